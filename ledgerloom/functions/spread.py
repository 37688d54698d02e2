"""Join keys that do not pile up on one task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spread_key(key: Column, *row: Column | str) -> Column:
    """``key``, with nulls replaced by filler texts made from a hash of ``row``.

    An outer join sends every null key to the same task although none of them can
    match. The filler is a function of the row, so a retried task repeats it; its
    64 bits don't bound the number of tasks that share the nulls. The join must also require the original
    key to be present, because a filler might equal a real key.
    """
    return F.coalesce(key, F.concat(F.lit("null-"), F.xxhash64(*row).cast("string")))
