"""Stored tables: one folder per table below a layer folder.

    <data>/raw/<table>.parquet         source files as tables, unchanged
    <data>/enriched/<table>.parquet    typed tables and the order fact
    <data>/aggregated/<table>.parquet  rollups

In a table's folder each store leaves a version of its own, and one small file names the
version that counts:

    _current                           the pointer, JSON
    _versions/00000012-<id>/           Parquet files of one version

A version is written in full, then the pointer is replaced in one step. Whatever ends a
store, and whenever, readers find the table as it was or as it is now.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
import uuid
from dataclasses import asdict, dataclass
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom import paths
from ledgerloom.sources.text import OnMissing, empty_table

log = logging.getLogger(__name__)

Layer = Literal["raw", "enriched", "aggregated"]
Staging = Literal["swap", "direct"]
OnError = Literal["raise", "flag"]

POINTER, VERSIONS = "_current", "_versions"

#: Versions that no pointer names and that nothing has changed for so long are swept. It must be
#: longer than any store pauses, and than readers go on with a version that was replaced.
SWEEP_HOURS = 24.0


@dataclass(frozen=True)
class Version:
    """What a pointer names: a version's folder, the one before, and what it was made from."""

    name: str
    replaces: str | None = None
    made_from: str | None = None


def table_path(data_dir: str, layer: Layer, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{layer}/{name}.parquet"


def version_path(path: str, version: Version | str) -> str:
    name = version if isinstance(version, str) else version.name
    return f"{path}/{VERSIONS}/{name}"


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The version that counts, or None if none was ever published.

    A pointer that can't be read may have been cut short where an overwrite isn't one step. It
    was then about to name the newest finished version, which is taken.
    """
    text = paths.read_text(spark, f"{path}/{POINTER}")
    if text is None:
        return None
    try:
        return Version(**json.loads(text))
    except (ValueError, TypeError):
        finished = [
            name
            for name in paths.children(spark, f"{path}/{VERSIONS}")
            if paths.exists(spark, f"{version_path(path, name)}/_SUCCESS")
        ]
        if not finished:
            raise FileNotFoundError(f"{path} has a damaged pointer and no finished version") from None
        log.warning("the pointer of %s is damaged; taking version %s", path, finished[-1])
        return Version(finished[-1])


def fingerprint(*parts: object) -> str:
    """A short text that differs if any of the parts, plain values, does."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:32]


def is_made_from(spark: SparkSession, path: str, made_from: str) -> bool:
    """Whether the table's version that counts was stored with this ``made_from``, and is there."""
    version = current_version(spark, path)
    return (
        version is not None
        and version.made_from == made_from
        and paths.exists(spark, f"{version_path(path, version)}/_SUCCESS")
    )


def store_table(
    df: DataFrame,
    path: str,
    staging: Staging = "swap",
    on_error: OnError = "raise",
    made_from: str | None = None,
    sweep_hours: float = SWEEP_HOURS,
) -> bool:
    """Replace the table at ``path`` with ``df``.

    The new version is written beside the old one, so a job that fails, or a driver that is
    lost, leaves the table as it was, and ``df`` may be derived from it. ``staging`` says how the
    pointer is replaced: ``swap`` renames a new file over it (HDFS, local disks), ``direct``
    overwrites it (object stores, which do that in one step). Of two stores at a time the one
    that ends last counts, and both are whole.

    ``made_from`` is kept with the version: a fingerprint of what it was made from, by which a
    flow tells that a step is done (``is_made_from``). It is published in the same step as the data.

    The version that was replaced stays for frames that still read it. It is swept, like what
    lost stores have left, by a store that comes ``sweep_hours`` after its last change.

    Failures are raised, or with ``on_error="flag"`` logged and returned as False.
    """
    spark = df.sparkSession
    try:
        version = _write_version(df, path, made_from)
        publish(spark, path, version, staging)
    except Exception:
        if on_error == "flag":
            log.exception("could not store %s", path)
            return False
        raise
    try:
        sweep(spark, path, sweep_hours)
    except Exception:  # the table is stored; what couldn't be swept is swept another time
        log.warning("could not sweep %s", path, exc_info=True)
    return True


def _write_version(df: DataFrame, path: str, made_from: str | None) -> Version:
    spark = df.sparkSession
    known = [name.split("-")[0] for name in paths.children(spark, f"{path}/{VERSIONS}")]
    number = max((int(n) for n in known if n.isdigit()), default=0) + 1
    before = current_version(spark, path)
    version = Version(f"{number:08d}-{uuid.uuid4().hex[:12]}", before and before.name, made_from)
    target = version_path(path, version)
    try:
        options = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true", "compression": "zstd"}
        df.write.options(**options).parquet(target)
    except Exception:
        paths.delete(spark, target)
        for folder in (f"{path}/{VERSIONS}", path):  # of a table that never was
            if not paths.children(spark, folder):
                paths.delete(spark, folder)
        raise
    return version


def publish(spark: SparkSession, path: str, version: Version, staging: Staging = "swap") -> None:
    """Let the pointer of ``path`` name ``version``, in one step."""
    if not paths.exists(spark, f"{version_path(path, version)}/_SUCCESS"):
        raise FileNotFoundError(f"{version_path(path, version)} isn't a finished version")
    paths.put_text(spark, f"{path}/{POINTER}", json.dumps(asdict(version)), rename=staging == "swap")


def sweep(spark: SparkSession, path: str, older_than_hours: float = SWEEP_HOURS) -> list[str]:
    """Delete what the pointer doesn't name and nothing has changed for so long; tells what went.

    That is replaced versions, versions and pointers of stores that were lost, and data files
    of the layout without versions, which the pointer has replaced. A version that a running
    store still writes is young.
    """
    current = current_version(spark, path)
    if current is None:
        return []
    oldest = (time.time() - older_than_hours * 3600) * 1000
    kept = {POINTER, VERSIONS}
    others = [f"{path}/{name}" for name in paths.children(spark, path) if name not in kept]
    others += [
        version_path(path, name)
        for name in paths.children(spark, f"{path}/{VERSIONS}")
        if name != current.name
    ]
    gone = [other for other in others if paths.newest_change(spark, other) <= oldest]
    for other in gone:
        paths.delete(spark, other)
    return gone


def load_table(
    spark: SparkSession, path: str, schema: T.StructType, on_missing: OnMissing = "raise"
) -> DataFrame:
    """Read a stored table, checked against its declared schema.

    A table is missing if no version was published and its folder holds no data. A plain
    Parquet folder without a pointer is read too. Data there without ``_SUCCESS`` may be what a
    failed overwrite left behind, or come from a writer that leaves no marker: with
    ``on_missing="raise"`` that is an error, with ``"empty"`` it is read, and logged. A pointer
    whose version is gone is always an error. Neither is ever taken for empty. A column that is
    absent or of another type is an error.
    """
    version = current_version(spark, path)
    location = version_path(path, version) if version else path
    if not paths.exists(spark, f"{location}/_SUCCESS"):
        if version:
            raise FileNotFoundError(f"{path} names {version.name}, which isn't there")
        unfinished = paths.holds_data(spark, path)
        if on_missing == "raise":
            raise FileNotFoundError(f"no finished table at {path}")
        if not unfinished:
            return empty_table(spark, schema)
        log.warning("%s holds data but no _SUCCESS; reading what is there", path)
    df = spark.read.parquet(location)
    found = {field.name: field.dataType for field in df.schema}
    wrong = [f.name for f in schema if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"{path} does not have the declared columns {wrong}")
    return df.select([f"`{name}`" for name in schema.names])
