"""Column helpers shared by the operators."""

from ledgerloom.functions.casts import typed
from ledgerloom.functions.spread import spread_key

__all__ = ["spread_key", "typed"]
