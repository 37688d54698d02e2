"""Exact sums of doubles that stand for decimals, without wide decimals for the usual ones.

A double that is nearest to a decimal of two places, or of six, is counted as that
decimal: as whole cents and as millionths below a cent. Cents are cut into limbs of 20 bits,
so that the sum of a limb over 2**43 rows has its place in a long, and carries are
settled once for each group. All of it is arithmetic on longs and doubles in generated code.

Other doubles, with more places or very large, add up as decimals of twelve places; and a
group with one that these can't hold (not finite, or too large, also as a total) as doubles.
Where no such value occurs, no decimal is made for a row.
"""

from __future__ import annotations

#: Below these a double tells decimals of two and of six places apart (15 digits).
_CENTS_BELOW, _MILLIONTHS_BELOW = "1e13D", "1e9D"


def _tests(x: str) -> tuple[str, str]:
    """Whether ``x`` is a decimal of two places, or of six; null and NaN are neither."""
    cents = f"(abs({x}) < {_CENTS_BELOW} AND rint({x} * 100) / 100 = {x})"
    millionths = f"(abs({x}) < {_MILLIONTHS_BELOW} AND rint({x} * 1000000) / 1000000 = {x})"
    return cents, millionths


def sum_parts(x: str) -> dict[str, str]:
    """Aggregates, by name, that hold the exact sum of the double column ``x``."""
    cents, millionths = _tests(x)
    # Millionths as whole cents, rounded down, and what is left of them, 0 to 9,999.
    in_millionths = f"cast(rint({x} * 1000000) AS BIGINT)"
    left = f"pmod({in_millionths}, 10000L)"
    whole = (
        f"CASE WHEN {cents} THEN cast(rint({x} * 100) AS BIGINT)"
        f" WHEN {millionths} THEN ({in_millionths} - {left}) div 10000L END"
    )
    hard = f"{x} IS NOT NULL AND NOT coalesce({cents} OR {millionths}, false)"
    decimal = f"try_cast({x} AS DECIMAL(38, 12))"
    return {
        "low": f"sum(({whole}) & 1048575L)",
        "middle": f"sum(shiftright({whole}, 20) & 1048575L)",
        "high": f"sum(shiftright({whole}, 40))",
        "millionths": f"sum(CASE WHEN NOT {cents} AND {millionths} THEN {left} END)",
        "hard": f"count_if({hard})",
        "decimals": f"try_sum(CASE WHEN {hard} THEN {decimal} END)",
        "lost": f"count_if({hard} AND {decimal} IS NULL)",
        "doubles": f"sum({x})",
    }


def merged_parts(prefix: str) -> dict[str, str]:
    """The same aggregates from stored ones, whose columns are named ``<prefix>_<name>``."""
    return {
        name: f"try_sum({prefix}_{name})" if name == "decimals" else f"sum({prefix}_{name})"
        for name in sum_parts("x")
    }


def stored_parts(prefix: str) -> dict[str, str]:
    """Stored aggregates as they are, where nothing is to be added up."""
    return {name: f"{prefix}_{name}" for name in sum_parts("x")}


def rounded_total(parts: dict[str, str], places: int = 2) -> str:
    """The exact sum, rounded half up once, as a double; null where no value was summed."""
    part = {name: f"coalesce({parts[name]}, 0)" for name in ("low", "middle", "high", "millionths")}
    wide = {name: f"cast({e} AS DECIMAL(27, 0))" for name, e in part.items()}
    cents = f"({wide['high']} * 1099511627776BD + {wide['middle']} * 1048576BD + {wide['low']})"
    easy = f"(cast({cents} AS DECIMAL(32, 0)) * 0.01BD + {wide['millionths']} * 0.000001BD)"
    # Decimals that are too large as a total make this null, as ones that were lost do.
    hard = f"CASE WHEN {parts['hard']} = 0 THEN 0BD WHEN {parts['lost']} = 0 THEN {parts['decimals']} END"
    exact = f"try_add(try_cast({easy} AS DECIMAL(38, 12)), try_cast({hard} AS DECIMAL(38, 12)))"
    return (
        f"CASE WHEN {parts['doubles']} IS NOT NULL THEN "
        f"coalesce(cast(round({exact}, {places}) AS DOUBLE), round({parts['doubles']}, {places})) END"
    )
