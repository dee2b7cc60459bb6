"""Sums and means of doubles that do not depend on the order of the rows, as SQL text.

A double below 2^40 in size is the sum of three whole numbers in units of 1, 2^-40 and 2^-80, all with its sign. Sums of whole numbers are the
same in any order. Smaller parts than 2^-80 (of doubles below 2^-28 in size) are cut off. A mean comes as the nearest double and its *side*: 1 if that
double lies above the exact mean, -1 if below, 0 if it is the exact mean; so a reading can be compared with the exact mean itself.
"""

from __future__ import annotations

LIMIT = "1099511627776.0D"  # 2^40
UNIT, UNITS = "1099511627776", "1208925819614629174706176"  # 2^40, 2^80
WIDE = "decimal(38, 0)"
PARTS = ("whole", "fine", "finest")


def inside(x: str) -> str:
    """Whether a value has an exact form (not if it is infinite, not a number, or 2^40 and more)."""
    return f"abs({x}) < {LIMIT}"


def parts(x: str) -> dict[str, str]:
    """The three whole numbers of a value; 0 for values without an exact form."""
    whole = f"floor(abs({x}))"
    fine = f"((abs({x}) - {whole}) * {LIMIT})"
    finest = f"floor(({fine} - floor({fine})) * {LIMIT})"
    signed = lambda p: f"if({inside(x)}, if({x} < 0, -{p}, {p}), if({x} is null, null, 0L))"
    return dict(zip(PARTS, (signed(whole), signed(f"floor({fine})"), signed(finest)), strict=True))


def first_mean(whole: str, fine: str, finest: str, n: str) -> str:
    """The mean within a few units in the last place."""
    return f"try_divide(cast({whole} as double) + cast({fine} as double) / {LIMIT} + cast({finest} as double) / {LIMIT} / {LIMIT}, cast({n} as double))"


def excess(mean: str, whole: str, fine: str, finest: str, n: str) -> str:
    """``n * mean`` less the sum, in units of 2^-80: exact for a double near the mean."""
    own = parts(mean)
    gaps = [f"cast({own[p]} as {WIDE}) * cast({n} as decimal(18, 0)) - cast({total} as {WIDE})" for p, total in zip(PARTS, (whole, fine, finest), strict=True)]
    return f"cast({gaps[0]} as decimal(13, 0)) * {UNITS}BD + cast({gaps[1]} as decimal(25, 0)) * {UNIT}BD + ({gaps[2]})"


def nearer_mean(mean: str, excess_of_it: str, n: str) -> str:
    """The mean moved by its error: no double lies between the result and the exact mean."""
    return f"{mean} - try_divide(cast({excess_of_it} as double) / {LIMIT} / {LIMIT}, cast({n} as double))"
