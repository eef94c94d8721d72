"""Sums that do not depend on the order of addition, and rounding of the binary value.

Two ways to add up doubles exactly, both plain aggregates whose parts merge over any partitioning:

- *Moments in whole numbers*, for quantities with a fixed scale such as money or units: every value becomes a
  whole number of 10^-6 (``PLACES``), and counts, sums and sums of squares of those are exact. Mean and deviation
  follow from them without cancellation, however large the values are next to their spread.
- *Limbs*, for numbers of no fixed scale such as errors of a model: every double is cut into six signed digits of 32
  bits, for the powers 2^64 down to 2^-96, whose sums are whole numbers of 64 bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = 6
EXACT = "decimal(38,0)"

# Moments in whole numbers


def whole(value: Column, places: int = PLACES) -> Column:
    """The nearest whole number of 10^-places. Values beyond 9.2e18 of these fail the job."""
    return F.rint(value.cast("double") * float(10**places)).cast("bigint")


def moments(value: Column, places: int = PLACES, prefix: str = "") -> dict[str, Column]:
    """Aggregates ``<prefix>n``, ``<prefix>sum`` and ``<prefix>squares`` over the values that are not NULL; rows of them add
    up to the moments of the union (``merged``)."""
    y = whole(value, places)
    large = y.cast("decimal(19,0)")
    return {
        f"{prefix}n": F.count(y),
        f"{prefix}sum": F.coalesce(F.sum(large), F.lit(0)).cast(EXACT),
        f"{prefix}squares": F.coalesce(F.sum((large * large).cast(EXACT)), F.lit(0)).cast(EXACT),
    }


def merged(prefix: str = "") -> dict[str, Column]:
    return {f"{prefix}{c}": F.sum(f"{prefix}{c}").cast("bigint" if c == "n" else EXACT) for c in ("n", "sum", "squares")}


def mean_of(prefix: str = "", places: int = PLACES) -> Column:
    """NULL without values."""
    n, total = F.col(f"{prefix}n"), F.col(f"{prefix}sum")
    return F.when(n > 0, total.cast("double") / (n * 10**places).cast("double"))


def deviation_of(prefix: str = "", places: int = PLACES) -> Column:
    """The sample standard deviation; NULL for fewer than two values.

    With sum = q * n + r, the squared distances from the mean add up to squares - q*q*n - 2*q*r, a whole number, less
    r*r/n."""
    n, total, squares = (F.col(f"{prefix}{c}") for c in ("n", "sum", "squares"))
    count = F.nullif(n, F.lit(0))
    q = F.call_function("div", total, count.cast("decimal(19,0)")).cast("decimal(19,0)")
    r = (total - (q * count.cast("decimal(19,0)")).cast(EXACT)).cast("decimal(19,0)")
    around = squares - ((q * q).cast(EXACT) * count.cast("decimal(19,0)")).cast(EXACT) - (q * r * 2).cast(EXACT)
    rest = (r * r).cast(EXACT).cast("double") / count
    spread = around.cast("double") - rest
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)) / float(10**places))


# Limbs

_BITS = 32
_POWERS = (2, 1, 0, -1, -2, -3)
_LARGEST = 2.0**126


def limb_sums(name: str, value: Column) -> dict[str, Column]:
    """Aggregates ``<name>_0`` (highest) to ``<name>_5`` and ``<name>_odd`` over the values that are not NULL. Each adds up by
    ``sum``. Digits below 2^-97 are rounded off for every value by itself; NaN, infinities and numbers from 2^126 on are
    added apart."""
    fits = F.abs(value) < _LARGEST
    inside = F.when(fits, value)
    parts = {}
    for k, power in enumerate(_POWERS):
        digit = F.rint(inside * 2.0 ** (-_BITS * power))
        if k:
            # Both terms and their difference are whole numbers that doubles hold exactly.
            digit = digit - F.rint(inside * 2.0 ** (-_BITS * _POWERS[k - 1])) * 2.0**_BITS
        parts[f"{name}_{k}"] = F.sum(digit.cast("bigint"))
    return parts | {f"{name}_odd": F.sum(F.when(~fits | F.isnan(value), value))}


def limb_names(name: str) -> list[str]:
    return [*(f"{name}_{k}" for k in range(len(_POWERS))), f"{name}_odd"]


def limb_totals(sums: DataFrame, names: Sequence[str]) -> DataFrame:
    """The sums as doubles under their names, instead of the limbs; for values that are not negative. The same for any order
    of addition. NULL without values.

    One small projection for each limb, from the lowest: what a step uses twice is a column of the step before."""
    low = F.lit((1 << _BITS) - 1).cast("bigint")
    out = sums.withColumns({f"__carry_{n}": F.lit(0).cast("bigint") for n in names} | {f"__part_{n}": F.lit(0.0) for n in names})
    for k in reversed(range(1, len(_POWERS))):
        out = out.withColumns({f"{n}_{k}": F.col(f"{n}_{k}") + F.col(f"__carry_{n}") for n in names})
        carries = {f"__carry_{n}": F.shiftright(f"{n}_{k}", _BITS) for n in names}
        parts = {f"__part_{n}": (F.col(f"{n}_{k}").bitwiseAND(low).cast("double") + F.col(f"__part_{n}")) * 2.0**-_BITS for n in names}
        out = out.withColumns(carries | parts)
    whole = 2.0 ** (_BITS * _POWERS[0])
    out = out.withColumns({n: ((F.col(f"{n}_0") + F.col(f"__carry_{n}")).cast("double") + F.col(f"__part_{n}")) * whole for n in names})
    odd = lambda n: F.col(f"{n}_odd")
    out = out.withColumns({n: F.when(odd(n).isNull(), F.col(n)).otherwise(odd(n) + F.coalesce(n, F.lit(0.0))) for n in names})
    gone = [part for n in names for part in (*limb_names(n), f"__carry_{n}", f"__part_{n}")]
    return out.drop(*gone)


# Rounding


def round_columns(df: DataFrame, names: Sequence[str], places: int = 4) -> DataFrame:
    """The columns rounded as the binary numbers that they are, ties to even: 0.00015 is a little less than that and
    becomes 0.0001. (``round`` of SQL rounds its shortest decimal text instead.) For ``places`` up to 8; numbers so large
    that ``places`` more digits leave 53 bits stay as they are.

    The product with the power of ten is taken in two parts, its rounded value and the exact rest, so the comparison with
    one half is exact. What a step uses several times is a column of the step before, which keeps the generated code short."""
    scale = float(10**places)
    part = lambda kind, n: F.col(f"__{kind}_{n}")
    step = lambda frame, kind, make: frame.withColumns({f"__{kind}_{n}": make(n) for n in names})
    out = step(df, "size", lambda n: F.abs(n))
    out = step(out, "product", lambda n: part("size", n) * scale)
    # The upper half of the bits, so that both partial products with the power of ten are exact.
    out = step(out, "upper", lambda n: part("size", n) * 134217729.0)
    out = step(out, "head", lambda n: part("upper", n) - (part("upper", n) - part("size", n)))
    out = step(out, "rest", lambda n: (part("head", n) * scale - part("product", n)) + (part("size", n) - part("head", n)) * scale)
    out = step(out, "down", lambda n: F.floor(F.when(part("product", n) < 2.0**53, part("product", n))).cast("double"))
    out = step(out, "over", lambda n: (part("product", n) - part("down", n)) - 0.5)
    odd = lambda n: part("down", n) % 2 == 1
    out = step(out, "up", lambda n: F.when(part("over", n) > -part("rest", n), 1.0).when((part("over", n) == -part("rest", n)) & odd(n), 1.0).otherwise(0.0))
    out = step(out, "near", lambda n: (part("down", n) + part("up", n)) / scale)
    signed = {n: F.when(part("near", n).isNull(), F.col(n)).when(F.col(n) < 0, -part("near", n)).otherwise(part("near", n)) for n in names}
    kinds = ("size", "product", "upper", "head", "rest", "down", "over", "up", "near")
    return out.withColumns(signed).drop(*[f"__{kind}_{n}" for kind in kinds for n in names])
