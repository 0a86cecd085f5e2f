"""Column expressions: text, rounding, formulas of the network model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(x: Column) -> Column:
    """NaN as null: comparisons and averages then treat it as missing (in Spark NaN is above all numbers)."""
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def above(x: Column, t: float) -> Column:
    """x > t, false where x is missing."""
    return F.coalesce(known(x) > t, F.lit(False))


def clip(x: Column, low: float, high: float) -> Column:
    """x held to [low, high]; missing stays missing (least and greatest would skip a null)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)


def half_even_scaled(x: Column, digits: int = 0) -> Column:
    """Half-even on the scaled double, as numpy and SQL's round_even have it: what counts is x * 10**digits in binary, not
    the decimals that x is shown with (0.575 gives 0.57, where ``half_even`` gives 0.58)."""
    scale = 10.0**digits
    return F.rint(x * scale) / scale


def fixed(x: Column, digits: int) -> Column:
    """A double with so many decimals as printf writes it: zeros keep their sign, and what is no finite number is nan, inf or -inf."""
    text = F.when(F.isnan(x), F.lit("nan")).when(x == float("inf"), F.lit("inf")).when(x == float("-inf"), F.lit("-inf")).otherwise(F.format_string(f"%.{digits}f", x))
    return F.when(x.isNotNull(), text)


def blank_name(name: Column) -> Column:
    """A name, or the empty string where it says that there is none."""
    t = F.trim(F.coalesce(name, F.lit("")))
    return F.when(F.lower(t).isin("", "nan", "none", "null"), F.lit("")).otherwise(t)


def title_case(x: Column) -> Column:
    return F.initcap(F.lower(x))


def plural(x: Column) -> Column:
    """Minor -> Minors, Distributary -> Distributaries."""
    return F.concat(F.regexp_replace(x, "y$", "ie"), F.lit("s"))


def km_text(metres: Column) -> Column:
    """Kilometres with one decimal, ties to even; ? where unknown or infinite."""
    km = F.bround(metres / 1000.0, 1)
    return F.when(km.isNull() | F.isnan(km) | (F.abs(km) == float("inf")), F.lit("?")).otherwise(F.format_string("%.1f", km))


def content_key(*parts: Column, prefix: str = "SEG_", digits: int = 10) -> Column:
    """A stable id from content: the first hexadecimal digits of an MD5."""
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat_ws("|", *parts)), 1, digits))


def whole_text(x: Column) -> Column:
    """A number as text without decimals, ties to even; small negative ones keep their sign, as printf does."""
    n = F.bround(x, 0)
    return F.when((n == 0) & x.cast("string").startswith("-"), F.lit("-0")).otherwise(n.cast("decimal(38,0)").cast("string"))


def numbered(prefix: Column, k: Column, width: int = 3) -> Column:
    return F.concat(prefix, F.lit("_"), F.format_string(f"%0{width}d", k))


def sample_count(length: Column, spacing: float = 200.0) -> Column:
    """Sample points of a line: one for each whole spacing, one at least."""
    return F.greatest(F.lit(1).cast("long"), F.floor(length / spacing).cast("long"))


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); missing if either is, or the sum is zero."""
    return (a - b) / F.nullif(a + b, F.lit(0.0))


def ring_mean(outer: Column, inner: Column, r_out: float, r_in: float) -> Column:
    """Mean over a ring, from the means over its two discs."""
    return (outer * r_out**2 - inner * r_in**2) / (r_out**2 - r_in**2)


def ratio(a: Column, b: Column) -> Column:
    """a / b; missing where b is zero."""
    return a / F.nullif(b, F.lit(0.0))


def band(score: Column) -> Column:
    """Criticality of a score in [0, 1]."""
    return F.when(score >= 0.8, "critical").when(score >= 0.6, "high").when(score >= 0.35, "moderate").otherwise("low")


def uniform(*parts: Column | str) -> Column:
    """A number in (0, 1] that depends on the parts alone, the same in every engine with MD5."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])), 1, 12), 16, 10).cast("double")
    return (h + 1.0) / float(1 << 48)


def contains_ci(q: str, *cols: Column) -> Column:
    """Whether any column contains q, case ignored and q taken literally."""
    out = F.lit(False)
    for c in cols:
        out = out | F.coalesce(F.contains(F.lower(c), F.lit(q.lower())), F.lit(False))
    return out
