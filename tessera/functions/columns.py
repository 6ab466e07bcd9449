"""Column-expression helpers. All of them build native Catalyst expressions,
so they stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

import math
import re
from statistics import NormalDist
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col_of", "ratio", "pct_text", "flag", "band", "season", "weekday_name",
    "snake_case", "normal_cdf", "z_quantile", "word_pair_flag", "clip_low", "rescale_over",
    "out_of_domain_null", "sigmoid", "epoch_seconds", "round_doubles", "presence_flag", "sig_round",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """Null-safe ratio: NULL when the denominator is 0 or NULL (never raises)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def pct_text(num, den, scale: int = 2) -> Column:
    """`round(num/den*100, scale) || '%'`, formatted through a decimal so the
    text is the same whatever the float path."""
    pct = F.try_divide(col_of(num).cast("double"), col_of(den).cast("double")) * 100
    return F.concat(F.round(pct, scale).cast(f"decimal(20,{scale})").cast("string"), F.lit("%"))


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 integer; NULL condition gives 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def presence_flag(c) -> Column:
    return col_of(c).isNotNull().cast("int")


def band(c, bounds: Sequence[tuple[float | None, float | None, str]], default: str | None = None) -> Column:
    """Half-open bands ``[lo, hi)`` -> label; ``None`` leaves a side open."""
    x = col_of(c)
    expr = None
    for lo, hi, label in bounds:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (x >= lo)
        if hi is not None:
            cond = cond & (x < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


# Month numbers of each season (northern-hemisphere meteorological seasons).
SEASON_MONTHS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autumn": (9, 10, 11)}


def season(month_col) -> Column:
    m = col_of(month_col)
    expr = None
    for name, months in SEASON_MONTHS.items():
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def weekday_name(c) -> Column:
    return F.date_format(col_of(c), "EEEE")


def epoch_seconds(c) -> Column:
    """Seconds since epoch of a timestamp / timestamp_ntz as double."""
    return F.unix_micros(col_of(c).cast("timestamp")) / F.lit(1_000_000.0)


_NON_WORD = re.compile(r"[^0-9a-zA-Z]+")


def snake_case(name: str) -> str:
    s = re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name.strip())
    s = _NON_WORD.sub("_", s).strip("_").lower()
    return re.sub(r"_+", "_", s)


def word_pair_flag(c, a: str, b: str) -> Column:
    """1 when the lower-cased text contains both words, 0 otherwise, NULL stays NULL."""
    x = F.lower(col_of(c))
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(flag(x.contains(a) & x.contains(b)))


def clip_low(c, low: float = 0.0) -> Column:
    x = col_of(c)
    return F.when(x.isNull(), x).otherwise(F.greatest(x, F.lit(low)))


def rescale_over(c, limit: float, divisor: float, truncate: bool = True) -> Column:
    """Values over ``limit`` are divided by ``divisor`` (and truncated); others kept."""
    x = col_of(c)
    scaled = x / F.lit(divisor)
    if truncate:
        scaled = F.floor(scaled)
    return F.when(x > limit, scaled.cast("double")).otherwise(x.cast("double"))


def out_of_domain_null(c, min_value: float | None = None, zero_is_null: bool = False) -> Column:
    x = col_of(c)
    out = x
    if min_value is not None:
        out = F.when(x >= min_value, x)
    if zero_is_null:
        out = F.nullif(out, F.lit(0))
    return out


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_of(c)))


# Abramowitz & Stegun 26.2.17 coefficients for the standard normal CDF (|error| < 7.5e-8).
_AS_P = 0.2316419
_AS_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal_cdf(c) -> Column:
    """Phi(z) as a Catalyst expression (Spark SQL has no erf)."""
    z = col_of(c).cast("double")
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_AS_P) * F.abs(z))
    poly = t * (F.lit(_AS_B[0]) + t * (F.lit(_AS_B[1]) + t * (F.lit(_AS_B[2]) + t * (F.lit(_AS_B[3]) + t * F.lit(_AS_B[4])))))
    pdf = F.exp(-z * z / 2.0) / F.lit(math.sqrt(2.0 * math.pi))
    upper = pdf * poly  # P(Z > |z|)
    return F.when(z >= 0, F.lit(1.0) - upper).otherwise(upper)


def z_quantile(p: float) -> float:
    """Phi^-1(p) as a plan-time constant (no data involved)."""
    return NormalDist().inv_cdf(p)


def sig_round(c, digits: int = 12) -> Column:
    """Round to ``digits`` significant digits as ``round(x / 10^e) * 10^e``.

    Float sums depend on summation order, so the last bits vary with the
    partitioning. Rounding to significant digits makes a mismatch need a
    value within ~1e-15 relative of a rounding boundary; the oracle SQL uses
    the same arithmetic (``tessera.plans.oracle.SIG``)."""
    x = col_of(c).cast("double")
    e = F.floor(F.log10(F.abs(x))) - F.lit(digits - 1)
    up = F.pow(F.lit(10.0), e)        # exact: 10^k, k >= 0
    down = F.pow(F.lit(10.0), -e)     # exact: 10^k, k > 0
    special = x.isNull() | (x == 0) | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return (F.when(special, x).when(e >= 0, F.round(x / up) * up)
            .otherwise(F.round(x * down) / down))


def round_doubles(df: DataFrame, digits: int = 12) -> DataFrame:
    """Round every double/float column to significant digits; integers
    widened to bigint. Used at the edge of a report so results are stable
    across partitionings."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t in ("double", "float") or t.startswith("decimal"):
            cols.append(sig_round(F.col(f"`{f.name}`"), digits).alias(f.name))
        elif t in ("int", "smallint", "tinyint"):
            cols.append(F.col(f"`{f.name}`").cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
