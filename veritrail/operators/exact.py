"""Exactly rounded sums and means of doubles, the same bits however rows are dealt out.

A double is an integer of 55 bits times a power of two. Integers are summed by that exponent, in three limbs of LIMB bits, each in a long: whole-number
sums in any order and any number of steps give the same partials, so they merge across tasks, files and micro-batches. Some 2^43 rows of
one exponent fit; more raise. There are at most some 2,100 exponents, of which data has a few. The end result is the exact sum, rounded once. A mean is that by the
count, as the standard library's fmean has it, and so rounded once more (three times 0.1: 0.10000000000000002); nearest_mean is the exact mean, rounded once (0.1).

Null values don't count. Zeros of both signs are 0. Infinities and NaN make their own sums (of both infinities: NaN). No rows: no sum and no mean.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 19
LEAST_EXPONENT = -1074  #: of the smallest double
PARTS = ("hi", "mid", "lo", "n", "odd")


def power(k: Column) -> Column:
    return F.pow(F.lit(2.0), k)


def decomposed(x: Column) -> tuple[Column, Column]:
    """(exponent q, integer m) with x = m * 2^q exactly, for a finite x; a logarithm off by one does no harm."""
    q = F.coalesce(F.greatest(F.floor(F.log2(F.abs(x))) - 53, F.lit(LEAST_EXPONENT)), F.lit(0)).cast("int")
    half = F.floor(q / 2)  # in two steps, as 2^1074 is no double
    return q, (x * power(-half) * power(half - q)).cast("bigint")


def partials(rows: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, exponent, hi, mid, lo, n, odd) of columns, one row for each exponent that occurs; odd: what isn't finite."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    each = rows.select(*by, values.alias("v")).select(*by, "v.column", "v.x").filter(F.col("x").isNotNull())
    finite = ~F.isnan("x") & (F.abs("x") < float("inf"))
    q, m = decomposed(F.when(finite, F.col("x")).otherwise(0.0))
    split = each.select(*by, "column", q.alias("exponent"), m.alias("m"), F.when(~finite, F.col("x")).alias("odd"))
    mask = F.lit((1 << LIMB) - 1).cast("bigint")
    return split.groupBy(*by, "column", "exponent").agg(
        F.sum(F.shiftright("m", 2 * LIMB)).alias("hi"), F.sum(F.shiftright("m", LIMB).bitwiseAND(mask)).alias("mid"), F.sum(F.col("m").bitwiseAND(mask)).alias("lo"),
        F.count("*").alias("n"), F.sum("odd").alias("odd"),
    )


def merged(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Partials of partials."""
    return parts.groupBy(*by, "column", "exponent").agg(*[F.sum(p).alias(p) for p in PARTS])


def rounded(terms: pd.Series) -> pd.DataFrame:
    """Sum and mean of (exponent, hi, mid, lo, n) as the nearest doubles, ties to even."""
    from fractions import Fraction

    def nearest(x: Fraction) -> float:
        try:
            return float(x)
        except OverflowError:  # beyond the largest double
            return float("inf") if x > 0 else float("-inf")

    out = []
    for each in terms:
        total = Fraction(sum(((t["hi"] << 38) + (t["mid"] << 19) + t["lo"]) << (t["exponent"] + 1074) for t in each), 1 << 1074)
        out.append((nearest(total), nearest(total / sum(t["n"] for t in each))))
    return pd.DataFrame(out, columns=["sum", "mean"])


def sums(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n, sum, mean, nearest_mean) of partials, whole or not yet merged."""
    terms = F.collect_list(F.struct("exponent", "hi", "mid", "lo", "n"))  # an entry for each exponent
    grouped = merged(parts, by).groupBy(*by, "column").agg(F.sum("n").alias("n"), F.sum("odd").alias("odd"), terms.alias("terms"))
    done = grouped.withColumn("r", F.pandas_udf(rounded, "sum double, mean double")("terms"))
    total = F.coalesce("odd", "r.sum")
    return done.select(*by, "column", "n", total.alias("sum"), (total / F.col("n").cast("double")).alias("mean"), F.coalesce("odd", "r.mean").alias("nearest_mean"))


def means(parts: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row for each value of by (a single one without), with mean_<column> for each column; null where it has no value."""
    wide = [F.max(F.when(F.col("column") == c, F.col("mean"))).alias(f"mean_{c}") for c in columns]
    return sums(parts, by).groupBy(*by).agg(*wide)
