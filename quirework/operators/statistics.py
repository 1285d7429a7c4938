"""Error rates of two aligned tables, margins of error, goodness of fit, and summaries of numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Confidence levels and their normal scores. Fixed values.
SCORES = ((95, 1.96), (97, 2.17), (99, 2.576))
#: Differences that are expected by chance, per cell. Fixed value.
EXPECTED_RATE = 0.005


def differs(a: Column, b: Column) -> Column:
    """Unequal, two nulls being equal."""
    return ~a.eqNullSafe(b)


def margin(score: float, n: Column, rate: Column) -> Column:
    return F.when(n > 0, F.lit(score) * F.sqrt(rate * (1 - rate) / n))


def error_rates(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows (grp, n, n_errors, error_rate, moe_95, moe_97, moe_99) for each column, for all cells and for whole
    rows, over the keys both sides have; one pass over the joined rows."""
    b = right.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_r_{c}") for c in columns))
    met = left.join(b, left[key] == b["_k"])
    wrong = {c: differs(F.col(c), F.col(f"_r_{c}")) for c in columns}
    sums = met.agg(
        F.count("*").alias("_n"), *(F.count_if(w).alias(f"_d_{c}") for c, w in wrong.items()),
        F.count_if(reduce(lambda x, y: x | y, wrong.values())).alias("_rows"),
    )
    cells = reduce(lambda x, y: x + y, (F.col(f"_d_{c}") for c in columns))
    parts = [F.struct(F.lit(c).alias("grp"), F.col("_n").alias("n"), F.col(f"_d_{c}").alias("n_errors")) for c in columns]
    parts.append(F.struct(F.lit("(cells)").alias("grp"), (F.col("_n") * len(columns)).alias("n"), cells.alias("n_errors")))
    parts.append(F.struct(F.lit("(rows)").alias("grp"), F.col("_n").alias("n"), F.col("_rows").alias("n_errors")))
    out = sums.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
    rate = F.when(F.col("n") > 0, F.col("n_errors") / F.col("n"))
    return out.select("*", rate.alias("error_rate"), *(margin(z, F.col("n"), rate).alias(f"moe_{level}") for level, z in SCORES))


#: Coefficients, from the highest power, of Chebyshev's approximation of the complementary error function, whose
#: relative error is under 1.2e-7. Fixed values.
ERFC = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)


def erfc(x: Column) -> Column:
    """The complementary error function of a number from zero on."""
    t = 1 / (1 + x / 2)
    power = F.lit(0.0)
    for c in ERFC:
        power = power * t + F.lit(c)
    return F.least(F.lit(1.0), t * F.exp(power - x * x))


def chi_square(counts: DataFrame, n: str = "n", wrong: str = "n_errors", expected: float = EXPECTED_RATE) -> DataFrame:
    """`counts` with the chi-square statistic of wrong and right cells against the expected rate, the chance of
    it (one degree of freedom), and the direction if that is under 5 %."""
    e = F.col(n) * expected
    stat = F.when(F.col(n) > 0, F.pow(F.col(wrong) - e, 2) / e + F.pow(e - F.col(wrong), 2) / (F.col(n) - e))

    with_stat = counts.withColumn("chi2", stat)
    p = erfc(F.sqrt(F.col("chi2") / 2))
    side = F.when(F.col(wrong) / F.col(n) < expected, "lower").otherwise("higher")
    return with_stat.withColumn("p_value", p).withColumn("significant", F.when(F.col("p_value") < 0.05, side).otherwise(""))


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, exact quartiles and max of a column."""
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("low"),
        *(F.percentile(c, F.lit(q)).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)), F.max(c).alias("high"),
    )


def column_deviation(lines: DataFrame, page: Sequence[str], column: str, counted: str, columns: DataFrame | None = None) -> DataFrame:
    """Per page the numbers of lines of its columns: the mean, and how far a column is from it at most. With
    `columns` (page, column), those of them that have no lines count 0."""
    per = lines.groupBy(*page, column).agg(F.count(counted).alias("n"))
    if columns is not None:
        none = columns.select(*page, column).distinct().withColumn("n", F.lit(0).cast("bigint"))
        per = per.unionByName(none).groupBy(*page, column).agg(F.max("n").alias("n"))
    mean = per.groupBy(*page).agg(F.avg("n").alias("mean_lines"), F.min("n").alias("_lo"), F.max("n").alias("_hi"))
    return mean.select(*page, "mean_lines", F.greatest(F.col("mean_lines") - F.col("_lo"), F.col("_hi") - F.col("mean_lines")).alias("deviation"))
