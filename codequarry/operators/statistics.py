"""Data set statistics: repository metrics, top lists, year matrices, quantiles and bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The shares of which quantiles are asked.
PROBES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.96, 0.97, 0.98, 0.99]

# Weaknesses that count as memory-related.
MEMORY_CWES = ["CWE-119", "CWE-125", "CWE-787", "CWE-476", "CWE-20", "CWE-416", "CWE-190"]


def repo_metrics(flat: DataFrame) -> DataFrame:
    """CVEs, commits, vulnerable and other functions of each repository."""
    return flat.groupBy("repo_name").agg(
        F.count_distinct("cve_id").alias("n_cve"), F.count_distinct("commit_hash").alias("n_commit"),
        F.count_if(F.col("is_vul")).alias("n_vul"), F.count_if(~F.col("is_vul")).alias("n_non_vul"),
    )


def top(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest value, ties by the tie column."""
    return df.orderBy(F.desc(by), F.asc_nulls_last(tie)).limit(k)


def cwe_counts(cve: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """CVE rows of each weakness; a weakness named twice in one row counts once."""
    out = cve.select(F.explode(F.array_distinct("cwe_ids")).alias("cwe"))
    return (out.where(~F.col("cwe").isin(*without)) if without else out).groupBy("cwe").agg(F.count(F.lit(1)).alias("n"))


def matrix(rows: DataFrame, year: str, label: str, labels: Sequence[str], least: int = 0, other: str = "Other") -> DataFrame:
    """Counts by year and label, one column for each of the labels and one for all others; years of more than `least`."""
    bucket = F.when(F.col(label).isin(*labels), F.col(label)).otherwise(F.lit(other))
    wide = rows.where(F.col(year).isNotNull()).withColumn("_b", bucket).groupBy(F.col(year).alias("year")).pivot("_b", [*labels, other])
    out = wide.agg(F.count(F.lit(1))).na.fill(0)
    total = sum((F.col(f"`{c}`") for c in [*labels, other]), F.lit(0))
    return out.where(total > least)


def long_matrix(rows: DataFrame, year: str, label: str, k: int, least: int = 0, other: str = "Other") -> DataFrame:
    """(year, label, n) over the k most frequent labels and the rest as one; years of more than `least` rows. Without a pivot
    the labels need not be known beforehand."""
    counted = rows.where(F.col(year).isNotNull() & F.col(label).isNotNull())
    best = top(counted.groupBy(label).agg(F.count(F.lit(1)).alias("_n")), "_n", k, label).select(F.col(label).alias("_top"))
    marked = counted.join(F.broadcast(best), F.col(label) == F.col("_top"), "left")  # k rows
    out = marked.groupBy(F.col(year).alias("year"), F.coalesce("_top", F.lit(other)).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("_t", F.sum("n").over(Window.partitionBy("year"))).where(F.col("_t") > least).drop("_t")


def stacked(rows: DataFrame, bar: str, part: str) -> DataFrame:
    """(bar, part, n, offset): counts of a stacked bar chart; offset is what the parts before it (by name) add up to."""
    out = rows.groupBy(bar, part).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(bar).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn("offset", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long"))


def top_within(rows: DataFrame, outer: str, inner: str, k: int, other: str = "Other") -> DataFrame:
    """(outer, inner, n): for each outer value its k most frequent inner values, the rest as one."""
    n = rows.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(outer).orderBy(F.desc("n"), F.asc_nulls_last(inner)))
    return n.withColumn(inner, F.when(rank <= k, F.col(inner)).otherwise(F.lit(other))).groupBy(outer, inner).agg(F.sum("n").alias("n"))


def by_year_month(rows: DataFrame, year: str, month: str) -> DataFrame:
    """Counts by year and month with the sums of each year (month null) and of all (both null)."""
    known = rows.where(F.col(year).isNotNull()).select(F.col(year).alias("year"), F.col(month).alias("month"))
    return known.rollup("year", "month").agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, value: str, probes: Sequence[float] = PROBES) -> DataFrame:
    """(probe, value): exact quantiles with linear interpolation."""
    q = df.agg(F.percentile(value, F.array(*[F.lit(float(p)) for p in probes])).alias("q"))
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probes]).alias("probe"), F.col("q").alias("value"))
    return q.select(F.explode(pairs).alias("z")).select("z.probe", "z.value")


def sigma_bounds(df: DataFrame, value: str, k: int) -> DataFrame:
    """(lower, upper): mean -/+ k sample standard deviations, cut toward zero."""
    m, s = F.avg(value), F.stddev_samp(value)
    return df.agg((m - k * s).cast("long").alias("lower"), (m + k * s).cast("long").alias("upper"))


def describe(df: DataFrame, value: str) -> DataFrame:
    q = lambda p: F.percentile(value, p)
    return df.agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
        q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.75).alias("q75"), F.max(value).alias("max"),
    )


def memory_share(cve: DataFrame, cwes: Sequence[str] = MEMORY_CWES) -> DataFrame:
    """Memory-related weaknesses named by all CVEs, all weaknesses that they name, and their quotient."""
    named = cve.select(F.explode("cwe_ids").alias("cwe"))
    return named.agg(F.count_if(F.col("cwe").isin(*cwes)).alias("n_memory"), F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n_memory") / F.col("n"))


def treemap(counts: DataFrame, n: str) -> DataFrame:
    """Each row's share of the whole in percent, with four decimals."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn("percent", F.round(F.col(n) * 100 / total, 4))


def stage_deltas(stages: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    """Differences of counts to the stage before; a handful of rows."""
    w = Window.orderBy(order)
    return stages.select("*", *[(F.col(v) - F.lag(v).over(w)).alias(f"{v}_delta") for v in values])
