"""Per-key results where a few keys hold most rows (value-frequency compression)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.operators import radix
from codequarry.session import Scratch, hot_keys, salted_join


def value_frequencies(df: DataFrame, key: Column, value: Column, flag: Column | None = None) -> DataFrame:
    """(key, value, n, hits): one weighted row for each distinct value of a key; flag counts as hit where it is true.

    Grouped by both, so a hot key is spread over its values, and combined on the map side, so a hot value is one row a
    task. Every later result of the key is derived from these rows.
    """
    hit = F.count_if(flag) if flag is not None else F.lit(0).cast("long")
    return df.select(key.alias("key"), value.alias("value"), *([flag.alias("_flag")] if flag is not None else [])).groupBy("key", "value").agg(
        F.count(F.lit(1)).alias("n"), (F.count_if(F.col("_flag")) if flag is not None else hit).alias("hits")
    )


def key_profile(df: DataFrame, key: Column, value: Column, flag: Column | None = None) -> DataFrame:
    """One row for each key: n_rows, n_hits, hit_share, n_values (distinct, not null), mode, mode_rows.

    Null keys form one group with key null. Null values count as rows, but not as values and never as the mode; the mode
    is null if a key has no other values, and the smallest of tied values else. An empty input gives no rows.
    """
    freq = value_frequencies(df, key, value, flag)
    seen = F.col("value").isNotNull()
    top = F.min(F.when(seen, F.struct((-F.col("n")).alias("m"), F.col("value").alias("value"))))
    out = freq.groupBy("key").agg(
        F.sum("n").alias("n_rows"), F.sum("hits").alias("n_hits"), F.count("value").alias("n_values"), top.alias("_top")
    )
    return out.select(
        "key", "n_rows", "n_hits", (F.col("n_hits") / F.col("n_rows")).alias("hit_share"), "n_values",
        F.col("_top.value").alias("mode"), (-F.col("_top.m")).alias("mode_rows"),
    )


def key_percentiles(df: DataFrame, key: Column, value: Column, probs: Sequence[float]) -> DataFrame:
    """(key, prob, value): exact discrete percentiles of a long value for each non-null key.

    The smallest value whose cumulative weight reaches ceil(prob * rows), found by radix selection over the compressed
    frequencies. Null values are left out; a key that has only nulls gives no row.
    """
    scratch = Scratch(df.sparkSession)
    freq = value_frequencies(df, key, value.cast("long"), None).where("key IS NOT NULL AND value IS NOT NULL")
    freq = scratch.save(freq.select("key", "n", radix.ascending_long(F.col("value")).alias("code")))
    prob = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    sizes = scratch.save(freq.groupBy("key").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("values")))
    ranks = sizes.select("key", "total", prob.alias("prob"))
    ranks = ranks.select(F.struct("key", "prob").alias("kp"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("total") * F.col("prob"))).alias("_need"))
    rows = freq.select("n", "code", F.explode(F.array(*[F.struct(F.col("key"), F.lit(float(p)).alias("prob")) for p in probs])).alias("kp"))
    per = sizes.select("values", F.explode(F.array(*[F.struct(F.col("key"), F.lit(float(p)).alias("prob")) for p in probs])).alias("kp"))
    hot = hot_keys(per, "kp", "values", freq.count())
    cut = radix.cutoffs(rows, ranks, "kp", ["code"], weight="n", hot=hot, scratch=scratch)
    # the cutoff may lie between two values where the count met the rank early: take the largest value not beyond it
    got = salted_join(rows, cut, "kp", hot, F.col("code")).where(radix.not_beyond(["code"])).groupBy("kp").agg(F.max(F.col("code").bitwiseXOR(F.lit(-(2**63)))).alias("value"))
    return got.select("kp.key", "kp.prob", "value")
