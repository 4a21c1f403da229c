"""Train, validation and test splits that never cut a group of tied records."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.operators.components import components
from codequarry.session import Scratch, hot_keys, salted_join

LABELS = 16  # the most frequent labels are balanced one by one, the rest together


def tie(records: DataFrame, id_: str, keys: list[str], scratch: Scratch) -> DataFrame:
    """(id, component) of every record: records that share a value of any key, directly or through others, have one
    component. Null values tie nothing; a record without any value is a component of its own."""
    named = [F.concat(F.lit(f"{i:02d}:"), F.col(k).cast("string")) for i, k in enumerate(keys)]
    own = F.concat(F.lit("~:"), F.col(id_).cast("string"))
    rows = scratch.save(records.select(F.col(id_).alias("id"), F.array_compact(F.array(*named)).alias("k")).withColumn("k", F.when(F.size("k") > 0, F.col("k")).otherwise(F.array(F.concat(F.lit("~:"), F.col("id").cast("string"))))))
    edges = rows.select(F.col("k")[0].alias("a"), F.explode("k").alias("b")).distinct()
    found = scratch.save(components(edges, scratch))
    first = rows.select("id", F.col("k")[0].alias("node"))
    counts = first.groupBy("node").agg(F.count(F.lit(1)).alias("c"))
    hot = hot_keys(counts, "node", "c", rows.count())
    return salted_join(first, found, "node", hot, F.col("id")).select("id", "component")


def _cost(sums: np.ndarray, share: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Squared relative deviation of each split's size, and a tenth of that of each label's rows."""
    want = np.maximum(share[:, None] * total[None, :], 1e-9)
    dev = ((sums - want) / np.maximum(total, 1)[None, :]) ** 2 / share[:, None]
    weight = np.concatenate([[1.0], np.full(sums.shape[1] - 1, 0.1)])
    return (dev * weight).sum()


def _anneal(units: np.ndarray, share: np.ndarray, start: np.ndarray, seed: int, steps: int) -> tuple[float, np.ndarray]:
    """units: (n, 1 + labels) rows of each unit, in all and by label. Moves one unit or exchanges two at each step."""
    rng = np.random.default_rng(seed)
    total = units.sum(axis=0)
    at = start.copy()
    if seed:  # other chains start from the same hashed assignment, shaken
        shake = rng.random(len(at)) < 0.1
        at[shake] = rng.integers(0, len(share), shake.sum())
    sums = np.zeros((len(share), units.shape[1]))
    np.add.at(sums, at, units)
    cost = _cost(sums, share, total)
    best, best_at = cost, at.copy()
    hot = max(cost, 1e-6)
    for i in range(steps):
        temperature = hot * 0.05 * (1 - i / steps) ** 3 + 1e-12
        x = int(rng.integers(len(at)))
        p = at[x]
        if rng.random() < 0.5:
            y, q = -1, int(rng.integers(len(share)))
            if q == p:
                continue
            delta = units[x]
        else:
            y = int(rng.integers(len(at)))
            q = at[y]
            if q == p:
                continue
            delta = units[x] - units[y]
        sums[p] -= delta
        sums[q] += delta
        new = _cost(sums, share, total)
        if new <= cost or rng.random() < np.exp((cost - new) / temperature):
            cost, at[x] = new, q
            if y >= 0:
                at[y] = p
            if cost < best:
                best, best_at = cost, at.copy()
        else:
            sums[p] += delta
            sums[q] -= delta
    return best, best_at


def split(records: DataFrame, id_: str, keys: list[str], label: str, shares: dict[str, float], chains: int = 8, steps: int = 20_000, buckets: int = 1024, scratch: Scratch | None = None) -> DataFrame:
    """(id, component, split) of every record, so that tied records (see tie) lie in one split.

    Components of at least a 1 / buckets share of the records are units of the search, at most `buckets` of them; all
    smaller ones are pooled by a hash of their name into `buckets` more units, so that what is searched is bounded
    whatever the input, and small components move together without being cut. Chains anneal in parallel from the hashed
    assignment, moving or exchanging units to bring each split's size and label counts to its share; the best is kept
    (ties: the first chain). Null labels count as a label; the labels beyond the LABELS most frequent are balanced as one. The same records get the same splits on any cluster.
    """
    spark = records.sparkSession
    scratch = scratch or Scratch(spark)
    ties = scratch.save(tie(records, id_, keys, scratch))
    labelled = records.select(F.col(id_).alias("id"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("label"))
    top = [r["label"] for r in labelled.groupBy("label").count().orderBy(F.desc("count"), "label").limit(LABELS).collect()]
    sizes = scratch.save(
        ties.join(labelled, "id").groupBy("component").agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == t).alias(f"l{i}") for i, t in enumerate(top)], F.count_if(~F.col("label").isin(top)).alias("rest")
        )
    )
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # a component's unit: itself if it is large, a bucket else
    unit = F.when(F.col("n") * buckets >= total, F.concat(F.lit("c"), F.col("component"))).otherwise(
        F.concat(F.lit("b"), F.pmod(F.xxhash64("component"), F.lit(buckets)).cast("string"))
    )
    sized = sizes.withColumn("unit", unit)
    cols = ["n", *[f"l{i}" for i in range(len(top))], "rest"]
    units = sized.groupBy("unit").agg(*[F.sum(c).alias(c) for c in cols]).orderBy("unit").toPandas()  # at most 2 * buckets rows
    names, share = list(shares), np.array(list(shares.values()), float)
    share = share / share.sum()
    if not len(units):
        return ties.select("id", "component", F.lit(None).cast("string").alias("split"))
    table = units[cols].to_numpy(float)
    import hashlib

    u = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=7).digest(), "big") / 2**56 for x in units["unit"]])
    start = np.minimum(np.searchsorted(np.cumsum(share), u, side="right"), len(share) - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chain in pdf["id"]:
                cost, at = _anneal(table, share, start, int(chain), steps)
                yield pd.DataFrame({"chain": [int(chain)], "cost": [cost], "at": [at.tolist()]})

    best = spark.range(0, chains, 1, chains).mapInPandas(run, "chain long, cost double, at array<int>").orderBy("cost", "chain").first()
    picked = spark.createDataFrame(pd.DataFrame({"unit": units["unit"], "split": [names[i] for i in best["at"]]}), "unit string, split string")
    by_component = sized.select("component", "n", "unit").join(F.broadcast(picked), "unit").select("component", "n", "split")
    hot = hot_keys(by_component, "component", "n", total)
    return salted_join(ties, by_component.drop("n"), "component", hot, F.col("id")).select("id", "component", "split")
