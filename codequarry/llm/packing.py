"""Documents packed into containers of fixed capacity by vector best-fit."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents that are packed together; each shard leaves only its last containers unfilled.
SHARD = 20_000


def best_fit(sizes: np.ndarray, capacity: int, most_items: int, attention: float, weights=(1.0, 0.05, 0.2)) -> np.ndarray:
    """The bin of each item, numbered from 0; sizes are at most the capacity.

    Items come by falling size. A bin has three residual capacities: tokens, items and attention cost (the sum of squared
    sizes). Among the open bins in which an item fits in every one, it goes to the bin with the least weighted norm of
    what would be left; the first of equal ones. Where none fits, a bin is opened. Bins in which not even the smallest item
    fits are closed, which leaves no choice out. An item alone may exceed the attention cost, as it cannot be cut for it.
    """
    order = np.argsort(-sizes, kind="stable")
    out = np.empty(len(sizes), np.int64)
    if not len(sizes):
        return out
    least = int(sizes.min())
    wt, wc, wa = weights[0] / capacity, weights[1] / most_items, weights[2] / attention
    r = np.empty(64)
    c = np.empty(64)
    a = np.empty(64)
    name = np.empty(64, np.int64)
    n_open = n_bins = 0
    since = 0
    for i in order:
        s = float(sizes[i])
        k = -1
        if n_open:
            fit = np.flatnonzero((r[:n_open] >= s) & (a[:n_open] >= s * s))
            if len(fit):
                left = ((r[fit] - s) * wt) ** 2 + ((c[fit] - 1) * wc) ** 2 + ((a[fit] - s * s) * wa) ** 2
                k = int(fit[left.argmin()])
        if k < 0:
            if n_open == len(r):
                r, c, a, name = (np.concatenate([x, np.empty_like(x)]) for x in (r, c, a, name))
            k = n_open
            r[k], c[k], a[k], name[k] = capacity, most_items, attention, n_bins
            n_open += 1
            n_bins += 1
        out[i] = name[k]
        r[k] -= s
        c[k] -= 1
        a[k] -= s * s
        since += 1
        if c[k] < 1 or r[k] < least or a[k] < least * least or since >= 4096:
            live = (c[:n_open] >= 1) & (r[:n_open] >= least) & (a[:n_open] >= least * least)
            since, m = 0, int(live.sum())
            if m < n_open:
                for x in (r, c, a, name):
                    x[:m] = x[:n_open][live]
                n_open = m
    return out


def pack(sizes: DataFrame, id_: str, size: str, containers: dict[str, float], most_items: int = 256, attention: float = 1.0, shard: int = SHARD, count: int | None = None) -> DataFrame:
    """Pieces of every item in every kind of container: id, container, piece, pieces, first, tokens, shard, bin.

    Only an item larger than the container is cut: into full pieces and one rest, first being the piece's first token.
    Each bin keeps at most its capacity of tokens, most_items pieces and attention * capacity**2 of attention cost (a
    piece alone excepted). Rows with a null id or size are left out; an empty item is one piece of no tokens; rows with
    one id are items of their own. (shard, bin) numbers the bins of a container. Shards are cut by a hash of the id, so
    that no task packs more than about `shard` items; an empty table gives no rows. count is the
    number of items, where the caller knows it or an upper bound; it only sets the number of shards.
    """
    rows = sizes.where(F.col(id_).isNotNull() & F.col(size).isNotNull()).select(F.col(id_).alias("id"), F.col(size).cast("long").alias("n"))
    count = rows.count() if count is None else count
    shards = max(1, math.ceil(count / shard))
    kinds = {k: max(1, int(v)) for k, v in containers.items()}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")  # the same bins whatever the order of arrival
        ids, n = pdf["id"].to_numpy(), pdf["n"].to_numpy()
        parts = []
        for kind, cap in kinds.items():
            pieces = np.maximum(1, -(-n // cap))
            of = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            tokens = np.minimum(cap, n[of] - piece * cap)
            full = tokens == cap
            bins = np.empty(len(of), np.int64)
            rest = best_fit(tokens[~full], cap, most_items, attention * cap * cap)
            bins[~full] = rest
            bins[full] = np.arange(full.sum()) + (rest.max() + 1 if len(rest) else 0)
            parts.append(pd.DataFrame({
                "id": ids[of], "container": kind, "piece": piece.astype("int32"), "pieces": pieces[of].astype("int32"),
                "first": piece * cap, "tokens": tokens, "shard": pdf["shard"].iloc[0], "bin": bins,
            }))
        return pd.concat(parts)

    kind = rows.schema["id"].dataType.simpleString()
    out = f"id {kind}, container string, piece int, pieces int, first long, tokens long, shard int, bin long"
    # a task for each shard: a number of partitions that is asked for is not merged again, as small shards would be
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).repartition(2 * shards, "shard")
    return dealt.groupBy("shard").applyInPandas(run, out)


def bin_checks(packed: DataFrame, containers: dict[str, float], most_items: int = 256, attention: float = 1.0) -> DataFrame:
    """(container, tokens, pieces, over_tokens, over_items, over_attention): what lies in the bins of each container, and
    the bins that break each of the three limits (none, unless the packer is wrong). A bin of one piece may exceed the attention cost."""
    caps = F.create_map(*[F.lit(x) for k, v in containers.items() for x in (k, float(max(1, int(v))))])
    bins = packed.groupBy("container", "shard", "bin").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("c"), F.sum(F.col("tokens") * F.col("tokens")).alias("a"))
    cap = caps[F.col("container")]
    return bins.groupBy("container").agg(
        F.sum("t").alias("tokens"), F.sum("c").alias("pieces"), F.count_if(F.col("t") > cap).alias("over_tokens"), F.count_if(F.col("c") > most_items).alias("over_items"),
        F.count_if((F.col("c") > 1) & (F.col("a") > F.lit(attention) * cap * cap)).alias("over_attention"),
    )
