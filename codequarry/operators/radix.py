"""Radix selection: the k-th smallest code of every key without sorting or gathering a key's rows.

A code is a list of unsigned 64-bit columns (kept in signed longs), compared as one big-endian byte string. Round by round
two bytes are fixed for every key: rows that agree with the bytes fixed so far are counted by (key, bytes), which combines
on the map side and leaves at most 65536 rows a key, and the bytes in which the running count reaches the rank become the
next of the cutoff. Only rows that agree with it go on to the next round. A key with any share of all rows therefore never
meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.session import Scratch, salted_join


@F.pandas_udf(T.LongType())
def ascending_double(v: pd.Series) -> pd.Series:
    """Doubles as unsigned 64-bit codes in ascending order; null and NaN become the largest code, -0.0 equals 0.0."""
    x = v.to_numpy(dtype="float64", na_value=np.nan) + 0.0
    bits = x.view("uint64")
    code = np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))
    return pd.Series(np.where(np.isnan(x), np.uint64(2**64 - 1), code).view("int64"))


def descending_double(v: Column) -> Column:
    """Largest double first, null and NaN last."""
    return ascending_double(-v.cast("double"))


def ascending_long(v: Column) -> Column:
    """Longs as unsigned codes in ascending order; null becomes the largest code."""
    return F.coalesce(v.cast("long").bitwiseXOR(F.lit(-(2**63))), F.lit(-1).cast("long"))


def not_beyond(codes: Sequence[str]) -> Column:
    """Condition on rows joined with cutoffs(): the code is at most the cutoff."""
    sign = F.lit(-(2**63))
    le = F.lit(True)
    for w in reversed(range(len(codes))):
        a, b = F.col(codes[w]).bitwiseXOR(sign), F.col(f"_p{w}").bitwiseXOR(sign)
        le = (a < b) | ((a == b) & le)
    return le


def _bits(codes: Sequence[str], i: int, width: int) -> Column:
    """width bits of the code from bit i on; they lie in one word."""
    return F.shiftrightunsigned(F.col(codes[i // 64]), 64 - width - i % 64).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _steps(first: Sequence[int]) -> list[tuple[int, int]]:
    """(bit, width) of each round: two bytes at a time, from the first bit of each word that is not the same in all rows."""
    return [(64 * w + b, min(16, 64 - b)) for w, f in enumerate(first) for b in range(f, 64, 16)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def cutoffs(rows: DataFrame, ranks: DataFrame, key: str, codes: Sequence[str], weight: str | None = None, broadcast: bool = False, hot: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """(key, _p0, _p1, ...): the smallest code up to which a key's weights add up to at least its rank.

    rows: key, codes and maybe weight, all not null. ranks: key and _need >= 1, at most the key's total. Leading bytes that all rows share are
    taken from one pass over them; then two bytes are fixed a round, and only the rows that still agree with an
    unfinished cutoff are written for the next, so the rounds after the first read a small part of the rows. Bytes that
    need not be told apart any more (the running count meets the rank exactly) are set to 255. broadcast says that ranks
    has a proven bound; else hot (see hot_keys) names the keys whose rows are dealt over several tasks.
    """
    scratch = scratch or Scratch(rows.sparkSession)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    unsigned = [F.col(c).bitwiseXOR(F.lit(-(2**63))) for c in codes]
    ends = rows.agg(*[F.min(u) for u in unsigned], *[F.max(u) for u in unsigned]).first()
    first, preset = [], []
    for w in range(len(codes)):
        lo, hi = (ends[w] or 0) + (1 << 63), (ends[len(codes) + w] or 0) + (1 << 63)
        shared = 64 - (lo ^ hi).bit_length()
        shared -= shared % 8
        first.append(shared)
        preset.append(_signed(lo >> (64 - shared) << (64 - shared)) if shared else 0)
    cut = ranks.select(key, "_need", *[F.lit(p).cast("long").alias(f"_p{w}") for w, p in enumerate(preset)], F.lit(False).alias("_done"))
    cut = saved = scratch.save(cut)
    by_bits = Window.partitionBy(key).orderBy("_b")
    now, kept = rows, None
    use = [key, *codes, *([weight] if weight else [])]
    rounds = _steps(first)
    for r, (i, width) in enumerate(rounds):
        w, shift = i // 64, 64 - width - i % 64
        left = cut.where(~F.col("_done"))
        met = now if r else now.join(F.broadcast(left.select(key)), key) if broadcast else salted_join(now, left.select(key), key, hot, F.xxhash64(*codes)) if hot is not None else now.join(left.select(key), key)
        hist = met.groupBy(key, _bits(codes, i, width).alias("_b")).agg(n.alias("_n"))
        hist = hist.withColumn("_cum", F.sum("_n").over(by_bits)).join(F.broadcast(left.select(key, "_need")) if broadcast else left.select(key, "_need"), key)
        hit = hist.where((F.col("_cum") >= F.col("_need")) & (F.col("_cum") - F.col("_n") < F.col("_need")))
        hit = hit.select(key, "_b", (F.col("_need") - F.col("_cum") + F.col("_n")).alias("_rest"), (F.col("_cum") == F.col("_need")).alias("_exact"))
        fill = F.when(F.col("_exact"), F.lit((1 << shift) - 1)).otherwise(F.lit(0)).cast("long")
        new = []
        for v in range(len(codes)):
            old = F.col(f"_p{v}")
            if v == w:
                old = old.bitwiseOR(F.shiftleft(F.col("_b").cast("long"), shift)).bitwiseOR(fill)
            elif v > w:
                old = F.when(F.col("_exact"), F.lit(-1).cast("long")).otherwise(old)
            new.append(F.when(F.col("_b").isNull(), F.col(f"_p{v}")).otherwise(old).alias(f"_p{v}"))
        nxt = cut.join(hit, key, "left").select(key, F.coalesce("_rest", "_need").alias("_need"), *new, (F.col("_done") | F.coalesce("_exact", F.lit(False))).alias("_done"), F.col("_b"))
        nxt = scratch.save(nxt)
        scratch.drop(saved)
        saved, cut = nxt, nxt.drop("_b")
        if r + 1 == len(rounds) or cut.where(~F.col("_done")).isEmpty():
            break
        # rows that may still be the cutoff
        on = nxt.where(~F.col("_done")).select(key, F.col("_b").alias("_on"))
        both = now.join(F.broadcast(on), key) if broadcast else salted_join(now, on, key, hot, F.xxhash64(*codes)) if hot is not None else now.join(on, key)
        narrowed = scratch.save(both.where(_bits(codes, i, width) == F.col("_on")).select(*use))
        scratch.drop(kept)
        now = kept = narrowed
    scratch.drop(kept)
    return cut.drop("_need", "_done")
