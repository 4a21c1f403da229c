"""Copies hidden by formatting: Bloom filters of once- and repeatedly-seen canonical hashes, then exact grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.llm.canonical import digests
from codequarry.session import Scratch, hot_keys, salted_join

SEGMENT = 1 << 16  # slots in a segment of a filter
FILLING_TASKS = 4096  # tasks that fill filters: as many parts of 16 KB at most are merged to a segment
MOST_SLOTS = 1 << 27  # slots of one filter, 16 MB of bits; more rows have more filters


def _pack(bits: np.ndarray) -> bytes:
    """A segment's bits as sorted 16-bit places where few are set, as they are else: never over 8 KB, and small where it is
    sparse. The lowest bit of a byte is its first slot."""
    if np.bitwise_count(bits).sum() < SEGMENT // 16 - 1:
        return np.flatnonzero(np.unpackbits(bits, bitorder="little")).astype("<u2").tobytes()
    return bits.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if len(data) == SEGMENT // 8:
        return np.frombuffer(data, np.uint8)
    places = np.frombuffer(data, "<u2")
    flags = np.zeros(SEGMENT, bool)
    flags[places] = True
    return np.packbits(flags, bitorder="little")


def _slots(digest: pd.Series, bits: int) -> np.ndarray:
    """Two slots for each 128-bit digest: shape (n, 2)."""
    words = np.frombuffer(b"".join(digest), "<u8").reshape(-1, 2)
    return (words & np.uint64(bits - 1)).astype(np.int64)


class Filling:
    """The slots that a task has seen once and again, a bit each."""

    def __init__(self, bits: int):
        self.once, self.again = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)

    def add(self, slots: np.ndarray) -> None:
        s, n = np.unique(slots, return_counts=True)
        if not len(s):
            return
        at, bit = s >> 3, np.uint8(1) << (s & 7).astype(np.uint8)
        twice = np.where((n > 1) | ((self.once[at] & bit) > 0), bit, np.uint8(0))
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.once[at[first]] |= np.bitwise_or.reduceat(bit, first)
        self.again[at[first]] |= np.bitwise_or.reduceat(twice, first)

    def segments(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(segment, once, again) of the segments that were touched."""
        size = SEGMENT >> 3
        for g in np.flatnonzero(self.once.reshape(-1, min(size, len(self.once))).any(axis=1)):
            yield int(g), _pack(self.once[g * size : (g + 1) * size]), _pack(self.again[g * size : (g + 1) * size])


def merged(parts: Iterator[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The slots of a segment seen at all and seen again, from what the tasks saw of it."""
    once, again = np.zeros(SEGMENT >> 3, np.uint8), np.zeros(SEGMENT >> 3, np.uint8)
    for o, a in parts:
        o = _unpack(o)
        again |= _unpack(a) | (once & o)
        once |= o
    return once, again


def slot_filter(keys: DataFrame, bits: int, repeated: bool) -> np.ndarray:
    """The merged filter of slots hit at all, or hit at least twice, as bits; keys has a column digest of 16 bytes.

    Each task fills a filter of slots seen once and one of slots seen again from its own rows and sends only the
    segments it touched; merging a segment makes a slot repeated that is in two tasks' once filters or in any repeated
    one. What comes to the driver and is sent to the executors is bits / 8 bytes, whatever the input.
    """

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Filling(bits)
        for pdf in batches:
            if len(pdf):
                seen.add(_slots(pdf["digest"], bits).ravel())
        for g, once, again in seen.segments():
            yield pd.DataFrame({"segment": [g], "once": [once], "again": [again]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        once, again = merged(zip(pdf["once"], pdf["again"]))
        return pd.DataFrame({"segment": [pdf["segment"].iloc[0]], "bits": [_pack(again if repeated else once)]})

    parts = keys.select("digest").coalesce(FILLING_TASKS).mapInPandas(fill, "segment int, once binary, again binary")
    found = parts.groupBy("segment").applyInPandas(merge, "segment int, bits binary").collect()  # at most bits / 8 bytes
    out = np.zeros(bits >> 3, np.uint8)
    for r in found:
        out[r["segment"] * (SEGMENT >> 3) : (r["segment"] + 1) * (SEGMENT >> 3)] = _unpack(bytes(r["bits"]))
    return out


def in_filter(flags: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether all slots of each row are set."""
    return ((flags[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).all(axis=1)


def may_hold(spark, flags: np.ndarray, bits: int):
    """A column function: whether the filter may hold a 16-byte digest."""
    shared = spark.sparkContext.broadcast(flags)

    @F.pandas_udf("boolean")
    def maybe(d: pd.Series) -> pd.Series:
        return pd.Series(in_filter(shared.value, _slots(d, bits)) if len(d) else [], dtype=bool)

    maybe.shared = shared
    return maybe


def filter_bits(rows: int, most: int = MOST_SLOTS) -> int:
    """Slots of the filters: 16 a row, a power of two."""
    return min(most, max(1 << 20, 1 << (max(1, 16 * rows) - 1).bit_length()))


def possible_repeats(digested: DataFrame, rows: int, scratch: Scratch, most: int = MOST_SLOTS) -> DataFrame:
    """digested, written, with a column maybe: whether its digest may come again. rows is an upper bound of its rows.

    A digest has one part of as many as keep every part's filter below `most` slots at 16 slots a row. The rows are
    written by part, each part is marked by a filter of its own, so the share of rows that are taken for repeats stays the
    same at any number of rows, and so does the memory of the driver and the tasks: a part's filter is given up before
    the next is filled.
    """
    parts = max(1, -(-16 * rows // most))
    if parts == 1:
        keys = scratch.save(digested)
        bits = filter_bits(rows, most)
        return keys.withColumn("maybe", may_hold(keys.sparkSession, slot_filter(keys, bits, True), bits)("digest"))
    # the part comes from bits that do not choose the slot
    keys = scratch.save(digested.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int")), by="part")
    out = None
    for p in range(parts):
        mine = keys.where(F.col("part") == p).drop("part")
        maybe = may_hold(keys.sparkSession, slot_filter(mine, most, True), most)
        marked = scratch.save(mine.withColumn("maybe", maybe("digest")))
        maybe.shared.destroy()
        out = marked if out is None else out.unionByName(marked)
    return out


def copy_groups(df: DataFrame, ordinal: str, fields: list[str], scratch: Scratch | None = None, most_slots: int = MOST_SLOTS) -> tuple[DataFrame, DataFrame]:
    """(groups, members) of copies.

    groups: field, ordinal (the smallest), copies (1 for a text that stands alone): one record for each distinct text.
    members: field, digest, ordinal_a, ordinal_b: every copy that is not the first of its group, beside the first.
    Null texts and rows without ordinal are left out; texts without a letter or digit are copies of each other. Rows
    that share an ordinal count as copies of one text only if they differ in text (same ordinal and text: copies counted,
    but no member row, as a member differs from its first). An empty table gives no rows.
    """
    spark = df.sparkSession
    scratch = scratch or Scratch(spark)
    total = max(1, df.count() * len(fields))  # from the files' footers
    marked = possible_repeats(digests(df, ordinal, fields), total, scratch, most_slots)
    alone = marked.where("NOT maybe").select("field", "ordinal", F.lit(1).cast("long").alias("copies"))
    again = scratch.save(marked.where("maybe").select(F.struct("field", "digest").alias("key"), "ordinal"))
    firsts = scratch.save(again.groupBy("key").agg(F.min("ordinal").alias("ordinal_a"), F.count(F.lit(1)).alias("copies")))
    groups = alone.unionByName(firsts.select("key.field", F.col("ordinal_a").alias("ordinal"), "copies"))
    many = firsts.where("copies > 1")
    hot = hot_keys(many, "key", "copies", total)
    members = salted_join(again, many.select("key", "ordinal_a"), "key", hot, F.col("ordinal")).where("ordinal <> ordinal_a")
    return groups, members.select("key.field", "key.digest", "ordinal_a", F.col("ordinal").alias("ordinal_b"))
