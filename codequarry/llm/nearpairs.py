"""Near-duplicate pairs by a chosen-path similarity join on word shingles."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.llm.canonical import digest
from codequarry.llm.copies import FILLING_TASKS, SEGMENT, Filling, _pack, _unpack, filter_bits, in_filter, may_hold, merged, slot_filter
from codequarry.operators.components import components
from codequarry.session import Scratch, hot_keys, salted_join

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SKETCH = 256  # bits of the parity sketch


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that scatters them (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b == 95 else 32 for b in range(256))


class _Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, w: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        if len(w) < 64 and len(self) < 500_000:
            self[w] = h
        return h


def shingle_sets(texts: list[str], k: int, words: _Words) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of k words."""
    split = [t.encode("utf-8", "replace").translate(_LOWER).split() for t in texts]
    sizes = [len(w) for w in split]
    flat = np.fromiter((words[w] for ws in split for w in ws), np.uint64, sum(sizes))
    h = np.zeros(max(0, len(flat) - k + 1), np.uint64)
    for i in range(k):
        h = _mix(h + flat[i : len(h) + i])
    out, at = [], 0
    for n in sizes:
        out.append(np.unique(h[at : at + n - k + 1]) if n >= k else np.empty(0, np.uint64))
        at += n
    return out


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets) if len(sets) else np.empty(0, np.uint64), sizes, np.repeat(np.arange(len(sets)), sizes)


def _sketches(flat: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Parity of the tokens in each of 256 cells: two sets differ in at least as many tokens as their sketches in bits."""
    cells = np.bincount(doc * SKETCH + (flat & np.uint64(SKETCH - 1)).astype(np.int64), minlength=n * SKETCH) & 1
    return np.packbits(cells.astype(np.uint8).reshape(n, SKETCH), axis=1).view(np.int64)


def _limits(sizes: np.ndarray, b: float) -> np.ndarray:
    """Sample a token when its hash is below this: once in b * |set|."""
    return np.minimum(1.0, 1.0 / (b * np.maximum(sizes, 1))) * float(2**64 - 2**12)


def _list_array(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


_SETS = "field string, ordinal long, digest binary, rid binary, fno int, n int, s0 long, s1 long, s2 long, s3 long, shingles array<long>"
_SETS_ARROW = pa.schema(
    [("field", pa.string()), ("ordinal", pa.int64()), ("digest", pa.binary()), ("rid", pa.binary()), ("fno", pa.int32()), ("n", pa.int32())]
    + [(f"s{i}", pa.int64()) for i in range(4)] + [("shingles", pa.list_(pa.int64()))]
)


def _whole(text: str) -> np.ndarray:
    """The set of a text that has too few words for a run: one hash of all its words."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    return np.array([int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8, key=b"short").digest(), "little")], np.uint64)


def _prepare(k: int, fields: list[str], short: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for f, field in enumerate(fields):
                for at in range(0, batch.num_rows, 2000):
                    part = batch.slice(at, 2000)
                    rows = [(o, t) for o, t in zip(part.column(0).to_pylist(), part.column(f + 1).to_pylist()) if t is not None]
                    sets = shingle_sets([t for _, t in rows], k, words)
                    if short:
                        sets = [s if len(s) else _whole(t) for s, (_, t) in zip(sets, rows)]
                    keep = [i for i, s in enumerate(sets) if len(s)]
                    if not keep:
                        continue
                    sets = [sets[i] for i in keep]
                    flat, sizes, doc = _flat(sets)
                    sk = _sketches(flat, doc, len(sets))
                    rid = [hashlib.blake2b(s.tobytes(), digest_size=16, key=field.encode()[:64]).digest() for s in sets]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([field] * len(sets), pa.string()), pa.array([rows[i][0] for i in keep], pa.int64()),
                        pa.array([digest(rows[i][1]) for i in keep], pa.binary()), pa.array(rid, pa.binary()),
                        pa.array(np.full(len(sets), f, np.int32)), pa.array(sizes.astype(np.int32)),
                        *[pa.array(np.ascontiguousarray(sk[:, c])) for c in range(4)], _list_array(flat, sizes),
                    ], schema=_SETS_ARROW)

    return run


MOST_SLOTS = 1 << 29  # slots of the filter of paths, 64 MB of bits
COARSE = 1 << 16  # cells of the sketch that finds paths of a great share of all rows


def _count_parts(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Two rows of COARSE counts in parts of 16 KB, numbered from -1 down, so that no task adds up all counts of all tasks."""
    parts = [p.astype("<i8").tobytes() for p in counts.reshape(-1, 2048)]
    return [-1 - k for k in range(len(parts))], parts


def _added(parts) -> bytes:
    return sum(np.frombuffer(x, "<i8") for x in parts).tobytes()


def _counts(rows) -> np.ndarray:
    out = np.zeros((2 * COARSE // 2048, 2048), np.int64)
    for r in rows:
        out[-1 - r["segment"]] = np.frombuffer(bytes(r["bits"]), "<i8")
    return out.reshape(2, COARSE)


class Level:
    """What is known of the paths of one level: slots of repeated paths, cells of hot paths, slots of heavy paths."""

    def __init__(self, bits: int, repeated: np.ndarray | None, hot: np.ndarray, heavy: np.ndarray | None = None):
        self.bits, self.repeated, self.hot, self.heavy = bits, repeated, hot, heavy


def _slots_of(path: np.ndarray, bits: int) -> np.ndarray:
    return np.stack([path, _mix(path ^ _M2)], axis=1).astype(np.uint64) & np.uint64(bits - 1)


def _cells(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (path >> np.uint64(48)).astype(np.int64), (_mix(path + _M1) >> np.uint64(48)).astype(np.int64)


def _is_hot(hot: np.ndarray, path: np.ndarray) -> np.ndarray:
    a, b = _cells(path)
    return hot[0][a] & hot[1][b]


def _walk(flat: np.ndarray, sizes: np.ndarray, doc: np.ndarray, fno: np.ndarray, b: float, seeds: np.ndarray, levels: list[Level]) -> tuple[np.ndarray, np.ndarray]:
    """(path, set) of the level behind the known ones: every path known as heavy or hot goes on with sampled tokens."""
    limit = _limits(sizes, b)[doc]
    salt = _mix(fno.astype(np.uint64))[doc]  # fields never meet in a bucket
    paths, owners = [], []
    for seed in seeds:
        g = _mix(flat ^ seed)
        hit = g < limit
        paths.append(_mix(g[hit] + seed + salt[hit]))
        owners.append(doc[hit])
    path, owner = np.concatenate(paths), np.concatenate(owners)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    limits = _limits(sizes, b)
    for lv in levels:
        on = _is_hot(lv.hot, path)
        if lv.heavy is not None:
            on |= in_filter(lv.heavy, _slots_of(path, lv.bits).astype(np.int64))
        path, owner = path[on], owner[on]
        new, own = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for at in range(0, len(path), 2000):  # so many paths at a time
            p, o = path[at : at + 2000], owner[at : at + 2000]
            lengths = sizes[o]
            rep = np.repeat(np.arange(len(p)), lengths)
            inner = np.arange(len(rep)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            g = _mix(flat[starts[o][rep] + inner] ^ _mix(p)[rep])
            hit = g < limits[o][rep]
            new.append(_mix(g[hit] + p[rep[hit]]))
            own.append(o[rep[hit]])
        path, owner = np.concatenate(new), np.concatenate(own)
    return path, owner


_SETS_USED = "rid binary, fno int, n int, s0 long, s1 long, s2 long, s3 long, shingles array<long>"
_PATHS = "path long, rid binary, n int, s0 long, s1 long, s2 long, s3 long"


def _emit(b: float, seeds: np.ndarray, levels, this=None, part: str = "near"):
    """Path rows of the next level. With what is known of this level: near leaves out paths that one set has and hot
    paths, rest has only heavy and hot paths; without: all. Sets met before in the task are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rid = batch.column(0).to_pylist()
                fresh = []
                for i, r in enumerate(rid):
                    if r not in known:
                        known.add(r)
                        fresh.append(i)
                if len(known) > 500_000:
                    known.clear()
                batch = batch.take(pa.array(fresh, pa.int64()))
                if not batch.num_rows:
                    continue
                lists = batch.column(7)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                fno = batch.column(1).to_numpy()
                path, owner = _walk(flat, sizes, doc, fno, b, seeds, levels.value)
                if this is not None:
                    lv = this.value
                    hot = _is_hot(lv.hot, path)
                    if part == "near":
                        keep = ~hot if lv.repeated is None else ~hot & in_filter(lv.repeated, _slots_of(path, lv.bits).astype(np.int64))
                    else:
                        keep = hot | in_filter(lv.heavy, _slots_of(path, lv.bits).astype(np.int64))
                    path, owner = path[keep], owner[keep]
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), batch.column(0).take(take), *[batch.column(i).take(take) for i in range(2, 7)]], names=_ROW)

    return run


_ROW = ["path", "rid", "n", "s0", "s1", "s2", "s3"]
_OUT = "path long, c long, a binary, b binary"
_OUT_ARROW = pa.schema([("path", pa.int64()), ("c", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])


def _compare(limit: int, num: int, den: int):
    """Rows sorted by path and rid -> (null, null, a, b) for pairs of one bucket that may be similar, and (path, rows, null,
    null) for each bucket of more than limit rows. No pair of at least num / den similarity is left out: sets of n and m
    tokens with that similarity differ in at most (n + m) * (den - num) / (den + num) tokens, and their sketches in no
    more bits."""

    def heavy(paths, counts):
        k = len(paths)
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.int64()), pa.array(counts, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())], schema=_OUT_ARROW)

    def work(rows: pa.Table | pa.RecordBatch):
        path = rows.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(path)]]))
        if (sizes > limit).any():
            yield heavy(path[starts[sizes > limit]], sizes[sizes > limit])
        of_row = np.repeat(sizes, sizes)
        small = np.flatnonzero((of_row <= limit) & (of_row > 1))
        if not len(small):
            return
        rows = rows.take(pa.array(small))
        path, n = path[small], rows.column(2).to_numpy().astype(np.int64)
        sk = np.stack([rows.column(i).to_numpy() for i in range(3, 7)], axis=1).view(np.uint64)
        rid = rows.column(1)
        here, k = np.arange(len(small)), 0
        while len(here):
            k += 1
            here = here[here + k < len(small)]
            here = here[path[here] == path[here + k]]
            for at in range(0, len(here), 1 << 18):
                i = here[at : at + (1 << 18)]
                j = i + k
                lo, hi = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                ok = lo * den >= hi * num
                i, j = i[ok], j[ok]
                if len(i):
                    diff = np.bitwise_count(sk[i] ^ sk[j]).sum(axis=1, dtype=np.int64)
                    ok = diff * (den + num) <= (n[i] + n[j]) * (den - num)
                    if ok.any():
                        i, j = i[ok], j[ok]
                        nothing = pa.nulls(len(i), pa.int64())
                        # rows of a bucket come sorted by rid, so a <= b
                        yield pa.RecordBatch.from_arrays([nothing, nothing, rid.take(pa.array(i)), rid.take(pa.array(j))], schema=_OUT_ARROW)

    def distinct(rows):
        path, rid = rows.column(0), rows.column(1)
        if len(path) < 2:
            return rows
        import pyarrow.compute as pc

        same = pc.and_(pc.equal(path.slice(1), path.slice(0, len(path) - 1)), pc.equal(rid.slice(1), rid.slice(0, len(rid) - 1)))
        return rows.filter(pa.array(np.concatenate([[True], ~same.to_numpy(zero_copy_only=False)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cut, counted = None, None, 0  # a bucket that goes on and is too large already is only counted
        for b in batches:
            rows = pa.Table.from_batches([b])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            rows = distinct(rows.combine_chunks().to_batches()[0] if rows.num_rows else b)
            held = None
            if not rows.num_rows:
                continue
            path = rows.column(0).to_numpy()
            if cut is not None:
                k = int(np.searchsorted(path, cut, side="right"))
                counted += k
                if k == len(path):
                    continue
                yield heavy([cut], [counted])
                cut, rows, path = None, rows.slice(k), path[k:]
            last = int(np.searchsorted(path, path[-1]))
            if last:
                yield from work(rows.slice(0, last))
            rows = rows.slice(last)
            if rows.num_rows > limit:
                cut, counted = int(path[-1]), rows.num_rows
            else:
                held = pa.Table.from_batches([rows])
        if cut is not None:
            yield heavy([cut], [counted])
        if held is not None and held.num_rows:
            yield from work(held.combine_chunks().to_batches()[0])

    return run


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first column was not met before in the task, as far back as the task remembers."""
    known: set[bytes] = set()
    for b in batches:
        fresh = []
        for i, r in enumerate(b.column(0).to_pylist()):
            if r not in known:
                known.add(r)
                fresh.append(i)
        if len(known) > 500_000:
            known.clear()
        yield b.take(pa.array(fresh, pa.int64()))


def _links_to_rows(links: DataFrame, rows: DataFrame, key: str, hot: DataFrame, spread) -> DataFrame:
    """links joined with the rows of a key. A key with very many rows is dealt over several tasks, its links repeated."""
    h = F.broadcast(hot)
    left = rows.join(h, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_ways", F.lit(1))).cast("int")).drop("_ways")
    right = links.join(h, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1))).drop("_ways")
    return left.join(right, [key, "_salt"]).drop("_salt")


def miss(levels: int) -> float:
    """The most that the chance can be that a pair of the threshold's similarity shares no path of `levels` tokens in a
    run: the sampled tokens that it shares below a path are one on average, so its paths branch like a tree of mean 1."""
    q = 0.0
    for _ in range(levels):
        q = math.exp(q - 1)
    return q


def runs_for(recall: float, levels: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(miss(levels)))


class NearPairs:
    """The chosen-path join of the texts of some fields of a table.

    Equal shingle sets are one class, named by a 128-bit hash. Level by level, every set samples tokens with a hash that
    depends on the path so far, once in threshold * |set|, so two sets of that similarity expect to share a sampled token;
    sets with one path form a bucket. Paths that only one set has are dropped before the shuffle by a filter of repeated
    hashes (beyond a 16th of MOST_SLOTS paths more and more of them pass it, at most all: about 2 kB a set). Buckets of
    at most `bucket` sets are compared by brute force on parity sketches that lose no pair; larger ones
    are split by another sampled token. Which paths are too large is told to the next level by a filter of bounded size, so
    the sets themselves are never shuffled; a false hit only costs work. A path of more than hot_rows rows and a
    thousandth of all is not shuffled at all. After `levels` levels the sets that still lie under large paths are joined
    exactly by their rarest tokens (_rest), so that no bucket is ever cut off. The runs for the target recall follow from
    the miss of a run in which all the paths that a pair shares are split down to the last level.
    """

    def __init__(self, df: DataFrame, ordinal: str, fields: list[str], k: int = 5, threshold: float = 0.8, recall: float = 0.9999, bucket: int = 500, levels: int = 2, hot_rows: int = 100_000, short: bool = False, most_slots: int = MOST_SLOTS):
        self.hot_rows, self.most_slots = hot_rows, most_slots
        self.spark = df.sparkSession
        self.scratch = Scratch(self.spark)
        th = Fraction(str(threshold))
        self.num, self.den, self.bucket, self.b = th.numerator, th.denominator, bucket, float(threshold)
        self.runs = runs_for(recall, levels)
        self.seeds = _mix(np.arange(1, self.runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        cols = [F.col(ordinal).cast("long").alias("ordinal"), *[F.col(f).cast("string").alias(f"t{i}") for i, f in enumerate(fields)]]
        rows = df.where(F.col(ordinal).isNotNull()).select(*cols)
        self.sets = self.scratch.save(rows.mapInArrow(_prepare(k, fields, short), _SETS))
        self.total = self.sets.count()
        self.pairs = self._verify(self._join(levels))

    def _paths(self, levels: list[Level], this: Level | None = None, part: str = "near") -> DataFrame:
        share = self.spark.sparkContext.broadcast
        use = self.sets.select("rid", "fno", *_ROW[2:], "shingles")
        return use.mapInArrow(_emit(self.b, self.seeds, share(levels), None if this is None else share(this), part), _PATHS)

    def _survey(self, levels: list[Level], bits: int) -> Level:
        """One pass over the level's paths: slots hit at least twice, and cells whose count only a hot path can reach."""
        b, seeds, known = self.b, self.seeds, self.spark.sparkContext.broadcast(levels)

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, counts = Filling(bits), np.zeros((2, COARSE), np.int64)
            for rows in _emit(b, seeds, known)(batches):
                path = rows.column(0).to_numpy().view(np.uint64)
                seen.add(_slots_of(path, bits).astype(np.int64).ravel())
                for i, c in enumerate(_cells(path)):
                    counts[i] += np.bincount(c, minlength=COARSE)
            for g, once, again in seen.segments():
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([once], pa.binary()), pa.array([again], pa.binary())], names=["segment", "once", "again"])
            ids, parts = _count_parts(counts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([b""] * len(ids), pa.binary()), pa.array(parts, pa.binary())], names=["segment", "once", "again"])

        def merge(pdf):
            import pandas as pd

            g = pdf["segment"].iloc[0]
            return pd.DataFrame({"segment": [g], "bits": [_added(pdf["again"]) if g < 0 else _pack(merged(zip(pdf["once"], pdf["again"]))[1])]})

        use = self.sets.select("rid", "fno", *_ROW[2:], "shingles").coalesce(FILLING_TASKS)
        found = use.mapInArrow(fill, "segment int, once binary, again binary").groupBy("segment").applyInPandas(merge, "segment int, bits binary").collect()
        repeated, counts = np.zeros(bits >> 3, np.uint8), _counts([r for r in found if r["segment"] < 0])
        for r in found:  # at most bits / 8 bytes and 1 MB of counts
            if r["segment"] >= 0:
                repeated[r["segment"] * (SEGMENT >> 3) : (r["segment"] + 1) * (SEGMENT >> 3)] = _unpack(bytes(r["bits"]))
        return Level(bits, repeated, counts > max(self.hot_rows, 0.001 * counts[0].sum()))

    def _compared(self, rows: DataFrame, limit: int) -> DataFrame:
        return rows.repartition("path").sortWithinPartitions("path", "rid").mapInArrow(_compare(limit, self.num, self.den), _OUT)

    def _join(self, most_levels: int) -> DataFrame:
        # a set samples about 1 / b tokens a run
        bits = filter_bits(math.ceil(self.runs / self.b) * self.total, self.most_slots)
        known: list[Level] = []
        pairs, written = None, []
        for level in range(1, most_levels + 1):
            this = self._survey(known, bits)
            out = self.scratch.save(self._compared(self._paths(known, this), self.bucket))
            written.append(out)
            got = out.where("path IS NULL").select("a", "b").distinct()
            pairs = got if pairs is None else pairs.unionByName(got)
            heavy = out.where("path IS NOT NULL").select("path")
            n_heavy = heavy.count()
            if not n_heavy and not this.hot.any():
                break
            this.heavy = _heavy_filter(heavy, bits)
            if level == most_levels:
                rest = self._paths(known, this, "rest").select("rid").distinct()
                pairs = pairs.unionByName(self._rest(self.scratch.save(rest)))
            this.repeated = None  # not needed below
            known.append(this)
        found = self.scratch.save(pairs.distinct())
        self.scratch.drop(*written)
        return found

    def _commonness(self) -> np.ndarray:
        """Counts of the tokens of all sets in two rows of COARSE cells, 1 MB whatever the input: a token's lesser cell is at
        least the number of sets that hold it."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((2, COARSE), np.int64)
            for b in batches:
                flat = b.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                for i, c in enumerate(_cells(_mix(flat))):
                    counts[i] += np.bincount(c, minlength=COARSE)
            ids, parts = _count_parts(counts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(parts, pa.binary())], names=["segment", "bits"])

        def add(pdf):
            import pandas as pd

            return pd.DataFrame({"segment": [pdf["segment"].iloc[0]], "bits": [_added(pdf["bits"])]})

        parts = self.sets.select("shingles").coalesce(FILLING_TASKS).mapInArrow(count, "segment int, bits binary")
        return _counts(parts.groupBy("segment").applyInPandas(add, "segment int, bits binary").collect())

    def _rest(self, rids: DataFrame) -> DataFrame:
        """Pairs among the sets that still lie under a heavy or hot path, exactly. Two sets of similarity t share one of the first
        n - ceil(t * n) + 1 tokens of each in any one order of all tokens; with the rare tokens first, what very many
        sets have in common, such as a licence or a frame that is generated, brings no sets together, however many they
        are. Buckets that are large even so hold sets of which most of the text is common; they are compared in blocks."""
        share = self.spark.sparkContext.broadcast(self._commonness())
        num, den = self.num, self.den

        def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 1000):
                    batch = whole.slice(at, 1000)
                    lists = batch.column(7)
                    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    doc = np.repeat(np.arange(len(sizes)), sizes)
                    a, b = _cells(_mix(flat))
                    often = np.minimum(share.value[0][a], share.value[1][b])
                    order = np.lexsort((flat, often, doc))
                    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    keep = place < (sizes + (-sizes * num) // den + 1)[doc]
                    chosen, own = flat[order[keep]], doc[keep]
                    path = _mix(chosen ^ _mix(batch.column(1).to_numpy().astype(np.uint64))[own])
                    take = pa.array(own)
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), batch.column(0).take(take), *[batch.column(i).take(take) for i in range(2, 7)]], names=_ROW)

        bits = filter_bits(self.total, 1 << 24)
        maybe = may_hold(self.spark, slot_filter(rids.select(F.col("rid").alias("digest")), bits, False), bits)
        # sets that the filter lets through by mistake only cost work
        use = self.sets.select("rid", "fno", *_ROW[2:], "shingles").where(maybe("rid")).mapInArrow(_first_seen, _SETS_USED)
        rows = self.scratch.save(use.mapInArrow(prefix, _PATHS))
        out = self.scratch.save(self._compared(rows, self.bucket))
        large = out.where("path IS NOT NULL").select("path").distinct()
        pairs = out.where("path IS NULL").select("a", "b")
        return (pairs if large.isEmpty() else pairs.unionByName(self._blocks(rows, large))).distinct()

    def _blocks(self, rows: DataFrame, large: DataFrame) -> DataFrame:
        """All pairs of the buckets of some paths, block by block."""
        bits = filter_bits(self.total, 1 << 24)
        heavy = _heavy_filter(large, bits)
        share = self.spark.sparkContext.broadcast(heavy)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                slots = _slots_of(b.column(0).to_numpy().view(np.uint64), bits).astype(np.int64)
                yield b.filter(pa.array(in_filter(share.value, slots)))

        rows = self.scratch.save(rows.mapInArrow(run, _PATHS).distinct())
        ways = rows.groupBy("path").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > self.bucket)
        ways = self.scratch.save(ways.select("path", F.ceil(F.col("c") / F.lit(self.bucket)).cast("int").alias("ways"), "c"))
        hot = hot_keys(ways, "path", "c", max(1, self.total))
        both = salted_join(rows, ways.select("path", "ways"), "path", hot, F.col("rid"))
        both = both.withColumn("x", F.pmod(F.xxhash64("rid"), F.col("ways")).cast("int")).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
        both = both.withColumn("path", F.xxhash64("path", F.least("x", "y"), F.greatest("x", "y"))).select(*_ROW)
        return self._compared(both, 2**31 - 1).select("a", "b")

    def _among(self, rids: DataFrame, cols: list[str]) -> DataFrame:
        """Rows of self.sets whose rid may be among some: most others are left out by a filter before any shuffle."""
        bits = filter_bits(self.total, 1 << 24)
        maybe = may_hold(self.spark, slot_filter(rids.select(F.col("rid").alias("digest")), bits, False), bits)
        return self.sets.select("rid", *cols).where(maybe("rid"))

    def _one_each(self, rids: DataFrame) -> DataFrame:
        """(rid, n, shingles) once for each rid: repeats go within the tasks first, so a class of any size is no burden."""
        rows = self._among(rids, ["n", "shingles"]).mapInArrow(_first_seen, "rid binary, n int, shingles array<long>")
        return rows.groupBy("rid").agg(F.any_value("n").alias("n"), F.any_value("shingles").alias("shingles")).join(rids.select("rid"), "rid", "left_semi")

    def _verify(self, pairs: DataFrame) -> DataFrame:
        """(a, b, common, union) of the class pairs that reach the threshold."""
        save = self.scratch.save
        ends = pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid")))
        need = save(ends.groupBy("rid").agg(F.count(F.lit(1)).alias("c")))
        hot = hot_keys(need, "rid", "c", max(1, pairs.count()))
        side = save(self._one_each(need))
        at = lambda x: (side.select(F.col("rid").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"t_{x}")), hot.withColumnRenamed("rid", x))
        (sa, ha), (sb, hb) = at("a"), at("b")
        both = salted_join(salted_join(pairs, sa, "a", ha, F.col("b")), sb, "b", hb, F.col("a"))
        both = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("t_a", "t_b")).alias("common"))
        both = both.withColumn("union", F.col("n_a") + F.col("n_b") - F.col("common"))
        out = save(both.where(F.col("common") * self.den >= F.col("union") * self.num).select("a", "b", "common", "union"))
        self.scratch.drop(side, need, pairs)
        return out

    def row_pairs(self) -> DataFrame:
        """(field, ordinal_a, ordinal_b): all pairs of rows that reach the threshold and differ in their canonical form."""
        save = self.scratch.save
        per = save(self.sets.groupBy("rid").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.count(F.lit(1)).alias("c")))
        hot = hot_keys(per, "rid", "c", max(1, self.total))
        ends = self.pairs.select(F.explode(F.array("a", "b")).alias("rid"))
        touched = save(ends.unionByName(per.where("lo <> hi").select("rid")).distinct())
        rows = save(salted_join(self._among(touched, ["field", "ordinal", "digest"]), touched, "rid", hot, F.col("ordinal")))
        kinds = save(rows.groupBy("field", "rid", "digest").agg(F.count(F.lit(1)).alias("c")))
        a = kinds.select(F.col("rid").alias("a"), F.col("digest").alias("da"), "field")
        b = kinds.select(F.col("rid").alias("b"), F.col("digest").alias("db"))
        across = self.pairs.select("a", "b").join(a, "a").join(b, "b").where("da <> db")
        within = a.join(b, (F.col("a") == F.col("b")) & (F.col("da") < F.col("db")))
        cols = ["field", F.struct(F.col("a").alias("rid"), F.col("da").alias("digest")).alias("ka"), F.struct(F.col("b").alias("rid"), F.col("db").alias("digest")).alias("kb")]
        links = save(across.select(*cols).unionByName(within.select(*cols)))
        # each link meets the rows of both its sides; what one side brings is dealt out before it meets the other
        many = lambda k: hot_keys(kinds.select(F.struct("rid", "digest").alias(k), "c"), k, "c", max(1, self.total))
        side = lambda k, o: rows.select(F.struct("rid", "digest").alias(k), F.col("ordinal").alias(o))
        first = _links_to_rows(links, side("ka", "oa"), "ka", many("ka"), F.col("oa"))
        out = _links_to_rows(first, side("kb", "ob"), "kb", many("kb"), F.col("ob")).where("oa <> ob")
        return out.select("field", F.least("oa", "ob").alias("ordinal_a"), F.greatest("oa", "ob").alias("ordinal_b"))


def near_groups(df: DataFrame, ordinal: str, fields: list[str], k: int = 5, threshold: float = 0.8, **kw) -> DataFrame:
    """(field, ordinal, group_id, n_links): one row for each text of at least k words: its group, the texts that similar
    pairs tie together directly or through others, and the number of other different texts that it is similar to. Equal
    texts are one to the links and share their group, so copies are not expanded into pairs. With short, texts of fewer
    words have a row too, in the group of those with the same words."""
    n = NearPairs(df, ordinal, fields, k, threshold, **kw)
    links = n.scratch.save(n.pairs.select("a", "b").unionByName(n.pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.count(F.lit(1)).alias("n_links")))
    group = components(n.pairs.select("a", "b"), n.scratch)
    known = n.scratch.save(links.join(group, F.col("a") == F.col("node")).select(F.col("a").alias("rid"), "component", "n_links"))
    counts = n.sets.groupBy("rid").agg(F.count(F.lit(1)).alias("c"))
    rows = salted_join(n.sets.select("field", "ordinal", "rid"), known, "rid", hot_keys(counts, "rid", "c", max(1, n.total)), F.col("ordinal"), "left")
    return rows.select("field", "ordinal", F.lower(F.hex(F.coalesce("component", "rid"))).alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _heavy_filter(paths: DataFrame, bits: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = np.ascontiguousarray(_slots_of(b.column(0).to_numpy().view(np.uint64), 1 << 63).astype("<u8"))
            yield pa.RecordBatch.from_arrays([pa.array([w.tobytes() for w in words], pa.binary())], names=["digest"])

    return slot_filter(paths.mapInArrow(run, "digest binary"), bits, False)


def near_pairs(df: DataFrame, ordinal: str, fields: list[str], k: int = 5, threshold: float = 0.8, **kw) -> DataFrame:
    """(field, ordinal_a, ordinal_b): pairs of rows whose texts share at least threshold of all their distinct runs of k
    words, and that are not mere copies in layout. Null texts and texts of fewer than k words have no pairs; an empty
    table gives no rows. Other columns of df play no part."""
    return NearPairs(df, ordinal, fields, k, threshold, **kw).row_pairs()
