"""Evaluation passages inside training documents, by suffix arrays of the training text."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.llm.words import letter_words
from codequarry.session import Scratch

#: Most characters of evaluation passages that are held and sent to the executors at a time; more are searched in several passes.
PASS_CHARS = 64_000_000
#: Characters of a shard, which has a suffix array of its own; a longer document is a shard by itself.
SHARD_CHARS = 8_000_000


def numbered(texts: list[str], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, text, end): the texts' word numbers with 0 behind each, each place's text and where that text ends. Words
    that are new get the next numbers of the vocabulary, so words compare as their numbers do."""
    words = [letter_words(t) for t in texts]
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    number = vocabulary.setdefault
    parts = []
    for w in words:
        parts.append(np.fromiter((number(x, len(vocabulary) + 1) for x in w), np.int64, len(w)))
        parts.append(np.zeros(1, np.int64))
    of = np.repeat(np.arange(len(texts)), sizes)
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)), of, np.repeat(np.cumsum(sizes) - 1, sizes)


def suffix_array(text: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The places of all words in the order of the suffixes that begin there, each up to the end of its text.

    Prefix doubling: suffixes ordered by their first k words are ordered by 2k by the rank of what follows the first k.
    Only those that are still equal and have not ended go on, so the work beyond the first rounds is that of repeated
    text. Suffixes that are equal to their ends stay in the order of their places.
    """
    order = np.flatnonzero(text > 0)
    order = order[np.argsort(text[order], kind="stable")]
    rank = np.zeros(len(text), np.int64)
    if not len(order):
        return order

    def regroup(at: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first of its group, size of its group) for the places `at` of the order; new says where a group begins."""
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        return np.repeat(at[first], size), np.repeat(size, size)

    word = text[order]
    live = np.arange(len(order))
    start, size = regroup(live, np.concatenate([[True], word[1:] != word[:-1]]))
    rank[order] = start + 1
    live, k = live[size > 1], 1
    while len(live):
        p = order[live]
        then = p + k
        follow = np.where(then < end[p], rank[np.minimum(then, len(text) - 1)], 0)
        key = rank[p] * (len(text) + 2) + follow
        by = np.argsort(key, kind="stable")
        order[live] = p[by]
        key, follow = key[by], follow[by]
        start, size = regroup(live, np.concatenate([[True], key[1:] != key[:-1]]))
        rank[order[live]] = start + 1
        live, k = live[(size > 1) & (follow > 0)], 2 * k
    return order


def _compare(text: np.ndarray, a: np.ndarray, test: np.ndarray, b: np.ndarray, words: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(sign, length): how text from a on compares to test from b on, by at most so many words, and the words they share."""
    sign, length = np.zeros(len(a), np.int8), np.zeros(len(a), np.int64)
    live, j = np.arange(len(a)), 0
    while len(live) and (words is None or j < words):
        x, y = text[a[live] + j], test[b[live] + j]
        sign[live] = np.sign(x - y)
        live = live[(x == y) & (x > 0)]
        j += 1
        length[live] = j
    return sign, length


def _bound(text: np.ndarray, order: np.ndarray, test: np.ndarray, b: np.ndarray, words: int | None, upper: bool, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
    """The place in a suffix array before which all suffixes are less than (upper: not greater than) those of test at b."""
    lo = np.zeros(len(b), np.int64) if lo is None else lo.copy()
    hi = np.full(len(b), len(order), np.int64) if hi is None else hi.copy()
    while len(live := np.flatnonzero(lo < hi)):
        mid = (lo[live] + hi[live]) // 2
        sign = _compare(text, order[mid], test, b[live], words)[0]
        right = sign <= 0 if upper else sign < 0
        lo[live[right]], hi[live[~right]] = mid[right] + 1, mid[~right]
    return lo


class Passages:
    """The evaluation passages as word numbers, their suffixes of n words or more and the distinct runs of n words."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.n, self.ids = n, np.array([i for i, _ in items], np.int64)
        self.vocabulary: dict[bytes, int] = {}
        self.text, self.item, end = numbered([t for _, t in items], self.vocabulary)
        at = np.flatnonzero(np.arange(len(self.text)) + n <= end)
        runs = np.stack([self.text[at + k] for k in range(n)], axis=1) if len(at) else np.empty((0, n), np.int64)
        _, first, run = np.unique(runs, axis=0, return_index=True, return_inverse=True)
        order = np.argsort(self.item[at], kind="stable")
        self.at, self.run = at[order], run.ravel()[order]  # suffixes, an item's together
        self.first = at[first]  # a place of each run
        self.edges = np.searchsorted(self.item[self.at], np.arange(len(items) + 1))
        # distinct (run, item), by run
        pairs = np.unique(np.stack([self.run, self.item[self.at]], axis=1), axis=0) if len(at) else np.empty((0, 2), np.int64)
        self.run_of, self.item_of = pairs[:, 0], pairs[:, 1]
        self.distinct = np.bincount(self.item_of, minlength=len(items))


def _spread(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value): start, start + 1, ... for so many of each."""
    owner = np.repeat(np.arange(len(start)), count)
    return owner, start[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


_OUT = pa.schema([("doc", pa.int64()), ("item_id", pa.int64()), ("matched", pa.int32()), ("runs", pa.int32()), ("longest", pa.int32()), ("at_word", pa.int32())])


def _search(test: Passages, ids: list[int], texts: list[str], least: float) -> pa.RecordBatch:
    text, doc, end = numbered(texts, dict(test.vocabulary))
    order = suffix_array(text, end)
    # the suffixes that begin with a run lie between two bounds, found by binary search
    lo = _bound(text, order, test.text, test.first, test.n, False)
    hi = _bound(text, order, test.text, test.first, test.n, True, lo)
    found = np.flatnonzero(hi > lo)
    run, places = _spread(lo[found], (hi - lo)[found])
    hits = np.unique(doc[order[places]] * len(test.first) + found[run])  # distinct (document, run)
    d, r = hits // max(1, len(test.first)), hits % max(1, len(test.first))
    first, last = np.searchsorted(test.run_of, r, "left"), np.searchsorted(test.run_of, r, "right")
    owner, at = _spread(first, last - first)
    pair, count = np.unique(d[owner] * len(test.ids) + test.item_of[at], return_counts=True)
    ok = count >= least * test.distinct[pair % len(test.ids)] - 1e-9
    pair, count = pair[ok], count[ok]
    d, i = pair // len(test.ids), pair % len(test.ids)
    longest, where = np.zeros(len(d), np.int64), np.zeros(len(d), np.int64)
    if len(d):
        # where each suffix of a passage would stand: in a document, the suffixes next to that place match it longest
        some = hi > lo
        t = np.flatnonzero(some[test.run])
        stand = np.zeros(len(test.at), np.int64)
        stand[t] = _bound(text, order, test.text, test.at[t], None, False, lo[test.run[t]], hi[test.run[t]])
        mine = np.flatnonzero(np.isin(doc[order], d))
        mine = mine[np.argsort(doc[order[mine]], kind="stable")]
        key = doc[order[mine]] * (len(order) + 1) + mine
        begins = np.searchsorted(doc, d)
        for part in range(0, len(d), 1000):
            p = np.arange(part, min(part + 1000, len(d)))
            owner, suffix = _spread(test.edges[i[p]], test.edges[i[p] + 1] - test.edges[i[p]])
            keep = some[test.run[suffix]]
            owner, suffix = p[owner[keep]], suffix[keep]
            near = np.searchsorted(key, d[owner] * (len(order) + 1) + stand[suffix])
            for side in (near - 1, near):
                inside = (side >= 0) & (side < len(key))
                o, s, a = owner[inside], suffix[inside], order[mine[side[inside]]]
                same = doc[a] == d[o]
                o, s, a = o[same], s[same], a[same]
                length = _compare(text, a, test.text, test.at[s], None)[1]
                for j in np.lexsort((a, -length, o))[np.concatenate([[True], np.diff(np.sort(o)) > 0])] if len(o) else ():
                    x = o[j]
                    if (length[j], -(a[j] - begins[x])) > (longest[x], -where[x]):
                        longest[x], where[x] = length[j], a[j] - begins[x]
    return pa.RecordBatch.from_arrays([
        pa.array(np.array(ids, np.int64)[d], pa.int64()), pa.array(test.ids[i], pa.int64()), pa.array(count, pa.int32()),
        pa.array(test.distinct[i], pa.int32()), pa.array(longest, pa.int32()), pa.array(where, pa.int32()),
    ], schema=_OUT)


def _groups(rows: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The passages in groups of at most so many characters, one group at a time; a longer passage is one by itself."""
    group: list[tuple[int, str]] = []
    size = 0
    for r in rows.toLocalIterator():
        if group and size + len(r["p"]) > chars:
            yield group
            group, size = [], 0
        group.append((r["i"], r["p"]))
        size += len(r["p"])
    yield group


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, passage: str, n: int = 4, least: float = 0.45, pass_chars: int = PASS_CHARS) -> DataFrame:
    """(doc, item_id, matched, runs, longest, at_word): documents that hold at least `least` of an item's distinct runs of
    n letter words.

    matched and runs count the item's distinct runs that the document holds and all of them; longest is the longest
    verbatim match in words and at_word the place in the document of one such. Documents are gathered to shards of
    about SHARD_CHARS characters, each with a suffix array of its own text; a document lies in one shard as a whole, so
    nothing is shuffled. Every suffix of every passage is searched in every shard. The passages are held and sent
    pass_chars characters at a time; with more than one such group a group's result is written before the next is read, so
    driver and executors hold one. Items of fewer than n words hold no run and leak nowhere; null texts, passages and ids
    are left out.
    """
    spark = docs.sparkSession
    rows = items.where(F.col(item_id).isNotNull() & F.col(passage).isNotNull()).select(F.col(item_id).cast("long").alias("i"), F.col(passage).cast("string").alias("p"))
    use = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def searched(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            test = shared.value
            if not len(test.first):
                return
            ids, texts, size = [], [], 0
            for doc, t in itertools.chain.from_iterable(zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches):
                if texts and size + len(t) > SHARD_CHARS:
                    yield _search(test, ids, texts, least)
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(t)
                size += len(t)
            if texts:
                yield _search(test, ids, texts, least)

        return use.mapInArrow(run, "doc long, item_id long, matched int, runs int, longest int, at_word int")

    groups = _groups(rows, pass_chars)
    out, scratch, group = None, None, next(groups)
    while group is not None:
        following = next(groups, None)
        shared = spark.sparkContext.broadcast(Passages(group, n))
        part = searched(shared)
        if out is not None or following is not None:
            scratch = scratch or Scratch(spark)
            part = scratch.save(part)
            shared.destroy()
        out = part if out is None else out.unionByName(part)
        group = following
    return out


def without_leaks(docs: DataFrame, doc_id: str, found: DataFrame) -> DataFrame:
    """docs without the documents that leaks() found."""
    return docs.join(found.select(F.col("doc").alias("_leaked_doc_")).distinct(), F.col(doc_id) == F.col("_leaked_doc_"), "left_anti")
