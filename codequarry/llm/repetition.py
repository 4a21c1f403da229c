"""Repeated content and tokeniser fertility of single documents."""

from __future__ import annotations

import base64
import itertools
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm.words import letter_words

#: The vocabulary that measures fertility: byte-level BPE, as ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's own tokenizer cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


_sent: set[tuple[str, str]] = set()


def send_vocabulary(spark: SparkSession, path: str) -> str:
    """Hands a vocabulary file of the driver's machine to all executors, once a session; its name there."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _sent:
        spark.sparkContext.addFile(path)
        _sent.add(key)
    return os.path.basename(path)


@cache
def _encoding(name: str):
    import tiktoken

    with open(SparkFiles.get(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    partial = np.zeros(max(ranks.values()) + 1, bool)  # tokens that hold only a part of a character
    for piece, i in ranks.items():
        try:
            piece.decode()
        except UnicodeDecodeError:
            partial[i] = True
    return tiktoken.Encoding("fertility", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), partial


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_words(words: np.ndarray, sizes: np.ndarray, run: int) -> np.ndarray:
    """Words of each document that lie in a run of `run` words that occurred before, starting earlier, in the document.

    words: 64-bit hashes of all documents' words, one after another. Two different runs are taken for equal with a chance
    of about words ** 2 / 2 ** 65 within one document.
    """
    n = len(words) - run + 1
    out = np.zeros(len(sizes), np.int64)
    if n < 1:
        return out
    doc = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    h = np.zeros(n, np.uint64)
    for k in range(run):
        h = _mixed(h + words[k : n + k])
    start = np.flatnonzero(doc[:n] == doc[run - 1 :])  # runs within one document
    key = _mixed(h[start] + doc[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(start), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    edge = np.zeros(len(words) + 1, np.int64)
    edge[start[again]] += 1
    np.subtract.at(edge, start[again] + run, 1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=len(sizes))


# Code points of the letters of some scripts beyond ASCII, as ranges of first and last.
SCRIPTS = {
    "Latin": [(0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x2B8), (0x1E00, 0x1EFF)], "Cyrillic": [(0x400, 0x481), (0x48A, 0x52F)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)], "Arabic": [(0x620, 0x64A), (0x66E, 0x66F), (0x671, 0x6D3), (0x6FA, 0x6FC), (0x750, 0x77F)],
}
_NO_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))


def script(text: str) -> str:
    """The script that at least half of a text's letters belong to: Latin, Cyrillic, Han, Arabic or Other; None without letters."""
    latin = len(text.encode("utf-8", "replace").translate(None, _NO_LETTERS))
    if text.isascii():
        return "Latin" if latin else "None"
    far = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    far = far[far > 127]
    known = np.zeros(len(far), bool)
    counts = {}
    for name, ranges in SCRIPTS.items():
        inside = np.zeros(len(far), bool)
        for lo, hi in ranges:
            inside |= (far >= lo) & (far <= hi)
        counts[name] = int(inside.sum()) + (latin if name == "Latin" else 0)
        known |= inside
    code, n = np.unique(far[~known], return_counts=True)
    letters = sum(counts.values()) + sum(int(k) for c, k in zip(code, n) if chr(c).isalpha())
    best = max(counts, key=lambda x: counts[x])
    return "None" if not letters else best if 2 * counts[best] >= letters else "Other"


_MEASURES = [("n_tokens", pa.int64()), ("chars_per_token", pa.float64()), ("byte_share", pa.float64()), ("token_entropy", pa.float64()),
             ("n_words", pa.int64()), ("n_repeated", pa.int64()), ("repeated_share", pa.float64()), ("script", pa.string())]
MEASURES = "n_tokens long, chars_per_token double, byte_share double, token_entropy double, n_words long, n_repeated long, repeated_share double, script string"


def measures(docs: DataFrame, doc_id: str, text: str, carry: list[str] | None = None, run: int = 8, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc, the carried columns, fertility under a public vocabulary, and the repeated share, of every document.

    chars_per_token: characters for each token; byte_share: tokens that hold only part of a character (the byte
    fallback); token_entropy: bits of the document's distribution of tokens; n_words: letter words; n_repeated: those in
    a run of `run` letter words that already occurred, starting earlier; repeated_share: their quotient; script: that of
    the text's letters. Whole texts are measured. Texts without tokens have null fertility, texts without letter words a null share; null texts are left out.
    """
    carry = carry or []
    vocabulary = send_vocabulary(docs.sparkSession, vocabulary)
    use = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc"), *carry, F.col(text).cast("string").alias("_text"))
    k = len(carry) + 1

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(k).to_pylist()
        enc, partial = _encoding(vocabulary)
        toks = [enc.encode_to_numpy(t, disallowed_special=()) for t in texts]
        n_tok = np.array([len(t) for t in toks], np.int64)
        owner = np.repeat(np.arange(len(texts), dtype=np.int64), n_tok)
        flat = np.concatenate(toks).astype(np.int64) if toks else np.empty(0, np.int64)
        byte = np.bincount(owner, weights=partial[flat], minlength=len(texts))
        pair, count = np.unique(owner << 32 | flat, return_counts=True)
        p = count / n_tok[pair >> 32]
        entropy = np.bincount(pair >> 32, weights=-p * np.log2(p), minlength=len(texts))
        words = [letter_words(t) for t in texts]
        n_words = np.array([len(w) for w in words], np.int64)
        hashed = np.fromiter(map(hash, itertools.chain.from_iterable(words)), np.int64, int(n_words.sum())).view(np.uint64)
        rep = repeated_words(hashed, n_words, run)
        chars = np.array([len(t) for t in texts], float)
        some, spoken = n_tok > 0, n_words > 0
        div = lambda a, b, ok: pa.array(np.divide(a, b, out=np.zeros(len(a)), where=ok), mask=~ok)
        cols = [pa.array(n_tok), div(chars, n_tok, some), div(byte, n_tok, some), pa.array(entropy, mask=~some), pa.array(n_words), pa.array(rep), div(rep.astype(float), n_words, spoken), pa.array(map(script, texts), pa.string())]
        fields = [batch.schema.field(i) for i in range(k)] + [pa.field(*m) for m in _MEASURES]
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(k)), *cols], schema=pa.schema(fields))

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                yield work(b.slice(at, 1000))

    schema = T.StructType([*use.drop("_text").schema, *T._parse_datatype_string(MEASURES)])
    return use.mapInArrow(run_, schema)


class _Tokens(dict):
    """Numbers of words, and the vocabulary's tokens of each word behind a blank."""

    def __init__(self, encoding):
        super().__init__()
        self.encode = encoding.encode_ordinary
        self.new: list[list[int]] = []
        self.each, self.flat = np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self)
        self.new.append(self.encode(" " + word.decode()))
        return k

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each word, all their tokens one after another)."""
        if self.new:
            each = np.array([len(t) for t in self.new], np.int64)
            self.each = np.concatenate([self.each, each])
            self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(self.new), np.int64, int(each.sum()))])
            self.new = []
        return self.each, self.flat


def _spent(number: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(different numbers, bits of entropy) of each owner's numbers."""
    pair, count = np.unique(owner << 32 | number, return_counts=True)
    own = pair >> 32
    total = np.maximum(np.bincount(owner, minlength=n), 1)
    p = count / total[own]
    return np.bincount(own, minlength=n), np.bincount(own, weights=-p * np.log2(p), minlength=n)


def run_entropy(token: np.ndarray, begins: np.ndarray, owner: np.ndarray, n_words: np.ndarray, least: float, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(bits of entropy of each document's runs of n tokens that begin with a word, the highest that a repeated share of `least` > 0 leaves).

    token: the tokens of the documents' words, word by word and document by document; begins: whether a token is the first
    of its word; n is half of `run`, down to a power of two. Such a run lies in n words at most. Of a repeated run's words, up
    to the next one's begin, all but the last n - 1 have theirs within it, so that it occurred before: (run - n + 1) / run of all
    repeated words. With R of these, N runs of tokens have at most N - R * (run - n + 1) / run different ones, and the highest entropy
    where all of them are equally frequent, as far as whole numbers allow. Documents without a run of n tokens are outside.
    """
    n = 1 << max(run // 2, 1).bit_length() - 1
    m = max(len(token) - n + 1, 0)
    use = np.flatnonzero(begins[:m] & (owner[:m] == owner[len(owner) - m :]))
    owner = owner[use]
    token, bits, k = token if n > 1 else token[use], int(token.max(initial=1)).bit_length(), 1
    while k < n:  # runs of twice as many tokens; equal runs have one number of at most 32 bits
        token = token[use] << bits | token[use + k] if 2 * k == n else token[:-k] << bits | token[k:]
        if 2 * bits > 32:
            token = np.unique(token, return_inverse=True)[1]
        bits, k = min(2 * bits, 32), 2 * k
    _, entropy = _spent(token, owner, len(n_words))
    total = np.bincount(owner, minlength=len(n_words))
    repeated = np.ceil(least * n_words - 1e-9).astype(np.int64)
    types = np.maximum(total + -repeated * (run - n + 1) // run, 1)
    often, more = np.divmod(np.maximum(total, 1), types)
    spent = (types - more) * often * np.log2(np.maximum(often, 1)) + more * (often + 1) * np.log2(often + 1)
    return entropy, np.where(total > 0, np.log2(np.maximum(total, 1)) - spent / np.maximum(total, 1), -1.0)


def in_bands(number: np.ndarray, n_words: np.ndarray, each: np.ndarray, flat: np.ndarray, least: float, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents inside both bands of `repetitive`, their numbers of tokens, their entropies of runs of tokens).

    number: the documents' words, one after another; each, flat: the words' tokens (see _Tokens.arrays).
    """
    owner = np.repeat(np.arange(len(n_words), dtype=np.int64), n_words)
    n_types, _ = _spent(number, owner, len(n_words))
    near = np.flatnonzero((n_words > 0) & (n_types <= (1 - least) * n_words + 1e-9))
    inside = np.isin(owner, near)
    number, owner = number[inside], np.searchsorted(near, owner[inside])
    long = each[number]
    at = np.cumsum(long) - long
    token = flat[np.repeat((np.cumsum(each) - each)[number] - at, long) + np.arange(int(long.sum()))]
    begins = np.zeros(len(token), bool)
    begins[at] = True
    owner = np.repeat(owner, long)
    entropy, most = run_entropy(token, begins, owner, n_words[near], least, run)
    keep = entropy <= most + 1e-6
    return near[keep], np.bincount(owner, minlength=len(near))[keep], entropy[keep]


REPETITIVE = "doc long, n_words long, n_tokens long, run_entropy double, n_repeated long, repeated_share double"


def repetitive(docs: DataFrame, doc_id: str, text: str, least: float = 0.45, run: int = 8, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc, n_words, n_tokens, run_entropy, n_repeated, repeated_share) of the documents whose repeated share (see measures)
    is at least `least` > 0.

    Two bands, each over what the one before it leaves. With W letter words, a document whose share is s has at most
    (1 - s) * W different words, as the first place of a word is never repeated. The second is one of fertility under a public
    vocabulary: s leaves the entropy of the document's runs of tokens a highest value (see run_entropy). Unlike that of single
    tokens, whose highest value the first band implies, it depends on the order of words. Documents outside a band are rejected, which loses none;
    for the others the exact share is measured. Every letter word is measured, whatever the document's length. Texts without
    letter words, null texts and null ids give no row; rows with one id are documents of their own.
    """
    vocabulary = send_vocabulary(docs.sparkSession, vocabulary)
    use = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("_text"))

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)[0]
        known = _Tokens(encoding)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                if len(known) > 300_000:
                    known = _Tokens(encoding)
                batch = whole.slice(at, 1000)
                words = [letter_words(t) for t in batch.column(1).to_pylist()]
                n_words = np.array([len(w) for w in words], np.int64)
                number = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(n_words.sum()))
                rows, n_tokens, entropy = in_bands(number, n_words, *known.arrays(), least, run)
                if not len(rows):
                    continue
                sizes = n_words[rows]
                number = number[np.isin(np.repeat(np.arange(len(words), dtype=np.int64), n_words), rows)]
                repeated = repeated_words(_mixed(number.astype(np.uint64) + np.uint64(1)), sizes, run)
                ok = repeated >= least * sizes
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows[ok])), pa.array(sizes[ok]), pa.array(n_tokens[ok]), pa.array(entropy[ok]), pa.array(repeated[ok]), pa.array(repeated[ok] / sizes[ok]),
                ], names=["doc", "n_words", "n_tokens", "run_entropy", "n_repeated", "repeated_share"])

    return use.mapInArrow(run_, REPETITIVE)


def bands(measured: DataFrame, group: str, far: float = 3.0) -> DataFrame:
    """(group, c_low, c_high, b_high, e_low): the band of usual fertility of each language or script.

    From `far` times the distance of the quartiles below the lower to as far above the upper one, for chars_per_token from
    both sides, for byte_share from above and for token_entropy from below. So documents are rejected for being far from the rest
    and not because some share has to be: where all are alike none is. The quartiles are exact to one part in 10000, over
    all documents, and combine on the map side. Null groups form one group.
    """
    q = lambda c, p: F.percentile_approx(c, F.lit(p), F.lit(10_000))
    cols = ("chars_per_token", "byte_share", "token_entropy")
    quartiles = measured.groupBy(group).agg(*[q(c, p).alias(f"{c}_{i}") for c in cols for i, p in enumerate((0.25, 0.75))])
    low = lambda c: F.col(f"{c}_0") - far * (F.col(f"{c}_1") - F.col(f"{c}_0"))
    high = lambda c: F.col(f"{c}_1") + far * (F.col(f"{c}_1") - F.col(f"{c}_0"))
    return quartiles.select(group, low("chars_per_token").alias("c_low"), high("chars_per_token").alias("c_high"), high("byte_share").alias("b_high"), low("token_entropy").alias("e_low"))


def rejected(measured: DataFrame, group: str, limits: DataFrame, most_repeated: float = 0.45) -> DataFrame:
    """measured with odd (outside the band of its group) and repetitive (repeated share at least most_repeated).

    limits has one row for each language or script; unknown groups have no band and are never odd.
    """
    both = measured.join(limits.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "left")
    odd = (F.col("chars_per_token") < F.col("c_low")) | (F.col("chars_per_token") > F.col("c_high")) | (F.col("byte_share") > F.col("b_high")) | (F.col("token_entropy") < F.col("e_low"))
    return both.withColumn("odd", F.coalesce(odd, F.lit(False))).withColumn("repetitive", F.coalesce(F.col("repeated_share") >= most_repeated, F.lit(False))).drop("_g", "c_low", "c_high", "b_high", "e_low")
