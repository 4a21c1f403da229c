"""Tokens of a text: letter words and word-punctuation tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of UTF-8 text with ASCII letters lower-cased and all else blank: translate and split give the letter words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(256))

def letter_words(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters, lower-cased."""
    return text.encode("utf-8", "replace").translate(LETTERS).split()


_CLASS = np.full(256, 2, np.uint8)  # 0 blank, 1 word, 2 other
_CLASS[[*range(9, 14), *range(28, 33)]] = 0
_CLASS[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = 1

# The blank characters of Unicode beyond ASCII.
BLANKS = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte of UTF-8 text; all bytes of a blank are blank, those of other characters are other."""
    kind = _CLASS[data]
    if len(data) and data.max() > 127:
        for c in BLANKS:
            code = chr(c).encode()
            at = np.flatnonzero(data[: len(data) - len(code) + 1] == code[0])
            for k in range(1, len(code)):
                at = at[data[at + k] == code[k]]
            for k in range(len(code)):
                kind[at + k] = 0
    return kind


def token_counts(texts: pa.Array) -> np.ndarray:
    """Number of word-punctuation tokens of each text, 0 for null: maximal runs of ASCII letters, digits and _, or of other
    non-blank characters. Counts the places where a run begins in the texts' bytes, without making strings."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    kind = _classes(data)
    begins = kind != 0
    begins[1:] &= kind[1:] != kind[:-1]
    first = offsets[:-1] - offsets[0]
    inside = first[first < len(data)]
    begins[inside] = kind[inside] != 0  # a text's first run begins with the text
    total = np.concatenate([[0], np.cumsum(begins)])
    return total[offsets[1:] - offsets[0]] - total[first]


def with_token_counts(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, n) of every document with an id and a text."""
    use = docs.where(F.col(id_).isNotNull() & F.col(text).isNotNull()).select(F.col(id_), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(token_counts(b.column(1)))], names=[b.schema.names[0], "n"])

    return use.mapInArrow(run, T.StructType([use.schema[0], T.StructField("n", T.LongType())]))
