"""Layout-free form of a function's text: the notion of a copy."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Declaration specifiers of C, C++ and Java, in lower case, whose order at the head of a function carries no
# meaning.
SPECIFIERS = "abstract const constexpr consteval constinit default explicit extern final friend inline __inline __inline__ native private protected public register static strictfp synchronized thread_local transient typedef virtual volatile _noreturn _thread_local __always_inline noinline".split()

_HEAD = re.compile(r"((?:\s+|//[^\n]*|/\*.*?\*/)*)((?:(?:" + "|".join(SPECIFIERS) + r")\b\s*){2,})", re.S)
_NAMED = re.compile(r"\{\s*(?:(?://[^\n]*|/\*.*?\*/)\s*)*\.\s*\w+\s*=", re.S)
_SCAN = re.compile(r"""("(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|//[^\n]*|/\*.*?\*/)|([{}()\[\],])""", re.S)
_MEMBER = re.compile(r"\s*(?:(?://[^\n]*|/\*.*?\*/)\s*)*\.\s*\w+\s*=", re.S)
_DROP = bytes(b for b in range(128) if not chr(b).isalnum())


def letters_digits(text: str) -> bytes:
    low = text.lower()
    if low.isascii():
        return low.encode().translate(None, _DROP)
    return "".join(ch for ch in low if ch.isalnum()).encode("utf-8", "replace")


def _ordered(text: str) -> str:
    """text with the named members of every braced initialiser, nested ones too, in a fixed order. A list that is not
    closed leaves the text behind its brace as it is."""
    open_: list[tuple[list[str], list[str] | None, int, int]] = []
    out: list[str] = []
    parts: list[str] | None = None  # the members of the innermost open initialiser
    depth, at, pos = 0, 0, 0
    while m := _SCAN.search(text, pos):
        pos = m.end()
        c = m.group(2)
        if c is None:
            continue
        if c == "{" and _NAMED.match(text, m.start()):
            out.append(text[at : m.start()])
            open_.append((out, parts, depth, m.start()))
            out, parts, depth, at = [], [], 0, pos
        elif parts is None:
            continue
        elif c in "{([":
            depth += 1
        elif c in "])" or (c == "}" and depth):
            depth = max(0, depth - 1)
        elif c == "}" or (c == "," and not depth):
            parts.append("".join(out) + text[at : m.start()])
            out, at = [], pos
            if c == "}":
                members = parts[:-1] if parts[-1].strip() == "" else parts
                if members and all(_MEMBER.match(p) for p in members):
                    members.sort(key=letters_digits)
                out, parts, depth, _ = open_.pop()
                out.append("{" + ",".join(members) + "}")
    if open_:
        out, _, _, at = open_[0]
    return "".join(out) + text[at:]


def canonical(text: str) -> bytes:
    """Letters and digits, lower-cased, after leading specifiers and named members of braced initialisers are put in a
    fixed order. Case is folded first, so that a specifier in capitals is one too. Strings and comments count as they
    are written."""
    text = text.lower()
    if (m := _HEAD.match(text)) is not None:
        text = m.group(1) + " ".join(sorted(m.group(2).split())) + " " + text[m.end() :]
    if "{" in text and _NAMED.search(text):
        text = _ordered(text)
    return letters_digits(text)


def digest(text: str) -> bytes:
    """128 bits of the canonical form: among 10**11 forms two collide with a chance below 10**-16."""
    return hashlib.blake2b(canonical(text), digest_size=16).digest()


def digests(df: DataFrame, ordinal: str, fields: list[str]) -> DataFrame:
    """(field, ordinal, digest) of every non-null text of some fields, from one pass over the rows."""
    schema = pa.schema([("field", pa.string()), ("ordinal", pa.int64()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            for k, field in enumerate(fields):
                rows = [(i, digest(t)) for i, t in zip(ids, b.column(k + 1).to_pylist()) if t is not None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([field] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=schema
                )

    cols = [F.col(ordinal).cast("long").alias("ordinal"), *[F.col(f).cast("string").alias(f"t{k}") for k, f in enumerate(fields)]]
    return df.where(F.col(ordinal).isNotNull()).select(*cols).mapInArrow(run, "field string, ordinal long, digest binary")
