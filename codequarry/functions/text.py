"""Column functions on source text: lines, comments, preprocessor branches, tokens, diffs, dates."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def line_count(text: Column) -> Column:
    """Lines as split by line feed; an empty text is one line."""
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


_STRINGS = r'"(?:\\.|[^"\\])*"|\'(?:\\.|[^\'\\])*\''


def without_comments(text: Column, block: bool = True, line: bool = True) -> Column:
    """Text without block and line comments; comment marks inside strings and characters stay."""
    kinds = ([r"/\*.*?\*/"] if block else []) + ([r"//[^\n]*"] if line else [])
    return F.regexp_replace(text, rf"(?s)({_STRINGS})|{'|'.join(kinds)}", "$1") if kinds else text


@F.pandas_udf(T.StringType())
def blank_comments(text: pd.Series) -> pd.Series:
    """Comments become blanks of the same length, line feeds stay; strings and characters are respected."""
    pattern = re.compile(rf"({_STRINGS})|//[^\n]*|/\*.*?(?:\*/|\Z)", re.S)
    blank = lambda m: m.group(1) or re.sub(r"[^\n]", " ", m.group(0))
    return text.map(lambda t: None if t is None else pattern.sub(blank, t))


@F.pandas_udf(T.StringType())
def first_branches(text: pd.Series) -> pd.Series:
    """Preprocessor lines, and the branches behind #else and #elif, become empty lines; all other lines keep their place."""

    def one(t):
        if t is None:
            return None
        out, stack, joined = [], [], False
        for line in t.split("\n"):
            mark = re.match(r"\s*#\s*(\w*)", line)
            if joined or mark:
                word = mark.group(1) if mark and not joined else ""
                if word in ("if", "ifdef", "ifndef"):
                    stack.append(True)
                elif word in ("else", "elif") and stack:
                    stack[-1] = False
                elif word == "endif" and stack:
                    stack.pop()
                joined = line.rstrip("\r").endswith("\\")
                out.append("")
            else:
                out.append(line if all(stack) else "")
        return "\n".join(out)

    return text.map(one)


def unified_diff(before: str | None, after: str | None) -> str | None:
    """Unified line diff with three lines of context; '' for equal texts, None if either is missing."""
    if before is None or after is None:
        return None
    return "\n".join(difflib.unified_diff(before.split("\n"), after.split("\n"), "func_before", "func_after", lineterm=""))


_LINES = T.ArrayType(T.StringType())


@F.pandas_udf(T.StructType([T.StructField("diff", T.StringType()), T.StructField("deleted_lines", _LINES), T.StructField("added_lines", _LINES)]))
def diff(before: pd.Series, after: pd.Series) -> pd.DataFrame:
    """The unified diff of two texts and the lines it deletes and adds."""
    rows = []
    for b, a in zip(before, after):
        d = unified_diff(b, a)
        body = [] if not d else d.split("\n")[2:]
        rows.append((d, None if d is None else [x[1:] for x in body if x[:1] == "-"], None if d is None else [x[1:] for x in body if x[:1] == "+"]))
    return pd.DataFrame(rows, columns=["diff", "deleted_lines", "added_lines"])


def text_slice(text: Column, row0: Column, col0: Column, row1: Column, col1: Column) -> Column:
    """The part of a text between two (row, column) points, counted from 0, the end not included."""
    lines = F.slice(F.split(text, "\n"), row0 + 1, row1 - row0 + 1)
    n = F.size(lines)
    cut = F.transform(lines, lambda x, i: F.when((i == 0) & (n == 1), F.substring(x, col0 + 1, col1 - col0)).when(i == 0, F.substring(x, col0 + 1, F.length(x))).when(i == n - 1, F.substring(x, F.lit(1), col1)).otherwise(x))
    return F.array_join(cut, "\n")


# How version-control pages write dates.
DATE_FORMATS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss Z", "EEE, d MMM yyyy HH:mm:ss Z", "EEE MMM d HH:mm:ss yyyy Z"]


def unix_date(text: Column) -> Column:
    """Seconds since 1970 of a date in one of DATE_FORMATS, whichever fits first; null for others."""
    # day names are checked by no reader here, and newer ones refuse them
    plain = F.regexp_replace(F.trim(text), r"^[A-Z][a-z]{2},? ", "")
    tried = [F.try_to_timestamp(plain, F.lit(f.replace("EEE, ", "").replace("EEE ", ""))) for f in DATE_FORMATS]
    return F.unix_timestamp(F.coalesce(*tried))


def year_month(iso: Column) -> tuple[Column, Column]:
    """Year and month of an ISO date-time text, null where it is none."""
    t = F.try_to_timestamp(iso)
    return F.year(t), F.month(t)


@F.pandas_udf(T.StringType())
def nfkd(text: pd.Series) -> pd.Series:
    """Compatibility decomposition."""
    import unicodedata

    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t))


@F.pandas_udf(T.StringType())
def decode_bytes(data: pd.Series) -> pd.Series:
    """Bytes as UTF-8, or as Latin-1 where they are not UTF-8 (which never fails)."""

    def one(b):
        if b is None:
            return None
        try:
            return bytes(b).decode("utf-8")
        except UnicodeDecodeError:
            return bytes(b).decode("latin-1")

    return data.map(one)


def escape_html(text: Column) -> Column:
    """Text for DOT labels: markup characters and line breaks escaped."""
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "<BR/>")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out
