"""Functions out of source files, and source text with its names replaced by symbols; by tokens, without a full parser."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPES = ["VAR", "FUNC", "TYPE", "NUMBER", "FIELD", "STR", "CHAR", "COMMENT", "LABEL", "ANNOTATION"]
#: What is replaced where nothing else is asked for.
DEFAULT = {t: t in ("VAR", "FUNC", "TYPE", "FIELD", "STR", "CHAR", "COMMENT", "LABEL") for t in TYPES}

_TOKEN = re.compile(
    r"(?P<COMMENT>//[^\n]*|/\*.*?\*/)|(?P<STR>(?:u8|[uUL])?\"(?:\\.|[^\"\\\n])*\")|(?P<CHAR>'(?:\\.|[^'\\\n])+')|(?P<NUMBER>\.?\d(?:[eEpP][+-]|[\w.])*)|(?P<DIRECTIVE>^[ \t]*\#[^\n]*)"
    r"|(?P<ANNOTATION>@[A-Za-z_]\w*)|(?P<WORD>[A-Za-z_$]\w*)|(?P<OP>->|::|&&|\|\||[<>=!+\-*/%&|^]=|\S)", re.S | re.M)  # fmt: skip

# Words that are no names, and words that are types.
KEYWORDS = frozenset("auto break case catch class const constexpr continue default delete do else enum extern final finally for friend goto if implements import inline instanceof interface namespace native new noexcept nullptr null operator override package private protected public register return sizeof static struct super switch synchronized template this throw throws transient true false try typedef typename union using virtual volatile while abstract assert extends NULL".split())
PRIMITIVES = frozenset("void char short int long float double signed unsigned bool boolean byte size_t ssize_t wchar_t u8 u16 u32 u64 s8 s16 s32 s64 int8_t int16_t int32_t int64_t uint8_t uint16_t uint32_t uint64_t".split())


def classified(code: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, text) of the tokens that have a type, by what stands around them. The function's own name has none."""
    toks = [(m.start(), m.end(), m.lastgroup, m.group()) for m in _TOKEN.finditer(code)]
    real = [i for i, t in enumerate(toks) if t[2] not in ("COMMENT", "DIRECTIVE")]
    place = {i: k for k, i in enumerate(real)}
    at = lambda k: toks[real[k]] if 0 <= k < len(real) else (0, 0, "OP", "")
    depth, own, out, types = 0, None, [], set()
    for i, (a, b, kind, text) in enumerate(toks):
        if kind == "DIRECTIVE":
            continue
        if kind in ("COMMENT", "STR", "CHAR", "NUMBER", "ANNOTATION"):
            out.append((a, b, kind, text))
            continue
        if kind == "OP":
            depth += (text == "{") - (text == "}")
            continue
        if text in KEYWORDS:
            continue
        k = place[i]
        before, after, next2 = at(k - 1)[3], at(k + 1)[3], at(k + 2)
        if depth == 0 and own is None and after == "(":
            own = text
            continue
        if depth == 0 and own is None and after == "::":
            continue
        if text in PRIMITIVES or before in ("struct", "union", "enum", "class", "new"):
            t = "TYPE"
        elif before in (".", "->"):
            t = "FUNC" if after == "(" else "FIELD"
        elif after == "(":
            t = "FUNC"
        elif before == "goto" or (after == ":" and before in (";", "{", "}") and next2[3] != ":"):
            t = "LABEL"
        elif text in types or at(k + 1)[2] == "WORD" and after not in KEYWORDS or (after in ("*", "&") and next2[2] == "WORD" and before in (";", "{", "}", "(", ",", "const", "static", "")):
            t = "TYPE"
        else:
            t = "VAR"
        if t == "TYPE":
            types.add(text)
        out.append((a, b, t, text))
    return out


def symbols(code: str) -> dict[str, dict[str, str]]:
    """type -> text -> symbol: numbered by first occurrence within each type."""
    table: dict[str, dict[str, str]] = {}
    for _, _, t, text in classified(code):
        mine = table.setdefault(t, {})
        if text not in mine:
            mine[text] = f"/* COMMENT_{len(mine)} */" if t == "COMMENT" else f"{t}_{len(mine)}"
    return table


def render(code: str, table: dict[str, dict[str, str]], config: dict[str, bool] | None = None) -> str:
    """The code with the symbols of the types that config turns on. What runs over several lines is replaced on its first
    and blanked on the others, so lines keep their place."""
    config = DEFAULT if config is None else config
    if unknown := set(config) - set(TYPES):
        raise ValueError(f"no such types: {sorted(unknown)}")
    out, at = [], 0
    for a, b, t, text in classified(code):
        if config.get(t) and text in table.get(t, {}):
            first, *rest = text.split("\n")
            out += [code[at:a], table[t][text], *("\n" + " " * len(x) for x in rest)]
            at = b
            del first
    return "".join(out) + code[at:]


@F.pandas_udf(T.StructType([T.StructField("code", T.StringType()), T.StructField("symbols", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))]))
def abstracted(code: pd.Series) -> pd.DataFrame:
    """The text with default symbols, and the symbol table."""
    tables = [None if c is None else symbols(c) for c in code]
    return pd.DataFrame({"code": pd.Series([None if c is None else render(c, t) for c, t in zip(code, tables)], dtype=object), "symbols": pd.Series(tables, dtype=object)})


# Functions.

_NOT_NAMES = frozenset(["if", "for", "while", "switch", "catch", "return", "sizeof", "else", "do", "try", "synchronized", "new", "throw", "case"])


def _first_branches(code: str) -> str:
    """The code with preprocessor lines and the branches behind #else and #elif blanked, every other character in its place."""
    if "#" not in code:
        return code
    out, stack, joined = [], [], False
    for line in code.split("\n"):
        mark = re.match(r"\s*#\s*(\w*)", line)
        if mark or joined:
            word = mark.group(1) if mark and not joined else ""
            if word in ("if", "ifdef", "ifndef"):
                stack.append(True)
            elif word in ("else", "elif") and stack:
                stack[-1] = False
            elif word == "endif" and stack:
                stack.pop()
            joined = line.rstrip("\r").endswith("\\")
            out.append(" " * len(line))
        else:
            out.append(line if all(stack) else " " * len(line))
    return "\n".join(out)


def functions(code: str) -> list[dict]:
    """Function definitions of a file: name, signature, parameters (type, name), return type, text, first and last line.

    A definition is a head with a parenthesised list before a brace, outside of other functions, also within classes and
    namespaces. Nested definitions lie inside their text and are not listed by themselves.
    """
    toks = [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(_first_branches(code)) if m.lastgroup not in ("COMMENT", "DIRECTIVE")]
    out: list[dict] = []
    head, i = 0, 0
    scopes: list[int] = []
    match: dict[int, int] = {}
    stack: list[int] = []
    pair = {")": "(", "]": "[", "}": "{"}
    for k, (_, _, t) in enumerate(toks):
        if t in "([{":
            stack.append(k)
        elif t in pair:
            while stack and toks[stack[-1]][2] != pair[t]:
                stack.pop()
            if stack:
                match[stack.pop()] = k
    while i < len(toks):
        t = toks[i][2]
        if t == "(" and i in match and i > head and re.match(r"[A-Za-z_$~]", toks[i - 1][2]) and toks[i - 1][2] not in _NOT_NAMES:
            close = match[i]
            j = close + 1
            init = False  # within a constructor's initialisers
            while j < len(toks) and not toks[j][2].startswith('"'):
                u = toks[j][2]
                init = init or u == ":"
                if init and j in match and (u == "(" or (u == "{" and re.match(r"[A-Za-z_$]", toks[j - 1][2]) and toks[min(match[j] + 1, len(toks) - 1)][2] in (",", "{"))):
                    j = match[j] + 1
                    continue
                if u in ("{", ";", "}", "=", "("):
                    break
                j += 1
            if j < len(toks) and toks[j][2] == "{" and j in match and i - 1 >= head:
                first, last = toks[head][0], toks[match[j]][1]
                n = i - 1
                while n - 2 >= head and toks[n - 1][2] in ("::",):
                    n -= 2
                name = "".join(x[2] for x in toks[n:i])
                inner = code[toks[i][1] : toks[close][0]].strip()
                params = _parameters(toks[i + 1 : close])
                kind = " ".join(x[2] for x in toks[head:n] if x[2] not in KEYWORDS or x[2] in ("struct", "union", "enum", "const"))
                out.append({"func_name": name, "signature": "(" + ", ".join(p[0] for p in params) + ")", "params": params, "return_type": kind, "func": code[first:last],
                            "first_line": code.count("\n", 0, first) + 1, "last_line": code.count("\n", 0, last) + 1, "inner": inner})
                i = head = match[j] + 1
                continue
            i = close + 1
            continue
        if t == "{":
            words = {x[2] for x in toks[head:i]}
            if words & {"class", "namespace", "interface", "enum", "struct", "union"} and "=" not in words or any(x[2] == "extern" for x in toks[head:i]):
                scopes.append(match.get(i, len(toks)))
                i += 1
                head = i
                continue
            i = head = match.get(i, len(toks)) + 1
            continue
        if t in (";", "}") or (t == ":" and i and toks[i - 1][2] in ("public", "private", "protected")):
            head = i + 1
        i += 1
    return out


def _parameters(toks: list[tuple[int, int, str]]) -> list[tuple[str, str]]:
    parts: list[list[str]] = [[]]
    depth = 0
    for _, _, t in toks:
        depth += (t in "(<[") - (t in ")>]")
        if t == "," and depth == 0:
            parts.append([])
        else:
            parts[-1].append(t)
    out = []
    for p in parts:
        p = p[: p.index("=")] if "=" in p else p
        if not p or p == ["void"]:
            continue
        words = [k for k, t in enumerate(p) if re.match(r"[A-Za-z_$]", t)]
        if len(words) > 1 and p[words[-1]] not in PRIMITIVES and (len(words) > 2 or p[words[0]] not in ("struct", "union", "enum", "const")):
            out.append((" ".join(p[: words[-1]] + p[words[-1] + 1 :]), p[words[-1]]))
        else:
            out.append((" ".join(p), ""))
    return out


def extract_functions(files: DataFrame, key: str, code: str) -> DataFrame:
    """(key, position, func_name, signature, return_type, func, first_line, last_line) of every function of every file."""
    kind = files.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["func_name", "signature", "return_type", "func", "first_line", "last_line"]
        for pdf in batches:
            rows = [(k, i, *(f[n] for n in names)) for k, c in zip(pdf["key"], pdf["code"]) if c is not None for i, f in enumerate(functions(c))]
            if rows:
                yield pd.DataFrame(rows, columns=["key", "position", *names])

    out = files.select(F.col(key).alias("key"), F.col(code).alias("code")).mapInPandas(run, f"key {kind}, position int, func_name string, signature string, return_type string, func string, first_line int, last_line int")
    return out.withColumnRenamed("key", key)
