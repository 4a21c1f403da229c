"""Access paths: how an expression reaches into the variable that it starts from.

A path is a list of elements: ("const", name), ("var",), ("shift", n), ("vshift",), ("addr",), ("deref",).
"""

from __future__ import annotations

Element = tuple
Path = list

NO_MATCH, EXACT, VARIABLE_EXACT, PREFIX, VARIABLE_PREFIX, EXTENDED, VARIABLE_EXTENDED = "no_match", "exact", "variable_exact", "prefix", "variable_prefix", "extended", "variable_extended"


def append(path: Path, element: Element) -> Path:
    """The path with one element more, in normal form: taking an address undoes an indirection and the other way round,
    shifts add up, a shift by nothing is none, and an unknown shift swallows known ones."""
    if element == ("shift", 0):
        return list(path)
    if path:
        last = path[-1]
        if {last[0], element[0]} == {"addr", "deref"}:
            return list(path[:-1])
        if last[0] in ("shift", "vshift") and element[0] in ("shift", "vshift"):
            if last[0] == element[0] == "shift":
                return append(path[:-1], ("shift", last[1] + element[1]))
            return [*path[:-1], ("vshift",)]
    return [*path, element]


def normal(elements: Path) -> Path:
    out: Path = []
    for e in elements:
        out = append(out, e)
    return out


def join(a: Path, b: Path) -> Path:
    out = list(a)
    for e in b:
        out = append(out, e)
    return out


_INVERSE = {"addr": ("deref",), "deref": ("addr",), "vshift": ("vshift",)}


def inverted(tail: Path) -> Path | None:
    """What undoes a tail; None if a part of it cannot be undone."""
    out: Path = []
    for e in reversed(tail):
        if e[0] == "shift":
            out.append(("shift", -e[1]))
        elif e[0] in _INVERSE:
            out.append(_INVERSE[e[0]])
        else:
            return None
    return out


def _meet(a: Element, b: Element) -> bool | None:
    """Whether two elements match: True certainly, False perhaps (one of them is variable), None not."""
    if a == b:
        return a[0] not in ("var", "vshift")
    kinds = {a[0], b[0]}
    return False if kinds in ({"const", "var"}, {"shift", "vshift"}) else None


def compare(tracked: Path, exclusions: list[Path], other: Path) -> tuple[str, Path]:
    """(result, difference) of a tracked path, some of whose extensions are excluded, with another.

    Equal lengths: exact. The tracked one longer: the other is a prefix, and the difference what the tracked one adds. The
    other longer: extended, the difference what it adds; an extension that begins with an excluded one does not match.
    Where a match holds only for some values of a variable part, the result is the variable one.
    """
    certain = True
    n = min(len(tracked), len(other))
    for a, b in zip(tracked[:n], other[:n]):
        m = _meet(a, b)
        if m is None:
            return NO_MATCH, []
        certain = certain and m
    if len(tracked) == len(other):
        return (EXACT if certain else VARIABLE_EXACT), []
    if len(tracked) > len(other):
        return (PREFIX if certain else VARIABLE_PREFIX), tracked[n:]
    rest = other[n:]
    if any(len(x) <= len(rest) and x == rest[: len(x)] for x in exclusions):
        return NO_MATCH, []
    return (EXTENDED if certain else VARIABLE_EXTENDED), rest


def exclude(exclusions: list[Path], path: Path) -> list[Path]:
    """The exclusions with one more, without those that it begins; unchanged where one of them begins it, or where a part of
    it is variable."""
    if any(e[0] in ("var", "vshift") for e in path) or any(x == path[: len(x)] for x in exclusions):
        return exclusions
    return [x for x in exclusions if x[: len(path)] != path] + [path]
