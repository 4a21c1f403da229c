"""Parsing with derivatives: a recogniser of context-free languages over token streams.

A language is a hash-consed node: nothing, the empty string, one token, a rule, a sequence, a choice or a repetition.
Reading a token replaces the language by its derivative. Nodes are interned, so equal languages are one number, and every
derivative is memoised by (node, token): functions that look alike share nearly all of their derivatives, and a token
costs one table lookup. Compaction keeps nodes small: sequences lean to the right, choices are sets whose members with one
tail are joined. The empty language after a token marks that token as the first that cannot stand there; a language that
does not hold the empty string when the tokens end means that the text breaks off.
"""

from __future__ import annotations

import re

NOTHING, EPSILON = 0, 1
_TOK, _RULE, _SEQ, _ALT, _STAR = "tok", "rule", "seq", "alt", "star"


class Language:
    """rules: name -> text with 'token', other rules, ( ) | * + ? and juxtaposition; no rule may be left-recursive."""

    def __init__(self, rules: dict[str, str], start: str, kinds: dict[str, int], most_memos: int = 3_000_000):
        self.rules, self.start_name, self.kinds, self.most = rules, start, kinds, most_memos
        self._parsed = {name: _Reader(text).choice() for name, text in rules.items()}
        self._nullable = self._fixpoint()
        self._reset()

    def _reset(self) -> None:
        self.nodes: list[tuple] = [("nothing",), ("epsilon",)]
        self.null = [False, True]
        self.index: dict[tuple, int] = {}
        self.memo: dict[int, int] = {}
        self.body: dict[str, int] = {}
        self.start = self._rule(self.start_name)

    def _fixpoint(self) -> dict[str, bool]:
        known = dict.fromkeys(self._parsed, False)

        def null(x) -> bool:
            op = x[0]
            if op == "name":
                return known[x[1]]
            if op == "seq":
                return all(map(null, x[1]))
            if op == "alt":
                return any(map(null, x[1]))
            return op in ("star", "opt") or (op == "plus" and null(x[1]))

        while True:
            new = {k: null(v) for k, v in self._parsed.items()}
            if new == known:
                return known
            known = new

    def _node(self, key: tuple, null: bool) -> int:
        i = self.index.get(key)
        if i is None:
            i = self.index[key] = len(self.nodes)
            self.nodes.append(key)
            self.null.append(null)
        return i

    def _rule(self, name: str) -> int:
        return self._node((_RULE, name), self._nullable[name])

    def _seq(self, a: int, b: int) -> int:
        if a == NOTHING or b == NOTHING:
            return NOTHING
        if a == EPSILON:
            return b
        if b == EPSILON:
            return a
        n = self.nodes[a]
        if n[0] == _SEQ:
            return self._seq(n[1], self._seq(n[2], b))
        return self._node((_SEQ, a, b), self.null[a] and self.null[b])

    def _alt(self, members) -> int:
        flat: set[int] = set()
        for m in members:
            n = self.nodes[m]
            if n[0] == _ALT:
                flat.update(n[1])
            elif m != NOTHING:
                flat.add(m)
        if len(flat) > 1:
            tails: dict[int, set[int]] = {}
            for m in flat:
                n = self.nodes[m]
                if n[0] == _SEQ:
                    tails.setdefault(n[2], set()).add(n[1])
                else:
                    tails.setdefault(EPSILON, set()).add(m)
            if len(tails) < len(flat) and any(t != EPSILON and len(h) > 1 for t, h in tails.items()):
                flat = set()
                for tail, heads in tails.items():
                    flat |= heads if tail == EPSILON else {self._seq(self._alt(heads), tail)}
        if not flat:
            return NOTHING
        if len(flat) == 1:
            return next(iter(flat))
        return self._node((_ALT, frozenset(flat)), any(self.null[m] for m in flat))

    def _build(self, x) -> int:
        op = x[0]
        if op == "lit":
            return self._node((_TOK, self.kinds[x[1]]), False)
        if op == "name":
            return self._rule(x[1])
        if op == "seq":
            out = EPSILON
            for y in reversed(x[1]):
                out = self._seq(self._build(y), out)
            return out
        if op == "alt":
            return self._alt([self._build(y) for y in x[1]])
        a = self._build(x[1])
        if op == "opt":
            return self._alt([a, EPSILON])
        star = self._node((_STAR, a), True)
        return star if op == "star" else self._seq(a, star)

    def derive(self, node: int, tok: int) -> int:
        key = node << 8 | tok
        out = self.memo.get(key)
        if out is None:
            n = self.nodes[node]
            op = n[0]
            if op == _TOK:
                out = EPSILON if n[1] == tok else NOTHING
            elif op == _RULE:
                body = self.body.get(n[1])
                if body is None:
                    body = self.body[n[1]] = self._build(self._parsed[n[1]])
                out = self.derive(body, tok)
            elif op == _SEQ:
                out = self._seq(self.derive(n[1], tok), n[2])
                if self.null[n[1]] and (rest := self.derive(n[2], tok)) != NOTHING:
                    out = self._alt([out, rest])
            elif op == _ALT:
                out = self._alt([self.derive(m, tok) for m in n[1]])
            elif op == _STAR:
                out = self._seq(self.derive(n[1], tok), node)
            else:
                out = NOTHING
            self.memo[key] = out
        return out

    def run(self, toks: list[int]) -> int:
        """-1: the tokens are in the language; len(toks): they break off; else the place of the first wrong token."""
        if len(self.memo) > self.most:
            self._reset()
        memo, s = self.memo, self.start
        for i, t in enumerate(toks):
            nxt = memo.get(s << 8 | t)
            s = self.derive(s, t) if nxt is None else nxt
            if s == NOTHING:
                return i
        return -1 if self.null[s] else len(toks)


class _Reader:
    """Reads the right side of a rule."""

    _WORD = re.compile(r"\s*(?:'([^']+)'|(\w+)|([()|*+?]))")

    def __init__(self, text: str):
        self.items = [(m.group(1), m.group(2), m.group(3)) for m in self._WORD.finditer(text)]
        self.i = 0

    def _op(self) -> str | None:
        return self.items[self.i][2] if self.i < len(self.items) else None

    def choice(self):
        alts = [self.sequence()]
        while self._op() == "|":
            self.i += 1
            alts.append(self.sequence())
        return alts[0] if len(alts) == 1 else ("alt", alts)

    def sequence(self):
        out = []
        while self.i < len(self.items) and self._op() not in ("|", ")"):
            lit, name, op = self.items[self.i]
            self.i += 1
            if op == "(":
                x = self.choice()
                self.i += 1
            else:
                x = ("lit", lit) if lit else ("name", name)
            while self._op() in ("*", "+", "?"):
                x = ({"*": "star", "+": "plus", "?": "opt"}[self._op()], x)
                self.i += 1
            out.append(x)
        return out[0] if len(out) == 1 else ("seq", out)
