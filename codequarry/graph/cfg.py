"""Control-flow edges from syntax trees, composed bottom-up: each construct is an entry and a set of loose ends."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.graph.model import Graph

AND, OR, CONDITIONAL = "<operator>.logicalAnd", "<operator>.logicalOr", "<operator>.conditional"


@dataclass
class Part:
    """Part of a flow: where it begins (None: nothing runs) and the nodes that go on to what follows."""

    entry: int | None = None
    ends: list[int] = field(default_factory=list)
    breaks: list[int] = field(default_factory=list)
    continues: list[int] = field(default_factory=list)
    cases: list[int] = field(default_factory=list)
    default: bool = False


class Builder:
    def __init__(self, nodes: dict[int, dict], children: dict[int, list[int]]):
        self.nodes, self.children = nodes, children
        self.edges: set[tuple[int, int]] = set()
        self.returns: list[int] = []
        self.labels: dict[str, int] = {}
        self.gotos: list[tuple[int, str]] = []

    def link(self, ends: list[int], entry: int | None) -> None:
        if entry is not None:
            self.edges.update((e, entry) for e in ends)

    def then(self, a: Part, b: Part) -> Part:
        """b behind a."""
        out = Part(breaks=a.breaks + b.breaks, continues=a.continues + b.continues, cases=a.cases + b.cases, default=a.default or b.default)
        if a.entry is None:
            out.entry, out.ends = b.entry, b.ends
        elif b.entry is None:
            out.entry, out.ends = a.entry, a.ends
        else:
            self.link(a.ends, b.entry)
            out.entry, out.ends = a.entry, b.ends
        return out

    def sequence(self, ids: list[int]) -> Part:
        out = Part()
        for i in ids:
            out = self.then(out, self.part(i))
        return out

    def part(self, i: int) -> Part:
        n = self.nodes[i]
        kids = self.children.get(i, [])
        label = n["label"]
        if label in ("BLOCK", "ARRAY_INITIALIZER"):
            return self.sequence(kids)
        if label == "CONTROL_STRUCTURE":
            return self.control(i, n, kids)
        if label == "JUMP_TARGET":
            name = n["name"] or ""
            self.labels[name] = i
            out = Part(i, [i])
            if name.startswith("case") or name == "default":
                out.cases, out.default = [i], name == "default"
            return out
        if label == "RETURN":
            body = self.then(self.sequence(kids), Part(i, []))
            self.returns.append(i)
            return body
        if label == "CALL":
            if n["name"] in (AND, OR) and len(kids) == 2:
                a, b = self.part(kids[0]), self.part(kids[1])
                self.link(a.ends, b.entry)
                self.link(a.ends + b.ends, i)
                return Part(a.entry, [i])
            if n["name"] == CONDITIONAL and len(kids) >= 2:
                c, branches = self.part(kids[0]), [self.part(k) for k in kids[1:]]
                for b in branches:
                    self.link(c.ends, b.entry)
                    self.link(b.ends, i)
                return Part(c.entry, [i])
            return self.then(self.sequence(kids), Part(i, [i]))
        if label in ("IDENTIFIER", "LITERAL", "FIELD_IDENTIFIER", "METHOD_REF", "TYPE_REF", "UNKNOWN", "TEMPLATE_DOM", "ANNOTATION_LITERAL"):
            return self.then(self.sequence(kids), Part(i, [i]))
        return Part()  # declarations run nothing

    def control(self, i: int, n: dict, kids: list[int]) -> Part:
        kind = (n["control_structure_type"] or "").split(" ")[0]
        if kind == "BREAK":
            return Part(i, [], breaks=[i])
        if kind == "CONTINUE":
            return Part(i, [], continues=[i])
        if kind == "GOTO":
            self.gotos.append((i, (n["code"] or "").replace("goto", "").strip(" ;")))
            return Part(i, [])
        if kind == "IF":
            cond, *rest = [self.part(k) for k in kids] or [Part()]
            for b in rest:
                self.link(cond.ends, b.entry)
            ends = [e for b in rest for e in (b.ends if b.entry is not None else cond.ends)]
            if len(rest) < 2:
                ends += cond.ends
            out = Part(cond.entry, list(dict.fromkeys(ends)))
            return self._jumps(out, rest)
        if kind == "ELSE":
            return self.sequence(kids)
        if kind in ("WHILE", "FOR", "DO"):
            return self.loop(kind, [self.part(k) for k in kids])
        if kind in ("SWITCH", "MATCH"):
            cond, *rest = [self.part(k) for k in kids] or [Part()]
            body = Part()
            for b in rest:
                body = self.then(body, b)
            for c in body.cases:
                self.link(cond.ends, c)
            ends = body.ends + body.breaks + ([] if body.default else cond.ends)
            return Part(cond.entry, ends, continues=body.continues)
        if kind == "TRY":
            parts = [self.part(k) for k in kids]
            body, handlers = parts[0] if parts else Part(), parts[1:]
            for h in handlers:
                self.link(body.ends, h.entry)
            return self._jumps(Part(body.entry, body.ends + [e for h in handlers for e in h.ends]), parts)
        return self.sequence(kids)

    def _jumps(self, out: Part, parts: list[Part]) -> Part:
        for b in parts:
            out.breaks += b.breaks
            out.continues += b.continues
            out.cases += b.cases
            out.default = out.default or b.default
        return out

    def loop(self, kind: str, parts: list[Part]) -> Part:
        if kind == "WHILE":
            cond, body = (parts + [Part()] * 2)[:2]
            self.link(cond.ends, body.entry if body.entry is not None else cond.entry)
            self.link(body.ends + body.continues, cond.entry)
            return Part(cond.entry, cond.ends + body.breaks)
        if kind == "DO":
            body, cond = (parts + [Part()] * 2)[:2]
            entry = body.entry if body.entry is not None else cond.entry
            self.link(body.ends + body.continues, cond.entry)
            self.link(cond.ends, entry)
            return Part(entry, cond.ends + body.breaks)
        init, cond, update, body = (parts + [Part()] * 4)[:4]
        head = cond if cond.entry is not None else body
        self.link(init.ends, head.entry)
        self.link(cond.ends, body.entry if body.entry is not None else (update.entry if update.entry is not None else cond.entry))
        back = update.entry if update.entry is not None else head.entry
        self.link(body.ends + body.continues, back)
        self.link(update.ends, head.entry)
        return Part(init.entry if init.entry is not None else head.entry, cond.ends + body.breaks)


def flow(nodes: dict[int, dict], children: dict[int, list[int]], method: int, exit_: int | None, body: list[int]) -> list[tuple[int, int]]:
    """Flow edges of a method from its entry over its body to its return."""
    b = Builder(nodes, children)
    whole = b.then(Part(method, [method]), b.sequence(body))
    for i, name in b.gotos:
        if name in b.labels:
            b.edges.add((i, b.labels[name]))
    if exit_ is not None:
        b.edges.update((e, exit_) for e in [*whole.ends, *b.returns])
    return sorted(b.edges)


def control_flow(graph: Graph) -> DataFrame:
    """CFG edges of every method, from the syntax tree below it; children run by their order."""
    below = graph.closure(["AST"]).select("graph_id", F.col("id").alias("method"), F.col("to").alias("node"))
    methods = graph.nodes.where("label = 'METHOD'").select("graph_id", F.col("id").alias("method"))
    inner = below.join(methods, ["graph_id", "method"], "left_semi").unionByName(methods.select("graph_id", "method", F.col("method").alias("node")))
    n = graph.nodes.select("graph_id", F.col("id").alias("node"), "label", "name", "code", "control_structure_type", F.coalesce("order", F.lit(0)).alias("ord"))
    parent = graph.etype("AST").select("graph_id", F.col("dst").alias("node"), F.col("src").alias("parent"))
    rows = inner.join(n, ["graph_id", "node"]).join(parent, ["graph_id", "node"], "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = int(pdf["method"].iloc[0])
        clean = lambda v: None if v is None or v != v else v
        nodes = {int(r.node): {"label": r.label, "name": clean(r.name), "code": clean(r.code), "control_structure_type": clean(r.control_structure_type)} for r in pdf.itertuples(index=False)}
        kids: dict[int, list[tuple[int, int]]] = {}
        for node, par, o in zip(pdf["node"], pdf["parent"], pdf["ord"]):
            if par == par and par is not None and int(node) != m:
                kids.setdefault(int(par), []).append((int(o), int(node)))
        children = {p: [c for _, c in sorted(cs)] for p, cs in kids.items()}
        top = children.get(m, [])
        exit_ = next((c for c in top if nodes[c]["label"] == "METHOD_RETURN"), None)
        edges = flow(nodes, children, m, exit_, [c for c in top if nodes[c]["label"] == "BLOCK"])
        g = int(pdf["graph_id"].iloc[0])
        return pd.DataFrame({"graph_id": [g] * len(edges), "src": [e[0] for e in edges], "dst": [e[1] for e in edges]}, dtype="int64")

    return rows.groupBy("graph_id", "method").applyInPandas(run, "graph_id long, src long, dst long").withColumn("etype", F.lit("CFG"))
