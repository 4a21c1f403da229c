"""Property graphs as two tables, and traversals over them as DataFrame transformations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.operators import shred
from codequarry.session import Scratch

# Label families of the property graph.
EXPRESSION = ["BLOCK", "CALL", "CONTROL_STRUCTURE", "FIELD_IDENTIFIER", "IDENTIFIER", "LITERAL", "METHOD_REF", "RETURN", "TEMPLATE_DOM", "TYPE_REF", "UNKNOWN", "ARRAY_INITIALIZER", "ANNOTATION", "ANNOTATION_LITERAL"]
CFG_NODE = [*EXPRESSION, "JUMP_TARGET", "METHOD", "METHOD_PARAMETER_IN", "METHOD_PARAMETER_OUT", "METHOD_RETURN"]

#: Columns of the node table; a source may leave any but graph_id, id and label out.
NODE_COLUMNS = {
    "graph_id": "long", "id": "long", "label": "string", "name": "string", "full_name": "string", "code": "string", "signature": "string", "value": "string",
    "type_full_name": "string", "filename": "string", "is_external": "boolean", "modifier_type": "string", "control_structure_type": "string",
    "dispatch_type": "string", "method_full_name": "string", "alias_type_full_name": "string", "inherits_from": "array<string>", "order": "int", "index": "int", "argument_index": "int",
    "argument_name": "string", "is_variadic": "boolean", "evaluation_strategy": "string", "line_number": "int", "line_number_end": "int", "column_number": "int", "column_number_end": "int",
    "offset": "int", "offset_end": "int", "content": "string", "parser_type_name": "string", "canonical_name": "string",
}
KEY = ["graph_id", "id"]


def full(column: str | Column, regex: str) -> Column:
    """The whole value matches the expression."""
    c = F.col(column) if isinstance(column, str) else column
    return c.rlike(f"^(?:{regex})$")


def complete_nodes(nodes: DataFrame) -> DataFrame:
    """nodes with every column of NODE_COLUMNS, null where the source has none."""
    return nodes.select(*[(F.col(f"`{c}`") if c in nodes.columns else F.lit(None)).cast(t).alias(c) for c, t in NODE_COLUMNS.items()])


def complete_edges(edges: DataFrame) -> DataFrame:
    var = F.col("variable") if "variable" in edges.columns else F.lit(None)
    return edges.select(F.col("graph_id").cast("long"), F.col("src").cast("long"), F.col("dst").cast("long"), "etype", var.cast("string").alias("variable"))


@dataclass(frozen=True)
class Graph:
    """nodes(graph_id, id, label, ...) and edges(graph_id, src, dst, etype, variable)."""

    nodes: DataFrame
    edges: DataFrame
    _pairs: dict = field(default_factory=dict, compare=False, repr=False)
    _above: dict = field(default_factory=dict, compare=False, repr=False)

    @staticmethod
    def of(nodes: DataFrame, edges: DataFrame) -> Graph:
        return Graph(complete_nodes(nodes), complete_edges(edges))

    @staticmethod
    def from_records(raw: DataFrame, scratch: Scratch | None = None) -> Graph:
        """Graphs of JSON records (kind 'graph'): exported edges name their source outNode and their target inNode. The
        records are shredded once, into a scratch table that both sides read."""
        adj = shred.adjacency(raw.where("kind = 'graph'"), "record_id", "payload")
        adj = (scratch or Scratch(raw.sparkSession)).save(adj)
        fields = {"id": "id", "_label": "label", "name": "name", "code": "code", "order": "order", "lineNumber": "line_number", "typeFullName": "type_full_name",
                  "controlStructureType": "control_structure_type", "isExternal": "is_external", "argumentIndex": "argument_index", "fullName": "full_name"}
        n = shred.entities(adj, {"nodes": "node"}, fields).drop("node", "level", "parent_node", "ordinal", "pos_path").withColumnRenamed("record_id", "graph_id")
        e = shred.entities(adj, {"edges": "edge"}, {"outNode": "src", "inNode": "dst", "etype": "etype", "variable": "variable"}).withColumnRenamed("record_id", "graph_id")
        return Graph.of(n.where("id IS NOT NULL"), e)

    def start(self, condition: Column | str | None = None) -> Traversal:
        return Traversal(self, self.nodes if condition is None else self.nodes.where(condition))

    def with_edges(self, *new: DataFrame) -> Graph:
        """The graph with more edges: an overlay."""
        edges = self.edges
        for e in new:
            edges = edges.unionByName(complete_edges(e))
        return Graph(self.nodes, edges)

    def with_nodes(self, *new: DataFrame) -> Graph:
        nodes = self.nodes
        for n in new:
            nodes = nodes.unionByName(complete_nodes(n))
        return Graph(nodes, self.edges)

    def etype(self, *types: str) -> DataFrame:
        return self.edges.where(F.col("etype").isin(*types)) if types else self.edges

    def pairs(self, types: list[str]) -> DataFrame:
        """(graph_id, id, to, depth): all that is reached from all nodes, with the least depth, written once for this graph.

        By doubling: a shortest path of more than k and at most 2k edges is one of k edges and one of at most k, so the
        rounds are the logarithm of the longest shortest path, however deep a tree is."""
        key = tuple(sorted(types))
        if key not in self._pairs:
            scratch = Scratch(self.nodes.sparkSession)
            e = self.etype(*types).select("graph_id", F.col("src").alias("id"), F.col("dst").alias("to")).distinct()
            parts, k = [scratch.save(e.withColumn("depth", F.lit(1)))], 1
            front = parts[0]
            while not front.isEmpty():
                known = shuffled(union(parts))
                on = front.where(F.col("depth") == k).select("graph_id", "id", F.col("to").alias("mid"))
                then = known.select("graph_id", F.col("id").alias("mid"), "to", F.col("depth").alias("more"))
                new = on.join(then, ["graph_id", "mid"]).groupBy("graph_id", "id", "to").agg((F.min("more") + k).alias("depth"))
                front = scratch.save(new.join(known.select("graph_id", "id", "to"), ["graph_id", "id", "to"], "left_anti"))
                parts.append(front)
                k *= 2
            self._pairs[key] = shuffled(union(parts))
        return self._pairs[key]

    def above(self, stops: Column) -> DataFrame:
        """(graph_id, id, above, depth): the nearest proper ancestor in the syntax tree that meets a condition, one for each node
        that has one. Pointers jump over twice as many levels in each round, and a node is one row in all of them."""
        scratch = Scratch(self.nodes.sparkSession)
        stop = shuffled(self.nodes.where(stops).select("graph_id", F.col("id").alias("to"), F.lit(True).alias("done")).distinct())
        up = self.etype("AST").select("graph_id", F.col("dst").alias("id"), F.col("src").alias("to")).distinct()
        now = up.join(stop, ["graph_id", "to"], "left").select("graph_id", "id", "to", F.lit(1).alias("depth"), F.coalesce("done", F.lit(False)).alias("done"))
        now = scratch.save(now)
        rounds = 0
        while not now.where("NOT done").isEmpty():
            rounds += 1
            if rounds > 60:
                raise RuntimeError("the syntax tree has a circle")
            then = shuffled(now.select("graph_id", F.col("id").alias("to"), F.col("to").alias("to2"), F.col("depth").alias("more"), F.col("done").alias("done2")))
            going = now.where("NOT done").join(then, ["graph_id", "to"]).select("graph_id", "id", F.col("to2").alias("to"), (F.col("depth") + F.col("more")).alias("depth"), F.col("done2").alias("done"))
            nxt = scratch.save(now.where("done").unionByName(going))
            scratch.drop(now)
            now = nxt
        return shuffled(now.select("graph_id", "id", F.col("to").alias("above"), "depth"))

    def above_label(self, label: str) -> DataFrame:
        """above() for the nodes with a label, written once for this graph."""
        if label not in self._above:
            self._above[label] = self.above(F.col("label") == label)
        return self._above[label]

    def closure(self, types: list[str], starts: DataFrame | None = None, reverse: bool = False, most: int | None = None) -> DataFrame:
        """(graph_id, id, to, depth): what is reached over edges of some types, the start itself left out unless a cycle
        leads back to it; the least depth of each. Of a syntax tree, whose pairs are few, and from all nodes it is taken from
        pairs(). From some starts over other edges only new pairs are carried on, each round is written, and the number
        of rounds is the longest shortest path, or most where that is given."""
        if most is None and (starts is None or types == ["AST"]):
            out = self.pairs(types)
            if reverse:
                out = out.select("graph_id", F.col("to").alias("id"), F.col("id").alias("to"), "depth")
            return out if starts is None else out.join(starts.select(*KEY).distinct(), KEY, "left_semi")
        scratch = Scratch(self.nodes.sparkSession)
        e = self.etype(*types).select("graph_id", *((F.col("dst").alias("f"), F.col("src").alias("t")) if reverse else (F.col("src").alias("f"), F.col("dst").alias("t")))).distinct()
        e = scratch.save(e)
        first = e.select("graph_id", F.col("f").alias("id"), F.col("t").alias("to"))
        if starts is not None:
            first = first.join(starts.select(*KEY).distinct(), KEY, "left_semi")
        delta = scratch.save(first.withColumn("depth", F.lit(1)))
        parts = [delta]
        depth = 1
        while (most is None or depth < most) and not delta.isEmpty():
            depth += 1
            parts = merged(parts, scratch)
            new = delta.join(e, (delta["graph_id"] == e["graph_id"]) & (delta["to"] == e["f"])).select(delta["graph_id"], delta["id"], e["t"].alias("to")).distinct()
            seen = union(parts)
            delta = scratch.save(new.join(seen.select("graph_id", "id", "to"), ["graph_id", "id", "to"], "left_anti").withColumn("depth", F.lit(depth)))
            parts.append(delta)
        return union(parts)


def shuffled(df: DataFrame) -> DataFrame:
    """df, to be joined by a shuffle: Spark goes by the size of its files, where few columns of a million rows take less than
    a limit for broadcasts, and the driver would hold the rows themselves."""
    return df.hint("merge")


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merged(parts: list[DataFrame], scratch: Scratch, most: int = 20) -> list[DataFrame]:
    """The same rows in at most `most` tables, so that the plan over many rounds stays small."""
    return parts if len(parts) <= most else [scratch.save(union(parts))]


class Traversal:
    """A bag of nodes: a DataFrame with the node table's columns, duplicates kept. Columns in carry stay with a row from
    step to step, such as the element that a sub-traversal started from."""

    def __init__(self, graph: Graph, df: DataFrame, carry: tuple[str, ...] = ()):
        self.graph, self.df, self.carry = graph, df, carry

    def _with(self, df: DataFrame) -> Traversal:
        return Traversal(self.graph, df, self.carry)

    def _at(self, ends: DataFrame, label: str | list[str] | None) -> Traversal:
        """The nodes at (_g, _far), with the carried columns."""
        nodes = self.graph.nodes.select(*NODE_COLUMNS)
        if label is not None:
            nodes = nodes.where(F.col("label").isin([label] if isinstance(label, str) else label))
        return self._with(nodes.join(ends, (F.col("graph_id") == F.col("_g")) & (F.col("id") == F.col("_far"))).drop("_g", "_far"))

    def keeping(self, name: str = "_start") -> Traversal:
        """Each row also names itself, for all later steps."""
        return Traversal(self.graph, self.df.withColumn(name, F.struct(*KEY)), (*self.carry, name))

    # Combinators.

    def where(self, condition: Column | str) -> Traversal:
        return self._with(self.df.where(condition))

    def label(self, *labels: str) -> Traversal:
        return self.where(F.col("label").isin(*labels))

    def matching(self, column: str, regex: str) -> Traversal:
        return self.where(full(column, regex))

    def not_matching(self, column: str, regex: str) -> Traversal:
        return self.where(~full(column, regex))

    def exact(self, column: str, *values) -> Traversal:
        return self.where(F.col(column).isin(*values))

    def _hop(self, types: tuple[str, ...], forward: bool, label: str | list[str] | None) -> Traversal:
        near, far = ("src", "dst") if forward else ("dst", "src")
        e = self.graph.etype(*types).select(F.col("graph_id").alias("_g"), F.col(near).alias("_near"), F.col(far).alias("_far"))
        ends = self.df.select(*KEY, *self.carry).join(e, (F.col("graph_id") == F.col("_g")) & (F.col("id") == F.col("_near"))).select("_g", "_far", *self.carry)
        return self._at(ends, label)

    def out(self, *types: str, label: str | list[str] | None = None) -> Traversal:
        """Targets of the out-edges, one for each edge."""
        return self._hop(types, True, label)

    def in_(self, *types: str, label: str | list[str] | None = None) -> Traversal:
        return self._hop(types, False, label)

    def reached(self, types: list[str], reverse: bool = False, label: str | list[str] | None = None, with_self: bool = False) -> Traversal:
        """The closure over some edge types, each node once for each start."""
        c = self.graph.closure(types, self.df, reverse).select(F.col("graph_id").alias("_g"), F.col("id").alias("_from"), F.col("to").alias("_far"))
        ends = self.df.select(*KEY, *self.carry).join(c, (F.col("graph_id") == F.col("_g")) & (F.col("id") == F.col("_from"))).select("_g", "_far", *self.carry)
        if with_self:
            ends = ends.unionByName(self.df.select(F.col("graph_id").alias("_g"), F.col("id").alias("_far"), *self.carry))
        return self._at(ends, label)

    def _hits(self, step: Callable[[Traversal], Traversal]) -> DataFrame:
        """The elements for which the step yields something; it runs once for all, each row carrying its start."""
        t = Traversal(self.graph, self.df.select(*NODE_COLUMNS).dropDuplicates(KEY)).keeping("_start")
        return step(t).df.select("_start.graph_id", "_start.id").distinct()

    def _tested(self, step: Callable[[Traversal], Traversal], how: str) -> Traversal:
        return self._with(self.df.join(self._hits(step), KEY, how))

    def where_step(self, step: Callable[[Traversal], Traversal]) -> Traversal:
        return self._tested(step, "left_semi")

    def where_not_step(self, step: Callable[[Traversal], Traversal]) -> Traversal:
        return self._tested(step, "left_anti")

    def and_(self, *steps: Callable) -> Traversal:
        t = self
        for s in steps:
            t = t.where_step(s)
        return t

    def or_(self, *steps: Callable) -> Traversal:
        hits = None
        for s in steps:
            h = self._hits(s)
            hits = h if hits is None else hits.unionByName(h)
        return self._with(self.df.join(hits.distinct(), KEY, "left_semi"))

    def not_(self, step: Callable) -> Traversal:
        return self.where_not_step(step)

    def dedup(self) -> Traversal:
        return self._with(self.df.dropDuplicates([*KEY, *self.carry]))

    def union(self, other: Traversal) -> Traversal:
        return self._with(self.df.unionByName(other.df))

    def intersect(self, other: Traversal) -> Traversal:
        return self._with(self.df.join(other.df.select(*KEY).distinct(), KEY, "left_semi").dropDuplicates(KEY))

    def minus(self, other: Traversal) -> Traversal:
        return self._with(self.df.join(other.df.select(*KEY).distinct(), KEY, "left_anti").dropDuplicates(KEY))

    def repeat(self, step: Callable[[Traversal], Traversal], times: int, emit: bool = True) -> Traversal:
        """The step applied up to `times` times; with emit the bag of all rounds, else the last round."""
        now, out = self, None
        for _ in range(times):
            now = step(now)
            out = now if out is None or not emit else out.union(now)
        return out if out is not None else self

    def coalesce(self, *steps: Callable[[Traversal], Traversal]) -> Traversal:
        """The first branch that yields anything at all."""
        for s in steps[:-1]:
            t = s(self)
            if not t.df.isEmpty():
                return t
        return steps[-1](self)

    def choose(self, condition: Column, then: Callable[[Traversal], Traversal], else_: Callable[[Traversal], Traversal]) -> Traversal:
        return then(self.where(condition)).union(else_(self.where(~F.coalesce(condition, F.lit(False)))))

    def sort_by(self, *columns: str | Column) -> Traversal:
        return self._with(self.df.orderBy(*columns))

    def group_count(self, *columns: str) -> DataFrame:
        return self.df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))

    # Terminals.

    def ids(self) -> DataFrame:
        return self.df.select(*KEY)

    def size(self) -> int:
        return self.df.count()

    def is_empty(self) -> bool:
        return self.df.isEmpty()

    def to_list(self) -> list:
        return self.df.collect()

    def iterate(self):
        return self.df.toLocalIterator()

    def head(self):
        return self.df.orderBy(*KEY).first()

    def to_json(self, pretty: bool = False) -> DataFrame:
        return self.df.select(*KEY, F.to_json(F.struct("*"), {"pretty": "true"} if pretty else {}).alias("json"))
