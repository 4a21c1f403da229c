"""Passes that add edges and nodes to a graph: containment, dominance, control dependence, types, calls, stubs.

Name linkers are equi-joins. Flow algorithms run once for each method, which is as large as its source text and no larger.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.graph import kernels
from codequarry.graph.model import CFG_NODE, Graph

# Labels that control dependence may start from.
CDG_SOURCES = ["LITERAL", "IDENTIFIER", "CALL", "METHOD_REF", "UNKNOWN", "CONTROL_STRUCTURE", "JUMP_TARGET"]


def contains(graph: Graph) -> DataFrame:
    """CONTAINS edges: METHOD, TYPE_DECL or FILE to the control-flow nodes whose nearest such ancestor it is."""
    near = graph.above(F.col("label").isin("METHOD", "TYPE_DECL", "FILE")).select("graph_id", F.col("above").alias("src"), F.col("id").alias("dst"))
    inner = graph.nodes.where(F.col("label").isin([x for x in CFG_NODE if not x.startswith("METHOD_PARAMETER") and x not in ("METHOD", "METHOD_RETURN")])).select("graph_id", F.col("id").alias("dst")).distinct()
    return near.join(inner, ["graph_id", "dst"], "left_semi").select("graph_id", "src", "dst", F.lit("CONTAINS").alias("etype"))


def _flow(graph: Graph) -> DataFrame:
    """(graph_id, method, src, dst, exit): the flow edges of each method; exit is its METHOD_RETURN, if it has one."""
    inside = graph.etype("CONTAINS").select(F.col("graph_id").alias("cg"), F.col("src").alias("method"), F.col("dst").alias("n"))
    methods = graph.nodes.where("label = 'METHOD'").select(F.col("graph_id").alias("cg"), F.col("id").alias("method"), F.col("id").alias("n"))
    of = inside.join(methods.select("cg", "method"), ["cg", "method"], "left_semi").unionByName(methods)
    rets = graph.etype("AST").join(graph.nodes.where("label = 'METHOD_RETURN'").select(F.col("graph_id").alias("rg"), F.col("id").alias("rid")), (F.col("graph_id") == F.col("rg")) & (F.col("dst") == F.col("rid")))
    rets = rets.groupBy(F.col("graph_id").alias("rg2"), F.col("src").alias("rm")).agg(F.min("dst").alias("exit"))
    flow = graph.etype("CFG").select("graph_id", "src", "dst").join(of, (F.col("graph_id") == F.col("cg")) & (F.col("src") == F.col("n"))).drop("cg", "n")
    return flow.join(rets, (F.col("graph_id") == F.col("rg2")) & (F.col("method") == F.col("rm")), "left").select("graph_id", "method", "src", "dst", "exit")


_EDGES = "graph_id long, src long, dst long"


def _succ(pdf: pd.DataFrame) -> tuple[dict[int, list[int]], list[int]]:
    succ: dict[int, list[int]] = {}
    for a, b in sorted(set(zip(pdf["src"].tolist(), pdf["dst"].tolist()))):
        succ.setdefault(a, []).append(b)
    return succ, sorted({*pdf["src"], *pdf["dst"]})


def _edges(pdf: pd.DataFrame, pairs: list[tuple[int, int]]) -> pd.DataFrame:
    g = int(pdf["graph_id"].iloc[0])
    return pd.DataFrame({"graph_id": [g] * len(pairs), "src": [p[0] for p in pairs], "dst": [p[1] for p in pairs]}, dtype="int64")


def _per_method(graph: Graph, run, etype: str) -> DataFrame:
    return _flow(graph).groupBy("graph_id", "method").applyInPandas(run, _EDGES).withColumn("etype", F.lit(etype))


def _exit_of(pdf: pd.DataFrame) -> int | None:
    e = pdf["exit"].iloc[0]
    return None if pd.isna(e) else int(e)


def dominators(graph: Graph) -> DataFrame:
    """DOMINATE edges: immediate dominator to node."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        succ, _ = _succ(pdf)
        return _edges(pdf, sorted((d, n) for n, d in kernels.immediate_dominators(succ, int(pdf["method"].iloc[0])).items()))

    return _per_method(graph, run, "DOMINATE")


def post_dominators(graph: Graph) -> DataFrame:
    """POST_DOMINATE edges: immediate post-dominator to node; what only leads to an added exit has none."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        succ, nodes = _succ(pdf)
        succ, end = kernels.with_exit(succ, nodes, _exit_of(pdf))
        idom = kernels.immediate_dominators(kernels.reversed_graph(succ), end)
        return _edges(pdf, sorted((d, n) for n, d in idom.items() if d != kernels.EXIT))

    return _per_method(graph, run, "POST_DOMINATE")


def control_dependence(graph: Graph) -> DataFrame:
    """CDG edges: a node to those whose running it decides, by post-dominance frontiers."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        succ, nodes = _succ(pdf)
        succ, end = kernels.with_exit(succ, nodes, _exit_of(pdf))
        back = kernels.reversed_graph(succ)
        front = kernels.frontiers(back, kernels.immediate_dominators(back, end))
        return _edges(pdf, sorted((f, n) for n, fs in front.items() for f in fs if kernels.EXIT not in (f, n)))

    found = _per_method(graph, run, "CDG")
    ok = graph.nodes.where(F.col("label").isin(CDG_SOURCES)).select(F.col("graph_id").alias("ng"), F.col("id").alias("nid"))
    return found.join(ok, (F.col("graph_id") == F.col("ng")) & (F.col("src") == F.col("nid")), "left_semi")


def post_order(graph: Graph) -> DataFrame:
    """(graph_id, method, id, number): a depth-first numbering of each method's flow, callees' order by id."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        succ, _ = _succ(pdf)
        m = int(pdf["method"].iloc[0])
        order = kernels.post_order(succ, m)
        return pd.DataFrame({"graph_id": int(pdf["graph_id"].iloc[0]), "method": m, "id": order, "number": range(len(order))})

    return _flow(graph).groupBy("graph_id", "method").applyInPandas(run, "graph_id long, method long, id long, number int")


# Nodes and names.


def _link(graph: Graph, left: DataFrame, right: DataFrame, etype: str) -> DataFrame:
    """Edges where left(graph_id, src, name) meets right(graph_id, dst, name)."""
    return left.join(right, ["graph_id", "name"]).select("graph_id", "src", "dst", F.lit(etype).alias("etype"))


def _named(graph: Graph, label: str, column: str, as_: str) -> DataFrame:
    return graph.nodes.where((F.col("label") == label) & F.col(column).isNotNull()).select("graph_id", F.col("id").alias(as_), F.col(column).alias("name"))


def files(graph: Graph, unknown: str = "<unknown>") -> Graph:
    """A FILE node for every file name and SOURCE_FILE edges from the nodes that name it; empty names mean an unknown file."""
    name = F.when(F.coalesce("filename", F.lit("")) == "", F.lit(unknown)).otherwise(F.col("filename"))
    users = graph.nodes.where(F.col("label").isin("METHOD", "TYPE_DECL", "NAMESPACE_BLOCK")).select("graph_id", F.col("id").alias("src"), name.alias("name"))
    known = _named(graph, "FILE", "name", "dst")
    missing = users.select("graph_id", "name").distinct().join(known, ["graph_id", "name"], "left_anti")
    new = missing.select("graph_id", (-F.abs(F.xxhash64("graph_id", "name", F.lit("file")))).alias("id"), F.lit("FILE").alias("label"), "name")
    have = graph.etype("SOURCE_FILE").select("graph_id", "src").distinct()
    edges = _link(graph, users.join(have, ["graph_id", "src"], "left_anti"), known.unionByName(new.select("graph_id", F.col("id").alias("dst"), "name")), "SOURCE_FILE")
    return graph.with_nodes(new).with_edges(edges)


def namespaces(graph: Graph) -> Graph:
    """One NAMESPACE for each name of blocks, with REF edges from them."""
    blocks = _named(graph, "NAMESPACE_BLOCK", "name", "src")
    new = blocks.select("graph_id", "name").distinct().select("graph_id", (-F.abs(F.xxhash64("graph_id", "name", F.lit("namespace")))).alias("id"), F.lit("NAMESPACE").alias("label"), "name")
    return graph.with_nodes(new).with_edges(_link(graph, blocks, new.select("graph_id", F.col("id").alias("dst"), "name"), "REF"))


def type_stubs(graph: Graph) -> Graph:
    """External TYPE_DECLs for types whose full name no declaration has."""
    missing = _named(graph, "TYPE", "full_name", "t").join(_named(graph, "TYPE_DECL", "full_name", "d"), ["graph_id", "name"], "left_anti").select("graph_id", "name").distinct()
    new = missing.select("graph_id", (-F.abs(F.xxhash64("graph_id", "name", F.lit("type")))).alias("id"), F.lit("TYPE_DECL").alias("label"), "name", F.col("name").alias("full_name"), F.lit(True).alias("is_external"))
    return graph.with_nodes(new)


def method_stubs(graph: Graph) -> Graph:
    """An external METHOD for each called full name that no method has, with one parameter for each argument of its widest
    call: from 1, or from 0 where a call is dispatched dynamically."""
    calls = graph.nodes.where("label = 'CALL' AND method_full_name IS NOT NULL").select("graph_id", "id", F.col("method_full_name").alias("name"), (F.col("dispatch_type") == "DYNAMIC_DISPATCH").alias("dyn"))
    args = graph.etype("ARGUMENT").groupBy("graph_id", F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("k"))
    sums = calls.join(_named(graph, "METHOD", "full_name", "m"), ["graph_id", "name"], "left_anti").join(args, ["graph_id", "id"], "left")
    sums = sums.groupBy("graph_id", "name").agg(F.max(F.coalesce("k", F.lit(0))).alias("k"), F.bool_or(F.coalesce("dyn", F.lit(False))).alias("dyn"))
    mid = -F.abs(F.xxhash64("graph_id", "name", F.lit("method")))
    methods = sums.select("graph_id", mid.alias("id"), F.lit("METHOD").alias("label"), F.element_at(F.split("name", r"[.:]"), -1).alias("name"), F.col("name").alias("full_name"), F.lit(True).alias("is_external"))
    first = F.when(F.col("dyn"), 0).otherwise(1)
    params = sums.where("k > 0").select("graph_id", mid.alias("m"), F.explode(F.sequence(first, first + F.col("k").cast("int") - 1)).alias("index"))
    params = params.select("graph_id", "m", "index", (-F.abs(F.xxhash64("graph_id", "m", "index", F.lit("parameter")))).alias("id"))
    nodes = params.select("graph_id", "id", F.lit("METHOD_PARAMETER_IN").alias("label"), F.concat(F.lit("p"), F.col("index")).alias("name"), "index", F.col("index").alias("order"))
    edges = params.select("graph_id", F.col("m").alias("src"), F.col("id").alias("dst"), F.lit("AST").alias("etype"))
    return graph.with_nodes(methods, nodes).with_edges(edges)


def parameter_index(graph: Graph) -> Graph:
    """Parameters without an index take their order."""
    index = F.when((F.col("label") == "METHOD_PARAMETER_IN") & F.col("index").isNull(), F.col("order")).otherwise(F.col("index"))
    return Graph(graph.nodes.withColumn("index", index), graph.edges)


def output_parameters(graph: Graph) -> Graph:
    """A METHOD_PARAMETER_OUT beside every parameter, tied by PARAMETER_LINK and under the same method."""
    p = graph.nodes.where("label = 'METHOD_PARAMETER_IN'")
    oid = -F.abs(F.xxhash64("graph_id", "id", F.lit("out")))
    nodes = p.withColumn("label", F.lit("METHOD_PARAMETER_OUT")).withColumn("id", oid)
    link = p.select("graph_id", F.col("id").alias("src"), oid.alias("dst"), F.lit("PARAMETER_LINK").alias("etype"))
    ast = graph.etype("AST").join(p.select(F.col("graph_id").alias("pg"), F.col("id").alias("pid")), (F.col("graph_id") == F.col("pg")) & (F.col("dst") == F.col("pid")))
    ast = ast.select("graph_id", "src", (-F.abs(F.xxhash64("graph_id", "dst", F.lit("out")))).alias("dst"), "etype")
    return graph.with_nodes(nodes).with_edges(link, ast)


def type_refs(graph: Graph) -> DataFrame:
    """REF edges from types to the declarations of their full name."""
    return _link(graph, _named(graph, "TYPE", "full_name", "src"), _named(graph, "TYPE_DECL", "full_name", "dst"), "REF")


def eval_types(graph: Graph) -> DataFrame:
    """EVAL_TYPE edges from nodes with a type's full name to it."""
    users = graph.nodes.where("type_full_name IS NOT NULL").select("graph_id", F.col("id").alias("src"), F.col("type_full_name").alias("name"))
    return _link(graph, users, _named(graph, "TYPE", "full_name", "dst"), "EVAL_TYPE")


def type_hierarchy(graph: Graph) -> DataFrame:
    """INHERITS_FROM edges from declarations to the types they name."""
    subs = graph.nodes.where("label = 'TYPE_DECL'").select("graph_id", F.col("id").alias("src"), F.explode("inherits_from").alias("name"))
    return _link(graph, subs, _named(graph, "TYPE", "full_name", "dst"), "INHERITS_FROM")


def aliases(graph: Graph) -> DataFrame:
    return _link(graph, _named(graph, "TYPE_DECL", "alias_type_full_name", "src"), _named(graph, "TYPE", "full_name", "dst"), "ALIAS_OF")


def method_refs(graph: Graph) -> DataFrame:
    return _link(graph, _named(graph, "METHOD_REF", "method_full_name", "src"), _named(graph, "METHOD", "full_name", "dst"), "REF")


def static_calls(graph: Graph) -> DataFrame:
    """CALL edges by exact full name, for calls that are not dispatched dynamically."""
    calls = graph.nodes.where("label = 'CALL' AND method_full_name IS NOT NULL AND coalesce(dispatch_type, '') <> 'DYNAMIC_DISPATCH'").select("graph_id", F.col("id").alias("src"), F.col("method_full_name").alias("name"))
    return _link(graph, calls, _named(graph, "METHOD", "full_name", "dst"), "CALL")


def dynamic_calls(graph: Graph) -> DataFrame:
    """CALL edges of dynamic calls: methods of the declaring type and all its subtypes with the callee's name and signature;
    internal ones if there are any, and what the full name itself leads to where nothing else is found."""
    m = graph.nodes.where("label = 'METHOD'").select("graph_id", F.col("id").alias("mid"), F.col("full_name").alias("mfull"), F.col("name").alias("mname"), F.coalesce("signature", F.lit("")).alias("msig"), F.coalesce("is_external", F.lit(False)).alias("ext"))
    own = graph.etype("AST").select("graph_id", F.col("src").alias("decl"), F.col("dst").alias("mid"))
    decl = graph.nodes.where("label = 'TYPE_DECL'").select("graph_id", F.col("id").alias("decl"))
    of = m.join(own.join(decl, ["graph_id", "decl"], "left_semi"), ["graph_id", "mid"])
    up = graph.etype("INHERITS_FROM").select("graph_id", F.col("src").alias("sub"), F.col("dst").alias("typ")).join(graph.etype("REF").select("graph_id", F.col("src").alias("typ"), F.col("dst").alias("sup")), ["graph_id", "typ"])
    sub = Graph(graph.nodes, up.select("graph_id", F.col("sup").alias("src"), F.col("sub").alias("dst"), F.lit("SUB").alias("etype"), F.lit(None).cast("string").alias("variable"))).closure(["SUB"])
    family = sub.select("graph_id", F.col("id").alias("decl"), F.col("to").alias("d2")).unionByName(decl.select("graph_id", "decl", F.col("decl").alias("d2")))
    calls = graph.nodes.where("label = 'CALL' AND dispatch_type = 'DYNAMIC_DISPATCH' AND method_full_name IS NOT NULL").select("graph_id", F.col("id").alias("src"), F.col("method_full_name").alias("mfull"))
    base = calls.join(of.select("graph_id", "mfull", "decl", "mname", "msig"), ["graph_id", "mfull"])
    other = of.select("graph_id", F.col("decl").alias("d2"), "mname", "msig", F.col("mid").alias("dst"), "ext")
    found = base.join(family, ["graph_id", "decl"]).join(other, ["graph_id", "d2", "mname", "msig"]).select("graph_id", "src", "dst", "ext").distinct()
    inner = found.groupBy("graph_id", "src").agg(F.bool_or(~F.col("ext")).alias("has"))
    virtual = found.join(inner, ["graph_id", "src"]).where("NOT has OR NOT ext").select("graph_id", "src", "dst")
    rest = calls.join(virtual.select("graph_id", "src").distinct(), ["graph_id", "src"], "left_anti").join(m.select("graph_id", "mfull", F.col("mid").alias("dst")), ["graph_id", "mfull"]).select("graph_id", "src", "dst")
    return virtual.unionByName(rest).withColumn("etype", F.lit("CALL"))


def naive_calls(graph: Graph) -> DataFrame:
    """CALL edges by short name for calls that have none yet."""
    have = graph.etype("CALL").select("graph_id", "src").distinct()
    calls = _named(graph, "CALL", "name", "src").join(have, ["graph_id", "src"], "left_anti")
    return _link(graph, calls, _named(graph, "METHOD", "name", "dst"), "CALL")


def field_refs(graph: Graph) -> DataFrame:
    """REF edges from field accesses to the member of their base's type."""
    acc = graph.nodes.where(F.col("name").isin("<operator>.fieldAccess", "<operator>.indirectFieldAccess")).select("graph_id", F.col("id").alias("src"))
    arg = graph.etype("ARGUMENT").select("graph_id", "src", F.col("dst").alias("aid"))
    n = graph.nodes.select("graph_id", F.col("id").alias("aid"), "argument_index", "type_full_name", F.coalesce("canonical_name", "code").alias("field"))
    both = acc.join(arg, ["graph_id", "src"]).join(n, ["graph_id", "aid"])
    pair = both.groupBy("graph_id", "src").agg(F.max(F.when(F.col("argument_index") == 1, F.col("type_full_name"))).alias("typ"), F.max(F.when(F.col("argument_index") == 2, F.col("field"))).alias("name"))
    decl = graph.nodes.where("label = 'TYPE_DECL'").select("graph_id", F.col("id").alias("d"), F.col("full_name").alias("typ"))
    mem = graph.etype("AST").select("graph_id", F.col("src").alias("d"), F.col("dst").alias("mid")).join(graph.nodes.where("label = 'MEMBER'").select("graph_id", F.col("id").alias("mid"), "name"), ["graph_id", "mid"])
    return pair.join(decl, ["graph_id", "typ"]).join(mem, ["graph_id", "d", "name"]).select("graph_id", "src", F.col("mid").alias("dst"), F.lit("REF").alias("etype"))


def complete(graph: Graph) -> DataFrame:
    """(graph_id, ok): whether no BLOCK child of the global or outermost METHOD holds an UNKNOWN node."""
    m = graph.nodes.where("label = 'METHOD'").select("graph_id", F.col("id").alias("m"))
    b = graph.nodes.where("label = 'BLOCK'").select("graph_id", F.col("id").alias("b"))
    u = graph.nodes.where("label = 'UNKNOWN'").select("graph_id", F.col("id").alias("u"))
    e = graph.etype("AST").select("graph_id", "src", "dst")
    blocks = e.join(m.withColumnRenamed("m", "src"), ["graph_id", "src"]).join(b.withColumnRenamed("b", "dst"), ["graph_id", "dst"]).select("graph_id", F.col("dst").alias("src"))
    bad = blocks.join(e, ["graph_id", "src"]).join(u.withColumnRenamed("u", "dst"), ["graph_id", "dst"]).select("graph_id").distinct().withColumn("bad", F.lit(True))
    return blocks.select("graph_id").distinct().join(bad, "graph_id", "left").select("graph_id", F.col("bad").isNull().alias("ok"))


def layer(graph: Graph, names: list[str]) -> Graph:
    """The graph with the edges of some passes, in order; a pass that adds nodes too returns the new graph."""
    for n in names:
        out = globals()[n](graph)
        graph = out if isinstance(out, Graph) else graph.with_edges(out)
    return graph


#: The layers and the passes of each, in the order in which they build on each other.
LAYERS = {
    "base": ["files", "namespaces", "type_stubs", "method_stubs", "parameter_index", "output_parameters", "contains", "type_refs", "eval_types"],
    "control_flow": ["dominators", "post_dominators", "control_dependence"],
    "type_relations": ["type_hierarchy", "aliases", "field_refs"],
    "call_graph": ["method_refs", "static_calls", "dynamic_calls", "naive_calls"],
}
