"""Views of program graphs: contracted control flow, call graph, type hierarchy, source excerpts, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.functions.text import escape_html
from codequarry.graph.model import CFG_NODE, KEY, Graph
from codequarry.graph.steps import Cpg, Steps

# Labels that a view of the control flow hides, but for identifiers that are a control structure's condition.
HIDDEN = ["LITERAL", "IDENTIFIER", "BLOCK", "CONTROL_STRUCTURE", "JUMP_TARGET", "METHOD_PARAMETER_IN"]


def _hidden(graph: Graph) -> DataFrame:
    cpg = Cpg(graph)
    shown = cpg.identifier().where_step(lambda t: t.in_("AST", label="CONTROL_STRUCTURE")).df.select(*KEY)
    return graph.nodes.where(F.col("label").isin(HIDDEN)).select(*KEY).join(shown, KEY, "left_anti")


def control_flow_view(graph: Graph) -> DataFrame:
    """(graph_id, method, src, dst): each method's control flow with hidden nodes contracted: an edge from every shown node to
    those that it reaches over hidden ones only. The method, its return and its parameters belong to it."""
    own = graph.etype("CONTAINS").select("graph_id", F.col("src").alias("method"), F.col("dst").alias("id"))
    parts = graph.etype("AST").select("graph_id", F.col("src").alias("method"), F.col("dst").alias("id"))
    ends = graph.nodes.where(F.col("label").isin("METHOD_RETURN", "METHOD_PARAMETER_IN")).select(*KEY)
    methods = graph.nodes.where("label = 'METHOD'").select("graph_id", F.col("id").alias("method"))
    body = own.join(graph.nodes.where(F.col("label").isin(CFG_NODE)).select(*KEY), KEY, "left_semi")
    inside = body.unionByName(parts.join(ends, KEY, "left_semi")).join(methods, ["graph_id", "method"], "left_semi").unionByName(methods.select("graph_id", "method", F.col("method").alias("id"))).distinct()
    hidden = _hidden(graph).withColumn("_h", F.lit(True))
    mine = inside.join(hidden, KEY, "left").select("graph_id", "method", "id", F.coalesce("_h", F.lit(False)).alias("h"))
    e = graph.etype("CFG").select("graph_id", "src", "dst")
    e = e.join(mine.select("graph_id", "method", F.col("id").alias("src"), F.col("h").alias("hs")), ["graph_id", "src"])
    e = e.join(mine.select("graph_id", "method", F.col("id").alias("dst"), F.col("h").alias("hd")), ["graph_id", "method", "dst"])
    # a node of two methods is two nodes here
    name = lambda c: F.xxhash64("method", c)
    over = Graph(graph.nodes, e.where("hs").select("graph_id", name("src").alias("src"), name("dst").alias("dst"), F.lit("CFG").alias("etype"), F.lit(None).cast("string").alias("variable")))
    far = over.pairs(["CFG"]).select("graph_id", F.col("id").alias("_a"), F.col("to").alias("_b"))
    ids = mine.where("NOT h").select("graph_id", "method", F.col("id").alias("dst")).withColumn("_b", name("dst"))
    first = e.where("NOT hs")
    near = first.where("NOT hd").select("graph_id", "method", "src", "dst")
    through = first.where("hd").select("graph_id", "src", name("dst").alias("_a")).join(far, ["graph_id", "_a"]).join(ids, ["graph_id", "_b"]).select("graph_id", "method", "src", "dst")
    return near.unionByName(through).distinct()


def call_graph(graph: Graph) -> DataFrame:
    """(graph_id, src, dst, label): methods that call each other, labelled with how the call is dispatched."""
    t = Cpg(graph).method().keeping("_m").call_out().withcol("_d", F.regexp_replace("dispatch_type", "_DISPATCH$", "")).out("CALL", label="METHOD")
    return t.df.select("graph_id", F.col("_m.id").alias("src"), F.col("id").alias("dst"), F.col("_d").alias("label")).distinct()


def type_hierarchy(graph: Graph) -> DataFrame:
    """(graph_id, src, dst): a type to each type whose declaration inherits from it."""
    t = Cpg(graph).type_decl().keeping("_d").out("INHERITS_FROM")
    base = t.df.select("graph_id", F.col("_d.id").alias("decl"), F.col("id").alias("src"))
    types = Cpg(graph).type_decl().keeping("_d").in_("REF", label="TYPE").df.select("graph_id", F.col("_d.id").alias("decl"), F.col("id").alias("dst"))
    return base.join(types, ["graph_id", "decl"]).select("graph_id", "src", "dst").distinct()


def dot_lines(edges: DataFrame, graph: Graph, by: list[str] | None = None) -> DataFrame:
    """(graph_id, ..., k, a, b, line): the lines of DOT texts, a row each, so that a graph of any size can be written sorted by
    (graph_id, ..., k, a, b): nodes at the ends of edges first. by names further columns that tell the texts apart."""
    by = ["graph_id", *(by or [])]
    ends = edges.select(*by, F.explode(F.array("src", "dst")).alias("id")).distinct()
    title = F.concat_ws(", ", "label", F.when(F.col("label").isin("METHOD", "MEMBER"), F.col("name")).otherwise(F.col("code")))
    n = ends.join(graph.nodes.select(*KEY, title.alias("_t")), KEY)
    n = n.select(*by, F.lit(0).alias("k"), F.col("id").alias("a"), F.lit(0).cast("long").alias("b"), F.concat(F.lit('"'), "id", F.lit('" [label = <'), escape_html(F.col("_t")), F.lit("> ]")).alias("line"))
    tag = F.concat(F.lit(' [ label = "'), escape_html(F.col("label")), F.lit('" ]')) if "label" in edges.columns else F.lit(" ")
    e = edges.select(*by, F.lit(1).alias("k"), F.col("src").alias("a"), F.col("dst").alias("b"), F.concat(F.lit('  "'), "src", F.lit('" -> "'), "dst", F.lit('"'), tag).alias("line"))
    return n.unionByName(e)


def excerpt(t: Steps) -> DataFrame:
    """(graph_id, id, dump): the source of the method that an element lies in, an arrow with the method's full name behind its
    first line; empty without content."""
    own = t.label("METHOD").keeping("_n")
    rest = t.where("label <> 'METHOD'")
    local = rest.label("LOCAL").keeping("_n").nearest("METHOD")
    other = rest.is_expression().keeping("_n").method()
    m = own.union(other).union(local)
    text = m.content().select("graph_id", "id", "content").distinct()
    rows = m.df.select("graph_id", F.col("_n.id").alias("_el"), "id", "full_name").join(text, KEY, "left")
    first, more = F.regexp_extract("content", r"^([^\r\n]*)", 1), F.regexp_extract("content", r"^[^\r\n]*((?s:.*))$", 1)
    dump = F.concat(first, F.lit(" /* <=== "), F.coalesce("full_name", F.lit("")), F.lit(" */ "), more)
    return rows.select("graph_id", F.col("_el").alias("id"), F.coalesce(dump, F.lit("")).alias("dump"))


def statement_count(graph: Graph) -> DataFrame:
    """(graph_id, n): expressions right below the bodies of methods."""
    return Cpg(graph).method().top_level_expressions().df.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n"))


def sliced_methods(graph: Graph, file: str | None = None, method: str | None = None, parameter: str | None = None, annotation: str | None = None) -> Steps:
    """The methods that a slice looks at: internal ones whose file, name, some parameter's type and some annotation's full name
    match the expressions that are given."""
    m = Cpg(graph).method().where("NOT coalesce(is_external, false)")
    m = m if file is None else m.matching("filename", file)
    m = m if method is None else m.matching("name", method)
    m = m if parameter is None else m.where_step(lambda t: t.parameters().matching("type_full_name", parameter))
    return m if annotation is None else m.where_step(lambda t: t.annotations().matching("full_name", annotation))


def calls_outside(t: Steps) -> Steps:
    """Calls of external methods."""
    return t.label("CALL").where_step(lambda c: c.out("CALL", label="METHOD").where("is_external"))


def type_summary(graph: Graph) -> DataFrame:
    """(graph_id, id, full_name, fields, procedures): members with their types, and methods by full name, of each internal type
    declaration; both sorted."""
    t = Cpg(graph).type_decl().where("NOT coalesce(is_external, false)")
    f = t.keeping("_t").out("AST", label="MEMBER").df.groupBy("_t").agg(F.array_sort(F.collect_list(F.concat_ws(":", "name", "type_full_name"))).alias("fields"))
    p = t.keeping("_t").out("AST", label="METHOD").df.groupBy("_t").agg(F.array_sort(F.collect_list("full_name")).alias("procedures"))
    rows = t.df.select(F.struct(*KEY).alias("_t"), "full_name").distinct().join(f, "_t", "left").join(p, "_t", "left")
    none = F.expr("cast(array() as array<string>)")
    return rows.select("_t.graph_id", "_t.id", "full_name", F.coalesce("fields", none).alias("fields"), F.coalesce("procedures", none).alias("procedures"))


def last_expression(graph: Graph) -> DataFrame:
    """(graph_id, block, id): the last child of each block by order that is neither a local nor a method; ties to the larger id."""
    t = Cpg(graph).all().label("BLOCK").keeping("_b").out("AST").where("label NOT IN ('LOCAL', 'METHOD')")
    return t.df.groupBy("_b").agg(F.max(F.struct("order", "id")).alias("m")).select("_b.graph_id", F.col("_b.id").alias("block"), F.col("m.id").alias("id"))
