"""Text forms of graphs and feature vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.functions.text import escape_html
from codequarry.graph.model import KEY, Graph

#: Views of a graph by the edge types they show.
VIEWS = {"ast": ["AST"], "cfg": ["CFG"], "cdg": ["CDG"], "ddg": ["REACHING_DEF"], "pdg": ["CDG", "REACHING_DEF"], "cpg14": ["AST", "CFG", "CDG", "REACHING_DEF"], "call_graph": ["CALL"], "type_hierarchy": ["INHERITS_FROM"], "all": []}


def _title(label: Column) -> Column:
    name = F.when(F.col("label").isin("METHOD", "MEMBER"), F.col("name")).otherwise(F.col("code"))
    return F.concat_ws(", ", label, name)


def subgraph(graph: Graph, view: str) -> Graph:
    """The edges of a view and the nodes at their ends; others are pruned."""
    e = graph.etype(*VIEWS[view])
    ends = e.select("graph_id", F.explode(F.array("src", "dst")).alias("id")).distinct()
    return Graph(graph.nodes.join(ends, KEY, "left_semi"), e)


def dot(graph: Graph, view: str, name: str = "g") -> DataFrame:
    """(graph_id, dot): one DOT text for each graph; nodes by id, then edges by ends."""
    g = subgraph(graph, view)
    n = g.nodes.select("graph_id", F.lit(0).alias("k"), F.col("id").alias("a"), F.lit(0).cast("long").alias("b"), F.concat(F.lit('"'), F.col("id"), F.lit('" [label = <'), escape_html(F.coalesce(_title(F.col("label")), F.lit(""))), F.lit("> ]")).alias("line"))
    e = g.edges.select("graph_id", F.lit(1).alias("k"), F.col("src").alias("a"), F.col("dst").alias("b"), F.concat(F.lit('  "'), F.col("src"), F.lit('" -> "'), F.col("dst"), F.lit('"'), F.when(F.coalesce("variable", F.lit("")) != "", F.concat(F.lit(' [ label = "'), escape_html(F.col("variable")), F.lit('" ]'))).otherwise(F.lit(" "))).alias("line"))
    lines = n.unionByName(e).groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct("k", "a", "b", "line"))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return lines.select("graph_id", F.concat(F.lit(f'digraph "{name}" {{\nnode [shape="rect"];\n'), body, F.lit("\n}\n")).alias("dot"))


def edge_list(graph: Graph) -> DataFrame:
    return graph.edges.select("graph_id", "src", "dst", "etype")


def neo4j_csv(graph: Graph) -> tuple[DataFrame, DataFrame]:
    """Node and edge tables with the columns that a bulk import expects."""
    skip = {"graph_id", "id", "label", "inherits_from"}
    nodes = graph.nodes.select(F.concat_ws("-", "graph_id", "id").alias(":ID"), F.col("label").alias(":LABEL"), *[F.col(f"`{c}`") for c in graph.nodes.columns if c not in skip])
    key = lambda c: F.concat_ws("-", "graph_id", c)
    return nodes, graph.edges.select(key("src").alias(":START_ID"), key("dst").alias(":END_ID"), F.col("etype").alias(":TYPE"), "variable")


def graphml(graph: Graph) -> DataFrame:
    """(graph_id, xml)."""
    esc = lambda c: escape_html(F.coalesce(c, F.lit("")))
    n = graph.nodes.select("graph_id", F.lit(0).alias("k"), F.col("id").alias("a"), F.lit(0).cast("long").alias("b"), F.concat(F.lit('<node id="'), F.col("id"), F.lit('"><data key="label">'), F.col("label"), F.lit('</data><data key="code">'), esc(F.col("code")), F.lit("</data></node>")).alias("line"))
    e = graph.edges.select("graph_id", F.lit(1).alias("k"), F.col("src").alias("a"), F.col("dst").alias("b"), F.concat(F.lit('<edge source="'), F.col("src"), F.lit('" target="'), F.col("dst"), F.lit('"><data key="etype">'), F.col("etype"), F.lit("</data></edge>")).alias("line"))
    lines = n.unionByName(e).groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct("k", "a", "b", "line"))).alias("l"))
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n<key id="label" for="node" attr.name="label" attr.type="string"/>\n<key id="code" for="node" attr.name="code" attr.type="string"/>\n<key id="etype" for="edge" attr.name="etype" attr.type="string"/>\n<graph id="G" edgedefault="directed">\n'
    return lines.select("graph_id", F.concat(F.lit(head), F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n</graph>\n</graphml>\n")).alias("xml"))


def graphson(graph: Graph) -> DataFrame:
    """(graph_id, json): vertices and edges of each graph."""
    n = graph.nodes.groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct("id", "label", "name", "code", F.col("line_number")))).alias("vertices"))
    e = graph.edges.groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct(F.col("src").alias("outV"), F.col("dst").alias("inV"), F.col("etype").alias("label"), "variable"))).alias("edges"))
    return n.join(e, "graph_id", "left").select("graph_id", F.to_json(F.struct("vertices", "edges")).alias("json"))


def record_json(graph: Graph) -> DataFrame:
    """(graph_id, payload): graphs in the exchange form, an edge's source as outNode and its target as inNode."""
    n = graph.nodes.groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct("id", F.col("label").alias("_label"), "name", "code", "order", F.col("line_number").alias("lineNumber"), F.col("type_full_name").alias("typeFullName"), F.col("control_structure_type").alias("controlStructureType")))).alias("nodes"))
    e = graph.edges.groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct(F.col("dst").alias("inNode"), F.col("src").alias("outNode"), "etype", "variable"))).alias("edges"))
    return n.join(e, "graph_id", "left").select("graph_id", F.to_json(F.struct("nodes", F.coalesce("edges", F.expr("cast(array() as array<struct<inNode:bigint,outNode:bigint,etype:string,variable:string>>)")).alias("edges"))).alias("payload"))


def split_by_method(graph: Graph) -> tuple[DataFrame, DataFrame]:
    """Nodes with the method that holds them, and the edges whose two ends lie in one method."""
    m = graph.etype("CONTAINS").join(graph.nodes.where("label = 'METHOD'").select("graph_id", F.col("id").alias("src")), ["graph_id", "src"], "left_semi").select("graph_id", F.col("src").alias("method"), F.col("dst").alias("id"))
    m = m.unionByName(graph.nodes.where("label = 'METHOD'").select("graph_id", F.col("id").alias("method"), "id"))
    e = graph.edges.join(m.select("graph_id", F.col("id").alias("src"), F.col("method").alias("ms")), ["graph_id", "src"]).join(m.select("graph_id", F.col("id").alias("dst"), F.col("method").alias("md")), ["graph_id", "dst"]).where("ms = md")
    return graph.nodes.join(m, KEY), e.withColumnRenamed("ms", "method").drop("md")


def adjacency(graph: Graph) -> DataFrame:
    """(graph_id, id, to): the different neighbours of each node over edges of any type, sorted."""
    return graph.edges.groupBy("graph_id", F.col("src").alias("id")).agg(F.array_sort(F.collect_set("dst")).alias("to"))


def degrees(graph: Graph) -> DataFrame:
    o = graph.edges.groupBy("graph_id", F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n_out"))
    i = graph.edges.groupBy("graph_id", F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n_in"))
    out = graph.nodes.select(*KEY).join(o, KEY, "left").join(i, KEY, "left")
    return out.select(*KEY, F.coalesce("n_out", F.lit(0)).alias("n_out"), F.coalesce("n_in", F.lit(0)).alias("n_in"))


def embedding(graph: Graph, dimensions: int = 1 << 16) -> DataFrame:
    """(graph_id, vector): a sparse vector for each graph, hashed symbol -> count; symbols are label and code of a node."""
    symbol = F.concat_ws("|", "label", F.coalesce("name", "code"))
    n = graph.nodes.select("graph_id", F.pmod(F.hash(symbol), F.lit(dimensions)).alias("d")).groupBy("graph_id", "d").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return n.groupBy("graph_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("d", "n")))).alias("vector"))


def embedding_dictionary(graph: Graph, dimensions: int = 1 << 16) -> DataFrame:
    """(d, symbol): what each dimension stands for."""
    symbol = F.concat_ws("|", "label", F.coalesce("name", "code"))
    return graph.nodes.select(F.pmod(F.hash(symbol), F.lit(dimensions)).alias("d"), symbol.alias("symbol")).distinct()
