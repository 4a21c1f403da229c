"""Queries of the graph operators over the provided program graphs, beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.graph import dataflow, exports, passes, scanners
from codequarry.graph.model import KEY, Graph
from codequarry.graph.steps import Cpg
from codequarry.plans.pipeline_queries import _graph
from codequarry.session import Scratch, table


_graphs: dict[tuple[str, str], Graph] = {}


def graph_of(spark: SparkSession, d: str) -> Graph:
    """The graphs of raw_record, written as node and edge tables once a session for each folder of tables."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _graphs:
        scratch = Scratch(spark)
        g = Graph.from_records(table(spark, d, "raw_record"), scratch)
        _graphs[key] = Graph(scratch.save(g.nodes), scratch.save(g.edges))
    return _graphs[key]


def _with_contains(g: Graph) -> Graph:
    return g.with_edges(Scratch(g.nodes.sparkSession).save(passes.contains(g)))


def q(name: str):
    def add(f):
        QUERIES[f"graph_{name}"] = lambda spark, d, f=f: f(graph_of(spark, d))
        return f

    return add


QUERIES: dict = {}
ORACLES: dict[str, str] = {}

N = f"""n AS MATERIALIZED (SELECT record_id AS graph_id, (x->>'id')::BIGINT AS id, x->>'_label' AS label, x->>'name' AS name, x->>'code' AS code, (x->>'order')::INTEGER AS ord, (x->>'lineNumber')::INTEGER AS line,
    x->>'typeFullName' AS typ, x->>'controlStructureType' AS cst, (x->>'isExternal')::BOOLEAN AS ext FROM {_graph('nodes')} WHERE x->>'id' IS NOT NULL)"""
E = f"""e AS MATERIALIZED (SELECT record_id AS graph_id, (x->>'outNode')::BIGINT AS src, (x->>'inNode')::BIGINT AS dst, x->>'etype' AS etype, x->>'variable' AS variable FROM {_graph('edges')})"""


def _closure(etype: str, name: str = "c", reverse: bool = False) -> str:
    a, b = ("dst", "src") if reverse else ("src", "dst")
    return f"""{name} AS (SELECT graph_id, {a} AS f, {b} AS t, 1 AS depth FROM e WHERE etype = '{etype}' UNION SELECT {name}.graph_id, {name}.f, e.{b}, depth + 1 FROM {name} JOIN e ON e.graph_id = {name}.graph_id AND e.{a} = {name}.t AND e.etype = '{etype}' WHERE depth < 100)"""


def sql(name: str, text: str, recursive: str = "") -> None:
    ORACLES[f"graph_{name}"] = f"WITH {'RECURSIVE ' if recursive else ''}{N}, {E}{', ' + recursive if recursive else ''} {text}"


def ids(t) -> DataFrame:
    return t.df.select(*KEY)


@q("label_counts")
def _(g):
    return Cpg(g).all().group_count("label")


sql("label_counts", "SELECT label, count(*) AS n FROM n GROUP BY 1")


@q("edge_counts")
def _(g):
    return g.edges.groupBy("etype").agg(F.count(F.lit(1)).alias("n"))


sql("edge_counts", "SELECT etype, count(*) AS n FROM e GROUP BY 1")

for _name, _label in {"call": "CALL", "method": "METHOD", "identifier": "IDENTIFIER", "control_structure": "CONTROL_STRUCTURE", "ret": "RETURN"}.items():
    q(f"starter_{_name}")(lambda g, n=_name: ids(getattr(Cpg(g), n)()))
    sql(f"starter_{_name}", f"SELECT graph_id, id FROM n WHERE label = '{_label}'")
for _name, _type in {"if_block": "IF", "for_block": "FOR", "while_block": "WHILE", "switch_block": "SWITCH"}.items():
    q(_name)(lambda g, n=_name: ids(getattr(Cpg(g), n)()))
    sql(_name, f"SELECT graph_id, id FROM n WHERE label = 'CONTROL_STRUCTURE' AND cst = '{_type}'")


@q("method_by_name")
def _(g):
    return ids(Cpg(g).method(".*_(open|load|read).*|.*Init.*"))


sql("method_by_name", "SELECT graph_id, id FROM n WHERE label = 'METHOD' AND regexp_full_match(name, '.*_(open|load|read).*|.*Init.*')")


@q("ast_children")
def _(g):
    return ids(Cpg(g).method().ast_children())


sql("ast_children", "SELECT n.graph_id, n.id FROM n m JOIN e ON e.graph_id = m.graph_id AND e.src = m.id AND etype = 'AST' JOIN n ON n.graph_id = e.graph_id AND n.id = e.dst WHERE m.label = 'METHOD'")


@q("ast_parent")
def _(g):
    return ids(Cpg(g).identifier().ast_parent())


sql("ast_parent", "SELECT n.graph_id, n.id FROM n m JOIN e ON e.graph_id = m.graph_id AND e.dst = m.id AND etype = 'AST' JOIN n ON n.graph_id = e.graph_id AND n.id = e.src WHERE m.label = 'IDENTIFIER'")


@q("ast_siblings")
def _(g):
    return ids(Cpg(g).ret().ast_siblings())


sql("ast_siblings", "SELECT n.graph_id, n.id FROM n m JOIN e a ON a.graph_id = m.graph_id AND a.dst = m.id AND a.etype = 'AST' JOIN e b ON b.graph_id = a.graph_id AND b.src = a.src AND b.etype = 'AST' AND b.dst <> m.id JOIN n ON n.graph_id = b.graph_id AND n.id = b.dst WHERE m.label = 'RETURN'")


@q("ast_descendants")
def _(g):
    return Cpg(g).method().ast().df.groupBy("graph_id", "label").agg(F.count(F.lit(1)).alias("n"))


sql("ast_descendants", "SELECT graph_id, label, count(*) AS n FROM (SELECT c.graph_id, d.label FROM c JOIN n m ON m.graph_id = c.graph_id AND m.id = c.f AND m.label = 'METHOD' JOIN n d ON d.graph_id = c.graph_id AND d.id = c.t UNION ALL SELECT graph_id, label FROM n WHERE label = 'METHOD') GROUP BY 1, 2", _closure("AST"))


@q("in_ast")
def _(g):
    return ids(Cpg(g).identifier().in_ast())


sql("in_ast", "SELECT graph_id, t AS id FROM c JOIN n USING (graph_id) WHERE n.id = c.t AND (graph_id, f) IN (SELECT graph_id, id FROM n WHERE label = 'IDENTIFIER') UNION ALL SELECT graph_id, id FROM n WHERE label = 'IDENTIFIER'", _closure("AST", reverse=True))


@q("parent_block")
def _(g):
    return ids(Cpg(g).identifier().parent_block())


sql("parent_block", "SELECT graph_id, arg_min(t, depth) AS id FROM c JOIN n USING (graph_id) WHERE n.id = c.t AND n.label = 'BLOCK' AND (graph_id, f) IN (SELECT graph_id, id FROM n WHERE label = 'IDENTIFIER') GROUP BY graph_id, f", _closure("AST", reverse=True))


@q("depth")
def _(g):
    return Cpg(g).method().depth()


sql("depth", "SELECT m.graph_id, m.id, coalesce(max(depth), 0)::INTEGER AS depth FROM n m LEFT JOIN c ON c.graph_id = m.graph_id AND c.f = m.id WHERE m.label = 'METHOD' GROUP BY 1, 2", _closure("AST"))


@q("control_depth")
def _(g):
    return Cpg(g).method().depth(F.col("label") == "CONTROL_STRUCTURE")


sql("control_depth", """SELECT m.graph_id, m.id, coalesce(max(k), 0)::INTEGER AS depth FROM n m LEFT JOIN r ON r.graph_id = m.graph_id AND r.root = m.id WHERE m.label = 'METHOD' GROUP BY 1, 2""",
    """r AS (SELECT graph_id, id AS root, id AS t, 0 AS k FROM n WHERE label = 'METHOD' UNION ALL SELECT r.graph_id, root, e.dst, k + (n.label = 'CONTROL_STRUCTURE')::INT FROM r JOIN e ON e.graph_id = r.graph_id AND e.src = r.t AND etype = 'AST' JOIN n ON n.graph_id = e.graph_id AND n.id = e.dst)""")  # fmt: skip


@q("cfg_next")
def _(g):
    return ids(Cpg(g).call().cfg_next(2))


sql("cfg_next", """SELECT graph_id, id FROM (SELECT a.graph_id, a.dst AS id FROM n m JOIN e a ON a.graph_id = m.graph_id AND a.src = m.id AND a.etype = 'CFG' WHERE m.label = 'CALL'
    UNION ALL SELECT a.graph_id, b.dst FROM n m JOIN e a ON a.graph_id = m.graph_id AND a.src = m.id AND a.etype = 'CFG' JOIN e b ON b.graph_id = a.graph_id AND b.src = a.dst AND b.etype = 'CFG' WHERE m.label = 'CALL') JOIN n USING (graph_id, id) WHERE label <> 'METHOD_RETURN'""")


@q("arguments")
def _(g):
    return ids(Cpg(g).call().argument())


sql("arguments", "SELECT n.graph_id, n.id FROM n c JOIN e ON e.graph_id = c.graph_id AND e.src = c.id AND etype = 'ARGUMENT' JOIN n ON n.graph_id = e.graph_id AND n.id = e.dst WHERE c.label = 'CALL'")


@q("in_call")
def _(g):
    return ids(Cpg(g).identifier().in_call())


sql("in_call", "SELECT graph_id, id FROM (SELECT c.graph_id, c.id, c.label, row_number() OVER (PARTITION BY e.graph_id, e.dst ORDER BY c.id) AS rn FROM e JOIN n i ON i.graph_id = e.graph_id AND i.id = e.dst AND i.label = 'IDENTIFIER' JOIN n c ON c.graph_id = e.graph_id AND c.id = e.src WHERE etype = 'ARGUMENT') WHERE rn = 1 AND label = 'CALL'")


@q("where_step")
def _(g):
    return ids(Cpg(g).method().where_step(lambda t: t.reached(["AST"], label="RETURN")))


sql("where_step", "SELECT graph_id, id FROM n m WHERE label = 'METHOD' AND EXISTS (SELECT 1 FROM c JOIN n r ON r.graph_id = c.graph_id AND r.id = c.t WHERE c.graph_id = m.graph_id AND c.f = m.id AND r.label = 'RETURN')", _closure("AST"))


@q("where_not_step")
def _(g):
    return ids(Cpg(g).call().where_not_step(lambda t: t.out("ARGUMENT")))


sql("where_not_step", "SELECT graph_id, id FROM n c WHERE label = 'CALL' AND NOT EXISTS (SELECT 1 FROM e JOIN n a ON a.graph_id = e.graph_id AND a.id = e.dst WHERE e.graph_id = c.graph_id AND e.src = c.id AND etype = 'ARGUMENT')")


@q("or_steps")
def _(g):
    return ids(Cpg(g).control_structure().or_(lambda t: t.out("ARGUMENT"), lambda t: t.out("CFG", label="RETURN")))


sql("or_steps", "SELECT graph_id, id FROM n c WHERE label = 'CONTROL_STRUCTURE' AND EXISTS (SELECT 1 FROM e JOIN n a ON a.graph_id = e.graph_id AND a.id = e.dst WHERE e.graph_id = c.graph_id AND e.src = c.id AND (etype = 'ARGUMENT' OR (etype = 'CFG' AND a.label = 'RETURN')))")


@q("when_true")
def _(g):
    return ids(Cpg(g).control_structure().when_true())


sql("when_true", "SELECT n.graph_id, n.id FROM n c JOIN e ON e.graph_id = c.graph_id AND e.src = c.id JOIN n ON n.graph_id = e.graph_id AND n.id = e.dst WHERE c.label = 'CONTROL_STRUCTURE' AND n.ord = 2")


@q("repr")
def _(g):
    return Cpg(g).all().repr()


sql("repr", "SELECT graph_id, id, CASE WHEN label IN ('METHOD', 'MEMBER') THEN name ELSE code END AS repr FROM n")


@q("contains")
def _(g):
    return passes.contains(g).select("graph_id", "src", "dst")


sql("contains", "SELECT graph_id, arg_min(f, depth) AS src, t AS dst FROM c JOIN n m USING (graph_id) JOIN n d USING (graph_id) WHERE m.id = c.f AND m.label IN ('METHOD', 'TYPE_DECL', 'FILE') AND d.id = c.t AND d.label NOT IN ('METHOD', 'METHOD_RETURN', 'METHOD_PARAMETER_IN') GROUP BY graph_id, t", _closure("AST"))


@q("idom")
def _(g):
    return passes.dominators(_with_contains(g)).select("graph_id", "src", "dst")


#: d dominates n where n is not reached once d is taken out; the immediate dominator is dominated by all others.
sql("idom", """SELECT graph_id, arg_max(d, k) AS src, v AS dst FROM (SELECT x.graph_id, x.d, x.v, (SELECT count(*) FROM dom y WHERE y.graph_id = x.graph_id AND y.v = x.d) AS k FROM dom x) GROUP BY graph_id, v""",
    """r0 AS (SELECT graph_id, min(id) AS m FROM n WHERE label = 'METHOD' GROUP BY 1), f AS (SELECT graph_id, src, dst FROM e WHERE etype = 'CFG'),
    reach AS (SELECT graph_id, m AS v FROM r0 WHERE (graph_id, m) IN (SELECT graph_id, src FROM f) UNION SELECT f.graph_id, f.dst FROM reach JOIN f ON f.graph_id = reach.graph_id AND f.src = reach.v),
    cut AS (SELECT a.graph_id, a.v AS d, r0.m AS v FROM reach a JOIN r0 USING (graph_id) WHERE a.v <> r0.m UNION SELECT cut.graph_id, cut.d, f.dst FROM cut JOIN f ON f.graph_id = cut.graph_id AND f.src = cut.v AND f.dst <> cut.d),
    dom AS (SELECT a.graph_id, a.v AS d, b.v FROM reach a JOIN reach b USING (graph_id) JOIN r0 USING (graph_id) WHERE a.v <> b.v AND b.v <> r0.m AND (a.v = r0.m OR NOT EXISTS (SELECT 1 FROM cut c WHERE c.graph_id = a.graph_id AND c.d = a.v AND c.v = b.v)))""")  # fmt: skip


@q("reaching_definitions")
def _(g):
    return dataflow.reaching_definitions(_with_contains(g)).select("graph_id", "src", "dst", "variable")


sql("reaching_definitions", "SELECT DISTINCT r.graph_id, r.node AS src, u.node AS dst, r.var AS variable FROM reach r JOIN uses u ON u.graph_id = r.graph_id AND u.loc = r.x AND u.var = r.var AND u.node <> r.node",
    """f AS (SELECT graph_id, src, dst FROM e WHERE etype = 'CFG'),
    uses AS (SELECT e.graph_id, e.src AS loc, e.dst AS node, a.label, CASE WHEN a.label = 'IDENTIFIER' THEN coalesce(a.name, a.code) ELSE a.code END AS var FROM e JOIN n a ON a.graph_id = e.graph_id AND a.id = e.dst WHERE etype = 'ARGUMENT' AND a.label <> 'FIELD_IDENTIFIER'),
    defs AS (SELECT uses.* FROM uses JOIN n k ON k.graph_id = uses.graph_id AND k.id = uses.loc AND k.label = 'CALL' WHERE uses.label = 'IDENTIFIER' AND var IS NOT NULL),
    reach AS (SELECT d.graph_id, d.node, d.var, f.dst AS x FROM defs d JOIN f ON f.graph_id = d.graph_id AND f.src = d.loc
        UNION SELECT r.graph_id, r.node, r.var, f.dst FROM reach r JOIN f ON f.graph_id = r.graph_id AND f.src = r.x WHERE NOT EXISTS (SELECT 1 FROM defs k WHERE k.graph_id = r.graph_id AND k.loc = r.x AND k.var = r.var))""")  # fmt: skip


@q("ddg_closure")
def _(g):
    return g.closure(["REACHING_DEF"]).select("graph_id", "id", "to", "depth")


sql("ddg_closure", "SELECT graph_id, f AS id, t AS \"to\", min(depth)::INTEGER AS depth FROM c GROUP BY ALL", _closure("REACHING_DEF"))


@q("usage_slice")
def _(g):
    return dataflow.usage_slice(_with_contains(g), 2).select("graph_id", "method", "variable", "n_calls")


sql("usage_slice", """SELECT m.graph_id, m.id AS method, coalesce(i.name, i.code) AS variable, count(DISTINCT k.id) AS n_calls FROM e JOIN n i ON i.graph_id = e.graph_id AND i.id = e.dst AND i.label = 'IDENTIFIER'
    JOIN n k ON k.graph_id = e.graph_id AND k.id = e.src AND k.label = 'CALL' JOIN c ON c.graph_id = k.graph_id AND c.t = k.id JOIN n m ON m.graph_id = c.graph_id AND m.id = c.f AND m.label = 'METHOD'
    WHERE e.etype = 'ARGUMENT' AND coalesce(i.name, i.code) IS NOT NULL GROUP BY 1, 2, 3 HAVING n_calls >= 2""", _closure("AST"))  # fmt: skip


@q("backward_slice")
def _(g):
    return dataflow.backward_slice(Cpg(g).call().argument())[0].select(*KEY)


sql("backward_slice", "SELECT DISTINCT graph_id, id FROM (SELECT s.graph_id, s.id FROM s UNION ALL SELECT c.graph_id, c.t FROM c JOIN s ON s.graph_id = c.graph_id AND s.id = c.f) JOIN n USING (graph_id, id)",
    "s AS (SELECT DISTINCT e.graph_id, e.dst AS id FROM e JOIN n k ON k.graph_id = e.graph_id AND k.id = e.src AND k.label = 'CALL' WHERE etype = 'ARGUMENT'), " + _closure("REACHING_DEF", reverse=True))


@q("adjacency")
def _(g):
    return exports.adjacency(g).select("graph_id", "id", F.array_join("to", ",").alias("to"))


sql("adjacency", "SELECT graph_id, src AS id, array_to_string(list_sort(list_distinct(list(dst))), ',') AS \"to\" FROM e GROUP BY 1, 2")


@q("degrees")
def _(g):
    return exports.degrees(g)


sql("degrees", "SELECT graph_id, id, (SELECT count(*) FROM e WHERE e.graph_id = n.graph_id AND e.src = n.id) AS n_out, (SELECT count(*) FROM e WHERE e.graph_id = n.graph_id AND e.dst = n.id) AS n_in FROM n")


@q("subgraph_cfg")
def _(g):
    return exports.subgraph(g, "cfg").nodes.select(*KEY)


sql("subgraph_cfg", "SELECT graph_id, id FROM n WHERE EXISTS (SELECT 1 FROM e WHERE e.graph_id = n.graph_id AND etype = 'CFG' AND n.id IN (src, dst))")


@q("edge_list")
def _(g):
    return exports.edge_list(g)


sql("edge_list", "SELECT graph_id, src, dst, etype FROM e")


@q("dot")
def _(g):
    return exports.dot(g, "cfg").select("graph_id", F.length("dot").alias("chars"))


_ESC = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(10), '<BR/>')"
_TITLE = "concat_ws(', ', n.label, CASE WHEN n.label IN ('METHOD', 'MEMBER') THEN n.name ELSE n.code END)"
sql("dot", f"""SELECT graph_id, (length('digraph "g" {{' || chr(10) || 'node [shape="rect"];' || chr(10)) + sum(len) + count(*) - 1 + length(chr(10) || '}}' || chr(10)))::INTEGER AS chars FROM (
    SELECT n.graph_id, length('"' || n.id || '" [label = <' || {_ESC.format(_TITLE)} || '> ]') AS len FROM n WHERE EXISTS (SELECT 1 FROM e WHERE e.graph_id = n.graph_id AND etype = 'CFG' AND n.id IN (src, dst))
    UNION ALL SELECT graph_id, length('  "' || src || '" -> "' || dst || '"' || CASE WHEN coalesce(variable, '') <> '' THEN ' [ label = "' || {_ESC.format('variable')} || '" ]' ELSE ' ' END) FROM e WHERE etype = 'CFG') GROUP BY 1""")  # fmt: skip


@q("graphml")
def _(g):
    return exports.graphml(g).select("graph_id", F.length("xml").alias("chars"))


@q("graphson")
def _(g):
    return exports.graphson(g).select("graph_id", F.json_array_length(F.get_json_object("json", "$.vertices")).alias("n_nodes"))


sql("graphson", "SELECT graph_id, count(*)::INTEGER AS n_nodes FROM n GROUP BY 1")


@q("embedding")
def _(g):
    return exports.embedding(g).select("graph_id", F.aggregate(F.map_values("vector"), F.lit(0.0), lambda a, x: a + x).alias("total"))


sql("embedding", "SELECT graph_id, count(*)::DOUBLE AS total FROM n GROUP BY 1")


@q("complete")
def _(g):
    return passes.complete(g)


sql("complete", "SELECT DISTINCT e.graph_id, true AS ok FROM e JOIN n m ON m.graph_id = e.graph_id AND m.id = e.src AND m.label = 'METHOD' JOIN n b ON b.graph_id = e.graph_id AND b.id = e.dst AND b.label = 'BLOCK' WHERE etype = 'AST'")


@q("complexity_metrics")
def _(g):
    """Counts for each method: control structures, loops, returns, calls."""
    t = Cpg(g).method().keeping("_m").reached(["AST"])
    c = t.df.groupBy("_m.graph_id", "_m.id").agg(
        F.count_if(F.col("label") == "CONTROL_STRUCTURE").alias("n_control"), F.count_if(F.col("control_structure_type").isin("FOR", "DO", "WHILE")).alias("n_loop"),
        F.count_if(F.col("label") == "RETURN").alias("n_return"), F.count_if(F.col("label") == "CALL").alias("n_call"),
    )
    return c


sql("complexity_metrics", """SELECT c.graph_id, c.f AS id, count(*) FILTER (WHERE d.label = 'CONTROL_STRUCTURE') AS n_control, count(*) FILTER (WHERE d.cst IN ('FOR', 'DO', 'WHILE')) AS n_loop,
    count(*) FILTER (WHERE d.label = 'RETURN') AS n_return, count(*) FILTER (WHERE d.label = 'CALL') AS n_call FROM c JOIN n m ON m.graph_id = c.graph_id AND m.id = c.f AND m.label = 'METHOD' JOIN n d ON d.graph_id = c.graph_id AND d.id = c.t GROUP BY 1, 2""", _closure("AST"))  # fmt: skip

for _scan, _cond in {"too-high-complexity": "count(*) FILTER (WHERE d.label = 'CONTROL_STRUCTURE') > 4", "multiple-returns": "count(*) FILTER (WHERE d.label = 'RETURN') > 1", "too-many-loops": "count(*) FILTER (WHERE d.cst IN ('FOR', 'DO', 'WHILE')) > 4"}.items():
    _key = f"scan_{_scan.replace('-', '_')}"
    q(_key)(lambda g, s=_scan: ids(scanners.REGISTRY[s].run(Cpg(g))))
    sql(_key, f"SELECT c.graph_id, c.f AS id FROM c JOIN n m ON m.graph_id = c.graph_id AND m.id = c.f AND m.label = 'METHOD' AND NOT m.ext AND m.name <> '<global>' JOIN n d ON d.graph_id = c.graph_id AND d.id = c.t GROUP BY 1, 2 HAVING {_cond}", _closure("AST"))


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES
