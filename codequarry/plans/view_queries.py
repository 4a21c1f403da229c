"""Queries of graph views over the generated graphs of step_queries, beside their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry.graph import exports, views
from codequarry.graph.model import KEY
from codequarry.graph.steps import Cpg
from codequarry.plans import flow_queries, step_queries
from codequarry.plans.step_queries import CFGN, EXPR

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def q(name: str, f, sql: str, ctes: str = "") -> None:
    QUERIES[f"view_{name}"] = lambda spark, d: f(step_queries.built(spark, d))
    ORACLES[f"view_{name}"] = f"WITH RECURSIVE {step_queries._GRAPH_SQL}{', ' + ctes if ctes else ''} {sql}"


_HID = """hid AS (SELECT graph_id, id FROM n WHERE label IN ('LITERAL', 'IDENTIFIER', 'BLOCK', 'CONTROL_STRUCTURE', 'JUMP_TARGET', 'METHOD_PARAMETER_IN')
    AND NOT (label = 'IDENTIFIER' AND EXISTS (SELECT 1 FROM e JOIN n p ON p.graph_id = e.graph_id AND p.id = e.src AND p.label = 'CONTROL_STRUCTURE' WHERE e.graph_id = n.graph_id AND e.dst = n.id AND etype = 'AST')))"""
_CONTROL = f"""{_HID},
    ins AS (SELECT i.graph_id, i.m, i.id, EXISTS (SELECT 1 FROM hid WHERE hid.graph_id = i.graph_id AND hid.id = i.id) AS h FROM (
        SELECT e.graph_id, e.src AS m, e.dst AS id FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE (etype = 'CONTAINS' AND x.label IN {CFGN}) OR (etype = 'AST' AND x.label IN ('METHOD_RETURN', 'METHOD_PARAMETER_IN'))
        UNION SELECT graph_id, id, id FROM n) i JOIN n m ON m.graph_id = i.graph_id AND m.id = i.m AND m.label = 'METHOD'),
    fl AS (SELECT a.graph_id, a.m, a.id AS s, a.h AS hs, b.id AS x, b.h FROM ins a JOIN e ON e.graph_id = a.graph_id AND e.src = a.id AND etype = 'CFG' JOIN ins b ON b.graph_id = a.graph_id AND b.m = a.m AND b.id = e.dst),
    w AS (SELECT graph_id, m, s, x, h FROM fl WHERE NOT hs UNION SELECT w.graph_id, w.m, w.s, fl.x, fl.h FROM w JOIN fl ON fl.graph_id = w.graph_id AND fl.m = w.m AND fl.s = w.x WHERE w.h)"""
_CONTRACTED = "SELECT DISTINCT graph_id, m AS method, s AS src, x AS dst FROM w WHERE NOT w.h"
q("control_flow", views.control_flow_view, _CONTRACTED, _CONTROL)
QUERIES["view_control_flow_methods"] = lambda spark, d: views.control_flow_view(flow_queries.made(spark, d))
ORACLES["view_control_flow_methods"] = f"WITH RECURSIVE {flow_queries._SQL}, {_CONTROL} {_CONTRACTED}"
_CALLS = """cg AS (SELECT DISTINCT a.graph_id, a.src, b.dst, replace(c.dispatch_type, '_DISPATCH', '') AS label FROM e a JOIN n m ON m.graph_id = a.graph_id AND m.id = a.src AND m.label = 'METHOD' JOIN n c ON c.graph_id = a.graph_id AND c.id = a.dst AND c.label = 'CALL'
    JOIN e b ON b.graph_id = c.graph_id AND b.src = c.id AND b.etype = 'CALL' JOIN n t ON t.graph_id = b.graph_id AND t.id = b.dst AND t.label = 'METHOD' WHERE a.etype = 'CONTAINS')"""
q("call_graph", views.call_graph, "SELECT * FROM cg", _CALLS)
_TYPES = """th AS (SELECT DISTINCT i.graph_id, i.dst AS src, t.id AS dst FROM e i JOIN n d ON d.graph_id = i.graph_id AND d.id = i.src AND d.label = 'TYPE_DECL' JOIN e r ON r.graph_id = d.graph_id AND r.dst = d.id AND r.etype = 'REF'
    JOIN n t ON t.graph_id = r.graph_id AND t.id = r.src AND t.label = 'TYPE' WHERE i.etype = 'INHERITS_FROM')"""
q("type_hierarchy", views.type_hierarchy, "SELECT * FROM th", _TYPES)
_ESC = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
_TITLE = _ESC.format("(n.label || ', ' || CASE WHEN n.label IN ('METHOD', 'MEMBER') THEN n.name ELSE n.code END)")


def _dot(table: str, tag: str) -> str:
    return f"""SELECT q.graph_id, 0 AS k, q.id AS a, 0::BIGINT AS b, '"' || q.id || '" [label = <' || {_TITLE} || '> ]' AS line FROM (SELECT graph_id, src AS id FROM {table} UNION SELECT graph_id, dst FROM {table}) q JOIN n ON n.graph_id = q.graph_id AND n.id = q.id
        UNION ALL SELECT graph_id, 1, src, dst, '  "' || src || '" -> "' || dst || '"' || {tag} FROM {table}"""


q("dot_call_graph", lambda g: views.dot_lines(views.call_graph(g), g), _dot("cg", "' [ label = \"' || label || '\" ]'"), _CALLS)
q("dot_type_hierarchy", lambda g: views.dot_lines(views.type_hierarchy(g), g), _dot("th", "' '"), _TYPES)
for _view, _types in {"ast": "'AST'", "cfg": "'CFG'", "cdg": "'CDG'", "cpg14": "'AST', 'CFG', 'CDG', 'REACHING_DEF'"}.items():
    q(f"dot_{_view}", lambda g, v=_view: views.dot_lines(exports.subgraph(g, v).edges.select("graph_id", "src", "dst"), g), _dot("ed", "' '"), f"ed AS (SELECT graph_id, src, dst FROM e WHERE etype IN ({_types}))")
q("dot_texts", lambda g: exports.dot(g, "cdg"), f"""SELECT graph_id, 'digraph "g" {{' || chr(10) || 'node [shape="rect"];' || chr(10) || string_agg(line, chr(10) ORDER BY k, a, b) || chr(10) || '}}' || chr(10) AS dot FROM ({_dot("ed", "' '")}) GROUP BY 1""", "ed AS (SELECT graph_id, src, dst FROM e WHERE etype = 'CDG')")
q("statement_count", views.statement_count, "SELECT a.graph_id, count(*) AS n FROM e a JOIN n m ON m.graph_id = a.graph_id AND m.id = a.src AND m.label = 'METHOD' JOIN n b ON b.graph_id = a.graph_id AND b.id = a.dst AND b.label = 'BLOCK' JOIN e c ON c.graph_id = b.graph_id AND c.src = b.id AND c.etype = 'AST' "
    f"JOIN n x ON x.graph_id = c.graph_id AND x.id = c.dst AND x.label IN {EXPR} WHERE a.etype = 'AST' GROUP BY 1")  # fmt: skip
q("sliced_methods", lambda g: views.sliced_methods(g, "f[01].*", "[a-s].*", None, None).df.select(*KEY), "SELECT graph_id, id FROM n WHERE label = 'METHOD' AND NOT is_external AND regexp_full_match(filename, 'f[01].*') AND regexp_full_match(name, '[a-s].*')")
q("sliced_by_parts", lambda g: views.sliced_methods(g, None, None, "T[0-3]", None).df.select(*KEY, F.lit("parameter").alias("part")).unionByName(views.sliced_methods(g, None, None, None, ".*").df.select(*KEY, F.lit("annotation").alias("part"))),
    "SELECT DISTINCT m.graph_id, m.id, CASE WHEN x.label = 'ANNOTATION' THEN 'annotation' ELSE 'parameter' END AS part FROM n m JOIN e ON e.graph_id = m.graph_id AND e.src = m.id AND etype = 'AST' JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst AND (x.label = 'ANNOTATION' OR (x.label = 'METHOD_PARAMETER_IN' AND x.type_full_name IN ('T0', 'T1', 'T2', 'T3'))) WHERE m.label = 'METHOD' AND NOT m.is_external")
q("calls_outside", lambda g: views.calls_outside(Cpg(g).all()).df.select(*KEY), "SELECT DISTINCT c.graph_id, c.id FROM n c JOIN e ON e.graph_id = c.graph_id AND e.src = c.id AND etype = 'CALL' JOIN n m ON m.graph_id = e.graph_id AND m.id = e.dst AND m.label = 'METHOD' AND m.is_external WHERE c.label = 'CALL'")
_KIDS = "SELECT list_sort(list({})) FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst AND x.label = '{}' WHERE e.graph_id = t.graph_id AND e.src = t.id AND etype = 'AST'"
q("type_summary", lambda g: views.type_summary(g).select(*KEY, "full_name", F.array_join("fields", ",").alias("fields"), F.array_join("procedures", ",").alias("procedures")),
    f"SELECT graph_id, id, full_name, coalesce(array_to_string(({_KIDS.format('''x.name || ':' || x.type_full_name''', 'MEMBER')}), ','), '') AS fields, coalesce(array_to_string(({_KIDS.format('x.full_name', 'METHOD')}), ','), '') AS procedures FROM n t WHERE label = 'TYPE_DECL' AND NOT is_external")
q("last_expression", views.last_expression, "SELECT graph_id, src AS block, arg_max(id, (ord, id)) AS id FROM (SELECT e.graph_id, e.src, x.id, x.\"order\" AS ord FROM e JOIN n b ON b.graph_id = e.graph_id AND b.id = e.src AND b.label = 'BLOCK' JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst AND x.label NOT IN ('LOCAL', 'METHOD') WHERE etype = 'AST') GROUP BY 1, 2")
q("excerpt", lambda g: views.excerpt(Cpg(g).method()).distinct(), """SELECT DISTINCT n.graph_id, n.id, coalesce(substring(f.content, n."offset" + 1, n.offset_end - n."offset") || ' /* <=== ' || n.full_name || ' */ ', '') AS dump FROM n LEFT JOIN e ON e.graph_id = n.graph_id AND e.src = n.id AND etype = 'SOURCE_FILE'
    LEFT JOIN n f ON f.graph_id = e.graph_id AND f.id = e.dst AND f.label = 'FILE' AND f.content <> '<empty>' WHERE n.label = 'METHOD'""")  # fmt: skip
q("neo4j_nodes", lambda g: exports.neo4j_csv(g)[0].select(F.col(":ID").alias("id"), F.col(":LABEL").alias("label"), "name", "line_number"), "SELECT graph_id || '-' || id AS id, label, name, line_number FROM n")
q("neo4j_edges", lambda g: exports.neo4j_csv(g)[1].select(F.col(":START_ID").alias("src"), F.col(":END_ID").alias("dst"), F.col(":TYPE").alias("etype")), "SELECT graph_id || '-' || src AS src, graph_id || '-' || dst AS dst, etype FROM e")


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES
