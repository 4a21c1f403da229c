"""Queries of the flow passes over generated control flow with branches, joins and loops, and of the linking passes over the
generated graphs of step_queries, beside their SQL.

For each graph record of raw_record one method is generated by arithmetic on its number: 21 places between entry and
return, each followed by the next, a third of them by another place as well; every second is a call with two arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.graph import cfg, dataflow, passes
from codequarry.graph.model import KEY, Graph
from codequarry.graph.steps import Cpg
from codequarry.plans import step_queries
from codequarry.session import Scratch, table

LAST = 22
CALLED = ["<operator>.assignment", "<operator>.addition", "strlen", "unknown", "<operator>.postIncrement", "free", "<operator>.listLiteral"]


def _called(k: str, spark: bool) -> str:
    return step_queries._pick(CALLED, f"({k} * 3 + g) % {len(CALLED)}", spark)


def _nodes(spark: bool) -> str:
    s = "string" if spark else "VARCHAR"
    place = f"""SELECT g AS graph_id, k AS id, CASE WHEN k = 0 THEN 'METHOD' WHEN k = {LAST} THEN 'METHOD_RETURN' WHEN k % 2 = 1 THEN 'CALL' ELSE 'CONTROL_STRUCTURE' END AS label, CASE WHEN k % 2 = 1 THEN {_called('k', spark)} END AS name,
        cast(NULL AS {s}) AS code, cast(NULL AS int) AS argument_index FROM b WHERE k <= {LAST}"""
    args = " UNION ALL ".join(f"SELECT g, 100 + 2 * k + {j}, CASE WHEN (k + g + {j}) % 7 = 0 THEN 'LITERAL' ELSE 'IDENTIFIER' END, concat('v', cast((k * 5 + g + {j} * (1 + k)) % 4 AS {s})), concat('v', cast((k * 5 + g + {j} * (1 + k)) % 4 AS {s})), cast({j} + 1 AS int) FROM b WHERE k < {LAST} AND k % 2 = 1" for j in (0, 1))
    return f"{place} UNION ALL {args}"


_EDGES = f"""SELECT g AS graph_id, k AS src, k + 1 AS dst, 'CFG' AS etype FROM b WHERE k < {LAST}
    UNION ALL SELECT g, k, 1 + (k * 7 + g) % 21, 'CFG' FROM b WHERE k BETWEEN 1 AND 20 AND (k + g) % 3 = 0 AND 1 + (k * 7 + g) % 21 NOT IN (k, k + 1)
    UNION ALL SELECT g, 0, k, 'CONTAINS' FROM b WHERE k BETWEEN 1 AND 21 UNION ALL SELECT g, 0, k, 'AST' FROM b WHERE k BETWEEN 1 AND {LAST}
    UNION ALL SELECT g, k, 100 + 2 * k, 'ARGUMENT' FROM b WHERE k < {LAST} AND k % 2 = 1 UNION ALL SELECT g, k, 101 + 2 * k, 'ARGUMENT' FROM b WHERE k < {LAST} AND k % 2 = 1"""
_SQL = f"""b AS MATERIALIZED (SELECT g, k FROM (SELECT DISTINCT record_id AS g FROM raw_record WHERE kind = 'graph'), range({LAST + 1}) t(k)), n AS MATERIALIZED ({_nodes(False)}), e AS MATERIALIZED ({_EDGES}),
    f AS MATERIALIZED (SELECT graph_id, src, dst FROM e WHERE etype = 'CFG')"""
_made: dict[tuple[str, str], Graph] = {}


def made(spark: SparkSession, d: str) -> Graph:
    key = (spark.sparkContext.applicationId, d)
    if key not in _made:
        scratch = Scratch(spark)
        base = table(spark, d, "raw_record").where("kind = 'graph'").select(F.col("record_id").alias("g")).distinct().select("g", F.explode(F.expr(f"sequence(0L, {LAST}L)")).alias("k"))
        base.createOrReplaceTempView("_flow_base")
        q = lambda text: spark.sql(text.replace("FROM b ", "FROM _flow_base "))
        g = Graph.of(q(_nodes(True) + " "), q(_EDGES + " "))
        _made[key] = Graph(scratch.save(g.nodes), scratch.save(g.edges))
        spark.catalog.dropTempView("_flow_base")
    return _made[key]


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def q(name: str, f, sql: str, ctes: str = "") -> None:
    QUERIES[f"flow_{name}"] = lambda spark, d: f(made(spark, d))
    ORACLES[f"flow_{name}"] = f"WITH RECURSIVE {_SQL}{', ' + ctes if ctes else ''} {sql}"


def _dominance(name: str, root: int, src: str, dst: str) -> str:
    """(graph_id, d, v): d strictly dominates v in the flow from src to dst: v is not reached once d is taken out."""
    return f"""{name}cut AS (SELECT DISTINCT graph_id, c.k AS d, {root} AS v FROM f, range({LAST + 1}) c(k) WHERE c.k <> {root} UNION SELECT x.graph_id, x.d, f.{dst} FROM {name}cut x JOIN f ON f.graph_id = x.graph_id AND f.{src} = x.v AND f.{dst} <> x.d),
    {name} AS (SELECT a.g AS graph_id, a.k AS d, v.k AS v FROM b a JOIN b v ON v.g = a.g AND v.k <> a.k WHERE v.k <> {root} AND (a.k = {root} OR NOT EXISTS (SELECT 1 FROM {name}cut c WHERE c.graph_id = a.g AND c.d = a.k AND c.v = v.k)))"""


_IMMEDIATE = "SELECT graph_id, arg_max(d, k) AS src, v AS dst FROM (SELECT x.graph_id, x.d, x.v, (SELECT count(*) FROM {0} y WHERE y.graph_id = x.graph_id AND y.v = x.d) AS k FROM {0} x) GROUP BY graph_id, v"
edges = lambda f: lambda g: f(g).select("graph_id", "src", "dst")
q("dominators", edges(passes.dominators), _IMMEDIATE.format("dom"), _dominance("dom", 0, "src", "dst"))
q("post_dominators", edges(passes.post_dominators), _IMMEDIATE.format("pd"), _dominance("pd", LAST, "dst", "src"))
q("control_dependence", edges(passes.control_dependence), """SELECT DISTINCT f.graph_id, f.src, x.id AS dst FROM f JOIN n x ON x.graph_id = f.graph_id AND x.id < 100 JOIN n s ON s.graph_id = f.graph_id AND s.id = f.src AND s.label IN ('CALL', 'CONTROL_STRUCTURE', 'IDENTIFIER', 'LITERAL', 'METHOD_REF', 'UNKNOWN', 'JUMP_TARGET')
    WHERE (x.id = f.dst OR EXISTS (SELECT 1 FROM pd WHERE pd.graph_id = f.graph_id AND pd.d = x.id AND pd.v = f.dst)) AND NOT EXISTS (SELECT 1 FROM pd WHERE pd.graph_id = f.graph_id AND pd.d = x.id AND pd.v = f.src)""", _dominance("pd", LAST, "dst", "src"))  # fmt: skip
q("post_order", lambda g: passes.post_order(g).groupBy("graph_id", "method").agg(F.count(F.lit(1)).alias("n"), F.max("number").alias("last"), F.max(F.when(F.col("id") == 0, F.col("number"))).alias("entry")), f"SELECT DISTINCT g AS graph_id, 0::BIGINT AS method, {LAST + 1}::BIGINT AS n, {LAST}::INTEGER AS last, {LAST}::INTEGER AS entry FROM b")

_ARGS = "args AS (SELECT e.graph_id, e.src AS loc, x.id AS node, x.label, x.name AS var, x.argument_index AS i, c.name AS call FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst JOIN n c ON c.graph_id = e.graph_id AND c.id = e.src WHERE etype = 'ARGUMENT')"


def _reaching(defined: str, used: str) -> str:
    return f"""{_ARGS}, defs AS (SELECT * FROM args WHERE label = 'IDENTIFIER' AND {defined}), uses AS (SELECT * FROM args WHERE {used}),
    reach AS (SELECT d.graph_id, d.node, d.var, f.dst AS x FROM defs d JOIN f ON f.graph_id = d.graph_id AND f.src = d.loc
        UNION SELECT r.graph_id, r.node, r.var, f.dst FROM reach r JOIN f ON f.graph_id = r.graph_id AND f.src = r.x WHERE NOT EXISTS (SELECT 1 FROM defs k WHERE k.graph_id = r.graph_id AND k.loc = r.x AND k.var = r.var)),
    rd AS (SELECT DISTINCT r.graph_id, r.node AS src, u.node AS dst, r.var AS variable FROM reach r JOIN uses u ON u.graph_id = r.graph_id AND u.loc = r.x AND u.var = r.var AND u.node <> r.node)"""


#: What the calls of the generated methods define and use, by their specification.
_DEFINED = "(call IN ('unknown', '<operator>.listLiteral') OR (i = 1 AND call IN ('<operator>.assignment', 'strlen', '<operator>.postIncrement', 'free')))"
_USED = "(call IN ('unknown', '<operator>.listLiteral', '<operator>.addition') OR (i = 2 AND call = '<operator>.assignment') OR (i = 1 AND call IN ('strlen', '<operator>.postIncrement', 'free')))"
_semantics = lambda g: dataflow.semantics_table(g.nodes.sparkSession, dataflow.DEFAULT_SEMANTICS)
q("reaching_definitions", lambda g: dataflow.reaching_definitions(g).drop("etype"), "SELECT * FROM rd", _reaching("TRUE", "TRUE"))
q("reaching_definitions_known_calls", lambda g: dataflow.reaching_definitions(g, _semantics(g)).drop("etype"), "SELECT * FROM rd", _reaching(_DEFINED, _USED))
q("over_definitions", lambda g: dataflow.over_definitions(g, most_definitions=18), "SELECT graph_id, 0::BIGINT AS method, count(*) AS definitions FROM args WHERE label = 'IDENTIFIER' GROUP BY 1 HAVING count(*) > 18", _ARGS)


def _tainted(g: Graph) -> DataFrame:
    g = g.with_edges(Scratch(g.nodes.sparkSession).save(dataflow.reaching_definitions(g)))
    cpg = Cpg(g)
    return dataflow.reachable_by(cpg.call().where("id % 3 = 0").argument(2), cpg.identifier().where("id < 110")).select("graph_id", "source", "sink")


q("taint_pairs", _tainted, """SELECT DISTINCT tw.graph_id, t AS source, f AS sink FROM tw JOIN n s ON s.graph_id = tw.graph_id AND s.id = tw.t AND s.label = 'IDENTIFIER' AND s.id < 110""",
    _reaching("TRUE", "TRUE") + """, st AS (SELECT graph_id, src, dst FROM rd UNION SELECT a.graph_id, a.node, b.node FROM args a JOIN args b ON b.graph_id = a.graph_id AND b.loc = a.loc AND b.label = 'IDENTIFIER' AND b.node <> a.node UNION SELECT graph_id, node, loc FROM args),
    tw AS (SELECT graph_id, node AS f, node AS t FROM args WHERE i = 2 AND loc % 3 = 0 UNION SELECT tw.graph_id, tw.f, st.src FROM tw JOIN st ON st.graph_id = tw.graph_id AND st.dst = tw.t)""")  # fmt: skip
q("ddg_slice", lambda g: dataflow.backward_slice(Cpg(g.with_edges(Scratch(g.nodes.sparkSession).save(dataflow.reaching_definitions(g)))).call().where("id = 21").argument(), 2)[0].select(*KEY),
    "SELECT DISTINCT graph_id, id FROM (SELECT graph_id, node AS id FROM args WHERE loc = 21 UNION SELECT rd.graph_id, rd.src FROM rd JOIN args a ON a.graph_id = rd.graph_id AND a.node = rd.dst AND a.loc = 21 UNION SELECT r2.graph_id, r2.src FROM rd r2 JOIN rd ON rd.graph_id = r2.graph_id AND rd.src = r2.dst JOIN args a ON a.graph_id = rd.graph_id AND a.node = rd.dst AND a.loc = 21)", _reaching("TRUE", "TRUE"))


q("used_and_defined", lambda g: dataflow.arguments_used_and_defined(g, _semantics(g)), f"SELECT graph_id, node AS id, {_USED} AS used, {_DEFINED} AS defined FROM args", _ARGS)
q("same_call", dataflow.same_call, "SELECT a.graph_id, a.node AS a, b.node AS b FROM args a JOIN args b ON b.graph_id = a.graph_id AND b.loc = a.loc AND b.node <> a.node", _ARGS)
q("defined_flows", lambda g: dataflow.defined_flows(g, _semantics(g)), """SELECT a.graph_id, a.node AS a, b.node AS b FROM args a JOIN args b ON b.graph_id = a.graph_id AND b.loc = a.loc
    WHERE a.call = 'unknown' OR (a.call = '<operator>.listLiteral' AND a.i = b.i) OR (a.call = '<operator>.assignment' AND a.i = 2 AND b.i = 1) OR (a.call IN ('strlen', '<operator>.postIncrement', 'free') AND a.i = 1 AND b.i = 1)""", _ARGS)  # fmt: skip
q("result_pairs", lambda g: dataflow.result_pairs(g.nodes.where("id = 103").select("graph_id", F.col("id").alias("source"), F.col("id").alias("sink"), F.expr("array(102L, 102L, 103L, 106L)").alias("path")), g).select("graph_id", F.array_join(F.transform("steps", lambda x: x["code"]), ",").alias("codes")),
    """SELECT a.graph_id, CASE WHEN a.var = b.var THEN a.var ELSE a.var || ',' || b.var END || CASE WHEN b.var = c.var THEN '' ELSE ',' || c.var END AS codes FROM args a JOIN args b ON b.graph_id = a.graph_id AND b.node = 103 JOIN args c ON c.graph_id = a.graph_id AND c.node = 106 WHERE a.node = 102""", _ARGS)  # fmt: skip

# Control flow made from syntax trees. Each construct is a tree and the flow that it has, both stated by hand: 0 is the method,
# 1 its body, 99 its return.

#: name: (nodes as id, label, name, kind of control structure, parent, order), edges)
C, I = "CALL", "IDENTIFIER"
CONSTRUCTS: dict[str, tuple[list[tuple], list[tuple[int, int]]]] = {
    "sequence": ([(2, C, "a", None, 1, 1), (3, I, "x", None, 2, 1), (4, C, "b", None, 1, 2)], [(0, 3), (3, 2), (2, 4), (4, 99)]),
    "if": ([(2, "CONTROL_STRUCTURE", None, "IF", 1, 1), (3, I, "c", None, 2, 1), (4, "BLOCK", None, None, 2, 2), (5, C, "a", None, 4, 1), (6, C, "b", None, 1, 2)], [(0, 3), (3, 5), (5, 6), (3, 6), (6, 99)]),
    "if_else": ([(2, "CONTROL_STRUCTURE", None, "IF", 1, 1), (3, I, "c", None, 2, 1), (4, "BLOCK", None, None, 2, 2), (5, C, "a", None, 4, 1), (6, "CONTROL_STRUCTURE", None, "ELSE", 2, 3), (7, C, "b", None, 6, 1), (8, C, "d", None, 1, 2)], [(0, 3), (3, 5), (3, 7), (5, 8), (7, 8), (8, 99)]),
    "while": ([(2, "CONTROL_STRUCTURE", None, "WHILE", 1, 1), (3, I, "c", None, 2, 1), (4, "BLOCK", None, None, 2, 2), (5, C, "a", None, 4, 1), (6, C, "b", None, 1, 2)], [(0, 3), (3, 5), (5, 3), (3, 6), (6, 99)]),
    "do": ([(2, "CONTROL_STRUCTURE", None, "DO", 1, 1), (3, "BLOCK", None, None, 2, 1), (4, C, "a", None, 3, 1), (5, I, "c", None, 2, 2), (6, C, "b", None, 1, 2)], [(0, 4), (4, 5), (5, 4), (5, 6), (6, 99)]),
    "for": ([(2, "CONTROL_STRUCTURE", None, "FOR", 1, 1), (3, C, "i", None, 2, 1), (4, I, "c", None, 2, 2), (5, C, "u", None, 2, 3), (6, "BLOCK", None, None, 2, 4), (7, C, "a", None, 6, 1)], [(0, 3), (3, 4), (4, 7), (7, 5), (5, 4), (4, 99)]),
    "break": ([(2, "CONTROL_STRUCTURE", None, "WHILE", 1, 1), (3, I, "c", None, 2, 1), (4, "BLOCK", None, None, 2, 2), (5, "CONTROL_STRUCTURE", None, "BREAK", 4, 1), (6, C, "b", None, 1, 2)], [(0, 3), (3, 5), (5, 6), (3, 6), (6, 99)]),
    "continue": ([(2, "CONTROL_STRUCTURE", None, "WHILE", 1, 1), (3, I, "c", None, 2, 1), (4, "BLOCK", None, None, 2, 2), (5, C, "a", None, 4, 1), (6, "CONTROL_STRUCTURE", None, "CONTINUE", 4, 2)], [(0, 3), (3, 5), (5, 6), (6, 3), (3, 99)]),
    "switch": ([(2, "CONTROL_STRUCTURE", None, "SWITCH", 1, 1), (3, I, "c", None, 2, 1), (4, "BLOCK", None, None, 2, 2), (5, "JUMP_TARGET", "case 1", None, 4, 1), (6, C, "a", None, 4, 2), (7, "CONTROL_STRUCTURE", None, "BREAK", 4, 3), (8, "JUMP_TARGET", "default", None, 4, 4), (9, C, "b", None, 4, 5)],
               [(0, 3), (3, 5), (5, 6), (6, 7), (7, 99), (3, 8), (8, 9), (9, 99)]),
    "switch_without_default": ([(2, "CONTROL_STRUCTURE", None, "SWITCH", 1, 1), (3, I, "c", None, 2, 1), (4, "BLOCK", None, None, 2, 2), (5, "JUMP_TARGET", "case 1", None, 4, 1), (6, C, "a", None, 4, 2)], [(0, 3), (3, 5), (5, 6), (6, 99), (3, 99)]),
    "return": ([(2, "CONTROL_STRUCTURE", None, "IF", 1, 1), (3, I, "c", None, 2, 1), (4, "BLOCK", None, None, 2, 2), (5, "RETURN", None, None, 4, 1), (6, I, "x", None, 5, 1), (7, C, "b", None, 1, 2)], [(0, 3), (3, 6), (6, 5), (5, 99), (3, 7), (7, 99)]),
    "goto": ([(2, C, "a", None, 1, 1), (3, "CONTROL_STRUCTURE", "goto out;", "GOTO", 1, 2), (4, C, "b", None, 1, 3), (5, "JUMP_TARGET", "out", None, 1, 4), (6, C, "d", None, 1, 5)], [(0, 2), (2, 3), (3, 5), (4, 5), (5, 6), (6, 99)]),
    "and": ([(2, C, "<operator>.logicalAnd", None, 1, 1), (3, I, "x", None, 2, 1), (4, I, "y", None, 2, 2)], [(0, 3), (3, 4), (3, 2), (4, 2), (2, 99)]),
    "or": ([(2, C, "<operator>.logicalOr", None, 1, 1), (3, I, "x", None, 2, 1), (4, I, "y", None, 2, 2)], [(0, 3), (3, 4), (3, 2), (4, 2), (2, 99)]),
    "conditional": ([(2, C, "<operator>.conditional", None, 1, 1), (3, I, "c", None, 2, 1), (4, I, "x", None, 2, 2), (5, I, "y", None, 2, 3)], [(0, 3), (3, 4), (3, 5), (4, 2), (5, 2), (2, 99)]),
    "try": ([(2, "CONTROL_STRUCTURE", None, "TRY", 1, 1), (3, "BLOCK", None, None, 2, 1), (4, C, "a", None, 3, 1), (5, "CONTROL_STRUCTURE", None, "CATCH", 2, 2), (6, C, "b", None, 5, 1), (7, C, "d", None, 1, 2)], [(0, 4), (4, 6), (4, 7), (6, 7), (7, 99)]),
    "nothing": ([], [(0, 99)]),
}


def flow_constructs(spark: SparkSession, d: str) -> DataFrame:
    """One method of one kind of construct for each graph record."""
    names = list(CONSTRUCTS)
    ids = table(spark, d, "raw_record").where("kind = 'graph'").select(F.col("record_id").alias("graph_id")).distinct().withColumn("kind", F.col("graph_id") % len(names))
    frame = [(0, "METHOD", "m", None, None, 1), (1, "BLOCK", None, None, 0, 1), (99, "METHOD_RETURN", None, None, 0, 2)]
    tree = [(k, *n) for k, name in enumerate(names) for n in [*frame, *CONSTRUCTS[name][0]]]
    t = F.broadcast(spark.createDataFrame(tree, "kind long, id long, label string, name string, control_structure_type string, parent long, `order` int"))  # some rows for each construct
    all_ = Scratch(spark).save(ids.join(t, "kind"))
    nodes = all_.select("graph_id", "id", "label", "name", F.col("name").alias("code"), "control_structure_type", "order")
    edges = all_.where("parent IS NOT NULL").select("graph_id", F.col("parent").alias("src"), F.col("id").alias("dst"), F.lit("AST").alias("etype"))
    return cfg.control_flow(Graph.of(nodes, edges)).select("graph_id", "src", "dst")


QUERIES["flow_constructs"] = flow_constructs
ORACLES["flow_constructs"] = "SELECT record_id AS graph_id, src, dst FROM (SELECT DISTINCT record_id FROM raw_record WHERE kind = 'graph') JOIN (VALUES " + ", ".join(f"({k}, {a}::BIGINT, {b}::BIGINT)" for k, c in enumerate(CONSTRUCTS.values()) for a, b in c[1]) + f") v(kind, src, dst) ON record_id % {len(CONSTRUCTS)} = kind"

# The passes that link by names, over the generated graphs with every label.


def passes_family(name: str, steps: dict, sql: dict[str, str]) -> None:
    """(step, graph_id, src, dst): the edges that each pass adds."""
    assert list(steps) == list(sql)

    def query(spark: SparkSession, d: str) -> DataFrame:
        g, out = step_queries.built(spark, d), None
        for step, f in steps.items():
            df = f(g).select(F.lit(step).alias("step"), "graph_id", "src", "dst")
            out = df if out is None else out.unionByName(df)
        return out

    QUERIES[name] = query
    ORACLES[name] = f"WITH RECURSIVE {step_queries._GRAPH_SQL} " + " UNION ALL ".join(f"SELECT '{k}' AS step, graph_id, src, dst FROM ({s})" for k, s in sql.items())


def _link(left: str, right: str) -> str:
    return f"SELECT l.graph_id, l.id AS src, r.id AS dst FROM (SELECT graph_id, id, {left}) l JOIN (SELECT graph_id, id, {right}) r ON r.graph_id = l.graph_id AND r.key = l.key"


passes_family(
    "flow_linked_names",
    {"type_refs": passes.type_refs, "eval_types": passes.eval_types, "aliases": passes.aliases, "method_refs": passes.method_refs, "static_calls": passes.static_calls, "naive_calls": passes.naive_calls, "contains": passes.contains,
     "type_hierarchy": lambda g: passes.type_hierarchy(Graph(g.nodes.withColumn("inherits_from", F.when(F.col("label") == "TYPE_DECL", F.array("full_name", "canonical_name"))), g.edges)), "field_refs": passes.field_refs},
    {"type_refs": _link("full_name AS key FROM n WHERE label = 'TYPE'", "full_name AS key FROM n WHERE label = 'TYPE_DECL'"), "eval_types": _link("type_full_name AS key FROM n", "full_name AS key FROM n WHERE label = 'TYPE'"),
     "aliases": _link("alias_type_full_name AS key FROM n WHERE label = 'TYPE_DECL'", "full_name AS key FROM n WHERE label = 'TYPE'"), "method_refs": _link("method_full_name AS key FROM n WHERE label = 'METHOD_REF'", "full_name AS key FROM n WHERE label = 'METHOD'"),
     "static_calls": _link("method_full_name AS key FROM n WHERE label = 'CALL' AND dispatch_type <> 'DYNAMIC_DISPATCH'", "full_name AS key FROM n WHERE label = 'METHOD'"),
     "naive_calls": _link("name AS key FROM n WHERE label = 'CALL' AND NOT EXISTS (SELECT 1 FROM e WHERE e.graph_id = n.graph_id AND e.src = n.id AND etype = 'CALL')", "name AS key FROM n WHERE label = 'METHOD'"),
     "contains": f"WITH RECURSIVE {step_queries._UP} SELECT upl.graph_id, arg_min(t, d) AS src, f AS dst FROM upl JOIN n x ON x.graph_id = upl.graph_id AND x.id = upl.f AND x.label IN {step_queries.CFGN} AND x.label NOT IN ('METHOD', 'METHOD_RETURN', 'METHOD_PARAMETER_IN', 'METHOD_PARAMETER_OUT') WHERE d > 0 AND upl.label IN ('METHOD', 'TYPE_DECL', 'FILE') GROUP BY upl.graph_id, f",
     "type_hierarchy": _link("unnest([full_name, canonical_name]) AS key FROM n WHERE label = 'TYPE_DECL'", "full_name AS key FROM n WHERE label = 'TYPE'"),
     "field_refs": """SELECT q.graph_id, q.src, m.id AS dst FROM (SELECT a.graph_id, a.id AS src, max(x.type_full_name) FILTER (WHERE x.argument_index = 1) AS typ, max(coalesce(x.canonical_name, x.code)) FILTER (WHERE x.argument_index = 2) AS field FROM n a JOIN e ON e.graph_id = a.graph_id AND e.src = a.id AND etype = 'ARGUMENT' JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst
        WHERE a.name IN ('<operator>.fieldAccess', '<operator>.indirectFieldAccess') GROUP BY 1, 2) q JOIN n d ON d.graph_id = q.graph_id AND d.label = 'TYPE_DECL' AND d.full_name = q.typ JOIN e ON e.graph_id = d.graph_id AND e.src = d.id AND etype = 'AST' JOIN n m ON m.graph_id = e.graph_id AND m.id = e.dst AND m.label = 'MEMBER' AND m.name = q.field"""},
)


def _on_built(name: str, f, sql: str) -> None:
    QUERIES[name] = lambda spark, d: f(step_queries.built(spark, d))
    ORACLES[name] = f"WITH RECURSIVE {step_queries._GRAPH_SQL} {sql}"


def _of_edge(g: Graph, etype: str, label: str) -> DataFrame:
    """(graph_id, src, name) of the edges of a type to nodes of a label that a pass made."""
    n = g.nodes.where(F.col("label") == label).select("graph_id", F.col("id").alias("dst"), "name")
    return g.etype(etype).where("dst < 0").join(n, ["graph_id", "dst"]).select("graph_id", "src", "name")


_on_built("flow_files", lambda g: _of_edge(passes.files(Graph(g.nodes.where("label <> 'FILE'"), g.edges.where("etype <> 'SOURCE_FILE'"))), "SOURCE_FILE", "FILE"), "SELECT graph_id, id AS src, filename AS name FROM n WHERE label IN ('METHOD', 'TYPE_DECL', 'NAMESPACE_BLOCK')")
_on_built("flow_namespaces", lambda g: _of_edge(passes.namespaces(g), "REF", "NAMESPACE"), "SELECT graph_id, id AS src, name FROM n WHERE label = 'NAMESPACE_BLOCK'")
_on_built("flow_type_stubs", lambda g: passes.type_stubs(g).nodes.where("id < 0").select("graph_id", "full_name", "is_external"), "SELECT DISTINCT graph_id, full_name, true AS is_external FROM n t WHERE label = 'TYPE' AND NOT EXISTS (SELECT 1 FROM n d WHERE d.graph_id = t.graph_id AND d.label = 'TYPE_DECL' AND d.full_name = t.full_name)")
_on_built("flow_method_stubs", lambda g: passes.method_stubs(g).nodes.where("id < 0").groupBy("graph_id", "label").agg(F.count(F.lit(1)).alias("n"), F.min("index").alias("first")),
    """SELECT graph_id, label, count(*) AS n, min(i)::INTEGER AS first FROM (SELECT graph_id, 'METHOD' AS label, NULL AS i FROM s UNION ALL SELECT graph_id, 'METHOD_PARAMETER_IN', unnest(range(CASE WHEN dyn THEN 0 ELSE 1 END, CASE WHEN dyn THEN k ELSE k + 1 END)) FROM s) GROUP BY 1, 2""")  # fmt: skip
ORACLES["flow_method_stubs"] = ORACLES["flow_method_stubs"].replace("SELECT graph_id, label, count(*) AS n, min(i)", ", s AS (SELECT c.graph_id, c.method_full_name, max((SELECT count(*) FROM e WHERE e.graph_id = c.graph_id AND e.src = c.id AND etype = 'ARGUMENT')) AS k, bool_or(c.dispatch_type = 'DYNAMIC_DISPATCH') AS dyn FROM n c WHERE c.label = 'CALL' AND NOT EXISTS (SELECT 1 FROM n m WHERE m.graph_id = c.graph_id AND m.label = 'METHOD' AND m.full_name = c.method_full_name) GROUP BY 1, 2) SELECT graph_id, label, count(*) AS n, min(i)", 1)
_on_built("flow_output_parameters", lambda g: passes.output_parameters(g).edges.where("dst < 0").groupBy("graph_id", "src", "etype").agg(F.count(F.lit(1)).alias("n")),
    """SELECT graph_id, src, etype, count(*) AS n FROM (SELECT graph_id, id AS src, 'PARAMETER_LINK' AS etype FROM n WHERE label = 'METHOD_PARAMETER_IN' UNION ALL SELECT e.graph_id, e.src, 'AST' FROM e JOIN n p ON p.graph_id = e.graph_id AND p.id = e.dst AND p.label = 'METHOD_PARAMETER_IN' WHERE etype = 'AST') GROUP BY 1, 2, 3""")  # fmt: skip
_on_built("flow_parameter_index", lambda g: passes.parameter_index(Graph(g.nodes.withColumn("index", F.when(F.col("index") > 1, F.col("index"))), g.edges)).nodes.where("label = 'METHOD_PARAMETER_IN'").select("graph_id", "id", "index"), "SELECT graph_id, id, CASE WHEN \"index\" > 1 THEN \"index\" ELSE \"order\" END AS \"index\" FROM n WHERE label = 'METHOD_PARAMETER_IN'")
_on_built("flow_unresolved_calls", lambda g: Cpg(g).all().unresolved_method_full_names(), "SELECT graph_id, id, method_full_name FROM n WHERE label = 'CALL' AND NOT EXISTS (SELECT 1 FROM e WHERE e.graph_id = n.graph_id AND e.src = n.id AND etype = 'CALL')")


def _resolver(g: Graph) -> DataFrame:
    return passes.static_calls(g)


_on_built("flow_resolved_calls", lambda g: Cpg(g).call().called_methods(_resolver).df.select(*KEY).unionByName(Cpg(g).method().method_callsites(_resolver).df.select(*KEY)),
    """, r AS (SELECT graph_id, src, dst FROM e WHERE etype = 'CALL' UNION SELECT c.graph_id, c.id, m.id FROM n c JOIN n m ON m.graph_id = c.graph_id AND m.label = 'METHOD' AND m.full_name = c.method_full_name WHERE c.label = 'CALL' AND c.dispatch_type <> 'DYNAMIC_DISPATCH')
    SELECT r.graph_id, r.dst AS id FROM r JOIN n c ON c.graph_id = r.graph_id AND c.id = r.src AND c.label = 'CALL' JOIN n m ON m.graph_id = r.graph_id AND m.id = r.dst AND m.label = 'METHOD'
    UNION ALL SELECT DISTINCT r.graph_id, r.src FROM r JOIN n c ON c.graph_id = r.graph_id AND c.id = r.src AND c.label = 'CALL' JOIN n m ON m.graph_id = r.graph_id AND m.id = r.dst AND m.label = 'METHOD'""")  # fmt: skip


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES
