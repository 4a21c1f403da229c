"""Queries of the steps of the graph language over generated graphs that hold every label and edge type, beside their SQL.

For each graph record of raw_record one graph of 82 nodes is generated by arithmetic on its number: a binary syntax tree
and edges of every type towards the labels that they lead to. Both sides generate the same graph. The SQL states each step
on its own, by hand, and takes nothing from the modules of the steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.graph import scanners
from codequarry.graph.model import KEY, Graph, shuffled, union
from codequarry.graph.steps import Cpg, Steps
from codequarry.session import Scratch, table

LABELS = """ANNOTATION ANNOTATION_LITERAL ANNOTATION_PARAMETER ANNOTATION_PARAMETER_ASSIGN ARRAY_INITIALIZER BINDING BLOCK CALL CLOSURE_BINDING COMMENT CONFIG_FILE CONTROL_STRUCTURE
    DEPENDENCY FIELD_IDENTIFIER FILE IDENTIFIER IMPORT JUMP_TARGET LITERAL LOCAL MEMBER META_DATA METHOD METHOD_PARAMETER_IN METHOD_PARAMETER_OUT METHOD_REF METHOD_RETURN MODIFIER
    NAMESPACE NAMESPACE_BLOCK RETURN TAG TEMPLATE_DOM TYPE TYPE_ARGUMENT TYPE_DECL TYPE_PARAMETER TYPE_REF UNKNOWN KEY_VALUE_PAIR FINDING""".split()  # fmt: skip
K = 82  # nodes of a graph: two of each label
#: Edge types with the labels that their edges lead to; a type that is listed twice has two edges at some nodes.
TARGETS = [
    ("ARGUMENT", "IDENTIFIER LITERAL CALL FIELD_IDENTIFIER"), ("ARGUMENT", "CALL IDENTIFIER BLOCK MEMBER"), ("RECEIVER", "IDENTIFIER CALL"), ("CONDITION", "CALL IDENTIFIER LOCAL"),
    ("REF", "METHOD TYPE_DECL NAMESPACE MEMBER LOCAL TYPE"), ("REF", "TYPE_DECL METHOD LOCAL"), ("EVAL_TYPE", "TYPE"), ("CAPTURE", "CLOSURE_BINDING"), ("CALL", "METHOD"), ("PARAMETER_LINK", "METHOD_PARAMETER_OUT LOCAL"),
    ("CFG", "CALL RETURN IDENTIFIER METHOD_RETURN BLOCK"), ("CONTAINS", "CALL BLOCK IDENTIFIER CONTROL_STRUCTURE RETURN LITERAL"), ("INHERITS_FROM", "TYPE"), ("ALIAS_OF", "TYPE"), ("BINDS", "BINDING"), ("SOURCE_FILE", "FILE"), ("TAGGED_BY", "TAG"),
    ("IMPORTS", "DEPENDENCY"), ("IS_CALL_FOR_IMPORT", "IMPORT"),
]
FORWARD = ["CDG", "DOMINATE", "POST_DOMINATE"]
NAMES = ["alpha", "beta", "gammaOne", "delta", "open"]
CALLS = ["<operator>.assignment", "<operator>.assignmentPlus", "<operator>.addition", "<operator>.postIncrement", "<operator>.indexAccess", "<operator>.indirectIndexAccess", "<operator>.fieldAccess", "<operator>.memberAccess", "<operator>.indirection", "<operator>.addressOf", "<operator>.shiftLeft", "open", "alpha", "read"]
FUNCTIONS = ["gets", "scanf", "strcat", "strncpy", "strcpy", "strtok", "getwd", "my_strcpy_s", "exec", "printf", "sprintf", "strlen", "free", "malloc", "read", "memcpy", "alpha", "open", "beta", "delta", "my_free", "<global>"]
TYPES = ["int", "long", "gint", "pkg.T0", "pkg.T1", "pkg.T2"]
MODS = ["PUBLIC", "PRIVATE", "PROTECTED", "ABSTRACT", "STATIC", "NATIVE", "CONSTRUCTOR", "VIRTUAL", "MODULE", "LAMBDA"]
CONTROLS = ["BREAK", "CONTINUE", "DO", "ELSE", "THROW", "FOR", "GOTO", "IF", "SWITCH", "TRY", "WHILE", "CATCH", "FINALLY"]


def _pick(values: list[str], at: str, spark: bool) -> str:
    inner = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({inner}), cast({at} + 1 as int))" if spark else f"list_element([{inner}], {at} + 1)"


def _node_columns(spark: bool) -> dict[str, str]:
    p = lambda values, at: _pick(values, at, spark)
    n, i = ("string", "int") if spark else ("VARCHAR", "INTEGER")
    s = lambda e: f"cast({e} AS {n})"
    return {
        "label": p(LABELS, f"(7 * k + g) % {len(LABELS)}"), "name": f"CASE WHEN (7 * k + g) % {len(LABELS)} = {LABELS.index('CALL')} THEN {p(CALLS, f'h % {len(CALLS)}')} WHEN (7 * k + g) % {len(LABELS)} = {LABELS.index('METHOD')} THEN {p(FUNCTIONS, f'h % {len(FUNCTIONS)}')} ELSE {p(NAMES, 'h % 5')} END",
        "full_name": f"CASE WHEN (7 * k + g) % {len(LABELS)} = {LABELS.index('TYPE')} THEN {p(TYPES, 'h % 6')} ELSE concat('pkg.T', {s('h % 6')}) END", "code": f"concat({p(NAMES, 'h % 4')}, '(', {s('h % 3')}, ')')", "signature": f"concat('void(', {s('h % 4')}, ')')", "value": f"concat('v', {s('h % 2')})",
        "type_full_name": f"concat('T', {s('h % 5')})", "filename": f"concat('f', {s('h % 3')}, '.c')", "is_external": "h % 2 = 0", "modifier_type": p(MODS, "h % 10"), "control_structure_type": p(CONTROLS, "h % 13"),
        "dispatch_type": p(["STATIC_DISPATCH", "DYNAMIC_DISPATCH", "INLINED"], "h % 3"), "method_full_name": f"concat('pkg.T', {s('h % 4')})", "alias_type_full_name": "CASE WHEN h % 3 = 0 THEN 'A' END",
        "canonical_name": f"concat('c', {s('h % 3')})", "evaluation_strategy": p(["BY_VALUE", "BY_REFERENCE", "BY_SHARING"], "h % 3"), "is_variadic": "h % 5 = 0",
        "order": f"cast(1 + h % 4 AS {i})", "index": f"cast(h % 4 AS {i})", "argument_index": f"cast((h + k) % 4 AS {i})", "line_number": f"cast(h AS {i})", "line_number_end": f"CASE WHEN h % 7 > 0 THEN cast(h + k % 4 + CASE WHEN h % 11 = 0 THEN 2000 ELSE 0 END AS {i}) END",
        "column_number": f"cast(h % 20 AS {i})", "content": f"CASE WHEN (7 * k + g) % {len(LABELS)} = {LABELS.index('FILE')} THEN CASE WHEN h % 3 = 0 THEN '<empty>' ELSE 'abcdefghijklmnopqrstuvwxyz' END END",
        "offset": f"cast(h % 9 AS {i})", "offset_end": f"cast(h % 9 + k % 6 AS {i})",
    }


def _edge_parts() -> list[tuple[str, str, str]]:
    """(type, condition on k and g, target)."""
    out = [("AST", "k >= 0", "2 * k + 1"), ("AST", "k >= 0", "2 * k + 2")]
    for t, (etype, labels) in enumerate(TARGETS):
        picks = [LABELS.index(x) for x in labels.split()]
        at = " ".join(f"WHEN {j} THEN {i}" for j, i in enumerate(picks))
        label = f"(CASE (k + {t}) % {len(picks)} {at} END)"
        # 7 * 6 = 1 modulo 41, so this node has the label
        out.append((etype, f"(k + {2 * t} + g) % 3 = 0", f"(({label} - g % 41 + 41) % 41 * 6) % 41 + 41 * ((k + {t}) % 2)"))
    for t, etype in enumerate(FORWARD):
        out.append((etype, f"(k + {t} + g) % 3 > 0", f"k + 1 + (k * 3 + {t} + g) % 5"))
    return out


_built: dict[tuple[str, str], Graph] = {}


def built(spark: SparkSession, d: str) -> Graph:
    """The generated graphs, written once a session for each folder of tables."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _built:
        scratch = Scratch(spark)
        ids = table(spark, d, "raw_record").where("kind = 'graph'").select(F.col("record_id").alias("g")).distinct()
        base = ids.select("g", F.explode(F.expr(f"sequence(0L, {K - 1}L)")).alias("k")).withColumn("h", F.expr("(k * 31 + g * 17) % 97"))
        nodes = base.select(F.col("g").alias("graph_id"), F.col("k").alias("id"), *[F.expr(e).alias(c) for c, e in _node_columns(True).items()])
        edge = F.explode(F.array(*[F.struct(F.lit(t).alias("etype"), F.expr(f"CASE WHEN {cond} THEN cast({dst} AS bigint) END").alias("dst")) for t, cond, dst in _edge_parts()]))
        edges = base.select(F.col("g").alias("graph_id"), F.col("k").alias("src"), edge.alias("e")).select("graph_id", "src", "e.dst", "e.etype").where(f"dst IS NOT NULL AND dst < {K} AND dst <> src")
        g = Graph.of(nodes, edges)
        _built[key] = Graph(shuffled(scratch.save(g.nodes)), shuffled(scratch.save(g.edges)))
    return _built[key]


_GRAPH_SQL = f"""b AS MATERIALIZED (SELECT g, k, (k * 31 + g * 17) % 97 AS h FROM (SELECT DISTINCT record_id AS g FROM raw_record WHERE kind = 'graph'), range({K}) t(k)),
    n AS MATERIALIZED (SELECT g AS graph_id, k AS id, {', '.join(f'{e} AS "{c}"' for c, e in _node_columns(False).items())} FROM b),
    e AS MATERIALIZED (SELECT * FROM ({' UNION ALL '.join(f"SELECT g AS graph_id, k AS src, {dst} AS dst, '{t}' AS etype FROM b WHERE {cond}" for t, cond, dst in _edge_parts())}) WHERE dst < {K} AND dst <> src)"""

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _counted(df: DataFrame) -> DataFrame:
    return df.groupBy("step", "graph_id").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def family(name: str, steps: dict, sql: dict[str, str], ctes: str = "", apart: bool = False) -> None:
    """One query for many steps: (step, graph_id, n, ids): how many nodes a step gives in each graph, and the sum of their ids.
    Apart, each step is counted and written before the next one is planned: for steps of many joins, all of whose plans at once
    are too much for the driver."""
    assert list(steps) == list(sql), (set(steps) ^ set(sql))

    def query(spark: SparkSession, d: str) -> DataFrame:
        g, scratch, parts = built(spark, d), Scratch(spark), []
        for step, f in steps.items():
            t = f(Cpg(g))
            df = (t.df if hasattr(t, "df") else t).select(F.lit(step).alias("step"), "graph_id", "id")
            parts.append(scratch.save(_counted(df)) if apart else df)
        return union(parts) if apart else _counted(union(parts))

    QUERIES[f"steps_{name}"] = query
    parts = " UNION ALL ".join(f"SELECT '{step}' AS step, graph_id, id FROM ({s})" for step, s in sql.items())
    ORACLES[f"steps_{name}"] = f"WITH RECURSIVE {_GRAPH_SQL}{', ' + ctes if ctes else ''} SELECT step, graph_id, count(*) AS n, sum(id)::BIGINT AS ids FROM ({parts}) GROUP BY 1, 2"


def rows(name: str, f, sql: str, ctes: str = "") -> None:
    """One query with the rows of one step."""
    QUERIES[f"steps_{name}"] = lambda spark, d: f(Cpg(built(spark, d)))
    ORACLES[f"steps_{name}"] = f"WITH RECURSIVE {_GRAPH_SQL}{', ' + ctes if ctes else ''} {sql}"


def _n(condition: str) -> str:
    return f"SELECT graph_id, id FROM n WHERE {condition}"


# Families of labels, as the graph's specification has them.
EXPR = "('BLOCK', 'CALL', 'CONTROL_STRUCTURE', 'FIELD_IDENTIFIER', 'IDENTIFIER', 'LITERAL', 'METHOD_REF', 'RETURN', 'TEMPLATE_DOM', 'TYPE_REF', 'UNKNOWN', 'ARRAY_INITIALIZER', 'ANNOTATION', 'ANNOTATION_LITERAL')"
CFGN = EXPR[:-1] + ", 'JUMP_TARGET', 'METHOD', 'METHOD_PARAMETER_IN', 'METHOD_PARAMETER_OUT', 'METHOD_RETURN')"


def _hops(chain: str, start: str = "SELECT graph_id, id FROM n") -> str:
    """SQL of hops such as '>AST:BLOCK <REF': out and in edges, with the label of the far node."""
    cur = start
    for hop in chain.split():
        near, far = ("src", "dst") if hop[0] == ">" else ("dst", "src")
        etype, _, label = hop[1:].partition(":")
        want = "" if not label else f" AND x.label IN {EXPR if label == 'EXPR' else CFGN if label == 'CFGN' else repr((label,)).replace(',)', ')')}"
        kind = f" AND e.etype = '{etype}'" if etype else ""
        cur = f"SELECT e.graph_id, e.{far} AS id FROM ({cur}) c JOIN e ON e.graph_id = c.graph_id AND e.{near} = c.id{kind} JOIN n x ON x.graph_id = e.graph_id AND x.id = e.{far}{want}"
    return cur


def _lines(text: str) -> dict[str, str]:
    return {line.split(None, 1)[0]: line.split(None, 1)[1].strip() for line in text.strip().splitlines() if line.strip()}


# Starting points.

_STARTERS = _lines("""
    annotation ANNOTATION
    call CALL
    config_file CONFIG_FILE
    dependency DEPENDENCY
    control_structure CONTROL_STRUCTURE
    file FILE
    identifier IDENTIFIER
    jump_target JUMP_TARGET
    local LOCAL
    literal LITERAL
    method METHOD
    method_return METHOD_RETURN
    member MEMBER
    meta_data META_DATA
    method_ref METHOD_REF
    namespace NAMESPACE
    namespace_block NAMESPACE_BLOCK
    parameter METHOD_PARAMETER_IN
    ret RETURN
    imports IMPORT
    typ TYPE
    type_decl TYPE_DECL
    tag TAG
    template_dom TEMPLATE_DOM
    type_ref TYPE_REF
    comment COMMENT
""")
_CONTROLS = {"break_": "BREAK", "continue_": "CONTINUE", "do_block": "DO", "else_block": "ELSE", "throws": "THROW", "for_block": "FOR", "goto": "GOTO", "if_block": "IF", "switch_block": "SWITCH", "try_block": "TRY", "while_block": "WHILE"}
family(
    "starters",
    {"all": lambda c: c.all(), "argument": lambda c: c.argument()} | {s: (lambda c, s=s: getattr(c, s)()) for s in [*_STARTERS, *_CONTROLS]},
    {"all": "SELECT graph_id, id FROM n", "argument": _hops(">ARGUMENT:EXPR", _n("label = 'CALL'"))} | {s: _n(f"label = '{x}'") for s, x in _STARTERS.items()}
    | {s: _n(f"label = 'CONTROL_STRUCTURE' AND control_structure_type = '{x}'") for s, x in _CONTROLS.items()},
)
_BY_NAME = "call config_file dependency file identifier local method member namespace namespace_block parameter typ type_decl tag".split()
family(
    "starters_matched",
    {s: (lambda c, s=s: getattr(c, s)("(al|gam).*|op.n")) for s in _BY_NAME} | {s: (lambda c, s=s: getattr(c, s)(r"(beta|delta)\(.\)")) for s in ("literal", "ret", "argument")}
    | {"comment": lambda c: c.comment("beta(1)"), "method_ref": lambda c: c.method_ref("b.*|d.*")},
    {s: _n(f"label = '{_STARTERS[s]}' AND regexp_full_match(name, '(al|gam).*|op.n')") for s in _BY_NAME}
    | {s: _n(f"label = '{x}' AND regexp_full_match(code, '(beta|delta)\\(.\\)')") for s, x in {"literal": "LITERAL", "ret": "RETURN"}.items()}
    | {"argument": f"SELECT q.graph_id, q.id FROM ({_hops('>ARGUMENT:EXPR', _n('''label = 'CALL' '''))}) q JOIN n USING (graph_id, id) WHERE regexp_full_match(code, '(beta|delta)\\(.\\)')",
       "comment": _n("label = 'COMMENT' AND code = 'beta(1)'"),
       "method_ref": _n("label = 'METHOD_REF' AND EXISTS (SELECT 1 FROM e JOIN n m ON m.graph_id = e.graph_id AND m.id = e.dst WHERE e.graph_id = n.graph_id AND e.src = n.id AND etype = 'REF' AND m.label = 'METHOD' AND regexp_full_match(m.name, 'b.*|d.*'))")},
)

# Label narrowing, property tests and modifiers.

_NARROW = "annotation annotation_literal array_initializer block control_structure literal local identifier import file field_identifier return member method_ref type_ref method modifier namespace_block template_dom type_decl".split()
family(
    "narrowing",
    {f"is_{x}": (lambda c, x=x: getattr(c.all(), f"is_{x}")()) for x in _NARROW} | {"is_parameter": lambda c: c.all().is_parameter(), "is_expression": lambda c: c.all().is_expression(), "is_cfg_node": lambda c: c.all().is_cfg_node(), "is_call": lambda c: c.all().is_call(), "is_call_code": lambda c: c.all().is_call(r"alpha\(.*"), "is_call_to": lambda c: c.all().is_call_to(r"<operator>\.a.*"), "walk_ast_until_reaching": lambda c: c.all().where("id IN (0, 1)").walk_ast_until_reaching(["METHOD", "BLOCK", "CALL", "FILE"])},
    {f"is_{x}": _n(f"label = '{x.upper()}'") for x in _NARROW} | {"is_parameter": _n("label = 'METHOD_PARAMETER_IN'"), "is_expression": _n(f"label IN {EXPR}"), "is_cfg_node": _n(f"label IN {CFGN}"), "is_call": _n("label = 'CALL'"), "is_call_code": _n(r"label = 'CALL' AND regexp_full_match(code, 'alpha\(.*')"), "is_call_to": _n(r"label = 'CALL' AND regexp_full_match(name, '<operator>\.a.*')"),
     "walk_ast_until_reaching": "SELECT DISTINCT graph_id, id FROM wk WHERE d > 0"},
    """wk AS (SELECT graph_id, id AS root, id, 0 AS d, false AS stop FROM n WHERE id IN (0, 1) UNION ALL SELECT e.graph_id, root, e.dst, d + 1, x.label IN ('METHOD', 'BLOCK', 'CALL', 'FILE')
        FROM wk JOIN e ON e.graph_id = wk.graph_id AND e.src = wk.id AND etype = 'AST' JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst JOIN n y ON y.graph_id = wk.graph_id AND y.id = wk.id WHERE y.label NOT IN ('METHOD', 'BLOCK', 'CALL', 'FILE'))""",
)
_TYPES = {"try": "TRY", "catch": "CATCH", "finally": "FINALLY", "if": "IF", "else": "ELSE", "switch": "SWITCH", "do": "DO", "for": "FOR", "while": "WHILE", "goto": "GOTO", "break": "BREAK", "continue": "CONTINUE", "throw": "THROW"}
_HAS = "EXISTS (SELECT 1 FROM e JOIN n m ON m.graph_id = e.graph_id AND m.id = e.dst WHERE e.graph_id = n.graph_id AND e.src = n.id AND m.label = 'MODIFIER' AND {})"
family(
    "tests",
    {f"is_{t}": (lambda c, t=t: getattr(c.all(), f"is_{t}")()) for t in _TYPES} | {f"is_{m.lower()}": (lambda c, m=m: getattr(c.all(), f"is_{m.lower()}")()) for m in MODS}
    | {s: (lambda c, s=s: getattr(c.all(), s)()) for s in ("is_static_dispatch", "is_dynamic_dispatch", "is_external", "is_internal", "is_alias", "is_canonical", "is_argument", "is_stub", "is_not_stub", "is_variadic")}
    | {"has_modifier": lambda c: c.all().has_modifier("P.*"), "condition_matching": lambda c: c.all().condition_matching(r"beta.*"), "contains_call_to": lambda c: c.all().contains_call_to("open|read")},
    {f"is_{t}": _n(f"control_structure_type = '{x}'") for t, x in _TYPES.items()} | {f"is_{m.lower()}": _n(_HAS.format(f"e.etype = 'AST' AND m.modifier_type = '{m}'")) for m in MODS}
    | {"is_static_dispatch": _n("dispatch_type = 'STATIC_DISPATCH'"), "is_dynamic_dispatch": _n("dispatch_type = 'DYNAMIC_DISPATCH'"), "is_external": _n("is_external"), "is_internal": _n("NOT is_external"), "is_alias": _n("alias_type_full_name IS NOT NULL"), "is_canonical": _n("alias_type_full_name IS NULL"),
       "is_argument": _n("EXISTS (SELECT 1 FROM e WHERE e.graph_id = n.graph_id AND e.dst = n.id AND etype = 'ARGUMENT')"),
       "is_stub": _n("NOT EXISTS (SELECT 1 FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE e.graph_id = n.graph_id AND e.src = n.id AND etype = 'CFG' AND x.label <> 'METHOD_RETURN')"),
       "is_not_stub": _n("EXISTS (SELECT 1 FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE e.graph_id = n.graph_id AND e.src = n.id AND etype = 'CFG' AND x.label <> 'METHOD_RETURN')"),
       "is_variadic": _n("EXISTS (SELECT 1 FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE e.graph_id = n.graph_id AND e.src = n.id AND etype = 'AST' AND x.label = 'METHOD_PARAMETER_IN' AND x.is_variadic)"),
       "has_modifier": _n(_HAS.format("regexp_full_match(m.modifier_type, 'P.*')")), "condition_matching": _n("EXISTS (SELECT 1 FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE e.graph_id = n.graph_id AND e.src = n.id AND etype = 'CONDITION' AND regexp_full_match(x.code, 'beta.*'))"),
       "contains_call_to": "SELECT DISTINCT ac.graph_id, f AS id FROM ac JOIN n x ON x.graph_id = ac.graph_id AND x.id = ac.t WHERE x.label = 'CALL' AND regexp_full_match(x.name, 'open|read') "},
    "ac AS (SELECT graph_id, id AS f, id AS t FROM n UNION SELECT ac.graph_id, ac.f, e.dst FROM ac JOIN e ON e.graph_id = ac.graph_id AND e.src = ac.t AND etype = 'AST')",
)
_TEXTS = {"name": "a.*|open", "code": r"b.*\(1\)", "full_name": r"pkg\.T[0-3]", "signature": r"void\([12]\)", "type_full_name": "T[134]", "filename": r"f[02]\.c", "method_full_name": "pkg.T1", "control_structure_type": "I.|.*H", "dispatch_type": "S.*", "modifier_type": "P.*", "canonical_name": "c[12]", "evaluation_strategy": "BY_V.*|BY_S.*"}
_EXACT = {"name": "open", "code": "beta(1)", "full_name": "pkg.T2", "signature": "void(3)", "type_full_name": "T4", "filename": "f1.c", "method_full_name": "pkg.T0", "control_structure_type": "GOTO", "dispatch_type": "INLINED", "modifier_type": "LAMBDA", "canonical_name": "c0", "evaluation_strategy": "BY_VALUE"}
_NUMBERS = {"line_number": 40, "line_number_end": 50, "column_number": 7, "order": 2, "index": 1, "argument_index": 3}
family(
    "properties",
    {f"{p}_is": (lambda c, p=p, r=r: getattr(c.all(), f"{p}_is")(r)) for p, r in _TEXTS.items()} | {f"{p}_not": (lambda c, p=p, r=r: getattr(c.all(), f"{p}_not")(r)) for p, r in _TEXTS.items()}
    | {f"{p}_exact": (lambda c, p=p, v=v: getattr(c.all(), f"{p}_exact")(v, "none")) for p, v in _EXACT.items()} | {f"{p}_{k}": (lambda c, p=p, k=k, v=v: getattr(c.all(), f"{p}_{k}")(v)) for p, v in _NUMBERS.items() for k in ("eq", "from", "to")},
    {f"{p}_is": _n(f"regexp_full_match({p}, '{r}')") for p, r in _TEXTS.items()} | {f"{p}_not": _n(f"NOT regexp_full_match({p}, '{r}')") for p, r in _TEXTS.items()}
    | {f"{p}_exact": _n(f"{p} = '{v}'") for p, v in _EXACT.items()} | {f"{p}_{k}": _n(f'"{p}" {o} {v}') for p, v in _NUMBERS.items() for k, o in (("eq", "="), ("from", ">="), ("to", "<="))},
)

# Hops.

_HOP_LINES = [_lines(x) for x in ("""
    annotations >AST:ANNOTATION
    receiver >RECEIVER:EXPR
    received_call <RECEIVER:CALL
    arguments >ARGUMENT:EXPR
    condition >CONDITION:EXPR
    refs_to >REF
    eval_types >EVAL_TYPE:TYPE
    expression_up <AST:EXPR
    expression_down >AST:EXPR
    closure_binding <REF:CLOSURE_BINDING
    captured_by_method_ref <REF:CLOSURE_BINDING <CAPTURE:METHOD_REF
    captured_by_type_ref <REF:CLOSURE_BINDING <CAPTURE:TYPE_REF
    to_method_return >CALL:METHOD >AST:METHOD_RETURN
    body >AST:BLOCK
    parameters >AST:METHOD_PARAMETER_IN
    parameters_out >AST:METHOD_PARAMETER_OUT
    method_returns >AST:METHOD_RETURN
    param_in <PARAMETER_LINK:METHOD_PARAMETER_IN
    param_out >PARAMETER_LINK:METHOD_PARAMETER_OUT
    cfg_last >AST:METHOD_RETURN <CFG:CFGN
    cfg_prev_all <CFG:CFGN
    ast_parent <AST
    ast_children >AST
    parent_method <AST:METHOD
    cfg_nodes >CONTAINS:CFGN
    calls >CONTAINS:CALL
    call_in <CALL:CALL
    callees_of_call >CALL:METHOD
""", """
    referenced_imports >IS_CALL_FOR_IMPORT:IMPORT
    import_calls <IS_CALL_FOR_IMPORT:CALL
    dependency_imports <IMPORTS:IMPORT
    ref_type_decl >REF:TYPE_DECL
    referencing_type <REF:TYPE
    base_type >INHERITS_FROM:TYPE
    base_type_decl >INHERITS_FROM:TYPE >REF:TYPE_DECL
    derived_type_decl <REF:TYPE <INHERITS_FROM:TYPE_DECL
    derived_type <INHERITS_FROM:TYPE_DECL <REF:TYPE
    alias_type_decl <REF:TYPE <ALIAS_OF:TYPE_DECL
    alias_type <ALIAS_OF:TYPE_DECL <REF:TYPE
    type_methods >AST:METHOD
    type_members >AST:MEMBER
    type_decls >AST:TYPE_DECL
    member_refs <REF:CALL
    namespaces >REF:NAMESPACE
    namespace_blocks_of_file <SOURCE_FILE:NAMESPACE_BLOCK
    locals_of_type <EVAL_TYPE:LOCAL
    members_of_type <EVAL_TYPE:MEMBER
    parameters_of_type <EVAL_TYPE:METHOD_PARAMETER_IN
    method_returns_of_type <EVAL_TYPE:METHOD_RETURN
    expressions_of_type <EVAL_TYPE:EXPR
""", """
    parameter_assigns >AST:ANNOTATION_PARAMETER_ASSIGN
    annotation_parameters >AST:ANNOTATION_PARAMETER
    annotation_values >AST:EXPR
    annotated_method <AST:METHOD
    annotated_type_decl <AST:TYPE_DECL
    annotated_member <AST:MEMBER
    annotated_parameter <AST:METHOD_PARAMETER_IN
    binding_type_decl <REF:BINDING <BINDS:TYPE_DECL
    referencing_binding <REF:BINDING
    bound_method >BINDS:BINDING >REF:METHOD
    method_binding >BINDS:BINDING
    tags >TAGGED_BY:TAG
    source_file >SOURCE_FILE:FILE
    modifiers >:MODIFIER
    tagged_member <TAGGED_BY:MEMBER
    tagged_method <TAGGED_BY:METHOD
    tagged_method_return <TAGGED_BY:METHOD_RETURN
    tagged_parameter <TAGGED_BY:METHOD_PARAMETER_IN
    tagged_parameter_out <TAGGED_BY:METHOD_PARAMETER_OUT
    tagged_call <TAGGED_BY:CALL
    tagged_identifier <TAGGED_BY:IDENTIFIER
    tagged_literal <TAGGED_BY:LITERAL
    tagged_local <TAGGED_BY:LOCAL
    tagged_file <TAGGED_BY:FILE
    field_member >REF:MEMBER
    caller_of_import <IS_CALL_FOR_IMPORT:CALL
""")]  # fmt: skip
_HOP_LINES[2].pop("caller_of_import")
for _k, _l in enumerate(_HOP_LINES):
    family(f"hops{_k + 1}", {s: (lambda c, s=s: getattr(c.all(), s)()) for s in _l}, {s: _hops(x) for s, x in _l.items()})


# Closures and what stands above or below in the tree.

def _walk(name: str, etype: str, back: bool = False, start: str = "TRUE") -> str:
    a, b = ("dst", "src") if back else ("src", "dst")
    return f"""{name} AS (SELECT e.graph_id, e.{a} AS f, e.{b} AS t FROM e JOIN n ON n.graph_id = e.graph_id AND n.id = e.{a} WHERE etype = '{etype}' AND {start}
        UNION SELECT w.graph_id, w.f, e.{b} FROM {name} w JOIN e ON e.graph_id = w.graph_id AND e.{a} = w.t AND etype = '{etype}')"""


_CLOSURES = {"controlled_by": ("CDG", True), "controls": ("CDG", False), "dominated_by": ("DOMINATE", True), "dominates": ("DOMINATE", False), "post_dominated_by": ("POST_DOMINATE", True), "post_dominates": ("POST_DOMINATE", False)}
_CALLS = "is_call"
family(
    "closures",
    {s: (lambda c, s=s: getattr(c.call(), s)()) for s in _CLOSURES} | {"passes": lambda c: c.call().passes(c.identifier()), "passes_not": lambda c: c.call().passes_not(c.identifier())},
    {s: f"SELECT graph_id, t AS id FROM w{i}" for i, s in enumerate(_CLOSURES)}
    | {k: _n(f"label = 'CALL' AND {neg} EXISTS (SELECT 1 FROM w4 JOIN n x ON x.graph_id = w4.graph_id AND x.id = w4.t WHERE w4.graph_id = n.graph_id AND w4.f = n.id AND x.label = 'IDENTIFIER')") for k, neg in (("passes", ""), ("passes_not", "NOT"))},
    ", ".join(_walk(f"w{i}", t, b, "n.label = 'CALL'") for i, (t, b) in enumerate(_CLOSURES.values())),
)
_UP = """up AS (SELECT graph_id, id AS f, id AS t, 0 AS d FROM n UNION ALL SELECT up.graph_id, f, e.src, d + 1 FROM up JOIN e ON e.graph_id = up.graph_id AND e.dst = up.t AND etype = 'AST'),
    upl AS (SELECT up.*, n.label, n.name, n.control_structure_type AS cst FROM up JOIN n ON n.graph_id = up.graph_id AND n.id = up.t), stop AS (SELECT graph_id, f, min(d) AS s FROM upl WHERE label = 'METHOD' GROUP BY 1, 2)"""
_NEAREST = "SELECT graph_id, arg_min(t, d) AS id FROM upl WHERE d > 0 AND label = '{}' GROUP BY graph_id, f"
_BELOW = "SELECT a.graph_id, b.t AS id FROM (SELECT graph_id, t FROM (SELECT graph_id, id AS t FROM n)) a JOIN up b ON b.graph_id = a.graph_id AND b.t = a.t"
_SKIP = "(label = 'CALL' AND name IN ('<operator>.indexAccess', '<operator>.indirectIndexAccess', '<operator>.fieldAccess', '<operator>.indirectFieldAccess', '<operator>.memberAccess', '<operator>.indirectMemberAccess', '<operator>.indirection', '<operator>.addressOf', '<operator>.pointerShift', '<operator>.getElementPtr'))"
family(
    "trees",
    {"ast": lambda c: c.all().ast(), "ast_condition": lambda c: c.all().ast(F.col("name") == "open"), "ast_minus_root": lambda c: c.all().ast_minus_root(), "ast_siblings": lambda c: c.all().ast_siblings(), "in_ast": lambda c: c.all().in_ast(), "in_ast_minus_leaf": lambda c: c.all().in_ast_minus_leaf(),
     "parent_block": lambda c: c.all().parent_block(), "defining_type_decl": lambda c: c.all().defining_type_decl(), "defining_method": lambda c: c.all().defining_method(), "parent_expression": lambda c: c.all().parent_expression(), "statement": lambda c: c.all().statement(),
     "control_structures": lambda c: c.all().control_structures(), "control_structures_code": lambda c: c.all().control_structures("b.*"), "locals": lambda c: c.all().locals(), "top_level_expressions": lambda c: c.all().top_level_expressions()},
    {"ast": "SELECT graph_id, t AS id FROM (SELECT graph_id, f AS t FROM up)", "ast_condition": "SELECT up.graph_id, up.f AS id FROM up JOIN n x ON x.graph_id = up.graph_id AND x.id = up.f WHERE x.name = 'open'", "ast_minus_root": "SELECT graph_id, f AS id FROM up WHERE d > 0",
     "ast_siblings": "SELECT b.graph_id, b.dst AS id FROM e a JOIN e b ON a.graph_id = b.graph_id AND a.src = b.src AND a.etype = 'AST' AND b.etype = 'AST' AND a.dst <> b.dst",
     "in_ast": "SELECT upl.graph_id, t AS id FROM upl LEFT JOIN stop USING (graph_id, f) WHERE d <= coalesce(s, 1000)", "in_ast_minus_leaf": "SELECT upl.graph_id, t AS id FROM upl LEFT JOIN stop USING (graph_id, f) WHERE d > 0 AND d <= coalesce(s, 1000)",
     "parent_block": _NEAREST.format("BLOCK"), "defining_type_decl": _NEAREST.format("TYPE_DECL"), "defining_method": _NEAREST.format("METHOD"),
     "parent_expression": f"SELECT graph_id, t AS id FROM (SELECT graph_id, f, arg_min(t, d) AS t, arg_min(label, d) AS label FROM upl WHERE d > 0 AND NOT coalesce({_SKIP}, false) GROUP BY 1, 2) WHERE label IN {EXPR}",
     "statement": "SELECT a.graph_id, a.t AS id FROM upl a JOIN (SELECT graph_id, f, min(d) AS d FROM upl WHERE d > 0 AND label IN ('BLOCK', 'CONTROL_STRUCTURE', 'METHOD') GROUP BY 1, 2) b ON b.graph_id = a.graph_id AND b.f = a.f AND a.d = b.d - 1",
     "control_structures": "SELECT up.graph_id, x.id FROM up JOIN n x ON x.graph_id = up.graph_id AND x.id = up.f WHERE d > 0 AND x.label = 'CONTROL_STRUCTURE'", "control_structures_code": "SELECT up.graph_id, x.id FROM up JOIN n x ON x.graph_id = up.graph_id AND x.id = up.f WHERE d > 0 AND x.label = 'CONTROL_STRUCTURE' AND regexp_full_match(x.code, 'b.*')",
     "locals": "SELECT u.graph_id, x.id FROM upl u JOIN n x ON x.graph_id = u.graph_id AND x.id = u.f WHERE u.d > 0 AND u.t > 0 AND u.label = 'BLOCK' AND x.label = 'LOCAL'",
     "top_level_expressions": _hops(">AST:BLOCK >AST:EXPR")},
    _UP, apart=True,
)
_IN_METHOD = {f"contained_{s}": x for s, x in _CONTROLS.items()}
family(
    "contained", {s: (lambda c, s=s: getattr(c.method(), s)()) for s in _IN_METHOD},
    {s: f"SELECT u.graph_id, x.id FROM upl u JOIN n x ON x.graph_id = u.graph_id AND x.id = u.f WHERE u.d > 0 AND u.label = 'METHOD' AND x.label = 'CONTROL_STRUCTURE' AND x.control_structure_type = '{t}'" for s, t in _IN_METHOD.items()}, _UP,
)

# Control flow, calls and types.

_CFG1 = "SELECT e.graph_id, e.{far} AS id FROM ({cur}) c JOIN e ON e.graph_id = c.graph_id AND e.{near} = c.id AND etype = 'CFG' JOIN n x ON x.graph_id = e.graph_id AND x.id = e.{far} AND x.label IN " + CFGN + " AND x.label <> 'METHOD_RETURN'"
_FWD = lambda cur: _CFG1.format(far="dst", near="src", cur=cur)
_BWD = lambda cur: _CFG1.format(far="src", near="dst", cur=cur)
_ALL = "SELECT graph_id, id FROM n"
_OWNER = f"""SELECT o.graph_id, o.m AS id FROM own o JOIN ({{}}) q ON q.graph_id = o.graph_id AND q.id = o.id"""
_OWN = """own AS (SELECT e.graph_id, e.dst AS id, e.src AS m FROM e JOIN n p ON p.graph_id = e.graph_id AND p.id = e.dst JOIN n m ON m.graph_id = e.graph_id AND m.id = e.src AND m.label = 'METHOD'
        WHERE (etype = 'AST' AND p.label IN ('METHOD_PARAMETER_IN', 'METHOD_PARAMETER_OUT', 'METHOD_RETURN')) OR (etype = 'CONTAINS' AND p.label NOT IN ('METHOD_PARAMETER_IN', 'METHOD_PARAMETER_OUT', 'METHOD_RETURN', 'METHOD'))
        UNION ALL SELECT graph_id, id, id FROM n WHERE label = 'METHOD'),
    rc AS (SELECT DISTINCT e.graph_id, e.dst AS callee, own.m AS caller FROM e JOIN n k ON k.graph_id = e.graph_id AND k.id = e.src AND k.label = 'CALL' JOIN own ON own.graph_id = e.graph_id AND own.id = e.src WHERE etype = 'CALL'),
    back AS (SELECT graph_id, id FROM n WHERE label = 'METHOD' AND is_external UNION SELECT rc.graph_id, rc.caller FROM back JOIN rc ON rc.graph_id = back.graph_id AND rc.callee = back.id),
    back2 AS (SELECT rc.graph_id, rc.caller AS id FROM rc JOIN n ON n.graph_id = rc.graph_id AND n.id = rc.callee AND n.label = 'METHOD' AND n.is_external UNION SELECT rc.graph_id, rc.caller FROM back2 JOIN rc ON rc.graph_id = back2.graph_id AND rc.callee = back2.id)"""
family(
    "calls",
    {"cfg_next": lambda c: c.all().cfg_next(), "cfg_next_3": lambda c: c.all().cfg_next(3), "cfg_prev": lambda c: c.all().cfg_prev(), "cfg_prev_2": lambda c: c.all().cfg_prev(2), "method": lambda c: c.all().method(), "in_call": lambda c: c.all().in_call(),
     "argument_1": lambda c: c.all().argument(1), "to_parameter": lambda c: c.all().to_parameter(), "when_true": lambda c: c.all().when_true(), "when_false": lambda c: c.all().when_false(), "macro_expansion": lambda c: c.all().macro_expansion(),
     "caller": lambda c: c.method().caller(), "callee": lambda c: c.method().callee(), "call_to": lambda c: c.method().call_to(r"pkg\.T[0-3]"), "call_out": lambda c: c.method().call_out(), "call_out_regex": lambda c: c.method().call_out_regex(r"pkg\.T[2-5]"),
     "called_by_including_sink": lambda c: c.method().where("is_external").called_by_including_sink(c.method().where("line_number < 60")), "called_by": lambda c: c.method().where("is_external").called_by(c.method().where("line_number < 60")),
     "return_user": lambda c: c.method_return().return_user()},
    {"cfg_next": _FWD(_ALL), "cfg_next_3": f"{_FWD(_ALL)} UNION ALL {_FWD(_FWD(_ALL))} UNION ALL {_FWD(_FWD(_FWD(_ALL)))}", "cfg_prev": _BWD(_ALL), "cfg_prev_2": f"{_BWD(_ALL)} UNION ALL {_BWD(_BWD(_ALL))}", "method": _OWNER.format(_ALL),
     "in_call": "SELECT graph_id, id FROM (SELECT e.graph_id, k.id, k.label, row_number() OVER (PARTITION BY e.graph_id, e.dst ORDER BY k.id) AS rn FROM e JOIN n k ON k.graph_id = e.graph_id AND k.id = e.src WHERE etype = 'ARGUMENT') WHERE rn = 1 AND label = 'CALL'",
     "argument_1": f"SELECT q.graph_id, q.id FROM ({_hops('>ARGUMENT:EXPR')}) q JOIN n USING (graph_id, id) WHERE argument_index = 1",
     "to_parameter": "SELECT p.graph_id, p.id FROM n a JOIN e x ON x.graph_id = a.graph_id AND x.dst = a.id AND x.etype = 'ARGUMENT' JOIN n k ON k.graph_id = x.graph_id AND k.id = x.src AND k.label = 'CALL' JOIN e y ON y.graph_id = k.graph_id AND y.src = k.id AND y.etype = 'CALL' JOIN e z ON z.graph_id = y.graph_id AND z.src = y.dst AND z.etype = 'AST' JOIN n p ON p.graph_id = z.graph_id AND p.id = z.dst AND p.label = 'METHOD_PARAMETER_IN' AND p.\"index\" = a.argument_index",
     "when_true": f"SELECT q.graph_id, q.id FROM ({_hops('>')}) q JOIN n USING (graph_id, id) WHERE \"order\" = 2", "when_false": f"SELECT q.graph_id, q.id FROM ({_hops('>')}) q JOIN n USING (graph_id, id) WHERE \"order\" = 3",
     "macro_expansion": _hops(">AST:BLOCK >AST:EXPR", _n("dispatch_type = 'INLINED'")), "caller": _OWNER.format(_hops("<CALL:CALL", _n("label = 'METHOD'"))), "callee": _hops(">CONTAINS:CALL >CALL:METHOD", _n("label = 'METHOD'")),
     "call_to": f"SELECT q.graph_id, q.id FROM ({_hops('>CONTAINS:CALL', _n('''label = 'METHOD' '''))}) q WHERE EXISTS (SELECT 1 FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE e.graph_id = q.graph_id AND e.src = q.id AND etype = 'CALL' AND x.label = 'METHOD' AND regexp_full_match(x.full_name, 'pkg\\.T[0-3]'))",
     "call_out": _hops(">CONTAINS:CALL", _n("label = 'METHOD'")),
     "call_out_regex": f"SELECT q.graph_id, q.id FROM ({_hops('>CONTAINS:CALL', _n('''label = 'METHOD' '''))}) q WHERE EXISTS (SELECT 1 FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE e.graph_id = q.graph_id AND e.src = q.id AND etype = 'CALL' AND x.label = 'METHOD' AND regexp_full_match(x.full_name, 'pkg\\.T[2-5]'))",
     "called_by_including_sink": "SELECT b.graph_id, b.id FROM back b JOIN n USING (graph_id, id) WHERE line_number < 60", "called_by": "SELECT b.graph_id, b.id FROM back2 b JOIN n USING (graph_id, id) WHERE line_number < 60",
     "return_user": _hops("<AST:METHOD <CALL:CALL", _n("label = 'METHOD_RETURN'"))},
    _OWN,
)
_TYPE_OF = "EXISTS (SELECT 1 FROM e a JOIN n t ON t.graph_id = a.graph_id AND t.id = a.dst AND t.label = 'TYPE' JOIN e b ON b.graph_id = t.graph_id AND b.src = t.id AND b.etype = 'REF' JOIN n d ON d.graph_id = b.graph_id AND d.id = b.dst AND d.label = 'TYPE_DECL' WHERE a.graph_id = n.graph_id AND a.src = n.id AND a.etype = 'EVAL_TYPE' AND {})"
_TRANSITIVE = {"base_type_decl_transitive": ">INHERITS_FROM:TYPE >REF:TYPE_DECL", "derived_type_decl_transitive": "<REF:TYPE <INHERITS_FROM:TYPE_DECL", "derived_type_transitive": "<INHERITS_FROM:TYPE_DECL <REF:TYPE", "alias_type_decl_transitive": "<REF:TYPE <ALIAS_OF:TYPE_DECL", "alias_type_transitive": "<ALIAS_OF:TYPE_DECL <REF:TYPE"}
_DECLS = {"decl_annotations": ">AST:ANNOTATION", "decl_type_methods": ">AST:METHOD", "decl_type_members": ">AST:MEMBER", "decl_base_type": ">INHERITS_FROM:TYPE"}


def _pairs(name: str, chain: str) -> str:
    """(graph_id, f, t): a chain of hops from each node, once."""
    sql = "SELECT graph_id, id AS f, id FROM n"
    for hop in chain.split():
        near, far = ("src", "dst") if hop[0] == ">" else ("dst", "src")
        etype, _, label = hop[1:].partition(":")
        sql = f"SELECT e.graph_id, c.f, e.{far} AS id FROM ({sql}) c JOIN e ON e.graph_id = c.graph_id AND e.{near} = c.id AND e.etype = '{etype}' JOIN n x ON x.graph_id = e.graph_id AND x.id = e.{far} AND x.label = '{label}'"
    return f"{name}0 AS MATERIALIZED (SELECT DISTINCT graph_id, f, id AS t FROM ({sql})), {name} AS (SELECT * FROM {name}0 UNION SELECT a.graph_id, a.f, b.t FROM {name} a JOIN {name}0 b ON b.graph_id = a.graph_id AND b.f = a.t)"


_ALIAS = "EXISTS (SELECT 1 FROM al0 WHERE al0.graph_id = {0}.graph_id AND al0.f = {0}.{1})"
family(
    "types",
    {s: (lambda c, s=s: getattr(c.all(), s)()) for s in [*_TRANSITIVE, *_DECLS]}
    | {"unravel_alias": lambda c: c.type_decl().unravel_alias(), "canonical_type": lambda c: c.type_decl().canonical_type(), "eval_type_matching": lambda c: c.all().eval_type_matching(r"pkg\.T[01]", r"pkg\.T4"), "eval_type_none": lambda c: c.all().eval_type_matching(),
       "eval_type_exact": lambda c: c.all().eval_type_exact("pkg.T2", "pkg.T3"), "eval_type_not": lambda c: c.all().eval_type_not(r"pkg\.T[0-3]"), "method_namespace_block": lambda c: c.method().method_namespace_block()},
    {s: f"SELECT graph_id, t AS id FROM t{i}" for i, s in enumerate(_TRANSITIVE)} | {s: _hops(f">REF:TYPE_DECL {x}") for s, x in _DECLS.items()}
    | {"unravel_alias": _hops(">ALIAS_OF:TYPE >REF:TYPE_DECL", _n("label = 'TYPE_DECL'")) + " UNION ALL " + _n(f"label = 'TYPE_DECL' AND NOT {_ALIAS.format('n', 'id')}"),
       "canonical_type": f"SELECT al.graph_id, t AS id FROM al JOIN n ON n.graph_id = al.graph_id AND n.id = al.f AND n.label = 'TYPE_DECL' WHERE NOT {_ALIAS.format('al', 't')} UNION ALL " + _n(f"label = 'TYPE_DECL' AND NOT {_ALIAS.format('n', 'id')}"),
       "eval_type_matching": _n(_TYPE_OF.format("regexp_full_match(d.full_name, 'pkg\\.T[014]')")), "eval_type_none": _n("false"), "eval_type_exact": _n(_TYPE_OF.format("d.full_name IN ('pkg.T2', 'pkg.T3')")), "eval_type_not": _n(_TYPE_OF.format("NOT regexp_full_match(d.full_name, 'pkg\\.T[0-3]')")),
       "method_namespace_block": "SELECT p.graph_id, p.id FROM n m JOIN e ON e.graph_id = m.graph_id AND e.dst = m.id AND etype = 'AST' JOIN n p ON p.graph_id = e.graph_id AND p.id = e.src AND p.label = 'NAMESPACE_BLOCK' WHERE m.label = 'METHOD' UNION ALL "
           "SELECT p.graph_id, p.id FROM (SELECT u.graph_id, u.f, arg_min(u.t, u.d) AS t FROM upl u JOIN n m ON m.graph_id = u.graph_id AND m.id = u.f AND m.label = 'METHOD' WHERE u.d > 0 AND u.label = 'TYPE_DECL' "
           "AND NOT EXISTS (SELECT 1 FROM e JOIN n p ON p.graph_id = e.graph_id AND p.id = e.src AND p.label = 'NAMESPACE_BLOCK' WHERE e.graph_id = m.graph_id AND e.dst = m.id AND etype = 'AST') GROUP BY 1, 2) q "
           "JOIN e ON e.graph_id = q.graph_id AND e.dst = q.t AND etype = 'AST' JOIN n p ON p.graph_id = e.graph_id AND p.id = e.src AND p.label = 'NAMESPACE_BLOCK'"},
    ", ".join(_pairs(f"t{i}", x) for i, x in enumerate(_TRANSITIVE.values())) + ", " + _pairs("al", ">ALIAS_OF:TYPE >REF:TYPE_DECL") + ", " + _UP,
)

# Operators.

_OPS = {
    "assignment": "assignment assignmentMultiplication assignmentDivision assignmentModulo assignmentPlus assignmentMinus assignmentExponentiation assignmentShiftLeft assignmentLogicalShiftRight assignmentArithmeticShiftRight assignmentAnd assignmentOr assignmentXor preIncrement preDecrement postIncrement",
    "arithmetic": "addition subtraction multiplication division exponentiation modulo preIncrement preDecrement postIncrement postDecrement assignmentMultiplication assignmentDivision assignmentModulo assignmentPlus assignmentMinus assignmentExponentiation",
    "array_access": "indexAccess indirectIndexAccess", "field_access": "fieldAccess indirectFieldAccess memberAccess indirectMemberAccess",
}
_SET = {k: "(" + ", ".join(f"'<operator>.{o}'" for o in v.split()) + ")" for k, v in _OPS.items()}
_PLURAL = {"assignment": "assignments", "arithmetic": "arithmetics", "array_access": "array_accesss", "field_access": "field_accesss"}
_ARGS = "args AS (SELECT e.graph_id, e.src AS c, e.dst AS a, x.argument_index AS i, x.label, x.name FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE etype = 'ARGUMENT' AND x.label IN " + EXPR + ")"
family(
    "operators",
    {s: (lambda c, s=s: getattr(c, s)()) for s in _OPS} | {f"{s}_below": (lambda c, p=p: getattr(c.all(), p)()) for s, p in _PLURAL.items()} | {f"in_{s}": (lambda c, s=s: getattr(c.all(), f"in_{s}")()) for s in _OPS}
    | {"target": lambda c: c.all().target(), "source": lambda c: c.all().source(), "array": lambda c: c.all().array(), "offset": lambda c: c.all().offset(), "subscript": lambda c: c.all().subscript(), "uses_constant_offset": lambda c: c.all().uses_constant_offset(),
       "field_identifier": lambda c: c.all().field_identifier(), "pointer": lambda c: c.all().pointer()},
    {s: _n(f"label = 'CALL' AND name IN {x}") for s, x in _SET.items()} | {f"{s}_below": f"SELECT up.graph_id, x.id FROM up JOIN n x ON x.graph_id = up.graph_id AND x.id = up.f WHERE x.label = 'CALL' AND x.name IN {x}" for s, x in _SET.items()}
    | {f"in_{s}": f"SELECT upl.graph_id, t AS id FROM upl LEFT JOIN stop USING (graph_id, f) WHERE d <= coalesce(s, 1000) AND label = 'CALL' AND name IN {x}" for s, x in _SET.items()}
    | {"target": "SELECT graph_id, a AS id FROM args WHERE i = 1", "source": "SELECT graph_id, a AS id FROM (SELECT *, count(*) OVER (PARTITION BY graph_id, c) AS k FROM args) WHERE i = least(k, 2)", "array": "SELECT graph_id, a AS id FROM args WHERE i = 1", "offset": "SELECT graph_id, a AS id FROM args WHERE i = 2",
       "subscript": "SELECT up.graph_id, up.f AS id FROM args JOIN up ON up.graph_id = args.graph_id AND up.t = args.a JOIN n x ON x.graph_id = up.graph_id AND x.id = up.f AND x.label = 'IDENTIFIER' WHERE i = 2",
       "uses_constant_offset": "SELECT args.graph_id, args.c AS id FROM args JOIN up ON up.graph_id = args.graph_id AND up.t = args.a JOIN n x ON x.graph_id = up.graph_id AND x.id = up.f WHERE i = 2 GROUP BY 1, 2 HAVING count(*) FILTER (WHERE x.label = 'IDENTIFIER') > 0 OR count(*) FILTER (WHERE x.label = 'LITERAL') = 1",
       "field_identifier": "SELECT graph_id, a AS id FROM args WHERE i = 2 AND label = 'FIELD_IDENTIFIER'", "pointer": "SELECT args.graph_id, a AS id FROM args JOIN n ON n.graph_id = args.graph_id AND n.id = args.c AND n.name = '<operator>.indirection' WHERE i = 1"},
    _UP + ", " + _ARGS, apart=True,
)

# Combinators.

family(
    "combinators",
    {"where": lambda c: c.all().where("line_number > 50"), "matching": lambda c: c.all().matching("code", "a.*"), "not_matching": lambda c: c.all().not_matching("code", "a.*"), "exact": lambda c: c.all().exact("name", "beta", "open"), "out": lambda c: c.all().out(), "in": lambda c: c.all().in_("REF", "CALL"),
     "where_step": lambda c: c.all().where_step(lambda t: t.out("REF", label="METHOD")), "where_not_step": lambda c: c.all().where_not_step(lambda t: t.out("REF", label="METHOD")), "and": lambda c: c.all().and_(lambda t: t.out("REF"), lambda t: t.out("CFG")), "or": lambda c: c.all().or_(lambda t: t.out("REF"), lambda t: t.out("CFG")),
     "not": lambda c: c.all().not_(lambda t: t.out("CFG")), "dedup": lambda c: c.all().out("REF", "CALL").dedup(), "union": lambda c: c.call().union(c.method()), "intersect": lambda c: c.all().out("REF").intersect(c.method()), "minus": lambda c: c.all().out("REF").minus(c.method()),
     "repeat_emit": lambda c: c.call().repeat(lambda t: t.out("REF", "ARGUMENT"), 3), "repeat_last": lambda c: c.call().repeat(lambda t: t.out("REF", "ARGUMENT"), 2, emit=False), "coalesce": lambda c: c.all().coalesce(lambda t: t.where("false"), lambda t: t.label("TAG")), "choose": lambda c: c.all().choose(F.col("label") == "CALL", lambda t: t.out("ARGUMENT"), lambda t: t.out("CFG"))},
    {"where": _n("line_number > 50"), "matching": _n("regexp_full_match(code, 'a.*')"), "not_matching": _n("NOT regexp_full_match(code, 'a.*')"), "exact": _n("name IN ('beta', 'open')"), "out": "SELECT graph_id, dst AS id FROM e", "in": "SELECT graph_id, src AS id FROM e WHERE etype IN ('REF', 'CALL')",
     "where_step": "SELECT DISTINCT e.graph_id, e.src AS id FROM e JOIN n ON n.graph_id = e.graph_id AND n.id = e.dst AND n.label = 'METHOD' WHERE etype = 'REF'", "where_not_step": _n("(graph_id, id) NOT IN (SELECT (e.graph_id, e.src) FROM e JOIN n ON n.graph_id = e.graph_id AND n.id = e.dst AND n.label = 'METHOD' WHERE etype = 'REF')"),
     "and": "SELECT graph_id, src AS id FROM e WHERE etype = 'REF' INTERSECT SELECT graph_id, src FROM e WHERE etype = 'CFG'", "or": "SELECT DISTINCT graph_id, src AS id FROM e WHERE etype IN ('REF', 'CFG')", "not": "SELECT graph_id, id FROM n EXCEPT SELECT graph_id, src FROM e WHERE etype = 'CFG'",
     "dedup": "SELECT DISTINCT graph_id, dst AS id FROM e WHERE etype IN ('REF', 'CALL')", "union": _n("label IN ('CALL', 'METHOD')"), "intersect": "SELECT graph_id, dst AS id FROM e WHERE etype = 'REF' INTERSECT SELECT graph_id, id FROM n WHERE label = 'METHOD'", "minus": "SELECT graph_id, dst AS id FROM e WHERE etype = 'REF' EXCEPT SELECT graph_id, id FROM n WHERE label = 'METHOD'",
     "repeat_emit": "SELECT graph_id, id FROM r1 UNION ALL SELECT graph_id, id FROM r2 UNION ALL SELECT graph_id, id FROM r3", "repeat_last": "SELECT graph_id, id FROM r2", "coalesce": _n("label = 'TAG'"), "choose": "SELECT e.graph_id, dst AS id FROM e JOIN n ON n.graph_id = e.graph_id AND n.id = e.src WHERE etype = CASE WHEN label = 'CALL' THEN 'ARGUMENT' ELSE 'CFG' END"},
    """r1 AS (SELECT e.graph_id, e.dst AS id FROM e JOIN n ON n.graph_id = e.graph_id AND n.id = e.src AND n.label = 'CALL' WHERE etype IN ('REF', 'ARGUMENT')),
    r2 AS (SELECT e.graph_id, e.dst AS id FROM e JOIN r1 ON r1.graph_id = e.graph_id AND r1.id = e.src WHERE etype IN ('REF', 'ARGUMENT')), r3 AS (SELECT e.graph_id, e.dst AS id FROM e JOIN r2 ON r2.graph_id = e.graph_id AND r2.id = e.src WHERE etype IN ('REF', 'ARGUMENT'))""",
)

# Scanners.

_CALLS_OF = lambda regex: _hops("<CALL:CALL", _n(f"label = 'METHOD' AND regexp_full_match(name, '{regex}')"))
_DANGER = {"call-to-gets": "(?i)gets", "call-to-scanf": "(?i)scanf", "call-to-strcat": "(?i)(strcat|strncat)", "call-to-strcpy": "(?i)(strcpy|strncpy)", "call-to-strtok": "(?i)strtok", "call-to-getwd": "(?i)getwd", "call-to-strcpy-ghidra": "(.*_)?(strcpy|strncpy).*", "call-to-exec": "exec"}
_INTERNAL = "m.label = 'METHOD' AND NOT m.is_external AND m.name <> '<global>'"
_MEASURED = lambda what, least: f"SELECT m.graph_id, m.id FROM up JOIN n m ON m.graph_id = up.graph_id AND m.id = up.t JOIN n x ON x.graph_id = up.graph_id AND x.id = up.f WHERE d > 0 AND {_INTERNAL} AND {what} GROUP BY 1, 2 HAVING count(*) > {least}"
_NO_LITERAL = lambda regex, at: f"SELECT q.graph_id, q.id FROM ({_CALLS_OF(regex)}) q WHERE NOT EXISTS (SELECT 1 FROM e JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst WHERE e.graph_id = q.graph_id AND e.src = q.id AND etype = 'ARGUMENT' AND x.\"order\" = {at} AND x.label = 'LITERAL')"
_FREED = "SELECT a.graph_id, a.id, x.label, x.name, x.code FROM (SELECT e.graph_id, e.dst AS id FROM (" + _CALLS_OF("(?i)(.*_)?free") + f") c JOIN e ON e.graph_id = c.graph_id AND e.src = c.id AND etype = 'ARGUMENT') a JOIN n x ON x.graph_id = a.graph_id AND x.id = a.id AND x.argument_index = 1 AND x.label IN {EXPR}"
_SCANS = [*_DANGER, "format-controlled-printf", "too-many-params", "too-high-complexity", "too-long", "multiple-returns", "too-many-loops", "too-nested", "strlen-truncation", "signed-left-shift", "free-field-no-reassign", "free-returned-value", "free-follows-value-reuse"]
family(
    "scans", {s: (lambda c, s=s: scanners.REGISTRY[s].run(c)) for s in _SCANS},
    {s: _CALLS_OF(r) for s, r in _DANGER.items()}
    | {"format-controlled-printf": _NO_LITERAL("(?i)printf", 1) + " UNION ALL " + _NO_LITERAL("(?i)(sprintf|vsprintf)", 2), "too-many-params": _MEASURED("d = 1 AND x.label = 'METHOD_PARAMETER_IN'", 4), "too-high-complexity": _MEASURED("x.label = 'CONTROL_STRUCTURE'", 4),
       "too-long": f"SELECT graph_id, id FROM n m WHERE {_INTERNAL} AND coalesce(line_number_end - line_number + 1, 0) > 1000", "multiple-returns": _MEASURED("x.label = 'RETURN'", 1), "too-many-loops": _MEASURED("x.label = 'CONTROL_STRUCTURE' AND x.control_structure_type IN ('FOR', 'DO', 'WHILE')", 4),
       "too-nested": f"SELECT m.graph_id, m.id FROM n m JOIN (SELECT u.graph_id, u.t, u.f, count(*) AS k FROM up u JOIN up v ON v.graph_id = u.graph_id AND v.f = u.f AND v.d <= u.d JOIN n x ON x.graph_id = v.graph_id AND x.id = v.t AND x.label = 'CONTROL_STRUCTURE' GROUP BY 1, 2, 3) q ON q.graph_id = m.graph_id AND q.t = m.id WHERE {_INTERNAL} GROUP BY 1, 2 HAVING max(k) > 3",
       "strlen-truncation": f"SELECT a.graph_id, a.a AS id FROM ({_CALLS_OF('(?i)strlen')}) q JOIN (SELECT upl.graph_id, f, t FROM upl LEFT JOIN stop USING (graph_id, f) WHERE d <= coalesce(s, 1000) AND label = 'CALL' AND name IN {_SET['assignment']}) b ON b.graph_id = q.graph_id AND b.f = q.id JOIN args a ON a.graph_id = b.graph_id AND a.c = b.t AND a.i = 1 "
           "WHERE EXISTS (SELECT 1 FROM e JOIN n t ON t.graph_id = e.graph_id AND t.id = e.dst AND t.label = 'TYPE' AND t.full_name IN ('int', 'gint') WHERE e.graph_id = a.graph_id AND e.src = a.a AND etype = 'EVAL_TYPE')",
       "signed-left-shift": "SELECT graph_id, id FROM n WHERE label = 'CALL' AND name IN ('<operator>.shiftLeft', '<operator>.assignmentShiftLeft') AND EXISTS (SELECT 1 FROM args a JOIN e ON e.graph_id = a.graph_id AND e.src = a.a AND etype = 'EVAL_TYPE' JOIN n t ON t.graph_id = e.graph_id AND t.id = e.dst AND t.label = 'TYPE' AND t.full_name IN ('int', 'long') WHERE a.graph_id = n.graph_id AND a.c = n.id AND a.i = 1) "
           "AND (SELECT count(*) FROM args a WHERE a.graph_id = n.graph_id AND a.c = n.id AND a.label = 'LITERAL') <> 2",
       "free-field-no-reassign": f"SELECT graph_id, id FROM ({_FREED}) f WHERE label = 'CALL' AND name IN ('<operator>.fieldAccess', '<operator>.indirectFieldAccess') AND NOT EXISTS (SELECT 1 FROM n k JOIN args a ON a.graph_id = k.graph_id AND a.c = k.id AND a.i = 1 JOIN n y ON y.graph_id = a.graph_id AND y.id = a.a WHERE k.graph_id = f.graph_id AND k.label = 'CALL' AND k.name IN {_SET['assignment']} AND y.code = f.code)",
       "free-returned-value": f"SELECT graph_id, id FROM ({_FREED}) f WHERE label = 'IDENTIFIER' AND EXISTS (SELECT 1 FROM own o JOIN own p ON p.graph_id = o.graph_id AND p.m = o.m JOIN n i ON i.graph_id = p.graph_id AND i.id = p.id AND i.label = 'IDENTIFIER' AND i.name = f.name JOIN e ON e.graph_id = i.graph_id AND e.dst = i.id AND etype = 'ARGUMENT' JOIN n r ON r.graph_id = e.graph_id AND r.id = e.src AND r.label = 'RETURN' WHERE o.graph_id = f.graph_id AND o.id = f.id)",
       "free-follows-value-reuse": f"SELECT graph_id, id FROM ({_FREED}) f WHERE label = 'IDENTIFIER' AND EXISTS (SELECT 1 FROM (SELECT e.graph_id, e.dst, arg_min(e.src, e.src) AS c FROM e WHERE etype = 'ARGUMENT' GROUP BY 1, 2) q JOIN n k ON k.graph_id = q.graph_id AND k.id = q.c AND k.label = 'CALL' JOIN pd ON pd.graph_id = q.graph_id AND pd.f = q.c JOIN n x ON x.graph_id = pd.graph_id AND x.id = pd.t AND x.label = 'IDENTIFIER' AND x.name = f.name WHERE q.graph_id = f.graph_id AND q.dst = f.id)"},
    _UP + ", " + _ARGS + ", " + _OWN + ", " + _walk("pd", "POST_DOMINATE", True),
)

# Steps that give values.

rows("number_of_lines", lambda c: c.method().number_of_lines(), "SELECT graph_id, id, coalesce(line_number_end - line_number + 1, 0)::INTEGER AS n_lines FROM n WHERE label = 'METHOD'")
rows("address", lambda c: c.all().address(), "SELECT graph_id, id, lower(to_hex(line_number)) AS address FROM n")
rows("content", lambda c: c.method().content(), "SELECT n.graph_id, n.id, substring(f.content, n.\"offset\" + 1, n.offset_end - n.\"offset\") AS content FROM n LEFT JOIN e ON e.graph_id = n.graph_id AND e.src = n.id AND etype = 'SOURCE_FILE' LEFT JOIN n f ON f.graph_id = e.graph_id AND f.id = e.dst AND f.label = 'FILE' AND f.content <> '<empty>' WHERE n.label = 'METHOD'")
rows("repr", lambda c: c.all().repr(), "SELECT graph_id, id, CASE WHEN label IN ('METHOD', 'MEMBER') THEN name ELSE code END AS repr FROM n")
rows("location", lambda c: c.all().location(), """SELECT n.graph_id, n.id, coalesce(n.name, n.code) AS symbol, n.label, n.line_number, n.filename, m.full_name AS method_full_name FROM n
    LEFT JOIN e ON e.graph_id = n.graph_id AND e.dst = n.id AND etype = 'CONTAINS' LEFT JOIN n m ON m.graph_id = n.graph_id AND m.id = coalesce(e.src, n.id) AND m.label = 'METHOD'""")  # fmt: skip
rows("eval_type", lambda c: c.all().eval_type(), "SELECT a.graph_id, a.src AS id, d.full_name AS eval_type FROM e a JOIN n t ON t.graph_id = a.graph_id AND t.id = a.dst AND t.label = 'TYPE' JOIN e b ON b.graph_id = t.graph_id AND b.src = t.id AND b.etype = 'REF' JOIN n d ON d.graph_id = b.graph_id AND d.id = b.dst AND d.label = 'TYPE_DECL' WHERE a.etype = 'EVAL_TYPE'")
rows("simple_name", lambda c: c.all().simple_name(), "SELECT graph_id, a AS id, name FROM args WHERE i = 1 AND label = 'IDENTIFIER'", _ARGS)
rows("tag_list", lambda c: c.all().tag_list().select(*KEY, F.array_join(F.transform("tags", lambda t: F.concat(t["name"], F.lit("="), t["value"])), ",").alias("tags")), "SELECT e.graph_id, e.src AS id, array_to_string(list_sort(list_distinct(list(t.name || '=' || t.value))), ',') AS tags FROM e JOIN n t ON t.graph_id = e.graph_id AND t.id = e.dst AND t.label = 'TAG' WHERE etype = 'TAGGED_BY' GROUP BY 1, 2")
rows("new_tag", lambda c: Cpg(c.call().new_tag("seen", "yes")).tag("seen").tagged_call().df.select(*KEY), "SELECT graph_id, id FROM n WHERE label = 'CALL'")
rows("depth_of", lambda c: c.all().where("id < 4").depth(F.col("is_external")), """SELECT graph_id, root AS id, max(k)::INTEGER AS depth FROM dp GROUP BY 1, 2""", """dp AS (SELECT graph_id, id AS root, id, is_external::INTEGER AS k FROM n WHERE id < 4
    UNION ALL SELECT dp.graph_id, root, e.dst, k + x.is_external::INTEGER FROM dp JOIN e ON e.graph_id = dp.graph_id AND e.src = dp.id AND etype = 'AST' JOIN n x ON x.graph_id = e.graph_id AND x.id = e.dst)""")  # fmt: skip
rows("sorted", lambda c: c.call().sort_by("line_number", "id").df.select(*KEY), _n("label = 'CALL'"))
rows("grouped", lambda c: c.all().group_count("label", "dispatch_type"), "SELECT label, dispatch_type, count(*) AS n FROM n GROUP BY 1, 2")
rows("json", lambda c: c.call().to_json().select(*KEY, F.get_json_object("json", "$.name").alias("name"), F.get_json_object("json", "$.line_number").cast("int").alias("line")), "SELECT graph_id, id, name, line_number AS line FROM n WHERE label = 'CALL'")


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES
