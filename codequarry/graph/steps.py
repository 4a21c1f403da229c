"""The steps of the graph query language, over Traversal.

Most steps are a label scan, a hop over some edge types, a property test, or a chain of these; they are listed as data and
become methods of Steps. Those with logic of their own are written out. Names are the steps' names in snake case. Regular
expressions match the whole value. A step on a bag keeps duplicates unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codequarry.graph.model import CFG_NODE, EXPRESSION, KEY, NODE_COLUMNS, Graph, Traversal, full, merged, union
from codequarry.session import Scratch

# Node-type starters: name -> (label, column that the argument is matched with).
STARTERS: dict[str, tuple[str, str | None]] = {
    "annotation": ("ANNOTATION", None), "call": ("CALL", "name"), "config_file": ("CONFIG_FILE", "name"), "dependency": ("DEPENDENCY", "name"),
    "control_structure": ("CONTROL_STRUCTURE", "code"), "file": ("FILE", "name"), "identifier": ("IDENTIFIER", "name"), "jump_target": ("JUMP_TARGET", "name"),
    "local": ("LOCAL", "name"), "literal": ("LITERAL", "code"), "method": ("METHOD", "name"), "method_return": ("METHOD_RETURN", None), "member": ("MEMBER", "name"),
    "meta_data": ("META_DATA", None), "method_ref": ("METHOD_REF", None), "namespace": ("NAMESPACE", "name"), "namespace_block": ("NAMESPACE_BLOCK", "name"),
    "parameter": ("METHOD_PARAMETER_IN", "name"), "ret": ("RETURN", "code"), "imports": ("IMPORT", None), "typ": ("TYPE", "name"), "type_decl": ("TYPE_DECL", "name"),
    "tag": ("TAG", "name"), "template_dom": ("TEMPLATE_DOM", None), "type_ref": ("TYPE_REF", None), "comment": ("COMMENT", None),
}

# Control structures: starter name -> type.
CONTROL = {
    "break_": "BREAK", "continue_": "CONTINUE", "do_block": "DO", "else_block": "ELSE", "throws": "THROW", "for_block": "FOR", "goto": "GOTO",
    "if_block": "IF", "switch_block": "SWITCH", "try_block": "TRY", "while_block": "WHILE",
}

# Label narrowing.
NARROW = {
    "is_annotation": "ANNOTATION", "is_annotation_literal": "ANNOTATION_LITERAL", "is_array_initializer": "ARRAY_INITIALIZER", "is_block": "BLOCK",
    "is_control_structure": "CONTROL_STRUCTURE", "is_literal": "LITERAL", "is_local": "LOCAL", "is_identifier": "IDENTIFIER", "is_import": "IMPORT", "is_file": "FILE",
    "is_field_identifier": "FIELD_IDENTIFIER", "is_return": "RETURN", "is_member": "MEMBER", "is_method_ref": "METHOD_REF", "is_type_ref": "TYPE_REF", "is_method": "METHOD",
    "is_modifier": "MODIFIER", "is_namespace_block": "NAMESPACE_BLOCK", "is_parameter": "METHOD_PARAMETER_IN", "is_template_dom": "TEMPLATE_DOM", "is_type_decl": "TYPE_DECL",
}

# Property tests.
WHERE = {
    "is_static_dispatch": "dispatch_type = 'STATIC_DISPATCH'", "is_dynamic_dispatch": "dispatch_type = 'DYNAMIC_DISPATCH'",
    "is_external": "is_external", "is_internal": "NOT is_external", "is_alias": "alias_type_full_name IS NOT NULL", "is_canonical": "alias_type_full_name IS NULL",
    **{f"is_{k}": f"control_structure_type = '{v}'" for k, v in {"try": "TRY", "catch": "CATCH", "finally": "FINALLY", "if": "IF", "else": "ELSE", "switch": "SWITCH", "do": "DO", "for": "FOR", "while": "WHILE", "goto": "GOTO", "break": "BREAK", "continue": "CONTINUE", "throw": "THROW"}.items()},
}

# Modifiers: a MODIFIER child of the type.
MODIFIERS = {f"is_{m.lower()}": m for m in ("PUBLIC", "PRIVATE", "PROTECTED", "ABSTRACT", "STATIC", "NATIVE", "CONSTRUCTOR", "VIRTUAL", "MODULE", "LAMBDA")}

# Hops: name -> chain of (direction, edge types, label or family).
HOPS: dict[str, list[tuple[str, str, str | list[str] | None]]] = {
    "annotations": [("out", "AST", "ANNOTATION")], "receiver": [("out", "RECEIVER", EXPRESSION)], "received_call": [("in", "RECEIVER", "CALL")],
    "arguments": [("out", "ARGUMENT", EXPRESSION)], "condition": [("out", "CONDITION", EXPRESSION)], "refs_to": [("out", "REF", None)],
    "eval_types": [("out", "EVAL_TYPE", "TYPE")], "expression_up": [("in", "AST", EXPRESSION)], "expression_down": [("out", "AST", EXPRESSION)],
    "closure_binding": [("in", "REF", "CLOSURE_BINDING")], "captured_by_method_ref": [("in", "REF", "CLOSURE_BINDING"), ("in", "CAPTURE", "METHOD_REF")],
    "captured_by_type_ref": [("in", "REF", "CLOSURE_BINDING"), ("in", "CAPTURE", "TYPE_REF")], "to_method_return": [("out", "CALL", "METHOD"), ("out", "AST", "METHOD_RETURN")],
    "body": [("out", "AST", "BLOCK")], "parameters": [("out", "AST", "METHOD_PARAMETER_IN")], "parameters_out": [("out", "AST", "METHOD_PARAMETER_OUT")],
    "method_returns": [("out", "AST", "METHOD_RETURN")], "param_in": [("in", "PARAMETER_LINK", "METHOD_PARAMETER_IN")], "param_out": [("out", "PARAMETER_LINK", "METHOD_PARAMETER_OUT")],
    "cfg_last": [("out", "AST", "METHOD_RETURN"), ("in", "CFG", CFG_NODE)], "cfg_prev_all": [("in", "CFG", CFG_NODE)],
    "ast_parent": [("in", "AST", None)], "parent_method": [("in", "AST", "METHOD")], "cfg_nodes": [("out", "CONTAINS", CFG_NODE)], "calls": [("out", "CONTAINS", "CALL")],
    "call_in": [("in", "CALL", "CALL")], "callees_of_call": [("out", "CALL", "METHOD")], "referenced_imports": [("out", "IS_CALL_FOR_IMPORT", "IMPORT")],
    "import_calls": [("in", "IS_CALL_FOR_IMPORT", "CALL")], "dependency_imports": [("in", "IMPORTS", "IMPORT")],
    "ref_type_decl": [("out", "REF", "TYPE_DECL")], "referencing_type": [("in", "REF", "TYPE")], "base_type": [("out", "INHERITS_FROM", "TYPE")],
    "base_type_decl": [("out", "INHERITS_FROM", "TYPE"), ("out", "REF", "TYPE_DECL")], "derived_type_decl": [("in", "REF", "TYPE"), ("in", "INHERITS_FROM", "TYPE_DECL")],
    "derived_type": [("in", "INHERITS_FROM", "TYPE_DECL"), ("in", "REF", "TYPE")], "alias_type_decl": [("in", "REF", "TYPE"), ("in", "ALIAS_OF", "TYPE_DECL")], "alias_type": [("in", "ALIAS_OF", "TYPE_DECL"), ("in", "REF", "TYPE")],
    "type_methods": [("out", "AST", "METHOD")], "type_members": [("out", "AST", "MEMBER")], "type_decls": [("out", "AST", "TYPE_DECL")],
    "member_refs": [("in", "REF", "CALL")], "namespaces": [("out", "REF", "NAMESPACE")], "namespace_blocks_of_file": [("in", "SOURCE_FILE", "NAMESPACE_BLOCK")],
    "locals_of_type": [("in", "EVAL_TYPE", "LOCAL")], "members_of_type": [("in", "EVAL_TYPE", "MEMBER")], "parameters_of_type": [("in", "EVAL_TYPE", "METHOD_PARAMETER_IN")],
    "method_returns_of_type": [("in", "EVAL_TYPE", "METHOD_RETURN")], "expressions_of_type": [("in", "EVAL_TYPE", EXPRESSION)],
    "parameter_assigns": [("out", "AST", "ANNOTATION_PARAMETER_ASSIGN")], "annotation_parameters": [("out", "AST", "ANNOTATION_PARAMETER")],
    "annotation_values": [("out", "AST", EXPRESSION)], "annotated_method": [("in", "AST", "METHOD")], "annotated_type_decl": [("in", "AST", "TYPE_DECL")],
    "annotated_member": [("in", "AST", "MEMBER")], "annotated_parameter": [("in", "AST", "METHOD_PARAMETER_IN")],
    "binding_type_decl": [("in", "REF", "BINDING"), ("in", "BINDS", "TYPE_DECL")], "referencing_binding": [("in", "REF", "BINDING")],
    "bound_method": [("out", "BINDS", "BINDING"), ("out", "REF", "METHOD")], "method_binding": [("out", "BINDS", "BINDING")],
    "tags": [("out", "TAGGED_BY", "TAG")], "source_file": [("out", "SOURCE_FILE", "FILE")], "modifiers": [("out", "", "MODIFIER")],
    **{f"tagged_{n}": [("in", "TAGGED_BY", lab)] for n, lab in {"member": "MEMBER", "method": "METHOD", "method_return": "METHOD_RETURN", "parameter": "METHOD_PARAMETER_IN", "parameter_out": "METHOD_PARAMETER_OUT", "call": "CALL", "identifier": "IDENTIFIER", "literal": "LITERAL", "local": "LOCAL", "file": "FILE"}.items()},
}

# Closures with the start left out: name -> (edge types, against the edges, label).
CLOSURES = {
    "controlled_by": ("CDG", True), "controls": ("CDG", False), "dominated_by": ("DOMINATE", True), "dominates": ("DOMINATE", False),
    "post_dominated_by": ("POST_DOMINATE", True), "post_dominates": ("POST_DOMINATE", False),
}

# Operator calls by kind. The combined set names the same operator twice and one not at all, as its users expect.
ASSIGNMENT = [f"<operator>.{o}" for o in ("assignment", "assignmentMultiplication", "assignmentDivision", "assignmentModulo", "assignmentPlus", "assignmentMinus", "assignmentExponentiation", "assignmentShiftLeft", "assignmentLogicalShiftRight", "assignmentArithmeticShiftRight", "assignmentAnd", "assignmentOr", "assignmentXor", "preIncrement", "preDecrement", "postIncrement")]
ARITHMETIC = [f"<operator>.{o}" for o in ("addition", "subtraction", "multiplication", "division", "exponentiation", "modulo", "preIncrement", "preDecrement", "postIncrement", "postDecrement", "assignmentMultiplication", "assignmentDivision", "assignmentModulo", "assignmentPlus", "assignmentMinus", "assignmentExponentiation")]
ARRAY_ACCESS = ["<operator>.indexAccess", "<operator>.indirectIndexAccess"]
FIELD_ACCESS = ["<operator>.fieldAccess", "<operator>.indirectFieldAccess", "<operator>.memberAccess", "<operator>.indirectMemberAccess"]
OPERATORS = {"assignment": ASSIGNMENT, "arithmetic": ARITHMETIC, "array_access": ARRAY_ACCESS, "field_access": FIELD_ACCESS}
MEMBER_ACCESS = [*ARRAY_ACCESS, *FIELD_ACCESS, "<operator>.indirection", "<operator>.addressOf", "<operator>.pointerShift", "<operator>.getElementPtr"]


class Cpg:
    """Starting points over a graph: cpg.method('main').ast()..."""

    def __init__(self, graph: Graph):
        self.graph = graph

    def _start(self, condition: Column | str | None = None) -> Steps:
        return Steps(self.graph, self.graph.nodes if condition is None else self.graph.nodes.where(condition))

    def all(self) -> Steps:
        return self._start()

    def argument(self, code: str | None = None) -> Steps:
        t = Steps.of(self._start("label = 'CALL'").out("ARGUMENT", label=EXPRESSION))
        return t if code is None else t.matching("code", code)

    def method_ref(self, name: str | None = None) -> Steps:
        t = self._start("label = 'METHOD_REF'")
        return t if name is None else t.where_step(lambda x: x.out("REF", label="METHOD").matching("name", name))

    def comment(self, code: str | None = None) -> Steps:
        """Here the argument is compared for equality."""
        t = self._start("label = 'COMMENT'")
        return t if code is None else t.exact("code", code)


def _starter(label: str, column: str | None):
    def step(self: Cpg, pattern: str | None = None) -> Steps:
        t = self._start(F.col("label") == label)
        return t if pattern is None else t.matching(column or "name", pattern)

    return step


for _name, (_label, _column) in STARTERS.items():
    if not hasattr(Cpg, _name):
        setattr(Cpg, _name, _starter(_label, _column))
for _name, _type in CONTROL.items():
    setattr(Cpg, _name, lambda self, t=_type: self._start((F.col("label") == "CONTROL_STRUCTURE") & (F.col("control_structure_type") == t)))
for _name, _set in OPERATORS.items():
    setattr(Cpg, _name, lambda self, s=_set: self._start((F.col("label") == "CALL") & F.col("name").isin(s)))


class Steps(Traversal):
    @staticmethod
    def of(t: Traversal) -> Steps:
        return Steps(t.graph, t.df, t.carry)

    def _with(self, df: DataFrame) -> Steps:
        return Steps(self.graph, df, self.carry)

    def keeping(self, name: str = "_start") -> Steps:
        return Steps.of(super().keeping(name))

    def _hits(self, step: Callable) -> DataFrame:
        t = Steps(self.graph, self.df.select(*NODE_COLUMNS).dropDuplicates(KEY)).keeping("_start")
        return step(t).df.select("_start.graph_id", "_start.id").distinct()

    # The syntax tree.

    def ast(self, condition: Column | None = None) -> Steps:
        """Descendants and the start itself."""
        t = self.reached(["AST"], with_self=True)
        return t if condition is None else t.where(condition)

    def ast_minus_root(self) -> Steps:
        return self.reached(["AST"])

    def ast_children(self) -> Steps:
        return self.out("AST").sort_by("order")

    def ast_siblings(self) -> Steps:
        t = self.keeping("_me").in_("AST").out("AST").where("_me.id <> id")
        return Steps(self.graph, t.df.drop("_me"), self.carry)

    def in_ast(self) -> Steps:
        """Ancestors and the start itself, up to the METHOD."""
        return self._up(True)

    def in_ast_minus_leaf(self) -> Steps:
        return self._up(False)

    def _up(self, with_self: bool) -> Steps:
        # above a METHOD nothing is taken; the METHOD nearest to the start ends the walk
        up = self.graph.pairs(["AST"]).select("graph_id", F.col("to").alias("_leaf"), F.col("id").alias("_far"), "depth")
        if with_self:
            up = up.unionByName(self.graph.nodes.select("graph_id", F.col("id").alias("_leaf"), F.col("id").alias("_far"), F.lit(0).alias("depth")))
        start = self.df.select("graph_id", F.col("id").alias("_leaf"), (F.col("label") == "METHOD").alias("_own"), *self.carry)
        stop = self.graph.above_label("METHOD").select("graph_id", F.col("id").alias("_leaf"), F.col("depth").alias("_stop"))
        rows = start.join(up, ["graph_id", "_leaf"]).join(stop, ["graph_id", "_leaf"], "left")
        ends = rows.where(F.col("depth") <= F.when(F.col("_own"), 0).otherwise(F.coalesce("_stop", F.lit(2**31 - 1))))
        return self._at(ends.select(F.col("graph_id").alias("_g"), "_far", *self.carry), None)

    def nearest(self, label: str) -> Steps:
        """The nearest proper ancestor with a label."""
        up = self.graph.above_label(label).select("graph_id", "id", F.col("above").alias("_far"))
        ends = self.df.select(*KEY, *self.carry).join(up, KEY).select(F.col("graph_id").alias("_g"), "_far", *self.carry)
        return self._at(ends, None)

    def parent_block(self) -> Steps:
        return self.nearest("BLOCK")

    def defining_type_decl(self) -> Steps:
        return self.nearest("TYPE_DECL")

    def defining_method(self) -> Steps:
        return self.nearest("METHOD")

    def contains_call_to(self, regex: str) -> Steps:
        return self.where_step(lambda t: t.reached(["AST"], label="CALL", with_self=True).matching("name", regex))

    def is_call_to(self, regex: str) -> Steps:
        return self.label("CALL").matching("name", regex)

    def is_call(self, regex: str | None = None) -> Steps:
        """The argument is matched with the code, not the name."""
        t = self.label("CALL")
        return t if regex is None else t.matching("code", regex)

    def is_cfg_node(self) -> Steps:
        return self.label(*CFG_NODE)

    def is_expression(self) -> Steps:
        return self.label(*EXPRESSION)

    def depth(self, condition: Column | None = None) -> DataFrame:
        """(graph_id, id, depth): the most nodes that meet a condition on a path from the start down to a leaf; without
        one, the number of edges of the longest path."""
        pred = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
        below = self.graph.closure(["AST"], self.df).select(F.col("graph_id").alias("g"), F.col("id").alias("root"), F.col("to").alias("n"), "depth")
        if condition is None:
            return self.df.select(*KEY).distinct().join(below, (F.col("graph_id") == F.col("g")) & (F.col("id") == F.col("root")), "left").groupBy(*KEY).agg(F.coalesce(F.max("depth"), F.lit(0)).alias("depth"))
        marked = self.graph.nodes.where(pred).select(F.col("graph_id").alias("mg"), F.col("id").alias("mn"))
        # a node's count on its path from the root: marked nodes between the root and it, both included
        inner = self.graph.closure(["AST"]).select(F.col("graph_id").alias("ig"), F.col("id").alias("up"), F.col("to").alias("down"))
        inner = inner.unionByName(self.graph.nodes.select(F.col("graph_id").alias("ig"), F.col("id").alias("up"), F.col("id").alias("down")))
        tree = below.select("g", "root", "n").unionByName(self.df.select(F.col("graph_id").alias("g"), F.col("id").alias("root"), F.col("id").alias("n")).distinct())
        hits = tree.join(marked, (F.col("g") == F.col("mg")) & (F.col("n") == F.col("mn"))).select("g", "root", "n")
        per = hits.join(inner, (F.col("g") == F.col("ig")) & (F.col("n") == F.col("up"))).groupBy("g", "root", "down").agg(F.count(F.lit(1)).alias("k"))
        most = per.groupBy("g", "root").agg(F.max("k").alias("k"))
        return self.df.select(*KEY).distinct().join(most, (F.col("graph_id") == F.col("g")) & (F.col("id") == F.col("root")), "left").select(*KEY, F.coalesce("k", F.lit(0)).cast("int").alias("depth"))

    def walk_ast_until_reaching(self, labels: list[str]) -> Steps:
        """What lies below the start without passing one of the labels, each node once; the labelled nodes are not walked through."""
        stops = self.graph.nodes.where(F.col("label").isin(labels)).select(F.col("graph_id").alias("sg"), F.col("id").alias("sid"))
        e = self.graph.etype("AST").join(stops, (F.col("graph_id") == F.col("sg")) & (F.col("src") == F.col("sid")), "left_anti")
        cut = Graph(self.graph.nodes, e)
        return Steps(self.graph, Steps(cut, self.df, self.carry).reached(["AST"]).df, self.carry).dedup()

    def repr(self) -> DataFrame:
        return self.df.select(*KEY, F.when(F.col("label").isin("METHOD", "MEMBER"), F.col("name")).otherwise(F.col("code")).alias("repr"))

    def parent_expression(self) -> Steps:
        """The nearest ancestor that is no member access, if that is an expression."""
        skip = F.coalesce((F.col("label") == "CALL") & F.col("name").isin(MEMBER_ACCESS), F.lit(False))
        up = self.graph.above(~skip).select("graph_id", "id", F.col("above").alias("_far"))
        return self._at(self.df.select(*KEY, *self.carry).join(up, KEY).select(F.col("graph_id").alias("_g"), "_far", *self.carry), EXPRESSION)

    def statement(self) -> Steps:
        """The child of the enclosing block, control structure or method that holds the start, or the start itself."""
        block = F.col("label").isin("BLOCK", "CONTROL_STRUCTURE", "METHOD")
        top = self.graph.above(block).select("graph_id", "id", (F.col("depth") - 1).alias("depth"))
        # the ancestor one level below it
        up = self.graph.pairs(["AST"]).select("graph_id", F.col("to").alias("id"), F.col("id").alias("_far"), "depth")
        at = top.where("depth > 0").join(up, ["graph_id", "id", "depth"]).select("graph_id", "id", "_far").unionByName(top.where("depth = 0").select("graph_id", "id", F.col("id").alias("_far")))
        return self._at(self.df.select(*KEY, *self.carry).join(at, KEY).select(F.col("graph_id").alias("_g"), "_far", *self.carry), None)

    # Control flow.

    def cfg_next(self, n: int = 1) -> Steps:
        return self.repeat(lambda t: t.out("CFG", label=CFG_NODE).where("label <> 'METHOD_RETURN'"), n)

    def cfg_prev(self, n: int = 1) -> Steps:
        return self.repeat(lambda t: t.in_("CFG", label=CFG_NODE).where("label <> 'METHOD_RETURN'"), n)

    def passes(self, included: Traversal) -> Steps:
        ids = included.df.select(*KEY).distinct()
        return self._paths_semi(ids, "left_semi")

    def passes_not(self, excluded: Traversal) -> Steps:
        return self._paths_semi(excluded.df.select(*KEY).distinct(), "left_anti")

    def _paths_semi(self, ids: DataFrame, how: str) -> Steps:
        post = self.graph.closure(["POST_DOMINATE"], self.df, reverse=True).select("graph_id", F.col("id").alias("_n"), F.col("to").alias("id"))
        hit = post.join(ids, KEY).select("graph_id", F.col("_n").alias("id")).distinct()
        return self._with(self.df.join(hit, KEY, how))

    def method(self) -> Steps:
        """The enclosing METHOD: over CONTAINS for nodes of the control flow, over AST for parameters and returns."""
        direct = self.label("METHOD_PARAMETER_IN", "METHOD_PARAMETER_OUT", "METHOD_RETURN").in_("AST", label="METHOD")
        rest = self.where(~F.col("label").isin("METHOD_PARAMETER_IN", "METHOD_PARAMETER_OUT", "METHOD_RETURN", "METHOD")).in_("CONTAINS", label="METHOD")
        return direct.union(rest).union(self.label("METHOD"))

    def address(self) -> DataFrame:
        return self.df.select(*KEY, F.lower(F.hex("line_number")).alias("address"))

    # Expressions and calls.

    def is_argument(self) -> Steps:
        e = self.graph.etype("ARGUMENT").select("graph_id", F.col("dst").alias("id")).distinct()
        return self._with(self.df.join(e, KEY, "left_semi"))

    def in_call(self) -> Steps:
        """The first node that the start is an argument of, if that is a call."""
        t = self.keeping("_arg").in_("ARGUMENT")
        first = t.df.withColumn("_rn", F.row_number().over(Window.partitionBy("_arg").orderBy("id"))).where("_rn = 1 AND label = 'CALL'").drop("_rn", "_arg")
        return Steps(self.graph, first, self.carry)

    def argument(self, index: int | None = None) -> Steps:
        t = self.out("ARGUMENT", label=EXPRESSION)
        return t if index is None else t.where(F.col("argument_index") == index)

    def to_parameter(self) -> Steps:
        """The parameter of each called method that the start is passed to."""
        t = self.where("argument_index IS NOT NULL").keeping("_arg").withcol("_ai", F.col("argument_index"))
        return t.in_("ARGUMENT", label="CALL").out("CALL", label="METHOD").out("AST", label="METHOD_PARAMETER_IN").where("`index` = _ai").dropping("_arg", "_ai")

    def withcol(self, name: str, value: Column) -> Steps:
        return Steps(self.graph, self.df.withColumn(name, value), (*self.carry, name))

    def dropping(self, *names: str) -> Steps:
        return Steps(self.graph, self.df.drop(*names), tuple(c for c in self.carry if c not in names))

    def condition_matching(self, regex: str) -> Steps:
        return self.where_step(lambda t: t.out("CONDITION").matching("code", regex))

    def when_true(self) -> Steps:
        """Children with order 2 over edges of any type."""
        return self.out().where("`order` = 2")

    def when_false(self) -> Steps:
        return self.out().where("`order` = 3")

    def macro_expansion(self) -> Steps:
        return self.where("dispatch_type = 'INLINED'").out("AST", label="BLOCK").out("AST", label=EXPRESSION)

    # Methods, parameters, types.

    def is_stub(self) -> Steps:
        return self.where_not_step(lambda t: t.out("CFG").where("label <> 'METHOD_RETURN'"))

    def is_not_stub(self) -> Steps:
        return self.where_step(lambda t: t.out("CFG").where("label <> 'METHOD_RETURN'"))

    def is_variadic(self) -> Steps:
        return self.where_step(lambda t: t.out("AST", label="METHOD_PARAMETER_IN").where("is_variadic"))

    def locals(self) -> Steps:
        return self.out("AST", label="BLOCK").reached(["AST"], label="LOCAL")

    def control_structures(self, regex: str | None = None) -> Steps:
        t = self.reached(["AST"], label="CONTROL_STRUCTURE")
        return t if regex is None else t.matching("code", regex)

    def top_level_expressions(self) -> Steps:
        return self.out("AST", label="BLOCK").out("AST", label=EXPRESSION).where("label <> 'LOCAL'")

    def method_namespace_block(self) -> Steps:
        """The block that a method lies in directly, else its type's."""
        direct = self.where_step(lambda t: t.in_("AST", label="NAMESPACE_BLOCK"))
        rest = self.where_not_step(lambda t: t.in_("AST", label="NAMESPACE_BLOCK"))
        return direct.in_("AST", label="NAMESPACE_BLOCK").union(rest.nearest("TYPE_DECL").in_("AST", label="NAMESPACE_BLOCK"))

    def number_of_lines(self) -> DataFrame:
        return self.df.select(*KEY, F.coalesce(F.col("line_number_end") - F.col("line_number") + 1, F.lit(0)).alias("n_lines"))

    def content(self) -> DataFrame:
        """The part of the file's content that a method or type spans; null where the file has none."""
        f = self.graph.nodes.where("label = 'FILE' AND content IS NOT NULL AND content <> '<empty>'").select(F.col("graph_id").alias("fg"), F.col("id").alias("fid"), F.col("content").alias("text"))
        e = self.graph.etype("SOURCE_FILE").select(F.col("graph_id").alias("eg"), "src", "dst")
        j = self.df.select(*KEY, "offset", "offset_end").join(e, (F.col("graph_id") == F.col("eg")) & (F.col("id") == F.col("src")), "left").join(f, (F.col("graph_id") == F.col("fg")) & (F.col("dst") == F.col("fid")), "left")
        return j.select(*KEY, F.substring("text", F.col("offset") + 1, F.col("offset_end") - F.col("offset")).alias("content"))

    def location(self) -> DataFrame:
        """(graph_id, id, symbol, label, line_number, filename, method_full_name), null where unknown."""
        m = self.graph.etype("CONTAINS").select(F.col("graph_id").alias("mg"), "src", F.col("dst").alias("mid"))
        names = self.graph.nodes.where("label = 'METHOD'").select(F.col("graph_id").alias("ng"), F.col("id").alias("nid"), F.coalesce("full_name", "name").alias("_mn"), F.col("filename").alias("_mf"))
        j = self.df.join(m, (F.col("graph_id") == F.col("mg")) & (F.col("id") == F.col("mid")), "left")
        j = j.join(names, (F.col("graph_id") == F.col("ng")) & (F.coalesce("src", F.col("id")) == F.col("nid")), "left")
        return j.select(*KEY, F.coalesce("name", "code").alias("symbol"), "label", "line_number", F.coalesce("filename", "_mf").alias("filename"), F.col("_mn").alias("method_full_name"))

    def canonical_type(self) -> Steps:
        """The type at the end of a chain of aliases, each once for each start; a chain that ends in a circle has none."""
        via = lambda t: t.out("ALIAS_OF", label="TYPE").out("REF", label="TYPE_DECL")
        t = self.keeping("_root")
        return t.union(t._chased(via)).where_not_step(via).dropping("_root")

    def unravel_alias(self) -> Steps:
        via = lambda t: t.out("ALIAS_OF", label="TYPE").out("REF", label="TYPE_DECL")
        return via(self.where_step(via)).union(self.where_not_step(via))

    def _chased(self, step: Callable[[Steps], Steps]) -> Steps:
        """What a step reaches again and again from each _root, each node once; rounds are written and go on until nothing is new."""
        scratch = Scratch(self.graph.nodes.sparkSession)
        key = [*KEY, "_root"]
        now = step(self).dedup()
        now = now._with(scratch.save(now.df))
        seen = [now.df]
        while not now.is_empty():
            seen = merged(seen, scratch)
            now = step(now).dedup()
            now = now._with(scratch.save(now.df.join(union(seen).select(*key), key, "left_anti")))
            seen.append(now.df)
        return self._with(union(seen))

    def _transitive(self, chain: str) -> Steps:
        """Closure of a chain of hops, the start left out unless a circle leads back to it, each node once for each start."""
        return self.keeping("_root")._chased(lambda t: getattr(t, chain)()).dropping("_root")

    def alias_type_transitive(self) -> Steps:
        return self._transitive("alias_type")

    def base_type_decl_transitive(self) -> Steps:
        return self._transitive("base_type_decl")

    def derived_type_decl_transitive(self) -> Steps:
        return self._transitive("derived_type_decl")

    def derived_type_transitive(self) -> Steps:
        return self._transitive("derived_type")

    def alias_type_decl_transitive(self) -> Steps:
        return self._transitive("alias_type_decl")

    def _of_type_decl(self, step: str) -> Steps:
        """A step of the type's declaration, from TYPE nodes."""
        return getattr(self.out("REF", label="TYPE_DECL"), step)()

    def eval_type(self) -> DataFrame:
        t = self.keeping("_n").out("EVAL_TYPE", label="TYPE").out("REF", label="TYPE_DECL")
        return t.df.select("_n.graph_id", "_n.id", F.col("full_name").alias("eval_type"))

    def eval_type_matching(self, *regexes: str) -> Steps:
        """Some type matches one of the expressions; none given, none kept."""
        if not regexes:
            return self.where(F.lit(False))
        return self.where_step(lambda t: t.out("EVAL_TYPE", label="TYPE").out("REF", label="TYPE_DECL").where(_any_match("full_name", regexes)))

    def eval_type_exact(self, *values: str) -> Steps:
        return self.where_step(lambda t: t.out("EVAL_TYPE", label="TYPE").out("REF", label="TYPE_DECL").exact("full_name", *values))

    def eval_type_not(self, *regexes: str) -> Steps:
        """Some type matches none of the expressions; nodes without a type are dropped."""
        return self.where_step(lambda t: t.out("EVAL_TYPE", label="TYPE").out("REF", label="TYPE_DECL").where(~_any_match("full_name", regexes)))

    def has_modifier(self, regex: str) -> Steps:
        return self.where_step(lambda t: t.out(label="MODIFIER").matching("modifier_type", regex))

    # The call graph.

    def caller(self) -> Steps:
        return self.in_("CALL", label="CALL").method()

    def callee(self) -> Steps:
        return self.out("CONTAINS", label="CALL").out("CALL", label="METHOD")

    def call_to(self, regex: str) -> Steps:
        """Contained calls of methods whose full name matches."""
        return self.out("CONTAINS", label="CALL").where_step(lambda t: t.out("CALL", label="METHOD").matching("full_name", regex))

    def called_by(self, source: Traversal) -> Steps:
        return self.caller().called_by_including_sink(source)

    def called_by_including_sink(self, source: Traversal) -> Steps:
        """Methods of source from which the start is reached over calls, each once."""
        ids = source.df.select(*KEY).distinct()
        # one root for all: what is reached from any start
        one = Steps(self.graph, self.df.select(*NODE_COLUMNS).withColumn("_root", F.lit(0)), ("_root",)).dedup()
        seen = one.union(one._chased(lambda t: t.caller())).dropping("_root").dedup()
        return seen._with(seen.df.join(ids, KEY, "left_semi"))

    def call_out(self) -> Steps:
        return self.out("CONTAINS", label="CALL")

    def call_out_regex(self, regex: str) -> Steps:
        return self.call_to(regex)

    def return_user(self) -> Steps:
        """Calls of the methods that the start returns from."""
        return self.in_("AST", label="METHOD").in_("CALL", label="CALL")

    # Calls that are not in the graph come from a resolver: edges of the calls that it knows. The default one adds none.

    def resolved(self, resolver: Callable[[Graph], DataFrame] | None = None) -> Steps:
        """The same elements in a graph with the resolver's CALL edges (graph_id, src, dst), each once."""
        if resolver is None:
            return self
        new = resolver(self.graph).select("graph_id", "src", "dst", F.lit("CALL").alias("etype"))
        old = self.graph.etype("CALL").select("graph_id", "src", "dst")
        g = self.graph.with_edges(new.distinct().join(old, ["graph_id", "src", "dst"], "left_anti"))
        return Steps(g, self.df, self.carry)

    def called_methods(self, resolver: Callable[[Graph], DataFrame] | None = None) -> Steps:
        return self.resolved(resolver).out("CALL", label="METHOD")

    def method_callsites(self, resolver: Callable[[Graph], DataFrame] | None = None) -> Steps:
        return self.resolved(resolver).in_("CALL", label="CALL").dedup()

    def unresolved_method_full_names(self) -> DataFrame:
        """(graph_id, id, method_full_name): calls that no CALL edge leaves, with the name that a resolver would look for."""
        e = self.graph.etype("CALL").select("graph_id", F.col("src").alias("id")).distinct()
        return self.label("CALL").df.join(e, KEY, "left_anti").select(*KEY, "method_full_name")

    # Operators.

    def target(self) -> Steps:
        return self.argument(1)

    def source(self) -> Steps:
        """The assigned value: the second argument, or the only one."""
        t = self.keeping("_call").out("ARGUMENT", label=EXPRESSION)
        n = F.count(F.lit(1)).over(Window.partitionBy("_call"))
        return t._with(t.df.withColumn("_k", n).where("argument_index = least(_k, 2)").drop("_k")).dropping("_call")

    def array(self) -> Steps:
        return self.argument(1)

    def offset(self) -> Steps:
        return self.argument(2)

    def subscript(self) -> Steps:
        return self.offset().reached(["AST"], label="IDENTIFIER", with_self=True)

    def uses_constant_offset(self) -> Steps:
        """An identifier in the offset, or exactly one literal: as its users know it, whatever its name says."""
        t = self.keeping("_acc").argument(2).reached(["AST"], with_self=True)
        hit = t.df.groupBy("_acc").agg(F.count_if(F.col("label") == "IDENTIFIER").alias("i"), F.count_if(F.col("label") == "LITERAL").alias("l")).where("i > 0 OR l = 1").select("_acc.graph_id", "_acc.id")
        return self._with(self.df.join(hit, KEY, "left_semi"))

    def simple_name(self) -> DataFrame:
        return self.argument(1).label("IDENTIFIER").df.select(*KEY, "name")

    def field_identifier(self) -> Steps:
        return self.argument(2).label("FIELD_IDENTIFIER")

    def field_member(self) -> Steps:
        return self.out("REF", label="MEMBER")

    def pointer(self) -> Steps:
        return self.where("name = '<operator>.indirection'").argument(1)

    # Tags.

    def tag_list(self) -> DataFrame:
        t = self.keeping("_n").out("TAGGED_BY", label="TAG")
        return t.df.groupBy(F.col("_n.graph_id").alias("graph_id"), F.col("_n.id").alias("id")).agg(F.array_sort(F.collect_set(F.struct("name", "value"))).alias("tags"))

    def new_tag(self, name: str, value: str = "") -> Graph:
        """The graph in which every element carries one more tag."""
        keys = self.df.select(*KEY).distinct()
        tag_id = -F.abs(F.xxhash64("graph_id", "id", F.lit(name), F.lit(value)))  # below zero, so apart from given ids
        nodes = keys.select("graph_id", tag_id.alias("id"), F.lit("TAG").alias("label"), F.lit(name).alias("name"), F.lit(value).alias("value"))
        edges = keys.select("graph_id", F.col("id").alias("src"), tag_id.alias("dst"), F.lit("TAGGED_BY").alias("etype"))
        return self.graph.with_nodes(nodes).with_edges(edges)

    def file(self) -> Steps:
        """The file of a node: over SOURCE_FILE, of itself or the nearest ancestor that has one."""
        own = self.out("SOURCE_FILE", label="FILE")
        above = self.where_not_step(lambda t: t.out("SOURCE_FILE", label="FILE")).keeping("_f").reached(["AST", "CONTAINS"], reverse=True).out("SOURCE_FILE", label="FILE").dedup()
        return own.union(above.dropping("_f"))


def _any_match(column: str, regexes) -> Column:
    out = F.lit(False)
    for r in regexes:
        out = out | full(column, r)
    return out


def _chain(hops):
    def step(self: Steps) -> Steps:
        t = self
        for direction, types, label in hops:
            t = (t.out if direction == "out" else t.in_)(*types.split(), label=label)
        return t

    return step


for _name, _hops in HOPS.items():
    if not hasattr(Steps, _name):
        setattr(Steps, _name, _chain(_hops))
for _name, (_type, _back) in CLOSURES.items():
    setattr(Steps, _name, lambda self, t=_type, b=_back: self.reached([t], reverse=b))
for _name, _label in NARROW.items():
    setattr(Steps, _name, lambda self, x=_label: self.label(x))
for _name, _cond in WHERE.items():
    setattr(Steps, _name, lambda self, c=_cond: self.where(c))
for _name, _mod in MODIFIERS.items():
    setattr(Steps, _name, lambda self, m=_mod: self.where_step(lambda t: t.out("AST", label="MODIFIER").exact("modifier_type", m)))
for _name, _type in CONTROL.items():
    setattr(Steps, f"contained_{_name}", lambda self, t=_type: self.control_structures().where(F.col("control_structure_type") == t))
for _name, _set in OPERATORS.items():
    setattr(Steps, f"{_name}s", lambda self, s=_set: self.reached(["AST"], label="CALL", with_self=True).where(F.col("name").isin(s)))
    setattr(Steps, f"in_{_name}", lambda self, s=_set: self.in_ast().label("CALL").where(F.col("name").isin(s)))
for _prop in ("name", "code", "full_name", "signature", "type_full_name", "filename", "method_full_name", "control_structure_type", "dispatch_type", "modifier_type", "canonical_name", "evaluation_strategy"):
    setattr(Steps, f"{_prop}_is", lambda self, r, p=_prop: self.matching(p, r))
    setattr(Steps, f"{_prop}_exact", lambda self, *v, p=_prop: self.exact(p, *v))
    setattr(Steps, f"{_prop}_not", lambda self, r, p=_prop: self.not_matching(p, r))
for _prop in ("line_number", "line_number_end", "column_number", "order", "index", "argument_index"):
    setattr(Steps, f"{_prop}_eq", lambda self, n, p=_prop: self.where(F.col(p) == n))
    setattr(Steps, f"{_prop}_from", lambda self, n, p=_prop: self.where(F.col(p) >= n))
    setattr(Steps, f"{_prop}_to", lambda self, n, p=_prop: self.where(F.col(p) <= n))
for _step in ("annotations", "type_methods", "type_members", "base_type", "is_internal", "is_external"):
    setattr(Steps, f"decl_{_step}", lambda self, s=_step: self._of_type_decl(s))
