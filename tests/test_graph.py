import random

import pytest
from pyspark.sql import functions as F

from codequarry.graph import dataflow, exports, kernels, passes, scanners
from codequarry.graph.model import Graph
from codequarry.graph.steps import Cpg

EDGES = [(0, 1), (1, 2), (2, 3), (2, 5), (3, 4), (4, 2), (4, 5), (5, 6)]


def succ(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
    return out


def test_dominators_known():
    s = succ(EDGES)
    idom = kernels.immediate_dominators(s, 0)
    assert idom == {1: 0, 2: 1, 3: 2, 5: 2, 4: 3, 6: 5}
    assert kernels.frontiers(s, idom) == {2: {2}, 3: {2, 5}, 4: {2, 5}}


@pytest.mark.parametrize("seed", range(20))
def test_dominators_and_definitions_brute(seed):
    rng = random.Random(seed)
    n = rng.randrange(4, 12)
    edges = [(rng.randrange(n), rng.randrange(1, n)) for _ in range(2 * n)] + [(0, 1)]
    s = succ(sorted(set(edges)))

    def reach(without=None):
        seen, todo = set(), [0] if without != 0 else []
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += [y for y in s.get(x, []) if y != without]
        return seen

    all_ = reach()
    dom = {v: {d for d in all_ if d == v or v not in reach(d)} for v in all_}
    want = {v: max(dom[v] - {v}, key=lambda d: len(dom[d])) for v in all_ if v}
    assert kernels.immediate_dominators(s, 0) == want
    nodes = list(range(n))
    var = {i: rng.choice("xy") for i in nodes if rng.random() < 0.6}
    gen = {i: {i} for i in var}
    kill = {i: {j for j in var if var[j] == var[i]} for i in var}
    got = kernels.reaching(s, nodes, gen, kill)
    for d in var:  # a definition reaches what a walk without another definition of its variable reaches
        seen, todo = set(), list(s.get(d, []))
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                if var.get(x) != var[d]:
                    todo += s.get(x, [])
        assert {x for x in nodes if d in got[x]} == seen


class Build:
    """A small graph: rows of nodes and edges by hand."""

    def __init__(self):
        self.nodes, self.edges, self.next = [], [], 1

    def node(self, label, **kw):
        self.nodes.append({"graph_id": 1, "id": self.next, "label": label, **kw})
        self.next += 1
        return self.next - 1

    def edge(self, etype, *ids):
        self.edges += [(1, a, b, etype) for a, b in zip(ids, ids[1:])]

    def under(self, parent, *ids, etype="AST"):
        self.edges += [(1, parent, i, etype) for i in ids]

    def graph(self, spark):
        cols = {"graph_id": "long", "id": "long", "label": "string", "name": "string", "full_name": "string", "code": "string", "order": "int", "argument_index": "int", "index": "int", "is_external": "boolean",
                "type_full_name": "string", "control_structure_type": "string", "method_full_name": "string", "modifier_type": "string", "line_number": "int", "line_number_end": "int", "dispatch_type": "string", "signature": "string", "inherits_from": "array<string>"}
        rows = [tuple(n.get(c) for c in cols) for n in self.nodes]
        return Graph.of(spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols.items())), spark.createDataFrame(self.edges, "graph_id long, src long, dst long, etype string"))


def ids(t):
    return sorted(r["id"] for r in t.df.select("id").collect())


def program(b):
    """f(p) { x = gets(); if (p) { y = x; strcpy(z, y); } return y; }  gets and strcpy are external."""
    n = {}
    n["gets"], n["strcpy"] = b.node("METHOD", name="gets", full_name="gets", is_external=True), b.node("METHOD", name="strcpy", full_name="strcpy", is_external=True)
    n["sp2"] = b.node("METHOD_PARAMETER_IN", name="p2", index=2, order=2)
    b.under(n["strcpy"], n["sp2"])
    n["f"] = b.node("METHOD", name="f", full_name="f", is_external=False, line_number=1, line_number_end=9)
    n["p"] = b.node("METHOD_PARAMETER_IN", name="p", index=1, order=1)
    n["body"] = b.node("BLOCK")
    n["a1"], n["x1"], n["g"] = b.node("CALL", name="<operator>.assignment", code="x = gets()"), b.node("IDENTIFIER", name="x", code="x", order=1, argument_index=1), b.node("CALL", name="gets", code="gets()", method_full_name="gets", order=2, argument_index=2)
    n["if"], n["pc"] = b.node("CONTROL_STRUCTURE", control_structure_type="IF", code="if (p)"), b.node("IDENTIFIER", name="p", code="p", order=1, argument_index=1)
    n["blk"] = b.node("BLOCK", order=2)
    n["a2"], n["y2"], n["x2"] = b.node("CALL", name="<operator>.assignment", code="y = x"), b.node("IDENTIFIER", name="y", code="y", order=1, argument_index=1), b.node("IDENTIFIER", name="x", code="x", order=2, argument_index=2)
    n["c"], n["z"], n["y3"] = b.node("CALL", name="strcpy", code="strcpy(z, y)", method_full_name="strcpy"), b.node("IDENTIFIER", name="z", code="z", order=1, argument_index=1), b.node("IDENTIFIER", name="y", code="y", order=2, argument_index=2)
    n["r"], n["y4"] = b.node("RETURN", code="return y;"), b.node("IDENTIFIER", name="y", code="y", order=1, argument_index=1)
    n["mr"] = b.node("METHOD_RETURN")
    b.under(n["f"], n["p"], n["body"], n["mr"])
    b.under(n["body"], n["a1"], n["if"], n["r"])
    b.under(n["a1"], n["x1"], n["g"])
    b.under(n["if"], n["pc"], n["blk"])
    b.under(n["blk"], n["a2"], n["c"])
    b.under(n["a2"], n["y2"], n["x2"])
    b.under(n["c"], n["z"], n["y3"])
    b.under(n["r"], n["y4"])
    for call in ("a1", "a2", "c", "r"):
        kids = {"a1": ["x1", "g"], "a2": ["y2", "x2"], "c": ["z", "y3"], "r": ["y4"]}[call]
        b.under(n[call], *[n[k] for k in kids], etype="ARGUMENT")
    b.under(n["if"], n["pc"], etype="CONDITION")
    b.edge("CFG", n["f"], n["g"], n["a1"], n["pc"], n["a2"], n["c"], n["r"], n["mr"])
    b.edge("CFG", n["pc"], n["r"])
    return n


@pytest.fixture(scope="module")
def built(spark):
    b = Build()
    n = program(b)
    g = b.graph(spark)
    g = Graph(g.nodes.cache(), g.edges)
    g = g.with_edges(passes.contains(g))
    g = g.with_edges(passes.static_calls(g))
    return Graph(g.nodes, g.edges.cache()), n


def test_steps(spark, built):
    g, n = built
    cpg = Cpg(g)
    assert ids(cpg.method("f").callee()) == sorted([n["gets"], n["strcpy"]])
    assert ids(cpg.method("strcpy").caller()) == [n["f"]]
    assert ids(cpg.method("gets").call_in().in_assignment().target()) == [n["x1"]]
    assert ids(cpg.identifier("y").in_call().is_call_to("strcpy")) == [n["c"]]
    assert ids(cpg.call("strcpy").argument(2).to_parameter()) == [n["sp2"]]
    assert ids(cpg.if_block().when_true()) == [n["blk"]]
    assert ids(cpg.if_block().condition()) == [n["pc"]]
    assert ids(cpg.identifier("z").in_ast_minus_leaf()) == sorted([n["c"], n["blk"], n["if"], n["body"], n["f"]])
    assert ids(cpg.identifier("z").parent_block()) == [n["blk"]]
    assert ids(cpg.identifier("z").statement()) == [n["c"]]
    assert ids(cpg.method("f").contains_call_to("strcpy")) == [n["f"]] and not ids(cpg.method("f").contains_call_to("strc"))
    assert ids(cpg.method().is_stub()) == sorted([n["gets"], n["strcpy"]])
    assert ids(cpg.method("f").walk_ast_until_reaching(["CONTROL_STRUCTURE"])) == sorted(set(range(n["p"], n["mr"] + 1)) - {n["pc"], n["blk"], n["a2"], n["y2"], n["x2"], n["c"], n["z"], n["y3"]})
    assert ids(cpg.method("strcpy").called_by(cpg.method("f"))) == [n["f"]]
    assert ids(cpg.assignment().source()) == sorted([n["g"], n["x2"]])
    two = cpg.identifier("y").union(cpg.identifier("y"))
    assert len(ids(two)) == 6 and len(ids(two.dedup())) == 3 and ids(two.dedup().dedup()) == ids(two.dedup())
    keep, drop = cpg.call().where_step(lambda t: t.argument(1)), cpg.call().where_not_step(lambda t: t.argument(1))
    assert sorted(ids(keep) + ids(drop)) == ids(cpg.call())
    tagged = Cpg(cpg.call("strcpy").new_tag("hot", "1"))
    assert ids(tagged.tag("hot").tagged_call()) == [n["c"]]


def test_control_dependence(spark, built):
    g, n = built
    got = {(r["src"], r["dst"]) for r in passes.control_dependence(g).collect()}
    assert got == {(n["pc"], n["a2"]), (n["pc"], n["c"])}
    full = g.with_edges(passes.post_dominators(g), passes.control_dependence(g))
    assert ids(Cpg(full).call("strcpy").controlled_by()) == [n["pc"]]
    assert n["r"] in ids(Cpg(full).call("gets").post_dominated_by())


def test_data_flow(spark, built):
    g, n = built
    # strcpy has no default: without a line of its own any of its arguments would flow to any
    sem = dataflow.semantics_table(spark, dataflow.DEFAULT_SEMANTICS + '"strcpy" 2->1 2->-1')
    ddg = dataflow.reaching_definitions(g, sem)
    got = {(r["src"], r["dst"]) for r in ddg.collect()}
    assert (n["x1"], n["x2"]) in got and (n["y2"], n["y3"]) in got and (n["y2"], n["y4"]) in got and (n["p"], n["pc"]) not in got  # a condition is no argument here
    full = g.with_edges(ddg)
    cpg = Cpg(full)
    flows = dataflow.reachable_by(cpg.call("strcpy").argument(2), cpg.call("gets"), semantics=sem).collect()
    assert [r["path"] for r in flows] == [[n["g"], n["x1"], n["x2"], n["y2"], n["y3"]]]
    into = dataflow.reachable_by(cpg.call("strcpy").argument(1), cpg.call("gets"), semantics=sem).collect()
    assert [r["path"][-2:] for r in into] == [[n["y3"], n["z"]]]  # the copy's target takes the value
    assert not dataflow.reachable_by(cpg.call("gets"), cpg.call("strcpy").argument(2), semantics=sem).collect()
    nodes, edges = dataflow.backward_slice(cpg.call("strcpy").argument(2))
    assert {n["y2"], n["y3"]} <= {r["id"] for r in nodes.collect()} and edges.count() >= 1


def test_semantics_grammar():
    assert dataflow.parse_semantics('"foo" 1->-1 2->3\n# rest\n/a.*/ PASSTHROUGH\n"bar"') == [
        ("foo", 1, -1, False, False), ("foo", 2, 3, False, False), ("a.*", None, None, True, True), ("bar", None, None, False, False),
    ]


def test_scanners(spark, built):
    g, n = built
    run = lambda s: ids(scanners.REGISTRY[s].run(Cpg(g)))
    assert len(scanners.REGISTRY) == 48
    assert run("call-to-gets") == [n["g"]] and run("call-to-strcpy") == [n["c"]] and run("call-to-scanf") == []
    assert run("too-many-params") == [] and run("file-operation-race") == []
    assert {s.name for s in scanners.selected(tags=["badfn"])} >= {"call-to-gets", "call-to-strcat"}
    found = scanners.findings(g, scanners.selected(names=["call-to-gets", "too-nested"])).collect()
    assert [(r["scan"], r["id"]) for r in found] == [("call-to-gets", n["g"])]


@pytest.mark.parametrize("name", sorted(scanners.REGISTRY))
def test_every_scanner_runs(spark, built, name):
    scanners.REGISTRY[name].run(Cpg(built[0])).df.select("id").collect()


def test_linkers(spark):
    b = Build()
    base, derived = b.node("TYPE_DECL", name="A", full_name="A"), b.node("TYPE_DECL", name="B", full_name="B", inherits_from=["A"])
    ta, tb = b.node("TYPE", name="A", full_name="A"), b.node("TYPE", name="B", full_name="B")
    ma, mb = b.node("METHOD", name="m", full_name="A.m", signature="()", is_external=False), b.node("METHOD", name="m", full_name="B.m", signature="()", is_external=False)
    b.under(base, ma)
    b.under(derived, mb)
    call = b.node("CALL", name="m", method_full_name="A.m", dispatch_type="DYNAMIC_DISPATCH")
    other = b.node("CALL", name="gone", method_full_name="x.gone")
    arg = b.node("IDENTIFIER", name="q", argument_index=1)
    b.under(other, arg, etype="ARGUMENT")
    g = b.graph(spark)
    g = g.with_edges(passes.type_refs(g), passes.type_hierarchy(g))
    assert ids(Cpg(g).type_decl("B").base_type()) == [ta] and ids(Cpg(g).type_decl("A").derived_type_decl()) == [derived]
    assert ids(Cpg(g).type_decl("A").derived_type_decl_transitive()) == [derived] and tb
    assert {(r["src"], r["dst"]) for r in passes.dynamic_calls(g).collect()} == {(call, ma), (call, mb)}
    stubbed = passes.method_stubs(g)
    assert [r["full_name"] for r in stubbed.nodes.where("label = 'METHOD' AND is_external").collect()] == ["x.gone"]
    assert stubbed.nodes.where("label = 'METHOD_PARAMETER_IN'").count() == 1
    assert passes.naive_calls(g).count() == 2


def test_exports(spark, built):
    g, n = built
    dot = exports.dot(g, "cfg").first()["dot"]
    assert f'"{n["f"]}" -> "{n["g"]}"' in dot and dot.endswith("}\n")
    back = Graph.from_records(exports.record_json(g).select(F.col("graph_id").alias("record_id"), "payload", F.lit("graph").alias("kind")))
    want = {(r["src"], r["dst"], r["etype"]) for r in g.edges.collect()}
    assert {(r["src"], r["dst"], r["etype"]) for r in back.edges.collect()} == want
    assert {(r["id"], r["label"]) for r in back.nodes.collect()} == {(r["id"], r["label"]) for r in g.nodes.collect()}
    nodes, edges = exports.split_by_method(g)
    assert edges.where("etype = 'CALL'").count() == 0 and nodes.where(f"id = {n['z']} AND method = {n['f']}").count() == 1
    assert exports.neo4j_csv(g)[0].count() == g.nodes.count()
