import base64
import random

import pytest
from pyspark.sql import functions as F

from codequarry.graph import access_path as ap
from codequarry.graph import dataflow, scanners, special
from codequarry.graph.model import Graph
from codequarry.graph.steps import Cpg
from codequarry.plans import step_queries
from tests.test_graph import Build, ids


def test_paths():
    c = lambda n: ("const", n)
    assert ap.normal([("addr",), ("deref",), c("a"), ("shift", 2), ("shift", -2)]) == [c("a")]
    assert ap.normal([("shift", 1), ("vshift",), ("shift", 3)]) == [("vshift",)]
    assert ap.compare([c("a")], [], [c("a")]) == (ap.EXACT, [])
    assert ap.compare([c("a"), c("b")], [], [c("a")]) == (ap.PREFIX, [c("b")])
    assert ap.compare([c("a")], [], [c("a"), c("b")]) == (ap.EXTENDED, [c("b")])
    assert ap.compare([c("a")], [[c("b")]], [c("a"), c("b"), c("d")]) == (ap.NO_MATCH, [])
    assert ap.compare([("var",)], [], [c("a")]) == (ap.VARIABLE_EXACT, []) and ap.compare([("vshift",)], [], [("shift", 2), c("x")])[0] == ap.VARIABLE_EXTENDED
    assert ap.compare([c("a")], [], [c("b")]) == (ap.NO_MATCH, [])
    assert ap.inverted([("addr",), ("shift", 2)]) == [("shift", -2), ("deref",)] and ap.inverted([c("a")]) is None
    assert ap.exclude([[c("a"), c("b")]], [c("a")]) == [[c("a")]] and ap.exclude([[c("a")]], [c("a"), c("b")]) == [[c("a")]] and ap.exclude([], [("var",)]) == []


def test_paths_undo():
    rng = random.Random(1)
    pool = [("addr",), ("deref",), ("shift", 1), ("shift", -3), ("shift", 2)]
    for _ in range(300):
        p = ap.normal([rng.choice(pool) for _ in range(rng.randrange(8))])
        assert ap.join(p, ap.inverted(p)) == [] and ap.normal(p) == p


def test_special_steps(spark):
    xml = '<manifest xmlns:android="a"><uses-permission android:name="android.permission.READ_EXTERNAL_STORAGE"/><application android:usesCleartextTraffic="true"><activity android:name=".A" android:exported="true"/><activity android:name=".B"/></application></manifest>'
    tag = base64.b64encode(b"method:a.f").decode()
    nodes = [
        (1, 1, "METHOD", "<module>", "m", None, None, None, None), (1, 2, "MODIFIER", None, None, "MODULE", None, None, None), (1, 3, "BLOCK", None, None, None, None, None, None), (1, 4, "LOCAL", "v", None, None, "android.webkit.WebView", None, None),
        (1, 5, "IDENTIFIER", "v", None, None, None, 1, None), (1, 6, "CALL", "<operator>.assignment", None, None, None, None, None), (1, 7, "IDENTIFIER", "v", None, None, None, 0, None), (1, 8, "CALL", "loadUrl", None, None, None, None, None),
        (1, 9, "TYPE_DECL", "m", "m", None, None, None, None), (1, 10, "MEMBER", "v", None, None, None, None, None), (1, 11, "CONFIG_FILE", "x/AndroidManifest.xml", None, None, None, None, xml), (1, 12, "TAG", "resolved_import", None, None, None, None, None), (1, 13, "METHOD", "f", "a.f", None, None, None, None),
    ]
    edges = [(1, 1, 2, "AST"), (1, 1, 3, "AST"), (1, 3, 4, "AST"), (1, 5, 4, "REF"), (1, 7, 4, "REF"), (1, 6, 5, "ARGUMENT"), (1, 8, 7, "ARGUMENT"), (1, 9, 10, "AST"), (1, 8, 12, "TAGGED_BY")]
    df = spark.createDataFrame(nodes, "graph_id long, id long, label string, name string, full_name string, modifier_type string, type_full_name string, argument_index int, content string")
    df = df.withColumn("value", F.when(F.col("label") == "TAG", F.lit(tag)))
    cpg = Cpg(Graph.of(df, spark.createDataFrame(edges, "graph_id long, src long, dst long, etype string")))
    v = special.module_variables(cpg)
    assert ids(v) == [4] and ids(special.references(v)) == [5, 7] and ids(special.definitions(v)) == [6] and ids(special.invoking_calls(v)) == [8] and ids(special.referencing_members(v)) == [10]
    assert ids(special.calls_on(special.web_views(cpg), "loadUrl")) == [8] and ids(special.resolved_entities(cpg.call("loadUrl"))) == [13]
    m = special.app_manifest(cpg)
    assert ids(special.uses_cleartext_traffic(m)) == [11] and ids(special.reads_external_storage(m)) == [11]
    assert special.reaches_default_category(m).collect() == [] and special.exported_receivers(m).collect() == []
    assert special.broadcast_receivers(cpg).is_empty() and special.exposed_to_script(cpg).is_empty()


def test_long_chains_are_not_cut(spark):
    b = Build()
    calls = [b.node("CALL", name="<operator>.fieldAccess", code="a.b") for _ in range(23)]
    top, block = b.node("CALL", name="f", code="f()"), b.node("BLOCK")
    b.edge("AST", block, top, *calls)
    cpg = Cpg(b.graph(spark))
    assert ids(cpg.all().where(F.col("id") == calls[-1]).parent_expression()) == [top]
    b = Build()
    sums = [b.node("CALL", name="<operator>.addition", code=str(i)) for i in range(63)]
    block = b.node("BLOCK")
    b.edge("AST", block, *sums)
    assert ids(Cpg(b.graph(spark)).all().where(F.col("id") == sums[-1]).statement()) == [sums[0]]


def test_closure_is_not_cut(spark):
    b = Build()
    chain = [b.node("BLOCK") for _ in range(204)]
    b.edge("AST", *chain)
    b.edge("AST", chain[3], chain[1])  # a cycle ends
    g = b.graph(spark)
    got = {r["to"]: r["depth"] for r in g.closure(["AST"], g.nodes.where(F.col("id") == chain[0])).collect()}
    assert got == {x: i for i, x in enumerate(chain) if i}
    assert g.closure(["AST"], g.nodes.where(F.col("id") == chain[0]), most=5).count() == 5


def test_flows_are_not_cut(spark):
    b = Build()
    chain = [b.node("IDENTIFIER", name=f"x{i}") for i in range(63)]
    b.edge("REACHING_DEF", *chain)
    cpg = Cpg(b.graph(spark))
    at = lambda i: cpg.all().where(F.col("id") == chain[i])
    got = dataflow.reachable_by(at(-1), at(0)).collect()
    assert [r["path"] for r in got] == [chain]


MANIFEST = """<manifest xmlns:android="http://schemas.android.com/apk/res/android"><uses-permission android:name="android.permission.READ_EXTERNAL_STORAGE"/>
<application android:usesCleartextTraffic="true"><activity android:name="Main"><intent-filter><category android:name="android.intent.category.DEFAULT"/></intent-filter></activity>
<activity android:name="Other" android:exported="true"/><receiver android:name=".Rec" android:exported="%s"><intent-filter/></receiver></application></manifest>"""


def app(spark, exported="true", guarded=False, sdk=18, root="/system/xbin/su", first="RETURN"):
    """A program that holds what the scanners of applications look for."""
    nodes, edges = [], []

    def node(label, under=None, **kw):
        nodes.append(dict(graph_id=1, id=len(nodes), label=label, **kw))
        if under is not None:
            edges.append((1, under, len(nodes) - 1, "AST"))
        return len(nodes) - 1

    def edge(src, dst, kind):
        edges.append((1, src, dst, kind))

    def call(m, name, full="", code="", typ="", args=()):
        c = node("CALL", m, name=name, method_full_name=full, code=code, type_full_name=typ)
        edge(m, c, "CONTAINS")
        for i, (label, kw) in args:
            a = node(label, c, argument_index=i, **kw)
            edge(c, a, "ARGUMENT")
            edge(m, a, "CONTAINS")
        return c

    def argument(c, i):
        return next(d for _, s, d, k in edges if k == "ARGUMENT" and s == c and nodes[d]["argument_index"] == i)

    ident = lambda name, typ="": ("IDENTIFIER", dict(name=name, code=name, type_full_name=typ))
    node("CONFIG_FILE", name="app/AndroidManifest.xml", content=MANIFEST % exported)
    node("CONFIG_FILE", name="app/build.gradle", content=f"android {{\n  minSdk 1\n  targetSdk {sdk}\n}}")
    main = node("TYPE_DECL", name="Main", full_name="a.Main")
    m = node("METHOD", main, name="onCreate", full_name="a.Main.onCreate")
    intent = call(m, "getIntent", typ="android.content.Intent")
    run = call(m, "exec", typ="java.lang.Process", args=[(1, ident("cmd"))])
    edge(intent, argument(run, 1), "REACHING_DEF")
    rec = node("TYPE_DECL", name="Rec", full_name="a.Rec")
    on = node("METHOD", rec, name="onReceive", full_name="a.Rec.onReceive")
    node("METHOD_PARAMETER_IN", on, index=1, name="c", type_full_name="android.content.Context")
    data = node("METHOD_PARAMETER_IN", on, index=2, name="i", type_full_name="android.content.Intent")
    call(m, "registerReceiver", args=[(1, ident("r", "a.Rec")), (2, ident("f", "android.content.IntentFilter"))])
    write = call(on, "write", args=[(0, ident("o", "java.io.FileOutputStream")), (1, ident("bytes"))])
    edge(data, argument(write, 1), "REACHING_DEF")
    storage = call(m, "getExternalStorageDirectory", args=[(0, ident("E", "android.os.Environment"))])
    loader = node("LOCAL", m, name="l", type_full_name="dalvik.system.DexClassLoader")
    made = call(m, "<init>", args=[(0, ident("l", "dalvik.system.DexClassLoader")), (1, ident("path"))])
    edge(storage, argument(made, 1), "REACHING_DEF")
    load = call(m, "loadClass", args=[(0, ident("l"))])
    edge(argument(load, 0), loader, "REF")
    invoke = call(m, "invoke", "java.lang.reflect.Method.invoke:java.lang.Object(java.lang.Object,java.lang.Object[])", args=[(1, ident("k"))])
    edge(load, argument(invoke, 1), "REACHING_DEF")
    view = node("LOCAL", m, name="w", type_full_name="android.webkit.WebView")
    script = call(m, "setJavaScriptEnabled", args=[(1, ("LITERAL", dict(code="true")))])
    settings = call(m, "getSettings", args=[(0, ident("w"))])
    edge(script, settings, "ARGUMENT")
    nodes[settings]["argument_index"] = 0
    edge(argument(settings, 0), view, "REF")
    url = call(m, "loadUrl", args=[(0, ident("w")), (1, ("LITERAL", dict(code='"http://x"')))])
    edge(argument(url, 0), view, "REF")
    add = call(m, "addJavascriptInterface", args=[(0, ident("w")), (1, ident("b", "a.Bridge"))])
    edge(argument(add, 0), view, "REF")
    bridge = node("TYPE_DECL", name="Bridge", full_name="a.Bridge")
    open_ = node("METHOD", bridge, name="debug", full_name="a.Bridge.debug")
    node("ANNOTATION", open_, full_name="android.webkit.JavascriptInterface")
    cmd = node("METHOD_PARAMETER_IN", open_, index=1, name="cmd")
    shell = call(open_, "exec", typ="java.lang.Process", args=[(1, ident("cmd"))])
    edge(cmd, argument(shell, 1), "REACHING_DEF")
    extra, start = node("METHOD", name="getParcelableExtra", full_name="b.e"), node("METHOD", name="startActivity", full_name="b.s")
    get, go = call(m, "getParcelableExtra", code="getIntent().getParcelableExtra()"), call(m, "startActivity", args=[(1, ident("x"))])
    edge(get, extra, "CALL"), edge(go, start, "CALL"), edge(get, argument(go, 1), "REACHING_DEF")
    if guarded:
        edge(node("CALL", node("CONTROL_STRUCTURE", m, control_structure_type="IF"), name="<operator>.equals"), go, "CDG")
    check = node("METHOD", main, name="isRooted", full_name="a.Main.isRooted")
    exists = call(check, "exists", "java.io.File.exists:boolean()", args=[(0, ident("f"))])
    su = node("LITERAL", check, code=f'"{root}"')
    edge(su, argument(exists, 0), "REACHING_DEF")
    edge(call(m, "isRooted"), check, "CALL")
    node("METHOD", name="<init>", full_name="java.net.URL.<init>:void(java.lang.String)")
    for code in ('"http://a"', '"https://a"', '"ftp://a"'):
        edge(call(m, "<init>", args=[(1, ("LITERAL", dict(code=code)))]), [n["id"] for n in nodes if n.get("full_name", "").startswith("java.net")][0], "CALL")
    verify = node("METHOD", main, name="verify", full_name="a.v", signature="boolean(java.lang.String,javax.net.ssl.SSLSession)")
    local = node("LOCAL", verify, name="c")
    copy = call(verify, "<operator>.assignment", "<operator>.assignment", args=[(1, ident("c")), (2, ident("p"))])
    for i in (1, 2):
        edge(argument(copy, i), local, "REF")
    end = node(first, verify, code="1" if first == "LITERAL" else "return true")
    edge(verify, argument(copy, 1), "CFG"), edge(argument(copy, 1), argument(copy, 2), "CFG"), edge(argument(copy, 2), copy, "CFG"), edge(copy, end, "CFG")
    schema = "graph_id long, id long, label string, name string, full_name string, code string, type_full_name string, method_full_name string, signature string, content string, control_structure_type string, argument_index int, index int"
    cols = [c.split()[0] for c in schema.split(", ")]
    g = Graph.of(spark.createDataFrame([tuple(n.get(c) for c in cols) for n in nodes], schema), spark.createDataFrame(edges, "graph_id long, src long, dst long, etype string"))
    return g, dict(exec=run, write=write, invoke=invoke, shell=shell, get=get, rooted=check, end=end, nodes=nodes)


def test_application_scanners(spark):
    g, x = app(spark)
    run = lambda g, s: ids(scanners.REGISTRY[s].run(Cpg(g)))
    assert run(g, "intent-to-runtime-exec") == [x["exec"]] and run(g, "broadcast-to-file-write") == [x["write"]]
    assert run(g, "external-storage-to-dex-classloader") == [x["invoke"]] and run(g, "insecure-load-url-to-exec") == [x["shell"]]
    assert run(g, "intent-redirection") == [x["get"]] and run(g, "root-detection-via-file-checks") == [x["rooted"]]
    assert len(run(g, "fragment-injection")) == 1 and run(g, "ineffective-certificate-check") == [x["end"]]
    assert [x["nodes"][i]["name"] for i in run(g, "usage-of-insecure-protocol")] == ["<init>"]


def test_applications_without_findings(spark):
    g, x = app(spark, exported="false", guarded=True, sdk=19, root="/system/bin/ls", first="CALL")
    for s in ("broadcast-to-file-write", "intent-redirection", "root-detection-via-file-checks", "fragment-injection", "ineffective-certificate-check"):
        assert ids(scanners.REGISTRY[s].run(Cpg(g))) == [], s
    assert ids(scanners.REGISTRY["ineffective-certificate-check"].run(Cpg(app(spark, first="LITERAL")[0]))) != []


@pytest.mark.parametrize("name", ["steps_trees", "steps_operators"])
def test_steps_are_planned_one_at_a_time(spark, name):
    """What the query returns reads counts that are written; no step's joins are left in its plan."""
    plan = step_queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_ancestors_by_label_are_written_once(spark):
    g = Graph.of(
        spark.createDataFrame([(1, 1, "METHOD"), (1, 2, "BLOCK"), (1, 3, "CALL"), (2, 1, "METHOD"), (2, 2, "METHOD")], "graph_id long, id long, label string"),
        spark.createDataFrame([(1, 1, 2, "AST"), (1, 2, 3, "AST"), (2, 1, 2, "AST")], "graph_id long, src long, dst long, etype string"),
    )
    up = g.above_label("METHOD")
    assert up is g.above_label("METHOD")
    assert sorted(map(tuple, up.collect())) == [(1, 2, 1, 1), (1, 3, 1, 2), (2, 2, 1, 1)]
    assert sorted(map(tuple, g.above_label("BLOCK").collect())) == [(1, 3, 2, 1)]


def test_graph_tables_are_not_broadcast(spark):
    """Whatever their files' size, pairs, ancestors and the generated graphs are joined by shuffles."""
    g = step_queries.built(spark, "/root/testdata/sf0.001")
    for t in (g.nodes, g.edges, g.pairs(["AST"]), g.above_label("METHOD")):
        plan = spark.createDataFrame([(1,)], "graph_id long").join(t, "graph_id")._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
