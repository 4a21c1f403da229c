"""Reaching definitions, data dependence, interprocedural taint and slices."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.graph import kernels
from codequarry.graph.model import KEY, Graph, Traversal, merged
from codequarry.graph.passes import _flow, _succ
from codequarry.session import Scratch

RETURN, RECEIVER = -1, 0


def parse_semantics(text: str) -> list[tuple[str, int, int, bool, bool]]:
    """(method, src, dst, passthrough, regex) of lines such as '"memcpy" 2->1 1->-1', where -1 is the return value and 0 the
    receiver; PASSTHROUGH lets every argument flow to itself and to the return value. A name between slashes is a regular
    expression; # begins a remark."""
    out = []
    for line in text.splitlines():
        m = re.match(r'\s*(?:"([^"]+)"|/([^/]+)/)\s*(.*?)\s*(?:#.*)?$', line)
        if not m:
            continue
        name, is_regex = (m.group(1), False) if m.group(1) else (m.group(2), True)
        rest = m.group(3)
        if "PASSTHROUGH" in rest:
            out.append((name, None, None, True, is_regex))
        found = re.findall(r"(-?\d+)\s*->\s*(-?\d+)", rest)
        out += [(name, int(a), int(b), False, is_regex) for a, b in found]
        if not found and "PASSTHROUGH" not in rest:
            out.append((name, None, None, False, is_regex))  # known to move nothing
    return out


def semantics_table(spark, text: str) -> DataFrame:
    return spark.createDataFrame(parse_semantics(text), "method string, src int, dst int, passthrough boolean, regex boolean")


# Flows between the arguments of operators and of common C and Java calls. A method that is not named moves any
# argument to any. ceil gives nothing back, as its users know it.
OPERATOR_SEMANTICS = """
"<operator>.addition" 1->-1 2->-1
"<operator>.addressOf" 1->-1
"<operator>.assignment" 2->1 2->-1
"<operator>.assignmentAnd" 2->1 1->1 2->-1
"<operator>.assignmentArithmeticShiftRight" 2->1 1->1 2->-1
"<operator>.assignmentDivision" 2->1 1->1 2->-1
"<operator>.assignmentExponentiation" 2->1 1->1 2->-1
"<operator>.assignmentLogicalShiftRight" 2->1 1->1 2->-1
"<operator>.assignmentMinus" 2->1 1->1 2->-1
"<operator>.assignmentModulo" 2->1 1->1 2->-1
"<operator>.assignmentMultiplication" 2->1 1->1 2->-1
"<operator>.assignmentOr" 2->1 1->1 2->-1
"<operator>.assignmentPlus" 2->1 1->1 2->-1
"<operator>.assignmentShiftLeft" 2->1 1->1 2->-1
"<operator>.assignmentXor" 2->1 1->1 2->-1
"<operator>.cast" 1->-1 2->-1
"<operator>.computedMemberAccess" 1->-1
"<operator>.conditional" 2->-1 3->-1
"<operator>.elvis" 1->-1 2->-1
"<operator>.notNullAssert" 1->-1
"<operator>.fieldAccess" 1->-1
"<operator>.getElementPtr" 1->-1
"<operator>.incBy" 1->1 2->1 3->1 4->1
"<operator>.indexAccess" 1->-1
"<operator>.indirectComputedMemberAccess" 1->-1
"<operator>.indirectFieldAccess" 1->-1
"<operator>.indirectIndexAccess" 1->-1 2->1
"<operator>.indirectMemberAccess" 1->-1
"<operator>.indirection" 1->-1
"<operator>.memberAccess" 1->-1
"<operator>.pointerShift" 1->-1
"<operator>.postDecrement" 1->1 1->-1
"<operator>.postIncrement" 1->1 1->-1
"<operator>.preDecrement" 1->1 1->-1
"<operator>.preIncrement" 1->1 1->-1
"<operator>.sizeOf"
"<operators>.assignmentExponentiation" 2->1 1->1
"<operators>.assignmentModulo" 2->1 1->1
"<operators>.assignmentShiftLeft" 2->1 1->1
"<operators>.assignmentLogicalShiftRight" 2->1 1->1
"<operators>.assignmentArithmeticShiftRight" 2->1 1->1
"<operators>.assignmentAnd" 2->1 1->1
"<operators>.assignmentOr" 2->1 1->1
"<operators>.assignmentXor" 2->1 1->1
"<operator>.tupleLiteral" PASSTHROUGH
"<operator>.dictLiteral" PASSTHROUGH
"<operator>.setLiteral" PASSTHROUGH
"<operator>.listLiteral" PASSTHROUGH
"""
C_SEMANTICS = """
"abs" 1->1 1->-1
"abort"
"asctime" 1->1 1->-1
"asctime_r" 1->1 1->-1
"atof" 1->1 1->-1
"atoi" 1->1 1->-1
"atol" 1->1 1->-1
"calloc" 1->-1 2->-1
"ceil" 1->1
"clock"
"ctime" 1->-1
"ctime64" 1->-1
"ctime_r" 1->-1
"ctime64_r" 1->-1
"difftime" 1->-1 2->-1
"difftime64" 1->-1 2->-1
"div" PASSTHROUGH
"exit" 1->1
"exp" 1->-1
"fabs" 1->-1
"fclose" 1->1 1->-1
"fdopen" 1->-1 2->-1
"feof" 1->1 1->-1
"ferror" 1->1 1->-1
"fflush" 1->1 1->-1
"fgetc" 1->1 1->-1
"fwrite" 1->1 1->-1 2->-1 3->-1 4->-1
"free" 1->1
"getc" 1->1
"scanf" 2->2
"strcmp" 1->1 1->-1 2->2 2->-1
"strlen" 1->1 1->-1
"strncpy" 1->1 2->2 3->3 1->-1 2->-1
"strncat" 1->1 1->-1 2->2 2->-1
"""
JAVA_SEMANTICS = """
"java.lang.String.split:java.lang.String[](java.lang.String)" PASSTHROUGH 0->0
"java.lang.String.split:java.lang.String[](java.lang.String,int)" PASSTHROUGH 0->0
"java.lang.String.compareTo:int(java.lang.String)" PASSTHROUGH 0->0
"java.io.PrintWriter.print:void(java.lang.String)" 0->0 1->1
"java.io.PrintWriter.println:void(java.lang.String)" 0->0 1->1
"java.io.PrintStream.println:void(java.lang.String)" 0->0 1->1
"java.io.PrintStream.print:void(java.lang.String)" PASSTHROUGH 0->0
"android.text.TextUtils.isEmpty:boolean(java.lang.String)" 0->-1 1->-1
"java.sql.PreparedStatement.prepareStatement:java.sql.PreparedStatement(java.lang.String)" 1->-1
"java.sql.PreparedStatement.prepareStatement:setDouble(int,double)" 1->1 2->2
"java.sql.PreparedStatement.prepareStatement:setFloat(int,float)" 1->1 2->2
"java.sql.PreparedStatement.prepareStatement:setInt(int,int)" 1->1 2->2
"java.sql.PreparedStatement.prepareStatement:setLong(int,long)" 1->1 2->2
"java.sql.PreparedStatement.prepareStatement:setShort(int,short)" 1->1 2->2
"java.sql.PreparedStatement.prepareStatement:setString(int,java.lang.String)" 1->1 2->2
"org.apache.http.HttpRequest.<init>:void(org.apache.http.RequestLine)" 1->1 1->0
"org.apache.http.HttpRequest.<init>:void(java.lang.String,java.lang.String)" 1->1 1->0 2->0
"org.apache.http.HttpRequest.<init>:void(java.lang.String,java.lang.String,org.apache.http.ProtocolVersion)" 1->1 1->0 2->2 2->0 3->3 3->0
"org.apache.http.HttpResponse.getStatusLine:org.apache.http.StatusLine()" 0->-1
"org.apache.http.HttpResponse.setStatusLine:void(org.apache.http.StatusLine)" 1->0 1->1 0->-1
"org.apache.http.HttpResponse.setReasonPhrase:void(java.lang.String)" 1->0 1->1 0->-1
"org.apache.http.HttpResponse.getEntity:org.apache.http.HttpEntity()" 0->-1
"org.apache.http.HttpResponse.setEntity:void(org.apache.http.HttpEntity)" 1->0 1->1
"""
DEFAULT_SEMANTICS = OPERATOR_SEMANTICS + C_SEMANTICS + JAVA_SEMANTICS


def _uses(graph: Graph) -> DataFrame:
    """(graph_id, at, arg, var, defines, idx): arguments of control-flow nodes with their variable. An identifier's variable
    is its name, another expression's its code. Field identifiers are none."""
    n = graph.nodes.select(F.col("graph_id").alias("ng"), F.col("id").alias("arg"), "label", "argument_index", F.when(F.col("label") == "IDENTIFIER", F.coalesce("name", "code")).otherwise(F.col("code")).alias("var"))
    e = graph.etype("ARGUMENT").select("graph_id", F.col("src").alias("at"), F.col("dst").alias("arg0"))
    return e.join(n, (F.col("graph_id") == F.col("ng")) & (F.col("arg0") == F.col("arg"))).where("label <> 'FIELD_IDENTIFIER' AND var IS NOT NULL").select("graph_id", "at", "arg", "label", "var", F.col("argument_index").alias("idx"))


def with_semantics(graph: Graph, uses: DataFrame, semantics: DataFrame | None) -> DataFrame:
    """uses with used and defined, and pairs (the call's flows between argument numbers, null where any may be): without a
    semantic for the call every argument is both; with one, what it says. The table of semantics is small by nature and
    broadcast."""
    if semantics is None:
        return uses.withColumn("used", F.lit(True)).withColumn("defined", F.lit(True)).withColumn("pairs", F.lit(None).cast("array<struct<src:int,dst:int>>")).withColumn("pass", F.lit(False))
    calls = graph.nodes.where("label = 'CALL'").select("graph_id", F.col("id").alias("at"), F.coalesce("method_full_name", "name").alias("method"))
    s = F.broadcast(semantics.withColumnRenamed("method", "_m"))
    hit = calls.join(s, F.when(F.col("regex"), F.rlike("method", F.concat(F.lit("^(?:"), F.col("_m"), F.lit(")$")))).otherwise(F.col("method") == F.col("_m")))
    per = hit.groupBy("graph_id", "at").agg(F.collect_set("src").alias("ins"), F.collect_set("dst").alias("outs"), F.bool_or("passthrough").alias("pass"), F.collect_set(F.struct("src", "dst")).alias("pairs"))
    j = uses.join(per, ["graph_id", "at"], "left")
    free = F.col("ins").isNull() | (F.col("pass") & (F.col("idx") != RECEIVER))
    known = lambda c: free | F.coalesce(F.array_contains(c, F.coalesce("idx", F.lit(-99))), F.lit(False))
    j = j.withColumn("used", known("ins")).withColumn("defined", known("outs"))
    return j.withColumn("pass", F.coalesce("pass", F.lit(False))).drop("ins", "outs")


def _allowed(src, dst):
    """Whether the call's semantics let argument src flow to dst (-1: to the call's value). PASSTHROUGH lets every argument but
    the receiver flow to itself and to the value."""
    through = F.col("pass") & (src != RECEIVER) & ((src == dst) | (dst == RETURN))
    return F.col("pairs").isNull() | F.coalesce(through, F.lit(False)) | F.coalesce(F.exists("pairs", lambda p: (p["src"] == src) & (p["dst"] == dst)), F.lit(False))


def arguments_used_and_defined(graph: Graph, semantics: DataFrame | None = None) -> DataFrame:
    """(graph_id, id, used, defined): whether its call uses and defines an argument."""
    return with_semantics(graph, _uses(graph), semantics).select("graph_id", F.col("arg").alias("id"), "used", "defined")


def same_call(graph: Graph) -> DataFrame:
    """(graph_id, a, b): different arguments of one call."""
    e = graph.etype("ARGUMENT").join(graph.nodes.where("label = 'CALL'").select("graph_id", F.col("id").alias("src")), ["graph_id", "src"], "left_semi")
    return e.select("graph_id", "src", F.col("dst").alias("a")).join(e.select("graph_id", "src", F.col("dst").alias("b")), ["graph_id", "src"]).where("a <> b").select("graph_id", "a", "b").distinct()


def defined_flows(graph: Graph, semantics: DataFrame | None = None) -> DataFrame:
    """(graph_id, a, b): arguments of one call of which the call lets the first flow into the second."""
    u = with_semantics(graph, _uses(graph), semantics)
    to = u.select("graph_id", "at", F.col("arg").alias("b"), F.col("idx").alias("j"))
    return u.select("graph_id", "at", F.col("arg").alias("a"), F.col("idx").alias("i"), "pairs", "pass").join(to, ["graph_id", "at"]).where(_allowed(F.col("i"), F.col("j"))).select("graph_id", "a", "b").distinct()


def result_pairs(found: DataFrame, graph: Graph) -> DataFrame:
    """(graph_id, source, sink, steps): the paths of reachable_by() as code and line of each node, repeats in a row once."""
    each = found.select("graph_id", "source", "sink", F.posexplode("path").alias("pos", "id"))
    n = graph.nodes.select("graph_id", "id", F.struct(F.coalesce("code", "name").alias("code"), F.col("line_number").alias("line")).alias("s"))
    rows = each.join(n, ["graph_id", "id"]).groupBy("graph_id", "source", "sink").agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("p"))
    return rows.select("graph_id", "source", "sink", F.transform(F.filter("p", lambda x, i: (i == 0) | ~x["s"].eqNullSafe(F.try_element_at("p", i)["s"])), lambda x: x["s"]).alias("steps"))


def reaching_definitions(graph: Graph, semantics: DataFrame | None = None, most_definitions: int | None = 4000) -> DataFrame:
    """REACHING_DEF edges (graph_id, src, dst, etype, variable): a definition to each use that it reaches.

    Definitions are a method's parameters at its entry and the identifiers among the arguments of calls; a later definition
    of the variable kills the earlier. Uses are arguments, also of returns and control structures. An argument defined by a
    method is the node the edge starts from, a parameter by its node. A method with more than most_definitions
    definitions gives no edges, as its users expect; over_definitions() names these methods, and None leaves none out.
    """
    rows = _facts(graph, semantics)
    return _reaching(rows, most_definitions)


def over_definitions(graph: Graph, semantics: DataFrame | None = None, most_definitions: int = 4000) -> DataFrame:
    """(graph_id, method, definitions) of the methods that reaching_definitions() leaves out for their number of definitions."""
    n = _facts(graph, semantics).where("kind = 'd'").groupBy("graph_id", "method").agg(F.count(F.lit(1)).alias("definitions"))
    return n.where(F.col("definitions") > most_definitions)


def _facts(graph: Graph, semantics: DataFrame | None) -> DataFrame:
    """(graph_id, method, src, dst, var, kind): flow edges (e), and definitions (d) and uses (u) as (place, node, variable)."""
    uses = with_semantics(graph, _uses(graph), semantics)
    defs = uses.where("defined AND label = 'IDENTIFIER'").select("graph_id", "at", F.col("arg").alias("node"), "var")
    calls = graph.nodes.where("label = 'CALL'").select("graph_id", F.col("id").alias("at"))
    defs = defs.join(calls, ["graph_id", "at"], "left_semi")
    params = graph.etype("AST").join(graph.nodes.where("label = 'METHOD_PARAMETER_IN'").select(F.col("graph_id").alias("pg"), F.col("id").alias("pid"), F.col("name").alias("var")), (F.col("graph_id") == F.col("pg")) & (F.col("dst") == F.col("pid")))
    params = params.select("graph_id", F.col("src").alias("at"), F.col("pid").alias("node"), "var")
    d = defs.unionByName(params).withColumn("kind", F.lit("d"))
    u = uses.where("used").select("graph_id", "at", F.col("arg").alias("node"), "var").withColumn("kind", F.lit("u"))
    flow = _flow(graph)
    ends = flow.select("graph_id", "method", F.col("src").alias("at")).unionByName(flow.select("graph_id", "method", F.col("dst").alias("at"))).distinct()
    facts = d.unionByName(u).join(ends, ["graph_id", "at"]).select("graph_id", "method", F.col("at").alias("src"), F.col("node").alias("dst"), "var", "kind")
    return flow.select("graph_id", "method", "src", "dst", F.lit(None).cast("string").alias("var"), F.lit("e").alias("kind")).unionByName(facts)


def _reaching(rows: DataFrame, most_definitions: int | None) -> DataFrame:
    def frame(g: int, out: list[tuple[int, int, str]]) -> pd.DataFrame:
        ids = pd.DataFrame({"graph_id": [g] * len(out), "src": [o[0] for o in out], "dst": [o[1] for o in out]}, dtype="int64")
        return ids.assign(variable=pd.Series([o[2] for o in out], dtype=object))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        g = int(pdf["graph_id"].iloc[0])
        succ, nodes = _succ(pdf[pdf["kind"] == "e"])
        dd = pdf[pdf["kind"] == "d"]
        if not nodes or (most_definitions is not None and len(dd) > most_definitions):
            return frame(g, [])
        var, at, by_var = {}, {}, {}
        for n, a, v in sorted(zip(dd["dst"].tolist(), dd["src"].tolist(), dd["var"].tolist())):
            var[n], at[n] = v, a
            by_var.setdefault(v, set()).add(n)
        gen, kill = {}, {}
        for n, a in at.items():
            gen.setdefault(a, set()).add(n)
            kill.setdefault(a, set()).update(by_var[var[n]])
        inn = kernels.reaching(succ, nodes, gen, kill)
        uu = pdf[pdf["kind"] == "u"]
        out = []
        for n, a, v in sorted(set(zip(uu["dst"].tolist(), uu["src"].tolist(), uu["var"].tolist()))):
            out += [(x, n, v) for x in sorted(inn.get(a, ())) if var[x] == v and x != n]
        return frame(g, out)

    return rows.groupBy("graph_id", "method").applyInPandas(run, "graph_id long, src long, dst long, variable string").withColumn("etype", F.lit("REACHING_DEF"))


def ddg_in(t: Traversal) -> Traversal:
    """Where the values of the start come from: REACHING_DEF against the edges, and, from an argument's definition, the
    other arguments of the same call that flow into it."""
    return t.in_("REACHING_DEF")


def flow_edges(graph: Graph, semantics: DataFrame | None = None) -> DataFrame:
    """(graph_id, src, dst, call, kind): one step of a value. flow: a reaching definition; within: a used argument to one
    that its call defines, or to the call itself; in: an argument to the parameter of a called method; out: a return's value
    or an output parameter back to the call or argument. call is the call site that is entered or left."""
    n = graph.nodes
    flow = graph.etype("REACHING_DEF").select("graph_id", "src", "dst", F.lit(None).cast("long").alias("call"), F.lit("flow").alias("kind"))
    uses = with_semantics(graph, _uses(graph), semantics)
    calls = n.where("label = 'CALL'").select("graph_id", F.col("id").alias("at"))
    a = uses.join(calls, ["graph_id", "at"], "left_semi")
    froms = a.where("used").select("graph_id", "at", F.col("arg").alias("src"), F.col("idx").alias("i"), "pairs", "pass")
    tos = a.where("defined AND label = 'IDENTIFIER'").select("graph_id", "at", F.col("arg").alias("dst"), F.col("idx").alias("j"))
    within = froms.join(tos, ["graph_id", "at"]).where((F.col("src") != F.col("dst")) & _allowed(F.col("i"), F.col("j")))
    up = froms.where(_allowed(F.col("i"), F.lit(RETURN))).select("graph_id", "src", F.col("at").alias("dst"))
    within = within.select("graph_id", "src", "dst").unionByName(up).select("graph_id", "src", "dst", F.lit(None).cast("long").alias("call"), F.lit("within").alias("kind"))
    link = graph.etype("CALL").select("graph_id", F.col("src").alias("at"), F.col("dst").alias("m"))
    par = graph.etype("AST").select("graph_id", F.col("src").alias("m"), F.col("dst").alias("p")).join(n.where("label = 'METHOD_PARAMETER_IN'").select("graph_id", F.col("id").alias("p"), F.coalesce("index", "order").alias("idx")), ["graph_id", "p"])
    into = a.join(link, ["graph_id", "at"]).join(par, ["graph_id", "m", "idx"]).select("graph_id", F.col("arg").alias("src"), F.col("p").alias("dst"), F.col("at").alias("call"), F.lit("in").alias("kind"))
    rets = graph.etype("CONTAINS").select("graph_id", F.col("src").alias("m"), F.col("dst").alias("r")).join(n.where("label = 'RETURN'").select("graph_id", F.col("id").alias("r")), ["graph_id", "r"])
    value = rets.join(graph.etype("ARGUMENT").select("graph_id", F.col("src").alias("r"), F.col("dst").alias("v")), ["graph_id", "r"])
    back = value.join(link, ["graph_id", "m"]).select("graph_id", F.col("v").alias("src"), F.col("at").alias("dst"), F.col("at").alias("call"), F.lit("out").alias("kind"))
    return flow.unionByName(within).unionByName(into).unionByName(back)


def reachable_by(sinks: Traversal, sources: Traversal, semantics: DataFrame | None = None, most_calls: int = 4, most_steps: int | None = None, most_args: int | None = 1000) -> DataFrame:
    """(graph_id, source, sink, path): for each pair the longest of the shortest walks of a value back from the sink.

    Backward from the sinks along flow_edges, a frontier at a time; the stack of call sites makes a value that came out of a
    method go in again at the same call, and holds at most most_calls entries. A (sink, node, stack) is walked once, which
    ends cycles; most_steps bounds the walks where it is given. Written round by round. Ties between paths go to the smallest.
    """
    scratch = Scratch(sinks.df.sparkSession)
    e = scratch.save(flow_edges(sinks.graph, semantics).distinct())
    # a call site with more than most_args arguments is not expanded, as its users expect; with None every one is
    limit = 2**62 if most_args is None else most_args
    wide = sinks.graph.etype("ARGUMENT").groupBy("graph_id", F.col("src").alias("call")).count().where(F.col("count") > limit).select("graph_id", "call")
    e = e.join(wide, ["graph_id", "call"], "left_anti").select("graph_id", F.col("src").alias("s"), F.col("dst").alias("d"), "call", "kind")
    src = sources.df.select("graph_id", F.col("id").alias("node")).distinct()
    now = sinks.df.select("graph_id", F.col("id").alias("sink"), F.col("id").alias("node")).distinct().withColumn("stack", F.expr("cast(array() as array<bigint>)")).withColumn("path", F.array("node"))
    now = scratch.save(now)
    seen = [now.select("graph_id", "sink", "node", "stack")]
    hits = [now.join(src, ["graph_id", "node"], "left_semi")]
    step = 0
    while most_steps is None or step < most_steps:
        step += 1
        seen, hits = merged(seen, scratch), merged(hits, scratch)
        j = now.join(e, (now["graph_id"] == e["graph_id"]) & (now["node"] == e["d"])).drop(e["graph_id"])
        top = F.try_element_at("stack", F.lit(-1))
        # backward: over 'out' a method is entered (push), over 'in' it is left (pop, or any caller where the stack is empty)
        ok = (F.col("kind").isin("flow", "within")) | ((F.col("kind") == "out") & (F.size("stack") < most_calls)) | ((F.col("kind") == "in") & ((F.size("stack") == 0) | (top == F.col("call"))))
        stack = F.when(F.col("kind") == "out", F.array_append("stack", F.col("call"))).when((F.col("kind") == "in") & (F.size("stack") > 0), F.slice("stack", 1, F.greatest(F.size("stack") - 1, F.lit(0)))).otherwise(F.col("stack"))
        nxt = j.where(ok & ~F.array_contains("path", F.col("s"))).select("graph_id", "sink", F.col("s").alias("node"), stack.alias("stack"), F.array_append("path", F.col("s")).alias("path"))
        nxt = nxt.groupBy("graph_id", "sink", "node", "stack").agg(F.min("path").alias("path"))
        old = seen[0]
        for s in seen[1:]:
            old = old.unionByName(s)
        now = scratch.save(nxt.join(old, ["graph_id", "sink", "node", "stack"], "left_anti"))
        if now.isEmpty():
            break
        seen.append(now.select("graph_id", "sink", "node", "stack"))
        hits.append(now.join(src, ["graph_id", "node"], "left_semi"))
    found = hits[0]
    for h in hits[1:]:
        found = found.unionByName(h)
    found = found.select("graph_id", F.col("node").alias("source"), "sink", F.reverse("path").alias("path"))
    best = found.groupBy("graph_id", "source", "sink").agg(F.min(F.struct((-F.size("path")).alias("n"), "path")).alias("b"))
    return best.select("graph_id", "source", "sink", F.col("b.path").alias("path"))


def reached_sources(sinks: Traversal, sources: Traversal, **kw) -> Traversal:
    """The sources that reach some sink."""
    ids = reachable_by(sinks, sources, **kw).select("graph_id", F.col("source").alias("id")).distinct()
    return sources._with(sources.df.join(ids, KEY, "left_semi"))


def backward_slice(sinks: Traversal, most: int = 20) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): what data flows into the sinks over at most `most` steps, and the flow among them."""
    c = sinks.graph.closure(["REACHING_DEF"], sinks.df, reverse=True, most=most)
    ids = c.select("graph_id", F.col("to").alias("id")).unionByName(sinks.df.select(*KEY)).distinct()
    nodes = sinks.graph.nodes.join(ids, KEY, "left_semi")
    e = sinks.graph.etype("REACHING_DEF")
    e = e.join(ids.withColumnRenamed("id", "src"), ["graph_id", "src"], "left_semi").join(ids.withColumnRenamed("id", "dst"), ["graph_id", "dst"], "left_semi")
    return nodes, e.select("graph_id", "src", "dst", "variable").distinct()


def usage_slice(graph: Graph, least_calls: int = 1) -> DataFrame:
    """(graph_id, method, variable, n_calls, calls): for each identifier name within a method, the calls that take it as an
    argument, by line; names in fewer calls are left out."""
    u = _uses(graph).where("label = 'IDENTIFIER'")
    c = graph.nodes.where("label = 'CALL'").select("graph_id", F.col("id").alias("at"), F.coalesce("name", "code").alias("call"), "line_number")
    m = graph.etype("CONTAINS").select("graph_id", F.col("src").alias("method"), F.col("dst").alias("at"))
    rows = u.join(c, ["graph_id", "at"]).join(m, ["graph_id", "at"])
    out = rows.groupBy("graph_id", "method", F.col("var").alias("variable")).agg(F.count_distinct("at").alias("n_calls"), F.array_sort(F.collect_set(F.struct("line_number", "call"))).alias("calls"))
    return out.where(F.col("n_calls") >= least_calls)
