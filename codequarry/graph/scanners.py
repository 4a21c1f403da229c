"""A registry of scanner queries over graphs. Each yields nodes that are worth a look."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.graph import special
from codequarry.graph.dataflow import reachable_by, reached_sources
from codequarry.graph.model import KEY, Graph, Traversal
from codequarry.graph.steps import Cpg, Steps


@dataclass(frozen=True)
class Scan:
    name: str
    title: str
    score: float
    tags: tuple[str, ...]
    run: Callable[[Cpg], Traversal]


REGISTRY: dict[str, Scan] = {}


def scan(name: str, title: str, score: float, *tags: str):
    def add(f: Callable[[Cpg], Traversal]) -> Callable[[Cpg], Traversal]:
        REGISTRY[name] = Scan(name, title, score, tags, f)
        return f

    return add


def selected(names: Iterable[str] = (), tags: Iterable[str] = ()) -> list[Scan]:
    """Scans by name or tag; with neither those tagged default; the tag 'all' means every one."""
    names, tags = set(names), set(tags)
    if not names and not tags:
        tags = {"default"}
    return [s for s in REGISTRY.values() if s.name in names or "all" in tags or tags & set(s.tags)]


def findings(graph: Graph, scans: Iterable[Scan] | None = None) -> DataFrame:
    """(scan, title, score, graph_id, id, line_number, code) of every finding, by falling score when shown."""
    parts = []
    for s in scans if scans is not None else selected():
        t = s.run(Cpg(graph))
        parts.append(t.df.select(F.lit(s.name).alias("scan"), F.lit(s.title).alias("title"), F.lit(float(s.score)).alias("score"), *KEY, "line_number", F.coalesce("code", "name").alias("code")))
    return reduce(DataFrame.unionByName, parts)


# Helpers.


def calls_of(cpg: Cpg, regex: str) -> Steps:
    """Call sites of methods by name, over CALL edges."""
    return cpg.method(regex).call_in()


def _count(cpg: Cpg, per: Callable[[Steps], Traversal], more_than: int) -> Steps:
    """Internal methods with more than so many nodes below them."""
    m = cpg.method().is_internal().name_not("<global>")
    t = per(m.keeping("_m"))
    n = t.df.groupBy("_m").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than).select("_m.graph_id", "_m.id")
    return m._with(m.df.join(n, KEY, "left_semi"))


def return_value_not_checked(calls: Steps) -> Steps:
    """Calls that no condition looks at: neither the call itself nor the variable that it is assigned to."""
    g = calls.graph
    cond = Steps(g, g.nodes).label("CONTROL_STRUCTURE").out("CONDITION").reached(["AST"], with_self=True)
    tested = calls._with(calls.df.join(cond.df.select(*KEY).distinct(), KEY, "left_anti"))
    inside = lambda t: t.method().df
    named = Steps(g, cond.label("IDENTIFIER").df.select(*g.nodes.columns)).keeping("_c")
    names = inside(named).select("graph_id", F.col("id").alias("_method"), F.col("_c.id").alias("_cid"))
    names = names.join(g.nodes.select(F.col("graph_id").alias("_ng"), F.col("id").alias("_nid"), F.col("name").alias("_var")), (F.col("graph_id") == F.col("_ng")) & (F.col("_cid") == F.col("_nid"))).select("graph_id", "_method", "_var").distinct()
    assigned = tested.keeping("_call").in_assignment().target().label("IDENTIFIER").keeping("_t").method()
    a = assigned.df.select("graph_id", F.col("id").alias("_method"), F.col("_call.id").alias("_call_id"), F.col("_t.id").alias("_tid"))
    a = a.join(g.nodes.select(F.col("graph_id").alias("_ng"), F.col("id").alias("_nid"), F.col("name").alias("_var")), (F.col("graph_id") == F.col("_ng")) & (F.col("_tid") == F.col("_nid"))).drop("_ng", "_nid")
    seen = a.join(names, ["graph_id", "_method", "_var"], "left_semi").select("graph_id", F.col("_call_id").alias("id")).distinct()
    return tested._with(tested.df.join(seen, KEY, "left_anti"))


def literal_int(t: Traversal) -> DataFrame:
    """(graph_id, id, n) of literals that are whole numbers, decimal or hexadecimal; others are left out."""
    hexa = F.conv(F.regexp_extract("code", r"^0[xX]([0-9a-fA-F]+)", 1), 16, 10)
    n = F.when(F.col("code").rlike(r"^0[xX]"), hexa).otherwise(F.regexp_extract("code", r"^-?\d+", 0))
    return t.df.withColumn("_n", n).select(*KEY, F.expr("try_cast(nullif(_n, '') as bigint)").alias("n")).where("n IS NOT NULL")


def tainted(sinks: Traversal, sources: Traversal) -> Steps:
    """The sinks that a source reaches; two calls deep."""
    hit = reachable_by(sinks, sources, most_calls=2).select("graph_id", F.col("sink").alias("id")).distinct()
    return Steps.of(sinks._with(sinks.df.join(hit, KEY, "left_semi")))


# Dangerous functions.

for _name, _regex, _score, _tags in (
    ("call-to-gets", "(?i)gets", 8, ("badfn", "default")), ("call-to-scanf", "(?i)scanf", 4, ("badfn",)), ("call-to-strcat", "(?i)(strcat|strncat)", 4, ("badfn",)),
    ("call-to-strcpy", "(?i)(strcpy|strncpy)", 4, ("badfn",)), ("call-to-strtok", "(?i)strtok", 4, ("badfn", "default")), ("call-to-getwd", "(?i)getwd", 4, ("badfn", "default")),
    ("call-to-strcpy-ghidra", "(.*_)?(strcpy|strncpy).*", 4, ("badfn",)), ("call-to-exec", "exec", 8, ("badfn", "default")),
):
    scan(_name, f"Dangerous function {_name.removeprefix('call-to-')} used", _score, *_tags)(lambda cpg, r=_regex: calls_of(cpg, r))


@scan("format-controlled-printf", "Format string is not a literal", 4, "badfn", "default")
def _(cpg):
    one = calls_of(cpg, "(?i)printf").where_not_step(lambda t: t.out("ARGUMENT").where("`order` = 1").label("LITERAL"))
    return one.union(calls_of(cpg, "(?i)(sprintf|vsprintf)").where_not_step(lambda t: t.out("ARGUMENT").where("`order` = 2").label("LITERAL")))


# Metrics.


@scan("too-many-params", "More than 4 parameters", 1, "metrics")
def _(cpg):
    return _count(cpg, lambda m: m.parameters(), 4)


@scan("too-high-complexity", "More than 4 control structures", 1, "metrics")
def _(cpg):
    return _count(cpg, lambda m: m.control_structures(), 4)


@scan("too-long", "More than 1000 lines", 1, "metrics")
def _(cpg):
    return cpg.method().is_internal().name_not("<global>").where("coalesce(line_number_end - line_number + 1, 0) > 1000")


@scan("multiple-returns", "More than one return", 1, "metrics")
def _(cpg):
    return _count(cpg, lambda m: m.reached(["AST"], label="RETURN"), 1)


@scan("too-many-loops", "More than 4 loops", 1, "metrics")
def _(cpg):
    return _count(cpg, lambda m: m.control_structures().exact("control_structure_type", "FOR", "DO", "WHILE"), 4)


@scan("too-nested", "Control structures more than 3 deep", 1, "metrics")
def _(cpg):
    m = cpg.method().is_internal().name_not("<global>")
    deep = m.depth(F.col("label") == "CONTROL_STRUCTURE").where("depth > 3").select(*KEY)
    return m._with(m.df.join(deep, KEY, "left_semi"))


# Checks of results and operations.


@scan("unchecked-read-recv-malloc", "Result of read, recv or malloc is not checked", 3, "default")
def _(cpg):
    return return_value_not_checked(calls_of(cpg, "(?i)(read|recv|malloc)"))


@scan("socket-send", "Result of send is not checked", 2, "default", "posix")
def _(cpg):
    four = cpg.method("send").keeping("_m").parameters().df.groupBy("_m").count().where("count = 4").select("_m.graph_id", "_m.id")
    m = cpg.method("send")
    return return_value_not_checked(m._with(m.df.join(four, KEY, "left_semi")).call_in())


@scan("signed-left-shift", "Signed value is shifted to the left", 2, "integers", "default")
def _(cpg):
    t = cpg.call().name_exact("<operator>.shiftLeft", "<operator>.assignmentShiftLeft").where_step(lambda t: t.argument(1).out("EVAL_TYPE", label="TYPE").full_name_exact("int", "long"))
    two = t.keeping("_c").out("ARGUMENT", label="LITERAL").df.groupBy("_c").count().where("count = 2").select("_c.graph_id", "_c.id")
    return t._with(t.df.join(two, KEY, "left_anti"))


@scan("strlen-truncation", "Length is stored in an int", 2, "integers", "default")
def _(cpg):
    return calls_of(cpg, "(?i)strlen").in_assignment().target().where_step(lambda t: t.out("EVAL_TYPE", label="TYPE").matching("full_name", "(g?)int"))


# Which arguments of file operations are paths.
FILE_OPERATIONS = {
    "access": [1], "chdir": [1], "chmod": [1], "chown": [1], "creat": [1], "faccessat": [2], "fchmodat": [2], "fopen": [1], "fstatat": [2], "lchown": [1], "linkat": [2, 4], "link": [1, 2],
    "lstat": [1], "mkdirat": [2], "mkdir": [1], "mkfifoat": [2], "mkfifo": [1], "mknodat": [2], "mknod": [1], "openat": [2], "open": [1], "readlinkat": [2], "readlink": [1], "renameat": [2, 4],
    "rename": [1, 2], "rmdir": [1], "stat": [1], "unlinkat": [2], "unlink": [1],
}


@scan("file-operation-race", "One path is used by two file operations", 3, "raceCondition", "default")
def _(cpg):
    ok = reduce(lambda a, b: a | b, [(F.col("_op") == n) & F.col("argument_index").isin(a) for n, a in FILE_OPERATIONS.items()])
    calls = cpg.call().name_exact(*FILE_OPERATIONS).withcol("_op", F.col("name")).keeping("_c")
    args = calls.out("ARGUMENT").df.where(ok).select("graph_id", F.col("_c.id").alias("call"), F.col("code").alias("path"))
    m = calls.method().df.select("graph_id", F.col("_c.id").alias("call"), F.col("id").alias("m"))
    per = args.join(m, ["graph_id", "call"]).groupBy("graph_id", "m", "path").agg(F.collect_set("call").alias("calls")).where(F.size("calls") > 1)
    hit = per.select("graph_id", F.explode("calls").alias("id")).distinct()
    c = cpg.call()
    return c._with(c.df.join(hit, KEY, "left_semi"))


@scan("copy-loop", "Array is written in a loop over its index", 2, "default")
def _(cpg):
    acc = Steps.of(cpg.assignment().target().label("CALL").where(F.col("name").isin("<operator>.indexAccess", "<operator>.indirectIndexAccess")))
    subs = acc.keeping("_a").subscript().df.select("graph_id", F.col("_a.id").alias("a"), "code").distinct()
    loops = acc.keeping("_a").in_ast().label("CONTROL_STRUCTURE").is_for().out("AST").where("label <> 'BLOCK'")
    inc = Steps.of(loops).assignments().target().df.select("graph_id", F.col("_a.id").alias("a"), "code").distinct()
    hit = subs.join(inc, ["graph_id", "a", "code"], "left_semi").select("graph_id", F.col("a").alias("id")).distinct()
    return Steps.of(acc._with(acc.df.join(hit, KEY, "left_semi"))).array()


@scan("constant-array-access-no-check", "Constant index without a check of the length", 3, "default")
def _(cpg):
    acc = Steps.of(cpg.array_access())
    n = literal_int(acc.keeping("_a").argument(2).label("LITERAL").dropping("_a"))
    lit = acc.keeping("_a").argument(2).label("LITERAL").df.select(*KEY, F.col("_a.id").alias("a")).join(n, KEY).select("graph_id", "a", "n")
    held = acc.keeping("_a").method().df.select("graph_id", F.col("_a.id").alias("a"), F.col("id").alias("m"))
    g = cpg.graph
    length = Steps(g, g.nodes).label("CONTROL_STRUCTURE").out("CONDITION").reached(["AST"], label="IDENTIFIER", with_self=True).matching("name", "(?i).*(len|size|count|cnt|num).*")
    m = Steps.of(length).method().df.select("graph_id", F.col("id").alias("m")).distinct()
    hit = lit.join(held, ["graph_id", "a"]).join(m, ["graph_id", "m"], "left_anti").select("graph_id", F.col("a").alias("id")).distinct()
    return acc._with(acc.df.join(hit, KEY, "left_semi"))


# Memory.


@scan("malloc-memcpy-int-overflow", "Size of an allocation is computed and then copied to", 4, "integers", "default")
def _(cpg):
    src = calls_of(cpg, "(?i)malloc").where_step(lambda t: t.argument(1).label("CALL").where(F.col("name").rlike(r"^<operator>\.(addition|multiplication)$")))
    return tainted(calls_of(cpg, "(?i)memcpy").argument(1), src)


@scan("strncpy-no-null-term", "strncpy fills its target to the end", 4, "strings", "default")
def _(cpg):
    src = calls_of(cpg, "(?i)malloc").argument(1)
    sink = calls_of(cpg, "(?i)strncpy").argument(3)
    code = src.df.select("graph_id", "code").distinct()
    return sink._with(sink.df.join(code, ["graph_id", "code"], "left_semi"))


def _freed(cpg: Cpg) -> Steps:
    return calls_of(cpg, "(?i)(.*_)?free").argument(1)


@scan("free-field-no-reassign", "Field is freed and not set again", 5, "uaf", "default")
def _(cpg):
    fields = _freed(cpg).label("CALL").where(F.col("name").rlike(r"^<operator>\.(indirectF|f)ieldAccess$"))
    set_ = Steps.of(cpg.assignment()).target().df.select("graph_id", "code").distinct()
    return fields._with(fields.df.join(set_, ["graph_id", "code"], "left_anti"))


@scan("free-returned-value", "Value is freed and returned", 5, "uaf")
def _(cpg):
    freed = _freed(cpg).label("IDENTIFIER")
    names = cpg.ret().out("ARGUMENT").label("IDENTIFIER").withcol("_v", F.col("name")).method().df.select("graph_id", F.col("id").alias("m"), F.col("_v").alias("name")).distinct()
    held = freed.keeping("_f").withcol("_v", F.col("name")).method().df.select("graph_id", F.col("id").alias("m"), F.col("_v").alias("name"), F.col("_f.id").alias("f"))
    hit = held.join(names, ["graph_id", "m", "name"], "left_semi").select("graph_id", F.col("f").alias("id"))
    return freed._with(freed.df.join(hit, KEY, "left_semi"))


@scan("free-follows-value-reuse", "Value is used after it was freed", 5, "uaf")
def _(cpg):
    freed = _freed(cpg).label("IDENTIFIER")
    after = freed.withcol("_v", F.col("name")).keeping("_f").in_call().post_dominated_by().where("label = 'IDENTIFIER' AND name = _v")
    hit = after.df.select("_f.graph_id", "_f.id").distinct()
    return freed._with(freed.df.join(hit, KEY, "left_semi"))


# Taint.


def _flow_scan(name: str, title: str, score: float, tags: tuple[str, ...], sources: Callable[[Cpg], Traversal], sinks: Callable[[Cpg], Traversal]) -> None:
    scan(name, title, score, *tags)(lambda cpg: tainted(sinks(cpg), sources(cpg)))


_flow_scan("getenv-to-strcpy", "Environment value is copied without a bound", 4, ("badfn",), lambda c: calls_of(c, "getenv"), lambda c: calls_of(c, "strcpy").argument(2))
_flow_scan("unsafe-crypto-hash-algo", "Weak hash algorithm", 6, ("cryptography", "default"), lambda c: c.literal('"?(MD5|SHA-1)"?'), lambda c: calls_of(c, "getInstance").argument())
_flow_scan("sql-injection", "Request value reaches a query", 5, ("sqlInjection", "default"), lambda c: c.parameter(), lambda c: calls_of(c, "query").argument(1))
_flow_scan("php-sql-injection", "Request value reaches a query", 5, ("remoteCodeExecution", "default"), lambda c: c.argument(r".*\$_(REQUEST|GET|POST).*"), lambda c: calls_of(c, "query").where_step(lambda t: t.out("RECEIVER")).argument())
_flow_scan("shell-exec", "Request value reaches a shell", 5, ("remoteCodeExecution", "default"), lambda c: c.argument(r".*\$_(REQUEST|GET|POST).*"), lambda c: calls_of(c, "shell_exec").argument())
_flow_scan("xss-servlet", "Request parameter is written to the response", 8, ("xss", "default"), lambda c: calls_of(c, "getParameter"), lambda c: calls_of(c, "(print|println|write)").argument(1))
_flow_scan("usage-of-nop-trust-manager", "Trust manager that checks nothing", 5, ("android", "insecureNetworkTraffic"), lambda c: c.call("<operator>.alloc").type_full_name_is(".*TrustManager.*"), lambda c: calls_of(c, "init").argument(2))


@scan("unzip-directory-traversal", "Archive entry's path is not checked", 4, "pathTraversal", "android")
def _(cpg):
    src = cpg.parameter().where(F.col("type_full_name").rlike("Zip(File|InputStream|Entry)$"))
    checked = reached_sources(calls_of(cpg, "startsWith").argument(), src)
    loose = src._with(src.df.join(checked.df.select(*KEY), KEY, "left_anti"))
    return tainted(calls_of(cpg, "<init>").where(F.col("method_full_name").contains("FileOutputStream")).argument(), loose)


@scan("low-pbe-key-iterations", "Too few rounds of key derivation", 6, "cryptography", "default")
def _(cpg):
    t = calls_of(cpg, "<init>").where(F.col("method_full_name").contains("PBEKeySpec")).argument(3)
    few = literal_int(cpg.literal()).where("n < 1000").select(*KEY)
    lit = cpg.literal()
    return tainted(t, lit._with(lit.df.join(few, KEY, "left_semi"))).union(Steps.of(t._with(t.df.join(few, KEY, "left_semi")))).dedup()


# Configuration and shape.


# Signatures of the methods that check certificates and hosts.
VALIDATORS = {
    "verify": ["boolean(java.lang.String,javax.net.ssl.SSLSession)"],
    "checkClientTrusted": ["void(java.security.cert.X509Certificate[],java.lang.String,javax.net.ssl.SSLEngine)"],
    "checkServerTrusted": ["void(java.security.cert.X509Certificate[],java.lang.String,javax.net.ssl.SSLEngine)"],
}


@scan("ineffective-certificate-check", "Certificate check that always passes", 6, "badimpl", "default")
def _(cpg):
    """What runs first in a validator, behind copies of parameters to locals, is a return or the literal 1 that is returned."""
    g = cpg.graph
    m = cpg.method().exact("name", *VALIDATORS).exact("signature", *[v for vs in VALIDATORS.values() for v in vs])
    other = Steps(g, g.nodes).label("IDENTIFIER").where_step(lambda t: t.out("REF").where("label <> 'LOCAL'"))
    plain = Steps(g, g.nodes).label("IDENTIFIER").minus(other)
    copies = cpg.call().where(F.col("method_full_name") == "<operator>.assignment")
    # an assignment of assignments counts as its arguments do; each round takes the next level in
    skipped = plain
    while True:
        ids = skipped.df.select("graph_id", F.col("id").alias("_a")).distinct()
        e = g.etype("ARGUMENT").select("graph_id", "src", F.col("dst").alias("_a"))
        loose = e.join(ids, ["graph_id", "_a"], "left_anti").select("graph_id", F.col("src").alias("id")).distinct()
        more = copies._with(copies.df.join(loose, KEY, "left_anti"))
        new = more.minus(skipped)
        if new.is_empty():
            break
        skipped = skipped.union(new)
    free = Graph(g.nodes, g.etype("CFG").join(skipped.df.select("graph_id", F.col("id").alias("src")).distinct(), ["graph_id", "src"], "left_semi"))
    first = m.keeping("_m").out("CFG")
    behind = Steps(free, first.df, first.carry).reached(["CFG"], with_self=True)
    stop = Steps(g, behind.df, behind.carry).dropping("_m")
    stop = stop._with(stop.df.join(skipped.df.select(*KEY).distinct(), KEY, "left_anti")).dedup()
    one = stop.label("LITERAL").exact("code", "1").where_not_step(lambda t: t.out("CFG").where("label <> 'RETURN'"))
    return stop.label("RETURN").union(one)


@scan("usage-of-insecure-protocol", "Unencrypted protocol", 4, "insecureNetworkTraffic", "android")
def _(cpg):
    return cpg.method().exact("full_name", "java.net.URL.<init>:void(java.lang.String)").call_in().where_step(lambda t: t.argument().label("LITERAL").matching("code", "[^h]*http:.*"))


# Applications of the Android kind. Names in a manifest belong to the graph that holds it.


def reached_calls(calls: Steps, sources: Traversal, index: int | None = None) -> Steps:
    """The calls of which a source reaches some argument, or the one of an index."""
    hit = reachable_by(calls.argument(index), sources, most_calls=2).select("graph_id", F.col("sink").alias("dst")).distinct()
    ids = calls.graph.etype("ARGUMENT").join(hit, ["graph_id", "dst"], "left_semi").select("graph_id", F.col("src").alias("id")).distinct()
    return calls._with(calls.df.join(ids, KEY, "left_semi"))


@scan("intent-to-runtime-exec", "Intent value is executed", 9, "android")
def _(cpg):
    names = special.reaches_default_category(cpg.config_file().where(F.col("name").endswith("AndroidManifest.xml")))
    t = cpg.type_decl()
    intents = t._with(t.df.join(names, ["graph_id", "name"], "left_semi")).out("AST", label="METHOD").out("CONTAINS", label="CALL").where("name = 'getIntent' AND type_full_name = 'android.content.Intent'")
    return reached_calls(cpg.call("exec").where("type_full_name = 'java.lang.Process'"), intents)


@scan("broadcast-to-file-write", "Broadcast value is written to a file", 6, "android")
def _(cpg):
    t = special.registered_broadcast_receivers(cpg)
    open_ = t._with(t.df.join(special.exported_receivers(special.app_manifest(cpg)), ["graph_id", "name"], "left_semi"))
    data = open_.out("AST", label="METHOD").exact("name", "onReceive").out("AST", label="METHOD_PARAMETER_IN").where(F.col("index") == 2)
    writes = cpg.call().exact("name", "write").where_step(lambda c: c.argument().label("IDENTIFIER").exact("type_full_name", "java.io.FileOutputStream"))
    return reached_calls(writes, data)


@scan("external-storage-to-dex-classloader", "Code is loaded from external storage", 9, "android")
def _(cpg):
    allowed = special.reads_external_storage(special.app_manifest(cpg)).df.select("graph_id").distinct()
    reads = special.external_storage_dir(cpg)
    reads = reads._with(reads.df.join(allowed, "graph_id", "left_semi"))
    made = cpg.call().exact("name", "<init>").where_step(lambda c: c.argument(0).label("IDENTIFIER").exact("type_full_name", "dalvik.system.DexClassLoader"))
    made = reached_calls(made, reads, 1)
    loaders = special.dex_class_loaders(cpg)
    held = made.method().df.select("graph_id", F.col("id").alias("_m")).distinct()
    of = loaders.keeping("_l").nearest("METHOD").df.select("graph_id", F.col("_l.id").alias("id"), F.col("id").alias("_m"))
    loaders = loaders._with(loaders.df.join(of.join(held, ["graph_id", "_m"], "left_semi").select(*KEY), KEY, "left_semi"))
    invoked = cpg.call().exact("method_full_name", "java.lang.reflect.Method.invoke:java.lang.Object(java.lang.Object,java.lang.Object[])")
    return reached_calls(invoked, special.calls_on(loaders, "loadClass"), 1)


@scan("insecure-load-url-to-exec", "Script value is executed", 9, "android")
def _(cpg):
    plain = cpg.literal().where(F.regexp_replace("code", '^"|"$', "").startswith("http:"))
    views = special.enabling_script(special.web_views(cpg))
    loads = special.load_url_calls(views.keeping("_v"))
    # the literal lies in the method of the call
    pairs = reachable_by(loads.argument(), plain, most_calls=2).select("graph_id", "source", F.col("sink").alias("dst"))
    calls = cpg.graph.etype("ARGUMENT").select("graph_id", "dst", F.col("src").alias("call")).join(pairs, ["graph_id", "dst"])
    own = lambda t, as_: t.keeping("_n").method().df.select("graph_id", F.col("_n.id").alias(as_), F.col("id").alias("_m"))
    hit = calls.join(own(plain, "source"), ["graph_id", "source"]).join(own(cpg.call().exact("name", "loadUrl"), "call"), ["graph_id", "call", "_m"]).select("graph_id", "call").distinct()
    seen = loads.df.select("graph_id", F.col("id").alias("call"), F.col("_v.id").alias("view")).join(hit, ["graph_id", "call"], "left_semi").select("graph_id", F.col("view").alias("id")).distinct()
    clear = special.names_cleartext_traffic(special.app_manifest(cpg)).df.select("graph_id").distinct()
    views = views._with(views.df.join(seen, KEY, "left_semi").join(clear, "graph_id", "left_semi"))
    bridges = special.add_script_interface_calls(views).argument(1).label("IDENTIFIER", "CALL").df.select("graph_id", F.col("type_full_name").alias("full_name")).distinct()
    exposed = special.exposed_to_script(cpg)
    of = exposed.keeping("_e").defining_type_decl().df.join(bridges, ["graph_id", "full_name"], "left_semi").select("graph_id", F.col("_e.id").alias("id")).distinct()
    exposed = exposed._with(exposed.df.join(of, KEY, "left_semi"))
    return reached_calls(cpg.call("exec").where("type_full_name = 'java.lang.Process'"), exposed.parameters())


@scan("intent-redirection", "Intent from outside is started", 4, "android")
def _(cpg):
    sources = cpg.method().exact("name", "getParcelableExtra").call_in().matching("code", ".*Intent.*")
    guarded = lambda t: t.controlled_by().in_("AST", label="CONTROL_STRUCTURE")
    sinks = cpg.method().exact("name", "startActivity").call_in().where_not_step(guarded).argument()
    return Steps.of(reached_sources(sinks, sources, most_calls=2))


@scan("fragment-injection", "Old target version lets fragments be injected", 4, "android", "misconfiguration")
def _(cpg):
    lines = F.split("content", "\n")
    version = lambda line: F.transform(F.regexp_extract_all(line, F.lit(r"^[^t]+targetSdk[^0-9]+(\d+)"), F.lit(1)), lambda v: v.cast("int"))
    return cpg.config_file(".*build.gradle").where(F.exists(lines, lambda line: F.exists(version(line), lambda v: v < 19)))


@scan("root-detection-via-file-checks", "Root is looked for by files", 3, "android")
def _(cpg):
    known = F.regexp_replace(F.regexp_replace("code", '"$', ""), "'$", "")
    paths = cpg.literal().where(F.col("code").contains("/") & (known.endswith("Superuser.apk") | known.endswith("superuser.apk") | known.endswith("/su")))
    checks = reached_calls(cpg.call().exact("method_full_name", "java.io.File.exists:boolean()"), paths)
    return checks.method().where_step(lambda m: m.caller())


def _config(cpg: Cpg, name: str, regex: str) -> Steps:
    return cpg.config_file(name).where(F.col("content").rlike(regex))


@scan("manifest-backup-enabled", "Backup is enabled", 3, "android", "misconfiguration")
def _(cpg):
    return _config(cpg, ".*AndroidManifest.xml", r'allowBackup\s*=\s*"true"')


@scan("tap-jacking", "Old target version lets windows be overlaid", 6, "android", "misconfiguration")
def _(cpg):
    f = cpg.config_file(r".*build\.gradle.*")
    return f.where(F.expr("try_cast(regexp_extract(content, 'targetSdk(?:Version)?\\\\s*=?\\\\s*(\\\\d+)', 1) as int)") < 23)


@scan("vuln-prng-android-v16_18", "Random numbers of old versions", 6, "android", "cryptography", "misconfiguration")
def _(cpg):
    f = cpg.config_file(r".*build\.gradle.*")
    old = f.where(F.expr("try_cast(regexp_extract(content, 'minSdk(?:Version)?\\\\s*=?\\\\s*(\\\\d+)', 1) as int)") <= 18).df.select("graph_id").distinct()
    c = cpg.call().where(F.col("method_full_name").rlike(r"SecureRandom\.<init>"))
    return c._with(c.df.join(old, "graph_id", "left_semi"))
