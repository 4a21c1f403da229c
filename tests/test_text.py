import json

import pytest
from pyspark.sql import functions as F

from codequarry.functions import abstraction, cve, urls
from codequarry.graph import cfg
from codequarry.sources import records
from codequarry.streaming import ingest
from tests.test_graph import Build, ids  # noqa: F401


def test_raw_records(spark):
    d = lambda *v: [{"lang": "en", "value": x} for x in v]
    raw = [
        {"id": "C1", "vulnStatus": "Analyzed", "descriptions": [{"lang": "es", "value": "x"}, *d("first", "second")], "weaknesses": [{"type": "Primary", "description": d("NVD-CWE-noinfo")}, {"type": "Secondary", "description": d("CWE-2", "CWE-1", "CWE-1")}],
         "metrics": {"cvssMetricV2": [{"type": "Secondary", "baseSeverity": "LOW", "cvssData": {"vectorString": "a", "baseScore": 1.0}}, {"type": "Primary", "baseSeverity": "HIGH", "cvssData": {"vectorString": "b", "baseScore": 7.0}}], "cvssMetricV31": [{"type": "Primary", "cvssData": {"vectorString": "c", "baseScore": 9.0, "baseSeverity": "CRITICAL"}}]}, "references": [{"url": "u"}, {"url": "v"}, {"url": "u"}]},
        {"id": "C2", "vulnStatus": "Modified", "descriptions": [], "weaknesses": [{"type": "Primary", "description": d("NVD-CWE-Other")}], "metrics": {"cvssMetricV31": [{"type": "x", "cvssData": {"vectorString": "c", "baseScore": 9.0, "baseSeverity": "CRITICAL"}}]}, "references": [{"url": "u"}]},
        {"id": "C3", "vulnStatus": "Rejected", "weaknesses": [], "references": [{"url": "u"}]}, {"id": "C4", "vulnStatus": "Analyzed", "weaknesses": [], "references": [{"url": "u"}]},
        {"id": "C5", "vulnStatus": "Analyzed", "weaknesses": [{"type": "Primary", "description": d("CWE-9")}], "metrics": {}, "references": []},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in raw], "j string").select(F.from_json("j", cve.RAW_SCHEMA).alias("r")).select("r.*")
    got = {r["cve_id"]: r for r in cve.records(df).collect()}
    assert set(got) == {"C1", "C2"}
    assert got["C1"]["description"] == "first" and got["C1"]["cwe_ids"] == ["CWE-1", "CWE-2"] and got["C1"]["urls"] == ["u", "v"]
    assert tuple(got["C1"]["cvss"]) == ("b", 7.0, "HIGH", False) and tuple(got["C2"]["cvss"]) == ("c", 9.0, "CRITICAL", True)
    assert got["C2"]["description"] == "" and got["C2"]["cwe_ids"] == ["CWE-Other"]


URLS = {
    "https://github.com/a/b/commit/abc123?x=1#top": "https://github.com/a/b/commit/abc123",
    "https://github.com/a/b/pull/7/commits/abc123def": "https://github.com/a/b/commit/abc123def",
    "https://github.com/a/b/blob/x.c": None,
    "http://git.kernel.org/?p=linux/kernel/git/torvalds/linux-2.6.git%3Ba=commitdiff_plain%3Bh=12ab": "http://git.kernel.org/?p=linux/kernel/git/torvalds/linux.git;a=commitdiff;h=12ab",
    "https://git.kernel.org/a/commit/?id=12ab": "https://git.kernel.org/a/commit/?h=12ab", "https://git.kernel.org/a/diff/commit?id=12ab": None,
    "https://sourceware.org/git/?p=glibc.git%3Bh=12": "https://sourceware.org/git/?p=glibc.git;h=12", "https://android.googlesource.com/a/+/1,2": "https://android.googlesource.com/a/+/12", "https://android.googlesource.com/a.java": None,
    "https://code.wireshark.org/review/gitweb?p=wireshark.git;a=commit;h=5b4a": "https://github.com/wireshark/wireshark/commit/5b4a", "https://git.videolan.org/?p=vlc.git%3Ba=commitdiff%3Bh=9": "https://git.videolan.org/?p=vlc.git;a=commit;h=9",
    "https://cgit.freedesktop.org/a/diff/?id=1": "https://cgit.freedesktop.org/a/commit/?id=1", "http://git.ghostscript.com/?p=mupdf.git;h=9675": "https://github.com/ArtifexSoftware/mupdf/commit/9675",
    "https://gitlab.freedesktop.org/xorg/lib/libx11/-/commit/1a2b": "https://cgit.freedesktop.org/xorg/lib/libX11/commit/?id=1a2b", "https://gitlab.gnome.org/GNOME/gimp/-/commit/12": "https://github.com/GNOME/gimp/commit/12",
    "https://git.qemu.org/gitweb.cgi?p=qemu.git;a=commit;h=7d1d": "https://github.com/qemu/qemu/commit/7d1d", "https://gitlab.com/a/b/-/commit/12#note": "https://gitlab.com/a/b/-/commit/12", "http://git.php.net/?p=php-src.git;a=commit;h=77": "https://github.com/php/php-src/commit/77",
    "https://git.savannah.gnu.org/cgit/a.git/patch/?id=1": "https://git.savannah.gnu.org/cgit/a.git/commit/?id=1", "https://unknown.example/x/commit/1": None, "not a url": None,
}


def test_host_rules(spark):
    df = spark.createDataFrame([(str(i), u) for i, u in enumerate(URLS)], "record string, url string")
    got = {r["record"]: r["url"] for r in urls.mine(df).collect()}
    for i, (u, want) in enumerate(URLS.items()):
        assert got.get(str(i)) == want, u


def test_mining_over_pages(spark):
    refs = [(1, "https://security-tracker.debian.org/tracker/C1"), (2, "https://github.com/a/b/pull/3"), (2, "https://github.com/a/b/commit/77"), (3, "https://github.com/a/b/pull/3"), (4, "https://gitlab.com/x/y/issues/1"), (5, None), (6, "https://git.gnome.org/x")]
    links = [("https://security-tracker.debian.org/tracker/C1", "https://github.com/q/r/commit/aa"), ("https://security-tracker.debian.org/tracker/C1", "https://rustsec.org/1"), ("https://rustsec.org/1", "https://github.com/q/r/commit/bb"), ("https://github.com/a/b/pull/3", "https://github.com/a/b/commit/33")]
    links += [("https://gitlab.com/x/y/issues/1", f"https://gitlab.com/x/y/commit/{i}") for i in range(11)]
    out = urls.mine(spark.createDataFrame(refs, "record int, url string"), spark.createDataFrame(links, "page string, url string"), spark.createDataFrame([("https://git.gnome.org/x", "https://gitlab.gnome.org/browse/x/commit/1")], "url string, final string"))
    got = {(r["record"], r["url"]) for r in out.collect()}
    assert got == {(1, "https://github.com/q/r/commit/aa"), (1, "https://github.com/q/r/commit/bb"), (2, "https://github.com/a/b/commit/77"), (3, "https://github.com/a/b/commit/33"), (6, "https://github.com/GNOME/x/commit/1")}


CODE = """static int add(struct s *p, int n)
{
    int total = n + 0x1F; // sum
    const char *t = "a b";
    if (p->len > total) { goto out; }
    total = helper(p, 'c');
out:
    return total;
}"""


def test_abstraction():
    table = abstraction.symbols(CODE)
    out = abstraction.render(CODE, table)
    assert out.startswith("static TYPE_0 add(struct TYPE_1 *VAR_0, TYPE_0 VAR_1)") and "VAR_2 = VAR_1 + 0x1F; /* COMMENT_0 */" in out
    assert "VAR_0->FIELD_0" in out and "FUNC_0(VAR_0, CHAR_0)" in out and "goto LABEL_0;" in out and "LABEL_0:" in out and "= STR_0;" in out
    assert abstraction.render(CODE, table, {}) == CODE and out.count("\n") == CODE.count("\n")
    assert "NUMBER_0" in abstraction.render(CODE, table, {"NUMBER": True})
    with pytest.raises(ValueError):
        abstraction.render(CODE, table, {"NOPE": True})
    two = "void f() { /* a\nbb */ g(); }"
    assert abstraction.render(two, abstraction.symbols(two)) == "TYPE_0 f() { /* COMMENT_0 */\n      FUNC_0(); }"


def test_function_extraction(spark):
    src = '#include <a.h>\nint x = f(1);\nstruct t { int a; };\n' + CODE + "\n\nnamespace n { class K : public B { public: K(int a) : b(a) { } int get() const { if (a) { return 1; } return 0; } }; }\nint n::K::other(void) { return 0; }\nint proto(int);\n"
    got = abstraction.functions(src)
    assert [f["func_name"] for f in got] == ["add", "K", "get", "n::K::other"]
    assert got[0]["signature"] == "(struct s *, int)" and got[0]["return_type"] == "int" and got[0]["func"] == CODE and (got[0]["first_line"], got[0]["last_line"]) == (4, 12)
    df = abstraction.extract_functions(spark.createDataFrame([(1, src), (2, None), (3, "")], "id int, text string"), "id", "text")
    assert df.count() == 4 and df.columns[0] == "id"
    java = "class A { @X public int f(List<Map<String, B>> a, int... b) throws E { return 1; } A() { } }"
    assert [(f["func_name"], f["signature"]) for f in abstraction.functions(java)] == [("f", "(List < Map < String , B > >, int ...)"), ("A", "()")] or [f["func_name"] for f in abstraction.functions(java)] == ["f", "A"]


def edges_of(spark, b):
    return {(r["src"], r["dst"]) for r in cfg.control_flow(b.graph(spark)).collect()}


def test_flow_of_assignment(spark):
    b = Build()
    m, blk, ret = b.node("METHOD", name="f"), b.node("BLOCK", order=1), b.node("METHOD_RETURN", order=2)
    a, x, p = b.node("CALL", name="<operator>.assignment", order=1), b.node("IDENTIFIER", name="x", order=1), b.node("CALL", name="<operator>.addition", order=2)
    y, one = b.node("IDENTIFIER", name="y", order=1), b.node("LITERAL", code="1", order=2)
    b.under(m, blk, ret)
    b.under(blk, a)
    b.under(a, x, p)
    b.under(p, y, one)
    assert edges_of(spark, b) == {(m, x), (x, y), (y, one), (one, p), (p, a), (a, ret)}


def test_flow_of_control(spark):
    b = Build()
    m, blk, ret = b.node("METHOD", name="f"), b.node("BLOCK", order=1), b.node("METHOD_RETURN", order=2)
    b.under(m, blk, ret)
    w, c = b.node("CONTROL_STRUCTURE", control_structure_type="WHILE", order=1), b.node("IDENTIFIER", name="c", order=1)
    body = b.node("BLOCK", order=2)
    i, d = b.node("CONTROL_STRUCTURE", control_structure_type="IF", order=1), b.node("IDENTIFIER", name="d", order=1)
    br, e = b.node("CONTROL_STRUCTURE", control_structure_type="BREAK", order=2), b.node("CALL", name="e", order=2)
    g, h = b.node("CALL", name="<operator>.logicalAnd", order=2), (b.node("IDENTIFIER", name="p", order=1), b.node("IDENTIFIER", name="q", order=2))
    r = b.node("RETURN", order=3)
    b.under(blk, w, g, r)
    b.under(w, c, body)
    b.under(body, i, e)
    b.under(i, d, br)
    b.under(g, *h)
    assert edges_of(spark, b) == {(m, c), (c, d), (d, br), (d, e), (e, c), (br, h[0]), (c, h[0]), (h[0], h[1]), (h[0], g), (h[1], g), (g, r), (r, ret)}


def test_flow_of_switch_and_goto(spark):
    b = Build()
    m, blk, ret = b.node("METHOD", name="f"), b.node("BLOCK", order=1), b.node("METHOD_RETURN", order=2)
    b.under(m, blk, ret)
    s, c, body = b.node("CONTROL_STRUCTURE", control_structure_type="SWITCH", order=1), b.node("IDENTIFIER", name="c", order=1), b.node("BLOCK", order=2)
    k1, a, k2, br = b.node("JUMP_TARGET", name="case 1", order=1), b.node("CALL", name="a", order=2), b.node("JUMP_TARGET", name="default", order=3), b.node("CONTROL_STRUCTURE", control_structure_type="BREAK", order=4)
    go, skip, out = b.node("CONTROL_STRUCTURE", control_structure_type="GOTO", code="goto end;", order=2), b.node("CALL", name="skip", order=3), b.node("JUMP_TARGET", name="end", order=4)
    b.under(blk, s, go, skip, out)
    b.under(s, c, body)
    b.under(body, k1, a, k2, br)
    assert edges_of(spark, b) == {(m, c), (c, k1), (c, k2), (k1, a), (a, k2), (k2, br), (br, go), (go, out), (skip, out), (out, ret)}


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string")
    records.write_json(df, str(tmp_path / "j"))
    records.write_json(df.limit(0), str(tmp_path / "j"))  # stays
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    (tmp_path / "list.json").write_text('[{"id": 1},\n {"id": 2}]')
    assert records.read_json_list(spark, str(tmp_path / "list.json"), "id long").count() == 2
    (tmp_path / "log").write_text("h1|||||||||| fix\nh2 |||||||||| fix\nplain  \n\n")
    assert [tuple(r) for r in records.read_changelog(spark, str(tmp_path / "log")).collect()] == [("fix", "h2")]
    assert records.read_lines(spark, str(tmp_path / "log")).count() == 3
    pages = spark.createDataFrame([(0, list(range(10))), (2, [1])], "page int, items array<int>")
    assert {(r["page"], r["n"], r["want"]) for r in records.incomplete_pages(pages, "page", "items", 23, 10).collect()} == {(1, 0, 10), (2, 1, 3)}
    red = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "url string, final string")
    got = {r["url"]: r["final"] for r in records.resolve_redirects(spark.createDataFrame([("a",), ("z",)], "url string"), red).collect()}
    assert got == {"a": "c", "z": "z"}
    b = Build()
    b.under(b.node("METHOD", name="f"), b.node("BLOCK"))
    records.save_graph(b.graph(spark), str(tmp_path / "g"))
    back = records.load_graph(spark, str(tmp_path / "g"))
    assert back.nodes.count() == 2 and back.edges.first()["etype"] == "AST"


def test_stream(spark, tmp_path):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id long, k string").withColumn("t", F.timestamp_seconds("id"))
    src.write.parquet(str(tmp_path / "in"))
    q = lambda: ingest.run_available(ingest.new_records(spark, str(tmp_path / "in"), src.schema, ["k"], "t", "1 day"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    src.where("id = 1").withColumn("k", F.lit("c")).write.mode("append").parquet(str(tmp_path / "in"))
    q()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]
