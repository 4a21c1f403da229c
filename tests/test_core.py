import json
import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codequarry import session
from codequarry.functions import paths, text
from codequarry.operators import radix, shred, skew, statistics
from codequarry.operators.components import components


def test_key_profile_edges(spark):
    rows = [("a", "x", True, 1), ("a", "x", False, 1), ("a", "y", None, 1), ("a", None, True, 1), (None, "z", False, 1), ("b", None, None, 1), ("t", "q", True, 1), ("t", "p", True, 1)]
    df = spark.createDataFrame(rows, "k string, v string, f boolean, key int")  # 'key' clashes with the result's
    got = {r["key"]: r for r in skew.key_profile(df, F.col("k"), F.col("v"), F.col("f")).collect()}
    assert (got["a"]["n_rows"], got["a"]["n_hits"], got["a"]["n_values"], got["a"]["mode"], got["a"]["mode_rows"]) == (4, 2, 2, "x", 2)
    assert got[None]["n_rows"] == 1 and got["b"]["mode"] is None and got["b"]["n_values"] == 0
    assert got["t"]["mode"] == "p"  # the smaller of tied values
    assert skew.key_profile(df.limit(0), F.col("k"), F.col("v"), F.col("f")).count() == 0


def test_key_percentiles_brute(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), rng.choice([None, *range(-5, 40)])) for _ in range(500)] + [("one", 7), ("none", None)]
    got = {(r["key"], r["prob"]): r["value"] for r in skew.key_percentiles(spark.createDataFrame(rows, "k string, v long"), F.col("k"), F.col("v"), [0.0, 0.5, 0.9, 1.0]).collect()}
    by = defaultdict(list)
    for k, v in rows:
        if v is not None:
            by[k].append(v)
    want = {(k, p): sorted(vs)[max(1, math.ceil(p * len(vs))) - 1] for k, vs in by.items() for p in (0.0, 0.5, 0.9, 1.0)}
    assert got == want


def test_radix_codes_order(spark):
    vals = [float("-inf"), -2.5, -0.0, 0.0, 1e-300, 3.0, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double").withColumn("c", radix.ascending_double(F.col("v")))
    codes = {r["i"]: r["c"] % 2**64 for r in df.collect()}
    assert codes[2] == codes[3] and codes[7] == codes[8] == 2**64 - 1
    assert [codes[i] for i in (0, 1, 2, 4, 5, 6)] == sorted(codes[i] for i in (0, 1, 2, 4, 5, 6))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, how):
    rng = random.Random(8)
    rows = spark.createDataFrame([(i, rng.choice(["hot", "hot", "warm", f"k{i}", None])) for i in range(400)], "id long, k string")
    small = rows.where("k IS NOT NULL AND (k IN ('hot', 'warm') OR id % 2 = 0)").select("k").distinct().withColumn("v", F.upper("k"))
    counts = rows.where("k IS NOT NULL").groupBy("k").count()
    hot = session.hot_keys(counts, "k", "count", 400, 0.1, 10)
    assert {r["k"]: r["_ways"] for r in hot.collect()}.keys() == {"hot", "warm"}
    want = sorted(map(str, rows.join(small, "k", how).select("id", "k", "v").collect()))
    assert sorted(map(str, session.salted_join(rows, small, "k", hot, F.col("id"), how).select("id", "k", "v").collect())) == want


def test_shred_edges(spark):
    deep = '{"a":' * 3000 + "1" + "}" * 3000
    payloads = [
        None, "", "{", "[1, NaN]", '{"nodes": [null, {"id": "7", "x": [], "y": {"z": 1.50}}, 3], "edges": {"outNode": 1, "inNode": 2, "etype": "AST"}}',
        '{"nodes": {"id": 1, "id": 2}}', '{"nodes": []}', "3", deep, '{"nodes": [[{"id": 5}]], "edges": null}',
    ]
    df = spark.createDataFrame([(i, p, "graph", 9) for i, p in enumerate(payloads)], "record_id long, payload string, kind string, node int")
    adj = shred.adjacency(df, "record_id", "payload").collect()
    ids = {r["record_id"] for r in adj}
    assert ids == {4, 5, 6, 7, 9} or ids == {4, 5, 6, 7, 8, 9}  # very deep JSON may be refused, never crash
    found = {(r["record_id"], r["level"], r["pos_path"], r["child_key"]) for r in shred.found(df).collect() if r["record_id"] != 8}
    assert found == {(4, "node", "1", "7"), (4, "edge", "0", "1>2:AST"), (5, "node", "0", "2"), (9, "node", "0/0", "5")}
    assert [r["scalar"] for r in adj if r["record_id"] == 4 and r["label"] == "z"] == ["1.50"]
    assert shred.found(df.limit(0)).count() == 0


def test_fix_commits_by_hash(spark, tmp_path):
    from codequarry.plans.pipeline_queries import queries

    rows = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (4, None)]
    spark.createDataFrame(rows, "cve_ordinal long, commit_hash string").write.parquet(f"{tmp_path}/fix_commit.parquet")
    got = {r["commit_hash"]: (r["n_rows"], r["n_values"], r["mode"], r["mode_rows"]) for r in queries()["p1_fix_commit_hash_profile"](spark, str(tmp_path)).collect()}
    assert got == {"a": (3, 2, 2, 2), "b": (1, 1, 3, 1), None: (1, 1, 4, 1)}


def test_flat_tables_name_their_parents(spark, tmp_path):
    from codequarry.plans.pipeline_queries import queries

    func = {"func_name": "f", "func_before": "a", "diff_line_info": {"added_lines": ["x", "y"], "deleted_lines": []}}
    # the commits' hashes are null or repeated, so only the link tells whose files they have
    commits = [{"commit_hash": h, "commit_msg": "m", "files": [{"file_path": p, "vulnerable_functions": func, "non_vulnerable_functions": [None, {"func_name": p, "func": "b"}]}]} for h, p in ((None, "p"), (None, "q"), ("h", "r"), ("h", "s"))]
    rows = [(1, "cve_record", json.dumps({"cve_id": "C", "cvss_is_v3": True, "cwe_ids": ["W1", None, "W2"], "commits": commits})), (2, "graph", json.dumps({"version": "1", "nodes": [{"id": 1, "overlays": ["o"]}], "edges": {"inNode": 1, "outNode": 1, "etype": "AST"}})), (3, "cve_record", "no json")]
    spark.createDataFrame(rows, "record_id long, kind string, payload string").write.parquet(f"{tmp_path}/raw_record.parquet")
    at = {n: [r.asDict() for r in q(spark, str(tmp_path)).collect()] for n, q in queries().items() if n.startswith("p4_")}
    assert [(r["record_id"], r["parent_node"], r["cve_id"], r["cvss_is_v3"]) for r in at["p4_record"]] == [(1, None, "C", "true")]
    objects = {(r["record_id"], r["node"]): r for r in at["p4_object"]}
    assert Counter(r["level"] for r in objects.values()) == {"cve_record": 1, "graph": 1, "commit": 4, "file": 4, "vul_func": 4, "non_vul_func": 4, "node": 1, "edge": 1, None: 4}
    by_place = {(r["record_id"], r["level"], r["pos_path"]): r for r in objects.values()}
    for level in ("commit", "file", "node", "edge"):  # the tables with SQL meet their link by their place
        assert len(at[f"p4_{level}"]) == sum((r["record_id"], level, r["pos_path"]) in by_place for r in at[f"p4_{level}"]) > 0
    files = {by_place[1, "file", r["pos_path"]]["node"]: r["file_path"] for r in at["p4_file"]}
    assert sorted((files[r["parent_node"]], r["func_name"], r["func"]) for r in at["p4_non_vul_func"]) == [(p, p, "b") for p in "pqrs"]
    assert sorted((files[r["parent_node"]], r["func_before"]) for r in at["p4_vul_func"]) == [(p, "a") for p in "pqrs"]
    tops = {r["node"] for r in at["p4_record"]}
    assert all(objects[1, objects[1, f]["parent_node"]]["parent_node"] in tops for f in files)
    items = sorted((r["ordinal"], r["kind"], r["value"]) for r in at["p4_scalar"] if r["label"] == "cwe_ids" and r["parent_node"] in tops)
    assert items == [(0, "string", "W1"), (1, "null", None), (2, "string", "W2")]
    lines = [r for r in at["p4_scalar"] if r["label"] == "added_lines"]
    assert Counter(objects[1, objects[1, r["parent_node"]]["parent_node"]]["level"] for r in lines) == {"vul_func": 8}
    assert {r["value"] for r in at["p4_scalar"] if r["label"] in ("commit_msg", "overlays", "version")} == {"m", "o", "1"}


def test_shred_round_trip(spark):
    rng = random.Random(3)

    def value(d):
        k = rng.randrange(6 if d else 4)
        return [None, True, rng.randrange(99), "s%d" % rng.randrange(9)][k] if k < 4 else {f"m{i}": value(d - 1) for i in range(rng.randrange(4))} if k == 4 else [value(d - 1) for _ in range(rng.randrange(4))]

    recs = {i: {"r": value(4)} for i in range(60)}
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in recs.items()], "record_id long, payload string")
    got = Counter((r["record_id"], r["label_path"], r["kind"]) for r in shred.adjacency(df, "record_id", "payload").collect())

    def walk(v, path, out):
        if isinstance(v, dict):
            out.append((path, "object"))
            for k, x in v.items():
                walk(x, f"{path}/{k}" if path else k, out)
        elif isinstance(v, list):
            if not v:
                out.append((path, "empty"))
            for x in v:
                walk(x, path, out)
        else:
            out.append((path, "null" if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, int) else "string"))

    want = Counter()
    for i, r in recs.items():
        out = []
        walk(r, "", out)
        want.update((i, *x) for x in out)
    assert got == want


@pytest.mark.parametrize("seed", [0, 1])
def test_components_brute(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(80):03d}", f"n{rng.randrange(80):03d}") for _ in range(60)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [(None, "x"), ("loop", "loop")]
    edges += [("hub", f"h{i:03d}") for i in range(50)] * 2
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a and b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_text_functions(spark):
    src = 'int a; // x /* y\nchar *s = "/* no */ //"; /* b\nc */ int d;'
    df = spark.createDataFrame([(src,), ("",), (None,)], "t string")
    out = df.select(text.without_comments(F.col("t")).alias("w"), text.blank_comments(F.col("t")).alias("b"), text.line_count(F.col("t")).alias("n")).collect()
    assert out[0]["w"] == 'int a; \nchar *s = "/* no */ //";  int d;' and len(out[0]["b"]) == len(src) and out[0]["b"].count("\n") == 2
    assert out[0]["n"] == 3 and out[1]["n"] == 1 and out[2]["n"] is None and out[2]["b"] is None
    d = spark.createDataFrame([("a\nb\nc", "a\nx\nc"), ("a", "a"), (None, "a")], "b string, a string").select(text.diff(F.col("b"), F.col("a")).alias("d")).collect()
    assert d[0]["d"]["deleted_lines"] == ["b"] and d[0]["d"]["added_lines"] == ["x"] and d[1]["d"]["diff"] == "" and d[2]["d"]["deleted_lines"] is None
    pre = spark.createDataFrame([("#if A\nx\n#else\ny\n#endif\nz",)], "t string").select(text.first_branches(F.col("t")).alias("t")).first()["t"]
    assert pre == "\nx\n\n\n\nz"
    cut = spark.createDataFrame([("abc\ndef\nghi",)], "t string").select(text.text_slice(F.col("t"), F.lit(0), F.lit(1), F.lit(2), F.lit(2)).alias("t")).first()["t"]
    assert cut == "bc\ndef\ngh"
    dates = ["2021-03-04T05:06:07+01:00", "2021-03-04 05:06:07 +0100", "Thu, 4 Mar 2021 05:06:07 +0100", "Thu Mar 4 05:06:07 2021 +0100", "soon", None]
    got = [r["u"] for r in spark.createDataFrame([(x,) for x in dates], "t string").select(text.unix_date(F.col("t")).alias("u")).collect()]
    assert got == [1614830767] * 4 + [None, None]


def test_paths(spark):
    cases = {"src/test/a.c": True, "src/my_test.c": True, "a/unit-tests/b.c": True, "src/latest.c": False, "testing.d/x.h": True, "Foo.java": False, "src/test/FooTest.java": True, "src/test/Foo.java": False}
    df = spark.createDataFrame(list(cases.items()), "p string, want boolean").withColumn("got", paths.is_test_path(F.col("p")))
    assert all(r["want"] == r["got"] for r in df.collect())
    repo = spark.createDataFrame([("memcached/memcached.git",), ("kernel/git/stable/linux.git",), ("a/b",), ("FFmpeg/FFmpeg",)], "r string").select(paths.merged_repo(F.col("r")).alias("m"))
    assert [r["m"] for r in repo.collect()] == ["memcached", "torvalds/linux", "a/b", "ffmpeg"]


def test_statistics_small(spark):
    df = spark.createDataFrame([(2000, "a"), (2000, "b"), (2000, "a"), (2001, "c"), (None, "a")], "y int, l string")
    got = {(r["year"], r["label"]): r["n"] for r in statistics.long_matrix(df, "y", "l", 1).collect()}
    assert got == {(2000, "a"): 2, (2000, "Other"): 1, (2001, "Other"): 1}
    st = {(r["y"], r["l"]): r["offset"] for r in statistics.stacked(df.where("y = 2000"), "y", "l").collect()}
    assert st == {(2000, "a"): 0, (2000, "b"): 2}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from([0, 1, 2, 255, 256, 65536, 2**40, 2**40 + 1, -1, -(2**63), 2**63 - 1]), st.integers(0, 5)), min_size=1, max_size=60), st.integers(1, 8))
def test_cutoffs_against_sorting(spark, rows, need):
    import pandas as pd

    pdf = pd.DataFrame(rows, columns=["k", "a", "b"])
    df = spark.createDataFrame(pdf).select("k", radix.ascending_long(F.col("a")).alias("c0"), radix.ascending_long(F.col("b")).alias("c1"), "a", "b")
    sizes = pdf.groupby("k").size()
    ranks = spark.createDataFrame(pd.DataFrame({"k": sizes.index, "_need": sizes.clip(upper=need).values}))
    hot = spark.createDataFrame([(rows[0][0], 3)], "k long, _ways int")
    for kw in ({"broadcast": True}, {"hot": hot}, {}):
        cut = radix.cutoffs(df, ranks, "k", ["c0", "c1"], **kw)
        got = {(r["k"], r["a"], r["b"]) for r in df.join(cut, "k").where(radix.not_beyond(["c0", "c1"])).collect()}
        want = set()
        for k, g in pdf.groupby("k"):
            g = g.sort_values(["a", "b"]).reset_index(drop=True)
            last = tuple(g.loc[min(need, len(g)) - 1, ["a", "b"]])
            want |= {(k, a, b) for a, b in zip(g["a"], g["b"]) if (a, b) <= last}
        assert got == want


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from codequarry.session import scratch_root

    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf))
    with pytest.raises(RuntimeError):
        scratch_root(cluster)
