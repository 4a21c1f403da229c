import random

import pytest

from codequarry.operators import curation
from codequarry.operators.curation import Dataset

FUNC = "file_ordinal long, ordinal long, is_vul boolean, func_name string, sig_before string, func_before string, sig string, func string, diff_line_info struct<deleted_lines:array<string>,added_lines:array<string>>"


def dataset(spark, seed):
    rng = random.Random(seed)
    cve = [(c, f"C{c}", rng.sample(["CWE-1", "CWE-2", "CWE-3"], rng.randrange(3))) for c in range(1, 16)]
    commit, file, func = [], [], []
    for c, *_ in cve:
        twin = rng.random() < 0.5
        for k in range(rng.randrange(1, 6)):
            commit.append((c, len(commit) + 1, rng.choice(["a/b", "a/b", "x/y", None]), rng.choice(["", "same", "same", f"m{k}"]) if not twin else "", f"h{rng.randrange(30)}", rng.randrange(3)))
            for p in rng.sample(["p.c", "q.c"], rng.randrange(0, 3)) if not twin else ["p.c"]:
                file.append((len(commit), len(file) + 1, p, f"src/{p}", "c"))
                for j in range(rng.randrange(0, 4)) if not twin else range(2):
                    vul = rng.random() < 0.5 if not twin else j == 0
                    body = rng.choice(["t1", "t2"]) if not twin else rng.choice(["t1", "t1", "t2"])
                    lines = ([f"- {rng.choice('ab') if not twin else 'a'}"], ["+"])
                    func.append((len(file), len(func) + 1, vul, rng.choice(["f", "g"]), "(s)" if vul else None, body + "b" if vul else None, rng.choice(["(s)", "(t)"]), body, lines if vul else None))
    mk = spark.createDataFrame
    ds = Dataset(mk(cve, "ordinal long, cve_id string, cwe_ids array<string>"), mk(commit, "cve_ordinal long, ordinal long, repo_name string, commit_msg string, commit_hash string, commit_date long"),
                 mk(file, "commit_ordinal long, ordinal long, file_name string, file_path string, language string"), mk(func, FUNC))
    return ds, cve, commit, file, func


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_commits_brute(spark, seed):
    ds, cve, commit, file, func = dataset(spark, seed)
    files = {m[1]: [f for f in file if f[0] == m[1]] for m in commit}
    vul = {f[1]: [x for x in func if x[0] == f[1] and x[2]] for f in file}

    def equal(a, b):
        if a[3] == b[3] and a[3]:
            return True
        if {f[3] for f in files[a[1]]} != {f[3] for f in files[b[1]]}:
            return False
        for f, g in zip(files[b[1]], files[a[1]]):
            if len(vul[f[1]]) != len(vul[g[1]]):
                return False
            pairs = list(zip(vul[f[1]], vul[g[1]]))
            if not (all((x[5], x[7]) == (y[5], y[7]) for x, y in pairs) or all(x[8] == y[8] for x, y in pairs)):
                return False
        return True

    keep = []
    for c, *_ in cve:
        mine = [m for m in commit if m[0] == c]
        same = len(mine) > 1 and all(equal(a, b) for a, b in zip(mine, mine[1:]))
        keep += [m[1] for m in (mine[:1] if same else mine)]
    assert len(keep) < len(commit)
    assert sorted(r["ordinal"] for r in curation.drop_equal_commits(ds).commit.collect()) == sorted(keep)


def test_filters_only_remove(spark):
    ds, *_ = dataset(spark, 4)
    before = {r["ordinal"] for r in ds.func.collect()}
    for f in curation.CHAIN + [curation.keep_latest_non_vul, curation.debug]:
        once = f(ds)
        ids = {r["ordinal"] for r in once.func.collect()}
        assert ids <= before
        if f not in (curation.drop_large_changes,):
            assert {r["ordinal"] for r in f(once).func.collect()} == ids  # a second run changes nothing


def test_overload_keys(spark):
    rows = [(1, 1, "f", "(int)", "a"), (1, 2, "f", "(long)", "b"), (1, 3, "f", "(int)", "c"), (1, 4, "g", "()", "d"), (2, 5, "f", None, "e")]
    out = curation.overload_keys(spark.createDataFrame(rows, "file long, pos long, name string, sig string, body string"), ["file"], "name", "sig", "pos")
    assert {(r["file"], r["key"], r["pos"]) for r in out.collect()} == {(1, "f$$$(int)", 3), (1, "f$$$(long)", 2), (1, "g", 4), (2, "f", 5)}


def test_empty_tables(spark):
    ds, *_ = dataset(spark, 5)
    empty = Dataset(*(x.limit(0) for x in (ds.cve, ds.commit, ds.file, ds.func)))
    out = curation.run(empty)
    assert out.func.count() == 0 and curation.counts(out).first()["n_vul"] == 0
