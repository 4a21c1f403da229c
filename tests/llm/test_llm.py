import itertools
import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codequarry.llm import capping, copies, leaks, nearpairs, packing, repetition, splitting, syntax, words
from codequarry.llm.canonical import canonical
from codequarry.llm.grammars import check

# Copies.


def test_canonical_layouts():
    a = "static inline int f(struct s *p)\n{\n  struct t x = { .a = p->b, .c = 3, .d = g(1, 2) };\n  return x.a;\n}"
    same = [
        "inline static int f( struct s *p ) {\n\tstruct t x = {.c=3,.d=g(1,2),.a=p->b,};\r\n return x.a; }",
        "INLINE static INT f(struct s *p){struct t x={ .d = g(1, 2), .a = p->b, .c = 3 };return x.a;}",
        "Inline STATIC INT F(STRUCT S *P){STRUCT T X={ .D = G(1, 2), .A = P->B, .C = 3 };RETURN X.A;}",
    ]
    assert all(canonical(s) == canonical(a) for s in same)
    other = [a.replace("inline ", ""), a.replace("g(1, 2)", "g(2, 1)"), a.replace(".c = 3", ".c = 4"), a + " x"]
    assert all(canonical(s) != canonical(a) for s in other)
    nested = "int f() { struct t x = { .a = { .p = 1, .q = 2 }, .b = \"{ .z = 1, .y\" }; }"
    assert canonical(nested) == canonical("int f() { struct t x = { .b = \"{ .z = 1, .y\", .a = { .q = 2, .p = 1 } }; }")
    # positional values keep their order, and a list that is not closed stays as it is
    assert canonical("int a[] = { 1, 2 };") != canonical("int a[] = { 2, 1 };")
    assert canonical("x = { .a = 1, .b") == b"xa1b" and canonical("") == b"" and canonical("  \n;") == b""
    assert canonical("É_1") == "é1".encode()
    assert canonical("PUBLIC Final int f()") == canonical("final public INT F()") and canonical("_Noreturn static void f()") == canonical("static _NORETURN void f()")
    deep = 5000  # nesting of any depth
    assert canonical("{.a=" * deep + "1" + "}" * deep) == b"a" * deep + b"1"
    assert canonical("x = { .b = { .d = 1, .c = 2 }, .a") == b"xbd1c2a"


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_canonical_never_fails(s):
    canonical(s)
    for lang in ("c", "cpp", "java"):
        check(s, lang)


def plain_form(text):
    """The form of a copy, written apart from the library, for the texts of these tests."""
    words = re.findall(r"[^\W_]+", text.casefold())
    k = next((i for i, w in enumerate(words) if w not in ("static", "inline", "public", "final")), len(words))
    return "".join(sorted(words[:k]) + words[k:])


def test_copy_groups_brute(spark):
    rng = random.Random(5)
    base = ["static inline int f%d(int a) { return a + %d; }" % (i, i) for i in range(40)] + ["final public int f(int a) { return %d; }" % i for i in range(9)]
    rows = []
    for o in range(1, 600):
        t = rng.choice([None, "", " ;", base[0], base[0], rng.choice(base)])
        if t and rng.random() < 0.5:
            t = t.replace(" ", "\n  ").upper()
        if t and rng.random() < 0.3:
            t = re.sub(r"^(\w+)(\s+)(\w+)", r"\3\2\1", t)
        rows.append((o, t, "x", o * 2))
    rows.append((None, base[1], "x", 1))
    df = spark.createDataFrame(rows, "ordinal long, body string, digest string, key int")  # clashing names
    groups, members = copies.copy_groups(df, "ordinal", ["body"])
    first, want, n = {}, set(), Counter()
    for o, t, *_ in rows:
        if o and t is not None:
            k = plain_form(t)
            n[k] += 1
            if k in first:
                want.add(("body", first[k], o))
            else:
                first[k] = o
    assert {(r["field"], r["ordinal_a"], r["ordinal_b"]) for r in members.collect()} == want
    assert {(r["ordinal"], r["copies"]) for r in groups.collect()} == {(first[k], n[k]) for k in first}
    g, m = copies.copy_groups(df.limit(0), "ordinal", ["body"])
    assert g.count() == 0 and m.count() == 0


def test_filters_hold_what_they_saw():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.001, 0.4):
        bits = np.packbits(rng.random(copies.SEGMENT) < share)
        data = copies._pack(bits)
        assert (copies._unpack(data) == bits).all() and len(data) <= copies.SEGMENT // 8
    seen, n = copies.Filling(1 << 20), Counter()
    for _ in range(5):
        slots = rng.integers(0, 3000, 700)
        seen.add(slots)
        n.update(slots.tolist())
    flags = lambda b: set(np.flatnonzero(np.unpackbits(b, bitorder="little")).tolist())
    assert flags(seen.once) == set(n) and flags(seen.again) == {k for k, c in n.items() if c > 1}
    # two tasks that saw a slot once each make it repeated
    (g, o, a), = seen.segments()
    once, again = copies.merged([(o, a), (o, a)])
    assert g == 0 and flags(once) == flags(again) == set(n)


def test_filters_in_parts(spark):
    """As many filters as keep each below its size: the groups stay the same, and so does the share taken for repeats."""
    rng = random.Random(8)
    n = 60_000
    df = spark.createDataFrame([(i, f"int f{rng.randrange(n * 4)}(void);") for i in range(n)], "ordinal long, body string").repartition(4)
    scratch = copies.Scratch(spark)
    shares = []
    for most in (copies.MOST_SLOTS, 1 << 17):  # one filter, and eight
        shares.append(copies.possible_repeats(copies.digests(df, "ordinal", ["body"]), n, scratch, most).agg(F.avg(F.col("maybe").cast("int"))).first()[0])
    assert abs(shares[0] - shares[1]) < 0.03
    got = [sorted(map(tuple, copies.copy_groups(df, "ordinal", ["body"], most_slots=m)[1].drop("digest").collect())) for m in (copies.MOST_SLOTS, 1 << 17)]
    assert got[0] == got[1] and len(got[0]) > 1000


# Syntax.

GOOD = {
    "c": [
        "int f(void) { return 0; }", "static inline unsigned long f(const struct s *p, int n) { for (int i = 0; i < n; i++) { a[i] = (u8) b; } do { x--; } while (x); return p->q ? 1 : 2; };",
        "void f(int a) {\n#ifdef X\n if (a) {\n#else\n if (!a) {\n#endif\n g(); }\n}", "int f(a, b) int a; char *b; { return a; }", "char *f(void) { return \"} \" \"x\"; /* { */ }",
        "int f(int (*cb)(void *), ...) { switch (x) { case 1 ... 3: break; default: ; } goto out; out: return cb(0); }", "#define M(a) do { \\\n x; \\\n} while (0)\nint f(void) { M(1); return sizeof(struct s) + sizeof x; }",
        "void *(*f(int a))(void) { return 0; }", "int f(void) { struct { int a; } s = { .a = 1, }; return ((struct t) { 1, 2 }).b; }", "long f(void) { asm volatile (\"nop\" : \"=r\" (x)); return x; }", "int f(x_t *x) { return x->a(b)[1].c++; }",
    ],
    "cpp": [
        "int A::f(const std::vector<std::map<int, B>> &v) const noexcept { for (auto &x : v) { g(x); } return static_cast<int>(a) << 1; }", "A::A(int x) : b(x), c{1} { try { throw E(\"x\"); } catch (const std::exception &e) { } catch (...) { } }", "A::~A() { delete[] p; }",
        "template <typename T> T f(T &&a) { auto l = [&](int x) -> int { return x; }; if (auto p = g(); p != nullptr) return l(1); return T(a); }", "bool operator==(const A &a, const A &b) { return a.x == b.x && a < b; }", "int f(struct s *p) { struct t x = { .a = 1 }; int class_ = 0; return x.a; }",
        "void f() { std::unique_ptr<A> a(new A(1)); std::vector<int> v{1, 2}; v[\"a\"] = 1; }", "int f(int a) { int new = a; return new; }",
    ],
    "java": [
        "public static final int f(List<Map<String, int[]>> a, final long... b) throws IOException, X { for (int i = 0, j = 1; i < j; i++) { a[i] >>>= 2; } return a.b().c(x -> x + 1); }", "@Override protected <T extends A & B> T f() { try (R r = new R()) { } catch (A | B e) { throw e; } finally { } return (T) null; }",
        "int f(Object o) { if (!(o instanceof Foo)) { } switch (x) { case 1: break; default: g(); } do { i--; } while (i > 0); synchronized (this) { assert a >= 1 : \"x\"; } return new int[] { 1, 2 }.length; }", "Foo(int a) { super(a); this.a = a; }", "void f() { Runnable r = new Runnable() { public void run() { g(); } }; List<String> l = new ArrayList<>(); A::b; }".replace("A::b;", "l.forEach(A::b);"),
        "long f() { return s.filter(a -> a.b() > 1).map(A::c).get(0) ? x : y; }",
    ],
}
BAD = {
    "c": ["", "int f(void) {", "int f(void) { return 0; } int g(void) { }", "int f(void);", "return 0; }", "int f(void) { if (a { } }", "int f(void) { x = ; }", "int f(void) { char *s = \"abc }", "int f(void) { /* }", "<<<<<<< HEAD\nint f(void) { }", "public int f(int a) { return a; }", "int f(void) { return 0; }\n#!/bin/sh", "f: a.o\n\tcc -o f a.o", "{ \"a\": 1 }", "int f(void) { std::string s; }", "<html></html>", "int f(void) { a b c d; }"],
    "cpp": ["int A::f( {", "int f() { std::vector<int v; }", "public int f(int a) { return a; }", "int f() { return 0; } }", "void f() { [snip]"],
    "java": ["int f() { struct a *b; }", "int f();", "void f() { a.b(; }", "void f() { List<String l; }", "int f() { return 1; } int g() { return 2; }", "void f() { x -> ; }", "void f(", "#include <a>\nvoid f() { }", "void f() { }; "],
}


@pytest.mark.parametrize("lang", GOOD)
def test_grammars(lang):
    for s in GOOD[lang]:
        assert check(s, lang) == (None, -1), s
    for s in BAD[lang]:
        assert check(s, lang)[0], s


@pytest.mark.parametrize("lang", GOOD)
def test_truncation_is_found(lang):
    for s in GOOD[lang]:
        body = s.rstrip("; \n")
        for cut in (len(body) - 1, len(body) * 2 // 3, len(body) // 2):
            assert check(body[:cut], lang)[0], body[:cut]


def test_every_branch_is_parsed():
    head, tail = "int f(int a) {\n", "\n return a; }"
    two = head + "#ifdef X\n if (a) {\n#else\n%s\n#endif\n a++; }" + tail
    assert check(two % " if (!a) {", "c")[0] is None
    for bad in ("<<<<<<< HEAD\n if (!a) {", " if (!a {", ""):
        assert check(two % bad, "c")[0] == "token" and check(two % bad, "cpp")[0] == "token", bad
    three = head + "#if A > 1\n g(1);\n#elif A\n g(2);\n#else\n g(3%s\n#endif" + tail
    assert check(three % ");", "c")[0] is None and check(three % ";", "c")[0] == "token"
    assert check(three.replace("g(2)", "g(2") % ");", "c")[0] == "token"
    nested = head + "#ifdef X\n#else\n#ifdef X\n g(%s;\n#else\n g(2);\n#endif\n#endif" + tail
    assert check(nested % "1)", "c")[0] is None and check(nested % "1", "c")[0] == "token"
    # one macro has one value in a text, and a second branch may go with the second of another conditional
    assert check(head + "#ifdef X\n if (a) {\n#endif\n g();\n#if defined(X)\n }\n#endif" + tail, "c")[0] is None
    assert check(head + "#ifdef X\n if (a)\n#else\n {\n#endif\n g();\n#ifndef X\n }\n#endif" + tail, "c")[0] is None
    assert check(head + "#if A > 1\n {\n#else\n {{\n#endif\n g();\n#if B > 1\n }\n#else\n }}\n#endif" + tail, "c")[0] is None
    assert check(head + "#if 0\n any text\n#else\n g();\n#endif" + tail, "c")[0] is None
    # as many texts as the largest conditional has branches, not one for each combination
    assert check(head + "#ifdef X%d\n g();\n#else\n h();\n#endif\n" * 60 % (*range(60),) + tail, "c")[0] is None


def test_unmatched_conditionals():
    for s in ("#endif\nint f(void) { }", "int f(void) {\n#else\n}", "int f(void) {\n#elif X\n}", "int f(void) {\n#ifdef X\n}", "int f(void) {\n#if X\n#else\n#else\n#endif\n}"):
        assert check(s, "c")[0] in ("directive", "truncated"), s
    assert check("int f(void) { }\n#ifdef X", "c") == ("directive", 0)
    assert check("int f(void) {\n#ifdef X\n g();", "c")[0] == "truncated"


def test_error_place():
    assert check("int f(void) { x = ; }", "c") == ("token", 8)
    assert check("int f(void) { x = 1;", "c") == ("truncated", 10)


def test_long_and_deep_texts():
    assert check("int f(void) { " + "x = x + 1; " * 50_000 + "}", "c")[0] is None
    assert check("int f(void) { return " + "(" * 300 + "1" + ")" * 300 + "; }", "c")[0] is None
    assert check("int f(void) { return " + "(" * 300 + "1" + ")" * 299 + "; }", "c")[0] == "token"


def test_syntax_flags(spark):
    func = spark.createDataFrame([(1, 1, "A/B.git", "int f(void) { }"), (1, 2, "a/b", "int f(void) {"), (2, 3, None, "x"), (9, 4, "c", "int f(void) { }"), (1, 5, "a/b", None), (None, 6, "a/b", "")], "file_ordinal long, ordinal long, repo_name string, func_before string")
    files = spark.createDataFrame([(1, "a.C", "x/a.c"), (2, "b", "x/b"), (3, None, None)], "ordinal long, file_name string, file_path string")
    flags = syntax.func_flags(func, files)
    got = {r["func_ordinal"]: (r["language"], r["problem"], r["repository"]) for r in flags.collect()}
    assert got == {1: ("c", None, "a/b"), 2: ("c", "truncated", "a/b"), 3: (None, None, None), 4: (None, None, "c"), 6: (None, None, "a/b")}
    assert [(r["checked"], r["invalid"], r["invalid_rate"]) for r in syntax.rates(flags).collect()] == [(2, 1, 0.5)]
    assert {r["file_ordinal"]: (r["checked"], r["invalid"]) for r in syntax.file_flags(flags).collect()}[1] == (2, 1)
    assert syntax.func_flags(func.limit(0), files).count() == 0 and syntax.func_flags(func, files.limit(0)).where("problem IS NOT NULL").count() == 0


# Splits.


def test_split_keeps_ties(spark):
    rng = random.Random(2)
    rows = [(i, f"c{rng.randrange(400)}" if rng.random() < 0.95 else None, f"r{rng.randrange(600)}" if rng.random() < 0.5 else None, rng.choice(["x", "y", None])) for i in range(500)]
    rows += [(1000 + i, "hot", f"h{i % 7}", "x") for i in range(100)]
    df = spark.createDataFrame(rows, "i long, cve string, repo string, component string")
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    out = {r["id"]: (r["component"], r["split"]) for r in splitting.split(df, "i", ["cve", "repo"], "component", shares, chains=2, steps=4000).collect()}
    assert set(out) == {r[0] for r in rows}
    for k in (1, 2):
        seen = {}
        for r in rows:
            if r[k] is not None:
                assert seen.setdefault(r[k], out[r[0]]) == out[r[0]]
    n = Counter(s for _, s in out.values())
    largest = max(Counter(c for c, _ in out.values()).values())
    assert abs(n["train"] - 480) <= max(6, largest - 480) and n["test"] > 0
    again = {r["id"]: r["split"] for r in splitting.split(df.repartition(7), "i", ["cve", "repo"], "component", shares, chains=2, steps=4000).collect()}
    assert again == {i: s for i, (_, s) in out.items()}
    assert splitting.split(df.limit(0), "i", ["cve", "repo"], "component", shares).count() == 0


# Near-duplicates.


def brute_pairs(rows, k, th):
    sets = {}
    for o, t in rows:
        if t is not None:
            w = [x.lower() for x in re.findall(r"[A-Za-z0-9_]+", t)]
            sets[o] = (frozenset(zip(*[w[i:] for i in range(k)])), canonical(t))
    out = set()
    for (a, (s, x)), (b, (t, y)) in itertools.combinations(sorted(sets.items()), 2):
        if s and t and x != y and len(s & t) * 1000 >= th * 1000 * len(s | t) - 1e-6:
            out.add((a, b))
    return out


@pytest.mark.parametrize("bucket,levels,hot", [(500, 3, 100_000), (3, 2, 100_000), (2, 1, 100_000), (3, 2, 5), (4, 1, 3)])
def test_near_pairs_brute(spark, bucket, levels, hot):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(60)]
    rows, o = [], 0
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randrange(20, 90))]
        for _ in range(rng.randrange(1, 6)):
            t = list(base)
            for _ in range(rng.randrange(0, 6)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            o += 1
            rows.append((o, ("common header text here " if rng.random() < 0.7 else "") + " ".join(t)))
    rows += [(o + 1, None), (o + 2, ""), (o + 3, "a b"), (o + 4, rows[0][1].upper()), (o + 5, rows[0][1].replace(" ", ", ")), (o + 6, rows[0][1] + " é")]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "ordinal long, body string, path string, rid int")
    got = {(r["ordinal_a"], r["ordinal_b"]) for r in nearpairs.near_pairs(df, "ordinal", ["body"], 3, 0.6, bucket=bucket, levels=levels, hot_rows=hot).collect()}
    want = brute_pairs(rows, 3, 0.6)
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 60
    if bucket == 500:
        assert len(got) == len(want)
        assert nearpairs.near_pairs(df.limit(0), "ordinal", ["body"], 3, 0.6).count() == 0


def test_runs_reach_the_recall(spark):
    # a threshold pair, the smaller set within the larger, followed through the levels as the walk samples it
    rng = np.random.default_rng(8)
    big = np.unique(rng.integers(0, 2**63, 50, dtype=np.uint64))
    flat, sizes, doc = nearpairs._flat([big[: round(0.6 * len(big))], big])
    everything = nearpairs.Level(8, None, np.ones((2, nearpairs.COARSE), bool))
    for levels in (1, 2, 3):
        lost = 0
        for seed in rng.integers(0, 2**63, 1500, dtype=np.uint64):
            path, owner = nearpairs._walk(flat, sizes, doc, np.zeros(2, np.int64), 0.6, np.array([seed]), [everything] * (levels - 1))
            lost += not len(np.intersect1d(path[owner == 0], path[owner == 1]))
        assert lost / 1500 <= nearpairs.miss(levels) + 0.04, levels
        assert lost / 1500 >= nearpairs.miss(levels) - 0.06, levels
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "ordinal long, body string")
    for levels in (1, 2, 3):
        n = nearpairs.NearPairs(df, "ordinal", ["body"], 3, 0.6, levels=levels)
        assert len(n.seeds) == n.runs and nearpairs.miss(levels) ** n.runs <= 1e-4


def test_boilerplate_brings_no_sets_together(spark):
    """Half of every text is one frame: the rest behind the levels meets by rare tokens, so no bucket is large."""
    rng = random.Random(3)
    frame = " ".join(f"frame{i}" for i in range(60))
    rows = [(o, frame + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for o in range(600)]
    rows += [(1000 + o, t.replace("frame7 ", "x ")) for o, t in rows[:50]]
    df = spark.createDataFrame(rows, "ordinal long, body string")
    asked = []
    blocks = nearpairs.NearPairs._blocks
    nearpairs.NearPairs._blocks = lambda self, *a: asked.append(1) or blocks(self, *a)
    try:
        got = {(r["ordinal_a"], r["ordinal_b"]) for r in nearpairs.near_pairs(df, "ordinal", ["body"], 3, 0.6, bucket=20, levels=1, most_slots=1 << 16).collect()}
    finally:
        nearpairs.NearPairs._blocks = blocks
    assert got == {(o, 1000 + o) for o in range(50)} and not asked


def test_near_groups(spark):
    base = " ".join(f"w{i}" for i in range(60))
    texts = [base, base.upper(), base.replace("w30", "x"), base.replace("w30", "x").replace("w10", "y"), " ".join(f"q{i}" for i in range(30)), "too few", None]
    out = {r["ordinal"]: (r["group_id"], r["n_links"]) for r in nearpairs.near_groups(spark.createDataFrame(list(enumerate(texts)), "ordinal long, t string"), "ordinal", ["t"]).collect()}
    assert set(out) == {0, 1, 2, 3, 4} and out[0] == out[1] and len({out[i][0] for i in range(4)}) == 1 and out[4][0] != out[0][0]
    assert [out[i][1] for i in (0, 2, 3, 4)] == [1, 2, 1, 0]  # 50 of 66 runs are too few between the ends


def test_groups_of_short_texts(spark, tmp_path):
    from codequarry.llm import queries

    texts = ["too few", "TOO, few", "other few words", "", " ;", None, "a b c d e f"]
    spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "ordinal long, func string, func_before string").write.parquet(f"{tmp_path}/func.parquet")
    out = {r["ordinal"]: (r["group_id"], r["n_links"]) for r in queries.p6_groups(spark, str(tmp_path)).collect()}
    assert set(out) == {0, 1, 2, 3, 4, 6} and all(n == 0 for _, n in out.values())
    assert out[0] == out[1] and out[3] == out[4] and len({g for g, _ in out.values()}) == 4


def test_sketch_never_loses():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, 120, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(1, len(a))], rng.integers(0, 2**63, 60, dtype=np.uint64)]))
        flat, _, doc = nearpairs._flat([a, b])
        sk = nearpairs._sketches(flat, doc, 2).view(np.uint64)
        assert np.bitwise_count(sk[0] ^ sk[1]).sum() <= len(np.setxor1d(a, b))


# Capping.


@pytest.mark.parametrize("count", [1, 3, 10])
def test_cap_brute(spark, count):
    rng = random.Random(count)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, float("nan"), 0.5, 0.25, -1.0, 0.0, -0.0, rng.random()])) for i in rng.sample(range(-50, 400), 200)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "ordinal long, who string, q double, _n int, keep int")
    got = {r["ordinal"] for r in capping.cap(df, F.col("who"), F.col("q"), "ordinal", count=count).where("NOT keep").collect()}
    want = set()
    for who in "abc":
        mine = sorted((r for r in rows if r[1] == who), key=lambda r: (r[2] is None or math.isnan(r[2]), 0 if r[2] is None or math.isnan(r[2]) else -r[2] + 0.0, r[0]))
        want |= {r[0] for r in mine[count:]}
    assert got == want
    assert capping.cap(df.limit(0), F.col("who"), F.col("q"), "ordinal", share=0.1).count() == 0


def test_cap_without_broadcast(spark):
    df = spark.range(1, 301).select(F.col("id").alias("ordinal"), F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("who"), (F.col("id") % 7).cast("double").alias("q"))
    a = capping.cap(df, F.col("who"), F.col("q"), "ordinal", count=5).where("keep").select("ordinal").collect()
    b = capping.cap(df, F.col("who"), F.col("q"), "ordinal", count=5, most_broadcast=0).where("keep").select("ordinal").collect()
    assert sorted(a) == sorted(b) and len(a) == 10


def test_cap_share_is_exact(spark):
    df = spark.range(1, 201).select(F.col("id").alias("ordinal"), F.lit("a").alias("who"), F.lit(1.0).alias("q"))
    assert capping.cap(df, F.col("who"), F.col("q"), "ordinal", share=0.07).where("keep").count() == 14


# Packing.

WORDPUNCT = re.compile(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]+")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aZ9_ .,é— 　\x1f\n", max_size=30)), max_size=8))
def test_token_counts(texts):
    texts = [t if t is None else t.encode("utf-8", "replace").decode() for t in texts]
    want = [0 if t is None else len(WORDPUNCT.findall(t)) for t in texts]
    assert words.token_counts(pa.array(texts, pa.string())).tolist() == want
    assert words.token_counts(pa.array(["x y", *texts], pa.string()).slice(1)).tolist() == want


def test_pack(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 5, 60, 64, 65, 200, rng.randrange(1, 64), None])) for i in range(400)] + [(None, 5)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, size int, shard string, bin int")
    out = packing.pack(df, "id", "size", {"small": 64, "large": 1000}, most_items=20, shard=150).collect()
    for kind, cap in (("small", 64), ("large", 1000)):
        mine = [r for r in out if r["container"] == kind]
        per = {}
        for r in mine:
            per.setdefault(r["id"], []).append(r)
            assert r["tokens"] <= cap and r["first"] == r["piece"] * cap
        assert {i: sum(r["tokens"] for r in rs) for i, rs in per.items()} == {i: n for i, n in rows if i is not None and n is not None}
        assert all(len(rs) == rs[0]["pieces"] == max(1, -(-sum(r["tokens"] for r in rs) // cap)) for rs in per.values())
        bins = Counter()
        count = Counter()
        for r in mine:
            bins[r["shard"], r["bin"]] += r["tokens"]
            count[r["shard"], r["bin"]] += 1
        assert max(bins.values()) <= cap and max(count.values()) <= 20
    assert packing.pack(df.limit(0), "id", "size", {"s": 4}).count() == 0


def test_best_fit_constraints():
    sizes = np.array([6, 6, 4, 4, 2, 2, 2, 0, 0, 0])
    bins = packing.best_fit(sizes, 10, 3, 60.0)
    for b in set(bins):
        s = sizes[bins == b]
        assert s.sum() <= 10 and len(s) <= 3 and (s**2).sum() <= 60
    assert len(packing.best_fit(np.array([], int), 10, 3, 60.0)) == 0


def test_attention_closes_containers(spark, tmp_path):
    from codequarry.llm import queries

    sizes = {1: 86, 2: 14, 3: 60, 4: 40, 5: 97, 6: 250}
    spark.createDataFrame([(i, "w " * n) for i, n in sizes.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("container_tokens", "small", 100.0)], "setting string, item string, amount double").write.parquet(f"{tmp_path}/job_setting.parquet")
    bins = {}
    for r in queries.p8_pieces(spark, str(tmp_path)).collect():
        bins.setdefault((r["shard"], r["bin"]), []).append(r["tokens"])
    assert sorted(n for b in bins.values() for n in b) == [14, 40, 50, 60, 86, 97, 100, 100]
    assert [86] in bins.values() and [97] in bins.values()  # 14 more tokens would fit beside 86, their cost does not
    assert all(sum(b) <= 100 and (len(b) == 1 or sum(n * n for n in b) <= queries.ATTENTION * 100**2) for b in bins.values())
    assert any(len(b) > 1 for b in bins.values())


# Leaks.


def test_leaks_brute(spark):
    rng = random.Random(9)
    v = [f"{a}{b}" for a in "abcdef" for b in "ghij"]
    items = [(i, " ".join(rng.choice(v) for _ in range(rng.randrange(3, 25)))) for i in range(12)] + [(90, None), (91, ""), (92, "ab cd"), (None, "ag ah ai aj")]
    docs = []
    for d in range(150):
        t = [rng.choice(v) for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.5:
            p = rng.choice(items[:12])[1].split()
            t[3:3] = p[: rng.randrange(1, len(p) + 1)]
        docs.append((d, (", " if d % 3 else "\r\n1").join(t).upper() if d % 2 else " ".join(t)))
    docs += [(500, None), (501, ""), (None, docs[0][1])]
    df = spark.createDataFrame([(*r, "z") for r in docs], "doc_id long, text string, doc string")
    it = spark.createDataFrame(items, "item_id long, passage string")
    out = leaks.leaks(df, "doc_id", "text", it, "item_id", "passage").collect()
    grams = lambda t: {tuple(w[i : i + 4]) for w in [re.findall("[a-z]+", t.lower())] for i in range(len(w) - 3)}
    want = {}
    for d, t in docs:
        for i, p in items:
            if d is not None and t is not None and i is not None and p and (g := grams(p)):
                k = len(g & grams(t))
                if k >= 0.45 * len(g):
                    want[d, i] = (k, len(g))
    assert {(r["doc"], r["item_id"]): (r["matched"], r["runs"]) for r in out} == want and len(want) > 20
    text = {d: re.findall("[a-z]+", (t or "").lower()) for d, t in docs}
    passage = {i: re.findall("[a-z]+", (p or "").lower()) for i, p in items}
    for r in out:  # the longest match is one, and none is longer
        w, p, n = text[r["doc"]], passage[r["item_id"]], r["longest"]
        runs = lambda n, p=p: {tuple(p[i : i + n]) for i in range(len(p) - n + 1)}
        assert tuple(w[r["at_word"] : r["at_word"] + n]) in runs(n)
        assert not any(tuple(w[i : i + n + 1]) in runs(n + 1) for i in range(len(w) - n))
    assert leaks.without_leaks(df, "doc_id", leaks.leaks(df, "doc_id", "text", it, "item_id", "passage")).count() == len(docs) - len({d for d, _ in want})
    assert leaks.leaks(df.limit(0), "doc_id", "text", it, "item_id", "passage").count() == 0
    assert leaks.leaks(df, "doc_id", "text", it.limit(0), "item_id", "passage").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=30), max_size=6))
def test_suffix_array(texts):
    words, of, end = leaks.numbered([" ".join(t) for t in texts], {})
    order = leaks.suffix_array(words, end)
    suffix = lambda a: list(words[a : end[a]])
    assert sorted(order) == [i for i, w in enumerate(words) if w]
    assert all(suffix(a) < suffix(b) or (suffix(a) == suffix(b) and a < b) for a, b in zip(order, order[1:]))


def test_leaks_in_several_passes(spark):
    it = spark.createDataFrame([(i, f"w{c} x{c} y{c} z{c} v{c}".replace("0", "o")) for i, c in enumerate("abcdefgh")], "item_id long, passage string")
    docs = it.select(F.col("item_id").alias("doc_id"), F.col("passage").alias("text"))
    out = leaks.leaks(docs, "doc_id", "text", it, "item_id", "passage", pass_chars=30)
    assert {(r["doc"], r["item_id"]) for r in out.collect()} == {(i, i) for i in range(8)}
    assert all(Path(f.removeprefix("file://")).exists() for f in out.inputFiles())  # each group's result was written


# Repetition.


def brute_share(text, run=8):
    w = re.findall("[a-z]+", text.lower())
    seen, hit = set(), [False] * len(w)
    for i in range(len(w) - run + 1):
        g = tuple(w[i : i + run])
        if g in seen:
            hit[i : i + run] = [True] * run
        seen.add(g)
    return len(w), sum(hit)


def test_repetition_brute(spark):
    rng = random.Random(11)
    docs = [(0, None), (1, ""), (2, "1 2 3 !!"), (3, "x " * 50), (4, "a b c d e f g"), (5, "é — ünï" * 20)]
    for d in range(6, 120):
        s = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 60))]
        s += s[rng.randrange(len(s)) :] * rng.randrange(0, 4)
        docs.append((d, " ".join(s)))
    docs.append((200, "word " * 200_000))
    df = spark.createDataFrame([(*r, "en", 1.0) for r in docs], "doc_id long, text string, lang string, n_tokens double")
    got = {r["doc"]: r for r in repetition.measures(df, "doc_id", "text", ["lang"]).collect()}
    assert set(got) == {d for d, t in docs if t is not None}
    for d, t in docs:
        if t is not None:
            n, k = brute_share(t)
            assert (got[d]["n_words"], got[d]["n_repeated"]) == (n, k)
            assert got[d]["repeated_share"] == (k / n if n else None)
    assert got[1]["n_tokens"] == 0 and got[1]["chars_per_token"] is None and got[1]["token_entropy"] is None
    assert 0 <= got[3]["token_entropy"] < 0.5 and got[5]["byte_share"] >= 0
    assert repetition.measures(df.limit(0), "doc_id", "text").count() == 0
    for least in (0.05, 0.45, 0.9):  # the band loses no document
        out = {r["doc"]: r for r in repetition.repetitive(df, "doc_id", "text", least).collect()}
        assert set(out) == {d for d, t in docs if t and (b := brute_share(t))[0] and b[1] >= least * b[0]}
        assert all((r["n_words"], r["n_repeated"]) == brute_share(dict(docs)[d]) for d, r in out.items())
    assert repetition.repetitive(df.limit(0), "doc_id", "text").count() == 0


def bands_of(texts, least, run=8, size=3):
    """What in_bands gives for texts whose words are cut into tokens of `size` letters."""
    split = [re.findall("[a-z]+", t) for t in texts]
    pieces = {w: [w[j : j + size] for j in range(0, len(w), size)] for s in split for w in s}
    number, token = {w: i for i, w in enumerate(pieces)}, {x: i for i, x in enumerate({x: 0 for p in pieces.values() for x in p})}
    each, flat = [len(p) for p in pieces.values()], [token[x] for p in pieces.values() for x in p]
    return repetition.in_bands(*(np.array(x, np.int64) for x in ([number[w] for s in split for w in s], [len(s) for s in split], each, flat)), least, run)


@pytest.mark.parametrize("run", [1, 2, 3, 4, 5, 8, 16])
def test_bands_lose_none(run):
    rng = random.Random(run)
    texts = ["", "a", "a " * 9, "abc " * 17]
    for _ in range(400):
        s = [rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 60))]
        s += s[rng.randrange(len(s)) :] * rng.randrange(0, 4)
        for _ in range(rng.randrange(0, 4)):  # parts again, with other words between
            at = rng.randrange(len(s))
            s += [rng.choice("klmnop") * rng.randrange(1, 9) for _ in range(rng.randrange(3))] + s[at : at + rng.randrange(run, 2 * run + 1)]
        texts.append(" ".join(s))
    shares = [brute_share(t, run) for t in texts]
    for least in (0.05, 0.3, 0.45, 0.9, 1.0):
        true = {i for i, (n, k) in enumerate(shares) if n and k >= least * n}
        for size in (1, 2, 9):
            inside = {*bands_of(texts, least, run, size)[0].tolist()}
            assert true <= inside <= {i for i, (n, _) in enumerate(shares) if n}
        assert true or least > 0.9


def test_band_of_runs_rejects():
    """Few different words in ever new orders: the words' number and the single tokens' entropy let them pass, the runs' entropy does not."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 7) for _ in range(400)) for _ in range(50)]
    for t in texts:
        w = t.split()
        assert len(set(w)) <= 0.55 * len(w) and brute_share(t)[1] < 0.45 * len(w)
    assert len(bands_of(texts, 0.45)[0]) == 0
    again = [f"{t} {t}" for t in texts]
    rows, n_tokens, entropy = bands_of([*texts, *again], 0.45)
    assert rows.tolist() == [*range(50, 100)] and (n_tokens >= 800).all() and (entropy < 10).all()


def test_bands_reject(spark):
    rows = [(i, "plain words of a text number " + " ".join(chr(97 + (i * 7 + j) % 26) * 3 for j in range(20)), "en") for i in range(300)] + [(999, "一龥㐀䶿" * 40, "en"), (998, "text", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = repetition.measures(df, "doc_id", "text", ["lang"])
    out = {r["doc"]: r["odd"] for r in repetition.rejected(m, "lang", repetition.bands(m, "lang")).collect()}
    assert out[999] and len(out) == len(rows) and sum(out.values()) == 1
    alike = repetition.measures(df.where("doc_id < 998"), "doc_id", "text", ["lang"])
    assert not any(r["odd"] for r in repetition.rejected(alike, "lang", repetition.bands(alike, "lang")).collect())
    s = {r["doc"]: r["script"] for r in m.collect()}
    assert s[999] == "Han" and s[0] == "Latin"


def test_scripts(spark):
    texts = ["", "12 !", "abc", "Grüße ñandú", "слово и дело", "一龥㐀 x", "سلام", "ελλάδα", "ab一二", "ab一二三", "a" + "ж" * 3, "é", "٣٤", "abc ελλάδα", "日本語のテキスト", "x\U0002a6d6"]
    names = {"Latin": "IsLatin", "Cyrillic": "IsCyrillic", "Han": "IsHan", "Arabic": "IsArabic"}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    letters = lambda p: F.regexp_count("t", F.lit(p))
    for r in df.select("t", letters(r"\p{L}").alias("all"), *[letters(rf"[\p{{{p}}}&&\p{{L}}]").alias(n) for n, p in names.items()]).collect():
        best = max(names, key=lambda n: r[n])
        assert repetition.script(r["t"]) == ("None" if not r["all"] else best if 2 * r[best] >= r["all"] else "Other"), r["t"]
