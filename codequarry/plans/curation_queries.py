"""Queries of the curation operators over the provided hierarchy, beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.functions import names, paths, text
from codequarry.operators import curation, statistics
from codequarry.operators.curation import Dataset
from codequarry.session import Scratch, table


def _kept(f, **kw):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return f(Dataset.load(spark, d), **kw).func.select("ordinal")

    return query


def _flat(spark: SparkSession, d: str) -> DataFrame:
    return curation.flatten(Dataset.load(spark, d))


def _dated(spark: SparkSession, d: str) -> DataFrame:
    y, m = text.year_month(F.col("publish_date"))
    return table(spark, d, "cve").withColumn("year", y).withColumn("month", m)


def flat_rows(spark, d):
    return _flat(spark, d).select("ordinal", "cve_id", "repo_name", "commit_hash", "file_path", "language", "func_name", "is_vul", "commit_date", "cvss_base_score", F.size("cwe_ids").alias("n_cwe"))


def simple_rows(spark, d):
    return curation.simple(_flat(spark, d)).select("ordinal", "cve_id", "repo_name", "git_url", "file_path", "func_name", "parameter_list_signature", "return_type", "is_vul")


def chain_counts(spark, d):
    """Counts of what the whole chain keeps."""
    return curation.counts(curation.run(Dataset.load(spark, d), save=Scratch(spark).save))


def multi_cve_cwes(spark, d):
    out = curation.merge_multi_cve_commits(Dataset.load(spark, d)).cve
    return out.select("ordinal", F.array_join(F.array_sort(F.array_distinct("cwe_ids")), ",").alias("cwes"))


def repo_types(spark, d):
    c = table(spark, d, "fix_commit").where("repo_name IS NOT NULL").select(paths.merged_repo(F.col("repo_name")).alias("repo"), paths.commit_language(F.col("raw_file_paths")).alias("kind"))
    return c.groupBy("repo").agg(F.when(F.count_distinct("kind") > 1, "mix").otherwise(F.min("kind")).alias("kind"))


def accepted_files(spark, d):
    c = table(spark, d, "fix_commit").select("ordinal", F.explode(paths.accepted_files(F.col("raw_file_paths"), [*paths.HEADER_FILES, *paths.C_FILES, *paths.CPP_FILES])).alias("path"))
    return c


def within_cve_dedup(spark, d):
    c = table(spark, d, "fix_commit").withColumn("_len", F.length(paths.merged_repo(F.coalesce("repo_name", F.lit("")))))
    best = c.groupBy("cve_ordinal", "commit_hash").agg(F.min(F.struct("_len", "ordinal")).alias("b")).select(F.col("b.ordinal").alias("ordinal"))
    return best


def function_matches(spark, d):
    """Before and after functions of each file, matched by name or name and signature."""
    f = table(spark, d, "func").where("is_vul")
    before = f.select("file_ordinal", "func_name", F.col("sig_before").alias("sig"), "ordinal", F.col("func_before").alias("body"))
    after = table(spark, d, "func").select("file_ordinal", "func_name", "sig", "ordinal", F.col("func").alias("body"))
    out = curation.match_functions(before, after, ["file_ordinal"], "func_name", "sig", "ordinal", "body")
    return out.select("file_ordinal", "key", "position", "is_vul")


def changed_line_counts(spark, d):
    return curation.changed_lines(table(spark, d, "func").where("is_vul")).select("ordinal", F.col("_changed").cast("int").alias("changed"))


def diff_counts(spark, d):
    """Lines that the diff of the texts before and after deletes and adds."""
    f = table(spark, d, "func").where("is_vul AND func_before IS NOT NULL")
    x = f.withColumn("d", text.diff(F.col("func_before"), F.col("func")))
    return x.select("ordinal", (F.size("d.deleted_lines")).alias("n_deleted"), F.size("d.added_lines").alias("n_added"))


def repo_metrics(spark, d):
    return statistics.repo_metrics(_flat(spark, d))


def top_repos(spark, d):
    return statistics.top(statistics.repo_metrics(_flat(spark, d)), "n_cve", 10, "repo_name")


def top_cwes(spark, d):
    return statistics.top(statistics.cwe_counts(table(spark, d, "cve")), "n", 20, "cwe")


def year_repo_matrix(spark, d):
    rows = _dated(spark, d).select(F.col("ordinal").alias("cve_ordinal"), "year").join(table(spark, d, "fix_commit").select("cve_ordinal", "repo_name"), "cve_ordinal")
    return statistics.long_matrix(rows, "year", "repo_name", 10, 2)


def year_repo_matrix_20(spark, d):
    rows = _dated(spark, d).select(F.col("ordinal").alias("cve_ordinal"), "year").join(table(spark, d, "fix_commit").select("cve_ordinal", "repo_name"), "cve_ordinal")
    return statistics.long_matrix(rows, "year", "repo_name", 10, 20)


def year_cwe_matrix(spark, d):
    rows = _dated(spark, d).select("year", F.explode("cwe_ids").alias("cwe")).where("cwe <> 'CWE-Other'")
    return statistics.long_matrix(rows, "year", "cwe", 10)


def severity_pivot(spark, d):
    return statistics.matrix(_dated(spark, d), "year", "cvss_base_severity", ["HIGH", "MEDIUM"])


def repo_cwe_stack(spark, d):
    rows = table(spark, d, "fix_commit").select("cve_ordinal", "repo_name").where("repo_name IS NOT NULL").join(table(spark, d, "cve").select(F.col("ordinal").alias("cve_ordinal"), F.explode("cwe_ids").alias("cwe")), "cve_ordinal")
    return statistics.stacked(rows, "repo_name", "cwe")


def cwe_top_repos(spark, d):
    rows = table(spark, d, "fix_commit").select("cve_ordinal", "repo_name").where("repo_name IS NOT NULL").join(table(spark, d, "cve").select(F.col("ordinal").alias("cve_ordinal"), F.explode("cwe_ids").alias("cwe")), "cve_ordinal")
    return statistics.top_within(rows, "cwe", "repo_name", 5)


def monthly_counts(spark, d):
    return statistics.by_year_month(_dated(spark, d), "year", "month")


def line_quantiles(spark, d):
    return statistics.quantiles(table(spark, d, "func").select(text.line_count(F.col("func")).alias("n")), "n")


def line_sigma(spark, d):
    return statistics.sigma_bounds(table(spark, d, "func").select(text.line_count(F.col("func")).alias("n")), "n", 2)


def line_sigma3(spark, d):
    return statistics.sigma_bounds(table(spark, d, "func").select(text.line_count(F.col("func")).alias("n")), "n", 3)


def line_describe(spark, d):
    return statistics.describe(table(spark, d, "func").select(text.line_count(F.col("func")).alias("n")), "n")


def lines_per_file(spark, d):
    return table(spark, d, "func").groupBy("file_ordinal").agg(F.sum(text.line_count(F.col("func"))).alias("n_lines"))


def memory_share(spark, d):
    return statistics.memory_share(table(spark, d, "cve"))


def dataset_totals(spark, d):
    return curation.totals(_flat(spark, d))


def graph_success(spark, d):
    """Share of functions with a graph, in percent, and of vulnerable ones with graphs on both sides."""
    f = table(spark, d, "func")
    both = F.col("graph_path").isNotNull() & F.col("graph_path_before").isNotNull()
    return f.agg((F.avg(F.col("graph_path").isNotNull().cast("int")) * 100).alias("percent"), (F.avg(F.when(F.col("is_vul"), both.cast("int"))) * 100).alias("percent_vul"))


def both_sides_graphs(spark, d):
    """Graph paths of vulnerable functions, kept only where both sides have one."""
    ok = F.col("graph_path").isNotNull() & F.col("graph_path_before").isNotNull()
    return table(spark, d, "func").where("is_vul").select("ordinal", F.when(ok, F.col("graph_path")).alias("graph_path"), F.when(ok, F.col("graph_path_before")).alias("graph_path_before"))


def hosts(spark, d):
    """Commits of each website, most first."""
    u = table(spark, d, "fix_commit").where("git_url IS NOT NULL").select(F.parse_url("git_url", F.lit("HOST")).alias("host"))
    return u.groupBy("host").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "host")


def single_repo_years(spark, d):
    rows = _dated(spark, d).select(F.col("ordinal").alias("cve_ordinal"), "cve_id", "year").join(table(spark, d, "fix_commit").where("repo_name = 'velmora/kernelweave'").select("cve_ordinal"), "cve_ordinal")
    return rows.groupBy("year").agg(F.count_distinct("cve_id").alias("n_cve"))


def repo_treemap(spark, d):
    c = table(spark, d, "fix_commit").where("repo_name IS NOT NULL").groupBy("repo_name").agg(F.count(F.lit(1)).alias("n"))
    return statistics.treemap(c, "n")


def merged_names(spark, d):
    return table(spark, d, "fix_commit").where("repo_name IS NOT NULL").select("ordinal", paths.merged_repo(F.col("repo_name")).alias("merged"), names.repository(F.col("repo_name")).alias("repository"))


def comment_free(spark, d):
    return table(spark, d, "func").select("ordinal", F.md5(text.without_comments(F.col("func"))).alias("digest"))


def file_names(spark, d):
    return table(spark, d, "commit_file").select("ordinal", paths.base_name(F.col("file_path")).alias("base"), names.extension(F.col("file_path")).alias("ext"), F.coalesce(paths.is_test_path(F.col("file_path")), F.lit(False)).alias("is_test"))


def both_sides_files(spark, d):
    before = table(spark, d, "fix_commit").select(F.col("ordinal").alias("commit_ordinal"), F.explode("raw_file_paths").alias("file_path"))
    return curation.both_sides(before, table(spark, d, "commit_file"), "commit_ordinal", "file_path")


def single_parents(spark, d):
    return curation.single_parent(table(spark, d, "fix_commit"), "commit_hash", "parent_commit_hash")


def sides_and_files(spark, d):
    return curation.sides_and_files(table(spark, d, "fix_commit"), "ordinal", "commit_hash", "parent_commit_hash", "raw_file_paths")


def all_parsed(spark, d):
    return curation.all_parsed(table(spark, d, "commit_file"), "commit_ordinal", "ordinal", table(spark, d, "func").where("func_name LIKE '%a%'"), "file_ordinal")


def commits_saying(spark, d):
    c = table(spark, d, "fix_commit")
    return curation.commits_saying(c, "commit_msg", "Fix").select("ordinal", F.lit("text").alias("how")).unionByName(curation.commits_saying(c, "commit_msg", r"over(flow|run)|\bnull\b", True).select("ordinal", F.lit("regex").alias("how")))


FILTERS = {
    "filter_test_files": _kept(curation.drop_test_files),
    "filter_large_changes": _kept(curation.drop_large_changes),
    "filter_multi_cve": _kept(curation.merge_multi_cve_commits),
    "filter_equal_commits": _kept(curation.drop_equal_commits),
    "filter_repeated_non_vul": _kept(curation.drop_repeated_non_vul),
    "filter_duplicate_non_vul": _kept(curation.drop_duplicate_non_vul),
    "filter_non_vul_seen_vul": _kept(curation.drop_non_vul_seen_vul),
    "filter_test_functions": _kept(curation.drop_test_functions),
    "filter_long_non_vul": _kept(curation.drop_long_non_vul, most_lines=30),
    "filter_long_non_vul_120": _kept(curation.drop_long_non_vul),
    "filter_long_vul_800": _kept(curation.drop_long_vul),
    "filter_long_vul": _kept(curation.drop_long_vul, most_lines=40),
    "filter_latest_non_vul": _kept(curation.keep_latest_non_vul),
}

QUERIES = [
    flat_rows, simple_rows, chain_counts, multi_cve_cwes, repo_types, accepted_files, within_cve_dedup, function_matches, changed_line_counts,
    diff_counts, repo_metrics, top_repos, top_cwes, year_repo_matrix, year_repo_matrix_20, year_cwe_matrix, severity_pivot, repo_cwe_stack, cwe_top_repos,
    monthly_counts, line_quantiles, line_sigma, line_sigma3, line_describe, lines_per_file, memory_share, dataset_totals, graph_success,
    both_sides_graphs, hosts, single_repo_years, repo_treemap, merged_names, comment_free, file_names,
    both_sides_files, single_parents, sides_and_files, all_parsed, commits_saying,
]


def queries() -> dict:
    return {f"curate_{f.__name__}": f for f in QUERIES} | FILTERS


ROWS = """rows AS (SELECT f.*, c.file_path, c.commit_ordinal, c.language, m.cve_ordinal, m.repo_name AS repo, m.commit_date, m.commit_hash AS hash
    FROM func f JOIN commit_file c ON c.ordinal = f.file_ordinal JOIN fix_commit m ON m.ordinal = c.commit_ordinal)"""
FLAT = """flat AS (SELECT f.ordinal, v.cve_id, m.repo_name, m.commit_hash, m.git_url, m.commit_date, c.file_path, c.language, f.func_name, f.sig, f.return_type, f.is_vul,
    v.cvss_base_score, v.cwe_ids FROM func f JOIN commit_file c ON c.ordinal = f.file_ordinal JOIN fix_commit m ON m.ordinal = c.commit_ordinal JOIN cve v ON v.ordinal = m.cve_ordinal)"""
LINES = "(length(func) - length(replace(func, chr(10), '')) + 1)"
PART = "lower(split_part(p, '.', 1))"
IS_TEST = f"""CASE WHEN lower(split_part(string_split(file_path, '/')[-1], '.', -1)) = 'java' THEN split_part(string_split(file_path, '/')[-1], '.', 1) LIKE '%Test'
    ELSE len(list_filter(string_split(file_path, '/'), lambda p: {PART} IN ('test', 'tests', 'testing', 'testsuite')
         OR ({PART} LIKE '%\\_%' ESCAPE '\\' AND {PART} LIKE '%test%') OR ({PART} LIKE '%-%' AND {PART} LIKE '%test%'))) > 0 END"""
TEST_FUNC = r"""(regexp_matches(split_part(func_name, '::', -1), '^(START_TEST|TEST|DEF_TEST|IN_PROC_BROWSER_TEST|BOOST_AUTO_TEST_CASE|DROGON_TEST|test|assert)')
    OR split_part(func_name, '::', -1) LIKE '%test')"""
DATED = "dated AS (SELECT *, year(publish_date::TIMESTAMP) AS year, month(publish_date::TIMESTAMP) AS month FROM cve)"
MERGED = """(CASE (CASE WHEN len(string_split(replace(repo_name, '.git', ''), '/')) = 2 AND split_part(replace(repo_name, '.git', ''), '/', 1) = split_part(replace(repo_name, '.git', ''), '/', 2)
    THEN split_part(replace(repo_name, '.git', ''), '/', 1) ELSE replace(repo_name, '.git', '') END)
    WHEN 'kernel/git/torvalds/linux' THEN 'torvalds/linux' WHEN 'kernel/git/stable/linux' THEN 'torvalds/linux' WHEN 'kernel/git/next/linux-next' THEN 'torvalds/linux' WHEN 'FFmpeg' THEN 'ffmpeg' ELSE (CASE WHEN len(string_split(replace(repo_name, '.git', ''), '/')) = 2 AND split_part(replace(repo_name, '.git', ''), '/', 1) = split_part(replace(repo_name, '.git', ''), '/', 2)
    THEN split_part(replace(repo_name, '.git', ''), '/', 1) ELSE replace(repo_name, '.git', '') END) END)"""


PROBES = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.96, 0.97, 0.98, 0.99]::DOUBLE[]"


def _vul_files(condition: str) -> str:
    """Functions left by a filter on functions, in files that keep a vulnerable one."""
    return f"""WITH {ROWS}, k AS (SELECT * FROM rows WHERE NOT coalesce({condition}, false))
        SELECT ordinal FROM k WHERE file_ordinal IN (SELECT file_ordinal FROM k WHERE is_vul)"""


#: Commits to drop as all equal, over tables {m}, {c} and {f}.
EQUAL = """WITH fv AS (SELECT file_ordinal, list(to_json([func_before, func]) ORDER BY ordinal) AS t, list(to_json([diff_line_info.deleted_lines, diff_line_info.added_lines]) ORDER BY ordinal) AS l FROM {f} WHERE is_vul GROUP BY 1),
    cv AS (SELECT commit_ordinal, list_sort(list_distinct(list(file_path))) AS p, list(struct_pack(t := coalesce(t, []), l := coalesce(l, [])) ORDER BY c.ordinal) AS x FROM {c} c LEFT JOIN fv ON fv.file_ordinal = c.ordinal GROUP BY 1),
    st AS (SELECT m.cve_ordinal, m.ordinal, commit_msg, p, x, lag(m.ordinal) OVER w AS po, lag(commit_msg) OVER w AS pm, lag(p) OVER w AS pp, lag(x) OVER w AS px FROM {m} m LEFT JOIN cv ON cv.commit_ordinal = m.ordinal WINDOW w AS (PARTITION BY m.cve_ordinal ORDER BY m.ordinal)),
    eq AS (SELECT *, po IS NULL OR coalesce(commit_msg = pm AND length(commit_msg) > 0, false) OR coalesce(p = pp, false)
        AND len(list_filter(range(1, least(len(x), len(px)) + 1), lambda i: NOT (len(x[i].t) = len(px[i].t) AND (x[i].t = px[i].t OR x[i].l = px[i].l)))) = 0 AS same FROM st),
    al AS (SELECT cve_ordinal, min(ordinal) AS first FROM eq GROUP BY 1 HAVING bool_and(same) AND count(*) > 1)
    SELECT ordinal FROM eq JOIN al USING (cve_ordinal) WHERE ordinal <> first"""


def _chain_sql() -> dict[str, str]:
    """The whole chain, a stage's tables of CVEs, commits, files and functions behind the other."""
    rows = "(SELECT f.*, c.file_path, c.commit_ordinal, c.language, m.cve_ordinal, m.repo_name AS repo, m.commit_date FROM {f} f JOIN {c} c ON c.ordinal = f.file_ordinal JOIN {m} m ON m.ordinal = c.commit_ordinal)"
    changed = "coalesce(len(diff_line_info.deleted_lines), 0) + coalesce(len(diff_line_info.added_lines), 0)"
    ctes: list[str] = []
    now = {"v": "cve", "m": "fix_commit", "c": "commit_file", "f": "func"}

    def step(**tables: str) -> None:
        k = len(ctes)
        for t, sql in tables.items():
            name = f"{t}{k}"
            ctes.append(f"{name} AS MATERIALIZED ({sql.format(**now)})")
            now[t] = name

    def down() -> None:
        step(m="SELECT * FROM {m} WHERE cve_ordinal IN (SELECT ordinal FROM {v})", c="SELECT * FROM {c} WHERE commit_ordinal IN (SELECT ordinal FROM {m})", f="SELECT * FROM {f} WHERE file_ordinal IN (SELECT ordinal FROM {c})")

    def local(condition: str) -> None:
        step(f=f"SELECT r.* EXCLUDE (file_path, commit_ordinal, language, cve_ordinal, repo, commit_date) FROM {rows} r WHERE NOT coalesce({condition}, false)")
        step(c="SELECT * FROM {c} WHERE ordinal IN (SELECT file_ordinal FROM {f} WHERE is_vul)")
        step(m="SELECT * FROM {m} WHERE ordinal IN (SELECT commit_ordinal FROM {c})", v="SELECT * FROM {v} WHERE ordinal IN (SELECT cve_ordinal FROM {m})", f="SELECT * FROM {f} WHERE file_ordinal IN (SELECT ordinal FROM {c})")

    step(c=f"SELECT * FROM {{c}} WHERE NOT coalesce({IS_TEST}, false)", f="SELECT * FROM {f} WHERE file_ordinal IN (SELECT ordinal FROM {c})", m="SELECT * FROM {m} WHERE ordinal IN (SELECT commit_ordinal FROM {c})", v="SELECT * FROM {v} WHERE ordinal IN (SELECT cve_ordinal FROM {m})")
    step(m=f"""SELECT * FROM {{m}} WHERE (cve_ordinal, coalesce(repo_name, chr(1))) NOT IN (SELECT (m.cve_ordinal, coalesce(m.repo_name, chr(1))) FROM {{m}} m
        LEFT JOIN (SELECT c.commit_ordinal, sum({changed}) AS n FROM {{f}} f JOIN {{c}} c ON c.ordinal = f.file_ordinal WHERE is_vul GROUP BY 1) s ON s.commit_ordinal = m.ordinal
        GROUP BY m.cve_ordinal, m.repo_name HAVING count(*) > 3 OR max(coalesce(n, 0)) > 110)""")
    down()
    step(m="SELECT * FROM {m} WHERE ordinal IN (SELECT arg_min(ordinal, (cve_ordinal, ordinal)) FROM {m} GROUP BY repo_name, commit_hash)", v="SELECT * FROM {v} WHERE ordinal IN (SELECT cve_ordinal FROM {m})")
    down()
    step(m=f"SELECT * FROM {{m}} WHERE ordinal NOT IN ({EQUAL})")
    down()
    spread = "(SELECT cve_ordinal, file_path, count(DISTINCT m.ordinal) AS k, min(m.ordinal) AS first FROM {c} c JOIN {m} m ON m.ordinal = c.commit_ordinal GROUP BY 1, 2 HAVING k > 1)"
    non = f"(SELECT r.ordinal, r.cve_ordinal, r.file_path, func_name, sig, commit_ordinal, k, first FROM {rows} r JOIN {spread} s USING (cve_ordinal, file_path) WHERE NOT is_vul)"
    step(f=f"""SELECT * FROM {{f}} WHERE ordinal NOT IN (SELECT unnest(list(ordinal) FILTER (WHERE commit_ordinal <> first)) FROM {non} GROUP BY cve_ordinal, file_path, func_name, sig HAVING count(DISTINCT commit_ordinal) = max(k))""")
    step(f=f"""SELECT * FROM {{f}} WHERE is_vul OR ordinal IN (SELECT min(ordinal) FROM {rows} WHERE NOT is_vul GROUP BY repo, file_path, func_name, sig, func)""")
    step(f=f"""SELECT r.* EXCLUDE (file_path, commit_ordinal, language, cve_ordinal, repo, commit_date) FROM {rows} r WHERE is_vul OR NOT EXISTS (SELECT 1 FROM {rows} v WHERE v.is_vul AND v.repo IS NOT DISTINCT FROM r.repo
        AND v.file_path IS NOT DISTINCT FROM r.file_path AND v.func_name IS NOT DISTINCT FROM r.func_name AND v.sig_before IS NOT DISTINCT FROM r.sig)""")
    local(f"({TEST_FUNC}) AND lower(coalesce(language, '')) <> 'java'")
    local(f"NOT is_vul AND {LINES} > 120")
    local(f"is_vul AND {LINES} > 800")
    counts = """SELECT (SELECT count(*) FROM {v}) AS n_cve, (SELECT count(*) FROM {m}) AS n_commit, (SELECT count(DISTINCT repo_name) FROM {m}) AS n_repo, (SELECT count(*) FROM {c}) AS n_file,
        (SELECT count(*) FROM {f} WHERE is_vul) AS n_vul, (SELECT count(*) FROM {f} WHERE NOT is_vul) AS n_non_vul""".format(**now)
    return {
        "filter_equal_commits": f"WITH {ROWS}, gone AS ({EQUAL.format(m='fix_commit', c='commit_file', f='func')}) SELECT ordinal FROM rows WHERE cve_ordinal IN (SELECT ordinal FROM cve) AND commit_ordinal NOT IN (SELECT ordinal FROM gone)",
        "curate_chain_counts": f"WITH {', '.join(ctes)} {counts}",
    }


def _kind(c: str, cpp: str) -> str:
    return f"CASE WHEN {cpp} AND NOT {c} THEN 'cpp' WHEN {c} AND NOT {cpp} THEN 'c' ELSE 'mix' END"


def oracle_sql() -> dict[str, str]:
    has = lambda exts: f"len(list_filter(raw_file_paths, lambda p: list_contains({exts!r}, lower(split_part(p, '.', -1))))) > 0"
    cwe_rows = "r AS (SELECT repo_name, unnest(cwe_ids) AS cwe FROM fix_commit m JOIN cve v ON v.ordinal = m.cve_ordinal WHERE repo_name IS NOT NULL)"
    out = {
        "filter_test_files": f"WITH {ROWS} SELECT ordinal FROM rows WHERE NOT coalesce({IS_TEST}, false)",
        "filter_large_changes": f"""WITH {ROWS}, s AS (SELECT commit_ordinal, sum(coalesce(len(diff_line_info.deleted_lines), 0) + coalesce(len(diff_line_info.added_lines), 0)) AS n FROM rows WHERE is_vul GROUP BY 1),
            b AS (SELECT cve_ordinal, repo_name FROM fix_commit m LEFT JOIN s ON s.commit_ordinal = m.ordinal GROUP BY 1, 2 HAVING count(*) > 3 OR max(coalesce(n, 0)) > 110)
            SELECT ordinal FROM rows r WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.cve_ordinal = r.cve_ordinal AND b.repo_name IS NOT DISTINCT FROM r.repo)""",
        "filter_multi_cve": f"""WITH {ROWS}, k AS (SELECT ordinal, row_number() OVER (PARTITION BY repo_name, commit_hash ORDER BY cve_ordinal, ordinal) AS rn FROM fix_commit)
            SELECT ordinal FROM rows WHERE commit_ordinal IN (SELECT ordinal FROM k WHERE rn = 1) AND cve_ordinal IN (SELECT ordinal FROM cve)""",
        "curate_multi_cve_cwes": """WITH g AS (SELECT repo_name, commit_hash, arg_min(cve_ordinal, (cve_ordinal, m.ordinal)) AS c, count(*) AS n, flatten(list(cwe_ids)) AS w
                FROM fix_commit m JOIN cve v ON v.ordinal = m.cve_ordinal GROUP BY 1, 2),
            u AS (SELECT c, flatten(list(w)) AS w FROM g WHERE n > 1 GROUP BY 1)
            SELECT ordinal, array_to_string(list_sort(list_distinct(coalesce(u.w, cwe_ids))), ',') AS cwes FROM cve LEFT JOIN u ON u.c = ordinal WHERE ordinal IN (SELECT c FROM g)""",
        "filter_repeated_non_vul": f"""WITH {ROWS}, s AS (SELECT cve_ordinal, file_path, count(DISTINCT m.ordinal) AS n, min(m.ordinal) AS first FROM commit_file c JOIN fix_commit m ON m.ordinal = c.commit_ordinal GROUP BY 1, 2 HAVING n > 1),
            e AS (SELECT r.cve_ordinal, r.file_path, func_name, sig FROM rows r JOIN s USING (cve_ordinal, file_path) WHERE NOT is_vul GROUP BY ALL HAVING count(DISTINCT commit_ordinal) = max(s.n))
            SELECT r.ordinal FROM rows r WHERE NOT EXISTS (SELECT 1 FROM e JOIN s USING (cve_ordinal, file_path) WHERE e.cve_ordinal = r.cve_ordinal AND e.file_path = r.file_path
                AND e.func_name IS NOT DISTINCT FROM r.func_name AND e.sig IS NOT DISTINCT FROM r.sig AND NOT r.is_vul AND r.commit_ordinal <> s.first)""",
        "filter_duplicate_non_vul": f"""WITH {ROWS}, k AS (SELECT ordinal, is_vul, row_number() OVER (PARTITION BY repo, file_path, func_name, sig, func, is_vul ORDER BY ordinal) AS rn FROM rows)
            SELECT ordinal FROM k WHERE is_vul OR rn = 1""",
        "filter_non_vul_seen_vul": f"""WITH {ROWS} SELECT ordinal FROM rows r WHERE is_vul OR NOT EXISTS (SELECT 1 FROM rows v WHERE v.is_vul AND v.repo IS NOT DISTINCT FROM r.repo
            AND v.file_path IS NOT DISTINCT FROM r.file_path AND v.func_name IS NOT DISTINCT FROM r.func_name AND v.sig_before IS NOT DISTINCT FROM r.sig)""",
        "filter_test_functions": _vul_files(f"({TEST_FUNC}) AND lower(coalesce(language, '')) <> 'java'"),
        "filter_long_non_vul": _vul_files(f"NOT is_vul AND {LINES} > 30"),
        "filter_long_non_vul_120": _vul_files(f"NOT is_vul AND {LINES} > 120"),
        "filter_long_vul_800": _vul_files(f"is_vul AND {LINES} > 800"),
        "curate_year_repo_matrix_20": f"""WITH {DATED}, r AS (SELECT d.year, m.repo_name FROM dated d JOIN fix_commit m ON m.cve_ordinal = d.ordinal WHERE d.year IS NOT NULL AND repo_name IS NOT NULL),
            t AS (SELECT repo_name FROM r GROUP BY 1 ORDER BY count(*) DESC, repo_name LIMIT 10),
            l AS (SELECT year, CASE WHEN repo_name IN (SELECT * FROM t) THEN repo_name ELSE 'Other' END AS label, count(*) AS n FROM r GROUP BY 1, 2)
            SELECT * FROM l WHERE year IN (SELECT year FROM l GROUP BY 1 HAVING sum(n) > 20)""",
        "filter_long_vul": _vul_files(f"is_vul AND {LINES} > 40"),
        "filter_latest_non_vul": f"""WITH {ROWS}, k AS (SELECT ordinal, is_vul, commit_date, max(commit_date) OVER (PARTITION BY repo, file_path) AS m FROM rows)
            SELECT ordinal FROM k WHERE is_vul OR commit_date = m""",
        "curate_flat_rows": f"WITH {FLAT} SELECT ordinal, cve_id, repo_name, commit_hash, file_path, language, func_name, is_vul, commit_date, cvss_base_score, len(cwe_ids)::INTEGER AS n_cwe FROM flat",
        "curate_simple_rows": f"WITH {FLAT} SELECT ordinal, cve_id, repo_name, git_url, file_path, func_name, sig AS parameter_list_signature, return_type, is_vul FROM flat",
        "curate_repo_types": f"""SELECT {MERGED} AS repo, CASE WHEN count(DISTINCT k) > 1 THEN 'mix' ELSE min(k) END AS kind
            FROM (SELECT *, {_kind(has(['c']), has(['cc', 'cpp', 'cxx', 'hpp', 'hxx', 'hh']))} AS k FROM fix_commit WHERE repo_name IS NOT NULL) GROUP BY 1""",
        "curate_accepted_files": """SELECT ordinal, path FROM (SELECT ordinal, unnest(raw_file_paths) AS path FROM fix_commit WHERE len(raw_file_paths) <= 50)
            WHERE contains(split_part(path, '/', -1), '.') AND split_part(path, '.', -1) IN ('h', 'c', 'cc', 'cpp', 'cxx', 'hpp', 'hxx', 'hh')""",
        "curate_within_cve_dedup": f"""SELECT arg_min(ordinal, (length({MERGED.replace("repo_name", "r")}), ordinal)) AS ordinal FROM (SELECT *, coalesce(repo_name, '') AS r FROM fix_commit) GROUP BY cve_ordinal, commit_hash""",
        "curate_function_matches": """WITH b AS (SELECT file_ordinal, func_name, sig_before AS sig, ordinal, func_before AS body FROM func WHERE is_vul),
            a AS (SELECT file_ordinal, func_name, sig, ordinal, func AS body FROM func),
            kb AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY file_ordinal, func_name) = 1 THEN func_name ELSE func_name || '$$$' || coalesce(sig, '') END AS key FROM b),
            ka AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY file_ordinal, func_name) = 1 THEN func_name ELSE func_name || '$$$' || coalesce(sig, '') END AS key FROM a),
            lb AS (SELECT *, row_number() OVER (PARTITION BY file_ordinal, key ORDER BY ordinal DESC) AS rn FROM kb), la AS (SELECT *, row_number() OVER (PARTITION BY file_ordinal, key ORDER BY ordinal DESC) AS rn FROM ka)
            SELECT file_ordinal, key, la.ordinal AS position, lb.body IS DISTINCT FROM la.body AS is_vul FROM lb JOIN la USING (file_ordinal, key) WHERE lb.rn = 1 AND la.rn = 1""",
        "curate_changed_line_counts": "SELECT ordinal, (coalesce(len(diff_line_info.deleted_lines), 0) + coalesce(len(diff_line_info.added_lines), 0))::INTEGER AS changed FROM func WHERE is_vul",
        "curate_repo_metrics": f"WITH {FLAT} SELECT repo_name, count(DISTINCT cve_id) AS n_cve, count(DISTINCT commit_hash) AS n_commit, count(*) FILTER (WHERE is_vul) AS n_vul, count(*) FILTER (WHERE NOT is_vul) AS n_non_vul FROM flat GROUP BY 1",
        "curate_top_repos": f"WITH {FLAT} SELECT repo_name, count(DISTINCT cve_id) AS n_cve, count(DISTINCT commit_hash) AS n_commit, count(*) FILTER (WHERE is_vul) AS n_vul, count(*) FILTER (WHERE NOT is_vul) AS n_non_vul FROM flat GROUP BY 1 ORDER BY n_cve DESC, repo_name NULLS LAST LIMIT 10",
        "curate_top_cwes": "SELECT cwe, count(*) AS n FROM (SELECT unnest(list_distinct(cwe_ids)) AS cwe FROM cve) GROUP BY 1 ORDER BY n DESC, cwe LIMIT 20",
        "curate_year_repo_matrix": f"""WITH {DATED}, r AS (SELECT d.year, m.repo_name FROM dated d JOIN fix_commit m ON m.cve_ordinal = d.ordinal WHERE d.year IS NOT NULL AND repo_name IS NOT NULL),
            t AS (SELECT repo_name FROM r GROUP BY 1 ORDER BY count(*) DESC, repo_name LIMIT 10),
            l AS (SELECT year, CASE WHEN repo_name IN (SELECT * FROM t) THEN repo_name ELSE 'Other' END AS label, count(*) AS n FROM r GROUP BY 1, 2)
            SELECT * FROM l WHERE year IN (SELECT year FROM l GROUP BY 1 HAVING sum(n) > 2)""",
        "curate_year_cwe_matrix": f"""WITH {DATED}, r AS (SELECT year, c FROM (SELECT year, unnest(cwe_ids) AS c FROM dated) WHERE c <> 'CWE-Other' AND year IS NOT NULL),
            t AS (SELECT c FROM r GROUP BY 1 ORDER BY count(*) DESC, c LIMIT 10)
            SELECT year, CASE WHEN c IN (SELECT * FROM t) THEN c ELSE 'Other' END AS label, count(*) AS n FROM r GROUP BY 1, 2""",
        "curate_severity_pivot": f"""WITH {DATED} SELECT year, count(*) FILTER (WHERE cvss_base_severity = 'HIGH') AS HIGH, count(*) FILTER (WHERE cvss_base_severity = 'MEDIUM') AS MEDIUM,
            count(*) FILTER (WHERE cvss_base_severity IS NULL OR cvss_base_severity NOT IN ('HIGH', 'MEDIUM')) AS Other FROM dated WHERE year IS NOT NULL GROUP BY 1""",
        "curate_repo_cwe_stack": f"""WITH {cwe_rows}, c AS (SELECT repo_name, cwe, count(*) AS n FROM r GROUP BY 1, 2)
            SELECT repo_name, cwe, n, coalesce(sum(n) OVER (PARTITION BY repo_name ORDER BY cwe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM c""",
        "curate_cwe_top_repos": f"""WITH {cwe_rows}, c AS (SELECT cwe, repo_name, count(*) AS n FROM r GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY cwe ORDER BY n DESC, repo_name) AS rn FROM c)
            SELECT cwe, CASE WHEN rn <= 5 THEN repo_name ELSE 'Other' END AS repo_name, sum(n)::BIGINT AS n FROM k GROUP BY 1, 2""",
        "curate_monthly_counts": f"WITH {DATED} SELECT year, month, count(*) AS n FROM dated WHERE year IS NOT NULL GROUP BY ROLLUP (year, month)",
        "curate_line_quantiles": f"""SELECT p AS probe, (SELECT quantile_cont({LINES}, {PROBES}) FROM func)[i] AS value FROM (SELECT unnest({PROBES}) AS p, unnest(range(1, 15)) AS i)""",
        "curate_line_sigma": f"SELECT trunc(avg(n) - 2 * stddev_samp(n))::BIGINT AS lower, trunc(avg(n) + 2 * stddev_samp(n))::BIGINT AS upper FROM (SELECT {LINES} AS n FROM func)",
        "curate_line_sigma3": f"SELECT trunc(avg(n) - 3 * stddev_samp(n))::BIGINT AS lower, trunc(avg(n) + 3 * stddev_samp(n))::BIGINT AS upper FROM (SELECT {LINES} AS n FROM func)",
        "curate_line_describe": f"""SELECT count(n) AS count, avg(n) AS mean, stddev_samp(n) AS std, min(n)::INTEGER AS min, quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.5) AS q50, quantile_cont(n, 0.75) AS q75, max(n)::INTEGER AS max FROM (SELECT {LINES} AS n FROM func)""",
        "curate_lines_per_file": f"SELECT file_ordinal, sum({LINES})::BIGINT AS n_lines FROM func GROUP BY 1",
        "curate_memory_share": """SELECT count(*) FILTER (WHERE c IN ('CWE-20', 'CWE-119', 'CWE-125', 'CWE-190', 'CWE-416', 'CWE-476', 'CWE-787')) AS n_memory, count(*) AS n, n_memory / n AS share
            FROM (SELECT unnest(cwe_ids) AS c FROM cve)""",
        "curate_dataset_totals": f"""WITH {FLAT} SELECT count(DISTINCT repo_name) AS n_repo, count(DISTINCT cve_id) AS n_cve, count(DISTINCT (repo_name, commit_hash)) FILTER (WHERE repo_name IS NOT NULL) AS n_commit,
            count(*) FILTER (WHERE is_vul) AS n_vul, count(*) FILTER (WHERE NOT is_vul) AS n_non_vul, (SELECT count(DISTINCT c) FROM (SELECT unnest(cwe_ids) AS c FROM flat)) AS n_cwe FROM flat""",
        "curate_graph_success": "SELECT avg((graph_path IS NOT NULL)::INT) * 100 AS percent, avg(CASE WHEN is_vul THEN (graph_path IS NOT NULL AND graph_path_before IS NOT NULL)::INT END) * 100 AS percent_vul FROM func",
        "curate_both_sides_graphs": "SELECT ordinal, CASE WHEN graph_path_before IS NOT NULL THEN graph_path END AS graph_path, CASE WHEN graph_path IS NOT NULL THEN graph_path_before END AS graph_path_before FROM func WHERE is_vul",
        "curate_hosts": "SELECT regexp_extract(git_url, '://([^/]+)', 1) AS host, count(*) AS n FROM fix_commit WHERE git_url IS NOT NULL GROUP BY 1",
        "curate_single_repo_years": f"WITH {DATED} SELECT year, count(DISTINCT cve_id) AS n_cve FROM dated JOIN fix_commit m ON m.cve_ordinal = dated.ordinal WHERE repo_name = 'velmora/kernelweave' GROUP BY 1",
        "curate_repo_treemap": "SELECT repo_name, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM fix_commit WHERE repo_name IS NOT NULL), 4) AS percent FROM fix_commit WHERE repo_name IS NOT NULL GROUP BY 1",
        "curate_merged_names": rf"SELECT ordinal, {MERGED} AS merged, regexp_replace(lower(regexp_replace(repo_name, '^\s+|\s+$', '', 'g')), '\.git$', '') AS repository FROM fix_commit WHERE repo_name IS NOT NULL",
        "curate_file_names": f"SELECT ordinal, split_part(file_path, '/', -1) AS base, lower(regexp_extract(file_path, '\\.([^./]+)$', 1)) AS ext, coalesce({IS_TEST}, false) AS is_test FROM commit_file",
        "curate_comment_free": r"""SELECT ordinal, md5(regexp_replace(func, '("(?:\\.|[^"\\])*"|''(?:\\.|[^''\\])*'')|/\*(?:[^*]|\*+[^*/])*\*+/|//[^\n]*', '\1', 'g')) AS digest FROM func""",
    }
    out |= {
        "curate_both_sides_files": "SELECT DISTINCT r.ordinal AS commit_ordinal, r.p AS file_path FROM (SELECT ordinal, unnest(raw_file_paths) AS p FROM fix_commit) r JOIN commit_file c ON c.commit_ordinal = r.ordinal AND c.file_path = r.p",
        "curate_single_parents": "SELECT commit_hash, min(parent_commit_hash) AS parent_commit_hash FROM fix_commit GROUP BY 1 HAVING count(DISTINCT parent_commit_hash) = 1",
        "curate_sides_and_files": """SELECT * FROM (SELECT ordinal, 'before' AS side, parent_commit_hash AS hash, unnest(raw_file_paths) AS path FROM fix_commit UNION ALL SELECT ordinal, 'after', commit_hash, unnest(raw_file_paths) FROM fix_commit)
            WHERE hash IS NOT NULL AND path IS NOT NULL""",
        "curate_all_parsed": "SELECT DISTINCT commit_ordinal FROM commit_file c WHERE NOT EXISTS (SELECT 1 FROM commit_file x WHERE x.commit_ordinal = c.commit_ordinal AND x.ordinal NOT IN (SELECT file_ordinal FROM func WHERE func_name LIKE '%a%'))",
        "curate_commits_saying": r"SELECT ordinal, 'text' AS how FROM fix_commit WHERE contains(lower(commit_msg), 'fix') UNION ALL SELECT ordinal, 'regex' FROM fix_commit WHERE regexp_matches(lower(commit_msg), 'over(flow|run)|\bnull\b')",
    }
    out |= _chain_sql()
    return out
