"""Queries of the operators on training text and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.functions.names import repository
from codequarry.llm import capping, copies, leaks, nearpairs, packing, repetition, splitting, syntax
from codequarry.llm.words import with_token_counts
from codequarry.session import Scratch, table


#: Attention cost that a container may hold, as a share of that of one piece that fills it. At 1 the tokens always bind first.
ATTENTION = 0.75


def setting(spark: SparkSession, d: str, name: str) -> dict[str, float]:
    """A job setting's items; the table holds a few rows and does not grow."""
    return {r["item"]: r["amount"] for r in table(spark, d, "job_setting").where(F.col("setting") == name).collect()}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return copies.copy_groups(table(spark, d, "func"), "ordinal", ["func", "abstract_func_before"])[1].drop("digest")


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return copies.copy_groups(table(spark, d, "func"), "ordinal", ["func", "abstract_func_before"])[0]


def p3_flags(spark: SparkSession, d: str) -> DataFrame:
    return syntax.func_flags(table(spark, d, "func"), table(spark, d, "commit_file"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_flags(spark, d).where("problem IS NOT NULL").select("file_ordinal", "func_ordinal")


def p3_files(spark: SparkSession, d: str) -> DataFrame:
    return syntax.file_flags(p3_flags(spark, d))


def p3_rates(spark: SparkSession, d: str) -> DataFrame:
    return syntax.rates(p3_flags(spark, d))


def _tied(spark: SparkSession, d: str) -> DataFrame:
    """fix_commit rows with their CVE, repository and the CVE's severity."""
    cve = table(spark, d, "cve").select(F.col("ordinal").alias("cve_ordinal"), "cve_id", F.col("cvss_base_severity").alias("severity"))
    commits = table(spark, d, "fix_commit").select("ordinal", "cve_ordinal", repository(F.col("repo_name")).alias("repository"))
    return commits.join(cve, "cve_ordinal", "left").drop("cve_ordinal")


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    tied = _tied(spark, d)
    return tied, splitting.split(tied, "ordinal", ["cve_id", "repository"], "severity", dict(sorted(setting(spark, d, "split_share").items())))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """CVEs beside the smallest of the component with which the swap search moved them."""
    tied, out = _split(spark, d)
    # CVEs sort before repositories, so a component is named by its smallest CVE
    rows = tied.where("cve_id IS NOT NULL").join(out, F.col("ordinal") == F.col("id")).select(F.substring("component", 4, 1 << 30).alias("cve_id_a"), F.col("cve_id").alias("cve_id_b"))
    return rows.where("cve_id_a <> cve_id_b").distinct()


def p5_split(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d)[1].select(F.col("id").alias("commit_ordinal"), "split")


def p5_check(spark: SparkSession, d: str) -> DataFrame:
    """All records, those without a split, and the CVEs and repositories that lie in two splits: none. One row of each is joined."""
    tied, out = _split(spark, d)
    rows = Scratch(spark).save(tied.join(out, F.col("ordinal") == F.col("id"), "left"))
    cut = lambda k, name: rows.where(F.col(k).isNotNull()).groupBy(k).agg(F.count_distinct("split").alias("s")).agg(F.count_if(F.col("s") > 1).alias(name))
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("split").isNull()).alias("without")).join(cut("cve_id", "cut_cves")).join(cut("repository", "cut_repositories"))


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    return p5_split(spark, d).groupBy("split").agg(F.count(F.lit(1)).alias("n_commits"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nearpairs.near_pairs(table(spark, d, "func"), "ordinal", ["func", "func_before"], 3, 0.6)


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """Groups at the usual five words and 0.8."""
    return nearpairs.near_groups(table(spark, d, "func"), "ordinal", ["func", "func_before"], short=True)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    share = setting(spark, d, "repo_cap_share")["fix_commit"]
    kept = capping.cap(table(spark, d, "fix_commit"), repository(F.col("repo_name")), F.col("quality_score"), "ordinal", share=share)
    return kept.where("NOT keep").select(F.col("ordinal").alias("commit_ordinal"))


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return packing.pack(with_token_counts(docs, "doc_id", "text"), "doc_id", "n", dict(sorted(setting(spark, d, "container_tokens").items())), attention=ATTENTION, count=docs.count())


def p8_cuts(spark: SparkSession, d: str) -> DataFrame:
    """Where every document is cut."""
    return p8_pieces(spark, d).select(F.col("id").alias("doc_id"), "container", "piece", "pieces", "first", "tokens")


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    return packing.bin_checks(p8_pieces(spark, d), setting(spark, d, "container_tokens"), attention=ATTENTION)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_pieces(spark, d).where("pieces > 1 AND piece = 0").select(F.col("id").alias("doc_id"), "container")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    bins = p8_pieces(spark, d).groupBy("container", "shard", "bin").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    return bins.groupBy("container").agg(F.count(F.lit(1)).alias("bins"), F.sum("tokens").alias("tokens"), F.sum("pieces").alias("pieces"))


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "passage")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_leaks(spark, d).select(F.col("doc").alias("doc_id"), "item_id")


def p9_matched(spark: SparkSession, d: str) -> DataFrame:
    """How many of an item's distinct runs a document holds, and how many there are."""
    return p9_leaks(spark, d).select(F.col("doc").alias("doc_id"), "item_id", "matched", "runs")


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    return leaks.without_leaks(table(spark, d, "documents"), "doc_id", p9_leaks(spark, d)).select("doc_id")


def p10_measures(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("language", F.lower("lang"))
    return repetition.measures(docs, "doc_id", "text", ["language"]).withColumnRenamed("doc", "doc_id")


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    """The repeated letter words of each document."""
    return p10_measures(spark, d).select("doc_id", "n_words", "n_repeated")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetitive(table(spark, d, "documents"), "doc_id", "text", 0.45).select(F.col("doc").alias("doc_id"))


def p10_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Documents outside the fertility band of their script, or repetitive. The script is that of the text: lang is not always right."""
    measured = Scratch(spark).save(repetition.measures(table(spark, d, "documents"), "doc_id", "text"))
    out = repetition.rejected(measured, "script", repetition.bands(measured, "script"))
    return out.where("odd OR repetitive").select(F.col("doc").alias("doc_id"), "script", "odd", "repetitive")


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_groups, p3_found, p3_flags, p3_files, p3_rates, p5_found, p5_split, p5_shares, p5_check, p6_found, p6_groups, p7_found, p8_found, p8_pieces, p8_fill, p8_cuts, p8_check, p9_found, p9_leaks, p9_matched, p9_clean, p10_found, p10_measures, p10_shares, p10_rejected)}


#: Repository of a row, in SQL.
REPO = r"regexp_replace(lower(regexp_replace(repo_name, '^\s+|\s+$', '', 'g')), '\.git$', '')"


#: Letter words of a text, in SQL: other characters become blanks before the case is lowered.
WORDS = "list_filter(string_split(lower(regexp_replace({}, '[^A-Za-z]+', ' ', 'g')), ' '), lambda x: x <> '')"
TOKENS = r"len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s\x{00a0}\x{0085}\x{2000}-\x{200a}\x{3000}\x{202f}\x{2028}\x{2029}\x{205f}\x{1680}\x1c-\x1f\x0b]+'))"


def oracle_sql() -> dict[str, str]:
    grams = "SELECT {id}, unnest(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) AS g FROM (SELECT {id}, " + WORDS + " AS w FROM {t}) WHERE len(w) >= 4"
    return {
        "p8_found": f"""
            SELECT doc_id, item AS container FROM (SELECT doc_id, {TOKENS} AS n FROM documents WHERE text IS NOT NULL) d
            JOIN job_setting s ON s.setting = 'container_tokens' AND d.n > s.amount""",
        "p8_check": f"""
            SELECT item AS container, sum(n)::BIGINT AS tokens, sum(greatest(1, ceil(n / amount)))::BIGINT AS pieces, 0::BIGINT AS over_tokens, 0::BIGINT AS over_items, 0::BIGINT AS over_attention
            FROM (SELECT doc_id, {TOKENS} AS n FROM documents WHERE text IS NOT NULL) d JOIN job_setting s ON s.setting = 'container_tokens' GROUP BY 1""",
        "p5_check": "SELECT count(*) AS records, 0::BIGINT AS without, 0::BIGINT AS cut_cves, 0::BIGINT AS cut_repositories FROM fix_commit",
        "p8_cuts": f"""
            SELECT doc_id, item AS container, p::INTEGER AS piece, k::INTEGER AS pieces, (p * cap)::BIGINT AS first, least(cap, n - p * cap)::BIGINT AS tokens
            FROM (SELECT doc_id, item, n, amount::BIGINT AS cap, greatest(1, ceil(n / amount))::BIGINT AS k, unnest(range(greatest(1, ceil(n / amount))::BIGINT)) AS p
                FROM (SELECT doc_id, {TOKENS} AS n FROM documents WHERE text IS NOT NULL) d JOIN job_setting s ON s.setting = 'container_tokens')""",
        "p9_matched": f"""
            WITH d AS ({grams.format("text", id="doc_id", t="documents")}), e AS ({grams.format("passage", id="item_id", t="eval_item")}),
            n AS (SELECT item_id, count(*) AS n FROM e GROUP BY 1)
            SELECT doc_id, item_id, count(*)::INTEGER AS matched, n::INTEGER AS runs FROM d JOIN e USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id, n HAVING count(*) >= 0.45 * n""",
        "p10_shares": f"""
            WITH w AS (SELECT doc_id, {WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL),
            r AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
            g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ') ORDER BY i) > 1 AS again FROM r),
            c AS (SELECT doc_id, count(DISTINCT p) AS k FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM g WHERE again) GROUP BY 1)
            SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(k, 0)::BIGINT AS n_repeated FROM w LEFT JOIN c USING (doc_id)""",
        "p9_clean": f"""
            WITH d AS ({grams.format("text", id="doc_id", t="documents")}), e AS ({grams.format("passage", id="item_id", t="eval_item")}),
            n AS (SELECT item_id, count(*) AS n FROM e GROUP BY 1)
            SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM d JOIN e USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id, n HAVING count(*) >= 0.45 * n)""",
        "p9_found": f"""
            WITH d AS ({grams.format("text", id="doc_id", t="documents")}), e AS ({grams.format("passage", id="item_id", t="eval_item")}),
            n AS (SELECT item_id, count(*) AS n FROM e GROUP BY 1)
            SELECT doc_id, item_id FROM d JOIN e USING (g) JOIN n USING (item_id) GROUP BY 1, 2, n HAVING count(*) >= 0.45 * n""",
        "p10_found": f"""
            WITH w AS (SELECT doc_id, {WORDS.format("text")} AS w FROM documents),
            r AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
            g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ') ORDER BY i) > 1 AS again FROM r),
            c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM g WHERE again)
            SELECT doc_id FROM (SELECT doc_id, count(*) AS k FROM c GROUP BY 1) JOIN w USING (doc_id) WHERE k >= 0.45 * len(w)""",
        "p5_found": f"""
            WITH RECURSIVE t AS (SELECT DISTINCT cve_id, {REPO} AS repo FROM fix_commit JOIN cve ON cve.ordinal = cve_ordinal),
            near AS (SELECT DISTINCT a.cve_id AS x, b.cve_id AS y FROM t a JOIN t b ON a.repo = b.repo),
            reach AS (SELECT cve_id AS x, cve_id AS y FROM t UNION SELECT reach.x, near.y FROM reach JOIN near ON near.x = reach.y)
            SELECT min(y) AS cve_id_a, x AS cve_id_b FROM reach GROUP BY x HAVING min(y) <> x""",
        "p7_found": f"""
            WITH r AS (SELECT ordinal, {REPO} AS repo, row_number() OVER (PARTITION BY {REPO}
                         ORDER BY quality_score IS NULL OR isnan(quality_score), quality_score DESC, ordinal) AS rn FROM fix_commit)
            SELECT ordinal AS commit_ordinal FROM r WHERE repo IS NOT NULL AND rn > (SELECT ceil(amount::DECIMAL(9, 6) * (SELECT count(*) FROM fix_commit))
                FROM job_setting WHERE setting = 'repo_cap_share')""",
    }
