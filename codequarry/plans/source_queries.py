"""Queries of sources and sinks, as round trips over the provided tables, beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.functions import text
from codequarry.graph import exports
from codequarry.graph.model import Graph
from codequarry.plans import step_queries
from codequarry.session import Scratch, table
from codequarry.sources import records


def source_json_list(spark: SparkSession, d: str) -> DataFrame:
    """CVEs written as files of one JSON list of a hundred records each and read again with their types."""
    path = f"{Scratch(spark).root}/lists"
    c = table(spark, d, "cve").select((F.col("ordinal") / 100).cast("int").alias("k"), F.struct("ordinal", "cve_id", "cwe_ids", "cvss_base_score").alias("r"))
    lists = c.groupBy("k").agg(F.to_json(F.collect_list("r")).alias("value")).repartition("k")
    lists.write.partitionBy("k").text(path)
    out = records.read_json_list(spark, path, "ordinal long, cve_id string, cwe_ids array<string>, cvss_base_score double")
    return out.select("ordinal", "cve_id", F.coalesce(F.size("cwe_ids"), F.lit(0)).alias("n_cwe"), "cvss_base_score")


def source_json_kept(spark: SparkSession, d: str) -> DataFrame:
    """What was written first stays where a sink is not told to overwrite; what it is told to is replaced."""
    root, c = Scratch(spark).root, table(spark, d, "fix_commit").select("ordinal", "commit_hash")
    for name, overwrite in (("kept", False), ("replaced", True)):
        records.write_json(c.where("ordinal % 2 = 0"), f"{root}/{name}")
        records.write_json(c.where("ordinal % 2 = 1"), f"{root}/{name}", overwrite)
    read = lambda name: spark.read.schema("ordinal long, commit_hash string").json(f"{root}/{name}").withColumn("name", F.lit(name))
    return read("kept").unionByName(read("replaced"))


def source_lines(spark: SparkSession, d: str) -> DataFrame:
    path = f"{Scratch(spark).root}/lines"
    f = table(spark, d, "commit_file").select(F.when(F.col("ordinal") % 5 == 0, "").otherwise(F.concat("file_path", F.lit("  "))).alias("line"))
    records.write_text(f, "line", path)
    return records.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def source_changelog(spark: SparkSession, d: str) -> DataFrame:
    path = f"{Scratch(spark).root}/log"
    line = F.concat("commit_hash", F.lit("||||||||||"), F.regexp_replace("commit_msg", r"\s+", " "))
    c = table(spark, d, "fix_commit").where("commit_hash IS NOT NULL AND trim(commit_msg) <> ''").select("ordinal", line.alias("line")).orderBy("ordinal").coalesce(1)  # a log is one file
    records.write_text(c, "line", path)
    return records.read_changelog(spark, path)


def source_incomplete_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of fifty records of which some records are missing."""
    c = table(spark, d, "cve")
    total = c.count()
    pages = c.where("ordinal % 77 <> 0").groupBy(((F.col("ordinal") - 1) / 50).cast("int").alias("page")).agg(F.collect_list("cve_id").alias("records"))
    return records.incomplete_pages(pages, "page", "records", total, 50)


def source_page_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cve").select("ordinal", records.page_url("https://x/cves/2.0", F.col("ordinal"), 2000).alias("url"))


def source_layout(spark: SparkSession, d: str) -> DataFrame:
    """Where the text of each function is laid out."""
    f = table(spark, d, "func").where("repo_name IS NOT NULL AND commit_hash IS NOT NULL")
    return f.select("ordinal", records.source_path(F.col("repo_name"), F.col("commit_hash"), F.when(F.col("is_vul"), "vul").otherwise("non_vul"), F.col("ordinal"), F.lit("c")).alias("path"))


def source_decoded(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.md5(text.decode_bytes(F.encode("text", "UTF-8"))).alias("digest"))


def source_graph_tables(spark: SparkSession, d: str) -> DataFrame:
    """Graphs saved as node and edge tables and read again."""
    path = f"{Scratch(spark).root}/graphs"
    records.save_graph(step_queries.built(spark, d), path)
    g = records.load_graph(spark, path)
    count = lambda df, by: df.groupBy(F.col(by).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum("graph_id").alias("graphs"))
    return count(g.nodes, "label").unionByName(count(g.edges, "etype"))


def source_graph_records(spark: SparkSession, d: str) -> DataFrame:
    """Graphs written in the exchange form and read again."""
    raw = exports.record_json(step_queries.built(spark, d)).select(F.col("graph_id").alias("record_id"), "payload", F.lit("graph").alias("kind"))
    g = Graph.from_records(raw)
    n = g.nodes.select("graph_id", "id", "label", "name", "order", "line_number")
    e = g.edges.groupBy("graph_id", F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n_out"), F.sum("dst").alias("to"))
    return n.join(e, ["graph_id", "id"], "left")


def source_methods_apart(spark: SparkSession, d: str) -> DataFrame:
    """Edges whose two ends lie in one method."""
    return exports.split_by_method(step_queries.built(spark, d))[1].select("graph_id", "method", "src", "dst", "etype")


def queries() -> dict:
    return {f.__name__: f for f in (source_json_list, source_json_kept, source_lines, source_changelog, source_incomplete_pages, source_page_urls, source_layout, source_decoded, source_graph_tables, source_graph_records, source_methods_apart)}


def oracle_sql() -> dict[str, str]:
    graph = f"WITH RECURSIVE {step_queries._GRAPH_SQL}"
    return {
        "source_json_list": "SELECT ordinal, cve_id, coalesce(len(cwe_ids), 0)::INTEGER AS n_cwe, cvss_base_score FROM cve",
        "source_json_kept": "SELECT ordinal, commit_hash, CASE WHEN ordinal % 2 = 0 THEN 'kept' ELSE 'replaced' END AS name FROM fix_commit",
        "source_lines": "SELECT rtrim(file_path) AS value, count(*) AS n FROM commit_file WHERE ordinal % 5 <> 0 AND rtrim(file_path) <> '' GROUP BY 1",
        "source_changelog": r"SELECT message, arg_max(commit_hash, ordinal) AS hash FROM (SELECT trim(regexp_replace(commit_msg, '\s+', ' ', 'g')) AS message, commit_hash, ordinal FROM fix_commit WHERE commit_hash IS NOT NULL AND trim(commit_msg) <> '') GROUP BY 1",
        "source_incomplete_pages": """SELECT p::INTEGER AS page, n::INTEGER AS n, want::INTEGER AS want FROM (SELECT p, (SELECT count(*) FROM cve WHERE (ordinal - 1) // 50 = p AND ordinal % 77 <> 0) AS n,
            least(50, (SELECT count(*) FROM cve) - 50 * p) AS want FROM range(((SELECT count(*) FROM cve) + 49) // 50) t(p)) WHERE n <> want""",
        "source_page_urls": "SELECT ordinal, 'https://x/cves/2.0?resultsPerPage=2000&startIndex=' || ordinal * 2000 AS url FROM cve",
        "source_layout": "SELECT ordinal, repo_name || '/' || substring(commit_hash, 1, 12) || '/' || CASE WHEN is_vul THEN 'vul' ELSE 'non_vul' END || '/' || ordinal || '.c' AS path FROM func WHERE repo_name IS NOT NULL AND commit_hash IS NOT NULL",
        "source_decoded": "SELECT doc_id, md5(text) AS digest FROM documents WHERE text IS NOT NULL",
        "source_graph_tables": f"{graph} SELECT label AS kind, count(*) AS n, sum(graph_id)::BIGINT AS graphs FROM n GROUP BY 1 UNION ALL SELECT etype, count(*), sum(graph_id)::BIGINT FROM e GROUP BY 1",
        "source_graph_records": f'{graph} SELECT n.graph_id, n.id, n.label, n.name, n."order", n.line_number, x.n_out, x."to" FROM n LEFT JOIN (SELECT graph_id, src AS id, count(*) AS n_out, sum(dst)::BIGINT AS "to" FROM e GROUP BY 1, 2) x ON x.graph_id = n.graph_id AND x.id = n.id',
        "source_methods_apart": f"""{graph}, ow AS (SELECT e.graph_id, e.src AS m, e.dst AS id FROM e JOIN n ON n.graph_id = e.graph_id AND n.id = e.src AND n.label = 'METHOD' WHERE etype = 'CONTAINS' UNION ALL SELECT graph_id, id, id FROM n WHERE label = 'METHOD')
            SELECT e.graph_id, a.m AS method, e.src, e.dst, e.etype FROM e JOIN ow a ON a.graph_id = e.graph_id AND a.id = e.src JOIN ow b ON b.graph_id = e.graph_id AND b.id = e.dst AND b.m = a.m""",
    }
