"""Sources and sinks: JSON lists, lines, changelogs, pages, source-file layouts, graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.graph.model import Graph
from codequarry.session import Scratch


def read_json_list(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Records of files that each hold one JSON list. With a schema, a record that does not fit it fails the read."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema).option("mode", "FAILFAST") if schema is not None else r).json(path)


def write_json(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Existing data stay unless overwrite is asked for."""
    df.write.mode("overwrite" if overwrite else "ignore").option("compression", "gzip").json(path)


def write_text(df: DataFrame, column: str, path: str, overwrite: bool = False) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite" if overwrite else "ignore").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines without trailing blanks."""
    return spark.read.text(path).select(F.rtrim("value").alias("value")).where("value <> ''")


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    """(message, hash) of lines 'hash||||||||||message'; of equal messages the line read last counts."""
    lines = spark.read.text(path).where(F.col("value").contains("||||||||||")).withColumn("at", F.monotonically_increasing_id())
    p = F.split("value", r"\|{10}", 2)
    return lines.select(F.trim(p[0]).alias("hash"), F.trim(p[1]).alias("message"), "at").groupBy("message").agg(F.max_by("hash", "at").alias("hash"))


def page_url(base: str, page: Column | int, size: int = 1000) -> Column:
    """Address of a page of a paged list."""
    p = F.lit(page) if isinstance(page, int) else page
    return F.concat(F.lit(f"{base}?resultsPerPage={size}&startIndex="), (p * size).cast("string"))


def incomplete_pages(pages: DataFrame, page: str, records: str, total: int, size: int = 1000) -> DataFrame:
    """(page, n, want): pages with another number of records than they should have, the last page holding the rest."""
    last = (total - 1) // size if total else 0
    want = F.when(F.col("page") == last, F.lit(total - last * size)).otherwise(F.lit(size))
    have = pages.select(F.col(page).alias("page"), F.coalesce(F.size(records), F.lit(0)).alias("n"))
    all_ = pages.sparkSession.range(0, last + 1).select(F.col("id").cast("int").alias("page"))
    return all_.join(have, "page", "left").select("page", F.coalesce("n", F.lit(0)).alias("n"), want.alias("want")).where("n <> want")


def resolve_redirects(urls: DataFrame, redirects: DataFrame) -> DataFrame:
    """urls(url) with final: where chains of redirects(url, final) end, however long they are; a URL that leads into a circle
    stands for itself. Of several redirects of one URL the smallest counts. Pointers jump twice as far in each round."""
    scratch = Scratch(urls.sparkSession)
    now = scratch.save(redirects.where("url IS NOT NULL AND final IS NOT NULL AND url <> final").groupBy("url").agg(F.min("final").alias("to")).withColumn("open", F.lit(True)))
    for _ in range(now.count().bit_length() + 1):
        then = now.select(F.col("url").alias("to"), F.col("to").alias("to2"), F.col("open").alias("open2"))
        now = scratch.save(now.join(then, "to", "left").select("url", F.coalesce("to2", "to").alias("to"), F.coalesce("open2", F.lit(False)).alias("open")))
        if now.where("open").isEmpty():
            break
    ends = now.where("NOT open").select(F.col("url").alias("_from"), "to")
    return urls.select("url").join(ends, F.col("url") == F.col("_from"), "left").select("url", F.coalesce("to", "url").alias("final"))


def source_path(repo: Column, commit: Column, side: Column, number: Column, extension: Column) -> Column:
    """Where a function's text is laid out: repository/commit/side/number.extension."""
    return F.concat(F.concat_ws("/", repo, F.substring(commit, 1, 12), side, number.cast("string")), F.lit("."), extension)


def language_of(paths: DataFrame, group: str, path: str) -> DataFrame:
    """(group, language): the language most of a group's files have, by extension; ties to the first by name."""
    from codequarry.functions.names import extension

    known = {"c": "c", "h": "c", "cc": "c", "cpp": "c", "cxx": "c", "hpp": "c", "java": "java", "js": "javascript", "ts": "javascript", "py": "python", "go": "go", "kt": "kotlin", "php": "php", "rb": "ruby", "swift": "swift", "cs": "csharp", "class": "jvm", "jar": "jvm"}
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    rows = paths.select(F.col(group).alias("group"), table[extension(F.col(path))].alias("language")).where("language IS NOT NULL")
    n = rows.groupBy("group", "language").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("group").agg(F.min_by("language", F.struct((-F.col("n")).alias("m"), "language")).alias("language")).withColumnRenamed("group", group)


def save_graph(graph: Graph, path: str) -> None:
    """Node and edge tables, partitioned by label and edge type, so that a scan of one kind reads only that."""
    graph.nodes.write.mode("overwrite").partitionBy("label").parquet(f"{path}/nodes")
    graph.edges.write.mode("overwrite").partitionBy("etype").parquet(f"{path}/edges")


def load_graph(spark: SparkSession, path: str) -> Graph:
    return Graph.of(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"))
