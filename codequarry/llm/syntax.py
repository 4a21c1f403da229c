"""Source texts that are no function definition of their language, per file and as rates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.functions.names import extension, repository
from codequarry.session import hot_keys, salted_join


def syntax_flags(df: DataFrame, keys: list[str], text: str, lang: str) -> DataFrame:
    """keys, language, problem, at_token for every row whose text is not null.

    language is c, cpp or java. problem is null for exactly one function definition, token or directive where something
    cannot stand, truncated where the text breaks off (also for an empty text); at_token is the place of the wrong token,
    -1 without a problem. Rows with another or no language get problem and at_token null: there is nothing to check them
    against. Each text is parsed as a whole, in time proportional to its tokens.
    """
    schema = pa.schema([pa.field("problem", pa.string()), pa.field("at_token", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from codequarry.llm.grammars import check

        for b in batches:
            problems, places = [], []
            for t, g in zip(b.column(b.num_columns - 1).to_pylist(), b.column(b.num_columns - 2).to_pylist()):
                p, at = check(t, g) if g else (None, None)
                problems.append(p)
                places.append(at)
            kept = [b.column(i) for i in range(b.num_columns - 1)]
            fields = [b.schema.field(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(problems, pa.string()), pa.array(places, pa.int32())], schema=pa.schema([*fields, *schema]))

    known = F.when(F.col(lang).isin("c", "cpp", "java"), F.col(lang))
    rows = df.where(F.col(text).isNotNull()).select(*keys, known.alias("language"), F.col(text).cast("string").alias("_text"))
    out = T.StructType([*rows.drop("_text").schema, T.StructField("problem", T.StringType()), T.StructField("at_token", T.IntegerType())])
    return rows.mapInArrow(run, out)


def func_flags(func: DataFrame, commit_file: DataFrame) -> DataFrame:
    """syntax_flags of func.func_before in the language of its file's extension: file_ordinal, func_ordinal, repository, ..."""
    from codequarry.llm.grammars import EXTENSIONS

    ext = extension(F.coalesce(F.col("file_path"), F.col("file_name")))
    lang = F.lit(None).cast("string")
    for e, name in EXTENSIONS.items():
        lang = F.when(ext == e, F.lit(name)).otherwise(lang)
    files = commit_file.where("ordinal IS NOT NULL").select(F.col("ordinal").alias("file_ordinal"), lang.alias("_lang")).dropDuplicates(["file_ordinal"])
    rows = func.where("func_before IS NOT NULL").select(
        "file_ordinal", F.col("ordinal").alias("func_ordinal"), repository(F.col("repo_name")).alias("repository"), "func_before"
    )
    # a file with a great share of all functions is parsed by several tasks
    counts = rows.groupBy("file_ordinal").agg(F.count(F.lit(1)).alias("_c"))
    hot = hot_keys(counts, "file_ordinal", "_c", func.count())
    rows = salted_join(rows, files, "file_ordinal", hot, F.col("func_ordinal"), "left")
    rows = rows.select("file_ordinal", "func_ordinal", "repository", "func_before", "_lang")
    return syntax_flags(rows, ["file_ordinal", "func_ordinal", "repository"], "func_before", "_lang")


def file_flags(flags: DataFrame) -> DataFrame:
    """One row a file: functions checked and functions with a problem."""
    return flags.groupBy("file_ordinal").agg(F.count("at_token").alias("checked"), F.count("problem").alias("invalid"))


def rates(flags: DataFrame) -> DataFrame:
    """Rate of invalid functions per repository and language; rows without a language are left out."""
    out = flags.where("language IS NOT NULL").groupBy("repository", "language").agg(
        F.count(F.lit(1)).alias("checked"), F.count("problem").alias("invalid"), F.count_if(F.col("problem") == "truncated").alias("truncated")
    )
    return out.withColumn("invalid_rate", F.col("invalid") / F.col("checked"))
