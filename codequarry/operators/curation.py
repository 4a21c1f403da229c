"""Cleaning filters, matching and flattening over the hierarchy CVE > commit > file > function.

The hierarchy is four tables tied by ordinals, and "first" always means the smallest ordinal. Every filter takes a Dataset
and returns one; nothing runs before a result is asked for. Keep-first filters find the smallest ordinal of each key by an
aggregate that combines on the map side, and join on the ordinal, which is unique: no key's rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codequarry.functions import paths, text
from codequarry.session import Scratch, table


@dataclass(frozen=True)
class Dataset:
    cve: DataFrame
    commit: DataFrame
    file: DataFrame
    func: DataFrame

    @staticmethod
    def load(spark: SparkSession, d: str) -> Dataset:
        return Dataset(*(table(spark, d, t) for t in ("cve", "fix_commit", "commit_file", "func")))

    def with_(self, **kw: DataFrame) -> Dataset:
        return replace(self, **kw)

    def prune_down(self) -> Dataset:
        """Drop commits, files and functions whose parent is gone."""
        commit = semi(self.commit, self.cve, "cve_ordinal", "ordinal")
        file = semi(self.file, commit, "commit_ordinal", "ordinal")
        return replace(self, commit=commit, file=file, func=semi(self.func, file, "file_ordinal", "ordinal"))

    def prune_up(self, only_vul: bool = False) -> Dataset:
        """Drop files without functions (or without vulnerable ones), then commits without files and CVEs without commits."""
        kept = self.func.where("is_vul") if only_vul else self.func
        file = semi(self.file, kept, "ordinal", "file_ordinal")
        commit = semi(self.commit, file, "ordinal", "commit_ordinal")
        cve = semi(self.cve, commit, "ordinal", "cve_ordinal")
        return replace(self, cve=cve, commit=commit, file=file, func=semi(self.func, file, "file_ordinal", "ordinal"))

    def rows(self) -> DataFrame:
        """Functions with their file's path, commit and CVE ordinals, repository and date."""
        f = self.file.select(F.col("ordinal").alias("file_ordinal"), "commit_ordinal", "file_path", "language")
        c = self.commit.select(F.col("ordinal").alias("commit_ordinal"), "cve_ordinal", F.col("repo_name").alias("repo"), "commit_date", F.col("commit_hash").alias("hash"))
        return self.func.join(f, "file_ordinal").join(c, "commit_ordinal")


def semi(df: DataFrame, other: DataFrame, key: str, other_key: str, how: str = "left_semi") -> DataFrame:
    ids = other.select(F.col(other_key).alias("_k"))
    return df.join(ids, df[key] == ids["_k"], how)


def keep_first(df: DataFrame, keys: Iterable[str | Column], order: str = "ordinal") -> DataFrame:
    """The first row of each key by a unique order column; null keys are keys."""
    first = df.groupBy(*keys).agg(F.min(order).alias("_first")).select("_first")
    return df.join(first, F.col(order) == F.col("_first"), "left_semi")


# Filters in the order in which the chain runs them.


def drop_test_files(ds: Dataset, drop_empty: bool = True) -> Dataset:
    """Files that lie in or are tests, by their path; then what became empty."""
    file = ds.file.where(~F.coalesce(paths.is_test_path(F.col("file_path")), F.lit(False)))
    out = ds.with_(file=file, func=semi(ds.func, file, "file_ordinal", "ordinal"))
    if not drop_empty:
        return out
    commit = semi(out.commit, file, "ordinal", "commit_ordinal")
    return out.with_(commit=commit, cve=semi(out.cve, commit, "ordinal", "cve_ordinal"))


def changed_lines(func: DataFrame) -> DataFrame:
    return func.withColumn("_changed", F.coalesce(F.size("diff_line_info.deleted_lines"), F.lit(0)) + F.coalesce(F.size("diff_line_info.added_lines"), F.lit(0)))


def drop_large_changes(ds: Dataset, most_lines: int = 110, most_commits: int = 3, drop_empty: bool = False) -> Dataset:
    """Commits that change more than most_lines lines of vulnerable functions; with them, and where a CVE has more than
    most_commits commits in one repository, all commits of that CVE and repository."""
    sizes = changed_lines(ds.func.where("is_vul")).join(ds.file.select(F.col("ordinal").alias("file_ordinal"), "commit_ordinal"), "file_ordinal")
    large = sizes.groupBy("commit_ordinal").agg(F.sum("_changed").alias("lines")).where(F.col("lines") > most_lines)
    marked = ds.commit.join(large.select(F.col("commit_ordinal").alias("ordinal"), F.lit(True).alias("_large")), "ordinal", "left")
    bad = marked.groupBy("cve_ordinal", "repo_name").agg(F.count(F.lit(1)).alias("n"), F.max("_large").alias("any_large")).where((F.col("n") > most_commits) | F.col("any_large"))
    bad = bad.select(F.col("cve_ordinal").alias("_c"), F.col("repo_name").alias("_r"))
    commit = ds.commit.join(bad, (F.col("cve_ordinal") == F.col("_c")) & F.col("repo_name").eqNullSafe(F.col("_r")), "left_anti")
    out = ds.with_(commit=commit).prune_down()
    return out.with_(cve=semi(ds.cve, commit, "ordinal", "cve_ordinal")) if drop_empty else out


def merge_multi_cve_commits(ds: Dataset) -> Dataset:
    """A commit (repository, hash) under several CVEs stays with the first; a CVE that keeps such a commit gets the CWEs of
    all CVEs that named any of them, sorted, instead of its own."""
    named = ds.commit.join(ds.cve.select(F.col("ordinal").alias("cve_ordinal"), "cwe_ids"), "cve_ordinal", "left")
    # by the order of CVEs, then commits
    first = named.groupBy("repo_name", "commit_hash").agg(
        F.min(F.struct("cve_ordinal", "ordinal")).alias("first"), F.count(F.lit(1)).alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("cwe_ids")))).alias("cwes")
    )
    kept = first.select(F.col("first.ordinal").alias("_o"), F.col("first.cve_ordinal").alias("_cve"), "n", "cwes")
    commit = ds.commit.join(kept.select("_o"), F.col("ordinal") == F.col("_o"), "left_semi")
    union = kept.where("n > 1").groupBy("_cve").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cwes")))).alias("_cwes"))
    cve = semi(ds.cve, commit, "ordinal", "cve_ordinal").join(union, F.col("ordinal") == F.col("_cve"), "left")
    cve = cve.withColumn("cwe_ids", F.coalesce("_cwes", "cwe_ids")).drop("_cwes", "_cve")
    return ds.with_(cve=cve, commit=commit).prune_down()


def drop_equal_commits(ds: Dataset) -> Dataset:
    """Where every commit of a CVE equals the one before it, only the first stays.

    Equal: the same non-empty message; or the same set of paths and, file by file and function by function in order (what
    has no partner is not looked at), as many vulnerable functions with equal texts or equal changed lines.
    """
    # two hashes of a list do not depend on how it is gathered: each element is hashed with its place, and all are xored
    both = lambda *c: F.struct(F.coalesce(F.bit_xor(F.xxhash64(*c)), F.lit(0)).alias("x"), F.coalesce(F.bit_xor(F.xxhash64(F.lit(1), *c)), F.lit(0)).alias("y"))
    place = F.row_number().over(Window.partitionBy("file_ordinal").orderBy("ordinal"))
    lines = (F.col("diff_line_info.deleted_lines"), F.col("diff_line_info.added_lines"))
    vul = ds.func.where("is_vul").select("file_ordinal", "ordinal", F.xxhash64("func_before", "func").alias("t"), F.xxhash64(*lines).alias("l")).withColumn("i", place)
    vul = vul.groupBy("file_ordinal").agg(F.count(F.lit(1)).alias("n"), both("i", "t").alias("texts"), both("i", "l").alias("lines"))
    files = ds.file.select(F.col("ordinal").alias("file_ordinal"), "commit_ordinal", "file_path").join(vul, "file_ordinal", "left")
    files = files.withColumn("at", F.row_number().over(Window.partitionBy("commit_ordinal").orderBy("file_ordinal")))
    none = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    files = files.select("commit_ordinal", "at", "file_path", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("texts", none).alias("texts"), F.coalesce("lines", none).alias("lines"))
    path = F.when(F.col("file_path").isNotNull(), F.xxhash64("file_path"))
    names = files.select("commit_ordinal", "file_path").distinct().groupBy("commit_ordinal").agg(F.struct(F.count("file_path").alias("k"), both(path).alias("h")).alias("paths"))
    w = Window.partitionBy("cve_ordinal").orderBy("ordinal")
    steps = ds.commit.select("cve_ordinal", "ordinal", "commit_msg", F.lag("ordinal").over(w).alias("po"), F.lag("commit_msg").over(w).alias("pm"))
    steps = steps.select("cve_ordinal", "ordinal", "po", F.coalesce((F.col("commit_msg") == F.col("pm")) & (F.length("commit_msg") > 0), F.lit(False)).alias("same_message"))
    here = files.select(F.col("commit_ordinal").alias("ordinal"), "at", "n", "texts", "lines")
    there = files.select(F.col("commit_ordinal").alias("po"), "at", F.col("n").alias("n_"), F.col("texts").alias("texts_"), F.col("lines").alias("lines_"))
    met = steps.where("po IS NOT NULL").select("ordinal", "po").join(here, "ordinal").join(there, ["po", "at"])
    odd = met.where("NOT (n = n_ AND (texts = texts_ OR lines = lines_))").select("ordinal", F.lit(True).alias("odd")).distinct()
    compared = steps.join(names.withColumnRenamed("commit_ordinal", "ordinal"), "ordinal", "left")
    compared = compared.join(names.select(F.col("commit_ordinal").alias("po"), F.col("paths").alias("paths_")), "po", "left").join(odd, "ordinal", "left")
    equal = F.col("po").isNull() | F.col("same_message") | (F.coalesce(F.col("paths") == F.col("paths_"), F.lit(False)) & F.col("odd").isNull())
    all_equal = compared.groupBy("cve_ordinal").agg(F.bool_and(equal).alias("same"), F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first")).where("same AND n > 1")
    gone = steps.select("cve_ordinal", "ordinal").join(all_equal.select("cve_ordinal", "first"), "cve_ordinal").where("ordinal <> first")
    return ds.with_(commit=semi(ds.commit, gone, "ordinal", "ordinal", "left_anti")).prune_down()


FUNC_KEY = ("func_name", "sig")


def drop_repeated_non_vul(ds: Dataset) -> Dataset:
    """Within a CVE and path, non-vulnerable functions (name, signature) found in every one of the path's commits stay in
    the first of these commits only."""
    rows = ds.rows().select("cve_ordinal", "commit_ordinal", "file_path", *FUNC_KEY, "ordinal", "is_vul")
    files = ds.file.join(ds.commit.select(F.col("ordinal").alias("commit_ordinal"), "cve_ordinal"), "commit_ordinal")
    spread = files.groupBy("cve_ordinal", "file_path").agg(F.count_distinct("commit_ordinal").alias("n"), F.min("commit_ordinal").alias("first")).where("n > 1")
    non = rows.where("NOT is_vul").join(spread, ["cve_ordinal", "file_path"])
    everywhere = non.groupBy("cve_ordinal", "file_path", *FUNC_KEY).agg(F.count_distinct("commit_ordinal").alias("k"), F.max("n").alias("m")).where("k = m")
    later = non.where("commit_ordinal <> first")
    on = (later["cve_ordinal"] == everywhere["cve_ordinal"]) & (later["file_path"] == everywhere["file_path"])
    for k in FUNC_KEY:
        on = on & later[k].eqNullSafe(everywhere[k])
    gone = later.join(everywhere, on, "left_semi")
    return ds.with_(func=semi(ds.func, gone, "ordinal", "ordinal", "left_anti"))


def drop_duplicate_non_vul(ds: Dataset) -> Dataset:
    """Of non-vulnerable functions equal in repository, path, name, signature and text the first stays."""
    rows = ds.rows().where("NOT is_vul").select("ordinal", "repo", "file_path", *FUNC_KEY, F.sha2("func", 256).alias("digest"))
    gone = semi(rows, keep_first(rows, ["repo", "file_path", *FUNC_KEY, "digest"]), "ordinal", "ordinal", "left_anti")
    return ds.with_(func=semi(ds.func, gone, "ordinal", "ordinal", "left_anti"))


def drop_non_vul_seen_vul(ds: Dataset) -> Dataset:
    """Non-vulnerable functions whose repository, path, name and signature are those of a vulnerable one before its fix."""
    rows = ds.rows().select("ordinal", "is_vul", "repo", "file_path", "func_name", "sig", "sig_before")
    key = lambda s: F.struct(F.coalesce("repo", F.lit("\0")).alias("r"), F.coalesce("file_path", F.lit("\0")).alias("p"), F.coalesce("func_name", F.lit("\0")).alias("f"), F.coalesce(s, F.lit("\0")).alias("s"))
    seen = rows.where("is_vul").select(key("sig_before").alias("_k")).distinct()
    gone = rows.where("NOT is_vul").withColumn("_key", key("sig")).join(seen, F.col("_key") == F.col("_k"), "left_semi")
    return ds.with_(func=semi(ds.func, gone, "ordinal", "ordinal", "left_anti"))


def _local(ds: Dataset, drop_vul: Column, drop_non: Column) -> Dataset:
    """A filter on single functions; then files without vulnerable functions go, and what became empty above them."""
    func = ds.func.where(~F.coalesce(F.when(F.col("is_vul"), drop_vul).otherwise(drop_non), F.lit(False)))
    return ds.with_(func=func).prune_up(only_vul=True)


def drop_test_functions(ds: Dataset) -> Dataset:
    lang = ds.file.select(F.col("ordinal").alias("file_ordinal"), (F.lower("language") == "java").alias("_java"))
    func = ds.func.join(lang, "file_ordinal", "left")
    test = paths.is_test_function(F.col("func_name")) & ~F.coalesce("_java", F.lit(False))
    out = _local(ds.with_(func=func), test, test)
    return out.with_(func=out.func.drop("_java"))


def drop_long_non_vul(ds: Dataset, most_lines: int = 120) -> Dataset:
    return _local(ds, F.lit(False), text.line_count(F.col("func")) > most_lines)


def drop_long_vul(ds: Dataset, most_lines: int = 800) -> Dataset:
    return _local(ds, text.line_count(F.col("func")) > most_lines, F.lit(False))


def keep_latest_non_vul(ds: Dataset) -> Dataset:
    """Non-vulnerable functions only from commits of the latest date of their repository and path. Not in the chain."""
    rows = ds.rows().select("ordinal", "is_vul", "repo", "file_path", "commit_date")
    latest = rows.groupBy("repo", "file_path").agg(F.max("commit_date").alias("_latest")).withColumnsRenamed({"repo": "_r", "file_path": "_p"})
    both = rows.where("NOT is_vul").join(latest, F.col("repo").eqNullSafe(F.col("_r")) & F.col("file_path").eqNullSafe(F.col("_p")))
    gone = both.where("commit_date <> _latest")
    return ds.with_(func=semi(ds.func, gone, "ordinal", "ordinal", "left_anti"))


def debug(ds: Dataset) -> Dataset:
    """Changes nothing; a place to look at what passes."""
    return ds


CHAIN: list[Callable[[Dataset], Dataset]] = [
    drop_test_files, drop_large_changes, merge_multi_cve_commits, drop_equal_commits, drop_repeated_non_vul,
    drop_duplicate_non_vul, drop_non_vul_seen_vul, drop_test_functions, drop_long_non_vul, drop_long_vul,
]


def run(ds: Dataset, chain: Iterable[Callable[[Dataset], Dataset]] = CHAIN, save: Callable[[DataFrame], DataFrame] | None = None) -> Dataset:
    """The filters in order. Behind each filter the ordinals that are left are written (by save, to a scratch table where none
    is given) and met with the tables as they came: each filter reads its input several times, and a chain planned as one
    query would grow with the power of its length. Only CVEs, whose fields a filter may change, are written as they are."""
    save = save or Scratch(ds.func.sparkSession).save
    whole = ds
    left = lambda table, kept: semi(table, save(kept.select("ordinal")), "ordinal", "ordinal")
    for f in chain:
        out = f(ds)
        ds = Dataset(save(out.cve), left(whole.commit, out.commit), left(whole.file, out.file), left(whole.func, out.func))
    return ds


def counts(ds: Dataset) -> DataFrame:
    """One row: CVEs, commits, files, vulnerable and other functions, and different repositories."""
    one = lambda df, *a: df.agg(*a)
    c = one(ds.cve, F.count(F.lit(1)).alias("n_cve"))
    m = one(ds.commit, F.count(F.lit(1)).alias("n_commit"), F.count_distinct("repo_name").alias("n_repo"))
    f = one(ds.file, F.count(F.lit(1)).alias("n_file"))
    g = one(ds.func, F.count_if(F.col("is_vul")).alias("n_vul"), F.count_if(~F.col("is_vul")).alias("n_non_vul"))
    parts = [x.select(F.to_json(F.struct("*")).alias("j")) for x in (c, m, f, g)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    names = ["n_cve", "n_commit", "n_repo", "n_file", "n_vul", "n_non_vul"]
    return union.agg(*[F.max(F.get_json_object("j", f"$.{n}").cast("long")).alias(n) for n in names])


# Commits.


def both_sides(before: DataFrame, after: DataFrame, commit: str, path: str) -> DataFrame:
    """(commit, path): the files that a commit has before and after it; a commit without any gives no row. Null paths are none."""
    return before.where(F.col(path).isNotNull()).select(commit, path).distinct().join(after.select(commit, path).distinct(), [commit, path], "left_semi")


def single_parent(parents: DataFrame, commit: str, parent: str) -> DataFrame:
    """(commit, parent) of the commits with exactly one different parent: merges and first commits have no side to compare with."""
    n = parents.groupBy(commit).agg(F.count_distinct(parent).alias("_n"), F.min(parent).alias(parent))
    return n.where("_n = 1").select(commit, parent)


def sides_and_files(commits: DataFrame, key: str, commit: str, parent: str, files: str) -> DataFrame:
    """(key, side, hash, path): what has to be fetched of each commit: every file as it was before (the parent's) and after."""
    sides = F.array(F.struct(F.lit("before").alias("side"), F.col(parent).alias("hash")), F.struct(F.lit("after").alias("side"), F.col(commit).alias("hash")))
    rows = commits.select(key, F.explode(sides).alias("_s"), files).select(key, "_s.side", "_s.hash", F.explode(files).alias("path"))
    return rows.where("hash IS NOT NULL AND path IS NOT NULL")


def all_parsed(files: DataFrame, commit: str, file: str, parsed: DataFrame, parsed_file: str) -> DataFrame:
    """(commit): commits of which every file is among the parsed ones; a commit without files gives no row."""
    ok = parsed.select(F.col(parsed_file).alias(file)).distinct().withColumn("_ok", F.lit(True))
    return files.select(commit, file).join(ok, file, "left").groupBy(commit).agg(F.bool_and(F.coalesce("_ok", F.lit(False))).alias("_all")).where("_all").select(commit)


def commits_saying(commits: DataFrame, message: str, pattern: str, regex: bool = False) -> DataFrame:
    """Commits whose message, in lower case, holds a text or matches an expression somewhere; null messages match nothing."""
    low = F.lower(message)
    return commits.where(low.rlike(pattern.lower()) if regex else low.contains(pattern.lower()))


# Matching of functions before and after a commit.


def overload_keys(funcs: DataFrame, group: list[str], name: str, signature: str, position: str) -> DataFrame:
    """key of every function within its group: its name where that is unique, else name$$$signature, of which the last
    counts. Rows whose full key comes again later are left out."""
    by_name = funcs.groupBy(*group, name).agg(F.count(F.lit(1)).alias("_n"))
    both = funcs.join(by_name, [*group, name])
    both = both.withColumn("key", F.when(F.col("_n") == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("$$$"), F.coalesce(signature, F.lit("")))))
    last = both.groupBy(*group, "key").agg(F.max(position).alias("_last"))
    return both.join(last, [*group, "key"]).where(F.col(position) == F.col("_last")).drop("_n", "_last")


def match_functions(before: DataFrame, after: DataFrame, group: list[str], name: str, signature: str, position: str, body: str) -> DataFrame:
    """Functions found on both sides of a commit by key: is_vul where the text differs, with both texts."""
    a = overload_keys(before, group, name, signature, position).select(*group, "key", F.col(body).alias("before"))
    b = overload_keys(after, group, name, signature, position).select(*group, "key", F.col(body).alias("after"), F.col(position).alias("position"))
    return a.join(b, [*group, "key"]).withColumn("is_vul", ~F.col("before").eqNullSafe(F.col("after")))


# Flattening.

SIMPLE = ["cve_id", "cwe_ids", "cvss_vector", "cvss_base_score", "cvss_base_severity", "cvss_is_v3", "publish_date", "repo_name", "commit_msg", "commit_hash", "git_url", "file_path", "func_name", "parameter_list_signature", "func_before", "func", "diff_line_info", "is_vul", "return_type"]


def flatten(ds: Dataset) -> DataFrame:
    """One row for each function with all fields of its file, commit and CVE (32 columns and the function's ordinal)."""
    cve = ds.cve.select(F.col("ordinal").alias("cve_ordinal"), "cve_id", "cwe_ids", "cvss_vector", "cvss_base_score", "cvss_base_severity", "cvss_is_v3", "publish_date", "last_modify_date", "description")
    commit = ds.commit.select(F.col("ordinal").alias("commit_ordinal"), "cve_ordinal", "repo_name", "commit_msg", "commit_hash", "parent_commit_hash", "commit_date", "git_url")
    file = ds.file.select(F.col("ordinal").alias("file_ordinal"), "commit_ordinal", "file_path", "file_name", "language")
    func = ds.func.drop("cve_id", "repo_name", "commit_hash").withColumnsRenamed({"sig": "parameter_list_signature", "sig_before": "parameter_list_signature_before"})
    # the small levels first, so that the wide function rows are shuffled once
    above = file.join(commit, "commit_ordinal").join(cve, "cve_ordinal")
    return func.join(above, "file_ordinal").drop("file_ordinal", "commit_ordinal", "cve_ordinal")


def simple(flat: DataFrame) -> DataFrame:
    return flat.select(*SIMPLE, "ordinal")


def totals(flat: DataFrame) -> DataFrame:
    """Different repositories, CVEs, CWEs and commits, and vulnerable and other functions."""
    base = flat.agg(
        F.count_distinct("repo_name").alias("n_repo"), F.count_distinct("cve_id").alias("n_cve"), F.count_distinct("repo_name", "commit_hash").alias("n_commit"),
        F.count_if(F.col("is_vul")).alias("n_vul"), F.count_if(~F.col("is_vul")).alias("n_non_vul"),
    )
    cwe = flat.select(F.explode("cwe_ids").alias("c")).agg(F.count_distinct("c").alias("n_cwe"))
    return base.withColumn("n_cwe", cwe.scalar())
