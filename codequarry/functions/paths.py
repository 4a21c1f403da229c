"""Column functions on file paths and function names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path parts and name beginnings that mark tests; extensions that are looked at.
TEST_PARTS = ["test", "tests", "testing", "testsuite"]
TEST_PREFIXES = ["START_TEST", "TEST", "DEF_TEST", "IN_PROC_BROWSER_TEST", "BOOST_AUTO_TEST_CASE", "DROGON_TEST", "test", "assert"]
C_FILES, CPP_FILES, HEADER_FILES, JAVA_FILES = ["c"], ["cc", "cpp", "cxx", "hpp", "hxx", "hh"], ["h"], ["java"]


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(part: Column) -> Column:
    """A path part up to its first dot."""
    return F.element_at(F.split(part, r"\."), 1)


def is_test_path(path: Column) -> Column:
    """Whether a path is a test's. Java: the file's stem ends in Test. Else any part, without what follows its first dot
    and lower-cased, is a word for tests, or has several parts joined by _ or - of which one holds 'test'. Parts that run
    words together without a mark (such as unittests) are not taken apart: there is no word list to do it with."""
    java = F.lower(F.element_at(F.split(base_name(path), r"\."), -1)) == "java"
    part = lambda p: F.lower(stem(p))
    marked = lambda p, sep: p.contains(sep) & p.contains("test")
    other = F.exists(F.split(path, "/"), lambda p: part(p).isin(TEST_PARTS) | marked(part(p), "_") | marked(part(p), "-"))
    return F.when(java, stem(base_name(path)).endswith("Test")).otherwise(other)


def is_test_function(name: Column) -> Column:
    last = F.element_at(F.split(name, "::"), -1)
    starts = F.lit(False)
    for p in TEST_PREFIXES:
        starts = starts | last.startswith(p)
    return starts | last.endswith("test")


def accepted_files(files: Column, extensions: list[str], most: int = 50) -> Column:
    """The paths with one of some extensions; none at all if more than `most` files changed."""
    ext = lambda p: F.element_at(F.split(base_name(p), r"\."), -1)
    kept = F.filter(files, lambda p: base_name(p).contains(".") & ext(p).isin(extensions))
    return F.when(F.size(files) > most, F.filter(files, lambda p: F.lit(False))).otherwise(kept)


# Repositories known under several names.
ALIASES = {"kernel/git/torvalds/linux": "torvalds/linux", "kernel/git/stable/linux": "torvalds/linux", "kernel/git/next/linux-next": "torvalds/linux", "FFmpeg": "ffmpeg"}


def merged_repo(name: Column) -> Column:
    """A repository's name without '.git'; owner/owner becomes owner, and known other names their first one."""
    plain = F.replace(name, F.lit(".git"), F.lit(""))
    parts = F.split(plain, "/")
    short = F.when((F.size(parts) == 2) & (F.element_at(parts, 1) == F.try_element_at(parts, F.lit(2))), F.element_at(parts, 1)).otherwise(plain)
    out = short
    for old, new in ALIASES.items():
        out = F.when(short == old, F.lit(new)).otherwise(out)
    return out


def commit_language(files: Column) -> Column:
    """c, cpp or mix, by the extensions of a commit's files."""
    ext = lambda p: F.lower(F.element_at(F.split(p, r"\."), -1))
    c, cpp = F.exists(files, lambda p: ext(p).isin(C_FILES)), F.exists(files, lambda p: ext(p).isin(CPP_FILES))
    return F.when(cpp & ~c, "cpp").when(c & ~cpp, "c").otherwise("mix")


def file_language(path: Column, repo_language: Column, detected: Column | None = None) -> Column:
    """Language of a file by extension; a header's is its repository's, or, in mixed ones, what was detected."""
    ext = F.element_at(F.split(path, r"\."), -1)
    header = ext.isin(HEADER_FILES)
    return (
        F.when(ext.isin(JAVA_FILES), "java").when(ext.isin(C_FILES) | (header & (repo_language == "c")), "c")
        .when(ext.isin(CPP_FILES) | (header & (repo_language == "cpp")), "cpp").when(header, F.lit(None) if detected is None else detected)
    )
