"""Column functions on repository names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def repository(name: Column) -> Column:
    """repo_name without outer blanks, lower-cased, without one final .git; null stays null."""
    return F.regexp_replace(F.lower(F.regexp_replace(name, r"^\s+|\s+$", "")), r"\.git$", "")


def extension(path: Column) -> Column:
    """Lower-cased text behind the last dot of the last path segment; '' without a dot, null for null."""
    return F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))
