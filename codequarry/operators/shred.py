"""Nested JSON records as flat related tables, by adjacency-table shredding."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADJACENCY = "record_id long, node long, parent long, label string, ordinal int, kind string, scalar string, label_path string, pos_path string"


def _strict(token: str):
    raise ValueError(token)


class _Literal(str):
    """A number as it is written in the payload."""


_DECODER = json.JSONDecoder(parse_constant=_strict, parse_int=_Literal, parse_float=_Literal)


def _nodes(rid: int, payload: str, out: list, wanted: frozenset[str] | None) -> None:
    try:
        top = _DECODER.decode(payload)
    except (ValueError, RecursionError, TypeError):
        return
    count = 0
    # (value, parent, label, ordinal, label path, position path); a stack of our own, so depth is not limited by Python's
    stack = [(top, None, None, None, "", "")]
    while stack:
        v, parent, label, ordinal, path, pos = stack.pop()
        if isinstance(v, list):
            if not v:
                if wanted is None or path in wanted:
                    out.append((rid, count, parent, label, ordinal, "empty", None, path, pos))
                count += 1
            # elements belong to the object that owns the array
            for i in range(len(v) - 1, -1, -1):
                stack.append((v[i], parent, label, i, path, f"{pos}/{i}" if pos else str(i)))
            continue
        if isinstance(v, dict):
            if ordinal is None and label is not None:  # a bare object counts as an array of one
                pos = f"{pos}/0" if pos else "0"
            me = count
            if wanted is None or path in wanted:
                out.append((rid, me, parent, label, ordinal, "object", None, path, pos))
            for k in reversed(v):
                stack.append((v[k], me, k, None, f"{path}/{k}" if path else k, pos))
        elif wanted is not None and path not in wanted:
            pass
        elif isinstance(v, _Literal):
            out.append((rid, count, parent, label, ordinal, "number", str(v), path, pos))
        elif isinstance(v, str):
            # a lone surrogate cannot be stored as UTF-8
            out.append((rid, count, parent, label, ordinal, "string", v.encode("utf-8", "replace").decode("utf-8"), path, pos))
        elif v is None:
            out.append((rid, count, parent, label, ordinal, "null", None, path, pos))
        else:
            out.append((rid, count, parent, label, ordinal, "boolean", "true" if v else "false", path, pos))
        count += 1


_ARROW = pa.schema(
    [("record_id", pa.int64()), ("node", pa.int64()), ("parent", pa.int64()), ("label", pa.string()), ("ordinal", pa.int32()), ("kind", pa.string()),
     ("scalar", pa.string()), ("label_path", pa.string()), ("pos_path", pa.string())]
)


def _batch(out: list) -> pa.RecordBatch:
    columns = zip(*out) if out else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _shred(wanted: frozenset[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list = []
            for rid, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                _nodes(rid, payload, out, wanted)
                if len(out) > 50_000:  # a batch of large records must not become one large batch
                    yield _batch(out)
                    out = []
            yield _batch(out)

    return run


def adjacency(df: DataFrame, record_id: str, payload: str, wanted: Iterable[str] | None = None) -> DataFrame:
    """One row for each object and scalar of each record's JSON text: node, parent, label, ordinal, kind, scalar.

    node counts the record's rows from 0 in document order; parent is the nearest enclosing object (null for the top).
    label is the nearest member name, ordinal the place in the innermost array (null outside arrays), label_path the
    member names and pos_path the array positions from the top, joined by '/'. A bare object counts as an array of one
    in pos_path. kind is object, string, number, boolean, null or empty (an empty array). Numbers keep their text. Of
    repeated members of one object the last counts. Payloads that are null, empty or not JSON (NaN and Infinity are not)
    give no rows. With wanted, only rows of these label paths are made; the others are numbered all the same.
    """
    some = None if wanted is None else frozenset(wanted)
    return df.select(F.col(record_id).cast("long").alias("record_id"), F.col(payload).alias("payload")).where(
        "record_id IS NOT NULL AND payload IS NOT NULL"
    ).mapInArrow(_shred(some), ADJACENCY)


def paths_of(at: Iterable[str], fields: Iterable[str]) -> list[str]:
    """The label paths that entities() reads for objects at some paths."""
    at, fields = list(at), list(fields)
    return [*at, *(f"{p}/{f}" if p else f for p in at for f in fields)]


def entities(adj: DataFrame, at: dict[str, str], fields: dict[str, str]) -> DataFrame:
    """Flat rows of the objects at some label paths, each naming its parent object.

    at: label path -> level; the empty path is the record itself. fields: member name -> output column (the member's scalar as text, null where it is
    missing, null or nested). Objects meet their scalar children on (record, object) and are pivoted in the same
    grouping; the key holds the object, so a record of any size is spread over tasks. Null array elements give no row.
    """
    level = F.lit(None).cast("string")
    for path, name in at.items():
        level = F.when(F.col("label_path") == path, F.lit(name)).otherwise(level)
    is_entity = (F.col("kind") == "object") & level.isNotNull()
    child = F.col("kind").isin("string", "number", "boolean") & F.col("ordinal").isNull() & F.col("label").isin(*fields)
    if fields:
        owners = [f"{p}/{f}" if p else f for p in at for f in fields]
        child = child & F.col("label_path").isin(*owners)
    rows = adj.where(is_entity | child).select(
        "record_id", F.when(is_entity, F.col("node")).otherwise(F.col("parent")).alias("node"),
        F.when(is_entity, F.struct(F.col("parent"), level.alias("level"), F.col("ordinal"), F.col("pos_path"))).alias("_object"),
        F.when(child, F.col("label")).alias("_label"), F.col("scalar"),
    )
    out = rows.groupBy("record_id", "node").agg(
        F.first("_object", ignorenulls=True).alias("_object"),
        *[F.max(F.when(F.col("_label") == f, F.col("scalar"))).alias(c) for f, c in fields.items()],
    )
    return out.where("_object IS NOT NULL").select(
        "record_id", F.col("_object.level").alias("level"), "node", F.col("_object.parent").alias("parent_node"),
        F.col("_object.ordinal").alias("ordinal"), F.col("_object.pos_path").alias("pos_path"), *fields.values(),
    )


CVE_LEVELS = {
    "commits": "commit",
    "commits/files": "file",
    "commits/files/vulnerable_functions": "vul_func",
    "commits/files/non_vulnerable_functions": "non_vul_func",
}
GRAPH_LEVELS = {"nodes": "node", "edges": "edge"}


def parts(raw: DataFrame) -> DataFrame:
    """All adjacency rows of raw_record with their level: the kind of record for its top, the name of a level for its
    objects, null for other objects and for what is no object."""
    def part(kind: str, at: dict[str, str]) -> DataFrame:
        level = F.lit(None).cast("string")
        for path, name in {"": kind, **at}.items():
            level = F.when((F.col("kind") == "object") & (F.col("label_path") == path), F.lit(name)).otherwise(level)
        return adjacency(raw.where(F.col("kind") == kind), "record_id", "payload").withColumn("level", level).withColumnRenamed("parent", "parent_node")

    return part("cve_record", CVE_LEVELS).unionByName(part("graph", GRAPH_LEVELS))


def child_key(level: Column) -> Column:
    """The name of an entity within its parent; expects the columns that found() pivots."""
    edge = F.concat(F.col("outNode"), F.lit(">"), F.col("inNode"), F.lit(":"), F.col("etype"))
    return (
        F.when(level == "commit", F.col("commit_hash")).when(level == "file", F.col("file_path"))
        .when(level.isin("vul_func", "non_vul_func"), F.col("func_name")).when(level == "node", F.col("id")).otherwise(edge)
    )


FOUND_FIELDS = {f: f for f in ("commit_hash", "file_path", "func_name", "id", "outNode", "inNode", "etype")}


def found(raw: DataFrame) -> DataFrame:
    """(record_id, level, pos_path, child_key) of raw_record's nested objects, by kind of record."""
    def part(kind: str, at: dict[str, str]) -> DataFrame:
        return entities(adjacency(raw.where(F.col("kind") == kind), "record_id", "payload", paths_of(at, FOUND_FIELDS)), at, FOUND_FIELDS)

    both = part("cve_record", CVE_LEVELS).unionByName(part("graph", GRAPH_LEVELS))
    return both.select("record_id", "level", "pos_path", child_key(F.col("level")).alias("child_key"))
