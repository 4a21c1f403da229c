"""Queries of the general training-data operators (problems 1 and 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.operators import shred, skew
from codequarry.session import table

#: Share of all rows from which a repository counts as hot.
HOT_SHARE = 0.025


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    prof = skew.key_profile(table(spark, d, "func"), F.col("repo_name"), F.col("commit_hash"), F.col("is_vul"))
    total = table(spark, d, "func").agg(F.count(F.lit(1))).scalar()  # from the files' footers
    hot = prof.where((F.col("n_rows") > F.lit(HOT_SHARE) * total) & F.col("key").isNotNull())
    return hot.select(F.col("key").alias("repo_name"))


def _profile(spark: SparkSession, d: str, name: str, key: str, value: str, flag: bool) -> DataFrame:
    df = table(spark, d, name)
    out = skew.key_profile(df, F.col(key), F.col(value), F.col("is_vul") if flag else None)
    if not flag:
        out = out.drop("n_hits", "hit_share")
    return out.withColumnsRenamed({"key": key, "n_hits": "n_vul", "hit_share": "vul_share"})


def p1_repo_profile(spark: SparkSession, d: str) -> DataFrame:
    return _profile(spark, d, "func", "repo_name", "commit_hash", True)


def p1_commit_profile(spark: SparkSession, d: str) -> DataFrame:
    return _profile(spark, d, "func", "commit_hash", "func_name", True)


def p1_fix_commit_profile(spark: SparkSession, d: str) -> DataFrame:
    return _profile(spark, d, "fix_commit", "repo_name", "commit_hash", False)


def p1_fix_commit_hash_profile(spark: SparkSession, d: str) -> DataFrame:
    """Commits, those under several CVEs too, by their hash."""
    return _profile(spark, d, "fix_commit", "commit_hash", "cve_ordinal", False)


def p1_length_percentiles(spark: SparkSession, d: str) -> DataFrame:
    out = skew.key_percentiles(table(spark, d, "func"), F.col("repo_name"), F.length("func"), [0.25, 0.5, 0.75, 0.99])
    return out.select(F.col("key").alias("repo_name"), "prob", F.col("value").alias("n_chars"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.found(table(spark, d, "raw_record"))


def _entity(kind: str, path: str, level: str, fields: list[str]):
    def query(spark: SparkSession, d: str) -> DataFrame:
        raw = table(spark, d, "raw_record").where(F.col("kind") == kind)
        out = shred.entities(shred.adjacency(raw, "record_id", "payload", shred.paths_of([path], fields)), {path: level}, {f: f.lstrip("_") for f in fields})
        return out.drop("level", "node", "parent_node")

    return query


P4_TABLES = {
    "p4_commit": ("cve_record", "commits", "commit", ["commit_hash", "parent_commit_hash", "repo_name", "git_url"]),
    "p4_node": ("graph", "nodes", "node", ["id", "_label", "name", "code", "lineNumber"]),
    "p4_edge": ("graph", "edges", "edge", ["outNode", "inNode", "etype", "variable"]),
}


def p4_file(spark: SparkSession, d: str) -> DataFrame:
    """Files with the number of their commit within the record; the parent link holds through nodes of one shredding."""
    levels, fields = {"commits": "commit", "commits/files": "file"}, {"commit_hash": "commit_hash", "file_path": "file_path", "file_name": "file_name"}
    adj = shred.adjacency(table(spark, d, "raw_record").where("kind = 'cve_record'"), "record_id", "payload", shred.paths_of(levels, fields))
    both = shred.entities(adj, levels, fields)
    commit = both.where("level = 'commit'").select("record_id", F.col("node").alias("parent_node"), "commit_hash")
    return both.where("level = 'file'").drop("commit_hash").join(commit, ["record_id", "parent_node"]).select("record_id", "pos_path", "commit_hash", "file_path", "file_name")


def _linked(path: str, level: str, fields: list[str]):
    """A level of the CVE records with node and parent_node, which number the objects of a record alike in every table."""
    def query(spark: SparkSession, d: str) -> DataFrame:
        raw = table(spark, d, "raw_record").where("kind = 'cve_record'")
        return shred.entities(shred.adjacency(raw, "record_id", "payload", shred.paths_of([path], fields)), {path: level}, {f: f for f in fields}).drop("level")

    return query


P4_LINKED = {
    "p4_record": ("", "cve_record", ["cve_id", "description", "publish_date", "last_modify_date", "cvss_vector", "cvss_base_score", "cvss_base_severity", "cvss_is_v3"]),
    "p4_vul_func": (
        "commits/files/vulnerable_functions", "vul_func",
        ["func_name", "parameter_list_signature", "func_before", "func_after", "abstract_func_before", "abstract_func_after", "func_graph_path_before", "func_graph_path_after", "diff_func"],
    ),
    "p4_non_vul_func": ("commits/files/non_vulnerable_functions", "non_vul_func", ["func_name", "parameter_list_signature", "func", "func_graph_path"]),
}


def p4_object(spark: SparkSession, d: str) -> DataFrame:
    """Every object of every record with its parent object. p4_commit, p4_file, p4_node and p4_edge meet it on record_id,
    level and pos_path."""
    return shred.parts(table(spark, d, "raw_record")).where("kind = 'object'").select("record_id", "level", "node", "parent_node", "ordinal", "label_path", "pos_path")


def p4_scalar(spark: SparkSession, d: str) -> DataFrame:
    """Every scalar, null and empty array of every record with the object that holds it; ordinal is the place in a scalar array."""
    rows = shred.parts(table(spark, d, "raw_record")).where("kind <> 'object'")
    return rows.select("record_id", "parent_node", "label", "ordinal", "kind", F.col("scalar").alias("value"), "label_path", "pos_path")


def queries() -> dict:
    out = {f.__name__: f for f in (p1_found, p1_repo_profile, p1_commit_profile, p1_fix_commit_profile, p1_fix_commit_hash_profile, p1_length_percentiles, p4_found, p4_file, p4_object, p4_scalar)}
    return out | {name: _entity(*spec) for name, spec in P4_TABLES.items()} | {name: _linked(*spec) for name, spec in P4_LINKED.items()}


def _profile_sql(name: str, key: str, value: str, flag: bool) -> str:
    vul = "sum(vul)::BIGINT AS n_vul, sum(vul) / sum(n) AS vul_share, " if flag else ""
    hits = "count(*) FILTER (WHERE is_vul) AS vul, " if flag else ""
    return f"""
        WITH f AS (SELECT {key}, {value} AS v, {hits} count(*) AS n FROM {name} GROUP BY 1, 2)
        SELECT {key}, sum(n)::BIGINT AS n_rows, {vul} count(v) AS n_values,
               arg_min(v, (-n, v)) FILTER (WHERE v IS NOT NULL) AS mode,
               max(n) FILTER (WHERE v IS NOT NULL) AS mode_rows
        FROM f GROUP BY 1"""


def _items(json: str) -> str:
    """Elements of a JSON array with their positions; a bare object counts as an array of one."""
    return f"""(SELECT unnest(range(len(a))) AS pos, unnest(a) AS x FROM (SELECT CASE json_type({json})
        WHEN 'ARRAY' THEN ({json})::JSON[] WHEN 'OBJECT' THEN [({json})::JSON] ELSE [] END AS a))"""


_COMMITS = f"""c AS (SELECT record_id, pos::VARCHAR AS p, x FROM (SELECT record_id, payload::JSON AS j FROM raw_record
    WHERE kind = 'cve_record' AND json_valid(payload)) r, LATERAL {_items("r.j->'commits'")} e WHERE json_type(x) = 'OBJECT')"""
_FILES = f"""f AS (SELECT record_id, p || '/' || pos AS p, e.x, c.x->>'commit_hash' AS commit_hash
    FROM c, LATERAL {_items("c.x->'files'")} e WHERE json_type(e.x) = 'OBJECT')"""


def _graph(name: str) -> str:
    return f"""(SELECT record_id, pos, x FROM (SELECT record_id, payload::JSON AS j FROM raw_record
    WHERE kind = 'graph' AND json_valid(payload)) r, LATERAL {_items(f"r.j->'{name}'")} e WHERE json_type(x) = 'OBJECT')"""


def oracle_sql() -> dict[str, str]:
    out = {
        "p1_found": f"""SELECT repo_name FROM func WHERE repo_name IS NOT NULL GROUP BY 1
            HAVING count(*) > 0.025 * (SELECT count(*) FROM func)""",
        "p1_repo_profile": _profile_sql("func", "repo_name", "commit_hash", True),
        "p1_commit_profile": _profile_sql("func", "commit_hash", "func_name", True),
        "p1_fix_commit_profile": _profile_sql("fix_commit", "repo_name", "commit_hash", False),
        "p1_fix_commit_hash_profile": _profile_sql("fix_commit", "commit_hash", "cve_ordinal", False),
        "p4_record": "SELECT record_id, 0::BIGINT AS node, NULL::BIGINT AS parent_node, NULL::INTEGER AS ordinal, '' AS pos_path, "
            + ", ".join(f"CASE WHEN json_type(j->'{f}') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN j->>'{f}' END AS {f}" for f in "cve_id description publish_date last_modify_date cvss_vector cvss_base_score cvss_base_severity cvss_is_v3".split())
            + " FROM (SELECT record_id, payload::JSON AS j FROM raw_record WHERE kind = 'cve_record' AND json_valid(payload)) WHERE json_type(j) = 'OBJECT'",
        "p1_length_percentiles": """
            WITH r AS (SELECT repo_name, length(func)::BIGINT AS n_chars, row_number() OVER (PARTITION BY repo_name ORDER BY length(func)) AS rn,
                       count(*) OVER (PARTITION BY repo_name) AS n FROM func WHERE repo_name IS NOT NULL AND func IS NOT NULL)
            SELECT repo_name, p::DOUBLE AS prob, n_chars FROM r, (VALUES (0.25::DOUBLE), (0.5), (0.75), (0.99)) t(p)
            WHERE rn = greatest(1, ceil(n * p::DOUBLE))""",
        "p4_found": f"""
            WITH {_COMMITS}, {_FILES}, v AS (
                SELECT record_id, 'vul_func' AS level, p || '/' || pos AS p, e.x->>'func_name' AS k FROM f, LATERAL {_items("f.x->'vulnerable_functions'")} e WHERE json_type(e.x) = 'OBJECT'
                UNION ALL SELECT record_id, 'non_vul_func', p || '/' || pos, e.x->>'func_name' FROM f, LATERAL {_items("f.x->'non_vulnerable_functions'")} e WHERE json_type(e.x) = 'OBJECT')
            SELECT record_id, 'commit' AS level, p AS pos_path, x->>'commit_hash' AS child_key FROM c
            UNION ALL SELECT record_id, 'file', p, x->>'file_path' FROM f
            UNION ALL SELECT * FROM v
            UNION ALL SELECT record_id, 'node', pos::VARCHAR, x->>'id' FROM {_graph("nodes")}
            UNION ALL SELECT record_id, 'edge', pos::VARCHAR, (x->>'outNode') || '>' || (x->>'inNode') || ':' || (x->>'etype') FROM {_graph("edges")}""",
        "p4_file": f"""WITH {_COMMITS}, {_FILES} SELECT record_id, p AS pos_path, commit_hash, x->>'file_path' AS file_path, x->>'file_name' AS file_name FROM f""",
    }
    for name, (kind, path, _, fields) in P4_TABLES.items():
        cols = ", ".join(f"x->>'{f}' AS {f.lstrip('_')}" for f in fields)
        src = f"(SELECT record_id, p::BIGINT AS pos, x FROM c)" if kind == "cve_record" else _graph(path)
        # a bare object has no place in an array
        raw = f"SELECT record_id AS rid, json_type(payload::JSON->'{path}') = 'OBJECT' AS bare FROM raw_record WHERE kind = '{kind}' AND json_valid(payload)"
        out[name] = f"WITH {_COMMITS} SELECT record_id, CASE WHEN bare THEN NULL ELSE pos END::INTEGER AS ordinal, pos::VARCHAR AS pos_path, {cols} FROM {src} s JOIN ({raw}) b ON b.rid = s.record_id"
    return out
