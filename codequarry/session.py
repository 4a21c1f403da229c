"""Sessions, shared scratch storage and size-checked joins used by every operator."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str | int = "*", app: str = "codequarry", **conf) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once a session."""
    global _shipped
    sc = spark.sparkContext
    if _shipped == sc.applicationId:
        return
    package = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="codequarry-py-"))  # the driver serves this file to the executors
    atexit.register(shutil.rmtree, to, ignore_errors=True)
    with zipfile.ZipFile(to / "codequarry.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for f in package.rglob("*.py"):
            z.write(f, f"codequarry/{f.relative_to(package)}")
    sc.addPyFile(str(to / "codequarry.zip"))
    _shipped = sc.applicationId


_shipped = ""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where it is unset, a folder of this process, if the session runs in this
    process alone; on a cluster, whose executors would each write to a disk of their own, it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="codequarry-")
        spark.conf.set("spark.checkpoint.dir", root)
        atexit.register(shutil.rmtree, root.removeprefix("file://"), ignore_errors=True)
    return root


class Scratch:
    """Writes intermediate tables to the shared folder, which cuts lineage and outlives lost executors.

    Tables that later steps no longer read are removed with drop(). What a returned DataFrame still reads stays until
    the application ends.
    """

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark, self.root = spark, f"{scratch_root(spark)}/codequarry-{uuid.uuid4().hex}"
        self.n = 0
        _open.append(self)

    def save(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """df, written and read again; by a column, each of whose values has a folder that can be read alone."""
        self.n += 1
        path = f"{self.root}/t{self.n}"
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.__dict__["_scratch_path"] = path
        return out

    def drop(self, *dfs: DataFrame | None) -> None:
        for df in dfs:
            if df is not None and (path := df.__dict__.pop("_scratch_path", None)):
                self._delete(path)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def close(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # the session may be gone
            pass


_open: list[Scratch] = []


@atexit.register
def _close_all() -> None:
    for s in _open:
        s.close()


#: A side is broadcast when it has at most this many rows; larger sides go through a shuffle.
BROADCAST_ROWS = 100_000


def hot_keys(counts: DataFrame, key: str, n: str, total: int, share: float = 0.001, least: int = 100_000) -> DataFrame:
    """Keys of counts(key, n) with more rows than max(least, share * total): never more than 1 / share of them."""
    limit = max(least, int(share * total))
    return counts.where(F.col(n) > limit).select(key, F.ceil(F.col(n) / F.lit(limit)).cast("int").alias("_ways"))


def salted_join(rows: DataFrame, small: DataFrame, key: str, hot: DataFrame, spread: Column, how: str = "inner") -> DataFrame:
    """Join rows with small (one row for each key) although some keys hold most rows.

    hot(key, _ways) comes from hot_keys(), so it is bounded and may be broadcast. Rows of a hot key are dealt by spread
    over _ways copies of its row in small; all other keys join as they are.
    """
    h = F.broadcast(hot)
    left = rows.join(h, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce(F.col("_ways"), F.lit(1))).cast("int")).drop("_ways")
    right = small.join(h, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ways"), F.lit(1)) - 1))).drop("_ways")
    return left.join(right, [key, "_salt"], how).drop("_salt")
