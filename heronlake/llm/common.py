"""Shared plumbing of the corpus operators: scratch tables, batch limits and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of texts that a worker works on at once; texts can be long.
ARROW_ROWS = 256


def scratch_dir(spark: SparkSession) -> str:
    """The folder shared by the cluster's machines (``spark.checkpoint.dir``).

    Only where the session names none and runs on one machine (tests, a laptop) a temporary folder is made, used and
    removed at exit; on a cluster each executor would write to a disk of its own, so a missing setting is an error there.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    own = getattr(spark.sparkContext, "_heronlake_scratch", None)
    if own is None:
        own = tempfile.mkdtemp(prefix="heronlake-")
        spark.sparkContext._heronlake_scratch = own
        atexit.register(shutil.rmtree, own, True)
    return f"file://{own}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/heronlake/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df to a table in the shared folder and read it back: the lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """Views of at most ``rows`` rows: bounds what a worker turns into Python objects, without a setting of the session.

    The bytes of a batch are bounded by Spark itself (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB unless set).
    """
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names for work columns that none of ``columns`` has, however they are spelled (Spark's names ignore case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star steps.

    edges: two columns of one orderable type. Rows with a null end and loops are ignored, repeated rows count once.
    Returns (node, root): each node that has an edge, with the smallest node that it reaches (a root maps to itself).
    Every round groups with map-side minima and ends in a written table, so nothing grows on the driver; rounds
    follow the logarithm of the longest chain. No edges: no rows.
    """
    star = materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "cc",
    )
    seen = _mark(star)
    while seen[0]:
        both = star.select("u", "v").unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") > F.col("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        star = materialise(small, "cc")
        now = _mark(star)
        if now == seen:
            break
        seen = now
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(star: DataFrame) -> tuple:
    """Count and order-free hash of an edge table: equal marks mean that a round changed nothing."""
    return tuple(star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


class Recent:
    """A bounded memory of two generations: what the older one held and nobody asked for again is forgotten."""

    def __init__(self, make, size: int):
        self.make, self.size = make, size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, key: str) -> bytes:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[key] = found
        return found
