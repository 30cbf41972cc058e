"""One place that builds sessions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "heronlake", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ANSI mode stays on, so untrusted casts are written as try_cast."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.config(map=conf).getOrCreate() if conf else b.getOrCreate()
