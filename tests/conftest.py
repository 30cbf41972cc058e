import os

import pytest
from pyspark.sql import SparkSession

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[*]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", f"file://{shared}").config("spark.sql.warehouse.dir", str(shared / "warehouse")).getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(columns, found):
    """Rows as sorted tuples in column-name order, numbers made comparable."""

    def plain(v):
        if isinstance(v, float):
            return round(v, 9)
        return v if v is None or isinstance(v, (str, bool)) else int(v) if v == int(v) else v

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


@pytest.fixture(scope="session")
def same_as_sql(spark, duck, sf_dir):
    def check(query, sql):
        df = query(spark, sf_dir)
        want = duck.sql(sql)
        names = list(want.columns)
        assert sorted(df.columns) == sorted(names)
        assert rows(df.columns, df.collect()) == rows(names, want.fetchall())

    return check
