import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    s = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", str(base / "warehouse")).config("spark.checkpoint.dir", str(base / "checkpoints")).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.execute(f"create view {t.removesuffix('.parquet')} as select * from '{DATA}/{t}'")
    return con


def rows_of(cols, rows):
    def plain(v):
        if isinstance(v, float):
            return repr(round(v, 6))
        return str(v).removesuffix(" 00:00:00")

    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def same(spark, duck):
    def check(df, sql):
        have = rows_of(df.columns, [tuple(r) for r in df.collect()])
        cur = duck.execute(sql)
        want = rows_of([d[0] for d in cur.description], cur.fetchall())
        assert have[0] == want[0]
        assert have[1] == want[1]
    return check
