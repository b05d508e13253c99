import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def same_rows(duck, spark_df, sql):
    """How many rows the query and its SQL don't share; columns by name."""
    import pyarrow as pa

    got, want = pa.table(spark_df.toArrow()), duck.execute(sql).to_arrow_table()
    cols = sorted(want.column_names)
    assert cols == sorted(got.column_names)
    duck.register("want", want.select(cols))
    duck.register("got", got.select(cols))
    n = duck.execute("select count(*) from ((from want except all from got) union all (from got except all from want))").fetchone()[0]
    return n, want.num_rows
