"""Every query with a twin gives the twin's rows on the small tables."""

import datetime as dt
import glob
import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewater.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(rows):
    return [tuple(round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, dt.date) else v for v in r) for r in rows]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_twin(spark, duck, name):
    df, twin = QUERIES[name](spark, SF), duck.sql(ORACLES[name])
    cols = sorted(df.columns)
    assert sorted(twin.columns) == cols
    key = lambda rows: sorted(map(repr, plain([tuple(r) for r in rows]) if name != "left_dim_join" else rows))
    assert key([tuple(r) for r in df.select(*cols).collect()]) == key(twin.select(*cols).fetchall())


def test_frames_keep_what_is_written(spark, tmp_path):
    """A table of the engine's queries is computed once, when it is written, and not by each of its readers."""
    from tidewater.plans.engine import Frames

    path, store = str(tmp_path / "metrics"), Frames(spark)
    spark.createDataFrame([(1, "fetched", 2.0)], "run_id long, metric string, value double").write.parquet(path)
    store.append("ops.run_metrics", spark.read.parquet(path))
    store.append("ops.run_metrics", spark.read.parquet(path).withColumn("run_id", F.lit(2)))
    shutil.rmtree(path)
    assert sorted(r.run_id for r in store.read("ops.run_metrics").collect()) == [1, 2]
