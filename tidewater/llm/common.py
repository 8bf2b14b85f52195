"""What several training-data operators share: table access, lineage cuts, components."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is used where it does the same: on pure ASCII."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower())
    )


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Rows and bytes of an Arrow batch that a Python worker holds at a time.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limits of Arrow batches, so that whole texts don't fill the workers; never raise them."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if not spark.conf.isModifiable(key):  # not known to this version
            continue
        now = spark.conf.get(key).rstrip("bB")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, most)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use spark.checkpoint.dir; fall back to a local folder in plain local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def cut(df: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame) -> DataFrame:
    """Like ``cut``, as Parquet: computed once and compressed, where an eager checkpoint computes its last stage twice."""
    return written(df, "kept")


#: Rows of a table of keys up to which it may be broadcast (about 40 bytes each).
BROADCAST_LIMIT = 250_000


def small(keys: DataFrame) -> DataFrame:
    """The keys, written and counted; marked for broadcast only if they are few."""
    keys = kept(keys)
    return F.broadcast(keys) if keys.count() <= BROADCAST_LIMIT else keys


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet to the shared checkpoint folder and read again."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(low, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _found_locally(edges: DataFrame) -> DataFrame:
    """(node, component) of edges (u, v) of longs, few enough for the driver."""
    table = edges.toArrow()
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for u, v in zip(table["u"].to_pylist(), table["v"].to_pylist(), strict=True):
        x, y = root(u), root(v)
        up[max(x, y)] = min(x, y)
    nodes = pa.table({"node": pa.array(list(up), pa.int64()), "component": pa.array([root(x) for x in list(up)], pa.int64())})
    return edges.sparkSession.createDataFrame(nodes)


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60, local: int = 0) -> DataFrame:
    """(node, component) for every node of a link; component is its smallest node.

    Alternating large-star and small-star rounds: each round is two grouped
    minima and two equi-joins, so no vertex's neighbourhood is ever collected,
    and a path of n nodes takes O(log n) rounds or so. Every round is written to
    the shared checkpoint folder; only a count and a checksum reach the driver.
    Links of a node to itself are ignored; nulls must not occur. Up to ``local``
    distinct links between longs are solved on the driver, with the same result.
    """
    x, y = F.col(a), F.col(b)
    edges = kept(
        links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    )
    if local and edges.count() <= local:
        return _found_locally(edges)
    seen = None
    for _ in range(max_rounds):
        mark = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(mark) == seen or mark[0] == 0:
            break
        seen = tuple(mark)
        edges = kept(_small_star(_large_star(edges)))
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
