"""Queries over the provided tables, one for each operator of the engine, and their DuckDB twins.

Each works on whole tables. Sums of money go through decimals, so that both
engines add exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.functions import paths

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register the function under its name, with its twin."""

    def keep(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return keep


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exact_sum(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


@query("""select cast(date_trunc('month', o_orderdate) as date) as month, o_orderstatus as status,
       count(*) as n_orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
  from orders group by 1, 2""")
def status_month_rollup(spark, d):
    """Monthly roll-up by status (the view over the fact table)."""
    return (
        _read(spark, d, "orders")
        .groupBy(F.trunc("o_orderdate", "MM").alias("month"), F.col("o_orderstatus").alias("status"))
        .agg(F.count("*").alias("n_orders"), _exact_sum("o_totalprice").alias("total"))
    )


@query("""select coalesce(cast(count(*) filter (where nullif(o_orderpriority, '4-NOT SPECIFIED') is null) as double)
       / nullif(count(*), 0), 0) as null_ratio from orders""")
def null_budget_ratio(spark, d):
    value = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    return _read(spark, d, "orders").agg(
        F.coalesce(F.try_divide(F.count_if(value.isNull()), F.count("*")), F.lit(0.0)).alias("null_ratio")
    )


@query("""select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1""")
def duplicate_keys(spark, d):
    return (
        _read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")
    )


@query("""select o_orderkey from orders o where not exists (select 1 from lineitem where l_orderkey = o.o_orderkey)""")
def anti_orphans(spark, d):
    lines = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return _read(spark, d, "orders").select("o_orderkey").join(lines, "o_orderkey", "left_anti")


@query("""select doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def anti_unlabelled(spark, d):
    return _read(spark, d, "documents").select("doc_id").join(_read(spark, d, "labels"), "doc_id", "left_anti")


@query("""select (select count(*) from orders) - (select count(distinct l_orderkey) from lineitem) as gap""")
def parity_gap(spark, d):
    a = _read(spark, d, "orders").agg(F.count("*").alias("a"))
    b = _read(spark, d, "lineitem").agg(F.count_distinct("l_orderkey").alias("b"))
    return a.crossJoin(b).select((F.col("a") - F.col("b")).alias("gap"))  # one row each


@query("""select o_orderkey, c.c_mktsegment as segment from orders
  left join (select * from customer where c_acctbal >= 0) c on o_custkey = c.c_custkey""")
def left_dim_join(spark, d):
    dim = _read(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return _read(spark, d, "orders").join(dim, "o_custkey", "left").select("o_orderkey", F.col("c_mktsegment").alias("segment"))


@query("""select distinct l_orderkey, l_partkey from lineitem join orders on l_orderkey = o_orderkey
  where o_orderstatus = 'F'""")
def bridge_inner(spark, d):
    kept = _read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return _read(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct().join(kept, "l_orderkey", "left_semi")


@query("""select o_orderkey, (select count(*) from lineitem where l_orderkey = o_orderkey) as n_lines from orders""")
def child_counts(spark, d):
    n = _read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return (
        _read(spark, d, "orders").select("o_orderkey").join(n, "o_orderkey", "left")
        .select("o_orderkey", F.coalesce("n", F.lit(0)).cast("long").alias("n_lines"))
    )


@query("""select count(*) as outside from events where event_type is not null
  and event_type not in (select distinct event_type from events where event_type <> 'error')""")
def accepted_values(spark, d):
    events = _read(spark, d, "events").where("event_type is not null").select("event_type")
    known = events.where("event_type <> 'error'").distinct()
    return events.join(known, "event_type", "left_anti").agg(F.count("*").alias("outside"))


@query("""select count(*) as negative from customer where c_acctbal < 0""")
def negative_values(spark, d):
    return _read(spark, d, "customer").where("c_acctbal < 0").agg(F.count("*").alias("negative"))


@query("""select count(*) as violations from lineitem join orders on l_orderkey = o_orderkey where l_shipdate < o_orderdate""")
def date_order_violations(spark, d):
    orders = _read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return (
        _read(spark, d, "lineitem").select("l_orderkey", "l_shipdate").join(orders, "l_orderkey")
        .where("l_shipdate < o_orderdate").agg(F.count("*").alias("violations"))
    )


@query("""select coalesce(date_diff('day', cast(max(o_orderdate) as date), date '2001-08-10'), 9999) as days from orders""")
def freshness_days(spark, d):
    days = F.datediff(F.lit("2001-08-10").cast("date"), F.max("o_orderdate").cast("date"))
    return _read(spark, d, "orders").agg(F.coalesce(days, F.lit(9999)).cast("long").alias("days"))


@query("""with days as (select cast(ts as date) as day, count(*) as n from events group by 1),
  last as (select n from days order by day desc limit 1),
  past as (select n from days where day < (select max(day) from days) order by day desc limit 7)
select (select percentile_cont(0.5) within group (order by n) from past) as median,
       (select n from last) / (select percentile_cont(0.5) within group (order by n) from past) as ratio""")
def median_volume(spark, d):
    days = _read(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    ranked = days.orderBy(F.desc("day")).limit(8).withColumn("k", F.row_number().over(W.orderBy(F.desc("day"))))
    return ranked.agg(
        F.median(F.when(F.col("k") > 1, F.col("n"))).alias("median"), F.max(F.when(F.col("k") == 1, F.col("n"))).alias("n")
    ).select("median", (F.col("n") / F.col("median")).alias("ratio"))


@query("""select event_type, count(*) filter (where value >= 50) as passes, count(*) filter (where value < 50) as fails,
       max(ts) filter (where value < 50) as last_failed,
       round(100.0 * count(*) filter (where value >= 50) / nullif(count(*), 0)) as pass_rate
  from events group by 1""")
def check_pass_rates(spark, d):
    good = F.col("value") >= 50
    return (
        _read(spark, d, "events").groupBy("event_type")
        .agg(
            F.count_if(good).alias("passes"),
            F.count_if(F.col("value") < 50).alias("fails"),
            F.max(F.when(F.col("value") < 50, F.col("ts"))).alias("last_failed"),
            F.round(F.try_divide(F.lit(100.0) * F.count_if(good), F.count("*"))).alias("pass_rate"),
        )
    )


@query("""select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem where l_orderkey in
  (select o_orderkey from orders order by o_orderdate desc, o_orderkey desc limit 20)""")
def last_runs_topk(spark, d):
    last = (
        _read(spark, d, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20)
        .select(F.col("o_orderkey").alias("l_orderkey"))
    )
    return (
        _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
        .join(F.broadcast(last), "l_orderkey", "left_semi")
    )


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("select user_id, " + ", ".join(
    f"count(*) filter (where event_type = '{t}') as {t}" for t in EVENT_TYPES) + " from events group by 1")
def metrics_pivot(spark, d):
    wide = _read(spark, d, "events").groupBy("user_id").pivot("event_type", EVENT_TYPES).agg(F.count(F.lit(1)))
    return wide.select("user_id", *[F.coalesce(t, F.lit(0)).cast("long").alias(t) for t in EVENT_TYPES])


@query("""select doc_id, sha256(text) as content_hash, length(text) as n from documents""")
def content_hash_docs(spark, d):
    return _read(spark, d, "documents").select(
        "doc_id", F.sha2("text", 256).alias("content_hash"), F.length("text").cast("long").alias("n")
    )


@query("""select distinct source, sha256(text) as content_hash from documents""")
def distinct_versions(spark, d):
    return _read(spark, d, "documents").select("source", F.sha2("text", 256).alias("content_hash")).distinct()


_SPLIT = "(select max(o_orderkey) from orders)"


@query(f"""with cur as (select o_orderkey, o_totalprice from orders where o_orderkey <= {_SPLIT} * 2 / 3),
  inc as (select o_orderkey, case when o_orderkey % 3 = 0 then o_totalprice + 1 else o_totalprice end as price
            from orders where o_orderkey > {_SPLIT} / 3)
select case when c.o_orderkey is null then 'new' when c.o_totalprice is distinct from i.price then 'changed'
            else 'unchanged' end as state, count(*) as n
  from inc i left join cur c using (o_orderkey) group by 1""")
def classify_upsert(spark, d):
    """New, changed and unchanged: one join of what comes in to what is there."""
    orders = _read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    top = F.broadcast(orders.agg(F.max("o_orderkey").alias("top")))  # one row
    both = orders.crossJoin(top)
    current = both.where("o_orderkey <= top * 2 / 3").select("o_orderkey", F.col("o_totalprice").alias("old"), F.lit(True).alias("there"))
    price = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    incoming = both.where("o_orderkey > top / 3").select("o_orderkey", price.alias("price"))
    state = (
        F.when(F.col("there").isNull(), "new").when(~F.col("old").eqNullSafe(F.col("price")), "changed").otherwise("unchanged")
    )
    return incoming.join(current, "o_orderkey", "left").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@query("""select user_id, event_id, event_type, value from
  (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k = 1""")
def merge_latest(spark, d):
    """Latest row of each key: max over a struct, so that partial maxima come before the shuffle."""
    last = _read(spark, d, "events").groupBy("user_id").agg(
        F.max(F.struct("ts", "event_id", "event_type", "value")).alias("e")
    )
    return last.select("user_id", "e.event_id", "e.event_type", "e.value")


@query("""select c_nationkey, arg_max(c_mktsegment, c_custkey) filter (where c_mktsegment <> 'BUILDING') as segment
  from customer group by 1""")
def coalesce_dim_upsert(spark, d):
    value = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return (
        _read(spark, d, "customer").groupBy("c_nationkey")
        .agg(F.max_by(value, F.when(value.isNotNull(), F.col("c_custkey"))).alias("segment"))
    )


@query("""select l_orderkey, l_linenumber, l_partkey from lineitem
    where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P')
  union all select o_orderkey, 1, -1 from orders where o_orderstatus = 'P'""")
def child_rewrite(spark, d):
    """Children of touched parents are replaced, those of others stay."""
    touched = _read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    old = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    kept = old.join(touched, "l_orderkey", "left_anti")
    new = touched.select("l_orderkey", F.lit(1).alias("l_linenumber"), F.lit(-1).cast("long").alias("l_partkey"))
    return kept.unionByName(new)


@query("""select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events""")
def json_extract(spark, d):
    v = F.try_parse_json("props")
    return _read(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "int").alias("k"))


@query("""with o as (select distinct cast(o_orderdate as date) as day from orders),
  s as (select distinct cast(l_shipdate as date) as day from lineitem)
select 'removed' as side, day from (select * from o except select * from s)
union all select 'added', day from (select * from s except select * from o)""")
def set_diff(spark, d):
    """Both differences of two sets in one pass: which sides a value was seen on."""
    seen = (
        _read(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"), F.lit(1).alias("side"))
        .unionByName(_read(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), F.lit(2).alias("side")))
        .groupBy("day").agg(F.min("side").alias("a"), F.max("side").alias("b"))
    )
    return seen.where("a = b").select(F.when(F.col("a") == 1, "removed").otherwise("added").alias("side"), "day")


@query("""select o_custkey, string_agg(p, '|' order by p) as phases from
  (select distinct o_custkey, o_orderpriority as p from orders) group by 1""")
def array_join_phase(spark, d):
    return _read(spark, d, "orders").groupBy("o_custkey").agg(
        F.array_join(F.sort_array(F.collect_set("o_orderpriority")), "|").alias("phases")
    )


@query("""select distinct unnest(json_keys(props)) as path from events""")
def schema_paths(spark, d):
    return paths.field_paths(_read(spark, d, "events").select(F.try_parse_json("props").alias("v")), "v").distinct()


@query("""select event_id, ts from events where cast(ts as date) between date '2024-01-05' and date '2024-01-09'""")
def inclusive_window(spark, d):
    return _read(spark, d, "events").where("ts >= timestamp_ntz '2024-01-05' and ts < timestamp_ntz '2024-01-10'").select("event_id", "ts")


@query("""select cast(date_diff('day', date '2024-01-01', cast(ts as date)) // 7 as bigint) as chunk, count(*) as n,
  min(cast(ts as date)) as first_day, max(cast(ts as date)) as last_day from events group by 1""")
def backfill_chunks(spark, d):
    day = F.col("ts").cast("date")
    chunk = F.floor(F.datediff(day, F.lit("2024-01-01").cast("date")) / 7).cast("long")
    return _read(spark, d, "events").groupBy(chunk.alias("chunk")).agg(
        F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


from tidewater.plans import engine  # noqa: E402  the engine's own operators, in the same registry

QUERIES |= engine.QUERIES
ORACLES |= engine.ORACLES
