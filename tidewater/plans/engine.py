"""Queries that run the engine's own operators over records made from the provided tables.

Every order becomes a record of the source, as JSON text; the tables that an operator
reads are frames instead of stored snapshots. The twins work on the plain columns.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import records
from tidewater.functions.paths import field_paths
from tidewater.operators import ingest, quality, transform
from tidewater.plans.schemas import SCHEMAS
from tidewater.sources.store import Store

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


def _kept(df: DataFrame) -> DataFrame:
    """The frame written once: as Parquet in the shared checkpoint folder, in plain local mode in a local one."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            return df.localCheckpoint()  # no folder that all executors share
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    path = f"{folder}/tables/engine-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Frames(Store):
    """A store whose tables are frames; what is written is kept, so that it is computed once."""

    def __init__(self, spark: SparkSession, **tables: DataFrame):
        self.spark, self.frames = spark, {k.replace("__", "."): v for k, v in tables.items()}

    def read(self, table: str, buckets=None) -> DataFrame:
        found = self.frames.get(table)
        return self.spark.createDataFrame([], SCHEMAS[table]) if found is None else found

    def replace(self, table: str, df: DataFrame) -> None:
        self.frames[table] = _kept(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]]))

    def append(self, table: str, df: DataFrame) -> None:
        old = self.read(table)
        self.replace(table, df)
        self.frames[table] = old.unionByName(self.frames[table])

    def rewrite(self, table: str, touched: DataFrame, change) -> None:
        self.replace(table, change(self.read(table)))


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as payloads; every seventh has no id, every eleventh a date that can't be read."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "RECRUITING").otherwise("PENDING")
    maker = lambda name, cls: F.struct(name.alias("name"), cls.alias("class"))
    module = F.struct(
        F.struct(F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("O"), k)).alias("nctId"), F.col("o_orderpriority").alias("briefTitle")).alias("identificationModule"),
        F.struct(
            status.alias("overallStatus"),
            F.struct(F.date_format(day, "yyyy-MM").alias("date")).alias("startDateStruct"),
            F.struct(F.when(k % 11 == 0, "soon").otherwise(day.cast("string")).alias("date")).alias("lastUpdatePostDateStruct"),
        ).alias("statusModule"),
        F.struct(F.array(F.lit("PHASE1"), F.when(k % 2 == 0, "PHASE2")).alias("phases"), F.struct(F.col("o_totalprice").cast("int").alias("count")).alias("enrollmentInfo")).alias("designModule"),
        F.struct(maker(F.concat(F.lit("S"), F.col("o_custkey") % 40), F.when(k % 3 != 0, F.concat(F.lit("K"), k % 5))).alias("leadSponsor")).alias("sponsorCollaboratorsModule"),
        F.struct(F.array(F.col("o_orderpriority"), F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")), F.lit(" "), status).alias("conditions")).alias("conditionsModule"),
        F.struct(F.array(F.struct(F.when(k % 2 == 0, "DRUG").alias("type"), F.lit("A ").alias("name")), F.struct(F.lit("DRUG").alias("type"), F.lit("A").alias("name"))).alias("interventions")).alias("armsInterventionsModule"),
        F.struct(F.when(k % 2 == 0, True).alias("healthyVolunteers"), F.repeat(F.lit("x"), (k % 9).cast("int")).alias("eligibilityCriteria")).alias("eligibilityModule"),
    )
    payload = F.to_json(F.struct(module.alias("protocolSection"), F.when(k % 5 == 0, True).alias("hasResults")))
    orders = _read(spark, d, "orders")
    # A small file is one task; records are long and slow to parse, so that every core gets some.
    dealt = orders.repartition(max(spark.sparkContext.defaultParallelism, orders.rdd.getNumPartitions()), "o_orderkey")
    return dealt.select("o_orderkey", payload.alias("payload"))


def _variants(spark: SparkSession, d: str) -> DataFrame:
    return _orders(spark, d).select("o_orderkey", F.try_parse_json("payload").alias("v"))


_GOOD = "o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0"
_STATUS = "case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'RECRUITING' else 'PENDING' end"


@query(f"""select case when o_orderkey % 7 = 0 then '' else 'O' || o_orderkey end as nct_id,
  case when o_orderkey % 11 = 0 then null else cast(o_orderdate as date) end as day, {_GOOD} as ok from orders""")
def engine_parse(spark, d):
    """Records without an id or a readable date are marked, not lost."""
    return ingest.parse(_orders(spark, d)).select("nct_id", F.col("last_update_post_date").alias("day"), "ok")


@query("""select event_id, sha256('{"a":' || json_extract_string(props, '$.k') || ',"b":[1,"x"]}') as h from events""")
def engine_content_hash(spark, d):
    """The hash doesn't depend on the order of keys or on spaces."""
    k = F.get_json_object("props", "$.k")
    text = F.concat(F.lit('{ "b": [1, "x"],  "a": '), k, F.lit("}"))
    return _read(spark, d, "events").select("event_id", records.content_hash(F.try_parse_json(text)).alias("h"))


@query(f"""select o_orderkey, o_orderpriority as brief_title, {_STATUS} as overall_status, cast(trunc(o_totalprice) as integer) as enrollment,
  'S' || o_custkey % 40 as lead_sponsor, case when o_orderkey % 3 <> 0 then 'K' || o_orderkey % 5 end as sponsor_class,
  cast(date_trunc('month', o_orderdate) as date) as start_date, case when o_orderkey % 2 = 0 then 'PHASE1|PHASE2' else 'PHASE1' end as phase,
  o_orderkey % 5 = 0 as has_results, case when o_orderkey % 2 = 0 then true end as healthy_volunteers, repeat('x', o_orderkey % 9) as eligibility_criteria
  from orders""")
def engine_flatten(spark, d):
    names = ["brief_title", "overall_status", "enrollment", "lead_sponsor", "sponsor_class", "start_date", "phase", "has_results", "healthy_volunteers", "eligibility_criteria"]
    return _variants(spark, d).select("o_orderkey", *records.flat_columns(F.col("v"))).select("o_orderkey", *names)


@query(f"""select o_orderkey, 0 as nth, o_orderpriority as condition from orders
  union all select o_orderkey, 1, {_STATUS} from orders""")
def engine_conditions(spark, d):
    """Trimmed before they are made distinct, in their order; blank ones go."""
    return _variants(spark, d).select("o_orderkey", F.posexplode(records.conditions(F.col("v"))).alias("nth", "condition"))


@query("""select o_orderkey, case when o_orderkey % 2 = 0 then 'DRUG' else 'UNKNOWN' end as intervention_type, 'A' as intervention_name from orders
  union all select o_orderkey, 'DRUG', 'A' from orders where o_orderkey % 2 <> 0""")
def engine_interventions(spark, d):
    return _variants(spark, d).select("o_orderkey", F.explode(records.interventions(F.col("v"))).alias("p")).select("o_orderkey", "p.*")


@query("""select o_orderkey, case o_orderkey % 5 when 0 then cast(o_orderdate as date) when 1 then cast(date_trunc('month', o_orderdate) as date)
  when 2 then cast(date_trunc('year', o_orderdate) as date) end as day from orders""")
def engine_partial_dates(spark, d):
    day = F.col("o_orderdate")
    forms = [F.date_format(day, p) for p in ("yyyy-MM-dd", "yyyy-MM", "yyyy")]
    text = F.when(F.col("o_orderkey") % 5 < 3, F.get(F.array(*forms), (F.col("o_orderkey") % 5).cast("int"))).when(F.col("o_orderkey") % 5 == 3, "2024-13")
    return _read(spark, d, "orders").select("o_orderkey", records.partial_date(text).alias("day"))


def _events(spark: SparkSession, d: str) -> DataFrame:
    """Events as parsed rows: ids repeat, so that an id has several versions."""
    return _read(spark, d, "events").select(
        F.concat(F.lit("U"), "user_id").alias("nct_id"), F.col("ts").cast("date").alias("last_update_post_date"),
        F.concat("event_type", F.lit("-"), "event_id").alias("content_hash"), F.col("event_id").cast("string").alias("payload"),
    )


@query("""select 'U' || user_id as nct_id, cast(ts as date) as day, event_type || '-' || event_id as content_hash from
  (select *, row_number() over (partition by user_id order by cast(ts as date) desc, event_type || '-' || event_id desc) as k from events) where k = 1""")
def engine_one_of_each(spark, d):
    return ingest.one_of_each(_events(spark, d)).select("nct_id", F.col("last_update_post_date").alias("day"), "content_hash")


def _raw(rows: DataFrame) -> DataFrame:
    at = F.lit(NOW).cast("timestamp")
    return rows.withColumns({c: at for c in ("first_seen_at", "last_seen_at", "last_changed_at")} | {"first_seen_run_id": F.lit(1), "last_seen_run_id": F.lit(1)})


@query("""with r as (select user_id, row_number() over (partition by user_id order by cast(ts as date) desc, event_type || '-' || event_id desc) as k from events)
select case when user_id % 3 = 0 then 'new' when user_id % 3 = 1 then 'changed' else 'unchanged' end as state, count(*) as n from r where k = 1 group by 1""")
def engine_classify(spark, d):
    rows = ingest.one_of_each(_events(spark, d))
    user = F.substring("nct_id", 2, 20).cast("long")
    current = _raw(rows).where(user % 3 != 0).withColumn("content_hash", F.when(user % 3 == 1, "old").otherwise(F.col("content_hash")))
    return ingest.classify(rows, current).groupBy("state").agg(F.count("*").alias("n"))


@query("""select 'U' || user_id as nct_id from (select distinct user_id from events) where user_id % 4 in (0, 1)""")
def engine_touched(spark, d):
    """What staging lacks or holds in another version."""
    rows = ingest.one_of_each(_events(spark, d))
    user = F.substring("nct_id", 2, 20).cast("long")
    staged = rows.where(user % 4 != 0).withColumn("content_hash", F.when(user % 4 == 1, "old").otherwise(F.col("content_hash")))
    store = Frames(spark, raw__studies=_raw(rows), staging__studies=staged)
    return transform.touched(store).select("nct_id")


def _loaded(spark: SparkSession, d: str) -> Frames:
    """All orders loaded, flattened and built into the marts by the engine."""
    store = Frames(spark)
    ingest.load_window(store, _orders(spark, d).select("payload"), 1, NOW)
    transform.build_staging(store, 1, NOW)
    transform.build_marts(store, 1, NOW)
    return store


_FACT = f"""select 'O' || o_orderkey as nct_id, o.o_custkey % 40 as s, {_STATUS} as overall_status, cast(trunc(o_totalprice) as integer) as enrollment,
  cast(date_trunc('month', o_orderdate) as date) as start_date, 2 as condition_count, cast(1 + o_orderkey % 2 as integer) as intervention_count,
  cast(o_orderkey % 9 as integer) as eligibility_char_len from orders o where {_GOOD}"""
_DIM = f"""select row_number() over (order by 'S' || s) as sponsor_key, 'S' || s as lead_sponsor, sponsor_class from
  (select o_custkey % 40 as s, arg_max('K' || o_orderkey % 5, cast(cast(o_orderdate as date) as varchar) || ' O' || o_orderkey) filter (where o_orderkey % 3 <> 0) as sponsor_class
   from orders where {_GOOD} group by 1)"""


@query(f"""with f as ({_FACT}), dim as ({_DIM})
select nct_id, sponsor_key, overall_status, enrollment, start_date, condition_count, intervention_count, eligibility_char_len
from f left join dim on lead_sponsor = 'S' || s""")
def engine_fact(spark, d):
    """The fact table after a load: dimension keys by a left join, child counts, lengths."""
    return _loaded(spark, d).read("marts.fct_trials").select(
        "nct_id", "sponsor_key", "overall_status", "enrollment", "start_date", "condition_count", "intervention_count", "eligibility_char_len"
    )


@query(_DIM)
def engine_sponsors(spark, d):
    """The dimension: keys in the order of names, the class of the latest record that states one."""
    return _loaded(spark, d).read("marts.dim_sponsor")


@query(f"""with f as ({_FACT}) select start_date as start_month, overall_status, count(*) as trials, cast(sum(enrollment) as bigint) as total_enrollment from f group by 1, 2""")
def engine_view(spark, d):
    return transform.trials_by_status_month(_loaded(spark, d))


@query(f"""select 'O' || o_orderkey as nct_id, o_orderpriority as condition from orders where {_GOOD}
  union all select 'O' || o_orderkey, {_STATUS} from orders where {_GOOD}""")
def engine_bridge(spark, d):
    return _loaded(spark, d).read("marts.bridge_trial_condition")


@query(f"""select count(*) as studies_fetched, count(*) filter (where not ({_GOOD})) as studies_skipped_no_id,
  count(*) filter (where {_GOOD}) as studies_new, cast(0 as bigint) as studies_changed, cast(0 as bigint) as studies_unchanged from orders""")
def engine_load_counts(spark, d):
    """A load's counters, of which one row goes to the metrics."""
    found = ingest.load_window(Frames(spark), _orders(spark, d).select("payload"), 1, NOW)
    return spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in found.items()])


@query(f"""with x as (select {_STATUS} as overall_status, o_orderkey, cast(trunc(o_totalprice) as integer) as enrollment, o_orderdate, o_custkey from orders where {_GOOD}),
 n as (select count(*) as n from x)
select 'freshness_raw' as check_name, cast(date_diff('day', (select cast(max(o_orderdate) as date) from x), date '2001-08-03') as double) as observed
union all select 'raw_staging_parity', 0 union all select 'history_covers_current', cast((select count(*) from x where o_orderkey % 13 = 0) as double)
union all select 'null_budget_brief_title', 0 union all select 'null_budget_overall_status', 0
union all select 'null_budget_eligibility_criteria', (select count(*) filter (where o_orderkey % 9 = 0) / count(*) from x)
union all select 'null_budget_lead_sponsor', 0 union all select 'unique_nct_id_staging', 0
union all select 'unique_nct_id_marts', (select count(*) from x where o_orderkey % 17 = 0) union all select 'ri_conditions_to_studies', 0
union all select 'ri_bridge_to_fct', 0 union all select 'ri_fct_to_dim_sponsor', (select count(*) + count(*) filter (where o_orderkey % 17 = 0) from x where o_custkey % 40 = 7)
union all select 'fct_staging_parity', -(select count(*) from x where o_orderkey % 17 = 0)
union all select 'accepted_values_overall_status', (select count(*) from x where overall_status = 'PENDING')
union all select 'enrollment_not_negative', 0 union all select 'completion_after_start', 0""")
def engine_checks(spark, d):
    """What every check of the suite observes, with some faults put in: history, repeated facts, a lost sponsor."""
    store = _loaded(spark, d)
    key = F.substring("nct_id", 2, 20).cast("long")
    store.frames["raw.studies_history"] = store.read("raw.studies_history").where(key % 13 != 0)
    fact = store.read("marts.fct_trials")
    store.frames["marts.fct_trials"] = fact.unionByName(fact.where(key % 17 == 0))
    store.frames["marts.dim_sponsor"] = store.read("marts.dim_sponsor").where("lead_sponsor <> 'S7'")
    found = None
    for c in quality.CHECKS:
        own = c.metric(store, dt.date(2001, 8, 3)).toDF("observed").select(F.lit(c.name).alias("check_name"), F.col("observed").cast("double"))
        found = own if found is None else found.union(own)
    return found


def _fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Event types as field paths, of two runs: one with the days up to the tenth, one with those after, less one type."""
    day = F.dayofmonth("ts")
    run = F.when(day <= 10, 1).otherwise(2)
    return (
        _read(spark, d, "events").where((day > 10) | (F.col("event_type") != "click")).groupBy(run.alias("run_id"))
        .agg(F.sort_array(F.collect_set("event_type")).alias("field_paths")).withColumn("id", F.col("run_id"))
    )


@query("""with a as (select distinct event_type as p from events where day(ts) > 10), b as (select distinct event_type as p from events where day(ts) <= 10 and event_type <> 'click')
select cast((select count(*) from (select * from a except select * from b)) + (select count(*) from (select * from b except select * from a)) as double) as observed,
 coalesce('added: ' || (select string_agg(p, ', ' order by p) from (select * from a except select * from b)), 'no change') as detail""")
def engine_schema_drift(spark, d):
    r = quality.check_schema_drift(Frames(spark, ops__schema_fingerprints=_fingerprints(spark, d)), 2)
    return spark.createDataFrame([(r.observed, r.detail)], "observed double, detail string")


@query("""with f as (select day(ts) as run_id, count(*) as n from events group by 1),
 past as (select n from f where run_id < 30 and run_id % 5 <> 0 order by run_id desc limit 7)
select round((select n from f where run_id = 30) / (select median(n) from past), 3) as ratio""")
def engine_volume_anomaly(spark, d):
    runs = _read(spark, d, "events").groupBy(F.dayofmonth("ts").alias("run_id")).agg(F.count("*").cast("double").alias("value"))
    status = F.when((F.col("run_id") % 5 == 0) | (F.col("run_id") == 30), "failed").otherwise("succeeded")
    store = Frames(
        spark, ops__run_metrics=runs.withColumn("metric", F.lit("studies_fetched")),
        ops__pipeline_runs=runs.select("run_id", F.lit("daily").alias("job"), status.alias("status")),
    )
    return spark.createDataFrame([(quality.check_volume_anomaly(store, 30).observed,)], "ratio double")


@query("""select unnest(['a', 'a[].b', 'a[].b.c', 'k', 'k.' || 'x']) as path, count(*) as n from events group by 1""")
def engine_field_paths(spark, d):
    """Nested fields to a depth of three names; of an array its first element."""
    k = F.get_json_object("props", "$.k")
    text = F.concat(F.lit('{"a": [{"b": {"c": {"e": 1}}}, {"z": 2}], "k": {"x": '), k, F.lit("}}"))
    return field_paths(_read(spark, d, "events").select(F.try_parse_json(text).alias("v")), "v").groupBy("path").agg(F.count("*").alias("n"))


@query("""select c_custkey, n_nationkey as key from customer, nation where c_nationkey = n_nationkey and c_custkey % 2 = 0
  union all select c_custkey, -1 from customer where c_custkey % 2 = 1""")
def engine_replace_children(spark, d):
    """Children of the touched parents are replaced through the store, those of others stay."""
    old = _read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("nct_id"), F.col("c_nationkey").cast("string").alias("condition"))
    store = Frames(spark, staging__study_conditions=old)
    parents = old.where(F.col("nct_id").cast("long") % 2 == 1).select("nct_id")
    transform.replace_children(store, "staging.study_conditions", parents, parents.withColumn("condition", F.lit("-1")))
    return store.read("staging.study_conditions").select(F.col("nct_id").cast("long").alias("c_custkey"), F.col("condition").cast("int").alias("key"))


@query("""select cast(user_id as varchar) as stream, max(cast(ts as date)) as last_value from events where user_id % 2 = 0 group by 1
  union all select cast(user_id as varchar), min(cast(ts as date)) from events where user_id % 2 = 1 group by 1""")
def engine_upsert(spark, d):
    """Rows replace those with equal keys; others stay."""
    day = F.col("ts").cast("date")
    both = _read(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("stream")).agg(F.min(day).alias("low"), F.max(day).alias("high"))
    rows = lambda c: both.select("stream", F.col(c).alias("last_value"), F.lit(NOW).cast("timestamp").alias("updated_at"))
    store = Frames(spark, ops__watermarks=rows("low"))
    store.upsert("ops.watermarks", rows("high").where(F.col("stream").cast("long") % 2 == 0), ["stream"])
    return store.read("ops.watermarks").select("stream", "last_value")
