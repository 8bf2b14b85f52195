"""Incremental jobs: a daily window from the watermark, and a resumable backfill.

The position is a table of dates, not a streaming checkpoint: after a failure the
next daily window reaches from the old position to the new day, where a replayed
micro-batch would cover the old range only.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.config import Config
from tidewater.operators import ingest, quality, transform
from tidewater.plans.schemas import RUN_STATUSES, SCHEMAS
from tidewater.sources.paged import PagedSource
from tidewater.sources.store import Store

DAILY = "daily"
Source = Callable[[SparkSession, dt.date, dt.date], DataFrame]


class QualityGateFailed(RuntimeError):
    pass


def api_source(cfg: Config) -> Source:
    def read(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
        spark.dataSource.register(PagedSource)
        options = {"url": cfg.api_url, "start": str(start), "end": str(end), "requestsPerMinute": str(cfg.requests_per_minute),
                   "maxRetries": str(cfg.max_retries), "pageSize": str(cfg.page_size)}
        return spark.read.format("paged_studies").options(**options).load()

    return read


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


# --- run log, metrics, positions ----------------------------------------------


def start_run(store: Store, job: str, start: dt.date | None = None, end: dt.date | None = None) -> int:
    last = store.read("ops.pipeline_runs").agg(F.coalesce(F.max("run_id"), F.lit(0))).first()[0]
    row = (last + 1, job, start, end, _utc_now(), None, "running", None)
    store.append("ops.pipeline_runs", store.spark.createDataFrame([row], SCHEMAS["ops.pipeline_runs"]))
    return last + 1


def finish_run(store: Store, run_id: int, status: str, error: str | None = None) -> None:
    if status not in RUN_STATUSES:
        raise ValueError(f"unknown status {status}")
    mine = F.col("run_id") == run_id
    runs = store.read("ops.pipeline_runs")
    store.replace(
        "ops.pipeline_runs",
        runs.withColumns({
            "status": F.when(mine, F.lit(status)).otherwise(F.col("status")),
            "error": F.when(mine, F.lit(error[:4000] if error else None).cast("string")).otherwise(F.col("error")),
            "finished_at": F.when(mine, F.lit(_utc_now()).cast("timestamp")).otherwise(F.col("finished_at")),
        }),
    )


def record_metrics(store: Store, run_id: int, metrics: dict[str, float]) -> None:
    if metrics:
        rows = [(run_id, k, float(v)) for k, v in metrics.items()]
        store.upsert("ops.run_metrics", store.spark.createDataFrame(rows, SCHEMAS["ops.run_metrics"]), ["run_id", "metric"])


def get_watermark(store: Store, stream: str) -> dt.date | None:
    row = store.read("ops.watermarks").where(F.col("stream") == stream).first()
    return row.last_value if row else None


def set_watermark(store: Store, stream: str, value: dt.date) -> None:
    row = store.spark.createDataFrame([(stream, value, _utc_now())], SCHEMAS["ops.watermarks"])
    store.upsert("ops.watermarks", row, ["stream"])


# --- jobs ------------------------------------------------------------------------


def process_and_check(store: Store, source: Source, run_id: int, start: dt.date, end: dt.date) -> dict:
    """Load, transform and check one window; the suite's summary with the metrics."""
    now = _utc_now()
    metrics = ingest.load_window(store, source(store.spark, start, end), run_id, now)
    record_metrics(store, run_id, metrics)
    metrics |= transform.build_staging(store, run_id, now, now) | transform.build_marts(store, run_id, now)
    return _check(store, run_id, metrics, end)


def _check(store: Store, run_id: int, metrics: dict, today: dt.date) -> dict:
    summary = quality.run_checks(store, run_id, _utc_now(), today)
    metrics |= {f"checks_{k}": summary[k] for k in ("passed", "failed_error", "failed_warn")}
    record_metrics(store, run_id, metrics)
    return summary | {"metrics": metrics}


def _gated(store: Store, run_id: int, work: Callable[[], dict], passed: Callable[[], None]) -> dict:
    """Run ``work``; finish the run whatever happens; ``passed`` only without blocking failures."""
    try:
        summary = work()
    except Exception as e:
        finish_run(store, run_id, "failed", f"{type(e).__name__}: {e}")
        raise
    if summary["blocking_failures"]:
        said = "blocking checks failed: " + ", ".join(summary["blocking_failures"])
        finish_run(store, run_id, "failed", said)
        raise QualityGateFailed(said)
    passed()
    finish_run(store, run_id, "succeeded")
    return summary


def run_daily(store: Store, cfg: Config, today: dt.date | None = None, source: Source | None = None) -> dict:
    """Load from the watermark to today, both included; move it only after the gate."""
    today = today or _utc_now().date()
    with store.writer():
        store.migrate()
        start = get_watermark(store, DAILY) or today - dt.timedelta(days=cfg.lookback_days)
        run_id = start_run(store, DAILY, start, today)
        summary = _gated(
            store,
            run_id,
            lambda: process_and_check(store, source or api_source(cfg), run_id, start, today),
            lambda: set_watermark(store, DAILY, today),
        )
    return {"run_id": run_id, "window": [str(start), str(today)], "status": "succeeded", "metrics": summary["metrics"],
            "checks": {k: summary[k] for k in ("run", "passed", "failed_error", "failed_warn")}}


def run_backfill(
    store: Store, cfg: Config, start: dt.date, end: dt.date, chunk_days: int = 7, source: Source | None = None
) -> dict:
    """Load a range in chunks; one that is stopped goes on after its last whole chunk.

    Each chunk is loaded and transformed before its position is kept, so that a
    stopped backfill leaves no loaded rows behind that nothing transforms. The
    last position is kept only after the gate.
    """
    if not start or not end or start > end:
        raise ValueError("a backfill needs a start and an end that isn't before it")
    stream = f"backfill:{start}:{end}"
    read = source or api_source(cfg)
    with store.writer():
        store.migrate()
        last = get_watermark(store, stream)
        at = last + dt.timedelta(days=1) if last else start
        if at > end:
            return {"run_id": None, "status": "already_complete"}
        run_id = start_run(store, "backfill", at, end)

        def work() -> dict:
            nonlocal at
            total: dict[str, float] = {}
            while at <= end:
                stop = min(at + dt.timedelta(days=chunk_days - 1), end)
                now = _utc_now()
                part = ingest.load_window(store, read(store.spark, at, stop), run_id, now)
                # What this chunk saw, and what staging lacks: chunks before it aren't transformed again.
                part |= transform.build_staging(store, run_id, now, now) | transform.build_marts(store, run_id, now)
                if stop < end:
                    set_watermark(store, stream, stop)
                for k, v in part.items():
                    total[k] = total.get(k, 0) + v
                at = stop + dt.timedelta(days=1)
            record_metrics(store, run_id, total)
            return _check(store, run_id, total, end)

        summary = _gated(store, run_id, work, lambda: set_watermark(store, stream, end))
    return {"run_id": run_id, "status": "succeeded", "metrics": summary["metrics"]}


def run_suite(store: Store) -> dict:
    """The quality suite alone, as a run of its own."""
    with store.writer():
        store.migrate()
        run_id = start_run(store, "checks")
        try:
            summary = quality.run_checks(store, run_id, _utc_now(), _utc_now().date())
        except Exception as e:
            finish_run(store, run_id, "failed", str(e))
            raise
        bad = summary["blocking_failures"]
        finish_run(store, run_id, "failed" if bad else "succeeded", "blocking checks failed: " + ", ".join(bad) if bad else None)
    return summary | {"run_id": run_id}


def with_retries(work: Callable[[], object], delays: tuple[float, ...] = (30, 120, 300), sleep=time.sleep):
    """Try again after each delay; a gate that fails isn't tried again."""
    for delay in delays:
        try:
            return work()
        except (QualityGateFailed, ValueError):
            raise
        except Exception:  # noqa: BLE001
            sleep(delay)
    return work()


def daily_flow(store: Store, cfg: Config, today: dt.date | None = None, source: Source | None = None, delays=(30, 120, 300)) -> dict:
    """The daily job with retries; the status page is written on success and on failure."""
    from tidewater import status

    try:
        return with_retries(lambda: run_daily(store, cfg, today, source), delays)
    finally:
        status.write(store, cfg.status_page)
