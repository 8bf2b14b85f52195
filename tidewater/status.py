"""A static page of runs and checks."""

from __future__ import annotations

import os
from html import escape

from pyspark.sql import functions as F

from tidewater.sources.store import Store

RUNS = 20


def fetch(store: Store) -> dict:
    """What the page shows: a few bounded frames."""
    runs = store.read("ops.pipeline_runs").orderBy(F.desc("run_id")).limit(RUNS)
    values = store.read("ops.run_metrics").join(F.broadcast(runs.select("run_id")), "run_id", "left_semi").collect()
    metrics: dict = {}
    for r in values:
        metrics.setdefault(r.run_id, {})[r.metric] = r.value
    failed = F.col("status") == "fail"
    checks = (
        store.read("ops.test_results")
        .groupBy("check_name", "severity")
        .agg(
            F.count_if(~failed).alias("passes"),
            F.count_if(failed).alias("fails"),
            F.max(F.when(failed, F.col("created_at"))).alias("last_failed"),
        )
        .orderBy(F.desc("fails"), "check_name")
    )
    return {
        "runs": runs.collect(),
        "metrics": metrics,
        "last_success": store.read("ops.pipeline_runs").where("status = 'succeeded'").orderBy(F.desc("run_id")).limit(1).collect(),
        "checks": checks.collect(),
        "rows": {t: store.read(t).count() for t in ("raw.studies", "raw.studies_history", "marts.fct_trials")},
    }


def _text(value) -> str:
    if value is None:
        return "-"
    if hasattr(value, "hour"):
        return f"{value:%Y-%m-%d %H:%M}"
    return escape(str(value))


def _number(value) -> str:
    return "-" if value is None else f"{value:,.0f}"


def _table(head: list[str], rows: list[list[str]]) -> str:
    th = "".join(f"<th>{h}</th>" for h in head)
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<table><thead><tr>{th}</tr></thead><tbody>{body}</tbody></table>"


def render(store: Store) -> str:
    d = fetch(store)
    runs = []
    for r in d["runs"]:
        m = d["metrics"].get(r.run_id, {})
        own = [_number(m.get(f"studies_{k}")) for k in ("fetched", "new", "changed", "unchanged")]
        bad = f"{_number(m.get('checks_failed_error'))}/{_number(m.get('checks_failed_warn'))}"
        window = f"{_text(r.window_start)} to {_text(r.window_end)}" if r.window_start else "-"
        runs.append([_text(r.run_id), _text(r.job), _text(r.status), window, _text(r.started_at), *own, bad, _text((r.error or "")[:200])])
    checks = [
        [_text(c.check_name), _text(c.severity), _number(c.passes), _number(c.fails),
         f"{100 * c.passes / (c.passes + c.fails):.0f}%", _text(c.last_failed)]
        for c in d["checks"]
    ]
    last = d["last_success"][0].finished_at if d["last_success"] else None
    sums = " &middot; ".join(f"{escape(t)}: {_number(n)} rows" for t, n in d["rows"].items())
    head = ["Run", "Job", "Status", "Window", "Started", "Fetched", "New", "Changed", "Unchanged", "Failed (error/warn)", "Error"]
    return (
        '<!doctype html><html lang="en"><head><meta charset="utf-8"><title>Pipeline status</title></head><body>'
        f"<h1>Pipeline status</h1><p>Last success: {_text(last)}</p><p>{sums}</p><h2>Runs</h2>"
        + (_table(head, runs) if runs else "<p>No runs yet.</p>")
        + "<h2>Checks</h2>"
        + _table(["Check", "Severity", "Passes", "Fails", "Pass rate", "Last failed"], checks)
        + "</body></html>"
    )


def write(store: Store, path: str) -> str:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(render(store))
    return path
