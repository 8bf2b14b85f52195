import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater import cli, status
from tidewater.config import Config
from tidewater.operators import ingest, quality, transform
from tidewater.streaming import jobs

NOW = dt.datetime(2026, 8, 28, 12, tzinfo=dt.timezone.utc)
TODAY = dt.date(2026, 8, 28)


def load(store, frame, rows, run_id=1, minutes=0):
    now = NOW + dt.timedelta(minutes=minutes)
    found = ingest.load_window(store, frame(rows), run_id, now)
    return found | transform.build_staging(store, run_id, now) | transform.build_marts(store, run_id, now)


def counts(store):
    return [store.read(t).count() for t in ("raw.studies", "raw.studies_history", "staging.studies", "marts.fct_trials")]


def test_replay_changes_nothing(store, frame, record):
    rows = [record(f"N{i}") for i in range(5)]
    first = load(store, frame, rows)
    assert (first["studies_new"], first["studies_unchanged"], first["staging_conditions"]) == (5, 0, 15)
    before = counts(store)
    again = load(store, frame, rows, 2, 1)
    assert (again["studies_new"], again["studies_unchanged"]) == (0, 5) and counts(store) == before
    r = store.read("raw.studies").first()
    assert (r.first_seen_run_id, r.last_seen_run_id) == (1, 2) and r.last_changed_at < r.last_seen_at


def test_versions(store, frame, record):
    a, b = record(title="A"), record(title="B", date="2026-08-28")
    for k, x in enumerate([a, b, a]):
        load(store, frame, [x], k + 1, k)
    assert counts(store) == [1, 2, 1, 1]
    assert store.read("staging.studies").first().brief_title == "A"


def test_skips_and_repeats(store, frame, record):
    bad_date = record("N2", date="soon")
    found = load(store, frame, [record("N1", "2026-08-01", "old"), record("N1", "2026-08-02", "new"), record(""), bad_date, "{oops"])
    assert (found["studies_fetched"], found["studies_skipped_no_id"], found["studies_new"]) == (5, 3, 1)
    assert store.read("raw.studies_history").count() == 1
    assert store.read("staging.studies").first().brief_title == "new"


def test_child_removal(store, frame, record):
    r = record()
    load(store, frame, [r, record("N2")])
    r["protocolSection"]["conditionsModule"]["conditions"] = ["ailment b"]
    load(store, frame, [r], 2, 1)
    own = store.read("marts.bridge_trial_condition").where("nct_id = 'R-7'").collect()
    assert [x.condition for x in own] == ["ailment b"]
    assert store.read("staging.study_conditions").count() == 4
    fact = {x.nct_id: x.condition_count for x in store.read("marts.fct_trials").collect()}
    assert fact == {"R-7": 1, "N2": 3}


def test_sponsors(store, frame, record):
    rows = [record("N1", "2026-08-01"), record("N2", "2026-08-02"), record("N3"), record("N4")]
    lead = lambda r: r["protocolSection"]["sponsorCollaboratorsModule"]["leadSponsor"]
    lead(rows[1])["class"] = "OTHER"
    lead(rows[2]).update({"name": "Beta", "class": None})
    lead(rows[3]).pop("name")
    load(store, frame, rows)
    dim = {r.lead_sponsor: (r.sponsor_key, r.sponsor_class) for r in store.read("marts.dim_sponsor").collect()}
    assert dim == {"Aster": (1, "OTHER"), "Beta": (2, None)}
    lead(rows[0])["class"] = None
    lead(rows[2])["name"] = "Aaa"
    load(store, frame, rows[:1] + rows[2:3], 2, 1)
    dim = {r.lead_sponsor: (r.sponsor_key, r.sponsor_class) for r in store.read("marts.dim_sponsor").collect()}
    assert dim == {"Aster": (1, "OTHER"), "Beta": (2, None), "Aaa": (3, None)}
    keys = {r.nct_id: r.sponsor_key for r in store.read("marts.fct_trials").collect()}
    assert keys == {"N1": 1, "N2": 1, "N3": 3, "N4": None}


def test_view(store, frame, record):
    load(store, frame, [record("N1"), record("N2")])
    row = transform.trials_by_status_month(store).collect()
    assert [tuple(r) for r in row] == [(dt.date(2024, 11, 1), "COMPLETED", 2, 74)]


def test_suite_passes_and_fails(store, frame, record, monkeypatch):
    load(store, frame, [record(f"N{i}") for i in range(6)])
    good = quality.run_checks(store, 1, NOW, TODAY)
    assert good["failed_error"] == 0 and good["run"] == 18 and good["blocking_failures"] == []
    store.replace("staging.studies", store.read("staging.studies").where("nct_id <> 'N3'"))
    bad = quality.run_checks(store, 1, NOW, TODAY)
    assert {"raw_staging_parity", "ri_conditions_to_studies", "fct_staging_parity"} <= set(bad["blocking_failures"])

    def broken(store, today):
        raise ValueError("no such thing")

    monkeypatch.setattr(quality, "CHECKS", [quality.Check("broken", "x", "error", broken)])
    assert quality.run_checks(store, 1, NOW, TODAY)["blocking_failures"] == ["broken"]
    assert store.read("ops.test_results").where("check_name = 'broken' and status = 'fail'").count() == 1


def test_compare():
    c = lambda how: quality.Check("c", "t", "warn", None, 2, how)
    assert [c("lte").passed(x) for x in (1, 2, 3, None)] == [True, True, False, False]
    assert [c("gte").passed(x) for x in (1, 2, 3)] == [False, True, True]
    assert [c("eq").passed(x) for x in (1, 2)] == [False, True]


def source_of(frame, rows):
    def read(spark, start, end):
        day = lambda r: dt.date.fromisoformat(r["protocolSection"]["statusModule"]["lastUpdatePostDateStruct"]["date"])
        return frame([r for r in rows if start <= day(r) <= end])

    return read


def test_daily(store, frame, record):
    cfg = Config(store.root)
    rows = [record(f"N{i}", "2026-08-27") for i in range(7)]
    first = jobs.run_daily(store, cfg, TODAY, source_of(frame, rows))
    assert first["window"] == ["2026-08-26", "2026-08-28"] and jobs.get_watermark(store, "daily") == TODAY
    again = jobs.run_daily(store, cfg, TODAY + dt.timedelta(days=1), source_of(frame, rows + [record("N9", "2026-08-28")]))
    assert again["window"] == ["2026-08-28", "2026-08-29"] and again["metrics"]["studies_new"] == 1
    page = status.render(store)
    assert "succeeded" in page and "freshness_raw" in page and "100%" in page


def test_gate_holds_the_watermark(store, frame, record):
    cfg, old = Config(store.root), TODAY - dt.timedelta(days=5)
    jobs.set_watermark(store, "daily", old)
    rows = [record(f"N{i}", "2026-08-27") for i in range(3)]
    rows[0]["protocolSection"]["designModule"]["enrollmentInfo"]["count"] = -1
    with pytest.raises(jobs.QualityGateFailed):
        jobs.run_daily(store, cfg, TODAY, source_of(frame, rows))
    assert jobs.get_watermark(store, "daily") == old
    run = store.read("ops.pipeline_runs").first()
    assert run.status == "failed" and "enrollment_not_negative" in run.error

    def down(spark, start, end):
        raise OSError("<down>")

    with pytest.raises(OSError):
        jobs.run_daily(store, cfg, TODAY, down)
    assert "&lt;down&gt;" in status.render(store)


def test_backfill_resumes(store, frame, record):
    cfg = Config(store.root)
    rows = [record(f"N{i}", f"2026-08-{i + 1:02d}") for i in range(9)]
    good, days = source_of(frame, rows), (dt.date(2026, 8, 1), dt.date(2026, 8, 9))

    def breaks(spark, start, end):
        if start > dt.date(2026, 8, 3):
            raise OSError("down")
        return good(spark, start, end)

    with pytest.raises(OSError):
        jobs.run_backfill(store, cfg, *days, 3, breaks)
    assert store.read("staging.studies").count() == 3
    assert jobs.run_backfill(store, cfg, *days, 3, good)["metrics"]["studies_fetched"] == 6
    assert counts(store) == [9, 9, 9, 9]
    assert jobs.run_backfill(store, cfg, *days, 3, good) == {"run_id": None, "status": "already_complete"}
    with pytest.raises(ValueError):
        jobs.run_backfill(store, cfg, days[1], days[0])


def test_drift_and_volume(store, frame, record):
    load(store, frame, [record()])
    r = record("N2")
    r["novel"] = {"field": 1}
    load(store, frame, [r], 2, 1)
    drift = quality.check_schema_drift(store, 2)
    assert not drift.passed and drift.observed == 2 and "novel.field" in drift.detail
    assert not quality.check_schema_drift(store, 3).passed  # a run of checks alone compares the last two
    assert quality.check_schema_drift(store, 1).passed
    for n in (100, 110, 90):
        run = jobs.start_run(store, "daily")
        jobs.record_metrics(store, run, {"studies_fetched": n})
        jobs.finish_run(store, run, "succeeded")
    run = jobs.start_run(store, "daily")
    assert quality.check_volume_anomaly(store, run).passed
    jobs.record_metrics(store, run, {"studies_fetched": 10})
    found = quality.check_volume_anomaly(store, run)
    assert not found.passed and found.observed == 0.1


def test_status_without_runs_and_cli(store, spark, monkeypatch, tmp_path, capsys):
    assert "No runs yet." in status.render(store)
    with pytest.raises(RuntimeError):
        Config.from_env({})
    monkeypatch.setenv("TIDEWATER_WAREHOUSE", store.root)
    monkeypatch.setenv("TIDEWATER_STATUS_PAGE", str(tmp_path / "s" / "index.html"))
    assert Config.from_env().page_size == 1000
    assert cli.main(["migrate"], spark) == 0 and cli.main(["status"], spark) == 0
    assert (tmp_path / "s" / "index.html").exists()
    assert cli.main(["checks"], spark) == 1  # an empty warehouse isn't fresh
    rows = [("{}", TODAY)]
    read = lambda s, a, b: s.createDataFrame(rows, "payload string, last_update_post_date date")
    cfg = Config.from_env()
    assert cli.verify_api(spark, cfg, read, TODAY) == 0
    assert cli.verify_api(spark, cfg, read, TODAY - dt.timedelta(days=9)) == 1


def test_flow_tries_again_and_writes_the_page(store, frame, record, tmp_path):
    tries, good = [], source_of(frame, [record(f"N{i}", "2026-08-27") for i in range(3)])

    def flaky(spark, start, end):
        tries.append(start)
        if len(tries) == 1:
            raise OSError("down")
        return good(spark, start, end)

    cfg = Config(store.root, status_page=str(tmp_path / "s" / "p.html"))
    found = jobs.daily_flow(store, cfg, TODAY, flaky, (0,))
    assert found["status"] == "succeeded" and len(tries) == 2 and (tmp_path / "s" / "p.html").exists()
    assert [r.status for r in store.read("ops.pipeline_runs").orderBy("run_id").collect()] == ["failed", "succeeded"]


def test_a_lock_that_was_left_behind_is_taken_over(store, monkeypatch):
    from tidewater.sources import store as module

    with store.writer():
        monkeypatch.setattr(module, "LOCK_SECONDS", -1)
        with store.writer():
            pass
        monkeypatch.undo()
    with store.writer():
        pass


def test_one_writer(store):
    with store.writer(), pytest.raises(RuntimeError), store.writer():
        pass
    with store.writer():
        pass


def test_old_versions_go(store, spark):
    for k in range(6):
        jobs.set_watermark(store, "s", dt.date(2026, 1, 1) + dt.timedelta(days=k))
    m = store.manifest("ops.watermarks")
    assert m["version"] == 7 and store.read("ops.watermarks").count() == 1
    assert store.read("ops.watermarks").where(F.col("last_value") == dt.date(2026, 1, 6)).count() == 1
