"""One local session for all tests, and makers of synthetic records."""

import json
import os
import sys
import zlib

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def made_record(key: str, date: str, title: str) -> dict:
    """A payload made from its key: the same for the same key; module names are the source's."""
    own = zlib.crc32(key.encode())
    names = [f"ailment {chr(97 + k)}" for k in range(3)]
    modules = {
        "identification": {"nctId": key, "briefTitle": title, "officialTitle": f"On {title}, number {own % 100}"},
        "status": {"overallStatus": "COMPLETED", "startDateStruct": {"date": "2024-11"}, "completionDateStruct": {"date": "2026-02-14", "type": "ACTUAL"}, "lastUpdatePostDateStruct": {"date": date}},
        "design": {"studyType": "OBSERVATIONAL", "phases": ["EARLY_PHASE1", "PHASE1", "PHASE4"], "enrollmentInfo": {"count": 37}},
        "sponsorCollaborators": {"leadSponsor": {"name": "Aster", "class": "NETWORK"}, "collaborators": []},
        "conditions": {"conditions": names, "keywords": names[:1]},
        "armsInterventions": {"interventions": [{"type": kind, "name": f"remedy {k}"} for k, kind in enumerate(["BIOLOGICAL", "OTHER", "DEVICE"])]},
        "eligibility": {"eligibilityCriteria": "One.\nTwo.\nThree.", "healthyVolunteers": True, "sex": "FEMALE", "minimumAge": "6 Months"},
    }
    return {"protocolSection": {f"{name}Module": body for name, body in modules.items()}, "hasResults": False}


@pytest.fixture
def record():
    """record(id, date, title) -> a payload that a test may change."""
    return lambda nct_id="R-7", date="2026-08-27", title="Sleep": made_record(nct_id, date, title)


@pytest.fixture
def frame(spark):
    """frame(records or texts) -> a frame of payloads."""

    def make(records):
        rows = [(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False),) for r in records]
        return spark.createDataFrame(rows, "payload string")

    return make


@pytest.fixture
def store(spark, tmp_path):
    from tidewater.sources.store import Store

    s = Store(spark, str(tmp_path / "wh"), buckets=2)
    s.migrate()
    return s
