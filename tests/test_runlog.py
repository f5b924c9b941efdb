"""Run events read from JSON lines (FIXTURES.md A7)."""

import json

import pytest

from thermolake.operators import runlog as R


def event(kind, run, second, job="silver", message=None, **changes):
    facets = {"errorMessage": {"message": message, "programmingLanguage": "PYTHON"}} if message else {}
    return {
        "eventType": kind, "eventTime": f"2024-03-01T08:00:{second:06.3f}+00:00",
        "run": {"runId": run, "facets": facets}, "job": {"namespace": "n", "name": job},
        "producer": "p", "inputs": [], "outputs": [], **changes,
    }


def test_runs_errors_conformance_and_pivot(spark, tmp_path):
    events = [
        event("START", "a", 0), event("COMPLETE", "a", 1.25),
        event("START", "b", 2, "gold"), event("FAIL", "b", 3, "gold", "ValueError: boom"),
        event("START", "c", 4, "gold", producer=None), event("RUNNING", "c", 9, "gold"),
    ]
    (tmp_path / "e.jsonl").write_text("\n".join(json.dumps(e) for e in events))
    df = R.read_events(spark, str(tmp_path / "e.jsonl"))
    runs = {r.run_id: (r.status, r.duration_ms) for r in R.run_status(df).collect()}
    assert runs == {"a": ("COMPLETE", 1250), "b": ("FAIL", 1000), "c": ("OPEN", None)}
    assert [tuple(r) for r in R.run_errors(df).collect()] == [("b", "gold", "ValueError: boom", "PYTHON")]
    missing = {r.field: (r.events, r.missing, r.conforms) for r in R.conformance(df).collect()}
    assert missing["producer"] == (6, 1, False) and missing["run.runId"] == (6, 0, True)
    (tmp_path / "broken.jsonl").write_text("{not json")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        R.read_events(spark, str(tmp_path / "broken.jsonl")).collect()
    pivot = {r.job_name: tuple(r)[1:] for r in R.events_per_job(df).collect()}
    assert pivot == {"silver": (1, 1, 0), "gold": (2, 0, 1)}
