"""Runs followed in a stream, with restarts, against the batch over the same events."""

import json
import random

from tests.test_runlog import event
from thermolake.operators import runlog as R
from thermolake.streaming import runs as S


def deliver(path, name, events):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(e) for e in events))


def statuses(frame):
    return {r.run_id: (r.job_name, r.status, r.duration_ms) for r in frame.collect()}


def test_overdue_runs_and_restarts(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    events, out, check = tmp_path / "events", f"{tmp_path}/out", f"{tmp_path}/check"
    drain = lambda: S.follow_runs(S.file_events(spark, str(events)), out, check, 20)
    first = [
        event("START", "a", 0), event("COMPLETE", "a", 1.5),
        event("START", "b", 2, "gold"), event("START", "c", 3, "gold"), event("START", "late", 1),
    ]
    deliver(events, "1.json", first)
    drain()
    assert statuses(S.reported(spark, out)) == {"a": ("silver", "COMPLETE", 1500)}
    second = [event("FAIL", "b", 30, "gold", "boom"), event("COMPLETE", "d", 31), event("START", "e", 40)]
    deliver(events, "2.json", second)
    drain()  # a new query from the checkpoint
    found = statuses(S.reported(spark, out))
    assert found["b"] == ("gold", "FAIL", 28_000)
    assert found["c"] == ("gold", "OVERDUE", None) and found["late"] == ("silver", "OVERDUE", None)
    assert "d" not in found and "e" not in found
    third = [event("START", "d", 45), event("COMPLETE", "late", 50), event("COMPLETE", "e", 55)]
    deliver(events, "3.json", third)
    drain()
    drain()  # nothing new
    found = statuses(S.reported(spark, out))
    batch = statuses(R.run_status(R.read_events(spark, str(events))))
    assert found.pop("c") == ("gold", "OVERDUE", None) and batch.pop("c") == ("gold", "OPEN", None)
    assert found == batch
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_order_within_a_drain_does_not_matter(spark, tmp_path):
    rnd = random.Random(2)
    events = []
    for i in range(60):
        events.append(event("START", f"r{i}", rnd.randrange(20)))
        if i % 4:
            events.append(event("FAIL" if i % 3 == 0 else "COMPLETE", f"r{i}", 20 + rnd.randrange(20)))
    rnd.shuffle(events)
    deliver(tmp_path / "events", "1.json", events)
    S.follow_runs(S.file_events(spark, str(tmp_path / "events")), f"{tmp_path}/out", f"{tmp_path}/check", 3600)
    batch = R.run_status(R.read_events(spark, str(tmp_path / "events"))).filter("status <> 'OPEN'")
    assert statuses(S.reported(spark, f"{tmp_path}/out")) == statuses(batch)
