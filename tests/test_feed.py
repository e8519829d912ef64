import pytest
from pyspark.sql import functions as F

from gavelspark.plans.feed import run_job
from gavelspark.streaming import feed as X


def test_deletes_of_a_page(spark):
    rows = [("a", 1, "updated", None, "n1"), ("a", 2, "deleted", "z", "n1"), ("a", 3, "updated", None, "n1"), ("b", 4, "deleted", None, "n2"), ("c", 5, "updated", None, "n2"), ("d", 6, "deleted", None, "n3"), ("e", 7, "updated", None, "n4"), ("f", 8, "updated", None, "n4"), ("g", 9, "deleted", None, "n4"), ("h", 10, "deleted", None, None)]
    page = spark.createDataFrame(rows, "k string, seq int, change string, into string, nat string")
    got = {r.k: (r.seq, r.outcome, r.target) for r in X.resolve_deletes(page, "k", "seq", "change", "into", "nat").collect()}
    assert got == {"a": (2, "merged", "z"), "b": (4, "rematched", "c"), "c": (5, "updated", None), "d": (6, "tombstoned", None), "e": (7, "updated", None), "f": (8, "updated", None), "g": (9, "tombstoned", None), "h": (10, "tombstoned", None)}
    assert X.resolve_deletes(page.limit(0), "k", "seq", "change", "into", "nat").count() == 0


def test_reconcile_resumes_at_its_cursor(spark, tmp_path):
    want = spark.createDataFrame([(i, i % 3) for i in range(50) if i % 5], "k int, v int")
    have = spark.createDataFrame([(i, i % 2) for i in range(50) if i % 4] + [(None, 1)], "k int, v int")
    whole = {r.k: r.action for r in X.reconcile_in_pages(want, have, "k", ["v"], 7).collect()}
    expected = {i: "insert" if i % 4 == 0 else "delete" if i % 5 == 0 else "keep" if i % 3 == i % 2 else "update" for i in range(50) if i % 5 or i % 4}
    assert whole == expected
    base = f"file://{tmp_path}/pages"
    X.reconcile_in_pages(want.filter("k < 20"), have.filter("k < 20"), "k", ["v"], 7, base)
    assert {r.k: r.action for r in X.reconcile_in_pages(want, have, "k", ["v"], 7, base).collect()} == expected
    assert X.reconcile_in_pages(want.limit(0), have.limit(0), "k", ["v"], 7).count() == 0


def test_drain_takes_the_due_in_order(spark):
    rows = [(1, "PENDING", 5, 1, 0, 200), (2, "PENDING", 5, 0, 0, 422), (3, "PENDING", 99, 0, 0, 200), (4, "DELIVERED", 1, 0, 0, 200), (5, "PENDING", 1, 1, 59, 503), (6, "PENDING", 1, 1, 3, None)]
    outbox = spark.createDataFrame(rows, "id int, status string, due_at int, priority int, attempts int, http int")
    got = [(r.id, r.position, r.chunk, r.state) for r in X.drain_outbox(outbox, F.lit(10), ["priority", "due_at", "id"], 2, "http").orderBy("position").collect()]
    assert got == [(2, 1, 0, "REJECTED"), (5, 2, 0, "UNAVAILABLE"), (6, 3, 1, "PENDING"), (1, 4, 1, "DELIVERED")]


def test_replays_are_suppressed_only_if_proven(spark):
    entries = spark.createDataFrame([("a", 1, "REJECTED", "UPDATE", "h"), ("b", 1, "REJECTED", "UPDATE", "h"), ("b", 2, "DELIVERED", "UPDATE", "h"), ("c", 1, "REJECTED", "CREATE", "h"), ("d", 1, "REJECTED", "UPDATE", None), ("e", 1, "REJECTED", "UPDATE", "old")], "k string, n int, status string, op string, payload_hash string")
    rows = spark.createDataFrame([(k, "h") for k in "abcef"] + [("d", None)], "k string, payload_hash string")
    assert {r.k for r in X.suppressed_replays(entries, rows, "k", "n").collect() if r.suppressed} == {"a"}


def test_redrive_and_supersede(spark):
    rows = [(1, "k", "x", 1, "UNAVAILABLE"), (2, "k", "x", 2, "UNAVAILABLE"), (3, "k", "y", 1, "UNAVAILABLE"), (4, "k", "x", 9, "UNAVAILABLE"), (5, "m", "x", 1, "PENDING"), (6, "m", "x", 2, "PENDING"), (7, "m", "x", 3, "DELIVERED")]
    outbox = spark.createDataFrame(rows, "id int, key string, kind string, at int, status string")
    assert {r.id: r.status for r in X.redrive(outbox, "x", F.lit(5), 1).collect()} == {1: "PENDING", 2: "UNAVAILABLE", 3: "UNAVAILABLE", 4: "UNAVAILABLE", 5: "SUPERSEDED", 6: "PENDING", 7: "DELIVERED"}


def test_cycles_isolate_and_back_off():
    def fail() -> int:
        raise ValueError

    rows, streak, wait = X.run_cycle([("a", lambda: 1), ("b", fail), ("c", lambda: 3)], 2)
    assert rows == [("a", "ok", 1), ("b", "failed", None), ("c", "ok", 3)] and (streak, wait) == (3, 240)
    assert X.run_cycle([("b", fail)], 60)[1:] == (61, 3600) and X.run_cycle([("a", lambda: 1)], 9)[1:] == (0, 60)


def test_jobs(spark):
    seen = []
    df = spark.range(3)
    assert run_job(lambda: df, lambda d: seen.append(d.count())) == 0 and seen == [3]
    assert run_job(lambda: df, lambda d: seen.append(d.count()), dry_run=True) == 4 and seen == [3]
    assert run_job(lambda: df, lambda d: seen.append(d.count()), {"x": 1}, ("y",)) == 2 and seen == [3]
    assert run_job(lambda: df.select(F.raise_error(F.lit("no"))), lambda d: seen.append(d.count())) == 1 and seen == [3]
    with pytest.raises(TypeError):
        run_job()


def test_run_ledger(spark):
    rows = [("a", "open", 1, None), ("a", "close", 61, "done"), ("b", "open", 1, None), ("c", "open", 99, None), ("d", "shot", 5, "ok"), ("a", "close", 31, "failed")]
    ledger = spark.createDataFrame(rows, "run_id string, entry string, at int, outcome string").withColumn("at", F.timestamp_seconds("at"))
    got = {r.run_id: (r.outcome, r.seconds) for r in X.run_states(ledger, F.timestamp_seconds(F.lit(50))).collect()}
    assert got == {"a": ("done", 60), "b": ("lost", None), "c": ("running", None), "d": ("ok", None)}
