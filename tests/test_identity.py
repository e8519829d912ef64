from gavelspark.operators import identity as I
from gavelspark.operators import temporal as T


def test_identities(spark):
    rows = [
        ("a", "gap", 1, 1950, 1), ("a", "gap", 2, 1990, 1),
        ("a", "solo", 3, 1990, 1), ("a", "solo", 3, 1990, 1),
        ("a", "crosser", 4, 2005, 1), ("a", "crosser", 5, 2011, 1),
        ("a", "lost", 6, 2005, 1), ("a", "lost", 7, 2011, 9),
        ("a", "twins", 8, 2005, 1), ("a", "twins", 9, 2011, 1),
        ("a", "tail", 10, 2007, 1), ("a", "split", 11, 1960, 1), ("a", "split", 12, 2001, 1), ("a", "told", 13, 2005, 1), ("a", "told", 14, 2011, 9),
        ("a", None, 15, 1990, 1), ("a", "noyear", 16, None, 1), ("a", "late", 17, 2015, 1),
    ]
    records = spark.createDataFrame(rows, "scope string, fold string, id int, year int, seat int")
    seated = [("a", "crosser", 1, 2011, "m1"), ("a", "twins", 1, 2011, "m2"), ("a", "twins", 1, 2011, "m3"), ("a", "tail", 1, 2009, "m4"), ("b", "lost", 9, 2011, "m5")]
    seatings = spark.createDataFrame(seated, "scope string, fold string, seat int, year int, member string")
    splits = spark.createDataFrame([("a", "split", 2000)], "scope string, fold string, boundary int")
    decided = spark.createDataFrame([("a", "told", None)], "scope string, fold string, member string")
    got = {(r.id, r.disposition, r.identity, r.reason) for r in I.resolve_identities(records, seatings, 2009, splits, decided).collect()}
    assert got == {
        (1, "refused", None, "wide_gap"), (2, "refused", None, "wide_gap"), (3, "minted", "solo:1990", None), (4, "joined", "m1", None), (6, "refused", None, "unresolved"),
        (8, "refused", None, "ambiguous"), (10, "joined", "m4", None), (11, "minted", "split:1960", None), (12, "minted", "split:2001", None), (13, "minted", "told:2005", None),
    }
    assert I.resolve_identities(records.limit(0), seatings, 2009, splits, decided).count() == 0


def test_winners(spark):
    won = [("c", 1, 1, ["ann"], "Position 1"), ("c", 1, 2, ["moved"], "Position 2"), ("c", 2, 3, ["lee"], None), ("c", 2, 4, ["ray"], "Position 1"), ("c", 3, 5, ["gone"], None), ("c", 4, 6, ["moved"], "Position 1"), ("c", 5, 7, None, "Position 1"), ("c", 6, 8, ["dup"], "Position 1"), ("c", 6, 9, ["dup"], "Position 2")]
    winners = spark.createDataFrame(won, "cohort string, seat int, id int, keys array<string>, qualifier string")
    roster = spark.createDataFrame([("c", 1, "A", "ann"), ("c", 2, "L", "lee"), ("c", 2, "M", "lee"), ("c", 4, "S", "stand"), ("c", 6, "D", "dup")], "cohort string, seat int, member string, surname string")
    senators = spark.createDataFrame([("c", 1, "X", "moved"), ("c", 4, "X", "moved")], "cohort string, seat int, member string, surname string")
    told, seats = I.project_winners(winners, roster, senators)
    assert {r.id: r.outcome for r in told.collect()} == {1: "direct", 2: "mover", 3: "ambiguous", 4: "unresolved", 5: "unmatched", 6: "mover", 7: "unresolved", 8: "direct", 9: "duplicate"}
    assert {(r.id, r.member, r.qualifier, r.inferred) for r in seats.collect()} == {(1, "A", "Position 1", False), (8, "D", "Position 1", False), (6, "S", "Position 1", True)}


def test_active_reconcile_under_guards(spark):
    frame = lambda rows: spark.createDataFrame(rows, "g string, k int")
    cohort = spark.createDataFrame([("a", i, True) for i in range(4)] + [("a", 9, False), ("a", 8, True), ("b", 1, True), ("c", 1, True), ("c", 2, True)], "g string, k int, on boolean")
    present = frame([("a", 0), ("a", 1), ("a", 2), ("a", 9), ("c", 2)])
    prior = frame([("a", 0), ("a", 3), ("b", 1), ("c", 1)])
    got = {(r.g, r.k, r.action) for r in T.reconcile_active(cohort, present, prior, ["g"], "k", "on").collect()}
    assert got == {("a", 3, "retire"), ("a", 9, "reactivate"), ("b", None, "empty_pull"), ("c", None, "cohort_floor")}


def test_event_items(spark):
    want = [("o", "founded", None, None, 1991), ("o", "dissolved", None, None, 2001), ("p", "founded", None, None, 1993), ("p", "joined", "q", "rq", 1995), ("p", "joined", "s", None, 1995), ("q", "founded", None, None, 1990)]
    have = [("o", "founded", None, 1991, "e1", False), ("o", "dissolved", None, 1999, "e2", False), ("p", "founded", None, 1990, None, False), ("q", "founded", None, 1980, "e3", True)]
    rows = T.event_items(spark.createDataFrame(want, "org string, slug string, link string, linked string, year int"), spark.createDataFrame(have, "org string, slug string, linked string, year int, anchor string, retracted boolean"))
    assert {(r.org, r.slug, r.linked): r.action for r in rows.collect() if r.slug != "joined" or r.linked} == {("o", "founded", None): "noop", ("o", "dissolved", None): "refine", ("p", "founded", None): "create", ("p", "joined", "rq"): "create", ("q", "founded", None): "retracted"}
    assert {r.action for r in rows.collect() if r.slug == "joined"} == {"create", "unresolved"}


def test_classification(spark):
    kind = "anchor string, {} name string, acronym string, windows array<string>, acronyms array<string>, parent int"
    local = [(None, "1", "A", "X", [], [], 1), ("r", "2", "A", "X", [], [], 1), ("m", "3", "A", "X", [], [], 1), ("k", "4", " A", "", ["b", "a"], None, None), ("d", "5", "A", "X", ["a"], ["X"], 1)]
    remote = [("m", "z", "B", None, None, None, None, False), ("k", None, "A", None, ["a", "b"], [], None, True), ("d", None, "B", "Y", [], ["Y"], 2, True)]
    told = T.classify_orgs(spark.createDataFrame(local, kind.format("id string,")), spark.createDataFrame(remote, kind.format("merged_into string,") + ", former boolean"))
    got = {r.id: (r.issues, r.reconciled) for r in told.collect()}
    assert got == {"1": (["unlinked"], False), "2": (["missing"], False), "3": (["merged"], False), "4": ([], True), "5": (["name_drift", "acronym_drift", "names_window_drift", "acronyms_drift", "parent_drift"], False)}


def test_sweep(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "a" * 10, True), (2, "b" * 5, False), (3, "c" * 50, True), (4, None, True), (5, "d", None)], "k int, body string, good boolean")
    rows = rows.withColumn("digest", F.when(F.col("good"), F.sha2("body", 256)).when(~F.col("good"), "x"))
    got = {r.k: (r.slice, r.outcome) for r in T.sweep_slices(rows, "k", "body", "digest", 12).collect()}
    assert got == {1: (0, "verified"), 2: (0, "mismatched"), 3: (1, "verified"), 4: (5, "unbaselined"), 5: (5, "unbaselined")}


def test_retire_guards(spark):
    spans = spark.createDataFrame([(str(i), i == 0) for i in range(10)], "member string, anchored boolean")
    none = spans.limit(0)
    assert T.retire(spans, none, ["member"], "anchored").count() == 0  # nothing asserted
    assert T.retire(spans, spans.filter("member = '9'"), ["member"], "anchored").count() == 0  # too many
    got = {r.member: r.outcome for r in T.retire(spans, spans.filter("member > '3'"), ["member"], "anchored").collect()}
    assert got == {"0": "kept_anchored", "1": "retired", "2": "retired", "3": "retired"}


def test_membership_build(spark):
    import datetime as dt

    d = dt.date
    seen = [("m", "house", "1", y) for y in (2019, 2021, 2023, 2025)] + [("m", "house", "2", 2001), ("n", "house", "1", 2021), ("n", "house", "1", 2023), ("o", "house", "1", 2003)]
    events = spark.createDataFrame([("m", "departed", d(2024, 5, 1), None, None)], "member string, kind string, effective_date date, seat_kind string, discriminator string")
    stored = spark.createDataFrame([("m", "house", "1", d(2019, 1, 1), None), ("x", "house", "1", d(2001, 1, 1), None)], "member string, kind string, discriminator string, valid_from date, valid_to date")
    rows = T.membership_build(spark.createDataFrame(seen, "member string, kind string, discriminator string, year int"), events, stored, 2019, ["house"], 2025).collect()
    assert {(r.source_id, str(r.valid_to), r.outcome) for r in rows} == {("m:house:1:2019", "2024-05-01", "emit"), ("n:house:1:2021", "2024-12-31", "emit"), ("x:house:1:2001", "2024-12-31", "close")}


def test_winners_are_projected_once(spark):
    """The seats' plan reads the rated winners as a table; it doesn't rate them again for each of its parts."""
    winners = spark.createDataFrame([("c", 1, 1, ["ann", "ann", None], "Position 1"), ("c", 1, 2, [], None), ("c", 1, 3, None, "Position 2"), ("c", None, 4, ["ann"], None)], "cohort string, seat int, id int, keys array<string>, qualifier string")
    listed = spark.createDataFrame([("c", 1, "A", "ann"), ("c", 1, "A", "ann"), ("c", None, "N", "ann")], "cohort string, seat int, member string, surname string")
    told, seats = I.project_winners(winners, listed, listed.limit(0))
    assert {r.id: r.outcome for r in told.collect()} == {1: "direct", 2: "unmatched", 3: "unresolved", 4: "unmatched"}
    assert [tuple(r) for r in seats.collect()] == [("c", 1, 1, "A", "Position 1", False)]
    plan = seats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 0 and plan.count("Window") == 0 and plan.count("Join") <= 2
