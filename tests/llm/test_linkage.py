import datetime as dt

from gavelspark.llm import linkage as L
from gavelspark.llm import matching as M

PERSONS = "id string, source string, source_id string, name_full string, name_first string, name_last string, name_middle string, name_suffix string, name_used string, updated_at timestamp, text string, class string"


def persons(spark):
    at = dt.datetime(2020, 1, 1)
    who = [("p1", "s1", "Dorothy", "Ardorman", "Aoife", None, "Dot"), ("p2", "s1", "Josephine", "Ardorman", None, None, None), ("p3", "s2", "Dorothy", "Ardorman", None, None, None), ("p4", "s1", "Björn", "Grenudell", None, None, None), ("p5", "s1", "Björn", "Grenudell", None, "Jr.", None)]
    return spark.createDataFrame([(i, s, f"QM-00000{s[1]}:{i}", f"{a} {b}", a, b, m, x, u, at, "clash", "clash") for i, s, a, b, m, x, u in who], PERSONS)


def tables(spark):
    bills = [(1, "s1", "Ardorman, Dot"), (2, "s1", "D. A. ARDORMAN"), (3, "s1", "J Ardorman"), (4, "s2", "Dorothy Ardorman"), (5, "s1", "?"), (6, "s1", "?"), (7, "s1", None), (8, "s1", "  "), (9, None, "Dot Ardorman"), (20, "s1", "Committee on Trade & Ethics"), (21, "s1", "Ethics and Trade Committee"), (22, "s1", "Cmte on Trade"), (23, "s2", "Ethics and Trade Committee"), (24, "s1", "TE Cmte"), (1, "s1", "Ardorman, Dot")]
    wins = [(10, "s1", "Dorothy Ardornan"), (11, "s1", "Björn Grenudell, Jr."), (12, "s1", "B. Grenudell")]
    notes = [(13, "s1", "bjorn grenudell"), (14, "s1", "Bjorn Grenudell jr"), (15, "s1", "x" * 5000)]
    frame = lambda rows, c: spark.createDataFrame(rows, f"mention_id bigint, source string, {c} string")
    return {"bill_sponsorships": frame(bills, "sponsor_name_raw"), "senate_winners": frame(wins, "ballot_name"), "deferred_annotations": frame(notes, "member_name")}


def test_links(spark):
    got = {tuple(r) for r in L.linked_mentions(tables(spark), persons(spark)).collect()}
    assert got == {(1, 2), (1, 10), (2, 10), (20, 21), (20, 24), (21, 24), (12, 13), (11, 14)}


def test_links_of_empty_tables(spark):
    full = tables(spark)
    assert L.linked_mentions({k: v.limit(0) for k, v in full.items()}, persons(spark)).count() == 0
    got = {tuple(r) for r in L.linked_mentions(full, persons(spark).limit(0)).collect()}
    assert (20, 21) in got and not any(5 in p or 6 in p for p in got)


def test_roots(spark):
    chain = spark.createDataFrame([("s", f"{i}", f"{max(0, i - 1)}") for i in range(30)], "source string, form string, root string")
    assert {r.root for r in L.roots(chain).collect()} == {"0"}


def records(spark):
    c = spark.createDataFrame([(1, "Dot Ardorman", " qm/1", "Dem", 4, 2011), (1, "Dot Ardorman", " qm/1", "Dem", 4, 2011), (2, "J. Ardorman", "QM-1", None, None, None), (3, "Nobody Known", "QM-1", None, None, None), (4, None, "QM-1", None, None, None), (5, "Dot Ardorman", None, None, None, None)], "record_id bigint, display_name string, assembly string, party_label string, district_hint int, last_seat_year int")
    e = spark.createDataFrame([(10, "QM-000001", "ARDORMAN D.A.", 4, 2011), (11, "QM-000002", "Dorothy Ardorman", 4, 2011)], "record_id bigint, assembly string, member_name string, district int, session_year int")
    h = spark.createDataFrame([(20, "QM-000001", 2010, 4, ["ardorman", "dorothy", "dorothyardorman"], "democratic"), (21, "QM-000001", 2010, 9, ["ardorman", "j", "jardorman"], None), (22, "QM-000001", 2010, 9, None, None), (23, "QM-000001", 2010, 9, [], None)], "record_id bigint, assembly string, election_year int, ld int, name_keys array<string>, party_slug string")
    return c, e, h


def test_matches(spark):
    c, e, h = records(spark)
    rows = M.matched_records(c, e, h, persons(spark)).collect()
    assert {(r.record_id_a, r.record_id_b) for r in rows} == {(1, 10), (1, 20), (10, 20), (2, 21)}
    assert all(0.5 < r.confidence <= 1 for r in rows)


def parsed_rows(spark, rows):
    """record_id, kind, assembly, text with what :func:`M.records` adds."""
    frame = spark.createDataFrame(rows, "record_id bigint, kind string, assembly string, text string")
    return frame.withColumn("assembly", M.assembly_code("assembly")).withColumn("p", L.parsed("text")).select("record_id", "kind", "assembly", "p.*")


def test_readings_lose_no_surname_of_a_slip(spark):
    p = spark.createDataFrame([("p1", "s1", "QM-000001:p1", "Gilbert Marossby", "Gilbert", "Marossby", None, None, None, dt.datetime(2020, 1, 1), "", "")], PERSONS)
    rows = parsed_rows(spark, [(1, "c", "QM-1", "G. Mraossby"), (2, "c", "QM-1", "Nobody Known")])
    read = M.readings(rows, p).collect()
    assert [r.form.split("\x1f")[0] for r in read] == ["g mraossby"] and list(read[0].member) == ["p1"]


def test_short_surnames_are_blocked(spark):
    """Directory-free: names of two or three letters meet, as do two slips in a long one."""
    e = [(1, "e", "QM-1", "Ann Lee"), (2, "e", "QM-1", "Ike Ott"), (3, "e", "QM-1", "Theodora Varselquin")]
    h = [(11, "h", "QM-1", "Lee, Ann"), (12, "h", "QM-1", "I. Ot"), (13, "h", "QM-1", "Theodora Vraselqiun"), (14, "h", "QM-2", "Ann Lee")]
    rows = parsed_rows(spark, e + h).selectExpr("*", "cast(null as int) as district", "cast(null as string) as party", "cast(null as int) as year")
    read = spark.createDataFrame([], "assembly string, form string, member map<string,double>")
    got = {tuple(r) for r in M.candidate_pairs(rows, read).collect()}
    assert {(1, 11), (3, 13)} <= got and not any(14 in p for p in got)


def test_word_join_equals_all_pairs(spark):
    """No alike pair is lost: swaps, gaps, surplus letters, scanned shapes, repeated grams, short words."""
    import itertools
    import random

    from gavelspark.llm import names as N
    from gavelspark.llm import wordjoin as J

    rng = random.Random(3)
    letters = "aabbcdeimnrsvw01"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(150)} | {"ababab", "abaabb", "aaaaaa", "aaaa", "bababa", "lee", "lae", "roe", "rce"}
    for w in list(words):
        for _ in range(3):
            v = list(w)
            for _ in range(rng.randint(1, 2)):
                i = rng.randrange(len(v)) if v else 0
                kind = rng.randrange(4)
                if kind == 0 and len(v) > 1:
                    del v[i]
                elif kind == 1:
                    v.insert(i, rng.choice(letters))
                elif kind == 2 and len(v) > i + 1:
                    v[i], v[i + 1] = v[i + 1], v[i]
                elif v:
                    v[i] = rng.choice(letters)
            words.add("".join(v))
    words = sorted(w for w in words | {"xy" * 9, "xy" * 9 + "x", "yx" * 9, "xy" * 10, "x" * 3000, "x" * 3002} if w)
    frame = spark.createDataFrame([("s", w) for w in words] + [("t", words[0])], "scope string, word string")
    got = {(r.word, r.other) for r in J.similar_words(frame).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(words, 2) if N.word_cost(a, b) < 9}
    both = {(r.word, r.other) for r in J.similar_words(frame.filter("scope = 's'"), frame).collect()}
    assert both == {(a, b) for a, b in itertools.product(words, words) if N.word_cost(a, b) < 9}
    assert J.similar_words(frame.limit(0)).count() == 0 and J.similar_words(frame, frame.limit(0)).count() == 0


def test_people_outside_the_directory_are_linked(spark):
    rows = [(1, "s9", "Robert Quaxel"), (2, "s9", "Quaxel, Robert"), (3, "s9", "R. Quaxel"), (4, "s9", "Rob Quaxle"), (5, "s9", "Ursula Quaxel"), (6, "s8", "Robert Quaxel")]
    full = tables(spark)
    mine = {**full, "bill_sponsorships": spark.createDataFrame(rows, "mention_id bigint, source string, sponsor_name_raw string")}
    classes = {r.mention_id: r["class"] for r in L.mention_classes(mine, persons(spark)).collect()}
    assert classes[1] == classes[2] == classes[3] == classes[4] != classes[5]


def test_classes_hold_the_links(spark):
    rows = L.linked_classes(tables(spark), persons(spark)).collect()
    pairs = L.linked_mentions(tables(spark), persons(spark)).count()
    assert sum(r.links for r in rows) == 2 * pairs and len({r.mention_id for r in rows}) == len(rows)


def test_matches_of_empty_tables(spark):
    c, e, h = records(spark)
    assert M.matched_records(c.limit(0), e.limit(0), h.limit(0), persons(spark)).count() == 0
    assert M.matched_records(c, e, h, persons(spark).limit(0)).count() == 0


def test_classifier_on_held_out_pairs():
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 3))
    y = (x @ [2.0, -1.0, 0.5] + rng.normal(size=2000) * 0.3 > 0.2).astype(float)
    w = M.fit_logistic(x[:1500], y[:1500])
    score = np.hstack([x[1500:], np.ones((500, 1))]) @ w
    assert ((score > 0) == y[1500:]).mean() > 0.93


def test_word_join_is_no_broadcast(spark):
    """The keys of a word are many more than the words' size tells, so they aren't sent to the driver."""
    from gavelspark.llm import wordjoin as J

    frame = spark.createDataFrame([("s", w) for w in ("ardorman", "ardornan", "grenudell")], "scope string, word string").distinct()
    pairs = J.similar_words(frame)
    assert [tuple(r)[1:3] for r in pairs.collect()] == [("ardorman", "ardornan")]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_candidates_are_planned_in_steps(spark):
    """The word join is made once and isn't part of the plan of the pairs."""
    rows = parsed_rows(spark, [(1, "c", "QM-1", "Dorothy Ardorman"), (2, "e", "QM-1", "Dorothy Ardornan"), (3, "h", "QM-2", "Dorothy Ardorman")]).selectExpr("*", "1 as district", "'r' as party", "2000 as year")
    alike = M.alike_words(rows.select("assembly", "form", "words"))
    assert {(r.assembly, r.word, r.other) for r in alike.collect()} == {("QM-000001", a, b) for a in ("ardorman", "ardornan") for b in ("ardorman", "ardornan")} | {("QM-000002", "ardorman", "ardorman")} | {(s, "dorothy", "dorothy") for s in ("QM-000001", "QM-000002")}
    assert alike._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    pairs = M.candidate_pairs(rows, M.readings(rows, persons(spark)))
    assert {tuple(r) for r in pairs.collect()} == {(1, 2)}
    assert "exact_cost" not in pairs._jdf.queryExecution().optimizedPlan().toString()
