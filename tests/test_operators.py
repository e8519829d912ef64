import datetime as dt

import pytest
from pyspark.sql import functions as F

from gavelspark.functions import dates as D
from gavelspark.functions import strings as S
from gavelspark.operators import relational as O
from gavelspark.operators import temporal as T
from gavelspark.operators.paging import byte_budget, global_rank, grouped_lines
from gavelspark.sources import archive as A
from gavelspark.sources import wire
from gavelspark.streaming import feed as X


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(column(F.col("v"))).collect()]


def test_strings(spark):
    assert one(spark, S.fold_token, "García", "O'Brien", "Groß", None) == ["garcia", "obrien", "gross", None]
    assert one(spark, S.probe_surname, "Orla Brandvik, Jr.", "Jr.", "", None, 'Ingrid (Mrs. Tor) "Inga" Solheim') == ["brandvik", None, None, None, "solheim"]
    assert one(spark, lambda c: S.surname_keys(S.folded_tokens(c)), "Van De Hol", "") == [["de", "dehol", "hol", "van", "vande", "vandehol"], []]
    assert one(spark, S.parse_votes, "1,234", "x", "", None, "12") == [1234, None, None, None, 12]
    assert one(spark, S.ballot_party, "(Prefers GOP Party)", "(States No Party)", None) == ["republican", None, None]
    assert one(spark, S.strip_position_suffix, "Olav Brekke – 19B", "Olav") == ["Olav Brekke", "Olav"]
    notes = one(spark, S.split_annotation, "Maren (Mrs. Odd T.) Falk (Appointed 1957)", "Sigrid (Siri) Nordahl", None)
    assert notes[0] == ("Maren (Mrs. Odd T.) Falk", "Appointed 1957") and notes[1] == ("Sigrid (Siri) Nordahl", None)


def test_dates(spark):
    assert one(spark, lambda c: D.parse_biennium(c)["end"], "1999-00", "2013-14", None) == [2000, 2014, None]
    with pytest.raises(Exception, match="bad biennium"):
        one(spark, lambda c: D.parse_biennium(c)["end"], "99-00")
    got = one(spark, D.mixed_date, "Resigned May 11, 1981", "February 31, 1950", "election March 3, 2918", "in 1933", "no date", None)
    assert got[0] == (dt.date(1981, 5, 11), "day") and got[1] == (None, "year") and got[3] == (None, "year") and got[4] == (None, "none") and got[5] is None
    assert got[2][0] is None


def test_refusals(spark):
    votes = spark.createDataFrame([("a", 5, "x"), ("a", 5, "y"), ("b", 3, "x"), ("b", None, "y"), ("c", None, "z"), ("d", 9, "p"), ("d", 2, "q")], "k string, v int, who string")
    assert {r.k: r.winner for r in O.top_or_refuse(votes, ["k"], "v", "who").collect()} == {"a": None, "b": None, "c": "z", "d": "p"}
    many = spark.createDataFrame([(i, True) for i in range(10)], "id int, x boolean")
    assert O.guarded(many, many, 0.5, 5).count() == 0
    assert O.guarded(many.limit(4), many, 0.5, 5).count() == 4
    assert O.guarded(many, many.limit(0), 0.5, 5).count() == 0


def test_upsert_never_overwrites_with_null(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    new = spark.createDataFrame([("a", None, "z"), ("c", 3, None), ("c", 3, None)], "k string, n int, s string")
    assert sorted(map(tuple, A.upsert(old, new, ["k"]).collect())) == [("a", 1, "z"), ("b", 2, "y"), ("c", 3, None)]
    assert sorted(r.k for r in A.fill_only(old, new, ["k"]).collect()) == ["a", "b", "c"]


def test_sidecars(tmp_path, spark):
    meta = A.write_sidecars(str(tmp_path / "seed.json"), b"[]", {"biennium": "2013-14"})
    assert (tmp_path / "seed.json.sha256").read_text().startswith(meta["sha256"])
    with pytest.raises(ValueError):
        A.write_sidecars(str(tmp_path / "x"), b"", {"sha256": "no"})
    files = spark.createDataFrame([("p", b"[]")], "path string, content binary")
    assert A.verified(files, spark.createDataFrame([("p", meta["sha256"])], "path string, digest string")).count() == 1
    with pytest.raises(Exception, match="bad checksum"):
        A.verified(files, spark.createDataFrame([("q", "0")], "path string, digest string")).collect()


def test_wire(spark):
    docs = spark.createDataFrame([("a", "<root><Member><FirstName>Ann</FirstName></Member><Member/></root>"), ("b", "<x><faultstring>no members here</faultstring></x>"), ("c", None), ("d", "")], "k string, body string")
    assert [(r.k, r.ord, r.FirstName) for r in wire.xml_rows(docs, "body", "Member", wire.MEMBER, ("no members",)).collect()][0] == ("a", 0, "Ann")
    with pytest.raises(Exception, match="fault"):
        wire.xml_rows(docs, "body", "Member", wire.MEMBER).collect()
    with pytest.raises(Exception, match="not a JSON array"):
        wire.json_array_rows(spark.createDataFrame([("a", "{}")], "k string, body string"), "body", "x int").collect()
    assert wire.json_array_rows(spark.createDataFrame([("a", "[]")], "k string, body string"), "body", "x int").count() == 0
    csv = spark.createDataFrame([("a", '﻿x,y\r\n1,"a,b"\r\n\r\n2,\r\n'), ("b", "x,y"), ("c", None)], "k string, body string")
    assert [(r.x, r.y) for r in wire.csv_rows(csv, "body", ["x", "y"]).collect()] == [("1", "a,b"), ("2", None)]


def test_overlay(spark):
    d = dt.date
    spans = spark.createDataFrame([("m", "house", "1", d(2011, 1, 1), None, True, "wire"), ("n", "house", "2", d(2001, 1, 1), d(2004, 12, 31), False, "wire")], T.SPAN)
    events = [("m", "departed", d(2013, 5, 1), None, None), ("n", "seated", d(2002, 3, 1), "house", "2"), ("n", "vacated", d(2003, 3, 1), "house", "2"), ("o", "seated", d(2025, 2, 1), "house", "1"), ("p", "seated", d(1999, 2, 1), "house", "1"), ("q", "vacated", d(2008, 2, 1), "house", "1"), ("m", "seated", d(2012, 1, 1), "senate", "1")]
    events = spark.createDataFrame(events + events[:2], "member string, kind string, effective_date date, seat_kind string, discriminator string")
    movers = spark.createDataFrame([("q", 2007)], "member string, year int")
    got = {(r.member, r.valid_from, r.valid_to, r.origin) for r in T.overlay_events(spans, events, ["house"], 2025, movers).collect()}
    assert got == {("m", d(2011, 1, 1), d(2013, 5, 1), "departed"), ("n", d(2002, 3, 1), d(2003, 3, 1), "vacated"), ("o", d(2025, 2, 1), None, "synthesized"), ("q", d(2007, 1, 1), d(2008, 2, 1), "synthesized")}


def test_elimination(spark):
    roster = spark.createDataFrame([("d", "a"), ("d", "b"), ("e", "c"), ("e", "f"), ("e", "g")], "g string, member string")
    matches = spark.createDataFrame([("d", "a", "Position 1"), ("e", "c", "Position 2")], "g string, member string, qualifier string")
    seeds = spark.createDataFrame([("e", "f", "Position 2"), ("e", "g", "Position 1")], "g string, member string, qualifier string")
    got = {(r.member, r.qualifier, r.how) for r in T.positions_by_elimination(roster, matches, seeds, ["g"]).collect()}
    assert got == {("a", "Position 1", "ballot"), ("b", "Position 2", "elimination"), ("c", "Position 2", "ballot"), ("f", None, None), ("g", "Position 1", "seed")}


def test_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"), F.lit(10).alias("size")).repartition(7)
    assert all(r.n == r.id + 1 for r in global_rank(df, ["id"], "n").collect())
    assert sorted(r.id for r in byte_budget(df, "id", "size", 95).collect()) == list(range(10))
    words = spark.createDataFrame([("p", 0.0, 1), ("p", 2.0, 2), ("p", 4.0, 3), ("p", 5.0, 4), ("q", 5.0, 1)], "page string, top double, x int")
    assert sorted(map(tuple, grouped_lines(words, "page", "top", "x", 3.0).collect())) == [("p", 1, 2), ("p", 2, 2), ("q", 1, 1)]


def test_feed(spark):
    page = spark.createDataFrame([("a", 1, "updated"), ("a", 2, "deleted"), ("a", 3, "updated"), ("b", 4, "updated")], "k string, seq int, change string")
    assert sorted(map(tuple, X.apply_page(page, "k", "seq", "change").collect())) == [("a", 2, "deleted"), ("b", 4, "updated")]
    runs = spark.createDataFrame([("k", i, h) for i, h in enumerate("aabbbba")] + [("k", 7, None), ("k", 8, None)], "k string, i int, h string")
    assert [(r.run, r.stuck) for r in X.identical_runs(runs, "k", ["i"], "h").orderBy("i").collect()] == [(1, False), (2, False), (1, False), (2, False), (3, True), (4, True), (1, False), (1, False), (2, False)]
    feed = spark.range(50, 100).select(F.col("id").alias("seq"))
    got = X.replay_window(feed, "seq", 80, 60, 10).collect()
    assert [r.seq for r in got] == list(range(50, 60)) and all(r.fell_off for r in got)


def test_change_feed_reads_every_change_once(spark):
    assert sorted(r.seq for r in X.drain_sample_feed(spark).collect()) == list(range(1, 61))


def test_similar_pairs_are_those_of_all_pairs(spark):
    import random

    rng = random.Random(3)
    sets = {i: ["and", *rng.sample("abcdefgh", rng.randint(0, 4))] for i in range(60)} | {90: [], 91: None, 92: []}
    df = spark.createDataFrame(list(sets.items()), "id int, w array<string>")
    for floor in (0.34, 0.5, 1.0):
        want = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len({*sets[a]} & {*sets[b]}) / len({*sets[a], *sets[b]}) >= floor}
        for most in (7, 1000):
            got = [(r.a, r.b) for r in O.similar_pairs(df, "id", "w", floor, most).collect()]
            assert len(got) == len(set(got)) and set(got) == want


def test_committee_pairs_are_not_of_one_biennium(spark, tmp_path):
    import __spark_entry__ as entry

    at = dt.datetime(2020, 1, 1)
    rows = [("1", "Mining & Energy", "2013/14", at), ("2", "Energy, Mining", " 2013-14", at), ("3", "Rules", "2013-14", at), ("4", "Mining", "2001-02", at), ("3", "Mining Energy", "1999-00", at + dt.timedelta(1)), ("5", None, "2001-02", at), ("6", "--", "2001-02", at), ("7", "", "2001-02", at)]
    spark.createDataFrame(rows, "source_id string, legal_name string, boundary_biennium string, recorded_at timestamp_ntz").write.parquet(f"{tmp_path}/rename_transitions.parquet")
    got = {tuple(r) for r in entry.queries()["join16_committee_pairs"](spark, str(tmp_path)).collect()}
    assert got == {("1", "2", 1.0), ("1", "3", 1.0), ("2", "3", 1.0), ("1", "4", 0.5), ("2", "4", 0.5), ("3", "4", 0.5)}


def test_feed_is_applied_to_its_end(spark, tmp_path):
    rows = [(f"u{i % 7}", i) for i in range(0, 200, 3)] + [("u1", 198), ("last", 500), ("none", None)]
    feed = spark.createDataFrame(rows, "k string, seq bigint")
    want = {}
    for k, i in rows:
        if i is not None:
            want[k] = max(i, want.get(k, -1))
    got = lambda df: {r.k: r.seq for r in df.collect()}
    assert got(X.drain_feed(feed, "k", "seq", 10)) == want
    base = f"{tmp_path}/feed"
    X.drain_feed(feed.filter("seq < 90"), "k", "seq", 10, base)
    # The second call goes on after the cursor: a number before it isn't read again.
    later = feed.unionByName(spark.createDataFrame([("again", 5)], "k string, seq bigint"))
    assert got(X.drain_feed(later, "k", "seq", 10, base)) == want
    assert got(X.drain_feed(feed.limit(0), "k", "seq")) == {}


def test_replay_continues_until_the_end_of_the_feed(spark):
    def passes(numbers, verified, margin, retain, most):
        out, floor, n = [], verified - retain if verified else max(numbers) - margin, 0
        while True:
            n, floor = n + 1, max(-1, floor)
            page = [x for x in numbers if x > floor][:most]
            out += [(n, x, floor + 1 < numbers[0]) for x in page]
            if len(page) < most:
                return sorted(out)
            verified = max(page[-1], verified or 0)
            floor = verified - retain

    for numbers in (list(range(0, 130)), list(range(50, 400, 3)), list(range(95))):
        feed = spark.createDataFrame([(x,) for x in numbers], "seq bigint")
        for verified in (None, 60):
            got = sorted(map(tuple, X.replay_passes(feed, "seq", verified, 100, 10, 30).collect()))
            assert got == passes(numbers, verified, 100, 10, 30)
            assert {x for _, x, _ in got} == {x for x in numbers if x > (verified - 10 if verified else max(-1, numbers[-1] - 100))}
    assert X.replay_passes(feed.limit(0), "seq").count() == 0
    with pytest.raises(ValueError):
        X.replay_passes(feed, "seq", retain=30, most=30)


def test_sponsor_build_overlays_emits_and_sweeps(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "member string, kind string, discriminator string, year int")
    seen = rows(*[(m, "house", "1", y) for m in ("left", "stays", "ghost", "touched") for y in (2021, 2023, 2025)], ("old", "house", "1", 2001), ("stays", "house", "?", 2025))
    stale = spark.createDataFrame([("ghost", 2025), ("touched", 2025)], "member string, year int")
    event = "member string, kind string, effective_date date, seat_kind string, discriminator string"
    told = spark.createDataFrame([("left", "departed", dt.date(2025, 5, 1), None, None), ("touched", "departed", dt.date(2026, 2, 1), None, None), ("ghost", "departed", dt.date(2022, 1, 1), None, None)], event)
    stored = T.tenure_spans(rows(("gone", "house", "1", 2025), *[(m, "house", "1", 2021) for m in ("stays",)], ("stays", "house", "1", 2023), ("stays", "house", "1", 2025)), 2025)
    built = lambda **x: {(r.source_id, r.outcome): r.valid_to for r in T.sponsor_build(seen, stale, rows(("stays", "house", "?", 2025)), rows(("stays", "house", "1", 2019)), told, stored, 2011, ["house"], 2025, **x).collect()}
    got = built()
    assert got["left:house:1:2021", "emit"] == dt.date(2025, 5, 1)  # overlaid
    assert got["touched:house:1:2021", "emit"] == dt.date(2026, 2, 1)  # exempt through its last event's biennium
    assert got["ghost:house:1:2021", "emit"] == dt.date(2022, 1, 1)
    assert got["stays:house:1:2019", "emit"] is None  # deepened by the extras
    assert got["gone:house:1:2025", "tombstone"] is None and ("stays:house:1:2021", "close") in got
    assert len(got) == 6 and not any("?" in k or k.startswith("old") for k, _ in got)


def test_name_reconcile_has_three_guards(spark):
    def verdicts(before, after):
        rows = [(2011, k, n) for k, n in before.items()] + [(2013, k, n) for k, n in after.items()]
        got = T.reconcile_names(spark.createDataFrame(rows, "year int, k string, name string"), "k", "name", "year").filter("year = 2013").collect()
        return {(r.k, r.before, r.after, r.aborted) for r in got}

    base = {"1": "Ways & Means", "2": "Rules", "3": "Law", "4": "Energy"}
    assert verdicts(base, base | {"1": "ways and means", "2": "Ethics"}) == {("2", "Rules", "Ethics", None)}
    assert verdicts({}, base) == {(None, None, None, "empty_pull")}
    assert verdicts(base, {"1": "Other", "7": "x", "8": "y", "9": "z"}) == {(None, None, None, "low_overlap")}
    assert verdicts(base, base | {"2": "a", "3": "b"}) == {(None, None, None, "rename_storm")}
    at = [("1", "A", 2009, 1), ("1", "B", 2013, 2), ("1", "C", 2013, 1), ("2", "D", 2011, 1), ("3", None, 2009, 1)]
    held = T.standing_names(spark.createDataFrame(at, "k string, name string, year int, at int"), "k", "name", "year", "at")
    assert {(r.year, r.k, r.name) for r in held.collect()} == {(2009, "1", "A"), (2011, "1", "A"), (2013, "1", "B"), (2011, "2", "D"), (2013, "2", "D")}


def test_special_match_differs_from_the_even_year(spark):
    rows = lambda x: spark.createDataFrame(x, "id int, q string")
    entries = rows([(i, None) for i in range(1, 6)])
    got = T.special_matches(entries, rows([(1, "a"), (3, "a"), (4, "a")]), rows([(1, "a"), (2, "b"), (3, "b")]), "id", "q").collect()
    assert {r.id: (r.even, r.merged, r.special) for r in got} == {1: ("a", "a", False), 2: (None, "b", True), 3: ("a", None, False), 4: ("a", "a", False), 5: (None, None, False)}


def test_feed_and_list_sources_read_tables(spark, tmp_path):
    import __spark_entry__ as entry

    events = [(i, i % 7, "error" if i % 5 == 0 else "view") for i in range(0, 25_000, 2)]
    spark.createDataFrame(events[::-1], "event_id bigint, user_id bigint, event_type string").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(tuple, entry.queries()["src13_change_feed"](spark, str(tmp_path)).collect()))
    assert got == [(i, "user", str(u), "deleted" if e == "error" else "updated") for i, u, e in events]
    names = [(f"s{i:04d}", f"name {i}") for i in range(1103)]
    spark.createDataFrame(names, "slug string, name string").repartition(3).write.parquet(f"{tmp_path}/jurisdictions.parquet")
    assert sorted(map(tuple, entry.queries()["src12_paged_list"](spark, str(tmp_path)).collect())) == names


def test_annotations(spark):
    got = one(spark, S.split_annotation, "Maren (Siri) Falk (wife (second) of unexpired member) x", "A (b) C", "Odd Nes (died 1901", "Ola (Elect) Vik", "  ", "x (" * 4000)
    assert [tuple(r) for r in got[:4]] == [("Maren (Siri) Falk", "wife (second) of unexpired member) x"), ("A (b) C", None), ("Odd Nes", "died 1901"), ("Ola (Elect) Vik", None)]
    assert got[4].name == "" and got[5].annotation is None
    verbs = one(spark, S.clauses, "(Resigned May 1, 1981) (Appointed 1982); was elected", "Sworn in 1901", None, "")
    assert [(r.verb, r.text) for r in verbs[0]] == [("resigned", "Resigned May 1, 1981"), ("appointed", "Appointed 1982"), (None, "was elected")]
    assert verbs[1][0].verb == "sworn_in" and verbs[2] is None and verbs[3] == []


def test_party_changes(spark):
    change = lambda *v: [tuple(r) for r in one(spark, S.party_change, *v)]
    assert change("Changed party affiliation, 1913) ..... Prog.", "Changed party affiliation 1897) / Silver R /") == [("year", 1913, None, "Prog."), ("year", 1897, None, "Silver Rep.")]
    assert change("Changed party affiliation February 13, 1981", "Changed party affiliation to Republican, May 3, 1999") == [("dated", 1981, dt.date(1981, 2, 13), None), ("dated", 1999, dt.date(1999, 5, 3), "R")]
    refused = ("Changed party affiliation Foo 33, 1981", "Changed party affiliation to Martian, February 13, 1981", "changed party 1981", "Changed party affiliation, 1913) 44", "Changed party affiliation June 31, 1981", "Changed party affiliation 12 May 3, 1999")
    assert {r[0] for r in change(*refused)} == {"unparsed"}
    assert change("Resigned", None) == [(None, None, None, None)] * 2


def test_row_shapes(spark):
    assert one(spark, S.awaits_leader, "1969 Odd “Ole” (T.) Nes", "1889 No district", "1891 - Vik", "Odd Nes", "1969", None) == [True, False, False, False, False, False]
    assert one(spark, lambda c: S.undeclared_party_tail(c, ["R", "Silver Rep."]), "Nes .... Whig", "Nes .. Silver Rep.", "Nes . Whig", "Nes .. a b c", None) == [True, False, False, False, False]


def test_dates_of_every_precision(spark):
    got = one(spark, D.mixed_date, "Dec. 6., 2024", "Feb 4. 2013", "to serve 1951 2nd Ex. S.", "Elected 1951 session; seated 1953", "June, 1921", "moved from district 12 in 1999")
    assert [tuple(r) for r in got] == [(dt.date(2024, 12, 6), "day"), (dt.date(2013, 2, 4), "day"), (None, "none"), (None, "year"), (None, "month"), (None, "none")]
    assert tuple(one(spark, D.partial_date, "May 3, 1999 at 09:15")[0]) == (1999, 5, 3, 9, 15, None)
    assert [tuple(r) for r in one(spark, D.partial_date, "June 1921 at 9:15", None)] == [(1921, 6, None, None, None, None), (None,) * 6]


def test_folding_is_the_decomposition_without_marks(spark):
    import unicodedata

    texts = ["Łukasz", "Æsa Øst", "Straße", "ﬁnﬂ", "Ǆ", "ＡＢ１", "é é", "İ", "漢字", "", "Ȧ̧", "Ñandú", "ĳ"]
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    from gavelspark.functions.folding import unaccent

    assert one(spark, unaccent, *texts, None) == [*map(plain, texts), None]
    assert one(spark, S.fold_token, "Łukasz") == ["ukasz"]


def test_single_match_raises_on_none_and_several(spark):
    held = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("a", 1)], "k string, v int")
    ask = lambda k: O.single_match(spark.createDataFrame([(k,)], "k string"), held, ["k"], "v").collect()
    assert ask("a")[0].v == 1
    for key, why in (("b", "several matches for b"), ("x", "no match for x")):
        with pytest.raises(Exception, match=why):
            ask(key)


def test_reconcile_touches_only_its_own(spark):
    want = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("n", 5)], "k string, v int")
    have = spark.createDataFrame([("a", 1, "us", "x"), ("b", 9, "us", None), ("c", None, "them", "x"), ("d", 4, "us", "x"), ("e", 4, "us", None), ("f", 4, None, "x")], "k string, v int, owner string, anchor string")
    got = {r.k: r.action for r in O.reconcile(want, have, ["k"], ["v"], "owner", "us", "anchor").collect()}
    assert got == {"a": "keep", "b": "update", "c": "owned_elsewhere", "d": "delete", "e": "left_alone", "f": "owned_elsewhere", "n": "insert"}


def test_extent_stops_after_empties(spark):
    years = spark.createDataFrame([(y,) for y in (1971, 1973, 1985, 1989, 1991, None, 1991)], "y int")
    assert {r.y: r.reached for r in O.extent(years, "y", 3).collect()} == {1971: False, 1973: False, 1985: True, 1989: True, 1991: True}
    assert O.extent(years.limit(0), "y", 3).count() == 0


def test_wire_lists(spark):
    assert one(spark, S.wire_list, None, "null", '{"a":1}', '[{"a":1},{"a":2}]', "[]", "") == [[], [], ['{"a":1}'], ['{"a":1}', '{"a":2}'], [], []]


def test_guards_of_sources(spark):
    pages = spark.createDataFrame([("u", "<a href='/x/Legislative_1.csv'>")], "url string, page string")
    assert pages.select(wire.required_href(F.col("page"), F.col("url"))).first()[0] == "/x/Legislative_1.csv"
    with pytest.raises(Exception, match="results link not found: u"):
        pages.select(wire.required_href(F.lit("<p>"), F.col("url"))).collect()
    rows = spark.createDataFrame([("a", "2015-16"), ("b", None)], "id string, stamp string")
    assert [r.edition for r in A.guard_edition(rows, F.lit("2015-16"), F.col("stamp")).orderBy("id").collect()] == ["ok", "unreadable"]
    with pytest.raises(Exception, match="edition mismatch: 2015-16"):
        A.guard_edition(rows, F.lit("2013-14"), F.col("stamp")).collect()


def test_discovery_is_bounded(spark):
    edges = spark.createDataFrame([("p", "1", "b", "x"), ("p", "2", "b", "x"), ("p", "2", "b", "y"), ("p", "3", "b", "y"), ("p", "4", "b", None)], "kind string, node string, to_kind string, `to` string")
    root = spark.createDataFrame([("p", "1"), ("p", None)], "kind string, node string")
    got = {(r.kind, r.node, r.hop) for r in A.discover(edges, root, 3, 100).collect()}
    assert got == {("p", "1", 0), ("b", "x", 1), ("p", "2", 2), ("b", "y", 3)}
    cut = A.discover(edges, root, 9, 1).collect()
    assert {r.node for r in cut} == {"1", "x"} and all(r.truncated for r in cut)
    assert A.discover(edges, root.limit(0), 2, 9).count() == 0


def test_seeds_with_sidecars(spark):
    from gavelspark.session import shared_path

    base = shared_path(spark, "seeds")
    A.write_seed(spark, f"{base}/a.json", b"[1]", {"table": "a"})
    assert [bytes(r.content) for r in A.verified(*A.seed_files(spark, base)).collect()] == [b"[1]"]
    with pytest.raises(ValueError):
        A.write_seed(spark, f"{base}/b.json", b"", {"bytes": "0"})
    A._write_shared(spark, f"{base}/a.json", b"[2]")
    with pytest.raises(Exception, match="bad checksum"):
        A.verified(*A.seed_files(spark, base)).collect()


def test_lines_equal_a_plain_loop(spark):
    import random

    rng = random.Random(9)
    words = [(p, float(rng.randint(0, 40)) / 2, x, rng.choice(["a", "b", None])) for p in range(12) for x in rng.sample(range(100), rng.randint(1, 30))]
    expected = []
    for page in range(12):
        line, first, held = 0, None, []
        for _, y, x, w in sorted((w for w in words if w[0] == page), key=lambda w: (w[1], w[2])):
            if first is None or y - first > 3:
                if held:
                    expected.append((page, line, len(held), " ".join(w for _, w in sorted(held) if w)))
                line, first, held = line + 1, y, []
            held.append((x, w or ""))
        expected.append((page, line, len(held), " ".join(w for _, w in sorted(held) if w)))
    df = spark.createDataFrame(words, "page int, top double, x int, word string")
    assert sorted(map(tuple, grouped_lines(df, "page", "top", "x", 3.0, "word").collect())) == sorted(expected)
    assert grouped_lines(df.limit(0), "page", "top", "x", 3.0, "word").count() == 0


def test_overlay_equals_a_plain_replay(spark):
    """Random spans and events of members, applied one by one."""
    import random

    rng = random.Random(10)
    day = lambda y: dt.date(y, rng.randint(1, 12), rng.randint(1, 28))
    spans, events = [], []
    for m in map(str, range(25)):
        for disc in ("1", "2"):
            y = rng.choice([2001, 2007, 2013])
            spans.append((m, "house", disc, dt.date(y, 1, 1), rng.choice([None, dt.date(y + 5, 12, 31)]), True, "wire"))
        for _ in range(rng.randint(0, 4)):
            kind = rng.choice(["departed", "vacated", "seated"])
            events.append((m, kind, day(rng.randint(2000, 2025)), rng.choice(["house", "house", "senate"]) if kind != "departed" else None, rng.choice(["1", "2"]) if kind != "departed" else None))
    own = {m: [list(s) for s in spans if s[0] == m] for m in map(str, range(25))}
    for m, kind, at, seat, disc in sorted(set(events), key=lambda e: (e[0], e[2], e[1], e[4] or "")):
        covers = [s for s in own[m] if s[3] <= at and (s[4] is None or at <= s[4]) and s[1] == seat and s[2] == disc]
        if kind == "departed":
            for s in own[m]:
                if s[4] is None or s[4] >= at:
                    s[4] = max(at, s[3])
        elif seat == "house":
            for s in covers:
                if kind == "seated":
                    s[3] = at
                else:
                    s[4] = max(at, s[3])
            if not covers and kind == "seated" and at.year - (at.year % 2 == 0) == 2025:
                own[m].append([m, seat, disc, at, None, True, "x"])
    schema = "member string, kind string, discriminator string, valid_from date, valid_to date, is_active boolean, origin string"
    got = T.overlay_events(spark.createDataFrame(spans, schema), spark.createDataFrame(events, "member string, kind string, effective_date date, seat_kind string, discriminator string"), ["house"], 2025)
    assert sorted((r.member, r.discriminator, str(r.valid_from), str(r.valid_to)) for r in got.collect()) == sorted((s[0], s[2], str(s[3]), str(s[4])) for rows in own.values() for s in rows)
