"""Tenure spans under operator events, sweeps with guards, reconciles and migrations."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gavelspark.operators.relational import guarded, spans_of, unique_match
from gavelspark.operators.paging import _running

SPAN = "member string, kind string, discriminator string, valid_from date, valid_to date, is_active boolean, origin string"


def tenure_spans(observations: DataFrame, current: int) -> DataFrame:
    """Observations (member, kind, discriminator, year) merged to spans; the run that reaches
    ``current`` is open."""
    runs = spans_of(observations, ["member", "kind", "discriminator"], "year")
    one = F.lit(1)
    is_open = F.col("last") >= current
    return runs.select(
        "member",
        "kind",
        "discriminator",
        F.make_date("first", one, one).alias("valid_from"),
        F.when(~is_open, F.make_date(F.col("last") + 1, F.lit(12), F.lit(31))).alias("valid_to"),
        is_open.alias("is_active"),
        F.lit("wire").alias("origin"),
    )


def _overlay(spans: list[dict], events: list[dict], owned: frozenset[str], current: int, movers: frozenset[int]) -> list[dict]:
    """Events of one member applied in order of date."""
    for e in events:
        day, hit = e["effective_date"], False
        covers = lambda s: s["valid_from"] <= day and (s["valid_to"] is None or day <= s["valid_to"])  # noqa: E731, B023
        if e["kind"] == "departed":
            for s in spans:
                if s["valid_to"] is None or s["valid_to"] >= day:
                    s |= {"valid_to": max(day, s["valid_from"]), "is_active": False, "origin": "departed"}
            continue
        if e["seat_kind"] not in owned:
            continue
        seat = [s for s in spans if s["kind"] == e["seat_kind"] and s["discriminator"] == e["discriminator"] and covers(s)]
        for s in seat:
            hit = True
            s |= {"valid_from": day, "origin": "seated"} if e["kind"] == "seated" else {"valid_to": max(day, s["valid_from"]), "is_active": False, "origin": "vacated"}
        start = day.year - (day.year % 2 == 0)
        fresh = {"member": e["member"], "kind": e["seat_kind"], "discriminator": e["discriminator"] or ""}
        if not hit and e["kind"] == "seated" and start == current:
            spans.append(fresh | {"valid_from": day, "valid_to": None, "is_active": True, "origin": "synthesized"})
        if not hit and e["kind"] == "vacated" and start in movers:
            floor = date(start, 1, 1)
            spans.append(fresh | {"valid_from": floor, "valid_to": max(day, floor), "is_active": False, "origin": "synthesized"})
    return spans


def overlay_events(spans: DataFrame, events: DataFrame, owned: list[str], current: int, movers: DataFrame | None = None) -> DataFrame:
    """Spans after the operator events: departed closes all spans open through the date,
    vacated the covering seat, seated moves the start; an unmatched seating of the
    current biennium opens a span, an unmatched vacancy of a mover a closed one, others
    change nothing.

    Order matters, so each member's events run in date order in one fold over sorted
    rows; a task holds one member's spans at a time, which the calendar bounds (spans do
    not overlap; of one kind, seat and day one event counts).
    """
    own = frozenset(owned)
    once = events.select("member", "kind", "effective_date", "seat_kind", "discriminator").filter("effective_date is not null").distinct()
    if movers is not None:
        once = once.join(movers.groupBy("member").agg(F.collect_set("year").alias("moves")), "member", "left")
    else:
        once = once.withColumn("moves", F.lit(None).cast("array<int>"))
    rows = spans.withColumn("tag", F.lit(0)).unionByName(once.withColumn("tag", F.lit(1)), allowMissingColumns=True)
    fields = ["member", "kind", "discriminator", "valid_from", "valid_to", "is_active", "origin"]

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        member, held, told, moves = None, [], [], frozenset()
        for frame in frames:
            out: list[dict] = []
            plain = frame.astype(object).where(frame.notna(), None)
            for row in plain.to_dict("records"):
                if row["member"] != member:
                    out += _overlay(held, told, own, current, moves)
                    member, held, told, moves = row["member"], [], [], frozenset()
                if row["tag"] == 0:
                    held.append({f: row[f] for f in fields})
                else:
                    told.append(row)
                    moves = frozenset(int(m) for m in row["moves"]) if row["moves"] is not None else moves
            if out:
                yield pd.DataFrame(out, columns=fields)
        yield pd.DataFrame(_overlay(held, told, own, current, moves), columns=fields)

    ordered = rows.repartition("member").sortWithinPartitions("member", "tag", "effective_date", "kind", "discriminator")
    return ordered.select(*fields, "tag", "effective_date", "seat_kind", "moves").mapInPandas(fold, SPAN)


def stale_close(spans: DataFrame, asserted: DataFrame, keys: list[str], current: int, most_fraction: float = 0.5, floor: int = 5) -> DataFrame:
    """Open spans that nothing asserts: closed at the last day before the current biennium,
    or tombstoned if they began later.  An empty assertion closes nothing; more than
    ``floor`` and more than the fraction of the open spans aborts the sweep."""
    scope = spans.filter("valid_to is null")
    stale = scope.join(asserted.select(*keys).distinct(), keys, "left_anti")
    nonempty = asserted.limit(1).select(F.lit(True).alias("_any"))
    swept = guarded(stale.join(F.broadcast(nonempty), F.lit(True)).drop("_any"), scope, most_fraction, floor)
    end = F.lit(date(current - 1, 12, 31))
    return swept.withColumn("outcome", F.when(F.col("valid_from") > end, "tombstone").otherwise("close")).withColumn("valid_to", F.when(F.col("valid_from") <= end, end))


def sponsor_build(observations: DataFrame, exclusions: DataFrame, artifacts: DataFrame, extras: DataFrame, events: DataFrame, stored: DataFrame, scope: int, owned: list[str], current: int, movers: DataFrame | None = None, most_fraction: float = 0.5) -> DataFrame:
    """source_id, member, kind, discriminator, valid_from, valid_to, outcome {emit, close, tombstone}.

    Excluded (member, year) observations are dropped unless an event of that member is in
    that biennium or later; artifacts are dropped always; then ``extras`` are added, members seen
    from ``scope`` on are kept with their whole history, merged to spans and overlaid by the
    events.  Open ``stored`` spans that the result doesn't assert are swept under a guard."""
    keys = ["member", "kind", "discriminator", "year"]
    latest = events.groupBy("member").agg(F.max(F.year("effective_date") - F.when(F.year("effective_date") % 2 == 0, 1).otherwise(0)).alias("_latest"))
    stale = exclusions.select("member", "year").distinct().join(latest, "member", "left").filter(F.col("_latest").isNull() | (F.col("_latest") < F.col("year")))
    kept = observations.select(*keys).join(stale, ["member", "year"], "left_anti").join(artifacts.select(*keys), keys, "left_anti")
    seen = kept.unionByName(extras.select(*keys)).distinct()
    seen = seen.join(seen.filter(F.col("year") >= scope).select("member").distinct(), "member", "left_semi")
    spans = overlay_events(tenure_spans(seen, current), events, owned, current, movers)
    return emitted_and_swept(spans, stored, current, most_fraction)


def membership_build(observations: DataFrame, events: DataFrame, stored: DataFrame, scope: int, owned: list[str], current: int, most_fraction: float = 0.5) -> DataFrame:
    """As :func:`sponsor_build` of seats: what is seen from ``scope`` on is a member in a seat, not a
    member, so an old seat of a present member stays out; merged, overlaid, emitted, swept."""
    keys = ["member", "kind", "discriminator"]
    seen = observations.select(*keys, "year").distinct()
    seen = seen.join(seen.filter(F.col("year") >= scope).select(*keys).distinct(), keys, "left_semi")
    return emitted_and_swept(overlay_events(tenure_spans(seen, current), events, owned, current), stored, current, most_fraction)


def emitted_and_swept(spans: DataFrame, stored: DataFrame, current: int, most_fraction: float) -> DataFrame:
    """source_id, member, kind, discriminator, valid_from, valid_to, outcome: every span, and the open
    stored ones that none of them asserts, under the guards of :func:`stale_close`."""
    id_ = F.concat_ws(":", "member", "kind", "discriminator", F.year("valid_from")).alias("source_id")
    columns = ["member", "kind", "discriminator", "valid_from", "valid_to"]
    emitted = spans.select(id_, *columns, F.lit("emit").alias("outcome"))
    swept = stale_close(stored.select(id_, *columns), emitted, ["source_id"], current, most_fraction)
    return emitted.unionByName(swept.select("source_id", *columns, "outcome"))


def standing_names(names: DataFrame, key: str, name: str, year: str, order: str) -> DataFrame:
    """year, key, name: in each biennium up to the last, the newest name so far of each key."""
    known = names.filter(F.col(key).isNotNull() & F.col(year).isNotNull() & F.col(name).isNotNull())
    newest = known.groupBy(key, year).agg(F.max_by(name, F.struct(order, name)).alias("_n"))
    last = newest.agg(F.max(year).alias("_hi"))
    grid = newest.groupBy(key).agg(F.min(year).alias("_lo")).join(F.broadcast(last), F.lit(True)).select(key, F.explode(F.sequence("_lo", "_hi", F.lit(2))).alias(year))
    held = F.last("_n", True).over(W.partitionBy(key).orderBy(year))
    return grid.join(newest, [key, year], "left").select(year, key, held.alias(name))


def reconcile_names(cohorts: DataFrame, key: str, name: str, year: str, most_renamed: float = 0.34, least_overlap: float = 0.5) -> DataFrame:
    """year, key, before, after, aborted: per biennium the keys whose name differs from the biennium before.

    ``cohorts`` has one row per key and biennium.  A biennium whose predecessor is empty, whose
    overlap with it is under ``least_overlap`` of the smaller cohort, or in which over
    ``most_renamed`` of the overlap changed, emits no names but one row with the reason.
    Names that differ in case, ``&`` or punctuation only are the same."""
    now = cohorts.select(year, key, F.col(name).alias("after"))
    old = cohorts.select((F.col(year) + 2).alias(year), key, F.col(name).alias("before"))
    plain = lambda x: F.trim(F.regexp_replace(F.replace(F.lower(x), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))
    both = now.join(old, [year, key]).withColumn("_renamed", plain(F.col("before")) != plain(F.col("after")))
    # A row per biennium: the calendar bounds it.
    sums = now.groupBy(year).agg(F.count("*").alias("_now")).join(old.groupBy(year).agg(F.count("*").alias("_old")), year, "left")
    sums = sums.join(both.groupBy(year).agg(F.count("*").alias("_both"), F.count_if("_renamed").alias("_changed")), year, "left")
    shared = F.coalesce("_both", F.lit(0))
    low = shared < F.least("_now", "_old") * least_overlap
    verdict = F.when(F.col("_old").isNull(), "empty_pull").when(low, "low_overlap").when(F.col("_changed") > shared * most_renamed, "rename_storm")
    rated = sums.select(year, verdict.alias("aborted"))
    none = F.lit(None).cast("string")
    stopped = rated.filter("aborted is not null").select(year, none.alias(key), none.alias("before"), none.alias("after"), "aborted")
    passed = both.filter("_renamed").join(F.broadcast(rated.filter("aborted is null")), year)
    return passed.select(year, key, "before", "after", "aborted").unionByName(stopped)


def special_matches(entries: DataFrame, even: DataFrame, odd: DataFrame, key: str, value: str) -> DataFrame:
    """key, even, merged, special: an entry is seated by a special election where the match in both
    cohorts together exists and differs from the match in the even year's alone."""
    a = unique_match(even, [key], value).withColumnRenamed("match", "even")
    b = unique_match(even.select(key, value).unionByName(odd.select(key, value)), [key], value).withColumnRenamed("match", "merged")
    special = F.col("merged").isNotNull() & ~F.col("merged").eqNullSafe(F.col("even"))
    return entries.select(key).distinct().join(a, key, "left").join(b, key, "left").withColumn("special", special)


def retire(spans: DataFrame, asserted: DataFrame, keys: list[str], anchored: str, most_fraction: float = 0.5, floor: int = 5) -> DataFrame:
    """Unasserted spans: retired, or kept and counted where an outside anchor holds them, under the
    guards of :func:`stale_close`: an empty assertion retires nothing, and more than
    ``floor`` that are more than the fraction of all abort."""
    stale = spans.join(asserted.select(*keys).distinct(), keys, "left_anti")
    nonempty = asserted.limit(1).select(F.lit(True).alias("_any"))
    swept = guarded(stale.join(F.broadcast(nonempty), F.lit(True)).drop("_any"), spans, most_fraction, floor)
    return swept.withColumn("outcome", F.when(F.col(anchored), "kept_anchored").otherwise("retired"))


def reconcile_active(cohort: DataFrame, present: DataFrame, prior: DataFrame, group: list[str], key: str, active: str, most_absent: float = 0.34) -> DataFrame:
    """group, key, action {retire, reactivate} or, with a null key, {empty_pull, cohort_floor}.

    ``cohort`` holds all that was ever produced, with its flag; of it only the live era
    counts, what is on the present or the prior roster.  Active and no longer present is
    retired, inactive and present again reactivated.  A group whose present roster is empty, or
    of whose active members more than ``most_absent`` are absent, changes nothing."""
    mark = lambda df, name: df.select(*group, key).distinct().withColumn(name, F.lit(True))
    era = cohort.select(*group, key, active).join(mark(present, "_now"), [*group, key], "left").join(mark(prior, "_then"), [*group, key], "left").filter("_now or _then")
    absent = F.col(active) & F.col("_now").isNull()
    sums = era.groupBy(*group).agg(F.count_if(F.col(active)).alias("_active"), F.count_if(absent).alias("_absent"))
    pulled = present.select(*group).distinct().withColumn("_pulled", F.lit(True))
    verdict = F.when(F.col("_pulled").isNull(), "empty_pull").when(F.col("_absent") > F.col("_active") * most_absent, "cohort_floor")
    rated = sums.join(pulled, group, "left").select(*group, verdict.alias("aborted"))
    moved = era.withColumn("action", F.when(absent, "retire").when(~F.col(active) & F.col("_now"), "reactivate")).filter("action is not null")
    passed = moved.join(rated.filter("aborted is null").select(*group), group).select(*group, key, "action")
    none = F.lit(None).cast(cohort.schema[key].dataType).alias(key)
    return passed.unionByName(rated.filter("aborted is not null").select(*group, none, F.col("aborted").alias("action")))


def event_items(desired: DataFrame, existing: DataFrame) -> DataFrame:
    """org, slug, linked, year, action of desired events against the mirrored ones: create, refine
    (an anchored one of another year), noop, unresolved (its link has no anchor) and
    retracted (which is terminal, so nothing is emitted again).

    ``desired``: org, slug, link, linked, year (``link``: the local id, null for none; ``linked``:
    its remote id).  ``existing``: org, slug, linked, year, anchor, retracted."""
    keys = ["org", "slug"]
    live = existing.filter("not retracted").groupBy(*keys, "linked").agg(F.max(F.struct("anchor", "year")).alias("_e")).select(*keys, F.col("linked").alias("_l"), "_e")
    gone = existing.filter("retracted").select(*keys, F.col("linked").alias("_g"), F.lit(True).alias("_gone")).distinct()
    joined = desired.join(live, [*[desired[k] == live[k] for k in keys], desired["linked"].eqNullSafe(live["_l"])], "left").select(*[desired[c] for c in desired.columns], "_e")
    joined = joined.join(gone, [*[joined[k] == gone[k] for k in keys], joined["linked"].eqNullSafe(gone["_g"])], "left").select(*[joined[c] for c in joined.columns], "_gone")
    action = (
        F.when(F.col("link").isNotNull() & F.col("linked").isNull(), "unresolved")
        .when(F.col("_gone"), "retracted")
        .when(F.col("_e.anchor").isNull(), "create")
        .when(F.col("_e.year").eqNullSafe(F.col("year")), "noop")
        .otherwise("refine")
    )
    return joined.select(*keys, "linked", "year", action.alias("action"))


def supersede(attestations: DataFrame, keys: list[str], order: list[str], digest: str) -> DataFrame:
    """Attestation chain: one row per distinct digest of a key, with ``superseded_by`` the id
    of its correction; the current one has none."""
    once = attestations.groupBy(*keys, digest).agg(F.min(F.struct(*order)).alias("_o"), F.min("id").alias("id"))
    return once.withColumn("superseded_by", F.lead("id").over(W.partitionBy(*keys).orderBy("_o", "id"))).drop("_o")


def positions_by_elimination(roster: DataFrame, matches: DataFrame, seeds: DataFrame, group: list[str]) -> DataFrame:
    """member, qualifier, how {ballot, seed, elimination}: a ballot match wins; a seed counts
    for an unmatched member if its seat is not claimed and no other seed of the group wants
    it; of two members the one left over takes the one position left."""
    base = roster.join(matches, [*group, "member"], "left").join(seeds.withColumnRenamed("qualifier", "seed"), [*group, "member"], "left")
    by = W.partitionBy(*group)
    claimed = F.collect_set("qualifier").over(by)
    wants = F.count(F.when(F.col("qualifier").isNull(), F.col("seed"))).over(W.partitionBy(*group, "seed"))
    seeded = base.withColumn("claimed", claimed).withColumn("wants", wants)
    usable = F.col("qualifier").isNull() & F.col("seed").isNotNull() & ~F.array_contains("claimed", F.col("seed")) & (F.col("wants") == 1)
    placed = seeded.withColumn("q", F.when(usable, F.col("seed")).otherwise(F.col("qualifier"))).withColumn("how", F.when(F.col("qualifier").isNotNull(), "ballot").when(usable, "seed"))
    members, open_ones = F.count("*").over(by), F.count_if(F.col("q").isNull()).over(by)
    rest = F.array_except(F.array(F.lit("Position 1"), F.lit("Position 2")), F.collect_set("q").over(by))
    last = F.col("q").isNull() & (F.col("members") == 2) & (F.col("open_ones") == 1) & (F.size("rest") == 1)
    final = placed.withColumn("members", members).withColumn("open_ones", open_ones).withColumn("rest", rest)
    return final.select(*group, "member", F.when(last, F.get("rest", F.lit(0))).otherwise(F.col("q")).alias("qualifier"), F.when(last, "elimination").otherwise(F.col("how")).alias("how"))


# The verbs that state a start and an end of a tenure, by priority.
START_VERBS, END_VERBS = ["sworn_in", "appointed"], ["deceased", "resigned"]


def proposals(rows: DataFrame, clauses: Column) -> DataFrame:
    """start, end (structs verb, value) and deferred: at most one start and one end per record.

    ``clauses``: an array of verb, value (a day or null), until (a day or null).  The first
    dated clause of the verbs in priority order counts; a start that also states until
    when gives the end where no clause does.  What has neither is deferred: for want of
    a verb of succession, or of a day."""
    c = rows.withColumn("_c", F.coalesce(clauses, F.array().cast(rows.select(clauses.alias("x")).schema["x"].dataType)))

    def dated(verb: str) -> Column:
        return F.get(F.filter("_c", lambda x: (x["verb"] == verb) & x["value"].isNotNull()), F.lit(0))

    def first(verbs: list[str]) -> Column:
        return F.coalesce(*[dated(v) for v in verbs])

    told = c.withColumn("_s", first(START_VERBS)).withColumn("_e", first(END_VERBS))
    pair = lambda verb, value: F.struct(verb.alias("verb"), value.alias("value"))
    start = F.when(F.col("_s").isNotNull(), pair(F.col("_s.verb"), F.col("_s.value")))
    end = F.when(F.col("_e").isNotNull(), pair(F.col("_e.verb"), F.col("_e.value"))).when(F.col("_s.until").isNotNull(), pair(F.lit("until"), F.col("_s.until")))
    named = F.exists("_c", lambda x: F.coalesce(x["verb"].isin(*START_VERBS, *END_VERBS), F.lit(False)))
    deferred = F.when(start.isNull() & end.isNull(), F.when(named, "no_day_precision").otherwise("no_succession_verb"))
    return told.withColumn("start", start).withColumn("end", end).withColumn("deferred", deferred).drop("_c", "_s", "_e")


def backfill(incoming: DataFrame, existing: DataFrame, scope: list[str], value: str, machine: str) -> DataFrame:
    """id, outcome of attestations that are to be filled in: skip (the same is attested), write (the
    scope has none), replace (what it has is a machine's), conflict (it is a person's, or
    another one came before it in the same batch, by id)."""
    held = existing.groupBy(*scope).agg(F.collect_set(value).alias("_v"), F.min(F.coalesce(F.col(machine), F.lit(False))).alias("_m"))
    first = incoming.groupBy(*scope).agg(F.min(F.struct("id", value)).alias("_f"))
    each = incoming.select("id", *scope, value).join(held, scope, "left").join(first, scope)
    later = F.col("id") != F.col("_f.id")
    same_before = later & F.col(value).eqNullSafe(F.col(f"_f.{value}"))
    known = F.coalesce(F.array_contains("_v", F.col(value)), F.lit(False))
    outcome = F.when(known | same_before, "skip").when(later, "conflict").when(F.col("_v").isNull(), "write").when(F.col("_m"), "replace").otherwise("conflict")
    return each.select("id", outcome.alias("outcome"))


def house_roster(members: DataFrame, movers: DataFrame, exclusions: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Members without those who moved to the other chamber and those excluded, unless kept."""
    gone = movers.select(*keys).unionByName(exclusions.select(*keys)).distinct().join(kept.select(*keys).distinct(), keys, "left_anti")
    return members.join(gone, keys, "left_anti")


def classify_orgs(local: DataFrame, remote: DataFrame) -> DataFrame:
    """id, issues, reconciled of local organizations against the remote records they are anchored to.

    ``local``: id, anchor, name, acronym, windows, acronyms, parent.  ``remote``: anchor,
    merged_into, name, acronym, windows, acronyms, parent, former.  Unlinked, missing and
    merged stand alone; else every drift counts: name, acronym (only where the remote has
    a canonical one), name windows, acronyms, parent.  ``reconciled`` is a clean one with a
    curated former name.  Sets compare in no order; blank and null names are equal."""
    r = remote.select("anchor", F.struct(*[c for c in remote.columns if c != "anchor"]).alias("r"))
    both = local.join(r, "anchor", "left")
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    alike = lambda a, b: F.array_sort(F.array_distinct(F.coalesce(a, F.array()))) == F.array_sort(F.array_distinct(F.coalesce(b, F.array())))
    c = F.col
    drifts = F.array_compact(
        F.array(
            F.when(text(c("name")) != text(c("r.name")), "name_drift"),
            F.when(c("r.acronym").isNotNull() & ~F.nullif("acronym", F.lit("")).eqNullSafe(c("r.acronym")), "acronym_drift"),
            F.when(~alike(c("windows"), c("r.windows")), "names_window_drift"),
            F.when(~alike(c("acronyms"), c("r.acronyms")), "acronyms_drift"),
            F.when(~c("parent").eqNullSafe(c("r.parent")), "parent_drift"),
        )
    )
    alone = F.when(c("anchor").isNull(), "unlinked").when(c("r").isNull(), "missing").when(c("r.merged_into").isNotNull(), "merged")
    issues = F.when(alone.isNotNull(), F.array(alone)).otherwise(drifts)
    return both.select("id", issues.alias("issues"), (F.size(issues) == 0) & F.coalesce(c("r.former"), F.lit(False))).toDF("id", "issues", "reconciled")


def sweep_slices(payloads: DataFrame, key: str, body: str, digest: str, budget: int) -> DataFrame:
    """key, slice, outcome {verified, mismatched, unbaselined}: every payload hashed again against
    its stored digest, in slices of ``budget`` bytes behind a cursor over the keys; a
    payload belongs to the slice in which it begins, so the one that crosses a border ends
    its slice, and an oversized one is read whole.

    The bodies are read once and hashed where they are; only keys and sizes are ordered, by
    range partitions and their totals."""
    size = F.coalesce(F.octet_length(body), F.lit(0)).cast("bigint")
    outcome = F.when(F.col(digest).isNull(), "unbaselined").when(F.sha2(body, 256) == F.col(digest), "verified").otherwise("mismatched")
    told = payloads.select(key, size.alias("_size"), outcome.alias("outcome"))
    total = _running(told, [key], F.col("_size"), "_sum")
    return total.select(key, F.floor((F.col("_sum") - F.col("_size")) / budget).alias("slice"), "outcome")


def adopt(rows: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """Stranded rows on the span that covers them: keeper, and whether the anchor moves (the
    keeper has none) or is dropped; rows that none covers stay."""
    covering = rows.join(spans.select(key, F.col("id").alias("keeper"), "valid_from", "valid_to", F.col("anchor").alias("keeper_anchor")), key, "left").filter(
        F.col("keeper").isNull() | ((F.col("valid_from") <= F.col("at")) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("at"))))
    )
    best = covering.groupBy("id", "anchor").agg(F.min(F.struct("valid_from", "keeper", "keeper_anchor")).alias("k"))
    kept = rows.select("id", "anchor").join(best.select("id", "k"), "id", "left")
    # One row per keeper hands its anchor over, that with the least id.
    moves = (F.row_number().over(W.partitionBy("k.keeper").orderBy(F.col("anchor").isNull(), "id")) == 1) & F.col("anchor").isNotNull() & F.col("k.keeper_anchor").isNull()
    outcome = F.when(F.col("k.keeper").isNull(), "stays").when(F.col("anchor").isNull(), "retired").when(F.col("moves"), "anchor_moved").otherwise("anchor_dropped")
    return kept.withColumn("moves", moves).select("id", F.col("k.keeper").alias("keeper"), outcome.alias("outcome"))
