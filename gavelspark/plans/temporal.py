"""Temporal and domain composites (TMP*)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gavelspark.functions import dates as D
from gavelspark.functions import strings as S
from gavelspark.operators import identity as I
from gavelspark.operators import relational as O
from gavelspark.operators import temporal as T
from gavelspark.operators.history import attribute_hash
from gavelspark.operators.renames import biennium_start, counted_changes
from gavelspark.plans.problems import _COUNTED
from gavelspark.plans.registry import Registry
from gavelspark.plans.relational import _CITES, _EVENTS, _HOUSE, _MATCHES, _PERSONS, _PROPOSALS, _STOPPED, _SURNAMED, _WINNERS, persons, surnamed
from gavelspark.session import stored

R = Registry()
c, lit = F.col, F.lit
CURRENT = 2025

_MEMBER = "assembly || '/' || ld"
_OBS = f"(select distinct {_MEMBER} as member, coalesce(qualifier, '?') as discriminator, election_year + 1 as year from house_positions)"
_RUNS = f"(select member, discriminator, min(year) as first, max(year) as last from (select *, year - 2 * row_number() over (partition by member, discriminator order by year) as i from {_OBS}) group by member, discriminator, i)"
_TENURES = f"(select member, discriminator, make_date(first, 1, 1) as valid_from, case when last < {CURRENT} then make_date(last + 1, 12, 31) end as valid_to from {_RUNS})"
_EV = f"(select distinct assembly || '/' || district as member, kind, effective_date from {_PROPOSALS})"


def observations(t):
    return t.house_positions.select(F.concat("assembly", lit("/"), "ld").alias("member"), lit("house").alias("kind"), F.coalesce("qualifier", lit("?")).alias("discriminator"), (c("election_year") + 1).alias("year")).distinct()


def tenures(t):
    return T.tenure_spans(observations(t), CURRENT)


def events(t):
    seat = F.coalesce("seat_discriminator", F.when(c("seat_kind") == "house", lit("Position 1")))
    return t.event_proposals.select(F.concat("assembly", lit("/"), "district").alias("member"), "kind", "effective_date", "seat_kind", seat.alias("discriminator")).distinct()


@R.query("tmp1_overlay")
def tmp1(t):
    movers = t.senate_winners.select(F.concat(F.substring("source", 1, 2), lit("/"), "ld").alias("member"), (c("election_year") + 1).alias("year"))
    return T.overlay_events(tenures(t), events(t), ["house"], CURRENT, movers)


@R.query(
    "tmp1b_departed_only",
    f"""with d as (select member, effective_date as d from {_EV} where kind = 'departed'),
  hit as (select s.member, s.discriminator, s.valid_from, min(d) as d from {_TENURES} s join d on s.member = d.member and (s.valid_to is null or s.valid_to >= d.d) group by 1, 2, 3)
select s.member, s.discriminator, s.valid_from, case when hit.d is null then s.valid_to else greatest(hit.d, s.valid_from) end as valid_to from {_TENURES} s left join hit on s.member = hit.member and s.discriminator = hit.discriminator and s.valid_from = hit.valid_from""",
)
def tmp1b(t):
    return T.overlay_events(tenures(t), events(t).filter("kind = 'departed'"), ["house"], CURRENT).select("member", "discriminator", "valid_from", "valid_to")


@R.query("tmp2_predates", f"select distinct s.member, s.valid_from, e.effective_date from {_TENURES} s join {_EV} e on s.member = e.member and e.effective_date < s.valid_from and e.effective_date >= s.valid_from - interval 365 day")
def tmp2(t):
    joined = tenures(t).select("member", "valid_from").join(events(t).select("member", "effective_date"), "member")
    return joined.filter("effective_date < valid_from and effective_date >= date_sub(valid_from, 365)").distinct()


@R.query("tmp3_stale_exempt", f"select member from {_EV} group by 1 having max(year(effective_date) - case when year(effective_date) % 2 = 0 then 1 else 0 end) >= 2011")
def tmp3(t):
    return events(t).groupBy("member").agg(F.max(D.biennium_start_of(c("effective_date"))).alias("y")).filter("y >= 2011").select("member")


@R.query("tmp4_stale_close", f"with o as (select * from {_TENURES} where valid_to is null), a as (select distinct member from {_OBS} where year = 2023), st as (select * from o where member not in (select member from a)) select member, discriminator, case when valid_from > date '2024-12-31' then 'tombstone' else 'close' end as outcome, case when valid_from <= date '2024-12-31' then date '2024-12-31' end as valid_to from st where (select count(*) from a) > 0 and not ((select count(*) from st) > 5 and (select count(*) from st) > 0.95 * (select count(*) from o))")
def tmp4(t):
    asserted = observations(t).filter("year = 2023").select("member")
    return T.stale_close(tenures(t), asserted, ["member"], CURRENT, most_fraction=0.95).select("member", "discriminator", "outcome", "valid_to")


@R.query("tmp5_retire", f"with s as (select * from {_TENURES} where member not in (select member from {_OBS} where year >= 2015)) select member, discriminator, valid_from, case when member in (select member from {_EV}) then 'kept_anchored' else 'retired' end as outcome from s where (select count(*) from {_OBS} where year >= 2015) > 0 and not ((select count(*) from s) > 5 and (select count(*) from s) > 0.5 * (select count(*) from {_TENURES}))")
def tmp5(t):
    anchored = tenures(t).join(events(t).select("member").distinct().withColumn("a", lit(True)), "member", "left").withColumn("anchored", F.coalesce("a", lit(False)))
    return T.retire(anchored, observations(t).filter("year >= 2015"), ["member"], "anchored").select("member", "discriminator", "valid_from", "outcome")


_EARLIER = f"(select member, discriminator, make_date(min(year), 1, 1) as valid_from, case when max(year) < {CURRENT} then make_date(max(year) + 1, 12, 31) end as valid_to from (select *, year - 2 * row_number() over (partition by member, discriminator order by year) as i from {_OBS} where year < 2015) group by member, discriminator, i)"
_SPAN_ID = "member || ':house:' || discriminator || ':' || year(valid_from)"


@R.query("tmp6_span_emit", f"select a.id as source_id, case when b.id is null then 'insert' when a.valid_to is distinct from b.valid_to then 'update' else 'keep' end as action, p.k is not null as resolved, year(a.valid_from) as cited_from, year(coalesce(a.valid_to, date '{CURRENT}-01-01')) as cited_to from (select *, {_SPAN_ID} as id from {_TENURES}) a left join (select *, {_SPAN_ID} as id from {_EARLIER}) b on a.id = b.id left join (select distinct assembly || '/' || ld as k from house_positions where qualifier is not null) p on a.member = p.k")
def tmp6(t):
    """Spans by their key against those stored from the years before 2015: inserted, updated or kept, with
    the role resolved and the years that the citation covers; nothing is deleted here."""
    id_ = F.concat_ws(":", "member", "kind", "discriminator", F.year("valid_from")).alias("source_id")
    roles = t.house_positions.filter("qualifier is not null").select(F.concat("assembly", lit("/"), "ld").alias("member")).distinct().withColumn("hit", lit(True))
    kept = T.tenure_spans(observations(t).filter("year < 2015"), CURRENT).select(id_, c("valid_to").alias("old_to"), lit(True).alias("had"))
    spans = tenures(t).select(id_, "member", "valid_from", "valid_to").join(roles, "member", "left").join(kept, "source_id", "left")
    action = F.when(c("had").isNull(), "insert").when(c("valid_to").eqNullSafe(c("old_to")), "keep").otherwise("update")
    return spans.select("source_id", action.alias("action"), c("hit").isNotNull().alias("resolved"), F.year("valid_from").alias("cited_from"), F.year(F.coalesce("valid_to", lit(f"{CURRENT}-01-01").cast("date"))).alias("cited_to"))


@R.query("tmp7_append_citations", f"select r.member, r.discriminator, y.range as year from {_RUNS} r, range(1951, 2031, 2) y where y.range between r.first and r.last and y.range not in (select election_year + 1 from senate_winners where election_year % 4 = 0)")
def tmp7(t):
    covered = O.spans_of(observations(t), ["member", "discriminator"], "year").select("member", "discriminator", F.explode(F.sequence("first", "last", lit(2))).alias("year"))
    cited = t.senate_winners.filter("election_year % 4 = 0").select((c("election_year") + 1).alias("year")).distinct()
    return covered.join(F.broadcast(cited), "year", "left_anti").select("member", "discriminator", "year")


_SEATED = f"(select distinct assembly || '/' || district as member, kind, effective_date, seat_kind, coalesce(seat_discriminator, case when seat_kind = 'house' then 'Position 1' end) as disc from {_PROPOSALS})"


@R.query("tmp8_overlay_citation", f"select distinct s.member, s.discriminator, e.kind, e.effective_date from {_TENURES} s join {_SEATED} e on s.member = e.member and e.effective_date >= s.valid_from and (s.valid_to is null or e.effective_date <= s.valid_to) and (e.kind = 'departed' or (e.kind in ('vacated', 'seated') and e.seat_kind = 'house' and e.disc = s.discriminator))")
def tmp8(t):
    """What an event changes it is cited for: a departure all spans of the day, a vacancy or a seating
    the span of its seat."""
    e = events(t).select("member", c("kind").alias("event"), "effective_date", "seat_kind", c("discriminator").alias("seat"))
    j = tenures(t).join(e, "member").filter(O.as_of(c("effective_date"), c("valid_from"), c("valid_to")))
    own = (c("event") == "departed") | (c("event").isin("vacated", "seated") & (c("seat_kind") == "house") & (c("seat") == c("discriminator")))
    return j.filter(own).select("member", "discriminator", c("event").alias("kind"), "effective_date").distinct()


_ATT = "(select source_id, coalesce(content_hash, '') as h, min(fetched_at) as seen, min(id) as id from fetch_events group by 1, 2)"


@R.query("tmp9_supersede", f"select source_id, h, id, lead(id) over (partition by source_id order by seen, id) as superseded_by from {_ATT}")
def tmp9(t):
    rows = t.fetch_events.select("source_id", F.coalesce("content_hash", lit("")).alias("h"), "fetched_at", "id")
    # Each digest counts once, at its first time.
    return T.supersede(rows, ["source_id"], ["fetched_at"], "h").select("source_id", "h", "id", "superseded_by")


_SCOPED = f"(select distinct record_id as id, assembly, district, kind, year(effective_date) as y, effective_date as d, page_number from event_proposals)"


@R.query(
    "tmp10_backfill",
    f"""with e as (select assembly, district, kind, y, list(distinct d) as v, bool_and(page_number < 150) as m from {_SCOPED} where page_number % 2 = 0 group by 1, 2, 3, 4),
  i as (select * from {_SCOPED} where page_number % 2 = 1), f as (select assembly, district, kind, y, min(id) as id, arg_min(d, id) as d from i group by 1, 2, 3, 4)
select i.id, case when coalesce(list_contains(e.v, i.d), false) or (i.id <> f.id and i.d is not distinct from f.d) then 'skip' when i.id <> f.id then 'conflict' when e.v is null then 'write' when e.m then 'replace' else 'conflict' end as outcome
from i join f on i.assembly = f.assembly and i.district = f.district and i.kind = f.kind and i.y = f.y left join e on i.assembly = e.assembly and i.district = e.district and i.kind = e.kind and i.y = e.y""",
)
def tmp10(t):
    """Proposals of odd pages against those of even pages as stored; the first 150 pages were read by machine."""
    rows = t.event_proposals.select(c("record_id").alias("id"), "assembly", "district", "kind", F.year("effective_date").alias("y"), c("effective_date").alias("d"), "page_number").distinct()
    existing = rows.filter("page_number % 2 = 0").withColumn("machine", c("page_number") < 150)
    return T.backfill(rows.filter("page_number % 2 = 1"), existing, ["assembly", "district", "kind", "y"], "d", "machine")


_FLOOR = 2009
_SEATINGS = f"(select distinct assembly as scope, k as fold, ld as seat, election_year + d as year, qualifier as member from (select assembly, ld, election_year, qualifier, unnest(name_keys) as k from {_HOUSE} where qualifier is not null), (values (1), (2)) y(d) where election_year + d >= {_FLOOR})"
_IDENTITIES = f"""with r as (select assembly as scope, surname as fold, record_id as id, session_year as year, district as seat from {_SURNAMED} where surname <> ''),
  pre as (select * from r where year < {_FLOOR}),
  seated as (select * from {_SEATINGS}),
  splits as (select scope, fold, min(year) as boundary from pre where fold like 'mc%' and year >= 2000 group by 1, 2),
  decided as (select distinct scope, fold, case when length(fold) % 2 = 0 then 'Position 1' end as member from r where fold like 'van%'),
  g as (select scope, fold, min(year) as first, coalesce(max(year - before) > 20, false) as wide from (select *, lag(year) over (partition by scope, fold order by year) as before from (select distinct scope, fold, year from pre)) group by 1, 2),
  post as (select p.scope, p.fold, count(distinct s.member) as n, min(s.member) as member from (select distinct scope, fold, seat, year from r where year >= {_FLOOR}) p left join seated s using (scope, fold, seat, year) group by 1, 2),
  probe as (select p.scope, p.fold, count(distinct s.member) as n, min(s.member) as member from (select distinct scope, fold, seat, {_FLOOR} as year from pre where year > {_FLOOR} - 4) p left join seated s using (scope, fold, seat, year) group by 1, 2),
  v as (select g.*, s.boundary, d.fold is not null as is_decided, d.member as decided, p.fold is not null as crossing, coalesce(p.n, 0) as pn, p.member as pm, coalesce(q.n, 0) as qn, q.member as qm
    from g left join splits s using (scope, fold) left join decided d on g.scope = d.scope and g.fold = d.fold left join post p on g.scope = p.scope and g.fold = p.fold left join probe q on g.scope = q.scope and g.fold = q.fold),
  w as (select *, case when boundary is not null then null when wide then 'wide_gap' when crossing and is_decided then null when crossing and pn > 1 then 'ambiguous' when crossing and pn = 0 then 'unresolved' when not crossing and qn > 1 then 'ambiguous' end as reason,
    case when boundary is not null or wide then null when crossing and is_decided then decided when crossing and pn = 1 then pm when not crossing and qn = 1 then qm end as member from v),
  x as (select pre.*, w.boundary, w.first, w.reason, w.member, case when pre.year >= w.boundary then 1 else 0 end as part from pre join w using (scope, fold)),
  identities as (select scope, fold, id, year, case when reason is not null then 'refused' when member is not null then 'joined' else 'minted' end as disposition, reason,
    case when reason is not null then null when member is not null then member else fold || ':' || case when boundary is not null then min(year) over (partition by scope, fold, part) else first end end as identity from x)"""


def identities(t):
    """Every listing from before 2009 and its identity.  Folds that begin with mc are taken as split, with
    van as adjudicated, so that the tables hold every disposition."""
    r = surnamed(t).filter("surname <> ''").select(c("assembly").alias("scope"), c("surname").alias("fold"), c("record_id").alias("id"), c("session_year").alias("year"), c("district").alias("seat"))
    years = F.explode(F.array(c("election_year") + 1, c("election_year") + 2)).alias("year")
    seated = t.house_positions.filter("qualifier is not null").select(c("assembly").alias("scope"), F.explode("name_keys").alias("fold"), c("ld").alias("seat"), c("qualifier").alias("member"), "election_year").select("scope", "fold", "seat", years, "member").filter(c("year") >= _FLOOR)
    splits = r.filter(f"fold like 'mc%' and year >= 2000 and year < {_FLOOR}").groupBy("scope", "fold").agg(F.min("year").alias("boundary"))
    decided = r.filter("fold like 'van%'").select("scope", "fold", F.when(F.length("fold") % 2 == 0, "Position 1").alias("member")).distinct()
    return I.resolve_identities(r, seated, _FLOOR, splits, decided)


@R.query("tmp11_identity_resolution", f"{_IDENTITIES} select * from identities")
def tmp11(t):
    return identities(t)


_YRS = f"(select e.record_id, h.qualifier as cand, count(distinct h.election_year) as years from {_SURNAMED} e join {_HOUSE} h on e.assembly = h.assembly and e.district = h.ld and list_contains(h.name_keys, e.surname) where h.qualifier is not null group by 1, 2)"


@R.query("tmp12_corroboration", f"select record_id, case when max(years) >= 2 and count(*) filter (years = top) = 1 then arg_max(cand, years) end as best from (select *, max(years) over (partition by record_id) as top from {_YRS}) group by 1")
def tmp12(t):
    keys = t.house_positions.filter("qualifier is not null").select("assembly", c("ld").alias("district"), F.explode("name_keys").alias("surname"), c("qualifier").alias("cand"), "election_year").distinct()
    years = surnamed(t).join(keys, ["assembly", "district", "surname"]).groupBy("record_id", "cand").agg(F.count_distinct("election_year").alias("years"))
    top = F.max("years").over(W.partitionBy("record_id"))
    g = years.withColumn("top", top).groupBy("record_id").agg(F.max("years").alias("m"), F.count_if(c("years") == c("top")).alias("k"), F.max_by("cand", "years").alias("b"))
    return g.select("record_id", F.when((c("m") >= 2) & (c("k") == 1), c("b")).alias("best"))


@R.query(
    "tmp13_seat_projection",
    f"""with r as (select distinct assembly, district, record_id::varchar as member from {_SURNAMED}),
  m as (select assembly, district, record_id::varchar as member, min(qualifier) as qualifier from (select e.record_id, e.assembly, e.district, m.qualifier from {_SURNAMED} e join {_MATCHES} m on e.record_id = m.record_id) group by 1, 2, 3 having count(distinct qualifier) = 1),
  b as (select r.*, m.qualifier, case when right(r.member, 1) = '7' then 'Position 2' end as seed from r left join m on r.assembly = m.assembly and r.district is not distinct from m.district and r.member = m.member),
  g as (select assembly, district, list(distinct qualifier) filter (qualifier is not null) as claimed, count(*) as members, count(*) filter (qualifier is null and seed is not null) as wants from b group by 1, 2),
  p as (select b.*, g.members, case when b.qualifier is not null then b.qualifier when seed is not null and wants = 1 and not coalesce(list_contains(claimed, seed), false) then seed end as q from b join g on b.assembly = g.assembly and b.district is not distinct from g.district),
  h as (select assembly, district, count(*) filter (q is null) as open, count(distinct q) as taken, min(q) as one from p group by 1, 2),
  x as (select p.*, p.q is null and p.members = 2 and open = 1 and taken = 1 and one in ('Position 1', 'Position 2') as last, case one when 'Position 1' then 'Position 2' else 'Position 1' end as other from p join h on p.assembly = h.assembly and p.district is not distinct from h.district)
select assembly, district, member, case when last then other else q end as qualifier, case when last then 'elimination' when qualifier is not null then 'ballot' when q is not null then 'seed' end as how from x""",
)
def tmp13(t):
    """Ballot match, seed, elimination per district; of unmatched members whose number ends in 7 a seed is known."""
    group = ["assembly", "district"]
    roster = surnamed(t).select(*group, c("record_id").cast("string").alias("member")).distinct()
    keys = t.house_positions.filter("qualifier is not null").select("assembly", c("ld").alias("district"), F.explode("name_keys").alias("surname"), "qualifier").distinct()
    matched = O.unique_match(surnamed(t).join(keys, ["assembly", "district", "surname"]), [*group, "record_id"], "qualifier").select(*group, c("record_id").cast("string").alias("member"), c("match").alias("qualifier"))
    seeds = roster.select(*group, "member", lit("Position 2").alias("qualifier")).filter(F.substring("member", -1, 1) == "7")
    return T.positions_by_elimination(roster, matched, seeds, group)


_COHORTS = f"""with w as (select assembly || '/' || election_year as cohort, ld as seat, record_id as id, name_keys as keys, qualifier from {_HOUSE}),
  m as (select distinct assembly || '/' || (session_year - 1) as cohort, district as seat, record_id as member, surname, chamber from (select s.*, p.chamber from {_SURNAMED} s join (select distinct record_id, chamber from event_proposals) p using (record_id)) where district is not null),
  h as (select w.cohort, w.seat, w.id, count(distinct m.member) as n, min(m.member) as member from w join m on w.cohort = m.cohort and w.seat = m.seat and m.chamber = 'house' and list_contains(w.keys, m.surname) group by 1, 2, 3),
  s as (select w.cohort, w.seat, w.id, count(distinct m.member) as n from w join m on w.cohort = m.cohort and w.seat = m.seat and m.chamber = 'senate' and list_contains(w.keys, m.surname) group by 1, 2, 3),
  r as (select w.cohort, w.seat, w.id, w.qualifier, coalesce(h.n, 0) as hn, case when h.n = 1 then h.member end as direct, coalesce(s.n, 0) as sn from w left join h using (cohort, seat, id) left join s using (cohort, seat, id)),
  told as (select *, case when direct is not null and row_number() over (partition by cohort, direct order by id) > 1 then 'duplicate' when direct is not null then case when qualifier is null then 'matched' else 'direct' end when sn = 1 then 'mover' when qualifier is not null then 'unresolved' when hn > 1 then 'ambiguous' else 'unmatched' end as outcome from r)"""


def winner_cohorts(t):
    """Winners of each House election, and the listings of the year after as the rosters."""
    won = t.house_positions.select(F.concat_ws("/", "assembly", "election_year").alias("cohort"), c("ld").alias("seat"), c("record_id").alias("id"), c("name_keys").alias("keys"), "qualifier").distinct()
    chambers = t.event_proposals.select("record_id", "chamber").distinct()
    listed = surnamed(t).join(chambers, "record_id").filter("district is not null").select(F.concat_ws("/", "assembly", c("session_year") - 1).alias("cohort"), c("district").alias("seat"), c("record_id").alias("member"), "surname", "chamber").distinct()
    listed = stored(listed)
    return I.project_winners(won, listed.filter("chamber = 'house'"), listed.filter("chamber = 'senate'"))


@R.query("tmp14_winner_projection", f"{_COHORTS} select cohort, seat, id, outcome from told")
def tmp14(t):
    return winner_cohorts(t)[0]


@R.query(
    "tmp14_seats",
    f"""{_COHORTS}, seen as (select cohort, direct as member from told where outcome in ('direct', 'matched')),
  open as (select m.cohort, m.seat, count(distinct m.member) as n, min(m.member) as member from m left join seen on m.cohort = seen.cohort and m.member = seen.member where m.chamber = 'house' and seen.member is null group by 1, 2),
  d as (select cohort, seat, count(*) as n, count(*) filter (outcome = 'mover') as movers, min(qualifier) as qualifier, min(id) as id from told where direct is null group by 1, 2)
select cohort, seat, id, direct as member, qualifier, false as inferred from told where outcome = 'direct'
union all select d.cohort, d.seat, d.id, o.member, d.qualifier, true from d join open o on d.cohort = o.cohort and d.seat = o.seat where d.n = 1 and d.movers = 1 and o.n = 1 and d.qualifier is not null""",
)
def tmp14_seats(t):
    """The members that the winners seat, with the one-for-one replacement of a winner who moved."""
    return winner_cohorts(t)[1]


@R.query("tmp15_roster_builder", f"with m as (select s.record_id, s.assembly, s.surname, p.chamber, p.kind from {_SURNAMED} s join (select distinct record_id, chamber, kind from event_proposals) p on s.record_id = p.record_id), gone as (select assembly, surname from m where chamber = 'senate' union select assembly, surname from m where kind = 'departed' except select assembly, surname from m where kind = 'seated') select record_id from m where chamber = 'house' and not exists (select 1 from gone g where g.assembly = m.assembly and g.surname = m.surname)")
def tmp15(t):
    """House members without movers (listed in the Senate, too) and excluded ones (departed), unless a
    seating keeps them."""
    rows = surnamed(t).join(t.event_proposals.select("record_id", "chamber", "kind").distinct(), "record_id").select("record_id", "assembly", "surname", "chamber", "kind")
    return T.house_roster(rows.filter("chamber = 'house'"), rows.filter("chamber = 'senate'"), rows.filter("kind = 'departed'"), rows.filter("kind = 'seated'"), ["assembly", "surname"]).select("record_id")


@R.query(
    "tmp16_observations",
    f"""select distinct assembly || '/' || district as member, chamber as kind, district::varchar as discriminator, session_year + d as year from {_PROPOSALS}, (values (0), (1)) x(d)
union select person_id, 'sponsor', source, year(sponsored_at) - case when year(sponsored_at) % 2 = 0 then 1 else 0 end from bill_sponsorships where person_id is not null and trim(person_id) <> '' and sponsored_at is not null
union select * from (select {_MEMBER} as member, 'membership' as kind, coalesce(qualifier, '?') as discriminator, election_year + 1 as year from house_positions)""",
)
def tmp16(t):
    """Observations of three sources in one shape: rosters (both years), sponsors and memberships by biennium."""
    roster = t.event_proposals.select(F.concat("assembly", lit("/"), "district").alias("member"), c("chamber").alias("kind"), c("district").cast("string").alias("discriminator"), F.explode(F.array(c("session_year"), c("session_year") + 1)).alias("year"))
    sponsors = t.bill_sponsorships.filter("trim(person_id) <> '' and sponsored_at is not null").select(c("person_id").alias("member"), lit("sponsor").alias("kind"), c("source").alias("discriminator"), D.biennium_start_of(c("sponsored_at")).alias("year"))
    seats = observations(t).withColumn("kind", lit("membership"))
    return roster.unionByName(sponsors).unionByName(seats).distinct()


_NOTES = r"""with p as (select distinct record_id, regexp_replace(replace(evidence, ';', chr(31)), '\)(\s*[A-Za-z(])', chr(31) || '\1', 'g') as e from event_proposals),
  s as (select record_id, unnest(string_split(e, chr(31))) as part, generate_subscripts(string_split(e, chr(31)), 1) as n from p),
  q as (select record_id, n, trim(part, ' ()') as text from s),
  d as (select record_id, n, case when regexp_matches(text, '^(?i:died|deceased)\b') then 'deceased' when regexp_matches(text, '^(?i:sworn\s+in)\b') then 'sworn_in' when regexp_matches(text, '^(?i:appointed)\b') then 'appointed' when regexp_matches(text, '^(?i:resigned)\b') then 'resigned' end as verb,
    try_strptime(regexp_extract(text, '\b([A-Z][a-z]+ \d{1,2}, \d{4})\b', 1), '%B %d, %Y')::date as day from q where text <> ''),
  f as (select record_id, count(verb) as verbs, arg_min(day, n) filter (verb = 'sworn_in' and day is not null) as sworn, arg_min(day, n) filter (verb = 'appointed' and day is not null) as appointed, arg_min(day, n) filter (verb = 'deceased' and day is not null) as died, arg_min(day, n) filter (verb = 'resigned' and day is not null) as resigned from d group by 1)"""


@R.query("tmp17_event_proposals", f"{_NOTES} select record_id, case when sworn is not null then 'sworn_in' when appointed is not null then 'appointed' end as verb, coalesce(sworn, appointed) as starts, case when died is not null then 'deceased' when resigned is not null then 'resigned' end as end_verb, coalesce(died, resigned) as ends, case when coalesce(sworn, appointed, died, resigned) is null then case when verbs > 0 then 'no_day_precision' else 'no_succession_verb' end end as deferred from f")
def tmp17(t):
    rows = t.event_proposals.select("record_id", "evidence").distinct()
    until = lambda x: D.mixed_date(F.nullif(F.regexp_extract(x, r"(?i)\buntil\b(.*)$", 1), lit("")))["value"]
    before = lambda x: F.regexp_replace(x, r"(?i)\buntil\b.*$", "")
    dated = F.transform(S.clauses(c("evidence")), lambda x: F.struct(x["verb"].alias("verb"), D.mixed_date(before(x["text"]))["value"].alias("value"), until(x["text"]).alias("until")))
    return T.proposals(rows, dated).select("record_id", "start.verb", c("start.value").alias("starts"), c("end.verb").alias("end_verb"), c("end.value").alias("ends"), "deferred")


_PEOPLE = f"(select upper(left(source_id, 2)) || '-' || lpad(regexp_extract(source_id, '^[A-Za-z]{{2}}\\W*0*(\\d+)', 1), 6, '0') as assembly, regexp_replace(lower(name_last), '[^a-z]', '', 'g') as surname, count(distinct id) as n from {_PERSONS} group by 1, 2)"


@R.query("tmp18_resolution", f"select e.record_id, case when e.seat_kind is null then 'no_seat' when m.q is null then 'no_position' when m.q > 1 then 'ambiguous' else 'resolved' end as seat, case when p.n is null then 'no_member' when p.n > 1 then 'ambiguous' else 'resolved' end as member from {_PROPOSALS} e join {_SURNAMED} s on e.record_id = s.record_id left join {_PEOPLE} p on s.assembly = p.assembly and s.surname = p.surname left join (select record_id, count(distinct qualifier) as q from {_MATCHES} group by 1) m on e.record_id = m.record_id")
def tmp18(t):
    """Both sides of a proposal: its seat by the ballot, its member by the surname in the assembly's directory."""
    keys = t.house_positions.filter("qualifier is not null").select("assembly", c("ld").alias("district"), F.explode("name_keys").alias("surname"), "qualifier").distinct()
    named = surnamed(t)
    m = named.join(keys, ["assembly", "district", "surname"]).groupBy("record_id").agg(F.count_distinct("qualifier").alias("q"))
    people = persons(t).groupBy(S.assembly_code(F.split_part("source_id", lit(":"), lit(1))).alias("assembly"), F.regexp_replace(F.lower("name_last"), "[^a-z]", "").alias("surname")).agg(F.count_distinct("id").alias("n"))
    seat = F.when(c("seat_kind").isNull(), "no_seat").when(c("q").isNull(), "no_position").when(c("q") > 1, "ambiguous").otherwise("resolved")
    member = F.when(c("n").isNull(), "no_member").when(c("n") > 1, "ambiguous").otherwise("resolved")
    rows = t.event_proposals.select("record_id", "seat_kind").distinct().join(named.select("record_id", "assembly", "surname"), "record_id")
    return rows.join(m, "record_id", "left").join(people, ["assembly", "surname"], "left").select("record_id", seat.alias("seat"), member.alias("member"))


@R.query("tmp19_corroboration_gate", "select w.ld, w.election_year, case when bool_or(h.ld is not null and list_has_any(w.name_keys, h.name_keys)) then 'ok' when bool_or(h.ld is not null) then 'mismatched' else 'missing' end as gate from senate_winners w left join house_positions h on w.ld = h.ld and w.election_year = h.election_year group by 1, 2")
def tmp19(t):
    h = t.house_positions.select("ld", "election_year", c("name_keys").alias("k"), lit(True).alias("hit")).distinct()
    j = t.senate_winners.select("ld", "election_year", "name_keys").distinct().join(h, ["ld", "election_year"], "left")
    ok = F.max(F.coalesce(c("hit") & F.arrays_overlap("name_keys", "k"), lit(False)))
    return j.groupBy("ld", "election_year").agg(F.when(ok, "ok").when(F.max(F.coalesce("hit", lit(False))), "mismatched").otherwise("missing").alias("gate"))


@R.query(
    "tmp20_invariants",
    """with p as (select distinct assembly, election_year, ld, qualifier, record_id, array_to_string(list_sort(name_keys), ',') as member from house_positions where qualifier is not null),
  s as (select assembly, election_year, ld, qualifier, count(distinct record_id) as k from p group by 1, 2, 3, 4),
  m as (select assembly, election_year, member, count(distinct (ld, qualifier)) as k from p where member is not null group by 1, 2, 3)
select s.assembly, s.election_year, count(distinct ld) as districts, count(*) as seats, count(*) filter (s.k > 1) as held_twice, coalesce(any_value(d.n), 0) as members_twice, count(distinct ld) = 49 and count(*) = 98 and count(*) filter (s.k > 1) = 0 and coalesce(any_value(d.n), 0) = 0 as whole
from s left join (select assembly, election_year, count(*) filter (k > 1) as n from m group by 1, 2) d on s.assembly = d.assembly and s.election_year = d.election_year group by 1, 2""",
)
def tmp20(t):
    """A whole chamber has 49 districts of two seats, no seat twice and no member in two seats."""
    keys = ["assembly", "election_year"]
    p = t.house_positions.filter("qualifier is not null").select(*keys, "ld", "qualifier", "record_id", F.array_join(F.array_sort("name_keys"), ",").alias("member")).distinct()
    seats = p.groupBy(*keys, "ld", "qualifier").agg(F.count_distinct("record_id").alias("k"))
    twice = p.filter("member is not null").groupBy(*keys, "member").agg(F.count_distinct("ld", "qualifier").alias("m")).groupBy(*keys).agg(F.count_if(c("m") > 1).alias("members_twice"))
    sums = seats.groupBy(*keys).agg(F.count_distinct("ld").alias("districts"), F.count("*").alias("seats"), F.count_if(c("k") > 1).alias("held_twice"))
    rated = sums.join(twice, keys, "left").withColumn("members_twice", F.coalesce("members_twice", lit(0)))
    return rated.withColumn("whole", (c("districts") == 49) & (c("seats") == 98) & (c("held_twice") == 0) & (c("members_twice") == 0))


_SEEN = "(select distinct assembly, ld from house_positions where election_year {})"


@R.query(
    "tmp21_active_reconcile",
    f"""with k as {_SEEN.format('<= 2012')}, now as {_SEEN.format('in (2011, 2012)')}, prior as {_SEEN.format('in (2009, 2010)')},
  era as (select k.*, prior.ld is not null as active, now.ld is not null as present from k left join now on k.assembly = now.assembly and k.ld = now.ld left join prior on k.assembly = prior.assembly and k.ld = prior.ld where now.ld is not null or prior.ld is not null),
  g as (select assembly, count(*) filter (active) as n, count(*) filter (active and not present) as gone, bool_or(present) as pulled from era group by 1),
  v as (select assembly, case when not pulled then 'empty_pull' when gone > 0.34 * n then 'cohort_floor' end as aborted from g)
select e.assembly, e.ld, case when active then 'retire' else 'reactivate' end as action from era e join v on e.assembly = v.assembly where v.aborted is null and active <> present
union all select assembly, null, aborted from v where aborted is not null""",
)
def tmp21(t):
    """Districts of each assembly: on the roster of 2012 or not, active if they were on that of 2010."""
    seen = lambda condition: t.house_positions.filter(condition).select("assembly", "ld").distinct()
    present, prior = seen("election_year in (2011, 2012)"), seen("election_year in (2009, 2010)")
    cohort = seen("election_year <= 2012").join(prior.withColumn("a", lit(True)), ["assembly", "ld"], "left").select("assembly", "ld", F.coalesce("a", lit(False)).alias("active"))
    return T.reconcile_active(cohort, present, prior, ["assembly"], "ld", "active")


@R.query("tmp22_rename_reconcile", "with x as (select source_id, count(*) as n, count(*) filter (lower(former_name) <> lower(legal_name)) as renamed from rename_transitions group by 1) select source_id, renamed, case when renamed > 0.34 * n and n >= 5 then 'abort_storm' when renamed = 0 then 'noop' else 'rename' end as action from x")
def tmp22(t):
    x = t.rename_transitions.groupBy("source_id").agg(F.count("*").alias("n"), F.count_if(F.lower("former_name") != F.lower("legal_name")).alias("renamed"))
    return x.select("source_id", "renamed", F.when((c("renamed") > 0.34 * c("n")) & (c("n") >= 5), "abort_storm").when(c("renamed") == 0, "noop").otherwise("rename").alias("action"))


@R.query("tmp22_cohort_reconcile")
def tmp22_all(t):
    """Names of all biennia against those of the biennium before, under the three guards."""
    y = F.substring(F.trim("boundary_biennium"), 1, 4).cast("int")
    rows = t.rename_transitions.select("source_id", "legal_name", "recorded_at", (y - F.when(y % 2 == 0, 1).otherwise(0)).alias("year"))
    return T.reconcile_names(T.standing_names(rows, "source_id", "legal_name", "year", "recorded_at"), "source_id", "legal_name", "year")


_YEAR = "cast(left(trim(boundary_biennium), 4) as integer)"
_ITEMS = f"""(select source_id as org, 'founded' as slug, null as link, null as linked, min({_YEAR}) as year from rename_transitions group by 1
  union all select source_id, 'dissolved', null, null, max({_YEAR}) from rename_transitions group by 1
  union all select a.source_id, 'succeeded_by', b.source_id, case when b.source_id::bigint % 5 > 0 then 'r' || b.source_id end, min(a.y) from (select distinct source_id, {_YEAR} as y, legal_name from rename_transitions) a join (select distinct source_id, former_name from rename_transitions) b on a.legal_name = b.former_name and a.source_id < b.source_id group by 1, 3)"""
# What the remote side holds is what the records of before 2021 told.
_MIRROR = f"""(select source_id as org, 'founded' as slug, null as linked, min({_YEAR}) as year, case when source_id::bigint % 3 > 0 then source_id end as anchor, source_id::bigint % 7 = 0 as retracted from rename_transitions where recorded_at < timestamp '2021-01-01' group by 1
  union all select source_id, 'dissolved', null, max({_YEAR}), source_id, false from rename_transitions where recorded_at < timestamp '2021-01-01' group by 1)"""


@R.query("tmp23_event_diff", f"select d.org, d.slug, d.linked, d.year, case when d.link is not null and d.linked is null then 'unresolved' when e.retracted then 'retracted' when e.anchor is null then 'create' when e.year is not distinct from d.year then 'noop' else 'refine' end as action from {_ITEMS} d left join {_MIRROR} e on d.org = e.org and d.slug = e.slug and d.linked is not distinct from e.linked")
def tmp23(t):
    """Founded, dissolved and succession events against those mirrored from the records of before 2021."""
    y = F.substring(F.trim("boundary_biennium"), 1, 4).cast("int")
    r = t.rename_transitions.select(c("source_id").alias("org"), y.alias("y"), "former_name", "legal_name", "recorded_at")
    null = lit(None).cast("string")
    ends = lambda rows: rows.groupBy("org").agg(F.min("y").alias("founded"), F.max("y").alias("dissolved"))
    spread = lambda rows: rows.select("org", F.explode(F.create_map(lit("founded"), c("founded"), lit("dissolved"), c("dissolved"))).alias("slug", "year"))
    after = r.select("org", "y", c("legal_name").alias("name")).distinct().join(r.select(c("org").alias("link"), c("former_name").alias("name")).distinct(), "name").filter("org < link")
    remote_id = F.when(c("link").cast("bigint") % 5 > 0, F.concat(lit("r"), "link"))
    links = after.groupBy("org", "link").agg(F.min("y").alias("year")).select("org", lit("succeeded_by").alias("slug"), "link", remote_id.alias("linked"), "year")
    desired = spread(ends(r)).select("org", "slug", null.alias("link"), null.alias("linked"), "year").unionByName(links)
    number = c("org").cast("bigint")
    anchor = F.when((c("slug") == "dissolved") | (number % 3 > 0), c("org"))
    mirrored = spread(ends(r.filter("recorded_at < '2021-01-01'"))).select("org", "slug", null.alias("linked"), "year", anchor.alias("anchor"), ((c("slug") == "founded") & (number % 7 == 0)).alias("retracted"))
    return T.event_items(desired, mirrored)


def _org_sql(cut: str) -> str:
    return f"(select source_id as id, arg_max(legal_name, (recorded_at, legal_name)) as name, upper(left(arg_max(legal_name, (recorded_at, legal_name)), 1)) as acronym, list_sort(list(distinct legal_name || '@' || {_YEAR})) as windows, list_sort(list(distinct upper(left(legal_name, 1)))) as acronyms, max({_YEAR}) % 4 as parent, bool_or(former_name is not null) as former from rename_transitions where legal_name is not null {cut} group by 1)"


@R.query(
    "tmp24_classification",
    f"""with l as (select *, case when id::bigint % 9 > 0 then id end as anchor from {_org_sql('')}), r as (select * from {_org_sql("and recorded_at < timestamp '2022-01-01'")} where id::bigint % 10 > 0),
  j as (select l.id, l.anchor, r.id as rid, r.id::bigint % 11 = 0 as merged, r.former, list_filter([case when trim(l.name) <> trim(r.name) then 'name_drift' end, case when l.acronym <> r.acronym then 'acronym_drift' end, case when l.windows <> r.windows then 'names_window_drift' end, case when l.acronyms <> r.acronyms then 'acronyms_drift' end, case when l.parent <> r.parent then 'parent_drift' end], lambda x: x is not null) as d from l left join r on l.anchor = r.id)
select id, case when anchor is null then 'unlinked' when rid is null then 'missing' when merged then 'merged' else array_to_string(d, ',') end as issues, anchor is not null and rid is not null and not merged and len(d) = 0 and former as reconciled from j""",
)
def tmp24(t):
    """Committees as of all records against the same as of those recorded before 2022; every ninth has no
    anchor, the remote side lacks every tenth and has merged every eleventh."""
    y = F.substring(F.trim("boundary_biennium"), 1, 4).cast("int")

    def orgs(rows):
        name = F.max_by("legal_name", F.struct("recorded_at", "legal_name"))
        initial = F.upper(F.substring("legal_name", 1, 1))
        agg = rows.filter("legal_name is not null").withColumn("y", y).groupBy(c("source_id").alias("id")).agg(name.alias("name"), F.collect_set(F.concat("legal_name", lit("@"), "y")).alias("windows"), F.collect_set(initial).alias("acronyms"), (F.max("y") % 4).alias("parent"), F.max(c("former_name").isNotNull()).alias("former"))
        return agg.withColumn("acronym", F.upper(F.substring("name", 1, 1))).withColumn("n", c("id").cast("bigint"))

    local = orgs(t.rename_transitions).withColumn("anchor", F.when(c("n") % 9 > 0, c("id")))
    remote = orgs(t.rename_transitions.filter("recorded_at < '2022-01-01'")).filter("n % 10 > 0").withColumn("merged_into", F.when(c("n") % 11 == 0, lit("other"))).withColumnRenamed("id", "anchor")
    fields = ["name", "acronym", "windows", "acronyms", "parent"]
    told = T.classify_orgs(local.select("id", "anchor", *fields), remote.select("anchor", "merged_into", *fields, "former"))
    return told.select("id", F.array_join("issues", ",").alias("issues"), "reconciled")


_LINEAGE = f"""with l as (select source_id, arg_max(legal_name, (recorded_at, legal_name)) as name, min({_YEAR}) as founded, max({_YEAR}) as dissolved from rename_transitions group by 1),
  n as (select *, list_filter(list_distinct(regexp_split_to_array(lower(name), '[^a-z0-9]+')), lambda x: x <> '' and x not in {_STOPPED}) as w from l),
  p as (select a.source_id as a, b.source_id as b, len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) as s, b.founded - a.dissolved between 0 and 2 or a.founded - b.dissolved between 0 and 2 as near, a.dissolved <> b.dissolved as sure from n a join n b on a.source_id < b.source_id and len(list_intersect(a.w, b.w)) > 0)
select a, b, round(s + case when near then 0.5 else 0 end, 3) as score, sure as direction_certain from p where s >= 0.34"""


@R.query("tmp25_lineage_scoring", _LINEAGE)
def tmp25(t):
    """Similar pairs scored by shared words, adjacent windows and shared years."""
    y = F.substring(F.trim("boundary_biennium"), 1, 4).cast("int")
    info = t.rename_transitions.groupBy("source_id").agg(F.max_by("legal_name", F.struct("recorded_at", "legal_name")).alias("name"), F.min(y).alias("founded"), F.max(y).alias("dissolved"))
    info = info.withColumn("w", S.significant_tokens(c("name")))
    each = info.select("*", F.explode("w").alias("k"))
    a = each.select(*[c(x).alias(f"{x}_a") for x in ("source_id", "w", "founded", "dissolved")], "k")
    b = each.select(*[c(x).alias(f"{x}_b") for x in ("source_id", "w", "founded", "dissolved")], "k")
    pairs = a.join(b, "k").filter("source_id_a < source_id_b").drop("k").distinct().withColumn("s", S.jaccard(c("w_a"), c("w_b"))).filter("s >= 0.34")
    adjacent = F.when(((c("founded_b") - c("dissolved_a")).between(0, 2)) | ((c("founded_a") - c("dissolved_b")).between(0, 2)), 0.5).otherwise(0.0)
    return pairs.select(c("source_id_a").alias("a"), c("source_id_b").alias("b"), F.round(c("s") + adjacent, 3).alias("score"), (c("dissolved_a") != c("dissolved_b")).alias("direction_certain"))


def stranded(t):
    rows = t.event_proposals.distinct().select(F.concat("assembly", lit("/"), "district").alias("member"), c("record_id").alias("id"), c("effective_date").alias("at"), F.when(c("record_id") % 2 == 0, c("record_id")).alias("anchor"))
    spans = tenures(t).select("member", F.concat_ws(":", "member", "discriminator", "valid_from").alias("id"), "valid_from", "valid_to", lit(None).cast("bigint").alias("anchor"))
    return rows, spans


_ADOPTED = f"""with r as (select distinct assembly || '/' || district as member, record_id as id, effective_date as at, case when record_id % 2 = 0 then record_id end as anchor from event_proposals),
  s as (select member, concat_ws(':', member, discriminator, valid_from::varchar) as id, valid_from, valid_to from {_TENURES}),
  k as (select r.id, r.anchor, arg_min(s.id, (s.valid_from, s.id)) as keeper from r left join s on r.member = s.member and s.valid_from <= r.at and (s.valid_to is null or s.valid_to >= r.at) group by 1, 2),
  m as (select *, anchor is not null and row_number() over (partition by keeper order by anchor is null, id) = 1 as moves from k)
select id, keeper, case when keeper is null then 'stays' when anchor is null then 'retired' when moves then 'anchor_moved' else 'anchor_dropped' end as outcome from m"""


@R.query("tmp26_source_migration", _ADOPTED)
def tmp26(t):
    return T.adopt(*stranded(t), "member")


@R.query("tmp27_integrity", "select doc_id, floor((sum(n) over (order by doc_id) - n) / 1048576)::bigint as slice, case when doc_id % 13 = 0 then 'unbaselined' when text is null then 'mismatched' else 'verified' end as outcome from (select doc_id, text, coalesce(strlen(text), 0) as n from documents)")
def tmp27(t):
    """All bodies hashed again, a megabyte at a time, against the digests stored when they came: a
    body that is gone is a mismatch; every thirteenth had no baseline."""
    archive = stored(t.documents.select("doc_id", F.when(c("doc_id") % 13 > 0, F.sha2(F.coalesce("text", lit("gone")), 256)).alias("digest")))
    return T.sweep_slices(t.documents.select("doc_id", "text").join(archive, "doc_id"), "doc_id", "text", "digest", 1_048_576)


_PAYLOAD = "name_full, name_first, name_last, name_middle, name_suffix, name_used, gender, archived_at, deleted_at"


@R.query("tmp28_clock_heal", f"select a.id, b.seen as updated_at from {_PERSONS} a join (select id, {_PAYLOAD}, min(updated_at) as seen from persons group by all) b on a.id = b.id and ({_PAYLOAD.replace('name_', 'a.name_').replace('gender', 'a.gender').replace('archived_at', 'a.archived_at').replace('deleted_at', 'a.deleted_at')}) is not distinct from ({_PAYLOAD.replace('name_', 'b.name_').replace('gender', 'b.gender').replace('archived_at', 'b.archived_at').replace('deleted_at', 'b.deleted_at')}) and b.seen < a.updated_at")
def tmp28(t):
    """A clock that moved without the payload goes back to when this payload was first seen."""
    payload = attribute_hash(*[c(x.strip()) for x in _PAYLOAD.split(",")])
    first = t.persons.withColumn("h", payload).groupBy("id", "h").agg(F.min("updated_at").alias("seen"))
    return persons(t).withColumn("h", payload).select("id", "h", "updated_at").join(first, ["id", "h"]).filter("seen < updated_at").select("id", c("seen").alias("updated_at"))


@R.query("tmp29_sponsor_build", f"with o as (select * from {_OBS} where member in (select member from {_OBS} where year >= 2011) and member not in (select member from {_EV} where kind = 'vacated')) select member, discriminator, make_date(min(year), 1, 1) as valid_from, case when max(year) < {CURRENT} then make_date(max(year) + 1, 12, 31) end as valid_to from (select *, year - 2 * row_number() over (partition by member, discriminator order by year) as i from o) group by member, discriminator, i")
def tmp29(t):
    """Exclusions out, members scoped, their whole history merged."""
    o = observations(t)
    scoped = o.join(o.filter("year >= 2011").select("member").distinct(), "member", "left_semi").join(events(t).filter("kind = 'vacated'").select("member"), "member", "left_anti")
    return T.tenure_spans(scoped, CURRENT).select("member", "discriminator", "valid_from", "valid_to")


@R.query("tmp29_sponsor_pipeline")
def tmp29_all(t):
    """TMP1 to TMP8 in a row: observations after a vacancy are stale, seats without a name are
    artifacts, the proposals' rosters are extras; spans stored before are all without events."""
    o, e = observations(t), events(t)
    vacated = e.filter("kind = 'vacated'").groupBy("member").agg(F.max("effective_date").alias("gone"))
    stale = o.join(vacated, "member").filter(c("year") > D.biennium_start_of(c("gone"))).select("member", "year")
    seat = t.event_proposals.filter("seat_kind = 'house' and seat_discriminator is not null")
    extras = seat.select(F.concat("assembly", lit("/"), "district").alias("member"), c("seat_kind").alias("kind"), c("seat_discriminator").alias("discriminator"), (c("session_year") - F.when(c("session_year") % 2 == 0, 1).otherwise(0)).alias("year"))
    movers = t.senate_winners.select(F.concat(F.substring("source", 1, 2), lit("/"), "ld").alias("member"), (c("election_year") + 1).alias("year"))
    stored = tenures(t).filter("valid_to is null")
    return T.sponsor_build(o, stale, o.filter("discriminator = '?'"), extras, e, stored, 2011, ["house"], CURRENT, movers)


@R.query("tmp30_membership_build", f"with o as (select * from {_OBS} where (member, discriminator) in (select (member, discriminator) from {_OBS} where year >= 2011)) select member, discriminator, make_date(min(year), 1, 1) as valid_from from (select *, year - 2 * row_number() over (partition by member, discriminator order by year) as i from o) group by member, discriminator, i")
def tmp30(t):
    o = observations(t)
    scoped = o.join(o.filter("year >= 2011").select("member", "discriminator").distinct(), ["member", "discriminator"], "left_semi")
    return T.tenure_spans(scoped, CURRENT).select("member", "discriminator", "valid_from")


@R.query("tmp31_roster_build", f"{_IDENTITIES} select scope, fold, disposition, identity, reason, count(*) as listings, min(year) as first, max(year) as last from identities group by 1, 2, 3, 4, 5")
def tmp31(t):
    """One row per identity (or refusal) with its listings; the joined ones carry their member."""
    return identities(t).groupBy("scope", "fold", "disposition", "identity", "reason").agg(F.count("*").alias("listings"), F.min("year").alias("first"), F.max("year").alias("last"))


@R.query("tmp32_house_build", f"select coalesce(a.record_id, b.record_id) as record_id, a.q is distinct from b.q as special from (select record_id, min(qualifier) as q from {_MATCHES} group by 1) a full outer join (select record_id, max(qualifier) as q from {_MATCHES} group by 1) b on a.record_id = b.record_id")
def tmp32(t):
    keys = t.house_positions.filter("qualifier is not null").select("assembly", c("ld").alias("district"), F.explode("name_keys").alias("surname"), "qualifier").distinct()
    g = surnamed(t).join(keys, ["assembly", "district", "surname"]).groupBy("record_id").agg(F.min("qualifier").alias("a"), F.max("qualifier").alias("b"))
    return g.select("record_id", (~c("a").eqNullSafe(c("b"))).alias("special"))


@R.query("tmp32_special_matches")
def tmp32_all(t):
    """Per proposal the match in its biennium's even election, and that with the odd one added."""
    keys = t.house_positions.filter("qualifier is not null").select("assembly", c("ld").alias("district"), F.explode("name_keys").alias("surname"), "qualifier", "election_year").distinct()
    start = c("session_year") - F.when(c("session_year") % 2 == 0, 1).otherwise(0)
    rows = surnamed(t).withColumn("start", start)
    hits = rows.join(keys, ["assembly", "district", "surname"])
    return T.special_matches(rows, hits.filter("election_year = start - 1"), hits.filter("election_year = start"), "record_id", "qualifier")


@R.query("tmp33_catalog_mirror", "select slug, case when slug not like '%mar%' then upper(name) else name end as name, slug not like '%mar%' as listed, slug not like '%mar%' and code < 'P' as offered from (select distinct slug, name, code from jurisdictions) union all select 'zz-new', 'NEW', true, true")
def tmp33(t):
    """The remote catalog mirrored by slug: listed rows take its name and flags, new ones are added, and
    a row that it lists no more stays but loses both flags."""
    have = t.jurisdictions.select("slug", "name", "code").distinct()
    added = t.spark.createDataFrame([("zz-new", "NEW", True)], "slug string, remote string, offer boolean")
    remote = have.filter(~c("slug").like("%mar%")).select("slug", F.upper("name").alias("remote"), (c("code") < "P").alias("offer")).unionByName(added).withColumn("hit", lit(True))
    listed = F.coalesce("hit", lit(False))
    return have.join(remote, "slug", "full_outer").select("slug", F.coalesce("remote", "name").alias("name"), listed.alias("listed"), (listed & F.coalesce("offer", lit(False))).alias("offered"))


@R.query("tmp34_retract", f"select r.id, case when p.id is null then 'not_found' when p.deleted_at is not null then 'already' when p.name_used is null then 'not_anchored' else 'would' end as outcome from (select id from persons union select left(id, 20) || 'ZZZZZZ' from persons) r left join {_PERSONS} p on r.id = p.id")
def tmp34(t):
    ids = t.persons.select("id").unionByName(t.persons.select(F.concat(F.substring("id", 1, 20), lit("ZZZZZZ")).alias("id"))).distinct()
    p = persons(t).select("id", "deleted_at", "name_used", lit(True).alias("hit"))
    return ids.join(p, "id", "left").select("id", F.when(c("hit").isNull(), "not_found").when(c("deleted_at").isNotNull(), "already").when(c("name_used").isNull(), "not_anchored").otherwise("would").alias("outcome"))


@R.query("tmp35_curation_heal", f"select a.id, case when a.archived_at is null and a.deleted_at is null and a.source_id is not null then b.name else a.name_full end as name, case when a.archived_at is null and a.deleted_at is null and a.source_id is not null then b.at else a.updated_at end as updated_at from {_PERSONS} a join (select id, min(updated_at) as at, arg_min(name_full, (updated_at, name_full)) as name from persons group by 1) b on a.id = b.id")
def tmp35(t):
    """Anchored live rows take the remote record and its clock, older or not; the remote side is
    taken to hold each person's first version."""
    remote = t.persons.groupBy("id").agg(F.min(F.struct("updated_at", "name_full")).alias("r"))
    heal = c("archived_at").isNull() & c("deleted_at").isNull() & c("source_id").isNotNull()
    rows = persons(t).select("id", "name_full", "updated_at", "archived_at", "deleted_at", "source_id").join(remote, "id")
    return rows.select("id", F.when(heal, c("r.name_full")).otherwise(c("name_full")).alias("name"), F.when(heal, c("r.updated_at")).otherwise(c("updated_at")).alias("updated_at"))


@R.query("tmp36_chain_emission", f"with {_COUNTED} select h.source_id, h.y as year, case when k.source_id is not null then 'emitted' when p.source_id is not null then 'hidden' else 'unproduced' end as outcome from (select distinct source_id, y from typed where y is not null and source_id is not null) h left join (select distinct source_id, y from counted) k on h.source_id = k.source_id and h.y = k.y left join (select distinct source_id from counted) p on h.source_id = p.source_id")
def tmp36(t):
    """Every transition on record: emitted where it counts, hidden where the committee has others that
    do, unproduced where it has none."""
    r = t.rename_transitions.select("source_id", biennium_start(c("boundary_biennium")).alias("year")).filter("source_id is not null and year is not null").distinct()
    counted = counted_changes(t.rename_transitions).select("source_id", c("start_year").alias("year"), lit(True).alias("counts"))
    produced = counted.select("source_id", lit(True).alias("any")).distinct()
    outcome = F.when(c("counts"), "emitted").when(c("any"), "hidden").otherwise("unproduced")
    return r.join(counted, ["source_id", "year"], "left").join(produced, "source_id", "left").select("source_id", "year", outcome.alias("outcome"))


@R.query("tmp37_row_migration", f"select e.record_id as id, count(s.member) > 0 as covered from (select record_id, assembly || '/' || district as member, effective_date as d from {_PROPOSALS}) e left join {_TENURES} s on e.member = s.member and s.valid_from <= e.d and (s.valid_to is null or s.valid_to >= e.d) group by 1")
def tmp37(t):
    rows, spans = stranded(t)
    return T.adopt(rows, spans, "member").select("id", (c("outcome") != "stays").alias("covered"))


@R.query("tmp30_membership_pipeline")
def tmp30_all(t):
    """TMP1 to TMP8 in a row for seats; spans stored before are all without events."""
    return T.membership_build(observations(t), events(t), tenures(t).filter("valid_to is null"), 2011, ["house"], CURRENT)


QUERIES, ORACLE = R.queries, R.oracle
