"""Projections, joins and aggregations (PRJ*, JOIN*, AGG*)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gavelspark.functions import dates as D
from gavelspark.functions import strings as S
from gavelspark.functions.json import canonical_json
from gavelspark.operators import relational as O
from gavelspark.operators.history import newest
from gavelspark.plans.registry import Registry

R = Registry()
c, lit = F.col, F.lit

# Tables without their repeats; the versioned ones at their newest version.
_PERSONS = "(select * from persons qualify row_number() over (partition by id order by updated_at desc) = 1)"
_SESSIONS = "(select * from legislative_sessions qualify row_number() over (partition by id order by updated_at desc) = 1)"
_CITES = "(select distinct * from citations)"
_EVENTS = "(select distinct * from fetch_events)"
_BILLS = "(select distinct * from bill_sponsorships)"
_HOUSE = "(select distinct * from house_positions)"
_WINNERS = "(select distinct * from senate_winners)"
_PROPOSALS = "(select distinct * from event_proposals)"


def persons(t):
    return newest(t.persons, ["id"], "updated_at")


def sessions(t):
    return newest(t.legislative_sessions, ["id"], "updated_at")


# Projections -----------------------------------------------------------------------------------------


@R.query("prj1_wire_person", f"select id, nullif(trim(name_first || ' ' || name_last), '') as name_full, case when name_full <> trim(name_first || ' ' || name_last) then name_full end as name_used from {_PERSONS}")
def prj1(t):
    full = F.trim(F.concat("name_first", lit(" "), "name_last"))
    return persons(t).select("id", F.nullif(full, lit("")).alias("name_full"), F.when(c("name_full") != full, c("name_full")).alias("name_used"))


@R.query("prj2_person_identifier", "select distinct id, source_id || ':' || source as identifier from persons")
def prj2(t):
    return t.persons.select("id", F.concat_ws(":", "source_id", "source").alias("identifier")).distinct()


@R.query("prj3_named_person", f"select id from {_PERSONS} where trim(coalesce(name_first, '')) <> '' and trim(coalesce(name_last, '')) <> ''")
def prj3(t):
    return persons(t).filter("trim(coalesce(name_first, '')) <> '' and trim(coalesce(name_last, '')) <> ''").select("id")


@R.query("prj4_entity_dedup", "select entity_type, entity_id, min(id) as id from citations group by entity_type, entity_id")
def prj4(t):
    return t.citations.groupBy("entity_type", "entity_id").agg(F.min("id").alias("id"))


@R.query("prj5_wire_committee", f"select distinct record_id as id, trim(member_name) as name, upper(kind) as acronym, case chamber when 'joint' then 'legislature' else 'chamber:' || chamber end as parent from {_PROPOSALS} where nullif(trim(member_name), '') is not null and chamber in ('house', 'senate', 'joint')")
def prj5(t):
    """Wire bodies: those without a long name or of an unknown agency are skipped, acronyms are upper
    case, and the parent is looked up among the bodies themselves."""
    wire_rows = t.event_proposals.select(c("record_id").alias("id"), S.clean(c("member_name")).alias("name"), F.upper("kind").alias("acronym"), c("chamber").alias("agency")).distinct()
    bodies = t.spark.createDataFrame([("house", "chamber:house"), ("senate", "chamber:senate"), ("joint", "legislature")], "agency string, parent string")
    return wire_rows.filter("name is not null").join(F.broadcast(bodies), "agency").select("id", "name", "acronym", "parent")


@R.query("prj6_agency_parent", f"select distinct record_id, case chamber when 'house' then 'chamber:house' when 'senate' then 'chamber:senate' when 'joint' then 'legislature' when 'other' then 'legislature' end as parent from {_PROPOSALS}")
def prj6(t):
    parent = {"house": "chamber:house", "senate": "chamber:senate", "joint": "legislature", "other": "legislature"}
    return t.event_proposals.select("record_id", S.lookup(c("chamber"), parent).alias("parent")).distinct()


@R.query(
    "prj7_subcommittee_parent",
    """with x as (select distinct source_id, legal_name, case when source_id::bigint % 2 = 0 then legal_name || ' Subcommittee on Rates' else 'Rates Subcommittee to ' || legal_name end as n from rename_transitions)
select source_id, n as name, legal_name as parent from x""",
)
def prj7(t):
    rows = t.rename_transitions.select("source_id", F.expr("case when cast(source_id as bigint) % 2 = 0 then legal_name || ' Subcommittee on Rates' else 'Rates Subcommittee to ' || legal_name end").alias("name")).distinct()
    on, to = F.instr(F.lower("name"), " subcommittee on "), F.instr(F.lower("name"), " subcommittee to ")
    parent = F.when(on > 0, F.expr("substring(name, 1, instr(lower(name), ' subcommittee on ') - 1)")).when(to > 0, F.expr("substring(name, instr(lower(name), ' subcommittee to ') + 17)"))
    return rows.select("source_id", "name", parent.alias("parent"))


@R.query("prj8_refs_flatten", "select distinct record_id, unnest(case when len(identifier_slugs) = 0 then [null] else identifier_slugs end) as ref from candidates")
def prj8(t):
    """The wire has nothing for no reference, one object for one, a list for more."""
    slugs = F.transform("identifier_slugs", lambda x: F.struct(x.alias("slug")))
    wire = F.when(F.size(slugs) == 1, F.to_json(F.get(slugs, lit(0)))).when(F.size(slugs) > 1, F.to_json(slugs))
    rows = t.candidates.select("record_id", wire.alias("wire")).distinct()
    return rows.select("record_id", F.explode_outer(S.wire_list(c("wire"))).alias("r")).select("record_id", F.get_json_object("r", "$.slug").alias("ref"))


@R.query("prj9_first_ref", "select slug, min(record_id) as record_id from (select record_id, unnest(identifier_slugs) as slug from candidates) where slug in ('person_ballot_name', 'person_roster_key') group by slug")
def prj9(t):
    refs = t.candidates.select("record_id", F.explode("identifier_slugs").alias("slug")).filter(c("slug").isin("person_ballot_name", "person_roster_key"))
    return refs.groupBy("slug").agg(F.min("record_id").alias("record_id"))


@R.query("prj10_clean_field", f"select id, nullif(trim(sponsor_name_raw), '') as name from {_BILLS}")
def prj10(t):
    return t.bill_sponsorships.select("id", S.clean(c("sponsor_name_raw")).alias("name")).distinct()


@R.query("prj11_live_rows", f"select id from {_PERSONS} where archived_at is null and deleted_at is null")
def prj11(t):
    return O.live_only(persons(t)).select("id")


@R.query("prj12_as_of", f"select id from {_SESSIONS} where start_date <= date '2015-02-01' and (end_date is null or end_date >= date '2015-02-01')")
def prj12(t):
    return sessions(t).filter(O.as_of(lit("2015-02-01").cast("date"), c("start_date"), c("end_date"))).select("id")


@R.query("prj13_substring", f"select id, name_full from {_PERSONS} where name_full ilike '%el%'")
def prj13(t):
    return persons(t).filter(c("name_full").ilike("%el%")).select("id", "name_full")


_SPAN_KEY = "concat_ws(':', assembly, chamber, seat_discriminator, " + "(session_year - case when session_year % 2 = 0 then 1 else 0 end)::varchar || '-' || lpad(((session_year + case when session_year % 2 = 0 then 0 else 1 end) % 100)::varchar, 2, '0'))"


def span_keys(t):
    """record_id and the key of the span that a proposal is about: member:kind:discriminator:start."""
    start = D.biennium_label(c("session_year") - F.when(c("session_year") % 2 == 0, 1).otherwise(0))
    return t.event_proposals.select("record_id", "assembly", "chamber", "seat_discriminator", start.alias("start")).distinct().withColumn("key", F.concat_ws(":", "assembly", "chamber", "seat_discriminator", "start"))


@R.query("prj14_span_key", f"select distinct record_id, {_SPAN_KEY} as key from event_proposals where chamber = 'house' and seat_discriminator is not null")
def prj14(t):
    parts = F.split("key", ":")
    return span_keys(t).filter((F.size(parts) == 4) & (parts[1] == "house")).select("record_id", "key")


@R.query("prj15_span_key_parts", f"select distinct record_id, assembly as member, chamber as kind, seat_discriminator as discriminator, right({_SPAN_KEY}, 7) as start from event_proposals where seat_discriminator is not null")
def prj15(t):
    shape = "^(.*):([^:]*):([^:]*):([^:]*)$"
    part = lambda i: F.regexp_extract("key", shape, i)
    keys = span_keys(t).select("record_id", "key").filter(c("key").rlike(shape))
    return keys.select("record_id", part(1).alias("member"), part(2).alias("kind"), part(3).alias("discriminator"), part(4).alias("start"))


@R.query(
    "prj16_job_health",
    "select distinct id, withdrawn_at is null as in_flight, date_diff('second', created_at, withdrawn_at) as duration, floor(epoch(timestamp '2026-12-31 00:00:00') - epoch(coalesce(withdrawn_at, created_at)))::bigint as age_seconds from (select id, date_trunc('second', created_at) as created_at, date_trunc('second', withdrawn_at) as withdrawn_at from bill_sponsorships)",
)
def prj16(t):
    rows = t.bill_sponsorships.select("id", F.date_trunc("second", "created_at").alias("begun"), F.date_trunc("second", "withdrawn_at").alias("ended"))
    now = lit("2026-12-31 00:00:00").cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.coalesce("ended", "begun"), now)
    return rows.select("id", c("ended").isNull().alias("in_flight"), F.timestamp_diff("SECOND", "begun", "ended").alias("duration"), age.alias("age_seconds")).distinct()


@R.query("prj17_hash_hex", f"select id, lower(content_hash) as hash from {_EVENTS}")
def prj17(t):
    return t.fetch_events.distinct().select("id", F.lower(F.hex(F.unhex("content_hash"))).alias("hash"))


@R.query("prj18_dimensions", "with d as (select distinct source_id, status from fetch_events where status is not null), s as (select distinct source_id from d), k as (select distinct status from d) select s.source_id, string_agg(case when d.status is not null then k.status end, ',' order by k.status) as statuses, coalesce(string_agg(case when d.status is null then k.status end, ',' order by k.status), '') as known_gaps from s cross join k left join d on d.source_id = s.source_id and d.status = k.status group by 1")
def prj18(t):
    """The statuses that a source has had, and of all statuses those it has not."""
    own = t.fetch_events.groupBy("source_id").agg(F.collect_set("status").alias("s"))
    every = t.fetch_events.agg(F.collect_set("status").alias("every"))  # statuses are a handful
    text = lambda a: F.array_join(F.array_sort(a), ",")
    return own.join(F.broadcast(every), lit(True)).select("source_id", text(c("s")).alias("statuses"), text(F.array_except("every", "s")).alias("known_gaps"))


@R.query("prj19_single_match", "select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey")
def prj19(t):
    """No region or several would be an error, as the tests show; never a silent drop."""
    return O.single_match(t.nation.select("n_nationkey", "n_name", c("n_regionkey").alias("r_regionkey")), t.region, ["r_regionkey"], "r_name").drop("r_regionkey")


@R.query("prj20_row_validation", f"select id, nullif(trim(name), '') is not null as named, coalesce(end_date >= start_date, true) as ordered, coalesce(year(start_date) >= 1889, false) as plausible from {_SESSIONS}")
def prj20(t):
    return sessions(t).select("id", S.clean(c("name")).isNotNull().alias("named"), F.coalesce(c("end_date") >= c("start_date"), lit(True)).alias("ordered"), F.coalesce(F.year("start_date") >= 1889, lit(False)).alias("plausible"))


@R.query("prj21_name_map", "select source_id, arg_max(legal_name, (recorded_at, legal_name)) as name from rename_transitions where trim(legal_name) <> '' group by source_id")
def prj21(t):
    return t.rename_transitions.filter("trim(legal_name) <> ''").groupBy("source_id").agg(F.max_by("legal_name", F.struct("recorded_at", "legal_name")).alias("name"))


@R.query("prj22_standing", f"select record_id, chamber, member_name from {_PROPOSALS} where chamber in ('house', 'senate') and trim(member_name) <> ''")
def prj22(t):
    return t.event_proposals.distinct().filter(c("chamber").isin("house", "senate") & (F.trim("member_name") != "")).select("record_id", "chamber", "member_name")


@R.query("prj23_reclassify", f"select case when source like 'ost%' then 'east' when source like 'tess%' then 'west' else 'unknown' end as kind, count(*) as n from {_PERSONS} group by 1")
def prj23(t):
    kind = F.when(c("source").startswith("ost"), "east").when(c("source").startswith("tess"), "west").otherwise("unknown")
    return persons(t).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@R.query("prj24_or_filter", f"select id from {_PERSONS} where name_used is not null or gender is not null")
def prj24(t):
    return persons(t).filter(c("name_used").isNotNull() | c("gender").isNotNull()).select("id")


@R.query("prj25_same_district", "select distinct w.mention_id as a, d.mention_id as b, w.ld is not distinct from d.district as same from senate_winners w join deferred_annotations d on w.source = d.source and w.election_year + 1 = d.session_year")
def prj25(t):
    """Winners and the annotations of the year after in one assembly; null matches null."""
    w = t.senate_winners.select("source", (c("election_year") + 1).alias("session_year"), c("mention_id").alias("a"), "ld").distinct()
    d = t.deferred_annotations.select("source", "session_year", c("mention_id").alias("b"), "district").distinct()
    return w.join(d, ["source", "session_year"]).select("a", "b", c("ld").eqNullSafe(c("district")).alias("same")).distinct()


# Joins -------------------------------------------------------------------------------------------------


@R.query("join1_inner", f"select c.id, f.source_id, f.status from {_CITES} c join {_EVENTS} f on c.fetch_event_id = f.id")
def join1(t):
    # Repeats are whole rows, so they are repeats of these columns too; the rest is not shuffled.
    return t.citations.select("id", "fetch_event_id").distinct().join(t.fetch_events.select(c("id").alias("fetch_event_id"), "source_id", "status").distinct(), "fetch_event_id").select("id", "source_id", "status")


@R.query("join2_polymorphic", f"select c.id, p.source from {_CITES} c join {_PERSONS} p on c.entity_type = 'person' and c.entity_id = p.id")
def join2(t):
    return t.citations.filter("entity_type = 'person'").distinct().select("id", "entity_id").join(persons(t).select(c("id").alias("entity_id"), "source"), "entity_id").select("id", "source")


@R.query("join3_hash_lookup", f"select e.record_id, h.record_id as position_id from {_PROPOSALS} e join {_HOUSE} h on e.assembly = h.assembly and e.district = h.ld and e.session_year - 1 = h.election_year where e.chamber = 'house'")
def join3(t):
    left = t.event_proposals.distinct().filter("chamber = 'house'").select("assembly", c("district").alias("ld"), (c("session_year") - 1).alias("election_year"), "record_id")
    return left.join(t.house_positions.distinct().select("assembly", "ld", "election_year", c("record_id").alias("position_id")), ["assembly", "ld", "election_year"]).select("record_id", "position_id")


def surnamed(t):
    """Proposals with the folded last word of the name before a comma or at the end."""
    name = c("member_name")
    last = F.when(name.contains(","), F.split(name, ",")[0]).otherwise(F.element_at(F.split(F.trim(name), r"\s+"), -1))
    return t.event_proposals.distinct().select("record_id", "assembly", "district", "session_year", F.regexp_replace(F.lower(last), "[^a-z]", "").alias("surname"))


_SURNAMED = f"(select record_id, assembly, district, session_year, regexp_replace(lower(case when contains(member_name, ',') then split_part(member_name, ',', 1) else list_extract(regexp_split_to_array(trim(member_name), '\\s+'), -1) end), '[^a-z]', '', 'g') as surname from {_PROPOSALS})"


@R.query("join4_key_containment", f"select distinct e.record_id, h.record_id as position_id from {_SURNAMED} e join {_HOUSE} h on e.assembly = h.assembly and e.district = h.ld and list_contains(h.name_keys, e.surname)")
def join4(t):
    keys = t.house_positions.select("assembly", c("ld").alias("district"), F.explode("name_keys").alias("surname"), c("record_id").alias("position_id")).distinct()
    return surnamed(t).join(keys, ["assembly", "district", "surname"]).select("record_id", "position_id").distinct()


_MATCHES = f"(select distinct e.record_id, h.qualifier, h.party_slug = 'republican' as own from {_SURNAMED} e join {_HOUSE} h on e.assembly = h.assembly and e.district = h.ld and list_contains(h.name_keys, e.surname) where h.qualifier is not null)"


_CODE = "upper(regexp_extract(assembly, '^\\s*([A-Za-z]{2})\\W*0*(\\d+)\\s*$', 1)) || '-' || lpad(regexp_extract(assembly, '^\\s*([A-Za-z]{2})\\W*0*(\\d+)\\s*$', 2), 6, '0')"
_REGISTERED = f"(select distinct record_id, {_CODE} as assembly, district_hint as district, case lower(trim(party_label)) when 'r' then 'republican' when 'republican' then 'republican' when 'd' then 'democratic' when 'democrat' then 'democratic' when 'democratic' then 'democratic' end as party, regexp_replace(lower(case when contains(display_name, ',') then split_part(display_name, ',', 1) else list_extract(regexp_split_to_array(trim(display_name), '\\s+'), -1) end), '[^a-z]', '', 'g') as surname from candidates)"


@R.query("join5_unique_match", f"select r.record_id, case when count(distinct qualifier) = 1 then min(qualifier) when count(distinct case when party = party_slug then qualifier end) = 1 then min(case when party = party_slug then qualifier end) end as match from {_REGISTERED} r join {_HOUSE} h on r.assembly = h.assembly and r.district = h.ld and list_contains(h.name_keys, r.surname) where h.qualifier is not null group by 1")
def join5(t):
    """A registered member's ballot position: the only one, or the only one of the member's own party."""
    name = c("display_name")
    last = F.when(name.contains(","), F.split(name, ",")[0]).otherwise(F.element_at(F.split(F.trim(name), r"\s+"), -1))
    members = t.candidates.select("record_id", S.assembly_code(c("assembly")).alias("assembly"), c("district_hint").alias("district"), S.canonicalize_party(c("party_label")).alias("party"), F.regexp_replace(F.lower(last), "[^a-z]", "").alias("surname")).distinct()
    keys = t.house_positions.filter("qualifier is not null").select("assembly", c("ld").alias("district"), F.explode("name_keys").alias("surname"), "qualifier", "party_slug").distinct()
    hits = members.join(keys, ["assembly", "district", "surname"]).withColumn("own", F.coalesce(c("party") == c("party_slug"), lit(False)))
    return O.unique_match(hits, ["record_id"], "qualifier", "own")


@R.query("join6_set_intersection", f"select distinct w.mention_id, h.record_id from {_WINNERS} w join {_HOUSE} h on w.ld = h.ld and w.election_year = h.election_year and list_has_any(w.name_keys, h.name_keys)")
def join6(t):
    left = t.senate_winners.select("mention_id", "ld", "election_year", "name_keys").distinct()
    right = t.house_positions.select("record_id", "ld", "election_year", c("name_keys").alias("keys")).distinct()
    return left.join(right, ["ld", "election_year"]).filter(F.arrays_overlap("name_keys", "keys")).select("mention_id", "record_id").distinct()


_INITIALS = "list_distinct(list_transform(list_filter(regexp_split_to_array(strip_accents(lower(concat_ws(' ', name_first, name_middle, name_used))), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: w[1]))"


@R.query("join7_initials", f"with p as (select id, source, name_last, {_INITIALS} as i from {_PERSONS}) select a.id as a, b.id as b from p a join p b on a.source = b.source and a.name_last = b.name_last and a.id < b.id and (len(a.i) = 0 or len(b.i) = 0 or list_has_any(a.i, b.i))")
def join7(t):
    """Bearers of one surname whose given names share an initial; a missing given name is never
    evidence against."""
    given = S.folded_tokens(F.translate(F.concat_ws(" ", "name_first", "name_middle", "name_used"), "-'.’", "    "))
    p = persons(t).select("id", "source", "name_last", S.given_initials(given, lit("")).alias("i"))
    a, b = p.alias("a"), p.alias("b")
    pairs = a.join(b, (c("a.source") == c("b.source")) & (c("a.name_last") == c("b.name_last")) & (c("a.id") < c("b.id")))
    fits = (F.size("a.i") == 0) | (F.size("b.i") == 0) | F.arrays_overlap("a.i", "b.i")
    return pairs.filter(fits).select(c("a.id").alias("a"), c("b.id").alias("b"))


_TENURE = f"(select assembly, ld, min(election_year) as a, max(election_year) as z from {_HOUSE} group by 1, 2)"


@R.query("join8_position_at_year", f"select e.record_id, x.a, x.z from {_PROPOSALS} e join {_TENURE} x on e.assembly = x.assembly and e.district = x.ld and e.session_year between x.a - 1 and x.z")
def join8(t):
    tenure = t.house_positions.groupBy("assembly", c("ld").alias("district")).agg(F.min("election_year").alias("a"), F.max("election_year").alias("z"))
    return t.event_proposals.distinct().join(tenure, ["assembly", "district"]).filter("session_year between a - 1 and z").select("record_id", "a", "z")


@R.query("join9_covering_span", f"select s.id, arg_min(p.id, (p.start_date, p.id)) as cover from {_SESSIONS} s join {_SESSIONS} p on s.organization_id = p.organization_id and s.classification = 'special' and p.classification = 'biennium' and p.start_date <= s.start_date and coalesce(p.end_date, date '9999-12-31') >= s.start_date group by s.id")
def join9(t):
    s = sessions(t)
    a = s.filter("classification = 'special'").select("id", "organization_id", "start_date")
    b = s.filter("classification = 'biennium'").select(c("id").alias("cover"), "organization_id", c("start_date").alias("f"), F.coalesce("end_date", lit("9999-12-31").cast("date")).alias("u"))
    return a.join(b, "organization_id").filter("f <= start_date and u >= start_date").groupBy("id").agg(F.min_by("cover", F.struct("f", "cover")).alias("cover"))


@R.query("join10_superseded", f"select id from (select id, start_date, coalesce(end_date, date '9999-12-31') as u, max(coalesce(end_date, date '9999-12-31')) over (partition by organization_id order by start_date range between unbounded preceding and interval 1 day preceding) as before from {_SESSIONS} where start_date is not null) where before >= u")
def join10(t):
    s = sessions(t).filter("start_date is not null").select("id", "organization_id", F.datediff("start_date", lit("1970-01-01")).alias("d"), F.coalesce("end_date", lit("9999-12-31").cast("date")).alias("u"))
    before = F.max("u").over(W.partitionBy("organization_id").orderBy("d").rangeBetween(W.unboundedPreceding, -1))
    return s.withColumn("before", before).filter("before >= u").select("id")


@R.query("join11_term_window", f"select e.record_id, case e.chamber when 'senate' then exists (select 1 from {_WINNERS} w where w.ld = e.district and e.session_year >= w.election_year + 1 and e.session_year < w.election_year + 5) else exists (select 1 from {_HOUSE} h where h.assembly = e.assembly and h.ld = e.district and e.session_year >= h.election_year + 1 and e.session_year < h.election_year + 3) end as backed from {_PROPOSALS} e where e.chamber in ('senate', 'house')")
def join11(t):
    """A Senate term is four years, a House term two; the years of a term are spread, so the join is by equality."""
    years = lambda n: F.explode(F.sequence(c("election_year") + 1, c("election_year") + n)).alias("session_year")
    hit = lit(True).alias("hit")
    senate = t.senate_winners.select(lit("senate").alias("chamber"), c("ld").alias("district"), years(4), hit).distinct()
    house = t.house_positions.select(lit("house").alias("chamber"), "assembly", c("ld").alias("district"), years(2), hit).distinct()
    e = t.event_proposals.distinct().select("record_id", "assembly", "chamber", "district", "session_year")
    backed = lambda rows, claims, keys: rows.join(claims, keys, "left").select("record_id", F.coalesce("hit", lit(False)).alias("backed"))
    keys = ["chamber", "district", "session_year"]
    return backed(e.filter("chamber = 'senate'"), senate, keys).unionByName(backed(e.filter("chamber = 'house'"), house, ["assembly", *keys]))


@R.query("join12_semi_in", f"select id from {_PERSONS} where id in (select entity_id from citations where entity_type = 'person')")
def join12(t):
    return persons(t).join(t.citations.filter("entity_type = 'person'").select(c("entity_id").alias("id")), "id", "left_semi").select("id")


@R.query("join13_semi_exists", "select distinct resource_id, source_id from fetch_events e where status = 'error' and exists (select 1 from fetch_events o where o.source_id = e.source_id and o.resource_id = e.resource_id and o.status = 'ok')")
def join13(t):
    keys = ["source_id", "resource_id"]
    e = t.fetch_events
    return e.filter("status = 'error'").select(*keys).join(e.filter("status = 'ok'").select(*keys), keys, "left_semi").distinct()


@R.query("join14_anti", f"select id from {_PERSONS} where id not in (select person_id from bill_sponsorships where person_id is not null)")
def join14(t):
    return persons(t).join(t.bill_sponsorships.select(c("person_id").alias("id")), "id", "left_anti").select("id")


@R.query("join15_missing_seats", "select distinct ld, election_year from house_positions where (ld, election_year) not in (select ld, election_year from senate_winners)")
def join15(t):
    keys = ["ld", "election_year"]
    return t.house_positions.select(*keys).distinct().join(t.senate_winners.select(*keys), keys, "left_anti")


_STOPPED = "('" + "', '".join(S.STOPWORDS) + "')"


@R.query(
    "join16_similar_pairs",
    f"""with l as (select source_id, arg_max(legal_name, (recorded_at, legal_name)) as name from rename_transitions where legal_name is not null group by 1),
  n as (select source_id, list_filter(list_distinct(regexp_split_to_array(lower(name), '[^a-z0-9]+')), lambda x: x <> '' and x not in {_STOPPED}) as w from l)
select a.source_id as a, b.source_id as b, round(len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))), 6) as similarity from n a, n b where a.source_id < b.source_id and len(list_intersect(a.w, b.w)) > 0 and len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) >= 0.34""",
)
def join16(t):
    """All pairs of committees (by their newest names) whose significant words overlap by 0.34 or more."""
    name = F.max_by("legal_name", F.struct("recorded_at", "legal_name")).alias("name")
    n = t.rename_transitions.filter("legal_name is not null").groupBy("source_id").agg(name)
    return O.similar_pairs(n.select("source_id", S.significant_tokens(c("name")).alias("w")), "source_id", "w", 0.34)


@R.query(
    "join16_committee_pairs",
    """with l as (select source_id, arg_max(legal_name, (recorded_at, legal_name)) as name from rename_transitions where legal_name is not null group by 1),
  n as (select source_id, list_filter(list_distinct(regexp_split_to_array(trim(regexp_replace(lower(name), '[^a-z]+', ' ', 'g')), ' ')), lambda x: x <> '') as w from l)
select a.source_id as a, b.source_id as b, round(len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))), 6) as similarity from n a, n b where a.source_id < b.source_id and len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) >= 0.5""",
)
def join16_all(t):
    """All words of the names, at a floor of 0.5."""
    name = F.max_by("legal_name", F.struct("recorded_at", "legal_name")).alias("name")
    n = t.rename_transitions.filter("legal_name is not null").groupBy("source_id").agg(name)
    words = F.array_distinct(F.split(F.trim(F.regexp_replace(F.lower("name"), "[^a-z]+", " ")), " "))
    return O.similar_pairs(n.select("source_id", F.array_remove(words, "").alias("w")), "source_id", "w", 0.5)


_COHORT = "(select source_id, arg_max(legal_name, (recorded_at, legal_name)) as name from rename_transitions where left(trim(boundary_biennium), 4) = '{}' group by 1)"


@R.query("join17_cohort_diff", f"select a.source_id, a.name as before, b.name as after from {_COHORT.format('2011')} a join {_COHORT.format('2013')} b on a.source_id = b.source_id where lower(a.name) <> lower(b.name)")
def join17(t):
    def cohort(year, name):
        rows = t.rename_transitions.filter(F.substring(F.trim("boundary_biennium"), 1, 4) == year)
        return rows.groupBy("source_id").agg(F.max_by("legal_name", F.struct("recorded_at", "legal_name")).alias(name))

    return cohort("2011", "before").join(cohort("2013", "after"), "source_id").filter("lower(before) <> lower(after)")


@R.query("join18_full_outer", f"select coalesce(a.id, b.id) as id, case when b.id is null then 'insert' when b.owner <> 'feed' then 'owned_elsewhere' when a.id is null then case when b.anchor is null then 'left_alone' else 'delete' end when a.gender is distinct from b.gender then 'update' else 'keep' end as action from (select id, gender from {_PERSONS} where right(id, 1) > '8') a full outer join (select id, case when right(id, 1) < 'F' then gender end as gender, name_used as anchor, case when archived_at is null then 'feed' else 'curator' end as owner from {_PERSONS} where right(id, 1) < 'T') b on a.id = b.id")
def join18(t):
    last = F.substring("id", -1, 1)
    desired = persons(t).filter(last > "8").select("id", "gender")
    owner = F.when(c("archived_at").isNull(), "feed").otherwise("curator")
    existing = persons(t).filter(last < "T").select("id", F.when(last < "F", c("gender")).alias("gender"), c("name_used").alias("anchor"), owner.alias("owner"))
    return O.reconcile(desired, existing, ["id"], ["gender"], "owner", "feed", "anchor")


@R.query(
    "join19_match_cascade",
    f"""with q as (select distinct mention_id, source, person_id, lower(sponsor_name_raw) as n from bill_sponsorships),
  p as (select id, source, lower(name_full) as f, lower(name_first || ' ' || name_last) as s from {_PERSONS}),
  tiers as (select q.mention_id, 1 as tier, p.id from q join p on q.person_id = p.id
    union all select q.mention_id, 2, p.id from q join p on q.source = p.source and q.n = p.f
    union all select q.mention_id, 3, p.id from q join p on q.source = p.source and q.n = p.s
    union all select q.mention_id, 4, p.id from q join p on q.n = p.f),
  best as (select mention_id, tier, count(distinct id) as k, min(id) as id from tiers group by 1, 2 qualify tier = min(tier) over (partition by mention_id))
select mention_id, tier, case when k = 1 then id end as person from best""",
)
def join19(t):
    """By identifier, by full name within the feed, by first and last name within it, by full name
    anywhere: the first tier with a hit decides, and several hits there are refused."""
    q = t.bill_sponsorships.select("mention_id", "source", "person_id", F.lower("sponsor_name_raw").alias("n")).distinct()
    p = persons(t).select("id", "source", F.lower("name_full").alias("f"), F.lower(F.concat("name_first", lit(" "), "name_last")).alias("s"))
    key = lambda tier, scope, value: F.struct(lit(tier).alias("tier"), F.coalesce(scope, lit("")).alias("scope"), value.alias("value"))
    anywhere = lit("")
    asked = q.select("mention_id", F.explode(F.array(key(1, anywhere, c("person_id")), key(2, c("source"), c("n")), key(3, c("source"), c("n")), key(4, anywhere, c("n")))).alias("k")).select("mention_id", "k.*").filter("value is not null")
    held = p.select("id", F.explode(F.array(key(1, anywhere, c("id")), key(2, c("source"), c("f")), key(3, c("source"), c("s")), key(4, anywhere, c("f")))).alias("k")).select("id", "k.*").filter("value is not null")
    tiers = asked.join(held, ["tier", "scope", "value"]).groupBy("mention_id", "tier").agg(F.count_distinct("id").alias("k"), F.min("id").alias("id"))
    best = tiers.groupBy("mention_id").agg(F.min(F.struct("tier", "k", "id")).alias("b"))
    return best.select("mention_id", "b.tier", F.when(c("b.k") == 1, c("b.id")).alias("person"))


_BARE = "array_to_string(list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace({0}, '\\([^)]*\\)', ' ', 'g'), '[“\"][^”\"]*[”\"]', ' ', 'g')), '\\s+'), lambda w: w <> '' and regexp_replace(lower(w), '[^a-z0-9]', '', 'g') not in ('" + "', '".join(S.HONORIFICS) + "')), ' ')"
_PLAINED = "trim(regexp_replace(replace(strip_accents(lower({0})), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
_WORDS = "list_filter(list_transform(regexp_split_to_array({0}, '[\\s(),]+'), lambda w: regexp_replace(strip_accents(lower(w)), '[^a-z0-9]', '', 'g')), lambda w: w <> '')"
_SURNAME = "nullif(list_extract(string_split(regexp_replace(array_to_string({0}, ' '), '( ?\\b(jr|sr|ii|iii|iv))+$', ''), ' '), -1), '')"


@R.query(
    "join20_adjudicate",
    f"""with l as (select id, upper(left(source_id, 2)) || '-' || lpad(regexp_extract(source_id, '^[A-Za-z]{{2}}\\W*0*(\\d+)', 1), 6, '0') as assembly, {_BARE.format('name_full')} as bare from {_PERSONS}),
  p as (select *, {_PLAINED.format('bare')} as plain, {_WORDS.format('bare')} as w, {_SURNAME.format(_WORDS.format('bare'))} as surname from l),
  c0 as (select distinct pm_id, {_CODE} as assembly, {_BARE.format('display_name')} as bare, list_contains(identifier_slugs, 'person_registry_member_id') as owned from candidates),
  c1 as (select *, {_PLAINED.format('bare')} as plain, {_WORDS.format('bare')} as w from c0),
  c2 as (select *, list_distinct(flatten(list_transform(range(1, len(w) + 1), lambda i: list_transform(range(i, len(w) + 1), lambda j: array_to_string(w[i:j], ''))))) as keys from c1),
  j as (select p.id, c2.pm_id, not coalesce(owned, false) and p.plain = c2.plain as exact, not coalesce(owned, false) and list_contains(c2.keys, p.surname)
      and list_has_any(list_transform(list_filter(p.w, lambda x: x <> p.surname), lambda x: x[1]), list_transform(list_filter(c2.w, lambda x: x <> p.surname), lambda x: x[1])) as guarded
    from p join c2 on p.assembly = c2.assembly where p.surname is not null),
  g as (select id, count(distinct case when exact then pm_id end) as e, count(distinct case when guarded then pm_id end) as k, min(case when exact then pm_id end) as em, min(case when guarded then pm_id end) as gm from j group by 1)
select p.id, case when coalesce(e, 0) = 1 then 'exact' when e > 1 then 'ambiguous' when k = 1 then 'guarded' when k > 1 then 'ambiguous' else 'new' end as verdict, case when e = 1 then em when coalesce(e, 0) = 0 and k = 1 then gm end as pm_id from p left join g on p.id = g.id""",
)
def join20(t):
    """A local person against the registry's people of the assembly: one equal name attaches, one
    that shares surname and an initial is only reported, several are ambiguous, none is new.
    What the registry already owns is no candidate."""
    local = persons(t).select("id", S.assembly_code(F.split_part("source_id", lit(":"), lit(1))).alias("assembly"), S.strip_non_name_parts(c("name_full")).alias("bare"))
    local = local.select("id", "assembly", S.normalize_name(c("bare")).alias("plain"), S.folded_tokens(c("bare")).alias("w"), S.probe_surname(c("bare")).alias("surname"))
    owned = F.coalesce(F.array_contains("identifier_slugs", "person_registry_member_id"), lit(False))
    theirs = t.candidates.select("pm_id", S.assembly_code(c("assembly")).alias("assembly"), S.strip_non_name_parts(c("display_name")).alias("bare"), owned.alias("owned")).distinct().filter("not owned")
    theirs = theirs.select("pm_id", "assembly", S.normalize_name(c("bare")).alias("their_plain"), S.folded_tokens(c("bare")).alias("their_w")).withColumn("keys", S.surname_keys(c("their_w")))
    # Candidates meet by the whole name or by the surname among their words, so the join is by equality.
    exact = local.join(theirs.select("assembly", c("their_plain").alias("plain"), "pm_id"), ["assembly", "plain"]).filter("surname is not null").groupBy("id").agg(F.count_distinct("pm_id").alias("e"), F.min("pm_id").alias("em"))
    shared = local.join(theirs.select("assembly", F.explode("keys").alias("surname"), "pm_id", "their_w"), ["assembly", "surname"])
    fits = F.arrays_overlap(S.given_initials(c("w"), c("surname")), S.given_initials(c("their_w"), c("surname")))
    near = shared.filter(fits).groupBy("id").agg(F.count_distinct("pm_id").alias("k"), F.min("pm_id").alias("gm"))
    e, k = F.coalesce("e", lit(0)), F.coalesce("k", lit(0))
    verdict = F.when(e == 1, "exact").when((e > 1) | ((e == 0) & (k > 1)), "ambiguous").when(k == 1, "guarded").otherwise("new")
    return local.join(exact, "id", "left").join(near, "id", "left").select("id", verdict.alias("verdict"), F.when(e == 1, c("em")).when((e == 0) & (k == 1), c("gm")).alias("pm_id"))


@R.query("join21_left_lookup", f"select count(*) as n, count(p.id) as resolved from {_BILLS} b left join {_PERSONS} p on b.person_id = p.id where b.person_id is not null")
def join21(t):
    b = t.bill_sponsorships.distinct().filter("person_id is not null").select("person_id")
    return b.join(persons(t).select(c("id").alias("person_id"), lit(1).alias("hit")), "person_id", "left").agg(F.count("*").alias("n"), F.count("hit").alias("resolved"))


@R.query("join22_left_outer", f"select e.id, case when r.n is null then 'skip' else 'hash' end as outcome, case when r.n is not null then sha256(coalesce(e.url, '')) end as hash from {_EVENTS} e left join (select resource_id, source_id, count(*) as n from fetch_events where content_hash is not null group by 1, 2) r on e.resource_id = r.resource_id and e.source_id = r.source_id where e.content_hash is null")
def join22(t):
    """Events without a hash: computed where the resource has a payload, of its address, as the
    test tables have no bodies."""
    keys = ["resource_id", "source_id"]
    known = t.fetch_events.filter("content_hash is not null").select(*keys).distinct().withColumn("has", lit(True))
    bare = t.fetch_events.filter("content_hash is null").select("id", "url", *keys).distinct().join(known, keys, "left")
    return bare.select("id", F.when(c("has"), "hash").otherwise("skip").alias("outcome"), F.when(c("has"), F.sha2(F.coalesce("url", lit("")), 256)).alias("hash"))


@R.query("join23_nested_semi", f"select id from {_PERSONS} where id in (select entity_id from citations where entity_type = 'person' and fetch_event_id in (select id from fetch_events where status = 'ok' and resource_id like 'sponsors:%'))")
def join23(t):
    events = t.fetch_events.filter("status = 'ok' and resource_id like 'sponsors:%'").select(c("id").alias("fetch_event_id"))
    cited = t.citations.filter("entity_type = 'person'").join(events, "fetch_event_id", "left_semi").select(c("entity_id").alias("id"))
    return persons(t).join(cited, "id", "left_semi").select("id")


@R.query("join24_identifier_links", f"select source_id as external, arg_min(person_id, (created_at, id)) as person_id from {_BILLS} where person_id in (select id from persons) and source_id is not null and source_id not in (select source_id from bill_sponsorships where withdrawn_at is not null and source_id is not null) group by 1")
def join24(t):
    """One link per wire id, the earliest; ids of withdrawn sponsorships count as linked before."""
    links = t.bill_sponsorships.select(c("source_id").alias("external"), "person_id", "created_at", "id").distinct()
    linked = t.bill_sponsorships.filter("withdrawn_at is not null").select(c("source_id").alias("external"))
    return O.emit_links(links, linked, t.persons.select(c("id").alias("person_id")), "external", "person_id", ["created_at", "id"])


# Aggregations -------------------------------------------------------------------------------------------


@R.query("agg1_count_by_group", "select k.kind, count(e.kind) as n from (values ('departed'), ('vacated'), ('seated'), ('elected')) k(kind) left join event_proposals e on e.kind = k.kind group by 1")
def agg1(t):
    kinds = t.spark.createDataFrame([("departed",), ("vacated",), ("seated",), ("elected",)], "kind string")
    return kinds.join(t.event_proposals.groupBy("kind").count(), "kind", "left").select("kind", F.coalesce("count", lit(0)).alias("n"))


@R.query("agg2_having", f"select assembly, election_year, ld, qualifier, count(*) as n from {_HOUSE} where qualifier is not null group by all having count(*) > 1")
def agg2(t):
    return t.house_positions.distinct().filter("qualifier is not null").groupBy("assembly", "election_year", "ld", "qualifier").agg(F.count("*").alias("n")).filter("n > 1")


@R.query("agg3_backlog", f"select status, count(*) as n, min(fetched_at) as oldest, count(*) filter (http_status >= 400) as due from {_EVENTS} group by status")
def agg3(t):
    return t.fetch_events.distinct().groupBy("status").agg(F.count("*").alias("n"), F.min("fetched_at").alias("oldest"), F.count_if(c("http_status") >= 400).alias("due"))


@R.query("agg4_limited_breakdown", f"select left(coalesce(reason, 'none'), 120) as reason, count(*) as n from (select reason from {_PROPOSALS} order by effective_date, record_id limit 100) group by 1")
def agg4(t):
    first = t.event_proposals.distinct().orderBy("effective_date", "record_id").limit(100)
    return first.groupBy(F.substring(F.coalesce("reason", lit("none")), 1, 120).alias("reason")).agg(F.count("*").alias("n"))


@R.query("agg5_threshold", f"select count(*) as n from {_EVENTS} where http_status >= 404")
def agg5(t):
    return t.fetch_events.distinct().filter("http_status >= 404").agg(F.count("*").alias("n"))


@R.query("agg6_sorted_list", "select assembly, ld, string_agg(distinct qualifier, ',' order by qualifier) as seats from house_positions where qualifier is not null group by 1, 2 having count(distinct qualifier) > 1")
def agg6(t):
    seats = t.house_positions.filter("qualifier is not null").groupBy("assembly", "ld").agg(F.array_sort(F.collect_set("qualifier")).alias("s"))
    return seats.filter("size(s) > 1").select("assembly", "ld", F.array_join("s", ",").alias("seats"))


@R.query("agg7_distinct_set", "select source_id, count(distinct resource_id) as resources from fetch_events group by 1")
def agg7(t):
    return t.fetch_events.select("source_id", "resource_id").distinct().groupBy("source_id").agg(F.count("*").alias("resources"))


_ARGMAX = "case when count(*) = 1 then min(mention_id) when count(*) > count(votes) then null when count(*) filter (votes = top) = 1 then arg_max(mention_id, votes) end"


@R.query("agg8_argmax_refusal", f"select source, election_year, ld, {_ARGMAX} as winner from (select *, max(votes) over (partition by source, election_year, ld) as top from {_WINNERS}) group by 1, 2, 3")
def agg8(t):
    return O.top_or_refuse(t.senate_winners.distinct(), ["source", "election_year", "ld"], "votes", "mention_id")


@R.query("agg9_winner_per_district", f"select ld, {_ARGMAX} as winner from (select *, max(votes) over (partition by ld) as top from {_WINNERS}) group by ld")
def agg9(t):
    return O.top_or_refuse(t.senate_winners.distinct(), ["ld"], "votes", "mention_id")


@R.query("agg10_winner_per_seat", "select l_suppkey, l_linenumber, case when count(*) = 1 then min(l_orderkey) when count(*) filter (l_extendedprice = top) = 1 then arg_max(l_orderkey, l_extendedprice) end as winner from (select *, max(l_extendedprice) over (partition by l_suppkey, l_linenumber) as top from lineitem) group by 1, 2")
def agg10(t):
    return O.top_or_refuse(t.lineitem.select("l_suppkey", "l_linenumber", "l_extendedprice", "l_orderkey"), ["l_suppkey", "l_linenumber"], "l_extendedprice", "l_orderkey")


@R.query("agg11_rows_to_list", "select assembly, election_year, ld, string_agg(record_id || '/' || coalesce(qualifier, '-'), ',' order by record_id) as entries from (select distinct assembly, election_year, ld, record_id, qualifier from house_positions) group by 1, 2, 3")
def agg11(t):
    rows = t.house_positions.select("assembly", "election_year", "ld", "record_id", "qualifier").distinct()
    listed = rows.groupBy("assembly", "election_year", "ld").agg(F.array_sort(F.collect_list(F.struct("record_id", "qualifier"))).alias("l"))
    text = F.array_join(F.transform("l", lambda x: F.concat(x["record_id"].cast("string"), lit("/"), F.coalesce(x["qualifier"], lit("-")))), ",")
    return listed.select("assembly", "election_year", "ld", text.alias("entries"))


@R.query("agg12_latest_per_key", "select member_name, max(session_year) as latest from event_proposals group by 1")
def agg12(t):
    return t.event_proposals.groupBy("member_name").agg(F.max("session_year").alias("latest"))


_NAMED = "(select distinct source, source_id from persons)"


@R.query("agg13_coverage_guard", "with named as (select distinct source, id from persons), seen as (select distinct source, person_id as id from bill_sponsorships where person_id is not null), r as (select n.source, count(*) as n, count(s.id) as k from named n left join seen s on n.id = s.id and n.source = s.source group by 1) select n.source, n.id from named n join r on n.source = r.source where r.k > 0 and r.k >= 0.9 * r.n and (n.source, n.id) not in (select source, id from seen)")
def agg13(t):
    keys = ["source", "id"]
    named = t.persons.select(*keys).distinct()
    seen = t.bill_sponsorships.filter("person_id is not null").select("source", c("person_id").alias("id")).distinct()
    covered = named.join(seen.withColumn("hit", lit(1)), keys, "left").groupBy("source").agg(F.count("*").alias("n"), F.count("hit").alias("k")).filter("k > 0 and k >= 0.9 * n")
    return named.join(seen, keys, "left_anti").join(covered.select("source"), "source").select(*keys)


@R.query("agg14_tail_rule", "select distinct source_id, legal_name from rename_transitions r where left(trim(boundary_biennium), 4) = (select max(left(trim(boundary_biennium), 4)) from rename_transitions x where x.source_id = r.source_id and left(trim(x.boundary_biennium), 4) <= '2013')")
def agg14(t):
    """The names of the last biennium up to this one (2013); later ones do not count."""
    rows = t.rename_transitions.withColumn("y", F.substring(F.trim("boundary_biennium"), 1, 4)).filter("y <= '2013'").select("source_id", "legal_name", "y")
    return rows.join(rows.groupBy("source_id").agg(F.max("y").alias("y")), ["source_id", "y"]).select("source_id", "legal_name").distinct()


@R.query("agg15_founded_floor", "select source_id, min(y)::integer as floor from (select source_id, cast(left(trim(boundary_biennium), 4) as integer) as y from rename_transitions union all select source_id, year(effective_start) from rename_transitions) group by 1")
def agg15(t):
    a = t.rename_transitions.select("source_id", F.substring(F.trim("boundary_biennium"), 1, 4).cast("int").alias("y"))
    return a.unionByName(t.rename_transitions.select("source_id", F.year("effective_start").alias("y"))).groupBy("source_id").agg(F.min("y").alias("floor"))


@R.query("agg16_windows", "select organization_id, case when min(biennium_label) > (select min(biennium_label) from legislative_sessions) then min(biennium_label) end as founded, max(biennium_label) as last, bool_or(biennium_label = '2025-26') as is_current from legislative_sessions where biennium_label is not null group by 1")
def agg16(t):
    rows = t.legislative_sessions.filter("biennium_label is not null")
    floor = rows.agg(F.min("biennium_label").alias("floor"))
    own = rows.groupBy("organization_id").agg(F.min("biennium_label").alias("first"), F.max("biennium_label").alias("last"), F.max(c("biennium_label") == "2025-26").alias("is_current"))
    return own.join(F.broadcast(floor), lit(True)).select("organization_id", F.when(c("first") > c("floor"), c("first")).alias("founded"), "last", "is_current")


@R.query("agg17_census", "select coalesce(party_slug, 'declined') as key, count(*) as n from house_positions group by 1 union all select 'total', count(*) from house_positions")
def agg17(t):
    return t.house_positions.rollup(F.coalesce("party_slug", lit("declined")).alias("k")).agg(F.count("*").alias("n")).select(F.coalesce("k", lit("total")).alias("key"), "n")


@R.query("agg18_summary", f"select kind || ':' || coalesce(reason, '') as key, count(*) as n from {_PROPOSALS} group by 1")
def agg18(t):
    return t.event_proposals.distinct().groupBy(F.concat_ws(":", "kind", F.coalesce("reason", lit(""))).alias("key")).agg(F.count("*").alias("n"))


@R.query("agg19_ratio", f"select assembly, coalesce(count(party_slug) / nullif(count(*), 0), 0.0) as rate from {_HOUSE} group by 1")
def agg19(t):
    return t.house_positions.distinct().groupBy("assembly").agg(F.coalesce(F.try_divide(F.count("party_slug"), F.count("*")), lit(0.0)).alias("rate"))


@R.query("agg20_stability", "with a as (select distinct source, lower(name_full) as k, id from persons where deleted_at is null), b as (select distinct source, lower(name_full) as k, id from persons) select a.source, count(*) filter (a.id = b.id) as same, count(*) filter (a.id <> b.id) as divergent from a join b on a.source = b.source and a.k = b.k group by 1")
def agg20(t):
    p = t.persons.select("source", F.lower("name_full").alias("k"), "id", "deleted_at")
    a = p.filter("deleted_at is null").select("source", "k", "id").distinct()
    b = p.select("source", "k", c("id").alias("other")).distinct()
    return a.join(b, ["source", "k"]).groupBy("source").agg(F.count_if(c("id") == c("other")).alias("same"), F.count_if(c("id") != c("other")).alias("divergent"))


@R.query("agg21_extent", "with k as (select biennium_label as b, left(biennium_label, 4)::integer as y, count(*) as n, count(*) filter (classification = 'special') as s from legislative_sessions where biennium_label is not null group by 1, 2), g as (select y, y - lag(y) over (order by y) > 6 as gap from (select distinct y from k)) select b, n, s, sum(n) over () as total, min(b) filter (s > 0) over () as earliest, y >= coalesce((select max(y) from g where gap), 0) as reached from k")
def agg21(t):
    """Counts per biennium, and whether a walk back that three empty biennia end reaches it."""
    y = F.substring("biennium_label", 1, 4).cast("int")
    k = t.legislative_sessions.filter("biennium_label is not null").groupBy(c("biennium_label").alias("b"), y.alias("y")).agg(F.count("*").alias("n"), F.count_if(c("classification") == "special").alias("s"))
    whole = k.agg(F.sum("n").alias("total"), F.min(F.when(c("s") > 0, c("b"))).alias("earliest"))
    return k.join(F.broadcast(whole), lit(True)).join(F.broadcast(O.extent(k, "y", 3)), "y").drop("y")


@R.query(
    "agg22_fingerprint",
    """select record_id, sha256('{"ld": ' || coalesce(any_value(ld)::varchar, 'null') || ', "names": {"keys": [' || array_to_string(list_transform(list_sort(any_value(name_keys)), lambda k: '"' || array_to_string(list_transform(string_split(k, ''), lambda ch: case when ch = '"' then '\\"' when ch = '\\' then '\\\\' when unicode(ch) between 32 and 126 then ch else printf('\\u%04x', unicode(ch)) end), '') || '"'), ', ') || '], "n": ' || len(any_value(name_keys)) || '}}') as digest from house_positions where name_keys is not null group by record_id""",
)
def agg22(t):
    """The hash of a nested payload in canonical JSON."""
    keys = F.array_sort("name_keys")
    rows = t.house_positions.filter("name_keys is not null").select("record_id", "ld", keys.alias("keys"), F.size("name_keys").alias("n")).distinct()
    nested = rows.select("record_id", "ld", F.struct("keys", "n").alias("names"))
    return nested.select("record_id", F.sha2(canonical_json(F.struct("ld", "names")), 256).alias("digest"))


@R.query("agg23_partition_oracle", f"select count(*) as input, count(*) filter (seat_kind is not null) as placed, count(*) filter (seat_kind is null) as refused, true as whole from {_PROPOSALS}")
def agg23(t):
    sums = t.event_proposals.distinct().agg(F.count("*").alias("input"), F.count("seat_kind").alias("placed"), F.count_if(c("seat_kind").isNull()).alias("refused"))
    whole = F.when(c("placed") + c("refused") == c("input"), lit(True)).otherwise(F.raise_error(lit("records lost")).cast("boolean"))
    return sums.withColumn("whole", whole)


@R.query("agg24_exists_count", f"select count(*) filter (content_hash is null) as unbaselined, count(*) filter (content_hash is null) > 0 as any_unbaselined from {_EVENTS}")
def agg24(t):
    n = F.count_if(c("content_hash").isNull())
    return t.fetch_events.distinct().agg(n.alias("unbaselined"), (n > 0).alias("any_unbaselined"))


QUERIES, ORACLE = R.queries, R.oracle
