"""Windows, orders, limits and set operations (WIN*, SORT*, SET*)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gavelspark.functions.folding import alnum_key
from gavelspark.operators import relational as O
from gavelspark.operators.paging import byte_budget, grouped_lines, page_after, paged_scan
from gavelspark.plans.registry import Registry
from gavelspark.plans.relational import _BILLS, _CITES, _EVENTS, _HOUSE, _PERSONS, _PROPOSALS, persons

R = Registry()
c, lit = F.col, F.lit

_YEARS = "(select distinct assembly, ld, election_year as y from house_positions)"
_SPANS = "(select assembly, ld, min(y) as first, max(y) as last from (select *, y - 2 * row_number() over (partition by assembly, ld order by y) as i from " + _YEARS + ") group by assembly, ld, i)"


def spans(t):
    return O.spans_of(t.house_positions, ["assembly", "ld"], "election_year")


@R.query("win1_tenure_spans", f"select assembly, ld, make_date(first + 1, 1, 1) as valid_from, case when last < 2024 then make_date(last + 2, 12, 31) end as valid_to from {_SPANS}")
def win1(t):
    one = lit(1)
    return spans(t).select("assembly", "ld", F.make_date(c("first") + 1, one, one).alias("valid_from"), F.when(c("last") < 2024, F.make_date(c("last") + 2, lit(12), lit(31))).alias("valid_to"))


@R.query("win2_distinct_on", "select source_id, id from fetch_events qualify row_number() over (partition by source_id order by fetched_at desc, id desc) = 1")
def win2(t):
    return t.fetch_events.groupBy("source_id").agg(F.max(F.struct("fetched_at", "id")).alias("v")).select("source_id", "v.id")


@R.query("win3_newest_per_key", "select id, updated_at from legislative_sessions qualify row_number() over (partition by id order by updated_at desc) = 1")
def win3(t):
    return t.legislative_sessions.groupBy("id").agg(F.max("updated_at").alias("updated_at"))


_KEY = "regexp_replace(strip_accents(lower(replace(legal_name, '&', 'and'))), '[^a-z0-9]', '', 'g')"


@R.query("win4_adjacent_diff", f"with r as (select source_id, effective_start, recorded_at, legal_name, {_KEY} as k from (select distinct * from rename_transitions)), l as (select *, lag(k) over (partition by source_id order by effective_start, recorded_at, legal_name) as before from r) select distinct source_id, effective_start, k as name_key from l where before is not null and before <> k")
def win4(t):
    rows = t.rename_transitions.distinct().select("source_id", "effective_start", "recorded_at", "legal_name", alnum_key(c("legal_name")).alias("name_key"))
    before = F.lag("name_key").over(W.partitionBy("source_id").orderBy("effective_start", "recorded_at", "legal_name"))
    return rows.withColumn("before", before).filter("before <> name_key").select("source_id", "effective_start", "name_key").distinct()


@R.query("win5_storm_guard", "with b as (select left(trim(boundary_biennium), 4) as y, count(*) as n, count(*) filter (lower(former_name) <> lower(legal_name)) as renamed from rename_transitions group by 1) select y, n, renamed, n >= 5 and renamed > 0.34 * n as skipped from b")
def win5(t):
    b = t.rename_transitions.groupBy(F.substring(F.trim("boundary_biennium"), 1, 4).alias("y")).agg(F.count("*").alias("n"), F.count_if(F.lower("former_name") != F.lower("legal_name")).alias("renamed"))
    return b.withColumn("skipped", (c("n") >= 5) & (c("renamed") > 0.34 * c("n")))


@R.query("win6_wide_gap", f"select assembly, ld, min(y) as before, arg_min(nxt, y) as after from (select *, lead(y) over (partition by assembly, ld order by y) as nxt from {_YEARS}) where nxt - y > 8 group by 1, 2")
def win6(t):
    y = t.house_positions.select("assembly", "ld", c("election_year").alias("y")).distinct()
    nxt = F.lead("y").over(W.partitionBy("assembly", "ld").orderBy("y"))
    return y.withColumn("nxt", nxt).filter("nxt - y > 8").groupBy("assembly", "ld").agg(F.min("y").alias("before"), F.min_by("nxt", "y").alias("after"))


@R.query("win7_next_listing", f"select assembly, ld, y, lead(y) over (partition by assembly, ld order by y) as until from {_YEARS}")
def win7(t):
    y = t.house_positions.select("assembly", "ld", c("election_year").alias("y")).distinct()
    return y.withColumn("until", F.lead("y").over(W.partitionBy("assembly", "ld").orderBy("y")))


_PARTIES = f"(select assembly, ld, election_year as y, max(party_slug) as party from {_HOUSE} group by 1, 2, 3)"


@R.query("win8_next_token", f"select assembly, ld, y, first_value(party ignore nulls) over (partition by assembly, ld order by y rows between 1 following and unbounded following) as next_party from {_PARTIES}")
def win8(t):
    rows = t.house_positions.groupBy("assembly", "ld", c("election_year").alias("y")).agg(F.max("party_slug").alias("party"))
    after = W.partitionBy("assembly", "ld").orderBy("y").rowsBetween(1, W.unboundedFollowing)
    return rows.select("assembly", "ld", "y", F.first("party", ignorenulls=True).over(after).alias("next_party"))


@R.query("win9_latest_name", "select district, arg_max(member_name, (session_year, record_id)) as name from event_proposals group by 1")
def win9(t):
    return t.event_proposals.groupBy("district").agg(F.max_by("member_name", F.struct("session_year", "record_id")).alias("name"))


@R.query("win10_earlier_cover", f"select id, coalesce(before >= until, false) as covered from (select id, coalesce(withdrawn_at, timestamp '9999-01-01') as until, max(coalesce(withdrawn_at, timestamp '9999-01-01')) over (partition by bill_id order by created_at, id rows between unbounded preceding and 1 preceding) as before from {_BILLS})")
def win10(t):
    until = F.coalesce("withdrawn_at", lit("9999-01-01").cast("timestamp_ntz"))
    before = F.max("until").over(W.partitionBy("bill_id").orderBy("created_at", "id").rowsBetween(W.unboundedPreceding, -1))
    return t.bill_sponsorships.distinct().withColumn("until", until).select("id", F.coalesce(before >= c("until"), lit(False)).alias("covered"))


@R.query("win11_line_grouping")
def win11(t):
    """Words to lines by a tolerance anchored on the first word of a line; tested against a plain loop."""
    words = t.lineitem.select(c("l_orderkey").alias("page"), c("l_linenumber").alias("x"), (c("l_quantity") % 20).alias("top"), c("l_returnflag").alias("word"))
    return grouped_lines(words, "page", "top", "x", 3.0, "word")


@R.query("win12_carry_forward", "select mention_id, last_value(district ignore nulls) over w as district, last_value(chamber ignore nulls) over w as chamber, last_value(session_year ignore nulls) over w as session_year from (select distinct * from deferred_annotations) window w as (partition by source order by page_number, mention_id rows between unbounded preceding and current row)")
def win12(t):
    """District, chamber and year of a listing stand until the next ones are printed, across rows and pages."""
    so_far = W.partitionBy("source").orderBy("page_number", "mention_id").rowsBetween(W.unboundedPreceding, 0)
    rows = t.deferred_annotations.select("source", "mention_id", "page_number", "district", "chamber", "session_year", "member_name", "reason", "evidence").distinct()
    return rows.select("mention_id", *[F.last(x, ignorenulls=True).over(so_far).alias(x) for x in ("district", "chamber", "session_year")])


_LISTED = f"(select distinct assembly, array_to_string(list_sort(name_keys), ' ') as member, ld, election_year as y, max(qualifier) as seed from {_HOUSE} where name_keys is not null group by 1, 2, 3, 4)"


@R.query(
    "win13_backchain",
    f"""with a as (select *, lag(ld) over m as before, lag(y) over m as earlier from {_LISTED} window m as (partition by assembly, member order by y, ld)),
  r as (select *, sum(case when before = ld and y - earlier <= 4 and not (y >= 2002 and earlier < 2002) and not (y >= 2012 and earlier < 2012) then 0 else 1 end) over (partition by assembly, member order by y, ld) as run from a)
select assembly, member, ld, y, coalesce(seed, first_value(seed ignore nulls) over b) as qualifier, seed is null and first_value(seed ignore nulls) over b is not null as carried from r window b as (partition by assembly, member, run order by y, ld rows between current row and unbounded following)""",
)
def win13(t):
    """A known position is carried back to the member's earlier listings, hop by hop, until the district
    changes, more than one election is skipped, or districts were redrawn (2002, 2012)."""
    listed = t.house_positions.filter("name_keys is not null").groupBy("assembly", F.array_join(F.array_sort("name_keys"), " ").alias("member"), "ld", c("election_year").alias("y")).agg(F.max("qualifier").alias("seed"))
    by = W.partitionBy("assembly", "member").orderBy("y", "ld")
    era = lambda y: (y >= 2002).cast("int") + (y >= 2012).cast("int")
    before, earlier = F.lag("ld").over(by), F.lag("y").over(by)
    linked = F.coalesce((before == c("ld")) & (c("y") - earlier <= 4) & (era(earlier) == era(c("y"))), lit(False))
    runs = listed.withColumn("fresh", F.when(linked, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(by))
    after = F.first("seed", ignorenulls=True).over(W.partitionBy("assembly", "member", "run").orderBy("y", "ld").rowsBetween(0, W.unboundedFollowing))
    told = runs.withColumn("qualifier", after)
    return told.select("assembly", "member", "ld", "y", "qualifier", (c("seed").isNull() & c("qualifier").isNotNull()).alias("carried"))


# Orders and limits ---------------------------------------------------------------------------------------


@R.query("sort1_span_order", f"select assembly, ld, first, row_number() over (order by assembly, ld, first) as n from {_SPANS}")
def sort1(t):
    """Ranks from partition counts of a range-sorted frame: no single-task window."""
    from gavelspark.operators.paging import global_rank

    return global_rank(spans(t).select("assembly", "ld", "first"), ["assembly", "ld", "first"], "n")


@R.query("sort2_keyset", f"select id from {_PERSONS} where id > '01G00000000000000000000000' order by id limit 51")
def sort2(t):
    return page_after(persons(t).select("id"), "id", "01G00000000000000000000000", 50)


@R.query("sort3_keyset_desc", f"select id from {_CITES} where id < '01J00000000000000000000000' order by id desc limit 51")
def sort3(t):
    return page_after(t.citations.select("id").distinct(), "id", "01J00000000000000000000000", 50, descending=True)


@R.query("sort4_top_n", f"select id, asserted_at from {_CITES} order by asserted_at desc, id limit 50")
def sort4(t):
    return t.citations.select("id", "asserted_at").distinct().orderBy(c("asserted_at").desc(), "id").limit(50)


@R.query("sort5_priority", f"select id, entity_type from {_CITES} order by case entity_type when 'person' then 1 when 'jurisdiction' then 0 else 2 end, created_at, id limit 100")
def sort5(t):
    rank = F.when(c("entity_type") == "person", 1).when(c("entity_type") == "jurisdiction", 0).otherwise(2)
    return t.citations.select("id", "entity_type", "created_at").distinct().orderBy(rank, "created_at", "id").limit(100).select("id", "entity_type")


@R.query("sort6_limited_update", f"with o as (select id from {_EVENTS} where status = 'error' order by fetched_at, id limit 20) select id, case when id in (select id from o) then 'pending' else status end as status from {_EVENTS}")
def sort6(t):
    e = t.fetch_events.distinct()
    oldest = e.filter("status = 'error'").orderBy("fetched_at", "id").limit(20).select("id", lit(True).alias("hit"))
    return e.join(F.broadcast(oldest), "id", "left").select("id", F.when(c("hit"), "pending").otherwise(c("status")).alias("status"))


@R.query("sort7_stable_scores", f"select a, b, s from (select ps_a as a, ps_b as b, s from (select a.p_partkey as ps_a, b.p_partkey as ps_b, abs(a.p_retailprice - b.p_retailprice) as s from part a join part b on a.p_brand = b.p_brand and a.p_type = b.p_type and a.p_size = b.p_size and a.p_partkey < b.p_partkey) order by s desc, a, b limit 40)")
def sort7(t):
    keys = ["p_brand", "p_type", "p_size"]
    a = t.part.select(*keys, c("p_partkey").alias("a"), c("p_retailprice").alias("pa"))
    b = t.part.select(*keys, c("p_partkey").alias("b"), c("p_retailprice").alias("pb"))
    return a.join(b, keys).filter("a < b").select("a", "b", F.abs(c("pa") - c("pb")).alias("s")).orderBy(c("s").desc(), "a", "b").limit(40)


@R.query("sort8_batch_scan", "with n as (select id, row_number() over (order by id) - 1 as k from (select distinct id from citations)) select (k // 5000)::bigint as page, count(*) as rows, min(id) as first, max(id) as last from n group by 1")
def sort8(t):
    """All citations by primary key, five thousand a page."""
    return paged_scan(t.citations.select("id").distinct(), "id", 5_000)


@R.query("sort9_byte_budget", "select doc_id from (select doc_id, sum(coalesce(strlen(text), 0)) over (order by doc_id rows between unbounded preceding and 1 preceding) as before from documents) where coalesce(before, 0) < 100000")
def sort9(t):
    return byte_budget(t.documents.select("doc_id", F.coalesce(F.octet_length("text"), lit(0)).alias("size")), "doc_id", "size", 100_000).select("doc_id")


# Sets ------------------------------------------------------------------------------------------------------


@R.query("set1_union", "select source, mention_id from senate_winners union all select source, mention_id from deferred_annotations")
def set1(t):
    return t.senate_winners.select("source", "mention_id").unionByName(t.deferred_annotations.select("source", "mention_id"))


@R.query("set2_merge_positions", "select ld, election_year as y from house_positions where election_year % 2 = 0 union select ld, election_year from senate_winners where election_year % 4 = 0")
def set2(t):
    a = t.house_positions.filter("election_year % 2 = 0").select("ld", c("election_year").alias("y"))
    return a.unionByName(t.senate_winners.filter("election_year % 4 = 0").select("ld", c("election_year").alias("y"))).distinct()


@R.query("set3_exclusions", "select id from persons where deleted_at is not null union select id from persons where archived_at is not null")
def set3(t):
    return t.persons.filter("deleted_at is not null").select("id").unionByName(t.persons.filter("archived_at is not null").select("id")).distinct()


@R.query("set4_difference", "select id from persons except select entity_id from citations")
def set4(t):
    return t.persons.select("id").distinct().join(t.citations.select(c("entity_id").alias("id")), "id", "left_anti")


@R.query("set5_subscriptions", "select distinct source_id from fetch_events where source_id not in (select source from persons where deleted_at is not null)")
def set5(t):
    gone = t.persons.filter("deleted_at is not null").select(c("source").alias("source_id"))
    return t.fetch_events.select("source_id").distinct().join(gone, "source_id", "left_anti")


@R.query("set6_intersection", "select source from persons where archived_at is not null intersect select source from persons where deleted_at is not null")
def set6(t):
    return t.persons.filter("archived_at is not null").select("source").intersect(t.persons.filter("deleted_at is not null").select("source"))


@R.query("set7_equality", "select a.record_id, len(list_filter(a.name_keys, lambda x: not list_contains(b.k, x))) = 0 and len(list_filter(b.k, lambda x: not list_contains(a.name_keys, x))) = 0 as same from (select distinct record_id, name_keys from house_positions) a join (select record_id, case when record_id % 2 = 0 then name_keys else name_keys[1:1] end as k from (select distinct record_id, name_keys from house_positions)) b on a.record_id = b.record_id")
def set7(t):
    other = F.when(c("record_id") % 2 == 0, c("name_keys")).otherwise(F.slice("name_keys", 1, 1))
    rows = t.house_positions.select("record_id", "name_keys").distinct().withColumn("k", other)
    return rows.select("record_id", ((F.size(F.array_except("name_keys", "k")) == 0) & (F.size(F.array_except("k", "name_keys")) == 0)).alias("same"))


@R.query("set8_buckets", f"select record_id, case when (assembly, district) in (select assembly, ld from house_positions) then 'claimed' else 'unclaimed' end as bucket from {_PROPOSALS}")
def set8(t):
    seats = t.house_positions.select("assembly", c("ld").alias("district")).distinct().withColumn("hit", lit(True))
    return t.event_proposals.distinct().join(seats, ["assembly", "district"], "left").select("record_id", F.when(c("hit"), "claimed").otherwise("unclaimed").alias("bucket"))


QUERIES, ORACLE = R.queries, R.oracle
