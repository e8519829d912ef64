"""Scans, sources and sinks (SRC*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelspark.operators import relational as O
from gavelspark.plans.registry import Registry
from gavelspark.plans.relational import _BILLS, _EVENTS, _PERSONS, _SESSIONS, persons, sessions
from gavelspark.session import shared_path
from gavelspark.sources import archive as A
from gavelspark.sources import wire

R = Registry()
c, lit = F.col, F.lit


def xml_archive(t, element, fields, df, key, faults=False):
    """Bodies of one XML document per key, as an archive would hold them."""
    parts = [F.concat(lit(f"<{tag}>"), F.replace(F.replace(F.coalesce(value.cast("string"), lit("")), lit("&"), lit("&amp;")), lit("<"), lit("&lt;")), lit(f"</{tag}>")) for tag, value in fields.items()]
    record = F.concat(lit(f"<{element}>"), *parts, lit(f"</{element}>"))
    body = F.concat(lit("<root>"), F.array_join(F.collect_list("_x"), ""), lit("</root>"))
    docs = df.select(key, record.alias("_x")).groupBy(key).agg(body.alias("body"))
    if faults:
        docs = docs.unionByName(t.spark.createDataFrame([("fault", "<s><faultstring>3001-02 is not a valid biennium</faultstring></s>")], f"{key} string, body string"))
    return docs


@R.query("src1_sponsors_xml", f"select source, name_first as first, name_last as last from {_PERSONS}")
def src1(t):
    docs = xml_archive(t, "Member", {"FirstName": c("name_first"), "LastName": c("name_last")}, persons(t), "source")
    return wire.xml_rows(docs, "body", "Member", wire.MEMBER).select("source", c("FirstName").alias("first"), c("LastName").alias("last"))


@R.query("src2_committees_xml", "select distinct source_id, trim(legal_name) as name from rename_transitions")
def src2(t):
    df = t.rename_transitions.select("source_id", F.trim("legal_name").alias("n")).distinct()
    docs = xml_archive(t, "Committee", {"Id": c("source_id"), "LongName": c("n")}, df, "source_id", faults=True)
    return wire.xml_rows(docs, "body", "Committee", wire.COMMITTEE, ("valid biennium",)).select("source_id", c("LongName").alias("name"))


@R.query("src3_committee_members_xml", "select distinct assembly, district from event_proposals where chamber = 'senate'")
def src3(t):
    df = t.event_proposals.filter("chamber = 'senate'").select("assembly", "district").distinct()
    docs = xml_archive(t, "Member", {"District": c("district")}, df, "assembly", faults=True)
    return wire.xml_rows(docs, "body", "Member", wire.MEMBER, ("no members", "not a valid")).select("assembly", c("District").cast("int").alias("district"))


@R.query("src4_meetings_xml", "select distinct source_id::integer as agenda, trim(legal_name) as committee from rename_transitions")
def src4(t):
    esc = lambda v: F.replace(F.replace(v, lit("&"), lit("&amp;")), lit("<"), lit("&lt;"))
    df = t.rename_transitions.select("source_id", F.trim("legal_name").alias("n")).distinct()
    inner = F.array_join(F.collect_list(F.concat(lit("<Committee><LongName>"), esc(c("n")), lit("</LongName></Committee>"))), "")
    docs = df.groupBy("source_id").agg(F.concat(lit("<root><CommitteeMeeting><AgendaId>"), F.first("source_id"), lit("</AgendaId><Committees>"), inner, lit("</Committees></CommitteeMeeting></root>")).alias("body"))
    return wire.meeting_rows(docs, "body").select(c("AgendaId").alias("agenda"), "committee")


@R.query("src5_json_array", "select ld, mention_id, votes::bigint as votes from (select distinct * from senate_winners) where election_year >= 2000")
def src5(t):
    df = t.senate_winners.distinct().filter("election_year >= 2000")
    docs = df.groupBy("ld").agg(F.to_json(F.collect_list(F.struct("mention_id", c("votes").cast("bigint").alias("votes")))).alias("body"))
    return wire.json_array_rows(docs, "body", "mention_id bigint, votes bigint").select("ld", "mention_id", "votes")


@R.query("src6_csv_filings", "select distinct assembly, record_id::varchar as id, qualifier as position from house_positions")
def src6(t):
    df = t.house_positions.select("assembly", "record_id", "qualifier").distinct()
    line = F.concat_ws(",", c("record_id").cast("string"), F.coalesce("qualifier", lit("")))
    docs = df.groupBy("assembly").agg(F.concat(lit("﻿id,position\r\n"), F.array_join(F.collect_list(line), "\r\n"), lit("\r\n")).alias("body"))
    return wire.csv_rows(docs, "body", ["id", "position"]).select("assembly", "id", F.nullif("position", lit("")).alias("position"))


@R.query("src7_results_link", "select distinct url, url || '/legislative.csv' as href from fetch_events where resource_id like 'sponsors%'")
def src7(t):
    """Index pages and the results file they link; a page without one is an error, as the tests show."""
    page = F.concat(lit("<p><a HREF='"), "url", lit("/legislative.csv'>x</a>"))
    pages = t.fetch_events.filter(c("resource_id").startswith("sponsors")).select("url", page.alias("page")).distinct()
    return pages.select("url", wire.required_href(c("page"), c("url")).alias("href"))


@R.query("src8_page_words", "select doc_id, count(*) as words from (select doc_id, unnest(string_split(regexp_replace(replace(text, chr(13), chr(10)), chr(10), ' ', 'g'), ' ')) as w from documents) where w <> '' group by doc_id")
def src8(t):
    return wire.page_words(t.documents, "doc_id", "text").groupBy("doc_id").agg(F.count("*").alias("words"))


# Seeds are small documents of fixed tables: a file each, with its checksum beside it.
_SEEDS = """(select 'nation.json' as name, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' order by n_nationkey) || ']' as body from nation
  union all select 'region.json', '[' || string_agg('{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}', ',' order by r_regionkey) || ']' from region)"""


def seed_folder(t):
    """The seeds and their sidecars, written to the shared folder."""
    base = shared_path(t.spark, "seeds")
    for name, rows, key in (("nation", t.nation.select("n_nationkey", "n_name"), "n_nationkey"), ("region", t.region.select("r_regionkey", "r_name"), "r_regionkey")):
        A.write_seed(t.spark, f"{base}/{name}.json", A.seed_document(rows, [key]).first().document.encode(), {"table": name})
    return base


@R.query("src9_verified_seed", f"select name, json_array_length(body) as entries from {_SEEDS}")
def src9(t):
    """Seed files whose bytes have the hash that their sidecar names; any other is an error."""
    seeds = A.verified(*A.seed_files(t.spark, seed_folder(t)))
    return seeds.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.json_array_length(c("content").cast("string")).cast("bigint").alias("entries"))


@R.query("src10_sidecar_manifest", f"select name, sha256(body) as sha256, strlen(body) as bytes, split_part(name, '.', 1) as \"table\" from {_SEEDS}")
def src10(t):
    """What the written sidecars say, read back."""
    meta = t.spark.read.schema("sha256 string, bytes bigint, table string").json(f"{seed_folder(t)}/*.meta.json")
    return meta.select(F.concat("table", lit(".json")).alias("name"), "sha256", "bytes", "table")


@R.query("src11_json_batch", "select distinct record_id, kind, effective_date from event_proposals")
def src11(t):
    """A batch of JSON lines, written and scanned with a fixed schema."""
    path = shared_path(t.spark, "batch")
    t.event_proposals.select("record_id", "kind", "effective_date").write.json(path)
    return t.spark.read.schema("record_id bigint, kind string, effective_date date").json(path).distinct()


@R.query("src12_paged_list", "select slug as id, name from jurisdictions")
def src12(t):
    """A domain table, page by page."""
    from gavelspark.sources.remote import PagedList

    t.spark.dataSource.register(PagedList)
    pages = -(-t.jurisdictions.count() // 200)
    return t.spark.read.format("paged_list").option("fetch", "gavelspark.sources.remote:table_list").option("location", f"{t.dir}/jurisdictions.parquet").option("pages", str(pages)).load()


@R.query(
    "src14_graph_discovery",
    """with edge as (select distinct 'person' as kind, person_id as node, bill_id as bill from bill_sponsorships where person_id is not null and bill_id is not null union select distinct 'organization', organization_id, bill_id from bill_sponsorships where organization_id is not null and bill_id is not null),
  root as (select min(person_id) as node from bill_sponsorships where length(person_id) = 26),
  bills as (select distinct bill from edge where node = (select node from root)),
  near as (select distinct kind, node from edge where bill in (select bill from bills) and node <> (select node from root))
select 'person' as kind, node, 0 as hop, false as truncated from root union all select 'bill', bill, 1, false from bills union all select kind, node, 2, false from near""",
)
def src14(t):
    """What two hops reach from one member, over the edges of members and of organizations to bills."""
    edge = lambda kind, column: t.bill_sponsorships.select(lit(kind).alias("kind"), c(column).alias("node"), lit("bill").alias("to_kind"), c("bill_id").alias("to"))
    root = t.bill_sponsorships.filter("length(person_id) = 26").agg(F.min("person_id").alias("node")).select(lit("person").alias("kind"), "node")
    return A.discover(edge("person", "person_id").unionByName(edge("organization", "organization_id")), root, 2, 1_000_000)


@R.query("src15_conditional_read", f"select id from {_EVENTS} where etag is null or etag like '%0%'")
def src15(t):
    e = t.fetch_events.distinct().select("id", F.coalesce("etag", lit("")).alias("etag"))
    stored = e.filter("etag <> ''").select("id", F.when(c("etag").contains("0"), lit("old")).otherwise(c("etag")).alias("etag"))
    return A.changed_validators(e, stored, ["id", "etag"]).select("id")


@R.query("src16_archive_write", "select source_id, resource_id, content_hash from fetch_events where content_hash is not null group by 1, 2, 3 having min(fetched_at) >= timestamp '2024-01-01'")
def src16(t):
    keys = ["source_id", "resource_id", "content_hash"]
    e = t.fetch_events.filter("content_hash is not null")
    return A.new_payloads(e.filter("fetched_at >= '2024-01-01'").select(*keys), e.filter("fetched_at < '2024-01-01'"), keys)


@R.query("src17_ttl_probe", "select source_id, resource_id, max(fetched_at) as fetched_at from fetch_events where status = 'ok' and fetched_at >= timestamp '2025-06-01' - interval 400 day group by 1, 2")
def src17(t):
    return A.fresh_events(t.fetch_events, ["source_id", "resource_id"], lit("2025-06-01").cast("timestamp_ntz"), 400).select("source_id", "resource_id", "fetched_at")


@R.query("src18_newest_payload", "select source_id, resource_id, id, content_hash from fetch_events where status = 'ok' and content_hash is not null qualify row_number() over (partition by source_id, resource_id order by fetched_at desc, id desc) = 1")
def src18(t):
    return A.newest_payload_events(t.fetch_events, ["source_id", "resource_id"]).select("source_id", "resource_id", "id", "content_hash")


@R.query("src19_key_listing", "select distinct substr(resource_id, 10) as biennium from fetch_events where resource_id like 'sponsors:%'")
def src19(t):
    return t.fetch_events.filter(c("resource_id").startswith("sponsors:")).select(F.expr("substring(resource_id, 10)").alias("biennium")).distinct()


_SAMPLE = "(select source_id, max(gender) as gender, max(name_used) as name_used from persons group by source_id)"


@R.query("src20_upsert", f"select source_id, coalesce(case when right(source_id, 1) < '5' then upper(gender) end, gender) as gender, name_used from {_SAMPLE}")
def src20(t):
    target = t.persons.groupBy("source_id").agg(F.max("gender").alias("gender"), F.max("name_used").alias("name_used"))
    changes = target.filter(F.substring("source_id", -1, 1) < "5").select("source_id", F.upper("gender").alias("gender"), lit(None).cast("string").alias("name_used"))
    return A.upsert(target, changes, ["source_id"])


@R.query("src21_fill_only", "select source_id, case when right(source_id, 1) < '5' then 'old' else 'new' end as origin from (select distinct source_id from persons)")
def src21(t):
    keys = t.persons.select("source_id").distinct()
    return A.fill_only(keys.filter(F.substring("source_id", -1, 1) < "5").withColumn("origin", lit("old")), keys.withColumn("origin", lit("new")), ["source_id"])


@R.query("src22_citation_sink", f"select p.id as entity_id, e.id as fetch_event_id, f.field, case f.field when '' then 1.0 else 0.9 end as confidence from {_PERSONS} p join (select source_id, max(id) as id from fetch_events where status = 'ok' group by 1) e on p.source = e.source_id, (values (''), ('name_full')) f(field)")
def src22(t):
    event = t.fetch_events.filter("status = 'ok'").groupBy(c("source_id").alias("source")).agg(F.max("id").alias("fetch_event_id"))
    fields = F.explode(F.array(F.struct(lit("").alias("field"), lit(1.0).alias("confidence")), F.struct(lit("name_full").alias("field"), lit(0.9).alias("confidence"))))
    return persons(t).select("id", "source").join(event, "source").select(c("id").alias("entity_id"), "fetch_event_id", fields.alias("x")).select("entity_id", "fetch_event_id", "x.field", "x.confidence")


@R.query("src23_resource_codec", "select distinct resource_id, split_part(resource_id, ':', 1) as prefix, substr(resource_id, strpos(resource_id, ':') + 1) as rest from fetch_events")
def src23(t):
    parts = wire.resource_parts(c("resource_id"), 2)
    return t.fetch_events.select("resource_id", parts[0].alias("prefix"), parts[1].alias("rest")).distinct().select(wire.resource_id(c("prefix"), c("rest")).alias("resource_id"), "prefix", "rest")


@R.query("src25_archive_only", "select source_id, resource_id, min(id) as id from fetch_events where status = 'ok' group by 1, 2")
def src25(t):
    return t.fetch_events.filter("status = 'ok'").groupBy("source_id", "resource_id").agg(F.min("id").alias("id"))


@R.query("src26_harvest_grade", f"select source_id, count(*) filter (status = 'ok') as ok, count(*) filter (http_status = 404) as absent, count(*) filter (status <> 'ok' and http_status is distinct from 404) as skipped, case when count(*) filter (status = 'ok' or http_status = 404) = 0 then 'degraded' else 'ok' end as outcome from {_EVENTS} group by 1")
def src26(t):
    state = F.when(c("http_status") == 404, "absent").otherwise("skipped")
    rows = t.fetch_events.distinct().select("source_id", F.when(c("status") == "ok", "ok").otherwise(state).alias("state"))
    return A.grade(rows, ["source_id"])


@R.query("src27_forced_refresh", "select id, row_number() over (partition by source_id, resource_id, content_hash order by fetched_at, id) = 1 as stored from (select distinct * from fetch_events) where content_hash is not null")
def src27(t):
    """Every resource fetched again whatever its age: stored where source, resource and hash are new
    to the archive.  The first event of a key is found map-side."""
    keys = ["source_id", "resource_id", "content_hash"]
    events = t.fetch_events.filter("content_hash is not null").select("id", "fetched_at", *keys).distinct()
    first = events.groupBy(*keys).agg(F.min(F.struct("fetched_at", "id")).alias("f")).select(c("f.id").alias("id"), lit(True).alias("first"))
    return events.join(first, "id", "left").select("id", F.coalesce("first", lit(False)).alias("stored"))


@R.query("src28_edition_guard", f"select id, case when biennium_label is null then 'unreadable' else 'ok' end as edition from {_SESSIONS} where biennium_label is null or biennium_label = '2015-16'")
def src28(t):
    """Payloads that are asked for as 2015-16: one of another edition is an error, as the tests show;
    an unreadable stamp is only marked."""
    asked = sessions(t).filter("biennium_label is null or biennium_label = '2015-16'")
    return A.guard_edition(asked, lit("2015-16"), c("biennium_label")).select("id", "edition")


@R.query("src29_values", "select * from (values ('legislature', 'joint'), ('house', 'chamber'), ('senate', 'chamber'), ('republican', 'party'), ('democratic', 'party')) v(slug, kind)")
def src29(t):
    return t.spark.createDataFrame([("legislature", "joint"), ("house", "chamber"), ("senate", "chamber"), ("republican", "party"), ("democratic", "party")], "slug string, kind string")


@R.query(
    "src30_get_or_create",
    """with have as (select distinct source_id from fetch_events), wanted as (select distinct source as source_id from persons union select 'elsewhere'),
  seen as (select distinct source_id, substr(resource_id, 10) as period from fetch_events where resource_id like 'sponsors:%'),
  fresh as (select source_id from wanted where source_id not in (select source_id from have))
select source_id, period, false as created from seen union all select source_id, p.period, true from fresh, (values ('2013-14'), ('2015-16')) p(period)""",
)
def src30(t):
    """Coverage of the sources of the events and of the feeds of persons: what was seen, and the seeds of
    those that are created now."""
    have = t.fetch_events.select("source_id").distinct()
    wanted = t.persons.select(c("source").alias("source_id")).unionByName(t.spark.createDataFrame([("elsewhere",)], "source_id string"))
    _, seeds = A.get_or_create(have, wanted, "source_id", ["2013-14", "2015-16"])
    seen = t.fetch_events.filter(c("resource_id").startswith("sponsors:")).select("source_id", F.expr("substring(resource_id, 10)").alias("period")).distinct()
    return seen.withColumn("created", lit(False)).unionByName(seeds.withColumn("created", lit(True)))


@R.query("src31_seed_document", "select '[' || string_agg('{\"code\":\"' || code || '\",\"slug\":\"' || slug || '\"}', ',' order by code) || ']' as document from jurisdictions")
def src31(t):
    return A.seed_document(t.jurisdictions.select("code", "slug"), ["code"])


@R.query("src32_archive_or_gap", "select s.source, b.biennium, count(e.id) > 0 as archived from (select distinct source from persons) s cross join (values ('2013-14'), ('2015-16'), ('2017-18')) b(biennium) left join fetch_events e on e.source_id = s.source and e.status = 'ok' and e.resource_id = 'sponsors:' || b.biennium group by 1, 2")
def src32(t):
    wanted = t.persons.select("source").distinct().select("source", F.explode(F.array(*map(lit, ("2013-14", "2015-16", "2017-18")))).alias("biennium"))
    have = t.fetch_events.filter("status = 'ok'").select(c("source_id").alias("source"), F.expr("substring(resource_id, 10)").alias("biennium"), "resource_id").filter("resource_id = 'sponsors:' || biennium").select("source", "biennium").distinct().withColumn("archived", lit(True))
    return wanted.join(have, ["source", "biennium"], "left").select("source", "biennium", F.coalesce("archived", lit(False)).alias("archived"))


@R.query("src33_sweep_all_or_nothing", "select source_id, resource_id, count(*) as n from fetch_events group by 1, 2 having count(*) filter (status = 'error') = 0")
def src33(t):
    """Sweeps without any failure; one failure drops all of a sweep."""
    return t.fetch_events.groupBy("source_id", "resource_id").agg(F.count("*").alias("n"), F.count_if(c("status") == "error").alias("bad")).filter("bad = 0").drop("bad")


@R.query("src13_change_feed", "select event_id as seq, 'user' as entity_type, user_id::varchar as entity_id, case event_type when 'error' then 'deleted' else 'updated' end as change from events")
def src13(t):
    """The feed source over the events, run to its end once; every change arrives exactly once."""
    from gavelspark.streaming.feed import drain_source

    # Sequence numbers begin with 0 here, so the cursor begins before it.
    return drain_source(t.spark, fetch="gavelspark.sources.remote:table_feed", location=f"{t.dir}/events.parquet", after="-1", limit="10000")


QUERIES, ORACLE = R.queries, R.oracle
