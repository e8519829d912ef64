"""Change feed, outbox and state (STM*), and the extension surface (UDX*)."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gavelspark.functions import strings as S
from gavelspark.operators import relational as O
from gavelspark.plans.problems import _P1
from gavelspark.plans.registry import Registry
from gavelspark.plans.relational import _BILLS, _CODE, _EVENTS, _PERSONS, _PLAINED, persons
from gavelspark.session import stored
from gavelspark.streaming import feed as X

R = Registry()
log = logging.getLogger(__name__)
c, lit = F.col, F.lit

_LOCAL = "(select user_id, max(ts) as ts, arg_max(event_type, (ts, event_id)) as v from events where event_type <> 'purchase' group by 1)"
_REMOTE = "(select user_id, max(ts) as ts, arg_max(event_type, (ts, event_type)) as v from events where event_type in ('purchase', 'view') and user_id % 3 > 0 group by 1)"


@R.query(
    "stm1_last_write_wins",
    f"select coalesce(a.user_id, b.user_id) as user_id, case when a.user_id is null then 'insert' when b.user_id is null then 'keep' when b.ts > a.ts then 'update' when b.ts = a.ts then 'noop' else 'keep_enqueue' end as action, case when a.user_id is null or b.ts > a.ts then b.v else a.v end as v from {_LOCAL} a full outer join {_REMOTE} b on a.user_id = b.user_id",
)
def stm1(t):
    local = t.events.filter("event_type <> 'purchase'").groupBy("user_id").agg(F.max("ts").alias("ts"), F.max_by("event_type", F.struct("ts", "event_id")).alias("v"))
    remote = t.events.filter("event_type in ('purchase', 'view') and user_id % 3 > 0").select("user_id", "ts", c("event_type").alias("v"))
    return X.last_write_wins(local, remote, ["user_id"], "ts", "v").select("user_id", "action", "v")


@R.query("stm2_feed_to_end", "select user_id, max(event_id) as seq from events group by 1")
def stm2_all(t):
    """The whole feed, batch by batch behind an advancing cursor."""
    return X.drain_feed(t.events, "user_id", "event_id").select("user_id", c("event_id").alias("seq"))


_PAGE = "(select user_id, event_id, event_type = 'error' as dead, case when event_id % 3 = 0 then user_id + 1 end as into_, user_id % 50 as n from events)"


@R.query(
    "stm3_page_with_deletes",
    f"""with o as (select user_id, n, min(event_id) filter (dead) as d, max(event_id) as z, arg_min(into_, event_id) filter (dead) as into_ from {_PAGE} group by 1, 2),
  first as (select o.*, case when d % 3 = 0 then user_id + 1 end as target from o),
  live as (select n, count(*) as k, min(user_id) as other from o where d is null group by 1)
select user_id, coalesce(d, z) as event_id, case when d is null then 'updated' when target is not null then 'merged' when k = 1 then 'rematched' else 'tombstoned' end as outcome, case when d is null then null else coalesce(target, case when k = 1 then other end) end as target from first left join live using (n)""",
)
def stm3(t):
    """The events as one page: an error deletes its user, every third names a successor."""
    page = t.events.select("user_id", "event_id", F.when(c("event_type") == "error", "deleted").otherwise("updated").alias("change"), F.when(c("event_id") % 3 == 0, c("user_id") + 1).alias("merged_into"), (c("user_id") % 50).alias("natural"))
    return X.resolve_deletes(page, "user_id", "event_id", "change", "merged_into", "natural")


@R.query(
    "stm4_trailing_replay",
    """with recursive high as (select min(event_id) as low, max(event_id) as high from events),
  p as (select 1 as pass, greatest(-1, (select high from high) - 10000) as floor
    union all select pass + 1, greatest(-1, floor + 2000 - 1000) from p where floor + 2000 <= (select high from high))
select p.pass, e.event_id, p.floor + 1 < (select low from high) as fell_off from p join events e on e.event_id > p.floor and e.event_id <= p.floor + 2000""",
)
def stm4(t):
    """Every pass of the trailing replay, from the margin before the high water to the feed's end."""
    return X.replay_passes(t.events, "event_id")


@R.query("stm5_full_reconcile", "select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when b.o_orderkey is null then 'insert' when a.o_orderkey is null then 'delete' when a.o_orderstatus is distinct from b.s then 'update' else 'keep' end as action from (select * from orders where o_orderkey % 5 > 0) a full outer join (select o_orderkey, case when o_orderkey % 7 > 0 then o_orderstatus end as s from orders where o_orderkey % 6 > 0) b on a.o_orderkey = b.o_orderkey")
def stm5(t):
    """All orders in pages behind a cursor that a broken run resumes at."""
    o = t.orders.select("o_orderkey", "o_orderstatus")
    existing = o.filter("o_orderkey % 6 > 0").withColumn("o_orderstatus", F.when(c("o_orderkey") % 7 > 0, c("o_orderstatus")))
    return X.reconcile_in_pages(o.filter("o_orderkey % 5 > 0"), existing, "o_orderkey", ["o_orderstatus"], 100_000)


@R.query("stm6_validator_withheld", f"select id, case when updated_at > created_at + interval 30 day then null else source_id end as validator from {_PERSONS}")
def stm6(t):
    late = c("updated_at") > c("created_at") + F.expr("interval 30 days")
    return persons(t).select("id", F.when(~late, c("source_id")).alias("validator"))


@R.query("stm7_enqueue", "select distinct o_custkey from orders where o_orderstatus = 'O' except select o_custkey from orders where o_orderstatus = 'P'")
def stm7(t):
    outbox = t.orders.filter("o_orderstatus = 'P'").select("o_custkey", lit("PENDING").alias("status"))
    return X.enqueue(outbox, t.orders.filter("o_orderstatus = 'O'"), ["o_custkey"])


@R.query("stm8_drain", f"with d as (select *, row_number() over (order by case status when 'error' then 0 else 1 end, fetched_at, id) as position from {_EVENTS} where fetched_at <= timestamp '2025-01-01') select id, position, ((position - 1) // 100)::bigint as chunk, case when http_status between 200 and 299 then 'DELIVERED' when http_status between 400 and 499 then 'REJECTED' else 'PENDING' end as state from d")
def stm8(t):
    """Fetches as an outbox: those due by 2025, failed ones first, in chunks of a hundred."""
    e = t.fetch_events.select("id", "fetched_at", "status", "http_status").distinct()
    outbox = e.select("id", lit("PENDING").alias("status"), c("fetched_at").alias("due_at"), F.when(c("status") == "error", 0).otherwise(1).alias("priority"), lit(0).alias("attempts"), "http_status")
    return X.drain_outbox(outbox, lit("2025-01-01").cast("timestamp_ntz"), ["priority", "due_at", "id"], 100, "http_status")


@R.query("stm9_dead_letter", "select o_orderkey, case when o_orderkey % 100 >= 60 then 'UNAVAILABLE' else 'PENDING' end as state from orders")
def stm9(t):
    return t.orders.select("o_orderkey", X.drained(lit("PENDING"), c("o_orderkey") % 100, lit(503)).alias("state"))


@R.query("stm10_reject_replay", "with l as (select user_id, arg_max(event_type, event_id) as kind, max(event_id) as id, floor(arg_max(value, event_id))::bigint % 3 as h from events where value is not null group by 1), r as (select user_id, floor(min(value))::bigint % 3 as h from events where value is not null group by 1) select r.user_id, coalesce(l.kind = 'error' and l.id % 2 = 0 and l.h = r.h, false) as suppressed from r left join l using (user_id)")
def stm10(t):
    """Events as outbox entries (an error is a rejection, an even number an update): users whose present
    payload is what their latest entry was refused for."""
    e = t.events.filter("value is not null")
    digest = lambda v: (F.floor(v) % 3).cast("string")
    entries = e.select("user_id", "event_id", F.when(c("event_type") == "error", "REJECTED").otherwise("DELIVERED").alias("status"), F.when(c("event_id") % 2 == 0, "UPDATE").otherwise("CREATE").alias("op"), digest(c("value")).alias("payload_hash"))
    rows = e.groupBy("user_id").agg(digest(F.min("value")).alias("payload_hash"))
    return X.suppressed_replays(entries, rows, "user_id", "event_id")


@R.query("stm11_fingerprint_drift", f"select id, gender is distinct from case when right(id, 1) < 'G' then gender end as drifted from {_PERSONS}")
def stm11(t):
    stored = F.when(F.substring("id", -1, 1) < "G", c("gender"))
    return persons(t).select("id", (~c("gender").eqNullSafe(stored)).alias("drifted"))


@R.query("stm12_identical_runs", "with x as (select user_id, event_id, event_type, case when lag(event_type) over w = event_type then 0 else 1 end as f from events window w as (partition by user_id order by event_id)), g as (select *, sum(f) over (partition by user_id order by event_id) as g from x) select event_id, row_number() over (partition by user_id, g order by event_id) as run, row_number() over (partition by user_id, g order by event_id) >= 3 as stuck from g")
def stm12(t):
    return X.identical_runs(t.events.select("user_id", "event_id", "event_type"), "user_id", ["event_id"], "event_type").select("event_id", "run", "stuck")


@R.query("stm13_reanchor_ledger", "select id, before as old, content_hash as new from (select id, content_hash, lag(content_hash) over (partition by source_id, resource_id order by fetched_at, id) as before from (select distinct * from fetch_events) where content_hash is not null) where before <> content_hash")
def stm13(t):
    before = F.lag("content_hash").over(W.partitionBy("source_id", "resource_id").orderBy("fetched_at", "id"))
    return t.fetch_events.distinct().filter("content_hash is not null").withColumn("old", before).filter("old <> content_hash").select("id", "old", c("content_hash").alias("new"))


@R.query(
    "stm14_redrive",
    """with m as (select o_orderkey from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT' and o_orderdate < timestamp '1997-01-01' order by o_orderdate, o_orderkey limit 500),
  n as (select o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as k from orders where o_orderstatus = 'P' group by 1)
select o.o_orderkey as id, case when m.o_orderkey is not null then 'PENDING' when o_orderstatus = 'P' and o.o_orderkey <> n.k then 'SUPERSEDED' else case o_orderstatus when 'F' then 'UNAVAILABLE' when 'P' then 'PENDING' else 'DELIVERED' end end as status
from orders o left join m on o.o_orderkey = m.o_orderkey left join n on o.o_custkey = n.o_custkey""",
)
def stm14(t):
    """Orders as an outbox: the 500 oldest urgent unavailable ones of before 1997 are driven again."""
    status = F.when(c("o_orderstatus") == "F", "UNAVAILABLE").when(c("o_orderstatus") == "P", "PENDING").otherwise("DELIVERED")
    outbox = t.orders.select(c("o_orderkey").alias("id"), c("o_custkey").alias("key"), c("o_orderpriority").alias("kind"), c("o_orderdate").alias("at"), status.alias("status"))
    return X.redrive(outbox, "1-URGENT", lit("1997-01-01").cast("timestamp_ntz"), 500)


@R.query("stm15_subscriptions", "with d as (select distinct o_custkey as k from orders where o_custkey % 4 > 0), h as (select distinct o_custkey as k from orders where o_custkey % 5 > 0) select k, 'add' as action from d where k not in (select k from h) union all select k, 'prune' from h where k not in (select k from d) and (select count(*) from h where k not in (select k from d)) <= 0.9 * (select count(*) from h)")
def stm15(t):
    k = t.orders.select(c("o_custkey").alias("k")).distinct()
    desired, have = k.filter("k % 4 > 0"), k.filter("k % 5 > 0")
    prune = O.guarded(have.join(desired, "k", "left_anti"), have, 0.9, 0)
    return desired.join(have, "k", "left_anti").withColumn("action", lit("add")).unionByName(prune.withColumn("action", lit("prune")))


@R.query("stm16_cycle", "select 'read' as step, 'ok' as state, (select count(*) from events) as result, 60 as wait union all select 'apply', 'failed', null, 60 union all select 'drain', 'ok', (select count(*) from orders where o_orderstatus = 'P'), 60")
def stm16(t):
    """A cycle of three steps; the second fails and stops neither of the others."""

    def broken() -> int:
        raise RuntimeError("apply failed, as asked")

    rows, _, wait = X.run_cycle([("read", lambda: t.events.count()), ("apply", broken), ("drain", lambda: t.orders.filter("o_orderstatus = 'P'").count())])
    return t.spark.createDataFrame([(*r, wait) for r in rows], "step string, state string, result bigint, wait int")


@R.query("stm17_rise_alert", "select d, n, n > lag(n) over (order by d) as rose from (select ts::date as d, count(*) filter (event_type = 'error') as n from events group by 1)")
def stm17(t):
    daily = t.events.groupBy(c("ts").cast("date").alias("d")).agg(F.count_if(c("event_type") == "error").alias("n"))
    # One row per day: the order is over the calendar, not over the events.
    return daily.withColumn("rose", c("n") > F.lag("n").over(W.orderBy("d")))


@R.query("stm18_job_ledger", f"select id as run_id, case when role = 'primary' and withdrawn_at is null and sponsor_order = 1 then 'shot' when withdrawn_at is not null then 'done' when created_at < timestamp '2023-01-01' then 'lost' else 'running' end as outcome, case when withdrawn_at is not null then date_diff('second', date_trunc('second', created_at), date_trunc('second', withdrawn_at)) end as seconds from {_BILLS}")
def stm18(t):
    """Sponsorships as runs: opened when created, closed when withdrawn; a lone first sponsor is a run of one entry."""
    b = t.bill_sponsorships.select("id", "role", "sponsor_order", "created_at", "withdrawn_at").distinct()
    shot = F.coalesce((c("role") == "primary") & c("withdrawn_at").isNull() & (c("sponsor_order") == 1), lit(False))
    entry = lambda rows, kind, at, outcome: rows.select(c("id").alias("run_id"), lit(kind).alias("entry"), c(at).alias("at"), lit(outcome).alias("outcome"))
    ledger = entry(b.filter(~shot), "open", "created_at", None).unionByName(entry(b.filter("withdrawn_at is not null"), "close", "withdrawn_at", "done")).unionByName(entry(b.filter(shot), "shot", "created_at", "shot"))
    return X.run_states(ledger, lit("2023-01-01").cast("timestamp_ntz"))


@R.query("stm19_stream_intervals", f"select entity_id as entity, kind, from_date, to_date from ({_P1}) where table_name = 'legislative_sessions'")
def stm19(t):
    """The sittings of p1 streamed through the keyed interval map, two files a batch; the last state of
    each assembly."""
    from gavelspark.plans.problems import sittings
    from gavelspark.session import shared_path
    from gavelspark.streaming.intervals import day_text, stream_periods

    base = shared_path(t.spark, "intervals")
    sittings(t.legislative_sessions).repartition(6).write.parquet(f"{base}/in")
    rows = t.spark.readStream.schema("organization_id string, `from` date, `to` date").option("maxFilesPerTrigger", 2).parquet(f"{base}/in")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", lit(number)).write.mode("overwrite").parquet(f"{base}/rows/n={number}")

    query = stream_periods(rows, "organization_id", "from", "to").writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/offsets").trigger(availableNow=True).start()
    query.awaitTermination()
    out = t.spark.read.schema("entity string, kind string, lo int, hi int, batch int").parquet(f"{base}/rows/*")
    last = out.groupBy("entity").agg(F.max("batch").alias("batch"))
    # Days of sittings are inclusive: the last one is one before the half-open end.
    return out.join(last, ["entity", "batch"]).select("entity", "kind", day_text("lo").alias("from_date"), day_text("hi", -1).alias("to_date"))


# Extension surface -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Descriptor:
    """What an entity kind must tell the engine: its keys, its clock, the columns compared, and, to meet
    remote records, their projection to its own columns and the keys that match."""

    kind: str
    keys: tuple[str, ...]
    clock: str
    compared: tuple[str, ...]
    projection: tuple[tuple[str, Column], ...] = ()
    natural: tuple[str, ...] = ()

    def unchanged(self, other: str = "_other") -> Column:
        return F.array_min(F.array(*[c(x).eqNullSafe(c(f"{x}{other}")) for x in self.compared]))

    def project(self, remote: DataFrame) -> DataFrame:
        return remote.select(*[column.alias(name) for name, column in self.projection])

    def match(self, local: DataFrame, remote: DataFrame, anchor: str) -> DataFrame:
        """anchor, outcome {matched, ambiguous, new} and the local key of a projected remote record."""
        key = self.keys[0]
        held = local.groupBy(*self.natural).agg(F.count_distinct(key).alias("_n"), F.min(key).alias(key))
        met = remote.select(anchor, *self.natural).distinct().join(held, list(self.natural), "left").groupBy(anchor).agg(F.sum(F.coalesce("_n", lit(0))).alias("_n"), F.min(key).alias(key))
        outcome = F.when(c("_n") == 0, "new").when(c("_n") == 1, "matched").otherwise("ambiguous")
        return met.select(anchor, outcome.alias("outcome"), F.when(c("_n") == 1, c(key)).alias(key))


class Adapter:
    """discover, fetch and normalize of one upstream, as frame-to-frame functions."""

    def __init__(self, discover: Callable[[], DataFrame], fetch: Callable[[DataFrame], DataFrame], normalize: Callable[[DataFrame], DataFrame]) -> None:
        self.steps = (fetch, normalize)
        self.discover = discover

    def run(self) -> DataFrame:
        df = self.discover()
        for step in self.steps:
            df = step(df)
        return df


def run_job(handler: Callable[..., DataFrame], publish: Callable[[DataFrame], None], args: dict | None = None, known: tuple[str, ...] = (), dry_run: bool = False) -> int:
    """Exit code of a job: 0 done, 1 failed, 2 called with unknown arguments (nothing is run), 4 dry run.

    The result is written to the shared folder before it is published, so a failure leaves
    nothing half done: the staged table is dropped and the target untouched.  A failure is logged."""
    if unknown := sorted(set(args or {}) - set(known)):
        log.error("unknown arguments: %s", unknown)
        return 2
    try:
        staged = stored(handler(**(args or {})))
        if dry_run:
            return 4
        publish(staged)
        return 0
    except Exception:  # noqa: BLE001 - a job's failure is its exit code
        log.exception("job failed")
        return 1


@R.query("udx1_job_harness", "select * from (values ('done', 0, 5), ('dry', 4, 5), ('failed', 1, 5), ('usage', 2, 5)) v(run, code, published)")
def udx1(t):
    """Four runs of one job: its exit codes, and what is published after each (only the first's rows)."""
    target: list[int] = []
    regions = lambda least=0: t.region.filter(c("r_regionkey") >= least)

    def broken() -> DataFrame:
        return t.region.withColumn("x", F.raise_error(lit("failed, as asked")).cast("string"))

    publish = lambda df: target.append(df.count())
    runs = [("done", regions, {"least": 0}, False), ("dry", regions, {}, True), ("failed", broken, {}, False), ("usage", regions, {"lest": 1}, False)]
    rows = [(name, run_job(job, publish, args, ("least",), dry), sum(target)) for name, job, args, dry in runs]
    return t.spark.createDataFrame(rows, "run string, code int, published int")


@R.query("udx2_adapter", "select distinct resource_id, split_part(resource_id, ':', 2) as biennium from fetch_events where resource_id like 'sponsors%'")
def udx2(t):
    return Adapter(
        lambda: t.fetch_events.select("resource_id").distinct(),
        lambda refs: refs.filter(c("resource_id").startswith("sponsors")),
        lambda rows: rows.withColumn("biennium", F.split_part("resource_id", lit(":"), lit(2))),
    ).run()


@R.query("udx3_cohort_provider", "select source, mention_id from senate_winners where election_year = 2010 union select source, mention_id from deferred_annotations where session_year = 2010")
def udx3(t):
    providers: list[Callable[[int], DataFrame]] = [
        lambda year: t.senate_winners.filter(c("election_year") == year).select("source", "mention_id"),
        lambda year: t.deferred_annotations.filter(c("session_year") == year).select("source", "mention_id"),
    ]
    return providers[0](2010).unionByName(providers[1](2010)).distinct()


@R.query("udx4_resolver_join", f"select b.id, p.name_full from {_BILLS} b join {_PERSONS} p on b.person_id = p.id")
def udx4(t):
    resolver = persons(t).select(c("id").alias("person_id"), "name_full")
    return t.bill_sponsorships.distinct().select("id", "person_id").join(resolver, "person_id").select("id", "name_full")


@R.query("udx5_descriptor", "select a.id, a.name_full is not distinct from b.name_full and a.gender is not distinct from b.gender as unchanged from (select * from persons qualify row_number() over (partition by id order by updated_at desc) = 1) a join (select * from persons qualify row_number() over (partition by id order by updated_at) = 1) b on a.id = b.id")
def udx5(t):
    d = Descriptor("person", ("id",), "updated_at", ("name_full", "gender"))
    oldest = t.persons.groupBy(*d.keys).agg(F.min(F.struct(d.clock, *d.compared)).alias("_o"))
    old = oldest.select(*d.keys, *[c(f"_o.{x}").alias(f"{x}_other") for x in d.compared])
    return persons(t).join(old, list(d.keys)).select("id", d.unchanged().alias("unchanged"))


@R.query(
    "udx5_match",
    f"""with l as (select distinct id, upper(left(source_id, 2)) || '-' || lpad(regexp_extract(source_id, '^[A-Za-z]{{2}}\\W*0*(\\d+)', 1), 6, '0') as assembly, {_PLAINED.format('name_full')} as plain from {_PERSONS}),
  r as (select distinct pm_id, {_CODE} as assembly, {_PLAINED.format('display_name')} as plain from candidates),
  h as (select assembly, plain, count(distinct id) as n, min(id) as id from l group by 1, 2),
  m as (select r.pm_id, sum(coalesce(h.n, 0)) as n, min(h.id) as id from r left join h on r.assembly = h.assembly and r.plain = h.plain group by 1)
select pm_id, case when n = 0 then 'new' when n = 1 then 'matched' else 'ambiguous' end as outcome, case when n = 1 then id end as id from m""",
)
def udx5_match(t):
    """Registry people projected to persons and matched by assembly and normalized name."""
    code = S.assembly_code
    d = Descriptor("person", ("id",), "updated_at", ("plain",), (("pm_id", c("pm_id")), ("assembly", code(c("assembly"))), ("plain", S.normalize_name(c("display_name")))), ("assembly", "plain"))
    local = persons(t).select("id", code(F.split_part("source_id", lit(":"), lit(1))).alias("assembly"), S.normalize_name(c("name_full")).alias("plain"))
    return d.match(local, d.project(t.candidates), "pm_id")


@R.query("udx6_validators", "select distinct record_id, concat_ws(',', case when kind not in ('departed', 'vacated', 'seated') then 'kind' end, case when kind <> 'departed' and seat_kind is null then 'seat' end, case when effective_date is null then 'date' end) as problems from event_proposals")
def udx6(t):
    problems = F.concat_ws(",", F.when(~c("kind").isin("departed", "vacated", "seated"), "kind"), F.when((c("kind") != "departed") & c("seat_kind").isNull(), "seat"), F.when(c("effective_date").isNull(), "date"))
    return t.event_proposals.select("record_id", problems.alias("problems")).distinct()


_SUPERSEDED = "(select distinct record_id, assembly, member_name, kind, seat_kind, lag(kind) over w as old_kind, lag(seat_kind) over w as old_seat, lag(record_id) over w as old from (select distinct record_id, assembly, member_name, kind, seat_kind, effective_date from event_proposals) window w as (partition by assembly, member_name order by effective_date, record_id))"


@R.query("udx6_supersede_rules", f"select record_id, old, concat_ws(',', case when kind <> old_kind then 'kind' end, case when seat_kind is distinct from old_seat then 'seat' end) as problems from {_SUPERSEDED} where old is not null")
def udx6_supersedes(t):
    """A record that supersedes the member's last one must keep its kind and seat; what it changes is named."""
    w = W.partitionBy("assembly", "member_name").orderBy("effective_date", "record_id")
    rows = t.event_proposals.select("record_id", "assembly", "member_name", "kind", "seat_kind", "effective_date").distinct()
    old = rows.select("record_id", "kind", "seat_kind", F.lag("record_id").over(w).alias("old"), F.lag("kind").over(w).alias("old_kind"), F.lag("seat_kind").over(w).alias("old_seat")).filter("old is not null")
    return old.select("record_id", "old", F.concat_ws(",", F.when(c("kind") != c("old_kind"), "kind"), F.when(~c("seat_kind").eqNullSafe(c("old_seat")), "seat")).alias("problems"))


@R.query("udx6_ends", "select distinct source_id, boundary_biennium, case when nullif(trim(former_name), '') is null or nullif(trim(legal_name), '') is null then 'end_missing' when regexp_replace(strip_accents(lower(replace(former_name, '&', 'and'))), '[^a-z0-9]', '', 'g') = regexp_replace(strip_accents(lower(replace(legal_name, '&', 'and'))), '[^a-z0-9]', '', 'g') then 'ends_equal' end as problem from rename_transitions")
def udx6_ends(t):
    """Both ends of a succession must be there and differ in more than typing."""
    from gavelspark.functions.folding import alnum_key
    from gavelspark.functions.strings import clean

    missing = clean(c("former_name")).isNull() | clean(c("legal_name")).isNull()
    problem = F.when(missing, "end_missing").when(alnum_key(c("former_name")) == alnum_key(c("legal_name")), "ends_equal")
    return t.rename_transitions.select("source_id", "boundary_biennium", problem.alias("problem")).distinct()


QUERIES, ORACLE = R.queries, R.oracle
