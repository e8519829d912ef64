"""Change-feed application: last write wins, bounded replay, outbox and convergence."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gavelspark.session import shared_path


def drain_source(spark: SparkSession, **options: str) -> DataFrame:
    """The change-feed source read by a streaming query to its end and written to the shared folder."""
    from gavelspark.sources.remote import ChangeFeed

    spark.dataSource.register(ChangeFeed)
    base = shared_path(spark, "feed")
    feed = spark.readStream.format("change_feed").options(**options).load()
    query = feed.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/offsets").start()
    query.processAllAvailable()
    query.stop()
    return spark.read.parquet(f"{base}/rows")


def drain_sample_feed(spark: SparkSession) -> DataFrame:
    """The sample feed, read to its end."""
    return drain_source(spark, fetch="gavelspark.sources.remote:sample_feed", limit="25")


def last_write_wins(local: DataFrame, remote: DataFrame, keys: list[str], clock: str, value: str) -> DataFrame:
    """keys, action, value, clock: absent -> insert; local newer -> keep; remote newer ->
    update; equal clocks -> noop.  Of several remote records of a key the newest counts."""
    r = remote.groupBy(*keys).agg(F.max(F.struct(clock, value)).alias("_r"))
    joined = local.select(*keys, F.struct(clock, value).alias("_l")).join(r, keys, "full_outer")
    lc, rc = F.col(f"_l.{clock}"), F.col(f"_r.{clock}")
    action = F.when(F.col("_l").isNull(), "insert").when(F.col("_r").isNull(), "keep").when(rc > lc, "update").when(rc == lc, "noop").otherwise("keep_enqueue")
    take = action.isin("insert", "update")
    return joined.select(*keys, action.alias("action"), F.when(take, F.col(f"_r.{value}")).otherwise(F.col(f"_l.{value}")).alias(value), F.when(take, rc).otherwise(lc).alias(clock))


def apply_page(page: DataFrame, key: str, seq: str, change: str) -> DataFrame:
    """The last change of each key in a page; what follows a delete within a pass is dropped,
    so a deleted key stays deleted."""
    dead = F.min(F.when(F.col(change) == "deleted", F.col(seq))).over(W.partitionBy(key))
    kept = page.withColumn("_d", dead).filter(F.col("_d").isNull() | (F.col(seq) <= F.col("_d")))
    return kept.groupBy(key).agg(F.max(F.struct(seq, change)).alias("_v")).select(key, f"_v.{seq}", f"_v.{change}")


def resolve_deletes(page: DataFrame, key: str, seq: str, change: str, merged_into: str, natural: str) -> DataFrame:
    """key, seq, outcome, target: what one pass over a page does to each key, in sequence order.

    The first deletion of a key ends it for the pass, later items are skipped.  A deletion
    that names a successor is a merge; else the key is matched again by its ``natural`` key,
    if exactly one other live key of the page has it; else it is a tombstone.  A key
    without a deletion is updated.  Aggregates only, so a hot key is no task's burden."""
    own = page.groupBy(key).agg(F.min(F.when(F.col(change) == "deleted", F.struct(seq, merged_into))).alias("_d"), F.max(F.struct(seq, natural)).alias("_last"))
    told = own.withColumn("_n", F.col(f"_last.{natural}"))
    live = told.filter("_d is null").groupBy("_n").agg(F.count("*").alias("_live"), F.min(key).alias("_other"))
    joined = told.join(live, "_n", "left")
    dead, target = F.col("_d").isNotNull(), F.col(f"_d.{merged_into}")
    again = F.col("_live") == 1
    outcome = F.when(~dead, "updated").when(target.isNotNull(), "merged").when(again, "rematched").otherwise("tombstoned")
    return joined.select(key, F.coalesce(F.col(f"_d.{seq}"), F.col(f"_last.{seq}")).alias(seq), outcome.alias("outcome"), F.when(dead, F.coalesce(target, F.when(again, F.col("_other")))).alias("target"))


def reconcile_in_pages(desired: DataFrame, existing: DataFrame, key: str, values: list[str], limit: int, base: str | None = None) -> DataFrame:
    """key, action of a full reconcile that goes through the keys of both sides in pages of
    ``limit`` behind a cursor.  A page and the cursor after it are one write, so a run that broke
    off goes on with the page it was at, given the same ``base``; null keys are in no page."""
    from gavelspark.operators.relational import full_outer_actions

    spark = desired.sparkSession
    base = base or shared_path(spark, "reconcile")
    keys = desired.select(key).unionByName(existing.select(key)).filter(F.col(key).isNotNull()).distinct()
    schema = f"`{key}` {keys.schema[key].dataType.simpleString()}, action string, _next {keys.schema[key].dataType.simpleString()}"
    try:
        after = spark.read.schema(schema).parquet(f"{base}/after=*").agg(F.max("_next")).first()[0]
    except AnalysisException as e:  # no page was done yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        after = None
    while True:
        rest = keys if after is None else keys.filter(F.col(key) > after)
        upto = rest.orderBy(key).limit(limit).agg(F.max(key)).first()[0]
        if upto is None:
            break
        within = F.col(key) <= upto if after is None else (F.col(key) > after) & (F.col(key) <= upto)
        actions = full_outer_actions(desired.filter(within), existing.filter(within), [key], values)
        actions.withColumn("_next", F.lit(upto).cast(keys.schema[key].dataType)).write.mode("overwrite").parquet(f"{base}/after={'' if after is None else after}")
        after = upto
    return keys.withColumn("action", F.lit("")).limit(0) if after is None else spark.read.schema(schema).parquet(f"{base}/after=*").drop("_next")


def drain_outbox(outbox: DataFrame, now: Column, order: list[str], chunk: int, answer: str, most: int = 60) -> DataFrame:
    """id, position, chunk, state: the due pending entries (due_at up to ``now``) in priority order,
    committed in chunks, each with the state its answer gives it; others are not touched."""
    from gavelspark.operators.paging import global_rank

    due = outbox.filter((F.col("status") == "PENDING") & (F.col("due_at") <= now))
    ranked = global_rank(due, order, "position")
    state = drained(F.col("status"), F.col("attempts") + 1, F.col(answer), most)
    return ranked.select("id", "position", F.floor((F.col("position") - 1) / chunk).alias("chunk"), state.alias("state"))


def suppressed_replays(entries: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """key, suppressed: whether to enqueue a row's update again would repeat exactly what was just
    refused: the key's latest entry is a rejected update with the row's present payload hash.
    A null hash proves nothing.  The latest entry is an aggregate, not a sort."""
    latest = entries.groupBy(key).agg(F.max(F.struct(order, "status", "op", "payload_hash")).alias("_e"))
    same = (F.col("_e.status") == "REJECTED") & (F.col("_e.op") == "UPDATE") & (F.col("_e.payload_hash") == F.col("payload_hash"))
    return rows.join(latest, key, "left").select(key, F.coalesce(same, F.lit(False)).alias("suppressed"))


def redrive(outbox: DataFrame, kind: str, older_than: Column, limit: int) -> DataFrame:
    """id, status: of one kind's unavailable entries that are older, the ``limit`` oldest are pending
    again; of several pending entries of a key all but the newest are superseded."""
    moved = outbox.filter((F.col("status") == "UNAVAILABLE") & (F.col("kind") == kind) & (F.col("at") < older_than)).orderBy("at", "id").limit(limit).select("id", F.lit(True).alias("_moved"))
    newest = outbox.filter("status = 'PENDING'").groupBy("key").agg(F.max(F.struct("at", "id")).alias("_n")).select("key", F.col("_n.id").alias("_newest"))
    joined = outbox.join(moved, "id", "left").join(newest, "key", "left")
    old = (F.col("status") == "PENDING") & (F.col("id") != F.col("_newest"))
    return joined.select("id", F.when(F.col("_moved"), "PENDING").when(old, "SUPERSEDED").otherwise(F.col("status")).alias("status"))


def run_cycle(steps: list[tuple[str, Callable[[], int]]], streak: int = 0) -> tuple[list[tuple[str, str, int | None]], int, int]:
    """Ordered steps, each on its own: (step, ok or failed, result) rows, the streak of failed cycles
    and the seconds to wait, which double from 60 to 3,600.  A failed step stops no other."""
    rows: list[tuple[str, str, int | None]] = []
    for name, step in steps:
        try:
            rows.append((name, "ok", step()))
        except Exception:  # noqa: BLE001 - isolated, logged and counted
            logging.getLogger(__name__).exception("step %s", name)
            rows.append((name, "failed", None))
    streak = streak + 1 if any(r[1] == "failed" for r in rows) else 0
    return rows, streak, min(60 * 2 ** (streak - 1), 3600) if streak else 60


def run_states(ledger: DataFrame, stale_before: Column) -> DataFrame:
    """run_id, outcome, seconds of an append-only ledger (run_id, entry {open, close, shot}, at,
    outcome): a closed or one-shot run has the outcome of its last closing entry, an open one is
    running, or lost if it was opened before ``stale_before``."""
    own = ledger.groupBy("run_id").agg(F.min(F.when(F.col("entry") == "open", F.col("at"))).alias("_o"), F.max(F.when(F.col("entry") != "open", F.struct("at", "outcome"))).alias("_c"))
    outcome = F.when(F.col("_c").isNotNull(), F.col("_c.outcome")).when(F.col("_o") < stale_before, "lost").otherwise("running")
    return own.select("run_id", outcome.alias("outcome"), F.timestamp_diff("SECOND", F.date_trunc("second", "_o"), F.date_trunc("second", "_c.at")).alias("seconds"))


def drain_feed(feed: DataFrame, key: str, seq: str, limit: int = 10_000, base: str | None = None) -> DataFrame:
    """The last sequence number of each key after the whole feed was applied: batches of
    ``limit`` numbers (repeats of the last included) are read after the cursor and
    written, until none follows.

    A batch and the cursor after it are one write to ``base``, so a batch that broke off is
    read again and one that was applied isn't; a later call with the same ``base`` goes
    on from there.  Rows without a sequence number are in no feed."""
    spark = feed.sparkSession
    base = base or shared_path(spark, "feed")
    schema = feed.select(key, F.col(seq).alias(seq), F.col(seq).alias("_next")).schema
    marks = spark.createDataFrame([], schema)
    try:
        marks = spark.read.schema(schema).parquet(f"{base}/after=*")
    except AnalysisException as e:  # nothing was applied yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    after = marks.agg(F.max("_next")).first()[0]
    while True:
        rest = feed.filter(F.col(seq).isNotNull() if after is None else F.col(seq) > after)
        upto = rest.select(seq).orderBy(seq).limit(limit).agg(F.max(seq)).first()[0]
        if upto is None:
            break
        applied = rest.filter(F.col(seq) <= upto).groupBy(key).agg(F.max(seq).alias(seq))
        applied.withColumn("_next", F.lit(upto).cast(schema["_next"].dataType)).write.mode("overwrite").parquet(f"{base}/after={'' if after is None else after}")
        after = upto
    done = marks if after is None else spark.read.schema(schema).parquet(f"{base}/after=*")
    return done.groupBy(key).agg(F.max(seq).alias(seq))


def replay_passes(feed: DataFrame, seq: str, verified: int | None = None, margin: int = 10_000, retain: int = 1_000, most: int = 2_000, first: int = 0) -> DataFrame:
    """pass, seq, fell_off: all passes of the trailing replay until one reaches the feed's end.

    The first floor is verified - retain, or the feed's high water - margin where nothing is
    verified.  A pass reads ``most`` items at most; where it stops is what the next one has as
    verified, so the rest is read by later passes.  ``first`` is the least number a feed begins with."""
    if most <= retain:
        raise ValueError("a pass must be longer than what the next one repeats")
    low, high = feed.agg(F.min(seq), F.max(seq)).first()
    out = feed.select(F.lit(0).alias("pass"), seq, F.lit(False).alias("fell_off")).limit(0)
    floor = verified - retain if verified else (high or 0) - margin
    number = 0
    while high is not None:
        number, floor = number + 1, max(first - 1, floor)
        rest = feed.filter(F.col(seq) > floor).select(seq)
        items, stop = rest.orderBy(seq).limit(most).agg(F.count("*"), F.max(seq)).first()
        if items:
            out = out.unionByName(rest.filter(F.col(seq) <= stop).select(F.lit(number).alias("pass"), seq, F.lit(floor + 1 < low).alias("fell_off")))
        if items < most:
            break
        verified = max(stop, verified or stop)
        floor = verified - retain
    return out


def replay_window(feed: DataFrame, seq: str, verified: int, retain: int, most: int) -> DataFrame:
    """The trailing range re-read for late data: after verified - retain, at most ``most``
    items in sequence order, with ``fell_off`` where the feed no longer reaches that far."""
    floor = max(0, verified - retain)
    low = feed.agg(F.min(seq).alias("_m"))
    page = feed.filter((F.col(seq) > floor) & (F.col(seq) <= verified)).orderBy(seq).limit(most)
    return page.join(F.broadcast(low), F.lit(True)).withColumn("fell_off", F.lit(floor) + 1 < F.col("_m")).drop("_m")


def enqueue(outbox: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted keys without a pending entry, each once."""
    return wanted.select(*keys).distinct().join(outbox.filter("status = 'PENDING'").select(*keys), keys, "left_anti")


def drained(status: Column, attempts: Column, http: Column, most: int = 60) -> Column:
    """Next state of an entry by the answer it got."""
    return (
        F.when(status != "PENDING", status)
        .when(http.between(200, 299), "DELIVERED")
        .when(http.between(400, 499), "REJECTED")
        .when(attempts >= most, "UNAVAILABLE")
        .otherwise("PENDING")
    )


def identical_runs(results: DataFrame, key: str, order: list[str], digest: str) -> DataFrame:
    """run: how many identical results of a key have come in a row, flagged from three on."""
    w = W.partitionBy(key).orderBy(*order)
    fresh = F.when(F.lag(digest).over(w).eqNullSafe(F.col(digest)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    grouped = results.withColumn("_g", fresh)
    grouped = grouped.withColumn("_g", F.sum("_g").over(w))
    run = F.row_number().over(W.partitionBy(key, "_g").orderBy(*order))
    return grouped.withColumn("run", run).withColumn("stuck", F.col("run") >= 3).drop("_g")
