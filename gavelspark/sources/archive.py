"""The archive of fetch events and payloads, canonical sinks and seeds.

Tables are DataFrames in, DataFrames out: a job writes the result to a new path and
swaps, so a lost executor never leaves half a write.
"""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelspark.session import checkpoint


def new_payloads(fetched: DataFrame, archived: DataFrame, keys: list[str]) -> DataFrame:
    """Fetched payloads whose key (source, resource, hash) the archive lacks, each once."""
    return fetched.join(archived.select(*keys), keys, "left_anti").dropDuplicates(keys)


def fresh_events(events: DataFrame, keys: list[str], now: Column, days: int) -> DataFrame:
    """The newest ok event per key that is at most ``days`` old."""
    fresh = events.filter((F.col("status") == "ok") & (F.col("fetched_at") >= now - F.make_interval(days=F.lit(days))))
    return fresh.groupBy(*keys).agg(F.max(F.struct("fetched_at", "id")).alias("v")).select(*keys, "v.fetched_at", "v.id")


def newest_payload_events(events: DataFrame, keys: list[str]) -> DataFrame:
    """The newest ok event with a payload per key; ties go to the greater id."""
    ok = events.filter("status = 'ok' and content_hash is not null")
    rest = [c for c in ok.columns if c not in (*keys, "fetched_at", "id")]
    # The greatest struct aggregates map-side; a key that holds much is not sorted in one task.
    held = ok.groupBy(*keys).agg(F.max(F.struct("fetched_at", "id", *rest)).alias("_v"))
    return held.select(*keys, "_v.fetched_at", "_v.id", *[f"_v.{c}" for c in rest])


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Merge on the natural key; nulls never overwrite.  Of changes with one key the
    greatest row counts; target rows without a change stay."""
    values = [c for c in target.columns if c not in keys]
    new = changes.groupBy(*keys).agg(F.max(F.struct(*values)).alias("_n"))
    old = target.select(*keys, F.struct(*values).alias("_o"))
    return old.join(new, keys, "full_outer").select(*keys, *[F.coalesce(F.col(f"_n.{v}"), F.col(f"_o.{v}")).alias(v) for v in values])


def fill_only(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds rows with new keys; existing rows win."""
    return target.unionByName(rows.join(target.select(*keys), keys, "left_anti").dropDuplicates(keys).select(*target.columns))


def get_or_create(have: DataFrame, wanted: DataFrame, key: str, coverage: list[str]) -> tuple[DataFrame, DataFrame]:
    """All sources, with ``created``, and the coverage rows (key, period) that those created now begin
    with; sources that were there keep theirs.  A null key makes no source."""
    fresh = wanted.select(key).filter(F.col(key).isNotNull()).distinct().join(have.select(key), key, "left_anti")
    sources = have.select(key).distinct().withColumn("created", F.lit(False)).unionByName(fresh.withColumn("created", F.lit(True)))
    return sources, fresh.select(key, F.explode(F.array(*map(F.lit, coverage))).alias("period"))


def changed_validators(current: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to read in full: those whose validator is not the stored one."""
    return current.join(stored, keys, "left_anti")


def grade(statuses: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ok, absent, skipped, outcome: degraded where everything was skipped."""
    counts = statuses.groupBy(*keys).agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("ok", "absent", "skipped")])
    return counts.withColumn("outcome", F.when((F.col("ok") == 0) & (F.col("absent") == 0), "degraded").otherwise("ok"))


def seed_document(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row, one text: a JSON array in a fixed order with fixed fields, so equal data give
    equal bytes.  For seeds, which are bounded by the sweep that made them."""
    listed = rows.agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in sorted(rows.columns) if c not in order]))).alias("l"))
    return listed.select(F.to_json("l").alias("document"))


def write_sidecars(path: str, content: bytes, extra: dict[str, str] | None = None) -> dict:
    """Writes ``.sha256`` and ``.meta.json`` beside a file; reserved keys may not be shadowed."""
    digest = hashlib.sha256(content).hexdigest()
    reserved = {"sha256": digest, "bytes": len(content)}
    if shadowed := reserved.keys() & (extra or {}).keys():
        raise ValueError(f"reserved keys: {sorted(shadowed)}")
    meta = reserved | (extra or {})
    Path(f"{path}.sha256").write_text(f"{digest}  {Path(path).name}\n")
    Path(f"{path}.meta.json").write_text(json.dumps(meta, sort_keys=True))
    return meta


def _write_shared(spark: SparkSession, path: str, content: bytes) -> None:
    """Small bytes to any file system that the session knows."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def write_seed(spark: SparkSession, path: str, content: bytes, extra: dict[str, str] | None = None) -> dict:
    """A seed with its two sidecars in the shared folder; reserved keys may not be shadowed."""
    reserved = {"sha256": hashlib.sha256(content).hexdigest(), "bytes": len(content)}
    if shadowed := reserved.keys() & (extra or {}).keys():
        raise ValueError(f"reserved keys: {sorted(shadowed)}")
    meta = reserved | (extra or {})
    _write_shared(spark, path, content)
    _write_shared(spark, f"{path}.sha256", f"{meta['sha256']}  {path.rsplit('/', 1)[-1]}\n".encode())
    _write_shared(spark, f"{path}.meta.json", json.dumps(meta, sort_keys=True).encode())
    return meta


def seed_files(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(path, content) of the seeds of a folder and (path, digest) of their checksum files."""
    every = spark.read.format("binaryFile").load(base).select("path", "content")
    sums = every.filter("path like '%.sha256'").select(F.regexp_replace("path", r"\.sha256$", "").alias("path"), F.split(F.col("content").cast("string"), " ")[0].alias("digest"))
    return every.filter("path not like '%.sha256' and path not like '%.meta.json'"), sums


def discover(edges: DataFrame, roots: DataFrame, hops: int, most: int) -> DataFrame:
    """kind, node, hop, truncated: what up to ``hops`` hops reach from ``roots`` (kind, node) over
    ``edges`` (kind, node, to_kind, to) in both directions, each node at its first hop.

    A hop after which over ``most`` nodes are known is the last, and all rows say so; edges
    with a null end lead nowhere."""
    whole = edges.filter("node is not null and `to` is not null").distinct()
    both = whole.unionByName(whole.select(F.col("to_kind").alias("kind"), F.col("to").alias("node"), F.col("kind").alias("to_kind"), F.col("node").alias("to")))
    known = checkpoint(roots.filter("node is not null").select("kind", "node", F.lit(0).alias("hop")).distinct())
    cut = False
    for hop in range(1, hops + 1):
        if cut := known.count() > most:
            break
        at = known.filter(F.col("hop") == hop - 1).select("kind", "node")
        met = both.join(at, ["kind", "node"], "left_semi").select(F.col("to_kind").alias("kind"), F.col("to").alias("node")).distinct()
        known = checkpoint(known.unionByName(met.join(known, ["kind", "node"], "left_anti").withColumn("hop", F.lit(hop))))
    return known.withColumn("truncated", F.lit(cut))


def verified(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """path, content of files whose hash is that of their sidecar; a missing sidecar or a
    mismatch raises."""
    joined = files.join(sidecars, "path", "left")
    ok = F.col("digest") == F.sha2("content", 256)
    checked = F.when(ok, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("bad checksum: "), "path")).cast("binary"))
    return joined.select("path", checked.alias("content"))


def guard_edition(events: DataFrame, key: Column, stamp: Column) -> DataFrame:
    """Rows with ``edition`` ok or unreadable (which is only logged); a mismatch is an error."""
    checked = edition_problems(events, key, stamp)
    wrong = F.raise_error(F.concat(F.lit("edition mismatch: "), stamp)).cast("string")
    return checked.withColumn("edition", F.when(F.col("edition") == "mismatch", wrong).otherwise(F.col("edition")))


def edition_problems(events: DataFrame, key: Column, stamp: Column) -> DataFrame:
    """Rows with ``edition``: ok, mismatch (must not be used) or unreadable (is only logged)."""
    return events.withColumn("edition", F.when(stamp.isNull(), "unreadable").when(stamp == key, "ok").otherwise("mismatch"))
