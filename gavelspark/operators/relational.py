"""Joins, matches and aggregates that refuse to guess."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def live_only(df: DataFrame, include_hidden: bool = False) -> DataFrame:
    """Rows that are neither archived nor deleted; apply to each side before a join.
    A frame without either column is an error."""
    marks = [m for m in ("archived_at", "deleted_at") if m in df.columns]
    if not marks:
        raise ValueError("no visibility column")
    return df if include_hidden else df.filter(" and ".join(f"{m} is null" for m in marks))


def as_of(day: Column, start: Column, end: Column) -> Column:
    """Closed interval containment; a null end is open."""
    return (start <= day) & (end.isNull() | (end >= day))


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order, which must be total for a fixed result."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def unique_match(candidates: DataFrame, keys: list[str], value: str, tie: str | None = None) -> DataFrame:
    """keys, match: the only distinct value per key; with several, the only one among rows
    where ``tie`` is true; else null.  One aggregation, no second pass."""
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c))
    first = one(F.col(value))
    second = one(F.when(F.col(tie), F.col(value))) if tie else F.lit(None)
    return candidates.groupBy(*keys).agg(F.coalesce(first, second).alias("match"))


def top_or_refuse(df: DataFrame, keys: list[str], votes: str, value: str) -> DataFrame:
    """keys, winner: a sole row wins; any null vote or a tie at the top gives null.  Two partial
    aggregations on the way down, no join: a hot key is counted map-side."""
    tallied = df.groupBy(*keys, votes).agg(F.count("*").alias("_n"), F.min(value).alias("_v"))
    top = tallied.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.sum(F.when(F.col(votes).isNull(), F.col("_n"))).alias("_unknown"), F.max(F.struct(F.col(votes), "_n", "_v")).alias("_best"))
    sure = (F.col("_rows") == 1) | (F.col("_unknown").isNull() & (F.col("_best._n") == 1))
    return top.select(*keys, F.when(sure, F.col("_best._v")).alias("winner"))


def single_match(rows: DataFrame, table: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``rows`` with the one ``value`` that ``table`` has for their keys; none or several is an error."""
    held = table.groupBy(*keys).agg(F.count_distinct(value).alias("_n"), F.min(value).alias(value))
    found = rows.join(held, keys, "left")
    fail = lambda what: F.raise_error(F.concat(F.lit(f"{what} for "), F.concat_ws("/", *keys))).cast(table.schema[value].dataType)
    one = F.when(F.col("_n").isNull(), fail("no match")).when(F.col("_n") > 1, fail("several matches")).otherwise(F.col(value))
    return found.withColumn(value, one).drop("_n")


def full_outer_actions(desired: DataFrame, existing: DataFrame, keys: list[str], values: list[str], overwrite: bool = False) -> DataFrame:
    """keys, action {insert, update, delete, keep} of a reconcile; values compare null-safely."""
    d = desired.select(*keys, F.struct(*values).alias("_d"), F.lit(True).alias("_in"))
    e = existing.select(*keys, F.struct(*values).alias("_e"), F.lit(True).alias("_had"))
    same = F.col("_d").eqNullSafe(F.col("_e"))
    action = F.when(F.col("_had").isNull(), "insert").when(F.col("_in").isNull(), "delete").when(same & ~F.lit(overwrite), "keep").otherwise("update")
    return d.join(e, keys, "full_outer").select(*keys, action.alias("action"))


def reconcile(desired: DataFrame, existing: DataFrame, keys: list[str], values: list[str], owner: str, ours: str, anchor: str) -> DataFrame:
    """keys, action of a full-outer reconcile that touches only its own: what another ``owner``
    holds is skipped, and a row that is no longer desired is deleted only if it has an
    ``anchor``; without one it is left alone."""
    d = desired.select(*keys, F.struct(*values).alias("_d"), F.lit(True).alias("_in"))
    e = existing.select(*keys, F.struct(*values).alias("_e"), F.lit(True).alias("_had"), F.col(owner).alias("_owner"), F.col(anchor).alias("_anchor"))
    action = (
        F.when(F.col("_had").isNull(), "insert")
        .when(~F.col("_owner").eqNullSafe(F.lit(ours)), "owned_elsewhere")
        .when(F.col("_in").isNull(), F.when(F.col("_anchor").isNull(), "left_alone").otherwise("delete"))
        .when(F.col("_d").eqNullSafe(F.col("_e")), "keep")
        .otherwise("update")
    )
    return d.join(e, keys, "full_outer").select(*keys, action.alias("action"))


def emit_links(links: DataFrame, existing: DataFrame, known: DataFrame, external: str, target: str, order: list[str]) -> DataFrame:
    """external, target: one new link per external id, the first in ``order`` wins; ids that are
    linked already and targets that nobody knows are skipped; nulls link nothing."""
    fresh = links.filter(F.col(external).isNotNull()).join(known.select(target).distinct(), target, "left_semi").join(existing.select(external).distinct(), external, "left_anti")
    return fresh.groupBy(external).agg(F.min(F.struct(*order, target)).alias("_f")).select(external, F.col(f"_f.{target}").alias(target))


def extent(years: DataFrame, year: str, empties: int, step: int = 2) -> DataFrame:
    """year, reached: walking back from the last year, whether a year is reached before
    ``empties`` empty steps in a row end the walk.  A row per year of the calendar."""
    own = years.filter(F.col(year).isNotNull()).select(year).distinct()
    gap = F.col(year) - F.lag(year).over(W.orderBy(year)) > step * empties
    last = own.withColumn("_g", gap).agg(F.max(F.when(F.col("_g"), F.col(year))).alias("_from"))
    return own.join(F.broadcast(last), F.lit(True)).select(year, (F.col("_from").isNull() | (F.col(year) >= F.col("_from"))).alias("reached"))


def guarded(changes: DataFrame, scope: DataFrame, most_fraction: float, floor: int) -> DataFrame:
    """The changes, or none of them: an empty scope changes nothing, and more than ``floor``
    changes that are more than ``most_fraction`` of the scope abort.  The guard is one
    row of two counts, attached by a broadcast of that row."""
    counts = changes.agg(F.count("*").alias("_c")).join(scope.agg(F.count("*").alias("_s")), F.lit(True))
    ok = (F.col("_s") > 0) & ~((F.col("_c") > floor) & (F.col("_c") > F.col("_s") * most_fraction))
    return changes.join(F.broadcast(counts.filter(ok).select(F.lit(True).alias("_ok"))), F.lit(True)).drop("_ok")


def spans_of(observations: DataFrame, keys: list[str], year: str, step: int = 2) -> DataFrame:
    """Gaps and islands: keys, first, last of runs of ``year`` in steps of ``step``; repeats
    count once, null years not at all."""
    distinct = observations.filter(F.col(year).isNotNull()).select(*keys, F.col(year).alias("_y")).distinct()
    island = F.col("_y") - step * F.row_number().over(W.partitionBy(*keys).orderBy("_y"))
    runs = distinct.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min("_y").alias("first"), F.max("_y").alias("last"))
    return runs.drop("_i")


def similar_pairs(sets: DataFrame, key: str, items: str, floor: float, most: int = 1000) -> DataFrame:
    """a, b, similarity: all pairs of keys (a < b) whose item sets have a Jaccard overlap of
    ``floor`` or more.  ``sets`` has one row per key; items are distinct; empty and null sets
    have no pairs.

    Sets that reach the floor share one of the rarest ``n - ceil(floor * n) + 1`` items of
    each, so only these are joined; an item of over ``most`` sets is salted.  A pair
    is rated where its rarest shared item meets, hence once."""
    each = sets.select(F.col(key).alias("_id"), F.explode(items).alias("_k"))
    often = each.groupBy("_k").agg(F.count("*").alias("_n"))
    ordered = each.join(often, "_k").groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("_n", "_k"))).alias("_w"))
    size = F.size("_w")
    prefix = F.slice("_w", F.lit(1), (size - F.ceil(size * floor - 1e-9) + 1).cast("int"))
    keyed = ordered.select("_id", F.transform("_w", lambda x: x["_k"]).alias("_w"), F.explode(prefix).alias("_p"))
    keyed = keyed.select("_id", "_w", F.col("_p._k").alias("_k"), F.ceil(F.col("_p._n") / most).cast("int").alias("_s"))
    a = keyed.select(F.col("_id").alias("a"), F.col("_w").alias("_a"), "_k", F.pmod(F.xxhash64("_id"), F.col("_s")).cast("int").alias("_s"))
    b = keyed.select(F.col("_id").alias("b"), F.col("_w").alias("_b"), "_k", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("_s"))
    shared = F.array_intersect("_a", "_b")
    pairs = a.join(b, ["_k", "_s"]).filter("a < b").withColumn("_i", shared).filter(F.col("_i")[0] == F.col("_k"))
    overlap = F.size("_i") / (F.size("_a") + F.size("_b") - F.size("_i"))
    return pairs.filter(overlap >= floor).select("a", "b", F.round(overlap, 6).alias("similarity"))
