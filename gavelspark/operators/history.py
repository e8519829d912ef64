"""History of changing attributes: a type-two dimension merge.

:func:`type_two_merge` compares the hash of the attributes of each update with
the version current at that time, closes changed versions and inserts new open
ones.  Updates of many periods merge in one pass: the hash of the previous
update (or of the stored open version) stands for the current version, so the
result equals merging snapshot after snapshot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """One row per key, that with the greatest ``by``; ties are broken by the whole
    row, so the choice is the same on every run.  Aggregates map-side."""
    rest = [c for c in df.columns if c not in keys and c != by]
    picked = df.groupBy(*keys).agg(F.max(F.struct(F.col(by), *rest)).alias("_v"))
    return picked.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in [by, *rest]])


def attribute_hash(*columns: Column) -> Column:
    """Hash of attributes in which null differs from every value, the empty text included."""
    return F.sha2(F.to_json(F.array(*[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("0")) for c in columns])), 256)


def type_two_merge(dimension: DataFrame | None, updates: DataFrame, keys: list[str], attributes: list[str], at: str, carried: list[str] | None = None) -> DataFrame:
    """Type-two dimension merge of ``updates`` into ``dimension``.

    ``dimension`` has the keys, the attributes, ``valid_from`` and ``valid_to``
    (null = open), or is None for an empty one.  Updates are rows (keys,
    attributes, ``at``); an update whose attribute hash equals that of the version
    valid at its time changes nothing, any other closes that version at ``at``
    and opens a new one, which is valid up to the next version there is.  So an update
    that comes late cuts the closed version of its time, and one within a hole fills it
    up to the next version.  An update at the very start of a version replaces it.  Of
    several updates of one key and time the greatest row counts; updates with a null time
    or an all-null key do not count.  Keys without an update pass through and take no
    part in the merge.  ``carried`` columns come along with the update that opens a
    version but are not compared.  ``at`` may be of any ordered type, a struct included.
    """
    attributes, hashed_ones = [*attributes, *(carried or [])], attributes
    cols = [*keys, *attributes]
    some_key = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys])
    step = updates.select(*cols, F.col(at).alias("valid_from")).filter(F.col("valid_from").isNotNull() & some_key)
    step = step.groupBy(*keys, "valid_from").agg(F.max(F.struct(*attributes)).alias("_a")).select(*keys, *[F.col(f"_a.{a}").alias(a) for a in attributes], "valid_from")
    step = step.withColumn("_h", attribute_hash(*[F.col(a) for a in hashed_ones])).withColumn("_new", F.lit(1))
    untouched = None
    if dimension is not None:
        touched = step.select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
        old = dimension.select(*cols, "valid_from", "valid_to")
        untouched = old.join(touched, same, "left_anti")
        held = old.join(touched, same, "left_semi")
        starts = held.select(*cols, "valid_from").withColumn("_h", attribute_hash(*[F.col(a) for a in hashed_ones])).withColumn("_new", F.lit(0))
        # The end of a closed version is a point of its own, where nothing is valid.
        ends = held.filter("valid_to is not null").select(*keys, *[F.lit(None).cast(old.schema[a].dataType).alias(a) for a in attributes], F.col("valid_to").alias("valid_from"), F.lit("").alias("_h"), F.lit(-1).alias("_new"))
        points = starts.unionByName(ends).unionByName(step)
        # At one time an update counts before a stored start, and that before an end.
        step = points.groupBy(*keys, "valid_from").agg(F.max(F.struct("_new", *attributes, "_h")).alias("_p")).select(*keys, *[F.col(f"_p.{a}").alias(a) for a in attributes], "valid_from", F.col("_p._h").alias("_h"))
    order = W.partitionBy(*keys).orderBy(F.col("valid_from").asc_nulls_first())
    changed = step.withColumn("_before", F.lag("_h").over(order)).filter(F.coalesce("_before", F.lit("")) != F.col("_h"))
    merged = changed.withColumn("valid_to", F.lead("valid_from").over(order)).filter("_h <> ''").select(*cols, "valid_from", "valid_to")
    return merged if untouched is None else untouched.unionByName(merged)
