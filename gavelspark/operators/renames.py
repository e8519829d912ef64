"""Rename chains of committees: which changes count, name versions, terms of a name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gavelspark.functions.folding import alnum_key
from gavelspark.operators.history import newest, type_two_merge


def biennium_start(label: Column) -> Column:
    """First year of a biennium typed in any way (1999-00, 1999/00, 1999 - 2000);
    null where the text has no four-digit year in front."""
    return F.regexp_extract(label, r"^\D*(\d{4})", 1).try_cast("int")


def biennium_label(start: Column) -> Column:
    """1999 gives 1999-00; null gives null."""
    return F.concat(F.lpad(start.cast("string"), 4, "0"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def counted_changes(renames: DataFrame) -> DataFrame:
    """The name changes that count, one per committee and biennium.

    Of the rows of one committee and biennium the latest recorded one holds (ties:
    the greatest row, so repeats are harmless), and it counts only if its two names
    differ in letters or digits.  A null name is a name of no letters.  Rows without
    a committee or a readable biennium do not count.

    Returns source_id, start_year, former_name, legal_name, former_key, legal_key,
    effective_start, former_effective_end.
    """
    rows = renames.select(
        "source_id",
        biennium_start(F.col("boundary_biennium")).alias("start_year"),
        "recorded_at",
        "former_name",
        "legal_name",
        "effective_start",
        "former_effective_end",
    ).filter("source_id is not null and start_year is not null")
    held = newest(rows, ["source_id", "start_year"], "recorded_at")
    key = lambda name: F.coalesce(alnum_key(F.col(name)), F.lit(""))
    return held.withColumn("former_key", key("former_name")).withColumn("legal_key", key("legal_name")).filter("former_key <> legal_key")


def name_updates(counted: DataFrame) -> DataFrame:
    """source_id, name_key, name, at: of each change the former name (step 0) and the legal one (step 1)."""
    at = lambda step: F.struct(F.col("start_year"), F.lit(step).alias("step")).alias("at")
    former = F.struct(F.col("former_key").alias("name_key"), F.col("former_name").alias("name"), at(0))
    legal = F.struct(F.col("legal_key").alias("name_key"), F.col("legal_name").alias("name"), at(1))
    return counted.select("source_id", F.explode(F.array(former, legal)).alias("u")).select("source_id", "u.*")


def name_versions(renames: DataFrame) -> DataFrame:
    """Every version of every committee's name: source_id, name, valid_from, valid_to
    (start years; null = unknown or open).

    A type-two merge: each change that counts gives two updates at its boundary,
    first the former name (step 0) and then the legal name (step 1).  Where the
    chain is whole, step 0 repeats the current version and changes nothing; where a
    hop was never recorded it closes the current version at an unknown time.  A
    committee without a change that counts has one version without bounds.
    """
    counted = counted_changes(renames)
    updates = name_updates(counted)
    merged = type_two_merge(None, updates, ["source_id"], ["name_key"], "at", carried=["name"])
    year = lambda c: F.when(F.col(f"{c}.step") == 1, F.col(f"{c}.start_year")).alias(c)
    versions = merged.select("source_id", "name", year("valid_from"), year("valid_to"))
    # Committees without any: their latest legal name, unbounded both ways.
    all_of = renames.filter("source_id is not null").groupBy("source_id").agg(F.max(F.struct("recorded_at", "legal_name")).alias("r"))
    still = all_of.join(counted.select("source_id").distinct(), "source_id", "left_anti")
    none = F.lit(None).cast("int")
    return versions.unionByName(still.select("source_id", F.col("r.legal_name").alias("name"), none.alias("valid_from"), none.alias("valid_to")))


def name_terms(renames: DataFrame) -> DataFrame:
    """Half-open terms for which a committee has a name on record: source_id, from, to.

    From one change's effective_start to the next change's former_effective_end
    (null: the next change's own effective_start); the first former name has no
    beginning, the last legal name no end.  A change without effective_start does
    not count here.
    """
    counted = counted_changes(renames).filter("effective_start is not null")
    order = W.partitionBy("source_id").orderBy("effective_start", "start_year")
    until = F.coalesce("former_effective_end", "effective_start")
    chained = counted.select(
        "source_id",
        "effective_start",
        until.alias("until"),
        F.lead(until).over(order).alias("next_until"),
        (F.row_number().over(order) == 1).alias("first"),
        F.lead(F.lit(True)).over(order).alias("more"),
    )
    # The last term is open because no change follows, not because an end is missing.
    none = F.lit(None).cast("date")
    terms = F.array(
        F.when(F.col("first"), F.struct(none.alias("from"), F.col("until").alias("to"))),
        F.struct(F.col("effective_start").alias("from"), F.when(F.col("more"), F.col("next_until")).otherwise(none).alias("to")),
    )
    return chained.select("source_id", F.explode(F.array_compact(terms)).alias("t")).select("source_id", "t.*")
