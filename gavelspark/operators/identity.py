"""Who a record is about: identities of listings from before a registry, and winners without one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gavelspark.session import stored


def resolve_identities(records: DataFrame, seatings: DataFrame, floor: int, splits: DataFrame, adjudications: DataFrame, gap: int = 20, term: int = 4) -> DataFrame:
    """scope, fold, id, year, disposition {minted, joined, refused}, identity, reason: each record
    from before ``floor`` once.

    ``records``: scope, fold (the folded name), id, year, seat.  ``seatings``: scope, fold,
    seat, year, member, from ``floor`` on.  ``splits``: scope, fold, boundary, adjudicated as two
    people.  ``adjudications``: scope, fold, member (null: decided to be nobody seated).

    In this order: a split fold gives two minted identities; listings more than ``gap`` years
    apart are refused (wide_gap); a fold with listings after the floor is joined to the
    adjudicated member, or to the only member seated where and when it is listed, else
    refused (ambiguous, unresolved); a fold without any is probed at the floor with the
    listings whose term reaches it: the only member seated there is joined, several are
    refused, none is a new identity.  Records without a fold or a year are left out.
    """
    key = ["scope", "fold"]
    known = records.filter("fold is not null and fold <> '' and year is not null").select(*key, "id", "year", "seat")
    pre = known.filter(F.col("year") < floor)
    post = known.filter(F.col("year") >= floor).select(*key, "seat", "year")
    reaching = pre.filter(F.col("year") > floor - term).select(*key, "seat", F.lit(floor).alias("year"))
    # The years of a fold are few (the calendar bounds them), whatever the number of its records.
    years = pre.groupBy(*key).agg(F.array_sort(F.collect_set("year")).alias("ys"))
    widest = F.array_max(F.zip_with("ys", F.slice("ys", 2, F.size("ys")), lambda a, b: b - a))
    groups = years.select(*key, F.coalesce(widest > gap, F.lit(False)).alias("wide"), F.array_min("ys").alias("first"))

    def seated(rows: DataFrame, name: str) -> DataFrame:
        hit = rows.distinct().join(seatings.select(*key, "seat", "year", "member").distinct(), [*key, "seat", "year"], "left")
        return hit.groupBy(*key).agg(F.count_distinct("member").alias(f"{name}_n"), F.min("member").alias(f"{name}_member"), F.lit(True).alias(f"{name}_any"))

    told = (
        groups.join(splits.select(*key, "boundary"), key, "left")
        .join(adjudications.select(*key, F.col("member").alias("decided"), F.lit(True).alias("is_decided")), key, "left")
        .join(seated(post, "post"), key, "left")
        .join(seated(reaching, "probe"), key, "left")
    )
    split, crossing, c = F.col("boundary").isNotNull(), F.col("post_any").isNotNull(), F.col
    member = (
        F.when(split | c("wide"), None)
        .when(crossing & c("is_decided").isNotNull(), c("decided"))
        .when(crossing & (c("post_n") == 1), c("post_member"))
        .when(~crossing & (c("probe_n") == 1), c("probe_member"))
    )
    reason = (
        F.when(split, None)
        .when(c("wide"), "wide_gap")
        .when(crossing & c("is_decided").isNull() & (c("post_n") != 1), F.when(c("post_n") > 1, "ambiguous").otherwise("unresolved"))
        .when(~crossing & (c("probe_n") > 1), "ambiguous")
    )
    verdicts = told.select(*key, "boundary", "first", member.alias("member"), reason.alias("reason"))
    each = pre.join(verdicts, key)
    # A split fold is two people; the later one's identity begins with the first listing after it.
    part = F.when(c("boundary").isNotNull() & (c("year") >= c("boundary")), 1).otherwise(0)
    begun = F.min("year").over(W.partitionBy(*key, "part"))
    minted = each.withColumn("part", part).withColumn("begun", F.when(c("boundary").isNotNull(), begun).otherwise(c("first")))
    disposition = F.when(c("reason").isNotNull(), "refused").when(c("member").isNotNull(), "joined").otherwise("minted")
    identity = F.when(c("reason").isNotNull(), None).otherwise(F.coalesce("member", F.concat_ws(":", "fold", F.col("begun").cast("string"))))
    return minted.select(*key, "id", "year", disposition.alias("disposition"), identity.alias("identity"), "reason")


def project_winners(winners: DataFrame, roster: DataFrame, senators: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Winners of a cohort against the roster that they were elected to.

    ``winners``: cohort, seat, id, keys, qualifier (may be null).  ``roster`` and ``senators``:
    cohort, seat, member, surname.

    The first frame has each winner's outcome: direct (the only member of the seat with a
    surname among the keys), matched (the same without a qualifier), duplicate (the member
    is another winner's already), mover (none here, but one senator of the seat),
    unresolved, and without a qualifier ambiguous or unmatched.  The second has the
    members seated: direct ones, and, where one winner of a seat is left, has moved and had a
    qualifier, and one member of it is left, that member, ``inferred``.
    """
    place = ["cohort", "seat"]
    each = winners.dropDuplicates(["cohort", "id"])
    # One member is where the least and the greatest are equal, so a name is one row, with no count of distinct ones.
    here, there = F.when(F.col("_here"), F.col("member")), F.when(~F.col("_here"), F.col("member"))
    listed = roster.select(*place, "surname", "member", F.lit(True).alias("_here")).unionByName(senators.select(*place, "surname", "member", F.lit(False).alias("_here")))
    named = listed.groupBy(*place, "surname").agg(F.min(here).alias("here"), F.max(here).alias("here_z"), F.min(there).alias("there"), F.max(there).alias("there_z"))
    worded = each.select(*place, "id", "qualifier", F.explode_outer("keys").alias("surname"))
    rated = worded.join(named, [*place, "surname"], "left").groupBy(*place, "id", "qualifier").agg(F.min("here").alias("here"), F.max("here_z").alias("here_z"), F.min("there").alias("there"), F.max("there_z").alias("there_z"))
    rated = rated.withColumn("direct", F.when(F.col("here") == F.col("here_z"), F.col("here")))
    # Of winners that match one member the first by id has it.
    order = F.row_number().over(W.partitionBy("cohort", "direct").orderBy("id"))
    outcome = (
        F.when(F.col("direct").isNotNull() & (order > 1), "duplicate")
        .when(F.col("direct").isNotNull(), F.when(F.col("qualifier").isNull(), "matched").otherwise("direct"))
        .when(F.col("there") == F.col("there_z"), "mover")
        .when(F.col("qualifier").isNotNull(), "unresolved")
        .when(F.col("here") < F.col("here_z"), "ambiguous")
        .otherwise("unmatched")
    )
    # Three parts of the result read it; as a table it is worked out once, not thrice in one plan.
    told = stored(rated.select(*place, "id", "qualifier", "direct", outcome.alias("outcome")))
    seen = told.filter("outcome in ('direct', 'matched')").select("cohort", F.col("direct").alias("member"))
    left = roster.select(*place, "member").distinct().join(seen, ["cohort", "member"], "left_anti").groupBy(*place).agg(F.count("*").alias("members"), F.min("member").alias("member"))
    deferred = told.filter("direct is null").groupBy(*place).agg(F.count("*").alias("winners"), F.count_if(F.col("outcome") == "mover").alias("movers"), F.min("qualifier").alias("qualifier"), F.min("id").alias("id"))
    inferred = deferred.join(left, place).filter("winners = 1 and movers = 1 and members = 1 and qualifier is not null")
    seats = told.filter("outcome = 'direct'").select(*place, "id", F.col("direct").alias("member"), "qualifier", F.lit(False).alias("inferred")).unionByName(inferred.select(*place, "id", "member", "qualifier", F.lit(True).alias("inferred")))
    return told.select(*place, "id", "outcome"), seats
