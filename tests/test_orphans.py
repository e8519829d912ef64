import datetime as dt
import uuid

from pyspark.sql import functions as F

from gavelspark.functions.ids import id_hex, id_text, present
from gavelspark.operators.orphans import find_orphans

CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def base32(value):
    return "".join(CROCKFORD[value >> 5 * i & 31] for i in reversed(range(26)))


def test_printings_of_one_id(spark):
    values = [uuid.uuid4() for _ in range(40)] + [uuid.UUID(int=0), uuid.UUID(int=2**128 - 1)]
    rows = []
    for u in values:
        for printing in (base32(u.int), base32(u.int).lower(), str(u), str(u).upper(), u.hex, f"\t{u}\n", f" {base32(u.int)} ", f"{{{u}}}", u.urn):
            rows.append((printing, u.hex.upper(), base32(u.int)))
    df = spark.createDataFrame(rows, "v string, hex string, text string")
    assert df.filter((id_hex(F.col("v")) != F.col("hex")) | id_hex(F.col("v")).isNull() | ~id_text(F.col("v")).eqNullSafe(F.col("text"))).count() == 0


def test_malformed_ids_are_null(spark):
    df = spark.createDataFrame([(v,) for v in (None, "", "  ", "x", "01J" * 9, "8" + "Z" * 25, "0" * 25, "g" * 32, "U" * 26)], "v string")
    got = df.select("v", id_text(F.col("v")).alias("t"), present(F.col("v")).alias("p")).collect()
    assert [r.t for r in got] == [None] * 9
    assert [r.p for r in got] == [False, False, False] + [True] * 6


def frames(spark):
    at = lambda d: dt.datetime(2020, 1, d)
    parents = spark.createDataFrame([("pA", at(5), False), ("pB", at(5), True), ("pC", None, False)], "key string, born timestamp, dead boolean")
    refs = [("t", "f", "1", "pA", at(6)), ("t", "f", "2", "pA", at(4)), ("t", "f", "3", "pB", at(9)), ("t", "f", "4", "pX", at(9)), ("t", "f", "5", None, at(9)), ("t", "f", "6", "pC", at(9)), ("t", "f", "7", "pA", None), ("t", "f", "4", "pX", at(9))]
    return spark.createDataFrame(refs, "ref_table string, ref_field string, ref_id string, key string, made_at timestamp").withColumn("extra", F.lit(1)), parents


def test_reasons_nulls_and_repeats(spark):
    refs, parents = frames(spark)
    got = sorted((r.ref_id, r.reason, r.extra) for r in find_orphans(refs, parents, 3).collect())
    assert got == [("2", "later", 1), ("3", "deleted", 1), ("4", "missing", 1), ("4", "missing", 1), ("5", "missing", 1)]


def test_empty_tables(spark):
    refs, parents = frames(spark)
    assert {r.reason for r in find_orphans(refs, parents.limit(0), 0).collect()} == {"missing"}
    assert find_orphans(refs, parents.limit(0), 0).count() == refs.count()
    assert find_orphans(refs.limit(0), parents, 3).count() == 0


def test_hot_key_and_small_filter_change_nothing(spark):
    """A key with most of the references goes by broadcast; the result is the plain join's."""
    parents = spark.range(2000).select(F.concat(F.lit("p"), "id").alias("key"), F.lit("2020-01-01").cast("timestamp").alias("born"), (F.col("id") % 50 == 0).alias("dead"))
    target = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 3000)
    refs = spark.range(40000).select(F.lit("t").alias("ref_table"), F.lit("f").alias("ref_field"), F.col("id").cast("string").alias("ref_id"), F.concat(F.lit("p"), target).alias("key"), F.lit("2020-01-02").cast("timestamp").alias("made_at"))
    got = {r.ref_id for r in find_orphans(refs, parents, 2000).select("ref_id").collect()}
    plain = refs.join(parents, "key", "left").filter("dead is null or dead").select("ref_id").collect()
    assert got == {r.ref_id for r in plain}
