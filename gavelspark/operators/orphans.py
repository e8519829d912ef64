"""References to records that do not exist, are deleted or came later.

Broadcast Bloom filters of the parent keys prove most orphans at the scan, which is
read once; only references that pass them go on to the exact join.  Heavy keys (a
frequent-items sketch finds them) are joined by a broadcast of at most ``HOT_KEYS``
parents, so a key that holds a third of all references is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelspark.session import stored

#: Bounds of a filter's size in bits: 8 KiB to 8 MiB, the most that Spark's has; and of the
#: number of filters, among which the keys are divided by hash (128 MiB for 10**8 parents).
LEAST_BITS, MOST_BITS, MOST_FILTERS = 2**16, 2**26, 16
#: Bits per parent key; about 1 % of the absent keys pass.
BITS_PER_KEY = 10
#: At most so many heavy keys, of HOT_ROWS references or more, are joined by broadcast (a row
#: each).  A key beyond them has at most one in HOT_KEYS references; adaptive execution
#: splits the partition if that is still much.
HOT_KEYS, HOT_ROWS = 1024, 10_000


def _jvm(df: DataFrame):
    from pyspark.sql.classic.column import Column as Classic

    jvm = df.sparkSession._jvm
    utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
    return jvm.org.apache.spark.sql.catalyst.expressions, lambda c: utils.expression(c._jc), lambda e: Classic(utils.column(e))


def bloom_filters(parents: DataFrame, key: Column, items: int) -> list[Column]:
    """Scalar subqueries of Bloom filters over ``key``, the i-th of the keys whose hash is i
    modulo their number, built by partial aggregation.

    Number and size follow ``items`` within fixed bounds; more keys than that only let
    more references through to the exact join, never a wrong result.
    """
    number = min(MOST_FILTERS, -(-items * BITS_PER_KEY // MOST_BITS) or 1)
    each = -(-items // number)
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << max(1, each * BITS_PER_KEY - 1).bit_length()))
    expressions, of, column = _jvm(parents)
    most = max(1, min(each, 4_000_000))

    def one(rows: DataFrame) -> Column:
        aggregate = expressions.aggregate.BloomFilterAggregate(of(F.xxhash64(key)), of(F.lit(most).cast("long")), of(F.lit(bits).cast("long")), 0, 0)
        return rows.agg(column(aggregate.toAggregateExpression()).alias("bloom")).scalar()

    return [one(parents if number == 1 else parents.filter(F.pmod(F.hash(key), F.lit(number)) == i)) for i in range(number)]


def might_contain(df: DataFrame, blooms: list[Column], key: Column) -> Column:
    """False where the filters prove that ``key`` is absent; a filter of no keys proves all."""
    expressions, of, column = _jvm(df)
    tests = [F.coalesce(column(expressions.BloomFilterMightContain(of(b), of(F.xxhash64(key)))), F.lit(False)) for b in blooms]
    out = tests[-1]
    for i, test in enumerate(tests[:-1]):
        out = F.when(F.pmod(F.hash(key), F.lit(len(tests))) == i, test).otherwise(out)
    return out


def find_orphans(refs: DataFrame, parents: DataFrame, parent_rows: int | None = None) -> DataFrame:
    """References without a living, earlier target.

    ``refs``: key string (null = malformed, so it names nothing), made_at, and other
    columns, which come along.  ``parents``: key string (unique), born timestamp, dead
    boolean.

    Returns the orphan references with ``reason`` missing, deleted or later; a
    repeated reference comes out as often as it came in.  A reference without a time
    is never later; a parent without one never late.  Empty tables: without parents
    every reference is missing.

    References and parents are written once to the shared folder; what the filters
    decide leaves from there without a shuffle.
    """
    held = stored(parents.select("key", "born", "dead"))
    blooms = bloom_filters(held, F.col("key"), held.count() if parent_rows is None else parent_rows)
    absent = F.col("key").isNull() | ~might_contain(refs, blooms, F.col("key"))
    tested = stored(refs.withColumn("absent", absent))
    missing = tested.filter("absent").withColumn("reason", F.lit("missing"))
    found = tested.filter("not absent")
    hot = (
        found.agg(F.expr(f"approx_top_k(key, {HOT_KEYS}, {HOT_KEYS * 16})").alias("top"))
        .select(F.explode("top").alias("t"))
        .filter(f"t.count > {HOT_ROWS}")
        .select(F.col("t.item").alias("key"))
    )
    known = hot.join(held, "key", "left").select("key", F.lit(True).alias("hot"), "born", "dead").collect()  # at most HOT_KEYS rows
    heavy = refs.sparkSession.createDataFrame(known, T.StructType([held.schema["key"], T.StructField("hot", T.BooleanType()), held.schema["born"], held.schema["dead"]]))
    split = found.join(F.broadcast(heavy), "key", "left") if known else found.withColumns({"hot": F.lit(None).cast("boolean"), "born": F.lit(None).cast(held.schema["born"].dataType), "dead": F.lit(None).cast("boolean")})
    decided = split.filter("hot").withColumn("reason", why("dead", "born")).drop("hot", "born", "dead")
    exact = split.filter("hot is null").drop("hot", "born", "dead").join(held, "key", "left").withColumn("reason", why("dead", "born")).drop("born", "dead")
    return missing.unionByName(decided).unionByName(exact).filter("reason is not null").drop("key", "absent")


def why(dead: str, born: str) -> Column:
    """The reason for which a joined reference is an orphan, or null."""
    return F.when(F.col(dead).isNull(), "missing").when(F.col(dead), "deleted").when(F.col(born) > F.col("made_at"), "later")
