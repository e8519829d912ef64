"""Pages, global ranks, budgets and lines: ordered work without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def page_after(df: DataFrame, key: str, cursor, limit: int, descending: bool = False) -> DataFrame:
    """Keyset page: rows after the cursor, one more than ``limit`` to signal that more follow."""
    after = F.col(key) < cursor if descending else F.col(key) > cursor
    return df.filter(after).orderBy(F.col(key).desc() if descending else F.col(key)).limit(limit + 1)


def _running(df: DataFrame, order: list[str], amount, name: str) -> DataFrame:
    """Running total in a global order: totals per key range, then a window inside each range.

    The ranges are those of an approximate-quantile bucket of the first order column's hash
    order, so no task holds more than its range.
    """
    ranged = df.withColumn("_a", amount).repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    # A partition's number is not the same on a second evaluation, so both uses share one evaluation.
    from gavelspark.session import checkpoint

    ranged = checkpoint(ranged)
    before = ranged.groupBy("_p").agg(F.sum("_a").alias("_s"))
    offset = before.withColumn("_o", F.coalesce(F.sum("_s").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_p", "_o")
    own = F.sum("_a").over(W.partitionBy("_p").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return ranged.join(F.broadcast(offset), "_p").withColumn(name, own + F.col("_o")).drop("_p", "_o")


def global_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """1, 2, 3 ... in a total order."""
    return _running(df, order, F.lit(1).cast("bigint"), name).drop("_a")


def byte_budget(df: DataFrame, key: str, size: str, budget: int) -> DataFrame:
    """Rows in key order until their sizes first reach the budget; the crossing row is included."""
    return _running(df, [key], F.col(size).cast("bigint"), "_t").filter(F.col("_t") - F.col("_a") < budget).drop("_t", "_a")


def grouped_lines(words: DataFrame, page: str, top: str, x: str, tolerance: float, text: str | None = None) -> DataFrame:
    """page, line, words and, if asked for, the line's ``text`` (its words from left to right): a
    line begins where a word is lower than the line's first word by more than the
    tolerance.  Streams sorted rows, so a page of any size needs no more memory than a line."""
    kind = words.schema[page].dataType.simpleString()
    columns = [page, "line", "words", *(["text"] if text else [])]

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, first, line, held = None, 0.0, 0, []
        out: list[tuple] = []

        def ended() -> tuple:
            said = [str(w) for _, w in sorted(held, key=lambda h: h[0]) if w is not None]
            return (own, line, len(held), " ".join(said))[: len(columns)]

        for frame in frames:
            for p, y, at, w in zip(frame.iloc[:, 0], frame.iloc[:, 1], frame.iloc[:, 2], frame.iloc[:, -1]):
                if own is None or p != own or y - first > tolerance:
                    if own is not None:
                        out.append(ended())
                    line = line + 1 if p == own else 1
                    own, first, held = p, y, []
                held.append((at, w))
            if out:
                yield pd.DataFrame(out, columns=columns)
                out = []
        if own is not None:
            yield pd.DataFrame([ended()], columns=columns)

    chosen = words.select(F.col(page), F.col(top), F.col(x), F.col(text or x).alias("_text"))
    ordered = chosen.repartition(page).sortWithinPartitions(page, top, x)
    return ordered.mapInPandas(lines, f"`{page}` {kind}, line int, words int" + (", text string" if text else ""))


def paged_scan(df: DataFrame, key: str, size: int) -> DataFrame:
    """page, rows, first, last: a scan of a table in key order in pages of ``size``."""
    ranked = global_rank(df.select(key), [key], "_n")
    page = F.floor((F.col("_n") - 1) / size).alias("page")
    return ranked.groupBy(page).agg(F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
