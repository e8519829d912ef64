"""Prefix-filtered set-similarity join of words on padded two-letter grams.

Two words are alike (:func:`gavelspark.llm.names.word_cost`) if they are equal, have
one scanned shape, or are within k slips: none below three letters, one below six, two
from six on, by the shorter word.  A slip (insertion, deletion, substitution, swap of
neighbours) spoils at most three grams of either word, so with sets A and B of grams
at least max(|A|, |B|) - 3k are shared, and two sets that share that many meet in the
3k + 1 first grams of each under any common order.  The order is by rarity, which
keeps the lists short.  Where a word has too few different grams for the bound
(at most 3k) it also has its variants with up to k letters left out, in which words
within k slips always meet, or, if it is longer than LONG letters, keys of its length,
as alike words differ by two letters at most; scanned shapes meet in a key of their own.  So no alike
pair is lost; ``tests/llm/test_linkage.py`` compares with all pairs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelspark.llm import names as N

#: The characters of folded words; any other counts as one more.  The table of gram
#: frequencies has CODES entries, whatever the data.
LETTERS = "^$0123456789abcdefghijklmnopqrstuvwxyz"
CODES = (len(LETTERS) + 1) ** 2

#: Longer words of few different grams (mere repetitions) meet by their length.
LONG = 16

_K = "case when length(word) < 3 then 0 when length(word) < 6 then 1 else 2 end"
_GRAMS = "array_distinct(transform(sequence(1, length(word) + 1), i -> substr(concat('^', word, '$'), i, 2)))"
_CODE = f"instr('{LETTERS}', left(g, 1)) * {len(LETTERS) + 1} + instr('{LETTERS}', substr(g, 2))"
_SHAPE = "replace(replace(replace(replace(replace(replace(replace({w}, '0', 'o'), '1', 'l'), 'rn', 'm'), 'vv', 'w'), 'i', 'l'), 'c', 'e'), '5', 's')"
_LESS = "transform(sequence(1, length({w})), i -> concat(left({w}, i - 1), substr({w}, i + 1)))"


def shape(word: str) -> str:
    """SQL of the scanned shape of a word column."""
    return _SHAPE.format(w=word)


def gram_table(words: DataFrame) -> Column:
    """Scalar subquery: how often each gram code occurs in ``word``, an array of CODES numbers."""
    codes = words.selectExpr(f"explode(transform({_GRAMS}, g -> {_CODE})) as code").groupBy("code").count()
    packed = codes.agg(F.map_from_entries(F.collect_list(F.struct("code", "count"))).alias("m"))
    return packed.select(F.expr(f"transform(sequence(0, {CODES - 1}), i -> coalesce(int(m[i]), 0))").alias("often")).scalar()


def with_keys(words: DataFrame, often: Column) -> DataFrame:
    """``words`` (scope, word, ...; perhaps an array ``more`` of further keys) with a row per join key ``key``."""
    more = "more" if "more" in words.columns else "array()"
    listed = words.withColumn("_k", F.expr(_K)).withColumn("_g", F.expr(_GRAMS)).withColumn("_often", often)
    ordered = listed.withColumn("_o", F.expr(f"array_sort(transform(_g, g -> struct(_often[{_CODE}] as n, g as g)))"))
    lengths = "array(concat('#', length(word) div 4), concat('#', (length(word) + 2) div 4), concat('#', (length(word) - 2) div 4))"
    fallback = f"if(_k = 0 or size(_g) > 3 * _k, array(), if(length(word) > {LONG}, {lengths}, array_union(array(word), if(_k = 1, {_LESS.format(w='word')}, array_union({_LESS.format(w='word')}, flatten(transform({_LESS.format(w='word')}, v -> {_LESS.format(w='v')})))))))"
    keys = F.expr(f"array_union({more}, array_union(array(concat('=', {shape('word')})), array_union(if(_k = 0, array(), transform(slice(_o, 1, 3 * _k + 1), s -> s.g)), transform({fallback}, v -> concat('-', v)))))")
    return ordered.withColumn("key", F.explode(keys)).drop("_k", "_g", "_o", "_often", "more")


@F.pandas_udf(T.DoubleType())
def exact_cost(a: pd.Series, b: pd.Series) -> pd.Series:
    """Cost of reading one word as another; null where they are not alike."""
    costs = (N.word_cost(x, y) for x, y in zip(a, b))
    return pd.Series([c if c < 9 else None for c in costs], dtype="float64")


# Else the optimizer moves a filter on it below the removal of repeats and evaluates it twice.
exact_cost = exact_cost.asNondeterministic()


def similar_words(left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """scope, word, other, slip: all alike words of ``left`` and ``right`` (scope, word; distinct)
    in one scope; without ``right`` those of ``left`` with each other, each pair once."""
    often = gram_table(left if right is None else right)
    a = with_keys(left, often).select("scope", "key", "word")
    b = (a if right is None else with_keys(right, often)).select("scope", "key", F.col("word").alias("other"))
    # A word has a dozen keys, which no estimate from the words' size knows of: never a broadcast.
    met = a.hint("merge").join(b, ["scope", "key"])
    met = (met.filter("word < other") if right is None else met).select("scope", "word", "other").distinct()
    allowed = "case when least(length(word), length(other)) < 3 then 0 when least(length(word), length(other)) < 6 then 1 else 2 end"
    # A swap is two plain edits, so twice the bound loses nothing; the rest is decided exactly.
    near = met.filter(F.expr(f"word = other or {shape('word')} = {shape('other')} or (abs(length(word) - length(other)) <= 2 and levenshtein(word, other, 2 * ({allowed})) >= 0)"))
    decided = near.withColumn("slip", F.when(F.col("word") == F.col("other"), F.lit(0.0)))
    return decided.withColumn("slip", F.coalesce("slip", exact_cost("word", "other"))).filter("slip is not null")
