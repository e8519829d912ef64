"""Linking the spellings of one member or committee (problem 3).

The records of the join are the spellings of a source and the entries of its
directory (persons), as further evidence.  A prefix-filtered set-similarity join on
the padded grams of their words (:mod:`gavelspark.llm.wordjoin`) finds the candidates
without losing an alike word; a soft comparison of the words, in which rare words
weigh more, verifies them.  Only distinct names are compared, inside one source.

* A spelling that can be read as entries of the directory belongs to the cheapest
  reading if the next one is clearly dearer, so ambiguous ones stay alone.
* Spellings that read as no entry, of committees and of people outside the directory,
  are joined with each other: committees by topic words, abbreviations and initials,
  people by their words.  Every one points to its best-established likeness; pointer
  jumping finds the roots.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelspark.llm import names as N
from gavelspark.llm.wordjoin import similar_words, with_keys, gram_table
from gavelspark.operators.history import newest
from gavelspark.session import checkpoint

#: A reading may cost so much, and the next one must cost so much more.
MOST_COST, MARGIN = 2.6, 0.25
#: Least likeness of two committees, or of two people outside the directory.
LIKENESS = 0.6

MENTIONS = (("bill_sponsorships", "sponsor_name_raw"), ("senate_winners", "ballot_name"), ("deferred_annotations", "member_name"))


def mentions(tables: dict[str, DataFrame]) -> DataFrame:
    """source, mention_id, text of every mention that is neither null nor blank; repeats once."""
    rows = [df.select("source", "mention_id", F.col(dict(MENTIONS)[name]).alias("text")) for name, df in tables.items()]
    union = reduce(DataFrame.unionByName, rows)
    return union.filter("source is not null and mention_id is not null and length(trim(coalesce(text, ''))) > 0").dropDuplicates(["source", "mention_id"])


#: A parsed name: its form (equal for names that read alike), words, possible surnames.
PARSED = T.StructType([T.StructField("form", T.StringType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("runs", T.ArrayType(T.StringType()))])


@F.pandas_udf(PARSED)
def parsed(text: pd.Series) -> pd.DataFrame:
    """A typed name, parsed."""
    read = [N.parse(t) for t in text]
    return pd.DataFrame({"form": [N.encoded(x) for x in read], "words": [x.tokens for x in read], "runs": [N.runs(x) for x in read]})


# Else a filter on its result is moved below and parses everything twice.
parsed = parsed.asNondeterministic()


@F.pandas_udf(T.ArrayType(T.StringType()))
def surname_words(last: pd.Series) -> pd.Series:
    """The whole surname and, of a surname of several words, its longest word."""

    def of(t: str | None) -> list[str]:
        p = N.person(None, None, t, None, None)
        return [w for w in dict.fromkeys((p.last, max(p.last_words, key=len, default=""))) if w]

    return last.map(of)


@F.pandas_udf(T.DoubleType())
def reading_cost(form: pd.Series, weights: pd.Series, first: pd.Series, middle: pd.Series, last: pd.Series, suffix: pd.Series, used: pd.Series) -> pd.Series:
    """Cost of reading a form as a member; null where it cannot be."""
    return pd.Series([N.reading_cost(N.decoded(t), N.person(a, b, c, d, e), w) for t, w, a, b, c, d, e in zip(form, weights, *(s.where(s.notna(), None) for s in (first, middle, last, suffix, used)))], dtype="float64")


# Else the optimizer evaluates it once for a filter on it and once more for its value.
reading_cost = reading_cost.asNondeterministic()


def rarity(forms: DataFrame) -> DataFrame:
    """scope, form, weights: a weight per word, 1 for one that a single form of the scope has,
    down to 0.5 for one that all have.  Names are short, so are the lists."""
    each = forms.select("scope", "form", F.posexplode("words").alias("at", "word"))
    often = each.select("scope", "form", "word").distinct().groupBy("scope", "word").agg(F.count("*").alias("often"))
    of_all = forms.groupBy("scope").agg(F.count("*").alias("all"))
    weight = 0.5 + 0.5 * F.log((F.col("all") + 1) / F.col("often")) / F.log(F.col("all") + 1)
    listed = each.join(often, ["scope", "word"]).join(of_all, "scope").groupBy("scope", "form").agg(F.array_sort(F.collect_list(F.struct("at", weight.alias("w")))).alias("l"))
    return listed.select("scope", "form", F.col("l.w").alias("weights"))


def directory(persons: DataFrame) -> DataFrame:
    """The newest version of every member: source, person_id and the parts of the name."""
    held = newest(persons.select("id", "updated_at", "source", "name_first", "name_middle", "name_last", "name_suffix", "name_used"), ["id"], "updated_at")
    return held.filter("source is not null and name_last is not null").select("source", F.col("id").alias("person_id"), "name_first", "name_middle", "name_last", "name_suffix", "name_used")


def member_readings(forms: DataFrame, people: DataFrame, most: float = MOST_COST) -> DataFrame:
    """scope, form, person_id, cost: every reading of a form as an entry of its scope's directory.

    ``forms``: scope, form, words, runs (distinct).  ``people``: scope, person_id and the
    parts of the name.  A reading needs a word alike the surname, so the join of words
    loses none.
    """
    run = forms.select("scope", "form", F.explode("runs").alias("word"))
    named = people.select("scope", "person_id", F.explode(surname_words("name_last")).alias("other"))
    alike = similar_words(run.select("scope", "word").distinct(), named.select("scope", F.col("other").alias("word")).distinct())
    # A form has several runs, which no estimate knows of: never a broadcast.
    found = run.hint("merge").join(alike.select("scope", "word", "other"), ["scope", "word"]).join(named, ["scope", "other"]).select("scope", "form", "person_id").distinct()
    weighed = found.join(rarity(forms), ["scope", "form"], "left").join(people, ["scope", "person_id"])
    return weighed.withColumn("cost", reading_cost("form", "weights", "name_first", "name_middle", "name_last", "name_suffix", "name_used")).filter(F.col("cost") <= most).select("scope", "form", "person_id", "cost")


def sure_readings(readings: DataFrame) -> DataFrame:
    """The cheapest reading of each form if it is cheaper than the next by MARGIN."""
    order = W.partitionBy("scope", "form").orderBy("cost", "person_id")
    ranked = readings.withColumn("next", F.lead("cost").over(order)).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.expr(f"rank = 1 and (next is null or next - cost >= {MARGIN})")).select("scope", "form", "person_id", "cost")


@F.pandas_udf(T.ArrayType(T.StringType()))
def topic_words(text: pd.Series) -> pd.Series:
    """Sorted topic words of what may be a committee's name; none where nobody is named."""

    def of(t: str | None) -> list[str]:
        words = N.committee_words(t)
        if not words or any(w in N.NOBODY for w in words) or N.NOBODY_TEXT.search(t or ""):
            return []
        return ["".join(words)] if len(words) > 1 and all(len(w) == 1 for w in words) else list(words)

    return text.map(of)


@F.pandas_udf(T.ArrayType(T.StringType()))
def topic_keys(words: pd.Series) -> pd.Series:
    """What two spellings of one committee share: a vowel-less word, four first letters, the
    initials, or the grams of a name of one word."""

    def of(ws) -> list[str]:
        ws = list(ws)
        # Only names of as many words can be alike, so the number is part of a key.
        keys = {f"{len(ws)}~{N.bare(w)}" for w in ws} | {f"{len(ws)}^{w[:4]}" for w in ws}
        if len(ws) > 1:
            keys.add("#" + "".join(sorted(w[0] for w in ws)))
        elif len(ws[0]) <= 9:
            keys.add("#" + "".join(sorted(ws[0])))
        return sorted(keys | (N.grams(ws) if len(ws) == 1 else set()))

    return words.map(of)


@F.pandas_udf(T.DoubleType())
def soft_likeness(a: pd.Series, b: pd.Series, weights: pd.Series, name: pd.Series, other: pd.Series) -> pd.Series:
    """Soft weighted likeness of two lists of topic words, or of two people's names (null if
    they are no people's), whichever is greater."""
    out = []
    for x, y, w, m, o in zip(a, b, weights, name, other):
        known = dict(w) if w is not None else {}
        alike = N.committee_likeness(tuple(x), tuple(y), lambda t: known.get(t, 1.0))
        entry = N.as_person(N.decoded(o)) if m and o else None
        cost = N.reading_cost(N.decoded(m), entry) if entry else None
        out.append(max(alike, 0.0 if cost is None else 1 - cost / 4))
    return pd.Series(out, dtype="float64")


soft_likeness = soft_likeness.asNondeterministic()


def unread_classes(spellings: DataFrame) -> DataFrame:
    """source, text, class of the spellings of committees, and of people outside the directory."""
    worded = spellings.withColumn("words", topic_words("text")).filter("size(words) > 0").withColumn("form", F.concat_ws(" ", "words"))
    # Of the names that fold to the same topic words the least text stands for all.
    forms = worded.groupBy("source", "form").agg(F.first("words").alias("words"), F.sum("n").alias("n"), F.min(F.when(~F.lower("text").rlike(N.BODY), F.col("text"))).alias("name"))
    often = forms.select(F.explode(F.array_distinct("words")).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("often"))
    rated = (
        forms.select("source", "form", "words", "n", "name", F.explode("words").alias("word"))
        .join(often, "word")
        .groupBy("source", "form")
        .agg(F.first("words").alias("words"), F.first("n").alias("n"), F.first("name").alias("name"), F.min("often").alias("least"), F.map_from_entries(F.collect_set(F.struct("word", (1 / F.log(F.col("often") + 2)).alias("w")))).alias("weights"))
    )
    # A form is better established the more often its rarest word occurs in all forms.
    rated = checkpoint(rated.withColumn("standing", F.struct("least", "n", "form")).withColumn("name", parsed("name")["form"]))
    person = rated.filter("name <> ''").select(F.col("source").alias("scope"), F.explode("words").alias("word"), "form", "standing").filter("length(word) > 2")
    alike_keys = with_keys(person, gram_table(person)).select(F.col("scope").alias("source"), F.concat(F.lit("p"), "key").alias("key"), "form", "standing")
    keyed = rated.select("source", F.explode(topic_keys("words")).alias("key"), "form", "standing").unionByName(alike_keys)
    better = keyed.select("source", "key", F.col("form").alias("other"), F.col("standing").alias("other_standing"))
    pairs = keyed.join(better, ["source", "key"]).filter("other_standing > standing").select("source", "form", "other").distinct()
    left = rated.select("source", "form", "words", "weights", "name")
    right = rated.select("source", F.col("form").alias("other"), F.col("words").alias("other_words"), F.col("standing").alias("other_standing"), F.col("name").alias("other_name"))
    liked = pairs.join(left, ["source", "form"]).join(right, ["source", "other"]).withColumn("likeness", soft_likeness("words", "other_words", "weights", "name", "other_name")).filter(F.col("likeness") >= LIKENESS)
    best = liked.groupBy("source", "form").agg(F.max(F.struct("likeness", "other_standing", "other")).alias("p")).select("source", "form", F.col("p.other").alias("root"))
    links = rated.select("source", "form").join(best, ["source", "form"], "left").select("source", "form", F.coalesce("root", "form").alias("root"))
    return worded.select("source", "text", "form").join(roots(links), ["source", "form"]).select("source", "text", F.col("root").alias("class"))


def roots(links: DataFrame, most: int = 40) -> DataFrame:
    """Pointer jumping: replaces ``root`` by the root's own root until nothing changes.

    Pointers go to better-established forms only, so there are no circles, and the
    number of rounds is the logarithm of the longest chain.
    """
    links = checkpoint(links)
    for _ in range(most):
        up = links.select("source", F.col("form").alias("root"), F.col("root").alias("above"))
        jumped = checkpoint(links.join(up, ["source", "root"], "left").select("source", "form", F.coalesce("above", "root").alias("root"), (F.coalesce("above", "root") != F.col("root")).alias("moved")))
        moved = jumped.filter("moved").limit(1).count()
        links = jumped.select("source", "form", "root")
        if not moved:
            return links
    raise RuntimeError("pointer jumping did not end")


def mention_classes(tables: dict[str, DataFrame], persons: DataFrame) -> DataFrame:
    """source, mention_id, class: a member or a committee of the source, or a person outside its directory."""
    each = mentions(tables)
    spellings = checkpoint(each.groupBy("source", "text").agg(F.count("*").alias("n")).withColumn("p", parsed("text")))
    forms = spellings.filter("p.form <> ''").select(F.col("source").alias("scope"), "p.form", "p.words", "p.runs").groupBy("scope", "form").agg(F.first("words").alias("words"), F.first("runs").alias("runs"))
    read = checkpoint(member_readings(forms, directory(persons).withColumnRenamed("source", "scope")))
    sure = sure_readings(read).select(F.col("scope").alias("source"), "form", F.concat(F.lit("member:"), "person_id").alias("class"))
    flat = spellings.select("source", "text", "n", "p.form")
    members = flat.join(sure, ["source", "form"]).select("source", "text", "class")
    # An ambiguous spelling is no one's; only what reads as no entry at all is joined with its like.
    any_reading = read.select(F.col("scope").alias("source"), "form").distinct()
    rest = flat.join(any_reading, ["source", "form"], "left_anti")
    classes = members.unionByName(unread_classes(rest.select("source", "text", "n")).withColumn("class", F.concat(F.lit("named:"), "class")))
    return each.join(classes, ["source", "text"]).select("source", "mention_id", "class")


def linked_classes(tables: dict[str, DataFrame], persons: DataFrame) -> DataFrame:
    """source, mention_id, class, links: one row per mention that names someone, with the
    number of other mentions of its class.  Linear in the mentions, however large a class."""
    classed = checkpoint(mention_classes(tables, persons))
    sizes = classed.groupBy("source", "class").agg((F.count("*") - 1).alias("links"))
    return classed.join(sizes, ["source", "class"]).select("source", "mention_id", "class", "links")


def linked_mentions(tables: dict[str, DataFrame], persons: DataFrame) -> DataFrame:
    """mention_id_a < mention_id_b: all mentions of one source that mean the same one.

    The pairs of one class are what is asked for, so this join's output is the result
    itself.  Mentions of nobody, ambiguous ones and lone ones are in no pair.
    """
    classed = mention_classes(tables, persons)
    a = classed.select("source", "class", F.col("mention_id").alias("mention_id_a"))
    b = classed.select("source", "class", F.col("mention_id").alias("mention_id_b"))
    return a.join(b, ["source", "class"]).filter("mention_id_a < mention_id_b").select("mention_id_a", "mention_id_b")
