"""Matching records of three sources that share no key, with calibrated confidences (problem 4).

1. Blocking inside one assembly, across attributes: MinHash buckets of the grams of
   every word of a name, joined by the lossless gram prefixes of
   :mod:`gavelspark.llm.wordjoin` for words that no band catches; and MinHash buckets
   of a record's other attributes (district, party, years, initials).
2. Features of a pair: the odds that both names are one member's (from the costs of
   reading each as any entry of the directory);
   likeness and initials of names that the directory does not know; agreement of
   district, party and year.
3. A logistic classifier, trained on weak labels of a bounded sample of pairs.  The
   labels come from the names as written (the same full name twice, full names that
   contradict each other, random pairs), the features from the directory and the other
   attributes.  Each training pair also stands as the directory's ignorance would show
   it, so that the weights of unknown names are learnt, too.  Platt scaling on held-out
   pairs calibrates it; it is applied as a Spark expression.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelspark.llm import names as N
from gavelspark.llm.linkage import MOST_COST, PARSED, directory, member_readings, parsed
from gavelspark.llm.wordjoin import similar_words
from gavelspark.session import stored

#: MinHash: bands of two rows each, of a word and of a record's other attributes.
BANDS, PROFILE_BANDS = 8, 6
#: The classifier sees at most about so many weakly labelled pairs, and so many records for random pairs.
TRAIN_PAIRS, TRAIN_RECORDS = 20_000, 10_000
#: Costs to weights: a reading dearer by this much is e times less likely; and the
#: weight of being nobody in the directory.
SCALE, NOBODY = 0.25, math.exp(-2.8 / 0.25)
#: Readings less likely than this are not kept; a record has at most 1 / LEAST_CHANCE
#: others, and the chance of one member is never off by more than LEAST_CHANCE.
LEAST_CHANCE = 1e-4
#: Records that read as one member with this chance each are a candidate pair.
LIKELY = 0.05

FEATURES = ["same_odds", "known", "unread_likeness", "unread_initials", "district_same", "district_differs", "party_same", "party_differs", "years"]
#: What a certain match and a certain mismatch look like; always among the training pairs,
#: as prior, so that the fit is defined for any table and behaves alike at every size.
KNOWN = [([4.6, 1, 0, 0, 1, 0, 1, 0, 0], 1), ([4.6, 1, 0, 0, 0, 0, 0, 0, 0.3], 1), ([0, 0, 1, 1, 1, 0, 1, 0, 0], 1), ([-4.6, 1, 0, 0, 0, 1, 0, 1, 0.5], 0), ([-4.6, 1, 0, 0, 1, 0, 0, 0, 0.1], 0), ([0, 0, 0, 0, 1, 0, 1, 0, 0], 0)]


def assembly_code(value: Column) -> Column:
    """Two letters and a number however typed: ' qm/8', 'QM000008' give QM-000008; else null."""
    letters, number = F.regexp_extract(value, r"^\s*([A-Za-z]{2})\W*0*(\d+)\s*$", 1), F.regexp_extract(value, r"^\s*([A-Za-z]{2})\W*0*(\d+)\s*$", 2)
    return F.when(F.length(letters) > 0, F.concat(F.upper(letters), F.lit("-"), F.lpad(number, 6, "0")))


def party_code(value: Column) -> Column:
    """First letter of a party however typed; GOP is Republican; null stays null."""
    text = F.lower(F.trim(value))
    return F.when(text.startswith("gop"), "r").when(F.length(text) > 0, F.substring(text, 1, 1))


@F.pandas_udf(PARSED)
def parsed_keys(keys: pd.Series) -> pd.DataFrame:
    """A set of name keys, read like a typed name (:func:`gavelspark.llm.linkage.parsed`)."""
    read = [N.parse_keys(k) for k in keys]
    return pd.DataFrame({"form": [N.encoded(x) for x in read], "words": [x.tokens for x in read], "runs": [N.runs(x) for x in read]})


parsed_keys = parsed_keys.asNondeterministic()


def records(candidates: DataFrame, proposals: DataFrame, positions: DataFrame) -> DataFrame:
    """record_id, kind, assembly, name (the parsed name), district, party, year.

    Repeats once; records without an id, an assembly or a name are left out, as they
    can match nothing.
    """
    c = F.col
    rows = [
        candidates.select("record_id", F.lit("c").alias("kind"), assembly_code(c("assembly")).alias("assembly"), parsed(c("display_name")).alias("name"), c("district_hint").cast("int").alias("district"), party_code(c("party_label")).alias("party"), c("last_seat_year").cast("int").alias("year")),
        proposals.select("record_id", F.lit("e").alias("kind"), assembly_code(c("assembly")).alias("assembly"), parsed(c("member_name")).alias("name"), c("district").cast("int").alias("district"), F.lit(None).cast("string").alias("party"), c("session_year").cast("int").alias("year")),
        positions.select("record_id", F.lit("h").alias("kind"), assembly_code(c("assembly")).alias("assembly"), parsed_keys(F.array_sort(c("name_keys"))).alias("name"), c("ld").cast("int").alias("district"), party_code(c("party_slug")).alias("party"), c("election_year").cast("int").alias("year")),
    ]
    return reduce(DataFrame.unionByName, rows).filter("record_id is not null and assembly is not null and name.form <> ''").dropDuplicates(["record_id"]).select("record_id", "kind", "assembly", "name.form", "name.words", "name.runs", F.split("name.form", "\x1f")[2].alias("suffix"), "district", "party", "year")


_A = np.random.default_rng(11).integers(1, 2**31 - 1, 2 * BANDS, dtype=np.uint64) | np.uint64(1)
_B = np.random.default_rng(13).integers(0, 2**31 - 1, 2 * BANDS, dtype=np.uint64)
_PRIME = np.uint64(2**31 - 1)


def word_buckets(words: list[str]) -> np.ndarray:
    """MinHash buckets of the padded two-letter grams of each word (a row), one per band."""
    padded = [f"^{w}$" for w in words]
    letters = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(p) for p in padded])
    grams = letters[:-1] * np.uint64(131071) + letters[1:]
    own = np.ones(len(grams), bool)
    own[np.cumsum(sizes)[:-1] - 1] = False  # a gram of two words' ends
    first = np.cumsum(sizes - 1) - (sizes - 1)
    least = np.minimum.reduceat(((grams[own] % _PRIME)[:, None] * _A + _B) % _PRIME, first, axis=0).astype(np.int64)
    return np.arange(BANDS) << 56 | (least[:, ::2] * 1000003 + least[:, 1::2]) & (2**56 - 1)


@F.pandas_udf(T.ArrayType(T.StringType()))
def buckets(word: pd.Series) -> pd.Series:
    """MinHash buckets as join keys."""
    if word.empty:
        return pd.Series([], dtype="object")
    return pd.Series([[f"#{b}" for b in row] for row in word_buckets(list(word)).tolist()])


def alike_words(forms: DataFrame) -> DataFrame:
    """assembly, word, other: pairs of words of an assembly's names that are alike, equal ones
    included.  Candidates share a MinHash bucket or a rare gram; an exact look decides."""
    words = stored(forms.select(F.col("assembly").alias("scope"), F.explode("words").alias("word")).filter("length(word) > 1").distinct().withColumn("more", buckets("word")))
    # Each pair in both directions from one join; as two parts of a union the join would be made twice.
    ways = F.explode(F.array(F.struct("word", "other"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"))))
    both = similar_words(words).select("scope", ways.alias("w")).select("scope", "w.word", "w.other")
    each = words.select("scope", "word", F.col("word").alias("other")).unionByName(both)
    return each.withColumnRenamed("scope", "assembly")


def profile_buckets() -> Column:
    """MinHash buckets of district, party, six-year period and the initials of the long words."""
    shingles = F.array_compact(
        F.concat(
            F.array(F.concat(F.lit("d"), F.col("district").cast("string")), F.concat(F.lit("p"), F.col("party")), F.concat(F.lit("y"), F.floor(F.col("year") / 6).cast("string"))),
            F.transform(F.filter("words", lambda w: F.length(w) > 2), lambda w: F.concat(F.lit("i"), F.substring(w, 1, 1))),
        )
    )
    row = lambda k: F.array_min(F.transform(shingles, lambda x: F.xxhash64(F.lit(k), x)))
    return F.when(F.size(shingles) >= 3, F.array(*[F.xxhash64(F.lit(b), row(3 * b), row(3 * b + 1), row(3 * b + 2)) for b in range(PROFILE_BANDS)]))


def candidate_pairs(rows: DataFrame, read: DataFrame) -> DataFrame:
    """record_id_a < record_id_b of different kinds and one assembly that share a block: the rarest
    word of one of the names, the other attributes, or a likely reading as one member."""
    # The steps are tables: as one plan they fill the driver, which plans all of it anew after every stage.
    forms = stored(rows.select("assembly", "form", "words").dropDuplicates(["assembly", "form"]))
    held = forms.select("assembly", "form", F.explode(F.array_distinct("words")).alias("word"))
    # Names that the directory does not know need a partner for every word of the shorter one, so for
    # its rarest, too: a given name that many share makes no block by itself.
    often = held.filter("length(word) > 1").groupBy("assembly", "word").agg(F.count("*").alias("n"))
    rarest = held.join(often, ["assembly", "word"]).groupBy("assembly", "form").agg(F.min(F.struct("n", "word")).alias("w")).select("assembly", "form", F.col("w.word").alias("word"))
    near = stored(rarest.join(stored(alike_words(forms)), ["assembly", "word"]).select("assembly", "form", "other").distinct())
    others = held.select("assembly", F.col("form").alias("form_b"), F.col("word").alias("other"))
    met = stored(near.hint("merge").join(others, ["assembly", "other"]).select("assembly", F.least("form", "form_b").alias("form"), F.greatest("form", "form_b").alias("form_b")).distinct())
    one = rows.select("assembly", "form", F.col("record_id").alias("r"), F.col("kind").alias("kr"))
    two = rows.select("assembly", F.col("form").alias("form_b"), F.col("record_id").alias("s"), F.col("kind").alias("ks"))
    named = met.join(one, ["assembly", "form"]).join(two, ["assembly", "form_b"]).filter("kr <> ks and (form <> form_b or r < s)").select(F.least("r", "s").alias("record_id_a"), F.greatest("r", "s").alias("record_id_b"))
    profiled = rows.select("assembly", F.explode(profile_buckets()).alias("bucket"), "record_id", "kind")
    p, q = profiled.toDF("assembly", "bucket", "record_id_a", "ka"), profiled.toDF("assembly", "bucket", "record_id_b", "kb")
    alike = p.join(q, ["assembly", "bucket"]).filter("record_id_a < record_id_b and ka <> kb").select("record_id_a", "record_id_b")
    likely = rows.join(read, ["assembly", "form"]).select("assembly", "record_id", "kind", F.explode("member").alias("person", "chance")).filter(f"chance >= {LIKELY}").drop("chance")
    p, q = likely.toDF("assembly", "record_id_a", "ka", "person"), likely.toDF("assembly", "record_id_b", "kb", "person")
    bridged = p.join(q, ["assembly", "person"]).filter("record_id_a < record_id_b and ka <> kb").select("record_id_a", "record_id_b")
    return named.unionByName(alike).unionByName(bridged).distinct()


def readings(rows: DataFrame, persons: DataFrame) -> DataFrame:
    """assembly, form, member: the chance of being each entry of the directory, as a map of
    person to chance; the chances of a form sum to less than 1."""
    people = directory(persons).join(persons.select(F.col("id").alias("person_id"), assembly_code(F.split("source_id", ":")[0]).alias("scope")).filter("scope is not null").distinct(), "person_id").drop("source")
    forms = stored(rows.select(F.col("assembly").alias("scope"), "form", "words", "runs").dropDuplicates(["scope", "form"]))
    cost = stored(member_readings(forms, stored(people), MOST_COST + 0.6))
    weighed = cost.withColumn("w", F.exp(-F.col("cost") / SCALE))
    chance = weighed.withColumn("chance", F.col("w") / (F.sum("w").over(W.partitionBy("scope", "form")) + NOBODY))
    kept = chance.filter(F.col("chance") >= LEAST_CHANCE)
    return kept.groupBy(F.col("scope").alias("assembly"), "form").agg(F.map_from_entries(F.collect_list(F.struct("person_id", "chance"))).alias("member"))


def name_likeness() -> Column:
    """Likeness of two names that the directory does not know.  Both need two words of two letters
    or more (a surname and initials prove nothing by themselves), and each of the shorter
    name's must have a partner in the other; a partner off by a slip or two counts 0.6."""
    slip = "levenshtein(w, o, if(least(length(w), length(o)) < 6, 1, 2)) >= 0"
    return F.expr(f"""
      case when size(u) < 2 or exists(u, w -> not exists(v, o -> o = w or {slip})) then 0.0D else
        aggregate(u, 0.0D, (s, w) -> s + if(array_contains(v, w), 1.0, 0.6) * length(w)) / aggregate(u, 0.0D, (s, w) -> s + length(w)) end
    """)


def pair_features(pairs: DataFrame, rows: DataFrame, read: DataFrame) -> DataFrame:
    """record_id_a, record_id_b, the names' words, and :data:`FEATURES`."""
    side = rows.join(read, ["assembly", "form"], "left").select("record_id", "words", "suffix", "district", "party", "year", "member")
    left = side.select([F.col(c).alias(f"{c}_a") for c in side.columns])
    right = side.select([F.col(c).alias(f"{c}_b") for c in side.columns])
    both = pairs.join(left, "record_id_a").join(right, "record_id_b")
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    long = lambda c: F.filter(c, lambda w: F.length(w) > 1)
    known = lambda c: F.coalesce(F.aggregate(F.map_values(c), F.lit(0.0), lambda s, x: s + x), F.lit(0.0))
    swapped = F.size(long("words_a")) > F.size(long("words_b"))
    ready = (
        both.withColumn("u", F.when(swapped, long("words_b")).otherwise(long("words_a")))
        .withColumn("v", F.when(swapped, long("words_a")).otherwise(long("words_b")))
        .withColumn("same_member", F.coalesce(F.expr("aggregate(map_entries(member_a), 0.0D, (s, e) -> s + e.value * coalesce(member_b[e.key], 0.0D))"), F.lit(0.0)))
    )
    both_known = F.greatest(known("member_a") * known("member_b"), F.lit(1e-9))
    initials = lambda c: F.array_distinct(F.transform(c, lambda w: F.substring(w, 1, 1)))
    return ready.select(
        "record_id_a",
        "record_id_b",
        "words_a",
        "words_b",
        (F.col("suffix_a") == F.col("suffix_b")).alias("same_suffix"),
        name_likeness().alias("likeness"),
        flag(F.size(F.array_except(initials("words_a"), initials("words_b"))) * F.size(F.array_except(initials("words_b"), initials("words_a"))) == 0).alias("initials"),
        # Odds of one member, as far as the directory knows both; 0 (no evidence) where it does not.
        (both_known * F.log((F.col("same_member") + 0.01 * both_known) / (1.01 * both_known - F.col("same_member")))).alias("same_odds"),
        both_known.alias("known"),
        F.when((known("member_a") == 0) | (known("member_b") == 0), name_likeness()).otherwise(0.0).alias("unread_likeness"),
        flag(F.col("district_a") == F.col("district_b")).alias("district_same"),
        flag(F.col("district_a") != F.col("district_b")).alias("district_differs"),
        flag(F.col("party_a") == F.col("party_b")).alias("party_same"),
        flag(F.col("party_a") != F.col("party_b")).alias("party_differs"),
        F.least(F.coalesce(F.abs(F.col("year_a") - F.col("year_b")) / 40, F.lit(0.0)), F.lit(2.0)).alias("years"),
    ).withColumn("unread_initials", F.when(F.col("unread_likeness") > 0, F.col("initials")).otherwise(0.0))


def weak_label() -> Column:
    """Votes on the names as written: 1 for the same full name, of two long words or more; 0 for
    two full names of which only one word agrees, and for names without an agreeing word; null
    (abstains) for everything else, as initials, slips and short forms."""
    full = lambda c: F.array_distinct(F.filter(c, lambda w: F.length(w) > 2))
    a, b = full("words_a"), full("words_b")
    shared = F.size(F.array_intersect(a, b))
    plain = (F.size(a) >= 2) & (F.size(b) >= 2) & ~F.exists("words_a", lambda w: F.length(w) <= 2) & ~F.exists("words_b", lambda w: F.length(w) <= 2)
    apart = ~F.exists("words_a", lambda w: F.exists("words_b", lambda o: (F.substring(w, 1, 1) == F.substring(o, 1, 1)) | (F.levenshtein(w, o) < 3)))
    contradict = plain & (shared == 1) & ~F.exists(F.array_except(a, b), lambda w: F.exists(F.array_except(b, a), lambda o: (F.substring(w, 1, 2) == F.substring(o, 1, 2)) | (F.levenshtein(w, o) < 4)))
    same = plain & (shared == F.size(a)) & (shared == F.size(b))
    # The same name with another suffix is a relative's, or lacks it: no vote.
    return F.when(same & F.col("same_suffix"), 1).when(contradict | apart, 0)


def random_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of neighbours in a random order of at most TRAIN_RECORDS records; the sample is
    uniform and so bounded that one task may sort an assembly of it."""
    sample = rows.select("record_id", "kind", "assembly", F.xxhash64("record_id").alias("o")).orderBy("o").limit(TRAIN_RECORDS)
    order = W.partitionBy("assembly").orderBy("o")
    after = sample.select("record_id", "kind", *[F.struct(F.lead("record_id", k).over(order).alias("id"), F.lead("kind", k).over(order).alias("k")).alias(f"n{k}") for k in (1, 2)])
    near = after.select("record_id", "kind", F.explode(F.array("n1", "n2")).alias("next"))
    return near.filter("next.id is not null and next.k <> kind").select(F.least("record_id", "next.id").alias("record_id_a"), F.greatest("record_id", "next.id").alias("record_id_b"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weights and bias by Newton steps with a ridge, so separable labels are no harm."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge * len(x) * np.eye(len(w)) * 0.01 + 1e-9 * np.eye(len(w)), z.T @ (p - y) + ridge * len(x) * 0.01 * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(features: DataFrame, chance: DataFrame) -> tuple[list[float], float, float]:
    """Weights (with bias) and Platt's slope and offset from a bounded sample of candidate
    pairs (``features``) and of random ones (``chance``).  A third is held out for Platt."""
    order = F.xxhash64("record_id_a", "record_id_b")
    # A minimum of hashes is a uniform sample.
    # It is drawn into a table, as what is drawn from each partition would meet in the driver.
    drawn = lambda df, v, most: stored(df.withColumn("y", weak_label()).filter(F.col("y") == v).select(*FEATURES, "likeness", "initials", "y", order.alias("o")).orderBy("o").limit(most)).toPandas()
    yes = drawn(features, 1, TRAIN_PAIRS // 2)
    # As many mismatches as matches, or the fit would lean to the more frequent label; half of
    # them are random pairs, which any assembly has.
    some = max(1, len(yes) // 2)
    sample = pd.concat([yes, drawn(features, 0, some), drawn(chance, 0, some)])
    sample = pd.concat([sample, sample.assign(same_odds=0.0, known=0.0, unread_likeness=sample.likeness, unread_initials=sample.initials)])
    known, labels = np.array([k for k, _ in KNOWN], float), np.array([v for _, v in KNOWN], float)
    held = (sample.o % 3 == 0).to_numpy(bool)
    x, y = sample[FEATURES].to_numpy(float), sample.y.to_numpy(float)
    join = lambda part: (np.vstack([x[part], known]), np.concatenate([y[part], labels]))
    w = fit_logistic(*join(~held))
    x, y = join(held)
    score = np.hstack([x, np.ones((len(x), 1))]) @ w
    smooth = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    slope, offset = fit_logistic(score[:, None], smooth, ridge=1e-3)
    return [float(v) for v in w], float(slope), float(offset)


def matched_records(candidates: DataFrame, proposals: DataFrame, positions: DataFrame, persons: DataFrame) -> DataFrame:
    """record_id_a, record_id_b, confidence: pairs of two sources that are more likely than
    not one member of one assembly.  Empty tables give no pairs."""
    rows = stored(records(candidates, proposals, positions))
    read = stored(readings(rows, persons))
    features = stored(pair_features(stored(candidate_pairs(rows, read)), rows, read))
    w, slope, offset = train(features, stored(pair_features(random_pairs(rows), rows, read)))
    score = reduce(lambda a, b: a + b, [F.col(f) * v for f, v in zip(FEATURES, w)]) + F.lit(w[-1])
    confidence = 1 / (1 + F.exp(-(score * slope + offset)))
    return features.select("record_id_a", "record_id_b", confidence.alias("confidence")).filter("confidence > 0.5")
