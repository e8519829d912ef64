"""Per-document text statistics and a learned rule list that tells prose from lists, tables and junk (problem 8).

All statistics are Spark SQL expressions; the rule list is a CASE expression.  The
rules are induced by incremental reduced-error pruning (:mod:`gavelspark.llm.rules`)
on labelled documents; the exported list is
:mod:`gavelspark.llm.quality_rules`, retrained by
``python -m gavelspark.llm.train_quality``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Function words of English and Spanish, two letters or more, accents folded.
FUNCTION_WORDS = """
the of and to in that is on by with as it was be at from or an this which not are but had has have its they were their
if under no so when after before until since because while though although who whom what would could must shall will only
each every than then there where without into over about more most both between during these those some any one two all
he she his her you your we our us my me them him other others out up down against among through upon per does did do been
being such own same too very just even nor unless whether however later still once nobody everyone nothing for
el la los las que en una por con para se del al lo su sus sin sobre fue es son como hubo hasta segun ante aunque desde
quien porque entre este esta esto ese esa eso pero mas ni ya le les nos de un y
""".split()

_ACCENTED = "áàâäãåāéèêëēíìîïīóòôöõøōúùûüūñçýÿšž"
_PLAIN = "aaaaaaaeeeeeiiiiiooooooouuuuuncyysz"
#: Deleted: soft hyphen, zero-width and direction marks, combining accents.
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2066\u2067\u2068\u2069\ufeff\ufe0f\u0300\u0301\u0302\u0303\u0308"

_SPACES = "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"

#: Shares of function words (per cent) of which a line may have more; a line of many symbols or
#: of many digits has more than so many per cent of them.
LEVELS = (6, 10, 14, 18, 22)
SYMBOLS, DIGITS = 14, 25
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÁÉÍÓÚÜÑÀÂÄÃÅÈÊËÌÎÏÒÔÖÕØÙÛÇÝŠŽ"
STATISTICS = (
    ["n_words", "n_lines", "visible", "mean_word_length", "symbol_ratio", "digit_ratio", "upper_ratio", "punctuated_lines", "common_words", "words_per_line", "single_letters", "symbol_lines", "digit_lines"]
    + [f"prose_{k}" for k in LEVELS]
)


def _in_list() -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(w for w in FUNCTION_WORDS if len(w) > 1)))


def _line_measures() -> dict[str, str]:
    """SQL of what is measured per line ``s.x`` with space-separated words ``s.w``: visible
    characters, words, function words, digits, letters and digits, single
    letters, an ending in punctuation.  In lines of one byte per character, letters
    and digits are counted by what is left without them; that costs less than a pattern."""
    wordly = "a-z0-9\\\\u00aa-\\\\u02ff\\\\u0370-\\\\u1fff\\\\u3040-\\\\ud7ff"
    without = lambda letters: f"length(s.x) - length(translate(s.x, '{letters}', ''))"
    shown = "length(replace(s.x, ' ', ''))"
    return {
        "v": shown,
        "n": "size(s.w)",
        "f": f"size(filter(s.w, w -> w in ({_in_list()})))",
        "d": without("0123456789"),
        "c": f"if(octet_length(s.x) = length(s.x), {without('abcdefghijklmnopqrstuvwxyz0123456789')}, length(regexp_replace(s.x, '[^{wordly}]+', '')))",
        "o": "size(filter(s.w, w -> length(w) = 1))",
        "e": r"cast(rtrim(s.x) rlike '[.!?:;][\")\\x{201D}\\x{2019}\\x{BB}*]*$' as int)",
    }


def text_statistics(documents: DataFrame, key: str = "doc_id", text: str = "text", wanted: list[str] | None = None) -> DataFrame:
    """One row of statistics per row: ``key`` and ``wanted`` (all :data:`STATISTICS`).

    Computed in the JVM from the whole text, without a shuffle.  ``visible`` counts
    characters that are not white space; ``prose_k`` is the share of them in lines of three
    words or more of which at least k % are function words, ``symbol_lines`` and
    ``digit_lines`` that in lines of many symbols or digits.  Words are parted by blanks
    of any kind.  Null, empty and blank texts have ``visible`` 0, counts 0 and null ratios.
    """
    wanted = STATISTICS if wanted is None else wanted
    ratios = {
        "mean_word_length": ("c", "n_words"),
        "symbol_ratio": ("y", "visible"),
        "digit_ratio": ("d", "visible"),
        "upper_ratio": ("up", "visible"),
        "punctuated_lines": ("e", "n_lines"),
        "common_words": ("f", "n_words"),
        "words_per_line": ("n_words", "n_lines"),
        "single_letters": ("o", "n_words"),
        "symbol_lines": ("ys", "visible"),
        "digit_lines": ("ds", "visible"),
    } | {f"prose_{k}": (f"p{k}", "visible") for k in LEVELS}
    used = {"visible", *wanted, *(x for w in wanted if w in ratios for x in ratios[w])}
    value = F.coalesce(F.col(text), F.lit(""))
    low = F.replace(F.lower(value), F.lit("\t"), F.lit(" "))
    # A text of one byte per character has no accents and no invisible characters to fold.
    folded = F.when(F.octet_length(value) == F.length(value), low).otherwise(F.translate(low, _ACCENTED + _SPACES + _INVISIBLE, _PLAIN + " " * len(_SPACES)))
    lines = documents.select(F.col(key).alias("_key"), value.alias("raw"), F.split(folded, "[\n\r\u2028\u2029\u0085\u000b\u000c]+").alias("lines"))
    measures = _line_measures()
    needs = {"v": {"v"}, "f": {"f"}, "c": {"c"}, "d": {"d"}, "e": {"e"}, "o": {"o"}, "n_words": {"n"}, "y": {"v", "c"}, "visible": {"v"}, "ys": {"v", "c"}, "ds": {"v", "d"}} | {f"p{k}": {"v", "n", "f"} for k in LEVELS}
    fields = sorted(set().union({"v"}, *(needs.get(u, set()) for u in used)))
    measured = lines.withColumn(
        "m",
        F.expr(
            "filter(transform(transform(lines, x -> struct(x, array_remove(split(x, ' '), '') as w)), s -> struct("
            + ", ".join(f"{measures[f]} as {f}" for f in fields)
            + ")), s -> s.v > 0)"
        ),
    )
    total = lambda f, name: F.expr(f"aggregate(m, 0L, (a, s) -> a + {f})").alias(name)
    sums = {
        "n_lines": F.size("m").alias("n_lines"),
        "up": (F.length("raw") - F.length(F.translate("raw", _CAPITALS, ""))).alias("up"),
        "visible": total("s.v", "visible"),
        "n_words": total("s.n", "n_words"),
        "y": total("(s.v - s.c)", "y"),
        "ys": total(f"if((s.v - s.c) * 100 > s.v * {SYMBOLS}, s.v, 0)", "ys"),
        "ds": total(f"if(s.d * 100 > s.v * {DIGITS}, s.v, 0)", "ds"),
    }
    sums |= {f: total(f"s.{f}", f) for f in "fdcoe"}
    sums |= {f"p{k}": total(f"if(s.n >= 3 and s.f * 100 >= s.n * {k}, s.v, 0)", f"p{k}") for k in LEVELS}
    # Generated columns stop later filters from being pushed below and evaluating all this again.
    one = F.array(F.struct(*[column for name, column in sums.items() if name in used]))
    summed = measured.select("_key", F.inline(one))
    ratio = lambda a, b, name: F.when(F.col(b) > 0, F.col(a) / F.col(b)).alias(name)
    return summed.select(F.col("_key").alias(key), *[ratio(*ratios[w], w) if w in ratios else w for w in dict.fromkeys(["visible", *wanted])])


def rated_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", wanted: list[str] | None = None) -> DataFrame:
    """The statistics and ``rule``: the number of the first rule of the learned list that
    holds (a document that is mostly a list, a table or junk), 0 for prose, null without
    visible characters.  ``wanted`` limits the statistics to these and the rules' own."""
    from gavelspark.llm.quality_rules import RULES
    from gavelspark.llm.rules import to_case

    needed = sorted({name for rule in RULES for name, _, _ in rule})
    stats = text_statistics(documents, key, text, None if wanted is None else [*wanted, *needed])
    return stats.withColumn("rule", F.when(F.col("visible") > 0, F.expr(to_case(RULES))))
