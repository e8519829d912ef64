"""Registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelspark.llm import leakage, linkage, matching, quality, tokenizer
from gavelspark.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of mentions that mean the same member or committee."""
    tables = {name: table(spark, sf_dir, name) for name, _ in linkage.MENTIONS}
    return linkage.linked_mentions(tables, table(spark, sf_dir, "persons"))


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per mention that names someone: its class and its number of links."""
    tables = {name: table(spark, sf_dir, name) for name, _ in linkage.MENTIONS}
    return linkage.linked_classes(tables, table(spark, sf_dir, "persons"))


def p4_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records of one member, with calibrated confidence."""
    return matching.matched_records(*[table(spark, sf_dir, name) for name in ("candidates", "event_proposals", "house_positions", "persons")])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records from two different sources that describe the same member."""
    return p4_matches(spark, sf_dir).select("record_id_a", "record_id_b")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k, without special tokens."""
    return tokenizer.encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items of which they hold eight consecutive words."""
    return leakage.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks with their extent and the overlap of question and answer."""
    return leakage.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All statistics and the rule that rates each document."""
    return quality.rated_documents(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents most of whose visible characters are not running prose."""
    return quality.rated_documents(table(spark, sf_dir, "documents"), wanted=[]).filter("rule > 0").select("doc_id")


QUERIES = {"p3_found": p3_found, "p3_classes": p3_classes, "p4_found": p4_found, "p4_matches": p4_matches, "p6_ids": p6_ids, "p7_found": p7_found, "p7_report": p7_report, "p8_found": p8_found, "p8_statistics": p8_statistics}

# Reference SQL (DuckDB): leaks by a join of all eight-word stretches, quality by lines.
_INVISIBLE = r"[\x{00AD}\x{034F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{0300}-\x{036F}]"
_MARKUP = "<[/!?a-z][^<>]*>|&([a-z]{2,8}|#[0-9]{1,6});"


def _words(column: str) -> str:
    plain = f"strip_accents(lower(regexp_replace({column}, '{_INVISIBLE}', '', 'g')))"
    bare = f"replace(replace(regexp_replace({plain}, '{_MARKUP}', ' ', 'g'), chr(39), ''), '’', '')"
    return rf"list_filter(regexp_split_to_array({bare}, '[^\pL\pN]+'), lambda w: w <> '')"


_P7 = f"""
with d as (select doc_id, {_words('text')} as w from documents where text is not null),
  i as (select item_id, {_words('passage')} as w from eval_items),
  dk as (select doc_id, array_to_string(w[k.k:k.k + 7], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 6)) as k from d) k),
  ik as (select distinct item_id, array_to_string(w[k.k:k.k + 7], ' ') as s from (select item_id, w, unnest(range(1, len(w) - 6)) as k from i) k)
select distinct doc_id, item_id from dk join ik on dk.s = ik.s
"""


def _quality_sql(columns: str, where: str = "") -> str:
    """p8 by lines: every statistic counted on its own, with patterns and joins in place of array
    functions; the rules are applied as they are exported."""
    from gavelspark.llm.quality_rules import RULES
    from gavelspark.llm.rules import to_case

    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    plain = f"replace(translate(lower(coalesce(text, '')), {quoted(quality._ACCENTED + quality._SPACES + quality._INVISIBLE)}, {quoted(quality._PLAIN + ' ' * len(quality._SPACES))}), chr(9), ' ')"
    prose = ", ".join(f"sum(case when n >= 3 and f * 100 >= n * {k} then v else 0 end) / nullif(sum(v), 0) as prose_{k}" for k in quality.LEVELS)
    breaks = r"[\n\r\x{2028}\x{2029}\x{85}\x{0B}\x{0C}]+"
    letters = r"[^a-z0-9\x{AA}-\x{2FF}\x{370}-\x{1FFF}\x{3040}-\x{D7FF}]+"
    ending = r"[.!?:;][\x{22})\x{201D}\x{2019}\x{BB}* ]{0,5}$"
    return f"""
with l as (select doc_id, unnest(regexp_split_to_array({plain}, '{breaks}')) as x from documents),
  w as (select doc_id, x, length(replace(x, ' ', '')) as v, list_filter(string_split(x, ' '), lambda w: w <> '') as w,
      length(regexp_replace(x, '{letters}', '', 'g')) as c, length(regexp_replace(x, '[^0-9]+', '', 'g')) as d, regexp_matches(rtrim(x), '{ending}') as e from l),
  m as (select *, len(w) as n, len(list_filter(w, lambda t: t in ({quality._in_list()}))) as f, len(list_filter(w, lambda t: length(t) = 1)) as o from w where v > 0),
  t as (select doc_id, sum(v)::bigint as visible, sum(n)::bigint as n_words, count(*)::bigint as n_lines, sum(c) / nullif(sum(n), 0) as mean_word_length, sum(v - c) / sum(v) as symbol_ratio, sum(d) / sum(v) as digit_ratio,
      count(*) filter (e) / count(*) as punctuated_lines, sum(f) / nullif(sum(n), 0) as common_words, sum(n) / count(*) as words_per_line, sum(o) / nullif(sum(n), 0) as single_letters,
      sum(case when (v - c) * 100 > v * {quality.SYMBOLS} then v else 0 end) / sum(v) as symbol_lines, sum(case when d * 100 > v * {quality.DIGITS} then v else 0 end) / sum(v) as digit_lines, {prose} from m group by doc_id),
  s as (select k.doc_id, coalesce(visible, 0) as visible, coalesce(n_words, 0) as n_words, coalesce(n_lines, 0) as n_lines, t.* exclude (doc_id, visible, n_words, n_lines),
      length(regexp_replace(coalesce(k.text, ''), '[^{quality._CAPITALS}]+', '', 'g')) / visible as upper_ratio from documents k left join t on k.doc_id = t.doc_id),
  r as (select *, case when visible > 0 then {to_case(RULES)} end as rule from s)
select {columns} from r {where}
"""


ORACLE: dict[str, str] = {"p7_found": _P7, "p8_found": _quality_sql("doc_id", "where rule > 0"), "p8_statistics": _quality_sql("*")}
