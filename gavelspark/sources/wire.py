"""Archived wire bodies to rows: XML, JSON arrays and CSV, parsed inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names of the wire records.
MEMBER = "Id int, Name string, LongName string, Agency string, Acronym string, Party string, District string, Phone string, Email string, FirstName string, LastName string"
COMMITTEE = "Id int, Name string, LongName string, Agency string, Acronym string, Phone string"
MEETING = f"AgendaId int, Agency string, Committees struct<Committee: array<struct<{COMMITTEE.replace(' ', ': ').replace(',: ', ', ')}>>>"


def _struct(fields: str) -> str:
    return "struct<" + ", ".join(":".join(f.split(" ", 1)) for f in fields.split(", ")) + ">"


def xml_rows(archive: DataFrame, body: str, element: str, fields: str, empty_faults: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``element`` of every body, with the archive's other columns and ``ord``.

    A body that is a fault whose text holds one of ``empty_faults`` is an empty set; any
    other fault raises; a body without elements, a null or an empty one gives no rows.
    """
    keep = [c for c in archive.columns if c != body]
    fault = F.coalesce(F.regexp_extract(body, r"(?s)<faultstring[^>]*>(.*?)</faultstring>", 1), F.lit(""))
    known = F.lit(False)
    for text in empty_faults:
        known = known | fault.contains(text)
    checked = F.when(fault == "", F.col(body)).when(known, F.lit(None)).otherwise(F.raise_error(F.concat(F.lit("fault: "), fault)).cast("string"))
    flat = archive.select(*keep, checked.alias("_x")).filter("length(_x) > 0")
    parsed = F.from_xml("_x", F.lit(f"{element} array<{_struct(fields)}>"), {"rowTag": "root"})
    return flat.withColumn("_p", parsed).select(*keep, F.posexplode(F.col(f"_p.{element}")).alias("ord", "_r")).select(*keep, "ord", "_r.*")


def meeting_rows(archive: DataFrame, body: str) -> DataFrame:
    """One row per meeting and committee named in it; a meeting without one keeps a row."""
    keep = [c for c in archive.columns if c != body]
    kind = f"CommitteeMeeting array<struct<AgendaId:int, Agency:string, Committees:struct<Committee:array<{_struct(COMMITTEE)}>>>>"
    meetings = archive.withColumn("_p", F.from_xml(body, F.lit(kind), {"rowTag": "root"})).select(*keep, F.explode("_p.CommitteeMeeting").alias("m"))
    return meetings.select(*keep, "m.AgendaId", "m.Agency", F.explode_outer("m.Committees.Committee").alias("r")).select(*keep, "AgendaId", F.col("Agency").alias("meeting_agency"), F.col("r.Id").alias("committee_id"), F.col("r.LongName").alias("committee"))


def json_array_rows(archive: DataFrame, body: str, fields: str) -> DataFrame:
    """Rows of a top-level JSON array; an empty array and a null give none, any other body raises."""
    keep = [c for c in archive.columns if c != body]
    array = F.when(F.col(body).isNull() | F.trim(body).startswith("["), F.col(body)).otherwise(F.raise_error(F.lit("body is not a JSON array")).cast("string"))
    return archive.withColumn("_p", F.from_json(array, f"array<{_struct(fields)}>")).select(*keep, F.posexplode("_p").alias("ord", "_r")).select(*keep, "ord", "_r.*")


def csv_rows(archive: DataFrame, body: str, columns: list[str]) -> DataFrame:
    """Rows of CSV bodies with a header line; a byte-order mark is dropped, all columns are
    text, blank lines are no rows.  Quoted line breaks are not supported."""
    keep = [c for c in archive.columns if c != body]
    lines = F.filter(F.split(F.regexp_replace(body, "^﻿", ""), r"\r?\n"), lambda x: F.trim(x) != "")
    rows = archive.select(*keep, F.posexplode(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).alias("ord", "_l"))
    return rows.withColumn("_r", F.from_csv("_l", ", ".join(f"`{c}` string" for c in columns))).select(*keep, "ord", "_r.*")


def legislative_href(html: Column) -> Column:
    """The link to the legislative results CSV in an index page; null without one."""
    return F.nullif(F.regexp_extract(html, r"""(?i)href\s*=\s*["']([^"']*legislative[^"']*\.csv)["']""", 1), F.lit(""))


def required_href(html: Column, page: Column) -> Column:
    """The link of :func:`legislative_href`; a page without one is an error."""
    href = legislative_href(html)
    return F.when(href.isNotNull(), href).otherwise(F.raise_error(F.concat(F.lit("results link not found: "), page)).cast("string"))


def json_params(office: str, year: int, limit: int = 5000) -> dict[str, str]:
    """Predicates pushed to a remote JSON service."""
    return {"office": office, "election_year": str(year), "$where": "general_election_status = 'Won in general'", "$limit": str(limit)}


def page_words(pages: DataFrame, key: str, text: str) -> DataFrame:
    """key, line, x, word: words of a page's text with the line number and the offset as
    geometry (no PDF reader is at hand, so the engine begins at words)."""
    lines = pages.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), r"\r\n|\r|\n")).alias("line", "_l"))
    return lines.select(key, "line", F.posexplode(F.split("_l", " ")).alias("x", "word")).filter("word <> ''")


def resource_id(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def resource_parts(value: Column, parts: int) -> Column:
    """At most ``parts`` parts; the last keeps its colons."""
    return F.split(value, ":", parts)
