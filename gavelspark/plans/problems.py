"""Queries p1, p2 and p5: intervals, orphan references, histories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelspark.functions.ids import id_key, present
from gavelspark.operators.history import newest, type_two_merge
from gavelspark.operators.intervals import periods_and_gaps
from gavelspark.operators.orphans import find_orphans
from gavelspark.operators.renames import biennium_label, counted_changes, name_terms, name_updates, name_versions
from gavelspark.session import stored, table


def sittings(sessions: DataFrame) -> DataFrame:
    """Half-open sitting terms of each assembly: organization_id, from, to (null = open)."""
    held = newest(sessions.select("id", "updated_at", "organization_id", "classification", "start_date", "end_date", "is_active"), ["id"], "updated_at")
    active = F.coalesce("is_active", F.lit(False))
    open_end = (F.col("end_date") == F.lit("9999-12-31").cast("date")) | (F.col("end_date").isNull() & active)
    counted = held.filter(
        (F.coalesce("classification", F.lit("")) != "biennium")
        & F.col("start_date").isNotNull()
        & (F.coalesce(F.col("end_date") >= F.col("start_date"), F.lit(True)))
        & (F.col("end_date").isNotNull() | active)
    )
    return counted.select("organization_id", F.col("start_date").alias("from"), F.when(~F.coalesce(open_end, F.lit(False)), F.date_add("end_date", 1)).alias("to"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous periods and gaps of assemblies and of committees' names."""
    named = lambda df, name: df.toDF("entity", "from", "to").withColumn("table_name", F.lit(name))
    terms = named(sittings(table(spark, sf_dir, "legislative_sessions")), "legislative_sessions").unionByName(named(name_terms(table(spark, sf_dir, "rename_transitions")), "rename_transitions"))
    found = periods_and_gaps(terms, "entity", "from", "to", ["table_name"])
    # Days of sittings are inclusive: the last one is one before the half-open end.
    last = F.when(F.col("table_name") == "legislative_sessions", F.date_sub("to_date", 1)).otherwise(F.col("to_date"))
    iso = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    return found.select("table_name", F.col("entity").alias("entity_id"), "kind", iso("from_date").alias("from_date"), iso(last).alias("to_date"))


#: What refers: the table and field that the number ``ref`` of a reference stands for.
REFERRING = [("citations", "entity_id"), ("citations", "fetch_event_id"), ("bill_sponsorships", "person_id"), ("fact_citations", "entity")]


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ref, ref_id, key, made_at: every reference that is neither null nor blank, with its target's
    typed key.  Both references of a citation come from one scan."""
    c = F.col

    def of(df: DataFrame, ref_id, made, *values) -> DataFrame:
        each = F.array(*[F.struct(F.lit(n).cast("tinyint").alias("ref"), kind.alias("kind"), value.alias("value")) for n, kind, value in values])
        rows = df.select(ref_id.cast("string").alias("ref_id"), made.alias("made_at"), F.explode(F.filter(each, lambda x: present(x["value"]))).alias("r"))
        return rows.select("r.ref", "ref_id", id_key(c("r.kind"), c("r.value")).alias("key"), "made_at")

    entity = F.split(c("entity"), ":", 2)
    facts = table(spark, sf_dir, "fact_citations").filter(present(c("entity")))
    return (
        of(table(spark, sf_dir, "citations"), c("id"), c("asserted_at"), (0, type_code(c("entity_type")), c("entity_id")), (1, F.lit("f"), c("fetch_event_id")))
        .unionByName(of(table(spark, sf_dir, "bill_sponsorships"), c("id"), c("created_at"), (2, F.lit("p"), c("person_id"))))
        .unionByName(facts.select(F.lit(3).cast("tinyint").alias("ref"), c("fact_id").cast("string").alias("ref_id"), id_key(type_code(F.trim(entity[0])), F.get(entity, F.lit(1))).alias("key"), c("emitted_at").alias("made_at")))
    )


def type_code(kind):
    """One letter per entity type; an unknown or null type matches no parent."""
    known = {"person": "p", "legislative_session": "l", "bill_sponsorship": "b", "jurisdiction": "j"}
    code = F.lit("?")
    for name, letter in known.items():
        code = F.when(kind == name, letter).otherwise(code)
    return code


def parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, born, dead: typed keys of all records that can be referred to, newest versions."""
    rows = []
    for name, code, born in (("persons", "p", "created_at"), ("legislative_sessions", "l", "created_at"), ("bill_sponsorships", "b", "created_at"), ("jurisdictions", "j", "created_at"), ("fetch_events", "f", "fetched_at")):
        df = table(spark, sf_dir, name)
        version = F.col("updated_at") if "updated_at" in df.columns else F.col(born)
        gone = F.col("deleted_at").isNotNull() if name == "persons" else F.lit(False)
        rows.append(df.filter("id is not null").select(id_key(F.lit(code), F.col("id")).alias("key"), version.alias("version"), F.col(born).alias("born"), gone.alias("dead")))
    held = reduce(DataFrame.unionByName, rows).groupBy("key").agg(F.max(F.struct("version", "born", "dead")).alias("v"))
    return held.select("key", F.col("v.born").alias("born"), F.col("v.dead").alias("dead"))


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ref_table, ref_field, ref_id, made_at, reason."""
    found = find_orphans(references(spark, sf_dir), parents(spark, sf_dir))
    name = lambda k: F.array(*[F.lit(r[k]) for r in REFERRING])[F.col("ref").cast("int")]
    return found.select(name(0).alias("ref_table"), name(1).alias("ref_field"), "ref_id", "made_at", "reason")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per referring record and field whose reference resolves to nothing valid."""
    return orphans(spark, sf_dir).select("ref_table", "ref_field", "ref_id").distinct()


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references per table, field, month and reason."""
    once = orphans(spark, sf_dir).groupBy("ref_table", "ref_field", "ref_id").agg(F.min("reason").alias("reason"), F.min("made_at").alias("made_at"))
    return once.groupBy("ref_table", "ref_field", F.date_format("made_at", "yyyy-MM").alias("month"), "reason").agg(F.count("*").alias("orphans"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per version of a committee's name."""
    text = lambda c: F.coalesce(biennium_label(F.col(c)), F.lit("")).alias(c)
    return name_versions(table(spark, sf_dir, "rename_transitions")).select("source_id", text("valid_from"), text("valid_to"))


def p5_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions with their names."""
    text = lambda c: F.coalesce(biennium_label(F.col(c)), F.lit("")).alias(c)
    return name_versions(table(spark, sf_dir, "rename_transitions")).select("source_id", "name", text("valid_from"), text("valid_to"))


#: The boundary between the two snapshots of :func:`p5_snapshots`.
SNAPSHOT = 2001


def p5_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions, built from two snapshots: the changes before SNAPSHOT make a stored
    dimension, into which the later ones are merged."""
    renames = table(spark, sf_dir, "rename_transitions")
    updates = name_updates(counted_changes(renames)).select("source_id", "name_key", "name", "at")
    first = updates.filter(F.col("at.start_year") < SNAPSHOT)
    dimension = stored(type_two_merge(None, first, ["source_id"], ["name_key"], "at", carried=["name"]))
    merged = type_two_merge(dimension, updates.filter(F.col("at.start_year") >= SNAPSHOT), ["source_id"], ["name_key"], "at", carried=["name"])
    text = lambda c: F.coalesce(biennium_label(F.when(F.col(f"{c}.step") == 1, F.col(f"{c}.start_year"))), F.lit("")).alias(c)
    return merged.select("source_id", "name", text("valid_from"), text("valid_to"))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_report": p2_report, "p5_found": p5_found, "p5_versions": p5_versions, "p5_snapshots": p5_snapshots}


# Reference SQL (DuckDB).  Sessions and changes are as in TESTDATA.md; islands by running maximum.
_ISLANDS = """
  marked as (select *, case when f > max(t) over (partition by e order by f, t rows between unbounded preceding and 1 preceding) then 1 else 0 end as fresh from {rows} where f < t),
  numbered as (select *, sum(fresh) over (partition by e order by f, t rows unbounded preceding) as island from marked),
  periods as (select e, min(f) as f, max(t) as t from numbered group by e, island),
  both_kinds as (
    select e, 'period' as kind, f, t from periods
    union all
    select e, 'gap', t, nf from (select e, t, lead(f) over (partition by e order by f) as nf from periods) where nf is not null)
"""

_COUNTED = """
  typed as (select *, cast(regexp_extract(boundary_biennium, '(\\d{4})', 1) as integer) as y from rename_transitions),
  held as (select * from typed qualify row_number() over (partition by source_id, y order by recorded_at desc, former_name desc, legal_name desc) = 1),
  folded as (select *,
    regexp_replace(strip_accents(lower(replace(former_name, '&', 'and'))), '[^a-z0-9]', '', 'g') as fk,
    regexp_replace(strip_accents(lower(replace(legal_name, '&', 'and'))), '[^a-z0-9]', '', 'g') as lk from held),
  counted as (select * from folded where fk <> lk)
"""

_P1 = f"""
with newest_session as (
    select * from legislative_sessions qualify row_number() over (partition by id order by updated_at desc) = 1),
  s as (
    select organization_id as e, start_date as f,
      case when end_date is null or end_date = date '9999-12-31' then date '9999-12-31' else end_date + interval 1 day end::date as t
    from newest_session
    where classification <> 'biennium' and start_date is not null and (end_date is null or end_date >= start_date) and (end_date is not null or is_active)),
  {_ISLANDS.format(rows='s')}
select 'legislative_sessions' as table_name, e as entity_id, kind, strftime(f, '%Y-%m-%d') as from_date,
  case when t = date '9999-12-31' then '' else strftime((t - interval 1 day)::date, '%Y-%m-%d') end as to_date
from both_kinds
union all
select * from (with {_COUNTED},
  chain as (select source_id as e, effective_start as s, coalesce(former_effective_end, effective_start) as u,
      lead(coalesce(former_effective_end, effective_start)) over w as nu, row_number() over w as n from counted
    window w as (partition by source_id order by effective_start, y)),
  r as (select e, s as f, coalesce(nu, date '9999-12-31') as t from chain
    union all select e, date '0001-01-01', u from chain where n = 1),
  {_ISLANDS.format(rows='r')}
  select 'rename_transitions' as table_name, e as entity_id, kind,
    case when f = date '0001-01-01' then '' else strftime(f, '%Y-%m-%d') end as from_date,
    case when t = date '9999-12-31' then '' else strftime(t, '%Y-%m-%d') end as to_date
  from both_kinds)
"""

_BASE32 = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
# 26 base32 characters of a UUID's 32 digits: five bits at a time over 130 bits.
_TO32 = (
    "list_aggregate(list_transform(range(0, 26), lambda k: substr('" + _BASE32 + "', 1 + cast(('0b' || substr(bits, 1 + 5 * k, 5))::bit::integer as integer), 1)), 'string_agg', '')"
)
_CANON = """
  case when regexp_full_match(upper(trim(v, e' \\t\\n\\r')), '[0-7][0-9A-HJKMNP-TV-Z]{25}') then upper(trim(v, e' \\t\\n\\r'))
       when regexp_full_match(upper(trim(v, e' \\t\\n\\r')), '[0-9A-F]{8}-?[0-9A-F]{4}-?[0-9A-F]{4}-?[0-9A-F]{4}-?[0-9A-F]{12}') then '#' || replace(upper(trim(v, e' \\t\\n\\r')), '-', '') end
"""
# Both printings meet as the 32 hexadecimal digits.
_HEXED = (
    "case when c[1] = '#' then substr(c, 2) else list_aggregate(list_transform(range(0, 32), lambda k: "
    "format('{:X}', list_sum(list_transform(range(0, 4), lambda j: "
    "case when 4 * k + j + 2 >= 0 then (((strpos('" + _BASE32 + "', substr(c, cast((4 * k + j + 2) // 5 + 1 as integer), 1)) - 1) >> cast(4 - (4 * k + j + 2) % 5 as integer)) & 1) << cast(3 - j as integer) else 0 end)))), 'string_agg', '') end"
)

_P2 = f"""
with refs as (
    select 'citations' as ref_table, 'entity_id' as ref_field, id as ref_id, entity_type as kind, entity_id as v, asserted_at as made from citations
    union all select 'citations', 'fetch_event_id', id, 'fetch_event', fetch_event_id, asserted_at from citations
    union all select 'bill_sponsorships', 'person_id', id, 'person', person_id, created_at from bill_sponsorships
    union all select 'fact_citations', 'entity', cast(fact_id as varchar), split_part(entity, ':', 1), substr(entity, strpos(entity, ':') + 1), emitted_at from fact_citations where entity is not null),
  real_refs as (select distinct * from refs where trim(coalesce(v, ''), e' \\t\\n\\r') <> ''),
  canon as (select *, {_CANON} as c from real_refs),
  keyed as (select *, {_HEXED} as k from canon),
  born as (
    select 'person' as kind, id as v, created_at as born, deleted_at is not null as dead from (select * from persons qualify row_number() over (partition by id order by updated_at desc) = 1)
    union all select 'legislative_session', id, created_at, false from (select * from legislative_sessions qualify row_number() over (partition by id order by updated_at desc) = 1)
    union all select distinct 'bill_sponsorship', id, created_at, false from bill_sponsorships
    union all select distinct 'jurisdiction', id, created_at, false from jurisdictions
    union all select distinct 'fetch_event', id, fetched_at, false from fetch_events),
  parent as (select kind, born, dead, {_HEXED} as k from (select *, v as c from born))
select distinct ref_table, ref_field, ref_id from keyed left join parent on keyed.kind = parent.kind and keyed.k = parent.k
where parent.k is null or parent.dead or parent.born > keyed.made
"""

_P2_REPORT = _P2.replace(
    "select distinct ref_table, ref_field, ref_id from keyed",
    "select ref_table, ref_field, strftime(made, '%Y-%m') as month, case when parent.k is null then 'missing' when parent.dead then 'deleted' else 'later' end as reason, count(distinct ref_id) as orphans from keyed",
) + "group by 1, 2, 3, 4"

_P5 = f"""
with {_COUNTED},
  chain as (select source_id, y, fk, lk, lag(lk) over w as before, lead(fk) over w as nf, lead(y) over w as ny, row_number() over w as n
    from counted window w as (partition by source_id order by y)),
  label as (select y, cast(y as varchar) || '-' || lpad(cast((y + 1) % 100 as varchar), 2, '0') as text from (select distinct y from typed))
select c.source_id, l.text as valid_from, case when c.nf = c.lk then n.text else '' end as valid_to
from chain c join label l on c.y = l.y left join label n on c.ny = n.y
union all
select c.source_id, '', l.text from chain c join label l on c.y = l.y where c.n = 1 or c.before <> c.fk
union all
select distinct source_id, '', '' from rename_transitions where source_id not in (select source_id from counted)
"""

_P5_NAMED = f"""
with {_COUNTED},
  chain as (select source_id, y, fk, lk, former_name, legal_name, lag(lk) over w as before, lead(fk) over w as nf, lead(y) over w as ny, row_number() over w as n
    from counted window w as (partition by source_id order by y)),
  label as (select y, cast(y as varchar) || '-' || lpad(cast((y + 1) % 100 as varchar), 2, '0') as text from (select distinct y from typed))
select c.source_id, c.legal_name as name, l.text as valid_from, case when c.nf = c.lk then n.text else '' end as valid_to
from chain c join label l on c.y = l.y left join label n on c.ny = n.y
union all
select c.source_id, c.former_name, '', l.text from chain c join label l on c.y = l.y where c.n = 1 or c.before <> c.fk
"""
_P5_STILL = """
union all
select source_id, arg_max(legal_name, (recorded_at, legal_name)), '', '' from rename_transitions where source_id not in (select source_id from counted) group by 1
"""

ORACLE = {"p1_found": _P1, "p2_found": _P2, "p2_report": _P2_REPORT, "p5_found": _P5, "p5_versions": _P5_NAMED + _P5_STILL, "p5_snapshots": _P5_NAMED}
