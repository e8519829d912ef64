"""String, date, array and JSON functions (STR*, DATE*, ARR*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelspark.functions import dates as D
from gavelspark.functions import strings as S
from gavelspark.functions.json import canonical_json
from gavelspark.functions.ids import id_hex, id_text
from gavelspark.functions.folding import unaccent
from gavelspark.plans.registry import Registry

R = Registry()
c, lit = F.col, F.lit


def names(t):
    return t.senate_winners.select("mention_id", "ballot_name", "ld").distinct()


_N = "(select distinct mention_id, ballot_name, ld from senate_winners)"
_FOLD = "regexp_replace(strip_accents(lower({})), '[^a-z0-9]', '', 'g')"
_TOKENS = "list_filter(list_transform(regexp_split_to_array({}, '[\\s(),]+'), lambda w: " + _FOLD.format("w") + "), lambda w: w <> '')"


@R.query("str1_unaccent", "select distinct name_full, strip_accents(name_full) as plain from persons")
def str1(t):
    return t.persons.select("name_full").distinct().select("name_full", unaccent(c("name_full")).alias("plain"))


@R.query("str2_fold_token", f"select distinct name_last, {_FOLD.format('name_last')} as folded from persons")
def str2(t):
    return t.persons.select("name_last").distinct().select("name_last", S.fold_token(c("name_last")).alias("folded"))


@R.query("str3_tokenize", f"select mention_id, array_to_string({_TOKENS.format('ballot_name')}, ' ') as tokens from {_N}")
def str3(t):
    return names(t).select("mention_id", F.array_join(S.folded_tokens(c("ballot_name")), " ").alias("tokens"))


_STRIP = "array_to_string(list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace({}, '\\([^)]*\\)', ' ', 'g'), '[“\"][^”\"]*[”\"]', ' ', 'g')), '\\s+'), lambda w: w <> '' and regexp_replace(lower(w), '[^a-z0-9]', '', 'g') not in ('mr', 'mrs', 'ms', 'dr', 'rev', 'hon')), ' ')"


@R.query("str4_strip_non_name_parts", f"select mention_id, {_STRIP.format('ballot_name')} as bare from {_N}")
def str4(t):
    return names(t).select("mention_id", S.strip_non_name_parts(c("ballot_name")).alias("bare"))


_PROBE = "nullif(list_extract(string_split(regexp_replace(array_to_string({}, ' '), '( ?\\b(jr|sr|ii|iii|iv))+$', ''), ' '), -1), '')"


@R.query("str5_probe_surname", f"select mention_id, {_PROBE.format(_TOKENS.format('bare'))} as surname from (select mention_id, {_STRIP.format('ballot_name')} as bare from {_N})")
def str5(t):
    return names(t).select("mention_id", S.probe_surname(c("ballot_name")).alias("surname"))


@R.query(
    "str6_surname_keys",
    f"""with k as (select mention_id, {_TOKENS.format('ballot_name')} as w from {_N}),
  j as (select mention_id, array_to_string(w[i.range:j.range], '') as key from k, range(1, 30) i, range(1, 30) j where j.range >= i.range and j.range <= len(w))
select mention_id, string_agg(key, ' ' order by key) as keys from (select distinct mention_id, key from j) group by mention_id""",
)
def str6(t):
    return names(t).select("mention_id", F.array_join(S.surname_keys(S.folded_tokens(c("ballot_name"))), " ").alias("keys"))


_NORM = "trim(regexp_replace(replace(strip_accents(lower({})), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


@R.query("str7_normalize_name", f"select distinct former_name, {_NORM.format('former_name')} as name from rename_transitions")
def str7(t):
    return t.rename_transitions.select("former_name").distinct().select("former_name", S.normalize_name(c("former_name")).alias("name"))


@R.query("str8_committee_fold", "select distinct legal_name, trim(regexp_replace(replace(lower(legal_name), '&', 'and'), '\\s+', ' ', 'g')) as name from rename_transitions")
def str8(t):
    return t.rename_transitions.select("legal_name").distinct().select("legal_name", S.fold_committee(c("legal_name")).alias("name"))


_SIG = "list_sort(list_distinct(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda w: w <> '' and w not in (" + ", ".join(f"'{w}'" for w in S.STOPWORDS) + "))))"


@R.query("str9_significant_tokens", f"select distinct legal_name, array_to_string({_SIG.format('legal_name')}, ' ') as tokens from rename_transitions")
def str9(t):
    return t.rename_transitions.select("legal_name").distinct().select("legal_name", F.array_join(S.significant_tokens(c("legal_name")), " ").alias("tokens"))


@R.query(
    "str10_jaccard",
    f"""with p as (select distinct former_name, legal_name, {_SIG.format('former_name')} as a, {_SIG.format('legal_name')} as b from rename_transitions)
select former_name, legal_name, case when len(a) = 0 or len(b) = 0 then 0.0 else len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) end as similarity from p""",
)
def str10(t):
    pairs = t.rename_transitions.select("former_name", "legal_name").distinct()
    return pairs.select("former_name", "legal_name", S.jaccard(S.significant_tokens(c("former_name")), S.significant_tokens(c("legal_name"))).alias("similarity"))


@R.query("str11_party", "select distinct party_label, case when lower(trim(party_label)) in ('r', 'republican') then 'republican' when lower(trim(party_label)) in ('d', 'democrat', 'democratic') then 'democratic' end as slug from candidates")
def str11(t):
    return t.candidates.select("party_label").distinct().select("party_label", S.canonicalize_party(c("party_label")).alias("slug"))


@R.query(
    "str12_ballot_party",
    """with x as (select distinct '(Prefers ' || party_label || ' Party)' as label from candidates)
select label, case when regexp_matches(label, '[ (](?i:r|republican|gop)[ )]') then 'republican' when regexp_matches(label, '[ (](?i:d|democrat|democratic)[ )]') then 'democratic' end as slug from x""",
)
def str12(t):
    label = F.concat(lit("(Prefers "), "party_label", lit(" Party)"))
    return t.candidates.select(label.alias("label")).distinct().select("label", S.ballot_party(c("label")).alias("slug"))


@R.query(
    "str13_roster_party",
    """with x as (select distinct case when record_id % 5 = 0 then 'Prog.' when record_id % 5 = 1 then 'Ind.' when record_id % 5 = 2 then party_label when record_id % 5 = 3 then 'Soc.' end as token,
    case when record_id % 3 > 0 then 1910 + record_id % 12 end as year from candidates)
select token, year,
  case when lower(token) = 'r' then 'republican' when lower(token) = 'd' then 'democratic' when token = 'Soc.' then 'socialist' when token = 'Prog.' and year between 1913 and 1917 then 'progressive' end as slug,
  case when token is null then 'declined' when lower(token) in ('r', 'd', 'soc.') then 'resolved' when token = 'Ind.' then 'declined'
       when token = 'Prog.' then case when year is null then 'unrecognized' when year between 1913 and 1917 then 'resolved' else 'declined' end else 'unrecognized' end as disposition,
  case when token is null or token = 'Ind.' then 'unaffiliated' when token = 'Prog.' then case when year is null then 'year_required' when year between 1913 and 1917 then null else 'outside_org_lifespan' end
       when lower(token) in ('r', 'd', 'soc.') then null else 'unknown_token' end as reason from x""",
)
def str13(t):
    token = F.expr("case when record_id % 5 = 0 then 'Prog.' when record_id % 5 = 1 then 'Ind.' when record_id % 5 = 2 then party_label when record_id % 5 = 3 then 'Soc.' end")
    rows = t.candidates.select(token.alias("token"), F.expr("case when record_id % 3 > 0 then 1910 + record_id % 12 end").alias("year")).distinct()
    return rows.withColumn("p", S.roster_party(c("token"), c("year"))).select("token", "year", "p.slug", "p.disposition", "p.reason")


@R.query("str14_district_number", "select record_id, try_cast(trim(regexp_replace(assembly, '^.*[^0-9]', '')) as integer) as number, try_cast(assembly as integer) as none from candidates")
def str14(t):
    return t.candidates.select("record_id", S.district_number(F.regexp_replace("assembly", "^.*[^0-9]", "")).alias("number"), S.district_number(c("assembly")).alias("none"))


@R.query("str15_district_slug", "select record_id, 'ld-' || ld as slug, case when qualifier in ('Position 1', 'Position 2') then qualifier end as position from house_positions")
def str15(t):
    return t.house_positions.select("record_id", S.district_slug(c("ld")).alias("slug"), S.canonical_position(c("qualifier")).alias("position"))


@R.query("str16_discriminator", "select record_id, 'ld-' || ld || '-position-' || right(qualifier, 1) as code, ld as district, qualifier as position from house_positions where qualifier is not null")
def str16(t):
    rows = t.house_positions.filter("qualifier is not null").select("record_id", S.house_discriminator(c("ld"), c("qualifier")).alias("code"))
    return rows.withColumn("p", S.parse_discriminator(c("code"))).select("record_id", "code", "p.district", "p.position")


def races(t):
    return t.house_positions.select(
        "record_id",
        F.expr("case record_id % 4 when 0 then 'LEGISLATIVE DISTRICT ' || ld || ' - State Representative Pos. ' || coalesce(right(qualifier, 1), '') when 1 then 'Legislative District ' || ld || ' - State Senator' when 2 then 'Legislative District ' || ld || ' State Representative ' || coalesce(right(qualifier, 1), '9') else 'Governor' end").alias("race"),
    )


_RACES = "(select record_id, ld, qualifier, case record_id % 4 when 0 then 'LEGISLATIVE DISTRICT ' || ld || ' - State Representative Pos. ' || coalesce(right(qualifier, 1), '') when 1 then 'Legislative District ' || ld || ' - State Senator' when 2 then 'Legislative District ' || ld || ' State Representative ' || coalesce(right(qualifier, 1), '9') else 'Governor' end as race from house_positions)"


@R.query("str17_house_race", f"select record_id, race, case when record_id % 4 in (0, 2) and qualifier is not null then ld end as ld, case when record_id % 4 in (0, 2) then qualifier end as qualifier from {_RACES}")
def str17(t):
    return races(t).withColumn("p", S.house_race(c("race"))).select("record_id", "race", "p.ld", "p.qualifier")


@R.query("str18_senate_race", f"select record_id, case when record_id % 4 = 1 then ld end as ld from {_RACES}")
def str18(t):
    return races(t).select("record_id", S.senate_race(c("race")).alias("ld"))


@R.query("str19_filing_race", "select record_id, qualifier as position from house_positions")
def str19(t):
    return t.house_positions.select("record_id", S.filing_race(F.concat(lit(" State Representative Pos. "), F.coalesce(F.substring("qualifier", -1, 1), lit("x")))).alias("position"))


@R.query("str20_votes", "select distinct mention_id, votes, cast(votes as bigint) as parsed from senate_winners")
def str20(t):
    typed = F.format_number(c("votes").cast("bigint"), 0)
    return t.senate_winners.select("mention_id", "votes", S.parse_votes(F.coalesce(typed, lit("n/a"))).alias("parsed")).distinct()


@R.query("str21_position_suffix", "select distinct member_name, regexp_replace(member_name || ' – ' || coalesce(district, 1) || 'B', '\\s*[–—-]\\s*\\d{1,2}\\s*[AB]?\\s*$', '') as name from event_proposals")
def str21(t):
    rows = t.event_proposals.select("member_name", "district").distinct()
    return rows.select("member_name", S.strip_position_suffix(F.concat("member_name", lit(" – "), F.coalesce(c("district"), lit(1)).cast("string"), lit("B"))).alias("name")).distinct()


_CUES = "|".join(S.CUES)


@R.query(
    "str22_split_annotation",
    f"""with x as (select distinct record_id, member_name || case when evidence like '(%' then ' ' || evidence else ' (' || evidence || ')' end as raw from event_proposals),
  y as (select *, '^(.*?)\\(\\s*((?i:{_CUES}|to serve)\\b.*)$' as p from x)
select record_id, trim(case when regexp_matches(raw, p) then regexp_extract(raw, p, 1) else raw end) as name, case when regexp_matches(raw, p) then trim(rtrim(trim(regexp_extract(raw, p, 2)), ')')) end as annotation from y""",
)
def str22(t):
    raw = F.concat("member_name", F.when(c("evidence").startswith("("), F.concat(lit(" "), "evidence")).otherwise(F.concat(lit(" ("), "evidence", lit(")"))))
    rows = t.event_proposals.select("record_id", raw.alias("raw")).distinct()
    return rows.select("record_id", S.split_annotation(c("raw")).alias("s")).select("record_id", "s.name", "s.annotation")


@R.query(
    "str23_clauses",
    """with p as (select distinct record_id, regexp_replace(replace(evidence, ';', chr(31)), '\\)(\\s*[A-Za-z(])', chr(31) || '\\1', 'g') as e from event_proposals),
  s as (select record_id, unnest(string_split(e, chr(31))) as part from p),
  q as (select record_id, trim(part, ' ()') as text from s)
select record_id, text, case when regexp_matches(text, '^(?i:died|deceased)\\b') then 'deceased' when regexp_matches(text, '^(?i:sworn\\s+in)\\b') then 'sworn_in' when regexp_matches(text, '^(?i:appointed)\\b') then 'appointed'
  when regexp_matches(text, '^(?i:resigned)\\b') then 'resigned' when regexp_matches(text, '^(?i:elected)\\b') then 'elected' when regexp_matches(text, '^(?i:redistricted)\\b') then 'redistricted' when regexp_matches(text, '^(?i:holdover)\\b') then 'holdover' when regexp_matches(text, '^(?i:changed\\s+party)\\b') then 'changed_party' end as verb
from q where text <> ''""",
)
def str23(t):
    rows = t.event_proposals.select("record_id", "evidence").distinct()
    return rows.select("record_id", F.explode(S.clauses(c("evidence"))).alias("p")).select("record_id", "p.text", "p.verb")


# Both forms, a token's other spelling, and two notes that must be refused; the rest as it stands.
_NOTE = "case record_id % 6 when 0 then 'Changed party affiliation, ' || session_year || ') ... R' when 1 then 'Changed party affiliation to Democrat, February 13, ' || session_year when 2 then 'Changed party affiliation ' || session_year || ') . Silver R' when 3 then 'Changed party affiliation to Martian, February 13, ' || session_year when 4 then 'Changed party affiliation Foo 33, ' || session_year else evidence end"


@R.query(
    "str24_party_change",
    f"""with x as (select distinct record_id, session_year, {_NOTE} as note from event_proposals)
select record_id, case when record_id % 6 in (0, 2) then 'year' when record_id % 6 = 1 then 'dated' when note ilike '%changed party%' then 'unparsed' end as state, case when record_id % 6 < 3 then session_year end as year,
  case when record_id % 6 = 1 then make_date(session_year, 2, 13) end as day, case record_id % 6 when 0 then 'R' when 1 then 'D' when 2 then 'Silver Rep.' end as token from x""",
)
def str24(t):
    rows = t.event_proposals.select("record_id", F.expr(_NOTE).alias("note")).distinct()
    return rows.withColumn("p", S.party_change(c("note"))).select("record_id", "p.state", "p.year", "p.day", "p.token")


@R.query(
    "str25_row_shape",
    """with x as (select distinct record_id, list_filter(regexp_split_to_array(member_name, '\\s+'), lambda w: w <> '') as w from event_proposals)
select record_id, record_id % 2 = 1 as undeclared, len(w) > 0 and len(list_filter(w, lambda v: not (v[1] in ('“', '”', '"', chr(39), '(') or (upper(v[1]) = v[1] and lower(v[1]) <> v[1])))) = 0 as awaits from x""",
)
def str25(t):
    body = F.concat("member_name", lit(" ........ "), F.expr("case when record_id % 2 = 1 then 'Whig' else 'R' end"))
    led = F.concat_ws(" ", c("session_year").cast("string"), "member_name")
    return t.event_proposals.select("record_id", S.undeclared_party_tail(body, list(S.ROSTER_PARTIES)).alias("undeclared"), S.awaits_leader(led).alias("awaits")).distinct()


@R.query("str26_reason_and_url", "select distinct record_id, left(evidence, 120) as reason, 'https://archive.invalid/roster.pdf#page=' || page_number as url from event_proposals")
def str26(t):
    return t.event_proposals.select("record_id", F.substring("evidence", 1, 120).alias("reason"), S.evidence_url(lit("https://archive.invalid/roster.pdf"), c("page_number")).alias("url")).distinct()


@R.query("str27_ulid_codec", "select distinct id, id as again, length(id) + 6 as digits from persons")
def str27(t):
    return t.persons.select("id", id_text(F.lower(id_hex(c("id")))).alias("again"), F.length(id_hex(c("id"))).alias("digits")).distinct()


# Dates ---------------------------------------------------------------------------------------------

_LABELS = "(select distinct slug, biennium_label as b, cast(left(biennium_label, 4) as integer) as y from legislative_sessions where biennium_label is not null)"


def labels(t):
    return t.legislative_sessions.filter("biennium_label is not null").select("slug", c("biennium_label").alias("b")).distinct()


def label_sql(year: str) -> str:
    return f"({year})::varchar || '-' || lpad(((({year}) + 1) % 100)::varchar, 2, '0')"


@R.query("date1_parse_biennium", f"select slug, y as start, y + 1 as \"end\" from {_LABELS}")
def date1(t):
    return labels(t).select("slug", "b", D.parse_biennium(c("b")).alias("p")).select("slug", "p.start", "p.end")


@R.query("date2_biennium_of_date", f"select distinct start_date, {label_sql('year(start_date) - case when year(start_date) % 2 = 0 then 1 else 0 end')} as biennium from legislative_sessions where start_date is not null")
def date2(t):
    return t.legislative_sessions.filter("start_date is not null").select("start_date", D.biennium_of(c("start_date")).alias("biennium")).distinct()


@R.query("date3_start_date", f"select slug, make_date(y, 1, 1) as day from {_LABELS}")
def date3(t):
    return labels(t).select("slug", D.start_date(c("b")).alias("day"))


@R.query("date4_previous", f"select slug, {label_sql('y - 2')} as previous from {_LABELS}")
def date4(t):
    return labels(t).select("slug", D.previous_biennium(c("b")).alias("previous"))


@R.query("date5_range", f"select b, {label_sql('r.range')} as each from (select distinct b, y from {_LABELS}) x, range(1989, 2031, 2) r where r.range <= y")
def date5(t):
    return labels(t).select("b").distinct().select("b", F.explode(D.bienniums_between(lit("1989-90"), c("b"))).alias("each"))


@R.query("date6_window", f"select distinct b, make_timestamp(y, 1, 1, 0, 0, 0) as \"from\", make_timestamp(y + 1, 12, 31, 23, 59, 59) as \"to\" from {_LABELS}")
def date6(t):
    return labels(t).select("b").distinct().select("b", D.biennium_window(c("b")).alias("w")).select("b", "w.from", "w.to")


@R.query("date7_calendar", f"select b, y - 1 as election, {label_sql('y + 2')} as seats_next, unnest([y - 1, y]) as house_year, unnest([y - 1, y - 3, y]) as senate_year from (select distinct b, y from {_LABELS})")
def date7(t):
    y = F.substring("b", 1, 4).cast("int")
    rows = labels(t).select("b").distinct()
    # Both lists side by side, the shorter one filled with nulls.
    both = F.arrays_zip(D.election_years(y), D.senate_election_years(y))
    return rows.select("b", D.election_year(y).alias("election"), D.seated_biennium(y + 1).alias("seats_next"), F.explode(both).alias("z")).select("b", "election", "seats_next", c("z.0").alias("house_year"), c("z.1").alias("senate_year"))


@R.query("date8_election_date", "select distinct election_year, (make_date(election_year, 11, 1) + ((8 - isodow(make_date(election_year, 11, 1))) % 7)::integer + 1)::date as day from senate_winners")
def date8(t):
    return t.senate_winners.select("election_year").distinct().select("election_year", D.general_election_date(c("election_year")).alias("day"))


_MONTH_SQL = D._MONTH.replace("(?:", "(", 1)
_DATED = f"""with x as (select distinct evidence as e, regexp_replace(evidence, '(?i:{"|".join(D.SESSION_NOISE)})', ' ', 'g') as b from event_proposals),
  p as (select e, b, regexp_extract(b, '(?i:\\b{_MONTH_SQL}[\\s.,]+(\\d{{1,2}})[\\s.,]+(\\d{{4}})\\b)', ['m', 'd', 'y']) as f, regexp_extract(b, '(?i:\\b{_MONTH_SQL}[\\s.,]+(\\d{{4}})\\b)', ['m', 'y']) as h, regexp_extract(b, '\\b((1[89]|20)\\d{{2}})\\b', 1) as y from x),
  q as (select *, case when try_cast(f.y as integer) between 1889 and 2049 then try_strptime(left(f.m, 3) || ' ' || f.d || ' ' || f.y, '%b %d %Y')::date end as day from p)"""


@R.query("date9_mixed_precision", f"{_DATED} select e as text, day as value, case when day is not null then 'day' when h.y <> '' then 'month' when y <> '' then 'year' else 'none' end as precision from q")
def date9(t):
    rows = t.event_proposals.select(c("evidence").alias("text")).distinct()
    return rows.withColumn("p", D.mixed_date(c("text"))).select("text", "p.value", "p.precision")


@R.query("date10_sweep_years", "select ld, r.range as year from (select ld, min(election_year) as a, max(election_year) as z from house_positions group by ld) x, range(1901, 2101, 2) r where r.range between a and z")
def date10(t):
    span = t.house_positions.groupBy("ld").agg(F.min("election_year").alias("a"), F.max("election_year").alias("z"))
    return span.select("ld", F.explode(D.sweep_years(c("a"), c("z"))).alias("year"))


@R.query("date11_backoff", "select distinct page_number % 12 + 1 as attempts, least(60 * power(2, page_number % 12), 3600)::bigint as seconds from event_proposals")
def date11(t):
    return t.event_proposals.select((c("page_number") % 12 + 1).alias("attempts")).distinct().select("attempts", D.backoff_seconds(c("attempts")).alias("seconds"))


@R.query("date12_remote_timestamp", "select distinct id, date_trunc('second', created_at) as at from jurisdictions")
def date12(t):
    wire = F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), lit("Z"))
    return t.jurisdictions.select("id", F.to_timestamp(wire).cast("timestamp_ntz").alias("at")).distinct()


@R.query(
    "date13_partial_date",
    f"{_DATED} select e as text, case when day is not null then year(day) when h.y <> '' then try_cast(h.y as integer) when y <> '' then try_cast(y as integer) end as year, case when day is not null then month(day) when h.y <> '' then month(try_strptime(left(h.m, 3), '%b')) end as month, day(day) as day, case when day is not null then 9 end as hour, case when day is not null then 30 end as minute, null::integer as second from q",
)
def date13(t):
    """Of a note and a clock time: hours count after a full date only, and seconds are not stated."""
    rows = t.event_proposals.select(c("evidence").alias("text")).distinct()
    return rows.withColumn("p", D.partial_date(F.concat("text", lit(" at 9:30")))).select("text", "p.*")


# Arrays and JSON -------------------------------------------------------------------------------------


@R.query("arr1_flatten", "select distinct record_id, unnest(name_keys) as key from house_positions")
def arr1(t):
    return t.house_positions.select("record_id", F.explode_outer("name_keys").alias("key")).distinct()


@R.query("arr2_two_years", "select distinct record_id, election_year + d as year from house_positions, (values (1), (2)) x(d)")
def arr2(t):
    return t.house_positions.select("record_id", F.explode(F.array(c("election_year") + 1, c("election_year") + 2)).alias("year")).distinct()


@R.query("arr3_term_coverage", "select distinct mention_id, election_year + d as year from senate_winners, (values (1), (3)) x(d)")
def arr3(t):
    return t.senate_winners.select("mention_id", F.explode(F.sequence(c("election_year") + 1, c("election_year") + 4, lit(2))).alias("year")).distinct()


@R.query("arr4_json_counters", "select status, '{\"n\":' || count(*) || ',\"hashed\":' || count(content_hash) || '}' as counters from fetch_events group by status")
def arr4(t):
    return t.fetch_events.groupBy("status").agg(F.count("*").alias("n"), F.count("content_hash").alias("hashed")).select("status", F.to_json(F.struct("n", "hashed")).alias("counters"))


@R.query("arr5_json_records", "select event_id, json_extract_string(props, '$.' || json_keys(props)[1]) as value from events where json_keys(props) is not null and len(json_keys(props)) > 0")
def arr5(t):
    fields = F.from_json("props", T.MapType(T.StringType(), T.StringType()))
    first = F.get(F.json_object_keys("props"), lit(0))
    return t.events.filter(F.size(F.json_object_keys("props")) > 0).select("event_id", F.try_element_at(fields, first).alias("value"))


_ESCAPED = "array_to_string(list_transform(string_split({}, ''), lambda ch: case when ch = '\"' then '\\\"' when ch = '\\' then '\\\\' when ch = chr(9) then '\\t' when ch = chr(10) then '\\n' when ch = chr(13) then '\\r' when unicode(ch) between 32 and 126 then ch else printf('\\u%04x', unicode(ch)) end), '')"


@R.query(
    "arr6_canonical_json",
    f"""select distinct record_id, sha256('{{"district": ' || coalesce(district::varchar, 'null') || ', "kind": "' || kind || '", "member": ' || coalesce('"' || {_ESCAPED.format('member_name')} || '"', 'null') || '}}') as digest from event_proposals""",
)
def arr6(t):
    document = canonical_json(F.struct("district", "kind", c("member_name").alias("member")))
    return t.event_proposals.select("record_id", F.sha2(document, 256).alias("digest")).distinct()


@R.query("arr7_structs_to_map", "select record_id, slug, record_id::varchar as value, len(identifier_slugs) as n from (select distinct record_id, identifier_slugs, unnest(identifier_slugs) as slug from candidates)")
def arr7(t):
    structs = F.transform("identifier_slugs", lambda s: F.struct(s.alias("scheme"), c("record_id").cast("string").alias("value")))
    mapped = t.candidates.dropDuplicates(["record_id"]).select("record_id", F.map_from_entries(structs).alias("by_scheme"))
    return mapped.select("record_id", F.explode("by_scheme").alias("slug", "value"), F.size("by_scheme").alias("n"))


@R.query("arr8_any_match", "select distinct record_id, list_contains(identifier_slugs, 'person_ballot_name') as has from candidates")
def arr8(t):
    return t.candidates.select("record_id", F.exists("identifier_slugs", lambda s: s == "person_ballot_name").alias("has")).distinct()


@R.query("arr9_payload", """select distinct record_id, '{' || concat_ws(',', '"id":' || record_id, '"district":' || cast(district_hint as integer), '"party":"' || party_label || '"') || '}' as payload from candidates""")
def arr9(t):
    fields = F.struct(c("record_id").alias("id"), c("district_hint").cast("int").alias("district"), c("party_label").alias("party"))
    return t.candidates.select("record_id", F.to_json(fields).alias("payload")).distinct()


@R.query("arr10_additional_ids", "select assembly, string_agg(s, ',' order by s) as schemes from (select distinct assembly, unnest(identifier_slugs) as s from candidates) group by assembly")
def arr10(t):
    each = t.candidates.select("assembly", F.explode("identifier_slugs").alias("s"))
    return each.groupBy("assembly").agg(F.array_join(F.array_sort(F.collect_set("s")), ",").alias("schemes"))


QUERIES, ORACLE = R.queries, R.oracle
