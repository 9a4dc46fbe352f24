"""DuckDB SQL of the registered queries, put together from common table expressions."""

from __future__ import annotations

from lodestone.functions.dictionaries import COUNTRIES, MATCH_ORDER, NAME_SUFFIXES, ORGANIZATION_WORDS, SECTION_NAMES, SKILL_ALIASES
from lodestone.plans.adapters import PLACES, SKILL_LISTS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


def _map(table: dict[str, str]) -> str:
    return f"map({_list(table)}, {_list(table.values())})"


def _clean(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '\\s+', ' ', 'g')), '')"


def _lookup(table: dict[str, str], key: str) -> str:
    return f"{_map(table)}[{key}]"


def _skill(x: str) -> str:
    return f"coalesce({_lookup(SKILL_ALIASES, f'lower(trim({x}))')}, trim({x}))"


def _once(items: str) -> str:
    """Texts that no earlier text equals but for case."""
    return f"list_filter({items}, lambda x, i: list_position(list_transform({items}, lambda y: lower(y)), lower(x)) = i)"


def _some(items: str) -> str:
    return f"list_filter({items}, lambda x: x IS NOT NULL AND x <> '')"


def _phone(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return f"""CASE WHEN length({d}) BETWEEN 7 AND 15 THEN CASE WHEN trim({x}) LIKE '+%' THEN '+' || {d}
      WHEN {d} LIKE '00%' AND length({d}) > 9 THEN '+' || {d}[3:] WHEN length({d}) >= 11 THEN '+' || {d} ELSE {d} END END"""


_COLUMNS = ("name", "email", "phone", "company", "title", "skills", "location")
_CASES = " ".join(f"WHEN {k} THEN replace({_text(p)}, '{{n}}', n_name)" for k, p in enumerate(PLACES))
ROWS = f"""
rows AS (
  SELECT o_orderkey AS seq,
    CASE o_orderkey % 7 WHEN 0 THEN 'resume_docx' WHEN 1 THEN 'resume_pdf' ELSE 'recruiter_csv' END AS source_type,
    replace(lower(c_name), '#', ' ') AS name,
    CASE WHEN o_orderkey % 3 <> 0 THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'Person.' ELSE 'person.' END) || o_custkey || '@Example.com' END AS email,
    CASE WHEN o_orderkey % 5 > 1 THEN CASE
      WHEN o_orderkey % 11 < 3 THEN '+44 (20) ' || lpad(o_custkey::VARCHAR, 8, '0')[1:4] || '-' || lpad(o_custkey::VARCHAR, 8, '0')[5:8]
      WHEN o_orderkey % 11 < 6 THEN '004420' || lpad(o_custkey::VARCHAR, 8, '0')
      WHEN o_orderkey % 11 < 9 THEN '44 20 ' || lpad(o_custkey::VARCHAR, 8, '0')[1:4] || '.' || lpad(o_custkey::VARCHAR, 8, '0')[5:8]
      ELSE ' +4420' || lpad(o_custkey::VARCHAR, 8, '0') END END AS phone,
    CASE WHEN o_orderkey % 13 <> 0 THEN c_mktsegment END AS company,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS title,
    {_list(SKILL_LISTS)}[(o_orderkey % 8 + 1)::INT] AS skills,
    CASE WHEN o_orderkey % 19 <> 0 THEN CASE o_orderkey % 4 {_CASES} END END AS location
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), raw AS (
  SELECT *, concat_ws(chr(10), {', '.join(f"CASE WHEN {c} <> '' THEN '{c}: ' || {c} END" for c in _COLUMNS)}) AS raw_text FROM rows
)"""

_NAME = _clean("name")
_WORD = f"""CASE WHEN trim(lower(w), '.') IN ({', '.join(map(_text, NAME_SUFFIXES))}) THEN rtrim(upper(w), '.')
      WHEN length(w) <= 3 AND regexp_matches(w, '\\p{{Lu}}') AND NOT regexp_matches(w, '\\p{{Ll}}') THEN w ELSE upper(w[1]) || lower(w[2:]) END"""
_SPLIT = f"list_filter(list_transform(string_split(coalesce(skills, ''), ','), lambda x: trim(x)), lambda x: x <> '')"
_PLACE = _clean("location")
NORM = f"""{ROWS}, cleaned AS (
  SELECT *, array_to_string(list_transform(string_split({_NAME}, ' '), lambda w: {_WORD}), ' ') AS full_name,
    {_clean('location')} AS raw_location, {_clean('email')} AS address,
    list_transform({_SPLIT}, lambda x: {_skill('x')}) AS skill_list,
    'raw_' || sha256(concat_ws(chr(31), 'orders', seq::VARCHAR, raw_text))[1:32] AS record_id,
    CASE source_type WHEN 'recruiter_csv' THEN 10 WHEN 'resume_docx' THEN 40 WHEN 'resume_pdf' THEN 50 END AS priority
  FROM raw
), parted AS (
  SELECT *, CASE WHEN regexp_matches(lower(address), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$') THEN lower(address) END AS mail, {_phone('phone')} AS tel,
    list_filter(list_transform(string_split(raw_location, ','), lambda x: trim(x)), lambda x: x <> '') AS parts, {_once('skill_list')} AS skill_set,
    {_clean('title')} AS job, {_clean('company')} AS firm
  FROM cleaned
), norm AS (
  SELECT *, string_split(full_name, ' ')[1] AS first_name, CASE WHEN contains(full_name, ' ') THEN string_split(full_name, ' ')[-1] END AS last_name,
    parts[1] AS city, {_lookup(COUNTRIES, 'lower(parts[-1])')} AS country, CASE WHEN firm IS NOT NULL THEN job END AS headline,
    CASE WHEN len(parts) > 2 OR (len(parts) = 2 AND {_lookup(COUNTRIES, 'lower(parts[-1])')} IS NULL) THEN parts[2] END AS state_or_region
  FROM parted
)"""
CASCADE = f"""{NORM}, k AS (
  SELECT *, 'normalized::' || record_id AS normalized_id, mail AS k1, tel AS k2, 'name_location::' || lower(full_name) || '::' || lower(raw_location) AS k3, 'name::' || lower(full_name) AS k4 FROM norm
), c1 AS (SELECT *, CASE WHEN k1 IS NOT NULL AND count(*) OVER (PARTITION BY k1) >= 2 THEN 'email_match' END AS r1 FROM k),
c2 AS (SELECT *, coalesce(r1, CASE WHEN k2 IS NOT NULL AND count(*) FILTER (WHERE r1 IS NULL) OVER (PARTITION BY k2) >= 2 THEN 'phone_match' END) AS r2 FROM c1),
c3 AS (SELECT *, coalesce(r2, CASE WHEN k3 IS NOT NULL AND count(*) FILTER (WHERE r2 IS NULL) OVER (PARTITION BY k3) >= 2 THEN 'name_location_match' END) AS r3 FROM c2),
c4 AS (SELECT *, coalesce(r3, CASE WHEN k4 IS NOT NULL AND count(*) FILTER (WHERE r3 IS NULL) OVER (PARTITION BY k4) >= 2 THEN 'ambiguous' END, 'no_match') AS rule FROM c3),
g AS (
  SELECT *, 'group::' || rule || '::' || replace(replace(replace(CASE rule WHEN 'email_match' THEN k1 WHEN 'phone_match' THEN k2 WHEN 'name_location_match' THEN k3 ELSE normalized_id END, ' ', '_'), '@', '_at_'), '::', '__') AS group_id,
    CASE rule WHEN 'email_match' THEN k1 WHEN 'phone_match' THEN k2 WHEN 'name_location_match' THEN k3 WHEN 'ambiguous' THEN 'ambiguous::' || k4 ELSE 'no_match::' || normalized_id END AS group_key
  FROM c4
), groups_ AS (
  SELECT group_id, group_key, rule, CASE WHEN rule IN ('ambiguous', 'no_match') THEN rule ELSE 'matched' END AS resolution_status, count(*) AS group_size,
    list_position(['email_match', 'phone_match', 'name_location_match', 'ambiguous', 'no_match'], rule)::INT AS rule_order, count(*) AS n_ids
  FROM g GROUP BY ALL
)"""


def _first(column: str) -> str:
    return f"(list({column} ORDER BY priority, seq) FILTER (WHERE {column} IS NOT NULL))[1]"


MASTER = f"""{CASCADE}, skill_rows AS (
  SELECT group_id, priority, seq, unnest(skill_set) AS skill, generate_subscripts(skill_set, 1) AS place FROM g
), skill_first AS (
  SELECT * FROM skill_rows QUALIFY row_number() OVER (PARTITION BY group_id, lower(skill) ORDER BY priority, seq, place) = 1
), skill_sets AS (
  SELECT group_id, list(skill ORDER BY priority, seq, place) AS skills FROM skill_first GROUP BY group_id
), jobs AS (
  SELECT * FROM g WHERE firm IS NOT NULL QUALIFY row_number() OVER (PARTITION BY group_id, lower(firm), lower(coalesce(job, '')) ORDER BY priority, seq) = 1
), job_counts AS (
  SELECT group_id, count(*) AS n_jobs FROM jobs GROUP BY group_id
), picked AS (
  SELECT group_id, rule, 'master::' || group_id AS master_candidate_id, count(*) AS n_records, {', '.join(f'{_first(c)} AS {c}' for c in ('full_name', 'first_name', 'last_name', 'headline', 'mail', 'tel', 'city', 'state_or_region', 'country', 'raw_location'))},
    count(DISTINCT mail) AS n_mails, count(DISTINCT tel) AS n_tels FROM g GROUP BY group_id, rule
), m AS (
  SELECT p.*, coalesce(s.skills, []) AS skills, coalesce(j.n_jobs, 0) AS n_jobs FROM picked p LEFT JOIN skill_sets s USING (group_id) LEFT JOIN job_counts j USING (group_id)
)"""
SCORED = f"""{MASTER}, s AS (
  SELECT *, CASE WHEN len(skills) = 0 THEN 0.0 WHEN len(skills) >= 5 THEN 1.0 WHEN len(skills) >= 3 THEN 0.8 ELSE 0.6 END::DOUBLE AS skill_confidence,
    0.4::DOUBLE AS extraction_reliability_score, CASE WHEN n_records <= 1 THEN 0.8 ELSE 1.0 END::DOUBLE AS source_agreement_score,
    CASE rule WHEN 'email_match' THEN 1.0 WHEN 'phone_match' THEN 1.0 WHEN 'name_location_match' THEN 0.8 WHEN 'ambiguous' THEN 0.3 ELSE 0.6 END::DOUBLE AS identity_score,
    0.5::DOUBLE AS conflict_outcome_score,
    round_even(((full_name IS NOT NULL)::INT + (mail IS NOT NULL)::INT + (tel IS NOT NULL)::INT + (headline IS NOT NULL)::INT + (raw_location IS NOT NULL)::INT + (len(skills) > 0)::INT + (n_jobs > 0)::INT) / 8.0::DOUBLE, 2) AS completeness_score,
    CASE WHEN rule = 'ambiguous' THEN 0.3 WHEN greatest(n_mails - 1, 0) + greatest(n_tels - 1, 0) = 0 THEN 1.0 WHEN greatest(n_mails - 1, 0) + greatest(n_tels - 1, 0) <= 2 THEN 0.8 ELSE 0.6 END::DOUBLE AS consistency_score
  FROM m
), c AS (
  SELECT *, round((skill_confidence + extraction_reliability_score + source_agreement_score + identity_score + conflict_outcome_score + completeness_score + consistency_score) / 7, 2) AS overall_score FROM s
)"""
_PROJECTED = "master_candidate_id AS candidate_id, full_name, mail AS email, tel AS phone, headline AS current_title, raw_location AS location, nullif(array_to_string(skills, '|'), '') AS skills"


def _texts(items: str, name: str, text: str = "text") -> str:
    """One row per item of a list made from the documents' texts."""
    return f"WITH t AS (SELECT doc_id, {text} AS text FROM documents), l AS (SELECT doc_id, {items} AS items FROM t) SELECT doc_id, generate_subscripts(items, 1) - 1 AS pos, unnest(items) AS {name} FROM l"


def _squeezed(items: str) -> str:
    return _some(f"list_transform({items}, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g')))")


_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
_TEL = r"\+?[0-9][0-9().\s-]{7,}[0-9]"
_LINES = _squeezed("regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e]')")
_SENTENCES = _squeezed("string_split(regexp_replace(text, '([.!?\\n])\\s+', '\\1' || chr(1), 'g'), chr(1))")


def statements() -> dict[str, str]:
    low = "lower(text)"
    escape = lambda a: "".join("\\" + c if c in ".+#-" else c for c in a)
    hits = ", ".join(f"CASE WHEN regexp_matches({low}, '(^|[^a-z0-9]){escape(a)}($|[^a-z0-9])') THEN {_text(SKILL_ALIASES[a])} END" for a in MATCH_ORDER)
    skill_names = f"list_filter([{hits}], lambda x: x IS NOT NULL)"
    kept_phones = f"list_filter(list_transform(regexp_extract_all(text, '{_TEL}'), lambda x: trim(trim(regexp_replace(x, '\\s+', ' ', 'g')), '.,;')), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 7 AND 15)"
    rows = lambda q: f"WITH {ROWS} {q}"
    org = "|".join(ORGANIZATION_WORDS)
    section = "|".join(sorted(SECTION_NAMES, key=len, reverse=True))
    url = "regexp_extract_all(t, '(?i)\\b(?:https?://|www\\.)[^\\s<>]+')"
    return {
        "q01_blank_filter": rows("SELECT seq, name FROM rows WHERE seq % 23 <> 0"),
        "q02_row_to_text": rows("SELECT seq, raw_text FROM raw"),
        "q03_validation_issues": rows("SELECT seq, 'missing_required_value' AS code, 'error' AS severity, 'email' AS field_name FROM rows WHERE source_type = 'recruiter_csv' AND coalesce(trim(email), '') = '' UNION ALL SELECT seq, 'missing_required_value', 'error', 'name' FROM rows WHERE source_type = 'recruiter_csv' AND coalesce(trim(name), '') = '' UNION ALL SELECT seq, 'malformed_phone_number', 'error', 'phone' FROM rows WHERE source_type = 'recruiter_csv' AND NOT regexp_matches(trim(phone), '^\\+?[0-9().\\s-]{7,}$')"),
        "q04_validation_report": rows("SELECT count(*) AS total_records, 0::BIGINT AS fatal_count, count(*) FILTER (WHERE source_type = 'recruiter_csv' AND email IS NULL) AS error_count, 0::BIGINT AS warning_count, 0::BIGINT AS info_count, count(*) AS valid_records, count(*) FILTER (WHERE source_type = 'recruiter_csv' AND email IS NULL) > 0 AS has_errors, false AS has_fatals FROM rows"),
        "q05_union_sources": rows("SELECT 0 AS source_order, source_type, count(*) AS n, sum(length(raw_text))::BIGINT AS n_chars FROM raw GROUP BY source_type UNION ALL SELECT 1, 'resume_docx', count(*), sum(length(text))::BIGINT FROM documents WHERE trim(text) <> ''"),
        "q06_split_skills": rows(f", l AS (SELECT seq, list_transform({_SPLIT}, lambda x: {_skill('x')}) AS items FROM rows) SELECT seq, generate_subscripts(items, 1) - 1 AS pos, unnest(items) AS skill FROM l"),
        "q07_extract_emails": _texts(_once(f"regexp_extract_all(text, '{_EMAIL}')"), "email"),
        "q08_extract_phones": _texts(_once(kept_phones), "phone"),
        "q09_extract_urls": f"WITH p AS (SELECT page_id, concat_ws(' ', 'see', url, 'or www.' || regexp_extract(url, '//([^/?#]+)', 1)) AS t FROM pages), l AS (SELECT page_id, {_once(f'list_transform({url}, lambda x: CASE WHEN contains(x, {_text("://")}) THEN x ELSE {_text("https://")} || x END)')} AS items FROM p) SELECT page_id, generate_subscripts(items, 1) - 1 AS pos, unnest(items) AS found FROM l",
        "q10_extract_skills": _texts(_once(skill_names), "skill", "text || ' Go, C++ and node.js; Java-Script (SQL)'"),
        "q11_lines": _texts(_LINES, "line"),
        "q12_sentences": _texts(_SENTENCES, "sentence"),
        "q13_sections": f"WITH t AS (SELECT doc_id, 'Summary of it' || chr(10) || text || chr(10) || 'Work Experience' || chr(10) || 'Engineer, Acme Labs 2019' || chr(10) || 'skills: all' || chr(10) || 'SQL and Spark' || chr(10) AS text FROM documents), l AS (SELECT doc_id, {_LINES} AS items FROM t), e AS (SELECT doc_id, generate_subscripts(items, 1) AS pos, unnest(items) AS line FROM l), h AS (SELECT *, {_lookup(SECTION_NAMES, f'''nullif(regexp_extract(lower(line), '^({section})\\b', 1), '')''')} AS header FROM e), p AS (SELECT *, last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM h) SELECT doc_id, section, count(*) FILTER (WHERE header IS NULL) AS n_lines FROM p WHERE section IS NOT NULL GROUP BY doc_id, section",
        "q14_name": f"WITH l AS (SELECT doc_id, {_LINES} AS items FROM documents) SELECT doc_id, list_filter(items[1:3], lambda x: NOT regexp_matches(x, '[@0-9]') AND len(string_split(x, ' ')) BETWEEN 2 AND 4 AND len(list_filter(string_split(x, ' '), lambda w: regexp_matches(w, '^[\\p{{L}}.]*\\p{{L}}[\\p{{L}}.]*$') AND NOT regexp_matches(w, '^\\p{{Lu}}'))) = 0)[1] AS name FROM l",
        "q15_organizations": f"WITH t AS (SELECT doc_id, text || ' He left Acme Labs. Then Blue Systems hired him' AS text FROM documents), l AS (SELECT doc_id, {_SENTENCES} AS items FROM t), e AS (SELECT doc_id, generate_subscripts(items, 1) AS sentence, string_split(unnest(items), ' ') AS w FROM l), w AS (SELECT doc_id, sentence, generate_subscripts(w, 1) AS place, unnest(w) AS a, unnest(list_append(list_slice(w, 2, len(w)), NULL)) AS b FROM e), p AS (SELECT doc_id, sentence, place, a || ' ' || b AS organization FROM w WHERE regexp_matches(a, '^\\p{{Lu}}') AND regexp_matches(b, '^\\p{{Lu}}') AND regexp_matches(lower(a || ' ' || b), '{org}')), f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY doc_id, lower(organization) ORDER BY sentence, place) = 1) SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sentence, place) - 1 AS pos, organization FROM f",
        "q19_names": f"WITH {NORM} SELECT seq, full_name, first_name, last_name FROM norm",
        "q20_phones": f"WITH {NORM} SELECT seq, tel AS phone FROM norm",
        "q21_emails": f"WITH {NORM} SELECT seq, mail AS email FROM norm",
        "q22_locations": rows(f", a AS (SELECT seq, {_clean('location')} AS l FROM rows), b AS (SELECT seq, array_to_string(list_transform(string_split(l, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS raw_location FROM a), c AS (SELECT *, list_filter(list_transform(string_split(raw_location, ','), lambda x: trim(x)), lambda x: x <> '') AS parts FROM b), d AS (SELECT *, {_lookup(COUNTRIES, 'lower(parts[-1])')} AS country FROM c) SELECT seq, parts[1] AS city, CASE WHEN len(parts) > 2 OR (len(parts) = 2 AND country IS NULL) THEN parts[2] END AS state_or_region, country, raw_location FROM d"),
        "q23_dates": "WITH d AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y') WHEN 2 THEN strftime(o_orderdate, '%-d %b %Y') WHEN 3 THEN strftime(o_orderdate, '%B %-d, %Y') ELSE 'soon' END AS text, o_orderdate FROM orders) SELECT o_orderkey, text, CASE WHEN o_orderkey % 5 IN (0, 2, 3) THEN o_orderdate::DATE WHEN o_orderkey % 5 = 1 THEN make_date(year(o_orderdate), 1, 1) END::VARCHAR AS parsed FROM d",
        "q24_date_ranges": "WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y FROM orders) SELECT o_orderkey, y || [' - ', ' to ', '-', '–', '—'][(o_orderkey % 5 + 1)::INT] || CASE WHEN o_orderkey % 3 = 0 THEN 'Present' ELSE (y + 2)::VARCHAR END AS text, make_date(y, 1, 1)::VARCHAR AS start_date, CASE WHEN o_orderkey % 3 <> 0 THEN make_date(y + 2, 1, 1) END::VARCHAR AS end_date, o_orderkey % 3 = 0 AS is_current FROM d",
        "q25_ordered_dedup": rows(f", a AS (SELECT seq, list_transform(list_concat(list_concat(string_split(skills, ','), string_split(upper(skills), ',')), string_split(title, '-')), lambda x: trim(x)) AS l FROM rows WHERE title IS NOT NULL), b AS (SELECT seq, {_some('l')} AS l FROM a), c AS (SELECT seq, {_once('l')} AS items FROM b) SELECT seq, generate_subscripts(items, 1) - 1 AS pos, unnest(items) AS item FROM c"),
        "q26_identity_assign": f"WITH {CASCADE} SELECT seq, rule, group_id FROM g",
        "q27_identity_groups": f"WITH {CASCADE} SELECT * FROM groups_",
        "q28_ambiguous": f"WITH {CASCADE} SELECT group_id, group_key FROM groups_ WHERE rule = 'ambiguous'",
        "q29_no_match": f"WITH {CASCADE} SELECT group_id, group_key FROM groups_ WHERE rule = 'no_match'",
        "q30_survivors": f"WITH {MASTER} SELECT master_candidate_id, full_name, first_name, last_name, headline, mail AS email, tel AS phone, greatest(n_mails - 1, 0) AS more_emails, greatest(n_tels - 1, 0) AS more_phones, n_records FROM m",
        "q31_survivor_skills": f"WITH {MASTER} SELECT 'master::' || group_id AS master_candidate_id, row_number() OVER (PARTITION BY group_id ORDER BY priority, seq, place) - 1 AS pos, skill FROM skill_first",
        "q31_survivor_jobs": f"WITH {MASTER} SELECT 'master::' || group_id AS master_candidate_id, row_number() OVER (PARTITION BY group_id ORDER BY priority, seq) - 1 AS pos, firm AS company_name, job AS title FROM jobs",
        "q32_survivor_location": f"WITH {MASTER} SELECT master_candidate_id, city, state_or_region, country, raw_location FROM m",
        "q33_provenance": f"WITH {MASTER}, v AS (SELECT *, unnest([{{'f': 'full_name', 'v': full_name}}, {{'f': 'headline', 'v': headline}}, {{'f': 'contact.email', 'v': mail}}, {{'f': 'contact.phone', 'v': tel}}, {{'f': 'location.city', 'v': city}}, {{'f': 'location.raw_location', 'v': raw_location}}]) AS u, count(*) OVER (PARTITION BY group_id) AS n FROM g), o AS (SELECT *, row_number() OVER (PARTITION BY group_id, u.f, CASE WHEN u.f LIKE 'contact%' THEN u.v END ORDER BY priority, seq) AS turn FROM v WHERE u.v IS NOT NULL) SELECT 'master::' || group_id AS master_candidate_id, u.f AS field_name, record_id AS source_record_id, source_type, CASE WHEN u.f LIKE 'contact%' THEN 'merged' WHEN (SELECT count(*) FROM g x WHERE x.group_id = o.group_id) > 1 THEN 'conflict_resolution' ELSE 'direct_extraction' END AS method, u.v AS source_value FROM o WHERE turn = 1",
        "q34_provenance_backfill": f"WITH {MASTER}, f AS (SELECT unnest([{{'f': 'full_name', 'n': (full_name IS NOT NULL)::INT, 'm': 'p'}}, {{'f': 'first_name', 'n': (first_name IS NOT NULL)::INT, 'm': 'p'}}, {{'f': 'last_name', 'n': (last_name IS NOT NULL)::INT, 'm': 'p'}}, {{'f': 'headline', 'n': (headline IS NOT NULL)::INT, 'm': 'p'}}, {{'f': 'summary', 'n': 0, 'm': 'p'}}, {{'f': 'contact.email', 'n': n_mails, 'm': 'm'}}, {{'f': 'contact.phone', 'n': n_tels, 'm': 'm'}}, {{'f': 'contact.alternate_emails', 'n': (n_mails > 1)::INT, 'm': 's'}}, {{'f': 'contact.alternate_phones', 'n': (n_tels > 1)::INT, 'm': 's'}}, {{'f': 'contact.linkedin_url', 'n': 0, 'm': 'p'}}, {{'f': 'location.city', 'n': (city IS NOT NULL)::INT, 'm': 'p'}}, {{'f': 'location.state_or_region', 'n': (state_or_region IS NOT NULL)::INT, 'm': 'p'}}, {{'f': 'location.country', 'n': (country IS NOT NULL)::INT, 'm': 'p'}}, {{'f': 'location.postal_code', 'n': 0, 'm': 'p'}}, {{'f': 'location.raw_location', 'n': (raw_location IS NOT NULL)::INT, 'm': 'p'}}, {{'f': 'skills', 'n': len(skills), 'm': 'm'}}, {{'f': 'work_experience', 'n': n_jobs, 'm': 'm'}}, {{'f': 'education', 'n': 0, 'm': 'm'}}, {{'f': 'certifications', 'n': 0, 'm': 'm'}}, {{'f': 'languages', 'n': 0, 'm': 'm'}}]) AS u, n_records FROM m) SELECT u.f AS field_name, CASE WHEN u.n = 0 THEN 'default_value' WHEN u.m = 'm' THEN 'merged' WHEN u.m = 's' OR n_records > 1 THEN 'conflict_resolution' ELSE 'direct_extraction' END AS method, sum(greatest(u.n, 1))::BIGINT AS n FROM f GROUP BY ALL",
        "q35_confidence": f"WITH {SCORED} SELECT master_candidate_id, overall_score, skill_confidence, extraction_reliability_score, source_agreement_score, identity_score, conflict_outcome_score, completeness_score, consistency_score FROM c",
        "q36_projection_default": f"WITH {SCORED} SELECT {_PROJECTED} FROM c",
        "q37_projection_policy": f"WITH {SCORED} SELECT coalesce(tel, 'unlisted') AS telephone, coalesce(headline, '') AS role, coalesce(full_name, '') AS full_name, coalesce(mail, '') AS email, rule AS resolution_rule, overall_score AS confidence_score, master_candidate_id AS candidate_id FROM c",
        "q39_end_to_end": f"WITH {SCORED} SELECT {_PROJECTED}, overall_score AS confidence_score FROM c",
    }
