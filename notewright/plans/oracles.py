"""The queries as plain SQL for DuckDB, to check results against.

Written apart from the Spark code; the two share the fixed values and the arithmetic on keys
that decides how a note is rendered. Steps are materialised: inlined into each other, the chained
replacements would be evaluated over and over. Expected outcomes of model responses are derived from the
gold labels and the way a response was broken, not by parsing it.
"""

from __future__ import annotations

import re

from notewright import fixed_values as fv
from notewright.operators.responses import DEFAULT_INSTRUCTIONS
from notewright.plans import note_values as nv
from notewright.plans.corpus import RESPONSE_KINDS
from notewright.plans.note_fixture import HASH_MODULUS, KEY_MODULUS, MULTIPLIERS
from notewright.plans.queries import EMAIL_RULE, LOADED_AT, MODEL_RUN, OWN_RULES, RULE_RUN
from notewright.schemas import facts_json_schema


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_s(v) for v in values) + "]"


def _draw(slot: str, key: str = "o_orderkey") -> str:
    return f"((({key} % {KEY_MODULUS}) * {MULTIPLIERS[slot]}) % {HASH_MODULUS} // 65536)"


def _pick(slot: str, values) -> str:
    return f"({_list(values)})[1 + {_draw(slot)} % {len(values)}]"


def _stating(slot: str) -> str:
    return ", ".join(str(i) for i, t in enumerate(nv.NOTE_TEMPLATES) if f"{{{slot}}}" in t)


def _filled(template: str) -> str:
    for slot in ("mrn", "dos", "provider", "name", "age", "sex", "dx", "tnm", "bio", "ecog", "meds"):
        template = f"replace({template}, '{{{slot}}}', CAST(x_{slot} AS VARCHAR))"
    return template


_CANCERS = ",\n".join(
    "({}, {}, {}, {}, {}, [{}], {})".format(
        i, _s(diagnosis), _list(wordings), _s(site), _s(histology),
        ", ".join(f"{{'name': {_s(n)}, 'statuses': {_list(s)}}}" for n, s in pool), _list(drugs))
    for i, (diagnosis, wordings, site, histology, pool, drugs) in enumerate(nv.CANCERS)
)

NOTES = f"""
cancers(cancer, diagnosis, wordings, site, hist, pool, drugs) AS (VALUES {_CANCERS}),
drawn AS MATERIALIZED (
  SELECT o_orderkey, o_custkey, o_orderdate, 'NOTE-' || lpad(CAST(o_orderkey AS VARCHAR),
           CAST(greatest(4, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS note_id,
         c.*, {_draw('template')} % 4 AS template, {_draw('tnm_style')} % 100 AS style,
         {_pick('t', nv.T_VALUES)} AS t, {_pick('n', nv.N_VALUES)} AS n,
         {_pick('m', nv.M_VALUES)} AS m, {_pick('stage', nv.STAGE_VALUES)} AS stage,
         {_draw('ecog')} % 4 AS x_ecog,
         1 + {_draw('marker_count')} % least(3, len(pool)) AS n_markers,
         {_draw('marker_start')} % len(pool) AS marker_start,
         {_draw('marker_status')} AS status_draw, {_draw('marker_wording')} AS wording_draw,
         1 + {_draw('med_count')} % 2 AS n_meds, {_draw('med_start')} % len(drugs) AS med_start
  FROM orders JOIN cancers c ON c.cancer = {_draw('cancer')} % 5
),
chosen AS MATERIALIZED (
  SELECT *,
    list_transform((pool || pool)[marker_start + 1 : marker_start + n_markers], lambda p, i:
      {{'name': p.name, 'status': p.statuses[1 + (status_draw + i - 1) % len(p.statuses)]}}) AS markers,
    (drugs || drugs)[med_start + 1 : med_start + n_meds] AS meds
  FROM drawn
),
slots AS MATERIALIZED (
  SELECT *,
    1000000 + o_custkey AS x_mrn, strftime(o_orderdate, '%m/%d/%Y') AS x_dos,
    {_pick('provider', nv.PROVIDERS)} AS x_provider,
    {_pick('first_name', nv.FIRST_NAMES)} || ' ' || {_pick('last_name', nv.LAST_NAMES)} AS x_name,
    38 + {_draw('age')} % 47 AS x_age,
    CASE site WHEN 'breast' THEN 'female' WHEN 'prostate' THEN 'male'
      ELSE {_pick('sex', ('male', 'female'))} END AS x_sex,
    wordings[1 + {_draw('wording')} % len(wordings)] AS x_dx,
    CASE WHEN style < 33 THEN t || ' ' || n || ' ' || m || ', stage ' || stage
         WHEN style < 66 THEN t || n || m || ' (stage ' || stage || ')'
         ELSE 'clinical stage ' || stage END AS x_tnm,
    array_to_string(list_transform(markers, lambda k, i: CASE
      WHEN k.name = 'HER2' AND k.status = 'positive' AND (wording_draw + 37 * (i - 1)) % 100 < 60
        THEN 'HER2 3+'
      WHEN k.name = 'EGFR' AND k.status = 'mutated' AND (wording_draw + 37 * (i - 1)) % 100 < 60
        THEN 'EGFR exon 19 deletion'
      WHEN (wording_draw + 37 * (i - 1)) % 100 < 25 THEN k.name || '(' || k.status || ')'
      ELSE k.name || ' ' || k.status END), ', ') AS x_bio,
    array_to_string(meds, ', ') AS x_meds
  FROM chosen
),
notes AS MATERIALIZED (
  SELECT o_orderkey, note_id, {_filled(f"({_list(nv.NOTE_TEMPLATES)})[1 + template]")} AS text,
    diagnosis AS primary_diagnosis, site AS primary_site, hist AS histology,
    CASE WHEN style < 66 THEN t END AS t, CASE WHEN style < 66 THEN n END AS n,
    CASE WHEN style < 66 THEN m END AS m, stage AS overall_stage,
    CASE WHEN template IN ({_stating('bio')}) THEN markers ELSE [] END AS markers,
    CASE WHEN template IN ({_stating('meds')}) THEN list_sort(meds) ELSE [] END AS meds,
    CASE WHEN template IN ({_stating('ecog')}) THEN CAST(x_ecog AS INTEGER) END AS ecog
  FROM slots
)"""


def _re2(pattern: str, ignore_case: bool = False) -> str:
    return _s(("(?i)" if ignore_case else "") + pattern)


_RULE_NAMES = ("mrn", "mrn_in_parentheses", "date", "provider", "name")


def _redacted(source: str, key: str, rules=fv.REDACTION_RULES, names=_RULE_NAMES) -> str:
    """CTEs that apply the rules one after another and count each one's replacements."""
    steps, previous = [], f"(SELECT {key}, text FROM {source})"
    for (_, pattern, ignore_case, _), name in zip(rules, names):
        lookbehind = re.match(r"\(\?<=([^)]*)\)", pattern)
        kept = ""
        if lookbehind:  # RE2 has none: keep what stands before by a group
            pattern = f"({lookbehind.group(1)})" + pattern[lookbehind.end():]
            kept = r"\1"
        regex = _re2(pattern, ignore_case)
        steps.append(
            f"by_{name} AS MATERIALIZED (SELECT * REPLACE (regexp_replace(text, {regex}, "
            f"{_s(kept + fv.REDACTION_TOKEN)}, 'g') AS text), "
            f"CAST(len(regexp_extract_all(text, {regex})) AS INTEGER) AS {name} FROM {previous})")
        previous = f"by_{name}"
    total = " + ".join(names)
    steps.append(f"deid AS MATERIALIZED (SELECT *, {total} AS redactions FROM {previous})")
    return ",\n".join(steps)


def _first(pattern: str, ignore_case: bool = False) -> str:
    return f"nullif(regexp_extract(text, {_re2(pattern, ignore_case)}, 1), '')"


def _keyword_case(position: int) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower(text), {_s(k)})" for k in group[0])
        + f" THEN {_s(group[position])}" for group in fv.KEYWORD_GROUPS)
    return f"CASE {whens} END"


_MARKER_HITS = ", ".join(
    "CASE WHEN regexp_matches(text, {p}) THEN {{'name': {n}, 'status': "
    "rtrim(regexp_extract(text, {p}, 1), '.')}} END".format(
        p=_re2(re.escape(name) + fv.BIOMARKER_STATUS, True), n=_s(name))
    for name in fv.BIOMARKER_NAMES
)


def _facts(source: str, key: str = "note_id") -> str:
    return f"""facts AS MATERIALIZED (
  SELECT {key}, 'baseline' AS method,
    {_keyword_case(1)} AS primary_diagnosis, {_keyword_case(2)} AS primary_site,
    {_keyword_case(3)} AS histology,
    'T' || {_first(fv.T_PATTERN)} AS t, 'N' || {_first(fv.N_PATTERN)} AS n,
    'M' || {_first(fv.M_PATTERN)} AS m, upper({_first(fv.STAGE_PATTERN, True)}) AS overall_stage,
    list_filter([{_MARKER_HITS}], lambda h: h IS NOT NULL) AS markers,
    list_sort(list_filter({_list(fv.MEDICATIONS)},
      lambda d: contains(lower(text), lower(d)))) AS meds,
    CAST({_first(fv.ECOG_PATTERN, True)} AS INTEGER) AS ecog
  FROM {source}
)"""


_DEID = f"{NOTES},\n{_redacted('notes', 'note_id')}"
_RULES = f"{_DEID},\n{_facts('deid')}"

_VALID_KINDS = ("plain", "fenced", "fenced_json", "ecog_text", "upper_case", "keys_left_out",
                "bad_domain", "extra_members", "plain_member", "null_stage", "odd_text")
_KIND = f"({_list(RESPONSE_KINDS)})[1 + {_draw('response')} % {len(RESPONSE_KINDS)}]"

# what a prediction must be, by the way its response is written; ecog is its JSON text
_MODEL = f"""kinds AS MATERIALIZED (SELECT *, {_KIND} AS kind FROM notes),
model AS MATERIALIZED (
  SELECT note_id, CASE WHEN ok THEN 'claude' ELSE 'claude_error' END AS method,
    CASE WHEN ok THEN CASE kind WHEN 'upper_case' THEN upper(primary_diagnosis)
      WHEN 'odd_text' THEN '  ' || primary_diagnosis || chr(10) || 'second line  '
      ELSE primary_diagnosis END END AS primary_diagnosis,
    CASE WHEN ok THEN CASE kind WHEN 'upper_case' THEN upper(primary_site)
      WHEN 'bad_domain' THEN '' ELSE primary_site END END AS primary_site,
    CASE WHEN ok AND kind <> 'keys_left_out' THEN CASE kind WHEN 'upper_case'
      THEN upper(histology) ELSE histology END END AS histology,
    CASE WHEN staged THEN t END AS t, CASE WHEN staged THEN n END AS n, CASE WHEN staged THEN m END AS m,
    CASE WHEN staged THEN CASE kind WHEN 'bad_domain' THEN 'IIIC' ELSE overall_stage END END
      AS overall_stage, NOT staged AS no_stage,
    CASE WHEN ok AND kind <> 'keys_left_out' THEN CASE kind WHEN 'plain_member'
      THEN list_append(markers, {{'name': NULL, 'status': NULL}}) ELSE markers END END AS markers,
    CASE WHEN kind = 'extra_members' THEN CAST(len(markers) AS INTEGER) ELSE 0 END AS with_method,
    CASE WHEN ok THEN meds END AS meds,
    CASE WHEN ok THEN ecog END AS ecog,
    CASE WHEN ok AND ecog IS NOT NULL THEN CASE kind WHEN 'ecog_text' THEN '"' || ecog || '"'
      ELSE CAST(ecog AS VARCHAR) END END AS ecog_json,
    CASE WHEN ok THEN 400 + {_draw('tokens_in')} % 800 ELSE 0 END AS input_tokens,
    CASE WHEN ok THEN 60 + {_draw('tokens_out')} % 200 ELSE 0 END AS output_tokens
  FROM (SELECT *, kind IN ({", ".join(map(_s, _VALID_KINDS))}) AS ok, ok AND kind <> 'null_stage' AS staged
    FROM kinds)
)"""

_ANSWERS = """written AS MATERIALIZED (
  SELECT note_id, kind, '{"primary_diagnosis": "' ||
      CASE kind WHEN 'upper_case' THEN upper(primary_diagnosis)
        WHEN 'odd_text' THEN '  ' || primary_diagnosis || '\\nsecond line  ' ELSE primary_diagnosis END ||
      '", "primary_site": "' || CASE kind WHEN 'upper_case' THEN upper(primary_site)
        WHEN 'bad_domain' THEN '' ELSE primary_site END ||
      '", "tnm_stage": ' || CASE kind WHEN 'null_stage' THEN 'null' ELSE
        '{"t": ' || coalesce('"' || t || '"', 'null') ||
        ', "n": ' || coalesce('"' || n || '"', 'null') ||
        ', "m": ' || coalesce('"' || m || '"', 'null') || ', "overall_stage": "' ||
        CASE kind WHEN 'bad_domain' THEN 'IIIC' ELSE overall_stage END || '"}' END ||
      CASE kind WHEN 'keys_left_out' THEN '' ELSE ', "histology": "' ||
        CASE kind WHEN 'upper_case' THEN upper(histology) ELSE histology END ||
        '", "biomarkers": [' || coalesce(array_to_string(list_transform(markers, lambda k:
          '{"name": "' || k.name || '", "status": "' || k.status ||
          CASE kind WHEN 'extra_members' THEN '", "method": "IHC"}' ELSE '"}' END), ', '), '') ||
          CASE kind WHEN 'plain_member' THEN CASE WHEN len(markers) > 0 THEN ', ' ELSE '' END || '"PTEN"'
            ELSE '' END || ']' END ||
      ', "medications": [' ||
        coalesce(array_to_string(list_transform(meds, lambda d: '"' || d || '"'), ', '), '') ||
      '], "ecog_performance_status": ' || coalesce(CASE kind WHEN 'ecog_text'
        THEN '"' || ecog || '"' ELSE CAST(ecog AS VARCHAR) END, 'null') || '}' AS body
  FROM kinds WHERE kind <> 'no_response'
),
answers AS MATERIALIZED (
  SELECT note_id,
    CASE kind WHEN 'fenced' THEN '```' || chr(10) || body || chr(10) || '```'
      WHEN 'fenced_json' THEN chr(10) || '```json' || chr(10) || body || chr(10) || '```' || chr(10)
      WHEN 'prose' THEN 'The note could not be read.'
      WHEN 'tail' THEN body || chr(10) || chr(10) || 'Ask if more is needed.'
      WHEN 'array' THEN '[' || body || ']'
      WHEN 'two_objects' THEN body || ' ' || body
      ELSE body END AS text,
    CASE kind WHEN 'prose' THEN 'The note could not be read.'
      WHEN 'tail' THEN body || chr(10) || chr(10) || 'Ask if more is needed.'
      WHEN 'array' THEN '[' || body || ']'
      WHEN 'two_objects' THEN body || ' ' || body
      ELSE body END AS answer
  FROM written
)"""
_ALL = f"{_RULES},\n{_MODEL}"

_MARKERS = ("coalesce(array_to_string(list_transform(markers, lambda k: coalesce(k.name || '=' || k.status, '')),"
            " ';'), '')")
_MEDS = "coalesce(array_to_string(meds, ','), '')"

# --- scoring ------------------------------------------------------------------------------


def _side(system: str, source: str, ecog: str = "'n:' || ecog") -> str:
    """The scored values of one side in long form: (system, note_id, field, item)."""
    scalars = " UNION ALL ".join(
        f"SELECT {_s(system)}, note_id, {_s(f)}, lower(trim({f})) FROM {source}"
        for f in ("primary_diagnosis", "primary_site", "histology"))
    stages = " UNION ALL ".join(
        f"SELECT {_s(system)}, note_id, 'tnm_stage', {_s(c)} || lower({c}) FROM {source}"
        for c in ("t", "n", "m", "overall_stage"))
    return f"""{scalars}
  UNION ALL SELECT {_s(system)}, note_id, 'ecog_performance_status', {ecog} FROM {source}
  UNION ALL {stages}
  UNION ALL SELECT {_s(system)}, note_id, 'biomarkers', coalesce(lower(u.k.name) || '|' || lower(u.k.status), 'plain')
    FROM {source}, unnest(markers) AS u(k)
  UNION ALL SELECT {_s(system)}, note_id, 'medications', lower(u.d) FROM {source}, unnest(meds) AS u(d)"""


def _counts(*systems: str) -> str:
    """Counts by system and field. A scalar is a set of at most one item, so one rule serves."""
    sides = {
        "rules": _side("rules", "facts"),
        "model": _side("model", "model",
                       "CASE WHEN ecog_json LIKE '\"%' THEN 's:' || ecog ELSE 'n:' || ecog END"),
    }
    return f"""gold_items(system, note_id, field, item) AS MATERIALIZED (
  SELECT DISTINCT * FROM ({_side('gold', 'notes')}) AS side(system, note_id, field, item) WHERE item IS NOT NULL),
pred_items(system, note_id, field, item) AS MATERIALIZED (
  SELECT DISTINCT * FROM ({' UNION ALL '.join(sides[s] for s in systems)})
    AS side(system, note_id, field, item) WHERE item IS NOT NULL),
systems(ord, system) AS (VALUES {', '.join(f"({i}, {_s(s)})" for i, s in enumerate(systems))}),
n_gold AS (SELECT field, count(*) AS n FROM gold_items GROUP BY field),
n_pred AS (SELECT system, field, count(*) AS n FROM pred_items GROUP BY system, field),
n_hit AS (SELECT p.system, p.field, count(*) AS n FROM pred_items p
  JOIN gold_items g USING (note_id, field, item) GROUP BY p.system, p.field),
counts AS (
  SELECT ord, s.system, g.field, coalesce(h.n, 0) AS tp,
    coalesce(p.n, 0) - coalesce(h.n, 0) AS fp, g.n - coalesce(h.n, 0) AS fn
  FROM systems s, n_gold g
  LEFT JOIN n_pred p ON p.system = s.system AND p.field = g.field
  LEFT JOIN n_hit h ON h.system = s.system AND h.field = g.field
),
report AS (
  SELECT ord, system, field, tp, fp, fn, 0 AS is_total FROM counts
  UNION ALL SELECT ord, system, 'MICRO-AVG', sum(tp), sum(fp), sum(fn), 1 FROM counts
    GROUP BY ord, system
),
scored AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r,
    CASE WHEN tp = 0 THEN 0.0 ELSE 2 * (tp / (tp + fp)) * (tp / (tp + fn))
      / (tp / (tp + fp) + tp / (tp + fn)) END AS f1
  FROM (SELECT ord, system, field, is_total, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
    CAST(fn AS BIGINT) AS fn FROM report)
)"""


_REPORT = """SELECT system, field, tp, fp, fn, round(p, 9) AS p, round(r, 9) AS r,
  round(f1, 9) AS f1,
  CAST(row_number() OVER (PARTITION BY system ORDER BY is_total, field) AS INTEGER) AS line
FROM scored"""

_LABELS = """ruled AS (
  SELECT doc_id, CAST(n_chars >= 200 AS INTEGER) AS quality,
    CAST(contains(lower(text), 'hate') AS INTEGER) AS toxic
  FROM documents WHERE lang IN ('en', 'de', 'fr')),
pairs AS (
  SELECT 'quality' AS field, l.quality AS g, r.quality AS p FROM labels l LEFT JOIN ruled r USING (doc_id)
  UNION ALL SELECT 'toxic', l.toxic, r.toxic FROM labels l LEFT JOIN ruled r USING (doc_id)),
counts AS (
  SELECT 0 AS ord, 'rule' AS system, field, count(*) FILTER (g = p) AS tp,
    count(*) FILTER (p IS NOT NULL AND g IS DISTINCT FROM p) AS fp,
    count(*) FILTER (g IS NOT NULL AND g IS DISTINCT FROM p) AS fn
  FROM pairs GROUP BY field)"""
_LABELS_SCORED = _counts("rules")[_counts("rules").index("report AS ("):]

# --- gate ---------------------------------------------------------------------------------


def _verdict(predictions: str, notes: str) -> str:
    leak = " OR ".join(
        f"regexp_matches(text, {_re2(p, ignore_case)})" for p, ignore_case, _ in fv.LEAK_PATTERNS)
    bad = f"overall_stage NOT IN ({', '.join(map(_s, fv.VALID_STAGES))})"
    return f"""fill AS (SELECT avg(CASE WHEN primary_site <> '' THEN 1.0 ELSE 0.0 END) AS v
  FROM {predictions}),
bad AS (SELECT count(*) AS v FROM {predictions} WHERE {bad}),
worst AS (SELECT coalesce(string_agg(note_id, ',' ORDER BY note_id), '') AS ids FROM (
  SELECT note_id FROM {predictions} WHERE {bad} ORDER BY note_id LIMIT 3)),
leaks AS (SELECT count(*) AS v FROM {notes} WHERE {leak}),
unkeyed AS (SELECT count(*) AS v FROM {predictions} WHERE note_id IS NULL)
SELECT 'site_fill_rate' AS "check", round(v, 9) AS value, {fv.MIN_SITE_FILL_RATE}::DOUBLE AS threshold,
  v >= {fv.MIN_SITE_FILL_RATE} AS passed, '' AS sample FROM fill
UNION ALL SELECT 'invalid_stage', v::DOUBLE, 0.0, v = 0, ids FROM bad, worst
UNION ALL SELECT 'residual_identifiers', v::DOUBLE, 0.0, v = 0, '' FROM leaks
UNION ALL SELECT 'missing_note_id', v::DOUBLE, 0.0, v = 0, '' FROM unkeyed"""


_LEAK = " OR ".join(
    f"regexp_matches(text, {_re2(p, ignore_case)})" for p, ignore_case, _ in fv.LEAK_PATTERNS)

# --- landing and marts --------------------------------------------------------------------

_LANDED = f"""landed AS MATERIALIZED (
  SELECT {_s(RULE_RUN)} AS run_id, note_id, method, primary_diagnosis, primary_site, histology,
    t, n, m, overall_stage, markers, meds, ecog, false AS no_stage, 0 AS with_method FROM facts
  UNION ALL SELECT {_s(MODEL_RUN)}, note_id, method, primary_diagnosis, primary_site, histology,
    t, n, m, overall_stage, markers, meds, ecog, no_stage, with_method FROM model),
codes(primary_site, icdo3_code, icdo3_label) AS (
  VALUES {', '.join('(' + ', '.join(map(_s, row)) + ')' for row in fv.SITE_CODES)})"""
_GROUP = "CASE {} ELSE {} END".format(
    " ".join(f"WHEN overall_stage IN ({', '.join(map(_s, stages))}) THEN {_s(group)}"
             for stages, group in fv.STAGE_GROUPS), _s(fv.STAGE_GROUP_OTHER))
_STAMP = _s(str(LOADED_AT))
_FCT = f"""{_ALL}, {_LANDED},
fct AS MATERIALIZED (SELECT note_id, run_id, primary_site, icdo3_code, icdo3_label, primary_diagnosis, histology,
    overall_stage, t AS t_category, n AS n_category, m AS m_category,
    ecog AS ecog_performance_status, {_GROUP} AS stage_group, method, {_STAMP} AS loaded_at
  FROM landed LEFT JOIN codes USING (primary_site)),
dim AS MATERIALIZED (SELECT note_id, primary_site, u.k.name AS biomarker_name, u.k.status AS biomarker_status
  FROM landed, unnest(markers) AS u(k))"""
_HER2 = """primary_site = 'breast' AND biomarker_name = 'HER2' AND biomarker_status = 'positive'"""

_SCALARS = "primary_diagnosis, primary_site, histology, t, n, m, overall_stage"
_PROMPT_HEAD = fv.PROMPT_FRAME.replace("{schema}", facts_json_schema()).split("{note}")[0]
_PROMPT = f"{_s(_PROMPT_HEAD)} || text || {_s(fv.PROMPT_FRAME.split('{note}')[1])}"
_ASSEMBLED = (f"note_id, {{}} AS method, primary_site, overall_stage, {_MARKERS} AS biomarkers, "
              f"{_MEDS} AS medications, ecog AS ecog_performance_status")

_PARSED = f"""WITH {_ALL}
SELECT note_id, method, {_SCALARS},
  CASE WHEN markers IS NOT NULL THEN {_MARKERS} END AS biomarkers,
  CASE WHEN meds IS NOT NULL THEN {_MEDS} END AS medications, ecog_json AS ecog, with_method,
  input_tokens, output_tokens FROM model"""

_GIVEN = """given AS MATERIALIZED (
  SELECT 'd' || doc_id AS note_id, text FROM documents
  UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations
  UNION ALL SELECT 'p' || page_id, html FROM pages)"""
_GIVEN_RULES = tuple((r.label, r.pattern, r.ignore_case, None) for r in (EMAIL_RULE, *OWN_RULES))

ORACLES: dict[str, str] = {
    "deid_given": f"WITH {_GIVEN}, " + _redacted(
        "given", "note_id", (*fv.REDACTION_RULES, *_GIVEN_RULES), (*_RULE_NAMES, "emails", "codes", "secrets"),
    ) + " SELECT note_id, md5(text) AS text_md5, emails, codes, secrets, redactions FROM deid",
    "facts_given": f"""WITH {_GIVEN}, {_facts('given')}
SELECT note_id, primary_site, t, n, m, overall_stage, {_MARKERS} AS biomarkers, {_MEDS} AS medications,
  ecog AS ecog_performance_status FROM facts""",
    "gate_given": f"WITH {_GIVEN}, {_facts('given')}, {_verdict('facts', 'given')}",
    "notes_rendered": f"WITH {NOTES} SELECT note_id, text, {_SCALARS}, "
                      "ecog AS ecog_performance_status FROM notes",
    "gold_long": f"""WITH {NOTES}
SELECT note_id, CAST(u.i - 1 AS INTEGER) AS pos, 'biomarker' AS kind, markers[u.i].name AS name,
  markers[u.i].status AS status FROM notes, unnest(range(1, len(markers) + 1)) AS u(i)
UNION ALL SELECT note_id, CAST(u.i - 1 AS INTEGER), 'medication', meds[u.i], ''
FROM notes, unnest(range(1, len(meds) + 1)) AS u(i)""",
    "deid_text": f"WITH {_DEID} SELECT note_id, text FROM deid",
    "deid_counts": f"WITH {_DEID} SELECT note_id, {', '.join(_RULE_NAMES)}, redactions FROM deid",
    "deid_stats": f"""WITH {_DEID}
SELECT count(*) AS notes, CAST(sum(redactions) AS BIGINT) AS redactions,
  round(sum(redactions) / greatest(count(*), 1), 9) AS redactions_per_note FROM deid""",
    "deid_custom_rule": "WITH " + _redacted(
        "documents", "doc_id",
        (*fv.REDACTION_RULES, (EMAIL_RULE.label, EMAIL_RULE.pattern, False, None)),
        (*_RULE_NAMES, "emails"),
    ) + " SELECT doc_id, md5(text) AS text_md5, emails, redactions FROM deid",
    "facts_scalar": f"WITH {_RULES} SELECT note_id, {_SCALARS}, ecog AS ecog_performance_status "
                    "FROM facts",
    "facts_biomarkers": f"WITH {_RULES} SELECT note_id, u.k.name AS name, u.k.status AS status "
                        "FROM facts, unnest(markers) AS u(k)",
    "biomarker_false_hits": f"WITH {_facts('documents', 'doc_id')} SELECT doc_id, u.k.name AS name, "
                            "u.k.status AS status FROM facts, unnest(markers) AS u(k)",
    "facts_meds": f"WITH {_RULES} SELECT note_id, u.d AS medication "
                  "FROM facts, unnest(meds) AS u(d)",
    "facts_plugged": f"WITH {_RULES} SELECT note_id, u.d AS medication "
                     "FROM facts, unnest(meds) AS u(d)",
    "facts_indexed": f"WITH {_RULES} SELECT note_id, primary_diagnosis, primary_site, histology, "
                     f"{_MEDS} AS medications FROM facts",
    "facts_assembled": f"WITH {_RULES} SELECT {_ASSEMBLED.format('method')} FROM facts",
    "model_offline": f"WITH {_RULES} SELECT {_ASSEMBLED.format(_s(fv.METHOD_OFFLINE))} FROM facts",
    "prompts": f"""WITH {_DEID} SELECT note_id, md5({_s(DEFAULT_INSTRUCTIONS)}) AS system_md5,
  md5({_PROMPT}) AS prompt_md5, CAST(length({_PROMPT}) AS INTEGER) AS prompt_length FROM deid""",
    "responses_joined": f"""WITH {_ALL}, {_ANSWERS}
SELECT note_id, md5(text) AS text_md5, md5(answer) AS body_md5 FROM answers""",
    "responses_parsed": _PARSED,
    "responses_repeated": _PARSED,
    "usage_cost": f"""WITH {_ALL},
used AS (SELECT count(*) AS notes, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
  CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM model),
priced AS (SELECT *, input_tokens / 1e6 * {fv.PRICE_IN_PER_MTOK}
  + output_tokens / 1e6 * {fv.PRICE_OUT_PER_MTOK} AS cost FROM used)
SELECT notes, input_tokens, output_tokens, round(cost, 6) AS cost,
  round(cost / greatest(notes, 1), 6) AS cost_per_note FROM priced""",
    "gate_clean": f"WITH {_RULES}, {_verdict('facts', 'deid')}",
    "gate_broken": f"WITH {_ALL}, {_verdict('model', 'notes')}",
    "leak_scan": f"""SELECT source, count(*) AS notes, count(*) FILTER ({_LEAK}) AS leaks FROM (
  SELECT 'documents' AS source, text FROM documents
  UNION ALL SELECT 'conversations', text FROM conversations
  UNION ALL SELECT 'pages', html FROM pages) GROUP BY source""",
    "last_record_wins": f"""WITH {_RULES},
keyed AS MATERIALIZED (SELECT f.*, n.o_orderkey AS k FROM facts f JOIN notes n USING (note_id)),
versions AS (
  SELECT note_id, 0 AS seq, primary_site FROM keyed
  UNION ALL SELECT note_id, 1, 'second' FROM keyed WHERE k % 5 = 0
  UNION ALL SELECT note_id, 2, 'third' FROM keyed WHERE k % 3 = 0
  UNION ALL SELECT 'NOTE-REPEATED', k, primary_site FROM keyed WHERE k % 4 <> 0)
SELECT note_id, primary_site FROM versions
QUALIFY row_number() OVER (PARTITION BY note_id ORDER BY seq DESC) = 1""",
    "eval_fields": f"""WITH {_RULES}, {_counts('rules')}
SELECT system, field, tp, fp, fn, round(p, 9) AS p, round(r, 9) AS r, round(f1, 9) AS f1
FROM scored WHERE is_total = 0""",
    "eval_report": f"WITH {_ALL}, {_counts('model', 'rules')} {_REPORT}",
    "eval_head_to_head": f"""WITH {_ALL}, {_counts('model', 'rules')}
SELECT CAST(row_number() OVER (ORDER BY f1 DESC, ord) AS INTEGER) AS rank, system,
  round(f1, 9) AS f1 FROM scored WHERE is_total = 1""",
    "eval_labels": f"WITH {_LABELS}, {_LABELS_SCORED} {_REPORT}",
    "landing_roundtrip": f"""WITH {_ALL}, {_LANDED}
SELECT run_id, note_id, method, primary_diagnosis, primary_site, histology, overall_stage,
  markers IS NULL AS no_biomarkers, no_stage, with_method, CAST(coalesce(len(meds), 0) AS INTEGER) AS medications,
  ecog AS ecog_performance_status, {_STAMP} AS loaded_at FROM landed""",
    "landing_csv": f"""WITH {_ALL}, {_LANDED} SELECT run_id, note_id, method, {_SCALARS.replace('primary_site', "nullif(primary_site, '') AS primary_site")},
  CASE WHEN markers IS NOT NULL THEN {_MARKERS} END AS biomarkers,
  CASE WHEN meds IS NOT NULL THEN {_MEDS} END AS medications, ecog AS ecog_performance_status FROM landed""",
    "eval_from_files": f"""WITH {_ALL}, {_counts('model')}
SELECT system, field, tp, fp, fn, round(p, 9) AS p, round(r, 9) AS r, round(f1, 9) AS f1
FROM scored WHERE is_total = 0""",
    "jsonl_roundtrip": f"""WITH {NOTES} SELECT note_id, md5(text) AS text_md5, primary_site, t, n, m,
  overall_stage, {_MARKERS} AS biomarkers, {_MEDS} AS medications,
  ecog AS ecog_performance_status FROM notes""",
    "stg_extractions": f"""WITH {_ALL}, {_LANDED}
SELECT note_id, run_id, method, primary_diagnosis, primary_site, histology, t AS t_category,
  n AS n_category, m AS m_category, overall_stage, ecog AS ecog_performance_status,
  CASE WHEN meds IS NOT NULL THEN {_MEDS} END AS medications FROM landed""",
    "fct_diagnoses": f"WITH {_FCT} SELECT * FROM fct",
    "dim_biomarkers": f"WITH {_FCT} SELECT * FROM dim",
    "cohort_her2_breast": f"""WITH {_FCT}
SELECT count(DISTINCT note_id) AS cases FROM dim WHERE {_HER2}""",
    "cohort_stage3_her2_trastuzumab": f"""WITH {_FCT}
SELECT note_id, run_id, icdo3_code, overall_stage, stage_group FROM fct
WHERE primary_site = 'breast' AND overall_stage LIKE 'III%'
  AND EXISTS (SELECT 1 FROM landed l, unnest(l.markers) AS u(k) WHERE l.note_id = fct.note_id
    AND l.run_id = fct.run_id AND u.k.name = 'HER2' AND u.k.status = 'positive')
  AND EXISTS (SELECT 1 FROM landed l WHERE l.note_id = fct.note_id AND l.run_id = fct.run_id
    AND list_contains(l.meds, 'trastuzumab'))""",
    "stage_groups": f"""WITH {_RULES},
codes(primary_site, icdo3_code, icdo3_label) AS (
  VALUES {', '.join('(' + ', '.join(map(_s, row)) + ')' for row in fv.SITE_CODES)})
SELECT icdo3_code, {_GROUP} AS stage_group, count(*) AS notes
FROM facts LEFT JOIN codes USING (primary_site) GROUP BY ALL""",
    "batch_run": f"WITH {_FCT} SELECT * FROM fct WHERE run_id = {_s(RULE_RUN)}",
    "batch_resumed": f"""WITH {_FCT},
runs AS (SELECT unnest([{_s(RULE_RUN)}, {_s(MODEL_RUN)}]) AS run_id),
own AS (SELECT * FROM landed WHERE run_id = {_s(RULE_RUN)})
SELECT 'fct_diagnoses' AS mart, runs.run_id, stage_group, icdo3_code, count(*) AS rows
FROM fct, runs WHERE fct.run_id = {_s(RULE_RUN)} GROUP BY ALL
UNION ALL SELECT 'dim_biomarkers', NULL, u.k.name, u.k.status, count(*)
FROM own, unnest(markers) AS u(k), runs GROUP BY ALL""",
    "batch_statistics": f"""WITH {_DEID}
SELECT {_s(RULE_RUN)} AS run_id, count(*) AS notes, CAST(sum(redactions) AS BIGINT) AS redactions,
  round(sum(redactions) / greatest(count(*), 1), 9) AS redactions_per_note FROM deid""",
    "landing_checked": f"""WITH {_RULES} SELECT {_s(RULE_RUN + '-000000')} AS run_id, note_id, method,
  primary_site, overall_stage, ecog AS ecog_performance_status FROM facts""",
    "landing_incremental": f"""WITH {_RULES} SELECT {_s(RULE_RUN)} AS run_id, note_id, method,
  primary_site, overall_stage, ecog AS ecog_performance_status FROM facts""",
}
