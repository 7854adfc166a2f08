"""SQL for DuckDB: the fixtures and rules once more, written without the package."""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id, user_id, event_type, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
  FROM events)"""

RAW = f"""{EV},
raw AS (
  SELECT user_id % 10 AS source_ord, event_id AS rec_ord, k,
    CASE WHEN event_id % 2 = 0 THEN 'Program  ' || user_id ELSE 'PROGRAM ' || user_id END AS program_name,
    CASE WHEN k % 11 = 0 THEN NULL ELSE CASE event_type WHEN 'signup' THEN 'federal'
      WHEN 'view' THEN 'state' WHEN 'click' THEN 'county' WHEN 'error' THEN 'city'
      WHEN 'purchase' THEN 'utility' END END AS level,
    CASE event_id % 9 WHEN 0 THEN 'tax_credit' WHEN 1 THEN 'grant' WHEN 2 THEN 'rebate'
      WHEN 3 THEN 'loan' WHEN 4 THEN 'financing' WHEN 5 THEN 'exemption'
      WHEN 6 THEN 'subsidy' WHEN 7 THEN 'investment' END AS type,
    CASE event_id % 6 WHEN 0 THEN 'fixed_dollar' WHEN 1 THEN 'percentage' WHEN 2 THEN 'per_unit'
      WHEN 3 THEN 'up_to' WHEN 4 THEN 'tiered' END AS amount_type,
    CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN floor(value) WHEN 2 THEN value * 1000 ELSE value END AS amount_value,
    CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 0.0::DOUBLE ELSE value * 10 END AS amount_max,
    CASE WHEN k % 5 = 0 THEN 'about ' || k || ' dollars' END AS amount_text,
    CAST(k AS DOUBLE) / 100 AS confidence_score,
    CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS requires_homeownership,
    CASE WHEN k % 4 = 0 THEN true END AS income_required,
    CASE k % 8 WHEN 0 THEN 80.0::DOUBLE WHEN 4 THEN 33.3333333::DOUBLE END AS income_limit_pct_ami,
    CASE WHEN k % 2 = 0 THEN ['sfh','condo','sfh'] ELSE []::VARCHAR[] END AS eligible_property_types,
    CASE WHEN k % 3 = 0 THEN ['roof','hvac','roof'] ELSE []::VARCHAR[] END AS eligible_project_types,
    CASE WHEN k % 10 = 0 THEN ['33603','33602'] ELSE []::VARCHAR[] END AS zip_codes,
    CASE WHEN k % 4 = 3 THEN NULL ELSE 'fl' END AS state,
    CASE k % 6 WHEN 0 THEN 'North County' WHEN 1 THEN 'South' END AS county,
    CASE WHEN k % 6 = 2 THEN 'Springfield' END AS city,
    CASE WHEN k % 6 = 3 THEN 'Acme Power' END AS utility_provider,
    CASE k % 9 WHEN 0 THEN 'instant REBATE' WHEN 1 THEN 'open space only' WHEN 2 THEN 'matching grant'
      WHEN 3 THEN 'tax-free' WHEN 4 THEN 'low loan' WHEN 5 THEN '' END AS eligibility_notes,
    CASE WHEN k % 6 = 5 THEN NULL ELSE trim(d.text, E' \\n\\t\\r') END AS description,
    CASE event_id % 5 WHEN 0 THEN 'https://apply.example.org/a' WHEN 1 THEN 'Example.COM/apply'
      WHEN 2 THEN '/relative' WHEN 3 THEN 'not a url' END AS application_url,
    CASE WHEN k = 99 THEN '' ELSE 'https://src' || user_id || '.example.org/p' END AS source_url,
    CASE k % 5 WHEN 0 THEN '2030-12-31' WHEN 1 THEN 'Permanent' WHEN 2 THEN 'Unknown' WHEN 3 THEN '' END AS expires_at,
    'Admin ' || (user_id % 10) AS program_administrator,
    CASE WHEN k % 2 = 0 THEN '2026-01-15' END AS last_verified_at,
    event_id, user_id
  FROM ev LEFT JOIN documents d ON d.doc_id = event_id % (SELECT count(*) FROM documents))"""


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def money(v: str) -> str:
    return (
        f"CASE WHEN abs({v} - trunc({v})) < 1e-9 THEN format('{{:,}}', CAST(trunc({v}) AS BIGINT)) "
        f"ELSE format('{{:,.2f}}', {v}) END"
    )


def sorted_list(items: str, separator: str) -> str:
    return f"array_to_string(list_sort(list_distinct({items})), '{separator}')"


def key_columns(alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    return (
        f"{collapse(f'lower({dot}program_name)')}, coalesce({dot}level, ''), "
        f"{collapse(f'lower(coalesce({dot}program_administrator, chr(32)))')}"
    )


def unique_rows(raw: str = "raw", name: str = "uniq") -> str:
    return f"""{name} AS (
  SELECT * FROM {raw}
  QUALIFY row_number() OVER (PARTITION BY {key_columns()} ORDER BY source_ord, rec_ord) = 1)"""


AMOUNT = f"""CASE WHEN amount_type IS NOT NULL AND amount_value IS NOT NULL THEN
      CASE amount_type
        WHEN 'percentage' THEN ({money('amount_value')}) || '%' ||
          CASE WHEN coalesce(amount_max, 0) <> 0 THEN ' (up to $' || ({money('amount_max')}) || ')' ELSE '' END
        WHEN 'fixed_dollar' THEN '$' || ({money('amount_value')})
        WHEN 'up_to' THEN 'Up to $' || ({money('amount_value')})
        WHEN 'per_unit' THEN '$' || ({money('amount_value')}) || ' per unit'
        ELSE coalesce(nullif(amount_text, ''), 'Tiered (see eligibility notes)') END
    ELSE trim(coalesce(amount_text, '')) END"""

STATE = "CASE WHEN level = 'federal' THEN 'USA' ELSE coalesce(upper(nullif(state, '')), 'FL') END"
CITY = """CASE level WHEN 'federal' THEN 'Federal' WHEN 'state' THEN 'Statewide'
      WHEN 'county' THEN CASE WHEN coalesce(nullif(county, ''), 'Hillsborough County') LIKE '%County'
        THEN coalesce(nullif(county, ''), 'Hillsborough County') ELSE county || ' County' END
      WHEN 'city' THEN coalesce(nullif(city, ''), 'Tampa')
      WHEN 'utility' THEN coalesce(nullif(utility_provider, ''), 'Utility') || ' territory'
      ELSE coalesce(nullif(city, ''), nullif(county, ''), 'Statewide') END"""
PROPERTY = f"""CASE WHEN len(eligible_property_types) = 0 THEN 'All'
      ELSE upper({sorted_list('eligible_property_types', '; ')}) END"""
CONDITIONS = f"""concat_ws(' | ',
      CASE WHEN requires_homeownership THEN 'Owner-occupied required' END,
      CASE WHEN income_required THEN CASE WHEN coalesce(income_limit_pct_ami, 0) <> 0
        THEN 'Income-qualified (≤ ' || format('{{:g}}', income_limit_pct_ami) || '% AMI)'
        ELSE 'Income-qualified' END END,
      CASE WHEN len(eligible_project_types) > 0
        THEN 'Eligible projects: ' || {sorted_list('eligible_project_types', ', ')} END,
      CASE WHEN len(zip_codes) > 0 THEN 'ZIP codes: ' || {sorted_list('zip_codes', ', ')} END,
      nullif(trim(eligibility_notes), ''),
      CASE WHEN coalesce(program_administrator, '') <> '' THEN 'Administered by: ' || program_administrator END)"""


def shorten(x: str, limit: int = 600) -> str:
    text = collapse(x)
    return (
        f"CASE WHEN length({text}) <= {limit} THEN {text} "
        f"ELSE rtrim(substr({text}, 1, {limit - 1})) || '…' END"
    )


DESCRIPTION = f"""CASE WHEN coalesce(description, '') <> '' THEN {shorten('description')}
      WHEN coalesce(eligibility_notes, '') <> '' THEN {shorten('eligibility_notes')}
      ELSE program_name END"""
_WORDS = (
    "lower(coalesce(description, '') || ' ' || coalesce(eligibility_notes, '') "
    "|| ' ' || coalesce(amount_text, ''))"
)
KNOWN_TYPE = f"""CASE WHEN type IN ('tax_credit', 'exemption') THEN 'Tax Credits'
      WHEN type IN ('grant', 'subsidy') THEN 'Grants' WHEN type = 'rebate' THEN 'Rebates'
      WHEN type IN ('loan', 'financing') THEN 'Finance Solutions'
      WHEN type = 'investment' THEN 'Investments'
      WHEN contains({_WORDS}, 'tax credit') OR contains({_WORDS}, 'tax exemption')
        OR contains({_WORDS}, 'tax-free') THEN 'Tax Credits'
      WHEN contains({_WORDS}, 'rebate') THEN 'Rebates'
      WHEN contains({_WORDS}, 'loan') OR contains({_WORDS}, 'financing')
        OR contains({_WORDS}, 'pace') THEN 'Finance Solutions'
      WHEN contains({_WORDS}, 'grant') THEN 'Grants' END"""
STATED = "coalesce(nullif(trim(expires_at), ''), 'Unknown')"
VALID_UNTIL = f"""CASE WHEN lower({STATED}) IN ('ongoing', 'permanent', 'indefinite', 'evergreen') THEN 'Ongoing'
      WHEN {STATED} = 'Unknown' AND coalesce(level, '') <> 'federal' THEN 'Ongoing' ELSE {STATED} END"""


def absolute(x: str) -> str:
    text = collapse(x)
    return f"""CASE WHEN regexp_matches({text}, '^(?i)https?://') THEN
        CASE WHEN regexp_matches({text}, '^(?i)https?://[^/?#]') THEN {text} END
      WHEN contains({text}, ' ') OR length({text}) < 4 OR starts_with({text}, '/')
        OR NOT contains(split_part({text}, '/', 1), '.') OR regexp_matches({text}, '^[?#]') THEN NULL
      ELSE 'https://' || {text} END"""


LINK = (
    f"coalesce({absolute('application_url')}, {absolute('source_url')}, "
    "trim(coalesce(source_url, '')))"
)


def final_rows(uniq: str = "uniq", name: str = "final") -> str:
    """CTEs ``shaped`` and ``name``: the finished rows of deduplicated records."""
    return f"""shaped AS (
  SELECT source_ord, rec_ord, program_name, {STATE} AS state_out, {CITY} AS city_out,
    {KNOWN_TYPE} AS known_type, {PROPERTY} AS property_type, {DESCRIPTION} AS description_out,
    {CONDITIONS} AS conditions, {AMOUNT} AS amount, {VALID_UNTIL} AS valid_until,
    level = 'federal' AND {STATED} = 'Unknown' AS expiry_unknown,
    coalesce(nullif(last_verified_at, ''), '2026-02-01') AS updated_at,
    confidence_score, {LINK} AS link
  FROM {uniq}),
reasoned AS (
  SELECT *, concat_ws('; ',
    CASE WHEN known_type IS NULL THEN 'incentive_type unresolved' END,
    CASE WHEN conditions = '' THEN 'eligibility unspecified' END,
    CASE WHEN amount = '' THEN 'amount unspecified' END,
    CASE WHEN expiry_unknown THEN 'expiry unknown' END,
    CASE WHEN link = '' THEN 'missing link' END,
    CASE WHEN confidence_score < 0.7 THEN 'low confidence (' || format('{{:.2f}}', confidence_score) || ')' END
  ) AS reasons FROM shaped),
{name} AS (
  SELECT source_ord, rec_ord, program_name, state_out AS state, city_out AS city,
    coalesce(known_type, 'Grants') AS incentive_type, property_type,
    description_out AS description,
    CASE WHEN conditions = '' THEN 'See program page' ELSE conditions END ||
      CASE WHEN reasons = '' THEN '' ELSE ' [needs review: ' || reasons || ']' END AS eligibility_criteria,
    CASE WHEN amount = '' THEN 'See program page' ELSE amount END AS incentive_amount,
    valid_until, updated_at,
    CASE WHEN reasons <> '' OR trim(program_name) = '' OR trim(state_out) = '' OR trim(city_out) = ''
      OR trim(property_type) = '' OR trim(description_out) = '' OR trim(link) = ''
      THEN 'Yes' ELSE 'No' END AS review_needed,
    link AS program_links, reasons
  FROM reasoned)"""


FINAL = f"{RAW},\n{unique_rows()},\n{final_rows()}"

DAMAGED = f"""{FINAL},
damaged AS (
  SELECT * REPLACE (
    CASE WHEN rec_ord % 7 = 0 THEN '2026/01/1' || (rec_ord % 3) ELSE updated_at END AS updated_at,
    CASE WHEN rec_ord % 11 = 0 THEN 'Maybe' ELSE review_needed END AS review_needed,
    CASE WHEN rec_ord % 13 = 0 THEN 'Other ' || (rec_ord % 4) ELSE incentive_type END AS incentive_type,
    CASE WHEN rec_ord % 17 = 0 THEN '' ELSE program_name END AS program_name)
  FROM final)"""

HOST = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)"

REGISTRY = f"""registry AS (
  SELECT page_id AS source_id, page_id AS source_ord, {HOST} AS name, url,
    CASE page_id % 5 WHEN 0 THEN 'federal' WHEN 1 THEN 'state' WHEN 2 THEN 'county'
      WHEN 3 THEN 'city' ELSE 'utility' END AS level,
    CASE WHEN page_id % 10 = 3 THEN '' WHEN page_id % 4 = 1 THEN 'GA' ELSE 'FL' END AS state,
    CASE WHEN page_id % 5 = 2 AND page_id % 3 <> 0 THEN 'Lake' ELSE '' END AS county,
    CASE WHEN page_id % 5 = 3 AND page_id % 3 <> 0 THEN 'Rivertown' ELSE '' END AS city,
    CASE WHEN page_id % 5 = 4 THEN 'Grid Co' ELSE '' END AS utility,
    CASE page_id % 7 WHEN 0 THEN 'js' WHEN 1 THEN 'static' ELSE 'auto' END AS render,
    45000 AS timeout_ms
  FROM pages)"""

JURISDICTION = """CASE level WHEN 'federal' THEN 'United States'
      WHEN 'state' THEN CASE WHEN state = '' THEN 'FL' ELSE state END
      WHEN 'county' THEN CASE WHEN county = '' THEN state ELSE county || ', ' || state END
      WHEN 'city' THEN CASE WHEN city = '' THEN state ELSE city || ', ' || state END
      ELSE utility || ' service territory' END"""


def visible(html: str) -> str:
    hidden = "|".join(
        f"<{n}[^>]*>.*?</{n}>" for n in ("script", "style", "noscript", "header", "footer", "nav")
    )
    bare = f"regexp_replace({html}, '(?is)<!--.*?-->|{hidden}', ' ', 'g')"
    text = f"regexp_replace({bare}, '<[a-zA-Z!/][^>]*(>|$)', ' ', 'g')"
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return collapse(text)


PAGES = f"""{REGISTRY},
shown AS (SELECT page_id, url, {visible('html')} AS visible FROM pages),
captured AS (
  SELECT page_id AS source_id, visible,
    CASE WHEN page_id % 23 = 0 THEN '' WHEN page_id % 4 = 0 THEN url || '/final' ELSE url END AS capture_url,
    page_id % 19 = 0 AS failed, page_id % 17 = 0 AS bad_status, page_id % 13 = 0 AS header_pdf,
    page_id % 3 = 0 AS rendered, 'extracted ' || url AS pdf_text, page_id / 7 AS elapsed
  FROM shown),
statics AS (
  SELECT r.*, c.* EXCLUDE (source_id),
    coalesce(nullif(capture_url, ''), url) AS ended_at,
    CASE WHEN failed OR bad_status THEN 'empty'
      WHEN header_pdf OR lower(coalesce(nullif(capture_url, ''), url)) LIKE '%.pdf' THEN 'pdf_text'
      ELSE 'html_text' END AS static_type
  FROM registry r JOIN captured c USING (source_id)),
texts AS (
  SELECT *, CASE static_type WHEN 'html_text' THEN visible WHEN 'pdf_text' THEN pdf_text ELSE '' END AS static_text
  FROM statics),
chosen AS (
  SELECT *, NOT (render = 'static' OR (render = 'auto' AND length(static_text) >= 400)) AS needs_render
  FROM texts),
page_texts AS (
  SELECT source_id, source_ord, name, url, level, state, county, city, utility, render, elapsed, needs_render,
    CASE WHEN needs_render AND rendered AND visible <> '' THEN visible
      WHEN render = 'js' THEN '' ELSE static_text END AS text,
    CASE WHEN needs_render AND rendered AND visible <> '' THEN 'js_text'
      WHEN render = 'js' THEN 'empty' ELSE static_type END AS content_type,
    CASE WHEN (needs_render AND rendered AND visible <> '') OR render = 'js' OR failed THEN url
      ELSE ended_at END AS final_url
  FROM chosen)"""

# Typed records of the answers, straight from events; needs RAW and page_texts.
ANSWERED = f"""entries AS (
  SELECT r.* , r.event_id % (SELECT count(*) FROM pages) AS source_id,
    r.event_id // (SELECT count(*) FROM pages) AS entry_ord
  FROM raw r),
objects AS (SELECT * FROM entries WHERE event_id % 19 <> 0 AND source_id <> 3),
hinted AS (
  SELECT o.* EXCLUDE (source_ord, rec_ord, state, level, county, city, utility_provider, source_url, last_verified_at),
    h.source_ord, o.entry_ord AS rec_ord, h.text,
    CASE WHEN o.event_id % 10 = 0 THEN h.level WHEN o.event_id % 11 = 0 THEN NULL ELSE o.level END AS level,
    CASE WHEN o.event_id % 10 = 0 THEN nullif(h.state, '') ELSE o.state END AS state,
    CASE WHEN coalesce(o.county, '') = '' AND h.county <> '' THEN h.county ELSE o.county END AS county,
    CASE WHEN coalesce(o.city, '') = '' AND h.city <> '' THEN h.city ELSE o.city END AS city,
    CASE WHEN coalesce(o.utility_provider, '') = '' AND h.utility <> '' THEN h.utility
      ELSE o.utility_provider END AS utility_provider,
    CASE WHEN o.source_url <> '' THEN o.source_url ELSE coalesce(nullif(h.final_url, ''), h.url) END AS source_url,
    coalesce(o.last_verified_at, '2026-02-01') AS last_verified_at
  FROM objects o JOIN page_texts h USING (source_id)),
answered AS (
  SELECT * FROM hinted
  WHERE length(trim(text)) >= 40 AND event_id % 13 <> 0 AND event_id % 17 <> 0)"""

LINK_STATUS = """link_status AS (
  SELECT url, CASE u % 7 WHEN 0 THEN 404 WHEN 1 THEN 403 WHEN 2 THEN NULL ELSE 200 END AS status,
    coalesce(u % 7 = 2, false) AS error
  FROM (SELECT DISTINCT program_links AS url,
          TRY_CAST(nullif(regexp_extract(program_links, '//src([0-9]+)\\.', 1), '') AS INTEGER) AS u
        FROM final WHERE program_links <> '')
  WHERE u IS NULL OR u % 7 <> 3),
verdicts AS (
  SELECT url, CASE WHEN error THEN true ELSE NOT ((status >= 200 AND status < 400) OR status = 403) END AS broken
  FROM link_status)"""
