"""DuckDB SQL for the registered queries, written apart from the operators."""

from __future__ import annotations

from ..operators.enrich import PROMPT
from ..params import HEADER_FIELDS, IDENTITY, PLATE, PROXY, REGIONS, REGISTRAR_STATES, SECTIONS, SQFT, STATUSES, TRACKED, VEHICLES
from ..sources.views import duckdb_view

TODAY, SPLIT = "DATE '1998-06-01'", "DATE '2024-01-15'"


def with_views(*parts: str) -> str:
    """WITH clause of views (by name) and further expressions."""
    return "WITH " + ",\n".join(duckdb_view(p) if p.startswith("v_") and " " not in p else p for p in parts) + "\n"


def norm(c: str) -> str:
    return f"coalesce(lower(regexp_replace(CAST({c} AS VARCHAR), '^\\s+|\\s+$', '', 'g')), '')"


def round1(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18,6)), 1) AS DOUBLE)"


def mean_known(*cols: str) -> str:
    total = " + ".join(f"coalesce(CAST({c} AS DECIMAL(18,6)), 0)" for c in cols)
    count = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols)
    return f"CAST(round(CAST(({total}) / CAST(nullif({count}, 0) AS DOUBLE) AS DECIMAL(18,6)), 1) AS DOUBLE)"


def flags(*cases: str) -> str:
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{name}' END" for name, c in (x.split(" IF ", 1) for x in cases)) + ")"


def percentile(batch: str) -> str:
    part = f"PARTITION BY {batch}, coalesce(reserve_price > 0, FALSE)"
    less, n = f"(rank() OVER ({part} ORDER BY reserve_price) - 1)", f"count(*) OVER ({part})"
    equal = f"count(*) OVER ({part}, reserve_price)"
    share = f"CASE WHEN {n} > 1 THEN ({less} + CAST(0.5 AS DOUBLE) * ({equal} - 1)) / ({n} - 1) ELSE CAST(0.5 AS DOUBLE) END"
    return f"CASE WHEN reserve_price > 0 THEN {round1(f'(1 - {share}) * 100')} END"


PRICE_FLAG = "CASE WHEN reserve_price IS NULL THEN 'price.missing' WHEN reserve_price = 0 THEN 'price.placeholder_zero' WHEN reserve_price < 0 THEN 'price.negative' END"
REGION = "CASE " + " ".join(f"WHEN contains(lower(location), '{r.lower()}') THEN '{r}'" for r in PROXY.preferred_regions) + " END"
LOCATION_SCORE = f"CASE WHEN ({REGION}) IS NULL THEN {PROXY.neutral} ELSE {PROXY.neutral + PROXY.bonus} END"
NOTICE = "noticed AS (SELECT * REPLACE (CASE WHEN input_seq % 3 <> 0 THEN notice_text END AS notice_text) FROM v_listings)"
PHYS, SYMB = "regexp_matches(notice_text, '(?i)\\bphysical possession\\b')", "regexp_matches(notice_text, '(?i)\\bsymbolic possession\\b')"
SOURCE = "coalesce(notice_text, nature_of_assets)"
LAND = (
    f"CASE WHEN regexp_matches({SOURCE}, '(?i)non[\\s-]?agricultural') THEN 'non-agricultural' "
    + " ".join(f"WHEN regexp_matches({SOURCE}, '(?i)\\b{c}\\b') THEN '{c}'" for c in ("agricultural", "industrial", "residential", "commercial"))
    + " END"
)
POSSESSED = f"""possessed AS (
  SELECT *, CASE WHEN {PHYS} AND NOT {SYMB} THEN 'physical' WHEN {SYMB} AND NOT {PHYS} THEN 'symbolic' END AS possession_status,
    {LAND} AS land_classification, {PHYS} AND {SYMB} AS p_both, NOT {PHYS} AND NOT {SYMB} AS p_none
  FROM noticed)"""
POSSESSION_SCORE = "CASE possession_status WHEN 'physical' THEN 100 WHEN 'symbolic' THEN 40 ELSE 50 END"

AREA = "(?i)([\\d,]+\\.?\\d*)\\s*(sq\\.?\\s*(?:ft|feet|mtrs?|meters?|metres?|m)\\.?|acres?|hectares?|guntas?|cents?)\\b"
MENTIONS = f"""mentions AS (
  SELECT input_seq, generate_subscripts(regexp_extract_all(nature_of_assets, '{AREA}', 1), 1) AS nth,
    unnest(regexp_extract_all(nature_of_assets, '{AREA}', 1)) AS num, unnest(regexp_extract_all(nature_of_assets, '{AREA}', 2)) AS unit
  FROM v_listings)"""
UNIT = "trim(replace(lower(unit), '.', ''))"
SQFT_CASE = (
    "CASE " + " ".join(f"WHEN {UNIT} LIKE '{u}%' THEN v * {SQFT[u]}::DOUBLE" for u in ("acre", "hectare", "gunta", "cent"))
    + f" WHEN {UNIT} LIKE '%ft%' OR {UNIT} LIKE '%feet%' THEN v WHEN {UNIT} LIKE '%m%' THEN v * {SQFT['m']}::DOUBLE END"
)
PLOTS = f"""sized AS (SELECT *, {SQFT_CASE} AS sqft FROM (SELECT *, TRY_CAST(replace(num, ',', '') AS DOUBLE) AS v FROM mentions)),
plots AS (
  SELECT input_seq, count(*) AS n, count(sqft) AS known, max({round1('sqft')}) AS most, min({round1('sqft')}) AS least, sum(sqft ORDER BY nth) AS total
  FROM sized GROUP BY input_seq),
plotted AS (
  SELECT l.*, coalesce(n, 0) AS n, coalesce(known, 0) AS known, coalesce(most = least OR (most - least) / most < CAST(0.01 AS DOUBLE), FALSE) AS one,
    CASE WHEN known > 0 AND (most = least OR (most - least) / most < CAST(0.01 AS DOUBLE)) THEN {round1('total / known')} END AS plot_sqft
  FROM v_listings l LEFT JOIN plots USING (input_seq))"""
SCORED = (
    NOTICE, POSSESSED,
    f"""parts AS (SELECT *, {percentile('batch_date')} AS price_score, {LOCATION_SCORE} AS location_score, {POSSESSION_SCORE} AS possession_score FROM possessed)""",
    f"""halves AS (SELECT *, {mean_known('price_score', 'location_score')} AS score_a, {mean_known('possession_score', '50')} AS score_b, CAST(50 AS DOUBLE) AS score_c FROM parts)""",
    f"""scored AS (SELECT *, {mean_known('score_a', 'score_b', 'score_c')} AS combined FROM halves)""",
)
NEAREST = f"""closing AS (
  SELECT *, CASE WHEN a IS NULL AND e IS NULL THEN NULL WHEN e IS NULL OR a <= e THEN a ELSE e END AS closing_date,
    CASE WHEN a IS NULL AND e IS NULL THEN NULL WHEN e IS NULL OR a <= e THEN 'auction_date' ELSE 'emd_due_date' END AS closing_field
  FROM (SELECT *, CASE WHEN auction_date >= {TODAY} THEN auction_date END AS a, CASE WHEN emd_due_date >= {TODAY} THEN emd_due_date END AS e FROM %s))"""

KEY = f"substring(sha256(concat_ws('|', {', '.join(norm(c) for c in IDENTITY)})), 1, 24)"
IDENT = f"[{', '.join(norm(c) for c in IDENTITY)}]"
FIELDS = "concat_ws('; ', " + ", ".join(f"CASE WHEN prev[{k}] <> tracked[{k}] THEN '{f}' END" for k, f in enumerate(TRACKED, 1)) + ")"


def folded(name: str, where: str = "TRUE") -> str:
    """Statuses of snapshots in their order, as ``name``."""
    return f"""{name}_k AS (SELECT *, {KEY} AS listing_key, {IDENT} AS ident, [{', '.join(norm(c) for c in TRACKED)}] AS tracked FROM v_snapshots WHERE {where}),
{name}_o AS (SELECT *, ident <> first_value(ident) OVER (PARTITION BY listing_key ORDER BY run_date, input_seq) AS hit FROM {name}_k),
{name}_l AS (SELECT *, lag(tracked) OVER w AS prev, lag(reserve_price) OVER w AS old_price FROM {name}_o WINDOW w AS (PARTITION BY listing_key, hit ORDER BY run_date, input_seq)),
{name} AS (
  SELECT *, CASE WHEN hit THEN 'collision' WHEN prev IS NULL THEN 'new' WHEN prev = tracked THEN 'unchanged' ELSE 'changed' END AS status,
    coalesce(NOT hit AND prev IS NOT NULL AND prev <> tracked AND reserve_price < old_price, FALSE) AS price_drop
  FROM {name}_l)"""


def final(name: str, source: str) -> str:
    order = "row(run_date, input_seq)"
    last = "row_number() OVER (PARTITION BY listing_key ORDER BY run_date DESC, input_seq DESC)"
    first = "row_number() OVER (PARTITION BY listing_key ORDER BY run_date, input_seq)"
    return f"""{name}_r AS (SELECT *, {last} AS nl, {first} AS nf FROM {source} WHERE status <> 'collision' AND {order} IS NOT NULL),
{name} AS (
  SELECT f.listing_key, f.corporate_debtor, f.ip_name, f.notice_type, f.nature_of_assets, f.ident, l.tracked, l.reserve_price, l.auction_date, l.notice_date, l.emd_due_date,
    l.details_parsed, g.first_seen, g.last_seen, g.last_changed, g.observations, length(f.corporate_debtor) % 2 = 0 AS notice_parsed
  FROM (SELECT * FROM {name}_r WHERE nf = 1) f JOIN (SELECT * FROM {name}_r WHERE nl = 1) l USING (listing_key)
  JOIN (SELECT listing_key, min(run_date) AS first_seen, max(run_date) AS last_seen, max(run_date) FILTER (status IN ('new', 'changed')) AS last_changed, count(*) AS observations
        FROM {name}_r GROUP BY listing_key) g USING (listing_key))"""


STATE = (folded("early", f"run_date <= {SPLIT}"), final("state", "early"))
LATE = f"late AS (SELECT *, {KEY} AS listing_key, {IDENT} AS ident, [{', '.join(norm(c) for c in TRACKED)}] AS tracked FROM v_snapshots WHERE run_date > {SPLIT})"
PREVIEW = """preview AS (
  SELECT late.*, s.details_parsed AS old_details, s.notice_parsed AS old_notice, s.ip_name AS old_ip, s.listing_key IS NOT NULL AS known,
    CASE WHEN s.listing_key IS NULL THEN 'new' WHEN s.ident <> late.ident THEN 'collision' WHEN s.tracked = late.tracked THEN 'unchanged' ELSE 'changed' END AS status
  FROM late LEFT JOIN state s ON late.listing_key = s.listing_key)"""
FRESH = "status IN ('new', 'changed', 'collision')"
ENRICHMENT = """enrichment AS (
  SELECT listing_key, 'narrative of ' || corporate_debtor AS narrative, last_seen AS narrative_at, details_parsed AS details_at_enrich, notice_parsed AS notice_at_enrich
  FROM state WHERE length(ip_name || corporate_debtor) % 3 <> 0)"""
ROUTED = f"""reasoned AS (
  SELECT p.*, p.input_seq % 3 = 0 AS notice_parsed, e.listing_key IS NOT NULL AS has_row,
    CASE WHEN status = 'collision' THEN 'collision' WHEN {FRESH} THEN 'status' WHEN e.listing_key IS NULL THEN 'no_row'
      WHEN details_parsed AND NOT details_at_enrich THEN 'details_parsed' WHEN p.input_seq % 3 = 0 AND NOT notice_at_enrich THEN 'notice_parsed' END AS reason
  FROM preview p LEFT JOIN enrichment e ON p.listing_key = e.listing_key),
routed AS (SELECT *, CASE WHEN reason = 'collision' THEN 'collision' WHEN reason IS NOT NULL THEN 'reenrich' ELSE 'reuse' END AS route FROM reasoned),
capped AS (
  SELECT * REPLACE (CASE WHEN route = 'reenrich' AND row_number() OVER (PARTITION BY route ORDER BY has_row, input_seq) > {PROXY.enrichment_cap} THEN 'deferred' ELSE route END AS route)
  FROM routed)"""
ROUTES = (*STATE, LATE, PREVIEW, ENRICHMENT, ROUTED)

CIN = "upper(regexp_replace(cin, '^\\s+|\\s+$', '', 'g'))"
CODES = "CASE substring({c}, 7, 2) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REGISTRAR_STATES.items()) + " END"
STATE_OF = f"CASE WHEN length({CIN}) = 21 THEN {CODES.format(c=CIN)} END"
REGISTRY = f"""registry AS (
  SELECT file_pos, {CIN} AS cin, {STATE_OF} AS state, company_name,
    CASE WHEN upper(trim(company_status)) IN ('', 'NA', 'N.A.', 'N/A', '-') THEN NULL ELSE company_status END AS company_status,
    CAST(paidup_capital AS VARCHAR) AS paidup_capital
  FROM v_registry),
lasts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY state, cin ORDER BY file_pos DESC) AS nth, count(*) OVER (PARTITION BY state, cin) - 1 AS duplicates FROM registry)
  WHERE nth = 1)"""
EXPECTED = ("andhra pradesh", "delhi", "goa", "karnataka", "maharashtra", "sikkim", "tamil nadu", "telangana", "uttar pradesh", "west bengal")
BAD_FILES = "('goa', 'delhi', 'sikkim')"
WHY_GONE = f"""(CASE e.state WHEN 'delhi' THEN 'no_key' WHEN 'sikkim' THEN 'no_rows' WHEN 'goa' THEN 'file_absent'
    ELSE CASE WHEN e.state IN {EXPECTED} AND e.state NOT IN (SELECT state FROM registry WHERE state IS NOT NULL) THEN 'file_absent' END END)"""
NAMED = "[" + ", ".join(f"CASE WHEN regexp_matches(location, '(?i)\\b{n.replace(' ', chr(92) + 's+')}\\b') THEN '{n}' END" for n, _ in REGIONS) + "]"
LOCATED = f"located AS (SELECT *, list_filter({NAMED}, lambda x: x IS NOT NULL) AS named FROM v_listings)"
STATUS = "CASE WHEN input_seq % 8 = 0 THEN 'new' WHEN input_seq % 8 = 1 THEN 'changed' WHEN input_seq % 97 = 5 THEN 'collision' ELSE 'unchanged' END"
SECTIONED = (
    "v_listings", *SCORED, NEAREST % "scored",
    f"""sections AS (
  SELECT 'top_scored' AS section, row_number() OVER (ORDER BY combined DESC, input_seq) AS nth, input_seq FROM scored WHERE combined IS NOT NULL QUALIFY nth <= {PROXY.top_n}
  UNION ALL SELECT 'closing_soon', row_number() OVER (ORDER BY closing_date, input_seq), input_seq FROM closing WHERE closing_date - {TODAY} <= {PROXY.closing_days}
  UNION ALL SELECT s, row_number() OVER (PARTITION BY s ORDER BY input_seq), input_seq FROM (
    SELECT input_seq, CASE {STATUS} WHEN 'new' THEN 'new_today' WHEN 'changed' THEN 'watchlist_changes' WHEN 'collision' THEN 'collisions' END AS s FROM v_listings)
  WHERE s IS NOT NULL)""",
)


def zero_filled(values: tuple[str, ...], column: str, source: str) -> str:
    rows = ", ".join(f"('{v}')" for v in values)
    return f"SELECT v.{column}, count(s.{column}) AS n FROM (VALUES {rows}) v({column}) LEFT JOIN {source} s ON v.{column} = s.{column} GROUP BY v.{column}"


def group_digits(n: str) -> str:
    digits = f"CAST(abs({n}) AS VARCHAR)"
    head = f"substring({digits}, 1, greatest(length({digits}) - 3, 0))"
    pairs = f"trim(reverse(regexp_replace(reverse({head}), '(\\d\\d)', '\\1,', 'g')), ',')"
    return f"CASE WHEN length({digits}) > 3 THEN {pairs} || ',' || right({digits}, 3) ELSE {digits} END"


def currency(n: str) -> str:
    return f"CASE WHEN {n} IS NULL THEN 'not disclosed' WHEN {n} = 0 THEN 'no reserve fixed (per notice)' ELSE CASE WHEN {n} < 0 THEN '-' ELSE '' END || 'Rs. ' || {group_digits(n)} END"


SHOWN = "coalesce(strftime({c}, '%d %b %Y'), 'unknown')"
VEHICLE = "(?i)\\b(?:" + "|".join(VEHICLES) + ")\\b"
PAGED = "paged AS (SELECT *, CAST(floor(date_diff('day', notice_date, DATE '1999-01-01') / 20) AS INT) + 1 AS page, CASE WHEN input_seq % 7 <> 0 THEN notice_date END AS seen FROM v_listings)"
RAW_DATE = """raws AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 5 AS k FROM orders)"""
RAW_AMOUNT = "raws AS (SELECT o_orderkey, o_orderkey % 4 AS k, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS n FROM orders)"
MISSING = "; ".join(sorted(f for f in HEADER_FIELDS.values() if f == list(HEADER_FIELDS.values())[6]))

EXCLUDED = f"(regexp_matches(nature_of_assets, '{VEHICLE}') OR regexp_matches(nature_of_assets, '{PLATE}'))"
ROUTE = f"""CASE WHEN coalesce(location, '') = '' AND coalesce(named[1], '') = '' THEN 'unknown_location'
        WHEN lower(named[1]) IN ({', '.join(f"'{s.lower()}'" for s in PROXY.included_states)}) OR {' OR '.join(f"contains(lower(location), '{k}')" for k in PROXY.included_keywords)} THEN 'kept' ELSE 'other_location' END"""
POSSESSION_FLAGS = """CASE WHEN p_both THEN 'possession.ambiguous' END, CASE WHEN p_none THEN 'possession.none' END, CASE WHEN notice_text IS NULL THEN 'possession.no_text' END,
        CASE WHEN land_classification IS NULL THEN 'land.none' END, CASE WHEN land_classification IS NOT NULL AND notice_text IS NULL THEN 'land.from_assets' END"""
LOCATION_FLAG = "CASE WHEN location IS NULL THEN 'location.unknown' END"
SCORE_FLAGS = f"concat_ws('; ', {PRICE_FLAG}, {LOCATION_FLAG}, {POSSESSION_FLAGS})"
#: Anchors are cut out first, without comments, scripts and styles; then the address of each is read from its attributes.
BARE = r"regexp_replace(html, '<!--.*?-->|<(script|style)\b.*?</(script|style)\s*>', '', 'gis')"
ANCHOR = r"""(?i)<a(?:\s+(?:[^\s"''>=]+(?:\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+))?\s*)*)?>"""
ADDRESS = r"""(?i)\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)"""
PLAIN = "replace(replace(replace(replace(replace({c}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', ''''), '&amp;', '&')"
JSON_FIELDS = ("corporate_debtor", "notice_type", "ip_name", "auction_date", "emd_due_date", "reserve_price", "nature_of_assets", "location")
AS_JSON = "'{' || " + " || ',' || ".join(
    f"'\"{f}\":' || coalesce(" + (f"CAST({f} AS VARCHAR)" if f == "reserve_price" else f"CAST(to_json(CAST({f} AS VARCHAR)) AS VARCHAR)") + ", 'null')" for f in JSON_FIELDS
) + " || '}'"
BEFORE, AFTER = (part.replace("'", "''") for part in PROMPT.split("%s"))
LINKS = f"""SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) AS nth, trim(replace(replace(trim(address, '"'''), '&amp;', '&'), '&#38;', '&')) AS href FROM (
        SELECT page_id, place, regexp_extract(anchor, '{ADDRESS}', 1) AS address FROM (
        SELECT page_id, generate_subscripts(regexp_extract_all({BARE}, '{ANCHOR}'), 1) AS place, unnest(regexp_extract_all({BARE}, '{ANCHOR}')) AS anchor FROM pages)
        WHERE regexp_matches(anchor, '{ADDRESS}'))"""

ORACLES = {
    "price_percentile": with_views("v_listings") + f"SELECT input_seq, batch_date, reserve_price, {percentile('batch_date')} AS price_score, {PRICE_FLAG} AS price_flag FROM v_listings",
    "price_percentile_global": with_views("v_listings") + f"SELECT input_seq, reserve_price, {percentile('1')} AS price_score, {PRICE_FLAG} AS price_flag FROM (SELECT * FROM v_listings)",
    "location_score": with_views("v_listings") + f"SELECT input_seq, {LOCATION_SCORE} AS location_score, {REGION} AS matched_region, CASE WHEN location IS NULL THEN 'location.unknown' END AS location_flag FROM v_listings",
    "possession_class": with_views("v_listings", NOTICE, POSSESSED) + f"""SELECT input_seq, possession_status, land_classification, {flags(
        'possession.ambiguous IF p_both', 'possession.none IF p_none', 'possession.no_text IF notice_text IS NULL', 'land.none IF land_classification IS NULL',
        'land.from_assets IF land_classification IS NOT NULL AND notice_text IS NULL')} AS flags FROM possessed""",
    "possession_score": with_views("v_listings", NOTICE, POSSESSED, f"s AS (SELECT input_seq, {POSSESSION_SCORE} AS possession_score, 50 AS land_score FROM possessed)")
    + f"SELECT *, {mean_known('possession_score', 'land_score')} AS score_b FROM s",
    "area_mentions": with_views("v_listings", MENTIONS) + """SELECT l.input_seq, coalesce(string_agg(num || ' ' || unit, '; ' ORDER BY nth), '') AS mentions, CAST(count(num) AS INT) AS n
        FROM v_listings l LEFT JOIN mentions m USING (input_seq) GROUP BY l.input_seq""",
    "plot_size": with_views("v_listings", MENTIONS, PLOTS) + f"""SELECT input_seq, plot_sqft, {flags(
        'area.none IF n = 0', 'area.unparsed IF known < n', 'area.unconverted IF n > 0 AND known = 0', 'area.ambiguous IF known > 0 AND NOT one')} AS flags, 50 AS plot_score FROM plotted""",
    "combined_score": with_views("v_listings", *SCORED) + "SELECT input_seq, score_a, score_b, score_c, combined FROM scored",
    "top_scored": with_views("v_listings", *SCORED) + f"SELECT input_seq, corporate_debtor, reserve_price, combined FROM scored WHERE combined IS NOT NULL ORDER BY combined DESC, input_seq LIMIT {PROXY.top_n}",
    "top_scored_by_batch": with_views("v_listings", *SCORED) + f"SELECT batch_date, CAST(row_number() OVER (PARTITION BY batch_date ORDER BY combined DESC, input_seq) AS INT) AS nth, input_seq, combined FROM scored QUALIFY nth <= {PROXY.top_n}",
    "closing_soon": with_views("v_listings", NEAREST % "v_listings") + f"SELECT input_seq, closing_date, closing_field, CAST(closing_date - {TODAY} AS INT) AS closing_days FROM closing WHERE closing_date - {TODAY} <= {PROXY.closing_days}",
    "identity_key": with_views("v_snapshots") + f"SELECT input_seq, {KEY} AS listing_key FROM v_snapshots",
    "change_preview": with_views("v_snapshots", *STATE, LATE, PREVIEW) + "SELECT input_seq, listing_key, status FROM preview",
    "change_status": with_views("v_snapshots", folded("c")) + f"SELECT input_seq, listing_key, status, price_drop, CASE WHEN status = 'changed' THEN {FIELDS} ELSE '' END AS fields FROM c",
    "change_status_resumed": with_views("v_snapshots", folded("c")) + f"SELECT input_seq, listing_key, status, price_drop FROM c WHERE run_date > {SPLIT}",
    "change_history": with_views("v_snapshots", folded("c")) + " UNION ALL ".join(
        f"SELECT listing_key, run_date AS changed_at, input_seq, '{f}' AS field, prev[{k}] AS old_value, tracked[{k}] AS new_value, {'price_drop' if f == 'reserve_price' else 'FALSE'} AS is_price_drop FROM c WHERE status = 'changed' AND prev[{k}] <> tracked[{k}]"
        for k, f in enumerate(TRACKED, 1)
    ),
    "price_drops": with_views("v_snapshots", folded("c")) + "SELECT input_seq, listing_key, reserve_price FROM c WHERE price_drop",
    "collision_detect": with_views("v_snapshots", folded("c")) + """SELECT input_seq, listing_key, '{"corporate_debtor":"' || corporate_debtor || '","ip_name":"' || ip_name || '"}' AS incoming FROM c WHERE status = 'collision'""",
    "listing_state_final": with_views("v_snapshots", folded("c"), final("s", "c")) + f"""SELECT s.listing_key, s.corporate_debtor, s.ip_name, {', '.join(f's.{t}' for t in TRACKED)}, s.details_parsed, first_seen, last_seen, last_changed, observations,
        '{{"corporate_debtor":"' || m.corporate_debtor || '","auction_date":"' || CAST(m.auction_date AS VARCHAR) || '","reserve_price":' || coalesce(CAST(m.reserve_price AS VARCHAR), 'null') || '}}' AS raw_json
        FROM s JOIN (SELECT * FROM c WHERE status IN ('new', 'changed') QUALIFY row_number() OVER (PARTITION BY listing_key ORDER BY run_date DESC, input_seq DESC) = 1) m USING (listing_key)""",
    "status_summary": with_views("v_snapshots", folded("c")) + zero_filled(STATUSES, "status", "c"),
    "page_dedup": with_views("v_paged_rows") + """SELECT page, row_idx, debtor, row_number() OVER (
        PARTITION BY CASE WHEN details_url <> '' THEN 'u:' || details_url ELSE 'f:' || debtor || ':' || price_raw END ORDER BY page, row_idx) = 1 AS kept FROM v_paged_rows""",
    "recency_cutoff": with_views("v_listings") + f"""SELECT * FROM (SELECT input_seq, CASE WHEN input_seq % 7 <> 0 THEN notice_date END AS notice_date FROM v_listings)
        WHERE notice_date IS NULL OR notice_date >= {TODAY} - {PROXY.window_days}""",
    "page_stop": with_views("v_listings", PAGED, "tops AS (SELECT page, count(*) AS n_rows, max(seen) AS newest FROM paged GROUP BY page)")
    + f"SELECT * FROM tops WHERE page <= coalesce((SELECT min(page) FROM tops WHERE newest < {TODAY} - {PROXY.window_days}), 2000000000)",
    "page_completeness": with_views("v_paged_rows", "n AS (SELECT page, count(*) AS n_rows FROM v_paged_rows WHERE page <> 3 GROUP BY page)")
    + """SELECT CAST(p AS INT) AS page, coalesce(n_rows, 0) AS n_rows, n_rows IS NULL AS missing
        FROM range(1, 1 + (SELECT CAST(ceil((SELECT count(*) FROM supplier) / CAST(n_rows AS DOUBLE)) AS INT) FROM n WHERE page = 1)) r(p) LEFT JOIN n ON n.page = r.p""",
    "date_parse": "WITH " + RAW_DATE + " SELECT o_orderkey, CASE WHEN k IN (0, 4) THEN d END AS day, CASE WHEN k IN (1, 2) THEN 'notice_date.unparseable' END AS flag FROM raws",
    "amount_parse": "WITH " + RAW_AMOUNT + """ SELECT o_orderkey, CASE k WHEN 0 THEN CAST('111' || n AS BIGINT) WHEN 3 THEN CAST(n AS BIGINT) END AS amount,
        CASE WHEN k IN (1, 2) THEN 'price.unparseable' END AS flag, CASE k WHEN 0 THEN CAST('111' || n AS BIGINT) WHEN 2 THEN NULL ELSE CAST(n AS BIGINT) END AS digits FROM raws""",
    "currency_format": with_views("v_listings") + f"SELECT input_seq, {currency('(reserve_price * (input_seq % 1000))')} AS price, {SHOWN.format(c='auction_date')} AS auction_date FROM v_listings",
    "state_from_text": with_views("v_listings", LOCATED) + "SELECT input_seq, named[1] AS state, CASE WHEN location IS NULL THEN 'state.blank' WHEN len(named) = 0 THEN 'state.none' WHEN len(named) > 1 THEN 'state.ambiguous' END AS flag FROM located",
    "form_fields": with_views("v_listings") + f"""SELECT input_seq, corporate_debtor, trim(cin) AS cin, 'Auction Notice' AS form_type, reserve_price, input_seq * 10 AS emd_amount,
        CASE WHEN input_seq % 2 = 1 THEN 'site ' || CAST(input_seq AS VARCHAR) ELSE 'eAuction' END AS platform, nature_of_assets, CASE WHEN input_seq % 11 <> 0 THEN location END AS location,
        {flags('cin IF cin IS NULL', 'location_raw IF input_seq % 11 = 0 OR location IS NULL')} AS missing, FALSE AS mismatch FROM v_listings""",
    "registry_normalize": with_views("v_registry", REGISTRY) + "SELECT file_pos, cin, state, company_name, company_status, paidup_capital, CAST(NULL AS VARCHAR) AS company_class FROM registry",
    "registry_dedup": with_views("v_registry", REGISTRY) + "SELECT cin, state, file_pos, company_name, duplicates FROM lasts",
    "registry_status": with_views("v_registry", REGISTRY, f"n AS (SELECT state, count(*) AS n_rows, count(DISTINCT cin) AS n_numbers FROM registry WHERE state NOT IN {BAD_FILES} GROUP BY state)")
    + f"""SELECT e.state, coalesce({WHY_GONE}, 'ok') AS status, coalesce(n_rows, 0) AS n_rows, coalesce(n_rows - n_numbers, 0) AS duplicates
        FROM (VALUES {", ".join(f"('{x}')" for x in EXPECTED)}) e(state) LEFT JOIN n USING (state)""",
    "registry_lookup": with_views("v_listings", "v_registry", REGISTRY, f"asked AS (SELECT input_seq, {CIN} AS number, {STATE_OF} AS state FROM v_listings)")
    + f"""SELECT input_seq, e.state AS registry_state, company_name, company_status, CASE WHEN number IS NULL THEN 'no_cin' WHEN e.state IS NULL THEN 'unmapped_code' WHEN {WHY_GONE} IS NOT NULL THEN {WHY_GONE}
        WHEN l.cin IS NULL THEN 'no_match' END AS miss_reason FROM asked e LEFT JOIN lasts l ON l.state = e.state AND l.cin = number AND e.state NOT IN {BAD_FILES}""",
    "registry_of_two_states": with_views("v_registry", REGISTRY) + "SELECT state, cin, company_name, duplicates FROM lasts WHERE state IN ('karnataka', 'west bengal')",
    "registry_csv": with_views("v_registry") + """SELECT file_pos AS n, cin, CASE file_pos % 3 WHEN 0 THEN company_name || chr(10) || 'second "line", of ' || CAST(file_pos AS VARCHAR)
        WHEN 1 THEN '"' || company_name || '"' ELSE company_name END AS company_name FROM v_registry""",
    "refetch_gate": with_views("v_snapshots", *STATE, LATE, PREVIEW) + f"SELECT input_seq, status, {FRESH} OR NOT coalesce(old_details, FALSE) AS need_details, {FRESH} OR NOT coalesce(old_notice, FALSE) AS need_notice FROM preview",
    "field_reuse": with_views("v_snapshots", *STATE, LATE, PREVIEW, f"g AS (SELECT *, known AND NOT ({FRESH} OR NOT coalesce(old_details, FALSE)) AS reused FROM preview)")
    + "SELECT input_seq, CASE WHEN reused THEN 'stored ' || old_ip ELSE 'fresh' END AS location, CASE WHEN reused THEN old_details ELSE details_parsed END AS details_parsed, reused FROM g",
    "reenrich_trigger": with_views("v_snapshots", *ROUTES) + "SELECT input_seq, status, route, reason, has_row FROM routed",
    "enrichment_cap": with_views("v_snapshots", *ROUTES) + "SELECT input_seq, has_row, route FROM capped",
    "enrichment_merge": with_views("v_snapshots", *ROUTES, """fresh AS (
  SELECT listing_key, CASE WHEN input_seq % 2 = 0 THEN 'fresh narrative' END AS narrative, 'registry ' || CAST(input_seq AS VARCHAR) AS registry, details_parsed, notice_parsed
  FROM (SELECT *, row_number() OVER (PARTITION BY listing_key ORDER BY input_seq DESC) AS n FROM routed WHERE route = 'reenrich') WHERE n = 1)""")
    + """SELECT coalesce(f.listing_key, e.listing_key) AS listing_key, coalesce(f.narrative, e.narrative) AS narrative,
        CASE WHEN f.narrative IS NOT NULL THEN DATE '2024-02-01' ELSE e.narrative_at END AS narrative_at, f.narrative IS NOT NULL OR e.listing_key IS NOT NULL AS narrative_attempted,
        f.registry, CASE WHEN f.registry IS NOT NULL THEN DATE '2024-02-01' END AS registry_at, f.registry IS NOT NULL AS registry_attempted,
        CASE WHEN f.listing_key IS NOT NULL THEN f.details_parsed ELSE e.details_at_enrich END AS details_at_enrich,
        CASE WHEN f.listing_key IS NOT NULL THEN f.notice_parsed ELSE e.notice_at_enrich END AS notice_at_enrich
        FROM enrichment e FULL JOIN fresh f ON e.listing_key = f.listing_key""",
    "location_route": with_views("v_listings", LOCATED) + f"SELECT input_seq, named[1] AS state, {ROUTE} AS route FROM located",
    "place_from_table": with_views(
        "v_listings", "names AS (SELECT n_nationkey AS ord, n_name AS name FROM nation UNION ALL SELECT 1000 + r_regionkey, r_name FROM region)",
        "hits AS (SELECT input_seq, name, ord FROM v_listings, names WHERE regexp_matches(location, '(?i)\\b' || name || '\\b'))",
    ) + "SELECT l.input_seq, arg_min(name, ord) AS name, CAST(count(name) AS INT) AS n FROM v_listings l LEFT JOIN hits USING (input_seq) GROUP BY l.input_seq",
    "keyword_route": with_views("v_listings", LOCATED) + """SELECT input_seq, named[1] AS state, CASE WHEN coalesce(location, '') = '' AND len(named) = 0 THEN 'unknown_location'
        WHEN EXISTS (SELECT 1 FROM nation WHERE n_nationkey % 3 = 0 AND contains(lower(location), lower(n_name))) THEN 'kept' ELSE 'other_location' END AS route FROM located""",
    "asset_exclusion": with_views("v_listings") + f"SELECT input_seq, {EXCLUDED} AS excluded FROM v_listings",
    "report_sections": with_views(*SECTIONED) + "SELECT section, CAST(nth AS INT) AS nth, input_seq FROM sections",
    "report_counts": with_views(*SECTIONED) + zero_filled(SECTIONS, "section", "sections"),
    "run_summary": with_views("v_snapshots", *ROUTES, folded("c")) + """SELECT * FROM
        (SELECT CAST(count_if(status = 'new') AS BIGINT) AS n_new, CAST(count_if(status = 'changed') AS BIGINT) AS n_changed, CAST(count_if(status = 'unchanged') AS BIGINT) AS n_unchanged, CAST(count_if(status = 'collision') AS BIGINT) AS n_collision FROM c),
        (SELECT CAST(count_if(route = 'reenrich') AS BIGINT) AS reenriched, CAST(count_if(route IN ('reuse', 'deferred')) AS BIGINT) AS reused, CAST(count_if(route = 'deferred') AS BIGINT) AS deferred, CAST(count_if(route = 'collision') AS BIGINT) AS skipped_collision FROM capped)""",
    "listing_cards": with_views("v_listings", *SCORED, f"located AS (SELECT *, list_filter({NAMED}, lambda x: x IS NOT NULL) AS named FROM scored)")
    + f"""SELECT coalesce(named[1], 'not stated in source data') AS state, CASE WHEN input_seq % 8 = 1 THEN 'reserve_price: 1 -> ' || coalesce(CAST(reserve_price AS VARCHAR), '') ELSE '' END AS changes,
        {SCORE_FLAGS} AS flags, coalesce(nullif(concat_ws(' | ', CASE WHEN input_seq % 3 = 0 THEN 'details: /d/' || input_seq END, CASE WHEN input_seq % 2 = 0 THEN 'notice: /n/' || input_seq END), ''), 'no links yet') AS links,
        input_seq, {currency('reserve_price')} AS price, coalesce(location, 'not yet known') AS location, {SHOWN.format(c='auction_date')} AS auction_date,
        {SHOWN.format(c='emd_due_date')} AS emd_due_date, ip_name, nature_of_assets, coalesce(CAST(CAST(combined AS DECIMAL(9,1)) AS VARCHAR), 'no score') AS score FROM located""",
    "fetch_summary": with_views("v_snapshots", *STATE, LATE, PREVIEW) + "SELECT " + ", ".join(
        f"CAST(count_if({'' if fetched else 'NOT '}({FRESH} OR NOT coalesce(old_{s}, FALSE))) AS BIGINT) AS {s}_{'fetched' if fetched else 'reused'}" for s in ("details", "notice") for fetched in (True, False)
    ) + " FROM preview",
    "filter_summary": with_views("v_listings", LOCATED, f"routes AS (SELECT {EXCLUDED} AS excluded, {ROUTE} AS route FROM located)") + "SELECT "
    + ", ".join(f"CAST(count_if(route = '{r}' AND NOT excluded) AS BIGINT) AS {r}" for r in ("kept", "other_location", "unknown_location")) + ", CAST(count_if(excluded) AS BIGINT) AS excluded FROM routes",
    "problem_lines": with_views("v_listings", f"p AS (SELECT input_seq, input_seq || ' ' || {PRICE_FLAG} AS reason FROM v_listings WHERE {PRICE_FLAG} IS NOT NULL)")
    + "SELECT string_agg(reason, '; ' ORDER BY input_seq) FILTER (n <= 10) AS first, CAST(greatest(count(*) - 10, 0) AS BIGINT) AS more FROM (SELECT *, row_number() OVER (ORDER BY input_seq) AS n FROM p)",
    "coverage_profile": with_views("v_listings", NOTICE, POSSESSED, MENTIONS, PLOTS) + """SELECT count(*) AS n_rows, count(p.cin) AS with_cin, count(p.location) AS with_location, count(nullif(p.reserve_price, 0)) AS with_price,
        count(possession_status) AS with_possession, count(plot_sqft) AS with_plot FROM possessed p JOIN plotted USING (input_seq)""",
    "tiered_search": with_views("v_tiers", """found AS (SELECT t.item_id, t.tier, d.doc_id FROM v_tiers t JOIN documents d ON contains(d.text, t.phrase)),
best AS (
  SELECT item_id, tier, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY doc_id) AS nth FROM (SELECT *, min(tier) OVER (PARTITION BY item_id) AS t FROM found) WHERE tier = t)""")
    + f"""SELECT e.item_id, b.tier, b.doc_id, CAST(b.nth AS INT) AS nth, CASE WHEN b.tier IS NULL THEN 'search.exhausted' WHEN b.tier > 1 THEN 'search.broadened' END AS flag
        FROM (SELECT DISTINCT item_id FROM v_tiers) e LEFT JOIN best b ON e.item_id = b.item_id AND b.nth <= {PROXY.hits_per_entity}""",
    "search_phrases": with_views("v_listings", "q AS (SELECT input_seq, '\"' || corporate_debtor || '\"' AS q, corporate_debtor AS n, location AS l, ' auction OR insolvency OR NCLT' AS t FROM v_listings)")
    + """SELECT input_seq, 0 AS tier, q || coalesce(' ' || l, '') || t AS phrase FROM q UNION ALL SELECT input_seq, 1, q || ' ' || l FROM q WHERE l IS NOT NULL
        UNION ALL SELECT input_seq, CASE WHEN l IS NULL THEN 1 ELSE 2 END, q FROM q UNION ALL SELECT input_seq, CASE WHEN l IS NULL THEN 2 ELSE 3 END, n FROM q""",
    "json_props_parse": "SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS keys, array_to_string(list_transform(json_keys(props), lambda k: json_extract_string(props, '$.' || k)), ',') AS first_values FROM events",
    "page_links": f"""SELECT *, CASE WHEN url IS NULL THEN 'link.unusable' END AS flag FROM (
        SELECT page_id, CAST(nth AS INT) - 1 AS nth, CASE WHEN href = '' OR href LIKE 'javascript%' THEN NULL WHEN href LIKE 'http%' THEN href ELSE 'https://listings.example' || href END AS url FROM (
        {LINKS}))""",
    "teaser_collapse": with_views("v_listings") + "SELECT input_seq, CASE WHEN input_seq % 3 = 2 THEN 'Other ... | ' || trim(nature_of_assets) ELSE trim(nature_of_assets) END AS text, input_seq % 3 = 2 AS uncertain FROM v_listings",
    "html_table_roundtrip": with_views("v_listings") + """SELECT input_seq, notice_type, auction_date, notice_date, corporate_debtor, ip_name, reserve_price, nature_of_assets,
        'https://listings.example/n/' || CAST(input_seq AS VARCHAR) || '.pdf' AS notice_url, CASE WHEN NOT cut THEN 'https://listings.example/d/' || CAST(input_seq AS VARCHAR) || '.pdf' END AS details_url,
        CASE WHEN cut THEN 'cell.missing.details_pdf_url' ELSE '' END AS flags
        FROM (SELECT *, input_seq % 50 = 1 AND date_diff('day', DATE '1990-01-01', notice_date) % 2 = 0 AS cut FROM v_listings)""",
    "malformed_row_reject": with_views("v_listings") + """SELECT CAST(date_diff('day', DATE '1990-01-01', notice_date) AS INT) AS page, CASE WHEN input_seq % 50 = 0 THEN 'row.too_few_cells' ELSE 'good' END AS kind, count(*) AS n
        FROM v_listings GROUP BY 1, 2""",
    "header_mapping": with_views("v_listings", f"h AS (SELECT * FROM (VALUES {', '.join(str((k, f)) for k, f in enumerate(HEADER_FIELDS.values()))}) AS t(nth, field))")
    + f"""SELECT page, CAST(CASE WHEN page % 2 = 1 THEN {len(HEADER_FIELDS) - 1} - nth ELSE nth END AS INT) AS col_idx, field, 'emd_amount_raw' AS missing
        FROM (SELECT DISTINCT CAST(notice_date - DATE '1990-01-01' AS INT) AS page FROM v_listings), h""",
    "prompt_build": with_views("v_listings") + f"SELECT input_seq, '{BEFORE}' || {AS_JSON} || '{AFTER}' AS prompt FROM v_listings",
    "response_parse": with_views("v_listings") + """SELECT input_seq, CASE WHEN input_seq % 4 < 3 THEN corporate_debtor END AS summary, CASE WHEN input_seq % 4 < 2 THEN 1 END AS n_risks,
        CASE input_seq % 4 WHEN 2 THEN 'narrative.missing.risk_notes; narrative.missing.data_gaps' WHEN 3 THEN 'narrative.unparseable' ELSE '' END AS flags FROM v_listings""",
    "result_blocks": f"""SELECT page_id, CAST(nth AS INT) AS nth, title, url, 'About ' || title AS snippet FROM (
        SELECT page_id, url, trim(regexp_replace({PLAIN.format(c="regexp_extract(html, '<title>(.*?)</title>', 1)")}, '\\s+', ' ', 'g')) AS title FROM pages), range(3) r(nth)
        WHERE title <> '' AND (nth <> 1 OR page_id % 2 = 1)""",
    "assembled": with_views("v_listings", *SCORED, "v_registry", REGISTRY, f"asked AS (SELECT *, {CIN} AS number, {STATE_OF} AS state FROM scored)")
    + f"""SELECT input_seq, reserve_price, location, score_a, score_b, score_c, combined, company_name, company_status, paidup_capital,
        concat_ws('; ', {PRICE_FLAG}, {LOCATION_FLAG}, CASE WHEN number IS NULL THEN 'registry.no_cin' WHEN e.state IS NULL THEN 'registry.unmapped_code' WHEN {WHY_GONE} IS NOT NULL THEN 'registry.' || {WHY_GONE}
        WHEN l.cin IS NULL THEN 'registry.no_match' END, {POSSESSION_FLAGS}) AS flags FROM asked e LEFT JOIN lasts l ON l.state = e.state AND l.cin = number AND e.state NOT IN {BAD_FILES}""",
    "assembled_entries": with_views("v_snapshots", *ROUTES, folded("c")) + f"""SELECT c.input_seq, c.listing_key, c.status, c.price_drop,
        CASE WHEN c.status = 'changed' THEN concat_ws('; ', {', '.join(f"CASE WHEN c.prev[{k}] <> c.tracked[{k}] THEN '{t} ' || c.prev[{k}] || ' ' || c.tracked[{k}] END" for k, t in enumerate(TRACKED, 1))}) ELSE '' END AS changes,
        CASE WHEN c.status <> 'collision' THEN e.narrative END AS narrative, r.route = 'reuse' AS enrichment_reused,
        CASE WHEN c.status = 'collision' THEN 'enrichment.skipped_collision' ELSE '' END AS flags
        FROM c JOIN routed r ON c.input_seq = r.input_seq LEFT JOIN enrichment e ON c.listing_key = e.listing_key WHERE c.run_date > {SPLIT}""",
}

SHORT = "page % 2 = 0 AND input_seq % 50 = 1"
ORACLES |= {
    "state_in_buckets": with_views("v_snapshots", folded("c"), final("s", "c")) + f"SELECT listing_key, corporate_debtor, ip_name, {', '.join(TRACKED)}, first_seen, last_seen, last_changed, observations FROM s",
    "history_rerun": ORACLES["change_history"],
    "stream_status": ORACLES["change_status"],
    "collision_log": with_views("v_snapshots", folded("c"), final("s", "c")) + """SELECT CAST(c.input_seq AS VARCHAR) AS incoming_input_seq, c.listing_key, c.run_date AS detected_at, s.corporate_debtor AS existing_corporate_debtor,
        s.ip_name AS existing_ip_name, c.corporate_debtor AS incoming_corporate_debtor, c.ip_name AS incoming_ip_name, FALSE AS resolved FROM c JOIN s USING (listing_key) WHERE c.status = 'collision'""",
    "answer_fields": with_views("v_listings") + """SELECT input_seq, CASE WHEN input_seq % 4 < 2 THEN corporate_debtor END AS summary, CASE WHEN input_seq % 4 < 2 THEN input_seq % 10 END AS confidence,
        CASE WHEN input_seq % 4 < 2 THEN notice_type END AS risk_notes, CASE WHEN input_seq % 4 = 2 THEN 'summary.type; confidence.type' ELSE '' END AS flags FROM v_listings""",
    "answer_extra_keys": with_views("v_listings") + """SELECT input_seq, 'source' AS name, '{"seq":' || CAST(input_seq AS VARCHAR) || '}' AS value, 'OBJECT<seq: BIGINT>' AS type FROM v_listings WHERE input_seq % 4 < 2""",
    "json_value_types": """SELECT event_id, name, CAST(json_extract(props, '$.' || name) AS VARCHAR) AS value,
        CASE json_type(props, '$.' || name) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'BIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(props, '$.' || name) END AS type
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS name FROM events)""",
    "listing_rows_sql": with_views("v_listings", "p AS (SELECT *, CAST(notice_date - DATE '1990-01-01' AS INT) AS page FROM v_listings)") + f"""SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY input_seq) AS INT) AS row_idx, corporate_debtor,
        coalesce(CAST(reserve_price AS VARCHAR), '') AS reserve_price_raw, CASE WHEN {SHORT} THEN 'cell.missing.details_pdf_url' ELSE '' END AS flags FROM p""",
    "page_anchors_sql": f"SELECT page_id, count(*) AS n_links, count(DISTINCT href) AS n_different FROM ({LINKS}) GROUP BY page_id",
}
