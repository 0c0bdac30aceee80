"""DuckDB SQL of the registered queries: the fixtures' SQL, and the operators once more in plain SQL."""

from __future__ import annotations

from ..functions import fixed
from . import fixtures as X

_URL = r"(?is)^([a-z][a-z0-9+.-]*)://([^/?#]*@)?([^/?#:@\x00-\x20<>\\^|%\[\]]+)(?::(\d*))?(/[^?#]*)?(\?[^#]*)?(#.*)?$"


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _hosts(host: str, domains) -> str:
    either = "|".join(d.replace(".", r"\.") for d in domains)
    return rf"regexp_matches(regexp_replace({host}, '^www\.', ''), '(?:^|\.)(?:{either})$')"


def _platform(host: str) -> str:
    names: dict[str, list[str]] = {}
    for domain, name in fixed.PLATFORMS:
        names.setdefault(name, []).append(domain)
    return "CASE " + " ".join(f"WHEN {_hosts(host, d)} THEN '{n}'" for n, d in names.items()) + " ELSE 'Website' END"


def _has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '(?i){pattern}')"


def parsed(source: str, name: str = "urls") -> str:
    """A CTE with the parts of source.url, its platform and its normalised form."""
    get = lambda k: f"regexp_extract(trim(url), '{_URL}', {k})"
    form = lambda x: f"replace(replace(replace(url_encode(url_decode(replace({x}, '+', ' '))), '%20', '+'), '~', '%7E'), '%2A', '*')"
    pairs = f"list_transform(list_filter(string_split(substr(query, 2), '&'), lambda p: p <> ''), lambda p: concat({form("split_part(p, '=', 1)")}, '=', {form("CASE WHEN contains(p, '=') THEN substr(p, instr(p, '=') + 1) ELSE '' END")}))"
    pairs = f"list_filter({pairs}, lambda p: split_part(p, '=', 1) NOT IN ({_in_list(fixed.TRACKING)}))"
    dot = lambda s: f"replace(lower({s}), '%2e', '.')"
    plain_path = f"list_reduce(list_concat([''], string_split(path, '/')[2:]), lambda a, s: CASE {dot('s')} WHEN '.' THEN a WHEN '..' THEN regexp_replace(a, '/[^/]*$', '') ELSE concat(a, '/', s) END)"
    safe = lambda text, unsafe: f"array_to_string(list_transform(string_split({text}, ''), lambda c: CASE WHEN regexp_matches(c, '[^\\x21-\\x7E]|[{unsafe}]') THEN url_encode(c) ELSE c END), '')"
    return f"""
{name}0 AS (
  SELECT *, lower({get(1)}) AS scheme, {get(2)} AS usr, lower({get(3)}) AS host, {get(4)} AS port, {get(5)} AS path, {get(6)} AS query, {get(7)} AS frag
  FROM {source}
), {name}1 AS (
  SELECT *, {_platform("host")} AS platform, regexp_replace({safe(plain_path, '"<>`{}')}, '/+$', '') AS short_path,
         array_to_string({pairs}, '&') AS kept, {safe("frag", '"<>`')} AS safe_frag
  FROM {name}0
), {name} AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE concat(scheme, '://', usr, host,
              CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE concat(':', port) END,
              CASE WHEN short_path = '' THEN '/' ELSE short_path END, CASE WHEN kept = '' THEN '' ELSE concat('?', kept) END, CASE WHEN frag = '#' THEN '' ELSE safe_frag END) END AS norm_url
  FROM {name}1
)"""


def _usable() -> str:
    """Whether a row of a parsed() CTE is neither junk nor blocked. Normalising keeps host and path but for slashes at the end."""
    rules = " OR ".join(f"({_hosts('host', [d])} AND starts_with(lower(short_path), '{p}'))" for d, p in fixed.BLOCKED_PATHS)
    return (
        f"norm_url <> '' AND NOT contains(norm_url, 'webcache') AND NOT ends_with(lower(split_part(norm_url, '?', 1)), '.pdf')"
        f" AND NOT contains(norm_url, 'google.com/search') AND NOT ({_hosts('host', fixed.BLOCKED_HOSTS)} OR {rules})"
    )


def _activity(title: str, description: str) -> str:
    text, u = f"concat({title}, ' ', {description})", "url"
    coded = _has(title, fixed.CONFERENCE_TITLE)
    return f"""CASE WHEN platform <> 'Website' THEN 'SMA'
      WHEN {_hosts("host", fixed.TRIAL_HOSTS)} OR {_has(text, fixed.TRIAL_TEXT)} OR {_has(u, fixed.TRIAL_TEXT)} THEN 'Trials'
      WHEN {_hosts("host", fixed.PUBLISHER_HOSTS)} OR {_has(u, fixed.PUBLISHER_URL)} THEN CASE WHEN {_has(u, fixed.SUPPLEMENT_URL)} OR {coded} THEN 'Conference' ELSE 'Pubs' END
      WHEN {_has(text, fixed.CONFERENCE_TEXT)} OR {_has(u, fixed.CONFERENCE_URL)} OR {coded} THEN 'Conference'
      WHEN {_has(text, fixed.PRESS_TEXT)} OR {_has(u, fixed.PRESS_URL)} THEN 'Press' ELSE 'Other' END"""


def _author() -> str:
    pipe = r"regexp_extract(title, '^([^|]{2,40})\s*\|', 1)"
    on = r"""trim(regexp_extract(title, '^"?([A-Za-z@][\w .''@&-]{1,40}?) on (?:Instagram|Facebook|TikTok)', 1))"""
    slug = "regexp_extract(url, 'facebook\\.com/([^/?#]+)/', 1)"
    return f"""CASE WHEN platform = 'Website' THEN ''
      WHEN {pipe} <> '' AND len(string_split(trim({pipe}), ' ')) <= 4 AND NOT {_has(pipe, fixed.SOCIAL_WORDS)} THEN trim({pipe})
      WHEN {on} <> '' THEN {on} WHEN {slug} IN ({_in_list(fixed.FACEBOOK_PATHS)}) THEN '' ELSE {slug} END"""


URL_NORMALIZE = X.with_tables(X.RESULTS, parsed("results"), select="SELECT page_id, url, norm_url FROM urls")
URL_DEDUPE = X.with_tables(
    X.RESULTS, parsed("results"), select=f"SELECT page_id % 97 AS expert, norm_url, min(page_id) AS page_id FROM urls WHERE {_usable()} GROUP BY 1, 2"
)
PLATFORM_SOURCE = X.with_tables(X.RESULTS, parsed("results"), select="SELECT page_id, host AS source, platform FROM urls")
ACTIVITY = X.with_tables(
    X.RESULTS,
    parsed("results"),
    "described AS (SELECT u.* EXCLUDE (description), concat(u.description, ' ', coalesce(d.text, '')) AS description FROM urls u LEFT JOIN documents d ON d.doc_id = u.page_id)",
    select=f"SELECT page_id, platform, {_activity('title', 'description')} AS activity_type FROM described",
)
SOCIAL_AUTHOR = X.with_tables(X.RESULTS, parsed("results"), select=f"SELECT page_id, platform, {_author()} AS author FROM urls")

# -- dates -----------------------------------------------------------------------------------------

_T = "lower(trim(date_text))"
_AS_OF = f"DATE '{X.AS_OF.isoformat()}'"


def _relative(t: str = _T) -> str:
    unit = lambda u: rf"TRY_CAST(nullif(regexp_extract({t}, '^(\d{{1,15}})\s+{u}s?\s+ago$', 1), '') AS BIGINT)"
    return rf"""CASE WHEN {t} IN ('today', 'just now') THEN 0 WHEN {t} = 'yesterday' THEN 1 WHEN regexp_matches({t}, '^\d+\s+(minute|hour)s?\s+ago$') THEN 0
      WHEN {t} = 'a week ago' THEN 7 WHEN {t} = 'a month ago' THEN 30 WHEN {t} = 'a year ago' THEN 365
      ELSE coalesce({unit("day")}, {unit("week")} * 7, {unit("month")} * 30, {unit("year")} * 365) END"""


def _offset(t: str) -> str:
    """Minutes that the zone at the end of a time is before UTC."""
    part = lambda length: f"coalesce(TRY_CAST(substr({t}, length({t}) - {length}, 2) AS BIGINT), 0)"
    return f"CASE WHEN {t} LIKE '%Z' THEN 0 ELSE CASE substr({t}, length({t}) - 5, 1) WHEN '-' THEN -1 ELSE 1 END * ({part(4)} * 60 + {part(1)}) END"


def _absolute(t: str = "trim(date_text)") -> str:
    # Formats that the fixtures use; anything else is null here and in the operator.
    tests = (
        (r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}$", f"TRY_STRPTIME(replace({t}, '/', '-'), '%Y-%m-%d')"),
        (r"^[A-Za-z]+ \d{1,2}, \d{4}$", f"coalesce(TRY_STRPTIME({t}, '%b %d, %Y'), TRY_STRPTIME({t}, '%B %d, %Y'))"),
        (r"^\d{1,2} [A-Za-z]+ \d{4}$", f"coalesce(TRY_STRPTIME({t}, '%d %b %Y'), TRY_STRPTIME({t}, '%d %B %Y'))"),
        (r"^\d{1,2}[-/]\d{1,2}[-/]\d{4}$", f"TRY_STRPTIME(replace({t}, '/', '-'), '%m-%d-%Y')"),
        (r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[-+]\d\d:\d\d)$", f"TRY_CAST(replace(substr({t}, 1, 19), 'T', ' ') AS TIMESTAMP) - to_minutes({_offset(t)})"),
        (r"^[A-Z][a-z]{2}, \d\d [A-Z][a-z]{2} \d{4} \d\d:\d\d:\d\d GMT$", f"TRY_STRPTIME(substr({t}, 6, 11), '%d %b %Y')"),
    )
    return "CAST(CASE " + " ".join(f"WHEN regexp_matches({t}, '{p}') THEN {e}" for p, e in tests) + " END AS DATE)"


def _within(days_back: int) -> str:
    return f"(abs_day >= {_AS_OF} - {days_back} AND abs_day <= CASE WHEN activity_type = 'Conference' THEN {_AS_OF} + {fixed.EVENT_HORIZON_DAYS} ELSE {_AS_OF} END)"


def read_dates(source: str, name: str = "read") -> str:
    return f"{name} AS (SELECT *, {_relative()} AS rel, {_absolute()} AS abs_day FROM {source})"


def _candidate(days_back: int) -> str:
    return f"CASE WHEN date_text = '' THEN true WHEN rel IS NOT NULL THEN rel <= {days_back} WHEN abs_day IS NULL THEN true ELSE {_within(days_back)} END"


def _decision(days_back: int) -> tuple[str, str]:
    loose = "activity_type IN ('Conference', 'Pubs', 'Trials')"
    keep = f"CASE WHEN trim(date_text) = '' THEN {loose} WHEN rel IS NOT NULL THEN rel <= {days_back} WHEN abs_day IS NULL THEN {loose} ELSE {_within(days_back)} END"
    reason = "CASE WHEN trim(date_text) = '' THEN 'undated' WHEN rel IS NOT NULL THEN 'relative' WHEN abs_day IS NULL THEN 'unparseable' ELSE 'dated' END"
    return keep, reason


RELATIVE_DAYS = X.with_tables(X.DATES, select=f"SELECT event_id, date_text, CAST({_relative()} AS BIGINT) AS days FROM dated")
ABSOLUTE_DATE = X.with_tables(X.DATES, select=f"SELECT event_id, date_text, {_absolute()} AS day FROM dated")
CANDIDATES = X.with_tables(X.DATES, read_dates("dated"), select=f"SELECT event_id, activity_type FROM read WHERE {_candidate(9)}")
RECENT = X.with_tables(X.DATES, read_dates("dated"), select="SELECT event_id, activity_type, {} AS keep, {} AS reason FROM read".format(*_decision(9)))

# -- roster ----------------------------------------------------------------------------------------

CLEAN = """
clean AS (
  SELECT CAST(substr(kol_id, 2) AS BIGINT) AS k, kol_id, trim(kol_name) AS kol_name, trim(specialty) AS specialty, was, CASE WHEN was AND trim(suffix) = '' THEN trim(affiliation) ELSE trim(suffix) END AS suffix2,
         CASE WHEN was THEN '' ELSE trim(affiliation) END AS affiliation2, row_number() OVER (PARTITION BY kol_id ORDER BY kol_name, suffix, affiliation, specialty) AS roster_seq
  FROM (SELECT *, regexp_full_match(trim(affiliation), '[A-Z]{2,6}([\\s,;./]+[A-Z]{2,6})*') AS was FROM roster) WHERE kol_id <> '' AND trim(kol_name) <> ''
)"""
_ANY_CASE = "|".join(fixed.CREDENTIALS_ANY)
_UPPER = "|".join(c.upper() for c in fixed.CREDENTIALS_UPPER)
_AFTER_COMMA = f"(?i),\\s*({_ANY_CASE}|{_UPPER})([\\s,]+({_ANY_CASE}|{_UPPER}))*$"
_PLAIN = """trim(regexp_replace(regexp_replace(regexp_replace(marked, '\\([^)]*\\)', ' ', 'g'), '[()"]', ' ', 'g'), '\\s+', ' ', 'g'))"""
#: Names read step by step: quoted nicknames as parentheticals, parentheticals off, Dr. off, credentials off, surname.
FORMS = f"""
named_1 AS (SELECT *, regexp_replace(kol_name, '"([^"]*)"', '(\\1)', 'g') AS marked FROM clean), named_2 AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace({_PLAIN}, '(?i)^dr\\.?\\s+', ''), '{_AFTER_COMMA}', ''), '^(\\S+ \\S+.*?)( ({_UPPER}|(?i:{_ANY_CASE})))+$', '\\1') AS full_form,
         regexp_extract(marked, '\\(([^)]*)\\)', 1) AS token, regexp_matches(marked, '\\)\\s*$') AS at_end
  FROM named_1
), named_3 AS (SELECT *, full_form = '' AS nameless, string_split(full_form, ' ') AS w FROM named_2), named_4 AS (
  SELECT *, CASE WHEN len(w) >= 3 AND replace(lower(w[-2]), '.', '') IN ({_in_list(fixed.SURNAME_PARTICLES)}) THEN 2 ELSE 1 END AS n_last FROM named_3
), named_5 AS (SELECT *, array_to_string(w[len(w) - n_last + 1:], ' ') AS last, list_transform(w[2:len(w) - n_last], lambda x: x[1]) AS initials FROM named_4), forms AS (
  SELECT * EXCLUDE (w, initials), concat(w[1], ' ', last) AS short_form, array_to_string(list_concat([w[1]], initials, [last]), ' ') AS initial_form,
         CASE WHEN length(token) < 2 OR len(w) < 2 THEN '' WHEN at_end THEN concat(w[1], ' ', token) ELSE concat(token, ' ', last) END AS extra_form,
         array_to_string(string_split(trim(regexp_replace(regexp_replace(affiliation2, '["()]', '', 'g'), '\\s+', ' ', 'g')), ' ')[1:{fixed.MAX_ANCHOR_WORDS}], ' ') AS anchor
  FROM named_5
)"""
_ALL = "list_filter(CASE WHEN anchor <> '' THEN [full_form, short_form] ELSE [full_form, short_form, initial_form, extra_form] END, lambda n: n <> '')"
_OWN = f"list_filter({_ALL}, lambda n, i: list_position({_ALL}, n) = i)"
_NAMES = f"""CASE WHEN len({_OWN}) = 1 THEN concat('"', full_form, '"') ELSE concat('("', array_to_string({_OWN}, '" OR "'), '")') END"""
_CLUSTER_LIST = "[" + ", ".join("'" + (f" {c}" if c else "") + "'" for c in fixed.CLUSTERS) + "]"
MANIFEST = f"""
numbers AS (SELECT unnest([1, 2, 3, 4, 5, 6]) AS cluster_no), manifest AS (
  SELECT forms.*, cluster_no, concat({_NAMES}, ' {fixed.HONORIFIC}', ({_CLUSTER_LIST})[cluster_no], CASE WHEN anchor <> '' THEN concat(' "', anchor, '"') ELSE '' END) AS query
  FROM forms, numbers WHERE NOT nameless
)"""
ROSTER_CLEAN = X.with_tables(
    X.ROSTER, CLEAN, select="SELECT kol_id, CAST(roster_seq AS INT) AS roster_seq, trim(kol_name) AS kol_name, suffix2 AS suffix, affiliation2 AS affiliation, specialty, was AS affiliation_was_suffix FROM clean"
)
NAME_FORMS = X.with_tables(
    X.ROSTER, CLEAN, FORMS,
    select="""SELECT kol_id, CAST(roster_seq AS INT) AS roster_seq, full_form AS clean_name, CASE WHEN NOT nameless THEN full_form END AS full_form, CASE WHEN NOT nameless THEN short_form END AS short_form,
       CASE WHEN NOT nameless THEN initial_form END AS initial_form, CASE WHEN NOT nameless THEN extra_form END AS extras FROM forms""",
)
QUERY_MANIFEST = X.with_tables(X.ROSTER, CLEAN, FORMS, MANIFEST, select="SELECT kol_id, CAST(roster_seq AS INT) AS roster_seq, CAST(cluster_no AS INT) AS cluster_no, query FROM manifest")
QUERY_CHUNKS = X.with_tables(
    X.ROSTER, CLEAN, FORMS, MANIFEST,
    select="""SELECT kol_id, CAST(roster_seq AS INT) AS roster_seq, CAST((cluster_no - 1) // 4 + 1 AS INT) AS chunk_no, 'qdr:m' AS tbs, '10' AS "limit",
       string_agg(query, ' | ' ORDER BY cluster_no) AS queries FROM manifest GROUP BY 1, 2, 3""",
)
FAILED_QUERIES = X.with_tables(
    X.ROSTER, CLEAN, FORMS, MANIFEST,
    select="""SELECT kol_id, CAST(roster_seq AS INT) AS roster_seq, CAST(cluster_no AS INT) AS cluster_no, query FROM manifest
       WHERE (k * 7 + cluster_no) % 97 = 0 OR (k * 5 + cluster_no) % 89 = 0""",
)

# -- search results --------------------------------------------------------------------------------

ITEMS = """
published AS (
  SELECT hits.*, concat('K', CAST(k AS VARCHAR)) AS kol_id,
         CASE page_id % 6 WHEN 0 THEN '2024-01-28' WHEN 1 THEN '3 days ago' WHEN 2 THEN '' WHEN 3 THEN 'Jan 5, 2024' WHEN 4 THEN '2024-06-01' ELSE 'press release' END AS date_text
  FROM hits WHERE k % 10 <> 8 AND k < (SELECT count(*) FROM customer)
), single AS (
  SELECT *, page_id % 11 = 0 AS lost, CASE WHEN page_id % 11 = 0 THEN CASE WHEN cluster_no <= 4 THEN 1 ELSE 5 END ELSE cluster_no END AS of FROM published
), merged AS (
  SELECT DISTINCT kol_id, k, cluster_no FROM published WHERE k % 4 = 0
), flat AS (
  SELECT s.kol_id, s.of AS cluster_no, s.page_id AS item_pos, 0 AS result_pos, s.url, s.title, s.description, s.date_text FROM single s
  WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.kol_id = s.kol_id AND m.cluster_no = s.of)
  UNION ALL
  SELECT p.kol_id, p.cluster_no, 1000000000 AS item_pos, row_number() OVER (PARTITION BY p.kol_id, p.cluster_no ORDER BY page_id, p.url) - 1 AS result_pos, url, title, description, date_text
  FROM published p WHERE k % 4 = 0 AND page_id % 2 = 0
), first_hits AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY kol_id, trim(url) ORDER BY cluster_no, item_pos, result_pos, url) AS n FROM flat) WHERE n = 1
)"""
SERP_ATTRIBUTION = X.with_tables(
    X.RESULTS, X.SERP, ITEMS,
    select="""SELECT kol_id, page_id AS item_pos, CAST(of AS INT) AS cluster_no, lost AS unattributed FROM single
       UNION ALL SELECT kol_id, 1000000000 AS item_pos, CAST(cluster_no AS INT) AS cluster_no, false AS unattributed FROM merged""",
)
SERP_DEDUPE = X.with_tables(
    X.RESULTS, X.SERP, ITEMS, select="SELECT kol_id, CAST(cluster_no AS INT) AS cluster_no, item_pos, CAST(result_pos AS INT) AS result_pos, url FROM first_hits"
)


def _truthy(value: str, field: str) -> str:
    """The text of a JSON field, null where it counts as nothing."""
    at = f"json_extract({value}, '$.{field}')"
    return f"CASE json_type({at}) WHEN 'VARCHAR' THEN nullif({value}->>'$.{field}', '') WHEN 'BOOLEAN' THEN nullif({value}->>'$.{field}', 'false') WHEN 'NULL' THEN NULL ELSE nullif({value}->>'$.{field}', '0') END"


#: The dumped lines, parsed and read item by item and result by result.
VARIANT_DUMPS = X.with_tables(
    X.ROSTER, CLEAN, FORMS, MANIFEST, X.RESULTS, X.SERP, X.LINES,
    f"""lines AS (SELECT CAST(line AS JSON) AS j FROM dumped WHERE json_valid(line)), items AS (
  SELECT j, j->>'$.kol_id' AS kol_id, CAST(j->>'$.item_pos' AS BIGINT) AS item_pos, CAST(j->>'$.chunk_no' AS INT) AS chunk_no, CAST(j->>'$.cluster_no' AS INT) AS own,
         lower(trim(coalesce({_truthy("j", "keyword")}, {_truthy("j", "query")}, {_truthy("j", "searchQuery")}, ''))) AS echo,
         coalesce(j->>'$.page_number' = 'all', false) AS merged, coalesce(json_type(j, '$.results') = 'ARRAY', false) AS usable
  FROM lines
), placed AS (
  SELECT i.*, CASE WHEN own IS NULL THEN 0 ELSE 1 END AS pass_no, coalesce(own, m.cluster_no, CASE chunk_no WHEN 1 THEN 1 ELSE 5 END) AS cluster_no
  FROM items i LEFT JOIN manifest m ON own IS NULL AND m.kol_id = i.kol_id AND m.roster_seq = 1 AND (m.cluster_no <= 4) = (chunk_no = 1) AND lower(m.query) = echo
), seen AS (
  SELECT *, min(CASE WHEN merged THEN item_pos END) OVER q AS first_pos, arg_min(usable, CASE WHEN merged THEN item_pos END) OVER q AS first_usable
  FROM placed WINDOW q AS (PARTITION BY pass_no, kol_id, cluster_no)
), places AS (
  SELECT *, unnest(range(CAST(json_array_length(j, '$.results') AS BIGINT))) AS result_pos FROM seen WHERE usable AND (first_pos IS NULL OR NOT first_usable OR item_pos = first_pos)
), found AS (SELECT * EXCLUDE (j), json_extract(j, concat('$.results[', result_pos, ']')) AS r FROM places),
addressed AS (SELECT *, coalesce({_truthy("r", "url")}, {_truthy("r", "link")}, '') AS url FROM found)""",
    select=f"""SELECT kol_id, CAST(pass_no AS INT) AS pass_no, CAST(cluster_no AS INT) AS cluster_no, item_pos, CAST(result_pos AS INT) AS result_pos, url,
       coalesce({_truthy("r", "position")}, '') AS position, CAST(r->>'$.rank.group' AS INT) AS rank_group
       FROM addressed WHERE trim(url) <> '' QUALIFY row_number() OVER (PARTITION BY kol_id, trim(url) ORDER BY pass_no, cluster_no, item_pos, result_pos, url) = 1""",
)
PROCESSED = parsed("first_hits", "p_urls") + f", rows_ AS (SELECT *, {_activity('title', 'description')} AS activity_type, {_author()} AS author FROM p_urls)"
CANDIDATE_ROWS = f"{read_dates('rows_', 'dated_rows')}, candidates AS (SELECT * FROM dated_rows WHERE {_candidate(9)})"
FRONTIER = X.with_tables(X.RESULTS, X.SERP, ITEMS, PROCESSED, CANDIDATE_ROWS, select="SELECT DISTINCT url FROM candidates WHERE platform = 'Website'")

# -- pages -----------------------------------------------------------------------------------------

#: What is put before the end of the head or into the body of a page; twelve forms by page id.
INJECTED = """
injected AS (
  SELECT page_id, url, CASE page_id % 12
    WHEN 0 THEN replace(html, '</head>', '<meta property="og:title" content="OG  title"><meta property="article:published_time" content=" 2024-01-20T08:00:00Z "></head>')
    WHEN 1 THEN replace(html, '</head>', '<meta name="twitter:title" content="Tweet"><meta name="date" content="2024-01-21"></head>')
    WHEN 2 THEN replace(html, '</head>', '<meta name="description" content="Plain"><meta name="twitter:description" content="T"></head>')
    WHEN 3 THEN replace(html, '</head>', '<meta property="og:description" content="OG &amp; more"><meta name="author" content="A. Writer"></head>')
    WHEN 4 THEN replace(html, '</head>', '<meta name="byl" content="By B"><meta itemprop="dateCreated" content="2024-01-22"></head>')
    WHEN 5 THEN replace(html, '</head>', '<script type="application/ld+json">{"@type": "Article", "datePublished": "2024-01-23"}</script></head>')
    WHEN 6 THEN replace(html, '</head>', '<script type="application/ld+json">not json</script><script type="application/ld+json">{"a": {"x": 1}, "@graph": [{"b": 1}, {"dateCreated": "2024-01-24"}]}</script></head>')
    WHEN 7 THEN replace(html, '<article>', '<time>no</time><time datetime="2024-01-25">x</time><article>')
    WHEN 8 THEN replace(html, '<article>', '<div class="meta post-date"> Jan <b>26</b>, 2024 </div><article>')
    WHEN 9 THEN replace(html, '</head>', '<meta property="og:title" content="Just a moment..."><meta name="author" content="Nobody"></head>')
    WHEN 10 THEN replace(html, '<article>', '<span itemprop="datePublished" content="2024-01-27">then</span><article>')
    ELSE html END AS html
  FROM {pages}
)"""
_TITLE = "trim(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'))"


def _unescaped(text: str) -> str:
    for name, sign in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{sign}')"
    return text


def _first_meta(selectors) -> str:
    """The content of the first of these meta elements that has any, as the pages write them."""
    return "coalesce(" + ", ".join(f"""nullif(regexp_extract(html, '<meta {key}="{name}" content="([^"]*)"', 1), '')""" for key, name in selectors) + ")"


_PROPS, _CLASSES = "|".join(fixed.DATE_ITEMPROPS), "|".join(fixed.DATE_CLASSES)
_DATES = (
    f"trim({_first_meta(fixed.DATE_META)})",
    """regexp_extract(html, '<time datetime="([^"]*)"', 1)""",
    f"""regexp_extract(html, '<script type="application/ld\\+json">[^<]*"(?:{_PROPS})": "([^"]*)"', 1)""",
    f"""regexp_extract(html, 'itemprop="(?:{_PROPS})" content="([^"]*)"', 1)""",
    f"""trim(regexp_replace(regexp_extract(html, 'class="[^"]*(?:{_CLASSES})"[^>]*>(.*?)</div>', 1), '<[^>]*>', '', 'g'))""",
)
#: Metadata read from the HTML, by the elements that the pages can have.
META = INJECTED.strip("\n") + f""", found_meta AS (
  SELECT page_id, url, trim(regexp_replace({_unescaped("coalesce(" + _first_meta(fixed.TITLE_META) + ", regexp_extract(html, '<title>([^<]*)</title>', 1), '')")}, '\\s+', ' ', 'g')) AS t,
         {_unescaped(_first_meta(fixed.DESCRIPTION_META))} AS d, {_unescaped(_first_meta(fixed.AUTHOR_META))} AS a, coalesce({", ".join(f"nullif({x}, '')" for x in _DATES)}) AS w
  FROM injected
), meta AS (
  SELECT page_id, url AS meta_url, CASE WHEN blocked THEN '' ELSE t END AS m_title, CASE WHEN blocked THEN '' ELSE coalesce(d, '') END AS m_description,
         CASE WHEN blocked THEN '' ELSE coalesce(a, '') END AS m_author, CASE WHEN blocked THEN '' ELSE coalesce(w, '') END AS m_date
  FROM (SELECT *, {_has("t", "(?:" + fixed.BLOCK_TITLE + ")")} AS blocked FROM found_meta)
)"""
PAGE_METADATA = X.with_tables(META, select="SELECT page_id, m_title AS title, m_description AS description, m_author AS author, m_date AS published_date FROM meta")
PAGE_OVERLAY = X.with_tables(
    X.RESULTS, parsed("results"), META,
    select=f"""SELECT u.page_id, coalesce(nullif(m_title, ''), title) AS title, coalesce(nullif(m_description, ''), description) AS description,
       coalesce(nullif(m_author, ''), {_author()}) AS author, coalesce(m_date, '') AS published_date
       FROM urls u LEFT JOIN meta ON meta_url = u.url AND platform = 'Website'""",
)
RUN = (
    X.RESULTS, X.SERP, ITEMS, PROCESSED, CANDIDATE_ROWS,
    f"plain_meta AS (SELECT url AS meta_url, {_TITLE} AS m_title FROM pages), enriched AS (SELECT c.* EXCLUDE (title), coalesce(nullif(m_title, ''), title) AS title FROM candidates c LEFT JOIN plain_meta ON meta_url = c.url AND platform = 'Website')",
    "decided AS (SELECT *, {} AS keep, {} AS reason FROM enriched)".format(*_decision(9)),
    f"""final_rows AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY kol_id, norm_url ORDER BY cluster_no, item_pos, result_pos, url) AS n FROM decided WHERE keep AND {_usable()}) WHERE n = 1)""",
)
#: The same with the pages' own metadata: what was read from results is read again from what pages say.
ENRICHED_RUN = (
    *RUN[:5], META,
    f"""overlaid AS (
  SELECT c.* EXCLUDE (title, description, author, date_text, rel, abs_day), coalesce(nullif(m_title, ''), title) AS title, coalesce(nullif(m_description, ''), description) AS description,
         coalesce(nullif(m_author, ''), author) AS author, coalesce(nullif(m_date, ''), date_text) AS date_text
  FROM candidates c LEFT JOIN meta ON meta_url = c.url AND platform = 'Website'
), {read_dates("overlaid", "enriched")}""",
    *RUN[6:],
)
_OUTPUT = "SELECT kol_id, url, norm_url, title, description, author, date_text AS published_date, host AS source, platform, activity_type, CAST(cluster_no AS INT) AS cluster_no FROM final_rows"
MONITOR_ENRICHED = X.with_tables(*ENRICHED_RUN, select=_OUTPUT)
MONITOR_OUTPUT = X.with_tables(
    *RUN, select="SELECT kol_id, url, norm_url, title, description, author, date_text AS published_date, host AS source, platform, activity_type, CAST(cluster_no AS INT) AS cluster_no FROM final_rows"
)
_STAGES = (("raw", "flat", "''"), ("unique", "first_hits", "''"), ("candidates", "candidates", "''"), ("dated", "decided", "concat(CASE WHEN keep THEN 'KEEP' ELSE 'REMOVE' END, ' ', reason)"), ("final", "final_rows", "''"))
STAGE_COUNTS = X.with_tables(*RUN, select=" UNION ALL ".join(f"SELECT kol_id, 1 AS roster_seq, '{name}' AS stage, {reason} AS reason, count(*) AS n FROM {table} GROUP BY ALL" for name, table, reason in _STAGES))
RUN_HEALTH = X.with_tables(
    *RUN, X.ROSTER, CLEAN, FORMS, MANIFEST,
    """failed_experts AS (SELECT kol_id, 1 AS roster_seq FROM clean WHERE k % 41 = 0 AND roster_seq = 1), good AS (SELECT f.* FROM final_rows f ANTI JOIN failed_experts e ON f.kol_id = e.kol_id),
    lost_queries AS (SELECT m.* FROM manifest m ANTI JOIN failed_experts e ON m.kol_id = e.kol_id AND m.roster_seq = e.roster_seq WHERE (k * 7 + cluster_no) % 97 = 0 OR (k * 5 + cluster_no) % 89 = 0)""",
    select="""SELECT (SELECT count(*) FROM clean) AS total_kols, (SELECT count(*) FROM failed_experts) AS kols_failed, (SELECT count(*) FROM lost_queries) AS queries_failed,
      (SELECT count(*) FROM forms f WHERE NOT nameless AND NOT (roster_seq = 1 AND k % 41 = 0) AND NOT (roster_seq = 1 AND EXISTS (SELECT 1 FROM good g WHERE g.kol_id = f.kol_id))) AS kols_zero_results,
      (SELECT count(*) FROM good) AS total_results, CAST((SELECT count(*) FROM failed_experts) AS DOUBLE) / (SELECT count(*) FROM clean) * 100 > 10 AS degraded""",
)
PROMOTE_OUTPUT = X.with_tables(
    X.RESULTS, parsed("results"),
    select=f"""SELECT '' AS "KOL_ID", '' AS "KOL_Name", '' AS "Search_Query", title AS "Title", description AS "Description", url AS "URL", '' AS "Published_Date", {_author()} AS "Author", '' AS "Position",
       host AS "Source", platform AS "Platform", '' AS "Activity_Type", '' AS "Validity", '' AS "Validity_Signals" FROM urls WHERE {_usable()}""",
)

# -- identity and corpus ---------------------------------------------------------------------------

_HAY = "concat(' ', trim(regexp_replace(lower(text), '[^a-z0-9_-]+', ' ', 'g')), ' ')"
_STOP = _in_list(fixed.AFFILIATION_STOPWORDS)
_PRIMARY = _in_list(fixed.CLINICAL_PRIMARY)
IDENTITY = f"""
texts AS (SELECT doc_id, m.kol_id, {_HAY} AS hay, f.* EXCLUDE (kol_id) FROM mentions m JOIN forms f ON f.kol_id = m.kol_id AND f.roster_seq = 1), looked AS (
  SELECT *, list_filter([lower(full_form), lower(short_form), lower(initial_form), lower(extra_form)], lambda n: n <> '') AS every,
         list_filter(list_transform(regexp_extract_all(lower(affiliation2), '[a-z'']{{4,}}'), lambda t: replace(t, '''', '')), lambda t: t NOT IN ({_STOP})) AS aff,
         list_transform(regexp_extract_all(lower(specialty), '[a-z]{{6,}}'), lambda t: substr(t, 1, 7)) AS spec,
         list_filter(list_transform(regexp_split_to_array(lower(suffix2), '[,;/\\s]+'), lambda t: replace(t, '.', '')), lambda t: len(t) BETWEEN 2 AND 8) AS suf
  FROM texts
), found AS (
  SELECT *, len(list_filter(every, lambda n: n <> lower(short_form) AND contains(hay, concat(' ', n, ' ')))) > 0 AS strong, contains(hay, concat(' ', lower(short_form), ' ')) AS weak,
         len(list_filter(aff, lambda t: contains(hay, concat(' ', t, ' ')) OR contains(hay, concat(' ', t, 's ')))) > 0 AS s_aff,
         len(list_filter(spec, lambda t: contains(hay, t))) > 0 AS s_spec,
         len(list_filter(every, lambda n: regexp_matches(hay, concat(' {fixed.ROLES} (?:', split_part(n, ' ', 1), ' )?', substr(n, instr(n, ' ') + 1), ' | (?:', split_part(n, ' ', 1), ' )?', substr(n, instr(n, ' ') + 1),
           ' {fixed.DEGREES} | ', split_part(n, ' ', 1), ' \\w ', substr(n, instr(n, ' ') + 1), ' {fixed.DEGREES} ')))) > 0 AS s_titled,
         flatten(list_transform(every, lambda n: flatten(list_transform(regexp_extract_all(hay, concat(' ', n, ' ((?:[a-z-]{{2,8}} ){{1,3}})'), 1), lambda a: string_split(trim(a), ' '))))) AS adj
  FROM looked
), judged AS (
  SELECT *, CASE WHEN len(suf) > 0 THEN len(list_filter(adj, lambda t: list_contains(suf, t))) > 0 ELSE false END AS s_suffix,
         CASE WHEN len(list_filter(suf, lambda t: t IN ({_PRIMARY}))) > 0 THEN list_filter(adj, lambda t: t IN ({_PRIMARY}) AND NOT list_contains(suf, t))[-1] END AS conflict
  FROM found
), said AS (
  SELECT *, list_filter([CASE WHEN s_suffix THEN 'suffix-match' ELSE '' END, CASE WHEN s_aff THEN 'affiliation' ELSE '' END, CASE WHEN s_spec THEN 'specialty' ELSE '' END, CASE WHEN s_titled THEN 'titled-name' ELSE '' END], lambda x: x <> '') AS signals
  FROM judged
), verdicts AS (
  SELECT doc_id, kol_id, CASE WHEN NOT nameless AND (strong OR weak) AND conflict IS NULL AND len(signals) > 0 THEN 'VALID' ELSE 'REVIEW' END AS validity,
         CASE WHEN nameless THEN 'unparseable-name' WHEN NOT (strong OR weak) THEN 'name-not-visible' WHEN conflict IS NOT NULL THEN concat('suffix-conflict:', conflict)
              WHEN len(signals) = 0 THEN CASE WHEN strong THEN 'no-medical-context' ELSE 'short-name-only' END
              ELSE concat(CASE WHEN strong THEN 'full-name+' ELSE '' END, array_to_string(signals, '+')) END AS validity_signals
  FROM said
)"""
IDENTITY_VERDICT = X.with_tables(X.ROSTER, CLEAN, FORMS, X.MENTIONS, IDENTITY, select="SELECT * FROM verdicts")
IDENTITY_COUNTS = X.with_tables(X.ROSTER, CLEAN, FORMS, X.MENTIONS, IDENTITY, select="SELECT validity, validity_signals, count(*) AS n FROM verdicts GROUP BY ALL")


def _hits(terms) -> str:
    return " + ".join(f"CAST(contains(hay, ' {t} ') AS INT)" for t in terms)


SEARCH = f"""
hays AS (SELECT doc_id, {_HAY} AS hay FROM mentions), counted AS (
  SELECT *, {_hits(fixed.HONORIFIC_TERMS)} AS honorific, {", ".join(f"{_hits(t)} AS {n}" for n, t in fixed.CLUSTER_TERMS.items())} FROM hays
), said_names AS (
  SELECT DISTINCT kol_id, CAST(roster_seq AS INT) AS roster_seq, kind, lower(form) AS form, concat(' ', trim(regexp_replace(lower(anchor), '[^a-z0-9_-]+', ' ', 'g')), ' ') AS anchor FROM (
    SELECT *, 'full' AS kind, full_form AS form FROM forms UNION ALL SELECT *, 'short', short_form FROM forms UNION ALL SELECT *, 'initial', initial_form FROM forms
    UNION ALL SELECT *, 'extra', extra_form FROM forms WHERE extra_form <> '') WHERE NOT nameless
), matches AS (
  SELECT n.kol_id, n.roster_seq, n.kind, n.form, n.anchor, c.* FROM said_names n JOIN counted c ON contains(c.hay, concat(' ', n.form, ' '))
)"""
CORPUS_ANSWERS = (
    f"""answers AS (
      SELECT kol_id, roster_seq, doc_id, count(DISTINCT form) AS n_forms, max(honorific) AS honorific, {", ".join(f"max({n}) AS {n}" for n in fixed.CLUSTER_TERMS)}
      FROM matches WHERE honorific > 0 AND (anchor = '  ' OR contains(hay, anchor)) GROUP BY ALL
    ), each_cluster AS (
      {" UNION ALL ".join(f"SELECT kol_id, roster_seq, {i} AS cluster_no, doc_id, n_forms + honorific{'' if n is None else f' + {n}'} AS n_terms FROM answers" + ('' if n is None else f' WHERE {n} > 0') for i, n in enumerate([None, *fixed.CLUSTER_TERMS], 1))}
    ), ranked AS (SELECT *, row_number() OVER (PARTITION BY kol_id, roster_seq, cluster_no ORDER BY n_terms DESC, doc_id) AS rank FROM each_cluster)""",
)
CORPUS_RANKED = "SELECT kol_id, roster_seq, CAST(cluster_no AS INT) AS cluster_no, doc_id, CAST(n_terms AS BIGINT) AS n_terms, CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 10"
CORPUS_SEARCH = X.with_tables(X.ROSTER, CLEAN, FORMS, X.MENTIONS, SEARCH, *CORPUS_ANSWERS, select=CORPUS_RANKED)
_TERMS = [("honorific", t) for t in fixed.HONORIFIC_TERMS] + [(n, t) for n, terms in fixed.CLUSTER_TERMS.items() for t in terms]
_ANY = [("honorific", "(any)", " OR ".join(f"contains(hay, ' {t} ')" for t in fixed.HONORIFIC_TERMS)), ("topic", "(any)", " OR ".join(f"contains(hay, ' {t} ')" for n, t in _TERMS if n != "honorific"))]
TERM_REACH = X.with_tables(
    X.MENTIONS, f"hays AS (SELECT {_HAY} AS hay FROM mentions)",
    select=" UNION ALL ".join(f"SELECT '{n}' AS topic, '{t}' AS term, count(*) FILTER (WHERE {c}) AS n_docs, CAST(count(*) FILTER (WHERE {c}) AS DOUBLE) / count(*) AS share FROM hays" for n, t, c in [*[(n, t, f"contains(hay, ' {t} ')") for n, t in _TERMS], *_ANY]),
)
FORM_REACH = X.with_tables(
    X.ROSTER, CLEAN, FORMS, X.MENTIONS, SEARCH, "pairs AS (SELECT DISTINCT kol_id, roster_seq, doc_id, kind FROM matches), total AS (SELECT count(*) AS n FROM (SELECT DISTINCT kol_id, roster_seq, doc_id FROM pairs))",
    select=" UNION ALL ".join(f"SELECT '{k}' AS form_kind, (SELECT count(*) FROM pairs WHERE kind = '{k}') AS n_pairs, CAST((SELECT count(*) FROM pairs WHERE kind = '{k}') AS DOUBLE) / n AS share FROM total" for k in ("full", "short", "initial", "extra")),
)

# -- the remaining operators -----------------------------------------------------------------------

MANIFEST_SUBSET = X.with_tables(X.ROSTER, CLEAN, FORMS, MANIFEST, select="SELECT kol_id, CAST(roster_seq AS INT) AS roster_seq, CAST(cluster_no AS INT) AS cluster_no, query FROM manifest WHERE cluster_no IN (1, 3, 4, 6)")
#: The forms are read from the name; one is dropped in each of three steps while there are too many words.
_MANY = "len(l) > 2 AND CAST(list_sum(list_transform(l, lambda n: len(string_split(n, ' ')))) AS BIGINT) + len(l) - 1 > 15"
_FEWER = f"CASE WHEN {_MANY} THEN CASE WHEN list_contains(l, initial) AND initial <> l[1] AND initial <> l[2] THEN list_filter(l, lambda n: n <> initial) ELSE l[1:len(l) - 1] END ELSE l END"
NAME_BUDGET = X.with_tables(
    X.LONG_NAMES,
    """cut AS (
      SELECT kol_id, string_split(trim(regexp_replace(regexp_replace(kol_name, '\\([^)]*\\)', '', 'g'), ' +', ' ', 'g')), ' ') AS w, regexp_extract_all(kol_name, '\\(([^)]*)\\)', 1) AS p, ends_with(kol_name, ')') AS other
      FROM long_names
    ), made AS (
      SELECT kol_id, array_to_string(w, ' ') AS whole, concat(w[1], ' ', w[-1]) AS short, array_to_string(list_concat([w[1]], list_transform(w[2:len(w) - 1], lambda m: m[1]), [w[-1]]), ' ') AS initial,
             CASE WHEN other THEN [concat(p[1], ' ', w[-1]), concat(w[1], ' ', p[2])] ELSE [concat(p[1], ' ', w[-1])] END AS extras
      FROM cut
    ), s0 AS (SELECT kol_id, initial, list_concat([whole, short, initial], extras) AS l FROM made)""",
    *[f"s{i} AS (SELECT kol_id, initial, {_FEWER} AS l FROM s{i - 1})" for i in (1, 2, 3)],
    select=f"""SELECT kol_id, concat('("', array_to_string(l, '" OR "'), '") {fixed.HONORIFIC}') AS query FROM s3""",
)
WEBSITE_ONLY = X.with_tables(X.RESULTS, parsed("results"), select=f"SELECT page_id, norm_url, platform FROM urls WHERE {_usable()} AND platform = 'Website'")
PAGE_BODY = f"""
WITH bodies AS (
  SELECT url, coalesce({_TITLE}, '') AS title, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<body>(.*?)(?:</body>.*)?$', 1), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g') AS x FROM pages
)
SELECT url, title, substr(trim(regexp_replace({_unescaped("x")}, '\\s+', ' ', 'g')), 1, {fixed.BODY_CHARS}) AS body_text FROM bodies
"""
_GATED = (X.ROSTER, CLEAN, FORMS, X.MENTIONS, IDENTITY)
GATE_MODES = X.with_tables(
    *_GATED,
    select="""SELECT doc_id, kol_id, 'off' AS mode, '' AS validity, '' AS validity_signals FROM verdicts UNION ALL SELECT doc_id, kol_id, 'tag', validity, validity_signals FROM verdicts
      UNION ALL SELECT doc_id, kol_id, 'drop', validity, validity_signals FROM verdicts WHERE validity = 'VALID'""",
)
GATED_HEALTH = X.with_tables(
    *_GATED, MANIFEST,
    """failed_experts AS (SELECT kol_id, 1 AS roster_seq, trim(kol_name) AS kol_name FROM clean WHERE k % 41 = 0 AND roster_seq = 1), kept AS (SELECT v.* FROM verdicts v ANTI JOIN failed_experts e ON v.kol_id = e.kol_id),
    lost_queries AS (SELECT m.* FROM manifest m ANTI JOIN failed_experts e ON m.kol_id = e.kol_id AND m.roster_seq = e.roster_seq WHERE (k * 7 + cluster_no) % 97 = 0 OR (k * 5 + cluster_no) % 89 = 0),
    few AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kol_id, roster_seq ORDER BY cluster_no) AS nth FROM lost_queries) WHERE nth <= 3),
    held AS (SELECT *, coalesce(sum(n) OVER (ORDER BY kol_id, roster_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT kol_id, roster_seq, count(*) AS n FROM few GROUP BY ALL)),
    modes AS (SELECT unnest(['tag', 'drop']) AS mode), finals AS (SELECT mode, kept.* FROM kept, modes WHERE mode = 'tag' OR validity = 'VALID'),
    searched AS (SELECT kol_id, roster_seq FROM forms WHERE NOT nameless AND NOT (roster_seq = 1 AND k % 41 = 0))""",
    select="""SELECT mode, (SELECT count(*) FROM clean) AS total_kols, (SELECT count(*) FROM failed_experts) AS kols_failed, (SELECT count(*) FROM lost_queries) AS queries_failed,
      (SELECT count(*) FROM searched s WHERE NOT (roster_seq = 1 AND kol_id IN (SELECT kol_id FROM finals f WHERE f.mode = modes.mode))) AS kols_zero_results,
      (SELECT count(*) FROM finals f WHERE f.mode = modes.mode AND validity = 'REVIEW') AS review_rows, (SELECT count(*) FROM finals f WHERE f.mode = modes.mode) AS total_results,
      CASE mode WHEN 'drop' THEN (SELECT count(*) FROM kept WHERE validity <> 'VALID') ELSE 0 END AS dropped_by_gate,
      CAST((SELECT count(*) FROM failed_experts) AS DOUBLE) / (SELECT count(*) FROM clean) * 100 AS failure_rate_pct, CAST((SELECT count(*) FROM failed_experts) AS DOUBLE) / (SELECT count(*) FROM clean) * 100 > 10 AS degraded,
      (SELECT string_agg(kol_name, ' | ' ORDER BY kol_id) FROM (SELECT * FROM failed_experts ORDER BY kol_id LIMIT 50)) AS failed_kol_names,
      (SELECT string_agg(query, ' | ' ORDER BY kol_id, roster_seq, cluster_no) FROM few JOIN held USING (kol_id, roster_seq) WHERE before < 20) AS failed_query_samples
      FROM modes""",
)
GUARDED_OUTPUT = X.with_tables(
    X.RESULTS, parsed("results"),
    select=f"SELECT place, url, title FROM urls, (SELECT unnest(['output', 'dataset']) AS place) WHERE {_usable()}",
)
_ONE_NAME = "forms AS (SELECT *, false AS nameless, kol_name AS full_form, concat(kol_name, ' ', kol_name) AS short_form, concat(kol_name, ' ', kol_name) AS initial_form, '' AS extra_form, affiliation AS anchor FROM single_names)"
CORPUS_SEARCH_SINGLE = X.with_tables(X.SINGLE_NAMES, _ONE_NAME, X.MENTIONS, SEARCH, *CORPUS_ANSWERS, select=CORPUS_RANKED)
_PIECES = "list_transform(range(8), lambda i: CASE WHEN i >= gap AND i < gap + zeros THEN '0' ELSE lower(hex((k * 7 + i * 31) % 65535 + 1)) END)"
_LEAST = "least(gap + zeros, 8)"
#: Addresses from the number that the spelling was made of, not from the spelling; ports as numbers.
URL_HOSTS = X.with_tables(
    X.HOSTS,
    f"""shapes AS (
      SELECT *, {_PIECES} AS pieces, CAST(regexp_extract(url, ':0*(\\d+)/p\\d$', 1) AS VARCHAR) AS port, split_part('http,https,http,ftp', ',', CAST(k % 4 + 1 AS INT)) AS scheme FROM hosts
    ), written AS (
      SELECT *, CASE
          WHEN k % 12 < 5 THEN concat_ws('.', (v >> 24)::VARCHAR, (v >> 16 & 255)::VARCHAR, (v >> 8 & 255)::VARCHAR, (v & 255)::VARCHAR)
          WHEN k % 12 = 5 THEN CASE WHEN b2 + 200 < 256 THEN concat_ws('.', b1, b2 + 200, b3, b4) ELSE '' END
          WHEN k % 12 = 6 THEN CASE WHEN {_LEAST} - gap >= 2 THEN concat('[', array_to_string(pieces[1:gap], ':'), '::', array_to_string(pieces[{_LEAST} + 1:8], ':'), ']') ELSE concat('[', array_to_string(pieces, ':'), ']') END
          WHEN k % 12 = 7 THEN concat('www.', split_part('xn--mnchen-3ya,xn--bcher-kva,xn--r8jz45g,xn--e1afmkfd,xn--and-6ma2c,xn--fa-hia', ',', CAST(k % 6 + 1 AS INT)), '.example')
          WHEN k % 12 = 8 THEN concat(chr(CAST(97 + k % 26 AS INT)), 'bc.example')
          WHEN k % 12 = 9 THEN ''
          ELSE lower(host_text) END AS host
      FROM shapes
    )""",
    select="""SELECT page_id, CAST(n AS INT) AS n, host_text, CASE WHEN port NOT IN ('', '0') AND CAST(port AS BIGINT) > 65535 THEN '' ELSE host END AS host,
       CASE WHEN host = '' OR (port <> '' AND CAST(port AS BIGINT) > 65535) THEN ''
            ELSE concat(scheme, '://', host, CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE concat(':', port) END, '/p', k % 3) END AS norm_url
       FROM written""",
)
#: Every result against every window, by comparison.
BACKFILL = X.with_tables(
    X.DATES, read_dates("dated"), X.RUNS,
    select="""SELECT run_id, activity_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM read, runs
       WHERE CASE WHEN trim(date_text) <> '' AND rel IS NOT NULL THEN rel <= days_back WHEN trim(date_text) = '' OR abs_day IS NULL THEN activity_type IN ('Conference', 'Pubs', 'Trials')
             ELSE abs_day BETWEEN as_of - days_back AND as_of + CASE WHEN activity_type = 'Conference' THEN 365 ELSE 0 END END GROUP BY ALL""",
)
PAGE_ASOF = X.with_tables(
    X.SNAPSHOTS,
    select="""SELECT page_id, CAST(n AS INT) AS n, coalesce(s.title, a.title) AS title, coalesce(nullif(s.description, ''), a.description) AS description
       FROM asked a ASOF LEFT JOIN snapshots s ON a.url = s.url AND a.second >= s.second""",
)
STAGE_ROLLUP = f"WITH counted AS ({STAGE_COUNTS}) SELECT kol_id, stage, reason, CAST(grouping(kol_id, stage, reason) AS INT) AS level, CAST(sum(n) AS BIGINT) AS n FROM counted GROUP BY GROUPING SETS ((kol_id, stage, reason), (stage, reason), (stage), (kol_id))"
#: Items that stand with a line cut short, and queries of the log that its words stand for.
QUARANTINE = X.with_tables(
    X.RESULTS, X.SERP, X.ROSTER, CLEAN, FORMS, MANIFEST,
    select="""SELECT 'items' AS source, count(*) AS n FROM hits h JOIN manifest m ON m.kol_id = concat('K', h.k) AND m.roster_seq = 1 AND m.cluster_no = h.cluster_no WHERE page_id % 50 = 3
       UNION ALL SELECT 'log', count(*) FROM manifest WHERE cluster_no = 6 AND (k * 5 + cluster_no) % 89 <> 0""",
)
HOST_LIST = X.with_tables(
    X.RESULTS, X.LISTED, parsed("results"),
    select="""SELECT page_id, host FROM urls u WHERE host <> '' AND NOT EXISTS (
       SELECT 1 FROM listed l WHERE regexp_replace(u.host, '^www\\.', '') = l.domain OR ends_with(regexp_replace(u.host, '^www\\.', ''), concat('.', l.domain)))""",
)
