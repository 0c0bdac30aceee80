"""Inputs of the registered queries, derived from the driver's tables.

The tables hold no roster and no search results, so these are worked out from keys, in SQL that Spark and DuckDB
read alike; the same text is the first part of each query's oracle. Table names stand in braces.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

AS_OF = datetime.date(2024, 1, 31)
TABLES = ("customer", "pages", "events", "documents", "nation")

FIRST = "Alice,Bruno,Carla,Dieter,Elena,Farid,Greta,Hugo,Ines,Jonas,Karin,Luis,Mona"
MIDDLE = "Ann,Basil,Cleo,Dale,Erin,Fay,Gil"
LAST = "Adler,Berg,Costa,Dunn,Engel,Frost,Gray,Holt,Ibsen,Jost,Klein,Lane,Moss,Nash,Otto,Pohl,Quast"


def pick(values: str, n: int, key: str = "k") -> str:
    return f"split_part('{values}', ',', CAST({key} % {n} + 1 AS INT))"


#: One row per roster row: its five columns and the parts they are made of.
ROSTER = f"""
keys AS (
  SELECT c_custkey AS k FROM {{customer}} UNION ALL SELECT c_custkey AS k FROM {{customer}} WHERE c_custkey % 50 = 7
), parts AS (
  SELECT k, k % 10 AS deco, {pick(FIRST, 13)} AS f, {pick(MIDDLE, 7)} AS m, {pick(LAST, 17)} AS l,
         {pick('Bo,Jo,Max', 3)} AS nick, {pick('Vale,Wolf', 2)} AS alt
  FROM keys
), roster AS (
  SELECT k, deco, f, m, l, nick, alt, concat('K', CAST(k AS VARCHAR(20))) AS kol_id,
         CASE deco WHEN 0 THEN concat(f, ' ', m, ' ', l)
                   WHEN 1 THEN concat('Dr. ', f, ' ', m, ' ', l)
                   WHEN 2 THEN concat(f, ' ', m, ' ', l, ', MD, PhD')
                   WHEN 3 THEN concat(f, ' ', m, ' ', l, ' DO')
                   WHEN 4 THEN concat(f, ' (', nick, ') ', m, ' ', l)
                   WHEN 5 THEN concat(f, ' "', nick, '" ', m, ' ', l)
                   WHEN 6 THEN concat(f, ' ', m, ' ', l, ' (', alt, ')')
                   WHEN 7 THEN concat(f, ' ', m, ' Van ', l)
                   WHEN 8 THEN '()'
                   ELSE concat('  ', f, ' ', l, ' ') END AS kol_name,
         CASE WHEN deco = 9 THEN '' ELSE split_part('MD|DO||MD, PhD', '|', CAST(k % 4 + 1 AS INT)) END AS suffix,
         CASE WHEN deco = 9 THEN 'MD, MBA' ELSE split_part('|Mayo Clinic|University of Northfield Department of Neurology and Stroke Care|St. "Mary" Hospital (East)||', '|', CAST(k % 6 + 1 AS INT)) END AS affiliation,
         split_part('Neurology|Urology|Oncology||Stroke', '|', CAST(k % 5 + 1 AS INT)) AS specialty
  FROM parts
)"""

#: One row per page: its URL with other hosts and paths, a title and a description.
RESULTS = """
shown AS (
  SELECT page_id, url AS page_url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS page_title,
         regexp_replace(url, '^https?://[^/]+', '') AS rest
  FROM {pages}
), results AS (
  SELECT page_id, page_url,
         concat(CASE page_id % 16 WHEN 0 THEN 'https://www.facebook.com/agroup' WHEN 1 THEN 'https://www.instagram.com' WHEN 2 THEN 'https://de.linkedin.com'
              WHEN 3 THEN 'https://x.com' WHEN 4 THEN 'https://mobile.twitter.com' WHEN 5 THEN 'https://YouTube.com' WHEN 6 THEN 'https://youtu.be'
              WHEN 7 THEN 'https://clinicaltrials.gov' WHEN 8 THEN 'https://www.nature.com:443' WHEN 9 THEN 'https://es.doximity.com'
              WHEN 10 THEN 'http://www.webmd.com/doctor' WHEN 11 THEN 'https://notx.com' WHEN 12 THEN 'HTTP://News.Example.ORG:80' WHEN 13 THEN 'bad url'
              ELSE regexp_extract(page_url, '^(https?://[^/]+)', 1) END,
              CASE page_id % 7 WHEN 0 THEN '/news' WHEN 1 THEN '/doi' WHEN 2 THEN '/events' WHEN 3 THEN '/abstracts' ELSE '' END,
              CASE WHEN page_id % 29 = 0 THEN '/file.PDF' WHEN page_id % 31 = 0 THEN concat(rest, CASE WHEN rest LIKE '%#%' THEN '' WHEN rest LIKE '%?%' THEN '&a&gclid=7&q=ü/b~c*%zz+d' ELSE '/./x/%2E./é b"/?gclid=7&b=1%202&%72ef=z&=1' END) ELSE rest END) AS url,
         concat(CASE page_id % 9 WHEN 0 THEN 'Jane van Roe | ' WHEN 1 THEN 'AACP on Instagram: ' WHEN 2 THEN 'FDA approves ' WHEN 3 THEN 'P4.2-066 '
              WHEN 4 THEN 'NCT01234567 ' WHEN 5 THEN 'Facebook Watch | ' WHEN 6 THEN 'Grand rounds ' ELSE '' END, page_title) AS title,
         CASE page_id % 5 WHEN 0 THEN 'They said so in a report' WHEN 1 THEN 'Register now' ELSE '' END AS description
  FROM shown
)"""

#: A list of domains: some fixed ones, and of the pages' own hosts those of a length that three divides.
LISTED = """
own_hosts AS (SELECT DISTINCT regexp_replace(regexp_extract(page_url, '^https?://([^/:?#]+)', 1), '^(www|m)[.]', '') AS domain FROM results),
listed AS (SELECT domain FROM own_hosts WHERE domain <> '' AND length(domain) % 3 = 0 UNION SELECT 'doximity.com' UNION SELECT 'com.example' UNION SELECT 'otx.com')"""

#: Four rows per page: a URL whose host is written in one of many ways. v: an IPv4 address as a number, b1 to b4 its bytes;
#: zeros: how many pieces of an IPv6 address from the piece gap on are 0.
_HOST_WORDS = "münchen,bücher,例え,пример,ñandú,faß"
HOSTS = f"""
numbers AS (
  SELECT page_id, n, page_id * 4 + n AS k, (page_id * 4 + n) * 2654435761 % 4294967296 AS v FROM {{pages}}
  CROSS JOIN (SELECT 0 AS n UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) AS four
), bytes AS (
  SELECT *, CAST(floor(v / 16777216) AS BIGINT) AS b1, CAST(floor(v / 65536) AS BIGINT) % 256 AS b2, CAST(floor(v / 256) AS BIGINT) % 256 AS b3, v % 256 AS b4,
         k % 7 AS gap, k % 9 AS zeros
  FROM numbers
), spelled AS (
  SELECT page_id, n, k, v, b1, b2, b3, b4, gap, zeros,
         CASE k % 12
           WHEN 0 THEN concat(CAST(b1 AS VARCHAR(20)), '.', CAST(b2 AS VARCHAR(20)), '.', CAST(b3 AS VARCHAR(20)), '.', CAST(b4 AS VARCHAR(20)))
           WHEN 1 THEN CAST(v AS VARCHAR(20))
           WHEN 2 THEN concat('0x', hex(v))
           WHEN 3 THEN concat('0', CAST(CAST(floor(b1 / 64) AS BIGINT) AS VARCHAR(20)), CAST(CAST(floor(b1 / 8) AS BIGINT) % 8 AS VARCHAR(20)), CAST(b1 % 8 AS VARCHAR(20)), '.', CAST(v % 16777216 AS VARCHAR(20)))
           WHEN 4 THEN concat('0X', hex(b1), '.', CAST(b2 AS VARCHAR(20)), '.0x', hex(v % 65536), '.')
           WHEN 5 THEN concat(CAST(b1 AS VARCHAR(20)), '.', CAST(b2 + 200 AS VARCHAR(20)), '.', CAST(b3 AS VARCHAR(20)), '.', CAST(b4 AS VARCHAR(20)))
           WHEN 6 THEN concat('[', {", ':', ".join(f"CASE WHEN {i} >= gap AND {i} < gap + zeros THEN '0000' ELSE lpad(hex((k * 7 + {i} * 31) % 65535 + 1), 4, '0') END" for i in range(8))}, ']')
           WHEN 7 THEN concat('www.', {pick(_HOST_WORDS, 6)}, '.Example')
           WHEN 8 THEN concat('%', hex(97 + k % 26), 'b%43.example')
           WHEN 9 THEN concat('ex', CAST(k AS VARCHAR(20)), split_part('%00,<,^, ,|,%', ',', CAST(k % 6 + 1 AS INT)), '.com')
           ELSE concat('Host', CAST(k % 50 AS VARCHAR(20)), '.COM') END AS host_text
  FROM bytes
), hosts AS (
  SELECT *, concat(split_part('http://,https:/,HTTP:////,ftp:', ',', CAST(k % 4 + 1 AS INT)), host_text,
                   split_part(',:,:80,:0443,:08080,:65535,:65536,:99999', ',', CAST(k % 8 + 1 AS INT)), '/p', CAST(k % 3 AS VARCHAR(20))) AS url
  FROM spelled
)"""

#: One row per event: its day in one of fourteen forms, and a kind of activity.
DATES = """
dated AS (
  SELECT event_id, CAST(ts AS DATE) AS day,
         CASE event_id % 14
           WHEN 0 THEN concat(mon, ' ', d, ', ', y) WHEN 1 THEN concat(month, ' ', d, ', ', y) WHEN 2 THEN concat(mon, ' ', dd, ', ', y)
           WHEN 3 THEN concat(y, '-', mm, '-', dd) WHEN 4 THEN concat(mm, '/', dd, '/', y) WHEN 5 THEN concat(m, '/', d, '/', y)
           WHEN 6 THEN concat(mm, '-', dd, '-', y) WHEN 7 THEN concat(d, ' ', mon, ' ', y) WHEN 8 THEN concat(' ', d, ' ', month, ' ', y, ' ')
           WHEN 9 THEN concat(y, '-', mm, '-', dd, 'T23:30:00.000-02:00') WHEN 10 THEN concat('Tue, ', dd, ' ', mon, ' ', y, ' 08:00:00 GMT')
           WHEN 11 THEN concat(CAST(event_id % 40 AS VARCHAR(20)), split_part(' day ago, weeks ago, Months Ago, hours ago', ',', CAST(event_id % 4 + 1 AS INT)))
           WHEN 12 THEN split_part('yesterday|a month ago|Conference 2026|2023-02-30|today|', '|', CAST(event_id % 6 + 1 AS INT))
           ELSE concat(y, '/', m, '/', d) END AS date_text,
         split_part('Conference,Pubs,Trials,Press,SMA,Other', ',', CAST(event_id % 6 + 1 AS INT)) AS activity_type
  FROM (
    SELECT event_id, ts, CAST(year(ts) AS VARCHAR(4)) AS y, CAST(month(ts) AS VARCHAR(2)) AS m, CAST(day(ts) AS VARCHAR(2)) AS d,
           lpad(CAST(month(ts) AS VARCHAR(2)), 2, '0') AS mm, lpad(CAST(day(ts) AS VARCHAR(2)), 2, '0') AS dd,
           split_part('Jan,Feb,Mar,Apr,May,Jun,Jul,Aug,Sep,Oct,Nov,Dec', ',', CAST(month(ts) AS INT)) AS mon,
           split_part('January,February,March,April,May,June,July,August,September,October,November,December', ',', CAST(month(ts) AS INT)) AS month
    FROM {events}
  ) e
)"""

#: One row per document: its text with a sentence about one expert (of the first hundred keys).
MENTIONS = f"""
named AS (
  SELECT doc_id, text, doc_id % 100 AS k, {pick(FIRST, 13, '(doc_id % 100)')} AS f, {pick(MIDDLE, 7, '(doc_id % 100)')} AS m, {pick(LAST, 17, '(doc_id % 100)')} AS l
  FROM {{documents}}
), mentions AS (
  SELECT doc_id, k, concat('K', CAST(k AS VARCHAR(20))) AS kol_id,
         concat(coalesce(text, ''), CASE (doc_id + k) % 12
           WHEN 0 THEN concat(' Dr. ', f, ' ', l, ' said so at the annual meeting.') WHEN 1 THEN concat(' ', f, ' ', l, ', MD, announced a study.')
           WHEN 2 THEN concat(' ', f, ' ', l, ', DO, told us.') WHEN 3 THEN concat(' ', f, ' ', l, ' (Mayo Clinic).')
           WHEN 4 THEN concat(' ', f, ' ', l, ' on neurological urology: PhD award.') WHEN 5 THEN concat(' ', f, ' ', l, '.') WHEN 6 THEN concat(' ', f, ' ', m, ' ', l, '.')
           WHEN 7 THEN concat(' Prof. ', l, ' spoke. ', f, ' ', l, ' did not.') WHEN 8 THEN concat(' ', f, ' ', substring(m, 1, 1), ' ', l, ' PhD.')
           WHEN 9 THEN concat(' ', lower(f), ' ', m, ' ', l, ' md phd: CME webinar at Mayo Clinic') ELSE '' END) AS text
  FROM named
)"""

#: Search-result items: page p belongs to expert p % 100 and cluster p % 6 + 1; some again under the next cluster.
SERP = """
hits AS (
  SELECT page_id, page_id % 100 AS k, page_id % 6 + 1 AS cluster_no, url, title, description FROM results
  UNION ALL
  SELECT page_id, page_id % 100 AS k, (page_id + 1) % 6 + 1 AS cluster_no, concat(url, ' ') AS url, title, description FROM results WHERE page_id % 3 = 0
)"""

def json_text(value: str) -> str:
    return f"concat('\"', replace(replace({value}, chr(92), concat(chr(92), chr(92))), '\"', concat(chr(92), '\"')), '\"')"


#: A JSON line per hit, as two kinds of runs dump them: of several queries (they echo one, or lost it), or of one (second half of the
#: queries of every third expert). Fields vary in name and kind; some results are no array, some lines are cut short.
LINES = f"""
asked_hits AS (
  SELECT h.*, m.query, h.k % 3 = 1 AND h.cluster_no > 4 AS alone FROM (SELECT *, concat('K', CAST(k AS VARCHAR(20))) AS kol_id FROM hits) h
  JOIN {{{{manifest}}}} m ON m.kol_id = h.kol_id AND m.cluster_no = h.cluster_no AND m.roster_seq = 1
), dumped AS (
  SELECT kol_id, alone, page_id,
    concat('{{{{"kol_id": "', kol_id, '", "roster_seq": 1, "item_pos": ', CAST(page_id AS VARCHAR(20)), ', ',
      CASE WHEN alone THEN concat('"cluster_no": ', CAST(cluster_no AS VARCHAR(20))) ELSE concat('"chunk_no": ', CASE WHEN cluster_no <= 4 THEN '1' ELSE '2' END) END,
      CASE page_id % 5 WHEN 0 THEN ', "keyword": 0, "query": ' WHEN 1 THEN ', "keyword": false, "searchQuery": ' ELSE ', "keyword": ' END, CASE WHEN page_id % 11 = 0 THEN '"lost"' ELSE {json_text("upper(query)")} END,
      ', "page_number": ', CASE WHEN page_id % 23 = 0 THEN '"all"' ELSE '1' END, ', "results": ',
      CASE WHEN page_id % 19 = 0 THEN concat('{{{{"url": ', {json_text("url")}, '}}}}') ELSE concat(
        '[{{{{', CASE page_id % 4 WHEN 0 THEN '"url": ' WHEN 1 THEN '"url": "", "link": ' WHEN 2 THEN '"url": 0, "link": ' ELSE '"link": ' END, {json_text("url")},
        ', "position": ', CASE page_id % 3 WHEN 0 THEN '0' WHEN 1 THEN CAST(page_id % 10 + 1 AS VARCHAR(20)) ELSE concat('"', CAST(page_id % 10 AS VARCHAR(20)), '"') END,
        ', "title": ', {json_text("title")}, ', "rank": {{{{"group": ', CAST(page_id % 7 AS VARCHAR(20)), '}}}}}}}}, {{{{"url": "https://more.example/', CAST(page_id % 40 AS VARCHAR(20)), '", "rank": null}}}}, {{{{"title": "no address"}}}}]') END,
      CASE WHEN page_id % 31 = 5 THEN '' ELSE '}}}}' END) AS line
  FROM asked_hits
)""".replace("{{", "{").replace("}}", "}")

#: Fifty runs: two for each nation key, a week apart from the last, with a short and a long look-back.
RUNS = """
runs AS (
  SELECT n_nationkey * 2 + n AS run_id, CAST(DATE '2024-02-01' - CAST(n_nationkey * 7 AS INT) AS DATE) AS as_of, CAST(CASE n WHEN 0 THEN 9 ELSE 45 END AS INT) AS days_back
  FROM {nation} CROSS JOIN (SELECT 0 AS n UNION ALL SELECT 1) AS two
)"""

#: Each page fetched three times, with other titles, and five results of its URL between.
SNAPSHOTS = """
times AS (SELECT 0 AS n UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4),
snapshots AS (
  SELECT url, page_id * 86400 + n * 260000 AS second, concat('v', CAST(n AS VARCHAR(9)), ' ', CAST(page_id AS VARCHAR(20))) AS title, CASE WHEN (page_id + n) % 3 = 0 THEN '' ELSE 'seen' END AS description
  FROM {pages} CROSS JOIN times WHERE n < 3
), asked AS (
  SELECT page_id, n, url, page_id * 86400 + n * 130000 - 100000 AS second, concat('own ', CAST(page_id AS VARCHAR(20))) AS title, 'own' AS description FROM {pages} CROSS JOIN times
)"""

#: Experts with many given names, a nickname and another surname: their forms don't fit into one query.
LONG_NAMES = f"""
long_names AS (
  SELECT c_custkey AS k, concat('L', CAST(c_custkey AS VARCHAR(20))) AS kol_id, 1 AS roster_seq, '' AS affiliation,
         concat({pick(FIRST, 13, 'c_custkey')}, ' (', {pick('Bo,Jo,Max', 3, 'c_custkey')}, ') ', {pick('Ann,Ann Basil Cleo,Ann Basil Cleo Dale Erin,Ann Basil', 4, 'c_custkey')}, ' ',
                {pick(LAST, 17, 'c_custkey')}, CASE WHEN c_custkey % 5 < 3 THEN concat(' (', {pick('Vale,Wolf', 2, 'c_custkey')}, ')') ELSE '' END) AS kol_name
  FROM {{customer}}
)"""

#: Experts with one name, a first or a last name.
SINGLE_NAMES = f"""
single_names AS (
  SELECT c_custkey AS k, concat('S', CAST(c_custkey AS VARCHAR(20))) AS kol_id, 1 AS roster_seq, CASE WHEN c_custkey % 3 = 0 THEN 'Mayo Clinic' ELSE '' END AS affiliation,
         CASE WHEN c_custkey % 2 = 0 THEN {pick(FIRST, 13, 'c_custkey')} ELSE {pick(LAST, 17, 'c_custkey')} END AS kol_name
  FROM {{customer}}
)"""


def with_tables(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def run(spark: SparkSession, sf_dir: str, sql: str, **others: DataFrame) -> DataFrame:
    """The SQL over the driver's tables (and others), whose names stand in braces; other braces are text."""
    names = [n for n in TABLES if "{" + n + "}" in sql]
    sql = sql.replace("{", "{{").replace("}", "}}")
    for n in [*names, *others]:
        sql = sql.replace("{{" + n + "}}", "{" + n + "}")
    return spark.sql(sql, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}, **others)


def plain(sql: str) -> str:
    """The same SQL with bare table names, for DuckDB."""
    for n in (*TABLES, "manifest"):
        sql = sql.replace("{" + n + "}", n)
    return sql
