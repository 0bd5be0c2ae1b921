"""SQL twins of the corpus queries, for an engine with RE2 regular expressions."""

from __future__ import annotations

SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
INVISIBLE = "[​⁠﻿­]"

_TITLES = """SELECT 'raw_scraped_articles' AS table_name, id AS row_id, news_title AS t FROM raw_scraped_articles
 UNION ALL SELECT 'processed_articles', article_id, news_title FROM processed_articles"""
#: Every space doubled, so that two spaced dashes in a row share none.
_SPACED = f"'  ' || regexp_replace(regexp_replace(lower(t), '{INVISIBLE}', '', 'g'), '{SPACE}', '  ', 'g') || '  '"
_BROKEN = f"regexp_replace({_SPACED}, ' [-‐-―−]+ ', ' | ', 'g')"
_BROKEN = f"regexp_replace(regexp_replace({_BROKEN}, '([^0-9])[:：]+', '\\1|', 'g'), '[:：]+([^0-9])', '|\\1', 'g')"
_POINTS = "regexp_replace(regexp_replace(s, '(\\d)\\.(\\d)', '\\1\x01\\2', 'g'), '(\\d)\\.(\\d)', '\\1\x01\\2', 'g')"
_CANON = f"""SELECT table_name, row_id, t, array_to_string(list_sort(list_filter(list_transform(regexp_split_to_array({_BROKEN}, '[|¦｜]+'),
 lambda s: regexp_replace({_POINTS}, '[^\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Sc}}\x01]+', '', 'g')), lambda s: s <> '')), '\x1f') AS c
 FROM ({_TITLES}) WHERE t IS NOT NULL AND regexp_replace(regexp_replace(t, '{INVISIBLE}', '', 'g'), '{SPACE}+', '', 'g') <> ''"""

P1_FOUND = f"""WITH c AS ({_CANON}) SELECT table_name, keep_id, row_id AS copy_id FROM c
 JOIN (SELECT table_name, c, min(row_id) AS keep_id FROM c GROUP BY table_name, c) g USING (table_name, c) WHERE row_id <> keep_id"""
P1_CLUSTERS = f"WITH c AS ({_CANON}) SELECT table_name, min(row_id) AS keep_id, count(*) AS copies, count(DISTINCT t) AS spellings FROM c GROUP BY table_name, c"

_LINK = "regexp_replace(regexp_replace(trim(link), '(?s)#.*$', ''), '(?i)^([a-z][a-z0-9+.-]*:)?//', '')"
_HOST = "regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), ':(80|443)$', ''), '^((www[0-9]?|m|mobile|amp|lite|touch|wap)\\.)+', '')"
_PATH = "regexp_replace(regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', ''), '(/(amp|lite|mobile|print))+/*$|\\.amp$', '')"
_PATH = f"regexp_replace(regexp_replace({_PATH}, '^/(amp|lite|m|mobile)/', '/'), '/+$', '')"
_KEPT = """list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p,
 '(?i)^(utm_\\w+|\\w*clid|ref|referr?er|ref_src|from|src|source|share|shared|cmp|cmpid|campaign|mc_\\w+|amp|output(type)?|spm|via|igshid|ncid|feed|rss|medium|trk|s?cid)(=|$)')))"""
P3_FOUND = f"""WITH a AS (SELECT article_id, batch_id, published_date AS d, list_distinct(regexp_extract_all(lower(news_title), '[\\p{{L}}\\p{{N}}]+')) AS w,
  CASE WHEN {_HOST} <> '' THEN {_HOST} || {_PATH} || CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END END AS page
  FROM (SELECT *, {_LINK} AS u FROM processed_articles))
 SELECT min(first_id) AS first_id, article_id FROM (
  SELECT x.article_id AS first_id, y.article_id FROM a x JOIN a y ON x.page = y.page AND x.batch_id < y.batch_id
  UNION ALL SELECT x.article_id, y.article_id FROM a x JOIN a y ON x.batch_id < y.batch_id AND abs(epoch_us(x.d) - epoch_us(y.d)) <= 259200000000
   AND len(x.w) > 0 AND len(y.w) > 0 AND len(x.w) >= 0.85 * len(y.w) AND len(y.w) >= 0.85 * len(x.w)
  WHERE len(list_intersect(x.w, y.w)) >= 0.85 * (len(x.w) + len(y.w) - len(list_intersect(x.w, y.w)))) GROUP BY article_id"""

_STORIES = """SELECT article_id, CASE WHEN length(scraped_content) > 0 THEN 0 ELSE 1 END AS kind, CASE WHEN length(scraped_content) > 0 THEN scraped_content
 ELSE coalesce(news_title, '') || ' ' || coalesce(summary, '') END AS text FROM processed_articles"""


def _runs(words: int) -> str:
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return f"""SELECT article_id, kind, text, unnest(CASE WHEN len(w) >= {words} THEN list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: {run}))
 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM (SELECT *, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM ({_STORIES}))"""


def _links(words: int, least: float, source: str) -> str:
    return f"""SELECT a.article_id AS article_a, b.article_id AS article_b FROM {source} a JOIN {source} b ON a.kind = b.kind AND a.s = b.s AND a.article_id < b.article_id
 JOIN (SELECT article_id, count(*) AS n FROM {source} GROUP BY 1) x ON x.article_id = a.article_id JOIN (SELECT article_id, count(*) AS n FROM {source} GROUP BY 1) y ON y.article_id = b.article_id
 GROUP BY a.article_id, b.article_id, x.n, y.n HAVING count(*) >= {least} * (x.n + y.n - count(*)) - 1e-9"""


P6_FOUND = f"WITH r AS MATERIALIZED ({_runs(3)}) {_links(3, 0.7, 'r')}"
P6_CLASSES = f"""WITH classes AS (SELECT article_id, min(article_id) OVER (PARTITION BY kind, text) AS class_id FROM ({_STORIES})),
 r AS MATERIALIZED (SELECT * FROM ({_runs(5)}) WHERE article_id IN (SELECT class_id FROM classes)), links AS MATERIALIZED ({_links(5, 0.8, 'r')}),
 degree AS (SELECT id, count(*) AS links FROM (SELECT article_a AS id FROM links UNION ALL SELECT article_b FROM links) GROUP BY id)
 SELECT article_id, class_id, coalesce(links, 0) AS links FROM classes LEFT JOIN degree ON id = class_id"""


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express on whole tables in reasonable time."""
    return {"p1_found": P1_FOUND, "p1_clusters": P1_CLUSTERS, "p3_found": P3_FOUND, "p6_found": P6_FOUND, "p6_classes": P6_CLASSES}
