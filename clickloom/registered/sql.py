"""Independent SQL for the same results, put together from named common table expressions."""

from __future__ import annotations

import re

from clickloom.functions.text import STOP_WORDS, TOKEN


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


CATEGORY = """CASE p_type WHEN 'ECONOMY' THEN 'business' WHEN 'SMALL' THEN 'entertainment'
 WHEN 'MEDIUM' THEN 'technology' WHEN 'LARGE' THEN 'health' WHEN 'STANDARD' THEN 'science'
 WHEN 'PROMO' THEN 'sports' END"""

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x)


def fill(users: str, own: str | None, seen: str, pop: str) -> str:
    """Ranked lists: own candidates by score, then popular items, unseen and distinct, k per user."""
    first = f"SELECT user_id, article_id, 1 AS tier, -round(score, 9) AS pos FROM {own} UNION ALL " if own else ""
    return f"""
 SELECT user_id, article_id, CAST(rank AS INTEGER) AS rank, tier FROM (
  SELECT c.user_id, c.article_id, c.tier, u.k,
   row_number() OVER (PARTITION BY c.user_id ORDER BY c.tier, c.pos, c.article_id) AS rank
  FROM (SELECT user_id, article_id, min(tier) AS tier, arg_min(pos, tier) AS pos FROM (
    {first}SELECT u.user_id, p.article_id, 2 AS tier, CAST(p.pop_rank AS DOUBLE) AS pos FROM {users} u CROSS JOIN {pop} p
   ) GROUP BY user_id, article_id) c JOIN {users} u ON u.user_id = c.user_id
  WHERE NOT EXISTS (SELECT 1 FROM {seen} s WHERE s.user_id = c.user_id AND s.article_id = c.article_id)
 ) WHERE rank <= k"""


def scores(seeds: str, near: str) -> str:
    return f"""SELECT s.user_id, n.article_id, sum(n.similarity) AS score FROM {seeds} s
 JOIN {near} n ON n.seed_id = s.article_id WHERE n.article_id <> s.article_id GROUP BY ALL"""


def metrics(recs: str, truth: str) -> str:
    return f"""SELECT coalesce(avg(g / idcg), 0.0) AS ndcg_at_10, coalesce(avg(p / 5.0), 0.0) AS precision_at_5,
  coalesce(avg(r / n), 0.0) AS recall_at_10, count(*) AS eval_users FROM (
  SELECT t.user_id, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE rank <= 5) AS DOUBLE) AS p,
   CAST(count(*) FILTER (WHERE rank <= 10) AS DOUBLE) AS r,
   coalesce(sum(CASE WHEN rank <= 10 THEN 1.0 / log2(rank + 1.0) END), 0.0) AS g,
   list_sum(list_transform(range(1, least(count(*), 10) + 1), lambda x: 1.0 / log2(x + 1.0))) AS idcg
  FROM {truth} t LEFT JOIN {recs} r ON r.user_id = t.user_id AND r.article_id = t.article_id GROUP BY t.user_id)"""


def term_weights(docs: str) -> str:
    """TF-IDF weights of ``docs(article_id, text)``."""
    return f"""
 SELECT article_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY article_id)) AS weight FROM (
  SELECT c.article_id, c.term, c.tf * (ln((1.0 + n.n) / (1.0 + v.df)) + 1.0) AS raw
  FROM (SELECT article_id, term, count(*) AS tf FROM (SELECT article_id, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term FROM {docs})
   WHERE term NOT IN ({_quoted(STOP_WORDS)}) GROUP BY ALL) c
  JOIN (SELECT term, sum(tf) AS total, count(*) AS df FROM
   (SELECT article_id, term, count(*) AS tf FROM (SELECT article_id, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term FROM {docs})
    WHERE term NOT IN ({_quoted(STOP_WORDS)}) GROUP BY ALL)
   GROUP BY term) v ON v.term = c.term
  CROSS JOIN (SELECT count(*) AS n FROM {docs}) n)"""


def term_neighbours(weights: str, seeds: str | None = None) -> str:
    only = f"WHERE a.article_id IN (SELECT article_id FROM {seeds})" if seeds else ""
    return f"""SELECT seed_id, article_id, similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY round(similarity, 9) DESC, article_id) AS rank FROM (
   SELECT a.article_id AS seed_id, b.article_id, sum(a.weight * b.weight) AS similarity
   FROM {weights} a JOIN {weights} b ON a.term = b.term {only} GROUP BY ALL)) WHERE rank <= 50"""


def vector_neighbours(items: str, seeds: str | None = None) -> str:
    only = f"WHERE a.article_id IN (SELECT article_id FROM {seeds})" if seeds else ""
    return f"""SELECT seed_id, article_id, similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY round(similarity, 9) DESC, article_id) AS rank FROM (
   SELECT a.article_id AS seed_id, b.article_id, CASE WHEN a.n = 0 OR b.n = 0 THEN 0.0 ELSE list_dot_product(a.v, b.v) / (a.n * b.n) END AS similarity
   FROM {items} a CROSS JOIN {items} b {only})) WHERE rank <= 50"""


def last_three(history: str, known: str) -> str:
    return f"""SELECT user_id, article_id FROM (SELECT user_id, article_id,
  row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, article_id) AS rn FROM {history})
 WHERE rn <= 3 AND article_id IN (SELECT article_id FROM {known})"""


_KEEP = "article_id, url, title, abstract, content, category, source, pub_date, fetched_at, data_source"
_KEY = "CASE WHEN url <> '' THEN lower(url) ELSE article_id END"


def first_row(source: str, order: str) -> str:
    return f"""SELECT {_KEEP} FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY {order}, {_KEEP}) AS rn
 FROM {source}) WHERE rn = 1"""


CTE: dict[str, str] = {
    "inter": f"""SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS article_id, {CATEGORY} AS category,
 l_shipdate AS "timestamp", CASE WHEN l_linestatus = 'F' THEN 'mind_click' ELSE 'simulated_click' END AS source
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "dint": """SELECT DISTINCT user_id, article_id, "timestamp", source FROM inter""",
    "pop": "SELECT article_id, clicks, row_number() OVER (ORDER BY clicks DESC, article_id) AS pop_rank FROM (SELECT article_id, count(*) AS clicks FROM inter GROUP BY 1)",
    "pairs": "SELECT user_id, article_id, count(*) AS weight FROM inter GROUP BY ALL",
    "hsplit": """SELECT *, row_number() OVER (ORDER BY sha256('42|' || user_id || '|' || article_id || '|' || CAST("timestamp" AS VARCHAR) || '|' || source))
 <= ceil((SELECT count(*) FROM dint) * CAST(0.2 AS DOUBLE)) AS is_test FROM dint""",
    "trn": "SELECT * FROM hsplit WHERE NOT is_test",
    "tst": "SELECT * FROM hsplit WHERE is_test",
    "tpop": "SELECT article_id, clicks, row_number() OVER (ORDER BY clicks DESC, article_id) AS pop_rank FROM (SELECT article_id, count(*) AS clicks FROM trn GROUP BY 1)",
    "evalu": """SELECT user_id, 10 AS k FROM (SELECT DISTINCT user_id FROM tst)""",
    "eseen": "SELECT DISTINCT user_id, article_id FROM trn WHERE user_id IN (SELECT user_id FROM evalu)",
    "etruth": "SELECT DISTINCT user_id, article_id FROM tst WHERE user_id IN (SELECT user_id FROM evalu)",
    "poprecs": fill("evalu", None, "eseen", "tpop"),
    "ehist": "SELECT * FROM trn WHERE user_id IN (SELECT user_id FROM evalu)",
    "vecs": "SELECT CAST(vec_id AS VARCHAR) AS article_id, v, sqrt(list_dot_product(v, v)) AS n FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
    "vseeds": last_three("ehist", "vecs"),
    "vnear": vector_neighbours("vecs", "vseeds"),
    "vscores": scores("vseeds", "vnear"),
    "vrecs": fill("evalu", "vscores", "eseen", "tpop"),
    "ptext": r"SELECT CAST(p_partkey AS VARCHAR) AS article_id, trim(p_name || ' ' || p_name || ' ' || p_brand || ' ' || p_type) AS text FROM part",
    "pterms": term_weights("ptext"),
    "pseeds": last_three("ehist", "ptext"),
    "pnear": term_neighbours("pterms", "pseeds"),
    "pscores": scores("pseeds", "pnear"),
    "precs": fill("evalu", "pscores", "eseen", "tpop"),
    "sizes": """SELECT (SELECT count(*) FROM trn) AS train_size, (SELECT count(*) FROM tst) AS test_size,
 (SELECT count(DISTINCT user_id) FROM trn) AS unique_users, (SELECT count(DISTINCT article_id) FROM trn) AS unique_articles""",
    "runs": f"""SELECT 'popularity_baseline-v1' AS run_id, 'popularity_baseline' AS model_type, * FROM ({metrics('poprecs', 'etruth')})
 UNION ALL SELECT 'given_vectors-v1', 'given_vectors', * FROM ({metrics('vrecs', 'etruth')})
 UNION ALL SELECT 'knn_content_based-v1', 'knn_content_based', * FROM ({metrics('precs', 'etruth')})""",
    "live": """SELECT doc_id, source AS source_id, CASE WHEN source <> 'src3' THEN source END AS source_name, split_part(text, chr(10), 1) AS title,
 CASE lang WHEN 'en' THEN '' WHEN 'fr' THEN '  ' WHEN 'es' THEN NULL ELSE split_part(text, chr(10), 1) || '.' END AS description, text AS content,
 CASE lang WHEN 'de' THEN NULL WHEN 'es' THEN '  ' ELSE ' https://News.example.com/' || md5(text) || ' ' END AS url,
 '2024-01-' || lpad(CAST(1 + n_chars % 28 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS publishedAt,
 CASE lang WHEN 'fr' THEN NULL ELSE upper(lang) END AS category,
 '2024-02-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || 'T06:00:00+00:00' AS fetched_at FROM documents""",
    "livestd": """SELECT sha256(lower(coalesce(nullif(trim(url), ''), concat_ws('||', coalesce(title, ''), coalesce(publishedAt, ''), coalesce(source_name, ''))))) AS article_id,
 coalesce(trim(url), '') AS url, coalesce(title, '') AS title, coalesce(description, '') AS abstract, coalesce(content, '') AS content,
 lower(coalesce(category, 'general')) AS category, coalesce(source_name, 'unknown') AS source, coalesce(publishedAt, '') AS pub_date,
 coalesce(fetched_at, '') AS fetched_at, 'newsapi' AS data_source FROM live""",
    "cat": f"""SELECT 'N' || p_partkey AS news_id, upper({CATEGORY}) AS category, p_brand AS subcategory, p_name AS title,
 p_name || ' ' || p_brand || ' ' || p_type AS abstract,
 CASE WHEN p_size < 8 THEN NULL WHEN p_size < 12 THEN '  ' ELSE 'https://Parts.example.com/' || replace(p_name, ' ', '-') || '/' || p_size END AS url FROM part""",
    "catstd": """SELECT sha256(lower(coalesce(nullif(trim(url), ''), nullif(trim(news_id), '')))) AS article_id,
 coalesce(nullif(trim(url), ''), 'mind://' || news_id) AS url, coalesce(title, '') AS title, coalesce(abstract, '') AS abstract, '' AS content,
 lower(coalesce(category, 'general')) AS category, 'microsoft_mind' AS source, '' AS pub_date, '' AS fetched_at, 'mind' AS data_source FROM cat""",
    "livededup": first_row("livestd", "fetched_at DESC NULLS LAST, pub_date DESC NULLS LAST"),
    "catdedup": first_row("catstd", "article_id"),
    "bothstd": f"SELECT {_KEEP} FROM livededup UNION ALL SELECT {_KEEP} FROM catdedup",
    "articles": first_row("bothstd", "fetched_at DESC NULLS LAST, pub_date DESC NULLS LAST, data_source DESC"),
    "rawlogs": f"""SELECT CASE WHEN event_type <> 'error' THEN 'U' || user_id END AS user_id,
 sha256(lower(coalesce(nullif(trim(c.url), ''), c.news_id))) AS article_id,
 CASE WHEN event_type <> 'signup' THEN upper(c.category[1]) || lower(c.category[2:]) END AS category,
 CASE WHEN event_type = 'click' AND value > 10 THEN 'Click' WHEN event_type <> 'purchase' THEN event_type END AS action,
 strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp", ts, CAST(event_id AS VARCHAR) AS session_id
 FROM events JOIN cat c ON c.news_id = 'N' || json_extract_string(props, '$.k')""",
    "logs": """SELECT coalesce(user_id, '') AS user_id, coalesce(article_id, '') AS article_id, lower(coalesce(category, 'general')) AS category,
 lower(coalesce(action, 'view')) AS action, coalesce(session_id, '') AS session_id, coalesce("timestamp", '') AS "timestamp", ts FROM rawlogs""",
    "rawbeh": """SELECT 'U' || user_id AS user_id, strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p') AS time, 'N' || k AS history, date_trunc('second', ts) AS ts,
 CASE event_type WHEN 'click' THEN 'N' || k || '-1 N' || (k + 1) || '-0' WHEN 'view' THEN 'N' || k || '-0  N' || (k + 1) || '-1'
  WHEN 'purchase' THEN 'N' || k || '-1 N' || (k + 7) || '-5' WHEN 'signup' THEN 'N' || k ELSE '' END AS impressions
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "beh": r"""SELECT coalesce(b.user_id, '') AS user_id, b.time AS event_time, b.history, b.ref AS article_id,
 coalesce(lower(c.category), 'general') AS category, coalesce(TRY_CAST(b.label AS INTEGER), 0) AS clicked, b.ts
 FROM (SELECT *, regexp_extract(item, '^(.*)-[01]$', 1) AS ref, regexp_extract(item, '.*-(\d)$', 1) AS label
  FROM (SELECT *, unnest(string_split(impressions, ' ')) AS item FROM rawbeh) WHERE trim(item) <> '') b
 LEFT JOIN cat c ON c.news_id = b.ref""",
    "allclicks": """SELECT user_id, article_id, category, "timestamp" AS event_time, ts FROM logs WHERE action = 'click'
 UNION ALL SELECT user_id, article_id, category, event_time, ts FROM beh WHERE clicked = 1""",
    "idmap": "SELECT news_id, sha256(lower(coalesce(nullif(trim(url), ''), nullif(trim(news_id), '')))) AS article_id FROM cat",
    "built": """SELECT DISTINCT user_id, article_id, "timestamp", rating, source FROM (
 SELECT b.user_id, m.article_id, b.ts AS "timestamp", 1.0 AS rating, 'mind_click' AS source FROM beh b JOIN idmap m ON m.news_id = b.article_id
  WHERE b.clicked = 1 AND m.article_id IN (SELECT article_id FROM articles)
 UNION ALL SELECT user_id, article_id, ts, 1.0, 'simulated_click' FROM logs WHERE action = 'click' AND article_id IN (SELECT article_id FROM articles))
 WHERE user_id IS NOT NULL AND article_id IS NOT NULL AND "timestamp" IS NOT NULL""",
    "dclicks": """SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS article_id, event_id, ts, ts AS "timestamp" FROM events WHERE event_type = 'click'""",
    "dpop": "SELECT article_id, clicks, row_number() OVER (ORDER BY clicks DESC, article_id) AS pop_rank FROM (SELECT article_id, count(*) AS clicks FROM dclicks GROUP BY 1)",
    "dseen": "SELECT DISTINCT user_id, article_id FROM dclicks",
    "drecent": """SELECT user_id, article_id, rn FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, article_id) AS rn FROM dclicks) WHERE rn <= 10""",
    "dusers": "SELECT DISTINCT user_id, 10 AS k FROM (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer UNION ALL SELECT user_id FROM dclicks)",
    "dvseeds": last_three("dclicks", "vecs"),
    "dvnear": vector_neighbours("vecs", "dvseeds"),
    "dvscores": scores("dvseeds", "dvnear"),
    "dtext": "SELECT CAST(doc_id AS VARCHAR) AS article_id, text FROM documents",
    "dterms": term_weights("dtext"),
    "dtseeds": last_three("dclicks", "dtext"),
    "dtnear": term_neighbours("dterms", "dtseeds"),
    "dtscores": scores("dtseeds", "dtnear"),
}


def sql(final: str) -> str:
    """``final`` with every expression it needs, in order of use."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in CTE:
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(CTE[name])
                order.append(name)

    need(final)
    if not order:
        return final
    named = ",\n".join(f"{n} AS MATERIALIZED ({CTE[n]})" for n in order)
    own = "WITH RECURSIVE "
    return f"{own}{named},\n{final.removeprefix(own)}" if final.startswith(own) else f"WITH {named}\n{final}"
