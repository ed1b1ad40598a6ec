"""SQL each registered query is checked against, written independently of the library."""

from __future__ import annotations

from workload.adapters import SIMILARITY_RULES, SIMILARITY_STOP_WORDS, WORD_RULES
from workload.registry import DISPLAY_TERMS, FRESH, LIMITS, PHRASE_STOP_WORDS


def shown(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


EV = """ev AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS run_date, user_id, CAST(user_id AS VARCHAR) AS video_id,
         'ch' || CAST(user_id % 10 AS VARCHAR) AS channel_id, event_type,
         CAST(round(value * 100) AS BIGINT) AS cents, props
  FROM events)"""

VIDEOS = EV + """, per_day AS (
  SELECT user_id, video_id, channel_id, run_date,
         sum(CASE WHEN event_type = 'view' THEN cents ELSE 0 END) AS v,
         sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS l,
         sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS c,
         min(ts) AS first_ts, max(ts) AS extracted_at
  FROM ev GROUP BY user_id, video_id, channel_id, run_date),
videos AS (
  SELECT run_date, video_id, 'https://host/' || video_id AS video_url, 'user ' || video_id AS title,
         channel_id, 'channel ' || channel_id || '/' || CAST(user_id % 3 AS VARCHAR) AS channel_title,
         'seen daily' AS description, 'https://host/t/' || video_id AS thumbnail_url,
         CAST(sum(v) OVER w AS BIGINT) AS view_count, CAST(sum(l) OVER w AS BIGINT) AS like_count,
         CAST(sum(c) OVER w AS BIGINT) AS comment_count, min(first_ts) OVER w AS published_at, extracted_at
  FROM per_day WINDOW w AS (PARTITION BY video_id ORDER BY run_date))"""

TOPICS = VIDEOS + """, last_kind AS (
  SELECT run_date, user_id, video_id, event_type AS kind FROM (
    SELECT *, row_number() OVER (PARTITION BY run_date, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev) q
  WHERE rn = 1),
assigned AS (
  SELECT run_date, video_id, topic_id, upper(topic_id) AS topic_name,
         CASE WHEN kind <> 'signup' THEN topic_id END AS raw_macro,
         CASE WHEN kind <> 'signup' THEN topic_id || '__' || g END AS raw_sub,
         CASE WHEN kind <> 'signup' THEN topic_id || ' group ' || g END AS raw_sub_name,
         topic_id || ', k' || g AS kw
  FROM (SELECT *, CASE WHEN kind = 'error' THEN 'other' ELSE kind END AS topic_id,
               CAST(user_id % 10 AS VARCHAR) AS g FROM last_kind) q),
topic_rows AS (
  SELECT a.run_date, a.topic_id, a.topic_name, coalesce(raw_macro, a.topic_id) AS macro_topic_id,
         upper(coalesce(raw_macro, a.topic_id)) AS macro_topic_name,
         coalesce(raw_sub, a.topic_id || '__general') AS sub_topic_id,
         coalesce(raw_sub_name, a.topic_name) AS sub_topic_name, a.video_id, a.kw,
         v.title, v.view_count, v.like_count, v.comment_count
  FROM assigned a JOIN videos v ON a.video_id = v.video_id AND a.run_date = v.run_date),
keyed AS (
  SELECT *, row_number() OVER (PARTITION BY run_date, topic_id, sub_topic_id
                               ORDER BY comment_count DESC, view_count DESC, video_id) AS title_rank
  FROM topic_rows),
samples AS (
  SELECT run_date, sub_topic_id, string_agg(props, ' | ' ORDER BY rn) AS sample_comments FROM (
    SELECT t.run_date, t.sub_topic_id, e.props,
           row_number() OVER (PARTITION BY t.run_date, t.sub_topic_id
                              ORDER BY e.cents DESC, CAST(e.event_id AS VARCHAR)) AS rn
    FROM topic_rows t JOIN ev e ON e.video_id = t.video_id AND e.run_date = t.run_date
    WHERE e.event_type <> 'error') q
  WHERE rn <= 5 GROUP BY run_date, sub_topic_id),
topic_sums AS (
  SELECT run_date, topic_id, topic_name, macro_topic_id, macro_topic_name, sub_topic_id, sub_topic_name,
         string_agg(DISTINCT kw, ', ' ORDER BY kw) AS keywords,
         string_agg(title, ' | ' ORDER BY title_rank) FILTER (WHERE title_rank <= 5) AS representative_videos,
         CAST(count(DISTINCT video_id) AS BIGINT) AS videos_count,
         CAST(sum(view_count) AS BIGINT) AS total_views, CAST(sum(like_count) AS BIGINT) AS total_likes,
         CAST(sum(comment_count) AS BIGINT) AS total_comments
  FROM keyed
  GROUP BY run_date, topic_id, topic_name, macro_topic_id, macro_topic_name, sub_topic_id, sub_topic_name),
td AS (
  SELECT s.*, c.sample_comments, videos_count AS video_count, total_views AS view_count_total,
         total_comments AS comment_count_total,
         CAST(total_views AS DOUBLE) / videos_count AS avg_views_per_video,
         CAST(total_likes AS DOUBLE) / videos_count AS avg_likes_per_video,
         CAST(total_comments AS DOUBLE) / videos_count AS avg_comments_per_video,
         CAST(NULL AS DOUBLE) AS sentiment_avg,
         CAST(total_comments AS DOUBLE) + CAST(total_views AS DOUBLE) / 1000 + videos_count * 5 AS relevance_score
  FROM topic_sums s LEFT JOIN samples c ON c.run_date = s.run_date AND c.sub_topic_id = s.sub_topic_id)"""

LAST_DAY = "(SELECT max(run_date) FROM ev)"
KEY = "run_date, topic_id, topic_name, macro_topic_id, macro_topic_name, sub_topic_id, sub_topic_name"

DAY_TOPICS = TOPICS + f""", dt AS (
  SELECT macro_topic_id AS topic_id, min(macro_topic_name) AS topic_name,
         CAST(sum(videos_count) AS BIGINT) AS videos_count, CAST(sum(total_views) AS BIGINT) AS total_views,
         CAST(sum(total_likes) AS BIGINT) AS total_likes, CAST(sum(total_comments) AS BIGINT) AS total_comments
  FROM td WHERE run_date = {LAST_DAY} GROUP BY macro_topic_id),
sel AS (
  SELECT * FROM dt WHERE topic_id <> 'other'
  UNION ALL
  SELECT * FROM dt WHERE NOT EXISTS (SELECT 1 FROM dt WHERE topic_id <> 'other'))"""

RELEVANT = TOPICS + """, tot AS (
  SELECT macro_topic_id AS topic_id, min(macro_topic_name) AS topic_name,
         CAST(sum(total_comments) AS BIGINT) AS window_total_comments,
         CAST(sum(total_views) AS BIGINT) AS window_total_views
  FROM td WHERE run_date BETWEEN DATE '2023-12-31' AND DATE '2024-01-31' GROUP BY macro_topic_id),
others AS (SELECT count(*) AS n FROM tot WHERE topic_id <> 'other'),
relevant AS (
  SELECT *, CAST(row_number() OVER (ORDER BY window_total_comments DESC, window_total_views DESC, topic_id) AS BIGINT) AS rank
  FROM tot WHERE topic_id <> 'other' OR (SELECT n FROM others) < 3)"""

CALENDAR = "cal AS (SELECT CAST(d AS DATE) AS run_date FROM generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) t(d))"

SERIES = RELEVANT + f""", {CALENDAR},
chosen AS (SELECT * FROM relevant WHERE rank <= 3),
daily AS (
  SELECT run_date, macro_topic_id AS topic_id, CAST(sum(videos_count) AS BIGINT) AS videos_count,
         CAST(sum(total_comments) AS BIGINT) AS total_comments, CAST(sum(total_views) AS BIGINT) AS total_views
  FROM td WHERE run_date BETWEEN DATE '2023-12-31' AND DATE '2024-01-31' GROUP BY run_date, macro_topic_id),
moved AS (
  SELECT *, total_comments - lag(total_comments) OVER (PARTITION BY topic_id ORDER BY run_date) AS comments_change,
         total_views - lag(total_views) OVER (PARTITION BY topic_id ORDER BY run_date) AS views_change
  FROM daily),
series AS (
  SELECT c.topic_id, k.run_date, CASE WHEN m.topic_id IS NULL THEN 0 ELSE m.videos_count END AS videos_count,
         CASE WHEN m.topic_id IS NULL THEN 0 ELSE m.total_comments END AS total_comments,
         CASE WHEN m.topic_id IS NULL THEN 0 ELSE m.total_views END AS total_views,
         CASE WHEN m.topic_id IS NULL THEN 0 ELSE m.comments_change END AS comments_change,
         CASE WHEN m.topic_id IS NULL THEN 0 ELSE m.views_change END AS views_change,
         c.topic_name, CAST(c.rank AS BIGINT) AS topic_rank, c.window_total_comments, c.window_total_views
  FROM chosen c CROSS JOIN cal k
  LEFT JOIN moved m ON m.topic_id = c.topic_id AND m.run_date = k.run_date)"""

ORDER_CHANNELS = """ov AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date, CAST(o_orderkey AS VARCHAR) AS video_id,
         CAST(o_custkey AS VARCHAR) AS channel_id, o_orderpriority AS channel_title,
         CAST(round(o_totalprice * 100) AS BIGINT) AS view_count, length(o_orderstatus) AS like_count,
         CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 100 END AS comment_count
  FROM orders),
oc AS (
  SELECT m.run_date, CAST(c_custkey AS VARCHAR) AS channel_id, c_name AS channel_title,
         CAST(c_nationkey AS BIGINT) AS subscriber_count, CAST(round(c_acctbal * 100) AS BIGINT) AS total_view_count,
         CAST(length(c_mktsegment) AS BIGINT) AS total_video_count
  FROM customer JOIN (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date
                      FROM orders WHERE o_orderstatus = 'F') m ON m.o_custkey = c_custkey),
cd AS (
  SELECT v.run_date, v.channel_id, v.channel_title, CAST(count(DISTINCT v.video_id) AS BIGINT) AS videos_count,
         CAST(sum(v.view_count) AS BIGINT) AS total_views, CAST(sum(v.like_count) AS BIGINT) AS total_likes,
         CAST(sum(v.comment_count) AS BIGINT) AS total_comments, max(c.subscriber_count) AS subscriber_count,
         max(c.total_view_count) AS total_channel_views, max(c.total_video_count) AS total_channel_videos,
         CAST(sum(v.view_count) AS DOUBLE) / count(DISTINCT v.video_id) AS avg_views_per_video,
         CAST(sum(v.comment_count) AS DOUBLE) / count(DISTINCT v.video_id) AS avg_comments_per_video
  FROM ov v LEFT JOIN oc c ON v.channel_id = c.channel_id AND v.run_date = c.run_date
  GROUP BY v.run_date, v.channel_id, v.channel_title)"""

SUMMARY = TOPICS + """, ch AS (
  SELECT channel_id, run_date, 'channel ' || channel_id AS channel_title FROM ev
  WHERE event_type = 'signup' GROUP BY channel_id, run_date),
topic_sum AS (
  SELECT a.run_date, a.raw_macro AS id, upper(a.raw_macro) AS name, sum(v.comment_count) AS n
  FROM assigned a JOIN videos v ON a.video_id = v.video_id AND a.run_date = v.run_date
  WHERE a.raw_macro <> 'other' GROUP BY a.run_date, a.raw_macro),
top_topic AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY n DESC, id) AS rn FROM topic_sum) q WHERE rn = 1),
channel_sum AS (
  SELECT v.run_date, c.channel_id AS id, c.channel_title AS name, sum(v.view_count) AS n
  FROM videos v JOIN ch c ON v.channel_id = c.channel_id AND v.run_date = c.run_date
  GROUP BY v.run_date, c.channel_id, c.channel_title),
top_channel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY n DESC, id) AS rn FROM channel_sum) q WHERE rn = 1),
vs AS (SELECT run_date, count(DISTINCT video_id) AS a, count(DISTINCT channel_id) AS b, sum(view_count) AS c,
              sum(like_count) AS d, sum(comment_count) AS e FROM videos GROUP BY run_date),
cs AS (SELECT run_date, count(DISTINCT event_id) AS n FROM ev GROUP BY run_date),
ts AS (SELECT run_date, count(DISTINCT CASE WHEN raw_macro <> 'other' THEN raw_macro END) AS n FROM assigned GROUP BY run_date),
summary AS (
  SELECT vs.run_date, CAST(a AS BIGINT) AS videos_monitored, CAST(b AS BIGINT) AS channels_monitored,
         CAST(coalesce(ts.n, 0) AS BIGINT) AS topics_detected, CAST(coalesce(cs.n, 0) AS BIGINT) AS comments_available,
         CAST(c AS BIGINT) AS total_views, CAST(d AS BIGINT) AS total_likes, CAST(e AS BIGINT) AS total_comments,
         t.id AS top_topic_id, t.name AS top_topic_name, CAST(t.n AS BIGINT) AS top_topic_comments,
         h.id AS top_channel_id, h.name AS top_channel_title, CAST(h.n AS BIGINT) AS top_channel_views
  FROM vs LEFT JOIN cs ON cs.run_date = vs.run_date LEFT JOIN ts ON ts.run_date = vs.run_date
  LEFT JOIN top_topic t ON t.run_date = vs.run_date LEFT JOIN top_channel h ON h.run_date = vs.run_date)"""

MOMENTUM = VIDEOS + f""", lagged AS (
  SELECT *, lag(view_count) OVER w AS previous_view_count, lag(like_count) OVER w AS previous_like_count,
         lag(comment_count) OVER w AS previous_comment_count
  FROM videos WHERE published_at >= (SELECT max(ts) FROM ev) - INTERVAL '{FRESH}'
  WINDOW w AS (PARTITION BY video_id ORDER BY extracted_at, run_date)),
grown AS (
  SELECT *, view_count - previous_view_count AS views_gained, like_count - previous_like_count AS likes_gained,
         comment_count - previous_comment_count AS comments_gained
  FROM lagged WHERE previous_view_count IS NOT NULL),
momentum AS (
  SELECT *, CAST(views_gained AS DOUBLE) / nullif(previous_view_count, 0) AS pct_growth,
         coalesce(views_gained, 0) + coalesce(likes_gained, 0) * 10 + coalesce(comments_gained, 0) * 25 AS momentum_score,
         date_sub('hour', published_at, extracted_at) AS video_age_hours
  FROM grown)"""

VERSIONED = EV + """, cur0 AS (SELECT * FROM ev WHERE event_type IN ('view', 'click', 'signup')),
inc0 AS (SELECT * FROM ev WHERE event_type NOT IN ('view', 'click', 'signup'))"""


def upsert(keys: str) -> str:
    same = " AND ".join(f"c.{k} = i.{k}" for k in keys.split(", "))
    return VERSIONED + f""", cur AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC, event_id) AS rn FROM cur0) q WHERE rn = 1),
inc AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC, event_id) AS rn FROM inc0) q WHERE rn = 1),
updated AS (
  SELECT i.*, c.run_date AS old_date FROM inc i JOIN cur c ON {same} WHERE i.ts > c.ts),
added AS (
  SELECT i.*, CAST(NULL AS DATE) AS old_date FROM inc i WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE {same})),
kept AS (SELECT c.* FROM cur c WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE {same} AND i.ts > c.ts))"""


def upserted(keys: str) -> str:
    columns = f"video_id, run_date, event_id, event_type, cents, {shown('ts')} AS extracted_at"
    return f"""WITH {upsert(keys)}
SELECT {columns} FROM kept UNION ALL SELECT {columns} FROM updated UNION ALL SELECT {columns} FROM added"""


NORM = r"trim(regexp_replace(strip_accents(lower({0})), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


def norm(column: str) -> str:
    return NORM.format(column)


def slug(column: str, length: int) -> str:
    base = f"trim(regexp_replace({norm(column)}, '[^a-z0-9]+', '_', 'g'), '_')"
    return f"coalesce(nullif(trim(substr({base}, 1, {length}), '_'), ''), 'topic')"


def words_in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def classification(rules, stop_words) -> str:
    """Rules, then TF-IDF cosine over the document and one text per topic, then catch-all."""
    topics, keywords = [], []
    for i, r in enumerate(rules):
        seed = " ".join([r.name, *r.keywords])
        topics.append(f"({i}, '{r.topic_id}', '{r.name}', {len(r.keywords)}, '{seed}')")
        keywords += [f"({i}, {j}, '{k}')" for j, k in enumerate(r.keywords)]
    grams = """SELECT owner, w AS term FROM {t} UNION ALL
    SELECT owner, w || ' ' || nxt FROM (SELECT owner, w, lead(w) OVER (PARTITION BY owner ORDER BY pos) AS nxt FROM {t}) q WHERE nxt IS NOT NULL"""
    return f"""WITH topic(ord, id, name, n_kw, seed) AS (VALUES {', '.join(topics)}),
kw0(ord, pos, kw) AS (VALUES {', '.join(keywords)}),
kw AS (SELECT ord, pos, kw, {norm('kw')} AS nk FROM kw0),
d AS (SELECT doc_id, {norm('text')} AS n FROM documents),
hit AS (SELECT doc_id, ord, pos, kw, CASE WHEN contains(nk, ' ') THEN 2 ELSE 1 END AS w
        FROM d JOIN kw ON contains(' ' || n || ' ', ' ' || nk || ' ')),
score AS (SELECT h.doc_id, h.ord, sum(w) AS s, string_agg(kw, ', ' ORDER BY pos) AS kws,
                 least(1.0, CAST(sum(w) AS DOUBLE) / greatest(3.0, max(t.n_kw) / 2.0)) AS conf
          FROM hit h JOIN topic t ON t.ord = h.ord GROUP BY h.doc_id, h.ord),
by_rule AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, conf DESC, ord) AS rn FROM score) q WHERE rn = 1),
open_docs AS (SELECT doc_id, n FROM d WHERE doc_id NOT IN (SELECT doc_id FROM by_rule)),
dw0 AS (SELECT doc_id AS owner, unnest(string_split(n, ' ')) AS w, generate_subscripts(string_split(n, ' '), 1) AS pos FROM open_docs),
dw AS (SELECT * FROM dw0 WHERE length(w) > 1 AND w NOT IN ({words_in(stop_words)})),
sw0 AS (SELECT ord AS owner, unnest(string_split({norm('seed')}, ' ')) AS w, generate_subscripts(string_split({norm('seed')}, ' '), 1) AS pos FROM topic),
sw AS (SELECT * FROM sw0 WHERE length(w) > 1 AND w NOT IN ({words_in(stop_words)})),
dt AS (SELECT owner, term, count(*) AS tf FROM ({grams.format(t='dw')}) q GROUP BY owner, term),
st AS (SELECT owner, term, count(*) AS tf FROM ({grams.format(t='sw')}) q GROUP BY owner, term),
sf AS (SELECT term, count(*) AS df FROM st GROUP BY term),
dv AS (SELECT dt.owner, dt.term, dt.tf * (ln({len(rules) + 2}.0 / (2 + coalesce(sf.df, 0))) + 1) AS w
       FROM dt LEFT JOIN sf ON sf.term = dt.term),
dn AS (SELECT owner, sqrt(sum(w * w)) AS len FROM dv GROUP BY owner),
sv AS (SELECT o.doc_id, st.owner AS ord, st.term,
              st.tf * (ln({len(rules) + 2}.0 / (1 + sf.df + CASE WHEN dt.term IS NULL THEN 0 ELSE 1 END)) + 1) AS w
       FROM open_docs o CROSS JOIN st JOIN sf ON sf.term = st.term
       LEFT JOIN dt ON dt.owner = o.doc_id AND dt.term = st.term),
sn AS (SELECT doc_id, ord, sqrt(sum(w * w)) AS len FROM sv GROUP BY doc_id, ord),
dot AS (SELECT sv.doc_id, sv.ord, sum(sv.w * dv.w) AS x FROM sv JOIN dv ON dv.owner = sv.doc_id AND dv.term = sv.term GROUP BY sv.doc_id, sv.ord),
sim AS (SELECT dot.doc_id, dot.ord, x / (dn.len * sn.len) AS s FROM dot JOIN dn ON dn.owner = dot.doc_id
        JOIN sn ON sn.doc_id = dot.doc_id AND sn.ord = dot.ord),
by_sim AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(s, 12) DESC, ord) AS rn FROM sim WHERE s > 0) q WHERE rn = 1),
src AS (SELECT 'title,description,tags,search_query,comments' AS txt)
SELECT d.doc_id, coalesce(rt.id, qt.id, 'other') AS macro_topic_id, coalesce(rt.name, qt.name, 'Otros') AS macro_topic_name,
       coalesce(r.kws, '') AS macro_topic_keywords, round(coalesce(r.conf, q.s, 0.0), 9) AS topic_confidence,
       CASE WHEN r.doc_id IS NOT NULL THEN 'macro_keyword_rules_v2' WHEN q.doc_id IS NOT NULL THEN 'macro_tfidf_fallback_v2' ELSE 'fallback' END AS topic_method,
       CASE WHEN r.doc_id IS NULL AND q.doc_id IS NULL THEN 'none' ELSE (SELECT txt FROM src) END AS matched_source
FROM d LEFT JOIN by_rule r ON r.doc_id = d.doc_id LEFT JOIN topic rt ON rt.ord = r.ord
LEFT JOIN by_sim q ON q.doc_id = d.doc_id LEFT JOIN topic qt ON qt.ord = q.ord"""


def token_table(condition: str) -> str:
    """Words of each document in order, after filtering."""
    return f"""d AS (SELECT doc_id, lang, source, {norm('text')} AS n FROM documents),
w0 AS (SELECT doc_id, unnest(string_split(n, ' ')) AS w, generate_subscripts(string_split(n, ' '), 1) AS place FROM d),
w1 AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS pos FROM w0
       WHERE w <> '' AND w NOT IN ({words_in(PHRASE_STOP_WORDS)}) AND {condition}),
w3 AS (SELECT doc_id, pos, w, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM w1 WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT doc_id, 3 AS size, pos, w || ' ' || b || ' ' || c AS term FROM w3 WHERE c IS NOT NULL
      UNION ALL SELECT doc_id, 2, pos, w || ' ' || b FROM w3 WHERE b IS NOT NULL
      UNION ALL SELECT doc_id, 1, pos, w FROM w3)"""


def displayed(column: str) -> str:
    """Lower-cased text with the display terms put back, longest first."""
    out = f"lower({column})"
    for term in sorted(DISPLAY_TERMS, key=lambda t: -len(t)):
        out = f"regexp_replace({out}, '\\b{term}\\b', '{DISPLAY_TERMS[term]}', 'gi')"
    return out


ORACLE: dict[str, str] = {
    "latest_per_key": f"""WITH {EV}
SELECT user_id, run_date, event_id, event_type, cents, {shown('ts')} AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, run_date ORDER BY ts DESC, event_id) AS rn FROM ev) q WHERE rn = 1""",
    "upsert_newer": upserted("video_id, run_date"),
    "upsert_moves_date": upserted("video_id"),
    "upsert_changes": f"""WITH {upsert('video_id')}
SELECT video_id, run_date, event_id, old_date FROM updated UNION ALL SELECT video_id, run_date, event_id, old_date FROM added""",
    "search_merge": f"""WITH {EV}, h AS (
  SELECT video_id, event_type AS q, CASE WHEN event_type <> 'click' THEN props END AS title, cents FROM ev),
t AS (SELECT video_id, title FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY q, title) AS rn FROM h WHERE title IS NOT NULL) x WHERE rn = 1),
c AS (SELECT video_id, cents FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY q, cents) AS rn FROM h) x WHERE rn = 1),
s AS (SELECT video_id, string_agg(DISTINCT q, ', ' ORDER BY q) AS search_query FROM h GROUP BY video_id)
SELECT s.video_id, s.search_query, t.title, c.cents FROM s JOIN c ON c.video_id = s.video_id LEFT JOIN t ON t.video_id = s.video_id""",
    "distinct_channels": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS channel_id FROM orders WHERE o_custkey IS NOT NULL",
    "first_per_key": f"""WITH {EV}, c AS (
  SELECT run_date, CASE WHEN event_type <> 'error' THEN props END AS comment_text, CAST(event_id AS VARCHAR) AS comment_id, cents AS like_count FROM ev)
SELECT run_date, comment_text, comment_id, like_count FROM (
  SELECT *, row_number() OVER (PARTITION BY run_date, comment_text ORDER BY like_count DESC, comment_id) AS rn FROM c) q WHERE rn = 1""",
    "previous_state_lookup": f"""WITH {TOPICS}
SELECT macro_topic_id, sub_topic_id, sub_topic_name, keywords FROM (
  SELECT *, row_number() OVER (PARTITION BY macro_topic_id, sub_topic_id ORDER BY run_date DESC, sub_topic_name, keywords) AS rn
  FROM td WHERE run_date < {LAST_DAY}) q WHERE rn = 1""",
    "video_momentum": f"""WITH {MOMENTUM}
SELECT run_date, video_id, title, channel_id, view_count, like_count, comment_count, previous_view_count,
       previous_like_count, previous_comment_count, views_gained, likes_gained, comments_gained, pct_growth,
       momentum_score, video_age_hours FROM momentum""",
    "video_discovery": f"""WITH {MOMENTUM}
SELECT video_id, title, channel_title, description, view_count, views_gained, comments_gained, likes_gained,
       pct_growth, momentum_score, video_age_hours, CAST(comment_count AS DOUBLE) / nullif(view_count, 0) AS comment_rate,
       CAST(like_count AS DOUBLE) / nullif(view_count, 0) AS like_rate,
       CASE WHEN view_count < {LIMITS.gem_views} AND momentum_score > 0 THEN 'hidden_gem'
            WHEN view_count < 20000 AND pct_growth >= 0.5 THEN 'breakout_candidate'
            WHEN comments_gained >= {LIMITS.driver_comments} AND CAST(comment_count AS DOUBLE) / nullif(view_count, 0) >= {LIMITS.driver_rate:.4f} THEN 'conversation_driver'
            ELSE 'normal' END AS discovery_type
FROM momentum
WHERE view_count BETWEEN 100 AND 100000 AND (pct_growth >= 0.25 OR comments_gained >= 3 OR momentum_score >= 500)""",
    "counter_changes_hot_keys": f"""WITH {EV}
SELECT event_id, event_type, cents, lag(cents) OVER w AS previous_cents, cents - lag(cents) OVER w AS cents_change,
       lag(user_id) OVER w AS previous_user, user_id - lag(user_id) OVER w AS user_change
FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
    "topic_daily": f"""WITH {TOPICS}
SELECT {KEY}, keywords, representative_videos, sample_comments, videos_count, video_count, total_views, view_count_total,
       total_likes, total_comments, comment_count_total, avg_views_per_video, avg_likes_per_video,
       avg_comments_per_video, sentiment_avg, relevance_score FROM td""",
    "topic_trends": f"""WITH {TOPICS}
SELECT {KEY}, keywords, videos_count, video_count, total_views, view_count_total, total_likes, total_comments,
       comment_count_total, relevance_score,
       lag(videos_count) OVER w AS previous_videos_count, lag(total_views) OVER w AS previous_total_views,
       lag(total_likes) OVER w AS previous_total_likes, lag(total_comments) OVER w AS previous_total_comments,
       videos_count - lag(videos_count) OVER w AS videos_count_change, total_views - lag(total_views) OVER w AS views_change,
       total_likes - lag(total_likes) OVER w AS likes_change, total_comments - lag(total_comments) OVER w AS comments_change
FROM td WINDOW w AS (PARTITION BY sub_topic_id ORDER BY run_date, topic_id)""",
    "channel_daily": f"WITH {ORDER_CHANNELS} SELECT * FROM cd",
    "dashboard_summary": f"WITH {SUMMARY} SELECT * FROM summary",
    "date_bounds": f"WITH {EV} SELECT max(run_date) AS latest_run_date, min(run_date) AS earliest_run_date FROM ev",
    "metadata": f"""WITH {EV} SELECT max(run_date) AS latest_run_date, min(run_date) AS earliest_run_date,
       count(DISTINCT run_date) AS days_available, CAST(32 AS BIGINT) AS data_window_days FROM ev""",
    "dashboard_summary_export": f"WITH {SUMMARY} SELECT * FROM summary WHERE run_date = {LAST_DAY}",
    "top_relevant_topics": f"WITH {RELEVANT} SELECT topic_id, topic_name, window_total_comments, window_total_views, rank FROM relevant WHERE rank <= 6",
    "topics_over_time_dense": f"WITH {SERIES} SELECT * FROM series",
    "topic_share": f"""WITH {DAY_TOPICS}
SELECT topic_id, topic_name, total_comments, CAST(total_comments AS DOUBLE) / nullif(sum(total_comments) OVER (), 0) AS share_of_comments,
       total_views, videos_count FROM sel ORDER BY total_comments DESC, total_views DESC, topic_id LIMIT 10""",
    "topic_changes": f"""WITH {TOPICS}, daily AS (
  SELECT run_date, macro_topic_id AS topic_id, min(macro_topic_name) AS topic_name, CAST(sum(videos_count) AS BIGINT) AS videos_count,
         CAST(sum(total_comments) AS BIGINT) AS total_comments, CAST(sum(total_views) AS BIGINT) AS total_views
  FROM td GROUP BY run_date, macro_topic_id),
l AS (SELECT *, lag(total_comments) OVER w AS previous_total_comments, lag(total_views) OVER w AS previous_total_views,
             lag(videos_count) OVER w AS previous_videos_count FROM daily WINDOW w AS (PARTITION BY topic_id ORDER BY run_date)),
today AS (SELECT * FROM l WHERE run_date = {LAST_DAY})
SELECT topic_id, topic_name, total_comments, previous_total_comments, total_comments - previous_total_comments AS comments_change,
       total_views, previous_total_views, total_views - previous_total_views AS views_change, videos_count,
       videos_count - previous_videos_count AS videos_count_change
FROM today WHERE topic_id <> 'other' OR NOT EXISTS (SELECT 1 FROM today WHERE topic_id <> 'other')
ORDER BY comments_change DESC NULLS LAST, views_change DESC NULLS LAST, topic_id LIMIT 10""",
    "top_topics": f"""WITH {DAY_TOPICS}
SELECT CAST(row_number() OVER (ORDER BY total_comments DESC, total_views DESC, topic_id) AS BIGINT) AS rank, topic_id, topic_name,
       videos_count, total_views, total_likes, total_comments, CAST(total_comments AS DOUBLE) / nullif(videos_count, 0) AS avg_comments_per_video
FROM sel ORDER BY rank LIMIT 10""",
    "catch_all_only_share": f"""WITH {TOPICS}
SELECT 'other' AS topic_id, 'other' AS topic_name, CAST(sum(total_comments) AS BIGINT) AS total_comments, CAST(1 AS DOUBLE) AS share_of_comments,
       CAST(sum(total_views) AS BIGINT) AS total_views, CAST(sum(videos_count) AS BIGINT) AS videos_count
FROM td WHERE run_date = {LAST_DAY}""",
    "top_videos_by_topic": f"""WITH {RELEVANT}, r AS (
  SELECT x.rank AS topic_rank, coalesce(a.raw_macro, a.topic_id) AS topic_id, upper(coalesce(a.raw_macro, a.topic_id)) AS topic_name,
         CAST(row_number() OVER (PARTITION BY x.topic_id ORDER BY v.comment_count DESC, v.view_count DESC, v.video_id) AS BIGINT) AS video_rank,
         v.video_id, a.raw_sub AS sub_topic_id, a.raw_sub_name AS sub_topic_name, v.title, v.channel_title, v.video_url, v.thumbnail_url,
         v.view_count, v.like_count, v.comment_count, {shown('v.published_at')} AS published_at, a.kw AS topic_keywords, 'props' AS matched_source
  FROM assigned a JOIN videos v ON a.video_id = v.video_id AND a.run_date = v.run_date
  JOIN relevant x ON x.topic_id = coalesce(a.raw_macro, a.topic_id) AND x.rank <= 6
  WHERE a.run_date = {LAST_DAY} AND coalesce(a.raw_macro, a.topic_id) <> 'other')
SELECT * FROM r WHERE video_rank <= 5""",
    "sub_topics_over_time": f"""WITH {TOPICS}, {CALENDAR},
daily AS (
  SELECT macro_topic_id, sub_topic_id, run_date, min(macro_topic_name) AS macro_topic_name, min(sub_topic_name) AS sub_topic_name,
         min(keywords) AS keywords, CAST(sum(videos_count) AS BIGINT) AS videos_count, CAST(sum(total_comments) AS BIGINT) AS total_comments,
         CAST(sum(total_views) AS BIGINT) AS total_views
  FROM td WHERE macro_topic_id <> 'other' AND sub_topic_id IS NOT NULL AND run_date BETWEEN DATE '2023-12-31' AND DATE '2024-01-31'
  GROUP BY macro_topic_id, sub_topic_id, run_date),
tot AS (
  SELECT macro_topic_id, sub_topic_id, CAST(sum(total_comments) AS BIGINT) AS window_total_comments,
         CAST(sum(total_views) AS BIGINT) AS window_total_views, arg_min(macro_topic_name, run_date) AS macro_topic_name,
         arg_min(sub_topic_name, run_date) AS sub_topic_name, arg_min(keywords, run_date) AS keywords
  FROM daily GROUP BY macro_topic_id, sub_topic_id),
best AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY macro_topic_id ORDER BY window_total_comments DESC, window_total_views DESC, sub_topic_id) AS BIGINT) AS sub_topic_rank
  FROM tot)
SELECT b.*, k.run_date, coalesce(d.videos_count, 0) AS videos_count, coalesce(d.total_comments, 0) AS total_comments,
       coalesce(d.total_views, 0) AS total_views, CAST(0 AS BIGINT) AS comments_change, CAST(0 AS BIGINT) AS views_change
FROM best b CROSS JOIN cal k
LEFT JOIN daily d ON d.macro_topic_id = b.macro_topic_id AND d.sub_topic_id = b.sub_topic_id AND d.run_date = k.run_date
WHERE b.sub_topic_rank <= 8""",
    "top_sub_topics_by_macro": f"""WITH {TOPICS}, r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY macro_topic_id ORDER BY total_comments DESC, total_views DESC, sub_topic_id) AS BIGINT) AS sub_topic_rank
  FROM td WHERE run_date = {LAST_DAY} AND macro_topic_id <> 'other')
SELECT macro_topic_id, macro_topic_name, sub_topic_rank, sub_topic_id, sub_topic_name, keywords, representative_videos,
       sample_comments, videos_count, total_views, total_comments, relevance_score FROM r WHERE sub_topic_rank <= 8""",
    "videos_by_sub_topic": f"""WITH {TOPICS}, r AS (
  SELECT coalesce(a.raw_macro, a.topic_id) AS macro_topic_id, upper(coalesce(a.raw_macro, a.topic_id)) AS macro_topic_name,
         a.raw_sub AS sub_topic_id, a.raw_sub_name AS sub_topic_name,
         CAST(row_number() OVER (PARTITION BY a.raw_sub ORDER BY v.comment_count DESC, v.view_count DESC, v.video_id) AS BIGINT) AS video_rank,
         v.video_id, v.title, v.channel_title, v.video_url, v.thumbnail_url, v.view_count, v.like_count, v.comment_count,
         {shown('v.published_at')} AS published_at, a.kw AS topic_keywords
  FROM assigned a JOIN videos v ON a.video_id = v.video_id AND a.run_date = v.run_date
  WHERE a.run_date = {LAST_DAY} AND coalesce(a.raw_macro, a.topic_id) <> 'other' AND a.raw_sub IS NOT NULL)
SELECT * FROM r WHERE video_rank <= 5""",
    "top_channels": f"""WITH {ORDER_CHANNELS}
SELECT CAST(row_number() OVER (ORDER BY total_comments DESC NULLS LAST, total_views DESC, channel_id, channel_title) AS BIGINT) AS rank,
       channel_id, channel_title, videos_count, total_views, total_likes, total_comments, subscriber_count, avg_comments_per_video
FROM cd WHERE run_date = (SELECT max(run_date) FROM cd) ORDER BY rank LIMIT 10""",
    "topics_over_time_json": f"""WITH {SERIES}, per_topic AS (
  SELECT topic_rank, '{{"topic_id":"' || topic_id || '","topic_name":"' || topic_name || '","window_total_comments":' || window_total_comments
         || ',"window_total_views":' || window_total_views || ',"series":[' || string_agg('{{"run_date":"' || run_date || '","videos_count":' || videos_count
         || ',"total_comments":' || total_comments || ',"total_views":' || total_views || ',"comments_change":' || coalesce(CAST(comments_change AS VARCHAR), 'null')
         || ',"views_change":' || coalesce(CAST(views_change AS VARCHAR), 'null') || '}}', ',' ORDER BY run_date) || ']}}' AS j
  FROM series GROUP BY topic_rank, topic_id, topic_name, window_total_comments, window_total_views)
SELECT '{{"start_date":"2023-12-31","end_date":"2024-01-31","dates":[' || (SELECT string_agg('"' || run_date || '"', ',' ORDER BY run_date) FROM cal)
       || '],"window_days":32,"metric":"total_comments","topics":[' || (SELECT string_agg(j, ',' ORDER BY topic_rank) FROM per_topic) || ']}}' AS document""",
    "top_sub_topics_json": f"""WITH {TOPICS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY macro_topic_id ORDER BY total_comments DESC, total_views DESC, sub_topic_id) AS rn
  FROM td WHERE run_date = {LAST_DAY} AND macro_topic_id <> 'other')
SELECT '{{"macro_topic_id":"' || macro_topic_id || '","macro_topic_name":"' || min(macro_topic_name) || '","sub_topics":['
       || string_agg('{{"sub_topic_rank":' || rn || ',"sub_topic_id":"' || sub_topic_id || '","keywords":"' || keywords || '","total_comments":' || total_comments || '}}', ',' ORDER BY rn)
       || ']}}' AS document
FROM r WHERE rn <= 8 GROUP BY macro_topic_id""",
    "json_records": f"""WITH {EV}
SELECT '{{"event_id":' || event_id || ',"run_date":"' || run_date || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","cents":' || cents || ',"name":'
       || CASE WHEN event_type = 'error' THEN 'null' ELSE '"é ' || event_type || '"' END || '}}' AS record FROM ev""",
    "normalize_text": f"SELECT doc_id, md5({norm('text')}) AS digest, CAST(length({norm('text')}) AS BIGINT) AS length FROM documents",
    "slugify": f"SELECT doc_id, {slug('text', 42)} AS slug, {slug('lang', 1)} AS short FROM documents",
    "iso_duration": """WITH s AS (
  SELECT l_orderkey, l_linenumber, CASE
    WHEN l_returnflag = 'R' THEN l_linenumber * 86400 + CAST(l_quantity AS BIGINT) * 3600
    WHEN l_linestatus = 'F' THEN l_linenumber * 3600 + CAST(l_quantity AS BIGINT) * 60 + l_suppkey END AS seconds FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(sum(seconds) AS BIGINT) AS seconds, count(*) AS lines, count(seconds) AS readable
FROM s GROUP BY l_orderkey, l_linenumber""",
    "schema_normalize": f"""SELECT CAST(event_id AS VARCHAR) AS video_id, CAST(ts AS DATE) AS run_date,
       CASE WHEN event_type <> 'error' THEN {shown('ts')} END AS published_at,
       CASE WHEN event_type <> 'view' THEN user_id END AS view_count,
       CASE WHEN event_type <> 'click' THEN CAST(7 AS BIGINT) END AS like_count, CAST(NULL AS BIGINT) AS comment_count FROM events""",
    "date_window_local": f"""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders),
u AS (SELECT run_date, (CAST(run_date - 2 AS TIMESTAMP) AT TIME ZONE 'America/Monterrey') AT TIME ZONE 'UTC' AS a,
             (CAST(run_date + 1 AS TIMESTAMP) AT TIME ZONE 'America/Monterrey') AT TIME ZONE 'UTC' AS b FROM d)
SELECT run_date, {shown('a')} AS published_after_utc, {shown('b')} AS published_before_utc, CAST(3 AS BIGINT) AS days,
       run_date - 3 AS day_before FROM u""",
    "flatten_search": f"""WITH {EV}
SELECT event_type AS search_query, CAST(event_id AS VARCHAR) AS video_id, channel_id, CAST(NULL AS VARCHAR) AS channel_title,
       props AS title, 'u/' || video_id AS thumbnail_url, 'kept' AS etag FROM ev WHERE event_type <> 'error'""",
    "flatten_details": """SELECT CAST(o_orderkey AS VARCHAR) AS video_id, o_orderstatus AS category_id,
       CASE WHEN o_orderstatus = 'F' THEN o_orderstatus || ', ' || o_orderpriority END AS tags, CAST(NULL AS VARCHAR) AS default_language,
       o_custkey AS duration_seconds, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS view_count,
       CASE WHEN o_orderstatus = 'O' THEN CAST(0 AS BIGINT) END AS like_count, CAST(NULL AS BIGINT) AS comment_count FROM orders""",
    "flatten_comments": f"""WITH {EV}
SELECT video_id, CAST(event_id AS VARCHAR) AS comment_id, CAST(NULL AS VARCHAR) AS parent_id,
       CASE WHEN event_type <> 'view' THEN video_id END AS author_channel_id, event_type AS comment_text, cents AS like_count FROM ev""",
    "flatten_channels": """SELECT CAST(c_custkey AS VARCHAR) AS channel_id, c_name AS channel_title, c_mktsegment AS description,
       CAST(NULL AS VARCHAR) AS custom_url, CAST(NULL AS VARCHAR) AS country, CAST(c_nationkey AS BIGINT) AS subscriber_count,
       CAST(NULL AS BIGINT) AS total_view_count, CAST(NULL AS BIGINT) AS total_video_count FROM customer""",
    "videos_snapshot": f"""WITH {EV}, q AS (
  SELECT video_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS search_query, min(channel_id) AS channel_id FROM ev GROUP BY video_id),
f AS (SELECT video_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY event_type, ts) AS rn FROM ev) x WHERE rn = 1),
p AS (SELECT video_id, CAST(sum(cents) AS BIGINT) AS n FROM ev WHERE event_type = 'purchase' GROUP BY video_id)
SELECT DATE '2024-01-30' AS run_date, q.video_id, 'https://www.youtube.com/watch?v=' || q.video_id AS video_url, q.channel_id, q.search_query,
       p.n AS view_count, CAST(NULL AS BIGINT) AS like_count, {shown('f.ts')} AS published_at,
       '2024-01-28 06:00:00.000000' AS published_after_utc, '2024-01-31 06:00:00.000000' AS published_before_utc
FROM q JOIN f ON f.video_id = q.video_id LEFT JOIN p ON p.video_id = q.video_id""",
    "comments_snapshot": f"""WITH {VIDEOS}, last AS (SELECT video_id, max(run_date) AS run_date FROM ev GROUP BY video_id)
SELECT l.run_date, e.video_id, 'https://host/' || e.video_id AS video_url, 'user ' || e.video_id AS video_title,
       CAST(e.event_id AS VARCHAR) AS comment_id, CASE WHEN event_type <> 'error' THEN props END AS comment_text, cents AS like_count
FROM ev e JOIN last l ON l.video_id = e.video_id""",
    "channels_snapshot": """SELECT DATE '2024-01-30' AS run_date, CAST(c_custkey AS VARCHAR) AS channel_id, c_name AS channel_title,
       c_mktsegment AS country, CAST(c_nationkey AS BIGINT) AS subscriber_count, CAST(NULL AS BIGINT) AS total_view_count
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "build_documents": """WITH c AS (
  SELECT conv_id, string_agg(text, ' ' ORDER BY rn) AS talk FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, conv_id || '-' || turn) AS rn
    FROM conversations WHERE text IS NOT NULL) q WHERE rn <= 30 GROUP BY conv_id),
d AS (SELECT CAST(doc_id AS VARCHAR) AS video_id,
             substr(concat_ws(' ', source || ' ' || lang, text, lang, source, c.talk), 1, 12000) AS t
      FROM documents LEFT JOIN c ON c.conv_id = doc_id)
SELECT video_id, CAST(length(t) AS BIGINT) AS length, md5(t) AS digest FROM d""",
    "macro_rules": classification(WORD_RULES, SIMILARITY_STOP_WORDS),
    "macro_tfidf_fallback": classification(SIMILARITY_RULES, SIMILARITY_STOP_WORDS),
    "top_phrases_single_doc": f"""WITH {token_table("length(w) > 2")},
c AS (SELECT doc_id, term, count(*) AS n, max(size) AS size, min(pos) AS pos FROM g GROUP BY doc_id, term),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, size DESC, pos) AS rn FROM c),
p AS (SELECT doc_id, string_agg(term, '|' ORDER BY rn) AS phrases FROM r WHERE rn <= 8 GROUP BY doc_id)
SELECT documents.doc_id, coalesce(p.phrases, 'conversacion especifica') AS phrases FROM documents LEFT JOIN p ON p.doc_id = documents.doc_id""",
    "sub_topic_names": f"""WITH {token_table("length(w) > 2")},
c AS (SELECT doc_id, term, count(*) AS n, max(size) AS size, min(pos) AS pos FROM g GROUP BY doc_id, term),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, size DESC, pos) AS rn FROM c),
t AS (SELECT d.doc_id, coalesce(r.rn, 1) AS rn, coalesce(r.term, 'conversacion especifica') AS term FROM d LEFT JOIN r ON r.doc_id = d.doc_id AND r.rn <= 8),
s AS (SELECT doc_id, rn, {displayed('term')} AS shown, contains(term, ' ') AS long FROM t),
k AS (SELECT doc_id, string_agg(shown, ', ' ORDER BY rn) AS keywords, min(CASE WHEN long THEN rn END) AS at_long FROM s GROUP BY doc_id)
SELECT k.doc_id, substr(coalesce(s.shown, d.source || ' ' || d.lang), 1, 80) AS name, k.keywords
FROM k JOIN d ON d.doc_id = k.doc_id LEFT JOIN s ON s.doc_id = k.doc_id AND s.rn = k.at_long""",
    "cluster_top_phrases": f"""WITH {token_table("length(w) > 1 AND ascii(w) < 128")},
tf AS (SELECT d.lang, g.doc_id, term, count(*) AS tf FROM g JOIN d ON d.doc_id = g.doc_id GROUP BY d.lang, g.doc_id, term),
n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
df AS (SELECT tf.lang, term, ln((1.0 + max(n.n)) / (1 + count(*))) + 1 AS idf FROM tf JOIN n ON n.lang = tf.lang
       GROUP BY tf.lang, term HAVING count(*) <= 0.9 * max(n.n)),
raw AS (SELECT tf.lang, doc_id, tf.term, tf * idf AS w FROM tf JOIN df ON df.lang = tf.lang AND df.term = tf.term),
len AS (SELECT doc_id, sqrt(sum(w * w)) AS len FROM raw GROUP BY doc_id),
s AS (SELECT raw.lang, d.source, term, CAST(sum(CAST(round(w / len * 1000000000) AS BIGINT)) AS BIGINT) AS s
      FROM raw JOIN len ON len.doc_id = raw.doc_id JOIN d ON d.doc_id = raw.doc_id
      WHERE length(term) > 2 GROUP BY raw.lang, d.source, term),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY s DESC, term) AS rn FROM s WHERE s > 0),
k AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source)
SELECT r.lang, r.source AS label, string_agg(term, '|' ORDER BY rn) AS phrases,
       round(max(s) / 1000000000.0 / max(k.n), 7) AS best
FROM r JOIN k ON k.lang = r.lang AND k.source = r.source WHERE rn <= 8 GROUP BY r.lang, r.source""",
    "stable_ids_jaccard": f"""WITH RECURSIVE {EV}, days AS (
  SELECT DISTINCT event_type AS m, run_date, 'u' || CAST(user_id % 60 AS VARCHAR) AS kw FROM ev),
lab AS (SELECT m, CAST(run_date - DATE '2024-01-28' AS BIGINT) AS label, run_date, kw FROM days WHERE run_date >= DATE '2024-01-28'),
old AS (SELECT m, m || '__' || run_date AS id, kw FROM days WHERE run_date < DATE '2024-01-28'),
ln AS (SELECT m, label, run_date, count(*) AS n, string_agg(kw, '|' ORDER BY kw) AS sig FROM lab GROUP BY m, label, run_date),
onn AS (SELECT m, id, count(*) AS n FROM old GROUP BY m, id),
both_n AS (SELECT lab.m, label, id, count(*) AS n FROM lab JOIN old ON old.m = lab.m AND old.kw = lab.kw GROUP BY lab.m, label, id),
cand AS (SELECT b.m, b.label, b.id, CAST(b.n AS DOUBLE) / (l.n + o.n - b.n) AS s FROM both_n b
         JOIN ln l ON l.m = b.m AND l.label = b.label JOIN onn o ON o.m = b.m AND o.id = b.id),
ranked AS (SELECT m, label, id, row_number() OVER (PARTITION BY m, label ORDER BY s DESC, id) AS rn FROM cand WHERE s >= 0.45),
opt AS (SELECT m, label, list(id ORDER BY rn) AS ids FROM ranked GROUP BY m, label),
lbl AS (SELECT l.m, l.label, l.run_date, coalesce(o.ids, CAST([] AS VARCHAR[])) AS ids,
               l.m || '__day_' || replace(CAST(l.run_date AS VARCHAR), '-', '_') || '__' || substr(sha1(l.sig), 1, 8) AS new_id
        FROM ln l LEFT JOIN opt o ON o.m = l.m AND o.label = l.label),
pick AS (
  SELECT m, label, coalesce(ids[1], new_id) AS id, [coalesce(ids[1], new_id)] AS used FROM lbl WHERE label = 0
  UNION ALL
  SELECT l.m, l.label, coalesce(list_filter(l.ids, lambda x: NOT list_contains(p.used, x))[1], l.new_id),
         list_append(p.used, coalesce(list_filter(l.ids, lambda x: NOT list_contains(p.used, x))[1], l.new_id))
  FROM pick p JOIN lbl l ON l.m = p.m AND l.label = p.label + 1)
SELECT p.m AS macro_topic_id, p.label, 'day ' || l.run_date AS name, p.id AS sub_topic_id
FROM pick p JOIN lbl l ON l.m = p.m AND l.label = p.label""",
    # Clusters of a language: about the root of its documents, two to five; copies are never parted.
    "subtopic_clusters": """
SELECT lang, count(*) AS documents, CAST(0 AS BIGINT) AS parted_copies,
       CAST(CASE WHEN count(*) <= 2 THEN count(*) ELSE greatest(2, least(5, ceil(sqrt(count(*))))) END AS BIGINT) AS clusters
FROM documents GROUP BY lang""",
    # Five vocabularies without a common word: the clusters are the priorities.
    "subtopic_clusters_orders": """
WITH f AS (SELECT o_orderpriority AS p, min(o_orderkey) AS first FROM orders GROUP BY 1),
n AS (SELECT p, row_number() OVER (ORDER BY first) - 1 AS label FROM f)
SELECT o_orderkey, label FROM orders JOIN n ON p = o_orderpriority""",
    "video_topics": """
WITH o AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS video_id, o_custkey % 2 = 0 AS is_even,
         substr(o_orderpriority, 1, 1) || CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS kind, o_orderkey AS k
  FROM orders)
SELECT video_id, CASE WHEN is_even THEN 'even' ELSE 'odd' END AS macro_topic_id,
       CASE WHEN is_even THEN 'Even customers' ELSE 'Odd customers' END AS macro_topic_name,
       min(video_id) OVER (PARTITION BY kind) AS first_video, count(*) OVER (PARTITION BY kind) AS videos,
       'grp' || kind || ' grp' || kind || ' core' || kind || ' base' || kind || ' tail' || kind || 'x' || (k % 3)
         || ' end' || kind || 'x' || (k % 2) AS source_text
FROM o""",
    "snapshot_round_trip": """
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date, CAST(o_orderkey AS VARCHAR) AS video_id,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS view_count, o_orderkey AS k FROM orders)
SELECT run_date, video_id, view_count, 'again' AS note FROM o WHERE k = (SELECT max(k) FROM o WHERE run_date = (SELECT max(run_date) FROM o))
UNION ALL
SELECT run_date, video_id, view_count, NULL FROM o WHERE run_date = (SELECT min(run_date) FROM o)""",
    "table_changes": """
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date, CAST(o_orderkey AS VARCHAR) AS video_id,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS view_count FROM orders),
l AS (SELECT run_date, video_id, view_count + 1 AS view_count FROM o WHERE run_date = (SELECT max(run_date) FROM o))
SELECT *, NULL AS note FROM o WHERE run_date > (SELECT min(run_date) FROM o) AND run_date < (SELECT max(run_date) FROM o)
UNION ALL SELECT *, 'replaced' FROM l UNION ALL SELECT *, 'rebuilt' FROM l""",
}


def record(columns: str, alias: str = "x", **named: str) -> str:
    """JSON text of a row; ``named`` gives other expressions for some of the columns."""
    return "to_json({" + ", ".join(f"'{c}': {named.get(c, f'{alias}.{c}')}" for c in columns.split()) + "})"


def array_of(rows: str, order: str) -> str:
    """An array document, a record to a line."""
    return f"""SELECT coalesce('[' || string_agg(j, chr(10) || ',' ORDER BY {order}) || chr(10) || ']', '[]') || chr(10) FROM ({rows}) q"""


ISO = "replace(substr(x.published_at, 1, 19), ' ', 'T') || CASE WHEN substr(x.published_at, 21) = '000000' THEN 'Z' ELSE '.' || substr(x.published_at, 21) || 'Z' END"
VIDEO_FIELDS = "title channel_title video_url thumbnail_url view_count like_count comment_count published_at topic_keywords"
DAY_FIELDS = "run_date videos_count total_comments total_views comments_change views_change"

SUB_SERIES = f"""(
  WITH rows AS ({ORACLE["sub_topics_over_time"]}),
  sub AS (SELECT macro_topic_id, min(macro_topic_name) AS macro_topic_name, sub_topic_rank, sub_topic_id, min(sub_topic_name) AS sub_topic_name,
                 min(keywords) AS keywords, min(window_total_comments) AS window_total_comments, min(window_total_views) AS window_total_views,
                 list({record(DAY_FIELDS)} ORDER BY run_date) AS series FROM rows x GROUP BY macro_topic_id, sub_topic_rank, sub_topic_id),
  macro AS (SELECT macro_topic_id, min(macro_topic_name) AS macro_topic_name,
                   list({record("sub_topic_id sub_topic_name keywords window_total_comments window_total_views series")} ORDER BY sub_topic_rank) AS sub_topics
            FROM sub x GROUP BY macro_topic_id)
  SELECT to_json({{'start_date': '2023-12-31', 'end_date': '2024-01-31',
    'dates': (SELECT list(CAST(run_date AS VARCHAR) ORDER BY run_date) FROM (SELECT DISTINCT run_date FROM rows) q), 'window_days': 32, 'metric': 'total_comments',
    'macros': (SELECT list({record("macro_topic_id macro_topic_name sub_topics")} ORDER BY macro_topic_id) FROM macro x)}}) || chr(10))"""

LAST_CHANNELS = f"""WITH {TOPICS}, own AS (
  SELECT channel_id, channel_title, count(DISTINCT video_id) AS videos_count, sum(view_count) AS v, sum(like_count) AS l, sum(comment_count) AS c
  FROM videos WHERE run_date = {LAST_DAY} GROUP BY channel_id, channel_title),
known AS (SELECT channel_id, count(*) AS s FROM ev WHERE event_type = 'signup' AND run_date = {LAST_DAY} GROUP BY channel_id)
SELECT row_number() OVER (ORDER BY c DESC, v DESC, o.channel_id, channel_title) AS rank, o.channel_id, channel_title, videos_count, CAST(v AS BIGINT) AS total_views,
       CAST(l AS BIGINT) AS total_likes, CAST(c AS BIGINT) AS total_comments, s AS subscriber_count, CAST(c AS DOUBLE) / videos_count AS avg_comments_per_video
FROM own o LEFT JOIN known k ON k.channel_id = o.channel_id ORDER BY rank LIMIT 10"""

SUMMARY_FIELDS = (
    "run_date videos_monitored channels_monitored topics_detected comments_available total_views total_likes total_comments "
    "top_topic_id top_topic_name top_topic_comments top_channel_id top_channel_title top_channel_views"
)
CHANGE_FIELDS = (
    "topic_id topic_name total_comments previous_total_comments comments_change total_views previous_total_views views_change videos_count videos_count_change"
)
SUB_FIELDS = (
    "sub_topic_rank sub_topic_id sub_topic_name keywords representative_videos sample_comments videos_count total_views total_comments relevance_score"
)


def by_line(name: str, columns: str, order: str) -> str:
    """An array document with a record for each row of another query."""
    kept = ", ".join(f"{c} AS {c}" for c in dict.fromkeys(order.replace(" DESC", "").replace(" NULLS LAST", "").split(", ")))
    return array_of(f"SELECT {record(columns)} AS j, {kept} FROM ({ORACLE[name]}) x", order)


DOCUMENTS = {
    "latest_metadata.json": f"""(WITH {EV} SELECT to_json({{'generated_at': replace(strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ'), '.000000Z', 'Z'),
  'latest_run_date': max(run_date), 'earliest_run_date': min(run_date), 'days_available': count(DISTINCT run_date), 'data_window_days': 32}}) || chr(10) FROM ev)""",
    "dashboard_summary.json": f"SELECT {record(SUMMARY_FIELDS)} || chr(10) FROM ({ORACLE['dashboard_summary_export']}) x",
    "relevant_topics_over_time.json": f"SELECT document || chr(10) FROM ({ORACLE['topics_over_time_json']}) x",
    "topic_share_today.json": by_line(
        "topic_share", "topic_id topic_name total_comments share_of_comments total_views videos_count", "total_comments DESC, total_views DESC, topic_id"
    ),
    "topic_changes_today.json": by_line("topic_changes", CHANGE_FIELDS, "comments_change DESC NULLS LAST, views_change DESC NULLS LAST, topic_id"),
    "top_topics_today.json": by_line(
        "top_topics", "rank topic_id topic_name videos_count total_views total_likes total_comments avg_comments_per_video", "rank"
    ),
    "top_videos_by_topic.json": array_of(
        f"""SELECT topic_rank, to_json({{'topic_id': topic_id, 'topic_name': topic_name,
  'videos': list({record("video_id sub_topic_id sub_topic_name " + VIDEO_FIELDS + " matched_source", published_at=ISO)} ORDER BY video_rank)}}) AS j
FROM ({ORACLE["top_videos_by_topic"]}) x WHERE topic_rank <= 3 GROUP BY topic_rank, topic_id, topic_name""", "topic_rank"
    ),
    "sub_topics_over_time.json": SUB_SERIES,
    "top_sub_topics_by_macro.json": array_of(
        f"""SELECT macro_topic_id, to_json({{'macro_topic_id': macro_topic_id, 'macro_topic_name': min(macro_topic_name),
  'sub_topics': list({record(SUB_FIELDS)} ORDER BY sub_topic_rank)}}) AS j FROM ({ORACLE["top_sub_topics_by_macro"]}) x GROUP BY macro_topic_id""",
        "macro_topic_id",
    ),
    "videos_by_sub_topic.json": array_of(
        f"""SELECT macro_topic_id, sub_topic_id, to_json({{'macro_topic_id': macro_topic_id, 'macro_topic_name': macro_topic_name, 'sub_topic_id': sub_topic_id,
  'sub_topic_name': sub_topic_name, 'videos': list({record("video_id " + VIDEO_FIELDS, published_at=ISO)} ORDER BY video_rank)}}) AS j
FROM ({ORACLE["videos_by_sub_topic"]}) x GROUP BY macro_topic_id, macro_topic_name, sub_topic_id, sub_topic_name""", "macro_topic_id, sub_topic_id"
    ),
    "channel_daily.json": array_of(
        f"""SELECT rank, {record("rank channel_id channel_title videos_count total_views total_likes total_comments subscriber_count avg_comments_per_video")} AS j
FROM ({LAST_CHANNELS}) x""", "rank"
    ),
}
ORACLE["export_set"] = " UNION ALL ".join(
    f"SELECT '{name}' AS document, CAST(({sql}) AS VARCHAR) AS content, CAST(2 AS BIGINT) AS copies" for name, sql in DOCUMENTS.items()
)

ORACLE["gold_backfill"] = """
WITH v AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS video_id, substr(o_orderpriority, 1, 1) || CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS kind,
         CASE WHEN o_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS macro, CAST(o_custkey % 25 AS VARCHAR) AS channel_id, o_orderkey AS k,
         [DATE '2024-01-01', DATE '2024-01-03'][1 + (o_orderkey // 6) % 2] AS run_date,
         CAST(round(o_totalprice * 100) AS BIGINT) AS views, length(o_orderstatus) AS likes, o_orderkey % 100 AS talks
  FROM orders),
c AS (
  SELECT v.run_date, v.video_id, v.kind, v.video_id || '-' || l_linenumber AS comment_id, CAST(trunc(l_quantity) AS BIGINT) AS likes,
         CASE WHEN l_returnflag <> 'R' THEN 'talk' || v.kind END AS said
  FROM lineitem JOIN v ON v.k = l_orderkey),
first AS (SELECT kind, min(video_id) AS first FROM v GROUP BY kind),
t AS (SELECT run_date, kind, macro, count(*) AS n, CAST(sum(views) AS BIGINT) AS views, CAST(sum(talks) AS BIGINT) AS talks, CAST(sum(likes) AS BIGINT) AS likes
      FROM v GROUP BY run_date, kind, macro),
best AS (SELECT run_date, kind, string_agg(said, ' | ') AS said FROM (
  SELECT *, row_number() OVER (PARTITION BY run_date, kind ORDER BY likes DESC, comment_id) AS rn FROM c WHERE said IS NOT NULL) q WHERE rn <= 5 GROUP BY run_date, kind),
talk AS (SELECT video_id, least(30, count(said)) AS n FROM c GROUP BY video_id),
doc AS (SELECT v.run_date, v.macro, v.kind,
  length('grp' || v.kind || ' grp' || v.kind || ' core' || v.kind || ' base' || v.kind || ' tail' || v.kind || 'x0 end' || v.kind || 'x0')
  + coalesce(n, 0) * (1 + length('talk' || v.kind)) AS size FROM v LEFT JOIN talk ON talk.video_id = v.video_id),
day AS (SELECT run_date, count(*) AS n, CAST(sum(talks) AS BIGINT) AS talks FROM v GROUP BY run_date),
said AS (SELECT run_date, count(DISTINCT comment_id) AS n FROM c GROUP BY run_date),
top AS (SELECT run_date, macro FROM (SELECT run_date, macro, row_number() OVER (PARTITION BY run_date ORDER BY sum(talks) DESC, macro) AS rn FROM v GROUP BY run_date, macro) q WHERE rn = 1),
channel AS (SELECT run_date, channel_id, count(*) AS n, CAST(sum(views) AS BIGINT) AS views FROM v GROUP BY run_date, channel_id),
top_channel AS (SELECT run_date, channel_id FROM (
  SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY views DESC, channel_id) AS rn FROM channel) q WHERE rn = 1)
SELECT 'text' AS kind, run_date, macro AS a, '' AS b, count(*) AS n, CAST(sum(least(size, 1200)) AS BIGINT) AS total, count(DISTINCT kind) AS change
FROM doc GROUP BY run_date, macro
UNION ALL
SELECT 'topic', run_date, macro, first, n, views, n - lag(n) OVER (PARTITION BY t.kind ORDER BY run_date) FROM t JOIN first ON first.kind = t.kind
UNION ALL SELECT 'topic', DATE '2024-01-02', 'kept', NULL, 7, NULL, NULL
UNION ALL
SELECT 'talk', t.run_date, coalesce(said, ''), first, talks, likes, 0 FROM t JOIN first ON first.kind = t.kind LEFT JOIN best ON best.kind = t.kind AND best.run_date = t.run_date
UNION ALL SELECT 'talk', DATE '2024-01-02', '', NULL, NULL, NULL, 0
UNION ALL
SELECT 'channel', run_date, channel_id, 'channel ' || channel_id, n, views, n_regionkey FROM channel LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = channel_id
UNION ALL
SELECT 'summary', day.run_date, macro, channel_id, day.n, talks, said.n FROM day JOIN top ON top.run_date = day.run_date
JOIN top_channel ON top_channel.run_date = day.run_date JOIN said ON said.run_date = day.run_date
"""

ORACLE["raw_load"] = """
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date, CAST(o_orderkey AS VARCHAR) AS video_id,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS view_count, length(o_orderstatus) AS like_count, o_orderpriority AS p FROM orders)
SELECT run_date, video_id, view_count, like_count, CASE WHEN month(run_date) % 2 = 1 THEN p END AS title,
       'view_count: bigint, string as bigint' AS conflicts, (SELECT count(DISTINCT run_date) FROM o) AS months FROM o
"""

ORACLE["silver_refresh"] = f"""
WITH {EV}, e AS (SELECT *, CASE WHEN run_date <= DATE '2024-01-15' THEN DATE '2024-01-15' ELSE DATE '2024-01-30' END AS day FROM ev),
comment AS (SELECT *, row_number() OVER (PARTITION BY video_id, event_type ORDER BY day DESC, ts DESC, props, cents) AS rn FROM e),
video AS (SELECT *, row_number() OVER (PARTITION BY day, video_id ORDER BY ts DESC, event_type, cents) AS rn FROM e),
channel AS (SELECT *, row_number() OVER (PARTITION BY day, channel_id ORDER BY ts DESC, cents) AS rn FROM e)
SELECT 'comment' AS kind, day AS run_date, video_id || '-' || event_type AS key, cents AS n, {shown('ts')} AS extracted_at FROM comment WHERE rn = 1
UNION ALL SELECT 'video', day, video_id, cents, {shown('ts')} FROM video WHERE rn = 1
UNION ALL SELECT 'channel', day, channel_id, cents, {shown('ts')} FROM channel WHERE rn = 1
"""

ORACLE["mixed_schemas"] = f"""WITH {TOPICS}
SELECT run_date, video_id, topic_id, CASE WHEN run_date < DATE '2024-01-15' THEN topic_id ELSE coalesce(raw_macro, topic_id) END AS macro_topic_id,
       upper(topic_id) AS macro_topic_name,
       CASE WHEN run_date < DATE '2024-01-15' THEN topic_id || '__general' ELSE coalesce(raw_sub, topic_id || '__general') END AS sub_topic_id,
       CASE WHEN run_date < DATE '2024-01-15' THEN topic_name ELSE coalesce(raw_sub_name, topic_name) END AS sub_topic_name, CAST(0 AS BIGINT) AS conflicts
FROM assigned"""
