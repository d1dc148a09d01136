"""DuckDB statements that give the same rows as the queries of the same name."""

from __future__ import annotations

from postsignal.functions.signals import NEGATIVE_TERMS, POSITIVE_TERMS
from postsignal.operators.tfidf import DEFAULT_TERMS
from postsignal.plans import driver_tables as tables
from postsignal.plans.queries import CUT_RULES, LIMIT, SPARSE_TERMS, STREAM_DELAY, WANTED
from postsignal.schema import COUNT_FIELDS, SourceThresholds
from postsignal.sources import runs
from postsignal.sources.articles import LOGIN_MARKERS
from postsignal.sources.jsonl import MISSING_KEY, NOT_AN_OBJECT

AS_OF = f"TIMESTAMP '{tables.AS_OF:%Y-%m-%d %H:%M:%S}'"


def _quoted(values: tuple[str, ...]) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def _normalized(value: str) -> str:
    """Normalized text. The tables hold no text that NFKC would change."""
    no_urls = f"regexp_replace(coalesce({value}, ''), 'https?://\\S+', ' ', 'g')"
    kept = f"regexp_replace({no_urls}, '[^\\p{{L}}\\p{{N}}_\\s#@%$₹.,:+\\-]', ' ', 'g')"
    return f"lower(trim(regexp_replace({kept}, '\\s+', ' ', 'g')))"


def _tags(value: str) -> str:
    found = f"regexp_extract_all({value}, '(?:^|\\s)#([^\\s#@]+)', 1)"
    return f"list_filter(list_transform({found}, lambda t: trim(t, '.,:;!?)]}}''\"')), lambda t: t <> '')"


def _mentions(value: str) -> str:
    return f"regexp_extract_all({value}, '(?:^|[^\\p{{L}}\\p{{N}}_])@([A-Za-z0-9_]+)', 1)"


def _entities(values: str) -> str:
    cleaned = f"list_transform({values}, lambda v: trim(ltrim({_normalized('v')}, '#@')))"
    return f"list_filter({cleaned}, lambda v: v <> '')"


def _tokens(value: str) -> str:
    return f"regexp_extract_all(lower({value}), '[a-zA-Z][a-zA-Z0-9_]+')"


def _count(value: str) -> str:
    bare = f"replace({value}, ',', '')"
    number = f"nullif(regexp_extract({bare}, '([0-9]+(?:\\.[0-9]+)?)([KMBkmb]?)', 1), '')"
    suffix = f"upper(regexp_extract({bare}, '([0-9]+(?:\\.[0-9]+)?)([KMBkmb]?)', 2))"
    scale = f"CASE {suffix} WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 ELSE 1.0 END"
    return f"CAST(trunc(CAST({number} AS DOUBLE) * {scale}) AS BIGINT)"


def _sentiment(tokens: str) -> str:
    def hits(lexicon: tuple[str, ...]) -> str:
        return f"len(list_distinct(list_filter({tokens}, lambda t: t IN ({_quoted(lexicon)}))))"

    return f"CAST({hits(POSITIVE_TERMS)} - {hits(NEGATIVE_TERMS)} AS DOUBLE)"


def _decay(timestamp: str, now: str) -> str:
    age = f"floor((epoch_us({now}) - epoch_us({timestamp})) / 1000000.0) / 3600.0"
    return (
        f"CASE WHEN {timestamp} IS NULL THEN 0.0 "
        f"ELSE least(1.0, exp(least(-({age}) * ln(2) / 12.0, 1.0))) END"
    )


POSTS = tables.POSTS.format(documents="documents", events="events")
BATCHES = tables.INGEST_BATCHES.format(events="events")
ARTICLES = tables.ARTICLES.format(documents="documents", events="events")
PAGES = tables.CAPTURED_PAGES.format(pages="pages")

# What the post's timestamp text stands for, from the event time it was made of.
TIMESTAMP = """CASE ingest_seq % 50
    WHEN 9 THEN NULL
    WHEN 19 THEN NULL
    WHEN 29 THEN event_ts - INTERVAL 330 MINUTE
    WHEN 49 THEN event_ts + INTERVAL 480 MINUTE
    ELSE event_ts END"""

_CLEAN_COUNTS = ", ".join(
    f"coalesce({name}, 0)::BIGINT AS {name}" for name in COUNT_FIELDS
)
WITH_POSTS = f"WITH posts AS ({POSTS})"
WITH_CLEAN = f"""{WITH_POSTS},
clean AS (
    SELECT ingest_seq, tweet_id, {_normalized('username')} AS username, display_name,
           {TIMESTAMP} AS timestamp, content, {_normalized('content')} AS content_clean,
           {_entities(_tags('content'))} AS hashtags_norm,
           {_entities(_mentions('content'))} AS mentions_norm,
           {_CLEAN_COUNTS}, url
    FROM posts)"""
WITH_DEDUPED = f"""{WITH_CLEAN},
deduped AS (
    SELECT * FROM clean
    QUALIFY row_number() OVER (
        PARTITION BY coalesce(nullif(tweet_id, ''), content_clean, 'None') ORDER BY ingest_seq) = 1)"""


def _with_signals(source: str) -> str:
    return f"""measured AS (
    SELECT *, reply_count + retweet_count * 2 + like_count + ln(view_count + 1) * 0.25
                  AS engagement_score,
           {_sentiment(_tokens('content_clean'))} AS lexical_sentiment,
           {_decay('timestamp', AS_OF)} AS recency_decay
    FROM {source}),
signals AS (
    SELECT *, lexical_sentiment * ln(1 + engagement_score) * recency_decay AS composite_signal
    FROM measured)"""


WITH_SIGNALS = f"{WITH_DEDUPED}, {_with_signals('deduped')}"
WITH_ALL_SIGNALS = f"{WITH_CLEAN}, {_with_signals('clean')}"

WITH_VOCABULARY = f"""{WITH_DEDUPED},
words AS (
    SELECT ingest_seq, {_tokens('content_clean')} AS tokens FROM deduped),
occurrences AS (
    SELECT ingest_seq, unnest(tokens) AS term, unnest(range(len(tokens))) AS place FROM words),
terms AS (
    SELECT term, count(*) AS corpus_count, count(DISTINCT ingest_seq) AS document_count,
           min(ingest_seq * 10000000 + place) AS first_place
    FROM occurrences GROUP BY term),
vocabulary AS (
    SELECT *, (SELECT greatest(count(*), 1) FROM deduped) AS corpus_size,
           row_number() OVER (ORDER BY corpus_count DESC, first_place) AS rank
    FROM terms ORDER BY corpus_count DESC, first_place LIMIT {DEFAULT_TERMS}),
weighted AS (
    SELECT *, ln((1 + corpus_size) / (1 + document_count)) + 1 AS idf FROM vocabulary),
scores AS (
    SELECT o.ingest_seq, o.term, v.rank, v.idf, count(*) / any_value(len(w.tokens)) AS tf
    FROM occurrences o JOIN weighted v ON v.term = o.term
    JOIN words w ON w.ingest_seq = o.ingest_seq
    GROUP BY o.ingest_seq, o.term, v.rank, v.idf)"""


def _scored_live() -> str:
    """``posts`` of the live run, cleaned, deduplicated and scored, with their run."""
    cleaned = WITH_CLEAN.split("clean AS (")[1].replace("SELECT ingest_seq,", "SELECT ingest_seq, source_name, run_id,", 1)
    deduped = WITH_DEDUPED.split("deduped AS (")[1]
    return f"{WITH_LIVE}, clean AS ({cleaned}, deduped AS ({deduped}, {_with_signals('deduped')}"


def _buckets(start: str, source: str = WITH_SIGNALS, having: str = "") -> str:
    return f"""{source}
SELECT {start} AS timestamp, count(*) AS tweet_count,
       round(avg(engagement_score), 6) AS engagement_score_mean,
       round(avg(composite_signal), 6) AS composite_signal_mean,
       round(coalesce(sum(composite_signal), 0), 6) AS composite_signal_sum,
       round(stddev_samp(composite_signal), 6) AS composite_signal_std,
       round(avg(recency_decay), 6) AS recency_decay_mean,
       round(avg(lexical_sentiment), 6) AS lexical_sentiment_mean
FROM signals WHERE timestamp IS NOT NULL GROUP BY 1 {having}"""


RUN_STATUS = f"""WITH posts AS ({POSTS}),
runs AS ({tables.SOURCE_RUNS.format(posts='posts')}),
classified AS (
    SELECT source_name, run_id, started_at, ended_at,
           CASE WHEN degraded_before_start THEN 0 ELSE n_records END AS n_records,
           CASE WHEN coalesce(degraded_before_start, false) THEN 'THROTTLED'
                WHEN error_kind = 'rate_limited' THEN 'THROTTLED'
                WHEN error_kind = 'login_wall' THEN 'LOGIN_REQUIRED'
                WHEN error_kind IS NOT NULL THEN 'FAILED'
                WHEN n_records = 0 AND raw_status IN ('SUCCESS', 'PARTIAL') THEN 'THROTTLED'
                WHEN raw_status = 'SUCCESS' AND n_records < row_limit THEN 'PARTIAL'
                ELSE raw_status END AS status,
           CASE WHEN coalesce(degraded_before_start, false) THEN '{runs.ALREADY_DEGRADED}'
                WHEN error_kind IS NOT NULL THEN error_message
                WHEN n_records = 0 THEN coalesce(error_message, '{runs.NO_RECORDS}')
                WHEN raw_status = 'SUCCESS' AND n_records < row_limit
                    THEN coalesce(error_message, '{runs.TOO_FEW_RECORDS}')
                ELSE error_message END AS error_message
    FROM runs)"""

_LIMITS = SourceThresholds()
WITH_HEALTH = f"""WITH batches AS ({BATCHES}),
running AS (
    SELECT *, count(*) OVER w AS total_batches,
           CAST(sum(new_records) OVER w AS BIGINT) AS total_collected,
           CAST(sum(duplicates) OVER w AS BIGINT) AS total_duplicates,
           avg(new_records) OVER (PARTITION BY source_name, run_id ORDER BY batch_seq
                                  ROWS {_LIMITS.rolling_batches - 1} PRECEDING) AS new_per_batch,
           min(batch_at) OVER (PARTITION BY source_name, run_id) AS run_started_at,
           count(*) OVER (PARTITION BY source_name, run_id) AS run_batches,
           sum(CASE WHEN new_records > 0 THEN 1 ELSE 0 END) OVER w AS island
    FROM batches
    WINDOW w AS (PARTITION BY source_name, run_id ORDER BY batch_seq)),
measured AS (
    SELECT *,
           CAST(sum(CASE WHEN new_records = 0 THEN 1 ELSE 0 END) OVER (
               PARTITION BY source_name, run_id, island ORDER BY batch_seq) AS BIGINT) AS empty_run,
           total_collected / (greatest((epoch_us(batch_at) - epoch_us(run_started_at)) / 1000000.0, 1.0)
                              / 60.0) AS records_per_minute,
           CASE WHEN total_collected + total_duplicates = 0 THEN 0.0
                ELSE total_duplicates / (total_collected + total_duplicates) END AS duplicate_ratio
    FROM running),
health AS (
    SELECT *, empty_run >= {_LIMITS.max_empty_run}
              OR (duplicate_ratio > {_LIMITS.max_duplicate_ratio} AND total_duplicates > 0)
              OR (total_batches >= {_LIMITS.rolling_batches}
                  AND records_per_minute < {_LIMITS.min_records_per_minute}) AS degraded
    FROM measured)"""

_RULES = CUT_RULES
_CUT = _RULES.thresholds


def _cut(batches: str, runs_: str) -> str:
    """Relations from ``batches`` and ``capture_runs`` to ``through`` (the batches that count) and ``cut`` (a row per run)."""
    return f"""batches AS MATERIALIZED ({batches}),
capture_runs AS MATERIALIZED ({runs_}),
numbered_batches AS (
    SELECT b.*, r.row_limit, r.started_at, r.degraded_before_start OR coalesce(r.row_limit < 1, false) AS skipped,
           count(*) OVER w AS total_batches, CAST(sum(b.new_records) OVER w AS BIGINT) AS total_collected,
           CAST(sum(b.duplicates) OVER w AS BIGINT) AS total_duplicates,
           sum(CASE WHEN b.new_records > 0 THEN 1 ELSE 0 END) OVER w AS island
    FROM batches b JOIN capture_runs r USING (source_name, run_id)
    WINDOW w AS (PARTITION BY source_name, run_id ORDER BY batch_seq)),
told AS (
    SELECT *, sum(CASE WHEN new_records = 0 THEN 1 ELSE 0 END) OVER (
                  PARTITION BY source_name, run_id, island ORDER BY batch_seq) AS empty_run,
           (epoch_us(batch_at) - epoch_us(started_at)) / 1000000.0 AS elapsed,
           total_duplicates / greatest(total_collected + total_duplicates, 1) AS ratio FROM numbered_batches),
flagged AS (
    SELECT *, empty_run >= {_CUT.max_empty_run} OR (ratio > {_CUT.max_duplicate_ratio} AND total_duplicates > 0)
              OR (total_batches >= {_CUT.rolling_batches}
                  AND total_collected / (greatest(elapsed, 1.0) / 60.0) < {_CUT.min_records_per_minute}) AS degraded FROM told),
tried AS (
    SELECT *, sum(CASE WHEN degraded THEN 1 ELSE 0 END) OVER (PARTITION BY source_name, run_id ORDER BY batch_seq) AS times FROM flagged),
stops AS (
    SELECT source_name, run_id, min({{'at': batch_seq, 'why': CASE WHEN elapsed >= {_RULES.timeout_seconds} THEN 0 WHEN login_wall THEN 1
               WHEN total_collected >= row_limit THEN 2 ELSE 3 END}}) AS stop
    FROM tried WHERE elapsed >= {_RULES.timeout_seconds} OR login_wall OR coalesce(total_collected >= row_limit, false)
                     OR (degraded AND times > {_RULES.max_retries}) GROUP BY source_name, run_id),
through AS (
    SELECT t.*, t.batch_seq AS seq FROM tried t LEFT JOIN stops s USING (source_name, run_id)
    WHERE NOT t.skipped AND (s.stop IS NULL OR t.batch_seq < s.stop.at OR (t.batch_seq = s.stop.at AND s.stop.why >= 2))),
ended AS (
    SELECT source_name, run_id, max(seq) AS last_batch, max(total_batches) AS total_batches, max(total_collected) AS collected,
           max(total_duplicates) AS duplicates, max(batch_at) AS last_at FROM through GROUP BY source_name, run_id),
found AS (
    SELECT r.*, least(coalesce(e.collected, 0), CASE WHEN r.row_limit IS NOT NULL THEN greatest(r.row_limit, 0) END) AS had, coalesce(e.duplicates, 0) AS total_duplicates,
           coalesce(e.total_batches, 0) AS total_batches, e.last_batch, e.last_at, CASE WHEN r.row_limit < 1 THEN 2 ELSE s.stop.why END AS why
    FROM capture_runs r LEFT JOIN ended e USING (source_name, run_id) LEFT JOIN stops s USING (source_name, run_id)),
cut AS (
    SELECT source_name, run_id, row_limit, started_at, total_duplicates, total_batches, last_batch,
           CASE why WHEN 0 THEN 'time_up' WHEN 1 THEN 'login_wall' WHEN 2 THEN 'full' WHEN 3 THEN 'throttled' ELSE 'no_more_batches' END AS stop_reason,
           CASE WHEN degraded_before_start THEN 0 ELSE had END AS n_records, coalesce(last_at, started_at) AS ended_at,
           round(had_ratio, 6) AS duplicate_ratio, round(coalesce(had / (greatest((epoch_us(last_at) - epoch_us(started_at)) / 1000000.0, 1.0) / 60.0), 0.0), 6)
               AS records_per_minute,
           CASE WHEN degraded_before_start OR why = 3 THEN 'THROTTLED' WHEN why = 1 THEN 'LOGIN_REQUIRED'
                WHEN why IS NULL AND error_kind IS NOT NULL THEN 'FAILED' WHEN had = 0 THEN 'THROTTLED'
                WHEN had < row_limit THEN 'PARTIAL' ELSE 'SUCCESS' END AS status,
           CASE WHEN degraded_before_start THEN '{runs.ALREADY_DEGRADED}' WHEN why = 3 THEN '{runs.RETRIES_EXHAUSTED}'
                WHEN why = 1 THEN '{runs.LOGIN_WALL}' WHEN why IS NULL AND error_kind IS NOT NULL THEN error_message
                WHEN had = 0 THEN '{runs.NO_RECORDS}' WHEN had < row_limit THEN '{runs.TOO_FEW_RECORDS}' END AS error_message
    FROM (SELECT *, CASE WHEN had + total_duplicates = 0 THEN 0.0 ELSE total_duplicates / (had + total_duplicates) END AS had_ratio FROM found))"""


_EVENT_CUT = _cut(tables.RUN_BATCHES.format(events="events"), tables.CAPTURE_RUNS.format(batches="batches"))
_LIVE_CUT = _cut(
    """SELECT c.*, coalesce(n.new_records, 0) AS new_records, coalesce(n.duplicates, 0) AS duplicates FROM captures c
       LEFT JOIN (SELECT source_name, run_id, batch_seq, CAST(sum(CASE WHEN is_new THEN 1 ELSE 0 END) AS BIGINT) AS new_records,
                         CAST(sum(CASE WHEN is_new THEN 0 ELSE 1 END) AS BIGINT) AS duplicates FROM seen GROUP BY ALL) n
       USING (source_name, run_id, batch_seq)""",
    tables.CAPTURE_RUNS.format(batches="captures"),
)
WITH_LIVE = f"""WITH all_posts AS MATERIALIZED ({POSTS}),
live_posts AS ({tables.LIVE_POSTS.format(posts='all_posts')}),
captures AS MATERIALIZED ({tables.CAPTURES.format(posts='live_posts')}),
seen AS (SELECT *, row_number() OVER (PARTITION BY source_name, run_id, tweet_id ORDER BY batch_seq, ingest_seq) = 1 AS is_new
         FROM live_posts WHERE coalesce(tweet_id, '') <> '' AND coalesce(content, '') <> ''),
{_LIVE_CUT},
taken AS (
    SELECT * FROM (SELECT p.* EXCLUDE (is_new, batch_seq), c.row_limit, row_number() OVER (PARTITION BY p.source_name, p.run_id ORDER BY p.batch_seq, p.ingest_seq) AS n
                   FROM seen p JOIN through t USING (source_name, run_id, batch_seq)
                   JOIN cut c USING (source_name, run_id) WHERE p.is_new)
    WHERE row_limit IS NULL OR n <= row_limit),
replaced AS (SELECT * FROM cut WHERE status IN ('THROTTLED', 'LOGIN_REQUIRED', 'FAILED')),
posts AS MATERIALIZED (
    SELECT * EXCLUDE (row_limit, n) FROM taken ANTI JOIN replaced USING (source_name, run_id)
    UNION ALL BY NAME
    SELECT * REPLACE ('fallback-' || ingest_seq AS tweet_id) FROM all_posts SEMI JOIN replaced USING (source_name, run_id) WHERE ingest_seq % 3 <> 1)"""
_JSON_FIELDS = ", ".join(
    [f"'{name}': {name}" for name in ("tweet_id", "username", "display_name", "timestamp", "content")]
    + [f"'hashtags': {_tags('content')}", f"'mentions': {_mentions('content')}"]
    + [f"'{name}': {name}" for name in (*COUNT_FIELDS, "url")]
)

_NEW_PER_BATCH = """
placed AS (
    SELECT {run} date_trunc('hour', event_ts)::TIMESTAMP AS batch_at, ingest_seq, tweet_id FROM posts
    WHERE coalesce(tweet_id, '') <> '' AND coalesce(content, '') <> ''),
marked AS (
    SELECT *, row_number() OVER (PARTITION BY {run} tweet_id ORDER BY batch_at, ingest_seq) = 1 AS is_new
    FROM placed)"""


def _deduped_by_batch(run: str, limit: int | None) -> str:
    parts = _NEW_PER_BATCH.format(run=run)
    keep = ""
    if limit is not None:
        partition = f"PARTITION BY {run.rstrip(', ')}" if run else ""
        parts += f""",
numbered AS (
    SELECT *, sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER (
        {partition} ORDER BY batch_at, ingest_seq ROWS UNBOUNDED PRECEDING) AS news FROM marked)"""
        keep = f"WHERE news < {limit} OR (news = {limit} AND is_new)"
    source = "numbered" if limit is not None else "marked"
    return f"""{WITH_POSTS}, {parts}
SELECT {run} batch_at, CAST(sum(CASE WHEN is_new THEN 1 ELSE 0 END) AS BIGINT) AS new_records,
       CAST(sum(CASE WHEN is_new THEN 0 ELSE 1 END) AS BIGINT) AS duplicates
FROM {source} {keep} GROUP BY {run} batch_at"""


def oracle_sql() -> dict[str, str]:
    record_key = (
        f"sha256(coalesce(nullif(tweet_id, ''), "
        f"{_normalized('username')} || ':' || {_normalized('content')}))"
    )
    ranks = ", ".join(
        f"round(coalesce(max(CASE WHEN s.rank = {i} THEN s.tf * s.idf END), 0.0), 6) AS tfidf_rank_{i}"
        for i in range(1, DEFAULT_TERMS + 1)
    )
    markers = " OR ".join(f"contains(lower(page_text), {_quoted((m,))})" for m in LOGIN_MARKERS)
    article_url = (
        "CASE WHEN contains(href, '/status/') THEN split_part(href, '?', 1) END"
    )
    articles = f"WITH articles AS ({ARTICLES})"
    first_line = "nullif(trim(split_part(trim(body_text, ' ' || chr(10)), chr(10), 1)), '')"
    reply = f"coalesce({_count('reply_label')}, {_count('reply_text')}"
    live = _scored_live()
    loose = (
        f"{RUN_STATUS}, loose AS (SELECT * REPLACE (CASE WHEN ingest_seq % 41 <> 7 THEN run_id END AS run_id) FROM posts), "
        "known AS (SELECT * FROM classified WHERE source_name <> 'feed_1' OR run_id <> 'run_0')"
    )
    arriving = (
        f"WITH all_posts AS (SELECT * FROM ({POSTS}) WHERE ingest_seq % 10 NOT IN (3, 4)), "
        "posts AS (SELECT * FROM all_posts WHERE ingest_seq % 23 NOT IN (1, 2, 3, 5, 7))"
        f"{WITH_CLEAN.removeprefix(WITH_POSTS)}, arrived AS (SELECT *, ingest_seq % 3 AS batch_id FROM clean)"
    )
    return {
        "normalize_text": f"{WITH_CLEAN} SELECT ingest_seq, content_clean FROM clean",
        "normalize_entities": f"""{WITH_CLEAN}
SELECT ingest_seq, array_to_string(hashtags_norm, '|') AS hashtags_norm,
       array_to_string(mentions_norm, '|') AS mentions_norm FROM clean""",
        "parse_timestamp": f"{WITH_POSTS} SELECT ingest_seq, {TIMESTAMP} AS timestamp FROM posts",
        "safe_int": f"""{WITH_POSTS}
SELECT ingest_seq, CAST(CASE WHEN ingest_seq % 5 < 3 THEN view_count ELSE 0 END AS BIGINT) AS count
FROM posts""",
        "parse_count": f"""{articles}
SELECT ingest_seq, coalesce({_count('like_text')}, -1) AS like_count,
       coalesce({_count('view_text')}, -1) AS view_count FROM articles""",
        "first_count": f"""{articles}
SELECT ingest_seq, {reply}, {_count('view_text')}) AS count FROM articles""",
        "extract_hashtags": f"""{WITH_POSTS}
SELECT ingest_seq, array_to_string({_tags('content')}, '|') AS hashtags FROM posts""",
        "extract_mentions": f"""{WITH_POSTS}
SELECT ingest_seq, array_to_string({_mentions('content')}, '|') AS mentions FROM posts""",
        "url_fields": f"""{WITH_POSTS}
SELECT ingest_seq, split_part(url, '?', 1) AS bare_url,
       regexp_extract(url, '/status/([0-9]+)', 1) AS post_id,
       regexp_extract(url, '^https://[^/]+/([^/?#]+)/', 1) AS url_username FROM posts""",
        "display_name": f"{articles} SELECT ingest_seq, {first_line} AS display_name FROM articles",
        "dedupe_key": f"""{WITH_CLEAN}
SELECT c.ingest_seq, r.record_key,
       sha256(coalesce(nullif(c.tweet_id, ''), c.content_clean, 'None')) AS cleaned_key
FROM clean c JOIN (SELECT ingest_seq, {record_key} AS record_key FROM posts) r
  ON r.ingest_seq = c.ingest_seq""",
        "tokens": f"""{WITH_POSTS}
SELECT ingest_seq, CAST(len({_tokens('content')}) AS INTEGER) AS n_tokens,
       array_to_string({_tokens('content')}, ' ') AS tokens FROM posts""",
        "sentiment": f"{WITH_ALL_SIGNALS} SELECT ingest_seq, lexical_sentiment FROM signals",
        "engagement": f"""{WITH_ALL_SIGNALS}
SELECT ingest_seq, round(engagement_score, 6) AS engagement_score FROM signals""",
        "recency_decay": f"""{WITH_CLEAN}
SELECT ingest_seq, round({_decay('timestamp', AS_OF)}, 6) AS recency_decay,
       round({_decay('timestamp', "(date_trunc('day', timestamp) + INTERVAL 1 DAY)")}, 6) AS decay_in_day
FROM clean""",
        "composite_signal": f"""{WITH_ALL_SIGNALS}
SELECT ingest_seq, round(composite_signal, 6) AS composite_signal FROM signals""",
        "search_url": """SELECT doc_id,
       'https://x.com/search?q=' || url_encode(text) || '&src=typed_query&f=live' AS search_url
FROM documents""",
        "clean": f"""{WITH_CLEAN}
SELECT * REPLACE (array_to_string(hashtags_norm, '|') AS hashtags_norm,
                  array_to_string(mentions_norm, '|') AS mentions_norm),
       'batch_feed' AS source_name, 'SUCCESS' AS collector_status,
       {AS_OF} AS collected_started_at, {AS_OF} AS collected_ended_at FROM clean""",
        "clean_where": f"""{WITH_CLEAN}
SELECT c.ingest_seq, c.timestamp, p.source_name, c.view_count, c.content_clean FROM clean c JOIN posts p USING (ingest_seq)
WHERE c.timestamp >= TIMESTAMP '{WANTED.since}' AND c.timestamp < TIMESTAMP '{WANTED.until}' AND p.source_name IN ({_quoted(WANTED.source_names)})
      AND c.view_count >= {WANTED.least['view_count']} AND contains(c.content_clean, '{WANTED.words[0]}')""",
        "normalize_nfkc": f"""{WITH_POSTS}
SELECT ingest_seq, {_normalized("'final RALLY VIII 1 2 kg café #tag ' || content")} AS content_clean FROM posts""",
        "tfidf_sparse": f"""{WITH_VOCABULARY.replace(f"LIMIT {DEFAULT_TERMS}", f"LIMIT {SPARSE_TERMS}")}
SELECT ingest_seq, CAST(rank - 1 AS BIGINT) AS index, round(tf * idf, 6) AS tfidf FROM scores""",
        "required_filter": f"""{WITH_POSTS}
SELECT ingest_seq, tweet_id, content FROM posts
WHERE coalesce(tweet_id, '') <> '' AND coalesce(content, '') <> ''""",
        "marker_pages": f"WITH p AS ({PAGES}) SELECT page_id, {markers} AS login_wall FROM p",
        "status_links": f"""WITH p AS ({PAGES})
SELECT page_id, split_part(list_filter(regexp_extract_all(html || extra_link, 'href="([^"]*)"', 1),
                                       lambda h: contains(h, '/status/'))[1], '?', 1) AS status_url
FROM p""",
        "extract_posts": f"""{articles},
found AS (
    SELECT *, {article_url} AS bare_url, trim(text, ' ' || chr(10)) AS body FROM articles)
SELECT ingest_seq, regexp_extract(bare_url, '/status/([0-9]+)', 1) AS tweet_id,
       regexp_extract(bare_url, '^https://[^/]+/([^/?#]+)/', 1) AS username,
       {first_line} AS display_name, datetime AS timestamp, body AS content,
       array_to_string({_tags('body')}, '|') AS hashtags,
       array_to_string({_mentions('body')}, '|') AS mentions,
       {reply}, -1) AS reply_count, CAST(-1 AS BIGINT) AS retweet_count,
       coalesce({_count('like_text')}, -1) AS like_count,
       coalesce({_count('view_text')}, -1) AS view_count,
       CAST(-1 AS BIGINT) AS follower_count, CAST(-1 AS BIGINT) AS following_count,
       bare_url AS url
FROM found WHERE bare_url IS NOT NULL AND body <> ''""",
        "jsonl_posts": f"""{WITH_POSTS}
SELECT ingest_seq, tweet_id, username, display_name, timestamp, content,
       array_to_string({_tags('content')}, '|') AS hashtags,
       array_to_string({_mentions('content')}, '|') AS mentions,
       CASE WHEN ingest_seq % 23 = 7 THEN 'NaN' ELSE CAST(reply_count AS VARCHAR) END AS reply_count,
       {", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in COUNT_FIELDS if name != "reply_count")}, url
FROM posts WHERE ingest_seq % 23 NOT IN (1, 2, 3, 5)""",
        "jsonl_rejects": f"""{WITH_POSTS}
SELECT ingest_seq, CASE WHEN ingest_seq % 23 = 2 THEN '{MISSING_KEY}: content'
                        ELSE '{NOT_AN_OBJECT}' END AS reason
FROM posts WHERE ingest_seq % 23 IN (1, 2, 3, 5)""",
        "limit_posts": f"""{WITH_POSTS}
SELECT ingest_seq, tweet_id, content FROM posts ORDER BY ingest_seq LIMIT {LIMIT}""",
        "limit_posts_by_cutoff": f"""{WITH_POSTS}
SELECT ingest_seq, tweet_id, content, (ingest_seq - 300) * 9000000000001 + ingest_seq % 7 AS order_value
FROM posts WHERE ingest_seq % 11 <> 4 ORDER BY order_value LIMIT {LIMIT // 5}""",
        "run_status": f"""{RUN_STATUS}
SELECT source_name, run_id, n_records, status, error_message FROM classified""",
        "envelope": f"""{loose}
SELECT p.source_name, p.run_id, ingest_seq, tweet_id, status AS collector_status,
       started_at AS collected_started_at, ended_at AS collected_ended_at
FROM loose p LEFT JOIN known k ON p.source_name = k.source_name AND p.run_id = k.run_id""",
        "fallback_select": f"""{loose}
SELECT p.source_name, p.run_id, ingest_seq,
       CASE WHEN status IN ('THROTTLED', 'LOGIN_REQUIRED', 'FAILED') THEN 'fallback-' || ingest_seq ELSE tweet_id END AS tweet_id, content
FROM loose p LEFT JOIN known k ON p.source_name = k.source_name AND p.run_id = k.run_id""",
        "post_json": f"""{WITH_POSTS}
SELECT ingest_seq, CAST(to_json({{{_JSON_FIELDS}}}) AS VARCHAR) AS document FROM posts""",
        "run_json": f"""{RUN_STATUS}
SELECT source_name, run_id, CAST(to_json({{
    'status': status, 'started_at': strftime(started_at, '%Y-%m-%dT%H:%M:%S.%fZ'),
    'ended_at': strftime(ended_at, '%Y-%m-%dT%H:%M:%S.%fZ'), 'error_message': error_message,
    'source_name': source_name, 'n_records': n_records}}) AS VARCHAR) AS document
FROM classified""",
        "dedupe_posts": f"""{WITH_DEDUPED}
SELECT ingest_seq, tweet_id, username, content_clean, timestamp FROM deduped""",
        "dedupe_incremental": f"""{WITH_POSTS},
keyed AS (SELECT ingest_seq, source_name, {record_key} AS dedupe_key FROM posts)
SELECT min(ingest_seq) AS ingest_seq, dedupe_key FROM keyed GROUP BY dedupe_key
HAVING count(*) FILTER (WHERE source_name = 'feed_0') = 0""",
        "dedupe_batches": _deduped_by_batch("", None),
        "dedupe_batches_limited": _deduped_by_batch("source_name, run_id,", 20),
        "vocabulary": f"""{WITH_VOCABULARY}
SELECT term, corpus_count, document_count, corpus_size, round(idf, 6) AS idf FROM weighted""",
        "tfidf_long": f"""{WITH_VOCABULARY}
SELECT ingest_seq, term, round(tf, 6) AS tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf
FROM scores""",
        "tfidf_wide": f"""{WITH_VOCABULARY}
SELECT w.ingest_seq, {ranks}
FROM words w LEFT JOIN scores s ON s.ingest_seq = w.ingest_seq GROUP BY w.ingest_seq""",
        "post_features": f"""{WITH_VOCABULARY}, {_with_signals('deduped')},
totals AS (SELECT ingest_seq, {ranks} FROM scores s GROUP BY ingest_seq)
SELECT ingest_seq, tweet_id, timestamp, round(engagement_score, 6) AS engagement_score,
       lexical_sentiment, round(recency_decay, 6) AS recency_decay,
       round(composite_signal, 6) AS composite_signal,
       {", ".join(f"coalesce(tfidf_rank_{i}, 0.0) AS tfidf_rank_{i}" for i in range(1, DEFAULT_TERMS + 1))}
FROM signals LEFT JOIN totals USING (ingest_seq)""",
        "signal_buckets": _buckets("date_trunc('hour', timestamp)::TIMESTAMP"),
        "signal_buckets_90m": _buckets(
            "time_bucket(INTERVAL 90 MINUTE, timestamp, TIMESTAMP '1970-01-01')"
        ),
        "signal_buckets_weekly": _buckets("date_trunc('week', timestamp)::TIMESTAMP"),
        "signal_buckets_monthly": _buckets("date_trunc('month', timestamp)::TIMESTAMP"),
        "undated_posts": f"""{WITH_CLEAN}
SELECT count(*) FILTER (WHERE timestamp IS NULL) AS undated_posts FROM clean""",
        "signal_series": f"""{WITH_SIGNALS}
SELECT date_trunc('hour', timestamp)::TIMESTAMP AS timestamp,
       round(avg(composite_signal), 6) AS composite_signal_mean
FROM signals WHERE timestamp IS NOT NULL GROUP BY 1""",
        "stream_signal_buckets": _buckets(
            "date_trunc('hour', timestamp)::TIMESTAMP",
            WITH_ALL_SIGNALS,
            "HAVING date_trunc('hour', timestamp) + INTERVAL 1 HOUR <= "
            f"(SELECT max(timestamp) FROM signals) - INTERVAL {STREAM_DELAY.upper()}",
        ),
        "file_posts": f"""{WITH_POSTS}
SELECT tweet_id, username, content, CAST(like_count AS VARCHAR) AS like_count, url,
       'sample_jsonl' AS source_name, 'SUCCESS' AS collector_status FROM posts""",
        "file_runs": f"""{WITH_POSTS}
SELECT 'good' AS source_name, 'SUCCESS' AS status, count(*) AS n_records FROM posts
UNION ALL SELECT 'good', 'SUCCESS', count(*) FROM posts
UNION ALL SELECT 'strict', 'FAILED', 0
UNION ALL SELECT 'quarantine', 'SUCCESS', count(*) FROM posts WHERE ingest_seq % 23 NOT IN (1, 2, 3, 5, 7)""",
        "batch_run": _buckets("date_trunc('hour', timestamp)::TIMESTAMP"),
        "snapshot": f"""{WITH_HEALTH}
, posts AS ({POSTS}), sizes AS (SELECT source_name, run_id, count(*) AS n FROM posts GROUP BY ALL)
SELECT coalesce(n, 0) AS tweet_count, source_name, run_id, total_collected, total_duplicates, total_batches, empty_run, degraded
FROM health LEFT JOIN sizes USING (source_name, run_id) WHERE total_batches = run_batches""",
        "run_cut": f"""WITH {_EVENT_CUT}
SELECT source_name, run_id, status, error_message, stop_reason, n_records, total_duplicates, total_batches, last_batch,
       ended_at, duplicate_ratio, records_per_minute FROM cut""",
        "run_cut_batches": f"""WITH {_EVENT_CUT}
SELECT source_name, run_id, batch_seq, new_records, duplicates FROM through""",
        "live_run": f"""{live}
SELECT s.ingest_seq, s.tweet_id, s.source_name, s.run_id, c.status AS collector_status, round(engagement_score, 6) AS engagement_score,
       lexical_sentiment, round(composite_signal, 6) AS composite_signal
FROM signals s JOIN cut c USING (source_name, run_id)""",
        "run_ledger": f"""{live}
SELECT 'snapshot_posts' AS name, count(*) AS n FROM taken UNION ALL SELECT 'snapshot_runs', count(*) FROM cut
UNION ALL SELECT 'posts_clean', count(*) FROM deduped UNION ALL SELECT 'tweets_features', count(*) FROM signals
UNION ALL SELECT 'undated', count(*) FROM signals WHERE timestamp IS NULL UNION ALL SELECT status, count(*) FROM cut GROUP BY status""",
        "file_order": f"""{WITH_DEDUPED}
SELECT row_number() OVER (ORDER BY ingest_seq) - 1 AS ingest_seq, tweet_id, content_clean
FROM (SELECT p.ingest_seq, d.tweet_id, d.content_clean, d.ingest_seq IS NOT NULL AS kept
      FROM posts p LEFT JOIN deduped d USING (ingest_seq)) QUALIFY kept""",
        "stream_dedupe": f"""{WITH_CLEAN}
SELECT DISTINCT sha256(coalesce(nullif(tweet_id, ''), content_clean, 'None')) AS dedupe_key
FROM clean""",
        "stream_scores": f"""{WITH_VOCABULARY},
all_words AS (SELECT ingest_seq, {_tokens('content_clean')} AS tokens FROM clean),
all_terms AS (SELECT ingest_seq, unnest(tokens) AS term FROM all_words),
totals AS (
    SELECT t.ingest_seq, sum(v.idf) AS weight FROM all_terms t JOIN weighted v ON v.term = t.term
    GROUP BY t.ingest_seq)
SELECT c.ingest_seq,
       round(reply_count + retweet_count * 2 + like_count + ln(view_count + 1) * 0.25, 6)
           AS engagement_score,
       round(coalesce(t.weight / len(w.tokens), 0.0), 6) AS tfidf_total
FROM clean c JOIN all_words w ON w.ingest_seq = c.ingest_seq
LEFT JOIN totals t ON t.ingest_seq = c.ingest_seq""",
        "stream_ingest": f"""{WITH_POSTS},
keyed AS (SELECT *, row_number() OVER (PARTITION BY {record_key} ORDER BY ingest_seq) AS place FROM posts)
SELECT source_name, run_id, CAST(0 AS BIGINT) AS batch_seq,
       count(*) FILTER (WHERE place = 1) AS new_records,
       count(*) FILTER (WHERE place > 1) AS duplicates FROM keyed GROUP BY source_name, run_id""",
        "stream_ingest_batches": f"""{WITH_POSTS},
keyed AS (SELECT *, row_number() OVER (PARTITION BY {record_key} ORDER BY ingest_seq % 3, ingest_seq) AS place FROM posts)
SELECT source_name, run_id, CAST(ingest_seq % 3 AS BIGINT) AS batch_seq,
       count(*) FILTER (WHERE place = 1) AS new_records,
       count(*) FILTER (WHERE place > 1) AS duplicates FROM keyed GROUP BY ALL""",
        "stream_dedupe_batches": f"""{WITH_POSTS},
keyed AS (SELECT ingest_seq, {record_key} AS dedupe_key FROM posts)
SELECT ingest_seq, dedupe_key, CAST(ingest_seq % 3 AS BIGINT) AS batch_id FROM keyed
QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY ingest_seq % 3, ingest_seq) = 1""",
        "stream_rejects": f"""{arriving}, firsts AS (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY batch_id) = 1 AS fresh FROM arrived),
marks AS (SELECT b.batch_id, max(f.timestamp) - INTERVAL '5 days' AS mark FROM range(3) b(batch_id) LEFT JOIN firsts f
          ON f.batch_id < b.batch_id AND f.fresh GROUP BY b.batch_id),
kinds AS (SELECT batch_id, CASE WHEN NOT fresh THEN 'duplicates' WHEN coalesce(timestamp < mark, false) THEN 'late' ELSE 'posts' END AS kind
          FROM firsts JOIN marks USING (batch_id)
          UNION ALL SELECT ingest_seq % 3, 'rejects' FROM all_posts WHERE ingest_seq % 23 IN (1, 2, 3, 5, 7)),
counted AS (SELECT batch_id, kind, count(*) AS n FROM kinds GROUP BY ALL)
SELECT CAST(b AS BIGINT) AS batch_id, k AS kind, coalesce(n, 0) AS n FROM range(3) t(b) CROSS JOIN (VALUES ('duplicates')) v(k)
LEFT JOIN counted c ON c.batch_id = b AND c.kind = k
UNION ALL SELECT CAST(batch_id AS BIGINT), kind, n FROM counted WHERE kind <> 'duplicates'""",
        "stream_live_buckets": _buckets(
            "date_trunc('hour', timestamp)",
            f"""{arriving}, deduped AS (SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY batch_id) = 1),
            {_with_signals('deduped')}""",
        ),
        "source_health": f"""{WITH_HEALTH}
SELECT source_name, run_id, batch_seq, batch_at, total_batches, total_collected, total_duplicates,
       empty_run, round(records_per_minute, 6) AS records_per_minute,
       round(new_per_batch, 6) AS new_per_batch, round(duplicate_ratio, 6) AS duplicate_ratio, degraded
FROM health""",
        "run_metrics": f"""{WITH_HEALTH}
SELECT source_name, run_id, total_collected, total_duplicates, total_batches, empty_run,
       round(records_per_minute, 6) AS records_per_minute, round(new_per_batch, 6) AS new_per_batch,
       round(duplicate_ratio, 6) AS duplicate_ratio, degraded
FROM health WHERE total_batches = run_batches""",
    }
