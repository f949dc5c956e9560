"""Expected results of the catalog queries as plain SQL over the sample tables.

The SQL computes results straight from the sample columns: it never sees the
JSON texts, so it shares no parsing with the queries it checks.
"""

from __future__ import annotations

# Shared views of the sample tables, inlined as common table expressions.

_EVENTS = r"""
    ev AS (
        SELECT event_id, ts, user_id, event_type, value,
               CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, event_id % 20 AS m
        FROM events
    )"""

_SEARCH = (
    _EVENTS
    + """,
    seen AS (
        SELECT event_type AS query, event_id AS pos, CAST(user_id AS VARCHAR) AS external_id,
               'user_' || CAST(user_id AS VARCHAR) AS handle,
               CASE WHEN k % 10 <> 9 THEN k END AS follower_count,
               row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS nth
        FROM ev WHERE user_id <> 0
    ),
    firsts AS (SELECT * FROM seen WHERE nth = 1),
    found AS (SELECT * FROM firsts WHERE follower_count >= 50)"""
)

_PAYLOADS = (
    _EVENTS
    + """,
    payloads AS (
        SELECT *, CAST(user_id AS VARCHAR) AS external_id,
               event_type = 'view' AND m > 3 AS is_search,
               CASE WHEN m = 0 THEN 'failed_fetch'
                    WHEN m IN (1, 2, 3) OR user_id = 0 THEN 'failed'
                    ELSE 'parsed' END AS outcome,
               CASE WHEN m = 0 THEN NULL
                    WHEN m = 2 THEN 'Payload lacks profile'
                    WHEN m = 3 THEN 'Payload is not a JSON object'
                    WHEN m = 1 OR user_id = 0 THEN 'Payload lacks author' END AS problem,
               CASE WHEN m <> 0 THEN NULL WHEN event_id % 40 = 0 THEN 'no_data' ELSE 'fetch_failed' END AS reason,
               CASE WHEN m IN (1, 2, 3) THEN 'failed' WHEN m IN (5, 10) THEN 'pending' ELSE 'parsed' END
                   AS parse_status
        FROM ev
    ),
    quarantined AS (
        SELECT event_id AS raw_id, ts,
               CASE problem
                    WHEN 'Payload lacks profile' THEN 'Profile fetch payload missing ''profile_item'''
                    WHEN 'Payload lacks author' THEN 'Missing or malformed authorMeta in hashtag payload'
                    ELSE problem END AS error
        FROM payloads WHERE outcome = 'failed'
    ),
    listed AS (
        SELECT event_id AS raw_id, 0 AS pos, 'v' || CAST(event_id AS VARCHAR) AS video_id, external_id, ts,
               CASE WHEN k % 13 <> 0 THEN date_trunc('milliseconds', ts) END AS posted_at,
               event_type = 'click' AS is_ad, 'en' AS text_language,
               'https://v.example/' || CAST(event_id AS VARCHAR) AS web_video_url,
               CAST(trunc(value) AS BIGINT) AS play_count, k AS digg_count,
               CASE WHEN k % 2 = 0 THEN k * 2 END AS comment_count, k AS share_count
        FROM payloads WHERE outcome = 'parsed' AND k % 11 <> 0
        UNION ALL
        SELECT event_id, 1, 'u' || CAST(user_id AS VARCHAR) || '_' || CAST(k % 10 AS VARCHAR), external_id, ts,
               NULL, event_type = 'purchase', NULL, NULL, NULL, event_id, NULL, NULL
        FROM payloads WHERE outcome = 'parsed' AND NOT is_search
    ),
    profile AS (
        SELECT event_id AS raw_id, ts, external_id,
               CASE WHEN k % 10 = 0 THEN '' ELSE 'user_' || external_id END AS handle,
               CASE WHEN k % 3 <> 2 THEN k * 100 END AS follower_count, k AS following_count,
               k * 100000 AS lifetime_likes, CASE WHEN k % 6 = 0 THEN 1 ELSE k END AS video_count,
               event_type AS bio,
               CASE WHEN k % 2 = 0 THEN 'https://shop.example/' || external_id END AS bio_link,
               k % 4 IN (0, 2) AS is_verified, k % 3 = 2 AS is_private, k % 5 = 0 OR k % 7 = 0 AS is_commerce_account
        FROM payloads WHERE outcome = 'parsed'
    ),
    fetched AS (
        SELECT raw_id, ts, external_id, handle, follower_count, lifetime_likes, bio, is_verified, is_private,
               is_commerce_account, 'success' AS scrape_status
        FROM profile
        UNION ALL
        SELECT event_id, ts, external_id, external_id, NULL, NULL, NULL, FALSE, FALSE, FALSE, reason
        FROM payloads WHERE outcome = 'failed_fetch'
    )"""
)

_REQUESTS = """
    requests AS (
        SELECT event_id // 4 AS request_id, CAST(min(user_id) AS VARCHAR) AS external_id
        FROM events GROUP BY 1
    ),
    answers AS (
        SELECT event_id // 4 AS request_id,
               string_agg('{"id":' || CAST(event_id AS VARCHAR) || ',"note":"' || event_type || '"}', ','
                          ORDER BY event_id) AS items,
               min_by('{"id":' || CAST(event_id AS VARCHAR) || ',"note":"' || event_type || '"}', event_id) AS lead
        FROM events WHERE event_type NOT IN ('error', 'signup') GROUP BY 1
    ),
    envelopes AS (
        SELECT request_id, 'tiktok' AS platform, external_id, 0 AS page, 'profile' AS source_type,
               CASE WHEN items IS NULL THEN '{"ok":false,"reason":"no_data"}'
                    ELSE '{"profile_item":' || lead || ',"video_items":[' || items || ']}' END AS payload
        FROM requests LEFT JOIN answers USING (request_id)
    )"""

_CREATORS = """
    creators AS (
        SELECT c_custkey AS creator_id,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'instagram' ELSE 'tiktok' END AS platform,
               CAST(c_custkey AS VARCHAR) AS external_id,
               CASE WHEN c_acctbal >= 0 THEN 'active' ELSE 'inactive' END AS status
        FROM customer
    ),
    outreach AS (SELECT c_custkey AS creator_id FROM customer WHERE c_mktsegment = 'BUILDING')"""

_SCORES = """
    scores AS (
        SELECT o_orderkey AS score_id, o_custkey AS creator_id, o_orderdate AS computed_at,
               CASE WHEN o_orderstatus = 'P' THEN 'v2' ELSE 'v1' END AS score_version,
               o_totalprice / 1e6 AS engagement_rate,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C'
                    WHEN '4' THEN 'Reject' ELSE 'needs_review' END AS tier
        FROM orders
    )"""

_SNAPSHOTS = """
    line_totals AS (
        SELECT l_orderkey, CAST(sum(l_quantity * l_linenumber * 20) AS BIGINT) AS lifetime_likes,
               count(*) AS video_count, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) >= 3 AS sells
        FROM lineitem GROUP BY l_orderkey
    ),
    snapshots AS (
        SELECT o_orderkey AS snapshot_id, o_custkey AS creator_id, CAST(o_orderdate AS DATE) AS snapshot_date,
               'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS handle,
               CAST(floor(o_totalprice / 10) AS BIGINT) AS follower_count, lifetime_likes, video_count,
               o_orderpriority AS bio, coalesce(sells, FALSE) AS sells,
               CASE WHEN o_orderstatus = 'P' AND left(o_orderpriority, 1) IN ('1', '2') THEN 'no_data'
                    WHEN o_orderstatus = 'P' AND left(o_orderpriority, 1) = '3' THEN 'fetch_failed'
                    ELSE 'success' END AS scrape_status,
               row_number() OVER (
                   PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderdate DESC, o_orderkey DESC
               ) AS nth
        FROM orders LEFT JOIN line_totals ON l_orderkey = o_orderkey
    )"""

_FIGURES = (
    _SNAPSHOTS
    + """,
    pairs AS (
        SELECT c.*, p.follower_count AS before, p.snapshot_date AS before_date
        FROM snapshots c
        LEFT JOIN snapshots p ON p.creator_id = c.creator_id AND p.nth = 2
        WHERE c.nth = 1
    ),
    figures AS (
        SELECT creator_id, scrape_status, follower_count,
               CASE WHEN lifetime_likes <> 0 AND video_count <> 0 AND follower_count <> 0
                    THEN CAST(lifetime_likes AS DOUBLE) / video_count / follower_count END AS lifetime_rate,
               CASE WHEN before <> 0 AND follower_count <> 0 AND snapshot_date > before_date
                    THEN CAST(follower_count - before AS DOUBLE) / before
                         * (CAST(30 AS DOUBLE) / (snapshot_date - before_date)) END AS growth,
               CASE WHEN sells THEN 'brand' WHEN lower(bio) LIKE '%low%' THEN 'reseller' ELSE 'creator' END
                   AS account
        FROM pairs
    )"""
)

_RECENT = """
    video_list AS (
        SELECT o_orderkey AS video_id, o_custkey AS creator_id,
               CASE WHEN left(o_orderpriority, 1) <> '5' THEN o_orderdate END AS posted_at,
               left(o_orderpriority, 1) = '1' AS is_ad
        FROM orders
    ),
    newest AS (
        SELECT * FROM video_list
        QUALIFY row_number() OVER (PARTITION BY creator_id ORDER BY posted_at DESC NULLS FIRST, video_id DESC) <= 5
    ),
    counters AS (
        SELECT l_orderkey AS video_id, CAST(l_shipdate AS DATE) AS snapshot_date,
               CAST(l_quantity AS BIGINT) AS digg_count, CAST(l_linenumber AS BIGINT) AS comment_count,
               CASE WHEN l_returnflag <> 'R' THEN 1 END AS share_count
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey
            ORDER BY CAST(l_shipdate AS DATE) DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                     l_extendedprice DESC, l_quantity DESC,
                     CASE WHEN l_returnflag <> 'R' THEN 1 END DESC NULLS LAST
        ) = 1
    ),
    recent AS (SELECT n.*, digg_count, comment_count, share_count FROM newest n JOIN counters USING (video_id)),
    activity AS (
        SELECT creator_id,
               sum(digg_count + comment_count + coalesce(share_count, 0)) FILTER (WHERE NOT is_ad) AS interactions,
               count(*) FILTER (WHERE NOT is_ad) AS organic,
               count(posted_at) AS dated,
               count(*) FILTER (WHERE DATE '2001-08-01' - CAST(posted_at AS DATE) BETWEEN 0 AND 30) AS in_window
        FROM recent GROUP BY creator_id
    )"""

_SIGNALS = (
    _FIGURES
    + ","
    + _RECENT
    + ","
    + _CREATORS
    + """,
    measured AS (
        SELECT c.creator_id, f.follower_count, coalesce(f.scrape_status, 'fetch_failed') AS scrape_status,
               CASE WHEN f.scrape_status = 'success' THEN
                    coalesce(lifetime_rate,
                             CASE WHEN organic > 0 AND follower_count <> 0
                                  THEN CAST(interactions AS DOUBLE) / organic / follower_count END)
               END AS engagement_rate,
               CASE WHEN f.scrape_status = 'success' THEN growth END AS growth_rate,
               CASE WHEN f.scrape_status = 'success' THEN account ELSE 'creator' END AS account_type,
               CASE WHEN dated > 0 THEN in_window / (CAST(30 AS DOUBLE) / 7) END AS posting_consistency
        FROM creators c
        LEFT JOIN figures f ON f.creator_id = c.creator_id
        LEFT JOIN activity a ON a.creator_id = c.creator_id
        WHERE c.status = 'active'
    ),
    signals AS (
        SELECT *, coalesce(engagement_rate > CAST(0.25 AS DOUBLE), FALSE)
                  OR coalesce(growth_rate > 1, FALSE) AS suspicious_growth
        FROM measured
    )"""
)


def _tiers(source: str) -> str:
    """Tier and flags of rows with the signal columns."""
    thresholds = "".join(
        f" WHEN engagement_rate >= CAST({limit} AS DOUBLE) THEN '{tier}'"
        for tier, limit in (("A", "0.06"), ("B", "0.03"), ("C", "0.01"))
    )
    return f"""
    decided AS (
        SELECT *,
            CASE WHEN scrape_status = 'fetch_failed' THEN 'fetch_failed'
                 WHEN scrape_status = 'no_data' AND follower_count >= 5000 THEN 'no_data_high_followers'
                 WHEN scrape_status = 'no_data' THEN 'no_data_low_followers'
                 WHEN account_type IN ('brand', 'reseller') THEN 'excluded_account_type:' || account_type
                 WHEN follower_count IS NULL OR follower_count < 5000 THEN 'below_minimum_followers'
                 WHEN suspicious_growth THEN 'suspicious_growth'
                 WHEN engagement_rate IS NULL THEN 'insufficient_engagement_data' END AS stop
        FROM {source}
    ),
    tiered AS (
        SELECT *,
            CASE WHEN stop IN ('fetch_failed', 'no_data_high_followers', 'suspicious_growth',
                               'insufficient_engagement_data') THEN 'needs_review'
                 WHEN stop IS NOT NULL THEN 'Reject'{thresholds} ELSE 'Reject' END AS tier,
            CASE WHEN stop IS NOT NULL THEN stop
                 ELSE concat_ws(',',
                    CASE WHEN growth_rate IS NULL THEN 'growth_unknown_first_snapshot' END,
                    CASE WHEN engagement_rate < CAST(0.01 AS DOUBLE) THEN 'below_engagement_threshold' END)
            END AS flags
        FROM decided
    )"""


_QUEUE = """
    queue AS (
        SELECT o_orderkey AS queue_id, CAST(o_custkey AS VARCHAR) AS external_id,
               CAST(left(o_orderpriority, 1) AS INTEGER) AS priority,
               CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'pending' ELSE 'done' END AS status,
               CASE WHEN o_orderstatus <> 'F' THEN NULL
                    ELSE CASE left(o_orderpriority, 1) WHEN '1' THEN 'HTTP 402 (quota exhausted)'
                         WHEN '2' THEN 'HTTP 404' WHEN '3' THEN 'request timed out'
                         WHEN '4' THEN 'Rate limit hit' END END AS error,
               o_orderdate AS enqueued_at
        FROM orders
    ),
    batch AS (
        SELECT * FROM queue WHERE status = 'pending'
        ORDER BY priority, enqueued_at, queue_id LIMIT 25
    )"""

_DUE = (
    _CREATORS
    + ","
    + _SCORES
    + ","
    + _SNAPSHOTS
    + """,
    due AS (
        SELECT c.platform, c.external_id, coalesce(s.handle, c.external_id) AS handle
        FROM creators c
        LEFT JOIN (SELECT * FROM scores QUALIFY row_number() OVER (
                       PARTITION BY creator_id ORDER BY computed_at DESC, score_id DESC) = 1) t
               ON t.creator_id = c.creator_id
        LEFT JOIN snapshots s ON s.creator_id = c.creator_id AND s.nth = 1
        WHERE c.status = 'active'
          AND (s.snapshot_date IS NULL
               OR DATE '2001-08-01' - s.snapshot_date >=
                  CASE coalesce(t.tier, 'needs_review') WHEN 'A' THEN 7 WHEN 'B' THEN 14 WHEN 'C' THEN 30
                       WHEN 'Reject' THEN 90 WHEN 'needs_review' THEN 3 ELSE 30 END)
    )"""
)

_READY = (
    _SCORES
    + ","
    + _CREATORS
    + """,
    ready AS (
        SELECT s.creator_id, s.tier FROM scores s
        JOIN (SELECT creator_id, max(computed_at) AS computed_at FROM scores GROUP BY creator_id) m
          ON m.creator_id = s.creator_id AND m.computed_at = s.computed_at
        WHERE s.tier IN ('A', 'B') AND s.creator_id NOT IN (SELECT creator_id FROM outreach)
    )"""
)

_TIER_AGE = (
    _SCORES
    + ","
    + _SNAPSHOTS
    + """,
    by_tier AS (
        SELECT tier, max(snapshot_date) AS latest_snapshot
        FROM scores JOIN snapshots USING (creator_id) GROUP BY tier
    ),
    sla AS (SELECT * FROM (VALUES ('A', 7), ('B', 14), ('C', 30), ('Reject', 90), ('needs_review', 3)) v(tier, days))"""
)

_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
_AS_OF_EVENTS = "'2024-01-31 00:00:00.000000'"
_AS_OF_ORDERS = "'2001-08-01 00:00:00.000000'"


def _time(column: str) -> str:
    return _TIME.format(column)


def _with(views: str, body: str) -> str:
    return f"WITH {views.strip()}\n{body.strip()}"


def _tier_rows(as_of: str) -> str:
    return f"""
        SELECT 'tier_freshness_' || tier AS name,
               coalesce(DATE '{as_of}' - latest_snapshot <= days + 2, TRUE) AS passed,
               CAST(DATE '{as_of}' - latest_snapshot AS DOUBLE) AS measured,
               CAST(days + 2 AS DOUBLE) AS allowed,
               CASE WHEN latest_snapshot IS NULL THEN 'No creators in tier ' || tier || ' yet'
                    ELSE 'Tier ' || tier || ' most recent snapshot is '
                         || CAST(DATE '{as_of}' - latest_snapshot AS VARCHAR) || 'd old (SLA '
                         || CAST(days AS VARCHAR) || 'd)' END AS message
        FROM sla LEFT JOIN by_tier USING (tier)"""


def _check_rows(tiers_as_of: str, joiner: str = ",") -> str:
    """All ten checks. Rates are shown with one digit, halves away from zero, by whole-number arithmetic."""

    def rate(noun: str, allowed: str) -> str:
        tenths = "(2000 * failed + total) // (2 * total)"
        return (
            f"failed || '/' || total || ' {noun} (' || {tenths} // 10 || '.' || {tenths} % 10 || '%, threshold {allowed}%)'"
        )

    return f"""
        {joiner} q AS (SELECT count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS total,
                       count(*) FILTER (WHERE error ILIKE '%402%' OR error ILIKE '%rate limit%') AS quota FROM queue),
        p AS (SELECT count(*) FILTER (WHERE parse_status = 'failed') AS failed, count(*) AS total,
                     count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-30 22:00:00') AS fresh,
                     count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-30 00:00:00') AS found FROM payloads)
        SELECT 'discovery_freshness' AS name, found >= 1 AS passed, CAST(found AS DOUBLE) AS measured,
               CAST(1 AS DOUBLE) AS allowed, found || ' discovery events in the last 24h (expected >= 1)' AS message FROM p
        UNION ALL SELECT 'ingestion_freshness', fresh >= 1, CAST(fresh AS DOUBLE), 1,
                         fresh || ' raw payloads landed in the last 2h (expected >= 1)' FROM p
        UNION ALL SELECT 'ingestion_health', CAST(failed AS DOUBLE) / total <= CAST(0.2 AS DOUBLE),
                         CAST(failed AS DOUBLE) / total, CAST(0.2 AS DOUBLE), {rate("ingestion items failed", "20.0")} FROM q
        UNION ALL SELECT 'quota_exhaustion', quota <= 5, CAST(quota AS DOUBLE), 5,
                         quota || ' ingestion failures look like quota/rate-limit errors (402/429)'
                         || CASE WHEN quota > 5 THEN ' — check usage' ELSE '' END FROM q
        UNION ALL SELECT 'parse_error_rate', CAST(failed AS DOUBLE) / total <= CAST(0.1 AS DOUBLE),
                         CAST(failed AS DOUBLE) / total, CAST(0.1 AS DOUBLE), {rate("raw payloads failed to parse", "10.0")} FROM p
        UNION ALL SELECT name, passed, measured, allowed, message FROM ({_tier_rows(tiers_as_of)})"""


_GROWTH_ONLY = """
    ranked AS (
        SELECT o_custkey AS creator_id, CAST(o_orderdate AS DATE) AS d, CAST(floor(o_totalprice / 10) AS BIGINT) AS f,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
        FROM orders
    )"""

ORACLES: dict[str, str] = {
    "discover_candidates": _with(
        _SEARCH,
        "SELECT 'tiktok' AS platform, external_id, handle, 'tiktok_hashtag' AS source, query FROM found",
    ),
    "first_occurrence": _with(_SEARCH, "SELECT query, pos, external_id, handle, follower_count FROM firsts"),
    "discovery_events": _with(
        _SEARCH,
        f"""SELECT 'tiktok' AS platform, external_id, 'tiktok_hashtag' AS source, query,
                   {_AS_OF_EVENTS} AS discovered_at FROM found""",
    ),
    "refresh_due": _with(_DUE, "SELECT platform, external_id, handle FROM due"),
    "enqueue_idempotent": _with(
        _SEARCH + "," + _DUE,
        """
        , busy AS (SELECT CAST(user_id AS VARCHAR) AS external_id FROM events GROUP BY user_id HAVING count(*) > 66),
        incoming AS (
            SELECT DISTINCT 'tiktok' AS platform, external_id, handle, 'new_candidate' AS reason, 5 AS priority
            FROM found
            UNION ALL
            SELECT platform, external_id, handle, 'scheduled_refresh', 1 FROM due
            WHERE NOT (platform = 'tiktok' AND external_id IN (SELECT external_id FROM found))
        )
        SELECT *, 'pending' AS status FROM incoming
        WHERE NOT (platform = 'tiktok' AND external_id IN (SELECT external_id FROM busy))
        """,
    ),
    "dequeue_topk": _with(
        _QUEUE,
        f"""SELECT queue_id, 'tiktok' AS platform, external_id, priority, status, error,
                   {_time("enqueued_at")} AS enqueued_at FROM batch""",
    ),
    "queue_transition": _with(
        _QUEUE,
        """
        SELECT queue_id, priority,
               CASE WHEN priority = 1 THEN 'done' WHEN priority = 2 THEN 'failed'
                    WHEN queue_id IN (SELECT queue_id FROM batch) THEN 'in_progress' ELSE status END AS status,
               CASE WHEN priority = 2 THEN 'HTTP 503' ELSE error END AS error
        FROM queue
        """,
    ),
    "error_summary": """
        SELECT o_orderkey AS queue_id,
               CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'HTTP ' || CASE o_orderkey % 7
                         WHEN 0 THEN '401 (auth failed)' WHEN 1 THEN '402 (quota exhausted)' WHEN 2 THEN '403 (forbidden)'
                         WHEN 3 THEN '404 (source not found)' WHEN 4 THEN '429 (rate limited)'
                         WHEN 5 THEN '500 (server error)' ELSE '503 (service unavailable)' END
                    WHEN left(o_orderpriority, 1) = '3' THEN 'request timed out'
                    WHEN left(o_orderpriority, 1) = '4' THEN 'HTTP 418'
                    ELSE 'ValueError: ' || left(repeat('order ' || CAST(o_orderkey AS VARCHAR) || ' refused; ', 20), 200)
               END AS summary,
               'ValueError: ' || repeat('order ' || CAST(o_orderkey AS VARCHAR) || ' refused; ', 20) AS detail
        FROM orders WHERE o_orderstatus = 'F'
    """,
    "fetch_envelope": _with(_REQUESTS, "SELECT * FROM envelopes"),
    "land_raw_payloads": _with(
        _REQUESTS,
        """SELECT platform, source_type, external_id, payload, 'pending' AS parse_status,
                  '2024-01-31' AS fetched_on FROM envelopes""",
    ),
    "ingest_round": _with(
        _QUEUE,
        """
        , lists AS (
            SELECT queue_id, external_id, event_id, '{"id":' || event_id || ',"note":"' || event_type || '"}' AS item,
                   (event_id - min(event_id) OVER (PARTITION BY queue_id)) // 30 AS page
            FROM batch JOIN events ON CAST(user_id AS VARCHAR) = external_id
            WHERE event_type NOT IN ('error', 'signup') AND queue_id % 5 <> 0
        ), pages AS (
            SELECT queue_id, external_id, page, '"video_items":[' || string_agg(item, ',' ORDER BY event_id) || ']}' AS videos,
                   min_by(item, event_id) AS lead
            FROM lists GROUP BY ALL
            UNION ALL
            SELECT queue_id, external_id, 0, NULL, NULL FROM batch
            WHERE queue_id % 5 <> 0 AND queue_id NOT IN (SELECT queue_id FROM lists)
        )
        SELECT 'landed' AS part, sha256('["payload","' || queue_id || '","' || page || '","2024-01-31 00:00:00"]') AS id, external_id,
               CASE WHEN page = 0 THEN 'profile' ELSE 'profile_page' END AS label,
               CASE WHEN videos IS NULL THEN '{"ok":false,"reason":"no_data"}'
                    WHEN page = 0 THEN '{"profile_item":' || lead || ',' || videos ELSE '{' || videos END AS detail
        FROM pages
        UNION ALL
        SELECT 'queue', CAST(queue_id AS VARCHAR), external_id, CASE WHEN queue_id % 5 = 0 THEN 'failed' ELSE 'done' END,
               CASE WHEN queue_id % 5 = 0 THEN 'HTTP 503 (service unavailable)' ELSE error END
        FROM batch
        """,
    ),
    "pending_payloads": _with(
        _PAYLOADS,
        """SELECT event_id AS raw_id, 'tiktok' AS platform, external_id FROM payloads
           WHERE parse_status = 'pending'""",
    ),
    "parse_outcomes": _with(
        _PAYLOADS,
        """SELECT event_id AS raw_id, outcome, error, reason
           FROM payloads LEFT JOIN quarantined ON raw_id = event_id""",
    ),
    "parse_errors": _with(_PAYLOADS, f"SELECT raw_id, error, {_time('ts')} AS occurred_at FROM quarantined"),
    "payload_status": _with(
        _PAYLOADS,
        """SELECT event_id AS raw_id, CASE WHEN outcome = 'failed' THEN 'failed' ELSE 'parsed' END AS parse_status
           FROM payloads""",
    ),
    "parse_profiles": _with(_PAYLOADS, "SELECT 'tiktok' AS platform, * EXCLUDE (ts) FROM profile"),
    "parse_videos": _with(
        _PAYLOADS,
        f"""SELECT raw_id, pos, video_id, external_id AS creator_external_id, {_time("posted_at")} AS posted_at,
                   is_ad, text_language, web_video_url, play_count, digg_count, comment_count, share_count,
                   CAST(NULL AS BIGINT) AS collect_count
            FROM listed""",
    ),
    "parse_first_video": _with(
        _PAYLOADS, "SELECT raw_id, video_id, is_ad, digg_count FROM listed WHERE pos = 0"
    ),
    "json_dual_shape": _with(
        _EVENTS,
        """SELECT event_type AS query, event_id AS pos, CAST(user_id AS VARCHAR) AS id,
                  'user_' || CAST(user_id AS VARCHAR) AS name,
                  CASE WHEN k % 10 <> 9 THEN CAST(k AS VARCHAR) END AS fans
           FROM ev""",
    ),
    "json_lenient_int": _with(
        _EVENTS,
        """SELECT event_id AS raw_id,
                  CASE WHEN m > 3 AND k % 3 <> 2 THEN k * 100 END AS fans,
                  CASE WHEN m > 3 THEN k END AS following,
                  CASE WHEN m > 3 THEN CASE WHEN k % 6 = 0 THEN 1 ELSE k END END AS video,
                  CASE WHEN m > 3 THEN k END AS share_count,
                  CASE WHEN m > 3 THEN CAST(trunc(value) AS BIGINT) END AS play_count,
                  CAST(NULL AS BIGINT) AS collect_count
           FROM ev""",
    ),
    "json_truthy": _with(
        _EVENTS,
        """SELECT event_id AS raw_id,
                  m > 3 AND k % 4 IN (0, 2) AS verified,
                  m > 3 AND k % 3 = 2 AS private_account,
                  m > 3 AND k % 7 = 0 AS tt_seller,
                  m > 3 AND k % 5 <> 1 AS commerce_info,
                  m > 3 AND event_type = 'click' AS is_ad,
                  m = 1 OR (m > 3 AND k % 11 <> 0) AS has_id
           FROM ev""",
    ),
    "enrich_snapshots": _with(
        _PAYLOADS,
        """SELECT raw_id, sha256('["tiktok","' || external_id || '"]') AS creator_id,
                  CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_date, handle, follower_count,
                  is_verified, is_private, is_commerce_account, scrape_status
           FROM fetched""",
    ),
    "profile_snapshots": _with(
        _PAYLOADS,
        """SELECT raw_id, handle, lifetime_likes, bio, scrape_status, '2024-01-31' AS snapshot_date
           FROM fetched""",
    ),
    "video_snapshots": _with(
        _PAYLOADS,
        """SELECT raw_id, video_id, '2024-01-31' AS snapshot_date, play_count, digg_count, comment_count,
                  share_count, CAST(NULL AS BIGINT) AS collect_count
           FROM listed""",
    ),
    "upsert_creators": _with(
        _PAYLOADS,
        f"""
        SELECT sha256('["tiktok","' || external_id || '"]') AS creator_id, 'tiktok' AS platform, external_id,
               {_time("min(ts)")} AS first_discovered_at, {_time("max(ts)")} AS last_seen_at,
               CASE WHEN max(ts) >= TIMESTAMP '2024-01-16' THEN 'active' ELSE 'inactive' END AS status
        FROM payloads WHERE outcome <> 'failed' GROUP BY external_id
        """,
    ),
    "discover_own_source": _with(
        _SEARCH,
        """
        SELECT external_id, handle, query, pos FROM (
            SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY query, pos) = 1
        ) WHERE starts_with(handle, 'user_1')
        """,
    ),
    "landed_items": _with(
        _SEARCH,
        """
        SELECT 'candidate' AS part, query, external_id, handle AS detail FROM found
        UNION ALL SELECT 'corrupt', event_type, NULL, '{"broken ' || event_id FROM ev WHERE event_id % 50 = 0
        """,
    ),
    "enrich_rounds": _with(
        _PAYLOADS,
        """
        , placed AS (
            SELECT raw_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN '2024-01-16' ELSE '2024-01-31' END AS day FROM (SELECT event_id AS raw_id, ts FROM payloads)
        ), figures AS (
            SELECT f.*, p.video_count FROM fetched f LEFT JOIN profile p USING (raw_id)
        ), firsts AS (
            SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ts, raw_id, pos) = 1
        )
        SELECT 'profile_snapshots' AS table_name, sha256('["profile","' || raw_id || '"]') AS id, sha256('["tiktok","' || external_id || '"]') AS creator, day,
            concat_ws('|', raw_id, handle, coalesce(follower_count::VARCHAR, '-'), coalesce(lifetime_likes::VARCHAR, '-'), coalesce(video_count::VARCHAR, '-'),
                is_verified, is_private, is_commerce_account, scrape_status) AS detail
        FROM figures JOIN placed USING (raw_id)
        UNION ALL
        SELECT 'videos', video_id, sha256('["tiktok","' || external_id || '"]'), day, concat_ws('|', is_ad, coalesce(text_language, '-'), coalesce(web_video_url, '-'))
        FROM firsts JOIN placed USING (raw_id)
        UNION ALL
        SELECT 'video_snapshots', sha256('["video","' || raw_id || '","' || pos || '"]'), NULL, day,
            concat_ws('|', raw_id, video_id, coalesce(play_count::VARCHAR, '-'), digg_count, coalesce(comment_count::VARCHAR, '-'), coalesce(share_count::VARCHAR, '-'))
        FROM listed JOIN placed USING (raw_id)
        UNION ALL
        SELECT 'parse_errors', CAST(raw_id AS VARCHAR), NULL, CAST(CAST(ts AS DATE) AS VARCHAR), error FROM quarantined
        UNION ALL
        SELECT 'parse_outcomes', CAST(event_id AS VARCHAR), NULL, NULL, concat_ws('|', outcome, coalesce(reason, '-')) FROM payloads
        UNION ALL
        SELECT DISTINCT 'creator_sightings', external_id, 'tiktok', day, CASE day WHEN '2024-01-16' THEN 'enrich-1' ELSE 'enrich-2' END
        FROM payloads JOIN placed ON raw_id = event_id WHERE outcome <> 'failed'
        """,
    ),
    "stored_status": _with(
        _PAYLOADS,
        """
        SELECT CAST(p.event_id AS VARCHAR) AS raw_id, external_id, CASE WHEN p.ts < TIMESTAMP '2024-01-16' THEN q.error END AS error,
               CASE WHEN p.ts >= TIMESTAMP '2024-01-16' THEN 'pending' WHEN outcome = 'failed' THEN 'failed' ELSE 'parsed' END AS parse_status
        FROM payloads p LEFT JOIN quarantined q ON q.raw_id = p.event_id
        """,
    ),
    "waiting_payloads": _with(
        _PAYLOADS,
        """
        SELECT CAST(p.event_id AS VARCHAR) AS raw_id, CASE WHEN is_search THEN 'hashtag' ELSE 'profile' END AS source_type, external_id, outcome, error
        FROM payloads p LEFT JOIN quarantined q ON q.raw_id = p.event_id WHERE p.ts >= TIMESTAMP '2024-01-16'
        """,
    ),
    "kept_newest": _with(
        _SNAPSHOTS,
        """SELECT creator_id, nth AS position, snapshot_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
                  follower_count
           FROM snapshots WHERE nth <= 2""",
    ),
    "queue_round": _with(
        _SEARCH + "," + _DUE,
        f"""
        , busy AS (SELECT CAST(user_id AS VARCHAR) AS external_id FROM events GROUP BY user_id HAVING count(*) > 66),
        incoming AS (
            SELECT DISTINCT 'tiktok' AS platform, external_id, 'new_candidate' AS reason, 5 AS priority FROM found
            UNION ALL
            SELECT platform, external_id, 'scheduled_refresh', 1 FROM due
            WHERE NOT (platform = 'tiktok' AND external_id IN (SELECT external_id FROM found))
        ), stored AS (
            SELECT *, sha256('["queue","' || platform || '","' || external_id || '","2024-01-31 00:00:00"]') AS id FROM incoming
            WHERE NOT (platform = 'tiktok' AND external_id IN (SELECT external_id FROM busy))
        )
        SELECT 'queue' AS part, id, platform, external_id, reason,
               CASE WHEN row_number() OVER (ORDER BY priority, id) <= 25 THEN 'in_progress' ELSE 'pending' END AS label,
               CAST(priority AS INTEGER) AS priority, {_AS_OF_EVENTS} AS at
        FROM stored
        UNION ALL SELECT 'event', NULL, 'tiktok', external_id, 'tiktok_hashtag', query, NULL, {_AS_OF_EVENTS} FROM found
        """,
    ),
    "score_rounds": _with(
        _SIGNALS.replace("DATE '2001-08-01' - CAST(posted_at AS DATE) BETWEEN 0 AND 30) AS in_window",
            "DATE '2001-08-01' - CAST(posted_at AS DATE) BETWEEN 0 AND 30) AS in_first, count(*) FILTER (WHERE DATE '2001-09-01' - CAST(posted_at AS DATE) BETWEEN 0 AND 30) AS in_second")
        .replace("CASE WHEN dated > 0 THEN in_window / (CAST(30 AS DOUBLE) / 7) END AS posting_consistency",
            "CASE WHEN dated > 0 THEN in_first / (CAST(30 AS DOUBLE) / 7) END AS first_rate, CASE WHEN dated > 0 THEN in_second / (CAST(30 AS DOUBLE) / 7) END AS second_rate")
        + "," + _tiers("signals"),
        """
        SELECT sha256('["score","v1","' || creator_id || '","' || day || ' 00:00:00"]') AS score_id, CAST(creator_id AS VARCHAR) AS creator_id, 'v1' AS score_version,
               day || ' 00:00:00.000000' AS computed_at, engagement_rate, growth_rate, CASE day WHEN '2001-08-01' THEN first_rate ELSE second_rate END AS posting_consistency,
               account_type, tier, flags
        FROM tiered, (VALUES ('2001-08-01'), ('2001-09-01')) runs(day)
        """,
    ),
    "outreach_listing": _with(
        _READY,
        f"""SELECT creator_id, NULL AS tier, NULL AS pushed_at, 'pending' AS status FROM outreach
            UNION ALL SELECT creator_id, min(tier), {_AS_OF_ORDERS}, 'pending' FROM ready GROUP BY creator_id""",
    ),
    "parse_new_shape": _with(
        _PAYLOADS,
        """
        , ids AS (SELECT raw_id, string_agg(video_id, ',' ORDER BY video_id) AS video_ids FROM listed GROUP BY raw_id)
        SELECT p.event_id AS raw_id, p.outcome, q.error, f.handle, f.follower_count,
               CASE WHEN p.outcome = 'parsed' THEN coalesce(video_ids, '') END AS video_ids
        FROM payloads p LEFT JOIN quarantined q ON q.raw_id = p.event_id LEFT JOIN profile f ON f.raw_id = p.event_id LEFT JOIN ids ON ids.raw_id = p.event_id
        """,
    ),
    "upsert_videos": _with(
        _PAYLOADS,
        f"""
        SELECT video_id, sha256('["tiktok","' || external_id || '"]') AS creator_id, {_time("posted_at")} AS posted_at, is_ad,
               {_time("ts")} AS first_seen_at
        FROM listed
        QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ts, raw_id, pos) = 1
        """,
    ),
    "active_creators": _with(_CREATORS, "SELECT creator_id FROM creators WHERE status = 'active'"),
    "creators_per_platform": _with(
        _CREATORS, "SELECT platform, count(*) AS n FROM creators GROUP BY platform"
    ),
    "latest_per_key": _with(
        _SCORES + "," + _SNAPSHOTS + "," + _RECENT,
        """
        SELECT * FROM (
            SELECT 'score' AS kind, creator_id AS key, CAST(CAST(computed_at AS DATE) AS VARCHAR) AS day,
                   score_id AS picked
            FROM scores
            QUALIFY row_number() OVER (PARTITION BY creator_id ORDER BY computed_at DESC, score_id DESC) = 1
        )
        UNION ALL
        SELECT 'profile', creator_id, CAST(snapshot_date AS VARCHAR), snapshot_id FROM snapshots WHERE nth = 1
        UNION ALL
        SELECT 'video', video_id, CAST(snapshot_date AS VARCHAR), digg_count FROM counters
        """,
    ),
    "latest_n_per_key": _with(
        _SNAPSHOTS,
        """SELECT creator_id, nth AS position, snapshot_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
                  follower_count
           FROM snapshots WHERE nth <= 2""",
    ),
    "latest_score_with_ties": _with(
        _SCORES,
        f"""SELECT creator_id, score_id, tier, {_time("computed_at")} AS computed_at FROM scores
            QUALIFY rank() OVER (PARTITION BY creator_id ORDER BY computed_at DESC) = 1""",
    ),
    "lifetime_engagement": _with(
        _SNAPSHOTS,
        """SELECT snapshot_id,
                  CASE WHEN lifetime_likes <> 0 AND video_count <> 0 AND follower_count <> 0
                       THEN CAST(lifetime_likes AS DOUBLE) / video_count / follower_count END AS engagement_rate
           FROM snapshots""",
    ),
    "recent_video_engagement": _with(
        _RECENT,
        f"""SELECT video_id, creator_id, {_time("posted_at")} AS posted_at, is_ad,
                   CAST(NULL AS BIGINT) AS play_count, digg_count, comment_count, share_count
            FROM recent""",
    ),
    "recent_engagement": _with(
        _SNAPSHOTS + "," + _RECENT,
        """SELECT s.creator_id,
                  CASE WHEN organic > 0 AND follower_count <> 0
                       THEN CAST(interactions AS DOUBLE) / organic / follower_count END AS engagement_rate
           FROM snapshots s LEFT JOIN activity a ON a.creator_id = s.creator_id WHERE nth = 1""",
    ),
    "posting_consistency": _with(
        _RECENT,
        """SELECT creator_id, CASE WHEN dated > 0 THEN in_window / (CAST(30 AS DOUBLE) / 7) END
                  AS posting_consistency
           FROM activity""",
    ),
    "growth_rate": _with(_FIGURES, "SELECT creator_id, growth AS growth_rate FROM figures"),
    "suspicious_growth": _with(
        _FIGURES,
        """SELECT creator_id, coalesce(lifetime_rate > CAST(0.25 AS DOUBLE), FALSE)
                              OR coalesce(growth > 1, FALSE) AS suspicious_growth
           FROM figures""",
    ),
    "account_type": """
        SELECT page_id,
               CASE WHEN contains(lower(html), 'track(1') OR contains(lower(url), 'example.net')
                    THEN 'reseller' ELSE 'creator' END AS account_type
        FROM pages
    """,
    "assign_tier": _with(
        _FIGURES
        + """,
    judged AS (
        SELECT follower_count, lifetime_rate AS engagement_rate, growth AS growth_rate, account AS account_type,
               scrape_status,
               coalesce(lifetime_rate > CAST(0.25 AS DOUBLE), FALSE) OR coalesce(growth > 1, FALSE)
                   AS suspicious_growth
        FROM figures
    ),"""
        + _tiers("judged"),
        "SELECT tier, flags, count(*) AS creators FROM tiered GROUP BY tier, flags",
    ),
    "assign_tier_own_rules": _with(
        _FIGURES
        + """,
    judged AS (
        SELECT creator_id, follower_count, lifetime_rate AS engagement_rate, growth AS growth_rate, account AS account_type,
               scrape_status,
               coalesce(lifetime_rate > CAST(0.25 AS DOUBLE), FALSE) OR coalesce(growth > 1, FALSE)
                   AS suspicious_growth
        FROM figures
    ),"""
        + _tiers("judged")
        .replace("CAST(0.06 AS", "CAST(0.12 AS")
        .replace("CAST(0.03 AS", "CAST(0.07 AS")
        .replace("CAST(0.01 AS", "CAST(0.04 AS")
        .replace("IN ('brand', 'reseller')", "IN ('brand')"),
        "SELECT creator_id, tier, flags FROM tiered",
    ),
    "creator_signals": _with(
        _SIGNALS,
        """SELECT creator_id, follower_count, engagement_rate, growth_rate, account_type, scrape_status,
                  posting_consistency, suspicious_growth
           FROM signals""",
    ),
    "score_creators": _with(
        _SIGNALS + "," + _tiers("signals"),
        f"""SELECT creator_id, 'v1' AS score_version, {_AS_OF_ORDERS} AS computed_at, engagement_rate,
                   growth_rate, posting_consistency, account_type, tier, flags
            FROM tiered""",
    ),
    "outreach_ready": _with(_READY, "SELECT creator_id, tier FROM ready"),
    "outreach_push": _with(
        _READY,
        f"""SELECT creator_id, min(tier) AS tier, {_AS_OF_ORDERS} AS pushed_at, 'pending' AS status
            FROM ready GROUP BY creator_id""",
    ),
    "a_tier_candidates": _with(
        _SCORES + "," + _CREATORS + "," + _SNAPSHOTS,
        """
        SELECT c.creator_id, p.handle, s.engagement_rate, s.tier
        FROM scores s
        JOIN creators c ON c.creator_id = s.creator_id
        JOIN snapshots p ON p.creator_id = c.creator_id AND p.nth = 1
        WHERE s.tier = 'A' AND s.score_version = 'v1'
          AND c.creator_id NOT IN (SELECT creator_id FROM outreach)
        ORDER BY s.engagement_rate DESC NULLS FIRST
        """,
    ),
    "count_since": """
        SELECT 'discovery_events' AS source_table, count(*) AS n FROM events
        WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'
        UNION ALL
        SELECT 'raw_payloads', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-30 22:00:00'
    """,
    "count_by_status": _with(_QUEUE, "SELECT status, count(*) AS n FROM queue GROUP BY status"),
    "count_by_parse_status": _with(
        _PAYLOADS, "SELECT parse_status, count(*) AS n FROM payloads GROUP BY parse_status"
    ),
    "quota_errors": _with(
        _QUEUE,
        """SELECT count(*) AS n FROM queue
           WHERE status = 'failed' AND (error ILIKE '%402%' OR error ILIKE '%429%'
                 OR error ILIKE '%payment required%' OR error ILIKE '%rate limit%')""",
    ),
    "failure_rate": _with(
        _QUEUE + "," + _PAYLOADS,
        """
        , outcomes AS (
            SELECT 'fetch' AS stage, status FROM queue
            UNION ALL SELECT 'parse', parse_status FROM payloads
        )
        SELECT stage, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS total,
               CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) / count(*) AS rate
        FROM outcomes GROUP BY stage
        """,
    ),
    "report_counts": _with(
        _QUEUE + "," + _PAYLOADS + "," + _SCORES + "," + _CREATORS,
        """
        SELECT 'discovery' AS report, 'tiktok_hashtag' AS label, event_type AS detail, count(*) AS n
        FROM ev GROUP BY event_type
        UNION ALL SELECT 'queue', status, NULL, count(*) FROM queue GROUP BY status
        UNION ALL SELECT 'fetch_errors', error, NULL, count(*) FROM queue WHERE status = 'failed' GROUP BY error
        UNION ALL SELECT 'payloads', parse_status, NULL, count(*) FROM payloads GROUP BY parse_status
        UNION ALL SELECT 'scores', tier, NULL, count(*) FROM scores GROUP BY tier
        UNION ALL SELECT 'outreach', 'pending', NULL, count(*) FROM outreach
        """,
    ),
    "discovery_today": """
        SELECT 'tiktok_hashtag' AS source, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'
    """,
    "run_totals": _with(
        _SEARCH + "," + _DUE,
        """
        SELECT 'found' AS total, count(*) AS n FROM found
        UNION ALL SELECT 'due', count(*) FROM due
        UNION ALL
        SELECT 'pushed', count(DISTINCT creator_id) FROM (
            SELECT creator_id, tier FROM scores
            QUALIFY rank() OVER (PARTITION BY creator_id ORDER BY computed_at DESC) = 1
        ) WHERE tier IN ('A', 'B') AND creator_id NOT IN (SELECT creator_id FROM outreach)
        """,
    ),
    "latest_snapshot_by_tier": _with(
        _TIER_AGE, "SELECT tier, CAST(latest_snapshot AS VARCHAR) AS latest_snapshot FROM by_tier"
    ),
    "tier_freshness": _with(_TIER_AGE, _tier_rows("2001-08-01")),
    "monitor_checks": _with(_QUEUE + "," + _PAYLOADS + "," + _TIER_AGE, _check_rows("2001-08-01")),
    "monitor_failures": _with(
        _QUEUE + "," + _PAYLOADS + "," + _TIER_AGE,
        f"""
        SELECT CASE WHEN name LIKE 'tier_freshness_%' THEN 'tier_freshness' ELSE name END AS alarm,
               string_agg(message, '; ' ORDER BY name) AS message
        FROM ({_check_rows("2001-09-01", "WITH")}) WHERE NOT passed GROUP BY alarm
        """,
    ),
    "stream_parse": _with(
        _PAYLOADS,
        """
        SELECT 'profile_snapshots' AS written_to, CAST(raw_id AS VARCHAR) AS id, concat_ws('|', sha256('["tiktok","' || external_id || '"]'), handle,
            coalesce(follower_count::VARCHAR, '-'), coalesce(lifetime_likes::VARCHAR, '-'), scrape_status) AS detail
        FROM fetched
        UNION ALL
        SELECT 'videos', video_id, concat_ws('|', sha256('["tiktok","' || external_id || '"]'), is_ad) FROM (
            SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ts, raw_id, pos) = 1)
        UNION ALL
        SELECT 'video_snapshots', video_id, concat_ws('|', raw_id, coalesce(play_count::VARCHAR, '-'), digg_count, coalesce(comment_count::VARCHAR, '-'),
            coalesce(share_count::VARCHAR, '-')) FROM listed
        UNION ALL SELECT 'parse_errors', CAST(raw_id AS VARCHAR), error FROM quarantined
        UNION ALL
        SELECT 'creators', external_id, concat_ws('|', 'active', strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f'), strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f'))
        FROM payloads WHERE outcome <> 'failed' GROUP BY external_id
        """,
    ),
    "stream_dedup": _with(
        _SEARCH,
        """
        , busy AS (SELECT CAST(user_id AS VARCHAR) AS external_id FROM events GROUP BY user_id HAVING count(*) > 66)
        SELECT sha256('["queue","tiktok","' || external_id || '","2024-01-31 00:00:00"]') AS queue_id, 'tiktok' AS platform, external_id, handle,
               'new_candidate' AS reason, 5 AS priority, 'pending' AS status, '2024-01-31 00:00:00.000000' AS enqueued_at
        FROM found WHERE external_id NOT IN (SELECT external_id FROM busy)
        QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY query, pos) = 1
        """,
    ),
    "stream_arrivals": f"""
        WITH hits AS (
            SELECT time_bucket(INTERVAL '15 minutes', ts) - i * INTERVAL '15 minutes' AS window_start
            FROM events, range(8) AS r(i)
        ),
        spine AS (
            SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL '15 minutes')) AS window_start
            FROM hits
        )
        SELECT {_time("window_start")} AS window_start, count(hits.window_start) AS n
        FROM spine LEFT JOIN hits USING (window_start) GROUP BY window_start
    """,
    "stream_growth": _with(
        _GROWTH_ONLY,
        """
        SELECT c.creator_id, CAST(c.d AS VARCHAR) AS snapshot_date,
               CASE WHEN p.f <> 0 AND c.f <> 0 AND c.d > p.d
                    THEN CAST(c.f - p.f AS DOUBLE) / p.f * (CAST(30 AS DOUBLE) / (c.d - p.d)) END AS growth_rate
        FROM ranked c LEFT JOIN ranked p ON p.creator_id = c.creator_id AND p.nth = 2
        WHERE c.nth = 1
        """,
    ),
}
ORACLES["stream_changed_growth"] = ORACLES["stream_growth"]
ORACLES["refresh_due_by_day"] = ORACLES["refresh_due"]
