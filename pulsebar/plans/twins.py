"""DuckDB SQL that gives the same rows as the registered queries."""

from __future__ import annotations

from pulsebar.layout import TICK_CELLS
from pulsebar.plans.catalogue import HISTORY, REPLAY, SCAN, ZONE
from pulsebar.plans.feeds import BASE, CORRECTED, DOCUMENT_WORDS, EVENT_PAIR, EVENT_WORDS, STEP, TEXT_WORDS

SECOND = "epoch_us(ts) // 1000000"

POSTS = f"(SELECT {SECOND} AS s, concat_ws(' ', event_type, props) AS text FROM events)"
TICKS = f"(SELECT {SECOND} AS s, value FROM events WHERE event_type = '{EVENT_PAIR}')"


def _like(word: str) -> str:
    return f"count(*) FILTER (WHERE text LIKE '%{word}%')"


def _social(posts: str, words: dict[str, str]) -> str:
    btc, bitcoin = _like(words["btc"]), _like(words["bitcoin"])
    return f"""
        SELECT s - s % 300 AS key, count(*) AS messages, {btc} AS btc, {bitcoin} AS bitcoin
        FROM {posts} GROUP BY 1 HAVING {btc} > 0 AND {bitcoin} > 0"""


PRICE = f"SELECT s - s % 300 AS key, avg(value) AS last FROM {TICKS} GROUP BY 1"
SOCIAL = _social(POSTS, EVENT_WORDS)
DOCUMENT_SOCIAL = _social(
    f"(SELECT {BASE} + doc_id * {STEP} AS s, text FROM documents)", DOCUMENT_WORDS
)
COMBINED = f"""
    SELECT coalesce(c.key, p.key) AS key, coalesce(messages, 0) AS messages, coalesce(btc, 0) AS btc,
        coalesce(bitcoin, 0) AS bitcoin, round(coalesce(last, 0), 6) AS last
    FROM ({SOCIAL}) c FULL JOIN ({PRICE}) p ON c.key = p.key"""

# the tick an event stands for, as text fields
TICK_TEXT = f"""
    SELECT event_id, {SECOND} AS s, ts, event_type AS currencypair,
        CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS last,
        CAST(CAST(value AS DECIMAL(18,2)) + 1.25 AS VARCHAR) AS lowestask,
        CAST(CAST(value AS DECIMAL(18,2)) - 1.25 AS VARCHAR) AS highestbid,
        regexp_extract(props, '[0-9]+') AS percentchange,
        CAST(user_id AS VARCHAR) AS basevolume,
        CAST(event_id AS VARCHAR) AS quotevolume,
        CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS isfrozen,
        CAST(CAST(value AS DECIMAL(18,2)) + 2.50 AS VARCHAR) AS "24high",
        CAST(CAST(value AS DECIMAL(18,2)) - 2.50 AS VARCHAR) AS "24low"
    FROM events"""
KEYED = "s * 1000 + row_number() OVER (PARTITION BY s ORDER BY event_id) - 1"
TICK_KEYED = f'SELECT CAST({KEYED} AS VARCHAR) AS "row", * FROM ({TICK_TEXT})'
MELTED = " UNION ALL ".join(
    f"""SELECT "row", 'CurrencyRate' AS "columnFamily", '{name}' AS qualifier, "{name}" AS value
    FROM ticks"""
    for name in TICK_CELLS
)

PRINTABLE = r"regexp_replace({}, '[^\x20-\x7E\t\n\r\x0B\x0C]', '', 'g')"
CREATED = f"make_timestamp(({BASE} + doc_id * {STEP}) * 1000000)"
CREATED_TEXT = f"strftime({CREATED}, '%Y-%m-%d %H:%M:%S')"
CHAT_TIME_TEXT = f"strftime(make_timestamp(({BASE} + conv_id) * 1000000), '%Y-%m-%d %H:%M:%S')"
CHAT_OFFSET = "conv_id * 1000 + turn"
CHAT_TEXT = r"""text || CASE role WHEN 'user' THEN ' it''s'
    WHEN 'assistant' THEN ' "it''s", ''so''' || chr(9) ELSE ' c:\new "x"' END"""
# Python's repr of a text without control characters other than these three
CHAT_BODY = r"replace(replace(replace(replace(m, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t')"
CHAT_QUOTED = f"""CASE WHEN contains(m, '''') AND NOT contains(m, '"') THEN '"' || {CHAT_BODY} || '"'
    ELSE '''' || replace({CHAT_BODY}, '''', '\\''') || '''' END"""
# a comma no backslash stands before
UNESCAPED = r"regexp_matches(text, '(^|[^\\]),')"


TWINS: dict[str, str] = {
    "price_5m": f"SELECT key, round(last, 6) AS last FROM ({PRICE})",
    "price_5m_cells": f"SELECT key, round(last, 6) AS last FROM ({PRICE})",
    "preview": f"SELECT key, round(last, 6) AS last FROM ({PRICE}) ORDER BY key LIMIT 20",
    "message_count": f"SELECT s - s % 300 AS key, count(*) AS messages FROM {POSTS} GROUP BY 1",
    "keyword_count": f"""SELECT s - s % 300 AS key, {_like(EVENT_WORDS["btc"])} AS btc,
        {_like(EVENT_WORDS["bitcoin"])} AS bitcoin FROM {POSTS} GROUP BY 1""",
    "social_5m": SOCIAL,
    "social_documents_5m": DOCUMENT_SOCIAL,
    "calc_full": COMBINED,
    "history": f"""SELECT *, strftime(make_timestamp(key * 1000000), '%Y-%m-%d %H:%M:%S') AS date_time FROM ({COMBINED})
        WHERE key >= {HISTORY[0]} AND key < {HISTORY[1]} ORDER BY key""",
    "history_union": f"""SELECT key, messages, btc, bitcoin, CAST(0 AS DOUBLE) AS last FROM ({SOCIAL})
        UNION ALL SELECT key, 0, 0, 0, round(last, 6) FROM ({PRICE})""",
    "upsert_latest": """
        SELECT o_custkey AS key, max(o_orderkey) AS messages,
            coalesce(max(o_orderkey) FILTER (WHERE o_orderstatus = 'F'), 0) AS btc,
            coalesce(max(o_orderkey) FILTER (WHERE o_orderstatus = 'O'), 0) AS bitcoin,
            arg_max(o_totalprice, o_orderkey) AS last
        FROM orders GROUP BY 1""",
    "row_key": f"SELECT event_id, {KEYED} AS row_key FROM (SELECT event_id, {SECOND} AS s FROM events)",
    "chat_row_key": f"""SELECT {CHAT_OFFSET} AS "offset", ({BASE} + conv_id) * 1000
        + row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS row_key FROM conversations""",
    "cells_melt": f"WITH ticks AS ({TICK_KEYED}) {MELTED}",
    "cells_explode": f"WITH ticks AS ({TICK_KEYED}) {MELTED}",
    "cells_wide": f'SELECT "row", currencypair, last, isfrozen FROM ({TICK_KEYED})',
    "family_profile": """
        SELECT 'CurrencyRate' AS "columnFamily", 10 * count(*) AS cells FROM events
        UNION ALL SELECT 'Twitter', 8 * count(*) FROM documents
        UNION ALL SELECT 'Trollbox', 2 * count(*) FROM conversations""",
    "family_scan": f"""
        SELECT CAST({CHAT_OFFSET} AS VARCHAR) AS "row", 'Trollbox' AS "columnFamily",
            'troll' AS qualifier, role AS value FROM conversations
        UNION ALL SELECT CAST({CHAT_OFFSET} AS VARCHAR), 'Trollbox', 'trollmessage', {CHAT_TEXT}
        FROM conversations""",
    "range_scan": f"""SELECT event_id AS "offset", event_type AS pair, value AS last, {SECOND} AS epoch_s
        FROM events WHERE {SECOND} >= {SCAN[0]} AND {SECOND} < {SCAN[1]}""",
    "backfill": f"""SELECT event_id AS "offset", event_type AS pair, value AS last, s AS epoch_s,
            {KEYED} AS row_key
        FROM (SELECT *, {SECOND} AS s FROM events) WHERE s > {REPLAY[0]} AND s <= {REPLAY[1]}""",
    "encode_post": f"""SELECT doc_id AS "offset", {PRINTABLE.format(
        "n_chars || ',' || doc_id || ',' || doc_id || ',' || replace(text, ',', '" + chr(92) + ",') || ',' || source"
        " || ',' || lang || ',' || source || '" + chr(92) + ", ' || lang || ',' || " + CREATED_TEXT
    )} AS value FROM documents""",
    "encode_tick": f"""SELECT event_id AS "offset", '(''' || currencypair || ''', ''' || last || ''', '''
        || lowestask || ''', ''' || highestbid || ''', ''' || percentchange || ''', ''' || basevolume
        || ''', ''' || quotevolume || ''', ' || isfrozen || ', ''' || "24high" || ''', ''' || "24low"
        || ''', ''' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ''')' AS value FROM ({TICK_TEXT})""",
    "encode_chat": f"""SELECT "offset", '(''trollboxMessage'', ' || conv_id || ', ''' || role || ''', '
        || {CHAT_QUOTED} || ', ' || turn || ', '''
        || {CHAT_TIME_TEXT} || ''')' AS value
        FROM (SELECT {CHAT_OFFSET} AS "offset", conv_id, turn, role, {CHAT_TEXT} AS m FROM conversations)""",
    "parse_post": f"""SELECT doc_id AS "offset", n_chars AS followers, doc_id AS friends,
        doc_id AS statuses, {PRINTABLE.format("text")} AS text, source AS screen_name,
        lang AS language, source || ', ' || lang AS location, {CREATED_TEXT} AS created,
        {BASE} + doc_id * {STEP} AS epoch_s FROM documents""",
    "parse_tick": f"""SELECT event_id AS "offset", currencypair AS pair, CAST(last AS DOUBLE) AS last,
        CAST(lowestask AS DOUBLE) AS lowest_ask, CAST(highestbid AS DOUBLE) AS highest_bid,
        CAST(percentchange AS DOUBLE) AS percent_change, CAST(basevolume AS DOUBLE) AS base_volume,
        CAST(quotevolume AS DOUBLE) AS quote_volume, CAST(isfrozen AS INTEGER) AS is_frozen,
        CAST("24high" AS DOUBLE) AS high_24h, CAST("24low" AS DOUBLE) AS low_24h,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, s AS epoch_s FROM ({TICK_TEXT})""",
    "parse_chat": f"""SELECT {CHAT_OFFSET} AS "offset", role AS "user", {CHAT_TEXT} AS message,
        {CHAT_TIME_TEXT} AS ts, {BASE} + conv_id AS epoch_s
        FROM conversations""",
    "rejects": f"""SELECT 'posts' AS source, 'posts' AS topic, 0 AS "partition", doc_id AS "offset",
            n_chars || ',' || doc_id || ',' || doc_id || ',' || text || ',' || source || ',' || lang
            || ',' || source || ',' || CASE WHEN lang = 'en' THEN {CREATED_TEXT}
            ELSE replace({CREATED_TEXT}, '-', '/') END AS value,
            CASE WHEN {UNESCAPED} THEN 'field_count' ELSE 'time' END AS reason
        FROM documents WHERE {UNESCAPED} OR lang <> 'en'""",
    "track_filter": "SELECT doc_id, text FROM documents WHERE "
    + " OR ".join(f"contains(lower(text), '{word}')" for word in TEXT_WORDS),
    "printable": f"SELECT doc_id, {PRINTABLE.format('text')} AS text FROM documents",
}

# a stream that has read its whole table leaves what the batch job gives
TWINS["stream_posts"] = f"""SELECT *, epoch_s * 1000 AS row_key FROM ({TWINS["parse_post"]})"""
TWINS["stream_ticks"] = f"""SELECT *, epoch_s * 1000 + row_number() OVER
    (PARTITION BY epoch_s ORDER BY "offset") - 1 AS row_key FROM ({TWINS["parse_tick"]})"""
TWINS["stream_chats"] = f"""SELECT *, epoch_s * 1000 + row_number() OVER
    (PARTITION BY epoch_s ORDER BY "offset") - 1 AS row_key FROM ({TWINS["parse_chat"]})"""
TWINS["stream_row_key"] = f"""SELECT {BASE} + conv_id AS epoch_s, ({BASE} + conv_id) * 1000
    + row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS row_key FROM conversations"""
# a backfill that overlaps another leaves what the batch job gives, too
TWINS["backfill_posts"] = TWINS["stream_posts"]
TWINS["backfill_chats"] = TWINS["stream_chats"]
TWINS["tick_zone"] = f"""SELECT event_id AS "offset", CAST(floor(epoch(timezone('{ZONE}', ts))) AS BIGINT) AS epoch_s,
    CAST(CAST(make_timestamp(CAST(floor(epoch(timezone('{ZONE}', ts))) AS BIGINT) * 1000000) AS DATE) AS VARCHAR) AS day
    FROM events"""
TWINS["history_local"] = f"""SELECT * REPLACE (strftime(timezone('{ZONE}', make_timestamptz(key * 1000000)),
    '%Y-%m-%d %H:%M:%S') AS date_time) FROM ({TWINS["history"]})"""
TWINS["calc_cells"] = f"""SELECT CAST(key AS VARCHAR) AS "row", 'Twitter' AS "columnFamily", qualifier, CAST(n AS VARCHAR) AS value
    FROM (UNPIVOT (SELECT key, messages AS "Messages", btc AS "BTC", bitcoin AS "Bitcoin" FROM ({SOCIAL})
        WHERE key >= {HISTORY[0]} AND key < {HISTORY[1]})
    ON "Messages", "BTC", "Bitcoin" INTO NAME qualifier VALUE n)"""
TWINS["produce_posts"] = f"""SELECT * EXCLUDE ("offset") FROM ({TWINS["parse_post"]}) p
    WHERE "offset" IN (SELECT doc_id FROM ({TWINS["track_filter"]}))"""
TWINS["stream_social"] = TWINS["social_documents_5m"]
TWINS["stream_price"] = TWINS["price_5m"]
TWINS["stream_social_late"] = TWINS["social_5m"]
TWINS["stream_compacted"] = TWINS["stream_ticks"]
TWINS["backfill_resume"] = f"""SELECT event_id AS "offset", event_type AS pair, value AS last, s AS epoch_s, {KEYED} AS row_key
    FROM (SELECT *, {SECOND} AS s FROM events)"""
TWINS["offsets_covered"] = f"""SELECT 'ticks' AS topic, 0 AS "partition", min(event_id) AS start, max(event_id) AS stop
    FROM (SELECT event_id, event_id - row_number() OVER (ORDER BY event_id) AS run FROM events
        WHERE {SECOND} > {REPLAY[0]} AND {SECOND} <= {REPLAY[1]}) GROUP BY run"""
TWINS["price_corrected"] = f"""SELECT s - s % 300 AS key, round(avg(value), 6) AS last
    FROM {TICKS} WHERE value >= {CORRECTED} GROUP BY 1"""
TWINS["price_recounted"] = TWINS["price_corrected"]
TWINS["price_1h_from_5m"] = f"""SELECT s - s % 3600 AS key, round(avg(value), 6) AS last
    FROM {TICKS} WHERE s >= {HISTORY[0]} AND s < {HISTORY[1]} GROUP BY 1"""
TWINS["cells_inferred"] = f"""SELECT CAST("row" AS BIGINT) AS "row", * EXCLUDE ("row") FROM ({TWINS["cells_melt"]})"""
TWINS["produce_ticks"] = f"""SELECT * EXCLUDE ("offset", ts, epoch_s) FROM ({TWINS["parse_tick"]})"""
TWINS["produce_chats"] = f"""SELECT "user", message FROM ({TWINS["parse_chat"]})"""
