"""The registered queries of the operators, and SQL for those it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebar.llm import (
    chat, decontaminate, exact_dedup, line_dedup, near_dedup, neighbours, pack, phrases, pii, quality, shards, trie, url_rules,
)
from pulsebar.llm.common import table

#: Curated rules: verdict, host, start of the path.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.base)
    names = F.array(*map(F.lit, pii.KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    packed = pack.pack(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')"
        " AS t(conv_id, turn, role, text)"
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_chats(given)
    turn = F.transform("segments", lambda s: F.concat(chat.unescape(s.role), F.lit("\n"), chat.unescape(s.text), F.lit("\n")))
    masked = F.filter("segments", lambda s: s.role == "assistant")
    loss = F.array_join(F.transform(masked, lambda s: chat.unescape(s.text)), "")
    return done.select(
        "conv_id", F.size("segments").cast("long").alias("n_turns"), F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, trees).select(
        "doc_id", F.coalesce(quality.fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= quality.CUT, 1).otherwise(0).alias("predicted"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_rows(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_decontamination, op3_personal_data, op4_packing, op5_chat,
        op6_line_dedup, op7_quality, op8_url_filter, op9_near_dedup, op10_shards, op11_prefix_trie,
        op12_nearest, op13_collocations,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY text)
    """,
    "op6_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        l AS (
            SELECT row, doc_id, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(1, len(string_split(text, chr(10))) + 1)) AS nth
            FROM d
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), f AS (
            -- every row is a document, rows that repeat a doc_id too
            SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT row) >= 3
        )
        SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines,
               count(*) FILTER (f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.keeper) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY nth)
                               FILTER (f.key IS NULL OR k.doc_id IS NOT DISTINCT FROM f.keeper), '')) AS kept_sha256
        FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.row
    """,
    "op5_chat": r"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), t AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   -- the template's own length, and a backslash for each control string where any text has one
                   sum(length(text) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE 23 + length(role) END) AS plain,
                   sum(len(regexp_extract_all(text, '[\[<]\\*(INST\]|/INST\]|ROLE\]|TEXT\]|/ROLE\]|/s>)'))) AS controls
            FROM r GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
               sha256(loss) AS loss_sha256, CAST(plain + controls AS BIGINT) AS formatted_chars
        FROM t
    """,
    "op2_decontamination": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k : k + 9], ' ') AS words
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
        ), spot AS (
            SELECT doc_id, k, size, array_to_string(w[k : k + size - 1], ' ') AS words
            FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d), (SELECT DISTINCT size FROM win)
            WHERE k + size - 1 <= len(w)
        ), hit AS (SELECT doc_id, k, spot.size, item_id FROM spot JOIN win USING (words)),
        covered AS (
            SELECT doc_id, count(DISTINCT place) AS n
            FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM hit) GROUP BY doc_id
        ), found AS (
            SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op9_near_dedup": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pair AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), link AS (
            SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * common >= 75 * (x.n + y.n - common)
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM d
            UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a
        )
        SELECT reach.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id,
               reach.doc_id = min(other) AS kept
        FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id
    """,
    "op11_prefix_trie": r"""
        WITH r AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            -- CRC-32 of the decimal id, byte by byte and bit by bit
            SELECT conv_id, conv_id - conv_id % 20 AS source, xor(list_reduce(
                       list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
                       lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                                lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
            FROM (SELECT DISTINCT conv_id FROM r)
        ), t AS (
            SELECT c.conv_id, 0 AS own, r.place, role, text FROM c JOIN r ON r.conv_id = c.source AND r.place < c.h
            UNION ALL SELECT c.conv_id, 1, r.place, role, text FROM c JOIN r ON r.conv_id = c.conv_id AND r.place >= c.h
        ), d AS (
            SELECT conv_id, row_number() OVER w AS depth, text,
                   sha256(string_agg(sha256(length(role) || ':' || role || text), ',') OVER w) AS node,
                   count(*) OVER (PARTITION BY conv_id) AS length
            FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)
        ), m AS (
            SELECT conv_id, depth, node, text, length FROM d
            UNION ALL SELECT conv_id, 0, 'root', '', (SELECT count(*) FROM t WHERE t.conv_id = c.conv_id) FROM c
        ), n AS (
            SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends
            FROM m GROUP BY 1, 2
        ), p AS (
            SELECT n.*, up.conv_id AS parent_conv_id, up.depth AS up_depth, up.node AS up_node
            FROM n LEFT JOIN m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
            LEFT JOIN n up ON up.depth = m.depth AND up.node = m.node
        ), k AS (SELECT up_depth AS depth, up_node AS node, count(*) AS n_children FROM p WHERE up_node IS NOT NULL GROUP BY 1, 2),
        s AS (
            SELECT m.depth, m.node, sum(n.saved) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
            FROM n JOIN m ON m.conv_id = n.conv_id AND m.depth <= n.depth
            LEFT JOIN k ON k.depth = n.depth AND k.node = n.node GROUP BY 1, 2
        )
        SELECT p.conv_id, p.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, ends AS ends_sha256
        FROM p JOIN s ON s.depth = p.depth AND s.node = p.node LEFT JOIN k ON k.depth = p.depth AND k.node = p.node
    """,
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (
            SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k : k + size - 1], ' '))) AS phrase
            FROM w, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size
        ), f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
        c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
        cut AS (
            SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
                   (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.f AS HUGEINT) * r.f) AS score
            FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : k], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1 :], ' ')
        ), scored AS (
            SELECT lang, phrase, a, arg_min(l, score * 4 + k) AS l, arg_min(r, score * 4 + k) AS r, min(score) AS score
            FROM cut GROUP BY lang, phrase, a
        ), longer AS (
            SELECT lang, phrase, max(a) AS longest
            FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE size = 3) GROUP BY ALL
        ), kept AS (
            SELECT s.* FROM scored s LEFT JOIN longer USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 50 * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
               CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
    """,
}
