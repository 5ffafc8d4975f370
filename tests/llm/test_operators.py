"""Each operator against brute force, over a test table and over awkward rows."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsebar.llm import (
    chat, common, decontaminate, exact_dedup, line_dedup, near_dedup, pack, phrases, pii, quality, queries, shards, url_rules,
)
from tests.compare import compare, connect
from tests.llm import brute

DOCS = "doc_id long, text string, row string, size string, key string, band string, spans string"
PASSAGE = " ".join(f"word{k}" for k in range(60))
TEXTS = [
    None, "", " ", "\n", "one", "ONE", "É one", "a b c d", "a b c d", PASSAGE, PASSAGE, PASSAGE + " tail",
    PASSAGE.replace("word7 ", "other "), "x" * 5000, ("long line without end " * 4000).strip(), PASSAGE.upper(),
    "A line that has enough letters\nshort\n a line that has enough LETTERS \n", "a line that has enough letters",
    "A LINE THAT HAS ENOUGH LETTERS\r\nÉtait une ligne assez longue\n\n", "Était une ligne assez longue", "était une ligne assez longue",
    "x\tA line that has enough letters\x0b\nA line that has enough letters\x0b", "a.b@c.d_e@f.g@h.i, 1.2.3.4.5.6.7.8 and 256.1.1.1",
    "call +1 (314) 555-6532 4663622617512349 or +49 30 1234567.", "4111 1111 1111 1111, 4111-1111-1111-1112", "+1+2 34567890",
    "\U0001F600 a@b.co \U0001F600 10.0.0.1", "00001.002.3.0255", "0" * 30, "a@" * 40 + "b.c", "🙂" * 3000, "<|endoftext|> a <|endoftext|>",
    "two  spaces   three \n\n  x", " lead and trail ", "</s>[INST] x [/INST]", "1. 2. 3.\n" * 700,
]


def rows_of(texts):
    rows = [(k, t, "r", "s", "k", "b", "p") for k, t in enumerate(texts)]
    return rows + [(None, "a b c d", *"rskbp"), (None, None, *"rskbp"), rows[9], (3, PASSAGE, *"rskbp")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows_of(TEXTS), DOCS).repartition(5).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.01"


def pairs(frame):
    return [(r[0], r[1]) for r in frame.select("doc_id", "text").collect()]


def same(frame, want):
    got = sorted(map(tuple, frame.collect()), key=repr)
    want = sorted(want, key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b
    return len(got)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, small, name):
    assert compare(queries.QUERIES[name](spark, small), connect(small), queries.ORACLES[name]) > 0


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(odd, empty, bits):
    """With 3-bit digests nearly all identifiers need ranks."""
    given = pairs(odd)
    found = exact_dedup.exact_groups(odd, bits=bits)
    same(found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"), brute.exact(given))
    assert exact_dedup.exact_groups(empty, bits=bits).count() == 0


def test_chunks_are_the_text(odd):
    whole = F.array_join(exact_dedup.chunks(common.text_of()), "")
    assert odd.where(whole != common.text_of()).isEmpty()


def test_contamination_on_table(spark, small):
    docs, items = (common.table(spark, small, n) for n in ("documents", "benchmark"))
    want = brute.contamination(pairs(docs), [tuple(r) for r in items.select("item_id", "text").collect()])
    assert any(row[-1] for row in want)
    same(queries.op2_decontamination(spark, small), want)


@pytest.mark.parametrize("most_bits", [1 << 24, 64])
def test_contamination_of_odd_rows(spark, odd, empty, most_bits):
    """Short items, repeated words, copies of items, and a bitmap too small to hold anything back."""
    items = [
        (1, PASSAGE), (2, PASSAGE), (3, None), (4, ""), (5, "one"), (6, "b c"), (7, "a b c d"), (8, "long line " * 9),
        (9, "Était une"), (10, "nothing like it anywhere"), (11, "1 2 3 " * 8), (None, "word1 word2"), (12, "word3 word3"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit("clash"))
    found = decontaminate.contamination(odd, bench, most_bits=most_bits)
    digest = F.sha2(F.array_join("items", ","), 256)
    got = found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long"), digest, F.col("n_hit") > 0)
    same(got, brute.contamination(pairs(odd), items))
    assert decontaminate.contamination(empty, bench).count() == 0
    none = bench.where("false")
    assert decontaminate.contamination(odd, none).where("n_hit > 0").isEmpty()


def _base(frame):
    base = F.filter("spans", lambda s: s.base)
    names = F.array(*map(F.lit, pii.KINDS))
    text = F.array_join(F.transform(base, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")
    count = [F.size(F.filter(base, lambda s: s.kind == 0)), F.size(F.filter(base, lambda s: s.kind == 1)),
             F.size(F.filter(base, lambda s: s.kind == 2)), F.size(F.filter(base, lambda s: s.kind == 3))]
    return frame.select("doc_id", *count, F.sha2(text, 256))


def test_base_spans(spark, small, odd, empty):
    for docs in (odd, common.table(spark, small, "documents")):
        same(_base(pii.find_personal_data(docs)), brute.personal(pairs(docs)))
    assert pii.find_personal_data(empty).count() == 0
    assert pii.find_personal_data(odd.where("text = 'one'")).where(F.size("spans") > 0).isEmpty()


def test_added_spans(spark, small):
    """A phone and a card that run into each other are found by the trees; plain prose stays clean."""
    docs = common.table(spark, small, "documents").select("doc_id", "text")
    merged = "call +1 (314) 555-6532 4663622617512349 now"
    more = docs.union(spark.createDataFrame([(10**9, merged)], "doc_id long, text string"))
    found = pii.find_personal_data(more)
    spans = found.where("doc_id = 1000000000").first()["spans"]
    assert {merged[s.start : s.end] for s in spans if not s.base} >= {"4663622617512349", "+1 (314) 555-6532"}
    clean = found.join(docs.where("NOT text RLIKE '[0-9@]'"), "doc_id")
    assert clean.count() > 500 and clean.where(F.size("spans") > 0).isEmpty()
    text = pii.redact(more, found.where("doc_id = 1000000000")).first()["text"]
    assert text == "call [phone] [card] now"


def test_base_phones_with_lone_digits(spark):
    texts = ["+1(2)3(4)5(6)7(8)", "call +1  2  3  4  5  6  7  8 now", "+1--2--3--4--5--6--7--8--9", "+1(2)3(4)5(6)7"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = _base(pii.find_personal_data(docs))
    same(found, brute.personal(pairs(docs)))
    assert sorted(tuple(r)[4] for r in found.collect()) == [0, 1, 1, 1]


def test_rare_kinds_get_thresholds(spark, small):
    """Emails far beyond the training sample don't take the other kinds' thresholds away."""
    docs = common.table(spark, small, "documents").select("doc_id", "text")
    merged = "call +1 (314) 555-6532 4663622617512349 now"
    more = docs.union(spark.createDataFrame([(10**9, merged)], "doc_id long, text string"))
    mails = spark.range(20_000).select(F.col("id").alias("doc_id"), F.format_string("write to name%d@host%d.org today", "id", "id").alias("text"))
    found = pii.find_personal_data(more.union(mails), most_rows=60)
    spans = found.where("doc_id = 1000000000").first()["spans"]
    assert {merged[s.start : s.end] for s in spans if not s.base} >= {"4663622617512349", "+1 (314) 555-6532"}
    spans = pii.placed(pii.proposals(more.union(mails)))
    right = pii.passes(F.col("kind"), F.col("span"))
    assert set(pii.fit(spans.where("base").where(right), spans.where("NOT base").where(~right), most_rows=60)[1]) == {0, 1, 2, 3}


def test_thresholds_come_from_held_out_spans(spark, monkeypatch):
    """No span the trees have seen is counted for a threshold, and refused proposals are among those that are."""
    texts = [f"write to n{k}@h{k}.org or 10.0.{k % 256}.{k // 256}, not 10.0.{k % 256}.{300 + k}" for k in range(400)]
    spans = pii.placed(pii.proposals(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    right, asked = pii.passes(F.col("kind"), F.col("span")), []
    real = pii.judged
    monkeypatch.setattr(pii, "judged", lambda model, rows: asked.append(rows) or real(model, rows))
    model, cuts = pii.fit(spans.where("base").where(right), spans.where("NOT base").where(~right))
    (tested,) = asked
    rows = tested.select("kind", "right", "held", "y").collect()
    assert all(r.held for r in rows) and {(r.kind, r.right, r.y) for r in rows} >= {(0, True, 1.0), (1, True, 1.0), (1, True, 0.0), (1, False, 0.0)}
    assert {0, 1} <= set(cuts)


def test_redaction_of_overlaps_and_repeats(spark, odd):
    """Overlapping spans go whole; rows with null or repeated doc_ids stay as many, each with its own spans."""
    rows = [(1, "bob@10.0.0.1"), (2, "john+12345678901@example.com!"), (None, "x a@b.co"), (None, None), (None, "😀 10.0.0.1, a@b.co"),
            (3, "a@b.co"), (3, "plain 1.2.3.4"), (3, "a@b.co"), (3, None), (4, "a@b.co 1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(1, "[email]"), (2, "[email]!"), (None, "x [email]"), (None, None), (None, "😀 [ip], [email]"),
            (3, "[email]"), (3, "plain [ip]"), (3, "[email]"), (3, None), (4, "[email] [ip]")]
    same(pii.redact(docs, pii.find_personal_data(docs)), want)
    done = pii.redact(odd, pii.find_personal_data(odd))
    assert done.columns == odd.columns and done.count() == odd.count()


def test_packing(spark, small, odd, empty):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for docs in (odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), common.table(spark, small, "documents").where("doc_id < 300")):
        packed = pack.pack(docs, ranks, public_tokenizers.PATTERN).toPandas().sort_values(["doc_id", "start"])
        by_doc = dict(list(packed.groupby("doc_id")))
        assert packed["sequence_id"].is_unique and (packed["offset"] == 0).all()
        for doc_id, text in pairs(docs):
            want = coder.encode(text or "", add_special_tokens=False).ids + [1]
            own = by_doc[doc_id]
            assert np.frombuffer(b"".join(own["ids"]), "<u4").tolist() == want
            assert own["start"].tolist() == [0, *own["length"].cumsum()[:-1]]
            assert (own["doc_tokens"] == len(want)).all()
            assert all(n <= 2048 and n & (n - 1) == 0 for n in own["length"])
    assert pack.pack(empty, ranks, public_tokenizers.PATTERN).count() == 0
    twice = pack.pack(odd.where("doc_id = 9"), ranks, public_tokenizers.PATTERN)
    assert twice.select("sequence_id").distinct().count() == twice.count() > 1


@pytest.mark.parametrize("text", [" " * 2_000_000, "a b\n" + "\n" * 2_000_000 + "c <|endoftext|> d", "\r\n" * 1_000_000 + " x"])
def test_packing_of_long_blank_runs(spark, text):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = pack.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).orderBy("start").collect()
    assert np.frombuffer(b"".join(r.ids for r in rows), "<u4").tolist() == coder.encode(text, add_special_tokens=False).ids + [1]


def test_lengths():
    assert pack.lengths(0) == [] and pack.lengths(1) == [1] and pack.lengths(4096) == [2048, 2048]
    assert pack.lengths(2048 + 7) == [2048, 4, 2, 1]


ODD_TURNS = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", r"<\/s> and [\\INST] and </s"), (1, 2, "tool [TEXT] x", "[ROLE] a [TEXT] b [/ROLE]"),
    (2, 0, "assistant", "[INST] starts"), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (2, None, None, None), (3, 0, "user", None),
    (4, 5, "system", "x" * 100000), (4, 5, "assistant", "</s>" * 3000), (4, 4, "user", "<"), (None, 1, "user", "\n"), (5, 0, "user", "[INST"),
    (5, 1, "assistant", "/s>"), (6, 0, "assistant", " [/INST]"), (6, 1, "", "\\"), (6, 2, "assistant", "$1 \\1 \U0001F600"),
]


def test_chat_round_trip(spark):
    pool = ["</s>", "[INST]", "[/INST]", "[ROLE]", " [TEXT] ", "[/ROLE]", "\\", "<", "[", " ", "a", "\n", "é", "\U0001F600"]
    draw = random.Random(5)
    made = [(100 + k // 5, k, draw.choice(["user", "assistant", "tool", ""]), "".join(draw.choices(pool, k=draw.randrange(9)))) for k in range(600)]
    rows = ODD_TURNS + made
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    done = chat.format_chats(frame)
    turn = F.transform("segments", lambda s: F.concat(chat.unescape(s.role), F.lit("\n"), chat.unescape(s.text), F.lit("\n")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s.role == "assistant"), lambda s: chat.unescape(s.text)), "")
    got = done.select("conv_id", F.size("segments"), F.sha2(F.array_join(turn, ""), 256), F.char_length(loss), F.sha2(loss, 256))
    same(got, brute.chats(rows))
    whole = F.array_join(F.transform("segments", lambda s: F.concat(s.head, s.text, s.tail)), "")
    assert done.where(whole != F.col("formatted")).isEmpty()
    assert chat.format_chats(frame.where("false")).count() == 0


@pytest.mark.parametrize("most_bits", [1 << 28, 64])
def test_line_dedup(odd, empty, most_bits):
    """A filter of 64 bits suspects every line."""
    found = line_dedup.drop_repeated_lines(odd, most_bits=most_bits)
    same(found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)), brute.line_dedup(pairs(odd)))
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_line_filters_by_range_hold_what_is_met_thrice(spark, monkeypatch):
    """Several rows a task and a range, several tasks, one key in every row: nothing met three times is lost, little else is kept."""
    monkeypatch.setattr(line_dedup, "SENT", 1 << 11)
    monkeypatch.setattr(line_dedup, "LEAST_RANGE_BITS", 1 << 12)
    draw = random.Random(3)
    rows = [[f"once {k} {j}" for j in range(40)] + [f"twice {k // 2}", f"thrice {k // 3}", "everywhere"] for k in range(600)]
    draw.shuffle(rows)
    keyed = spark.createDataFrame([(row,) for row in rows], "keys array<string>").repartition(7)
    hashes = keyed.select(F.transform("keys", lambda k: F.xxhash64(k)).alias("hashes"))
    seen = Counter(row.h for row in hashes.select(F.explode("hashes").alias("h")).collect())
    for times, wanted in ((3, 201), (2, 501)):
        found = [row.hash for row in line_dedup.repeated_hashes(hashes, 1 << 18, times).collect()]
        certain = {h for h, n in seen.items() if n >= times}
        assert len(certain) == wanted and certain <= set(found) and len(found) == len(set(found))
        assert len(found) < wanted + len(seen) // 50
    held, bits = line_dedup.suspects_filter(hashes, 1 << 18, 1 << 16, 3)
    filter_, places = np.frombuffer(held, np.uint8), line_dedup._places(np.asarray(list(seen), np.int64), bits)
    inside = line_dedup._holds(filter_, places[0]) & line_dedup._holds(filter_, places[1])
    assert bits == 1 << 16 and len(held) == bits // 8 and sum(inside) < len(seen) // 50
    assert all(i for i, n in zip(inside, seen.values()) if n >= 3)


def test_quality(spark, small, odd, empty):
    docs, labels = (common.table(spark, small, n) for n in ("documents", "labels"))
    scored = queries.op7_quality(spark, small)
    rows = scored.join(labels, "doc_id").where("held_out").toPandas()
    assert (rows["score"].between(0, 1)).all()
    good, bad = rows[rows["quality"] == 1]["score"], rows[rows["quality"] == 0]["score"]
    wins = (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean()
    assert len(bad) > 3 and wins > 0.95
    assert (rows["predicted"] == rows["quality"]).mean() > 0.9
    held = {r[0]: r[1] for r in scored.select("doc_id", "held_out").collect()}
    assert all(held[k] == (zlib.crc32(str(k).encode()) % 5 == 0) for k in held)
    trees = quality.fit(docs, labels)
    assert quality.score(odd, trees).where("score IS NULL").isEmpty() and quality.score(empty, trees).count() == 0
    assert quality.fit(docs, labels.where("false")).score(np.zeros((2, 22))).tolist() == pytest.approx([1, 1], abs=1e-5)
    # Labels of the held-out fold and other columns change nothing.
    other = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score(docs, quality.fit(docs, other)).select("doc_id", F.col("score").alias("other"))
    assert again.join(scored, "doc_id").where("other <> score").isEmpty()


def test_trees_in_arrays_are_the_trees(spark, small, odd):
    """Scores against walking each tree node by node; training does not hang on the order of rows, repeated ids or null ones."""
    docs, labels = (common.table(spark, small, n) for n in ("documents", "labels"))
    trees = quality.fit(docs, labels)
    again = quality.fit(docs.repartition(7).union(docs.limit(50)), labels)
    for one, other in zip((trees.feature, trees.above, trees.leaf), (again.feature, again.above, again.leaf)):
        assert np.array_equal(one, other)

    def walked(x):
        total = trees.start
        for feature, above, leaf in zip(trees.feature.tolist(), trees.above.tolist(), trees.leaf.tolist()):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[feature[node]] > above[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    rows = quality.score(odd.select("text"), trees).collect()
    assert max(abs(r.score - walked(quality.statistics(r.text))) for r in rows) < 1e-12


def test_null_ids_are_not_held_out(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (4, "c")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (None, 0), (4, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r.held_out for r in queries.op7_quality(spark, str(tmp_path)).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in (None, 1, 4)}


def test_repeated_rows_count_as_documents(spark, tmp_path):
    """The query and its SQL have one rule."""
    line = "a line that has enough letters"
    rows = [(1, line), (1, line), (2, line), (3, f"{line}\n{line} too"), (None, f"{line} too"), (4, f"{line} too"), (4, f"{line} too")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(queries.op6_line_dedup(spark, str(tmp_path)), con, queries.ORACLES["op6_line_dedup"]) == len(rows)
    same(queries.op6_line_dedup(spark, str(tmp_path)), brute.line_dedup(rows))


def test_trees_learn_a_step():
    x = np.random.default_rng(1).normal(size=(2000, 3))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 1)).astype(float)
    assert ((quality.train(x, y).score(x) > 0.5) == y).mean() > 0.98


def test_url_rules(spark, small, empty):
    odd_urls = [None, "", "no scheme", "://", "http://NET", "http://a.NET/x", "x://y.example.NET/en/1?q#f", "http://net?/", "http://example.net/en", "http://a.org/fr/#", "http://notnet/", "http://example.com/de/://x", "http://org/fr/x.html"]
    schema = "page_id long, url string, tokens string, host string"
    made = spark.createDataFrame([(k, u, "t", "h") for k, u in enumerate(odd_urls)] + [(3, "://", "t", "h")], schema)
    labels = common.table(spark, small, "labels")
    for pages in (made, common.table(spark, small, "pages")):
        given = [(r[0], r[1]) for r in pages.select("page_id", "url").collect()]
        rows = url_rules.judge(pages, labels, queries.RULES).select("page_id", "host", "path", "rule", "verdict").collect()
        want = sorted(brute.urls(given), key=repr)
        assert sorted([tuple(r)[:4] for r in rows], key=repr) == sorted([w[:4] for w in want], key=repr)
        kinds = {w[0]: w[4] for w in want}
        assert all(r.verdict == (kinds[r.page_id] or r.verdict) and r.verdict in ("allow", "block") for r in rows)
    assert url_rules.judge(made.where("false"), labels, queries.RULES).count() == 0


def test_mined_rules_block(spark):
    """A host and folder that go with low labels block; a host alone that does not, stays."""
    pages = spark.createDataFrame([(k, f"http://h{k % 4}.example.io/{'bad' if k % 8 == 0 else 'ok'}/{k}") for k in range(400)], "page_id long, url string")
    labels = spark.createDataFrame([(k, 0 if k % 8 == 0 else 1) for k in range(300)], "doc_id long, quality int")
    rows = {r.page_id: r.verdict for r in url_rules.judge(pages, labels, queries.RULES).collect()}
    assert all(rows[k] == ("block" if k % 8 == 0 else "allow") for k in range(400))


def test_rules_need_proof_and_not_a_share(spark):
    """Two low pages of one host prove nothing; twelve do, though they are under 0.2 % of a larger table."""
    schema = "page_id long, url string"
    few = [(k, f"http://{'chance' if k < 2 else f'n{k % 7}'}.example.io/x/{k}") for k in range(400)]
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 12, 0).otherwise(1).alias("quality"))
    some = labels.withColumn("quality", F.when(F.col("doc_id") < 2, 0).otherwise(1))
    rows = url_rules.judge(spark.createDataFrame(few, schema), some, []).collect()
    assert {r.verdict for r in rows} == {"allow"}
    host = F.when(F.col("id") < 12, "spam").otherwise(F.concat(F.lit("n"), (F.col("id") % 7).cast("string")))
    many = spark.range(20_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://"), host, F.lit(".example.io/x/"), F.col("id").cast("string")).alias("url"))
    done = url_rules.judge(many.repartition(5), labels, [])
    assert {r.page_id for r in done.where("verdict = 'block'").collect()} == set(range(12))


def test_near_groups_on_table(spark, small):
    docs = common.table(spark, small, "documents")
    want = brute.near(pairs(docs))
    assert sum(not w[3] for w in want) > 50
    same(queries.op9_near_dedup(spark, small), want)


def test_near_groups_of_odd_rows(odd, empty):
    found = near_dedup.near_groups(odd).select("doc_id", "n_shingles", "component_id", "kept")
    want = [(*w[:3], w[0] == w[2]) for w in brute.near(pairs(odd))]
    same(found, want)
    assert near_dedup.near_groups(empty).count() == 0


def test_near_groups_round_the_threshold(spark, monkeypatch):
    """Chains whose ends are not linked, and many texts just below and above the threshold in shared bands."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    draw = random.Random(3)
    words = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(150):
        own = words[:]
        for _ in range(draw.randrange(1, 7)):
            own[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(own))
    chain = words[:]
    for k in range(40):
        chain[3 * k] = f"c{k}"
        texts.append(" ".join(chain))
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.near(docs)
    assert 3 < len({w[2] for w in want}) < 150
    same(near_dedup.near_groups(frame).select("doc_id", "n_shingles", "component_id", "kept"), want)


@pytest.mark.parametrize("matrix", [4, 1000])
def test_near_groups_of_one_template(spark, monkeypatch, matrix):
    """Bands with the same members are one group; overlaps of a block are counted at once or pair by pair."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "MATRIX", matrix)
    monkeypatch.setattr(near_dedup, "COLUMNS", 50)
    draw = random.Random(8)
    texts = []
    for k in range(120):
        own = [f"w{j}" for j in range(205)]
        for j in range(draw.choice([3, 5, 6, 7])):
            own[draw.randrange(205)] = f"x{k}_{j}"
        texts.append(" ".join(own))
    docs = list(enumerate(texts))
    want = brute.near(docs)
    assert 10 < len({w[2] for w in want}) < 110
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    same(near_dedup.near_groups(frame).select("doc_id", "n_shingles", "component_id", "kept"), want)


def test_overlaps_of_sets():
    draw = np.random.default_rng(4)
    sides = [[np.unique(draw.integers(0, 60, draw.integers(1, 40))).astype(np.uint64) for _ in range(n)] for n in (7, 11)]
    want = [[len(set(a) & set(b)) for b in sides[1]] for a in sides[0]]
    assert near_dedup.overlaps(*sides).tolist() == want
    assert near_dedup.overlaps([np.arange(3, dtype=np.uint64)], [np.arange(5, 9, dtype=np.uint64)]).tolist() == [[0]]


def test_registers_estimate_overlap():
    draw = np.random.default_rng(2)
    for share in (0.5, 0.75, 0.9):
        both = draw.integers(0, 2**64, int(2000 * share), dtype=np.uint64)
        a, b = (np.concatenate([both, draw.integers(0, 2**64, 1000 - len(both) // 2, dtype=np.uint64)]) for _ in "ab")
        x, y = near_dedup.registers(a), near_dedup.registers(b)
        true = len(both) / (len(a) + len(b) - len(both))
        one = np.array
        found, possible = near_dedup.likely(one([(x == y).sum()]), one([(x > y).sum()]), one([float(len(a))]), one([float(len(b))]))
        assert abs(found[0] - true) < 0.12 and (possible[0] or true < 0.75)
        assert (np.maximum(x, y) == near_dedup.registers(np.union1d(a, b))).all()


def test_shards_are_the_ranges_of_keys(spark, small, odd):
    """Shard and slot of every row, from the rows in the order of their keys and the running sum of their bytes."""
    for docs, count in ((common.table(spark, small, "documents"), 40), (odd, 4)):
        rows = []
        for doc_id, text in pairs(docs):
            raw = (text or "").encode()
            key = xxhash.xxh64_intdigest(raw, 42)
            rows.append((key - (key >> 63 << 64), -(2**63) if doc_id is None else doc_id, len(raw) + 16))
        rows.sort()
        total, before, want, slots = sum(r[2] for r in rows), 0, [], Counter()
        for _, doc_id, size in rows:
            shard = min(int((2 * before + size) * count / (2 * total)), count - 1)
            want.append((doc_id, size, shard, slots[shard]))
            slots[shard] += 1
            before += size
        got = [(-(2**63) if r.doc_id is None else r.doc_id, r["size"], r.shard, r.slot) for r in shards.assign(docs, shards=count).collect()]
        assert sorted(got) == sorted(want)


#: names the operators use for columns of their own
CLASHES = [
    "row", "size", "key", "keys", "hashes", "suspects", "flags", "band", "bands", "node", "root", "n", "spans", "found", "kind", "score",
    "text_hash", "text_sha256", "of_id", "of_hash", "of_text", "recipe", "kept", "keep_id", "group_size", "set_hash", "doc", "range", "shard",
    "next", "hot", "salt", "rows", "words", "windows", "items", "item_id", "n_words", "labelled", "quality", "component_id", "length", "start", "ids",
]


@pytest.mark.parametrize("name", [
    "exact", "leaks", "personal", "redacted", "packed", "lines", "scored", "near", "shards", "phrases", "chats", "pages",
])
def test_clashing_columns_change_nothing(spark, small, odd, name):
    docs, more = odd.select("doc_id", "text"), {c: F.lit("clash") for c in CLASHES}
    items = common.table(spark, small, "benchmark")
    turns = common.table(spark, small, "conversations").limit(50)
    pages, labels = (common.table(spark, small, n) for n in ("pages", "labels"))
    trees = quality.fit(common.table(spark, small, "documents"), labels)
    spans = pii.find_personal_data(docs)
    run = {
        "exact": exact_dedup.exact_groups, "leaks": lambda d: decontaminate.contamination(d, items),
        "personal": pii.find_personal_data, "redacted": lambda d: pii.redact(d, spans).select("doc_id", "text"),
        "packed": lambda d: pack.pack(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("sequence_id"),
        "lines": line_dedup.drop_repeated_lines, "scored": lambda d: quality.score(d, trees).select("doc_id", "text", "score"),
        "near": near_dedup.near_groups, "shards": lambda d: shards.assign(d).drop("slot"),
        "phrases": lambda d: phrases.collocations(d.withColumn("lang", F.lit("en"))),
        "chats": lambda d: chat.format_chats(d).select("conv_id", "formatted"),
        "pages": lambda d: url_rules.judge(d, labels, queries.RULES).select("page_id", "host", "path", "rule", "verdict"),
    }[name]
    given = {"chats": turns, "pages": pages.select("page_id", "url")}.get(name, docs)
    assert sorted(map(str, run(given.withColumns({c: v for c, v in more.items() if c not in given.columns})).collect())) == sorted(map(str, run(given).collect()))


def test_shards(spark, small, odd, empty):
    for docs, count in ((common.table(spark, small, "documents"), 40), (odd, 4)):
        found = shards.assign(docs, shards=count).toPandas()
        given = pairs(docs)
        want = sorted(((i if i is not None else -1), len((t or "").encode()) + 16, brute.crc(t)) for i, t in given)
        got = sorted(zip(found["doc_id"].fillna(-1).astype(int), found["size"], found["text_crc32"]))
        assert got == want and found["grown_shard"].isna().all() and (found["law"] == "bytes").all()
        for _, one in found.groupby("shard"):
            assert sorted(one["slot"]) == list(range(len(one)))
        sums = found.groupby("shard")["size"].sum()
        assert (sums - found["size"].sum() / count).abs().max() <= 2 * found["size"].max()
    assert shards.assign(empty).count() == 0
    copies = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "the same").otherwise(F.col("id").cast("string")).alias("text"))
    even = shards.assign(copies).groupBy("shard").agg(F.sum("size").alias("n")).toPandas()["n"]
    assert len(even) == 40 and even.max() - even.min() <= 2 * 24


def test_estimates_of_many_pairs_take_little_memory():
    draw = np.random.default_rng(1)
    n = 10_000
    sets = [pd.Series(list(map(bytes, draw.integers(0, 256, (n, 2 * near_dedup.REGISTERS), dtype=np.uint8)))) for _ in "ab"]
    sets[1][:50] = sets[0][:50]
    sizes = pd.Series(np.full(n, 100))
    tracemalloc.start()
    found = near_dedup._estimated(sizes, sets[0], sizes, sets[1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found["possible"].to_numpy().nonzero()[0].tolist() == [*range(50)] and (found["overlap"][:50] == 1).all()
    assert peak < 16 << 20
