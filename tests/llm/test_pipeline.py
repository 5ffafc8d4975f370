"""The pipeline against brute force, stage by stage, and over awkward rows."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulsebar.llm import common, quality
from pulsebar.sources import workdir
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
#: names the stages use themselves
CLASHES = ["score", "own_id", "own_hash", "of_id", "of_hash", "kept", "text_hash", "doc", "labelled", "quality", "n_hit", "count"]


@pytest.fixture(scope="module")
def items(spark):
    return [tuple(r) for r in common.table(spark, SMALL, "benchmark").select("item_id", "text").collect()]


def expected(spark, docs, items):
    trees = quality.fit(docs, common.table(spark, SMALL, "labels"))
    rows = [(r.doc_id, r.text) for r in quality.score(docs, trees).where("score >= 0.3").select("doc_id", "text").collect()]
    rows = {(i, t): None for i, t in rows}
    dropped = {(e[0], t) for e, (_, t) in ((e, d) for d in rows for e in brute.exact(list(rows)) if e[0] == d[0] and e[4] == brute.sha(d[1] or "")) if not e[3]}
    rows = [d for d in rows if d not in dropped]
    rows = [d for d, n in zip(rows, brute.near(rows)) if n[3]]
    return [d for d, c in zip(rows, brute.contamination(rows, items)) if not c[5]]


def test_run(spark, items):
    from tokenizers import Tokenizer

    docs = common.table(spark, SMALL, "documents")
    left = expected(spark, docs, items)
    assert 0 < len(left) < docs.count()
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: coder.encode(t or "", add_special_tokens=False).ids + [1] for i, t in left}
    packed = corpus_pipeline.run(spark, SMALL).toPandas().sort_values(["doc_id", "start"])
    got = {i: b"".join(one["ids"]) for i, one in packed.groupby("doc_id")}
    assert set(got) == set(want)
    assert all(len(got[i]) == 4 * len(want[i]) for i in want)


def test_run_packs_the_ids(spark, items):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left = expected(spark, common.table(spark, SMALL, "documents"), items)
    want = {i: coder.encode(t or "", add_special_tokens=False).ids + [1] for i, t in left}
    packed = corpus_pipeline.run(spark, SMALL).toPandas().sort_values(["doc_id", "start"])
    got = {i: np.frombuffer(b"".join(one["ids"]), "<u4").tolist() for i, one in packed.groupby("doc_id")}
    assert got == want


def test_run_leaves_its_result_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workdir, "shared_folder", lambda session: str(tmp_path))
    packed = corpus_pipeline.run(spark, SMALL)
    (left,) = workdir.folders(spark, f"{tmp_path}/pulsebar")
    assert left.startswith("stage-packing") and packed.count() > 0


def test_stages_return_documents(spark):
    docs = common.table(spark, SMALL, "documents").withColumns({name: F.lit(name) for name in CLASHES})
    odd = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).union(docs.limit(2).withColumn("text", F.lit(None).cast("string")))
    for rows in (docs.union(odd).union(docs.limit(2)), docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, SMALL)
            assert out.columns == rows.columns and out.count() <= rows.count()
            assert all(r[name] == name for r in out.select(*CLASHES).distinct().collect() for name in CLASHES)


def test_exact_stage_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "a"), (3, None), (3, None), (None, "c"), (None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.drop_copies(spark, docs, SMALL).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(2, "a"), (2, "b"), (3, None), (None, "c")], key=repr)
