"""The corpus pipeline against brute force, stage by stage, and its registration."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tagloom.llm import quality, toxicity
from tagloom.sources.storage import materialise
from tests.llm.test_similar import slow_components, slow_fingerprint
from tests.llm.test_tokens import check_packed


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "toxicity", "simhash near-dedup", "packing"]
    for name, module, wanted in (("quality classifier", quality, 1), ("toxicity", toxicity, 0)):
        kept = materialise(stages[name](spark, docs, folder))
        judged = module.classify(docs, labels).collect()
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in judged if r["predicted"] == wanted)
        assert kept.columns == columns
        docs = kept
    rows = docs.collect()
    groups = slow_components([r["doc_id"] for r in rows], [slow_fingerprint(r["text"] or "") for r in rows])
    kept = stages["simhash near-dedup"](spark, docs, folder)
    left = sorted(kept.collect(), key=lambda r: r["doc_id"])
    assert kept.columns == columns
    assert [tuple(r) for r in left] == sorted(tuple(r) for r, g in zip(rows, groups, strict=True) if r["doc_id"] == g)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = [(r["doc_id"], [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in left]
    pieces = stages["packing"](spark, kept, folder).collect()
    check_packed(pieces, wanted, 2048)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in whole.collect() if r["start"] == 0 and r["length"] == r["doc_tokens"])
    assert {r["doc_id"] for r in whole.collect()} == {r["doc_id"] for r in left}


def test_stages_of_odd_documents(spark, odd, nothing, folder):
    for docs in (odd, nothing):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, docs, folder)
            if number + 1 < len(corpus_pipeline.STAGES):
                assert made.columns == docs.columns
            made.collect()


def test_documents_stay_where_nothing_can_be_learned(spark, odd):
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        for rows in ([], [(3, 1), (4, 1)], [(10**9 + k, k % 2) for k in range(50)]):  # none, one class, other documents
            labels = spark.createDataFrame(rows, f"doc_id bigint, {label} int")
            kept = module.keep(odd, labels)
            assert kept.columns == odd.columns and kept.count() == odd.count()


def test_labels_of_other_documents_do_not_fill_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"{'good calm' if k % 2 else 'bad loud'} words number {k}") for k in range(400)], "doc_id bigint, text string")
    rows = [(k, k % 2) for k in range(400)] + [(10**6 + k, k % 2) for k in range(4000)]
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        monkeypatch.setattr(module, "FIT_ROWS", 150)
        made = [
            {r["doc_id"]: r["score"] for r in module.classify(docs, spark.createDataFrame(x, f"doc_id bigint, {label} int")).collect()}
            for x in (rows, rows[:400])
        ]
        assert made[0] == made[1]
        right = [(score > 0.5) == bool(k % 2) for k, score in made[0].items()]
        assert sum(right) > 0.9 * len(right)


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert corpus_pipeline.ORACLE_SQL is None
