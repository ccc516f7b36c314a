"""Classifiers by held-out accuracy, packing by exact round trip, the pipeline by its parts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ventilake.llm import packing as pk
from ventilake.llm import quality as ql
from ventilake.llm import toxicity as tx
from ventilake.llm.common import table

from conftest import SF_CHECK, SF_SMALL

DOCS = "doc_id long, text string"
TOKENIZER = pk.default_tokenizer()


def _accuracy(scored, labels, name):
    both = scored.where("held_out").join(labels, "doc_id")
    good, n = both.agg(F.avg((F.col("predicted") == F.col(name)).cast("double")), F.count("*")).first()
    return good, n


def test_toxicity_held_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    out = tx.toxicity(docs, labels)
    good, n = _accuracy(out, labels, "toxic")
    assert n > 300 and good > 0.95
    caught = out.where("held_out").join(labels.where("toxic = 1"), "doc_id").agg(F.avg("predicted")).first()[0]
    assert caught > 0.8


def test_quality_held_out(spark):
    docs, labels = (table(spark, SF_CHECK, t) for t in ("documents", "labels"))
    good, n = _accuracy(ql.quality(docs, labels), labels, "quality")
    assert n > 50 and good > 0.97


@pytest.mark.parametrize("op,name", [(tx.toxicity, "toxic"), (ql.quality, "quality")])
def test_classifiers_defined_cases(spark, op, name):
    rows = [(1, "good words"), (2, None), (3, ""), (3, ""), (None, "x"), (4, "y " * 20_000)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit("s"), "y": F.lit(1), "positive": F.lit(2)})
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (77, 1)], f"doc_id long, {name} int")
    for given in (labels, labels.limit(0)):
        out = op(docs, given).collect()
        assert len(out) == len(rows)
        assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] == (r["score"] >= 0.5) for r in out)
        folds, held = (5, 0) if name == "toxic" else (3, 1)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held) for r in out if r["doc_id"] is not None)
    assert op(docs.limit(0), labels).collect() == []


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs, labels = (table(spark, SF_SMALL, t) for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in tx.toxicity(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_packing_is_an_exact_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "<|endoftext|> it's\x00 é  12³ \n\n 🙂"), (10**6 + 3, " " * 5000), (10**6 + 4, "x" * 9000)]
    docs = docs.union(spark.createDataFrame(odd, DOCS)).withColumn("start", F.lit(1))
    pieces = pk.pack(docs, TOKENIZER, block_sequences=16).collect()
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    per_doc, per_sequence = {}, {}
    for p in pieces:
        per_doc.setdefault(p["doc_id"], []).append(p)
        per_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(per_doc) == set(ids)
    for i, own in per_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids[i])
            part = np.array(ids[i][at : at + p["length"]], dtype="<u4")
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
            at += p["length"]
        assert at == len(ids[i])
    total = 0
    for own in per_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == own[0]["sequence_length"] <= pk.CAPACITY
        total += at
    assert total / (len(per_sequence) * pk.CAPACITY) > 0.9  # blocks of 16 sequences; 128 fill over 0.99
    assert pk.pack(docs.limit(0), TOKENIZER).collect() == []


def test_repeated_and_null_ids_are_packed_one_by_one(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c")]
    got = pk.pack(spark.createDataFrame(rows, DOCS).coalesce(1), TOKENIZER).collect()
    assert sorted(str(p["doc_id"]) for p in got) == ["1", "1", "None"] and len({p["sequence_id"] for p in got}) == 1


def test_differencing_beats_taking_pieces_in_turn():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 500, 300).tolist()
    parts = pk.difference(sizes, 40)
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert sorted(i for p in parts for i in p) == list(range(300)) and len(parts) == 40
    assert max(sums) - min(sums) < 20
    in_turn = [sum(sizes[k::40]) for k in range(40)]
    assert max(sums) - min(sums) < (max(in_turn) - min(in_turn)) / 10
    assert all(sum(sizes[i] for i in p) <= 2048 for p in pk.divide(sizes, 2048))
    assert pk.divide([], 10) == [] or pk.divide([], 10) == [[]]
    assert pk.divide([10, 10, 10], 10) and len(pk.divide([10, 10, 10], 10)) == 3


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = table(spark, SF_SMALL, "documents")
    kept = docs
    sizes = [docs.count()]
    for _, stage in cp.STAGES[:-1]:
        kept = stage(spark, kept, SF_SMALL)
        assert kept.columns == docs.columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        sizes.append(kept.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]
    out = cp.run(spark, SF_SMALL)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.collect()}
    norm = ["".join(r["text"].split()) for r in kept.collect()]
    assert len(norm) == len(set(norm))


def test_the_toxicity_sample_is_trained_on_by_a_task(spark, monkeypatch):
    texts = [f"vile {w} talk" if i % 3 == 0 else f"kind {w} talk" for i, w in enumerate("abcdefghij" * 6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(len(texts))], "doc_id long, toxic int")

    def gathered(self):
        raise AssertionError("the sample came to the driver")

    monkeypatch.setattr(type(docs), "toArrow", gathered)
    weights, bias = tx.fit(docs, labels)
    chosen = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5]
    sets = {i: tx.sampled(tx.columns_of(texts[i])) for i in chosen}
    order = sorted(chosen, key=lambda i: (i, sets[i].tobytes()))
    toxic = [i for i in order if i % 3 == 0]
    want, cut = tx.train([sets[i] for i in toxic], [sets[i] for i in order], len(toxic) / len(order))
    assert want.any() and (weights == want).all() and bias == cut
