"""Importance resampling against zlib, regular expressions and a plain sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ventilake.llm import importance as im
from ventilake.llm import queries as q
from ventilake.llm.common import table

from conftest import SF_SMALL

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    w = WORD.findall((text or "").translate(UPPER))
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, buckets=10_000, percent=5, min_words=20, seed=42):
    bucket = lambda g: zlib.crc32(g.encode("utf-8", "surrogatepass")) % buckets
    s = Counter(bucket(g) for _, x in docs for g in grams(x)[1])
    t = Counter(bucket(g) for x in target for g in grams(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in docs:
        n, features = grams(x)
        weight = sum(gain[bucket(g)] for g in features)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


@given(st.binary(min_size=1, max_size=400), st.lists(st.tuples(st.integers(0, 399), st.integers(1, 400)), min_size=1, max_size=20))
@settings(max_examples=150)
def test_folded_checksums(data, spans):
    spans = [(a % len(data), min(len(data), a % len(data) + n)) for a, n in spans]
    starts, ends = (np.array(x, dtype=np.int64) for x in zip(*spans, strict=True))
    for distances in (1, 3, 64):
        got = im.Checksums(distances).folded(np.frombuffer(data, dtype=np.uint8), starts, ends)
        assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


@given(st.lists(st.text(alphabet="abZ 09.\n-é漢\U0001f600_\x00", max_size=80), max_size=8))
@settings(max_examples=200)
def test_features_of_texts(texts):
    for distances, block in ((64, 1 << 18), (5, 16)):
        features = im.Features(10_000, 3, distances, block)
        got, words = Counter(), Counter()
        for first, some in features.blocks(texts):
            for text, bucket in features.of(some):
                (words if len(bucket) and bucket[0] < 0 else got).update(zip((text + first).tolist(), bucket.tolist(), strict=True))
        want = Counter((k, zlib.crc32(g.encode()) % 10_000) for k, x in enumerate(texts) for g in grams(x)[1])
        assert got == want
        assert {k: n for (k, _), n in words.items()} == {k: n for k, x in enumerate(texts) if (n := grams(x)[0])}


def _docs():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(200)] + ["É", "Straße", "漢字", "x" * 90]
    rows = [(k, " ".join(rng.choice(vocabulary, rng.integers(1, 60)))) for k in range(300)]
    long = " ".join(rng.choice(vocabulary, 60_000))
    return rows + [(300, long), (301, None), (302, ""), (303, " .,\n\x00"), (7, rows[7][1]), (None, rows[9][1]), (None, rows[9][1]), (304, "q" * 200_000), (305, "Z" * 70 + " a b" * 12)]


TARGET = ["w1 w2 w3 w1 w2 w3", None, "", "Straße w5 É", "w1 w2 w3 w1 w2 w3"]


@pytest.mark.parametrize("options", [{}, {"buckets": 97, "percent": 40, "min_words": 5, "seed": 1}, {"percent": 100, "min_words": 0}])
def test_resampling_equals_brute_force(spark, options):
    docs = _docs()
    df = spark.createDataFrame(docs, DOCS).withColumns({"weight": F.lit("w"), "rank": F.lit(1), "place": F.lit(2), "part": F.lit(3)})
    out = im.importance_resample(df.repartition(5), spark.createDataFrame([(t,) for t in TARGET], "text string"), **options)
    got = sorted(map(tuple, out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    want = brute(docs, TARGET, **options)
    # equal rows (a repeated id with one text) may share out their ranks either way
    assert got == want


def test_empty_tables(spark):
    empty, target = spark.createDataFrame([], DOCS), spark.createDataFrame([], "text string")
    assert im.importance_resample(empty, target).collect() == []
    rows = im.importance_resample(spark.createDataFrame(_docs()[:40], DOCS), target).collect()
    assert sorted((r["doc_id"], r["weight"]) for r in rows) == sorted((i, w) for i, _, w, *_ in brute(_docs()[:40], []))


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    target = [r["text"] for r in table(spark, SF_SMALL, "benchmark").collect()]
    assert sorted(map(tuple, q.op12_importance_resampling(spark, SF_SMALL).collect()), key=str) == brute(docs, target)
