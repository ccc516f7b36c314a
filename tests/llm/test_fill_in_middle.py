"""Fill-in-middle: rotations, exact round trips, and the registered query against plain slicing."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ventilake.llm import fill_in_middle as fim
from ventilake.llm import queries as q

DOCS = "doc_id long, text string"
TEXTS = [
    (1, "one\ntwo\nthree\nfour"), (2, "no line end"), (3, "\n"), (4, "\n\n\n"), (5, ""), (6, None), (7, "a<P>b\nc\nd"),
    (8, "é\nü ß\n漢字\n\U0001f600\n"), (8, "another text\nwith the same id\n"), (None, "no id\nat all\n"), (9, "<\nS>\n<M\n>"),
    (10, "<S\n<P\nM>\n" * 50), (11, "line\r\nwith\rreturns\x0b\n\x00 and nul\n"), (12, "x" * 300_000), (13, "y\n" * 40_000),
    (-14, "negative\nid\n"), (15, "one\ntwo\nthree\nfour"),
]


def brute(doc_id, text, seed=7, rate=100, spm=50):
    """The contract by regular expression and slicing."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(st.binary(max_size=40), st.tuples(*[st.integers(0, 40)] * 3))
def test_rotation_exchanges_segments(data, at):
    a, m, b = sorted(min(x, len(data)) for x in at)
    buffer = bytearray(data)
    fim.rotate(buffer, a, m, b)
    assert bytes(buffer) == data[:a] + data[m:b] + data[a:m] + data[b:]


@settings(max_examples=300)
@given(st.text(alphabet="<>PSM\n aé漢", max_size=60), st.integers(0, 10**9), st.integers(0, 10**9), st.sampled_from(["psm", "spm"]))
def test_round_trip(text, h1, h2, form):
    data = text.encode()
    if fim.form_of(data, 0, 0) == "plain":
        form = "plain"
    ends = [0, *fim.unit_ends(data).tolist()]
    assert len(ends) - 1 == len(re.findall(r"[^\n]*\n|[^\n]+", text))
    cut, end = sorted((ends[h1 % len(ends)], ends[h2 % len(ends)]))
    output = fim.transform(data, form, cut, end)
    p, m, s = data[:cut], data[cut:end], data[end:]
    assert bytes(output) == {"plain": data, "psm": b"<P>" + p + b"<S>" + s + b"<M>" + m, "spm": b"<S>" + s + b"<P>" + p + b"<M>" + m}[form]
    assert bytes(fim.restore(bytes(output), form)) == data


@pytest.mark.parametrize("options", [{}, {"rate": 40, "spm": 10, "seed": 3}, {"spm": 100}, {"spm": 0}])
def test_transform_equals_slicing(spark, options):
    # extra columns with clashing names play no part
    df = spark.createDataFrame(TEXTS, DOCS).withColumns({"output": F.lit("o"), "form": F.lit(1), "n": F.lit(2), "draws": F.lit(3)})
    out = fim.fill_in_middle(df, **options)
    rows = out.withColumn("again", fim.restored("output", "form")).collect()
    got = sorted([tuple(r)[:6] for r in rows], key=str)
    assert got == sorted([brute(i, t, **options) for i, t in TEXTS], key=str)
    assert sorted((r["doc_id"] or 0, r["again"]) for r in rows) == sorted((i or 0, t or "") for i, t in TEXTS)
    assert len(set(r["form"] for r in rows)) > 1


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []


def test_query_digests(spark, tmp_path):
    """The registered query over whole tables, against slicing; independent of partitioning."""
    results = []
    for parts in (1, 5):
        spark.createDataFrame(TEXTS, DOCS).repartition(parts).write.parquet(f"{tmp_path}/{parts}/documents.parquet")
        results.append(sorted(map(tuple, q.op13_fill_in_middle(spark, f"{tmp_path}/{parts}").collect()), key=str))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in TEXTS:
        *head, output = brute(i, t)
        want.append((*head, sha(output), sha(t or "")))
    assert results[0] == results[1] == sorted(want, key=str)
