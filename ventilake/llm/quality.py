"""Quality scores learnt from preference pairs (Bradley-Terry).

Training pairs are a good and a bad document of the labels' training folds; the
probability that the good one is preferred is the logistic function of the
difference of their scores, a linear function of text statistics.  The weights
minimise the logistic loss of feature differences.  The cut is a quantile of the
training scores, the share of bad documents among all training labels; scores
are passed through a logistic curve centred there, so 0.5 is the cut.

Features, for every whole text: the shares of all 256 byte values and of pairs of
coarse character classes (square roots), word and line statistics (distinct
words, adjacent repeats, word lengths, repeated lines, shares of words that end
in punctuation or are all upper case), and the log length.

The fit reads at most ``sample`` good and ``sample`` bad rows, chosen by hash of
the id; the quantile's share is counted over all training labels.

Defined cases: null and empty texts have all features zero but a marker and are
scored like any other; without both classes every score is the share of good
labels (0.5 without labels); labels of unknown ids and null labels are not used;
a repeated label row counts once; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import fold, fresh, id_text

SAMPLE = 4_000
FOLDS = 3
HELD_OUT = 1
PAIRS = 20_000
#: coarse classes of bytes: space, line end, digit, upper, lower, stop or comma, other ASCII, non-ASCII
_CLASS = np.array(
    [
        7 if c >= 0x80 else 1 if c == 10 else 0 if c in (9, 11, 12, 13, 32) else 2 if chr(c).isdigit()
        else 3 if chr(c).isupper() else 4 if chr(c).islower() else 5 if chr(c) in ".,;:'" else 6
        for c in range(256)
    ],
    dtype=np.uint8,
)
WIDTH = 256 + 64 + 10
_BLOCK = 1 << 20


def features(text: str | None) -> np.ndarray:
    out = np.zeros(WIDTH)
    if not text:
        out[-1] = 1.0
        return out
    data = text.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, dtype=np.uint8)
    pairs = np.zeros(64, dtype=np.int64)
    for i in range(0, len(raw), _BLOCK):
        kinds = _CLASS[raw[i : i + _BLOCK + 1]]
        pairs += np.bincount(kinds[:-1] * 8 + kinds[1:], minlength=64)
    out[:256] = np.sqrt(np.bincount(raw, minlength=256) / len(raw))
    out[256:320] = np.sqrt(pairs / max(1, len(raw) - 1))
    words = data.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = data.split(b"\n")
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out[320:329] = (
        len(counts) / n,
        max(counts.values(), default=0) / n,
        repeats / n,
        min(40.0, len(data) / n) / 10,
        len(set(lines)) / len(lines),
        sum(not w[-1:].isalnum() and w[-1] < 0x80 for w in counts) / max(1, len(counts)),
        sum(w.isupper() for w in counts) / max(1, len(counts)),
        np.log1p(len(words)) / 10,
        np.log1p(len(lines)) / 10,
    )
    return out


def train(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, steps: int = 400, rate: float = 0.05, l2: float = 1e-3) -> np.ndarray:
    """Weights of the Bradley-Terry scores, from random pairs of a good and a bad row (Adam on the mean logistic loss)."""
    rng = np.random.default_rng(9)
    scale = np.concatenate([good, bad]).std(axis=0) + 1e-3
    a, b = good[rng.integers(0, len(good), pairs)] / scale, bad[rng.integers(0, len(bad), pairs)] / scale
    diff = a - b
    w, m, v = np.zeros(diff.shape[1]), np.zeros(diff.shape[1]), np.zeros(diff.shape[1])
    for t in range(1, steps + 1):
        part = diff[rng.integers(0, pairs, 512)]
        lost = 1.0 / (1.0 + np.exp(np.clip(part @ w, -30, 30)))
        grad = -(lost @ part) / len(part) + l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w / scale


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    label_id: str = "doc_id",
    sample: int = SAMPLE,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
) -> tuple[np.ndarray, float, float]:
    """Weights, cut and scale of the scores, learnt from the folds other than ``held_out``."""
    marked = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    marked = marked.where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    marked = marked.where(fold(F.col("doc_id"), folds) != held_out)
    seen, n_good = marked.agg(F.count("*"), F.coalesce(F.sum(F.expr("int(y > 0)")), F.lit(0))).first()
    share = n_good / seen if seen else 0.5
    flat = (np.zeros(WIDTH), -float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), 1.0)
    if not seen or n_good in (0, seen):
        return flat
    order = F.xxhash64("doc_id")
    chosen = [marked.where(c).orderBy(order, "doc_id").limit(sample) for c in ("y > 0", "y <= 0")]
    rows = id_text(docs, id_col, text_col).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            stats = [features(t).astype(np.float32).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"y": frame["y"], "doc_id": frame["doc_id"], "stats": stats})

    found = sorted(rows.mapInPandas(build, "y int, doc_id long, stats binary").collect(), key=lambda r: (r["doc_id"], r["stats"]))
    good, bad = (np.array([np.frombuffer(r["stats"], dtype=np.float32) for r in found if (r["y"] > 0) == kind], dtype=np.float64) for kind in (True, False))
    if not len(good) or not len(bad):
        return flat
    w = train(good, bad)
    scores = np.concatenate([good @ w, bad @ w])
    weight = np.concatenate([np.full(len(good), share / len(good)), np.full(len(bad), (1 - share) / len(bad))])
    order = np.argsort(scores, kind="stable")
    below = np.cumsum(weight[order])
    k = int(np.searchsorted(below, 1 - share))
    k = min(max(k, 0), len(order) - 2)
    cut = float((scores[order[k]] + scores[order[k + 1]]) / 2)
    spread = float(np.median(good @ w) - np.median(bad @ w))
    return w, cut, 6.0 / max(spread, 1e-6)


def with_score(docs: DataFrame, model: tuple[np.ndarray, float, float], text_col: str = "text", score_col: str = "score") -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        w, cut, scale = held.value
        raw = np.array([features(t) @ w for t in texts], dtype=np.float64)
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(scale * (raw - cut), -30, 30))), dtype="float64")

    return docs.withColumn(score_col, score(F.col(text_col).cast("string")))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT, **options) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    model = fit(docs, labels, id_col, text_col, folds=folds, held_out=held_out, **options)
    scored = with_score(id_text(docs, id_col, text_col), model)
    out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those below the cut; all columns stay."""
    model = fit(docs, labels, id_col, text_col, **options)
    (score,) = fresh(docs, "quality_score")
    return with_score(docs, model, text_col, score).where(F.col(score) >= 0.5).select(*docs.columns)
