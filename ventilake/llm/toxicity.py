"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, all other training documents are
unlabelled: their labels are not used.  With class prior ``p``, positive risk
``Rp``, and unlabelled risk ``Ru``, the risk of a linear scorer is estimated as
``p * Rp(+1) + max(0, Ru(-1) - p * Rp(-1))``: what toxic documents add to the
unlabelled risk is taken off again, and where that estimate turns negative
(the model has learnt the sample by heart) the step is turned around instead.

A document is the set of its words: every distinct lower-cased word and the
word's first four and five characters, each hashed to a column.  A column's
weight counts once however often the word occurs, so a few toxic words decide
also in a long text.  Only columns that speak for the positive class take part
(at least ``support`` positives hold them and the prior-corrected share of
positives among the documents that do is at least ``share``), their weights are
not negative, those of rare columns shrunk (by half where one positive in 200 holds
the column), and weights below ``floor`` of the largest are set to nothing, so
the many neutral words of a long text add up to nothing.  The cut between the classes is
the one with the smallest non-negative 0-1 risk on the sample, estimated the
same way; scores are 0.5 there.

The prior is counted over all training labels.  The sample is bounded by
``positives`` and ``unlabelled`` rows, chosen by hash of the id, and
``SAMPLE_COLUMNS`` columns of each (32 KB); one task trains on it, the driver
gets the weights that are not zero, and Arrow batches are scored on the executors.

Defined cases: null and empty texts have no columns and get the intercept's
score; without positive or without unlabelled rows every score is the prior
(0 without labels); labels of unknown ids and null labels are not used; a
repeated label row counts once; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import checkpointed, fold, forget, fresh, id_text

COLUMNS = 1 << 18
POSITIVES = 4_000
UNLABELLED = 12_000
#: a sampled document brings at most this many columns, those of the smallest mixed numbers
SAMPLE_COLUMNS = 1 << 13
FOLDS = 5
#: A-Z to a-z, digits, punctuation and control characters to spaces, the rest of UTF-8 as it is
_CUT = bytes(c if c >= 0x80 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def words_of(text: str) -> set[bytes]:
    return set(text.encode("utf-8", "surrogatepass").translate(_CUT).split())


def columns_of(text: str | None, columns: int = COLUMNS) -> np.ndarray:
    """The hashed columns of a text's distinct words and word beginnings."""
    if not text:
        return np.empty(0, dtype=np.int64)
    parts = words_of(text)
    parts |= {w[:4] + b"*" for w in parts} | {w[:5] + b"*" for w in parts}
    return np.unique(np.fromiter(map(zlib.crc32, parts), dtype=np.int64, count=len(parts)) % columns)


def sampled(columns: np.ndarray, most: int = SAMPLE_COLUMNS) -> np.ndarray:
    """What a document brings into the sample; a choice of its columns, the same ones in every document, if there are very many."""
    if len(columns) > most:
        columns = np.sort(columns[np.argsort(columns * 40503 % 65521, kind="stable")[:most]])
    return columns.astype(np.int32)


class Lookup(dict):
    """Word to those of its columns that have a weight, worked out once per word."""

    def __init__(self, kept: frozenset[int], columns: int = COLUMNS, limit: int = 500_000):
        super().__init__()
        self.kept, self.columns, self.limit = kept, columns, limit

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > self.limit:
            self.clear()
        hashed = (zlib.crc32(part) % self.columns for part in (word, word[:4] + b"*", word[:5] + b"*"))
        found = self[word] = tuple(c for c in hashed if c in self.kept)
        return found


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Bags:
    """Sets of columns of many documents, one after the other."""

    def __init__(self, sets: list[np.ndarray]):
        self.ends = np.cumsum([0, *map(len, sets)])
        self.columns = np.concatenate(sets) if sets else np.empty(0, dtype=np.int64)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.ends[rows + 1] - self.ends[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.ends[rows], sizes)
        return owner, self.columns[at]


def _counts(sets: list[np.ndarray], columns: int) -> np.ndarray:
    return np.bincount(np.concatenate([np.empty(0, dtype=np.int64), *sets]), minlength=columns)


def _cut(of_positive: np.ndarray, of_unlabelled: np.ndarray, prior: float) -> float:
    """The cut of least estimated risk: missed positives, and unlabelled rows above it beyond the positives among them."""
    steps = np.unique(np.concatenate([of_positive, of_unlabelled]))
    cuts = np.concatenate([(steps[1:] + steps[:-1]) / 2, [steps[-1] + 1e-6]]) if len(steps) > 1 else steps
    missed = np.searchsorted(np.sort(of_positive), cuts) / len(of_positive)
    above = 1 - np.searchsorted(np.sort(of_unlabelled), cuts) / len(of_unlabelled)
    risk = prior * missed + np.maximum(0.0, above - prior * (1 - missed))
    best = np.flatnonzero(risk <= risk.min() + 1e-12)
    return float(cuts[best[len(best) // 2]])


def train(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    columns: int = COLUMNS,
    support: int = 3,
    share: float = 0.5,
    epochs: int = 40,
    batch: int = 512,
    rate: float = 0.5,
    l2: float = 2e-4,
    floor: float = 0.05,
    shrink: float = 0.005,
) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative risk with logistic loss (adaptive gradient steps)."""
    w, g2 = np.zeros(columns), np.full(columns, 1e-8)
    bias, b2 = float(np.log(prior / (1 - prior))), 1e-8
    n_pos, n_unl = _counts(positive, columns), _counts(unlabelled, columns)
    likely = prior * (n_pos / len(positive)) / ((n_unl + 1) / len(unlabelled))
    speaking = (n_pos >= support) & (likely >= share)
    pos, unl = (Bags([s[speaking[s]] for s in sets]) for sets in (positive, unlabelled))
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        order = rng.permutation(len(unlabelled))
        for i in range(0, len(order), batch):
            u = order[i : i + batch]
            p = rng.integers(0, len(positive), max(32, batch // 4))
            (po, pc), (uo, uc) = pos.take(p), unl.take(u)
            sp = _sigmoid(bias + np.bincount(po, w[pc], len(p)))
            su = _sigmoid(bias + np.bincount(uo, w[uc], len(u)))
            # logistic loss: -log s for +1, -log(1 - s) for -1
            negative = np.mean(-np.log1p(-su + 1e-12)) - prior * np.mean(-np.log1p(-sp + 1e-12))
            dp_plus, dp_minus, du = prior * (sp - 1) / len(p), -prior * sp / len(p), su / len(u)
            dp, dn = (dp_plus + dp_minus, du) if negative >= 0 else (-dp_minus, -du)
            grad = np.bincount(pc, dp[po], columns) + np.bincount(uc, dn[uo], columns)
            used = grad != 0
            grad[used] += l2 * w[used]
            g2 += grad * grad
            w = np.maximum(w - rate * grad / np.sqrt(g2) * used, 0.0)
            gb = float(dp.sum() + dn.sum())
            b2 += gb * gb
            bias -= 0.1 * rate * gb / np.sqrt(b2)
    w *= n_pos / (n_pos + shrink * len(positive))
    w[w < floor * w.max()] = 0.0
    (po, pc), (uo, uc) = pos.take(np.arange(len(positive))), unl.take(np.arange(len(unlabelled)))
    return w, -_cut(np.bincount(po, w[pc], len(positive)), np.bincount(uo, w[uc], len(unlabelled)), prior)


def _sample(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``positive, doc_id, columns`` of the chosen documents (``doc_id, positive``), a bounded number, kept in the shared folder."""
    rows = docs.join(F.broadcast(chosen), "doc_id")

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"positive": frame["positive"], "doc_id": frame["doc_id"], "columns": [sampled(columns_of(t)).tobytes() for t in frame["text"]]})

    return checkpointed(rows.mapInPandas(build, "positive int, doc_id long, columns binary"))


def _trained(sample: DataFrame, prior: float) -> tuple[np.ndarray, float]:
    """The model of a sample, trained by one task: only weights that are not zero come to the driver."""

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pos, unl = [], []
        for frame in frames:
            for positive, columns in zip(frame["positive"], frame["columns"], strict=True):
                (pos if positive else unl).append(np.frombuffer(columns, dtype=np.int32))
        if not pos or not unl:
            weights, bias = np.zeros(COLUMNS), float(np.log(prior / (1 - prior)))
        else:
            weights, bias = train(pos, unl, prior)
        kept = np.flatnonzero(weights)
        yield pd.DataFrame({"at": [kept.astype(np.int32).tobytes()], "weights": [weights[kept].tobytes()], "bias": [bias]})

    # the sample is in the shared folder already, so one task reads it and nothing else
    rows = sample.coalesce(1).sortWithinPartitions("doc_id", "columns").select("positive", "columns")
    model = rows.mapInPandas(learn, "at binary, weights binary, bias double").first()
    weights = np.zeros(COLUMNS)
    if model is None:  # a table without partitions
        return weights, float(np.log(prior / (1 - prior)))
    weights[np.frombuffer(model["at"], dtype=np.int32)] = np.frombuffer(model["weights"])
    return weights, model["bias"]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", label_id: str = "doc_id", positives: int = POSITIVES, unlabelled: int = UNLABELLED, folds: int = FOLDS, held_out: int = 0) -> tuple[np.ndarray, float]:
    """Weights over the hashed columns and intercept, learnt from the folds other than ``held_out``."""
    marked = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    marked = marked.where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    marked = marked.where(fold(F.col("doc_id"), folds) != held_out)
    seen, toxic = marked.agg(F.count("*"), F.sum(F.expr("int(y > 0)"))).first()
    if not seen or not toxic or toxic == seen:
        return np.zeros(COLUMNS), float(np.log(max(1e-9, (toxic or 0) / max(seen, 1)) / max(1e-9, 1 - (toxic or 0) / max(seen, 1))))
    order = F.xxhash64("doc_id")
    plus = marked.where("y > 0").orderBy(order, "doc_id").limit(positives).select("doc_id", F.lit(1).alias("positive"))
    rest = marked.orderBy(order, "doc_id").limit(unlabelled).select("doc_id", F.lit(0).alias("positive"))
    sample = _sample(id_text(docs, id_col, text_col), plus.union(rest))
    model = _trained(sample, toxic / seen)
    forget(sample)
    return model


def with_score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` and a probability-like score of its texts."""
    kept = np.flatnonzero(model[0])
    held = docs.sparkSession.sparkContext.broadcast((kept, model[0][kept], model[1]))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, weights, bias = held.value
        weight = dict(zip(at.tolist(), weights.tolist(), strict=True))
        lookup = Lookup(frozenset(weight))
        for texts in batches:
            out = []
            for text in texts:
                columns = set(chain.from_iterable(map(lookup.__getitem__, words_of(text)))) if text else ()
                out.append(bias + sum(weight[c] for c in sorted(columns)))
            yield pd.Series(_sigmoid(np.array(out, dtype=np.float64)), dtype="float64")

    return docs.withColumn(score_col, score(F.col(text_col).cast("string")))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, held_out: int = 0, **options) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    model = fit(docs, labels, id_col, text_col, folds=folds, held_out=held_out, **options)
    scored = with_score(id_text(docs, id_col, text_col), model)
    out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents scored 0.5 or more; all columns stay."""
    model = fit(docs, labels, id_col, text_col, **options)
    (score,) = fresh(docs, "toxicity")
    return with_score(docs, model, text_col, score).where(F.col(score) < 0.5).select(*docs.columns)
