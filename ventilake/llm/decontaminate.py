"""Benchmark passages in documents, found by Wu-Manber search over words.

The patterns are the benchmark's windows of ``size`` words (a shorter item is
one window).  For each window length the search keeps a table that says, for
the block of words under the end of the search window, how far the window may
move without passing an occurrence; blocks that end a pattern move it by none
and select, through a bucket keyed by that suffix block, the patterns whose
words are then compared directly.  Blocks unknown to the benchmark, nearly all
of a clean document, move the window by its length less one.

Benchmark windows are read in batches of bounded size (``batch_windows``); each
batch is broadcast and searched against all documents, its hits are written to
the shared folder and the batch is let go, and the hits are merged by id and
text, so a benchmark of any size works and gives the same rows.

Defined cases: null or wordless texts have no words and no hits; a null item id
counts as the text ``null``; items with the same text are each reported; an
empty benchmark leaves every document clean; rows that repeat an id or have none
are reported one by one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import checkpointed, fresh, id_text

WINDOW = 10
BATCH_WINDOWS = 500_000
#: A-Z to a-z, other ASCII that is no letter or digit to a space, the rest of UTF-8 as it is
_FOLD = bytes(
    c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Searcher:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, patterns: dict[tuple, list[int]], length: int):
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.patterns = patterns
        self.shift: dict = {}
        self.bucket: dict = {}
        for p in patterns:
            for end in range(self.block, length + 1):
                key = p[end - 1] if self.block == 1 else p[end - 2 : end]
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            self.bucket.setdefault(key, []).append(p)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """(start, pattern) of every occurrence."""
        n, m, shift, jump, pair = len(words), self.length, self.shift, self.jump, self.block == 2
        end = m
        while end <= n:
            key = (words[end - 2], words[end - 1]) if pair else words[end - 1]
            move = shift.get(key, jump)
            if move:
                end += move
                continue
            start = end - m
            here = tuple(words[start:end])
            for p in self.bucket[key]:
                if p == here:
                    yield start, p
            end += 1


def windows(items: list[tuple[str, str | None]], size: int) -> dict[int, dict[tuple, list[int]]]:
    """By window length: each window's words and the numbers of the items that hold it."""
    out: dict[int, dict[tuple, list[int]]] = {}
    for k, (_, text) in enumerate(items):
        w = words_of(text)
        if not w:
            continue
        m = min(size, len(w))
        for i in range(len(w) - m + 1):
            owners = out.setdefault(m, {}).setdefault(tuple(w[i : i + m]), [])
            if not owners or owners[-1] != k:
                owners.append(k)
    return out


def batches(benchmark: DataFrame, id_col: str, text_col: str, size: int, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items in batches of about ``limit`` windows each, fetched one partition at a time."""
    rows = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    batch: list[tuple[str, str]] = []
    held = 0
    for r in rows.toLocalIterator():
        batch.append((r["item"], r["text"]))
        held += max(1, len(words_of(r["text"])))
        if held >= limit:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def _hits(docs: DataFrame, held: Broadcast, size: int, every: bool) -> DataFrame:
    """``doc_id, key, n_words, hits (starts and lengths in turn), items``; documents without hits only if ``every``.

    ``key`` is the md5 of the text."""
    cache: list = []

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not cache:
            cache.append([Searcher(p, m) for m, p in sorted(windows(held.value, size).items())])
        names = [i for i, _ in held.value]
        for frame in frames:
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                words = words_of(text)
                spans: list[int] = []
                owners: set[int] = set()
                for s in cache[0]:
                    for start, p in s.find(words):
                        spans += (start, s.length)
                        owners.update(s.patterns[p])
                if every or spans:
                    key = hashlib.md5(text.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
                    out.append((doc_id, key, len(words), spans, [names[k] for k in owners]))
            yield pd.DataFrame(out, columns=["doc_id", "key", "n_words", "hits", "items"]).astype({"doc_id": "Int64"})

    return docs.mapInPandas(search, "doc_id long, key binary, n_words long, hits array<long>, items array<string>")


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        n_hit, n_items, sha = [], [], []
        for hits, items in zip(frame["hits"], frame["items"], strict=True):
            spans = np.asarray(hits, dtype=np.int64).reshape(-1, 2)
            spans = spans[np.argsort(spans[:, 0], kind="stable")]
            covered, reach = 0, 0
            for start, length in spans.tolist():
                covered += max(0, start + length - max(start, reach))
                reach = max(reach, start + length)
            names = sorted(set(items))
            n_hit.append(covered)
            n_items.append(len(names))
            sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_words": frame["n_words"], "n_hit": n_hit, "n_items": n_items, "items_sha256": sha})


def _passes(rows: DataFrame, parts: Iterable[list[tuple[str, str]]], size: int) -> DataFrame:
    """The hits of several batches, merged by id and text: again one row per input row."""
    found = None
    for k, items in enumerate(parts):
        held = rows.sparkSession.sparkContext.broadcast(items)
        # rows that repeat id and text have the same hits, which are kept once, and counted in the first pass
        part = _hits(rows, held, size, every=k == 0).groupBy("doc_id", "key").agg(
            *[F.first(c).alias(c) for c in ("n_words", "hits", "items")], F.count("*").alias("copies")
        )
        part = checkpointed(part if k == 0 else part.withColumn("copies", F.lit(0).cast("long")))
        held.destroy()
        found = part if found is None else found.union(part)
    merged = found.groupBy("doc_id", "key").agg(
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.flatten(F.collect_list("items")).alias("items"),
        F.sum("copies").alias("copies"),
    )
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, size: int, batch_windows: int) -> DataFrame:
    rows = id_text(docs, id_col, text_col)
    share = docs.sparkSession.sparkContext.broadcast
    rest = batches(benchmark, item_col, item_text_col, size, batch_windows)
    first, second = next(rest, []), next(rest, None)
    if second is None:
        return _hits(rows, share(first), size, every=True)
    return _passes(rows, chain([first, second], rest), size)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
    batch_windows: int = BATCH_WINDOWS,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    merged = _found(docs, benchmark, id_col, text_col, item_col, item_text_col, size, batch_windows)
    out = merged.mapInPandas(_digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string")
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
    batch_windows: int = BATCH_WINDOWS,
) -> DataFrame:
    """``docs`` without the rows whose text (named by its md5) holds a benchmark window, whatever their id; all columns stay."""
    (key,) = fresh(docs, "text_md5")
    bad = _found(docs, benchmark, id_col, text_col, item_col, item_text_col, size, batch_windows).where(F.size("hits") > 0)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn(key, F.unhex(F.md5(text.cast("binary"))))
    return keyed.join(bad.select(F.col("key").alias(key)).distinct(), key, "left_anti").select(*docs.columns)
