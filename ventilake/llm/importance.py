"""Importance resampling towards a target distribution, over hashed word n-grams.

Features of a text are all runs of one to ``NGRAMS`` consecutive words, joined by
one space; a feature's bucket is its unsigned crc32 modulo ``buckets``.  The gain
of a bucket is the logarithm of how much more often the target has it than the
corpus, smoothed by one and taken to whole thousandths, a document's weight the
sum over its features.  Adding Gumbel noise (from a hash of the id) and taking
the highest scores draws without replacement in proportion to the weights.

The checksums come from a position table.  CRC is affine over GF(2): the checksum
of a span is the exclusive or of what each byte contributes at its distance from
the span's end, and of a constant for the span's length.  ``TABLE[distance, byte]``
holds the contributions, ``CONSTANTS[length]`` the constants, and
``bitwise_xor.reduceat`` adds up whole blocks of texts at once.  The one to three
words that end at one place share their distances, so one gather over the longest
of them, cut at the word starts, serves them all.  Spans longer than the table
are folded blockwise: the register after a block is the register before it
advanced by a block of zero bytes (a table of four times 256 entries), exclusive
or what the block contributes.

1. Both tables are counted: every task emits its counts per bucket, at most
   ``buckets`` rows, which are added up; the two sums of ``buckets`` rows reach
   the driver, whatever the corpus.
2. All documents are read again and weighted.
3. The scored rows (a few numbers each) are sorted by range, ranked by their
   place in the partition and the sizes of the partitions before it.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, found as runs
of UTF-8 bytes.  Texts are read whole, in blocks of about ``BLOCK`` bytes.

Defined cases: null, empty and wordless texts have no features and weight 0 and
are never drawn (below ``min_words``); a null id is written as nothing in the
noise's hash and ranks behind all others among ties; rows that repeat an id are
weighted and drawn one by one; an empty target or corpus counts as no features;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import checkpointed, id_text

BUCKETS = 10_000
NGRAMS = 3
SEED = 42
#: percent of the documents with at least MIN_WORDS words that are drawn
PERCENT = 5
MIN_WORDS = 20
#: distances from the end that the position table covers; longer spans are folded
DISTANCES = 64
#: bytes of text that are taken at once (a longer text is taken alone)
BLOCK = 1 << 18
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
#: the lower-cased byte of a word, 0 for bytes between words
_WORD = np.array(
    [c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0 for c in range(256)],
    dtype=np.uint8,
)


def byte_table() -> np.ndarray:
    """What a last byte contributes: the usual table of the checksum, from its polynomial."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = (x >> np.uint32(1)) ^ np.where(x & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    return x


def _advanced(x: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Registers one zero byte later."""
    return (x >> np.uint32(8)) ^ last[x & np.uint32(255)]


def position_table(distances: int = DISTANCES) -> np.ndarray:
    """Contribution of every byte at every distance from the end, ``[distance, byte]``."""
    last = byte_table()
    rows = [last]
    while len(rows) < distances:
        rows.append(_advanced(rows[-1], last))
    return np.stack(rows)


class Checksums:
    """Tables for the checksums of many spans of one buffer."""

    def __init__(self, distances: int = DISTANCES):
        self.distances = distances
        last = byte_table()
        self.table = position_table(distances).ravel()
        #: by length: the checksum of so many zero bytes
        self.constants = np.array([zlib.crc32(bytes(n)) for n in range(distances + 1)], dtype=np.uint32)
        jump = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
        for _ in range(distances):
            jump = _advanced(jump, last)
        self.jump = jump

    def _after_block(self, x: np.ndarray) -> np.ndarray:
        """Registers a whole block of zero bytes later."""
        j, byte = self.jump, np.uint32(255)
        return (
            j[0][x & byte] ^ j[1][(x >> np.uint32(8)) & byte] ^ j[2][(x >> np.uint32(16)) & byte] ^ j[3][x >> np.uint32(24)]
        )

    def _contributions(self, buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contributions of all bytes of the spans, one span after the other, and where each span begins among them."""
        begins = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum()), dtype=np.int32)
        distance = np.repeat((begins + sizes - 1).astype(np.int32), sizes) - at
        at += np.repeat((starts - begins).astype(np.int32), sizes)
        return self.table[(distance << 8) | buffer[at]], begins

    def short(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
        """Checksums of ``cut:end`` for each of ``cuts`` (each span's own starts, ascending; the first are ``starts``).

        No span may be longer than the table.  Where neighbouring cuts are equal, so are their checksums."""
        found, begins = self._contributions(buffer, starts, ends - starts)
        places = np.stack([begins + (c - starts) for c in cuts], axis=1)
        pieces = np.bitwise_xor.reduceat(found, places.ravel()).reshape(places.shape)
        # reduceat gives an element instead of nothing where a piece is empty
        pieces[:, :-1][places[:, 1:] == places[:, :-1]] = 0
        sums = np.bitwise_xor.accumulate(pieces[:, ::-1], axis=1)[:, ::-1]
        return [sums[:, k] ^ self.constants[ends - c] for k, c in enumerate(cuts)]

    def folded(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Checksums of spans of any length from one byte on, a block at a time from the front."""
        d = self.distances
        blocks = -((starts - ends) // d)
        out = np.empty(len(starts), dtype=np.uint32)
        order = np.argsort(-blocks, kind="stable")
        starts, ends, blocks = starts[order], ends[order], blocks[order]
        end = ends - (blocks - 1) * d
        sizes = end - starts
        found, begins = self._contributions(buffer, starts, sizes)
        register = self.constants[sizes] ^ _ONES ^ np.bitwise_xor.reduceat(found, begins)
        live = len(starts)
        for k in range(1, int(blocks[0])):
            live = int(np.searchsorted(-blocks[:live], -k, side="left"))
            found, begins = self._contributions(buffer, end[:live], np.full(live, d))
            register[:live] = self._after_block(register[:live]) ^ np.bitwise_xor.reduceat(found, begins)
            end[:live] += d
        out[order] = register ^ _ONES
        return out


class Features:
    """Buckets of the word n-grams of many texts."""

    def __init__(self, buckets: int = BUCKETS, ngrams: int = NGRAMS, distances: int = DISTANCES, block: int = BLOCK):
        self.buckets, self.ngrams, self.block = buckets, ngrams, block
        self.checksums = Checksums(distances)

    def blocks(self, texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
        """The texts in groups of about ``block`` bytes, each with the number of its first text."""
        first, held, size = 0, [], 0
        for k, text in enumerate(texts):
            data = text.encode("utf-8", "surrogatepass")
            if held and size + len(data) > self.block:
                yield first, held
                first, held, size = k, [], 0
            held.append(data)
            size += len(data)
        if held:
            yield first, held

    def of(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(text, bucket)`` of every feature, in pieces of bounded size; then ``(text, -1)`` of every word."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        begins = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        word = _WORD[data]
        inside = word != 0
        before = np.concatenate(([False], inside[:-1]))
        starts = np.flatnonzero(inside & ~before)
        if not len(starts):
            return
        first = np.searchsorted(starts, begins)
        text = np.searchsorted(begins, starts, side="right") - 1
        # words one after the other with one space behind each
        buffer = word[inside | before]
        buffer[buffer == 0] = 32
        sizes = np.flatnonzero(before & ~inside) - starts
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        number = np.arange(len(starts))
        # the start of the longest run that ends with each word, then of the shorter ones
        cuts = [starts[np.maximum(number - k, first[text])] for k in range(self.ngrams - 1, -1, -1)]
        there = [number - k >= first[text] for k in range(self.ngrams - 1, -1, -1)]
        long = ends - cuts[0] > self.checksums.distances
        at = np.flatnonzero(~long)
        reach = np.cumsum(ends[at] - cuts[0][at])
        splits = np.searchsorted(reach, np.arange(4 * self.block, int(reach[-1]) if len(reach) else 0, 4 * self.block))
        for some in np.split(at, np.unique(splits)):
            if len(some):
                sums = self.checksums.short(buffer, cuts[0][some], ends[some], [c[some] for c in cuts])
                for crc, has in zip(sums, there, strict=True):
                    yield text[some][has[some]], (crc[has[some]] % np.uint32(self.buckets)).astype(np.int64)
        at = np.flatnonzero(long)
        for i in range(0, len(at), 4096):
            some = at[i : i + 4096]
            for cut, has in zip(cuts, there, strict=True):
                own = some[has[some]]
                if len(own):
                    crc = self.checksums.folded(buffer, cut[own], ends[own])
                    yield text[own], (crc % np.uint32(self.buckets)).astype(np.int64)
        yield text, np.full(len(text), -1)


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, ngrams: int = NGRAMS) -> np.ndarray:
    """How often the features of all texts fall into each bucket."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(buckets, ngrams)
        total = np.zeros(buckets, dtype=np.int64)
        for frame in frames:
            for _, texts in features.blocks(frame["text"].tolist()):
                for _, bucket in features.of(texts):
                    if len(bucket) and bucket[0] >= 0:
                        total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counted = rows.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for r in counted:
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Whole thousandths of the logarithm of smoothed target share over smoothed corpus share, by bucket."""
    n, t, s = len(target), float(target.sum()), float(corpus.sum())
    ratio = [(a + 1.0) * (s + n) / ((b + 1.0) * (t + n)) for a, b in zip(target.tolist(), corpus.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from the first 32 bits of the sha256 of ``<seed>:<doc_id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", ngrams: int = NGRAMS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_features, weight``."""

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(len(gain), ngrams)
        for frame in frames:
            n = len(frame)
            words, many, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for first, texts in features.blocks(frame["text"].tolist()):
                span = slice(first, first + len(texts))
                for text, bucket in features.of(texts):
                    count = np.bincount(text, minlength=len(texts))
                    if len(bucket) and bucket[0] < 0:
                        words[span] += count
                        continue
                    many[span] += count
                    # sums of whole numbers far below 2^53 are exact in doubles
                    weight[span] += np.bincount(text, gain[bucket], len(texts)).astype(np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_words": words, "n_features": many, "weight": weight})

    return id_text(docs, id_col, text_col).mapInPandas(weigh, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list[Column], most: int, rank_col: str = "rank") -> DataFrame:
    """``rows`` with their place in the order, from 1, null beyond ``most``.

    Sorted by range, so no task holds more than its share; only the sizes of the
    partitions reach the driver."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = checkpointed(placed)
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect()))
    numbers, sizes = (np.array(x, dtype=np.int64) for x in (zip(*sizes, strict=True) if sizes else ((), ())))
    # a local table of known size, one row per partition: no shuffle of the rows
    offsets = rows.sparkSession.createDataFrame(pa.table({"part": numbers, "before": np.cumsum(sizes) - sizes}))
    rank = F.col("before") + within + 1
    out = placed.withColumn("part", part).join(offsets, "part").withColumn(rank_col, F.when(rank <= most, rank))
    return out.drop("part", "before", "place")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    buckets: int = BUCKETS,
    ngrams: int = NGRAMS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_features, weight, score, rank`` (null where not drawn)."""
    gain = gains(bucket_counts(target, target_text_col, buckets, ngrams), bucket_counts(docs, text_col, buckets, ngrams))
    rows = weighted(docs, gain, id_col, text_col, ngrams)
    rows = checkpointed(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    able = F.col("n_words") >= min_words
    most = percent * rows.where(able).count() // 100
    order = [able.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return ranked(rows, order, most)
