"""Paragraphs and passages that repeat across documents, by MinHash banding.

Two kinds of units are compared, as one set each of five-word shingles:

- paragraphs: every line, and every block of lines between blank lines; one of
  fewer than five words is one shingle;
- windows, for passages that are copied into the middle of lines: stretches of
  ``WORDS_PER_UNIT`` words that start where the text itself says so.  Of every
  ``stretch`` consecutive positions the one with the smallest hash of its five
  words starts a window.  With 24 words and 28 positions any run of 51 words or
  more that two documents share holds at least one window that is the same in
  both, wherever the run begins.

1. All texts are cut once, some at a time in one array; each document's units are kept
   packed, 25 bytes a unit and the bands of its paragraphs.  A unit is named by 128 bits of its set.
2. Units of one name are combined map-side first, so copies cost one row however
   often they occur.  Equal windows need no more: a passage holds one that is the
   same in both documents.
3. Distinct paragraphs get bands of three MinHash values, ten each: a pair at
   Jaccard 0.8 is missed with probability 7.7e-4, at 0.9 with 2e-6.  Those that
   share a band are compared on their full sets (exact Jaccard) by the rounds of
   hubs that ``near_dedup`` describes, never in all pairs.  Until then only they
   and the units that occur in several documents are kept.
4. Components of similar classes that occur in two or more documents are the
   repeats.  One occurrence, in the smallest id at the smallest position, stays;
   all others are to be removed, save units of the same document that overlap it.
5. A window to be removed is aligned with the first document that has the same
   set, or else with what stays.  Windows that follow each other at one distance
   from there are one run.  Each run is extended as long as both documents go on
   alike word by word (names of stretches, doubled and then narrowed); runs that go over
   into each other are followed as one.  Every window is reported with the span of its run;
   a paragraph is reported as it is.

``repeated_paragraphs`` does all of this.  ``repeated_passages`` reports the
windows alone, without step 5.

Defined cases: null, empty and blank texts have no units; repeats within one
document alone are no repeats; rows that repeat an id count as one document (a
run of theirs is extended on one of their texts); a null id is left out; an
empty table gives an empty result; other columns are not read.  Words are split
at ``[\\x20\\x09-\\x0D]``, lines at ``\\x0A``, and A-Z lower-cased; positions
count words.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ventilake.llm.common import checkpointed, forget, id_text, remove, written
from ventilake.llm.near_dedup import WORDS, class_components, multipliers, shingle_hashes, words_of

WORDS_PER_UNIT = 24
#: shared runs of this many words hold a common window for certain
RUN = 51
PARAGRAPH_BANDS = 10
#: sets of fewer shingles are similar to no other set at the threshold (4 and 5 shingles can reach 0.8)
LEAST = 4
ROWS = 3
#: 64-bit words of the cells that bound what two sets share; tight for sets of up to some hundred shingles
CELL_WORDS = 16
#: similarity threshold in hundredths
THRESHOLD = 80
_ODD = np.uint64(0x9E3779B97F4A7C15)


def starts_of(hashes: np.ndarray, per_unit: int, stretch: int) -> np.ndarray:
    """Positions where windows start: the smallest hash of each stretch of positions, the first of equals.

    Where equal hashes follow each other closer than a stretch, only the first
    of them starts one, so repeated words do not start one at every position."""
    n = len(hashes) - (per_unit - WORDS)
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    h = hashes[:n] * _ODD
    h ^= h >> np.uint64(31)
    if n <= stretch:
        return np.array([int(h.argmin())])
    at = np.unique(np.lib.stride_tricks.sliding_window_view(h, stretch).argmin(axis=1) + np.arange(n - stretch + 1))
    if (h[at[1:]] == h[at[:-1]]).any():
        kept = [int(at[0])]
        for p in at[1:].tolist():
            if h[p] != h[kept[-1]] or p - kept[-1] >= stretch:
                kept.append(p)
        at = np.array(kept)
    return at


def _mixed(shingles: np.ndarray, factor: int) -> np.ndarray:
    mixed = (shingles ^ (shingles >> np.uint64(33))) * np.uint64(factor)
    return mixed ^ (mixed >> np.uint64(29))


#: two independent sums over a set's shingles name it
_NAMES = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def paragraphs(text: str | None) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words of a text, and start and length in words of its lines and of its blocks of several lines."""
    words: list[bytes] = []
    spans: list[tuple[int, int]] = []
    lines, begin = 0, 0
    for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"):
        own = line.split()
        if own:
            spans.append((len(words), len(own)))
            words += own
            lines += 1
            continue
        if lines > 1:
            spans.append((begin, len(words) - begin))
        lines, begin = 0, len(words)
    if lines > 1:
        spans.append((begin, len(words) - begin))
    return words, spans


def span_sets(words: list[bytes], hashes: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all spans one after the other, sorted within each; where each begins; first of equals; the two numbers that name each set."""
    parts = [
        hashes[a : a + n - WORDS + 1] if n >= WORDS else np.array([xxhash.xxh3_64_intdigest(b" ".join(words[a : a + n]))], dtype=np.uint64)
        for a, n in spans
    ]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    every, of = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
    every = every[np.lexsort((every, of))]
    first = np.ones(len(every), dtype=bool)
    first[1:] = every[1:] != every[:-1]
    first[begins] = True
    size = np.add.reduceat(first.astype(np.uint64), begins)
    names = [np.add.reduceat(_mixed(every, f) * first, begins) + size for f in _NAMES]
    return every, begins, first, np.stack(names, axis=1).view(np.int64)


def _folded(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)


def _keys(low: np.ndarray) -> np.ndarray:
    """Band keys of sets, ``[set, band]``, from their smallest images ``[permutation, set]``."""
    low = low.astype(np.uint64).reshape(-1, ROWS, low.shape[1])
    keys = np.repeat(np.arange(1, len(low) + 1, dtype=np.uint64)[:, None], low.shape[2], axis=1)
    for k in range(ROWS):
        keys = (keys ^ low[:, k]) * _ODD
        keys ^= keys >> np.uint64(29)
    return np.ascontiguousarray(keys.T).view(np.int64)


def _repeating(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each hash the place of the last equal one before it in its text, -1 if there is none."""
    last = np.full(len(hashes), -1, dtype=np.int64)
    texts = np.flatnonzero(ends > begins)
    bits = np.uint64(len(begins).bit_length())
    of = np.repeat(texts.astype(np.uint64), (ends - begins)[texts])
    every = np.concatenate([hashes[a:b] for a, b in zip(begins[texts], ends[texts], strict=True)] or [hashes[:0]])
    # equal in the leading bits within one text: only these texts are looked at closely
    keys = np.sort((of << (np.uint64(64) - bits)) | (every >> bits))
    for i in np.unique(keys[1:][keys[1:] == keys[:-1]] >> (np.uint64(64) - bits)).tolist():
        own = hashes[begins[i] : ends[i]]
        order = np.argsort(own, kind="stable")
        same = np.flatnonzero(own[order[1:]] == own[order[:-1]])
        last[begins[i] + order[same + 1]] = begins[i] + order[same]
    return last


def _over(ufunc: np.ufunc, values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``ufunc`` over each ``values[begin:end]`` of the last axis, none of them empty."""
    if not len(begins):
        return values[..., :0]
    # one value more, as an end may be the array's
    values = np.concatenate([values, values[..., -1:]], axis=-1)
    return ufunc.reduceat(values, np.stack([begins, ends], axis=1).ravel(), axis=-1)[..., ::2]


def _first_lowest(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest value of each stretch of ``width``, the first of equals."""
    at, reach = np.arange(len(h)), 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = at[: len(at) - step], at[step:]
        at, reach = np.where(h[b] < h[a], b, a), reach + step
    return at


def _starts_in(hashes: np.ndarray, begins: np.ndarray, lengths: np.ndarray, per_unit: int, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts_of`` for texts of so many words that begin there: the starts, in order, and the texts they are in."""
    places = lengths - per_unit + 1
    h = hashes * _ODD
    h ^= h >> np.uint64(31)
    long = np.flatnonzero(places > stretch)
    windows = (places - stretch + 1)[long]
    text = np.repeat(long, windows)
    first = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows - begins[long], windows)
    at = _first_lowest(h, stretch)[first] if len(first) else first
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1]
    at, text = at[new], text[new]
    # texts of one stretch at most, or with equal hashes one after the other, by themselves
    tied = np.unique(text[1:][(h[at[1:]] == h[at[:-1]]) & (text[1:] == text[:-1])])
    single = np.concatenate([tied, np.flatnonzero((places > 0) & (places <= stretch))])
    if not len(single):
        return at, text
    keep = ~np.isin(text, tied)
    ats, texts = [at[keep]], [text[keep]]
    for i in single.tolist():
        own = begins[i] + starts_of(hashes[begins[i] : begins[i] + lengths[i] - WORDS + 1], per_unit, stretch)
        ats.append(own)
        texts.append(np.full(len(own), i))
    at, text = np.concatenate(ats), np.concatenate(texts)
    order = np.argsort(at)
    return at[order], text[order]


def _cut(texts: list[str], per_unit: int, run: int, of_paragraph: int, factors: np.ndarray) -> list[tuple[int, bytes, bytes, bytes, bytes]]:
    """Each text's units, packed: how many are paragraphs, (start, length) of all, names, sizes, and the paragraphs' bands.

    Paragraphs come first; those of fewer than ``LEAST`` shingles have no bands.  The
    texts follow each other in one array; a shingle that reaches into the next text is in no unit."""
    words: list[bytes] = []
    spans: list[tuple[int, int]] = []
    begins, many = [], []
    for text in texts:
        own, of_text = paragraphs(text)
        begins.append(len(words))
        many.append(len(of_text) if of_paragraph else 0)
        if of_paragraph:
            spans += [(len(words) + a, n) for a, n in of_text]
        words += own
    begin = np.array(begins, dtype=np.int64)
    lengths = np.diff(begin, append=len(words))
    hashes = shingle_hashes(words)
    starts, window_of = _starts_in(hashes, begin, lengths, per_unit, run - per_unit + 1)
    at = np.concatenate([np.array(spans, dtype=np.int64).reshape(-1, 2), np.stack([starts, np.full(len(starts), per_unit)], axis=1)])
    text = np.concatenate([np.repeat(np.arange(len(texts)), many), window_of])
    paragraph = np.arange(len(at)) < len(spans)

    # sums over the shingles of a unit, as differences of sums from the beginning
    size, names = np.ones(len(at), dtype=np.int64), np.empty((len(at), 2), dtype=np.uint64)
    whole = np.flatnonzero(at[:, 1] >= WORDS)
    low, high = at[whole, 0], at[whole].sum(axis=1) - WORDS + 1
    size[whole] = high - low
    for k, factor in enumerate(_NAMES):
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_mixed(hashes, factor), dtype=np.uint64)])
        names[whole, k] = sums[high] - sums[low] + size[whole].astype(np.uint64)
    # a shingle counts once in a unit
    last = _repeating(hashes, begin, begin + np.maximum(lengths - WORDS + 1, 0))
    again = np.flatnonzero(_over(np.maximum, last, low, high) >= low) if (last >= 0).any() else []
    for i in again:
        own = np.unique(hashes[low[i] : high[i]])
        size[whole[i]] = len(own)
        names[whole[i]] = [_mixed(own, f).sum(dtype=np.uint64) + np.uint64(len(own)) for f in _NAMES]
    short = np.flatnonzero(at[:, 1] < WORDS)
    if len(short):
        own = np.array([xxhash.xxh3_64_intdigest(b" ".join(words[a : a + n])) for a, n in at[short].tolist()], dtype=np.uint64)
        for k, factor in enumerate(_NAMES):
            names[short, k] = _mixed(own, factor) + np.uint64(1)

    on = np.flatnonzero(paragraph & (size >= LEAST))
    keys, folded = np.empty((0, of_paragraph), dtype=np.int64), _folded(hashes)
    if len(on):
        step = max(1, (1 << 22) // len(folded))
        low, high = at[on, 0], at[on].sum(axis=1) - WORDS + 1
        keys = _keys(np.concatenate([_over(np.minimum, folded * factors[i : i + step, None], low, high) for i in range(0, len(factors), step)]))

    order = np.argsort(text, kind="stable")
    at[:, 0] -= begin[text]
    at, names, size = at[order].astype(np.int32), names[order], size[order].astype(np.int32)
    end = np.cumsum(np.bincount(text, minlength=len(texts))).tolist()
    banded = np.cumsum(np.bincount(text[on], minlength=len(texts))).tolist()
    out, a, k = [], 0, 0
    for n, b, m in zip(many, end, banded, strict=True):
        out.append((n, at[a:b].tobytes(), names[a:b].tobytes(), size[a:b].tobytes(), keys[k:m].tobytes()))
        a, k = b, m
    return out


#: characters of the texts that are cut together
_TOGETHER = 1 << 19


def _portions(texts: list[str]) -> Iterator[tuple[int, int]]:
    """From where to where the texts are cut together; a long text by itself."""
    begin = held = 0
    for i, text in enumerate(texts):
        if i > begin and held + len(text) > _TOGETHER:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _units(rows: DataFrame, per_unit: int, run: int, of_paragraph: int) -> DataFrame:
    """One row per document: its units, packed as by ``_cut``."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = multipliers(max(1, of_paragraph) * ROWS)
        for frame in frames:
            texts, out = frame["text"].tolist(), []
            for a, b in _portions(texts):
                out += _cut(texts[a:b], per_unit, run, of_paragraph, factors)
            out = pd.DataFrame(out, columns=["paragraphs", "at", "names", "sizes", "bands"])
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    schema = "doc_id long, paragraphs int, at binary, names binary, sizes binary, bands binary"
    return rows.where("doc_id is not null").mapInPandas(cut, schema)


def _unpacked(units: DataFrame, places: bool) -> DataFrame:
    """One row per unit: ``doc_id, k1, k2``, with ``places`` also ``start, length, is_window``."""

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), 1000):
                some = frame.iloc[i : i + 1000]
                names = np.frombuffer(b"".join(some["names"]), dtype=np.int64).reshape(-1, 2)
                many = np.array([len(v) for v in some["sizes"]]) // 4
                doc = np.repeat(some["doc_id"].to_numpy(), many)
                if not places:
                    # a unit that a document holds twice counts once
                    yield pd.DataFrame({"doc_id": doc, "k1": names[:, 0], "k2": names[:, 1]}).drop_duplicates()
                    continue
                at = np.frombuffer(b"".join(some["at"]), dtype=np.int32).reshape(-1, 2)
                within = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                window = within >= np.repeat(some["paragraphs"].to_numpy(), many)
                yield pd.DataFrame({"doc_id": doc, "k1": names[:, 0], "k2": names[:, 1], "start": at[:, 0], "length": at[:, 1], "is_window": window})

    schema = "doc_id long, k1 long, k2 long" + (", start int, length int, is_window boolean" if places else "")
    columns = ["doc_id", "paragraphs", "names", "sizes"] + (["at"] if places else [])
    return units.select(*columns).mapInPandas(unpack, schema)


def _banded(units: DataFrame, of_paragraph: int) -> DataFrame:
    """One row per paragraph that has bands, repeated ones of a batch once: ``k1, k2, n_shingles, bands, doc_id, start, length``."""

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), 1000):
                some = frame.iloc[i : i + 1000]
                many = np.array([len(v) for v in some["sizes"]]) // 4
                doc = np.repeat(some["doc_id"].to_numpy(), many)
                within = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                n = np.frombuffer(b"".join(some["sizes"]), dtype=np.int32)
                on = np.flatnonzero((within < np.repeat(some["paragraphs"].to_numpy(), many)) & (n >= LEAST))
                if not len(on):
                    continue
                names = np.frombuffer(b"".join(some["names"]), dtype=np.int64).reshape(-1, 2)[on]
                at = np.frombuffer(b"".join(some["at"]), dtype=np.int32).reshape(-1, 2)[on]
                keys = np.frombuffer(b"".join(some["bands"]), dtype=np.int64).reshape(-1, of_paragraph)
                _, first = np.unique(names, axis=0, return_index=True)
                on, names, at, keys = on[first], names[first], at[first], keys[first]
                yield pd.DataFrame({"k1": names[:, 0], "k2": names[:, 1], "n_shingles": n[on], "bands": list(keys), "doc_id": doc[on], "start": at[:, 0], "length": at[:, 1]})

    schema = "k1 long, k2 long, n_shingles long, bands array<long>, doc_id long, start int, length int"
    return units.select("doc_id", "paragraphs", "at", "names", "sizes", "bands").mapInPandas(unpack, schema)


def _read(rows: DataFrame, wanted: DataFrame, build: Callable, schema: str, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``build`` reads in the texts of the documents of ``wanted`` (``doc_id, wanted``), finished and kept in the shared folder.

    ``wanted`` is written as a table, so Spark knows its size: a small one goes to
    where the texts are read, and only a large one moves the texts."""
    folder = written(wanted)
    asked = rows.sparkSession.read.parquet(folder)
    out = checkpointed(finish(rows.join(asked, "doc_id").select("doc_id", "text", "wanted").mapInPandas(build, schema)))
    remove(rows.sparkSession, folder)
    return out


def _cells(shingles: np.ndarray) -> np.ndarray:
    """``CELL_WORDS`` words with a bit set for every cell, by leading bits, that a shingle falls in."""
    at = np.zeros(CELL_WORDS * 64, dtype=bool)
    at[shingles >> np.uint64(65 - (CELL_WORDS * 64).bit_length())] = True
    return np.packbits(at).view(np.int64)


def _sets_of(rows: DataFrame, places: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, shingles, cells`` of the wanted ids, built again at one of their places (``id, k1, k2, doc_id, start, length``)."""
    ask = ["id", "k1", "k2", "start", "length"]
    chosen = places.join(wanted, "id", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct(*ask)).alias("wanted"))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, sets, cells = [], [], []
            for text, wanted in zip(frame["text"], frame["wanted"], strict=True):
                words = words_of(text)
                some = [p for p in wanted if p["start"] + p["length"] <= len(words)]
                if some:
                    every, begins, first, own = span_sets(words, shingle_hashes(words), [(p["start"], p["length"]) for p in some])
                    ends = [*begins[1:].tolist(), len(every)]
                    for p, name, a, b in zip(some, own.tolist(), begins.tolist(), ends, strict=True):
                        # another text with this id may hold something else there
                        if name == [p["k1"], p["k2"]]:
                            ids.append(p["id"])
                            sets.append(every[a:b][first[a:b]].view(np.int64))
                            cells.append(_cells(every[a:b]))
            yield pd.DataFrame({"id": ids, "shingles": sets, "cells": cells})

    sets = _read(rows, chosen, build, "id long, shingles array<long>, cells array<long>", lambda found: found)
    if not sets.groupBy("id").count().where("count > 1").isEmpty():
        # rows that repeat a doc_id
        found, sets = sets, checkpointed(sets.dropDuplicates(["id"]))
        forget(found)
    return sets


def _candidates(units: DataFrame, of_paragraph: int) -> DataFrame:
    """The distinct paragraphs that share a band with another one: ``id, k1, k2, n_shingles, doc_id, start, length, bands`` (the shared ones)."""
    distinct = _banded(units, of_paragraph).dropDuplicates(["k1", "k2"])
    # a number of its own for every paragraph, fixed by writing the table
    distinct = checkpointed(distinct.withColumn("id", F.monotonically_increasing_id()))
    members = distinct.select("id", F.explode("bands").alias("band"))
    # moved and sorted once: a band is shared if a neighbour has it too
    order = Window.partitionBy("band").orderBy("id")
    beside = F.coalesce(F.lag("id").over(order), F.lead("id").over(order)).alias("beside")
    bands = members.select("id", "band", beside).where("beside is not null").groupBy("id").agg(F.collect_list("band").alias("bands"))
    out = checkpointed(distinct.drop("bands").join(bands, "id"))
    forget(distinct)
    return out


def _linked(rows: DataFrame, candidates: DataFrame, threshold: int) -> DataFrame:
    """``k1, k2, component``: the paragraphs that are similar to another one, and the component they are in."""
    places = candidates.select("id", "k1", "k2", "doc_id", "start", "length")
    component = class_components(candidates.select("id", "n_shingles", "bands"), lambda ids: _sets_of(rows, places, ids), threshold, words=CELL_WORDS)
    linked = checkpointed(places.select("id", "k1", "k2").join(component, "id").select("k1", "k2", "component"))
    forget(component)
    return linked


def _occurrences(rows: DataFrame, per_unit: int, run: int, of_paragraph: int, threshold: int) -> DataFrame:
    """Units that repeat: ``doc_id, start, length, is_window, passage_id, like, kept, n_docs, removed``.

    ``kept`` (``doc_id, start, length``) is the occurrence that stays, ``like`` the
    first one with the same set if that is in an earlier document, else ``kept``."""
    units = checkpointed(_units(rows, per_unit, run, of_paragraph))
    held = _unpacked(units, False).groupBy("k1", "k2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    names = held.withColumn("equal", F.col("low") != F.col("high")).select("k1", "k2", "equal")
    if of_paragraph:
        candidates = _candidates(units, of_paragraph)
        names = names.join(candidates.select("k1", "k2", F.lit(True).alias("banded")), ["k1", "k2"], "left").where("equal or banded").drop("banded")
    else:
        names = names.where("equal")
    names = checkpointed(names.withColumn("at", F.monotonically_increasing_id()))
    # all that can repeat; the rest of the units is not kept while paragraphs are compared
    place = checkpointed(_unpacked(units, True).join(names.select("k1", "k2"), ["k1", "k2"]))
    forget(units)
    # a passage of equal sets alone gets a number below 0, without gaps within what a task wrote
    task = F.shiftright("at", 33)
    own = -(F.shiftleft(task, 33) + F.row_number().over(Window.partitionBy(task).orderBy("at")))
    passage, known = own, names
    if of_paragraph:
        linked = _linked(rows, candidates, threshold)
        forget(candidates)
        known = names.join(linked, ["k1", "k2"], "left").where("component is not null or equal")
        passage = F.coalesce("component", own)
    known = checkpointed(known.select("k1", "k2", passage.alias("passage_id")))
    possible, place = place, checkpointed(place.join(known, ["k1", "k2"]))
    forget(names, known, possible)
    unit = F.struct("doc_id", "start", "length")
    like = place.groupBy("k1", "k2").agg(F.min(unit).alias("like"))
    # start and length in one number, so that the smallest is the first
    first = F.min(F.shiftleft(F.col("start").cast("long"), 32) + F.col("length")).alias("first")
    each = place.groupBy("passage_id", "doc_id").agg(first).groupBy("passage_id")
    each = each.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min_by("first", "doc_id").alias("first"), F.count("*").alias("n_docs"))
    start, length = F.shiftright("first", 32).cast("int"), F.col("first").bitwiseAND(F.lit(2**32 - 1)).cast("int")
    kept = F.struct(F.col("low").alias("doc_id"), start.alias("start"), length.alias("length"))
    each = each.where("low != high").select("passage_id", kept.alias("kept"), "n_docs")
    out = place.distinct().join(each, "passage_id").join(like, ["k1", "k2"]).drop("k1", "k2")
    # units of the document that keeps the passage stay as far as they overlap, one after the other, what is kept
    order = Window.partitionBy("passage_id", "doc_id").orderBy("start", "length", "is_window")
    before = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    out = out.withColumn("like", F.when(F.col("like.doc_id") < F.col("doc_id"), F.col("like")).otherwise(F.col("kept")))
    out = out.withColumn("apart", F.when(F.col("start") >= before, 1).otherwise(0))
    apart = F.max("apart").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("removed", (F.col("doc_id") != F.col("kept.doc_id")) | (apart > 0)).drop("apart")


#: lengths that are compared at once where a run is narrowed down
LENGTHS = 64
#: two primes below 2^31 and a base for each; a stretch of words is named by its two remainders
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 69069069)


#: powers are kept from text to text as far as this
_KEPT = 1 << 18


@functools.cache
def _first_powers(base: int, prime: int) -> np.ndarray:
    return _powers_up_to(base, prime, _KEPT)


def _powers_up_to(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:n]


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    return _first_powers(base, prime)[:n] if n <= _KEPT else _powers_up_to(base, prime, n)


class _Stretches:
    """Names of a text's stretches of words, each in constant time after one pass over the text."""

    def __init__(self, words: list[bytes]):
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        self.n, self.of = len(words), []
        for base, prime in zip(_BASES, _PRIMES, strict=True):
            # below 2^63 for any text of less than 2^32 words
            terms = hashes % np.uint64(prime) * _powers(base, prime, self.n) % np.uint64(prime)
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)])
            self.of.append((np.uint64(prime), sums, _powers(pow(base, -1, prime), prime, self.n + 1)))

    def names(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        a, b = ((sums[end] - sums[begin]) % prime * back[begin] % prime for prime, sums, back in self.of)
        return ((a << np.uint64(31)) | b).view(np.int64)


def _lengths(left: int, size: int, low: int, step: int) -> np.ndarray:
    """Lengths up to ``left``: with ``step`` 0 all up to ``size`` and then its doubles, below 0 ``low`` alone, else ``low`` and so many steps more."""
    if step < 0:
        return np.arange(low, min(low, left) + 1)
    if step:
        return low + step * np.arange(1, min(LENGTHS, (left - low) // step) + 1)
    doubles = size << np.arange(1, max(1, (left // size).bit_length()))
    return np.concatenate([np.arange(1, min(size, left) + 1), doubles])


def _beside(rows: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """``doc_id, at, side, low, step, names``: names of the stretches of ``_lengths`` after ``at`` (``side`` 1 or 2) or before it (-1)."""
    ask = ["at", "side", "low", "step"]
    wanted = places.groupBy("doc_id").agg(F.collect_set(F.struct(*ask)).alias("wanted"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, wanted in zip(frame["doc_id"], frame["text"], frame["wanted"], strict=True):
                text, asked, begin, end = _Stretches(words_of(text)), [], [], []
                for p in wanted:
                    at, side, low, step = (p[c] for c in ask)
                    if not 0 <= at <= text.n:
                        continue  # a place of another text with this id
                    n = _lengths(text.n - at if side > 0 else at, size, low, step)
                    here = np.full(len(n), at)
                    begin.append(here if side > 0 else at - n)
                    end.append(at + n if side > 0 else here)
                    asked.append((doc_id, at, side, low, step))
                if asked:
                    names = text.names(np.concatenate(begin), np.concatenate(end))
                    names = np.split(names, np.cumsum([len(n) for n in begin])[:-1])
                    out += [(*p, n) for p, n in zip(asked, names, strict=True)]
            yield pd.DataFrame(out, columns=["doc_id", *ask, "names"])

    schema = "doc_id long, at long, side int, low long, step long, names array<long>"
    return _read(rows, wanted, read, schema, lambda found: found.groupBy("doc_id", *ask).agg(F.max("names").alias("names")))


def _further(rows: DataFrame, open_: DataFrame, run: list[str], size: int) -> DataFrame:
    """The sides of runs, ``low`` raised to the greatest length asked for at which both documents are alike.

    ``step`` is then the distance of the lengths to ask for next, -1 where ``low`` is exact.
    Where one length alone was asked for, ``low`` is 1 if they are alike there and 0 if not."""
    other = F.col("at") - F.col("distance")
    places = open_.select("doc_id", "at", "side", "low", "step").union(open_.select("kept_id", other, "side", "low", "step")).distinct()
    beside = _beside(rows, places, size)
    kept = beside.select(F.col("doc_id").alias("kept_id"), F.col("at").alias("other"), "side", "low", "step", F.col("names").alias("there"))
    own = beside.withColumnRenamed("names", "here")
    pairs = open_.select(*run, "side", "at", other.alias("other"), "low", "step")
    pairs = pairs.join(own, ["doc_id", "at", "side", "low", "step"]).join(kept, ["kept_id", "other", "side", "low", "step"])
    unlike = F.array_position(F.zip_with("here", "there", lambda a, b: a.eqNullSafe(b)), False)
    alike = F.when(unlike > 0, unlike - 1).otherwise(F.size("here")).cast("long")
    pairs = pairs.select(*run, "side", "at", "low", "step", alike.alias("alike"))
    double = (F.lit(size) * F.pow(F.lit(2.0), F.col("alike") - size)).cast("long")
    exact = (F.col("step") < 0) | (F.col("alike") < size)
    low = F.when(F.col("step") > 0, F.col("low") + F.col("step") * F.col("alike")).when(exact, F.col("alike")).otherwise(double)
    # the exact length is less than so much more
    width = F.when(F.col("step") > 0, F.col("step")).when(exact, F.lit(1)).otherwise(double)
    step = F.when(width <= 1, F.lit(-1)).otherwise(F.ceil(width / LENGTHS)).cast("long")
    out = checkpointed(pairs.select(*run, "side", "at", low.alias("low"), step.alias("step")))
    forget(beside)
    return out


def _runs(rows: DataFrame, removed: DataFrame, per_unit: int, size: int) -> DataFrame:
    """The removed windows with the span ``low, high`` that their run shares with the document they are ``like``.

    Stretches of words beyond each end are compared by name: all of up to ``size``
    words, then each of twice the length; between the last that is alike and the next,
    ``LENGTHS`` lengths a round.  So the rounds grow with the logarithm of the length."""
    run = ["doc_id", "kept_id", "distance", "run"]
    windows = removed.select(
        "doc_id", "start", "passage_id", F.col("like.doc_id").alias("kept_id"), (F.col("start") - F.col("like.start")).alias("distance")
    ).distinct()
    order = Window.partitionBy("doc_id", "kept_id", "distance").orderBy("start")
    gap = F.col("start") - F.lag("start").over(order) > per_unit
    windows = windows.withColumn("gap", F.coalesce(gap.cast("int"), F.lit(0)))
    windows = checkpointed(windows.withColumn("run", F.sum("gap").over(order)).drop("gap"))
    ends = windows.groupBy(*run).agg(F.min("start").alias("low"), F.max(F.col("start") + per_unit).alias("high"))
    order = Window.partitionBy("doc_id", "kept_id", "distance").orderBy("run")
    ends = ends.withColumns({"gap": F.lead("low").over(order) - F.col("high"), "back": F.col("low") - F.lag("high").over(order)})
    ends = checkpointed(ends)
    nothing, one = F.lit(0).cast("long"), F.lit(-1).cast("long")
    low, high, length = (c.cast("long") for c in (F.col("low"), F.col("high"), F.col("high") - F.col("low")))
    side = lambda k, at, n, step: F.struct(F.lit(k).alias("side"), at.alias("at"), n.alias("low"), step.alias("step"))
    # of runs that follow each other closely also whether the whole run is alike
    near = F.coalesce(F.col("gap") <= size, F.lit(False)) | F.coalesce(F.col("back") <= size, F.lit(False))
    sides = F.array(side(-1, low, nothing, nothing), side(1, high, nothing, nothing), F.when(near, side(2, low, length, one)))
    open_ = ends.select(*run, F.explode(sides).alias("e")).where("e is not null").select(*run, "e.*")
    step = _further(rows, open_, run, size)
    chain = _chains(ends, step, run)
    first, last = (F.col("side") < 0) & (F.col("run") == F.col("chain")), (F.col("side") == 1) & F.col("last")
    sides = step.join(chain, run).where(first | last).select(*run[:-1], F.col("chain").alias("run"), "side", "at", "low", "step")
    closed, open_ = sides.where("step < 0"), sides.where("step > 0")
    while not open_.isEmpty():
        step = _further(rows, open_, run, size)
        closed, open_ = closed.union(step.where("step < 0")), step.where("step > 0")
    closed = closed.withColumn("at", F.col("at") + F.col("side") * F.col("low"))
    spans = closed.groupBy(*run).agg(F.min("at").alias("low"), F.max("at").alias("high")).withColumnRenamed("run", "chain")
    windows = windows.join(chain, run).join(spans, [*run[:-1], "chain"])
    return checkpointed(windows.select("doc_id", "start", "passage_id", "kept_id", "distance", "low", "high"))


def _chains(ends: DataFrame, step: DataFrame, run: list[str]) -> DataFrame:
    """``chain`` of every run: the first of those that go over into each other, whose spans are one; ``last`` is true for the chain's last.

    Both runs are alike word by word, and so is what lies between."""
    ahead = step.where("side = 1").select(*run, F.col("low").alias("ahead"))
    whole = step.where("side = 2 and low = 1").select(*run, F.lit(True).alias("whole"))
    runs = ends.select(*run, "gap").join(ahead, run, "left").join(whole, run, "left").withColumn("whole", F.col("whole").isNotNull())
    order = Window.partitionBy(*run[:-1]).orderBy("run")
    on = F.col("whole") & F.lead("whole").over(order) & (F.col("ahead") >= F.col("gap"))
    runs = runs.withColumn("on", F.coalesce(on, F.lit(False)))
    begins = ~F.coalesce(F.lag("on").over(order), F.lit(False))
    chain = F.max(F.when(begins, F.col("run"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return checkpointed(runs.select(*run, chain.alias("chain"), (~F.col("on")).alias("last")))


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_unit: int = WORDS_PER_UNIT,
    run: int = RUN,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """One row per window that repeats: ``doc_id, start, end, passage_id, n_docs, removed`` (positions in words)."""
    out = _occurrences(id_text(docs, id_col, text_col), per_unit, run, 0, threshold)
    start = F.col("start").cast("long")
    return out.select("doc_id", start.alias("start"), (start + F.col("length")).alias("end"), "passage_id", "n_docs", "removed")


def repeated_paragraphs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_unit: int = WORDS_PER_UNIT,
    run: int = RUN,
    of_paragraph: int = PARAGRAPH_BANDS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """One row per paragraph that repeats, and per window that repeats with the span of its run; columns as ``repeated_passages``."""
    rows = id_text(docs, id_col, text_col)
    found = checkpointed(_occurrences(rows, per_unit, run, of_paragraph, threshold))
    removed = found.where("is_window and removed")
    runs = _runs(rows, removed, per_unit, run - per_unit + 1)
    own = runs.select("doc_id", "start", "passage_id", F.lit(True).alias("is_window"), "low", "high")
    # what a run is like reaches as far itself
    there = [F.col("kept_id").alias("doc_id"), (F.col("start") - F.col("distance")).alias("start"), F.lit(True).alias("is_window")]
    reach = runs.groupBy(*there).agg(F.min(F.col("low") - F.col("distance")).alias("back"), F.max(F.col("high") - F.col("distance")).alias("ahead"))
    start, end = F.col("start").cast("long"), (F.col("start") + F.col("length")).cast("long")
    # within one document a run goes back to the kept unit at most
    free = F.when(F.col("doc_id") == F.col("kept.doc_id"), F.col("kept.start") + F.col("kept.length")).otherwise(F.lit(0))
    low = F.when(F.col("low").isNotNull(), F.greatest(F.col("low"), free)).otherwise(F.col("back"))
    high = F.when(F.col("high").isNotNull(), F.col("high")).otherwise(F.col("ahead"))
    out = found.join(own, ["doc_id", "start", "passage_id", "is_window"], "left").join(reach, ["doc_id", "start", "is_window"], "left")
    return out.select(
        "doc_id",
        F.least(start, F.coalesce(low, start)).alias("start"),
        F.greatest(end, F.coalesce(high, end)).alias("end"),
        "passage_id",
        "n_docs",
        "removed",
    ).distinct()
