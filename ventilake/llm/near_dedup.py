"""Near duplicates by min-max hashing of five-word shingles, confirmed on full sets.

Every permutation gives two signature values, the smallest and the largest
image of the set, so ``perms`` evaluations yield ``2 * perms`` values.  Both
agree with probability equal to the Jaccard similarity, as in plain MinHash,
and being negatively correlated their mean varies less.  Bands of ``rows``
values are cut from the minima and from the maxima.  With 72 permutations and
bands of six values (24 bands) a pair at similarity 0.85 shares no band with
probability 1.2e-5, a pair at 0.90 with 2e-8.

Documents with the same set are one class, so copies cost nothing more.
Classes that share a band are candidates and their similarity is computed on
the full sets.  No bucket is expanded into all its pairs:

1. Shingles that only one candidate holds bound every similarity of that
   candidate from above: those that cannot reach the threshold with anything
   are set aside, and the bound is applied again to each pair before the sets
   are compared.
2. In each bucket all classes are compared with one hub, the one with the
   fewest shingles of its own; confirmed links are contracted to components.
3. Buckets that still hold more than one component get further hubs, eight
   times as many in each round, compared only across components, until every
   such pair has been looked at.  The rounds end early for nearly all buckets.
   Here the whole signature is consulted first, packed to four bits a value: a
   pair whose agreement lies four standard deviations below that of a pair at
   the threshold is left out (a linked pair is missed so with probability 3e-5).

Words are split at ``[\\x20\\x09-\\x0D]`` and A-Z lower-cased; a text of fewer than
five words is one shingle.  Sets hold 64-bit hashes of shingles; equality of
sets is decided on a 128-bit digest of the sorted set.

Defined cases: null, empty and blank texts have the empty set and are linked
with nothing; rows that repeat an id are documents of their own, told apart by
their sets; a null id belongs to the component of its set (null where that has
no other id) and is kept only then (the filter ``drop_near_copies`` judges rows, also
those without an id); an empty table gives an empty result; texts of any length
are read in blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import checkpointed, forget, fresh, id_text, row_keys
from ventilake.llm.components import connected_components

WORDS = 5
PERMS = 72
ROWS = 6
#: similarity threshold in hundredths
THRESHOLD = 85
_BLOCK = 1 << 15
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of the five-word shingles, in order; none for fewer words."""
    n = len(words)
    if n < WORDS:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    s = np.zeros(n - WORDS + 1, dtype=np.uint64)
    for k in range(WORDS):
        part = h[k : n - WORDS + 1 + k] * _MIX[k]
        s = (s ^ (part ^ (part >> np.uint64(32)))) * np.uint64(0x9FB21C651E98DF25)
    return s ^ (s >> np.uint64(29))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; fewer than five words are one shingle."""
    words = words_of(text)
    if 0 < len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], dtype=np.uint64)
    return np.unique(shingle_hashes(words))


def multipliers(perms: int) -> np.ndarray:
    """Odd factors: multiplying by one permutes the 32-bit integers."""
    return np.random.default_rng(20_240_601).integers(0, 2**31, perms, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def min_max(shingles: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.full(len(factors), 2**32 - 1, dtype=np.uint32)
    high = np.zeros(len(factors), dtype=np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    for i in range(0, len(x), _BLOCK):
        image = factors[:, None] * x[None, i : i + _BLOCK]
        np.minimum(low, image.min(axis=1), out=low)
        np.maximum(high, image.max(axis=1), out=high)
    return low, high


def band_keys(values: np.ndarray, rows: int) -> list[int]:
    """One signed 64-bit key per band of signature values; the band's number is part of the key."""
    return [
        int.from_bytes(xxhash.xxh3_64_digest(values[i : i + rows].tobytes(), seed=i), "big", signed=True)
        for i in range(0, len(values), rows)
    ]


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketch(values: np.ndarray) -> np.ndarray:
    """Four bits of each signature value, sixteen values to a signed 64-bit word."""
    nibbles = ((values * np.uint32(0x9E3779B1)) >> np.uint32(28)).astype(np.uint64)
    nibbles = np.concatenate([nibbles, np.zeros(-len(nibbles) % 16, dtype=np.uint64)]).reshape(-1, 16)
    return (nibbles << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64).view(np.int64)


def _agreeing(a: Column, b: Column, words: int, values: int, threshold: int) -> Column:
    """Whether two sketches agree about as often as those of a pair at the threshold."""
    differ = F.lit(0)
    for i in range(words):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111))
        differ = differ + F.bit_count(x)
    p = threshold / 100 + (1 - threshold / 100) / 16
    return differ <= values - math.floor(values * p - 4 * math.sqrt(values * p * (1 - p)))


def _signatures(rows: DataFrame, perms: int, per_band: int) -> DataFrame:
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = multipliers(perms)
        for frame in frames:
            out = []
            for doc_id, also, text in zip(frame["doc_id"], frame["also"], frame["text"], strict=True):
                s = shingle_set(text)
                if len(s):
                    values = np.concatenate(min_max(s, factors))
                    out.append((doc_id, also, len(s), digest_of(s), band_keys(values, per_band), sketch(values)))
                else:
                    out.append((doc_id, also, 0, None, [], []))
            columns = ["doc_id", "also", "n_shingles", "digest", "bands", "sketch"]
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    schema = "doc_id long, also long, n_shingles long, digest binary, bands array<long>, sketch array<long>"
    return rows.mapInPandas(sign, schema)


def _sets(rows: DataFrame) -> DataFrame:
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingle_set(t) for t in frame["text"]]
            yield pd.DataFrame({"digest": [digest_of(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]})

    return rows.mapInPandas(build, "digest binary, shingles array<long>")


def _sets_of(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of the wanted ids of ``classes`` (``id, digest, doc_id``), built again from the texts: one row per id."""
    wanted = checkpointed(classes.join(wanted, "id", "left_semi").select("id", "digest", "doc_id"))
    ids = wanted.select("doc_id").distinct()
    sets = _sets(rows.join(ids, "doc_id", "left_semi")).join(wanted.select("id", "digest"), "digest")
    sets = checkpointed(sets.select("id", "shingles").dropDuplicates(["id"]))
    forget(wanted)
    return sets


def _reachable(n_a: Column, own_a: Column, n_b: Column, own_b: Column, threshold: int) -> Column:
    """Whether sets of these sizes, each with so many shingles of its own, can reach the threshold."""
    common = F.least(n_a - own_a, n_b - own_b)
    return 100 * common >= threshold * (n_a + n_b - common)


def _reach_by_cells(words: int, threshold: int) -> Column:
    """Whether two sets can reach the threshold, as the cells both occupy and the fewer shingles beyond one a cell
    (``cell0 ..., spare`` of one, with ``_x`` of the other) are at least as many as what they have in common."""
    most = F.least("spare", "spare_x")
    for i in range(words):
        most = most + F.bit_count(F.col(f"cell{i}").bitwiseAND(F.col(f"cell{i}_x")))
    return (100 + threshold) * most >= threshold * (F.col("n_shingles") + F.col("n_shingles_x"))


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.select("a", "b").distinct().join(right, "b").join(left, "a")
        .where(100 * common >= threshold * (F.size("of_a") + F.size("of_b") - common))
        .select("a", "b")
    )


def class_components(
    classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], threshold: int = THRESHOLD, values: int = 0, words: int = 0
) -> DataFrame:
    """``id, component`` of the classes (``id, n_shingles, bands``) that are linked with another.

    ``sets_of`` turns a table of ids into ``id, shingles``, the full sets, kept
    in the shared folder.  ``values``: how many signature values the column
    ``sketch`` holds; without sketches every pair of the rounds is compared.
    ``words``: how many 64-bit words the column ``cells`` of the sets holds, a bit
    for each cell that a shingle falls in; pairs of the rounds that cannot reach
    the threshold by their cells are left out, which loses no link."""
    members = classes.select("id", "n_shingles", F.explode("bands").alias("band"))
    shared = members.groupBy("band").count().where("count > 1").select("band")
    candidates = checkpointed(members.join(shared, "band"))
    sets = sets_of(candidates.select("id").distinct())
    if words:
        # the cells bound each pair more closely
        members = candidates.withColumn("own", F.lit(0).cast("long"))
    else:
        own = (
            sets.select("id", F.explode("shingles").alias("shingle")).groupBy("shingle")
            .agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1").groupBy("id").agg(F.count("*").alias("own"))
        )
        members = candidates.join(own, "id", "left").na.fill(0, ["own"])
        members = members.where(100 * (F.col("n_shingles") - F.col("own")) >= threshold * F.col("n_shingles"))
    order = F.struct("own", F.xxhash64("id"), "id")
    hubs = members.groupBy("band").agg(F.min(F.struct(order.alias("o"), "n_shingles")).alias("h"), F.count("*").alias("size"))
    hubs = hubs.where("size > 1").select(
        "band", "size", F.col("h.o.id").alias("hub"), F.col("h.o.own").alias("hub_own"), F.col("h.n_shingles").alias("hub_n")
    )
    written = members = checkpointed(members.join(hubs, "band"))
    forget(candidates)
    pairs = members.where(F.col("id") != F.col("hub")).where(
        _reachable(F.col("n_shingles"), F.col("own"), F.col("hub_n"), F.col("hub_own"), threshold)
    )
    links = checkpointed(_confirmed(pairs.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")), sets, threshold))

    rank = (F.pmod(F.xxhash64("id", "band"), F.lit(1 << 20)) * F.col("size") / float(1 << 20)).alias("rank")
    members = members.select("band", "id", "n_shingles", "own", "size", rank)
    low, high = 0, 8
    component = None
    while True:
        # what is connected already goes on as stars, only the new links are added
        stars = links if component is None else links.union(component.select(F.col("id").alias("a"), F.col("component").alias("b")))
        before, component = component, checkpointed(connected_components(stars))
        forget(links, *[before] * (before is not None))
        open_ = members.join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = open_.groupBy("band").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.max("size").alias("n"))
        mixed = checkpointed(mixed.where("c0 != c1").where(F.col("n") > low).select("band"))
        if mixed.isEmpty():
            forget(sets, written, mixed)
            return component
        open_ = open_.join(mixed, "band")
        if not words or values:
            open_ = open_.join(classes.select("id", "bands", *["sketch"] * bool(values)), "id")
        if words:
            cells = [f"cell{i}" for i in range(words)]
            open_ = open_.join(sets.select("id", *[F.col("cells")[i].alias(c) for i, c in enumerate(cells)]), "id")
            open_ = open_.withColumn("spare", F.col("n_shingles") - sum(map(F.bit_count, cells), F.lit(0)))
        x = open_.where((F.col("rank") >= low) & (F.col("rank") < high)).select([F.col(c).alias(f"{c}_x") for c in open_.columns])
        # a pair is looked at in the first band that it shares, and there alone; the few that their cells leave are told apart later
        first = F.col("band") if "bands" not in open_.columns else F.array_min(F.array_intersect("bands", "bands_x"))
        pairs = open_.join(x, F.col("band") == F.col("band_x")).where(
            (F.struct("rank", "id") > F.struct("rank_x", "id_x"))
            & (F.col("component") != F.col("component_x"))
            & _reachable(F.col("n_shingles"), F.col("own"), F.col("n_shingles_x"), F.col("own_x"), threshold)
            & (_reach_by_cells(words, threshold) if words else F.lit(True))
            & (first == F.col("band"))
            & (_agreeing(F.col("sketch"), F.col("sketch_x"), -(-values // 16), values, threshold) if values else F.lit(True))
        )
        pairs = pairs.select(F.least("id", "id_x").alias("a"), F.greatest("id", "id_x").alias("b"))
        links = checkpointed(_confirmed(pairs, sets, threshold))
        forget(mixed)
        low, high = high, high * 8


def _grouped(rows: DataFrame, threshold: int, perms: int, rows_per_band: int) -> DataFrame:
    """``doc_id, also, n_shingles, component (a number of its own, null without shingles), component_id`` for
    rows of ``doc_id, also, text``; ``also`` is carried along."""
    signed = checkpointed(_signatures(rows, perms, rows_per_band))
    known = signed.where("digest is not null").groupBy("digest")
    classes = known.agg(
        F.min("doc_id").alias("doc_id"),
        *[F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")],
    )
    # a number of its own for every class, fixed by writing the table
    classes = checkpointed(classes.withColumn("id", F.monotonically_increasing_id()))
    named = classes.where("doc_id is not null")
    component = class_components(named, lambda ids: _sets_of(rows, named, ids), threshold, 2 * perms)
    smallest = component.join(classes, "id").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = component.join(smallest, "component").select("id", "component", "component_id")
    of_class = classes.join(of_class, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
    out = signed.drop("bands", "sketch").join(of_class, "digest", "left")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "also", "n_shingles", "component", own.alias("component_id"))


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    perms: int = PERMS,
    rows_per_band: int = ROWS,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``."""
    rows = id_text(docs, id_col, text_col).withColumn("also", F.lit(0).cast("long"))
    out = _grouped(rows, threshold, perms, rows_per_band)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return out.select("doc_id", "n_shingles", "component_id", kept)


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    perms: int = PERMS,
    rows_per_band: int = ROWS,
) -> DataFrame:
    """``docs`` with one row of each component; all columns stay.

    The row with the smallest id stays (a null id last).  Rows are told apart by 128
    bits of id and text: those with a null id are compared like others, of repeated
    rows one stays, and rows with one id and different texts are judged one by one."""
    a, b = fresh(docs, "row_key_a", "row_key_b")
    keyed = docs.withColumns(dict(zip((a, b), row_keys(id_col, text_col), strict=True)))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    rows = keyed.select(F.col(a).alias("doc_id"), F.col(b).alias("also"), text)
    linked = _grouped(rows, threshold, perms, rows_per_band).select("doc_id", "also", "component").distinct()
    ids = keyed.select(F.col(a).alias("doc_id"), F.col(b).alias("also"), F.col(id_col).cast("long").alias("id")).distinct()
    order = F.struct(F.col("id").isNull().alias("without"), "id", "doc_id", "also")
    best = linked.where("component is not null").join(ids, ["doc_id", "also"]).groupBy("component").agg(F.min(order).alias("best"))
    best = best.select("best.doc_id", "best.also").union(linked.where("component is null").select("doc_id", "also"))
    best = checkpointed(best.select(F.col("doc_id").alias(a), F.col("also").alias(b)))
    return keyed.dropDuplicates([a, b]).join(best, [a, b], "left_semi").select(*docs.columns)
