"""Near duplicates of vectors by sorted projection passes.

Each pass hashes every vector to ``BITS`` bits, the signs of its projections on
random directions, and orders the vectors of a label lexicographically by the
concatenated bits.  Similar vectors agree in most bits and come to stand near
each other; every vector is compared with the next ``WINDOW`` in the order, by
cosine in double precision.  A pair at cosine 0.98 agrees in a bit with
probability 0.936, so among 10,000 vectors of a label a pass of 64 neighbours
finds it with probability 0.6, and 16 passes miss it with 2e-7.

1. Equal vectors of one label are one class with a weight, so copies cost
   nothing more (combined map-side).  Vectors are compared only within a label
   and a length.
2. A pass sorts by range of (label, length, bits, class); ``together`` passes share
   one shuffle.  A task slides its window over its sorted rows and hands on the
   pairs it verified as a forest (one edge a row at most), so dense groups are not
   expanded into pairs.  The first and last ``WINDOW`` rows of each partition are
   compared across its borders in a second, small step: the same pairs are
   compared for any partitioning.
3. The forests of all passes are united to connected components.
4. The window bounds what a pass compares, not what is reported: within a
   component all classes are compared again in blocks of ``PER_BLOCK`` and counted,
   no pair is emitted.  A large component is dealt to many tasks, one for each
   pair of its blocks (rows moved: its size times its number of blocks).  So
   ``n_links`` is exact within a component, and a link can be lost only if no pass
   connects its two ends by any chain of links.

Vectors travel as bytes of the table's own precision (4 or 8 a value).

Defined cases: vectors that are null, empty, all zero or hold a null or
non-finite value, and those without a label, link with nothing: they report no
links and their own id; cosines do not overflow or underflow (vectors are scaled
by their largest value first); ``-0.0`` equals ``0.0``; vectors of different length
are not compared; rows that repeat an id are vectors of their own; a null id is
the component of nothing (the component is the smallest id there is, null where
there is none); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventilake.llm.common import checkpointed
from ventilake.llm.components import connected_components, forest

THRESHOLD = 0.98
PASSES = 16
#: passes that share one shuffle
TOGETHER = 4
WINDOW = 64
#: bits of one pass, as one non-negative long
BITS = 63
#: classes of a component that are compared with each other in one piece
PER_BLOCK = 1024
#: shares that a component is dealt to where its rows meet its size and its smallest id
SALTS = 64


def _value_type(df: DataFrame, vector: str) -> str:
    kind = df.schema[vector].dataType
    return "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"


def _usable(v: Column) -> Column:
    """Whether a vector has a direction: not null, all values finite, not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def units(vectors: list[bytes], kind: str) -> np.ndarray:
    """The vectors, all of one length, scaled to length one in double precision."""
    x = np.frombuffer(b"".join(vectors), dtype="<f4" if kind == "float" else "<f8").reshape(len(vectors), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


def directions(dim: int, passes: int) -> np.ndarray:
    return np.random.default_rng([20_251_117, dim]).standard_normal((dim, passes * BITS))


def sort_keys(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """One long per pass: the concatenated signs of its projections."""
    signs = (x @ planes > 0).reshape(len(x), -1, BITS)
    return (signs.astype(np.int64) << np.arange(BITS - 1, -1, -1, dtype=np.int64)).sum(axis=2)


def pairs_in_order(x: np.ndarray, groups: np.ndarray, window: int, threshold: float, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows at most ``window`` apart, in one group, that reach the threshold; the later one at row ``first`` or after."""
    found_a, found_b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    n = len(x)
    for i in range(max(0, first - window), n - 1, window):
        rows = x[i : i + window]
        cosine = rows @ x[i + 1 : i + 2 * window].T
        if cosine.max(initial=-1.0) < threshold:
            continue
        a, b = np.nonzero(cosine >= threshold)
        a, b = a + i, b + i + 1
        near = (b > a) & (b - a <= window) & (b >= first)
        a, b = a[near], b[near]
        same = groups[a] == groups[b]
        found_a.append(a[same])
        found_b.append(b[same])
    return np.concatenate(found_a), np.concatenate(found_b)


def _classes(rows: DataFrame, kind: str, passes: int) -> DataFrame:
    """One row per distinct vector of a label: ``cid, label, dim, vector (bytes), keys, weight, vec_id, k1, k2``."""
    usable = rows.where(_usable(F.col("vector")) & F.col("label").isNotNull())
    known = usable.groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("vec_id").alias("vec_id"))
    known = known.withColumns({"cid": F.monotonically_increasing_id(), **_keys_of(F.col("vector"))})
    # written first, so that the numbers stay as they are
    known = checkpointed(known)

    def hash_(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for frame in frames:
            data = [np.asarray(v, dtype="<f4" if kind == "float" else "<f8").tobytes() for v in frame["vector"]]
            dims = np.array([len(v) for v in frame["vector"]], dtype=np.int64)
            keys: list = [None] * len(data)
            for dim in np.unique(dims).tolist():
                if dim not in planes:
                    planes[dim] = directions(dim, passes)
                at = np.flatnonzero(dims == dim)
                for i in range(0, len(at), 1024):
                    some = at[i : i + 1024].tolist()
                    for k, row in zip(some, sort_keys(units([data[k] for k in some], kind), planes[dim]), strict=True):
                        keys[k] = row
            yield pd.DataFrame({"cid": frame["cid"], "label": frame["label"], "dim": dims, "vector": data, "keys": keys, "weight": frame["weight"], "vec_id": frame["vec_id"].astype("Int64"), "k1": frame["k1"], "k2": frame["k2"]})

    label = rows.schema["label"].dataType.simpleString()
    columns = known.select("cid", "label", "vector", "weight", "vec_id", "k1", "k2")
    schema = f"cid long, label {label}, dim long, vector binary, keys array<long>, weight long, vec_id long, k1 long, k2 long"
    return checkpointed(columns.mapInPandas(hash_, schema))


def _keys_of(vector: Column) -> dict[str, Column]:
    """128 bits that name a vector's values."""
    return {"k1": F.xxhash64(F.lit(1), vector), "k2": F.xxhash64(F.lit(2), vector)}


def _runs(*columns: np.ndarray) -> np.ndarray:
    """The number of the run of equal rows that each row belongs to."""
    n = len(columns[0])
    change = np.zeros(n, dtype=np.int64)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.cumsum(change)


def _unit_rows(frame: pd.DataFrame, kind: str) -> list[tuple[slice, np.ndarray]]:
    """Stretches of rows of one length, with their unit vectors."""
    run = _runs(frame["dim"].to_numpy())
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
    vectors = frame["vector"].tolist()
    return [(slice(a, b), units(vectors[a:b], kind)) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def _edges_of(frame: pd.DataFrame, kind: str, window: int, threshold: float, first: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the verified pairs of sorted rows, the later one at row ``first`` or after: ``(cid, cid)``."""
    cid = frame["cid"].to_numpy()
    group = _runs(frame["pass"].to_numpy(), frame["label"].to_numpy(), frame["dim"].to_numpy())
    left, right = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for span, x in _unit_rows(frame, kind):
        a, b = pairs_in_order(x, group[span], window, threshold, max(0, first - span.start))
        if len(a):
            root = forest(len(x), a, b)
            tied = np.flatnonzero(root != np.arange(len(x)))
            left.append(cid[span][tied])
            right.append(cid[span][root[tied]])
    return np.concatenate(left), np.concatenate(right)


_SORTED = ["pass", "label", "dim", "key", "cid"]


def _pass_edges(classes: DataFrame, chosen: list[int], kind: str, window: int, threshold: float) -> DataFrame:
    """``a, b``: a forest of the links that the passes ``chosen`` verify."""
    label = classes.schema["label"].dataType.simpleString()
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("pass"), F.col("keys")[p].alias("key")) for p in chosen])).alias("p")
    rows = classes.select("cid", "label", "dim", "vector", each).select("p.pass", "label", "dim", "p.key", "cid", "vector")
    rows = rows.repartitionByRange(*_SORTED).sortWithinPartitions(*_SORTED).drop("key")
    fields = ["kind", "a", "b", "part", "pass", "label", "dim", "cid", "vector"]

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        empty = {"kind": None, "a": None, "b": None, "part": part, "pass": None, "label": None, "dim": None, "cid": None, "vector": None}
        held, seen = None, 0

        def border(some: pd.DataFrame, kind_: int, places: np.ndarray) -> pd.DataFrame:
            return some.assign(kind=kind_, a=places, b=None, part=part)[fields]

        for frame in frames:
            if not len(frame):
                continue
            if seen < window:
                head = frame.iloc[: window - seen]
                yield border(head, 1, seen + np.arange(len(head)))
            first = 0 if held is None else len(held)
            both = frame if held is None else pd.concat([held, frame], ignore_index=True)
            a, b = _edges_of(both, kind, window, threshold, first)
            if len(a):
                yield pd.DataFrame(empty | {"kind": 0, "a": a, "b": b})[fields]
            seen += len(frame)
            held = both.iloc[-window:].reset_index(drop=True)
        if seen:
            # rows of the tail that are not in the head as well
            tail = held.iloc[-min(len(held), max(0, seen - window)) :] if seen > window else held.iloc[:0]
            yield border(tail, 1, seen - len(tail) + np.arange(len(tail)))
            yield pd.DataFrame(empty | {"kind": [2], "a": [seen]})[fields]

    schema = f"kind int, a long, b long, part int, pass int, label {label}, dim long, cid long, vector binary"
    found = checkpointed(rows.mapInPandas(look, schema))
    sizes = sorted((r["part"], r["a"]) for r in found.where("kind = 2").select("part", "a").collect())
    edges = found.where("kind = 0").select("a", "b")
    if len(sizes) < 2:
        return edges
    starts = dict(zip([p for p, _ in sizes], np.cumsum([0, *[n for _, n in sizes[:-1]]]).tolist(), strict=True))
    borders = np.array(sorted(starts.values())[1:])

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rank = frame["a"].to_numpy() + frame["part"].map(starts).to_numpy()
            low, high = np.searchsorted(borders, rank - window, side="right"), np.searchsorted(borders, rank + window, side="left")
            # the borders that lie at most a window before or behind the row
            times = np.maximum(0, high - low)
            at = np.repeat(np.arange(len(frame)), times)
            border = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
            out = frame.iloc[at][["pass", "label", "dim", "cid", "vector"]].reset_index(drop=True)
            yield out.assign(border=border, rank=rank[at], limit=borders[border] if len(at) else border)

    def across(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_groups(frames, ["border"]):
            frame = frame.drop_duplicates("rank")
            rank, limit = frame["rank"].to_numpy(), int(frame["limit"].iloc[0])
            if (rank[1:] != rank[:-1] + 1).any():
                raise RuntimeError("rows at a border are missing")
            a, b = _edges_of(frame, kind, window, threshold, int(np.searchsorted(rank, limit)))
            if len(a):
                yield pd.DataFrame({"a": a, "b": b})

    fields_ = f"pass int, label {label}, dim long, cid long, vector binary, border long, rank long, limit long"
    placed = found.where("kind = 1").select("part", "a", "pass", "label", "dim", "cid", "vector").mapInPandas(place, fields_)
    placed = placed.repartition("border").sortWithinPartitions("border", "rank")
    return edges.union(checkpointed(placed.mapInPandas(across, "a long, b long")))


def _whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Group after group of a sorted stream, each whole; groups are of bounded size."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        values = [frame[k].to_numpy() for k in keys]
        if held and any(held[-1][k].iloc[-1] != v[0] for k, v in zip(keys, values, strict=True)):
            yield pd.concat(held, ignore_index=True)
            held = []
        edges = [0, *(np.flatnonzero(np.diff(_runs(*values))) + 1).tolist(), len(frame)]
        for a, b in zip(edges[:-2], edges[1:-1], strict=True):
            yield pd.concat([*held, frame.iloc[a:b]], ignore_index=True)
            held = []
        held.append(frame.iloc[edges[-2] :])
    if held:
        yield pd.concat(held, ignore_index=True)


def _of_group(rows: DataFrame, group: str, part: Column, whole: Column) -> DataFrame:
    """``rows`` with the value ``whole`` of their group, an aggregate of ``part`` (aggregates of ``SALTS`` shares of it).

    A group's rows meet its value share by share, so a hot group is dealt to many tasks."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(F.col("id")), F.lit(SALTS)))
    shares = salted.groupBy(group, "salt").agg(part.alias("part"))
    value = shares.select(group, "salt").join(shares.groupBy(group).agg(whole), group)
    return salted.join(value, [group, "salt"]).drop("salt")


def _link_counts(classes: DataFrame, component: DataFrame, kind: str, threshold: float, per_block: int) -> DataFrame:
    """``cid, linked``: the weight of the other classes of its component that each class is linked with."""
    members = _of_group(component, "component", F.count("*"), F.ceil(F.sum("part") / per_block).cast("int").alias("blocks"))
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = members.join(classes.select(F.col("cid").alias("id"), "vector", "weight"), "id")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = members.select("component", "block", other, "id", "vector", "weight").select(
        "component",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).alias("second"),
        "id",
        "vector",
        "weight",
    )
    keys = ["component", "low", "high"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "second")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_groups(frames, keys):
            x, w = units(frame["vector"].tolist(), kind), frame["weight"].to_numpy()
            within = frame["low"].iloc[0] == frame["high"].iloc[0]
            cut = 0 if within else int((~frame["second"].to_numpy(dtype=bool)).sum())
            linked = np.zeros(len(x), dtype=np.int64)
            for i in range(0, len(x) if within else cut, 256):
                if within:
                    near = x[i : i + 256] @ x.T >= threshold
                    near[np.arange(len(near)), i + np.arange(len(near))] = False
                    linked[i : i + 256] = near @ w
                else:
                    near = x[i : min(cut, i + 256)] @ x[cut:].T >= threshold
                    linked[i : i + len(near)] += near @ w[cut:]
                    linked[cut:] += w[i : i + len(near)] @ near
            yield pd.DataFrame({"cid": frame["id"], "linked": linked})

    return rows.mapInPandas(count, "cid long, linked long").groupBy("cid").agg(F.sum("linked").alias("linked"))


def embedding_dedup(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    passes: int = PASSES,
    window: int = WINDOW,
    together: int = TOGETHER,
    per_block: int = PER_BLOCK,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``."""
    kind = _value_type(table, vector_col)
    zero = F.lit(0.0).cast(kind)
    vector = F.transform(F.col(vector_col).cast(f"array<{kind}>"), lambda x: x + zero)
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("vector"))
    classes = _classes(rows, kind, passes)
    edges = None
    for p in range(0, passes, together):
        some = _pass_edges(classes, list(range(p, min(passes, p + together))), kind, window, threshold)
        edges = some if edges is None else edges.union(some)
    component = checkpointed(connected_components(edges))
    linked = _link_counts(classes, component, kind, threshold, per_block)
    own = classes.select(F.col("cid").alias("id"), "label", "k1", "k2", "weight", "vec_id").join(component, "id", "left")
    own = own.withColumn("component", F.coalesce("component", "id"))
    own = _of_group(own, "component", F.min("vec_id"), F.min("part").alias("component_id"))
    found = own.join(linked.withColumnRenamed("cid", "id"), "id", "left").select(
        "label", "k1", "k2", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    usable = _usable(F.col("vector")) & F.col("label").isNotNull()
    rows = rows.select("vec_id", F.when(usable, F.col("label")).alias("label"), *[k.alias(n) for n, k in _keys_of(F.col("vector")).items()])
    out = rows.join(found, ["label", "k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
