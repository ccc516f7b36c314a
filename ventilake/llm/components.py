"""Connected components of a link table: contraction inside the tasks, then alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import checkpointed, forget


#: a task of the contractions takes this many links
LINKS_PER_TASK = 500_000


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` vertices the smallest one it is connected with through the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for at in (a, b, root[a], root[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as stars: every vertex but the smallest of its component, tied to that one."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = forest(len(ids), at[: len(u)], at[len(u) :])
    tied = np.flatnonzero(root != np.arange(len(ids)))
    return ids[tied], ids[root[tied]]


def _contract(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """The links of each task contracted to stars; with one task these are the components.

    A combiner: what a task holds is contracted again whenever it has grown by
    ``LINKS_PER_TASK``."""

    def tie(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u = v = np.empty(0, dtype=np.int64)
        held, size = [], 0
        for frame in frames:
            held.append((frame["u"].to_numpy(), frame["v"].to_numpy()))
            size += len(frame)
            if size > LINKS_PER_TASK:
                u, v = contracted(*(np.concatenate([x, *y]) for x, y in zip((u, v), zip(*held, strict=True), strict=True)))
                held, size = [], 0
        if held:
            u, v = contracted(*(np.concatenate([x, *y]) for x, y in zip((u, v), zip(*held, strict=True), strict=True)))
        yield pd.DataFrame({"u": u, "v": v})

    return (edges.coalesce(tasks) if tasks else edges).mapInPandas(tie, "u long, v long")


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """One contraction of directed edges ``u > v``, in ``tasks`` partitions.

    Large star: every neighbour above ``u`` is tied to the smallest vertex that
    ``u`` sees.  Small star: ``u`` and its smaller neighbours are tied to it."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        tied = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        tied = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = tied.union(low.select("u", F.col("m").alias("v")))
    return tied.where("u != v").coalesce(tasks).distinct().coalesce(tasks)


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every vertex of ``links``; the component is its smallest id.

    The links are first contracted inside the tasks, as many as their number asks
    for, then, if there are several, by star contractions across them; each of these
    is written to the checkpoint folder, so the lineage stays short.  Null ends and
    loops are left out, repeated links count once; an empty table gives an
    empty result."""
    edges = links.select(
        F.greatest(F.col(a), F.col(b)).cast("long").alias("u"), F.least(F.col(a), F.col(b)).cast("long").alias("v")
    ).where("u is not null and v is not null and u != v")
    # each partition contracts its own links before they are counted
    edges = checkpointed(_contract(edges))
    tasks = 1 + edges.count() // LINKS_PER_TASK
    first, edges = edges, checkpointed(_contract(edges, tasks))
    forget(first)
    state = None
    for _ in range(max_rounds if tasks > 1 else 0):
        before, edges = edges, checkpointed(_star(_star(edges, True, tasks), False, tasks))
        forget(before)
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        if tasks > 1:
            raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots).coalesce(tasks)
