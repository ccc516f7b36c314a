"""Band (range) lookups through breakpoints with their winners worked out in advance.

The ends of a sensor's bands cut its axis into elementary intervals; on each of
them one band wins everywhere, the one with the highest ``borne_inf`` (ties go to
the larger of the other columns), or none.  A lookup is a binary search for the
last breakpoint at or below the value.

- A sensor of up to ``MOST`` bands has its breakpoints and winners as two arrays
  in its dimension row (``band_index``, column expressions, no job).
- Sensors beyond that are found by ``band_pages``: their breakpoints are numbered
  by a sort by range, every band is cut into dyadic runs of breakpoints (at most
  two per power of two), the best band of each run is kept, and a breakpoint's
  winner is the best of the runs that hold it.  No task sees all bands of a
  sensor.  The breakpoints are stored in pages of ``PAGE``; a reading finds its
  page by binary search over the page starts and joins it on (sensor, page).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 1024
PAGE = 1024


class Pages(NamedTuple):
    """The breakpoints of large sensors."""

    #: ``capteur_facteur, starts, numbers``: first breakpoint and number of each page
    starts: DataFrame
    #: ``capteur_facteur, page, points, winners``
    pages: DataFrame


def cleaned(bands: DataFrame, coefficients: Sequence[str]) -> DataFrame:
    """``capteur_facteur, band``: the bands as structs whose order is the order of winning.

    SQL NULLs are read as 0.0, as a JDBC ``getDouble`` does; empty bands can match
    nothing and are left out."""
    cols = ["borne_inf", "borne_sup", *coefficients]
    b = bands.select("capteur_facteur", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols])
    return b.where("borne_inf < borne_sup and capteur_facteur is not null").select("capteur_facteur", F.struct(*cols).alias("band"))


def band_index(bands: DataFrame, coefficients: Sequence[str], pages: Pages | None = None) -> DataFrame:
    """``capteur_facteur, points, winners`` of each sensor that is not in ``pages`` (dimension-sized work)."""
    b = cleaned(bands, coefficients)
    if pages is not None:
        b = b.join(pages.starts.select("capteur_facteur"), "capteur_facteur", "left_anti")
    held = b.groupBy("capteur_facteur").agg(F.collect_list("band").alias("bands"))
    ends = F.concat(F.transform("bands", lambda x: x["borne_inf"]), F.transform("bands", lambda x: x["borne_sup"]))
    held = held.withColumn("points", F.array_sort(F.array_distinct(ends)))
    best = F.transform(
        "points",
        lambda p: F.array_max(F.filter("bands", lambda x: (p >= x["borne_inf"]) & (p < x["borne_sup"]))),
    )
    return held.select("capteur_facteur", "points", best.alias("winners"))


def last_at_most(points: Column, value: Column, most: int) -> Column:
    """Position (from 1) of the last of the sorted ``points`` at or below ``value``, 0 if there is none.

    ``most``: the length that a binary search has steps for."""

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["low"] + state["high"] + 1, 1)
        here = F.coalesce(F.get(points, middle - 1) <= value, F.lit(False))
        done = state["low"] >= state["high"]
        low = F.when(~done & here, middle).otherwise(state["low"])
        high = F.when(~done & ~here, middle - 1).otherwise(state["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.greatest(F.size(points), F.lit(0)).alias("high"))
    steps = F.array(*[F.lit(0)] * most.bit_length())
    return F.aggregate(steps, start, halve, lambda state: state["low"])


def winner(points: Column, winners: Column, value: Column, most: int = 2 * MOST) -> Column:
    """The winning band of ``value`` (null if none, also for null and NaN)."""
    return F.get(winners, last_at_most(points, value, most) - 1)


def band_pages(bands: DataFrame, coefficients: Sequence[str], most: int = MOST, page: int = PAGE) -> Pages | None:
    """The pages of all sensors with more than ``most`` bands; None where there are none (this runs jobs)."""
    b = cleaned(bands, coefficients)
    large = b.groupBy("capteur_facteur").count().where(F.col("count") > most).select("capteur_facteur").checkpoint(eager=True)
    if large.isEmpty():
        return None
    # of bands with one lower end the largest wins wherever it reaches, and it reaches farthest
    b = b.join(large, "capteur_facteur").groupBy("capteur_facteur", F.col("band.borne_inf").alias("low")).agg(F.max("band").alias("band"))
    b = b.select("capteur_facteur", "low", F.col("band.borne_sup").alias("high"), "band").checkpoint(eager=True)

    # breakpoints numbered in the order of (sensor, point), all sensors in one sequence
    key = ["capteur_facteur", "point"]
    points = b.select("capteur_facteur", F.col("low").alias("point")).union(b.select("capteur_facteur", "high")).distinct()
    placed = points.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("place", F.monotonically_increasing_id())
    placed = placed.checkpoint(eager=True)
    part, before = F.shiftright("place", 33), 0
    shift = []
    for number, size in sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect())):  # one number per partition
        shift.append((number, before - (number << 33)))
        before += size
    shift = b.sparkSession.createDataFrame(shift, "part long, shift long")
    points = placed.withColumn("part", part).join(shift, "part").select(*key, (F.col("place") + F.col("shift")).alias("rank"))
    points = points.checkpoint(eager=True)

    # each band as the run of breakpoints first <= rank < last, in dyadic pieces (power, piece)
    run = b.join(points.withColumnsRenamed({"point": "low", "rank": "first"}), ["capteur_facteur", "low"])
    run = run.join(points.withColumnsRenamed({"point": "high", "rank": "last"}), ["capteur_facteur", "high"])
    run = run.select("band", "first", "last").checkpoint(eager=True)
    powers = int(run.agg(F.max(F.col("last") - F.col("first"))).first()[0]).bit_length()
    pieces = []
    for k in range(powers):
        first, last = F.shiftright(F.col("first") + ((1 << k) - 1), k), F.shiftright(F.col("last"), k)
        for piece, odd in ((first, first), (last - 1, last)):
            there = (first < last) & (odd.bitwiseAND(F.lit(1)) == 1)
            pieces.append(F.when(there, F.struct(F.lit(k).alias("power"), piece.alias("piece"))))
    best = run.select("band", F.explode(F.array_compact(F.array(*pieces))).alias("at"))
    best = best.groupBy("at.power", "at.piece").agg(F.max("band").alias("band"))

    # the winner at a breakpoint: the best of the pieces that hold it
    holders = F.explode(F.array(*[F.struct(F.lit(k).alias("power"), F.shiftright("rank", k).alias("piece")) for k in range(powers)]))
    held = points.select("rank", holders.alias("at")).select("rank", "at.power", "at.piece").join(best, ["power", "piece"])
    won = points.join(held.groupBy("rank").agg(F.max("band").alias("band")), "rank", "left")
    numbered = won.withColumn("page", F.floor(F.col("rank") / page).cast("long"))
    pages = numbered.groupBy("capteur_facteur", "page").agg(F.array_sort(F.collect_list(F.struct("point", "band"))).alias("all"))
    pages = pages.select("capteur_facteur", "page", F.col("all.point").alias("points"), F.col("all.band").alias("winners"))
    pages = pages.checkpoint(eager=True)
    starts = pages.groupBy("capteur_facteur").agg(F.array_sort(F.collect_list(F.struct(F.col("points")[0].alias("s"), "page"))).alias("all"))
    starts = starts.select("capteur_facteur", F.col("all.s").alias("starts"), F.col("all.page").alias("numbers"))
    return Pages(starts.checkpoint(eager=True), pages)


def paged_winner(df: DataFrame, pages: Pages, sensor: str, value: Column, name: str, page: int = PAGE) -> DataFrame:
    """``df`` with the winning band of ``value`` as column ``name``, for sensors in ``pages`` (null for others)."""
    key, number, points, winners = (f"__{x}_{name}" for x in ("key", "page", "points", "winners"))
    starts = pages.starts.select(F.col("capteur_facteur").alias(key), F.col("starts").alias(points), F.col("numbers").alias(winners))
    out = df.join(starts, df[sensor] == F.col(key), "left")
    # 31 steps: as many pages as an array can have
    out = out.withColumn(number, F.get(F.col(winners), last_at_most(F.col(points), value, (1 << 31) - 1) - 1)).drop(key, points, winners)
    held = pages.pages.select(
        F.col("capteur_facteur").alias(key), F.col("page").alias(number), F.col("points").alias(points), F.col("winners").alias(winners)
    )
    out = out.join(held, (out[sensor] == held[key]) & (out[number] == held[number]), "left").drop(held[number])
    return out.withColumn(name, winner(F.col(points), F.col(winners), value, page)).drop(key, number, points, winners)
