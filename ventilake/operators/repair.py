"""Sentinel repair of raw readings (lag, forward fill, seeded fill).

The boxes write the error code ``61440`` instead of a measure.  A reading in
error takes the last earlier value of the same series that is neither null nor
in error; errors at the start of a series stay null unless a seed (last good
value of an earlier batch) is available.

Partitioning: the fill runs per *file* (one box, one day) or per (sensor, day),
never over one global partition, so a sensor with a long or very dense history
is spread over many tasks.  Carrying values across days goes through a
per-(sensor, day) summary, which is tiny compared with the readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import SENTINEL
from ..functions.naming import day_of


def _good(c: str, sentinel: float) -> Column:
    return F.nullif(F.col(c), F.lit(sentinel))


# stand-in for a null timestamp in order keys: before any real date (nulls sort first)
_NULL_MICROS = "-100000000000000000"


def order_key(date: str, tiebreak: Sequence[str] = ()) -> Column:
    """One sortable, non-null value for the order (date NULLS FIRST, tiebreak).

    With no tiebreak, the timestamp itself; with one integral tiebreak, the
    exact decimal ``micros * 10^20 + tiebreak`` (a primitive-like key keeps
    ``max_by`` in a hash aggregate; a struct key would force a sort-based
    aggregate that sorts all raw rows on the map side).  Other tiebreaks fall
    back to a struct.  Micros are taken in the session time zone (UTC by
    default), where wall-clock order and instant order agree.
    """
    if not tiebreak:
        return F.coalesce(F.col(date), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    if len(tiebreak) == 1:
        micros = F.coalesce(
            F.unix_micros(F.col(date).cast("timestamp")).cast("decimal(20,0)"),
            F.lit(_NULL_MICROS).cast("decimal(20,0)"),
        )
        shift = F.lit("100000000000000000000").cast("decimal(21,0)")
        tb = F.coalesce(F.col(tiebreak[0]).cast("decimal(20,0)"), F.lit(-1).cast("decimal(20,0)"))
        return (micros * shift + tb).cast("decimal(38,0)")
    return F.struct(F.col(date).isNotNull(), F.col(date), *[F.col(c) for c in tiebreak])


def lag_previous(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = ("capteur",),
    order: Sequence[str] = ("date",),
    suffix: str = "_prev",
) -> DataFrame:
    """Previous value of each column within a series (``lag(c, 1)``)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.select("*", *[F.lag(c, 1).over(w).alias(c + suffix) for c in columns])


def repair_sentinels(
    df: DataFrame,
    measures: Sequence[str],
    by: Sequence[str],
    order: Sequence[str] = ("date",),
    sentinel: float = SENTINEL,
) -> DataFrame:
    """Replace error codes by the last good earlier value within ``by``.

    Equal to the lag / temp_adjust / zeroNonZero / forward-fill chain of the
    original, written as one window with all measure columns.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    repaired = {c: F.last(_good(c, sentinel), ignorenulls=True).over(w) for c in measures}
    return df.withColumns(repaired)


def repair_bucketed(
    df: DataFrame,
    measures: Sequence[str],
    series: Sequence[str],
    bucket: Column,
    date: str = "date",
    tiebreak: Sequence[str] = (),
    sentinel: float = SENTINEL,
) -> DataFrame:
    """W3 over each ``series``, computed in ordered buckets of it.

    ``bucket`` must be a non-decreasing function of the order (e.g. the hour
    of ``date``).  1. forward fill inside each (series, bucket); 2. per
    (series, bucket): the last good value (a hash aggregate, combined on the
    map side); 3. per series, over those bucket rows only: the last non-null
    value of the *earlier* buckets -- the carry; 4. ``coalesce(fill, carry)``.

    Equal to one forward fill over the whole series, but no window partition
    holds more than one bucket of one series, however long or hot the series.
    Rows whose series key is null keep the fill of their bucket only.
    """
    b = "__bucket"
    # never null, so that the carry is joined by plain equality on the keys the
    # window is partitioned by, and the readings are shuffled once
    base = df.withColumn(b, F.coalesce(bucket, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")))
    filled = repair_sentinels(base, measures, by=(*series, b), order=[date, *tiebreak], sentinel=sentinel)
    position = order_key(date, tiebreak)
    per_bucket = base.groupBy(*series, b).agg(
        *[F.max_by(_good(c, sentinel), F.when(_good(c, sentinel).isNotNull(), position)).alias(c) for c in measures]
    )
    earlier = Window.partitionBy(*series).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        *series, b, *[F.last(c, ignorenulls=True).over(earlier).alias("__seed_" + c) for c in measures]
    )
    joined = filled.join(carry, [*series, b], "left")
    out = joined.withColumns({c: F.coalesce(F.col(c), F.col("__seed_" + c)) for c in measures})
    return out.select(*df.columns)


def repair_seeded(
    df: DataFrame,
    measures: Sequence[str],
    sensor: str = "capteur",
    date: str = "date",
    tiebreak: Sequence[str] = (),
    sentinel: float = SENTINEL,
    bucket_unit: str = "day",
) -> DataFrame:
    """T3 over a whole history: errors take the last good value of the sensor,
    across files and days (leading errors of a day are seeded from earlier
    days).  Computed per (sensor, ``bucket_unit``) with carried values, so a
    sensor's history is split into days (or hours)."""
    bucket = F.date_trunc(bucket_unit, F.col(date)).cast("timestamp_ntz")
    return repair_bucketed(df, measures, (sensor,), bucket, date, tiebreak, sentinel)


def repair_per_day(
    df: DataFrame,
    measures: Sequence[str],
    sensor: str = "capteur",
    date: str = "date",
    tiebreak: Sequence[str] = (),
    sentinel: float = SENTINEL,
) -> DataFrame:
    """W3 per (sensor, day) -- one file of the original -- leading errors of
    each day stay null.  Computed per sensor-hour with carried values."""
    tmp = "__series_day"
    d = df.withColumn(tmp, day_of(date))
    bucket = F.date_trunc("hour", F.col(date)).cast("timestamp_ntz")
    return repair_bucketed(d, measures, (sensor, tmp), bucket, date, tiebreak, sentinel).drop(tmp)


def seed_values(
    history: DataFrame,
    measures: Sequence[str],
    before,
    sensor: str = "capteur",
    date: str = "date",
    tiebreak: Sequence[str] = (),
    sentinel: float = SENTINEL,
) -> DataFrame:
    """Per sensor and column, the last good value strictly before ``before``.

    One hash aggregate with one ``max_by`` per column, each restricted to its
    own good rows."""
    h = history.where(F.col(date) < F.lit(before))
    position = order_key(date, tiebreak)
    return h.groupBy(sensor).agg(
        *[F.max_by(F.col(c), F.when(_good(c, sentinel).isNotNull(), position)).alias("__seed_" + c) for c in measures]
    )


def apply_seeds(
    filled: DataFrame, seeds: DataFrame, measures: Sequence[str], keys: Sequence[str] = ("capteur",)
) -> DataFrame:
    """Fill the leading nulls of a repaired batch with seeds (``__seed_<measure>`` per ``keys``)."""
    joined = filled.join(seeds, list(keys), "left")
    out = joined.withColumns({c: F.coalesce(F.col(c), F.col("__seed_" + c)) for c in measures})
    return out.drop(*["__seed_" + c for c in measures])


def last_good(repaired: DataFrame, measures: Sequence[str], day: str = "day", keys: Sequence[str] = ()) -> DataFrame:
    """The state that later days are seeded from: per sensor, file day, ``keys`` and
    ``usable`` (the later of file day and day of the reading: the value may
    seed files of later days only), the last good value of each measure and
    its time ``<measure>_date``.  One or two rows per file."""
    rows = repaired.where(F.col("capteur").isNotNull() & F.col("date").isNotNull() & F.col(day).isNotNull())
    usable = F.greatest(F.col(day), F.col("date").cast("date")).alias("usable")
    pairs = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("date").alias("d"), F.col(c).alias("v"))) for c in measures}
    rows = rows.select("capteur", day, *keys, usable, *[p.alias(c) for c, p in pairs.items()])
    return _latest(rows, measures, ("capteur", day, "usable", *keys))


def _latest(pairs: DataFrame, measures: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per key the latest (time, value) of each measure; of one time the larger value."""
    best = pairs.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])
    return best.select(*keys, *[x for c in measures for x in (F.col(c)["v"].alias(c), F.col(c)["d"].alias(c + "_date"))])


def compact_state(state: DataFrame, measures: Sequence[str], as_of, day: str = "day") -> DataFrame:
    """The state (:func:`last_good`) of files before ``as_of``, as the days from ``as_of`` on see it.

    A mergeable maximum: one row per sensor, and one more for values that may
    not seed ``as_of`` itself yet; merging it with later rows gives the same seeds
    as all its rows would.  Stored under the day ``as_of``."""
    usable = F.greatest(F.col("usable"), F.date_sub(F.lit(as_of).cast("date"), 1)).alias("usable")
    pairs = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c + "_date").alias("d"), F.col(c).alias("v"))) for c in measures}
    rows = state.select("capteur", usable, *[p.alias(c) for c, p in pairs.items()])
    return _latest(rows, measures, ("capteur", "usable")).withColumn(day, F.lit(as_of).cast("date"))


def seeds_by_day(state: DataFrame, targets: DataFrame, measures: Sequence[str], day: str = "day") -> DataFrame:
    """Seeds of each (sensor, file day) in ``targets``: the last good values of
    ``state`` (:func:`last_good`) that were usable before that day.

    A running maximum by time over one row per file, never over readings."""
    events = state.select(
        "capteur",
        F.date_add("usable", 1).alias("__at"),
        F.lit(0).alias("__ask"),
        *[F.when(F.col(c).isNotNull(), F.struct(F.col(c + "_date").alias("d"), F.col(c).alias("v"))).alias(c) for c in measures],
    )
    asks = targets.select("capteur", F.col(day).alias("__at"), F.lit(1).alias("__ask")).distinct()
    w = Window.partitionBy("capteur").orderBy("__at", "__ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = events.unionByName(asks, allowMissingColumns=True)
    seen = both.select("capteur", "__at", "__ask", *[F.max(c).over(w)["v"].alias("__seed_" + c) for c in measures])
    return seen.where("__ask = 1").drop("__ask").withColumnRenamed("__at", day)
