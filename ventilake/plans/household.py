"""T4: household transform (raw household readings -> test_logement rows).

One lazy DataFrame plan instead of three row-by-row stages with per-row
database lookups and six aggregate join-backs:

1. the dimension tables are joined into one row per sensor (J1-J6), and the
   readings are joined with it once: calibrated temperature/hr for real
   sensors, 0.0 for virtual ones (F2, F3);
2. household means (A1, A2) joined back; virtual sensors take them (P4);
3. F4-F11 as column expressions; a sensor's breakpoints and winning bands are
   arrays that each reading searches (``operators.bands``);
4. household totals of extracted flow and equivalent surface (A3, F15, A5,
   A6), joined back; F16, F12.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import formulas as fx
from ..functions.naming import ntz_literal
from ..operators import bands as bd
from ..operators import household as hh
from ..operators import lookups as lk

BANDS = {
    "facteur_debit_position2": ("fct1", "fct2", "fct3", "fct4", "valeur_defaut"),
    "facteur_debit_pression2": ("fct1", "fct2", "fct3"),
}

MEASURES = ("temperature", "hr", "debit_position_1", "debit_pression_1", "co2")
OUTPUT_COLUMNS = (
    "capteur",
    "date",
    "temperature",
    "hr",
    "debit_position_1",
    "debit_pression_1",
    "co2",
    "debit_position_2",
    "debit_pression_2",
    "debit_produit",
    "surface_equivalente_ea",
    "pression_reelle",
    "debit_reelle",
    "humidite_absolue",
    "somme_debits_extraits",
    "somme_surface_equivalente",
)


def _with_rid(readings: DataFrame) -> DataFrame:
    if "rid" in readings.columns:
        return readings
    return readings.withColumn("rid", F.lit(None).cast("bigint"))


def calibrated_climate(readings: DataFrame, sensors: DataFrame, placed: Sequence[str] = ()) -> DataFrame:
    """Phase 1: J1 + J2 + F2 + F3.  ``sensors``: :func:`lookups.sensor_dimension`.
    Keeps the raw counts as ``raw_*`` columns.  ``placed``: columns that both sides
    are stored or shuffled by, joined on as well (``plans.placed``)."""
    # the measures travel as one array: every branch that an aggregate is joined
    # back to then asks for the same columns, and the shuffles below are reused
    r = _with_rid(readings).select("rid", "capteur", "date", *placed, F.array(*MEASURES).alias("__raw"))
    at = {c: f"__at_{c}" for c in placed}
    same = [F.col("capteur") == F.col("id_capteur"), *[F.col(c) == F.col(a) for c, a in at.items()]]
    joined = hh.keyed(r.join(sensors.withColumnsRenamed(at), same, "inner").drop("id_capteur", *at.values()))
    joined = joined.withColumns({f"raw_{m}": F.col("__raw")[i] for i, m in enumerate(MEASURES)}).drop("__raw")
    t = fx.temperature("raw_temperature", "__fct_t")
    return joined.withColumn("temperature", F.when(F.col("reel"), t).otherwise(F.lit(0.0))).withColumn(
        "hr", F.when(F.col("reel"), fx.relative_humidity("raw_hr", "temperature")).otherwise(F.lit(0.0))
    )


def check_factors(missing: DataFrame) -> None:
    """Strict mode (the original aborted on a missing required factor): raise
    if ``missing`` (:func:`lookups.missing_factors`) has rows.  Only a handful
    of keys reach the driver for the message."""
    sample = missing.take(20)
    if sample:
        keys = ", ".join(f"{r['factor_table']}:{r['key']}" for r in sample)
        raise ValueError(f"missing required factors (first {len(sample)}): {keys}")


def band_pages(dims: dict[str, DataFrame], most: int = bd.MOST) -> dict[str, bd.Pages | None]:
    """The pages of sensors with more bands than one array should hold (this runs jobs)."""
    return {table: bd.band_pages(dims[table], names, most) for table, names in BANDS.items()}


def calibrated_flow(filled: DataFrame, pages: dict[str, bd.Pages | None] | None = None) -> DataFrame:
    """Phase 3: J3, J4, J5 and F4-F11 (debit_*, co2, debit_produit, surface, humidity)."""
    real = F.col("reel")
    # band keys: raw position for real sensors, household hr for virtual ones (J4);
    # always the raw position for the pressure bands
    searched = {
        "__p2": ("facteur_debit_position2", F.when(real, F.col("raw_debit_position_1")).otherwise(F.col("hr"))),
        "__q2": ("facteur_debit_pression2", F.col("raw_debit_position_1")),
    }
    found = {}
    for name, (table, key) in searched.items():
        found[name] = bd.winner(F.col(f"__points_{table}"), F.col(f"__winners_{table}"), key)
        if pages and pages.get(table) is not None:
            filled = bd.paged_winner(filled, pages[table], "capteur", key, f"{name}_paged")
            found[name] = F.coalesce(found[name], F.col(f"{name}_paged"))
    stage = filled.withColumns(
        found
        | {
            "debit_position_1": F.when(
                real, fx.flow_position_1("raw_debit_position_1", "__fct_p1", "piece")
            ).otherwise(F.lit(0.0)),
            "debit_pression_1": F.when(real, fx.flow_pressure_1("raw_debit_pression_1")).otherwise(F.lit(0.0)),
            "co2": F.when(real, fx.co2("raw_co2", "type")).otherwise(F.lit(0.0)),
        }
    )
    stage = stage.withColumns(
        {"__p2_matched": F.col("__p2").isNotNull(), "__q2_matched": F.col("__q2").isNotNull()}
    )
    stage = stage.withColumns(
        {
            "debit_position_2": fx.flow_position_2(
                "reel",
                "piece",
                "__p2_matched",
                "debit_position_1",
                "hr",
                "__p2.fct1",
                "__p2.fct2",
                "__p2.fct3",
                "__p2.fct4",
                "__p2.valeur_defaut",
            ),
            "debit_pression_2": fx.flow_pressure_2(
                "type", "__q2_matched", "debit_pression_1", "__q2.fct1", "__q2.fct2", "__q2.fct3"
            ),
        }
    )
    stage = stage.withColumn(
        "debit_produit", fx.produced_flow("debit_pression_2", "debit_position_2", "type", "piece")
    ).withColumns(
        {
            "humidite_absolue": fx.absolute_humidity("hr", "temperature"),
            "surface_equivalente_ea": fx.equivalent_surface("debit_produit", "type"),
        }
    )
    return stage.drop(*[c for c in stage.columns if c.startswith("__") and c != "__fct_s"])


def balance(flow: DataFrame, keys: Sequence[str] = hh.KEYS) -> DataFrame:
    """Phase 4: household totals, real pressure and real flow."""
    out = flow.join(hh.household_totals(flow, keys), list(keys), "inner")
    out = out.withColumn("pression_reelle", fx.real_pressure("somme_debits_extraits", "somme_surface_equivalente"))
    return out.withColumn("debit_reelle", fx.real_flow("somme_surface_equivalente", "pression_reelle"))


def day_range(df: DataFrame, day_from=None, day_to=None, column: str = "date") -> DataFrame:
    """P5: keep rows of ``[day_from, day_to)`` (either bound optional)."""
    if day_from is not None:
        df = df.where(F.col(column) >= ntz_literal(day_from))
    if day_to is not None:
        df = df.where(F.col(column) < ntz_literal(day_to))
    return df


def household_stages(
    readings: DataFrame, dims: dict[str, DataFrame], real_only: bool = False, pages: dict[str, bd.Pages | None] | None = None
) -> dict[str, DataFrame]:
    """All intermediate frames of T4 (used by the operator-level queries).

    ``real_only``: household means over real sensors only (the original counts
    virtual sensors as 0.0).  ``pages`` (:func:`band_pages`): for sensors with very
    many bands.  Nothing runs while the frames are built."""
    climate = calibrated_climate(readings, lk.sensor_dimension(dims, BANDS, pages))
    return climate_stages(climate, real_only, pages)


def climate_stages(
    climate: DataFrame, real_only: bool = False, pages: dict[str, bd.Pages | None] | None = None, keys: Sequence[str] = hh.KEYS
) -> dict[str, DataFrame]:
    """Phases 2 to 4 on the rows of phase 1; ``keys`` make up a household-minute."""
    filled = hh.fill_virtual(climate, hh.household_means(climate, keys, real_only), keys)
    flow = calibrated_flow(filled, pages)
    return {"climate": climate, "filled": filled, "flow": flow.drop("__fct_s"), "final": balance(flow, keys)}


def household_balance(
    readings: DataFrame,
    dims: dict[str, DataFrame],
    day_from=None,
    day_to=None,
    real_only: bool = False,
    strict: bool = False,
    pages: dict[str, bd.Pages | None] | None = None,
) -> DataFrame:
    """T4: test_logement rows for readings of ``[day_from, day_to)``.

    The day filter is applied to the readings before the first join; a
    household-minute lies entirely inside one day, so filtering first gives
    the same rows as the original's filter at the end.  ``strict``: raise on
    missing required factors instead of producing nulls (this looks at the
    data, so it runs a job).
    """
    readings = day_range(readings, day_from, day_to)
    if strict:
        known = hh.keyed(lk.join_sensor_dim(readings, dims["capteur"]))
        check_factors(
            lk.missing_factors(known, dims["facteur_temperature"], dims["facteur_somme_surface_equivalente"])
        )
    return household_stages(readings, dims, real_only, pages)["final"].select(*OUTPUT_COLUMNS)
