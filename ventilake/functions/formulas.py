"""Calibration formulas as Spark Column expressions.

Every function takes and returns ``pyspark.sql.Column`` objects, so the
formulas stay inside whole-stage codegen.  Null inputs give null outputs.
The arithmetic is written in the same operation order as the original
formulas so that double results are reproducible bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_wc(piece) -> Column:
    """Room is a WC; a null room counts as not WC."""
    return F.coalesce(_c(piece).contains(X.ROOM_WC), F.lit(False))


def is_type(typ, value: str) -> Column:
    return F.coalesce(_c(typ) == F.lit(value), F.lit(False))


def temperature(raw, fct1) -> Column:
    """F2: 0.01 * raw - fct1."""
    return F.lit(X.TEMP_SCALE) * _c(raw) - _c(fct1)


def relative_humidity(raw, temp) -> Column:
    """(t-25)*(0.01+0.00008*b) + 0.0405*b + (-0.0000028)*(b*b) - 4."""
    b, t = _c(raw), _c(temp)
    return (
        (t - F.lit(X.HR_T_REF)) * (F.lit(X.HR_A) + F.lit(X.HR_B) * b)
        + F.lit(X.HR_C) * b
        + F.lit(X.HR_D) * (b * b)
        - F.lit(X.HR_E)
    )


def flow_position_1(raw, fct1, piece) -> Column:
    """raw/1023*2.5 - fct1, 0.0 in a WC."""
    return F.when(is_wc(piece), F.lit(0.0)).otherwise(
        _c(raw) / F.lit(X.RAW_FULL_SCALE) * F.lit(X.FLOW_POSITION_SPAN) - _c(fct1)
    )


def flow_pressure_1(raw) -> Column:
    """raw/1023*4.5."""
    return _c(raw) / F.lit(X.RAW_FULL_SCALE) * F.lit(X.FLOW_PRESSURE_SPAN)


def co2(raw, typ) -> Column:
    """raw*2000/818 for air inlets and stations, else 0.0."""
    keep = F.coalesce(_c(typ).isin(X.TYPE_AIR_INLET, X.TYPE_STATION), F.lit(False))
    return F.when(keep, _c(raw) * F.lit(X.CO2_NUM) / F.lit(X.CO2_DEN)).otherwise(F.lit(0.0))


def flow_position_2(reel, piece, matched, d, hr, fct1, fct2, fct3, fct4, default) -> Column:
    """F7 given the winning band (``matched`` false when no band covers the key).

    Real sensor: polynomial of the calibrated position ``d``; virtual sensor:
    ``fct1*hr + fct2``.  A positive default value replaces the formula.
    """
    poly_real = (
        _c(fct1)
        + _c(fct2) * _c(d)
        + _c(fct3) * F.pow(_c(d), F.lit(2.0))
        + _c(fct4) * F.pow(_c(d), F.lit(3.0))
    )
    poly_virtual = _c(fct1) * _c(hr) + _c(fct2)
    formula = F.when(_c(reel), poly_real).otherwise(poly_virtual)
    banded = F.when(_c(default) <= F.lit(0.0), formula).otherwise(_c(default))
    return (
        F.when(is_wc(piece), F.lit(0.0))
        .when(_c(matched), banded)
        .otherwise(F.lit(0.0))
    )


def flow_pressure_2(typ, matched, p, fct1, fct2, fct3) -> Column:
    """F8: extract vents only, fct1 + fct2*p + fct3*(p*p) of the winning band."""
    poly = _c(fct1) + _c(fct2) * _c(p) + _c(fct3) * (_c(p) * _c(p))
    return (
        F.when(~is_type(typ, X.TYPE_EXTRACT_VENT), F.lit(0.0))
        .when(_c(matched), poly)
        .otherwise(F.lit(0.0))
    )


def produced_flow(pressure_2, position_2, typ, piece) -> Column:
    """(1+pressure_2)*position_2 for extract vents outside a WC, else position_2."""
    vent = is_type(typ, X.TYPE_EXTRACT_VENT) & ~is_wc(piece)
    return F.when(vent, (F.lit(1.0) + _c(pressure_2)) * _c(position_2)).otherwise(_c(position_2))


def absolute_humidity(hr, temp) -> Column:
    """hr/100 * exp(18.8161 - 4110.34/(t+235)); null where t = -235."""
    expo = F.lit(X.AH_A) - F.try_divide(F.lit(X.AH_B), _c(temp) + F.lit(X.AH_C))
    return _c(hr) / F.lit(100.0) * F.exp(expo)


def equivalent_surface(flow, typ) -> Column:
    """flow/sqrt(2) for air inlets, else 0.0."""
    return F.when(is_type(typ, X.TYPE_AIR_INLET), _c(flow) / F.sqrt(F.lit(2.0))).otherwise(F.lit(0.0))


def real_flow(surface, pressure) -> Column:
    """surface * sqrt(pressure/10); NaN for a negative pressure, null for null."""
    return _c(surface) * F.sqrt(_c(pressure) / F.lit(10.0))


def real_pressure(extracted, surface) -> Column:
    """F16: extracted / surface^2, null when the divisor is 0."""
    return F.try_divide(_c(extracted), _c(surface) * _c(surface))


def wind_direction(raw) -> Column:
    """half-up rounding of raw/1023*360 as int, 360 and more -> 0."""
    deg = F.floor(_c(raw) / F.lit(X.RAW_FULL_SCALE) * F.lit(X.FULL_CIRCLE) + F.lit(0.5))
    return F.when(deg >= F.lit(int(X.FULL_CIRCLE)), F.lit(0)).otherwise(deg).cast("int")


def wind_speed(raw) -> Column:
    """raw/1023*2.1*207.5/2.1 + 2.5, same operation order."""
    return (
        _c(raw) / F.lit(X.RAW_FULL_SCALE) * F.lit(X.WIND_GAIN) * F.lit(X.WIND_SPAN) / F.lit(X.WIND_GAIN)
        + F.lit(X.WIND_OFFSET)
    )


def compass(orientation) -> Column:
    """8-point compass label; exactly 337.5 gives ''. Null stays null."""
    o = _c(orientation).cast("double")
    expr = F.when(o.isNull(), F.lit(None).cast("string")).when(
        (o <= F.lit(X.COMPASS_NORTH_LOW)) | (o > F.lit(X.COMPASS_NORTH_HIGH)), F.lit(X.COMPASS_NORTH)
    )
    for label, low, high in X.COMPASS_SECTORS:
        expr = expr.when((o >= F.lit(low)) & (o < F.lit(high)), F.lit(label))
    return expr.otherwise(F.lit(X.COMPASS_NONE))


def wind_class(speed) -> Column:
    """wind speed class label. Null stays null."""
    s = _c(speed)
    expr = F.when(s.isNull(), F.lit(None).cast("string"))
    for bound, label in X.WIND_CLASSES:
        expr = expr.when(s < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(X.WIND_CLASS_TOP))


def fan_power(raw) -> Column:
    """1.1122*raw - 5.4133."""
    return F.lit(X.FAN_POWER_A) * _c(raw) - F.lit(X.FAN_POWER_B)


def fan_pressure(raw) -> Column:
    """0.7177*raw - 43.485."""
    return F.lit(X.FAN_PRESSURE_A) * _c(raw) - F.lit(X.FAN_PRESSURE_B)
