"""Hand-computed values of the calibration formulas, with their boundaries."""

import math

import pytest
from pyspark.sql import functions as F

from ventilake.functions import formulas as fx


STRING_COLUMNS = {"p", "piece", "t", "r"}


def _type(name, value):
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, str) or (value is None and name in STRING_COLUMNS):
        return "string"
    return "double"


def one(spark, expr, **cols):
    names = list(cols)
    row = tuple(cols[n] for n in names)
    schema = ", ".join(f"{n} {_type(n, v)}" for n, v in cols.items())
    df = spark.createDataFrame([row], schema)
    return df.select(expr.alias("r")).first()["r"]


def test_temperature_and_hr(spark):
    assert one(spark, fx.temperature("b", "f"), b=4500.0, f=1.0) == pytest.approx(44.0)
    t = 20.0
    b = 400.0
    expected = (t - 25) * (0.01 + 0.00008 * b) + 0.0405 * b + (-0.0000028) * (b * b) - 4
    assert one(spark, fx.relative_humidity("b", "t"), b=b, t=t) == expected


def test_flow_position_1_wc(spark):
    assert one(spark, fx.flow_position_1("b", "f", "p"), b=1023.0, f=0.5, p="Sejour") == pytest.approx(2.0)
    assert one(spark, fx.flow_position_1("b", "f", "p"), b=1023.0, f=0.5, p="WC 1") == 0.0
    # a null room counts as not WC
    assert one(spark, fx.flow_position_1("b", "f", "p"), b=1023.0, f=0.5, p=None) == pytest.approx(2.0)


def test_co2_types(spark):
    assert one(spark, fx.co2("b", "t"), b=818.0, t="EA") == pytest.approx(2000.0)
    assert one(spark, fx.co2("b", "t"), b=818.0, t="Station") == pytest.approx(2000.0)
    assert one(spark, fx.co2("b", "t"), b=818.0, t="Bouche") == 0.0


def test_flow_position_2_branches(spark):
    args = dict(reel=True, piece="Sejour", m=True, d=2.0, hr=50.0, f1=1.0, f2=2.0, f3=3.0, f4=4.0, v=0.0)
    e = fx.flow_position_2("reel", "piece", "m", "d", "hr", "f1", "f2", "f3", "f4", "v")
    assert one(spark, e, **args) == 1 + 2 * 2 + 3 * 4 + 4 * 8
    assert one(spark, e, **{**args, "v": 7.5}) == 7.5
    assert one(spark, e, **{**args, "reel": False}) == 1.0 * 50 + 2.0
    assert one(spark, e, **{**args, "piece": "WC"}) == 0.0
    assert one(spark, e, **{**args, "m": False}) == 0.0


def test_flow_pressure_2_only_vents(spark):
    e = fx.flow_pressure_2("t", "m", "p", "f1", "f2", "f3")
    assert one(spark, e, t="Bouche", m=True, p=2.0, f1=1.0, f2=2.0, f3=3.0) == 1 + 4 + 12
    assert one(spark, e, t="EA", m=True, p=2.0, f1=1.0, f2=2.0, f3=3.0) == 0.0


def test_produced_flow_and_surface(spark):
    assert one(spark, fx.produced_flow("q", "p", "t", "r"), q=0.5, p=2.0, t="Bouche", r="Sejour") == 3.0
    assert one(spark, fx.produced_flow("q", "p", "t", "r"), q=0.5, p=2.0, t="Bouche", r="WC") == 2.0
    assert one(spark, fx.equivalent_surface("x", "t"), x=2.0, t="EA") == pytest.approx(math.sqrt(2))
    assert one(spark, fx.equivalent_surface("x", "t"), x=2.0, t="Bouche") == 0.0


def test_absolute_humidity_and_real_values(spark):
    v = one(spark, fx.absolute_humidity("h", "t"), h=50.0, t=20.0)
    assert v == pytest.approx(0.5 * math.exp(18.8161 - 4110.34 / 255.0))
    assert one(spark, fx.absolute_humidity("h", "t"), h=50.0, t=-235.0) is None
    assert one(spark, fx.real_pressure("q", "s"), q=4.0, s=0.0) is None
    assert one(spark, fx.real_pressure("q", "s"), q=4.0, s=2.0) == 1.0
    assert math.isnan(one(spark, fx.real_flow("s", "p"), s=1.0, p=-10.0))
    assert one(spark, fx.real_flow("s", "p"), s=2.0, p=40.0) == pytest.approx(4.0)


@pytest.mark.parametrize(
    "raw,deg",
    [(0.0, 0), (1023.0, 0), (511.5, 180), (1.0, 0), (2.0, 1), (1022.0, 0)],
)
def test_wind_direction_rounding(spark, raw, deg):
    # half-up rounding, 360 wraps to 0 (raw 1022 -> 359.6 -> 360 -> 0)
    assert one(spark, fx.wind_direction("b"), b=raw) == deg


@pytest.mark.parametrize(
    "o,label",
    [(0.0, "Nord"), (22.5, "Nord"), (23.0, "Nord Est"), (67.5, "Est"), (180.0, "Sud"), (337.0, "Nord Ouest"),
     (337.5, ""), (338.0, "Nord"), (None, None)],
)
def test_compass(spark, o, label):
    assert one(spark, fx.compass("o"), o=o) == label


@pytest.mark.parametrize(
    "v,label",
    [(0.4, "<0.5 m/s"), (0.5, "0.5-2 m/s"), (1.99, "0.5-2 m/s"), (2.0, "2-4 m/s"), (9.99, "8-10 m/s"),
     (10.0, ">10 m/s"), (None, None)],
)
def test_wind_class(spark, v, label):
    assert one(spark, fx.wind_class("v"), v=v) == label


def test_wind_speed_and_fan(spark):
    assert one(spark, fx.wind_speed("b"), b=0.0) == 2.5
    assert one(spark, fx.wind_speed("b"), b=1023.0) == pytest.approx(210.0)
    assert one(spark, fx.fan_power("b"), b=10.0) == pytest.approx(1.1122 * 10 - 5.4133)
    assert one(spark, fx.fan_pressure("b"), b=100.0) == pytest.approx(0.7177 * 100 - 43.485)


def test_null_measure_gives_null(spark):
    assert one(spark, fx.temperature("b", "f"), b=None, f=1.0) is None
    assert one(spark, fx.wind_direction("b"), b=None) is None
    assert one(spark, F.lit(1.0) + fx.fan_power("b"), b=None) is None
