import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowmart.functions import bands
from flowmart.functions import events as ev
from flowmart.functions.numbers import mean, merged_sum, numeric2, partial_mean, partial_sum, round2

NAN = float("nan")
LABELS = {
    bands.status: {
        None: "MODERATE CONGESTION", NAN: "CRITICAL CONGESTION", 80.0: "HIGH CONGESTION",
        80.01: "CRITICAL CONGESTION", 50.0: "MODERATE CONGESTION", 50.01: "HIGH CONGESTION", 0.0: "MODERATE CONGESTION",
    },
    bands.traffic_level: {
        None: "CRITIQUE", NAN: "CRITIQUE", 19.99: "FAIBLE", 20.0: "MODERÉ", 49.99: "MODERÉ", 50.0: "ÉLEVÉ",
        79.99: "ÉLEVÉ", 80.0: "CRITIQUE",
    },
    bands.speed_category: {
        None: "TRÈS_LENTE", NAN: "RAPIDE", 80.0: "NORMALE", 80.01: "RAPIDE", 50.0: "LENTE", 50.01: "NORMALE",
        30.0: "TRÈS_LENTE", 30.01: "LENTE",
    },
    bands.congestion_priority: {
        None: "FAIBLE", NAN: "URGENTE", 80.0: "HAUTE", 80.01: "URGENTE", 50.0: "MODERÉE", 50.01: "HAUTE",
        30.0: "FAIBLE", 30.01: "MODERÉE",
    },
    bands.alert_status: {None: "NORMAL", NAN: "ALERTE", 50.0: "NORMAL", 50.01: "ALERTE"},
    bands.occupancy_band: {29.99: "green", 30.0: "yellow", 60.0: "orange", 80.0: "red", None: "green"},
    bands.speed_band: {29.99: "red", 30.0: "yellow", 50.0: "green", None: "red"},
    bands.alert_count_band: {0.0: "green", 1.0: "yellow", 2.0: "orange", 3.0: "red", 9.0: "red"},
    bands.flow_regime: {69.9: "free", 70.0: "dense", 89.9: "dense", 90.0: "critical", None: "free"},
}


@pytest.mark.parametrize("function", LABELS, ids=lambda function: function.__name__)
def test_labels_at_their_limits(spark, function):
    expected = LABELS[function]
    frame = spark.createDataFrame([(value,) for value in expected], "v double")
    got = [row.label for row in frame.select("v", function(F.col("v")).alias("label")).collect()]
    assert got == list(expected.values())


def test_level_colours_and_limits_of_road_types(spark):
    frame = spark.createDataFrame([("CRITIQUE",), ("ÉLEVÉ",), ("MODERÉ",), ("FAIBLE",), ("?",), (None,)], "l string")
    colours = [row[0] for row in frame.select(bands.level_colour(F.col("l"))).collect()]
    assert colours == ["red", "orange", "yellow", "green", None, None]
    types = spark.createDataFrame([("Autoroute",), ("Avenue",), ("Rue",), ("Piste",)], "t string")
    limits = types.select(bands.capacity(F.col("t")), bands.top_speed(F.col("t"))).collect()
    assert [tuple(row) for row in limits] == [(100, 140), (50, 60), (20, 30), (None, None)]


def test_time_bands_include_both_ends(spark):
    hours = spark.range(24).select(F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.col("id").cast("int"), F.lit(59), F.lit(59.9)).alias("t"))
    got = [row[0] for row in hours.select(bands.time_band(F.col("t"))).collect()]
    want = ["peak" if h in (7, 8, 9, 17, 18, 19) else "medium" if 10 <= h <= 16 else "calm" for h in range(24)]
    assert got == want


def test_rounding_is_half_up_on_the_decimal_text(spark):
    frame = spark.createDataFrame([(1.005,), (80.004,), (80.005,), (-1.005,), (NAN,), (float("inf"),), (None,)], "v double")
    for function in (round2, numeric2):
        got = [row[0] for row in frame.select(function(F.col("v"))).collect()]
        assert got[:4] == [1.01, 80.0, 80.01, -1.01]
        assert math.isnan(got[4]) and got[5] == float("inf") and got[6] is None


def test_event_times_and_directories(spark):
    texts = {
        "2024-01-31T23:59:59.999999": "2024-01-31",
        "2024-01-31 23:59:59": "2024-01-31",
        "2024-01-31": "2024-01-31",
        "2024-02-30T00:00:00": None,
        "2024": None,
        "12:30:00": None,
        "soon": None,
        None: None,
    }
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    days = [row[0] for row in frame.select(ev.event_day(ev.local_time(F.col("t")))).collect()]
    assert days == list(texts.values())
    assert frame.select(ev.zone_directory(F.lit("Centre Ville Nord"))).first()[0] == "Centre_Ville_Nord"


@pytest.mark.parametrize(
    "values",
    [
        [0.1, 0.2, 0.3],
        [None, None],
        [1 / 3, 0.25, 2e9],
        [NAN, 1.0],
        [float("inf"), 1.0],
        [float("inf"), float("-inf")],
        [49.9, 50.05],
        [-3.5, 3.5, None],
    ],
    ids=str,
)
def test_merged_partials_give_the_mean_of_all_values(spark, values):
    frame = spark.createDataFrame([(position % 2, value) for position, value in enumerate(values)], "day int, m double")
    merged = frame.groupBy("day").agg(*partial_sum("m")).agg(*merged_sum("m")).select(partial_mean("m")).first()[0]
    whole, direct = frame.agg(F.avg("m"), mean("m")).first()
    assert repr(direct) == repr(merged)
    if whole is None:
        assert merged is None
    elif math.isnan(whole):
        assert math.isnan(merged)
    else:
        # Ten decimals of each value count.
        assert merged == pytest.approx(whole, rel=1e-12, abs=1e-10)


def test_a_mean_between_two_roundings_is_rounded_alike_in_any_order(spark):
    """Adding doubles can miss such a mean on either side, in the last bits."""
    for values, expected in (
        ([49.9, 50.05, 49.95, 50.0] * 25, 49.98),
        ([1875.12, 3302.47, 2810.9, 1402.33, 3999.99, 2210.45, 3502.71, 1743.63], 2605.95),
    ):
        frame = spark.createDataFrame(list(enumerate(values)), "n int, m double")
        for parts in (1, 3, 7):
            for order in ("n", "m", "m DESC"):
                ordered = frame.orderBy(F.expr(order) if " " not in order else F.desc("m")).coalesce(1)
                assert ordered.agg(numeric2(mean("m"))).first()[0] == expected
            assert frame.repartition(parts).agg(numeric2(mean("m"))).first()[0] == expected
            partials = frame.groupBy((F.col("n") % parts).alias("day")).agg(*partial_sum("m"))
            assert partials.agg(*merged_sum("m")).select(numeric2(partial_mean("m"))).first()[0] == expected
