"""The same events give the same means, however they are read, split, repeated or merged."""

import tempfile

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowmart.functions.numbers import mean, merged_sum, partial_mean, partial_sum
from flowmart.operators import aggregates as agg
from tests.conftest import rows

QUICK = (Phase.explicit, Phase.generate)  # a smaller example is not worth minutes of Spark jobs
EVENT = "zone string, road_id string, road_type string, vehicle_count bigint, average_speed double, occupancy_rate double, date string"
big = st.floats(-1e15, 1e15) | st.integers(10**8, 10**12).map(lambda n: n / 100) | st.integers(10**9, 10**12).map(lambda n: n / 1000 + 0.005)
numbers = st.none() | st.floats(-200, 2000) | st.floats(0, 100).map(lambda x: round(x, 2)) | st.just(float("nan")) | big
events = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.sampled_from(["r1", "r2", None]),
        st.sampled_from(["Rue", None]),
        st.none() | st.integers(0, 5000) | st.integers(-(2**62), 2**62),
        numbers,
        numbers,
        st.sampled_from(["2024-01-01", "2024-01-02", "2024-03-01", "undated"]),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=12, deadline=None, phases=QUICK, suppress_health_check=list(HealthCheck))
@given(first=events, late=events)
def test_partials_merged_after_late_events_equal_one_sweep(spark, first, late):
    arrived, added = spark.createDataFrame(first, EVENT), spark.createDataFrame(late, EVENT)
    whole = arrived.union(added)
    path = f"{tempfile.mkdtemp(prefix='flowmart-law-')}/partials"
    agg.store_partials(agg.daily_sweep(arrived), path)
    agg.refresh_partials(whole, added, path)
    sweep = agg.sweep(whole.repartition(3))
    merged = agg.merge_partials(spark.read.parquet(path)).select(*sweep.columns)
    assert list(map(repr, rows(merged))) == list(map(repr, rows(sweep)))


@settings(max_examples=8, deadline=None, phases=QUICK, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(st.sampled_from(["a", None]), st.integers(0, 1000000)), min_size=1, max_size=60), parts=st.integers(1, 9))
def test_means_do_not_depend_on_the_partitioning(spark, data, parts):
    frame = spark.createDataFrame(data, "zone string, n bigint").select(
        "zone", (F.col("n") / 10000).alias("occupancy_rate"), F.col("n").alias("vehicle_count")
    )
    assert rows(agg.zone_means(frame.repartition(parts))) == rows(agg.zone_means(frame.coalesce(1)))


@settings(max_examples=15, deadline=None, phases=QUICK, suppress_health_check=list(HealthCheck))
@given(data=st.lists(numbers, min_size=1, max_size=80), seed=st.randoms(use_true_random=False), parts=st.integers(2, 7))
def test_means_are_the_same_bits_in_any_order_and_split(spark, data, seed, parts):
    """Unrounded: shuffled rows, any partial sums, merged in two steps."""
    shuffled = list(data)
    seed.shuffle(shuffled)
    whole, other = (spark.createDataFrame([(x, k) for k, x in enumerate(given)], "m double, k long") for given in (data, shuffled))
    want = whole.coalesce(1).agg(mean("m")).first()[0]
    days = other.repartition(parts).groupBy((F.col("k") % parts).alias("day")).agg(*partial_sum("m"))
    months = days.groupBy((F.col("day") % 2).alias("month")).agg(*merged_sum("m"))
    merged = months.agg(*merged_sum("m")).select(partial_mean("m")).first()[0]
    assert repr(other.repartition(parts).agg(mean("m")).first()[0]) == repr(want) == repr(merged)


def test_the_mean_of_decimals_is_exact(spark):
    """Ten decimals of every value count, so a tie of the second decimal is a tie: in 10^5 rows, and with large values."""
    for low in (0.12, 1234567.12, 8_000_000_000.25, -50.13):
        frame = spark.range(100_000).select((F.lit(low) + F.when(F.col("id") % 2 == 0, 0.01).otherwise(0)).alias("m"))
        value = frame.agg(mean("m").alias("m")).first()[0]
        assert value == round(low + 0.005, 3)
    halves = spark.createDataFrame([(2**62,), (2**62 + 2,), (-(2**61),)], "m bigint").agg(mean("m")).first()[0]
    assert halves == (2**63 + 2 - 2**61) / 3
