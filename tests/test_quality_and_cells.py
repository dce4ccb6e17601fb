from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cells, quality

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "mmsi bigint, ts timestamp_ntz, longitude double, latitude double"


def pings(spark, rows):
    return spark.createDataFrame([(m, T0 + dt.timedelta(hours=h), x, y) for m, h, x, y in rows], SCHEMA)


ROWS = [
    (1, 0, -123.4, 48.6),
    (1, 0, -123.4, 48.6),
    (1, 24, -123.4, 48.6),
    (2, 0, -123.4, 48.6),
    (2, 5, -123.4, 48.6),
    (3, 5, -122.1, 47.1),
    (4, 5, None, 47.1),
    (5, 5, -123.4, 95.0),
]


def test_null_profile_lists_only_columns_with_nulls(spark):
    got = {r["column_name"]: (r["null_count"], r["null_percent"]) for r in quality.null_profile(pings(spark, ROWS)).collect()}
    assert got == {"longitude": (1, 12.5)}


def test_validity_keeps_three_groups(spark):
    got = {r["is_valid_geom"]: r["count"] for r in quality.validity_summary(pings(spark, ROWS)).collect()}
    assert got == {True: 6, False: 1, None: 1}


def test_bounds_center_is_the_middle_of_the_box(spark):
    row = quality.bounds_center(pings(spark, ROWS[:6])).first()
    assert (row["center_lat"], row["center_lon"]) == pytest.approx((47.85, -122.75))


def test_report_agrees_with_single_checks(spark):
    report = {r["check"]: r["value"] for r in quality.quality_report(pings(spark, ROWS)).collect()}
    assert report["total_rows"] == 8 and report["unique_vessels"] == 5
    assert (report["valid_geom"], report["invalid_geom"], report["missing_geom"]) == (6, 1, 1)
    assert report["nulls_longitude"] == 1 and report["nulls_mmsi"] == 0


def test_approximate_count_is_close(spark):
    df = spark.range(20_000).select(F.col("id").alias("mmsi"))
    assert quality.unique_count(df, "mmsi", "n").first()["n"] == 20_000
    assert quality.unique_count(df, "mmsi", "n", 0.02).first()["n"] == pytest.approx(20_000, rel=0.1)


def test_hour_of_day_merges_dates_and_null_cell_is_kept(spark):
    got = cells.cell_hour(pings(spark, ROWS), 6).collect()
    by_hour = {(r["hex_res6"] is None, r["hour_of_day"]): (r["unique_vessels"], r["total_records"]) for r in got if r["hour_of_day"] == 0}
    assert by_hour == {(False, 0): (2, 4)}
    assert [(r["unique_vessels"], r["total_records"]) for r in got if r["hex_res6"] is None] == [(2, 2)]


def test_sum_of_hourly_distincts_differs_from_daily_distinct(spark):
    one_cell = pings(spark, ROWS[:5])
    summed = cells.cell_daily_sum(cells.cell_hour(one_cell, 6), "hex_res6").first()
    unique = cells.cell_daily_unique(one_cell, 6).first()
    assert (summed["total_unique_vessels"], summed["total_records"]) == (3, 5)
    assert (unique["daily_unique"], unique["total_records"]) == (2, 5)


def test_records_of_cells_add_up_to_pings(spark):
    for res in (6, 9):
        total = cells.cell_hour(pings(spark, ROWS), res).agg(F.sum("total_records")).first()[0]
        assert total == len(ROWS)


def test_all_resolutions_equal_single_ones(spark):
    everything = cells.cell_hour_all(pings(spark, ROWS)).collect()
    for res in (6, 7, 8, 9):
        single = {tuple(r) for r in cells.cell_hour(pings(spark, ROWS), res).collect()}
        assert {tuple(r)[1:] for r in everything if r["resolution"] == res} == single


def test_cell_stats(spark):
    row = cells.cell_stats(cells.cell_hour(pings(spark, ROWS), 6), "hex_res6").first()
    assert tuple(row) == (4, 2, 2)


@pytest.mark.parametrize("values", [[1, 2, 3, 4, 10], [7], [5, 5, 5, 6]])
def test_description_equals_pandas(spark, values):
    got = cells.describe_values(spark.createDataFrame([(v,) for v in values], "v bigint"), "v").first()
    want = pd.Series(values).describe()
    for name, label in (("count", "count"), ("mean", "mean"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert got[name] == pytest.approx(want[label])
    assert got["std"] is None if len(values) == 1 else got["std"] == pytest.approx(want["std"])


def test_equal_cells_are_all_yellow(spark):
    daily = spark.createDataFrame([(432345564227567616 + i, 5, 9) for i in range(3)], "cell bigint, total_unique_vessels bigint, total_records bigint")
    rows = cells.cell_colors(daily, "cell").collect()
    assert [r["rgba"] for r in rows] == [[255, 255, 0, 255]] * 3
    assert {(r["all_vessels"], r["all_records"]) for r in rows} == {(15, 27)}


def test_center_is_the_mean_of_distinct_cells(spark):
    hourly = cells.cell_hour(pings(spark, ROWS[:6]), 9)
    row = cells.cells_center(hourly, "hex_res9").first()
    assert (row["center_lat"], row["center_lon"]) == pytest.approx((47.85, -122.75), abs=0.01)


@pytest.mark.parametrize("seed", range(3))
def test_quartiles_of_many_ranges_equal_pandas(spark, seed):
    """Ties, even and odd counts, NULLs, negative and large values, over many ranges."""
    import random

    rng = random.Random(seed)
    values = [rng.choice([rng.randint(-50, 50), rng.randint(0, 3), 10**15 + rng.randint(0, 9)]) for _ in range(rng.randint(200, 999))]
    got = cells.describe_values(spark.createDataFrame([(v,) for v in [*values, None]], "v bigint").repartition(7), "v").first()
    want = pd.Series(values).describe()
    assert got["count"] == len(values) and got["min"] == min(values) and got["max"] == max(values)
    for name, label in (("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
        assert got[name] == pytest.approx(want[label], rel=1e-12), name


def test_description_of_nothing(spark):
    got = cells.describe_values(spark.createDataFrame([(None,)], "v bigint"), "v").first()
    assert got["count"] == 0 and got["mean"] is got["p50"] is got["max"] is None
