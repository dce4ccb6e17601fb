"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.operators import ports as port_ops
from tidemark.operators import spatial
from tidemark.plans import flows, given
from tidemark.session import scratch_path

QUERIES = contract.queries()
LAZY = ("pings_in_ports", "pings_in_zones", "od_matrix", "sessionize", "cell_colors", "cell_hour_res9", "dq_report", "pending_urls", "landing_full")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", LAZY)
def test_no_all_pairs_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_flagship_reads_the_pings_once(spark, sf_dir):
    text = final_plan(QUERIES["od_matrix"](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet \[event_id", text)) == 1
    assert "ReusedExchange" in text


def test_no_window_over_all_pings_of_a_vessel(spark, sf_dir):
    """Windows over raw pings are keyed by vessel and time slice."""
    text = plan(QUERIES["sessionize"](spark, sf_dir))
    specs = re.findall(r"windowspecdefinition\((_vessel#\d+L, _slice#\d+L(?: ASC)?)", text)
    assert specs and "windowspecdefinition(mmsi" not in text


def test_colours_compute_the_cells_once(spark, sf_dir):
    text = final_plan(QUERIES["cell_colors"](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet \[", text)) <= 3


def test_distinct_count_spreads_a_crowded_cell(spark, sf_dir):
    text = plan(QUERIES["cell_hour_res9"](spark, sf_dir))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert any("mmsi" in e for e in exchanges)


def test_bounds_reach_the_scan_and_columns_are_pruned(spark, sf_dir):
    path = scratch_path(spark, "pings")
    given.pings(spark, sf_dir).withColumn("note", F.lit("unused")).write.parquet(path)
    stored = spark.read.parquet(path)
    stays = flows.stays(stored, given.ports(spark, sf_dir))
    text = spark._jvm.PythonSQLUtils.explainString(stays._jdf.queryExecution(), "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(longitude,.*LessThanOrEqual\(latitude,", text)
    assert "note" not in re.search(r"ReadSchema: struct<mmsi[^>]*>", text).group(0)


def test_projection_is_not_repeated_in_filters(spark, sf_dir):
    ports = port_ops.without_size(given.ports(spark, sf_dir))
    text = plan(flows.in_port_pings(given.pings(spark, sf_dir), ports))
    assert not [line for line in text.split("\n") if "Filter" in line and "ATANH" in line]


def test_queries_do_not_need_utc_beforehand(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    first = QUERIES["time_range"](spark, sf_dir).first()
    assert first["min_time"].year == 2024
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


@pytest.mark.parametrize("name", ["sessionize", "prev_port", "session_flags"])
def test_sessions_compute_the_pings_once(spark, sf_dir, name):
    """Events are read by the job that stores the in-port pings; all that follows starts from those."""
    text = spark._jvm.PythonSQLUtils.explainString(QUERIES[name](spark, sf_dir)._jdf.queryExecution(), "formatted")
    places = re.findall(r"Location: \w+ \[([^\]]*)\]", text)
    assert len(places) == 2 and all("in-port-pings" in place for place in places) and "events.parquet" not in text
    summarised = min(re.findall(r"ReadSchema: struct<([^>]*)>", text), key=len)
    assert summarised.count(":") == 4


@pytest.mark.parametrize(("name", "most"), [("od_matrix", 5), ("journeys", 4), ("port_stays", 3)])
def test_voyages_shuffle_little(spark, sf_dir, name, most):
    text = final_plan(QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"(?m)^[ :+-]*Exchange hashpartitioning", text)) <= most


def test_no_window_over_all_stays_of_a_vessel(spark, sf_dir):
    """Stays are windowed by vessel and block, and their first and last ones by vessel; nothing by the vessel alone."""
    text = plan(QUERIES["journeys"](spark, sf_dir))
    keys = set(re.findall(r"windowspecdefinition\((mmsi#\d+L, _\w+?)#", text))
    assert {k.split(", ")[1] for k in keys} == {"_slot", "_edge"}
    assert not re.search(r"windowspecdefinition\(mmsi#\d+L, (?!_slot|_edge)", text)


def test_bounds_of_both_hemispheres_reach_the_scan(spark, sf_dir):
    path = scratch_path(spark, "pings")
    given.pings(spark, sf_dir).write.parquet(path)
    rows = [(1, "east", 179.99, 10.0), (2, "west", -179.99, 10.0), (3, "far east", 150.0, 11.0)]
    ports = spark.createDataFrame(rows, "port_id bigint, port_name string, plon double, plat double")
    found = spatial.pings_in_ports(spark.read.parquet(path), ports, zone=None)
    text = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert re.search(r"Or\(And\(GreaterThanOrEqual\(longitude,-180.0\),LessThanOrEqual\(longitude,-179.9", pushed)
