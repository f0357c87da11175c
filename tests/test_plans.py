"""What the planner makes of the queries."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks.tables import CUTOFF, RANGE_END, RANGE_START, Tables
from conftest import SF_SMALL
from wattloom.plans import load_daily
from wattloom.session import work_path
from wattloom.sources import readers, sinks

QUERIES = queries()


@pytest.fixture(autouse=True)
def whole_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")


# Queries that write or fit while they are built; their result is a scan of what they wrote.
EAGER = {n for n in QUERIES if re.match(r"forecast_|hybrid_|cluster_day|batch_score|evaluate_|hyperparameter|stream_|scheduled_", n)}

# One row or a handful from the whole table, or a final sort by time.
ONE_TASK = {"null_report", "head_tail_preview", "append_client", "sort_time"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_single_task(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text
    if name not in ONE_TASK:
        assert "SinglePartition" not in text


# Operators on readings, whose number per site is not bounded.
ON_READINGS = ["ffill", "lag_features", "row_ordinal", "chronological_split", "minmax_scale", "features_load", "energy_series_15m"]


@pytest.mark.parametrize("name", ON_READINGS)
def test_readings_are_never_shuffled_by_site_alone(spark, name):
    lines = plan(QUERIES[name](spark, SF_SMALL)).splitlines()
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\(ClientId#\d+, \d+\)", line):
            depth = len(line) - len(line.lstrip(" :+-"))
            below = []
            for child in lines[i + 1 :]:
                if len(child) - len(child.lstrip(" :+-")) <= depth:
                    break
                below.append(child)
            # an aggregate by site and time span lies between the readings and this shuffle
            assert any(re.search(r"Aggregate\(keys?=\[ClientId#\d+, \w+#\d+", child) for child in below), line


@pytest.mark.parametrize("name", ["sequence_tail", "latest_in_use_run", "row_position_in_day"])
def test_tails_are_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, SF_SMALL)
    text = plan(readers.scan_energy_range(t.energy, 3, RANGE_START, RANGE_END))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(ts,2024-01-10T06:00\).*LessThanOrEqual\(ts,2024-01-20T18:00\)", text)
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>", text)
    text = plan(load_daily.features(t.energy, t.measurements, cutoff=CUTOFF))
    assert "GreaterThan(ts,2024-01-08T00:00)" in text


def test_flagship_shuffles_readings_once(spark):
    t = Tables(spark, SF_SMALL)
    text = plan(load_daily.features(t.energy, t.measurements, cutoff=CUTOFF))
    # readings by site and second, their states by site and bin, weather partials by site and bin, bins by site
    assert text.count("Exchange hashpartitioning") == 4
    assert len(re.findall(r"FileScan parquet .*\bts#", text)) == 2  # readings once, weather once
    assert "COUNT" not in text.split("FileScan")[-1]


@pytest.mark.parametrize("name", ["features_load", "energy_series_15m", "row_ordinal", "ffill", "lag_features", "chronological_split"])
def test_rows_of_one_range_or_second_are_the_most_a_window_sees(spark, name):
    """Every window over readings is split by range or second at least; others run on summaries, bins or blocks."""
    text = plan(QUERIES[name](spark, SF_SMALL))
    if name in ("row_ordinal", "chronological_split"):
        assert "Window" not in text  # places come from counts per range
    if name in ("row_ordinal", "chronological_split", "ffill", "lag_features"):
        assert text.count("FileScan") <= 2 and len(re.findall(r"\bExchange\b", text)) <= 2
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            depth = len(line) - len(line.lstrip(" :+-"))
            below = []
            for child in lines[i + 1 :]:
                if len(child) - len(child.lstrip(" :+-")) <= depth:
                    break
                below.append(child)
            reduced = any("HashAggregate" in c or "SortAggregate" in c for c in below)
            parts = line.split("], [")[-2] if line.count("], [") > 1 else line
            assert reduced or re.search(r"part#|_second#|_block#", parts), line


def test_landed_readings_prune_partitions(spark):
    path = work_path(spark, "landed")
    sinks.land_readings(Tables(spark, SF_SMALL).energy, path, "TimeStampMeasured", files=4)
    landed = spark.read.parquet(path)
    rows = readers.scan_energy_range(landed, 3, RANGE_START, RANGE_END)
    text = plan(rows)
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-10.*day#\d+ <= 2024-01-20", text)
    assert re.search(r"PushedFilters: \[.*EqualTo\(ClientId,3\)", text)
    direct = readers.scan_energy_range(Tables(spark, SF_SMALL).energy, 3, RANGE_START, RANGE_END)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, direct.collect()))
    assert len(rows.inputFiles()) < len(landed.inputFiles()) + 1


def test_bucketed_readings_are_not_shuffled(spark):
    table = f"readings_{uuid.uuid4().hex}"
    energy = Tables(spark, SF_SMALL).energy
    sinks.land_bucketed(energy, table, work_path(spark, table), "TimeStampMeasured", 4)
    try:
        bucketed = spark.table(table)
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
        states = load_daily.bin_states(bucketed, CUTOFF, tie=("event_id",))
        assert "Exchange" not in plan(states)
        plain = load_daily.bin_states(energy, CUTOFF, tie=("event_id",))
        names = ["ClientId", "bin", F.round("total", 6), "open", "final"]
        assert states.count() == plain.count() > 0
        assert states.select(names).exceptAll(plain.select(names)).isEmpty()
    finally:
        spark.sql(f"DROP TABLE {table}")
