"""A quick slice of the driver's correctness gate: registered queries vs their
DuckDB twins on the smallest tables (the full run is tests/oracle_check.py)."""

import pytest

from tests.oracle_check import compare

FAST = ["a01_sensor_stats", "w04_grid_exact", "w05_ffill", "w06_interpolate", "w09_history_fill",
        "p07_calendar", "o04_ordered_split", "g05_row_normalize", "j06_mapping", "j09_idw_weights",
        "p03_zscore_unguarded", "o06_batches", "p22_input_jitter", "c09_bias_applied", "t05_stream_forecast", "s02_read_dir",
        "t03_latest_state", "w15_ema_state", "j02_lookup", "s07_matrix_readings", "j14_split_candidates"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_duckdb(spark, name):
    res = compare(spark, "/root/testdata/sf0.01", {name}, verbose=False)
    assert res[name].startswith("OK"), res[name]
