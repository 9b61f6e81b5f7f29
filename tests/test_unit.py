"""Checks that need little or no data: grids, names, contracts, configs."""

from __future__ import annotations

import datetime as dt

import pytest

from eventlake.operators.churn import ChurnConfig
from eventlake.schema import FEATURE_COLUMNS, LABEL_COLUMN, SILVER_COLUMNS, SILVER_SCHEMA
from eventlake.sources import bronze
from eventlake.sources.tables import check_mode


def test_hour_file_name_is_unpadded():
    assert bronze.hour_file_name(dt.date(2024, 1, 1), 0) == "2024-01-01-0.json.gz"
    assert bronze.hour_file_name(dt.date(2024, 1, 1), 23) == "2024-01-01-23.json.gz"


@pytest.mark.parametrize("hour", [-1, 24])
def test_hour_out_of_range_rejected(hour):
    with pytest.raises(ValueError):
        bronze.hour_file_name(dt.date(2024, 1, 1), hour)


@pytest.mark.parametrize(
    "year,month,expected", [(2024, 1, 744), (2024, 2, 696), (2023, 2, 672), (2024, 4, 720)]
)
def test_month_grid_sizes(spark, year, month, expected):
    assert bronze.month_grid(spark, year, month).count() == expected


def test_day_grid_has_24_unpadded_names(spark):
    rows = bronze.hour_grid(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 1)).orderBy("hour").collect()
    assert len(rows) == 24
    assert rows[0].file_name == "2024-01-01-0.json.gz"
    assert rows[-1].file_name == "2024-01-01-23.json.gz"
    assert {r.event_date for r in rows} == {dt.date(2024, 1, 1)}


def test_silver_columns_match_schema():
    assert SILVER_COLUMNS == tuple(f.name for f in SILVER_SCHEMA.fields)
    required = {f.name for f in SILVER_SCHEMA.fields if not f.nullable}
    assert required == {"event_id", "event_type", "created_at", "event_date", "event_hour", "_silver_processed_at"}


def test_write_modes():
    assert check_mode("append") == "append"
    assert check_mode("overwrite") == "overwrite"
    with pytest.raises(ValueError):
        check_mode("merge")


def test_feature_names_unique_and_label_separate():
    assert len(set(FEATURE_COLUMNS)) == len(FEATURE_COLUMNS)
    assert LABEL_COLUMN not in FEATURE_COLUMNS


def test_churn_config_defaults():
    cfg = ChurnConfig(split_date=dt.date(2024, 1, 16))
    assert cfg.min_events_in_train == 5
    assert cfg.entity == "repo_id"
    assert (cfg.max_iter, cfg.reg_param, cfg.seed) == (50, 0.0, 42)
