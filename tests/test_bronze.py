"""Landing raw dumps into Bronze."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from eventlake.sources import bronze
from fixtures import event, write_hour


def test_read_adds_ingest_columns(spark, hour_files):
    df = bronze.with_ingest_columns(bronze.read_events(spark, hour_files))
    assert {"event_date", "_ingested_at"} <= set(df.columns)
    rows = df.collect()
    assert len(rows) == 10
    assert {r.event_date for r in rows} == {dt.date(2024, 1, 1)}
    # payload keeps the raw nested JSON text
    first = min(rows, key=lambda r: int(r.id))
    assert json.loads(first.payload) == {"size": 0, "ref": "refs/heads/b0"}
    # and the line keeps what the envelope does not name
    assert sum("org" in r.further for r in rows) == 5
    assert all(json.loads(r.further["org"].toJson()) == {"id": i, "login": f"org-{i}"} for i, r in enumerate(sorted(rows, key=lambda r: int(r.id))) if i % 2)


def test_empty_path_list_rejected(spark):
    with pytest.raises(ValueError):
        bronze.read_events(spark, [])
    with pytest.raises(ValueError):
        bronze.land(spark, [], "/unused")


def test_land_day_partitions_by_date(spark, day_files, tmp_path):
    target = str(tmp_path / "bronze")
    res = bronze.land(spark, day_files, target)
    assert res.rows == 15
    assert sorted(d for d in os.listdir(target) if d.startswith("event_date=")) == ["event_date=2024-01-01"]
    assert bronze.read_bronze(spark, target).count() == 15


def test_bad_mode_rejected(spark, hour_files, tmp_path):
    df = bronze.with_ingest_columns(bronze.read_events(spark, hour_files))
    with pytest.raises(ValueError):
        bronze.write_bronze(df, str(tmp_path / "b"), mode="merge")


def test_append_twice_doubles_rows_without_ledger(spark, hour_files, tmp_path):
    target = str(tmp_path / "bronze")
    bronze.land(spark, hour_files, target)
    bronze.land(spark, hour_files, target)
    assert bronze.read_bronze(spark, target).count() == 20


def test_ledger_skips_landed_files(spark, tmp_path):
    raw = tmp_path / "raw"
    first = [str(write_hour(raw, dt.date(2024, 1, 1), h, 5)) for h in range(2)]
    target, ledger = str(tmp_path / "bronze"), str(tmp_path / "ledger")
    assert bronze.land(spark, first, target, ledger).rows == 10
    # rerun: nothing new
    again = bronze.land(spark, first, target, ledger)
    assert again.rows == 0 and again.files == ()
    # a new hour arrives: only it is landed
    second = first + [str(write_hour(raw, dt.date(2024, 1, 1), 2, 5))]
    res = bronze.land(spark, second, target, ledger)
    assert res.rows == 5 and len(res.files) == 1
    assert bronze.read_bronze(spark, target).count() == 15


def test_broken_json_line_goes_to_corrupt_record(spark, tmp_path):
    from eventlake.operators.silver import normalize, rejects

    path = write_hour(tmp_path / "raw", dt.date(2024, 1, 1), 0, 3, extra_lines=['{"id": "9", "type": '])
    df = bronze.read_events(spark, [str(path)])
    bad = df.where(F.col("_corrupt_record").isNotNull()).collect()
    assert len(bad) == 1
    assert df.count() == 4
    raw = bronze.with_ingest_columns(df)
    assert normalize(raw).count() == 3
    assert [r.reason for r in rejects(raw).collect()] == ["corrupt_record"]


def test_fixture_files_are_valid_gzip_jsonl(tmp_path):
    import gzip

    from fixtures import write_days

    files = write_days(tmp_path / "raw", dt.date(2024, 1, 1), days=2, hours=3, per_hour=4)
    ids = []
    for f in files:
        with gzip.open(f, "rt") as fh:
            ids += [json.loads(line)["id"] for line in fh if line.strip()]
    assert len(ids) == 24 and len(set(ids)) == 24
    assert os.path.basename(files[0]) == "2024-01-01-0.json.gz"


def test_new_fields_and_text_ids_survive_landing(spark, tmp_path):
    from eventlake.operators.silver import normalize

    target = str(tmp_path / "bronze")
    bronze.land(spark, [str(write_hour(tmp_path / "raw", dt.date(2024, 1, 1), 0, 8))], target)
    rows = bronze.read_bronze(spark, target)
    assert rows.where("variant_get(further['org'], '$.login', 'string') is not null").count() == 4
    assert rows.where("variant_get(further['actor'], '$.avatar_url', 'string') is not null").count() == 4
    out = normalize(rows)
    assert out.count() == 8
    assert out.where("actor_id is null or repo_id is null or public is null or not public").count() == 0


def test_own_columns_read_with_merge(spark, tmp_path):
    target = str(tmp_path / "bronze")
    df = bronze.with_ingest_columns(bronze.read_events(spark, [str(write_hour(tmp_path / "raw", dt.date(2024, 1, 1), 0, 2))]))
    bronze.write_bronze(df, target)
    bronze.write_bronze(df.selectExpr("*", "7 as extra").withColumn("event_date", df.event_date + 1), target)
    merged = bronze.read_bronze_merged(spark, target)
    assert "extra" in merged.columns and merged.count() == 4


def test_hour_coverage_reports_missing_hours(spark, tmp_path):
    from eventlake.operators.silver import normalize

    files = [str(write_hour(tmp_path / "raw", dt.date(2024, 1, 1), h, 2)) for h in (0, 1, 5)]
    events = normalize(bronze.with_ingest_columns(bronze.read_events(spark, files)))
    grid = bronze.hour_grid(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    cov = bronze.hour_coverage(grid, events)
    missing = sorted(r.hour for r in cov.where("missing").collect())
    assert missing == [h for h in range(24) if h not in (0, 1, 5)]
    ledger = bronze.file_listing(spark, files)
    assert bronze.missing_files(grid, ledger).count() == 21


def test_land_day_and_month(spark, tmp_path):
    from fixtures import write_days

    raw = tmp_path / "raw"
    write_days(raw, dt.date(2024, 1, 30), days=3, hours=2, per_hour=3)  # Jan 30, 31, Feb 1
    ledger = str(tmp_path / "ledger")
    day = bronze.land_day(spark, str(raw), dt.date(2024, 1, 31), str(tmp_path / "b"), ledger)
    assert day.rows == 6 and len(day.files) == 2
    month = bronze.land_month(spark, str(raw), 2024, 1, str(tmp_path / "b"), ledger)
    assert month.rows == 6  # Jan 30 only; Jan 31 already landed, Feb 1 outside
    files, missing = bronze.files_for_range(spark, str(raw), dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert len(files) == 4 and missing == 744 - 4
    nothing = bronze.land_day(spark, str(raw), dt.date(2024, 3, 1), str(tmp_path / "b"), ledger)
    assert nothing.rows == 0


def test_overwrite_relands_everything_and_resets_ledger(spark, tmp_path):
    raw = tmp_path / "raw"
    files = [str(write_hour(raw, dt.date(2024, 1, 1), h, 5)) for h in range(2)]
    target, ledger = str(tmp_path / "bronze"), str(tmp_path / "ledger")
    bronze.land(spark, files, target, ledger)
    res = bronze.land(spark, files, target, ledger, mode="overwrite")
    assert res.rows == 10 and len(res.files) == 2
    assert bronze.read_bronze(spark, target).count() == 10
    assert spark.read.parquet(ledger).count() == 2
    assert bronze.land(spark, files, target, ledger).rows == 0  # append after overwrite: still skipped


def test_members_beyond_the_envelope(spark):
    """What the envelope has no column for is kept with its type, whatever else is wrong with the line."""
    same = '"type":"T","created_at":"2024-01-01T00:00:00Z"'
    lines = [
        '{"id":"1",%s,"actor":{"id":1,"avatar_url":"u"},"org":{"id":3},"n":1}' % same,
        '{"id":"2",%s,"n":2.5,"flag":null}' % same,
        '{"id":"3",%s,"n":1,"n":2}' % same,  # a member twice
        '{"id":"4",%s,"payload":{"a":1,"a":2}}' % same,
        '{"id":"5",%s}' % same,
        "{broken",
        '{"id":"6",%s,"actor":"odd shape","org":5}' % same,
        '{"id":"7",%s,"actor":null,"actor.x":1,"":2}' % same,
    ]
    rows = {r.id: r for r in bronze.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    seen = {i: None if r.further is None else {k: json.loads(v.toJson()) for k, v in r.further.items()} for i, r in rows.items()}
    assert seen["1"] == {"org": {"id": 3}, "n": 1, "actor": {"avatar_url": "u"}}
    assert seen["2"] == {"n": 2.5, "flag": None}
    assert seen["3"] == {bronze.WHOLE_LINE: lines[2]} and seen["4"] == {bronze.WHOLE_LINE: lines[3]}
    assert seen["5"] == {} and seen[None] is None and rows[None]._corrupt_record == "{broken"
    assert seen["6"] is None and rows["6"]._corrupt_record == lines[6]
    assert seen["7"] == {"actor.x": 1, "": 2}


def test_new_members_and_typed_columns(spark, day_files, tmp_path):
    bronze.land(spark, day_files, str(tmp_path / "bronze"))
    b = bronze.read_bronze(spark, str(tmp_path / "bronze"))
    found = {r.member: (r.value_type, r.first_day, r.n_rows) for r in bronze.new_members(b).collect()}
    assert found == {"org": ("OBJECT<id: BIGINT, login: STRING>", dt.date(2024, 1, 1), 6), "actor": ("OBJECT<avatar_url: STRING>", dt.date(2024, 1, 1), 6)}
    typed = bronze.with_members(b, {"org_id": ("org", "$.id", "int"), "wrong": ("org", "$.login", "int")})
    assert sorted(r.org_id for r in typed.collect() if r.org_id is not None) == [1, 1, 1, 3, 3, 3]
    assert typed.where("wrong is not null").isEmpty()
    assert bronze.new_members(b.where("false")).collect() == []
