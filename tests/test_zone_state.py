"""The zone job in one JSON pass, and its stream with state."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ridgeline.operators.clean import clean
from ridgeline.session import scratch_path
from ridgeline.sources import io as IO
from ridgeline.sources import zone as Z
from ridgeline.streaming.zone_state import add_batch, merged_counts, read_cleaned, start_zone_stream, zone_summary
from ridgeline.streaming.zone_stream import landed_counts, start_clean_stream

SCHEMA = "stars double, useful bigint, text string, `odd name` string"


def land(path, rows, broken=0):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-{len(os.listdir(path))}.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
        f.writelines('{"stars": \n' for _ in range(broken))


def rows(n, text=True, useful=0):
    return [{"stars": float(1 + i % 6), "useful": i - useful, "odd name": "x"} | ({"text": f"t{i}"} if text else {}) for i in range(n)]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_staging_counts_what_a_plain_pass_counts(spark, tmp_path):
    land(str(tmp_path / "a"), rows(50) + rows(30, text=False), broken=4)
    lines = IO.read_json_lines(spark, str(tmp_path / "a"), spark.createDataFrame([], SCHEMA).schema)
    counts = Z.stage_lines(lines, str(tmp_path / "staged"))
    assert counts == Z.Counts(84, 4, {"stars": 0, "useful": 0, "text": 30, "odd name": 0})
    staged = spark.read.parquet(str(tmp_path / "staged"))
    assert staged.count() == 80
    # from here on no JSON is needed
    for f in os.listdir(tmp_path / "a"):
        os.truncate(tmp_path / "a" / f, 0)
    n, columns = Z.rewrite_staged(staged, counts, str(tmp_path / "out"))
    assert (n, columns) == (67, 3)  # text is sparse; 13 rows have 6 stars
    want = clean(staged, "validated")
    assert sorted_rows(spark.read.parquet(str(tmp_path / "out"))) == sorted_rows(want)


def test_rewrite_reads_only_the_columns_that_stay(spark, tmp_path):
    land(str(tmp_path / "a"), rows(50) + rows(30, text=False))
    counts = Z.stage_lines(IO.read_json_lines(spark, str(tmp_path / "a")), str(tmp_path / "staged"))
    out = clean(spark.read.parquet(str(tmp_path / "staged")), "validated", null_row=counts.null_row)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("ReadSchema")[1] and "GreaterThanOrEqual(stars" in plan


def test_clean_table(spark, tmp_path):
    land(str(tmp_path / "land" / "t.json"), rows(60, useful=5) + rows(2, text=False), broken=2)
    got = Z.clean_table(spark, str(tmp_path / "land"), str(tmp_path / "clean"), "t", partitions=3, eda_path=str(tmp_path / "eda"))
    assert got[:3] == ("t", 64, 2) and got[4:] == (4, 4)
    assert got[3] == sum(1 for r in rows(60, useful=5) if r["stars"] <= 5 and r["useful"] >= 0)
    assert IO.input_bytes(spark, Z.cleaned_path(str(tmp_path / "clean"), "t")).first().input_files == 3
    nulls = spark.read.json(str(tmp_path / "eda" / "t")).where("metric = 'nulls' AND column = 'text'").first().value
    assert nulls == 2


def test_empty_and_all_broken_landings(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    land(str(tmp_path / "land" / "e.json"), [])
    land(str(tmp_path / "land" / "b.json"), [], broken=3)
    got = Z.clean_zone(spark, str(tmp_path / "land"), str(tmp_path / "clean"), ["e", "b"], schemas={"e": schema, "b": schema}).collect()
    assert [tuple(r) for r in got] == [("e", 0, 0, 0, 4, 4), ("b", 3, 3, 0, 4, 4)]


@pytest.mark.parametrize("files", [None, 1])
def test_landings_in_a_row_equal_one_batch(spark, tmp_path, files):
    schema = spark.createDataFrame([], SCHEMA).schema
    landing, cleaned, state = str(tmp_path / "land"), str(tmp_path / "clean"), str(tmp_path / "state")
    batches = [(rows(40), 1), (rows(30, text=False), 2), (rows(300), 0), (rows(400), 3)]  # text is kept, then sparse, then kept
    seen, landed = [], []
    for part, broken in batches:
        landed.append((part, broken))
        land(landing, part, broken)
        start_zone_stream(spark, landing, cleaned, state, schema, max_files_per_trigger=files).awaitTermination()
        lines = IO.read_json_lines(spark, landing, schema)
        whole = Z.good_lines(lines)
        want = clean(whole, "validated")
        got = read_cleaned(spark, cleaned, state, schema)
        assert got.columns == want.columns
        assert sorted_rows(got) == sorted_rows(want)
        seen.append(tuple(got.columns))
        total = merged_counts(spark, state)
        assert (total.rows, total.malformed) == (sum(len(p) + n for p, n in landed), sum(n for _, n in landed))
    assert len(set(seen)) == 2  # the decision changed on the way
    summary = zone_summary(spark, "t", cleaned, state, schema).first()
    assert tuple(summary) == ("t", 776, 6, want.count(), 4, 4)
    # nothing new: nothing changes
    start_zone_stream(spark, landing, cleaned, state, schema).awaitTermination()
    assert zone_summary(spark, "t", cleaned, state, schema).first() == summary


def test_a_batch_tried_again_changes_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    cleaned, state = str(tmp_path / "clean"), str(tmp_path / "state")
    frames = []
    for k, part in enumerate((rows(20), rows(30, text=False))):
        land(str(tmp_path / f"l{k}"), part, broken=1)
        frames.append(IO.read_json_lines(spark, str(tmp_path / f"l{k}"), schema))
    add_batch(frames[0], 0, cleaned, state)
    add_batch(frames[1], 1, cleaned, state)
    once = sorted_rows(read_cleaned(spark, cleaned, state, schema))
    add_batch(frames[1], 1, cleaned, state)
    assert sorted_rows(read_cleaned(spark, cleaned, state, schema)) == once
    assert merged_counts(spark, state).malformed == 2
    assert read_cleaned(spark, cleaned, str(tmp_path / "none"), schema).count() == 0


def test_plain_stream_counts_malformed_lines(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    land(str(tmp_path / "land"), rows(10), broken=3)
    query = start_clean_stream(spark, str(tmp_path / "land"), str(tmp_path / "out"), scratch_path(spark, "ck"), schema)
    query.awaitTermination()
    assert landed_counts(query) == (13, 3)
