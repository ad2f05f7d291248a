from support import SF_SMALL
from ridgeline.operators.clean import clean
from ridgeline.session import scratch_path
from ridgeline.sources import fixtures as fx
from ridgeline.sources import io as IO
from ridgeline.streaming.zone_stream import clean_rows, start_clean_stream


def test_stream_equals_batch(spark):
    dirty = fx.review_dirty(spark, SF_SMALL)
    landing = scratch_path(spark, "sl")
    IO.write_json(dirty, landing)
    out, ckpt = scratch_path(spark, "so"), scratch_path(spark, "sc")
    q = start_clean_stream(spark, landing, out, ckpt, dirty.schema, drop=["text", "date"])
    q.awaitTermination()
    got = sorted(tuple(r) for r in IO.read_table(spark, out).select(*[c for c in dirty.columns if c not in ("text", "date")]).collect())
    want = sorted(tuple(r) for r in clean(dirty, "validated").collect())
    assert got == want and len(got) == 875
    # a second run on the same checkpoint finds nothing new
    q2 = start_clean_stream(spark, landing, out, ckpt, dirty.schema, drop=["text", "date"])
    q2.awaitTermination()
    assert IO.read_table(spark, out).count() == 875


def test_clean_rows_batch(spark):
    df = spark.createDataFrame([(1.0, "a"), (7.0, "b"), (None, "c")], "stars double, `a b` string")
    assert [tuple(r) for r in clean_rows(df).collect()] == [(1.0, "a")]


def test_stream_picks_up_new_files_once(spark):
    from pyspark.sql import functions as F
    dirty = fx.review_dirty(spark, SF_SMALL)
    landing = scratch_path(spark, "sl2")
    first = dirty.filter(F.col("review_id") < 500)
    second = dirty.filter(F.col("review_id") >= 500)
    IO.write_json(first, f"{landing}/batch1")
    out, ckpt = scratch_path(spark, "so2"), scratch_path(spark, "sc2")
    schema = dirty.schema
    # the stream reads every file under the landing folder (batch sub-folders included)
    start_clean_stream(spark, f"{landing}/*", out, ckpt, schema, drop=["text", "date"]).awaitTermination()
    n1 = IO.read_table(spark, out).count()
    IO.write_json(second, f"{landing}/batch2")
    start_clean_stream(spark, f"{landing}/*", out, ckpt, schema, drop=["text", "date"]).awaitTermination()
    n2 = IO.read_table(spark, out).count()
    assert n1 == clean(first, "validated").count()
    assert n2 == 875  # both batches, each row once
