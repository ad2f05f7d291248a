from support import SF_MID
from ridgeline.session import scratch_path, shared_dir
from ridgeline.sources import fixtures as fx
from ridgeline.sources import io as IO
from ridgeline.sources import zone as Z


def test_shared_dir_is_stable(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_json_malformed_and_nested(spark, tmp_path):
    p = tmp_path / "in.json"
    p.write_text('{"a": 1, "o": {"k": 2}, "arr": [1, 2]}\n{"a": 2, "o": null, "arr": []}\n{broken\n')
    lines = IO.read_json_lines(spark, str(p))
    assert lines.columns[-1] == IO.CORRUPT and [r.a for r in lines.where("a IS NOT NULL").sort("a").collect()] == [1, 2]
    assert lines.where(f"{IO.CORRUPT} IS NOT NULL AND a IS NULL").count() == 1
    good = Z.good_lines(lines)
    assert len(good.collect()) == 2 and dict(good.dtypes)["o"].startswith("struct")
    assert IO.read_json(spark, str(p), mode="DROPMALFORMED").count() == 2
    clean_file = tmp_path / "good.json"
    clean_file.write_text('{"a": 1}\n')
    assert IO.read_json_lines(spark, str(clean_file)).columns == ["a", IO.CORRUPT]


def test_parquet_roundtrip_and_schema(spark):
    df = fx.business(spark, SF_MID)
    path = scratch_path(spark, "t")
    IO.write_parquet(df, path)
    back = IO.read_table(spark, path)
    assert back.count() == 100 and back.columns == df.columns
    IO.write_parquet(df.limit(3), path)  # overwrite
    assert IO.read_table(spark, path).count() == 3
    st = IO.schema_table(df).collect()
    assert [(r.pos, r.column, r.type) for r in st][:2] == [(0, "business_id", "bigint"), (1, "name", "string")]


def test_input_bytes(spark):
    r = IO.input_bytes(spark, f"{SF_MID}/events.parquet").first()
    assert r.input_files == 1 and r.input_bytes == 220511


def test_clean_zone(spark):
    landing = scratch_path(spark, "landing")
    IO.write_json(fx.review_dirty(spark, SF_MID), Z.landing_path(landing, "review"))
    IO.write_json(fx.users(spark, SF_MID), Z.landing_path(landing, "user"))
    eda = scratch_path(spark, "eda")
    out = {r.table: r for r in Z.clean_zone(spark, landing, scratch_path(spark, "cleaned"), ["review", "user"],
                                            eda_path=eda).collect()}
    prof = spark.read.json(f"{eda}/review")
    nulls = {r.column: r.value for r in prof.filter("metric = 'nulls'").collect()}
    assert nulls["text"] == 2500 and nulls["date"] == 1000
    assert (out["review"].rows_in, out["review"].rows_out, out["review"].cols_out) == (10000, 8773, 7)
    assert (out["user"].rows_in, out["user"].rows_out) == (1500, 1500)


def test_preview(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert [r.k for r in IO.preview(df, 2, "k").collect()] == [1, 2]


def test_write_metadata_document(spark):
    from ridgeline.plans.metadata import write_metadata
    path = scratch_path(spark, "meta")
    write_metadata({"business": fx.business(spark, SF_MID), "users": fx.users(spark, SF_MID)}, path)
    m = spark.read.json(f"{path}/metrics")
    s = spark.read.json(f"{path}/schema")
    assert s.count() == 14
    got = {(r.table, r.column, r.metric) for r in m.collect()}
    assert ("business", "stars", "corr:latitude") in got and ("users", "average_stars", "distinct") in got
    assert not any(c == "is_open" and mt.startswith("corr:") for _, c, mt in got)  # bigint not in matrix


def test_load_tables(spark):
    t = IO.load_tables(spark, SF_MID, ["supplier", "customer"])
    assert set(t) == {"supplier", "customer"} and t["supplier"].count() == 100


def test_write_parquet_partitions(spark):
    df = fx.review(spark, SF_MID).select("review_id", "stars").repartition(2)
    for want in (1, 7):  # fewer and more files than the input has partitions
        path = scratch_path(spark, "parts")
        IO.write_parquet(df, path, partitions=want)
        back = IO.read_table(spark, path)
        assert back.count() == 10000
        assert len(back.inputFiles()) == want


def test_profile_of_a_large_table_reads_every_row(spark, tmp_path):
    landing = scratch_path(spark, "landing")
    path = Z.landing_path(landing, "big")
    spark.range(5000).selectExpr("id", "id % 7 AS k").write.json(path)
    spark.createDataFrame([("{oops",)], "value string").write.mode("append").text(path)
    eda = scratch_path(spark, "eda")
    row = Z.clean_zone(spark, landing, scratch_path(spark, "cleaned"), ["big"], eda_path=eda, partitions=3).first()
    assert (row.rows_in, row.malformed, row.rows_out) == (5001, 1, 5000)
    prof = {(r.column, r.metric): r.value for r in spark.read.json(f"{eda}/big").collect()}
    assert prof["id", "distinct"] == 5000 and prof["id", "max"] == 4999 and prof["k", "count"] == 5000


def test_shared_dir_is_required_on_a_cluster():
    from types import SimpleNamespace

    import pytest
    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        shared_dir(SimpleNamespace(sparkContext=sc))


def test_every_review_has_its_document(spark):
    docs = fx.base(spark, SF_MID, "documents").agg({"doc_id": "min", "*": "count"}).first()
    ids = fx.base(spark, SF_MID, "documents").select("doc_id").distinct().count()
    assert docs["min(doc_id)"] == 0 and ids == docs["count(1)"]
    assert fx.review(spark, SF_MID).count() == fx.base(spark, SF_MID, "events").count()


def test_landed_texts_are_packed(spark, tmp_path):
    import random
    from ridgeline.sources.io import input_bytes
    text = "".join(random.Random(1).choices("abcdefghij ", k=2000))
    rows = spark.range(0, 500, 1, 1).selectExpr("id", f"'{text}' AS text")
    IO.write_json(rows, str(tmp_path / "j"))
    IO.write_parquet(rows, str(tmp_path / "p"))
    for name, back in (("j", IO.read_json(spark, str(tmp_path / "j"))), ("p", IO.read_table(spark, str(tmp_path / "p")))):
        assert sorted(map(tuple, back.select("id", "text").collect())) == [(i, text) for i in range(500)]
        assert input_bytes(spark, str(tmp_path / name)).first().input_bytes < 40_000


def test_only_the_tables_that_are_read_are_landed(spark):
    from support import SF_SMALL
    from ridgeline.registry import _land
    from ridgeline.session import path_exists
    landing = _land(spark, SF_SMALL, ("business_dirty",))
    assert path_exists(spark, f"{landing}/business_dirty.json") and not path_exists(spark, f"{landing}/tip.json")
