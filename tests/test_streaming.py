from harrowmill.operators import folds
from harrowmill.streaming import stateful as S

SCHEMA = "key string, id bigint, ts_us bigint, kind string"


def stream(spark, tmp_path, rows, files=2):
    for i in range(files):
        spark.createDataFrame(rows[i::files] if files > 1 else rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return S.event_stream(spark, str(tmp_path / "in"), "*.parquet", SCHEMA, per_trigger=10)


def test_dedup_equals_its_batch_twin(spark, tmp_path):
    rows = [("a", i, i * 3, "view") for i in range(12)] + [("b", 100, 5, "view")]
    got = sorted(r.id for r in S.run_to_end(S.ttl_dedup_stream(stream(spark, tmp_path, rows), 10), "t").collect())
    batch = folds.ttl_accepts(spark.createDataFrame(rows, SCHEMA), ["key"], 10).filter("accepted")
    want = sorted(r.id for r in batch.join(spark.createDataFrame(rows, SCHEMA), ["key", "ts_us"]).collect())
    assert got == want


def test_release_frees_the_key(spark, tmp_path):
    rows = [("a", 1, 0, "view"), ("a", 2, 1, "view"), ("a", 3, 2, "release"), ("a", 4, 3, "view")]
    assert sorted(r.id for r in S.run_to_end(S.ttl_dedup_stream(stream(spark, tmp_path, rows, 1), 10), "r").collect()) == [1, 4]
