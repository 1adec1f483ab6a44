from pyspark.sql import functions as F

from tessera import streaming as S


def test_fsm_and_dedup(spark, tmp_path):
    rows = [(1, 1, "RUN_CREATED", "2024-01-01 00:00:00"), (1, 2, "RUN_STARTED", "2024-01-01 00:01:00"), (1, 3, "RUN_CREATED", "2024-01-01 00:02:00"), (2, 1, "RUN_STARTED", "2024-01-01 00:03:00"), (1, 4, "HUMAN_DECISION", "2024-01-01 00:04:00")]
    df = spark.createDataFrame(rows, "run_id long, seq long, event_type string, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.unionByName(df.limit(0)).write.parquet(str(tmp_path / "in"))
    stream = S.event_stream(spark, str(tmp_path / "in"), df.schema)
    S.run_available(S.fsm_check(stream), str(tmp_path / "bad"), str(tmp_path / "c1"))
    assert {(r["run_id"], r["seq"]) for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == {(1, 3), (2, 1)}
    S.run_available(S.import_dedup(stream, "ts", "event_type", "1 hour"), str(tmp_path / "once"), str(tmp_path / "c2"))
    assert spark.read.parquet(str(tmp_path / "once")).count() == 3


def test_latest_of_closed_windows(spark, tmp_path):
    rows = [("a", "2024-01-01 00:01:00"), ("a", "2024-01-01 00:50:00"), ("b", "2024-01-01 00:02:00"), ("a", "2024-01-01 09:00:00")]
    df = spark.createDataFrame(rows, "k string, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = S.latest(S.event_stream(spark, str(tmp_path / "in"), df.schema), "ts", "k", "10 minutes", "1 hour")
    S.run_available(stream.select("k", "latest", "n"), str(tmp_path / "out"), str(tmp_path / "c"))
    got = {(r["k"], str(r["latest"]), r["n"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", "2024-01-01 00:50:00", 2), ("b", "2024-01-01 00:02:00", 1)}  # the last window is still open
