from datetime import datetime, timedelta

from brightweir.functions.dates import reference
from brightweir.operators import freshness
from brightweir.session import scratch_path
from brightweir.streaming import monitor

REF = datetime(2026, 9, 12, 12)


def _write(spark, path, rows):
    df = spark.createDataFrame(rows, "id long, key string, ts timestamp, source string")
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def _rows(start, count, hours):
    # Every other record repeats the key "hot".
    return [(i, "hot" if i % 2 else f"k{i}", REF - timedelta(hours=hours, minutes=i % 50), f"s{i % 3}") for i in range(start, start + count)]


def test_stream_equals_batch_and_can_be_continued(spark, tmp_path):
    landed, table, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    schema = _write(spark, landed, _rows(0, 200, 20))
    _write(spark, landed, _rows(100, 200, 30))
    _write(spark, landed, [(999, "future", REF + timedelta(days=400), "s0")])

    def run():
        stream = monitor.file_stream(spark, landed, schema, files_per_trigger=1)
        fresh = monitor.fresh_stream(stream, "ts", reference(str(REF)), "key", ["id"])
        monitor.append_new(fresh, table, log, "key", ["id"]).awaitTermination()
        return {r.key for r in spark.read.parquet(table).collect()}, spark.read.parquet(table).count()

    batch = freshness.fresh_only(spark.read.parquet(landed), "ts", reference(str(REF)))
    expected = {r.key for r in batch.select("key").distinct().collect()}
    assert run() == (expected, len(expected))
    # A later run takes only new files and inserts no key twice.
    _write(spark, landed, _rows(150, 200, 2))
    expected |= {r.key for r in freshness.fresh_only(spark.read.parquet(landed), "ts", reference(str(REF))).collect()}
    assert run() == (expected, len(expected))
    # A lost checkpoint replays everything; the table stays the same.
    log = str(tmp_path / "log2")
    assert run() == (expected, len(expected))


def test_rejected_rows_keep_a_reason(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = _write(spark, landed, _rows(0, 10, 20) + _rows(10, 7, 30) + [(99, "f", REF + timedelta(hours=1), "s")])
    stale = monitor.stale_stream(monitor.file_stream(spark, landed, schema), "ts", reference(str(REF)))
    monitor.append_all(stale, out, str(tmp_path / "log")).awaitTermination()
    counts = {r.reason_code: r["count"] for r in spark.read.parquet(out).groupBy("reason_code").count().collect()}
    assert counts == {"STALE_RECORD": 7, "FUTURE_TIMESTAMP": 1}


def test_closed_windows_are_counted(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i, "k", REF + timedelta(minutes=30 * i), "s") for i in range(8)]
    schema = _write(spark, landed, rows)
    counts = monitor.window_counts(monitor.file_stream(spark, landed, schema), "ts", "source", delay="1 hour")
    monitor.append_all(counts, out, str(tmp_path / "log")).awaitTermination()
    got = {(r.window_start, r.n_rows) for r in spark.read.parquet(out).collect()}
    # The last event is at 15:30, so windows ending by 14:30 are closed.
    assert got == {(REF, 2), (REF + timedelta(hours=1), 2)}


def test_open_windows_are_counted_too(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = _write(spark, landed, [(i, "k", REF + timedelta(minutes=20 * i), "s") for i in range(8)])

    def run():
        counts = monitor.window_counts(monitor.file_stream(spark, landed, schema, files_per_trigger=1), "ts", "source")
        monitor.append_updates(counts, out, str(tmp_path / "log")).awaitTermination()
        return {(r.window_start, r.n_rows) for r in monitor.latest_counts(spark.read.parquet(out), "source").collect()}

    assert run() == {(REF, 3), (REF + timedelta(hours=1), 3), (REF + timedelta(hours=2), 2)}
    _write(spark, landed, [(9, "k", REF + timedelta(minutes=150), "s")])
    assert run() == {(REF, 3), (REF + timedelta(hours=1), 3), (REF + timedelta(hours=2), 3)}


def test_scratch_is_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert first != second and first.startswith(shared.rstrip("/") + "/x-")
