"""Streams with late rows: watermarks close windows and let go of state."""

import os

import pytest

from gleanery import streaming


@pytest.fixture
def late(spark, tmp_path):
    """A stream of files: times go up, then one row comes that is too late."""
    day = "2026-01-01 "
    batches = [
        [(1, day + "00:05:00", "a"), (1, day + "00:06:00", "a")], [(2, day + "03:00:00", "a")], [(5, day + "03:00:30", "c")],
        [(3, day + "00:10:00", "a"), (1, day + "03:01:00", "b")], [(4, day + "09:00:00", "a")],
    ]
    folder = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "k long, ts string, kind string").selectExpr("k", "to_timestamp(ts) AS ts", "kind").coalesce(1).write.mode("append").parquet(str(folder / str(i)))
    flat = tmp_path / "flat"
    flat.mkdir()
    for i in range(len(batches)):
        part = next((folder / str(i)).glob("part-*.parquet"))
        target = flat / f"{i}-events.parquet"
        target.write_bytes(part.read_bytes())
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))  # the order in which they are read
    schema = spark.read.parquet(str(flat)).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(flat))


def drained(stream, tmp_path):
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out).collect()


def test_late_rows_miss_their_window(late, tmp_path):
    rows = drained(streaming.windowed_counts(late, "ts", ["kind"]), tmp_path)
    # the row of 00:10 comes after the watermark has passed 02:50; windows after 08:50 are still open
    assert sorted((r["window"]["start"].hour, r["kind"], r["n"]) for r in rows) == [(0, "a", 2), (3, "a", 1), (3, "b", 1), (3, "c", 1)]


def test_state_is_let_go_of_after_the_watermark(late, tmp_path):
    rows = drained(streaming.dedup(late, ["k"], "ts", "1 hour"), tmp_path)
    # key 1 is a repeat within the hour and new again three hours later; key 3 is too late
    assert sorted((r["k"], r["kind"]) for r in rows) == [(1, "a"), (1, "b"), (2, "a"), (4, "a"), (5, "c")]


def test_sessions_close(late, tmp_path):
    rows = drained(streaming.session_counts(late, "ts", ["kind"]), tmp_path)
    assert sorted((r["kind"], r["n"]) for r in rows) == [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
