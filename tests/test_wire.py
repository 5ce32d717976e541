"""Growing files of messages by offsets, and line protocol that only committed tasks add to."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tickforge.operators.clean import closed_only
from tickforge.sources import messages, wire
from tickforge.sources.scratch import scratch_path


def message(k: int) -> str:
    return json.dumps({"k": {"t": 60_000 * k, "o": "1", "h": "2", "l": "0.5", "c": str(k), "v": "3", "q": "4", "n": 5, "V": "1", "Q": "2", "x": True}})


@pytest.mark.parametrize("range_bytes", [1, 7, 64 << 20])
def test_every_line_is_in_one_range(spark, tmp_path, range_bytes):
    texts = ["", "a", "bb\r", "ünï", "x" * 50, "", "last whole"]
    (tmp_path / "one.log").write_bytes("\n".join(texts).encode() + b"\nnot yet whole")
    (tmp_path / "empty.log").write_bytes(b"")
    (tmp_path / "_hidden").write_bytes(b"no\n")
    wire.register(spark)
    got = spark.read.format("message_lines").option("path", str(tmp_path)).option("rangeBytes", range_bytes).load().orderBy("offset").collect()
    assert [r["value"] for r in got] == [t.rstrip("\r") for t in texts]
    whole = (tmp_path / "one.log").read_bytes()
    assert all(whole[r["offset"] :].decode().startswith(r["value"]) for r in got)


def test_stream_follows_files_that_grow(spark, tmp_path):
    source, out, state = tmp_path / "in", scratch_path(spark, "klines"), scratch_path(spark, "state")
    source.mkdir()

    def land():
        lines = wire.message_stream(spark, str(source)).select(F.lit("btc@kline_1m").alias("stream"), "value")
        closed_only(messages.parse_ws_klines(lines)).writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()

    parts = [("a", [0, 1, 2], ""), ("a", [3], message(4)[:20]), ("b", [7], ""), ("a", [], message(4)[20:] + "\n")]
    seen = []
    for name, whole, rest in parts:
        with open(source / name, "a") as to:
            to.write("".join(message(k) + "\n" for k in whole) + rest)
        land()
        seen.append(sorted(int(r["close"]) for r in spark.read.parquet(out).collect()))
    assert seen == [[0, 1, 2], [0, 1, 2, 3], [0, 1, 2, 3, 7], [0, 1, 2, 3, 4, 7]]


def test_lines_round_trip_and_add_up(spark):
    path = scratch_path(spark, "lines")
    for lo in (0, 100):
        wire.write_lines(spark.range(lo, lo + 100, 1, 3).select(F.format_string("m,s=é v=%di 1", "id").alias("value")), path)
    wire.write_lines(spark.range(0).select(F.lit("x").alias("value")), path)
    assert sorted(r["value"] for r in wire.read_lines(spark, path).collect()) == sorted(f"m,s=é v={k}i 1" for k in range(200))


def test_a_lost_task_leaves_no_line(spark, tmp_path):
    path = str(tmp_path / "lines")
    good = spark.range(10).select(F.col("id").cast("string").alias("value"))
    wire.write_lines(good, path)
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="lost"):
        wire.write_lines(bad, path)
    (tmp_path / "lines" / "part-ofalostjob.lp").write_text("never\n")
    assert sorted(int(r["value"]) for r in wire.read_lines(spark, path).collect()) == list(range(10))


def test_overwriting_is_refused(spark):
    wire.register(spark)
    with pytest.raises(Exception, match="appended"):
        spark.range(1).select(F.lit("x").alias("value")).write.format("line_protocol").mode("overwrite").option("path", scratch_path(spark, "lines")).save()
