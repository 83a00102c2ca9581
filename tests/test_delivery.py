import json
import time
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import schemas, streaming
from tidemark.session import write_text_once
from tidemark.sources import read_tweets, write_csv

MESSAGE = "tweet_id string, created_at string, text string"


def tweet_file(spark, path, n):
    rows = [(f"{i:04}", "a", "True", "x", f'line "{i}",\nmore', None, None) for i in range(n)]
    write_csv(spark.createDataFrame(rows, schemas.TWEETS_CSV).repartitionByRange(3, "tweet_id").sortWithinPartitions("tweet_id"), str(path))
    return [r[0] for r in rows]


def decoded(spark, folder):
    rows = streaming.decode_messages(spark.read.parquet(str(folder)), keep=["number", "step"])
    return sorted((r.number, r.step, r.tweet_id) for r in rows.collect())


def test_numbers_are_gapless_and_follow_files_and_lines(spark, tmp_path):
    ids = tweet_file(spark, tmp_path / "file", 250)
    for _ in range(2):
        streaming.number_rows(read_tweets(spark, str(tmp_path / "file")), str(tmp_path / "table"), block_rows=100)
    rows = spark.read.parquet(str(tmp_path / "table" / "rows")).orderBy("number").collect()
    assert [(r.number, r.block, r.tweet_id) for r in rows] == [(i, i // 100, t) for i, t in enumerate(ids)]


def test_messages_leave_evenly_and_go_on_after_a_stop(spark, tmp_path):
    ids, seen = tweet_file(spark, tmp_path / "file", 90), []
    assert streaming.messages_per_step() == 11 and streaming.messages_per_step(5) == 1

    def send(messages, batch_id):
        seen.append((time.monotonic(), messages.count(), batch_id))
        streaming.folder_sender(str(tmp_path / "topic"))(messages, batch_id)

    def start(**options):
        return streaming.replay_paced(spark, read_tweets(spark, str(tmp_path / "file")), str(tmp_path / "progress"), send, seconds=0.05, **options)

    replay = start()
    while len(seen) < 3:
        replay.query.awaitTermination(0.1)
    replay.query.stop()
    # One second's share at most, and a second between any two of them.
    assert all(n <= 20 for _, n, _ in seen)
    assert all(b[0] - a[0] > 0.7 for a, b in zip(seen[1:], seen[2:]))
    start().wait()
    assert decoded(spark, tmp_path / "topic") == [(i, i // 20, t) for i, t in enumerate(ids)]


def test_fast_replay_and_empty_file(spark, tmp_path):
    ids = tweet_file(spark, tmp_path / "file", 30)
    send = streaming.folder_sender(str(tmp_path / "topic"))
    streaming.replay_paced(spark, read_tweets(spark, str(tmp_path / "file")), str(tmp_path / "p"), send, steps_per_batch=2).wait()
    assert decoded(spark, tmp_path / "topic") == [(i, i // 11, t) for i, t in enumerate(ids)]
    none = spark.createDataFrame([], schemas.TWEETS_CSV)
    streaming.replay_paced(spark, none, str(tmp_path / "q"), send, steps_per_batch=2).wait()


def test_failed_batch_is_sent_once_more_and_bad_records_are_set_aside(spark, tmp_path):
    records = spark.createDataFrame([("a",), (None,), ("x" * 50,), ("b",)], "value string")
    calls = []

    def send(messages, batch_id):
        calls.append(sorted(r.value for r in messages.collect()))
        if len(calls) == 1:
            raise RuntimeError("no acknowledgement")

    deliver = streaming.acknowledged(send, str(tmp_path), most_bytes=20)
    deliver(records, 7)
    deliver(records, 7)
    assert calls == [["a", "b"]] * 2
    assert [tuple(r) for r in streaming.sent_batches(spark, str(tmp_path)).collect()] == [(7, 2, 2, 2)]
    aside = streaming.rejected_records(spark, str(tmp_path)).collect()
    assert Counter(tuple(r) for r in aside) == Counter([(None, 7), ("x" * 50, 7)])


def test_sender_that_keeps_failing_stops_the_query_and_a_restart_loses_nothing(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(str(tmp_path / "topic"))
    stream = spark.readStream.text(str(tmp_path / "topic"))

    def fail(messages, batch_id):
        raise RuntimeError("no broker")

    def start(send):
        return streaming.start_acknowledged(stream, str(tmp_path / "progress"), send, str(tmp_path / "delivery"))

    with pytest.raises(StreamingQueryException):
        start(fail).awaitTermination()
    assert streaming.sent_batches(spark, str(tmp_path / "delivery")).count() == 0
    start(streaming.folder_sender(str(tmp_path / "sent"))).awaitTermination()
    start(fail).awaitTermination()
    assert Counter(r.value for r in spark.read.parquet(str(tmp_path / "sent")).collect()) == Counter(["a", "b"])


def batch(spark, *times):
    return spark.createDataFrame([("i", t, "x") for t in times], MESSAGE)


def counts(spark, folder):
    rows = streaming.read_minute_counts(spark, folder).select(F.date_format("minute", "HH:mm").alias("m"), "n_messages", "n_late")
    return {r.m: (r.n_messages, r.n_late) for r in rows.collect()}


@pytest.mark.parametrize("merge_every", [1, 2, 100])
def test_minute_table_takes_late_unparseable_and_repeated_batches(spark, tmp_path, merge_every):
    folder = str(tmp_path)
    assert counts(spark, folder) == {}
    add = streaming.add_minute_counts(folder, merge_every)
    day = "2017-10-31 "
    add(batch(spark, day + "10:00:05", day + "10:00:50", "soon"), 0)
    add(batch(spark, day + "10:01:00", None), 1)
    assert counts(spark, folder) == {"10:00": (2, 0), None: (2, 0), "10:01": (1, 0)}
    # The same batch again, whole or in another order, changes nothing.
    add(batch(spark, None, day + "10:01:00"), 1)
    # A message of an earlier minute is late.
    add(batch(spark, day + "10:00:59", day + "10:02:00"), 2)
    add(batch(spark), 3)
    add(batch(spark, day + "10:01:30"), 4)
    assert counts(spark, folder) == {"10:00": (3, 1), None: (2, 0), "10:01": (2, 1), "10:02": (1, 0)}


def test_batch_that_was_cut_short_is_not_read(spark, tmp_path):
    add = streaming.add_minute_counts(str(tmp_path))
    add(batch(spark, "2017-10-31 10:00:05"), 0)
    # Written, but stopped before its state file.
    batch(spark).selectExpr("now() minute", "1L n_messages", "0L n_late").write.parquet(str(tmp_path / "batch=1"))
    spark.range(1).selectExpr("now() minute", "1L n_messages", "0L n_late").write.mode("append").parquet(str(tmp_path / "batch=1"))
    assert counts(spark, str(tmp_path)) == {"10:00": (1, 0)}
    add(batch(spark, "2017-10-31 10:00:06"), 1)
    assert counts(spark, str(tmp_path)) == {"10:00": (2, 0)}


def minutes_of(spark, folder, *times):
    """One more trigger of the stream of minute files."""
    frame = spark.createDataFrame([(t, t, "x,\ny") for t in times], MESSAGE).repartition(2)
    streaming.encode_messages(frame, created_at="created_at").write.mode("append").text(f"{folder}/topic")
    stream = streaming.decode_messages(streaming.read_message_files(spark, f"{folder}/topic", 1))
    streaming.write_minute_files(stream, f"{folder}/raw", f"{folder}/progress", availableNow=True).awaitTermination()


def read(spark, folder):
    return sorted((r.minute, r.tweet_id) for r in streaming.read_compacted_minutes(spark, folder).collect())


def files(spark, folder):
    return {r.minute: r.n_files for r in streaming.minute_file_counts(spark, folder).collect()}


def test_one_file_per_closed_minute(spark, tmp_path):
    folder, day = str(tmp_path), "2017-10-31 "
    assert streaming.compact_minutes(spark, folder, "9") == 0 and read(spark, folder) == []
    times = [day + f"10:0{m}:{s:02}" for s in range(4) for m in range(3)]
    for s in range(4):
        minutes_of(spark, folder, *times[3 * s : 3 * s + 3])
    key = lambda t: f"2017_10_31_10_{t[14:16]}_00"
    expected = sorted((key(t), t) for t in times)
    assert read(spark, folder) == expected and max(files(spark, folder).values()) > 1
    assert streaming.compact_minutes(spark, folder, key(day + "10:02:00")) == 2
    assert read(spark, folder) == expected
    assert [n for m, n in sorted(files(spark, folder).items())][:2] == [1, 1]
    assert streaming.compact_minutes(spark, folder, key(day + "10:02:00")) == 0
    # A late message opens its minute again; the next run merges it.
    minutes_of(spark, folder, day + "10:00:59")
    expected = sorted([*expected, (key(day + "10:00"), day + "10:00:59")])
    assert read(spark, folder) == expected
    assert streaming.compact_minutes(spark, folder, "9") == 2
    assert read(spark, folder) == expected and set(files(spark, folder).values()) == {1}


def test_crash_before_the_manifest_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    folder, day = str(tmp_path), "2017-10-31 "
    for s in range(2):
        minutes_of(spark, folder, day + f"10:00:0{s}")
    expected = read(spark, folder)

    def crash(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr("tidemark.streaming.compaction.write_text_once", crash)
        with pytest.raises(RuntimeError):
            streaming.compact_minutes(spark, folder, "9")
    assert read(spark, folder) == expected
    assert streaming.compact_minutes(spark, folder, "9") == 1
    assert read(spark, folder) == expected and set(files(spark, folder).values()) == {1}


def test_small_files_are_written_whole_and_once(spark, tmp_path):
    path = str(tmp_path / "a" / "b.json")
    assert write_text_once(spark, path, '{"x": "é"}') and not write_text_once(spark, path, "other")
    assert json.loads((tmp_path / "a" / "b.json").read_text()) == {"x": "é"}
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")] == ["b.json"]


def test_positions_of_a_consumer(spark, tmp_path):
    streaming.encode_messages(batch(spark, "1", "2", "3").repartition(3), created_at="created_at").write.text(str(tmp_path / "topic"))
    listener = streaming.PositionLog(spark, str(tmp_path / "positions"), "readers")
    spark.streams.addListener(listener)
    try:
        for _ in range(2):
            stream = streaming.read_message_files(spark, str(tmp_path / "topic"), 1)
            writer = stream.writeStream.format("parquet").queryName("readers").option("checkpointLocation", str(tmp_path / "progress"))
            writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        assert streaming.await_positions(spark, str(tmp_path / "positions"), "readers", 3) == 3
    finally:
        spark.streams.removeListener(listener)
    rows = streaming.read_positions(spark, str(tmp_path / "positions"), "readers").orderBy("batch").collect()
    assert sum(r.n_rows for r in rows) == 3 and all(len(r.starts) == len(r.ends) == 1 for r in rows)
    assert all(b.starts == a.ends for a, b in zip(rows, rows[1:]))
    assert streaming.read_positions(spark, str(tmp_path / "positions"), "others").count() == 0
