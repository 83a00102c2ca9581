from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import schemas, streaming
from tidemark.sources import read_tweets, write_csv

TIMES = ["10:00:05", "10:00:50", "10:01:01", "10:03:00", "10:00:59"]


def write_message(spark, folder, i, time, text="hi"):
    frame = spark.createDataFrame([(str(i), f"2017-10-31 {time}", text)], "tweet_id string, created_at string, text string")
    streaming.encode_messages(frame, created_at="created_at").write.mode("append").text(str(folder))


def catch_up(spark, tmp_path):
    stream = streaming.decode_messages(streaming.read_message_files(spark, str(tmp_path / "topic"), 1))
    streaming.write_minute_files(
        stream, str(tmp_path / "out"), str(tmp_path / "progress"), availableNow=True
    ).awaitTermination()
    return streaming.read_minute_files(spark, str(tmp_path / "out"))


def test_encode_and_decode(spark):
    texts = ['say "hi",\nall', "😡", "", None, "back\\slash"]
    frame = spark.createDataFrame(
        [(str(i), "2017-10-31 10:00:00", t) for i, t in enumerate(texts)], "tweet_id string, created_at string, text string"
    )
    encoded = streaming.encode_messages(frame, created_at="created_at")
    assert encoded.dtypes == [("value", "string")]
    assert encoded.first().value == (
        '{"tweet_id":"0","created_at":"2017-10-31 10:00:00","text":"say \\"hi\\",\\nall"}'
    )
    assert Counter(streaming.decode_messages(encoded).collect()) == Counter(frame.collect())
    binary = encoded.select(F.col("value").cast("binary").alias("value"))
    assert Counter(streaming.decode_messages(binary).collect()) == Counter(frame.collect())
    stamped = streaming.decode_messages(streaming.encode_messages(frame)).first().created_at
    assert len(stamped) == 19 and stamped > "2024"


def test_broken_message(spark):
    broken = spark.createDataFrame([("no json",), ('{"tweet_id": "1"}',)], "value string")
    got = Counter(map(tuple, streaming.decode_messages(broken).collect()))
    assert got == Counter([(None, None, None), ("1", None, None)])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        streaming.decode_messages(broken, mode="FAILFAST").collect()


def test_minute_files_with_a_late_message_and_restarts(spark, tmp_path):
    for i, time in enumerate(TIMES[:3]):
        write_message(spark, tmp_path / "topic", i, time, 'a "b",\nc ')
    assert catch_up(spark, tmp_path).count() == 3
    for i, time in enumerate(TIMES[3:], 3):
        write_message(spark, tmp_path / "topic", i, time)
    catch_up(spark, tmp_path)
    got = catch_up(spark, tmp_path)
    assert Counter(r.minute for r in got.collect()) == Counter(
        {"2017_10_31_10_00_00": 3, "2017_10_31_10_01_00": 1, "2017_10_31_10_03_00": 1}
    )
    assert sorted(r.tweet_id for r in got.collect()) == ["0", "1", "2", "3", "4"]
    first = got.where("tweet_id = '0'").first()
    assert (first.created_at, first.text) == ("2017-10-31 10:00", 'a "b",\nc ')


def test_minute_counts_keep_messages_without_a_time(spark):
    frame = spark.createDataFrame([("2017-10-31 10:00:05",), ("soon",), (None,)], "created_at string")
    got = Counter((str(r.minute), r.n_messages) for r in streaming.minute_counts(frame).collect())
    assert got == Counter([("2017-10-31 10:00:00", 1), ("None", 2)])


def test_minute_counts_batch_and_stream(spark, tmp_path):
    for i, time in enumerate(TIMES):
        write_message(spark, tmp_path / "topic", i, time)
    batch = streaming.decode_messages(spark.read.text(str(tmp_path / "topic")))
    expected = Counter(tuple(r) for r in streaming.minute_counts(batch).collect())
    assert sorted(n for _, n in expected) == [1, 1, 3]
    for mode, name, delay in (("complete", "all_minutes", None), ("append", "closed_minutes", "1 minute")):
        messages = streaming.decode_messages(streaming.read_message_files(spark, str(tmp_path / "topic")))
        streaming.minute_counts(messages, delay).writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    assert Counter(map(tuple, spark.table("all_minutes").collect())) == expected
    # Append mode holds back minutes that may still be open.
    closed = Counter(map(tuple, spark.table("closed_minutes").collect()))
    assert 0 < len(closed) < len(expected) and not closed - expected


def test_replay(spark, tmp_path):
    tweets = spark.createDataFrame(
        [(str(i), "a", "True", "x", f'text "{i}",\nmore', None, None) for i in range(25)], schemas.TWEETS_CSV
    ).coalesce(1)
    write_csv(tweets, str(tmp_path / "file"))
    streaming.split_for_replay(read_tweets(spark, str(tmp_path / "file")), str(tmp_path / "steps"), 10)
    stream = streaming.encode_messages(streaming.read_tweet_stream(spark, str(tmp_path / "steps")))
    for _ in range(2):
        query = streaming.start_replay(
            stream.writeStream.format("text").option("path", str(tmp_path / "topic")), str(tmp_path / "progress")
        )
        query.awaitTermination()
    sent = streaming.decode_messages(spark.read.text(str(tmp_path / "topic"))).select("tweet_id", "text")
    assert Counter(sent.collect()) == Counter(tweets.select("tweet_id", "text").collect())


def test_replay_goes_on_after_a_stop(spark, tmp_path):
    rows = [(f"{i:03}", "a", "True", "x", f'line "{i}",\nmore', None, None) for i in range(60)]
    write_csv(spark.createDataFrame(rows, schemas.TWEETS_CSV).coalesce(1), str(tmp_path / "file"))

    def start(paced):
        tweets = read_tweets(spark, str(tmp_path / "file"))
        sink = streaming.text_sink(str(tmp_path / "topic"))
        return streaming.replay(spark, tweets, str(tmp_path / "progress"), sink, rows_per_step=10, paced=paced)

    query = start(paced=True)
    while not query.lastProgress:
        query.awaitTermination(1)
    query.stop()
    sent = spark.read.text(str(tmp_path / "topic")).count()
    assert 0 < sent < 60 and sent % 10 == 0
    for _ in range(2):
        start(paced=False).awaitTermination()
    got = streaming.decode_messages(spark.read.text(str(tmp_path / "topic"))).select("tweet_id", "text")
    assert Counter(map(tuple, got.collect())) == Counter((r[0], r[4]) for r in rows)
    steps = [f.read_text() for f in sorted((tmp_path / "progress" / "steps").glob("part-*"))]
    ids = [[line.split(",")[0] for line in step.split("\n")[1:] if line[:3].isdigit()] for step in steps]
    assert sum(ids, []) == [r[0] for r in rows] and max(map(len, ids)) == 10


def test_replay_pace(spark, tmp_path):
    tweets = spark.createDataFrame([("1", "a", "True", "x", "t", None, None)], schemas.TWEETS_CSV)
    streaming.split_for_replay(tweets, str(tmp_path / "steps"), 10)
    stream = streaming.encode_messages(streaming.read_tweet_stream(spark, str(tmp_path / "steps")))
    writer = stream.writeStream.format("text").option("path", str(tmp_path / "topic"))
    query = streaming.start_replay(writer, str(tmp_path / "progress"), rows_per_trigger=10)
    try:
        query.processAllAvailable()
        assert spark.read.text(str(tmp_path / "topic")).count() == 1
        assert query.isActive
    finally:
        query.stop()
