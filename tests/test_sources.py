import json
from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from tidemark import schemas, session, sources

TRICKY = [
    'plain, with "quotes"',
    "two\nlines",
    " spaces kept ",
    '"',
    "ends with backslash \\",
    'a \\" mix',
    "tab\tand 😡",
    "x\r\ny",
]


def test_tweets_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(
        [(str(i), "me", "True", None, t, "1,2", None) for i, t in enumerate(TRICKY)], schemas.TWEETS_CSV
    )
    sources.write_csv(frame, str(tmp_path / "t"))
    back = sources.read_tweets(spark, str(tmp_path / "t"))
    assert Counter(back.collect()) == Counter(frame.collect())


def test_hand_written_tweet_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n"
        '1,a,True,x,"say ""hi"", all",2,\n'
        '3,b,False,y,"line one\nline two","4,5",1\n'
    )
    rows = {r.tweet_id: r for r in sources.read_tweets(spark, str(path)).collect()}
    assert rows["1"].text == 'say "hi", all' and rows["1"].in_response_to_tweet_id is None
    assert rows["3"].text == "line one\nline two" and rows["3"].response_tweet_id == "4,5"


def test_videos_csv_by_header_and_by_schema(spark, raw, tmp_path):
    frame = raw({"description": 'say ""hi"", all\nnext', "tags": '"a"|"b"'}, {"description": None})
    sources.write_csv(frame, str(tmp_path / "v"))
    back = sources.read_videos(spark, str(tmp_path / "v"))
    assert set(back.dtypes) == {(c, "string") for c in frame.columns}
    assert Counter(back.collect()) == Counter(frame.collect())
    typed = sources.read_videos(spark, str(tmp_path / "v"), schemas.VIDEOS_CSV)
    assert Counter(typed.collect()) == Counter(frame.collect())


def test_transactions(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,"
        "isFraud,isFlaggedFraud\n1,PAYMENT,9.5,C1,10.0,0.5,M1,0.0,9.5,0,0\n2,CASH,1.0,C2,1.0,0.0,M2,0.0,1.0,,1\n"
    )
    frame = sources.read_transactions(spark, str(path))
    assert frame.count() == 2
    assert [t for _, t in frame.dtypes] == ["int", "string", "double", "string", "double", "double", "string", "double", "double", "int", "int"]
    assert [r.isFraud for r in frame.orderBy("step").collect()] == [0, None]


def test_categories(spark, tmp_path):
    document = {
        "kind": "k",
        "etag": '"e"',
        "items": [
            {"kind": "k", "etag": "e", "id": i, "snippet": {"channelId": "c", "title": t, "assignable": True}}
            for i, t in [("1", "Film"), ("23", "Comedy"), ("34", "Comedy")]
        ],
    }
    path = tmp_path / "c.json"
    path.write_text(json.dumps(document, indent=1))
    rows = Counter(tuple(r) for r in sources.read_categories(spark, str(path)).collect())
    assert rows == Counter([("1", "Film"), ("23", "Comedy"), ("34", "Comedy")])
    inferred = spark.read.json(str(path), multiLine=True)
    assert Counter(map(tuple, sources.flatten_categories(inferred).collect())) == rows


def test_write_table(spark, typed, tmp_path):
    frame = typed({}, {"views": "x"})
    back = sources.write_table(frame, str(tmp_path / "p"))
    assert back.dtypes == frame.dtypes and Counter(back.collect()) == Counter(frame.collect())


def test_videos_without_joins_are_the_same_rows(spark):
    folder = "/root/testdata/sf0.001"
    narrow = sources.videos(spark, folder, "video_id", "views")
    whole = sources.videos(spark, folder).select("video_id", "views")
    assert Counter(narrow.collect()) == Counter(whole.collect())


def test_kafka_is_asked_for_by_name(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        sources.message_reader(spark, "broker:9093", max_offsets_per_trigger=1000)
    frame = spark.createDataFrame([("{}",)], "value string")
    with pytest.raises(AnalysisException, match="kafka"):
        sources.message_writer(frame, "broker:9093").save()


def test_shared_folder(spark, monkeypatch):
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({f"spark.{k.replace('_', '.')}": v for k, v in conf.items()})

    assert session.shared_folder(Session(checkpoint_dir="hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        session.shared_folder(Session(master="spark://host:7077"))
    local = Session(master="local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
    assert session.work_folder(spark, "x") != session.work_folder(spark, "x")


def test_session_factory_sets_no_master():
    assert "spark.master" not in session.DEFAULTS
