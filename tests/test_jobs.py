import json

import pytest

from tidemark import jobs, sources


@pytest.fixture
def files(spark, raw, tmp_path):
    frame = raw(
        {"trending_date": "17.13.11", "views": "100001", "likes": "4", "tags": '"a"|"b"'},
        {"trending_date": "17.14.11", "views": "100005", "likes": "6"},
        {"trending_date": "17.14.11", "video_id": "w", "description": 'x, "y"\nz'},
    )
    sources.write_csv(frame, str(tmp_path / "videos"))
    item = {"kind": "k", "etag": "e", "id": "1", "snippet": {"channelId": "c", "title": "Film", "assignable": True}}
    (tmp_path / "c.json").write_text(json.dumps({"kind": "k", "etag": "e", "items": [item]}, indent=1))
    return ["--videos", str(tmp_path / "videos"), "--categories", str(tmp_path / "c.json")]


def test_analyses_print(spark, files, capsys):
    jobs.main(["analyses", *files])
    out = capsys.readouterr().out
    for name in ("trendingDays", "weeks", "month", "video_views", "videos_days", "ratio_likes_dislikes"):
        assert name in out


def test_analyses_write(spark, files, tmp_path):
    jobs.main(["analyses", *files, "--out", str(tmp_path / "out"), "--dedupe", "period"])
    weeks = [r.weeks for r in spark.read.json(str(tmp_path / "out" / "top_week_categories")).collect()]
    assert [(w.category_name, w.total_views, w.video_ids) for w in weeks] == [("Film", 4, ["v"])]
    assert spark.read.json(str(tmp_path / "out" / "top_tags_monthly")).count() == 31
    assert spark.read.json(str(tmp_path / "out" / "top_trending_videos")).count() == 2


def test_profile(spark, tmp_path, capsys):
    frame = sources.transactions(spark, "/root/testdata/sf0.001")
    sources.write_csv(frame, str(tmp_path / "t"))
    jobs.main(["profile", "--transactions", str(tmp_path / "t")])
    assert f"{frame.count():,} rows in total" in capsys.readouterr().out


def test_profile_as_a_table(spark, tmp_path):
    frame = sources.transactions(spark, "/root/testdata/sf0.001")
    sources.write_csv(frame, str(tmp_path / "t"))
    jobs.main(["profile", "--transactions", str(tmp_path / "t"), "--out", str(tmp_path / "o")])
    found = {r.column: r for r in spark.read.json(str(tmp_path / "o" / "profile")).collect()}
    assert found["step"].n_rows == frame.count() == spark.read.parquet(str(tmp_path / "o" / "table")).count()
    assert found["nameOrig"].n_nulls == 0 and found["isFraud"].greatest == "1"


def test_compact_without_files(spark, tmp_path, capsys):
    jobs.main(["compact", "--out", str(tmp_path), "--before", "2024_01_01_00_00_00"])
    assert "0 minutes merged" in capsys.readouterr().out


def test_message_jobs_reach_the_connector(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n1,a,True,x,hi,,\n"
    )
    common = ["--servers", "broker:9093", "--progress", str(tmp_path / "p")]
    with pytest.raises(Exception, match="kafka"):
        jobs.main(["replay", "--tweets", str(tmp_path / "t.csv"), *common])
    with pytest.raises(Exception, match="kafka"):
        jobs.main(["minutes", "--out", str(tmp_path / "o"), *common])
