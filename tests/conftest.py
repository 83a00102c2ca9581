import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidemark import schemas  # noqa: E402
from tidemark.plans import normalize_videos  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


COLUMNS = [part.split()[0] for part in schemas.VIDEOS_CSV.split(",")]


@pytest.fixture
def raw(spark):
    """Text snapshots from dicts; missing fields get a plain default, None stays null."""

    def build(*rows):
        default = {
            "video_id": "v",
            "title": "t",
            "description": "d",
            "channel_title": "c",
            "category_id": "1",
            "tags": "a",
            "trending_date": "17.14.11",
            "views": "1",
            "likes": "1",
            "dislikes": "1",
        }
        return spark.createDataFrame(
            [tuple({**default, **row}[c] for c in COLUMNS) for row in rows], schemas.VIDEOS_CSV
        )

    return build


@pytest.fixture
def typed(raw):
    return lambda *rows: normalize_videos(raw(*rows))


@pytest.fixture
def titles(spark):
    return spark.createDataFrame([("1", "Film"), ("2", "Cars"), ("3", "Film")], "id string, title string")
