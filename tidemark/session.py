"""Session and shared-folder helpers."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Time zone and adaptive execution are what the results and the skew handling rely on.
# Sizes (executors, memory, shuffle partitions) belong to the job's own submit settings.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app_name="tidemark", shuffle_partitions=None, **conf):
    """Return a session. No master is set here, so `spark-submit --master` decides.

    `shuffle_partitions` is the starting number that adaptive execution merges down
    from. Size it as shuffled bytes / 128 MB; the default of 200 is far too few for
    terabytes.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark):
    """Folder that all executors see: `spark.checkpoint.dir`, or a fresh one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_MADE = []


def work_folder(spark, name):
    """A new, unused path below the shared folder."""
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    _MADE.append(path)
    return path


def _storage(spark, path):
    """Hadoop file system and path object of a path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark, path):
    """Whether a file or folder is there, in any storage that Spark reads."""
    storage, place = _storage(spark, path)
    return storage.exists(place)


def write_text_once(spark, path, text):
    """Write a small text file whole or not at all; False if it is there already."""
    storage, place = _storage(spark, path)
    if storage.exists(place):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    out = storage.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if storage.rename(draft, place):
        return True
    storage.delete(draft, False)
    return False


def file_names(spark, folder, suffix=""):
    """Sorted names in a folder; none if it is not there."""
    storage, place = _storage(spark, folder)
    if not storage.exists(place):
        return []
    names = [status.getPath().getName() for status in storage.listStatus(place)]
    return sorted(name for name in names if name.endswith(suffix) and not name.startswith((".", "_")))


def read_text(spark, path):
    """Text of a small file."""
    storage, place = _storage(spark, path)
    stream = storage.open(place)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def remove_work_folders(spark):
    """Delete the work folders of this process; for the end of a job, when no frame reads them any more."""
    while _MADE:
        storage, place = _storage(spark, _MADE.pop())
        storage.delete(place, True)
