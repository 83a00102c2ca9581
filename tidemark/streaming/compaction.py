"""One file per closed minute, kept by a manifest that readers follow."""

import json
import os

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.session import exists, file_names, read_text, write_text_once
from tidemark.sources.files import CSV_OPTIONS

FILE = f"{schemas.MINUTE_FILE}, minute string"


def _manifest(spark, folder):
    """Newest manifest: its number, the generation of each compacted minute, and the raw files taken."""
    names = file_names(spark, os.path.join(folder, "manifest"), ".json")
    if not names:
        return {"number": 0, "minutes": {}, "files": []}
    return json.loads(read_text(spark, os.path.join(folder, "manifest", names[-1])))


def _raw_files(spark, folder):
    """Committed files of the stream by minute key; the sink's own log decides which are."""
    raw = os.path.join(folder, "raw")
    if not exists(spark, raw) or not file_names(spark, raw):
        return {}
    found = {}
    for path in spark.read.schema(schemas.MINUTE_FILE).options(header=False, **CSV_OPTIONS).csv(raw).inputFiles():
        found.setdefault(path.split("/minute=")[-1].split("/")[0], []).append(path)
    return found


def _read(spark, folder, paths, base):
    reader = spark.read.schema(FILE).options(header=False, multiLine=True, **CSV_OPTIONS)
    return reader.option("basePath", os.path.join(folder, base)).csv(paths)


def _compacted(folder, generation, minute):
    return os.path.join(folder, "closed", f"generation={generation}", f"minute={minute}")


def _new_files(spark, folder, manifest):
    """Raw files by minute that no compaction has taken."""
    taken = set(manifest["files"])
    found = {m: [p for p in paths if p not in taken] for m, paths in _raw_files(spark, folder).items()}
    return {m: paths for m, paths in found.items() if paths}


def _rows(spark, folder, minutes, new):
    """Rows of the compacted `minutes` (key to generation) and of `new` raw files by minute."""
    parts = [([p for paths in new.values() for p in paths], "raw")]
    for generation in sorted(set(minutes.values())):
        paths = [_compacted(folder, generation, m) for m, g in minutes.items() if g == generation]
        parts.append((paths, f"closed/generation={generation}"))
    frames = [_read(spark, folder, paths, base) for paths, base in parts if paths]
    if not frames:
        return spark.createDataFrame([], FILE)
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.union(frame)
    return rows


def compact_minutes(spark, folder, closed_before):
    """Merge the files of every minute whose key is below `closed_before` into one file each; number of minutes merged.

    Only minutes with files that no compaction has taken are written. The new files of a minute, its earlier
    compacted one included, go to a new generation; a manifest, written whole or not at all, then names the generation
    of each minute and the raw files it holds. A crash before that leaves the old manifest, so nothing is lost or
    doubled; the next run overwrites what was left. Readers follow the newest manifest. Minutes that get late
    messages are merged again. Names of minutes and files pass through the driver, as in any listing; rows do not.
    """
    manifest = _manifest(spark, folder)
    new = {m: paths for m, paths in _new_files(spark, folder, manifest).items() if m < closed_before}
    if not new:
        return 0
    number = manifest["number"] + 1
    target = os.path.join(folder, "closed", f"generation={number}")
    earlier = {m: g for m, g in manifest["minutes"].items() if m in new}
    rows = _rows(spark, folder, earlier, new).repartition(max(1, len(new)), "minute")
    rows.write.mode("overwrite").options(header=False, **CSV_OPTIONS).partitionBy("minute").csv(target)
    files = manifest["files"] + [p for paths in new.values() for p in paths]
    following = {"number": number, "minutes": {**manifest["minutes"], **dict.fromkeys(new, number)}, "files": files}
    path = os.path.join(folder, "manifest", f"{number:012}.json")
    if not write_text_once(spark, path, json.dumps(following)):
        raise RuntimeError(f"another compaction has written {path}")
    return len(new)


def read_compacted_minutes(spark, folder):
    """All messages of the raw and the compacted files, each once, with `minute`."""
    manifest = _manifest(spark, folder)
    return _rows(spark, folder, manifest["minutes"], _new_files(spark, folder, manifest))


def minute_file_counts(spark, folder):
    """Rows (minute, n_files) of the files that readers read."""
    rows = read_compacted_minutes(spark, folder)
    return rows.select("minute", F.input_file_name().alias("path")).distinct().groupBy("minute").agg(F.count("*").alias("n_files"))
