"""Positions of a consumer: what each committed batch has read."""

import json
import os
import time

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.session import file_names, write_text_once

POSITIONS = "group string, batch long, n_rows long, starts array<string>, ends array<string>"


class PositionLog(StreamingQueryListener):
    """Writes the committed positions of the queries named `group`, one file per batch with rows.

    A batch that was cut short has no entry: progress is reported once its commit is done. Its restart has the same
    id, and an entry that is there stays as it is.
    """

    def __init__(self, spark, folder, group):
        self.spark, self.folder, self.group = spark, os.path.join(folder, group), group

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.name != self.group or not progress.numInputRows:
            return
        entry = {
            "group": self.group,
            "batch": progress.batchId,
            "n_rows": progress.numInputRows,
            "starts": [str(source.startOffset) for source in progress.sources],
            "ends": [str(source.endOffset) for source in progress.sources],
        }
        write_text_once(self.spark, os.path.join(self.folder, f"{progress.batchId:012}.json"), json.dumps(entry))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def read_positions(spark, folder, group):
    """One row per committed batch of a group."""
    path = os.path.join(folder, group)
    return spark.read.schema(POSITIONS).json(path) if file_names(spark, path, ".json") else spark.createDataFrame([], POSITIONS)


def await_positions(spark, folder, group, n_rows, seconds=60):
    """Until the positions cover `n_rows` rows; events of a query reach listeners a moment after it."""
    limit = time.monotonic() + seconds
    while True:
        found = read_positions(spark, folder, group).agg(F.sum("n_rows")).first()[0] or 0
        if found >= n_rows or time.monotonic() > limit:
            return found
        time.sleep(0.2)
