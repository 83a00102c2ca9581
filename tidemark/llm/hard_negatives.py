"""Hard negatives by Four-Russians scoring of integer vectors.

Each component x becomes floor(`scale` * x). For each group of eight dimensions of an anchor, a table holds the
sums of all 256 subsets of its eight components. A candidate is stored as bit planes: bit j of its
components, in two's complement, eight dimensions to a byte. A plane's part of the inner product is one table
lookup per byte; the planes are added from the sign plane down, doubling in between. The result is
the exact integer score, with no multiplication per dimension.

Anchors are a stated query set that meets all rows in blocks: files of at most `PIECE_ROWS` packed
candidates and of at most `BLOCK_ANCHORS` anchors lie in the shared folder, and a row of the work list names one
of each. A task maps one candidate file and one anchor block at a time, whatever the number of rows. Two
rounds go over the list:

1. Each anchor against the rows of its own label (pieces are ordered by label): its first `positives` other rows.
2. Each anchor against the rows of other labels: for each of its positives the first `negatives` rows
   with low * positive score <= 100 * score <= high * positive score.

A task returns the best rows per anchor and block, which are merged by rank; a hot label or a group of copies
is spread over the pieces like all other rows.

Rows with a null id or label, a null vector, or null or non-finite components take no part, nor do rows with a
component beyond `LARGEST` in size after scaling, whose scores could leave 64 bits; zero and empty vectors do.
An id that occurs more than once counts once, with its smallest label and vector. Vectors of other lengths than the
anchor's are no rows of it. Ties go to the smaller id. Anchors without positives and positives
without negatives give no rows; empty tables give none. Other columns are ignored.
"""

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.arrays import load, save
from tidemark.session import work_folder

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
LARGEST = 1 << 22
PIECE_ROWS, BLOCK_ANCHORS, SLOT_PIECES, CHUNK = 16384, 256, 16, 128
NONE = -(1 << 62)
FILES = "dim int, path string, rows long, bits int"
WORK = "dim int, path string, rows long, bits int, block int, slot int"
BEST = "anchor long, positive long, positive_score long, id long, score long"


def bit_planes(x, bits):
    """Bytes (rows, planes, groups) of integer vectors in two's complement, lowest plane first."""
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % 8)))
    planes = [np.packbits((x >> j & 1).astype(np.uint8), axis=1, bitorder="little") for j in range(bits)]
    return np.stack(planes, axis=1)


def bits_of(x):
    """Planes that hold all components, sign included."""
    return int(max(x.max(initial=0), -1 - x.min(initial=0))).bit_length() + 1


def subset_sums(anchors):
    """Table (groups, 256, anchors) of the sums of all subsets of eight components."""
    x = np.pad(anchors, ((0, 0), (0, -anchors.shape[1] % 8)))
    groups = x.reshape(len(x), -1, 8).transpose(1, 2, 0)
    table = np.zeros((len(groups), 256, len(x)), np.int64)
    for j in range(8):
        # Subsets whose highest member is j extend those of the members below.
        table[:, 1 << j : 2 << j] = table[:, : 1 << j] + groups[:, j : j + 1]
    return table


def scores(table, planes):
    """Exact inner products (rows, anchors) by lookups, from the sign plane down."""
    n, bits, groups = planes.shape
    out = np.zeros((n, table.shape[2]), table.dtype)
    plane, part = np.empty((2, min(n, CHUNK), table.shape[2]), table.dtype)
    for at in range(0, n, CHUNK):
        rows = planes[at : at + CHUNK]
        total, plane_sum, looked_up = out[at : at + CHUNK], plane[: len(rows)], part[: len(rows)]
        for j in range(bits - 1, -1, -1):
            plane_sum[:] = 0
            for g in range(groups):
                np.take(table[g], rows[:, j, g], axis=0, out=looked_up, mode="clip")
                plane_sum += looked_up
            if j == bits - 1:
                np.negative(plane_sum, out=total)
            else:
                total += total
                total += plane_sum
    return out


def narrow(table, bits):
    """The table in 32 bits if no score can leave them."""
    largest = int(np.abs(table).max(initial=0)) * table.shape[0] << bits
    return table.astype(np.int32) if largest < 1 << 31 else table


def by_anchor(found):
    return np.ascontiguousarray(found.T, np.int64)


def first_rows(values, ids, n):
    """Places of the first `n` values, higher first, ties by smaller id."""
    if len(values) > n:
        kept = np.flatnonzero(values >= np.partition(values, len(values) - n)[len(values) - n])
    else:
        kept = np.arange(len(values))
    return kept[np.lexsort((ids[kept], -values[kept]))][:n]


class Best:
    """The first `n` rows of each of some searches, merged piece by piece."""

    def __init__(self, searches, n):
        self.n = n
        self.ids, self.scores = np.full((searches, n), NONE), np.full((searches, n), NONE)

    def least(self, at):
        """Score that a row must reach to be among the first."""
        return self.scores[at, -1]

    def add(self, at, ids, values):
        place = first_rows(values, ids, self.n)
        ids, values = np.append(self.ids[at], ids[place]), np.append(self.scores[at], values[place])
        place = np.lexsort((ids, -values))[: self.n]
        self.ids[at], self.scores[at] = ids[place], values[place]


def _rows(batches, scale):
    """(dim, ids, labels, integer vectors) of the usable rows of batches, per length."""
    for batch in batches:
        lengths = batch.column(1).value_lengths().to_numpy()
        values = np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64))
        starts = np.concatenate(([0], np.cumsum(lengths)))
        ids, labels = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            x = values[starts[rows][:, None] + np.arange(dim)]
            sound = (np.abs(x) <= LARGEST).all(axis=1)
            yield int(dim), ids[rows[sound]], labels[rows[sound]], x[sound].astype(np.int64)


def _pieces(batches, scale, size):
    """At most `size` rows of one length at a time."""
    held = {}
    for dim, *columns in _rows(batches, scale):
        parts = held.setdefault(dim, [])
        parts.append(columns)
        while sum(len(p[0]) for p in parts) >= size:
            whole = [np.concatenate(c) for c in zip(*parts)]
            yield dim, *[c[:size] for c in whole]
            parts[:] = [[c[size:] for c in whole]]
    for dim, parts in held.items():
        whole = [np.concatenate(c) for c in zip(*parts)]
        if len(whole[0]):
            yield dim, *whole


def _file(dim, path, rows, bits):
    return pa.RecordBatch.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([path]), pa.array([rows], pa.int64()), pa.array([bits], pa.int32())],
        ["dim", "path", "rows", "bits"],
    )


def _pack_candidates(folder, scale, size):
    def pack(batches):
        for dim, ids, labels, x in _pieces(batches, scale, size):
            order, bits = np.lexsort((ids, labels)), bits_of(x)
            planes = bit_planes(x[order], bits)
            yield _file(dim, save(folder, "piece", [ids[order], labels[order], planes]), len(ids), bits)

    return pack


def _pack_anchors(folder, scale, size):
    def pack(batches):
        for dim, ids, labels, x in _pieces(batches, scale, size):
            yield _file(dim, save(folder, "anchors", [ids, labels, x]), len(ids), 0)

    return pack


def _candidates(path, rows, bits, dim):
    groups = -(-dim // 8)
    ids, labels, planes = load(path, ("i8", "i8", f"V{bits * groups}" if groups else "V1"), rows) if groups else (*load(path, ("i8", "i8"), rows), None)
    planes = np.zeros((rows, 1, 0), np.uint8) if planes is None else planes.view(np.uint8).reshape(rows, bits, groups)
    return ids, labels, planes


def _anchors(path, rows, dim):
    ids, labels, *x = load(path, ("i8", "i8", f"V{8 * dim}") if dim else ("i8", "i8"), rows)
    x = x[0].view(np.int64).reshape(rows, dim) if x else np.zeros((rows, 0), np.int64)
    return ids, labels, x


class Round:
    """One round over the work list; blocks and wanted positives travel as file names."""

    def __init__(self, blocks, found):
        self.blocks, self.found = blocks, found

    def run(self, batches):
        block, state = None, None
        for batch in batches:
            for dim, path, rows, bits, number, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if number != block:
                    if state:
                        yield from state.answers()
                    anchors = _anchors(*self.blocks[number][:2], dim)
                    block, state = number, self.found(number, *anchors)
                ids, labels, planes = _candidates(path, rows, bits, dim)
                state.meet(ids, labels, planes)
        if state:
            yield from state.answers()


def _answer(columns):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "positive", "positive_score", "id", "score"])


class Positives:
    """First rows of the same label for the anchors of a block."""

    def __init__(self, n, ids, labels, x):
        self.ids, self.labels, self.table = ids, labels, subset_sums(x)
        self.best = Best(len(ids), n)

    def meet(self, ids, labels, planes):
        for label in np.unique(self.labels):
            low, high = np.searchsorted(labels, label, "left"), np.searchsorted(labels, label, "right")
            mine = np.flatnonzero(self.labels == label)
            if low == high:
                continue
            table = narrow(np.ascontiguousarray(self.table[:, :, mine]), planes.shape[1])
            found = by_anchor(scores(table, planes[low:high]))
            for at, values in zip(mine, found):
                near = (values >= self.best.least(at)) & (ids[low:high] != self.ids[at])
                self.best.add(at, ids[low:high][near], values[near])

    def answers(self):
        held = self.best.scores != NONE
        anchor = np.repeat(self.ids, held.sum(axis=1))
        none = np.zeros(len(anchor), np.int64)
        yield _answer([anchor, none, none, self.best.ids[held], self.best.scores[held]])


class Negatives:
    """First rows of other labels within the bounds of each positive of a block's anchors."""

    def __init__(self, n, low, high, wanted, ids, labels, x):
        self.ids, self.labels, self.table = ids, labels, subset_sums(x)
        self.anchor, self.positive, self.score = wanted
        self.low, self.high = -(-low * self.score // 100), high * self.score // 100
        self.best = Best(len(self.anchor), n)
        self.by_anchor = [np.flatnonzero(self.anchor == at) for at in range(len(ids))]

    def meet(self, ids, labels, planes):
        found = by_anchor(scores(narrow(self.table, planes.shape[1]), planes))
        for at, values in enumerate(found):
            if not len(self.by_anchor[at]):
                continue
            other = labels != self.labels[at]
            for search in self.by_anchor[at]:
                least = max(self.low[search], self.best.least(search))
                near = np.flatnonzero((values >= least) & (values <= self.high[search]) & other)
                if len(near):
                    self.best.add(search, ids[near], values[near])

    def answers(self):
        held = self.best.scores != NONE
        times = held.sum(axis=1)
        columns = [np.repeat(c, times) for c in (self.ids[self.anchor], self.positive, self.score)]
        yield _answer([*columns, self.best.ids[held], self.best.scores[held]])


def usable(df, id_col, vector_col, label_col):
    """Rows (id, vector, label) that take part, one per id."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("long").alias("label"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.filter("id is not null and vector is not null and label is not null").filter(F.forall("vector", sound))
    repeated = rows.groupBy("id").count().filter("count > 1").select("id")
    path = work_folder(df.sparkSession, "repeated-ids")
    repeated.write.parquet(path)
    repeated = df.sparkSession.read.parquet(path)
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return rows.join(repeated, "id", "left_anti").select("id", "vector", "label").union(one.select("id", "row.vector", "row.label"))


def _kept(df, name):
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _first(df, keys, n, order=("score", "id")):
    ranked = Window.partitionBy(*keys).orderBy(F.desc(order[0]), order[1])
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n)


def mine(
    df,
    anchors,
    id_col="vec_id",
    vector_col="embedding",
    label_col="label",
    scale=SCALE,
    positives=POSITIVES,
    negatives=NEGATIVES,
    low=LOW,
    high=HIGH,
):
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchors` is a condition on `id_col` that says which rows are anchors.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col, label_col)
    folder = work_folder(spark, "planes")
    pieces = _kept(rows.mapInArrow(_pack_candidates(folder, scale, PIECE_ROWS), FILES), "pieces")
    asked = rows.withColumnRenamed("id", id_col).filter(anchors).withColumnRenamed(id_col, "id")
    few = max(1, -(-asked.count() // (16 * BLOCK_ANCHORS)))
    blocks = asked.repartition(few).mapInArrow(_pack_anchors(folder, scale, BLOCK_ANCHORS), FILES)
    # One name per block of anchors, that is per tens of thousands of rows.
    blocks = [(row.path, row.rows, row.dim) for row in blocks.collect()]
    if not blocks:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    # About `SLOT_PIECES` pieces meet a block in a task, fewer if that leaves cores without work.
    many = max(1, pieces.count())
    slots = min(many, max(-(-many // SLOT_PIECES), -(-4 * spark.sparkContext.defaultParallelism // len(blocks))))

    def pair_up(batches):
        for batch in batches:
            for dim, path, rows, bits in zip(*(c.to_pylist() for c in batch.columns)):
                numbers = [b for b, (_, _, length) in enumerate(blocks) if length == dim]
                slot = crc32(path.encode()) % slots
                columns = {"dim": pa.int32(), "path": pa.string(), "rows": pa.int64(), "bits": pa.int32()}
                same = [pa.array([value] * len(numbers), kind) for value, kind in zip((dim, path, rows, bits), columns.values())]
                same += [pa.array(numbers, pa.int32()), pa.array([slot] * len(numbers), pa.int32())]
                yield pa.RecordBatch.from_arrays(same, [*columns, "block", "slot"])

    work = pieces.mapInArrow(pair_up, WORK).repartition(len(blocks) * slots, "block", "slot").sortWithinPartitions("block")

    def near(number, ids, labels, x):
        return Positives(positives, ids, labels, x)

    found = work.mapInArrow(Round(blocks, near).run, BEST)
    chosen = _first(found, ["anchor"], positives).select("anchor", "id", "score")
    # The positives of a block's anchors go to one file of a few rows per anchor.
    chosen = _kept(chosen.select("anchor", F.col("id").alias("positive"), "score"), "positives")
    wanted = _positive_files(chosen, blocks, folder, positives)

    def far(number, ids, labels, x):
        anchor, positive, score = load(wanted[number][0], ("i8", "i8", "i8"), wanted[number][1]) if number in wanted else [np.zeros(0, np.int64)] * 3
        order = np.argsort(ids, kind="stable")
        return Negatives(negatives, low, high, (order[np.searchsorted(ids[order], anchor)], positive, score), ids, labels, x)

    found = work.mapInArrow(Round(blocks, far).run, BEST)
    return _first(found, ["anchor", "positive"], negatives).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _positive_files(chosen, blocks, folder, positives):
    """File (path, rows) with the positives of each block's anchors."""
    spark = chosen.sparkSession
    listed = spark.createDataFrame([(b, path, rows, dim) for b, (path, rows, dim) in enumerate(blocks)], "block int, path string, rows long, dim int")

    def members(batches):
        for batch in batches:
            for block, path, rows, dim in zip(*(c.to_pylist() for c in batch.columns)):
                ids = _anchors(path, rows, dim)[0]
                yield pa.RecordBatch.from_pydict({"block": pa.array([block] * rows, pa.int32()), "anchor": pa.array(ids)})

    def write(batches):
        block, held = None, []
        for batch in batches:
            for number, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if number != block and held:
                    yield _positives_file(folder, block, held)
                    held = []
                block = number
                held.append(row)
        if held:
            yield _positives_file(folder, block, held)

    grouped = listed.mapInArrow(members, "block int, anchor long").join(chosen, "anchor").select("block", "anchor", "positive", "score")
    grouped = grouped.repartition(max(1, len(blocks) // 16), "block").sortWithinPartitions("block")
    return {row.block: (row.path, row.rows) for row in grouped.mapInArrow(write, "block int, path string, rows long").collect()}


def _positives_file(folder, block, rows):
    path = save(folder, "positives", list(np.array(rows, np.int64).T.copy()))
    return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "path": [path], "rows": pa.array([len(rows)], pa.int64())})
