"""Nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cells of `k` random Gaussian projections, each cut into steps of one width.
A neighbour at distance d lies on a projection at a normal offset of spread d from the query, so the
chance that it lies in a cell is known: the probability of a bucket is the product over the
projections. A query visits the buckets of each table in the order of that estimate until the
chances add up to `chance`; tables are independent, so a neighbour is missed by all of them with
chance (1 - chance) ** tables. Candidates of all tables are ranked by exact distance in double precision.

Fitting uses `SAMPLE` vectors, the first by hash: d is the 0.9 quantile of their distances to the
`top`-th neighbour among all rows. The number of projections follows from the number of rows, so
buckets hold a few rows at any size; up to `WHOLE_ROWS` rows there are none, and all rows are one bucket. Every row
is indexed.

Index rows and the probes of queries meet in blocks: a table's buckets are dealt to blocks by hash,
and a block with more rows than planned (a bucket with many copies) is cut further by the hash of the row,
with its probes repeated. The numbers of cuts are counted first, from the hashes alone, so vectors are shuffled once per
table and written nowhere. A task holds one piece of a block and streams the probes past it; it
returns at most `top` rows per query and piece.

d fits most queries, not all. A query that has found fewer than `top` rows, or whose `top`-th row lies beyond
d, where rows are missed more often, is unfinished: about one in ten is by the choice of d. Unfinished queries are compared
with all rows in blocks: files of at most `PIECE_ROWS` vectors and of at most `ASKED_ROWS` queries in the shared
folder, one pair of which a task holds at a time. So every query gets `top` rows, or all candidates if there are fewer.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without id. Vectors of other lengths than the query's are no candidates. Rows with the query's own id are
no candidates; an id that occurs more than once counts with its nearest vector, as query too. Ties go
to the smaller id. Queries without candidates have no rows. Other columns are ignored; empty tables give no rows.
"""

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import words as W
from tidemark.llm.arrays import load, save
from tidemark.session import work_folder

TABLES, CHANCE, WIDTH = 6, 0.42, 2.7
SAMPLE, SEED = 64, 20240601
WHOLE_ROWS, BLOCK_ROWS = 1024, 8192
PIECE_ROWS, ASKED_ROWS, SLOT_PIECES = 16384, 256, 16
FIRST_PROBES = 256
PIECE = "dim int, tbl int, slot int, cut int, kind int, id long, vector binary, codes binary"
COUNTS = "dim int, tbl int, slot int, n long"
FOUND = "query_id long, ids array<long>, scores array<double>"
FILES = "dim int, path string, rows long"
WORK = "dim int, path string, rows long, block int, slot int"


class Projections:
    """Hash functions of all tables for vectors of one length."""

    def __init__(self, dim, k, tables, width):
        self.k, self.width = k, width
        random = [np.random.default_rng([SEED, dim, t]) for t in range(tables)]
        self.axes = [r.standard_normal((dim, k)) for r in random]
        self.shifts = [r.uniform(0, width, k) for r in random]

    def places(self, table, vectors):
        return vectors @ self.axes[table] + self.shifts[table]

    def cells(self, places):
        return np.floor(places / self.width).astype(np.int64)

    @staticmethod
    def codes(cells):
        """64-bit names of buckets."""
        code = np.zeros(len(cells), np.uint64)
        for column in cells.T:
            code = W.chain(code, column.astype(np.uint64))
        return code

    def probes(self, place, distance, chance):
        """Cells of the likeliest buckets of one query, best first, until their chances add up."""
        if not len(place):
            return np.zeros((1, 0), np.int64)
        steps = np.arange(-3, 4)
        low = ((np.floor(place / self.width)[:, None] + steps) * self.width - place[:, None]) / distance
        log_p = np.log(np.maximum(_normal(low + self.width / distance) - _normal(low), 1e-30))
        likely = [np.flatnonzero(row > math.log(1e-5)) for row in log_p]
        most = FIRST_PROBES
        while True:
            # The best `most` products of k factors extend the best `most` products of k - 1 factors.
            total, cells = np.zeros(1), np.zeros((1, 0), np.int64)
            for row, options in zip(log_p, likely):
                sums = (total[:, None] + row[options]).ravel()
                keep = np.argpartition(-sums, most - 1)[:most] if len(sums) > most else np.arange(len(sums))
                total = sums[keep]
                cells = np.column_stack([cells[keep // len(options)], steps[options[keep % len(options)]]])
            order = np.argsort(-total, kind="stable")
            reached = np.cumsum(np.exp(total[order]))
            if reached[-1] >= chance or len(total) < most:
                return np.floor(place / self.width).astype(np.int64) + cells[order[: np.searchsorted(reached, chance) + 1]]
            most *= 4


def _normal(z):
    """Distribution function of the normal distribution."""
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(z / math.sqrt(2)))


def _by_length(batch, dtype):
    """(ids, vectors) of the rows of a batch, per length of vector."""
    lengths = batch.column(1).value_lengths().to_numpy()
    values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(dtype)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    ids = batch.column(0).to_numpy()
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield int(dim), ids[rows], values[starts[rows][:, None] + np.arange(dim)]


def _slots(codes, blocks):
    return (W.mix(codes) % np.uint64(blocks)).astype(np.int32)


def _names(schema):
    return schema.replace(",", "").split()[::2]


def _pieces(dim, table, slots, cuts, kind, ids, vectors, codes):
    n = len(ids)
    columns = [np.full(n, dim, np.int32), np.full(n, table, np.int32), slots, cuts, np.full(n, kind, np.int32), ids]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(vectors, pa.binary()), pa.array(codes, pa.binary())], _names(PIECE))


class Search:
    """Parameters of one index; small, so it travels with functions. `cuts` names the file of blocks in several pieces."""

    def __init__(self, k, tables, distance, chance, blocks, top, dtype):
        self.k, self.tables, self.distance, self.chance = k, tables, distance, chance
        self.blocks, self.top, self.dtype, self.cuts = blocks, top, dtype, None

    def functions(self, dim):
        return Projections(dim, self.k, self.tables, WIDTH * self.distance)

    def slots(self, hashes, table, vectors):
        """Buckets and blocks of vectors."""
        codes = hashes.codes(hashes.cells(hashes.places(table, vectors.astype(float))))
        return codes, _slots(codes, self.blocks)

    def counts(self, batches):
        """Rows per block."""
        for batch in batches:
            for dim, _, vectors in _by_length(batch, self.dtype):
                hashes = self.functions(dim)
                for table in range(self.tables):
                    found, n = np.unique(self.slots(hashes, table, vectors)[1], return_counts=True)
                    columns = [np.full(len(n), dim, np.int32), np.full(len(n), table, np.int32), found, n.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], _names(COUNTS))

    def cut_finder(self):
        """Function of (dim, table, slots) that gives the numbers of pieces of blocks."""
        names, numbers = load(*self.cuts) if self.cuts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

        def find(dim, table, slots):
            if not len(names):
                return np.ones(len(slots), np.int64)
            wanted = _block_names(dim, table, slots)
            at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
            return np.where(names[at] == wanted, numbers[at], 1)

        return find

    def index_rows(self, batches):
        cuts_of = self.cut_finder()
        for batch in batches:
            for dim, ids, vectors in _by_length(batch, self.dtype):
                hashes = self.functions(dim)
                data = [v.tobytes() for v in vectors]
                for table in range(self.tables):
                    codes, slots = self.slots(hashes, table, vectors)
                    of = cuts_of(dim, table, slots).astype(np.uint64)
                    # By place in the batch too, so that repeated ids are spread as well.
                    mark = W.chain(ids.astype(np.uint64), np.arange(len(ids), dtype=np.uint64))
                    cuts = (W.mix(mark) % of).astype(np.int32)
                    yield _pieces(dim, table, slots, cuts, 0, ids, data, [c.tobytes() for c in codes])

    def probe_rows(self, batches):
        cuts_of = self.cut_finder()
        for batch in batches:
            for dim, ids, vectors in _by_length(batch, self.dtype):
                hashes = self.functions(dim)
                for table in range(self.tables):
                    places = hashes.places(table, vectors.astype(float))
                    for key, vector, place in zip(ids, vectors, places):
                        codes = np.sort(hashes.codes(hashes.probes(place, self.distance, self.chance)))
                        slots = _slots(codes, self.blocks)
                        order = np.argsort(slots, kind="stable")
                        found, starts = np.unique(slots[order], return_index=True)
                        parts = [p.tobytes() for p in np.split(codes[order], starts[1:])]
                        times = cuts_of(dim, table, found)
                        at = np.repeat(np.arange(len(found)), times)
                        cuts = np.concatenate([np.arange(n, dtype=np.int32) for n in times])
                        n = len(at)
                        yield _pieces(dim, table, found[at], cuts, 1, np.full(n, key), [vector.tobytes()] * n, [parts[i] for i in at])

    def answer(self, batches):
        """Best candidates per query and piece, from pieces whose index rows come first."""
        key, held, index = None, [], None
        for batch in batches:
            rows = {"query_id": [], "ids": [], "scores": []}
            for *piece, kind, name, vector, codes in zip(*(c.to_pylist() for c in batch.columns)):
                if piece != key:
                    key, held, index = piece, [], None
                if kind == 0:
                    held.append((codes, name, vector))
                elif held or index:
                    index = index or _sorted_index(held, self.dtype)
                    held = []
                    ids, scores = nearest(index, name, np.frombuffer(vector, self.dtype), np.frombuffer(codes, np.uint64), self.top)
                    if len(ids):
                        rows["query_id"].append(name)
                        rows["ids"].append(ids)
                        rows["scores"].append(scores)
            yield _found(rows)


def _found(rows):
    schema = pa.schema([("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])
    return pa.RecordBatch.from_pydict(rows, schema)


def _block_names(dim, table, slots):
    return W.chain(np.full(len(slots), dim << 8 | table, np.uint64), np.asarray(slots).astype(np.uint64))


def _write_cuts(folder, rows):
    """Function that writes the numbers of pieces of the blocks of more than `rows` rows."""

    def write(batches):
        names, numbers = [], []
        for batch in batches:
            for dim, table, slot, n in zip(*(c.to_pylist() for c in batch.columns)):
                names.append(_block_names(dim, table, [slot])[0])
                numbers.append(-(-n // rows))
        if names:
            order = np.argsort(names)
            path = save(folder, "cuts", [np.array(names, np.uint64)[order], np.array(numbers, np.int64)[order]])
            yield pa.RecordBatch.from_pydict({"path": [path], "rows": pa.array([len(names)], pa.int64())})

    return write


def _sorted_index(rows, dtype):
    codes = np.frombuffer(b"".join(r[0] for r in rows), np.uint64)
    order = np.argsort(codes, kind="stable")
    vectors = np.frombuffer(b"".join(r[2] for r in rows), dtype).reshape(len(rows), -1)
    return codes[order], np.array([r[1] for r in rows], np.int64)[order], vectors[order].astype(float)


def nearest(index, own, vector, probes, top):
    """Ids and exact distances of the `top` nearest rows of the probed buckets."""
    codes, ids, vectors = index
    low, high = np.searchsorted(codes, probes, "left"), np.searchsorted(codes, probes, "right")
    hit = high > low
    at = np.concatenate([np.arange(a, b) for a, b in zip(low[hit], high[hit])]) if hit.any() else np.zeros(0, np.int64)
    at = at[ids[at] != own]
    if not len(at):
        return [], []
    scores = np.sqrt(np.square(vectors[at] - vector.astype(float)).sum(axis=1))
    return first_ids(ids[at], scores, top)


def first_ids(ids, scores, top):
    """The `top` nearest ids and their distances, ties by smaller id."""
    best = np.lexsort((ids, scores))
    # An id that occurs more than once counts once, so that it takes no other's place.
    _, first = np.unique(ids[best], return_index=True)
    best = best[np.sort(first)][:top]
    return ids[best].tolist(), scores[best].tolist()


def usable(df, id_col, vector_col):
    """Rows (id, vector) that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.filter("id is not null and vector is not null").filter(F.forall("vector", sound) & F.exists("vector", lambda x: x != 0))


def _sample_distances(top, dtype, sample):
    def distances(batches):
        for batch in batches:
            for dim, ids, vectors in _by_length(batch, dtype):
                for name, vector in sample:
                    if len(vector) == dim:
                        index = np.zeros(len(ids), np.uint64), ids, vectors.astype(float)
                        _, scores = nearest(index, name, np.array(vector), np.zeros(1, np.uint64), top)
                        if scores:
                            yield pa.RecordBatch.from_pydict({"id": [name] * len(scores), "score": scores})

    return distances


def _packer(folder, name, size, dtype):
    """Function that writes files of at most `size` vectors of one length, in double precision."""

    def pack(batches):
        held = {}
        for batch in batches:
            for dim, ids, vectors in _by_length(batch, dtype):
                parts = held.setdefault(dim, [])
                parts.append((ids, vectors.astype(float)))
                while sum(len(p[0]) for p in parts) >= size:
                    whole = [np.concatenate(c) for c in zip(*parts)]
                    yield write(dim, *[c[:size] for c in whole])
                    parts[:] = [tuple(c[size:] for c in whole)]
        for dim, parts in held.items():
            whole = [np.concatenate(c) for c in zip(*parts)]
            if len(whole[0]):
                yield write(dim, *whole)

    def write(dim, ids, vectors):
        columns = {"dim": pa.array([dim], pa.int32()), "path": [save(folder, name, [ids, vectors])], "rows": pa.array([len(ids)], pa.int64())}
        return pa.RecordBatch.from_pydict(columns)

    return pack


def _vectors(path, rows, dim):
    ids, x = load(path, ("i8", f"V{8 * dim}"), rows)
    return ids, x.view(np.float64).reshape(rows, dim)


def compare(asked, rows, top):
    """(query, ids, distances) of the `top` nearest of all rows, for two files of (ids, vectors)."""
    sizes = np.square(rows[1]).sum(axis=1)
    for name, vector in zip(*asked):
        # Rough squares decide who is measured exactly; the margin covers their rounding.
        own = np.square(vector).sum()
        rough = sizes - 2 * (rows[1] @ vector) + own
        rough[rows[0] == name] = np.inf
        if len(rough) > 8 * top:
            # Repeated ids take places among the nearest rows: as many more have to be looked at.
            ids = len(rough) - len(np.unique(rows[0]))
            place = min(top + ids, len(rough) - 1)
            near = np.flatnonzero(rough <= np.partition(rough, place)[place] + 1e-9 * (sizes.max() + own))
        else:
            near = np.arange(len(rough))
        near = near[rows[0][near] != name]
        if len(near):
            yield int(name), *first_ids(rows[0][near], np.sqrt(np.square(rows[1][near] - vector).sum(axis=1)), top)


def _compare_all(rows, asked, top):
    """Rows of FOUND for all queries against all rows, block by block."""
    spark = rows.sparkSession
    folder, dtype = work_folder(spark, "vectors"), np.float64
    few = max(1, -(-asked.count() // (16 * ASKED_ROWS)))
    blocks = asked.repartition(few).mapInArrow(_packer(folder, "asked", ASKED_ROWS, dtype), FILES).collect()
    # One name per block of queries, that is per tens of thousands of rows.
    blocks = [(row.path, row.rows, row.dim) for row in blocks]
    path = work_folder(spark, "pieces")
    rows.mapInArrow(_packer(folder, "rows", PIECE_ROWS, dtype), FILES).write.parquet(path)
    pieces = spark.read.parquet(path)
    many = max(1, pieces.count())
    slots = min(many, max(-(-many // SLOT_PIECES), -(-4 * spark.sparkContext.defaultParallelism // max(1, len(blocks)))))

    def pair_up(batches):
        for batch in batches:
            for dim, path, n in zip(*(c.to_pylist() for c in batch.columns)):
                numbers = [b for b, (_, _, length) in enumerate(blocks) if length == dim]
                kinds = {"dim": pa.int32(), "path": pa.string(), "rows": pa.int64()}
                same = [pa.array([value] * len(numbers), kind) for value, kind in zip((dim, path, n), kinds.values())]
                same += [pa.array(numbers, pa.int32()), pa.array([crc32(path.encode()) % slots] * len(numbers), pa.int32())]
                yield pa.RecordBatch.from_arrays(same, [*kinds, "block", "slot"])

    def meet(batches):
        for batch in batches:
            for dim, path, n, block, _ in zip(*(c.to_pylist() for c in batch.columns)):
                found = list(compare(_vectors(*blocks[block][:2], dim), _vectors(path, n, dim), top))
                if found:
                    yield _found(dict(zip(("query_id", "ids", "scores"), map(list, zip(*found)))))

    work = pieces.mapInArrow(pair_up, WORK).repartition(max(1, len(blocks)) * slots, "block", "slot").sortWithinPartitions("block")
    return work.mapInArrow(meet, FOUND)


def _best(found, top):
    """Rows (query_id, rank, id, score) from rows of FOUND."""
    found = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    found = found.groupBy("query_id", F.col("x.ids").alias("id")).agg(F.min("x.scores").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(df, queries, id_col="vec_id", vector_col="embedding", top=10, tables=TABLES, chance=CHANCE):
    """Rows (query_id, rank, id, score) of the `top` nearest rows found for every query."""
    spark = df.sparkSession
    rows, asked = usable(df, id_col, vector_col), usable(queries, id_col, vector_col)
    dtype = np.float32 if dict(df.dtypes)[vector_col] == "array<float>" else np.float64
    n = rows.count()
    sample = [(row.id, row.vector) for row in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()]
    found = rows.mapInArrow(_sample_distances(top, dtype, sample), "id long, score double")
    within = Window.partitionBy("id").orderBy("score")
    last = found.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= top).groupBy("id").agg(F.max("score").alias("score"))
    distances = [row.score for row in last.collect()]
    distance = max(float(np.quantile(distances, 0.9)) if distances else 1.0, 1e-12)
    k = max(2, math.ceil(math.log2(n))) if n > WHOLE_ROWS else 0
    plan = Search(k, tables if k else 1, distance, chance, max(1, -(-n // BLOCK_ROWS)), top, dtype)

    place = ["dim", "tbl", "slot"]
    counts = rows.mapInArrow(plan.counts, COUNTS).groupBy(*place).agg(F.sum("n").alias("n")).filter(F.col("n") > 2 * BLOCK_ROWS)
    # Blocks of more than twice the planned rows: at most one for `BLOCK_ROWS` rows of the tables, 16 bytes each.
    files = counts.coalesce(1).mapInArrow(_write_cuts(work_folder(spark, "cuts"), 2 * BLOCK_ROWS), "path string, rows long").collect()
    plan.cuts = (files[0].path, ("u8", "i8"), files[0].rows) if files else None
    pieces = rows.mapInArrow(plan.index_rows, PIECE).union(asked.mapInArrow(plan.probe_rows, PIECE))
    pieces = pieces.repartition(*place, "cut").sortWithinPartitions(*place, "cut", "kind")
    path = work_folder(spark, "found")
    _best(pieces.mapInArrow(plan.answer, FOUND), top).write.parquet(path)
    best = spark.read.parquet(path)

    done = best.groupBy("query_id").agg(F.count("*").alias("n"), F.max("score").alias("last")).filter((F.col("n") == top) & (F.col("last") <= distance))
    path = work_folder(spark, "unfinished")
    asked.join(done, F.col("id") == F.col("query_id"), "left_anti").write.parquet(path)
    unfinished = spark.read.parquet(path) if k else asked.limit(0)
    if not unfinished.isEmpty():
        exact = _best(_compare_all(rows, unfinished, top), top)
        best = best.join(done, "query_id", "left_semi").select(exact.columns).union(exact)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
