"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A table rotates a unit vector by three rounds of random signs and a fast Hadamard transform and names the
nearest vertex of the cross-polytope: the coordinate of largest size and its sign. `k` such rotations
together name a bucket; k follows from the number of rows, so that buckets keep a bounded mean size. A row lies
in its own bucket of every table, and visits further ones in the order of the squared gaps between the largest
coordinate and the others, as a neighbour's largest coordinate is likeliest there: all within `REACH` of the
spread that a neighbour at the threshold has, at most `PROBES`. Two rows meet if either visits the other's
bucket. The chance of that at the threshold is measured on random pairs of fixed seeds, and
`tables` grows until a link is missed with a chance of at most `MISS`.

1. Equal vectors are one class from the start, named after its smallest id; only classes are hashed.
2. Rows of a bucket are dealt to cuts of at most about `CUT_ROWS` rows by hash; most buckets have one cut. A task
   reads one cut at a time. The cuts of larger buckets are written to files in the shared folder, each
   vector once, and a work list of pairs of cuts names what has to be compared.
3. Within a cut, or a pair of them, cosines come from products of blocks in double precision. A pair counts in
   the first table where its rows meet, and there in the smaller bucket, which follows from the
   two vectors alone. So links are counted once without listing pairs: a task returns one count per row, and
   at most one link per row that keeps the groups of the cut together.
4. Counts are summed, and links become components by repeated minimum labels.

A group of m different vectors that are all near each other costs m * m products, spread over pairs of cuts; copies
of one vector cost nothing beyond the first.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing: no links, their own
component, kept. Rows with a null id link with nothing and have a null component. Vectors of different lengths
link with nothing. An id that occurs more than once is several rows; its component is the smallest reachable id, and
rows of equal vectors link even if their ids are equal. An empty table gives an empty result. Other
columns are ignored.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.arrays import load, save
from tidemark.llm.near_dup import components
from tidemark.session import work_folder

LEAST = 0.95
MISS, PROBES, REACH = 1e-3, 8, 2.2
SEED, MEAN_ROWS, CUT_ROWS, CUT_BYTES, CHUNK_PAIRS, HOT = 20240701, 4096, 32768, 64 << 20, 1 << 19, 100_000
MEMBER = "tbl int, code long, cut int, class long, copies long, own boolean, vector binary"
FOUND = "a long, b long, n long, tbl int, code long, path string, rows long, dim int"


def unit(x):
    """Rows of length one, in double precision."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))


def hadamard(x):
    """Fast Hadamard transform of every row, scaled to keep lengths; their size is a power of two."""
    n, half = x.shape[1], 1
    x = x.copy()
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / math.sqrt(n)


class Polytopes:
    """Hash functions of all tables for unit vectors of one length."""

    def __init__(self, dim, k, tables, least):
        self.size, self.k, self.tables, self.dim = 1 << (dim - 1).bit_length() if dim > 1 else 1, k, tables, dim
        signs = [np.random.default_rng([SEED, dim, t, j]).choice([-1.0, 1.0], (3, self.size)) for t in range(tables) for j in range(k)]
        self.signs = np.array(signs).reshape(tables, k, 3, self.size)
        # Spread of the difference of two coordinates of a neighbour at the threshold.
        self.spread = math.sqrt(2 * (1 - least**2) / self.size) / least

    def codes(self, table, x):
        """Buckets (rows, 1 + probes) in the order of visits, own bucket first; unvisited ones are 0."""
        gaps, names = np.zeros((len(x), 1)), np.full((len(x), 1), W.mix(np.uint64([self.dim << 8 | table]))[0])
        padded = np.pad(x, ((0, 0), (0, self.size - x.shape[1])))
        for signs in self.signs[table]:
            y = padded
            for flips in signs:
                y = hadamard(y * flips)
            both = np.concatenate([y, -y], axis=1)
            most = min(1 + PROBES, both.shape[1])
            best = np.argpartition(-both, most - 1, axis=1)[:, :most] if most < both.shape[1] else np.tile(np.arange(most), (len(x), 1))
            size = np.take_along_axis(both, best, axis=1)
            order = np.lexsort((best, -size), axis=1)
            best, size = np.take_along_axis(best, order, axis=1), np.take_along_axis(size, order, axis=1)
            gap = np.square((size[:, :1] - size) / self.spread)
            gaps = (gaps[:, :, None] + gap[:, None, :]).reshape(len(x), -1)
            names = W.chain(names[:, :, None], best[:, None, :].astype(np.uint64)).reshape(len(x), -1)
            order = np.argsort(gaps, axis=1, kind="stable")[:, : 1 + PROBES]
            gaps, names = np.take_along_axis(gaps, order, axis=1), np.take_along_axis(names, order, axis=1)
        names = np.where(names == 0, np.uint64(1), names)
        return np.where(gaps <= REACH**2, names, np.uint64(0))


def meet(a, b):
    """Whether rows with buckets `a` and `b` of one table meet: either visits the other's own."""
    return (a[:, :1] == b).any(axis=1) | (b[:, :1] == a).any(axis=1)


def functions_for(dim, rows, least=LEAST, miss=MISS, mean_rows=MEAN_ROWS):
    """Hash functions for a number of rows; tables until links at the threshold are missed rarely enough."""
    size = 1 << (dim - 1).bit_length() if dim > 1 else 1
    k = max(1, math.ceil(math.log(max(rows / mean_rows, 1)) / math.log(2 * size)))
    random = np.random.default_rng([SEED, dim])
    x = unit(random.standard_normal((4096, dim)))
    if dim == 1:
        y = x
    else:
        side = random.standard_normal((4096, dim))
        y = least * x + math.sqrt(1 - least**2) * unit(side - (side * x).sum(axis=1, keepdims=True) * x)
    tables, missed = 0, np.ones(len(x), bool)
    while not tables or missed.mean() > miss:
        tables += 1
        hashes = Polytopes(dim, k, tables, least)
        missed &= ~meet(hashes.codes(tables - 1, x), hashes.codes(tables - 1, y))
    return hashes


def _by_length(batch):
    """(places, vectors in double precision) of the rows of a batch, per length."""
    lengths = batch.column(1).value_lengths().to_numpy()
    values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, values[starts[rows][:, None] + np.arange(dim)]


def _named(batches):
    """Rows (id, class, vector) of a batch; negative zeros count as zeros."""
    for batch in batches:
        for rows, x in _by_length(batch):
            data = [v.tobytes() for v in np.ascontiguousarray(x + 0.0)]
            names = [hashlib.blake2b(v, digest_size=16).digest() for v in data]
            ids = batch.column(0).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.binary()), pa.array(data, pa.binary())], ["id", "name", "vector"])


class Index:
    """Hash functions per length of vector, the kind of number in their bytes, and the cuts of large buckets."""

    def __init__(self, hashes, dtype, least):
        self.hashes, self.dtype, self.least, self.large = hashes, dtype, least, None

    def vectors(self, data, dim):
        return unit(np.frombuffer(b"".join(data), self.dtype).reshape(-1, dim).astype(np.float64))

    def buckets(self, batches):
        """Rows (code, dim) of the buckets that every class is in."""
        for batch in batches:
            for dim, rows, codes in self.coded(batch):
                for table in codes:
                    seen = table[table != 0]
                    yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(np.full(len(seen), dim, np.int32))], ["code", "dim"])

    def coded(self, batch):
        """(dim, places, codes per table) of the classes (name, copies, vector) of a batch."""
        data = batch.column(2).to_pylist()
        dims = np.array([len(v) for v in data]) // np.dtype(self.dtype).itemsize
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            x = self.vectors([data[i] for i in rows], dim)
            yield int(dim), rows, [self.hashes[int(dim)].codes(t, x) for t in range(self.hashes[int(dim)].tables)]

    def members(self, batches):
        """Rows of MEMBER: every class in its buckets of all tables."""
        large, cuts = load(*self.large) if self.large else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            names = batch.column(0).to_numpy()
            for _, rows, codes in self.coded(batch):
                for table, code in enumerate(codes):
                    row, visit = np.nonzero(code)
                    found = code[row, visit].view(np.int64)
                    at = np.minimum(np.searchsorted(large, found), max(len(large) - 1, 0))
                    of = np.where(large[at] == found, cuts[at], 1) if len(large) else np.ones(len(found), np.int64)
                    cut = (W.mix(names[rows[row]].astype(np.uint64)) % of.astype(np.uint64)).astype(np.int32)
                    take = lambda i: batch.column(i).take(pa.array(rows[row]))  # noqa: E731, B023
                    columns = [pa.array(np.full(len(row), table, np.int32)), pa.array(found), pa.array(cut), take(0), take(1), pa.array(visit == 0), take(2)]
                    yield pa.RecordBatch.from_arrays(columns, ["tbl", "code", "cut", "class", "copies", "own", "vector"])

    def first_round(self, folder):
        """Rows of FOUND from the sorted rows of MEMBER: each cut within itself, and files of the cuts of large buckets."""

        def run(batches):
            large = load(*self.large)[0] if self.large else np.zeros(0, np.int64)
            for (table, code, _, size), block in cuts_of(batches):
                dim = size // np.dtype(self.dtype).itemsize
                block = Block(block, self.vectors(block["vector"], dim), self.hashes[dim], table)
                yield from compare(block, block, code, self.least)
                at = np.searchsorted(large, code)
                if at < len(large) and large[at] == code:
                    path = save(folder, "cut", [block.ids, block.copies, block.own, block.x])
                    yield _found(tbl=[table], code=[code], path=[path], rows=[len(block.ids)], dim=[dim])

        return run

    def second_round(self, batches):
        """Rows of FOUND from rows (table, code, dim, path, rows, other path, other rows): pairs of cuts of a bucket."""
        for batch in batches:
            for table, code, dim, *files in zip(*(c.to_pylist() for c in batch.columns)):
                blocks = []
                for path, rows in (files[:2], files[2:]):
                    ids, copies, own, x = load(path, ("i8", "i8", "?", f"V{8 * dim}"), rows)
                    held = {"class": ids, "copies": copies, "own": own}
                    blocks.append(Block(held, x.view(np.float64).reshape(rows, dim), self.hashes[dim], table))
                yield from compare(*blocks, code, self.least)


class Block:
    """Rows of a cut with their buckets in the tables up to its own."""

    def __init__(self, rows, x, hashes, table):
        self.ids, self.copies = np.array(rows["class"], np.int64), np.array(rows["copies"], np.int64)
        self.own, self.x = np.array(rows["own"], bool), x
        self.codes = [hashes.codes(t, x) for t in range(table + 1)]


def cuts_of(batches):
    """((table, code, cut, bytes of a vector), columns) of sorted rows of MEMBER, cut by cut."""
    key, held = None, None
    for batch in batches:
        for table, code, cut, *values in zip(*(c.to_pylist() for c in batch.columns)):
            row_key = table, code, cut, len(values[-1])
            if row_key != key:
                if held:
                    yield key, dict(zip(("class", "copies", "own", "vector"), held))
                key, held = row_key, [[], [], [], []]
            for column, value in zip(held, values):
                column.append(value)
    if held:
        yield key, dict(zip(("class", "copies", "own", "vector"), held))


def _found(**columns):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("tbl", pa.int32()), ("code", pa.int64()), ("path", pa.string()), ("rows", pa.int64()), ("dim", pa.int32())])
    rows = max(len(c) for c in columns.values())
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * rows), f.type) for f in schema], schema=schema)


def compare(a, b, code, least):
    """Counts and links of the pairs of two blocks that count in bucket `code`; a block and itself give each pair once."""
    same = a is b
    counts = [np.zeros(len(a.ids), np.int64)] * 2 if same else [np.zeros(len(x.ids), np.int64) for x in (a, b)]
    label = np.arange(len(a.ids)), np.arange(len(b.ids)) if same else len(a.ids) + np.arange(len(b.ids))
    groups = Labels(len(a.ids) + (0 if same else len(b.ids)))
    step = max(1, CHUNK_PAIRS // max(1, len(b.ids)))
    for at in range(0, len(a.ids), step):
        near = a.x[at : at + step] @ b.x.T >= least
        near &= a.own[at : at + step, None] | b.own
        if same:
            near &= np.arange(at, min(at + step, len(a.ids)))[:, None] < np.arange(len(b.ids))
        i, j = np.nonzero(near)
        i += at
        if not len(i):
            continue
        for table, (mine, other) in enumerate(zip(a.codes, b.codes)):
            if table < len(a.codes) - 1:
                kept = ~meet(mine[i], other[j])
            else:
                # Where both visit each other, the pair meets in both own buckets: the smaller one counts.
                x, y = mine[i], other[j]
                both = (x[:, :1] == y).any(axis=1) & (y[:, :1] == x).any(axis=1)
                first = np.minimum(x[:, 0], y[:, 0]) == np.int64(code).astype(np.uint64)
                kept = ~both | first
            i, j = i[kept], j[kept]
        np.add.at(counts[0], i, b.copies[j])
        np.add.at(counts[1], j, a.copies[i])
        groups.join(label[0][i], label[1][j])
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    total = counts[0] if same else np.concatenate(counts)
    rows = np.flatnonzero(total)
    if len(rows):
        yield _found(a=ids[rows], b=ids[groups.tops()[rows]], n=total[rows])


class Labels:
    """Groups of numbered rows, joined by arrays of pairs."""

    def __init__(self, n):
        self.label = np.arange(n)

    def join(self, x, y):
        while True:
            low = np.minimum(self.label[x], self.label[y])
            moved = self.label.copy()
            np.minimum.at(moved, x, low)
            np.minimum.at(moved, y, low)
            # Whole groups move, not only the rows of these pairs.
            np.minimum.at(moved, self.label[x], low)
            np.minimum.at(moved, self.label[y], low)
            moved = moved[moved]
            if (moved == self.label).all():
                return
            self.label = moved

    def tops(self):
        while True:
            above = self.label[self.label]
            if (above == self.label).all():
                return above
            self.label = above


def _kept(df, name):
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _write_large(folder):
    def write(batches):
        rows = [np.stack([c.to_numpy() for c in batch.columns]) for batch in batches if batch.num_rows]
        if rows:
            codes, cuts = np.concatenate(rows, axis=1)
            order = np.argsort(codes)
            path = save(folder, "large", [codes[order], cuts[order]])
            yield pa.RecordBatch.from_pydict({"path": [path], "rows": pa.array([len(codes)], pa.int64())})

    return write


def near_duplicates(df, id_col="vec_id", vector_col="embedding", least=LEAST, miss=MISS, mean_rows=MEAN_ROWS):
    """Rows (id, n_links, component_id, kept) of all vectors; links are pairs with a cosine of at least `least`."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    dtype = np.float32 if dict(df.dtypes)[vector_col] == "array<float>" else np.float64
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", sound) & F.exists("vector", lambda x: x != 0)
    named = rows.filter(usable).mapInArrow(_named, "id long, name binary, vector binary")
    grouped = named.groupBy("name").agg(F.min("id").alias("class"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    classes = _kept(grouped, "classes")

    # One hash function per length; lengths are few.
    lengths = classes.groupBy(F.octet_length("vector").alias("size")).count().collect()
    width = np.dtype(dtype).itemsize
    index = Index({r["size"] // width: functions_for(r["size"] // width, r["count"], least, miss, mean_rows) for r in lengths}, dtype, least)
    hashed = classes.select("class", "copies", "vector")
    most = F.least(F.lit(CUT_ROWS), F.greatest(F.lit(1), F.floor(F.lit(CUT_BYTES) / (8 * F.col("dim")))))
    buckets = hashed.mapInArrow(index.buckets, "code long, dim int").groupBy("code").agg(F.count("*").alias("n"), F.max("dim").alias("dim"))
    large = buckets.filter(F.col("n") > most).select("code", F.ceil(F.col("n") / most).cast("long").alias("cuts"))
    folder = work_folder(spark, "cuts")
    # Buckets of more than `CUT_ROWS` rows: at most 1 / `CUT_ROWS` of the rows that buckets hold, 16 bytes each.
    files = large.coalesce(1).mapInArrow(_write_large(folder), "path string, rows long").collect()
    index.large = (files[0].path, ("i8", "i8"), files[0].rows) if files else None

    members = hashed.mapInArrow(index.members, MEMBER).repartition("tbl", "code", "cut").sortWithinPartitions("tbl", "code", "cut")
    found = _kept(members.mapInArrow(index.first_round(folder), FOUND), "cuts-found")
    links = found.filter("n is not null").select("a", "b", "n")
    if index.large:
        cuts = found.filter("path is not null").select("tbl", "code", "dim", "path", "rows")
        pairs = cuts.join(cuts.select("tbl", "code", F.col("path").alias("other"), F.col("rows").alias("more")), ["tbl", "code"])
        pairs = _kept(pairs.filter("path < other").select("tbl", "code", "dim", "path", "rows", "other", "more"), "cut-pairs")
        pairs = pairs.repartition("path", "other").mapInArrow(index.second_round, FOUND)
        links = links.union(_kept(pairs.select("a", "b", "n"), "pairs-found"))

    counts = links.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    labels = components(links.filter("a <> b").select("a", "b"))
    groups = classes.select("name", "class", "copies").join(counts, "class", "left").join(labels, F.col("class") == F.col("node"), "left")
    links_of = (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
    groups = _kept(groups.select("name", "copies", links_of, F.coalesce("label", "class").alias("component")), "groups")
    # Classes with more than `HOT` copies: at most 1 / `HOT` of the rows. Their rows are not shuffled by class.
    hot, keys = groups.filter(F.col("copies") > HOT), named.select("id", "name")
    cold = keys.join(F.broadcast(hot.select("name")), "name", "left_anti").join(groups.filter(F.col("copies") <= HOT), "name")
    linked = keys.join(F.broadcast(hot), "name").union(cold.select("name", "id", "copies", "n_links", "component"))
    linked = linked.select("id", "n_links", "component")
    alone = rows.filter(~F.coalesce(usable, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.union(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
