"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `virtual_nodes` points of a ring. A row falls on the arc that starts at the
hash of its group (rows with equal text fall together) and goes to the arc's owner. A shard
takes no more than its bound; rows beyond it go on clockwise to the next shard with room.
With `load_factor=1` the bounds are the row count divided evenly, so shards differ by one row
at most; a larger factor moves fewer rows when the number of shards changes.

Which row overflows depends only on the order (arc, slice of the hash of the id, position,
id), never on partitions. The driver sees row counts of arcs and slices only: at most
`2 * arcs + SLICES` numbers however large the table is. A hot group is cut into slices by the
hash of its ids, so no task ranks more than about 1 / SLICES of the rows.

Null text: no bytes, its own group. Null ids: one more id value. Repeated rows are rows like any
other; two rows that agree in id and text may swap places, which leaves the result the same.
An empty table gives an empty result. Other columns are ignored.
"""

from bisect import bisect_right
from zlib import crc32

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import work_folder

SLICES = 4096
RING = 1 << 32
CELL_BITS = 22


def ring(shards, virtual_nodes=64):
    """Arcs in clockwise order as (start, shard); a shard's points do not depend on the number of shards."""
    points = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            points.setdefault(crc32(f"node {node} of shard {shard}".encode()), shard)
    return sorted(points.items())


def ring_cells(arcs):
    """Arcs cut at equal steps of the ring, as (cell, low, high, arc): at most one row per arc and cell more."""
    edges = [(start, arc) for arc, (start, _) in enumerate(arcs)]
    if edges[0][0] > 0:
        edges.insert(0, (0, len(arcs) - 1))
    out = []
    for (low, arc), (high, _) in zip(edges, edges[1:] + [(RING, None)]):
        while low < high:
            cell = low >> CELL_BITS
            end = min(high, (cell + 1) << CELL_BITS)
            out.append((cell, low, end, arc))
            low = end
    return out


def bounds(rows, shards, load_factor=1.0):
    """Most rows that each shard takes."""
    if load_factor <= 1:
        return [rows // shards + (shard < rows % shards) for shard in range(shards)]
    return [-int(-load_factor * rows // shards)] * shards


def pour(demand, owners, room):
    """Segments (arc, first rank, rows, shard, first slot) of a full assignment.

    Every arc first fills its own shard; what is left walks clockwise, the oldest first.
    """
    room, filled, segments, waiting = list(room), [0] * len(room), [], []

    def take(arc, first, rows, shard):
        n = min(rows, room[shard])
        if n:
            segments.append((arc, first, n, shard, filled[shard]))
            room[shard] -= n
            filled[shard] += n
        return n

    left = []
    for arc, rows in enumerate(demand):
        n = take(arc, 0, rows, owners[arc])
        left.append((n, rows - n))
    for turn in range(2):
        for arc, (first, rows) in enumerate(left):
            while waiting and room[owners[arc]]:
                source, at, rest = waiting.pop(0)
                n = take(source, at, rest, owners[arc])
                if n < rest:
                    waiting.insert(0, (source, at + n, rest - n))
            if turn == 0 and rows:
                waiting.append((arc, first, rows))
    return segments


def assign_shards(df, shards, id_col="doc_id", text_col="text", virtual_nodes=64, load_factor=1.0):
    """Rows (id, size, text_crc32, arc, shard, slot) with `size` the UTF-8 bytes of the text plus 1.

    Hashes are computed once and written to the shared folder; texts are never shuffled.
    """
    spark = df.sparkSession
    arcs = ring(shards, virtual_nodes)
    text = F.col(text_col)
    path = work_folder(spark, "ring")
    df.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "utf-8")), F.lit(0).cast("long")).alias("text_crc32"),
        F.xxhash64(text).alias("position"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    cells = spark.createDataFrame(ring_cells(arcs), "cell long, low long, high long, arc int")
    place = F.pmod("position", F.lit(RING))
    rows = (
        rows.withColumns({"place": place, "of_cell": F.shiftright(place, CELL_BITS)})
        .join(
            F.broadcast(cells),
            (F.col("of_cell") == F.col("cell")) & (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")),
        )
        .drop("place", "of_cell", "cell", "low", "high")
    )

    counted = {row.arc: row.n for row in rows.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    total = sum(counted.values())
    demand = [counted.get(arc, 0) for arc in range(len(arcs))]
    slices = [max(1, -(-n * SLICES // max(1, total))) for n in demand]
    segments = pour(demand, [shard for _, shard in arcs], bounds(total, shards, load_factor))

    per_arc = F.get(F.array(*[F.lit(n) for n in slices]), F.col("arc"))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("id"), per_arc).cast("int"))
    cells = sorted((r.arc, r.slice, r.n) for r in rows.groupBy("arc", "slice").agg(F.count("*").alias("n")).collect())
    offsets, seen = [], {}
    for arc, piece, n in cells:
        offsets.append((arc, piece, seen.get(arc, 0)))
        seen[arc] = seen.get(arc, 0) + n

    offset = spark.createDataFrame(offsets, "arc int, slice int, offset long")
    segment = spark.createDataFrame(segments, "arc int, first long, n long, shard int, slot long")
    within = Window.partitionBy("arc", "slice").orderBy("position", "id", "text_crc32", "size")
    rank = F.col("offset") + F.col("row") - 1
    return (
        rows.withColumn("row", F.row_number().over(within))
        .join(F.broadcast(offset), ["arc", "slice"])
        .withColumn("rank", rank)
        .withColumnRenamed("arc", "of_arc")
        .join(
            F.broadcast(segment),
            (F.col("of_arc") == F.col("arc")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")),
        )
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            "arc",
            "shard",
            (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"),
        )
    )


def home_shard(position, arcs):
    """Owner of a position in plain Python, for tests."""
    return arcs[bisect_right([start for start, _ in arcs], position % RING) - 1][1]
