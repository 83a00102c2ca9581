"""Near-duplicate groups of documents by bottom-k sketches and exact verification.

A document is the set of its hashed word shingles. Its sketch is the `K` smallest values of that set
(one hash function: the shingles are hashed already). Documents with equal sets are one class from
the start. For the classes:

1. Inverted lists of retained values. Two sets with similarity 0.8 share at least `NEEDED` of `K`
   retained values but for a chance of about 1e-8, so a class is listed only under the
   `K - NEEDED + SHARED` rarest values that it retains, and two such sets meet in at least `SHARED`
   lists; sets that the sketch holds whole are listed under as many as their size demands, which
   is exact. Rarity is counted over all classes, and values that one class retains make no list: most are such, and
   are left out where they are read, before the rest is shuffled with its class.
   Sizes must lie within a factor of 0.8, so lists are kept per size class.
2. Families. Lists of at most `SHORT` members give overlaps: pairs that meet in `SHARED` of them are
   candidates, in the family of the smaller one. All longer lists with the same smallest member
   are one family, with no pairs made. A pair that is similar meets in a longer list or in enough
   short ones, so it shares a family. Full sets are fetched for members of families only. A family
   beyond `BLOCK_MEMBERS` members or `BLOCK_VALUES` values is cut into blocks, and each pair of
   blocks is a piece of work of its own, so no task holds more than two blocks.
3. In a piece of work all members are compared with the family's first member exactly. Those linked
   to it need no comparison among themselves; every other member is compared with all: estimation
   on the union of two sketches filters, exact similarity on the full sets decides. Only links
   that join two groups leave the task: at most one per member, never all pairs.
4. Linked classes become groups by repeated minimum labels.

Every step is written to the shared folder, which cuts lineage.

Documents without words, or without text, are linked with nothing, not even each other. Rows with a
null id are linked with nothing and have a null component. Equal rows are copies of each other. An
empty table gives an empty result. Other columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import words as W
from tidemark.llm.arrays import HashSet
from tidemark.session import work_folder

K = 128
# P(Binomial(128, 0.8) < 77) is about 2e-8; the estimate at 0.8 spreads by 0.035.
NEEDED = 77
PERCENT = 80
LEAST_ESTIMATE = 0.8 - 5.5 * 0.0354
SHARED, SHORT = 3, 8
BLOCK_MEMBERS, BLOCK_VALUES = 2048, 1_000_000
VALUES_PER_FILE = 1 << 16
BASE = "id long, n int, class long, sketch binary"
SETS = "class long, n int, values binary"
LINKS = "a long, b long"


def class_of(values):
    """64-bit name of a set, 0 for the empty one."""
    if not len(values):
        return np.uint64(0)
    parts = np.array([np.bitwise_xor.reduce(W.mix(values ^ W.END)), np.add.reduce(values)], np.uint64)
    return W.chain(parts[:1], parts[1:])[0]


def _sketches(size, k):
    """Rows of BASE from rows (id, text); copies of a set within a batch carry its sketch once."""

    def make(batches):
        for batch in batches:
            n, names, sketches, seen = [], [], [], set()
            for text in batch.column(1):
                values = W.shingles(W.text_words(text.as_py()), size)
                name = class_of(values)
                n.append(len(values))
                names.append(name)
                sketches.append(None if name in seen or not len(values) else values[:k].tobytes())
                seen.add(name)
            names = pa.array(np.array(names, np.uint64).view(np.int64))
            columns = [batch.column(0), pa.array(n, pa.int32()), names, pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "class", "sketch"])

    return make


def _whole_sets(size, wanted):
    """Rows of SETS for the rows (id, text) whose class and id are wanted."""

    def make(batches):
        for batch in batches:
            found = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = W.shingles(W.text_words(text.as_py()), size)
                if key is not None and len(values):
                    found.append((class_of(values), key, values))
            if not found:
                continue
            marks = W.chain(np.array([f[0] for f in found]), np.array([f[1] for f in found], np.int64).view(np.uint64))
            rows, sent = {"class": [], "n": [], "values": []}, set()
            for hit, (name, _, values) in zip(wanted.contains(marks), found):
                if hit and name not in sent:
                    sent.add(name)
                    rows["class"].append(int(name.astype(np.int64)))
                    rows["n"].append(len(values))
                    rows["values"].append(values.tobytes())
            schema = pa.schema([("class", pa.int64()), ("n", pa.int32()), ("values", pa.binary())])
            yield pa.RecordBatch.from_pydict(rows, schema)

    return make


def _marked(batches):
    """Hash of class and id, as `_whole_sets` makes it."""
    for batch in batches:
        name, key = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(W.chain(name, key).view(np.int64))], ["mark"])


class Groups:
    """Union of members of one piece of work."""

    def __init__(self, n):
        self.up = list(range(n))

    def top(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.top(x), self.top(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _flat(sets):
    """Index of each value among all values, and where each set begins."""
    _, index = np.unique(np.concatenate(sets), return_inverse=True)
    return index, np.concatenate(([0], np.cumsum([len(s) for s in sets])))


def _shared(index, starts, x, flags):
    """Size of the intersection of set x with every set."""
    mine = index[starts[x] : starts[x + 1]]
    flags[mine] = 1
    found = np.add.reduceat(flags[index], starts[:-1])
    flags[mine] = 0
    return found


def spanning_links(sets, leader, k=K, least=LEAST_ESTIMATE, percent=PERCENT):
    """Pairs of positions that link all sets with 100 * intersection >= percent * union into their groups."""
    n = np.array([len(s) for s in sets])
    index, starts = _flat(sets)
    flags = np.zeros(index.max() + 1, np.int32)
    groups, links = Groups(len(sets)), []

    def link(x, others, shared):
        for y in others[100 * shared >= percent * (n[x] + n[others] - shared)]:
            if groups.join(x, int(y)):
                links.append((x, int(y)))

    everyone = np.arange(len(sets))
    link(leader, everyone[everyone != leader], _shared(index, starts, leader, flags)[everyone != leader])
    rest = [x for x in everyone if groups.top(x) != groups.top(leader)]
    if not rest:
        return links
    sketches = [s[:k] for s in sets]
    small, small_starts = _flat(sketches)
    small_flags = np.zeros(small.max() + 1, np.int32)
    last = np.array([s[-1] if len(s) >= k else np.iinfo(np.uint64).max for s in sketches], np.uint64)
    for x in rest:
        tops = np.array([groups.top(y) for y in everyone])
        others = everyone[(tops != tops[x]) & (np.minimum(n, n[x]) * 100 >= percent * np.maximum(n, n[x]))]
        if not len(others):
            continue
        common = _shared(small, small_starts, x, small_flags)[others]
        # Both sketches are complete up to the smaller of their last values: there they sample the union.
        limit = np.minimum(last[x], last[others])
        mine = np.searchsorted(sketches[x], limit, "right")
        theirs = np.array([np.searchsorted(sketches[y], v, "right") for y, v in zip(others, limit)])
        others = others[common >= least * (mine + theirs - common)]
        if len(others):
            link(x, others, _shared(index, starts, x, flags)[others])
    return links


def _linker(k, least, percent):
    """Rows of LINKS from rows (leader, i, j, class, values) sorted by the first three."""

    def solve(key, group):
        names = list(group)
        sets = [np.frombuffer(group[name], np.uint64) for name in names]
        if len(sets) < 2:
            return
        pairs = spanning_links(sets, names.index(key[0]) if key[0] in group else 0, k, least, percent)
        if pairs:
            a, b = zip(*pairs)
            rows = {"a": [names[x] for x in a], "b": [names[y] for y in b]}
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    def link(batches):
        key, group = None, {}
        for batch in batches:
            for *row_key, name, values in zip(*(column.to_pylist() for column in batch.columns)):
                if row_key != key:
                    if group:
                        yield from solve(key, group)
                    key, group = row_key, {}
                group[name] = values
        if group:
            yield from solve(key, group)

    return link


def _kept(df, name):
    """The rows, written to the shared folder and read back."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links):
    """Smallest member (node, label) of the component of every linked node, by repeated minimum labels."""
    edges = _kept(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = _kept(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("met"))
        jump = labels.select(F.col("node").alias("met"), F.col("label").alias("jumped"))
        new = met.join(jump, "met").select("node", F.col("label").alias("old"), F.least("met", "jumped").alias("label"))
        new = _kept(new, "labels")
        if new.filter("old <> label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def near_duplicates(docs, size, id_col="doc_id", text_col="text", percent=PERCENT, k=K, needed=NEEDED, least=LEAST_ESTIMATE):
    """Rows (id, n_shingles, component_id, kept) of all documents; `size` is the number of words of a shingle."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    base = _kept(rows.mapInArrow(_sketches(size, k), BASE), "sketches")
    named = base.filter("n > 0 and id is not null")
    classes = named.groupBy("class").agg(F.min("id").alias("first"), F.max("n").alias("n"))
    sketches = named.filter("sketch is not null").select("class", "n", "sketch").dropDuplicates(["class"])

    # Inverted lists of the rarest retained values.
    values = _kept(sketches.mapInArrow(_values, "class long, n int, k int, value long"), "retained")
    counts = _kept(values.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1"), "shared-values")
    several = HashSet(counts, "value", rows_per_file=VALUES_PER_FILE)
    values = values.mapInArrow(_values_in(several), "class long, n int, k int, value long")
    by_rarity = Window.partitionBy("class").orderBy("df", "value")
    must = F.least(F.ceil(F.col("n") * percent / 100), F.lit(needed))
    listed = (
        values.join(counts, "value")
        .withColumns({"rank": F.row_number().over(by_rarity), "shared": F.count("*").over(Window.partitionBy("class"))})
        # Values of no other class come first in the order.
        .filter(F.col("rank") + F.col("k") - F.col("shared") <= F.col("k") - must + F.least(must, F.lit(SHARED)))
        # Sizes within a factor of `percent` are in the same or in neighbouring steps, rounding included.
        .withColumn("step", F.floor(F.log(F.col("n").cast("double")) / math.log(100.1 / percent)))
        .select("class", "n", "value", F.col("step").alias("own"), F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("step"))
    )
    listed = _kept(listed, "lists")
    leaders = listed.groupBy("value", "step").agg(F.min("class").alias("leader"), F.count("*").alias("m")).filter("m > 1")
    listed = _kept(listed.join(leaders, ["value", "step"]), "long-lists")
    longer = listed.filter(F.col("m") > SHORT).select("leader", "class", "n")
    # At most SHORT members each; a pair is made in the list of its larger size class only.
    short = listed.filter(F.col("m") <= SHORT).groupBy("value", "step")
    short = short.agg(F.array_sort(F.collect_list(F.struct("class", "n", "own"))).alias("x"))
    later = lambda a, i: F.transform(F.slice("x", i + 2, SHORT), lambda b: F.struct(a.alias("a"), b.alias("b")))
    pairs = short.select("step", F.explode(F.flatten(F.transform("x", later))).alias("p"))
    pairs = pairs.filter(F.greatest("p.a.own", "p.b.own") == F.col("step")).filter(
        F.least("p.a.n", "p.b.n") * 100 >= F.greatest("p.a.n", "p.b.n") * percent
    )
    met = pairs.groupBy(*[F.col(f"p.{side}.{c}").alias(f"{c}_{side}") for side in "ab" for c in ("class", "n")]).agg(F.count("*").alias("met"))
    met = met.filter(F.col("met") >= F.least(F.ceil(F.least("n_a", "n_b") * percent / 100), F.lit(SHARED)))
    first = met.select(F.col("class_a").alias("leader"), F.col("class_a").alias("class"), F.col("n_a").alias("n"))
    second = met.select(F.col("class_a").alias("leader"), F.col("class_b").alias("class"), F.col("n_b").alias("n"))
    members = longer.union(first).union(second).distinct()
    members = _kept(members, "families")
    weight = F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_VALUES))
    blocks = members.groupBy("leader").agg(weight.cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # Pairs of blocks (i <= j); the leader is in all of them.
    work = members.join(blocks, "leader").withColumn("own", own).withColumn("other", other)
    work = work.select("leader", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class")
    lead = blocks.select("leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), "blocks")
    lead = lead.select("leader", "i", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)).alias("j"), F.col("leader").alias("class"))
    work = work.union(lead).distinct()

    # Full sets of the members of families, made again from one text of each class; equal rows give one twice.
    wanted = members.select("class").distinct().join(classes, "class").select("class", "first").mapInArrow(_marked, "mark long")
    wanted = HashSet(_kept(wanted, "marks"), "mark")
    sets = _kept(rows.mapInArrow(_whole_sets(size, wanted), SETS), "sets")
    pieces = work.join(sets, "class").select("leader", "i", "j", "class", "values")
    pieces = pieces.repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j")
    links = _kept(pieces.mapInArrow(_linker(k, least, percent), LINKS), "links")

    groups = classes.join(components(links), classes["class"] == F.col("node"), "left")
    label = F.coalesce("label", "class")
    groups = groups.select("class", label.alias("label"), "first")
    lowest = groups.groupBy("label").agg(F.min("first").alias("lowest"))
    found = _kept(groups.join(lowest, "label").select("class", "lowest"), "groups")
    alone = F.when(F.col("n") == 0, F.col("id"))
    known = base.select("id", "n", "class").withColumn("class", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("class")))
    component = F.coalesce("lowest", alone)
    return known.join(found, "class", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _values(batches):
    """One row per retained value."""
    for batch in batches:
        sketches = [np.frombuffer(s, np.int64) for s in batch.column(2).to_pylist()]
        k = np.array([len(s) for s in sketches], np.int32)
        if len(k):
            columns = [np.repeat(batch.column(i).to_numpy(), k) for i in (0, 1)]
            columns += [np.repeat(k, k), np.concatenate(sketches)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["class", "n", "k", "value"])


def _values_in(wanted):
    """The rows of retained values whose value is wanted."""

    def keep(batches):
        for batch in batches:
            hashes = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(wanted.contains(hashes)))

    return keep
