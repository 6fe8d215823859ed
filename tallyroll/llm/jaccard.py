"""Similarity join of texts by the Jaccard distance of their word n-grams, exact, over regions around pivots.

The Jaccard distance is a metric on sets. Texts with equal sets are one class first;
the join runs over classes. Any set may be a pivot; the pivots of the first level are
the one-shingle sets {u}. A class x lies at distance 1 - 1/|x| from the pivots of its
own shingles and at distance 1 from all others, so its nearest pivots are its own
shingles, and a fixed order of pivots (rare ones first) settles the ties: its Voronoi
region is that of its first shingle. Boundary: if y is within the radius r of x and
the first shingle they share has i shingles of x before it, then those i are not in y,
so |x \\ y| >= i and, by the triangle inequality over x & y, i <= r |x|. So x is
replicated into the regions of its first floor(r |x|) + 1 shingles and no others, and
any two classes within r meet in a region. The order uses counts of all shingles in a
table of fixed size; any order gives the same links, a better one smaller regions.

Small regions yield their pairs, less those that sizes and places rule out. A large
region (a group of near copies, a passage that many texts share) is joined around a
pivot of its own: the distance of every member to the pivot is computed; members in
the pivot's ball are linked with it. If all members are in one component, the region
is done. Otherwise every link between components has an end outside the largest one;
such members become the pivots of the next round, against the members that differ in
component and lie in the triangle-inequality window |d(x, p) - d(q, p)| <= r of the
first pivot. The number of pivots grows from round to round, the last takes all that
are left, so the recursion ends and misses nothing. Pairs within a group of near
copies are never listed.

Before sets are compared, signatures are: counts of a set's shingles in 256 buckets.
They map sets into a space where they lie no farther apart, so they rule out pairs and
never a link. Only the sets of classes that still have a partner are made again.

Shingles are 64-bit hashes of word sequences. Within one pair of texts of n shingles
two different shingles collide with a probability of about n^2 / 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import bytes_of, land, new_path
from tallyroll.llm.components import components

#: Cells and blocks of the table of shingle counts: 8 MB whatever the input.
CELLS, BLOCK = 1 << 20, 1 << 14
#: Members up to which a region yields its pairs directly.
LEAF = 32
#: Members that meet one pivot in one task.
SALT = 128
#: 64-bit words of the bitmap that tells which texts are needed again: 1 MB whatever the input.
WORDS = 1 << 17
#: Buckets of a class's signature.
BUCKETS = 256
_ROWS = 2000  # rows handled at a time
_CELL = np.uint64(64 - CELLS.bit_length() + 1)
_ENTRY = np.dtype([("u", "<u8"), ("c", "<i8"), ("n", "<u4"), ("i", "<u4")])


def _odd(seed: int, n: int) -> list[np.uint64]:
    return [np.uint64(xxhash.xxh3_64_intdigest(b"%d:%d" % (seed, k)) | 1) for k in range(n)]


def shingle_hashes(text: bytes, width: int, factors: list[np.uint64]) -> np.ndarray:
    """The sorted distinct hashes of a text's word n-grams; a shorter text is one shingle, a text without words none."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII white-space characters only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < width:
        h = np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64)
    else:
        n = len(words) - width + 1
        mixed = h[:n] * factors[0]
        for k in range(1, width):
            mixed = (mixed ^ (mixed >> np.uint64(31)) ^ h[k:n + k]) * factors[k]
        h = mixed ^ (mixed >> np.uint64(29))
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def class_number(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def signature(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each of BUCKETS buckets, 255 at most. Between two sets these numbers differ by |A \\ B| + |B \\ A| in sum at most."""
    return np.minimum(np.bincount(((shingles >> np.uint64(20)) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def shingled(docs: DataFrame, width: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The landed rows (id, n, c, digest, sig: null if the task has seen the set before) and the counts by task (block, counts)."""
    spark, kind = docs.sparkSession, docs.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, counts, seen, names, id_type = _odd(seed, width), np.zeros(CELLS, np.uint32), set(), ["id", "n", "c", "digest", "sig", "kind"], pa.int64()
        for batch in _slices(batches):
            id_type = batch.column(0).type
            n, digests, signatures = [], [], []
            for text in bytes_of(batch.column(1)):
                s = shingle_hashes(text, width, factors)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                new = len(s) > 0 and digest not in seen
                n.append(len(s))
                digests.append(digest)
                signatures.append(signature(s) if new else None)
                if new:
                    seen.add(digest)
                    np.add.at(counts, (s >> _CELL).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(map(class_number, digests), pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary()), pa.array([0] * len(n), pa.int32())], names=names)
        if seen:
            blocks = [counts[k:k + BLOCK].tobytes() for k in range(0, CELLS, BLOCK)]
            none, n = lambda t: pa.nulls(len(blocks), t), pa.array(range(len(blocks)), pa.int64())
            yield pa.RecordBatch.from_arrays([none(id_type), n, none(pa.int64()), none(pa.binary()), pa.array(blocks, pa.binary()), pa.array([1] * len(blocks), pa.int32())], names=names)

    path, schema = new_path(spark, "shingled"), f"id {kind}, n long, c long, digest binary, sig binary, kind int"
    docs.mapInArrow(run, schema).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    read = spark.read.schema(schema).parquet(path)
    return read.filter("kind = 0").drop("kind"), read.filter("kind = 1").select(F.col("n").alias("block"), F.col("sig").alias("counts"))


def total_counts(parts: DataFrame) -> np.ndarray:
    """The sum of the tasks' count tables: CELLS numbers, whatever the input."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = sums.setdefault(block, np.zeros(BLOCK, np.int64))
                own += np.frombuffer(counts, np.uint32)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "counts"])

    out = np.zeros(CELLS, np.int64)
    for block, counts in parts.repartition(CELLS // BLOCK, "block").mapInArrow(add, "block long, counts binary").collect():
        out[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(counts, np.int64)
    return out


def region_entries(docs: DataFrame, counts: np.ndarray, width: int, seed: int, percent: int, buckets: int) -> DataFrame:
    """(bucket, entries): each class with the shingles in whose regions it lies, its size and their places, packed.

    Shingles are hashed anew: reading the texts again is cheaper than writing all shingles.
    """
    order = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32))
    shift = np.uint64(64 - buckets.bit_length() + 1) if buckets > 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, seen = _odd(seed, width), set()
        for batch in _slices(batches):
            some = []
            for text in bytes_of(batch.column(1)):
                s = shingle_hashes(text, width, factors)
                n, digest = len(s), xxhash.xxh3_128_digest(s.tobytes())
                if not n or digest in seen:
                    continue
                seen.add(digest)
                reach = n - -(-percent * n // 100) + 1
                place = np.argsort(order.value[(s >> _CELL).astype(np.int64)], kind="stable")[:reach]
                e = np.empty(reach, _ENTRY)
                e["u"], e["c"], e["n"], e["i"] = s[place], class_number(digest), n, np.arange(reach)
                some.append(e)
            if not some:
                continue
            entries = np.concatenate(some)
            bucket = (entries["u"] >> shift).astype(np.int64) if shift is not None else np.zeros(len(entries), np.int64)
            by = np.argsort(bucket, kind="stable")
            entries, bucket = entries[by], bucket[by]
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(at[1:], len(bucket))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array([entries[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())], names=["bucket", "entries"])

    return docs.mapInArrow(run, "bucket long, entries binary")


def join_regions(entries: DataFrame, percent: int) -> DataFrame:
    """Regions with two members and more. large = 0: a pair (x, y), meeting key `k`; large = 1: member x (of y shingles) of region k, whose shingle is at place i of x."""
    def joined(e: np.ndarray) -> Iterator[np.ndarray]:
        e = e[np.lexsort((e["c"], e["u"]))]
        fresh = np.ones(len(e), bool)  # several tasks may send one class
        fresh[1:] = (e["u"][1:] != e["u"][:-1]) | (e["c"][1:] != e["c"][:-1])
        e = e[fresh]
        at = np.flatnonzero(np.concatenate([[True], e["u"][1:] != e["u"][:-1]]))
        size = np.diff(np.append(at, len(e)))
        pairs = []
        for m in np.unique(size[(size > 1) & (size <= LEAF)]):
            first = at[size == m]
            a, b = np.triu_indices(m, 1)
            x, y = e[(first[:, None] + a).ravel()], e[(first[:, None] + b).ravel()]
            key = np.repeat(e["c"][first], len(a))
            n, k = x["n"].astype(np.int64), y["n"].astype(np.int64)
            least = -(-percent * (n + k) // (100 + percent))
            most = 1 + np.minimum(n - x["i"], k - y["i"]) - 1
            fit = (100 * np.minimum(n, k) >= percent * np.maximum(n, k)) & (most >= least)
            zero = np.zeros(fit.sum(), np.int64)
            pairs.append(np.stack([zero, x["c"][fit], y["c"][fit], key[fit], zero]))
        if pairs:
            yield np.unique(np.concatenate(pairs, axis=1), axis=1)
        for first, m in zip(at[size > LEAF], size[size > LEAF], strict=True):
            own = e[first:first + m]
            yield np.stack([np.ones(m, np.int64), own["c"], own["n"].astype(np.int64), np.full(m, own["u"][0]).view(np.int64), own["i"].astype(np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        bucket = None

        def flush():
            if held:
                for some in joined(np.frombuffer(b"".join(held), _ENTRY)):
                    yield pa.RecordBatch.from_arrays([pa.array(row) for row in some], names=["large", "x", "y", "k", "i"])
                held.clear()

        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket:
                    yield from flush()
                    bucket = b
                held.append(raw)
        yield from flush()

    return entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "large long, x long, y long, k long, i long")


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (x, y, key, salt), landed, less those whose signatures lie too far apart.

    Signatures lie no farther apart than the sets, so no pair within the radius goes.
    """
    once = pairs.groupBy("x", "y").agg(F.min(F.struct("key", "salt")).alias("at")).select("x", "y", "at.key", "at.salt")
    side = lambda name: classes.select(F.col("c").alias(name), F.col("n").alias(f"n_{name}"), F.col("sig").alias(f"sig_{name}"))
    both = once.join(side("x"), "x").join(side("y"), "y").select("x", "y", "key", "salt", "n_x", "n_y", "sig_x", "sig_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            n = sum(batch.column(k).to_numpy(zero_copy_only=False) for k in (4, 5))
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int16) for k in (6, 7))
            apart = np.abs(a - b).sum(axis=1, dtype=np.int64)
            yield batch.select(range(4)).filter(pa.array(apart <= n - 2 * -(-percent * n // (100 + percent))))

    return land(both.mapInArrow(run, "x long, y long, key long, salt long"), "pairs")


def wanted_sets(docs: DataFrame, wanted: DataFrame, width: int, seed: int) -> DataFrame:
    """The landed sets (c, shingles) of the wanted classes (c, keeper: the id of a row that has it), hashed anew."""
    spark = docs.sparkSession
    place = F.xxhash64("keeper")
    words = wanted.groupBy(F.pmod(place, F.lit(WORDS)).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(shiftright(xxhash64(keeper), 17), 64) as int))")).alias("bits"))
    bitmap = np.zeros(WORDS, np.uint64)  # at most WORDS rows come to the driver
    for w, bits in words.collect():
        bitmap[w] = np.int64(bits).astype(np.uint64)
    marked = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, seen = _odd(seed, width), set()
        for batch in _slices(batches):
            at = batch.column(2).to_numpy(zero_copy_only=False)
            hit = (marked.value[at % WORDS] >> (np.right_shift(at, 17) % 64).astype(np.uint64)) & np.uint64(1) == 1
            c, sets = [], []
            for text in bytes_of(batch.column(1).filter(pa.array(hit))):
                s = shingle_hashes(text, width, factors)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                if len(s) and digest not in seen:
                    seen.add(digest)
                    c.append(class_number(digest))
                    sets.append(s.tobytes())
            if c:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(sets, pa.binary())], names=["c", "shingles"])

    found = docs.select("id", "text", F.xxhash64("id")).mapInArrow(run, "c long, shingles binary")
    return land(found.join(wanted.select("c"), "c", "left_semi"), "wanted-sets")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Per pair (x, y) of classes: x, y, `common`, n_x, n_y. Pairs with equal (key, salt) meet in one task, and every set goes there once."""
    ends = pairs.select("key", "salt", F.col("x").alias("c")).unionAll(pairs.select("key", "salt", "y")).distinct()
    rows = ends.join(sets, "c").select("key", "salt", F.lit(0).alias("what"), "c", F.lit(0).cast("long").alias("d"), "shingles").unionAll(
        pairs.select("key", "salt", F.lit(1), "x", "y", F.lit(None).cast("binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        at = None
        for batch in _slices(batches):
            out = []
            for key, salt, what, c, d, raw in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if (key, salt) != at:
                    at = (key, salt)
                    held = {}
                if not what:
                    held[c] = np.frombuffer(raw, np.uint64)
                else:
                    a, b = held[c], held[d]
                    out.append((c, d, len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*out, strict=True)], names=["x", "y", "common", "n_x", "n_y"])

    return rows.repartition("key", "salt").sortWithinPartitions("key", "salt", "what").mapInArrow(run, "x long, y long, common long, n_x long, n_y long")


def class_links(docs: DataFrame, classes: DataFrame, counts: np.ndarray, width: int, seed: int, percent: int) -> DataFrame:
    """Edges (x, y) between classes within the radius, enough of them to join all that are linked by a path."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = 1 << max(0, int(total * (100 - percent) // 100 // 32768).bit_length())
    regions = land(join_regions(region_entries(docs, counts, width, seed, percent, buckets), percent), "regions")
    near = regions.filter("large = 0").select("x", "y", F.col("k").alias("key"), F.lit(0).cast("long").alias("salt"))
    members = regions.filter("large = 1").select(F.col("k").alias("g"), F.col("x").alias("c"), F.col("y").alias("n"), "i")
    # The pivot of a region is the member that lies in most large regions: edits bring rare shingles, so that is the middle of a group of near copies.
    often = members.groupBy("c").agg(F.count("*").alias("often"))
    heads = land(members.join(often, "c").groupBy("g").agg(F.max_by("c", F.struct("often", "c")).alias("p"), F.count("*").alias("m")), "heads")
    salt = F.pmod(F.xxhash64("c"), F.ceil(F.col("m") / SALT))
    met = members.join(heads, "g").filter("c <> p")
    stars = met.select(F.col("c").alias("x"), F.col("p").alias("y"), F.col("p").alias("key"), salt.alias("salt"))
    within = f"100 * common >= {percent} * (n_x + n_y - common)"
    pairs = possible(near.unionAll(stars), classes, percent)
    wanted = pairs.select(F.col("x").alias("c")).unionAll(pairs.select("y")).unionAll(members.select("c")).distinct()
    sets = wanted_sets(docs, land(wanted.join(classes.select("c", "keeper"), "c"), "wanted"), width, seed)
    measured = land(overlaps(pairs, sets), "overlaps")
    edges = land(measured.filter(within).select("x", "y"), "links")
    if not members.take(1):
        return edges
    radius = 1 - percent / 100
    apart = measured.select("x", "y", (1 - F.col("common") / (F.col("n_x") + F.col("n_y") - F.col("common"))).alias("far"))
    # A distance that no one has measured is null: it rules out no pair.
    placed = met.join(apart, (apart["x"] == met["c"]) & (apart["y"] == met["p"]), "left").select("g", "c", "n", "i", "far")
    own = members.join(heads, "g").filter("c = p").select("g", "c", "n", "i", F.lit(0.0))
    placed = land(placed.unionAll(own), "placed")
    pivots = 8
    while True:
        labels = components(edges)
        named = placed.join(labels, placed["c"] == labels["node"], "left").select("g", "c", "n", "i", "far", F.coalesce("label", "c").alias("label"))
        sizes = named.groupBy("g", "label").agg(F.count("*").alias("m"))
        most = sizes.groupBy("g").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.count("*").alias("parts"), F.sum("m").alias("m"))
        most = land(most.filter("parts > 1"), "open-regions")
        if not most.take(1):
            return edges
        still = land(named.join(most, "g"), "open-members")
        rest = still.filter("label <> main")
        left = rest.groupBy("g").agg(F.count("*").alias("left"))
        last = not left.filter(F.col("left") > pivots).take(1) or pivots > 4096
        if not last:
            rest = rest.groupBy("g", F.pmod(F.xxhash64("c", F.lit(pivots)), F.lit(pivots)).alias("cell")).agg(F.min_by(F.struct("c", "n", "i", "far", "label"), "c").alias("q")).select("g", "q.*")
        q = rest.select("g", F.col("c").alias("q"), F.col("n").alias("q_n"), F.col("i").alias("q_i"), F.col("far").alias("q_far"), F.col("label").alias("q_label"))
        window = F.coalesce(F.abs(F.col("far") - F.col("q_far")) <= radius + 1e-9, F.lit(True))
        # As in small regions: sizes, and places if the region's shingle is the first that the two share.
        sized = (100 * F.least("n", "q_n") >= percent * F.greatest("n", "q_n")) & ((100 + percent) * F.least(F.col("n") - F.col("i"), F.col("q_n") - F.col("q_i")) >= percent * (F.col("n") + F.col("q_n")))
        met_again = still.join(q, "g").filter((F.col("label") != F.col("q_label")) & window & sized)
        tried = met_again.select(F.least("c", "q").alias("x"), F.greatest("c", "q").alias("y"), F.col("label").alias("key"), F.pmod(F.xxhash64("c"), F.ceil(F.col("m") / SALT)).alias("salt"))
        found = overlaps(possible(tried, classes, percent), sets).filter(within).select("x", "y")
        edges = land(edges.unionAll(found).distinct(), "links")
        if last:
            return edges
        pivots *= 8


def jaccard_classes(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_shingles, component_id, n_copies.

    component_id is the smallest id that links reach, the row's own included; two texts
    are linked if 100 * |A & B| >= percent * |A | B| for their sets of word n-grams
    (A-Z in lower case; words are runs of anything but ASCII white space). n_copies
    counts the rows with the same set, the row itself included.

    A text of fewer words than `width` is one shingle, the whole sequence. Null, empty
    and blank texts have no shingles, link with nothing and are their own component.
    Repeated rows are copies of each other. A row with a null id joins its copies'
    component but never names one, so among null ids alone the component is null.
    Other columns are not read; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    for seed in range(1, 99):
        sets, parts = shingled(rows, width, seed)
        full = sets.filter("n > 0")
        classes = land(full.groupBy("c").agg(
            F.min("id").alias("first"), F.count("*").alias("n_copies"), F.min("n").alias("n"), F.min(F.when(F.col("sig").isNotNull(), F.col("id"))).alias("keeper"),
            F.min("sig").alias("sig"), F.min("digest").alias("d0"), F.max("digest").alias("d1")), "classes")
        if not classes.filter("d0 <> d1").take(1):  # two different sets with one number: hash anew
            break
    edges = class_links(rows, classes, total_counts(parts), width, seed, percent)
    labels = components(edges)
    named = classes.join(labels, classes["c"] == labels["node"], "left").select("c", "first", "n_copies", F.coalesce("label", "c").alias("label"))
    heads = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = land(named.join(heads, "label").select(F.col("c").alias("of"), "component_id", "n_copies"), "class-components")
    known = full.select("id", "n", "c").join(named, F.col("c") == F.col("of")).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "n_copies")
    bare = sets.filter("n = 0").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"))
    return known.unionAll(bare)
