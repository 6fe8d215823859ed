"""Phrases whose words stand together more often than apart, mined by set-oriented relations (SETM).

The relation R_k holds the occurrences of word groups of length k: (block, position,
group), sorted by position. A block is a run of texts of one language; between pieces
and between texts a position stays empty, so occurrences at p and p + 1 lie in one
piece. One level:

1. semi-join: occurrences of groups that are not frequent leave R_(k-1);
2. merge-join: occurrences at p and p + 1 become one of length k at p;
3. group-count: occurrences by group, summed up in the task, then by Spark;
4. what is frequent is written, and R_k, semi-joined with it, is written for the next level.

Relations are written in blocks (a row holds the sorted columns of one block), so the
merge-join moves no data: only the counts of groups are shuffled. The frequent groups
reach the tasks as a bitmap of hashed groups of 32 MB at most. It lets a few others
pass, never drops one: the counts decide, so results are exact at every size.

A word's id is a 64-bit hash of word and language; if two words share one, everything
is hashed anew. Groups are compared as tuples of ids.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.llm.common import bytes_of, land, new_path

#: Bytes that end a piece: . , ; : ! ? and U+000A to U+000D.
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
#: No byte of UTF-8 text; stands for the end of a piece.
_GAP = b"\xff"
#: Words of a block.
BLOCK = 1 << 19
#: Bits of the bitmap of frequent groups: at least, at most (32 MB), and for each group.
LEAST_BITS, MOST_BITS, BITS_EACH = 20, 28, 16
#: Parts of a language's candidates that are ranked side by side.
SALTS = 64
#: Bits of the bitmap that one row holds on its way to the driver.
_PART = 18
_RELATION = "ids binary, groups binary, steps binary, gid binary"


class _Codes(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _binary(array: np.ndarray) -> pa.Array:
    return pa.array([array.tobytes()], pa.binary())


def occurrences(docs: DataFrame, seed: int) -> DataFrame:
    """R_1, landed: (lang, words, ids, groups, steps, gid), one row for each block. `steps` are the differences of the sorted positions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Codes, list[np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (codes, parts) in held.items():
                code = np.concatenate(parts)
                at = np.flatnonzero(code)
                if not len(at):
                    continue
                words = list(codes)[1:]
                own = xxhash.xxh3_64_intdigest(lang.encode(), seed)
                ids = np.fromiter((xxhash.xxh3_64_intdigest(w, own) for w in words), np.uint64, len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([[w.decode() for w in words]], pa.list_(pa.string())), _binary(ids), _binary(np.arange(len(words), dtype=np.int32)),
                     _binary(np.diff(at, prepend=0).astype(np.int32)), _binary((code[at] - 1).astype(np.int32))], names=["lang", "words", "ids", "groups", "steps", "gid"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1)), strict=True):
                codes, parts = held.setdefault(lang, (_Codes({_GAP: 0}), [np.zeros(1, np.int32)]))
                tokens = text.lower().translate(_ENDS).replace(b"\n", b" \xff ").split()
                tokens.append(_GAP)
                parts.append(np.fromiter(map(codes.__getitem__, tokens), np.int32, len(tokens)))
                size += len(tokens)
                if size >= BLOCK:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return _land_blocks(rows.mapInArrow(run, f"lang string, words array<string>, {_RELATION}"), "occurrences-1")


def _land_blocks(df: DataFrame, name: str) -> DataFrame:
    """As `land`, with row groups small enough that a few blocks at a time are in memory."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").option("parquet.block.size", str(16 << 20)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _block_by_block(spark: SparkSession) -> Iterator[None]:
    """A block is megabytes, so while blocks are read each goes to Python alone: a batch of thousands would hold all blocks of a task twice."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def count_words(relation: DataFrame) -> DataFrame:
    """The landed vocabulary (id, lang, word, f)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words = batch.column(1).slice(k, 1).flatten()
                ids = np.frombuffer(batch.column(2)[k].as_py(), np.int64)
                count = np.bincount(np.frombuffer(batch.column(3)[k].as_py(), np.int32), minlength=len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.repeat(batch.column(0)[k], len(ids)), words, pa.array(count, pa.int64())], names=["id", "lang", "word", "c"])

    counts = relation.select("lang", "words", "ids", "gid").mapInArrow(run, "id long, lang string, word string, c long")
    with _block_by_block(relation.sparkSession):
        return land(counts.groupBy("id", "lang", "word").agg(F.sum("c").alias("f")), "vocabulary")


def _places(groups: np.ndarray, bits: int) -> np.ndarray:
    """Where tuples of ids (one in a row) stand in the bitmap."""
    h = np.zeros(len(groups), np.uint64)
    for column in groups.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


def bitmap_of(frequent: DataFrame, columns: list[str]) -> tuple[np.ndarray, int]:
    """The bitmap of the groups in these columns and the logarithm of its length. Tasks send places, one task for each part puts them together."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(frequent.count() * BITS_EACH).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_places(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1), bits))
            part = at >> _PART
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            ends = np.append(starts[1:], len(at))
            yield pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array([(at[a:b] & ((1 << _PART) - 1)).astype(np.int32).tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())], names=["part", "at"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts.setdefault(part, np.zeros(1 << _PART, bool))[np.frombuffer(raw, np.int32)] = True
        for part, marks in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), _binary(np.packbits(marks, bitorder="little"))], names=["part", "bits"])

    schema = "part long, at binary"
    rows = frequent.select(columns).mapInArrow(places, schema).repartition(1 << (bits - _PART), "part").mapInArrow(put, "part long, bits binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for part, raw in rows.collect():  # 2^(bits - 18) rows of 32 KB at most
        out[part << (_PART - 3):(part + 1) << (_PART - 3)] = np.frombuffer(raw, np.uint8)
    return out, bits


class _Block:
    """One row of a relation: ids of words, groups as rows of places in `ids`, sorted positions and the group at each."""

    def __init__(self, ids: bytes, groups: bytes, steps: bytes, gid: bytes, length: int):
        self.ids, self.groups = np.frombuffer(ids, np.int64), np.frombuffer(groups, np.int32).reshape(-1, length)
        self.pos, self.gid = np.cumsum(np.frombuffer(steps, np.int32), dtype=np.int64), np.frombuffer(gid, np.int32)

    def semi_join(self, marks: np.ndarray, bits: int) -> _Block:
        """Leave only occurrences of groups that the bitmap holds."""
        hit = in_bitmap(self.ids[self.groups], marks, bits)[self.gid]
        self.pos, self.gid = self.pos[hit], self.gid[hit]
        return self

    def merge_join(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and keys of occurrences one word longer; a key is the pair of the groups at p and p + 1."""
        at = np.flatnonzero(self.pos[1:] == self.pos[:-1] + 1)
        return self.pos[at], self.gid[at].astype(np.int64) * len(self.groups) + self.gid[at + 1]

    def longer(self, keys: np.ndarray) -> np.ndarray:
        """The groups of such keys."""
        return np.concatenate([self.groups[keys // len(self.groups)], self.groups[keys % len(self.groups), -1:]], axis=1)


def in_bitmap(groups: np.ndarray, marks: np.ndarray, bits: int) -> np.ndarray:
    """Which tuples of ids the bitmap holds: all that it was made of, and a few others."""
    at = _places(groups, bits)
    return (marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[_Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield _Block(*(batch.column(c)[k].as_py() for c in range(4)), length)


def count_groups(relation: DataFrame, marks: tuple[np.ndarray, int], length: int) -> DataFrame:
    """(w1 .. w<length>, f): how often groups occur whose two parts, one word shorter, are in the bitmap."""
    shared = relation.sparkSession.sparkContext.broadcast(marks)
    names = [f"w{k}" for k in range(1, length + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, length - 1):
            _, keys = block.semi_join(*shared.value).merge_join()
            keys, count = np.unique(keys, return_counts=True)
            groups = block.ids[block.longer(keys)]
            for at in range(0, len(keys), 1 << 17):
                part = slice(at, at + (1 << 17))
                yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(column[part])) for column in groups.T), pa.array(count[part], pa.int64())], names=[*names, "c"])

    counts = relation.select("ids", "groups", "steps", "gid").mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "c"]))
    return counts.groupBy(*names).agg(F.sum("c").alias("f"))


def extended(relation: DataFrame, marks: tuple[np.ndarray, int], longer: tuple[np.ndarray, int], length: int) -> DataFrame:
    """R_length, landed: the merge-join of R_(length - 1) with itself, semi-joined with the bitmap `longer`."""
    shared, kept = (relation.sparkSession.sparkContext.broadcast(m) for m in (marks, longer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, length - 1):
            pos, keys = block.semi_join(*shared.value).merge_join()
            unique = np.unique(keys)
            groups = block.longer(unique)
            hit = in_bitmap(block.ids[groups], *kept.value)
            unique, groups = unique[hit], groups[hit]
            if not len(unique):
                continue
            gid = np.minimum(np.searchsorted(unique, keys), len(unique) - 1)
            stay = unique[gid] == keys
            words, at = np.unique(groups, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [_binary(block.ids[words]), _binary(at.reshape(groups.shape).astype(np.int32)), _binary(np.diff(pos[stay], prepend=0).astype(np.int32)), _binary(gid[stay].astype(np.int32))],
                names=["ids", "groups", "steps", "gid"])

    with _block_by_block(relation.sparkSession):
        return _land_blocks(relation.select("ids", "groups", "steps", "gid").mapInArrow(run, _RELATION), f"occurrences-{length}")


def frequent_groups(docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (id, lang, word, f) and all phrases of 1 to `longest` words that occur `least` times: (phrase: ids, f)."""
    for seed in range(1, 99):
        relation = occurrences(docs, seed)
        words = count_words(relation)
        if not words.groupBy("id").count().filter("count > 1").take(1):  # two words with one id: hash anew
            break
    found = land(words.filter(F.col("f") >= least).select(F.col("id").alias("w1"), "f"), "frequent-1")
    levels, marks = [found.select(F.array("w1").alias("phrase"), "f")], bitmap_of(found, ["w1"])
    for length in range(2, longest + 1):
        with _block_by_block(docs.sparkSession):
            found = land(count_groups(relation, marks, length).filter(F.col("f") >= least), f"frequent-{length}")
        names = found.columns[:-1]
        levels.append(found.select(F.array(*names).alias("phrase"), "f"))
        if length < longest:
            longer = bitmap_of(found, names)
            relation, marks = extended(relation, marks, longer, length), longer
    return words, functools.reduce(DataFrame.unionAll, levels)


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, top: int = 2000, scale: int = 2_000_000, absorbed: int = 80) -> DataFrame:
    """Each language's `top` phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and U+000A to U+000D, and
    pieces into words at spaces and tabs. a counts the phrase's occurrences within
    pieces, overlaps included; phrases of 2 to `longest` words with a >= `least` are
    candidates. Cut after its first words, a candidate has the parts' counts l and r
    and the score floor(scale * a / (l + r)); the cut with the lowest score counts,
    among equal ones the first. A candidate within a longer one that has `absorbed` of a
    hundred of its occurrences goes. n counts all words of the language. Order: score
    and a descending, phrase ascending by bytes.

    A null text has no words; a null lang is `und`. Repeated rows count again, ids are
    not read, other columns neither. Languages without candidates give no rows, nor
    does an empty table. Texts of any length are read whole.
    """
    words, phrases = frequent_groups(docs, longest, least)
    size = F.size("phrase")
    found = phrases.filter(size > 1)
    # Counts of the longest-lived phrase around each part of a candidate; parts have two words at least.
    inner = found.filter(size > 2).select("f", F.explode(F.expr(
        "flatten(transform(sequence(2, size(phrase) - 1), m -> transform(sequence(1, size(phrase) - m + 1), i -> slice(phrase, i, m))))")).alias("part"))
    around = inner.groupBy("part").agg(F.max("f").alias("around"))
    kept = found.join(around, F.col("phrase") == F.col("part"), "left").filter(
        F.col("around").isNull() | (100 * _wide("around") < absorbed * _wide("f"))).select("phrase", F.col("f").alias("a"))
    cuts = kept.select("phrase", "a", F.explode(F.expr("sequence(1, size(phrase) - 1)")).alias("k")).select(
        "phrase", "a", "k", F.expr("slice(phrase, 1, k)").alias("head"), F.expr("slice(phrase, k + 1, size(phrase))").alias("rest"))
    heads, rests = phrases.select(F.col("phrase").alias("head"), F.col("f").alias("l")), phrases.select(F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(heads, "head").join(rests, "rest").withColumn("score", F.expr(f"cast({scale} as decimal(17,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r)"))
    lowest = scored.groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("phrase", "a", "cut.l", "cut.r", "cut.score")
    spelled = lowest.select("phrase", F.posexplode("phrase").alias("at", "id")).join(words.filter(F.col("f") >= least).select("id", "lang", "word"), "id").groupBy("phrase").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("text"))  # at most `longest` words
    order = (F.desc("score"), F.desc("a"), F.asc("text"))
    # A language may have any number of candidates: each of SALTS parts of them is cut to `top` rows before one task ranks what is left.
    part = F.row_number().over(W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order))
    chosen = land(lowest.join(spelled, "phrase").withColumn("place", part).filter(F.col("place") <= top).select("lang", "text", "a", "l", "r", "score"), "chosen")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return chosen.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
