"""Packing into fixed windows with a controlled mixture: deficit round-robin over source queues.

Every source with a fair share of the tokens is a queue, its documents one after the
other; smaller sources share one queue, in which they take turns by slices of a 32nd of
a window: a slice's place is its virtual time, the share of its source's tokens before
it, so that at any time every small source has served its share of its tokens but for
one slice. In every round each queue's counter gains its
quantum (the window's length times the queue's target share) and the queue serves the
whole tokens nearest to its counter; what is left over, plus or minus half a token, is
the deficit it carries into the next round. Because tokens may be cut freely, the
state after w rounds is a formula, round(target level after w windows), so a task can
begin at any window: deficits carry over windows and over partitions without a pass
over the earlier ones. The rounds laid end to end are one stream of tokens, cut into
sequences of the window's length, so only the very last sequence needs padding.

Where target shares are given, a queue that runs dry leaves its share to the others
in proportion; without them every source's target is its share of all tokens, and all
queues run dry together.

Two passes. The first tokenizes every document once and lands the ids in the shared
folder with the number of tokens that precede them in their task and source. Sums by
task and source give every document's place in its queue. The second pass reads the
landed ids and cuts them; ids of sources with a queue of their own are never shuffled
while the table of sums is small enough to be broadcast. Slices of small sources are
sorted by virtual time, with their ids, in ranges; sums by range give their places.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.bpe import WORDS, byte_alphabet
from tallyroll.llm.common import land, texts_of

#: A source below this share of the tokens (8 tokens of a window of 2048) has no queue of its own unless a mixture names it, so without a mixture there are 257 queues at most.
OWN_SHARE = 1 / 256
#: Slices of small sources in a window's length.
SLICES = 32
#: Texts of more characters are tokenized in parts.
LONG = 1 << 16
#: A single space between two visible characters.
_CUT = re.compile(r"(?<=\S) (?=\S)")


class LibraryTokens:
    """Token ids as the tokenizers library gives them.

    For a byte-level BPE file whose ids are in merge order (checked when it is read),
    texts without added tokens go through tiktoken with that file's vocabulary, which
    makes the same ids faster; all others go through the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.ranked = self._ranked(spec)

    @staticmethod
    def _ranked(spec: dict):
        import tiktoken

        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or any(
                model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            return None
        merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        alphabet = byte_alphabet()
        if merged != sorted(merged) or len(merged) + 256 != len(model["vocab"]) or min(merged, default=256) < 256:
            return None
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()}
        return tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        """The text's ids, packed."""
        if self.ranked is None or any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()
        if len(text) <= LONG:
            return np.array(self.ranked(text), dtype=self.kind).tobytes()
        # Long texts in parts that start at single spaces, where no word of the pattern continues.
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + LONG // 2)
            end = cut.start() if cut else len(text)
            part = text[at:end]
            out.append(np.array(self.ranked(part) if len(part) <= LONG else self.library.encode(part, add_special_tokens=False).ids, dtype=self.kind).tobytes())
            at = end
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def library_tokens(path: str) -> LibraryTokens:
    """One for each worker process."""
    return LibraryTokens(path)


_TURNS = 1 << 21  # numbers of rounds times queues looked at together


class Rounds:
    """Which queue serves which tokens in which round.

    `totals` are the queues' tokens, `weights` their targets. Level v means that queue q
    has served min(totals[q], weights[q] * v); after w rounds w * length tokens are served.
    """

    def __init__(self, totals: list[int], weights: list[float], length: int):
        self.totals, self.weights, self.length = np.array(totals, np.int64), np.array(weights, np.float64), length
        self.all = int(self.totals.sum())
        self.rounds = -(-self.all // length)
        dry = self.totals / self.weights
        self.levels = np.concatenate([[0.0], np.unique(dry)])
        self.served_at = np.array([np.minimum(self.totals, self.weights * v).sum() for v in self.levels])

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens that each queue has served before the given rounds: one row for each round."""
        level = np.interp(rounds * float(self.length), self.served_at, self.levels)
        out = np.minimum(np.floor(np.outer(level, self.weights) + 0.5).astype(np.int64), self.totals)
        out[rounds >= self.rounds] = self.totals
        return out

    def served_by(self, queues: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Tokens that the given queues have served before the given rounds, pair by pair; the same numbers as in `served`."""
        level = np.interp(rounds * float(self.length), self.served_at, self.levels)
        out = np.minimum(np.floor(level * self.weights[queues] + 0.5).astype(np.int64), self.totals[queues])
        return np.where(rounds >= self.rounds, self.totals[queues], out)

    def round_of(self, queues: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The rounds in which the given queues serve their tokens of the given numbers, pair by pair."""
        level = (tokens + 0.5) / self.weights[queues]
        found = np.interp(level, self.levels, self.served_at) // self.length
        found = np.clip(found.astype(np.int64), 0, self.rounds - 1)
        while True:
            early = self.served_by(queues, found + 1) <= tokens
            late = self.served_by(queues, found) > tokens
            if not early.any() and not late.any():
                return found
            found = found + early - late

    def pieces(self, queues: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How documents are cut whose tokens are first .. first + count - 1 of their queues.

        Per piece: document, start in the document, length, place in the stream of all rounds.
        """
        begin, end = self.round_of(queues, firsts), self.round_of(queues, firsts + counts - 1)
        # A queue that serves less than a token in a round skips rounds; then its tokens are looked at, not the rounds between them.
        sparse = end - begin >= counts
        docs, rounds = [], []
        for k in np.flatnonzero(sparse):
            own = np.unique(self.round_of(np.full(counts[k], queues[k]), np.arange(firsts[k], firsts[k] + counts[k])))
            docs.append(np.full(len(own), k))
            rounds.append(own)
        dense = np.flatnonzero(~sparse)
        n = (end - begin + 1)[dense]
        docs.append(np.repeat(dense, n))
        rounds.append(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[dense], n))
        doc, turn = np.concatenate(docs), np.concatenate(rounds)
        # What all queues have served before each round, once for each round that occurs.
        turns, at = np.unique(turn, return_inverse=True)
        starts, lengths, places = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
        by_turn = np.argsort(at, kind="stable")
        step = max(1, _TURNS // len(self.totals))
        for low in range(0, len(turns), step):
            before, after = self.served(turns[low:low + step]), self.served(turns[low:low + step] + 1)
            ahead = np.cumsum(after - before, axis=1) - (after - before) + before.sum(axis=1)[:, None]
            own = by_turn[np.searchsorted(at, low, sorter=by_turn):np.searchsorted(at, low + step, sorter=by_turn)]
            row, queue = at[own] - low, queues[doc[own]]
            starts[own] = np.maximum(before[row, queue], firsts[doc[own]])
            lengths[own] = np.minimum(after[row, queue], firsts[doc[own]] + counts[doc[own]]) - starts[own]
            places[own] = ahead[row, queue] + starts[own] - before[row, queue]
        full = lengths > 0
        doc, starts, lengths, places = doc[full], starts[full], lengths[full], places[full]
        # Cut again where a sequence ends.
        n = (places + lengths - 1) // self.length - places // self.length + 1
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        doc, starts, lengths, places = np.repeat(doc, n), np.repeat(starts, n), np.repeat(lengths, n), np.repeat(places, n)
        begin = np.maximum(places, (places // self.length + k) * self.length)
        stop = np.minimum(places + lengths, (places // self.length + k + 1) * self.length)
        return doc, starts + begin - places - firsts[doc], stop - begin, begin


def tokenize(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Per row: doc_id, source, n (tokens with the end id), ids (packed), part, and `ahead`: the tokens of its source before it in its part."""
    rows = docs.select("doc_id", "source", "text")
    kind = rows.schema[0].dataType.simpleString()

    def run(batches):
        own, part = library_tokens(path), TaskContext.get().partitionId()
        end, ahead = np.array([end_id], own.kind).tobytes(), defaultdict(int)
        for batch in batches:
            packed = [own.encode(t) + end for t in texts_of(batch.column(2))]
            n = [len(p) // own.kind.itemsize for p in packed]
            sources, before = batch.column(1).to_pylist(), []
            for s, k in zip(sources, n, strict=True):
                before.append(ahead[s])
                ahead[s] += k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(packed, pa.binary()), pa.array([part] * len(n), pa.int32()), pa.array(before, pa.int64())],
                names=["doc_id", "source", "n", "ids", "part", "ahead"])

    return rows.mapInArrow(run, f"doc_id {kind}, source string, n long, ids binary, part int, ahead long")


def in_turns(pool: DataFrame, size: int) -> DataFrame:
    """Slices of documents in the order of their virtual time: doc_id, source, n, ids, queue, first, skip, size.

    `pool` has doc_id, source, n, ids, queue, before (tokens of the source before the
    document) and total (the source's tokens). A source's tokens are cut into slices of
    `size`; a slice's virtual time lies at the source's phase, a hash of its name, of the
    stretch that the slice takes, so that sources of one slice are spread over the queue.
    """
    spark, kind = pool.sparkSession, pool.schema["doc_id"].dataType.simpleString()
    rows = pool.select("doc_id", "source", "n", "ids", "queue", "before", "total", (F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / (1 << 20)).alias("phase"))

    def cut(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                n, before, total, phase = (np.array(batch.column(k).to_pylist(), np.float64 if k == 7 else np.int64) for k in (2, 5, 6, 7))
                grid = before // size
                count = (before + n - 1) // size - grid + 1
                row = np.repeat(np.arange(len(n)), count)
                k = np.repeat(grid, count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin, end = np.maximum(before[row], k * size), np.minimum((before + n)[row], (k + 1) * size)
                own = np.minimum((k + 1) * size, total[row]) - k * size
                time = (k * size + phase[row] * own) / total[row]
                skip, ids = begin - before[row], batch.column(3).to_pylist()
                width = [len(p) // t for p, t in zip(ids, n.tolist(), strict=True)]
                parts = [ids[r][a * width[r]:b * width[r]] for r, a, b in zip(row.tolist(), skip.tolist(), (skip + end - begin).tolist(), strict=True)]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(n[row]), pa.array(parts, pa.binary()), batch.column(4).take(take), pa.array(time), pa.array(begin), pa.array(skip), pa.array(end - begin)],
                    names=["doc_id", "source", "n", "ids", "queue", "time", "at", "skip", "size"])

    # Written once, so that the ranges are drawn and filled from the same rows.
    slices = land(rows.mapInArrow(cut, f"doc_id {kind}, source string, n long, ids binary, queue int, time double, at long, skip long, size long"), "packing-slices")

    def run(batches):
        part, ahead = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = np.array(batch.column(8).to_pylist(), np.int64)
            before = ahead + np.cumsum(own) - own
            ahead += int(own.sum())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 1, 2, 3, 4, 7, 8)), pa.array(before), pa.array([part] * len(own), pa.int32())],
                                             names=["doc_id", "source", "n", "ids", "queue", "skip", "size", "ahead", "range"])

    order = ["time", "source", "at"]
    turns = land(slices.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, f"doc_id {kind}, source string, n long, ids binary, queue int, skip long, size long, ahead long, range int"), "packing-turns")
    sums, bases, base = sorted(tuple(r) for r in turns.groupBy("range").agg(F.sum("size")).collect()), [], 0  # one row for each range
    for part, n in sums:
        bases.append((part, base))
        base += n
    bases = spark.createDataFrame(bases, "b_range int, base long")
    return turns.join(F.broadcast(bases), F.col("range") == F.col("b_range")).select("doc_id", "source", "n", "ids", "queue", (F.col("base") + F.col("ahead")).alias("first"), "skip", "size")


def pack(docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, mixture: dict[str, float] | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length, source.

    `path` is the tokenizer's file; every document ends with `end_id`. `mixture` gives
    target weights to sources, each of which has a queue of its own then; sources that it
    doesn't name, and all of them without it, weigh as many tokens as they have. padded_length is the length of
    the piece's sequence with padding: `length`, but a last sequence whose length is a
    power of two is left as it is.

    Null and empty texts are documents of the end id alone. A null source is a source.
    Null doc_ids stay null, repeated rows are documents of their own, other columns are
    not read, and an empty table gives no pieces.
    """
    spark = docs.sparkSession
    landed = land(tokenize(docs, path, end_id), "packing-ids")
    sums = land(landed.groupBy("part", "source").agg(F.sum("n").alias("n")), "packing-sums")
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    total = by_source.agg(F.sum("n")).first()[0] or 0
    kind = landed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long, source string"
    if not total:
        return spark.createDataFrame([], schema)
    mixture = dict(mixture or {})
    if any(w <= 0 for w in mixture.values()):
        raise ValueError("the weights of a mixture are positive")
    # A source with the given share of the tokens: 256 rows at most, and as many named ones.
    own = by_source.filter((F.col("n") >= total * OWN_SHARE) | F.coalesce(F.col("source").isin(list(mixture)), F.lit(False)))
    named = sorted((tuple(r) for r in own.collect()), key=lambda r: (r[0] is None, r[0]))
    rest = total - sum(n for _, n in named)
    totals = [n for _, n in named] + [rest] * (rest > 0)
    weights = [mixture.get(s, n / total) for s, n in named] + [rest / total] * (rest > 0)
    rounds = Rounds(totals, weights, length)
    queues = spark.createDataFrame([(s, k) for k, (s, _) in enumerate(named)], "source string, queue int")
    earlier = Window.partitionBy("source").orderBy("part")
    bases = sums.select("part", "source", (F.sum("n").over(earlier) - F.col("n")).alias("base"))
    bases = bases.join(F.broadcast(queues), bases["source"].eqNullSafe(queues["source"]), "left").select(
        F.col("part").alias("b_part"), bases["source"].alias("b_source"), F.coalesce("queue", F.lit(len(named))).alias("queue"), "base")
    bases = land(bases, "packing-bases")
    placed = landed.join(bases, (landed["part"] == bases["b_part"]) & landed["source"].eqNullSafe(bases["b_source"])).select(
        "doc_id", "source", "n", "ids", "queue", (F.col("base") + F.col("ahead")).alias("first"))
    if rest:
        small = by_source.select(F.col("source").alias("t_source"), F.col("n").alias("total"))
        pool = placed.filter(F.col("queue") == len(named)).withColumnRenamed("first", "before")
        pool = in_turns(pool.join(small, pool["source"].eqNullSafe(small["t_source"])), max(1, length // SLICES))
        placed = placed.filter(F.col("queue") < len(named)).withColumns({"skip": F.lit(0).cast("long"), "size": F.col("n")}).unionAll(pool)
    else:
        placed = placed.withColumns({"skip": F.lit(0).cast("long"), "size": F.col("n")})

    last = rounds.all - (rounds.rounds - 1) * length
    padded_last = last if last & (last - 1) == 0 else length

    def run(batches):
        for batch in batches:
            packed = batch.column(3).to_pylist()
            n, queue, first, skip = (np.array(batch.column(k).to_pylist(), np.int64) for k in (7, 4, 5, 6))
            if not len(n):
                continue
            row, start, size, place = rounds.pieces(queue, first, n)
            crcs = np.empty(len(row), np.int64)
            views = [memoryview(np.frombuffer(p, np.dtype(f"<u{len(p) // k}")).astype("<u4")).cast("B") for p, k in zip(packed, n.tolist(), strict=True)]
            for at, (k, a, b) in enumerate(zip(row.tolist(), (4 * start).tolist(), (4 * (start + size)).tolist(), strict=True)):
                crcs[at] = zlib.crc32(views[k][a:b])
            start += skip[row]
            sequence, row = place // length, pa.array(row)
            padded = np.where(sequence == rounds.rounds - 1, padded_last, length)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), pa.array(start), pa.array(size), pa.array(crcs), batch.column(2).take(row), pa.array(sequence), pa.array(place % length), pa.array(padded.astype(np.int64)), batch.column(1).take(row)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length", "source"])

    return placed.mapInArrow(run, schema)
