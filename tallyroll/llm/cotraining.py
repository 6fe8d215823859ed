"""Quality by co-training: a classifier of the text and one of the metadata teach each other.

The text view sees only measurements of the content, the metadata view only language,
source and stated length. Both start from the same labelled texts. In every round each
view is fitted and calibrated on held-out labels and scores all unlabelled documents
once. Of the distinct texts among these, each view hands the share `SHARE` that it holds
most surely for good, and the same share at the other end, to the other view. Their
pseudo-labels are the calibrated probabilities themselves: a view that is sure of little,
as that of the metadata, hands on what it knows and no more. At the end the calibrated
views are combined (log odds added, the prior counted once) and score all documents.

The number of labels handed on grows with the documents. Fitting reads at most
`max_labelled` labelled texts and at most `max_labelled` / 4 pseudo-labelled ones of each
view and end, taken by a hash of their ids; those of one view together weigh half as much
as the labels, however many they are. The features of all documents are made once
and landed: numbers only, no text. Where labels of one id clash, the larger counts.
"""

from __future__ import annotations

import dataclasses
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import bytes_of, land
from tallyroll.llm.features import descend, known_labels, sigmoid
from tallyroll.llm.quality_rules import MEASURES, measure

MAX_LABELLED, ROUNDS = 8000, 2
#: Share of the distinct unlabelled texts that a view hands on at either end.
SHARE = 0.1
#: Weight of the pseudo-labels of one view, as a share of that of the labels.
TRUST = 0.5
_BUCKETS = {"lang": 8, "source": 32, "n_chars": 12}
TEXT_WIDTH, META_WIDTH = 18, sum(_BUCKETS.values())


def text_features(text: bytes) -> list[float]:
    """What the text view sees."""
    m = dict(zip(MEASURES, measure(text), strict=True))
    words, lines, size = max(1, m["n_words"]), max(1, m["n_lines"]), max(1, len(text))
    distinct = len(set(text.split())) / words
    digits = sum(text.count(b"%d" % d) for d in range(10)) / size
    shares = [m["n_symbols"] / words, text.count(b"!") / words, m["n_dup_lines"] / lines, m["n_repeat_words"] / words, m["n_shouted"] / words, 1 - distinct, digits]
    return [*shares, *(min(1.0, 4 * s) for s in shares), min(m["word_chars"] / words, 20) / 10, min(1, m["word_chars"] / words / 4), np.log1p(words) / 10, float(words < 20)]


def meta_columns(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """What the metadata view sees: the numbers of the columns that are 1."""
    out, start = [], 0
    for value, (name, buckets) in zip((lang, source, n_chars), _BUCKETS.items(), strict=True):
        if name == "n_chars":
            bucket = min(buckets - 1, max(0, int(value or 0)).bit_length() * buckets // 24)
        else:
            bucket = 0 if value is None else 1 + zlib.crc32(value.encode()) % (buckets - 1)
        out.append(start + bucket)
        start += buckets
    return out


def features(docs: DataFrame) -> DataFrame:
    """Landed: doc_id, text_view, meta_view, copy (a 64-bit hash of the text)."""
    rows = docs.select("doc_id", F.col("text"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = bytes_of(batch.column(1))
            texts = [text_features(t) for t in raw]
            copy = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw)).view(np.int64)
            meta = [meta_columns(*m) for m in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.list_(pa.float64())), pa.array(meta, pa.list_(pa.int32())), pa.array(copy)], names=["doc_id", "text_view", "meta_view", "copy"])

    return land(rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, text_view array<double>, meta_view array<int>, copy long"), "features")


def dense(meta: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(meta), META_WIDTH))
    for k, columns in enumerate(meta):
        out[k, columns] = 1
    return out


@dataclasses.dataclass
class View:
    """A linear classifier with a calibration of its log odds."""

    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (x @ self.weights[:-1] + self.weights[-1]) + self.offset


def _logistic(x: np.ndarray, y: np.ndarray, l2: float, steps: int, weigh: np.ndarray | None = None) -> np.ndarray:
    """Weights for probabilities y (labels are 0 and 1); `weigh` says how many rows each row stands for."""
    ones = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    keep = np.concatenate([np.full(x.shape[1], l2), [0.0]])
    own = np.ones(len(y)) if weigh is None else weigh
    return descend(lambda w: ones.T @ (own * (sigmoid(ones @ w) - y)) / max(1.0, own.sum()) + keep * w, np.zeros(x.shape[1] + 1), steps, 0.1)


def fit_view(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray, weigh: np.ndarray | None = None) -> View:
    """Fit, then calibrate on held-out rows."""
    view = View(_logistic(x, y, 1e-4, 500, weigh))
    if 0 < held_y.sum() < len(held_y):
        slope, offset = _logistic(view.log_odds(held_x)[:, None], held_y, 1e-3, 500)
        view.slope, view.offset = float(max(slope, 0.0)), float(offset)
    return view


def combined(text: View, meta: View, prior: float, text_x: np.ndarray, meta_x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of good quality: by text, by metadata, by both."""
    a, b = text.log_odds(text_x), meta.log_odds(meta_x)
    return sigmoid(a), sigmoid(b), sigmoid(a + b - prior)


def _arrays(batch: pa.RecordBatch, text_at: int) -> tuple[np.ndarray, np.ndarray]:
    return np.array(batch.column(text_at).to_pylist(), np.float64).reshape(-1, TEXT_WIDTH), dense(batch.column(text_at + 1).to_pylist())


@dataclasses.dataclass
class Handed:
    """What one view handed on at one end in one round: how many distinct texts, and how many of them were fitted on."""

    round_no: int
    teacher: str
    good: bool
    texts: int
    fitted: int


def hand_on(scored: DataFrame, round_no: int, most: int) -> tuple[DataFrame, list[Handed]]:
    """The chosen rows (teacher, p, h, copy), at most `most` of each view and end, and how many there were.

    `scored` has h (hash of the id), copy, by_text, by_meta; of equal texts one counts.
    """
    once = land(scored.groupBy("copy").agg(F.min(F.struct("h", "by_text", "by_meta")).alias("one")).select("copy", "one.*"), "distinct-texts")
    ends = once.agg(*[F.percentile_approx(f"by_{t}", F.array(F.lit(SHARE), F.lit(1 - SHARE)), 1000).alias(t) for t in ("text", "meta")]).first()
    parts, log = [], []
    for teacher in ("text", "meta"):
        if ends[teacher] is None:
            continue
        low, high = ends[teacher]
        for good in (False, True):
            p = F.col(f"by_{teacher}")
            sure = once.filter(p >= high if good else p <= low)
            chosen = sure.orderBy(F.xxhash64("copy"), "copy").limit(most).select(F.lit(teacher).alias("teacher"), p.alias("p"), "h", "copy")
            count = sure.count()
            parts.append(chosen)
            log.append(Handed(round_no, teacher, good, count, min(most, count)))
    return functools.reduce(DataFrame.unionAll, parts) if parts else None, log


def co_train(table: DataFrame, labels: DataFrame, label_col: str = "quality", max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> tuple[View, View, float, list[Handed]]:
    """The two views, the prior log odds, and what was handed on. With labels of one class or none, constant views.

    `table` is what `features` gives: null ids are scored and never fitted on, rows that
    repeat an id count once, an empty table gives constant views.
    """
    known = land(known_labels(labels, label_col), "labels")
    chosen = land(known.orderBy(F.xxhash64("of"), "of").limit(max_labelled), "sampled-labels")  # max_labelled rows at most: may be broadcast
    sample = table.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).groupBy("of").agg(F.first("label").alias("label"), F.min(F.struct("text_view", "meta_view")).alias("x"))
    rows = sorted(tuple(r) for r in sample.select("of", "label", "x.text_view", "x.meta_view").collect())
    y = np.array([r[1] for r in rows], np.float64)
    text_x, meta_x = np.array([r[2] for r in rows], np.float64).reshape(-1, TEXT_WIDTH), dense([r[3] for r in rows])
    if not len(y) or y.min() == y.max():
        prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0
        constant = lambda width: View(np.concatenate([np.zeros(width), [prior]]))
        return constant(TEXT_WIDTH), constant(META_WIDTH), prior, []
    held = np.arange(len(y)) % 4 == 3
    prior = float(np.log(y[~held].sum() + 1) - np.log((1 - y[~held]).sum() + 1))
    start = {"text": (text_x[~held], y[~held], np.ones((~held).sum())), "meta": (meta_x[~held], y[~held], np.ones((~held).sum()))}
    own, log = dict(start), []
    for round_no in range(rounds + 1):
        text = fit_view(own["text"][0], own["text"][1], text_x[held], y[held], own["text"][2])
        meta = fit_view(own["meta"][0], own["meta"][1], meta_x[held], y[held], own["meta"][2])
        if round_no == rounds:
            return text, meta, prior, log

        def run(batches: Iterator[pa.RecordBatch], text=text, meta=meta) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = _arrays(batch, 2)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sigmoid(text.log_odds(a))), pa.array(sigmoid(meta.log_odds(b)))], names=["doc_id", "copy", "by_text", "by_meta"])

        # One scoring pass a round; what is landed and joined are four numbers for each document.
        schema = f"doc_id {table.schema['doc_id'].dataType.simpleString()}, copy long, by_text double, by_meta double"
        scored = table.filter("doc_id IS NOT NULL").select("doc_id", "copy", "text_view", "meta_view").mapInArrow(run, schema)
        outside = scored.join(known.select("of"), F.col("doc_id") == F.col("of"), "left_anti").select(F.xxhash64("doc_id").alias("h"), "copy", "by_text", "by_meta")
        picked, found = hand_on(outside, round_no + 1, max(1, max_labelled // 4))
        log += found
        if picked is None:
            continue
        picked = land(picked, "handed-on")  # max_labelled rows at most: may be broadcast
        views = table.select(F.xxhash64("doc_id").alias("t_h"), F.col("copy").alias("t_copy"), "text_view", "meta_view")
        taken = views.join(F.broadcast(picked), (F.col("t_h") == F.col("h")) & (F.col("t_copy") == F.col("copy"))).groupBy("teacher", "h", "copy").agg(
            F.min("p").alias("p"), F.min(F.struct("text_view", "meta_view")).alias("x")).select("teacher", "copy", "h", "p", "x.text_view", "x.meta_view").collect()
        for teacher, pupil in (("text", "meta"), ("meta", "text")):
            some = sorted((r for r in taken if r.teacher == teacher), key=lambda r: (r.copy, r.h))
            if some:
                x = np.array([r.text_view for r in some], np.float64) if pupil == "text" else dense([r.meta_view for r in some])
                weight = np.full(len(some), TRUST * len(start[pupil][1]) / len(some))
                own[pupil] = tuple(np.concatenate(pair) for pair in zip(start[pupil], (x, np.array([r.p for r in some]), weight), strict=True))
    raise AssertionError("unreachable")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, p_text, p_meta, quality (both views), kept (quality >= threshold), from_text, from_meta (labels that each view handed on).

    Null and empty texts have the features of no words; null metadata has columns of its
    own. Rows with a null id are scored and never used for fitting; repeated rows are
    scored one by one; columns other than doc_id, text, lang, source and n_chars are not
    read; an empty table gives an empty one.
    """
    table = features(docs)
    text, meta, prior, log = co_train(table, labels, "quality", max_labelled, rounds)
    from_text, from_meta = (sum(x.texts for x in log if x.teacher == t) for t in ("text", "meta"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, both = combined(text, meta, prior, *_arrays(batch, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(a), pa.array(b), pa.array(both), pa.array(both >= threshold), *(pa.array(np.full(batch.num_rows, n, np.int64)) for n in (from_text, from_meta))],
                names=["doc_id", "p_text", "p_meta", "quality", "kept", "from_text", "from_meta"])

    return table.drop("copy").mapInArrow(run, f"doc_id {table.schema['doc_id'].dataType.simpleString()}, p_text double, p_meta double, quality double, kept boolean, from_text long, from_meta long")
