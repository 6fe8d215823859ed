"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Labels tell toxic from clean. Features are words and beginnings of words that labelled
toxic texts hold so much more often than clean ones that chance would hardly give one
such term among all. The
severity grades of toxic texts come from the data: the numbers of their words that hold
such terms are cut at their thirds into grades 1 to 3; clean texts have grade 0. Terms that
stand in nearly the same texts are one feature, so that its evidence counts once however
many of them a text holds: one of them tells as much as all. The model
has one weight for each feature, shared by all grades, and ordered thresholds
t1 <= t2 <= t3: P(grade >= k) = sigmoid(w . x - t_k). The expected severity is the sum
of these probabilities; a text is toxic if P(grade >= 1) >= 0.5.

Fitting reads at most `max_labelled` labelled texts (all that there are, if fewer),
taken by a hash of their ids; texts whose 3-word shingles are the same set are copies and
count once, all others stay apart. Each label's sampled texts
weigh as many as the label has in the whole table, so that P(grade >= 1) means the same
whether the sample is all there is or a small part of it. Terms are selected by Spark
over these texts; what reaches the driver is at most `max_terms` terms and the sampled
texts' counts of them. Every document is scored. Where labels of one id clash, the larger counts.
"""

from __future__ import annotations

import dataclasses
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.collocations import bitmap_of, in_bitmap
from tallyroll.llm.common import bytes_of, land, texts_of
from tallyroll.llm.features import Rows, descend, known_labels, sigmoid
from tallyroll.llm.jaccard import _odd, shingle_hashes

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that are terms beside the words themselves.
BEGINNINGS = (4, 5, 6, 7)
MAX_LABELLED, MAX_TERMS, GRADES = 8000, 1024, 3
#: Terms are one feature if of the sampled texts that hold one of two, at least this share holds both.
TOGETHER = 0.9


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings with a mark behind them."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def term_counts(text: str) -> Counter:
    """How often each term occurs in a text, in lower case."""
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for term in terms_of(word):
            out[term] += n
    return out


def feature(count: np.ndarray | float) -> np.ndarray | float:
    return 1 + np.log(count)


@dataclasses.dataclass
class OrdinalModel:
    """Weight and feature of each term, and ordered thresholds. A feature's count in a text is the largest of its terms'."""

    weights: dict[str, float]
    thresholds: list[float]
    features: dict[str, int] = dataclasses.field(default_factory=dict)

    def scorer(self) -> Callable[[str], float]:
        """A function that gives a text's linear score. It keeps which terms of the model a word holds, for so many words."""
        kept: dict[str, tuple[str, ...]] = {}
        weights, features = self.weights, self.features

        def level(text: str) -> float:
            hits: dict[str, int] = {}
            for word, n in Counter(_WORD.findall(text.lower())).items():
                own = kept.get(word)
                if own is None:
                    if len(kept) >= 1 << 18:
                        kept.clear()
                    own = kept[word] = tuple(t for t in terms_of(word) if t in weights)
                for term in own:
                    hits[term] = hits.get(term, 0) + n
            most: dict[int | str, tuple[int, float]] = {}
            for term, n in sorted(hits.items()):
                own = features.get(term, term)
                if own not in most or most[own][0] < n:
                    most[own] = (n, weights[term])
            return float(sum(w * feature(n) for n, w in most.values()))
        return level

    def at_least(self, levels: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, one row for each level."""
        return sigmoid(np.asarray(levels, np.float64)[:, None] - np.array(self.thresholds)[None, :])


def fit_ordinal(rows: Rows, grades: np.ndarray, top: int, l2: float = 1e-4, steps: int = 400, weigh: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximize the likelihood of the grades 0 .. top; thresholds ascend by construction. `weigh` says how many rows each row stands for."""
    d = rows.columns
    own_part = np.full(rows.rows, 1 / max(1, rows.rows)) if weigh is None else weigh / weigh.sum()

    def thresholds(x: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([x[:1], np.exp(x[1:])]))

    def gradient(x: np.ndarray) -> np.ndarray:
        t = thresholds(x[d:])
        above = sigmoid(rows.dot(x[:d])[:, None] - t[None, :])  # P(grade >= k)
        padded = np.concatenate([np.ones((rows.rows, 1)), above, np.zeros((rows.rows, 1))], axis=1)
        own = np.maximum(np.take_along_axis(padded, grades[:, None], 1) - np.take_along_axis(padded, grades[:, None] + 1, 1), 1e-12)[:, 0]
        slope = np.concatenate([np.zeros((rows.rows, 1)), above * (1 - above), np.zeros((rows.rows, 1))], axis=1)
        low, high = np.take_along_axis(slope, grades[:, None], 1)[:, 0], np.take_along_axis(slope, grades[:, None] + 1, 1)[:, 0]
        by_level = -(low - high) / own * own_part
        by_threshold = np.zeros(top)
        for k in range(top):
            by_threshold[k] = (((grades == k + 1) * low / own - (grades == k) * high / own) * own_part).sum()
        steps_down = np.cumsum(by_threshold[::-1])[::-1]  # each threshold holds all earlier steps
        steps_down[1:] *= np.exp(x[d + 1:])
        return np.concatenate([rows.transposed_dot(by_level) + l2 * x[:d], steps_down])

    found = descend(gradient, np.concatenate([np.zeros(d), [1.0], np.zeros(top - 1)]), steps, 0.1)
    return found[:d], thresholds(found[d:])


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, most: int) -> tuple[DataFrame, dict[int, int]]:
    """At most `most` labelled texts, half of them at most of one label: (doc_id, label, text), one of each group of copies, by a hash of the id.

    With them, how many such texts each label has in the whole table: labels without a
    document don't count, and copies are put together before the sample is taken. Rows
    that repeat an id with different texts are texts of their own.
    """
    known = land(known_labels(labels, label_col), "known-labels")
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Tasks hash the texts of labelled ids alone; the bitmap of these ids has a bounded size and lets few others pass.
    marks = docs.sparkSession.sparkContext.broadcast(bitmap_of(known.select(F.xxhash64(F.col("of").cast(kind)).alias("h")), ["h"]))

    def digests(texts: pa.Array, factors: list[np.uint64]) -> pa.Array:
        return pa.array([xxhash.xxh3_128_digest(shingle_hashes(t, 3, factors).tobytes()) for t in bytes_of(texts)], pa.binary())

    def with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _odd(1, 3)
        for batch in batches:
            some = batch.filter(pa.array(in_bitmap(batch.column(2).to_numpy(zero_copy_only=False)[:, None], *marks.value)))
            yield pa.RecordBatch.from_arrays([some.column(0), digests(some.column(1), factors)], names=["doc_id", "digest"])

    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = rows.withColumn("h", F.xxhash64("doc_id")).mapInArrow(with_digest, f"doc_id {kind}, digest binary")
    groups = land(keyed.join(known, F.col("doc_id") == F.col("of")).groupBy("digest", "label").agg(F.min("doc_id").alias("one")), "labelled-groups")
    full = dict(tuple(r) for r in groups.groupBy("label").count().collect())
    ranked = [groups.filter(F.col("label") == k).orderBy(F.xxhash64("one"), "one", "digest").limit(most // 2) for k in (0, 1)]
    chosen = land(ranked[0].unionAll(ranked[1]), "sampled-labels")
    # The sample has `most` rows at most, so the large table is not shuffled for it.
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("one")).select(F.col("doc_id").cast("long"), "label", "text", "digest")

    def of_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _odd(1, 3)
        for batch in batches:  # rows that repeat an id may hold other texts
            yield batch.filter(pc.equal(batch.column(3), digests(batch.column(2), factors)))

    same = found.mapInArrow(of_group, "doc_id long, label int, text string, digest binary")
    return land(same.groupBy("digest", "label").agg(F.min(F.struct("doc_id", "text")).alias("one")).select("one.doc_id", "label", "one.text"), "sample"), full


def sample_terms(sample: DataFrame) -> DataFrame:
    """(term, k, n): in how many sampled texts a term is, and in how many toxic ones; summed up in the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: Counter = Counter()
            toxic: Counter = Counter()
            for label, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                own = term_counts(text).keys()
                texts.update(own)
                if label:
                    toxic.update(own)
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array(texts.keys(), pa.string()), pa.array([toxic[t] for t in texts], pa.int64()), pa.array(texts.values(), pa.int64())], names=["term", "k", "n"])

    return sample.select("label", "text").mapInArrow(run, "term string, k long, n long").groupBy("term").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))


def telling_terms(sample: DataFrame, clean: int, toxic: int, max_terms: int, min_texts: int) -> list[str]:
    """At most `max_terms` terms, the most telling first: in `min_texts` toxic texts at least, with a share of toxic texts above the sample's that chance hardly gives."""
    texts = land(sample_terms(sample), "sample-terms")
    # How likely chance is to give a term goes by the texts looked at, so here the base share is the sample's; a share
    # is above it exactly if the weighted share is above the whole table's.
    base = toxic / (toxic + clean)
    share = F.col("k") / F.col("n")
    # n times the divergence of the term's toxic share from the base share bounds minus the log of the chance of such a share.
    part = lambda p, q: F.when(p > 0, p * F.log(p / q)).otherwise(0.0)
    told: Column = F.col("n") * (part(share, F.lit(base)) + part(1 - share, F.lit(max(1 - base, 1e-9))))
    tested = texts.count()
    telling = texts.filter((share > base) & (F.col("k") >= min_texts)).withColumn("told", told).filter(F.col("told") >= (float(np.log(max(1, tested))) + 2 if clean else 0.0))
    return [r[0] for r in telling.orderBy(F.desc("told"), "term").limit(max_terms).select("term").collect()]


def features_of(held: np.ndarray) -> np.ndarray:
    """The feature of each column (term) of `held` (text x term): that of the first column that stands in nearly the same texts, else its own."""
    own = np.full(held.shape[1], -1, np.int64)
    both = held.T.astype(np.float32) @ held.astype(np.float32)
    size = np.diag(both)
    leaders: list[int] = []
    for k in range(held.shape[1]):
        near = [n for n, at in enumerate(leaders) if both[k, at] >= TOGETHER * (size[k] + size[at] - both[k, at])]
        if near:
            own[k] = near[0]
        else:
            own[k] = len(leaders)
            leaders.append(k)
    return own


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS, min_texts: int = 3) -> OrdinalModel:
    """Fit on labelled documents. Without toxic labels, the model finds nothing toxic."""
    sample, full = labelled_sample(docs, labels, label_col, max_labelled)
    sizes = dict(tuple(r) for r in sample.groupBy("label").count().collect())
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not toxic:
        return OrdinalModel({}, [20.0] * GRADES)
    names = telling_terms(sample, clean, toxic, max_terms, min_texts)
    if not names:
        return OrdinalModel({}, [20.0] * GRADES)
    vocabulary = {term: k for k, term in enumerate(names)}

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked, columns, counts = [], [], []
            for text in texts_of(batch.column(2)):
                own, words = Counter(), 0
                for word, n in Counter(_WORD.findall(text.lower())).items():
                    held = [vocabulary[t] for t in terms_of(word) if t in vocabulary]
                    words += n * bool(held)
                    for k in held:
                        own[k] += n
                marked.append(words)
                columns.append(np.array(sorted(own), np.int32).tobytes())
                counts.append(np.array([own[k] for k in sorted(own)], np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marked, pa.int64()), pa.array(columns, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "label", "marked", "k", "n"])

    rows = sample.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(packed, "doc_id long, label int, marked long, k binary, n binary")
    found = sorted(tuple(r) for r in rows.collect())  # max_labelled rows of packed numbers at most
    columns, counts = ([np.frombuffer(r[k], np.int32) for r in found] for k in (3, 4))
    row = np.repeat(np.arange(len(found)), [len(c) for c in columns])
    column, count = np.concatenate(columns), np.concatenate(counts)
    label, marked = (np.array([r[k] for r in found], np.int64) for k in (1, 2))
    grades = label.copy()
    cuts = np.quantile(marked[label == 1], [k / GRADES for k in range(1, GRADES)])
    grades[label == 1] = 1 + (marked[label == 1][:, None] > cuts[None, :]).sum(axis=1)
    weigh = np.where(label == 1, full[1] / toxic, full.get(0, 0) / max(1, clean))
    held = np.zeros((len(found), len(names)), bool)
    held[row, column] = True
    feature_no = features_of(held)
    most = np.zeros((len(found), feature_no.max() + 1), np.int64)
    np.maximum.at(most, (row, feature_no[column]), count)
    row, column = np.nonzero(most)
    weights, thresholds = fit_ordinal(Rows(row, column, feature(most[row, column]), len(found), most.shape[1]), grades, GRADES, weigh=weigh)
    own = {t: int(k) for t, k in zip(names, feature_no, strict=True) if weights[k]}
    return OrdinalModel({t: float(weights[k]) for t, k in own.items()}, [float(t) for t in thresholds], own)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, p_toxic, severity (expected grade), grade (the largest with P(grade >= k) >= 0.5), toxic.

    A null or empty text has no terms and the score of a text without any. Null ids stay
    null, repeated rows are scored one by one, other columns are not read, an empty
    table gives an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = model.scorer()
        for batch in batches:
            p = model.at_least(np.array([level(t) for t in texts_of(batch.column(1))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p[:, 0]), pa.array(p.sum(axis=1)), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(p[:, 0] >= 0.5)], names=[id_col, "p_toxic", "severity", "grade", "toxic"])

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, p_toxic double, severity double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text is not toxic. Nothing is joined or shuffled.

    Null and empty texts have no terms and are judged as such; null ids, repeated rows
    and columns of any name pass through; an empty table gives an empty one.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = model.scorer()
        for batch in batches:
            p = model.at_least(np.array([level(t) for t in texts_of(batch.column(at))]))
            yield batch.filter(pa.array(p[:, 0] < 0.5))

    return docs.mapInArrow(run, docs.schema)
