"""Rule-based text quality as a ledger of failure bits.

Every rule is evaluated once for each text. The ledger keeps the measurements and one
bit for each failed rule; no verdict is stored. A policy is a named version with a
mask of the rules that it enforces; applying one, and telling what each rule alone
costs (ablations), are bitwise operations on the ledger, without reading a text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import by_batch, bytes_of

#: Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouted")
#: Rules by bit: the text fails where the condition holds (integers only, so that SQL elsewhere gives the same).
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 50 * n_words"),
    ("repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_shouted > 50 * n_words"),
    ("short_words", "2 * word_chars < 5 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
)
BITS = {name: 1 << n for n, (name, _) in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_windows"]
#: Policies by version: the bits they enforce.
POLICIES = {"base": BASE, "v1": BASE | BITS["symbols"] | BITS["repeated_lines"], "v2": sum(BITS.values())}
PRODUCTION = "v2"


def repeated_window_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of `width` words (a power of two) which the text has twice or more. Exact: ranks are doubled, not hashed."""
    n = len(words)
    if n <= width:
        return 0
    known: dict[bytes, int] = {}
    rank = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    size, windows = 1, None
    while size < width:
        _, windows, counts = np.unique(rank[:-size] * (n + 1) + rank[size:], return_inverse=True, return_counts=True)
        if len(counts) == len(windows):
            return 0  # no two equal windows of this size, so none of a larger one
        rank, size = windows, size * 2
    twice = counts[windows] > 1
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text in UTF-8, in the order of MEASURES. Words are runs of anything but ASCII white space."""
    words = text.split()  # of bytes: the six ASCII white-space characters
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    continued = len(text.translate(None, bytes(b for b in range(256) if not 0x80 <= b < 0xC0)))
    chars = sum(map(len, words)) - continued
    symbols = sum(text.count(c.encode()) for c in SYMBOLS)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_window_words(words), len(lines), sum(map(bytes.isupper, words))


def failure_bits() -> Column:
    """One bit for each rule that fails."""
    bits = F.lit(0).cast("long")
    for name, condition in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the measurements, `failed` (bits).

    A null text is the empty text: no words, so `few_words` fails. Null ids stay null,
    repeated rows are rows of their own, other columns are not read, an empty table
    gives an empty one.
    """
    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([measure(t) for t in bytes_of(batch.column(1))], dtype=np.int64)
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, k]) for k in range(len(MEASURES)))], names=[id_col, *MEASURES])
        return one

    rows = docs.select(id_col, text_col)
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInArrow(by_batch(make), schema).withColumn("failed", failure_bits())


def passes(policy: str = PRODUCTION) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """Per policy and enforced rule: `failing` rows, rows that only this rule rejects (`alone`), and `rejected` rows of the policy.

    The ledger is reduced to counts by bit pattern (2^rules at most) before policies are applied.
    """
    patterns = rows.groupBy("failed").agg(F.count("*").alias("rows"))
    masks = rows.sparkSession.createDataFrame([(p, mask, name, bit) for p, mask in POLICIES.items() for name, bit in BITS.items() if mask & bit], "policy string, mask long, rule string, bit long")
    enforced = F.col("failed").bitwiseAND(F.col("mask"))
    hit = patterns.join(masks, F.col("failed").bitwiseAND(F.col("mask")) != 0)
    counted = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))
    return hit.groupBy("policy", "rule").agg(
        counted(enforced.bitwiseAND(F.col("bit")) != 0).alias("failing"), counted(enforced == F.col("bit")).alias("alone"), F.sum("rows").alias("rejected"))


def keep_passing(docs: DataFrame, policy: str = PRODUCTION, text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text passes the policy. Rows pass one by one: nothing is joined or shuffled."""
    at, mask = docs.columns.index(text_col), POLICIES[policy]
    enforced = [(compile(condition.replace("AND", "and"), name, "eval"), BITS[name]) for name, condition in RULES]

    def bits(text: bytes) -> int:
        names = dict(zip(MEASURES, measure(text), strict=True))
        return sum(bit for code, bit in enforced if eval(code, {}, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bits(t) & mask == 0 for t in bytes_of(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
