"""Token counts of a sentence-piece BPE model without making tokens.

A text is a linked list of characters. A heap holds the adjacent pairs whose joined
text is a piece, by rank (best score first) and then by place. The lowest pair is
popped and merged while there is one; pairs whose symbols have changed since they
were pushed are passed over. The count is the number of symbols at the start minus
the number of merges, plus the further bytes of characters that are no piece (they
fall back to one token for each byte). No identifier is emitted.

Pieces never continue over the start of a word (checked when the model is read), so
words are counted one by one and the counts of short ones are kept.
"""

from __future__ import annotations

import functools
import heapq
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyroll.llm.common import by_batch, texts_of

#: Fixed value: the character that stands for a space.
SPACE = "▁"
WORDS_KEPT, LONGEST_KEPT = 1 << 20, 64
_NORMAL, _UNKNOWN, _CONTROL, _OWN, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5  # kinds of pieces in the file format


def _fields(data: bytes):
    """(number, value) of a protocol buffer message: bytes for length-delimited fields, numbers for the rest."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if b < 0x80:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else varint(at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class PieceCounter:
    """Token counts by one sentence-piece model file of the BPE kind."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = f.read()
        scores: dict[str, float] = {}
        settings = {3: 1, 4: 1, 5: 1, 2: b""}  # dummy prefix, spaces removed, spaces escaped, character map
        fallback = bpe = False
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                kind = piece.get(3, _NORMAL)
                if kind == _NORMAL:
                    scores[piece[1].decode()] = struct.unpack("<f", piece.get(2, bytes(4)))[0]
                elif kind in (_OWN, _UNUSED):
                    raise ValueError(f"{path}: user-defined or unused pieces")
            elif number == 2:
                trainer = dict(_fields(value))
                bpe, fallback, suffix = trainer.get(3, 1) == 2, bool(trainer.get(35, 0)), bool(trainer.get(24, 0))
            elif number == 3:
                settings |= dict(_fields(value))
        if not bpe or not fallback or suffix or settings[2] or settings[4] or not settings[3] or not settings[5]:
            raise ValueError(f"{path}: not a BPE model with byte fallback, dummy prefix and identity normalization")
        if any(SPACE in piece.lstrip(SPACE) for piece in scores):
            raise ValueError(f"{path}: pieces that go on over the start of a word")
        ranks = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {piece: ranks[s] for piece, s in scores.items()}
        self._words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self._kept: dict[str, int] = {}

    def merged_count(self, word: str) -> int:
        """Tokens of one word, its spaces escaped."""
        ranks, n = self.ranks, len(word)
        symbols: list[str] = list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, 2) for i in range(n - 1) if (p := word[i:i + 2]) in ranks]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one of the two has been merged meanwhile
            joined = symbols[i] + symbols[j]
            if joined not in ranks:
                continue
            symbols[i], symbols[j] = joined, ""
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get(joined + symbols[k])) is not None:
                    heapq.heappush(heap, (rank, i, size + len(symbols[k])))
            if (h := before[i]) >= 0 and (rank := ranks.get(symbols[h] + joined)) is not None:
                heapq.heappush(heap, (rank, h, size + len(symbols[h])))
        fallen = sum(len(s.encode()) - 1 for s in symbols if len(s) == 1 and s not in ranks)
        return n - merges + fallen

    def _word(self, word: str) -> int:
        found = self._kept.get(word)
        if found is None:
            found = self.merged_count(word)
            if len(word) <= LONGEST_KEPT:
                if len(self._kept) >= WORDS_KEPT:
                    self._kept.clear()
                self._kept[word] = found
        return found

    def count(self, text: str) -> int:
        """Tokens of a whole text, without begin and end."""
        if not text:
            return 0
        kept, total = self._kept, 0
        for word in self._words.findall(SPACE + text.replace(" ", SPACE)):
            found = kept.get(word)
            total += self._word(word) if found is None else found
        return total


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    """One counter for each worker process."""
    return PieceCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_bytes (of the text in UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows
    are rows of their own; other columns are not read; an empty table gives an empty one.
    """
    def make():
        own = counter(path)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch.column(1))
            n = [own.count(t) for t in texts]
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])
        return one

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(by_batch(make), f"`{id_col}` {rows.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
