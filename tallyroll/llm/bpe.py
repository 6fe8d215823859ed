"""Byte-level BPE: exact encoding by backtracking over longest matches, decoding by an offset table.

A text is encoded piece by piece (a piece is what the tokenizer's word pattern
yields). Within a piece an Aho-Corasick automaton over all tokens gives the longest
token at every position in one pass. The encoder walks from left to right, takes the
longest token there, and asks a table of compatible pairs whether BPE merges would
ever leave that token beside the one before it. If not, it tries the next shorter
token (the longest token that is a proper prefix), and where none is left it steps
back one token and marks the position as dead. A sequence of pairwise compatible
tokens that covers the piece is the sequence that the merges give; every position is
marked at most once, so the work is linear in the piece.

Decoding gathers the tokens' bytes from one flat array by (offset, length).
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyroll.llm.common import by_batch, texts_of

#: Splits at single spaces between two visible characters. No word of the pattern reaches over such a place.
_UNITS = re.compile(r"(?<=\S) (?=\S)")
#: Fixed value: the word pattern of the published byte-level vocabulary, which the file names only as "use_regex".
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Units kept in a worker, and the longest unit kept; the memory of a worker is bounded by their product.
UNITS_KEPT, LONGEST_KEPT = 1 << 20, 64
_GATHER = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class OffsetTable:
    """Byte strings by number, laid end to end; `render` joins those of a sequence of numbers."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def render(self, numbers: np.ndarray) -> bytes:
        parts = []
        for at in range(0, len(numbers), _GATHER):  # the index array stays small however long the text is
            some = numbers[at:at + _GATHER]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            index = np.repeat(self.starts[some] - (ends - lengths), lengths)
            index += np.arange(len(index))
            parts.append(self.flat[index].tobytes())
        return b"".join(parts)


class BacktrackingBpe:
    """The tokenizer of one byte-level BPE file in the JSON format of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path}: not a byte-level BPE file without prefix space and normalizer")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        raw = lambda token: bytes(alphabet[c] for c in token)
        # Own numbers: bytes first, then the tokens in the order of their merges, so that number order is rank order.
        self.strings = [bytes([b]) for b in range(256)]
        self.left, self.right = list(range(256)), list(range(256))
        number = {s: n for n, s in enumerate(self.strings)}
        spelled = {c: number[bytes([b])] for c, b in alphabet.items()}
        self.merged: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair, token = (spelled[a], spelled[b]), a + b
            if token not in spelled:
                spelled[token] = len(self.strings)
                self.strings.append(raw(token))
                self.left.append(pair[0])
                self.right.append(pair[1])
            self.merged[pair] = spelled[token]
        self.lengths = [len(s) for s in self.strings]
        self.ids = np.array([vocab[t] for t, _ in sorted(spelled.items(), key=lambda x: x[1])], dtype=np.uint32)
        self._number = {s: n for n, s in enumerate(self.strings)}
        self._shorter: dict[int, int] = {}
        self._fit: dict[tuple[int, int], bool] = {}
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n, s in enumerate(self.strings):
            if n >= 256:
                self.matcher.add_word(s.decode("latin-1"), n)
        self.matcher.make_automaton()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] and not t["special"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that strip or match words only")
        self._added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words = regex.compile(WORDS)
        strings = {i: raw(t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        self.table = OffsetTable([strings.get(i, b"") for i in range(max(strings) + 1)])
        self.decimals = OffsetTable([b"%d," % i for i in range(max(strings) + 1)])
        self._kept: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one; -1 if there is none."""
        found = self._shorter.get(token)
        if found is None:
            s = self.strings[token]
            found = self._shorter[token] = next((n for k in range(len(s) - 1, 0, -1) if (n := self._number.get(s[:k])) is not None), -1)
        return found

    def compatible(self, first: int, second: int) -> bool:
        """Whether merges leave these two tokens side by side; looked up in a table that fills as pairs are met."""
        found = self._fit.get((first, second))
        if found is None:
            if len(self._fit) >= 1 << 20:
                self._fit.clear()
            found = self._fit[first, second] = self._undone(first, second)
        return found

    def _undone(self, a: int, b: int) -> bool:
        """Undo the merges inside both tokens, the latest first. The pair at the border must never have had a merge that comes before the one just undone."""
        before = 1 << 60
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < before:
                return False
            split_a, split_b = a >= 256, b >= 256
            if not split_a and not split_b:
                return True
            # At equal numbers the left token was merged first, so the right one is undone first.
            if split_a and (a > b or not split_b):
                before, a = a, self.right[a]
            else:
                before, b = b + 1, self.left[b]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens (own numbers) of one piece."""
        n = len(piece)
        known = self._number.get(piece)
        if known is not None:
            return [known]
        longest, lengths = list(piece), self.lengths
        for end, token in self.matcher.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token  # ends ascend: the last match of a start is its longest
        dead, out, at, token = bytearray(n + 1), [], 0, longest[0]
        while at < n:
            end = at + lengths[token]
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
                continue
            token = self.shorter(token)
            while token < 0:
                dead[at] = 1
                token = out.pop()
                at -= lengths[token]
                token = self.shorter(token)
        return out

    def _unit(self, text: str) -> bytes:
        own: list[int] = []
        for word in self.words.findall(text):
            own += self.encode_piece(word.encode())
        return self.ids[own].tobytes()

    def _ordinary(self, text: str) -> list[bytes]:
        """Ids of a text without added tokens, by units that start at single spaces."""
        out, units = [], _UNITS.split(text) if text else []
        for lead, some in (("", units[:1]), (" ", units[1:])):
            kept = self._kept[bool(lead)]
            for unit in some:
                found = kept.get(unit)
                if found is None:
                    found = self._unit(lead + unit)
                    if len(unit) <= LONGEST_KEPT:
                        if len(kept) >= UNITS_KEPT:
                            kept.clear()
                        kept[unit] = found
                out.append(found)
        return out

    def encode(self, text: str) -> np.ndarray:
        """The text's token ids."""
        if self._added is None or not any(t in text for t in self.added):
            return np.frombuffer(b"".join(self._ordinary(text)), dtype=np.uint32)
        out: list[bytes] = []
        for n, part in enumerate(self._added.split(text)):
            out += [np.uint32(self.added[part]).tobytes()] if n % 2 else self._ordinary(part)
        return np.frombuffer(b"".join(out), dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids; bytes that are not UTF-8 become U+FFFD."""
        return self.table.render(ids).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> BacktrackingBpe:
    """One tokenizer for each worker process."""
    return BacktrackingBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, `ids` (array of token ids).

    Null and empty texts have no ids; a null id stays null; repeated rows are rows of
    their own; other columns are not read; an empty table gives an empty one. Added
    tokens in a text become their ids, as the library does by default.
    """
    def make():
        own = tokenizer(path)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [own.encode(t) for t in texts_of(batch.column(1))]
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32), pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])
        return one

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(by_batch(make), f"`{id_col}` {rows.schema[0].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id, `text`. A null list of ids, and an empty one, is the empty text; null ids in a list are passed over."""
    def make():
        own = tokenizer(path)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [own.decode(np.array([i for i in ids or () if i is not None], dtype=np.int64)) for ids in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])
        return one

    rows = encoded.select(id_col, ids_col)
    return rows.mapInArrow(by_batch(make), f"`{id_col}` {rows.schema[0].dataType.simpleString()}, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded text).

    One pass; ids and texts don't leave the task. Null and empty texts count as the empty text.
    """
    def make():
        own = tokenizer(path)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_sha, text_sha = [], [], []
            for text in texts_of(batch.column(1)):
                ids = own.encode(text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(own.decimals.render(ids)[:-1]).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return one

    rows = docs.select("doc_id", "text")
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(by_batch(make), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
