"""Encoding, decoding and counting against the libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyroll.llm import bpe, token_counts

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
HARD = ["", " ", "\n", "  \n  a", "a\x1c b", "don't  we'll\tgo\r\n", "<|endoftext|>", "x<|endoftext|> y <|endoftext", "中文字符 と かな", "🙂🙂 é́", "▁ ▁▁a", "<s> </s> <unk> <0x0A>", "\x00\x01", "a" * 3000, "ab " * 2000, "1234567 89.5", " lead and trail "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


def random_texts(seed, n):
    r = random.Random(seed)
    parts = [" the", "ing", "ation", " ", "  ", "\n", "'s", "é", "ß", "zz", "qx", "…", "0", "42", "<|endoftext|>", "▁", "a"]
    for k in range(n):
        yield "".join(r.choice(parts) if k % 2 else chr(r.choice([*range(32, 127), 10, 233, 8364, 20013])) for _ in range(r.randrange(80)))


def test_encoder_equals_the_library(library):
    own = bpe.BacktrackingBpe(BYTE)
    for text in [*HARD, *random_texts(1, 800)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, text[:80]
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False) == text


def test_encoder_steps_back(library):
    """Pieces on which longest matches alone are wrong."""
    own, seen = bpe.BacktrackingBpe(BYTE), 0
    r = random.Random(5)
    for _ in range(1500):
        piece = "".join(r.choice("abcdeghinorst") for _ in range(r.randrange(2, 30)))
        ids = library.encode(piece, add_special_tokens=False).ids
        greedy, at = [], 0
        while at < len(piece):
            token = max((s for k in range(1, len(piece) - at + 1) if (s := piece[at:at + k].encode()) in own._number), key=len)
            greedy.append(int(own.ids[own._number[token]]))
            at += len(token)
        seen += greedy != ids
        assert own.encode(piece).tolist() == ids
    assert seen > 100


def test_every_token_encodes_itself():
    own = bpe.BacktrackingBpe(BYTE)
    for n in range(256, len(own.strings), 97):
        s = own.strings[n]
        number = own._number.pop(s)
        assert own.encode_piece(s) == [n]
        own._number[s] = number


def test_bytes_that_are_no_text_are_replaced(library):
    own = bpe.BacktrackingBpe(BYTE)
    ids = [i for i in library.encode("é中", add_special_tokens=False).ids][:1]
    import numpy as np

    assert own.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        bpe.BacktrackingBpe(public_tokenizers.path("word_bpe_49k.json"))


def test_counts_equal_the_library(pieces):
    own = token_counts.PieceCounter(PIECE)
    for text in [*HARD, *random_texts(2, 800)]:
        assert own.count(text) == len(pieces.encode(text)), text[:80]


def test_tables_with_nulls_repeats_and_clashing_columns(make, library, pieces):
    rows = [(1, "some text"), (None, "x"), (3, None), (4, ""), (1, "some text"), (5, "long " * 30000)]
    docs = make(rows, extra=True)
    found = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(docs, BYTE).collect()), key=repr)
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=repr)
    encoded = bpe.encode(docs, BYTE)
    assert sorted(((r.doc_id, r.text) for r in bpe.decode(encoded, BYTE).collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    counted = sorted((tuple(r) for r in token_counts.count_tokens(docs, PIECE, limit=10).collect()), key=repr)
    assert counted == sorted(((i, len((t or "").encode()), (n := len(pieces.encode(t or ""))), n > 10) for i, t in rows), key=repr)


def test_empty_tables(make):
    docs = make([])
    assert bpe.round_trip_digests(docs, BYTE).collect() == []
    assert bpe.encode(docs, BYTE).collect() == [] and token_counts.count_tokens(docs, PIECE).collect() == []
