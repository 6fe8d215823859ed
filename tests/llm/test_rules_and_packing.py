"""The quality ledger and packing, against plain definitions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyroll.llm import packing, quality_rules

BYTE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "  \n ", "one", "a b c d e f g h a b c d e f g h x", "x " * 100, "Straße é\n\nStraße é\nüber\n", "# $ % & | < > *" * 3, "LOUD WORDS!! ONLY\n" * 12,
         "A\x0bB\x0cC\rD\tE", "line\nline\n line\nline ", "\x85 nbsp\xa0word", " ".join(f"w{k}" for k in range(40)), "a " * 7 + "b", "pneumono" * 9 + " x" * 20, "long text " * 20000]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    counts = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    shouted = sum(bool(re.search("[A-Z]", w)) and not re.search("[a-z]", w) for w in words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), len(lines), shouted


def test_measurements_and_bits(make):
    docs = make([(k, t) for k, t in enumerate(TEXTS)] + [(None, "one"), (3, "one")], extra=True)
    rows = quality_rules.ledger(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = "one" if r.doc_id is None else TEXTS[r.doc_id]
        assert tuple(r[m] for m in quality_rules.MEASURES) == plain(text), text and text[:40]
        values = dict(zip(quality_rules.MEASURES, plain(text)))
        assert r.failed == sum(quality_rules.BITS[n] for n, c in quality_rules.RULES if eval(c.replace("AND", "and"), {}, values))


def test_window_words_on_random_texts():
    r = random.Random(8)
    for _ in range(300):
        words = [r.choice("ab").encode() for _ in range(r.randrange(60))] if r.random() < 0.5 else [b"%d" % r.randrange(9) for _ in range(r.randrange(60))]
        assert quality_rules.repeated_window_words(words) == plain(b" ".join(words).decode())[4]


def test_filter_equals_the_ledger_and_keeps_all_columns(make):
    docs = make([(k, t) for k, t in enumerate(TEXTS)] + [(None, TEXTS[12]), (12, TEXTS[12])], extra=True)
    for policy in quality_rules.POLICIES:
        kept = quality_rules.keep_passing(docs, policy)
        assert kept.schema == docs.schema
        passing = [r.doc_id for r in quality_rules.ledger(docs).filter(quality_rules.passes(policy)).collect()]
        assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, passing))


def test_ablations_equal_counting(make):
    rows = quality_rules.ledger(make([(k, t) for k, t in enumerate(TEXTS * 3)]))
    failed = [r.failed for r in rows.collect()]
    found = {(r.policy, r.rule): (r.failing, r.alone, r.rejected) for r in quality_rules.ablations(rows).collect()}
    for policy, mask in quality_rules.POLICIES.items():
        for rule, bit in quality_rules.BITS.items():
            expected = (sum(bool(f & mask & bit) for f in failed), sum(f & mask == bit for f in failed), sum(bool(f & mask) for f in failed))
            if mask & bit and expected[2]:
                assert found[policy, rule] == expected
    assert quality_rules.ledger(make([])).collect() == [] and quality_rules.keep_passing(make([])).collect() == []


def check_packing(rows, docs, length):
    """Every id in one piece; sequences full and gapless."""
    library = Tokenizer.from_file(BYTE)
    full = defaultdict(list)
    for i, text in docs:
        full[i].append(np.array(library.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(full)
    for i, pieces in by_doc.items():
        assert len({len(x) for x in full[i]}) == 1 or i is None or len(full[i]) == 1
        copies = len(full[i])
        if copies == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(full[i][0])
                assert p.ids_crc32 == zlib.crc32(full[i][0][at:at + p.length].tobytes())
                at += p.length
            assert at == len(full[i][0])
        else:
            assert sum(p.length for p in pieces) == sum(map(len, full[i]))
    last = max(by_sequence, default=0)
    assert sorted(by_sequence) == list(range(last + 1)) if by_sequence else True
    for s, pieces in by_sequence.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == length if s < last else at <= length
        assert {p.padded_length for p in pieces} == {at if at & (at - 1) == 0 else length}


def random_documents(seed, n, sources=6):
    r = random.Random(seed)
    return [(k, " ".join(r.choice(["alpha", "beta", "gamma", "Δ", "x1"]) for _ in range(r.choice([0, 1, 5, 60, 400]))), r.choice(["big"] * 4 + [f"s{j}" for j in range(sources)] + [None])) for k in range(n)]


@pytest.mark.parametrize("length", [2048, 64, 7])
def test_pieces_cover_all_and_sequences_are_full(make, length):
    docs = random_documents(length, 150)
    rows = packing.pack(make(docs, extra=True).repartition(4), BYTE, length=length).collect()
    check_packing(rows, [(d[0], d[1]) for d in docs], length)


def test_every_window_has_the_target_mixture(make):
    docs = random_documents(1, 300)
    rows = packing.pack(make(docs).repartition(5), BYTE, length=256).collect()
    total, by_source, cells = sum(r.length for r in rows), Counter(), Counter()
    for r in rows:
        by_source[r.source] += r.length
        cells[r.sequence_id, r.source] += r.length
    last = max(r.sequence_id for r in rows)
    # Rounds and sequences are apart by half a token for each queue at most.
    for (sequence, source), n in cells.items():
        if sequence < last:
            assert abs(n - 256 * by_source[source] / total) <= 2 + len(by_source)


def test_given_mixture_holds_until_a_queue_is_dry(make):
    docs = [(k, "word " * 200, "a" if k % 2 else "b") for k in range(100)]
    rows = packing.pack(make(docs).repartition(3), BYTE, length=128, mixture={"a": 3.0, "b": 1.0}).collect()
    check_packing(rows, [(d[0], d[1]) for d in docs], 128)
    early = Counter()
    for r in rows:
        if r.sequence_id < 20:
            early[r.source] += r.length
    assert abs(early["a"] / sum(early.values()) - 0.75) < 0.01


def test_many_small_sources_share_a_queue(make):
    docs = [(k, "w " * (1 + k % 3), f"source {k}") for k in range(600)]
    rows = packing.pack(make(docs).repartition(4), BYTE, length=32).collect()
    check_packing(rows, [(d[0], d[1]) for d in docs], 32)


def test_small_sources_take_turns(make):
    """300 equal sources, none with a queue of its own: any stretch of the stream holds each in proportion but for few slices."""
    docs = [(k, "w " * (40 + k % 7), f"source {k // 12}") for k in range(3600)] + [(k, "x " * 20, f"tail {k}") for k in range(4000, 4300)]
    rows = packing.pack(make(docs).repartition(4), BYTE, length=256).collect()
    check_packing(rows, [(d[0], d[1]) for d in docs], 256)
    total, by_source, at = sum(r.length for r in rows), Counter(), [defaultdict(int) for _ in range(4)]
    for r in rows:
        by_source[r.source] += r.length
        at[min(3, 4 * (256 * r.sequence_id + r.offset) // total)][r.source] += r.length
    for quarter in at:
        assert all(abs(quarter[f"source {k}"] - by_source[f"source {k}"] / 4) <= 40 for k in range(300))
        assert 0.12 <= sum(n for s, n in quarter.items() if s.startswith("tail")) / sum(n for s, n in by_source.items() if s.startswith("tail")) <= 0.38


def test_mixture_of_many_sources(make):
    docs = [(k, "w " * 30, f"source {k % 300}") for k in range(1200)]
    rows = packing.pack(make(docs).repartition(3), BYTE, length=1024, mixture={f"source {k}": 2.0 if k < 100 else 1.0 for k in range(300)}).collect()
    check_packing(rows, [(d[0], d[1]) for d in docs], 1024)
    early = sum(r.length for r in rows if r.sequence_id < 10 and int(r.source.split()[1]) < 100)
    assert abs(early / 10240 - 0.5) < 0.05, early


def test_rounds_find_every_token():
    rounds = packing.Rounds([1000, 3, 250, 77], [1000.0, 3.0, 250.0, 77.0], 16)
    for queue, total in enumerate(rounds.totals):
        got = rounds.round_of(np.full(total, queue), np.arange(total))
        assert (rounds.served(got)[:, queue] <= np.arange(total)).all() and (rounds.served(got + 1)[:, queue] > np.arange(total)).all()


def test_ids_equal_the_library():
    library, own = Tokenizer.from_file(BYTE), packing.LibraryTokens(BYTE)
    assert own.ranked is not None
    texts = ["", " ", "a  b\n\n c", "x<|endoftext|>y", "é中🙂 z", "word " * 40000, "a" * 100000, " " * 80000 + "x", "\x1c a \x85b", "tab\tend \n"]
    for text in [*texts, *(t or "" for t in TEXTS)]:
        assert np.frombuffer(own.encode(text), own.kind).tolist() == library.encode(text, add_special_tokens=False).ids, text[:30]


def test_odd_documents(make):
    docs = [(1, None, None), (2, "", "a"), (None, "x y", "a"), (3, "tok " * 9000, "a"), (4, "same", "b"), (4, "same", "b")]
    check_packing(packing.pack(make(docs, extra=True), BYTE).collect(), [(d[0], d[1]) for d in docs], 2048)
    assert packing.pack(make([]), BYTE).collect() == []
    # A last sequence of a power of two is left as it is.
    assert {r.padded_length for r in packing.pack(make([(1, None)]), BYTE).collect()} == {1}
