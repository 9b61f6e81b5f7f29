"""Operator 13: every id once, sequences gapless and without padding."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from brute import SF_SMALL
from tokenizers import Tokenizer

from eventlake.llm import op13_packing as op13


def library():
    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made.no_truncation()
    made.no_padding()
    return made


def check(pieces, rows, window=op13.WINDOW):
    """Every document's ids are its pieces in order; sequences are gapless and full or of a power of two."""
    made = library()
    want = sorted([(d is None, d or 0, tuple([*made.encode(x or "", add_special_tokens=False).ids, op13.END_ID])) for d, x in rows])
    per_doc, per_seq = {}, {}
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), np.uint32)
        assert len(ids) == p.length > 0
        per_doc.setdefault((p.doc_id is None, p.doc_id or 0), []).append((p.start, p.doc_tokens, tuple(ids.tolist())))
        per_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in per_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    # rows that share an id have the same sums: all start positions and ids together
    for key in {w[:2] for w in want}:
        texts = [w[2] for w in want if w[:2] == key]
        parts = per_doc.pop(key)
        assert sum(len(i) for _, _, i in parts) == sum(map(len, texts))
        if len(texts) == 1:
            assert all(total == len(texts[0]) for _, total, _ in parts)
            assert tuple(x for _, _, i in sorted(parts) for x in i) == texts[0]
        else:
            for text in texts:  # each is covered by pieces of its own length at their starts
                assert all(any(s == a and text[s : s + len(i)] == i for s, n, i in parts if n == len(text)) for a, n, _ in parts if n == len(text))
    assert not per_doc
    return per_seq


def test_all_ids_once(docs, raw_docs):
    pieces = op13.pack(docs, op13.default_vocabulary()).collect()
    check(pieces, raw_docs)


def test_small_windows_merge_in_levels(spark, raw_docs, monkeypatch):
    """Many tasks, small windows and groups of two: leftovers pass several levels."""
    monkeypatch.setattr(op13, "MERGE", 2)
    rows = [(d, (x or "")[:300]) for d, x in raw_docs[:120]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    per_seq = check(op13.pack(df, op13.default_vocabulary(), window=64, n_open=3).collect(), rows, window=64)
    assert len({s >> 58 for s in per_seq}) > 2
    assert sum(1 for parts in per_seq.values() if sum(n for _, n in parts) < 64) <= 6


def test_best_fit_and_fullest():
    p = op13.Packer(0, 0, window=10, n_open=2)
    ids = lambda n: np.arange(n, dtype=np.uint32)
    for doc, n in enumerate((7, 5, 3)):
        p.add(doc, 0, ids(n), n)
    # 7 and 5 are open; 3 fits both and goes where it leaves least room
    assert [(r[2], r[4]) for r in p.out] == [(0, 7), (2, 3)]
    p.add(3, 0, ids(4), 4)
    p.add(4, 0, ids(9), 9)
    # none has room for 9, one may still be opened
    assert sorted(w[0] for w in p.open) == [1, 1]
    p.add(5, 0, ids(2), 2)
    # none has room for 2: the fullest is topped up and emitted, the rest goes where it fits best
    assert [(r[2], r[3], r[4]) for r in p.out[2:]] == [(1, 0, 5), (3, 0, 4), (5, 0, 1), (4, 0, 9), (5, 1, 1)]
    p.pour()
    assert not p.open and sum(r[4] for r in p.out) == 30


def test_encoder_equals_the_library():
    made, rng = library(), random.Random(3)
    encoder = op13.Encoder(open(op13.default_vocabulary(), encoding="utf-8").read())
    alphabet = "aB9 é'ñ!.<|>\t́Ω É-"
    vocab = [s.replace("</w>", "") for s in made.get_vocab()]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    texts += ["".join(rng.choice(vocab) for _ in range(3)) for _ in range(2000)]
    texts += ["", None, "I'll don't 'S", "a<|endoftext|>b <|EndOfText|>", "ΑΣ", "x" * 5000, "1234 a1b2!!c", "ÉÀ×÷ é ẞß", "\x85\xa0 y", "a\x00b \x1c x", "日本語 テスト"]
    ids, sizes = encoder.encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, sizes.tolist(), strict=True):
        assert ids[at : at + n].tolist() == made.encode(text or "", add_special_tokens=False).ids, text
        at += n
    assert at == len(ids)


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(op13, "WORDS_KEPT", 5)
    made = library()
    encoder = op13.Encoder(open(op13.default_vocabulary(), encoding="utf-8").read())
    for texts in (["one two three"], ["four five one"], ["two six seven eight nine ten"]):
        ids, _ = encoder.encode(pa.array(texts))
        assert ids.tolist() == made.encode(texts[0], add_special_tokens=False).ids


def test_empty_table(spark, no_docs):
    assert op13.pack(no_docs, op13.default_vocabulary()).collect() == []


def test_query(spark):
    rows = op13.op13_packing(spark, SF_SMALL).collect()
    made = library()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows[:200]:
        ids = [*made.encode(docs[r.doc_id] or "", add_special_tokens=False).ids, op13.END_ID]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[r.start : r.start + r.length]))
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
