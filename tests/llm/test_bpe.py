from __future__ import annotations

import hashlib
import random

import public_tokenizers
from brute import SF_SMALL
from tokenizers import Tokenizer

from eventlake.llm import op8_bpe as op8


def library():
    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made.no_truncation()
    made.no_padding()
    return made


def test_equals_the_library(docs, raw_docs):
    made = library()
    want = []
    for d, x in raw_docs:
        ids = made.encode(x or "", add_special_tokens=False).ids
        want.append((d, len(ids), b"".join(i.to_bytes(4, "little") for i in ids), made.decode(ids, skip_special_tokens=False)))
    got = [(r.doc_id, r.n_tokens, bytes(r.token_ids), r.decoded) for r in op8.bpe_encode(docs, op8.default_vocabulary()).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_odd_texts():
    made = library()
    trie = op8.BpeTrie(open(op8.default_vocabulary(), encoding="utf-8").read())
    rng = random.Random(1)
    pieces = [s.replace("</w>", "") for s in made.get_vocab()]
    texts = ["".join(rng.choice(pieces) for _ in range(3)) for _ in range(4000)]
    texts += ["", "I'll don't 'S", "a<|endoftext|>b<|startoftext|>", "ΑΣ ΟΔΟΣ", "x" * 5000, "1234", "İstanbul ﬁ Å é", "\x85\xa0 y"]
    ids, decoded = trie.encode(texts)
    for text, i, shown in zip(texts, ids, decoded, strict=True):
        want = made.encode(text, add_special_tokens=False).ids
        assert i == b"".join(n.to_bytes(4, "little") for n in want), text
        assert shown == made.decode(want, skip_special_tokens=False)


def test_query(spark):
    row = op8.op8_bpe(spark, SF_SMALL).where("doc_id = 3").first()
    text = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id = 3").first().text
    ids = library().encode(text, add_special_tokens=False).ids
    assert row.n_tokens == len(ids)
    assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
