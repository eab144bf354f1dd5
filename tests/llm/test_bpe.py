"""Encoding and decoding by the segment tree, against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from catlink.llm import bpe, queries

DATA = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \n\t ", "a<|endoftext|>B<|startoftext|><|endoftext|>  İΣ ΑΣ<|endof", "x" * 3000, "ab" * 5000 + " 1234'll don't\x1c\x85 é é ﬁ ½ 漢字テスト 👍🏽!!??", "it'S I'VE ''ve 're<|end",
    "\x00\x01 ﻿​ b", "ẹ́ Å", "word " * 20_000, "".join(random.Random(1).choice("abcdehinorst") for _ in range(20_000)), None,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def wanted(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_the_table(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11_bpe(spark, DATA).collect()}
    assert got == {r.doc_id: wanted(library, r.text) for r in docs}


def test_odd_rows(spark, library, tmp_path):
    rows = [(i if i % 3 else None, t, f"ids {i}") for i, t in enumerate(ODD)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11_bpe(spark, str(tmp_path)).collect()))
    assert got == sorted([wanted(library, t) for t in ODD] * 2)
    assert bpe.decode(bpe.encode(df.limit(0), PATH), PATH).count() == 0
    kept = bpe.encode(df, PATH, into="coded")
    assert kept.columns == ["doc_id", "ids", "coded"] and {r.ids for r in kept.collect()} == {r[2] for r in rows}


@pytest.mark.parametrize(("step", "block", "at_once"), [(1, 5, 1), (50, 100, 3)])
def test_memory_forgets_but_the_ids_stay(library, monkeypatch, step, block, at_once):
    for name, value in (("CACHE", 7), ("STEP", step), ("BLOCK", block), ("AT_ONCE", at_once)):
        monkeypatch.setattr(bpe, name, value)
    c = bpe.Coder(PATH)
    for text in [" ".join(f"wörd{i % 23} {i}" for i in range(300)), *[t for t in ODD if t]]:
        assert np.frombuffer(c.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(c.words) < 7


def test_merges_take_the_leftmost_of_the_lowest_rank():
    draw = random.Random(3)
    for size in (1, 2, 3, 4, 5, 9, 40, 300):
        pairs = {a << 32 | b: (rank, 10 + rank) for rank, (a, b) in enumerate(draw.sample([(a, b) for a in range(14) for b in range(14)], 60))}
        for _ in range(10):
            symbols = [draw.randrange(6) for _ in range(size)]
            plain = list(symbols)
            while found := [(pairs[a << 32 | b], i) for i, (a, b) in enumerate(zip(plain, plain[1:], strict=False)) if a << 32 | b in pairs]:
                (_, new), i = min(found, key=lambda x: (x[0][0], x[1]))
                plain[i:i + 2] = [new]
            merges = bpe.Merges(pairs, np.arange(256), np.arange(256))
            assert merges.run(symbols) == plain
            assert np.frombuffer(merges.run_many([b"", bytes(symbols), b"\0"])[1], "<u4").tolist() == plain


def test_long_pieces_are_held_in_arrays(library, monkeypatch):
    monkeypatch.setattr(bpe, "SHORT", 3)
    c = bpe.Coder(PATH)
    for text in ("international", "a" * 777, "thetheir" * 50):
        assert np.frombuffer(c.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
