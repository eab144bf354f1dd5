"""The operators on conversations against plain forms of their contracts."""

import random

import brute
import numpy as np
import pytest

from catlink.llm import queries, repair, trie

DATA = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies string, d string"
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def odd_rows():
    draw = random.Random(4)
    rows = [(c, t, draw.choice(["user", "assistant", "system", "tool", "", None]), draw.choice(["a.", "b!", "c", " ", "", None, "d. ", "line\nline?"])) for c in range(60) for t in range(draw.randrange(12))]
    rows += [(None, None, None, None), (None, 1, "user", "q."), (None, 1, "user", "q."), (7, 3, "user", "x" * 100_000 + "."), (-5, None, "assistant", "z."), (-5, 9, "user", "z.")]
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(3000)] + [(901, 1, "user", "again.")] * 500
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in odd_rows()], SCHEMA)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory, odd):
    """The odd rows as a table folder."""
    folder = str(tmp_path_factory.mktemp("odd"))
    odd.write.parquet(f"{folder}/conversations.parquet")
    odd.limit(0).write.parquet(f"{folder}/none/conversations.parquet")
    return folder


def mended(df):
    return {r.conv_id: tuple(r[c] for c in FIELDS) for r in df.collect()}


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert mended(queries.op12_repair(spark, DATA)) == brute.repaired(rows)


@pytest.mark.parametrize("piece", [repair.PIECE, 5])
def test_repair_of_odd_rows(spark, small, piece):
    damaged = repair.damage(spark.read.parquet(f"{small}/conversations.parquet"))
    assert mended(queries.repair_digests(repair.repair(damaged, piece))) == brute.repaired(odd_rows())
    assert queries.op12_repair(spark, f"{small}/none").count() == 0


def test_repair_keeps_texts(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "assistant", "cut"), (2, 0, "assistant", "a."), (3, 0, "user", "u.")]
    got = {r.conv_id: (r.audit, [(x.role, x.text) for x in r.repaired]) for r in repair.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert got == {1: ("RRD", [("user", "s."), ("assistant", "u.")]), 2: ("D", []), 3: ("D", [])}


@pytest.mark.parametrize("block", [1, 3, 4])
def test_block_tables_agree_with_single_steps(block):
    t, one, draw = repair.tables(block), repair.tables(1), np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 5, 8, 13, 40):
        for _ in range(20):
            symbols = draw.integers(0, repair.SYMBOLS, n).astype(np.uint8)
            for v in (0, 5):
                seen, grown = t.back(symbols, v)
                plain, total = one.back(symbols, v)
                assert (seen[-1], grown) == (plain[-1], total)
                assert [t.trace(symbols, seen, s) for s in range(4)] == [one.trace(symbols, plain, s) for s in range(4)]


def trie_rows(df):
    return sorted((tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in df.collect()), key=repr)


def tree_rows():
    """Conversations that branch at every depth, copies, a long one with a long copy, and the odd rows."""
    draw = random.Random(6)
    rows = [(c, t, "user", f"{draw.randrange(3)} w") for c in range(1000, 1100) for t in range(draw.randrange(1, 7))]
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2040) for t in range(4)]
    rows += [(c, t, "user", f"long {t // (1 if c < 3001 else 2)}") for c in (3000, 3001) for t in range(30)] + [(3002, t, "user", f"long {t}") for t in range(25)]
    return rows + [r for r in odd_rows() if r[0] != 900]


def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(queries.op13_trie(spark, DATA)) == brute.trie(brute.rebuilt(rows))


@pytest.mark.parametrize(("cells", "piece"), [(trie.CELLS, trie.PIECE), (4096, 4)])
def test_trie_of_odd_rows(spark, cells, piece):
    rows = tree_rows()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth string, own string")
    got = trie_rows(trie.nodes_of(trie.rebuilt(trie.digests(df)), cells, piece))
    assert got == brute.trie(brute.rebuilt(rows))


def test_plain_trie(spark):
    rows = [(2, 0, "user", "hi there"), (2, 1, "assistant", "yes"), (5, 0, "user", "hi there"), (5, 1, "assistant", "no"), (7, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    convs = {2: [("user", "hi there"), ("assistant", "yes")], 5: [("user", "hi there"), ("assistant", "no")], 7: [("", "")]}
    assert trie_rows(trie.nodes(df)) == brute.trie(convs)
    assert trie.nodes(df.limit(0)).count() == 0
