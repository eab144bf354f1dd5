"""The corpus operators on small tables, against plain forms of their contracts."""

import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from catlink.llm import chat, decontam, licences, mixing, quality, queries, repeats, rules, sharding, simhash, tokens

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, score double, _u string"
LONG = " ".join(f"word{i} and other{i % 7}" for i in range(3000))
ODD = [
    (None, "one two three four five", "en", None, 1.0, "x"), (1, None, None, "a", None, None), (2, "", "en", "a", 1.0, None), (3, LONG, "en", "b", 1.0, "y"),
    (4, LONG, "en", "b", 1.0, "y"), (4, LONG, "en", "b", 1.0, "y"), (5, " \n\t ", "en", "b", None, "z"), (6, "Ünïcode § text <|endoftext|> x", "fr", "c", 0.0, "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def test_sharding(spark, odd, none):
    rows = queries.op1_sharding(spark, DATA).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(40))
    got = sharding.assign(odd, sharding.layout(3)).collect()
    assert len(got) == len(ODD) and {r.size for r in got if r.doc_id == 1} == {16}
    assert len({r.shard for r in got if r.doc_id == 4}) == 1 and len({(r.shard, r.slot) for r in got}) == len(ODD)
    assert sharding.assign(none, sharding.layout(3)).count() == 0


def test_sharding_equals_plain_form(spark, docs):
    text = dict(docs)
    for r in queries.op1_sharding(spark, DATA).collect():
        raw = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
    copies = spark.createDataFrame([(None, "same")] * 300 + [(7, f"t{i}") for i in range(100)], "doc_id bigint, text string")
    got = defaultdict(list)
    for r in sharding.assign(copies.repartition(5), sharding.layout(3)).collect():
        got[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in got.values()) and sum(map(len, got.values())) == 400


def test_shards_take_by_weight(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    tree = [sharding.Shard(0, "a", "r", 3.0), sharding.Shard(1, "b", "q", 1.0), sharding.Shard(2, "b", "p", 0.0)]
    n = Counter(r.s for r in sharding.place(ids, tree, "doc_id", "s").collect())
    assert set(n) == {0, 1} and abs(n[0] / 4000 - 0.75) < 0.03


def test_quality(spark, odd, none, labels):
    q = {r.doc_id: r.quality for r in labels.collect()}
    rows = queries.op2_quality(spark, DATA).collect()
    assert all(r.held_out == brute.held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    unseen = [(r.predicted, q[r.doc_id]) for r in rows if r.doc_id in q and r.held_out]
    assert np.mean([a == b for a, b in unseen]) >= 0.9
    assert quality.classify(odd, labels).count() == len(ODD) and quality.classify(none, labels).count() == 0
    one_class = labels.filter("quality = 1")
    assert {r.score for r in quality.classify(odd, one_class).collect()} == {0.5}
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_decontamination(spark, odd, none, docs):
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    want = brute.decontamination(docs, [(r.item_id, r.text) for r in bench.collect()])
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in queries.op3_decontamination(spark, DATA).collect()}
    assert got == want
    items = [(1, "two THREE"), (2, None), (None, "five"), (3, ""), (4, " ".join(LONG.split()[50:75])), (4, "x")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (decontam.BLOCK, 3):
        rows = decontam.hits(odd, bench, block).collect()
        plain = brute.decontamination([(i, r[1]) for i, r in enumerate(ODD)], items)
        want = Counter((ODD[i][0], v[0], v[1], v[2]) for i, v in plain.items())
        assert Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"])) for r in rows) == want
        kept = decontam.keep_clean(odd, bench, block)
        assert kept.columns == odd.columns and kept.count() == sum(v[1] == 0 for v in plain.values())
    assert decontam.hits(none, bench).count() == 0 and decontam.hits(odd, bench.limit(0)).filter("size(spans) > 0").count() == 0


@pytest.mark.parametrize("limit", [repeats.LIMIT, 2])
def test_repeats(spark, docs, limit):
    want = brute.repeats(docs, 40)
    rows = repeats.remove(spark.read.parquet(f"{DATA}/documents.parquet"), 40, False, 16, limit).collect()
    assert {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in rows} == want


def test_repeats_keep_first(spark, odd, none):
    rows = [(1, "abcdefghij" + "K" * 3), (2, "xx" + "abcdefghij"), (3, "abcdefghij" * 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id: bytes(r.kept) for r in repeats.remove(df, 10, True, 8).collect()}
    assert kept[1] == b"abcdefghijKKK" and kept[2] == b"xx" and kept[3] == b""
    rows = repeats.remove(odd, 40, False, 16).collect()
    assert len(rows) == len(ODD) and all(r.kept == b"" for r in rows if r.doc_id in (3, 4))
    assert repeats.remove(none, 40, True, 16).count() == 0


def test_repeats_of_null_ids_with_equal_checksums(spark):
    passage = "".join(f"{i:03d}" for i in range(20))
    by = {zlib.crc32(f"{passage}A{i}".encode()): i for i in range(300_000)}
    i, j = next((by[c], j) for j in range(1_000_000) if (c := zlib.crc32(f"B{j:09d}{passage}".encode())) in by)
    texts = [f"{passage}A{i}", f"B{j:09d}{passage}"]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    assert sorted(bytes(r.kept).decode() for r in repeats.remove(df, 40, False, 16).collect()) == [f"A{i}", f"B{j:09d}"]
    rows = repeats.remove(spark.createDataFrame([(None, texts[0])] * 30, df.schema), 40, False, 16).collect()
    assert len(rows) == 30 and all(r.kept == b"" for r in rows)


def test_longest_factors():
    data = np.frombuffer(b"abcdabcdXabcd", np.uint8)
    start = np.arange(10)
    earlier, shared = repeats.longest_factors(np.concatenate([data, np.zeros(8, np.uint8)]), start, np.zeros(10, np.int64), 8)
    assert not earlier.any() and not shared.any()


def test_previous_factors_equal_plain_search():
    draw = np.random.default_rng(5)
    for n, letters, length in ((1, 2, 8), (40, 1, 12), (60, 2, 8), (200, 3, 16), (300, 2, 24)):
        data = np.concatenate([draw.integers(97, 97 + letters, n).astype(np.uint8), np.zeros(length, np.uint8)])
        raw, starts = data.tobytes(), np.arange(n)

        def shared(i, j, raw=raw, length=length):
            return next((k for k in range(length) if raw[i + k] != raw[j + k]), length)

        keys = repeats._words(data, starts, length)
        order = np.lexsort([starts, *keys])
        common = repeats._common(keys, order, length)
        assert [shared(a, b) for a, b in zip(order, order[1:], strict=False)] == common[1:].tolist()
        common[0] = 0
        found = dict(zip(order.tolist(), repeats.previous_factors(order.tolist(), common.tolist()), strict=True))
        assert found == {i: max((shared(i, j) for j in range(i)), default=0) for i in range(n)}
        earlier, both = repeats.longest_factors(data, starts, np.zeros(n, np.int64), length)
        assert earlier.tolist() == [found[i] >= length for i in range(n)]
        assert both.tolist() == [any(shared(i, j) >= length for j in range(n) if j != i) for i in range(n)]


def test_repeats_query(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op4_repeats(spark, DATA).collect()}
    assert got == brute.repeats(docs)


def test_simhash(spark, odd, none, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op5_simhash(spark, DATA).collect()}
    assert got == brute.simhash(docs)
    assert simhash.groups(odd).count() == len(ODD) and simhash.groups(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 3, 6]


def test_keep_one_of_null_and_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (8, d), (9, c), (None, d), (7, d)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(None, a), (None, b), (7, c), (7, d)])
    kept = simhash.keep_one(spark.createDataFrame([(1, a), (5, a), (5, b)], "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, a), (5, b)])


def test_keep_one_follows_the_links(spark, docs):
    kept = simhash.keep_one(spark.read.parquet(f"{DATA}/documents.parquet"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute.simhash(docs).values()})
    text = " ".join(f"{x}{i}" for x in "ab" for i in range(60))
    rows = spark.createDataFrame([(5, text, "k5"), (3, text.upper(), "k3"), (9, "other words here", "k9")], "doc_id bigint, text string, row string")
    assert sorted((r.doc_id, r.row) for r in simhash.keep_one(rows).collect()) == [(3, "k3"), (9, "k9")]


def test_stages_leave_clashing_columns_alone(spark, labels):
    names = ["_u", "_hash", "_first", "target", "copies", "source_size", "_quality_score", "score", "_row", "row", "key", "_copy", "spans", "n_words", "shard"]
    texts = [(f"word{i} {' '.join(f'w{i}x{j}' for j in range(40))}", f"s{i % 3}") for i in range(30)]
    rows = [(i, t, src, *[f"{n}-{i}" for n in names]) for i, (t, src) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    bench = spark.createDataFrame([(1, "none of these")], "item_id bigint, text string")
    for out in (quality.keep_good(df, labels), simhash.keep_one(df), decontam.keep_clean(df, bench), mixing.apply(df, (1, 1, 3))):
        assert out.columns == df.columns
        assert {tuple(r) for r in out.collect()} <= set(rows)
    assert simhash.keep_one(df).count() == len(rows) and {r.source for r in mixing.apply(df).collect()} == {"s0", "s1", "s2"}


def test_anchors_meet_all_close_pairs(spark):
    draw = np.random.default_rng(1)
    base = [int(x) for x in draw.integers(0, 1 << 63, 40)]
    fps = set(base)
    for x in base:
        for n in (1, 2, 3, 4):
            y = x
            for b in draw.choice(64, n, replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = {(r.u, r.v) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}


def test_replicas_are_never_broadcast(spark):
    """Spark sizes the replicas as the fingerprints they come from, so it must not choose the join by size."""
    plan = simhash.links(spark.range(20).select(F.col("id").alias("fp")))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 1


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "u bigint, v bigint")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software "
       "without restriction.\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")


def wrapped(text, width, mark):
    lines, line = [], ""
    for word in text.replace("\n\n", " \n\n ").split(" "):
        if word == "\n\n" or len(line) + len(word) > width:
            lines.append(mark + line)
            line = ""
            if word == "\n\n":
                lines.append(mark.rstrip())
                continue
        line += word + " "
    return "\n".join([*lines, mark + line])


def test_licence_notices(spark):
    prose = " ".join(next(r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect() if r.text and len(r.text.split()) > 300).split()[:300])
    texts = {
        1: (wrapped(MIT, 79, ""), {"mit"}), 2: (wrapped(MIT, 60, "# "), {"mit"}), 3: ("/*\n" + wrapped(MIT, 50, " * ") + "\n */\n" + prose, {"mit"}),
        4: ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", {"mit", "apache-2.0"}),
        5: (f"{prose} {MIT.split(chr(10))[0]} {prose}", {"mit"}), 6: (f"{prose} Licensed under CC BY-SA 4.0. {prose}", {"cc-by-sa"}), 7: (prose, set()), 8: ("The.\n\nMit und.\n\nPation.", set()),
        9: ("// SPDX-License-Identifier: MIT\n" + prose, {"mit"}), 10: ("", set()), 11: (None, set()),
        12: (prose + "\nThis program is free software: you can redistribute it and/or modify it under the terms of the GNU General\nPublic License as published by the Free Software Foundation.\n" + prose, {"gpl-3.0"}),
    }
    extra = spark.createDataFrame([(-k, t[0]) for k, t in texts.items()], "doc_id bigint, text string")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").unionByName(extra)
    got = {r.doc_id: {x.family for x in r.found} for r in licences.scan(docs).filter("doc_id < 0").collect()}
    assert {k: got[-k] - {"unknown"} for k in texts} == {k: t[1] for k, t in texts.items()}
    assert not any("unknown" in got[-k] for k in (7, 8, 10, 11))


def test_few_unknown_licences(spark):
    folder = "/root/testdata/sf0.01"
    rows = licences.scan(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    windows = sum(r.n_paragraphs for r in rows)
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    known = licences.Templates(licences.TEMPLATES)
    lines = sum(1 for t in text.values() for x in t.split("\n") if x.strip())
    odd = [x for r in rows for x in r.found if x.family == "unknown"]
    assert windows and len(odd) <= max(2, 0.001 * lines), [text[r.doc_id].encode()[x.start:x.end] for r in rows for x in r.found if x.family == "unknown"][:20]
    # every template that lies in a text whole, by plain search of its words, is found
    for r in rows:
        words = " " + " ".join(licences.plain_words(text[r.doc_id])) + " "
        for family, templates in known.texts.items():
            if any(f" {' '.join(licences.plain_words(t))} " in words for t in templates):
                assert family in {x.family for x in r.found}, (r.doc_id, family)


def test_templates_from_files(spark, tmp_path):
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / "a.txt").write_text("Use of this thing needs a nod.\n\nA second paragraph of the own notice.")
    found = licences.read_templates(spark, str(tmp_path))
    assert found == {"own": ["Use of this thing needs a nod.", "A second paragraph of the own notice."]}
    docs = spark.createDataFrame([(1, "Intro words here. Use of this thing\nneeds a nod. More words follow it."), (2, "plain words only " * 40)], "doc_id bigint, text string")
    assert {r.doc_id: [x.family for x in r.found] for r in licences.scan(docs, templates=found).collect()} == {1: ["own"], 2: []}


def test_licences(spark, odd, none):
    lines = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit", "All rights reserved.": "all-rights-reserved"}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").join(queries.op6_licences(spark, DATA), "doc_id").collect():
        for line, family in lines.items():
            assert (family in r.families.split(",")) == (line in r.text.split("\n"))
    assert licences.scan(odd).count() == len(ODD) and licences.scan(none).count() == 0


def test_mixing(spark, odd, none):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = queries.op7_mixing(spark, DATA).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r["size"]
    want = brute.targets(dict(sizes))
    assert all(abs(want[s] - target[s]) <= 1e-6 * want[s] for s in want)
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.05 * sum(sizes.values())
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(none).count() == 0
    assert mixing.apply(odd).columns == odd.columns
    capped = spark.createDataFrame([("a", 10), ("b", 1000), (None, 1000), ("d", 0)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(capped).collect()}
    want = brute.targets({"a": 10, "b": 1000, None: 1000, "d": 0})
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_heavier_documents_are_likelier(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.when(F.col("id") < 1500, "a").otherwise("b").alias("source"), F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("w"))
    rows = mixing.mix(df, (1, 3), 3, "w").filter("source = 'a'").collect()
    even, uneven = (sum(r.copies for r in rows if r.doc_id % 2 == k) for k in (0, 1))
    assert even > 2 * uneven and abs(sum(r.taken for r in rows) - rows[0].target) <= 2


def test_rules(spark, odd, none, labels, docs):
    text = dict(docs)
    rows = queries.op8_rules(spark, DATA).collect()
    assert all(brute.statistics(text[r.doc_id]) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert all(r.kept for r in rows if r.doc_id in good and not r.base_failed) and any(r.rejected_by for r in rows)
    got = rules.judge(odd, labels).collect()
    assert len(got) == len(ODD) and not any(r.kept for r in got if r.doc_id in (None, 1, 2, 5))
    assert rules.judge(none, labels).count() == 0 and rules.learn(odd, labels.limit(0)) == []


def test_preferences(spark):
    schema = "pair bigint, turn bigint, role string, text string"
    a = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "x"), (3, 0, None, None), (None, 1, "user", "q"), (4, 0, "user", "u")]
    b = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "why"), (2, 0, "user", "x"), (3, 0, "user", ""), (3, 1, "assistant", "z")]
    got = {r.pair: r for r in chat.preferences(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert got[1].prompt == "<|user|>\nhi<|end|>\n" and got[1].chosen == "<|assistant|>\nyes<|end|>\n" and got[1].chosen_train == [True] and got[1].rejected_train == [True, False]
    assert got[2].reason == "equal sides" and got[2].prompt == "<|user|>\nx<|end|>\n" and got[2].chosen == got[2].rejected == ""
    assert got[3].n_prompt_turns == 1 and got[3].chosen == "" and got[4].prompt == "" and got[4].rejected == "" and got[None].chosen == "<|user|>\nq<|end|>\n"
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.preferences(*chat.stale_replies(empty)).count() == 0


def test_chat_query(spark, tmp_path):
    odd = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "b"), (1, 3, "user", "later"), (2, 0, "assistant", "only"), (3, 0, "user", "same"), (3, 1, "assistant", "same"),
           (4, None, "user", "first"), (4, 0, None, None), (4, 1, "assistant", None), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (5, 0, "user", "q"), (5, 1, "assistant", "r"), (5, 1, "user", "both")]
    spark.createDataFrame(odd, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    table = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    for folder, rows in ((DATA, table), (str(tmp_path), odd)):
        got = {r.conv_id: (r.n_prompt_turns, r.prompt, r.chosen, r.chosen_mask, r.rejected, r.rejected_mask, r.reason) for r in queries.op9_chat(spark, folder).collect()}
        assert got == brute.preferences(rows)


def test_token_files(spark, odd, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = tokens.round_trip(odd, path, per_file=3).orderBy("start").collect()
    ids = [[*t.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in ODD]
    assert [r.n_tokens for r in rows] == [len(x) for x in sorted_by_id(ids)]
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in sorted_by_id(ids)]
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows[:-1]]]).tolist()
    assert tokens.round_trip(none, path).count() == 0
    values = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7], np.uint32)
    assert (tokens.unpack(*tokens.pack(values), len(values)) == values).all()


def test_token_files_of_the_table(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, {}
    for doc, text in sorted(docs):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want[doc] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op10_token_files(spark, DATA).collect()} == want


def test_token_files_of_repeated_and_null_ids(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(None, "same text")] * 200 + [(None, f"other {i}") for i in range(50)] + [("b", "x"), ("a", None)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    got = tokens.round_trip(df, path, per_file=20).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 250 + ["a", "b"] and [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()


def sorted_by_id(ids):
    order = sorted(range(len(ODD)), key=lambda i: (ODD[i][0] is not None, ODD[i][0] or 0))
    return [ids[i] for i in order]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3]
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert len(rows) == sizes[4]
