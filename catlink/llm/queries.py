"""The registered queries of the corpus operators: thin forms of the operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catlink.llm import bpe, chat, decontam, licences, mixing, quality, repair, repeats, rules, sharding, simhash, tokens, trie
from catlink.llm.common import table

SHARDS = 40


def tokenizer_file() -> str:
    """The tokenizer that the queries use; its package is needed by them alone."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 39 of a tree of five regions, and where a forty-first shard would put them."""
    tree = sharding.layout(SHARDS)
    return sharding.assign(table(spark, folder, "documents"), tree, sharding.grown(tree)).withColumn("law", F.lit("key"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document."""
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    df = decontam.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return df.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the passages of 200 bytes that occur twice anywhere."""
    df = repeats.remove(table(spark, folder, "documents"), keep_first=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return df.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    df = simhash.groups(table(spark, folder, "documents"))
    return df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence families found in every document: the most probable confirmed one, all confirmed ones, and the unknown paragraphs."""
    df = licences.scan(table(spark, folder, "documents"))
    sure, odd = F.filter("found", lambda x: x["family"] != "unknown"), F.filter("found", lambda x: x["family"] == "unknown")
    best = F.array_max(F.transform(sure, lambda x: F.struct(x["probability"], x["family"])))["family"]
    return df.select(
        "doc_id", "n_paragraphs", best.alias("licence"), F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
        F.size(sure).cast("long").alias("n_confirmed"), F.size(odd).cast("long").alias("n_unknown"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often the mix takes each document."""
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of every document and the verdict of the learned decision list."""
    df = rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against the same one with a stale last reply; ``reason`` where it has none."""
    df = chat.preferences(*chat.stale_replies(table(spark, folder, "conversations")))
    mask = lambda c: F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), "")
    return df.select(
        F.col("pair").alias("conv_id"), "n_prompt_turns", "prompt", "chosen", mask("chosen_train").alias("chosen_mask"), "rejected", mask("rejected_train").alias("rejected_mask"), "reason")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in the token files, read back from them."""
    return tokens.round_trip(table(spark, folder, "documents"), tokenizer_file())


def op11_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and their text again, as digests."""
    tokenizer = tokenizer_file()
    df = bpe.decode(bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), tokenizer), tokenizer)
    return df.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation, the cheapest edits that mend it, and what they leave."""
    return repair_digests(repair.repair(repair.damage(table(spark, folder, "conversations"))))


def repair_digests(df: DataFrame) -> DataFrame:
    text = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    return df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(text.cast("binary"), 256).alias("repaired_sha256"))


def op13_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the prefix trie of all conversations, rebuilt so that many share their first turns."""
    return trie.nodes_of(trie.rebuilt(trie.digests(table(spark, folder, "conversations"))))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_quality, op3_decontamination, op4_repeats, op5_simhash, op6_licences, op7_mixing, op8_rules, op9_chat, op10_token_files, op11_bpe, op12_repair, op13_trie)}
ORACLE: dict[str, str] = {}
