"""Preference formatting: the common prompt of a chosen and a rejected conversation, rendered once, and their masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def render(role: Column, text: Column) -> Column:
    """One turn in the chat layout. A null role counts as ``user``, a null text as empty."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("user")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def _keyed(side: DataFrame) -> DataFrame:
    """Rows by ``key`` and ``at``: structs of pair and turn in which null is a value, the first turn."""
    return side.select(F.struct("pair").alias("key"), F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")).alias("at"), "role", "text")


def _turns(side: DataFrame, name: str) -> DataFrame:
    """One row a (key, at): its segments in order of role and text. Repeated rows of a turn count once."""
    segment = F.struct(render(F.col("role"), F.col("text")).alias("text"), F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("train"))
    return side.distinct().groupBy("key", "at").agg(F.array_sort(F.collect_list(segment)).alias(name))


def _joined(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def _mask(segments: Column) -> Column:
    return F.transform(segments, lambda s: s["train"])


def preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair, n_prompt_turns, prompt, chosen, rejected and, for each segment of the two completions, whether it is trained on; and reason.

    Both sides hold (pair, turn, role, text). Turns are compared by number, null first; the first turn that differs, or that one side lacks, ends
    the common prefix. Only assistant turns of the completions are trained on. Every pair has a row: where the sides are equal, everything is
    prompt, the completions are empty and ``reason`` says so (else it is null); a pair that one side lacks has an empty prompt. The null
    pair is one like any other. Other columns are not read; empty tables give no rows. Turns are joined one by one, so a long conversation is split
    over tasks until its text, one value by definition, is put together.
    """
    turns = _turns(_keyed(chosen), "c").join(_turns(_keyed(rejected), "r"), ["key", "at"], "full")
    same = F.coalesce(F.col("c") == F.col("r"), F.lit(False))
    ends = turns.filter(~same).groupBy("key").agg(F.min("at").alias("end"))
    turns = turns.join(ends, "key", "left")
    shared = F.col("end").isNull() | (F.col("at") < F.col("end"))
    part = F.struct(F.col("at"), *[F.when(shared if x == "p" else ~shared, F.col(c)).alias(x) for x, c in (("p", "c"), ("c", "c"), ("r", "r"))])
    parts = turns.groupBy("key").agg(F.array_sort(F.collect_list(part)).alias("t"), F.max(F.col("end").isNotNull()).alias("differ"))
    empty = F.expr("cast(array() as array<struct<text:string,train:boolean>>)")

    def of(side: str) -> Column:
        return F.flatten(F.transform("t", lambda x: F.coalesce(x[side], empty)))

    flat = parts.select("key", "differ", F.size(F.filter("t", lambda x: x["p"].isNotNull())).alias("n_prompt_turns"), of("p").alias("p"), of("c").alias("c"), of("r").alias("r"))
    return flat.select(
        "key.pair", "n_prompt_turns", _joined(F.col("p")).alias("prompt"), _joined(F.col("c")).alias("chosen"), _mask(F.col("c")).alias("chosen_train"),
        _joined(F.col("r")).alias("rejected"), _mask(F.col("r")).alias("rejected_train"), F.when(~F.col("differ"), "equal sides").alias("reason"))


def stale_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen, rejected) from plain conversations, keyed by conv_id.

    Chosen is the conversation; rejected is the same, but its last reply is a stale one: the latest of the assistant's earlier texts that is another,
    or else the latest of the user's. Turns behind the last reply are in both. A conversation without a reply, or in which nothing
    else was said before, is equal on both sides.
    """
    plain = conversations.select(F.col("conv_id").alias("pair"), "turn", "role", "text")
    conv = _keyed(plain)
    last = conv.filter("role = 'assistant'").groupBy("key").agg(F.max(F.struct("at", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    other = F.coalesce("text", F.lit("")) != F.col("last.text")
    said = conv.filter("role IN ('assistant', 'user')").join(last, "key").filter((F.col("at") < F.col("last.at")) & other)
    before = said.groupBy("key").agg(*[F.max(F.when(F.col("role") == r, F.struct("at", F.coalesce("text", F.lit("")).alias("text")))).alias(r) for r in ("assistant", "user")])
    stale = before.join(last, "key").select("key", F.col("last.at").alias("end"), F.coalesce("assistant", "user")["text"].alias("stale"))
    kept = conv.join(stale.select("key", "end"), "key", "left").filter("end IS NULL OR at != end OR NOT coalesce(role = 'assistant', false)")
    columns = [F.col("key.pair"), F.col("at.turn")]
    reply = stale.select("key.pair", F.col("end.turn").alias("turn"), F.lit("assistant").alias("role"), F.col("stale").alias("text"))
    return plain, kept.select(*columns, "role", "text").unionByName(reply)
