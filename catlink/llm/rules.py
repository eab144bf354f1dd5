"""Quality rules: text statistics, and a decision list learned from labelled ones.

The list is learned by sequential covering. A rule is a conjunction of thresholds on statistics; it is grown on two thirds of the
labelled rows by the condition of the greatest information gain, pruned on the last third back to its most precise beginning, and kept
if it is precise there; what it covers is taken away before the next rule. The rules are emitted as ordered conditional expressions.
Everything runs as DataFrame operations: each growing step is one small aggregation over binned statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from catlink import session
from catlink.llm.common import sampled

SYMBOLS = "#*$%&|<>"
WINDOW = 8
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_exclaim"]
_GAP = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows that are learned from, about, drawn by hash where there are more. ``precision``: share of rejected rows on the pruning third that must be bad."""

    sample: int = 20_000
    bins: int = 24
    rules: int = 8
    conditions: int = 3
    precision: float = 0.97


FEATURES = {
    "symbol_share": lambda: F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
    "repeat_share": lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
    "duplicate_lines": lambda: F.col("n_dup_lines").cast("double"),
    "distinct_share": lambda: F.col("n_distinct_words") / F.greatest("n_words", F.lit(1)),
    "upper_share": lambda: F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
    "exclaim_share": lambda: F.col("n_exclaim") / F.greatest("n_words", F.lit(1)),
    "word_length": lambda: F.col("word_chars") / F.greatest("n_words", F.lit(1)),
    "words": lambda: F.col("n_words").cast("double"),
}


def _fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column as a generated one, so that no filter or projection above it repeats its expression."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _let(value: Column, body) -> Column:
    """The body over a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(text: Column, char: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def _covered(windows: Column) -> Column:
    """Words inside windows (hashes in text order) that occur twice or more."""
    def positions(s: Column) -> Column:
        twice = F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda e: e["i"]))

    def total(q: Column) -> Column:
        steps = F.transform(q, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(q, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(_let(pairs, positions), total))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics of every whole text to its row. A null text has no words.

    Windows of eight words are compared by 64-bit hashes of their words' hashes.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = F.col("_row")
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), t.alias("_t"))
    df = _fixed(df, "_words", F.filter(F.split("_t", _GAP), lambda w: w != ""))
    df = _fixed(df, "_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    starts = F.when(F.size("_hashes") >= WINDOW, F.sequence(F.lit(0), F.size("_hashes") - WINDOW)).otherwise(F.expr("cast(array() as array<int>)"))
    df = _fixed(df, "_windows", F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)])))
    df = _fixed(df, "_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    symbols = sum((_count(F.col("_t"), c) for c in SYMBOLS[1:]), _count(F.col("_t"), SYMBOLS[0]))
    df = _fixed(df, "_stats", F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_windows")).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("_hashes")).cast("long").alias("n_distinct_words"),
        F.char_length(F.regexp_replace("_t", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        _count(F.col("_t"), "!").cast("long").alias("n_exclaim"),
    ))
    return df.select(*[rows[c].alias(c) for c in docs.columns if c not in STATISTICS], *[F.col("_stats")[c].alias(c) for c in STATISTICS])


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Rejects rows of which all conditions (statistic, at least?, threshold) hold."""

    conditions: tuple

    def expression(self) -> Column:
        out = F.lit(True)
        for name, above, value in self.conditions:
            out = out & (FEATURES[name]() >= value if above else FEATURES[name]() < value)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if a else '<'} {v:.4g}" for n, a, v in self.conditions)


def _bin(name: str, cuts: list[float]) -> Column:
    """Number of thresholds at or below the statistic."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda t: t <= F.col(name))).alias(name)


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p and p0 else 0.0


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """The decision list: rules that reject, in order. Empty if the labels do not hold both classes.

    Learned from labelled rows that pass the base rules, as the others are rejected anyway.
    """
    y = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg(F.col("quality").cast("double")) < 0.5).cast("int").alias("bad"))
    turn = F.md5(F.col("doc_id").cast("string"))
    picked = sampled(y, "doc_id", settings.sample).select(F.col("doc_id").alias("_id"), "bad", turn.alias("_turn"))
    rows = statistics(docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_id"))).filter(~base_failed())
    rows = session.materialise(rows.select("bad", "_turn", *[f().alias(n) for n, f in FEATURES.items()]), "rule-rows")
    if rows.select("bad").distinct().count() < 2:
        return []
    at = [i / settings.bins for i in range(1, settings.bins)]
    # Thresholds between the values of good rows, of bad rows, and of all.
    cuts = {n: set() for n in FEATURES}
    for part in (rows, rows.filter("bad = 1"), rows.filter("bad = 0")):
        got = part.agg(*[F.percentile_approx(n, F.lit(at), 10_000).alias(n) for n in FEATURES]).first()
        for n in FEATURES:
            cuts[n].update(got[n] or [])
    cuts = {n: sorted(c) for n, c in cuts.items()}
    binned = [_bin(n, cuts[n]) for n in FEATURES]
    grow = F.conv(F.substring("_turn", 9, 4), 16, 10).cast("int") % 3 < 2
    cells = session.materialise(rows.select(grow.alias("grow"), "bad", *binned).groupBy("grow", *FEATURES).agg(
        F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")), "rule-cells")

    def holds(conditions) -> Column:
        out = F.lit(True)
        for name, above, j in conditions:
            out = out & (F.col(name) >= j if above else F.col(name) < j)
        return out

    rules: list[list] = []
    for _ in range(settings.rules):
        left = cells
        for r in rules:
            left = left.filter(~holds(r))
        rule: list = []
        while len(rule) < settings.conditions:
            bins = left.filter("grow").filter(holds(rule)).select(
                F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in FEATURES])).alias("e"), "p", "n")
            counts = bins.groupBy("e.f", "e.b").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect()
            best = (0.0,)
            for name in FEATURES:
                mine = sorted((r["b"], r["p"], r["n"]) for r in counts if r["f"] == name)
                p0, n0 = sum(x[1] for x in mine), sum(x[2] for x in mine)
                for j in range(1, len(cuts[name]) + 1):
                    p, n = sum(x[1] for x in mine if x[0] >= j), sum(x[2] for x in mine if x[0] >= j)
                    best = max(best, (_gain(p, n, p0, n0), name, True, j), (_gain(p0 - p, n0 - n, p0, n0), name, False, j))
            if best[0] <= 1e-9:
                break
            rule.append(best[1:])
        # Pruning: the most precise beginning of the rule on the rows it was not grown on, the shortest on a tie.
        begins = [rule[:k] for k in range(1, len(rule) + 1)]
        if not begins:
            break
        unseen = left.filter("NOT grow").agg(*[F.sum(F.when(holds(b), F.col(x)).otherwise(0)).alias(f"{x}{k}") for k, b in enumerate(begins) for x in "pn"]).first()
        score = [(((unseen[f"p{k}"] or 0) - (unseen[f"n{k}"] or 0)) / max(1, (unseen[f"p{k}"] or 0) + (unseen[f"n{k}"] or 0)), -k) for k in range(len(begins))]
        k = -max(score)[1]
        p, n = unseen[f"p{k}"] or 0, unseen[f"n{k}"] or 0
        if not p or p / (p + n) < settings.precision:
            break
        rules.append(begins[k])
    return [Rule(tuple((n, a, float(cuts[n][j - 1])) for n, a, j in r)) for r in rules]


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a row with statistics, 0 for the base rules; null if none does."""
    out = F.when(base_failed(), 0)
    for i, r in enumerate(rules, 1):
        out = out.when(r.expression(), i)
    return out


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents with their statistics, base_failed, rejected_by and kept. Repeated rows are judged each; an empty table gives no rows."""
    rules = learn(docs, labels, settings)
    df = statistics(docs.select("doc_id", "text")).drop("text")
    return df.withColumns({"base_failed": base_failed(), "rejected_by": verdict(rules)}).withColumn("kept", F.col("rejected_by").isNull())
