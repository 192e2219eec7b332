"""Quality rules judged by host.

Each text is measured (words, symbols, repeated lines, repeated three-word windows) and
tested against the rules. The failures of every rule are counted by host, and a host's
failure rate is drawn towards the other hosts by a beta prior fitted to all of them: its
mean is the rate over all documents, its strength comes from how much more the hosts
differ than chance makes them. A host whose shrunk rate of a rule is over ``bad`` loses
all documents; one over ``doubtful`` loses those that fail that rule themselves. Everything
is DataFrame functions; texts never move, only a row of measures per document does.

A NULL text has no words and fails as a short one. A NULL source counts as an empty one,
which is a host like any other. Rows with the same id or text are judged each and count
each. An empty table gives no rows. Of other columns only ``source`` is read. Windows are
compared by 64-bit digests within one text; there is no limit on its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark.functions.arrays import let
from veilmark.llm.blocks import BROADCAST_ROWS
from veilmark.sources.shared import cut

# What separates words, and what counts as a symbol.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Failure of each rule, over the measures of a text.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "lines": "100 * n_dup_lines > 30 * n_lines",
    "symbols": "100 * n_symbols > 10 * n_words",
    "lengths": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 14 * n_words)",
}
#: Documents' worth of a prior at least and at most.
STRENGTH = (1.0, 1e6)
#: Parts of a host when its verdict is joined by a shuffle.
SALTS = 64


def _covered(grams: Column) -> Column:
    """How many words are in windows (one digest per place) that occur twice or more."""

    def among(ranked: Column) -> Column:
        def same(x: Column, other: Column) -> Column:
            return F.coalesce(x["g"] == other["g"], F.lit(False))

        repeated = F.filter(ranked, lambda x, i: same(x, F.get(ranked, i - 1)) | same(x, F.get(ranked, i + 1)))
        places = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        return let(
            places,
            lambda p: F.aggregate(
                F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))),
                F.lit(0),
                lambda total, x: total + F.coalesce(x, F.lit(0)),
            ),
        )

    ranked = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(ranked, among)).otherwise(0)


def _repeat_words(words: Column) -> Column:
    def of(digests: Column) -> Column:
        grams = F.transform(
            F.slice(digests, F.lit(1), F.size(digests) - 2),
            lambda x, i: F.xxhash64(x, F.get(digests, i + 1), F.get(digests, i + 2)),
        )
        return F.when(F.size(digests) > 3, let(grams, _covered)).otherwise(0)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, source and the measures of each text."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = documents.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    )
    return counted.select("doc_id", "source", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def rates(failures: DataFrame) -> DataFrame:
    """source, and for each rule the shrunk failure rate of that host. ``failures`` has a
    column per rule: whether the document fails it."""
    hosts = cut(
        failures.groupBy("source").agg(F.count("*").cast("double").alias("n"), *(F.sum(F.col(r).cast("double")).alias(r) for r in RULES)),
        "hosts",
    )
    totals = hosts.agg(
        F.count("*").alias("h"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        *(F.sum(r).alias(r) for r in RULES), *(F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_2") for r in RULES),
    )
    prior = totals.select(*(p.alias(f"{r}_{k}") for r in RULES for k, p in _prior(r).items())).first()  # ten numbers
    return hosts.select(
        "source",
        *(((F.col(r) + F.lit(prior[f"{r}_mean"]) * F.lit(prior[f"{r}_strength"])) / (F.col("n") + F.lit(prior[f"{r}_strength"]))).alias(r) for r in RULES),
    )


def _prior(rule: str) -> dict[str, Column]:
    """Mean and strength (mean (1 - mean) / variance between hosts - 1) of a rule's prior."""
    mean = F.col(rule) / F.col("n")
    chance = mean * (1 - mean)
    spread = F.col(f"{rule}_2") - F.col("n") * mean * mean
    between = (spread - (F.col("h") - 1) * chance) / (F.col("n") - F.col("nn") / F.col("n"))
    low, high = STRENGTH
    strength = F.when((F.col("h") > 1) & (between > 0), F.least(F.greatest(chance / between - 1, F.lit(low)), F.lit(high))).otherwise(high)
    return {"mean": mean, "strength": strength}


def judge(documents: DataFrame, bad: float = 0.5, doubtful: float = 0.25) -> DataFrame:
    """doc_id, the measures, base_failed (the rules ``short`` and ``repeats``), kept, and
    host_verdict: ``good``, ``doubtful`` or ``bad``."""
    rows = cut(measures(documents), "measures").select("*", *(F.expr(r).alias(name) for name, r in RULES.items()))
    marks = [F.when(F.col(r) > bad, 2).when(F.col(r) > doubtful, 1).otherwise(0).alias(f"host_{r}") for r in RULES]
    verdicts = cut(rates(rows).select(F.col("source").alias("host"), *marks), "verdicts")
    verdicts = verdicts.where(" OR ".join(f"host_{r} > 0" for r in RULES))  # other hosts need no row
    if verdicts.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(verdicts), F.col("source") == F.col("host"), "left")
    else:  # a host may hold a third of all rows: its verdict is copied, its rows are dealt out
        salted = verdicts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
        joined = rows.join(salted, (F.col("source") == F.col("host")) & (own == F.col("part")), "left")
    worst = F.coalesce(F.greatest(*(f"host_{r}" for r in RULES)), F.lit(0))
    fails_where_many_do = F.coalesce(F.expr(" OR ".join(f"({r} AND host_{r} > 0)" for r in RULES)), F.lit(False))
    base_failed = F.col("short") | F.col("repeats")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & (worst < 2) & ~fails_where_many_do).alias("kept"),
        F.element_at(F.array(*map(F.lit, ("good", "doubtful", "bad"))), worst + 1).alias("host_verdict"),
    )
