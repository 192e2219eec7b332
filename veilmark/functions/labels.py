"""BIO label arrays and token ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import text as tx
from veilmark.functions.arrays import indices, let, pad

OUTSIDE = "O"
PAD_TOKEN = "[PAD]"


def parse(literal: Column) -> Column:
    """``"['O', 'B-X']"`` to an array; NULL, '' and anything unreadable to []."""
    parsed = F.from_json(F.translate(literal, "'", '"'), "array<string>")
    return F.coalesce(parsed, F.array().cast("array<string>"))


def render(labels: Column) -> Column:
    """Inverse of :func:`parse`."""
    return F.when(F.size(labels) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("['"), F.array_join(labels, "', '"), F.lit("']"))
    )


def tag(token: Column) -> Column:
    """Rule-based label of one token."""
    return (
        F.when(
            tx.starts_upper(token) & (F.length(token) > 1),
            F.when(tx.is_all_caps(token), OUTSIDE).otherwise("B-PERSON"),
        )
        .when(F.contains(token, F.lit("@")) & F.contains(token, F.lit(".")), "B-EMAIL")
        .when(token.rlike(f"^{catalog.spelled_out(catalog.TAGGER_PHONE)}"), "B-PHONE")
        .when(token.rlike(f"^{catalog.spelled_out(catalog.TAGGER_SSN)}"), "B-SSN")
        .otherwise(OUTSIDE)
    )


def tags(tokens: Column) -> Column:
    return F.transform(tokens, tag)


def demo_tags(tokens: Column) -> Column:
    """First two tokens are one PERSON; texts of one token get none."""
    return let(
        tokens,
        lambda ts: F.transform(
            ts,
            lambda t, i: F.when(F.size(ts) < 2, OUTSIDE)
            .when(i == 0, "B-PERSON")
            .when(i == 1, "I-PERSON")
            .otherwise(OUTSIDE),
        ),
    )


def align(predicted: Column, truth: Column) -> Column:
    """Predicted labels cut or filled with 'O' to the length of the truth."""
    return pad(predicted, F.size(truth), F.lit(OUTSIDE))


def is_pii(label: Column) -> Column:
    return label != OUTSIDE


def binary(labels: Column) -> Column:
    return F.transform(labels, lambda x: is_pii(x).cast("int"))


def class_of(label: Column) -> Column:
    """0 = O, 1 = B-, 2 = I-."""
    return F.when(label.startswith("B-"), 1).when(label.startswith("I-"), 2).otherwise(0)


def classes(labels: Column, max_len: int) -> Column:
    """The class of each label, cut or padded with 0."""
    return pad(F.transform(labels, class_of), F.lit(max_len), F.lit(0))


def entity_type(label: Column) -> Column:
    """What stands between the first and the second '-'; NULL without one."""
    return F.get(F.split(label, "-"), F.lit(1))


def token_bucket(token: Column, buckets: int) -> Column:
    """Stable bucket of a token from the first 32 bits of its MD5."""
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def fast_token_bucket(token: Column, buckets: int) -> Column:
    """Same idea with the built-in 64-bit hash (cheaper, Spark only)."""
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def token_ids(tokens: Column, buckets: int, max_len: int) -> Column:
    ids = F.transform(F.slice(tokens, 1, max_len), lambda t: token_bucket(t, buckets))
    return pad(ids, F.lit(max_len), F.lit(0))


def padded_tokens(tokens: Column, max_len: int) -> Column:
    return pad(tokens, F.lit(max_len), F.lit(PAD_TOKEN))


def attention_mask(tokens: Column, max_len: int, all_ones: bool = False) -> Column:
    return let(
        F.size(tokens),
        lambda n: F.transform(
            indices(F.lit(max_len)), lambda i: (F.lit(True) if all_ones else i < n).cast("int")
        ),
    )


def pii_count(labels: Column) -> Column:
    return F.size(F.filter(labels, is_pii))


def counts(truth: Column, predicted: Column) -> Column:
    """Per-row token counts; ``predicted`` must be aligned with ``truth``."""
    codes = F.zip_with(truth, predicted, lambda t, p: is_pii(t).cast("int") * 2 + is_pii(p).cast("int"))

    def tally(code: Column) -> Column:
        def n(value: int) -> Column:
            return F.size(F.filter(code, lambda c: c == value)).cast("long")

        return F.struct(
            F.size(code).cast("long").alias("n"), n(3).alias("tp"), n(1).alias("fp"), n(2).alias("fn"), n(0).alias("tn")
        )

    return let(codes, tally)
