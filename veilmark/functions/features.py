"""Feature sets and weak labels as named columns of one projection."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import text as tx


def _flag(test: Column) -> Column:
    return F.when(test, F.lit(1.0)).otherwise(0.0)


def _scaled(text: Column, by: float, cap: float | None = None) -> Column:
    value = F.length(text) / F.lit(by)
    return value if cap is None else F.least(value, F.lit(cap))


def _words(text: Column, by: float) -> Column:
    return tx.n_tokens(text) / F.lit(by)


def _has(text: Column, piece: str) -> Column:
    return F.contains(text, F.lit(piece))


def _dot_and_at(text: Column) -> Column:
    return tx.has_at(text) & _has(text, ".")


def _web_domain(text: Column) -> Column:
    low = F.lower(text)
    return _has(low, ".com") | _has(low, ".net") | _has(low, ".org")


def _phone_like(text: Column) -> Column:
    return (tx.digit_count(text) >= 10) & text.rlike(r"[-()+]")


def final(text: Column) -> dict[str, Column]:
    return {
        "length": _scaled(text, 50, 2.0),
        "has_at": _flag(tx.has_at(text)),
        "dot_after_at": _flag(tx.dot_after_last_at(text)),
        "digit_ratio": tx.digit_ratio(text),
        "has_title": _flag(text.rlike(tx.HAS_TITLE_WORD)),
        "words": _words(text, 20),
    }


def simple(text: Column) -> dict[str, Column]:
    return {
        "length": _scaled(text, 100),
        "has_at": _flag(tx.has_at(text)),
        "has_dot": _flag(_dot_and_at(text)),
        "digit_ratio": tx.digit_ratio(text),
        "has_title": _flag(text.rlike(tx.HAS_TITLE_WORD)),
        "words": _words(text, 10),
        "has_hyphen": _flag(_has(text, "-")),
        "has_parentheses": _flag(_has(text, "(") & _has(text, ")")),
    }


def proper(text: Column) -> dict[str, Column]:
    return {
        "length": _scaled(text, 100, 1.0),
        "has_at": _flag(tx.has_at(text)),
        "web_domain": _flag(_web_domain(text)),
        "digit_ratio": tx.digit_ratio(text),
        "phone_like": _flag(_phone_like(text)),
        "has_title": _flag(text.rlike(tx.HAS_TITLE_WORD)),
        "honorific": _flag(text.rlike(tx.has_word(catalog.HONORIFICS))),
        "street": _flag(text.rlike(tx.has_word(catalog.STREET_WORDS))),
    }


def improved(text: Column) -> dict[str, Column]:
    return {
        "length": _scaled(text, 50, 2.0),
        "has_at": _flag(tx.has_at(text)),
        "is_email": _flag(text.rlike(catalog.SEARCH_EMAIL)),
        "has_phone": _flag(text.rlike(catalog.spelled_out(catalog.SEARCH_PHONE))),
        "digit_ratio": tx.digit_ratio(text),
        "many_digits": _flag(tx.digit_ratio(text) > 0.3),
        "has_title": _flag(text.rlike(tx.HAS_LONG_TITLE_WORD)),
        "honorific": _flag(text.rlike(tx.has_word(catalog.HONORIFICS))),
        "street": _flag(text.rlike(tx.has_word(catalog.STREET_WORDS_LONG))),
        "special": _flag(text.rlike("[#$%&*]")),
        "words": _words(text, 10),
        "has_caps": _flag(text.rlike(tx.HAS_CAPS_WORD)),
    }


def tiny(text: Column) -> dict[str, Column]:
    return {
        "length": _scaled(text, 100, 1.0),
        "has_digit": _flag(tx.digit_count(text) > 0),
        "has_at": _flag(tx.has_at(text)),
        "has_dot": _flag(_dot_and_at(text)),
    }


def check(text: Column) -> dict[str, Column]:
    return {
        "length": _scaled(text, 100, 1.0),
        "has_at": _flag(tx.has_at(text)),
        "has_dot": _flag(_dot_and_at(text)),
        "digit_ratio": tx.digit_ratio(text),
        "has_title": _flag(text.rlike(tx.HAS_TITLE_WORD)),
    }


def word(token: Column) -> dict[str, Column]:
    return {
        "length": F.least(F.length(token) / F.lit(10.0), F.lit(2.0)),
        "has_at": _flag(tx.has_at(token)),
        "has_dot": _flag(_dot_and_at(token)),
        "digit_ratio": tx.digit_ratio(token),
        "first_upper": _flag(tx.starts_upper(token)),
        "words": _words(token, 10),
    }


def word_token(token: Column) -> dict[str, Column]:
    """Same as :func:`word` for one word of letters, digits and underscores: it
    holds no '@', no '.' and no blank, so three features are constants."""
    digits = F.when(token.rlike(tx.DIGIT), tx.digit_ratio(token)).otherwise(0.0)
    return {
        "length": F.least(F.length(token) / F.lit(10.0), F.lit(2.0)),
        "has_at": F.lit(0.0),
        "has_dot": F.lit(0.0),
        "digit_ratio": digits,
        "first_upper": _flag(tx.starts_upper(token)),
        "words": F.lit(0.1),
    }


SETS = {
    "final": final, "simple": simple, "proper": proper, "improved": improved,
    "tiny": tiny, "check": check, "word": word,
}


def in_context(chunk: Column, context: Column) -> dict[str, Column]:
    """Features of a chunk read after its context, if it has one."""
    return final(F.when(context != "", F.concat(context, F.lit(" "), chunk)).otherwise(chunk))


def chunk_facts(chunk: Column) -> Column:
    """What a chunk contributes to the features of any text it is part of."""
    return F.struct(
        F.length(chunk).alias("n"),
        tx.has_at(chunk).alias("at"),
        tx.dot_after_last_at(chunk).alias("dot_after"),
        _has(chunk, ".").alias("dot"),
        tx.digit_count(chunk).alias("digits"),
        chunk.rlike(tx.HAS_TITLE_WORD).alias("title"),
        tx.n_tokens(chunk).alias("words"),
    )


def from_facts(before: Column, after: Column, own: Column) -> Column:
    """Feature array of "before after own" joined by blanks, from the parts' facts.

    Equal to :func:`in_context`: words do not cross a blank, counts add up, and
    the last '@' lies in the last part that has one. The parts before and
    after may be NULL; a missing "before" still leaves its blank.
    """
    either = before.isNotNull() | after.isNotNull()

    def count(name: str) -> Column:
        return F.coalesce(before[name], F.lit(0)) + F.coalesce(after[name], F.lit(0)) + own[name]

    def flag(part: Column, name: str) -> Column:
        return F.coalesce(part[name], F.lit(False))

    blanks = F.when(after.isNotNull(), 1).otherwise(0) + F.when(either, 1).otherwise(0)
    chars = count("n") + blanks
    dotted = (
        F.when(own["at"], own["dot_after"])
        .when(flag(after, "at"), flag(after, "dot_after") | own["dot"])
        .when(flag(before, "at"), flag(before, "dot_after") | flag(after, "dot") | own["dot"])
        .otherwise(F.lit(False))
    )
    return F.array(
        F.least(chars / F.lit(50.0), F.lit(2.0)),
        _flag(own["at"] | flag(before, "at") | flag(after, "at")),
        _flag(dotted),
        count("digits") / F.greatest(chars, F.lit(1)),
        _flag(own["title"] | flag(before, "title") | flag(after, "title")),
        count("words") / F.lit(20.0),
    )


def weak_label(name: str, f: dict[str, Column] | None = None) -> Column:
    """0/1 label computed from the columns of the feature set of that name."""

    def on(c: str) -> Column:
        return (f[c] if f else F.col(c)) > 0.5

    def value(c: str) -> Column:
        return f[c] if f else F.col(c)

    rules = {
        "final": lambda: (on("has_at") & on("dot_after_at")) | (value("digit_ratio") > 0.3),
        "simple": lambda: (on("has_at") & on("has_dot"))
        | (value("digit_ratio") > 0.4)
        | (on("has_title") & (value("digit_ratio") > 0.2)),
        # two words or more: the word count is not one of the features
        "proper": lambda: (on("has_at") & on("web_domain"))
        | on("phone_like")
        | (on("has_title") & (F.col("n_tokens") >= 2) & (value("digit_ratio") > 0.3)),
        "improved": lambda: on("is_email")
        | on("has_phone")
        | (on("has_title") & on("many_digits"))
        | (on("honorific") & on("has_title")),
        "tiny": lambda: on("has_digit") & on("has_at") & on("has_dot"),
        "check": lambda: (on("has_at") & on("has_dot")) | (value("digit_ratio") > 0.3),
    }
    return rules[name]().cast("int")


@cache
def columns(text: str, feature_set: str) -> dict[str, Column]:
    """Feature columns of a text column, built once per process."""
    return SETS[feature_set](F.col(text))


def featurize(df: DataFrame, text: str = "text", feature_set: str = "final") -> DataFrame:
    """Adds the columns of a feature set and its weak label ``label``."""
    wide = df.select("*", *[c.alias(n) for n, c in columns(text, feature_set).items()])
    if feature_set == "proper":
        wide = wide.withColumn("n_tokens", tx.n_tokens(F.col(text)))
    return wide.withColumn("label", weak_label(feature_set)) if feature_set != "word" else wide


def names(feature_set: str) -> list[str]:
    return list(columns("text", feature_set))


def scaler(df: DataFrame, names: list[str]) -> DataFrame:
    """One row: mean and population standard deviation per column (0 becomes 1)."""
    stats = []
    for c in names:
        spread = F.stddev_pop(c)
        stats += [F.avg(c).alias(f"{c}_mean"), F.when(spread > 0, spread).otherwise(1.0).alias(f"{c}_std")]
    return df.agg(*stats)


def standardise(df: DataFrame, names: list[str], fitted: DataFrame | None = None) -> DataFrame:
    """(x - mean) / std with a stored scaler, or one fitted on ``df`` itself."""
    fitted = scaler(df, names) if fitted is None else fitted
    row = fitted.select(F.struct("*").alias("s")).scalar()
    others = [F.col(c) for c in df.columns if c not in names]
    return df.select(
        *others, *[((F.col(c) - row[f"{c}_mean"]) / row[f"{c}_std"]).alias(c) for c in names]
    )


def vector(names: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in names])
