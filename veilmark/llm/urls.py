"""URL filter by a character language-model ratio.

Rules decide what they fit. For all other URLs two smoothed variable-order Markov models
of characters, one of accepted and one of rejected URLs (those that rules decided), give
a log-likelihood difference per character; it is compared with a threshold calibrated on
a fifth of the decided URLs that the models have not seen.

A model mixes the orders 0 to ``ORDER``: p_k = (n(context, char) + a * p_(k-1)) /
(n(context) + a), so that a context counts for as much as is known of it. Counts are exact:
a table with a row per gram, which grows with the URLs and is joined to the characters of
each distinct text. Everything is DataFrame functions.

A NULL URL or one without ``://`` has an empty host and path, and its difference is 0. If
one class has no URL, there is no model and what no rule fits is allowed. Every row gets
one row; repeated rows count as often as they occur; other columns are ignored. URLs of any
length are judged whole. A difference equal to the threshold allows. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilmark.sources.shared import cut

ORDER = 4
#: Most grams whose log-ratios are broadcast; more are joined by a shuffle.
CELLS = 1 << 20
WEIGHT = 2.0
ALPHABET = 64.0


def split_url(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.locate("://", u) > 0, F.substring(u, F.locate("://", u) + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def by_rules(rules: Iterable[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or NULL. A rule is (verdict, host and path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _grams(texts: DataFrame) -> DataFrame:
    """id, gram, accepted, rejected: every character of ``texts`` with the ``ORDER`` before it."""
    marked = F.concat(F.lit("^" * ORDER), F.col("text"), F.lit("$"))
    chars = texts.where("text != ''").select("id", "accepted", "rejected", F.split(marked, "").alias("c"))
    of = ", ".join(f"get(c, i + {k})" for k in range(ORDER + 1))
    grams = F.expr(f"transform(sequence(0, size(c) - {ORDER + 1}), i -> concat({of}))")
    return chars.select("id", "accepted", "rejected", F.explode_outer(grams).alias("gram"))


def _ratios(grams: DataFrame) -> DataFrame:
    """gram, ratio: the log-ratio of the last character after those before it, for each of
    ``grams`` (gram, accepted, rejected; each once). All shorter grams and all contexts are
    counted from them, order by order; a gram meets one context and one shorter gram."""
    found = None
    for k in range(ORDER + 1):
        level = grams if k == ORDER else grams.groupBy(F.substring("gram", ORDER + 1 - k, k + 1).alias("gram")).agg(
            F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")
        )
        context = Window.partitionBy(F.substring("gram", 1, k))
        level = level.withColumns({f"of_{c}": F.sum(c).over(context) for c in ("accepted", "rejected")})
        if found is None:
            level = level.withColumns({f"p_{c}": F.lit(1 / ALPHABET) for c in ("accepted", "rejected")})
        else:
            level = level.withColumn("shorter", F.substring("gram", 2, k)).join(found.withColumnRenamed("gram", "shorter"), "shorter")
        found = level.select("gram", *(
            ((F.col(c) + WEIGHT * F.col(f"p_{c}")) / (F.col(f"of_{c}") + WEIGHT)).alias(f"p_{c}") for c in ("accepted", "rejected")
        ))
    return found.select("gram", F.log(F.col("p_accepted") / F.col("p_rejected")).alias("ratio"))


def differences(texts: DataFrame) -> DataFrame:
    """``texts`` (id, text, accepted, rejected; each text once) with ``difference``, the
    log-likelihood difference per character of models of the accepted and rejected counts."""
    at = _grams(texts)
    grams = cut(at.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "grams")
    ratios = cut(_ratios(grams), "ratios")
    joined = at.select("id", "gram").join(F.broadcast(ratios) if ratios.count() <= CELLS else ratios, "gram")
    # Decimals, so that a sum does not depend on the order of its parts.
    total = joined.groupBy("id").agg(F.sum(F.col("ratio").cast("decimal(20,12)")).cast("double").alias("total"))
    return texts.join(total, "id", "left").withColumn("difference", F.coalesce(F.col("total") / (F.length("text") + 1), F.lit(0.0)))


def threshold(scored: DataFrame) -> float:
    """Between the differences of the decided URLs that the models have not seen."""
    steps = [i / 100 for i in range(101)]
    of = {}
    for verdict in ("allow", "block"):
        row = scored.where(f"unseen_{verdict}").agg(F.percentile_approx("difference", steps, 10000).alias("d")).first()
        if row["d"]:
            of[verdict] = row["d"]
    if len(of) < 2:
        return 0.0
    low, high = sorted(of["block"]), sorted(of["allow"])

    def right(t: float) -> int:
        return sum(x >= t for x in high) + sum(x < t for x in low)

    points = sorted({*low, *high})
    best = max(map(right, points))
    chosen = [t for t in points if right(t) == best]
    below = [x for x in points if x < chosen[0]]
    return (chosen[0] + below[-1]) / 2 if below else chosen[0]


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, difference of every row."""
    host, path = split_url(url_column)
    parts = pages.select(id_column, host.alias("host"), path.alias("path"))
    rule, verdict = by_rules(rules, F.col("host"), F.col("path"))
    ruled = parts.withColumns({"rule": rule, "verdict": verdict})
    ruled = ruled.withColumn("text", F.lower(F.concat("host", "path")))
    kept = F.crc32(F.col("text").cast("binary")) % 5 != 0

    def n(verdict: str) -> Column:
        return F.count_if(kept & F.col("verdict").eqNullSafe(verdict))

    def unseen(verdict: str) -> Column:
        return F.max(~kept & F.col("verdict").eqNullSafe(verdict))

    texts = cut(
        ruled.groupBy("text").agg(
            n("allow").alias("accepted"), n("block").alias("rejected"), unseen("allow").alias("unseen_allow"), unseen("block").alias("unseen_block")
        ).withColumn("id", F.monotonically_increasing_id()),
        "texts",
    )
    known = texts.agg(F.max("accepted").alias("accepted"), F.max("rejected").alias("rejected")).first()
    if known["accepted"] and known["rejected"]:
        scored = cut(differences(texts).select("text", "difference", "unseen_allow", "unseen_block"), "scored")
        limit = threshold(scored)
        ruled = ruled.join(scored.select("text", "difference"), "text")
    else:
        limit, ruled = 0.0, ruled.withColumn("difference", F.lit(0.0))
    judged = F.when(F.col("difference") >= limit, F.lit("allow")).otherwise(F.lit("block"))
    return ruled.select(id_column, "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"), "difference")
