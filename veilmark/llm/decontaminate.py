"""Benchmark decontamination by template canonicalisation.

Numbers, units after a number, and names (capitalised words within a sentence) become
typed placeholders. Windows of ``WIDTH`` template words of all documents are hash-joined
with those of the benchmark items; a document is contaminated by an item if it holds at
least ``share`` of the item's distinct windows and the slots agree: under the alignment
of the shared windows each value in the item's slots stands for one value in the
document's, for at least ``share`` of the item's values. Windows are aligned with their
first places in the document; where those do not agree, the item is looked for around every
place of its windows, so that a variant that stands before it does not hide it. So a
question with other numbers or names is found, a table that merely looks alike is not.
Everything is DataFrame functions.

An item of fewer than ``WIDTH`` template words, but ``shortest`` or more, is one window of
its own length, and all of its slot values must be equal: a document holds it if it holds
its words in a row. (Items of fewer words than that parameter are ordinary phrases that
identify nothing.)

Rows with the same id count as one document, a NULL id as an id of its own. NULL texts
and texts of fewer words than a window share none. Repeated items are found each. Runs of
numbers or names of any length are matched without recursion, in time that grows with the
text. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark.functions.arrays import let
from veilmark.llm import blocks
from veilmark.sources.shared import cut

WIDTH = 5
#: Most windows of benchmark items that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

# Unit words.
UNITS = (
    "km", "cm", "mm", "m", "kg", "mg", "g", "lb", "lbs", "oz", "l", "ml", "s", "ms", "min", "h", "hrs", "hr", "mph", "kmh", "usd", "eur",
    "miles", "mile", "meters", "metres", "meter", "metre", "feet", "foot", "inches", "inch", "yards", "hours", "hour", "minutes",
    "minute", "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years", "year", "dollars", "dollar", "euros",
    "euro", "cents", "cent", "percent", "degrees", "degree", "liters", "litres", "gallons", "pounds", "grams", "kilograms", "tons",
)
NUMBER = r"\p{N}+(?:[.,]\p{N}+)*"
WITH_UNIT = rf"{NUMBER}[ ]?(%|(?i:{'|'.join(sorted(UNITS, key=lambda u: (-len(u), u)))}))([^\p{{L}}\p{{N}}]|$)"
NAME = r"([^.!?: \t\r\n][ \t\r\n]+)(\p{Lu}\p{Ll}+(?:[ ]\p{Lu}\p{Ll}+)*)"
SPLIT = r"[^\p{L}\p{N}]+"
# The same for the JVM's matcher: inner loops give nothing back (nothing after them could use
# it), which spares it the recursion, and a number is not tried again from its middle.
_NUMBER = r"\p{N}++(?:[.,]\p{N}++)*+"
_WITH_UNIT = r"(?<!\p{N})(?<!\p{N}[.,])" + WITH_UNIT.replace(NUMBER, _NUMBER)
_NAME = r"([^.!?: \t\r\n][ \t\r\n]++)(\p{Lu}\p{Ll}++(?:[ ]\p{Lu}\p{Ll}++)*+)"
# Placeholders start with a letter that no benchmark or document language uses.
P_NUMBER, P_UNIT, P_NAME = "ʘnum", "ʘunit", "ʘname"


def _without_numbers(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _WITH_UNIT, f" {P_NUMBER} {P_UNIT} $2"), _NUMBER, f" {P_NUMBER} ")


def template(text: Column) -> Column:
    """The template words of a text."""
    words = F.split(F.lower(F.regexp_replace(_without_numbers(F.coalesce(text, F.lit(""))), _NAME, f"$1 {P_NAME} ")), SPLIT)
    return F.filter(words, lambda w: w != "")


def _digests(words: Column, width: int) -> Column:
    """The digests of all ``width`` words in a row; each word is hashed once."""
    def of(h: Column) -> Column:
        places = F.when(F.size(h) >= width, F.slice(h, F.lit(1), F.size(h) - (width - 1)))
        return F.transform(places, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, width))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def windows(rows: DataFrame, id_column: str) -> DataFrame:
    """id, at, window: the hash of the template words from place ``at`` on."""
    arrays = rows.select(id_column, _digests(template(F.col("text")), WIDTH).alias("h"))
    return arrays.select(id_column, F.posexplode_outer("h").alias("at", "window")).where("window IS NOT NULL")


def _slots(rows: DataFrame, id_column: str, value: str) -> DataFrame:
    """id, at, kind, value: what stands in each placeholder."""
    text = F.coalesce("text", F.lit(""))
    found = {
        P_NUMBER: F.regexp_extract_all(text, F.lit(_NUMBER), 0),
        P_UNIT: F.regexp_extract_all(text, F.lit(_WITH_UNIT), 1),
        P_NAME: F.regexp_extract_all(_without_numbers(text), F.lit(_NAME), 2),
    }

    def of_kind(words: Column, kind: str, values: Column) -> Column:
        at = F.filter(F.transform(words, lambda w, i: F.when(w == kind, i)), lambda i: i.isNotNull())
        return F.zip_with(at, values, lambda i, v: F.struct(i.alias("at"), F.lit(kind).alias("kind"), F.lower(v).alias(value)))

    def of(words: Column) -> Column:
        return F.concat(*(of_kind(words, *kv) for kv in found.items()))

    slots = rows.select(id_column, F.explode_outer(let(template(F.col("text")), of)).alias("s"))
    return slots.select(id_column, "s.*").where("at IS NOT NULL")


def find(documents: DataFrame, benchmark: DataFrame, share: float = 0.8, shortest: int = 4) -> DataFrame:
    """doc_id, item_id, n_windows, n_found, n_values, n_agreeing of each contamination."""
    found = _by_windows(documents, benchmark, share)
    sized = benchmark.select("item_id", "text", F.size(template(F.col("text"))).alias("__size"))
    short = cut(sized.where(F.col("__size").between(shortest, WIDTH - 1)).drop("__size"), "short-items")
    return found if short.isEmpty() else found.unionByName(_whole(documents, short))


def _whole(documents: DataFrame, short: DataFrame) -> DataFrame:
    """The contaminations by items that are found as a whole."""
    def words(text: str) -> Column:
        return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT), lambda w: w != "")

    sized = short.withColumn("n", F.size(words("text")))
    lengths = sorted(r["n"] for r in sized.select("n").distinct().collect())  # a few small numbers
    items = sized.select("item_id", "n", F.coalesce(*(F.when(F.col("n") == n, F.get(_digests(words("text"), n), F.lit(0))) for n in lengths)).alias("h"))
    values = _slots(short, "item_id", "value").groupBy("item_id").agg(F.countDistinct("kind", "value").alias("n_values"))
    items = items.distinct().join(values.withColumnRenamed("item_id", "i"), F.col("item_id").eqNullSafe(F.col("i")), "left").drop("i")

    def sized_windows(n: int) -> Column:
        return F.transform(F.coalesce(_digests(words("text"), n), F.array().cast("array<long>")), lambda h: F.struct(F.lit(n).alias("n"), h.alias("h")))

    each = [sized_windows(n) for n in lengths]
    own = documents.select("doc_id", F.explode_outer(F.concat(*each)).alias("x")).where("x IS NOT NULL").select("doc_id", "x.n", "x.h")
    hits = own.join(F.broadcast(items) if items.count() <= BROADCAST_ROWS else items, ["n", "h"])
    one, values = F.lit(1).cast("long"), F.coalesce("n_values", F.lit(0)).cast("long")
    return hits.select(
        "doc_id", "item_id", one.alias("n_windows"), one.alias("n_found"), values.alias("n_values"), values.alias("n_agreeing")
    ).distinct()


def _by_windows(documents: DataFrame, benchmark: DataFrame, share: float) -> DataFrame:
    """The contaminations by items of ``WIDTH`` template words or more."""
    items = windows(benchmark, "item_id").groupBy("item_id", "window").agg(F.min("at").alias("item_at"))
    n_items = items.count()
    sizes = items.groupBy("item_id").agg(F.count("*").alias("n_windows"))
    of_documents = windows(documents, "doc_id")
    shared = of_documents.join(F.broadcast(items) if n_items <= BROADCAST_ROWS else items, "window")
    # First by alignment, so that what a document repeats is summed up before it moves on.
    aligned = shared.groupBy("doc_id", "item_id", "item_at").agg(F.min("at").alias("at"))
    found = cut(
        aligned.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_found"), F.collect_list(F.struct("item_at", "at")).alias("places"))
        .join(sizes, "item_id")
        .where(F.col("n_found") >= share * F.col("n_windows")),
        "found",
    )
    first = found.select("doc_id", "item_id", F.lit(0).alias("shift"), F.explode("places").alias("p")).select(
        "doc_id", "item_id", "shift", "p.item_at", "p.at"
    )
    judged = cut(_judged(found.withColumn("shift", F.lit(0)), _agreement(first, documents, benchmark), share), "judged")
    kept = judged.where("agrees").select("doc_id", "item_id", "n_windows", "n_found", "n_values", "n_agreeing")
    if judged.where("NOT agrees").isEmpty():
        return kept
    others = _occurrences(judged.where("NOT agrees"), items, documents)
    sized = others.groupBy("doc_id", "item_id", "shift", "n_windows").agg(F.count("*").alias("n_found")).where(
        F.col("n_found") >= share * F.col("n_windows")
    )
    apart = _judged(sized, _agreement(others, documents, benchmark), share).where("agrees")
    best = F.max_by(F.struct("n_windows", "n_found", "n_values", "n_agreeing"), F.struct("n_found", "n_agreeing", -F.col("shift")))
    return kept.unionByName(apart.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*"))


def _judged(found: DataFrame, agreement: DataFrame, share: float) -> DataFrame:
    """doc_id, item_id, shift, n_windows, n_found, n_values, n_agreeing, agrees."""
    same = [found[c].eqNullSafe(agreement[o]) for c, o in (("doc_id", "d"), ("item_id", "i"), ("shift", "o"))]
    return found.join(agreement, same[0] & same[1] & same[2], "left").select(
        "doc_id", "item_id", "shift", "n_windows", "n_found",
        F.coalesce("n_values", F.lit(0)).cast("long").alias("n_values"),
        F.coalesce("n_agreeing", F.lit(0)).cast("long").alias("n_agreeing"),
    ).withColumn("agrees", F.col("n_agreeing") >= share * F.col("n_values"))


def _occurrences(pairs: DataFrame, items: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, shift, item_at, at: the places of an item's windows in a
    document around each ``shift`` (a place less the item's) that one of them has. A window
    stands at the place nearest to it, no farther off than the item is long; shifts that are
    so near to each other meet in slices of that length."""
    ids = cut(pairs.select(F.col("doc_id")).distinct(), "again-ids")
    again = documents.join(blocks.small(ids.withColumnRenamed("doc_id", "__id")), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    wanted = pairs.select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"), "n_windows").join(
        items, F.col("i").eqNullSafe(F.col("item_id"))
    ).select("d", "i", "n_windows", "window", "item_at")
    at = windows(again, "doc_id").withColumnRenamed("window", "w")
    places = cut(
        wanted.join(at, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("window") == F.col("w")))
        .select("d", "i", "n_windows", "item_at", "at", (F.col("at") - F.col("item_at")).alias("off")),
        "places",
    )
    slice_of = F.floor(F.col("off") / F.col("n_windows"))
    shifts = places.select(
        F.col("d").alias("doc_id"), F.col("i").alias("item_id"), F.col("off").alias("shift"), slice_of.alias("slice")
    ).distinct().withColumn("slice", F.explode(F.array(F.col("slice") - 1, F.col("slice"), F.col("slice") + 1)))
    near = places.withColumn("s", slice_of).join(
        shifts, F.col("d").eqNullSafe(F.col("doc_id")) & F.col("i").eqNullSafe(F.col("item_id")) & (F.col("s") == F.col("slice"))
    ).where(F.abs(F.col("off") - F.col("shift")) <= F.col("n_windows"))
    return near.groupBy("doc_id", "item_id", "n_windows", "shift", "item_at").agg(
        F.min_by("at", F.struct(F.abs(F.col("off") - F.col("shift")), "at")).alias("at")
    )


def _agreement(aligned: DataFrame, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """d, i, o, n_values, n_agreeing: the item's slot values, and those that stand for one
    value in the document, under each alignment (doc_id, item_id, shift, item_at, at)."""
    places = aligned.select(
        F.col("doc_id").alias("d"), F.col("item_id").alias("i"), F.col("shift").alias("o"),
        F.explode(F.expr(f"transform(sequence(0, {WIDTH - 1}), k -> struct(item_at + k AS item_at, at + k AS at))")).alias("p"),
    ).select("d", "i", "o", "p.item_at", "p.at").distinct()
    item_slots = _slots(benchmark, "item_id", "item_value").withColumnRenamed("at", "item_at")
    own = places.join(item_slots, (places["i"] == item_slots["item_id"]) & (places["item_at"] == item_slots["item_at"])).select(
        "d", "i", "o", places["at"], "kind", "item_value"
    )
    ids = cut(own.select(F.col("d").alias("doc_id")).distinct(), "slot-ids")
    slots = _slots(blocks.only(documents, ids), "doc_id", "value").withColumnsRenamed({"doc_id": "s_id", "at": "s_at", "kind": "s_kind"})
    pairs = own.join(slots, (own["d"] == slots["s_id"]) & (own["at"] == slots["s_at"]) & (own["kind"] == slots["s_kind"]))
    values = pairs.groupBy("d", "i", "o", "kind", "item_value").agg(F.countDistinct("value").alias("n"))
    return values.groupBy("d", "i", "o").agg(F.count("*").alias("n_values"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("n_agreeing"))


def keep_clean(documents: DataFrame, benchmark: DataFrame, share: float = 0.8) -> DataFrame:
    """The documents that no benchmark item contaminates."""
    hit = cut(find(documents, benchmark, share).select(F.col("doc_id").alias("__hit")).distinct(), "hits")
    return documents.join(blocks.small(hit), documents["doc_id"].eqNullSafe(hit["__hit"]), "left_anti")
