"""N-gram Jaccard join with prefix trees.

All n-grams have one global order: by hash, but the most frequent ones (by a count sketch
of fixed size) last. A text's set in that order is a path in a trie. Two texts within the
threshold share an n-gram among the first |x| - ceil(t |x|) + 1 of each (prefix filter),
so the paths to compare meet below a shared prefix n-gram. Where few sets meet, they are
paired, and pairs that share fewer prefix n-grams than their sizes call for are left out.
Where more meet, first two of them are paired with the others and links are joined to
components; then all that are still in different components are paired, but for those
that a bitmap of parities proves to differ in too many n-grams. What is paired with one
set goes into tries of ordered sets that this set runs down: the overlap is kept per node
and shared by the paths below it, and a subtree is left when the overlap so far and the
remaining lengths cannot reach the threshold.

A node of the graph is a set, named by a 64-bit digest of its n-grams. Nothing is dropped: the sketch only decides the order, groups of any size are dealt out
over pairs of blocks, and rows with equal sets are one class. A set is empty and links
with nothing if its text is NULL or has no word; a row with a NULL id links with nothing
and has no component. Every row gets one row, also if its id repeats; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark.llm import blocks, graph, shingles
from veilmark.llm.arrow import batch, groups, let_go, tidy, utf8
from veilmark.sources.shared import cut

#: Cells of the count sketch, a byte each.
CELLS = 1 << 22
#: Sets below one prefix n-gram that are paired at once.
FEW = 8
#: Bits of a set's bitmap; a large set has half as many as n-grams, to a power of two.
BITS = 512
#: Members of a prefix n-gram in one block of a task.
BLOCK_ROWS = 2048
#: Shared prefix n-grams by which a pair that is met below several is made only once.
LISTED = 64
#: n-grams in one trie.
TRIE_GRAMS = 1 << 18
#: Queries that run down a trie together.
QUERIES = 128


def _rows(part: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    let_go()
    for lo, hi in groups(utf8(part["text"])[1], 1 << 20):
        yield lo, shingles.sets(part["text"].slice(lo, hi - lo), width)


def levels(documents: DataFrame, width: int) -> np.ndarray:
    """Level of each sketch cell: 0, or the logarithm of its count if it is far above the mean."""
    step = 1 << 16
    schema = pa.schema([("part", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.uint8)
        for part in batches:
            for _, found in _rows(part, width):
                cell, n = np.unique((np.concatenate(found) & np.uint64(CELLS - 1)).astype(np.int32), return_counts=True)
                total[cell] = np.minimum(total[cell].astype(np.int64) + n, 255)
        if total.any():
            for i in range(0, CELLS, step):
                yield batch(schema, [i // step], [total[i : i + step].tobytes()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for some in batches:
            for part, counts in zip(some["part"].to_pylist(), some["counts"].to_pylist(), strict=True):
                held[part] = held.get(part, 0) + np.frombuffer(counts, np.uint8).astype(np.int64)
        for part, total in held.items():
            usual = 2 * total.mean() + 32
            level = np.where(total > usual, np.minimum(1 + 8 * np.log2(np.maximum(total, 1) / usual), 255), 0)
            yield batch(schema, [part], [level.astype(np.uint8).tobytes()])

    kinds = "part int, counts binary"
    out = np.zeros(CELLS, np.uint8)
    for r in documents.select("text").mapInArrow(tidy(count), kinds).repartition("part").mapInArrow(add, kinds).toLocalIterator():
        out[r["part"] * step : (r["part"] + 1) * step] = np.frombuffer(r["counts"], np.uint8)
    return out


def ordered(found: np.ndarray, level: np.ndarray) -> np.ndarray:
    """A set in the global order: 8 bits of level, 56 of hash."""
    return np.sort((level[(found & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (found >> np.uint64(8)))


def _digests(found: list[np.ndarray]) -> np.ndarray:
    return np.array([int(shingles.mix(f).sum()) for f in found], np.uint64).view(np.int64)


def bitmaps(found: list[np.ndarray]) -> list[np.ndarray]:
    """For each set a power of two of 64-bit numbers; each n-gram flips one bit. Two
    bitmaps differ in no more bits than their sets in n-grams, also if the larger one is
    folded to the size of the other."""
    out = []
    for f in found:
        size = max(BITS, 1 << max(len(f) // 2 - 1, 0).bit_length())
        bit = (shingles.mix(f ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(size - 1)).astype(np.int64)
        out.append(np.packbits((np.bincount(bit, minlength=size) & 1).astype(np.uint8)).view(np.int64))
    return out


def _profiles(documents: DataFrame, width: int, level, num: int, den: int) -> DataFrame:
    """doc_id, n, rep, bits, prefix: size, digest and bitmap of each set, and its prefix n-grams."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("rep", pa.int64()), ("bits", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))]
    )

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids = part["doc_id"]
            for lo, found in _rows(part, width):
                first = [ordered(f, level.value)[: len(f) - -(-num * len(f) // den) + 1].view(np.int64) if len(f) else [] for f in found]
                yield batch(schema, ids.slice(lo, len(found)), [len(f) for f in found], _digests(found), bitmaps(found), first)

    return documents.select("doc_id", "text").mapInArrow(
        tidy(profile), "doc_id long, n long, rep long, bits array<long>, prefix array<long>"
    )


def _stored(documents: DataFrame, ids: DataFrame, width: int, level) -> DataFrame:
    """rep, grams: the ordered sets of some documents."""
    schema = pa.schema([("rep", pa.int64()), ("grams", pa.binary())])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for _, found in _rows(part, width):
                yield batch(schema, _digests(found), [ordered(f, level.value).astype(">u8").tobytes() for f in found])

    return blocks.only(documents, ids).select("text").mapInArrow(tidy(store), "rep long, grams binary")


class Trie:
    """Ordered sets as a compressed trie, run through by many queries at once."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.rows = np.array(order)
        self.sets = [sets[i] for i in order]
        self.size = np.array([len(s) for s in self.sets])
        shared = [0]
        for a, b in zip(self.sets, self.sets[1:]):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            shared.append(int(differ[0]) if len(differ) else m)
        self.shared = np.array([*shared, 0])  # grams that a row has in common with the row before it

    def run(self, queries: list[np.ndarray], num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
        """(row, queries within the threshold of it)."""
        grams, at = np.unique(np.concatenate(queries), return_inverse=True)
        member = np.zeros((len(grams) + 1, len(queries)), np.int32)
        member[at, np.repeat(np.arange(len(queries)), [len(q) for q in queries])] = 1
        n = np.array([len(q) for q in queries])

        def needed(size):
            """Overlap for den * o >= num * (n + size - o)."""
            return -(-num * (n + size) // (den + num))

        def steps(row: np.ndarray) -> np.ndarray:
            place = np.minimum(np.searchsorted(grams, row), len(grams) - 1)
            return np.where(grams[place] == row, place, len(grams))

        # (rows from lo to hi, depth, overlaps at that depth): a node of the trie.
        nodes = [(0, len(self.sets), 0, np.zeros(len(queries), np.int64))]
        while nodes:
            lo, hi, depth, overlap = nodes.pop()
            least, most = int(self.size[lo:hi].min()), int(self.size[lo:hi].max())
            # The rest of a path adds at most what is left of the longest row below and of a query.
            if not (overlap + np.minimum(most - depth, n - overlap) >= needed(least)).any():
                continue
            if hi - lo == 1:
                total = overlap + member[steps(self.sets[lo][depth:])].sum(axis=0)
                hit = np.flatnonzero(total >= needed(int(self.size[lo])))
                if len(hit):
                    yield int(self.rows[lo]), hit
                continue
            end = int(self.shared[lo + 1 : hi].min())
            if end > depth:
                overlap = overlap + member[steps(self.sets[lo][depth:end])].sum(axis=0)
            cuts = [lo, *(lo + 1 + np.flatnonzero(self.shared[lo + 1 : hi] == end)).tolist(), hi]
            nodes += [(a, b, end, overlap) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: the ``pairs`` (center, rep, n) within the threshold, but for those that others
    in the same task make needless. The sets paired with one center are dealt out over
    tries of bounded size that the center's set runs down."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in blocks.groups(batches, "task"):
            rep, asks = group["rep"].to_numpy(), group["asks"].to_numpy(zero_copy_only=False)
            sets = [np.frombuffer(g, ">u8").astype(np.uint64) for g in group["grams"].to_pylist()]
            who, whom = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(who) or not len(whom):
                continue
            trie = Trie([sets[i] for i in whom])
            for lo in range(0, len(who), QUERIES):
                some = who[lo : lo + QUERIES]
                for row, hits in trie.run([sets[i] for i in some], num, den):
                    found += [(rep[q], rep[whom[row]]) for q in some[hits].tolist()]
            if len(found) > 10_000:
                yield batch(schema, *zip(*found, strict=True))
                found = []
        if found:
            yield batch(schema, *zip(*found, strict=True))

    grams = pairs.groupBy("center").agg(F.sum("n").alias("total"))
    part = F.pmod(F.xxhash64("rep", F.lit(3)), F.ceil(F.col("total") / TRIE_GRAMS))
    members = pairs.join(grams, "center").select("center", part.alias("part"), "rep", F.lit(False).alias("asks"))
    centers = members.select("center", "part").distinct().select("center", "part", F.col("center").alias("rep"), F.lit(True).alias("asks"))
    rows = members.union(centers).join(sets, "rep").select(F.xxhash64("center", "part").alias("task"), "rep", "asks", "grams")
    return blocks.together(rows, "task").mapInArrow(tidy(verify), "a long, b long")


def _room(n, m, num: int, den: int):
    """In how many n-grams sets of these sizes may differ within the threshold."""
    return n + m - 2 * -(-num * (n + m) // (num + den))


def _least_shared(num: int, den: int) -> Column:
    """How many prefix n-grams sets of sizes n and m within the threshold share at least."""
    both, larger = F.col("n") + F.col("m"), F.greatest("n", "m")
    return F.ceil(F.lit(num) * both / (num + den)) - F.ceil(F.lit(num) * larger / den) + 1


def _allowed(num: int, den: int) -> Column:
    """In how many n-grams sets of sizes n and m within the threshold may differ."""
    both = F.col("n") + F.col("m")
    return both - 2 * F.ceil(F.lit(num) * both / (num + den))


def _of_few(prefixes: DataFrame, num: int, den: int) -> DataFrame:
    """center, rep, n: pairs of sets that meet below n-grams of few sets, if they share
    enough of them. (Pairs that also meet below others are found there.)"""
    groups_ = prefixes.where(F.col("c") <= FEW).groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("rep", "n"))).alias("g"))
    pairs = groups_.select(
        F.explode(F.expr("flatten(transform(g, (x, i) -> transform(slice(g, i + 2, size(g)), y -> struct(x.rep AS center, x.n AS m, y.rep AS rep, y.n AS n))))")).alias("p")
    ).select("p.*")
    counted = pairs.where(F.abs(F.col("n") - F.col("m")) <= _allowed(num, den)).groupBy("center", "m", "rep", "n").agg(F.count("*").alias("k"))
    return counted.where(F.col("k") >= _least_shared(num, den)).select("center", "rep", "n")


def _stars(prefixes: DataFrame, profiles: DataFrame, num: int, den: int) -> DataFrame:
    """center, rep, n: the first and the last set below each n-gram with all others, as
    far as sizes and bitmaps allow."""
    own = F.struct("rep", "n")
    ends = prefixes.groupBy("gram").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    pairs = prefixes.join(ends, "gram").select(F.explode(F.array("first", "last")).alias("p"), "rep", "n")
    room = _allowed(num, den)
    pairs = pairs.select(F.col("p.rep").alias("center"), F.col("p.n").alias("m"), "rep", "n").where(
        (F.col("rep") != F.col("center")) & (F.abs(F.col("n") - F.col("m")) <= room)
    )
    bits = profiles.select("rep", "bits")
    half = "zip_with(slice({0}, 1, size({0}) / 2), slice({0}, size({0}) / 2 + 1, size({0}) / 2), (x, y) -> x ^ y)"
    folded = {c: half.format(c).replace("size(" + c + ") / 2", f"cast(size({c}) / 2 AS int)") for c in ("bits", "center_bits")}
    differ = F.expr(
        "aggregate(zip_with("
        f"CASE WHEN size(bits) = 2 * size(center_bits) THEN {folded['bits']} ELSE bits END, "
        f"CASE WHEN size(center_bits) = 2 * size(bits) THEN {folded['center_bits']} ELSE center_bits END, "
        "(x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + coalesce(x, 0))"
    )
    marked = pairs.distinct().join(bits, "rep").join(bits.select(F.col("rep").alias("center"), F.col("bits").alias("center_bits")), "center")
    return marked.where(differ <= room).select("center", "rep", "n")


def _rest(prefixes: DataFrame, profiles: DataFrame, found: DataFrame, num: int, den: int) -> DataFrame:
    """center, rep, n: pairs of members of a prefix n-gram that are not in one component
    yet, as far as sizes and bitmaps allow.

    A pair is made below the first n-gram that lists both. Every member carries the first
    ``LISTED`` n-grams that list it, so that a task can tell; a pair that shares only later
    ones may be made a few times and is made distinct afterwards.
    """
    schema = pa.schema([("center", pa.int64()), ("rep", pa.int64()), ("n", pa.int64())])

    def first_met(gram: int, a: frozenset, b: frozenset) -> bool:
        return min(a & b, default=gram) >= gram

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in blocks.groups(batches, "task"):
            if group.num_rows < 2:
                continue
            rep, n, component, block = (group[c].to_numpy() for c in ("rep", "n", "component", "block"))
            gram, lists = group["gram"][0].as_py(), group["listed"].combine_chunks()
            seen: dict[int, frozenset] = {}

            def listed(row: int) -> frozenset:
                if row not in seen:
                    seen[row] = frozenset(lists[row].values.to_pylist())
                return seen[row]

            bits = group["bits"].combine_chunks()
            words = pc.list_value_length(bits).to_numpy()
            flat, at = bits.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(words)])
            row = np.zeros(len(rep), np.int64)
            table = {}
            for w in np.unique(words).tolist():
                own = np.flatnonzero(words == w)
                row[own] = np.arange(len(own))
                table[w] = flat[at[own][:, None] + np.arange(w)]
            apart = group["block_i"][0] != group["block_j"][0]
            for lo in range(0, len(rep), 64):
                a = slice(lo, lo + 64)
                room = _room(n[a, None], n[None, :], num, den)
                near = (component[a, None] != component[None, :]) & (rep[a, None] < rep[None, :]) & (np.abs(n[a, None] - n[None, :]) <= room)
                if apart:
                    near &= block[a, None] != block[None, :]  # pairs of one block have a task of their own
                i, j = np.nonzero(near)
                keep = np.ones(len(i), bool)
                for w in table:
                    for v in (w, w // 2, w * 2):
                        both = np.flatnonzero((words[lo + i] == w) & (words[j] == v))
                        if len(both) and v in table:
                            x, y = table[w][row[lo + i[both]]], table[v][row[j[both]]]
                            x = x[:, :v] ^ x[:, v:] if w > v else x
                            y = y[:, :w] ^ y[:, w:] if v > w else y
                            keep[both] = np.bitwise_count(x ^ y).sum(axis=1) <= room[i[both], j[both]]
                i, j = i[keep], j[keep]
                once = [k for k, (x, y) in enumerate(zip((lo + i).tolist(), j.tolist(), strict=True)) if first_met(gram, listed(x), listed(y))]
                if once:
                    i, j = i[once], j[once]
                    yield batch(schema, rep[lo + i], rep[j], n[j])

    placed = prefixes.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    ends = prefixes.groupBy("gram").agg(F.min("rep").alias("first"), F.max("rep").alias("last"))
    untried = placed.join(ends, "gram").where("rep != first AND rep != last").select("gram", "rep", "n", "component")
    among = untried.groupBy("gram").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("k"),
        F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(5))).alias("y"),
    ).where("low != high")
    # Equal groups below different n-grams are compared once.
    once = among.groupBy("x", "y", "k").agg(F.min("gram").alias("gram")).select("gram", "k")
    members = cut(untried.join(once, "gram"), "untried")
    lists = members.groupBy("rep").agg(F.slice(F.array_sort(F.collect_set("gram")), 1, LISTED).alias("listed"))
    own = profiles.select("rep", "bits").join(lists, "rep")
    tasks = blocks.tasks(members, "gram", "rep", F.ceil(F.col("k") / BLOCK_ROWS)).join(own, "rep")
    columns = ("task", "gram", "rep", "n", "component", "bits", "listed", "block", "block_i", "block_j")
    return blocks.together(tasks.select(*columns), "task").mapInArrow(tidy(pair), "center long, rep long, n long").distinct()


def join(documents: DataFrame, width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: components of the links
    ``den * intersection >= num * union``."""
    level = documents.sparkSession.sparkContext.broadcast(levels(documents, width))
    profiles = cut(_profiles(documents, width, level, num, den), "profiles")
    linkable = profiles.where("n > 0 AND doc_id IS NOT NULL")
    grams = linkable.select("rep", "n", F.explode("prefix").alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    meeting = cut(grams.join(shared, "gram", "left_semi").distinct(), "meeting")
    sizes = meeting.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1")
    prefixes = cut(meeting.join(sizes, "gram"), "prefixes")
    crowded = prefixes.where(F.col("c") > FEW).drop("c")
    classes = cut(linkable.groupBy("rep").agg(F.min("doc_id").alias("doc_id"), F.first("bits").alias("bits")), "classes")

    def links(pairs: DataFrame) -> DataFrame:
        pairs = cut(pairs, "pairs")
        wanted = pairs.select("rep").union(pairs.select("center")).distinct()
        ids = cut(classes.join(wanted, "rep", "left_semi").select("doc_id").distinct(), "set-ids")
        return cut(_verified(pairs, _stored(documents, ids, width, level), num, den), "links")

    star = links(_stars(crowded, classes, num, den).union(_of_few(prefixes, num, den)).distinct())
    joined = cut(graph.components(star).withColumnRenamed("id", "rep"), "first-components")
    rest = links(_rest(crowded, classes, joined, num, den))
    final = graph.components(star.union(rest)).withColumnRenamed("id", "rep")
    named = classes.join(final, "rep", "left").select("rep", "doc_id", F.coalesce("component", "rep").alias("component"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("rep", "component_id")
    empty = profiles.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    rows = linkable.select("rep", "doc_id", "n").join(named, "rep").select("doc_id", "n", "component_id").union(empty)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_first(documents: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """One document of each component: the one with the smallest id. Of rows that repeat
    that id with the same text one stays; rows with a NULL id stay."""
    found = cut(join(documents, width, num, den).where("doc_id = component_id"), "kept").groupBy("doc_id").agg(F.count("*").alias("c"))
    once = blocks.only(documents, found.where("c = 1").select("doc_id"))
    repeated = blocks.only(documents, found.where("c > 1").select("doc_id")).dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated).unionByName(documents.where("doc_id IS NULL"))
