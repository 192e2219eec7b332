"""Best-fit packing by a configuration linear program.

Documents become token ids and one end id; only those longer than the capacity are cut
into pieces of the capacity, the last one shorter. The histogram of piece lengths (at
most one bar per length) is all that the driver sees. A fractional cover of the bars by
configurations (multisets of lengths that fit one sequence) is found by multiplicative
weights: each step prices the lengths, takes the dearest configuration by dynamic
programming over the capacity (an unbounded knapsack), and lowers the prices of what it
covers. The cover is rounded down to whole, full sequences and the rest of the histogram is
packed best fit, longest first. Pieces of one length are numbered on the cluster and
take the places of their length in that order.

NULL text is empty: a piece of the end id alone. Every row gets its own pieces, also one
whose id is NULL or repeats; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilmark.llm.arrow import Recent, batch, held, text_groups, tidy
from veilmark.sources.shared import cut

#: Words of each age that a worker remembers.
REMEMBER = 150_000
#: Numbers of pieces of one length are counted in this many parts.
PARTS = 1024


_SIMPLE = re.compile(r"[ \n\t\r!-&(-~À-ÖØ-öø-ÿ]*").fullmatch
_PRE_TOKENS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+").findall


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Encoder:
    """Token ids of texts, as little-endian bytes.

    In texts of Latin letters, digits and plain punctuation, runs of letters, single
    digits and runs of punctuation are pre-tokens, each encoded by the model alone. Of
    other texts only the words between spaces and line feeds that are so simple go that
    way, and all other words through the whole tokenizer: nothing crosses a space or line
    feed. What has been seen lately is remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.seen = Recent(REMEMBER)
        printable = "".join(chr(c) for c in [*range(32, 127), *range(192, 256)])
        for probe in ("a  b\nc", "́x ́y\ńz", "Ab'S'll \t1 2,5..", printable, " ".join(printable), "ÄÉÿß!?ab12.", "日本 x"):
            if self.ids([probe])[0] != self._whole(probe):
                raise ValueError("this tokenizer cuts or normalises texts in another way")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode(self, word: str) -> bytes:
        if word[0] == "\0":
            return self._whole(word[1:])
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    @staticmethod
    def _cut(text: str) -> list[str]:
        """Pre-tokens, and words marked with NUL that are none."""
        if _SIMPLE(text) and "<|" not in text:
            return _PRE_TOKENS(text.lower())
        out = []
        for word in text.replace("\n", " ").split(" "):
            if _SIMPLE(word) and "<|" not in word:
                out += _PRE_TOKENS(word.lower())
            else:
                out.append("\0" + word)
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        lists = [self._cut(t) for t in texts]
        new = self.seen.missing(set().union(*lists))
        of = self.seen.new
        of.update(zip(new, map(self._encode, new), strict=True))
        return [b"".join(map(of.__getitem__, words)) for words in lists]


def pieces_of(documents: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """doc_id, row, piece, start, length, ids_crc32: the cut token ids of every row."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )
    end = np.array([end_id], "<u4").tobytes()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(("encoder", tokenizer), lambda: Encoder(tokenizer))
        for part in batches:
            ids = part["doc_id"].to_pylist()
            for lo, texts in text_groups(part["text"]):
                rows = []
                for doc_id, tokens in zip(ids[lo : lo + len(texts)], own.ids(texts), strict=True):
                    tokens += end
                    for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                        some = tokens[at : at + 4 * capacity]
                        rows.append((doc_id, piece, at // 4, len(some) // 4, zlib.crc32(some)))
                yield batch(schema, *zip(*rows, strict=True))

    return documents.select("doc_id", "text").mapInArrow(tidy(cut_up), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _dearest(price: np.ndarray, capacity: int) -> Counter:
    """The configuration of the highest total price: knapsack by dynamic programming."""
    lengths = np.flatnonzero(price[: capacity + 1] > 0)
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        fit = lengths[: np.searchsorted(lengths, room, "right")]
        if len(fit):
            value = price[fit] + best[room - fit]
            k = int(np.argmax(value))
            if value[k] > best[room - 1]:
                best[room], last[room] = value[k], fit[k]
                continue
        best[room], last[room] = best[room - 1], 0
    config, room = Counter(), capacity
    while room > 0:
        if last[room]:
            config[int(last[room])] += 1
            room -= int(last[room])
        else:
            room -= 1
    return config


def fractional(demand: dict[int, int], capacity: int, steps: int = 200, rate: float = 0.5) -> dict[tuple, float]:
    """Configuration -> how often, about covering every length ``demand`` times."""
    amount = np.zeros(capacity + 1)
    for length, n in demand.items():
        amount[length] = n
    amount[capacity] = 0  # a full piece is a sequence of its own
    lengths = np.flatnonzero(amount)
    price = np.zeros(capacity + 1)
    price[lengths] = lengths / capacity
    used: dict[tuple, float] = defaultdict(float)
    covered = np.zeros(capacity + 1)
    for _ in range(steps if len(lengths) else 0):
        config = _dearest(price, capacity)
        own = np.array(list(config))
        each = np.array([config[x] for x in own])
        times = (amount[own] / each).min()
        used[tuple(sorted(config.items(), reverse=True))] += times
        covered[own] += times * each
        price[own] *= np.exp(-rate * times * each / amount[own])
        # Covered often enough: its weight in the program is spent.
        price[price < price.max() * 1e-9] = price.max() * 1e-9 if price.max() else 0
        price[amount == 0] = 0
    share = covered[lengths] @ lengths / max(float(amount @ np.arange(capacity + 1)), 1)
    return {c: x / max(share, 1e-9) for c, x in used.items()}


def configurations(demand: dict[int, int], capacity: int, steps: int = 200) -> list[tuple[tuple, int]]:
    """(configuration, number of sequences) that hold each length exactly ``demand`` times."""
    left = Counter({length: n for length, n in demand.items() if n})
    out: Counter = Counter()

    def take(config: tuple, times: int) -> None:
        if times > 0:
            out[config] += times
            for length, each in config:
                left[length] -= each * times

    if left[capacity]:
        take(((capacity, 1),), left[capacity])
    for config, times in sorted(fractional(left, capacity, steps).items(), key=lambda x: (-x[1], x[0])):
        if sum(length * each for length, each in config) < capacity:
            continue  # rounded to nothing: best fit may still fill that space
        take(config, min(int(times), *(left[length] // each for length, each in config)) * 9 // 10)
    # Best fit on the rest: equal bins are kept as (free space, contents) with their number.
    bins: Counter = Counter()
    heap_of: dict[int, list] = defaultdict(list)
    free = np.zeros(capacity + 1, np.int64)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            fits = np.flatnonzero(free[length:])
            if not len(fits):
                whole = capacity // length
                full, rest = divmod(n, whole)
                for each, times in ((whole, full), (rest, 1)):
                    if each and times:
                        key = ((length, each),)
                        room = capacity - each * length
                        if key not in bins:
                            heapq.heappush(heap_of[room], key)
                        bins[key] += times
                        free[room] += times
                break
            room = length + int(fits[0])
            key = heap_of[room][0]
            times = min(bins[key], n)
            n -= times
            bins[key] -= times
            free[room] -= times
            if not bins[key]:
                heapq.heappop(heap_of[room])
                del bins[key]
            content = Counter(dict(key))
            content[length] += 1
            new = tuple(sorted(content.items(), reverse=True))
            if new not in bins:
                heapq.heappush(heap_of[room - length], new)
            bins[new] += times
            free[room - length] += times
    out.update(bins)
    return sorted(out.items())


class Places:
    """Where the n-th piece of a length goes: intervals of n, sorted by (length, n)."""

    def __init__(self, packed: list[tuple[tuple, int]]):
        rows, used, sequence = [], Counter(), 0
        for config, times in packed:
            offset = 0
            for length, each in config:
                rows.append((length, used[length], each, sequence, offset))
                used[length] += each * times
                offset += length * each
            sequence += times
        rows.sort()
        self.sequences = sequence
        self.length, self.first, self.each, self.sequence, self.offset = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
        self.begin = {int(x): int(i) for x, i in zip(*np.unique(self.length, return_index=True), strict=True)}
        self.end = {int(x): int(i + n) for x, i, n in zip(*np.unique(self.length, return_index=True, return_counts=True), strict=True)}

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            own = lengths == length
            lo, hi = self.begin[int(length)], self.end[int(length)]
            at[own] = lo + np.searchsorted(self.first[lo:hi], numbers[own], "right") - 1
        copy, slot = np.divmod(numbers - self.first[at], self.each[at])
        return self.sequence[at] + copy, self.offset[at] + slot * lengths


def pack(documents: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, steps: int = 200) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = cut(pieces_of(documents, tokenizer, capacity, end_id), "pieces")
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(PARTS)).cast("int")
    pieces = pieces.withColumn("part", part)
    tally = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    demand = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(configurations(demand, capacity, steps))
    before = tally.select(
        "length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before")
    )
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    numbered = pieces.withColumn("n", F.row_number().over(inside) - 1).join(before, ["length", "part"])

    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
         ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            sequence, offset = places.of(some["length"].to_numpy(), some["n"].to_numpy())
            yield batch(schema, *(some[c] for c in schema.names[:5]), sequence, offset)

    rows = numbered.select(*schema.names[:5], (F.col("n") + F.col("before")).alias("n"))
    return rows.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
