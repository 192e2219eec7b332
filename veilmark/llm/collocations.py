"""Phrase collocations, counted level by level with double-array tries.

Texts become streams of word numbers, a number for each word of a language that is
frequent enough; anything else, and every end of a piece, is a border. A phrase can only
be frequent if all phrases inside it are, so the candidates of a level are the phrases
that begin and end with a frequent phrase of the level before (as far as that is known)
and whose occurrences, summed over all shards, suffice. They are broadcast as double-array
tries: numpy moves the states of all text positions one byte of a word number at a time,
positions that fall out of the trie are let go, and the accepting states are counted by
``bincount``. The same run of a trie gives what may be a candidate of the next level; this
is sent on as sorted numbers, whole parts of them in a row. The counts of all tasks are
summed. Scores, containment and ranks are joins over the counted phrases, in exact
arithmetic.

Vocabularies and candidates of any size are handled: a trie and a broadcast table hold at
most a stated number of entries, and more of them are passed over the streams one after
another. Each of several tries runs only from the places that are its own, and a filter
of all their phrases takes the place of the one trie that would know the ends. A language or word that holds most of the rows is summed up inside the tasks
before it is moved.

NULL texts are empty, a NULL language is ``und``. Repeated rows count as often as they
occur, their ids are not read. Texts of any length are processed whole. Ties are ordered
by phrase; equal scores of two cuts go to the smaller first part. An empty table, or one
without a frequent phrase, gives no rows. Columns other than text and lang are ignored.
Words are told apart by 64-bit digests inside a task and by themselves between tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilmark.llm import blocks, shingles, tries
from veilmark.llm.arrow import batch, groups, let_go, release, tidy, utf8
from veilmark.sources.shared import cut

# What separates words, and what ends a piece.
SPACE, END = b" \t", b".,;:!?\n\x0b\x0c\r"
LONGEST = 4
#: Words of a vocabulary, and phrases of a trie, that are broadcast at once (about half of
#: it on average, so that a hash deals out no more). A word takes about 20 bytes of a
#: worker, a phrase about 50.
WORDS, PHRASES = 1 << 23, 1 << 22
#: Distinct words and phrases that a task sums up before it passes them on.
HELD = 400_000
#: Counts in one row.
COUNTS = 1 << 12
#: The first bits of a mixed number say in which part it is summed up.
PART_BITS = 10
ODD = 0x9E3779B97F4A7C15
#: Places of a stream that are worked on at once; a longer text is worked on alone.
PLACES = 1 << 18

_INSIDE = np.array([b not in SPACE + END for b in range(256)])
_ENDS = np.array([b in END for b in range(256)])
_ROWS = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])
_STREAM = pa.schema([("h", pa.list_(pa.int64())), ("ids", pa.list_(pa.int32()))])


# Texts as streams of word numbers.


def _digests(hashed: np.ndarray, languages: pa.Array, language: np.ndarray) -> np.ndarray:
    """Digests of (language, word), never 0."""
    data, at = utf8(languages)
    own = shingles.hashes(data, at[:-1], at[1:]) if len(languages) else np.zeros(0, np.uint64)
    return np.maximum(shingles.mix(hashed ^ (own * np.uint64(3))[language]), np.uint64(1))


def _words(part: pa.RecordBatch):
    """For rows of about a megabyte: digests, languages, the number of each word's language,
    bytes, starts and ends, where a piece begins, and the row borders."""
    for lo, hi in groups(utf8(part["text"])[1]):
        data, at = utf8(part["text"].slice(lo, hi - lo))
        starts, ends = shingles.runs(_INSIDE[data], at)
        rows = np.searchsorted(starts, at)
        coded = part["lang"].slice(lo, hi - lo).dictionary_encode()
        language = np.repeat(coded.indices.to_numpy(), np.diff(rows))
        stops = np.concatenate([[0], np.cumsum(_ENDS[data])])
        begins = np.ones(len(starts), bool)
        begins[1:] = stops[starts[1:]] != stops[starts[:-1]]
        begins[rows[:-1][np.diff(rows) > 0]] = True
        digests = _digests(shingles.hashes(data, starts, ends), coded.dictionary, language)
        yield digests, coded.dictionary, language, data, starts, ends, begins, rows


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words at these places, with A-Z in lower case."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)])
    flat = data[np.arange(at[-1]) + np.repeat(starts - at[:-1], size)]
    flat = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat))


def word_counts(documents: DataFrame) -> DataFrame:
    """lang, word, n: how often each word occurs in the texts of a language."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def merged(held: list) -> list:
        digests, n, lang, word = (list(x) for x in zip(*held, strict=True))
        found, first, at = np.unique(np.concatenate(digests), return_index=True, return_inverse=True)
        take = pa.array(first)
        return [found, np.bincount(at, np.concatenate(n)).astype(np.int64), pa.concat_arrays(lang).take(take), pa.concat_arrays(word).take(take)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held, size = [], 0
        for part in batches:
            for digests, languages, language, data, starts, ends, _, _ in _words(part):
                if not len(digests):
                    continue
                found, first, n = np.unique(digests, return_index=True, return_counts=True)
                held.append([found, n, languages.take(pa.array(language[first])).cast(pa.string()), _strings(data, starts[first], ends[first])])
                size += len(found)
                if size > 2 * HELD:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > HELD:
                        yield batch(schema, held[0][2], held[0][3].cast(pa.string()), held[0][1])
                        held, size = [], 0
        if held:
            _, n, lang, word = merged(held)
            yield batch(schema, lang, word.cast(pa.string()), n)

    return documents.mapInArrow(tidy(count), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame, limit: int) -> tuple[DataFrame, int, int]:
    """lang, word, n, part, id of a vocabulary, in how many parts it is broadcast, and its
    size. Words of a part that are frequent have low numbers: they share bytes in a trie."""
    parts = -(-2 * words.count() // limit)
    dealt = words.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(max(parts, 1))).cast("int"))
    sizes = dealt.groupBy("part").count().orderBy("part").collect()  # a row per part
    first, before = {}, 0
    for r in sizes:
        first[r["part"]] = before
        before += r["count"]
    offset = F.lit(0)
    if first:
        offset = F.element_at(F.create_map(*(F.lit(x) for kv in first.items() for x in kv)), F.col("part"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), "lang", "word"))
    return cut(dealt.withColumn("id", (place - 1 + offset).cast("int")), "vocabulary"), parts, before


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams of digests with a 0 before each piece; no word has a number yet."""
    for part in batches:
        for digests, _, _, _, _, _, begins, rows in _words(part):
            before = np.concatenate([[0], np.cumsum(begins)])
            h = np.zeros(len(digests) + before[-1], np.uint64)
            h[np.arange(len(digests)) + before[1:]] = digests
            at = pa.array((rows + before[rows]).astype(np.int32))
            ids = pa.array(np.full(len(h), -1, np.int32))
            yield batch(_STREAM, pa.ListArray.from_arrays(at, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(at, ids))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column (without NULLs) and the row borders in them."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy()[at[0] : at[-1]], at - at[0]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about ``PLACES`` numbers at once."""
    for part in batches:
        for lo, hi in groups(_lists(part["ids"])[1], PLACES):
            yield part.slice(lo, hi - lo)


class Vocabulary:
    """Numbers of words by their digests. Digests are spread evenly, so that the first bits
    of one lead to its place or next to it."""

    def __init__(self, digests: np.ndarray, numbers: np.ndarray):
        order = np.argsort(digests)
        self.digest = np.append(digests[order], ~np.uint64(0))  # the last ends a search
        self.number = np.append(numbers[order], -1).astype(np.int32)
        bits = max(1, len(digests).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.digest, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the digests that are known, their numbers)."""
        place = self.first[digests >> self.shift]
        late = np.flatnonzero(self.digest[place] < digests)
        while len(late):
            place[late] += 1
            late = late[self.digest[place[late]] < digests[late]]
        hit = np.flatnonzero((self.digest[place] == digests) & (place < len(self.digest) - 1))
        return hit, self.number[place[hit]]


def _filled(vocabulary) -> Callable:
    """Give the words of a part of the vocabulary their numbers."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            h, at = _lists(part["h"])
            ids = _lists(part["ids"])[0].copy()
            hit, number = vocabulary.value.find(h.view(np.uint64))
            ids[hit] = number
            yield batch(_STREAM, part["h"], pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)))

    return fill


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest, id of the words of a vocabulary."""
    schema = pa.schema([("digest", pa.int64()), ("id", pa.int32())])
    for part in batches:
        data, at = utf8(part["word"])
        coded = part["lang"].dictionary_encode()
        digests = _digests(shingles.hashes(data, at[:-1], at[1:]), coded.dictionary, coded.indices.to_numpy())
        yield batch(schema, digests.view(np.int64), part["id"])


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ids: streams that begin with a border (-1), without words that have no neighbour
    and with one border in place of many. Rows without a phrase are left out."""
    schema = pa.schema([("ids", pa.list_(pa.int32()))])
    for part in batches:
        ids, at = _lists(part["ids"])
        word = np.concatenate([[False], ids >= 0, [False]])
        word[1:-1] &= word[:-2] | word[2:]
        keep = word[1:-1] | word[:-2]
        keep[at[:-1][np.diff(at) > 0]] = True
        kept = np.concatenate([[0], np.cumsum(keep)])[at]
        rows = np.flatnonzero(np.diff(kept) > 1)
        out = pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), pa.array(np.where(word[1:-1], ids, -1)[keep].astype(np.int32)))
        yield batch(schema, out.take(pa.array(rows)))


def streams(documents: DataFrame, vocabulary: DataFrame, parts: int) -> DataFrame:
    """ids: the numbers of the words of each text."""
    session = documents.sparkSession

    def broadcast(part: int):
        own = vocabulary.where(F.col("part") == part).select("lang", "word", "id")
        found = own.mapInArrow(tidy(_digested), "digest long, id int").toArrow()  # at most ``limit`` rows
        return session.sparkContext.broadcast(Vocabulary(found["digest"].to_numpy().view(np.uint64), found["id"].to_numpy()))

    kinds = "h array<long>, ids array<int>"
    if parts == 1:
        fill = _filled(broadcast(0))
        return cut(documents.mapInArrow(tidy(lambda batches: _compact(fill(_hashed(batches)))), "ids array<int>"), "streams")
    found = documents.mapInArrow(tidy(_hashed), kinds)
    for part in range(parts):
        if not vocabulary.where(F.col("part") == part).isEmpty():
            found = cut(found.mapInArrow(tidy(_filled(broadcast(part))), kinds), "hashed")
    return cut(found.mapInArrow(tidy(_compact), "ids array<int>"), "streams")


# Tries.


class Trie:
    """Phrases of equal length as a double-array trie over the bytes of word numbers. An
    accepting state has no children: its ``base`` is the number of its phrase. ``first`` has
    the states behind first words, 0 for others. Of several tries, each knows which places
    of a stream are its own."""

    def __init__(self, phrases: np.ndarray, part: int = 0, parts: int = 1):
        """``phrases``: a row of word numbers each, distinct and in ascending order."""
        self.phrases, self.part, self.parts = phrases.astype(np.int32, copy=False), part, parts
        n, self.length = phrases.shape
        self.bytes = max(1, -(-int(phrases.max()).bit_length() // 8))
        # Edges of the trie, level by level: rows that share a prefix are neighbours.
        parent, code, nodes, node = [], [], 1, np.zeros(n, np.int32)
        fresh = np.zeros(n, bool)
        fresh[0] = True
        for k in range(self.length):
            for shift in range(8 * self.bytes - 8, -1, -8):
                symbol = ((self.phrases[:, k] >> shift) & 255).astype(np.uint8)
                fresh[1:] |= symbol[1:] != symbol[:-1]
                parent.append(node[fresh])
                code.append(symbol[fresh])
                node = (np.cumsum(fresh) + (nodes - 1)).astype(np.int32)
                nodes = int(node[-1]) + 1
            if not k:
                after = node
        self.base, self.check, state = tries.double_array(np.concatenate(parent), np.concatenate(code), dense=True)
        self.base[state[node]] = np.arange(n)
        self.first = np.zeros(int(self.phrases[-1, 0]) + 1, np.int32)
        self.first[self.phrases[:, 0]] = state[after]

    def run(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions at which a phrase begins, its number)."""
        word = (ids >= 0) & (ids < 1 << 8 * self.bytes)
        inside = word[: max(len(ids) - self.length + 1, 0)] & (ids[: max(len(ids) - self.length + 1, 0)] < len(self.first))
        for k in range(1, self.length):
            inside &= word[k : k + len(inside)]
        at = np.flatnonzero(inside)
        if self.parts > 1:
            at = at[_owner(ids[at], ids[at + 1], self.parts) == self.part]
        state = self.first[ids[at]]
        at, state = at[state > 0], state[state > 0]
        for k in range(1, self.length):
            for shift in range(8 * self.bytes - 8, -1, -8):
                after = self.base[state] ^ ((ids[at + k] >> shift) & 255)
                hit = self.check[after] == state
                at, state = at[hit], after[hit]
        return at, self.base[state]


def _owner(first, second, parts: int):
    """Which of several tries has the phrases that begin with these two words, for
    columns and for arrays."""
    if isinstance(first, np.ndarray):
        first = first.astype(np.int64)
    return (first * 1_000_003 + second) % parts


class Filter:
    """Phrases of all tries of a level as one bit array: what it has not is not frequent."""

    def __init__(self, n: int):
        self.bits = max(10, (16 * n).bit_length())
        self.flags = np.zeros(1 << self.bits - 3, np.uint8)

    def _places(self, ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for k in range(length):
            h = shingles.mix((h << np.uint64(1)) + ids[at + k].astype(np.uint64) + np.uint64(1))
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, phrases: np.ndarray) -> None:
        length = phrases.shape[1]
        place = self._places(phrases.ravel(), np.arange(0, phrases.size, length), length)
        np.bitwise_or.at(self.flags, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))

    def has(self, ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Whether a phrase may begin at these positions; all its numbers are words."""
        place = self._places(ids, at, length)
        return (self.flags[place >> 3] >> (place & 7).astype(np.uint8)) & 1 != 0


class Keys:
    """Numbers below ``size`` as (part, rest of a number), evenly dealt out and back again."""

    def __init__(self, size: int):
        self.bits = max(size.bit_length(), PART_BITS + 1)
        if self.bits > 64:
            raise ValueError("too many phrases and words")
        self.rest = self.bits - PART_BITS
        self.kind = np.dtype(np.uint32 if self.rest <= 32 else np.uint64)

    def _times(self, x: np.ndarray, factor: int) -> np.ndarray:
        return (x * np.uint64(factor % (1 << 64))) & np.uint64((1 << self.bits) - 1)

    def _folded(self, x: np.ndarray) -> np.ndarray:
        return x ^ (x >> np.uint64((self.bits + 1) // 2))  # its own inverse

    def mixed(self, keys: np.ndarray) -> np.ndarray:
        return self._times(self._folded(self._times(keys, ODD)), ODD)

    def plain(self, part: int, rest: np.ndarray) -> np.ndarray:
        back = pow(ODD, -1, 1 << self.bits)
        mixed = rest.astype(np.uint64) | np.uint64(part << self.rest)
        return self._times(self._folded(self._times(mixed, back)), back)

    def rows(self, keys: np.ndarray) -> pa.RecordBatch:
        """A row for each part that has some of the keys: its distinct ones in order, and
        how often each occurs."""
        keys = np.sort(self.mixed(keys))
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.diff(np.append(first, len(keys)))
        keys, n = keys[first], n.astype(np.min_scalar_type(int(n.max())))
        own = (keys >> np.uint64(self.rest)).astype(np.int32)
        cuts = np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1])), len(own))
        rest = (keys & np.uint64((1 << self.rest) - 1)).astype(self.kind)
        parts = pa.array(own[cuts[:-1]])
        return pa.RecordBatch.from_arrays([parts, _blobs(rest, cuts), _blobs(n, cuts)], schema=_ROWS)


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of the values between each two cuts."""
    at = (cuts * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def _numbers(blob: bytes, n: int) -> np.ndarray:
    """``n`` whole numbers, of as many bytes each as the blob has."""
    return np.frombuffer(blob, f"u{len(blob) // n}")


def _summed(rest: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers and the sums of ``n``."""
    rest, n = np.concatenate(rest), np.concatenate([x.astype(np.int64) for x in n])
    order = np.argsort(rest)
    rest, n = rest[order], n[order]
    first = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
    return rest[first], np.add.reduceat(n, first)


def _phrases(words: np.ndarray, a: np.ndarray) -> pa.RecordBatch:
    """w, a from a row of word numbers for each phrase."""
    at = np.arange(len(words) + 1, dtype=np.int32) * np.int32(words.shape[1])
    w = pa.ListArray.from_arrays(pa.array(at), pa.array(words.ravel().astype(np.int32)))
    return pa.RecordBatch.from_arrays([w, pa.array(a.astype(np.int64))], schema=pa.schema([("w", w.type), ("a", pa.int64())]))


def _level(found: DataFrame, trie, heads: int, ends, length: int, least: int, words: int) -> DataFrame:
    """w, a: how often each phrase of a trie (``heads`` of ``length`` words) occurs, and the phrases of
    one word more that begin with one of them and occur ``least`` times. Without a trie:
    phrases of two words. What follows the first word of a longer phrase is frequent too:
    the trie knows it if it has all phrases; else ``ends`` leaves out nearly all others.

    One run of the trie over a stream serves both. Every task counts all accepting states
    and sends the counts in as few bytes as they need. A longer phrase is one number, the
    number of its beginning and its last word; a task sums up some millions of them at
    once and sends them on sorted, by parts, so that nothing is moved or hashed row by row."""
    longer = length < LONGEST
    numbers = Keys(heads * words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trie.value if trie is not None else None
        total = np.zeros(0 if tree is None else heads, np.int64)
        held, size = [], 0

        def sent():
            keys = np.concatenate(held)
            for lo in range(0, len(keys), 16 * HELD):  # one long text may have more
                yield numbers.rows(keys[lo : lo + 16 * HELD])

        for part in _slices(batches):
            ids, _ = _lists(part["ids"])
            if tree is None:
                at = np.flatnonzero(ids >= 0)
                head = ids[at]
            else:
                at, head = tree.run(ids)
                total += np.bincount(head, minlength=heads)
            if not longer:
                continue
            alive = np.zeros(len(ids) + 1, bool)
            alive[at] = True
            fits = alive[at + 1] if ends is None else np.append(ids, -1)[at + length] >= 0
            at, head = at[fits], head[fits]
            if ends is not None:
                fits = ends.value.has(ids, at + 1, length)
                at, head = at[fits], head[fits]
            held.append(head.astype(np.uint64) * np.uint64(words) + ids[at + length].astype(np.uint64))
            size += len(at)
            if size > 8 * HELD:
                yield from sent()
                held, size = [], 0
        if size:
            yield from sent()
        for lo in range(0, len(total), COUNTS):
            own = total[lo : lo + COUNTS]
            if own.any():
                own = own.astype(np.min_scalar_type(int(own.max())))
                yield batch(_ROWS, [(1 << PART_BITS) + lo // COUNTS], [b""], [own.tobytes()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = trie.value.phrases if trie is not None else np.arange(words, dtype=np.int32)[:, None]

        def ended():
            if now >= 1 << PART_BITS:
                lo = (now - (1 << PART_BITS)) * COUNTS
                return _phrases(phrases[lo : lo + len(total)], total)
            rest, n = _summed(*held)
            often = n >= least
            head, last = np.divmod(numbers.plain(now, rest[often]), np.uint64(words))
            return _phrases(np.column_stack([phrases[head.astype(np.int64)], last.astype(np.int32)]), n[often])

        now, held, total = None, ([], []), 0
        for some in batches:
            for part, keys, n in zip(some["part"].to_pylist(), some["keys"], some["n"], strict=True):
                if part != now:
                    if now is not None:
                        yield ended()
                    now, held, total = part, ([], []), 0
                keys, n = keys.as_py(), n.as_py()
                if part >= 1 << PART_BITS:
                    total = total + _numbers(n, min(COUNTS, heads - (part - (1 << PART_BITS)) * COUNTS)).astype(np.int64)
                else:
                    held[0].append(np.frombuffer(keys, numbers.kind))
                    held[1].append(_numbers(n, len(held[0][-1])))
        if now is not None:
            yield ended()

    rows = found.mapInArrow(tidy(count), "part int, keys binary, n binary")
    return blocks.together(rows, "part").mapInArrow(tidy(add), "w array<int>, a long")


def _tries(session: SparkSession, candidates: DataFrame, length: int, limit: int) -> tuple[list, Broadcast | None]:
    """Broadcast tries of about ``limit`` phrases each at most, and how many these are, none
    where there is no phrase; and of several tries, what all of them have as a broadcast filter."""
    n = candidates.count()
    parts, out = -(-2 * n // limit), []
    seen = Filter(n) if parts > 1 and length < LONGEST else None
    own = _owner(F.col("w")[0].cast("long"), F.col("w")[1], parts)
    for part in range(parts):
        found = candidates.where(own == part).toArrow()["w"].combine_chunks()
        if len(found):
            phrases = found.flatten().to_numpy().reshape(-1, length)
            phrases = phrases[np.lexsort(phrases.T[::-1])]
            if seen is not None:
                seen.add(phrases)
            out.append((session.sparkContext.broadcast(Trie(phrases, part, parts)), len(phrases)))
            del found, phrases
            release()
    return out, seen and session.sparkContext.broadcast(seen)


# Phrases.


def mine(
    documents: DataFrame, least: int = 30, top: int = 2000, inside: int = 80, words: int = WORDS, phrases: int = PHRASES
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language that
    occur ``least`` times, but those of which ``inside`` percent stand in a longer one."""
    session = documents.sparkSession
    rows = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    all_words = cut(word_counts(rows), "words")
    totals = all_words.groupBy("lang").agg(F.sum("n").alias("n"))
    vocabulary, parts, size = numbered(all_words.where(F.col("n") >= least), words)
    empty = session.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    if not parts:
        return empty
    found = streams(rows, vocabulary, parts)
    counts, before, ends = [vocabulary.select(F.array("id").alias("w"), F.col("n").alias("a"))], [(None, size)], None
    for length in range(1, LONGEST + 1):
        levels = reduce(DataFrame.unionByName, [cut(_level(found, trie, heads, ends, length, least, size), "phrases") for trie, heads in before])
        if length > 1:
            counts.append(levels.where(F.size("w") == length))
        for used in filter(None, [*(trie for trie, _ in before), ends]):
            used.unpersist()
        if length < LONGEST:
            before, ends = _tries(session, levels.where(F.size("w") == length + 1), length + 1, phrases)
            if not before:
                break
    if len(counts) == 1:
        return empty
    ranked = scored(cut(reduce(DataFrame.unionByName, counts), "counts"), inside)
    named = _named(ranked, vocabulary).join(F.broadcast(totals) if totals.count() <= blocks.BROADCAST_ROWS else totals, "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (
        named.withColumn("rank", place).where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def scored(counted: DataFrame, inside: int) -> DataFrame:
    """w, a, l, r, score of the phrases that stand alone often enough, from the counts
    (w, a) of words and phrases."""
    phrases = counted.where("size(w) > 1")
    cuts = phrases.select("w", "a", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    sides = counted.select(F.col("w").alias("side"), F.col("a").alias("f"))
    sides = blocks.small(sides)
    for name, part in (("l", "slice(w, 1, k)"), ("r", "slice(w, k + 1, size(w))")):
        cuts = cuts.withColumn("own", F.expr(part)).join(sides.withColumnRenamed("f", name), F.col("own") == F.col("side")).drop("own", "side")
    score = F.expr("(CAST(2000000 AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(20, 0))) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    lowest = cuts.withColumn("score", score).groupBy("w").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("x")
    ).select("w", "x.a", "x.l", "x.r", "x.score")
    pieces = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> slice(w, i, m))))"
    )
    within = phrases.where("size(w) > 2").select(F.explode(pieces).alias("w"), "a").groupBy("w").agg(F.max("a").alias("longer"))
    joined = lowest.join(within, "w", "left")
    wide = "DECIMAL(25, 0)"
    alone = F.expr(f"longer IS NULL OR 100 * CAST(longer AS {wide}) < {inside} * CAST(a AS {wide})")
    return joined.where(alone).drop("longer")


def _named(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The phrases with their language and words in place of numbers."""
    names = blocks.small(vocabulary.select("id", "lang", "word"))
    rows = phrases.select("*", F.posexplode("w").alias("i", "id")).join(names, "id")
    spelled = rows.groupBy("w", "a", "l", "r", "score", "lang").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("words"))
    return spelled.withColumn("phrase", F.array_join("words.word", " ")).drop("w", "words")
