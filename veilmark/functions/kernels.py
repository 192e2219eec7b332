"""Arrow batch functions: the only Python that runs inside tasks.

The module is pickled by value, so executors need NumPy and PyArrow but not
this package. Keep it free of other imports from the package.

Functions are marked nondeterministic to make the optimizer evaluate each call
once: it must not copy a call into a filter or into a lambda.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HIT = "array<struct<priority:int,start:int,end:int>>"
_HIT_ARROW = pa.struct([("priority", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def accept(starts, ends, strict: bool) -> list[int]:
    """Positions of the candidates kept, taken in the given order.

    Default test (closed): a candidate is dropped if its start or its end lies
    in [start, end] of a kept one, so neighbours that touch clash and a
    candidate that encloses a kept one passes. ``strict``: any shared character.

    What is kept is held as disjoint intervals in order (an interval that encloses others
    takes their place), so a test is a binary search, whatever the length of the text.
    """
    low: list[int] = []
    high: list[int] = []
    kept = []
    for i, (s, e) in enumerate(zip(starts, ends)):
        if strict:
            at = bisect_left(low, e) if s < e else 0
            if at and high[at - 1] > s:
                continue
            kept.append(i)
            if s < e:
                low.insert(at, s)
                high.insert(at, e)
        else:
            at, to = bisect_right(low, s), bisect_right(low, e)
            if at and high[at - 1] >= s or to and high[to - 1] >= e:
                continue
            kept.append(i)
            low[at:to], high[at:to] = [s], [e]
    return kept


def accepted_by_rank(rank: np.ndarray, starts: np.ndarray, ends: np.ndarray, strict: bool) -> np.ndarray:
    """The same for candidates of many texts, whose places do not meet, as arrays in order
    of (rank, start); those of one rank do not overlap. Whether each is kept, all of a rank
    at once: what touches its kept neighbour of the same rank goes, if touching counts."""
    kept = np.zeros(len(rank), bool)
    low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def inside(x: np.ndarray) -> np.ndarray:
        at = np.searchsorted(low, x, "right") - 1
        return (at >= 0) & (high[at] >= x) if len(low) else np.zeros(len(x), bool)

    cuts = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        s, e = starts[lo:hi], ends[lo:hi]
        if strict:
            at = np.searchsorted(low, e, "left") - 1
            free = np.flatnonzero((at < 0) | (high[at] <= s)) if len(low) else np.arange(hi - lo)
        else:
            free = np.flatnonzero(~(inside(s) | inside(e)))
            chain = np.append(True, s[free][1:] > e[free][:-1]) if len(free) else np.zeros(0, bool)
            first = np.flatnonzero(chain)
            place = np.arange(len(free)) - np.repeat(first, np.diff(np.append(first, len(free))))
            free = free[place % 2 == 0]
        if not len(free):
            continue
        kept[lo + free] = True
        s, e = s[free], e[free]
        at = np.searchsorted(s, low, "right") - 1
        rest = (at < 0) | (e[at] <= low)  # those that no new one encloses
        low, high = np.concatenate([low[rest], s]), np.concatenate([high[rest], e])
        order = np.argsort(low, kind="stable")
        low, high = low[order], high[order]
    return kept


#: Elements (pieces, spans, bytes) of a batch that are worked on at once. A batch has a
#: number of rows, whatever their length; memory follows this number and the longest row.
SLICE = 1 << 20


def slices(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of whole rows of at most ``SLICE`` elements, or of one row."""
    reach = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out, at = [], 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(reach, reach[at] + SLICE, "right")) - 1)
        out.append((at, to))
        at = to
    return out


def in_slices(rows: pa.Array, sizes: np.ndarray, body) -> pa.Array:
    """``body`` over slices of an array, as one array."""
    parts = [body(rows.slice(lo, hi - lo)) for lo, hi in slices(sizes)]
    return pa.concat_arrays(parts) if parts else body(rows)


def _sizes(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def first_come(strict: bool):
    def some(lens: pa.Array) -> pa.Array:
        # lens: per document and pattern, alternating gap and match lengths
        per_pattern = lens.flatten()
        n_patterns, n_pieces = _sizes(lens), _sizes(per_pattern)
        reach = np.concatenate([[0], np.cumsum(per_pattern.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)])
        first = np.cumsum(n_pieces) - n_pieces
        n_hits = np.maximum(n_pieces - 1, 0) // 2
        list_of = np.repeat(np.arange(len(n_pieces)), n_hits)
        at = first[list_of] + 1 + 2 * (np.arange(len(list_of)) - np.repeat(np.cumsum(n_hits) - n_hits, n_hits))
        start, end = reach[at] - reach[first[list_of]], reach[at + 1] - reach[first[list_of]]
        document = np.repeat(np.arange(len(lens)), n_patterns)[list_of]
        rank = list_of - (np.cumsum(n_patterns) - n_patterns)[document]
        apart = document * (int(end.max(initial=0)) + 2)
        order = np.lexsort((start + apart, rank))
        kept = order[accepted_by_rank(rank[order], (start + apart)[order], (end + apart)[order], strict)]
        kept = kept[np.lexsort((start[kept], rank[kept], document[kept]))]
        bounds = np.searchsorted(document[kept], np.arange(len(lens) + 1)).astype(np.int32)
        columns = [pa.array(x[kept].astype(np.int32)) for x in (rank, start, end)]
        return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(columns, fields=list(_HIT_ARROW)))

    @F.arrow_udf(_HIT)
    def run(lens: pa.Array) -> pa.Array:
        per_pattern = np.concatenate([[0], np.cumsum(_sizes(lens.flatten()))])
        last = np.concatenate([[0], np.cumsum(_sizes(lens))])
        return in_slices(lens, np.diff(per_pattern[last]), some)

    return run.asNondeterministic()


def first_come_spans(strict: bool):
    def some(spans: pa.Array) -> pa.Array:
        flat, sizes = spans.flatten(), _sizes(spans)
        starts, ends = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("start", "end"))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        rows = [accept(starts[lo:hi].tolist(), ends[lo:hi].tolist(), strict) for lo, hi in zip(bounds[:-1], bounds[1:])]
        counts = np.array([len(r) for r in rows], np.int64)
        place = np.fromiter((i for r in rows for i in r), np.int64, int(counts.sum()))
        at = place + np.repeat(bounds[:-1], counts)
        columns = [pa.array(x.astype(np.int32)) for x in (place, starts[at], ends[at])]
        kept = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(kept), pa.StructArray.from_arrays(columns, fields=list(_HIT_ARROW)))

    @F.arrow_udf(_HIT)
    def run(spans: pa.Array) -> pa.Array:
        # spans: in order of preference; the result's priority is the position
        return in_slices(spans, _sizes(spans), some)

    return run.asNondeterministic()


# -- words scored by a network ----------------------------------------------------

_SPANS = "array<struct<category:string,start:int,end:int,confidence:double,source:string,priority:int>>"
_KINDS = ["CREDIT_CARD", "PHONE", "NAME", "ACCOUNT_NUMBER", "NUMERIC_ID", "GENERAL_PII"]
# What a byte of a plain text is: nothing of a word, a letter or underscore, a digit, a capital.
_BYTE = np.zeros(256, np.uint8)
_BYTE[[*range(ord("a"), ord("z") + 1), ord("_")]] = 1
_BYTE[ord("0") : ord("9") + 1] = 2
_BYTE[ord("A") : ord("Z") + 1] = 3


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts, one after the other, and where each begins and ends."""
    texts = texts.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


def _first_places(texts: pa.Array, doc: np.ndarray, begin: np.ndarray, end: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Start of the first word that equals each one in its text; begin and end count the
    characters of all texts."""
    data, _ = _bytes(texts)
    leads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    whole, seen = data.tobytes(), {}
    places = zip(doc.tolist(), leads[begin].tolist(), leads[end].tolist(), start.tolist())
    return np.fromiter((seen.setdefault((d, whole[lo:hi]), s) for d, lo, hi, s in places), np.int64, len(doc))


def word_spans(layers, threshold: float, first: bool):
    """(text, plain text) -> spans of the words that a network calls personal data.

    A plain text has a character for each one of the text: of the characters of words,
    digits are 0-9, capitals A-Z, and all others a-z or the underscore; no other character
    is one of these. ``first`` moves each word to the first place of the same word.
    """

    def some(both: pa.StructArray) -> pa.Array:
        text, plain = both.field(0), both.field(1)
        data, bounds = _bytes(plain)
        kind = _BYTE[data]
        inside = np.concatenate([[False], kind > 0, [False]])
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        begin = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
        end = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
        char, digit = _running((data & 0xC0) != 0x80), _running(kind == 2)
        doc = np.searchsorted(bounds, begin, "right") - 1
        start, n = char[begin] - char[bounds[doc]], end - begin
        size, share, capital = np.minimum(n / 10.0, 2.0), (digit[end] - digit[begin]) / n, kind[begin] == 3
        none = np.zeros(len(n))
        x = np.stack([size, none, none, share, capital.astype(float), none + 0.1], axis=1)
        p = probabilities(layers, x)[:, 1] if len(x) else none
        long = size > 1.0
        which = np.select(
            [(share > 0.7) & long & (share > 0.9), (share > 0.7) & long, capital & long & (share < 0.1), capital & long, share > 0.3],
            [0, 1, 2, 3, 4], 5,
        )
        if first and len(n):
            start = _first_places(text, doc, char[begin], char[end], start)
        kept = np.flatnonzero(p > threshold)
        columns = [
            pa.array(_KINDS).take(pa.array(which[kept])), pa.array(start[kept].astype(np.int32)), pa.array((start + n)[kept].astype(np.int32)),
            pa.array(p[kept]), pa.array(["model"]).take(pa.array(np.zeros(len(kept), np.int32))), pa.array(np.zeros(len(kept), np.int32)),
        ]
        spans = pa.StructArray.from_arrays(columns, names=["category", "start", "end", "confidence", "source", "priority"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[kept], np.arange(len(plain) + 1)).astype(np.int32)), spans)

    @F.arrow_udf(_SPANS)
    def run(text: pa.Array, plain: pa.Array) -> pa.Array:
        both = pa.StructArray.from_arrays([text, plain], names=["text", "plain"])
        return in_slices(both, np.diff(_bytes(plain)[1]), some)

    return run.asNondeterministic()


# -- chunks of words scored by a network -------------------------------------------

_CHUNKS = "array<struct<first:int,start:int,end:int,p:double,named:boolean>>"
_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True


def _last_before(places: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The last of ``places`` below each of ``x``, or -1."""
    return np.append(places, -1)[np.searchsorted(places, x) - 1] if len(places) else np.full(len(x), -1)


def _neighbour(values: np.ndarray, there: np.ndarray, by: int) -> np.ndarray:
    return np.where(there, np.roll(values, by), np.zeros(1, values.dtype))


def chunk_hits(layers, size: int):
    """Plain text with cases -> chunks of ``size`` words that a network calls personal data.

    A chunk begins at every ``size // 5``-th word. ``first`` is the number of its first word,
    start and end are its place; ``named`` chunks hold a word in title case, no digit and no
    '@'. Features are those of ``features.in_context``, from sums over the words of a chunk
    and its neighbours.
    """
    step = size // 5

    def some(plain: pa.Array) -> pa.Array:
        data, bounds = _bytes(plain)
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        begin = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
        end = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
        upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
        after_case = np.concatenate([[False], (upper | lower)[:-1]]) & ~edge[:-1] if len(data) else upper
        wrong, capitals = _running((upper & after_case) | (lower & ~after_case)), _running(upper)
        titled = _running((wrong[begin] == wrong[end]) & (capitals[begin] < capitals[end]))
        char, digit = _running((data & 0xC0) != 0x80), _running((data >= 48) & (data <= 57))
        letters, digits = _running(char[end] - char[begin]), _running(digit[end] - digit[begin])

        # Words a to b of each chunk, all texts one after the other.
        top = np.searchsorted(begin, bounds)
        words = np.diff(top)
        chunks = -(-words // step)
        doc = np.repeat(np.arange(len(plain)), chunks)
        no = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        a = top[doc] + no * step
        b = np.minimum(a + size, top[doc + 1])
        if not len(a):
            doc = a = b = np.zeros(0, np.int64)
        n, count = letters[b] - letters[a] + (b - a) - 1, b - a
        many, title = digits[b] - digits[a], titled[b] > titled[a]
        low, high = (begin[a], end[b - 1]) if len(a) else (a, a)
        last_at = _last_before(np.flatnonzero(data == 64), high)
        last_dot = _last_before(np.flatnonzero(data == 46), high)
        at, dot = last_at >= low, last_dot >= low
        dotted = at & (last_dot > last_at)

        same = doc[1:] == doc[:-1]
        back, ahead = np.append(False, same)[: len(a)], np.append(same, False)[: len(a)]

        def around(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return _neighbour(v, back, 1), _neighbour(v, ahead, -1)

        def total(v: np.ndarray) -> np.ndarray:
            before, after = around(v)
            return before + after + v

        chars = total(n) + ahead + (ahead | back)
        (at_b, at_a), (dotted_b, dotted_a), (_, dot_a), (title_b, title_a) = map(around, (at, dotted, dot, title))
        has_dot = np.where(at, dotted, np.where(at_a, dotted_a | dot, at_b & (dotted_b | dot_a | dot)))
        x = np.stack(
            [
                np.minimum(chars / 50.0, 2.0), (at | at_b | at_a).astype(float), has_dot.astype(float),
                total(many) / np.maximum(chars, 1), (title | title_b | title_a).astype(float), total(count) / 20.0,
            ],
            axis=1,
        )
        p = probabilities(layers, x)[:, 1] if len(x) else np.zeros(0)
        kept = np.flatnonzero(p > 0.5)
        own = char[bounds[doc[kept]]]
        columns = [
            pa.array((a - top[doc])[kept].astype(np.int32)), pa.array((char[low[kept]] - own).astype(np.int32)),
            pa.array((char[high[kept]] - own).astype(np.int32)), pa.array(p[kept]), pa.array((title & ~at & (many == 0))[kept]),
        ]
        hits = pa.StructArray.from_arrays(columns, names=["first", "start", "end", "p", "named"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[kept], np.arange(len(plain) + 1)).astype(np.int32)), hits)

    @F.arrow_udf(_CHUNKS)
    def run(plain: pa.Array) -> pa.Array:
        return in_slices(plain, np.diff(_bytes(plain)[1]), some)

    return run.asNondeterministic()


# -- small network scoring ------------------------------------------------------


def forward(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    """Activations of every layer: tanh between layers, none at the end."""
    acts = [x]
    for i, (w, b) in enumerate(layers):
        z = acts[-1] @ w + b
        acts.append(np.tanh(z) if i < len(layers) - 1 else z)
    return acts


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Class probabilities of each row; equal rows go through the network once.

    Features of words and chunks repeat heavily. Rows are told apart by a 64-bit mix of
    their bytes, and compared in full with the row that stands for them; should two
    different rows ever mix alike, or few rows repeat, all are scored.
    """
    x = np.ascontiguousarray(x)
    bits = x.view(np.uint64)
    mix = np.zeros(len(x), np.uint64)
    for k in range(x.shape[1]):
        mix = (mix ^ bits[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
    _, first, inverse = np.unique(mix, return_index=True, return_inverse=True)
    if 2 * len(first) > len(x) or not np.array_equal(bits[first][inverse], bits):
        return softmax(forward(layers, x)[-1])
    return softmax(forward(layers, x[first])[-1])[inverse]


def mlp(layers):
    """array<double> features -> struct(pred, prob of class 1)."""

    @F.arrow_udf("struct<pred:int,prob:double>")
    def run(features: pa.Array) -> pa.Array:
        x = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), -1)
        p = probabilities(layers, x)
        return pa.StructArray.from_arrays(
            [pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(p[:, 1])], names=["pred", "prob"]
        )

    return run.asNondeterministic()


# -- training: per-example clipped gradients -------------------------------------


def loss_and_slope(kind: str, logits: np.ndarray, y: np.ndarray, weights: tuple[float, float]):
    """Per-example loss and its derivative by the logits."""
    if kind == "sigmoid":  # binary, on the logit of class 1; weights[1] is the positive weight
        z = logits[:, 1]
        w = 1.0 + (weights[1] - 1.0) * y
        loss = w * (np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z))))
        slope = np.zeros_like(logits)
        slope[:, 1] = w * (1.0 / (1.0 + np.exp(-z)) - y)
        return loss, slope
    p = softmax(logits)
    hot = np.eye(logits.shape[1])[y.astype(int)]
    loss = -np.log(np.maximum((p * hot).sum(axis=1), 1e-300))
    slope = p - hot
    if kind == "weighted":
        w = np.where(y == 1, weights[1], weights[0])
        return loss * w, slope * w[:, None]
    return loss, slope


def clipped_gradient(layers, x, y, clip: float, kind: str, weights, per_tensor: bool):
    """Sum over examples of gradients clipped one example at a time.

    An example's gradient of a layer is the outer product of its input and its slope, so
    its norm is the product of theirs, and a clipped sum is one product of matrices: no
    gradient of a single example is ever written out.
    Returns (flat sum, sum of losses, sum of unclipped norms).
    """
    acts = forward(layers, x)
    loss, delta = loss_and_slope(kind, acts[-1], y, weights)
    deltas = [delta]
    for i in range(len(layers) - 1, 0, -1):
        delta = (delta @ layers[i][0].T) * (1.0 - acts[i] ** 2)
        deltas.insert(0, delta)
    slopes = [np.sqrt(np.einsum("ij,ij->i", d, d)) for d in deltas]
    norms = [n * np.sqrt(np.einsum("ij,ij->i", a, a)) for a, n in zip(acts, slopes)]
    total = np.sqrt(sum(n**2 for n in norms) + sum(n**2 for n in slopes))
    shared = np.minimum(1.0, clip / np.maximum(total, 1e-10))
    out = []
    for a, d, of_w, of_b in zip(acts, deltas, norms, slopes):
        w, b = (np.minimum(1.0, clip / np.maximum(n, 1e-10)) if per_tensor else shared for n in (of_w, of_b))
        out += [(a.T @ (d * w[:, None])).ravel(), b @ d]
    return np.concatenate(out), float(loss.sum()), float(total.sum())
