"""Language identification by unigram pieces with the segmentation summed out.

Every language has its own probabilities over one fixed public vocabulary of pieces. A
word's probability is the sum over all of its segmentations (forward algorithm), a
text's the product over its words; the language with the largest one is predicted, and
the score is its share under equal priors. The probabilities are learned by expectation
maximisation over the word counts of the training rows.

A word is a run of letters in lower case, of any length and always whole; a letter outside
the vocabulary counts as one unknown piece. Words of over ``LINEAR`` letters are summed up
as logarithms, which keeps them within floating point. NULL texts and texts without a
letter give ``und`` and 0. Training rows need a text and a language; without any, all
predictions are ``und``. Ties go to the first language in alphabetical order. Repeated rows
count as often as they occur. An empty table gives no rows, and columns other than doc_id,
text and lang are ignored. The number of languages is small: each has a column of piece
probabilities in every task.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.llm import tries
from veilmark.llm.arrow import batch, held, let_go, text_groups, tidy
from veilmark.sources.shared import cut

SPACE = "▁"
#: Letters of a word whose sums are taken as they are, and places times words in one lattice.
LINEAR, PLACES = 24, 1 << 16
#: Words of each age that a worker remembers.
REMEMBER = 120_000
_RUNS = re.compile(r"[^\W\d_]+").findall


@cache
def vocabulary(model: str) -> tuple[dict[str, int], int]:
    """Prefixes of pieces (piece number, or -1 for a mere prefix) and the number of
    pieces; the last piece number is the unknown one."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    found = [sp.id_to_piece(i) for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    pieces = sorted(p for p in found if p == p.lower() and p.lstrip(SPACE).isalpha() and SPACE not in p[1:]) + [SPACE]
    table = {p[:k]: -1 for p in pieces for k in range(1, len(p))}
    table.update({p: i for i, p in enumerate(pieces)})
    return table, len(pieces) + 1


@cache
def automaton(model: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The pieces as a double-array trie: the code of each character, base, check, the
    piece of each state (or -1), and the length of the longest piece."""
    table, _ = vocabulary(model)
    letter = np.zeros(0x110000, np.int32)  # 0: a character that no piece has
    letters = sorted({c for p in table for c in p})
    letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    prefixes = sorted(table, key=lambda p: (len(p), p))
    number = {"": 0} | {p: k + 1 for k, p in enumerate(prefixes)}
    parent = np.array([number[p[:-1]] for p in prefixes])
    base, check, state = tries.double_array(parent, letter[[ord(p[-1]) for p in prefixes]].astype(np.int64))
    piece = np.full(len(base), -1, np.int32)
    piece[state[1:]] = [table[p] for p in prefixes]
    return letter, base, check, piece, max(map(len, prefixes))


def scored(word: str) -> str:
    """What a run of word characters is scored as: its letters, or nothing without one."""
    if not word.isalpha():
        word = "".join(c for c in word if c.isalpha())
    return SPACE + word if word else ""


def lots(words: list[str]) -> Iterator[np.ndarray]:
    """Places of the words, those of about equal length together, for one lattice each."""
    size = np.array([len(w) for w in words])
    order = np.argsort(size, kind="stable")
    lo = 0
    while lo < len(order):
        most = np.searchsorted((size[order[lo:]] + 1) * np.arange(1, len(order) - lo + 1), PLACES, "right")
        hi = lo + max(1, min(int(most), 60_000))
        yield order[lo:hi]
        lo = hi


class Lattice:
    """All segmentations of a list of words, as edges sorted by (end, word)."""

    def __init__(self, words: list[str], model: str):
        letter, base, check, pieces, longest = automaton(model)
        self.n, self.size = len(words), vocabulary(model)[1]
        self.length = np.array([len(w) for w in words], np.int64)
        self.log = int(self.length.max(initial=0)) > LINEAR
        codes = letter[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        first = np.cumsum(self.length) - self.length
        own = np.repeat(np.arange(self.n), self.length)
        left = (first + self.length)[own] - np.arange(len(codes))
        at, state, single = np.arange(len(codes)), np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        edges = []
        for k in range(longest):
            inside = left[at] > k
            at, state = at[inside], state[inside]
            after = base[state] ^ codes[at + k]
            hit = check[after] == state
            at, state = at[hit], after[hit]
            if not len(at):
                break
            piece = pieces[state]
            ends = np.flatnonzero(piece >= 0)
            edges.append((at[ends], np.full(len(ends), k + 1), piece[ends]))
            if k == 0:
                single[at[ends]] = True
        unknown = np.flatnonzero(~single)
        edges.append((unknown, np.ones(len(unknown), np.int64), np.full(len(unknown), self.size - 1)))
        at, size, piece = (np.concatenate(x).astype(np.int64) for x in zip(*edges, strict=True))
        word = own[at]
        start = at - first[word]
        end = start + size
        order = np.argsort(word.astype(np.uint16), kind="stable")  # radix sorts: by word, then by end
        order = order[np.argsort(end[order].astype(np.uint16 if end.max(initial=0) < 1 << 16 else np.int64), kind="stable")]
        self.word, self.start, self.end, self.piece = word[order], start[order], end[order], piece[order]

    def _passed(self, edge: np.ndarray, forward: bool) -> np.ndarray:
        """[position, word, column]: the sum over all ways from the first position (or to
        the last one) of the products of ``edge``, a row per edge; logarithms where ``log``."""
        times, plus, one, none = (np.add, np.logaddexp, 0.0, -np.inf) if self.log else (np.multiply, np.add, 1.0, 0.0)
        top = int(self.length.max(initial=0))
        out = np.full((top + 1, self.n, edge.shape[1]), none)
        if forward:
            out[0], by, source, steps = one, self.end, self.start, range(1, top + 1)
            order = np.arange(len(by))
        else:
            out[self.length, np.arange(self.n)] = one
            order = np.argsort(self.word.astype(np.uint16), kind="stable")
            order = order[np.argsort(self.start[order].astype(np.uint16 if top < 1 << 16 else np.int64), kind="stable")]
            by, source, steps = self.start[order], self.end, range(top - 1, -1, -1)
        bounds = np.searchsorted(by, np.arange(top + 2))
        for t in steps:
            e = order[bounds[t] : bounds[t + 1]]
            if len(e):
                word = self.word[e]
                values = times(out[source[e], word], edge[e])
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                sums = plus.reduceat(values, first, axis=0)
                ends = word[first]
                # A word's last position keeps the end of its own ways.
                out[t, ends] = plus(out[t, ends], sums)
        return out

    def log_probabilities(self, p: np.ndarray) -> np.ndarray:
        """A row per word, a column for each column of ``p`` (piece probabilities)."""
        whole = self._passed(np.log(p)[self.piece] if self.log else p[self.piece], True)[self.length, np.arange(self.n)]
        return whole if self.log else np.log(whole)

    def shares(self, edge: np.ndarray) -> np.ndarray:
        """How often each edge is used in a word on average; ``edge`` has probabilities."""
        if self.log:
            edge = np.log(edge)
        alpha, beta = self._passed(edge, True), self._passed(edge, False)
        whole = alpha[self.length, np.arange(self.n)][self.word]
        before, after = alpha[self.start, self.word], beta[self.end, self.word]
        return np.exp(before + edge + after - whole) if self.log else before * edge * after / whole

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, for words that occur ``weight`` times in each language."""
        share = self.shares(p[self.piece]) * weight[self.word]
        return np.stack([np.bincount(self.piece, share[:, k], self.size) for k in range(p.shape[1])], axis=1)

    def expected_in(self, p: np.ndarray, language: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The same for words of one language each, that occur ``n`` times."""
        share = self.shares(p[self.piece, language[self.word]][:, None])[:, 0] * n[self.word]
        place = self.piece * p.shape[1] + language[self.word]
        return np.bincount(place, share, p.size).reshape(p.shape)


def word_counts(training: DataFrame) -> DataFrame:
    """lang, word, n: how often each scored word occurs in the rows of a language."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen: dict[str, dict[str, int]] = {}

        def flush():
            rows = [(lang, own, n) for lang, words in seen.items() for word, n in words.items() if (own := scored(word))]
            seen.clear()
            if rows:
                yield batch(schema, *zip(*rows, strict=True))

        for part in batches:
            langs = part["lang"].to_pylist()
            for lo, texts in text_groups(part["text"]):
                for lang, text in zip(langs[lo : lo + len(texts)], texts, strict=True):
                    own = seen.setdefault(lang, {})
                    for w in _RUNS(text.lower()):
                        own[w] = own.get(w, 0) + 1
                if sum(map(len, seen.values())) > REMEMBER:
                    yield from flush()
        yield from flush()

    rows = training.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(tidy(count), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(training: DataFrame, model: str, steps: int = 2, smoothing: float = 0.1) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of all pieces in each (a row per piece).

    Only sums per language and piece come to the driver: at most one number per language
    and vocabulary entry from each step.
    """
    counts = cut(word_counts(training), "word-counts")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    size = vocabulary(model)[1]
    p = np.full((size, len(languages)), 1 / size)
    column = {lang: k for k, lang in enumerate(languages)}
    for _ in range(steps if languages else 0):
        rows = counts.mapInArrow(_expectation(model, p, column), "lang int, piece int, n double")
        found = rows.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
        p = np.full((size, len(languages)), smoothing)
        p[found["piece"].to_numpy(), found["lang"].to_numpy()] += found["n"].to_numpy()
        p /= p.sum(axis=0)
    return languages, p


def _expectation(model: str, p: np.ndarray, column: dict[str, int]):
    schema = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("n", pa.float64())])

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        total = np.zeros_like(p)
        for part in batches:
            words = part["word"].to_pylist()
            at = np.array([column[x] for x in part["lang"].to_pylist()], np.int64)
            n = part["n"].to_numpy()
            for some in lots(words):
                total += Lattice([words[i] for i in some.tolist()], model).expected_in(p, at[some], n[some])
        piece, lang = np.nonzero(total)
        if len(piece):
            yield batch(schema, lang, piece, total[piece, lang])

    return tidy(expect)


class _Scorer:
    """Scores texts; remembers the latest words and as many before them."""

    def __init__(self, model: str, p: np.ndarray):
        self.model, self.p = model, p
        self.old, self.at = {}, {}
        self.old_rows = self.rows = np.zeros((0, p.shape[1]))

    def learn(self, words: set[str]) -> None:
        if len(self.at) + len(words) > len(self.rows):
            self.old, self.old_rows = self.at, self.rows
            self.at, self.rows = {}, np.empty((REMEMBER + len(words), self.p.shape[1]))
        missing = words.difference(self.at)
        known = [w for w in missing if w in self.old]
        self._put(known, self.old_rows[[self.old[w] for w in known]])
        new = list(missing.difference(known))
        own, cut_up = np.zeros((len(new), self.p.shape[1])), [scored(w) for w in new]
        letters = [i for i, w in enumerate(cut_up) if w]
        cut_up = [cut_up[i] for i in letters]
        for some in lots(cut_up):
            own[np.array(letters)[some]] = Lattice([cut_up[i] for i in some.tolist()], self.model).log_probabilities(self.p)
        self._put(new, own)

    def _put(self, words: list[str], rows: np.ndarray) -> None:
        n = len(self.at)
        self.rows[n : n + len(words)] = rows
        self.at.update(zip(words, range(n, n + len(words)), strict=True))

    def score(self, texts: list[str]) -> np.ndarray:
        """Log probability of each text in each language; NaN without a letter."""
        lists = [_RUNS(t.lower()) for t in texts]
        self.learn(set().union(*lists))
        out = np.full((len(texts), self.p.shape[1]), np.nan)
        for i, words in enumerate(lists):
            if words and any(c.isalpha() for w in words for c in w):
                out[i] = self.rows[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(axis=0)
        return out


def predictions(model: str, languages: list[str], p: np.ndarray) -> Callable[[Column], Column]:
    """A function of a text column: lang_pred and score of each text, as a struct."""
    key = uuid.uuid4().hex

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(column: pa.Array) -> pa.Array:
        scorer = held(key, lambda: _Scorer(model, p))
        names, scores = [], []
        for _, texts in text_groups(column):
            if not languages:
                names += ["und"] * len(texts)
                scores += [0.0] * len(texts)
                continue
            logs = scorer.score(texts)
            best = np.argmax(np.nan_to_num(logs, nan=0.0), axis=1)
            share = 1 / np.exp(logs - logs[np.arange(len(logs)), best][:, None]).sum(axis=1)
            empty = np.isnan(logs[:, 0])
            names += ["und" if e else languages[b] for e, b in zip(empty, best, strict=True)]
            scores += np.where(empty, 0.0, share).tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict


def identify(documents: DataFrame, training: Column, model: str, steps: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the documents
    for which ``training`` holds."""
    found = predictions(model, *train(documents.where(training), model, steps))(F.col("text"))
    held_out = ~F.coalesce(training, F.lit(False))
    return documents.select("doc_id", held_out.alias("held_out"), found.alias("found")).select("doc_id", "held_out", "found.*")


def keep_known(documents: DataFrame, model: str, least: float = 0.5) -> DataFrame:
    """The documents whose language is predicted with a score of ``least`` or more,
    learned from all rows with a language."""
    found = predictions(model, *train(documents, model))(F.col("text"))
    return documents.where((found["lang_pred"] != "und") & (found["score"] >= least))
