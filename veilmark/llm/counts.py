"""Token counts by rank-synchronous array merging.

Pre-tokens are kept as ragged numpy arrays of symbols. In each step every sequence
applies its lowest-ranked pair, all sequences at once, until none has a pair left; the
surviving symbols are the tokens. Results equal those of the library for a BPE model
with byte fallback and identity normalisation (checked on probe texts when it is loaded).

NULL text is empty and has no token; rows keep their number and order is free; repeated
ids give one row each; other columns are ignored. Texts of any length are counted whole.
Of equally ranked pairs in a sequence the first is applied first, as the library does it.
An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veilmark.llm.arrow import Recent, batch, held, text_groups, utf8

SPACE = "▁"
NONE = np.iinfo(np.int32).max
#: Pre-tokens of each age that a worker remembers.
REMEMBER = 300_000


class Merger:
    """The merge table of a SentencePiece BPE model and the pre-tokens seen so far."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model)
        plain = [i for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        symbols = {s: i for i, s in enumerate([*score, *sorted({c for p in score for c in p} - set(score))])}
        ranks = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        width = self.width = len(symbols)
        pairs = sorted(
            (symbols[p[:k]] * width + symbols[p[k:]], ranks[score[p]], symbols[p])
            for p in score for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols
        )
        self.keys, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.is_piece = np.array([s in score for s in symbols])
        self.of_char = np.full(0x110000, -1, np.int64)
        for s, i in symbols.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        self.space = symbols[SPACE]
        self.runs = {len(p) for p in score if not p.strip(SPACE)}
        later = [p for p in score if SPACE in p[1:] and p.strip(SPACE)]
        low = [ranks[score[p]] for p in score if len(p) > 1 and not p.strip(SPACE)]
        high = [ranks[score[p]] for p in score if len(p) > 1 and p.strip(SPACE)]
        if later or "\n" in symbols or (low and (len(set(low)) > 1 or min(low) < max(high))):
            raise ValueError("pre-tokens of this model cannot be cut at spaces and line feeds")
        self.seen = Recent(REMEMBER)  # tokens of a pre-token, below 0 if its leading space stays alone
        for probe in ("", " ", "a  b", " a ", "\t x\n", "<s> é\x00", "aaaa  \n\n   aaa", "a" + " " * 40 + "\n 　x"):
            if self.count([probe])[0] != len(sp.encode(probe)):
                raise ValueError("this model normalises its texts")

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; unknown symbols are negative."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NONE), np.where(hit, self.merged[at], -1)

    def merge(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of each pre-token, and whether its first is a bare space."""
        code = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32)
        sym = self.of_char[code]
        size = np.ones(len(sym), np.int64)  # tokens a symbol stands for: bytes, if it is no piece
        odd = (sym < 0) | ~self.is_piece[np.maximum(sym, 0)]
        size[odd] = 1 + (code[odd] > 0x7F) + (code[odd] > 0x7FF) + (code[odd] > 0xFFFF)
        seq = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        count, first = np.zeros(len(tokens), np.int64), np.full(len(tokens), -1)
        while len(sym):
            inside = np.append(seq[1:] == seq[:-1], False)
            rank, into = self.lookup(sym, np.append(sym[1:], -1))
            rank[~inside] = NONE
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(sym)))
            low = np.repeat(lowest, lengths)
            ended = low == NONE
            if ended.any():
                count += np.bincount(seq[ended], size[ended], len(tokens)).astype(np.int64)
                over = starts[lowest == NONE]
                first[seq[over]] = sym[over]
                keep = ~ended
                sym, size, seq, rank, into, low = (x[keep] for x in (sym, size, seq, rank, into, low))
                if not len(sym):
                    break
            at = np.flatnonzero(rank == low)
            run = np.append(True, (np.diff(at) > 1) | (seq[at[1:]] != seq[at[:-1]]))
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]  # leftmost first, without overlap
            # Pairs that a merge makes must not come before the next occurrence of the same rank.
            chosen = np.zeros(len(sym) + 2, bool)
            chosen[at] = True
            z = into[at]
            twice = np.where(at >= 2, chosen[at - 2], False)
            before = np.where(twice, into[at - 2], sym[at - 1])
            before = np.where((at > 0) & (seq[at - 1] == seq[at]), before, -1)
            after_at = np.minimum(at + 2, len(sym) - 1)
            after = np.where((at + 2 < len(sym)) & (seq[after_at] == seq[at]), sym[after_at], -1)
            early = np.minimum(self.lookup(before, z)[0], self.lookup(z, after)[0]) <= low[at]
            if early.any():
                careful = np.isin(seq[at], seq[at[early]])
                leftmost = np.append(True, seq[at[1:]] != seq[at[:-1]])
                at, z = at[~careful | leftmost], z[~careful | leftmost]
            sym = sym.copy()
            sym[at], size[at] = z, 1
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, size, seq = sym[keep], size[keep], seq[keep]
        return count, first == self.space

    @cache  # noqa: B019  one model per worker
    def run_count(self, n: int) -> int:
        """Symbols that ``n`` spaces in a row become: all their pieces rank alike, so the
        leftmost pair that makes a piece always goes first."""
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                last = stack.pop()
                stack[-1] += last
        return len(stack)

    def _learn(self, tokens: set[str]) -> None:
        if new := self.seen.missing(tokens):
            counts, bare = self.merge(new)
            self.seen.new.update(zip(new, np.where(bare, -counts, counts).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        cut = re.compile(f"{SPACE}?[^{SPACE}\n]+|{SPACE}|\n").findall
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        lists = [cut(t) for t in marked]
        self._learn(set().union(*lists))
        seen, out = self.seen.new, []
        for text, tokens in zip(marked, lists, strict=True):
            n = sum(map(abs, map(seen.__getitem__, tokens)))
            if SPACE + SPACE in text:
                n += self._spaces(tokens)
            out.append(n)
        return out

    def _spaces(self, tokens: list[str]) -> int:
        """What the count changes by when spaces in a row merge."""
        change, run = 0, 0
        for t in [*tokens, ""]:
            if self.seen.new.get(t, 1) < 0:
                run += 1
                if t == SPACE:
                    continue
            if run:
                change += self.run_count(run) - run
                run = 0
        return change


def count_tokens(documents: DataFrame, model: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every text. ``model`` is the path of a
    SentencePiece model that every executor has."""
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(("merger", model), lambda: Merger(model))
        for part in batches:
            tokens = [n for _, texts in text_groups(part.column(1)) for n in own.count(texts)]
            yield batch(schema, part.column(0), np.diff(utf8(part.column(1))[1]), tokens, [n > limit for n in tokens])

    return documents.select(id_column, text_column).mapInArrow(count, f"{id_column} long, n_bytes long, n_tokens long, over_limit boolean")
