import random

import public_tokenizers
import sentencepiece

from tests.llm.helpers import documents
from veilmark.llm import counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_equals_the_library():
    rng = random.Random(5)
    texts = ["".join(rng.choice(" \n▁aabbethe  ing日é🙂\t<s>.1") for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["a" * 3000, " " * 500 + "b", " " * 700, "nnnnnnn", "\n" * 30, " \n  x", "", "<s></s><unk><0x41>", "x\x00y\r\n　z", "aab" * 200]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert counts.Merger(MODEL).count(texts) == [len(x) for x in library.encode(texts)]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(counts, "REMEMBER", 5)
    own, texts = counts.Merger(MODEL), [f"word{i} other{i % 3}  x" for i in range(40)]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [own.count([t])[0] for t in texts] == [len(x) for x in library.encode(texts)]


def test_rows(spark):
    table = documents(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "é"), (4, "word " * 5000)])
    got = sorted(counts.count_tokens(table, MODEL, limit=4096).collect(), key=str)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t, *_ in table.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert counts.count_tokens(table.limit(0), MODEL).count() == 0
