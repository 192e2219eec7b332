import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.helpers import documents
from veilmark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_equal_the_library():
    texts = ["İstanbul <|endoftext|>x<|startoftext|>", "ΑΣ Σ", "é ́x", "a b　c\x1cd\x85e", "日本🙂🙂", "don't I'LL we've", "", " ",
             "Ab12.5!?«x»", "ñÑ ß ẞ µ²½ª", "x" * 3000, "a\n\n b\tc"]
    tokenizer = Tokenizer.from_file(PATH)
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.Encoder(PATH).ids(texts) == want


def test_dearest_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        price = np.zeros(21)
        price[rng.integers(2, 21, 4)] = rng.random(4)

        def best(room, price=price):
            return max([price[x] + best(room - x) for x in range(1, room + 1) if price[x] > 0], default=0.0)

        found = packing._dearest(price, 20)
        assert sum(x * k for x, k in found.items()) <= 20
        assert np.isclose(sum(price[x] * k for x, k in found.items()), best(20))


def test_configurations_hold_every_piece():
    rng = np.random.default_rng(3)
    for _ in range(10):
        demand = {int(x): int(n) for x, n in zip(rng.integers(1, 65, 30), rng.integers(1, 2000, 30))}
        packed = packing.configurations(demand, 64, 50)
        held = Counter()
        for config, times in packed:
            assert sum(x * k for x, k in config) <= 64
            for x, k in config:
                held[x] += k * times
        assert held == demand
        assert sum(n for _, n in packed) <= 1.1 * sum(x * n for x, n in demand.items()) / 64 + 5 or max(demand) > 32
    assert packing.configurations({}, 64) == []


def test_pack(spark):
    rows = [(i, "token " * (i % 7) + "word" * (i % 3)) for i in range(300)] + [(900, None), (901, ""), (902, "many words " * 3000), (None, "a"), (5, "again")]
    table = documents(spark, rows)
    got = packing.pack(table, PATH, capacity=64).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 64)):
            some = ids[at : at + 64]
            want[(i, piece, at, len(some), zlib.crc32(np.array(some, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= 1.02 * sum(r["length"] for r in got) / 64 + 1
    assert packing.pack(table.limit(0), PATH).count() == 0
