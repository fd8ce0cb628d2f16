"""Encoding, decoding and packing, against the public libraries."""

import random
import time
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parcelry.llm import bpe, packing, ranked

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def automaton():
    return bpe.Automaton(VOCABULARY)


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    parts = ["a", "e", "t", "the", "ing", " ", "  ", "\n", "\r", "\x1c", "\x85", "\xa0", "é", "漢", "😀", "'s", "1", "²", "_", "!", "\0", "<|endoftext|>", "zz" * 20]
    for _ in range(n):
        yield "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        yield "".join(chr(rnd.choice([rnd.randint(0, 0x3000), rnd.randint(0xE000, 0x10FFFF)])) for _ in range(rnd.randint(0, 30)))


def test_automaton_gives_the_ids_of_the_merges(library, automaton):
    encoder = ranked.RankEncoder(RANKS, VOCABULARY)
    for text in odd_texts(1500):
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(array("I", automaton.encode(text))) == ids
        assert list(array("I", encoder.encode(text))) == ids
        assert automaton.decode(array("I", ids).tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_words_without_a_blank_take_linear_time(library, automaton):
    rnd = random.Random(5)
    for word in ("ab" * 30_000, "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(20_000)), "".join(rnd.choices("abcdefghij", k=60_000))):
        assert list(array("I", automaton.encode(word))) == library.encode(word, add_special_tokens=False).ids
    begun = time.process_time()
    automaton.encode("".join(rnd.choices("abcdefghij", k=1_000_000)))
    assert time.process_time() - begun < 60


def test_every_merge_has_its_gadget(automaton):
    assert len(automaton.index) == 50_256
    assert all(automaton.walk(label) == [i] for label, i in list(automaton.index.items())[::97])


def test_recent_keeps_two_generations():
    made = Counter()
    cache = bpe.Recent(lambda k: made.update([k]) or k.encode(), size=2)
    assert [cache[k] for k in "aabbccaab"] == [k.encode() for k in "aabbccaab"]
    assert len(cache) + len(cache.older) <= 4 and sum(made.values()) < 9


def test_encode_and_decode(spark, docs, nothing, library):
    automaton = bpe.shared_automaton(spark, VOCABULARY)
    rows = bpe.decode(bpe.encode(docs, automaton), automaton).collect()
    source = Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert Counter((r["doc_id"], r["decoded"]) for r in rows) == source
    for r in rows:
        assert list(array("I", r["ids"])) == library.encode(r["decoded"], add_special_tokens=False).ids
    assert bpe.decode(bpe.encode(nothing, automaton), automaton).collect() == []


def test_pack(spark, docs, nothing, library):
    encoder = ranked.shared_encoder(spark, RANKS, VOCABULARY)
    rows = packing.pack(docs, encoder, capacity=128).collect()
    ids = {(r["doc_id"], r["text"]): library.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    lengths = Counter(len(ids[r["doc_id"], r["text"]]) for r in docs.collect())
    assert sum(r["length"] for r in rows) == sum(n * c for n, c in lengths.items())
    by_doc = {i: x for (i, _), x in ids.items()}
    sequences = defaultdict(list)
    for r in rows:
        piece = by_doc[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(array("I", piece).tobytes()) == r["ids_crc32"]
        assert r["length"] == 128 or r["piece"] == 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 128
    assert packing.pack(nothing, encoder, capacity=128).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_and_is_near_the_bound(seed):
    rnd = random.Random(seed)
    counts = Counter(min(256, max(1, int(rnd.lognormvariate(4, 1)))) for _ in range(4000))
    used = defaultdict(list)
    for length, first, sequence, copies, offset in packing.plan(counts, 256):
        used[length].append((first, sequence, copies, offset))
    cells = Counter()
    for length, n in counts.items():
        steps = sorted(used[length])
        for (first, sequence, copies, _), after in zip(steps, [*steps[1:], (n, 0, 0, 0)]):
            for k in range(after[0] - first):
                cells[sequence + k // copies] += length
    assert max(cells.values()) <= 256 and sum(cells.values()) == sum(x * n for x, n in counts.items())
    assert len(cells) <= 1.01 * -(-sum(cells.values()) // 256) + 2


def test_best_filling_is_a_knapsack_optimum():
    import numpy as np

    prices = np.zeros(21)
    prices[[3, 7, 9]] = [3.2, 8.0, 10.5]
    best = max(a * 3.2 + b * 8.0 + c * 10.5 for a in range(7) for b in range(3) for c in range(3) if 3 * a + 7 * b + 9 * c <= 20)
    filling = packing.best_filling(prices, 20)
    assert sum(prices[x] * n for x, n in filling.items()) == pytest.approx(best)


@pytest.mark.parametrize("counts, capacity, most", [({400: 6000, 300: 12000}, 1024, 6000), ({500: 900, 250: 1800}, 1024, 900), ({600: 1000, 350: 1000, 100: 50}, 1024, 1005)])
def test_plan_of_few_lengths(counts, capacity, most):
    rows = packing.plan(counts, capacity)
    used, cells = defaultdict(list), Counter()
    for length, first, sequence, copies, offset in rows:
        used[length].append((first, sequence, copies))
    for length, n in counts.items():
        steps = sorted(used[length])
        for (first, sequence, copies), after in zip(steps, [*steps[1:], (n, 0, 0)]):
            for k in range(after[0] - first):
                cells[sequence + k // copies] += length
    assert max(cells.values()) <= capacity and sum(cells.values()) == sum(x * n for x, n in counts.items())
    assert len(cells) <= most
