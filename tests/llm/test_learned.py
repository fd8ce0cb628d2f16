"""Scores, languages, rules, neighbours and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelry.llm import hashing, language, mixing, neighbours, quality, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ENGLISH = "the cat sat on the mat and the dog ran to the house with all of them".split()
GERMAN = "der hund und die katze sind nicht im haus aber ich habe das buch über straßen".split()
GREEK = "η γάτα και ο σκύλος είναι στο σπίτι".split()


def sentences(words, n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(words, 30)) for _ in range(n)]


# --- context mixing ---------------------------------------------------------


def test_mixing_base_is_exact(docs, nothing):
    tokens = [(r["doc_id"], WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")) + ["\n"]) for r in docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    seen = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(seen.values()), len(seen)
    wanted = sorted((i or 0, len(ws), sum(seen[w] > 0 for w in ws), n, round(sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 5)) for i, ws in tokens)
    rows = mixing.score(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == wanted
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert mixing.score(nothing).collect() == []


def test_mixing_is_the_same_under_any_partitioning(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "WORDS_A_STEP", 700)
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (3, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        rows = mixing.score(docs.repartition(parts)).collect()
        found.append(sorted((r["doc_id"] or 0, r["n_tokens"], r["score"], r["bits_per_byte"]) for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    for a, b in zip(*found):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-12)
    sizes = sorted((r["doc_id"] or 0, len((r["text"] or "").encode())) for r in docs.collect())
    assert [x[3] for x in found[0] if x[0] == 1] == pytest.approx([-x[2] / math.log10(2) / dict(sizes)[1] for x in found[0] if x[0] == 1])


def test_mixing_probabilities_of_all_continuations_sum_to_one():
    """The bits of one byte after a prefix are a tree: the probabilities of its leaves sum to one."""
    code = mixing.Code(np.arange(257))
    rng = np.random.default_rng(0)
    mixer = mixing.Mixer(code, [rng.integers(0, 50, (1 << n, 2)).astype(np.uint16) for n in (18, 20, 20, 22, 22)])
    tails = [b"ab" + bytes([x]) for x in range(256)]
    # log of a byte after "ab": the spelled word without its terminator
    total = 0.0
    for word, whole in zip(tails, mixer.log10(tails)):
        slots, _, bit, _ = mixing.bits_of([word], code)
        stop = code.size[mixing.STOP]
        p = mixer.mix(*mixer.inputs([s[-stop:] for s in slots]))
        total += 10 ** (whole - np.log10(np.where(bit[-stop:] == 1, p, 1 - p)).sum())
    closed = mixer.log10([b"ab"])[0]
    head = mixing.bits_of([b"ab"], code)
    stop = code.size[mixing.STOP]
    p = mixer.mix(*mixer.inputs([s[:-stop] for s in head[0]]))
    prefix = np.log10(np.where(head[2][:-stop] == 1, p, 1 - p)).sum()
    assert total + 10**closed == pytest.approx(10**prefix, rel=1e-6)


def test_mixing_learns(spark):
    rows = [(k, t) for k, t in enumerate(sentences(ENGLISH, 300, 1))]
    scored = {r["doc_id"]: r["score"] / r["n_tokens"] for r in mixing.score(spark.createDataFrame(rows + [(1000, "qzx vvk jjq wxy")], "doc_id long, text string")).collect()}
    held = [scored[k] for k, _ in rows if zlib.crc32(str(k).encode()) % 10 == 0]
    # under 6 bits a word, where chance is 8 bits a byte
    assert np.mean(held) > -6 * math.log10(2) and scored[1000] < -4


def test_mixing_contexts_cross_the_border_of_a_word(spark):
    """Bits of a word's first bytes depend on the word before it, those behind them do not."""
    code = mixing.Code(np.arange(257))
    place = np.repeat(np.arange(6), code.size[list(b"house") + [mixing.STOP]])
    for k, order in enumerate(mixing.ORDERS):
        the, old, bold = (mixing.bits_of([b"house"], code, [before])[0][k] for before in (b"the", b"old", b"bold"))
        assert set(place[the != old]) == set(range(4) if order == 5 else ())
        assert set(place[old != bold]) == set(range(1) if order == 5 else ())
    turned = " ".join(reversed(ENGLISH))
    docs = spark.createDataFrame(list(enumerate(sentences(ENGLISH, 50, 1))) + [(100, " ".join(ENGLISH)), (101, turned)], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in mixing.score(docs).collect()}
    assert abs(found[100] - found[101]) > 1e-6


@pytest.mark.parametrize("kept", [2, 21])
def test_mixing_windows_and_words_add_up_to_the_text(monkeypatch, kept):
    """First bytes by windows and the rest by words give what each word costs in its place, whether priced now or before."""
    monkeypatch.setattr(mixing, "KEPT_BITS", kept)
    rng = np.random.default_rng(1)
    code = mixing.Code(np.arange(257))
    mixer = mixing.Mixer(code, [rng.integers(0, 50, (1 << n, 2)).astype(np.uint16) for n in mixing.SLOT_BITS])
    texts = ["the old house", "", " \t ", "a", "a  b\nabcd abc\x00 ABCDE", "ab straße 漢字 " + "x" * 300, "\x00 \x00\x00\x00\x00 y", "the old house"]
    data = [t.encode() for t in texts]
    prices, found = mixing.Prices(mixer), np.zeros(len(texts))
    for _ in range(2):
        found[:] = 0
        for keys, owner in mixing.windows_of(hashing.Tokens(data), len(data)):
            found += np.bincount(owner, prices.of(keys), len(data))
    for t, got in zip(data, found):
        words = t.lower().split() + [mixing.END]
        wanted = mixer.log10(words, [mixing.END, *words[:-1]]).sum()
        assert got + mixer.log10(words, first=mixing.HEAD).sum() == pytest.approx(wanted, rel=1e-9)


# --- quality ----------------------------------------------------------------


def test_quality_learns_and_keeps_held_out_rows_out(spark):
    good, bad = sentences(ENGLISH, 300, 2), ["### ".join(sentences(ENGLISH, 1, k)) + " $$$ | " * 9 for k in range(300)]
    docs = spark.createDataFrame([(k, t, 5) for k, t in enumerate(good + bad)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, int(k < 300)) for k in range(600)], "doc_id long, quality int")
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.train(docs, labels)).collect()}
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all((scored[k] >= 0.3) == (k < 300) for k in held)
    flipped = spark.createDataFrame([(k, int(k < 300) if k not in held else int(k >= 300)) for k in range(600)], "doc_id long, quality int")
    assert np.array_equal(quality.train(docs, flipped), quality.train(docs, labels))


def test_quality_edges(docs, labels, nothing, no_labels):
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in quality.score(docs, quality.train(docs, no_labels)).collect()} == {0.5}
    assert quality.score(nothing, quality.train(nothing, labels)).collect() == []


# --- language ---------------------------------------------------------------


def test_language_spans_and_scripts(spark):
    rows = [(k, t, lang) for lang, words, base in (("en", ENGLISH, 0), ("de", GERMAN, 100), ("el", GREEK, 200)) for k, t in enumerate(sentences(words, 60, base), base)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = "the dog ran to the house and the cat sat on the mat der hund und die katze sind nicht im haus aber das buch"
    asked = [(1, mixed), (2, "η γάτα και ο σκύλος"), (3, "123 456 --"), (4, None), (5, ""), (6, "der hund und die katze"), (6, "der hund und die katze")]
    got = language.predict(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert [s["lang"] for s in by[1]["spans"]] == ["en", "de"] and by[1]["spans"][0]["words"] == 13
    assert by[2]["lang_pred"] == "el" and by[6]["lang_pred"] == "de" and len(got) == 7
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (3, 4, 5))


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    first = np.array([0, 4, 4, 9])
    scores = rng.normal(0, 3, (9, 3))
    got = language.viterbi(scores, first, 2.0)
    value = lambda path, s: s[np.arange(len(path)), path].sum() - 2.0 * (np.diff(path) != 0).sum()
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            paths = np.stack(np.meshgrid(*[range(3)] * (b - a)), -1).reshape(-1, b - a)
            assert value(got[a:b], scores[a:b]) == pytest.approx(max(value(p, scores[a:b]) for p in paths))


@pytest.mark.parametrize("span", [1, 3, 256])
def test_runs_of_a_text_join_to_the_best_path(monkeypatch, span):
    """Whole texts, as with many languages, and short runs give paths of the same value; and the same labels, as no ties arise."""
    rng = np.random.default_rng(5)
    first = np.cumsum([0, 40, 0, 1, 7, 0, 300, 2])
    scores = rng.normal(0, 3, (first[-1], 4)).astype(np.float32)
    monkeypatch.setattr(language, "SPAN", span)
    got = language.viterbi(scores, first, 4.0)
    monkeypatch.setattr(language, "SIDE_BY_SIDE", 0)
    assert (got == language.viterbi(scores, first, 4.0)).all()
    assert len(set(got.tolist())) == 4


def test_known_words_are_found_again(monkeypatch):
    tokens = hashing.Tokens([b"one two three two one four five six seven"])
    asked = []

    def make(words):
        asked.extend(words.hash.tolist())
        return (words.hash % np.uint64(97)).astype(np.float32)[:, None]

    known = language.Known(1, size=8)
    for size in (3, 5, 9, 9):
        words, like = language.distinct(hashing.Tokens([b" ".join(b"one two three two one four five six seven".split()[:size])]))
        assert (known.get(words, make)[like][:, 0] == (tokens.hash[:size] % np.uint64(97)).astype(np.float32)).all()
    assert len(asked) == 7


def test_language_edges(docs, nothing):
    assert len(language.predict(docs, language.train(docs)).collect()) == docs.count()
    unlearned = language.predict(docs, language.train(nothing)).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}


# --- rules ------------------------------------------------------------------


def base_of(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_rules_match_brute_force(docs, labels, nothing, no_labels):
    rows = rules.judge(docs, rules.trusted_ids(labels)).collect()
    assert Counter(((r["doc_id"], r["text"]), tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))) for r in rows) == Counter(
        ((r["doc_id"], r["text"]), base_of(r["text"])) for r in docs.collect()
    )
    for r in rows:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["ratio"] >= rules.THRESHOLD)
    assert all(r["ratio"] in (0.0, None) for r in rules.judge(docs, rules.trusted_ids(no_labels)).collect())
    assert rules.judge(nothing, rules.trusted_ids(labels)).collect() == []


def test_rules_reject_what_the_trusted_never_say(spark):
    good, bad = sentences(ENGLISH, 200, 4), [" ".join(f"{w}%%%" for w in t.split()) for t in sentences(ENGLISH, 60, 5)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in rules.judge(docs, rules.trusted_ids(labels)).collect()}
    assert all(kept[k] for k in range(200)) and not any(kept[k] for k in range(200, 260))


def test_rules_trust_every_good_label(spark, docs, labels, monkeypatch):
    many = spark.range(20_050).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert rules.trusted_ids(many.union(many)).count() == 20_050
    told = rules.ratios(docs, rules.trusted_ids(labels))
    monkeypatch.setattr(rules, "TOLD", 0)
    assert any(told) and rules.ratios(docs, rules.trusted_ids(labels)) == told


# --- neighbours -------------------------------------------------------------


def brute_nearest(rows, query, k):
    v = dict(rows)[query]
    best = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != query)
    return [i for _, i in best[:k]]


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(0, 1, 16).astype(np.float32).tolist()) for k in range(1200)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=10, shard_rows=500).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    doubles = [(k, np.array(v, np.float64)) for k, v in rows]
    hits = sum(len({i for i, _ in got[q]} & set(brute_nearest(doubles, q, 10))) for q in range(0, 1200, 20))
    assert hits >= 0.9 * 600
    by = dict(doubles)
    assert all(s == pytest.approx(float(by[q] @ by[i]), rel=1e-12) for q, found in got.items() for i, s in found)


def test_neighbours_ties_and_unusable_vectors(spark):
    rows = [(k, [1.0, 0.0]) for k in range(100)] + [(200, [0.0, 0.0]), (201, None), (202, [float("nan"), 1.0]), (203, [None, 1.0]), (204, [float("inf"), 0.0]), (205, [0.0, 2.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id long, embedding array<float>, shard string")
    got = {}
    for r in neighbours.nearest(vectors, vectors.where("vec_id % 5 = 0"), k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got[0] == [1, 2, 3, 4, 5, 6, 7] and got[5] == [0, 1, 2, 3, 4, 6, 7] and got[205] == [0, 1, 2, 3, 4, 5, 6] and 200 not in got
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in neighbours.nearest(few, few, k=5).orderBy("query_id").collect()] == [(0, 1, 1, 2.0), (1, 1, 0, 2.0)]
    none = vectors.limit(0)
    assert neighbours.nearest(none, none, k=5).collect() == []
