"""Passages and near duplicates, against brute force."""

import hashlib
import random

import numpy as np
import pytest

from parcelry.llm import hashing, repeats, simhash


def brute_spans(rows, depth):
    owner = {}
    for i, text in rows:
        for k in range(len(text) - depth + 1):
            window = text[k : k + depth]
            owner[window] = min(owner.get(window, i), i)
    out = []
    for i, text in rows:
        covered = np.zeros(len(text), bool)
        for k in range(len(text) - depth + 1):
            if owner[text[k : k + depth]] < i:
                covered[k : k + depth] = True
        edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
        out.append((i, text, [tuple(x) for x in edge.reshape(-1, 2).tolist()]))
    return out


def found(df):
    return [(repeats.LAST if r["doc_id"] is None else r["doc_id"], bytes(r["text"]), [(s["start"], s["stop"]) for s in r["spans"]]) for r in df.collect()]


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_repeats_match_brute_force(docs, nothing):
    rows = [(repeats.LAST if r["doc_id"] is None else r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    same(found(repeats.find_repeats(docs)), brute_spans(rows, 50))
    cut = {(r["doc_id"], bytes(r["kept"])) for r in repeats.cut_out(repeats.find_repeats(docs, carry=("lang",)), carry=("lang",)).collect()}
    assert (2, b"") in cut and any(i == 9 and k.startswith(b"An opening that nobody else has. ") and b"fifty" not in k for i, k in cut)
    assert repeats.find_repeats(nothing).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_in_text_full_of_short_repeats(spark, monkeypatch, seed):
    """Few letters and spliced pieces: many marks with one first digit and several second ones."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2000)
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(20, 120))) for _ in range(12)]
    rows = [(k // 2, "".join(rnd.choice(pool)[rnd.randint(0, 15) :] for _ in range(rnd.randint(0, 8)))) for k in range(160)]
    same(found(repeats.find_repeats(spark.createDataFrame(rows, "doc_id long, text string"))), brute_spans([(i, t.encode()) for i, t in rows], 50))


def groups_of(fps, distance):
    label = list(range(len(fps)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = sorted((top(i), top(j)))
                label[b] = a
    return [top(i) for i in range(len(fps))]


def clustered(n, seed):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(5)]
    return [rnd.choice(centres) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_index_groups(seed):
    fps = list(dict.fromkeys(clustered(300, seed)))
    order, label = simhash.linked(np.zeros(300, int)[: len(fps)], np.array(fps, np.uint64), 3)
    found = {}
    for place, row in enumerate(order):
        found.setdefault(label[place], []).append(int(row))
    assert sorted(map(sorted, found.values())) == classes(groups_of(fps, 3))


def classes(labels):
    found = {}
    for k, x in enumerate(labels):
        found.setdefault(x, []).append(k)
    return sorted(found.values())


def test_index_keeps_keys_apart():
    rnd = random.Random(4)
    fps = clustered(400, 4)
    keys = [rnd.choice([0, 1, 2, 3, 3, 3, 4 + k]) for k in range(400)]
    order, label = simhash.linked(np.array(keys), np.array(fps, np.uint64), 3)
    found = {}
    for place, row in enumerate(order):
        found.setdefault(label[place], []).append(int(row))
    want = []
    for key in set(keys):
        own = [k for k in range(400) if keys[k] == key]
        want.extend([own[i] for i in c] for c in classes(groups_of([fps[k] for k in own], 3)))
    assert sorted(map(sorted, found.values())) == sorted(want)


@pytest.mark.parametrize("part", [64, 8192])
def test_links_connect_all_within_the_distance(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    fps = list(dict.fromkeys(clustered(400, 9)))
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, k) for k, f in enumerate(fps)], "fp long, doc long")
    placed = {r["node"]: r["component"] for r in simhash.components(simhash.links(nodes, 3)).collect()}
    assert [placed.get(k, k) for k in range(len(fps))] == groups_of(fps, 3)


def test_long_chain(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(60)], "a long, b long")
    assert {tuple(r) for r in simhash.components(edges).collect()} == {(k, 0) for k in range(61)}


def test_near_duplicates(docs, nothing):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert {c for _, c in by[2]} == {1} and by[3] == by[4] == by[5] == {(0, 3)}
    assert simhash.near_duplicates(nothing).collect() == []


def test_fingerprint_bits():
    import xxhash

    words = b"A b C d e".lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(3)]
    bits = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > 1.5)
    assert simhash.fingerprint(b"A b  C\td\ne") == bits and simhash.fingerprint(b" ") == 0


def test_word_hashes_depend_on_the_word_only():
    a, b = hashing.Tokens([b"x One two", b"", b" two"]), hashing.Tokens([b"two one"])
    assert a.hash[2] == a.hash[3] == b.hash[0] and a.hash[1] == b.hash[1] and a.first.tolist() == [0, 3, 3, 4]


def one_bit_texts():
    """Texts of which each is within the distance of the next only."""
    rnd = random.Random(2)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(400)]
    out = []
    for k in range(60):
        out.append(" ".join(base))
        base[rnd.randrange(400)] = f"v{k}"
    return out


@pytest.fixture(scope="module")
def bridges(spark):
    """Texts in a chain, some without an id, some ids repeated, some rows repeated."""
    rnd = random.Random(11)
    rows = [(None if k % 3 == 1 else rnd.choice([k, k, k % 7]), t) for k, t in enumerate(one_bit_texts())]
    rows += [(None, ""), (None, None), (900, " "), (901, "alone in its group"), (None, "nobody is like this one"), *rows[:5]]
    return rows


def test_groups_over_texts_equal_brute_force(spark, bridges):
    fps = [simhash.fingerprint((t or "").encode()) for _, t in bridges]
    labels = groups_of(fps, 3)
    want = []
    for (i, _), fp, x in zip(bridges, fps, labels):
        ids = [j for (j, _), y in zip(bridges, labels) if y == x and j is not None]
        want.append((i, fp - (1 << 64) if fp >> 63 else fp, min(ids, default=None)))
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in bridges], "doc_id long, text string, component string, n_rows long").repartition(3)
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(set(labels)) < len(bridges) - 10


def test_one_row_of_each_group_stays(spark, bridges):
    labels = groups_of([simhash.fingerprint((t or "").encode()) for _, t in bridges], 3)
    best = {}
    for (i, t), x in zip(bridges, labels):
        key = (i is None, i or 0, hashlib.sha256((t or "").encode()).digest())
        best[x] = min(best.get(x, (key, i, t)), (key, i, t), key=lambda r: r[0])
    docs = spark.createDataFrame([(i, t, "k") for i, t in bridges], "doc_id long, text string, component string").repartition(3)
    got = [(r.doc_id, r.text or "") for r in simhash.one_of_each(docs).collect()]
    assert sorted(got, key=repr) == sorted(((i, t or "") for _, i, t in best.values()), key=repr)
    assert simhash.one_of_each(docs.limit(0)).collect() == []
