"""The prefix trie against a plain build in one process."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from parcelry.llm import queries, trie
from parcelry.llm.common import settled


def plain_trie(sequences):
    """sequences: conv_id -> list of (role, text)."""
    members = defaultdict(list)
    for conv_id, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv_id)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        saved[node] = own + sum(saved[c] for c in children[node])
    return sorted(
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(m),
            len(children[node]),
            leaves[node],
            saved[node],
            sha256(",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(node)).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def rebuilt(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            turns[conv_id].append((turn is not None, turn or 0, role, sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    for own in turns.values():
        own.sort()
    plain = {c: [(r, t) for *_, r, _, t in own] for c, own in turns.items()}
    out = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = plain.get(head, [])[:h] + own[h:]
    return out


def odd_conversations(seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(0, 260), None, -5, -100, -250, 1000, 1007]:
        n = rnd.choice([0, 1, 2, 3, 6, 9]) if c != 7 else 150
        kind = rnd.randint(0, 3)
        for turn in range(max(n, 1)):
            text = f"{kind} says {turn}" if rnd.random() < 0.9 else rnd.choice(["", None, "é漢😀", "x" * 2000])
            rows.append((c, rnd.choice([turn, turn, turn, None]), rnd.choice(["user", "assistant", None]) if rnd.random() < 0.1 else "user", text))
    rows += [(300 + k, t, "user", f"copy {t}") for k in range(90) for t in range(70)]
    rows += [(300, 1, "user", "copy 1")] * 5
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, node string, parent string, piece string, pos int"


def test_query_on_odd_conversations(spark, tmp_path):
    rows, folder = odd_conversations(), str(tmp_path)
    spark.createDataFrame([(*r, "n", "p", "q", 1) for r in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    found = queries.QUERIES["op13_trie"](spark, folder)
    longs = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    assert found.dtypes == [*((c, "bigint") for c in longs), ("ends_sha256", "string")]
    key = lambda r: (r[2] is not None, r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain_trie(rebuilt(rows)), key=key)


@pytest.mark.parametrize("whole,limit,band", [(1, 8, 4), (3, 40, 8), (1, 2, 2)])
def test_small_components_over_several_rounds(spark, whole, limit, band):
    rnd = random.Random(limit)
    sequences = {c: [("user", str(rnd.choice([0, 0, 0, 1]))) for _ in range(rnd.choice([0, 3, 7, 20]))] for c in range(60)}
    sequences[60] = sequences[61] = [("user", "0")] * 40
    rows = [(c, t, *x) for c, own in sequences.items() for t, x in enumerate(own)]
    sequences = {c: own for c, own in sequences.items() if own}
    turns = settled(trie.placed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), "turns")
    found = trie.prefix_trie(trie.alone(turns), whole, limit, band)
    key = lambda r: (r[2] is not None, r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain_trie(sequences), key=key)


def test_centroids_give_subtree_sums():
    rnd = random.Random(1)
    for shape in ("bush", "chain", "star", "forest"):
        for n in (1, 2, 3, 50, 400):
            parents = [-1] + [{"bush": rnd.randrange(k), "chain": k - 1, "star": 0, "forest": rnd.choice([-1, k - 1, rnd.randrange(k)])}[shape] for k in range(1, n)]
            names = rnd.sample(range(n), n)
            moved = [0] * n
            for k, p in enumerate(parents):
                moved[names[k]] = names[p] if p >= 0 else -1
            values = [[rnd.randint(-5, 9) for _ in range(n)] for _ in range(2)]
            want = [list(v) for v in values]
            for k in range(n - 1, 0, -1):
                for w in want:
                    if parents[k] >= 0:
                        w[names[parents[k]]] += w[names[k]]
            assert trie.centroid_totals(moved, values) == want
    with pytest.raises(ValueError):
        trie.centroid_totals([1, 0], [[1, 1]])


def test_no_conversations(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(trie.rebuilt(settled(trie.placed(nothing), "turns"))).count() == 0


def test_query_agrees_with_its_sql(spark):
    import oracle

    folder = "/root/testdata/sf0.001"
    assert oracle.compare(queries.QUERIES["op13_trie"](spark, folder), folder, queries.CHECKS["op13_trie"]) == []
