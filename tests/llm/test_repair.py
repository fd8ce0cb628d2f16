"""Conversation repair against a plain shortest-path search over all edits."""

import heapq
import random
import re
import zlib
from hashlib import sha256

import pytest

from parcelry.llm import queries, repair


def brute(roles, faults, pattern=re.compile(r"(s?(ua)+)?")):
    """Least (cost, edits) over all edit sequences, by Dijkstra over (turn, initials so far as a state)."""
    n = len(roles)
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, said = heapq.heappop(heap)
        if i == n and pattern.fullmatch(said):
            return cost, edits
        state = said[-1:] if said else "-"
        if (i, state) in done:
            continue
        done.add((i, state))
        due = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 3, edits + "I", i, said + due))
        if i < n:
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, said))
            if faults[i] < 2:
                extra = 3 * faults[i]
                if roles[i] == due or roles[i] == "s" and not said:
                    heapq.heappush(heap, (cost + extra, edits + "K", i + 1, said + roles[i]))
                heapq.heappush(heap, (cost + 3 + extra, edits + "R", i + 1, said + due))


def coded(roles, faults):
    return bytes(4 * repair.LETTERS.get(r, 0) + f for r, f in zip(roles, faults))


def test_search_finds_the_least_of_the_cheapest():
    rnd = random.Random(5)
    for k in range(1500):
        n = rnd.randint(0, 9 if k % 10 else 40)
        roles = [rnd.choice("uuaasx") for _ in range(n)]
        faults = [rnd.choice([0, 0, 0, 1, 2]) for _ in range(n)]
        assert repair.whole(coded(roles, faults)) == brute(roles, faults), (roles, faults)


def test_segments_put_together_give_the_whole():
    rnd = random.Random(6)
    for _ in range(300):
        n = rnd.randint(2, 25)
        roles = [rnd.choice("uuaasx") for _ in range(n)]
        faults = [rnd.choice([0, 0, 0, 1, 2]) for _ in range(n)]
        turns, cuts = coded(roles, faults), sorted(rnd.sample(range(1, n), min(n - 1, rnd.randint(1, 4))))
        tables = [repair.table(turns[a:b]) for a, b in zip([0, *cuts], [*cuts, n])]
        assert repair.joined(tables) == brute(roles, faults), (roles, faults, cuts)


def test_runs_put_together_give_the_whole(monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 3)
    rnd = random.Random(8)
    for _ in range(150):
        n = rnd.randint(2, 25)
        roles = [rnd.choice("uuaasx") for _ in range(n)]
        faults = [rnd.choice([0, 0, 0, 1, 2]) for _ in range(n)]
        turns, cut = coded(roles, faults), rnd.randint(1, n - 1)
        assert repair.joined([repair.chained(turns[:cut]), repair.chained(turns[cut:])]) == brute(roles, faults), (roles, faults, cut)


def expected(conversations):
    """The whole contract over plain rows (conv_id, turn, role, text)."""
    said = lambda x: " " if x is None else str(x)
    blank = set(" \t\n\x0b\x0c\r")
    groups = {}
    for conv_id, turn, role, text in conversations:
        rows = groups.setdefault(conv_id, [])
        role, text = said(role), said(text)
        hit = zlib.crc32(f"{said(conv_id)}:{said(turn)}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        rows.extend([(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1))
    out = {}
    for conv_id, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in rows:
            shown = [c for c in text if c not in blank]
            faults.append(3 if not shown else 2 if (role, text) in seen else 1 if shown[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        roles = [r[:1] for _, r, _ in rows]
        cost, edits = brute(roles, [min(f, 2) for f in faults])
        lines, initials, left = [], "", iter(rows)
        for e in edits:
            due = "assistant" if initials[-1:] == "u" else "user"
            _, role, text = next(left) if e != "I" else (None, due, "")
            if e != "D":
                lines.append(f"{role if e == 'K' else due}:{text}")
                initials += lines[-1][0]
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(k) for k in (3, 2, 1)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
            cost,
            edits,
            sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def odd_conversations(seed=7):
    rnd = random.Random(seed)
    rows = []
    for conv_id in [*range(60), None, -7]:
        n = rnd.choice([1, 2, 3, 5, 8, 13]) if conv_id != 11 else 700
        for turn in range(n):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "umpire"]) if rnd.random() < 0.4 else ("user", "assistant")[turn % 2]
            text = rnd.choice(["Hello there.", "So? ", "no stop", "", " \t", None, "same.", "same.", "é漢!\n", "x" * 3000 + "."]) if rnd.random() < 0.5 else f"turn {turn} of {conv_id}."
            rows.append((conv_id, rnd.choice([turn, turn, turn, turn + 3, None]), role, text))
        if conv_id == 5:
            rows.extend([(5, 2, "user", "again and again.")] * 200)
        if conv_id == 9:
            rows.extend([(9, None, None, None)] * 3)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, digest string, audit string, kind int, hit string"


@pytest.mark.parametrize("parts", [1, 32])
def test_query_on_odd_conversations(spark, tmp_path, parts):
    rows = odd_conversations()
    folder = str(tmp_path)
    spark.createDataFrame([(*r, "d", "a", 1, "h") for r in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = queries.QUERIES["op11_repair"](spark, folder)
        assert found.dtypes == [*[(c, "bigint") for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", "string"), ("repaired_sha256", "string")]
        got = {r[0]: tuple(r)[1:] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == expected(rows)


def test_no_conversations_and_none_left(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair.report(nothing, repair.damaged(nothing)).count() == 0
    two = spark.createDataFrame([(1, 1, "user", "Hi."), (2, 1, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    rows = repair.report(two, two.where("conv_id = 2")).orderBy("conv_id").collect()
    assert tuple(rows[0]) == (1, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    # deleting the single turn costs 4, an answer costs 3
    assert rows[1].cost == 3 and rows[1].audit == "KI" and rows[1].repaired_sha256 == sha256(b"user:Hi.\nassistant:").hexdigest()
    solved = repair.solve(two)
    assert {(r.conv_id, r.place, r.role, r.text) for r in repair.repaired(two, solved).collect()} == {(c, *t) for c in (1, 2) for t in ((0, "user", "Hi."), (1, "assistant", ""))}
