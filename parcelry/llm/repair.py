"""Repair of the turn structure of conversations by the cheapest edits, found by iterative-deepening A*.

Turns are kept (K), given the role that is due (R), deleted (D), or an empty turn of that role is inserted (I), until the
initials of the roles read ``(s?(ua)+)?``.  A search goes through the turns depth first, edits in ASCII order, as far as a
bound on the cost allows; a state that failed keeps the least cost that it would have needed, and the least of those is
the next bound.  So the first path that is accepted is the cheapest, and of equal ones the least in ASCII order.

Turns are sorted over all tasks by conversation and place, so that a conversation of any length is cut into runs.  One of
at most ``LONGEST`` turns that lies in one task is searched there at once; any other run is cut into segments of ``SEGMENT``
turns, each is searched for every pair of states before and after it, and they are put together afterwards.  An insertion belongs to the segment of the turn it stands before, so every segment but the last
ends with the edit of a turn, none of its paths is the beginning of another, and the least of each gives the least whole.
"""

import sys
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelry.llm.common import ready, settled

SEGMENT = 64
#: A conversation of up to so many turns is searched at once if it lies in one task.
LONGEST = 512
#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: What counts as blank, and how a whole turn ends.
SHOWN, STOPS = r"[^\x20\x09-\x0D]", "[.!?]"
START, SYSTEM, USER, ASSISTANT = range(4)
NO_WAY, DONE = 1 << 30, None
#: Letters of roles as states; any other initial has none.
LETTERS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What may follow each state, and the state that an insertion or a new role leads to.
MAY_FOLLOW = [{SYSTEM, USER}, {USER}, {ASSISTANT}, {USER}]
DUE = [USER, USER, ASSISTANT, USER]
WHOLE = frozenset({START, ASSISTANT})

FACTS = "n_rows long, blank long, duplicate long, truncated long, illegal long, n_turns long, least_turn long, most_turn long, first_turn long, last_turn long, first_letter int, last_letter int"


def damaged(conversations):
    """The rows that are left after damage by a hash of conversation and turn, a missing value as one space.

    Of the hash modulo 20, 0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), hit.alias("hit")).where("hit != 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", STOPS, "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "hit")
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.expr("sequence(0, if(hit = 3, 1, 0))")).alias("copy")).drop("copy")


def ordered(rows):
    """Rows with what their place depends on: turns with missing ones first, then role and digest; equal rows may change places."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    digest = F.sha2(F.concat(F.length(said("role")).cast("string"), F.lit(":"), said("role"), said("text")).cast("binary"), 256)
    return rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), digest.alias("digest"))


PLACE = ["conv_id", "turn", "role", "digest"]


class Search:
    """The cheapest path through the turns of one segment, from a state to one of some goals.

    ``turns`` has a byte for each: four times its state (0: none) plus 0 whole, 1 truncated, 2 to be deleted.
    ``last``: whether turns may still be inserted behind the last one.
    """

    def __init__(self, turns, goals, last):
        self.turns, self.goals, self.last, n = turns, goals, last, len(turns)
        self.failed = {}
        # least cost of each turn alone, and half of what each illegal pair of kept turns costs more: one edit mends at most two pairs
        self.alone, self.pairs, self.next_kept = [0] * (n + 1), [0] * (n + 1), [n] * (n + 1)
        for i in range(n - 1, -1, -1):
            letter, fault = divmod(turns[i], 4)
            self.alone[i] = self.alone[i + 1] + (0, CUT_OFF, DELETE)[fault]
            if fault == 2:
                self.pairs[i], self.next_kept[i] = self.pairs[i + 1], self.next_kept[i + 1]
                continue
            self.next_kept[i] = i
            after = self.next_kept[i + 1]
            if after == n:
                self.pairs[i] = 0 if letter in goals and letter else self.half(i)
            else:
                fits = letter and turns[after] // 4 in MAY_FOLLOW[letter]
                self.pairs[i] = self.pairs[after] + (0 if fits else min(self.half(i), self.half(after)))

    def half(self, i):
        return 1 if self.turns[i] % 4 == 1 else 3

    def at_least(self, i, state):
        """A bound from below on the cost from here to a goal."""
        after = self.next_kept[i]
        if after < len(self.turns):
            fits = self.turns[after] // 4 in MAY_FOLLOW[state]
            return self.alone[i] + (self.pairs[after] + (0 if fits else self.half(after)) + 1) // 2
        if state in self.goals:
            return self.alone[i]
        return self.alone[i] + INSERT if self.last or i < len(self.turns) else NO_WAY

    def dive(self, i, state, rest, path):
        """DONE if a goal is reached at a cost of at most ``rest``, with its edits put on ``path`` from the last to the first, else the least cost that may do."""
        need = self.failed.get((i, state))
        if need is None:
            need = self.at_least(i, state)
        if need > rest:
            return need
        n = len(self.turns)
        if i == n and state in self.goals:
            return DONE
        need = NO_WAY
        for edit, cost, i_after, state_after in self.edits(i, state):
            more = self.dive(i_after, state_after, rest - cost, path)
            if more is DONE:
                path.append(edit)
                return DONE
            need = min(need, cost + more)
        self.failed[i, state] = need
        return need

    def edits(self, i, state):
        """In ASCII order."""
        n = len(self.turns)
        letter, fault = divmod(self.turns[i], 4) if i < n else (0, 2)
        if i < n:
            yield "D", DELETE, i + 1, state
        if i < n or self.last:
            yield "I", INSERT, i, DUE[state]
        if fault < 2:
            extra = CUT_OFF if fault else 0
            if letter and letter in MAY_FOLLOW[state]:
                yield "K", extra, i + 1, letter
            yield "R", REROLE + extra, i + 1, DUE[state]

    def reachable(self, state):
        """Nothing leads back to the start, and only a kept turn leads from the start to the system's state."""
        if self.last or self.goals & {USER, ASSISTANT} or state in self.goals:
            return True
        return SYSTEM in self.goals and state == START and any(t // 4 == SYSTEM and t % 4 < 2 for t in self.turns)

    def best(self, state):
        """Cost and edits, or None where no path leads to a goal."""
        # each turn deleted and a few insertions reach any goal that can be reached at all
        most = DELETE * len(self.turns) + 4 * INSERT
        if not self.reachable(state):
            return None
        bound = self.at_least(0, state)
        while bound <= most:
            path = []
            need = self.dive(0, state, bound, path)
            if need is DONE:
                return bound, "".join(reversed(path))
            bound = need
        return None


@lru_cache(maxsize=50_000)
def whole(turns):
    """Cost and edits of a whole conversation."""
    return Search(turns, WHOLE, True).best(START)


@lru_cache(maxsize=5_000)
def table(turns):
    """Best path of a segment from each state to each state, and from each state to the end: 20 pairs of cost and edits."""
    found = [Search(turns, frozenset({q}), False).best(p) for p in range(4) for q in range(4)]
    return [x or (NO_WAY, "") for x in found + [Search(turns, WHOLE, True).best(p) for p in range(4)]]


def chained(turns):
    """The table of a run from those of its segments."""
    tables = [table(turns[k : k + SEGMENT]) for k in range(0, len(turns), SEGMENT)]
    whole = tables[0]
    for t in tables[1:]:
        # through each state in the middle; to each state behind, and to the end
        after = [[t[4 * m + q] for m in range(4)] for q in range(4)] + [t[16:]]
        best = lambda p, to: min((a[0] + b[0], a[1] + b[1]) for a, b in zip(whole[4 * p : 4 * p + 4], to))
        whole = [best(p, after[q]) for p in range(4) for q in range(4)] + [best(p, after[4]) for p in range(4)]
        whole = [(min(cost, NO_WAY), edits) for cost, edits in whole]
    return whole


def joined(tables):
    """Cost and edits of a conversation from the tables of its segments in order."""
    togo = [[cost for cost, _ in tables[-1][16:]]]
    for t in reversed(tables[:-1]):
        togo.append([min(t[4 * p + q][0] + togo[-1][q] for q in range(4)) for p in range(4)])
    togo.reverse()
    edits, states = [], {START}
    for k, t in enumerate(tables[:-1]):
        # the best costs of the rest tell which paths stay optimal; of those the least is taken, in every state it leads to
        ways = [(t[4 * p + q][1], q) for p in states for q in range(4) if t[4 * p + q][0] + togo[k + 1][q] == togo[k][p] < NO_WAY]
        least = min(ways)[0]
        edits.append(least)
        states = {q for edit, q in ways if edit == least}
    edits.append(min(tables[-1][16 + p][1] for p in states))
    return togo[0][START], "".join(edits)


def applied(edits, turns):
    """What ``edits`` make of ``turns``, (role, text) in order, as (role, text)."""
    state, turns = START, iter(turns)
    for edit in edits:
        if edit == "D":
            next(turns)
        elif edit == "K":
            role, text = next(turns)
            state = LETTERS[role[0]]
            yield role, text
        else:
            state = DUE[state]
            yield ROLES[state], next(turns)[1] if edit == "R" else ""


class Run:
    """The turns of one conversation that follow each other in a task."""

    def __init__(self, conv_id):
        self.conv_id, self.turns = conv_id, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.least = self.most = self.first = self.last = None

    def add(self, turn, letter, fault):
        if self.turns:
            before = self.turns[-1] // 4
            self.illegal += not legal(before, letter)
        else:
            self.first = turn
        self.n_turns += turn is not None and turn != self.last
        self.last = turn
        if turn is not None:
            self.least, self.most = turn if self.least is None else self.least, turn
        self.blank += fault == 3
        self.duplicate += fault == 2
        self.truncated += fault == 1
        self.turns.append(4 * letter + min(fault, 2))

    def facts(self):
        return [len(self.turns), self.blank, self.duplicate, self.truncated, self.illegal, self.n_turns, self.least, self.most, self.first, self.last, self.turns[0] // 4, self.turns[-1] // 4]


def legal(before, letter):
    return (before, letter) in {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


RUNS = f"conv_id long, place long, inside boolean, {FACTS}, cost long, audit string, costs array<int>, audits array<string>"


def runs_of(batches):
    """Facts and paths of the runs of a task's sorted turns; only its first and its last run can go on elsewhere."""
    names = [f.split()[0] for f in RUNS.replace("array<int>", "x").replace("array<string>", "x").split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 10, pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string())]
    place = TaskContext.get().partitionId() << 32
    out, run = [], None

    def close(run, part):
        nonlocal place
        if not part:
            cost, audit = whole(bytes(run.turns))
            out.append([run.conv_id, place, True, *run.facts(), cost, audit, None, None])
        else:
            best = chained(bytes(run.turns))
            out.append([run.conv_id, place, False, *run.facts(), None, None, [c for c, _ in best], [a for _, a in best]])
        place += 1

    def flushed():
        columns = list(zip(*out)) if out else [[] for _ in names]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * LONGEST))
    # whether the run began in this task and is not cut
    alone = False
    for batch in batches:
        for conv_id, turn, letter, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if run is None or run.conv_id != conv_id:
                if run is not None:
                    close(run, not alone)
                    alone = True
                run = Run(conv_id)
            elif len(run.turns) == LONGEST:
                close(run, True)
                alone, run = False, Run(conv_id)
            run.add(turn, letter, fault)
        if len(out) >= 2000:
            yield flushed()
    if run is not None:
        close(run, True)
    yield flushed()


SOLVED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def put_together(batches):
    """One row per conversation from its runs in order, which follow each other in the task."""
    kinds = [pa.int64()] * 7 + [pa.string()]
    names = [f.split()[0] for f in SOLVED.split(", ")]
    held, out = [], []

    def close():
        conv_id = held[0]["conv_id"]
        total = lambda c: sum(r[c] for r in held)
        edges = list(zip(held, held[1:]))
        illegal = total("illegal") + sum(not legal(a["last_letter"], b["first_letter"]) for a, b in edges)
        n_turns = total("n_turns") - sum(a["last_turn"] is not None and a["last_turn"] == b["first_turn"] for a, b in edges)
        known = [r for r in held if r["least_turn"] is not None]
        gaps = max(r["most_turn"] for r in known) - min(r["least_turn"] for r in known) + 1 - n_turns if known else 0
        cost, audit = (held[0]["cost"], held[0]["audit"]) if held[0]["inside"] else joined([list(zip(r["costs"], r["audits"])) for r in held])
        out.append([conv_id, gaps, total("blank"), total("duplicate"), total("truncated"), illegal, cost, audit])
        held.clear()

    def flushed():
        columns = list(zip(*out)) if out else [[] for _ in names]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                close()
            held.append(row)
        if len(out) >= 2000:
            yield flushed()
    if held:
        close()
    yield flushed()


def solve(rows):
    """One row for each conversation with rows: its faults, and cost and initials of its cheapest edits (``audit``).

    ``rows`` have conv_id, turn, role and text; a missing role or text is one space, rows without a conv_id are one
    conversation, a missing turn comes first, equal turns go by role and digest, equal rows are duplicates of the first.
    Of a turn's faults the first counts: blank, duplicate (role and text of an earlier one), truncated.  ``gaps`` counts
    the turns missing between the least and the greatest, ``illegal`` neighbours other than su, ua and au.
    """
    ready(rows.sparkSession)
    letter = F.substring("role", 1, 1)
    state = F.when(letter == "s", SYSTEM).when(letter == "u", USER).when(letter == "a", ASSISTANT).otherwise(0)
    # the text ends in a stop, but for blanks behind it
    whole_end = F.col("text").rlike(STOPS + r"[\x20\x09-\x0D]*\z")
    turns = ordered(rows).select(*PLACE, state.alias("letter"), F.col("text").rlike(SHOWN).alias("shown"), whole_end.alias("ends"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(~F.col("shown"), 3).when(F.col("seen") > 1, 2).when(~F.col("ends"), 1).otherwise(0)
    turns = turns.withColumn("seen", seen).select(*PLACE, "letter", fault.alias("fault"))
    sort = [F.col(c).asc_nulls_first() for c in PLACE]
    turns = turns.repartitionByRange(*sort).sortWithinPartitions(*sort).select("conv_id", "turn", "letter", "fault")
    runs = settled(turns.mapInArrow(runs_of, RUNS), "runs")
    # a conversation that lies in one task needs no exchange
    apart = runs.where("not inside").repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place")
    return runs.where("inside").mapInArrow(put_together, SOLVED).unionByName(apart.mapInArrow(put_together, SOLVED))


def repaired(rows, solved):
    """The turns that the edits leave: conv_id, place from 0, role and text; a conversation's rows follow each other in a task.

    Each conversation passes through one task as a sorted stream of which one row at a time is held, beside its edits.
    """
    ready(rows.sparkSession)
    turns = ordered(rows).select(*PLACE, "text", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"))
    edits = solved.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), F.lit("").alias("text"), F.lit(0).alias("kind"), "audit")
    both = edits.unionByName(turns).repartition("conv_id")
    both = both.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "digest")
    return both.select("conv_id", "role", "text", "audit").mapInArrow(edited, "conv_id long, place long, role string, text string")


def edited(batches):
    names = ["conv_id", "place", "role", "text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))

    def conversations():
        head = next(stream, None)
        while head is not None:
            conv_id, _, _, audit = head
            head = None

            def turns():
                nonlocal head
                for row in stream:
                    if row[3] is not None:
                        head = row
                        return
                    yield row[1], row[2]

            own = turns()
            yield from ((conv_id, place, role, text) for place, (role, text) in enumerate(applied(audit, own)))
            for _ in own:
                raise ValueError(f"conversation {conv_id} has more turns than edits")

    held, size = [], 0
    for row in conversations():
        held.append(row)
        size += len(row[3])
        if len(held) >= 1000 or size >= 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def digests(turns):
    """SHA-256 of each conversation's ``role:text`` lines; ``turns`` as ``repaired`` leaves them."""

    def run(batches):
        current, hasher, out = None, None, []
        for batch in batches:
            for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if hasher:
                        out.append((current, hasher.hexdigest()))
                    current, hasher = conv_id, sha256()
                else:
                    hasher.update(b"\n")
                hasher.update(f"{role}:{text}".encode())
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        if hasher:
            out.append((current, hasher.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    names, kinds = ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()]
    return turns.mapInArrow(run, "conv_id long, repaired_sha256 string")


def report(conversations, rows):
    """Faults, edits and digest of every conversation of ``conversations``, of which ``rows`` is what is left.

    A conversation without rows has zeros, no edits and the digest of nothing; an empty table gives an empty report.
    """
    solved = settled(solve(rows), "solved")
    found = digests(repaired(rows, solved))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = ids.join(solved.withColumnRenamed("conv_id", "__solved"), same("conv_id", "__solved"), "left").drop("__solved")
    out = out.join(found.withColumnRenamed("conv_id", "__found"), same("conv_id", "__found"), "left").drop("__found")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
