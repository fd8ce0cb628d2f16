"""Language-model scores by logistic context mixing.

A text is a row of tokens, words and one end.  Words are spelled byte by byte and closed by a terminator; each byte is a
path in a code tree, so a word is a row of bits.  For each bit, ORDERS bit predictors look up how often 0 and 1 came in
their context before: the last 1, 2 and 3 bytes of the word, the last 5 of the text, and the word so far.  A logistic mixer adds their stretched
predictions with weights that a gate chooses by how much the longer contexts have seen; the weights are learned online, and
a last table, by tree node and prediction, corrects what the mixer tends to get wrong.

The order of 5 crosses the border of a word: its first HEAD bytes are predicted from the blank before it and from the end of the
word before as well.  Each of them depends on the REACH bytes before it and on nothing else, so everything about them is learned and
scored once per distinct window of REACH bytes and the byte that follows.  Later bytes depend on their own word alone and are learned and
scored once per distinct word.  Predictors count all windows and words of all training documents into hashed tables of fixed
size.  The mixer learns from the same windows and words with the occurrence at hand taken out of the counts, as if it were
new.  Scores are frozen: a text's score depends on no other text that is scored.
"""

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from parcelry.llm.common import ready, remainder, settled, texts
from parcelry.llm.hashing import Powers, Tokens, in_chunks, mixed

ORDERS = (1, 2, 3, 5, None)
#: log2 of the slots of each order's table.
SLOT_BITS = (18, 20, 20, 22, 22)
SLICE = 1 << 16
ENOUGH = 65_535
GATES = 48
BUCKETS = 24
STOP = 256
#: The order that crosses a word's border, and how many bytes of a word so see the word before it.
REACH = max(order for order in ORDERS if order)
HEAD = REACH - 1
PAD = 0x20
#: The end of a text as a word: no word holds a blank byte.
END = b"\n"
END_HASH = 1
WORDS_A_STEP = 2000
#: Words of a learner's shard that are wanted, and the fewest shards. Both words of a shard and their order follow from a hash.
WORDS_A_PART, LEAST_PARTS = 500_000, 4
#: A word with at least this fraction of all tokens is looked up in a broadcast table, which so has 2^22 rows at most.
FREQUENT = 1 / (1 << 22)
RATE = 0.15
#: Windows that a counting task holds, windows priced at once, and log2 of those whose price a worker keeps.
HELD, WINDOWS_A_STEP, KEPT_BITS = 1 << 20, 20_000, 21


class Code:
    """A prefix code over 256 bytes and the terminator: bits and tree nodes of each."""

    def __init__(self, counts):
        heap = [(int(n) + 1, s, (s,)) for s, n in enumerate(counts)]
        heapq.heapify(heap)
        paths, node = {s: [] for s in range(len(counts))}, 0
        while len(heap) > 1:
            (a, i, left), (b, j, right) = heapq.heappop(heap), heapq.heappop(heap)
            for bit, side in enumerate((left, right)):
                for s in side:
                    paths[s].append((node, bit))
            node += 1
            heapq.heappush(heap, (a + b, min(i, j), left + right))
        self.size = np.array([len(paths[s]) for s in range(len(counts))])
        self.node = np.zeros((len(counts), self.size.max()), np.int64)
        self.bit = np.zeros((len(counts), self.size.max()), np.int8)
        for s, path in paths.items():
            for k, (n, b) in enumerate(reversed(path)):
                self.node[s, k], self.bit[s, k] = n, b


def coded(flat, at, place, symbol, code):
    """All bits of some symbols: slot in each order's table, tree node, bit, and the symbol of each.

    ``at`` is where each symbol stands in ``flat``, with REACH bytes of context before it, and ``place`` is its place in its word.
    """
    size = code.size[symbol]
    of = np.repeat(np.arange(len(at)), size)
    step = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    node, bit = code.node[symbol[of], step], code.bit[symbol[of], step]
    spread = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    Powers.reach(len(flat))
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum((flat + np.uint64(1)) * Powers.up[: len(flat)])]
    slots = []
    for k, order in enumerate(ORDERS):
        reach = np.full(len(at), REACH) if order == REACH else place if order is None else np.minimum(place, order)
        since = at - reach
        context = mixed((sums[at] - sums[since]) * Powers.down[since] + (reach + 64 * k + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        slots.append((((context[of] + spread) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - SLOT_BITS[k])).astype(np.int64))
    return slots, node, bit, of


def bits_of(words, code, before=None, first=0):
    """All bits of some words from place ``first`` on: slot in each order's table, tree node, bit, and the word of each.

    ``before`` are the words before them; without it, each word is the first of a text, which stands behind the end of another.
    """
    if before is None:
        lead = (bytes([PAD]) * HEAD + END)[-HEAD:] + bytes([PAD])
        data = lead + (b"\0" + lead).join(words) + b"\0"
    else:
        data = b"".join((bytes([PAD]) * HEAD + b)[-HEAD:] + bytes([PAD]) + w + b"\0" for b, w in zip(before, words)) + b"\0"
    flat = np.frombuffer(data, np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = place + np.repeat(np.cumsum(sizes + REACH) - sizes, sizes)
    symbol = flat[at].astype(np.int64)
    symbol[np.cumsum(sizes) - 1] = STOP
    kept = place >= first
    slots, node, bit, of = coded(flat, at[kept], place[kept], symbol[kept], code)
    return slots, node, bit, word[kept][of]


def windows_of(tokens, n_texts):
    """The windows of the first HEAD places of all words and of the texts' ends, place by place: (keys, text of each).

    A key is the place and, without the blank between the words, the REACH bytes that end with the one at the place. The word
    before is padded in front and a word that ends early behind, both with the blank, which no word holds; so a window that ends
    with it is that of the terminator.
    """
    size, last = tokens.stop - tokens.start, len(tokens.data) - 1
    tail, head = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    for k in range(HEAD):
        tail = tail << np.uint64(8) | np.where(size >= HEAD - k, tokens.data[np.maximum(tokens.stop - HEAD + k, 0)], PAD).astype(np.uint64)
        head = head << np.uint64(8) | np.where(size > k, tokens.data[np.minimum(tokens.start + k, last)], PAD).astype(np.uint64)
    start, end = np.uint64(int.from_bytes((bytes([PAD]) * HEAD + END)[-HEAD:])), np.uint64(int.from_bytes((END + bytes([PAD]) * HEAD)[:HEAD]))
    filled = np.diff(tokens.first) > 0
    before, closing = np.r_[start, tail[:-1]][: len(tail)], np.full(n_texts, start)
    before[tokens.first[:-1][filled]] = start
    closing[filled] = tail[tokens.first[1:][filled] - 1]
    both = np.r_[before, closing] << np.uint64(8 * HEAD) | np.r_[head, np.full(n_texts, end)]
    text = np.r_[tokens.text, np.arange(n_texts)]
    for k in range(HEAD):
        if k:
            open_ = both >> np.uint64(8 * (HEAD - k)) & np.uint64(255) != PAD
            both, text = both[open_], text[open_]
        yield both >> np.uint64(8 * (HEAD - 1 - k)) & np.uint64((1 << 8 * REACH) - 1) | np.uint64(k << 8 * REACH), text


def bits_of_windows(keys, code):
    """All bits of the last symbols of some windows: slot in each order's table, tree node, bit, and the window of each."""
    place = (keys >> np.uint64(8 * REACH)).astype(np.int64)
    data = keys[:, None] >> np.arange(8 * HEAD, -1, -8).astype(np.uint64) & np.uint64(255)
    column, blank = np.arange(REACH + 1), (HEAD - place)[:, None]
    flat = np.where(column < blank, data[:, np.minimum(column, HEAD)], np.where(column == blank, np.uint64(PAD), data[:, np.maximum(column - 1, 0)]))
    symbol = flat[:, REACH].astype(np.int64)
    symbol[symbol == PAD] = STOP
    return coded(flat.ravel(), np.arange(len(keys)) * (REACH + 1) + REACH, place, symbol, code)


def stretch(p):
    return np.log(p / (1 - p))


def squash(x):
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


class Mixer:
    def __init__(self, code, tables):
        """tables: for each order, how often 0 and 1 came in each slot, two columns."""
        self.code, self.tables, self.kept = code, tables, None
        self.weights = np.tile([0.1, 0.1, 0.2, 0.3, 0.6], (GATES, 1))
        self.bend = np.full((GATES, len(ORDERS)), 50.0)
        self.fix = np.zeros((257, BUCKETS, 2))

    def inputs(self, slots, bit=None):
        """Stretched predictions, and the gate. With the bits given, each bit's own occurrence is taken out of the counts."""
        x, seen = np.empty((len(ORDERS), len(slots[0])), np.float32), []
        for k, slot in enumerate(slots):
            n = self.tables[k][slot].astype(np.float32)
            zero, one = n[:, 0], n[:, 1]
            if bit is not None:
                one -= bit
                zero -= 1 - bit
                np.maximum(one, 0, out=one)
                np.maximum(zero, 0, out=zero)
            total = zero + one
            x[k] = np.log((one + 0.3) / (zero + 0.3))
            seen.append(total)
        level = lambda n, *steps: sum((n > a).astype(np.int64) for a in steps)
        return x, level(seen[-1], 0, 1, 3, 8, 50) * 8 + level(seen[-2], 0, 3, 50) * 2 + (seen[-3] > 3)

    def mix(self, x, gate):
        w = self.weights[gate]
        return squash(sum(w[:, k] * x[k] for k in range(len(ORDERS))))

    def learn(self, words, weight, windows, window_weight, rate):
        parts = [(bits_of(words, self.code, first=HEAD), weight), (bits_of_windows(windows, self.code), window_weight)]
        slots = [np.concatenate(s) for s in zip(*(bits[0] for bits, _ in parts))]
        node, bit = (np.concatenate([bits[k] for bits, _ in parts]) for k in (1, 2))
        each = np.concatenate([w[bits[3]] for bits, w in parts])
        x, gate = self.inputs(slots, bit)
        p = self.mix(x, gate)
        err = (bit - p) * each
        curve = p * (1 - p) * each
        for k in range(len(ORDERS)):
            # steps are measured by how sharply the loss bends lately
            self.bend[:, k] = 0.9 * self.bend[:, k] + np.bincount(gate, curve * x[k] ** 2, GATES)
            self.weights[:, k] += rate * np.bincount(gate, err * x[k], GATES) / self.bend[:, k]
        np.clip(self.weights, -1, 3, out=self.weights)
        cell = node * BUCKETS + self.bucket(p)
        self.fix += np.stack([np.bincount(cell, each * (1 - bit), 257 * BUCKETS), np.bincount(cell, each * bit, 257 * BUCKETS)], axis=1).reshape(257, BUCKETS, 2)

    @staticmethod
    def bucket(p):
        return np.clip((stretch(p) + 12) * (BUCKETS / 24), 0, BUCKETS - 1).astype(np.int64)

    def log10(self, words, before=None, first=0):
        """log10 probability of each word, from place ``first`` on, after the words ``before``."""
        return self.sums(bits_of(words, self.code, before, first), len(words))

    def log10_windows(self, keys):
        """log10 probability of the last symbol of each window."""
        return self.sums(bits_of_windows(keys, self.code), len(keys))

    def prices(self):
        """Prices of windows, kept for all tasks of a worker."""
        if self.kept is None:
            self.kept = Prices(self)
        return self.kept

    def sums(self, bits, n_units):
        slots, node, bit, unit = bits
        p = self.mix(*self.inputs(slots))
        n = self.fix[node, self.bucket(p)]
        # the table is trusted by how much it has seen
        p = (p * 8 + n[:, 1]) / (8 + n.sum(axis=1)) * 0.5 + p * 0.5
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return np.bincount(unit, np.log10(np.where(bit == 1, p, 1 - p)), n_units)


class Prices:
    """The mixer's prices of windows. Each kept one stands at the first of its two places if that was free, else at the second."""

    def __init__(self, mixer):
        self.mixer, self.keys, self.found = mixer, np.full(1 << KEPT_BITS, ~np.uint64(0)), np.zeros(1 << KEPT_BITS)

    def places(self, keys):
        h = mixed(keys)
        return h >> np.uint64(64 - KEPT_BITS), h & np.uint64((1 << KEPT_BITS) - 1)

    def of(self, keys):
        first, second = self.places(keys)
        found, new = self.found[first], np.flatnonzero(self.keys[first] != keys)
        found[new] = self.found[second[new]]
        new = new[self.keys[second[new]] != keys[new]]
        if len(new):
            some, like = np.unique(keys[new], return_inverse=True)
            price = np.concatenate([self.mixer.log10_windows(some[a : a + WINDOWS_A_STEP]) for a in range(0, len(some), WINDOWS_A_STEP)])
            found[new] = price[like]
            first, second = self.places(some)
            free = self.keys[first] == ~np.uint64(0)
            self.keys[first[free]], self.found[first[free]] = some[free], price[free]
            left = self.keys[first] != some
            self.keys[second[left]], self.found[second[left]] = some[left], price[left]
        return found


def unit_table(docs, holdout):
    """Each distinct word with its number of occurrences in training documents (``c``) and in all (``c_all``), and each distinct
    window of training documents (``key``, the word is null) with its number there (``c``).
    """
    rows = texts(docs).select(F.coalesce(remainder("doc_id", holdout) != 0, F.lit(True)).alias("train"), F.col("text").cast("binary").alias("text"))

    def tally(batches):
        held = {True: Counter(), False: Counter()}

        def rows_of():
            for train, counts in held.items():
                words, n = list(counts), pa.array(list(counts.values()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.nulls(len(words), pa.int64()), n if train else pa.array([0] * len(words), pa.int64()), n], names=["word", "key", "c", "c_all"])
                counts.clear()

        def window_rows(keys, n):
            return pa.RecordBatch.from_arrays([pa.nulls(len(keys), pa.binary()), pa.array(keys.view(np.int64)), pa.array(n), pa.array(np.zeros(len(n), np.int64))], names=["word", "key", "c", "c_all"])

        def merged(parts):
            keys, like = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(like, np.concatenate([n for _, n in parts])).astype(np.int64)

        seen, size = [], 0
        for batch in batches:
            learned = []
            for train, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = held[train]
                counts.update(text.lower().split())
                counts[END] += 1
                if train:
                    learned.append(text)
            if len(held[True]) + len(held[False]) > 400_000:
                yield from rows_of()
            for s in in_chunks(learned):
                seen.append(np.unique(np.concatenate([k for k, _ in windows_of(Tokens(learned[s]), s.stop - s.start)]), return_counts=True))
                size += len(seen[-1][0])
                if size > HELD:
                    seen = [merged(seen)]
                    size = len(seen[0][0])
                    if size > HELD // 2:
                        yield window_rows(*seen.pop())
                        size = 0
        yield from rows_of()
        if seen:
            yield window_rows(*merged(seen))

    return rows.mapInArrow(tally, "word binary, key long, c long, c_all long").groupBy("word", "key").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def units_of(batch):
    """Words and their counts, windows and their counts of a batch with ``word``, ``key`` and ``c``."""
    is_word = batch.column(0).is_valid()
    words, windows = batch.filter(is_word), batch.filter(pc.invert(is_word))
    return words.column(0).to_pylist(), words.column(2).to_numpy(), windows.column(1).to_numpy().view(np.uint64), windows.column(2).to_numpy()


def in_steps(batches, size=WORDS_A_STEP):
    for batch in batches:
        for a in range(0, batch.num_rows, size):
            yield batch.slice(a, size)


def train(units, n_parts):
    """A mixer from the stored table of words and windows. What reaches the driver has a fixed size: tables, weights, corrections.

    Counts are whole numbers, so they do not depend on the order in which tasks add them up; each learner takes the words and windows
    of one hash shard in the order of their hashes, and the learners are averaged by their numbers in the order of the shards.  So
    the model is the same under any partitioning of the table.
    """
    context = units.sparkSession.sparkContext
    known = units.where("c > 0").select("word", "key", "c")

    def bytes_seen(batches):
        total = np.zeros(257)
        for batch in in_steps(batches, 50_000):
            data, n = batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float)
            total[:256] += np.bincount(np.frombuffer(b"".join(data), np.uint8), np.repeat(n, [len(w) for w in data]), 256)
            total[256] += n.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(257)), pa.array(total)], names=["byte", "n"])

    seen = known.where("key is null").select("word", "c").mapInArrow(bytes_seen, "byte long, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(257)
    for r in seen:
        counts[r["byte"]] = r["n"]
    code = Code(counts)

    def count_bits(batches):
        tables = [np.zeros(2 << n, np.int64) for n in SLOT_BITS]
        for batch in in_steps(batches):
            words, c, windows, window_c = units_of(batch)
            for (slots, _, bit, unit), n in ((bits_of(words, code, first=HEAD), c), (bits_of_windows(windows, code), window_c)):
                weight = n[unit]
                for table, slot in zip(tables, slots):
                    np.add.at(table, slot * 2 + bit, weight)
        for k, table in enumerate(tables):
            for a in range(0, len(table), SLICE):
                at = np.flatnonzero(table[a : a + SLICE])
                if len(at):
                    n = np.minimum(table[a : a + SLICE][at], 4e9)
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([a]), pa.array([at.astype("<u2").tobytes()]), pa.array([n.astype("<u4").tobytes()])], names=["k", "a", "at", "n"])

    def add(table):
        total = np.zeros(SLICE)
        for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist()):
            total[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<u4")
        pair = total.reshape(-1, 2)
        most = pair.max(axis=1, keepdims=True)
        pair = np.where(most > ENOUGH, pair * (ENOUGH / np.maximum(most, 1)), pair)
        return pa.table({"k": table.column("k")[:1], "a": table.column("a")[:1], "n": pa.array([np.minimum(np.ceil(pair), ENOUGH).astype("<u2").tobytes()])})

    parts = known.mapInArrow(count_bits, "k long, a long, at binary, n binary").groupBy("k", "a").applyInArrow(add, "k long, a long, n binary").toArrow()
    tables = [np.zeros(2 << n, np.uint16) for n in SLOT_BITS]
    for k, a, n in zip(*(parts.column(c).to_pylist() for c in ("k", "a", "n"))):
        tables[k][a : a + SLICE] = np.frombuffer(n, "<u2")
    mixer = Mixer(code, [x.reshape(-1, 2) for x in tables])
    shared = context.broadcast(mixer)

    def learn(batches):
        shard, own, seen, held = None, None, 0, ([], [], [], [])

        def step():
            """Steps have the same words and windows however the batches are cut."""
            nonlocal seen
            n = len(held[0]) + len(held[2])
            if n:
                own.learn(held[0], np.array(held[1], float), np.array(held[2], np.uint64), np.array(held[3], float), RATE / (1 + seen / 200_000) ** 0.5)
                seen += n
                for x in held:
                    x.clear()

        def done():
            step()
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([own.weights.tobytes()]), pa.array([own.fix.tobytes()]), pa.array([seen])], names=["shard", "weights", "fix", "n"])

        for batch in batches:
            for word, key, n, k in zip(*(c.to_pylist() for c in batch.columns)):
                if k != shard:
                    if own:
                        yield done()
                    shard, own, seen = k, Mixer(shared.value.code, shared.value.tables), 0
                unit = 0 if key is None else 2
                held[unit].append(word if key is None else key)
                held[unit + 1].append(n)
                if len(held[0]) + len(held[2]) == WORDS_A_STEP:
                    step()
        if own:
            yield done()

    order = F.xxhash64("word", "key")
    dealt = known.withColumn("shard", F.pmod(order, F.lit(n_parts))).repartition(n_parts, "shard").sortWithinPartitions("shard", order, "word", "key")
    learned = sorted(dealt.select("word", "key", "c", "shard").mapInArrow(learn, "shard long, weights binary, fix binary, n long").collect(), key=lambda r: r["shard"])
    total = sum(r["n"] for r in learned)
    if total:
        mixer.weights = sum(np.frombuffer(r["weights"]).reshape(GATES, -1) * (r["n"] / total) for r in learned)
        mixer.fix = sum(np.frombuffer(r["fix"]).reshape(257, BUCKETS, 2) for r in learned)
    shared.unpersist()
    return context.broadcast(mixer)


def score_words(words, mixer):
    """``hash``, ``c``, ``c_all`` and ``spelled`` (log10 probability behind the first HEAD bytes) of each word of the table."""

    def run(batches):
        for batch in in_steps(batches):
            data = batch.column(0).to_pylist()
            hashes = Tokens([b" ".join(data)]).hash if END not in data else np.array([END_HASH if w == END else Tokens([w]).hash[0] for w in data], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column(1), batch.column(2), pa.array(mixer.value.log10(data, first=HEAD))], names=["hash", "c", "c_all", "spelled"])

    return words.mapInArrow(run, "hash long, c long, c_all long, spelled double")


def score(docs, holdout=10):
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte`` of each document's whole text.

    Bits per byte are the score's bits by the bytes of the text in UTF-8; an empty text counts as one byte.

    Documents whose id's crc32 modulo ``holdout`` is 0 are not learned from.  A missing text is empty and has only its end.
    Repeated rows are counted and scored each; without training documents every bit has probability one half.
    """
    spark = ready(docs.sparkSession)
    units = settled(unit_table(docs, holdout), "units")
    words = units.where("key is null").select("word", "c", "c_all")
    n, v, n_all = words.select(F.sum("c"), F.sum((F.col("c") > 0).cast("long")), F.sum("c_all")).first()
    n, v, n_all = n or 0, v or 0, n_all or 0
    mixer = train(units, max(LEAST_PARTS, -(-units.count() // WORDS_A_PART)))
    scored = settled(score_words(words, mixer), "scored")
    spread = n + 0.1 * (v + 1)
    # at most 1 / FREQUENT rows of three numbers
    frequent = F.col("c_all") >= F.lit(max(2.0, n_all * FREQUENT))
    head = scored.where(frequent).select("hash", "c", "spelled").toArrow()
    by = np.argsort(head.column("hash").to_numpy().view(np.uint64))
    known = spark.sparkContext.broadcast(tuple(head.column(c).to_numpy()[by] for c in ("hash", "c", "spelled")))
    keys = "doc_id long, key long, hash long, times long, n_tokens long, n_known long, base double, spelled double, n_bytes long"
    names = [x.split()[0] for x in keys.split(", ")]

    def run(batches):
        part, row = TaskContext.get().partitionId() << 40, 0
        hashes, c, spelled = known.value
        hashes = hashes.view(np.uint64)
        base = np.log10((c + 0.1) / spread)
        prices = mixer.value.prices()
        for batch in batches:
            ids, data = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s in in_chunks(data):
                tokens, m = Tokens(data[s]), s.stop - s.start
                word, text = np.r_[tokens.hash, np.full(m, END_HASH, np.uint64)], np.r_[tokens.text, np.arange(m)]
                at = np.minimum(np.searchsorted(hashes, word), max(len(hashes) - 1, 0))
                hit = hashes[at] == word if len(hashes) else np.zeros(len(word), bool)
                sums = [np.bincount(text[hit], x[at[hit]], m) if len(x) else np.zeros(m) for x in ((c > 0).astype(float), base, spelled)]
                for keys, owner in windows_of(tokens, m):
                    sums[2] += np.bincount(owner, prices.of(keys), m)
                count = np.bincount(text, minlength=m)
                key = part + row + np.arange(m)
                row += m
                # the document's row, then a row for each distinct rare word of it
                pair = np.stack([text[~hit].astype(np.uint64), word[~hit]], axis=1)
                order = np.lexsort((pair[:, 1], pair[:, 0]))
                pair = pair[order]
                edge = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]).any(axis=1)][: len(pair)])
                times = np.diff(np.r_[edge, len(pair)])
                rare, none = len(edge), [None]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[s] + none * rare, pa.int64()),
                        pa.array(np.r_[key, key[pair[edge, 0].astype(np.int64)]]),
                        pa.array(none * m + pair[edge, 1].view(np.int64).tolist(), pa.int64()),
                        pa.array(np.r_[np.zeros(m, np.int64), times]),
                        pa.array(np.r_[count, np.zeros(rare, np.int64)]),
                        pa.array(np.r_[np.round(sums[0]).astype(np.int64), np.zeros(rare, np.int64)]),
                        pa.array(np.r_[sums[1], np.zeros(rare)]),
                        pa.array(np.r_[sums[2], np.zeros(rare)]),
                        pa.array(np.r_[np.array([len(t) for t in data[s]], np.int64), np.zeros(rare, np.int64)]),
                    ],
                    names=names,
                )

    rows = settled(texts(docs).select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, keys), "tokens")
    tail = rows.where("hash is not null").select("key", "hash", "times").join(scored.select("hash", "c", F.col("spelled").alias("bits")), "hash")
    base = F.log10((F.col("c") + 0.1) / F.lit(spread))
    zero = F.lit(0).cast("long")
    parts = rows.where("hash is null").select("key", "doc_id", F.lit(True).alias("whole"), "n_tokens", "n_known", "base", "spelled", "n_bytes").union(
        tail.select("key", F.lit(None).cast("long"), F.lit(None).cast("boolean"), zero, F.when(F.col("c") > 0, F.col("times")).otherwise(zero), F.col("times") * base, F.col("times") * F.col("bits"), zero)
    )
    summed = parts.groupBy("key").agg(F.max("doc_id").alias("doc_id"), *(F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "spelled", "n_bytes")))
    return summed.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("spelled").alias("score"), (F.col("spelled") / F.lit(-np.log10(2.0).item()) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
