"""Byte-pair encoding and decoding with a token automaton.

The automaton starts with one state that has an arc to itself for each byte.  Each merge (a, b) applies one gadget:
the state that arcs labelled ``a`` lead to is split, its copy loses the arc ``b``, the ``a`` arcs lead to the copy, and
an arc labelled ``ab`` leads to where ``b`` led.  A token string is a path of the finished automaton exactly if it is
what the merges make of its bytes, so each text has one path.

A copy differs from its original by one missing arc, so the states are kept as what was cut, and when: ``cuts[a, b]`` is
the number of the gadget that took arc ``b`` from the state behind ``a``.  The state behind a merged label is the one
its right part had at that time, and a merged arc leaves a state if its left part did at that time; so an entry of the
transition table is found by looking up the right parts of the one label against the left parts of the other.  Entries met
once stay in the table.

A word is read from left to right without going back: the path that spells its first bytes is unique and its last label is
the state, so of the labels that end at the next byte just one has an arc from the state where it begins.
"""

import json
import re
from array import array

import pyarrow as pa
import regex
from pyspark.sql import functions as F

from parcelry.llm.common import ready, texts

#: Fixed value: how the byte-level vocabularies split a text before the merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
NEVER = 1 << 60
CACHED_WORDS = 150_000
CACHED_ARCS = 1_000_000


def byte_alphabet():
    """The printable stand-in of each byte in a byte-level vocabulary: itself where printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Recent(dict):
    """What ``make`` gives for a key, kept for the keys met lately: at most two generations of ``size``."""

    def __init__(self, make, size=CACHED_WORDS):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Automaton:
    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocabulary = spec["model"]["vocab"]
        self.labels = [b""] * (1 + max([*vocabulary.values(), *(x["id"] for x in spec["added_tokens"])]))
        for token, i in vocabulary.items():
            self.labels[i] = bytes(alphabet[c] for c in token)
        self.added = {}
        for x in spec["added_tokens"]:
            if x["lstrip"] or x["rstrip"] or x["single_word"]:
                raise ValueError(f"added token {x['content']!r} takes its surroundings, which is not supported")
            self.labels[x["id"]] = x["content"].encode()
            self.added[x["content"]] = x["id"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.compile([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges], [vocabulary[c] for c in alphabet])

    def compile(self, merges, singles):
        size = len(self.labels)
        self.left, self.right, self.born = [-1] * size, [-1] * size, [NEVER] * size
        self.cuts = {}
        alive = set(singles)
        for k, (a, b, ab) in enumerate(merges):
            if a in alive and b in alive and ab not in alive and self.follows(a, b):
                self.left[ab], self.right[ab], self.born[ab] = a, b, k
                self.cuts[a << 20 | b] = k
                alive.add(ab)
        self.index = {self.labels[i]: i for i in alive}
        #: What a label can end with: from a byte on backwards, labels are tried as long as one can still be met.
        self.ends = {label[k:]: -1 for label in self.index for k in range(len(label))} | self.index

    def follows(self, u, v):
        """Whether the state behind arcs ``u`` has an arc ``v``."""
        left, right, born, cut = self.left, self.right, self.born, self.cuts.get
        y, until = u, NEVER
        while y >= 0:
            x, before = v, NEVER
            while x >= 0:
                k = cut(y << 20 | x)
                if k is not None and k < until and k <= before:
                    return False
                x, before = left[x], born[x]
            y, until = right[y], born[y]
        return True

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in {"arcs", "words", "tokens", "pattern", "odd", "marks"}}

    def start(self):
        """Tables that fill while texts are encoded; each worker has its own."""
        if "words" not in self.__dict__:
            self.arcs = {}
            self.tokens = Recent(lambda word: array("I", self.walk(word.encode())).tobytes())
            self.words = Recent(lambda piece: self.split_and_walk(" " + piece))
            self.pattern, self.odd = regex.compile(SPLIT), re.compile(r" (?:\s|\Z)")
            self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        return self

    def walk(self, word):
        """Labels of the one path that spells ``word``, found from its first byte to its last.

        The state after each byte is the last label of the path that spells the bytes so far, which is unique; so of all
        labels that end here just one has an arc from the state where it begins.
        """
        whole = self.index.get(word)
        if whole is not None:
            return [whole]
        ends, arcs, n = self.ends.get, self.arcs.get, len(word)
        state = [-1] * (n + 1)
        for i in range(1, n + 1):
            for k in range(i - 1, -1, -1):
                label = ends(word[k:i])
                if label is None:
                    raise ValueError(f"no path spells {word[:i]!r}")
                if label >= 0:
                    last = state[k]
                    if last < 0 or (arcs(last << 20 | label) or self.arc(last, label)) > 0:
                        state[i] = label
                        break
        path, i = [], n
        while i:
            path.append(state[i])
            i -= len(self.labels[state[i]])
        path.reverse()
        return path

    def arc(self, last, label):
        """1 if an arc ``label`` leaves the state behind ``last``, else -1; kept in the table of arcs."""
        known = self.arcs.get(last << 20 | label)
        if known is None:
            if len(self.arcs) >= CACHED_ARCS:
                self.arcs.clear()
            known = self.arcs[last << 20 | label] = 1 if self.follows(last, label) else -1
        return known

    def split_and_walk(self, text):
        return b"".join(map(self.tokens.__getitem__, self.pattern.findall(text)))

    def plain(self, text):
        """Ids of a text without added tokens. A blank before a non-blank always begins a word, so pieces between blanks can be looked up."""
        if self.odd.search(text):
            return self.split_and_walk(text)
        first, *rest = text.split(" ")
        return self.split_and_walk(first) + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text):
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        self.start()
        if self.marks is None or not any(x in text for x in self.added):
            return self.plain(text)
        parts = self.marks.split(text)
        return b"".join(array("I", [self.added[x]]).tobytes() if k % 2 else self.plain(x) for k, x in enumerate(parts) if x)

    def decode(self, ids):
        """The labels along a path, joined; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, array("I", ids))).decode("utf-8", "replace")


def shared_automaton(spark, path):
    """The automaton compiled once and broadcast; its size is that of the vocabulary."""
    return ready(spark).sparkContext.broadcast(Automaton(path))


def encode(docs, automaton):
    """``doc_id`` and ``ids`` (binary, little-endian unsigned 32-bit integers) of each document's whole ``text``.

    A missing or empty text has no ids; repeated rows stay; other columns are not looked at; an empty table gives an
    empty table.  Added tokens in a text become their ids.  Map only: nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            encoder = automaton.value
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([encoder.encode(t) for t in batch.column(1).to_pylist()], pa.binary())], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(tokens, automaton):
    """``doc_id``, ``ids`` and ``decoded``, the text of ``ids``; missing ids give the empty text."""

    def run(batches):
        for batch in batches:
            decoder = automaton.value
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([decoder.decode(x) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", F.coalesce(F.col("ids"), F.lit(b"")).alias("ids")).mapInArrow(run, "doc_id long, ids binary, decoded string")
