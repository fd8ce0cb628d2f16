"""Quality scores: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are the words, word pairs, word endings and immediate repeats of the whole text, hashed to SLOTS places; each
text is scaled to length one.  A bounded, hash-chosen sample of the labelled documents is dealt to SHARDS learners; each
makes PASSES over its share, one update per document, and the learners' weights are averaged.  Scoring is a sparse dot
product per document and needs no shuffle.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from parcelry.llm.common import ready, remainder, texts
from parcelry.llm.hashing import Tokens, in_chunks, mixed

SLOTS = 1 << 18
SHARDS = 6
PASSES = 3
#: Weight of a document labelled 0; those labelled 1 are far more.
LOW_WEIGHT = 2.0
#: Labelled documents that are learned from at most; those with the smallest hashes of their ids.
SAMPLE = 20_000


def features(batch, slots=SLOTS):
    """For a list of texts: the number of features of each, and all features in order."""
    tokens = Tokens(batch)
    word, inside = tokens.hash, tokens.text[1:] == tokens.text[:-1]
    pair = mixed(word[1:] * np.uint64(3) + word[:-1])[inside]
    # the last two bytes of a word, and that a word repeats the one before, whatever it is
    ending = mixed(tokens.data[tokens.stop - 1].astype(np.uint64) * np.uint64(256) + tokens.data[tokens.stop - 2])
    again = inside & (word[1:] == word[:-1])
    kinds = [(word, tokens.text), (pair, tokens.text[1:][inside]), (ending, tokens.text), (np.zeros(again.sum(), np.uint64), tokens.text[1:][again])]
    at = (np.concatenate([k for k, _ in kinds]) >> np.uint64(40)).astype(np.int64) % slots
    text = np.concatenate([t for _, t in kinds])
    total = np.bincount(text, minlength=len(batch))
    order = np.argsort(text, kind="stable")
    return total, at[order]


def each(total, at):
    """Distinct features and their scaled counts, text by text."""
    edges = np.r_[0, np.cumsum(total)]
    for a, b in zip(edges[:-1], edges[1:]):
        slot, count = np.unique(at[a:b], return_counts=True)
        value = np.log1p(count)
        yield slot, value / max(np.sqrt(np.dot(value, value)), 1e-9)


class Learner:
    """Follow the regularised leader, one coordinate-wise step per document; the last slot is the constant."""

    def __init__(self, slots=SLOTS, rate=0.5, smooth=1.0, l1=0.02, l2=0.2):
        self.z, self.n = np.zeros(slots + 1), np.zeros(slots + 1)
        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2

    def weights(self, at=slice(None)):
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.smooth + np.sqrt(n)) / self.rate + self.l2))

    def learn(self, slot, value, label):
        slot, value = np.r_[slot, len(self.z) - 1], np.r_[value, 0.3]
        w = self.weights(slot)
        g = (1 / (1 + np.exp(-np.dot(w, value))) - label) * value * (1.0 if label else LOW_WEIGHT)
        n = self.n[slot]
        self.z[slot] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.rate * w
        self.n[slot] = n + g * g


def train(docs, labels, holdout=5, sample=SAMPLE, slots=SLOTS):
    """Weights from labelled documents; ids whose crc32 modulo ``holdout`` is 0 are never learned from.

    Missing texts count as empty, missing labels are left out, a repeated label row is learned again.  Without any label
    all weights are zero.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", holdout) != 0))
    # at most ``sample`` rows, so this side may be broadcast
    chosen = F.broadcast(known.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample))
    rows = texts(docs).join(chosen, "doc_id").select("doc_id", F.col("text").cast("binary").alias("text"), "quality", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(SHARDS)).cast("int").alias("shard"))

    def learn(table):
        order = np.argsort(mixed(table.column("doc_id").to_numpy().astype(np.uint64)), kind="stable")
        text, label = table.column("text").to_pylist(), table.column("quality").to_numpy()
        learner = Learner(slots)
        seen = {}
        for _ in range(PASSES):
            for s in range(0, len(order), 64):
                mine = order[s : s + 64]
                if s not in seen:
                    seen[s] = [(a.astype(np.int32), v.astype(np.float32)) for a, v in each(*features([text[k] for k in mine], slots))]
                for k, (slot, value) in zip(mine, seen[s]):
                    learner.learn(slot, value, label[k])
        return pa.table({"weights": [learner.weights().astype("<f4").tobytes()], "n": [len(order)]})

    parts = rows.groupBy("shard").applyInArrow(learn, "weights binary, n long").collect()  # SHARDS rows of fixed size
    total = sum(r["n"] for r in parts)
    return sum((np.frombuffer(r["weights"], "<f4") * (r["n"] / total) for r in parts), np.zeros(slots + 1)).astype(np.float32)


def with_score(docs, weights):
    """``docs`` with ``score`` (0 to 1) of each row's whole ``text``; missing and empty texts get the score of no feature."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(weights)
    slots = len(weights) - 1

    @F.pandas_udf("double")
    def scores(text: pd.Series) -> pd.Series:
        w, data, out = shared.value, [x or b"" for x in text], []
        for s in in_chunks(data):
            for slot, value in each(*features(data[s], slots)):
                out.append(float(w[slots]) * 0.3 + float(np.dot(w[slot], value)))
        return pd.Series(1 / (1 + np.exp(-np.array(out, float))))

    return docs.withColumn("score", scores(F.col("text").cast("binary")))


def score(docs, weights):
    """``doc_id`` and ``score`` of each document."""
    return with_score(docs.select("doc_id", "text"), weights).select("doc_id", "score")
