"""Language of each span of a text: scripts narrow the candidates, word scores decide, a switching penalty smooths.

Learned from all labelled documents: how often each hashed byte n-gram of words occurs in each language, and how often
words of each script do.  A word's script comes from the range of its first character outside ASCII, or is Latin; only
languages in which at least RARE of all words have that script are candidates for it.  A word's score is the log
probability of its n-grams, for each candidate.  Viterbi over the words, with a penalty for each change of language, labels
every word; runs of one label are the spans, and the language with most bytes is the document's.
"""

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from parcelry.llm.common import ready, remainder, settled
from parcelry.llm.hashing import Tokens, in_chunks, mixed

SLOTS = 1 << 16
RARE = 0.001
#: Words whose scores a worker keeps, and languages that a model may have: it has a float for each slot of each.
KNOWN = 1 << 17
LANGUAGES = 512
#: Words of a run that is labelled beside others, and the most languages for which runs start from all of them.
SPAN, SIDE_BY_SIDE = 256, 16
SWITCH = 8.0

#: First code points of the ranges of scripts, in Unicode's order. Others go with the range before them.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0E00, "thai"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x3040, "kana"), (0x3400, "han"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "other"), (0x20000, "han"),
]
NAMES = sorted({name for _, name in SCRIPTS})


def scripts_of(tokens):
    """For each word, the place of its script in NAMES."""
    data = tokens.data.astype(np.int64)
    lead = np.flatnonzero(data >= 0xC0)
    after = np.r_[data, 0, 0, 0]
    two, three, four = ((after[lead + k] & 0x3F) for k in (1, 2, 3))
    head = data[lead]
    point = np.where(head < 0xE0, (head & 0x1F) << 6 | two, np.where(head < 0xF0, (head & 0x0F) << 12 | two << 6 | three, (head & 0x07) << 18 | two << 12 | three << 6 | four))
    kind = np.array([NAMES.index(n) for _, n in SCRIPTS])[np.searchsorted([p for p, _ in SCRIPTS], point, "right") - 1]
    first = np.searchsorted(lead, tokens.start)
    found = np.full(len(tokens.start), NAMES.index("latin"))
    has = first < np.searchsorted(lead, tokens.stop)
    found[has] = kind[first[has]]
    return found


class Some:
    """Some of the words of ``tokens``, by their places."""

    def __init__(self, tokens, places):
        self.data, self.start, self.stop, self.hash = tokens.data, tokens.start[places], tokens.stop[places], tokens.hash[places]


def distinct(tokens):
    """One of each distinct word, and for every word the place of its like among them."""
    _, first, like = np.unique(tokens.hash, return_index=True, return_inverse=True)
    return Some(tokens, first), like


class Known:
    """What was found for the words met lately, by their hashes; at most about ``size`` of them."""

    def __init__(self, width, size=KNOWN):
        self.size, self.hash, self.found = size, np.empty(0, np.uint64), np.empty((0, width), np.float32)

    def get(self, words, make):
        """``make`` of each of the distinct ``words``, sorted by hash."""
        at = np.searchsorted(self.hash, words.hash)
        seen = np.zeros(len(at), bool)
        inside = at < len(self.hash)
        seen[inside] = self.hash[at[inside]] == words.hash[inside]
        out = np.empty((len(at), self.found.shape[1]), np.float32)
        out[seen] = self.found[at[seen]]
        new = np.flatnonzero(~seen)
        if len(new):
            out[new] = make(Some(words, new))
            if len(self.hash) + len(new) > self.size:
                self.hash, self.found = words.hash, out
            else:
                # both are sorted, so the new ones are put in between
                self.hash, self.found = np.insert(self.hash, at[new], words.hash[new]), np.insert(self.found, at[new], out[new], axis=0)
        return out


def grams(tokens, slots=SLOTS):
    """Hashed n-grams of 1 to 4 bytes of each word with a blank on either side: (slots, word) of each."""
    n = len(tokens.data)
    size = tokens.stop - tokens.start
    word = np.repeat(np.arange(len(size)), size + 1)
    at = np.arange(len(word)) - np.repeat(np.cumsum(size + 1) - (size + 1), size + 1) + np.repeat(tokens.start, size + 1)
    # the grams that end at each byte of the word or at the blank behind it, and do not reach before the blank in front
    wide = np.r_[np.full(4, 32, np.uint8), tokens.data].astype(np.uint32)
    code = np.zeros(n, np.uint64)
    out = []
    for k in range(4):
        code |= wide[4 - k : 4 - k + n].astype(np.uint64) << np.uint64(8 * k)
        if k:
            fits = at - k >= np.repeat(tokens.start, size + 1) - 1
            out.append(((mixed(code[at[fits]] + (np.uint64(k) << np.uint64(40))) % np.uint64(slots)).astype(np.int64), word[fits]))
    return np.concatenate([s for s, _ in out]), np.concatenate([w for _, w in out])


class Model:
    def __init__(self, languages, counts, scripts):
        """counts: n-grams by language and slot; scripts: words by language and script."""
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True)
        self.scores = np.log((counts + 0.1) / (total + 0.1 * counts.shape[1])).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        allowed = share >= RARE
        self.allowed = np.where(allowed.any(axis=0), allowed, True)

    def words(self, tokens):
        """Log score of each word in each language; languages that do not use its script get a low one."""
        slot, word = grams(tokens, self.scores.shape[1])
        order = np.argsort(word, kind="stable")
        slot, word = slot[order], word[order]
        edge = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        scores = np.stack([np.add.reduceat(s[slot], edge) for s in self.scores], axis=1)
        return np.where(self.allowed[:, scripts_of(tokens)].T, scores, scores.min(axis=1, keepdims=True) - 20.0)


def by_size(sizes):
    """Order of runs from the longest on, and how many of them have a word at each step."""
    order = np.argsort(-sizes, kind="stable")
    return order, np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max()) + 1), "right")


def ends(scores, heads, sizes, penalty):
    """Best score of each run that ends in each label, after each label before it and (the last row) after nothing."""
    order, alive = by_size(sizes)
    n = scores.shape[1]
    best = scores[heads[order]][:, None, :] - penalty * np.r_[1.0 - np.eye(n), np.zeros((1, n))]
    for t in range(1, len(alive)):
        own = best[: alive[t]]
        np.maximum(own, own.max(axis=2, keepdims=True) - penalty, out=own)
        own += scores[heads[order[: alive[t]]] + t][:, None, :]
    out = np.empty_like(best)
    out[order] = best
    return out


def labelled(scores, heads, sizes, penalty, before, last):
    """Labels of the words of all runs side by side, after the label ``before`` (-1: nothing) and up to ``last`` (-1: the best)."""
    label = np.zeros(len(scores), np.int64)
    order, alive = by_size(sizes)
    heads, before, last = heads[order], before[order], last[order]
    back, kept = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32), np.arange(scores.shape[1])
    best = scores[heads].astype(np.float64) - penalty * ((before[:, None] >= 0) & (before[:, None] != kept))
    for t in range(len(alive)):
        at = heads[: alive[t]] + t
        if t:
            best = best[: alive[t]]
            top = best.argmax(axis=1)
            switch = best[np.arange(len(best)), top] - penalty
            stay = best >= switch[:, None]
            back[at] = np.where(stay, kept, top[:, None])
            best = np.where(stay, best, switch[:, None]) + scores[at]
        done = slice(alive[t + 1] if t + 1 < len(alive) else 0, alive[t])
        label[at[done]] = np.where(last[done] >= 0, last[done], best[done].argmax(axis=1))
    for t in range(len(alive) - 1, 0, -1):
        at = heads[: alive[t]] + t
        label[at - 1] = back[at, label[at]]
    return label


def viterbi(scores, first, penalty=SWITCH):
    """Labels of all words of several texts: words of text k are first[k] to first[k + 1].

    Texts are cut into runs of SPAN words, so that all advance side by side: first from every label to every label, which
    gives the labels at the cuts, then within them. With many languages whole texts advance instead, to the same end.
    """
    size = np.diff(first)
    with_words = np.flatnonzero(size)
    if not len(with_words):
        return np.zeros(len(scores), np.int64)
    n = scores.shape[1]
    span = SPAN if n <= SIDE_BY_SIDE else int(size.max())
    runs = -(-size[with_words] // span)
    text = np.repeat(np.arange(len(with_words)), runs)
    place = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    heads = first[:-1][with_words][text] + place * span
    sizes = np.minimum(span, size[with_words][text] - place * span)
    before, last = np.full(len(text), -1), np.full(len(text), -1)
    if runs.max() > 1:
        moves = ends(scores.astype(np.float64), heads, sizes, penalty)
        own = np.cumsum(runs) - runs
        value, came = moves[own, n], np.zeros((len(text), n), np.int64)
        for k in range(1, int(runs.max())):
            at = np.flatnonzero(runs > k)
            ways = value[at][:, :, None] + moves[own[at] + k, :n]
            came[own[at] + k] = ways.argmax(axis=1)
            value[at] = ways.max(axis=1)
        last[own + runs - 1] = value.argmax(axis=1)
        for k in range(int(runs.max()) - 1, 0, -1):
            at = own[runs > k] + k
            before[at] = came[at, last[at]]
            last[at - 1] = before[at]
    return labelled(scores, heads, sizes, penalty, before, last)


def has_letter(text):
    return any(unicodedata.category(c)[0] == "L" for c in text)


def train(docs, holdout=5, slots=SLOTS):
    """A model from all documents with a text and a language whose id's crc32 modulo ``holdout`` is not 0.

    Counts are summed by language and slot over all of them; what reaches the driver is bounded by both numbers, as more
    than LANGUAGES languages are an error.
    """
    ready(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(remainder("doc_id", holdout) != 0, F.lit(True))).select("lang", F.col("text").cast("binary").alias("text"))

    def count(batches):
        sums = {}
        for batch in batches:
            lang, data = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for name in set(lang.tolist()):
                mine = [data[k] for k in np.flatnonzero(lang == name)]
                held = sums.setdefault(name, (np.zeros(slots, np.int64), np.zeros(len(NAMES), np.int64)))
                for s in in_chunks(mine):
                    tokens = Tokens(mine[s])
                    if len(tokens.start):
                        words, like = distinct(tokens)
                        times = np.bincount(like)
                        slot, word = grams(words, slots)
                        held[0][:] += np.bincount(slot, times[word], minlength=slots).astype(np.int64)
                        held[1][:] += np.bincount(scripts_of(words), times, minlength=len(NAMES)).astype(np.int64)
        for name, (gram, script) in sums.items():
            n = np.r_[gram, script]
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "slot", "n"])

    sums = settled(rows.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")), "grams")
    if sums.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    vectors = sums.groupBy("lang").agg(F.collect_list(F.struct("slot", "n")).alias("at")).toArrow()
    names = sorted(vectors.column("lang").to_pylist())
    full = np.zeros((len(names), slots + len(NAMES)))
    for name, at in zip(vectors.column("lang").to_pylist(), vectors.column("at")):
        inner = at.values
        full[names.index(name), inner.field("slot").to_numpy()] = inner.field("n").to_numpy()
    return Model(names, full[:, :slots], full[:, slots:])


def label_spans(texts, model, penalty=SWITCH, known=None):
    """For a list of texts (bytes): tokens and the label of each word. Each distinct word is scored once."""
    tokens = Tokens(texts)
    if not len(tokens.start):
        return tokens, np.empty(0, np.int64)
    words, like = distinct(tokens)
    scores = (known or Known(len(model.languages))).get(words, model.words)
    return tokens, viterbi(scores[like], tokens.first, penalty)


def predict(docs, model):
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` (lang, words) of each document's whole text.

    The score is the share of the text's word bytes in that language.  A missing text, or one without a letter, is ``und``
    with score 0, and so is every text if nothing was learned; ties go to the first name. Repeated rows stay.
    """
    shared = ready(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        known = Known(len(shared.value.languages))
        for batch in batches:
            model, data = shared.value, batch.column(1).to_pylist()
            langs, scores, spans = ["und"] * len(data), [0.0] * len(data), [[] for _ in data]
            for s in in_chunks([t or b"" for t in data]) if model.languages else ():
                tokens, label = label_spans([t or b"" for t in data[s]], model, known=known)
                size = (tokens.stop - tokens.start).astype(float)
                weight = np.bincount(tokens.text * len(model.languages) + label, size, (s.stop - s.start) * len(model.languages)).reshape(-1, len(model.languages))
                letters = np.bincount(tokens.text, minlength=s.stop - s.start)
                for k in range(s.start, s.stop):
                    w = weight[k - s.start]
                    if letters[k - s.start] and has_letter(data[k].decode("utf-8", "replace")):
                        langs[k], scores[k] = model.languages[int(w.argmax())], float(w.max() / w.sum())
                        mine = label[tokens.first[k - s.start] : tokens.first[k - s.start + 1]]
                        edge = np.r_[np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]]), len(mine)]
                        spans[k] = [{"lang": model.languages[mine[a]], "words": int(b - a)} for a, b in zip(edge[:-1], edge[1:])]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=["doc_id", "lang_pred", "score", "spans"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<lang:string,words:long>>")
