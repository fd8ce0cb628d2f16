"""Encoding with a piece model that keeps every piece's place in the source, and decoding.

A text is normalised from left to right: at each place the longest prefix that the model's compiled character map has a
rule for is replaced, any other character is copied, and each byte written remembers the source byte it came from.  The
pieces cover the normalised bytes without gaps, so their borders, looked up in that alignment, are spans of the source.

The compiled map is a double array: a unit's offset and the next byte lead to the next unit, whose label must be that
byte; a unit that ends a rule has a leaf with the place of its replacement in a table of strings.
"""

import heapq
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from parcelry.llm.bpe import Recent
from parcelry.llm.common import ready, texts

#: The mark that stands for a blank, and the kinds of pieces in a model file.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
CACHED_WORDS = 200_000
#: Up to so many characters are merged by plain search, more by a heap.
SHORT = 24


class CharacterMap:
    """Replacement of the longest prefix that has a rule."""

    def __init__(self, compiled=b""):
        size = int.from_bytes(compiled[:4], "little")
        self.units = array("I", compiled[4 : 4 + size])
        self.strings = compiled[4 + size :]
        # characters that no rule begins with are copied in whole runs
        self.rare = re.compile("[" + "".join(map(re.escape, self.openers())) + "]") if self.units else re.compile(r"(?!)")

    def __bool__(self):
        return bool(self.units)

    def step(self, place, byte):
        """Place of the unit behind ``byte``, or -1."""
        unit = self.units[place]
        place ^= ((unit >> 10) << ((unit & 0x200) >> 6)) ^ byte
        return place if place < len(self.units) and self.units[place] & 0x800000FF == byte else -1

    def openers(self):
        """Every character that a rule begins with: all walks from the root that spell one character."""
        heads = [(0, b"")]
        while heads:
            place, head = heads.pop()
            for byte in range(1, 256):
                if (after := self.step(place, byte)) < 0:
                    continue
                spelled = head + bytes([byte])
                try:
                    yield spelled.decode()
                except UnicodeDecodeError:
                    if len(spelled) < 4:
                        heads.append((after, spelled))

    def longest(self, data, start):
        """Length of the longest prefix of ``data[start:]`` with a rule and its replacement, or (0, b"")."""
        place, found, at = 0, 0, -1
        for k in range(start, len(data)):
            if data[k] == 0 or (place := self.step(place, data[k])) < 0:
                break
            unit = self.units[place]
            if unit & 0x100:
                leaf = place ^ ((unit >> 10) << ((unit & 0x200) >> 6))
                found, at = k + 1 - start, self.units[leaf] & 0x7FFFFFFF
        return found, self.strings[at : self.strings.index(b"\0", at)] if at >= 0 else b""


class PieceModel:
    def __init__(self, path):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE:
            raise ValueError("only models with merges by score are supported")
        if odd := {p.type for p in spec.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"pieces of kinds {sorted(odd)} are not supported")
        rules = spec.normalizer_spec
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces
        self.suffix = spec.trainer_spec.treat_whitespace_as_suffix
        self.begin, self.end = spec.trainer_spec.bos_id, spec.trainer_spec.eos_id
        self.ids, self.scores, self.bytes, self.labels, self.opens = {}, {}, {}, [], []
        for i, p in enumerate(spec.pieces):
            label = b""
            if p.type == NORMAL:
                self.ids[p.piece], self.scores[p.piece] = i, p.score
                label = p.piece.replace(MARK, " ").encode()
            elif p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
                label = bytes([int(p.piece[3:5], 16)])
            elif p.type == UNKNOWN:
                self.unknown, label = i, spec.trainer_spec.unk_surface.encode()
            self.labels.append(label)
            self.opens.append(p.type == NORMAL and p.piece.startswith(MARK))
        # no piece has a blank after another character: then nothing is merged across a blank, and words are encoded alone
        self.pattern = self.word_pattern()

    def word_pattern(self):
        """Cuts a text only between characters that no piece has side by side, so that nothing is merged across a cut.

        That is before a blank, if no piece has one behind another character, between a letter and some marks, and behind
        some control characters. Without byte pieces a run of characters without a piece is one unknown and stays whole.
        """
        pairs = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        if not self.escape or not self.bytes or any(b == MARK != a for a, b in pairs):
            return "(?s).+"
        letters = {c for p in self.ids for c in p if c.isalpha()}
        marks = [c for c in map(chr, range(256)) if not c.isalnum() and c != " " and not any(c == b and a in letters for a, b in pairs)]
        ends = [c for c in marks if not any(c == a for a, _ in pairs)]
        some = lambda cs: "".join(map(re.escape, sorted(cs)))
        return f"(?s)(?:{MARK}+|[^{MARK}])(?:(?<![{some(ends)}])[^{MARK}{some(marks)}]+|(?<![{some(letters)}])[{some(marks)}])*" if marks and ends else f"{MARK}+[^{MARK}]*|[^{MARK}]+"

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in {"words", "split"}}

    def start(self):
        if "words" not in self.__dict__:
            self.words = Recent(self.word, CACHED_WORDS)
            self.split = re.compile(self.pattern).findall
        return self

    def normalise(self, text):
        """The normalised text and, for each of its bytes and its end, the byte of the source that it came from."""
        source = text.encode()
        if not self.map and not self.squeeze:
            if not source:
                return "", np.zeros(1, np.int64)
            data = np.frombuffer(source, np.uint8)
            mark, wide = (MARK, 3) if self.escape else (" ", 1)
            before, after = self.prefix and not self.suffix, self.prefix and self.suffix
            places = np.repeat(np.arange(len(data)), np.where(data == 32, wide, 1))
            places = np.concatenate([np.zeros(wide * before, np.int64), places, np.full(wide * after + 1, len(data))])
            return mark * before + text.replace(" ", mark) + mark * after, places
        return self.mapped(text, source)

    def mapped(self, text, source):
        out, places, done = [], [], 0
        mark = MARK.encode() if self.escape else b" "

        def put(byte, at):
            piece = mark if byte == b" " else byte
            out.append(piece)
            places.extend([at] * len(piece))

        blank = self.squeeze
        begun = not (self.prefix and not self.suffix)
        for at, size, data, copied in self.parts(text, source):
            if self.squeeze and not begun:
                lead = len(data) - len(data.lstrip(b" ")) if copied else size * (data == b" ")
                at, size, data = at + lead, size - lead, data[lead:]
                done = at
                if not size:
                    continue
            if not begun:
                put(b" ", done)
                begun = True
            for k, byte in enumerate(data):
                # of a run of blanks the first stays
                if not (self.squeeze and blank and byte == 32):
                    put(data[k : k + 1], at + (k if copied else 0))
                    blank = byte == 32
            done = at + size
        data = b"".join(out)
        if self.squeeze:
            kept = data
            while kept.endswith(mark):
                kept = kept[: -len(mark)]
            if len(kept) < len(data):
                data, done = kept, places[len(kept)]
                del places[len(kept) :]
        if data and self.prefix and self.suffix:
            data += mark
            places.extend([done] * len(mark))
        places.append(done)
        return data.decode("utf-8", "replace"), np.array(places, np.int64)

    def parts(self, text, source):
        """Runs of the source as (place, length, what replaces it, whether it is copied)."""
        at, k = 0, 0
        while k < len(text):
            found = self.map.rare.search(text, k)
            stop = found.start() if found else len(text)
            if stop > k:
                run = text[k:stop].encode()
                yield at, len(run), run, True
                at, k = at + len(run), stop
                continue
            size, data = self.map.longest(source, at)
            if size:
                yield at, size, data, False
                k += len(source[at : at + size].decode())
                at += size
            else:
                run = text[k].encode()
                # a character that begins rules, none of which is met
                yield at, len(run), run, True
                at, k = at + len(run), k + 1

    def merged(self, word):
        """Pieces of ``word``: the adjacent pair with the highest score is merged first, of equal ones the leftmost."""
        parts, score = list(word), self.scores.get
        if len(parts) > SHORT:
            return self.merged_by_heap(parts)
        pairs = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for k, s in enumerate(pairs):
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(pairs):
                pairs[at] = score(parts[at] + parts[at + 1])

    def merged_by_heap(self, parts):
        n, score = len(parts), self.scores.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(a, b):
            joined = parts[a] + parts[b]
            if (s := score(joined)) is not None:
                heapq.heappush(heap, (-s, a, b, len(joined)))

        for k in range(n - 1):
            offer(k, k + 1)
        while heap:
            _, a, b, size = heapq.heappop(heap)
            if not parts[a] or not parts[b] or after[a] != b or len(parts[a]) + len(parts[b]) != size:
                continue
            parts[a], parts[b] = parts[a] + parts[b], ""
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        return [p for p in parts if p]

    def word(self, word):
        """Ids of a word and the normalised bytes that each covers, both as unsigned 32-bit integers.

        A character without a piece becomes its bytes, of which the last covers it; without byte pieces, a run of such
        characters becomes one unknown.
        """
        ids, sizes, lost = array("I"), array("I"), False
        for piece in self.merged(word):
            i = self.ids.get(piece)
            data = piece.encode()
            if i is not None:
                ids.append(i)
                sizes.append(len(data))
            elif self.bytes:
                ids.extend(self.bytes[b] for b in data)
                sizes.extend([0] * (len(data) - 1) + [len(data)])
            elif lost:
                sizes[-1] += len(data)
            else:
                ids.append(self.unknown)
                sizes.append(len(data))
            lost = i is None
        return ids.tobytes(), sizes.tobytes()

    def encode(self, text):
        """Ids of ``text`` between the begin and the end id, and begin and end of each one's span in the source bytes."""
        self.start()
        normal, places = self.normalise(text)
        found = [self.words[w] for w in self.split(normal)]
        sizes = np.frombuffer(b"".join([s for _, s in found]), np.uint32)
        ends = np.cumsum(sizes, dtype=np.int64)
        spans = np.empty((len(sizes) + 2, 2), "<u4")
        spans[0], spans[-1] = 0, len(places) and places[-1]
        spans[1:-1, 1] = places[ends]
        spans[1:-1, 0] = places[ends - sizes]
        ids = array("I", [self.begin]).tobytes() + b"".join([i for i, _ in found]) + array("I", [self.end]).tobytes()
        return ids, spans.tobytes()

    def decode(self, ids):
        """The text of ``ids``: the blank put before the text goes, byte pieces are joined, a byte that is no UTF-8 becomes U+FFFD."""
        ids = array("I", ids)
        labels = list(map(self.labels.__getitem__, ids))
        if (self.prefix or self.squeeze) and not self.suffix:
            for k, i in enumerate(ids):
                if self.opens[i]:
                    labels[k] = labels[k][1:]
                if labels[k] or self.opens[i] and not self.squeeze:
                    break
        data = b"".join(labels)
        if self.prefix and self.suffix and data.endswith(b" "):
            data = data[:-1]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return "".join(whole_characters(data))


def whole_characters(data):
    while data:
        for size in (1, 2, 3, 4):
            try:
                yield data[:size].decode()
                data = data[size:]
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            data = data[1:]


def shared_model(spark, path):
    """The model read once and broadcast; its size is that of the vocabulary."""
    return ready(spark).sparkContext.broadcast(PieceModel(path))


def encode(docs, model):
    """``doc_id``, ``ids`` and ``spans`` of each document's whole ``text``.

    ``ids`` are little-endian unsigned 32-bit integers with begin and end id, ``spans`` one pair of such integers for each:
    first byte and byte after the last in the UTF-8 of the source.  The spans of the pieces follow each other without gaps.
    A missing or empty text has begin and end alone; repeated rows stay; other columns are not looked at; an empty table
    gives an empty table.  Map only: nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            encoder = model.value
            found = [encoder.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i for i, _ in found], pa.binary()), pa.array([s for _, s in found], pa.binary())], names=["doc_id", "ids", "spans"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary, spans binary")


def decode(tokens, model):
    """``doc_id``, ``ids`` and ``decoded``, the text of ``ids``; missing ids give the empty text."""

    def run(batches):
        for batch in batches:
            decoder = model.value
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([decoder.decode(x) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", F.coalesce(F.col("ids"), F.lit(b"")).alias("ids")).mapInArrow(run, "doc_id long, ids binary, decoded string")
