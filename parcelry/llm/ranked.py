"""Token ids from the rank file of a byte-level vocabulary, for operators that only need ids; the automaton in ``bpe`` gives the same."""

import base64
import json
import re
from array import array

import tiktoken

from parcelry.llm.bpe import SPLIT, Recent
from parcelry.llm.common import ready

CACHED_WORDS = 250_000


class RankEncoder:
    def __init__(self, ranks, vocabulary):
        """ranks: the file of ranks; vocabulary: the file that names the added tokens."""
        with open(ranks, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        with open(vocabulary, encoding="utf-8") as f:
            self.added = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}

    def __getstate__(self):
        return {"ranks": self.ranks, "added": self.added}

    def start(self):
        if "words" not in self.__dict__:
            encoding = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=self.ranks, special_tokens={})
            self.whole = lambda text: array("I", encoding.encode_ordinary(text)).tobytes()
            self.words = Recent(lambda piece: self.whole(" " + piece), CACHED_WORDS)
            self.odd = re.compile(r" (?:\s|\Z)")
            self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        return self

    def plain(self, text):
        """Ids of a text without added tokens. A blank before a non-blank always begins a word, so pieces between blanks can be looked up."""
        if self.odd.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text):
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        self.start()
        if self.marks is None or not any(x in text for x in self.added):
            return self.plain(text)
        return b"".join(array("I", [self.added[x]]).tobytes() if k % 2 else self.plain(x) for k, x in enumerate(self.marks.split(text)) if x)


def shared_encoder(spark, ranks, vocabulary):
    """The ranks, broadcast; their size is that of the vocabulary."""
    return ready(spark).sparkContext.broadcast(RankEncoder(ranks, vocabulary))
