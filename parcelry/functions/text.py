"""Title normalisation and tokens."""

import unicodedata
import zlib
from functools import lru_cache
from itertools import permutations

from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def bound(value, body):
    """``body`` of the value. As a lambda variable the value is computed once, however often the body uses it.

    A column given by its name is at hand already: without a lambda the body is compiled.
    """
    return body(F.col(value)) if isinstance(value, str) else F.get(F.transform(F.array(value), body), F.lit(0))


#: Combining marks above and below a letter, and a character with those that follow it.
MARKS = "[\u0300-\u036f]"
CLUSTER = "(?s)[^\u0300-\u036f]?[\u0300-\u036f]+|[^\u0300-\u036f]+(?![\u0300-\u036f])|[^\u0300-\u036f]"


@lru_cache(maxsize=1)
def compositions():
    """{letter and its marks in any order: the one character that they make}, for all Latin letters of one or two marks."""
    found = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if 0 < len(marks) < 3 and unicodedata.normalize("NFC", chr(code)) == chr(code):
            for order in permutations(marks):
                if unicodedata.normalize("NFC", base + "".join(order)) == chr(code):
                    found[base + "".join(order)] = chr(code)
            if len(marks) == 2:
                # the first mark is in place already
                first = unicodedata.normalize("NFC", base + marks[0])
                if len(first) == 1:
                    found[first + marks[1]] = chr(code)
    return found


#: Maps that the compositions are dealt into.
BUCKETS = 1024


@lru_cache(maxsize=1)
def composition_buckets():
    """SQL of ``compositions()`` as an array of maps, dealt by CRC-32: a map is searched entry by entry, so each has one or two."""
    dealt = [["", ""] for _ in range(BUCKETS)]
    for apart, whole in compositions().items():
        dealt[zlib.crc32(apart.encode()) % BUCKETS] += [apart, whole]
    return "array({})".format(", ".join("map({})".format(", ".join(f"'{x}'" for x in bucket)) for bucket in dealt))


def composed(c):
    """Letters with the marks that follow them as one character, as far as Latin has it; a text without marks is left alone.

    Spark has no such function. Only texts with marks are taken apart: each letter with marks is looked up.
    """
    table = F.expr(composition_buckets())
    known = lambda p: F.try_element_at(F.get(table, F.pmod(F.crc32(p.cast("binary")), F.lit(BUCKETS)).cast("int")), p)
    first = lambda p: F.coalesce(known(p), p)
    whole = lambda p: F.coalesce(known(p), F.concat(first(F.substring(p, 1, 2)), F.substring(p, 3, 1 << 20)))
    part = lambda p: F.when(p.rlike(MARKS), whole(p)).otherwise(p)
    read = lambda t: F.when(t.rlike(MARKS), F.array_join(F.transform(F.regexp_extract_all(t, F.lit(CLUSTER), F.lit(0)), part), "")).otherwise(t)
    return bound(c, read)


def normalise_title(c):
    """Lower case; every run of characters other than letters becomes one space. Letters may come with separate marks."""
    return F.trim(F.regexp_replace(F.lower(composed(c)), r"[^a-zA-ZÀ-ỹ]+", " "))


def tokens(c):
    """White-space tokens; no tokens for an empty or missing text."""
    words = F.split(_col(c), r"(?U)\s+")
    return F.filter(F.coalesce(words, F.array().cast("array<string>")), lambda w: w != "")


def without_stop_words(words, stop_words):
    """Drop stop words and keep the order and the duplicates of the rest.

    An entry with a space in it can never equal a token and is left out.
    """
    single = sorted({w.strip() for w in stop_words if w.strip() and " " not in w.strip()})
    if not single:
        return _col(words)
    return F.filter(_col(words), lambda w: ~w.isin(single))


def long_words(c):
    """Lower-case runs of at least two letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def neighbours(words):
    """Structs (first, second) of the neighbouring pairs of words."""
    words = _col(words)
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.arrays_zip(F.slice(words, F.lit(1), rest).alias("first"), F.slice(words, F.lit(2), rest).alias("second"))


def bigrams(words):
    """Neighbouring word pairs, joined by a space."""
    return F.transform(neighbours(words), lambda p: F.concat(p["first"], F.lit(" "), p["second"]))
