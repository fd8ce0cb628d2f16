"""Quality rules: counts of plain defects, and a log-likelihood ratio of hashed n-grams. DataFrame functions only.

Words and word pairs are hashed to BUCKETS.  Two multinomials over the buckets are counted: one from a trusted target, the
other from the whole raw corpus.  A document's ratio is the mean, over its n-grams, of the log of target over raw
probability, so it does not depend on its length.  Documents under the threshold are rejected, always the same ones.

The bucket table has a fixed size and travels as a literal; scoring is a projection without any shuffle.
"""

import math

from pyspark.sql import functions as F

BUCKETS = 1 << 14
#: So many trusted ids are broadcast; more are joined by shuffle.
TOLD = 1 << 20
THRESHOLD = -0.2
SMOOTH = 1.0
WINDOW = 8

BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def bound(value, use):
    """``use`` of a value that is computed once for each row, however often it occurs."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def words_of(text):
    """The words of ``text``; none if it is missing or blank."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def places(n):
    """1 to n, nothing for n under 1."""
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def grams_of(words):
    """Buckets of all words and pairs of neighbours."""
    pairs = F.transform(places(F.size(words) - 1), lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i)))
    return F.transform(F.concat(F.transform(words, lambda w: F.xxhash64(w)), pairs), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def repeated_words(words, window=WINDOW):
    """Number of words inside windows of ``window`` words that occur twice or more in the text, the first included.

    Window hashes are sorted with their places; neighbours with one hash are repeats. Each repeated window covers the words
    up to the next one's start, ``window`` at most.
    """
    hashes = F.transform(places(F.size(words) - (window - 1)), lambda i: F.xxhash64(*(F.get(words, i - 1 + k) for k in range(window))))

    def covered(starts):
        steps = F.transform(places(F.size(starts) - 1), lambda i: F.least(F.lit(window), F.get(starts, i) - F.get(starts, i - 1)))
        return F.when(F.size(starts) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(window), lambda total, x: total + x))

    def repeated(ordered):
        same = lambda i, j: F.get(ordered, i)["h"] == F.get(ordered, j)["h"]
        hit = lambda i: F.coalesce(same(i - 1, i), F.lit(False)) | F.coalesce(F.when(i >= 2, same(i - 1, i - 2)), F.lit(False))
        starts = F.transform(F.filter(places(F.size(ordered)), hit), lambda i: F.get(ordered, i - 1)["i"])
        return bound(F.sort_array(starts), covered)

    def count(h):
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bound(ordered, repeated))

    return bound(hashes, count).cast("long")


def base_counts(docs):
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return docs.select(
        "*",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        bound(words_of(F.col("text")), repeated_words).alias("n_repeat_words"),
    )


def trusted_ids(labels):
    """All documents labelled as good."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct()


def ratios(docs, trusted):
    """Log ratio of each bucket: its share in the trusted documents over its share in all documents, smoothed.

    Every document is counted. Without a trusted document all ratios are 0.
    """
    own, few = docs.select("doc_id", "text"), trusted.count() <= TOLD
    if few:
        marked = own.join(F.broadcast(trusted.select("doc_id", F.lit(1).alias("good"))), "doc_id", "left").select("good", "text", F.lit(1).alias("any"))
    else:
        # documents without an id meet no label and stay out of the shuffle
        marked = own.select(F.lit(None).cast("int").alias("good"), "text", F.lit(1).alias("any")).union(own.join(trusted.hint("shuffle_merge"), "doc_id", "left_semi").select(F.lit(1), "text", F.lit(None).cast("int")))
    grams = marked.select("good", "any", F.explode(bound(words_of(F.col("text")), grams_of)).alias("bucket"))
    tally = grams.groupBy("bucket").agg(F.count("any").alias("raw"), F.count("good").alias("target")).collect()  # BUCKETS rows at most
    raw, target = ({r["bucket"]: r[c] for r in tally} for c in ("raw", "target"))
    n_raw, n_target = sum(raw.values()), sum(target.values())
    if not n_target:
        return [0.0] * BUCKETS
    # the target's prior is the raw corpus, so what neither says much about counts as neutral
    share = {k: (raw.get(k, 0) + SMOOTH) / (n_raw + SMOOTH * BUCKETS) for k in range(BUCKETS)}
    return [math.log((target.get(k, 0) + BUCKETS * share[k]) / (n_target + BUCKETS) / share[k]) for k in range(BUCKETS)]


def with_ratio(docs, table):
    """``docs`` with ``ratio``, the mean log ratio of the text's n-grams; NULL without a word."""
    # a foldable expression: it is evaluated once, when the query is planned
    literal = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")
    mean = lambda g: F.when(F.size(g) > 0, F.aggregate(g, F.lit(0.0), lambda total, k: total + F.get(literal, k)) / F.size(g))
    return docs.withColumn("ratio", bound(bound(words_of(F.col("text")), grams_of), mean))


def judge(docs, trusted, threshold=THRESHOLD):
    """``docs`` with the base counts, ``ratio``, ``base_failed`` and ``kept``.

    A missing text has no words and fails the base. Base: under 20 words, or over 30 % of words in repeated windows.
    Columns of ``docs`` with the same names are replaced; repeated rows stay; an empty table gives an empty table.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "base_failed", "kept"]
    plain = docs.drop(*own)
    scored = with_ratio(base_counts(plain), ratios(plain, trusted))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= threshold))
