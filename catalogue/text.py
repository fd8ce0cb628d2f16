from pyspark.sql import functions as F

from catalogue.registry import register, table
from parcelry.functions import text as T
from parcelry.operators import text_counts as C

# A sample list for the given texts; callers pass their own.
STOP_WORDS = ["the", "of", "and", "to", "in", "le", "la", "les", "de", "des", "et", "der", "die", "und", "el", "los", "y", "en el"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
NORMAL = "trim(regexp_replace(lower(text), '[^a-zA-ZÀ-ỹ]+', ' ', 'g'))"
WORDS = f"""WITH words AS (SELECT w AS word, count(*) AS count FROM (SELECT unnest(string_split({NORMAL}, ' ')) AS w FROM documents)
 WHERE w <> '' AND w NOT IN ({STOP_SQL}) GROUP BY w)"""


@register("t1_normalised_titles", f"SELECT doc_id, {NORMAL} AS clean FROM documents")
def t1(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.normalise_title("text").alias("clean"))


@register(
    "t2_tokens",
    f"""SELECT doc_id, list_filter(string_split({NORMAL}, ' '), lambda w: w <> '' AND w NOT IN ({STOP_SQL})) AS tokens FROM documents""",
)
def t2(spark, folder):
    return C.cleaned_tokens(table(spark, folder, "documents").select("doc_id", "text"), "text", STOP_WORDS).drop("text")


def document_tokens(spark, folder):
    return C.cleaned_tokens(table(spark, folder, "documents"), "text", STOP_WORDS)


@register("t3_word_counts", f"{WORDS} SELECT * FROM words ORDER BY count DESC, word LIMIT 50")
def t3(spark, folder):
    return C.top_words(document_tokens(spark, folder))


@register(
    "t3_word_extremes",
    f"""{WORDS}, top AS (SELECT CAST(row_number() OVER (ORDER BY count DESC, word) AS INTEGER) AS rank, * FROM words)
 SELECT rank, word, count FROM top WHERE rank <= 20 OR (rank > 30 AND rank <= 50)""",
)
def t3_extremes(spark, folder):
    return C.word_extremes(document_tokens(spark, folder))


@register(
    "t4_bigrams",
    """WITH w AS (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS w FROM documents)
 SELECT b AS bigram, count(*) AS count FROM (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM w) GROUP BY b ORDER BY 2 DESC, 1 LIMIT 50""",
)
def t4(spark, folder):
    return C.top_bigrams(table(spark, folder, "documents"), "text")


@register("t5_cloud_weights", f"{WORDS} SELECT word, count, count / (SELECT max(count) FROM words) AS weight FROM words")
def t5(spark, folder):
    return C.cloud_weights(document_tokens(spark, folder))
