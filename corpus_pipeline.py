"""From raw documents to packed sequences, in five stages.

Each stage takes what the one before kept, as a written table, and drops or changes documents by its own decision:

1. ``rules``: documents that fail the quality rules go.
2. ``classifier``: documents that the quality classifier scores under 0.3 go.
3. ``near_duplicates``: of each group of documents whose SimHash fingerprints are linked, the one with the smallest id stays.
4. ``repeats``: passages of 50 bytes or more that an earlier document has are cut out of the text.
5. ``packing``: the rest is cut and packed into sequences of 1024 tokens.

A missing text counts as empty and fails the rules.  Labels that a stage learns from are those of the given tables.
"""

import public_tokenizers
from pyspark.sql import functions as F

from parcelry.llm import packing, quality, ranked, repeats, rules, simhash
from parcelry.llm.common import ready, settled, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCORE = 0.3


def keep_by_rules(spark, docs, sf_dir):
    judged = rules.judge(docs, rules.trusted_ids(table(spark, sf_dir, "labels")))
    return judged.where("kept").select(COLUMNS)


def keep_by_quality(spark, docs, sf_dir):
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, weights).where(F.col("score") >= SCORE).select(COLUMNS)


def drop_near_duplicates(spark, docs, sf_dir):
    """Links at three of 64 bits over three-word shingles; one row of each group stays."""
    return simhash.one_of_each(docs, words=3, distance=3, seed=42).select(COLUMNS)


def cut_repeats(spark, docs, sf_dir):
    """Cut texts keep their row, with the new number of characters."""
    cut = repeats.cut_out(repeats.find_repeats(docs, depth=50, carry=("lang", "source")), carry=("lang", "source"))
    return cut.withColumn("text", repeats.readable(F.col("kept"))).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def pack(spark, docs, sf_dir):
    encoder = ranked.shared_encoder(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, encoder, capacity=1024, end=2)


STAGES = [("rules", keep_by_rules), ("classifier", keep_by_quality), ("near_duplicates", drop_near_duplicates), ("repeats", cut_repeats), ("packing", pack)]

#: Fingerprints, learned weights and sorted suffixes have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
