"""The operators of this package as queries over the given tables, with production parameters."""

import public_tokenizers
from pyspark.sql import functions as F

from parcelry.llm import bpe, language, mixing, neighbours, packing, pieces, quality, ranked, repair, repeats, rules, simhash, trie, warc
from parcelry.llm.common import ready, remainder, settled, table

QUERIES = {}
CHECKS = {}


def register(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return keep


def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


def held_out(modulus):
    """Whether a row is left out of learning; a row without an id is not."""
    return F.coalesce(remainder("doc_id", modulus) == 0, F.lit(False)).alias("held_out")


@register("op1_bpe")
def op1_bpe(spark, folder):
    """Every document encoded and decoded again: number of tokens and digests of both."""
    automaton = bpe.shared_automaton(spark, tokenizer())
    both = bpe.decode(bpe.encode(table(spark, folder, "documents"), automaton), automaton)
    return both.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register("op2_packing")
def op2_packing(spark, folder):
    """Every document's pieces and their places in sequences of at most 1024 tokens."""
    encoder = ranked.shared_encoder(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), tokenizer())
    return packing.pack(table(spark, folder, "documents"), encoder, capacity=1024, end=2)


@register("op9_simhash")
def op9_simhash(spark, folder):
    """Every document's fingerprint and the smallest document it is linked with."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=3, distance=3, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op7_repeats")
def op7_repeats(spark, folder):
    """Every document without the passages of 50 bytes or more that a document with a smaller id also has."""
    cut = repeats.cut_out(repeats.find_repeats(table(spark, folder, "documents"), depth=50))
    return cut.select("doc_id", (F.octet_length("kept") + F.col("n_removed")).cast("long").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op4_quality")
def op4_quality(spark, folder):
    """Every document's quality score and the decision at 0.3."""
    docs = table(spark, folder, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, folder, "labels"), holdout=5))
    return scored.select("doc_id", held_out(5), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@register("op5_language")
def op5_language(spark, folder):
    """Every document's language, learned from the others' labels."""
    docs = table(spark, folder, "documents")
    found = language.predict(docs, language.train(docs, holdout=5))
    return found.select("doc_id", held_out(5), "lang_pred", "score")


@register("op8_rules")
def op8_rules(spark, folder):
    """Every document's base counts and the verdict of the rules."""
    docs = table(spark, folder, "documents")
    judged = rules.judge(docs, rules.trusted_ids(table(spark, folder, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


@register("op10_neighbours")
def op10_neighbours(spark, folder):
    """The 20 nearest vectors of each vector whose id is divisible by 20."""
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@register("pipeline")
def pipeline(spark, folder):
    """The stages of ``corpus_pipeline`` over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


@register("op6_warc")
def op6_warc(spark, folder):
    """Every page as it comes back from the archives it was written to."""
    records = warc.round_trip(table(spark, folder, "pages"))
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return records.select(
        page("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), F.col("stated_bytes")).alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), F.regexp_replace("stated_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )


@register("op3_mixing")
def op3_mixing(spark, folder):
    """Every document's log10 probability by the base and by the mixing model."""
    scored = mixing.score(table(spark, folder, "documents"), holdout=10)
    return scored.select("doc_id", held_out(10), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@register("op12_pieces")
def op12_pieces(spark, folder):
    """Every document encoded into pieces and decoded again: number of ids and digests of both."""
    model = pieces.shared_model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    both = pieces.decode(pieces.encode(table(spark, folder, "documents"), model), model)
    return both.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register("op11_repair")
def op11_repair(spark, folder):
    """Every conversation's faults after damage, its cheapest repair, and the digest of what that leaves."""
    conversations = table(spark, folder, "conversations")
    return repair.report(conversations, repair.damaged(conversations))


#: Nodes are paths of digests; the totals come from each node's smallest member, whose path passes all nodes above it. The list is a CRC-32, bit by bit.
TRIE_SQL = """WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
  sha256(len(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos FROM conversations WHERE conv_id IS NOT NULL),
 b AS (SELECT DISTINCT conv_id, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS bits FROM t),
 c AS (SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], bits), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 6 AS h FROM b),
 r AS (SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
  UNION ALL SELECT t.conv_id, 1, pos, role, text FROM t JOIN c ON c.conv_id = t.conv_id WHERE pos > h),
 s AS (SELECT conv_id, len(text) AS chars, row_number() OVER w AS d, string_agg(sha256(len(role)::VARCHAR || ':' || role || text), '') OVER w AS path FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
 p AS (SELECT conv_id, 0 AS d, '' AS path, 0 AS chars FROM c UNION ALL SELECT conv_id, d, path, chars FROM s),
 n AS (SELECT path, min(conv_id) AS conv_id, max(d) AS depth, count(*) AS n_convs, max(chars) AS chars, CASE WHEN path <> '' THEN left(path, len(path) - 64) END AS parent FROM p GROUP BY path),
 k AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
 v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * chars AS saved FROM n LEFT JOIN k ON k.parent = n.path),
 u AS (SELECT p.path, sum((v.n_children = 0)::INT) AS n_leaves, sum(v.saved) AS saved_tokens FROM v JOIN p ON p.conv_id = v.conv_id AND p.d <= v.depth GROUP BY p.path),
 e AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM (SELECT conv_id, arg_max(path, d) AS path FROM p GROUP BY conv_id) GROUP BY path)
 SELECT v.conv_id, v.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256 FROM v JOIN u ON u.path = v.path LEFT JOIN e ON e.path = v.path LEFT JOIN n AS a ON a.path = v.parent"""


@register("op13_trie", TRIE_SQL)
def op13_trie(spark, folder):
    """Every node of the prefix trie of the rebuilt conversations."""
    turns = settled(trie.placed(table(ready(spark), folder, "conversations")), "turns")
    return trie.prefix_trie(trie.rebuilt(turns))
