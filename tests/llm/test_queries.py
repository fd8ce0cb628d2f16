"""Each registered query on odd rows and on empty tables: names, types, and a row for each row or key that the contract names."""

import zlib

import pytest

from parcelry.llm import queries

LONG, TEXT, TRUTH, INT, REAL = "bigint", "string", "boolean", "int", "double"
#: Columns that each query must return, with their types.
CONTRACT = {
    "op1_bpe": {"doc_id": LONG, "n_tokens": LONG, "ids_sha256": TEXT, "decoded_sha256": TEXT},
    "op2_packing": {"doc_id": LONG, "piece": INT, "start": LONG, "length": LONG, "ids_crc32": LONG, "sequence_id": LONG, "offset": LONG},
    "op3_mixing": {"doc_id": LONG, "held_out": TRUTH, "n_tokens": LONG, "n_known": LONG, "train_tokens": LONG, "base_score": REAL, "score": REAL, "bits_per_byte": REAL},
    "op4_quality": {"doc_id": LONG, "held_out": TRUTH, "score": REAL, "predicted": INT},
    "op5_language": {"doc_id": LONG, "held_out": TRUTH, "lang_pred": TEXT, "score": REAL},
    "op7_repeats": {"doc_id": LONG, "n_bytes": LONG, "n_removed": LONG, "n_spans": LONG, "kept_sha256": TEXT},
    "op8_rules": {"doc_id": LONG, **dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), LONG), "base_failed": TRUTH, "kept": TRUTH},
    "op9_simhash": {"doc_id": LONG, "fingerprint": TEXT, "component_id": LONG},
    "op12_pieces": {"doc_id": LONG, "n_tokens": LONG, "ids_sha256": TEXT, "decoded_sha256": TEXT},
}
MODULUS = {"op3_mixing": 10, "op4_quality": 5, "op5_language": 5}


@pytest.fixture(scope="module")
def folders(docs, nothing, labels, no_labels, tmp_path_factory):
    out = {}
    for name, rows, marks in (("odd", docs, labels), ("empty", nothing, no_labels)):
        out[name] = str(tmp_path_factory.mktemp(name))
        rows.write.parquet(f"{out[name]}/documents.parquet")
        marks.write.parquet(f"{out[name]}/labels.parquet")
    return out


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_documents(spark, docs, folders, name):
    found = queries.QUERIES[name](spark, folders["odd"])
    kinds = dict(found.dtypes)
    assert {c: kinds.get(c) for c in CONTRACT[name]} == CONTRACT[name]
    rows, ids = found.collect(), sorted((r["doc_id"] or 0) for r in docs.collect())
    if name != "op2_packing":
        assert sorted((r["doc_id"] or 0) for r in rows) == ids
    for r in rows:
        if name in MODULUS:
            assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % MODULUS[name] == 0)
        assert not (name == "op5_language" and r["doc_id"] in (3, 4, 5)) or r["lang_pred"] == "und"
        assert not (name == "op4_quality") or 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert not (name == "op9_simhash" and r["doc_id"] in (3, 4, 5)) or (r["fingerprint"], r["component_id"]) == ("0" * 16, 3)
    assert queries.QUERIES[name](spark, folders["empty"]).count() == 0


def test_pages(spark, tmp_path):
    rows = [(3, "u", "x" * 200), (1, "u" * 70_000, "x" * 200), (2, None, None), (4, "u", "short"), (5, "u", "short"), (6, "v", "é" * 60)]
    spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, record_id string").repartition(2).write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.QUERIES["op6_warc"](spark, str(tmp_path))
    assert dict(found.dtypes) == {"page_id": LONG, "payload_bytes": LONG, "payload_digest": TEXT, "record_type": TEXT, "refers_to": LONG}
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in found.collect())
    assert got == [(1, 200, "response", None), (2, 0, "response", None), (3, 200, "revisit", 1), (4, 5, "response", None), (5, 5, "response", None), (6, 120, "response", None)]


def test_vectors(spark, tmp_path):
    rows = [(k, [float(k % 7), 1.0, float(k % 3)]) for k in range(60)] + [(100, None), (120, [0.0, 0.0, 0.0]), (140, [float("nan"), 1.0, 1.0]), (160, [None, 1.0, 1.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.QUERIES["op10_neighbours"](spark, str(tmp_path))
    assert {k: dict(found.dtypes)[k] for k in ("query_id", "rank", "vec_id", "score")} == {"query_id": LONG, "rank": INT, "vec_id": LONG, "score": REAL}
    for q in (0, 20, 40):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found.where(f"query_id = {q}").collect())
        value = lambda k, q=q: sum(a * b for a, b in zip(rows[q][1], rows[k][1]))
        want = sorted((k for k in range(60) if k != q), key=lambda k: (-value(k), k))[:20]
        assert [v for _, v, _ in own] == want and [r for r, *_ in own] == list(range(1, 21))
    assert found.where("query_id > 40").count() == 0
