"""Piece encoding against the public library: ids, spans and texts, under several normalisers."""

import itertools
import random
from array import array
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2, sentencepiece_pb2

from parcelry.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(n, seed=3):
    rnd = random.Random(seed)
    parts = ["a", "e", "the", "ing", " ", "  ", "\n", "\r", "\x1c", "\x85", "\xa0", "é", "é", "漢", "😀", "'s", "1", "²", "_", "!", "\0", "<s>", "<0x41>", "zz" * 20, "▁", " ▁", "    ", "�", "ﬁ", "ｶﾞ", "Å", "　", "½", "ㄱ"]
    for _ in range(n):
        yield "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        yield "".join(chr(rnd.choice([rnd.randint(0, 0x3000), rnd.randint(0xE000, 0x10FFFF)])) for _ in range(rnd.randint(0, 30)))


def agree(model, library, text):
    ids, spans = model.encode(text)
    proto = sentencepiece_pb2.SentencePieceText()
    proto.ParseFromString(library.encode(text, out_type="serialized_proto"))
    ids, spans = list(array("I", ids)), array("I", spans)
    assert ids == [1, *(p.id for p in proto.pieces), 2], repr(text)
    assert list(zip(spans[0::2], spans[1::2]))[1:-1] == [(p.begin, p.end) for p in proto.pieces], repr(text)
    assert model.decode(array("I", ids).tobytes()) == library.decode(ids), repr(text)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(MODEL)


def test_ids_spans_and_texts_of_the_given_model(model, library):
    for text in odd_texts(1500):
        agree(model, library, text)


@pytest.mark.parametrize("rules,prefix,squeeze", [*itertools.product(["nfkc", "nfkc_cf"], [True, False], [True, False]), ("identity", False, True), ("identity", True, True)])
def test_compiled_character_maps(tmp_path, rules, prefix, squeeze):
    spec = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        spec.ParseFromString(f.read())
    own = sentencepiece_model_pb2.ModelProto()
    own.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rules).serialized_model_proto())
    spec.normalizer_spec.precompiled_charsmap = own.normalizer_spec.precompiled_charsmap
    spec.normalizer_spec.add_dummy_prefix, spec.normalizer_spec.remove_extra_whitespaces = prefix, squeeze
    path = str(tmp_path / "own.model")
    with open(path, "wb") as f:
        f.write(spec.SerializeToString())
    model, library = pieces.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for text in odd_texts(300):
        agree(model, library, text)


def test_without_byte_pieces_unknown_runs_are_one(tmp_path):
    spec = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        spec.ParseFromString(f.read())
    spec.trainer_spec.byte_fallback = False
    for p in spec.pieces:
        if p.type == pieces.BYTE:
            p.type = pieces.CONTROL
    path = str(tmp_path / "plain.model")
    with open(path, "wb") as f:
        f.write(spec.SerializeToString())
    model, library = pieces.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for text in ["a 漢\U000e0001\U000e0002 b", "\0\0x", "", " "]:
        ids, _ = model.encode(text)
        assert list(array("I", ids))[1:-1] == library.encode(text)


def test_long_words_take_the_heap(model, library):
    for word in ("ab" * 20_000, "漢字仮名" * 5_000, "".join(random.Random(1).choices("abcdefghij", k=30_000))):
        agree(model, library, word)


def test_bytes_that_are_no_text(model, library):
    for ids in ([1, 198, 2], [198, 199, 35, 270], [1, 28705, 255, 3, 2], [0, 264], [], [2, 264, 1]):
        assert model.decode(array("I", ids).tobytes()) == library.decode(ids)


def test_query_gives_the_digests_of_the_library(spark, docs, nothing, library, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    found = queries.QUERIES["op12_pieces"](spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for doc_id, text in docs.select("doc_id", "text").toLocalIterator():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((doc_id, len(ids), sha256(array("I", ids).tobytes()).hexdigest(), sha256(library.decode(ids).encode()).hexdigest()))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    model = pieces.shared_model(spark, MODEL)
    assert pieces.decode(pieces.encode(nothing, model), model).count() == 0
    spans = {r.doc_id: array("I", r.spans) for r in pieces.encode(docs, model).collect()}
    assert all(s[2:-2:2][1:] == s[3:-2:2][:-1] for s in spans.values())
