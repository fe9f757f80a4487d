"""Encoding and decoding against the library, and the character map against its normaliser."""

import hashlib
import os
import random

import numpy as np
import pytest

spm = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tripledger.llm.pieces import (  # noqa: E402
    STRETCH, CharacterMap, Codec, decode, digests, encode,
)

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  a", "a  ", "Hello world", "a\tb\nc\r\n d", "▁a ▁▁ b", "  double  spaces   here",
         "<s> </s> <0x41> <unk>", "日本語のテキスト", "naïve café – “quoted”", "🙂🙃 emoji \U0010ffff",
         "x" * 5000, "ab" * 3000 + " " * 300, "\0 null", "é combining", "ᄒ" * 70, "1234567890" * 20]


def sample(seed=1):
    draw = random.Random(seed)
    alphabet = "abcdefghij  \n\t.,é▁ßñ漢🙂ABC123<>_"
    return TEXTS + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(200)))
                    for _ in range(400)]


@pytest.fixture(scope="module")
def codec():
    return Codec.load(MODEL).prepare()


def test_ids_and_text_equal_the_library(codec):
    library = spm.SentencePieceProcessor(model_file=MODEL)
    texts = sample()
    for text, (ids, written, spans) in zip(texts, codec.encode([t.encode() for t in texts])):
        ids = ids.tolist()
        assert ids == library.encode(text), text
        assert written == " ".join(map(str, ids))
        assert codec.decode([*ids, 2]) == library.decode([*ids, 2]), text
        assert len(spans) == len(ids)


def test_spans_cover_the_source_in_order(codec):
    texts = sample(2)
    for text, (_, _, spans) in zip(texts, codec.encode([t.encode() for t in texts])):
        if len(spans):
            assert spans[0, 0] == 0 and spans[-1, 1] == len(text.encode())
            assert (spans[1:, 0] >= spans[:-1, 0]).all() and (spans[:, 0] <= spans[:, 1]).all()
            inner = [(a, b) for a, b in spans.tolist()]
            assert all(b == c or (a, b) == (c, d) for (a, b), (c, d) in zip(inner, inner[1:]))


def test_character_map_replaces_the_longest_prefix():
    from sentencepiece import sentencepiece_model_pb2
    try:
        library = spm.SentencePieceNormalizer(rule_name="nmt_nfkc_cf")
        blob = sentencepiece_model_pb2.ModelProto.FromString(
            library.serialized_model_proto()).normalizer_spec.precompiled_charsmap
    except (AttributeError, RuntimeError, TypeError) as error:
        pytest.skip(f"no compiled map at hand: {error}")
    mapping = CharacterMap(blob)
    whole = Codec([], [], [], blob, True, True, 2, 0, False).prepare()
    for text in ["Ｆｕｌｌ ＷＩＤＴＨ", "ﬁne é Å ①", "plain", "  two  spaces ", "가각", "ＡΑА ㍿", "tab\tend"]:
        got, source = mapping.apply(text.encode())
        assert whole.normalise(text.encode())[0] == library.normalize(text)
        assert len(source) == len(got) and (np.diff(source) >= 0).all()


def test_frames(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (None, "a b"), (3, "a  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS id")
    library = spm.SentencePieceProcessor(model_file=MODEL)
    found = encode(docs, MODEL)
    pieces = sorted((r.id if r.id is not None else -1, tuple(r.ids)) for r in found.collect())
    assert pieces == sorted((i if i is not None else -1, tuple(library.encode(t or "") + [2]))
                            for i, t in rows)
    texts = sorted((r.id if r.id is not None else -1, r.text) for r in decode(found, MODEL).collect())
    assert texts == sorted((i if i is not None else -1, library.decode(library.encode(t or "")))
                           for i, t in rows)
    hashed = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(docs, MODEL).collect())
    assert hashed == sorted(
        (len(ids := library.encode(t or "") + [2]),
         hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
         hashlib.sha256(library.decode(ids).encode()).hexdigest()) for _, t in rows)
    assert digests(docs.limit(0), MODEL).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_whole_documents_equal_the_library(codec):
    import pyarrow.parquet as pq
    library = spm.SentencePieceProcessor(model_file=MODEL)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    for text, (ids, _, _) in zip(texts, codec.encode([t.encode() for t in texts])):
        assert ids.tolist() == library.encode(text)


def test_own_merges_equal_the_library(codec):
    library = spm.SentencePieceProcessor(model_file=MODEL)
    for text in sample(3):
        stretches = STRETCH.findall(codec.normalise(text.encode())[0])
        assert [i for s in stretches for i in codec.piece_ids(s)] == library.encode(text)
