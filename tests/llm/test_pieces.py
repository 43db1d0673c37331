"""The piece encoder against the library."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import documents, empty, texts

from foretide.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts():
    r = random.Random(1)
    signs = list(" \n\t\r'abcXéß1２。，   ~▁\ufffd\x00") + ["<0x0A>", "<s>", "</s>", "<unk>", "   ", "aaaaaa", "日本", "\U0001f600"]
    signs += ["the ", " \n", "\n ", "▁▁", "e\u0301"]
    odd = ["".join(r.choices(signs, k=r.randint(0, 30))) for _ in range(8000)]
    return odd + ["", " ", "  ", "a" * 3000, "ab" * 2000, " " * 3000, "\n" * 500, *[t or "" for _, t in texts()]]


def test_encoder_agrees_with_the_library(library):
    own, odd = pieces.Encoder(PATH), odd_texts()
    expected = library.encode(odd)
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(odd)] == expected
    assert [own.decode(i) for i in expected] == library.decode(expected)


def test_any_ids_decode_as_in_the_library(library):
    """Broken bytes, control pieces and unknown pieces among the ids too."""
    r, own = random.Random(2), pieces.Encoder(PATH)
    ids = [[r.randrange(32_000 if r.random() < 0.5 else 300) for _ in range(r.randint(0, 8))] for _ in range(8000)]
    assert [own.decode(i) for i in ids] == library.decode(ids)


def test_bounded_tables(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN", 50)
    monkeypatch.setattr(pieces, "KNOWN_PARTS", 50)
    own, again = pieces.Encoder(PATH), pieces.Encoder(PATH)
    held = [t or "" for _, t in texts()]
    assert [own.encode([t])[0] for t in held] == again.encode(held)
    assert len(own.chunks) < 5000


def test_other_models_are_refused(tmp_path):
    data = open(PATH, "rb").read()
    # The rule's fields 3 and 4 stand next to each other; white space is to be removed here.
    other = data.replace(b"\x18\x01\x20\x00", b"\x18\x01\x20\x01")
    assert other != data
    (tmp_path / "m.model").write_bytes(other)
    with pytest.raises(ValueError):
        pieces.Encoder(str(tmp_path / "m.model"))


def test_encode_and_decode(spark, library):
    docs = documents(spark)
    coded = pieces.encode(docs, PATH, decoded=True)
    expected = Counter((i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in texts())
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in coded.collect()) == expected
    back = Counter((i, t) for i, _, t in expected.elements())
    assert Counter((r.doc_id, r.text) for r in pieces.decode(coded, PATH).collect()) == back
    assert pieces.differences(docs, PATH).count() == 0
    assert pieces.encode(empty(spark), PATH, decoded=True).count() == 0


def test_query_agrees_with_the_library_on_a_whole_table(spark):
    import hashlib

    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    folder = "/root/testdata/sf0.001"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        expected.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert set(map(tuple, queries.op11_pieces(spark, folder).collect())) == expected
