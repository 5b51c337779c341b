import random

import numpy as np
import pytest

from strata.llm import piece_codec as P

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def both():
    model = P.read_model(P.tokenizer_path())
    return P.PieceCodec(model), sentencepiece.SentencePieceProcessor(model_proto=model)


def texts(sp):
    r = random.Random(1)
    out = ["", " ", "  a  b ", "a\x00b", "▁a", "a▁", "<s>hi</s> <0x41>", "a" * 3000, " " * 500 + "x", "中文字符" * 300]
    out += [" " * n + w for n in range(0, 70) for w in ("", "the x", "\n")]
    letters = " ▁aabcdeth \n\t<>/012漢字éñ😀\u0301"
    out += ["".join(r.choice(letters) for _ in range(r.randint(1, 150))) for _ in range(400)]
    pieces = [sp.id_to_piece(i).replace("▁", " ") for i in range(3, 32000)]
    return out + ["".join(r.choice(pieces) for _ in range(r.randint(1, 40))) for _ in range(400)]


def test_equal_to_the_library(both):
    codec, sp = both
    t = texts(sp)
    ids, off = codec.encode(t)
    for k, x in enumerate(t):
        assert ids[off[k]:off[k + 1]].tolist() == sp.encode(x)
    assert codec.decode(ids, off) == [sp.decode(sp.encode(x)) for x in t]


def test_decodes_any_ids_like_the_library(both):
    codec, sp = both
    r = random.Random(2)
    lists = [[r.choice([0, 1, 2, 200, 259, r.randint(3, 258), r.randint(0, 31999)]) for _ in range(r.randint(0, 12))] for _ in range(800)]
    off = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    assert codec.decode(np.array([i for x in lists for i in x], np.int64), off) == [sp.decode(x) for x in lists]


def test_documents(spark, odd_docs, no_docs, both):
    _, sp = both
    path = P.tokenizer_path()
    rows = P.decode_documents(P.encode_documents(odd_docs, path), path).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert list(r["piece_ids"]) == sp.encode(r["text"] or "")
        assert r["decoded"] == sp.decode(list(r["piece_ids"]))
    both_ways = sorted((str(r["doc_id"]), r["text"], tuple(r["piece_ids"])) for r in P.round_trip(odd_docs, path).collect())
    assert both_ways == sorted((str(r["doc_id"]), r["decoded"], tuple(r["piece_ids"])) for r in rows)
    assert P.digests(odd_docs, path).count() == odd_docs.count()
    assert P.encode_documents(no_docs, path).count() == 0
