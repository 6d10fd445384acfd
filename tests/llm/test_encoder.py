import numpy as np
import public_tokenizers
import pyarrow as pa

from docgroups.llm import packing

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_flat_ids_equal_the_tokenizer(monkeypatch):
    encode = packing.Encoder(BYTE_BPE)
    texts = ["", "a b c b a", " b", "a  b", "日本 語 é", "b", "x <|endoftext|> y", "a b"]
    for limit in (packing.CACHE_IDS, 3):  # with the second, what was learned is dropped before each call
        monkeypatch.setattr(packing, "CACHE_IDS", limit)
        for part in (texts, texts[::-1], [], ["", ""], ["a"], texts):
            ids, at = encode.flat(pa.array(part, pa.string()))
            assert [ids[a:b].tobytes() for a, b in zip(at, at[1:])] == encode.ids(part) and len(at) == len(part) + 1


def test_pieces_of_empty_null_and_long_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 30 + "end"), (4, "a")], "doc_id long, text string")
    rows = packing.pieces(docs, BYTE_BPE, capacity=8).orderBy("doc_id", "piece").collect()
    ids = {i: packing.Encoder(BYTE_BPE).ids([t])[0] + b"\2\0\0\0" for i, t in ((1, ""), (2, ""), (3, "word " * 30 + "end"), (4, "a"))}
    for i, want in ids.items():
        mine = [r for r in rows if r["doc_id"] == i]
        assert b"".join(bytes(r["ids"]) for r in mine) == want and [r["piece"] for r in mine] == list(range(len(mine)))
        assert all(r["length"] == len(r["ids"]) // 4 == 8 for r in mine[1:]) and [r["start"] for r in mine] == np.cumsum([0, *(r["length"] for r in mine)])[:-1].tolist()
