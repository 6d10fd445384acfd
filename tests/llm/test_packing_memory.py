import numpy as np
import public_tokenizers
import pyarrow as pa

from docgroups.llm import packing


def test_texts_are_cut_in_runs_of_bounded_bytes(monkeypatch):
    texts = ["one two three " * 40, None, "", "four five six " * 70, "long " * 30_000] * 200
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    parts = list(packing.slices(batch))
    assert [x for part in parts for x in part.column("text").to_pylist()] == texts
    assert max(sum(len(x or "") for x in part.column("text").to_pylist()) for part in parts) <= packing.SLICE_BYTES + max(len(x or "") for x in texts)
    assert list(packing.slices(batch.slice(0, 0))) == []


def test_words_reach_the_tokenizer_and_ids_are_copied_in_small_runs(monkeypatch):
    encode, sizes, real = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json")), [], packing.Encoder.learn
    monkeypatch.setattr(packing.Encoder, "learn", lambda self, cuts: (sizes.append(len(cuts)), real(self, cuts)))
    texts = [" ".join(f"w{i * 7919 % 9_973}x" for i in range(at, at + 3_000)) for at in range(0, 12_000, 1_000)]
    for copied in (packing.SLICE_CUTS, 100):
        monkeypatch.setattr(packing, "SLICE_CUTS", copied)
        ids, at = encode.flat(pa.array(texts))
        assert [ids[a:b].tobytes() for a, b in zip(at, at[1:])] == encode.ids(texts)
    assert max(sizes) <= 8_000 < sum(sizes) and np.all(np.diff(at) > 0)
