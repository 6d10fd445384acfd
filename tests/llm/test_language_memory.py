import numpy as np

from docgroups.llm import chars, language


def _model():
    rng = np.random.default_rng(0)
    return language.Model(["a", "b"], rng.normal(size=(language.BUCKETS, 2)), np.ones((chars.N_SCRIPTS, 2), bool), np.zeros(2))


def test_texts_are_scored_in_small_runs(monkeypatch):
    texts, scored, real = ["one two three " * 40, None, "", "four five six " * 70] * 500, [], language.emissions

    def emissions(model, points, starts, ends):
        scored.append(len(points))
        return real(model, points, starts, ends)

    monkeypatch.setattr(language, "emissions", emissions)
    model = _model()
    want = [x for part in language._label(model, texts, 12.0) for x in zip(*part)]
    assert max(scored) <= 200_000 and len(want) == len(texts)
    monkeypatch.setattr(language, "RUN_CHARS", 5_000)
    monkeypatch.setattr(language, "SCORED_CHARS", 1_000)
    assert [x for part in language._label(model, texts, 12.0) for x in zip(*part)] == want
