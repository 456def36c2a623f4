import numpy as np
from llm_fixtures import odd_documents

from daygrain.llm import language

TEXTS = {
    "en": "the quick brown fox jumps over the lazy dog while they were thinking about the weather with their friends".split(),
    "de": "der schnelle braune fuchs springt über den faulen hund während sie über das wetter nachdachten und nicht".split(),
    "fr": "le renard brun rapide saute par dessus le chien paresseux pendant qu'ils pensaient à la météo où été".split(),
}


def labelled(n=240):
    rng = np.random.default_rng(3)
    out = []
    for i in range(n):
        lang = list(TEXTS)[i % 3]
        out.append((i, " ".join(rng.choice(TEXTS[lang], rng.integers(4, 30))) + " 12,5 %%%", lang))
    return out


def test_held_out_accuracy_and_oddities(spark):
    odd = [(1000 + k, t, None if k % 2 else "en") for k, (_, t) in enumerate(odd_documents()) if t is None or not any(c.isalpha() for c in t)]
    rows = [*labelled(), *odd, (None, "the dog and the fox", "en"), (5, "the dog", "en"), (5, "the dog", "en")]
    docs = spark.createDataFrame([(*r, 0.0, "q") for r in rows], "doc_id long, text string, lang string, score double, lang_pred string")
    got = language.languages(docs, sample=150).collect()
    assert len(got) == len(rows)
    known = {i: lang for i, _, lang in labelled()}
    held = [r for r in got if r.held_out and r.doc_id in known]
    assert len(held) > 50 and np.mean([r.lang_pred == known[r.doc_id] for r in held]) > 0.97
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id is not None and r.doc_id >= 1000)
    assert all(0 <= r.score <= 1 for r in got) and {r.lang_pred for r in got} == {"en", "de", "fr", "und"}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "hello there", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.languages(docs).collect()] == [("und", 0.0)] * 2
    assert language.languages(docs.limit(0)).collect() == []


def test_penalties_make_weights_sparse_and_temperature_calibrates():
    rows = [(*language.grams(t), list(TEXTS).index(lang)) for _, t, lang in labelled()]
    dense, sparse = (language.Model(list(TEXTS), np.ones(language.FEATURES), np.zeros((language.FEATURES, 3)), np.zeros(3)) for _ in "ab")
    language.follow_the_regularised_leader(dense, rows, 2, l1=0.0)
    language.follow_the_regularised_leader(sparse, rows, 2, l1=0.5)
    assert sparse.zeros > dense.zeros and (sparse.weights != 0).any()
    noisy = [(u, c, label if i % 5 else (label + 1) % 3) for i, (u, c, label) in enumerate(rows)]
    sparse.temperature = language.calibrated(sparse, noisy)
    said = np.mean([language.softmax(sparse.logits(u, c) / sparse.temperature).max() for u, c, _ in noisy])
    assert abs(said - 0.8) < 0.06


def test_letters_and_grams():
    assert "".join(map(chr, language.letters("Ab1,,C é"))) == " ab c é "
    assert len(language.grams("123 %% ...")[0]) == 0 and len(language.grams(None)[0]) == 0
    used, counts = language.grams("aaa")
    assert counts.sum() == 3 + 4 + 3
