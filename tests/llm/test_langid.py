import itertools

import numpy as np
from pyspark.sql import functions as F

from lexispark.llm import langid as L

TEXTS = {
    "en": "the cat and the dog were in the house with the man who is here and that was what they thought of it",
    "de": "der hund und die katze waren in dem haus mit einem mann und das ist nicht was sie sich gedacht haben",
    "fr": "le chien et le chat sont dans la maison avec un homme qui est là et ce que nous avons pensé de cela",
}


def rows(n=40):
    words = {k: t.split() for k, t in TEXTS.items()}
    return [(i, " ".join(words[k][(i + j * 7) % len(words[k])] for j in range(30)), k) for i, k in zip(range(n * 3), itertools.cycle(TEXTS))]


def test_forward_sums_all_segmentations():
    m = L.fit([(lang, text) for lang, text in TEXTS.items()])
    pieces = m.vocabulary.pieces

    def brute(word):
        if not word:
            return np.ones(len(m.languages))
        out = np.zeros(len(m.languages))
        for k in range(1, len(word) + 1):
            if word[:k] in pieces:
                out += m.p[pieces[word[:k]]] * brute(word[k:])
            elif k == 1:
                out += m.p[-1] * brute(word[1:])
        return out

    for word in (" the", " katze", " ça", " x你b"):
        expected = np.log(brute(word))
        assert np.allclose(m.words([word])[0], expected)
        assert np.allclose(L.long_word(word, m.vocabulary.prefixes, m.p, len(m.p) - 1), expected)
    long = " " + "thecat" * 100
    assert np.isfinite(m.words([long])).all()


def test_em_raises_the_likelihood():
    one, four = (L.fit([("en", TEXTS["en"])], rounds=r) for r in (1, 4))
    total = lambda m: m.words(L.letters(TEXTS["en"])).sum()
    assert total(four) > total(one)


def test_held_out_accuracy_and_edges(spark, docs):
    extra = [(900, None), (901, ""), (902, "12 34 !!"), (903, "the " * 30_000), (904, "LE CHIEN ET LE CHAT SONT DANS LA MAISON")]
    frame = docs(rows() + extra)
    out = {x.doc_id: x for x in L.identify(frame).collect()}
    truth = {r[0]: r[2] for r in rows()}
    held = [i for i in truth if out[i].held_out]
    assert held and all(out[i].lang_pred == truth[i] for i in held)
    assert all((out[i].lang_pred, out[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert out[903].lang_pred == "en" and out[904].lang_pred == "fr" and all(0 <= x.score <= 1 for x in out.values())


def test_no_labels_and_no_rows(spark, docs):
    assert {x.lang_pred for x in L.identify(docs([(1, "abc"), (1, "abc")])).collect()} == {"und"}
    assert L.identify(docs([])).count() == 0


def test_clashing_columns(spark, docs):
    m = L.fit(list(TEXTS.items()))
    out = L.predict(docs([(1, TEXTS["de"])]).withColumn("score", F.lit("x")), m).first()
    assert out.lang_pred == "de" and isinstance(out.score, float)


def test_letters_are_of_category_l():
    from lexispark.llm.langid import letters

    assert letters("½ ² Ⅷ ৹ 12 ٣ _ 漢") == [" 漢"] and letters("aⅧb½") == [" a", " b"]


def test_words_of_any_length_are_summed_alike():
    from lexispark.llm.langid import Edges, long_word

    m = L.fit([("en", "the cat sat on the mat"), ("de", "die katze sitzt auf der matte " + "x" * 500)])
    words = [" cat", " " + "漢" * 46, " thecatsatonthematthecatsatonthematthecatsatont"]
    lattice = Edges(words, m.vocabulary.prefixes, len(m.p) - 1)
    assert lattice.longest <= 48
    for w, a in zip(words, m.words(words), strict=True):
        assert np.allclose(a, long_word(w, m.vocabulary.prefixes, m.p, len(m.p) - 1), rtol=1e-9)
    assert np.isfinite(m.words([" " + "漢" * 48, " " + "漢" * 4000])).all()
