"""Disguised words are restored: spaced signs, split words, and signs at a word's end."""

import pytest

from tests.llm.cases import documents
from tidemill.llm import toxicity

PLAIN = "the idiot said trash and useless words to a moron in the old house with an ass and asses " * 3


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.costs(toxicity.trigrams(documents(spark, [(1, PLAIN)])).collect())


def restored(text, model):
    return set().union(*(toxicity.readings(t, model) for t in toxicity.tokens_of(text)))


@pytest.mark.parametrize("text, word", [("an i d i 0 t here", "idiot"), ("such t r 4 s h", "trash"), ("i.d.1.o.t", "idiot"), ("i d i o t", "idiot")])
def test_set_apart(model, text, word):
    assert word in restored(text, model)


@pytest.mark.parametrize("text, word", [("idio7", "idiot"), ("idio+", "idiot"), ("a$$", "ass"), ("@$$", "ass"), ("useles$", "useless"), ("the&&&", "the"), ("m0r0n", "moron")])
def test_signs_anywhere(model, text, word):
    assert word in restored(text, model)


@pytest.mark.parametrize("text", ["so tr ash it", "id iot", "an id i ot", "tr 4sh"])
def test_split_words(model, text):
    vector = toxicity._vectors({"=idiot": 3.0, "=trash": 3.0}, model)
    assert vector(text)[0] == 3.0
    assert vector("the old house said to a")[0] == 0.0


def test_long_words_are_counted(spark):
    grams = {r.gram: r.n for r in toxicity.trigrams(documents(spark, [(1, "q" * 60 + " ab")])).collect()}
    assert grams["qqq"] == 58 and grams["^ab"] == 1


def test_pieces_are_read_once(model, monkeypatch):
    """A piece that is part of many split words is decoded once in a task."""
    seen, reading_of = [], toxicity.reading

    def watched(token, characters):
        seen.append(token)
        return reading_of(token, characters)

    monkeypatch.setattr(toxicity, "reading", watched)
    vector = toxicity._vectors({"=idiot": 3.0, "=trash": 3.0}, model)
    assert vector("id iot, 1d iot, id 10t, tr ash, tr 4sh")[0] == 3.0
    assert seen.count("id") == seen.count("iot") == seen.count("tr") == 1
