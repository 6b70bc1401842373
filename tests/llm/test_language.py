"""Language identification: phrase counts of a plain parse, scripts of many letters, many languages."""

import random

import numpy as np
import pytest

from obligato.llm import language


def plainly(model, samples, text, letters=language.LETTERS):
    """Weighed phrases per language by searching every phrase in the sampled symbols."""
    lookup = language.code_points(model.symbol_of_letter)
    symbols, costs = language.as_symbols(text, lookup).tolist(), []
    for name, bits in zip(model.languages, model.bits):
        held = [language.as_symbols(t, lookup)[:letters].tolist() for t in samples[name]]
        known = {tuple(h[i:j]) for h in held for i in range(len(h)) for j in range(i + 1, min(len(h), i + language.LANE) + 1)}
        phrases = 0
        for lane in (symbols[i:i + language.LANE] for i in range(0, len(symbols), language.LANE)):
            at = 0
            while at < len(lane):
                end = at + 1
                while end <= len(lane) and (tuple(lane[at:end]) in known and language.UNKNOWN not in lane[at:end]):
                    end += 1
                at = max(end - 1, at + 1)
                phrases += 1
        costs.append(phrases * bits / max(1, len(symbols)))
    return costs


def made(dice, letters, n):
    words = ["".join(dice.choice(letters) for _ in range(dice.randrange(1, 5))) for _ in range(60)]
    return [" ".join(dice.choice(words) for _ in range(dice.randrange(1, 60))) for _ in range(n)]


LATIN, GREEK, HAN = "abcdefghij", "αβγδεζηθικ", [chr(0x4E00 + i) for i in range(300)]


@pytest.mark.parametrize("dense", [language.DENSE, 4])
def test_phrases_are_those_of_a_plain_parse(dense):
    dice = random.Random(dense)
    samples = {"la": made(dice, LATIN, 4), "gr": made(dice, GREEK + "ab", 4), "ha": made(dice, HAN, 4)}
    model = language.Model(samples, dense=dense)
    assert model.alphabet > 62 and len(model.edge) > 0
    texts = made(dice, LATIN + GREEK, 3) + made(dice, HAN, 3) + [samples["gr"][0], "Zz 12 é αβ", "x" * 700, "".join(HAN[:90])]
    parser = language.Parser(model)
    got = parser.phrases(texts)
    for text, costs in zip(texts, got):
        assert np.allclose(costs, plainly(model, samples, text), atol=1e-9), text


def test_scripts_of_many_letters_are_told_apart(spark):
    dice = random.Random(5)
    scripts = {f"l{k}": [chr(0x4E00 + 500 * k + i) for i in range(500)] for k in range(3)} | {"la": LATIN}
    rows = [(i, t, lang) for lang, letters in scripts.items() for i, t in enumerate(made(dice, letters, 60), 1000 * int(lang[1:] or 0, 36) if lang != "la" else 9000)]
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    model = language.learn(docs)
    got = language.identify(docs, model).collect()
    truth = {i: lang for i, _, lang in rows}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) > 0.95


def test_more_languages_than_the_sample_has_room_for(spark, monkeypatch):
    monkeypatch.setattr(language, "TEXTS", 6)
    rows = [(100 * k + i, " ".join([chr(97 + k) * 3] * (i % 7 + 1)), f"l{k}") for k in range(9) for i in range(12 - k)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == [f"l{k}" for k in range(6)]
    assert model.states <= 2 * 6 * (language.LETTERS + 1)
