"""Trigrams of whole texts, counted in runs of rows."""

from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from socialtext.operators import language


def grams(text):
    clean = " " + "".join(c if c.isalpha() else " " for c in text.lower())
    clean = " " + " ".join(clean.split()) + " "
    return Counter(clean[i:i + 3] for i in range(len(clean) - 2))


@pytest.mark.parametrize("letters", [1 << 20, 7])
def test_grams_are_three_code_points(spark, monkeypatch, letters):
    # Before, letters beyond U+FFFF were cut in the middle, as every place in UTF-16 gave a trigram.
    monkeypatch.setattr(language, "LETTERS", letters)
    rows = [(1, "a", "Ab, ab ab"), (2, "b", "x\U00020000\U00020001\U00020002y"), (2, "b", "xy z"), (None, "a", "ab"), (4, "b", None), (5, None, "zz"), (6, "a", "1 2")]
    df = spark.createDataFrame(rows, "id int, lang string, text string").coalesce(1)
    wanted = {}
    for _, lang, text in rows:
        for gram, n in grams(text or "").items():
            if lang:
                wanted[lang, gram] = wanted.get((lang, gram), 0) + n
    profiles = language.fit_profiles(df, "text", "lang")
    got = {(e["language"], r["gram"]): e["c"] for r in profiles.collect() for e in r["entries"]}
    assert got == wanted
    for limit in (100, 1):
        scores = {(r["id"], r["language"]): r["score"] for r in language.language_scores(df, "id", "text", profiles, limit).collect()}
        distinct = len({g for _, g in wanted})
        own = grams("x\U00020000\U00020001\U00020002y") + grams("xy z")
        total = sum(n for (name, _), n in wanted.items() if name == "b")
        assert scores[2, "b"] == pytest.approx(sum(n * (log(wanted["b", g] + 1) - log(total + distinct)) for g, n in own.items()))
        assert {i for i, _ in scores} == {1, 2, None, 5} - ({5} if not set(grams("zz")) & {g for _, g in wanted} else set())
    guessed = {(r["id"], r["language"]) for r in language.guess_language(df.select("id", "text"), "id", "text", profiles).collect()}
    assert {(1, "a"), (2, "b"), (None, "00"), (4, "00"), (6, "00")} <= guessed


def test_wide_alphabets(monkeypatch):
    import numpy as np
    texts = ["".join(map(chr, range(0x4E00, 0x4E00 + 300))), "abc"]
    run = language._counted_run(np.array([3, 1]), np.array([300, 3]), texts)
    assert len(run[0]) == 299 and run[2].sum() == 299 and sorted(set(run[0])) == [1, 3]
    assert language._counted_run(np.array([0]), np.array([2]), ["  "])[2].sum() == 0
