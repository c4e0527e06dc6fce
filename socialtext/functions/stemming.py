"""Suffix stripping on the distinct words of an Arrow batch.

The stemmer follows M. F. Porter, "An algorithm for suffix stripping" (1980).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import functions as F, types as T

_CONS = "[^aeiou]"
_VOWEL = "[aeiouy]"
_MEASURE_0 = re.compile(rf"^(?:{_CONS}[^aeiouy]*)?{_VOWEL}[aeiou]*{_CONS}")
_MEASURE_1_ONLY = re.compile(rf"^(?:{_CONS}[^aeiouy]*)?{_VOWEL}[aeiou]*{_CONS}[^aeiouy]*(?:{_VOWEL}[aeiou]*)?$")
_MEASURE_2 = re.compile(rf"^(?:{_CONS}[^aeiouy]*)?{_VOWEL}[aeiou]*{_CONS}[^aeiouy]*{_VOWEL}[aeiou]*{_CONS}")
_HAS_VOWEL = re.compile(rf"^(?:{_CONS}[^aeiouy]*)?{_VOWEL}")
_SHORT_END = re.compile(rf"^{_CONS}[^aeiouy]*{_VOWEL}[^aeiouwxy]$")

# Suffix tables of the published steps 2, 3 and 4.
_STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"),
          ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
          ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
          ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti",
          "ous", "ive", "ize"]


def _longest(word: str, suffixes) -> str | None:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else None


def porter_stem(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    first_y = w[0] == "y"
    if first_y:  # a leading y is a consonant
        w = "Y" + w[1:]

    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]

    if w.endswith("eed"):
        if _MEASURE_0.match(w[:-3]):
            w = w[:-1]
    else:
        cut = next((s for s in ("ed", "ing") if w.endswith(s) and _HAS_VOWEL.match(w[: -len(s)])), None)
        if cut:
            w = w[: -len(cut)]
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif re.search(r"([^aeiouylsz])\1$", w):
                w = w[:-1]
            elif _SHORT_END.match(w):
                w += "e"
    if w.endswith("y") and _HAS_VOWEL.match(w[:-1]):
        w = w[:-1] + "i"

    for table in (_STEP2, _STEP3):
        suffix = _longest(w, [s for s, _ in table])
        if suffix and _MEASURE_0.match(w[: -len(suffix)]):
            w = w[: -len(suffix)] + dict(table)[suffix]

    suffix = _longest(w, _STEP4)
    if suffix:
        if _MEASURE_2.match(w[: -len(suffix)]):
            w = w[: -len(suffix)]
    elif re.search("[st]ion$", w) and _MEASURE_2.match(w[:-3]):
        w = w[:-3]

    if w.endswith("e"):
        stem = w[:-1]
        if _MEASURE_2.match(stem) or (_MEASURE_1_ONLY.match(stem) and not _SHORT_END.match(stem)):
            w = stem
    if w.endswith("ll") and _MEASURE_2.match(w):
        w = w[:-1]
    return "y" + w[1:] if first_y else w


def map_distinct(tokens: pa.Array, convert) -> pa.Array:
    """Apply ``convert`` once to each distinct token of a batch of token lists."""
    if isinstance(tokens, pa.ChunkedArray):
        tokens = tokens.combine_chunks()
    coded = tokens.flatten().dictionary_encode()
    mapped = pa.array([None if t is None else convert(t) for t in coded.dictionary.to_pylist()], pa.string())
    offsets = [0]
    for n in tokens.value_lengths().to_pylist():
        offsets.append(offsets[-1] + (n or 0))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), mapped.take(coded.indices))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stem the alphabetic tokens; each distinct word of a batch is stemmed once."""
    return map_distinct(tokens, lambda t: porter_stem(t) if t.isalpha() else t)
