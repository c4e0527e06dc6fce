"""Quality rules with suffix-array repetition inside a text.

Words become numbers, and the suffixes of all texts of a piece are sorted by prefix doubling over words (1, 2, 4, ...
words), where only suffixes that still tie are sorted again. The longest-common-prefix intervals of the finished array give
the maximal repeated substrings; the spans of those of ``LEAST_WORDS`` words or more are united. A text fails when the united spans cover more than ``COVERED`` of
its word characters or one repeat is longer than ``LONGEST`` of its words. The base rule has its own window of ``WINDOW`` words.

Words are ``[^\\x20\\x09-\\x0D]+``; null counts as a text without words, which fails the base rule. Texts never share
suffixes. Repeated rows get equal results; only ``doc_id`` and ``text`` are read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from socialtext.llm.numeric import Spans, pieces, words
from socialtext.llm.tables import prepare

#: Repeats of fewer words than this are part of ordinary language.
LEAST_WORDS = 3
#: Words of the window of the base rule.
WINDOW = 8
#: Largest part of the word characters inside repeats of a text that stays.
COVERED = 0.30
#: Largest part of the words that one repeat may have.
LONGEST = 0.25

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "kept boolean, covered double, longest_repeat long")


def suffix_array(word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the word sequences; a suffix ends with its text, and texts are kept apart by their number."""
    n = len(word)
    last = np.searchsorted(text, text, side="right")
    order = np.lexsort((word, text))
    key_changes = np.ones(n, bool)
    key_changes[1:] = (word[order][1:] != word[order][:-1]) | (text[order][1:] != text[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(key_changes, np.arange(n), 0))
    width = 1
    while True:
        # Positions in the array whose rank is shared.
        start = np.flatnonzero(key_changes)
        size = np.diff(np.append(start, n))
        tied = np.repeat(size > 1, size)
        if not tied.any():
            return order
        at = np.flatnonzero(tied)
        suffix = order[at]
        ahead = suffix + width
        after = np.where(ahead < last[suffix], rank[np.minimum(ahead, n - 1)], -1)
        moved = np.lexsort((after, rank[suffix]))
        order[at], after, group = suffix[moved], after[moved], rank[suffix[moved]]
        change = np.ones(len(at), bool)
        change[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        key_changes[at] = change
        rank[order[at]] = np.maximum.accumulate(np.where(change, at, 0))
        width *= 2


def common_words(order: np.ndarray, word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in the array, 0 across texts.

    The first words are compared one by one, all suffixes together; what still agrees then is measured by halving steps on
    hashes of word runs, so that long repeats cost the logarithm of their length.
    """
    last = np.searchsorted(text, text, side="right")
    shared = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    at = at[text[order[at]] == text[order[at - 1]]]
    for _ in range(WINDOW):
        a, b = order[at] + shared[at], order[at - 1] + shared[at]
        ok = (a < last[order[at]]) & (b < last[order[at - 1]])
        ok[ok] = word[a[ok]] == word[b[ok]]
        at = at[ok]
        shared[at] += 1
    if len(at):
        runs = Spans(word)
        most = np.minimum(last[order[at]] - order[at], last[order[at - 1]] - order[at - 1])
        step = 1 << int(most.max()).bit_length()
        while step:
            longer = shared[at] + step
            may = longer <= most
            a, b, n = order[at][may], order[at - 1][may], longer[may]
            same = runs.hash(a, a + n) == runs.hash(b, b + n)
            shared[at[may][same]] += step
            step >>= 1
    return shared


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of every text of a piece."""
    n = len(offsets) - 1
    start, end, text = words(data, offsets)
    hashes = Spans(data)
    word = hashes.hash(start, end)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = lead[end] - lead[start]
    out = {"n_words": np.bincount(text, minlength=n), "word_chars": np.bincount(text, chars, n).astype(np.int64)}
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]
    out["n_dup_lines"] = _duplicate_lines(data, offsets, start, hashes)

    order = suffix_array(word, text) if len(word) else np.zeros(0, np.int64)
    shared = common_words(order, word, text)
    position = np.empty(len(order), np.int64)
    position[order] = np.arange(len(order))
    # The longest repeat that starts at a word is its larger common prefix with either neighbour in the array.
    longest = np.maximum(shared, np.append(shared[1:], 0))[position] if len(order) else shared

    def cover(length: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(word) + 1, np.int64)
        begin = np.flatnonzero(length)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + length[begin], -1)
        return np.cumsum(edge)[:-1] > 0

    eight = cover(np.where(longest >= WINDOW, WINDOW, 0))
    out["n_repeat_words"] = np.bincount(text[eight], minlength=n)
    united = cover(np.where(longest >= LEAST_WORDS, longest, 0))
    out["covered"] = np.bincount(text[united], chars[united], n) / np.maximum(out["word_chars"], 1)
    out["longest_repeat"] = np.zeros(n, np.int64)
    np.maximum.at(out["longest_repeat"], text, longest)
    return out


def _duplicate_lines(data, offsets, start, hashes) -> np.ndarray:
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    text = np.searchsorted(offsets, begin, side="right") - 1
    stop = np.minimum(np.append(begin[1:], len(data)), offsets[text + 1])
    stop -= (data[np.maximum(stop - 1, 0)] == 10) & (stop > begin)
    full = np.searchsorted(start, stop) > np.searchsorted(start, begin)
    begin, stop, text = begin[full], stop[full], text[full]
    line = np.stack([text.astype(np.uint64), hashes.hash(begin, stop)], 1)
    first = np.unique(line, axis=0, return_index=True)[1]
    again = np.ones(len(line), bool)
    again[first] = False
    return np.bincount(text[again], minlength=n)


def assess(docs: DataFrame, covered: float = COVERED, longest: float = LONGEST) -> DataFrame:
    """``SCHEMA`` for every row. A narrow map: texts never leave their task."""
    prepare(docs.sparkSession)

    def apply(batches):
        for batch in batches:
            for first, last, data, offsets in pieces(batch):
                m = measure(data, offsets)
                failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
                kept = ~failed & (m["covered"] <= covered) & (m["longest_repeat"] <= longest * m["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first).cast(pa.int64()), *[pa.array(m[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                     pa.array(failed), pa.array(kept), pa.array(m["covered"]), pa.array(m["longest_repeat"])],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered", "longest_repeat"])

    return docs.select("doc_id", "text").mapInArrow(apply, SCHEMA)
