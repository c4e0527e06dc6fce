"""Importance resampling, multiset fingerprints and the filter audit against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from socialtext.llm import audit, importance, multiset

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, rank int, place int, part string"


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(11)
    words = ["alpha", "Beta", "Γάμμα", "delta9", "of", "THE", "the", "x", "É", "#tag"]
    texts = [" ".join(pick.choices(words, k=pick.randint(1, 300))) + pick.choice([".", "!?", "\n", ""]) for _ in range(40)]
    texts += [texts[0], texts[1], texts[1], None, "", "\n \n", "...", "one. two.\n three", "three\none. two.", "A" * 500, "no stop at all " * 400]
    out = [(i * 3, t, pick.choice(["a", "b", None, ""])) for i, t in enumerate(texts)]
    return [*out, (9, texts[3], "b"), (9, texts[3], "a"), (None, texts[0], "a"), (None, "solo", None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "clash") for r in rows], DOCS).repartition(4)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def _plain_resample(rows, target, longest):
    def runs(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = np.zeros(10000), np.zeros(10000)
    for _, text, *_ in rows:
        np.add.at(s, runs(text)[1], 1)
    for text in target:
        np.add.at(t, runs(text)[1], 1)
    out = []
    for i, text, *_ in rows:
        n, f = runs(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10000) / ((s[b] + 1) * (t.sum() + 10000)))) for b in f]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0], r[2]))
    return out, able


@pytest.mark.parametrize("longest,percent", [(1, 10), (1, 60), (2, 30)])
def test_resample(spark, docs, rows, longest, percent):
    target = ["the delta9 alpha of of", "É x", None, ""]
    out, able = _plain_resample(rows, target, longest)
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, longest=longest, few=2).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got))) == sorted(map(str, ((i, f, w, s) for i, _, f, w, s in out)))
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    k = percent * len(able) // 100
    assert [r["rank"] for r in drawn] == list(range(1, k + 1))
    assert [(r["doc_id"], r["score"]) for r in drawn] == [(r[0], r[4]) for r in able[:k]]


def test_resample_of_nothing(spark, docs, nothing):
    empty = spark.createDataFrame([], "text string")
    assert importance.resample(nothing, empty).count() == 0
    got = importance.resample(docs, empty, percent=0)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and got.where("rank is not null").count() == 0


def test_cutoff_is_exact(spark):
    pick = random.Random(5)
    keys = [(pick.randint(-3, 3), pick.randint(0, 1), pick.randint(0, 40), 1) for _ in range(3000)] + [(-1, 0, 7, 1)] * 1500
    table = spark.createDataFrame(keys, "_minus long, _none long, _id long, _features long").repartition(5)
    for k in (1, 2, 700, 2200, 4499, 4500):
        assert importance.cutoff(table, k, few=3, group_keys=200) == sorted(keys)[k - 1]
    assert importance.cutoff(table, 0) is None and importance.cutoff(table, 4501) is None


def _plain_print(text):
    lanes = [0] * 256
    for p in re.findall(r"[^\n.!?]*[.!?]+|[^\n.!?]+", text):
        if p.strip(" "):
            bits = int(hashlib.sha256(p.strip(" ").encode()).hexdigest(), 16)
            lanes = [v + (1 if bits >> (255 - i) & 1 else -1) for i, v in enumerate(lanes)]
    return lanes


def _cosine(a, b):
    size = sum(x * x for x in a) * sum(x * x for x in b)
    return 1.0 if a == b else max(0.0, sum(x * y for x, y in zip(a, b)) / math.sqrt(size)) if size else 0.0


@pytest.mark.parametrize("ranges", [1, 5, 200])
def test_fingerprints(docs, rows, ranges):
    got = multiset.fingerprints(docs, ranges=ranges).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r[1] or "" for r in rows if r[0] is not None and r[0] != 9}
    ids = sorted(by_id, reverse=True)
    prints = {}
    for r in got:
        prints.setdefault(r["fingerprint"], set()).add(r["doc_id"])
    for i, j in itertools.pairwise(ids):
        if 9 in range(j, i + 1) or j == 0:  # a repeated id lies between, or nulls follow
            continue
        r = next(r for r in got if r["doc_id"] == i)
        half = len(by_id[i]) // 2
        edited = by_id[i][: len(by_id[i]) - half] + by_id[j][:half]
        a, e, n = (_plain_print(t) for t in (by_id[i], edited, by_id[j]))
        assert (r["n_chars"], r["edited_sha256"]) == (len(by_id[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == multiset.text_of(np.array(a).astype(np.uint16)) and r["edited_fingerprint"] == multiset.text_of(np.array(e).astype(np.uint16))
        assert r["near_edited"] == pytest.approx(_cosine(a, e), abs=1e-6) and r["near_next"] == pytest.approx(_cosine(a, n), abs=1e-6)
    moved = {i for i, t in by_id.items() if t in ("one. two.\n three", "three\none. two.")}
    assert moved in [s & moved for s in prints.values()]  # the order of paragraphs does not count


def test_last_and_first_are_neighbours(spark, nothing):
    got = {r["doc_id"]: r for r in multiset.fingerprints(spark.createDataFrame([(1, "aaaa"), (2, "bb"), (3, "cc. dd.")], "doc_id long, text string")).collect()}
    assert got[1]["edited_sha256"] == hashlib.sha256(b"aacc").hexdigest() and got[2]["edited_sha256"] == hashlib.sha256(b"ba").hexdigest()
    one = multiset.fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    assert multiset.fingerprints(nothing).count() == 0


def test_insertion_and_deletion():
    pick = random.Random(2)
    for _ in range(300):
        text = "".join(pick.choices("ab .!\n", k=pick.randint(0, 30)))
        added, keep = "".join(pick.choices("ab .!\n", k=pick.randint(0, 10))), pick.randint(0, len(text))
        whole = multiset.total(multiset.paragraphs(text))
        assert (multiset.replaced(whole, text, keep, added) == multiset.total(multiset.paragraphs(text[:keep] + added))).all()
        assert (multiset.delete(multiset.insert(whole, ["new"]), ["new"]) == whole).all()
    assert (multiset.total(["a"] * 70_000) == multiset.total(["a"] * (70_000 - 65_536))).all()


def test_a_very_long_text(spark):
    text = "".join(f"word after {i}. " for i in range(300_000))
    rows = spark.createDataFrame([(1, text), (2, "short text. " * 30)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in multiset.fingerprints(rows).collect()}
    assert got[1]["n_chars"] == len(text) and 0 < got[1]["near_edited"] <= 1
    scores = importance.resample(rows, rows.select("text"), percent=100).collect()
    assert {r["doc_id"]: r["n_features"] for r in scores} == {1: 900_000, 2: 60}


def _plain_masks(rows, labels):
    out = []
    for n, (i, text, source) in enumerate(rows):
        text = text or ""
        w = SPACE.findall(text)
        order = (i is None, i or 0)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search("[#$%&*|]", text)),
                 any((j is None, j or 0) < order and (t or "") == text for j, t, _ in rows)]
        out.append((source or "", fails, *labels.get(i, (0, 0))))
    return out


def test_audit(spark, docs, rows, nothing):
    marks = [(0, 1, 0), (3, 0, 1), (9, 1, 1), (9, 0, 0), (30, None, 1), (None, 1, 1), (777, 1, 1), (36, 1, None)]
    labels = {}
    for i, good, toxic in marks:
        if i is not None:
            old = labels.get(i, (0, 0))
            labels[i] = (max(old[0], good or 0), max(old[1], toxic or 0))
    masks = _plain_masks(rows, labels)
    want = {}
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {m[0] for m in masks}:
            left = [m for m in masks if m[0] == part]
            every = left
            for step, letter in enumerate(order, 1):
                f = "ABCDE".index(letter)
                gone = [m for m in left if m[1][f]]
                left = [m for m in left if not m[1][f]]
                want[part, order, step] = [len(left), len(gone), sum(m[1][f] for m in every) - len(gone), sum(m[1][f] and sum(m[1]) == 1 for m in every),
                                           sum(m[2] == 1 for m in gone), sum(m[3] == 1 for m in gone), 0]
    for (part, order, step), v in want.items():
        v[-1] = sum(want[part, o, o.index(order[step - 1]) + 1][1] for o in map("".join, itertools.permutations("ABCDE")))
    table = spark.createDataFrame([(*m, 0) for m in marks], "doc_id long, quality int, toxic int, part int")
    got = audit.audit(audit.labelled_masks(docs, table)).collect()
    assert {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in got} == want and len(got) == len(want)
    assert audit.audit(audit.labelled_masks(nothing, table)).count() == 0
    bare = audit.audit(audit.labelled_masks(docs, table.limit(0)))
    assert bare.where("good_lost > 0 or toxic_lost > 0").count() == 0 and bare.count() == len(want)


def test_intervals_cover_every_order_once():
    for mask in range(1, 32):
        covered = sorted(r for m, _, a, b in audit.removal_intervals() if m == mask for r in range(a, b))
        assert covered == list(range(120))
