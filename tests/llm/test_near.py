"""Near copies by exact shingle similarity against brute force."""

import random

import numpy as np
import pytest
from cases import COLUMNS, ODD
from conftest import SMALL

from gridloom.llm import near
from gridloom.llm.shared import documents, workspace


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    """Smallest index that links of similarity 0.8 reach from each, and the number of linked pairs."""
    sets, label, pairs = [shingle_set(t) for t in texts], list(range(len(texts))), 0

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                pairs += 1
                low, high = sorted((top(i), top(j)))
                label[high] = low
    return [top(i) for i in range(len(texts))], pairs


def kept(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id for r in near.one_of_near(df).collect()}


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**6)}"
    return out


def test_stage_equals_brute_force_on_edits(spark):
    import corpus_pipeline

    rng = random.Random(3)
    texts = []
    for _ in range(40):
        base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(300)) for _ in range(rng.randint(60, 300))]
        texts += [" ".join(edited(rng, base, n)) for n in (0, 0, 1, 2, 3, 4, 5, 6)]
    rng.shuffle(texts)
    want, pairs = brute(texts)
    assert pairs > 150 and len(set(want)) > 60
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, SMALL).collect()} == set(want)


@pytest.mark.parametrize("edits", [2, 8])
def test_large_group_of_near_copies(spark, edits, monkeypatch):
    """Chains of edits and pairs just below the similarity need later rounds."""
    monkeypatch.setattr(near, "NEAREST", 1)
    monkeypatch.setattr(near, "CHUNK", 8)
    rng = random.Random(edits)
    words = [f"w{rng.randrange(500)}" for _ in range(150)]
    texts, now = [], words
    for i in range(60):
        now = edited(rng, now if i % 2 else words, edits)
        texts.append(" ".join(now))
    assert kept(spark, texts) == set(brute(texts)[0])


def test_stage_equals_brute_force_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SMALL).select("doc_id", "text").orderBy("doc_id").collect()]
    label, _ = brute([t for _, t in rows])
    got = {r.doc_id for r in near.one_of_near(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {rows[i][0] for i in set(label)}


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, COLUMNS)
    out = near.one_of_near(df)
    assert out.columns == df.columns and sorted((r.doc_id or -1) for r in out.collect()) == [-1, 1, 4, 5, 7, 8]
    assert near.one_of_near(df.limit(0)).count() == 0
    assert near.near_groups(df, workspace(spark, "n")).count() == len(ODD)


def test_a_pair_is_asked_for_in_one_bucket_only(spark, monkeypatch):
    """Texts just below the similarity meet in many tables; each pair of them is asked for once, those far below it never."""
    rng = random.Random(7)
    words = [f"w{rng.randrange(500)}" for _ in range(150)]
    texts = [" ".join(edited(rng, words, n)) for n in [2] * 10 + [6] * 25 + [16] * 25]
    asked, stage = [], near.stage

    def counted(df, path):
        out = stage(df, path)
        if "/asked-" in path:
            asked.extend((r.a, r.b) for r in out.collect())
        return out

    monkeypatch.setattr(near, "stage", counted)
    monkeypatch.setattr(near, "NEAREST", 1 << 20)
    assert kept(spark, texts) == set(brute(texts)[0])
    assert 0 < len(asked) == len(set(asked)) < 60 * 59 // 2 // 3


def test_first_table():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 64, (200, near.WORDS), dtype=np.uint64)
    flips = np.packbits(rng.random((200, 64 * near.WORDS)) < 0.1, axis=1).view(np.uint64)
    tables = [(w, np.uint64(m % (1 << 64))) for w in range(near.WORDS) for m in near._MASKS]
    first = [next((t for t, (w, m) in enumerate(tables) if not x[w] & m), None) for x in flips]
    met = [i for i, t in enumerate(first) if t is not None]
    assert len(met) > 50 and max(first[i] for i in met) > 14
    assert near.first_table(a[met] ^ (a ^ flips)[met]).tolist() == [first[i] for i in met]


def test_pairs_below_the_similarity_are_told_without_verifying_them(spark, monkeypatch):
    """In a group of texts that are all near each other, verified pairs grow with the texts and not with their square."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(500)}" for _ in range(150)]
    texts = [" ".join(edited(rng, words, 3)) for _ in range(100)]
    want, pairs = brute(texts)
    assert len(set(want)) > 60
    verified, true = [], near._verified

    def counted(pairs, sets):
        verified.extend((r.a, r.b) for r in pairs.collect())
        return true(pairs, sets)

    monkeypatch.setattr(near, "_verified", counted)
    assert kept(spark, texts) == set(want)
    assert len({frozenset(p) for p in verified}) == len(verified) < pairs + 10 * len(texts)


def test_pairs_left_by_the_first_round_are_found_later(spark, monkeypatch):
    """A first round of one pair a set, in which sets of one piece's bucket rarely are the nearest of all."""
    monkeypatch.setattr(near, "FIRST", 1)
    rng = random.Random(11)
    words = [f"w{rng.randrange(500)}" for _ in range(150)]
    texts, now = [], words
    for i in range(80):
        now = edited(rng, now if i % 4 else words, 2)
        texts.append(" ".join(now))
    assert kept(spark, texts) == set(brute(texts)[0])


def test_parity_loses_no_similar_pair():
    rng = np.random.default_rng(9)
    told = []
    for size in (1, 5, 9, 40, 150, 600, 3000):
        for differing in np.linspace(0, size // 2, 20).astype(int):
            x = np.unique(rng.integers(0, 1 << 64, size + int(differing), dtype=np.uint64))
            a, b = np.sort(rng.permutation(x)[:size]), np.sort(rng.permutation(x)[-size:])
            may = near.may_be_similar(np.array([len(a)]), near.parity(a)[None], len(b), near.parity(b))[0]
            assert may or not near.similar(a, b)
            both = len(np.intersect1d(a, b))
            if size == 150 and 4 * both < 3 * (2 * size - both):
                told.append(bool(may))
    assert told and not any(told) and near.parity(np.zeros(0, dtype=np.uint64)).tolist() == [0] * near.PARITY
