"""SimHash groups and repeated substrings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import COLUMNS, LONG, ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import simhash, suffixes
from gridloom.llm.components import components
from gridloom.llm.shared import workspace


def fp(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, radius):
    """Smallest index reachable from each."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_masks_cover_every_pair(radius):
    masks = simhash.masks(radius, list(range(64)))
    rng = random.Random(radius)
    for _ in range(2000):
        flipped = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not (flipped & m) for m in masks)


def test_groups_equal_brute_force(spark):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    texts = base + [t + " q" for t in base] + [t.upper() for t in base[:20]] + [t.replace("a", "b", 1) for t in base] + base[:10]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for radius in (2, 4):
        prints = [fp(t) for t in texts]
        label = groups(prints, radius)
        rows = {r.doc_id: r for r in simhash.simhash_groups(df, radius=radius).collect()}
        assert [rows[i].fingerprint for i in range(len(texts))] == [format(p, "016x") for p in prints]
        assert [rows[i].component_id for i in range(len(texts))] == label


@pytest.mark.parametrize(("bucket", "share", "radius"), [(4096, 2000, 2), (5, 2000, 2), (5, 20, 2), (60, 2000, 3)])
def test_links_at_every_level(spark, monkeypatch, bucket, share, radius):
    """Large and hot buckets are split until they are small; bits of all places may differ, the highest too."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "HOT_SHARE", share)
    monkeypatch.setattr(simhash, "SAMPLE", 1 if share == 20 else 64)
    rng = random.Random(bucket + radius)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in [*prints][:12]:
        prints |= {p ^ sum(1 << b for b in rng.sample([63, *range(20)], rng.randint(1, 2 * radius))) for _ in range(25)}
    signed = sorted(n - (1 << 64) if n >> 63 else n for n in prints)
    edges = simhash.links(spark.createDataFrame([(n,) for n in signed], "fp long"), radius, workspace(spark, "l"))
    got = {r.node: r.label for r in components(edges, workspace(spark, "c")).collect()}
    label = groups([n & (1 << 64) - 1 for n in signed], radius)
    assert [got.get(n, n) for n in signed] == [signed[k] for k in label]


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 200) if i % 50 != 49] + [(1000, -5), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), workspace(spark, "c")).collect()}
    assert all(got[i] == i - i % 50 for i in range(200)) and got[1000] == got[-5] == -5


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, COLUMNS)
    rows = simhash.simhash_groups(df).collect()
    by = Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows)
    assert sum(by.values()) == len(ODD) and by[(5, format(fp(ODD[4][1]), "016x"), 5)] == 2
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert simhash.simhash_groups(df.limit(0)).count() == 0


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                mark[i : i + 200] = b"\1" * 200
        spans = sum(1 for i in range(len(mark)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((len(b), sum(mark), spans, hashlib.sha256(bytes(x for x, m in zip(b, mark, strict=True) if not m)).hexdigest()))
    return out


def removed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: tuple(r)[1:] for r in suffixes.remove_repeats(df).collect()}
    return [rows[i] for i in range(len(texts))]


def test_removal_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    passage = "".join(rng.choice("abc é") for _ in range(700))
    texts = []
    for i in range(60):
        t = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 900)))
        k = rng.randint(0, 600)
        texts.append(t + passage[k : k + rng.randint(100, 500)] + t[:300] * (i % 3))
    texts += ["x" * 1000, "x" * 199, "y" * 200, "y" * 200, None, "", "ab" * 400, "x" * 5000, texts[0], texts[0], "ab" * 101, "\x00" * 300]
    want = brute(texts)
    assert removed(spark, texts) == want
    monkeypatch.setattr(suffixes, "CLASS_RUNS", 3)  # hot classes by window hashes
    assert removed(spark, texts) == want
    monkeypatch.setattr(suffixes, "SAMPLE", 1)  # and counted apart, for one run in ten
    monkeypatch.setattr(suffixes, "HOT_SHARE", 10**9)
    assert removed(spark, texts) == want
    monkeypatch.setattr(suffixes, "CLASS_RUNS", 4096)
    monkeypatch.setattr(suffixes, "CLASS_BYTES", 300)
    assert removed(spark, texts) == want


def test_removal_from_long_texts(spark, monkeypatch):
    """Texts beyond a segment, a passage in thousands of texts, and runs of megabytes."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(320))
    long = "".join(rng.choice("abcdefghijkl mnop") for _ in range(1_300_000))
    texts = [long, "=" * 400_000, passage + long[700_000:1_200_000] + passage, LONG, LONG[:90_000]]
    texts += [f"{i} {passage[i % 40 :]} {i * 7}" for i in range(5000)]
    want = brute(texts)
    assert removed(spark, texts) == want
    monkeypatch.setattr(suffixes, "SAMPLE", 4)
    assert removed(spark, texts) == want


def test_removal_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, COLUMNS)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df).collect())
    assert got == Counter((r[0], *b) for r, b in zip(ODD, brute([r[1] for r in ODD]), strict=True))
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 6), st.integers(1, 300), st.randoms(use_true_random=False))
def test_suffixes_are_sorted(letters, n, rng):
    x = np.array([rng.randrange(letters) for _ in range(n + 200)], dtype=np.uint8)
    wanted = np.array(sorted(rng.sample(range(n), rng.randint(1, n))))
    order = suffixes.sort_suffixes(x, wanted)
    raw = x.tobytes()
    keys = [raw[i : i + 200] for i in order]
    assert sorted(order.tolist()) == wanted.tolist() and keys == sorted(keys)
    count = Counter(raw[i : i + 200] for i in wanted)
    assert suffixes.repeated(x, wanted).tolist() == [i for i in wanted.tolist() if count[raw[i : i + 200]] > 1]
