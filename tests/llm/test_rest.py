"""Search, mixing, archives, quality, pseudonyms and the corpus pipeline."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import COLUMNS, ODD
from conftest import SMALL

from gridloom.llm import mixing, pii, quality, shared, topk, warc
from gridloom.llm.registry import ORACLES, QUERIES
from gridloom.llm.shared import before, documents, join_skewed, workspace


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, spark, tables, same_rows):
    same_rows(QUERIES[name](spark, SMALL), tables.sql(ORACLES[name]))


def test_prefix_sums(spark):
    df = spark.range(500).selectExpr("id % 3 AS k", "id", "id * 7 % 5 AS v")
    rows = sorted(tuple(r) for r in before(df, ["k"], "id", "v", 499, "b", fan=4).select("k", "id", "v", "b").collect())
    total = Counter()
    for k, _, v, b in rows:
        assert b == total[k]
        total[k] += v
    assert len(rows) == 500


def test_skewed_join_keeps_rows(spark):
    left = spark.createDataFrame([("hot", i) for i in range(3000)] + [("a", 1), ("none", 2)], "k string, i int")
    right = spark.createDataFrame([("hot", 1, 3000), ("a", 2, 1)], "k string, v int, n long")
    got = Counter((r.k, r.v) for r in join_skewed(left, right, "k", "n", 3002, left.i).collect())
    assert got == {("hot", 1): 3000, ("a", 2): 1, ("none", None): 1}


def test_topk_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [5.0]), (50, []), (7, []), (8, [3e30, -3e30])]
    df = topk.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert sorted(r.vec_id for r in df.collect()) == [0, 1, 1, 6, 7, 8, 50]
    got = sorted(tuple(r) for r in topk.top_k(df.where("vec_id % 50 = 0"), df, 2).collect())
    assert got == [(0, 1, 1, 5), (0, 2, 1, 5), (50, 1, 7, 0)]
    assert topk.top_k(df.where("vec_id = 6"), df, 2).count() == 0 and topk.top_k(df.limit(0), df.limit(0), 2).count() == 0


def test_topk_over_shards_blocks_and_tiles(spark, monkeypatch):
    for name, n in (("SHARD", 7), ("BLOCK", 3), ("TILE", 4), ("FAN", 2)):
        monkeypatch.setattr(topk, name, n)
    rng = random.Random(4)
    rows = [(rng.randrange(60), [float(rng.randint(-3, 3)) for _ in range(3)]) for _ in range(120)] + [(7, [1.0, 2.0, 3.0])] * 20
    df = spark.createDataFrame(rows, "vec_id long, x array<double>").repartition(3)
    got = Counter(tuple(r) for r in topk.top_k(df.where("vec_id % 5 = 0"), df, 4).collect())
    want = Counter()
    for q in {i for i, _ in rows if i % 5 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j) for i, x in rows if i == q for j, y in rows if j != q)
        want.update((q, rank, j, int(-s)) for rank, (s, j) in enumerate(scores[:4], 1))
    assert got == want


def test_small_join_beyond_broadcast(spark, monkeypatch):
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 2)
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("b", 1), (None, 2), ("none", 3)], "k string, i int")
    small = spark.createDataFrame([("hot", 1), ("b", 2), ("c", 3), ("d", 4)], "k string, v int")
    for how in ("left", "inner"):
        got = Counter((r.k, r.v) for r in shared.join_small(left, small, ["k"], how).collect())
        assert got == {("hot", 1): 500, ("b", 2): 1} | ({(None, None): 1, ("none", None): 1} if how == "left" else {})


def test_topk_exact_beyond_floats():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0], [2.0**30, 3.0]])
    assert topk.products(a, b).tolist() == [[2**60 + 1, (1 << 63) - 1]]
    rng = np.random.default_rng(0)
    scores, ids = rng.integers(-3, 3, (20, 50)), np.arange(50)
    r, c = topk.best(scores, ids, 7)
    for i in range(20):
        want = sorted(range(50), key=lambda j: (-scores[i, j], j))[:7]
        assert sorted(c[r == i].tolist()) == sorted(want)


def test_mix_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, COLUMNS)
    docs, sources, pieces = mixing.mix(df, workspace(spark, "m"))
    by = {r.key: r for r in sources.collect()}
    size = Counter()
    for r in ODD:
        size["n" if r[3] is None else "s" + r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    assert {k: r.source_size for k, r in by.items()} == dict(size)
    assert math.isclose(sum(r.target for r in by.values()), 1.5 * sum(size.values()))
    taken = Counter()
    slots = [r.asDict() for r in pieces.collect()]
    for r in slots:
        taken[r["key"]] += r["words"]
        assert 0 < r["words"] <= mixing.BLOCK
    assert {k: taken[k] for k in by} == {k: r.take for k, r in by.items()}
    assert docs.count() == len(ODD)
    again = mixing.mixed_documents(df)
    assert again.columns == df.columns and again.count() > 0
    assert mixing.mixed_documents(df.limit(0)).count() == 0 and mixing.mix(df.limit(0), workspace(spark, "m"))[2].count() == 0


def test_mix_of_blank_texts(spark):
    for texts in ([None, None], ["", " \n"], [None]):
        df = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
        docs, sources, pieces = mixing.mix(df, workspace(spark, "m"))
        assert docs.count() == len(texts) and pieces.count() == 0 and mixing.mixed_documents(df).count() == 0
        assert {(r.source_size, r.target, r.take) for r in sources.collect()} == {(0, 0.0, 0)}


def plain_mix(rows):
    """(doc_id, text) as often as closed-form passes over shuffled streams take most of them; rows: (doc_id, text, source)."""
    hash_ = lambda r: hashlib.md5(f"mix:{'' if r[0] is None else r[0]}:{'' if r[1] is None else hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest()
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sources = sorted({r[2] for r in rows}, key=lambda k: (k is None, k or ""))
    weight = {k: (3, 1, 2)[i % 3] for i, k in enumerate(sources)}
    total = {k: sum(size(r) for r in rows if r[2] == k) for k in sources}
    capped: set = set()
    while True:
        free = [k for k in sources if k not in capped]
        rest = 1.5 * sum(total.values()) - sum(2 * total[k] for k in capped)
        target = {k: 2.0 * total[k] if k in capped else rest * weight[k] / sum(weight[f] for f in free) for k in sources}
        over = {k for k in free if target[k] > 2 * total[k]}
        if not over:
            break
        capped |= over
    out = Counter()
    for k in sources:
        at, take = 0, min(math.floor(target[k] + 0.5), 2 * total[k])
        for r in sorted((r for r in rows if r[2] == k), key=lambda r: (hash_(r), size(r))):
            for epoch in range(2):
                begin = at + epoch * total[k]
                out[r[0], r[1]] += 2 * max(0, min(begin + size(r), take) - begin) > size(r)
            at += size(r)
    return +out


def test_mixed_documents_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [(i if i % 9 else None, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(0, 4000))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    rows += [(77, f"one id {i} " * (i % 7), "b") for i in range(200)]
    got = mixing.mixed_documents(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == plain_mix(rows)


def test_schedule_is_even(spark):
    sizes = spark.createDataFrame([(k, n) for k, n in (("sa", 900_000), ("sb", 900_000), ("sc", 900_000))], "key string, size long")
    sources = mixing.targets(sizes)
    n = sources.agg({"slots": "sum"}).first()[0]
    rows = [r.key for r in mixing.schedule(sources, n).orderBy("slot").collect()]
    share = {r.key: r.slots / n for r in sources.collect()}
    for stop in (n // 10, n // 3, n):
        got = Counter(rows[:stop])
        assert all(abs(got[k] - s * stop) <= 8 for k, s in share.items())


def test_archives(spark):
    fake = "a" * 700 + "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n<html>" + "é" * 500
    rows = [(1, "u\n v", fake), (2, None, fake), (3, "", None), (4, "b", "WARC/1.1\r\nContent-Length: 20\r\n\r\n"), (None, "c", fake), (5, "d", "x" * 999), (6, "d", "x" * 999), (7, "z", "WARC/1.1\r\n"), (8, "z", fake), (8, "z", fake)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size, parts in ((37, 1), (5000, 2), (warc.RANGE, 3)):
        folder = workspace(spark, "w")
        got = warc.read_archives(warc.write_archives(pages.coalesce(1).repartition(parts), folder), folder, range_bytes=size).collect()
        payload = lambda r: (r[2] or "").encode()
        want = Counter((r[0], len(payload(r)), hashlib.sha1(payload(r)).hexdigest(), *(("revisit", 8) if r[2] == fake and r[0] != 8 else ("response", None))) for r in rows)
        assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
        assert all(r.record_type == "revisit" or bytes(r.payload) in {payload(x) for x in rows} for r in got)
    folder = workspace(spark, "w")
    assert warc.read_archives(warc.write_archives(pages.limit(0), folder), folder).count() == 0


def test_archives_lose_no_record(spark, tmp_path):
    """Headers of megabytes, files closed early, hostile payloads; a file cut short is an error."""
    lines = "WARC/1.1\r\nContent-Length: 3\r\nX: WARC/1.1\r\n"
    rows = [(0, "a", lines * 300), (1, "u" * 5_000_000, "long"), (2, "b", "x" * 2000), (3, "é" * 800_000, "more"), (4, "c", None), (5, "d", "x" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}"
    for size in (1, 3_000_000, warc.FILE_BYTES):
        files = warc.write_archives(pages.coalesce(1), folder, file_bytes=size)
        assert files.count() == {1: 6, 3_000_000: 3}.get(size, 1)
        got = {r.page_id: (r.payload_bytes, r.refers_to) for r in warc.read_archives(files, folder, range_bytes=100_000).collect()}
        assert got == {i: (len((html or "").encode()), 5 if i == 2 else None) for i, _, html in rows}
    name = tmp_path / files.first().file
    whole = name.read_bytes()
    last = whole.rfind(warc.MAGIC)
    for cut, kind in ((len(whole) - 1, Exception), (last, ValueError), (last + 20, ValueError), (6_000_000, Exception)):
        name.write_bytes(whole[:cut])
        with pytest.raises(kind):
            warc.read_archives(files, folder, range_bytes=100_000).collect()
    name.write_bytes(whole)
    assert warc.read_archives(files, folder).count() == len(rows)


def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    rng = random.Random(0)
    texts = [r[1] for r in ODD] + ["".join(rng.choice("ab é\n\t#|\x0b\x1c") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    assert all(quality.text_stats(t)[:5] == plain_stats(t) for t in texts)


def test_quality_judges(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    clean = [" ".join(word() for _ in range(rng.randint(60, 900))) for _ in range(260)]
    junk = [" ".join(w + "###" for w in t.split()) for t in clean[:6]]
    rows = [(i, t, "en", f"s{i % 2}", None, None, "x", 7, 8, 9) for i, t in enumerate(clean + junk)] + ODD
    df = spark.createDataFrame(rows, COLUMNS)
    got = {r.doc_id: r for r in quality.quality(df).collect() if r.doc_id is not None}
    assert all(got[i].kept for i in range(9, 260)) and not any(got[i].kept for i in range(260, 266))
    for i in range(9, 266):
        n, _, _, _, repeat = plain_stats(rows[i][1])
        assert got[i].base_failed == (n < 50 or 100 * repeat > 50 * n)
    kept = quality.kept_documents(df)
    assert kept.columns == df.columns and kept.where("doc_id >= 260").count() == 0 and kept.where("doc_id between 9 and 259").count() == 251
    small = spark.createDataFrame(ODD, COLUMNS)
    assert quality.quality(small).count() == len(ODD) and quality.quality(small.limit(0)).count() == 0
    assert quality.kept_documents(small.limit(0)).count() == 0


def test_estimate_is_the_covariance():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(4000, quality.DIM)) * 3 * quality.UNIT).astype(int)
    mean, inverse = quality.estimate(len(x), x.sum(0).tolist(), [int((x[:, i] * x[:, j]).sum()) for i, j in quality.PAIRS], 0.975)
    cov = np.cov(x.T, bias=True) / quality.UNIT**2 * quality._consistency(0.975) + np.diag(np.square(list(quality.FLOORS.values())))
    assert np.allclose(mean, x.mean(0) / quality.UNIT) and np.allclose(np.linalg.inv(cov).ravel(), inverse)
    assert math.isclose(quality.chi2_quantile(0.95, 5), 11.0705, rel_tol=1e-4) and math.isclose(quality.chi2_cdf(3.0, 2), 1 - math.exp(-1.5))


def plain_feistel(a, b, ra, rb, kind, key):
    def moved(half, radix, other, turn):
        seed = f"{key}|{kind}|{turn}|{','.join(map(str, other))}|"
        return [(x + int(hashlib.sha256(f"{seed}{i}".encode()).hexdigest()[:12], 16)) % r for i, (x, r) in enumerate(zip(half, radix, strict=True))]

    for turn in range(pii.ROUNDS):
        if turn % 2 == 0:
            a = moved(a, ra, b, turn)
        else:
            b = moved(b, rb, a, turn)
    return a + b


def plain_permuted(text, alphabets, kind):
    of = [next((a for a in alphabets if c in a), c) for c in text]
    values, radices, half = [a.index(c) for a, c in zip(of, text, strict=True)], [len(a) for a in of], -(-len(text) // 2)
    got = plain_feistel(values[:half], values[half:], radices[:half], radices[half:], kind, pii.KEY)
    return "".join(a[v] for a, v in zip(of, got, strict=True))


def luhn(s):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", s))]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def iban(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.pseudonymized(df).orderBy("doc_id").collect()]


def test_pseudonyms_keep_formats(spark):
    texts = ["x und.34@mail7.example.com, É.ré.78@mail3.example.com.", "+1 (017) 555-7713", "233.254.104.120 999.1.1.1", "4111 1111 1111 1111 and 4111111111111112", "DE89370400440532013000 GB82 WEST 1234 5698 7654 32", "2021-02-28 2021-02-30 31.12.1999 12/31/1999", "123-45-6789 000-12-3456", 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"', None, "", "plain 12 3.4"]
    got = replaced(spark, texts)
    assert got[8:] == texts[8:]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[7]) and got[7] != texts[7]
    for before_, after in zip(texts[:7], got, strict=False):
        kind = lambda s: re.sub(r"[^\W\d_]", "a", re.sub(r"\d+" if "." in s else r"\d", "0", s))
        assert before_ != after and kind(before_) == kind(after)
    o = plain_feistel([233, 254], [104, 120], [256] * 2, [256] * 2, "ip", pii.KEY)
    assert got[2] == ".".join(map(str, o)) + " 999.1.1.1"
    assert luhn(got[3][:19]) and got[3].endswith("4111111111111112") and all(map(iban, (got[4][:22], got[4][23:])))
    body = plain_permuted("4111 1111 1111 111", [pii.DIGITS], "card")
    assert got[3].startswith(body)
    assert got[0].split()[1] == plain_permuted("und.34@mail7.example", pii.ALPHABETS, "email") + ".com,"
    assert got[1] == "+1 " + plain_permuted("(017) 555-7713", [pii.DIGITS], "phone")
    assert "2021-02-30" in got[5] and "000-12-3456" in got[6]
    assert replaced(spark, texts) == got


def test_pseudonyms_are_permutations(spark):
    octets = [f"10.0.{i}.{j}" for i in range(20) for j in range(20)]
    assert len(set(replaced(spark, octets))) == 400
    days = [f"2001-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 29)]
    out = replaced(spark, days)
    assert len(set(out)) == len(days) and all(re.fullmatch(r"\d{4}-\d\d-\d\d", d) for d in out)
    both = replaced(spark, ["mail a.b12@c.org", "again: a.b12@c.org!"])
    assert both[0].split()[1] == both[1].split()[1].rstrip("!")


def test_pseudonyms_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, COLUMNS)
    assert Counter((r.doc_id, r.text) for r in pii.pseudonymized(df).collect()) == Counter((r[0], r[1]) for r in ODD)
    assert pii.pseudonymized(df.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as c

    assert [n for n, _ in c.STAGES] == ["quality", "near_dedup", "pii", "mixing", "packing"]
    docs = documents(spark, SMALL)
    out = c.run(spark, SMALL).collect()
    kept = {r.doc_id for r in quality.kept_documents(docs).collect()}
    assert out and {r.doc_id for r in out} <= kept
    odd = spark.createDataFrame(ODD, COLUMNS)
    for _, stage in c.STAGES[:-1]:
        assert stage(spark, odd, SMALL).columns == odd.columns
        assert stage(spark, odd.limit(0), SMALL).count() == 0
