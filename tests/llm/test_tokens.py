"""Encoding, token files, packing and counts against the tokenizers library."""

import zlib

import numpy as np
import pytest
from cases import COLUMNS, LONG, ODD
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import packing, streamvbyte, tokencount
from gridloom.llm.shared import workspace
from gridloom.llm.tokens import Encoder, encoder

P = pytest.importorskip("public_tokenizers")
FILE = P.path("word_bpe_49k.json")
TRICKY = st.text(st.sampled_from(list("aAbBzZ 'sStTrReEvVmMlLdD09.,!-_<|>\t\n\x0b\x1c\x85\xa0éÉßẞÀÿİıΣσς́　中😀ﬁ")), max_size=40)


def whole(text):
    return encoder(FILE).whole.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), TRICKY, st.just("a <|endoftext|>b <|STARTOFTEXT|>")), max_size=6))
def test_encoder_equals_the_library(texts):
    ids, at = encoder(FILE).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [whole(t) for t in texts]


def test_encoder_outlives_its_cache(monkeypatch):
    monkeypatch.setattr("gridloom.llm.tokens.CACHED", 50)
    enc = Encoder(FILE)
    for k in range(3):
        text = " ".join(f"word{i * (k + 1)}, Word" for i in range(300))
        assert enc.encode([text])[0].tolist() == whole(text)


def test_other_tokenizers_encode_whole_texts():
    enc = Encoder(P.path("byte_bpe_50k.json"))
    ids, at = enc.encode(["a b  c", None, "é"])
    assert not enc.cached and at[0] == 0 and at[1] == at[2] and ids[: at[1]].tolist() == enc.whole.encode("a b  c", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1), max_size=60))
def test_coding_round_trip(values):
    v = np.array(values, dtype=np.uint64)
    control, data = streamvbyte.encode_values(v)
    assert len(control) == -(-len(values) // 4)
    assert streamvbyte.decode_values(control, data, len(values)).tolist() == values


def test_token_files(spark):
    df = spark.createDataFrame(ODD, COLUMNS).repartition(3)
    folder = workspace(spark, "t")
    files, by_rank = streamvbyte.write_tokens(df, FILE, folder)
    rows = streamvbyte.read_tokens(files, folder, by_rank).collect()
    want = sorted((r[0] is not None, r[0] or 0, len(whole(r[1])) + 1, crc([*whole(r[1]), 2])) for r in ODD)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == want
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    ids = [r.doc_id for r in ordered if r.doc_id is not None]
    assert ids == sorted(ids)
    empty, ranks = streamvbyte.write_tokens(df.limit(0), FILE, workspace(spark, "t"))
    assert streamvbyte.read_tokens(empty, folder, ranks).count() == 0


def check_pieces(rows, want, window=4096):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        ids, at = want[d], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
        total += at
    assert padding <= 0.016 * total + window


def test_packing_documents(spark):
    rows = packing.op9_packing(spark, SMALL).collect()
    check_pieces(rows, {r.doc_id: [*whole(r.text), 2] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()})


def test_packing_odd_rows(spark):
    df = spark.createDataFrame([r for r in ODD if r[0] not in (5, None)], COLUMNS).coalesce(1)
    check_pieces(packing.pack_documents(df, FILE, block_tokens=3000).collect(), {r[0]: [*whole(r[1]), 2] for r in ODD if r[0] not in (5, None)})
    assert packing.pack_documents(spark.createDataFrame(ODD, COLUMNS), FILE).where("start = 0").count() == len(ODD)
    assert packing.pack_documents(df.limit(0), FILE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.integers(1, 100))
def test_pack_is_best_fit(lengths, window):
    got = packing.pack(lengths, window, loose=window)
    parts = sorted(((n % window, d) for d, n in enumerate(lengths) if n % window), key=lambda x: (-x[0], x[1]))
    open_ = []
    for n, _ in parts:  # plain best fit decreasing
        fits = [w for w in open_ if w[0] >= n]
        if fits:
            min(fits, key=lambda w: w[0])[0] -= n
        else:
            open_.append([window - n])
    assert sorted(window - sum(p[2] for p in s) for s in got) == sorted([w[0] for w in open_] + [0] * sum(n // window for n in lengths))


def test_counts_equal_the_library(spark):
    vocab = tokencount.vocabulary(P.path("piece_bpe_32k.model"))
    full = tokencount.tokenizer(vocab)
    got = tokencount.op8_token_counts(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(texts) and all(r.n_tokens == len(full.encode(texts[r.doc_id]).ids) for r in got)
    odd = tokencount.token_counts(spark.createDataFrame(ODD, COLUMNS), P.path("piece_bpe_32k.model")).collect()
    assert sorted(r.n_tokens for r in odd) == sorted(len(full.encode(r[1] or "").ids) for r in ODD)


@settings(max_examples=300, deadline=None)
@given(st.text("abc ▁\t\x1c日", max_size=16))
def test_ties_follow_the_library(text):
    vocab = [("<unk>", 0.0)] + [(p, -1.0) for p in ("▁", "a", "b", "ab", "aa", "ba", "aab", "▁a")] + [("abab", -2.0), ("bb", -2.0)]
    assert tokencount.Counter(vocab).text(text)[1] == len(tokencount.tokenizer(vocab).encode(text).ids)


def test_long_text():
    assert len(whole(LONG)) == len(encoder(FILE).encode([LONG])[0])
