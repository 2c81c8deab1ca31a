"""Sources, sinks, recognition and the whole way from documents to texts, with synthetic backends."""

import json
import os

import numpy as np
from pyspark.sql import functions as F
from synthetic import Renderer, reader

from gridloom.operators import ocr
from gridloom.operators.devices import device_stats
from gridloom.plans import extraction
from gridloom.plans.rasters import drawn
from gridloom.settings import OCR_STATS, OUTCOME, PREPROCESS
from gridloom.sources import documents as s
from gridloom.sources.files import png, remove_files, text_files, write_named
from gridloom.streaming.files import arriving_documents, process_arriving


def make(folder):
    for name, seed, pages in (("a.pdf", 1, 5), ("b.pdf", 3, 4), ("c.txt", 0, 9), ("D.PDF", 0, 9)):
        (folder / name).write_text(json.dumps({"seed": seed, "pages": pages}))
    (folder / "broken.pdf").write_text("{")
    (folder / "sub").mkdir()
    (folder / "sub" / "e.pdf").write_text("{}")


def test_listing_and_rendering(spark, tmp_path):
    make(tmp_path)
    assert sorted(r.pdf_name for r in s.documents(spark, str(tmp_path)).collect()) == ["a", "b", "broken"]
    files = s.documents(spark, str(tmp_path), content=True)
    counts = {r.pdf_name: (r.n_pages, r.error is None) for r in s.page_counts(files, Renderer()).collect()}
    assert counts == {"a": (5, True), "b": (4, True), "broken": (0, False)}
    pages = s.rendered_pages(files, Renderer())
    assert sorted((r.pdf_name, r.page_no) for r in pages.select("pdf_name", "page_no").collect()) == [("a", 3), ("a", 4), ("b", 3)]
    assert s.rendered_pages(files, Renderer(), "first").count() == 2


def test_documents_to_texts(spark, tmp_path):
    make(tmp_path)
    pages = s.rendered_pages(s.documents(spark, str(tmp_path), content=True), Renderer())
    rows = extraction.document_texts(pages, reader).select("pdf_name", "voter_no", "file_name", "success", "text").collect()
    want = {"a": 4 % 7 + 5 % 7, "b": 6 % 7}
    assert {d: sorted(r.voter_no for r in rows if r.pdf_name == d) for d in want} == {d: list(range(1, n + 1)) for d, n in want.items()}
    assert all(r.success and r.text.endswith("\nend") for r in rows)


def test_two_phases_keep_accounts(spark, tmp_path):
    make(tmp_path)
    (tmp_path / "none.pdf").write_text(json.dumps({"seed": 1, "pages": 0}))
    files = s.documents(spark, str(tmp_path), content=True)
    for legacy in (False, True):
        images, stats = extraction.preprocessed(files, Renderer(), legacy)
        texts, read = extraction.read_texts(images, stats, reader, legacy)
        assert set(stats.columns) == set(PREPROCESS.fieldNames()) and set(read.columns) == set(OCR_STATS.fieldNames())
        n = {"a": 4 % 7 + 5 % 7, "b": 6 % 7, "broken": 0, "none": 0}
        got = {r.pdf_name: (r.cleaned, r.page_1_saved, r.preprocess_success, r.cleaned_dir is not None) for r in stats.collect()}
        assert got == {k: (c, k in "ab", k in "ab", k in "ab") for k, c in n.items()}
        found = {r.pdf_name: (r.ocr_successful, r.ocr_failed, r.page_1_ocr_successful) for r in read.collect()}
        assert found == {k: (n[k] + legacy, 0, True) for k in "ab"}
        assert {(r.pdf_name, r.file_name) for r in texts.where("first").collect()} == {("a", "page_1.jpg"), ("b", "page_1.jpg")}
    assert sorted(r.page_no for r in s.rendered_pages(files, Renderer(), (2, 4)).where("pdf_name = 'a'").collect()) == [2, 3]


def test_pages_without_contours_use_their_lines(spark):
    page = np.full((1400, 1400), 255, dtype=np.uint8)
    page[[250, 251, 252, 500, 501, 502], :] = 0
    page[:, [450, 451, 452, 900, 901, 902]] = 0
    row = {"pdf_name": "p", "page_no": 1, "height": 1400, "width": 1400, "channels": 1, "data": bytearray(page.tobytes())}
    df = spark.createDataFrame([row], s.PAGE)
    assert extraction.detected_blocks(df).count() > 0
    assert extraction.detected_blocks(df.limit(0)).count() == 0


def test_failures_are_rows(spark):
    rows = [(i, *x.shape, 1, bytearray(x.tobytes())) for i, x in enumerate([drawn(1), drawn(1)[:101, :50]])]
    df = spark.createDataFrame(rows, "i int, height int, width int, channels int, data binary")
    found = ocr.recognized(df, reader, ["i"])
    got = {r.i: (r.success, r.text, r.error) for r in ocr.text_of(found).collect()}
    assert got == {0: (False, None, "ValueError: a whole page"), 1: (True, "101x50\nend", None)}
    assert {r.i: r.text for r in ocr.text_of(found, legacy_unified=True).collect()}[0] == ""


def test_files_by_name(spark, tmp_path):
    df = spark.createDataFrame([("d", "voter_001", "ä\nb"), ("d", "voter_002", ""), ("e", "x", None)], "pdf_name string, stem string, text string")
    done = write_named(text_files(df), str(tmp_path)).collect()
    assert all(r.success for r in done) and (tmp_path / "d" / "voter_001.txt").read_text() == "ä\nb"
    remove_files(spark.createDataFrame(done, OUTCOME), str(tmp_path)).collect()
    assert not (tmp_path / "d").exists()


def test_images_round_trip(spark, tmp_path):
    rng = np.random.default_rng(0)
    arrays = {"g.png": rng.integers(0, 255, (7, 5), dtype=np.uint8), "c.png": rng.integers(0, 255, (4, 6, 3), dtype=np.uint8)}
    df = spark.createDataFrame([(f"doc/{k}", bytearray(png(a))) for k, a in arrays.items()] + [("doc/no.png", bytearray(b"x"))], "file_path string, content binary")
    write_named(df, str(tmp_path)).collect()
    assert s.image_files(spark, str(tmp_path), "*.png").count() == 3
    assert s.image_files(spark, str(tmp_path / "none")).count() == 0 and s.images(spark, str(tmp_path / "none")).count() == 0
    rows = s.images(spark, str(tmp_path), "*.png").collect()
    assert {r.file_name for r in rows} == set(arrays) and {r.pdf_name for r in rows} == {"doc"}
    for r in rows:
        assert (s.as_image(r.asDict()) == arrays[r.file_name]).all()


def test_stream_of_documents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    make(tmp_path / "in")
    stream = arriving_documents(spark, str(tmp_path / "in"))
    count = lambda batch: s.page_counts(batch, Renderer())
    process_arriving(stream, count, str(tmp_path / "out"), str(tmp_path / "check"), once=True).awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out")).where(F.col("n_pages") > 0).collect()
    assert sorted(r.pdf_name for r in rows) == ["a", "b"]
    assert os.path.isdir(tmp_path / "check")


def test_no_device_here():
    assert device_stats() is None or "free_memory_gb" in device_stats()


def test_command_line(spark, tmp_path):
    from gridloom.__main__ import clean_images, read_images, run_query

    card = np.full((60, 80), 255, dtype=np.uint8)
    card[20:45, 20:60] = 0
    df = spark.createDataFrame([("d/voter_001.png", bytearray(png(card))), ("d/bad.png", bytearray(b"?"))], "file_path string, content binary")
    write_named(df, str(tmp_path / "in")).collect()
    assert clean_images(spark, str(tmp_path / "in"), str(tmp_path / "out"), "*.png", True) == (1, 2)
    row = s.images(spark, str(tmp_path / "out"), "*.png").first()
    assert row.file_name == "voter_001.png" and (s.as_image(row.asDict()) == 255).all()
    assert read_images(spark, str(tmp_path / "out"), str(tmp_path / "texts"), "*.png", "synthetic:reader", 0) == (1, 1)
    assert (tmp_path / "texts" / "d" / "voter_001.txt").read_text() == "60x80\nend"
    run_query(spark, "documents_read", "/root/testdata/sf0.001", str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1
