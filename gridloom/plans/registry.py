"""Queries by name, and DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import geometry as g
from gridloom.functions import text as t
from gridloom.functions.folds import keep_apart
from gridloom.operators import blocks as b
from gridloom.operators import grid, runs
from gridloom.plans import surrogates as s
from gridloom.plans.rasters import raster_blocks
from gridloom.settings import SETTINGS

W, H = SETTINGS.page_width, SETTINGS.page_height
CW, CH = s.CARD_W, s.CARD_H


def page_range_filter(spark: SparkSession, d: str) -> DataFrame:
    return b.relevant_pages(s.manifest(spark, d))


def _candidates(spark: SparkSession, d: str, per_page: int = 10) -> DataFrame:
    return b.contour_candidates(s.boxes(spark, d, per_page).drop("n_vertices"))


def contour_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d)


def greedy_dedup(spark: SparkSession, d: str) -> DataFrame:
    return b.deduplicated(_candidates(spark, d), ["doc", "page"]).drop("doc")


def block_numbering(spark: SparkSession, d: str) -> DataFrame:
    kept = b.deduplicated(_candidates(spark, d), ["doc", "page"])
    return b.numbered(kept, ["doc"], ["page", "idx"]).select("doc", "page", "idx", "voter_no", "x", "y", "w", "h")


def _exploded(lines: DataFrame) -> DataFrame:
    return lines.select("page", F.posexplode("lines").alias("idx", "at"))


def merge_lines_h(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(grid.merged_lines(s.boxes(spark, d), ["page"], "y", SETTINGS.horizontal_gap))


def merge_lines_v(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(grid.merged_lines(s.boxes(spark, d), ["page"], "x", SETTINGS.vertical_gap))


def _page_lines(spark: SparkSession, d: str, per_page: int = 10) -> DataFrame:
    """Both directions of each page from one grouping."""
    boxes = s.boxes(spark, d, per_page)
    both = boxes.groupBy("doc", "page").agg(F.array_sort(F.collect_set("y")).alias("h"), F.array_sort(F.collect_set("x")).alias("v"))
    return both.select("doc", "page", grid.merge_close(F.col("h"), SETTINGS.horizontal_gap).alias("h_lines"), grid.merge_close(F.col("v"), SETTINGS.vertical_gap).alias("v_lines"))


def grid_cells(spark: SparkSession, d: str) -> DataFrame:
    return grid.grid_cells(_page_lines(spark, d), ["doc", "page"]).drop("doc", "w", "h")


def _grid_blocks(spark: SparkSession, d: str, per_page: int = 10) -> DataFrame:
    return grid.grid_blocks(grid.grid_cells(grid.viable(_page_lines(spark, d, per_page)), ["doc", "page"]))


def grid_cells_filtered(spark: SparkSession, d: str) -> DataFrame:
    return _grid_blocks(spark, d).drop("doc")


def strict_filter(spark: SparkSession, d: str) -> DataFrame:
    return b.strict_if_many(_grid_blocks(spark, d, 40), ["doc", "page"]).drop("doc")


def method_fallback(spark: SparkSession, d: str) -> DataFrame:
    """An order to a page, so that many pages have no block from contours. A page's boxes meet once: candidates and lines are of one row."""
    boxes = s.boxes(spark, d, 1).withColumn("c", g.padded("x", "y", "w", "h", F.lit(W), F.lit(H)))
    block = F.struct("y", "x", "w", "h", (F.col("c.y2") - F.col("c.y1")).alias("ph"), (F.col("c.x2") - F.col("c.x1")).alias("pw"))
    some = F.array_sort(F.collect_list(F.when(g.is_contour_block("w", "h", F.lit(W), F.lit(H)), block)))
    pages = boxes.groupBy("doc", "page").agg(some.alias("b"), F.array_sort(F.collect_set("y")).alias("h"), F.array_sort(F.collect_set("x")).alias("v"))
    pages = pages.withColumn("_found", F.size("b") > 0)
    found = pages.where("_found").select("page", F.explode(keep_apart(F.col("b"))).alias("k")).select("page", "k.x", "k.y", "k.w", "k.h", F.lit("contour").alias("method"))
    lines = pages.where("not _found").select("doc", "page", grid.merge_close(F.col("h"), SETTINGS.horizontal_gap).alias("h_lines"), grid.merge_close(F.col("v"), SETTINGS.vertical_gap).alias("v_lines"))
    cells = b.strict_if_many(grid.grid_blocks(grid.grid_cells(grid.viable(lines), ["doc", "page"])), ["doc", "page"])
    return found.unionByName(cells.select("page", F.col("x1").alias("x"), F.col("y1").alias("y"), "w", "h", F.lit("grid").alias("method")))


def _largest_contour(spark: SparkSession, d: str) -> DataFrame:
    return b.largest(s.boxes(spark, d), ["page"], F.col("w") * F.col("h"), ["y", "x", "w", "h"])


def page_contour_box(spark: SparkSession, d: str) -> DataFrame:
    return _largest_contour(spark, d).select("page", g.page_box("x", "y", "w", "h", F.lit(W), F.lit(H)).alias("b")).select("page", "b.*")


def crop_clamp(spark: SparkSession, d: str) -> DataFrame:
    return _largest_contour(spark, d).select("page", g.clamped("x", "y", "w", "h", F.lit(W), F.lit(H)).alias("b")).select("page", "b.*")


def _border(spark: SparkSession, d: str) -> DataFrame:
    boxes = s.boxes(spark, d)
    borders = boxes.where(g.is_outer_border("w", "h", "n_vertices", F.lit(CW), F.lit(CH)))
    return b.largest(borders, ["page"], F.col("w") * F.col("h"), ["y", "x", "w", "h"])


def outer_border(spark: SparkSession, d: str) -> DataFrame:
    return _border(spark, d).select("page", "x", "y", "w", "h")


def border_crop(spark: SparkSession, d: str) -> DataFrame:
    return _border(spark, d).select("page", g.inside_border("x", "y", "w", "h", F.lit(CW), F.lit(CH)).alias("b")).select("page", "b.*")


def _inner(spark: SparkSession, d: str) -> DataFrame:
    boxes = s.boxes(spark, d)
    inner = boxes.where(g.is_inner_box("w", "h", "n_vertices", F.lit(CW), F.lit(CH)))
    return inner.select("page", g.corners("x", "y", "w", "h").alias("c")).select("page", "c.*")


def inner_boxes(spark: SparkSession, d: str) -> DataFrame:
    return b.numbered(_inner(spark, d), ["page"], ["y1", "x1", "x2", "y2"], "place")


def fill_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _inner(spark, d).select("page", g.fill_box("x1", "y1", "x2", "y2", F.lit(W), F.lit(H)).alias("f")).select("page", "f.*")


def split_lr(spark: SparkSession, d: str) -> DataFrame:
    cut = g.split_at("w")
    return s.boxes(spark, d).select("page", "x", "y", "w", "h", cut.alias("left_w"), (F.col("w") - cut).alias("right_w"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/conversations.parquet")


def ocr_text(spark: SparkSession, d: str) -> DataFrame:
    return _turns(spark, d).groupBy("conv_id").agg(t.joined_lines("turn", "text").alias("text"))


def ocr_json(spark: SparkSession, d: str) -> DataFrame:
    lines = _turns(spark, d).groupBy("conv_id").agg(t.line_records("turn", "text", "role").alias("lines"))
    return lines.select("conv_id", t.result_json(F.lit(None), F.col("lines")).alias("result"))


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    return s.manifest(spark, d).select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("image"))


def chunk_global(spark: SparkSession, d: str) -> DataFrame:
    return runs.chunks_of_all(_tasks(spark, d), ["doc", "image"])


def chunk_per_pdf(spark: SparkSession, d: str) -> DataFrame:
    return runs.chunks_by_document(_tasks(spark, d), ["doc"], ["image"])


def batch_counts(spark: SparkSession, d: str) -> DataFrame:
    """What was written is every row, so the legacy count is the total."""
    chunks = runs.chunks_by_document(s.outcomes(spark, d), ["user_id"], ["event_id"])
    return runs.outcome_counts(chunks, ["user_id", "chunk"], legacy_unified=False).withColumn("legacy_success", F.col("total"))


def success_totals(spark: SparkSession, d: str) -> DataFrame:
    return runs.with_totals(s.outcomes(spark, d), ["user_id"])


def pdf_batches(spark: SparkSession, d: str) -> DataFrame:
    return runs.document_batches(s.manifest(spark, d).select("pdf_name"), ["pdf_name"])


def phase_semi_join(spark: SparkSession, d: str) -> DataFrame:
    docs = s.manifest(spark, d)
    first = docs.select("pdf_name", (F.col("o_orderstatus") != "F").alias("preprocess_success"), F.when(F.col("n_pages") > 3, F.col("pdf_name")).alias("cleaned_dir"))
    return runs.ready_for_ocr(docs.select("pdf_name", "n_pages"), first)


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return runs.run_summary(s.outcomes(spark, d)).withColumn("avg_seconds", F.round("avg_seconds", 6))


def documents_read(spark: SparkSession, d: str) -> DataFrame:
    per = s.outcomes(spark, d).groupBy("user_id").agg(F.count_if("ok").alias("ocr_successful"))
    return runs.documents_with_text(per)


def page_1_box(spark: SparkSession, d: str) -> DataFrame:
    """The page's content by the contour of the largest area, the first among equals, cut to the page."""
    boxes = s.boxes(spark, d).withColumn("area", F.col("w") * F.col("h") * F.col("n_vertices") / 8)
    box = g.page_box("x", "y", "w", "h", F.lit(W), F.lit(H))
    found = b.largest(boxes, ["page"], F.col("area"), ["y", "x", "w", "h"]).select("page", "area", box.alias("b")).select("page", "area", "b.*")
    return found.select("page", "area", g.clamped("x", "y", "w", "h", F.lit(W), F.lit(H)).alias("c")).select("page", "area", "c.*")


def block_counts(spark: SparkSession, d: str) -> DataFrame:
    return runs.block_counts(b.deduplicated(_candidates(spark, d), ["doc", "page"]), "doc", "page")


def _accounted(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("pdf_name")
    return s.manifest(spark, d).select(name, F.concat(F.lit("in/"), name, F.lit(".pdf")).alias("pdf_path"), F.concat(F.lit("clean/"), name).alias("cleaned_dir"))


def preprocess_stats(spark: SparkSession, d: str) -> DataFrame:
    return runs.preprocess_stats(_accounted(spark, d), s.images(spark, d).where("ok"))


def ocr_stats(spark: SparkSession, d: str) -> DataFrame:
    legacy = runs.ocr_stats(_accounted(spark, d), s.images(spark, d), legacy_unified=True)
    legacy = legacy.select("pdf_name", F.col("ocr_successful").alias("legacy_successful"), F.col("time_taken").alias("legacy_time"))
    return runs.ocr_stats(_accounted(spark, d), s.images(spark, d), legacy_unified=False).join(legacy, "pdf_name")


def elapsed_fmt(spark: SparkSession, d: str) -> DataFrame:
    seconds = F.col("event_id") % 9000 + F.col("seconds")
    return s.outcomes(spark, d).select("event_id", t.elapsed(seconds).alias("short"), t.elapsed_long(seconds).alias("long"))


def _artifacts(spark: SparkSession, d: str) -> DataFrame:
    tasks = b.numbered(_tasks(spark, d).withColumn("doc", F.col("doc") % 7), ["doc"], ["image"], "number")
    return tasks.withColumn("file_name", t.voter_file(F.col("number")))


def artifact_names(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("out/pdf."), F.col("doc").cast("string"), F.lit("/"), F.col("file_name"))
    return _artifacts(spark, d).select("doc", "number", "file_name", t.stem(path).alias("stem"), t.parent(path).alias("parent"))


def file_order(spark: SparkSession, d: str) -> DataFrame:
    files = _artifacts(spark, d).select("doc", "number", "file_name")
    legacy = runs.in_file_order(files, ["doc"], "file_name", "number", legacy=True).withColumnRenamed("place", "legacy_place")
    return runs.in_file_order(legacy, ["doc"], "file_name", "number", legacy=False)


def worker_plan(spark: SparkSession, d: str) -> DataFrame:
    free, used = F.col("free_gb"), F.col("utilization")
    return s.outcomes(spark, d).select("event_id", runs.workers(free, used, 16).alias("workers"), runs.workers(free, used, 16, careful=False).alias("staged_workers"))


QUERIES = {
    f.__name__: f
    for f in (
        page_range_filter, contour_candidates, greedy_dedup, block_numbering, merge_lines_h, merge_lines_v, grid_cells, grid_cells_filtered,
        strict_filter, method_fallback, page_contour_box, crop_clamp, outer_border, border_crop, inner_boxes, fill_boxes, split_lr, ocr_text, ocr_json,
        chunk_global, chunk_per_pdf, batch_counts, success_totals, pdf_batches, phase_semi_join, run_summary, documents_read, elapsed_fmt,
        artifact_names, file_order, worker_plan, raster_blocks, page_1_box, block_counts, preprocess_stats, ocr_stats,
    )
}


def _boxes(n: int = 10) -> str:
    return s.SQL_BOXES.format(n=n)


_CAND = f"""cand AS (SELECT doc, page, x, y, w, h, greatest(0, x - 5) AS x1, greatest(0, y - 5) AS y1, least({W}, x + w + 5) AS x2, least({H}, y + h + 5) AS y2
    FROM boxes WHERE h > 100 AND h < greatest(500, 0.4::DOUBLE * {H}) AND w > 200 AND w < greatest(800, 0.8::DOUBLE * {W})
    AND w::DOUBLE / h > 1.2::DOUBLE AND w::DOUBLE / h < 6 AND w * h > 30000)"""
_DEDUP = f"""{_CAND},
arr AS (SELECT doc, page, list({{'y': y, 'x': x, 'w': w, 'h': h, 'ph': y2 - y1, 'pw': x2 - x1}} ORDER BY y, x, w, h) AS b FROM cand GROUP BY doc, page),
fold AS (SELECT doc, page, 1 AS i, b, b[1:1] AS k FROM arr UNION ALL
    SELECT doc, page, i + 1, b, CASE WHEN len(list_filter(k, lambda o: abs(b[i + 1].y - o.y) < least(b[i + 1].ph, o.ph) * 0.7::DOUBLE
        AND abs(b[i + 1].x - o.x) < least(b[i + 1].pw, o.pw) * 0.7::DOUBLE)) = 0 THEN list_append(k, b[i + 1]) ELSE k END FROM fold WHERE i < len(b)),
kept AS (SELECT doc, page, unnest(generate_series(1, len(k))) AS j, k FROM fold WHERE i = len(b)),
blocks AS (SELECT doc, page, (j - 1)::INTEGER AS idx, k[j].y AS y, k[j].x AS x, k[j].w AS w, k[j].h AS h, k[j].ph AS ph, k[j].pw AS pw FROM kept)"""


def _merged(name: str, at: str, gap: int) -> str:
    return f"""{name}_raw AS (SELECT doc, page, list(DISTINCT {at} ORDER BY {at}) AS l FROM boxes GROUP BY doc, page),
{name}_fold AS (SELECT doc, page, 1 AS i, l, l[1:1] AS m FROM {name}_raw UNION ALL
    SELECT doc, page, i + 1, l, CASE WHEN l[i + 1] - m[len(m)] >= {gap} THEN list_append(m, l[i + 1])
        ELSE list_append(m[1:len(m) - 1], (m[len(m)] + l[i + 1]) // 2) END FROM {name}_fold WHERE i < len(l)),
{name} AS (SELECT doc, page, m FROM {name}_fold WHERE i = len(l))"""


_CELLS = f"""{_merged("hl", "y", 30)}, {_merged("vl", "x", 100)},
he AS (SELECT doc, page, list_concat([0::BIGINT], m, [{H}::BIGINT]) AS e, len(m) AS n FROM hl),
ve AS (SELECT doc, page, list_concat([0::BIGINT], m, [{W}::BIGINT]) AS e, len(m) AS n FROM vl),
hs AS (SELECT doc, page, n, e, unnest(generate_series(1, len(e) - 1)) AS i FROM he),
vs AS (SELECT doc, page, n, e, unnest(generate_series(1, len(e) - 1)) AS i FROM ve),
cells AS (SELECT doc, page, hs.n AS hn, vs.n AS vn, vs.e[vs.i] AS x1, hs.e[hs.i] AS y1, vs.e[vs.i + 1] AS x2, hs.e[hs.i + 1] AS y2,
    (row_number() OVER (PARTITION BY doc, page ORDER BY hs.i, vs.i) - 1)::INTEGER AS cell_idx FROM hs JOIN vs USING (doc, page)
    WHERE hs.e[hs.i + 1] - hs.e[hs.i] >= 80 AND vs.e[vs.i + 1] - vs.e[vs.i] >= 150),
gridb AS (SELECT doc, page, cell_idx, x1, y1, x2, y2, x2 - x1 AS w, y2 - y1 AS h FROM cells WHERE hn >= 2 AND vn >= 2
    AND y2 - y1 > 100 AND y2 - y1 < 0.35::DOUBLE * {H} AND x2 - x1 > 200 AND x2 - x1 < 0.7::DOUBLE * {W}
    AND (x2 - x1)::DOUBLE / (y2 - y1) > 1.5::DOUBLE AND (x2 - x1)::DOUBLE / (y2 - y1) < 5),
strict AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc, page) AS n FROM gridb)
    WHERE n <= 50 OR (h > 150 AND h < 400 AND w > 300 AND w < 600 AND w * h > 50000))"""
_FIRST = "row_number() OVER (PARTITION BY page ORDER BY w * h DESC, y, x, w, h) = 1"
_LARGEST = f"top AS (SELECT * FROM boxes QUALIFY {_FIRST})"
_BORDER = f"top AS (SELECT * FROM boxes WHERE w * h > 0.85::DOUBLE * {CW * CH} AND n_vertices = 4 QUALIFY {_FIRST})"
_INNER = f"inside AS (SELECT page, x AS x1, y AS y1, x + w AS x2, y + h AS y2 FROM boxes WHERE w >= 20 AND h >= 20 AND w * h <= 0.9::DOUBLE * {CW * CH} AND n_vertices = 4)"
_CHUNK = "((row_number() OVER ({}) - 1) // 5)::BIGINT AS chunk"
_FILES = f"""{s.SQL_MANIFEST}, files AS (SELECT *, printf('voter_%03d.jpg', number) AS file_name FROM (SELECT o_custkey % 7 AS doc,
    row_number() OVER (PARTITION BY o_custkey % 7 ORDER BY o_orderkey) AS number FROM manifest))"""
_ELAPSED = f"""{s.SQL_OUTCOMES}, e AS (SELECT event_id, event_id % 9000 + seconds AS v FROM outcomes),
p AS (SELECT event_id, v, floor(v / 3600)::BIGINT AS hh, floor((v % 3600) / 60)::BIGINT AS mm, printf('%.2f', v % 60) AS ss, floor(v / 60)::BIGINT AS am FROM e)"""


def _workers(careful: bool) -> str:
    fit = "floor(free_gb * 0.8::DOUBLE / 2)"
    plan = f"greatest(1, least(16, greatest(1, floor({fit} * CASE WHEN utilization > 80 THEN 0.5 WHEN utilization > 60 THEN 0.7 ELSE 1 END::DOUBLE))))::BIGINT"
    return f"CASE WHEN free_gb < 2 THEN 1 ELSE {plan} END" if careful else plan


ORACLES: dict[str, str] = {
    "page_range_filter": f"WITH {s.SQL_MANIFEST} SELECT pdf_name, unnest(generate_series(3, n_pages - 1))::INTEGER AS page_no FROM manifest WHERE n_pages > 3",
    "contour_candidates": f"WITH {_boxes()}, {_CAND} SELECT * FROM cand",
    "greedy_dedup": f"WITH RECURSIVE {_boxes()}, {_DEDUP} SELECT page, idx, y, x, w, h, ph, pw FROM blocks",
    "block_numbering": f"WITH RECURSIVE {_boxes()}, {_DEDUP} SELECT doc, page, idx, row_number() OVER (PARTITION BY doc ORDER BY page, idx) AS voter_no, x, y, w, h FROM blocks",
    "merge_lines_h": f"WITH RECURSIVE {_boxes()}, {_merged('hl', 'y', 30)}, u AS (SELECT page, unnest(generate_series(1, len(m))) AS j, m FROM hl) SELECT page, (j - 1)::INTEGER AS idx, m[j] AS at FROM u",
    "merge_lines_v": f"WITH RECURSIVE {_boxes()}, {_merged('vl', 'x', 100)}, u AS (SELECT page, unnest(generate_series(1, len(m))) AS j, m FROM vl) SELECT page, (j - 1)::INTEGER AS idx, m[j] AS at FROM u",
    "grid_cells": f"WITH RECURSIVE {_boxes()}, {_CELLS} SELECT page, cell_idx, x1, y1, x2, y2 FROM cells",
    "grid_cells_filtered": f"WITH RECURSIVE {_boxes()}, {_CELLS} SELECT page, cell_idx, x1, y1, x2, y2, w, h FROM gridb",
    "strict_filter": f"WITH RECURSIVE {_boxes(40)}, {_CELLS} SELECT page, cell_idx, x1, y1, x2, y2, w, h FROM strict",
    "method_fallback": f"""WITH RECURSIVE {_boxes(1)}, {_DEDUP}, {_CELLS} SELECT page, x, y, w, h, 'contour' AS method FROM blocks
        UNION ALL SELECT page, x1, y1, w, h, 'grid' FROM strict WHERE page NOT IN (SELECT page FROM blocks)""",
    "page_contour_box": f"""WITH {_boxes()}, {_LARGEST} SELECT page, greatest(0, x - 20) AS x, greatest(0, y - 20) AS y,
        least({W} - greatest(0, x - 20), w + 40) AS w, least({H} - greatest(0, y - 20), h + 40) AS h FROM top""",
    "crop_clamp": f"""WITH {_boxes()}, {_LARGEST} SELECT page, greatest(0, least(x, {W})) AS x1, greatest(0, least(y, {H})) AS y1,
        greatest(0, least(x + w, {W})) AS x2, greatest(0, least(y + h, {H})) AS y2 FROM top""",
    "outer_border": f"WITH {_boxes()}, {_BORDER} SELECT page, x, y, w, h FROM top",
    "border_crop": f"""WITH {_boxes()}, {_BORDER}, c AS (SELECT page, greatest(0, x + 5) AS x1, greatest(0, y + 5) AS y1, least({CW}, x + w - 5) AS x2, least({CH}, y + h - 5) AS y2 FROM top)
        SELECT page, CASE WHEN x2 <= x1 OR y2 <= y1 THEN 0 ELSE x1 END AS x1, CASE WHEN x2 <= x1 OR y2 <= y1 THEN 0 ELSE y1 END AS y1,
        CASE WHEN x2 <= x1 OR y2 <= y1 THEN {CW} ELSE x2 END AS x2, CASE WHEN x2 <= x1 OR y2 <= y1 THEN {CH} ELSE y2 END AS y2 FROM c""",
    "inner_boxes": f"WITH {_boxes()}, {_INNER} SELECT *, row_number() OVER (PARTITION BY page ORDER BY y1, x1, x2, y2) AS place FROM inside",
    "fill_boxes": f"WITH {_boxes()}, {_INNER} SELECT page, greatest(0, x1 - 2) AS x1, greatest(0, y1 - 2) AS y1, least({W}, x2 + 2) AS x2, least({H}, y2 + 2) AS y2 FROM inside",
    "split_lr": f"WITH {_boxes()} SELECT page, x, y, w, h, floor(w * 0.6::DOUBLE)::BIGINT AS left_w, w - floor(w * 0.6::DOUBLE)::BIGINT AS right_w FROM boxes",
    "ocr_text": "SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (text <> ''), '') AS text FROM conversations GROUP BY conv_id",
    "ocr_json": "SELECT conv_id, to_json({'page': 1, 'text_lines': list({'text': text, 'role': role} ORDER BY turn)})::VARCHAR AS result FROM conversations GROUP BY conv_id",
    "chunk_global": f"WITH {s.SQL_MANIFEST} SELECT o_custkey AS doc, o_orderkey AS image, {_CHUNK.format('ORDER BY o_custkey, o_orderkey')} FROM manifest",
    "chunk_per_pdf": f"WITH {s.SQL_MANIFEST} SELECT o_custkey AS doc, o_orderkey AS image, {_CHUNK.format('PARTITION BY o_custkey ORDER BY o_orderkey')} FROM manifest",
    "batch_counts": f"""WITH {s.SQL_OUTCOMES}, c AS (SELECT *, {_CHUNK.format('PARTITION BY user_id ORDER BY event_id')} FROM outcomes)
        SELECT user_id, chunk, count(*) FILTER (ok) AS success, count(*) AS total, count(*) AS legacy_success FROM c GROUP BY user_id, chunk""",
    "success_totals": f"WITH {s.SQL_OUTCOMES} SELECT user_id, count(*) FILTER (ok) AS success, count(*) AS total FROM outcomes GROUP BY ROLLUP (user_id)",
    "pdf_batches": f"WITH {s.SQL_MANIFEST} SELECT pdf_name, ((row_number() OVER (ORDER BY pdf_name) - 1) // 10 + 1)::BIGINT AS batch_no FROM manifest",
    "phase_semi_join": f"WITH {s.SQL_MANIFEST} SELECT pdf_name, n_pages FROM manifest WHERE o_orderstatus <> 'F' AND n_pages > 3",
    "run_summary": f"WITH {s.SQL_OUTCOMES} SELECT count(*) AS total, count(*) FILTER (ok) AS successful, count(*) FILTER (NOT ok) AS failed, round(sum(seconds) / count(*), 6) AS avg_seconds FROM outcomes",
    "documents_read": f"WITH {s.SQL_OUTCOMES} SELECT count(DISTINCT user_id) AS total, count(DISTINCT user_id) FILTER (ok) AS successful FROM outcomes",
    "elapsed_fmt": f"""WITH {_ELAPSED} SELECT event_id, CASE WHEN hh > 0 THEN hh || 'h ' || mm || 'm ' || ss || 's' WHEN mm > 0 THEN mm || 'm ' || ss || 's' ELSE ss || 's' END AS short,
        CASE WHEN am > 0 THEN am || ' minute(s) ' || ss || ' seconds (' || printf('%.2f', v) || ' seconds)' ELSE ss || ' seconds' END AS long FROM p""",
    "artifact_names": f"WITH {_FILES} SELECT doc, number, file_name, file_name[:len(file_name) - 4] AS stem, 'pdf.' || doc AS parent FROM files",
    "file_order": f"""WITH {_FILES} SELECT doc, number, file_name, row_number() OVER (PARTITION BY doc ORDER BY file_name) AS legacy_place,
        row_number() OVER (PARTITION BY doc ORDER BY number) AS place FROM files""",
    "raster_blocks": """WITH p AS (SELECT s_suppkey % 10 AS doc, s_suppkey AS page, unnest(generate_series(0, s_suppkey % 7 - 1)) AS i FROM supplier WHERE s_suppkey % 7 > 0)
        SELECT doc, page, i::INTEGER AS idx, row_number() OVER (PARTITION BY doc ORDER BY page, i) AS voter_no, 40 + 430 * (i % 2) AS x, 40 + 310 * (i // 2) AS y,
        260 + page * 13 % 120 AS w, 120 + page * 7 % 90 AS h FROM p""",
    "page_1_box": f"""WITH {_boxes()}, a AS (SELECT page, x, y, w, h, w * h * n_vertices / 8 AS area FROM boxes
        QUALIFY row_number() OVER (PARTITION BY page ORDER BY w * h * n_vertices DESC, y, x, w, h) = 1),
        c AS (SELECT page, area, greatest(0, x - 20) AS x, greatest(0, y - 20) AS y, least({W} - greatest(0, x - 20), w + 40) AS w, least({H} - greatest(0, y - 20), h + 40) AS h FROM a)
        SELECT page, area, greatest(0, least(x, {W})) AS x1, greatest(0, least(y, {H})) AS y1, greatest(0, least(x + w, {W})) AS x2, greatest(0, least(y + h, {H})) AS y2 FROM c""",
    "block_counts": f"WITH RECURSIVE {_boxes()}, {_DEDUP} SELECT doc, page, count(*) AS n_blocks FROM blocks GROUP BY GROUPING SETS ((doc, page), (doc))",
    "preprocess_stats": f"""WITH {s.SQL_MANIFEST}, {s.SQL_IMAGES}, n AS (SELECT pdf_name, count(*) FILTER (NOT first) AS cleaned, count(*) FILTER (first) > 0 AS page_1, sum(seconds) AS t FROM images WHERE ok GROUP BY pdf_name)
        SELECT pdf_name, 'in/' || pdf_name || '.pdf' AS pdf_path, coalesce(cleaned, 0) AS total_voters, coalesce(cleaned, 0) AS cleaned, coalesce(page_1, false) AS page_1_saved,
        CASE WHEN cleaned > 0 OR page_1 THEN 'clean/' || pdf_name END AS cleaned_dir, coalesce(cleaned > 0 OR page_1, false) AS preprocess_success, coalesce(t, 0) AS time_taken FROM manifest LEFT JOIN n USING (pdf_name)""",
    "ocr_stats": f"""WITH {s.SQL_MANIFEST}, {s.SQL_IMAGES}, n AS (SELECT pdf_name, count(*) FILTER (NOT first AND ok) AS good, count(*) FILTER (NOT first AND NOT ok) AS bad, count(*) FILTER (first AND ok) > 0 AS page_1,
            sum(seconds) AS t, count(*) AS every, sum(CASE WHEN first THEN 2 ELSE 1 END * seconds) AS t2 FROM images GROUP BY pdf_name)
        SELECT pdf_name, coalesce(good, 0) AS ocr_successful, coalesce(bad, 0) AS ocr_failed, coalesce(page_1, false) AS page_1_ocr_successful, coalesce(t, 0) AS time_taken,
        coalesce(every, 0) AS legacy_successful, coalesce(t2, 0) AS legacy_time FROM manifest LEFT JOIN n USING (pdf_name)""",
    "worker_plan": f"WITH {s.SQL_OUTCOMES} SELECT event_id, {_workers(True)} AS workers, {_workers(False)} AS staged_workers FROM outcomes",
}
