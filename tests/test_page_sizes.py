"""Pages of several sizes in one call of the extraction."""

import numpy as np

from gridloom.plans import extraction
from gridloom.sources import documents as s


def ruled(height, width):
    page = np.full((height, width), 255, dtype=np.uint8)
    for y in (250, 500):
        page[y : y + 3, :] = 0
    for x in (450, 900):
        page[:, x : x + 3] = 0
    return page


def boxed(height, width):
    page = np.full((height, width), 255, dtype=np.uint8)
    y, x = height - 300, width - 560
    page[y : y + 200, x : x + 500] = 0
    page[y + 4 : y + 196, x + 4 : x + 496] = 255
    return page


def test_pages_keep_their_own_size(spark):
    pages = [ruled(700, 1400), ruled(1500, 1100), boxed(900, 1600), boxed(1600, 900)]
    rows = [{"pdf_name": f"p{i}", "page_no": 1, "height": p.shape[0], "width": p.shape[1], "channels": 1, "data": bytearray(p.tobytes())} for i, p in enumerate(pages)]
    found = lambda part: sorted(tuple(r) for r in extraction.detected_blocks(spark.createDataFrame(part, s.PAGE)).select("pdf_name", "idx", "x1", "y1", "x2", "y2").collect())
    alone = sorted(x for r in rows for x in found([r]))
    assert {x[0] for x in alone} == {"p0", "p1", "p2", "p3"}
    assert found(rows) == alone == found(rows[::-1])
