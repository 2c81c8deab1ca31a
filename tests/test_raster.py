"""Kernels on drawn images with known answers."""

import numpy as np

from gridloom.operators import raster as r


def page(h=400, w=500):
    return np.full((h, w), 255, dtype=np.uint8)


def rule(a, y, x, h, w, t=3, ink=0):
    a[y : y + h, x : x + w] = ink
    a[y + t : y + h - t, x + t : x + w - t] = 255
    return a


def test_boxes_of_drawn_rectangles():
    a = rule(rule(page(), 20, 30, 100, 200), 200, 30, 120, 220)
    boxes = r.component_boxes(r.adaptive_threshold(a), holes=False)
    assert (30, 20, 200, 100) in boxes and (30, 200, 220, 120) in boxes
    holes = r.component_boxes(a == 0)
    assert (30 + 2, 20 + 2, 196, 96) in holes


def test_blank_page_has_none():
    assert r.component_boxes(r.adaptive_threshold(page())) == []
    assert r.line_positions(r.adaptive_threshold(page()), False) == []


def test_lines_need_half_of_the_length():
    ink = np.zeros((200, 200), dtype=bool)
    ink[50, 20:180] = True
    ink[120, 20:70] = True
    found = r.line_positions(ink, False)
    assert found and all(abs(y - 50) <= 2 for y in found)
    ink = ink.T
    assert r.line_positions(np.ascontiguousarray(ink), True) and not r.line_positions(np.zeros((3, 3), dtype=bool), True)


def test_otsu_parts_two_levels():
    a = page(10, 10)
    a[:5] = 40
    assert (r.otsu_threshold(a) == (a == 40)).all()


def test_contours_tell_rectangles():
    ink = np.zeros((200, 300), dtype=bool)
    ink[20:80, 20:120] = True
    ink[100:180, 150:230] = np.tri(80, dtype=bool)
    found = sorted(r.contours(ink), key=lambda c: c["y"])
    assert [c["n_vertices"] for c in found] == [4, 3]
    assert found[0] | {} == {"x": 20, "y": 20, "w": 100, "h": 60, "area": 99.0 * 59, "n_vertices": 4}


def test_labels_against_flood_fill():
    rng = np.random.default_rng(1)
    for diagonal in (False, True):
        a = rng.random((30, 40)) < 0.45
        parts = r.Components(a, diagonal)
        got, n = np.zeros(a.shape, dtype=int), parts.n
        for k, ((x, y, w, h), mask) in enumerate(parts.masks(), 1):
            got[y : y + h, x : x + w][mask] = k
        seen, count = np.zeros_like(got), 0
        near = [(0, 1), (1, 0), (0, -1), (-1, 0)] + [(1, 1), (1, -1), (-1, 1), (-1, -1)] * diagonal
        for p in zip(*np.nonzero(a), strict=True):
            if not seen[p]:
                count += 1
                todo = [p]
                seen[p] = count
                while todo:
                    y, x = todo.pop()
                    for dy, dx in near:
                        q = (y + dy, x + dx)
                        if 0 <= q[0] < 30 and 0 <= q[1] < 40 and a[q] and not seen[q]:
                            seen[q] = count
                            todo.append(q)
        assert n == count and len({(int(i), int(j)) for i, j in zip(got[a], seen[a], strict=True)}) == n


def test_cleaning_drops_border_and_boxes():
    card = rule(rule(page(200, 400), 2, 2, 196, 396, 4), 60, 100, 60, 80)
    out = r.cleaned(card)
    assert out.shape[0] < 200 and (out[10:-10, 10:-10] == 255).all()


def test_fill_by_channels():
    assert r.painted(np.zeros((9, 9), dtype=np.uint8), [(3, 3, 5, 5)])[1, 1] == 255
    assert r.painted(np.zeros((9, 9, 3), dtype=np.uint8), [(3, 3, 5, 5)], fill=(1, 2, 3))[4, 4].tolist() == [1, 2, 3]
    assert r.painted(np.zeros((9, 9, 4), dtype=np.uint8), [(3, 3, 5, 5)])[4, 4].tolist() == [255] * 4
    assert r.gray(np.dstack([np.full((2, 2), v, dtype=np.uint8) for v in (255, 0, 0)])).tolist() == [[76, 76], [76, 76]]


def test_boxes_inside_a_ruled_table_are_painted():
    """Cells are holes of one component, whose own outline is no rectangle."""
    a = page(300, 400)
    for y in (40, 100, 160):
        a[y : y + 3, 50:253] = 0
    for x in (50, 150, 250):
        a[40:163, x : x + 3] = 0
    a[160:163, 50:340] = 0  # a line goes on beyond the table
    a[60:80, 70:100] = 90
    cells = [c for c in r.contours(a == 0, holes=True) if c["n_vertices"] == 4 and c["w"] > 80]
    assert {(c["x"], c["y"], c["w"], c["h"]) for c in cells} >= {(52, 42, 99, 59), (152, 42, 99, 59)}
    assert (r.cleaned(a)[60:80, 70:100] == 255).all()


def test_largest_contour_is_the_page():
    a = rule(page(), 60, 80, 200, 300, t=2)
    a[10:14, 10:490] = 0
    assert r.largest_contour(a == 0) == (80, 60, 300, 200)
    assert r.page_content(a).shape == (240, 340) and r.page_content(page()).shape == (400, 500)
    b = page()
    b[0:100, 5:300] = 0
    assert r.page_content(b, 20).shape == (140, 335)
