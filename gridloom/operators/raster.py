"""Pixel kernels in numpy, for Arrow-batched Python stages. Gray images are two-dimensional uint8 arrays.

Binary images are boolean. Borders of filters repeat the edge; positions outside an image never limit an
erosion and never add to a dilation. Results for whole pages follow the published definitions of the
filters; equality with any particular imaging library, pixel by pixel, isn't claimed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: ITU-R BT.601 weights of red, green and blue.
LUMA = np.array([0.299, 0.587, 0.114])


def gray(image: np.ndarray) -> np.ndarray:
    """Luminance of an image with three channels, or four, of which the last is ignored; gray ones stay."""
    return image if image.ndim == 2 else np.floor(image[..., :3] @ LUMA + 0.5).astype(np.uint8)


def _convolved(a: np.ndarray, kernel: np.ndarray, axis: int) -> np.ndarray:
    r, n = len(kernel) // 2, a.shape[axis]
    padded = np.pad(a, [(r, r) if k == axis else (0, 0) for k in range(2)], mode="edge")
    out, part = np.zeros_like(a), np.empty_like(a)
    for i, w in enumerate(kernel.astype(a.dtype)):
        np.multiply(padded[i : i + n] if axis == 0 else padded[:, i : i + n], w, out=part)
        out += part
    return out


def adaptive_threshold(image: np.ndarray, block: int = 11, offset: float = 2) -> np.ndarray:
    """Ink: pixels not above the Gaussian mean of their neighbourhood less ``offset``."""
    sigma = 0.3 * ((block - 1) * 0.5 - 1) + 0.8
    x = np.arange(block) - block // 2
    kernel = np.exp(-(x**2) / (2 * sigma**2))
    kernel /= kernel.sum()
    mean = np.rint(_convolved(_convolved(image.astype(np.float32), kernel, 0), kernel, 1))
    return image.astype(np.float32) <= mean - offset


def otsu_threshold(image: np.ndarray) -> np.ndarray:
    """Ink: pixels up to the level that parts the histogram with the largest variance between classes (Otsu 1979)."""
    counts = np.bincount(image.ravel(), minlength=256).astype(float)
    below, total = np.cumsum(counts), counts.sum()
    mass = np.cumsum(counts * np.arange(256))
    above = total - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return image <= int(np.nanargmax(np.where(below * above > 0, between, -1)))


def _shifted(a: np.ndarray, dy: int, dx: int, fill: bool) -> np.ndarray:
    out = np.full_like(a, fill)
    h, w = a.shape
    out[max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)] = a[max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)]
    return out


def close(a: np.ndarray, size: int = 3, times: int = 2) -> np.ndarray:
    """Dilations, then as many erosions, by a square."""
    r = size // 2
    steps = [(y, x) for y in range(-r, r + 1) for x in range(-r, r + 1)]
    for _ in range(times):
        a = np.logical_or.reduce([_shifted(a, y, x, False) for y, x in steps])
    for _ in range(times):
        a = np.logical_and.reduce([_shifted(a, y, x, True) for y, x in steps])
    return a


def _run_filter(a: np.ndarray, size: int, grow: bool) -> np.ndarray:
    """Erosion or dilation of each row by a horizontal bar of ``size`` pixels, its anchor at size // 2."""
    left, right = size // 2, size - 1 - size // 2
    before, after = (right, left) if grow else (left, right)
    sums = np.zeros((a.shape[0], a.shape[1] + 1), dtype=np.int64)
    np.cumsum(a if grow else ~a, axis=1, out=sums[:, 1:])
    x = np.arange(a.shape[1])
    some = sums[:, np.minimum(x + after + 1, a.shape[1])] - sums[:, np.maximum(x - before, 0)] > 0
    return some if grow else ~some


def line_mask(ink: np.ndarray, vertical: bool) -> np.ndarray:
    """Long straight runs: two openings by a quarter of the length, then a dilation; none in an image under four pixels."""
    a = ink.T if vertical else ink
    size = a.shape[1] // 4
    if not size:
        return np.zeros_like(ink)
    for grow in (False, False, True, True, True):
        a = _run_filter(a, size, grow)
    return a.T if vertical else a


def line_positions(ink: np.ndarray, vertical: bool) -> list[int]:
    """Rows, or columns, whose 0/255 line pixels sum to more than 0.4 of their length."""
    mask = line_mask(ink, vertical)
    sums = mask.sum(axis=0 if vertical else 1, dtype=np.uint64) * 255
    return np.flatnonzero(sums > 0.4 * ink.shape[0 if vertical else 1]).tolist()


class Components:
    """Connected components of an image as runs of its rows: run i covers start[i] .. stop[i] - 1 of row[i] and belongs to number[i]."""

    def __init__(self, a: np.ndarray, diagonal: bool):
        h, w = a.shape
        edge = np.diff(np.pad(a.astype(np.int8), ((0, 0), (1, 1))), axis=1).ravel()
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.row, self.start = np.divmod(begin, w + 1)
        self.stop = end - self.row * (w + 1)
        # runs of the next row that touch a run, in coordinates where rows stand behind each other
        stride, reach = w + 2, int(diagonal)
        low = np.searchsorted(self.row * stride + self.stop + reach, (self.row + 1) * stride + self.start, side="right")
        high = np.searchsorted(self.row * stride + self.start, (self.row + 1) * stride + self.stop + reach, side="left")
        count = np.maximum(high - low, 0)
        upper = np.repeat(np.arange(len(begin)), count)
        lower = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        root = np.arange(len(begin))
        while len(upper):
            x, y = root[upper], root[lower]
            apart = x != y
            if not apart.any():
                break
            upper, lower, x, y = upper[apart], lower[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
        kinds, self.number = np.unique(root, return_inverse=True)
        self.n = len(kinds)

    def boxes(self) -> np.ndarray:
        """Rows (x, y, w, h) around the components."""
        low, high = np.full((self.n, 2), np.iinfo(np.int64).max), np.zeros((self.n, 2), dtype=np.int64)
        for i, (first, last) in enumerate(((self.start, self.stop), (self.row, self.row + 1))):
            np.minimum.at(low[:, i], self.number, first)
            np.maximum.at(high[:, i], self.number, last)
        return np.concatenate([low, high - low], axis=1)

    def masks(self) -> Iterator[tuple[tuple[int, int, int, int], np.ndarray]]:
        """Each component's box and its pixels there."""
        order = np.argsort(self.number, kind="stable")
        cut = np.flatnonzero(np.diff(self.number[order])) + 1
        for (x, y, w, h), runs in zip(self.boxes().tolist(), np.split(order, cut) if len(order) else [], strict=True):
            mask = np.zeros((h, w), dtype=bool)
            for r, s, e in zip((self.row[runs] - y).tolist(), (self.start[runs] - x).tolist(), (self.stop[runs] - x).tolist(), strict=True):
                mask[r, s:e] = True
            yield (x, y, w, h), mask


def _holes(boxes: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Which background components don't reach the image's border."""
    x, y, w, h = boxes.T
    return (x > 0) & (y > 0) & (x + w < shape[1]) & (y + h < shape[0])


def component_boxes(ink: np.ndarray, holes: bool = True) -> list[tuple[int, int, int, int]]:
    """(x, y, w, h) around each ink component, and around each enclosed background region grown by a pixel.

    These are the rectangles around the outer and inner border curves of the image.
    """
    out = Components(ink, diagonal=True).boxes()
    if holes:
        found = Components(~ink, diagonal=False).boxes()
        out = np.concatenate([out, found[_holes(found, ink.shape)] + [-1, -1, 2, 2]])
    return sorted(map(tuple, out.tolist()), key=lambda b: (b[1], b[0], b[2], b[3]))


_TURNS = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]  # clockwise from east, as (dy, dx)


def outer_curve(mask: np.ndarray) -> np.ndarray:
    """Border pixels (y, x) of the first component of a mask, followed clockwise (Suzuki and Abe 1985)."""
    h, w = mask.shape
    start = divmod(int(np.argmax(mask)), w)
    at, heading, out = start, 0, []
    inside = lambda p: 0 <= p[0] < h and 0 <= p[1] < w and mask[p]
    first = None
    while True:
        out.append(at)
        for k in range(8):
            turn = (heading + 5 + k) % 8
            step = (at[0] + _TURNS[turn][0], at[1] + _TURNS[turn][1])
            if inside(step):
                break
        else:
            return np.array(out)
        if first is None:
            first = (at, turn)
        elif (at, turn) == first:
            return np.array(out[:-1])
        at, heading = step, turn


def polygon_area(curve: np.ndarray) -> float:
    y, x = curve[:, 0].astype(float), curve[:, 1].astype(float)
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def perimeter(curve: np.ndarray) -> float:
    return float(np.hypot(*(np.roll(curve, -1, axis=0) - curve).T).sum())


def simplified(curve: np.ndarray, tolerance: float) -> np.ndarray:
    """Vertices of a closed curve after Douglas and Peucker (1973), begun at two points far apart."""
    if len(curve) < 3:
        return curve
    a = int(np.argmax(((curve - curve[0]) ** 2).sum(axis=1)))
    b = int(np.argmax(((curve - curve[a]) ** 2).sum(axis=1)))
    ring = np.roll(curve, -a, axis=0)
    middle, n = (b - a) % len(curve), len(curve)
    keep, todo = {0, middle}, [(0, middle), (middle, n)]
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        p, q = ring[i].astype(float), ring[j % n].astype(float)
        d = ring[i + 1 : j] - p
        length = np.hypot(*(q - p))
        far = np.abs(d[:, 0] * (q - p)[1] - d[:, 1] * (q - p)[0]) / length if length else np.hypot(*d.T)
        k = int(np.argmax(far))
        if far[k] > tolerance:
            keep.add(i + 1 + k)
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return ring[sorted(keep)]


def contours(ink: np.ndarray, holes: bool = False) -> list[dict]:
    """Contours: box, area of the border polygon, and vertices when simplified to a fiftieth of the perimeter.

    They are the outer border curves, and with ``holes`` those around enclosed background too, which run over the ink beside it.
    """
    every = list(Components(ink, diagonal=True).masks())
    if holes:
        for (x, y, w, h), mask in Components(~ink, diagonal=False).masks():
            if x > 0 and y > 0 and x + w < ink.shape[1] and y + h < ink.shape[0]:
                m = np.pad(mask, 1)
                every.append(((x - 1, y - 1, w + 2, h + 2), np.logical_or.reduce([m, *[_shifted(m, a, b, False) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))]])))
    out = []
    for (x, y, w, h), mask in every:
        curve = outer_curve(mask)
        out.append({"x": x, "y": y, "w": w, "h": h, "area": polygon_area(curve), "n_vertices": len(simplified(curve, 0.02 * perimeter(curve)))})
    return out


def largest_contour(ink: np.ndarray) -> tuple[int, int, int, int] | None:
    """Box of the outer contour of the largest polygon area, the first in reading order among equals; None without ink.

    A polygon is no larger than its box, so components are traced in falling order of boxes while one may still be larger.
    """
    parts = Components(ink, diagonal=True)
    boxes = parts.boxes()
    best, found = -1.0, None
    for k in np.lexsort((boxes[:, 0], boxes[:, 1], -boxes[:, 2] * boxes[:, 3])).tolist():
        x, y, w, h = boxes[k].tolist()
        if w * h < best:
            break
        mask = np.zeros((h, w), dtype=bool)
        for i in np.flatnonzero(parts.number == k).tolist():
            mask[parts.row[i] - y, parts.start[i] - x : parts.stop[i] - x] = True
        area = polygon_area(outer_curve(mask))
        if area > best or area == best and (y, x) < (found[1], found[0]):
            best, found = area, (x, y, w, h)
    return found


def page_content(image: np.ndarray, pad: int = 20) -> np.ndarray:
    """A page cut to its largest contour and a margin, which beside an edge goes to the other side; the whole page without one."""
    box = largest_contour(adaptive_threshold(gray(image)))
    if box is None:
        return image
    h, w = image.shape[:2]
    x, y = max(0, box[0] - pad), max(0, box[1] - pad)
    return image[y : y + min(h - y, box[3] + 2 * pad), x : x + min(w - x, box[2] + 2 * pad)]


def painted(image: np.ndarray, boxes: list[tuple[int, int, int, int]], pad: int = 2, fill: tuple[int, int, int] = (255, 255, 255)) -> np.ndarray:
    """A copy with boxes (x1, y1, x2, y2) and their padding filled; gray turns 255, a fourth channel opaque."""
    out = image.copy()
    channels = 1 if image.ndim == 2 else image.shape[2]
    color = {3: fill, 4: (*fill, 255)}.get(channels, 255)
    for x1, y1, x2, y2 in boxes:
        out[max(0, y1 - pad) : min(out.shape[0], y2 + pad), max(0, x1 - pad) : min(out.shape[1], x2 + pad)] = color
    return out


def cleaned(image: np.ndarray) -> np.ndarray:
    """A card without its outer border, and with the boxes inside painted over."""
    border = [c for c in contours(close(otsu_threshold(gray(image)))) if c["w"] * c["h"] > 0.85 * image.shape[0] * image.shape[1] and c["n_vertices"] == 4]
    if border:
        c = max(border, key=lambda c: c["w"] * c["h"])
        x1, y1, x2, y2 = c["x"] + 5, c["y"] + 5, c["x"] + c["w"] - 5, c["y"] + c["h"] - 5
        if x2 > x1 and y2 > y1:
            image = image[y1:y2, x1:x2]
    most = 0.9 * image.shape[0] * image.shape[1]
    inner = [c for c in contours(close(otsu_threshold(gray(image))), holes=True) if c["w"] >= 20 and c["h"] >= 20 and c["w"] * c["h"] <= most and c["n_vertices"] == 4]
    return painted(image, [(c["x"], c["y"], c["x"] + c["w"], c["y"] + c["h"]) for c in sorted(inner, key=lambda c: (c["y"], c["x"]))])
