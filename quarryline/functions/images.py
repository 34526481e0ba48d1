"""Pixel arithmetic on numpy images (rows, columns[, bands]): the kernels that tile operators run in Arrow batches."""

from __future__ import annotations

import functools

import numpy as np

# The mean of each band that a network's input is moved by.
MEAN_PIXEL = (123.7, 116.8, 103.9)


def to_byte(image: np.ndarray) -> np.ndarray:
    """Values rounded and held within 0..255, without rescaling."""
    return np.clip(np.rint(image.astype(np.float64)), 0, 255).astype(np.uint8)


def stretch(image: np.ndarray) -> np.ndarray:
    """All bands together to 0..255 by their common ends, rounded; a constant image becomes 0."""
    lo, hi = float(image.min()), float(image.max())
    wide = image.astype(np.float64) - lo
    return np.rint(wide * 255 / (hi - lo)).astype(np.uint8) if hi > lo else np.zeros(image.shape, np.uint8)


def equalise(band: np.ndarray) -> np.ndarray:
    """Histogram equalisation of one band of bytes; a single value stays."""
    n = np.bincount(band.ravel(), minlength=256)
    first = np.flatnonzero(n)[0]
    if n[first] == band.size:
        return band.copy()
    return np.rint((np.cumsum(n) - n[first]).clip(0) * 255 / (band.size - n[first])).astype(np.uint8)[band]


def otsu(values: np.ndarray, bins: int = 256) -> float:
    """The threshold of a histogram over the values' range; 0 for a constant image."""
    lo, hi = values.min(), values.max()
    return otsu_of(np.histogram(values, bins, (lo, hi))[0], lo, hi) if lo < hi else 0.0


def otsu_of(n: np.ndarray, lo: float, hi: float) -> float:
    """The centre of the bin that ends the darker side of the split with the largest variance between the sides, the
    first of several, of the counts n of equal bins from lo to hi; 0 where the ends are the same."""
    if lo >= hi:
        return 0.0
    edges = np.linspace(lo, hi, len(n) + 1)
    centre = (edges[:-1] + edges[1:]) / 2
    below, total = np.cumsum(n)[:-1].astype(float), float(n.sum())
    weight = np.cumsum(n * centre)
    low, high = weight[:-1] / below, (weight[-1] - weight[:-1]) / np.maximum(total - below, 1)
    return float(centre[np.argmax(below * (total - below) * (low - high) ** 2)])


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear sampling at the centres of the new pixels; outside of the image is 0."""
    wide = np.pad(image.astype(np.float64), [(1, 1), (1, 1)] + [(0, 0)] * (image.ndim - 2))

    def places(new: int, old: int) -> tuple[np.ndarray, np.ndarray]:
        at = (np.arange(new) + 0.5) * old / new + 0.5  # in the padded image
        low = np.floor(at).astype(int)
        return low, at - low

    (y, fy), (x, fx) = places(height, image.shape[0]), places(width, image.shape[1])
    more = (None,) * (image.ndim - 2)
    fy, fx = fy[(slice(None), None, *more)], fx[(None, slice(None), *more)]
    rows = wide[y] * (1 - fy) + wide[y + 1] * fy
    return rows[:, x] * (1 - fx) + rows[:, x + 1] * fx


def fit_square(image: np.ndarray, least: int | None, most: int, least_scale: float | None = None) -> tuple[np.ndarray, tuple[int, int, int, int], float]:
    """The image scaled up to `least` on its shorter side (or by least_scale), but to no more than `most` on the longer
    one, amid zeros in a square of `most`; then the window that it fills and its scale."""
    h, w = image.shape[:2]
    scale = max(1.0, least / min(h, w)) if least else 1.0
    scale = max(scale, least_scale or 0.0)
    if round(max(h, w) * scale) > most:
        scale = most / max(h, w)
    if scale != 1:
        image = resize(image, round(h * scale), round(w * scale)).astype(image.dtype)
    return *pad_to(image, most, most), scale


def fit_multiple(image: np.ndarray, least: int | None = None, least_scale: float | None = None, step: int = 64) -> tuple[np.ndarray, tuple[int, int, int, int], float]:
    """The image scaled up as in fit_square without an upper limit, amid zeros up to the next multiples of `step`."""
    h, w = image.shape[:2]
    scale = max(1.0, least / min(h, w) if least else 1.0, least_scale or 0.0)
    if scale != 1:
        image = resize(image, round(h * scale), round(w * scale)).astype(image.dtype)
    return *pad_to(image, -(-image.shape[0] // step) * step, -(-image.shape[1] // step) * step), scale


def pad_to(image: np.ndarray, height: int, width: int) -> tuple[np.ndarray, tuple[int, int, int, int]]:
    """The image in the middle of zeros, and its window (y1, x1, y2, x2); odd rests go below and to the right."""
    h, w = image.shape[:2]
    top, left = (height - h) // 2, (width - w) // 2
    pads = [(top, height - h - top), (left, width - w - left)] + [(0, 0)] * (image.ndim - 2)
    return np.pad(image, pads), (top, left, top + h, left + w)


def small_mask(mask: np.ndarray, box: tuple[int, int, int, int], height: int, width: int) -> np.ndarray:
    """The part of a mask in its box, at a small fixed size; masks of equal boxes may come as bands."""
    y1, x1, y2, x2 = box
    if y2 <= y1 or x2 <= x1:
        raise ValueError("the box is empty")
    return np.around(resize(mask[y1:y2, x1:x2].astype(float), height, width)).astype(bool)


def full_mask(small: np.ndarray, box: tuple[int, int, int, int], height: int, width: int, least: float = 0.5) -> np.ndarray:
    """A small mask, of probabilities or bits, put back in its box in an image of that size; or bands of them."""
    y1, x1, y2, x2 = box
    out = np.zeros((height, width, *small.shape[2:]), bool)
    out[y1:y2, x1:x2] = resize(small.astype(float), y2 - y1, x2 - x1) >= least
    return out


def network_input(image: np.ndarray, mean=MEAN_PIXEL) -> np.ndarray:
    return image.astype(np.float32) - np.asarray(mean, np.float32)


def from_network(image: np.ndarray, mean=MEAN_PIXEL) -> np.ndarray:
    return (image + np.asarray(mean, np.float32)).astype(np.uint8)


def rasterise(ring: np.ndarray, height: int, width: int) -> np.ndarray:
    """The pixels whose centres (whole coordinates) lie inside a ring of (row, column) vertices: between pairs of its
    crossings of each row. Pixels on the line count."""
    y, x = ring[:, 0].astype(float), ring[:, 1].astype(float)
    qy, qx = np.roll(y, -1), np.roll(x, -1)
    out = np.zeros((height, width), bool)
    for r in range(max(0, int(np.ceil(y.min()))), min(height - 1, int(np.floor(y.max()))) + 1):
        cut = (y > r) != (qy > r)
        at = np.sort(x[cut] + (r - y[cut]) * (qx[cut] - x[cut]) / (qy[cut] - y[cut]))
        for a, b in zip(at[::2], at[1::2]):
            out[r, max(0, int(np.ceil(a))) : max(0, int(np.floor(b)) + 1)] = True
        for a in x[y == r]:
            if a == int(a) and 0 <= a < width:
                out[r, int(a)] = True
        flat = (y == r) & (qy == r)
        for a, b in zip(x[flat], qx[flat]):
            out[r, max(0, int(np.ceil(min(a, b)))) : max(0, int(np.floor(max(a, b))) + 1)] = True
    return out


@functools.lru_cache(4096)
def pixels_of(ring: bytes) -> int:
    """How many pixels a ring has in the frame from 0 to its farthest vertices; of (row, column) doubles, as bytes."""
    p = np.frombuffer(ring).reshape(-1, 2)
    return int(rasterise(p, int(p[:, 0].max()) + 1, int(p[:, 1].max()) + 1).sum())
