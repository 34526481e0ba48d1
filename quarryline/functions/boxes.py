"""Box expressions over (y1, x1, y2, x2) columns; the far side is exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "", suffix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{c}{suffix}") for c in ("y1", "x1", "y2", "x2"))


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def overlap(a: Box, b: Box) -> Column:
    """Area of the intersection."""
    high = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    wide = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    return high * wide


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where both are empty."""
    both = overlap(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def apply_deltas(b: Box, d: Box) -> Box:
    """Move the centre by d[0:2] sizes and scale the size by exp(d[2:4])."""
    h, w = b[2] - b[0], b[3] - b[1]
    cy, cx = b[0] + h * 0.5 + d[0] * h, b[1] + w * 0.5 + d[1] * w
    h, w = h * F.exp(d[2]), w * F.exp(d[3])
    return cy - h * 0.5, cx - w * 0.5, cy + h * 0.5, cx + w * 0.5


def refinement(b: Box, gt: Box) -> Box:
    """The deltas that move b to gt; the inverse of apply_deltas."""
    h, w, gh, gw = b[2] - b[0], b[3] - b[1], gt[2] - gt[0], gt[3] - gt[1]
    return (
        (gt[0] + gh * 0.5 - (b[0] + h * 0.5)) / h, (gt[1] + gw * 0.5 - (b[1] + w * 0.5)) / w, F.ln(gh / h), F.ln(gw / w)
    )


def clip(b: Box, window: Box) -> Box:
    return tuple(F.greatest(F.least(v, window[2 + k % 2]), window[k % 2]) for k, v in enumerate(b))


def normalise(b: Box, h: Column, w: Column) -> Box:
    """Pixels to 0..1, where the far side becomes inclusive."""
    return b[0] / (h - 1), b[1] / (w - 1), (b[2] - 1) / (h - 1), (b[3] - 1) / (w - 1)


def denormalise(b: Box, h: Column, w: Column) -> Box:
    """0..1 to pixels, rounded half to even."""
    return tuple(F.rint(v * ((h if k % 2 == 0 else w) - 1) + (0 if k < 2 else 1)).cast("int") for k, v in enumerate(b))


def from_window(b: Box, window: Box, h: Column, w: Column) -> Box:
    """Normalised boxes of a padded image in pixels of the image of h x w that fills the normalised window."""
    tall, wide = window[2] - window[0], window[3] - window[1]
    own = tuple((v - window[k % 2]) / (tall if k % 2 == 0 else wide) for k, v in enumerate(b))
    return denormalise(own, h, w)


def smooth_l1(a: Column, b: Column) -> Column:
    """Half the square of a difference below 1, the difference less a half from there."""
    d = F.abs(a - b)
    return F.when(d < 1, d * d / 2).otherwise(d - 0.5)


def pyramid_level(b: Box, image_area: Column) -> Column:
    """The feature level of a box in normalised coordinates: 4 at 224 pixels, one more per doubling, within 2..5."""
    size = F.sqrt(area(b)) / (F.lit(224.0) / F.sqrt(image_area))
    return F.least(F.lit(5), F.greatest(F.lit(2), F.lit(4) + F.rint(F.log2(size)).cast("int")))
