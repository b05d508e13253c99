"""Boxes, page transforms and render sizes as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bbox(polygons: Column) -> Column:
    """[x0, y0, x1, y1] around polygons (arrays of points); points without two coordinates are dropped; none gives zeros."""
    points = F.filter(F.flatten(polygons), lambda p: F.size(p) >= 2)
    x, y = F.transform(points, lambda p: F.get(p, F.lit(0))), F.transform(points, lambda p: F.get(p, F.lit(1)))
    box = F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y))
    return F.when(F.size(points) > 0, box).otherwise(F.array(*[F.lit(0.0)] * 4))


def render_contract(w_pt: Column, h_pt: Column, w_px: Column, h_px: Column, rotation: Column) -> Column:
    """Scales and both 2 x 3 transforms between points and pixels."""
    w, h = F.greatest(w_pt.cast("double"), F.lit(1.0)), F.greatest(h_pt.cast("double"), F.lit(1.0))
    x, y = F.greatest(w_px.cast("int"), F.lit(1)) / w, F.greatest(h_px.cast("int"), F.lit(1)) / h
    zero = F.lit(0.0)
    return F.struct(
        w.alias("w_pt"), h.alias("h_pt"), x.alias("px_per_pt_x"), y.alias("px_per_pt_y"), (x * 72).alias("dpi"), F.pmod(rotation.cast("int"), F.lit(360)).alias("rotation"),
        F.array(x, zero, zero, y, zero, zero).alias("pdf_to_px"), F.array(1 / x, zero, zero, 1 / y, zero, zero).alias("px_to_pdf"),
    )


def affine(x: Column, y: Column, m: Column) -> tuple[Column, Column]:
    a, b, c, d, e, f = (F.get(m, F.lit(i)) for i in range(6))
    return a * x + c * y + e, b * x + d * y + f


def box_to_px(x: Column, y: Column, w: Column, h: Column, m: Column) -> Column:
    (x0, y0), (x1, y1) = affine(x, y, m), affine(x + w, y + h, m)
    return F.struct(F.least(x0, x1).alias("x0"), F.least(y0, y1).alias("y0"), F.greatest(x0, x1).alias("x1"), F.greatest(y0, y1).alias("y1"))


def render_size(w_pt: Column, h_pt: Column, anchored: Column, longest: int = 1288) -> Column:
    """(w, h) in pixels: 200 or 300 dots an inch, scaled down to the longest side."""
    dpi = F.when(anchored, F.lit(200.0)).otherwise(F.lit(300.0))
    w, h = w_pt / 72 * dpi, h_pt / 72 * dpi
    k = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(w, h))
    return F.struct(F.floor(w * k).cast("int").alias("w"), F.floor(h * k).cast("int").alias("h"))


def bbox_pixels(box: Column, width: Column, height: Column) -> Column:
    """Whole pixels of a box given in pixels or in shares of the crop; null if empty."""
    v = [F.get(box, F.lit(i)).cast("double") for i in range(4)]
    share = (F.least(*v) >= -0.05) & (F.greatest(*v) <= 1.5)
    kx, ky = F.when(share, width.cast("double")).otherwise(1.0), F.when(share, height.cast("double")).otherwise(1.0)
    x0, y0, x1, y1 = v[0] * kx, v[1] * ky, v[2] * kx, v[3] * ky
    hold = lambda c, most: F.greatest(F.lit(0), F.least(most, c)).cast("int")
    out = F.array(hold(F.floor(F.least(x0, x1)), width), hold(F.floor(F.least(y0, y1)), height), hold(F.ceil(F.greatest(x0, x1)), width), hold(F.ceil(F.greatest(y0, y1)), height))
    return F.when((F.get(out, F.lit(2)) > F.get(out, F.lit(0))) & (F.get(out, F.lit(3)) > F.get(out, F.lit(1))), out)


def pad_box(box: Column, share: float, width: Column, height: Column) -> Column:
    x0, y0, x1, y1 = (F.get(box, F.lit(i)) for i in range(4))
    dx, dy = F.ceil((x1 - x0) * share).cast("int"), F.ceil((y1 - y0) * share).cast("int")
    return F.array(F.greatest(F.lit(0), x0 - dx), F.greatest(F.lit(0), y0 - dy), F.least(width, x1 + dx), F.least(height, y1 + dy))


def cell_box(row_boxes: Column, col_boxes: Column, r0: Column, r1: Column, c0: Column, c1: Column) -> Column:
    """Box of a span from boxes of rows and of columns; null outside them or if empty."""
    rows, cols = F.slice(row_boxes, r0 + 1, r1 - r0 + 1), F.slice(col_boxes, c0 + 1, c1 - c0 + 1)
    at = lambda boxes, k: F.transform(boxes, lambda b: F.get(b, F.lit(k)))
    out = F.array(F.array_min(at(cols, 0)), F.array_min(at(rows, 1)), F.array_max(at(cols, 2)), F.array_max(at(rows, 3)))
    ok = (r0 >= 0) & (c0 >= 0) & (r1 < F.size(row_boxes)) & (c1 < F.size(col_boxes))
    return F.when(ok & (F.get(out, F.lit(2)) > F.get(out, F.lit(0))) & (F.get(out, F.lit(3)) > F.get(out, F.lit(1))), out)
