"""Two-dimensional geometry as column expressions.

A box is a struct x1, y1, x2, y2 of page pixels (INT), a rect the same of page shares (DOUBLE).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilframe.functions.numeric import ceil_to, clamp, draw, floor_to, half_even, num, toward_zero

MIN_SIDE = 0.004
PAD, COARSE_PAD = 2, 12


def box(x1, y1, x2, y2) -> Column:
    return F.struct(*[num(v).cast("int").alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (x1, y1, x2, y2), strict=True)])


def rect(x1, y1, x2, y2) -> Column:
    return F.struct(*[num(v).cast("double").alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (x1, y1, x2, y2), strict=True)])


def area(b: Column) -> Column:
    return (b.x2 - b.x1).cast("double") * (b.y2 - b.y1)


def overlap_area(a: Column, b: Column) -> Column:
    """Shared area; boxes that only touch share none."""
    w = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)
    h = F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    return F.when((w > 0) & (h > 0), w.cast("double") * h).otherwise(0.0)


def iou(a: Column, b: Column) -> Column:
    inter = overlap_area(a, b)
    return F.when(inter > 0, inter / (area(a) + area(b) - inter)).otherwise(0.0)


def cover(b: Column, outer: Column) -> Column:
    """Share of b that lies in outer; also the containment of a box in a tile."""
    return F.when(area(b) > 0, overlap_area(b, outer) / area(b)).otherwise(0.0)


def overlap_ratio(a: Column, b: Column) -> Column:
    """Shared area against the smaller box."""
    small = F.least(area(a), area(b))
    return F.when(small > 0, overlap_area(a, b) / small).otherwise(0.0)


def center_in(b: Column, outer: Column) -> Column:
    cx, cy = (b.x1 + b.x2) / 2.0, (b.y1 + b.y2) / 2.0
    return (cx >= outer.x1) & (cx <= outer.x2) & (cy >= outer.y1) & (cy <= outer.y2)


def dist2(b: Column, cx: Column, cy: Column) -> Column:
    dx, dy = (b.x1 + b.x2) / 2.0 - cx, (b.y1 + b.y2) / 2.0 - cy
    return dx * dx + dy * dy


def rects_overlap(a: Column, b: Column) -> Column:
    return (a.x1 < b.x2) & (b.x1 < a.x2) & (a.y1 < b.y2) & (b.y1 < a.y2)


def quad_to_box(quad: Column) -> Column:
    """Smallest integer box around an array of [x, y] points."""
    xs, ys = F.transform(quad, lambda p: p[0]), F.transform(quad, lambda p: p[1])
    return box(F.floor(F.array_min(xs)), F.floor(F.array_min(ys)), F.ceil(F.array_max(xs)), F.ceil(F.array_max(ys)))


def union_box(boxes: Column) -> Column:
    """Box around an array of boxes; null for an empty array."""
    side = lambda f, n: f(F.transform(boxes, lambda b: b[n]))
    return F.when(F.size(boxes) > 0, box(side(F.array_min, "x1"), side(F.array_min, "y1"), side(F.array_max, "x2"), side(F.array_max, "y2")))


def pad_box(b: Column, by, page_w, page_h) -> Column:
    return box(F.greatest(b.x1 - num(by), F.lit(0)), F.greatest(b.y1 - num(by), F.lit(0)), F.least(b.x2 + num(by), num(page_w)), F.least(b.y2 + num(by), num(page_h)))


def denorm(r: Column, w, h) -> Column:
    """Rect to pixels: corners in order, halves to even, at least one pixel."""
    x1, x2 = half_even(F.least(r.x1, r.x2) * num(w)), half_even(F.greatest(r.x1, r.x2) * num(w))
    y1, y2 = half_even(F.least(r.y1, r.y2) * num(h)), half_even(F.greatest(r.y1, r.y2) * num(h))
    return box(x1, y1, F.greatest(x2, x1 + 1), F.greatest(y2, y1 + 1))


def norm(b: Column, w, h) -> Column:
    w, h = num(w), num(h)
    some = (w > 0) & (h > 0)
    share = lambda v, side: F.when(some, v / side).otherwise(0.0)
    return rect(share(b.x1, w), share(b.y1, h), share(b.x2, w), share(b.y2, h))


def crop_pixels(r: Column, w, h) -> Column:
    """Pixels that a normalised rect cuts out: halves to even, at least one, inside the page."""
    w, h = num(w), num(h)
    x1, y1 = clamp(half_even(r.x1 * w), 0, w - 1), clamp(half_even(r.y1 * h), 0, h - 1)
    return box(x1, y1, clamp(half_even(r.x2 * w), x1 + 1, w), clamp(half_even(r.y2 * h), y1 + 1, h))


def rect_to_pixels(r: Column, w, h) -> Column:
    return box(half_even(r.x1 * num(w)), half_even(r.y1 * num(h)), half_even(r.x2 * num(w)), half_even(r.y2 * num(h)))


def tile_to_page(local: Column, tile: Column) -> Column:
    w, h = tile.x2 - tile.x1, tile.y2 - tile.y1
    return rect(tile.x1 + local.x1 * w, tile.y1 + local.y1 * h, tile.x1 + local.x2 * w, tile.y1 + local.y2 * h)


def tiles(width, height, count: int = 3, overlap: float = 0.08, factor: int = 32) -> Column:
    """Array of rects that cover the page along its longer side in strips of one thickness, snapped to factor.

    The thickness is widened by factor until no gap is left: the least number of steps without one.
    """
    width, height = num(width), num(height)
    if count <= 1:
        return F.array(rect(0.0, 0.0, 1.0, 1.0))
    share = min(max(overlap, 0.0), 0.5)
    upright = height >= width
    span = F.when(upright, height).otherwise(width)
    f = max(1, factor)
    up = lambda v: F.least(span, ceil_to(F.ceil(v), f))
    least = F.greatest(up(span / count), up(span / count * (1 + 2 * share)))
    thick = lambda k: F.least(span, least + k * f)

    def start(t, i: int):
        last = span - t
        return F.lit(0) if i == 0 else last.cast("int") if i == count - 1 else floor_to(last * i / (count - 1), f)

    def gapless(t):
        ok = t >= span
        whole = F.lit(True)
        for i in range(count - 1):
            whole = whole & (start(t, i + 1) <= start(t, i) + t)
        return ok | whole

    steps = F.sequence(F.lit(0), F.ceil(span / f).cast("int"))
    t = F.element_at(F.filter(F.transform(steps, thick), gapless), 1)
    strips = [F.struct(start(t, i).alias("lo"), (start(t, i) + t).alias("hi")) for i in range(count)]
    as_rect = lambda s: F.when(upright, rect(0.0, s.lo / height, 1.0, s.hi / height)).otherwise(rect(s.lo / width, 0.0, s.hi / width, 1.0))
    return F.transform(F.array(*strips), as_rect)


def smart_resize(height, width, factor: int = 32, max_pixels: int = 0, min_pixels: int = 0) -> Column:
    """Size (h, w) that a vision encoder sees: multiples of factor between two pixel counts."""
    height, width = num(height).cast("double"), num(width).cast("double")
    hi, lo = float(max_pixels or 16384 * factor * factor), float(min_pixels or 4 * factor * factor)
    snapped = lambda v: F.greatest(F.lit(factor), half_even(v / factor) * factor)
    h, w = snapped(height), snapped(width)
    big, small = h.cast("double") * w > hi, h.cast("double") * w < lo
    down, grow = F.sqrt(height * width / hi), F.sqrt(lo / F.greatest(F.lit(1.0), height * width))
    side = lambda v, s: F.when(big, F.greatest(F.lit(factor), floor_to(v / down, factor))).when(small, F.greatest(F.lit(factor), ceil_to(toward_zero(v * grow), factor))).otherwise(s)
    return F.struct(side(height, h).alias("h"), side(width, w).alias("w"))


def fit_side(height, width, most: int) -> Column:
    """Shrink so that the longer side is at most `most`; 0 or less leaves it."""
    height, width = num(height), num(width)
    longest = F.greatest(height, width)
    shrink = longest > most if most > 0 else F.lit(False)
    side = lambda v: F.when(shrink, F.greatest(F.lit(1), toward_zero(v * (most / longest)))).otherwise(v)
    return F.struct(side(height).alias("h"), side(width).alias("w"))


def crop_box(b: Column, w, h, ratio: float = 0.35, least: int = 64) -> Column:
    """Search area around a box: each axis grows by a share of its size, not less than `least`."""
    px = F.greatest(F.lit(least), toward_zero((b.x2 - b.x1) * ratio))
    py = F.greatest(F.lit(least), toward_zero((b.y2 - b.y1) * ratio))
    return box(F.greatest(F.lit(0), b.x1 - px), F.greatest(F.lit(0), b.y1 - py), F.least(num(w), b.x2 + px), F.least(num(h), b.y2 + py))


def crop_scale(b: Column, upscale: float = 2.0, most: int = 1600) -> Column:
    """Enlargement of a crop: at least 1, and not beyond `most` pixels on the longer side."""
    longest = F.greatest(b.x2 - b.x1, b.y2 - b.y1)
    wanted = F.lit(max(1.0, upscale))
    return F.when(longest * wanted > most, F.greatest(F.lit(1.0), F.lit(float(most)) / longest)).otherwise(wanted)


def crop_to_page(b: Column, crop: Column, scale: Column) -> Column:
    """Near corner without its fraction, far corner to the nearest pixel."""
    return box(crop.x1 + toward_zero(b.x1 / scale), crop.y1 + toward_zero(b.y1 / scale), crop.x1 + half_even(b.x2 / scale), crop.y1 + half_even(b.y2 / scale))


def canvas_fit(w, h, canvas_w: int = 1760, canvas_h: int = 2464) -> Column:
    """Scale onto a fixed canvas, size, padding right and below, and whether over 15 % is padding."""
    w, h = num(w), num(h)
    scale = F.least(F.lit(float(canvas_w)) / w, F.lit(float(canvas_h)) / h)
    nw, nh = F.greatest(F.lit(1), half_even(w * scale)), F.greatest(F.lit(1), half_even(h * scale))
    waste = 1 - nw.cast("double") * nh / (canvas_w * canvas_h)
    return F.struct(scale.alias("scale"), nw.alias("w"), nh.alias("h"), (canvas_w - nw).alias("pad_x"), (canvas_h - nh).alias("pad_y"), (waste > 0.15).alias("wasteful"))


def align_padding(side, align: int = 32) -> Column:
    return F.pmod(-num(side), F.lit(align))


def deskew_applies(angle: Column, least: float = 0.4, most: float = 15.0) -> Column:
    """The angle is brought to -45 .. 45 degrees first."""
    turned = F.when(angle > 45, angle - 90).when(angle < -45, angle + 90).otherwise(angle)
    return (F.abs(turned) >= least) & (F.abs(turned) <= most)


def sane_rect(raw: Column, sx=1.0, sy=1.0) -> Column:
    """Model coordinates as a rect: four numbers or null; scaled, clamped, ordered, widened where degenerate."""
    v = F.transform(raw, lambda x: x.cast("double"))
    at = lambda i, s: clamp(F.get(v, F.lit(i)) / num(s), 0.0, 1.0)
    xa, ya, xb, yb = at(0, sx), at(1, sy), at(2, sx), at(3, sy)

    def pair(a, b):
        lo, hi = F.least(a, b), F.greatest(a, b)
        thin = hi - lo < MIN_SIDE
        return F.when(thin, F.greatest(F.lit(0.0), lo - MIN_SIDE)).otherwise(lo), F.when(thin, F.least(F.lit(1.0), hi + MIN_SIDE)).otherwise(hi)

    (x1, x2), (y1, y2) = pair(xa, xb), pair(ya, yb)
    whole = (F.size(raw) == 4) & ~F.exists(v, lambda x: x.isNull())
    return F.when(whole, rect(x1, y1, x2, y2))


def to_permille(b: Column, tile: Column, w, h) -> Column:
    """Box as integers 0 .. 1000 of a tile; the inverse of decoding."""
    share = lambda v, side, lo, hi: half_even(clamp((v / num(side) - lo) / F.greatest(hi - lo, F.lit(1e-9)), 0.0, 1.0) * 1000)
    return F.array(share(b.x1, w, tile.x1, tile.x2), share(b.y1, h, tile.y1, tile.y2), share(b.x2, w, tile.x1, tile.x2), share(b.y2, h, tile.y1, tile.y2))


def roundtrip(permille: Column, tile: Column, w, h) -> Column:
    return denorm(tile_to_page(sane_rect(permille, 1000.0, 1000.0), tile), w, h)


def quantization_limit(tile: Column, w, h) -> Column:
    """Pixels of one step of a thousandth, on the coarser axis."""
    return F.greatest((tile.x2 - tile.x1) * num(w), (tile.y2 - tile.y1) * num(h)) / 1000.0


def scaled_regions(tile: Column, scale: float, key: Column, seed: int = 0) -> Column:
    """A part of the tile, 1 / scale of each side, at a place that key and seed decide."""
    place = lambda salt: draw(seed, salt, key, 1_000_003) / 1_000_002.0
    w, h = (tile.x2 - tile.x1) / scale, (tile.y2 - tile.y1) / scale
    x, y = tile.x1 + place("x") * ((tile.x2 - tile.x1) - w), tile.y1 + place("y") * ((tile.y2 - tile.y1) - h)
    return rect(x, y, x + w, y + h)


def badge(b: Column, text_w, text_h, w, h, pad: int = 3) -> Column:
    """Where a label goes: above its box if there is room, else below, inside the page."""
    bw, bh = num(text_w) + 2 * pad, num(text_h) + 2 * pad
    y = F.when(b.y1 - bh >= 0, b.y1 - bh).otherwise(F.least(b.y2, num(h) - bh))
    x = F.greatest(F.lit(0), F.least(b.x1, num(w) - bw))
    return box(x, F.greatest(F.lit(0), y), x + bw, F.greatest(F.lit(0), y) + bh)
