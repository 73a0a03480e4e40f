"""Boxes: conversions between centre, pixel and corner form, overlap and IoU."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pixels_from_centre(xc: Column, yc: Column, w: Column, h: Column, width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """Normalised centre form to pixel (left, top, width, height), truncated toward 0."""
    i = lambda c: c.cast("int")
    return i((xc - w / 2) * width), i((yc - h / 2) * height), i(w * width), i(h * height)


def centre_from_pixels(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    return (x + w / 2) / width, (y + h / 2) / height, w / width, h / height


def corners(x: Column, y: Column, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    return x, y, x + w, y + h


def clamped(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """Corner form within the image."""
    clip = lambda c, most: F.greatest(F.lit(0), F.least(c, most))
    return clip(x0, width), clip(y0, height), clip(x1, width), clip(y1, height)


def intersection(a: tuple, b: tuple) -> Column:
    """Area shared by two boxes in corner form."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0.0))


def iou(a: tuple, b: tuple) -> Column:
    both = intersection(a, b)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def fit_within(w: Column, h: Column, most_w: int, most_h: int) -> tuple[Column, Column]:
    """Dimensions scaled down to fit, with their ratio kept; smaller ones stay."""
    scale = F.least(F.lit(1.0), most_w / w, most_h / h)
    return F.floor(w * scale).cast("int"), F.floor(h * scale).cast("int")
