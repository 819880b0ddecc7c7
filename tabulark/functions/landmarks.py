"""Hand-landmark geometry as array expressions, evaluated inside the JVM.

Points are ``array<struct<x,y,z>>`` with the wrist first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.arrays import bind

EPSILON = 1e-6


def _point(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def is_left(handedness: Column) -> Column:
    return F.coalesce(F.lower(handedness).startswith("left"), F.lit(False))


def landmark_normalize(points: Column, handedness: Column) -> Column:
    """63 pose-free numbers: wrist at the origin, left hands mirrored, the middle
    knuckle turned to point up, and the farthest point at distance 1."""
    side = F.when(is_left(handedness), F.lit(-1.0)).otherwise(F.lit(1.0))

    def shifted(wrist: Column) -> Column:
        return F.transform(
            points,
            lambda p: _point(
                (p["x"] - wrist["x"]) * side, p["y"] - wrist["y"], p["z"] - wrist["z"]
            ),
        )

    def turned(moved: Column) -> Column:
        knuckle = F.element_at(moved, K.MIDDLE_KNUCKLE + 1)
        length = F.sqrt(knuckle["x"] * knuckle["x"] + knuckle["y"] * knuckle["y"])
        # Turning (kx, ky) onto (0, -length) has cosine -ky/length and sine -kx/length.
        frame = F.when(
            length > EPSILON,
            F.struct((-knuckle["y"] / length).alias("c"), (-knuckle["x"] / length).alias("s")),
        ).otherwise(F.struct(F.lit(1.0).alias("c"), F.lit(0.0).alias("s")))
        return bind(
            frame,
            lambda t: F.transform(
                moved,
                lambda p: _point(
                    p["x"] * t["c"] - p["y"] * t["s"], p["x"] * t["s"] + p["y"] * t["c"], p["z"]
                ),
            ),
        )

    def sized(straight: Column) -> Column:
        squares = F.transform(straight, lambda p: p["x"] * p["x"] + p["y"] * p["y"])
        reach = F.sqrt(F.array_max(squares))
        return bind(
            F.when(reach > 0, reach).otherwise(F.lit(1.0)),
            lambda r: F.flatten(
                F.transform(straight, lambda p: F.array(p["x"] / r, p["y"] / r, p["z"] / r))
            ),
        )

    moved = bind(F.element_at(points, K.WRIST + 1), shifted)
    return bind(bind(moved, turned), sized)


def hand_bbox(points: Column, width: Column, height: Column, padding: float = 0.2) -> Column:
    """Pixel box around the hand, padded relative to the hand and cut to the frame;
    null when nothing is left."""

    def edges(axis: str, size: Column) -> tuple[Column, Column]:
        values = F.transform(points, lambda p: p[axis])
        low, high = F.array_min(values), F.array_max(values)
        pad = (high - low) * padding
        return (
            F.greatest(F.lit(0.0), (low - pad) * size).cast("int"),
            F.least(size.cast("double"), (high + pad) * size).cast("int"),
        )

    x1, x2 = edges("x", width)
    y1, y2 = edges("y", height)
    box = F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    return F.when((x2 > x1) & (y2 > y1), box)


def square_box(box: Column, width: Column, height: Column, margin: float = 1.0) -> Column:
    """Square around the centre of a box, and how far it sticks out on each side."""
    centre_x = F.floor((box["x1"] + box["x2"]) / 2).cast("int")
    centre_y = F.floor((box["y1"] + box["y2"]) / 2).cast("int")
    longest = F.greatest(box["x2"] - box["x1"], box["y2"] - box["y1"])
    half = F.greatest((longest * margin / 2).cast("int"), F.lit(1))
    left, top = centre_x - half, centre_y - half
    right, bottom = centre_x + half, centre_y + half
    zero = F.lit(0)
    square = F.struct(
        left.alias("x1"), top.alias("y1"), right.alias("x2"), bottom.alias("y2"),
        F.greatest(zero, -top).alias("pad_top"),
        F.greatest(zero, bottom - height).alias("pad_bottom"),
        F.greatest(zero, -left).alias("pad_left"),
        F.greatest(zero, right - width).alias("pad_right"),
    )
    return F.when(box.isNotNull(), square)


def center_square_box(width: Column, height: Column) -> Column:
    """Largest centred square of a frame, for frames without a found hand."""
    side = F.least(width, height)
    x0 = F.floor((width - side) / 2).cast("int")
    y0 = F.floor((height - side) / 2).cast("int")
    return F.struct(
        x0.alias("x1"), y0.alias("y1"), (x0 + side).alias("x2"), (y0 + side).alias("y2")
    )


def crop_box(box: Column, width: Column, height: Column, margin: float = 1.0) -> Column:
    """Square around a found hand, else the largest centred square of the frame."""
    square = square_box(box, width, height, margin)
    corners = F.struct(*[square[c].alias(c) for c in ("x1", "y1", "x2", "y2")])
    return F.when(box.isNotNull(), corners).otherwise(center_square_box(width, height))


def unit_interval(*parts: Column) -> Column:
    """A number in (0, 1] that depends on the given values only."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return (bits.cast("double") + 1) / float(2**53)


def gaussian(*parts: Column) -> Column:
    """Standard normal draw tied to the given values, so independent of partitioning."""
    radius = F.sqrt(-2 * F.log(unit_interval(F.lit("r"), *parts)))
    return radius * F.cos(2 * math.pi * unit_interval(F.lit("a"), *parts))


def jitter_points(points: Column, sigma: float, *parts: Column) -> Column:
    """Gaussian noise on every coordinate."""

    def moved(p: Column, i: Column) -> Column:
        return _point(
            *[
                p[axis] + sigma * gaussian(i, F.lit(axis), *parts)
                for axis in ("x", "y", "z")
            ]
        )

    return F.transform(points, moved)
