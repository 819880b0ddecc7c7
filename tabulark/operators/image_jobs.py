"""Image table jobs that need real pixel work, in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions.landmarks import unit_interval

GRAY_BGR = np.array([0.114, 0.587, 0.299])  # fixed values: luma weights in BGR order


def area_weights(size: int, target: int) -> np.ndarray:
    """(target, size) matrix that averages each target cell's stretch of the source."""
    edges = np.arange(target + 1) * (size / target)
    cells = np.arange(size)
    low = np.maximum(edges[:-1, None], cells[None, :])
    high = np.minimum(edges[1:, None], cells[None, :] + 1)
    overlap = np.clip(high - low, 0.0, None)
    return overlap / overlap.sum(axis=1, keepdims=True)


def _round_bytes(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values + 0.5), 0, 255)


def decode_pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width, channels)


def crop_to_gray(
    pixels: np.ndarray, box: Sequence[int], side: int, flip: bool, work_width: int | None
) -> np.ndarray:
    """Square cut with repeated edges, gray, area-resized, in 0..1."""
    if flip:
        pixels = pixels[:, ::-1]
    height, width = pixels.shape[:2]
    x1, y1, x2, y2 = box
    rows = np.clip(np.arange(y1, y2), 0, height - 1)
    columns = np.clip(np.arange(x1, x2), 0, width - 1)
    cut = pixels[rows][:, columns].astype(np.float64)
    if work_width and width > work_width:
        shrink = work_width / width
        tall, wide = max(1, int(len(rows) * shrink)), max(1, int(len(columns) * shrink))
        cut = _round_bytes(
            np.einsum("ij,jkc,lk->ilc", area_weights(len(rows), tall), cut,
                      area_weights(len(columns), wide))
        )
    gray = cut[..., 0] if cut.shape[2] == 1 else _round_bytes(cut[..., :3] @ GRAY_BGR)
    small = area_weights(gray.shape[0], side) @ gray @ area_weights(gray.shape[1], side).T
    return (_round_bytes(small) / 255.0).astype(np.float32)


def image_crop_resize(
    images: DataFrame,
    keep: Sequence[str],
    side: int = K.IMAGE_SIDE,
    flip: bool = False,
    work_width: int | None = None,
) -> DataFrame:
    """Cut each decoded image (height, width, nChannels, data, box) to a gray
    ``side`` x ``side`` array in 0..1. ``box`` is a square struct x1, y1, x2, y2; without
    a box or without an image the pixels are null."""
    corners = F.array("box.x1", "box.y1", "box.x2", "box.y2")
    whole = F.forall(corners, lambda x: x.isNotNull()) & F.col("data").isNotNull()
    source = images.select(
        *keep, "height", "width", "nChannels", "data", F.when(whole, corners).alias("box"),
    )
    schema = ", ".join(
        [f"`{c}` {images.schema[c].dataType.simpleString()}" for c in keep] + ["pixels array<float>"]
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [
                None if b is None
                else crop_to_gray(
                    decode_pixels(d, int(h), int(w), int(c)), b, side, flip, work_width
                ).ravel()
                for d, h, w, c, b in zip(
                    batch["data"], batch["height"], batch["width"], batch["nChannels"], batch["box"]
                )
            ]
            yield batch[list(keep)].assign(pixels=done)

    return source.mapInPandas(cut, schema)


def warp(images: np.ndarray, turn, shift_x, shift_y, zoom) -> np.ndarray:
    """Rotate, shift and zoom a stack (n, s, s) about its centre; empty areas are 0."""
    n, side, _ = images.shape
    centre = (side - 1) / 2.0
    y, x = np.meshgrid(np.arange(side) - centre, np.arange(side) - centre, indexing="ij")
    column = lambda v: np.asarray(v, dtype=np.float64).reshape(n, 1, 1)
    c, s, z = np.cos(column(turn)), np.sin(column(turn)), column(zoom)
    away_x, away_y = x - column(shift_x) * side, y - column(shift_y) * side
    source_x = (c * away_x + s * away_y) / z + centre
    source_y = (-s * away_x + c * away_y) / z + centre
    left, top = np.floor(source_x).astype(int), np.floor(source_y).astype(int)
    part_x, part_y = source_x - left, source_y - top
    out = np.zeros(images.shape)
    which = np.arange(n).reshape(n, 1, 1)
    for dy, weight_y in ((0, 1 - part_y), (1, part_y)):
        for dx, weight_x in ((0, 1 - part_x), (1, part_x)):
            row, col = top + dy, left + dx
            inside = (row >= 0) & (row < side) & (col >= 0) & (col < side)
            value = images[which, np.clip(row, 0, side - 1), np.clip(col, 0, side - 1)]
            out += np.where(inside, value, 0.0) * weight_y * weight_x
    return out


def image_augment(
    df: DataFrame,
    id_column: str,
    pixels: str,
    keep: Sequence[str],
    side: int = K.IMAGE_SIDE,
    copies: int = 1,
    seed: int = 0,
    turn: float = 0.04,
    shift: float = 0.08,
    zoom: float = 0.1,
) -> DataFrame:
    """Randomly turned, shifted and zoomed copies of each image, never mirrored.
    The draws depend on (seed, id, copy) only."""

    def spread(name: str, limit: float) -> Column:
        draw = unit_interval(F.lit(name), F.lit(seed), F.col(id_column), F.col("copy"))
        return (draw * 2 - 1) * limit

    numbered = df.select(
        *keep, F.col(pixels).cast("array<double>").alias("_pixels"),
        F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"),
    )
    drawn = numbered.withColumns(
        {
            "_turn": spread("turn", turn * 2 * math.pi),
            "_x": spread("x", shift),
            "_y": spread("y", shift),
            "_zoom": 1 + spread("zoom", zoom),
        }
    )
    schema = ", ".join(
        [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
        + ["copy int", "pixels array<double>"]
    )

    def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            stack = np.stack(batch["_pixels"].to_numpy()).reshape(-1, side, side)
            out = warp(stack, batch["_turn"], batch["_x"], batch["_y"], batch["_zoom"])
            yield batch[[*keep, "copy"]].assign(pixels=list(out.reshape(len(batch), -1)))

    return drawn.mapInPandas(turned, schema)
