"""Patch layout of whole frames as dense arrays (SC9, SC10, W6 at real sizes).

One row holds a temporal group of frames and gives one row of patches: the pixels
stay bytes, are reshaped and transposed by an Arrow kernel a frame group at a
time, and are never exploded into rows.  An image is a group of its own and needs
no shuffle; frames of a video meet by ``(video, frame div temporal)``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import MERGE_SIZE, PATCH_SIZE, TEMPORAL_PATCH


def to_channels(frame: np.ndarray, rgb: bool) -> np.ndarray:
    """Height x width x channels; with ``rgb`` BGR(A) becomes RGB, alpha is dropped and
    grey is replicated."""
    if not rgb:
        return frame
    if frame.shape[2] == 1:
        return np.repeat(frame, 3, axis=2)
    return frame[:, :, 2::-1]


def patch_block(frames: Sequence[np.ndarray], patch: int, merge: int, temporal: int) -> np.ndarray:
    """Frames (height, width, channels) of one temporal group -> (token, element,
    channel); the last frame fills a group that is short."""
    x = np.stack([*frames, *[frames[-1]] * (temporal - len(frames))])
    tp, height, width, channels = x.shape
    side = patch * merge
    x = x.reshape(tp, height // side, merge, patch, width // side, merge, patch, channels)
    return x.transpose(1, 4, 2, 5, 0, 3, 6, 7).reshape(-1, tp * patch * patch, channels)


def _kernel(keys: list[str], patch: int, merge: int, temporal: int, rgb: bool):
    side = patch * merge

    def one(frames: list, height: int, width: int, channels: int) -> tuple[bytes | None, str | None]:
        if not frames or height is None or width is None or channels is None:
            return None, "no frame"
        if height <= 0 or width <= 0 or height % side or width % side:
            return None, "size"
        size = height * width * channels
        if any(f is None or len(f) != size for f in frames):
            return None, "payload"
        shaped = [to_channels(np.frombuffer(f, np.uint8).reshape(height, width, channels), rgb) for f in frames]
        return patch_block(shaped, patch, merge, temporal).tobytes(), None

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):        # a frame group at a time
                row = batch.slice(k, 1)
                height, width, channels = (row.column(c)[0].as_py() for c in ("_h", "_w", "_c"))
                values, error = one([f.as_py() for f in row.column("_frames")[0].values or []]
                                    if row.column("_frames")[0].is_valid else [], height, width, channels)
                grid = [None] * 3 if error else [height // patch, width // patch,
                                                 3 if rgb else channels]
                yield pa.RecordBatch.from_arrays(
                    [row.column(c) for c in keys] + [pa.array([v], pa.int32()) for v in grid]
                    + [pa.array([values], pa.binary()), pa.array([error], pa.string())],
                    names=[*keys, "grid_h", "grid_w", "channels", "patches", "error"])
    return run


def dense_patches(frames: DataFrame, keys: Sequence[str], pixels: str | Column, height, width, channels,
                  patch: int = PATCH_SIZE, merge: int = MERGE_SIZE, temporal: int = TEMPORAL_PATCH,
                  rgb: bool = True, frame: str | None = None) -> DataFrame:
    """``keys``, t, grid_h, grid_w, channels, patches, error: one row for each
    temporal group of an item, ``patches`` being its bytes in the order (token,
    element, channel) of ``vision.patchify``.

    ``pixels``: row-major bytes of one frame, channel last.  Without ``frame`` each row
    is an image of its own; with it rows of equal ``keys`` are the frames of a video
    in the order of that column (a number from 0).  A null or wrong payload, a side that is no multiple of ``patch * merge``
    and frames of different sizes in one group give a null ``patches`` and the reason."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = frames.select(*keys, *([F.col(frame).alias("_at")] if frame else [F.lit(0).alias("_at")]),
                         as_column(pixels).alias("_px"), as_column(height).cast("int").alias("_h"),
                         as_column(width).cast("int").alias("_w"), as_column(channels).cast("int").alias("_c"))
    rows = rows.withColumn("t", F.floor(F.col("_at") / temporal).cast("int"))
    if frame is None:
        groups = rows.select(*keys, "t", F.array("_px").alias("_frames"), "_h", "_w", "_c")
    else:
        same = lambda c: F.when(F.min(c) == F.max(c), F.max(c)).alias(c)
        groups = rows.groupBy(*keys, "t").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_at", "_px"))), lambda s: s["_px"]).alias("_frames"),
            same("_h"), same("_w"), same("_c"))
    names = [*keys, "t"]
    schema = T.StructType([*groups.select(*names).schema.fields, *T._parse_datatype_string(
        "grid_h int, grid_w int, channels int, patches binary, error string").fields])
    return groups.mapInArrow(_kernel(names, patch, merge, temporal, rgb), schema)


def pixel_bytes(values: Column | str) -> Column:
    """An array of numbers 0 to 255 as bytes."""
    two = F.transform(values, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0"))
    return F.unhex(F.array_join(two, ""))
