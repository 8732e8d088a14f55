"""File sources and sinks.

Listing touches names only (``listing``: any file system; ``resolve_data_files``:
the driver's own disk); reading is Spark's own (parquet with column pruning, the
``image`` source for frames).  ``rejects`` reads files that may be damaged,
``file_sink`` writes raw files.
"""

from __future__ import annotations

import glob as _glob
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .listing import GLOB_CHARS, list_data_files, literal_path


def _has_scheme(p: str) -> bool:
    return "://" in p


def resolve_data_files(spec: str | Sequence[str], base_dir: str | None = None) -> list[str]:
    """Comma-separated file spec -> ordered list of files.

    Items are trimmed, blanks ignored; a glob in the item is expanded in
    sorted order (files only); order of the items and repeats are kept; a
    relative item is also tried against ``base_dir``; a missing literal (or a
    glob with no file) raises ``FileNotFoundError``; an empty result raises
    ``ValueError``."""
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    out: list[str] = []
    for raw in items:
        item = raw.strip()
        if not item:
            continue
        if _has_scheme(item):
            out.append(item)
            continue
        cands = [os.path.expanduser(item)]
        if base_dir and not os.path.isabs(cands[0]):
            cands.append(os.path.join(base_dir, cands[0]))
        found = False
        for c in cands:
            if any(ch in os.path.basename(c) for ch in GLOB_CHARS):
                hits = [os.path.abspath(h) for h in sorted(_glob.glob(c)) if os.path.isfile(h)]
                if hits:
                    out.extend(hits)
                    found = True
                    break
            if os.path.isfile(c):          # also a literal name with [ ] in it
                out.append(os.path.abspath(c))
                found = True
                break
        if not found:
            raise FileNotFoundError(f"data file not found: {item}")
    if not out:
        raise ValueError("the file spec names no file")
    return out


def read_parquet_files(spark: SparkSession, spec: str | Sequence[str], wanted: Sequence[str] | None = None,
                       base_dir: str | None = None, provenance: bool = True) -> DataFrame:
    """Parquet files of a spec; only the wanted columns that exist; the
    source file as ``source_file`` (from the hidden ``_metadata`` column)."""
    df = spark.read.parquet(*[literal_path(p) for p in list_data_files(spark, spec, base_dir)])
    cols = [c for c in (wanted or df.columns) if c in df.columns]
    extra = [F.col("_metadata.file_path").alias("source_file")] if provenance else []
    return df.select(*cols, *extra)


def safe_source(make: Callable[[], DataFrame], schema: T.StructType | str, spark: SparkSession,
                name: str = "source") -> tuple[DataFrame, dict]:
    """Create a source; on failure return an empty frame of ``schema`` and a
    status saying why (never silently)."""
    try:
        return make(), {"source": name, "ok": True, "error": None}
    except Exception as exc:  # the caller decides whether an empty source is acceptable
        return spark.createDataFrame([], schema), {"source": name, "ok": False, "error": repr(exc)}


def read_frames(spark: SparkSession, path: str, video_id=None, drop_invalid: bool = False) -> DataFrame:
    """Image files -> frame rows ``(video_id, frame_idx, origin, height,
    width, nChannels, data)`` in path order per video (lexicographic).  The
    default video is the parent folder.  Invalid files stay as rows with
    ``height = -1`` unless ``drop_invalid``."""
    from ..operators.vision import frame_index_by_path
    img = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower()).load(path)
    d = img.select("image.origin", "image.height", "image.width", "image.nChannels", "image.mode", "image.data")
    vid = video_id if video_id is not None else F.regexp_extract("origin", r"^(.*)/[^/]*$", 1)
    return frame_index_by_path(d, vid, "origin")


def write_patches(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Patch rows to parquet; by default fails when the target exists."""
    df.write.mode(mode).parquet(path)
