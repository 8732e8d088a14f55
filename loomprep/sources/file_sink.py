"""Sinks that write raw files: one file for each key, and ordered fixed-width
records (S9, S10).

Both are a Python data source with a commit protocol.  A task writes into a folder
of its attempt and moves each finished file to its final name, which depends on
the data only, so a repeated or speculative attempt replaces its own files.  The
driver's commit removes the attempts' folders and writes the manifest last; a
failed job removes the target.  The target must not exist before.  Files are
written through ``pyarrow.fs`` (local and shared folders, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import math
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "loomprep_raw_files"
ATTEMPTS, MANIFEST = "_attempts", "_manifest.json"
WIDTHS = {"f32": 4, "bf16": 2}


def open_folder(path: str):
    """(file system, path in it)."""
    from pyarrow import fs
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)


def encode(values, kind: str) -> bytes:
    """Little-endian float32, or bfloat16 rounded half to even."""
    import numpy as np
    x = np.ascontiguousarray(values, "<f4")
    if kind == "f32":
        return x.tobytes()
    bits = x.view("<u4")
    short = ((bits + 0x7FFF + ((bits >> 16) & 1)) >> 16).astype("<u2")
    quiet = (((bits >> 16) | 0x40) & 0xFFFF).astype("<u2")
    return np.where(np.isnan(x), quiet, short).astype("<u2").tobytes()


def decode(raw: bytes, kind: str):
    import numpy as np
    if kind == "f32":
        return np.frombuffer(raw, "<f4")
    return (np.frombuffer(raw, "<u2").astype("<u4") << 16).view("<f4")


def _npy_header(rows: int, dimension: int) -> bytes:
    import io

    import numpy as np
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(
        out, {"descr": "<f4", "fortran_order": False, "shape": (rows, dimension)})
    return out.getvalue()


@dataclass
class Written(WriterCommitMessage):
    part: int
    files: int
    rows: int
    size: int
    dimension: int | None


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.kind = options["path"], options.get("kind", "files")
        fs, root = open_folder(self.path)
        if fs.get_file_info(root).type.name != "NotFound":
            raise FileExistsError(f"the target exists: {self.path}")

    def write(self, iterator) -> Written:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        fs, root = open_folder(self.path)
        own = f"{root}/{ATTEMPTS}/{uuid.uuid4().hex}"
        fs.create_dir(own, recursive=True)
        done = (self._files if self.kind == "files" else self._records)(fs, root, own, part, iterator)
        fs.delete_dir(own)
        return done

    def _files(self, fs, root, own, part, iterator) -> Written:
        files = size = 0
        for batch in iterator:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                with fs.open_output_stream(f"{own}/{files}", compression=None) as out:
                    out.write(content)
                folder = name.rpartition("/")[0]
                if folder:
                    fs.create_dir(f"{root}/{folder}", recursive=True)
                fs.move(f"{own}/{files}", f"{root}/{name}")
                files, size = files + 1, size + len(content)
        return Written(part, files, files, size, None)

    def _records(self, fs, root, own, part, iterator) -> Written:
        import numpy as np
        rows = size = 0
        dimension = None
        with fs.open_output_stream(f"{own}/part", compression=None) as out:
            for batch in iterator:
                column = batch.column("vector")
                widths = np.diff(np.asarray(column.offsets))
                if not len(widths):
                    continue
                dimension = int(widths[0]) if dimension is None else dimension
                flat = column.flatten()
                if column.null_count or flat.null_count or (widths != dimension).any():
                    raise ValueError(f"vectors must be whole and of one dimension ({dimension})")
                raw = encode(np.asarray(flat, np.float32), self.kind)
                out.write(raw)
                rows, size = rows + len(widths), size + len(raw)
        if not rows:
            return Written(part, 0, 0, 0, None)
        fs.move(f"{own}/part", f"{root}/{part_name(part, self.kind)}")
        return Written(part, 1, rows, size, dimension)

    def commit(self, messages: list) -> None:
        fs, root = open_folder(self.path)
        fs.create_dir(root, recursive=True)
        done = sorted((m for m in messages if m is not None and m.files), key=lambda m: m.part)
        manifest: dict = {"kind": self.kind, "files": sum(m.files for m in done), "rows": sum(m.rows for m in done),
                          "bytes": sum(m.size for m in done)}
        if self.kind != "files":
            dimensions = {m.dimension for m in done}
            if len(dimensions) > 1:
                self.abort(messages)
                raise ValueError(f"vectors must be of one dimension: {sorted(dimensions)}")
            manifest["dimension"] = min(dimensions, default=0)
            first, manifest["parts"] = 0, []
            for m in done:
                manifest["parts"].append({"file": part_name(m.part, self.kind), "first_row": first, "rows": m.rows})
                first += m.rows
            if self.kind == "f32":
                with fs.open_output_stream(f"{root}/header.npy", compression=None) as out:
                    out.write(_npy_header(manifest["rows"], manifest["dimension"]))
        if fs.get_file_info(f"{root}/{ATTEMPTS}").type.name != "NotFound":
            fs.delete_dir(f"{root}/{ATTEMPTS}")
        with fs.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(manifest).encode())

    def abort(self, messages: list) -> None:
        fs, root = open_folder(self.path)
        if fs.get_file_info(root).type.name != "NotFound":
            fs.delete_dir(root)


class RawFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))


def part_name(part: int, kind: str) -> str:
    return f"part-{part:06d}.{kind}"


def write_files(df: DataFrame, path: str, name: str = "name", content: str = "content") -> None:
    """One file for each row: ``content`` (null: empty) at ``path/name``.

    Names must be relative, not null and not repeated (checked beforehand on the
    names alone); ``FileExistsError`` if the target exists."""
    rows = df.select(F.col(name).alias("name"), F.coalesce(F.col(content), F.lit(b"")).alias("content"))
    odd = F.col("name").isNull() | F.col("name").rlike(r"^(/|_|\.|$)|(^|/)\.\.?(/|$)|/$")
    bad = rows.select("name").groupBy("name").count().where(odd | (F.col("count") > 1)).limit(5).collect()
    if bad:
        raise ValueError(f"file names must be relative, whole and single: {[r.name for r in bad]}")
    spark = df.sparkSession
    spark.dataSource.register(RawFiles)
    rows.write.format(FORMAT).mode("append").option("path", path).option("kind", "files").save()


def dump_vectors(df: DataFrame, path: str, order: str = "vec_id", vector: str = "embedding", kind: str = "f32",
                 rows_per_part: int = 1 << 20) -> dict:
    """All vectors in the order of ``order`` as fixed-width little-endian records.

    ``part-*.<kind>`` files in order of their names hold the records (``f32`` or
    ``bf16``), ``header.npy`` is the header that makes them one ``.npy`` file when put in
    front (``f32``), and the manifest, written last, has the dimension and each part's
    first row.  Rows are sorted within ranges of the key, so no task holds
    more than a part; equal keys are ordered by their vectors.  Returns the manifest."""
    if kind not in WIDTHS:
        raise ValueError(f"kind must be one of {sorted(WIDTHS)}")
    rows = df.select(F.col(order).alias("k"), F.transform(vector, lambda v: v.cast("float")).alias("vector"))
    parts = max(1, math.ceil(rows.count() / rows_per_part))
    # equal keys may fill more than a part: the vector's hash splits them
    ranged = rows.repartitionByRange(parts, "k", F.xxhash64("vector")).sortWithinPartitions(
        "k", F.xxhash64("vector"), "vector")
    df.sparkSession.dataSource.register(RawFiles)
    ranged.select("vector").write.format(FORMAT).mode("append").option("path", path).option("kind", kind).save()
    return read_manifest(path)


def read_manifest(path: str) -> dict:
    fs, root = open_folder(path)
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(position, vector) of a dump, one task for each part."""
    manifest = read_manifest(path)
    schema = "position long, vector array<float>"
    if not manifest["rows"]:
        return spark.createDataFrame([], schema)
    kind, dimension = manifest["kind"], manifest["dimension"]
    first = {p["file"]: p["first_row"] for p in manifest["parts"]}

    def records(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                x = decode(content, kind).astype(np.float32)
                at = first[name.rpartition("/")[2]]
                n = len(x) // dimension
                for a in range(0, n, 65_536):
                    part = x[a * dimension:min(n, a + 65_536) * dimension]
                    m = len(part) // dimension
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.arange(at + a, at + a + m)),
                        pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * dimension),
                                                 pa.array(part))], names=["position", "vector"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"part-*.{kind}").load(path)
    return files.select("path", "content").mapInArrow(records, schema)
