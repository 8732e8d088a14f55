"""Failures while reading (S7): the rows that could be read, and a row for each
file that gave fewer than it holds.

Spark skips the rest of a file whose bytes it cannot read (``ignoreCorruptFiles``)
and says nothing.  Here the files of a spec are listed first, the rows are read
and written once with the file they come from, and each file's rows are counted
against its footer; page checksums are verified while reading.  A file is
rejected with its reason when it is short of rows or cannot be opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .listing import list_data_files, literal_path, metadata_path, source_path

IGNORE = "spark.sql.files.ignoreCorruptFiles"
REJECTS = "source_file string, rows_read long, rows_held long, error string"


def _why(spark: SparkSession, path: str) -> str | None:
    """Why a file cannot be opened; None if it can (a file without rows)."""
    try:
        spark.read.parquet(literal_path(path)).schema
        return None
    except PySparkException as exc:
        return f"unreadable: {str(exc).splitlines()[0][:300]}"
    except Py4JJavaError as exc:
        cause = exc.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        return f"unreadable: {cause.getMessage()}"[:300]


def read_with_rejects(spark: SparkSession, spec: str | Sequence[str], wanted: Sequence[str] | None = None,
                      base_dir: str | None = None, schema: T.StructType | str | None = None
                      ) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of the Parquet files of a spec, whose schemas are merged.

    ``rows``: the wanted columns that exist, ``source_file`` and ``source_row``, of
    every row that could be read; ``rejects``: ``source_file, rows_read, rows_held,
    error`` of each file that lost some (``rows_held`` is null if it has no readable
    footer).  ``schema`` is needed only if no file can be opened.  The spec's order
    and repeats do not matter here; a missing file is an error of the spec."""
    files = {metadata_path(spark, p): p for p in list_data_files(spark, spec, base_dir)}
    reader = spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").option(
        "parquet.page.verify-checksum.enabled", "true")
    paths = [literal_path(p) for p in files.values()]
    before = spark.conf.get(IGNORE)
    spark.conf.set(IGNORE, "true")              # footers are read under the session's setting
    try:
        found = reader.option("mergeSchema", "true").parquet(*paths).schema
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA" or schema is None:
            raise
        found = schema
    finally:
        spark.conf.set(IGNORE, before)
    data = reader.schema(found).parquet(*paths)
    cols = [c for c in (wanted or data.columns) if c in data.columns]
    rows = materialize(data.select(*cols, source_path().alias("source_file"),
                                   F.col("_metadata.row_index").alias("source_row")), "read-rows")
    read = rows.groupBy(F.col("source_file").alias("f")).agg(F.count("*").alias("rows_read"))
    # without columns only footers are read
    held = data.select(source_path().alias("h")).groupBy("h").agg(F.count("*").alias("rows_held"))
    listed = spark.createDataFrame([(f,) for f in files], "source_file string")
    status = listed.join(held, F.col("source_file") == F.col("h"), "left").join(
        read, F.col("source_file") == F.col("f"), "left").select(
        "source_file", F.coalesce("rows_read", F.lit(0)).alias("rows_read"), "rows_held")
    short = status.where("rows_held is null or rows_read < rows_held").collect()    # failing files only
    rejects = []
    for r in short:
        error = (_why(spark, files[r.source_file]) if r.rows_held is None else
                 f"lost rows: {r.rows_read} of {r.rows_held} could be read")
        if error:
            rejects.append((r.source_file, r.rows_read, r.rows_held, error))
    return rows, spark.createDataFrame(rejects, REJECTS)
