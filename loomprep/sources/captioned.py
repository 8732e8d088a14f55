"""Captioned-image rows ``(item_id, question, answer array<string>, image
struct<bytes, path>)`` and the choice of an image payload (S1, S5).

The test tables hold no images; a captioned row is derived from every
assistant turn of ``conversations``: question = the user turn right before it,
answer = the lines of the assistant text, image = the page of ``pages`` whose
``page_id`` equals ``conv_id * 16 + turn`` (so some rows have no image, as in
real data, and two rows may show one page).  ``item_id`` is the pair
``(conv_id, turn)`` packed into one long, turn in the lower 32 bits.  Adjacent turns are matched by an equi-join on
``(conv_id, turn)`` so a very long conversation is spread by both keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM_STRIDE = 1 << 32
PAGE_STRIDE = 16
WANTED = ("question", "answer", "image")


def scan_optional_columns(df: DataFrame, wanted: Sequence[str] = WANTED) -> DataFrame:
    """Only those wanted columns that exist (column pruning reaches the scan)."""
    return df.select(*[c for c in wanted if c in df.columns])


def item_key() -> Column:
    """``(conv_id, turn)`` packed into one long."""
    return (F.col("conv_id") * F.lit(ITEM_STRIDE) + F.col("turn")).cast("bigint")


def captioned_images(conversations: DataFrame, pages: DataFrame) -> DataFrame:
    """Captioned-image rows derived from ``conversations`` and ``pages`` (see module doc)."""
    a = conversations.where(F.col("role") == "assistant").select("conv_id", "turn", "text")
    prev = conversations.select("conv_id", (F.col("turn") + 1).alias("turn"),
                                F.col("role").alias("prev_role"), F.col("text").alias("prev_text"))
    item_id = item_key()
    page_id = (F.col("conv_id") * PAGE_STRIDE + F.col("turn")).cast("bigint")
    rows = (a.join(prev, ["conv_id", "turn"], "left")
            .select(item_id.alias("item_id"), page_id.alias("_page"), "conv_id", "turn",
                    F.when(F.col("prev_role") == "user", F.col("prev_text")).alias("question"),
                    F.split(F.col("text"), "\n").alias("answer")))
    # the payload flag is computed before the join, so when only the flag is
    # used the payload itself is pruned and never crosses the shuffle
    img = pages.select(F.col("page_id").alias("_page"),
                       F.struct(F.encode(F.col("html"), "UTF-8").alias("bytes"),
                                F.col("url").alias("path")).alias("image"),
                       F.coalesce(F.length(F.col("html")) > 0, F.lit(False)).alias("_has"))
    out = rows.join(img, "_page", "left")
    return out.withColumn("has_image", F.coalesce(F.col("_has"), F.lit(False))).drop("_has", "_page")


def inline_payload(image: str = "image") -> Column:
    """Non-empty inline ``bytes`` of an image struct, else null."""
    b = F.col(f"{image}.bytes")
    return F.when(F.length(b) > 0, b)


def with_payload(df: DataFrame, files: DataFrame, image: str = "image", out: str = "payload") -> DataFrame:
    """Payload of each row: non-empty inline ``bytes``, else the file found
    at ``image.path`` in ``files(path, data)`` (for example Spark's image or
    binaryFile source), else null.  A left join on the path; rows without a
    payload stay (validity is decided later)."""
    f = files.select(F.col("path").alias("_p"), F.col("data").alias("_data"))
    return (df.join(f, F.col(f"{image}.path") == F.col("_p"), "left")
            .withColumn(out, F.coalesce(inline_payload(image), F.col("_data"))).drop("_p", "_data"))


def has_payload(image: str = "image") -> Column:
    """True when the image struct carries non-empty inline bytes."""
    return F.coalesce(F.length(F.col(f"{image}.bytes")) > 0, F.lit(False))


ROW_BITS = 40          # item_id = spec position << 40 | row index in the file


def normalize_captioned(df: DataFrame) -> DataFrame:
    """Canonical captioned rows from whatever of ``question, answer, image``
    exists: missing columns become nulls, a plain-string ``answer`` is lifted
    to a one-element array, ``has_image`` is derived from the payload."""
    from pyspark.sql import types as T
    cols = {f.name: f.dataType for f in df.schema.fields}
    q = F.col("question").cast("string") if "question" in cols else F.lit(None).cast("string")
    if "answer" not in cols:
        a = F.lit(None).cast("array<string>")
    elif isinstance(cols["answer"], T.ArrayType):
        a = F.col("answer").cast("array<string>")
    else:
        a = F.when(F.col("answer").isNotNull(), F.array(F.col("answer").cast("string")))
    img_t = "struct<bytes:binary,path:string>"
    img = F.col("image") if "image" in cols else F.lit(None).cast(img_t)
    keep = [c for c in df.columns if c not in ("question", "answer", "image")]
    out = df.select(*keep, q.alias("question"), a.alias("answer"), img.alias("image"))
    return out.withColumn("has_image", has_payload("image"))


def read_captioned(spark, spec, base_dir: str | None = None) -> DataFrame:
    """Captioned rows of a file spec in reading order.

    Files are resolved like the spec says (order kept, repeats kept) and
    read once each with only the wanted columns; ``item_id`` is the spec
    position of the file and the row's index inside it, so ranks by
    ``item_id`` follow the order in which a sequential reader meets the rows.
    A file listed twice yields its rows twice (one copy per position)."""
    from .listing import list_data_files, literal_path, metadata_path, source_path
    listed = list_data_files(spark, spec, base_dir)          # file names only
    occ = spark.createDataFrame([(metadata_path(spark, f), k) for k, f in enumerate(listed)],
                                "_file string, file_idx long")
    df = spark.read.parquet(*map(literal_path, dict.fromkeys(listed)))
    d = df.select(*[c for c in WANTED if c in df.columns],
                  source_path().alias("_path"), F.col("_metadata.row_index").alias("_row"))
    d = d.join(occ, F.col("_path") == F.col("_file"))        # one row per spec entry
    d = d.withColumn("item_id", F.shiftleft(F.col("file_idx"), ROW_BITS) + F.col("_row")) \
        .drop("_path", "_file", "_row")
    return normalize_captioned(d)


def with_found_images(df: DataFrame, files: DataFrame, image: str = "image") -> DataFrame:
    """``has_image`` is also true for rows without inline bytes whose
    ``image.path`` is among ``files`` (column ``path``; only paths travel)."""
    found = files.select(F.col("path").alias("_found")).distinct()
    return (df.join(found, F.col(f"{image}.path") == F.col("_found"), "left")
            .withColumn("has_image", has_payload(image) | F.col("_found").isNotNull()).drop("_found"))
