"""Small pixel images and image sizes derived from the input tables (the
tables hold no image files): every ``embeddings`` vector becomes an 8x8
single-channel image, every page an image size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDE = 8


def vector_pixels(embeddings: DataFrame) -> DataFrame:
    """(vec_id, pixels array<int>): ``clip(floor((2v + 1) * 127.5), 0, 255)``."""
    px = F.transform("embedding", lambda v: F.least(F.lit(255), F.greatest(
        F.lit(0), F.floor((v.cast("double") * 2 + 1) * 127.5).cast("int"))).cast("int"))
    return embeddings.select("vec_id", px.alias("pixels"))


def page_image_sizes(pages: DataFrame) -> DataFrame:
    """(page_id, width, height): ``100 + length(html) mod 1200`` by
    ``100 + (37 * page_id) mod 900``."""
    return pages.select("page_id", (100 + F.pmod(F.length("html"), F.lit(1200))).cast("int").alias("width"),
                        (100 + F.pmod(F.col("page_id") * 37, F.lit(900))).cast("int").alias("height"))
