"""Positions of sequences that arrive as arrays, one row each.

Everything is a function of the row: vision blocks are found as segments of the id
array, their grids are looked up in the row's own grid lists, and the segments are
expanded to positions again.  Nothing is exploded or shuffled.  ``batch_grids``
finds a row's grids in lists that run across a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import IMAGE_PAD_ID, MERGE_SIZE, VIDEO_PAD_ID, VISION_START_ID

AXES = ("pos_t", "pos_h", "pos_w")
GRIDS = "array<struct<t:int,h:int,w:int>>"


def _upto(n: Column) -> Column:
    """``[0, n)`` as an array (empty for n <= 0)."""
    n = F.greatest(n.cast("int"), F.lit(0))
    return F.slice(F.sequence(F.lit(0), n), F.lit(1), n)


def block_starts(ids: Column, pads: Sequence[int], start_id: int) -> Column:
    """Where a pad token follows a start token."""
    at = F.transform(ids, lambda x, i: F.when(x.isin(*pads) & (F.get(ids, i - 1) == start_id), i))
    return F.filter(at, lambda i: i.isNotNull())


def _whole(t, h, w) -> Column:
    return F.struct(t.cast("int").alias("t"), h.cast("int").alias("h"), w.cast("int").alias("w"))


def split_videos(grids: Column) -> Column:
    """Each video grid ``(t, h, w)`` as t grids ``(1, h, w)``."""
    return F.flatten(F.transform(grids, lambda g: F.array_repeat(_whole(F.lit(1), g["h"], g["w"]), g["t"])))


def _lift(axis_values) -> Column:
    return F.struct(*[v.cast("long").alias(a) for a, v in zip(AXES, axis_values)])


def positions_on_rows(rows: DataFrame, ids: str = "input_ids", images: str = "image_grids",
                      videos: str = "video_grids", mask: str | None = None, merge: int = MERGE_SIZE,
                      image_id: int = IMAGE_PAD_ID, video_id: int = VIDEO_PAD_ID,
                      start_id: int = VISION_START_ID) -> DataFrame:
    """The rows with ``positions`` (array of struct pos_t, pos_h, pos_w, one for each id),
    ``next_pos``, ``delta`` and ``status``: the values of ``sequence.sequence_positions``.

    ``images``, ``videos``: the sample's grids in order (``array<struct<t,h,w>>`` in patches;
    null: none); a video grid counts once for each of its t groups.  Null ids give null
    positions; an empty sequence has none."""
    extra = [f"_p{k}" for k in range(6)]
    kept = F.filter(ids, lambda _, i: F.get(F.col(mask), i) == 1) if mask else F.col(ids)
    none = F.array().cast(GRIDS)
    d = rows.withColumns({"_p0": kept, "_p1": F.coalesce(F.col(images).cast(GRIDS), none),
                          "_p2": split_videos(F.coalesce(F.col(videos).cast(GRIDS), none))})
    x = F.col("_p0")
    d = d.withColumn("_p3", block_starts(x, (image_id, video_id), start_id))
    first_of = lambda pad: F.filter("_p3", lambda s: F.get(x, s) == pad)
    d = d.withColumn("_p4", F.struct(first_of(image_id).alias("image"), first_of(video_id).alias("video")))

    def block(s: Column, k: Column) -> Column:
        """A block's start, end of its place (the next start), grid after merging, n and advance."""
        of_image = F.get(x, s) == image_id
        ordinal = F.when(of_image, F.array_position("_p4.image", s)).otherwise(
            F.array_position("_p4.video", s)).cast("int") - 1
        g = F.when(of_image, F.get("_p1", ordinal)).otherwise(F.get("_p2", ordinal))
        h, w = F.floor(g["h"] / merge).cast("int"), F.floor(g["w"] / merge).cast("int")
        return F.struct(s.alias("s"), F.coalesce(F.get("_p3", k + 1), F.size(x)).alias("stop"),
                        F.get(x, s).alias("pad"), h.alias("h"), w.alias("w"),
                        F.coalesce(g["t"] * h * w, F.lit(0)).alias("n"),
                        F.coalesce(F.greatest(g["t"], h, w), F.lit(0)).alias("a"), g.isNull().alias("missing"))
    d = d.withColumn("_p5", F.transform("_p3", block))
    # the blocks with what the blocks before them take off (their number is small)
    zero = F.struct(F.lit(0).alias("off"), F.array().cast("array<int>").alias("before"))
    off = F.aggregate("_p5", zero, lambda acc, b: F.struct(
        (acc["off"] + b["n"] - b["a"]).alias("off"), F.array_append(acc["before"], acc["off"]).alias("before")))
    d = d.withColumn("_p4", off["before"])

    def expand(b: Column, k: Column) -> Column:
        """The positions from a block's start to the next block."""
        before = F.get("_p4", k)
        inside = F.greatest(F.least(b["n"], b["stop"] - b["s"]), F.lit(0))
        base, hw = b["s"] - before, b["h"] * b["w"]
        vision = F.transform(_upto(inside), lambda j: _lift(
            [base + F.floor(j / hw), base + F.floor(j / b["w"]) % b["h"], base + j % b["w"]]))
        first = b["s"] + inside
        text = F.transform(_upto(b["stop"] - first), lambda j: _lift([first + j - before - b["n"] + b["a"]] * 3))
        return F.concat(vision, text)
    head = F.transform(_upto(F.coalesce(F.get("_p3", F.lit(0)), F.size(x))), lambda j: _lift([j] * 3))
    found = F.concat(head, F.flatten(F.transform("_p5", expand)))
    in_block = lambda b: F.slice(x, b["s"] + 1, F.greatest(F.least(b["n"], b["stop"] - b["s"]), F.lit(0)))
    is_pad = lambda v: v.isin(image_id, video_id)
    inner_pads = F.aggregate("_p5", F.lit(0), lambda acc, b: acc + F.size(F.filter(in_block(b), is_pad)))
    wrong = F.exists("_p5", lambda b: F.exists(in_block(b), lambda v: v != b["pad"])) | (
        F.size(F.filter(x, is_pad)) > inner_pads)
    status = F.when(F.exists("_p5", lambda b: b["missing"]), F.lit("missing_grid")).when(
        wrong, F.lit("grid_mismatch"))
    d = d.withColumns({"positions": F.when(x.isNotNull(), found), "status": status})
    top = F.array_max(F.transform("positions", lambda p: F.greatest(*[p[a] for a in AXES])))
    d = d.withColumns({"next_pos": top + 1,
                       "delta": (F.coalesce(top, F.lit(0)) + 1 - F.size(ids)).cast("long")})
    if mask:
        d = d.withColumn("positions", scatter("positions", F.col(mask), _lift([F.lit(1)] * 3)))
    return d.drop(*extra)


def position_rows(d: DataFrame, ids: str = "input_ids") -> DataFrame:
    """The long form of :func:`positions_on_rows`: a row for each token, with the other columns.

    The outer form of the explode is used because the plain one infers a filter on the
    array's size, which the optimizer pushes below the projections that build the
    array, copying their expressions into each other."""
    both = F.arrays_zip(F.col(ids).alias("token_id"), F.col("positions").alias("p"))
    rest = [c for c in d.columns if c not in (ids, "positions")]
    rows = d.select(*rest, F.posexplode_outer(both).alias("pos", "_z")).where("pos is not null")
    return rows.select(*rest, "pos", F.col("_z.token_id").alias("token_id"), "_z.p.*")


def scatter(values: str, mask: Column, masked: Column) -> Column:
    """``values`` at the places where the mask is 1, in order, and ``masked`` at the others."""
    seen = F.filter(F.transform(mask, lambda m, i: F.when(m == 1, i)), lambda i: i.isNotNull())
    rest = F.filter(F.transform(mask, lambda m, i: F.when(m == 1, None).otherwise(i)), lambda i: i.isNotNull())
    both = F.concat(F.zip_with(seen, values, lambda i, v: F.struct(i.alias("i"), v.alias("v"))),
                    F.transform(rest, lambda i: F.struct(i.alias("i"), masked.alias("v"))))
    return F.transform(F.sort_array(both), lambda p: p["v"])


def mask_positions_on_rows(rows: DataFrame, mask: str = "attention_mask") -> DataFrame:
    """The rows with ``positions`` (array<long>) and ``delta``: unmasked tokens are
    numbered from 0, masked ones get 1, ``delta = max + 1 - len``."""
    seen = F.size(F.filter(mask, lambda m: m == 1))
    d = rows.withColumn("_seen", F.transform(_upto(seen), lambda j: j.cast("long")))
    d = d.withColumn("positions", scatter("_seen", F.col(mask), F.lit(1).cast("long"))).drop("_seen")
    top = F.array_max("positions")
    return d.withColumn("delta", F.when(F.size(mask) > 0, top + 1 - F.size(mask)).cast("long"))


def batch_grids(samples: DataFrame, images: DataFrame, videos: DataFrame, batch: str = "batch_id",
                order: str = "slot", ids: str = "input_ids", mask: str | None = None,
                image_id: int = IMAGE_PAD_ID, video_id: int = VIDEO_PAD_ID,
                start_id: int = VISION_START_ID) -> tuple[DataFrame, DataFrame]:
    """Grid lists that run across a batch, dealt to its samples: ``(samples with
    image_grids and video_grids, report)``.

    ``images``, ``videos``: ``(batch, ordinal, t, h, w)`` without any sample's name, ordinal from
    0.  A sample takes as many grids as it has vision blocks, after those that the
    samples before it (by ``order``) take; a video grid serves t blocks, which may lie in
    several samples.  The report has a row for each batch and modality whose number
    of blocks differs from what its grids serve.  Amounts are summed over the
    samples of a batch (bounded by its size); grids meet their samples by the batch and
    an interval of ordinals."""
    kept = F.filter(ids, lambda _, i: F.get(F.col(mask), i) == 1) if mask else F.col(ids)
    starts = block_starts(kept, (image_id, video_id), start_id)
    count = lambda pad: F.size(F.filter(starts, lambda s: F.get(kept, s) == pad)).cast("long")
    d = samples.withColumns({"_n_image": count(image_id), "_n_video": count(video_id)})
    before = Window.partitionBy(batch).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({f"_b_{m}": F.coalesce(F.sum(f"_n_{m}").over(before), F.lit(0)) for m in ("image", "video")})
    reports = []
    for modality, grids, column in (("image", images, "image_grids"), ("video", videos, "video_grids")):
        g = grids.select(F.col(batch).alias("_gb"), F.col("ordinal").cast("long").alias("_o"),
                         *[F.col(c).cast("int") for c in ("t", "h", "w")])
        if modality == "video":         # one grid for each temporal group, numbered across the batch
            upto = Window.partitionBy("_gb").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
            g = g.withColumn("_from", F.coalesce(F.sum("t").over(upto), F.lit(0)))
            g = g.select("_gb", F.posexplode(F.array_repeat(F.lit(1), F.col("t"))).alias("_j", "t"), "h", "w", "_from")
            g = g.select("_gb", (F.col("_from") + F.col("_j")).alias("_o"), "t", "h", "w")
        mine = d.where(F.col(f"_n_{modality}") > 0).select(
            F.col(batch).alias("_sb"), F.col(order).alias("_so"), F.col(f"_b_{modality}").alias("_lo"),
            (F.col(f"_b_{modality}") + F.col(f"_n_{modality}")).alias("_hi"))
        dealt = g.join(mine, F.col("_gb").eqNullSafe(F.col("_sb")) & (F.col("_o") >= F.col("_lo"))
                       & (F.col("_o") < F.col("_hi"))).groupBy("_sb", "_so").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_o", "t", "h", "w"))),
                        lambda s: _whole(s["t"], s["h"], s["w"])).alias(column))
        d = d.join(dealt, F.col(batch).eqNullSafe(F.col("_sb")) & F.col(order).eqNullSafe(F.col("_so")), "left") \
            .drop("_sb", "_so").withColumn(column, F.coalesce(column, F.array().cast(GRIDS)))
        needed = d.groupBy(F.col(batch).alias("_nb")).agg(F.sum(f"_n_{modality}").alias("blocks"))
        served = g.groupBy("_gb").agg(F.count("*").alias("grids"))
        reports.append(needed.join(served, F.col("_nb").eqNullSafe(F.col("_gb")), "full").select(
            F.coalesce("_nb", "_gb").alias(batch), F.lit(modality).alias("modality"),
            F.coalesce("blocks", F.lit(0)).alias("blocks"), F.coalesce("grids", F.lit(0)).alias("grids"))
            .where("blocks <> grids"))
    return (d.drop(*[f"_{p}_{m}" for p in "nb" for m in ("image", "video")]),
            reports[0].unionByName(reports[1]))
