"""Positions of array rows against the long form and a plain loop; grids of a batch."""

import random

import pytest
from pyspark.sql import functions as F

from loomprep.functions.constants import IMAGE_PAD_ID as IMG
from loomprep.functions.constants import VIDEO_PAD_ID as VID
from loomprep.functions.constants import VISION_END_ID as END
from loomprep.functions.constants import VISION_START_ID as START
from loomprep.operators import row_positions as R
from loomprep.operators import sequence as Q
from loomprep.plans import catalog
from conftest import SF01

SCHEMA = ("sample_id long, input_ids array<int>, m array<int>, image_grids array<struct<t:int,h:int,w:int>>, "
          "video_grids array<struct<t:int,h:int,w:int>>")


def sample(rng, k, odd):
    """Text, images and videos at random; ``odd``: runs, grids and masks that do not fit."""
    ids, images, videos = [], [], []
    for _ in range(rng.randint(0, 5)):
        ids += [rng.randint(1, 50) for _ in range(rng.randint(0, 4))]
        h, w = rng.randint(1, 3), rng.randint(1, 3)
        if rng.random() < 0.5:
            n = h * w + (rng.choice([-1, 0, 2]) if odd else 0)
            ids += [START] + [IMG] * max(n, 0) + [END]
            images.append((1, 2 * h, 2 * w))
        elif rng.random() < 0.6:
            t = rng.randint(1, 3)
            for _ in range(t):
                ids += [rng.randint(1, 50), START] + [VID] * (h * w) + [END]
            videos.append((t, 2 * h, 2 * w))
    if odd and images and rng.random() < 0.3:
        images.pop()
    if odd and rng.random() < 0.2:
        ids.append(IMG)
    mask = [int(rng.random() < 0.8) for _ in ids] if odd else [1] * len(ids)
    if not odd:                                     # pads on either side
        left, right = rng.randint(0, 3), rng.randint(0, 3)
        ids, mask = [0] * left + ids + [0] * right, [0] * left + mask + [0] * right
    return (k, ids, mask, images, videos)


def grids_of(rows):
    return [(r[0], m, o, *g) for r in rows for m, gs in (("image", r[3]), ("video", r[4])) for o, g in enumerate(gs)]


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("with_mask", [False, True])
def test_rows_equal_the_long_form(spark, odd, with_mask):
    rng = random.Random(11 + odd)
    rows = [sample(rng, k, odd) for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    grids = spark.createDataFrame(grids_of(rows), "sample_id long, modality string, ordinal int, t int, h int, w int")
    zipped = F.arrays_zip(F.col("input_ids").alias("t"), F.col("m").alias("m"))
    long = df.select("sample_id", F.posexplode(zipped).alias("pos", "z")).select(
        "sample_id", "pos", F.col("z.t").alias("token_id"), *([F.col("z.m").alias("mask")] if with_mask else []))
    want = {(r.sample_id, r.pos): (r.pos_t, r.pos_h, r.pos_w, r.delta, r.status)
            for r in Q.sequence_positions(long, grids).collect()}
    got = {(r.sample_id, k): (*p, r.delta, r.status)
           for r in R.positions_on_rows(df, mask="m" if with_mask else None).collect()
           for k, p in enumerate(r.positions)}
    assert got == want
    if odd:
        assert {v[4] for v in want.values()} == {None, "missing_grid", "grid_mismatch"}


def test_next_position_and_empty_rows(spark):
    rows = [(1, [], [], [], []), (2, None, None, None, None), (3, [START, IMG, IMG, END, 7], [1] * 5, [(1, 2, 4)], None)]
    got = {r.sample_id: r for r in R.positions_on_rows(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].positions == [] and got[1].status is None and got[2].positions is None
    assert [tuple(p) for p in got[3].positions] == [(0, 0, 0), (1, 1, 1), (1, 1, 2), (3, 3, 3), (4, 4, 4)]
    assert got[3].next_pos == 5 and got[3].delta == 0
    assert R.positions_on_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_mask_positions(spark):
    rng = random.Random(4)
    masks = [[int(rng.random() < 0.6) for _ in range(rng.randint(0, 12))] for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(masks)), "k long, attention_mask array<int>")
    for r in R.mask_positions_on_rows(df).collect():
        m, seen, want = masks[r.k], 0, []
        for x in m:
            want.append(seen if x else 1)
            seen += x
        assert r.positions == want and r.delta == (max(want) + 1 - len(m) if m else None)


def test_positions_need_no_shuffle(spark):
    conv = spark.read.parquet(f"{SF01}/conversations.parquet")
    from loomprep.sources import tokens as K
    plan = R.positions_on_rows(K.mm_rows(conv))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Python" not in plan


def batches(seed, samples=60):
    """Samples in batches of three, and each batch's grids as flat lists."""
    rng = random.Random(seed)
    rows = [sample(rng, k, False) for k in range(samples)]
    images, videos = [], []
    for b in range(0, samples, 3):
        group = rows[b:b + 3]
        images += [(b // 3, o, *g) for o, g in enumerate(g for r in group for g in r[3])]
        videos += [(b // 3, o, *g) for o, g in enumerate(g for r in group for g in r[4])]
    return rows, images, videos


def test_grids_run_across_a_batch(spark):
    rows, images, videos = batches(5)
    flat = "batch_id long, ordinal int, t int, h int, w int"
    samples = spark.createDataFrame([(r[0] // 3, r[0] % 3, *r[:3]) for r in rows],
                                    "batch_id long, slot int, sample_id long, input_ids array<int>, m array<int>")
    dealt, report = R.batch_grids(samples, spark.createDataFrame(images, flat), spark.createDataFrame(videos, flat),
                                  mask="m")
    assert report.count() == 0
    got = {r.sample_id: [tuple(p) for p in r.positions] for r in R.positions_on_rows(dealt, mask="m").collect()}
    own = spark.createDataFrame(rows, SCHEMA)
    assert got == {r.sample_id: [tuple(p) for p in r.positions]
                   for r in R.positions_on_rows(own, mask="m").collect()}


def test_a_video_may_serve_two_samples_and_mismatch_is_reported(spark):
    run = [3, START, VID, END]
    samples = spark.createDataFrame([(0, 0, 1, run * 2), (0, 1, 2, run), (1, 0, 3, run), (None, 0, 4, [START, IMG])],
                                    "batch_id long, slot int, sample_id long, input_ids array<int>")
    flat = "batch_id long, ordinal int, t int, h int, w int"
    videos = spark.createDataFrame([(0, 0, 3, 2, 2), (2, 0, 1, 2, 2)], flat)
    dealt, report = R.batch_grids(samples, spark.createDataFrame([(None, 0, 1, 2, 2)], flat), videos)
    assert {r.sample_id: (len(r.image_grids), len(r.video_grids)) for r in dealt.collect()} == {
        1: (0, 2), 2: (0, 1), 3: (0, 0), 4: (1, 0)}
    assert {(r.batch_id, r.modality, r.blocks, r.grids) for r in report.collect()} == {
        (1, "video", 1, 0), (2, "video", 0, 1)}
    assert {r.sample_id: r.status for r in R.positions_on_rows(dealt).collect()} == {
        1: None, 2: None, 3: "missing_grid", 4: None}


def test_registered_queries_are_whole(spark):
    a = catalog.QUERIES["batch_grid_positions"](spark, SF01)
    b = catalog.QUERIES["sequence_positions"](spark, SF01)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
