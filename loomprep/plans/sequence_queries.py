"""Registered queries: token sequences, positions, chunks, gathers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.constants import (CHUNK_LEN, CONTEXT_LEN, IMAGE_PAD_ID, PREFILL_LEN, VIDEO_PAD_ID,
                                   VISION_END_ID, VISION_START_ID)
from ..operators import prepare as P
from ..operators import row_positions as R
from ..operators import sequence as Q
from ..sources import tokens as K
from ..sources.tables import table
from .registry import register
from .sql import hashed_id, words

S = K.SAMPLE_STRIDE
V = "v"                                  # column of nv: the number of vectors
NV = "nv AS (SELECT greatest(1, count(*)) AS v FROM embeddings)"
END = P.MSG_END_ID


def _marker(ms: int) -> str:
    return hashed_id(f"'<{ms}ms>'", V)


def ids_md5(ids: str):
    """Digest of an id array in order."""
    return F.md5(F.array_join(F.col(ids).cast("array<string>"), ",")).alias("ids_md5")


def _vocab(spark, sf) -> int:
    return K.vocab_size(table(spark, sf, "embeddings"))


# words and derived grid per conversation turn
BASE = f"""
{NV},
tw AS (SELECT CAST(conv_id * {S} + turn AS BIGINT) AS sample_id, conv_id, turn, role,
              {words('text')} AS ws, v FROM conversations, nv),
base AS (SELECT *, CAST(1 + len(ws) % 3 AS INTEGER) AS hh, CAST(1 + turn % 2 AS INTEGER) AS ww,
                role = 'user' AS has_img, role = 'user' AND turn >= 2 AS has_vid,
                list_transform(ws, lambda x: {hashed_id('x', V)}) AS wid FROM tw)"""

EMPTY = "CAST([] AS INTEGER[])"


def _rep(n: str, v: int) -> str:
    return f"list_resize({EMPTY}, {n}, {v})"


SEQS = f"""{BASE.strip()},
seqs AS (
  SELECT sample_id, conv_id, turn, role, hh, ww, has_img, has_vid, v, list_concat(
    CASE WHEN has_img THEN list_concat([{VISION_START_ID}], {_rep('hh * ww', IMAGE_PAD_ID)}, [{VISION_END_ID}])
         ELSE {EMPTY} END,
    wid,
    CASE WHEN has_vid THEN list_concat([{_marker(250)}, {VISION_START_ID}], {_rep('hh * ww', VIDEO_PAD_ID)},
                                       [{VISION_END_ID}, {_marker(1250)}, {VISION_START_ID}],
                                       {_rep('hh * ww', VIDEO_PAD_ID)}, [{VISION_END_ID}])
         ELSE {EMPTY} END) AS ids
  FROM base),
tk AS (SELECT sample_id, CAST(generate_subscripts(ids, 1) - 1 AS INTEGER) AS pos, unnest(ids) AS token_id
       FROM seqs)"""


def _mm(spark, sf):
    """All samples as id arrays, and their grids."""
    conv = table(spark, sf, "conversations", spread_small=True)
    return K.mm_sequences(conv, _vocab(spark, sf)), K.vision_grids(conv)


POSITIONS = f"""
WITH {SEQS},
lg AS (SELECT *, lag(token_id) OVER (PARTITION BY sample_id ORDER BY pos) AS prev FROM tk),
bl AS (SELECT *, coalesce(prev = {VISION_START_ID} AND token_id = {IMAGE_PAD_ID}, false) AS is_img,
              coalesce(prev = {VISION_START_ID} AND token_id = {VIDEO_PAD_ID}, false) AS is_vid FROM lg),
bo AS (SELECT *, sum(CASE WHEN is_img THEN 1 ELSE 0 END) OVER w - 1 AS img_ord,
                 sum(CASE WHEN is_vid THEN 1 ELSE 0 END) OVER w - 1 AS vid_ord
       FROM bl WINDOW w AS (PARTITION BY sample_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT sample_id, 'image' AS modality, 0 AS ordinal, 1 AS t, hh, ww FROM base WHERE has_img
      UNION ALL SELECT sample_id, 'video', 0, 1, hh, ww FROM base WHERE has_vid
      UNION ALL SELECT sample_id, 'video', 1, 1, hh, ww FROM base WHERE has_vid),
blocks AS (
  SELECT bo.sample_id, bo.pos AS s, g.t * g.hh * g.ww AS n, greatest(g.t, g.hh, g.ww) AS a, g.hh, g.ww
  FROM bo JOIN g ON g.sample_id = bo.sample_id
   AND ((bo.is_img AND g.modality = 'image' AND g.ordinal = bo.img_ord)
     OR (bo.is_vid AND g.modality = 'video' AND g.ordinal = bo.vid_ord))),
cum AS (SELECT *, sum(n - a) OVER (PARTITION BY sample_id ORDER BY s
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS shrink FROM blocks),
j AS (SELECT tk.sample_id, tk.pos, tk.token_id, cum.s, cum.n, cum.a, cum.hh, cum.ww, coalesce(cum.shrink, 0) AS shrink,
             cum.s IS NOT NULL AND tk.pos < cum.s + cum.n AS in_blk
      FROM tk ASOF LEFT JOIN cum ON tk.sample_id = cum.sample_id AND tk.pos >= cum.s),
p AS (SELECT sample_id, pos, token_id,
        CAST(CASE WHEN in_blk THEN s - (shrink - (n - a)) + (pos - s) // (hh * ww) ELSE pos - shrink END AS BIGINT) AS pos_t,
        CAST(CASE WHEN in_blk THEN s - (shrink - (n - a)) + ((pos - s) // ww) % hh ELSE pos - shrink END AS BIGINT) AS pos_h,
        CAST(CASE WHEN in_blk THEN s - (shrink - (n - a)) + (pos - s) % ww ELSE pos - shrink END AS BIGINT) AS pos_w
      FROM j)
SELECT sample_id, pos, token_id, pos_t, pos_h, pos_w,
       CAST(max(greatest(pos_t, pos_h, pos_w)) OVER (PARTITION BY sample_id) + 1
            - count(*) OVER (PARTITION BY sample_id) AS BIGINT) AS delta,
       CAST(NULL AS VARCHAR) AS status
FROM p"""


def _position_rows(d):
    return R.position_rows(d).select("sample_id", "pos", "token_id", *R.AXES, "delta", "status")


@register("sequence_positions", POSITIONS)
def sequence_positions(spark, sf):
    """Token rows and grid rows, as they come from other operators."""
    seqs, grids = _mm(spark, sf)
    return Q.sequence_positions(K.token_rows(seqs), grids)


@register("row_positions", POSITIONS)
def row_positions(spark, sf):
    """The sequences arrive as arrays with their grids: positions of the row, no shuffle."""
    conv = table(spark, sf, "conversations", spread_small=True)
    return _position_rows(R.positions_on_rows(K.mm_rows(conv, _vocab(spark, sf))))


BATCH_TURNS = 8
BATCH = f"{{0}} // {S} AS c, {{0}} % {S} // {BATCH_TURNS} AS b"
ONE_BATCH = f"PARTITION BY sample_id // {S}, sample_id % {S} // {BATCH_TURNS}"


@register("batch_grid_positions", POSITIONS
          .replace("PARTITION BY sample_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),",
                   f"{ONE_BATCH} ORDER BY sample_id, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),")
          .replace("SELECT sample_id, 'image' AS modality, 0 AS ordinal, 1 AS t, hh, ww FROM base WHERE has_img",
                   f"SELECT {BATCH.format('sample_id')}, 'image' AS modality, row_number() OVER ({ONE_BATCH} "
                   "ORDER BY sample_id) - 1 AS ordinal, 1 AS t, hh, ww FROM base WHERE has_img")
          .replace("SELECT sample_id, 'video', 0, 1, hh, ww FROM base WHERE has_vid\n      UNION ALL "
                   "SELECT sample_id, 'video', 1, 1, hh, ww FROM base WHERE has_vid",
                   f"SELECT {BATCH.format('sample_id')}, 'video', row_number() OVER ({ONE_BATCH} "
                   "ORDER BY sample_id, part) - 1, 1, hh, ww "
                   "FROM base, (SELECT unnest([0, 1]) AS part) WHERE has_vid")
          .replace("g.sample_id = bo.sample_id", f"g.c = bo.sample_id // {S} AND g.b = bo.sample_id % {S} // {BATCH_TURNS}"))
def batch_grid_positions(spark, sf):
    """Eight turns of a conversation are a batch whose grids come as two flat lists, without
    the sample they belong to: each sample takes its own by the counts before it."""
    rows = K.mm_rows(table(spark, sf, "conversations", spread_small=True), _vocab(spark, sf))
    batch = (F.col("conv_id") * F.lit(S) + F.floor(F.col("turn") / BATCH_TURNS)).alias("batch_id")

    def flat(column):
        g = rows.where(F.col(column).isNotNull()).select(batch, "turn", F.explode(column).alias("g"))
        nth = F.row_number().over(Window.partitionBy("batch_id").orderBy("turn")) - 1
        return g.select("batch_id", nth.alias("ordinal"), "g.*")
    samples = rows.select(batch, F.col("turn").alias("slot"), "sample_id", "input_ids")
    dealt, _ = R.batch_grids(samples, flat("image_grids"), flat("video_grids"))
    return _position_rows(R.positions_on_rows(dealt))


@register("row_mask_positions", f"""
WITH {BASE.strip()},
r AS (SELECT sample_id, CAST(len(ws) % 5 AS INTEGER) AS n_pad, CAST(len(ws) AS INTEGER) AS n FROM base),
u AS (SELECT *, CAST(unnest(range(n_pad + n)) AS INTEGER) AS pos FROM r)
SELECT sample_id, pos, CAST(CASE WHEN pos < n_pad THEN 1 ELSE pos - n_pad END AS BIGINT) AS position,
       CAST(greatest(n - 1, CASE WHEN n_pad > 0 THEN 1 ELSE 0 END) + 1 - n_pad - n AS BIGINT) AS delta FROM u""")
def row_mask_positions(spark, sf):
    """Left-padded masks on the row (as many pads as words modulo 5)."""
    t = K.text_sequences(table(spark, sf, "conversations"), _vocab(spark, sf))
    ones = F.transform("input_ids", lambda _: F.lit(1))
    mask = F.concat(F.array_repeat(F.lit(0), F.size("input_ids") % 5), ones)
    d = R.mask_positions_on_rows(t.select("sample_id", mask.alias("attention_mask")))
    return d.select("sample_id", F.posexplode_outer("positions").alias("pos", "position"), "delta").where(
        "pos is not null")


@register("visual_mask", f"""
WITH {SEQS}
SELECT sample_id, CAST(ceil(len(ids) / {CHUNK_LEN}) * {CHUNK_LEN} AS INTEGER) AS mask_len,
       CAST(len(list_filter(ids, lambda x: x IN ({IMAGE_PAD_ID}, {VIDEO_PAD_ID}))) AS INTEGER) AS n_visual,
       array_to_string(list_filter(list_transform(ids, lambda x, i:
         CASE WHEN x IN ({IMAGE_PAD_ID}, {VIDEO_PAD_ID}) THEN i - 1 ELSE -1 END), lambda y: y >= 0), ',') AS slots
FROM seqs""")
def visual_mask(spark, sf):
    seqs, _ = _mm(spark, sf)
    m = seqs.select("sample_id", Q.visual_mask("input_ids").alias("m"))
    slots = F.filter(F.transform("m", lambda x, i: F.when(x, i).otherwise(-1)), lambda y: y >= 0)
    return m.select("sample_id", F.size("m").alias("mask_len"),
                    F.size(F.filter("m", lambda x: x)).alias("n_visual"),
                    F.array_join(slots.cast("array<string>"), ",").alias("slots"))


@register("capacity_reasons", f"""
WITH {SEQS}
SELECT sample_id, CAST(len(ids) AS INTEGER) AS n_tokens,
       CASE WHEN len(ids) > {CONTEXT_LEN} THEN 'over_context' WHEN len(ids) > {PREFILL_LEN} THEN 'over_prefill' END
         AS skip_reason
FROM seqs""")
def capacity_reasons(spark, sf):
    seqs, _ = _mm(spark, sf)             # every sample once, with its reason (null = it fits)
    n = F.size("input_ids")
    return seqs.select("sample_id", n.alias("n_tokens"), Q.capacity_reason(n).alias("skip_reason"))


@register("sequence_chunks", f"""
WITH {SEQS}
SELECT sample_id, CAST(pos // {CHUNK_LEN} AS INTEGER) AS chunk, CAST(count(*) AS INTEGER) AS n_tokens,
       min(pos) AS first_pos, CAST((pos // {CHUNK_LEN} + 1) * {CHUNK_LEN} AS INTEGER) AS kv_len,
       md5(string_agg(CAST(token_id AS VARCHAR), ',' ORDER BY pos)) AS ids_md5,
       CAST(sum(pos + 1) AS BIGINT) AS kv_visible_sum
FROM tk GROUP BY sample_id, pos // {CHUNK_LEN}""")
def sequence_chunks(spark, sf):
    seqs, _ = _mm(spark, sf)
    c = Q.array_chunks(seqs)
    total = F.aggregate("kv_visible", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return c.select("sample_id", "chunk", "n_tokens", "first_pos", "kv_len", ids_md5("token_ids"),
                    total.alias("kv_visible_sum"))


@register("expand_placeholders", f"""
WITH {BASE.strip()}
SELECT sample_id, 'image' AS modality, CAST(hh * ww + 2 AS INTEGER) AS n_tokens,
       array_to_string(list_concat([{VISION_START_ID}], {_rep('hh * ww', IMAGE_PAD_ID)}, [{VISION_END_ID}]), ',') AS ids
FROM base WHERE has_img
UNION ALL
SELECT sample_id, 'video', CAST(2 * (hh * ww + 3) AS INTEGER),
       array_to_string(list_concat([{_marker(250)}, {VISION_START_ID}], {_rep('hh * ww', VIDEO_PAD_ID)},
         [{VISION_END_ID}, {_marker(1250)}, {VISION_START_ID}], {_rep('hh * ww', VIDEO_PAD_ID)}, [{VISION_END_ID}]), ',')
FROM base WHERE has_vid""")
def expand_placeholders(spark, sf):
    g = K.vision_grids(table(spark, sf, "conversations"))
    ids = Q.media_tokens("modality", "t", "h", "w", F.lit(2.0), vocab=_vocab(spark, sf))
    return g.select("sample_id", "modality", F.size(ids).alias("n_tokens"),
                    F.array_join(ids.cast("array<string>"), ",").alias("ids"))


@register("visual_token_count", f"""
WITH {BASE.strip()},
g AS (SELECT sample_id, 'image' AS modality, 1 AS frames, hh * 32 AS height, ww * 32 AS width FROM base WHERE has_img
      UNION ALL SELECT sample_id, 'video', 4 - CAST(conv_id % 4 = 3 AS INTEGER), hh * 32, ww * 32 FROM base WHERE has_vid)
SELECT sample_id, modality, CAST(ceil(frames / 2) AS INTEGER) AS grid_t, CAST(height // 16 AS INTEGER) AS grid_h,
       CAST(width // 16 AS INTEGER) AS grid_w,
       CAST(ceil(frames / 2) * (height // 16 // 2) * (width // 16 // 2) AS INTEGER) AS n_visual
FROM g""")
def visual_token_count(spark, sf):
    conv = table(spark, sf, "conversations")
    g = K.vision_grids(conv).join(conv.select(K.sample_id().alias("sample_id"), "conv_id"), "sample_id")
    frames = F.when(F.col("modality") == "image", F.lit(1)) \
        .otherwise(4 - (F.pmod(F.col("conv_id"), F.lit(4)) == 3).cast("int"))
    d = g.select("sample_id", "modality", frames.alias("frames"), (F.col("h") * 16).alias("height"),
                 (F.col("w") * 16).alias("width"))
    thw = Q.grid_thw("frames", "height", "width")
    return d.select("sample_id", "modality", thw["t"].alias("grid_t"), thw["h"].alias("grid_h"),
                    thw["w"].alias("grid_w"), Q.visual_tokens(thw["t"], thw["h"], thw["w"]).alias("n_visual"))


# ------------------------------------------------------------ padding / masks

PADDED = f"""
{NV},
tw AS (SELECT CAST(conv_id * {S} + turn AS BIGINT) AS sample_id, {words('text')} AS ws, v FROM conversations, nv),
bt AS (SELECT sample_id, len(ws) AS n, list_transform(ws, lambda x: {hashed_id('x', V)}) AS ids, (row_number() OVER (ORDER BY sample_id) - 1) // 4 AS batch_id FROM tw),
pb AS (SELECT *, max(n) OVER (PARTITION BY batch_id) AS padded_len FROM bt)"""


@register("pad_batches", f"""
WITH {PADDED.strip()}
SELECT sample_id, CAST(batch_id AS BIGINT) AS batch_id, CAST(padded_len AS INTEGER) AS padded_len,
       CAST(padded_len - n AS INTEGER) AS n_pad, CAST(n AS BIGINT) AS mask_sum,
       md5(array_to_string(list_concat({_rep('padded_len - n', 0)}, ids), ',')) AS ids_md5,
       array_to_string(list_concat({_rep('padded_len - n', 0)}, {_rep('n', 1)}), '') AS mask FROM pb""")
def pad_batches(spark, sf):
    p = Q.pad_batches(K.text_sequences(table(spark, sf, "conversations"), _vocab(spark, sf)), 4)
    ms = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))
    return p.select("sample_id", "batch_id", F.size("input_ids").alias("padded_len"),
                    (F.size("input_ids") - ms).cast("int").alias("n_pad"), ms.alias("mask_sum"),
                    ids_md5("input_ids"),
                    F.array_join(F.col("attention_mask").cast("array<string>"), "").alias("mask"))


@register("mask_positions", f"""
WITH {PADDED.strip()},
r AS (SELECT sample_id, padded_len - n AS n_pad, padded_len, unnest(range(padded_len)) AS pos FROM pb),
p AS (SELECT sample_id, CAST(pos AS INTEGER) AS pos, CAST(CASE WHEN pos < n_pad THEN 1 ELSE pos - n_pad END AS BIGINT) AS position,
             padded_len FROM r)
SELECT sample_id, pos, position, CAST(max(position) OVER (PARTITION BY sample_id) + 1 - padded_len AS BIGINT) AS delta
FROM p""")
def mask_positions(spark, sf):
    conv = table(spark, sf, "conversations")
    tasks = K.row_tasks(conv, 4)         # a batch's samples are padded to its longest
    p = Q.pad_batches(K.text_sequences(conv, _vocab(spark, sf)), 4, tasks=tasks)
    p = p.repartition(tasks, "sample_id")    # as arrays: the token rows keep the partitioning
    rows = K.token_rows(p, mask="attention_mask", carry=("batch_id", "slot"))
    return Q.mask_positions(rows, ("batch_id", "slot")).select("sample_id", "pos", "position", "delta")


# ---------------------------------------------------------------- gathers

def _esum(col):
    """Sum of the components, each times its place, so that their order counts."""
    placed = F.transform(col, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(placed, F.lit(0.0).cast("double"), lambda a, x: a + x), 4)


ESUM = "round(list_sum(list_transform({0}, lambda x, i: CAST(x AS DOUBLE) * i)), 4)"

TEXT_TOK = f"""
{NV},
tw AS (SELECT CAST(conv_id * {S} + turn AS BIGINT) AS sample_id, {words('text')} AS ws, v FROM conversations, nv),
tt AS (SELECT sample_id, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos,
              {hashed_id('unnest(ws)', V)} AS token_id FROM tw)"""


GATHER = f"""
WITH {TEXT_TOK.strip()}
SELECT sample_id, pos, token_id, {ESUM.format('e.embedding')} AS emb_sum,
       CASE WHEN e.vec_id IS NULL THEN 'unknown_id' END AS status
FROM tt LEFT JOIN embeddings e ON e.vec_id = tt.token_id"""


def _gather(spark, sf, vectors, **how):
    toks = K.token_rows(K.text_sequences(table(spark, sf, "conversations", spread_small=True),
                                          _vocab(spark, sf)))
    g = Q.embedding_gather(toks, vectors, **how)
    return g.select("sample_id", "pos", "token_id", _esum(F.col("embedding")).alias("emb_sum"), "status")


@register("embedding_gather", GATHER)
def embedding_gather(spark, sf):
    return _gather(spark, sf, table(spark, sf, "embeddings"))


@register("embedding_gather_split", GATHER)
def embedding_gather_split(spark, sf):
    """As for a vector table too large to broadcast: a shuffled join, frequent ids split."""
    return _gather(spark, sf, table(spark, sf, "embeddings").hint("shuffle_hash"), salt="auto")


def _vision_vectors(spark, sf, seqs, layer: int):
    """Vision rows (sample_id, vis_idx, embedding) derived from embeddings:
    the k-th visual slot of a sample takes vector ``(7*sample + k + 100*layer)
    mod`` the number of vectors."""
    n_vis = F.size(F.filter("input_ids", lambda x: x.isin(IMAGE_PAD_ID, VIDEO_PAD_ID)))
    slots = seqs.where(n_vis > 0).select("sample_id", F.explode(F.sequence(F.lit(0), n_vis - 1)).alias("vis_idx"))
    slots = slots.withColumn("vec_id", F.pmod(F.col("sample_id") * 7 + F.col("vis_idx") + 100 * layer, F.lit(_vocab(spark, sf))))
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return slots.join(e, "vec_id").select("sample_id", "vis_idx", "embedding")


VIS = f"""
vt AS (SELECT tk.*, (token_id IN ({IMAGE_PAD_ID}, {VIDEO_PAD_ID})) AS vis FROM tk),
vk AS (SELECT *, CASE WHEN vis THEN sum(CAST(vis AS INTEGER)) OVER (PARTITION BY sample_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 END AS k FROM vt),
ve AS (SELECT vk.*, e.embedding AS tok_vec, v0.embedding AS vis_vec
       FROM (SELECT vt_k.*, nv.v FROM vk AS vt_k, nv) AS vk
       LEFT JOIN embeddings e ON e.vec_id = vk.token_id
       LEFT JOIN embeddings v0 ON vk.vis AND v0.vec_id = (vk.sample_id * 7 + vk.k) % vk.v)"""


@register("masked_replace", f"""
WITH {SEQS},
{VIS.strip()}
SELECT sample_id, pos, token_id, vis_vec IS NOT NULL AS from_vision,
       {ESUM.format('CASE WHEN vis THEN coalesce(vis_vec, tok_vec) ELSE tok_vec END')} AS emb_sum
FROM ve""")
def masked_replace(spark, sf):
    seqs, _ = _mm(spark, sf)
    r = Q.input_vectors(K.token_rows(seqs), table(spark, sf, "embeddings"), _vision_vectors(spark, sf, seqs, 0))
    return r.select("sample_id", "pos", "token_id", "from_vision", _esum(F.col("embedding")).alias("emb_sum"))


@register("masked_add", f"""
WITH {SEQS},
{VIS.strip()},
va AS (SELECT ve.*, s1.embedding AS a1, s2.embedding AS a2, s3.embedding AS a3 FROM ve
       LEFT JOIN embeddings s1 ON ve.vis AND s1.vec_id = (ve.sample_id * 7 + ve.k + 100) % ve.v
       LEFT JOIN embeddings s2 ON ve.vis AND s2.vec_id = (ve.sample_id * 7 + ve.k + 200) % ve.v
       LEFT JOIN embeddings s3 ON ve.vis AND s3.vec_id = (ve.sample_id * 7 + ve.k + 300) % ve.v),
vv AS (SELECT *, CASE WHEN vis THEN
         list_transform(list_zip(list_transform(list_zip(list_transform(list_zip(vis_vec, a1), lambda z: CAST(z[1] + z[2] AS FLOAT)), a2),
                                                lambda z: CAST(z[1] + z[2] AS FLOAT)), a3), lambda z: CAST(z[1] + z[2] AS FLOAT))
         ELSE tok_vec END AS vec FROM va)
SELECT sample_id, pos, token_id, {ESUM.format('vec')} AS emb_sum FROM vv""")
def masked_add(spark, sf):
    seqs, _ = _mm(spark, sf)
    a = Q.input_vectors(K.token_rows(seqs), table(spark, sf, "embeddings"), _vision_vectors(spark, sf, seqs, 0),
                        [_vision_vectors(spark, sf, seqs, i) for i in (1, 2, 3)])
    return a.select("sample_id", "pos", "token_id", _esum(F.col("embedding")).alias("emb_sum"))


@register("decode_join", f"""
WITH {TEXT_TOK.strip()},
tw2 AS (SELECT unnest({words('text')}) AS word, v FROM conversations, nv),
vocab AS (SELECT {hashed_id('word', V)} AS token_id, min(word) AS word FROM tw2 GROUP BY 1)
SELECT sample_id, string_agg(coalesce(vocab.word, '<unk>'), ' ' ORDER BY pos) AS text
FROM tt LEFT JOIN vocab ON vocab.token_id = tt.token_id GROUP BY sample_id""")
def decode_join(spark, sf):
    conv = table(spark, sf, "conversations")
    size = _vocab(spark, sf)
    toks = K.token_rows(K.text_sequences(conv, size))
    from ..functions.text import whitespace_tokens
    from ..functions.hashing import hashed_id as hid
    vocab = conv.select(F.explode(whitespace_tokens("text")).alias("word")) \
        .groupBy(hid(F.col("word"), size).alias("token_id")).agg(F.min("word").alias("word"))
    return Q.decode_join(toks, vocab, skip_ids=(VISION_START_ID, VISION_END_ID, IMAGE_PAD_ID, VIDEO_PAD_ID))


@register("trim_output", f"""
WITH {NV},
tw AS (SELECT conv_id, turn, role, list_transform({words('text')}, lambda x: {hashed_id('x', V)}) AS ids
       FROM conversations, nv)
SELECT CAST(u.conv_id * {S} + u.turn AS BIGINT) AS sample_id, CAST(least(len(a.ids), 128) AS INTEGER) AS n_new,
       md5(array_to_string(a.ids[1:128], ',')) AS ids_md5
FROM tw u JOIN tw a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'""")
def trim_output(spark, sf):
    conv = table(spark, sf, "conversations")
    ids = K.word_ids("text", _vocab(spark, sf))
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", ids.alias("inp"))
    a = conv.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                        ids.alias("ans"))
    j = u.join(a, ["conv_id", "turn"])
    out = F.concat("inp", "ans", F.array(F.lit(END)), "inp")
    gen = Q.trim_output(F.col("inp"), out, END, 128, skip_ids=(VISION_START_ID, VISION_END_ID))
    return j.select(K.sample_id().alias("sample_id"), gen.alias("gen")).select(
        "sample_id", F.size("gen").alias("n_new"), ids_md5("gen"))
