"""Token rows derived from the input tables.

A sample is one conversation turn.  ``sample_id`` is the pair ``(conv_id,
turn)`` packed into one long (turn in the lower 32 bits), so no two turns share
an id; ids beyond that range raise an overflow instead of colliding.  Its
text tokens are the whitespace words of the turn, id = md5 hash mod ``vocab``
(the queries pass the number of vectors in ``embeddings``, so every id has a
vector).  User turns carry vision blocks whose grids are derived
from the row: an image before the text and, from the third turn on, a video
after it.  Everything is row-level (``posexplode``); nothing is grouped.
"""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hashed_id
from ..functions.text import whitespace_tokens

SAMPLE_STRIDE = 1 << 32
VOCAB = 500          # hash range where the caller names none
ROWS_PER_TASK = 1 << 23    # most token rows that a task is meant to get


def sample_id() -> Column:
    """Sample key of a conversation turn: ``conv_id * 2**32 + turn``."""
    return (F.col("conv_id") * F.lit(SAMPLE_STRIDE) + F.col("turn")).cast("bigint")


def vocab_size(embeddings: DataFrame) -> int:
    """Number of vectors (from the file footers), at least 1."""
    return max(1, embeddings.count())


def word_ids(text, vocab: int = VOCAB) -> Column:
    """Hashed ids of the whitespace words of a text."""
    return F.transform(whitespace_tokens(text), lambda w: hashed_id(w, vocab))


def text_sequences(conversations: DataFrame, vocab: int = VOCAB) -> DataFrame:
    """(sample_id, input_ids array<int>) -- text only."""
    return conversations.select(sample_id().alias("sample_id"), word_ids("text", vocab).alias("input_ids"))


def token_rows(sequences: DataFrame, ids: str = "input_ids", mask: str | None = None,
               carry: tuple = ()) -> DataFrame:
    """Long form ``(sample_id, [carry,] pos, token_id[, mask])`` of array sequences."""
    if mask is None:
        return sequences.select("sample_id", *carry, F.posexplode(ids).alias("pos", "token_id"))
    z = F.arrays_zip(F.col(ids).alias("t"), F.col(mask).alias("m"))
    return (sequences.select("sample_id", *carry, F.posexplode(z).alias("pos", "tm"))
            .select("sample_id", *carry, "pos", F.col("tm.t").alias("token_id"), F.col("tm.m").alias("mask")))


def row_tasks(conversations: DataFrame, copies: int = 1) -> int:
    """Tasks to deal the texts' token rows to, so that a task gets ``ROWS_PER_TASK`` of them at
    most on average, however large the table (at least the default parallelism): a text of n
    bytes has (n + 1) / 2 words at most, and padding makes at most ``copies`` rows of a word.
    One aggregate over the bytes of the texts, run when the query is built."""
    most = conversations.agg(F.sum(F.floor((F.octet_length("text") + 1) / 2))).first()[0] or 0
    try:
        least = conversations.sparkSession.sparkContext.defaultParallelism
    except (PySparkAttributeError, PySparkNotImplementedError):   # sessions without an RDD view
        least = 1
    return max(least, -(-copies * most // ROWS_PER_TASK))


def vision_grids(conversations: DataFrame) -> DataFrame:
    """Grid rows ``(sample_id, modality, ordinal, t, h, w)`` in patch units:
    user turns get an image ``(1, h, w)``; user turns from the third turn on
    also a video ``(2, h, w)``; ``h = 2*(1 + words mod 3)``, ``w = 2*(1 + turn mod 2)``."""
    u = conversations.where(F.col("role") == "user")
    n_words = F.size(whitespace_tokens("text"))
    base = u.select(sample_id().alias("sample_id"), F.col("conv_id"), F.col("turn"),
                    (2 * (1 + F.pmod(n_words, F.lit(3)))).cast("int").alias("h"),
                    (2 * (1 + F.pmod(F.col("turn"), F.lit(2)))).cast("int").alias("w"))
    img = base.select("sample_id", F.lit("image").alias("modality"), F.lit(0).alias("ordinal"),
                      F.lit(1).alias("t"), "h", "w")
    vid = base.where(F.col("turn") >= 2).select(
        "sample_id", F.lit("video").alias("modality"), F.lit(0).alias("ordinal"), F.lit(2).alias("t"), "h", "w")
    return img.unionByName(vid)


def _grid_hw(conversations_cols=None):
    n_words = F.size(whitespace_tokens("text"))
    h = (2 * (1 + F.pmod(n_words, F.lit(3)))).cast("int")
    w = (2 * (1 + F.pmod(F.col("turn"), F.lit(2)))).cast("int")
    return h, w


def mm_sequences(conversations: DataFrame, vocab: int = VOCAB, fps: float = 2.0, keep: tuple = (),
                 more: dict | None = None) -> DataFrame:
    """(sample_id, input_ids): ``[image run] + words + [video runs]`` with
    the grids of :func:`vision_grids` (row-level, no grouping); ``keep``, ``more``: columns
    kept and added."""
    from ..operators.sequence import media_tokens
    h, w = _grid_hw()
    user = F.col("role") == "user"
    video = user & (F.col("turn") >= 2)
    empty = F.array().cast("array<int>")
    ids = F.concat(F.when(user, media_tokens(F.lit("image"), F.lit(1), h, w, vocab=vocab)).otherwise(empty),
                   word_ids("text", vocab),
                   F.when(video, media_tokens(F.lit("video"), F.lit(2), h, w, F.lit(fps), vocab=vocab))
                   .otherwise(empty))
    return conversations.select(*keep, sample_id().alias("sample_id"), ids.alias("input_ids"),
                                *[c.alias(n) for n, c in (more or {}).items()])


def mm_rows(conversations: DataFrame, vocab: int = VOCAB, fps: float = 2.0) -> DataFrame:
    """(conv_id, turn, sample_id, input_ids, image_grids, video_grids): the sequences of
    :func:`mm_sequences` with each sample's grids on its own row."""
    h, w = _grid_hw()
    user = F.col("role") == "user"
    grid = lambda t: F.array(F.struct(F.lit(t).alias("t"), h.alias("h"), w.alias("w")))
    return mm_sequences(conversations, vocab, fps, keep=("conv_id", "turn"), more={
        "image_grids": F.when(user, grid(1)), "video_grids": F.when(user & (F.col("turn") >= 2), grid(2))})
