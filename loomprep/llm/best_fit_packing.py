"""Best-fit packing: best two fit over blocks of whole documents.

A document's token ids (a public tokenizer, then an end id) stay together; only
a document of more than ``length`` tokens is cut, into pieces of ``length`` and a
shorter last one.  One sequence is filled at a time: the longest piece that fits,
again and again until nothing does.  Then its shortest piece gives way to the two
unpacked pieces that fill the room it leaves more tightly, if there are such;
what still fits is added, and this is repeated while it gains.  The piece taken
out is packed later.

Pieces are dealt evenly into blocks of about ``BLOCK_PIECES``, and each block is
packed by one task from an exact histogram of its lengths, so the work is spread
however many rows share a text or a length, and a task holds lengths and row
numbers only.  A block wastes part of its last sequences, one in some ten
thousand.  Nothing but the number of pieces reaches the driver.

Defined cases: null, empty and white-space texts are one piece that holds the end id; repeated
rows are packed each; a null doc_id is carried along; other columns are ignored;
an empty table gives no sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import table
from .word_tokens import default_tokenizer, token_pieces

LENGTH, END_ID = 4096, 1
BLOCK_PIECES = 65_536


class Unpacked:
    """How many pieces of each length are left, and the longest up to a room."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.count = np.bincount(sizes, minlength=capacity + 1).tolist()
        have = np.where(np.array(self.count) > 0, np.arange(capacity + 1), 0)
        have[0] = 0
        self.longest = np.maximum.accumulate(have)      # 0: none

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            reach = self.longest[size:] == size
            stop = len(reach) if reach.all() else int(reach.argmin())
            self.longest[size:size + stop] = self.longest[size - 1]

    def put(self, size: int) -> None:
        self.count[size] += 1
        if self.count[size] == 1:
            reach = self.longest[size:] < size
            stop = len(reach) if reach.all() else int(reach.argmin())
            self.longest[size:size + stop] = size

    def best_two(self, room: int) -> tuple[int, int]:
        """The two unpacked lengths with the largest sum up to ``room`` (0, 0: none);
        of equal sums the one with the longest piece."""
        first = np.flatnonzero(self.longest[:room] == np.arange(room))[1:]
        if not len(first):
            return 0, 0
        second = self.longest[np.minimum(first, room - first)]
        alone = np.flatnonzero(second == first)
        for k in alone[[self.count[s] < 2 for s in first[alone].tolist()]].tolist():
            second[k] = self.longest[first[k] - 1]
        total = np.where(second > 0, first + second, 0)
        k = len(total) - 1 - int(total[::-1].argmax())
        return (int(first[k]), int(second[k])) if total[k] else (0, 0)


def best_two_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """The lengths in each sequence, in the order of packing."""
    full = int((sizes == capacity).sum())
    left, rest = Unpacked(sizes[sizes < capacity], capacity), len(sizes) - full
    out = [[capacity] for _ in range(full)]
    while rest:
        held: list[int] = []
        room = _fill(left, held, capacity)
        while room and len(held) > 1:
            shortest = min(held)
            a, b = left.best_two(room + shortest)
            if a + b <= shortest:
                break
            held.remove(shortest)
            left.put(shortest)
            for size in (a, b):
                left.take(size)
                held.append(size)
            room = _fill(left, held, room + shortest - a - b)
        rest -= len(held)
        out.append(held)
    return out


def _fill(left: Unpacked, held: list[int], room: int) -> int:
    while size := int(left.longest[room]):
        left.take(size)
        held.append(size)
        room -= size
    return room


def place(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the sequence, place in it) of each length; equal lengths are
    used in the order given."""
    packed = best_two_fit(sizes, capacity)
    held = np.fromiter(map(len, packed), np.int64, len(packed))
    flat = np.fromiter((s for one in packed for s in one), np.int64, len(sizes))
    upto = np.cumsum(flat) - flat
    sequence = np.repeat(np.arange(len(packed)), held)
    offset = upto - np.repeat(upto[np.cumsum(held) - held], held) if len(flat) else upto
    use, own = np.argsort(flat, kind="stable"), np.argsort(sizes, kind="stable")
    out = np.zeros((2, len(sizes)), np.int64)
    out[0, own], out[1, own] = sequence[use], offset[use]
    return out[0], out[1]


def _pack_block(length: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "part", "row")])
        sequence, offset = place(np.asarray(rows.column("length"), np.int64), length)
        return rows.drop_columns(["block"]).append_column(
            "sequence_id", pa.array((key[0].as_py() << 32) + sequence)).append_column(
            "offset", pa.array(offset))
    return run


def pack_whole(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH,
               end_id: int = END_ID, with_ids: bool = True, block: int = BLOCK_PIECES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset and,
    if asked for, ids (array) of every piece."""
    path = tokenizer or default_tokenizer()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = materialize(texts.mapInArrow(
        token_pieces(path, length, end_id, with_ids), schema + (", ids array<int>" if with_ids else "")),
        "whole-pieces")
    # a row of the written table is known by its file's number and its place there
    cut = cut.select("*", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("part"),
                     F.col("_metadata.row_index").alias("row"))
    blocks = -(-cut.count() // block) or 1
    narrow = cut.drop("ids").withColumn(
        "block", F.pmod(F.xxhash64("part", "row"), F.lit(blocks)).cast("long"))
    placed = narrow.groupBy("block").applyInArrow(
        _pack_block(length), schema + ", part int, row long, sequence_id long, offset long")
    if with_ids:
        placed = placed.join(cut.select("part", "row", "ids"), ["part", "row"])
    piece = F.expr(f"cast(start div {int(length)} as int)").alias("piece")
    return placed.select("doc_id", piece, "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         "offset", *(["ids"] if with_ids else []))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_whole(table(spark, sf_dir, "documents"), with_ids=False)
