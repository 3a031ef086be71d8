"""Best-fit packing of token sequences by hierarchical residuals.

Each task encodes its documents, cuts those that are too long and packs the pieces best-fit (longest first). Bins
with at most SLACK free places are done. The underfull ones, each as one item as long as it is full, are dealt to fewer and fewer
tasks, packed best-fit again, and so on until one task is enough for all that are left, or a round no longer helps.
A task packs blocks of at most BLOCK items, so its memory is bounded whatever the input; only rows of a few numbers move, no texts.

Defined cases: null text counts as empty and gives one piece with the end id alone; repeated rows are packed as often as they
occur; ties in length keep the order of reading; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .shared import arrow_map, stored

WIDTH = 1024
END_ID = 2
SLACK = 8
BLOCK = 50_000
FAN_IN = 8
LEAF_BINS = 2000  # underfull bins that a node of the first merging takes, about

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, pos long, fill long"
MOVES = "bin long, parent long, shift long, parent_fill long"


def cut(n: int, width: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole if they fit, else pieces of width with the shorter one first."""
    if n <= width:
        return [(0, n)]
    first = n % width
    return ([(0, first)] if first else []) + [(s, width) for s in range(first, n, width)]


def best_fit(lengths: list[int], width: int) -> tuple[list[int], list[int], list[int]]:
    """(bin of each item, place of each item in it, fill of each bin), longest items first, each into the fullest bin that takes it."""
    order = sorted(range(len(lengths)), key=lambda k: -lengths[k])
    where, place, fill = [0] * len(lengths), [0] * len(lengths), []
    open_bins: list[list[int]] = [[] for _ in range(width + 1)]  # by free places
    free = 0  # bit r is set if a bin has r places free
    for k in order:
        n = lengths[k]
        fits = free >> n
        if n and fits:
            room = n + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                free ^= 1 << room
        else:
            room, b = width, len(fill)
            fill.append(0)
        where[k], place[k] = b, fill[b]
        fill[b] += n
        if left := room - n:
            open_bins[left].append(b)
            free |= 1 << left
    return where, place, fill


def _ids_from_partition():
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 40


def pieces(docs: DataFrame, ranks: str | None, id_col: str, text_col: str, width: int) -> DataFrame:
    def run(batches):
        encoder, next_bin, held = bpe.encoder(ranks), _ids_from_partition(), []

        def packed():
            nonlocal next_bin
            where, place, fill = best_fit([h[3] for h in held], width)
            cols = [*map(list, zip(*held, strict=True)), [next_bin + b for b in where], place, [fill[b] for b in where]]
            next_bin += len(fill)
            held.clear()
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 6]
            names = [x.split()[0] for x in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = memoryview(encoder.ids(text or "") + end)
                for k, (start, n) in enumerate(cut(len(ids) // 4, width)):
                    held.append((doc_id, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
                if len(held) >= BLOCK:
                    yield packed()
        if held:
            yield packed()

    from .shared import small_batches

    small_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, PIECES)


def merge_round(items: DataFrame, width: int, level: int) -> DataFrame:
    """items: bin, fill. Where each goes: MOVES. Ids of this level's bins are negative and differ from all others."""

    def run(batches):
        next_bin, ids, fills = _ids_from_partition() + (level << 34), [], []

        def packed():
            nonlocal next_bin
            where, place, fill = best_fit(fills, width)
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (ids, [-1 - next_bin - b for b in where], place, [fill[b] for b in where])],
                names=["bin", "parent", "shift", "parent_fill"],
            )
            next_bin += len(fill)
            ids.clear()
            fills.clear()
            return out

        for batch in batches:
            ids += batch.column(0).to_pylist()
            fills += batch.column(1).to_pylist()
            if len(ids) >= BLOCK:
                yield packed()
        if ids:
            yield packed()

    return items.select("bin", "fill").mapInArrow(run, MOVES)


def pack(docs: DataFrame, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, slack: int = SLACK) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    local = stored(pieces(docs, ranks, id_col, text_col, width), "pieces")
    under = local.filter((F.col("pos") == 0) & (F.col("fill") < width - slack)).select("bin", "fill")
    left, level, moves = under.count(), 0, None
    nodes = math.ceil(left / LEAF_BINS)
    while left > 1:
        level += 1
        nodes = max(1, min(math.ceil(nodes / FAN_IN), left), math.ceil(left / BLOCK))
        moved = stored(merge_round(under.repartition(nodes), width, level), f"moves{level}")
        if moves is None:
            moves = moved.select("bin", F.col("parent").alias("root"), "shift")
        else:
            nxt = moved.select(F.col("bin").alias("root"), "parent", F.col("shift").alias("more"))
            moves = moves.join(nxt, "root", "left").select(
                "bin", F.coalesce("parent", "root").alias("root"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
            )
        under = moved.filter((F.col("shift") == 0) & (F.col("parent_fill") < width - slack)).select(F.col("parent").alias("bin"), F.col("parent_fill").alias("fill"))
        before, left = left, under.count()
        if nodes == 1 or left > 0.98 * before:
            break
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if moves is None:
        return local.select(*keep, F.col("bin").alias("sequence_id"), F.col("pos").alias("offset"))
    done = local.filter(F.col("fill") >= width - slack).select(*keep, F.col("bin").alias("sequence_id"), F.col("pos").alias("offset"))
    rest = local.filter(F.col("fill") < width - slack).join(moves, "bin", "left").select(
        *keep, F.coalesce("root", "bin").alias("sequence_id"), (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("offset")
    )
    return done.unionByName(rest)
