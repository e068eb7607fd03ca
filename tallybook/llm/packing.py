"""Best-fit packing planned on the histogram of lengths.

Texts become token ids and pieces of at most one sequence. How many pieces there are of each length
is all the plan needs: best fit, longest first, runs over those counts and gives patterns of
lengths with the number of sequences that follow each. Pieces then take the planned places of their
length by rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.placing import bucket_count, running_sum
from tallybook.llm.stage import stage
from tallybook.llm.tokens import token_slices
from tallybook.llm.workers import small_batches

PLACE_COLUMNS = ("length", "first", "beyond", "sequence", "each", "offset")


def piece_rows(batches, path: str, end: int | None, capacity: int):
    """Arrow batches of (doc_id, text) to batches of pieces."""
    for batch in batches:
        doc_ids = batch.column(0)
        for first, last, ids, limits in token_slices(batch.column(1), path):
            lengths = np.diff(limits)
            if end is not None:
                ids = np.insert(ids, limits[1:], end)
                lengths = lengths + 1
            pieces = -(-lengths // capacity)
            doc = np.repeat(np.arange(last - first), pieces)
            total = int(pieces.sum())
            piece = np.arange(total) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            # The first piece has what the full ones leave over.
            head = lengths - (pieces - 1) * capacity
            length = np.where(piece == 0, head[doc], capacity)
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            edges = np.concatenate([[0], np.cumsum(length)]) * 4
            payload = pa.Array.from_buffers(
                pa.large_binary(), total,
                [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays(
                [doc_ids.slice(first, last - first).take(pa.array(doc)),
                 pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)),
                 pa.array(length.astype(np.int64)), payload.cast(pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])


def token_pieces(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text",
                 end: int | None = 2, capacity: int = 1024) -> DataFrame:
    """One row per piece of each text: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``.

    ``ids`` are unsigned 32-bit little-endian numbers. A null text is an empty one; with an ``end``
    id it still gives a piece, without one it gives none. Only texts of over ``capacity`` ids are cut.
    """
    kind = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, text).mapInArrow(
        lambda batches: piece_rows(batches, path, end, capacity),
        f"doc_id {kind}, piece int, start long, length long, ids binary")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for pieces of the given lengths: (length, first rank, rank beyond, sequence, each, offset).

    The pieces of that length with a rank in the interval go, ``each`` to a sequence, into sequences
    counted up from ``sequence``, the first of a sequence at ``offset``. The result is that of best
    fit over single pieces, longest first. Every length splits at most one kind of open sequence, so
    the plan's size follows from ``capacity``, not from the number of pieces.
    """
    room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    levels: list[int] = []

    def put(left: int, count: int, content: list[tuple[int, int]]) -> None:
        if left not in room:
            room[left] = []
            insort(levels, left)
        room[left].append((count, content))

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            at = bisect_left(levels, length)
            if at < len(levels):
                left = levels[at]
                count, content = room[left].pop()
                if not room[left]:
                    del room[left], levels[at]
            else:
                left, count, content = capacity, -(-todo // (capacity // length)), []
            each = left // length
            full = min(count, todo // each)
            if full:
                put(left - each * length, full, [*content, (length, each)])
                todo -= full * each
                count -= full
            if count and todo:
                put(left - todo * length, 1, [*content, (length, todo)])
                todo = 0
                count -= 1
            if count:
                put(left, count, content)
    places, sequence, used = [], 0, dict.fromkeys(counts, 0)
    for left in levels:
        for count, content in room[left]:
            offset = 0
            for length, each in content:
                first = used[length]
                used[length] += count * each
                places.append((length, first, used[length], sequence, each, offset))
                offset += each * length
            sequence += count
    return places


def pack(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text",
         end: int | None = 2, capacity: int = 1024) -> DataFrame:
    """Packs all texts into sequences of at most ``capacity`` ids.

    One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` and ``ids``. Null ids and repeated rows are packed like others; a null text is an empty
    one; an empty table gives an empty one. The pieces are stored once, in the session's shared folder.
    """
    spark = df.sparkSession
    pieces = token_pieces(df, path, id_column, text, end, capacity)
    with small_batches(spark):
        pieces = stage(pieces.withColumn("ids_crc32", F.crc32("ids"))
                       .withColumn("__piece", F.monotonically_increasing_id()), "pieces")
    # At most ``capacity`` rows.
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    # From Arrow columns the table is made without Python workers.
    columns = np.array(plan(counts, capacity), np.int64).reshape(-1, len(PLACE_COLUMNS)).T
    places = spark.createDataFrame(pa.table(dict(zip(PLACE_COLUMNS, map(pa.array, columns)))))
    ranked = running_sum(
        pieces.select("__piece", "length", F.lit(1).cast("long").alias("__one"),
                      F.pmod(F.xxhash64("__piece"), F.lit(bucket_count(sum(counts.values())))).alias("__bucket")),
        ["length"], "__bucket", [F.col("__piece")], "__one", "__rank")
    # The plan's size is bound by the capacity.
    placed = ranked.join(F.broadcast(places), "length").where(
        (F.col("__rank") >= F.col("first")) & (F.col("__rank") < F.col("beyond")))
    at = F.col("__rank") - F.col("first")
    placed = placed.select(
        "__piece",
        (F.col("sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("offset") + (at % F.col("each")) * F.col("length")).cast("long").alias("offset"))
    return pieces.join(placed, "__piece").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")
