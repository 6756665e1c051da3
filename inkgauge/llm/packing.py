"""Best-fit packing planned on the histogram of lengths.

Best-fit decreasing is run over counts: pieces of one length fill the open
sequences with the least sufficient room, group by group, so the plan has a size
that depends on the capacity and not on the number of documents. Documents then
take the planned slots by a join on length and rank within the length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge.llm.frames import map_batches, ranked, written
from inkgauge.llm.tokens import tokens_of

SLOTS = "slot_length int, first long, last long, sequence long, per long, used int"


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than the capacity."""
    head = n % capacity or min(n, capacity)
    return [(0, head), *[(at, capacity) for at in range(head, n, capacity)]]


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots as (length, first rank, last rank + 1, first sequence, pieces per sequence, offset).

    Rank r of a length goes to sequence + (r - first) // per at offset
    used + (r - first) % per x length. The result is that of best-fit decreasing
    over the single pieces. Every length adds at most three groups of sequences,
    which bounds the plan by the capacity.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first sequence, count)
    slots, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            free = next((c for c in range(length, capacity + 1) if room[c]), None)
            if free is None:
                free, start, count = capacity, sequences, -(-left // (capacity // length))
                sequences += count
            else:
                start, count = room[free].pop()
            per = free // length
            whole = min(count, left // per)
            if whole:
                slots.append((length, rank, rank + whole * per, start, per, capacity - free))
                room[free - per * length].append((start, whole))
                rank, left, start, count = rank + whole * per, left - whole * per, start + whole, count - whole
            if count and left:  # fewer pieces than one more sequence could take
                slots.append((length, rank, rank + left, start, left, capacity - free))
                room[free - left * length].append((start, 1))
                rank, left, start, count = rank + left, 0, start + 1, count - 1
            if count:
                room[free].append((start, count))
    return slots


def _pieces(path: str, capacity: int, end_id: int, keep_words: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, end = tokens_of(path, keep_words), np.array([end_id], np.uint32)
        for pdf in batches:
            rows = []
            for key, text in zip(pdf["id"].astype(object), pdf["text"], strict=True):
                ids = np.concatenate([tokens.ids(text), end])
                for piece, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((None if pd.isna(key) else int(key), piece, start, length, crc))
            yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"]).astype({"id": "Int64"})

    return run


def pack_best_fit(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    keep_words: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    A document is its ids and ``end_id``; only documents longer than the capacity
    are cut, losslessly. Null and empty texts are the end id alone. Repeated rows
    and null ids are packed like others; pieces of equal length are interchangeable,
    and their ranks follow a hash of id and piece. ``keep_words`` lets Python workers keep
    their word memory from task to task: less work, more memory. One length may hold most pieces,
    since ranks are salted. What the driver sees is one count per length. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    schema = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    cut = map_batches(rows, _pieces(tokenizer_path, capacity, end_id, keep_words), schema)
    cut = written(cut.withColumn("draw", F.xxhash64("id", "piece")), "pieces")
    histogram = {r.length: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # bounded by the capacity: safe to broadcast
    slots = docs.sparkSession.createDataFrame(plan_slots(histogram, capacity), SLOTS)
    nth = F.col("rank") - F.col("first")
    return (
        ranked(cut, ["length"], ["draw", "id", "piece"], "rank", salts=1024)
        .join(
            F.broadcast(slots),
            (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")),
        )
        .select(
            F.col("id").alias(id_col),
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("sequence") + F.floor(nth / F.col("per"))).cast("bigint").alias("sequence_id"),
            (F.col("used") + nth % F.col("per") * F.col("length")).cast("bigint").alias("offset"),
        )
    )
