"""Packed token-id matrices: best-fit decreasing with a segment tree over capacities.

Documents are encoded, cut losslessly where they are longer than a sequence, and
dealt out to shards of bounded size. Within a shard, pieces go in descending
length to the open sequence with the least sufficient room, which a segment tree
over the room left finds in a logarithmic number of steps. The task that packs a
shard writes its matrix as one Parquet file (rows of ids and positions as
little-endian bytes, with the ends of the segments) and returns the file's name, so
nothing but names leaves it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgauge.llm.frames import map_batches, written
from inkgauge.llm.tokens import tokens_of

SHARD_BYTES = 8 << 20  # of text for each shard
ID_TYPE = "<u4"


class RoomTree:
    """Counts of open sequences by room left; ``least(n)`` is the smallest room >= n in use."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.counts = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.counts[at] += by
            at >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.open[room].pop()

    def least(self, n: int) -> int | None:
        at = n + self.size
        if self.counts[at]:
            return n
        while at > 1:  # up to the first subtree on the right that is not empty
            if not at & 1 and self.counts[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.size:
            at = 2 * at if self.counts[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of the pieces of each sequence; longest first, ties as they come."""
    tree, sequences = RoomTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.least(lengths[i])
        if room is None:
            sequence, room = len(sequences), capacity
            sequences.append([])
        else:
            sequence = tree.take(room)
        sequences[sequence].append(i)
        tree.put(room - lengths[i], sequence)
    return sequences


def _encode(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, end = tokens_of(path, True), np.array([end_id], np.uint32)
        for pdf in batches:
            rows = []
            for key, text in zip(pdf["id"].astype(object), pdf["text"], strict=True):
                ids = np.concatenate([tokens.ids(text), end]).astype(ID_TYPE)
                key = None if pd.isna(key) else int(key)
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    rows.append((key, piece, ids[at : at + capacity].tobytes()))
            yield pd.DataFrame(rows, columns=["id", "piece", "ids"]).astype({"id": "Int64"})

    return run


def _pack(capacity: int, pad_id: int):
    width = np.dtype(ID_TYPE).itemsize

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "piece", "ids"], ignore_index=True)
        blobs = pdf["ids"].tolist()
        lengths = [len(b) // width for b in blobs]
        ids = [None if pd.isna(x) else int(x) for x in pdf["id"]]
        rows = []
        for sequence, members in enumerate(best_fit_decreasing(lengths, capacity)):
            used = np.array([lengths[i] for i in members])
            line = np.full(capacity, pad_id, ID_TYPE)
            line[: used.sum()] = np.frombuffer(b"".join(blobs[i] for i in members), ID_TYPE)
            cumulative = np.concatenate([[0], np.cumsum(used)])
            positions = np.arange(capacity)
            positions[: used.sum()] -= np.repeat(cumulative[:-1], used)
            positions[used.sum() :] -= used.sum()
            rows.append(
                (
                    key[0], sequence, [ids[i] for i in members], pdf["piece"].to_numpy()[members].tolist(),
                    cumulative.tolist(), line.tobytes(), positions.astype(ID_TYPE).tobytes(),
                )
            )
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return run


SCHEMA = (
    "shard int, sequence int, doc_ids array<bigint>, pieces array<int>, cu_seqlens array<int>, "
    "input_ids binary, position_ids binary"
)


def pack_token_matrix(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    pad_id: int = 0,
) -> DataFrame:
    """One row per packed sequence: (shard, sequence, doc_ids, pieces, cu_seqlens, input_ids, position_ids).

    ``input_ids`` and ``position_ids`` are rows of ``capacity`` little-endian unsigned
    32-bit numbers; ``cu_seqlens`` has the ends of the segments, after a 0; positions
    start again at 0 in each segment and in the padding. A document is its ids and
    ``end_id``; what is longer than the capacity is cut into pieces that join up
    again. Null and empty texts are the end id alone. Null ids and repeated rows are
    packed like others; in a shard, ties of length go by id, piece and content. An
    empty table gives an empty result.

    The number of shards follows the bytes of text, and a piece's shard a hash of its
    id, number, ids and place in the input, so that a shard has a bounded size whatever
    the documents' lengths, also where rows repeat or have no id.
    """
    return _dealt(docs, tokenizer_path, id_col, text_col, capacity, end_id).applyInPandas(_pack(capacity, pad_id), SCHEMA)


def _dealt(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, end_id: int):
    """Pieces grouped by shard."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-(size + 1) // SHARD_BYTES)
    cut = map_batches(rows, _encode(tokenizer_path, capacity, end_id), "id bigint, piece int, ids binary")
    spot = F.xxhash64("id", "piece", "ids", F.monotonically_increasing_id())
    return cut.withColumn("shard", F.pmod(spot, F.lit(shards)).cast("int")).groupBy("shard")


def write_matrix(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    pad_id: int = 0,
) -> DataFrame:
    """Pack as ``pack_token_matrix`` does and write the matrix: (shard, file, sequences) of each file.

    Every attempt of a task has a file of its own; the returned rows name those that
    count. ``folder`` is one that all executors reach (local, HDFS, S3, GCS).
    """
    pack = _pack(capacity, pad_id)
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip((c.split()[0] for c in SCHEMA.split(", ")), kinds, strict=True)))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        local = not ("://" in folder or folder.startswith("file:"))
        store, root = (fs.LocalFileSystem(), folder) if local else fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        table = pa.Table.from_pandas(pack(key, pdf), schema, preserve_index=False)
        name = f"{key[0]:06d}-{uuid.uuid4().hex}.parquet"
        pq.write_table(table, f"{root}/{name}", compression="zstd", use_dictionary=False, filesystem=store)
        return pd.DataFrame({"shard": [key[0]], "file": [name], "sequences": [table.num_rows]})

    dealt = _dealt(docs, tokenizer_path, id_col, text_col, capacity, end_id)
    return written(dealt.applyInPandas(run, "shard int, file string, sequences bigint"), "matrix-files")


def read_matrix(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The rows of a written matrix, of the files that count."""
    if files.isEmpty():
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(folder).withColumn("file", F.col("_metadata.file_name"))
    return rows.join(files.select("file"), "file", "left_semi").drop("file")


def matrix_digests(packed: DataFrame) -> DataFrame:
    """(shard, sequence, doc_ids, pieces, cu_seqlens, n_tokens, ids_crc32, positions_crc32)."""
    return packed.select(
        "shard",
        "sequence",
        "doc_ids",
        "pieces",
        "cu_seqlens",
        F.element_at("cu_seqlens", -1).alias("n_tokens"),
        F.crc32("input_ids").alias("ids_crc32"),
        F.crc32("position_ids").alias("positions_crc32"),
    )


def restore_documents(packed: DataFrame) -> Iterator[tuple[int | None, int, bytes]]:
    """(doc_id, piece, ids) of every segment of collected rows; for checks and small sets."""
    width = np.dtype(ID_TYPE).itemsize
    for row in packed.toLocalIterator():
        for i, (doc, piece) in enumerate(zip(row.doc_ids, row.pieces, strict=True)):
            yield doc, piece, bytes(row.input_ids[row.cu_seqlens[i] * width : row.cu_seqlens[i + 1] * width])


def crc_of(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, ID_TYPE).tobytes())
