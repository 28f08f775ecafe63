"""Operator 4: token ids in binary shards.

Texts are range-partitioned by id, encoded, and gathered into blocks of whole
documents in ascending id order.  Ids are renumbered by corpus frequency (the
most frequent id becomes rank 0) and ranks are written in a byte-aligned
variable-length code with separate control bytes: two bits a value give its
length of 1 to 4 bytes, four values a control byte; the data bytes follow.

A shard folder holds ``ranks.bin`` (the id of each rank, little-endian
unsigned 32-bit) and one file a block, ``part-SSSSSS-BBBBBB.ids``:

    magic "TID1", shard, block, documents n, ids m   (4 + 4 x 8 bytes)
    n document ids (8 bytes), n lengths (8 bytes)
    ceil(m / 4) control bytes, data bytes

Files are written under a name of the attempt and then moved, so a task that
runs twice leaves one file.  Block and shard totals give every document's
position; nothing but these totals is ever in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetcraft.llm.common import joined, keyed_text, once_a_worker, prepare, spaces, text_key, written
from sheetcraft.llm.pieces import RUN_CHARS, LibraryPieces, text_runs

MAGIC = b"TID1"
BLOCK_IDS = 1 << 20  # ids after which a block ends (documents are whole)
_BYTES = np.arange(256, dtype=np.uint8)
_LETTER = np.isin(_BYTES, np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", dtype=np.uint8))
_MARK = np.isin(_BYTES, np.frombuffer(b".,;:!?", dtype=np.uint8))
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
NULL_ID = -(1 << 63)  # stands for a null document id in the files

# Bytes of each of the four values of a control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    code = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    padded = np.zeros(-(-len(code) // 4) * 4, dtype=np.uint8)
    padded[: len(code)] = code
    return (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8), data


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of control and data bytes, by table lookup."""
    lengths = LENGTHS.take(control, axis=0).ravel()[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    values = data.take(at).astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        values[more] |= data.take(at[more] + k).astype(np.uint32) << np.uint32(8 * k)
    return values


def write_block(shard: int, block: int, doc_ids: np.ndarray, lengths: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    head = np.array([shard, block, len(doc_ids), len(ranks)], dtype="<i8")
    return b"".join(
        (MAGIC, head.tobytes(), doc_ids.astype("<i8").tobytes(), lengths.astype("<i8").tobytes(), control.tobytes(), data.tobytes())
    )


def read_block(raw: bytes) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Shard, block, document ids, lengths and ranks of a file."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token id file")
    shard, block, n, m = np.frombuffer(raw, "<i8", 4, 4).tolist()
    doc_ids = np.frombuffer(raw, "<i8", n, 36)
    lengths = np.frombuffer(raw, "<i8", n, 36 + 8 * n)
    rest = np.frombuffer(raw, np.uint8, offset=36 + 16 * n)
    controls = -(-m // 4)
    return shard, block, doc_ids, lengths, unpack(rest[:controls], rest[controls:], m)


class PieceEncoder(LibraryPieces):
    """A tokenizers model applied to pieces of texts.

    The model lower-cases, drops white space and never joins a letter with a
    punctuation mark, so the ids of a text are those of its pieces one after
    another; distinct pieces are encoded once and remembered."""

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text.  A piece is what stands between white space, cut
        before a mark after an ASCII letter; white space itself is dropped.
        ASCII letters are lower-cased first, unless there may be the text of a
        special token, which is told by its case."""
        data, offsets = joined([t.encode() for t in texts])
        if b"<|" not in data.tobytes():
            data = _LOWER.take(data)
        blank = spaces(data)
        start = ~blank
        start[1:] &= blank[:-1] | (_MARK.take(data[1:]) & _LETTER.take(data[:-1]))
        at = np.flatnonzero(start)
        gone = np.cumsum(blank, dtype=np.int32)
        dense = data[~blank]
        bounds = np.append(at - gone[at], len(dense)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(dense))
        return self.spread(pieces, np.diff(np.searchsorted(at, offsets)))


def _encoder(model_json: str) -> PieceEncoder:
    return once_a_worker(("pieces", zlib.crc32(model_json.encode())), lambda: PieceEncoder(model_json))


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _put(folder: str, name: str, attempt: str, raw: bytes) -> None:
    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/.{name}.{attempt}") as out:
        out.write(raw)
    system.move(f"{path}/.{name}.{attempt}", f"{path}/{name}")


_RANKS: dict[str, np.ndarray] = {}


def _ranks(folder: str) -> np.ndarray:
    """The id of each rank, read once a process."""
    if folder not in _RANKS:
        system, path = _file_system(folder)
        with system.open_input_stream(f"{path}/ranks.bin") as raw:
            _RANKS[folder] = np.frombuffer(raw.read(), "<u4")
    return _RANKS[folder]


def _block_row(shard: int, block: int, doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    counts = np.bincount(flat)  # ids are places in a vocabulary
    used = np.flatnonzero(counts)
    counts = counts[used]
    columns = [
        pa.array([shard], pa.int64()),
        pa.array([block], pa.int64()),
        pa.array([[NULL_ID if i is None else i for i in doc_ids]], pa.list_(pa.int64())),
        pa.array([[len(x) for x in ids]], pa.list_(pa.int64())),
        pa.array([flat.astype("<u4" if int(flat.max(initial=0)) > 0xFFFF else "<u2").tobytes()], pa.binary()),
        pa.array([used.astype(np.int64)], pa.list_(pa.int64())),
        pa.array([counts.astype(np.int64)], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["shard", "block", "doc_ids", "lengths", "ids", "used", "counts"])


def _block_ids(raw: bytes, lengths: np.ndarray) -> np.ndarray:
    n = int(lengths.sum())
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4", n)


def token_blocks(docs: DataFrame, model_path: str, end_id: int, id_col: str, text_col: str, shards: int) -> DataFrame:
    """One row a block: shard, block, doc_ids, lengths, ids (binary), and the
    distinct ids with their counts.  Shards are ranges of (id, hash of the text)
    in ascending order."""
    model_json = Path(model_path).read_text(encoding="utf-8")

    def run(batches) -> Iterator[pa.RecordBatch]:
        coder, shard, block = _encoder(model_json), TaskContext.get().partitionId(), 0
        keys, parts, size = [], [], 0
        for batch in batches:
            own = batch.column(0).to_pylist()
            for positions, group in text_runs(batch.column(1).to_pylist(), 2 * RUN_CHARS):
                for i, ids in zip(positions, coder.encode_all(group)):
                    keys.append(own[i])
                    parts.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    if size >= BLOCK_IDS:
                        yield _block_row(shard, block, keys, parts)
                        keys, parts, size, block = [], [], 0, block + 1
                pa.default_memory_pool().release_unused()
        if keys:
            yield _block_row(shard, block, keys, parts)

    rows = keyed_text(docs, id_col, text_col).toDF("id", "text")
    # Rows of one id, or of none, and copies of a row may lie in several shards.
    order = ["id", "key", "copy"]
    rows = rows.withColumns({"key": text_key(F.col("text")), "copy": F.monotonically_increasing_id()})
    ranged = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("id", "text")
    return ranged.mapInArrow(
        run,
        "shard long, block long, doc_ids array<long>, lengths array<long>, ids binary, used array<long>, counts array<long>",
    )


def write_token_shards(
    docs: DataFrame,
    folder: str,
    model_path: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
) -> int:
    """Encode all texts and write them to ``folder``; returns the number of
    files.  ``end_id`` follows each document.  A null text is empty (only the
    end id); null document ids come first; repeated ids keep all their rows."""
    spark = docs.sparkSession
    prepare(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = written(token_blocks(docs, model_path, end_id, id_col, text_col, shards), "token-blocks")
    frequency = (
        blocks.select(F.explode(F.arrays_zip("used", "counts")).alias("u"))
        .groupBy(F.col("u.used").alias("token"))
        .agg(F.sum("u.counts").alias("n"))
        .orderBy(F.desc("n"), "token")
        .collect()  # at most a row a vocabulary entry
    )
    by_rank = np.array([row["token"] for row in frequency], dtype="<u4")
    _put(folder, "ranks.bin", "driver", by_rank.tobytes())
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def run(batches):
        attempt = str(TaskContext.get().taskAttemptId())
        for batch in batches:
            names = []
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], dtype=np.int64)
                ranks = rank_of.take(_block_ids(row["ids"], lengths))
                name = f"part-{row['shard']:06d}-{row['block']:06d}.ids"
                raw = write_block(row["shard"], row["block"], np.array(row["doc_ids"], dtype=np.int64), lengths, ranks)
                _put(folder, name, attempt, raw)
                names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    rows = blocks.select("shard", "block", "doc_ids", "lengths", "ids")
    return rows.mapInArrow(run, "name string").distinct().count()


def _read(spark: SparkSession, folder: str, value: Callable[[list[np.ndarray]], pa.Array], kind: str) -> DataFrame:
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("content")

    def run(batches):
        for batch in batches:
            for raw in batch.column(0):
                shard, block, doc_ids, lengths, ranks = read_block(raw.as_py())
                ids = _ranks(folder).take(ranks).astype("<u4", copy=False)
                ends = np.cumsum(lengths)
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64(), mask=doc_ids == NULL_ID),
                        pa.array(np.full(n, shard), pa.int64()),
                        pa.array(np.full(n, block), pa.int64()),
                        pa.array(ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        value(np.split(ids, ends[:-1])),
                    ],
                    ["doc_id", "shard", "block", "place", "n_tokens", "value"],
                )

    return files.mapInArrow(run, f"doc_id long, shard long, block long, place long, n_tokens long, value {kind}")


def read_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row a document: doc_id, shard, block, place (of its first id in the
    block), n_tokens and ids (binary, little-endian unsigned 32-bit)."""
    rows = _read(spark, folder, lambda ids: pa.array([x.tobytes() for x in ids], pa.binary()), "binary")
    return rows.withColumnRenamed("value", "ids")


def shard_digest(spark: SparkSession, folder: str, files: int) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files of a folder."""
    rows = _read(spark, folder, lambda ids: pa.array([zlib.crc32(x) for x in ids], pa.int64()), "long")
    rows = written(rows.withColumnRenamed("value", "ids_crc32"), "token-digest")
    blocks = rows.groupBy("shard", "block").agg(F.sum("n_tokens").alias("ids"))
    if blocks.count() != files:
        raise RuntimeError(f"{folder} does not hold the {files} files that were written")
    shards = blocks.groupBy("shard").agg(F.sum("ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    in_shard = F.sum("ids").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    shard_start = shards.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    block_start = blocks.select("shard", "block", F.coalesce(in_shard, F.lit(0)).alias("block_start"))
    starts = block_start.join(shard_start, "shard")
    return rows.join(starts, ["shard", "block"]).select(
        "doc_id",
        (F.col("shard_start") + F.col("block_start") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
