"""Shared pieces of the training-data operators.

Text goes through Python in Arrow batches.  Words are maximal runs of bytes
other than space and 0x09-0x0D (so any UTF-8 character may be part of a word),
hashed to 64 bits with numpy over blocks of bounded size; shingles are hashes
over consecutive words.  Tables that several later steps read are written to
the shared folder (``spark.checkpoint.dir``), which also cuts their lineage.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetcraft.session import scratch_dir, ship_package

BLOCK = 1 << 16  # bytes hashed at a time, so that the arrays stay in cache
BATCH_TEXT = 1 << 20  # bytes of text worked on at a time

T = TypeVar("T")
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def prepare(spark: SparkSession) -> None:
    """Make the package importable on executors and bound Arrow batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


_WORKER: dict[object, object] = {}


def once_a_worker(key: object, build: Callable[[], T]) -> T:
    """What ``build`` makes, kept by the Python worker until another is asked
    for: workers outlive stages, and hold one model at a time."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = build()
    return _WORKER[key]


def forget() -> None:
    """Drop the model that this worker holds, and memory that Arrow keeps."""
    _WORKER.clear()
    pa.default_memory_pool().release_unused()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name) + "/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def erase(*tables: DataFrame) -> None:
    """Delete what ``written`` made, once all that reads it is written too."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
            spark = df.sparkSession
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps that are over: it
    follows the driver's garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *others: str) -> DataFrame:
    """Only id (long), text (string) and named others; the rest never reaches
    Python."""
    own = F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)
    return docs.select(*own, *others)


def text_key(text: Column) -> Column:
    """A hash that tells rows of one id, or of none, apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    inv = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, dtype=_U), np.full(n, inv, dtype=_U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)


_POWERS: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _POWERS:
        _POWERS.extend(powers(BLOCK + 1))
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (murmur finaliser)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space: 0x20 and 0x09-0x0D."""
    return (data == 0x20) | ((data - np.uint8(9)) < 5)


def byte_values(fold_case: bool) -> np.ndarray:
    """A random odd 64-bit value per byte; A-Z equal a-z when ``fold_case``."""
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
    if fold_case:
        values[65:91] = values[97:123]
    return values


EXACT, FOLDED = byte_values(False), byte_values(True)


def _cuts(data: np.ndarray) -> Iterator[tuple[int, int, bool]]:
    """Block bounds that fall on white space; the flag marks pieces of one
    word longer than a block (all but its last piece)."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + BLOCK)
        if end < n and not spaces(data[end : end + 1])[0]:
            cuts = np.flatnonzero(spaces(data[at:end]))
            if len(cuts):
                end = at + int(cuts[-1])
                if end == at:
                    end = at + 1
            else:
                yield at, end, True
                at = end
                continue
        yield at, end, False
        at = end


def word_hashes(data: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word of ``data`` (uint8)."""
    up, down = _power_tables()
    hashes, starts, ends = [], [], []
    carry, carry_len, carry_start = 0, 0, -1
    for a, b, partial in _cuts(data):
        block = data[a:b]
        if partial:
            if carry_len == 0:
                carry_start = a
            total = int((values.take(block) * up[: len(block)]).sum(dtype=_U))
            carry = (carry + total * pow(_BASE, carry_len, 1 << 64)) % (1 << 64)
            carry_len += len(block)
            continue
        word = np.zeros(len(block) + 2, dtype=bool)
        np.logical_not(spaces(block), out=word[1:-1])
        edge = np.flatnonzero(word[1:] != word[:-1])
        s, e = edge[0::2], edge[1::2]
        sums = np.zeros(len(block) + 1, dtype=_U)
        np.cumsum(values.take(block) * up[: len(block)], dtype=_U, out=sums[1:])
        h = (sums[e] - sums[s]) * down[s]
        s, e = s + a, e + a
        if carry_len:
            if len(s) and s[0] == a:
                total = int(h[0]) * pow(_BASE, carry_len, 1 << 64)
                h[0] = _U((carry + total) % (1 << 64))
                s[0] = carry_start
            else:
                h = np.concatenate((np.array([carry], dtype=_U), h))
                s, e = np.concatenate(([carry_start], s)), np.concatenate(([a], e))
            carry, carry_len = 0, 0
        hashes.append(h)
        starts.append(s)
        ends.append(e)
    if carry_len:
        hashes.append(np.array([carry], dtype=_U))
        starts.append(np.array([carry_start]))
        ends.append(np.array([len(data)]))
    if not hashes:
        return np.empty(0, dtype=_U), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    h, s, e = np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)
    return mix(h + (e - s).astype(_U)), s, e


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One hash per run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=_U)
    acc = words[:n].copy()
    for j in range(1, k):
        acc *= _U(0x9FB21C651E98DF25)
        acc += words[j : j + n]
    return mix(acc)


def text_groups(ids: Iterable, texts: Iterable[str | bytes | None]) -> Iterator[tuple[list, list[bytes]]]:
    """Groups of (ids, UTF-8 texts) of bounded total size; null is empty."""
    out_ids, out_texts, size = [], [], 0
    for i, t in zip(ids, texts):
        raw = t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") if t else b""
        if out_ids and size + len(raw) > BATCH_TEXT:
            yield out_ids, out_texts
            out_ids, out_texts, size = [], [], 0
        out_ids.append(i)
        out_texts.append(raw)
        size += len(raw)
    if out_ids:
        yield out_ids, out_texts


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after another, each followed by a line feed, and the
    offset of each (one more than there are texts)."""
    data = np.frombuffer(b"".join(x + b"\n" for x in texts), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)))
    return data, offsets
