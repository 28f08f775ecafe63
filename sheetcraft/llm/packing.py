"""Operator 12: documents packed into training sequences.

Each document is encoded and closed with an end id.  Its whole sequences are
cut off where it is encoded; what is left, less than one sequence, is dealt to
random groups of bounded size.  In a group the rests go, longest first, into
the first bin that has room (first-fit decreasing).  The bin is found in a
tournament tree whose inner nodes hold the larger remaining capacity of their
two children, from the root always to the left child if it has room, so a rest
costs the logarithm of the number of bins.

Bins that are not full then take ids from the emptiest ones, cutting a rest
where the gap ends, until one bin of the group at most is not full; that one
is dealt out as sequences whose lengths are powers of two, which need no
padding.  Only rests are shuffled, never whole documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetcraft.llm.byte_bpe import split_pieces
from sheetcraft.llm.common import forget, keyed_text, once_a_worker, prepare, written
from sheetcraft.llm.pieces import RUN_CHARS, LibraryPieces, text_runs

GROUP_IDS = 1 << 22  # ids of a group of rests, on average
ROW_BATCH = 4096
FAMILIAR = 0x530  # characters below are in the same class in all Unicode versions
_GROUP_SEQUENCE = 1 << 62  # sequences of groups are numbered from here on
_PIECE = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("ids", pa.binary()),
]
_PIECE_DDL = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Tournament:
    """Remaining capacities of bins; ``take`` finds the first bin with room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> int:
        room, node = self.room, 1
        if room[1] < size:
            raise ValueError("no bin has room")
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        found = node - self.leaves
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return found


def first_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in ``sizes``, which is in descending order."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[int]] = []
    for i, size in enumerate(sizes):
        at = tree.take(size)
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def close_gaps(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(position, from, to)``: every bin but one is filled from
    the emptiest bins, and that one is cut at powers of two."""
    filled = [[(i, 0, sizes[i]) for i in own] for own in bins]
    fill = [sum(sizes[i] for i in own) for own in bins]
    order = sorted(range(len(bins)), key=lambda b: (-fill[b], b))
    near, far = 0, len(order) - 1
    while near < far:
        taker, giver = order[near], order[far]
        gap = capacity - fill[taker]
        if not gap:
            near += 1
        elif not fill[giver]:
            far -= 1
        else:
            i, a, z = filled[giver].pop()
            part = min(gap, z - a)
            filled[taker].append((i, a, a + part))
            if a + part < z:
                filled[giver].append((i, a + part, z))
            fill[taker] += part
            fill[giver] -= part
    out = [filled[b] for b in order if fill[b] == capacity]
    for b in order:
        if 0 < fill[b] < capacity:
            out += power_cuts(filled[b])
    return out


def power_cuts(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces as sequences whose lengths are distinct powers of two."""
    left = sum(z - a for _, a, z in pieces)
    out, rest = [], list(reversed(pieces))
    while left:
        want = 1 << (left.bit_length() - 1)
        left -= want
        own = []
        while want:
            i, a, z = rest.pop()
            part = min(want, z - a)
            own.append((i, a, a + part))
            if a + part < z:
                rest.append((i, a + part, z))
            want -= part
        out.append(own)
    return out


class LibraryEncoder(LibraryPieces):
    """A byte-level model of the tokenizers library, asked once for each
    distinct piece; a text that holds a special token's string, or a character
    of a newer Unicode version, goes to the library whole."""

    def __init__(self, model_json: str):
        super().__init__(model_json)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.classes = np.zeros(0x110000, dtype=np.uint8)  # 0 not looked at, 1 same class, 2 another

    def strange(self, text: str) -> bool:
        """Whether a character is in another class for the library than for
        ``split_pieces``: their Unicode versions may differ."""
        if text.isascii():
            return False
        chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        new = np.unique(chars[chars >= FAMILIAR])
        new = new[self.classes.take(new) == 0]
        for at in range(0, len(new), ROW_BATCH):
            some = new[at : at + ROW_BATCH]
            probe = "".join(f"a{c}1{c} {c}\u00e9" for c in map(chr, some.tolist()))
            theirs = np.array([a for _, (a, _) in self.model.pre_tokenizer.pre_tokenize_str(probe)])
            ours = np.concatenate(([0], np.cumsum([len(p) for p in split_pieces([probe])[0].to_pylist()])))[:-1]
            self.classes[some] = 1
            self.classes[some[np.unique(np.setxor1d(theirs, ours) // 7)]] = 2
        return bool((self.classes.take(chars) == 2).any())

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        whole = {i for i, t in enumerate(texts) if any(s in t for s in self.special) or self.strange(t)}
        pieces, per_text = split_pieces(["" if i in whole else t for i, t in enumerate(texts)])
        out = self.spread(pieces, per_text)
        for i in whole:
            out[i] = np.array(self.model.encode(texts[i], add_special_tokens=False).ids, dtype=np.uint32)
        return out


def _encoder(model_json: str) -> LibraryEncoder:
    return once_a_worker(("packing", zlib.crc32(model_json.encode())), lambda: LibraryEncoder(model_json))


def _batches(rows: list[tuple], schema: list) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), ROW_BATCH):
        columns = zip(*rows[at : at + ROW_BATCH])
        arrays = [pa.array(values, kind) for values, (_, kind) in zip(columns, schema)]
        yield pa.RecordBatch.from_arrays(arrays, [name for name, _ in schema])


def cut_documents(docs: DataFrame, model_path: str, end_id: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of all documents: whole sequences with their sequence_id, ids as
    unsigned 32-bit integers, and rests (sequence_id null), which are shuffled,
    as 16-bit ones unless the model has larger ids."""
    model_json = Path(model_path).read_text(encoding="utf-8")

    def run(batches) -> Iterator[pa.RecordBatch]:
        coder, task, n = _encoder(model_json), TaskContext.get().partitionId(), 0
        kind = _kind(max(coder.model.get_vocab_size(with_added_tokens=True), end_id))
        end = np.array([end_id], dtype=kind)
        for batch in batches:
            own, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for positions, group in text_runs(texts, RUN_CHARS):
                rows = []
                for i, found in zip(positions, coder.encode_all(group)):
                    ids = np.concatenate((found.astype(kind), end))
                    for start in range(0, len(ids), size):
                        part = ids[start : start + size]
                        full = len(part) == size
                        sequence = (task << 33) + n if full else None
                        n += full
                        rows.append((own[i], start, len(part), len(ids), sequence, 0, (part.astype("<u4") if full else part).tobytes()))
                yield from _batches(rows, _PIECE)
                pa.default_memory_pool().release_unused()

    return keyed_text(docs, id_col, text_col).mapInArrow(run, _PIECE_DDL)


def _kind(largest: int) -> str:
    return "<u2" if largest <= 0xFFFF else "<u4"


def _pack_group(capacity: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        forget()  # the worker may still hold the encoder
        table = table.sort_by([("length", "descending"), ("salt", "ascending")])
        sizes = table.column("length").to_pylist()
        starts, ids = table.column("start").to_pylist(), table.column("ids").to_pylist()
        sequences = close_gaps(first_fit(sizes, capacity), sizes, capacity)
        first = _GROUP_SEQUENCE + (key[0].as_py() << 32)
        place, out = [], {"start": [], "length": [], "sequence_id": [], "offset": [], "ids": []}
        for s, pieces in enumerate(sequences):
            offset = 0
            for i, a, z in pieces:
                kind = "<u2" if len(ids[i]) == 2 * sizes[i] else "<u4"
                part = np.frombuffer(ids[i], kind)[a:z].astype("<u4").tobytes()
                place.append(i)
                for name, value in zip(out, (starts[i] + a, z - a, first + s, offset, part)):
                    out[name].append(value)
                offset += z - a
        kept = table.select(["doc_id", "doc_tokens"]).take(pa.array(place, pa.int64()))
        columns = {"doc_id": kept["doc_id"], "doc_tokens": kept["doc_tokens"]} | {k: pa.array(v, dict(_PIECE)[k]) for k, v in out.items()}
        return pa.table({name: columns[name] for name, _ in _PIECE})

    return run


def pack_documents(
    docs: DataFrame,
    model_path: str,
    end_id: int = 0,
    size: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_ids: int = GROUP_IDS,
) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``: the
    pieces of all documents, each with its place in its document and in its
    sequence; ids are little-endian unsigned 32-bit integers.  Sequences hold ``size`` ids, but for those that hold a
    smaller power of two of them (a few a group).

    A null or empty text is the end id alone; every row is packed, so repeated
    rows and rows without an id are too; texts of any length are cut, rests
    of equal length come in random order; only the two named columns are read,
    so others may have any name; an empty table has no pieces.
    """
    spark = docs.sparkSession
    prepare(spark)
    cut = written(cut_documents(docs, model_path, end_id, size, id_col, text_col), "cut-documents")
    rests = cut.where("sequence_id is null")
    total = rests.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_ids))
    # Equal rows must not meet in one group: the salt is a row's place.
    salted = rests.withColumn("salt", F.xxhash64(F.monotonically_increasing_id(), "doc_id", "start"))
    dealt = salted.withColumn("bin", F.pmod("salt", F.lit(groups))).select("bin", "salt", "doc_id", "start", "length", "doc_tokens", "ids")
    packs = dealt.groupBy("bin").applyInArrow(_pack_group(size), _PIECE_DDL)
    return cut.where("sequence_id is not null").unionByName(packs)

