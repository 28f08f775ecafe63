"""Operator 8: byte-level BPE as a monoid tree reduction.

The encoding of a piece is the product of the encodings of its halves.  The
product of two encodings L and R is their concatenation if the pair of tokens
at the seam is itself an encoding; else the last w tokens of L and the first w
of R are encoded again, w doubling until the first and the last token of the
window come out as they went in.  This is exact: a token sequence is the
encoding of its bytes if each pair of neighbours is, and every pair outside
the window, or across its rim, was a pair of L or R before.  Halves and seams
recur across words, so both are remembered (bounded, per worker process), and
equal pieces of a batch are encoded once.
Decoding concatenates the token bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetcraft.llm.common import keyed_text, once_a_worker, prepare
from sheetcraft.llm.pieces import LETTER, SPACE, char_classes, packed, spread_ids, text_runs

REMEMBERED = 200_000  # pieces and halves a worker remembers at most, each
SHORT = 32  # bytes up to which pieces and halves are remembered
LEAF_BYTES = 12  # bytes that are encoded without halving
NEVER = 1 << 62
LEAF = 1 << 16  # tokens that decoding concatenates at once

# Fixed value: the pattern whose matches are the pieces; split_pieces finds
# the same matches, and a test holds the two against each other.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


def merge_all(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Plain BPE of a window: the pair of lowest rank merges first, leftmost
    among equals (heap of pairs over a linked list)."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the token that starts here
    before = list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, z = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = end[i]
        if j >= n or end[j] != z or not alive[j]:
            continue
        alive[j] = False
        end[i] = z
        if z < n:
            before[z] = i
            if (r := ranks.get(piece[i : end[z]])) is not None:
                heapq.heappush(heap, (r, i, end[z]))
        h = before[i]
        if h >= 0 and (r := ranks.get(piece[h:z])) is not None:
            heapq.heappush(heap, (r, h, z))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return tuple(out)


def split_pieces(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All pieces of the texts in order, and how many each text has: the
    matches of PIECES, found from runs of one class of characters."""
    text = "".join(texts)
    chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    n = len(chars)
    if not n:
        return pa.array([], pa.large_string()), np.zeros(len(texts), dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    kind = np.concatenate((char_classes().take(chars), [SPACE, SPACE, SPACE])).astype(np.uint8)
    first = np.zeros(n + 4, dtype=bool)  # of a text
    first[begins] = True
    start = first[: n + 1].copy()
    start[1:n] |= kind[1:n] != kind[: n - 1]
    # White space before other characters: its last is a piece of its own, or
    # joins them if it is a blank.
    after = np.flatnonzero(start[:n] & (kind[:n] != SPACE) & ~first[:n])
    after = after[kind[after - 1] == SPACE]
    start[after - 1] = True
    start[after[chars[after - 1] == 0x20]] = False
    # An apostrophe that begins a piece, and the letters it takes along.
    quote = np.flatnonzero(chars == 0x27)
    quote = quote[start[quote]]
    if len(quote):
        padded = np.concatenate((chars, np.zeros(3, dtype=np.uint32)))
        one = np.where(first[quote + 1], 0, padded[quote + 1])
        two = np.where((one == 0) | first[quote + 2], 0, padded[quote + 2])
        taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        pairs = ((one << 8) | two)[..., None] == [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")]
        taken = np.where((one < 128) & (two < 128) & pairs.any(axis=1), 3, taken)
        quote, taken = quote[taken > 0], taken[taken > 0]
        start[quote + 1] = False
        rest = quote + taken
        start[rest[(kind[rest] == LETTER) & ~first[rest]]] = True
    at = np.flatnonzero(start[:n])
    raw = text.encode()
    offsets = np.append(at, n).astype(np.int64)
    if len(raw) > n:  # where more than a byte a character comes before
        wide = np.flatnonzero(chars > 0x7F).astype(np.int64)
        more = 1 + (chars[wide] > 0x7FF).astype(np.int64) + (chars[wide] > 0xFFFF)
        offsets += np.concatenate(([0], np.cumsum(more)))[np.searchsorted(wide, offsets)]
    pieces = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(raw))
    return pieces, np.diff(np.searchsorted(at, begins))


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Plain BPE of a few bytes, by scanning for the lowest rank."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    rank = ranks.get
    pairs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == NEVER:
            break
        i = pairs.index(low)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], NEVER)
    return tuple([ranks[x] for x in parts])


class TreeEncoder(dict):
    """Maps a piece of text to its packed ids; remembers what it has seen."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.token_bytes = pa.array(self.tokens, pa.large_binary())
        self.halves: dict[bytes, tuple[int, ...]] = {}
        self.windows: dict[tuple[int, ...], tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        rank = self.ranks.get(raw)
        ids = packed(self.tree(raw) if rank is None else (rank,))
        if len(raw) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids

    def tree(self, raw: bytes) -> tuple[int, ...]:
        n = len(raw)
        if n <= SHORT and (ids := self.halves.get(raw)) is not None:
            return ids
        if n <= LEAF_BYTES:
            ids = self.halves[raw] = merge_short(raw, self.ranks)
            return ids
        ids = self.joined(self.tree(raw[: n // 2]), self.tree(raw[n // 2 :]))
        if n <= SHORT:
            if len(self.halves) >= REMEMBERED:
                self.halves.clear()
            self.halves[raw] = ids
        return ids

    def joined(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        w = 1
        while True:
            inner = left[-w:] + right[:w]
            again = self.window(inner)
            firm_left = w >= len(left) or again[0] == inner[0]
            firm_right = w >= len(right) or again[-1] == inner[-1]
            if firm_left and firm_right:
                return left[:-w] + again + right[w:]
            w *= 2

    def window(self, inner: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the bytes of some tokens."""
        known = self.windows.get(inner)
        if known is None:
            raw = b"".join([self.tokens[t] for t in inner])
            known = merge_short(raw, self.ranks) if len(raw) <= 48 else merge_all(raw, self.ranks)
            if len(inner) <= 4:
                if len(self.windows) >= REMEMBERED // 4:
                    self.windows.clear()
                self.windows[inner] = known
        return known

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text, every piece encoded on its own.  The
        distinct pieces of the texts are encoded once."""
        pieces, per_text = split_pieces(texts)
        return spread_ids(pieces, per_text, lambda distinct: [self[p] for p in distinct])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) > LEAF:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        if not len(ids):
            return b""
        return bytes(self.token_bytes.take(pa.array(ids)).buffers()[2])


def encoder(raw_ranks: bytes) -> TreeEncoder:
    """The worker's encoder for a rank file."""
    return once_a_worker(("bpe", zlib.crc32(raw_ranks)), lambda: TreeEncoder(read_ranks(raw_ranks)))


def bpe_round_trip(
    docs: DataFrame,
    ranks_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_tokens, ids, decoded)``, a row a document row.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers,
    ``decoded`` the bytes decoded from them.  A null text is an empty one and
    has no ids.  Nothing is shuffled; other columns are not read; repeated
    rows keep their rows; an empty table gives an empty result."""
    prepare(docs.sparkSession)
    raw_ranks = Path(ranks_path).read_bytes()

    def run(batches):
        enc = encoder(raw_ranks)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for positions, group in text_runs(texts):
                ids = enc.encode_all(group)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(positions)),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                        pa.array([enc.decode(x) for x in ids], pa.binary()),
                    ],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    schema = f"{id_col} long, n_tokens long, ids binary, decoded binary"
    return keyed_text(docs, id_col, text_col).mapInArrow(run, schema)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.select(
        id_col,
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
