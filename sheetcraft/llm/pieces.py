"""Characters by class, and ids of many text pieces at once: each distinct
piece is looked up once and the ids are spread over its places with numpy."""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

GROUP_CHARS = 1 << 20  # characters whose pieces are told apart at once
RUN_CHARS = 1 << 22  # the same, for pieces that a library encodes
REMEMBERED = 250_000  # pieces in each of two generations that a worker remembers
SHORT = 48  # bytes up to which a piece is remembered
PIECE_BATCH = 1 << 14  # pieces that a library gets at once


SPACE, LETTER, NUMBER, OTHER = range(4)
_CLASSES: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """White space, letter, number or other, for every code point."""
    if not _CLASSES:
        table = np.full(0x110000, OTHER, dtype=np.uint8)
        every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        for pattern, kind in ((r"\s", SPACE), (r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
            found = "".join(regex.findall(pattern, every))
            table[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def text_runs(texts: list[str | None], limit: int | None = None) -> Iterator[tuple[list[int], list[str]]]:
    """Positions and texts (null: empty) in groups of at most ``limit`` characters."""
    positions, group, size = [], [], 0
    for i, text in enumerate(texts):
        if group and size + len(text or "") > (limit or GROUP_CHARS):
            yield positions, group
            positions, group, size = [], [], 0
        positions.append(i)
        group.append(text or "")
        size += len(group[-1])
    if group:
        yield positions, group


def packed(ids: Sequence[int]) -> bytes:
    """Ids as unsigned 32-bit integers, a compact form to remember."""
    return array("I", ids).tobytes()


def spread_ids(
    pieces: pa.Array, per_text: np.ndarray, lookup: Callable[[list[str]], list[bytes]]
) -> list[np.ndarray]:
    """Ids (uint32) of each text from its pieces; ``lookup`` gives the packed
    ids of distinct pieces."""
    if not len(pieces):
        return [np.empty(0, dtype=np.uint32)] * len(per_text)
    coded = pieces.dictionary_encode()
    known = lookup(coded.dictionary.to_pylist())
    sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) >> 2
    flat = np.frombuffer(b"".join(known), dtype=np.uint32)
    first = np.cumsum(sizes) - sizes
    index = coded.indices.to_numpy()
    counts = sizes.take(index)
    ends = np.cumsum(counts)
    ids = flat.take(np.repeat(first.take(index) - (ends - counts), counts) + np.arange(int(ends[-1])))
    cuts = np.concatenate(([0], ends))[np.cumsum(per_text)]
    return np.split(ids, cuts[:-1])


class Known:
    """Pieces and their ids, one after another in ``flat``."""

    def __init__(self, texts: pa.Array, sizes: np.ndarray, flat: np.ndarray):
        self.texts, self.sizes, self.flat = texts, sizes, flat
        self.first = np.cumsum(sizes) - sizes

    def __len__(self) -> int:
        return len(self.texts)

    def take(self, at: np.ndarray) -> Known:
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        spread = np.repeat(self.first[at] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        return Known(self.texts.take(pa.array(at)), sizes, self.flat[spread])

    def find(self, texts: pa.Array) -> np.ndarray:
        """Where each text is among the pieces, or -1."""
        return pc.index_in(texts, value_set=self.texts).fill_null(-1).to_numpy().astype(np.int64)


def _together(parts: list[Known]) -> Known:
    texts = pa.concat_arrays([p.texts for p in parts])
    return Known(texts, np.concatenate([p.sizes for p in parts]), np.concatenate([p.flat for p in parts]))


class LibraryPieces:
    """A model of the tokenizers library, asked once for each distinct piece.
    Two generations of pieces are remembered: when the younger is full it
    becomes the older, from which pieces that return are taken over."""

    def __init__(self, model_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model_json)
        self.young = self.old = self.encode_pieces([])

    def encode_pieces(self, pieces: list[str]) -> Known:
        sizes, flat = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.uint32)]
        for at in range(0, len(pieces), PIECE_BATCH):
            some = pieces[at : at + PIECE_BATCH]
            coded = self.model.encode(some, is_pretokenized=True, add_special_tokens=False)
            flat.append(np.array(coded.ids, dtype=np.uint32))
            sizes.append(np.bincount(np.array(coded.word_ids, dtype=np.int64), minlength=len(some)))
        return Known(pa.array(pieces, pa.large_string()), np.concatenate(sizes), np.concatenate(flat))

    def lookup(self, pieces: pa.Array) -> Known:
        """The pieces, which are distinct, in some order."""
        at = self.young.find(pieces)
        rest = pieces.filter(pa.array(at < 0))
        before = self.old.find(rest)
        back = self.old.take(before[before >= 0])
        new = self.encode_pieces(rest.filter(pa.array(before < 0)).to_pylist())
        out = _together([self.young.take(at[at >= 0]), back, new])
        kept = _together([back, new])
        kept = kept.take(np.flatnonzero(pc.binary_length(kept.texts).to_numpy() <= SHORT))
        if len(self.young) + len(kept) > REMEMBERED:
            self.old, self.young = self.young, kept
        else:
            self.young = _together([self.young, kept])
        return out

    def spread(self, pieces: pa.Array, per_text: np.ndarray) -> list[np.ndarray]:
        """Ids (uint32) of each text from its pieces."""
        if not len(pieces):
            return [np.empty(0, dtype=np.uint32)] * len(per_text)
        coded = pieces.dictionary_encode()
        known = self.lookup(coded.dictionary)
        place = known.find(coded.dictionary)[coded.indices.to_numpy()]
        counts = known.sizes[place]
        ends = np.cumsum(counts)
        ids = known.flat.take(np.repeat(known.first[place] - (ends - counts), counts) + np.arange(int(ends[-1])))
        return np.split(ids, np.concatenate(([0], ends))[np.cumsum(per_text)][:-1])
