"""What the text operators share: slices of Arrow batches, and ids of text pieces that a
Python worker remembers."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Hashable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into Python objects at once.
SLICE_BYTES = 4 << 20
#: Texts that a tokenizer is asked for at once.
ASKED = 4096


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each slice holds about ``most`` bytes of the column; a
    longer value is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def spans_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every span, one span after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


class PieceIndex(dict):
    """Numbers pieces as they are first asked for; new holds those not encoded yet."""

    def __init__(self):
        super().__init__()
        self.new: list[Hashable] = []

    def __missing__(self, piece: Hashable) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class PieceTable:
    """Ids of pieces by an encoder that is asked once for each new piece. It holds at most
    about ``limit`` pieces and ``limit`` * 8 ids, and starts anew beyond that."""

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.index = PieceIndex()
        self.flat = np.empty(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)

    def positions(self, pieces: Sequence) -> np.ndarray:
        """The table's row of every piece, valid until the next call."""
        if len(self.index) > self.limit or len(self.flat) > 8 * self.limit:
            self.clear()
        at = np.fromiter(map(self.index.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        if self.index.new:
            ids, counts = self.encode(self.index.new)
            self.index.new = []
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
        return at

    def ids_of(self, pieces: Sequence, per_document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each document has, from its number of pieces."""
        return self._gather(self.positions(pieces), per_document)

    def ids_of_words(
        self, words: pa.Array, per_document: np.ndarray, before: str = "", prepare: Callable[[pa.Array], pa.Array] = lambda distinct: distinct
    ) -> tuple[np.ndarray, np.ndarray]:
        """As ``ids_of`` for an Arrow array of words, each with ``before`` put before it, for
        tokenizers that part letters and digits from a comma or full stop after them.

        Equal words are looked up once, in the form that ``prepare`` gives to distinct ones.
        A comma or full stop at the end is looked up by itself, as words mostly occur
        without one too.
        """
        encoded = words.dictionary_encode()
        distinct, at = prepare(encoded.dictionary), encoded.indices.to_numpy()
        marked = pc.match_substring_regex(distinct, "[A-Za-z0-9][,.]$")
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(distinct, 0, -1), distinct)
        stops = pc.ends_with(distinct, ".").to_numpy(zero_copy_only=False)[at]
        marked = marked.to_numpy(zero_copy_only=False)[at]
        rows = self.positions([*(before + w for w in stems.to_pylist()), ",", "."])
        parts = 1 + marked
        ends = np.cumsum(parts)
        every = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        every[ends - parts] = rows[at]
        every[ends[marked] - 1] = np.where(stops[marked], rows[-1], rows[-2])
        last = np.concatenate([[0], np.cumsum(per_document)])
        return self._gather(every, np.diff(np.concatenate([[0], ends])[last]))

    def _gather(self, at: np.ndarray, per_document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.starts[at]
        counts = self.starts[at + 1] - starts
        ends = np.concatenate([[0], np.cumsum(counts)])
        last = np.concatenate([[0], np.cumsum(per_document)])
        return self.flat[spans_of(starts, counts)], np.diff(ends[last])


def library_encoder(tokenizer_json: bytes, joint: str | None = None) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Asks the tokenizers library for the ids of many short texts, without its special
    tokens: all ids, and how many each text has.

    With a ``joint`` texts are encoded as one, joined by it, which spares the library an
    encoding for each. It must be one token wherever it stands between two of the texts and
    keep them apart. Where its token is seen more or less often than it was put in, the
    texts are encoded one by one.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(tokenizer_json)

    def each(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(counts.sum())), counts

    between_ids = each([joint])[0] if joint else []

    def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(between_ids) != 1:
            return each(texts)
        (encoding,) = tokenizer.encode_batch_fast([joint.join(texts)], add_special_tokens=False)
        ids = np.array(encoding.ids, dtype=np.uint32)
        between = np.flatnonzero(ids == between_ids[0])
        if len(between) != len(texts) - 1:
            return each(texts)
        return np.delete(ids, between), np.diff(between, prepend=-1, append=len(ids)) - 1

    def ask(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [joined(texts[at: at + ASKED]) for at in range(0, len(texts), ASKED)]
        if not parts:
            return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])

    return ask


def ragged_rows(parts: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of all rows in order, from parts (rows, ids, counts) that each hold some
    of them."""
    rows, ids, counts = (np.concatenate(held) for held in zip(*parts))
    order = np.argsort(rows, kind="stable")
    return ids[spans_of((np.cumsum(counts) - counts)[order], counts[order])], counts[order]
