"""Packs tokenised documents into sequences of a fixed length by the sum-of-squares rule.

Each task packs its documents as they come. A window that is partly filled stands at the
level of its tokens; an array holds how many windows stand at each level. A document goes
where the sum of the squared counts over all levels ends up least: into a new window, or
into one of those at a level that leaves room. So no level gets crowded, and some window
is likely to wait for a document of the fitting length. A document longer than a sequence
first fills whole sequences, its rest is placed like any other.

Windows still open at the end, or once ``OPEN`` of them are, are completed with pieces cut
from the emptiest ones. What a task has left at last is cut into sequences whose lengths
are powers of two, which need no padding either.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm.pieces import PieceTable, library_encoder, ragged_rows, text_slices

SEQUENCE = 2048
END_ID = 1
#: Partly filled windows a task holds at most, 8 kB of ids each.
OPEN = 4096
#: Sequences in one record batch.
BATCH = 256

#: White space other than single spaces and line feeds between other characters: texts with
#: it are not cut.
ODD_SPACE = (
    r"[\t\v\f\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|^[ \n]|[ \n]$"
)
#: Bytes of text that are encoded at once; words that a worker remembers.
SLICE, TABLE_ROWS = 8 << 20, 600_000
_encoders: dict[int, Callable] = {}


# ---- tokens -------------------------------------------------------------------------

def may_cut(tokenizer: dict) -> bool:
    """Whether a tokenizer file says that texts can be cut before white space: bytes as they
    are, parted by the byte-level pattern, and no added token that looks beyond itself."""
    pattern = tokenizer.get("pre_tokenizer") or {}
    return (
        tokenizer.get("normalizer") is None and tokenizer.get("post_processor") is None
        and tokenizer.get("truncation") is None and tokenizer.get("padding") is None
        and pattern.get("type") == "ByteLevel" and pattern.get("use_regex") is True and not pattern.get("add_prefix_space")
        and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in tokenizer.get("added_tokens", ())
        )
    )


def encoder(tokenizer_json: bytes) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """This worker's encoder: all ids of some texts, and how many each text has; null is
    empty.

    Texts are cut before single spaces and around single line feeds, which no match of the
    byte-level pattern reaches over, and the library is asked once for each new word. Texts
    with other white space, and all texts of a tokenizer that cannot be cut, go to the
    library whole.
    """
    key = zlib.crc32(tokenizer_json)
    if key not in _encoders:
        cuts, ask_whole = may_cut(json.loads(tokenizer_json)), library_encoder(tokenizer_json)
        feed = ask_whole(["\n"])[0]
        table = PieceTable(library_encoder(tokenizer_json, "\n"), TABLE_ROWS)

        def encode_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """Ids of texts whose white space is single spaces and line feeds, which are
            tokens of their own; a space belongs to the word after it."""
            lines = pc.split_pattern(texts, "\n")
            per_text = pc.list_value_length(lines).to_numpy().astype(np.int64)
            words = pc.split_pattern(lines.flatten(), " ")
            per_line = pc.list_value_length(words).to_numpy().astype(np.int64)
            n = np.arange(len(per_line))
            is_first = np.zeros(int(per_line.sum()), dtype=bool)
            is_first[np.cumsum(per_line) - per_line] = True
            feeds = np.full(len(n), len(feed))
            feeds[np.cumsum(per_text) - 1] = 0
            flat = words.flatten()
            ids, counts = ragged_rows([
                (3 * n, *table.ids_of_words(flat.filter(pa.array(is_first)), np.ones(len(n), dtype=np.int64))),
                (3 * n + 1, *table.ids_of_words(flat.filter(pa.array(~is_first)), per_line - 1, " ")),
                (3 * n + 2, np.tile(feed, int((feeds > 0).sum())), feeds),
            ])
            return ids, np.add.reduceat(counts, np.concatenate([[0], 3 * np.cumsum(per_text)[:-1]]))

        def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            texts = pc.fill_null(texts, "")
            whole = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False) | (not cuts)
            parts = []
            for rows, encode_some in ((np.flatnonzero(~whole), encode_lines), (np.flatnonzero(whole), lambda some: ask_whole(some.to_pylist()))):
                if len(rows):
                    parts.append((rows, *encode_some(texts.take(pa.array(rows)))))
            return ragged_rows(parts)

        _encoders[key] = encode
    return _encoders[key]


# ---- packing --------------------------------------------------------------------------

class Piece:
    """Ids of a document from ``start`` on; ``total`` are all it has."""

    __slots__ = ("doc_id", "start", "ids", "total")

    def __init__(self, doc_id, start: int, ids: np.ndarray, total: int):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:at], self.total),
            Piece(self.doc_id, self.start + at, self.ids[at:], self.total),
        )


Window = list[Piece]


def level_of(window: Window) -> int:
    return sum(len(p.ids) for p in window)


class SumOfSquares:
    """Open windows by level. ``add`` and ``finish`` give windows that are complete."""

    def __init__(self, length: int = SEQUENCE, most_open: int = OPEN):
        self.length, self.most_open = length, most_open
        #: how many windows stand at each level; none stand at 0 or at the full length
        self.counts = np.zeros(length + 1, dtype=np.int64)
        self.windows: dict[int, list[Window]] = defaultdict(list)
        self.open = 0

    def best_level(self, size: int) -> int:
        """The level to place ``size`` tokens at, 0 for a new window: the change of the sum
        of squares is 1 + 2 N(level + size) less 2 N(level) - 1 where a window leaves a
        level, and nothing is added where one is completed. Of equal ones the fullest."""
        gone = 1 - 2 * self.counts[: self.length - size + 1]
        gone[0] = 0
        come = 1 + 2 * self.counts[size:]
        come[-1] = 0
        change = gone + come
        change[1:][self.counts[1: len(change)] == 0] = np.iinfo(np.int64).max
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def _put(self, window: Window, level: int) -> None:
        self.windows[level].append(window)
        self.counts[level] += 1
        self.open += 1

    def _take(self, level: int) -> Window:
        self.counts[level] -= 1
        self.open -= 1
        return self.windows[level].pop()

    def add(self, document: Piece) -> Iterator[Window]:
        while len(document.ids) >= self.length:
            head, document = document.cut(self.length)
            yield [head]
        size = len(document.ids)
        if not size:
            return
        level = self.best_level(size)
        window = self._take(level) if level else []
        window.append(document)
        if level + size == self.length:
            yield window
            return
        self._put(window, level + size)
        if self.open > self.most_open:
            last, done = self._complete()
            yield from done
            if last:
                self._put(last, level_of(last))

    def _complete(self) -> tuple[Window, list[Window]]:
        """All open windows completed, the fullest by pieces cut from the emptiest; the
        window that is left, which may be empty, and those completed."""
        waiting = [self._take(level) for level in range(1, self.length) for _ in range(int(self.counts[level]))]
        done: list[Window] = []
        pieces: Window = []  # of the emptiest windows, to be cut from
        low, high = 0, len(waiting) - 1
        while low <= high:
            window = waiting[high]
            high -= 1
            room = self.length - level_of(window)
            while room and (pieces or low <= high):
                if not pieces:
                    pieces = waiting[low]
                    low += 1
                piece = pieces.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    pieces.append(rest)
                window.append(piece)
                room -= len(piece.ids)
            if room:
                return window, done
            done.append(window)
        return pieces, done

    def finish(self) -> Iterator[Window]:
        """The rest: complete windows, then such of lengths that are powers of two."""
        last, done = self._complete()
        yield from done
        left = level_of(last)
        while left:
            size = 1 << (left.bit_length() - 1)
            window: Window = []
            room = size
            while room:
                piece = last.pop(0)
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    last.insert(0, rest)
                window.append(piece)
                room -= len(piece.ids)
            left -= size
            yield window


def pack(
    docs: DataFrame, tokenizer_json: bytes, key: str = "doc_id", text: str = "text",
    length: int = SEQUENCE, end_id: int | None = END_ID, most_open: int = OPEN,
) -> DataFrame:
    """A row for each sequence: sequence_id, ids (array<int>), and its pieces, an array of
    (doc_id, start, length, doc_tokens) that follow each other in it.

    A document's ids are the tokenizer's, without its special tokens, then ``end_id`` if
    there is one. Each id is in exactly one piece; only documents longer than a sequence
    and those of a task's last open windows are cut. Sequences hold ``length`` ids, but for
    a few at the end of each task whose lengths are powers of two. Sequence ids are unique,
    not gapless.

    Null texts are empty and give the end id alone, or no piece without one; rows of equal
    or null keys are documents of their own; an empty table gives no row.
    """
    if length < 1 or length & (length - 1):
        raise ValueError(f"the length of a sequence, {length}, is no power of two")
    tokenizer = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary file
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer.value), SumOfSquares(length, most_open)
        number = TaskContext.get().partitionId() << 33
        ready: list[Window] = []
        id_type = None

        def batch_of(windows: list[Window]) -> pa.RecordBatch:
            nonlocal number
            pieces = list(chain.from_iterable(windows))
            fields = [
                pa.array([p.doc_id for p in pieces], id_type), pa.array([p.start for p in pieces], pa.int64()),
                pa.array([len(p.ids) for p in pieces], pa.int64()), pa.array([p.total for p in pieces], pa.int64()),
            ]
            sizes = np.cumsum([0, *map(level_of, windows)]).astype(np.int32)
            ends = np.cumsum([0, *map(len, windows)]).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + len(windows))),
                 pa.ListArray.from_arrays(sizes, pa.array(np.concatenate([p.ids for p in pieces]).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, names=["doc_id", "start", "length", "doc_tokens"]))],
                names=["sequence_id", "ids", "pieces"],
            )
            number += len(windows)
            return out

        for batch in text_slices(batches, "text", SLICE):
            id_type = batch.schema.field("doc_id").type
            ids, counts = encode(batch.column("text"))
            if end_id is not None:
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            ends = np.cumsum(counts).tolist()
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), [0, *ends], ends):
                # a copy of its own: an open window must not hold the whole slice
                ready += packer.add(Piece(doc_id, 0, ids[a:b].copy(), b - a))
                while len(ready) >= BATCH:
                    yield batch_of(ready[:BATCH])
                    del ready[:BATCH]
        ready += packer.finish()
        for at in range(0, len(ready), BATCH):
            yield batch_of(ready[at: at + BATCH])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"sequence_id long, ids array<int>, pieces array<struct<doc_id: {kind}, start: bigint, length: bigint, doc_tokens: bigint>>"
    )


def piece_digests(sequences: DataFrame) -> DataFrame:
    """A row for each piece of packed sequences: doc_id, start, length, ids_crc32 (of its ids
    as little-endian 32-bit integers), doc_tokens, sequence_id, offset."""
    kind = sequences.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = batch.column("pieces").flatten()
            doc_id, start, length, total = pieces.flatten()
            ids = batch.column("ids").flatten().to_numpy().astype("<u4")
            ends = np.cumsum(length.to_numpy())
            begins = ends - length.to_numpy()
            data = memoryview(ids.tobytes())
            crcs = [zlib.crc32(data[4 * a: 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            # where each piece's sequence begins among the ids of the batch
            counts = batch.column("ids").value_lengths().to_numpy().astype(np.int64)
            of = np.repeat(np.arange(batch.num_rows), batch.column("pieces").value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays(
                [doc_id, start, length, pa.array(crcs, pa.int64()), total, batch.column("sequence_id").take(pa.array(of)),
                 pa.array(begins - (np.cumsum(counts) - counts)[of])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return sequences.mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
