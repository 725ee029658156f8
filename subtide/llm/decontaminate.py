"""Benchmark passages in documents: each shard of documents gets an FM-index, the windows
of the benchmark's items are searched in it, and their occurrences merge into spans.

Symbols are the benchmark's words. A document's other words cannot be part of a window, so
they only end a stretch, and stretches shorter than the shortest window are left out of the
index; that changes no result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.fm_index import FMIndex
from subtide.llm.pieces import spans_of, text_slices
from subtide.llm.scratch import free_name, store

WINDOW = 10
SHARD_BYTES = 16 << 20
#: Items over so many bytes are searched in groups of about that size, one after another; a
#: group is what the driver and a worker hold.
GROUP_BYTES = 16 << 20
#: Longer items are taken in stretches, so that no group is much larger than the others.
STRETCH_BYTES = 256 << 10
SPANS = "array<struct<a:int,b:int>>"
#: A-Z in lower case; every other character up to 7F but digits and a-z parts words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class Phrases:
    """The distinct windows of some items."""

    def __init__(self, items: Sequence[tuple[str, str]], window: int = WINDOW):
        self.symbol: dict[bytes, int] = {}
        symbols = [np.array([self.symbol.setdefault(w, len(self.symbol) + 2) for w in words_of(t)], dtype=np.int64) for _, t in items]
        sizes = np.array([len(x) for x in symbols], dtype=np.int64)
        every = np.concatenate([np.zeros(window, dtype=np.int64), *symbols])
        del symbols
        ends = np.cumsum(sizes) + window
        windows = np.where(sizes > 0, np.maximum(1, sizes - window + 1), 0)
        owner = np.repeat(np.arange(len(items)), windows)
        # a window ends here; of an item shorter than a window nothing before its start counts
        last = spans_of(ends - windows, windows)
        phrases = every[last[:, None] + np.arange(1 - window, 1)]
        phrases[np.arange(window) < (window - np.minimum(sizes, window))[owner][:, None]] = 0
        self.items = sorted({items[k][0] for k in np.unique(owner).tolist()})
        number = {item: k for k, item in enumerate(self.items)}
        owner = np.array([number.get(item, -1) for item, _ in items], dtype=np.int64)[owner]
        # equal phrases stand together, and of each its items ascend
        order = np.lexsort((owner, *phrases.T))
        phrases, owner = phrases[order], owner[order]
        fresh = np.ones(len(phrases), dtype=bool)
        fresh[1:] = (phrases[1:] != phrases[:-1]).any(axis=1)
        kept = fresh.copy()
        kept[1:] |= owner[1:] != owner[:-1]
        self.phrases, self.item_of = phrases[fresh], owner[kept]
        self.item_starts = np.flatnonzero(fresh[kept])
        self.item_counts = np.diff(self.item_starts, append=len(self.item_of))
        self.lengths = (self.phrases > 0).sum(axis=1)
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0

    def search(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
        """For each text: its words, merged spans of hit words, and the items found."""
        get = self.symbol.get
        found = [[get(w, 1) for w in words_of(t)] for t in texts]
        n_words = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[list[str]] = [[] for _ in texts]
        starts = np.cumsum(n_words) - n_words
        # a 1 stands between texts and for words of no item
        symbols = np.ones(int(n_words.sum()) + len(texts) + 1, dtype=np.int64)
        place = starts + np.arange(len(texts)) + 1
        for at, x in zip(place.tolist(), found):
            symbols[at: at + len(x)] = x
        del found
        ends = np.flatnonzero(symbols == 1)
        sizes = np.diff(ends) - 1
        kept = sizes >= max(1, self.shortest)
        if not self.shortest or not kept.any():
            return n_words, spans, items
        # the stretches, each with the 1 behind it
        positions = spans_of(ends[:-1][kept] + 1, sizes[kept] + 1)
        index = FMIndex(symbols[positions])
        low, high = index.intervals(self.phrases, self.lengths)
        hits = np.flatnonzero(high > low)
        counts = (high - low)[hits]
        phrase = np.repeat(hits, counts)
        at = positions[index.locate(spans_of(low[hits], counts))]
        cover = np.zeros(len(symbols) + 1, dtype=np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + self.lengths[phrase], -1)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)])))
        begin, end = edges[::2], edges[1::2]
        text = np.searchsorted(place, begin, side="right") - 1
        for t, a, b in zip(text.tolist(), (begin - place[text]).tolist(), (end - place[text]).tolist()):
            spans[t].append((a, b))
        owner = np.searchsorted(place, at, side="right") - 1
        pairs = np.unique(owner * len(self.phrases) + phrase)
        owner, phrase = pairs // len(self.phrases), pairs % len(self.phrases)
        each = self.item_counts[phrase]
        owned = np.unique(np.repeat(owner, each) * len(self.items) + self.item_of[spans_of(self.item_starts[phrase], each)])
        for t, i in zip((owned // len(self.items)).tolist(), (owned % len(self.items)).tolist()):
            items[t].append(self.items[i])
        return n_words, spans, items


def merge_spans(*lists: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(x for spans in lists for x in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them; each gap
    becomes one line feed."""
    words = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at: words[a][0]])
        at = words[b - 1][1]
    return "\n".join([*out, text[at:]])


_known: dict[str, Phrases] = {}


def _phrases(name: str, items: list[tuple[str, str]], window: int) -> Phrases:
    if name not in _known:
        _known.clear()
        _known[name] = Phrases(items, window)
    return _known[name]


def _distinct_items(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item, text, size), repeated rows once. A long text is taken in stretches that share
    all but one word of a window, so that together they have its windows."""
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            for one, words in zip(batch.column("item").to_pylist(), map(words_of, batch.column("text").to_pylist())):
                starts, held = [0], 0
                for i, word in enumerate(words):
                    held += len(word) + 1
                    if held > STRETCH_BYTES and i - starts[-1] >= window:
                        starts.append(i)
                        held = 0
                cut = [b" ".join(words[a: b + window - 1]).decode() for a, b in zip(starts, [*starts[1:], len(words)])]
                # a last stretch shorter than a window would be a window of its own
                if len(cut) > 1 and len(words) - starts[-1] < window:
                    cut[-2:] = [b" ".join(words[starts[-2]:]).decode()]
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(cut), pa.string()), pa.array(cut, pa.string())], names=["item", "text"])

    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")).filter("text IS NOT NULL").distinct()
    long = F.octet_length("text") > STRETCH_BYTES
    pieces = items.filter(~long).unionByName(items.filter(long).mapInArrow(stretches, "item string, text string"))
    return pieces.withColumn("size", F.octet_length("text").cast("long") + 50)


class _Items:
    """The benchmark's items: at once if they are few, else stored in groups, of which the
    driver and a worker hold one at a time."""

    def __init__(self, benchmark: DataFrame, item: str, text: str, window: int):
        self.spark, self.window = benchmark.sparkSession, window
        pieces = _distinct_items(benchmark, item, text, window)
        total = pieces.agg(F.sum("size")).first()[0] or 0
        self.pieces, self.groups = pieces, max(1, -(-total // GROUP_BYTES))
        if self.groups == 1:
            return
        pieces = store(pieces, "items")

        def dealt() -> DataFrame:
            return pieces.withColumn("group", F.pmod(F.xxhash64("item", "text"), F.lit(self.groups)).cast("int"))

        largest = F.max("size")
        while self.groups < total and dealt().groupBy("group").agg(F.sum("size").alias("size")).agg(largest).first()[0] > 2 * max(GROUP_BYTES, STRETCH_BYTES):
            self.groups *= 2
        self.pieces = store(dealt().repartition("group"), "item-groups", "group")

    def shared(self, group: int = 0):
        """A broadcast of one group: a name and its items. Its size has been checked."""
        rows = self.pieces if self.groups == 1 else self.pieces.filter(F.col("group") == group)
        return self.spark.sparkContext.broadcast((uuid.uuid4().hex, [tuple(r) for r in rows.select("item", "text").collect()]))

    def search(self, numbered: DataFrame, row: str, text: str) -> DataFrame:
        """(row, spans, items) of the stored rows with hits, one for each group that has any.
        Each group is searched in a job of its own, and let go after it."""
        window, names = self.window, ["row", "spans", "items"]
        hits = []
        for group in range(self.groups):
            items = self.shared(group)

            def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
                phrases = _phrases(*items.value, window)
                for batch in text_slices(batches, "text", SHARD_BYTES):
                    _, spans, owned = phrases.search(batch.column("text").to_pylist())
                    hit = [i for i, found in enumerate(spans) if found]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("row").take(pa.array(hit, pa.int64())), _arrow_spans([spans[i] for i in hit]),
                        pa.array([owned[i] for i in hit], pa.list_(pa.string())),
                    ], names=names)

            found = numbered.select(F.col(row).alias("row"), F.col(text).alias("text")).mapInArrow(search, f"row long, spans {SPANS}, items array<string>")
            try:
                hits.append(store(found, "hits"))
            finally:
                items.destroy()
        return reduce(DataFrame.unionByName, hits)


def _arrow_spans(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"a": a, "b": b} for a, b in s] for s in spans], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))


def _merged(found: list[dict] | None) -> list[tuple[int, int]]:
    return merge_spans([(x["a"], x["b"]) for x in found or []])


def find_passages(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """doc_id, n_words, spans (of word numbers, merged), items (ids as strings, sorted) for
    each row of docs; no document is shuffled. A null or empty text has no words; an item
    without words, or a null one, has no window; texts of any length are searched whole. An
    empty table of docs gives no row, one of items no hit. Items of over ``GROUP_BYTES`` are
    searched in groups, each in a pass over the documents; their number changes no result."""
    kind = dict(docs.dtypes)[key]
    items = _Items(benchmark, item, item_text, window)
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "n_words", "spans", "items"]
    schema = f"doc_id {kind}, n_words long, spans {SPANS}, items array<string>"
    if items.groups == 1:
        shared = items.shared()

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = _phrases(*shared.value, window)
            for batch in text_slices(batches, "text", SHARD_BYTES):
                n_words, spans, owned = phrases.search(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n_words), _arrow_spans(spans), pa.array(owned, pa.list_(pa.string()))], names=names
                )

        return narrow.mapInArrow(search, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            n_words = pa.array([len(words_of(t)) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), n_words], names=["row", "doc_id", "n_words"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = _arrow_spans([_merged(s) for s in batch.column("spans").to_pylist()])
            owned = pa.array([sorted(set(i or [])) for i in batch.column("items").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), spans, owned], names=names)

    numbered = store(narrow.withColumn("row", F.monotonically_increasing_id()), "searched")
    found = items.search(numbered, "row", "text").groupBy("row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    counted = numbered.mapInArrow(count, f"row long, doc_id {kind}, n_words long")
    return counted.join(found, "row", "left").select(*names).mapInArrow(merge, schema)


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["b"] - s["a"])


def _remove_in_rounds(docs: DataFrame, items: _Items, text: str) -> DataFrame:
    """remove_passages for several groups of items: a round searches the uncut texts for every
    group and cuts the merged spans; cut texts meet all groups again."""
    row, spans_name, was_cut = (free_name(docs, name) for name in ("__row", "__spans", "__cut"))
    carried = [row, spans_name]
    schema = docs.select("*", F.lit(True).alias(was_cut)).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            texts, keep, hit = batch.column(text).to_pylist(), [], []
            for i, found in enumerate(batch.column(spans_name).to_pylist()):
                hit.append(bool(found))
                if found:
                    texts[i] = cut_spans(texts[i], _merged(found))
                keep.append(not found or WORD.search(texts[i]) is not None)
            at = batch.schema.get_field_index(text)
            batch = batch.set_column(at, text, pa.array(texts, batch.schema.field(at).type)).drop_columns(carried)
            yield batch.append_column(was_cut, pa.array(hit)).filter(pa.array(keep))

    doubtful, clean = docs, []
    while True:
        numbered = store(doubtful.withColumn(row, F.monotonically_increasing_id()), "uncut")
        found = items.search(numbered, row, text).groupBy(F.col("row").alias(row)).agg(F.flatten(F.collect_list("spans")).alias(spans_name))
        searched = store(numbered.join(found, row, "left").select(*docs.columns, *carried).mapInArrow(cut, schema), "cut")
        clean.append(searched.filter(~F.col(was_cut)).drop(was_cut))
        doubtful = searched.filter(was_cut).drop(was_cut)
        if doubtful.isEmpty():
            return reduce(DataFrame.unionByName, clean)


def remove_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with its columns, benchmark passages cut out of the texts until no window is
    left; a text that was cut and holds no word any more goes with its row. Null, empty and
    wordless texts stay as they are. The number of groups of items changes no result; an
    empty table of items cuts nothing, one of docs gives no row."""
    items = _Items(benchmark, item, item_text, window)
    if items.groups > 1:
        return _remove_in_rounds(docs, items, text)
    shared = items.shared()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _phrases(*shared.value, window)
        for batch in text_slices(batches, text, SHARD_BYTES):
            texts = batch.column(text).to_pylist()
            keep = np.ones(len(texts), dtype=bool)
            doubtful = list(range(len(texts)))
            while doubtful:
                _, spans, _ = phrases.search([texts[i] for i in doubtful])
                hit = [(i, s) for i, s in zip(doubtful, spans) if s]
                for i, s in hit:
                    texts[i] = cut_spans(texts[i], s)
                    keep[i] = WORD.search(texts[i]) is not None
                doubtful = [i for i, _ in hit]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, text, pa.array(texts, batch.schema.field(at).type)).filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
