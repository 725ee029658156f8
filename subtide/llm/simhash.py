"""Near-duplicates by SimHash: fingerprints that differ in few bits agree in some blocks,
are joined on these, and verified by their Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.components import connected_components
from subtide.llm.pieces import text_slices
from subtide.llm.scratch import free_name, partitions_for, store
from subtide.operators.joins import hash_join

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
BLOCKS = 7
#: Fingerprints of one block key that are compared in one task; more are dealt out in
#: chunks of half as many.
KEY_ROWS = 4096
_HASHES = 1 << 16


def shingle_hashes(text: str | None, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of each run of words, A-Z in lower case; a shorter text is one run, a text
    without words has none."""
    found = text.encode().lower().split() if text else []  # ASCII letters and white space
    runs = map(b" ".join, zip(*(found[k:] for k in range(words)))) if len(found) >= words else [b" ".join(found)] * bool(found)
    digest = xxhash.xxh64_intdigest
    return [digest(run, SEED) for run in runs]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A fingerprint of each document from its share of the hashes: bits set in over half;
    zero without hashes."""
    counts = np.zeros((len(sizes), 64), dtype=np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for a in range(0, len(hashes), _HASHES):
        part, of = hashes[a: a + _HASHES], owner[a: a + _HASHES]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        counts[of[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > sizes[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (64 bits as a long) for each row of docs; nothing is shuffled."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            hashes, sizes = [], np.zeros(batch.num_rows, dtype=np.int64)
            for i, content in enumerate(batch.column("text").to_pylist()):
                found = shingle_hashes(content, words)
                sizes[i] = len(found)
                hashes.append(np.array(found, dtype=np.uint64))
            fp = majority_bits(np.concatenate(hashes), sizes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Masks as signed longs. Among ``blocks`` blocks of 64 bits, ``radius`` differing bits
    leave at least blocks - radius untouched, so close fingerprints agree under one mask."""
    if not radius < blocks <= 64:
        raise ValueError("more blocks than differing bits are needed")
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [int(np.uint64(sum(c)).astype(np.int64)) for c in combinations(parts, blocks - radius)]


def spanning_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever fingerprints within the radius connect, fewer than there
    are fingerprints: each reached one is compared with those not reached yet."""
    rest, a, b = fps, [], []
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            here = reached.pop()
            near = np.bitwise_count(rest ^ here) <= radius
            if near.any():
                found = rest[near]
                reached.extend(found)
                a.append(np.full(len(found), here))
                b.append(found)
                rest = rest[~near]
    none = np.empty(0, dtype=np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _links_in_runs(batches: Iterator[pa.RecordBatch], radius: int, most: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by block key: links (mask null), and rows of keys with more than
    ``most`` fingerprints as they are."""
    def rows(mask, value, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([mask, value, pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["mask", "value", "a", "b"])

    def links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return rows(pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int64()), a, b)

    def heavy(mask: int, value: int, fps: np.ndarray) -> pa.RecordBatch:
        return rows(pa.array(np.full(len(fps), mask, dtype=np.int32)), pa.array(np.full(len(fps), value)), fps, fps)

    held: list[np.ndarray] = []  # the run that may go on in the next batch
    held_key, held_rows, too_many = None, 0, False

    def close() -> Iterator[pa.RecordBatch]:
        if held and not too_many and held_rows > 1:
            yield links(*spanning_links(np.concatenate(held), radius))

    for batch in batches:
        if not batch.num_rows:
            continue
        mask, value, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "value", "fp"))
        fp = fp.view(np.uint64)
        first = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]))
        ends = np.append(first[1:], len(fp))
        inner = slice(1, len(first) - 1)  # runs that begin and end in this batch
        pair = first[inner][ends[inner] - first[inner] == 2]
        near = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= radius]
        if len(near):
            yield links(fp[near], fp[near + 1])
        longer = np.flatnonzero(ends - first > 2)
        for k in sorted({0, len(first) - 1, *longer.tolist()}):
            key, part = (int(mask[first[k]]), int(value[first[k]])), fp[first[k]: ends[k]]
            if key != held_key:
                yield from close()
                held, held_key, held_rows, too_many = [], key, 0, False
            held_rows += len(part)
            if too_many:
                yield heavy(*key, part)
            else:
                held.append(part)
                if held_rows > most:
                    too_many = True
                    yield heavy(*key, np.concatenate(held))
                    held = []
    yield from close()


def near_links(reps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, key_rows: int = KEY_ROWS) -> DataFrame:
    """Links (a, b) that connect what pairs of the distinct fingerprints ``fp`` within the
    radius connect."""
    masks = block_masks(blocks, radius)
    keyed = reps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("mask", "value"))
    dealt = keyed.repartition(partitions_for(reps.sparkSession), "mask", "value").sortWithinPartitions("mask", "value")
    found = store(
        dealt.select("mask", "value", "fp").mapInArrow(lambda batches: _links_in_runs(batches, radius, key_rows), "mask int, value long, a long, b long"),
        "simhash-links",
    )
    # keys with more fingerprints than one task compares: chunks of them meet pair by pair
    crowded = found.filter("mask IS NOT NULL").select("mask", "value", F.col("a").alias("fp"))
    chunks = crowded.groupBy("mask", "value").agg(F.ceil(F.count("*") / (key_rows // 2)).cast("int").alias("n"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    met = crowded.join(chunks, ["mask", "value"]).withColumn("own", chunk).select(
        "mask", "value", "fp", F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.struct(F.least(o, "own").alias("x"), F.greatest(o, "own").alias("y")))).alias("pair")
    )

    def compare(table: pa.Table) -> pa.Table:
        a, b = spanning_links(table.column("fp").to_numpy().view(np.uint64), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    rest = met.groupBy("mask", "value", "pair").applyInArrow(compare, "a long, b long")
    return found.filter("mask IS NULL").select("a", "b").unionByName(rest)


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """fp, root (the least fingerprint that links reach), component_id (the least id there)
    for each distinct fingerprint of prints (doc_id, fp)."""
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(near_links(reps, radius))
    linked = roots.join(reps, roots["node"] == reps["fp"]).select("fp", "root", "first")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    moved = linked.join(least, "root").select("fp", "root", "least")
    return reps.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "first").alias("component_id"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id: the least id that links reach, for each row of docs.

    Rows with one fingerprint stand for each other, so copies are never paired; also null,
    empty and blank texts, whose fingerprint is zero. Repeated rows are kept. Null ids are
    allowed and never the least; a component of only such ids has a null component_id.
    """
    prints = store(fingerprints(docs, key, text), "fingerprints")
    return hash_join(prints, _classes(prints, radius), ["fp"], "inner").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """docs with its columns and one row of each component: that of the least id; of its
    repeated rows one. A null id counts as the greatest. Null, empty and blank texts are one
    component; an empty table gives no row."""
    names, row = docs.columns, free_name(docs, "__row")
    numbered = store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    ids = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col(row).alias("row"))
    prints = store(fingerprints(numbered.select(ids.alias("doc_id"), F.col(text).alias("text"))), "fingerprints")
    kept = hash_join(prints, _classes(prints, radius), ["fp"], "inner").groupBy("root").agg(F.min("doc_id").alias("doc_id"))
    return numbered.join(kept.select(F.col("doc_id.row").alias(row)), row, "left_semi").select(names)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
