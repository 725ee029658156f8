"""Token ids of documents in ascending order of their ids, as files of packed words.

A file is one Parquet part of records; a record holds some whole documents: their ids,
token counts, and one Simple-8b image (see simple8b) of all their tokens.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtide.llm import simple8b
from subtide.llm.pieces import PieceTable, library_encoder, text_slices
from subtide.llm.scratch import partitions_for, store

RECORD_IDS = 1 << 18
END_ID = 1
#: Bytes of text that are encoded at once; words that a worker remembers.
SLICE, TABLE_ROWS = 16 << 20, 1_200_000
#: Fixed value: a pattern whose matches are runs of letters, single digits, and runs of
#: other characters; what lies between them is dropped.
WORDS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_encoders: dict[int, Callable] = {}


def _steps(step: dict | None, name: str) -> list[dict]:
    """The steps of a normaliser or pre-tokeniser, which may be a sequence."""
    if step is None:
        return []
    return [s for inner in step[name] for s in _steps(inner, name)] if step["type"] == "Sequence" else [step]


def drops_spaces(tokenizer: dict) -> bool:
    """Whether a tokenizer file says that texts can be cut at spaces and line feeds: it drops
    white space, and no normalisation, added token or match of its pattern reaches over it."""
    split, *rest = _steps(tokenizer.get("pre_tokenizer"), "pretokenizers") or [{}]
    return (
        all(
            step["type"] in ("NFC", "Lowercase") or (step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " ")
            for step in _steps(tokenizer.get("normalizer"), "normalizers")
        )
        and split.get("type") == "Split" and split["pattern"] == {"Regex": WORDS_PATTERN} and split["behavior"] == "Removed" and split["invert"]
        and all(step["type"] == "ByteLevel" and not step["use_regex"] and not step["add_prefix_space"] for step in rest)
        and tokenizer.get("post_processor") is None and tokenizer.get("truncation") is None and tokenizer.get("padding") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] for t in tokenizer.get("added_tokens", ()))
    )


def text_encoder(tokenizer_json: bytes) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """This worker's encoder by the tokenizers library: all ids of some texts, one after
    another, and how many each text has; null is empty.

    For a tokenizer that drops white space texts are cut at spaces and line feeds, and the
    library is asked once for each new word; where it lowers letters, ASCII words are looked
    up in lower case. A word that might hold an added token, which is no such token in other
    case, stays as it is. Other tokenizers get whole texts.
    """
    key = zlib.crc32(tokenizer_json)
    if key not in _encoders:
        spec = json.loads(tokenizer_json)
        if not drops_spaces(spec):
            ask = library_encoder(tokenizer_json)
            _encoders[key] = lambda texts: ask(pc.fill_null(texts, "").to_pylist())
            return _encoders[key]
        added = tuple(t["content"] for t in spec.get("added_tokens", ()))
        lowers = any(step["type"] == "Lowercase" for step in _steps(spec.get("normalizer"), "normalizers"))
        # an added token is cut out before all else and so keeps apart what is beside it
        joints = [t["content"] for t in spec.get("added_tokens", ()) if t["special"] and not t["normalized"]]
        table = PieceTable(library_encoder(tokenizer_json, joints[0] if joints else None), TABLE_ROWS)

        def lowered(words: pa.Array) -> pa.Array:
            fit = pc.string_is_ascii(words)
            for token in added:
                fit = pc.and_not(fit, pc.match_substring(words, token, ignore_case=True))
            return pc.if_else(fit, pc.ascii_lower(words), words)

        def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
            return table.ids_of_words(
                words.flatten(), pc.list_value_length(words).to_numpy().astype(np.int64), prepare=lowered if lowers else lambda distinct: distinct
            )

        _encoders[key] = encode
    return _encoders[key]


def encode_texts(texts: Sequence[str | None] | pa.Array, encode: Callable, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts by ``text_encoder``, and how many each has, with the end id."""
    ids, counts = encode(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
    if end_id is not None:
        ids = np.insert(ids, np.cumsum(counts), end_id)
        counts = counts + 1
    return ids, counts


def write_token_files(
    docs: DataFrame, tokenizer_json: bytes, key: str = "doc_id", text: str = "text",
    end_id: int | None = END_ID, record_ids: int = RECORD_IDS,
) -> DataFrame:
    """Writes the files into the shared folder and returns them as a table: part (ascending
    with the key), record (ascending in a part), first (ids of the part before the record),
    doc_ids, counts, image.

    A null text is empty; rows with equal keys follow each other by the hash of their
    texts, a null key comes first. An empty table gives no record.
    """
    spark = docs.sparkSession
    tokenizer = spark.sparkContext.broadcast(tokenizer_json)  # one vocabulary file
    kind = dict(docs.dtypes)[key]
    ordered = (
        docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        .withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(partitions_for(spark), "doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = text_encoder(tokenizer.value), TaskContext.get().partitionId()
        doc_ids: list[pa.Array] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        record = first = 0

        def flush() -> pa.RecordBatch:
            nonlocal record, first
            tokens, keys, sizes = np.concatenate(ids), pa.concat_arrays(doc_ids), np.concatenate(counts)
            whole = np.array([0, len(keys)], dtype=np.int32)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([record], pa.int32()), pa.array([first], pa.int64()),
                 pa.ListArray.from_arrays(whole, keys), pa.ListArray.from_arrays(whole, pa.array(sizes)), pa.array([simple8b.to_bytes(tokens)])],
                names=["part", "record", "first", "doc_ids", "counts", "image"],
            )
            record, first = record + 1, first + len(tokens)
            for held in (ids, doc_ids, counts):
                held.clear()
            return out

        held = 0
        for batch in text_slices(batches, "text", SLICE):
            tokens, sizes = encode_texts(batch.column("text"), encode, end_id)
            ends = np.cumsum(sizes)
            # documents are dealt to records whole; a record is full once it has its ids
            group = (held + ends - sizes) // record_ids
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
            for a, b in zip(cuts, cuts[1:]):
                first_id = int(ends[a] - sizes[a])
                ids.append(tokens[first_id: int(ends[b - 1])])
                counts.append(sizes[a:b])
                doc_ids.append(batch.column("doc_id").slice(a, b - a))
                if b < len(sizes):
                    yield flush()
            held = sum(map(len, ids))
            if held >= record_ids:
                yield flush()
                held = 0
        if ids:
            yield flush()

    return store(
        ordered.mapInArrow(pack, f"part int, record int, first long, doc_ids array<{kind}>, counts array<long>, image binary"),
        "token-files",
    )


def with_starts(files: DataFrame, rows: DataFrame) -> DataFrame:
    """rows with a start within their part, counted from the first file on instead."""
    # one row for each file; the records' counts, not their images, are read
    totals = files.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    return rows.join(starts, "part").withColumn("start", F.col("start") + F.col("part_start")).drop("part", "part_start")


def _read(files: DataFrame, column: str, kind: str, value) -> DataFrame:
    id_kind = dict(files.dtypes)["doc_ids"][len("array<"): -1]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sizes = np.asarray(batch.column("counts")[i].values, dtype=np.int64)
                ids = simple8b.from_bytes(batch.column("image")[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), batch.column("part")[i].as_py(), dtype=np.int32)), batch.column("doc_ids")[i].values,
                     pa.array(batch.column("first")[i].as_py() + np.cumsum(sizes) - sizes), pa.array(sizes), value(ids, sizes)],
                    names=["part", "doc_id", "start", "n_tokens", column],
                )

    rows = files.select("part", "first", "doc_ids", "counts", "image").mapInArrow(read, f"part int, doc_id {id_kind}, start long, n_tokens long, {column} {kind}")
    return with_starts(files, rows)


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids."""
    def lists(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(ids.astype(np.int64)))

    return _read(files, "ids", "array<long>", lists).select("doc_id", "start", "n_tokens", "ids")


def token_file_digests(files: DataFrame) -> DataFrame:
    """As read_token_files, with the crc32 of the ids as little-endian 32-bit integers."""
    def digests(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        data, ends = memoryview(ids.astype("<u4").tobytes()), (4 * np.cumsum(sizes)).tolist()
        return pa.array([zlib.crc32(data[a:b]) for a, b in zip([0, *ends], ends)], pa.int64())

    return _read(files, "ids_crc32", "long", digests).select("doc_id", "start", "n_tokens", "ids_crc32")
