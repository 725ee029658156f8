"""Word n-gram scores by deleted interpolation.

P_k(w | context) = a * c(context, w) / c(context) + (1 - a) * P_(k-1)(w | shorter context),
down to 1 / (V + 1); the weight a depends on the bucket of c(context) (its bit length).
The weights are learned by expectation-maximisation on documents whose counts are held out.

Documents are put into batches. A batch asks for each of its distinct n-grams once, with its
own count; the reducer of a range of n-gram hashes adds up the counts of all batches and
answers each. So a frequent n-gram is one entry per batch, and no occurrence is shuffled.
N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.pieces import text_slices
from subtide.llm.scratch import partitions_for, store

ORDER = 2
BATCH_TOKENS = 500_000  # a batch's arrays, some ten of 8 bytes a token, in each of an executor's Python workers at once
RANGE_ENTRIES = 2_000_000  # about so many entries of a range of hashes meet in one task
DEV_SHARE = 16  # one training document in so many is held out of the counts for the weights
BINS = 8  # of a frequency's logarithm to base 2, in the events that EM sees
BUCKETS = 64
END, START = xxhash.xxh64_intdigest(b"\n"), xxhash.xxh64_intdigest(b"\n\n")  # no words
MAIN, DEV = 0, 1


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []  # ASCII letters and white space


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngram_keys(texts: list[bytes], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The hash of the n-gram that ends at each token, for each length from 1 to order, and
    the number of tokens of each text; every text ends with END."""
    if len(_hashes) > 500_000:
        _hashes.clear()
    parts, sizes = [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.split()
        sizes[i] = len(words) + 1
        parts.append(np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words)))
        parts.append(np.array([END], dtype=np.uint64))
    tokens = np.concatenate(parts)
    first = np.cumsum(sizes) - sizes
    keys = [tokens]
    for _ in range(1, order):
        before = np.roll(keys[-1], 1)
        before[first] = START
        keys.append(_mix(before, tokens))
    return keys, sizes


def _planes(values: np.ndarray) -> bytes:
    """Bytes of the same weight together, which compresses well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _batches(docs: DataFrame, kind: str) -> DataFrame:
    """batch, part (MAIN or DEV), doc_ids, train, tokens, train_tokens, train_texts, words:
    compressed, a line for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple]] = {MAIN: [], DEV: []}
        tokens = {MAIN: 0, DEV: 0}

        def flush(part: int, id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal made
            ids, train, sizes, lines = zip(*held[part])
            taught = [n for t, n in zip(train, sizes) if t]
            values = [
                ((task << 32) + made, pa.int64()), (part, pa.int32()), (ids, pa.list_(id_type)), (train, pa.list_(pa.bool_())),
                (sum(sizes), pa.int64()), (sum(taught), pa.int64()), (len(taught), pa.int64()),
                (zstandard.ZstdCompressor(level=3).compress(b"\n".join(lines)), pa.binary()),
            ]
            made, tokens[part], held[part] = made + 1, 0, []
            names = ["batch", "part", "doc_ids", "train", "tokens", "train_tokens", "train_texts", "words"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], names=names)

        id_type = pa.null()
        for batch in text_slices(batches, "text"):
            id_type = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                part = DEV if row["train"] and row["dev"] else MAIN
                words = words_of(row["text"])
                held[part].append((row["doc_id"], row["train"], len(words) + 1, b" ".join(words)))
                tokens[part] += len(words) + 1
                if tokens[part] >= BATCH_TOKENS:
                    yield flush(part, id_type)
        for part in held:
            if held[part]:
                yield flush(part, id_type)

    return store(
        docs.mapInArrow(run, f"batch long, part int, doc_ids array<{kind}>, train array<boolean>, tokens long, train_tokens long, train_texts long, words binary"),
        "lm-batches",
    )


def _texts(words: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(words).split(b"\n")


def _requests(staged: DataFrame, order: int, ranges: int) -> DataFrame:
    """range, batch, part, level, keys (differences of the sorted hashes), counts."""
    edges = np.array([(r << 64) // ranges for r in range(1, ranges)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                row = rows.slice(i, 1).to_pylist()[0]
                keys, sizes = ngram_keys(_texts(row["words"]), order)
                train = np.repeat(np.array(row["train"]), sizes)
                out = []
                for level, key in enumerate(keys):
                    distinct, where = np.unique(key, return_inverse=True)
                    counts = np.bincount(where[train], minlength=len(distinct)).astype(np.uint32)
                    cuts = [0, *np.searchsorted(distinct, edges).tolist(), len(distinct)]
                    for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if b > a:
                            steps = np.diff(distinct[a:b], prepend=np.uint64(0))
                            out.append((r, row["batch"], row["part"], level, _planes(steps), _planes(counts[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["range", "batch", "part", "level", "keys", "counts"],
                )

    return staged.select("batch", "part", "train", "words").mapInArrow(run, "range int, batch long, part int, level int, keys binary, counts binary")


def _replies(requests: DataFrame) -> DataFrame:
    """batch, range, level, counts in all training documents, counts without the held-out
    ones (for DEV batches), in the order of the request; and for each range a row of batch
    -1 and level 0 whose distinct counts its training words."""
    def answer(table: pa.Table) -> pa.Table:
        out = []
        levels = np.asarray(table.column("level"))
        for level in np.unique(levels).tolist():
            rows = table.filter(pa.array(levels == level))
            keys = [np.cumsum(_from_planes(k, np.uint64), dtype=np.uint64) for k in rows.column("keys").to_pylist()]
            counts = [_from_planes(c, np.uint32) for c in rows.column("counts").to_pylist()]
            parts, batches, ranges = (rows.column(c).to_pylist() for c in ("part", "batch", "range"))
            distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
            dev = np.repeat(np.array(parts) == DEV, [len(k) for k in keys])
            count = np.concatenate(counts).astype(np.float64)
            everything = np.bincount(where, count, len(distinct))
            fitted = everything - np.bincount(where[dev], count[dev], len(distinct))
            ends = np.cumsum([len(k) for k in keys])
            for at, part, batch, r in zip(np.split(where, ends[:-1]), parts, batches, ranges):
                out.append((batch, r, level, _planes(everything[at].astype(np.uint64)), _planes(fitted[at].astype(np.uint64)) if part == DEV else None, 0))
            if level == 0:
                out.append((-1, ranges[0], 0, None, None, int((everything > 0).sum())))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))], names=["batch", "range", "level", "counts", "fitted", "distinct"])

    n = partitions_for(requests.sparkSession)
    return store(
        requests.repartition(n, "range").groupBy("range").applyInArrow(answer, "batch long, range int, level int, counts binary, fitted binary, distinct long"),
        "lm-replies",
    )


def _counts_at_tokens(keys: list[np.ndarray], replies: pa.Table, column: str) -> list[np.ndarray]:
    """For each level the count of the n-gram at every token."""
    rows = sorted(replies.select(["level", "range", column]).to_pylist(), key=lambda r: (r["level"], r["range"]))
    out = []
    for level, key in enumerate(keys):
        counts = np.concatenate([_from_planes(r[column], np.uint64) for r in rows if r["level"] == level]).astype(np.float64)
        out.append(counts[np.unique(key, return_inverse=True)[1]])
    return out


def _frequencies(counts: list[np.ndarray], sizes: np.ndarray, tokens: float, texts: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each level the relative frequency of the token after its context (0 after an
    unknown one), and the context's bucket."""
    first = np.cumsum(sizes) - sizes
    shares, buckets = [counts[0] / max(tokens, 1)], [np.zeros(len(counts[0]), dtype=np.int64)]
    for level in range(1, len(counts)):
        context = np.roll(counts[level - 1], 1)
        context[first] = texts
        shares.append(np.divide(counts[level], context, out=np.zeros_like(context), where=context > 0))
        buckets.append(np.frexp(context)[1].clip(0, BUCKETS - 1).astype(np.int64))  # the bit length
    return shares, buckets


def mixed(shares: list[np.ndarray], buckets: list[np.ndarray], weights: np.ndarray, uniform: float) -> np.ndarray:
    p = np.full(len(shares[0]), uniform)
    for share, bucket, weight in zip(shares, buckets, weights):
        p = weight[bucket] * share + (1 - weight[bucket]) * p
    return p


def learn_weights(shares: list[np.ndarray], buckets: list[np.ndarray], times: np.ndarray, uniform: float, rounds: int = 100) -> np.ndarray:
    """weights[level, bucket] by EM over held-out events; half an event of either kind is
    added to each. Bucket 0 of a context is unknown: there the shorter one decides. A bucket
    without an event, as the final counts may reach, has the weight of the nearest with one."""
    weights = np.full((len(shares), BUCKETS), 0.5)
    weights[1:, 0] = 0
    for _ in range(rounds):
        below = [np.full(len(times), uniform)]
        for share, bucket, weight in zip(shares, buckets, weights):
            below.append(weight[bucket] * share + (1 - weight[bucket]) * below[-1])
        mass, new = times.astype(float), weights.copy()
        for level in range(len(shares) - 1, -1, -1):
            own = mass * weights[level][buckets[level]] * shares[level] / below[level + 1]
            hits, total = np.bincount(buckets[level], own, BUCKETS), np.bincount(buckets[level], mass, BUCKETS)
            new[level] = (hits + 0.5) / (total + 1)
            mass = mass - own
        new[1:, 0] = 0
        done = np.abs(new - weights).max() < 1e-6
        weights = new
        if done:
            break
    for level, bucket in enumerate(buckets):
        learned = np.flatnonzero(np.bincount(bucket, times, BUCKETS)[level > 0:]) + (level > 0)
        if len(learned):
            away = np.abs(np.arange(level > 0, BUCKETS)[:, None] - learned)
            weights[level, level > 0:] = weights[level, learned[away.argmin(axis=1)]]
    return weights


def in_training(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 7 != 2


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of
    docs; scores are log10 probabilities. A null or empty text has one token, its end. A
    table without training documents has unknown tokens only."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)[key]
    ident = F.col(key)
    staged = _batches(
        docs.select(
            ident.alias("doc_id"), in_training(ident).alias("train"),
            (F.pmod(F.xxhash64(ident.cast("string")), F.lit(DEV_SHARE)) == 0).alias("dev"), F.col(text).alias("text"),
        ),
        kind,
    )
    entries = (staged.agg(F.sum("tokens")).first()[0] or 0) * order
    replies = _replies(_requests(staged, order, max(1, -(-entries // RANGE_ENTRIES))))
    vocabulary = replies.filter("batch = -1").agg(F.sum("distinct")).first()[0] or 0

    taught = {r.part: r for r in staged.groupBy("part").agg(F.sum("train_tokens").alias("tokens"), F.sum("train_texts").alias("texts")).collect()}
    main = (taught[MAIN].tokens, taught[MAIN].texts) if MAIN in taught else (0, 0)
    tokens, texts = sum(r.tokens for r in taught.values()), sum(r.texts for r in taught.values())
    uniform = 1 / (vocabulary + 1)
    grouped = replies.filter("batch >= 0").groupBy("batch")

    def events(batch: pa.Table, found: pa.Table) -> pa.Table:
        names = [f"{c}{k}" for k in range(order) for c in "bq"]
        if not batch.num_rows:
            return pa.table({n: pa.array([], pa.int32()) for n in names} | {"times": pa.array([], pa.int64())})
        row = batch.to_pylist()[0]
        keys, sizes = ngram_keys(_texts(row["words"]), order)
        shares, buckets = _frequencies(_counts_at_tokens(keys, found, "fitted"), sizes, *main)
        logs = [np.where(s > 0, np.round(-BINS * np.log2(np.maximum(s, 1e-300))), -1) for s in shares]
        rows, times = np.unique(np.stack([x for b, q in zip(buckets, logs) for x in (b, q)], axis=1).astype(np.int32), axis=0, return_counts=True)
        return pa.table({n: rows[:, i] for i, n in enumerate(names)} | {"times": times})

    names = [f"{c}{k}" for k in range(order) for c in "bq"]
    seen = (
        staged.filter(F.col("part") == DEV).groupBy("batch").cogroup(replies.filter(F.col("fitted").isNotNull()).groupBy("batch"))
        .applyInArrow(events, ", ".join(f"{n} int" for n in names) + ", times long")
        .groupBy(*names).agg(F.sum("times").alias("times")).toArrow()  # bounded by buckets and bins
    )
    column = {n: np.asarray(seen.column(n)).astype(np.int64) for n in seen.column_names}
    weights = learn_weights(
        [np.where(column[f"q{k}"] < 0, 0.0, 2.0 ** (-column[f"q{k}"] / BINS)) for k in range(order)],
        [column[f"b{k}"] for k in range(order)], column["times"], uniform,
    )

    if not tokens:
        weights[0] = 0  # nothing was counted: every token is unknown

    def judge(batch: pa.Table, found: pa.Table) -> pa.Table:
        row = batch.slice(0, 1)
        ids = row.column("doc_ids").combine_chunks().values
        keys, sizes = ngram_keys(_texts(row.column("words")[0].as_py()), order)
        counts = _counts_at_tokens(keys, found, "counts")
        first = np.cumsum(sizes) - sizes
        shares, buckets = _frequencies(counts, sizes, tokens, texts)
        p = np.log10(mixed(shares, buckets, weights, uniform))
        base = np.log10((counts[0] + 1) / (tokens + vocabulary + 1))
        return pa.table({
            "doc_id": ids, "held_out": pa.array(~np.array(row.column("train")[0].as_py())), "n_tokens": sizes,
            "n_known": np.add.reduceat((counts[0] > 0).astype(np.int64), first), "train_tokens": np.full(len(sizes), tokens),
            "base_score": np.add.reduceat(base, first), "score": np.add.reduceat(p, first),
        })

    return staged.groupBy("batch").cogroup(grouped).applyInArrow(
        judge, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
