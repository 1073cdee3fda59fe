"""Best-fit packing of documents by length patterns (op 6).

Texts become token ids, an end id each, and are cut into pieces of at most
``size`` tokens.  What is packed is the histogram of piece lengths, which has
at most ``size`` bins however many pieces there are:

1. pairs and triples of lengths that fill a sequence are enumerated,
2. non-negative least squares fits how often to repeat each one so that
   together they use up the histogram,
3. the repeat counts are rounded to what the histogram has left,
4. residual lengths are packed best-fit, longest first, again as patterns
   with repeat counts.

Spark then numbers the pieces within each length and looks up which repeat of
which pattern has that number.  Lengths with many pieces are numbered in
slices.

Cases: a null or empty text is its end id alone; repeated rows are packed each;
null doc_ids are kept; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensa.llm.arrow import field_type, slices, text_of
from propensa.llm.tokenizer import word_tokenizer
from propensa.session import written

#: Most patterns given to the least-squares fit, and tokens they may waste.
PATTERNS, WASTE = 6000, 2
#: Pieces of one length that are numbered together.
SLICE = 20_000


def pieces(docs: DataFrame, path: str, end_id: int, size: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    table = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for rows, texts in slices(batch):
                which, piece, length, crc = [], [], [], []
                for i, ids in enumerate(tokenizer.encode(texts)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * size)):
                        part = ids[at:at + 4 * size]
                        which.append(i)
                        piece.append(k)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array([k * size for k in piece], pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return table.mapInArrow(encode, f"doc_id {field_type(table, 'doc_id')}, piece int, start bigint, "
                                    "length bigint, ids_crc32 bigint")


def enumerate_patterns(histogram: np.ndarray, size: int) -> np.ndarray:
    """Rows of three lengths (0: none), each filling a sequence up to WASTE."""
    lengths = np.flatnonzero(histogram[:size])
    lengths = lengths[lengths > 0]
    # largest present length that is at most i
    fitting = np.maximum.accumulate(np.where(histogram[:size] > 0, np.arange(size), 0))
    first, second = np.meshgrid(lengths, np.append(0, lengths), indexing="ij")
    first, second = first.ravel(), second.ravel()
    keep = (second <= first) & (first + second <= size)
    first, second = first[keep], second[keep]
    third = np.where(second > 0, fitting[np.minimum(np.minimum(second, size - first - second), size - 1)], 0)
    rows = np.stack([first, second, third], axis=1)
    rows = rows[size - rows.sum(axis=1) <= WASTE]
    # rows of plentiful lengths first
    plenty = np.where(rows > 0, histogram[rows], histogram.max() if len(histogram) else 0).min(axis=1)
    return rows[np.argsort(-plenty, kind="stable")][:PATTERNS]


def fit(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 with least squares of (lengths used - histogram),
    by accelerated projected gradient steps."""
    if not len(patterns):
        return np.zeros(0)
    used = patterns > 0
    target = histogram.astype(float)

    def residual(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns[used], np.repeat(x, used.sum(axis=1)), len(target)) - target

    def gradient(x: np.ndarray) -> np.ndarray:
        return np.where(used, residual(x)[patterns], 0).sum(axis=1)

    # the largest eigenvalue is at most the largest row sum of A'A
    step = 1 / max(1.0, np.where(used, np.bincount(patterns[used], None, len(target))[patterns], 0).sum(axis=1).max() * 3)
    x = ahead = np.zeros(len(patterns))
    momentum = 1.0
    for _ in range(rounds):
        new = np.maximum(0, ahead - step * gradient(ahead))
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


def plan(histogram: np.ndarray, size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns, as (length, how many) lists, with repeat counts, that use up
    the histogram (counts by length, 0 to ``size``) exactly."""
    left = histogram.astype(np.int64).copy()
    made: list[tuple[list[tuple[int, int]], int]] = []

    def take(pattern: list[tuple[int, int]], times: int) -> None:
        made.append((pattern, times))
        for length, many in pattern:
            left[length] -= many * times

    if left[size]:
        take([(size, 1)], int(left[size]))
    patterns = enumerate_patterns(left, size)
    repeats = fit(patterns, left)
    for i in np.argsort(-repeats, kind="stable"):
        lengths, many = np.unique(patterns[i][patterns[i] > 0], return_counts=True)
        times = min(round(float(repeats[i])), int((left[lengths] // many).min()))
        if times > 0:
            take([(int(a), int(b)) for a, b in zip(lengths, many)], times)
    while left.any():
        present = np.flatnonzero(left)
        pattern, room = [], size
        while room:
            at = int(np.searchsorted(present, room, side="right")) - 1
            if at < 0:
                break
            length = int(present[at])
            many = min(room // length, int(left[length]))
            pattern.append((length, many))
            room -= many * length
            present = present[:at]
        take(pattern, int(min(left[a] // b for a, b in pattern)))
    return made


def slots(patterns: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Where pieces go: rows of length, first number, how many in a sequence,
    first sequence, offset; ordered by length and first number."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, many in pattern:
            rows.append((length, used.get(length, 0), many, sequence, offset))
            used[length] = used.get(length, 0) + many * times
            offset += many * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(length: np.ndarray, number: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these numbers in their length."""
    slot = np.empty(len(length), np.int64)
    for value in np.unique(length):
        mine = length == value
        low, high = np.searchsorted(table[:, 0], [value, value + 1])
        slot[mine] = low + np.searchsorted(table[low:high, 1], number[mine], side="right") - 1
    _, first, many, sequence, offset = table[slot].T
    within = number - first
    return sequence + within // many, offset + within % many * length


def pack(docs: DataFrame, path: str, end_id: int, size: int) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    spark = docs.sparkSession
    cut = written(pieces(docs, path, end_id, size).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = cut.groupBy("length").agg(F.count("*").alias("n")).collect()    # at most ``size`` rows
    histogram = np.zeros(size + 1, np.int64)
    for row in counts:
        histogram[row["length"]] = row["n"]
    table = slots(plan(histogram, size))

    order = ["length", "slice"]
    spread = spark.createDataFrame([(r["length"], -(-r["n"] // SLICE)) for r in counts], "length bigint, slices bigint")
    sliced = cut.join(F.broadcast(spread), "length").withColumn(
        "slice", F.pmod(F.xxhash64("row"), F.col("slices"))).drop("slices")
    sizes = sliced.groupBy(*order).agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy(*order).orderBy("row")) - 1
    numbered = sliced.withColumn("within", within).join(before, order).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("within")).alias("number"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = place(batch.column("length").to_numpy(), batch.column("number").to_numpy(), table)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(assign, f"doc_id {field_type(docs, 'doc_id')}, piece int, start bigint, length bigint, "
                                       "ids_crc32 bigint, sequence_id bigint, offset bigint")
