"""Near-duplicate documents by consistent weighted sampling (op 10).

A text is its five-word shingles with TF-IDF weights; two texts are near
duplicates if their weighted Jaccard similarity is ``THRESHOLD`` or more, and
a class is what such links connect.

1. *Document frequencies* are counted over all documents in a table of
   ``COUNTERS`` hashed counters, whose size does not grow.  Only shares of the
   documents count, and one in ``COMMON`` or fewer is as rare as any: what a
   counter holds of other shingles is a share too, of a text's length by
   ``COUNTERS``, so weights are the same at any size of the corpus.
2. *Samples.*  Improved consistent weighted sampling (ICWS) draws ``BANDS`` x
   ``ROWS`` samples a text; two texts agree in one with the probability of their
   weighted Jaccard similarity.  A function looks at about ``SEEN`` to twice as
   many shingles: those of long texts are dealt out to the functions by hash.
   Texts near the limit of two lengths are sampled on both sides of it.
3. *Candidates.*  Texts that agree in a band are linked to the band's lowest
   text, not in pairs, and Spark finds the components.
4. *Verification.*  All texts of a component are compared exactly, by products
   of shingle matrices, and give their classes.  A component too large for one
   task is dealt into blocks, twice by different hashes; after these, only
   texts that are not yet in the component's largest class are compared with
   all blocks, so no link is lost and blocks are not all paired.

Identical texts are one text throughout.  ``IDF_SPREAD`` bounds the weight
ratio of rare and common shingles: with unbounded weights the few edited
shingles of a copy would outweigh all that its group shares, and the larger a
group, the less alike its members.  Repetitions count 1 + ln(tf).

Cases: a text of one to four words has one shingle; texts without words are
alike only if identical (null is empty); repeated rows are copies; a class is
named by its lowest doc_id (nulls last); an empty table gives none; other
columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import aside, field_type, text_of
from propensa.llm.components import components
from propensa.llm.tokenizer import release_tokenizer
from propensa.llm.words import texts_words
from propensa.session import written

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 21, 3
SEEN = 256
IDF_SPREAD = 0.2
COUNTERS, COUNTER_BITS, COMMON = 1 << 20, 20, 1024
#: Size of one verification task: shingles, and TEXT for each text; bytes of
#: text handled at once.
BLOCK, TEXT, SLICE = 600_000, 1000, 1 << 20
#: Shared shingles of one matrix product.
DIMENSIONS = 4096


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SEEDS = _mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes of each text, ascending, and how often each
    occurs."""
    document, _, _, code = texts_words(texts)
    n = np.bincount(document, minlength=len(texts))
    begin = np.cumsum(n) - n
    padded = np.concatenate([code, np.zeros(WORDS - 1, np.uint64)])
    total = np.zeros(len(code), np.uint64)
    for k in range(WORDS):
        total = total * np.uint64(0x9E3779B97F4A7C15) + padded[k:k + len(code)]
    total = _mix(total)
    found = []
    for b, m in zip(begin, n):
        if m >= WORDS:
            found.append(np.unique(total[b:b + m - WORDS + 1], return_counts=True))
        else:    # one shingle of all words
            one = np.zeros(min(m, 1), np.uint64)
            for w in code[b:b + m]:
                one = _mix(one * np.uint64(31) + w + np.uint64(m))
            found.append((one, np.ones(len(one), np.int64)))
    return found


def _sliced(batches: Iterator[pa.RecordBatch], column: str = "data") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        step = max(1, batch.num_rows * SLICE // max(SLICE, batch.nbytes))
        for begin in range(0, batch.num_rows, step):
            rows = batch.slice(begin, step)
            yield rows, rows.column(column).to_pylist()


class Weights:
    """TF-IDF weights from the hashed document frequencies."""

    def __init__(self, counters: np.ndarray, documents: int):
        share = np.log(np.maximum(1, documents) / np.maximum(1, counters)) / np.log(COMMON)
        self.idf = (1 + IDF_SPREAD * np.clip(share, 0, 1)).astype(np.float32)

    def __call__(self, shingle: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (1 + np.log(tf)).astype(np.float32) * self.of(shingle)

    def of(self, shingle: np.ndarray) -> np.ndarray:
        return self.idf[shingle >> np.uint64(64 - COUNTER_BITS)]


def document_frequencies(data: DataFrame) -> Weights:
    """Count documents by hashed shingle; ``data`` has one binary column."""
    block = 4096

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, documents = np.zeros(COUNTERS, np.int64), 0
        for rows, texts in _sliced(batches):
            found = [s >> np.uint64(64 - COUNTER_BITS) for s, _ in shingles(texts)]
            counters += np.bincount(np.concatenate(found).astype(np.int64), minlength=COUNTERS)
            documents += len(texts)
        parts = counters.astype("<u4").reshape(-1, block)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts) + 1), pa.int32()),
             pa.array([p.tobytes() for p in parts] + [np.array([documents], "<u4").tobytes()], pa.binary())],
            ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                sums[number] = sums.get(number, 0) + np.frombuffer(counts.as_py(), "<u4").astype("<u8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            ["block", "counts"])

    schema = "block int, counts binary"
    # COUNTERS numbers, whatever the corpus
    sums = data.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()
    by_block = {r["block"]: np.frombuffer(bytes(r["counts"]), "<u8").astype(np.int64) for r in sums}
    last = COUNTERS // block
    if last not in by_block:
        return Weights(np.zeros(COUNTERS, np.int64), 0)
    return Weights(np.concatenate([by_block[k] for k in range(last)]), int(by_block[last][0]))


def samples(shingle: np.ndarray, weight: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One ICWS sample (hash of shingle and step) for each seed."""
    a = _mix(shingle[:, None] ^ seeds[None, :])
    b = a * np.uint64(0xD6E8FEB86659FD93)
    b ^= b >> np.uint64(32)
    unit, half = np.float32(2.0 ** -24), np.float32(2.0 ** -25)

    def uniform(bits: np.ndarray) -> np.ndarray:
        return (bits & np.uint64(0xFFFFFF)).astype(np.float32) * unit + half

    r = -np.log(uniform(a >> np.uint64(40)) * uniform(a >> np.uint64(16)))
    log_c = np.log(-np.log(uniform(b >> np.uint64(40)) * uniform(b >> np.uint64(16))))
    beta = uniform((a << np.uint64(8)) ^ b)
    t = np.floor(np.log(weight)[:, None] / r + beta)
    best = (log_c - r * (t - beta) - r).argmin(axis=0)
    column = np.arange(len(seeds))
    return _mix(shingle[best] + t[best, column].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def band_hashes(shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Band hashes of a text, for one length class or two."""
    if not len(shingle):
        return np.zeros(0, np.uint64)
    total = float(weight.sum())
    top = (BANDS * ROWS).bit_length() - 1

    def level(w: float) -> int:
        return min(top, max(0, int(np.floor(np.log2(w / SEEN)))))

    found = []
    for k in sorted({level(total), level(total / THRESHOLD)}):
        drawn = np.zeros(BANDS * ROWS, np.uint64)
        # function j sees the shingles of class j modulo 2 ** k
        classes = 1 << k
        dealt = shingle & np.uint64(classes - 1)
        for c in range(classes):
            mine = dealt == np.uint64(c) if classes > 1 else slice(None)
            if classes == 1 or mine.any():
                drawn[c::classes] = samples(shingle[mine], weight[mine], SEEDS[c::classes])
        code = np.full(BANDS, k + 1, np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(64)
        for row in drawn.reshape(BANDS, ROWS).T:
            code = _mix(code * np.uint64(31) + row)
        found.append(code)
    return np.concatenate(found)


def links(members: list[tuple[np.ndarray, np.ndarray]], weights: Weights,
          threshold: float = THRESHOLD, queries: np.ndarray | None = None) -> np.ndarray:
    """Lowest member (index) that each member is connected to by links of
    ``threshold`` or more.  ``queries``: compare only pairs with one of these."""
    n = len(members)
    shingle = np.concatenate([s for s, _ in members])
    tf = np.concatenate([t for _, t in members])
    owner = np.repeat(np.arange(n), [len(s) for s, _ in members])
    total = np.bincount(owner, weights(shingle, tf), n)
    # min(tf) as shared levels: one feature for each of a shingle's levels
    level = np.arange(tf.sum()) - np.repeat(np.cumsum(tf) - tf, tf)
    shingle, owner = np.repeat(shingle, tf), np.repeat(owner, tf)
    gain = np.where(level > 0, np.log1p(level) - np.log(np.maximum(1, level)), 1) * weights.of(shingle)
    feature = _mix(shingle + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, number, count = np.unique(feature, return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[number]
    dimension = (np.cumsum(shared) - 1)[number[keep]]
    owner, root = owner[keep], np.sqrt(gain[keep]).astype(np.float32)
    order = np.argsort(dimension, kind="stable")
    dimension, owner, root = dimension[order], owner[order], root[order]
    label = np.arange(n)
    rows = np.arange(n) if queries is None else queries
    shared_weight = np.zeros((len(rows), n), np.float32)
    for low in range(0, int(dimension[-1]) + 1 if len(dimension) else 0, DIMENSIONS):
        a, b = np.searchsorted(dimension, [low, low + DIMENSIONS])
        matrix = np.zeros((n, min(DIMENSIONS, int(dimension[b - 1]) + 1 - low)), np.float32)
        matrix[owner[a:b], dimension[a:b] - low] = root[a:b]
        shared_weight += matrix[rows] @ matrix.T
    # the margin covers the rounding of single-precision sums
    near = shared_weight >= (threshold - 1e-5) * (total[rows][:, None] + total[None, :] - shared_weight)
    near &= shared_weight > 0
    i, j = np.nonzero(near)
    i = rows[i]
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _classes(docs: DataFrame, threshold: float, block: int) -> DataFrame:
    """``docs`` (doc_id, text and renamed others) with _class, the number of
    its class, and class_id."""
    text = text_of(docs)
    keyed = docs.withColumns({"_k": F.xxhash64(text), "_l": F.xxhash64(F.lit(1), text)})
    bare = keyed.select("doc_id", "_k", "_l", text.cast("binary").alias("data"))
    weights = document_frequencies(bare.select("data"))
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    kind = field_type(docs, "doc_id")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tokenizer()
        for rows, texts in _sliced(batches):
            found = shingles(texts)
            bands = [band_hashes(s, sent.value(s, t)).view(np.int64) for s, t in found]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:3], pa.array(bands, pa.list_(pa.int64())),
                 pa.array([int(t.sum()) + TEXT for _, t in found], pa.int64())], ["doc_id", "_k", "_l", "bands", "size"])

    signed = written(bare.mapInArrow(
        sign, f"doc_id {kind}, _k bigint, _l bigint, bands array<bigint>, size bigint"), "signed")
    first = F.min(F.col("doc_id")).alias("doc_id")      # min skips nulls
    texts = written(signed.groupBy("_k", "_l").agg(first, F.any_value("size").alias("size"),
                                                   F.any_value("bands").alias("bands")), "texts")
    spread = texts.select("_k", F.explode("bands").alias("band"))
    lowest = spread.groupBy("band").agg(F.min("_k").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = spread.join(lowest, "band").where("_k != b").select(F.col("_k").alias("a"), "b").distinct()
    groups = components(edges)
    inside = texts.join(groups.withColumnRenamed("node", "_k"), "_k").select("_k", "_l", "doc_id", "size", "root")
    total = inside.groupBy("root").agg(F.sum("size").alias("total")).select(
        "root", F.ceil(F.col("total") / block).cast("int").alias("blocks"))
    members = written(inside.join(total, "root"), "members")

    # one document for each text that has a candidate
    wanted = members.select(F.col("doc_id").alias("_id"), F.col("_k").alias("_a"), F.col("_l").alias("_b"),
                            "root", "blocks").hint("shuffle_hash")
    chosen = bare.join(wanted, (bare["_k"] == wanted["_a"]) & (bare["_l"] == wanted["_b"])
                       & bare["doc_id"].eqNullSafe(wanted["_id"])).select("root", "blocks", "_k", "_l", "data")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _sliced(batches):
            found = shingles(texts)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:4], pa.array([s.tobytes() for s, _ in found], pa.binary()),
                 pa.array([t.astype("<u4").tobytes() for _, t in found], pa.binary())],
                ["root", "blocks", "_k", "_l", "shingles", "counts"])

    sets = written(chosen.mapInArrow(
        cut, "root bigint, blocks int, _k bigint, _l bigint, shingles binary, counts binary").dropDuplicates(
        ["_k", "_l"]), "sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts arrive ordered by group; each is linked to its class's lowest."""
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            member = [(np.frombuffer(r["shingles"], "<u8"), np.frombuffer(r["counts"], "<u4").astype(np.int64)) for r in held]
            asked = np.array([i for i, r in enumerate(held) if r["asked"]], np.int64)
            label = links(member, sent.value, threshold, None if len(asked) == len(held) else asked)
            return pa.RecordBatch.from_arrays(
                [pa.array([r["_k"] for r in held], pa.int64()), pa.array([r["_l"] for r in held], pa.int64()),
                 pa.array([held[i]["_k"] for i in label], pa.int64()),
                 pa.array([held[i]["_l"] for i in label], pa.int64())], ["_k", "_l", "to_k", "to_l"])

        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                for row in batch.slice(begin, 256).to_pylist():
                    if held and (row["root"], row["part"]) != (held[-1]["root"], held[-1]["part"]):
                        yield close()
                        held = []
                    held.append(row)
        if held:
            yield close()

    linked = "_k bigint, _l bigint, to_k bigint, to_l bigint"

    def compared(rows: DataFrame) -> DataFrame:
        wide = rows.select("root", "part", "asked", "_k", "_l", "shingles", "counts")
        return wide.repartition("root", "part").sortWithinPartitions("root", "part", "_k", "_l").mapInArrow(
            compare, linked)

    def dealt(salt: int):
        return F.pmod(F.xxhash64(F.lit(salt), "_k", "_l"), F.col("blocks")).cast("int")

    whole = compared(sets.where("blocks <= 1").withColumns({"part": F.lit(0), "asked": F.lit(True)}))
    found = written(whole, "linked").select("_k", "_l", F.col("to_k").alias("root"))
    large = sets.where("blocks > 1")
    if not large.limit(1).isEmpty():
        found = found.unionByName(_large(large, dealt, compared, block))

    named = texts.select("_k", "_l", "doc_id").join(found, ["_k", "_l"], "left").withColumn(
        "_class", F.coalesce("root", "_k"))
    lowest = named.groupBy("_class").agg(F.min("doc_id").alias("class_id"))
    to_class = named.join(lowest, "_class").select("_k", "_l", "_class", "class_id").hint("shuffle_hash")
    return keyed.join(to_class, ["_k", "_l"]).drop("_k", "_l")


def _large(large: DataFrame, dealt, compared, block: int) -> DataFrame:
    """_k, _l and root of the texts of components that take several blocks."""
    twice = large.select("*", F.explode(F.array(dealt(1), dealt(2) + F.col("blocks"))).alias("part")).withColumn(
        "asked", F.lit(True))
    so_far = written(compared(twice), "linked")
    root_of = components(so_far.select(F.col("_k").alias("a"), F.col("to_k").alias("b")))
    state = large.select("root", "_k", "_l", "counts").join(
        root_of.withColumnsRenamed({"node": "_k", "root": "now"}), "_k", "left").withColumn(
        "now", F.coalesce("now", "_k"))
    sizes = state.groupBy("root", "now").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("root").agg(F.max(F.struct("n", "now"))["now"].alias("largest"))
    rest = written(state.join(largest, "root").where("now != largest").select(
        "root", "_k", "_l", (F.octet_length("counts") / 4 + TEXT).alias("size")), "rest")
    # the rest, in chunks, against all texts, in blocks
    chunks = rest.groupBy("root").agg(F.ceil(F.sum("size") / block).cast("int").alias("chunks"))
    both = large.join(chunks, "root")
    chunk = F.pmod(F.xxhash64(F.lit(4), "_k", "_l"), F.col("chunks")).cast("int")
    asked = both.join(rest.select("_k", "_l"), ["_k", "_l"], "left_semi").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at")).withColumn(
        "part", F.col("at") + F.col("blocks") * chunk).withColumn("asked", F.lit(True))
    all_texts = both.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("at")).withColumn(
        "part", dealt(3) + F.col("blocks") * F.col("at")).withColumn("asked", F.lit(False))
    linked = so_far.unionByName(compared(asked.unionByName(all_texts)))
    final = components(linked.select(F.col("_k").alias("a"), F.col("to_k").alias("b")))
    return large.select("_k", "_l").join(final.withColumnRenamed("node", "_k"), "_k", "left").select(
        "_k", "_l", F.coalesce("root", "_k").alias("root"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (lowest doc_id of the class) and kept (whether the
    row has that id) of every row."""
    table = _classes(docs.select("doc_id", "text"), threshold, block)
    return table.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``docs`` with its columns, one document of each class."""
    renamed, back = aside(docs, "doc_id", "text")
    kept = _classes(renamed, threshold, block).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    # several rows of an id, or without one, may be left of a class
    ids = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("some")).first()
    repeated = ids["n"] > ids["some"] or not docs.groupBy("doc_id").count().where("count > 1").limit(1).isEmpty()
    return back(kept.dropDuplicates(["_class"]) if repeated else kept)
