"""Importance resampling towards a target distribution (op 11).

Features of a text are its runs of ``low`` to ``high`` words, hashed to
``BUCKETS`` buckets.  A document's weight is the mean, over its features, of
how much commoner their buckets are in the target's texts than in the
documents; Gumbel noise, fixed by the document's id and a seed, makes the
highest scores a draw without replacement.

1. *Batches.*  The texts of a batch are joined with a separator, one pass of
   one regular expression finds the words of all of them, and a binary search
   over the documents' offsets says whose they are.  Runs of words with ends in
   different documents are masked before buckets are counted.
2. *Counts* of all documents and of all target texts are added up by Spark, in
   blocks of buckets; the driver gets ``BUCKETS`` numbers, whatever the corpus.
3. *Weights* come from a second pass over the texts, with the gains at hand.
4. *Draw.*  The least drawn score is found from counts of scores, first in steps
   of ``STEP``, then within one; rows from there up are numbered by sorted ranges
   (``numbering``).  No task sorts all rows, however many share a score or an id.

Cases: a null or empty text has no words, no features and weight 0, and is
drawn only where ``least_words`` allows it; a null id is drawn like the empty
one and comes after others of its score; repeated rows have equal scores and
are drawn one by one, in no order that matters; ties go to the lower id; long texts are
counted in runs of ``RUN`` words; an empty table gives none, and an empty
target the same gain for all absent words; other columns are carried or ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import aside, slices, text_of
from propensa.llm.numbering import numbered
from propensa.session import written

BUCKETS, SEED = 10_000, 2024
#: Least words of a document that may be drawn.
LEAST_WORDS = 20
#: The separator is no word byte.  Bytes of a word after lowering A-Z, which
#: are those of code points other than 00-2F, 3A-60 and 7B-7F.
SEPARATOR = b"\n"
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Words held at once; buckets summed in one task; step of the score counts.
RUN, BLOCK, STEP = 1 << 18, 1000, 1024


def features(texts: list[str], low: int = 1, high: int = 1,
             buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of words of a batch: document of each word, and document and
    bucket of each feature that ends in the run."""
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(t) + 1 for t in data[:-1]])
    found = WORD.finditer(SEPARATOR.join(data).lower())     # bytes: A-Z only
    words: list[bytes] = []
    document = np.zeros(0, np.int64)
    while new := [(m.start(), m.group()) for m in itertools.islice(found, RUN)]:
        tail = max(0, len(words) - high + 1)      # of the run before
        starts = np.fromiter((s for s, _ in new), np.int64, len(new))
        words = words[tail:] + [w for _, w in new]
        document = np.concatenate([document[tail:], np.searchsorted(offsets, starts, side="right") - 1])
        old = len(words) - len(new)
        owners, hashed = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        code: list[int] = []
        for n in range(1, high + 1):
            code = ([zlib.crc32(w) for w in words] if n == 1
                    else [zlib.crc32(b" " + w, c) for c, w in zip(code, words[n - 1:])])
            if n < low or n > len(words):
                continue
            first = max(0, old - n + 1)           # runs of n words that end among the new ones
            own = document[first:len(words) - n + 1]
            within = own == document[first + n - 1:]
            owners.append(own[within])
            hashed.append((np.array(code[first:], np.int64) % buckets)[within])
        yield document[old:], np.concatenate(owners), np.concatenate(hashed)


def bucket_counts(texts: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``texts`` (column text, not null) are in each
    bucket."""
    edges = range(0, buckets, BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in slices(batch):
                for _, _, bucket in features(part, low, high, buckets):
                    counts += np.bincount(bucket, minlength=buckets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(edges)), pa.int32()), pa.array([counts[e:e + BLOCK].tobytes() for e in edges], pa.binary())],
            ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(part, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            ["block", "counts"])

    schema = "block int, counts binary"
    rows = texts.select("text").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()
    total = np.zeros(buckets, np.int64)
    for row in rows:
        part = np.frombuffer(bytes(row["counts"]), np.int64)
        total[row["block"] * BLOCK:row["block"] * BLOCK + len(part)] += part
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, floored."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, low: int = 1, high: int = 1) -> DataFrame:
    """``docs`` (text not null) with n_words, n_features and weight."""
    own = docs.columns

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                n_words, n_features, total = np.zeros((3, len(texts)), np.int64)
                for document, owner, bucket in features(texts, low, high, len(gain)):
                    n_words += np.bincount(document, minlength=len(texts))
                    n_features += np.bincount(owner, minlength=len(texts))
                    # whole numbers far below 2 ** 53: sums are exact
                    total += np.bincount(owner, gain[bucket], len(texts)).astype(np.int64)
                weight = np.where(n_features > 0, total // np.maximum(1, n_features), 0)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(n_words), pa.array(n_features), pa.array(weight)],
                    [*own, "n_words", "n_features", "weight"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(weigh, f"{kinds}, n_words bigint, n_features bigint, weight bigint")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, floored, from a hash of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def scored(docs: DataFrame, target: DataFrame, key: str = "doc_id", low: int = 1, high: int = 1,
           buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``docs`` (key, text and columns that do not clash) with n_words,
    n_features, weight and score."""
    docs = docs.withColumn("text", text_of(docs))
    gain = gains(bucket_counts(docs, low, high, buckets),
                 bucket_counts(target.select(text_of(target).alias("text")), low, high, buckets))
    return weighted(docs, gain, low, high).withColumn("score", F.col("weight") + gumbel(F.col(key), seed))


def least_drawn(scores: DataFrame, wanted: int) -> int | None:
    """The ``wanted``-th highest of column score; None if there are fewer."""
    def reached(counts: DataFrame, still: int) -> tuple[int, int] | None:
        # at most as many rows as a score has steps, or a step scores
        for value, n in sorted(counts.collect(), reverse=True):
            if n >= still:
                return value, still
            still -= n
        return None

    step = F.floor(F.col("score") / STEP).cast("bigint").alias("step")
    top = reached(scores.groupBy(step).count(), wanted) if wanted else None
    if top is None:
        return None
    inside = scores.where(F.floor(F.col("score") / STEP) == top[0])
    return reached(inside.groupBy("score").count(), top[1])[0]


def ranked(table: DataFrame, key: str = "doc_id", share: tuple[int, int] = (10, 100),
           least_words: int = LEAST_WORDS) -> DataFrame:
    """``table`` (from :func:`scored`, written) with rank: 1, 2, 3 ... for the
    drawn share of the rows with enough words, null for others."""
    table = written(table.withColumn("_row", F.monotonically_increasing_id()), "scored")
    eligible = table.where(F.col("n_words") >= least_words)
    wanted = eligible.count() * share[0] // share[1]
    least = least_drawn(eligible, wanted)
    if least is None:
        return table.drop("_row").withColumn("rank", F.lit(None).cast("bigint"))
    order = [F.col("score").desc(), F.col(key).asc_nulls_last()]
    drawn = numbered(eligible.where(F.col("score") >= least).select("_row", "score", key), order, [], "_row").where(
        F.col("at") < wanted).select(F.col("_row").alias("_drawn"), (F.col("at") + 1).alias("rank"))
    return table.join(drawn, F.col("_row") == F.col("_drawn"), "left").drop("_row", "_drawn")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", share: tuple[int, int] = (10, 100),
             low: int = 1, high: int = 1, buckets: int = BUCKETS, seed: int = SEED,
             least_words: int = LEAST_WORDS) -> DataFrame:
    """The drawn documents, with their own columns."""
    renamed, back = aside(docs, key, "text")
    none = renamed.withColumn("no text", F.col("text").isNull())
    found = ranked(scored(none, target, key, low, high, buckets, seed), key, share, least_words)
    return back(found.where("rank is not null").withColumn("text", F.when(~F.col("`no text`"), F.col("text"))))
