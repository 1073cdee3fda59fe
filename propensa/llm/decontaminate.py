"""Benchmark decontamination with an FM-index per training shard (op 4).

Phrases are the ``WINDOW``-word windows of the benchmark items (an item of
fewer words is one phrase).  A shard is a run of documents.  Its words become
numbers of the benchmark's vocabulary; a word that no item has, or a pair of
neighbours that no item has, is a break, and stretches between breaks that are
shorter than any phrase cannot hold one.  The rest is indexed.  Phrases are
found by backward search, all of a length at once; their places come from
sampled suffix positions and are merged to spans of words and of bytes.

The benchmark is a stated query set.  It is taken in blocks of at most
``BLOCK_BYTES`` of item text (one item at least), one pass over the shards for
each.  A block's windows, word numbers and vocabulary take at most 12 bytes a
byte of text, which bounds the broadcast; it is made on the driver from arrays.

Cases: a null or empty text has no words and no hits; an item without words
has no phrase; items with equal text or id are found once per id; an item
whose id is null marks words but is in no list of items; repeated documents
and null doc_ids are kept; empty tables give no rows, or no hits; other columns
are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import aside, text_of
from propensa.llm.fm_index import FMIndex
from propensa.llm.words import texts_words
from propensa.session import written

WINDOW = 13
BLOCK_BYTES = 4 << 20
#: Windows searched together.
TOGETHER = 1 << 16
#: Bytes of text in a shard.
SHARD = 8 << 20


class Phrases:
    """The windows of a block of items, as numbers of its vocabulary.

    Windows are places in the items' words (``words``, 32 bits each), not
    copies of them; ``by_length`` has, for each length, the places of the
    different windows and, as one list with limits, whose they are.
    """

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        self.ids = sorted({i for i, _ in items if i is not None})
        number = {i: k for k, i in enumerate(self.ids)}
        owner = np.array([-1 if i is None else number[i] for i, _ in items], np.int32)
        document, _, _, code = texts_words([t.encode() for _, t in items])
        self.vocabulary = np.unique(code)
        self.words = (np.searchsorted(self.vocabulary, code) + 1).astype(np.int32)
        self.size = len(self.vocabulary) + 1
        joined = document[1:] == document[:-1]
        self.pairs = np.unique((self.words[:-1].astype(np.int64) * self.size + self.words[1:])[joined])
        count = np.bincount(document, minlength=len(items))
        begin = np.cumsum(count) - count
        # a window per place that has ``window`` words after it, or one for all of a short item
        short = (count > 0) & (count < window)
        length = np.where(short, count, window)
        places = np.where(count > 0, np.maximum(1, count - window + 1), 0)
        item = np.repeat(np.arange(len(items)), places)
        start = np.repeat(begin, places) + np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
        self.by_length: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for n in np.unique(length[item]).tolist():
            mine = length[item] == n
            self.by_length.append((n, *self._different(start[mine], owner[item[mine]], n)))
        self.shortest = min((n for n, *_ in self.by_length), default=0)

    def _different(self, start: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of different windows of ``n`` words, limits of each one's
        owners, and owners."""
        order = np.arange(len(start))
        for k in range(n - 1, -1, -1):       # by one word after the other
            order = order[np.argsort(self.words[start[order] + k], kind="stable")]
        start, owner = start[order], owner[order]
        new = np.zeros(len(start), bool)
        new[:1] = True
        for k in range(n):
            new[1:] |= self.words[start[1:] + k] != self.words[start[:-1] + k]
        phrase = np.cumsum(new) - 1
        whose = np.unique((phrase * (len(self.ids) + 1) + owner)[owner >= 0])
        which = whose // (len(self.ids) + 1)
        limits = np.searchsorted(which, np.arange(int(new.sum()) + 1))
        return start[new].astype(np.int32), limits.astype(np.int32), (whose % (len(self.ids) + 1)).astype(np.int32)

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of at most ``TOGETHER`` windows of a length as rows of word
        numbers, with their limits and the owners."""
        for n, start, limits, owners in self.by_length:
            for at in range(0, len(start), TOGETHER):
                part = start[at:at + TOGETHER]
                yield (self.words[part[:, None] + np.arange(n)].astype(np.int64),
                       limits[at:at + len(part) + 1].astype(np.int64), owners)

    def find(self, document: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words in order: whether each is in an occurrence; and document
        and item number of all items found."""
        hit = np.zeros(len(code) + 1, np.int64)
        none = hit[:-1] > 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.by_length or not len(code):
            return none
        at = np.minimum(np.searchsorted(self.vocabulary, code), len(self.vocabulary) - 1)
        symbol = np.where(self.vocabulary[at] == code, at + 1, 0)
        pair = symbol[:-1] * self.size + symbol[1:]
        near = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        joined = (self.pairs[near] == pair if len(self.pairs) else np.zeros(len(pair), bool)) \
            & (document[1:] == document[:-1])
        first = np.concatenate([[True], ~joined]) & (symbol > 0)
        group = np.cumsum(np.concatenate([[True], ~joined])) - 1
        long = np.bincount(group)[group] >= self.shortest
        word = np.flatnonzero(long & (symbol > 0))
        if not len(word):
            return none
        # a separator before each stretch
        shift = np.arange(len(word)) + np.cumsum(first[word])
        text = np.zeros(shift[-1] + 1, np.int64)
        text[shift] = symbol[word]
        back = np.zeros(len(text), np.int64)
        back[shift] = word
        index = FMIndex(text, self.size)
        where, who = [], []
        for rows, limits, owners in self.windows():
            low, high = index.search(rows)
            count = high - low
            phrase = np.repeat(np.arange(len(rows)), count)
            row = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[phrase]
            place = back[index.locate(row)]
            np.add.at(hit, place, 1)
            np.add.at(hit, place + rows.shape[1], -1)
            times = np.diff(limits)[phrase]
            where.append(np.repeat(document[place], times))
            who.append(owners[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                              + np.repeat(limits[phrase], times)])
        both = np.unique(np.stack([np.concatenate(where), np.concatenate(who)]), axis=1)
        return np.cumsum(hit[:-1]) > 0, both[0], both[1]


def _scan(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """``docs`` (with text, spans, items) with this block's finds added."""
    sent = docs.sparkSession.sparkContext.broadcast(phrases)
    columns = docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * SHARD // max(SHARD, batch.nbytes))
            for begin in range(0, batch.num_rows, step):
                yield shard(batch.slice(begin, step))

    def shard(rows: pa.RecordBatch) -> pa.RecordBatch:
        phrases = sent.value
        texts = [t.encode() for t in rows.column("text").to_pylist()]
        document, start, end, code = texts_words(texts)
        hit, where, who = phrases.find(document, code)
        n_words = np.bincount(document, minlength=len(texts))
        begin = np.cumsum(n_words) - n_words
        old_spans, old_items = rows.column("spans").to_pylist(), rows.column("items").to_pylist()
        for k in np.unique(document[hit]):
            mine = slice(begin[k], begin[k] + n_words[k])
            covered = hit[mine].copy()
            for span in old_spans[k]:
                covered[span["first"]:span["last"]] = True
            edge = np.diff(np.concatenate([[0], covered.view(np.int8), [0]]))
            a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            old_spans[k] = [{"first": int(x), "last": int(y), "low": int(start[mine][x]), "high": int(end[mine][y - 1])}
                            for x, y in zip(a, b)]
        for k, item in zip(where.tolist(), who.tolist()):
            old_items[k].append(phrases.ids[item])
        new = {"n_words": pa.array(n_words, pa.int64()),
               "spans": pa.array(old_spans, rows.schema.field("spans").type),
               "items": pa.array([sorted(set(i)) for i in old_items], rows.schema.field("items").type)}
        return pa.RecordBatch.from_arrays([new[c] if c in new else rows.column(c) for c in columns], columns)

    return docs.mapInArrow(scan, docs.schema)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (text not null) with n_words, spans (first and last word, low
    and high byte; ends exclusive) and items (sorted ids as strings)."""
    items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), text_of(benchmark).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = docs.withColumn("text", text_of(docs)).withColumns({
        "n_words": F.lit(0).cast("bigint"),
        "spans": F.expr("cast(array() as array<struct<first: bigint, last: bigint, low: bigint, high: bigint>>)"),
        "items": F.expr("cast(array() as array<string>)")})
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        found = _scan(found, Phrases([tuple(r) for r in block.collect()], window))
        if k + 1 < blocks:      # passes do not run inside each other
            found = written(found, "scanned")
    return found


def n_hit() -> Column:
    return F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first)")


def is_contaminated() -> Column:
    """At least a twentieth of the words are in occurrences."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated."""
    found = find_benchmark(docs.select("doc_id", "text"), benchmark, window).withColumn("n_hit", n_hit())
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents; own columns, texts whole."""
    renamed, back = aside(docs, "text")
    found = find_benchmark(renamed, benchmark, window).withColumn("n_hit", n_hit())
    return back(found.where(~is_contaminated()))
