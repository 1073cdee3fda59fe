"""Removal of repeated byte strings with suffix arrays per shard (op 3).

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else, in the same document or another.  Suffixes are not compared
corpus-wide; what could be equal is first brought into the same shard:

1. *Anchors.*  Every ``length``-byte window selects the leftmost lowest hash
   among its ``ANCHOR``-byte substrings.  Equal windows select equal anchors at
   equal places.  The windows that select one anchor overlap in a piece of
   text, and each window is in one piece.
2. *Counts.*  Spark counts anchors by hash, and pieces by hash within an
   anchor.  Pieces that occur twice are repeats whole, however many there are,
   so copies are never brought together.  Of different pieces of one anchor,
   one of each kind goes on, and of these the windows whose common middle
   (``BIN`` neighbouring windows at a time) occurs in another kind, too.
3. *Shards.*  Those are dealt out by anchor.  Each shard's suffix array is
   built by induced sorting (``suffix_array``); permuted common prefixes give
   runs of suffixes that agree for ``length`` bytes, and a run with two
   places is a repeat.
4. *Hot anchors*, with over ``HOT`` different pieces left, are not brought
   into one shard: their windows are counted by digest instead.

Hashes of anchors and middles only route.  Pieces of an anchor are told apart
by two 64-bit hashes together, windows of hot anchors by 128 bits.

Cases: a null text is empty; texts under ``length`` bytes keep all; repeated
rows are copies of each other, whatever their doc_id; null doc_ids are kept;
an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import aside, field_type, text_of
from propensa.llm.suffix_array import permuted_lcp, suffix_array
from propensa.session import written

LENGTH, ANCHOR = 400, 128
#: Different pieces of one anchor that share a shard.
HOT = 4096
#: Neighbouring windows whose common middle is compared.
BIN = 68
#: Bytes hashed at once (a part takes some 60 bytes of arrays a byte), and
#: bytes in a shard.
PART, SHARD = 1 << 18, 1 << 21
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PLACE_BITS = 24
#: What a span is.
PIECE, SINGLE, FOUND = 0, 1, 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OF_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_POWERS: dict[int, np.ndarray] = {}
KEPT = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1; up to ``KEPT`` of them are held for the next call."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(max(n, 1), base, np.uint64)
        steps[0] = 1
        powers = np.multiply.accumulate(steps)
        if n > KEPT:
            return powers
        _POWERS[base] = powers
    return _POWERS[base][:n]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Lowest of each ``width`` neighbours, by block-wise running minima."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _parts(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Runs of (text index, place in it, bytes) that hold every window of
    every text once."""
    run, held = [], 0
    for i, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, PART):
            run.append((i, start, text[start:start + PART + length - 1]))
            held += len(run[-1][2])
            if held >= PART:
                yield run
                run, held = [], 0
    if run:
        yield run


def find_anchors(texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Text index, low and high end of the piece, place of the anchor in it,
    anchor hash and piece hash of all anchors."""
    found = [(np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),) * 2]
    place_mask = np.uint64((1 << PLACE_BITS) - 1)
    for run in _parts(texts, length):
        data = np.frombuffer(b"".join(p[2] for p in run), np.uint8)
        sizes = np.array([len(p[2]) for p in run])
        begin = np.cumsum(sizes) - sizes
        n = len(data)
        inverse = _powers(INVERSE, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_OF_BYTE[data] * _powers(BASE, n), out=sums[1:])
        hashes = _mix((sums[anchor:] - sums[:-anchor]) * inverse[:n + 1 - anchor])
        # the place below the hash: the leftmost of equal hashes is lowest
        ranked = (hashes & ~place_mask) | np.arange(len(hashes), dtype=np.uint64)
        lowest = (sliding_min(ranked, length - anchor + 1) & place_mask).astype(np.int64)
        # windows inside one part, in order; those of one anchor are neighbours
        inside = np.zeros(n + 1, np.int8)
        inside[begin] = 1
        inside[begin + sizes - length + 1] -= 1
        window = np.flatnonzero(np.cumsum(inside, dtype=np.int8))
        chosen = lowest[window]
        first = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (np.diff(window) > 1)]))
        low, at = window[first], chosen[first]
        high = window[np.append(first[1:], len(window)) - 1] + length
        piece = _mix((sums[high] - sums[low]) * inverse[low] + _mix(((high - low) * 4096 + at - low).astype(np.uint64)))
        part = np.searchsorted(begin, low, side="right") - 1
        move = np.array([p[1] for p in run])[part] - begin[part]
        found.append((np.array([p[0] for p in run])[part], low + move, high + move, at - low, hashes[at], piece))
    return tuple(np.concatenate(x) for x in zip(*found))


def bins_of(piece: bytes, offset: int, length: int = LENGTH, width: int = BIN) -> tuple[list[int], list[int]]:
    """The bins (by distance of the window's start to the anchor) that a
    piece has windows in, and the hash of the middle they share."""
    bins = range((offset - len(piece) + length) // width, offset // width + 1)
    middles = [piece[offset - width * j:offset - width * j + length - width + 1] for j in bins]
    return list(bins), [xxhash.xxh64_intdigest(m) - (1 << 63) for m in middles]


def windows_in(piece_size: int, offset: int, bins: list[int], length: int = LENGTH,
               width: int = BIN) -> list[tuple[int, int]]:
    """Limits, in the piece, of the texts that hold its windows in ``bins``."""
    spans: list[tuple[int, int]] = []
    for j in sorted(bins, reverse=True):      # windows from left to right
        low = max(0, offset - width * (j + 1) + 1)
        high = min(piece_size, offset - width * j + length)
        if spans and spans[-1][1] - length + 1 >= low:
            spans[-1] = spans[-1][0], high
        else:
            spans.append((low, high))
    return spans


def shard_repeats(pieces: list[bytes], place: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """Piece index and limits (in the piece) of strings of ``length`` bytes
    that occur at two places.  ``place``: a number for each piece's first byte,
    such that equal places have equal numbers and others differ."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.uint16) + 1
    text[begin + sizes] = 0                   # separators
    used = np.flatnonzero(np.bincount(text, minlength=257))
    code = np.zeros(257, np.uint8 if len(used) <= 256 else np.uint16)
    code[used] = np.arange(len(used))
    text = code[text]
    array = suffix_array(text, len(used))
    common = permuted_lcp(text, array)[array]
    piece = np.searchsorted(begin, array, side="right") - 1
    offset = array - begin[piece]
    whole = offset + length <= sizes[piece]   # the window lies in its piece
    agrees = common >= length
    run = np.cumsum(~agrees)[whole]
    piece, offset = piece[whole], offset[whole]
    if not len(run):
        return []
    spot = place[piece] + offset.astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    counts = np.diff(np.append(first, len(run)))
    many = np.repeat(np.minimum.reduceat(spot, first) != np.maximum.reduceat(spot, first), counts)
    return merged_spans(piece[many], offset[many], offset[many] + length)


def merged_spans(piece: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int, int]]:
    """Unions of overlapping or touching spans, by piece."""
    order = np.lexsort((low, piece))
    spans: list[tuple[int, int, int]] = []
    for p, a, b in zip(piece[order].tolist(), low[order].tolist(), high[order].tolist()):
        if spans and spans[-1][0] == p and a <= spans[-1][2]:
            spans[-1] = p, spans[-1][1], max(b, spans[-1][2])
        else:
            spans.append((p, a, b))
    return spans


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """doc_id, text_hash, low, high, tag: pieces of repeated anchors (PIECE),
    those of them that occur once (SINGLE), and strings found in shards
    (FOUND).  What goes is the union of all but the single pieces.

    ``docs`` has doc_id, text_hash and text (not null).
    """
    kind = field_type(docs, "doc_id")
    data = docs.select("doc_id", "text_hash", F.col("text").cast("binary").alias("data")).where(
        F.octet_length("text") >= length)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = max(1, batch.num_rows * PART // max(PART, batch.nbytes))
            for start in range(0, batch.num_rows, size):
                rows = batch.slice(start, size)
                text, low, high, offset, hashes, piece = find_anchors(rows.column("data").to_pylist(), length, anchor)
                which = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(which), rows.column("text_hash").take(which), pa.array(low),
                     pa.array(high), pa.array(offset), pa.array(hashes.view(np.int64)), pa.array(piece.view(np.int64))],
                    ["doc_id", "text_hash", "low", "high", "offset", "anchor", "piece"])

    found = written(data.mapInArrow(anchors, f"doc_id {kind}, text_hash bigint, low bigint, high bigint, offset bigint, "
                                             "anchor bigint, piece bigint"), "anchors")
    # tables that rows are joined with are written: then both sides of a join
    # are shuffled, and the rows of a hot anchor may be split
    twice = written(found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("piece").alias("a"), F.max("piece").alias("b")).where("n > 1").selectExpr(
        "anchor", "a != b as varied"), "twice")
    repeated = written(found.join(twice, "anchor"), "repeated")
    span = ["doc_id", "text_hash", "low", "high"]

    def tagged(df: DataFrame, tag: int) -> DataFrame:
        return df.select(*span, F.lit(tag).alias("tag"))

    varied = repeated.where("varied")
    kinds = written(varied.groupBy("anchor", "piece").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in [*span, "offset"]]), "kinds")
    # where every kind occurs twice, all of them are copies already
    once = written(kinds.groupBy("anchor").agg(F.min("n").alias("n")).where("n = 1").select("anchor"), "once")
    wanted = kinds.join(once, "anchor").groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("low", "high", "offset", "anchor", "piece")).alias("wanted"))
    bodies = _with_text(data, wanted, "inner")

    def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for start in range(0, len(row["wanted"]), 1024):
                    part = row["wanted"][start:start + 1024]
                    texts = [row["data"][w["low"]:w["high"]] for w in part]
                    bins = [bins_of(t, w["offset"], length) for t, w in zip(texts, part)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w["anchor"] for w in part], pa.int64()), pa.array([w["piece"] for w in part], pa.int64()),
                         pa.array([row["doc_id"]] * len(part), batch.schema.field("doc_id").type),
                         pa.array([row["text_hash"]] * len(part), pa.int64()),
                         pa.array([w["low"] for w in part], pa.int64()), pa.array([w["offset"] for w in part], pa.int64()),
                         pa.array(texts, pa.binary()), pa.array([b for b, _ in bins], pa.list_(pa.int32())),
                         pa.array([m for _, m in bins], pa.list_(pa.int64()))],
                        ["anchor", "piece", "doc_id", "text_hash", "low", "offset", "data", "bins", "middles"])

    pieces = written(bodies.mapInArrow(
        cut_pieces, f"anchor bigint, piece bigint, doc_id {kind}, text_hash bigint, low bigint, offset bigint, "
                    "data binary, bins array<int>, middles array<bigint>"), "pieces")
    middles = pieces.select("anchor", "piece", F.inline(F.arrays_zip("bins", "middles"))).toDF(
        "anchor", "piece", "bin", "middle")
    shared = written(middles.groupBy("anchor", "bin", "middle").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "shared")
    alive = written(middles.join(shared, ["anchor", "bin", "middle"]).groupBy("anchor", "piece").agg(
        F.collect_list("bin").alias("alive")), "alive")
    crowd = alive.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor", F.lit(True).alias("hot"))
    left = written(pieces.drop("bins", "middles").join(alive, ["anchor", "piece"]).drop("piece").join(
        crowd, "anchor", "left"), "left")
    schema = f"doc_id {kind}, text_hash bigint, low bigint, high bigint"
    in_shards = left.where("hot is null").withColumn("document", F.xxhash64("doc_id", "text_hash"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive ordered by anchor; an anchor's pieces stay together."""
        held: list[tuple] = []
        size, last = 0, None

        def close() -> pa.RecordBatch:
            texts, documents, doc_ids, text_hashes, lows = zip(*held)
            low = np.array(lows, np.int64)
            place = _mix(np.array(documents, np.int64).view(np.uint64)) + low.astype(np.uint64)
            spans = shard_repeats(list(texts), place, length)
            return pa.RecordBatch.from_arrays(
                [pa.array([doc_ids[p] for p, _, _ in spans], kinds_type), pa.array([text_hashes[p] for p, _, _ in spans], pa.int64()),
                 pa.array([lows[p] + a for p, a, _ in spans], pa.int64()), pa.array([lows[p] + b for p, _, b in spans], pa.int64())],
                ["doc_id", "text_hash", "low", "high"])

        for batch in batches:
            kinds_type = batch.schema.field("doc_id").type
            for start in range(0, batch.num_rows, 512):
                for row in batch.slice(start, 512).to_pylist():
                    if size >= SHARD and last != row["anchor"]:
                        yield close()
                        held, size = [], 0
                    last = row["anchor"]
                    for a, b in windows_in(len(row["data"]), row["offset"], row["alive"], length):
                        held.append((row["data"][a:b], row["document"], row["doc_id"], row["text_hash"], row["low"] + a))
                        size += b - a
        if held:
            yield close()

    # a number of partitions, because sorting suffixes takes time by bytes, and
    # a few MB of them more of it than Spark would expect
    size = in_shards.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    parts = max(1, -(-size // SHARD))
    from_shards = in_shards.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(shards, schema)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                spans = windows_in(len(row["data"]), row["offset"], row["alive"], length)
                at = [j for a, b in spans for j in range(a, b - length + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.md5(row["data"][j:j + length]).digest() for j in at], pa.binary()),
                     pa.array([row["doc_id"]] * len(at), batch.schema.field("doc_id").type),
                     pa.array([row["text_hash"]] * len(at), pa.int64()), pa.array([row["low"] + j for j in at], pa.int64())],
                    ["window", "doc_id", "text_hash", "low"])

    single = left.where("hot").mapInArrow(windows, f"window binary, doc_id {kind}, text_hash bigint, low bigint")
    # a window is in one piece, and kinds are distinct: two rows are two places
    again = single.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    from_hot = single.join(again, "window").select("doc_id", "text_hash", "low", (F.col("low") + length).alias("high"))
    return tagged(repeated, PIECE).unionByName(tagged(kinds.where("n = 1"), SINGLE)).unionByName(
        tagged(from_shards, FOUND)).unionByName(tagged(from_hot, FOUND))


def _with_text(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Join per-document lists to documents on (doc_id, text_hash), null-safe;
    the lists are the hashed side, so texts are not sorted."""
    right = lists.withColumnsRenamed({"doc_id": "right_id", "text_hash": "right_hash"}).hint("shuffle_hash")
    on = docs["doc_id"].eqNullSafe(right["right_id"]) & (docs["text_hash"] == right["right_hash"])
    return docs.join(right, on, how).drop("right_id", "right_hash")


def with_removals(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """``docs`` with its columns, text as not null, and ``spans``: an array of
    (low, high, tag) as from :func:`repeated_spans`; null if none."""
    keyed = docs.withColumn("text", text_of(docs)).withColumn("text_hash", F.xxhash64("text"))
    spans = repeated_spans(keyed.select("doc_id", "text_hash", "text"), length, anchor, hot)
    # a set: repeated rows of one doc_id all bring the spans of their text
    lists = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("low", "high", "tag")).alias("spans"))
    return _with_text(keyed, lists, "left")


def cut(data: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of ``data``, and the maximal removed spans."""
    single = {(s["low"], s["high"]) for s in spans or () if s["tag"] == SINGLE}
    spans = [s for s in spans or () if s["tag"] == FOUND or s["tag"] == PIECE and (s["low"], s["high"]) not in single]
    if not spans:
        return data, []
    low, high = np.array([s["low"] for s in spans]), np.array([s["high"] for s in spans])
    gone = [(a, b) for _, a, b in merged_spans(np.zeros(len(low), np.int64), low, high)]
    kept, at = [], 0
    for a, b in gone:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]]), gone


def removal_report(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and text,
    what is left; a character that lost some of its bytes is not in it."""
    table = with_removals(docs.select("doc_id", "text"), length, anchor, hot).select(
        "doc_id", F.col("text").cast("binary").alias("data"), "spans")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, spans in zip(batch.column("data"), batch.column("spans")):
                data = data.as_py()
                kept, gone = cut(data, spans.as_py())
                rows.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(),
                             kept.decode(errors="ignore")))
            n, removed, spans, sha, texts = zip(*rows) if rows else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    return table.mapInArrow(report, f"doc_id {field_type(table, 'doc_id')}, n_bytes bigint, n_removed bigint, "
                                    "n_spans bigint, kept_sha256 string, text string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """``docs`` with its own columns, repeated bytes cut from ``text``.  A
    character that loses some of its bytes loses all of them."""
    renamed, back = aside(docs, "doc_id", "text")
    table = with_removals(renamed, length, anchor, hot).drop("text_hash")
    columns = renamed.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                text, spans = text.as_py(), spans.as_py()
                texts.append(cut(text.encode(), spans)[0].decode(errors="ignore") if spans else text)
            arrays = [batch.column(c) for c in columns]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return back(table.mapInArrow(apply, table.select([f"`{c}`" for c in columns]).schema))
