"""Token ids as binary blocks with Elias-Fano document boundaries (op 2).

``write_tokens`` range-partitions documents by id, encodes each text, appends
the end id, and writes blocks: the ids of consecutive documents, concatenated,
and their boundaries as an Elias-Fano code.  ``read_tokens`` opens the blocks
again and finds each document's ids by ``select``.

A block is one row of a Parquet table in the shared folder, so that any store
Spark can reach will do::

    part, block     place in document order
    before          ids of this part's earlier blocks
    n_ids           ids in this block
    doc_ids         ids of its documents, ascending, nulls first
    data            b"EFT2", id width in bytes, Elias-Fano boundaries, ids

Cases: a null text is an empty text (one end id); null doc_ids come first;
rows with equal doc_id are ordered by a hash of the text and all kept; an empty
table gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import field_type, slices, text_of
from propensa.llm.elias_fano import EliasFano
from propensa.llm.tokenizer import word_tokenizer
from propensa.session import written

MAGIC = b"EFT2"
#: A block is closed once it has so many ids or documents.
BLOCK_IDS, BLOCK_DOCS = 1 << 20, 1 << 14
#: Words in each of the tokenizer's generations, so that rarer ones are met
#: again: about 70 MB each, for which there is room beside a block.
WORDS = 400_000


def pack_block(ids: list[bytes], width: int) -> tuple[bytes, int]:
    """Block bytes and number of ids; ``ids``: uint32 bytes of each document."""
    ends = np.cumsum([0] + [len(x) // 4 for x in ids])
    flat = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}")
    return MAGIC + bytes([width]) + EliasFano.of(ends).to_bytes() + flat.tobytes(), int(ends[-1])


def open_block(data: bytes) -> tuple[EliasFano, np.ndarray]:
    """Boundaries and ids of a block."""
    view = memoryview(data)
    if bytes(view[:4]) != MAGIC:
        raise ValueError("not a token block")
    width = view[4]
    bounds, used = EliasFano.from_bytes(view[5:])
    return bounds, np.frombuffer(view[5 + used:], f"<u{width}")


def write_tokens(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write the blocks of ``docs`` (doc_id, text) and return their table."""
    table = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    table = table.withColumn("h", F.xxhash64("text"))
    # the row's number last, so that any number of equal rows can be cut
    order = F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("row")
    table = table.withColumn("row", F.monotonically_increasing_id())
    table = table.repartitionByRange(*order).sortWithinPartitions(*order).drop("h", "row")
    kind = table.schema["doc_id"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path, WORDS)
        width = 2 if max(tokenizer.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        keys: list = []
        held = 0

        def close() -> pa.RecordBatch:
            data, n = pack_block(ids, width)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int64()),
                "before": pa.array([before], pa.int64()), "n_ids": pa.array([n], pa.int64()),
                "doc_ids": pa.array([keys], pa.list_(key_type)), "data": pa.array([data], pa.binary())})

        for batch in batches:
            key_type = batch.schema.field("doc_id").type
            for rows, texts in slices(batch):
                for key, code in zip(rows.column("doc_id").to_pylist(), tokenizer.encode(texts)):
                    ids.append(code + end)
                    keys.append(key)
                    held += len(code) // 4 + 1
                    if held >= BLOCK_IDS or len(ids) >= BLOCK_DOCS:
                        yield close()
                        block, before, held = block + 1, before + held, 0
                        ids, keys = [], []
        if ids:
            yield close()

    schema = (f"part int, block bigint, before bigint, n_ids bigint, "
              f"doc_ids array<{kind.simpleString()}>, data binary")
    return written(table.mapInArrow(encode, schema), "tokens")


def read_tokens(blocks: DataFrame) -> DataFrame:
    """One row per document from the blocks: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of the ids as uint32)."""
    # one row per part: as many as the write had partitions
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = totals.selectExpr(
        "part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as base")
    table = blocks.join(F.broadcast(starts), "part").selectExpr("base + before as first", "doc_ids", "data")
    kind = field_type(blocks, "doc_ids")[len("array<"):-1]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bounds, ids = open_block(batch.column("data")[i].as_py())
                keys = batch.column("doc_ids")[i].values
                at = bounds.select(np.arange(bounds.n))
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(at[:-1] + batch.column("first")[i].as_py()), pa.array(np.diff(at)),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return table.mapInArrow(decode, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
