"""Quality classifier: a byte-level convolutional network in numpy (op 8).

A text is cut into overlapping chunks that cover all its bytes.  Bytes become
small vectors, learned filters slide over each chunk, each filter's highest
response is kept, and a small dense layer turns these into a logit.  The mean
logit of a document's chunks, on a scale fitted last, gives one probability.

The network is fitted on a bounded sample of the labelled rows whose
``crc32(doc_id as text) mod 5`` is not 0: the ``TRAIN_ROWS`` with the lowest
hash, in this order up to ``TRAIN_BYTES`` of text.  Fitting and scoring use all
chunks of their texts.  Only bytes of the text are inputs.

Cases: a null or empty text is one chunk of padding and has a score; labels
that are null or without a document are not used; several labels of a row are
each a training row; with one class or none the score is that class's share
(0.5 without rows); repeated rows score alike; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import aside, field_type, slices, text_of
from propensa.llm.tokenizer import release_tokenizer

#: The bounds of the sample; epochs over its chunks.
TRAIN_ROWS, TRAIN_BYTES, EPOCHS = 8192, 16 << 20, 3
CHUNK, OVERLAP = 256, 16
VECTOR, WIDTH, STRIDE, FILTERS, HIDDEN = 8, 12, 2, 48, 24
#: Chunks convolved at once.
BATCH = 64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def chunk_starts(n: int) -> range:
    """Starts of the chunks of a text of ``n`` bytes; they overlap."""
    return range(0, max(1, n - OVERLAP), CHUNK - OVERLAP)


def chunk_array(data: bytes, starts) -> np.ndarray:
    """Chunks as rows of byte numbers 1 to 256; 0 is padding."""
    rows = np.zeros((len(starts), CHUNK), np.int16)
    text = np.frombuffer(data, np.uint8)
    for row, at in zip(rows, starts):
        part = text[at:at + CHUNK]
        row[:len(part)] = part
        row[:len(part)] += 1
    return rows


class ByteCNN:
    """Embedding, convolution, max-pool, two dense layers; one logit a chunk."""

    def __init__(self, seed: int = 8):
        rng = np.random.default_rng(seed)

        def normal(*shape: int, fan: int) -> np.ndarray:
            return (rng.standard_normal(shape) * np.sqrt(2 / fan)).astype(np.float32)

        self.p = {"vector": normal(257, VECTOR, fan=2), "filter": normal(WIDTH * VECTOR, FILTERS, fan=WIDTH * VECTOR),
                  "bias": np.zeros(FILTERS, np.float32), "w1": normal(FILTERS, HIDDEN, fan=FILTERS),
                  "b1": np.zeros(HIDDEN, np.float32), "w2": normal(HIDDEN, fan=HIDDEN),
                  "b2": np.zeros((), np.float32)}
        self.slope, self.offset, self.constant = 1.0, 0.0, None

    def responses(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows (chunk, place, inputs) and filter responses."""
        flat = self.p["vector"][chunks].reshape(len(chunks), CHUNK * VECTOR)
        windows = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * VECTOR, axis=1)[:, ::STRIDE * VECTOR]
        windows = np.ascontiguousarray(windows)
        out = windows.reshape(-1, WIDTH * VECTOR) @ self.p["filter"]
        return windows, out.reshape(len(chunks), -1, FILTERS)

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        out = np.empty(len(chunks), np.float32)
        for at in range(0, len(chunks), BATCH):
            pooled = np.maximum(self.responses(chunks[at:at + BATCH])[1].max(axis=1) + self.p["bias"], 0)
            hidden = np.maximum(pooled @ self.p["w1"] + self.p["b1"], 0)
            out[at:at + BATCH] = hidden @ self.p["w2"] + self.p["b2"]
        return out

    def gradients(self, chunks: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean logistic loss."""
        p, n = self.p, len(chunks)
        windows, out = self.responses(chunks)
        top = out.argmax(axis=1)                                           # chunk, filter
        raw = np.take_along_axis(out, top[:, None], axis=1)[:, 0] + p["bias"]
        pooled = np.maximum(raw, 0)
        before = pooled @ p["w1"] + p["b1"]
        hidden = np.maximum(before, 0)
        logit = hidden @ p["w2"] + p["b2"]
        d = (weight * (1 / (1 + np.exp(-logit)) - target) / n).astype(np.float32)
        d_before = np.outer(d, p["w2"]) * (before > 0)
        d_raw = d_before @ p["w1"].T * (raw > 0)
        chosen = windows[np.arange(n)[:, None], top]                       # chunk, filter, inputs
        g = {"w2": hidden.T @ d, "b2": d.sum(), "w1": pooled.T @ d_before, "b1": d_before.sum(0),
             "bias": d_raw.sum(0), "filter": np.einsum("nf,nfi->if", d_raw, chosen), "vector": np.zeros_like(p["vector"])}
        d_inputs = d_raw[:, :, None] * p["filter"].T[None]                 # chunk, filter, inputs
        place = top[:, :, None] * STRIDE + np.arange(WIDTH)
        symbol = chunks[np.arange(n)[:, None, None], place]
        np.add.at(g["vector"], symbol.ravel(), d_inputs.reshape(-1, VECTOR))
        return g

    def fit(self, chunks: np.ndarray, target: np.ndarray, weight: np.ndarray, epochs: int = 4, rate: float = 3e-3,
            seed: int = 8) -> None:
        """Adam over shuffled batches, the rate falling to zero."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        total, t = epochs * -(-len(chunks) // BATCH), 0
        for _ in range(epochs):
            order = rng.permutation(len(chunks))
            for at in range(0, len(order), BATCH):
                mine = order[at:at + BATCH]
                t += 1
                for k, g in self.gradients(chunks[mine], target[mine], weight[mine]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    step = rate * (1 - (t - 1) / total) * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
                    self.p[k] = (self.p[k] - step).astype(np.float32)

    def scale(self, logit: np.ndarray, target: np.ndarray) -> None:
        """Fit slope and offset of the mean logits to the labels (Newton)."""
        x = np.stack([logit, np.ones_like(logit)], axis=1).astype(float)
        # smoothed targets keep the slope finite where classes are apart
        ones = target.sum()
        y = np.where(target > 0, (ones + 1) / (ones + 2), 1 / (len(target) - ones + 2))
        a = np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            a = a - np.linalg.solve(h, x.T @ (p - y) + 1e-3 * (a - [1, 0]))
        self.slope, self.offset = float(a[0]), float(a[1])

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.offset, -30, 30)))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """One probability a text, from all its chunks."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        starts = [chunk_starts(len(t)) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        total = np.zeros(len(texts))
        rows, count, done = [], 0, 0
        for i, (text, start) in enumerate(zip(texts, starts)):
            for at in range(0, len(start), 1024):
                rows.append(chunk_array(text, start[at:at + 1024]))
                count += len(rows[-1])
                if count >= 1024 or i + 1 == len(texts) and at + 1024 >= len(start):
                    logit = self.logits(np.concatenate(rows))
                    np.add.at(total, owner[done:done + count], logit)
                    rows, done, count = [], done + count, 0
        return self.probability(total / np.maximum(1, np.bincount(owner, minlength=len(texts))))


def training_chunks(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS,
                    most_bytes: int = TRAIN_BYTES) -> tuple[np.ndarray, ...]:
    """Chunks, their row and the label of each row, of a bounded sample."""
    known = labels.select(labels["doc_id"].alias("doc_id"), labels["quality"].cast("int").alias("quality")).where(
        F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    sample = known.withColumn("order", F.xxhash64(F.col("doc_id").cast("string"))).orderBy(
        "order", "doc_id", "quality").limit(rows)
    text = text_of(docs)
    table = docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"), F.octet_length(text).alias("size"),
                        F.xxhash64(text).alias("h")).join(F.broadcast(sample), "doc_id")
    keys = ["order", "quality", "h"]
    # at most ``rows`` rows of numbers, then as many texts as fit; repeated
    # rows of an id are one
    sizes = table.select(*keys, "size").distinct().orderBy(*keys).limit(rows).collect()
    room = np.searchsorted(np.cumsum([r["size"] for r in sizes]), most_bytes, side="right")
    chosen = docs.sparkSession.createDataFrame([tuple(r)[:3] for r in sizes[:int(room)]], "order bigint, quality int, h bigint")
    got = table.join(F.broadcast(chosen), keys).groupBy(*keys).agg(F.first("text").alias("text")).orderBy(*keys).collect()
    data = [r["text"].encode() for r in got]
    chunks = [chunk_array(text, chunk_starts(len(text))) for text in data]
    owner = np.repeat(np.arange(len(got)), [len(c) for c in chunks])
    return (np.concatenate(chunks) if chunks else np.zeros((0, CHUNK), np.int16), owner,
            np.array([r["quality"] for r in got], np.float32))


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> ByteCNN:
    """Fit on the driver: the sample is bounded by ``rows`` and bytes."""
    chunks, owner, quality = training_chunks(docs, labels, rows)
    model = ByteCNN()
    ones = quality.sum()
    if not len(quality) or ones in (0, len(quality)):
        model.constant = float(ones / len(quality)) if len(quality) else 0.5
        return model
    counts = np.bincount(owner)
    # both classes and all documents weigh alike
    share = np.where(quality > 0, len(quality) / (2 * ones), len(quality) / (2 * (len(quality) - ones)))
    weight = (share / counts)[owner]
    model.fit(chunks, quality[owner], (weight / weight.mean()).astype(np.float32), epochs)
    model.scale(np.bincount(owner, model.logits(chunks)) / counts, quality)
    return model


def score(docs: DataFrame, model: ByteCNN, column: str = "score") -> DataFrame:
    """``docs`` with its columns and the model's probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = [c for c in docs.columns if c != column]
    table = docs.select(own)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tokenizer()
        for batch in batches:
            for rows, texts in slices(batch):
                values = sent.value.scores([t.encode() for t in texts])
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(values, pa.float64())], [*own, column])

    schema = ", ".join(f"`{c}` {field_type(table, c)}" for c in own)
    return table.mapInArrow(apply, f"{schema}, `{column}` double")


def keep(docs: DataFrame, model: ByteCNN, least: float) -> DataFrame:
    """The rows of ``docs``, with their columns, that score ``least`` or more."""
    renamed, back = aside(docs, "text")
    return back(score(renamed, model).where(F.col("score") >= least))
