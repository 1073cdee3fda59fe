"""Near duplicates, the byte network and the pipeline."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from propensa.llm import byte_cnn, near_dedup
from tests.llm.data import EDGES, ascii_words, prose, table


def shingle_set(text):
    words = ascii_words(text)
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def edited(text, seed, share):
    rng = random.Random(seed)
    words = text.split()
    for i in rng.sample(range(len(words)), int(share * len(words))):
        words[i] = f"w{seed}x{i}"
    return " ".join(words)


def groups():
    """A few groups of near copies, at and around the threshold."""
    rows = list(EDGES)
    for g in range(3):
        base = prose(200 + g, 150 + 400 * g)
        rows += [(1000 + 100 * g + k, edited(base, 10 * g + k, 0.004 * (k % 6))) for k in range(14)]
    return rows


def plain_classes(rows, weights, threshold):
    """Lowest doc_id connected by weighted Jaccard similarity, by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    codes = [near_dedup.shingles([(t or "").encode()])[0] for _, t in rows]
    assert [len(s) for s in sets] == [len(c) for c, _ in codes]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    weighted = [dict(zip(c.tolist(), weights(c, n).tolist())) for c, n in codes]
    for i in range(len(rows)):
        for j in range(i):
            a, b = weighted[i], weighted[j]
            if not a or not b:
                alike = (rows[i][1] or "") == (rows[j][1] or "")
            else:
                low = sum(min(a[k], b[k]) for k in a.keys() & b.keys())
                alike = low >= (threshold - 1e-5) * (sum(a.values()) + sum(b.values()) - low)
            if alike:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[root(i)] = min(lowest.get(root(i), doc), doc)
    return Counter((doc, lowest.get(root(i))) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 4000])
def test_classes(spark, block):
    from pyspark.sql import functions as F

    rows = groups()
    docs = table(spark, rows)
    weights = near_dedup.document_frequencies(docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("data")))
    got = near_dedup.near_duplicates(docs, block=block).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == plain_classes(rows, weights, 0.8)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_one_row_of_each_class(spark):
    rows = groups()
    docs = table(spark, rows)
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert left.count(5) == 1 and 6 not in left and 1000 in left and 1001 not in left
    assert near_dedup.near_duplicates(table(spark, [])).collect() == []


def test_samples_agree_as_similar():
    rng = np.random.default_rng(5)
    shingle = np.sort(rng.integers(0, 2 ** 63, 1000, dtype=np.uint64))
    weight = (1 + rng.random(1000)).astype(np.float32)
    seeds = near_dedup._mix(np.arange(1, 3001, dtype=np.uint64))
    a = near_dedup.samples(shingle[:800], weight[:800], seeds)
    b = near_dedup.samples(shingle[100:], weight[100:], seeds)
    similarity = weight[100:800].sum() / weight.sum()
    assert abs((a == b).mean() - similarity) < 4 * math.sqrt(0.25 / 3000)


@pytest.mark.parametrize("n", [100, 250, 260, 500, 1100, 9000])
def test_long_and_short_texts_share_bands(n):
    """Similarity 0.9 is found on either side of the length classes."""
    weights = near_dedup.Weights(np.ones(near_dedup.COUNTERS, np.int64), 100)
    found = 0
    for seed in range(8):
        base = prose(300 + seed, n)
        (a, x), (b, y) = near_dedup.shingles([base.encode(), edited(base, seed, 0.01).encode()])
        found += bool(set(near_dedup.band_hashes(a, weights(a, x)).tolist())
                      & set(near_dedup.band_hashes(b, weights(b, y)).tolist()))
    assert found == 8


def labelled(spark, n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text = prose(5000 + i, rng.randint(20, 120))
        good = rng.random() < 0.7
        rows.append((i, text if good else text.replace(" ", "### ")))
        labels.append((i, int(good)))
    labels += [(None, 1), (3, None), (999999, 0), (5, 7)]
    return table(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_quality_network(spark):
    docs, labels = labelled(spark)
    model = byte_cnn.fit_quality(docs, labels, epochs=8)
    scored = {r["doc_id"]: r["score"] for r in byte_cnn.score(docs, model).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [i for i in scored if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scored[i] >= 0.3) == (truth[i] == 1) for i in held) >= 0.9 * len(held)
    edge = table(spark, EDGES)
    got = byte_cnn.score(edge, model)
    assert got.count() == len(EDGES) and got.columns.count("score") == 1
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert byte_cnn.keep(edge, model, 0.0).columns == edge.columns
    assert byte_cnn.score(table(spark, []), model).collect() == []


def test_network_without_classes(spark):
    docs, labels = labelled(spark, 20)
    assert byte_cnn.fit_quality(docs, labels.limit(0)).scores([b"x"]).tolist() == [0.5]
    assert byte_cnn.fit_quality(docs, labels.where("quality = 1")).scores([b"x"]).tolist() == [1.0]


def test_chunks_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 496, 497, 5000):
        covered = set()
        for at in byte_cnn.chunk_starts(n):
            covered |= set(range(at, min(n, at + byte_cnn.CHUNK)))
        assert covered == set(range(n)) and len(byte_cnn.chunk_starts(n)) >= 1


def test_gradients_by_differences():
    model = byte_cnn.ByteCNN(3)
    rng = np.random.default_rng(2)
    chunks = rng.integers(0, 257, (4, byte_cnn.CHUNK)).astype(np.int16)
    target, weight = np.array([0, 1, 1, 0], np.float32), np.ones(4, np.float32)

    def loss():
        z = model.logits(chunks).astype(float)
        return float(np.mean(np.log1p(np.exp(-np.where(target > 0, z, -z)))))

    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    gradients = model.gradients(chunks, target, weight)
    for name in ("w2", "w1", "filter", "bias"):
        at = tuple(rng.integers(0, s) for s in model.p[name].shape)
        before = model.p[name][at]
        ends = []
        for step in (1e-3, -1e-3):
            model.p[name][at] = before + step
            ends.append(loss())
        model.p[name][at] = before
        assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(float(gradients[name][at]), abs=2e-3)


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = corpus_pipeline.written(stage(spark, kept, sf), name)
        assert kept.columns == columns and 0 < kept.count() <= before
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == {r["doc_id"] for r in kept.collect()}
    assert corpus_pipeline.run(spark, sf).count() == pieces.count()
