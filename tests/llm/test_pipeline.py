"""The corpus pipeline, stage by stage, against the plain rules."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from propensa.llm import byte_cnn, near_dedup, repeats
from propensa.session import shared_dir
from tests.llm import test_models, test_repeats, test_texts, test_tokens
from tests.llm.data import EDGES, prose


def plain_logit(model, data):
    """Mean logit of a text, by loops over chunks, filters and places."""
    p, n = {k: v.astype(float) for k, v in model.p.items()}, len(data)
    logits = []
    for start in range(0, max(1, n - byte_cnn.OVERLAP), byte_cnn.CHUNK - byte_cnn.OVERLAP):
        part = [b + 1 for b in data[start:start + byte_cnn.CHUNK]]
        symbols = part + [0] * (byte_cnn.CHUNK - len(part))
        inputs = np.concatenate([p["vector"][s] for s in symbols])
        pooled = []
        for f in range(byte_cnn.FILTERS):
            best = max(float(inputs[at * byte_cnn.VECTOR:(at + byte_cnn.WIDTH) * byte_cnn.VECTOR] @ p["filter"][:, f])
                       for at in range(0, byte_cnn.CHUNK - byte_cnn.WIDTH + 1, byte_cnn.STRIDE))
            pooled.append(max(0.0, best + p["bias"][f]))
        hidden = np.maximum(0, np.array(pooled) @ p["w1"] + p["b1"])
        logits.append(float(hidden @ p["w2"] + p["b2"]))
    return sum(logits) / len(logits)


def test_scores_equal_looped_convolution():
    model = byte_cnn.ByteCNN(4)
    model.slope, model.offset = 1.5, -0.25
    texts = [b"", b"x", prose(1, 60).encode(), prose(2, 90).encode() * 2]
    plain = [1 / (1 + np.exp(-(1.5 * plain_logit(model, t) - 0.25))) for t in texts]
    assert model.scores(texts) == pytest.approx(plain, abs=1e-4)


def tables(spark, rows, labels, items):
    """A folder with documents (columns that operators use themselves added),
    labels and benchmark."""
    base = shared_dir(spark, "pipeline")
    full = [(i, t, "en", f"s{k}", None if t is None else len(t), f"c{k}", k, f"r{k}") for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string, "
                                "spans long, row string").repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def corpus():
    rng = random.Random(6)
    items = [(k, prose(700 + k, 40)) for k in range(4)] + [(None, prose(9, 3)), (8, None)]
    rows, labels = list(EDGES), []
    for k in range(60):
        text = prose(3000 + k, rng.randint(30, 120))
        good = k % 4 > 0
        rows.append((100 + k, text if good else text.replace(" ", "### ")))
        labels.append((100 + k, int(good), 0))
    shared = prose(77, 120)
    rows += [(300 + k, prose(800 + k, 40) + " " + shared + " " + prose(900 + k, 40)) for k in range(4)]
    rows += [(400 + k, test_models.edited(prose(55, 300), k, 0.004)) for k in range(6)]
    rows += [(500, prose(60, 30) + " " + items[0][1]), (501, items[1][1]), (502, prose(61, 2000) + " " + items[2][1][:120])]
    rows += [(102, rows[16][1])] * 2      # repeated rows
    return rows, labels + [(None, 1, 0), (9999, 0, 0)], items


def as_rows(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_each_stage_equals_its_plain_rule(spark):
    rows, labels, items = corpus()
    base = tables(spark, rows, labels, items)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        steps[name] = docs, (found := corpus_pipeline.written(stage(spark, docs, base), name))
        assert name == "packing" or found.columns == columns
        docs = found

    before, after = steps["quality"]
    model = byte_cnn.fit_quality(before, spark.read.parquet(f"{base}/labels.parquet"))
    texts = before.collect()
    score = model.scores([(r["text"] or "").encode() for r in texts])
    assert Counter(map(tuple, after.collect())) == Counter(
        tuple(r) for r, s in zip(texts, score) if s >= corpus_pipeline.QUALITY)

    before, after = steps["near_duplicates"]
    given = [(r["doc_id"], r["text"]) for r in before.collect()]
    weights = near_dedup.document_frequencies(before.select(F.coalesce("text", F.lit("")).cast("binary").alias("data")))
    classes = test_models.plain_classes(given, weights, near_dedup.THRESHOLD)
    # one row of each class; classes without an id are not named, and count by their texts
    named = {c for _, c in classes if c is not None}
    left = [r["doc_id"] for r in after.collect()]
    assert Counter(i for i in left if i is not None) == Counter(named)
    assert not as_rows(after) - as_rows(before)

    before, after = steps["repeats"]
    given = [(r["doc_id"], r["text"]) for r in before.collect()]
    plain = Counter()
    for (i, *_, text), n in test_repeats.plain(given, repeats.LENGTH).items():
        plain[i, text] += n
    assert as_rows(after) == plain
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = steps["decontamination"]
    given = [(r["doc_id"], r["text"]) for r in before.collect()]
    clean = Counter()
    for row in given:
        if not any(x[5] for x in test_texts.contamination([row], items, 13)):
            clean[row] += 1
    assert as_rows(after) == clean
    assert {500, 501}.isdisjoint(i for i, _ in clean) and 502 in {i for i, _ in clean}

    before, after = steps["packing"]
    pieces = after.collect()
    lengths = Counter()
    for r in before.collect():
        lengths[r["doc_id"], len(test_tokens.ids(test_tokens.WORD, r["text"])) + 1] += 1
    total = Counter()
    for r in pieces:
        total[r["doc_id"]] += r["length"]
    assert total == sum((Counter({i: n * k}) for (i, n), k in lengths.items()), Counter())
    assert test_tokens.packed_right(pieces, 2048) >= -(-sum(total.values()) // 2048)


def test_pipeline_of_an_empty_table(spark):
    base = tables(spark, [], [], [])
    assert corpus_pipeline.run(spark, base).collect() == []
