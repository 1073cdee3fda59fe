"""Licence statements found by a trained paragraph classifier (op 1), native.

Lines, and stretches of the size of a statement in the lines up to a blank
one, become hashed words and word pairs.  Softmax regression,
sparse because only the n-grams of known statements carry weights, gives each
family's probability beside an unknown class; its temperature is fitted on
rows kept from training.  What the classifier finds is confirmed by
comparison with the statements of its family: the share of the pairs of one
that the line or stretch has.

Stretches are where a statement could start: word pairs that a statement has,
too, vote for its first word, and ``VOTES`` of its pairs must agree.  So wrapped
statements are found, and statements inside long paragraphs.  Only confirmed
stretches count; of two that overlap by half, the one more alike.

The model is fitted on the driver from the stated templates, variants of them,
and the lines of the ``BACKGROUND`` documents with the lowest hash of their
text.  Scanning is one projection of array expressions: the weights are
literals, no user functions run.

Cases: a null or empty text has no paragraph and no licence; repeated rows are
scanned each; ties between families go to the first in order of name; null
doc_ids are kept; columns other than doc_id and text are ignored; an empty
table gives none, and the model has only its own unknown sentences then.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.llm.arrow import text_of
from propensa.llm.license_templates import OTHER, TEMPLATES

BUCKETS = 1 << 13
#: Different texts whose lines train the unknown class, different lines of them
#: at most, and the longest line (bytes) that is taken for this.
BACKGROUND, BACKGROUND_LINES, LINE_BYTES = 256, 4096, 1 << 14
#: Least probability of a family, and least share of a statement's pairs.
PROBABILITY, SIMILARITY = 0.5, 0.6
#: Least share of a statement's pairs that vote for one first word.
VOTES = 0.3
UNKNOWN = "unknown"
#: What stands for a blank line among the words.
BLANK = "\n"
WORD_GAPS = "[^a-z0-9À-￿]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_GAPS), "")


def grams(column: str) -> Column:
    """Hashes of the words and word pairs of an array of words."""
    return F.expr(_grams(column))


def _grams(column: str) -> str:
    return f"concat(transform({column}, v -> hash(v)), {_pairs(column)})"


def _pairs(column: str) -> str:
    """Hashes of neighbouring words; none for fewer than two words."""
    return (f"transform(slice({column}, 1, greatest(size({column}) - 1, 0)), (v, i) -> hash(v, get({column}, i + 1)))")


def variants(statement: str) -> list[str]:
    """A statement, and it without its first or last words."""
    parts = statement.split()
    cuts = [parts, parts[1:], parts[:-1], parts[2:], parts[:-2]]
    return list(dict.fromkeys(" ".join(p) for p in cuts if len(p) >= 3 or p is parts))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class LicenseModel:
    """Classes (the last is unknown), features, weights by feature and class."""

    def __init__(self, families: list[str], features: np.ndarray):
        self.families, self.features = families, features
        self.weights = np.zeros((len(features) + 1, len(families) + 1))
        self.temperature = 1.0

    def matrix(self, rows: list[list[int]]) -> np.ndarray:
        """Counts of the features, and a constant."""
        x = np.zeros((len(rows), len(self.features) + 1))
        x[:, -1] = 1
        place = {f: i for i, f in enumerate(self.features.tolist())}
        for i, row in enumerate(rows):
            for gram in row:
                k = place.get(gram % BUCKETS)
                if k is not None:
                    x[i, k] += 1
        return x

    def fit(self, rows: list[list[int]], target: np.ndarray, rounds: int = 400) -> None:
        """The temperature comes from a fifth of the rows, which a first model
        has not seen; the model itself from all of them."""
        x = self.matrix(rows)
        aside = np.arange(len(rows)) % 5 == 4
        if aside.any():
            self._descend(x[~aside], target[~aside], rounds)
            logit, truth = x[aside] @ self.weights, target[aside]
            steps = np.geomspace(0.25, 4, 33)
            loss = [-np.log(softmax(logit / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in steps]
            self.temperature = float(steps[int(np.argmin(loss))])
        self._descend(x, target, rounds)

    def _descend(self, x: np.ndarray, target: np.ndarray, rounds: int, rate: float = 0.5, penalty: float = 1e-4) -> None:
        """Gradient steps on the mean loss, from zero; classes weigh alike."""
        self.weights[:] = 0
        norm = np.maximum(1, np.sqrt((x ** 2).sum(axis=1)))
        y = np.eye(self.weights.shape[1])[target]
        share = y.sum(axis=0)
        weight = (y / np.maximum(1, share)).sum(axis=1)[:, None]
        weight /= weight.sum()
        scaled = x / norm[:, None]
        for _ in range(rounds):
            error = weight * (softmax(x @ self.weights) - y)
            self.weights -= rate * (len(y) ** 0.5) * (scaled.T @ error + penalty * self.weights)


def _stated(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """family and line of stated rows."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("line"))
                                                    for f, t in rows])))


def fit_licenses(docs: DataFrame, background: int = BACKGROUND) -> LicenseModel:
    """Train from the templates and a bounded sample of ``docs``' lines."""
    spark = docs.sparkSession
    families = sorted(TEMPLATES)
    stated = [(f, v) for f in families for t in TEMPLATES[f] for v in variants(t)] + [(UNKNOWN, t) for t in OTHER]
    text = text_of(docs)
    # hashes first: copies are one, and no text is sorted
    lowest = docs.select(F.xxhash64(text).alias("h")).distinct().orderBy("h").limit(background)
    sample = docs.select(text.alias("text"), F.xxhash64(text).alias("h")).join(F.broadcast(lowest), "h")
    lines = sample.select(F.explode(F.split("text", "\n")).alias("line")).where(
        F.octet_length("line") <= LINE_BYTES).distinct().orderBy(F.xxhash64("line"), "line").limit(BACKGROUND_LINES)
    given = _stated(spark, stated)
    hashed = given.unionByName(lines.select(F.lit("").alias("family"), "line")).withColumn("w", words(F.col("line"))).select(
        "family", grams("w").alias("grams")).collect()
    known = [r for r in hashed if r["family"]]
    features = np.unique([g % BUCKETS for r in known if r["family"] != UNKNOWN for g in r["grams"]])
    model = LicenseModel(families, features)
    statements = [set(r["grams"]) for r in known if r["family"] != UNKNOWN and len(r["grams"]) >= 3]
    rows = [(families.index(r["family"]) if r["family"] != UNKNOWN else len(families), r["grams"]) for r in known]
    # lines of the corpus that are statements themselves say nothing of the rest
    rows += [(len(families), r["grams"]) for r in hashed if not r["family"] and r["grams"]
             and not any(len(s & set(r["grams"])) > SIMILARITY * len(s) for s in statements)]
    model.fit([g for _, g in rows], np.array([k for k, _ in rows]))
    return model


def _literal(values: list) -> str:
    return "array(" + ", ".join(f"{v:.9g}D" for v in values) + ")"


def _templates(docs: DataFrame, families: list[str]) -> list[list[list[int]]]:
    """Pair hashes of each statement of each family (fixed, small)."""
    given = [(f, t) for f in families for t in TEMPLATES[f]]
    rows = _stated(docs.sparkSession, given).withColumn(
        "w", words(F.col("line"))).select("family", F.expr(_pairs("w")).alias("pairs")).collect()
    return [[sorted(set(r["pairs"])) for r in rows if r["family"] == f and r["pairs"]] for f in families]


def _stretches(docs: DataFrame) -> str:
    """Stretches of the words ``words`` (with the lines ``at`` that they are in)
    that could be statements: paragraph and last (lines), low, high, w."""
    stated = _stated(docs.sparkSession, [(f, t) for f in sorted(TEMPLATES) for t in TEMPLATES[f]]).withColumn(
        "w", words(F.col("line"))).select(F.size("w").alias("n"), F.expr(_pairs("w")).alias("pairs")).collect()
    places: dict[int, list[int]] = {}
    for k, row in enumerate(stated):
        for offset, pair in enumerate(row["pairs"]):
            places.setdefault(pair % BUCKETS, []).append((k << 40) - offset + (1 << 20))
    number = np.zeros(BUCKETS, np.int64)
    number[list(places)] = np.arange(1, len(places) + 1)
    numbers = "array(" + ", ".join(map(str, number)) + ")"
    lists = "array(array(0L), " + ", ".join("array(" + ", ".join(f"{c}L" for c in v) + ")" for v in places.values()) + ")"
    needs = "array(" + ", ".join(str(max(2, -int(-VOTES * len(r["pairs"]) // 1))) for r in stated) + ")"
    sizes = "array(" + ", ".join(str(r["n"]) for r in stated) + ")"
    hits = (f"filter(transform({_pairs('words')}, (h, i) -> named_struct('n', get({numbers}, pmod(h, {BUCKETS})), 'i', i)), "
            "x -> x.n > 0)")
    # votes: statement * 2^40 + 2^20 + place of its first word
    votes = f"array_sort(flatten(transform({hits}, x -> transform(get({lists}, x.n), c -> c + x.i))))"
    starts = (f"transform(array({votes}), v -> filter(v, (k, i) -> get(v, cast(i + get({needs}, cast(shiftright(k, 40) as int)) - 1 as int)) = k "
              "and coalesce(get(v, i - 1), -1L) != k))[0]")
    placed = (f"transform({starts}, k -> named_struct('low', cast((k & {(1 << 40) - 1}L) - {1 << 20} as int), "
              f"'n', get({sizes}, cast(shiftright(k, 40) as int))))")
    cut = (f"transform({placed}, x -> named_struct('low', greatest(x.low, 0), 'n', x.n + least(x.low, 0), 'w', "
           "slice(words, greatest(x.low, 0) + 1, x.n + least(x.low, 0) + x.n div 8)))")
    # a stretch ends at a blank line, or starts behind it
    ended = (f"transform({cut}, x -> transform(array(cast(array_position(x.w, '{BLANK}') as int)), b -> case when b = 0 then x "
             "when 2 * b <= x.n then named_struct('low', x.low + b, 'n', x.n - b, 'w', slice(x.w, b + 1, size(x.w))) "
             "else named_struct('low', x.low, 'n', least(x.n, b - 1), 'w', slice(x.w, 1, b - 1)) end)[0])")
    return (f"transform(filter({ended}, x -> size(x.w) > 1), x -> named_struct('paragraph', get(at, x.low), 'last', "
            "get(at, least(x.low + x.n, size(at)) - 1), 'low', x.low, 'high', x.low + x.n, 'w', x.w))")


def scan(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """Per document: doc_id, n_paragraphs (lines that are not blank), licences
    (paragraph: the line it starts in, family, probability, similarity,
    confirmed) of each line that the classifier takes for one and each stretch
    that is confirmed, the family of the likeliest confirmed one (else
    unknown), and probability, similarity and confirmed of the likeliest."""
    families = model.families
    known = np.zeros(BUCKETS, np.int64)
    known[model.features] = np.arange(1, len(model.features) + 1)
    numbers = "array(" + ", ".join(map(str, known)) + ")"
    weights = np.vstack([np.zeros(len(families) + 1), model.weights[:-1] / model.temperature])
    constant = model.weights[-1] / model.temperature
    table = docs.select(docs["doc_id"].alias("doc_id"), F.transform(F.split(text_of(docs), "\n"), lambda line, i: F.struct(
        i.alias("paragraph"), (F.trim(line) != "").alias("solid"), F.when(
            F.translate(line, " \t\r", "") == "", F.array(F.lit(BLANK))).otherwise(words(line)).alias("w"))).alias("lines"))
    table = table.select("doc_id", "lines", F.expr("size(filter(lines, x -> x.solid))").alias("n_paragraphs"), F.expr(
        "flatten(transform(lines, x -> x.w))").alias("words"), F.expr(
        "flatten(transform(lines, x -> array_repeat(x.paragraph, size(x.w))))").alias("at"))
    # lines and stretches (low is null for lines), then the features among their
    # n-grams; those with none are unknown
    split = table.select("doc_id", "n_paragraphs", F.expr(
        f"concat(transform(filter(lines, x -> x.w != array('{BLANK}')), x -> named_struct('paragraph', x.paragraph, 'last', "
        f"x.paragraph, 'low', cast(null as int), 'high', cast(null as int), 'w', x.w)), {_stretches(docs)})").alias("p"))
    where = "'paragraph', x.paragraph, 'last', x.last, 'low', x.low, 'high', x.high"
    hashed = split.withColumn("p", F.expr(
        f"transform(p, x -> named_struct({where}, 'w', x.w, 'at', filter(transform("
        f"{_grams('x.w')}, h -> get({numbers}, pmod(h, {BUCKETS}))), n -> n > 0)))"))
    hashed = hashed.withColumn("p", F.expr("filter(p, x -> size(x.at) > 0)"))
    sums = ", ".join(f"{constant[k]:.9g}D + aggregate(x.at, 0D, (s, n) -> s + get({_literal(weights[:, k].tolist())}, n))"
                     for k in range(len(families) + 1))
    scored = hashed.withColumn("p", F.expr(
        f"transform(p, x -> named_struct({where}, 'w', x.w, 'z', array({sums})))"))
    scored = scored.withColumn("p", F.expr(
        f"transform(p, x -> named_struct({where}, 'w', x.w, 'z', x.z, 'top', array_max(x.z)))"))
    scored = scored.withColumn("p", F.expr(
        f"transform(p, x -> named_struct({where}, 'w', x.w, 'k', array_position(x.z, x.top) - 1, "
        "'probability', 1 / aggregate(x.z, 0D, (s, z) -> s + exp(z - x.top))))"))
    scored = scored.withColumn("p", F.expr(f"filter(p, x -> x.k < {len(families)} and x.probability >= {PROBABILITY}D)"))
    cases = []
    for k, statements in enumerate(_templates(docs, families)):
        each = ", ".join(f"size(array_intersect(x.pairs, array({', '.join(map(str, s))}))) / {len(s)}D" for s in statements)
        cases.append(f"when {k} then array_max(array({each}))")
    compared = scored.withColumn("p", F.expr(
        f"transform(p, x -> named_struct({where}, 'k', x.k, 'probability', x.probability, 'pairs', {_pairs('x.w')}))"))
    names = "array(" + ", ".join(f"'{f}'" for f in families) + ")"
    compared = compared.withColumn("p", F.expr(
        f"transform(p, x -> named_struct({where}, 'family', get({names}, cast(x.k as int)), 'probability', "
        f"x.probability, 'similarity', case x.k {' '.join(cases)} end))"))
    # of stretches, in order, those that are confirmed and the best of what overlaps
    found = compared.withColumn("s", F.expr(
        f"array_sort(transform(filter(p, x -> x.low is not null and x.similarity >= {SIMILARITY}D), x -> named_struct('low', x.low, "
        "'high', x.high, 'similarity', x.similarity, 'probability', x.probability, 'x', x)))"))
    found = found.withColumn("s", F.expr(
        "aggregate(s, slice(s, 1, 0), (found, x) -> case when size(found) = 0 or 2 * (found[size(found) - 1].high - x.low) <= "
        "least(x.high - x.low, found[size(found) - 1].high - found[size(found) - 1].low) then concat(found, array(x)) "
        "when x.similarity > found[size(found) - 1].similarity or x.similarity = found[size(found) - 1].similarity and "
        "x.probability > found[size(found) - 1].probability then concat(slice(found, 1, size(found) - 1), array(x)) "
        "else found end)"))
    # one entry for what a line and a stretch both find
    found = found.withColumn("l", F.expr(
        f"filter(p, x -> x.low is null and (x.similarity >= {SIMILARITY}D or not exists(s, y -> x.paragraph between "
        "y.x.paragraph and y.x.last)))"))
    found = found.withColumn("s", F.expr(
        f"transform(filter(s, y -> not exists(l, x -> x.similarity >= {SIMILARITY}D and x.family = y.x.family and x.paragraph "
        "between y.x.paragraph and y.x.last)), y -> y.x)"))
    found = found.withColumn("licenses", F.expr(
        "array_sort(transform(concat(l, s), x -> named_struct('paragraph', x.paragraph, 'family', x.family, 'probability', "
        f"x.probability, 'similarity', x.similarity, 'confirmed', x.similarity >= {SIMILARITY}D)))"))
    # the likeliest: confirmed ones first, then by probability, then the earliest
    best = F.expr("array_max(transform(licenses, x -> named_struct('c', x.confirmed, 'p', x.probability, 'i', -x.paragraph, "
                  "'x', x)))['x']")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", "n_paragraphs", "licenses", F.when(F.col("best.confirmed"), F.col("best.family")).otherwise(
            F.lit(UNKNOWN)).alias("family"),
        F.col("best.probability").alias("probability"), F.col("best.similarity").alias("similarity"),
        F.coalesce("best.confirmed", F.lit(False)).alias("confirmed"))
