"""Nearest neighbours of vectors: learned cells, probing, exact distances.

``build_index`` fits coarse cells (k-means) on a bounded sample of the vectors
and deals *all* vectors to their nearest cell.  ``nearest`` looks for each
query in the cells whose centres are closest to it and ranks what it finds by
exact distances; with ``exact=True`` it then also looks into every other cell
that could hold something closer, by the triangle inequality, so the result is
that of comparing all pairs.

A cell's vectors are compared with its queries in blocks of at most
``BLOCK_ITEMS`` by ``BLOCK_QUERIES``, so a hot cell (a third of all vectors, or
of all queries) is spread over tasks; each block gives the best ``k`` of each
query, and Spark ranks these.

Vectors that are null, of another length than most of the sample, or hold
nulls, NaN or infinities are not indexed, nor are rows without an id; such
queries have no neighbours.  Ties go to the lower id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa.session import written

#: Vectors that cells are fitted on, at most, and cells at most.
SAMPLE, MOST_CELLS = 20_000, 2048
#: Cells looked into for each query.
PROBES = 8
BLOCK_ITEMS, BLOCK_QUERIES = 20_000, 5_000
#: Pairs of a block held at once.
PAIRS = 1 << 21


@dataclass
class VectorIndex:
    """Cells and their members (a written table: cell, id, vector, row)."""

    members: DataFrame
    centres: np.ndarray        # cells x dimension
    radius: np.ndarray         # greatest distance of a member to its centre
    size: np.ndarray           # members of each cell
    scaled: bool               # vectors have length 1 (cosine)

    @property
    def dimension(self) -> int:
        return self.centres.shape[1]


def _matrix(vectors: pa.Array, dimension: int | None, scaled: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold usable vectors, and those as a matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.nan_to_num(np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), float), nan=-1).astype(np.int64)
    if dimension is None:
        dimension = int(Counter(lengths[lengths > 0].tolist()).most_common(1)[0][0]) if (lengths > 0).any() else 0
    rows = np.flatnonzero((lengths == dimension) & (lengths > 0))
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    matrix = np.asarray(flat, np.float64).reshape(len(rows), dimension)
    good = np.isfinite(matrix).all(axis=1)
    rows, matrix = rows[good], matrix[good]
    if scaled:
        length = np.sqrt((matrix * matrix).sum(axis=1))
        rows, matrix = rows[length > 0], matrix[length > 0] / length[length > 0, None]
    return rows, matrix


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, up to rounding."""
    return np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T)


def kmeans(sample: np.ndarray, cells: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from centres that are spread over the sample; a cell
    that loses all its vectors takes the vector farthest from its centre."""
    rng = np.random.default_rng(seed)
    sample = np.unique(sample, axis=0)
    cells = min(cells, len(sample))
    first = [int(rng.integers(len(sample)))]
    near = squared(sample, sample[first])[:, 0]
    while len(first) < cells:
        share = near / near.sum() if near.sum() > 0 else None
        first.append(int(rng.choice(len(sample), p=share)))
        near = np.minimum(near, squared(sample, sample[first[-1:]])[:, 0])
    centres = sample[first]
    for _ in range(rounds):
        distance = squared(sample, centres)
        cell = distance.argmin(axis=1)
        count = np.bincount(cell, minlength=cells)
        total = np.zeros_like(centres)
        np.add.at(total, cell, sample)
        far = iter(np.argsort(-distance[np.arange(len(sample)), cell], kind="stable"))
        centres = np.stack([total[c] / count[c] if count[c] else sample[next(far)] for c in range(cells)])
    return centres


def _sample(items: DataFrame, vector: str, most: int) -> list:
    """At most ``most`` different vectors, those of the lowest hashes."""
    hashed = items.select(F.col(vector).alias("vector")).where(F.size("vector") > 0).withColumn("h", F.xxhash64("vector"))
    n = hashed.count()
    if n > 2 * most:      # about 1.5 x most rows come any further
        hashed = hashed.where(F.pmod("h", F.lit(1 << 31)) < int((1 << 31) * min(1.0, 1.5 * most / n)))
    return hashed.dropDuplicates(["h"]).orderBy("h").limit(most).select("vector").toArrow().column("vector")


def build_index(items: DataFrame, key: str = "vec_id", vector: str = "embedding", cells: int | None = None,
                sample: int = SAMPLE, metric: str = "l2") -> VectorIndex:
    """Index all ``items``.  ``cells``: by default the square root of their
    number, at most ``MOST_CELLS``.  ``metric``: l2 or cosine."""
    if metric not in ("l2", "cosine"):
        raise ValueError(f"metric must be l2 or cosine, not {metric!r}")
    scaled = metric == "cosine"
    found = _matrix(_sample(items, vector, sample), None, scaled)[1]
    if cells is None:
        cells = min(MOST_CELLS, max(1, round(float(np.sqrt(items.count())))))
    centres = kmeans(found, cells) if len(found) else np.zeros((0, max(1, found.shape[1])))
    key_type = items.schema[key].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rows, matrix = _matrix(part.column("vector"), centres.shape[1], scaled)
                if not len(rows) or not len(centres):
                    continue
                distance = squared(matrix, centres)
                cell = distance.argmin(axis=1)
                reach = np.sqrt(((matrix - centres[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), part.column("id").take(pa.array(rows)),
                     pa.array([m.tobytes() for m in matrix], pa.binary()), pa.array(reach)],
                    ["cell", "id", "vector", "reach"])

    dealt = items.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("vector")).mapInArrow(
        assign, f"cell int, id {key_type}, vector binary, reach double")
    members = written(dealt.withColumn("row", F.monotonically_increasing_id()), "cells")
    size, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    # at most MOST_CELLS rows
    for r in members.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("reach")).collect():
        size[r["cell"]], radius[r["cell"]] = r["n"], r["reach"]
    return VectorIndex(members, centres, radius, size, scaled)


def _best(table: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query number."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy("distance", "id", "row"))
    return table.withColumn("rank", rank).where(F.col("rank") <= k)


def _compare(index: VectorIndex, probes: DataFrame, k: int, others: bool) -> DataFrame:
    """q, id, row, distance: the best ``k`` of each block.  ``probes``: q, own
    (the query's id), vector, cell.  ``others``: not the rows of that id."""
    wanted = {r["cell"]: r["n"] for r in probes.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    chunks = {c: -(-n // BLOCK_QUERIES) for c, n in wanted.items()}
    slices = {c: max(1, -(-int(index.size[c]) // BLOCK_ITEMS)) for c in wanted}

    def of_cell(numbers: dict[int, int]) -> Column:
        # one entry a cell, at most MOST_CELLS
        flat = [F.lit(x) for pair in sorted(numbers.items()) for x in pair]
        return F.create_map(*flat)[F.col("cell")] if flat else F.lit(1)

    def every(numbers: dict[int, int], name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), of_cell(numbers) - 1)).alias(name)

    queries = probes.withColumn("chunk", F.pmod(F.col("q"), of_cell(chunks)).cast("int")).select(
        "cell", "chunk", "q", "own", F.col("vector").alias("v"), every(slices, "slice"))
    items = index.members.where(F.col("cell").isin(sorted(wanted))).withColumn(
        "slice", F.pmod(F.col("row"), of_cell(slices)).cast("int")).select(
        "cell", "slice", "id", "row", "vector", every(chunks, "chunk"))
    kind = index.members.schema["id"].dataType.simpleString()

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        types = right.schema.field("id").type
        done: list[pa.Table] = [pa.table({"q": pa.array([], pa.int64()), "id": pa.array([], types),
                                          "row": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})]
        if left.num_rows and right.num_rows:
            a = np.frombuffer(b"".join(left.column("v").to_pylist())).reshape(left.num_rows, -1)
            b = np.frombuffer(b"".join(right.column("vector").to_pylist())).reshape(right.num_rows, -1)
            q, own = left.column("q").to_numpy(), left.column("own").to_pylist()
            ids, row = right.column("id").to_pylist(), right.column("row").to_numpy()
            _, code = np.unique(np.array(ids), return_inverse=True)     # order of ids
            step = max(1, PAIRS // len(b))
            for at in range(0, len(a), step):
                who, what, distance = nearest_pairs(a[at:at + step], b, k, [
                    [] if not others else own[i] for i in range(at, min(len(a), at + step))], ids, code, row)
                done.append(pa.table({"q": pa.array(q[who + at], pa.int64()), "id": right.column("id").take(pa.array(what)),
                                      "row": pa.array(row[what], pa.int64()), "distance": pa.array(distance)}))
        return pa.concat_tables(done)

    keys = ["cell", "slice", "chunk"]
    return queries.groupBy(*keys).cogroup(items.groupBy(*keys)).applyInArrow(
        block, f"q bigint, id {kind}, row bigint, distance double")


def nearest_pairs(a: np.ndarray, b: np.ndarray, k: int, own: list, ids: list, code: np.ndarray,
                  row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, item and distance of the ``k`` nearest items of each query.  A
    matrix product picks those that may be, their distances are then taken
    coordinate by coordinate, so equal vectors are equally far."""
    rough = squared(a, b)
    by_id: dict = {}
    for i, x in enumerate(ids):
        by_id.setdefault(x, []).append(i)
    for i, x in enumerate(own):
        if not isinstance(x, list):
            rough[i, by_id.get(x, [])] = np.inf
    kth = np.partition(rough, min(k, len(b)) - 1, axis=1)[:, min(k, len(b)) - 1]
    scale = (a * a).sum(1) + float((b * b).sum(1).max())
    who, what = np.nonzero((rough <= (kth + 1e-9 * scale)[:, None]) & np.isfinite(rough))
    distance = np.empty(len(who))
    for at in range(0, len(who), 1 << 16):
        part = slice(at, at + (1 << 16))
        distance[part] = np.sqrt(((a[who[part]] - b[what[part]]) ** 2).sum(axis=1))
    order = np.lexsort((row[what], code[what], distance, who))
    who, what, distance = who[order], what[order], distance[order]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    return who[place < k], what[place < k], distance[place < k]


def nearest(queries: DataFrame, index: VectorIndex, k: int = 10, key: str = "vec_id", vector: str = "embedding",
            probes: int = PROBES, exact: bool = False, others: bool = True) -> DataFrame:
    """query_id, rank (1 to ``k``), id and distance of the nearest indexed
    vectors of each row of ``queries``.  ``others``: a query does not find
    rows of its own id.  Cosine distances are those of vectors of length 1."""
    centres, radius, size, scaled = index.centres, index.radius, index.size, index.scaled
    kind = queries.schema[key].dataType.simpleString()
    asked = written(queries.select(F.col(key).alias("own"), F.col(vector).alias("vector"),
                                   F.monotonically_increasing_id().alias("q")), "queries")
    schema = f"q bigint, own {kind}, vector binary, cell int"

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cells to look into; with a limit: those that may hold something
        as close and are not among the first."""
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rows, matrix = _matrix(part.column("vector"), centres.shape[1], scaled)
                if not len(rows) or not len(centres):
                    continue
                distance = np.sqrt(squared(matrix, centres))
                order = np.argsort(distance, axis=1, kind="stable")
                first = np.zeros(distance.shape, bool)
                np.put_along_axis(first, order[:, :probes], True, axis=1)
                if "limit" in part.schema.names:
                    limit = part.column("limit").to_numpy(zero_copy_only=False)[rows]
                    # a margin for the rounding of both sides
                    first = ~first & (distance - radius <= limit[:, None] * (1 + 1e-9) + 1e-6)
                who, cell = np.nonzero(first & (size > 0))
                which = pa.array(rows[who])
                yield pa.RecordBatch.from_arrays(
                    [part.column("q").take(which), part.column("own").take(which),
                     pa.array([matrix[i].tobytes() for i in who], pa.binary()), pa.array(cell, pa.int32())],
                    ["q", "own", "vector", "cell"])

    bare = asked.select("q", "own", "vector")
    found = _best(_compare(index, written(bare.mapInArrow(probe, schema), "probes"), k, others), k)
    if exact:
        found = written(found, "found")
        limit = found.where(F.col("rank") == k).select("q", F.col("distance").alias("limit"))
        second = bare.join(limit, "q", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
        more = _compare(index, written(second.mapInArrow(probe, schema), "probes"), k, others)
        found = _best(found.drop("rank").unionByName(more), k)
    return found.join(asked.select("q", "own"), "q").select(
        F.col("own").alias("query_id"), "rank", "id", "distance")


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """query_id, wanted, found: of each query's exact neighbours, how many the
    other result has."""
    both = exact.select("query_id", "id", F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        approximate.select("query_id", "id", F.lit(0).alias("e"), F.lit(1).alias("a")))
    pairs = both.groupBy("query_id", "id").agg(F.max("e").alias("e"), F.max("a").alias("a"))
    return pairs.groupBy("query_id").agg(F.sum("e").alias("wanted"), F.sum(F.col("e") * F.col("a")).alias("found"))
