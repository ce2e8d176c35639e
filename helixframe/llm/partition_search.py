"""Nearest neighbours through learned partitions: a balanced graph cut and a routing network.

1. A sample of distinct vectors, at most ``SAMPLE_PER_PART`` per partition, gives a graph of
   each one's nearest ones, found by Spark tasks in blocks.
2. The graph is halved again and again along its smoothest eigenvector, every half of equal
   size, exchanges of pairs lowering the cut: balanced partitions that keep neighbours together.
3. A small network learns, from a vector, the partitions that its neighbours lie in.
4. It assigns every row of the table to its most probable partition: the index.
5. It routes each query to its most probable partitions, so many that held-out vectors find
   ``TARGET_RECALL`` of their neighbours in the sample, and on until enough rows are met.
   What lies in those partitions is scored exactly, in double precision, terms added in order
   of the components, and the nearest are kept: first in the most probable partition, whose
   last kept score then bounds what a row of the others must reach to be handed on at all.

Copies of one vector: the index holds the ``top + 1`` least ids of each distinct vector, since
no answer can name more, and equal queries are answered once. Partitions of any size are met
in blocks of rows and of queries, so no task holds more than one of each.

Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do
those whose length is not the most frequent one (of equally frequent ones the greatest). A null
id is a candidate, last among ties, and no query. Repeated rows are candidates each, and
queries each that leave out one row of their own; ties go to the smaller id. Tables of fewer
rows than ``top + 1`` give all there are; an empty table gives no rows. Columns besides id and
vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm.common import own_columns, written

TOP = 20
QUERY_EVERY = 20
PART_ROWS = 2000
MIN_PARTS, MAX_PARTS = 8, 1024
SAMPLE_PER_PART = 256
GRAPH_DEGREE = 10
HELD_OUT = 512
TARGET_RECALL = 0.95
HIDDEN, EPOCHS, BATCH = 128, 25, 256
GRAPH_ROWS = 512
CANDIDATE_ROWS, QUERY_ROWS, SCORED_AT_ONCE = 1 << 16, 1 << 14, 256


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _directions(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def usable_vectors(table: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """(``vec_id``, ``v``, ``h``) of rows that take part, and their dimension (0: none do)."""
    kind = table.schema[vector_column].dataType
    double = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vector = F.col(f"`{vector_column}`") if double else F.col(f"`{vector_column}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_column}`").alias("vec_id"), vector.alias("v"))
    infinite = F.lit(float("inf"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    sound = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    sizes = sound.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    dimension = first["size"] if first else 0
    return sound.where(F.size("v") == dimension).withColumn("h", F.xxhash64("v")), dimension


def draw_sample(vectors: DataFrame, dimension: int, rows: int, most: int) -> np.ndarray:
    """At most ``most`` distinct vectors, the least by hash; the draw is thinned before it is sorted."""
    share = min(1.0, 2.0 * most / max(rows, 1))
    mixed = F.pmod(F.xxhash64("h"), F.lit(1 << 30))
    drawn = vectors.where(mixed < int(share * (1 << 30))).groupBy("h").agg(F.first("v").alias("v"))
    table = drawn.orderBy(F.xxhash64("h"), "h").limit(most).select("v").toArrow()
    return _matrix(table.column("v").combine_chunks(), dimension) if table.num_rows else np.zeros((0, dimension))


def neighbour_graph(spark: SparkSession, directions: np.ndarray, degree: int = GRAPH_DEGREE) -> np.ndarray:
    """(n, degree): each sample vector's nearest ones by angle, in blocks over the cluster."""
    n = len(directions)
    shared = spark.sparkContext.broadcast(directions)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = shared.value
        for batch in batches:
            for start in batch.column("id").to_pylist():
                own = np.arange(start, min(start + GRAPH_ROWS, n))
                near = whole[own] @ whole.T
                near[np.arange(len(own)), own] = -np.inf
                best = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(list(best), pa.list_(pa.int64()))], names=["i", "near"])

    blocks = spark.range(0, n, GRAPH_ROWS, max(1, -(-n // GRAPH_ROWS)))
    found = blocks.mapInArrow(nearest, "i long, near array<long>").toArrow().sort_by("i")
    shared.unpersist()
    return found.column("near").combine_chunks().flatten().to_numpy().reshape(n, degree)


def _halved(near: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Two halves of a graph (rows of neighbours, -1 outside) as booleans, equal up to one."""
    n = len(near)
    inside = near >= 0
    source = np.repeat(np.arange(n), inside.sum(axis=1))
    target = near[inside]
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    degree = np.maximum(np.bincount(source, minlength=n), 1)
    x = random.standard_normal(n)
    for _ in range(60):
        x = (x + np.bincount(source, x[target], n) / degree) / 2
        x -= np.average(x, weights=degree)
        x /= np.abs(x).max() + 1e-12
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2 :]] = True
    best, best_cut = side.copy(), int((side[source] != side[target]).sum())
    for _ in range(12):
        across = np.bincount(source, side[source] != side[target], n)
        gain = 2 * across - np.bincount(source, minlength=n)
        left, right = (np.flatnonzero(side == s) for s in (False, True))
        left, right = (part[np.argsort(-gain[part], kind="stable")] for part in (left, right))
        pairs = min(len(left), len(right))
        better = int((gain[left[:pairs]] + gain[right[:pairs]] > 0).sum())
        if not better:
            break
        swapped = -(-better // 2)
        side[left[:swapped]], side[right[:swapped]] = True, False
        cut = int((side[source] != side[target]).sum())
        if cut < best_cut:
            best, best_cut = side.copy(), cut
    return best


def balanced_partitions(near: np.ndarray, parts: int, seed: int = 11) -> np.ndarray:
    """A part number for each node of the graph; ``parts`` is a power of two, sizes differ by little."""
    random = np.random.default_rng(seed)
    part = np.zeros(len(near), np.int64)
    for _ in range(parts.bit_length() - 1):
        split = np.zeros(len(near), np.int64)
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            local = np.full(len(near) + 1, -1)
            local[nodes] = np.arange(len(nodes))
            split[nodes] = _halved(local[near[nodes]], random)
        part = 2 * part + split
    return part


@dataclass(frozen=True)
class Router:
    """A network of one hidden layer from directions to logits of partitions."""

    layers: tuple[np.ndarray, ...]

    def logits(self, directions: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(directions @ w1 + b1, 0) @ w2 + b2

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Partitions from most to least probable."""
        return np.argsort(-self.logits(_directions(vectors)), axis=1, kind="stable")


def train_router(directions: np.ndarray, wanted: np.ndarray, seed: int = 13) -> Router:
    """Fits logits to ``wanted``, the share of each vector's neighbours per partition (Adam)."""
    random = np.random.default_rng(seed)
    n, d = directions.shape
    parts = wanted.shape[1]
    weights = [
        random.standard_normal((d, HIDDEN)).astype(np.float32) * np.float32((2 / d) ** 0.5) * np.float32(d**0.5 / 2),
        np.zeros(HIDDEN, np.float32),
        random.standard_normal((HIDDEN, parts)).astype(np.float32) * np.float32(HIDDEN**-0.5),
        np.zeros(parts, np.float32),
    ]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        rate = 4e-3 * (1 - epoch / EPOCHS) + 2e-4
        shuffled = random.permutation(n)
        for at in range(0, n, BATCH):
            rows = shuffled[at : at + BATCH]
            x = directions[rows]
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            logits = hidden @ weights[2] + weights[3]
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (odds / odds.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            slopes = [x.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                scaled = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                weights[k] = (weights[k] - rate * first[k] / (1 - 0.9**step) / scaled).astype(np.float32)
    return Router(tuple(weights))


def _probes(router: Router, kept: np.ndarray, held: np.ndarray, parts: int, top: int, target: float) -> int:
    """The fewest partitions per query in which held-out vectors find ``target`` of their nearest."""
    if not len(held) or not len(kept):
        return parts
    top = min(top, len(kept))
    near = np.argpartition(-(held @ kept.T), top - 1, axis=1)[:, :top]
    home = router.order(kept)[:, 0]
    place = np.argsort(router.order(held), axis=1)
    depth = np.take_along_axis(place, home[near], axis=1)
    found = np.cumsum(np.bincount(depth.ravel(), minlength=parts)) / depth.size
    return int(min(np.searchsorted(found, target) + 1, parts))


@dataclass(frozen=True)
class Model:
    router: Router
    parts: int
    probes: int


def fit(spark: SparkSession, sample: np.ndarray, parts: int, *, top: int = TOP, target: float = TARGET_RECALL) -> Model:
    """Graph, partitions and router of a sample, and the number of partitions to probe."""
    held = sample[: min(HELD_OUT, len(sample) // 8)]
    kept = sample[len(held) :]
    directions = _directions(kept) if len(kept) else np.zeros(kept.shape, np.float32)
    degree = min(GRAPH_DEGREE, len(kept) - 1)
    if degree < 1:
        shape = (max(kept.shape[1], 1), 1)
        zero = tuple(np.zeros(s, np.float32) for s in (shape, 1, (1, 1), 1))
        return Model(Router(zero), 1, 1)
    near = neighbour_graph(spark, directions, degree)
    part = balanced_partitions(near, parts)
    wanted = np.zeros((len(kept), parts), np.float32)
    for column in (np.arange(len(kept))[:, None], near):
        np.add.at(wanted, (np.arange(len(kept))[:, None], part[column]), 1)
    router = train_router(directions, wanted / (degree + 1))
    return Model(router, parts, _probes(router, kept, held, parts, top, target))


def _with_part(model, dimension: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best = model.value.router.order(_matrix(batch.column("v"), dimension))[:, 0]
                yield batch.append_column("part", pa.array(best.astype(np.int32)))

    return run


def build_index(vectors: DataFrame, model, dimension: int, top: int = TOP) -> DataFrame:
    """(``vec_id``, ``v``, ``h``, ``part``): per distinct vector the rows of its ``top + 1`` least ids."""
    copies = Window.partitionBy("h", "v").orderBy(F.col("vec_id").asc_nulls_last())
    rows = vectors.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= top + 1).drop("copy")
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType())])
    return written(rows.mapInArrow(_with_part(model, dimension), schema), "search-index")


def _routed(model, sizes: np.ndarray, dimension: int, enough: int):
    """Partitions to probe per query: the model's number, and on until ``enough`` rows are met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = model.value.router.order(_matrix(batch.column("v"), dimension))
            met = np.cumsum(sizes[order], axis=1)
            short = (met < enough).sum(axis=1) + 1
            counts = np.minimum(np.maximum(short, model.value.probes), order.shape[1])
            chosen = [row[:n] for row, n in zip(order.astype(np.int32), counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("qid"), batch.column("v"), pa.array(chosen, pa.list_(pa.int32()))], names=["qid", "v", "parts"]
            )

    return run


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, terms added one after the other."""
    total = np.zeros(len(queries))
    for k in range(queries.shape[1]):
        total += queries[:, k] * candidates[:, k]
    return total


def _ranked_block(dimension: int, top: int):
    """The ``top`` nearest rows of a block of candidates for each query of a block of queries,
    as far as they reach the query's ``least`` score."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[pa.Table] = []
        names = ["qid", "vec_id", "score", "same"]
        if left.num_rows and right.num_rows:
            left = left.sort_by([("vec_id", "ascending")])  # nulls come last
            rows = _matrix(left.column("v").combine_chunks(), dimension)
            queries = _matrix(right.column("v").combine_chunks(), dimension)
            least = right.column("least").to_numpy()[:, None]
            reach = np.abs(rows).sum(axis=1).max()
            qids, ids = right.column("qid").combine_chunks(), left.column("vec_id").combine_chunks()
            for at in range(0, len(queries), SCORED_AT_ONCE):
                some, bound = queries[at : at + SCORED_AT_ONCE], least[at : at + SCORED_AT_ONCE]
                rough = some @ rows.T
                wanted = bound
                if len(rows) > top:
                    wanted = np.maximum(bound, -np.partition(-rough, top - 1, axis=1)[:, top - 1 : top])
                # The matrix product rounds otherwise than the ordered sums, by less than this.
                slack = 1e-12 * reach * np.abs(some).max(axis=1, keepdims=True)
                q, c = np.nonzero(rough >= wanted - slack)
                exact = _scores(some[q], rows[c])
                order = np.lexsort((c, -exact, q))
                q, c, exact = q[order], c[order], exact[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                best = (rank < top) & (exact >= bound[q, 0])
                q, c, exact = q[best], c[best], exact[best]
                same = (some[q] == rows[c]).all(axis=1)
                found.append(pa.table([qids.take(pa.array(q + at)), ids.take(pa.array(c)), pa.array(exact), pa.array(same)], names=names))
        if found:
            return pa.concat_tables(found)
        return pa.table([pa.array([], pa.int64()), pa.array([], left.schema.field("vec_id").type), pa.array([], pa.float64()), pa.array([], pa.bool_())], names=names)

    return run


def _blocked(rows: DataFrame, own: str, other: str, own_blocks: Column, other_blocks: Column, key: Column) -> DataFrame:
    """Deals rows over the blocks of their part and copies them to the other side's blocks."""
    dealt = rows.withColumn(own, F.pmod(F.xxhash64(key), own_blocks).cast("int"))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), other_blocks - 1)))


def _by_part(counts: dict[int, int], most: int, parts: int) -> Column:
    blocks = [max(1, -(-counts.get(p, 0) // most)) for p in range(parts)]
    return F.get(F.array(*[F.lit(b) for b in blocks]), F.col("part"))


def _part_counts(rows: DataFrame) -> dict[int, int]:
    """Rows per partition: at most ``MAX_PARTS`` numbers come back."""
    return {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}


def _scored(index: DataFrame, sizes: dict[int, int], probing: DataFrame, parts: int, dimension: int, top: int) -> DataFrame:
    """(``qid``, ``vec_id``, ``score``, ``same``) of the nearest rows per query, partition and block."""
    row_blocks = _by_part(sizes, CANDIDATE_ROWS, parts)
    query_blocks = _by_part(_part_counts(probing), QUERY_ROWS, parts)
    left = _blocked(index.drop("h"), "row_block", "query_block", row_blocks, query_blocks, F.struct("vec_id", "v"))
    right = _blocked(probing, "query_block", "row_block", query_blocks, row_blocks, F.col("qid"))
    keys = ["part", "row_block", "query_block"]
    kind = index.schema["vec_id"].dataType.simpleString()
    schema = f"qid long, vec_id {kind}, score double, same boolean"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_ranked_block(dimension, top), schema)


def search(index: DataFrame, queries: DataFrame, model, dimension: int, top: int = TOP) -> DataFrame:
    """(``qid``, ``found``): per query (``qid``, ``v``) its ``top`` nearest index rows in order."""
    sizes = _part_counts(index)
    parts = model.value.parts
    rows_in = np.array([sizes.get(p, 0) for p in range(parts)])
    schema = T.StructType([T.StructField("qid", T.LongType()), queries.schema["v"], T.StructField("parts", T.ArrayType(T.IntegerType()))])
    routed = written(queries.select("qid", "v").mapInArrow(_routed(model, rows_in, dimension, top), schema), "search-routed")
    home = routed.select("qid", "v", F.get("parts", F.lit(0)).alias("part"), F.lit(float("-inf")).alias("least"))
    near = written(_scored(index, sizes, home, parts, dimension, top), "search-home")
    reached = near.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.array_min(F.slice(F.sort_array(F.collect_list("score"), False), 1, top)).alias("last"))
    bounds = reached.where(F.col("n") >= top).select("qid", "last")
    others = routed.join(bounds, "qid", "left").select(
        "qid", "v", F.explode(F.slice("parts", 2, parts)).alias("part"),
        F.coalesce("last", F.lit(float("-inf"))).alias("least"),
    )
    further = _scored(index, sizes, written(others, "search-others"), parts, dimension, top)
    best = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    kept = near.unionByName(further).withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
    return kept.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "same"))).alias("found"))


def nearest_neighbours(
    table: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    is_query: Column | None = None,
    top: int = TOP,
    part_rows: int = PART_ROWS,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``) for the rows that ``is_query`` (over
    ``vec_id``) picks, by default every ``QUERY_EVERY``-th id.
    """
    spark = table.sparkSession
    vectors, dimension = usable_vectors(own_columns(table, id_column, vector_column), id_column, vector_column)
    kind = vectors.schema["vec_id"].dataType
    if not dimension:
        empty = T.StructType([T.StructField("query_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", kind), T.StructField("score", T.DoubleType())])
        return spark.createDataFrame([], empty)
    rows = vectors.count()
    parts = MIN_PARTS
    while parts < MAX_PARTS and parts * part_rows < rows:
        parts *= 2
    sample = draw_sample(vectors, dimension, rows, parts * SAMPLE_PER_PART)
    model = spark.sparkContext.broadcast(fit(spark, sample, parts, top=top, target=target))
    index = build_index(vectors, model, dimension, top)
    asked = vectors.where((F.col("vec_id") % QUERY_EVERY == 0) if is_query is None else is_query)
    distinct = asked.select("h", "v").distinct().withColumn("qid", F.monotonically_increasing_id())
    queries = written(distinct, "search-queries")
    found = search(index, queries, model, dimension, top + 1)
    answers = queries.join(found, "qid").select("h", "v", "found")
    each = asked.select("vec_id", "h", "v").join(answers, ["h", "v"]).select(F.col("vec_id").alias("query_id"), "found")
    own = F.array_position(F.transform("found", lambda x: x["same"] & x["vec_id"].eqNullSafe(F.col("query_id"))), F.lit(True))
    others = F.filter("found", lambda x, i: (i + 1) != own)
    listed = each.select("query_id", F.posexplode(F.slice(others, 1, top)).alias("at", "x"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
