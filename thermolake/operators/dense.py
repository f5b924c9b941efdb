"""Dense vectors: the default text vectoriser, exact search, and cluster-probed search."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake import settings
from thermolake.functions.text import required, tokens
from thermolake.operators.block_topk import (
    QUERIES_PER_MATRIX,
    SCORE_DIGITS,
    SLACK,
    Scorer,
    query_blocks,
    rank_hits,
    search_blocks,
)

DEFAULT_DIMENSIONS = 64


def hashing_embedder(
    dimensions: int = DEFAULT_DIMENSIONS, text: str = "text"
) -> Callable[[DataFrame], DataFrame]:
    """A stateless text vectoriser: hashed ``1 + ln(tf)`` weights scaled to unit length. The bucket of a
    token comes from the first 32 bits of its MD5, worked out once per distinct token of a batch.

    It stands in for a neural encoder, which is not available here, so distances differ from an
    encoder's. Any function adding an ``embedding`` column can take its place. A table that has the
    ``tokens`` of its text already is not split again.
    """

    @F.arrow_udf("array<double>")
    def to_vector(words: pa.Array) -> pa.Array:
        n = len(words)
        lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(n, dtype=np.int64), lengths)
        encoded = pc.list_flatten(words).dictionary_encode()
        digests = [md5(t.encode("utf-8")).digest() for t in encoded.dictionary.to_pylist()]
        bucket = np.array([int.from_bytes(d[:4], "big") % dimensions for d in digests], dtype=np.int64)
        cell = row * dimensions + bucket[encoded.indices.to_numpy()] if len(row) else row
        counts = np.bincount(cell, minlength=n * dimensions).reshape(n, dimensions)
        weights = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0)
        norms = np.linalg.norm(weights, axis=1, keepdims=True)
        unit = weights / np.where(norms == 0, 1, norms)
        offsets = np.arange(0, (n + 1) * dimensions, dimensions, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel()))

    def words_of(df: DataFrame) -> Column:
        return F.col("tokens") if text == "text" and "tokens" in df.columns else tokens(required(F.col(text), text))

    return lambda df: df.withColumn("embedding", to_vector(words_of(df)))


def _vectors(column: pa.Array, dimensions: int) -> np.ndarray:
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), dimensions)


def squared_l2(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """rows x queries squared distances from one matrix product."""
    squares = (vectors**2).sum(axis=1)[:, None] + (queries**2).sum(axis=1)[None, :]
    return np.maximum(squares - 2 * (vectors @ queries.T), 0.0)


def _grouped(queries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for start in range(0, len(queries), QUERIES_PER_MATRIX):
        yield start, queries[start : start + QUERIES_PER_MATRIX]


def _bytes(vector: str) -> Column:
    return F.size(vector).cast("bigint") * 8 + 64


def _complete(rows: DataFrame, dimensions: int | None = None) -> DataFrame:
    """Rows whose vectors are not null, hold no null and have the wanted length; others fail the
    job, as they have no distance."""
    vector = F.col("embedding")
    bad = vector.isNull() | F.exists(vector, lambda x: x.isNull())
    if dimensions is not None:
        bad |= F.size(vector) != dimensions
    problem = F.raise_error("embedding is null, holds a null or has another length")
    return rows.withColumn("embedding", F.when(bad, problem.cast(rows.schema["embedding"].dataType)).otherwise(vector))


def _fetch(block: DataFrame) -> tuple[list, np.ndarray]:
    table = block.select("query_id", "embedding").toArrow()
    ids = table["query_id"].to_pylist()
    dimensions = len(table["embedding"][0]) if ids else 0
    return ids, _vectors(table["embedding"].combine_chunks(), dimensions) if ids else np.zeros((0, 0))


def _dimensions(rows: DataFrame) -> int | None:
    row = rows.select(F.size("embedding")).first()
    return row[0] if row else None


def dense_search(
    rows: DataFrame, queries: DataFrame, k: int = settings.TOP_K_RETRIEVE
) -> DataFrame:
    """Exact nearest ``k`` rows per query by squared L2.

    ``rows``: ``id, ord_key, pos, embedding``; ``queries``: ``query_id, embedding``. The score is
    the negated distance, so larger is nearer. Every query meets every row: for query sets that
    grow with the table use ``probed_search``.
    """
    dimensions = _dimensions(queries)

    def scorer(wanted: np.ndarray, ids: list) -> Scorer:
        def score(batch: pa.RecordBatch, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            vectors = _vectors(batch.column("embedding"), wanted.shape[1])
            for start, group in _grouped(wanted):
                yield start, -squared_l2(vectors, group)

        return score

    blocks = query_blocks(_complete(queries, dimensions), _bytes("embedding"), k)
    found = search_blocks(blocks, _fetch, scorer, _complete(rows, dimensions), k, ["embedding"])
    return rank_hits(found, k)


# --- exact search with bounds -------------------------------------------------------------

# Pairs whose bound is looked at together.
BOUND_CELLS = 1_000_000


def fit_pivots(rows: DataFrame, pivots: int) -> np.ndarray:
    """Orthonormal directions (pivots x dimensions) spanned by the first vectors of the table.

    Any directions give right results; they only decide how much a bound excludes.
    """
    first = rows.orderBy("ord_key", "pos").limit(pivots).select("embedding").collect()
    if not first:
        return np.zeros((0, 0))
    basis, upper = np.linalg.qr(np.array([r[0] for r in first], dtype=np.float64).T)
    return np.ascontiguousarray(basis[:, np.abs(np.diag(upper)) > 1e-6].T)


def with_bounds(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add ``head``, a vector's coordinates along the pivots, and ``tail``, its distance from what they
    span; to be stored with the row.

    For two vectors, ``|head - head|^2 + (tail - tail)^2`` is at most their squared distance: the
    first part is exact, and beside it the triangle inequality bounds the rest.
    """
    ddl = "struct<head:array<double>,tail:double>"

    @F.arrow_udf(ddl)
    def bounds(vectors: pa.Array) -> pa.Array:
        heads, tails = _heads(_vectors(vectors, pivots.shape[1]), pivots)
        offsets = pa.array(np.arange(len(heads) + 1, dtype=np.int32) * heads.shape[1])
        column = pa.ListArray.from_arrays(offsets, pa.array(heads.ravel()))
        return pa.StructArray.from_arrays([column, pa.array(tails)], names=["head", "tail"])

    bounded = _complete(rows, pivots.shape[1] or None).withColumn("_bounds", bounds("embedding"))
    return bounded.withColumns({"head": F.col("_bounds.head"), "tail": F.col("_bounds.tail")}).drop("_bounds")


def _heads(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    heads = vectors @ pivots.T
    return heads, np.sqrt(np.maximum((vectors**2).sum(axis=1) - (heads**2).sum(axis=1), 0.0))


class BoundedScorer:
    """Negated squared distances of the pairs that a bound does not exclude; counts both."""

    def __init__(self, queries: np.ndarray, pivots: np.ndarray):
        self.queries, self.pivots = queries, pivots
        self.heads, self.tails = _heads(queries, pivots)
        self.pairs = self.measured = 0

    def __call__(self, batch: pa.RecordBatch, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        vectors = _vectors(batch.column("embedding"), self.queries.shape[1])
        heads = _vectors(batch.column("head"), len(self.pivots))
        tails = batch.column("tail").to_numpy()
        # Small steps, so that the floors of the first rows help with the others.
        step = max(1, BOUND_CELLS // QUERIES_PER_MATRIX // 32)
        for start, group in _grouped(self.queries):
            own = slice(start, start + len(group))
            least = floor[own].copy()
            scores = np.full((len(vectors), len(group)), -np.inf)
            best = np.full((0, len(group)), -np.inf)  # the k best scores of the steps so far
            for low in range(0, len(vectors), step):
                part = slice(low, low + step)
                bound = squared_l2(heads[part], self.heads[own]) + (tails[part, None] - self.tails[None, own]) ** 2
                row, query = np.nonzero(-bound >= least - SLACK)
                self.pairs += bound.size
                self.measured += len(row)
                found = scores[part]
                if len(row) > bound.size // 4:
                    found[row, query] = -squared_l2(vectors[part], group)[row, query]
                else:
                    x, y = vectors[part][row], group[query]
                    dots = np.einsum("ij,ij->i", x, y)
                    found[row, query] = -np.maximum((x**2).sum(axis=1) + (y**2).sum(axis=1) - 2 * dots, 0.0)
                if low + step < len(vectors):
                    best = self._best(np.concatenate([best, found]))
                    least = np.maximum(least, self._kth(best))
            yield start, scores

    def _best(self, scores: np.ndarray) -> np.ndarray:
        """The k best scores of every query, all with fewer rows."""
        n = len(scores)
        return np.partition(scores, n - self.k, axis=0)[n - self.k :] if n > self.k else scores

    def _kth(self, scores: np.ndarray) -> np.ndarray:
        """The k-th best score, minus infinity with fewer rows."""
        return self._best(scores).min(axis=0) if len(scores) >= self.k else np.full(scores.shape[1], -np.inf)

    k = 1


def bounded_search(
    stored: DataFrame, pivots: np.ndarray, queries: DataFrame, k: int = settings.TOP_K_RETRIEVE
) -> DataFrame:
    """``dense_search`` on rows stored ``with_bounds``: the same hits, and no product for rows whose
    bound is beyond the k-th best distance found so far."""
    return rank_hits(_bounded(stored, pivots, queries, k, None), k)


def bounded_work(stored: DataFrame, pivots: np.ndarray, queries: DataFrame, k: int = settings.TOP_K_RETRIEVE) -> DataFrame:
    """One row: pairs of a query and a row, and the distances a bounded search measures for them."""

    def count(rows: DataFrame, ids: list, scorer: Callable[[], Scorer], k: int, columns: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score, floor = scorer(), np.full(len(ids), -np.inf)
            for batch in batches:
                for start, scores in score(batch, floor) if batch.num_rows else ():
                    own = slice(start, start + scores.shape[1])
                    floor[own] = np.maximum(floor[own], score._kth(scores))
            yield pa.RecordBatch.from_pydict({"pairs": [score.pairs], "measured": [score.measured]})

        return rows.select(*columns).mapInArrow(run, "pairs bigint, measured bigint")

    found = _bounded(stored, pivots, queries, k, count)
    return found.agg(F.sum("pairs").alias("pairs"), F.sum("measured").alias("measured"))


def _bounded(stored: DataFrame, pivots: np.ndarray, queries: DataFrame, k: int, top: Callable | None) -> DataFrame:
    dimensions = pivots.shape[1] or None

    def scorer(wanted: np.ndarray, ids: list) -> Scorer:
        made = BoundedScorer(wanted, pivots)
        made.k = k
        return made

    blocks = query_blocks(_complete(queries, dimensions), _bytes("embedding"), k)
    columns = ["embedding", "head", "tail"]
    return search_blocks(blocks, _fetch, scorer, _complete(stored, dimensions), k, columns, top)


def dense_hits(found: DataFrame) -> DataFrame:
    """Rounded for presentation: ``query_id, rank, chunk_id, distance``."""
    distance = F.round(-F.col("raw"), 4) + F.lit(0.0)
    return found.select(
        "query_id", "rank", F.col("id").alias("chunk_id"), distance.alias("distance")
    )


# --- approximate search -------------------------------------------------------------------


def fit_clusters(
    rows: DataFrame, clusters: int, seed: int = 7, max_iter: int = 10, fraction: float = 1.0
) -> KMeansModel:
    """Centroids over the vectors; a few passes, each combining on the map side.

    Centroids only steer the search, so on large tables a ``fraction`` of the vectors may fit
    them; every vector is assigned and searched all the same.
    """
    chosen = rows if fraction >= 1.0 else rows.sample(fraction, seed)
    vectors = chosen.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return KMeans(k=clusters, seed=seed, maxIter=max_iter, initSteps=2).fit(vectors)


def assign_clusters(rows: DataFrame, model: KMeansModel) -> DataFrame:
    """Add ``cluster``, the nearest centroid. Stored with ``partitionBy("cluster")``, unprobed
    clusters are never read."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return (
        model.setFeaturesCol("_features")
        .setPredictionCol("cluster")
        .transform(rows.withColumn("_features", vector))
        .drop("_features")
    )


def nearest_clusters(centres: np.ndarray, queries: np.ndarray, probes: int) -> np.ndarray:
    return np.argsort(squared_l2(queries, centres), axis=1, kind="stable")[:, :probes]


def probed_search(
    clustered: DataFrame,
    model: KMeansModel,
    queries: DataFrame,
    probes: int,
    k: int = settings.TOP_K_RETRIEVE,
) -> DataFrame:
    """Nearest ``k`` rows within each query's ``probes`` nearest clusters.

    A batch is split by cluster, and the rows of a cluster are only multiplied with the queries
    that probe it. Clusters are no shuffle key, so one holding a third of the rows is spread over
    as many tasks as its files.
    """
    centres = np.array(model.clusterCenters())

    def scorer(wanted: np.ndarray, ids: list) -> Scorer:
        near = nearest_clusters(centres, wanted, probes)
        probed = np.zeros((len(centres), len(wanted)), dtype=bool)
        probed[near.ravel(), np.repeat(np.arange(len(wanted)), near.shape[1])] = True

        def score(batch: pa.RecordBatch, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            vectors = _vectors(batch.column("embedding"), wanted.shape[1])
            cluster = batch.column("cluster").to_numpy()
            for start, group in _grouped(wanted):
                scores = np.full((len(vectors), len(group)), -np.inf)
                for c in np.unique(cluster):
                    mine = np.flatnonzero(probed[c, start : start + len(group)])
                    if len(mine):
                        own = np.flatnonzero(cluster == c)
                        scores[np.ix_(own, mine)] = -squared_l2(vectors[own], group[mine])
                yield start, scores

        return score

    dimensions = centres.shape[1]
    blocks = query_blocks(_complete(queries, dimensions), _bytes("embedding"), k)
    found = search_blocks(blocks, _fetch, scorer, _complete(clustered, dimensions), k, ["embedding", "cluster"])
    return rank_hits(found, k)


# --- coded residuals ----------------------------------------------------------------------

# Levels of a coded component.
LEVELS = 16


def with_codes(clustered: DataFrame, model: KMeansModel) -> tuple[DataFrame, np.ndarray]:
    """Add ``code``, a byte per component that tells a vector's place relative to the centre of its
    cluster, and return the levels' ends (least, step) per component.

    The ends come from one aggregation over all residuals, so every component lies within a level.
    """
    centres = np.array(model.clusterCenters())
    dimensions = centres.shape[1]

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dimensions, np.inf), np.full(dimensions, -np.inf)
        for batch in batches:
            if batch.num_rows:
                apart = _vectors(batch.column("embedding"), dimensions) - centres[batch.column("cluster").to_numpy()]
                low, high = np.minimum(low, apart.min(axis=0)), np.maximum(high, apart.max(axis=0))
        if np.isfinite(low).all():
            yield pa.RecordBatch.from_pydict({"place": np.arange(dimensions, dtype=np.int32), "low": low, "high": high})

    sent = clustered.select("embedding", "cluster").mapInArrow(ends, "place int, low double, high double")
    rows = sent.groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    levels = np.zeros((2, dimensions))
    for r in rows:
        levels[:, r["place"]] = r["low"], (r["high"] - r["low"]) / LEVELS

    @F.arrow_udf("binary")
    def code(vectors: pa.Array, cluster: pa.Array) -> pa.Array:
        apart = _vectors(vectors, dimensions) - centres[cluster.to_numpy()] - levels[0]
        level = np.clip(apart / np.where(levels[1] > 0, levels[1], 1.0), 0, LEVELS - 1).astype(np.uint8)
        return pa.array([row.tobytes() for row in level], pa.binary())

    return clustered.withColumn("code", code("embedding", "cluster")), levels


def write_clusters(coded: DataFrame, path: str) -> DataFrame:
    """Store coded rows by cluster: a search reads the clusters that its queries probe, and of them the
    codes."""
    coded.repartition("cluster", F.pmod(F.xxhash64("id"), F.lit(8))).write.partitionBy("cluster").parquet(path)
    return coded.sparkSession.read.schema(coded.schema).parquet(path)


def coded_search(
    stored: DataFrame,
    model: KMeansModel,
    levels: np.ndarray,
    queries: DataFrame,
    probes: int,
    rescored: int,
    k: int = settings.TOP_K_RETRIEVE,
) -> DataFrame:
    """Nearest ``k`` rows within each query's ``probes`` nearest clusters, by codes first.

    A query has a table per probed cluster: what each level of each component adds to the squared
    distance. Rows get the sum of their levels; the ``rescored`` best of a query are measured exactly.
    """
    centres = np.array(model.clusterCenters())
    dimensions = centres.shape[1]
    asked = _complete(queries, dimensions)

    @F.arrow_udf("array<int>")
    def near(vectors: pa.Array) -> pa.Array:
        found = nearest_clusters(centres, _vectors(vectors, dimensions), probes)
        return pa.array(found.tolist(), pa.list_(pa.int32()))

    wanted = asked.select(F.explode(near("embedding")).alias("cluster")).distinct()
    probed_clusters = sorted(r[0] for r in wanted.collect())  # at most as many as there are clusters
    rows = stored.filter(F.col("cluster").isin(probed_clusters))

    def scorer(vectors: np.ndarray, ids: list) -> Scorer:
        mine = nearest_clusters(centres, vectors, probes)
        middles = levels[0] + (np.arange(LEVELS)[:, None] + 0.5) * levels[1]

        def score(batch: pa.RecordBatch, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            cluster = batch.column("cluster").to_numpy()
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, dimensions)
            for start, group in _grouped(vectors):
                scores = np.full((len(codes), len(group)), -np.inf)
                for c in np.unique(cluster):
                    of_queries = np.flatnonzero((mine[start : start + len(group)] == c).any(axis=1))
                    if len(of_queries):
                        own = np.flatnonzero(cluster == c)
                        # (levels, components, queries)
                        tables = (middles[:, :, None] - (group[of_queries] - centres[c]).T[None]) ** 2
                        total = np.zeros((len(own), len(of_queries)))
                        for component in range(dimensions):
                            total += tables[codes[own, component], component]
                        scores[np.ix_(own, of_queries)] = -total
                yield start, scores

        return score

    blocks = query_blocks(asked, _bytes("embedding"), rescored)
    rough = rank_hits(search_blocks(blocks, _fetch, scorer, rows, rescored, ["cluster", "code"]), rescored)
    pairs = rough.select("query_id", "id").join(rows.select("id", "ord_key", "pos", "embedding"), "id")
    pairs = pairs.join(asked.select("query_id", F.col("embedding").alias("_asked")), "query_id")
    apart = F.aggregate(
        F.zip_with(F.col("embedding"), F.col("_asked"), lambda x, y: (x.cast("double") - y.cast("double")) ** 2),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    exact = pairs.select("query_id", "id", "ord_key", "pos", F.round(-apart, SCORE_DIGITS).alias("score"), (-apart).alias("raw"))
    return rank_hits(exact, k)


def distances_computed(
    clustered: DataFrame, model: KMeansModel, queries: DataFrame, probes: int
) -> DataFrame:
    """One row: distances a probed search computes, and an exact one."""
    centres = np.array(model.clusterCenters())

    @F.arrow_udf("array<int>")
    def probed(vectors: pa.Array) -> pa.Array:
        return pa.array(nearest_clusters(centres, _vectors(vectors, centres.shape[1]), probes).tolist(), pa.list_(pa.int32()))

    asked = queries.select(F.explode(probed("embedding")).alias("cluster")).groupBy("cluster")
    held = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_rows"))
    pairs = held.join(asked.agg(F.count(F.lit(1)).alias("n_queries")), "cluster", "left")
    return pairs.agg(
        F.sum(F.col("n_rows") * F.coalesce("n_queries", F.lit(0))).alias("probed"),
        (F.sum("n_rows") * F.sum("n_queries") / probes).cast("bigint").alias("exact"),
    )


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """One row: exact hits, how many the approximate search found, and the ratio."""
    found = approximate.select("query_id", "id").withColumn("_found", F.lit(1))
    return (
        exact.join(found, ["query_id", "id"], "left")
        .agg(F.count(F.lit(1)).alias("exact_hits"), F.count("_found").alias("found_hits"))
        .withColumn("recall", F.col("found_hits") / F.col("exact_hits"))
    )
