"""BM25 over stored postings: index segments, statistics and batch search."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolake import settings
from thermolake.functions.text import explode_terms, tokens
from thermolake.operators import postings as P
from thermolake.operators.block_topk import (
    HIT_DDL,
    QUERIES_PER_MATRIX,
    Scorer,
    query_blocks,
    rank_hits,
    search_blocks,
)
from thermolake.operators.term_scan import AskedGroups, TermScorer
from thermolake.session import materialise, setting

# Queries from which on their words have most postings: then a scan of the chunks costs less.
MANY_QUERIES = 256
# Products formed at once while scoring a batch.
PRODUCT_CELLS = 2_000_000


def with_tokens(chunks: DataFrame) -> DataFrame:
    """Add ``tokens`` and the chunk length ``dl``."""
    return chunks.withColumn("tokens", tokens(F.col("text"))).withColumn("dl", F.size("tokens"))


def document_frequencies(tokenised: DataFrame) -> DataFrame:
    """``(term, df)``; counts are combined before the shuffle, so common words stay cheap."""
    terms = tokenised.select(F.explode(F.array_distinct("tokens")).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def raw_idf(n_chunks: Column, df: Column) -> Column:
    return F.log(n_chunks - df + 0.5) - F.log(df + 0.5)


@dataclass(frozen=True)
class CorpusStats:
    """Numbers of the whole corpus that every score needs."""

    n_chunks: int
    total_length: int
    mean_idf: float

    @property
    def mean_length(self) -> float:
        return self.total_length / self.n_chunks if self.n_chunks else 0.0


STATS_DDL = "segment int, n_chunks bigint, total_length bigint, buckets int, mean_idf double"

# Parts that may have no file in a segment, as they are written by bucket.
PART_DDL = {
    "postings": f"{P.BLOCK_DDL}, segment int, bucket int",
    "terms": "term string, df bigint, max_tf int, min_dl int, segment int, bucket int",
}

# Chunks that one more bucket of postings is opened for; a task writes a file to each.
CHUNKS_PER_BUCKET = 4_000_000
LEAST_BUCKETS = 8
# Stored chunks whose postings one task sorts in its memory.
PART_BYTES = 32 << 20


@dataclass(frozen=True)
class TextIndex:
    """Stored index in segments: ``chunks``, ``postings``, ``terms`` (df) and ``stats``.

    A segment is written once and never rewritten. The first one holds a corpus; later ones hold what
    a change batch adds, the ids of the documents it takes out of earlier segments, and what those
    take off the counts: a segment's document frequencies, number of chunks and lengths are
    differences, so the state of the index is their sum. A segment counts when its row in ``stats``
    is there, which is written last.
    """

    spark: SparkSession
    path: str

    @classmethod
    def build(
        cls,
        chunks: DataFrame,
        path: str,
        embed: Callable[[DataFrame], DataFrame] | None = None,
    ) -> TextIndex:
        """Write the index, replacing an old one under the same path.

        ``embed`` adds an ``embedding`` column for dense search.
        """
        index = cls(chunks.sparkSession, path.rstrip("/"))
        # Without its statistics an old index is none.
        index.spark.createDataFrame([], STATS_DDL).write.mode("overwrite").parquet(f"{index.path}/stats")
        index._write_segment(0, chunks, embed, None)
        return index

    def update(
        self,
        changed: DataFrame,
        removed: DataFrame | None = None,
        embed: Callable[[DataFrame], DataFrame] | None = None,
    ) -> TextIndex:
        """Add a segment: ``changed`` has all chunks of new and changed documents, ``removed`` the
        ``doc_id`` of documents that are gone. Returns the index with its new state.

        Earlier segments stay as they are. The chunks that are taken out are read once, by their
        document, to find what they count.
        """
        gone = changed.select("doc_id").distinct()
        if removed is not None:
            gone = gone.union(removed.select("doc_id")).distinct()
        segment = self.stats_rows()[-1]["segment"] + 1
        self._write_segment(segment, changed, embed, materialise(gone, "gone"))
        return TextIndex(self.spark, self.path)

    def _write_segment(
        self, segment: int, chunks: DataFrame, embed: Callable[[DataFrame], DataFrame] | None, gone: DataFrame | None
    ) -> None:
        mode = "overwrite"
        # Chunks are numbered and written where they lie: only ids and scores are ever put in order.
        prepared = with_tokens(chunks).withColumn("no", P.chunk_number(segment))
        if embed is not None:
            prepared = embed(prepared)
        prepared = prepared.drop("tokens")  # made again from the text as they are read
        prepared.write.mode(mode).option("compression", "zstd").parquet(f"{self.path}/chunks/segment={segment}")
        stored = self._read_chunks(segment, segment)
        size = stored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("length")).first()

        buckets = max(LEAST_BUCKETS, 1 << (size["n"] // CHUNKS_PER_BUCKET).bit_length()) if segment == 0 else self.buckets
        # Each task writes what it counts, a file per bucket, so postings are not shuffled and a very
        # common word is no single file.
        with setting(self.spark, "spark.sql.files.maxPartitionBytes", PART_BYTES):
            placed = P.blocks(self._read_chunks(segment, segment)).withColumn("bucket", P.bucket(F.col("term"), buckets))
            placed = placed.sortWithinPartitions("bucket", "term", "shard")
            placed.write.mode(mode).option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/postings/segment={segment}")
        own = self.spark.read.schema(PART_DDL["postings"]).parquet(f"{self.path}/postings/segment={segment}")
        frequencies = own.groupBy("term", "bucket").agg(
            F.sum("n").cast("bigint").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl")
        )
        before = (0, 0)
        taken = (0, 0)
        if gone is not None:
            last = self.stats
            before = (last.n_chunks, last.total_length)
            out = self.chunks().join(gone, "doc_id", "left_semi")
            out = materialise(out.select("no", "dl", "tokens"), "out")
            out.select("no").write.mode(mode).parquet(f"{self.path}/removed/segment={segment}")
            lost = out.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("length")).first()
            taken = (lost["n"], lost["length"])
            none = F.lit(None).cast("int")
            less = document_frequencies(out).select(
                "term", P.bucket(F.col("term"), buckets).alias("bucket"), (-F.col("df")).alias("df"), none.alias("max_tf"), none.alias("min_dl")
            )
            frequencies = frequencies.unionByName(less)
        frequencies.repartition("bucket").write.mode(mode).partitionBy("bucket").parquet(f"{self.path}/terms/segment={segment}")

        n, length = before[0] + size["n"] - taken[0], before[1] + size["length"] - taken[1]
        mean = self._frequencies(segment).agg(F.avg(raw_idf(F.lit(n), F.col("df")))).first()[0] or 0.0
        row = [(segment, n, length, buckets, float(mean))]
        self.spark.createDataFrame(row, STATS_DDL).coalesce(1).write.mode("append").parquet(f"{self.path}/stats")

    def _segments(self, part: str, last: int, first: int = 0) -> DataFrame:
        """A part of all segments up to ``last``, with their number and bucket."""
        paths = [f"{self.path}/{part}/segment={s}" for s in range(first, last + 1)]
        reader = self.spark.read.option("basePath", f"{self.path}/{part}")
        return (reader.schema(PART_DDL[part]) if part in PART_DDL else reader).parquet(*paths)

    def _read_chunks(self, last: int, first: int = 0) -> DataFrame:
        """Stored chunks with the tokens of their text, which are made only where they are used."""
        return self._segments("chunks", last, first).withColumn("tokens", tokens(F.col("text")))

    @cached_property
    def _last(self) -> int:
        return self.stats_rows()[-1]["segment"]

    def stats_rows(self) -> list:
        rows = self.spark.read.schema(STATS_DDL).parquet(f"{self.path}/stats").orderBy("segment").collect()
        if not rows:
            raise ValueError(f"no index under {self.path}")
        return rows

    @property
    def removed(self) -> DataFrame | None:
        """Numbers of chunks that later segments took out; None if there is one segment."""
        return self._segments("removed", self._last, 1).select("no") if self._last else None

    def chunks(self) -> DataFrame:
        """The chunks that count, with tokens, ``dl`` and ``no``."""
        stored = self._read_chunks(self._last)
        return stored if self.removed is None else stored.join(self.removed, "no", "left_anti")

    def blocks(self) -> DataFrame:
        """Stored blocks of postings of all segments, those of removed chunks included."""
        return self._segments("postings", self._last)

    def postings(self) -> DataFrame:
        """Inverted index rows ``(term, id, tf, dl)``, from the stored blocks."""
        rows = P.live(self.blocks()).join(self.chunks().select("no", "id"), "no")
        return rows.select("term", "id", "tf", "dl")

    @cached_property
    def stats(self) -> CorpusStats:
        row = self.stats_rows()[-1]
        return CorpusStats(row["n_chunks"], row["total_length"], row["mean_idf"])

    @cached_property
    def buckets(self) -> int:
        return self.stats_rows()[-1]["buckets"]

    def _frequencies(self, last: int) -> DataFrame:
        """``(term, bucket, df, max_tf, min_dl)`` up to a segment; terms that no chunk has are gone."""
        stored = self._segments("terms", last)
        if last == 0:
            return stored.drop("segment")
        total = stored.groupBy("term", "bucket").agg(
            F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl")
        )
        return total.filter("df > 0")

    def frequencies(self, epsilon: float = settings.BM25_EPSILON) -> DataFrame:
        """``(term, bucket, df, max_tf, min_dl, idf)``."""
        raw = raw_idf(F.lit(self.stats.n_chunks), F.col("df"))
        floor = F.lit(epsilon * self.stats.mean_idf)
        return self._frequencies(self._last).withColumn("idf", F.when(raw < 0, floor).otherwise(raw))

    def terms(self, epsilon: float = settings.BM25_EPSILON) -> DataFrame:
        """``(term, df, idf)``; a negative idf becomes ``epsilon`` times the mean idf."""
        return self.frequencies(epsilon).select("term", "df", "idf")


def query_terms(queries: DataFrame, terms: DataFrame) -> DataFrame:
    """``(query_id, term, qtf)`` of one block and the columns of ``terms``: a repeated query word
    counts each time.

    The block's size was checked, so it may be broadcast and the term table is read in place.
    """
    split = queries.select("query_id", tokens(F.col("query")).alias("_tokens"))
    counted = explode_terms(split, "_tokens", "query_id").withColumnRenamed("tf", "qtf")
    return terms.join(F.broadcast(counted), "term")


@dataclass(frozen=True)
class _QueryWeights:
    """A block of queries: the vocabulary, and per group of queries the (query, weight) entries of
    each term, all terms one after the other (``begin[t]`` to ``begin[t + 1]``)."""

    vocabulary: pa.Array
    groups: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, weights: pa.Table, query_ids: list, group_size: int) -> _QueryWeights:
        position = {q: i for i, q in enumerate(query_ids)}
        query = np.array([position[q] for q in weights["query_id"].to_pylist()], dtype=np.int64)
        weight = weights["weight"].to_numpy()
        encoded = weights["term"].combine_chunks().dictionary_encode()
        term = encoded.indices.to_numpy()
        groups = []
        for start in range(0, len(query_ids), group_size):
            width = min(group_size, len(query_ids) - start)
            mine = np.flatnonzero((query >= start) & (query < start + width))
            mine = mine[np.argsort(term[mine], kind="stable")]
            begin = np.searchsorted(term[mine], np.arange(len(encoded.dictionary) + 1))
            groups.append((start, width, begin, query[mine] - start, weight[mine]))
        return cls(encoded.dictionary, groups)


def _score_batch(
    batch: pa.RecordBatch, queries: _QueryWeights, mean_length: float, k1: float, b: float
) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of every row for each group of queries.

    A hit (row, term) only meets the queries that hold the term.
    """
    column = batch.column("tokens")
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    words = pc.list_flatten(column)
    size = len(queries.vocabulary)
    code = pc.fill_null(pc.index_in(words, value_set=queries.vocabulary), -1).to_numpy()
    known = code >= 0
    of_word = np.repeat(np.arange(batch.num_rows, dtype=np.int64), lengths)[known]
    cell, tf = np.unique(of_word * max(size, 1) + code[known], return_counts=True)
    row, term = np.divmod(cell, max(size, 1))
    saturation = tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[row] / mean_length))

    for start, width, begin, query, weight in queries.groups:
        scores = np.zeros((batch.num_rows, width))
        fan_out = begin[term + 1] - begin[term]
        done = np.concatenate(([0], np.cumsum(fan_out)))
        low = 0
        while low < len(row):
            # Whole rows up to about PRODUCT_CELLS products, at least one row.
            target = np.searchsorted(done, done[low] + PRODUCT_CELLS, side="right") - 1
            first, last = row[low], row[min(max(target, low + 1), len(row)) - 1]
            if target < len(row) and last > first:
                last -= 1
            high = np.searchsorted(row, last, side="right")
            part = slice(low, high)
            times = fan_out[part]
            entry = np.arange(times.sum()) + np.repeat(
                begin[term[part]] - (done[part] - done[low]), times
            )
            flat = np.repeat((row[part] - first) * width, times) + query[entry]
            products = np.repeat(saturation[part], times) * weight[entry]
            height = last - first + 1
            sums = np.bincount(flat, weights=products, minlength=height * width)
            scores[first : last + 1] = sums.reshape(height, width)
            low = high
        yield start, scores


def bm25_search(
    index: TextIndex,
    queries: DataFrame,
    k: int = settings.TOP_K_RETRIEVE,
    k1: float = settings.BM25_K1,
    b: float = settings.BM25_B,
) -> DataFrame:
    """Top ``k`` chunks per query: ``query_id, id, ord_key, pos, score, raw, rank``.

    Every chunk has a score, zero when it shares no word, so a query with few matches is filled
    with the first chunks in corpus order. Hits of few queries come from the stored postings, block of
    queries by block, those of many from a scan of the chunks; short lists are padded once. With a
    negative mean idf common words count against a chunk and zeros are no worst score: then every chunk
    is scored from its tokens.
    """
    asked = queries.select("query_id", "query")
    size = F.length("query").cast("bigint") * 2 + 64
    blocks = query_blocks(asked, size, k)
    if index.stats.mean_idf < 0:
        return rank_hits(_scan(index, blocks, k, k1, b), k)
    if asked.count() >= MANY_QUERIES:
        found = _scan_many(index, blocks, k, k1, b)
        return rank_hits(pad(materialise(rank_hits(found, k).drop("rank"), "best"), asked, index.chunks(), k), k)
    found = [materialise(search.hits(), "hits") for search in postings_searches(index, blocks, k, k1, b)]
    if not found:
        return rank_hits(index.spark.createDataFrame([], HIT_DDL.format("bigint")), k)
    hits = reduce(DataFrame.unionByName, found)
    placed = index.chunks().select("no", "id", "ord_key", "pos").join(hits, "no")
    placed = placed.select("query_id", "id", "ord_key", "pos", "score", "raw")
    return rank_hits(pad(materialise(placed, "placed"), asked, index.chunks(), k), k)


def postings_searches(
    index: TextIndex, blocks: Iterator[DataFrame], k: int, k1: float, b: float
) -> Iterator[P.PostingsSearch]:
    """A search per block of queries; a block's ids and weights come to the driver."""
    weight = (F.col("qtf") * F.col("idf")).alias("weight")
    for block in blocks:
        ids = block.select("query_id").toArrow()["query_id"].to_pylist()
        if ids:
            terms = query_terms(block, index.frequencies())
            rows = terms.select("query_id", "term", weight, "df", "bucket", "max_tf", "min_dl").toArrow()
            of_block = P.Asked.of(ids, rows, index.stats.mean_length, k1, b)
            yield P.PostingsSearch(index.spark, index.blocks(), index.removed, of_block, k)


def search_work(index: TextIndex, queries: DataFrame, k: int = settings.TOP_K_RETRIEVE) -> DataFrame:
    """One row: stored blocks and those a search reads (in its last two passes); postings of the
    queries' terms, counted per query, and those that are scored or looked up."""
    asked = queries.select("query_id", "query")
    size = F.length("query").cast("bigint") * 2 + 64
    read = of_terms = scored = 0
    for search in postings_searches(index, query_blocks(asked, size, k), k, settings.BM25_K1, settings.BM25_B):
        a, (floor, mask) = search.asked, search.plan()
        blocks = search.essentials(floor, mask)
        found = search.reaching(materialise(search.candidates(blocks, floor, mask), "candidates"), mask)
        read += blocks.count() + search.rest(mask, found).count()
        of_terms += int(a.df.sum())
        left = np.bincount(a.query[~mask], minlength=len(a.ids))
        lookups = sum(int(left[r["query"]]) * r["count"] for r in found.groupBy("query").count().collect())  # a row per query
        scored += int(a.df[a.seeds()].sum() + a.df[mask].sum()) + lookups
    counts = [(index.blocks().count(), read, of_terms, scored)]
    return index.spark.createDataFrame(counts, "stored_blocks bigint, read_blocks bigint, of_terms bigint, scored bigint")


def _scan(index: TextIndex, blocks: Iterator[DataFrame], k: int, k1: float, b: float) -> DataFrame:
    """Hits of all chunks, from their tokens."""
    stats = index.stats
    terms = index.terms()

    def fetch(block: DataFrame) -> tuple[list, pa.Table]:
        ids = block.select("query_id").toArrow()["query_id"].to_pylist()
        weight = (F.col("qtf") * F.col("idf")).alias("weight")
        return ids, query_terms(block, terms).select("query_id", "term", weight).toArrow()

    def scorer(weights: pa.Table, ids: list) -> Scorer:
        of_queries = _QueryWeights.of(weights, ids, QUERIES_PER_MATRIX)
        return lambda batch, floor: _score_batch(batch, of_queries, stats.mean_length, k1, b)

    return search_blocks(blocks, fetch, scorer, index.chunks(), k, ["tokens"])


def _scan_many(index: TextIndex, blocks: Iterator[DataFrame], k: int, k1: float, b: float) -> DataFrame:
    """Hits with a score above zero, from the tokens of all chunks; weights must not be negative."""
    stats = index.stats

    def fetch(block: DataFrame) -> tuple[list, AskedGroups | None]:
        ids = block.select("query_id").toArrow()["query_id"].to_pylist()
        weight = (F.col("qtf") * F.col("idf")).alias("weight")
        rows = query_terms(block, index.frequencies()).select("query_id", "term", weight, "df").toArrow()
        return AskedGroups.of(ids, rows, stats.n_chunks)

    def scorer(asked: AskedGroups, ids: list) -> Scorer:
        return TermScorer(asked, len(ids), stats.mean_length, k1, b, k)

    # A task for each file, however small: its work is far more than its bytes.
    with setting(index.spark, "spark.sql.files.openCostInBytes", 1 << 30):
        return search_blocks(blocks, fetch, scorer, index.chunks(), k, ["tokens"])


def pad(found: DataFrame, queries: DataFrame, chunks: DataFrame, k: int) -> DataFrame:
    """Add the first chunks of the corpus, with score zero, to queries with fewer than ``k`` hits.

    Such a query has all of its hits in ``found``, at most ``k - 1``, so among the first ``2 * k``
    chunks there are enough others.
    """
    have = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("have"))
    short = queries.select("query_id").join(have, "query_id", "left").filter(F.coalesce("have", F.lit(0)) < k)
    short = materialise(short.select("query_id"), "short")
    if short.isEmpty():
        return found
    first = chunks.select("id", "ord_key", "pos").orderBy("ord_key", "pos").limit(2 * k)
    numbered = F.broadcast(materialise(first, "first")).withColumn("one", F.lit(1))  # 2 k rows
    fill = short.withColumn("one", F.lit(1)).join(numbered, "one").drop("one")
    fill = fill.join(found.select("query_id", "id"), ["query_id", "id"], "left_anti")
    zero = fill.withColumn("score", F.lit(0.0)).withColumn("raw", F.lit(0.0))
    return found.unionByName(zero.select(found.columns))


def bm25_hits(found: DataFrame) -> DataFrame:
    """Rounded for presentation: ``query_id, rank, chunk_id, bm25_score``."""
    return found.select(
        "query_id", "rank", F.col("id").alias("chunk_id"), F.round("raw", 4).alias("bm25_score")
    )
