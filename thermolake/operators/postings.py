"""Stored postings in blocks with score bounds, and a search that reads few of them.

A block holds the postings of one term in one shard of ``2 ** SHARD_BITS`` consecutive chunks: places
in the shard, frequencies and lengths, and next to them the greatest frequency and the least length,
from which the block's greatest possible score follows for any k1, b and mean length. Blocks are
stored by term bucket and sorted by term.

A search takes three passes, each over the buckets and terms of its queries only:

1. seeds: the rarest terms of every query, up to a share of its postings, give each chunk a partial score.
   As weights are not negative, the k-th best partial score is a lower bound of the k-th best score;
2. essentials: terms are ordered by the greatest score they can add. Those that stay below a share of
   the bound even together cannot lift a chunk over it alone, so every hit has one of the other, essential
   terms. Only blocks of these are read, and of them only blocks that can reach the bound with the help
   of all other terms. Chunks that cannot reach it with what is missing drop out;
3. the rest: blocks of the remaining terms, only where a chunk is left that may need them.

In a pass, the blocks of a shard meet in one task: a bounded number of chunks, whatever the size of the
corpus or the frequency of a word. Scores go into a dense array per query; no (query, chunk) pair is
formed for a chunk that is no candidate. Shards are many more than tasks, so a hot word is spread over
all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermolake.operators.block_topk import SCORE_DIGITS
from thermolake.operators.topk import top_k
from thermolake.session import materialise

# Chunks of a shard; shards are numbered by the leading bits of a chunk's number.
SHARD_BITS = 13
# A chunk's number: segment, task of the writing job, row.
ROW_BITS, TASK_BITS = 30, 20
# Tokens a task gathers before it closes the blocks of a shard early.
GATHERED_TOKENS = 2_000_000
# Share of a query's postings that its seeds may have.
SEED_SHARE = 0.08
# Share of its bound that what is left to the last pass may add to a query's candidate.
REST_SHARE = 0.5
# Terms up to which a filter names each, for the reader's statistics; more are only joined.
NAMED_TERMS = 1_000
# Queries, and postings of theirs, scored together in a task.
QUERIES_TOGETHER = 128
POSTINGS_TOGETHER = 1_000_000

# Partial sums may differ in their last bits from a sum in another order.
SLACK = 1e-7

BLOCK_DDL = (
    "term string, shard bigint, first bigint, n int, max_tf int, min_dl int, "
    "places array<int>, tfs array<int>, dls array<int>"
)
BLOCK_NAMES = ["term", "shard", "first", "n", "max_tf", "min_dl", "places", "tfs", "dls"]
# What a search takes of a block that it reads.
READ_NAMES = ["term", "shard", "places", "tfs", "dls"]


def chunk_number(segment: int) -> Column:
    """A chunk's number in a segment, by the task that writes it."""
    id_ = F.monotonically_increasing_id()
    task, row = F.shiftright(id_, 33), id_.bitwiseAND((1 << 33) - 1)
    fits = (task < 1 << TASK_BITS) & (row < 1 << ROW_BITS)
    number = F.lit(segment << (TASK_BITS + ROW_BITS)).cast("bigint") + F.shiftleft(task, ROW_BITS) + row
    return F.when(fits, number).otherwise(F.raise_error("too many chunks in a task").cast("bigint"))


def bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def saturation(tf, dl, mean_length: float, k1: float, b: float):
    """What a term's frequency is worth in a text of a length; grows with tf, falls with dl."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / mean_length))


def _lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), pc.list_flatten(column).to_numpy(zero_copy_only=False)


def blocks(numbered: DataFrame) -> DataFrame:
    """``BLOCK_DDL`` rows of stored chunks (no, dl, tokens): counted in the task that reads them."""
    bits, names, limit = SHARD_BITS, BLOCK_NAMES, GATHERED_TOKENS

    def close(shard: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]) -> pa.RecordBatch:
        """The blocks of one shard from (place, length, tokens per chunk, tokens)."""
        place, dl, lengths = (np.concatenate([p[i] for p in parts]) for i in range(3))
        words = pa.chunked_array([p[3] for p in parts], pa.string()).combine_chunks().dictionary_encode()
        size = max(len(words.dictionary), 1)
        cell = words.indices.to_numpy().astype(np.int64) * len(place) + np.repeat(np.arange(len(place)), lengths)
        cell, tf = np.unique(cell, return_counts=True)
        code, chunk = np.divmod(cell, max(len(place), 1))
        begin = np.searchsorted(code, np.arange(size + 1))
        n = np.diff(begin)
        tf, dls = tf.astype(np.int32), dl[chunk].astype(np.int32)
        offsets = pa.array(begin.astype(np.int32))
        columns = [
            words.dictionary.slice(0, size),
            pa.array(np.full(size, shard)),
            pa.array((shard << bits) + place[chunk[begin[:-1]]]),
            pa.array(n.astype(np.int32)),
            pa.array(np.maximum.reduceat(tf, begin[:-1])),
            pa.array(np.minimum.reduceat(dls, begin[:-1])),
            *[pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (place[chunk].astype(np.int32), tf, dls)],
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, current, held = [], None, 0
        for batch in batches:
            number, dl = batch.column("no").to_numpy(), batch.column("dl").to_numpy()
            lengths = pc.list_value_length(batch.column("tokens")).to_numpy(zero_copy_only=False)
            tokens = pc.list_flatten(batch.column("tokens"))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            shards = number >> bits
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(number)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                if parts and (current != shards[low] or held > limit):
                    if held:
                        yield close(current, parts)
                    parts, held = [], 0
                current = int(shards[low])
                words = tokens.slice(ends[low], ends[high] - ends[low])
                parts.append((number[low:high] & ((1 << bits) - 1), dl[low:high], lengths[low:high], words))
                held += len(words)
        if held:
            yield close(current, parts)

    return numbered.select("no", "dl", "tokens").mapInArrow(run, BLOCK_DDL)


def live(stored: DataFrame) -> DataFrame:
    """(term, no, tf, dl) of blocks."""
    rows = stored.select("term", "shard", F.inline(F.arrays_zip("places", "tfs", "dls")))
    return rows.select("term", (F.shiftleft("shard", SHARD_BITS) + F.col("places")).alias("no"), F.col("tfs").alias("tf"), F.col("dls").alias("dl"))


@dataclass(frozen=True)
class Asked:
    """A block of queries: entries (query, term, weight, bound) sorted by term, and the vocabulary.

    ``bound`` is the greatest score a term can add to a chunk for the query, ``df`` its chunks.
    """

    ids: list
    terms: pa.Array
    query: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    bound: np.ndarray
    df: np.ndarray
    bucket: np.ndarray
    mean_length: float
    k1: float
    b: float

    @classmethod
    def of(cls, ids: list, rows: pa.Table, mean_length: float, k1: float, b: float) -> Asked:
        """From rows (query_id, term, weight, df, bucket, max_tf, min_dl); weights of zero have no part."""
        rows = rows.filter(pc.greater(rows["weight"], 0.0)).sort_by("term")
        encoded = rows["term"].combine_chunks().dictionary_encode()
        position = {q: i for i, q in enumerate(ids)}
        weight = rows["weight"].to_numpy()
        top = saturation(rows["max_tf"].to_numpy().astype(float), rows["min_dl"].to_numpy(), mean_length, k1, b)
        query = np.array([position[q] for q in rows["query_id"].to_pylist()], dtype=np.int64)
        return cls(
            ids, encoded.dictionary, query, encoded.indices.to_numpy().astype(np.int64), weight, weight * top,
            rows["df"].to_numpy().astype(np.int64), rows["bucket"].to_numpy(), mean_length, k1, b,
        )

    def seeds(self) -> np.ndarray:
        """Entries of each query's rarest terms, as many as ``SEED_SHARE`` of its postings hold, one at least."""
        order = np.lexsort((self.term, self.df, self.query))
        total = np.bincount(self.query, self.df, minlength=len(self.ids))
        so_far = _running(self.query[order], self.df[order].astype(float))
        first = np.concatenate([[True], np.diff(self.query[order]) > 0])[: len(order)]
        mask = np.zeros(len(order), dtype=bool)
        mask[order] = first | (so_far <= SEED_SHARE * total[self.query[order]])
        return mask

    def essential(self, floor: np.ndarray) -> np.ndarray:
        """Entries outside each query's largest set of terms that stay below ``REST_SHARE`` of its floor
        together: a larger set would leave more candidates, as all of it is unknown in the second pass."""
        order = np.lexsort((self.term, self.bound, self.query))
        mask = np.zeros(len(order), dtype=bool)
        mask[order] = _running(self.query[order], self.bound[order]) >= REST_SHARE * floor[self.query[order]] - SLACK
        return mask

    def needed(self, mask: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Per term, the saturation a block must be able to have to matter to any query of ``mask``."""
        others = np.bincount(self.query, self.bound, minlength=len(self.ids))[self.query] - self.bound
        least = np.full(len(self.terms), np.inf)
        np.minimum.at(least, self.term[mask], ((floor[self.query] - SLACK - others) / self.weight)[mask])
        return least

    def rest(self, mask: np.ndarray) -> np.ndarray:
        """Per query, what the terms outside ``mask`` can add at most."""
        return np.bincount(self.query[~mask], self.bound[~mask], minlength=len(self.ids))


def _spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start .. start + n - 1 of every span, one after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - n), n)


def _running(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Running sums within runs of equal keys, itself included."""
    if not len(key):
        return value
    total = np.cumsum(value)
    start = np.searchsorted(key, key)
    return total - (total - value)[start]


@dataclass(frozen=True)
class BlockScorer:
    """Scores the blocks of one shard for the entries of a mask."""

    asked: Asked
    mask: np.ndarray
    floor: np.ndarray
    k: int

    def dead(self, table: pa.Table) -> np.ndarray:
        """Places of removed chunks: the rows without a term."""
        return _lists(table.filter(pc.is_null(table["term"]))["places"])[1].astype(np.int64)

    def scores(self, table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the first query, queries x places) for groups of queries; removed chunks have 0."""
        a, size = self.asked, 1 << SHARD_BITS
        dead, table = self.dead(table), table.filter(pc.is_valid(table["term"]))
        code = pc.fill_null(pc.index_in(table["term"].combine_chunks(), value_set=a.terms), -1).to_numpy(zero_copy_only=False)
        offsets, places = _lists(table["places"])
        worth = saturation(_lists(table["tfs"])[1].astype(float), _lists(table["dls"])[1], a.mean_length, a.k1, a.b)
        known = np.flatnonzero(code >= 0)
        for start in range(0, len(a.ids), QUERIES_TOGETHER):
            width = min(QUERIES_TOGETHER, len(a.ids) - start)
            entry = np.flatnonzero(self.mask & (a.query >= start) & (a.query < start + width))
            begin = np.searchsorted(a.term[entry], np.arange(len(a.terms) + 1))
            times = begin[code[known] + 1] - begin[code[known]]
            # Every (block, entry) of a term, then every posting of it, a bounded number at once.
            block = np.repeat(known, times)
            mine = entry[_spans(begin[code[known]], times)]
            postings = np.diff(offsets)[block]
            done = np.concatenate([[0], np.cumsum(postings)])
            total, low = np.zeros(width * size), 0
            while low < len(block):
                high = max(low + 1, int(np.searchsorted(done, done[low] + POSTINGS_TOGETHER, side="right")) - 1)
                n = postings[low:high]
                at = _spans(offsets[block[low:high]], n)
                cell = np.repeat((a.query[mine[low:high]] - start) * size, n) + places[at]
                total += np.bincount(cell, np.repeat(a.weight[mine[low:high]], n) * worth[at], len(total))
                low = high
            if len(block):
                total = total.reshape(width, size)
                total[:, dead] = 0.0
                yield start, total

    def best(self, table: pa.Table) -> pa.Table:
        """(query, score): the k best scores of every query in this shard."""
        queries, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        for start, total in self.scores(table):
            top = np.partition(total, total.shape[1] - self.k, axis=1)[:, -self.k :] if self.k < total.shape[1] else total
            row, column = np.nonzero(top > 0)
            queries.append(row + start)
            values.append(top[row, column])
        return pa.table({"query": np.concatenate(queries), "score": np.concatenate(values)})

    def candidates(self, table: pa.Table) -> pa.Table:
        """(query, shard, place, score): chunks whose score can still reach the floor, or the k-th
        best of this shard."""
        rest = self.asked.rest(self.mask)
        shard = table["shard"][0].as_py()
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for start, total in self.scores(table):
            width = len(total)
            own = np.partition(total, total.shape[1] - self.k, axis=1)[:, -self.k] if self.k < total.shape[1] else np.zeros(width)
            least = np.maximum(self.floor[start : start + width], own) - rest[start : start + width] - SLACK
            row, place = np.nonzero((total > 0) & (total >= least[:, None]))
            out.append((row + start, place, total[row, place]))
        query, place, score = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query": query, "shard": np.full(len(query), shard), "place": place.astype(np.int32), "score": score})

    def completed(self, found: pa.Table, table: pa.Table) -> pa.Table:
        """Candidates of a shard with what the blocks of the remaining terms add to them."""
        a, found = self.asked, found.sort_by("query")
        query, place, score = found["query"].to_numpy(), found["place"].to_numpy(), found["score"].to_numpy().copy()
        first = np.searchsorted(query, np.arange(len(a.ids) + 1))
        entry = np.flatnonzero(self.mask & (first[a.query] < first[a.query + 1]))
        begin = np.searchsorted(a.term[entry], np.arange(len(a.terms) + 1))
        code = pc.index_in(table["term"].combine_chunks(), value_set=a.terms).to_numpy(zero_copy_only=False)
        offsets, places = _lists(table["places"])
        worth = saturation(_lists(table["tfs"])[1].astype(float), _lists(table["dls"])[1], a.mean_length, a.k1, a.b)
        for i, term in enumerate(code.tolist()):
            block = slice(offsets[i], offsets[i + 1])
            for e in entry[begin[int(term)] : begin[int(term) + 1]].tolist():
                mine = slice(first[a.query[e]], first[a.query[e] + 1])
                at = np.minimum(np.searchsorted(places[block], place[mine]), offsets[i + 1] - offsets[i] - 1)
                score[mine] += np.where(places[block][at] == place[mine], a.weight[e] * worth[block][at], 0.0)
        return pa.table({"query": query, "shard": found["shard"].to_numpy(), "place": place, "score": score})


SCORED_DDL = "query bigint, shard bigint, place int, score double"


@dataclass(frozen=True)
class PostingsSearch:
    """Search of one block of queries in stored blocks.

    ``stored`` has ``BLOCK_DDL`` and ``bucket``; ``removed`` the numbers (no) of chunks that no longer
    count.
    """

    spark: SparkSession
    stored: DataFrame
    removed: DataFrame | None
    asked: Asked
    k: int

    def read(self, mask: np.ndarray, needed: np.ndarray | None = None) -> DataFrame:
        """Blocks of the terms of ``mask`` that can be worth ``needed``: pruned by bucket and term."""
        a = self.asked
        used = np.unique(a.term[mask])
        terms = a.terms.take(pa.array(used))
        least = np.full(len(used), -np.inf) if needed is None else needed[used]
        wanted = self.spark.createDataFrame(pa.table({"term": terms, "needed": least})) if len(used) else None
        if wanted is None:
            return self.stored.filter("false").select(*READ_NAMES)
        found = self.stored.filter(F.col("bucket").isin(np.unique(a.bucket[mask]).tolist()))
        if len(used) <= NAMED_TERMS:
            found = found.filter(F.col("term").isin(terms.to_pylist()))
        top = saturation(F.col("max_tf"), F.col("min_dl"), a.mean_length, a.k1, a.b)
        # The terms of a block of queries: its bytes were counted when it was cut.
        return found.join(F.broadcast(wanted), "term").filter(top >= F.col("needed")).select(*READ_NAMES)

    def _by_shard(self, found: DataFrame) -> DataFrame:
        """Rows of a shard in one partition. The blocks of few queries are few bytes but much work, so
        the session's number of partitions is kept instead of being cut down to the bytes."""
        return found.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "shard")

    def _with_removed(self, found: DataFrame) -> DataFrame:
        """Blocks, and rows without a term that name removed places of each shard."""
        if self.removed is None:
            return self._by_shard(found)
        place = F.col("no").bitwiseAND((1 << SHARD_BITS) - 1).cast("int")
        gone = self.removed.select(F.shiftright("no", SHARD_BITS).alias("shard"), place.alias("place"))
        gone = gone.groupBy("shard").agg(F.collect_set("place").alias("places"))  # a shard's places at most
        empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema}
        return self._by_shard(found.unionByName(gone.select(*[F.col(n) if n in ("shard", "places") else empty[n] for n in READ_NAMES])))

    def floor(self) -> np.ndarray:
        """Per query, a lower bound of its k-th best score; 0 with fewer than k partial scores."""
        mask = self.asked.seeds()
        scorer = BlockScorer(self.asked, mask, np.zeros(len(self.asked.ids)), self.k)
        parts = self._with_removed(self.read(mask)).groupBy("shard").applyInArrow(lambda t: scorer.best(t), "query bigint, score double")
        kth = top_k(parts, ["query"], [F.desc("score")], self.k).filter(F.col("rank") == self.k).toArrow()
        floor = np.zeros(len(self.asked.ids))
        floor[kth["query"].to_numpy()] = kth["score"].to_numpy()
        return floor

    def plan(self) -> tuple[np.ndarray, np.ndarray]:
        """(floor per query, mask of the essential entries)"""
        floor = self.floor()
        return floor, self.asked.essential(floor)

    def essentials(self, floor: np.ndarray, mask: np.ndarray) -> DataFrame:
        return self.read(mask, self.asked.needed(mask, floor))

    def rest(self, mask: np.ndarray, found: DataFrame) -> DataFrame:
        """Blocks of the remaining terms where a candidate is left whose query has the term."""
        a = self.asked
        if mask.all():
            return self.stored.filter("false").select(*READ_NAMES)
        terms = pa.table({"query": a.query[~mask], "term": a.terms.take(pa.array(a.term[~mask]))})
        left = found.select("query", "shard").distinct().join(F.broadcast(self.spark.createDataFrame(terms)), "query")
        return self.read(~mask).join(left.select("term", "shard").distinct(), ["term", "shard"], "left_semi")

    def candidates(self, blocks_read: DataFrame, floor: np.ndarray, mask: np.ndarray) -> DataFrame:
        scorer = BlockScorer(self.asked, mask, floor, self.k)
        return self._with_removed(blocks_read).groupBy("shard").applyInArrow(lambda t: scorer.candidates(t), SCORED_DDL)

    def reaching(self, found: DataFrame, mask: np.ndarray) -> DataFrame:
        """Candidates that the terms outside ``mask`` may lift to the k-th best score that there is
        without them, over all shards."""
        kth = top_k(found, ["query"], [F.desc("score")], self.k).filter(F.col("rank") == self.k)
        kth = kth.select("query", F.col("score").alias("kth"))
        rest = self.spark.createDataFrame(pa.table({"query": np.arange(len(self.asked.ids)), "rest": self.asked.rest(mask)}))
        bound = F.broadcast(rest.join(kth, "query", "left"))  # a row per query of the block
        left = found.join(bound, "query").filter(F.col("score") + F.col("rest") + SLACK >= F.coalesce("kth", F.lit(0.0)))
        return materialise(left.select("query", "shard", "place", "score"), "left")

    def hits(self) -> DataFrame:
        """(query_id, no, score, raw): all that can be among the k best, those that tie with the k-th included."""
        if not len(self.asked.query):
            kind = "string" if self.asked.ids and isinstance(self.asked.ids[0], str) else "bigint"
            return self.spark.createDataFrame([], f"query_id {kind}, no bigint, score double, raw double")
        floor, mask = self.plan()
        found = self.candidates(self.essentials(floor, mask), floor, mask)
        if not mask.all():
            found = self.reaching(materialise(found, "candidates"), mask)
            last = BlockScorer(self.asked, ~mask, floor, self.k)
            others = self.rest(mask, found)
            found = self._by_shard(found).groupBy("shard").cogroup(self._by_shard(others).groupBy("shard")).applyInArrow(lambda found, rest: last.completed(found, rest), SCORED_DDL)
        scored = found.select(
            "query",
            (F.shiftleft("shard", SHARD_BITS) + F.col("place")).alias("no"),
            F.round("score", SCORE_DIGITS).alias("score"),
            F.col("score").alias("raw"),
        )
        # Numbers do not follow the corpus: all that tie with the k-th stay, until their keys are known.
        best = scored.withColumn("rank", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).filter(F.col("rank") <= self.k)
        ids = self.spark.createDataFrame(pa.table({"query": np.arange(len(self.asked.ids)), "query_id": self.asked.ids}))
        return best.join(F.broadcast(ids), "query").select("query_id", "no", "score", "raw")
