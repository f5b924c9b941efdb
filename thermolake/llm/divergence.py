"""How far the vocabularies of sources lie apart, as exact sums over all terms of a language.

Every (language, source) group is a sparse row of term counts. With N the counts of a row summed and V
the number of kept terms, a term with count c has p(c) = 1 + floor(10^9 (c + 2) / (N + 2V)), and two
rows differ by the sum over all V terms of f(p, q) = floor((p - q)^2 / (p + q)). Also of terms that
neither row has: those with count 0 stand at the row's baseline z = p(0).

The sum is worked out by Gustavson's row accumulation on blocks of terms. A block holds a term-major
index: the groups of each term, with p. Each group of the block scatters its terms through the index
into a dense accumulator with one place per peer; what a task emits are accumulators, never the
pairs of postings behind them. Only terms that both rows have take part in the scatter, so it adds

    f(p, q) - f(p, z_q) - f(z_p, q) + f(z_p, z_q)

and the baselines are corrected per row: f(p, z_q) - f(z_p, z_q) over the terms of one row, from its
histogram of counts (at most about sqrt(2N) different ones), and V f(z_p, z_q) once. As
everything is whole numbers, the order of the additions does not matter.

At scale: counts are combined in each task, in Spark's partial aggregation and by (language, source,
term), so a hot word or source is no hot key. A block has about ``BLOCK_ENTRIES`` entries, chosen by a
hash of the term; a term has one entry per group at most. Accumulators have one number per peer.
The result itself has all pairs of sources of a language, which is what is asked for.

Odd rows: null text, language or source count as empty; a group without terms has count 0 everywhere;
a language without kept terms gives 0 for its pairs and no terms; rows sharing an id are documents of
their own; an empty table gives an empty result. Only (text, lang, source) are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermolake.llm.common import stored

# A term is a run of letters: ASCII letters and everything beyond ASCII.
BETWEEN_TERMS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000

# Entries of a block of the term-major index, and postings visited at once.
BLOCK_ENTRIES = 200_000
VISITS = 1_000_000
# Different (group, term) pairs that a counting task gathers before it sends them on.
GATHERED = 400_000

COUNTS_DDL = "lang string, source string, term string, n bigint, docs bigint"


class _Counter:
    """Counts of one task: gathered by batch, merged when there are many."""

    def __init__(self) -> None:
        self.parts: list[pa.Table] = []
        self.held = 0

    def add(self, batch: pa.RecordBatch) -> None:
        lang, source = (pc.fill_null(batch.column(c), "").dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(len(source.dictionary), 1)
        group = group + source.indices.to_numpy(zero_copy_only=False)
        split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(batch.column("text"), "")), BETWEEN_TERMS)
        lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(split).dictionary_encode()
        code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        terms = flat.dictionary
        size = max(len(terms), 1)
        real = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
        doc = np.repeat(np.arange(batch.num_rows, dtype=np.int64), lengths)[real]
        in_doc, times = np.unique(doc * size + code[real], return_counts=True)
        doc, term = np.divmod(in_doc, size)
        cell, where = np.unique(group[doc] * size + term, return_inverse=True)
        n = np.zeros(len(cell), np.int64)
        np.add.at(n, where, times)
        docs = np.bincount(where, minlength=len(cell)).astype(np.int64)
        of, term = np.divmod(cell, size)
        # A group without terms is a row without a term, which names the group.
        names = np.unique(group)
        of, n, docs = np.concatenate([of, names]), np.concatenate([n, 0 * names]), np.concatenate([docs, 0 * names])
        term = pa.concat_arrays([terms.take(pa.array(term)), pa.nulls(len(names), terms.type)])
        a, b = np.divmod(of, max(len(source.dictionary), 1))
        columns = [lang.dictionary.take(pa.array(a)), source.dictionary.take(pa.array(b)), term, pa.array(n), pa.array(docs)]
        self.parts.append(pa.table(columns, names=["lang", "source", "term", "n", "docs"]))
        self.held += len(cell)

    def merged(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            whole = pa.concat_tables(self.parts).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
            self.parts, self.held = [], 0
            yield from whole.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"]).to_batches(100_000)


def counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, first): how often a group has a term that ``least`` documents of its
    language have; a row with a null term per group; ``first`` marks one row of each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Counter()
        for batch in batches:
            if batch.num_rows:
                gathered.add(batch)
            if gathered.held >= GATHERED:
                yield from gathered.merged()
        yield from gathered.merged()

    text = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*text).mapInArrow(count, COUNTS_DDL)
    found = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    named = found.filter("term is not null")
    kept = named.withColumn("all", F.sum("docs").over(of_term)).withColumn("place", F.row_number().over(of_term.orderBy("source")))
    kept = kept.filter(F.col("all") >= least).select("lang", "source", "term", "n", (F.col("place") == 1).alias("first"))
    groups = found.filter("term is null").select("lang", "source", "term", "n", F.lit(False).alias("first"))
    return kept.unionByName(groups)


def shares(n: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """p of counts ``n`` with N + 2V = ``total``: 1 + floor(10^9 (n + 2) / total), exactly."""
    if len(n) and int(n.max()) > (1 << 63) // SCALE - 3:
        n, total = n.astype(object), np.asarray(total).astype(object)
    return np.asarray(1 + SCALE * (n + 2) // total).astype(np.int64)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f(p, q); both are at most 10^9 + 1, so the square fits."""
    return (p - q) ** 2 // (p + q)


PART_DDL = "lang string, source string, part string, item string, value bigint"


def _rows(lang: str, source: pa.Array, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
    n = len(value)
    columns = [pa.repeat(pa.scalar(lang, pa.string()), n), source.cast(pa.string()), pa.repeat(pa.scalar(part, pa.string()), n), item.cast(pa.string()), pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "part", "item", "value"])


def accumulate(block: pa.Table) -> Iterator[pa.RecordBatch]:
    """Accumulators of all groups of one block of terms, and each group's largest terms.

    ``block``: lang, source, term, n, total (N + 2V of the group), lang_total; one language.
    """
    lang = block.column("lang")[0].as_py()
    block = block.sort_by([("term", "ascending"), ("source", "ascending")])
    terms, names = (block.column(c).combine_chunks().dictionary_encode() for c in ("term", "source"))
    term, n = terms.indices.to_numpy().astype(np.int64), block.column("n").to_numpy()
    group = names.indices.to_numpy().astype(np.int64)
    peers = len(names.dictionary)
    own = block.column("total").to_numpy()
    total = np.zeros(peers, np.int64)
    total[group] = own
    p, zero = shares(n, own), shares(np.zeros(peers, np.int64), total)

    # Terms are numbered in order, so the postings of a term lie together, sorted by group name.
    end = np.searchsorted(term, term, side="right")
    by_group = np.argsort(group, kind="stable")
    first = np.searchsorted(group[by_group], np.arange(peers + 1))
    accumulator = np.zeros(peers, np.int64)
    for g in range(peers):
        mine = by_group[first[g] : first[g + 1]]
        fan_out = end[mine] - mine - 1  # the peers behind this group; those before it have met it
        done = np.concatenate([[0], np.cumsum(fan_out)])
        touched = np.zeros(peers, bool)
        low = 0
        while low < len(mine):
            high = max(low + 1, int(np.searchsorted(done, done[low] + VISITS, side="right")) - 1)
            times = fan_out[low:high]
            at = np.arange(times.sum()) + np.repeat(mine[low:high] + 1 - (done[low:high] - done[low]), times)
            mine_p, peer, peer_p = np.repeat(p[mine[low:high]], times), group[at], p[at]
            both = apart(mine_p, peer_p) - apart(mine_p, zero[peer]) - apart(zero[g], peer_p) + apart(zero[g], zero[peer])
            np.add.at(accumulator, peer, both)
            touched[peer] = True
            low = high
        met = np.flatnonzero(touched)
        if len(met):
            here, there, value = pa.repeat(names.dictionary[g], len(met)), names.dictionary.take(pa.array(met)), accumulator[met]
            yield _rows(lang, here, "pair", there, value)
            yield _rows(lang, there, "pair", here, value)
            accumulator[met] = 0

    whole = np.zeros(len(terms.dictionary), np.int64)
    np.add.at(whole, term, n)
    q = shares(whole, block.column("lang_total").to_numpy()[0])[term]
    over = np.flatnonzero((p > q) & (n > 0))
    value = apart(p[over], q[over])
    order = np.lexsort((term[over], -value, group[over]))
    over, value = over[order], value[order]
    place = np.arange(len(over)) - np.searchsorted(group[over], group[over])
    best = place < TOP_TERMS
    at = pa.array(over[best])
    yield _rows(lang, names.dictionary.take(names.indices.take(at)), "term", terms.dictionary.take(terms.indices.take(at)), value[best])


def baselines(row: pa.Table) -> Iterator[pa.RecordBatch]:
    """What a group's terms add against the baseline of every peer, and the baselines themselves.

    ``row``: lang, source, item, a, b; with an item a peer and its N + 2V, without one a count and
    the number of terms that have it; ``own`` and ``terms``: N + 2V of the group, and V.
    """
    lang, source = row.column("lang")[0].as_py(), row.column("source")[0]
    own, size = row.column("own")[0].as_py(), row.column("terms")[0].as_py()
    is_peer = pc.is_valid(row.column("item"))
    peers, histogram = row.filter(is_peer), row.filter(pc.invert(is_peer))
    if not peers.num_rows:
        return
    names = peers.column("item").combine_chunks()
    if not size:
        yield _rows(lang, pa.repeat(source, len(names)), "pair", names, np.zeros(len(names), np.int64))
        return
    zero = shares(np.zeros(1, np.int64), own)[0]
    peer_zero = shares(np.zeros(len(names), np.int64), peers.column("a").to_numpy())
    empty = apart(zero, peer_zero)
    accumulator = np.zeros(len(names), np.int64)
    for p, times in zip(shares(histogram.column("a").to_numpy(), own), histogram.column("b").to_numpy()):
        accumulator += times * (apart(p, peer_zero) - empty)
    here = pa.repeat(source, len(names))
    yield _rows(lang, here, "pair", names, accumulator + size * empty)
    yield _rows(lang, names, "pair", here, accumulator)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has the distance to every other source
    of the language, part ``term`` the ``TOP_TERMS`` terms a source has more of than its language,
    that contribute most."""
    kept = stored(counts(docs, least), "terms")
    of_lang = Window.partitionBy("lang")
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("bigint")).alias("terms"))
    groups = groups.withColumns({"terms": F.sum("terms").over(of_lang), "lang_n": F.sum("n").over(of_lang)})
    groups = stored(
        groups.select("lang", "source", "terms", (F.col("n") + 2 * F.col("terms")).alias("total"), (F.col("lang_n") + 2 * F.col("terms")).alias("lang_total")),
        "groups",
    )
    entries = kept.filter("term is not null").select("lang", "source", "term", "n")

    blocks = max(1, math.ceil(entries.count() / BLOCK_ENTRIES))
    placed = entries.join(groups.drop("terms"), ["lang", "source"]).withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)))

    def of_block(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(accumulate(table)))

    shared = placed.groupBy("lang", "block").applyInArrow(of_block, PART_DDL)

    peers = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("a"))
    pairs = groups.join(peers, "lang").filter("source <> item").select("lang", "source", "item", "a", F.lit(0).cast("bigint").alias("b"))
    histogram = entries.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("b"))
    histogram = histogram.select("lang", "source", F.lit(None).cast("string").alias("item"), F.col("n").alias("a"), "b")
    rows = pairs.unionByName(histogram).join(groups.select("lang", "source", F.col("total").alias("own"), "terms"), ["lang", "source"])

    def of_row(table: pa.Table) -> pa.Table:
        found = list(baselines(table))
        return pa.Table.from_batches(found) if found else pa.Table.from_batches([_rows("", pa.array([], pa.string()), "", pa.array([], pa.string()), np.zeros(0, np.int64))])

    corrected = rows.groupBy("lang", "source").applyInArrow(of_row, PART_DDL)
    total = shared.unionByName(corrected).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = total.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))
