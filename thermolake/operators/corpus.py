"""Documents and chunks.

A document is ``id, source, text, ord_key``; ``ord_key`` sorts documents in corpus order, which
settles ties between equal scores. A chunk adds ``doc_id`` and ``pos``, its first sentence.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake import settings
from thermolake.functions.numbers import float_text
from thermolake.functions.text import required, sentences

DOCUMENT_COLUMNS = ["id", "source", "text", "ord_key"]
CHUNK_COLUMNS = ["id", "doc_id", "source", "text", "ord_key", "pos"]

# Id, source and sentence templates of a KPI document.
KPI_ID = "gold_%s_%s"
KPI_SOURCE = "delta://gold/machine_daily_kpi/%s/%s"
KPI_TEXT = (
    "On %s, machine %s reported %d temperature readings. "
    "%d of them were anomalies, an anomaly rate of %s. "
    "The average temperature was %s degrees Celsius, ranging from %s to %s, "
    "a thermal spread of %s degrees."
)


def order_key(rows: DataFrame, column: str) -> Column:
    """Text that sorts as the column does: integers by value (shifted to be positive, with all of
    their 20 digits), anything else as its own text, of whatever length."""
    if isinstance(rows.schema[column].dataType, T.IntegralType):
        shifted = F.col(column).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
        return F.lpad(shifted.cast("decimal(20,0)").cast("string"), 20, "0")
    return F.col(column).cast("string")


def documents(rows: DataFrame, doc_id: str, text: str = "text", source: str = "source") -> DataFrame:
    """A table with an id as a corpus, in the order of the ids. A null text is refused."""
    return rows.select(
        F.col(doc_id).cast("string").alias("id"),
        F.col(source).alias("source"),
        required(F.col(text), "text").alias("text"),
        order_key(rows, doc_id).alias("ord_key"),
    )


def kpi_documents(gold: DataFrame) -> DataFrame:
    """One document per daily KPI row."""
    day = F.col("reading_date").cast("string")

    def number(name: str) -> Column:
        return float_text(F.col(name))

    return gold.select(
        F.format_string(KPI_ID, "machine_id", day).alias("id"),
        F.format_string(KPI_SOURCE, "machine_id", day).alias("source"),
        F.format_string(
            KPI_TEXT,
            day,
            F.col("machine_id"),
            F.col("readings"),
            F.col("anomaly_count"),
            number("anomaly_rate"),
            number("avg_temperature_c"),
            number("min_temperature_c"),
            number("max_temperature_c"),
            number("temp_spread_c"),
        ).alias("text"),
        F.concat_ws("|", "machine_id", day).alias("ord_key"),
    )


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """Corpora one after the other: the position prefixes the order key."""
    digits = len(str(len(corpora)))
    numbered = [
        c.select(
            "id", "source", "text", F.concat(F.lit(f"{i:0{digits}d}|"), F.col("ord_key")).alias("ord_key")
        )
        for i, c in enumerate(corpora)
    ]
    return reduce(DataFrame.unionByName, numbered)


def chunk(corpus: DataFrame, sentences_per_chunk: int = settings.SENTENCES_PER_CHUNK) -> DataFrame:
    """Overlapping chunks of whole sentences; neighbours share a sentence.

    A window starts every ``n - 1`` sentences until one reaches the end. Each document expands
    inside its own row, so nothing is shuffled.
    """
    n = sentences_per_chunk
    step = max(1, n - 1)
    parts = F.col("_sentences")
    last = F.ceil(F.greatest(F.size(parts) - n, F.lit(0)) / step).cast("int") * step
    windows = F.transform(
        F.sequence(F.lit(0), last, F.lit(step)),
        lambda i: F.struct(
            i.cast("int").alias("pos"),
            F.array_join(F.slice(parts, i + 1, F.lit(n)), " ").alias("text"),
        ),
    )
    expanded = corpus.withColumn("_sentences", sentences(required(F.col("text"), "text"))).select(
        F.col("id").alias("doc_id"), "source", "ord_key", F.inline(windows)
    )
    # Sentences carry no outer white space, so only an empty document gives a blank chunk.
    return (
        expanded.filter(F.col("text") != "")
        .withColumn("id", F.format_string("%s#c%02d", "doc_id", "pos"))
        .select(CHUNK_COLUMNS)
    )


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunk_count"))
