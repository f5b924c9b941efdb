"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``:

1. toxicity: texts that the classifier rejects at the threshold of their language go;
2. near_duplicates: of each group linked by 80 % shared five-word shingles, the document with the
   smallest id stays;
3. decontamination: documents that overlap with a benchmark item go;
4. secrets: every match of a secret rule is replaced by a mark, ``n_chars`` follows;
5. packing: pieces of token ids and their places in sequences of 1024.

Null and empty texts are kept by stages 1 to 4 and packed as a single end id; rows with a null id
link with nothing and stay; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolake.llm import decontaminate, jaccard, packing, secrets, toxicity
from thermolake.llm.common import stored, table
from thermolake.llm.queries import TOKENIZER, known_labels


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, known_labels(spark, sf_dir, "toxic", 3, 1))
    scored = toxicity.score(docs, model)
    return scored.filter(F.col("score") < toxicity.threshold(model, F.col("lang"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = secrets.redact(docs)
    length = F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return marked.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = packing.pieces(docs, TOKENIZER)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mark_secrets),
    ("packing", pack),
]

# A trained network, hashed sets and a tokenizer's ids are beyond SQL; the tests compare stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of what is kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
