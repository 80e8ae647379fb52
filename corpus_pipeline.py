"""A corpus from documents: toxic texts go, then copies, near copies and benchmark leaks; what stays is packed.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the last return rows with the
columns of `docs`, untouched, whatever else these are called. A decision on an id holds for all rows with that
id. Rows without an id are told apart by their text alone: exact copies of them go, and no other stage can name
them, so they stay. Null texts are empty; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavesym.llm.catalog import table, tokenizer_path
from wavesym.llm.decontaminate import contaminated
from wavesym.llm.exact import exact_duplicates, normal_text
from wavesym.llm.minhash import MinHash, near_duplicates
from wavesym.llm.packing import pack
from wavesym.llm.store import Work
from wavesym.llm.toxicity import toxicity

NEAR = MinHash(num=80, den=100, bands=40, rows=5)
CAPACITY, END_ID = 2048, 0


FEW = 1_000_000  # numbers that may be broadcast


def _small(numbers: DataFrame) -> DataFrame:
    """A table of numbers for a join with the documents: broadcast up to FEW rows, counted, shuffled beyond."""
    return F.broadcast(numbers) if numbers.count() <= FEW else numbers


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents themselves are not shuffled for the few that go."""
    gone = Work(docs.sparkSession).table(ids.select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return docs.join(_small(gone), docs["doc_id"].cast("long") == gone["gone"], "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return _without(docs, scored.filter("predicted = 1"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that with the smallest id.

    Texts that no other row has stay where they are; only the rows of groups are brought together.
    """
    work = Work(spark)
    found = work.table(exact_duplicates(docs), "exact")
    groups = found.filter("group_size > 1")
    repeated = work.table(groups.select(F.xxhash64("text_sha256").alias("mark")).distinct(), "repeated")
    kept = groups.filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_text"))
    digest = F.sha2(normal_text(docs["text"]).cast("binary"), 256)
    marked = docs.select(F.struct("*").alias("row"), docs["doc_id"].cast("long").alias("id"), digest.alias("digest"))
    marked = marked.withColumn("mark", F.xxhash64("digest"))
    single = marked.join(_small(repeated), "mark", "left_anti")
    several = marked.join(_small(repeated), "mark", "left_semi")
    first = several.join(kept, several["id"].eqNullSafe(kept["kept_id"]) & (several["digest"] == kept["kept_text"]), "left_semi")
    return single.select("row.*").unionByName(first.dropDuplicates(["id", "digest"]).select("row.*"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, near_duplicates(docs, NEAR).filter("not kept"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path(), END_ID, CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: Similarity of sets of words, language models and edit distance are more than SQL expresses.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
