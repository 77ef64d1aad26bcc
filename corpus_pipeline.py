"""A training corpus from ``documents``: filter, dedup, mix, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns they got. ``run`` writes each stage's result to the
shared checkpoint folder and reads it again for the next one, so a lost
executor never costs more than the stage it was lost in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starweave.llm import exact, mixing, packing, simhash, toxicity
from starweave.llm.common import scratch_tables, stored
from starweave.llm.queries import TOXIC, table, vocabulary
from starweave.session import discard


def _chosen(docs: DataFrame, key: Column, keep: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``(doc_id, key)`` in ``keep``; null ids match null ids."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("id"), key.alias("key"))
    wanted = keep.select(F.col("doc_id").alias("want_id"), F.col("key").alias("want_key"))
    match = F.col("id").eqNullSafe(F.col("want_id")) & (F.col("key") == F.col("want_key"))
    rows = rows.join(wanted, match, "left_semi")
    # rows of one id and text may differ elsewhere: their own hash decides, so a retried task picks the same one
    first = F.row_number().over(W.partitionBy("id", "key").orderBy(F.xxhash64("row")))
    return rows.withColumn("n", first).where("n = 1").select("row.*")


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, does not reject.

    Null and empty texts score low and stay. Without labels nothing is rejected.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out="__toxicity")
    return scored.where(F.col("__toxicity") < TOXIC).drop("__toxicity")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts, the row with the smallest id.

    Repeated rows count as copies; where a text has no id at all one row stays.
    """
    found = exact.exact_dedup(docs).where("kept").select("doc_id", F.col("digest").alias("key")).distinct()
    return _chosen(docs, exact.digest(docs["text"]), found)


def distinct_fingerprints(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (4-word shingles, 4 bits), the row with the smallest id.

    Rows with one id are ordered by a hash of the text; null ids come last.
    """
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    found = simhash.simhash_dedup(docs.select("doc_id", "text", own.alias("__key")), 4, 4, keep=("__key",))
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col("__key").alias("key"))
    least = found.groupBy("group_fp").agg(F.min(place).alias("least"))
    return _chosen(docs, own, least.select("least.doc_id", "least.key"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at 3:1:2; a document taken twice is two rows.

    Null and empty texts have no words; they are taken as often as their source's
    certain copies. The null source is one source, the last. Rows that share id and size are taken together.
    Whole texts are counted; an empty table gives an empty mix.
    """
    return mixing.repeated(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens.

    Null and empty texts are their end token. A very long text is cut into
    several sequences. Repeated rows, with null ids too, are packed each on its
    own. Other columns are not read; an empty table gives no pieces.
    """
    return packing.pack(docs, vocabulary(), end=2, capacity=4096)


STAGES = [
    ("toxicity", non_toxic),
    ("exact_dedup", distinct_texts),
    ("simhash_dedup", distinct_fingerprints),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL cannot express the classifier, XXH64 or the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after the other.

    Intermediate tables are removed once their stage is written; the table that
    packing reads stays, as its result is computed by the caller.
    """
    before: list[str] = []
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch_tables() as used:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # the stage is written: what it kept on its way, and the stage before, have no reader any more
        discard(spark, *before, *used[:-1])
        before = used[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
