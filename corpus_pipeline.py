"""A pipeline from raw documents to shards of a training mix.

``STAGES`` lists its stages; each takes all that the one before kept and returns the
columns of ``documents`` (the last: the shards).  ``run`` applies them to the table,
each result written as a table in the shared folder and read again, so that a lost
executor costs one stage at most.

Defined cases, beyond those of the operators: rows are told apart by id and text, so
rows with a null or repeated id are kept or dropped on their own; equal rows are one
document to the stage that removes copies, which leaves one of them; an empty table
passes through every stage; further columns of ``documents`` are carried along, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.llm import language_id
from velomart.llm.common import materialize, read_table, row_key
from velomart.llm.decontamination import contamination
from velomart.llm.jaccard_join import JaccardJoin
from velomart.llm.mixing import mix_sources
from velomart.llm.sharding import shard_rows

SHINGLE_WORDS = 5
NEAR_PERCENT = 80
SHARDS = 24
#: No SQL: the first stage's model cannot be expressed in it.
ORACLE_SQL = None


def _key():
    return row_key("doc_id", "text")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: null texts and those without a letter.  Nothing else
    goes, also where no row has a label to learn from."""
    model = language_id.train(docs, ~language_id.held_out("doc_id"))
    carried = {f"column{i}": F.col(c) for i, c in enumerate(docs.columns)}
    found = language_id.identify(docs, model, extra=carried)
    return found.where("has_letter").select(*(F.col(n).alias(c) for n, c in zip(carried, docs.columns, strict=True)))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each component of near duplicates, that of the least id."""
    found = JaccardJoin(docs, n=SHINGLE_WORDS, percent=NEAR_PERCENT, extra={"rk": _key()}).components()
    group = F.coalesce(F.col("root").cast("string"), F.concat(F.lit("row "), F.col("rk")))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rk"))
    kept = found.groupBy(group.alias("group")).agg(first.alias("first")).select(F.col("first.rk").alias("kept_key"))
    kept = materialize(kept.distinct(), "kept")
    rows = docs.withColumn("row_key of this stage", _key()).join(kept, F.col("row_key of this stage") == F.col("kept_key"), "left_semi")
    return rows.dropDuplicates(["row_key of this stage"]).drop("row_key of this stage")


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the contamination rule names."""
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    dirty = materialize(found.where("contaminated").select(F.col("rk").alias("dirty_key")).distinct(), "dirty")
    return docs.join(dirty, _key() == F.col("dirty_key"), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents as the mix of sources takes them; a document of
    which the last block takes a part counts as taken."""
    taken = mix_sources(docs, extra={"rk": _key()}).where("taken > 0")
    times = taken.select(F.col("rk").alias("taken_key"), F.ceil(F.col("taken") / F.col("size")).cast("int").alias("times"))
    times = materialize(times.groupBy("taken_key").agg(F.sum("times").alias("times")), "times")
    rows = docs.withColumn("row_key of this stage", _key()).dropDuplicates(["row_key of this stage"])
    repeated = rows.join(times, F.col("row_key of this stage") == F.col("taken_key")).withColumn("copy of this stage", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return repeated.select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return shard_rows(docs, shards=SHARDS)


STAGES = [
    ("known_language", known_language),
    ("one_of_near_copies", one_of_near_copies),
    ("clean_of_benchmarks", clean_of_benchmarks),
    ("mixed", mixed),
    ("sharded", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
