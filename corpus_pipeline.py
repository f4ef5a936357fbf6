"""The corpus pipeline: rejects toxic documents, keeps one of each group of similar ones, masks personal data, mixes the
sources to their target weights and packs what is left into training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm import mixing, ngram_join, packing, pii, toxicity
from folioframe.scratch import Scratch


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the grade clean."""
    model = toxicity.fit_on(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity.label_grade())
    return toxicity.score_documents(docs, model).where("__grade = 0").select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents, that of the smallest id; documents without an id stay. Of
    rows of that id with one text one stays, and every different text of it, unless they are similar themselves."""
    unlike = "__unlike"
    # Rows of one id are told apart by their text, so that two different documents never stand for each other.
    named = docs.withColumn(unlike, F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.col("text").isNull(), "text"))
    kept = ngram_join.similar_components(spark, named, id_col=unlike).select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")).distinct()
    rows = named.join(kept, F.col(unlike) == F.col("__row"))
    first = F.row_number().over(Window.partitionBy("__group").orderBy("doc_id", F.xxhash64(*docs.columns)))
    with_id = rows.where("doc_id is not null").withColumn("__n", first).where("__n = 1")
    return with_id.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    plan, _ = mixing.mix_plan(spark, docs)
    taken = mixing.apply_plan(docs, plan).where("__mix_repeats > 0")
    return taken.withColumn("__copy", F.explode(F.expr("sequence(1L, __mix_repeats)"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.pack_documents(spark, docs).drop("ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", keep_one_of_similar),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage keeps is written out, since the next reads it more than once."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs)
    return docs
