"""From documents to packed training sequences, in stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next one's docs. A stage works on all that the one before kept;
all but the last return the columns of documents.

Defined results: null texts have no language and go in the first stage, as do
texts without a letter. Rows that share an id but not a text are documents of their
own, and the third stage keeps the least (id, hash of the text) of each component of
near duplicates; rows equal in all columns are one. Rows without an id are documents
of their own in every stage: nothing is their duplicate. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfscan.llm import langid, quality_gam
from shelfscan.llm.jaccard_join import near_duplicates
from shelfscan.llm.packing import pack_documents
from shelfscan.llm.substring_dedup import remove_repeats
from shelfscan.llm.tables import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: The SQL of run()'s rows: SQL has neither the models nor the packing.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known: undetermined ones go, and those less like any prototype than
    its own training documents of that length are."""
    docs = docs.select(*COLUMNS)
    training = docs.filter(~langid.held_out())
    learned = langid.prototypes(training)
    known = langid.identify(training.select("text", "lang"), learned, lang_pred="__lang", score="__score")
    least = langid.least_scores(known.filter("lang = __lang"), score="__score")
    found = langid.identify(docs, learned, lang_pred="__lang", score="__score")
    like = langid.is_like(least, score="__score")
    return found.filter((F.col("__lang") != langid.UNDETERMINED) & like).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score a half or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_gam.train(quality_gam.learnable(docs), quality_gam.learnable(labels), "quality")
    scored = quality_gam.score(docs.select(*COLUMNS), model, name="__score")
    return scored.filter("__score >= 0.5").select(*COLUMNS)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least by id and text, of every group of near duplicates; all rows without an id."""
    docs = docs.select(*COLUMNS)
    nulls = [F.col(c).isNull() for c in COLUMNS]  # a hash passes over nulls
    rows = docs.filter("doc_id IS NOT NULL").withColumn("__row", F.xxhash64(*COLUMNS, *nulls))
    classes = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("__row"), "component_id").distinct()
    order = F.struct("doc_id", F.xxhash64("text").alias("hash"), "__row").alias("order")
    least = rows.select("__row", order).join(classes, "__row").groupBy("component_id").agg(F.min("order").alias("order"))
    first = least.select(F.col("order.__row").alias("__row"))
    kept = rows.join(first, "__row", "left_semi").dropDuplicates(["__row"]).select(*COLUMNS)
    return kept.unionByName(docs.filter("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller id has, else as they stand; those of which nothing is left go."""
    kept = remove_repeats(docs.select(*COLUMNS), text="__kept", as_is=True)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("__kept")).otherwise(F.col("text"))
    left = kept.filter("n_removed = 0 OR n_removed < n_words")
    return left.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document stands in the packed sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicate_groups", near_duplicate_groups),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
