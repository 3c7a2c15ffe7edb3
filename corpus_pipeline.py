"""From raw documents to packed training sequences: five stages, each calling one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import op3_packing, op5_suffix_dedup, op7_decontamination, op9_language, op10_jaccard_groups
from millrace.llm.columns import bound_batches, table
from millrace.plans.scratch import new_dir
from millrace.session import ship_package

# Near copies: sets of five words, Jaccard similarity 0.80 or more. The query op10 has its own values.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def _ready(spark: SparkSession) -> None:
    """Executors have the package; batches to Python workers are small, as documents travel in them whole."""
    ship_package(spark)
    bound_batches(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; texts that are null or without letters go."""
    _ready(spark)
    model = op9_language.fit(docs, f"NOT ({op9_language.HELD_OUT})")
    return op9_language.predict(docs, model, keep=docs.columns).where("lang_pred <> 'und'").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each class of near copies: the one with the smallest doc_id, null being the largest."""
    _ready(spark)
    return op10_jaccard_groups.one_of_each_class(docs, NEAR_WORDS, NEAR_PERCENT)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that an earlier document has; what is left empty by that goes.

    A character that a cut leaves incomplete goes with the cut; n_chars counts the new text.
    """
    _ready(spark)
    columns = docs.columns
    # The text comes back as the bytes that are left, so rows carry everything else beside it.
    missing = _unused(columns, "no_text")
    carried = docs.withColumn(missing, F.col("text").isNull())
    found = op5_suffix_dedup.remove_repeats(carried, keep=[c for c in carried.columns if c != "text"]).where("n_removed = 0 OR n_removed < n_bytes")
    whole = F.col("kept").cast("string")
    text = F.coalesce(F.try_validate_utf8(whole), F.regexp_replace(F.make_valid_utf8(whole), "\ufffd", ""))
    new = F.when(F.col("n_removed") > 0, text).when(~F.col(f"row.`{missing}`"), whole)
    chars = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length(new).cast("bigint")) if "n_chars" in columns else None
    made = {"text": new, "n_chars": chars}
    return found.select(*[made[c].alias(c) if c in made else F.col(f"row.`{c}`").alias(c) for c in columns])


def _unused(columns: list[str], name: str) -> str:
    """A column name like ``name`` that is not among ``columns``."""
    while name.lower() in [c.lower() for c in columns]:
        name += "_"
    return name


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = op7_decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns)
    return found.where("n_hit = 0").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 4096 tokens."""
    _ready(spark)
    return op3_packing.pack_documents(docs, public_tokenizers.path(op3_packing.TOKENIZER), ids=False)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("decontaminated", decontaminated),
    ("packed", packed),
]

# Tokenizers, trained models and components are beyond SQL; tests/llm/test_pipeline.py compares
# each stage and run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
