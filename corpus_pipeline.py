"""A corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and returns a
DataFrame that is written as Parquet and read again for the next. All but the last return the
columns of ``docs``, extra ones included. Rows come out as often as they came in unless a
stage's decision drops them.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import bagminhash, bigru, linededup, packing, winnowing
from tallyfield.llm.common import LAST_ID, keyed, lean, stored
from tallyfield.session import configure, load

#: Texts whose best language has less pooled probability than this are in no known language.
LEAST_SCORE = 0.4


def beside(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """``docs`` as d joined with ``other`` as r by document; the aliases keep like names apart."""
    own_id = F.coalesce(F.col("d.doc_id").cast("long"), F.lit(LAST_ID))
    own_tx = F.xxhash64(F.coalesce(F.col("d.text").cast("string"), F.lit("")))
    return docs.alias("d").join(other.alias("r"), (own_id == F.col("r._id")) & (own_tx == F.col("r._tx")), how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language the network knows.

    The network learns from the labelled rows outside the held-out fold. NULL texts, texts without a letter
    and texts of which no language has a probability of ``LEAST_SCORE`` go.
    """
    lean(spark)
    network = bigru.train(docs.where(~bigru.held_out()))
    unknown = (F.col("lang_pred") == bigru.UNKNOWN) | (F.col("score") < LEAST_SCORE)
    rejected = stored(bigru.identify(docs, network).where(unknown).select("_id", "_tx").distinct(), "stage-language")
    return beside(docs, rejected, "left_anti")


def kept_text(text: pd.Series, gone: pd.Series) -> pd.Series:
    return pd.Series([linededup.without_lines(t, g) if t is not None and g is not None else t for t, g in zip(text, gone)], dtype=object)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated lines out of the texts; a document that loses all its lines with words goes.

    ``n_chars`` follows the new text where the column exists. Documents that lose no line stay as they are.
    """
    lean(spark)
    gone = linededup.removed_lines(keyed(docs))
    kept = F.pandas_udf(kept_text, "string")(F.col("d.text"), F.col("r._gone"))
    marked = beside(docs, gone, "left").select("d.*", F.col("r._gone").isNotNull().alias("__cut"), kept.alias("__kept"))
    left = marked.where("not __cut or __kept is not null")
    new = {"text": F.col("__kept")}
    if "n_chars" in docs.columns:
        length = F.length("__kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("__cut"), length).otherwise(F.col("n_chars"))
    return left.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each class of near duplicates the document with the least id.

    Of texts that share that id the one with the least hash stays, and of rows that repeat both one.
    Texts without words are in no class and stay.
    """
    lean(spark)
    classes = stored(bagminhash.class_members(docs), "stage-classes")
    stays = (F.col("_head._id") == F.col("_id")) & (F.col("_head._tx") == F.col("_tx"))
    kept = beside(docs, classes.where(F.col("_words") & ~stays).select("_id", "_tx").distinct(), "left_anti")
    twice = classes.where(F.col("_words") & stays).groupBy("_id", "_tx").count().where("count > 1").select("_id", "_tx")
    twice = stored(twice, "stage-twice")
    if twice.limit(1).count():
        one = beside(kept, twice, "inner").select("d.*", "r._id", "r._tx").toDF(*docs.columns, "__id", "__tx").dropDuplicates(["__id", "__tx"])
        kept = beside(kept, twice, "left_anti").union(one.drop("__id", "__tx"))
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more are words of benchmark windows.

    NULL and empty texts have no words and stay, with or without an id; of repeated rows all go or all stay. Without benchmark items
    nothing goes, and an empty table stays empty. Other columns come out as they came.
    """
    lean(spark)
    found = winnowing.hits(docs, load(spark, sf_dir, "benchmark"))
    return beside(docs, stored(found.where("contaminated").select("_id", "_tx").distinct(), "stage-dirty"), "left_anti")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences of at most 2048 tokens; one row per piece.

    A NULL or empty text is one end token; repeated rows are packed as often as they come; a NULL id stays NULL. Only
    longer documents are cut. Other columns are left out, and an empty table gives an empty result.
    """
    lean(spark)
    path = public_tokenizers.path
    return packing.pack_documents(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: A trained network, near-duplicate classes and a packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written to the shared folder and read again."""
    docs = load(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
