"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

For each word of a document, with its count as weight, and each of ``samples`` draws, a gamma
variable r, a gamma variable c and a uniform shift are derived from hashes of word and draw.
The word with the least ``c / (y e^r)``, where y is the largest power below the weight on the
shifted grid of step r, is the sample, together with its grid step. Two documents agree in a
draw with a probability equal to their generalised Jaccard similarity, sum of minima over
sum of maxima of the weights.

Texts are shuffled once by document; counting words, sampling and gathering all keep that
placement, so no (document, word) rows are ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.llm.common import given_id, keyed, pieces, stored

SAMPLES = 32
#: What stands for a draw of a document without words.
NO_WORD = "--------"


def neighbours(keys: DataFrame) -> DataFrame:
    """For (_id, _tx, _n, _copies) the keys of the next document and key and length of the one before.

    The order is by id and text hash, and goes round at the ends. Rows are sorted in range
    pieces; only the ends of the pieces, a handful of rows, meet in one task.
    """
    n = pieces(keys.sparkSession)
    placed = stored(keys.repartitionByRange(n, "_id", "_tx").withColumn("_piece", F.spark_partition_id()), "neighbour-pieces")
    here = F.struct("_id", "_tx", "_n")
    inside, along = Window.partitionBy("_piece").orderBy("_id", "_tx"), Window.orderBy("_at")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = placed.groupBy(F.col("_piece").alias("_at")).agg(F.min(here).alias("_low"), F.max(here).alias("_high"))
    ends = ends.select(
        "_at",
        F.coalesce(F.lead("_low").over(along), F.first("_low").over(whole)).alias("_after"),
        F.coalesce(F.lag("_high").over(along), F.last("_high").over(whole)).alias("_before"),
    )
    return (
        placed.withColumn("_up", F.lead(here).over(inside))
        .withColumn("_down", F.lag(here).over(inside))
        .join(ends, F.col("_piece") == F.col("_at"))
        .select("_id", "_tx", "_copies", F.coalesce("_up", "_after").alias("_up"), F.coalesce("_down", "_before").alias("_down"))
        .select(
            "_id", "_tx", "_copies", F.col("_up._id").alias("_next_id"), F.col("_up._tx").alias("_next_tx"),
            F.col("_down._id").alias("_last_id"), F.col("_down._tx").alias("_last_tx"), F.col("_down._n").alias("_last_n"),
        )
    )


def uniform(hashed: Column, shift: int) -> Column:
    """One of the two 32-bit halves of a hash as a number strictly between 0 and 1."""
    half = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(0xFFFFFFFF))
    return (half.cast("double") + 0.5) / F.lit(float(2**32))


def sampled(words: DataFrame, weights: list[str], samples: int) -> DataFrame:
    """For (_id, _tx, _word, weights) one row per (_id, _tx, _draw) with a sample per weight."""
    hashes = [F.xxhash64("_word", "_draw", F.lit(i)) for i in range(3)]
    grown = words.withColumn("_draw", F.explode(F.array(*[F.lit(k) for k in range(samples)]))).select(
        "_id", "_tx", "_draw", "_word", *weights,
        (-F.log(uniform(hashes[0], 0) * uniform(hashes[0], 32))).alias("_r"),
        F.log(-F.log(uniform(hashes[1], 0) * uniform(hashes[1], 32))).alias("_c"),
        uniform(hashes[2], 32).alias("_shift"),
    )
    steps = grown.select(
        "*", *[F.when(F.col(w) > 0, F.floor(F.log(F.col(w).cast("double")) / F.col("_r") + F.col("_shift"))).alias(f"_step{w}") for w in weights]
    )
    best = [
        F.min_by(F.xxhash64("_word", f"_step{w}"), F.col("_c") - F.col("_r") * (F.col(f"_step{w}") - F.col("_shift")) - F.col("_r")).alias(w)
        for w in weights
    ]
    return steps.groupBy("_id", "_tx", "_draw").agg(*best)


def likeness(a: str, b: str, samples: int) -> Column:
    """The share of draws in which two lists of samples agree."""
    return F.size(F.filter(F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b")), lambda x: x["a"] == x["b"])) / F.lit(float(samples))


def fingerprints(docs: DataFrame, samples: int = SAMPLES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text, and their likeness.

    The edited text has the last floor(n/2) code points replaced by the first as many, or all, of
    the next document by id (after the last comes the first; ties by text hash; NULL ids last).
    Words end at white space. A NULL text is empty; documents without words agree
    with each other in every draw and with no other. Rows that repeat an id and a text are
    one document, whose result is given for each of the rows. A single document is its own next one. An empty
    table gives an empty result.
    """
    rows = keyed(docs, id_column, text_column)
    # copies are counted beside the keys: both uses of the texts then ask the same of their aggregate, and share its exchange
    keys = rows.groupBy("_id", "_tx", F.length("_text").alias("_n")).agg(F.count(F.lit(1)).alias("_copies"))
    around = stored(neighbours(keys), "fingerprint-neighbours")
    texts = rows.groupBy("_id", "_tx").agg(F.first("_text").alias("_text")).join(around.drop("_copies"), ["_id", "_tx"])
    heads = texts.select(
        F.col("_last_id").alias("_id"), F.col("_last_tx").alias("_tx"), F.left("_text", F.expr("_last_n div 2").cast("int")).alias("_head")
    )
    n = F.length("_text")
    edited = texts.join(heads, ["_id", "_tx"]).select(
        "_id", "_tx", "_text", n.alias("n_chars"), "_next_id", "_next_tx",
        F.concat(F.left("_text", n - F.expr("length(_text) div 2").cast("int")), "_head").alias("_edited"),
    )
    both = F.array(F.struct(F.lit(1).alias("own"), F.col("_text").alias("text")), F.struct(F.lit(0).alias("own"), F.col("_edited").alias("text")))
    split = F.split(F.translate("_side.text", "\t\n\x0b\f\r", "     "), " ")
    counted = (
        edited.select("_id", "_tx", F.explode(both).alias("_side"))
        .select("_id", "_tx", F.col("_side.own").alias("_own"), F.explode(split).alias("_term"))
        .where("_term != ''")
        .groupBy("_id", "_tx", F.xxhash64("_term").alias("_word"))
        .agg(F.sum("_own").alias("_w"), F.sum(F.lit(1) - F.col("_own")).alias("_v"))
    )
    as_text = lambda c: F.coalesce(F.substring(F.lpad(F.lower(F.hex(F.col(c))), 16, "0"), 9, 8), F.lit(NO_WORD)).alias(c)
    drawn = (
        sampled(counted, ["_w", "_v"], samples)
        .select("_id", "_tx", "_draw", as_text("_w"), as_text("_v"))
        .groupBy("_id", "_tx")
        .agg(F.sort_array(F.collect_list(F.struct("_draw", "_w", "_v"))).alias("_drawn"))
    )
    none = F.array(*[F.lit(NO_WORD)] * samples)
    found = stored(
        edited.select("_id", "_tx", "n_chars", "_next_id", "_next_tx", F.sha2("_edited", 256).alias("edited_sha256"))
        .join(drawn, ["_id", "_tx"], "left")
        .withColumn("_print", F.coalesce(F.col("_drawn._w"), none))
        .withColumn("_edit", F.coalesce(F.col("_drawn._v"), none))
        .drop("_drawn"),
        "fingerprints",
    )
    following = found.select(F.col("_id").alias("_next_id"), F.col("_tx").alias("_next_tx"), F.col("_print").alias("_next"))
    copies = around.select("_id", "_tx", "_copies")
    each = found.join(following, ["_next_id", "_next_tx"]).join(copies, ["_id", "_tx"]).withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)")))
    return each.select(
        given_id().alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        F.concat_ws("", "_print").alias("fingerprint"),
        F.concat_ws("", "_edit").alias("edited_fingerprint"),
        likeness("_print", "_edit", samples).alias("near_edited"),
        likeness("_print", "_next", samples).alias("near_next"),
    )
