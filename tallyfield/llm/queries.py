"""The corpus operators bound to the supplied tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import bagminhash, bigru, bitslices, collisions, fmindex, linededup, packing, residues, secretscan, sharding, sparsesuffix, weightedsampling, winnowing
from tallyfield.llm.common import lean
from tallyfield.session import configure, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, base: str) -> DataFrame:
        return f(lean(configure(spark)), base)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return run


@query
def op5_sharding(spark: SparkSession, base: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, equal texts together."""
    out = sharding.shard(load(spark, base, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op8_secret_scan(spark: SparkSession, base: str) -> DataFrame:
    """Counts and spans of secrets in every text."""
    out = secretscan.scan(load(spark, base, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random")


@query
def op9_packing(spark: SparkSession, base: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    path = public_tokenizers.path
    return packing.pack_documents(load(spark, base, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


@query
def op7_decontamination(spark: SparkSession, base: str) -> DataFrame:
    """Words of every document that occur in windows of benchmark items."""
    out = winnowing.decontaminate(load(spark, base, "documents"), load(spark, base, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op6_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Words of every document left after removing windows that an earlier document holds."""
    out = fmindex.dedup_substrings(load(spark, base, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_suffix_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Passages of 50 words and more that other documents repeat."""
    return sparsesuffix.repeated_passages(load(spark, base, "documents"))


@query
def op10_fingerprints(spark: SparkSession, base: str) -> DataFrame:
    """Fingerprints of every text and its edited text, with their likeness."""
    return weightedsampling.fingerprints(load(spark, base, "documents"))


@query
def op2_minhash_dedup(spark: SparkSession, base: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return bagminhash.near_duplicates(load(spark, base, "documents"))


@query
def op3_line_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Lines of every document left after removing repeats of earlier lines."""
    out = linededup.line_report(load(spark, base, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op1_language_id(spark: SparkSession, base: str) -> DataFrame:
    """The language of every text, learned from the documents outside the held-out fold."""
    return bigru.language_report(load(spark, base, "documents"))


@query
def op11_embedding_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Links and components of all vectors of a label by cosine."""
    return collisions.near_vectors(load(spark, base, "embeddings"))


@query
def op12_ranked_search(spark: SparkSession, base: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return bitslices.ranked(load(spark, base, "documents"), load(spark, base, "benchmark"))


@query
def op13_hard_negatives(spark: SparkSession, base: str) -> DataFrame:
    """Hard negatives of every anchor and positive among all vectors."""
    return residues.mine(load(spark, base, "embeddings"))


# ---- SQL of the queries that SQL can express ----

_SUBSTRINGS = r"""WITH w AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)),
early AS (SELECT k, MIN(doc_id) AS m FROM win GROUP BY k),
hit AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN early USING (k) WHERE m < doc_id)),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, COUNT(*) AS n FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY 1)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = f"regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WINDOWS = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
test AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM item)),
win AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM item))),
met AS (SELECT doc_id, n, i, item_id FROM win JOIN test USING (n, k)),
hit AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY 1),
ids AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit, CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items,
  sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)"""

_NEGATIVES = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
    CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(ROW_NUMBER() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY ROW_NUMBER() OVER w <= 3"""

_LINKED = """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v AS a JOIN v AS b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach AS r JOIN link AS l ON r.y = l.x),
low AS (SELECT x, MIN(y) AS y FROM reach GROUP BY x), many AS (SELECT x, COUNT(*) AS n FROM link GROUP BY x)
SELECT vec_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_links, CAST(LEAST(vec_id, COALESCE(y, vec_id)) AS BIGINT) AS component_id,
  vec_id = LEAST(vec_id, COALESCE(y, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON vec_id = low.x LEFT JOIN many ON vec_id = many.x"""

_RANKED = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
size AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
every AS (SELECT CAST(COUNT(*) AS BIGINT) AS n_docs, CAST(SUM(n) AS BIGINT) AS n_words FROM size),
tf AS (SELECT r, t, COUNT(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY 1, 2),
item AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_WORDS}) AS t FROM benchmark)),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM tf, every GROUP BY t, n_docs),
score AS (SELECT item_id, r, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM item JOIN tf USING (t) JOIN weight USING (t) JOIN size USING (r), every GROUP BY 1, 2)
SELECT item_id, CAST(ROW_NUMBER() OVER w AS INTEGER) AS rank, doc_id, score FROM score JOIN size USING (r) WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY ROW_NUMBER() OVER w <= 10"""


ORACLES.update(
    op6_substring_dedup=_SUBSTRINGS,
    op7_decontamination=_WINDOWS,
    op11_embedding_dedup=_LINKED,
    op12_ranked_search=_RANKED,
    op13_hard_negatives=_NEGATIVES,
)
