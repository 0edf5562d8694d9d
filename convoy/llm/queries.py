"""Registered queries of the operators and their DuckDB counterparts.

Each query runs its operator with production parameters over its whole table.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from convoy.llm.bbit_minhash import near_duplicates
from convoy.llm.bpe import encoding_digests
from convoy.llm.hard_negatives import mined
from convoy.llm.latent_quality import quality
from convoy.llm.naming import exact_duplicates
from convoy.llm.pii import personal_data
from convoy.llm.ppm_language import language
from convoy.llm.ring import balanced_shards
from convoy.llm.suffix_dedup import PASSAGE_WORDS, remove_repeats
from convoy.llm.tables import table
from convoy.llm.token_counts import token_counts
from convoy.llm.toxicity import toxicity
from convoy.llm.whitening import whitened
from convoy.llm.wu_manber import contamination_digests

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bbit_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_bounded_ring(spark, sf_dir):
    return balanced_shards(table(spark, sf_dir, "documents"))


@query
def op3_induced_suffixes(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), passage_words=PASSAGE_WORDS)


@query
def op4_contextual_pii(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op5_latent_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_ppm_language(spark, sf_dir):
    return language(table(spark, sf_dir, "documents"))


@query
def op7_block_naming(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_wu_manber(spark, sf_dir):
    return contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_token_counts(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), path)


@query
def op10_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return encoding_digests(table(spark, sf_dir, "documents"), path)


@query
def op11_hilbert_negatives(spark, sf_dir):
    return mined(table(spark, sf_dir, "embeddings"))


@query
def op12_cholesky_whitening(spark, sf_dir):
    return whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_toxic_grammar(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op7_block_naming"] = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
     g AS (SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, t
           FROM d WINDOW w AS (PARTITION BY t))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(t) AS text_sha256
FROM g
"""

_WORDS = r"regexp_extract_all({}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')".format(_LOWER)

ORACLE["op8_wu_manber"] = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark
               WHERE item_id IS NOT NULL),
     patterns AS (
         SELECT DISTINCT item_id, least(len(w), 13) AS l,
                array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS k
         FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items
               WHERE len(w) > 0)),
     docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     places AS (
         SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS k
         FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
               FROM docs, (SELECT DISTINCT l FROM patterns))),
     found AS (SELECT doc_id, item_id, i, l FROM places JOIN patterns USING (l, k)),
     hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
             FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM found) GROUP BY doc_id),
     named AS (SELECT doc_id, count(*) AS n_items, string_agg(n, ',' ORDER BY n) AS names
               FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS n FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op1_bbit_minhash"] = rf"""
WITH RECURSIVE
     docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
     sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM docs
                    WHERE len(w) > 0)),
     sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
     common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
                FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
     links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
               WHERE 100 * c >= 75 * (p.n + q.n - c)),
     reached(doc_id, other) AS (
         SELECT doc_id, doc_id FROM documents
         UNION SELECT reached.doc_id, y FROM reached JOIN links ON x = other)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

ORACLE["op11_hilbert_negatives"] = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda c : floor(256 * c::DOUBLE)) AS x
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda c : c IS NULL OR NOT isfinite(c))) = 0),
     scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                       list_dot_product(a.x, b.x)::BIGINT AS score
                FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
     positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
