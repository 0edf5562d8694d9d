"""Corpus preparation: quality, exact copies, near copies, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of ``docs``; the last
returns the encoded documents. Rows whose id is null or repeated go through like others, each by its own
text; rows that repeat both id and text are one document. Empty tables give empty results. Columns of ``docs``
pass through; ``__score``, ``__found``, ``__coded``, ``__id`` and ``__sha`` are the pipeline's own names.
"""

import public_tokenizers
from pyspark.sql import functions as F

from convoy.llm.bbit_minhash import near_duplicates
from convoy.llm.bpe import encode
from convoy.llm.latent_quality import PREDICT_AT, held_out, learn, score
from convoy.llm.naming import exact_duplicates
from convoy.llm.tables import lower_ascii, stored, table
from convoy.llm.wu_manber import contamination, is_contaminated

#: The classifier has no SQL form, so the rows after it have none.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Documents that the classifier accepts."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = learn(docs, labels.filter(~held_out(F.col("doc_id"), 5, 0)))
    return score(docs, model, out="__score").filter(F.col("__score") >= PREDICT_AT).drop("__score")


def exact_dedup(spark, docs, sf_dir):
    """Of documents with equal text the one with the greatest id."""
    decided = stored(exact_duplicates(docs), "exact")
    kept = decided.filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    if not kept.groupBy("__id", "__sha").count().filter("count > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id", "text"])
    text = lower_ascii(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.sha2(text.cast("binary"), 256) == F.col("__sha"))
    return docs.join(kept, same, "left_semi")


def near_dedup(spark, docs, sf_dir):
    """Of documents that similarity connects the one with the smallest id."""
    text = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    found = near_duplicates(docs.select("doc_id", "text", text.alias("__sha")), carry="__sha")
    kept = stored(found.filter("kept").select(F.col("doc_id").alias("__id"), "__sha").distinct(), "near")
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (text == F.col("__sha"))
    return docs.join(kept, same, "left_semi")


def decontaminate(spark, docs, sf_dir):
    """Documents without passages of the benchmark."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"), out="__found")
    return found.filter(~is_contaminated(F.col("__found"))).drop("__found")


def tokens(spark, docs, sf_dir):
    """Token ids of the documents."""
    coded = encode(docs, public_tokenizers.path("word_bpe_49k.json"), out="__coded")
    code = F.col("__coded")
    names = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    return coded.select("doc_id", "lang", "source", *[code[n].alias(n) for n in names])


STAGES = [
    ("quality", quality),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("tokens", tokens),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
