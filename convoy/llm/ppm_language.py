"""Language of texts by prediction by partial matching over bytes.

For every language a tree of contexts of up to three bytes counts what followed. The code length of a byte is
taken at the deepest context of the language that precedes it; a byte not seen there costs an
escape (method C: as likely as the number of different bytes seen) and is coded one byte of context shorter, down to
equal chances for all 256 bytes. The counts are frozen after learning, so the length of every byte in
every context is a table, and a text's code length in all languages is a sum of looked-up rows. The
language with the shortest code wins.

Counts cover the whole of all learnt texts and all contexts; nothing is left out, however rare the string or the language.
Spark sums them, finds the distinct four-byte strings of the texts to be told, and joins each with its counts of
orders 0 to 3. The finished rows reach the texts in pieces of at most TABLE_CELLS cells, one after the other: a
larger table makes more passes, not a smaller model.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.latent_quality import held_out
from convoy.llm.tables import stored
from convoy.llm.words import LOWER, flat, runs

ORDER = 3
#: Cells (a four-byte string in a language) that the driver and a task hold at once.
TABLE_CELLS = 4 << 20
UNDETERMINED = "und"


@dataclass(frozen=True)
class Tree:
    """Names of the languages in order, and all counts: (lang, gram, n), lang being the place in the list."""

    languages: list[str]
    counts: DataFrame


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with a context of blanks before each text, and where the text's bytes are."""
    texts = np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    places = np.arange(len(data)) + ORDER * texts
    signs = np.full(len(data) + ORDER * (len(offsets) - 1), 32, np.uint8)
    signs[places] = LOWER[data]
    return signs, places


def _grams(data: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Each byte of a run of texts with the three before it, the byte itself in the lowest place."""
    signs, at = padded(data[part[0] : part[-1]], part - part[0])
    x = signs.astype(np.uint32)
    return x[at - 3] << np.uint32(24) | x[at - 2] << np.uint32(16) | x[at - 1] << np.uint32(8) | x[at]


def _gram_counts(batches):
    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), object)
        for language in sorted(set(languages.tolist())):
            data, offsets = flat(batch.column("text").filter(pa.array(languages == language)))
            for a, b in runs(offsets, 8 << 20):
                part = offsets[a : b + 1]
                grams, counts = np.unique(_grams(data, part), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([language] * len(grams), pa.string()),
                        pa.array(grams.astype(np.int64)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )


def learn(docs: DataFrame) -> Tree | None:
    """Tree of the texts of ``docs`` (lang, text). Rows without lang teach nothing; without any, None."""
    known = docs.filter("lang is not null and text is not null").select("lang", "text")
    counts = known.mapInArrow(_gram_counts, "lang string, gram long, n long")
    counts = stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts")
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    places = docs.sparkSession.createDataFrame(list(enumerate(languages)), "place int, lang string")
    counts = counts.join(F.broadcast(places), "lang")
    return Tree(languages, counts.select(F.col("place").alias("lang"), "gram", "n"))


def _code_table(docs: DataFrame, tree: Tree) -> DataFrame:
    """(gram, lang, bits): the code length of the last byte of every four-byte string of ``docs``, in every language."""
    texts = docs.select(F.lit("").alias("lang"), F.col("text").cast("string").alias("text"))
    met = texts.mapInArrow(_gram_counts, "lang string, gram long, n long").select("gram").distinct()
    met = stored(met, "grams")
    languages = docs.sparkSession.range(len(tree.languages)).select(F.col("id").cast("int").alias("lang"))
    shorter = None
    for order in range(ORDER + 1):
        string = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)).alias("string")
        context = F.shiftright("string", 8).alias("context")
        seen = tree.counts.groupBy("lang", string).agg(F.sum("n").alias("n"))
        seen = stored(seen.withColumn("context", context), "strings")
        contexts = seen.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        wanted = met.select(string).distinct().crossJoin(F.broadcast(languages)).withColumn("context", context)
        found = wanted.join(seen.drop("context"), ["lang", "string"], "left").join(contexts, ["lang", "context"], "left")
        if shorter is None:
            found = found.withColumn("above", F.lit(1 / 256))
        else:
            found = found.withColumn("end", F.col("string").bitwiseAND(F.lit((1 << 8 * order) - 1))).join(
                shorter.select("lang", F.col("string").alias("end"), F.col("chance").alias("above")), ["lang", "end"]
            )
        room = F.col("total") + F.col("kinds")
        chance = F.coalesce(F.col("n") / room, F.col("kinds") / room * F.col("above"), F.col("above"))
        shorter = stored(found.select("lang", "string", chance.alias("chance")), "chances")
    return shorter.select(F.col("string").alias("gram"), "lang", (-F.log2("chance")).cast("float").alias("bits"))


def code_lengths(grams: np.ndarray, bits: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text in each language, of those bytes that end one of the sorted ``grams``; the last row of ``bits``
    is for all others."""
    found = np.zeros((len(offsets) - 1, bits.shape[1]))
    for a, b in runs(offsets):
        part = offsets[a : b + 1]
        if part[-1] == part[0]:
            continue
        x = _grams(data, part)
        at = np.searchsorted(grams, x)
        at[grams[np.minimum(at, len(grams) - 1)] != x] = len(grams)
        filled = np.flatnonzero(np.diff(part) > 0)
        found[a + filled] = np.add.reduceat(bits[at], (part - part[0])[:-1][filled], axis=0, dtype=np.float64)
    return found


def predict(docs: DataFrame, tree: Tree | None, out: str = "language", cells: int = TABLE_CELLS) -> DataFrame:
    """``docs`` with a struct column ``out``: lang_pred, score.

    ``score`` is the chance of the language if all were equally likely before. Texts that are null or have
    no letter are ``und`` with score 0, and so is every text if nothing was learnt. Ties go to
    the first language by name. ``out`` replaces a column of its name, others pass through, but ``__guess`` is the operator's own name.
    ``docs`` is read twice, and once more for each further ``cells`` cells of the table.
    """
    text = F.col("text").cast("string")
    if tree is None:
        return docs.withColumn(out, F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score")))
    table = _code_table(docs, tree)
    wide = len(tree.languages)
    pieces = max(1, -(-table.count() // max(cells, wide)))
    piece = F.pmod(F.xxhash64("gram"), F.lit(pieces))
    docs = docs.withColumn("__guess", F.array_repeat(F.lit(0.0), wide))
    for i in range(pieces):
        rows = table.filter(piece == i).toArrow()
        gram, lang = rows.column("gram").to_numpy(), rows.column("lang").to_numpy()
        order = np.lexsort((lang, gram))
        bits = np.zeros((len(order) // wide + 1, wide), np.float32)
        bits[:-1] = rows.column("bits").to_numpy()[order].reshape(-1, wide)
        sent = docs.sparkSession.sparkContext.broadcast((gram[order][::wide].astype(np.uint32), bits))
        if i:
            docs = stored(docs, "lengths")
        docs = docs.withColumn("__guess", _add_lengths(sent)(text, F.col("__guess")))
    names = F.array(*[F.lit(x) for x in tree.languages])
    least = F.array_min("__guess")
    chance = 1 / F.aggregate("__guess", F.lit(0.0), lambda s, x: s + F.pow(F.lit(2.0), least - x))
    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    chosen = F.struct(
        F.when(letter, F.element_at(names, F.array_position("__guess", least).cast("int"))).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(letter, chance).otherwise(0.0).alias("score"),
    )
    return docs.withColumn(out, chosen).drop("__guess")


def _add_lengths(sent):
    """A column function: code lengths so far and those by the sent piece of the table."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        grams, bits = sent.value
        for texts, before in batches:
            own = np.zeros((len(texts), bits.shape[1])) if not len(grams) else code_lengths(grams, bits, *flat(texts))
            total = own + before.flatten().to_numpy(zero_copy_only=False).reshape(own.shape)
            ends = np.arange(len(total) + 1, dtype=np.int32) * bits.shape[1]
            yield pa.ListArray.from_arrays(ends, pa.array(total.reshape(-1)))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<double>")


def language(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score. Held-out rows are not learnt from;
    rows without an id are held out; an empty table gives an empty result."""
    held = held_out(F.col("doc_id"), 4, 2)
    tree = learn(docs.filter(~held))
    done = predict(docs.select("doc_id", "text"), tree)
    return done.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score")
