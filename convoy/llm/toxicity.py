"""Toxicity of texts by a weighted finite-state grammar of clauses.

Words become symbols: insults (learnt, with a strength), verbs of violence, modal verbs, persons addressed,
negations, verbs of saying, quotation marks and turns ("but"). Four transducers, negation, reported speech,
threat and target, are composed into one table; it reads every clause and says for each insult or threat in
it whether it is plain, negated or reported, and for the clause whether it is aimed at somebody. The matches of
each kind, weighed by strength and kind, make the score; a word alone has no weight of its own.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.latent_quality import held_out
from convoy.llm.words import LETTER, STEP, UNSTEP, flat, mixed, runs

#: Labelled texts of each class that are learnt from at most, chosen by a hash of their ids.
SAMPLE_PER_CLASS = 20_000
#: Words and stems whose strength is learnt at most: those that tell the classes apart best.
MAX_UNITS = 1024
#: Stems are the first letters of a word.
STEMS = (4, 5, 6, 7)
#: Toxic texts that must use a unit, and how much more usual it must be in them than in others.
LEAST_TEXTS, LEAST_RATIO = 4, 3.0
#: A word is an insult from this log-odds on.
INSULT_FROM = 0.3
PREDICT_AT = 0.7

# Symbols of the grammar. Insults, violence and threats come plain, negated, reported and both.
NOTHING, MODAL, TARGET, NEGATION, REPORT, QUOTE, TURN = range(7)
INSULT, VIOLENCE, THREAT = 7, 11, 15
SYMBOLS = 19

#: Closed classes of words (fixed values).
CLOSED = {
    MODAL: "will would shall should must gonna going ll werde wirst werden vais va allons voy vas vamos",
    TARGET: "you your yours yourself u ur thou he him she her they them du dich dir dein deine ihr euch er sie tu te toi"
    " ton ta vous votre il elle ils elles usted ustedes tú ti vosotros él ella ellos",
    NEGATION: "not no never nobody none neither without isn aren wasn don doesn didn won nicht kein keine nie niemals ohne"
    " pas jamais aucun sans nunca jamás tampoco sin ningún",
    REPORT: "said says say saying told tells called calls claimed wrote quoted asked sagte sagt sagen nannte schrieb"
    " behauptete dit disait appelle écrit dijo dice llamó escribió",
    TURN: "but however yet aber jedoch sondern mais cependant pero sino",
    VIOLENCE: "kill hurt beat destroy burn stab shoot crush strangle murder töten umbringen schlagen vernichten tuer"
    " frapper brûler détruire matar golpear quemar destruir",
}

#: Log-odds of a threat, and shares of a match's strength that the grammar starts from: plain, negated, reported,
#: both; then the same for clauses that are aimed at somebody.
THREAT_STRENGTH = 4.0
START = np.array([1.0, 0.3, 0.6, 0.3, 1.1, 0.3, 0.6, 0.3] * 2)


class Transducer:
    """Next state and output of every state and symbol; unnamed symbols pass unchanged."""

    def __init__(self, states: int, rules: dict | None = None):
        self.next = np.repeat(np.arange(states, dtype=np.int16)[:, None], SYMBOLS, axis=1)
        self.out = np.repeat(np.arange(SYMBOLS, dtype=np.int16)[None], states, axis=0)
        for (state, symbol), (to, says) in (rules or {}).items():
            self.next[state, symbol], self.out[state, symbol] = to, says

    def then(self, other: "Transducer") -> "Transducer":
        """Composition: what this one says is what the other reads."""
        n, m = len(self.next), len(other.next)
        found = Transducer(n * m)
        for i in range(n):
            for j in range(m):
                said = self.out[i]
                found.next[i * m + j] = self.next[i] * m + other.next[j, said]
                found.out[i * m + j] = other.out[j, said]
        return found


def negation() -> Transducer:
    """A negation turns what follows in its clause; a second one turns it back."""
    rules = {(s, NEGATION): (1 - s, NOTHING) for s in (0, 1)} | {(1, TURN): (0, TURN)}
    return Transducer(2, rules | {(1, k): (1, k + 1) for k in (INSULT, VIOLENCE)})


def reported() -> Transducer:
    """What follows a verb of saying, or stands in quotation marks, is reported."""
    rules = {(s, REPORT): (s | 1, NOTHING) for s in range(4)} | {(s, QUOTE): (s ^ 2, NOTHING) for s in range(4)}
    rules |= {(s, TURN): (s & 2, NOTHING) for s in range(4)}
    hits = {(s, k + d): (s, k + d + 2) for s in (1, 2, 3) for k in (INSULT, VIOLENCE) for d in (0, 1)}
    return Transducer(4, rules | hits)


def threat() -> Transducer:
    """Violence is a threat after a modal verb and nothing without one."""
    rules = {(s, MODAL): (1, NOTHING) for s in (0, 1)}
    rules |= {(0, VIOLENCE + d): (0, NOTHING) for d in range(4)}
    return Transducer(2, rules | {(1, VIOLENCE + d): (1, THREAT + d) for d in range(4)})


def target() -> Transducer:
    """Whether somebody was addressed or pointed at: the last bit of the state."""
    return Transducer(2, {(s, TARGET): (1, NOTHING) for s in (0, 1)})


def grammar() -> tuple[np.ndarray, np.ndarray]:
    whole = reduce(Transducer.then, [negation(), reported(), threat(), target()])
    return whole.next, whole.out


KINDS = 16  # (insult, threat) x aimed x (plain, negated, reported, both)

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".!?;:\n"]] = True


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in lower case (ASCII and Latin-1) and which of them belong to words."""
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    if len(low) > 1:
        after_c3 = np.r_[False, data[:-1] == 0xC3]
        low[after_c3 & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    inside = _LETTERS[low]
    sign = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80)) if len(data) > 2 else np.empty(0, np.int64)
    for i in range(3):  # general punctuation, typographic quotes among it
        inside[sign + i] = False
    return low, inside


class Text:
    """Words of a few texts: their places, the hash of each whole word and of its stems."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        low, inside = _letters(data)
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
        self.ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        powers, back = np.full(n, STEP), np.full(n + 1, UNSTEP)
        powers[:1], back[0] = 1, 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(LETTER[low] * np.cumprod(powers), out=sums[1:])
        back = np.cumprod(back)

        def hashes(ends):
            return mixed((sums[ends] - sums[self.starts]) * back[self.starts])

        self.words = hashes(self.ends)
        heads = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of every character
        place = np.searchsorted(heads, self.starts)
        heads = np.r_[heads, n]
        self.stems = []
        for k in STEMS:
            end = heads[np.minimum(place + k, len(heads) - 1)]
            which = np.flatnonzero(end < self.ends)
            self.stems.append((which, mixed((sums[end[which]] - sums[self.starts[which]]) * back[self.starts[which]])))

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of every whole word and stem. Stems are marked, or they would be words."""
        which = [np.arange(len(self.words))] + [w for w, _ in self.stems]
        return np.concatenate(which), np.concatenate([self.words] + [h ^ np.uint64(1) for _, h in self.stems])


def _looked_up(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def closed_words() -> tuple[np.ndarray, np.ndarray]:
    """Hashes and symbols of the closed classes, sorted by hash."""
    names, symbols = zip(*[(w, s) for s, words in CLOSED.items() for w in words.split()])
    raw = [w.encode() for w in names]
    offsets = np.r_[0, np.cumsum([len(w) for w in raw])]
    hashes = Text(np.frombuffer(b"".join(raw), np.uint8), offsets).words
    order = np.argsort(hashes)
    return hashes[order], np.array(symbols, np.int8)[order]


def matches(text: Text, strength: np.ndarray, closed: tuple, table: tuple) -> np.ndarray:
    """Strength of the matched clauses of each text by kind.

    ``strength`` has one value per word; words from INSULT_FROM on are insults. All clauses that hold an insult or
    a verb of violence are read side by side, one symbol of each at a time.
    """
    found = np.zeros((len(text.offsets) - 1, KINDS))
    at = _looked_up(closed[0], text.words)
    symbol = np.where(at >= 0, closed[1][at], NOTHING)
    symbol[strength >= INSULT_FROM] = INSULT
    marked = np.flatnonzero(symbol)
    quotes = np.flatnonzero(text.data == ord('"'))
    place = np.r_[text.starts[marked], quotes]
    symbol, weight = np.r_[symbol[marked], np.full(len(quotes), QUOTE)], np.r_[strength[marked], np.zeros(len(quotes))]
    order = np.argsort(place, kind="stable")
    place, symbol, weight = place[order], symbol[order], weight[order]
    ends = np.union1d(np.flatnonzero(_BREAKS[text.data]), text.offsets[1:])
    clause = np.searchsorted(ends, place, "right")
    hot = np.unique(clause[(symbol == INSULT) | (symbol == VIOLENCE)])
    keep = _looked_up(hot, clause) >= 0
    place, symbol, weight, clause = place[keep], symbol[keep], weight[keep], np.searchsorted(hot, clause[keep])
    first = np.searchsorted(clause, np.arange(len(hot) + 1))
    by_length = np.argsort(-np.diff(first), kind="stable")
    lengths = np.diff(first)[by_length]
    state = np.zeros(len(hot), np.int16)
    said = np.zeros(len(symbol), np.int16)
    alive = len(hot)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        while alive and lengths[alive - 1] <= step:
            alive -= 1
        now = by_length[:alive]
        i = first[now] + step
        said[i] = table[1][state[now], symbol[i]]
        state[now] = table[0][state[now], symbol[i]]
    insult = (said >= INSULT) & (said < INSULT + 4)
    threats = said >= THREAT
    hit = insult | threats
    mode = np.where(insult, said - INSULT, said - THREAT)[hit]
    kind = np.where(insult, 0, 8)[hit] + 4 * (state[clause[hit]] % 2) + mode
    owner = np.searchsorted(text.offsets, place[hit], "right") - 1
    np.add.at(found, (owner, kind), np.where(threats, THREAT_STRENGTH, weight)[hit])
    return found


def _pieces(texts: pa.Array) -> Iterator[Text]:
    data, offsets = flat(texts)
    for a, b in runs(offsets):
        yield Text(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _strengths(text: Text, units: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log-odds of each word: the sum over itself and its stems, as far as they were learnt."""
    which, hashes = text.units()
    at = _looked_up(units, hashes)
    known = at >= 0
    return np.bincount(which[known], weights[at[known]], len(text.words)).astype(float)


def _sizes(text: Text) -> np.ndarray:
    """Hundreds of words of each text: long texts meet every stem by chance."""
    return np.diff(text.first) / 100.0


def logistic(features, labels: np.ndarray, weights: np.ndarray, pull: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Coefficients of a weighted logistic regression, drawn to ``start`` by ``pull`` (Newton, conjugate gradients).

    ``features`` is (row, column, value, number of rows, number of columns).
    """
    row, col, value, n, m = features

    def times(x):
        return np.bincount(row, value * x[col], n)

    def back(x):
        return np.bincount(col, value * x[row], m)

    def loss(x):
        z = times(x)
        return (weights * (np.logaddexp(0, z) - labels * z)).sum() + 0.5 * (pull * (x - start) ** 2).sum()

    x = start.copy()
    now = loss(x)
    for _ in range(40):
        p = 1 / (1 + np.exp(-times(x)))
        slope = back(weights * (p - labels)) + pull * (x - start)
        bend = weights * p * (1 - p)
        step, rest = np.zeros(m), -slope
        way, size = rest.copy(), (rest * rest).sum()
        goal = 1e-10 * size
        for _ in range(200):
            if size <= goal or size == 0:
                break
            curved = back(bend * times(way)) + pull * way
            move = size / (way * curved).sum()
            step += move * way
            rest = rest - move * curved
            size, old = (rest * rest).sum(), size
            way = rest + size / old * way
        length = 1.0
        while length > 1e-4 and loss(x + length * step) > now:
            length /= 2
        x = x + length * step
        then = loss(x)
        if now - then < 1e-8 * max(1.0, abs(now)):
            break
        now = then
    return x


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that use a unit, added up over the task's batches."""
    total: tuple = (np.empty(0, np.uint64), np.empty((0, 2), np.int64))
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        done = 0
        for text in _pieces(batch.column(1)):
            which, hashes = text.units()
            owner = text.owner()[which]
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            toxic = label[done + owner[new]] == 1
            done += len(text.offsets) - 1
            keys = np.r_[total[0], hashes[new]]
            counts = np.concatenate([total[1], np.stack([~toxic, toxic], 1)])
            names, at = np.unique(keys, return_inverse=True)
            sums = np.zeros((len(names), 2), np.int64)
            np.add.at(sums, at, counts)
            total = names, sums
        if len(total[0]) > 2_000_000:
            yield _unit_rows(total)
            total = (np.empty(0, np.uint64), np.empty((0, 2), np.int64))
    yield _unit_rows(total)


def _unit_rows(total: tuple) -> pa.RecordBatch:
    columns = [pa.array(total[0].view(np.int64)), pa.array(total[1][:, 0]), pa.array(total[1][:, 1])]
    return pa.RecordBatch.from_arrays(columns, ["unit", "clean", "toxic"])


def chosen_texts(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(label, text) of at most ``per_class`` labelled documents of each class, equal texts once.

    ``labels`` has doc_id and label; labels that are null, not 0 or 1, or of unknown documents teach nothing.
    """
    labels = labels.filter("label in (0, 1) and doc_id is not null").select("doc_id", F.col("label").cast("int"))
    order = F.xxhash64("doc_id"), "doc_id"
    sample = [labels.filter(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    ids = F.broadcast(sample[0].unionByName(sample[1]))  # at most 2 * per_class ids
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(ids, "doc_id")
    return found.select("label", "text").distinct()


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple:
    """Strengths of words and weights of clause kinds, as plain arrays.

    Units are counted by Spark. What comes to the driver is bounded: MAX_UNITS units, and of each of at most
    2 * ``per_class`` sampled texts its label, size and known units. Without labels of both classes no
    strength is learnt: only threats match, and texts without them get the share of label 1 among the labels,
    held within 0.05 and 0.5 (0.5 if there is none).
    """
    usable = labels.filter("label in (0, 1) and doc_id is not null")
    n, ones = usable.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = ones / n if n else 0.5
    bias = float(np.log(share / (1 - share))) if 0.05 < share < 0.5 else (-2.94 if n and share <= 0.05 else 0.0)
    plain = (np.empty(0, np.uint64), np.empty(0), START, np.array([bias, 0.0]))
    if not n or ones in (0, n):
        return plain
    from convoy.llm.tables import stored

    texts = stored(chosen_texts(docs, usable, per_class), "toxicity")
    seen = {r[0]: r[1] for r in texts.groupBy("label").count().collect()}
    if len(seen) < 2:
        return plain
    counts = texts.mapInArrow(_count_units, "unit long, clean long, toxic long").groupBy("unit")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    inside, outside = F.col("toxic") / seen[1], (F.col("clean") + 0.5) / (seen[0] + 1)
    best = counts.filter((F.col("toxic") >= LEAST_TEXTS) & (inside >= LEAST_RATIO * outside))
    best = best.orderBy((F.col("toxic") * F.log(inside / outside)).desc(), "unit").limit(MAX_UNITS)
    units = np.sort(np.array([r[0] for r in best.select("unit").collect()], np.int64).view(np.uint64))
    if not len(units):
        return plain

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Label, size and (unit, count) pairs of each text."""
        for batch in batches:
            sizes, pairs = [], []
            for text in _pieces(batch.column(1)):
                which, hashes = text.units()
                at = _looked_up(units, hashes)
                key = text.owner()[which[at >= 0]] * len(units) + at[at >= 0]
                key, count = np.unique(key, return_counts=True)
                cut = np.searchsorted(key, np.arange(len(text.offsets)) * len(units))
                for a, b in zip(cut[:-1], cut[1:]):
                    pairs.append(np.stack([key[a:b] % len(units), count[a:b]], 1).astype(np.int32).tobytes())
                sizes.append(_sizes(text))
            columns = [batch.column(0), pa.array(np.concatenate(sizes or [np.zeros(0)])), pa.array(pairs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "size", "pairs"])

    rows = texts.mapInArrow(known, "label int, size double, pairs binary").collect()
    rows = sorted((r["label"], r["size"], bytes(r["pairs"])) for r in rows)
    labelled, sizes = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    each = [np.frombuffer(r[2], np.int32).reshape(-1, 2) for r in rows]
    owner = np.repeat(np.arange(len(rows)), [len(e) for e in each])
    pairs = np.concatenate(each)
    weigh = np.where(labelled == 1, ones / (labelled == 1).sum(), (n - ones) / (labelled == 0).sum())
    weigh = weigh / weigh.mean()
    hit = np.unique(owner)  # size only matters where something is found
    k, m = len(rows), len(units)
    features = (
        np.r_[owner, np.arange(k), hit],
        np.r_[pairs[:, 0], np.full(k, m), np.full(len(hit), m + 1)],
        np.r_[pairs[:, 1].astype(float), np.ones(k), sizes[hit]],
        k,
        m + 2,
    )
    pull = np.r_[np.full(m, 0.3), 1e-3, 1e-2]
    found = logistic(features, labelled, weigh, pull, np.zeros(m + 2))
    strengths = found[:m]

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closed, table = closed_words(), grammar()
        for batch in batches:
            parts = [
                np.c_[matches(t, _strengths(t, units, strengths), closed, table), _sizes(t)] for t in _pieces(batch.column(1))
            ]
            both = np.concatenate(parts) if parts else np.zeros((0, KINDS + 1))
            columns = [batch.column(0), pa.array([r.tobytes() for r in both], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "found"])

    rows = sorted((r[0], bytes(r[1])) for r in texts.mapInArrow(kinds, "label int, found binary").collect())
    y = np.array([r[0] for r in rows])
    x = np.frombuffer(b"".join(r[1] for r in rows), float).reshape(-1, KINDS + 1).copy()
    x[x[:, :KINDS].sum(axis=1) == 0, KINDS] = 0
    x = np.c_[x, np.ones(len(x))]
    weigh = np.where(y == 1, ones / (y == 1).sum(), (n - ones) / (y == 0).sum())
    r, c = np.nonzero(x)
    start = np.r_[START, found[m + 1], found[m]]
    pull = np.r_[np.full(KINDS, 20.0), 1e-2, 1e-3]
    found = logistic((r, c, x[r, c], len(x), KINDS + 2), y, weigh / weigh.mean(), pull, start)
    return units, strengths, np.maximum(found[:KINDS], 0), found[[KINDS + 1, KINDS]]


def scores(model: tuple, texts: pa.Array, closed: tuple, table: tuple) -> np.ndarray:
    units, strengths, kinds, (bias, per_size) = model
    parts = []
    for text in _pieces(texts):
        found = matches(text, _strengths(text, units, strengths), closed, table)
        size = _sizes(text) * (found.sum(axis=1) > 0)
        z = found @ kinds + bias + np.minimum(per_size, 0) * size
        parts.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
    return np.concatenate(parts) if parts else np.zeros(0)


def score(docs: DataFrame, model: tuple, out: str = "score") -> DataFrame:
    """``docs`` with column ``out``: 0 to 1, higher when label 1 is likelier.

    Null counts as empty; texts without a matched clause, empty ones among them, get one score. Only ``text`` is
    read, whole, whatever its length. Equal texts get equal scores, rows may repeat, an empty table stays empty.
    ``out`` replaces a column of its name, others pass through.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # MAX_UNITS numbers at most

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        closed, table = closed_words(), grammar()
        for batch in batches:
            yield pa.array(scores(sent.value, batch, closed, table), pa.float64())

    return docs.withColumn(out, F.arrow_udf(run, "double")(F.col("text").cast("string")))


def is_held_out(id_column: Column) -> Column:
    return held_out(id_column, 3, 1)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from 0.7 on).

    ``labels`` has doc_id and toxic; those of held-out ids are not learnt from. Rows without an id are held out.
    """
    known = labels.select("doc_id", F.col("toxic").alias("label")).filter(~is_held_out(F.col("doc_id")))
    scored = score(docs.select("doc_id", "text"), learn(docs, known))
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
