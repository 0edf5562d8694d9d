"""Personal data by bootstrapped contextual extraction.

Base entities (email, ip, card, phone) follow fixed rules and are the seeds. Around every seed, and around
every other string that could be an identifier, lexical patterns are taken: the words before and
after. Spark scores the graph of patterns and instances iteratively: a pattern is as good for a kind as
the share of what it surrounds that is known or believed to be of that kind; an unproven instance is believed as much
as its patterns together say. What scattered patterns with enough different seeds confirm is added to the base spans.

Texts are read once; afterwards only spans, patterns and counts are moved. Patterns in very many places
are summed before they are shuffled, and the joins on patterns can be split.
"""

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.tables import stored

#: Kinds in the order of reports, and the base rules.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match begins with a whole run of digits, so looking at run starts only finds the same and stays linear
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Strings that may be of a kind although they break its rule.
LOOSE = (
    ("email", None),  # see _around_at
    ("ip", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){2,3}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")),
)
_NO_ADDRESS = re.compile(r"[\s@,;<>()\"']")
HINT = re.compile(r"[0-9@]")
NEAR = 200  # characters of a word that a span cuts, see Neighbours
WORD_CHARS = 40  # of a neighbouring word in a pattern; longer words are told apart by their hash

ROUNDS = 3
LEAST_SCORE = 0.9
LEAST_SEEDS = 3  # different seeds of the kind that a pattern must surround


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ so that long words cost no more than they are long."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind."""
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        if 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((*m.span(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _neighbour(word: str) -> str:
    word = word.strip(".,;:!?()[]{}<>\"'").lower()
    return word if len(word) <= WORD_CHARS else hashlib.sha256(word.encode()).hexdigest()[:WORD_CHARS]


class Neighbours:
    """Words of a text, for the patterns around spans. A word that a span touches counts as far as it lies outside;
    what is left of it beyond NEAR characters is known by the whole word, which is hashed once."""

    def __init__(self, text: str):
        self.text = text
        self.places = [m.span() for m in re.finditer(r"\S+", text)]
        self.starts = [a for a, _ in self.places]
        self.known: dict[int, str] = {}

    def _word(self, i: int, a: int, b: int) -> str:
        if b - a <= NEAR:
            return _neighbour(self.text[a:b])
        if i not in self.known:
            self.known[i] = _neighbour(self.text[slice(*self.places[i])])
        return self.known[i]

    def patterns(self, start: int, end: int) -> list[str]:
        """Words before and after a span, alone and together."""
        i = bisect_left(self.starts, start)
        before = [self._word(k, a, min(b, start)) for k in range(max(0, i - 2), i) for a, b in [self.places[k]]]
        j = bisect_right(self.starts, end)
        j -= j > 0 and self.places[j - 1][1] > end
        right = ""
        if j < len(self.places):
            a, b = self.places[j]
            right = self._word(j, max(a, end), b)
        left = before[-1] if before else ""
        return [f"{left} _", f"_ {right}", f"{left} _ {right}", f"{' '.join(before)} _"]


def _bare(text: str, start: int, end: int) -> tuple[int, int]:
    """A word without the punctuation around it."""
    while start < end and text[start] in "([{<\"'":
        start += 1
    while end > start and text[end - 1] in ".,;:!?)]}>\"'":
        end -= 1
    return start, end


def mentions(text: str) -> tuple[list, list]:
    """Base spans, and (start, end, kind, role, instance, patterns) of all that could be an identifier:
    role 0 a seed, 1 unproven, 2 another word with digits or @, of no kind yet."""
    if not HINT.search(text):
        return [], []
    base = base_spans(text)
    taken = [(a, b) for a, b, _ in base]
    found = [(a, b, k, 0) for a, b, k in base]

    def free(spans: list[tuple[int, int]], own: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Those of ``own`` (in order) that touch none of ``spans`` (in order)."""
        out, i = [], 0
        for a, b in own:
            while i < len(spans) and spans[i][1] <= a:
                i += 1
            if i == len(spans) or spans[i][0] >= b:
                out.append((a, b))
        return out

    for kind, rule in LOOSE:
        if kind == "email" and "@" not in text:
            continue
        own = list(_around_at(text)) if kind == "email" else [m.span() for m in rule.finditer(text)]
        own = free(taken, own)
        found += [(a, b, kind, 1) for a, b in own]
        taken = sorted(taken + own)
    near = Neighbours(text)
    others = [_bare(text, a, b) for a, b in near.places if HINT.search(text, a, b)]
    found += [(a, b, "", 2) for a, b in free(taken, others)]
    found.sort()
    return base, [(a, b, k, r, text[a:b], near.patterns(a, b)) for a, b, k, r in found]


def _around_at(text: str) -> Iterator[tuple[int, int]]:
    """Strings around an @ up to the next sign that no address has, without stops at their end."""
    done, at = 0, text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > done and not _NO_ADDRESS.match(text[start - 1]):
            start -= 1
        while end < len(text) and not _NO_ADDRESS.match(text[end]):
            end += 1
        done = end
        while end > at + 1 and text[end - 1] in ".:!?":
            end -= 1
        if start < at and end > at + 1:
            yield start, end
        at = text.find("@", done)


def shown(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


_MENTIONS = pa.list_(
    pa.struct(
        [
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("kind", pa.string()),
            ("role", pa.int32()),
            ("instance", pa.string()),
            ("patterns", pa.list_(pa.string())),
        ]
    )
)


def _scan(batches):
    names = [f.name for f in _MENTIONS.value_type]
    for batch in batches:
        counts, shas, bases, found = [], [], [], []
        for text in batch.column("text").to_pylist():
            base, others = mentions(text or "")
            kinds = [k for _, _, k in base]
            counts.append([kinds.count(k) for k in KINDS])
            shas.append(hashlib.sha256(shown(base).encode()).hexdigest())
            bases.append(shown(base))
            found.append([dict(zip(names, (*o[:4], hashlib.sha256(o[4].encode()).hexdigest()[:32], o[5]))) for o in others])
        columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *columns, pa.array(shas, pa.string()), pa.array(bases, pa.string()), pa.array(found, _MENTIONS)],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "mentions"],
        )


def scores(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) from (pattern, instance, kind, role, n).

    Confidence is the believed share of what a pattern surrounds, less what one unknown more would take away; it is 0 for
    patterns with fewer than LEAST_SEEDS different seeds of the kind.
    """
    totals = stored(edges.groupBy("pattern").agg(F.sum("n").alias("all")), "pattern-totals")
    seeds = edges.filter("role = 0").groupBy("pattern", "kind").agg(
        F.sum("n").alias("sure"), F.count(F.lit(1)).alias("different")
    )
    seeds = stored(seeds.filter(F.col("different") >= LEAST_SEEDS).join(totals, "pattern"), "pattern-seeds")
    near_miss = edges.filter("role = 1").select("pattern", "kind", "instance", "n")
    near_miss = near_miss.join(seeds.select("pattern", "kind"), ["pattern", "kind"], "left_semi")
    # another word may be of every kind that its patterns surround
    words = edges.filter("role = 2").select("pattern", "instance", "n").join(seeds.select("pattern", "kind"), "pattern")
    unproven = stored(near_miss.unionByName(words), "unproven")
    confidence = seeds.select("pattern", "kind", (F.col("sure") / (F.col("all") + 1)).alias("confidence"))
    for _ in range(rounds - 1):
        confidence = stored(confidence, "confidence")
        doubt = F.exp(F.sum(F.log1p(-F.col("confidence"))))
        belief = unproven.join(confidence, ["pattern", "kind"]).groupBy("instance", "kind").agg((1 - doubt).alias("belief"))
        believed = (
            unproven.join(stored(belief, "belief"), ["instance", "kind"])
            .groupBy("pattern", "kind")
            .agg(F.sum(F.col("n") * F.col("belief")).alias("believed"))
        )
        confidence = seeds.join(stored(believed, "believed"), ["pattern", "kind"], "left").select(
            "pattern",
            "kind",
            ((F.col("sure") + F.coalesce("believed", F.lit(0.0))) / (F.col("all") + 1)).alias("confidence"),
        )
    return stored(confidence, "confidence")


def personal_data(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans.

    ``spans`` lists kind:start:end (code points, end exclusive) of base and added spans by start, then kind. Null
    counts as empty; a text without digits and @ has no spans. Repeated rows count each, also as evidence
    that a pattern is used, but one instance is one seed. Further columns are ignored; an empty table gives an
    empty result.
    """
    counted = ", ".join(f"n_{k} long" for k in KINDS)
    schema = (
        f"doc_id long, {counted}, base_sha256 string, base string, mentions array<struct<start:long,end:long,"
        "kind:string,role:int,instance:string,patterns:array<string>>>"
    )
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = stored(source.mapInArrow(_scan, schema).withColumn("row", F.monotonically_increasing_id()), "mentions")
    placed = rows.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    placed = placed.withColumn("pattern", F.explode("patterns")).drop("patterns")
    edges = placed.groupBy("pattern", "instance", "kind", "role").agg(F.count(F.lit(1)).alias("n"))
    confidence = scores(stored(edges, "edges"))
    doubt = F.exp(F.sum(F.log1p(-F.col("confidence"))))
    at = ["row", "start", "end", "pattern", "kind"]
    near_miss = placed.filter("role = 1").select(*at).join(confidence, ["pattern", "kind"])
    words = placed.filter("role = 2").select(*at[:-1]).join(confidence, "pattern")
    scored = near_miss.unionByName(words.select(near_miss.columns)).groupBy("row", "start", "end", "kind")
    scored = scored.agg((1 - doubt).alias("score")).filter(F.col("score") >= least_score)
    # of several kinds the likeliest, then the first in alphabetical order
    best = F.max_by("kind", F.struct("score", -F.ascii("kind"))).alias("kind")
    added = (
        scored.groupBy("row", "start", "end")
        .agg(best)
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "end", "kind")).alias("added"))  # of one text
    )
    number = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    base = F.transform(
        F.filter("mentions", lambda m: m["role"] == 0),
        lambda m: F.struct(m["start"].alias("start"), number[m["kind"]].alias("rank"), m["end"].alias("end"), m["kind"].alias("kind")),
    )
    more = F.transform(
        F.coalesce("added", F.expr("cast(array() as array<struct<start:bigint,end:bigint,kind:string>>)")),
        lambda m: F.struct(m["start"].alias("start"), number[m["kind"]].alias("rank"), m["end"].alias("end"), m["kind"].alias("kind")),
    )
    spans = F.transform(
        F.array_sort(F.concat(base, more)),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return rows.join(stored(added, "added"), "row", "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", F.array_join(spans, ",").alias("spans")
    )
