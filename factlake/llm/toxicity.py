"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses at sentence marks and line ends, and its words become the symbols of five transducers:

- insult: a learned word (or the learned beginning of one) carries its log-odds, and a learned beginning that
  the text uses again the log-odds of being used twice;
- threat: a verb of harm after a sign of intent, or intent to end something of the target;
- target: the second person, or "is/are" before the insult;
- negation: "not", "never" and the like within ``REACH`` words before the match;
- reported speech: a verb of saying before the match, or quotation marks around it.

Composed, they read a clause from left to right with a small state: words since the last negation, intent, target and
report.  A match adds its weight, a target adds, negation and report take away.  A clause counts only if something in it
matched; the clause scores are combined as independent evidence and calibrated to (0, 1).

The insult lexicon and the calibration are learned from a bounded sample of labelled rows (``sample_rows`` per
label, those with the smallest hash of the text).  Null and empty texts get the score of a text without a match.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake.llm.text import documents
from factlake.session import materialize

THRESHOLD = 0.3
REACH = 4
#: Labelled rows of each label that are learned from at most.
SAMPLE_ROWS = 6000
#: Letters of the beginnings of words that are learned beside whole words.
STEMS = (4, 5, 6)

#: Function words of the grammar, in the languages at hand.
TARGET = frozenset("you your yours yourself u ur du dich dir dein deine sie ihr tu te toi vous ton ta tes usted tú ti vosotros eres".split())
COPULA = frozenset("is are am be being you're bist ist sind es est êtes sont eres son".split())
NEGATION = frozenset("not no never isn't aren't wasn't don't doesn't nobody nicht kein keine nie pas jamais aucun nunca jamás tampoco".split())
REPORT = frozenset("said says say wrote claimed claims called quoted reported sagte schrieb dit écrit appelé dijo escribió llamó".split())
INTENT = frozenset("will gonna going i'll we'll shall werde werden vais allons voy vamos".split())
HARM = frozenset("kill hurt murder destroy beat shoot stab töten schlagen umbringen tuer frapper matar golpear".split())
THREAT_WEIGHT, TARGET_BONUS, NEGATED, REPORTED = 4.0, 0.5, 0.25, 0.4

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;\n]+")


@dataclass(frozen=True)
class ToxicityModel:
    #: (word, log-odds) and (beginning, log-odds).
    words: tuple[tuple[str, float], ...]
    stems: tuple[tuple[str, float], ...]
    #: (beginning, log-odds of texts that use it twice or more).
    repeats: tuple[tuple[str, float], ...]
    #: Calibration: log-odds of a text without a match, and of each unit of evidence.
    bias: float
    slope: float


@functools.lru_cache(maxsize=2)
def _grammar(model: ToxicityModel):
    words, stems, repeats = dict(model.words), dict(model.stems), dict(model.repeats)
    # one pass over a text finds the clauses that can match at all
    automaton = ahocorasick.Automaton()
    for head in {*words, *stems, *repeats, *HARM}:
        automaton.add_word(head, len(head))
    automaton.make_automaton()
    return words, stems, repeats, automaton


def _weight(word: str, words: dict, stems: dict) -> float:
    if word in words:
        return words[word]
    return max((stems.get(word[:n], 0.0) for n in STEMS if len(word) >= n), default=0.0)


def clause_score(clause: str, words: dict, stems: dict, repeats: dict | None = None, used: set[str] | None = None) -> float:
    """Weight of the matches of one lower-case clause, by the composed transducer.

    ``used`` holds the beginnings in ``repeats`` that the text has used so far.
    """
    repeats, used = repeats or {}, set() if used is None else used
    score, last = 0.0, -1_000
    negated = target = intent = reported = last
    for k, m in enumerate(_WORD.finditer(clause)):
        w = m[0].replace("’", "'")
        if w in NEGATION:
            negated = k
        if w in TARGET or w in COPULA:
            target = k
        if w in REPORT:
            reported = k
        if w in INTENT:
            intent = k
        weight = _weight(w, words, stems)
        for head in {w[:n] for n in STEMS if w[:n] in repeats}:
            if head in used:
                weight = max(weight, repeats[head])
            used.add(head)
        if not weight and w in HARM and k - intent <= REACH:
            weight = THREAT_WEIGHT
        if not weight:
            continue
        if k - target <= REACH:
            weight += TARGET_BONUS
        if k - negated <= REACH:
            weight *= NEGATED
        quoted = clause[: m.start()].count('"') % 2 == 1 and '"' in clause[m.end() :]
        if k - reported <= 2 * REACH or quoted:
            weight *= REPORTED
        score += weight
    return score


def clauses(text: str) -> Iterator[tuple[int, int]]:
    start = 0
    for m in _CLAUSE.finditer(text):
        yield start, m.start()
        start = m.end()
    yield start, len(text)


def evidence(model: ToxicityModel, text: str | None) -> tuple[float, list[dict]]:
    """Sum of the clause scores, and the clauses that matched."""
    words, stems, repeats, automaton = _grammar(model)
    found: list[dict] = []
    used: set[str] = set()
    if not text:
        return 0.0, found
    low = text.lower()
    if len(low) != len(text):
        text = low  # spans then are those of the lower-case text
    hits = [a for end, n in automaton.iter(low) if (a := end - n + 1) == 0 or not low[a - 1].isalpha()]
    if not hits:
        return 0.0, found
    hits.sort()
    k = 0
    for a, b in clauses(low):
        if k < len(hits) and hits[k] < b:
            score = clause_score(low[a:b], words, stems, repeats, used)
            if score > 0:
                found.append({"start": a, "end": b, "score": score})
            while k < len(hits) and hits[k] < b:
                k += 1
    return sum(c["score"] for c in found), found


def probability(model: ToxicityModel, amount: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, model.bias + model.slope * amount))))


def draw(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """At most ``sample_rows`` ids of each label (``doc_id``, ``toxic``), those with the smallest hash, and how many rows each label has.

    Only ids are drawn; the few that are meet the texts without a shuffle of the texts.
    """
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    some = [rows.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for y in (0, 1)]
    return F.broadcast(materialize(some[0].union(some[1]))), totals


def _sampled(rows: DataFrame, counts: dict[int, int], sample_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """A bounded sample of labelled texts, copies folded, and its size by label."""
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    share = F.create_map(*(F.lit(x) for y, n in counts.items() for x in (y, float(min(1.0, (1.5 * sample_rows + 50) / n) * (1 << 30)))))
    near = rows.withColumn("place", place).where(F.col("place") < share[F.col("toxic")])
    # copies are folded into a count, so that no group of them meets in one task
    order = Window.partitionBy("toxic").orderBy("place", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    folded = near.groupBy("toxic", "place", "text").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(order))
    room = F.lit(sample_rows) - (F.col("upto") - F.col("n"))
    sample = materialize(folded.where(room > 0).select("text", "toxic", F.least("n", room).alias("n")))
    return sample, {y: min(n, sample_rows) for y, n in counts.items()}


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, most_words: int = 400, least_docs: int = 6, least_odds: float = 3.8, mixed_odds: float = 5.5, totals: dict[int, int] | None = None) -> ToxicityModel:
    """Learn from ``text`` and ``toxic`` (0/1) of ``labelled``.

    A word or beginning that a clean text of the sample has needs log-odds of ``mixed_odds``; any other, and the
    repeated use of a beginning, ``least_odds``.  ``totals`` says that ``labelled`` is a bounded sample already (see ``draw``)
    and how many rows each label has in all.

    Reaches the driver: two counts, at most ``most_words`` words and twice as many beginnings, and the evidence of the sample as
    grouped counts.
    """
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND text IS NOT NULL")
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return ToxicityModel((), (), (), 4.0 if counts.get(1) else -4.0, 0.0)
    if totals is not None:
        sample = materialize(rows.groupBy("text", "toxic").agg(F.count("*").alias("n")))
        sizes = counts
    else:
        sample, sizes = _sampled(rows, counts, sample_rows)

    def seen(batches):
        for batch in batches:
            out: dict[tuple[str, int, str], int] = {}
            for text, y, n in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "n"))):
                own = [m[0].replace("’", "'") for m in _WORD.finditer(text.lower())]
                heads = Counter(w[:k] for w in own for k in STEMS if len(w) >= k)
                kinds = ("word", set(own)), ("stem", heads), ("repeat", [w for w, uses in heads.items() if uses > 1])
                for kind, some in kinds:
                    for w in some:
                        out[w, y, kind] = out.get((w, y, kind), 0) + n
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in keys], pa.string()), pa.array([x[1] for x in keys], pa.int32()), pa.array([x[2] for x in keys], pa.string()), pa.array([out[x] for x in keys], pa.int64())],
                ["word", "toxic", "kind", "n"],
            )

    per_word = sample.mapInArrow(seen, "word string, toxic int, kind string, n long").groupBy("word", "kind").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good")
    )
    odds = F.log(((F.col("bad") + 0.5) / (sizes[1] + 1.0)) / ((F.col("good") + 0.5) / (sizes[0] + 1.0)))
    strong = per_word.withColumn("odds", odds).where((F.col("bad") >= least_docs) & (F.length("word") > 2))
    strong = strong.where(F.col("odds") >= F.when((F.col("kind") == "repeat") | (F.col("good") == 0), least_odds).otherwise(mixed_odds))
    learned = []
    for kind in ("word", "stem", "repeat"):
        best = strong.where(F.col("kind") == kind).orderBy(F.desc("odds"), F.desc("bad"), "word").limit(most_words).collect()
        learned.append(tuple(sorted((r["word"], round(r["odds"], 6)) for r in best)))
    model = ToxicityModel(*learned, 0.0, 1.0)

    # calibration on binned evidence of the same sample
    def bins(batches):
        for batch in batches:
            got = [min(40, int(2 * evidence(model, t)[0])) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), batch.column("toxic"), batch.column("n")], ["bin", "toxic", "n"])

    table = sample.mapInArrow(bins, "bin int, toxic int, n long").groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect()
    scale = {y: (totals or counts).get(y, sizes[y]) / sizes[y] for y in counts}  # the sample is even, the table is not
    return _calibrated(model, [((r["bin"] + (0.5 if r["bin"] else 0.0)) / 2, r["toxic"], r["n"] * scale[r["toxic"]]) for r in table])


def _calibrated(model: ToxicityModel, points: list[tuple[float, int, float]]) -> ToxicityModel:
    """Logistic regression in one variable, by damped Newton steps on the binned counts."""
    total = sum(n for _, _, n in points)
    bias, slope = -2.0, 1.0
    for _ in range(60):
        g0, g1, h00, h01, h11 = 1e-3 * bias, 1e-3 * slope, 1e-3, 0.0, 1e-3
        for x, y, n in points:
            p = 1 / (1 + math.exp(-max(-40.0, min(40.0, bias + slope * x))))
            w, e = n / total * p * (1 - p), n / total * (p - y)
            g0, g1, h00, h01, h11 = g0 + e, g1 + e * x, h00 + w, h01 + w * x, h11 + w * x * x
        det = h00 * h11 - h01 * h01
        step = ((h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det)
        size = max(1.0, abs(step[0]), abs(step[1]))
        bias, slope = bias - step[0] / size, slope - step[1] / size
    return ToxicityModel(model.words, model.stems, model.repeats, bias, max(0.0, slope))


_MATCHES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and the matched ``clauses`` of every row."""

    def run(batches):
        for batch in batches:
            got = [evidence(model, t) for t in batch.column("text").to_pylist()]
            p = [probability(model, g[0]) for g in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p, pa.float64()), pa.array([int(x >= threshold) for x in p], pa.int32()), pa.array([g[1] for g in got], _MATCHES)],
                ["doc_id", "score", "predicted", "clauses"],
            )

    return documents(docs).mapInArrow(run, "doc_id long, score double, predicted int, clauses array<struct<start:int,end:int,score:double>>")
