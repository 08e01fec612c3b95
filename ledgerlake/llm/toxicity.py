"""Toxicity by a weighted finite-state grammar over clauses.

A clause is read as a string of classes: insult, threat, target, negation,
reporting word, any other word. Five transducers rewrite and weigh it, one
after the other: negation takes most of the weight of what it denies, reported
speech that of what is quoted from others, a target near an insult or a threat
adds to it, and insults and threats are scored last. They are composed into one
transducer once; a clause is scored by one walk through it. Which words are
insults, and their weights, is learned from labels; targets, threats, negation
and reporting words are fixed.

Learning (a documented bound): of either label the first ``SAMPLE_DOCS``
labelled rows in the order of a hash of their id, without texts that share
their least long word (near copies of each other). The lexicon holds at most
``LEXICON`` words and word beginnings. The clause scores of a text are summed
and turned into a probability by logistic regression, with the share of toxic
rows among all labelled rows as prior.

Defined results: a null text counts as empty; without a matched clause the
score is that of an empty text; without any labels of both kinds every score is
the share of toxic rows, 0 without labels; of several labels of one id the
largest counts; repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import in_tasks, small_slices

SAMPLE_DOCS = 2500
LEXICON = 300
STEM_CHARS = range(4, 9)
LEAST_SUPPORT, LEAST_SHARE, LEAST_ODDS = 4, 0.004, 2.5

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
QUOTED, DENIED = 6, 7  # insult or threat, as rewritten
CLASSES = 8
REACH = 4  # words over which negation and targets act

# Fixed word lists.
TARGETS = frozenset("you your yours yourself u he she him her they them these those it this that tu vous du ihr sie ustedes".split())
NEGATIONS = frozenset("not no never nobody isn isnt aren arent wasn wasnt don dont doesn doesnt nicht kein keine pas jamais no nunca".split())
REPORTS = frozenset("said says say told wrote writes called calls quoted quote reported according sagte schrieb dit écrit dijo escribió".split())
THREATS = frozenset("kill killed hurt destroy murder attack beat shoot stab burn töten tuer matar".split())

_CLAUSE = re.compile(r"[.!?;:\n]+")
_WORD = re.compile(r"[^\W\d_]+")


# --- transducers ---


@dataclass
class Transducer:
    """A deterministic transducer: (state, class) to (state, class written, weight factor)."""

    start: tuple = (0,)
    arcs: dict = field(default_factory=dict)

    def add(self, state: tuple, read: int, to: tuple, write: int, factor: float = 1.0) -> None:
        self.arcs[state, read] = (to, write, factor)


def counting(trigger: int, rewrites: dict[int, tuple[int, float]], reach: int) -> Transducer:
    """After ``trigger``, for ``reach`` words, rewrite some classes and multiply the weight."""
    out = Transducer()
    for left in range(reach + 1):
        for read in range(CLASSES):
            to = (reach,) if read == trigger else (max(0, left - 1),)
            write, factor = rewrites.get(read, (read, 1.0)) if left else (read, 1.0)
            out.add((left,), read, to, write, factor)
    return out


def negation() -> Transducer:
    return counting(NEGATION, {INSULT: (DENIED, 0.2), THREAT: (DENIED, 0.2)}, REACH)


def reported() -> Transducer:
    """Speech that is reported lasts to the end of the clause."""
    out = Transducer()
    for inside in (0, 1):
        for read in range(CLASSES):
            quoted = inside and read in (INSULT, THREAT)
            out.add((inside,), read, (1 if read == REPORT else inside,), QUOTED if quoted else read, 0.4 if quoted else 1.0)
    return out


def target() -> Transducer:
    return counting(TARGET, {k: (k, 1.5) for k in (INSULT, THREAT, QUOTED)}, REACH)


def insult() -> Transducer:
    """An insult right after another one weighs more."""
    return counting(INSULT, {INSULT: (INSULT, 1.2)}, 1)


def threat() -> Transducer:
    """A threat counts only with a target after it; before, the target transducer has raised it."""
    out = Transducer()
    for read in range(CLASSES):
        out.add((0,), read, (0,), read, 0.5 if read == THREAT else 1.0)
    return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One transducer that does what the two do one after the other."""
    out = Transducer(first.start + second.start)
    split = len(first.start)
    queue, seen = deque([out.start]), {out.start}
    while queue:
        state = queue.popleft()
        for read in range(CLASSES):
            to, middle, factor = first.arcs[state[:split], read]
            then, write, more = second.arcs[state[split:], middle]
            out.add(state, read, to + then, write, factor * more)
            if to + then not in seen:
                seen.add(to + then)
                queue.append(to + then)
    return out


def grammar() -> Transducer:
    whole = negation()
    for part in (reported(), target(), insult(), threat()):
        whole = compose(whole, part)
    return whole


# --- scoring ---


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]  # word, or word beginning, to weight
    slope: float
    offset: float

    def __post_init__(self):
        self.arcs = grammar()
        self.lengths = sorted({len(s) for s in self.lexicon}, reverse=True)
        # One search tells the texts that hold nothing of interest.
        heads = sorted(self.lexicon) + sorted(THREATS)
        self.any = re.compile(r"\b(?:" + "|".join(map(re.escape, heads)) + ")") if heads else None

    def weight(self, word: str) -> float:
        for n in self.lengths:
            if n <= len(word) and (found := self.lexicon.get(word[:n])):
                return found
        return 0.0

    def clause(self, words: list[str]) -> float:
        state, total = self.arcs.start, 0.0
        for word in words:
            weight = self.weight(word)
            if weight:
                kind = INSULT
            elif word in THREATS:
                kind, weight = THREAT, 1.0
            elif word in NEGATIONS:
                kind = NEGATION
            elif word in TARGETS:
                kind = TARGET
            elif word in REPORTS:
                kind = REPORT
            else:
                kind = OTHER
            state, _, factor = self.arcs.arcs[state, kind]
            total += weight * factor
        return total

    def total(self, text: str | None) -> float:
        """Sum of the clause scores."""
        low = (text or "").lower()
        if not low or self.any is None or not self.any.search(low):
            return 0.0
        return sum(
            self.clause(_WORD.findall(part)) for part in _CLAUSE.split(low) if self.any.search(part)
        )

    def score(self, text: str | None) -> float:
        z = self.offset + self.slope * math.log1p(self.total(text))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


# --- learning ---


def candidates(text: str) -> set[str]:
    """Words of a text, and their beginnings."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        if len(word) >= min(STEM_CHARS):
            found.add(word)
            found.update(word[:n] for n in STEM_CHARS if n < len(word))
    return found


def learn_lexicon(texts: list[str], toxic: list[int]) -> dict[str, float]:
    """Words and beginnings that toxic texts hold far more often, weighted by their log odds."""
    with_it, without = Counter(), Counter()
    n_toxic = sum(toxic)
    n_clean = len(toxic) - n_toxic
    for text, label in zip(texts, toxic):
        (with_it if label else without).update(candidates(text))
    least = max(LEAST_SUPPORT, LEAST_SHARE * n_toxic)
    ranked = []
    for word, n in with_it.items():
        if n < least:
            continue
        odds = math.log((n + 0.5) / (n_toxic - n + 0.5)) - math.log((without[word] + 0.5) / (n_clean - without[word] + 0.5))
        if odds >= LEAST_ODDS:
            ranked.append((-n * odds, -len(word), word, odds))  # of equal evidence the longest
    chosen: dict[str, float] = {}
    for _, _, word, odds in sorted(ranked):
        related = any(word.startswith(s) or s.startswith(word) for s in chosen)
        if not related and len(chosen) < LEXICON:
            chosen[word] = odds
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset, by Newton steps with a light ridge."""
    features = np.column_stack([x, np.ones_like(x)])
    ridge = np.diag([1e-2, 1e-4])
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ theta, -30, 30)))
        gradient = features.T @ (weight * (y - p)) - ridge @ theta
        hessian = (features * (weight * p * (1 - p))[:, None]).T @ features + ridge
        step = np.linalg.solve(hessian, gradient)
        theta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def learn(texts: list[str], toxic: list[int], share: float) -> ToxicityModel:
    if not 0 < sum(toxic) < len(toxic):
        return ToxicityModel({}, 0.0, -60.0 if share <= 0 else 60.0 if share >= 1 else math.log(share / (1 - share)))
    # The lexicon is learned on one half and the curve on the other, so that rare words do not flatter it.
    lexicon = learn_lexicon(texts[::2], toxic[::2])
    model = ToxicityModel(lexicon, 0.0, 0.0)
    x = np.log1p([model.total(t) for t in texts[1::2]])
    y = np.array(toxic[1::2], dtype=float)
    if not 0 < y.sum() < len(y):
        x, y = np.log1p([model.total(t) for t in texts]), np.array(toxic, dtype=float)
    share = min(max(share, 1e-6), 1 - 1e-6)
    weight = np.where(y > 0, share / max(1e-9, y.mean()), (1 - share) / max(1e-9, 1 - y.mean()))
    slope, offset = fit_logistic(x, y, weight)
    return ToxicityModel(learn_lexicon(texts, toxic), slope, offset)


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int], float]:
    """Bounded sample of labelled texts with their labels, and the share of toxic rows among all labels."""
    known = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    share = known.agg(F.avg("toxic").alias("share")).first().share or 0.0
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = known.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_DOCS)
    rows = picked.select("doc_id", "toxic").collect()  # at most two times SAMPLE_DOCS ids
    spark = docs.sparkSession
    picked = F.broadcast(spark.createDataFrame(rows, "doc_id long, toxic int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.filter("text is not null and text != ''").join(picked, "doc_id")
    long_words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) >= 9)
    least = F.coalesce(F.array_min(F.transform(long_words, lambda w: F.xxhash64(w))), F.xxhash64("text"))
    one = found.groupBy("toxic", least.alias("least")).agg(F.min_by("text", F.struct("doc_id", "text")).alias("text"))
    rows = one.orderBy("least", "text").collect()
    return [r.text for r in rows], [r.toxic for r in rows], float(share)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row: the carried columns as a struct ``row``, and ``score``."""
    narrow = docs.select(F.struct(*carry).alias("row"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_slices(batches):
            scores = [model.score(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["row", "score"])

    return in_tasks(narrow, run, narrow.select("row", F.lit(0.0).alias("score")).schema)
