"""Language identification by cross-parsing entropy.

A suffix automaton is built from labelled text of every language. A text is
parsed greedily into the longest phrases that occur in a language's labelled
text; the fewer phrases it takes, weighted by the bits that one phrase costs,
the closer the language. The language with the fewest bits wins.

Training sample (a documented bound): per language ``SAMPLE_DOCS`` whole labelled
texts in the order of a hash of their content, those of up to ``SHORT`` characters
first; together they make an automaton of ``SAMPLE_SYMBOLS`` symbols at most. Texts
to be labelled are parsed whole, in segments of ``SEGMENT`` symbols; a phrase ends
where its segment ends.

No script is left out: the letters that are most frequent in some language are one
symbol each, every other letter is spelled as the four digits of its code.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
equal costs go to the first language in alphabetical order; without any labelled
row everything is ``und``; repeated rows get equal results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import held, in_tasks, small_slices

SAMPLE_DOCS = 64
SHORT = 2000
SAMPLE_SYMBOLS = 32_000
SEGMENT = 256
UNDECIDED = "und"

# Symbols: the end of a segment, anything but letters, sixteen digits, single letters.
PAD, GAP, DIGIT = 0, 1, 2
LETTER = DIGIT + 16
SYMBOLS = 64


def sample(labelled: DataFrame, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """A bounded sample of labelled texts: (language, text), SAMPLE_DOCS texts a language.

    Of a text longer than a language's automaton can hold no more than fills it is fetched.
    """
    order = Window.partitionBy("lang").orderBy("long", "mark", "text")
    rows = (
        labelled.select(
            F.col(lang_col).cast("string").alias("lang"),
            F.substring(F.col(text_col), 1, SAMPLE_SYMBOLS).alias("text"),
            (F.char_length(F.col(text_col)) > SHORT).alias("long"),
            F.xxhash64(text_col).alias("mark"),
        )
        .filter("lang is not null and text is not null and text != ''")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= SAMPLE_DOCS)
        .orderBy("lang", "place")
        .collect()
    )
    return [(r.lang, r.text) for r in rows]


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text; everything that is no letter becomes 0."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4").astype(np.int64)
    high = codes > 0xFFFF
    if high.any():
        codes[high] = [0xFFFF if chr(c).isalpha() else 0 for c in codes[high]]
    return np.where(_LETTERS[codes], codes, 0)


# 0xFFFF is no character; it stands for letters beyond the basic plane.
_LETTERS = np.array([chr(c).isalpha() for c in range(0xFFFF)] + [True])


def automaton(symbols: list[int]) -> np.ndarray:
    """Suffix automaton as a transition table; row 0 is the start, 0 means no transition."""
    step = np.zeros((2 * len(symbols) + 2, SYMBOLS), dtype=np.int32)
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and step[at, symbol] == 0:
            step[at, symbol] = new
            at = link[at]
        if at >= 0:
            seen = int(step[at, symbol])
            if length[seen] == length[at] + 1:
                link[new] = seen
            else:
                twin = len(link)
                link.append(link[seen])
                length.append(length[at] + 1)
                step[twin] = step[seen]
                while at >= 0 and step[at, symbol] == seen:
                    step[at, symbol] = twin
                    at = link[at]
                link[seen] = link[new] = twin
        last = new
    return step[: len(link)]


class Parser:
    """The automata of all languages, as one parsing table each.

    An entry holds the next row, times SYMBOLS, and in its two lowest bits the
    number of phrases that reading the symbol completes.
    """

    def __init__(self, labelled: list[tuple[str, str]]):
        taken: dict[str, list[np.ndarray]] = {}
        share: Counter = Counter()  # of a letter in the language that uses it most
        for lang, text in labelled:
            codes = letter_codes(f" {text}")
            if codes.any():
                taken.setdefault(lang, []).append(codes)
        for parts in taken.values():
            letters = Counter(np.concatenate([c[c > 0] for c in parts]).tolist())
            total = sum(letters.values())
            for code, n in letters.items():
                share[code] = max(share[code], n / total)
        self.symbol_of = np.zeros(0x10000, dtype=np.uint8)
        self.symbol_of[0] = GAP
        ranked = sorted(share, key=lambda c: (-share[c], c))
        for place, code in enumerate(ranked[: SYMBOLS - LETTER]):
            self.symbol_of[code] = place + LETTER
        self.langs = sorted(taken)
        self.tables, self.bits = [], []
        for lang in self.langs:
            text = self.symbols_of_codes(np.concatenate(taken[lang]))[:SAMPLE_SYMBOLS]
            step = automaton(text.tolist())
            # The table is made in the automaton's own memory: a worker holds one of them at a time beside those that are done.
            missing = step == 0
            fresh = step[0].copy()
            np.copyto(step, fresh, where=missing)
            step *= SYMBOLS << 2
            # A missing transition ends the phrase; a symbol unknown to the language is one of its own.
            np.add(step, (1 + (fresh == 0)).astype(np.int32), out=step, where=missing)
            step[0] = fresh * (SYMBOLS << 2) + (fresh == 0)
            step[:, PAD] = 1
            step[0, PAD] = 0
            self.tables.append(step.ravel())
            self.bits.append(np.log2(max(2, len(text))))

    def symbols_of_codes(self, codes: np.ndarray) -> np.ndarray:
        """Symbols, with runs of gaps made one; a letter without a symbol becomes its four digits."""
        gap = codes == 0
        gap[1:] &= gap[:-1]
        gap[:1] = False
        codes = codes[~gap]
        symbols = self.symbol_of[codes]
        spelled = symbols == 0
        if not spelled.any():
            return symbols
        width = np.where(spelled, 4, 1)
        first = np.cumsum(width) - width
        out = np.empty(int(width.sum()), dtype=np.uint8)
        out[first[~spelled]] = symbols[~spelled]
        for k in range(4):
            out[first[spelled] + k] = DIGIT + (codes[spelled] >> (12 - 4 * k) & 15)
        return out

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits per symbol: one row per text, one column per language."""
        counts = np.array([-(-len(t) // SEGMENT) for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        grid = np.zeros((int(counts.sum()), SEGMENT), dtype=np.uint8)
        at = 0
        for text, n in zip(texts, counts):
            grid[at : at + n].reshape(-1)[: len(text)] = text
            at += n
        # One column more closes the phrase that is open at the end of a segment.
        columns = np.vstack([grid.T, np.zeros((1, len(grid)), dtype=np.uint8)])
        sizes = np.array([max(1, len(t)) for t in texts])
        out = np.empty((len(texts), len(self.tables)))
        for k, (table, bits) in enumerate(zip(self.tables, self.bits)):
            row = np.zeros(len(grid), dtype=np.int32)
            phrases = np.zeros(len(grid), dtype=np.int32)
            for column in columns:
                entry = table[row + column]
                phrases += entry & 3
                row = entry >> 2
            out[:, k] = np.bincount(owner, weights=phrases, minlength=len(texts)) * bits / sizes
        return out

    def identify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNDECIDED] * len(texts), [0.0] * len(texts)
        places, parsed = [], []
        for place, text in enumerate(texts):
            codes = letter_codes(f" {text}") if text else None
            if codes is not None and codes.any() and self.langs:
                places.append(place)
                parsed.append(self.symbols_of_codes(codes))
        if places:
            costs = self.costs(parsed)
            best = costs.argmin(axis=1)
            low = costs.min(axis=1)
            second = np.partition(costs, 1, axis=1)[:, 1] if costs.shape[1] > 1 else np.full(len(low), np.inf)
            margin = 1 - low / np.maximum(second, 1e-12)
            for place, b, m in zip(places, best, np.clip(margin, 0, 1)):
                langs[place], scores[place] = self.langs[b], float(m)
        return langs, scores


def identify(
    docs: DataFrame,
    labelled: list[tuple[str, str]],
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per row: the carried columns as a struct ``row``, ``lang_pred`` and ``score``."""
    narrow = docs.select(F.struct(*carry).alias("row"), F.col(text_col).cast("string").alias("text"))
    key = hash(tuple(labelled))
    shared = docs.sparkSession.sparkContext.broadcast(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = held(("languages", key), lambda: Parser(shared.value))  # automata are built where they are used
        for part in small_slices(batches, rows=2048, size=2 << 20):
            langs, scores = parser.identify(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["row", "lang_pred", "score"],
            )

    schema = narrow.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return in_tasks(narrow, run, schema, holds=True)


def keep_identified(docs: DataFrame, labelled: list[tuple[str, str]], text_col: str = "text") -> DataFrame:
    """The rows whose language could be told, with the columns of the input."""
    marked = identify(docs, labelled, text_col, tuple(docs.columns)).filter(F.col("lang_pred") != UNDECIDED)
    return marked.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
