"""Language identification with language-bitmask n-gram filters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, map_arrow, tuned, unpacked, with_texts

#: Characters that are counted at once.
STEP_CHARS = 1 << 18
#: Languages in one word of a bitmask.
WORD_BITS = 32
#: Positions of an n-gram in the filter.
HASHES = 3
#: Slots of a filter: a power of two in this range, so its size has a bound.
LEAST_SLOTS, MOST_SLOTS = 1 << 12, 1 << 21
#: Slots for each n-gram of the language with the most.
SLOTS_PER_GRAM = 8
#: An n-gram belongs to a language if it occurs there this often, and at least
#: at this share of the rate of the language where it is most frequent.
LEAST_COUNT = 2
LEAST_RATE = 0.1
UNKNOWN = "und"

_NO_LETTERS = regex.compile(r"\P{L}+")


def _letters(text: str | None) -> str:
    """Lower-case letters of a text, words between single spaces; empty without letters."""
    inner = _NO_LETTERS.sub(" ", (text or "").lower()).strip(" ")
    return f" {inner} " if inner else ""


def _grams(text: str) -> np.ndarray:
    """Trigrams of a padded text as packed code points, without those that cross words."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    grams = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    return grams[codes[1:-1] != 32]


def _groups(texts: Iterable[str | None]) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """(rows, their n-gram counts, n-grams) over all texts, a bounded number of characters at a time.

    A text longer than the step comes in pieces that overlap by two characters, so
    each n-gram comes exactly once.
    """
    rows: list[int] = []
    padded: list[str] = []
    held = 0

    def flush() -> tuple[list[int], list[int], np.ndarray]:
        counts = [len(p) - p.count(" ") for p in padded]
        return list(rows), counts, _grams("".join(padded))

    for row, text in enumerate(texts):
        one = _letters(text)
        if not one:
            continue
        if len(one) > STEP_CHARS:
            for start in range(0, len(one) - 2, STEP_CHARS):
                piece = _grams(one[start : start + STEP_CHARS + 2])
                yield [row], [len(piece)], piece
            continue
        rows.append(row)
        padded.append(one)
        held += len(one)
        if held >= STEP_CHARS:
            yield flush()
            rows, padded, held = [], [], 0
    if rows:
        yield flush()


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    found, where = np.unique(keys, return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([c for _, c in parts]))
    return found, counts.astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's texts, summed within bounded memory."""
    sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    waiting = 0

    def emit() -> Iterator[pa.RecordBatch]:
        for lang, parts in sums.items():
            keys, counts = _merged(parts)
            langs = pa.array([lang] * len(keys), pa.string())
            yield pa.RecordBatch.from_arrays(
                [langs, pa.array(keys), pa.array(counts)], ["lang", "gram", "n"]
            )
        sums.clear()

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        for lang in dict.fromkeys(langs.tolist()):
            own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            for _, _, grams in _groups(own):
                keys, counts = np.unique(grams, return_counts=True)
                parts = sums.setdefault(lang, [])
                parts.append((keys, counts))
                if len(parts) >= 16:
                    sums[lang] = [_merged(parts)]
        waiting = sum(len(k) for parts in sums.values() for k, _ in parts)
        if waiting > 4_000_000:
            yield from emit()
    yield from emit()


def _slots(grams: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """Positions of n-grams in a filter of a power of two slots."""
    x = grams.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    step = (x >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((x + np.uint64(k) * step) & np.uint64(slots - 1)).astype(np.int64)


@dataclass
class LanguageFilter:
    """Bit-sliced Bloom filters of all languages: a slot holds a bit of each language."""

    languages: list[str]
    most_common: int
    table: np.ndarray

    def rates(self) -> np.ndarray:
        """Each language's share of n-grams that its filter holds by accident."""
        fill = [
            np.mean((self.table[:, i // WORD_BITS] >> (i % WORD_BITS)) & 1)
            for i in range(len(self.languages))
        ]
        return np.minimum(np.array(fill) ** HASHES, 0.999)

    def hits(self, ends: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Per text (its n-grams end at ``ends``), the n-grams that each language's filter holds."""
        masks = None
        for at in _slots(grams, len(self.table)):
            found = self.table[at]
            masks = found if masks is None else masks & found
        out = np.zeros((len(ends), len(self.languages)), np.int64)
        for i in range(len(self.languages)):
            bits = (masks[:, i // WORD_BITS] >> (i % WORD_BITS)) & 1
            total = np.concatenate([[0], np.cumsum(bits)])[ends]
            out[:, i] = np.diff(total, prepend=0)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        hits = np.zeros((len(texts), len(self.languages)))
        grams_of = np.zeros(len(texts))
        for rows, counts, grams in _groups(texts):
            hits[rows] += self.hits(np.cumsum(counts), grams)
            grams_of[rows] += counts
        rates, n = self.rates(), np.maximum(grams_of, 1)[:, None]
        known = np.clip((hits - n * rates) / (1 - rates), 0, None) / n
        best = known.argmax(axis=1)
        score = np.clip(known.max(axis=1), 0.0, 1.0)
        best[score == 0] = self.most_common
        letters = grams_of > 0
        names = [self.languages[b] if x else UNKNOWN for b, x in zip(best, letters, strict=True)]
        return names, np.where(letters, score, 0.0)


def learn(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least_count: int = LEAST_COUNT,
    least_rate: float = LEAST_RATE,
) -> LanguageFilter:
    """Build the filters from all texts with a language.

    N-grams are counted in the tasks and summed per language.  The filter's bits are
    set in the tasks and joined by OR in Spark; the driver gets its slots, whose
    number has a bound.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "langid")
    texts = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.where("lang is not null and text is not null")
    counts = map_arrow(texts, _count_grams, "lang string, gram long, n long")
    counts = scratch.store(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")

    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rows = sorted(tuple(r) for r in totals.collect())
    languages = [r[0] for r in rows]
    if not languages:
        scratch.drop("grams")
        return LanguageFilter([], 0, np.zeros((LEAST_SLOTS, 1), np.int64))
    most_common = max(range(len(rows)), key=lambda i: (rows[i][1], -i))
    order = spark.createDataFrame(
        [(lang, total, i) for i, (lang, total) in enumerate(rows)], "lang string, total long, place int"
    )
    rate = F.col("n") / F.col("total")
    member = (
        counts.join(F.broadcast(order), "lang")
        .withColumn("rate", rate)
        .withColumn("most", F.max("rate").over(Window.partitionBy("gram")))
        .where((F.col("n") >= least_count) & (F.col("rate") >= least_rate * F.col("most")))
    )
    member = scratch.store(member.select("gram", "place"), "members")
    largest = member.groupBy("place").count().agg(F.max("count")).first()[0] or 1
    slots = LEAST_SLOTS
    while slots < MOST_SLOTS and slots < SLOTS_PER_GRAM * largest:
        slots *= 2

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, place = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "place")
            )
            word = (place // WORD_BITS).astype(np.int32)
            bit = np.left_shift(np.int64(1), (place % WORD_BITS).astype(np.int64))
            for at in _slots(grams, slots):
                yield pa.RecordBatch.from_arrays(list(map(pa.array, (at, word, bit))), ["slot", "word", "bits"])

    cells = map_arrow(member, positions, "slot long, word int, bits long")
    cells = cells.groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = -(-len(languages) // WORD_BITS)
    filled = np.zeros((slots, words), np.int64)
    filled[cells["slot"].to_numpy(), cells["word"].to_numpy()] = cells["bits"].to_numpy()
    scratch.drop("grams", "members")
    return LanguageFilter(languages, most_common, filled)


def predict(
    docs: DataFrame, model: LanguageFilter, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to all rows, with the columns ``keep`` (default: all).

    Every trigram of a whole text is looked up once and gives the set of languages
    that have it.  A language's hits, less those that its filter's false-positive rate
    explains, as a share of all trigrams are its score; the greatest decides, ties
    go to the first language by code point.  Texts that no language explains get the
    language with most training text and score 0.  A text that is null or has no
    letter is ``und`` with score 0, and so is every text if nothing was learned.

    No other column is read.  Repeated rows get equal results; an empty table gives
    no rows; input columns named like result columns are replaced.
    """
    spark = tuned(docs.sparkSession)
    rows, texts_in, names = with_texts(docs, text_col, keep)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    shared = spark.sparkContext.broadcast((model.languages, model.most_common, model.table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageFilter(*shared.value)
        for batch in batches:
            found, score = own.predict(texts_in(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(found, pa.string()), pa.array(score)],
                ["row", "lang_pred", "score"],
            )

    return unpacked(map_arrow(rows, run, schema), names, "lang_pred", "score")
