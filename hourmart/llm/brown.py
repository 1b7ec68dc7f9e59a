"""Class-based n-gram language model with exchange clustering."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, map_arrow, tuned, unpacked, with_texts

#: Words whose counts are sent to all tasks, at most; all other words are joined by shuffle.
SENT_WORDS = 262_144
#: Units whose classes are found first: the most frequent words, and the others by their
#: last two characters, the most frequent endings at least.  From its unit's class every
#: other word then moves to a class of its own choice.
UNIT_WORDS, UNIT_ENDINGS = 2_048, 512
ENDING_CHARS = 2
CLASSES = 48
ROUNDS = 10
#: Shares of the moving words, those that gain most, until the likelihood rises.
MOVING = (1.0, 0.25, 0.0625)
#: Added counts: of a word inside its class, and of a class after another class.
WORD_SHARE = 0.5
CLASS_SHARE = 5.0
#: Fixed units.  Their classes are fixed as well, under the same numbers.
BEGIN, END, OTHER = 0, 1, 2
FIRST_UNIT = 3
#: Entries that a task holds before it hands them on.
HELD = 500_000
#: Words that a task holds before it counts them, or their neighbours, and hands these on.
HELD_WORDS = 2_000_000
#: Rows of words' neighbours that a task reads at once, about.
CONTEXT_ROWS = 16_384


# Counting


def _words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, A-Z lower-cased, and the number of each text's words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    # White space at a text's ends leaves empty strings there.
    filled = pc.greater(pc.binary_length(words), 0)
    of = pc.list_parent_indices(lists).filter(filled).to_numpy()
    return words.filter(filled), np.bincount(of, minlength=len(texts))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of a task's texts; a null word is the end of a text."""
    held: list[pa.Array] = []
    size = ends = 0

    def emit() -> pa.RecordBatch:
        found = pa.concat_arrays(held).value_counts()
        held.clear()
        words = pa.concat_arrays([found.field("values"), pa.nulls(1, pa.string())])
        counts = pa.concat_arrays([found.field("counts"), pa.array([ends], pa.int64())])
        return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])

    for batch in batches:
        held.append(_words_of(batch.column("text"))[0])
        size, ends = size + len(held[-1]), ends + batch.num_rows
        if size > HELD_WORDS:
            yield emit()
            size = ends = 0
    if ends:
        yield emit()


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of column ``text``; the null word counts the texts' ends."""
    counts = map_arrow(texts.select("text"), _count_words, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


@dataclass
class Units:
    """Words that tasks know, and the unit of every word."""

    words: list[bytes]
    counts: np.ndarray
    word_unit: np.ndarray
    endings: dict[str, int]
    tokens: np.ndarray
    types: np.ndarray

    def alone(self) -> int:
        """How many words, the first of ``words``, are units of their own."""
        return min(UNIT_WORDS, len(self.words))

    def index(self) -> pa.Array:
        return pa.array(self.words, pa.binary()).cast(pa.string())

    def unit_of(self, word: bytes) -> int:
        return self.endings.get(word.decode()[-ENDING_CHARS:], OTHER)

    def units_of(self, words: pa.Array) -> np.ndarray:
        """``unit_of`` of many words."""
        ends = pc.utf8_slice_codeunits(words, start=-ENDING_CHARS)
        at = pc.index_in(ends, value_set=pa.array(list(self.endings), pa.string()))
        return np.array([*self.endings.values(), OTHER], np.int64)[at.fill_null(-1).to_numpy()]

    def size(self) -> int:
        return len(self.tokens)

    def plain(self) -> tuple:
        return (self.words, self.counts, self.word_unit, self.endings, self.tokens, self.types)


def choose_units(counts: DataFrame, scratch: Scratch) -> Units:
    """The words to send, by a count bound that admits at most ``SENT_WORDS``; units with their counts."""
    spark = counts.sparkSession
    words = counts.where("word is not null")
    step = F.floor(64 * F.log2("n")).cast("int")
    steps = sorted(((r[0], r[1]) for r in words.groupBy(step).count().collect()), reverse=True)
    least, held = 1 << 30, 0
    for value, n in steps:
        if held + n > SENT_WORDS:
            break
        least, held = value, held + n
    sent = words.where(step >= least).toArrow()
    order = sorted(zip((-n for n in sent["n"].to_pylist()), sent["word"].to_pylist(), strict=True))
    top = [w for _, w in order[:UNIT_WORDS]]

    own = spark.createDataFrame([(w,) for w in top], "word string")
    ending = F.substring("word", -ENDING_CHARS, ENDING_CHARS).alias("ending")
    rest = words.join(F.broadcast(own), "word", "left_anti")
    ends = rest.groupBy(ending).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types"))
    ends = scratch.store(ends, "endings")
    listed = ends.orderBy(F.desc("n"), "ending").limit(UNIT_ENDINGS).collect()
    all_n, all_types = ends.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    texts = counts.where("word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    scratch.drop("endings")

    first_ending = FIRST_UNIT + len(top)
    endings = {r["ending"]: first_ending + i for i, r in enumerate(listed)}
    tokens, types = (np.zeros(first_ending + len(listed)) for _ in range(2))
    tokens[END] = texts
    tokens[OTHER] = all_n - sum(r["n"] for r in listed)
    types[OTHER] = all_types - sum(r["types"] for r in listed)
    for i, (n, _) in enumerate(order[: len(top)]):
        tokens[FIRST_UNIT + i] = -n
    for i, r in enumerate(listed):
        tokens[first_ending + i], types[first_ending + i] = r["n"], r["types"]
    names = [w.encode() for _, w in order]
    out = Units(names, np.array([-n for n, _ in order], np.int64), np.zeros(len(order), np.int64), endings, tokens, types)
    out.word_unit = np.array(
        [FIRST_UNIT + i if i < len(top) else out.unit_of(w) for i, w in enumerate(names)], np.int64
    )
    return out


@dataclass
class Lines:
    """A batch of texts as one line, each with its begin and end.

    ``row`` is the text of every place, ``place`` where the words are, and ``at`` their
    numbers (-1: not sent); ``others`` are the words not sent.
    """

    rows: int
    row: np.ndarray
    place: np.ndarray
    at: np.ndarray
    others: pa.Array

    def filled(self, known: np.ndarray, others: np.ndarray | int, begin: int = BEGIN, end: int = END) -> np.ndarray:
        """Numbers of all places: ``known`` of the sent words, ``others`` of those not sent."""
        out = np.full(len(self.row), end, np.int64)
        out[np.flatnonzero(np.diff(self.row, prepend=-1))] = begin
        of = np.empty(len(self.at), np.int64)
        sent = self.at >= 0
        of[sent], of[~sent] = known[self.at[sent]], others
        out[self.place] = of
        return out


def _lines_of(texts: pa.Array, index: pa.Array) -> Lines:
    words, sizes = _words_of(texts)
    at = pc.index_in(words, value_set=index).fill_null(-1).to_numpy()
    text = np.repeat(np.arange(len(sizes)), sizes)
    return Lines(
        len(sizes),
        np.repeat(np.arange(len(sizes)), sizes + 2),
        np.arange(len(at)) + 2 * text + 1,
        at,
        words.filter(pa.array(at < 0)),
    )


def unit_pairs(texts: DataFrame, units: Units) -> DataFrame:
    """(left, right, n): neighbouring units over all texts, with begin and end."""
    shared = texts.sparkSession.sparkContext.broadcast(units.plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Units(*shared.value)
        index, size = own.index(), own.size()
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[np.ndarray] = []
        held = 0

        def gathered() -> None:
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            parts.append((keys, counts))
            waiting.clear()
            if len(parts) >= 8:
                parts[:] = [merged()]

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(where, weights=np.concatenate([c for _, c in parts])).astype(np.int64)

        def emit() -> pa.RecordBatch:
            keys, counts = merged()
            parts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys // size), pa.array(keys % size), pa.array(counts)], ["left", "right", "n"]
            )

        for batch in batches:
            lines = _lines_of(batch.column("text"), index)
            line = lines.filled(own.word_unit, own.units_of(lines.others))
            inner = line[:-1] != END
            waiting.append(line[:-1][inner] * size + line[1:][inner])
            held += len(waiting[-1])
            if held > HELD:
                gathered()
                held = 0
            if sum(len(k) for k, _ in parts) > 8 * HELD:
                yield emit()
        if waiting:
            gathered()
        if parts:
            yield emit()

    pairs = map_arrow(texts.select("text"), run, "left long, right long, n long")
    return pairs.groupBy("left", "right").agg(F.sum("n").alias("n"))


# Exchange clustering


def _g(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1.0)), 0.0)


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of class pairs, up to a constant: sum over cells less both margins."""
    return float(_g(table).sum() - _g(table.sum(axis=0)).sum() - _g(table.sum(axis=1)).sum())


def exchange_gain(
    table: np.ndarray, old: int, after: np.ndarray, before: np.ndarray, itself: float
) -> np.ndarray:
    """Change of the likelihood if a unit leaves class ``old`` for each class.

    ``after`` and ``before`` count the unit's neighbours by class, without itself;
    ``itself`` counts it next to itself.
    """
    rows, columns = table.sum(axis=1), table.sum(axis=0)
    m = table.astype(float)
    m[old, :] -= after
    m[:, old] -= before
    m[old, old] -= itself
    lost = _g(m[old, :]).sum() - _g(table[old, :]).sum() + _g(m[:, old]).sum() - _g(table[:, old]).sum()
    lost -= _g(m[old, old]) - _g(table[old, old])
    base = _g(m)
    right = _g(m + after[None, :]) - base
    left = _g(m + before[:, None]) - base
    corner = np.diag(m)
    gain = right.sum(axis=1) - np.diag(right) + left.sum(axis=0) - np.diag(left)
    gain += _g(corner + after + before + itself) - _g(corner)
    out, into = after.sum() + itself, before.sum() + itself
    gain -= _g(rows + out) - _g(rows) + _g(rows[old] - out) - _g(rows[old])
    gain -= _g(columns + into) - _g(columns) + _g(columns[old] - into) - _g(columns[old])
    gain += lost
    gain[old] = 0.0
    return gain


def _contexts(pairs: DataFrame) -> DataFrame:
    """(unit, right, left): a unit's neighbours with their counts; at most one entry a unit."""
    both = pairs.select(F.col("left").alias("unit"), F.lit(True).alias("follows"), F.col("right").alias("other"), "n").union(
        pairs.select("right", F.lit(False), "left", "n")
    )
    entry = F.struct("other", "n")
    return both.groupBy("unit").agg(
        F.collect_list(F.when(F.col("follows"), entry)).alias("right"),
        F.collect_list(F.when(~F.col("follows"), entry)).alias("left"),
    )


def _by_class(entries: pa.ListScalar, classes: np.ndarray, number: int, unit: int) -> tuple[np.ndarray, float]:
    values = entries.values
    other = values.field("other").to_numpy(zero_copy_only=False)
    n = values.field("n").to_numpy(zero_copy_only=False).astype(float)
    same = other == unit
    return np.bincount(classes[other], weights=np.where(same, 0.0, n), minlength=number), float(n[same].sum())


def exchange_classes(pairs: DataFrame, size: int, scratch: Scratch, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units and the table of class pairs.

    Units start dealt over the classes by frequency.  In each round, tasks compute for
    every unit the class to which moving it alone gains most; the units that gain most
    move at once, half of them or fewer: a round that does not gain is undone and the
    next moves a smaller share, in the end the best unit alone, which always gains.
    The number of units is bounded, so their classes are the driver's to keep.
    """
    contexts = scratch.store(_contexts(pairs).repartition("unit"), "contexts")
    number = classes + FIRST_UNIT - 1
    assigned = np.zeros(size, np.int64)
    assigned[END] = END
    assigned[OTHER:] = 2 + np.arange(size - OTHER) % classes

    def tabled(now: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = np.zeros((number, number))
            for batch in batches:
                for unit, right in zip(batch.column("unit").to_pylist(), batch.column("right"), strict=True):
                    found, itself = _by_class(right, now, number, unit)
                    table[now[unit]] += found
                    table[now[unit], now[unit]] += itself
            cells = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table.ravel()[cells])], ["cell", "n"])

        out = np.zeros(number * number)
        sums = map_arrow(contexts.select("unit", "right"), run, "cell long, n double").groupBy("cell")
        for cell, n in sums.agg(F.sum("n")).collect():
            out[cell] = n
        return out.reshape(number, number)

    def moves(now: np.ndarray, table: np.ndarray) -> list[tuple[int, int, float]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for unit, right, left in zip(batch.column("unit").to_pylist(), batch.column("right"), batch.column("left"), strict=True):
                    if unit < OTHER:
                        continue
                    after, itself = _by_class(right, now, number, unit)
                    before, _ = _by_class(left, now, number, unit)
                    gain = exchange_gain(table, now[unit], after, before, itself)
                    gain[:OTHER] = -np.inf
                    best = int(np.argmax(gain))
                    if gain[best] > 1e-9:
                        rows.append((unit, best, float(gain[best])))
                columns = list(zip(*rows, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                    ["unit", "into", "gain"],
                )

        found = map_arrow(contexts, run, "unit long, into long, gain double").collect()
        return sorted((tuple(r) for r in found), key=lambda r: (-r[2], r[0]))

    table = tabled(assigned)
    best, parts = likelihood(table), 2
    for _ in range(rounds):
        wanted = moves(assigned, table)
        if not wanted:
            break
        trial = assigned.copy()
        for unit, into, _ in wanted[: -(-len(wanted) // parts)]:
            trial[unit] = into
        trial_table = tabled(trial)
        if (value := likelihood(trial_table)) > best:
            assigned, table, best, parts = trial, trial_table, value, max(2, parts // 2)
        else:
            parts *= 4
    scratch.drop("contexts")
    return assigned, table


# Classes of all other words


def move_values(
    table: np.ndarray, old: np.ndarray, after: np.ndarray, before: np.ndarray, itself: np.ndarray
) -> np.ndarray:
    """Change of the likelihood, one row a word, if words that left ``old`` enter each class.

    As ``exchange_gain`` (a row less its value at ``old``), for many words with few neighbours.
    """
    each, size = np.arange(len(old)), len(table)

    def side(cells: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Sum over the neighbours' classes; ``cells`` has the word's class first."""
        word, to = np.nonzero(own)
        n, left = own[word, to], old[word]
        entry, home = np.arange(len(word)), to == left
        x = cells[:, to].T.copy()
        x[entry, left] -= n
        x[home] -= other[word[home]]
        x[entry[home], left[home]] -= itself[word[home]]
        out = np.zeros((len(old), size))
        if len(word):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[first]] = np.add.reduceat(_g(x + n[:, None]) - _g(x), first)
        return out

    corner = np.repeat(np.diag(table)[None, :], len(old), axis=0)
    corner[each, old] -= after[each, old] + before[each, old] + itself
    value = side(table, after, before) + side(table.T, before, after) + _g(corner)
    value -= _g(corner + after) + _g(corner + before)
    value += _g(corner + after + before + itself[:, None])
    for margin, own in ((table.sum(axis=1), after), (table.sum(axis=0), before)):
        n = own.sum(axis=1) + itself
        rest = np.repeat(margin[None, :], len(old), axis=0)
        rest[each, old] -= n
        value -= _g(rest + n[:, None]) - _g(rest)
    return value


def word_contexts(texts: DataFrame, units: Units, classes: np.ndarray, number: int) -> DataFrame:
    """(at, word, codes, n): classes of the neighbours of every word that is no unit of its own.

    A sent word has its number ``at`` and no ``word``, any other -1.  Codes below
    ``number`` are classes behind the word, then those before it; the last is the word itself.
    A word has one or more rows, which follow each other in one partition.
    """
    shared = texts.sparkSession.sparkContext.broadcast((units.plain(), classes))
    codes = 2 * number + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, kinds = shared.value
        own = Units(*plain)
        index, sent, alone = own.index(), len(own.words), own.alone()
        known = kinds[own.word_unit]
        held: list[Lines] = []

        def emit() -> pa.RecordBatch:
            names = pa.concat_arrays([x.others for x in held]).dictionary_encode()
            others = sent + names.indices.to_numpy().astype(np.int64)
            waiting, first = [], 0
            for x in held:
                mine = others[first : first + len(x.others)]
                first += len(x.others)
                word = x.filled(np.arange(sent), mine, -1, -1)
                of = x.filled(known, kinds[own.units_of(x.others)])
                free = word >= alone
                same = (word[:-1] == word[1:]) & free[1:]
                right = word[:-1] * codes + np.where(same, 2 * number, of[1:])
                left = word[1:] * codes + number + of[:-1]
                waiting += [right[free[:-1]], left[free[1:] & ~same]]
            held.clear()
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            first = np.flatnonzero(np.diff(keys // codes, prepend=-1))
            at = keys[first] // codes
            words = names.dictionary.take(pa.array(np.where(at < sent, 0, at - sent), mask=at < sent))
            offsets = pa.array(np.append(first, len(keys)).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(at < sent, at, -1).astype(np.int32)),
                    words,
                    pa.ListArray.from_arrays(offsets, pa.array((keys % codes).astype(np.int16))),
                    pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int64))),
                ],
                ["at", "word", "codes", "n"],
            )

        size = 0
        for batch in batches:
            held.append(_lines_of(batch.column("text"), index))
            size += len(held[-1].at)
            if size > HELD_WORDS:
                yield emit()
                size = 0
        if held:
            yield emit()

    found = map_arrow(texts.select("text"), run, "at int, word string, codes array<short>, n array<long>")
    return found.repartition("at", "word").sortWithinPartitions("at", "word")


def _whole_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows of whole words, and where each word's rows begin."""

    def begins(rows: pa.Table) -> np.ndarray:
        at, word = rows["at"].to_numpy(), rows["word"].combine_chunks()
        other = pc.not_equal(word.slice(1), word.slice(0, max(0, len(word) - 1))).fill_null(False)
        return np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | other.to_numpy(zero_copy_only=False)))

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size > CONTEXT_ROWS:
            rows = pa.Table.from_batches(held).combine_chunks()
            first = begins(rows)
            # The last word may go on.
            if len(first) > 1:
                yield rows.slice(0, first[-1]), first[:-1]
            held = rows.slice(first[-1]).to_batches()
            size = len(rows) - first[-1] if len(first) > 1 else 0
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, begins(rows)


def word_moves(contexts: DataFrame, units: Units, classes: np.ndarray, table: np.ndarray) -> DataFrame:
    """(at, word, n, old, into, gain): a word's count, its class, and the class to which moving it gains most."""
    shared = contexts.sparkSession.sparkContext.broadcast((units.plain(), classes, table))
    number = len(table)
    codes = 2 * number + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, kinds, pairs = shared.value
        own = Units(*plain)
        once, once_gain = np.full(number**3, -1, np.int64), np.zeros(number**3)
        for rows, first in _whole_words(batches):
            size = len(first)
            at, words = (rows[c].combine_chunks().take(pa.array(first)) for c in ("at", "word"))
            sent = at.to_numpy()
            ending = own.units_of(words.fill_null(""))
            old = kinds[np.where(sent >= 0, own.word_unit[sent], ending) if len(own.word_unit) else ending]
            word = np.repeat(np.arange(size), np.diff(np.append(first, len(rows))))
            lists = rows["codes"].combine_chunks()
            place = word[pc.list_parent_indices(lists).to_numpy()] * codes + pc.list_flatten(lists).to_numpy()
            n = pc.list_flatten(rows["n"].combine_chunks()).to_numpy()
            found = np.bincount(place, weights=n, minlength=size * codes).reshape(size, codes)
            after, before, itself = found[:, :number], found[:, number:-1], found[:, -1]
            count = (after.sum(axis=1) + itself).astype(np.int64)
            # Of words that occur once with the same three classes, one is computed.
            key = (old * number + after.argmax(axis=1)) * number + before.argmax(axis=1)
            single = np.flatnonzero(count == 1)
            new = single[np.unique(key[single], return_index=True)[1]]
            new = new[once[key[new]] < 0]
            some = np.append(np.flatnonzero(count != 1), new)
            value = move_values(pairs, old[some], after[some], before[some], itself[some])
            value[:, :OTHER] = -np.inf
            into, gain = old.copy(), np.zeros(size)
            best, each = np.argmax(value, axis=1), np.arange(len(some))
            more = value[each, best] - value[each, old[some]]
            into[some], gain[some] = (np.where(more > 1e-9, x, y) for x, y in ((best, old[some]), (more, 0.0)))
            once[key[new]], once_gain[key[new]] = into[new], gain[new]
            into[single], gain[single] = once[key[single]], once_gain[key[single]]
            into = into.astype(np.int32)
            columns = [pa.array(x) for x in (count, old.astype(np.int32), into, gain)]
            yield pa.RecordBatch.from_arrays(
                [at, words, *columns], ["at", "word", "n", "old", "into", "gain"]
            )

    return map_arrow(contexts, run, "at int, word string, n long, old int, into int, gain double")


_TAIL = "words array<struct<word: string, back: int>>, tail array<struct<k: int, left: int, right: int>>"


def _tails(lines: Lines, kind: np.ndarray, own: Units, classes: np.ndarray) -> list[pa.ListArray]:
    """Columns of the words not sent, with the class of their ending, and of each place of one with its neighbours' classes."""

    def lists(of: np.ndarray, **columns: pa.Array) -> pa.ListArray:
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=lines.rows))).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(columns.values()), list(columns)))

    spots = lines.place[lines.at < 0]
    of, names = lines.row[spots], lines.others.dictionary_encode()
    number = max(1, len(names.dictionary))
    each, k = np.unique(of * number + names.indices.to_numpy(), return_inverse=True)
    text, name = each // number, each % number
    back = classes[own.units_of(names.dictionary)][name]
    words = lists(text, word=names.dictionary.take(pa.array(name)), back=pa.array(back, pa.int32()))
    numbers = {"k": k - np.searchsorted(text, of), "left": kind[spots - 1], "right": kind[spots + 1]}
    return [words, lists(of, **{c: pa.array(x, pa.int32()) for c, x in numbers.items()})]


def _with_classes(rows: DataFrame, tail: DataFrame) -> DataFrame:
    """Rows with ``found`` instead of ``words``: their classes and counts, joined by shuffle."""
    each = rows.select("uid", F.posexplode("words").alias("k", "each"))
    joined = each.join(tail, F.col("each.word") == F.col("word"), "left")
    known = F.struct(
        "k", F.coalesce("class", "each.back").alias("class"), F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )
    found = joined.groupBy("uid").agg(F.sort_array(F.collect_list(known)).alias("found"))
    return rows.drop("words").join(found, "uid", "left")


def _tail_pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of all places of words not sent: row, class and count; then row, left and right of their class pairs."""
    tail, found = batch.column("tail"), batch.column("found")
    row = pc.list_parent_indices(tail).to_numpy()
    first = np.cumsum([0, *pc.fill_null(pc.list_value_length(found), 0).to_pylist()])
    k, left, right = (pc.list_flatten(tail).field(c).to_numpy(zero_copy_only=False) for c in ("k", "left", "right"))
    values = pc.list_flatten(found)
    kind, n = (values.field(c).to_numpy(zero_copy_only=False)[first[row] + k] for c in ("class", "n"))
    right = np.where(right < 0, np.append(kind[1:], -1)[: len(kind)], right)
    known = left >= 0
    return (
        row, kind, n,
        np.concatenate([row, row[known]]), np.concatenate([kind, left[known]]), np.concatenate([right, kind[known]]),
    )


def class_pairs(
    texts: DataFrame, units: Units, classes: np.ndarray, word_class: np.ndarray, tail: DataFrame, number: int, scratch: Scratch
) -> np.ndarray:
    """The table of class pairs over all texts, every word with its own class."""
    shared = texts.sparkSession.sparkContext.broadcast((units.plain(), classes, word_class))

    def cells(table: np.ndarray) -> list[pa.Array]:
        at = np.flatnonzero(table)
        return [pa.array(at), pa.array(table[at].astype(np.int64))]

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, kinds, of = shared.value
        own = Units(*plain)
        index = own.index()
        for batch in batches:
            lines = _lines_of(batch.column("text"), index)
            kind = lines.filled(of, -1)
            both = (kind[:-1] >= 0) & (kind[1:] >= 0) & (kind[:-1] != END)
            table = np.bincount(kind[:-1][both] * number + kind[1:][both], minlength=number * number)
            counts = [
                pa.array([c.tolist()] + [None] * (lines.rows - 1), pa.list_(pa.int64()))[: lines.rows] for c in cells(table)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), *_tails(lines, kind, own, kinds), *counts], ["uid", "words", "tail", "cells", "times"]
            )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(number * number)
        for batch in batches:
            _, _, _, _, left, right = _tail_pairs(batch)
            table += np.bincount(left.astype(np.int64) * number + right, minlength=number * number)
        yield pa.RecordBatch.from_arrays(cells(table), ["cell", "n"])

    rows = texts.select("text").withColumn("uid", F.monotonically_increasing_id())
    rows = scratch.store(map_arrow(rows, known, f"uid long, {_TAIL}, cells array<long>, times array<long>"), "lines")
    others = _with_classes(rows.select("uid", "words", "tail").where(F.size("tail") > 0), tail)
    sure = rows.select(F.explode(F.arrays_zip("cells", "times")).alias("x")).select("x.cells", "x.times")
    out = np.zeros(number * number)
    counted = sure.union(map_arrow(others.select("tail", "found"), joined, "cell long, n long")).toDF("cell", "n")
    for cell, n in counted.groupBy("cell").agg(F.sum("n")).collect():
        out[cell] = n
    scratch.drop("lines")
    return out.reshape(number, number)


def place_words(
    texts: DataFrame, units: Units, classes: np.ndarray, table: np.ndarray, scratch: Scratch
) -> tuple[np.ndarray, DataFrame, np.ndarray]:
    """Classes of the sent words, (word, n, class) of all others, and the table of class pairs.

    Every word that is no unit of its own starts in its unit's class, and its gain in each
    class is computed exactly from all its neighbours.  All that gain move at once; if the
    likelihood does not rise, only those that gain most do, in the end none.
    """
    contexts = word_contexts(texts, units, classes, len(table))
    moves = scratch.store(word_moves(contexts, units, classes, table), "moves")
    sent, start = moves.where("at >= 0"), likelihood(table)
    gains = moves.where("gain > 0")
    for share in (*MOVING, 0.0):
        least = math.inf
        if share:
            least = gains.agg(F.percentile_approx("gain", 1.0 - share, 10_000)).first()[0] if share < 1 else 0.0
        if least is None:
            continue
        moved = F.when((F.col("gain") > 0) & (F.col("gain") >= F.lit(least)), F.col("into")).otherwise(F.col("old"))
        word_class = classes[units.word_unit] if len(units.words) else np.zeros(0, np.int64)
        own = sent.where(moved != F.col("old")).select("at", moved.alias("class")).toArrow()
        word_class[own["at"].to_numpy()] = own["class"].to_numpy()
        tail = moves.where("at < 0").select("word", "n", moved.alias("class"))
        if not share:
            return word_class, tail, table
        found = class_pairs(texts, units, classes, word_class, tail, len(table), scratch)
        if likelihood(found) > start:
            return word_class, tail, found
    raise AssertionError("the last share is none")


# The model


@dataclass
class BrownModel:
    """log10 probabilities: class after class, sent words in their class; ``mass`` divides others' counts."""

    units: Units
    classes: np.ndarray
    after: np.ndarray
    word_class: np.ndarray
    word: np.ndarray
    mass: np.ndarray
    known: np.ndarray

    def plain(self) -> tuple:
        return (self.units.plain(), self.classes, self.after, self.word_class, self.word, self.mass, self.known)


def build_model(
    units: Units,
    classes: np.ndarray,
    table: np.ndarray,
    total: float,
    word_class: np.ndarray | None = None,
    others: np.ndarray | None = None,
) -> BrownModel:
    """Smoothed probabilities, of classes of the sent words and numbers of other words by class.

    A class follows another by its relative count there, mixed with its overall share.
    A word has its share of its class, where each word, and one unknown word, gets
    ``WORD_SHARE`` added.  The end is alone in its class.
    """
    share = (table.sum(axis=0) + 1.0) / (table.sum() + len(table))
    after = (table + CLASS_SHARE * share[None, :]) / (table.sum(axis=1, keepdims=True) + CLASS_SHARE)
    if word_class is None:
        word_class = classes[units.word_unit]
    types = np.bincount(word_class, minlength=len(table)) + (0 if others is None else others)
    mass = np.log10(table.sum(axis=0) + WORD_SHARE * (types + 1.0))
    word = np.log10(units.counts + WORD_SHARE) - mass[word_class]
    return BrownModel(units, classes, np.log10(after), word_class, word, mass, np.log10(units.counts + 1.0))


def learn(texts: DataFrame, counts: DataFrame, scratch: Scratch) -> tuple[BrownModel, DataFrame]:
    """Cluster and count over all training texts, given their word counts; also (word, n, class) of words not sent."""
    units = choose_units(counts, scratch)
    pairs = scratch.store(unit_pairs(texts, units), "pairs")
    classes, table = exchange_classes(pairs, units.size(), scratch, CLASSES)
    scratch.drop("pairs")
    word_class, tail, table = place_words(texts, units, classes, table, scratch)
    others = np.zeros(len(table))
    for kind, n in tail.groupBy("class").count().collect():
        others[kind] = n
    return build_model(units, classes, table, float(units.tokens.sum()), word_class, others), tail


def score(
    docs: DataFrame, training: DataFrame, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Score all texts of ``docs`` with a class model and word counts of ``training``.

    The result has the columns ``keep`` of ``docs`` (default: all).
    Adds ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one word
    probabilities), ``score`` (log10 probability under the model) and ``perplexity``.

    Tokens are words after lower-casing A-Z, then an end.  Words are counted over all
    training texts.  The most frequent words, and the endings of the others, are
    assigned to classes by exchange clustering over all their neighbouring pairs; then
    every other word moves to the class that its own neighbours favour.  A text's
    probability is the product of class transitions and emissions of words; an unknown
    word has the class of its ending.  The counts and classes of a bounded number of
    frequent words are sent to all tasks; each text's other words are joined with theirs
    by shuffle.

    A null or blank text is the end alone.  Without training texts every word is
    unknown.  Repeated rows get equal results; an empty table gives no rows; input
    columns named like result columns are replaced.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "brown")
    texts = training.select(F.col(f"`{text_col}`").alias("text"))
    counts = scratch.store(count_words(texts), "counts")
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    model, tail = learn(texts, counts, scratch)
    shared = spark.sparkContext.broadcast(model.plain())
    rows, _, names = with_texts(docs, text_col, keep)
    rows = rows.withColumn("uid", F.monotonically_increasing_id())

    def opened() -> BrownModel:
        plain, *rest = shared.value
        return BrownModel(Units(*plain), *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened()
        index, ends = own.units.index(), own.units.tokens[END]
        for batch in batches:
            texts = batch.column("row").field(text_col) if text_col in names else batch.column("text")
            lines = _lines_of(texts, index)
            kind = lines.filled(own.word_class, -1)
            both = (kind[:-1] >= 0) & (kind[1:] >= 0) & (kind[:-1] != END)
            sent = lines.at >= 0
            at, of = lines.at[sent], lines.row[lines.place[sent]]

            def summed(row: np.ndarray, values: np.ndarray | None = None, size: int = lines.rows) -> np.ndarray:
                return np.bincount(row, values, size)

            total = summed(lines.row[:-1][both], own.after[kind[:-1][both], kind[1:][both]]) + summed(of, own.word[at])
            base = summed(of, own.known[at]) + np.log10(ends + 1.0)
            columns = [summed(lines.row) - 1, summed(of) + int(ends > 0)]
            numbers = [*(pa.array(c, pa.int64()) for c in columns), *(pa.array(c, pa.float64()) for c in (base, total))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("row"), *numbers, *_tails(lines, kind, own.units, own.classes)],
                ["uid", "row", "n_tokens", "known", "base", "total", "words", "tail"],
            )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened()
        for batch in batches:
            row, kind, n, at, left, right = _tail_pairs(batch)
            size = batch.num_rows
            total = np.bincount(row, np.log10(n + WORD_SHARE) - own.mass[kind], size)
            total += np.bincount(at, own.after[left, right], size)
            base = np.bincount(row, np.log10(n + 1.0), size)
            more = [np.bincount(row, n > 0, size).astype(np.int64), base, total]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), *map(pa.array, more)], ["uid", "more_known", "more_base", "more_total"]
            )

    schema = (
        f"uid long, row {rows.schema['row'].dataType.simpleString()}, n_tokens long, known long, "
        f"base double, total double, {_TAIL}"
    )
    scored = scratch.store(map_arrow(rows, run, schema), "scored")
    others = _with_classes(scored.select("uid", "words", "tail").where(F.size("tail") > 0), tail)
    sums = map_arrow(others, added, "uid long, more_known long, more_base double, more_total double")
    scored = scored.drop("words", "tail")
    zero = F.lit(0.0)
    n_tokens = F.col("n_tokens")
    value = F.col("total") + F.coalesce("more_total", zero)
    return unpacked(
        scored.join(sums, "uid", "left"),
        names,
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (
            F.col("base") + F.coalesce("more_base", zero) - n_tokens * F.log10(F.lit(float(tokens + types + 1)))
        ).alias("base_score"),
        value.alias("score"),
        F.pow(F.lit(10.0), -value / n_tokens).alias("perplexity"),
    )
