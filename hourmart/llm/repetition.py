"""Quality rules: counts of words, symbols and lines, and repetition from a suffix array of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import map_arrow, tuned, unpacked, with_texts

#: Fewest words of a text, and the share of its words in repeated 3-word windows (in %).
LEAST_WORDS, MOST_REPEAT_WORDS, WINDOW = 50, 50, 3
#: Symbols that are counted.
SYMBOLS = b"#*$%&|<>"
#: A repeat counts from so many words; the share of a text's characters in repeats, and
#: the share of its words in the longest one, beyond which it goes.
LEAST_REPEAT, MOST_COVERED, LONGEST_SHARE = 8, 0.4, 0.2

#: Marks occurrences that different words precede.
_MIXED = -2

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_chars long, longest_repeat long, repeats array<struct<start:long,length:long,copies:long>>"
)


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of a sequence of numbers 0, 1, ..., and the common prefixes of neighbours.

    Prefix doubling: the ranks by the first k items give those by 2k.  The ranks kept
    from each round give the common prefixes, longest steps first.
    """
    n = len(ids)
    rank, step, rounds = ids.astype(np.int64), 1, []
    order = np.zeros(n, np.int64)
    while n:
        rounds.append(rank.astype(np.int32))
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        places = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = places
        if places[-1] == n - 1:
            break
        step *= 2
    one, other = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(one), np.int64)
    for j in reversed(range(len(rounds))):
        inside = np.flatnonzero((one < n) & (other < n))
        same = inside[rounds[j][one[inside]] == rounds[j][other[inside]]]
        for moved in (one, other, common):
            moved[same] += 1 << j
    return order, common


def maximal_repeats(ids: np.ndarray, order: np.ndarray, common: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(first start, length, copies) of all maximal repeats of ``least`` items or more.

    They are the intervals of the common prefixes (no longer to the right) whose
    occurrences different items precede (no longer to the left).  A stack finds them
    in one pass over the suffixes that have such a repeat.
    """
    long = np.flatnonzero(common >= least)
    if not len(long):
        return []
    before = np.where(order > 0, ids[order - 1], -1).tolist()
    found: list[tuple[int, int, int]] = []
    # The suffix after a run of long common prefixes closes the run's intervals.
    ends = np.flatnonzero(np.diff(long, append=long[-1] + 2) > 1)
    start = 0
    for end in ends.tolist():
        ranks = long[start : end + 1].tolist()
        lengths = common[ranks].tolist()
        start = end + 1
        stack: list[list[int]] = []
        for rank, length in zip([*ranks, ranks[-1] + 1], [*lengths, 0], strict=True):
            low, left = rank, before[rank]
            while stack and stack[-1][0] > length:
                size, low, seen = stack.pop()
                left = seen if seen == left else _MIXED
                if left == _MIXED:
                    found.append((low, rank, size))
            if stack and stack[-1][0] == length:
                stack[-1][2] = left if stack[-1][2] == left else _MIXED
            elif length:
                stack.append([length, low, left])
    return [(int(order[low : high + 1].min()), size, high - low + 1) for low, high, size in found]


def _covered(reach: np.ndarray) -> np.ndarray:
    """Whether each place lies in a span that starts there or before and ends at ``reach``."""
    return np.maximum.accumulate(reach) > np.arange(len(reach))


def _word_sizes(data: bytes) -> np.ndarray:
    """Code points of each word."""
    codes = np.frombuffer(data, np.uint8)
    word = (codes != 0x20) & ((codes < 0x09) | (codes > 0x0D))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    points = np.concatenate(([0], np.cumsum((codes & 0xC0) != 0x80)))
    return points[edges[1::2]] - points[edges[::2]]


def measure(text: str | None, least: int = LEAST_REPEAT) -> tuple:
    """The values of ``COLUMNS`` for one text."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    symbols = sum(map(data.count, [SYMBOLS[k : k + 1] for k in range(len(SYMBOLS))]))
    if not n:
        return (0, 0, symbols, 0, 0, 0, 0, [])
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    sizes = _word_sizes(data)
    order, common = suffix_array(ids)
    # The longest repeat that starts at each place.
    longest = np.zeros(n, np.int64)
    longest[order] = np.maximum(np.concatenate(([0], common)), np.concatenate((common, [0])))
    places = np.arange(n)
    windows = _covered(np.where(longest >= WINDOW, places + WINDOW, 0))
    # The union over maximal repeats: a repeat that is not maximal lies inside one that is.
    spans = _covered(np.where(longest >= least, places + longest, 0))
    repeats = maximal_repeats(ids, order, common, least)
    repeats.sort(key=lambda r: (-r[1], r[0]))
    most = repeats[0][1] if repeats else 0
    return (n, int(sizes.sum()), symbols, dup_lines, int(windows.sum()), int(sizes[spans].sum()), most, repeats)


def repetition_rules(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    least: int = LEAST_REPEAT,
    most_covered: float = MOST_COVERED,
    longest_share: float = LONGEST_SHARE,
) -> DataFrame:
    """Add counts, repeats and a verdict to every row.

    Words are separated by white space.  ``n_symbols`` counts ``#*$%&|<>``;
    ``n_dup_lines`` lines with a word that equal an earlier line; ``n_repeat_words``
    words in 3-word windows that occur twice or more.  ``repeats`` lists the maximal
    repeated word sequences of ``least`` words or more, longest first: first start and
    length in words, and copies.  ``covered_chars`` are the characters of words in the
    union of all their spans, ``longest_repeat`` the words of the longest.

    ``base_failed``: under 50 words, or over half of them in repeated windows.
    ``kept``: not ``base_failed``, repeats cover at most ``most_covered`` of the words'
    characters, and the longest has at most ``longest_share`` of the words.

    A row is judged by its own text alone, whole whatever its length: no shuffle, and
    a task holds one batch of texts and about 100 bytes a word of one text, more by 4
    for each doubling of its longest repeat.  A null text has no words; blank and empty
    ones too, and all fail.  Repeated rows are judged alike; null identifiers are
    ordinary; an empty table gives no rows.  Input columns named like result columns
    are replaced.  ``keep`` names the input columns to return (all, if None).
    """
    tuned(docs.sparkSession)
    rows, texts_in, names = with_texts(docs, text_col, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t, least) for t in texts_in(batch)]
            columns = list(zip(*found, strict=True)) or [()] * 8
            counts = [pa.array(c, pa.int64()) for c in columns[:7]]
            span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("copies", pa.int64())])
            spans = [[{"start": s, "length": n, "copies": k} for s, n, k in r] for r in columns[7]]
            arrays = [batch.column("row"), *counts, pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(arrays, ["row", *[c.split()[0] for c in COLUMNS.split(", ")]])

    found = map_arrow(rows, run, f"row {rows.schema['row'].dataType.simpleString()}, {COLUMNS}")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_WORDS * F.col("n_words"))
    covered = F.col("covered_chars") > most_covered * F.col("word_chars")
    too_long = F.col("longest_repeat") > longest_share * F.col("n_words")
    results = [c.split()[0] for c in COLUMNS.split(", ")]
    judged = found.withColumn("base_failed", failed).withColumn("kept", ~(failed | covered | too_long))
    return unpacked(judged, names, *results, "base_failed", "kept")
