"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, map_arrow, tuned, unpacked, with_texts, word_blocks
from hourmart.llm.components import connected_components

BITS = 64
SEED = 42
#: Bits of one block of a partition whose values are counted exactly.
BLOCK_BITS = 11
#: Cells of a task's partial sums in one row.
SLICE = 512
#: Numbers of partitions to choose from.
PART_COUNTS = (2, 3, 4)
#: Members up to which a bucket is compared inside one task; larger ones take another exact way.
BUCKET_ROWS = 20_000
#: Cost of one probe row against one candidate comparison.
PROBE_COST = 20.0


# Fingerprints


def _shingle_hashes(data: bytes, width: int) -> Iterator[np.ndarray]:
    """Hashes of all word shingles of a text, in bounded pieces."""
    held: list[bytes] = []
    short = True
    for words in word_blocks(data.lower()):
        words = held + words
        if len(words) < width:
            held = words
            continue
        short = False
        line = b" ".join(words)
        ends = list(itertools.accumulate(map(len, words), lambda a, n: a + n + 1))
        starts = [0, *(e + 1 for e in ends)]
        pieces = [line[a:b] for a, b in zip(starts, ends[width - 1 :], strict=False)]
        yield np.fromiter(
            map(xxhash.xxh64_intdigest, pieces, itertools.repeat(SEED)), np.uint64, len(pieces)
        )
        held = words[len(words) - width + 1 :]
    if short and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """The signed 64-bit fingerprint of a text; 0 without words."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in _shingle_hashes((text or "").encode(), width):
        for part in np.array_split(hashes, len(hashes) // 65536 + 1):
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(
    docs: DataFrame, text_col: str = "text", width: int = 3, keep: list[str] | None = None
) -> DataFrame:
    """(row, fp): the columns to keep as a struct, and the fingerprints."""
    rows, texts_in, _ = with_texts(docs, text_col, keep)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, width) for t in texts_in(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), found], ["row", "fp"])

    return map_arrow(rows, run, schema)


# Partitions and thresholds


def _bit_rows(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(frame: DataFrame, size: int, count: object) -> np.ndarray:
    """Sum over all fingerprints of an array of ``size`` numbers that ``count`` makes of a batch.

    A task gives its sums as a few slices; each slice is added up over the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += count(batch.column("fp").to_numpy(zero_copy_only=False))
        starts = [a for a in range(0, size, SLICE) if total[a : a + SLICE].any()]
        slices = pa.array([total[a : a + SLICE].tolist() for a in starts], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), slices], ["start", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.array(s.values) for chunk in table["sums"].chunks for s in chunk)
        return pa.table({"start": table["start"][:1], "sums": [total.tolist()]})

    schema = "start long, sums array<double>"
    parts = map_arrow(frame.select("fp"), run, schema)
    out = np.zeros(size)
    for start, sums in parts.groupBy("start").applyInArrow(add, schema).collect():
        out[start : start + len(sums)] = sums
    return out


def group_bits(together: np.ndarray, n: float, parts: int) -> list[list[int]]:
    """Partition the bits, correlated ones together, into groups of nearly equal size.

    ``together[i, j]`` counts fingerprints with bits i and j set.  A group starts with
    the most correlated free pair and takes the free bit closest to it until full.
    """
    share = together / max(n, 1.0)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    close = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(close, 0.0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        want = len(free) // (parts - k)
        left = sorted(free)
        inner = close[np.ix_(left, left)]
        first = left[int(np.unravel_index(np.argmax(inner), inner.shape)[0])]
        group = [first]
        free.remove(first)
        while len(group) < want:
            best = max(sorted(free), key=lambda b: (close[b, group].mean(), -b))
            group.append(best)
            free.remove(best)
        groups.append(group)
    return groups


def _values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    unsigned = fps.view(np.uint64)
    out = np.zeros(len(fps), np.int64)
    for place, bit in enumerate(bits):
        out |= ((unsigned >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


class Allocation:
    """Bit groups, estimates of candidates per value, and thresholds per fingerprint."""

    def __init__(self, groups: list[list[int]], distance: int) -> None:
        self.groups, self.distance = groups, distance
        self.blocks = [
            [group[a : a + BLOCK_BITS] for a in range(0, len(group), BLOCK_BITS)] for group in groups
        ]
        self.total = 0.0
        self.near: list[list[np.ndarray]] = []

    def counts(self, fps: np.ndarray) -> np.ndarray:
        out = []
        for blocks in self.blocks:
            for bits in blocks:
                out.append(np.bincount(_values(fps, bits), minlength=1 << BLOCK_BITS))
        return np.concatenate(out).astype(float)

    def size(self) -> int:
        return sum(map(len, self.blocks)) << BLOCK_BITS

    def learn(self, counted: np.ndarray) -> None:
        """Shares of fingerprints at each distance from each value of each block."""
        tables = iter(counted.reshape(-1, 1 << BLOCK_BITS))
        for blocks in self.blocks:
            own = []
            for bits in blocks:
                exact = next(tables)
                self.total = exact.sum()
                at = np.arange(1 << BLOCK_BITS)
                shells = [exact / max(self.total, 1.0)]
                for d in range(1, self.distance + 1):
                    shell = np.zeros_like(exact)
                    for flips in itertools.combinations(range(len(bits)), d):
                        shell += shells[0][at ^ sum(1 << f for f in flips)]
                    shells.append(shell)
                own.append(np.array(shells))
            self.near.append(own)

    def costs(self, fps: np.ndarray) -> list[np.ndarray]:
        """Per group, estimated cost (threshold + 1, fingerprint) of probing at each threshold."""
        out = []
        for group, blocks, tables in zip(self.groups, self.blocks, self.near, strict=True):
            shares = np.zeros((self.distance + 1, len(fps)))
            shares[0] = 1.0
            for bits, table in zip(blocks, tables, strict=True):
                found = table[:, _values(fps, bits)]
                shares = np.array(
                    [
                        sum(shares[a] * found[d - a] for a in range(d + 1))
                        for d in range(self.distance + 1)
                    ]
                )
            probes = np.cumsum([_ways(len(group), d) for d in range(self.distance + 1)])
            cost = PROBE_COST * probes[:, None] + self.total * np.cumsum(shares, axis=0)
            out.append(np.vstack([np.zeros((1, len(fps))), cost]))
        return out

    def thresholds(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cheapest thresholds (group, fingerprint) from -1 up, and their costs.

        By the general pigeonhole principle the thresholds of m groups may sum to
        distance - m + 1.  Shifted by one they are 0 or more and sum to distance + 1;
        dynamic programming over the groups finds the cheapest split of that sum.
        """
        costs, want = self.costs(fps), self.distance + 1
        best = np.full((want + 1, len(fps)), np.inf)
        best[0] = 0.0
        picks = []
        for cost in costs:
            options = np.array(
                [
                    [
                        best[t - s] + cost[s] if s <= t else np.full(len(fps), np.inf)
                        for s in range(want + 1)
                    ]
                    for t in range(want + 1)
                ]
            )
            picks.append(options.argmin(axis=1))
            best = options.min(axis=1)
        chosen = np.zeros((len(costs), len(fps)), np.int64)
        left = np.full(len(fps), want)
        everyone = np.arange(len(fps))
        for k in range(len(costs) - 1, -1, -1):
            chosen[k] = picks[k][left, everyone]
            left -= chosen[k]
        return chosen - 1, best[want]

    def entries(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part, value, fp, probe): index rows, and the values that thresholds make probe."""
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            limits, _ = self.thresholds(fps)
            for part, bits in enumerate(self.groups):
                values = _values(fps, bits)
                rows = [(values, fps, limits[part] >= 0)]
                for d in range(1, self.distance + 1):
                    at = limits[part] >= d
                    for flips in itertools.combinations(range(len(bits)), d) if at.any() else ():
                        mask = sum(1 << f for f in flips)
                        rows.append((values[at] ^ mask, fps[at], np.ones(at.sum(), bool)))
                columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(columns[0]), part, np.int32)), *map(pa.array, columns)],
                    ["part", "value", "fp", "probe"],
                )


def _ways(n: int, k: int) -> int:
    return 1 if k == 0 else _ways(n - 1, k - 1) * n // k


def fit_allocation(classes: DataFrame, distance: int) -> Allocation:
    """Choose groups and their number by the estimated cost over all fingerprints."""

    def correlated(fps: np.ndarray) -> np.ndarray:
        bits = _bit_rows(fps).astype(np.float32)
        return np.append((bits.T @ bits).ravel().astype(float), len(fps))

    counted = _summed(classes, BITS * BITS + 1, correlated)
    together, n = counted[:-1].reshape(BITS, BITS), counted[-1]
    options = [Allocation(group_bits(together, n, m), distance) for m in PART_COUNTS]
    sizes = [o.size() for o in options]
    histograms = _summed(
        classes, sum(sizes), lambda fps: np.concatenate([o.counts(fps) for o in options])
    )
    for option, found in zip(options, np.split(histograms, np.cumsum(sizes)[:-1]), strict=True):
        option.learn(found)
    totals = _summed(
        classes, len(options), lambda fps: np.array([o.thresholds(fps)[1].sum() for o in options])
    )
    return options[int(np.argmin(totals))]


# Links


def _bucket_links(fps: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of one bucket within the distance."""
    if len(fps) == 2:
        if (int(fps[0] ^ fps[1]) & (2**BITS - 1)).bit_count() <= distance:
            yield int(fps[0]), int(fps[1])
        return
    rest = np.unique(fps)
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near = np.bitwise_count((rest ^ one).view(np.uint64)) <= distance
            if near.any():
                found, rest = rest[near], rest[~near]
                queue.extend(found)
                for other in found:
                    yield int(one), int(other)


def _bucket_batches(distance: int) -> object:
    """Links inside buckets of rows that arrive sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                now = tuple(
                    batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "value", "fp")
                )
                held = now if held is None else tuple(map(np.concatenate, zip(held, now, strict=True)))
            if held is None or not len(held[0]):
                continue
            part, value, fps = held
            breaks = np.flatnonzero((np.diff(part) != 0) | (np.diff(value) != 0)) + 1
            if batch is not None and not len(breaks):
                continue
            bounds = [0, *breaks.tolist()]
            if batch is None:
                bounds.append(len(fps))
            links = [
                link
                for a, b in zip(bounds, bounds[1:], strict=False)
                for link in _bucket_links(fps[a:b], distance)
            ]
            held = None if batch is None else tuple(c[bounds[-1] :] for c in held)
            ends = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])

    return run


def _crowded_links(members: DataFrame) -> DataFrame:
    """Links within two bits among the members of crowded buckets.

    Two fingerprints differ in at most two bits exactly if some value is within one
    bit of both.  Each member is listed under its 65 such values; a value has at
    most 65 members, which form one component.
    """
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)), lambda k: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))
    )
    near = members.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("centre"))
    groups = near.groupBy("centre").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    return groups.where("size(fps) > 1").select(
        F.col("fps")[0].alias("u"), F.explode(F.slice("fps", 2, BITS)).alias("v")
    )


def near_links(
    classes: DataFrame, scratch: Scratch, distance: int = 2, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints ``fp`` within the distance."""
    allocation = fit_allocation(classes, distance)
    entries = scratch.store(
        map_arrow(
            classes.select("fp"), allocation.entries, "part int, value long, fp long, probe boolean"
        ),
        "entries",
    )
    sizes = entries.groupBy("part", "value").agg(
        F.count(F.lit(1)).alias("n"), F.max("probe").alias("probed")
    )
    shared = scratch.store(
        entries.join(sizes.where("n > 1 and probed").drop("probed"), ["part", "value"]), "shared"
    )
    # Repartitioned outright: a join's own partitions may be split at run time.
    small = (
        shared.where(F.col("n") <= bucket_rows)
        .repartition("part", "value")
        .sortWithinPartitions("part", "value")
    )
    links = map_arrow(small.select("part", "value", "fp"), _bucket_batches(distance), "u long, v long")
    crowded = shared.where(F.col("n") > bucket_rows).select("fp").distinct()
    return links.union(_crowded_links(crowded))


def near_components(
    marked: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    distance: int = 2,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint of ``marked`` (row, fp)."""
    if not 0 <= distance <= 2:
        raise ValueError("distances up to 2 are supported")
    classes = scratch.store(
        marked.groupBy("fp").agg(F.min(F.col(f"row.`{id_col}`")).alias("least")), "classes"
    )
    links = near_links(classes, scratch, distance, bucket_rows)
    roots = connected_components(links, scratch)
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.store(rooted.join(names, "root").select("fp", "component_id"), "named")
    scratch.drop("entries", "shared", "classes")
    return named


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    distance: int = 2,
    bucket_rows: int = BUCKET_ROWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``fingerprint`` and ``component_id`` to all rows, with the columns ``keep`` (default: all).

    A fingerprint bit is set where more than half of the hashes of the word shingles
    (repeats included) have it.  Rows link at ``distance`` or fewer differing bits;
    ``component_id`` is the smallest identifier reachable over links.

    Rows with one fingerprint are one class.  Bits are grouped so that correlated
    ones share a group; each class gets thresholds per group by dynamic programming
    over estimated candidate counts, is listed in an index under its value in each
    group, and probes all values within its thresholds.  The number of groups is the
    one with the least estimated cost.  Buckets are verified in blocks and give a
    spanning forest of their links, never all pairs; buckets of more than
    ``bucket_rows`` classes are linked through values within one bit, in groups of at
    most 65.  No bucket is skipped.

    A null or blank text has fingerprint zero and links like any other.  Null
    identifiers never name a component unless it has no other, when it is null.
    Repeated rows share a class; an empty table gives no rows.  Input columns named
    like result columns are replaced.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "simhash")
    marked = scratch.store(fingerprints(docs, text_col, width, keep), "marked")
    named = near_components(marked, scratch, id_col, distance, bucket_rows)
    joined = marked.join(named.withColumnRenamed("fp", "class"), F.col("fp") == F.col("class"), "left")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return unpacked(joined, docs.columns if keep is None else keep, digits, "component_id")
