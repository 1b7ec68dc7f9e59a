"""Exact top-k search with MaxScore over sharded postings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import partitions, tuned

#: Rows of a shard and queries of a block: what one task holds at a time.
SHARD_ROWS = 32_768
BLOCK_QUERIES = 4_096
#: Weights beyond this are cut to it, so that no sum overflows.
MOST_WEIGHT = 1 << 26
#: A list that holds this share of a shard's rows is kept as a column of all rows.
DENSE_SHARE = 0.25
#: Rows at either end of a list, and lists of a query, that give the first threshold.
SEED_ROWS, SEED_LISTS = 8, 6
#: Lists that are probed before rows are dropped again.
PROBE_STEP = 4


def quantised(vector: str | Column, scale: int = 256) -> Column:
    """Whole numbers floor(scale * x); null if the vector or a component is null or not finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector

    def usable(x: Column) -> Column:
        wide = x.cast("double")
        return x.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < float("inf"))

    def whole(x: Column) -> Column:
        cut = F.least(F.lit(float(MOST_WEIGHT)), F.greatest(F.lit(-float(MOST_WEIGHT)), F.lit(float(scale)) * x.cast("double")))
        return F.floor(cut)

    return F.when(F.forall(vector, usable), F.transform(vector, whole))


def dense_vectors(frame: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, terms, weights) of dense vectors: a term is a position.

    Vectors that are null or hold a null or non-finite component, and rows without
    identifier, take no part.  Of rows that repeat an identifier the smallest vector counts.
    """
    vectors = frame.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), quantised(F.col(f"`{vector_col}`"), scale).alias("weights")
    ).where("id is not null and weights is not null")
    once = vectors.groupBy("id").agg(F.min("weights").alias("weights"))
    terms = F.when(F.size("weights") > 0, F.sequence(F.lit(0), F.size("weights") - 1))
    return once.select("id", F.coalesce(terms, F.array().cast("array<int>")).alias("terms"), "weights")


class Shard:
    """Postings of a shard: per term the rows that have it and their weights."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        self.ids = ids
        n = len(ids)
        rows = np.repeat(np.arange(n), lengths)
        order = np.lexsort((rows, terms))
        terms, rows, weights = terms[order], rows[order], weights[order]
        found, starts = np.unique(terms, return_index=True)
        self.lists: dict[int, tuple[np.ndarray | None, np.ndarray]] = {}
        self.range: dict[int, tuple[int, int]] = {}
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for term, a, b in zip(found.tolist(), starts, [*starts[1:], len(terms)], strict=True):
            at, w = rows[a:b], weights[a:b]
            # Rows without the term count as weight 0.
            low, high = int(w.min()), int(w.max())
            self.range[term] = (low, high) if b - a == n else (min(low, 0), max(high, 0))
            by_weight = at[np.argsort(w, kind="stable")]
            self.seeds[term] = (by_weight[:SEED_ROWS], by_weight[::-1][:SEED_ROWS])
            if b - a >= DENSE_SHARE * n:
                column = np.zeros(n, np.int64)
                column[at] = w
                self.lists[term] = (None, column)
            else:
                self.lists[term] = (at, w)

    def weights(self, term: int, rows: np.ndarray) -> np.ndarray:
        at, w = self.lists[term]
        if at is None:
            return w[rows]
        place = np.minimum(np.searchsorted(at, rows), len(at) - 1)
        return np.where(at[place] == rows, w[place], 0)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers and scores of the k best rows but ``skip``; ties to smaller identifiers."""
        asked = [(t, w) for t, w in zip(terms.tolist(), weights.tolist(), strict=True) if w and t in self.lists]
        bounds = [max(w * self.range[t][0], w * self.range[t][1]) for t, w in asked]
        order = sorted(range(len(asked)), key=lambda i: -bounds[i])
        asked, bounds = [asked[i] for i in order], [bounds[i] for i in order]
        # What the lists from the i-th on can add at most.
        rest = np.append(np.cumsum(bounds[::-1], dtype=np.int64)[::-1], 0)

        # A first threshold from the rows at the favourable ends of the strongest lists.
        threshold = None
        seeds = [self.seeds[t][int(w > 0)] for t, w in asked[:SEED_LISTS]]
        if seeds:
            rows = np.unique(np.concatenate(seeds))
            rows = rows[self.ids[rows] != skip] if skip is not None else rows
            if len(rows) >= k:
                scores = np.zeros(len(rows), np.int64)
                for t, w in asked:
                    scores += w * self.weights(t, rows)
                threshold = int(np.partition(scores, len(rows) - k)[len(rows) - k])

        # The non-essential lists together stay below the threshold.
        split = len(asked)
        while threshold is not None and split and rest[split - 1] < threshold:
            split -= 1
        sums = np.zeros(len(self.ids), np.int64)
        for t, w in asked[:split]:
            at, column = self.lists[t]
            if at is None:
                sums += w * column
            else:
                sums[at] += w * column
        alive = np.arange(len(sums))
        if threshold is not None:
            alive = np.flatnonzero(sums + rest[split] >= threshold)
        sums = sums[alive]
        for j in range(split, len(asked)):
            t, w = asked[j]
            sums += w * self.weights(t, alive)
            if (j - split) % PROBE_STEP == PROBE_STEP - 1:
                near = sums + rest[j + 1] >= threshold
                alive, sums = alive[near], sums[near]
        found = self.ids[alive]
        if skip is not None:
            found, sums = found[found != skip], sums[found != skip]
        if len(found) > k:
            least = np.partition(sums, len(sums) - k)[len(sums) - k]
            found, sums = found[sums >= least], sums[sums >= least]
        best = np.lexsort((found, -sums))[:k]
        return found[best], sums[best]


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    lists = table["terms"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    weights = table["weights"].combine_chunks().flatten().to_numpy()
    return table["id"].to_numpy(), lengths, lists.flatten().to_numpy(), weights


def top_k(
    queries: DataFrame,
    rows: DataFrame,
    k: int,
    skip_own: bool = True,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, id, score): each query's k rows with the greatest inner product.

    Both inputs have (id, terms, weights): distinct terms with signed whole weights, so
    texts with term weights and dense vectors search alike.  Ties go to the smaller
    identifier; queries with fewer than k rows get all of them.  With ``skip_own`` a
    row with the query's identifier is no candidate.  Rows without a common term
    score 0 and can be results.

    Rows are dealt into shards and queries into blocks, of bounded size; each pair of
    them meets in one task.  There a query's lists are ordered by the most that they
    can add.  Lists that together stay below the k-th best score known so far are not
    essential: only the others are traversed, and rows that can still reach the
    threshold are looked up in the rest, fewer after every few lists.  The shards'
    best k are merged.  An empty table gives no rows.
    """
    spark = tuned(rows.sparkSession)
    shards = max(partitions(spark), -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_queries))

    def place(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt_rows = rows.select("id", "terms", "weights", place(shards).alias("shard"), everywhere(blocks).alias("block"))
    dealt_queries = queries.select(
        "id", "terms", "weights", everywhere(shards).alias("shard"), place(blocks).alias("block")
    )

    def search(own: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if own.num_rows and asked.num_rows:
            shard = Shard(*_rows(own))
            ids, lengths, terms, weights = _rows(asked)
            ends = np.cumsum(lengths)
            for one, a, b in zip(ids.tolist(), ends - lengths, ends, strict=True):
                found, scores = shard.search(terms[a:b], weights[a:b], k, one if skip_own else None)
                out.append((np.full(len(found), one), found, scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "id", "score"), columns, strict=True)))

    partial = (
        dealt_rows.groupBy("shard", "block")
        .cogroup(dealt_queries.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
