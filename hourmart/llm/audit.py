"""Audit of how quality filters interact, from a sparse document-term matrix."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, map_arrow, tuned

FILTERS = "ABCDE"
#: A: fewest words.  B: least different words, in % of all.  C: most capitals, in % of code points.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
#: D: symbols that no text may hold.
SYMBOLS = re.compile(rb"[#$%&*|]")
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of texts after which a shard of the matrix is closed.
SHARD_BYTES = 16 << 20
#: Words of a shard are numbered below this; a word's code is its first place, shard times this plus number.
CODES = 1 << 31

DOCUMENT = ("id", "part", "capitals", "symbols", "digest")


class _Shard:
    """Rows of the matrix in the making, with the shard's own numbers of words."""

    def __init__(self) -> None:
        self.size = 0
        self.codes: dict[bytes, int] = {}
        self.documents: list[tuple] = []
        self.pointers = [0]
        self.steps: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, key: int | None, part: str, text: str | None) -> None:
        data, codes = (text or "").encode(), self.codes
        words = data.split()
        row = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int32, len(words))
        columns, counts = np.unique(row, return_counts=True)
        self.pointers.append(self.pointers[-1] + len(columns))
        # Steps between a row's columns are small numbers, which pack well.
        self.steps.append(np.diff(columns, prepend=np.int32(0)))
        self.counts.append(counts.astype(np.int32))
        capitals = len(data) - len(data.translate(None, CAPITALS))
        flags = (100 * capitals > MOST_CAPITALS * len(text or ""), SYMBOLS.search(data) is not None)
        self.documents.append((key, part, *flags, hashlib.sha256(data).digest()))
        self.size += len(data)

    def packed(self) -> bytes:
        """The documents as a compressed Arrow stream; list offsets are the row pointers."""
        types = (pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.binary())
        columns = [pa.array(c, t) for c, t in zip(zip(*self.documents, strict=True), types, strict=True)]
        for values in (self.steps, self.counts):
            flat = pa.array(np.concatenate(values), pa.int32())
            columns.append(pa.ListArray.from_arrays(pa.array(self.pointers, pa.int32()), flat))
        batch = pa.RecordBatch.from_arrays(columns, [*DOCUMENT, "steps", "counts"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        return sink.getvalue().to_pybytes()


def _shards(docs: DataFrame) -> DataFrame:
    """Shards of (id, part, text): a row with the packed documents, and one for each different word."""
    schema = pa.schema([("nth", pa.int64()), ("packed", pa.binary()), ("place", pa.int64()), ("word", pa.binary())])

    def rows_of(nth: int, shard: _Shard) -> Iterator[pa.RecordBatch]:
        one = [pa.array([nth]), pa.array([shard.packed()], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
        yield pa.RecordBatch.from_arrays(one, schema=schema)
        words, step = list(shard.codes), 1 << 15
        for start in range(0, len(words), step):
            own = words[start : start + step]
            places = pa.array(np.arange(start, start + len(own)))
            columns = [pa.array(np.full(len(own), nth)), pa.nulls(len(own), pa.binary()), places, pa.array(own, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, nth = _Shard(), 0
        for batch in batches:
            columns = [batch.column(name) for name in ("id", "part", "text")]
            for key, part, text in zip(*columns, strict=True):
                shard.add(key.as_py(), part.as_py(), text.as_py())
                if shard.size >= SHARD_BYTES:
                    yield from rows_of(nth, shard)
                    shard, nth = _Shard(), nth + 1
        if shard.documents:
            yield from rows_of(nth, shard)

    return map_arrow(docs, run, "nth long, packed binary, place long, word binary")


class Csr(NamedTuple):
    """A shard: row r has the counts and word codes between pointers r and r + 1."""

    documents: pa.Table
    pointers: np.ndarray
    columns: np.ndarray
    counts: np.ndarray


def _csr(packed: bytes, codes: pa.Table) -> Csr:
    """A shard with its words in the numbers of the whole corpus."""
    [batch] = pa.ipc.open_stream(packed)
    places = codes.column("place").to_numpy()
    table = np.zeros(len(places), np.int64)
    table[places] = codes.column("code").to_numpy()
    steps, counts = batch.column("steps"), batch.column("counts")
    pointers = steps.offsets.to_numpy()
    # Sums of steps over all rows, less what earlier rows add.
    sums = np.cumsum(steps.values.to_numpy(), dtype=np.int64)
    before = np.concatenate(([0], sums))[pointers[:-1]]
    columns = table[sums - np.repeat(before, np.diff(pointers))]
    return Csr(pa.Table.from_batches([batch.select(list(DOCUMENT))]), pointers, columns, counts.values.to_numpy())


class Shards(NamedTuple):
    """The matrix in parts: packed documents by shard, and the codes of their words."""

    packed: DataFrame
    codes: DataFrame
    #: (code, word)
    dictionary: DataFrame

    def each(self, function: Callable[[Csr], pa.Table], schema: str) -> DataFrame:
        """The rows that a function gives for each shard; a task holds one shard at a time."""

        def run(packed: pa.Table, codes: pa.Table) -> pa.Table:
            [data] = packed.column("packed").to_pylist()
            return function(_csr(data, codes))

        return self.packed.groupBy("shard").cogroup(self.codes.groupBy("shard")).applyInArrow(run, schema)


def document_term_shards(docs: DataFrame, scratch: Scratch) -> Shards:
    """Shards of the document-term matrix of (id, part, text).

    Texts are read once, into shards of bounded size with words in numbers of their own,
    which are stored.  Only a shard's different words are shuffled: of all places of a
    word the first is its code, and goes back to the shards.  Codes are unique, not
    dense.  A word that every shard has meets itself as often as there are shards.
    """
    local = scratch.store(_shards(docs).withColumn("task", F.spark_partition_id()), "local")
    # One row a task: where its shards' numbers start.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = local.where("packed is not null").groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    starts = scratch.store(tasks.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    numbered = local.join(F.broadcast(starts), "task").withColumn("shard", F.col("start") + F.col("nth"))

    seen = F.col("shard") * CODES + F.col("place")
    placed = numbered.where("word is not null").select("word", seen.alias("seen"))
    coded = placed.withColumn("code", F.min("seen").over(Window.partitionBy("word")))
    codes = coded.select(
        F.floor(F.col("seen") / CODES).alias("shard"), F.pmod("seen", F.lit(CODES)).alias("place"), "code"
    )
    dictionary = coded.where("seen = code").select("code", "word")
    return Shards(numbered.where("packed is not null").select("shard", "packed"), codes, dictionary)


def document_term_matrix(shards: Shards) -> DataFrame:
    """The shards as compressed sparse rows: (ids, pointers, columns, counts)."""

    def run(csr: Csr) -> pa.Table:
        values = [csr.documents.column("id").to_pylist(), *(v.tolist() for v in csr[1:])]
        return pa.table([pa.array([v], pa.list_(pa.int64())) for v in values], names)

    names = ["ids", "pointers", "columns", "counts"]
    return shards.each(run, ", ".join(f"{n} array<long>" for n in names))


def _row_figures(shards: Shards) -> DataFrame:
    """(id, part, capitals, symbols, digest, n_words, n_distinct): sums and nonzero counts of the rows."""

    def run(csr: Csr) -> pa.Table:
        sums = np.concatenate(([0], np.cumsum(csr.counts, dtype=np.int64)))[csr.pointers]
        row = np.repeat(np.arange(len(csr.pointers) - 1), np.diff(csr.pointers))
        nonzero = np.bincount(row[csr.counts > 0], minlength=len(csr.pointers) - 1)
        found = csr.documents.append_column("n_words", pa.array(np.diff(sums)))
        return found.append_column("n_distinct", pa.array(nonzero.astype(np.int64)))

    schema = "id long, part string, capitals boolean, symbols boolean, digest binary, n_words long, n_distinct long"
    return shards.each(run, schema)


def filter_patterns(figures: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, documents, good, toxic): documents by the letters of the filters they fail.

    Whether an equal text has a smaller identifier (E) is decided on counts: rows are
    counted by identifier, then by text, before texts meet, so many copies of a text
    are a few rows there.  Only a text's rows with its smallest identifier pass.
    """
    letters = [
        ("A", F.col("n_words") < LEAST_WORDS),
        ("B", 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words")),
        ("C", F.col("capitals")),
        ("D", F.col("symbols")),
    ]
    fails = F.concat(*[F.when(failed, letter).otherwise("") for letter, failed in letters])
    rows = figures.groupBy("id", "part", "digest", fails.alias("fails")).agg(F.count(F.lit(1)).alias("n"))
    marked = rows.join(labels, rows["id"] == labels["label_id"], "left")
    marks = [F.coalesce(m, F.lit(False)).alias(m) for m in ("good", "toxic")]
    counted = marked.groupBy("digest", "part", "fails", *marks).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
    )
    least = F.min("first.id").over(Window.partitionBy("digest"))
    held = F.when(F.col("first.id") == least, F.col("first.n")).otherwise(0)
    split = counted.withColumn("passing", F.col("unnamed") + held)
    both = F.array(
        F.struct(F.col("fails").alias("fails"), F.col("passing").alias("n")),
        F.struct(F.concat("fails", F.lit("E")).alias("fails"), (F.col("n") - F.col("passing")).alias("n")),
    )
    opened = split.select("part", "good", "toxic", F.explode(both).alias("c")).where("c.n > 0")
    return opened.groupBy("part", F.col("c.fails").alias("fails")).agg(
        F.sum("c.n").alias("documents"),
        *[F.sum(F.when(F.col(m), F.col("c.n")).otherwise(0)).alias(m) for m in ("good", "toxic")],
    )


def order_table(patterns: DataFrame) -> DataFrame:
    """Every part, filter order and step of ``filter_patterns``, zeros included.

    A part has at most 32 patterns, so this is small however many documents there are.
    """
    orders = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    opened = patterns.withColumn("filter_order", F.explode(orders))
    # Where in the order a document goes; beyond the end if nothing removes it.
    places = [F.when(F.col("fails").contains(c), F.locate(c, F.col("filter_order"))) for c in FILTERS]
    gone = F.coalesce(F.least(*places), F.lit(len(FILTERS) + 1))
    stepped = opened.withColumn("gone", gone).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    stepped = stepped.withColumn("letter", F.substr("filter_order", F.col("step"), F.lit(1)))
    failing = F.col("fails").contains(F.col("letter"))
    removed = F.col("gone") == F.col("step")

    def total(condition, column="documents"):
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    table = stepped.groupBy("part", "filter_order", "step", "letter").agg(
        total(F.col("gone") > F.col("step")).alias("kept"),
        total(removed).alias("removed"),
        total(failing & (F.col("gone") < F.col("step"))).alias("redundant"),
        total(F.col("fails") == F.col("letter")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return table.withColumn("shapley", shapley).drop("letter")


def interaction_audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    part_col: str = "lang",
    text_col: str = "text",
    good: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """What five filters remove in each of their 120 orders.

    Filters fail a text with under 100 words (A), under 80 % different words (B), over
    10 % capitals A-Z (C), one of ``#$%&*|`` (D), or equal to that of a smaller
    identifier in the whole table (E).  Per value of ``part_col``, order and step:
    documents ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its
    filter, gone before), ``unique_fails`` (failing its filter only), ``good_lost``
    and ``toxic_lost`` (removed, with such a label), ``shapley`` (what its filter
    removes, summed over all orders).

    A and B come from row sums and nonzero counts of the document-term matrix.

    A null text is empty, a null part the empty string; both meet those that are so.
    A null identifier is smaller than none and greater than none, and has no labels.
    Repeated rows each count; those with a text's smallest identifier all pass E.  Of
    several labels of an identifier any that is 1 counts.  An empty table gives no rows.
    Only the named columns are read, so no name can clash.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "audit")
    named = docs.select(
        docs[f"`{id_col}`"].cast("long").alias("id"),
        F.coalesce(docs[f"`{part_col}`"].cast("string"), F.lit("")).alias("part"),
        docs[f"`{text_col}`"].alias("text"),
    )
    figures = scratch.store(_row_figures(document_term_shards(named, scratch)), "figures")
    scratch.drop("local")
    marks = labels.groupBy(labels[f"`{id_col}`"].cast("long").alias("label_id")).agg(
        F.max(F.coalesce(labels[f"`{good}`"] == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(labels[f"`{toxic}`"] == 1, F.lit(False))).alias("toxic"),
    )
    return order_table(scratch.store(filter_patterns(figures, marks), "patterns"))
