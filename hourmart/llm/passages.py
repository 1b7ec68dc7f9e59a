"""Repeated paragraphs and passages across documents, by MinHash banding."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, map_arrow, tuned
from hourmart.llm.components import connected_components

#: Words of a shingle, and the Jaccard similarity from which paragraphs are near copies.
SHINGLE, SIMILARITY = 5, 0.8
#: Chance that two paragraphs of just that similarity share a band, and values of a band.
RECALL, BAND_ROWS = 0.995, 3
#: Words of the shortest paragraph, and of a passage inside a paragraph.
LEAST_WORDS = 25
#: Any common run of LEAST_WORDS + SPAN - 1 words has a passage that both texts list.
SPAN = 26
#: Words that are handled at once, and their overlap.
PIECE_WORDS, OVERLAP_WORDS = 200_000, 128
#: Different paragraphs of a bucket that are compared in one block.
BLOCK = 2_000
PARAGRAPH, PASSAGE = 0, 1
#: Words of texts whose units are found together; one text may have more.
GROUP_WORDS = 40_000
_UNIT = ("doc_id", "kind", "start", "words", "h1", "h2", "bands")

_POWERS: dict[int, np.ndarray] = {}
_SEEDS: dict[int, list] = {}
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """The fewest bands that reach the recall at the similarity."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


# Hashes


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first powers of a base; a task computes them once, up to the longest asked for."""
    found = _POWERS.get(int(base))
    if found is None or len(found) < n:
        found = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(2 * n, 64), base), dtype=np.uint64)])
        _POWERS[int(base)] = found
    return found[:n]


def _runs(words: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Hash of every run of ``width`` words: a polynomial of the words' hashes, mixed."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k, power in enumerate(_powers(base, width)):
        out += words[k : k + len(out)] * power
    return _mix(out)


def _windows(words: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """The same as ``_runs`` from sums of all words before: the base is odd, so it has an inverse."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(base, len(words)), dtype=np.uint64)])
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    return _mix((sums[width:] - sums[:n]) * _powers(inverse, n))


def _runs_at(words: np.ndarray, at: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """``_runs`` at some places."""
    out = np.zeros(len(at), np.uint64)
    for k, power in enumerate(_powers(base, width)):
        out += words[at + k] * power
    return _mix(out)


def _whole(words: np.ndarray, starts: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of the stretches of words that begin at ``starts`` and fill the array."""
    lengths = np.diff(np.append(starts, len(words)))
    place = np.arange(len(words)) - np.repeat(starts, lengths)
    power = _powers(base, int(lengths.max(initial=1)))
    sums = np.add.reduceat(words * power[place], starts)
    return _mix(sums + lengths.astype(np.uint64))


def _sliding(x: np.ndarray, pick: np.ufunc, span: int) -> np.ndarray:
    width = 1
    while width < span:
        step = min(width, span - width)
        x = pick(x[: len(x) - step], x[step:])
        width += step
    return x


def _chosen(values: np.ndarray, span: int, firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions that hold the smallest value of some ``span`` neighbouring ones.

    The values of several texts lie side by side: ``counts`` of them from ``firsts`` on.
    A text of fewer values than ``span`` counts as one stretch.
    """
    mark = np.zeros(len(values), bool)
    full = counts > span
    if full.any():
        least = _sliding(values, np.minimum, span)
        inside = np.zeros(len(least) + 1, np.int64)
        np.add.at(inside, firsts[full], 1)
        np.add.at(inside, firsts[full] + counts[full] - span + 1, -1)
        # Stretches that run over a text's end count for nothing.
        least = np.where(np.cumsum(inside[:-1]) > 0, least, np.uint64(0))
        edge = np.zeros(span - 1, np.uint64)
        mark |= _sliding(np.concatenate([edge, least, edge]), np.maximum, span) == values
    some = ~full & (counts > 0)
    if some.any():
        sizes = counts[some]
        heads = np.cumsum(sizes) - sizes
        places = np.arange(sizes.sum()) - np.repeat(heads, sizes) + np.repeat(firsts[some], sizes)
        own = values[places]
        mark[places[own == np.repeat(np.minimum.reduceat(own, heads), sizes)]] = True
    return np.flatnonzero(mark)


def _pieces(text: str) -> Iterator[tuple[int, list[bytes], list[int]]]:
    """(first word, words, starts of lines) of a text; very many words come in overlapping pieces.

    A paragraph ends with its piece.
    """
    words, lines = [], []
    for line in text.encode().lower().split(b"\n"):
        own = line.split()
        if own:
            lines.append(len(words))
            words.extend(own)
    if len(words) <= PIECE_WORDS:
        if len(words) >= LEAST_WORDS:
            yield 0, words, lines
        return
    for begin in range(0, len(words) - OVERLAP_WORDS, PIECE_WORDS - OVERLAP_WORDS):
        part = words[begin : begin + PIECE_WORDS]
        if len(part) >= LEAST_WORDS:
            yield begin, part, sorted({max(s - begin, 0) for s in lines if s - begin < len(part)})


class _Group:
    """Pieces of texts whose units are found together, in arrays."""

    def __init__(self) -> None:
        self.words: list[bytes] = []
        self.lines: list[int] = []
        #: (text, doc_id, first word in the text, first word here, words)
        self.pieces: list[tuple[int, int, int, int, int]] = []

    def add(self, text: int, doc: int, begin: int, words: list[bytes], lines: list[int]) -> None:
        here = len(self.words)
        self.pieces.append((text, doc, begin, here, len(words)))
        self.words.extend(words)
        self.lines.extend(here + s for s in lines)

    def units(self, bands: int) -> pa.RecordBatch:
        """(doc_id, kind, start, words, h1, h2, bands): each different unit of a text once."""
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        text, doc, begin, here, size = (np.array(c, np.int64) for c in zip(*self.pieces, strict=True))
        start, length, first, second, keys = _paragraphs(hashed, np.array(self.lines), bands)
        runs = _windows(hashed, LEAST_WORDS, _BASES[0])
        at = _chosen(runs, SPAN, here, size - LEAST_WORDS + 1)
        # Paragraphs first, then passages.
        places = np.concatenate([start, at])
        kinds = np.repeat(np.array([PARAGRAPH, PASSAGE], np.int32), [len(start), len(at)])
        lengths = np.concatenate([length, np.full(len(at), LEAST_WORDS)])
        one = np.concatenate([first, runs[at]]).view(np.int64)
        two = np.concatenate([second, _runs_at(hashed, at, LEAST_WORDS, _BASES[1])]).view(np.int64)
        piece = np.searchsorted(here, places, side="right") - 1
        order = np.lexsort((two, one, kinds, text[piece]))
        same = np.ones(max(len(order) - 1, 0), bool)
        for column in (text[piece], kinds, one, two):
            same &= column[order][1:] == column[order][:-1]
        kept = np.sort(order[np.concatenate([[True], ~same])]) if len(order) else order
        # A paragraph's keys are the rows of a matrix; passages have none.
        own = keys[kept[kept < len(start)]].astype(np.uint64).view(np.int64)
        offsets = np.concatenate([np.arange(len(own) + 1), np.full(len(kept) - len(own), len(own))]) * bands
        missing = pa.array(kept >= len(start))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(own.ravel()), mask=missing)
        columns = (doc[piece], kinds, places - here[piece] + begin[piece], lengths, one, two)
        return pa.RecordBatch.from_arrays([*(pa.array(c[kept]) for c in columns), lists], _UNIT)


def _seeds(count: int) -> list[tuple[np.uint64, np.uint64]]:
    """Odd factors and masks of the hash functions."""
    if count not in _SEEDS:
        draws = np.random.RandomState(5).randint(0, 1 << 62, size=(count, 2)).astype(np.uint64)
        _SEEDS[count] = [(a * np.uint64(2) + np.uint64(1), b) for a, b in draws]
    return _SEEDS[count]


def _paragraphs(hashed: np.ndarray, starts: np.ndarray, bands: int) -> tuple[np.ndarray, ...]:
    """Starts, lengths, two content hashes and band keys of the paragraphs that are long enough."""
    ends = np.append(starts[1:], len(hashed))
    long = np.flatnonzero(ends - starts >= LEAST_WORDS)
    if not len(long):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64), np.zeros((0, bands), np.uint64)
    first, second = (_whole(hashed, starts, base)[long] for base in _BASES)
    shingles = _runs(hashed, SHINGLE, _BASES[0])
    counts = ends[long] - starts[long] - SHINGLE + 1
    cells = np.repeat(starts[long], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    own, heads = shingles[cells], np.cumsum(counts) - counts
    # The shingles' hashes are mixed already: a mask and an odd factor reorder them.
    least = [np.minimum.reduceat((own ^ b) * a, heads) for a, b in _seeds(bands * BAND_ROWS)]
    keys = np.zeros((len(long), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(long), band + 1, np.uint64)
        for value in least[band * BAND_ROWS : (band + 1) * BAND_ROWS]:
            key = _mix(key * _BASES[0] + value)
        keys[:, band] = key
    return starts[long], ends[long] - starts[long], first, second, keys


def list_units(docs: DataFrame, id_col: str, text_col: str, bands: int) -> DataFrame:
    """(doc_id, kind, start, words, h1, h2, bands): each different unit of a text once.

    Texts are put together up to ``GROUP_WORDS`` words, so arrays are long enough to pay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = _Group()
            texts = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for k, (doc, text) in enumerate(texts):
                found = list(_pieces(text))
                if group.pieces and len(group.words) + sum(len(w) for _, w, _ in found) > GROUP_WORDS:
                    yield group.units(bands)
                    group = _Group()
                for piece in found:
                    group.add(k, doc, *piece)
            if group.pieces:
                yield group.units(bands)

    return map_arrow(
        _texts(docs, id_col, text_col),
        run,
        "doc_id long, kind int, start long, words long, h1 long, h2 long, bands array<long>",
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    ).where("doc_id is not null and text is not null")


# Near copies of paragraphs


def _shingles(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, shingles) of one occurrence of each wanted paragraph (cid, doc_id, start, words, h1)."""
    asked = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("cid", "start", "words", "h1")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist(), strict=True):
                words = text.encode().lower().split()
                for place in places:
                    part = words[place["start"] : place["start"] + place["words"]]
                    hashed = np.fromiter(map(xxhash.xxh64_intdigest, part), np.uint64, len(part))
                    # Rows that share an identifier differ in their texts: only the right one has the hash.
                    if len(part) == place["words"] and _whole(hashed, np.array([0]), _BASES[0]).view(np.int64)[0] == place["h1"]:
                        found = np.unique(_runs(hashed, SHINGLE, _BASES[0])).view(np.int64)
                        rows.append((place["cid"], found.tolist()))
            cids, lists = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cids, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], ["cid", "shingles"]
            )

    found = map_arrow(docs.join(asked, "doc_id").select("text", "asked"), run, "cid long, shingles array<long>")
    return found.groupBy("cid").agg(F.first("shingles").alias("shingles"))


def _group_links(cids: list[int], sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of one block whose exact Jaccard similarity is high enough."""
    sizes = np.array([len(s) for s in sets])
    member = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, member = values[order], member[order]
    rest = np.ones(len(sets), bool)
    for first in range(len(sets)):
        if not rest[first]:
            continue
        rest[first], queue = False, [first]
        while queue and rest.any():
            one = queue.pop()
            a, b = np.searchsorted(values, sets[one], "left"), np.searchsorted(values, sets[one], "right")
            at = np.repeat(a, b - a) + np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
            common = np.bincount(member[at], minlength=len(sets))
            near = rest & (common >= similarity * (sizes[one] + sizes - common) - 1e-9)
            for other in np.flatnonzero(near).tolist():
                yield cids[one], cids[other]
            rest[near] = False
            queue.extend(np.flatnonzero(near).tolist())


def _block_links(similarity: float):  # noqa: ANN202
    """Links inside blocks of rows that arrive sorted by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("band", "key", "low", "high", "cid")]
                lists = (x.values.to_numpy() for x in batch.column("shingles"))
                yield from zip(*columns, lists, strict=True)

        for _, group in itertools.groupby(rows(), key=lambda r: r[:4]):
            held = {r[4]: r[5] for r in group}
            links = list(_group_links(list(held), list(held.values()), similarity)) if len(held) > 1 else []
            if links:
                u, v = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def paragraph_links(docs: DataFrame, classes: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """Links (u, v) that connect all near copies among the different paragraphs ``classes``."""
    listed = classes.where(F.col("kind") == PARAGRAPH)
    keys = listed.select("cid", F.posexplode("bands").alias("band", "key"))
    crowd = keys.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = scratch.store(keys.join(crowd, ["band", "key"]), "shared")
    wanted = listed.join(shared.select("cid").distinct(), "cid").select("cid", "doc_id", "start", "words", "h1")
    sets = scratch.store(_shingles(docs, wanted), "shingles")

    # A bucket's members are dealt into blocks; each two blocks meet in one group.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    dealt = shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(
        "band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "cid"
    )
    groups = (
        dealt.join(sets, "cid")
        .repartition("band", "key", "low", "high")
        .sortWithinPartitions("band", "key", "low", "high")
    )
    return map_arrow(groups, _block_links(similarity), "u long, v long")


# Removals


def _stretches(units: DataFrame) -> DataFrame:
    """(component_id, doc_id, first_word, end_word, n_units, kept) of units that cover words without a gap.

    Words of a unit that stays are never in a removal.  ``n_units`` are those of the
    stretch's own kind that have words in it.
    """
    stays, goes = F.col("kept").cast("long"), (~F.col("kept")).cast("long")

    def event(at: Column, sign: int) -> Column:
        begun = F.lit(int(sign > 0))
        return F.struct(
            at.alias("at"),
            (sign * stays).alias("stay"),
            (sign * goes).alias("go"),
            (begun * stays).alias("stay_begun"),
            (begun * goes).alias("go_begun"),
        )

    events = units.select(
        "component_id", "doc_id", F.explode(F.array(event(F.col("start"), 1), event(F.col("start") + F.col("words"), -1))).alias("e")
    )
    sums = ("stay", "go", "stay_begun", "go_begun")
    places = events.groupBy("component_id", "doc_id", F.col("e.at").alias("at")).agg(*[F.sum(f"e.{c}").alias(c) for c in sums])
    order = Window.partitionBy("component_id", "doc_id").orderBy("at")
    # Units that cover the words from one place to the next.
    pieces = places.select(
        "component_id",
        "doc_id",
        "at",
        F.lead("at").over(order).alias("next"),
        F.sum("stay").over(order).alias("stay"),
        F.sum("go").over(order).alias("go"),
        "stay_begun",
        "go_begun",
    ).withColumn("kept", F.when(F.col("stay") > 0, True).when(F.col("go") > 0, False))
    fresh = (~F.col("kept").eqNullSafe(F.lag("kept").over(order))).cast("long")
    pieces = pieces.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(order)).where("kept is not null")
    there, begun = F.when(F.col("kept"), F.col("stay")).otherwise(F.col("go")), F.when(F.col("kept"), F.col("stay_begun")).otherwise(F.col("go_begun"))
    return pieces.groupBy("component_id", "doc_id", "island", "kept").agg(
        F.min("at").alias("first_word"),
        F.max("next").alias("end_word"),
        (F.min_by(there - begun, "at") + F.sum(begun)).alias("n_units"),
    )


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Stretches of words that repeat across documents.

    One row per stretch of a document that units cover without a gap: doc_id,
    component_id, first_word, end_word (words from 0, end exclusive), n_words, n_units
    (that have words there), n_docs (of the component) and kept.  Of equal units and
    their near copies those in the document with the smallest identifier stay, whatever
    lies next to them, unless they lie in a unit whose equal stays elsewhere; the others are
    removals, less the words of units that stay.  So each unit or a near copy stays somewhere, and no word outside a unit is marked.  Documents that
    share nothing have no row.

    Units of a text are its paragraphs (lines of ``LEAST_WORDS`` words or more), and
    passages for what was pasted into a paragraph: stretches of that many words at
    places that depend on the words around them alone, so texts with a common run of
    ``LEAST_WORDS + SPAN - 1`` words share one.  Equal units are one class.  Classes
    of paragraphs with MinHash values in common in a band, their number tuned for recall, are
    compared by the exact Jaccard similarity of their shingles.  A bucket's links are a
    spanning forest; large buckets are compared in blocks, two at a time.  Near copies,
    and units that meet within a few words of a document, form components; these name
    what belongs together and decide nothing.

    Words are split at white space, A-Z lower-cased.  Null texts and rows without
    identifier take no part; rows that repeat an identifier are one document.  Copies
    inside one document alone do not count.  An empty table gives no rows; other
    columns are not read.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "passages")
    units = scratch.store(list_units(docs, id_col, text_col, tune_bands(similarity)), "units")
    key = ("kind", "h1", "h2")
    classes = scratch.store(
        units.groupBy(*key)
        .agg(
            F.min(F.struct("doc_id", "start", "words")).alias("first"),
            F.max("doc_id").alias("last"),
            F.first("bands").alias("bands"),
        )
        .where(f"kind = {PARAGRAPH} or first.doc_id <> last")
        .select(*key, "first.*", "last", "bands")
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    links = scratch.store(
        paragraph_links(_texts(docs, id_col, text_col), classes, scratch, similarity), "links"
    )
    # Classes that repeat, or are near a paragraph of another document.
    ends = links.select("u").union(links.select("v")).distinct().withColumnRenamed("u", "cid")
    repeated = classes.where("doc_id <> last").select("cid").union(ends).distinct()
    kept = classes.join(repeated, "cid").select("cid", *key, F.col("doc_id").alias("least"))
    members = scratch.store(units.join(kept, [*key]).select("cid", "least", "doc_id", "start", "words"), "members")
    scratch.drop("units", "classes", "shared", "shingles")

    # A group is a class and its near copies; the document with the smallest identifier keeps it.
    groups = connected_components(links, scratch, "groups")
    grouped = members.join(groups, members["cid"] == groups["node"], "left").select(
        F.coalesce("root", "cid").alias("group"), "least", "doc_id", "start", "words"
    )
    grouped = scratch.store(grouped, "grouped")
    keepers = grouped.groupBy("group").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
    marked = grouped.join(keepers.where("keeper <> last"), "group").withColumn("kept", F.col("doc_id") == F.col("keeper"))
    # What lies in a unit whose equal stays elsewhere stays there with it.
    end = F.col("start") + F.col("words")
    copied = F.max(F.when(~F.col("kept") & (F.col("least") == F.col("keeper")), end)).over(Window.partitionBy("doc_id").orderBy("start"))
    marked = marked.select(
        "group", "doc_id", "start", "words", (F.col("kept") & (F.coalesce(copied, F.lit(0)) < end)).alias("kept")
    )
    marked = scratch.store(marked, "marked")
    scratch.drop("links", "members", "grouped")

    # Units that meet in a few words of a document belong together: each is linked to the first.
    cells = F.sequence((F.col("start") / SPAN).cast("long"), ((F.col("start") + F.col("words") - 1) / SPAN).cast("long"))
    covered = scratch.store(marked.select("group", "doc_id", F.explode(cells).alias("cell")), "covered")
    first = covered.groupBy("doc_id", "cell").agg(F.min("group").alias("v"))
    overlaps = covered.join(first, ["doc_id", "cell"]).select(F.col("group").alias("u"), "v").where("u <> v")
    roots = connected_components(overlaps.distinct(), scratch)
    rooted = marked.join(roots, marked["group"] == roots["node"], "left").select(
        F.coalesce("root", "group").alias("component_id"), "doc_id", "start", "words", "kept"
    )
    rooted = scratch.store(rooted, "rooted")
    scratch.drop("marked", "covered")
    sizes = rooted.select("component_id", "doc_id").distinct().groupBy("component_id").agg(F.count(F.lit(1)).alias("n_docs"))
    return _stretches(rooted).join(sizes, "component_id").select(
        "doc_id",
        "component_id",
        "first_word",
        "end_word",
        (F.col("end_word") - F.col("first_word")).alias("n_words"),
        "n_units",
        "n_docs",
        "kept",
    )
