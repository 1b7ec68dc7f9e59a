"""Near copies of whole texts: MinHash bands, SimHash and rare shingles propose, the exact Jaccard similarity decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.llm import simhash
from hourmart.llm.common import Scratch, map_arrow, marked_keys, tuned, unpacked, with_texts, word_blocks
from hourmart.llm.components import connected_components
from hourmart.llm.passages import _BASES, BLOCK, SHINGLE, SIMILARITY, _block_links, _mix, _runs, _seeds, _whole, tune_bands

#: Chance that two texts of just the similarity share a band, and values of a band.
RECALL, BAND_ROWS = 0.9999, 4
#: Shingles of a bucket's members that are compared in one block, about.
BLOCK_SHINGLES = 1_000_000
#: Slots in which shingles are counted to put rare ones first, and slots in one row of a task's counts.
SLOTS, SLICE = 1 << 20, 1 << 14
#: Slack of bounds on similarities, for rounding.
SLACK = 1e-6


def _word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's words, A-Z lower-cased."""
    parts = [
        np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        for words in word_blocks((text or "").encode().lower())
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _shingles_of(words: np.ndarray) -> np.ndarray:
    """Hashes of all shingles; of the whole text if it is shorter than one."""
    if 0 < len(words) < SHINGLE:
        return _whole(words, np.array([0]), _BASES[0])
    return _runs(words, SHINGLE, _BASES[0])


def _band_keys(shingles: list[np.ndarray], bands: int) -> list[list[int] | None]:
    """MinHash keys of each text; None for a text without words."""
    out: list[list[int] | None] = [None] * len(shingles)
    full = [k for k, s in enumerate(shingles) if len(s)]
    if not full:
        return out
    own = np.concatenate([shingles[k] for k in full])
    heads = np.cumsum([0, *(len(shingles[k]) for k in full[:-1])])
    # The shingles' hashes are mixed already: a mask and an odd factor reorder them.
    least = [np.minimum.reduceat((own ^ b) * a, heads) for a, b in _seeds(bands * BAND_ROWS)]
    keys = np.zeros((len(full), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(full), band + 1, np.uint64)
        for value in least[band * BAND_ROWS : (band + 1) * BAND_ROWS]:
            key = _mix(key * _BASES[0] + value)
        keys[:, band] = key
    for k, row in zip(full, keys.view(np.int64).tolist(), strict=True):
        out[k] = row
    return out


def _marked(docs: DataFrame, text_col: str, bands: int) -> DataFrame:
    """(row, uid, h1, h2, size, bands, fp): content hashes, number of shingles, band keys and fingerprint of every row."""
    rows, texts_in, _ = with_texts(docs, text_col, None)
    rows = rows.withColumn("uid", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_in(batch)
            words = [_word_hashes(t) for t in texts]
            shingles = [_shingles_of(w) for w in words]
            hashes = [
                [int(_whole(w, np.array([0]), base).view(np.int64)[0]) if len(w) else 0 for w in words] for base in _BASES
            ]
            columns = [*hashes, [len(s) for s in shingles]]
            keys = pa.array(_band_keys(shingles, bands), pa.list_(pa.int64()))
            prints = pa.array([simhash.fingerprint(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("uid"), *(pa.array(c, pa.int64()) for c in columns), keys, prints],
                ["row", "uid", "h1", "h2", "size", "bands", "fp"],
            )

    row_type = rows.schema["row"].dataType.simpleString()
    return map_arrow(rows, run, f"row {row_type}, uid long, h1 long, h2 long, size long, bands array<long>, fp long")


def _sets(texts: DataFrame) -> DataFrame:
    """(cid, groups, shingles): the different shingles of each row of (cid, groups, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_shingles_of(_word_hashes(t))).view(np.int64) for t in batch.column("text").to_pylist()]
            lists = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), batch.column("groups"), lists], ["cid", "groups", "shingles"]
            )

    groups = texts.schema["groups"].dataType.simpleString()
    return map_arrow(texts, run, f"cid long, groups {groups}, shingles array<long>")


def _close_prints(classes: DataFrame, spark: SparkSession) -> DataFrame:
    """(cid, size, band, key): one bucket more for texts whose SimHash fingerprints are linked."""
    scratch = Scratch(spark, "near_copies-simhash")
    worded = classes.where("size > 0")
    prints = scratch.store(worded.select("fp").distinct(), "prints")
    links = scratch.store(simhash.near_links(prints, scratch), "links")
    roots = connected_components(links, scratch)
    key = F.coalesce("root", "fp").alias("key")
    return worded.join(roots, F.col("fp") == F.col("node"), "left").select("cid", "size", F.lit(-1).alias("band"), key)


def _compared(marked: DataFrame, wanted: DataFrame, text_col: str, similarity: float) -> DataFrame:
    """Links (u, v) inside the groups (band, key, low, high) that the classes ``wanted`` (cid, groups) meet in."""
    # One row of each class gives its text; texts that are not wanted stay where they are.
    texts = marked_keys(marked.select("uid", F.col(f"row.`{text_col}`").alias("text")), {"uid": "cid"}, wanted)
    texts = texts.where("likely").join(wanted, F.col("uid") == F.col("cid")).select("cid", "groups", "text")
    groups = (
        _sets(texts)
        .select(F.explode("groups").alias("group"), "cid", "shingles")
        .select("group.*", "cid", "shingles")
        .repartition("band", "key", "low", "high")
        .sortWithinPartitions("band", "key", "low", "high")
    )
    return map_arrow(groups, _block_links(similarity), "u long, v long")


def near_links(
    marked: DataFrame, classes: DataFrame, prints: DataFrame, scratch: Scratch, text_col: str, similarity: float
) -> DataFrame:
    """Links (u, v) of near copies among the different texts ``classes`` that share a band or a bucket of ``prints``."""
    keys = classes.select("cid", "size", F.posexplode("bands").alias("band", "key")).union(prints)
    crowds = (
        keys.groupBy("band", "key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("size").alias("weight"),
            F.bit_xor(F.xxhash64("cid")).alias("x"),
            F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y"),
        )
        .where("n > 1")
    )
    # Buckets of the same members need one comparison.
    once = crowds.groupBy("n", "x", "y").agg(F.min(F.struct("band", "key")).alias("at"), F.first("weight").alias("weight"))
    shared = scratch.store(keys.drop("size").join(once.select("at.*", "weight"), ["band", "key"]), "shared")

    # A bucket's members are dealt into blocks; each two blocks meet in one group.
    blocks = F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")
    own = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    dealt = shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    group = F.struct("band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    wanted = scratch.store(dealt.groupBy("cid").agg(F.collect_list(group).alias("groups")), "wanted")
    return _compared(marked, wanted, text_col, similarity)


# Near copies without a band in common


def _crowding(texts: DataFrame) -> np.ndarray:
    """About how common the shingles of each slot are, 0 to 255: eighths of a power of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            found = [_shingles_of(_word_hashes(t)) for t in batch.column("text").to_pylist()]
            slots = np.concatenate([np.zeros(0, np.uint64), *found]) % np.uint64(SLOTS)
            total += np.bincount(slots.astype(np.int64), minlength=SLOTS)
        starts = [a for a in range(0, SLOTS, SLICE) if total[a : a + SLICE].any()]
        sums = pa.array([total[a : a + SLICE].tobytes() for a in starts], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), sums], ["start", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s, np.int64) for s in table["sums"].to_pylist())
        return pa.table({"start": table["start"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "start long, sums binary"
    out = np.zeros(SLOTS, np.int64)
    for start, sums in map_arrow(texts, run, schema).groupBy("start").applyInArrow(add, schema).collect():
        out[start : start + SLICE] = np.frombuffer(sums, np.int64)
    return np.minimum(8 * np.log2(1 + out), 255).astype(np.uint8)


def _rarest(texts: DataFrame, crowding: np.ndarray, similarity: float) -> DataFrame:
    """(key, cid, root, size, place): of each text (cid, root, text) the shingles that come first, the rarest.

    Two sets of at least the similarity have so many shingles in common that the first
    common one, in any one order of all shingles, is among these in both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(_shingles_of(_word_hashes(t))) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            counts = np.where(sizes > 0, sizes - np.ceil(similarity * sizes - SLACK).astype(np.int64) + 1, 0)
            # Equally common ones follow their hashes, by which they are sorted.
            keys = [
                s[np.argsort(crowding[(s % np.uint64(SLOTS)).astype(np.int64)], kind="stable")[:n]]
                for s, n in zip(sets, counts.tolist(), strict=True)
            ]
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + 1
            ends = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), counts) for c in ("cid", "root")]
            columns = [np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64), *ends, np.repeat(sizes, counts), place]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "cid", "root", "size", "place"])

    return map_arrow(texts, run, "key long, cid long, root long, size long, place long")


def _candidates(entries: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """(u, v, size): texts of different components that may be near copies, by their common ``entries``; size is v's."""
    met = entries.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    met = scratch.store(met, "met")
    found = marked_keys(entries, {"key": "key"}, met).where("likely").drop("likely")
    found = scratch.store(found.join(met, "key"), "found")

    # Of two texts of different components one, at least, is not of the bucket's largest.
    crowds = found.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", "root"))
    crowds = crowds.groupBy("key").agg(largest["root"].alias("most"), (F.sum("n") - largest["n"]).alias("others"))
    blocks = F.ceil(F.col("others") / BLOCK).cast("int")
    placed = found.join(crowds, "key").select("key", "root", "most", blocks.alias("blocks"), F.struct("cid", "size", "place").alias("at"))
    one = placed.where("root <> most").withColumn("block", F.pmod(F.xxhash64("at.cid"), "blocks").cast("int"))
    two = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    two = two.select("key", "block", F.col("root").alias("root2"), F.col("at").alias("at2"))
    pairs = one.join(two, ["key", "block"]).where("root <> root2 and (root2 = most or at.cid < at2.cid)")
    pairs = pairs.select(F.least("at", "at2").alias("a"), F.greatest("at", "at2").alias("b"))
    sizes = (F.col("a.size"), F.col("b.size"))
    pairs = pairs.where(similarity * F.greatest(*sizes) <= F.least(*sizes) + SLACK)
    pairs = pairs.groupBy(F.col("a.cid").alias("u"), F.col("b.cid").alias("v"), sizes[0].alias("m"), sizes[1].alias("n")).agg(
        F.count(F.lit(1)).alias("common"),
        *[f(f"{side}.place").alias(f"{name}_{side}") for name, f in (("first", F.min), ("last", F.max)) for side in "ab"],
    )
    # No shingle before the first is common; the common ones up to the last are counted.
    need = similarity / (1 + similarity) * (F.col("m") + F.col("n")) - SLACK
    most = F.least(F.expr("m - first_a"), F.expr("n - first_b")) + 1
    rest = F.least(F.expr("m - last_a"), F.expr("n - last_b"))
    return pairs.where((most >= need) & (F.col("common") + rest >= need)).select("u", "v", F.col("n").alias("size"))


def missed_links(
    marked: DataFrame, classes: DataFrame, roots: DataFrame, scratch: Scratch, text_col: str, similarity: float
) -> DataFrame:
    """Links (u, v) of all near copies among ``classes`` that are in different components, as ``roots`` says."""
    rooted = classes.join(roots, F.col("cid") == F.col("node"), "left")
    known = rooted.where("copies > 1 or root is not null").select("h1", "h2", "cid", F.coalesce("root", "cid").alias("root"))
    known = scratch.store(known, "known")
    # Each class once; the texts of others than copies and linked ones are not sent.
    rows = marked.where("size > 0").select("uid", "h1", "h2", F.col(f"row.`{text_col}`").alias("text"))
    rows = marked_keys(rows, {"h1": "h1", "h2": "h2"}, known)
    joined = rows.where("likely").join(known, ["h1", "h2"], "left").where("cid is null or uid = cid")
    texts = joined.select(F.col("uid").alias("cid"), F.coalesce("root", "uid").alias("root"), "text").union(
        rows.where("not likely").select("uid", "uid", "text")
    )
    crowding = _crowding(marked.select(F.col(f"row.`{text_col}`").alias("text")))
    entries = scratch.store(_rarest(texts, crowding, similarity), "entries")
    pairs = scratch.store(_candidates(entries, scratch, similarity), "pairs")
    scratch.drop("entries", "met", "found")

    # A text meets its partners in one group, or in several if these are many.
    blocks = pairs.groupBy("u").agg(F.ceil(F.sum("size") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("v"), "blocks").cast("int")
    dealt = pairs.join(blocks, "u").select(
        "u", "v", F.struct(F.lit(-2).alias("band"), F.col("u").alias("key"), block.alias("low"), block.alias("high")).alias("group")
    )
    ends = dealt.select(F.col("u").alias("cid"), "group").distinct().union(dealt.select("v", "group"))
    wanted = scratch.store(ends.groupBy("cid").agg(F.collect_list("group").alias("groups")), "wanted-pairs")
    return _compared(marked, wanted, text_col, similarity)


def _print_links(prints: DataFrame) -> DataFrame:
    """Links (u, v) of all texts of a bucket of ``prints`` with its first one."""
    first = prints.groupBy("key").agg(F.min("cid").alias("u"))
    return prints.join(first, "key").where("cid <> u").select("u", F.col("cid").alias("v"))


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    by_prints: bool = False,
) -> DataFrame:
    """Add ``component_id``, the smallest identifier of a text's near copies, to all rows.

    Texts link if the Jaccard similarity of their sets of 5-word shingles is
    ``similarity`` or more; components are what is reachable over links.  A text of
    fewer words is one shingle.  Texts with a band of MinHash values in common are
    compared by the exact similarity; the number of bands finds a pair of just that
    similarity with a chance of ``RECALL``, and closer pairs more surely.  So are texts
    whose SimHash fingerprints, those of ``near_duplicates``, are linked at two bits or
    fewer.  Every bucket is compared: a large one in blocks of bounded size, two at a time,
    and buckets of the same members once.

    What these leave apart is then searched exactly, so no link is missed: near copies
    have a shingle in common among their rarest, so many that the similarity allows no
    others to be the first.  Texts of different components that have are counted, bounded
    by size and place, and compared.  ``by_prints`` links texts with linked fingerprints
    whatever their similarity, too.

    Words are split at white space, A-Z lower-cased; texts of the same words are one
    class, and so are all null and blank texts.  Null identifiers never name a
    component unless it has no other, when it is null.  An empty table gives no rows;
    an input column named ``component_id`` is replaced.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "near_copies")
    marked = scratch.store(_marked(docs, text_col, tune_bands(similarity, RECALL, BAND_ROWS)), "marked")
    classes = scratch.store(
        marked.groupBy("h1", "h2")
        .agg(
            F.min("uid").alias("cid"),
            F.min(F.col(f"row.`{id_col}`")).alias("least"),
            F.count(F.lit(1)).alias("copies"),
            F.first("size").alias("size"),
            F.first("bands").alias("bands"),
            F.first("fp").alias("fp"),
        ),
        "classes",
    )
    prints = scratch.store(_close_prints(classes, spark), "prints")
    links = near_links(marked, classes, prints, scratch, text_col, similarity)
    links = scratch.store(links.union(_print_links(prints)) if by_prints else links, "links")
    roots = connected_components(links, scratch)
    missed = scratch.store(missed_links(marked, classes, roots, scratch, text_col, similarity), "missed")
    if not missed.isEmpty():
        roots = connected_components(links.union(missed), scratch, "all")
    rooted = classes.join(roots, classes["cid"] == roots["node"], "left")
    rooted = rooted.select("h1", "h2", "least", "copies", F.coalesce("root", "cid").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("named"))
    # Classes of one row that keep its identifier need no name.
    other = rooted.join(names, "root").where("copies > 1 or not (least <=> named)")
    named = scratch.store(other.select("h1", "h2", "root", "named"), "named")
    scratch.drop("classes", "prints", "shared", "wanted", "links", "known", "pairs", "wanted-pairs", "missed")
    # Rows without a new name are not sent to the join.
    row = marked_keys(marked.select("row", "h1", "h2"), {"h1": "h1", "h2": "h2"}, named)
    joined = row.where("likely").join(named, ["h1", "h2"], "left")
    own = F.col(f"row.`{id_col}`")
    component = F.when(F.col("root").isNull(), own).otherwise(F.col("named"))
    alone = unpacked(row.where("not likely"), docs.columns, own.alias("component_id"))
    return alone.union(unpacked(joined, docs.columns, component.alias("component_id")))
