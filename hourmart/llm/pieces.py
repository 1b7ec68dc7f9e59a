"""SentencePiece encoding by a max-plus scan, and decoding."""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, map_arrow, packed, tuned, unpacked, with_texts

#: Characters of a chunk; longer texts are encoded by a scan over their chunks.
CHUNK_CHARS = 32_768
#: Chunks whose transfer matrices are multiplied in one group.
GROUP_CHUNKS = 256
#: Weights are whole multiples of this, so sums do not depend on their order.
SCALE = 1 << 16
#: Further penalty of a byte that no piece covers, as the public library has it.
BYTE_PENALTY = 10.0
NO_PATH = -(1 << 60)
#: Words whose pieces a task remembers: the last used ones, up to twice as many.
CACHE_WORDS = 120_000
#: The public format's sign for a space.
SPACE_SIGN = "▁"

#: Longest word of the array path, and words and characters that it handles at once.
WORD_CHARS, WORDS_AT_ONCE, TEXT_CHARS = 64, 8_000, 1 << 18

_BASE, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)
_BREAKS = "\n\t\r"


@dataclass
class Pieces:
    """A vocabulary: pieces with weights, and bytes for what they do not cover."""

    weights: dict[str, tuple[int, int]]
    byte_ids: list[int]
    byte_weight: int
    surfaces: list[bytes]
    longest: int = 1
    table: dict[str, int | None] = field(default_factory=dict)
    unit: str = ""
    cache: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)
    id_weights: dict[int, int] = field(default_factory=dict)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    key_weights: np.ndarray | None = None
    key_ids: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.weights), default=1)
        # Weights of pieces; None for what only begins pieces.
        self.table = {p[:n]: None for p in self.weights for n in range(1, len(p))}
        self.table.update((p, w) for p, (_, w) in self.weights.items())
        # No piece runs on from a letter to a space or holds a break: the best path passes there.
        whole = all(re.fullmatch(r" *[^ ]*", p) for p in self.weights)
        breaks = "".join(b for b in _BREAKS if not any(b in p and len(p) > 1 for p in self.weights))
        self.unit = rf" *[^ {breaks}]+| +|[{breaks}]" if breaks else r" *[^ ]+| +"
        if not whole:
            self.unit = r"(?s).+"

    # Best paths

    def scores(self, text: str, starts: dict[int, int], stop: int) -> tuple[list[int], list[int]]:
        """Best sums and predecessors of every position, for pieces that start before ``stop``.

        ``starts`` has the sums to begin with.  Of equal sums the longest last piece
        wins.  A character that is no piece counts as its bytes.
        """
        table, size, absent = self.table, len(text), NO_PATH
        best, back = [NO_PATH] * (size + 1), [-1] * (size + 1)
        for i, score in starts.items():
            best[i] = score
        for i in range(stop):
            score = best[i]
            if score == NO_PATH:
                continue
            j = i + 1
            weight = table.get(text[i:j], absent)
            if weight is None or weight == absent:
                alone = score + self.byte_weight * len(text[i].encode())
                if alone > best[j]:
                    best[j], back[j] = alone, i
            while weight != absent:
                if weight is not None and score + weight > best[j]:
                    best[j], back[j] = score + weight, i
                if j == size:
                    break
                j += 1
                weight = table.get(text[i:j], absent)
        return best, back

    def ids_of(self, text: str, back: list[int], start: int, end: int) -> list[int]:
        out: list[int] = []
        while end > start:
            begin = back[end]
            piece = text[begin:end]
            known = self.weights.get(piece)
            if known is not None:
                out.append(known[0])
            else:
                out.extend(self.byte_ids[b] for b in reversed(piece.encode()))
            end = begin
        out.reverse()
        return out

    def slow_word(self, unit: str) -> bytes:
        """Ids, as 32-bit numbers, of a unit that no piece crosses."""
        _, back = self.scores(unit, {0: 0}, len(unit))
        return array("i", self.ids_of(unit, back, 0, len(unit))).tobytes()

    def words(self, units: list[str]) -> list[bytes]:
        """Ids of many short units, their best paths found side by side in arrays.

        All starts of pieces are followed one character at a time through the hashes of
        the beginnings of pieces; then positions are relaxed in order, all units at once.
        """
        if not len(self.keys):
            self.hash_pieces()
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64)
        unit = np.repeat(np.arange(len(units)), lengths)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(codes)) - first[unit]
        left = lengths[unit] - place
        # Edges (start, length, weight, id) of the units' paths.
        at, hashes, parts = np.arange(len(codes)), np.zeros(len(codes), np.uint64), []
        alone = np.ones(len(codes), bool)
        for n in range(1, self.longest + 1):
            hashes = hashes * _BASE + codes[at + n - 1] + _ODD
            found = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            known = self.keys[found] == hashes
            whole = known & (self.key_ids[found] >= 0)
            parts.append((at[whole], np.full(whole.sum(), n), self.key_weights[found[whole]], self.key_ids[found[whole]]))
            if n == 1:
                alone[at[whole]] = False
            on = known & (left[at] > n)
            at, hashes = at[on], hashes[on]
        start, size, weight, piece = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((size, place[start]))
        start, size, weight, piece = start[order], size[order], weight[order], piece[order]
        source, node = start + unit[start], first + np.arange(len(units))
        best = np.full(len(codes) + len(units), NO_PATH, np.int64)
        best[node] = 0
        back, ids = np.zeros(len(best), np.int64), np.zeros(len(best), np.int32)
        turn = place[start] * (self.longest + 1) + size
        bounds = np.append(np.flatnonzero(np.diff(turn, prepend=-1)), len(turn))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            reached = best[source[a:b]] + weight[a:b]
            target = source[a:b] + size[a]
            better = reached > best[target]
            target = target[better]
            best[target], back[target], ids[target] = reached[better], size[a], piece[a:b][better]
        # Back from every end at once.
        current, steps = node + lengths, []
        going = np.arange(len(units))
        while len(going):
            steps.append((going, ids[current[going]]))
            current[going] -= np.maximum(back[current[going]], 1)
            going = going[current[going] > node[going]]
        counts = np.bincount(np.concatenate([g for g, _ in steps]), minlength=len(units))
        ends = np.cumsum(counts)
        flat = np.zeros(int(ends[-1]), np.int32)
        for k, (going, found) in enumerate(steps):
            flat[ends[going] - 1 - k] = found
        data, stops = flat.tobytes(), (4 * ends).tolist()
        out = [data[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        for k in np.unique(unit[alone]).tolist():
            out[k] = self.slow_word(units[k])
        return out

    def hash_pieces(self) -> None:
        """Sorted hashes of all beginnings of pieces, with the weights and ids of pieces."""
        hashes, weights, ids = [], [], []
        for text, weight in self.table.items():
            value = 0
            for c in text:
                value = (value * int(_BASE) + ord(c) + int(_ODD)) % (1 << 64)
            hashes.append(value)
            weights.append(weight or 0)
            ids.append(-1 if weight is None else self.weights[text][0])
        order = np.argsort(np.array(hashes, np.uint64))
        self.keys = np.array(hashes, np.uint64)[order]
        if (np.diff(self.keys) == 0).any():
            raise ValueError("two beginnings of pieces have one hash")
        self.key_weights, self.key_ids = np.array(weights, np.int64)[order], np.array(ids, np.int32)[order]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts that begin with the added space."""
        parts = [re.findall(self.unit, t) for t in texts]
        known = self.cache
        missing = set().union(*parts).difference(known)
        known.update((u, self.older[u]) for u in missing.intersection(self.older))
        missing = list(missing.difference(known))
        short = [u for u in missing if len(u) <= WORD_CHARS]
        for a in range(0, len(short), WORDS_AT_ONCE):
            some = short[a : a + WORDS_AT_ONCE]
            known.update(zip(some, self.words(some), strict=True))
        long = {u: self.slow_word(u) for u in missing if len(u) > WORD_CHARS}
        known.update(long)
        out = [b"".join(map(known.__getitem__, units)) for units in parts]
        for u in long:
            del known[u]
        if len(known) > CACHE_WORDS:
            self.older, self.cache = known, {}
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def score(self, ids: bytes) -> int:
        """The sum of the pieces' weights."""
        if not self.id_weights:
            self.id_weights.update((i, w) for i, w in self.weights.values())
            self.id_weights.update((i, self.byte_weight) for i in self.byte_ids)
        return sum(map(self.id_weights.__getitem__, np.frombuffer(ids, np.int32).tolist()))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surfaces.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    # Chunks.  State s at a chunk's border: the piece over the border ends s characters behind it.

    def cuts(self, chunk: str) -> tuple[int, int] | None:
        """First and last position inside a chunk that no piece crosses."""
        ends = [m.end() for m in re.finditer(self.unit, chunk)][:-1]
        return (ends[0], ends[-1]) if ends else None

    def transfer(self, chunk: str, ahead: str) -> np.ndarray:
        """Best sums from each state at the chunk's start to each at its end."""
        size, n, text = self.longest, len(chunk), chunk + ahead
        out = np.full((size, size), NO_PATH, np.int64)
        cut = self.cuts(chunk)
        if cut:
            first, last = cut
            head = np.full(size, NO_PATH, np.int64)
            for s in range(min(size, first + 1)):
                head[s] = self.scores(chunk[:first], {s: 0}, first)[0][first]
            tail = self.scores(text[last:], {0: 0}, n - last)[0][n - last :]
            ends = np.full(size, NO_PATH, np.int64)
            ends[: min(size, len(tail))] = tail[:size]
            middle = self.score(self.encode(chunk[first:last]))
            both = (head[:, None] > NO_PATH) & (ends[None, :] > NO_PATH)
            return np.where(both, head[:, None] + middle + ends[None, :], NO_PATH)
        for s in range(size):
            if s > n:
                out[s, s - n] = 0
                continue
            ends = self.scores(text, {s: 0}, n)[0][n:]
            out[s, : min(size, len(ends))] = ends[:size]
        return out

    def chunk_ids(self, chunk: str, ahead: str, entry: int, leave: int) -> bytes:
        """Ids of the pieces that start in a chunk, between two states."""
        n, text = len(chunk), chunk + ahead
        if entry > n:
            return b""
        cut = self.cuts(chunk)
        if not cut:
            _, back = self.scores(text, {entry: 0}, n)
            return np.array(self.ids_of(text, back, entry, n + leave), np.int32).tobytes()
        first, last = cut
        _, back = self.scores(chunk[:first], {entry: 0}, first)
        head = self.ids_of(chunk, back, entry, first)
        rest = text[last:]
        _, back = self.scores(rest, {0: 0}, n - last)
        tail = self.ids_of(rest, back, 0, n - last + leave)
        middle = self.encode(chunk[first:last])
        return np.array(head, np.int32).tobytes() + middle + np.array(tail, np.int32).tobytes()


def load_pieces(model_file: str, by_rank: bool = True) -> Pieces:
    """Read a public SentencePiece file.

    Files of the unigram kind hold log-probabilities; use them with ``by_rank=False``.
    Files of the merge kind hold only an order.  With ``by_rank`` a piece weighs as a
    word of its rank does under Zipf's law, ``-log(rank + 2)``.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    plain = [
        i
        for i in range(size)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
    ]
    score = {i: model.get_score(i) for i in plain}
    order = sorted(plain, key=lambda i: (-score[i], i))
    if by_rank:
        score = {i: -math.log(rank + 2) for rank, i in enumerate(order)}
    surfaces, weights, byte_ids = [b""] * size, {}, [-1] * 256
    for i in plain:
        surface = model.id_to_piece(i).replace(SPACE_SIGN, " ")
        surfaces[i] = surface.encode()
        weights[surface] = (i, round(score[i] * SCALE))
    for i in filter(model.is_byte, range(size)):
        value = int(model.id_to_piece(i)[3:-1], 16)
        byte_ids[value], surfaces[i] = i, bytes([value])
    if -1 in byte_ids:
        raise ValueError("a vocabulary with all byte pieces is needed for exact round trips")
    least = min(score.values(), default=0.0)
    return Pieces(weights, byte_ids, round((least - BYTE_PENALTY) * SCALE), surfaces)


def _shared(spark, pieces: Pieces):  # noqa: ANN001, ANN202
    plain = (pieces.weights, pieces.byte_ids, pieces.byte_weight, pieces.surfaces)
    return spark.sparkContext.broadcast(plain)


def _id_lists(found: list[bytes | None]) -> pa.ListArray:
    sizes = [0 if b is None else len(b) // 4 for b in found]
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    values = np.frombuffer(b"".join(b or b"" for b in found), np.int32)
    missing = pa.array([b is None for b in found], pa.bool_())
    return pa.ListArray.from_arrays(offsets, pa.array(values), mask=missing)


# The scan


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product; it is associative."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NO_PATH)


def _forward(start: np.ndarray, steps: list[np.ndarray]) -> list[np.ndarray]:
    """Best sums of each state before every step."""
    out = [start]
    for step in steps:
        out.append(np.maximum((out[-1][:, None] + step).max(axis=0), NO_PATH))
    return out


def _backward(before: list[np.ndarray], steps: list[np.ndarray], end: int) -> list[int]:
    """The state at every border on a best path that ends in ``end``; ties to the smaller."""
    states = [end]
    for sums, step in zip(reversed(before[:-1]), reversed(steps), strict=True):
        states.append(int(np.argmax(sums + step[:, states[-1]])))
    return states[::-1]


def _matrices(column: pa.Array, size: int) -> list[np.ndarray]:
    return [np.array(m, np.int64).reshape(size, size) for m in column.to_pylist()]


def _scan(matrices: DataFrame, size: int) -> DataFrame:
    """(uid, chunk, entry, leave) from (uid, chunk, matrix) in three steps.

    Matrices are multiplied in groups of chunks; a pass over a text's group products
    gives the state at every group border; each group then finds its own states.
    """

    def only(state: int) -> np.ndarray:
        return np.where(np.arange(size) == state, 0, NO_PATH)

    def product(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        steps = _matrices(table["matrix"], size)
        total = steps[0]
        for step in steps[1:]:
            total = _times(total, step)
        return pa.table(
            {"uid": table["uid"][:1], "part": table["part"][:1], "matrix": [total.ravel().tolist()]}
        )

    def borders(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        steps = _matrices(table["matrix"], size)
        states = _backward(_forward(only(0), steps), steps, 0)
        return pa.table(
            {
                "uid": table["uid"],
                "part": table["part"],
                "first": pa.array(states[:-1], pa.int32()),
                "last": pa.array(states[1:], pa.int32()),
            }
        )

    def inner(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        steps = _matrices(table["matrix"], size)
        first, last = (table[c][0].as_py() for c in ("first", "last"))
        states = _backward(_forward(only(first), steps), steps, last)
        return pa.table(
            {
                "uid": table["uid"],
                "chunk": table["chunk"],
                "entry": pa.array(states[:-1], pa.int32()),
                "leave": pa.array(states[1:], pa.int32()),
            }
        )

    parts = matrices.withColumn("part", (F.col("chunk") / GROUP_CHUNKS).cast("int"))
    products = parts.groupBy("uid", "part").applyInArrow(product, "uid long, part int, matrix array<long>")
    ends = products.groupBy("uid").applyInArrow(borders, "uid long, part int, first int, last int")
    return (
        parts.join(ends, ["uid", "part"])
        .groupBy("uid", "part")
        .applyInArrow(inner, "uid long, chunk int, entry int, leave int")
    )


def encode(
    docs: DataFrame,
    pieces: Pieces,
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``ids`` to all rows of ``docs``: the pieces of the best path over each whole text.

    The result has the columns ``keep`` of ``docs`` (default: all).

    The best path has the greatest sum of piece weights, as in the format's unigram
    kind.  A space is put before the text; characters that no piece covers become
    byte pieces, so decoding gives back every text exactly.

    Texts of up to ``chunk_chars`` are encoded in one go.  Longer ones are split into
    chunks in different tasks: each yields a matrix of best sums between the states
    at its borders (how far a piece reaches over), matrices are combined
    associatively, and with the states on the best path known, each chunk finds its
    pieces on its own.  Splitting never changes a text's score.

    A null text has null ids, an empty one none.  Repeated rows get equal results; an
    empty table gives no rows; an input column ``ids`` is replaced.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "pieces")
    shared, size = _shared(spark, pieces), pieces.longest
    if chunk_chars < size:
        raise ValueError("a chunk must hold the longest piece")
    rows, texts_in, names = with_texts(docs, text_col, keep)
    text = F.col(f"row.`{text_col}`" if text_col in names else "text")
    row_type = rows.schema["row"].dataType.simpleString()
    length = F.coalesce(F.length(text), F.lit(0))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces(*shared.value)
        for batch in batches:
            texts, start = texts_in(batch), 0
            while start < len(texts):
                end, held = start, 0
                while end < len(texts) and held < TEXT_CHARS:
                    held, end = held + len(texts[end] or ""), end + 1
                some = texts[start:end]
                coded = iter(own.encode_all([" " + t for t in some if t]))
                found = [None if t is None else next(coded) if t else b"" for t in some]
                rows_of = batch.column("row").slice(start, end - start)
                yield pa.RecordBatch.from_arrays([rows_of, _id_lists(found)], ["row", "ids"])
                start = end

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                text = " " + text
                for chunk, at in enumerate(range(0, len(text), chunk_chars)):
                    end = at + chunk_chars
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("uid").slice(k, 1),
                            pa.array([chunk], pa.int32()),
                            pa.array([text[at:end]], pa.string()),
                            pa.array([text[end : end + size - 1]], pa.string()),
                        ],
                        ["uid", "chunk", "piece", "ahead"],
                    )

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces(*shared.value)
        for batch in batches:
            found = [
                own.transfer(*x).ravel().tolist()
                for x in zip(batch.column("piece").to_pylist(), batch.column("ahead").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("chunk"), pa.array(found, pa.list_(pa.int64()))],
                ["uid", "chunk", "matrix"],
            )

    def backtrace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces(*shared.value)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("piece", "ahead", "entry", "leave")]
            found = [own.chunk_ids(*x) for x in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("chunk"), _id_lists(found)], ["uid", "chunk", "ids"]
            )

    schema = f"row {row_type}, ids array<int>"
    short = map_arrow(rows.where(length <= chunk_chars), whole, schema)

    # Identifiers of long texts are fixed by storing the rows that carry them.
    long_rows = scratch.store(
        rows.where(length > chunk_chars).withColumn("uid", F.monotonically_increasing_id()), "long"
    )
    texts = long_rows.select("uid", text.alias("text"))
    chunks = scratch.store(
        map_arrow(texts, split, "uid long, chunk int, piece string, ahead string").repartition(
            "uid", "chunk"
        ),
        "chunks",
    )
    matrices = scratch.store(map_arrow(chunks, transfer, "uid long, chunk int, matrix array<long>"), "matrices")
    states = _scan(matrices, size)
    found = map_arrow(
        chunks.join(states, ["uid", "chunk"]), backtrace, "uid long, chunk int, ids array<int>"
    )
    joined = found.groupBy("uid").agg(
        F.flatten(
            F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])
        ).alias("ids")
    )
    pieced = long_rows.join(joined, "uid").select("row", "ids")
    return unpacked(short.union(pieced), names, "ids")


def _joined(ids: pa.ListArray, surfaces: pa.BinaryArray) -> pa.StringArray:
    """The texts of lists of ids: their surfaces taken and joined as whole arrays."""
    start, end = ids.offsets[0].as_py(), ids.offsets[-1].as_py()
    taken = surfaces.take(ids.values.slice(start, end - start))
    offsets = pc.subtract(ids.offsets, pa.scalar(start, pa.int32()))
    lists = pa.ListArray.from_arrays(offsets, taken, mask=ids.is_null())
    texts = pc.binary_join(lists, b"")
    spaced = pa.array([t is not None and t[:1] == b" " for t in texts.to_pylist()])
    texts = pc.if_else(spaced, pc.binary_replace_slice(texts, 0, 1, b""), texts)
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:  # ids that some other program chose
        return pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


def decode(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of the ids in ``ids_col`` as ``into``; null ids give null.

    Tasks get the pieces' surfaces alone, and no id becomes an object of its own.
    """
    spark = tuned(encoded.sparkSession)
    shared = spark.sparkContext.broadcast(pieces.surfaces)
    rows = packed(encoded)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, `{into}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces = pa.array(shared.value, pa.binary())
        for batch in batches:
            texts = _joined(batch.column("row").field(ids_col), surfaces)
            yield pa.RecordBatch.from_arrays([batch.column("row"), texts], ["row", into])

    return unpacked(map_arrow(rows, run, schema), encoded.columns, F.col(f"`{into}`"))
