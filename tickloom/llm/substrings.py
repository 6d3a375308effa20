"""Substring dedup of words by anchors at the positions of a difference cover."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tickloom.llm import bytewords
from tickloom.llm.placing import packed, unpacked
from tickloom.session import staged

WINDOW = 20
PACKET = 1 << 20
PART_BYTES = 8 << 20
BUCKET_PARTS = 4
# For each period positions whose differences are all residues of it.
COVERS = {1: [0], 3: [0, 1], 7: [0, 1, 3], 13: [0, 1, 3, 9], 21: [3, 6, 7, 12, 14], 31: [1, 5, 11, 24, 25, 27]}
WORDS = bytewords.Alphabet(bytewords.BETWEEN_BLANKS.word, fold=False)
SECOND = np.uint64(0xA0761D6478BD642F)
RANGE = StructType([StructField("first", LongType()), StructField("last", LongType())])
OUTPUTS = ["n_words", "n_removed", "ranges", "kept"]

PACKET_SCHEMA = (
    "part int, hashes binary, checks binary, docs binary, starts binary, ids binary, nulls binary, prints binary"
)
DOC_SCHEMA = "id long, print long, places binary"


def period_of(window: int) -> int:
    """The largest period that leaves an anchor about a third of the window."""
    return max(p for p in COVERS if p == 1 or 3 * p <= 2 * window)


@dataclass
class Found:
    """Occurrences: a hash (with more bits of it in ``check``), a document of the
    lists and a place in it."""

    hash: np.ndarray
    check: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    ids: np.ndarray
    nulls: np.ndarray
    prints: np.ndarray

    def doc_ranks(self) -> np.ndarray:
        """Rank of each listed document; those alike in id and print are the same
        document, null ids come last."""
        order = np.lexsort((self.prints, self.ids, self.nulls))
        keys = [a[order] for a in (self.nulls, self.ids, self.prints)]
        steps = np.zeros(len(order), bool)
        for key in keys:
            steps[1:] |= key[1:] != key[:-1]
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.cumsum(steps)
        return rank

    def ranked(self) -> np.ndarray:
        """Rank of document and place in one number."""
        return (self.doc_ranks()[self.doc] << np.uint64(32)) | self.place.astype(np.uint64)

    def only(self, pick: np.ndarray) -> Found:
        return Found(
            self.hash[pick], self.check[pick], self.doc[pick], self.place[pick], self.ids, self.nulls, self.prints
        )

    def classes(self) -> tuple[Found, np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences by hash, then by rank, with their ranks; where the classes of
        equal ones begin, and their sizes."""
        rank = self.ranked()
        order = np.lexsort((rank, self.check, self.hash))
        rows, rank = self.only(order), rank[order]
        begins = np.ones(len(order), bool)
        begins[1:] = (rows.hash[1:] != rows.hash[:-1]) | (rows.check[1:] != rows.check[:-1])
        first = np.flatnonzero(begins)
        return rows, rank, first, np.diff(np.append(first, len(order)))

    def repeated(self, but_first: bool) -> tuple[Found, Found]:
        """The first occurrence of every class, and all members of the classes of
        several; ``but_first`` leaves out those at the first one's place."""
        rows, rank, first, sizes = self.classes()
        several = np.repeat(sizes > 1, sizes)
        if but_first:
            several &= rank != np.repeat(rank[first], sizes)
        return rows.only(first), rows.only(several)

    def by_doc(self) -> pa.RecordBatch:
        """A row for each document with its different places."""
        rank, at = np.unique(self.ranked(), return_index=True)
        own = rank >> np.uint64(32)
        first = np.flatnonzero(np.append(np.ones(min(1, len(own)), bool), own[1:] != own[:-1]))
        docs = self.doc[at[first]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids[docs], pa.int64(), mask=self.nulls[docs].astype(bool)),
                pa.array(self.prints[docs], pa.int64()),
                _pieces(self.place[at].astype(np.uint32), np.append(first, len(own))),
            ],
            names=["id", "print", "places"],
        )

    def by_bucket(self, buckets: int) -> list[tuple[int, Found]]:
        """Occurrences by a remainder of their document's print."""
        bucket = (self.prints % buckets)[self.doc]
        return [(int(k), self.only(bucket == k)) for k in np.unique(bucket)]


def _pieces(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Stretches of an array as binary values."""
    raw, size = values.tobytes(), values.itemsize
    return pa.array([raw[a * size : b * size] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())


@dataclass
class Packet:
    """Occurrences a task has gathered and not yet passed on."""

    held: list[tuple] = field(default_factory=list)
    docs: list[tuple] = field(default_factory=list)
    n_docs: int = 0
    size: int = 0

    def add(self, batch: pa.RecordBatch, row: np.ndarray, place: np.ndarray, hash: np.ndarray, check: np.ndarray):
        if not len(row):
            return
        ids, prints = batch.column("id"), batch.column("print")
        nulls = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.docs.append((ids, nulls, prints.to_numpy(zero_copy_only=False)))
        self.held.append((hash, check, (row + self.n_docs).astype(np.uint32), place.astype(np.uint32)))
        self.n_docs += batch.num_rows
        self.size += len(row)

    def found(self) -> Found:
        parts = [np.concatenate(x) for x in zip(*self.held, strict=True)]
        ids, nulls, prints = (np.concatenate(x) for x in zip(*self.docs, strict=True))
        return Found(*parts, ids, nulls, prints)


def _sent(packet: Packet, parts: int, but_first: bool) -> pa.RecordBatch:
    """The packet's classes, one occurrence of each, by ranges of their hashes. What
    the packet itself can tell goes along under a negative number."""
    firsts, known = packet.found().repeated(but_first)
    part = (((firsts.hash >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
    bounds = np.searchsorted(part, np.arange(parts + 1))
    rows = [(k, firsts.only(slice(bounds[k], bounds[k + 1]))) for k in range(parts) if bounds[k] < bounds[k + 1]]
    if len(known.hash):
        rows.append((-1 - int(known.prints[0] % parts), known))
    return _packed(rows, but_first)


def _packed(rows: list[tuple[int, Found]], checked: bool) -> pa.RecordBatch:
    """Numbered occurrences as rows of arrays; hashes go along for numbers from 0."""
    columns = [[] for _ in range(8)]
    for number, own in rows:
        docs, doc = np.unique(own.doc, return_inverse=True)
        values = [
            own.hash if number >= 0 else own.hash[:0],
            own.check if number >= 0 and checked else own.check[:0],
            doc.astype(np.uint32),
            own.place,
            own.ids[docs],
            own.nulls[docs],
            own.prints[docs],
        ]
        columns[0].append(number)
        for column, value in zip(columns[1:], values, strict=True):
            column.append(np.ascontiguousarray(value).tobytes())
    kinds = [pa.int32()] + [pa.binary()] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["part", "hashes", "checks", "docs", "starts", "ids", "nulls", "prints"],
    )


def _unpacked(group: pa.Table) -> Found:
    columns = [[] for _ in range(7)]
    n_docs = 0
    for row in group.to_pylist():
        doc = np.frombuffer(row["docs"], np.uint32).astype(np.int64) + n_docs
        hashes = np.frombuffer(row["hashes"], np.uint64)
        checks = np.frombuffer(row["checks"], np.uint32)
        ids = np.frombuffer(row["ids"], np.int64)
        n_docs += len(ids)
        values = [
            hashes if len(hashes) else np.zeros(len(doc), np.uint64),
            checks if len(checks) else np.zeros(len(doc), np.uint32),
            doc,
            np.frombuffer(row["starts"], np.uint32),
            ids,
            np.frombuffer(row["nulls"], np.uint8),
            np.frombuffer(row["prints"], np.int64),
        ]
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    return Found(*[np.concatenate(c) for c in columns])


def _sender(occurrences: Callable, parts: int, but_first: bool):
    """Pass on what ``occurrences`` finds in slices of texts, packet by packet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packet = Packet()
        for batch in bytewords.sliced(batches, "body"):
            packet.add(batch, *occurrences(batch))
            if packet.size >= PACKET:
                yield _sent(packet, parts, but_first)
                packet = Packet()
        if packet.size:
            yield _sent(packet, parts, but_first)

    return run


def _merger(parts: int, but_first: bool):
    """Compare the occurrences of one range of hashes, where a class sends one for each
    packet at most, and pass on the repeated ones in buckets of documents."""

    def run(group: pa.Table) -> pa.Table:
        found = _unpacked(group)
        if group.column("part")[0].as_py() >= 0:
            order = np.argsort(found.hash, kind="stable")
            same = found.hash[order][1:] == found.hash[order][:-1]
            twice = np.append(same, False) | np.insert(same, 0, False)
            _, found = found.only(order[twice[: len(order)]]).repeated(but_first)
        rows = [(-1 - bucket, own) for bucket, own in found.by_bucket(max(1, parts // BUCKET_PARTS))]
        return pa.Table.from_batches([_packed(rows, False)])

    return run


def _gather(group: pa.Table) -> pa.Table:
    return pa.Table.from_batches([_unpacked(group).by_doc()])


def _repeats(rows: DataFrame, occurrences: Callable, parts: int, but_first: bool) -> DataFrame:
    """``id``, ``print`` and ``places`` of the documents of ``rows`` that hold any
    repeated occurrence."""
    sent = rows.mapInArrow(_sender(occurrences, parts, but_first), PACKET_SCHEMA)
    found = sent.groupBy("part").applyInArrow(_merger(parts, but_first), PACKET_SCHEMA)
    return staged(found.groupBy("part").applyInArrow(_gather, DOC_SCHEMA))


def _words(batch: pa.RecordBatch) -> tuple[bytewords.Words, np.ndarray, np.ndarray]:
    """Words of the texts, the number of each within its text, and where texts begin
    among them."""
    words = bytewords.words_of(batch.column("body"), WORDS)
    head = np.searchsorted(words.row, np.arange(batch.num_rows + 1))
    return words, np.arange(len(words.row)) - head[words.row], head


def _places(batch: pa.RecordBatch, head: np.ndarray) -> np.ndarray:
    """Numbers of all words that the rows' ``places`` name."""
    out = [np.zeros(0, np.int64)]
    for row, raw in enumerate(batch.column("places").to_pylist()):
        if raw:
            out.append(np.frombuffer(raw, np.uint32).astype(np.int64) + head[row])
    return np.concatenate(out)


def _anchors(window: int, period: int) -> Callable:
    """Windows of the anchor's length at cover positions of every text."""
    covered = np.isin(np.arange(period), COVERS[period])

    def run(batch: pa.RecordBatch):
        words, place, _ = _words(batch)
        first, hashed = bytewords.window_hashes(words, window - period + 1)
        pick = covered[place[first] % period]
        first, hashed = first[pick], hashed[pick]
        return words.row[first], place[first], hashed, np.zeros(len(first), np.uint32)

    return run


def _extended(window: int, period: int) -> Callable:
    """Windows around anchors that occur elsewhere too."""

    def run(batch: pa.RecordBatch):
        words, place, head = _words(batch)
        first, hashed = bytewords.window_hashes(words, window)
        _, second = bytewords.window_hashes(words._replace(hash=bytewords.scrambled(words.hash ^ SECOND)), window)
        marks = np.zeros(len(words.row) + period + 1, np.int64)
        marks[_places(batch, head) + 1] = 1
        upto = np.cumsum(marks)
        pick = upto[first + period] > upto[first]
        first = first[pick]
        return words.row[first], place[first], hashed[pick], (second[pick] >> np.uint64(32)).astype(np.uint32)

    return run


def remove(
    docs: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    id: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """Remove every word that lies in a window of ``window`` words whose sequence
    also starts earlier: in a document with a smaller id, or before it in the same.

    Words are runs between blanks, unchanged. Anchors, windows shorter than
    ``window`` by a period less one, are hashed only at positions of a difference
    cover of the period. Two equal windows, wherever they start, have an anchor each
    at the same offset that both lie on the cover, so a window without an anchor that
    occurs twice is unique. Windows around such anchors are then hashed whole (96
    bits) and compared. Tasks send one occurrence of each hash in a packet, by ranges
    of hashes whose number follows the size of the texts, so no task gathers a
    frequent passage, and what packets can tell themselves they do.

    Null and empty texts have no words and ``kept`` is empty; texts of fewer words
    than ``window`` lose none. Null ids come after all others. Rows alike in id and
    text count as one document and get the same result; of different texts with one
    id that with the smaller hash is the earlier. Extra columns stay, one named like
    an output is replaced; an empty table gives no rows. A text may hold up to 2^32
    words.

    Returns the kept columns and ``n_words``, ``n_removed``, ``ranges`` (first and last
    removed word, from 0) and ``kept``, the words left, one blank between."""
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        packed(docs, keep).alias("row"),
        F.col(f"`{id}`").cast("long").alias("id"),
        F.xxhash64(body).alias("print"),
        body.alias("body"),
    )
    period = period_of(window)
    filled = rows.filter(F.length("body") > 0).select("id", "print", "body")
    size = filled.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    anchored = _repeats(filled, _anchors(window, period), parts, False)
    around = _joined(filled, anchored, "inner").select("id", "print", "body", "places")
    doomed = _repeats(around, _extended(window, period), parts, True)
    schema = StructType([rows.schema["row"], StructField("n_words", LongType()), StructField("n_removed", LongType())])
    schema = schema.add(StructField("ranges", ArrayType(RANGE))).add(StructField("kept", StringType()))
    cut = _joined(rows, doomed, "left").select("row", "body", "places").mapInArrow(_cutter(window, schema), schema)
    return unpacked(cut, "row", OUTPUTS)


def _joined(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    named = found.select(F.col("id").alias("_id"), F.col("print").alias("_print"), "places")
    return rows.join(named, F.col("id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")), how)


def _cutter(window: int, schema: StructType):
    from pyspark.sql.pandas.types import to_arrow_type

    ranges_type = to_arrow_type(schema["ranges"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytewords.sliced(batches, "body"):
            words, place, head = _words(batch)
            starts = _places(batch, head)
            steps = np.zeros(len(words.row) + window + 1, np.int64)
            np.add.at(steps, starts, 1)
            np.add.at(steps, starts + window, -1)
            gone = np.cumsum(steps)[: len(words.row)] > 0
            removed = np.bincount(words.row[gone], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(np.diff(head), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(_ranges(words.row, place, gone, batch.num_rows), ranges_type),
                    _texts(batch.column("body"), words, ~gone),
                ],
                names=schema.names,
            )

    return run


def _ranges(row: np.ndarray, place: np.ndarray, gone: np.ndarray, rows: int) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(rows)]
    at = np.flatnonzero(gone)
    if len(at):
        breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(row[at]) > 0))
        for a, b in zip(at[np.append(0, breaks + 1)], at[np.append(breaks, len(at) - 1)], strict=True):
            out[row[a]].append({"first": int(place[a]), "last": int(place[b])})
    return out


def _texts(bodies: pa.Array, words: bytewords.Words, kept: np.ndarray) -> pa.Array:
    """The kept words of every text, one blank before each but the first."""
    data, bounds = bytewords.text_buffers(bodies)
    row, start, end = words.row[kept], words.start[kept], words.end[kept]
    follows = np.zeros(len(row), bool)
    follows[1:] = row[1:] == row[:-1]
    steps = np.zeros(len(data) + 1, np.int32)
    steps[start - follows] += 1
    np.subtract.at(steps, end, 1)
    inside = np.cumsum(steps)[: len(data)] > 0
    out = np.where(inside, data, np.uint8(0))
    out[start[follows] - 1] = 32
    sizes = np.concatenate(([0], np.cumsum(inside)))[bounds]
    return pa.Array.from_buffers(
        pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(out[inside])]
    ).cast(pa.string())
