"""Token ids of whole texts in checksummed, range-coded files."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickloom.llm import bytewords, rangecoder

END = 0
BLOCK_IDS = 4096
GROUP_BLOCKS = 1024
SLICE_BYTES = 1 << 21
CACHE_BYTES, PIECE_BYTES = 3 << 25, 130
VOCABULARY = 50_257
MAGIC = b"TLI2"
HEADER = struct.Struct("<4sIII")
FILE = "part long, block long, data binary"
READ = "doc_id long, part long, place long, before long, n_tokens long, ids_crc32 long"


# --- text to ids -------------------------------------------------------------------

# kinds of bytes: ASCII letters, others that are no white space, marks that end words
LETTER, SOLID, MARK = 1, 2, 4
KINDS = np.zeros(256, np.uint8)
KINDS[33:127] = SOLID
KINDS[[*range(65, 91), *range(97, 123)]] = SOLID | LETTER
KINDS[list(b"\n0123456789!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] |= MARK  # not ' nor what special ids have
BLANK, NEWLINE = 32, 10

# a blank at most and Latin letters: one word of pre-tokenizing, whatever its parts
WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")


@cache
def symbols() -> list[str]:
    """What byte-level pre-tokenizing writes for each byte: itself where that is a visible
    character of Latin-1, else one of the characters from U+0100 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(byte if byte in seen else next(hidden)) for byte in range(256)]


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places within texts, which start at ``starts``, where byte-level pre-tokenizing
    always breaks: before a blank that follows no white space, between a letter of ASCII or
    up to U+00FF and a mark, and between a single line feed and an ASCII letter."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    kind = KINDS.take(data)
    cut = np.zeros(len(data) + 2, bool)
    blank = data == BLANK
    cut[1 : len(data)] = (blank[1:] & (kind[:-1] >= SOLID)) | (((kind[1:] & MARK) != 0) & ((kind[:-1] & LETTER) != 0))
    line = (data[1:-1] == NEWLINE).nonzero()[0] + 2
    line = line[((kind[line] & LETTER) != 0) & ((kind[line - 2] & SOLID) != 0)]
    line = line[~np.isin(line - 1, starts)]
    cut[line] = True
    wide = ((blank[1:] | ((kind[1:] & MARK) != 0)) & (data[:-1] >= 0x80)).nonzero()[0] + 1
    cut[wide[np.where(blank[wide], ~_wide_space(data, wide), _wide_letter(data, wide))]] = True
    cut[starts] = False
    return cut[: len(data)].nonzero()[0]


def _wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character that is not ASCII and ends before ``at`` may be white space:
    U+0085 and U+00A0, or one of the blocks that hold U+1680, U+2000 to U+205F, U+3000."""
    second = data[np.maximum(at - 2, 0)]
    third = data[np.maximum(at - 3, 0)].astype(np.uint16) << 8 | second
    return (second == 0xC2) | np.isin(third, (0xE19A, 0xE280, 0xE281, 0xE380))


def _wide_letter(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether one of U+00C0 to U+00FF, but for the signs U+00D7 and U+00F7, ends before ``at``."""
    last = data[at - 1]
    return (data[np.maximum(at - 2, 0)] == 0xC3) & (last != 0x97) & (last != 0xB7)


@cache
def divisible(path: str) -> bool:
    """Whether texts may be cut: nothing is normalized, and no added id can be cut, be part
    of a word or look beyond its own characters."""
    whole = tokenizer(path)
    for added in whole.get_added_tokens_decoder().values():
        data = np.frombuffer(added.content.encode(), np.uint8)
        if added.rstrip or added.single_word or WORD.fullmatch(added.content) or len(cuts(data, np.zeros(1, int))):
            return False
    return whole.normalizer is None


class Pieces:
    """Ids by piece of text. Texts are cut where pre-tokenizing breaks anyway, and every
    piece is encoded by itself; pieces repeat, texts do not. The piece of no bytes stands
    for the end of a text. When what is known takes more than ``CACHE_BYTES``, pieces met
    only once since the last time are forgotten, or all if that does not free half."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.forget()

    def forget(self) -> None:
        self.known = {b"": 0}
        self.ids = np.full(1 << 12, END, np.uint32)
        self.bounds = np.ones(1 << 10, np.int64)
        self.bounds[0] = 0
        self.met = np.zeros(1 << 10, np.int32)
        self.bytes = 0

    def thin(self) -> None:
        keep = self.met[: len(self.known)] > 1
        keep[0] = True
        sizes = np.diff(self.bounds[: len(keep) + 1])
        self.ids = self.ids[: self.bounds[len(keep)]][np.repeat(keep, sizes)]
        self.bounds = np.concatenate([[0], np.cumsum(sizes[keep])])
        self.known = {piece: k for k, piece in enumerate(compress(self.known, keep))}
        self.met = np.ones(len(self.known), np.int32)
        self.bytes = sum(map(len, self.known)) + PIECE_BYTES * len(self.known) + self.ids.nbytes
        if self.bytes > CACHE_BYTES // 2:
            self.forget()

    def stream(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), the end id after each, and how many each has."""
        texts = texts.fill_null("").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        ends = offsets[1:] - offsets[0]
        starts = offsets[:-1] - offsets[0]
        filled = ends > starts
        inner = cuts(data, starts[filled]) if divisible(self.path) else []
        bounds = np.concatenate([[0], inner, ends, ends[filled]])
        bounds = np.sort(bounds.astype(np.int64), kind="stable")
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        ).dictionary_encode()
        which = self.numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
        first = self.bounds[which]
        sizes = self.bounds[which + 1] - first
        after = np.cumsum(sizes)
        ids = self.ids[np.repeat(first - after + sizes, sizes) + np.arange(sizes.sum())]
        return ids, np.diff(after[which == 0], prepend=0)

    def numbers(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of different pieces, encoding those that are not known."""
        if self.bytes > CACHE_BYTES:
            self.thin()
        found = list(map(self.known.get, pieces))
        new = [k for k, number in enumerate(found) if number is None]
        if new:
            found = np.array([-1 if number is None else number for number in found])
            found[new] = self.add([pieces[k] for k in new])
        self.met = _room(self.met, len(self.known))
        numbers = np.asarray(found, np.int64)
        self.met[numbers] += 1
        return numbers

    def add(self, pieces: list[bytes]) -> range:
        ids = _encoded(self.path, pieces)
        sizes = np.array([len(i) for i in ids])
        at = range(len(self.known), len(self.known) + len(pieces))
        ends = self.bounds[at.start] + np.cumsum(sizes)
        self.bounds = _room(self.bounds, at.stop + 1)
        self.bounds[at.start + 1 : at.stop + 1] = ends
        self.ids = _room(self.ids, int(ends[-1]))
        self.ids[self.bounds[at.start] : ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        self.known.update(zip(pieces, at, strict=True))
        self.bytes += sum(map(len, pieces)) + PIECE_BYTES * len(pieces) + 4 * int(sizes.sum())
        return at

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers, the end id last."""
        ids, sizes = self.stream(pa.array(texts, pa.large_string()))
        return [part.astype("<u4").tobytes() for part in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def _encoded(path: str, pieces: list[bytes]) -> list[list[int]]:
    """Ids of pieces. A word goes to the model of the tokenizer in the symbols that
    pre-tokenizing would write for it, anything else through the whole tokenizer."""
    whole = tokenizer(path)
    texts, plain = [p.decode() for p in pieces], divisible(path)
    words = [WORD.fullmatch(t) is not None and plain for t in texts]
    rest = iter(whole.encode_batch_fast([t for t, w in zip(texts, words, strict=True) if not w], add_special_tokens=False))
    model, written = whole.model, symbols()
    return [
        [token.id for token in model.tokenize("".join([written[byte] for byte in p]))] if word else next(rest).ids
        for p, word in zip(pieces, words, strict=True)
    ]


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The values with room for as many."""
    if size <= len(values):
        return values
    return np.concatenate([values, np.zeros(max(size, len(values) * 3 // 2) - len(values), values.dtype)])


@cache
def pieces_of(path: str) -> Pieces:
    """A worker keeps what it knows from task to task."""
    return Pieces(path)


# --- blocks ------------------------------------------------------------------------


def sealed_blocks(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """A header (mark, number of ids, bytes, checksum of the coded bytes) and the
    coded ids of each block."""
    coded = rangecoder.encode(blocks, vocabulary)
    return [HEADER.pack(MAGIC, len(b), len(c), zlib.crc32(c)) + c for b, c in zip(blocks, coded, strict=True)]


def opened_blocks(blobs: list[bytes], vocabulary: int) -> list[np.ndarray]:
    """Ids of sealed blocks; a block that is not whole is an error."""
    sizes, coded = [], []
    for blob in blobs:
        mark, number, length, checksum = HEADER.unpack_from(blob)
        body = blob[HEADER.size :]
        if mark != MAGIC or len(body) != length or zlib.crc32(body) != checksum:
            raise ValueError("damaged block of token ids")
        sizes.append(number)
        coded.append(body)
    return rangecoder.decode(coded, sizes, vocabulary)


def _writer(path: str, vocabulary: int, block_ids: int):
    """Blocks of the ids of a task's documents, in their order. Block -1 lists the
    documents: place, id and number of ids."""

    def flush(part: int, at: int, blocks: list[np.ndarray]) -> pa.RecordBatch:
        data = sealed_blocks(blocks, vocabulary)
        return _file_rows(part, range(at, at + len(blocks)), data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        pieces, held, size, at, place = pieces_of(path), [], 0, 0, 0
        for batch in bytewords.sliced(batches, "body", SLICE_BYTES):
            ids, lengths = pieces.stream(batch.column("body"))
            yield _file_rows(part, [-1 - place], [_listing(place, batch.column("doc_id"), lengths)])
            place += len(lengths)
            held.append(ids)
            size += len(ids)
            if size >= block_ids * GROUP_BLOCKS:
                stream = np.concatenate(held)
                whole = size // block_ids
                yield flush(part, at, [stream[k * block_ids : (k + 1) * block_ids] for k in range(whole)])
                held, at = [stream[whole * block_ids :]], at + whole
                size -= whole * block_ids
        if size:
            stream = np.concatenate(held)
            yield flush(part, at, [stream[k : k + block_ids] for k in range(0, size, block_ids)])

    return run


def _file_rows(part: int, blocks, data: list[bytes]) -> pa.RecordBatch:
    parts = np.full(len(data), part)
    return pa.RecordBatch.from_arrays(
        [pa.array(parts), pa.array(list(blocks), pa.int64()), pa.array(data, pa.binary())],
        names=["part", "block", "data"],
    )


def _listing(place: int, doc_ids: pa.Array, sizes: np.ndarray) -> bytes:
    """Documents of a slice as bytes: number, lengths, ids and which ids are null."""
    lengths = sizes.astype("<u4")
    values = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
    nulls = doc_ids.is_null().to_numpy(zero_copy_only=False)
    body = lengths.tobytes() + values.tobytes() + nulls.tobytes()
    return HEADER.pack(MAGIC, len(sizes), place, zlib.crc32(body)) + body


def _listed(blob: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    mark, n, place, checksum = HEADER.unpack_from(blob)
    body = blob[HEADER.size :]
    if mark != MAGIC or zlib.crc32(body) != checksum:
        raise ValueError("damaged list of documents")
    cuts = 4 * n, 12 * n
    nulls = np.frombuffer(body[cuts[1] :], bool)
    return place, np.frombuffer(body[: cuts[0]], "<u4"), np.frombuffer(body[cuts[0] : cuts[1]], "<i8"), nulls


def write(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    text: str = "text",
    id: str = "doc_id",
    vocabulary: int = VOCABULARY,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the token ids of all texts, each followed by the end id 0, in ascending
    order of the document ids.

    Documents are range-partitioned and sorted by id (null first, ties by text), so
    part after part and block after block is the whole sequence. A part is cut into
    blocks of ``block_ids`` ids wherever that falls. Every block is coded by a range
    coder whose predictions start anew and carries a checksum, so it can be decoded
    alone. The blocks are rows of Parquet files: a lost task is simply repeated.

    Null and empty texts have the end id only. Repeated rows are written as often as
    they occur; an empty table writes no blocks."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("body"))
    tied = rows.withColumn("tie", F.xxhash64("body"))
    ordered = tied.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "body")
    blocks = ordered.select("doc_id", "body").mapInArrow(_writer(tokenizer_path, vocabulary, block_ids), FILE)
    blocks.write.mode("overwrite").option("compression", "none").parquet(folder)


def read(spark: SparkSession, folder: str, vocabulary: int = VOCABULARY) -> DataFrame:
    """Documents of written files in terms of their sequence: ``start`` (ids of all
    documents before), ``n_tokens`` and ``ids_crc32`` (checksum of their ids as
    little-endian 32-bit numbers). Damaged blocks are an error."""
    files = spark.read.schema(FILE).parquet(folder)
    order = F.when(F.col("block") < 0, -1 - F.col("block")).otherwise(F.col("block"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = files.repartition(parts, "part").sortWithinPartitions("part", F.col("block") >= 0, order)
    listings = files.filter("block < 0").select("part", "data").mapInArrow(_listed_ids, "part long, n_tokens long")
    return with_starts(sorted_.mapInArrow(_digester(vocabulary), READ), listings)


def with_starts(found: DataFrame, listed: DataFrame) -> DataFrame:
    """Add what all earlier parts hold; there is one sum per part, taken from the lists of
    documents so that blocks are decoded once."""
    sums = listed.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return found.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def _listed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many ids the documents of each list have."""
    for batch in batches:
        numbers = [int(_listed(blob)[1].sum(dtype=np.int64)) for blob in batch.column("data").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), pa.array(numbers, pa.int64())], names=["part", "n_tokens"]
        )


def _digester(vocabulary: int):
    """Decode the blocks of whole parts in order and cut them into documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        waiting: list[bytes] = []
        for batch in batches:
            for part, block, data in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "data")), strict=True):
                if state is None or state.part != part or len(waiting) == GROUP_BLOCKS:
                    if state is not None:
                        yield from state.rows(opened_blocks(waiting, vocabulary))
                    waiting = []
                if state is None or state.part != part:
                    state = _Part(part)
                if block < 0:
                    state.add(data)
                else:
                    waiting.append(data)
        if state is not None:
            yield from state.rows(opened_blocks(waiting, vocabulary))

    return run


class _Part:
    """Documents of a part that are still to be cut from its ids."""

    def __init__(self, part: int) -> None:
        self.part = part
        self.lengths, self.ids, self.nulls = [], [], []
        self.next, self.before = 0, 0
        self.checksum, self.left = 0, None

    def add(self, listing: bytes) -> None:
        _, lengths, ids, nulls = _listed(listing)
        self.lengths += lengths.tolist()
        self.ids += ids.tolist()
        self.nulls += nulls.tolist()

    def rows(self, blocks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Documents that end within the blocks; what is left of the last one is kept
        as its checksum so far."""
        if not blocks:
            return
        stream = np.concatenate(blocks).astype("<u4")
        at, out = 0, []
        while at < len(stream):
            length = self.lengths[self.next]
            left = length if self.left is None else self.left
            end = min(len(stream), at + left)
            self.checksum = zlib.crc32(stream[at:end], self.checksum)
            self.left = left - (end - at)
            at = end
            if not self.left:
                doc = None if self.nulls[self.next] else self.ids[self.next]
                out.append((doc, self.part, self.next, self.before, length, self.checksum))
                self.next, self.before = self.next + 1, self.before + length
                self.checksum, self.left = 0, None
        if out:
            columns = zip(*out, strict=True)
            names = ["doc_id", "part", "place", "before", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
