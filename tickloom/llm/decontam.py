"""Benchmark decontamination by a broadcast set of test n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tickloom.llm import bytewords
from tickloom.llm.bytewords import LETTERS_DIGITS
from tickloom.llm.placing import unpacked, with_text
from tickloom.session import staged

WINDOW = 13
BLOCK_WINDOWS = 500_000
FILTER_BITS = 20
RANGE = StructType([StructField("first", LongType()), StructField("last", LongType())])
STATE = [
    StructField("n_words", LongType()),
    StructField("ranges", ArrayType(RANGE)),
    StructField("item_ids", ArrayType(StringType())),
]
OUTPUTS = ["n_words", "n_hit", "item_ids", "ranges", "contaminated"]


@dataclass
class Needles:
    """Test windows: for each length their hashes, sorted, the words of each and
    the items it is from. ``screen`` has a bit for the head of every hash."""

    items: list[str] = field(default_factory=list)
    windows: dict[int, dict[bytes, list[int]]] = field(default_factory=lambda: defaultdict(dict))
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    texts: dict[int, list[bytes]] = field(default_factory=dict)
    screen: dict[int, np.ndarray] = field(default_factory=dict)
    count: int = 0

    def add(self, item: str, text: str, n: int) -> None:
        words = bytewords.words_of(pa.array([text]), LETTERS_DIGITS)
        if not len(words.hash):
            return
        tokens = bytewords.folded(np.frombuffer(text.encode(), np.uint8), LETTERS_DIGITS).split()
        size = min(n, len(tokens))
        number = len(self.items)
        self.items.append(item)
        held = self.windows[size]
        for at in range(len(tokens) - size + 1):
            owners = held.setdefault(b" ".join(tokens[at : at + size]), [])
            if not owners or owners[-1] != number:
                owners.append(number)
                self.count += 1

    def sealed(self) -> Needles:
        for size, held in self.windows.items():
            texts = list(held)
            words = bytewords.words_of(pa.array([t.decode() for t in texts]), LETTERS_DIGITS)
            _, hashed = bytewords.window_hashes(words, size)
            order = np.argsort(hashed, kind="stable")
            self.hashes[size] = hashed[order]
            self.texts[size] = [texts[i] for i in order]
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[hashed >> np.uint64(64 - FILTER_BITS)] = True
            self.screen[size] = bits
        return self

    def hits(self, words: bytewords.Words, clean: bytes) -> Iterator[tuple[int, int, list[int]]]:
        """First word, length and items of every verified window."""
        for size, known in self.hashes.items():
            first, hashed = bytewords.window_hashes(words, size)
            near = np.flatnonzero(self.screen[size][hashed >> np.uint64(64 - FILTER_BITS)])
            left = np.searchsorted(known, hashed[near], "left")
            right = np.searchsorted(known, hashed[near], "right")
            found = left < right
            for at, low, high in zip(first[near[found]], left[found], right[found], strict=True):
                window = b" ".join(clean[words.start[at] : words.end[at + size - 1]].split())
                for k in range(low, high):
                    if self.texts[size][k] == window:
                        yield int(at), size, self.windows[size][window]
                        break


def needle_blocks(benchmark: DataFrame, item: str, text: str, n: int, limit: int) -> Iterator[Needles]:
    """Test items in blocks of about ``limit`` windows, at least one; the driver holds
    one block at a time."""
    block, made = Needles(), False
    rows = benchmark.select(F.col(f"`{item}`").cast("string"), F.col(f"`{text}`")).toLocalIterator()
    for name, body in rows:
        if block.count >= limit:
            yield block.sealed()
            block, made = Needles(), True
        block.add("" if name is None else name, body or "", n)
    if block.count or not made:
        yield block.sealed()


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Mark the words of documents that lie in an occurrence of a test window.

    Words are runs of a-z, 0-9 and non-ASCII characters once A-Z became a-z. A
    test window is ``n`` words in a row, or a whole shorter item. The windows are
    broadcast as a hash set, in blocks of about ``block_windows``. Each block is a pass
    of its own; what it finds is written down, and the block dropped, before the next
    goes out, so that neither tasks nor driver hold two. Hashed hits are verified by
    their words.

    Returns the kept columns and ``n_words``, ``n_hit`` (words hit), ``item_ids``
    (distinct, as text, in order), ``ranges`` (hit words, first and last) and
    ``contaminated``: at least one of twenty words is hit. Null and empty texts
    have no words and are never contaminated; items without words do nothing; a
    null item id counts as an empty one; repeated rows stay; an empty benchmark
    marks nothing."""
    found = marked_rows(docs, benchmark, n, text, item, item_text, keep, block_windows)
    return unpacked(found, "row", OUTPUTS)


def marked_rows(
    docs: DataFrame, benchmark: DataFrame, n: int, text: str, item: str, item_text: str, keep, block_windows: int
) -> DataFrame:
    """What ``mark`` returns, with the kept columns as a struct ``row``."""
    columns, at = with_text(docs, keep, text, F.col(f"`{text}`").cast("string"))
    rows = docs.select(*columns)
    held = [f for f in rows.schema if f.name == "body"]
    blocks = iter(needle_blocks(benchmark, item, item_text, n, block_windows))
    needles = next(blocks)
    while needles is not None:
        following = next(blocks, None)
        sent = docs.sparkSession.sparkContext.broadcast(needles)
        schema = StructType([rows.schema["row"], *(held if following else []), *STATE])
        rows = rows.mapInArrow(_scanner(sent, at, schema), schema)
        if following:
            rows = staged(rows)
            sent.destroy()
        needles = following
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"] + 1)
    return rows.withColumn("n_hit", hit).withColumn("contaminated", contaminated())


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def _scanner(needles, column: str, schema: StructType):
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {f.name: to_arrow_type(f.dataType) for f in STATE}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytewords.sliced(batches, column):
            values = _marked(batch, bytewords.carried(batch, column), needles.value)
            made = {name: pa.array(v, kinds[name]) for name, v in zip(kinds, values, strict=True)}
            columns = [made[name] if name in made else batch.column(name) for name in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return scan


def _marked(batch: pa.RecordBatch, texts: pa.Array, needles: Needles):
    """Word counts, merged ranges of hit words and item ids of a batch's rows, with
    what earlier blocks have found."""
    data, bounds = bytewords.text_buffers(texts)
    words = bytewords.words_in(data, bounds, LETTERS_DIGITS)
    counts = np.bincount(words.row, minlength=batch.num_rows)
    head = np.concatenate(([0], np.cumsum(counts)))
    before = "ranges" in batch.schema.names
    ranges, items = (
        batch.column(c).to_pylist() if before else [[] for _ in range(batch.num_rows)] for c in ("ranges", "item_ids")
    )
    found = defaultdict(list)
    clean = bytewords.folded(data, LETTERS_DIGITS)
    for at, size, owners in needles.hits(words, clean):
        found[int(words.row[at])].append((at, size, owners))
    for row, hits in found.items():
        at = int(head[row])
        spans = [(r["first"], r["last"]) for r in ranges[row]] + [(a - at, a - at + s - 1) for a, s, _ in hits]
        ranges[row] = [{"first": a, "last": b} for a, b in merged(spans)]
        owners = {id(o): o for _, _, o in hits}.values()
        items[row] = sorted({*items[row], *(needles.items[i] for o in owners for i in o)})
    return counts, ranges, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def without_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The documents that are not contaminated, in their own columns."""
    marked = marked_rows(docs, benchmark, n, text, item, item_text, None, block_windows)
    return marked.filter(~F.col("contaminated")).select("row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, hit words and what stands between them cut from their texts."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")
    body = F.col(f"`{text}`").alias("body")
    marked = mark(docs.select(row, body), benchmark, text="body", keep=["kept", "body"], **options)
    cut = marked.select("kept", "body", "ranges")
    cleaned = cut.mapInArrow(_cutter, StructType([cut.schema["kept"], StructField("body", StringType())]))
    return cleaned.select(*[F.col("body").alias(c) if c == text else F.col(f"kept.`{c}`") for c in docs.columns])


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bytewords.sliced(batches, "body"):
        texts = batch.column("body").to_pylist()
        for row, ranges in enumerate(batch.column("ranges").to_pylist()):
            if ranges:
                raw = texts[row].encode()
                words = bytewords.words_of(pa.array([texts[row]]), LETTERS_DIGITS)
                cuts = [(words.start[r["first"]], words.end[r["last"]]) for r in ranges]
                parts, at = [], 0
                for low, high in cuts:
                    parts.append(raw[at:low])
                    at = high
                texts[row] = b"".join([*parts, raw[at:]]).decode()
        yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], names=["kept", "body"])
