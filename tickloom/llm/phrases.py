"""Phrase collocations counted by double-array tries of Apriori-safe candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm import bytewords
from tickloom.llm.doublearray import Trie, digits_of
from tickloom.operators.ordered import with_index
from tickloom.session import staged

LONGEST = 3
LEAST = 10
FIRST = 2000
COVERED_PERCENT = 50
UNDETERMINED = "und"
SLICE_BYTES = 4 << 20
BLOCK_BYTES = 32 << 20
TRIE_PHRASES = 500_000
CHUNK = 1024
BATCH_ROWS = 512
KEYS = 1 << 21
ID_BITS = 31

# Words are [^\x20\x09]+ within pieces, which [.,;:!?\x0A-\x0D] split.
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_BREAKS
_WORD[[0x20, 0x09]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _sorted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts of a language next to each other."""
    return batch.take(pc.sort_indices(batch.column("lang")))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return map(_sorted, bytewords.sliced(batches, "body", SLICE_BYTES))


def _words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lower-case words of the texts in order, the text of each, and whether it stands
    in the same piece as the word before."""
    data, bounds = bytewords.text_buffers(batch.column("body"))
    inside = _WORD[data]
    before = np.concatenate(([False], inside[:-1]))[: len(data)]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    letters = _LOWER[data[inside]]
    offsets = np.append(np.cumsum(inside, dtype=np.int32)[start] - 1, len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    )
    row = np.searchsorted(bounds, start, "right") - 1
    breaks = np.cumsum(_BREAKS[data], dtype=np.int32)[start]
    joined = np.zeros(len(start), bool)
    joined[1:] = (row[1:] == row[:-1]) & (breaks[1:] == breaks[:-1])
    return words, row, joined


def _languages(batch: pa.RecordBatch, row: np.ndarray) -> Iterator[tuple[str, slice]]:
    """Each language of a sorted batch with its stretch of words."""
    langs = batch.column("lang").to_pylist()
    edges = [k for k in range(len(langs)) if k == 0 or langs[k] != langs[k - 1]] + [len(langs)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield langs[a], slice(int(np.searchsorted(row, a)), int(np.searchsorted(row, b)))


def _word_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _texts(batches):
        words, row, _ = _words(batch)
        for lang, part in _languages(batch, row):
            counted = words[part].value_counts()
            own = counted.field(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), own.cast(pa.string()), counted.field(1)],
                names=["lang", "word", "n"],
            )


def _coder(block: Broadcast, first: bool, last: bool, longest: int):
    """Number the words of texts that stand in a block of the dictionary; the last
    block makes chunks of numbers of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[pa.Array, np.ndarray]] = block.value
        for batch in _texts(batches):
            words, row, joined = _words(batch)
            numbers = np.zeros(len(words), np.int32)
            if not first:
                numbers[:] = np.frombuffer(b"".join(batch.column("numbers").to_pylist()), np.int32)
            for lang, part in _languages(batch, row):
                if lang in known:
                    names, given = known[lang]
                    at = pc.index_in(words[part], value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
                    numbers[part] = np.where(at >= 0, given[at], numbers[part])
            if last:
                yield from _chunks(_runs(numbers, joined), longest)
            else:
                head = np.searchsorted(row, np.arange(batch.num_rows + 1))
                own = [numbers[a:b].tobytes() for a, b in zip(head[:-1], head[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang"), batch.column("body"), pa.array(own, pa.binary())],
                    names=["lang", "body", "numbers"],
                )

    return run


def _runs(numbers: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Words that have a numbered neighbour in their piece, a 0 before each run."""
    linked = np.zeros(len(numbers) + 1, bool)
    linked[1:-1] = joined[1:] & (numbers[1:] > 0) & (numbers[:-1] > 0)
    kept = linked[:-1] | linked[1:]
    begins = (kept & ~linked[:-1])[kept]
    out = np.zeros(len(begins) + int(begins.sum()), np.int32)
    out[np.arange(len(begins)) + np.cumsum(begins)] = numbers[kept]
    return out


def _chunks(numbers: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``CHUNK`` numbers, each with what phrases that begin there need of the
    next."""
    rows = [numbers[at : at + CHUNK + longest - 1] for at in range(0, len(numbers), CHUNK)]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate([*rows, np.zeros(0, np.int32)])
    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))], names=["numbers"])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to a few hundred chunks, since a chunk is long."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _positions(batch: pa.RecordBatch, words: int, beyond: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All numbers of a batch, and the places where as many words in a row begin: those
    this row has to count, and up to ``beyond`` of the next one's. For each whether it
    is to be counted here."""
    lists = batch.column("numbers")
    offsets = lists.offsets.to_numpy()
    numbers = lists.flatten().to_numpy(zero_copy_only=False)
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    place = np.arange(len(numbers)) - np.repeat(offsets[:-1], size)
    good = (place < CHUNK + beyond) & (place + words <= np.repeat(size, size))
    for k in range(words):
        good[: len(numbers) - k] &= numbers[k:] > 0
    start = np.flatnonzero(good)
    return numbers, start, place[start] < CHUNK


def _tally(held: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.unique(np.concatenate(held), return_counts=True)
    return keys, np.minimum(counts, least)


def _pair_sieve(least: int):
    """Pairs of frequent words that stand together, with what a task saw of them, up
    to ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in _chunked(batches):
            numbers, start, _ = _positions(batch, 2)
            held.append((numbers[start].astype(np.int64) << ID_BITS) | numbers[start + 1])
            size += len(start)
            if size >= KEYS:
                yield _keys(held, least)
                held, size = [], 0
        if size:
            yield _keys(held, least)

    return run


def _keys(held: list[np.ndarray], least: int) -> pa.RecordBatch:
    keys, counts = _tally(held, least)
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts, pa.int32())], names=["next", "seen"])


def _trie_builder(digits: int):
    def run(group: pa.Table) -> pa.Table:
        ids = group.column("ids").combine_chunks()
        phrases = ids.flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1).astype(np.int64)
        order = np.lexsort(phrases.T[::-1])
        trie = Trie.of(phrases[order], digits)
        rows = group.column("idx").to_numpy()[order]
        return pa.table(
            {
                "shard": group.column("shard")[:1],
                "words": pa.array([trie.words], pa.int32()),
                "base": pa.array([trie.base.tobytes()], pa.binary()),
                "check": pa.array([trie.check.tobytes()], pa.binary()),
                "idx": pa.array([rows.tobytes()], pa.binary()),
            }
        )

    return run


def _walker(sent: Broadcast, shard: int, shards: int, least: int, more: bool):
    """Occurrences of the trie's phrases (``phrase``, ``n``) and, with ``more``, their
    extensions by a word whose own last words may be a phrase too (``next``,
    ``seen``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, digits, base, check, rows = sent.value
        trie = Trie(words, digits, np.frombuffer(base, np.int32), np.frombuffer(check, np.int32))
        idx = np.frombuffer(rows, np.int64)
        counts = np.zeros(len(idx), np.int64)
        held, size = [], 0
        for batch in _chunked(batches):
            numbers, start, counting = _positions(batch, words, 1)
            alive, entry = trie.walk(numbers, start)
            counts += np.bincount(entry[counting[alive]], minlength=len(idx))
            if more:
                _, longer, _ = _positions(batch, words + 1)
                held.append(_extensions(numbers, start[alive], idx[entry], longer, words, shard, shards))
                size += len(held[-1])
                if size >= KEYS:
                    yield _walked(next=_tally(held, least))
                    held, size = [], 0
        if size:
            yield _walked(next=_tally(held, least))
        some = np.flatnonzero(counts)
        yield _walked(phrase=(idx[some], counts[some]))

    return run


def _extensions(numbers, found, phrase, longer, words: int, shard: int, shards: int) -> np.ndarray:
    """Keys of the phrases of one more word that begin with a phrase found; if their
    last words belong to this shard, those have to be a phrase as well."""
    at = np.full(len(numbers) + 1, -1, np.int64)
    at[found] = phrase
    begin = longer[at[longer] >= 0]
    own = np.zeros(len(begin), np.int64)
    for k in range(1, words + 1):
        own += numbers[begin + k]
    begin = begin[(own % shards != shard) | (at[begin + 1] >= 0)]
    return (at[begin] << ID_BITS) | numbers[begin + words]


def _walked(phrase=None, next=None) -> pa.RecordBatch:
    none = pa.nulls
    if phrase is not None:
        keys, counts = phrase
        columns = [pa.array(keys), pa.array(counts), none(len(keys), pa.int64()), none(len(keys), pa.int32())]
    else:
        keys, counts = next
        size = len(keys)
        columns = [none(size, pa.int64()), none(size, pa.int64()), pa.array(keys), pa.array(counts, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=["phrase", "n", "next", "seen"])


def _frequent(seen: DataFrame, least: int) -> DataFrame:
    """Keys seen ``least`` times by all tasks together, in their parts."""
    kept = seen.groupBy("next").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= least)
    return kept.select(
        F.shiftright("next", ID_BITS).alias("prefix"), F.col("next").bitwiseAND((1 << ID_BITS) - 1).cast("int").alias("id")
    )


def _numbered(phrases: DataFrame) -> tuple[DataFrame, int]:
    """Phrases (``ids``) with their number and the shard of their trie."""
    rows = staged(with_index(staged(phrases), ["ids"]))
    count = rows.count()
    shards = max(1, -(-count // TRIE_PHRASES))
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.withColumn("shard", F.pmod(total, F.lit(shards)).cast("int")), shards if count else 0


def _counted(
    numbers: DataFrame, phrases: DataFrame, shards: int, digits: int, least: int, more: bool
) -> tuple[DataFrame, DataFrame]:
    """Counts of the phrases and what their extensions have been seen; one pass over
    the numbered texts for each trie."""
    spark = numbers.sparkSession
    fields = "shard int, words int, base binary, check binary, idx binary"
    tries = staged(phrases.groupBy("shard").applyInArrow(_trie_builder(digits), fields))
    walked = None
    for row in tries.toLocalIterator():
        sent = spark.sparkContext.broadcast((row["words"], digits, bytes(row["base"]), bytes(row["check"]), bytes(row["idx"])))
        seen = numbers.mapInArrow(
            _walker(sent, row["shard"], shards, least, more), "phrase long, n long, next long, seen int"
        )
        part = staged(seen)
        sent.destroy()
        walked = part if walked is None else walked.unionByName(part)
    counts = walked.filter("phrase IS NOT NULL").groupBy(F.col("phrase").alias("idx")).agg(F.sum("n").alias("f"))
    return counts, walked.filter("next IS NOT NULL").select("next", "seen")


def _coded(texts: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """Texts as chunks of word numbers, one pass for each block of the dictionary."""
    spark = texts.sparkSession
    size = words.agg(F.sum(F.octet_length("word").cast("long") + 8)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(blocks):
        own = words.filter(F.pmod(F.col("id"), F.lit(blocks)) == block).select("lang", "word", "id").toArrow()
        known = {}
        for lang in pc.unique(own.column("lang")).to_pylist():
            rows = own.filter(pc.equal(own.column("lang"), lang))
            names = rows.column("word").combine_chunks().cast(pa.large_string())
            known[lang] = names, rows.column("id").to_numpy().astype(np.int32)
        sent = spark.sparkContext.broadcast(known)
        last = block == blocks - 1
        kind = "numbers array<int>" if last else "lang string, body string, numbers binary"
        texts = staged(texts.mapInArrow(_coder(sent, block == 0, last, longest), kind))
        sent.destroy()
    return texts


def mine(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    first: int = FIRST,
    covered_percent: int = COVERED_PERCENT,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The ``first`` phrases of two to ``longest`` words of every language whose words
    keep together most.

    Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and into
    words at blanks. A phrase occurs at least ``least`` times. Cut after its first k
    words it scores 1,000,000 * a * a / (l * r), rounded down, from its own count and
    those of the two parts; its worst cut counts. Phrases inside longer ones that have
    at least ``covered_percent`` of their occurrences are left out.

    Frequent words get numbers, and texts are written down as numbers with all else
    cut out. A phrase is a candidate if the parts of one word less are frequent and
    tasks together saw it often enough; they report no more than ``least`` each.
    Candidates go out as double-array tries of at most about ``TRIE_PHRASES``; all
    positions of a task's texts walk the trie side by side, and the counts of the
    states where phrases end are summed over the tasks. The dictionary goes out in
    blocks of about ``BLOCK_BYTES``. Each trie and block makes a pass of its own, so
    that a task holds one at a time; their number grows with the phrases that reach
    ``least``. Scores are computed with decimals of 38 digits.

    Null texts are empty, a null language is ``und`` and the same as that name. Repeated
    rows count each; other columns are not used; no phrase gives no rows. Ties go to
    the more frequent phrase, then to the lesser in bytes, those of cuts to the
    smallest k. Counts up to 10^12 keep the arithmetic exact."""
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNDETERMINED)).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body"),
    )
    seen = texts.mapInArrow(_word_counter, "lang string, word string, n long")
    counts = staged(seen.groupBy("lang", "word").agg(F.sum("n").alias("f")))
    totals = counts.groupBy("lang").agg(F.sum("f").alias("total"))
    words = with_index(counts.filter(F.col("f") >= least), ["lang", "word"])
    words = staged(words.withColumn("id", (F.col("idx") + 1).cast("int")).drop("idx"))
    digits = digits_of(words.agg(F.max("id")).first()[0] or 0)
    numbers = _coded(texts, words, longest)
    parts = [words.select(F.array("id").alias("ids"), "f")]
    sieve = numbers.mapInArrow(_pair_sieve(least), "next long, seen int")
    prefixes = words.select(F.col("id").cast("long").alias("prefix"), F.array("id").alias("head"))
    for size in range(2, longest + 1):
        found = _frequent(sieve, least).join(prefixes, "prefix").select(F.concat("head", F.array("id")).alias("ids"))
        phrases, shards = _numbered(found)
        if not shards:
            break
        counts, sieve = _counted(numbers, phrases, shards, digits, least, size < longest)
        kept = staged(phrases.join(counts, "idx").filter(F.col("f") >= least).select("idx", "ids", "f"))
        parts.append(kept.select("ids", "f"))
        prefixes = kept.select(F.col("idx").alias("prefix"), F.col("ids").alias("head"))
    return _ranked(parts, words, totals, first, covered_percent)


def _ranked(parts: list[DataFrame], words: DataFrame, totals: DataFrame, first: int, percent: int) -> DataFrame:
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    phrases = every.filter(F.size("ids") > 1).withColumnRenamed("f", "a")
    scored = staged(_scored(_uncovered(phrases, percent), every))
    lang = words.select("lang", F.col("id").alias("first_id"))
    placed = scored.withColumn("first_id", F.element_at("ids", 1)).join(lang, "first_id")
    near = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near_first = staged(placed.withColumn("_at", F.rank().over(near)).filter(F.col("_at") <= first))
    spelled = near_first.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    in_order = F.array_sort(F.collect_list(F.struct("at", "word")))
    names = spelled.groupBy("ids").agg(F.array_join(F.transform(in_order, lambda w: w["word"]), " ").alias("phrase"))
    exact = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = near_first.join(names, "ids").withColumn("rank", F.row_number().over(exact).cast("long"))
    return (
        ranked.filter(F.col("rank") <= first)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    )


def _uncovered(phrases: DataFrame, percent: int) -> DataFrame:
    """Phrases that no longer one has nearly all occurrences of."""
    size = F.size("ids")
    starts = F.explode(F.sequence(F.lit(1), size - F.col("short") + 1))
    inner = (
        phrases.filter(size > 2)
        .withColumn("short", F.explode(F.sequence(F.lit(2), size - 1)))
        .withColumn("at", starts)
        .groupBy(F.slice("ids", F.col("at"), F.col("short")).alias("ids"))
        .agg(F.max("a").alias("around"))
    )
    covered = F.coalesce(100 * F.col("around") >= percent * F.col("a"), F.lit(False))
    return phrases.join(inner, "ids", "left").filter(~covered).drop("around")


def worst_score(a: Column, left: Column, right: Column) -> Column:
    """1,000,000 * a * a / (left * right), rounded down."""
    wide = [c.cast("decimal(13,0)") for c in (a, left, right)]
    over = F.lit(1_000_000).cast("decimal(7,0)") * (wide[0] * wide[0])
    return F.call_function("div", over, wide[1] * wide[2])


def _scored(phrases: DataFrame, every: DataFrame) -> DataFrame:
    """Counts of the parts and score of the worst cut."""
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    cut = cut.withColumn("left", F.slice("ids", F.lit(1), F.col("k")))
    cut = cut.withColumn("right", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")))
    left = every.select(F.col("ids").alias("left"), F.col("f").alias("l"))
    right = every.select(F.col("ids").alias("right"), F.col("f").alias("r"))
    both = cut.join(left, "left").join(right, "right")
    both = both.withColumn("score", worst_score(F.col("a"), F.col("l"), F.col("r")))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("worst")
    return both.groupBy("ids", "a").agg(worst).select("ids", "a", "worst.l", "worst.r", "worst.score")
