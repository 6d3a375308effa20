"""Similarity join of documents on word shingles by token-combination prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm import bytewords
from tickloom.llm.bytewords import BETWEEN_BLANKS, scrambled
from tickloom.llm.components import components
from tickloom.llm.placing import packed, unpacked
from tickloom.session import small_batches, staged

SHINGLE = 5
PERCENT = 75
LEAST_PERCENT = 20
FREQUENT = 16
FEW = 12
TURNS = 3
PIVOTS = 4
MARKS = 32
CLASS_SHIFT = 16
SLICE_BYTES = 1 << 18
PACKET_TOKENS = 1 << 20
PART_TOKENS = 1 << 20
BROADCAST_SETS = 1_000_000
OUTPUTS = ["n_shingles", "component_id"]


# --- token sets ----------------------------------------------------------------


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, by row and hash. A text
    of fewer than ``n`` words, but not none, has one: all its words."""
    words = bytewords.words_of(texts, BETWEEN_BLANKS)
    counts = np.bincount(words.row, minlength=len(texts))
    first, hashes = bytewords.window_hashes(words, n)
    rows, values = [words.row[first]], [hashes]
    for size in range(1, n):
        if (counts == size).any():
            first, hashes = bytewords.window_hashes(words, size)
            short = counts[words.row[first]] == size
            rows.append(words.row[first[short]])
            values.append(hashes[short])
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[fresh], value[fresh]


def fingerprints(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit fingerprint of each row's set."""
    sizes = np.bincount(row, minlength=n)
    sums = np.zeros(n, np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        heads = np.concatenate(([0], np.cumsum(sizes)))[some]
        sums[some] = np.add.reduceat(scrambled(value + np.uint64(1)), heads)
    return sizes, scrambled(sums + sizes.astype(np.uint64)).view(np.int64)


# --- prefixes --------------------------------------------------------------------


def overlap(n: int, percent: int) -> int:
    """The least number of tokens that a set of ``n`` shares with one it links with."""
    return -(-percent * n // 100)


def combined(percent: int) -> int:
    """Tokens of a combination: two, if all sets that link share as many."""
    return 2 if overlap(2, percent) >= 2 else 1


def prefix_length(n: Column, percent: int) -> Column:
    """Two sets that link share a combination among the first so many tokens of each,
    in any order common to all."""
    return n - F.ceil(percent * n / 100) + combined(percent)


def _sent_classes(bits: int):
    """Token classes (the first 48 bits) of all sets, packed by range of classes:
    sorted steps between classes and the place of each one's set in the packet.
    The sets of a packet go along in a row of their own. Of copies of a set within
    a task only the first is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packet = TaskContext.get().partitionId() << 24
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        prints, sizes, size = [], [], 0
        for batch in bytewords.sliced(batches, "body", SLICE_BYTES):
            row, value = shingle_sets(batch.column("body"))
            count, mark = fingerprints(row, value, batch.num_rows)
            place = np.full(batch.num_rows, -1, np.int32)
            for at, (n, own) in enumerate(zip(count.tolist(), mark.tolist(), strict=True)):
                if n > 1 and own not in seen:
                    seen.add(own)
                    place[at] = len(prints)
                    prints.append(own)
                    sizes.append(n)
            kept = place[row] >= 0
            held.append((value[kept] >> np.uint64(CLASS_SHIFT), place[row[kept]]))
            size += int(kept.sum())
            if size >= PACKET_TOKENS:
                yield _packet(packet, held, prints, sizes, bits)
                packet, held, prints, sizes, size = packet + 1, [], [], [], 0
        if size:
            yield _packet(packet, held, prints, sizes, bits)

    return run


def _packet(packet: int, held, prints: list[int], sizes: list[int], bits: int) -> pa.RecordBatch:
    """A class goes out once, whatever the number of sets here that have it; if several
    do, they are counted at once and the class goes without a place."""
    classes, places = (np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    order = np.argsort(classes)
    classes, places = classes[order], places[order]
    del order
    same = np.zeros(len(classes) + 1, bool)
    same[1:-1] = classes[1:] == classes[:-1]
    several = same[1:] | same[:-1]
    here = np.bincount(places[several], minlength=len(prints))
    places[several] = len(prints)
    classes, places = classes[~same[:-1]], places[~same[:-1]]
    part = (classes >> np.uint64(64 - CLASS_SHIFT - bits)).astype(np.int64)
    cuts = np.searchsorted(part, np.arange((1 << bits) + 1))
    parts = np.flatnonzero(np.diff(cuts))
    blobs = [np.array([prints, sizes, here], np.int64).tobytes()]
    for low, high in zip(cuts[parts], cuts[parts + 1], strict=True):
        steps = np.diff(classes[low:high], prepend=np.uint64(0))
        blobs.append(planes(steps) + planes(places[low:high].astype(np.uint64)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(blobs), packet)),
            pa.array(np.concatenate(([-1 - packet], parts))),
            pa.array(blobs, pa.binary()),
        ],
        names=["packet", "part", "blob"],
    )


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte of equal weight, so that empty bytes lie together."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(blob: bytes, number: int = 1) -> list[np.ndarray]:
    whole = np.frombuffer(blob, np.uint8).reshape(number, 8, -1)
    return [np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in whole]


def _shared_places(table: pa.Table) -> pa.Table:
    """From one range of classes, for each packet the places of sets, once for every
    token another set has too. Rows that list the sets pass as they are."""
    if table.column("part")[0].as_py() < 0:
        return table.select(["packet", "part", "blob"])
    packets = table.column("packet").to_pylist()
    both = [unplanes(blob.as_py(), 2) for blob in table.column("blob")]
    classes = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in both])
    order = np.argsort(classes)
    ordered = classes[order]
    same = np.zeros(len(classes) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    shared = np.zeros(len(classes), bool)
    shared[order] = same[1:] | same[:-1]
    out, at = [], 0
    for _, places in both:
        out.append(places[shared[at : at + len(places)]].astype(np.uint32).tobytes())
        at += len(places)
    return pa.table(
        {
            "packet": pa.array(packets, pa.int64()),
            "part": pa.array(np.zeros(len(out), np.int64)),
            "blob": pa.array(out, pa.binary()),
        }
    )


def _shared_counts(table: pa.Table) -> pa.Table:
    """Sets of one packet with the number of their tokens that another set has."""
    prints = sizes = here = None
    places = [np.zeros(0, np.uint32)]
    for part, blob in zip(table.column("part").to_pylist(), table.column("blob").to_pylist(), strict=True):
        if part < 0:
            prints, sizes, here = np.frombuffer(blob, np.int64).reshape(3, -1)
        else:
            places.append(np.frombuffer(blob, np.uint32))
    counts = np.bincount(np.concatenate(places), minlength=len(prints) + 1)[: len(prints)]
    return pa.table({"set": prints, "n": sizes, "common": here + counts})


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every token of the sets."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            values = [np.frombuffer(t.as_py(), np.int64) for t in part.column("tokens")]
            sizes = [len(v) for v in values]
            rest = [pa.array(np.repeat(part.column(c).to_numpy(), sizes)) for c in ("set", "n", "common")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(values)), *rest], names=["key", "set", "n", "common"]
            )


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bytewords.sliced(batches, "body", SLICE_BYTES):
        sizes, prints = fingerprints(*shingle_sets(batch.column("body")), batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id"), batch.column("text_key"), pa.array(sizes), pa.array(prints)],
            names=["row", "id", "text_key", "n", "set"],
        )


def _with_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bytewords.sliced(batches, "body", SLICE_BYTES):
        row, value = shingle_sets(batch.column("body"))
        sizes, prints = fingerprints(row, value, batch.num_rows)
        ends = np.cumsum(sizes)
        tokens = [value[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(prints), pa.array(sizes), pa.array(tokens, pa.binary()), marks(row, value, batch.num_rows)],
            names=["set", "n", "tokens", "marks"],
        )


def marks(row: np.ndarray, value: np.ndarray, n: int) -> pa.Array:
    """For each set a row of bits, each the parity of the tokens that fall to it. Two
    sets differ in at most as many bits as there are tokens that only one has."""
    bits = 64 * MARKS
    out = np.zeros((n, MARKS), np.int64)
    cell = (value >> np.uint64(40)).astype(np.int64) % bits
    for low in range(0, n, 256):
        high = min(n, low + 256)
        a, b = np.searchsorted(row, [low, high])
        odd = np.bincount((row[a:b] - low) * bits + cell[a:b], minlength=(high - low) * bits) & 1
        out[low:high] = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(-1, MARKS)
    return pa.ListArray.from_arrays(np.arange(0, n * MARKS + 1, MARKS, dtype=np.int32), pa.array(out.ravel()))


# --- join --------------------------------------------------------------------------


def candidate_sets(docs: DataFrame, percent: int, tokens: int) -> DataFrame:
    """Fingerprints of the sets that can have a partner: of their tokens at least
    ``percent`` of a hundred are in some other set as well. ``common`` says how many.

    Tokens are compared by range of classes, wherever their sets are: a few bytes a
    token go out, and two bytes come back for a token that is shared. Ranges follow from
    the number of ``tokens``, and a packet sends a class once, so neither a range nor a
    frequent token makes a task larger than its share."""
    bits = min(24, max(2, (tokens // PART_TOKENS).bit_length()))
    row = "packet long, part long, blob binary"
    sent = docs.mapInArrow(_sent_classes(bits), row)
    back = sent.groupBy("part").applyInArrow(_shared_places, row)
    counted = back.groupBy("packet").applyInArrow(_shared_counts, "set long, n long, common long")
    return counted.filter(100 * F.col("common") >= percent * F.col("n")).select("set", "common").distinct()


def prefixes(tokens: DataFrame, percent: int) -> DataFrame:
    """Candidate sets with the tokens of their extended prefixes that other candidates
    have too (``shared``), each with its count and its place in the set, the rarest first.

    Tokens are ordered by the number of candidates that have them, so a prefix is full
    of what is the set's own before it comes to what many sets quote."""
    rows = tokens.mapInArrow(_postings, "key long, set long, n long, common long")
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    met = rows.join(counts, "key").groupBy("set", "n", "common")
    gathered = met.agg(F.array_sort(F.collect_list(F.struct("count", "key"))).alias("met"))
    alone = F.col("n") - F.size("met")
    length = (prefix_length(F.col("n"), percent) - alone).cast("int")
    first = F.slice("met", F.lit(1), F.greatest(length, F.lit(0)))
    placed = F.transform(first, lambda t, i: F.struct(t["count"].alias("count"), t["key"].alias("key"), (alone + i).alias("at")))
    return gathered.filter(length > 0).select("set", "n", "common", placed.alias("shared"))


def index_keys(candidates: DataFrame, percent: int, frequent: int) -> DataFrame:
    """Sets by the keys they meet in: ``key``, ``set`` with its size and common tokens,
    ``at``, the place of the key's first token in the set, and ``few``.

    Sets that link share two tokens of their extended prefixes. If one of these is
    rare, with fewer than ``frequent`` sets, it is a key of both. If all are frequent,
    both sets have a pair of them: all pairs of a set's frequent tokens are its keys, as
    long as it has at most ``FEW``. Sets of more have too many pairs; the frequent tokens
    themselves are their keys, and those of the sets of few as well, to meet them. There
    ``few`` marks the latter, which need not be compared with each other.

    Where sets that link may share a single token, each token is a key."""
    base = ["set", "n", "common"]
    if combined(percent) == 1:
        single = candidates.select(*base, F.explode("shared").alias("t"))
        return single.select(F.col("t.key").alias("key"), *base, "t.at", F.lit(False).alias("few"))
    rare = F.filter("shared", lambda t: t["count"] < frequent)
    parted = candidates.select(*base, rare.alias("rare"), F.filter("shared", lambda t: t["count"] >= frequent).alias("often"))
    few = F.size("often") <= FEW
    rares = parted.select(F.explode("rare").alias("t"), *base, F.lit(False).alias("few"))
    often = parted.filter(F.size("often") > 1)
    singles = rares.unionByName(often.select(F.explode("often").alias("t"), *base, few.alias("few")))
    firsts = often.filter(few).select(*base, "often", F.posexplode("often").alias("at", "t"))
    behind = F.slice("often", F.col("at") + 2, F.size("often"))
    pairs = firsts.select(*base, "t", F.explode(behind).alias("u"))
    pairs = pairs.select(F.xxhash64("t.key", "u.key").alias("key"), *base, "t.at", F.lit(False).alias("few"))
    return singles.select(F.col("t.key").alias("key"), *base, "t.at", "few").unionByName(pairs)


def possible(percent: int, n: Column, common: Column, other_n: Column, other_common: Column) -> Column:
    """Whether two sets can link, by their sizes and by the tokens each has in common
    with any set: they cannot share more than these."""
    return (100 + percent) * F.least(common, other_common) >= percent * (n + other_n)


def linked(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs of sets whose overlap is large enough, by comparing all tokens."""
    left = tokens.select(F.col("set").alias("a"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("set").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(
        _verifier(percent), "a long, b long"
    )


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.zeros(batch.num_rows, bool)
            for at, (x, y) in enumerate(zip(batch.column("ta"), batch.column("tb"), strict=True)):
                a, b = (np.frombuffer(t.as_py(), np.uint64) for t in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                kept[at] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    return run


def set_components(docs: DataFrame, described: DataFrame, percent: int, frequent: int) -> DataFrame:
    """``node``, ``root``: components of sets that link, for all but the roots.

    In a few turns every set of a key is compared with one set of the key only, another
    one each turn, unless both hang together already. Near copies hang together then.
    What is left are keys whose sets are still apart, and only pairs from different
    components of these, which can link by their sizes and marks, are compared too."""
    total = described.agg(F.sum("n")).first()[0] or 0
    found = staged(candidate_sets(docs.select("body"), percent, total))
    tokens = staged(_tokens_of(docs, described, found))
    candidates = staged(prefixes(tokens, percent))
    met = staged(_met(index_keys(candidates, percent, frequent)))
    edges = docs.sparkSession.createDataFrame([], "a long, b long")
    roots = edges.toDF("node", "root")
    for turn in range(TURNS):
        apart = staged(_apart(met, roots))
        stars = staged(_stars(apart, percent, turn))
        if stars.isEmpty():
            return roots
        edges = roots.toDF("a", "b").unionByName(linked(stars, tokens, percent))
        roots = components(edges)
    apart = staged(_apart(met, roots))
    rest = linked(_crossed(apart, tokens.select("set", "marks"), percent), tokens, percent)
    return components(roots.toDF("a", "b").unionByName(rest))


def _met(keys: DataFrame) -> DataFrame:
    """Members of keys that more than one set has, unless all of them are ``few``."""
    ends = keys.groupBy("key").agg(F.min("set").alias("low"), F.max("set").alias("high"), F.min("few").alias("all_few"))
    return keys.join(ends.filter("low < high AND NOT all_few").select("key"), "key", "left_semi")


def _apart(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of keys whose sets lie in more than one component, with these."""
    of_set = roots.select(F.col("node").alias("set"), "root")
    rooted = met.join(of_set, "set", "left").withColumn("root", F.coalesce("root", "set"))
    split = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    return rooted.join(split.select("key"), "key", "left_semi")


def _stars(apart: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of a set and the pivot of one of its keys, in different components. The
    first turn takes the least set of a key; later ones draw, and the keys of a group
    draw a few different sets between them."""
    draw = F.xxhash64("set", F.pmod("key", F.lit(PIVOTS)), F.lit(turn)) if turn else F.col("set")
    pivot = F.min_by(F.struct("set", "n", "common", "root"), F.struct("few", draw)).alias("pivot")
    near = possible(percent, F.col("n"), F.col("common"), F.col("pivot.n"), F.col("pivot.common"))
    both = apart.join(apart.groupBy("key").agg(pivot), "key").filter((F.col("root") != F.col("pivot.root")) & near)
    return both.select(F.least("set", "pivot.set").alias("a"), F.greatest("set", "pivot.set").alias("b")).distinct()


def _tokens_of(docs: DataFrame, described: DataFrame, candidates: DataFrame) -> DataFrame:
    """Tokens of the candidate sets, each taken from one of its documents. A list of
    up to a million documents is broadcast to find their texts; a longer one meets
    them in a shuffle."""
    chosen = staged(
        described.join(candidates.select("set"), "set", "left_semi")
        .groupBy("set").agg(F.min(F.struct("id", "text_key")).alias("doc"))
        .select("doc.id", "doc.text_key")
    )
    few = chosen.count() <= BROADCAST_SETS
    own = docs["id"].eqNullSafe(chosen["id"]) & (docs["text_key"] == chosen["text_key"])
    texts = docs.join(F.broadcast(chosen) if few else chosen.hint("shuffle_hash"), own, "left_semi").select("body")
    found = texts.mapInArrow(_with_tokens, "set long, n long, tokens binary, marks array<long>")
    return found.dropDuplicates(["set"]).join(candidates, "set")


def _crossed(apart: DataFrame, marked: DataFrame, percent: int) -> DataFrame:
    """Pairs of a key from different components that can link.

    A pair counts at the key of its first common token, in the order of prefixes, and is
    left out at later keys as far as places tell: from its first common token on, sets
    that link have all they share, so neither may have less than that left."""
    rest = apart.join(marked, "set")
    x, y = (rest.select("key", *[F.col(c).alias(f"{c}_{side}") for c in rest.columns if c != "key"]) for side in "ab")
    near = possible(percent, F.col("n_a"), F.col("common_a"), F.col("n_b"), F.col("common_b"))
    other = (F.col("root_a") != F.col("root_b")) & (F.col("set_a") < F.col("set_b")) & ~(F.col("few_a") & F.col("few_b"))
    left = (100 + percent) * F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = left >= percent * (F.col("n_a") + F.col("n_b"))
    pairs = x.join(y, "key").filter(other & near & enough & alike(percent))
    return pairs.select(F.col("set_a").alias("a"), F.col("set_b").alias("b")).distinct()


def alike(percent: int) -> Column:
    """Whether the marks of two sets leave room for a link: of the tokens of sets that
    link at most (100 - percent) of (100 + percent) are in one of them only, and the
    marks differ in no more bits than that."""
    apart = [F.bit_count(F.col("marks_a")[i].bitwiseXOR(F.col("marks_b")[i])) for i in range(MARKS)]
    return (100 + percent) * sum(apart[1:], apart[0]) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))


def cluster(
    docs: DataFrame,
    percent: int = PERCENT,
    text: str = "text",
    id: str = "doc_id",
    keep: list[str] | None = None,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Size of every document's set of distinct five-word shingles, and the component
    it belongs to when documents link whose sets have a Jaccard similarity of at
    least ``percent``; the component is named by its smallest id.

    Copies of a set count as one throughout. Sets without enough tokens that any
    other set has are left aside, which are most; see ``index_keys`` for the keys of
    the others. No pair is lost: candidates are compared by all their tokens, of 64
    bits each. Sets are told apart by 64-bit fingerprints (a false copy is to be
    expected from about four billion different sets on).

    A ``percent`` below 20 is an error. Up to 50 sets that link may share a single token,
    and frequent tokens are keys themselves, which takes more comparisons.

    Null, empty and blank texts have size 0 and are a component each; with fewer
    than five words the whole text is the one shingle. Null ids are ignored in the
    choice of a name, so the component of rows with null ids only is null.
    Repeated rows belong together. An empty table gives no rows."""
    component = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("id"))
    out = rooted(docs, percent, text, id, keep, frequent).select(
        "row", F.col("n").alias("n_shingles"), component.alias("component_id")
    )
    return unpacked(out, "row", OUTPUTS)


def rooted(
    docs: DataFrame, percent: int, text: str, id: str, keep: list[str] | None, frequent: int = FREQUENT
) -> DataFrame:
    """What ``cluster`` works with: the kept columns as ``row``, the id, a hash of the
    text (``print``), the size ``n`` of its set, and for sets with tokens the ``root`` set
    of the component and its ``name``, the smallest id."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100, not {percent}")
    body = F.col(f"`{text}`").cast("string")
    small_batches(docs.sparkSession)
    rows = docs.select(
        packed(docs, keep).alias("row"),
        F.col(f"`{id}`").cast("long").alias("id"),
        F.xxhash64(body).alias("text_key"),
        body.alias("body"),
    )
    schema = rows.drop("body").schema.add("n", "long").add("set", "long")
    described = staged(rows.mapInArrow(_described, schema))
    roots = set_components(rows.drop("row"), described.drop("row"), percent, frequent)
    sets = described.filter("n > 0").groupBy("set").agg(F.min("id").alias("least"))
    hung = sets.join(roots.select(F.col("node").alias("set"), "root"), "set", "left")
    hung = hung.withColumn("root", F.coalesce("root", "set"))
    names = hung.groupBy("root").agg(F.min("least").alias("name"))
    named = hung.join(names, "root").select("set", "root", "name")
    return described.join(named, "set", "left").select(
        "row", "id", F.col("text_key").alias("print"), "n", "root", "name"
    )
