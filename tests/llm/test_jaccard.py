import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from tickloom.llm import bytewords, components, jaccard
from tests.llm.odd import ROWS, nothing, odd


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [brute_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
            root[top(j)] = top(i)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def found(docs, **options):
    rows = jaccard.cluster(docs, keep=["doc_id"], **options).collect()
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows], key=str)


def test_odd_rows(spark):
    assert found(odd(spark)) == brute(ROWS)
    assert jaccard.cluster(odd(spark)).columns[:4] == ["doc_id", "text", "lang", "source"]
    assert found(nothing(spark)) == []


def changed(draw, words, share):
    return " ".join(f"n{draw.random():.6f}" if draw.random() < share else w for w in words)


def test_near_copies_and_passages(spark):
    draw = random.Random(3)
    rows = []
    passage = [f"p{i}" for i in range(40)]
    for group in range(12):
        words = [f"g{group}x{draw.randint(0, 400)}" for _ in range(draw.choice([6, 8, 12, 40, 150]))]
        for _ in range(draw.choice([1, 2, 5, 40])):
            rows.append((len(rows), changed(draw, words, draw.choice([0, 0.01, 0.04, 0.08])), "en", "a"))
    for _ in range(60):  # a passage makes up a large part, the rest is the document's own
        own = [f"o{draw.random():.6f}" for _ in range(draw.choice([5, 12, 20]))]
        rows.append((len(rows), " ".join(passage + own), "en", "a"))
    draw.shuffle(rows)
    docs = odd(spark, rows)
    want = brute(rows)
    assert found(docs) == want
    assert found(docs, frequent=2) == want
    assert found(docs, frequent=1000) == want


def test_lower_similarities(spark):
    draw = random.Random(5)
    rows, sets = [], {}
    for pair in range(300):  # two documents begin with the same words
        both = [f"w{pair}x{k}" for k in range(draw.randint(14, 34))]
        for side in "ab":
            own = [f"{side}{pair}x{k}" for k in range(draw.randint(2, len(both)))]
            rows.append((len(rows), " ".join(both + own), "en", "a"))
            sets[len(sets)] = brute_set(rows[-1][1])
    docs = odd(spark, rows)
    for percent in (20, 50, 60):
        want = []
        for i in range(0, len(rows), 2):
            both, either = len(sets[i] & sets[i + 1]), len(sets[i] | sets[i + 1])
            other = i if 100 * both >= percent * either else i + 1
            want += [(i, len(sets[i]), i), (i + 1, len(sets[i + 1]), other)]
        assert 20 < sum(c < i for i, _, c in want) <= 300
        assert found(docs, percent=percent, frequent=2) == sorted(want, key=str)


def test_similarities_out_of_range(spark):
    for percent in (0, 19, 101):
        with pytest.raises(ValueError, match="percent"):
            jaccard.cluster(odd(spark), percent=percent)


def linked_pair(draw, low, high):
    n = draw.randint(low, high)
    a = set(draw.sample(range(1 << 40), n))
    b = set(a)
    while True:
        c = set(b)
        if draw.random() < 0.5 and len(c) > 1:
            c.remove(draw.choice(sorted(c)))
        else:
            c.add(draw.randrange(1 << 40))
        if 100 * len(a & c) < 75 * len(a | c):
            return np.array(sorted(a), np.uint64), np.array(sorted(b), np.uint64)
        b = c


def test_linked_sets_share_two_tokens_of_their_prefixes(spark):
    draw = random.Random(5)
    pairs = [linked_pair(draw, 2, 120) for _ in range(300)]
    sizes = sorted({len(x) for pair in pairs for x in pair})
    frame = spark.createDataFrame([(n,) for n in sizes], "n long")
    length = {r[0]: r[1] for r in frame.select("n", jaccard.prefix_length(F.col("n"), 75)).collect()}
    for a, b in pairs:
        heads = [set(x[: length[len(x)]]) for x in (a, b)]
        assert len(heads[0] & heads[1]) >= 2


def test_marks_differ_in_no_more_bits_than_sets_in_tokens():
    draw = random.Random(7)
    for low, high in ((2, 30), (30, 400), (2000, 5000)):
        for _ in range(20):
            sets = linked_pair(draw, low, high)
            row = np.repeat([0, 1], [len(x) for x in sets])
            value = np.concatenate([bytewords.scrambled(x) for x in sets])
            a, b = (np.array(m, np.int64).view(np.uint64) for m in jaccard.marks(row, value, 2).to_pylist())
            differing = sum(int(x).bit_count() for x in a ^ b)
            assert differing <= len(set(sets[0]) ^ set(sets[1])) <= (len(sets[0]) + len(sets[1])) / 7


def test_sets_of_one_passage_meet_in_few_keys(spark):
    """Sets of a common passage and enough of their own tokens are not compared, though
    every one of them shares most of its tokens with all others."""
    draw = random.Random(8)
    passage = [f"p{i}" for i in range(74)]
    rows = [(i, " ".join(passage + [f"o{draw.random():.8f}" for _ in range(30)]), "en", "a") for i in range(300)]
    rows += [(300 + i, rows[i][1] + " more", "en", "a") for i in range(150)]
    docs = odd(spark, rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"), F.col("text").alias("body"))
    schema = "row struct<x:long>, id long, text_key long, n long, set long"
    described = docs.select(F.struct(F.col("id").alias("x")).alias("row"), "*").mapInArrow(jaccard._described, schema)
    sets = described.select("set", F.col("n").alias("common"))
    tokens = jaccard._tokens_of(docs, described, sets)
    met = jaccard._met(jaccard.index_keys(jaccard.prefixes(tokens, 75), 75, 16))
    sizes = [r["count"] for r in met.groupBy("key").count().collect()]
    assert sum(n * (n - 1) // 2 for n in sizes) < 450 * 20
    assert found(odd(spark, rows)) == brute(rows)


@pytest.mark.parametrize("few", [0, 1, 3, 100])
def test_sets_of_many_frequent_tokens(spark, monkeypatch, few):
    monkeypatch.setattr(jaccard, "FEW", few)
    draw = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, changed(draw, base, draw.choice([0.005, 0.02, 0.03])), "en", "a") for i in range(120)]
    rows += [(200 + i, changed(draw, base[: draw.randint(30, 60)], 0.01), "en", "a") for i in range(60)]
    for frequent, turns in ((2, 0), (4, 1), (16, 3)):
        monkeypatch.setattr(jaccard, "TURNS", turns)
        assert found(odd(spark, rows), frequent=frequent) == brute(rows)


def test_texts_of_all_lengths_have_the_brute_force_sets():
    texts = ["", None, "a", "A b", "a b c d", "a b c d e", "a b c d e f a b c d e", "x " * 40]
    row, _ = jaccard.shingle_sets(pa.array(texts))
    assert np.bincount(row, minlength=len(texts)).tolist() == [len(brute_set(t)) for t in texts]


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(7, 7), (201, 200)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(frame).collect()}
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)} | {201: 200, 202: 200}
    assert got == want
    assert components.components(frame.limit(0)).count() == 0


def test_tasks_hold_few_tokens_and_small_batches(spark, monkeypatch):
    """Peak of numpy's memory while five million tokens are sent: 185 MB before."""
    import tracemalloc
    from types import SimpleNamespace

    context = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(jaccard, "TaskContext", context)

    def batches():
        for at in range(10):
            texts = [" ".join(map(str, range(k * 5000, k * 5000 + 5000))) for k in range(at * 100, at * 100 + 100)]
            yield pa.RecordBatch.from_arrays([pa.array(texts)], names=["body"])

    tracemalloc.start()
    number = sum(r.num_rows for r in jaccard._sent_classes(2)(batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert number > 4 and peak < 110e6

    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 200).alias("text"))
    jaccard.rooted(docs, 75, "text", "doc_id", ["doc_id"])
    sizes = docs.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in bs), "n long")
    assert max(r.n for r in sizes.collect()) < 5e6
