import random
import re

from tickloom.llm import decontam
from tests.llm.odd import ROWS, nothing, odd


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, n):
    own, hit, names = words(text), set(), set()
    for name, body in items:
        want = words(body)
        size = min(n, len(want))
        grams = {tuple(want[i : i + size]) for i in range(len(want) - size + 1)} if want else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                names.add("" if name is None else str(name))
    return len(own), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(own)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(10, "alpha BETA, gamma-delta"), (9, "two three"), (9, "two three"), (2, None), (3, ""), (None, "w1 w2 w3 w4")]
ITEMS += [(11, " ".join(f"w{i}" for i in range(30))), (12, "é" * 5000)]


def test_odd_rows(spark):
    for options in ({}, {"n": 3}, {"n": 2, "block_windows": 2}):
        n = options.get("n", 13)
        out = decontam.mark(odd(spark), bench(spark, ITEMS), **options).collect()
        assert len(out) == len(ROWS)
        for r in out:
            got = r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]
            assert got == brute(r["text"], ITEMS, n)
            assert (r["row"], r["body"], r["set"]) == ("r", "b", 6)
    assert decontam.mark(nothing(spark), bench(spark, ITEMS)).count() == 0
    clean = decontam.mark(odd(spark), bench(spark, [])).collect()
    assert len(clean) == len(ROWS) and not any(r["contaminated"] or r["n_hit"] for r in clean)


def test_random_texts(spark):
    draw = random.Random(6)
    text = lambda k: " ".join(draw.choice("abc") for _ in range(k))
    items = [(i, text(draw.randint(1, 20))) for i in range(25)]
    rows = [(i, text(draw.randint(0, 60)), "en", "a") for i in range(120)]
    for r in decontam.mark(odd(spark, rows), bench(spark, items), n=6, block_windows=40).collect():
        assert (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) == brute(r["text"], items, 6)


def test_removal(spark):
    rows = [(1, "keep This, cut me PLEASE now; and go on", "en", "a"), (2, "all clean here", "en", "a"), (3, None, None, None)]
    rows += [(4, "cut me please", "en", "a")]
    items = bench(spark, [(1, "cut me please")])
    docs = odd(spark, rows)
    kept = decontam.without_documents(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    texts = {r["doc_id"]: r["text"] for r in decontam.without_spans(docs, items).collect()}
    assert texts == {1: "keep This,  now; and go on", 2: "all clean here", 3: None, 4: ""}
