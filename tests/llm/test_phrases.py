import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import phrases
from tickloom.llm.doublearray import Trie, digits_of
from tests.llm.odd import ROWS, nothing, odd


def brute(rows, longest=3, least=10, first=2000, percent=50):
    counts, totals = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = []
    for lang in totals:
        own = {g: a for (at, g), a in found.items() if at == lang}
        rows_ = []
        for g, a in own.items():
            inside = (
                100 * b >= percent * a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
                for h, b in own.items()
                if len(h) > len(g)
            )
            if any(inside):
                continue
            cuts = []
            for k in range(1, len(g)):
                left, right = counts[lang, g[:k]], counts[lang, g[k:]]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            rows_.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in phrases.mine(df, **options).collect())


def texts(seed, rows, words="a b c d E e é".split()):
    draw = random.Random(seed)

    def text():
        return "".join(draw.choice(words) + draw.choice([" ", "  ", "\t", ". ", "\n"]) for _ in range(draw.randint(0, 60)))

    return [(i, text(), draw.choice(["en", "fr", None, "und"]), "a") for i in range(rows)]


def test_odd_rows(spark):
    for options in ({"least": 1}, {"least": 2, "longest": 4}, {"least": 2, "first": 3}):
        assert found(odd(spark), **options) == brute(ROWS, **options)
    assert found(nothing(spark)) == []
    assert found(odd(spark, [(1, "a b", "en", "a")])) == []


def test_random_texts(spark):
    rows = texts(1, 150)
    assert found(odd(spark, rows)) == brute(rows)
    assert found(odd(spark, rows), longest=2, least=4, first=7) == brute(rows, 2, 4, 7)
    assert found(odd(spark, rows), longest=4, least=3, covered_percent=80) == brute(rows, 4, 3, percent=80)


def test_many_shards_blocks_and_chunks(spark, monkeypatch):
    rows = texts(2, 120) + [(999, "a b c d " * 400, "en", "a")]
    for name, value in (("TRIE_PHRASES", 9), ("BLOCK_BYTES", 40), ("CHUNK", 5), ("KEYS", 50), ("SLICE_BYTES", 700)):
        monkeypatch.setattr(phrases, name, value)
    assert found(odd(spark, rows)) == brute(rows)


@pytest.mark.parametrize(("a", "left", "right"), [(10**12, 10**12, 10**12), (999_999_999_989, 10**12, 999_999_999_999), (10, 11, 12)])
def test_scores_beyond_64_bits(spark, a, left, right):
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    score = row.select(phrases.worst_score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert score == 1_000_000 * a * a // (left * right)


def test_trie_finds_all_phrases():
    draw = np.random.default_rng(3)
    for count, words, largest in ((1, 2, 5), (300, 2, 30), (20_000, 3, 90_000), (3000, 1, 70_000)):
        numbers = ((largest - 1) * draw.random((count, words)) ** 3).astype(np.int64) + 1
        rows = np.unique(numbers, axis=0)
        trie = Trie.of(rows, digits_of(largest))
        text = np.concatenate([rows.ravel(), draw.integers(1, largest + 1, 2000), np.zeros(words, np.int64)]).astype(np.int32)
        start = np.arange(len(text) - words + 1)
        at, entry = trie.walk(text, start)
        known = {tuple(r): k for k, r in enumerate(rows.tolist())}
        grams = [tuple(text[i : i + words].tolist()) for i in start]
        assert list(zip(at.tolist(), entry.tolist(), strict=True)) == [(i, known[g]) for i, g in enumerate(grams) if g in known]
