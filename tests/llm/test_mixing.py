import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tickloom.llm import mixing
from tests.llm.odd import ROWS, nothing, odd


def test_targets_share_all_words_and_stop_at_three_times():
    assert mixing.targets([100, 100, 100], [1, 1, 2]) == [75, 75, 150]
    got = mixing.targets([10, 100, 0], [5, 2, 1])
    assert got == [30, 80, 0] and sum(got) == 110
    assert mixing.targets([], []) == []
    assert mixing.targets([0], [5]) == [0]


def test_schedule_keeps_quotas_and_low_discrepancy(spark):
    quotas = [500, 200, 100, 7, 0]
    rows = sorted(mixing.schedule(spark, quotas).collect())
    assert [r["slot"] for r in rows] == sorted({r["slot"] for r in rows})
    counts, total = Counter(), sum(quotas)
    for n, r in enumerate(rows, 1):
        assert r["rank"] == counts[r["src"]]
        counts[r["src"]] += 1
        if n <= 0.95 * total:
            assert all(abs(counts[s] - n * q / total) < 8 for s, q in enumerate(quotas))
    assert [counts[s] for s in range(5)] == quotas


def brute_taken(lined, block):
    """Words of each place in the repeated line that fall below the plan."""
    want = {}
    for r in lined:
        low, size, length, plan = r["start"], r["size"], r["source_size"], r["planned"]
        want[r["src"], low, size] = sum(
            max(0, min(low + size + k * length, plan) - (low + k * length)) for k in range(4)
        ) if length else 0
    return want


def test_odd_rows(spark):
    docs = odd(spark)
    for block in (7, 2048):
        pieces, lined = mixing.mix(docs, block_words=block)
        rows, parts = lined.collect(), pieces.collect()
        assert len(rows) == len(ROWS)
        got = {(r["src"], r["start"], r["size"]): r["taken"] for r in mixing.taken(pieces, lined).collect()}
        assert got == brute_taken(rows, block)
        slots = defaultdict(int)
        for p in parts:
            slots[p["slot"]] += p["words"]
        assert sum(w != block for w in slots.values()) <= len({r["src"] for r in rows})
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["row"]["text"] or ""))
        assert got[r["src"], r["start"], r["size"]] <= 3 * r["size"]
    assert sorted({(r["src"], r["row"]["source"]) for r in rows}) == [(0, "a"), (1, "b"), (2, "c"), (3, "zz"), (4, None)]
    again = mixing.mix(docs, block_words=2048)[0].collect()
    assert sorted(again) == sorted(parts)


def test_nothing_and_no_words(spark):
    pieces, lined = mixing.mix(nothing(spark))
    assert pieces.count() == 0 and mixing.taken(pieces, lined).count() == 0
    pieces, lined = mixing.mix(odd(spark).filter("doc_id in (3, 4)"))
    assert mixing.taken(pieces, lined).agg(F.sum("taken"), F.count("*")).first() == (0, 2)
