import random
import zlib
from collections import defaultdict

from tickloom.llm import sharding
from tests.llm.odd import ROWS, nothing, odd


def brute_capacity(sizes, shards):
    best = {0: {0: 0}}
    for k in range(1, shards + 1):
        best[k] = {}
        for end in range(len(sizes) + 1):
            ways = [max(best[k - 1][a], sum(sizes[a:end])) for a in best[k - 1] if a <= end]
            if ways:
                best[k][end] = min(ways)
    return best[shards][len(sizes)]


def test_capacity_is_minimax_and_cuts_keep_it():
    draw = random.Random(1)
    for _ in range(150):
        sizes = [draw.randint(1, 30) for _ in range(draw.randint(1, 14))]
        shards = draw.randint(1, 6)
        want = brute_capacity(sizes, shards)
        assert sharding.smallest_capacity(sizes, shards) == want
        cuts = [0, *sharding.even_cuts(sizes, shards), len(sizes)]
        assert cuts == sorted(cuts) and len(cuts) == shards + 1
        assert max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])) <= want


def test_one_group_above_all_others_leaves_the_rest_even():
    sizes = [1] * 50 + [1000] + [1] * 50
    cuts = [0, *sharding.even_cuts(sizes, 5), 101]
    assert max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])) <= 1050


def test_odd_rows(spark):
    out = sharding.shard(odd(spark), shards=4).collect()
    assert len(out) == len(ROWS)
    of_text, slots = defaultdict(set), defaultdict(list)
    for r in out:
        raw = None if r["text"] is None else r["text"].encode()
        assert r["size"] == len(raw or b"") + 16
        assert r["text_crc32"] == (None if raw is None else zlib.crc32(raw))
        of_text[r["text"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        assert (r["row"], r["body"], r["cell"], r["tie"]) == ("r", "b", 2, "t")
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(odd(spark), shards=4).collect() == out
    assert sharding.shard(nothing(spark)).count() == 0
