"""The columns of queries that have no SQL, against loops over a small table."""

import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from tests.llm.test_pii import brute as plain_spans
from tests.llm.test_sharding import brute_capacity
from tickloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def documents():
    table = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return {i: (t, s) for i, t, s in zip(table["doc_id"], table["text"], table["source"], strict=True)}


def found(spark, name):
    rows = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
    assert {r["doc_id"] for r in rows} == set(documents()) and len(rows) == len(documents())
    return rows


def shares(sizes):
    """Targets: all words by weight, three times a source's at most, the rest anew."""
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    goal, free, left = {}, set(sizes), Fraction(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        for s in above or free:
            goal[s] = Fraction(3 * sizes[s]) if above else left * weight[s] / total
        left -= sum(goal[s] for s in above)
        free -= above or free
    return goal


def test_op1_columns(spark):
    docs, rows = documents(), found(spark, "op1_mixing")
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (t, _) in docs.items()}
    of_source, taken = defaultdict(int), defaultdict(int)
    for i, (_, s) in docs.items():
        of_source[s] += size[i]
    goal = shares(of_source)
    for r in rows:
        source = docs[r["doc_id"]][1]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], of_source[source])
        assert abs(r["target"] - float(goal[source])) < 1e-6 * max(1, r["target"])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)


def test_op5_columns(spark):
    docs, rows = documents(), found(spark, "op5_sharding")
    groups, shards = defaultdict(set), defaultdict(list)
    total = defaultdict(int)
    for r in rows:
        text = docs[r["doc_id"]][0]
        raw = None if text is None else text.encode()
        assert r["size"] == len(raw or b"") + 16
        assert r["text_crc32"] == (None if raw is None else zlib.crc32(raw))
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 40
        groups[text].add(r["shard"])
        shards[r["shard"]].append(r["slot"])
        total[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    size = defaultdict(int)
    for r in rows:
        size[docs[r["doc_id"]][0]] += r["size"]
    assert max(total.values()) <= 2 * max(max(size.values()), brute_capacity(sorted(size.values()), 40))


def test_op7_columns(spark):
    docs, rows = documents(), found(spark, "op7_tokens")
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    start = 0
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = [*tokenizer.encode(docs[r["doc_id"]][0] or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_op8_columns(spark):
    docs = documents()
    kinds = ["email", "ip", "card", "phone"]
    for r in found(spark, "op8_pii"):
        spans = sorted(plain_spans(docs[r["doc_id"]][0] or ""), key=lambda s: (kinds.index(s[0]), s[1]))
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in spans) for k in kinds]
        every = [s for s in r["spans"].split(",") if s]
        assert set(listed.split(",")) - {""} <= set(every)
        places = [(kinds.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in every)]
        assert places == sorted(places) and all(a < b for _, a, b in places)
