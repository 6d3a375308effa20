import random
import re

import numpy as np
import pyarrow as pa

from tickloom.llm import substrings
from tests.llm.odd import ROWS, nothing, odd


def key(doc):
    return (doc[0] is None, doc[0] or 0)


def brute(docs, n):
    """Removed words by document; documents alike in id and text are one, of others
    with one id the order is not known here, so ids with several texts do not occur."""
    worded = {}
    for doc in sorted({d[:2] for d in docs}, key=key):
        worded[doc] = re.findall(r"[^\x20\x09-\x0D]+", doc[1] or "")
    seen, gone = set(), {doc: set() for doc in worded}
    for doc, words in worded.items():
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            if gram in seen:
                gone[doc] |= set(range(i, i + n))
            seen.add(gram)
    return {
        doc: (len(w), len(gone[doc]), sorted(gone[doc]), " ".join(x for i, x in enumerate(w) if i not in gone[doc]))
        for doc, w in worded.items()
    }


def check(spark, docs, n):
    out = substrings.remove(odd(spark, docs), n)
    text = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert out.count() == len(docs)
    for doc, (count, removed, places, kept) in brute(docs, n).items():
        row = text[doc]
        assert (row["n_words"], row["n_removed"], row["kept"]) == (count, removed, kept)
        assert [p for a, b in row["ranges"] for p in range(a, b + 1)] == places


def test_covers_have_all_differences():
    for period, cover in substrings.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_odd_rows(spark):
    rows = [r for r in ROWS if r[:2] != (None, None)] + [(None, None, None, None)]
    for n in (20, 3, 1):
        check(spark, rows, n)
    out = substrings.remove(odd(spark), 3)
    assert out.columns[-4:] == substrings.OUTPUTS and out.first()["row"] == "r"
    assert substrings.remove(nothing(spark)).count() == 0


def test_random_texts(spark, monkeypatch):
    draw = random.Random(8)

    def text(k):
        return "".join(draw.choice("aAb") + draw.choice([" ", "\t", "\n "]) for _ in range(k))

    passages = [text(draw.randint(3, 30)) for _ in range(6)]
    docs = [
        (i, text(draw.randint(0, 15)) + draw.choice(passages) + text(draw.randint(0, 15)), "en", "a") for i in range(90)
    ]
    for packet, part in ((1 << 20, 8 << 20), (40, 300)):
        monkeypatch.setattr(substrings, "PACKET", packet)
        monkeypatch.setattr(substrings, "PART_BYTES", part)
        for n in (5, 8, 20):
            check(spark, docs, n)


def test_long_copies_at_every_offset(spark):
    draw = random.Random(9)
    passage = [f"p{i}" for i in range(20)]
    docs = []
    for i in range(40):
        before, after = ([f"d{i}.{draw.random()}" for _ in range(k)] for k in (i, 5))
        docs.append((i, " ".join(before + passage + after), "en", "a"))
    docs.append((50, " ".join([*passage, *passage]), "en", "a"))
    check(spark, docs, 20)


def test_same_id_and_several_texts(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = [(1, words, "en", "a"), (1, words + " more", "en", "a"), (1, words, "en", "b"), (None, words, "en", "b")]
    rows = substrings.remove(odd(spark, docs)).collect()
    kept = {(r["doc_id"], r["text"]): r["n_removed"] for r in rows}
    assert kept[None, words] == 30 and sorted([kept[1, words], kept[1, words + " more"]]) == [0, 30]


def test_texts_of_kept_words():
    bodies = pa.array(["  a  bb\tc ", None, "", "é x", "one"])
    words = substrings.bytewords.words_of(bodies, substrings.WORDS)
    kept = np.array([True, False, True, False, True, True])
    assert substrings._texts(bodies, words, kept).to_pylist() == ["a c", "", "", "x", "one"]
