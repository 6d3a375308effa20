import random

import corpus_pipeline
from tests.llm.odd import odd
from tests.llm.test_decontam import brute as contamination
from tests.llm.test_jaccard import brute as components

COLUMNS = ["doc_id", "text", "lang", "source"]


def test_stages(spark, tmp_path):
    draw = random.Random(13)
    english = "the of and that with from this which have were".split()
    french = "les des une dans pour avec être très à où".split()
    rows = []
    for i in range(120):
        words = [draw.choice(french if i % 3 == 0 else english) + draw.choice(["", "x", "y", "z"]) for _ in range(60)]
        rows.append((i, " ".join(words), "fr" if i % 3 == 0 else "en", f"s{i % 4}"))
    rows += [(200 + i, rows[i][1] + " more", rows[i][2], "s9") for i in range(10)]
    rows += [(300, None, "en", "s1"), (301, "123 456 !", "en", "s1"), (302, "", None, None)]
    items = [(1, " ".join(rows[5][1].split()[10:40])), (2, "nowhere to be found in any of them at all")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = odd(spark, rows).select(*COLUMNS)
    stages = dict(corpus_pipeline.STAGES)
    sf = str(tmp_path)

    clear = stages["language ID"](spark, docs, sf)
    kept = sorted(tuple(r) for r in clear.collect())
    assert clear.columns == COLUMNS and not {300, 301, 302} & {r[0] for r in kept}
    assert len(kept) >= 128

    fresh = spark.createDataFrame(kept, "doc_id long, text string, lang string, source string")
    single = stages["n-gram Jaccard join"](spark, fresh, sf)
    names = {i for i, _, c in components(kept) if i == c}
    kept = sorted(tuple(r) for r in single.collect())
    assert single.columns == COLUMNS and {r[0] for r in kept} == names and len(kept) == len(names)

    fresh = spark.createDataFrame(kept, "doc_id long, text string, lang string, source string")
    clean = stages["benchmark decontamination"](spark, fresh, sf)
    want = {r[0] for r in kept if not contamination(r[1], items, 13)[3]}
    kept = sorted(tuple(r) for r in clean.collect())
    assert clean.columns == COLUMNS and {r[0] for r in kept} == want and 5 not in want

    fresh = spark.createDataFrame(kept, "doc_id long, text string, lang string, source string")
    mixed = stages["mixing sources to target weights"](spark, fresh, sf)
    rows = sorted(tuple(r) for r in mixed.collect())
    assert mixed.columns == COLUMNS and {r[0] for r in rows} <= {r[0] for r in kept}
    sizes = {s: sum(len(r[1].split()) for r in kept if r[3] == s) for s in {r[3] for r in kept}}
    names = sorted(sizes)
    goals = corpus_pipeline.mixing.targets([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    for name, goal in zip(names, goals, strict=True):
        assert abs(sum(len(r[1].split()) for r in rows if r[3] == name) - goal) <= 130

    fresh = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    shards = stages["sharding"](spark, fresh, sf).collect()
    assert sorted(r["doc_id"] for r in shards) == sorted(r[0] for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    none = odd(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name


def test_odd_rows_pass_every_stage(spark, tmp_path):
    spark.createDataFrame([(1, "two three")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert out.count() > 0 or name == "language ID", name  # too few texts to learn from
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_near_copies_by_row(spark):
    """Ids that are repeated or missing lose no text that resembles no other."""
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    x, y, z = (" ".join(f"{k}{i}" for i in range(40)) for k in "xyz")
    cases = [
        ([(1, x), (1, y), (0, y)], {(1, x), (0, y)}),
        ([(1, x), (1, y), (2, y)], {(1, x), (1, y)}),
        ([(1, x), (1, x), (None, x + " more"), (3, z)], {(1, x), (3, z)}),
        ([(None, x), (None, x), (None, y), (None, y + " more"), (4, None)], None),
        ([(5, ""), (5, ""), (5, " ")], {(5, ""), (5, " ")}),
    ]
    for rows, want in cases:
        docs = odd(spark, [(*r, "en", "a") for r in rows])
        got = [(r["doc_id"], r["text"]) for r in stage(spark, docs, "").collect()]
        if want is None:
            assert len(got) == 3 and (None, x) in got and (4, None) in got and any(t and t.startswith(y) for _, t in got)
        else:
            assert set(got) == want and len(got) == len(want) + (rows[0][1] == "")


def test_mixing_by_row(spark):
    stage = dict(corpus_pipeline.STAGES)["mixing sources to target weights"]
    rows = [(None, f"{'w ' * (5 * i + 1)}{i}", "en", "ab"[i % 2]) for i in range(60)]
    got = [r["text"] for r in stage(spark, odd(spark, rows), "").collect()]
    times = {t: got.count(t) for _, t, _, _ in rows}
    assert set(got) <= set(times) and max(times.values()) <= 3 and len(set(times.values())) > 1
