"""Documents with every oddity an operator has to bear."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, row string, body string, size string, key long, "
    "score string, cell int, src int, start string, part int, position int, tie string, shard string, set long"
)
FILLER = ("r", "b", "s", 1, "x", 2, 3, "st", 4, 5, "t", "sh", 6)
LONG = " ".join(f"w{i % 977}" for i in range(120_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
    (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
    (2, "Alpha  beta\tgamma\ndelta epsilon ZETA", "en", "b"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \t\n ", "fr", None),
    (None, "one two three", "de", "c"),
    (None, None, None, None),
    (6, "one two three", "de", "c"),
    (7, LONG, "en", "a"),
    (8, "é" * 5000, None, "c"),
    (9, "!!! ... 123", "fr", "zz"),
]


def odd(spark, rows=ROWS):
    return spark.createDataFrame([r + FILLER for r in rows], SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
