import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import rangecoder, tokens
from tests.llm.odd import ROWS, nothing, odd

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(text):
    return tokens.tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + [0]


def test_blocks_round_trip():
    draw = np.random.default_rng(8)
    blocks = [draw.integers(0, 50_257, 700), np.zeros(300), draw.integers(0, 5, 999), [50_256], [], np.arange(50_000)]
    blocks = [np.asarray(b, np.uint32) for b in blocks]
    coded = tokens.sealed_blocks(blocks, 50_257)
    back = tokens.opened_blocks(coded, 50_257)
    assert all(a.tolist() == b.tolist() for a, b in zip(blocks, back, strict=True))
    alone = tokens.opened_blocks([coded[2]], 50_257)
    assert alone[0].tolist() == blocks[2].tolist()
    assert len(coded[1]) < 100
    assert rangecoder.encode([], 50_257) == [] and tokens.opened_blocks([], 50_257) == []


def test_damage_is_noticed():
    coded = tokens.sealed_blocks([np.arange(100, dtype=np.uint32)], 50_257)[0]
    for bad in (coded[:-1], coded[:-1] + bytes([coded[-1] ^ 1]), b"XXXX" + coded[4:]):
        with pytest.raises(ValueError, match="damaged"):
            tokens.opened_blocks([bad], 50_257)


def test_pieces_give_the_ids_of_whole_texts():
    draw = random.Random(9)
    parts = ["a", "The", "don't", "é", "ß", " ", " ", "  ", "\n", "\t", " ", " ", "12", "!!", "<|endoftext|>", "'s", "日本"]
    pieces = tokens.Pieces(PATH)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 20))) for _ in range(3000)]
    for text, ids in zip(texts, pieces.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole(text), repr(text)


def brute(rows):
    start, out = 0, []
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole(text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_odd_rows(spark, tmp_path):
    for block_ids in (50, 4096):
        tokens.write(odd(spark), str(tmp_path / "t"), PATH, block_ids=block_ids)
        found = tokens.read(spark, str(tmp_path / "t"))
        got = sorted((tuple(r) for r in found.collect()), key=lambda r: r[1])
        want = brute(ROWS)
        # rows without an id may stand in any order among themselves
        assert sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
        assert [r for r in got if r[0] is not None] == [r for r in want if r[0] is not None]
        assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))


def test_nothing(spark, tmp_path):
    tokens.write(nothing(spark), str(tmp_path / "t"), PATH)
    assert tokens.read(spark, str(tmp_path / "t")).count() == 0


def test_damaged_files_are_an_error(spark, tmp_path):
    tokens.write(odd(spark).filter("doc_id = 1"), str(tmp_path / "t"), PATH)
    files = spark.read.schema(tokens.FILE).parquet(str(tmp_path / "t"))
    cut = files.withColumn("data", F.expr("CASE WHEN block >= 0 THEN substr(data, 1, length(data) - 1) ELSE data END"))
    cut.write.parquet(str(tmp_path / "cut"))
    with pytest.raises(Exception, match="damaged"):
        tokens.read(spark, str(tmp_path / "cut")).collect()


def test_few_steps_and_frequencies(monkeypatch):
    steps = []
    look = rangecoder.Followers.look
    monkeypatch.setattr(rangecoder.Followers, "look", lambda self, n: (steps.append(n), look(self, n))[1])
    draw = np.random.default_rng(4)
    chance = 1 / np.arange(1, 301)
    blocks = [draw.choice(draw.permutation(50_257)[:300], 4096, p=chance / chance.sum()).astype(np.uint32) for _ in range(20)]
    coded = rangecoder.encode([*blocks, blocks[0][:77]], 50_257)
    back = rangecoder.decode(coded, [4096] * 20 + [77], 50_257)
    assert all(a.tolist() == b.tolist() for a, b in zip([*blocks, blocks[0][:77]], back, strict=True))
    # a step codes several ids of a block
    assert len(steps) == 2 * 4096 // rangecoder.LANES and 2 * 4096 // len(steps) >= 8
    # ids drawn by themselves take little more than their chances (6.2 bits) and the first of each
    assert max(map(len, coded)) < 4096 * 1.15


def test_blocks_are_decoded_once(spark, tmp_path):
    tokens.write(odd(spark), str(tmp_path / "t"), PATH, block_ids=50)
    plan = tokens.read(spark, str(tmp_path / "t"))._jdf.queryExecution().optimizedPlan().toString()
    assert sum("MapInArrow" in line and "ids_crc32" in line for line in plan.splitlines()) == 1


def test_cuts_before_marks_and_after_lines(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 200_000)
    draw = random.Random(5)
    parts = ["a", "Ab", "é", "×", "÷", "ç7", "Ā.", "\n", "\n\n", "\r", " ", "  ", "\u0085", "\u00a0", "\u3000", "…", "—"]
    parts += ["'", "'s", "|", "<|", "<|endoftext|>", "%", "_", ".", ",", "b-", "a1", "42", "日本", "。", "\x1c", "²"]
    pieces, most = tokens.Pieces(PATH), 0
    for _ in range(40):
        texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 24))) for _ in range(100)]
        for text, ids in zip(texts, pieces.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole(text), repr(text)
        most = max(most, len(pieces.known))
    # what is known is thinned, and pieces met again are kept
    kept = [p for p in pieces.known if pieces.met[pieces.known[p]] > 1]
    pieces.thin()
    assert set(pieces.known) == {b"", *kept} and len(kept) > 10 and most > len(pieces.known)
    text = "".join(parts * 2)
    assert np.frombuffer(pieces.encode([text])[0], "<u4").tolist() == whole(text)
    words = tokens.Pieces(PATH)
    words.encode(["word after word. Word\nafter word, word"])
    assert set(words.known) == {b"", b"word", b" after", b" word", b".", b" Word", b"\n", b"after", b","}


def test_added_ids_stay_whole(tmp_path):
    for added in ("[PAD]", "word", "a b"):
        path = str(tmp_path / "tokenizer.json")
        own = Tokenizer.from_file(PATH)
        own.add_special_tokens([added])
        own.save(path)
        tokens.tokenizer.cache_clear()
        tokens.divisible.cache_clear()
        texts = ["a word[PAD], sword a b.", "[PAD]", "", "word words a  b"]
        for text, ids in zip(texts, tokens.Pieces(path).encode(texts), strict=True):
            want = own.encode(text, add_special_tokens=False).ids + [0]
            assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
