import random
import re

import pyarrow as pa

from tickloom.llm import pii
from tests.llm.odd import ROWS, nothing, odd

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: [int(c) for c in m[0] if c in "0123456789"]
    luhn = lambda d: sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(d))) % 10 == 0
    found = [("email", m) for m in EMAIL.finditer(text)]
    found += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", m) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [(k, m.start(), m.end()) for k, m in found]


def test_plain_spans_are_those_of_the_patterns():
    draw = random.Random(7)
    pieces = ["a", "b1", "1", "22", "255", "256", ".", ".", "@", "-", " ", "+", "(", ")", "é", ".com", "4111 1111 1111 1111"]
    for _ in range(20_000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 25)))
        assert pii.plain_spans(text) == brute(text)
        assert [s[:3] for s in pii.spans(text) if s[3]] == brute(text)


def only(text):
    return [(k, text[a:b], plain, value) for k, a, b, plain, value in pii.spans(text)]


def test_disguises_are_found_where_they_stand():
    cases = {
        "mail jo.doe [at] example [dot] com now": ("email", "jo.doe [at] example [dot] com", "jo.doe@example.com"),
        "to bob at example dot co dot uk.": ("email", "bob at example dot co dot uk", "bob@example.co.uk"),
        "é x(@)y.de": ("email", "x(@)y.de", "x@y.de"),
        "jоhn@exаmple.com": ("email", "jоhn@exаmple.com", "john@example.com"),
        "mail＠example．com": ("email", "mail＠example．com", "mail@example.com"),
        "a​b@c​.de": ("email", "a​b@c​.de", "ab@c.de"),
        "plus four nine one seven one 2345678": (
            "phone", "plus four nine one seven one 2345678", "+49171 2345678",
        ),
        "at one nine two dot one six eight dot zero dot one": (
            "ip", "one nine two dot one six eight dot zero dot one", "192.168.0.1",
        ),
        "192[.]168[.]1[.]7": ("ip", "192[.]168[.]1[.]7", "192.168.1.7"),
        "４１１１ 1111 1111 1111": ("card", "４１１１ 1111 1111 1111", "4111 1111 1111 1111"),
        "FOUR " + "one " * 15: ("card", "FOUR " + "one " * 14 + "one", "4" + "1" * 15),
    }
    for text, (kind, source, value) in cases.items():
        assert (kind, source, False, value) in only(text), text


def test_prose_is_left_alone():
    for text in (
        "look at the dot on it", "arrive at example.com today", "un deux trois quatre", "one two three four five",
        "write me@example.com—soon", "au point de vue", "1–2–3", "plus one", "",
    ):
        assert all(plain for _, _, _, plain, _ in pii.spans(text)), text


def test_addresses_of_every_ending():
    found = {
        "mario at libero dot it": "mario@libero.it",
        "write to anna at firma dot at for details": "anna@firma.at",
        "jan at post dot be, please": "jan@post.be",
        "ann at shop dot example dot online now": "ann@shop.example.online",
        "ola at firma punkt no und": "ola@firma.no",
        "raj at mail dot in has it": "raj@mail.in",
        "li at host point sg or tw": "li@host.sg",
        "bo at host dot xyz": "bo@host.xyz",
        "joe at cafe point is": "joe@cafe.is",
        "joe at cafe point us. More": "joe@cafe.us",
        "eva at this [dot] is it": "eva@this.is",
        "x at the dot com": "x@the.com",
    }
    for text, value in found.items():
        assert value in [v for k, _, _, _, v in screened(text) if k == "email"], text
    for text in (
        "look at the dot in the middle", "stop at this point in time", "arrived at that point it rained",
        "at some point we left", "done at one point to no end", "stare at a dot is boring", "water at boiling point is hot",
        "look at each dot no more", "at every point top speed", "meet at noon dot whatever",
    ):
        assert not screened(text), text


def test_country_codes_are_whole():
    endings = pii.DOMAINS | pii.WORD_DOMAINS
    assert not pii.DOMAINS & pii.WORD_DOMAINS
    assert sum(len(e) == 2 for e in endings) >= 248
    for ending in endings:
        assert [s[4] for s in screened(f"jan at post dot {ending}")] == [f"jan@post.{ending}"], ending


def test_screen_passes_every_disguise():
    import pyarrow as pa

    texts = ["a at b dot c", "x (dot) y", "FÜNF SECHS", "plus 4", "plus vier", "one two", "nothing here", "one", None]
    assert pii.hints(pa.array(texts)).tolist() == [True, True, True, True, True, True, False, False, False]


def screened(text):
    return pii.spans(text, bool(pii.hints(pa.array([text]))[0]))


def test_screen_keeps_mixed_digits_and_quoted_words():
    cases = {
        "Call +49 151 two 345 six 78": ("phone", "+49 151 two 345 six 78", "+49 151 2 345 6 78"),
        "pay 4111 one 111 1111 1111 now": ("card", "4111 one 111 1111 1111", "4111 1 111 1111 1111"),
        "host 192.168.one.1 up": ("ip", "192.168.one.1", "192.168.1.1"),
        "one.2.3.4": ("ip", "one.2.3.4", "1.2.3.4"),
        "call „plus 49 151 2345678“": ("phone", "plus 49 151 2345678", "+49 151 2345678"),
        "•plus four nine 151 2345678": ("phone", "plus four nine 151 2345678", "+49 151 2345678"),
        "+49 151 fünf 345 67 8": ("phone", "+49 151 fünf 345 67 8", "+49 151 5 345 67 8"),
        "fünf@x.com": ("email", "fünf@x.com", "5@x.com"),
        "+49 151 SİX 345 67 8": ("phone", "+49 151 SİX 345 67 8", "+49 151 6 345 67 8"),
        "x（at）y“ (dot) “a at b dot com": ("email", "a at b dot com", "a@b.com"),
    }
    for text, (kind, source, value) in cases.items():
        found = screened(text)
        assert (kind, source, False, value) in [(k, text[a:b], p, v) for k, a, b, p, v in found], text


def test_screen_loses_nothing_the_transducer_finds():
    draw = random.Random(11)
    pieces = [
        "one", "TWO", "fünf", "ZÉRO", "sİx", "un", "plus", "dot", "at", "[at]", "(.)", "point", "at", "a", "b7", "x@y.de",
        "@", ".", ".", "-", "+", "(", ")", "_", "4111", "1111", "1", "49", "255", "„", "•", "’", "é", "１", "–", "о",
        " ", " ", " ", " ", "\t", "\u00a0", "\n", ".com",
    ]
    texts = []
    for _ in range(40_000):
        some = draw.sample(pieces, 12) if draw.random() < 0.5 else ["1", "one", " ", ".", "-", "+", "49", "(", "151"]
        texts.append("".join(draw.choice(some) for _ in range(draw.randint(1, 30))))
    hinted = pii.hints(pa.array(texts))
    for text, hint in zip(texts, hinted.tolist(), strict=True):
        if not hint:
            assert pii.spans(text, False) == pii.spans(text), text
    assert 1000 < hinted.sum() < 39_000


def test_odd_rows(spark):
    extra = [(20, "a@b.de and a@b.de", "en", "a"), (21, "x at y dot org" * 3 + " 10.0.0.1", "en", "a")]
    out = pii.find(odd(spark, ROWS + extra)).collect()
    assert len(out) == len(ROWS) + 2
    for r in out:
        assert [tuple(s) for s in r["pii"]] == pii.spans(r["text"] or "")
        assert (r["row"], r["body"]) == ("r", "b")
    assert pii.find(nothing(spark)).count() == 0
    masked = {r["doc_id"]: r["text"] for r in pii.masked(odd(spark, extra)).collect()}
    assert masked[20] == "<email> and <email>" and "10.0.0.1" not in masked[21]
