"""Personal data in plain and disguised form, with offsets in the source text."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from tickloom.llm import bytewords
from tickloom.llm.placing import packed, unpacked

KINDS = ("email", "ip", "card", "phone")
SPAN = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("plain", BooleanType()),
        StructField("value", StringType()),
    ]
)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# An address that fails at the head of a run of digits fails everywhere in the run,
# so runs are passed as a whole.
IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_ASCII = re.compile(r"[^\x00-\x7F]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "ԁ": "d", "һ": "h", "ո": "n", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i", "А": "A", "В": "B", "Е": "E",
    "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "τ": "t", "Α": "A", "Β": "B",
    "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "—": "-", "−": "-", "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\ufeff": "", "\u00ad": "",
}
# Digits spelled in English, German, French and Spanish.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3",
    "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2",
    "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_NUMBER = "|".join(sorted(SPELLED, key=len, reverse=True))
_AT = r"(?:at|arroba|chez|@)"
_DOT = r"(?:dot|punkt|point|punto|\.)"
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
_BOXED_AT = rf"[\x20\t]*{_OPEN}[\x20\t]*{_AT}[\x20\t]*{_SHUT}[\x20\t]*"
_BOXED_DOT = rf"[\x20\t]*{_OPEN}[\x20\t]*{_DOT}[\x20\t]*{_SHUT}[\x20\t]*"
_SPACED_DOT = r"[\x20\t]+(?:dot|punkt|point|punto)[\x20\t]+"
# A bare "at" is a disguise only where a disguised dot follows its next word.
_SPACED_AT = rf"[\x20\t]+(?:at|arroba)[\x20\t]+(?=[A-Za-z0-9-]+(?:{_SPACED_DOT}|{_BOXED_DOT})[A-Za-z0-9])"
EDIT = re.compile(
    rf"(?P<digits>(?<!\w)(?:{_NUMBER})(?:(?:[\x20\t]+|-)(?:{_NUMBER}))*(?!\w))"
    rf"|(?P<plus>(?<!\w)plus[\x20\t]+(?=[0-9]|(?:{_NUMBER})(?!\w)))"
    rf"|(?<=\w)(?P<at>{_BOXED_AT}|{_SPACED_AT})(?=\w)"
    rf"|(?<=\w)(?P<dot>{_BOXED_DOT}|{_SPACED_DOT})(?=\w)",
    re.IGNORECASE,
)
BOXED = re.compile(rf"{_OPEN}[\x20\t]*(?:{_AT}|{_DOT})[\x20\t]*{_SHUT}", re.IGNORECASE)
NUMBER = re.compile(_NUMBER, re.IGNORECASE)
DOTTED_I = "\u0130"
BARE_AT = re.compile(r"\s(?:at|arroba)\s", re.IGNORECASE)
# Endings that tell "x at y dot z" from running prose: country codes and
# general endings.
DOMAINS = frozenset(
    (
        "com org net edu gov mil int info biz name pro dev app io ai co me tv uk de fr es eu nl pt pl se ch ca au nz jp "
        "cn kr br mx ar cl ru ua cz dk fi gr hu ie il lt lv ro rs sk tr za test example invalid ac ae af ag al ao aq aw "
        "ax az ba bb bd bf bg bh bi bj bm bn bo bs bt bv bw bz cc cd cf cg ci ck cm cr cu cv cw cx cy dj dm dz ec ee eg "
        "er et fj fk fm fo ga gb gd ge gf gg gh gi gl gm gn gp gq gs gt gu gw gy hk hm hn hr ht id im iq ir je jm jo ke "
        "kg kh ki km kn kp kw ky kz lb lc li lk lr ls lu ly mc md mg mh mk ml mm mn mo mp mq mt mu mv mw mz na nc ne nf "
        "ng ni np nr nu om pe pf pg ph pk pn pr ps pw py qa rw sa sb sc sd sg si sj sl sm sn sr ss su sv sx sy sz tc td "
        "tf tg th tj tk tl tm tn tt tw tz ug uy uz va vc ve vg vi vn vu wf ws ye yt zm zw xyz icu vip nyc ooo wiki mobi "
        "arpa gmbh ltd llc"
    ).split()
)
# Country codes that are words, and newer general endings, most of which
# are words too. These count unless the text around has the shape of prose.
WORD_DOMAINS = frozenset(
    (
        "ad am as at be by do in is it la ma mr ms my no pa pm re sh so st to us academy actor aero agency apartments "
        "army art asia associates auction audio auto baby band bank bar bargains beauty beer berlin best bet bid bike "
        "bingo bio black blog blue boutique bond build builders business buy buzz cab cafe cam camera camp capital car "
        "cards care careers cars cash casino cat center cfd chat cheap church city claims cleaning click clinic clothing "
        "cloud club coach codes coffee college cologne community company computer condos construction consulting "
        "contractors cooking cool coop country coupons courses credit cruises dance date dating day deals degree delivery "
        "democrat dental desi design diamonds digital direct directory discount doctor dog domains download earth eco "
        "education email energy engineer engineering enterprises equipment esq estate events exchange expert express fail "
        "faith family fan fans farm fashion film finance financial fish fishing fit fitness flights florist flowers foo "
        "football forsale forum foundation fun fund furniture futbol fyi gallery game games garden gay gift gifts gives "
        "glass global gold golf graphics gratis green gripe group guide guitars guru hair hamburg haus health healthcare "
        "help hiphop hockey holdings holiday homes horse hospital host hosting hotel house how immo immobilien inc "
        "industries ink institute insurance insure international investments jetzt jewelry jobs juegos kaufen kids kim "
        "kitchen kiwi koeln land lat law lawyer lease legal lgbt life lighting limited limo link live living loan loans "
        "lol london love ltda luxury maison makeup management market marketing markets mba media melbourne memorial men "
        "menu miami moda moe mom money monster mortgage motorcycles mov movie museum music navy network new news ngo "
        "ninja now observer ong online onl organic page paris partners parts party pet phd photo photography photos "
        "pics pictures pink pizza place plumbing plus poker post press productions prof promo properties property "
        "protection pub qpon quest racing realestate recipes red rehab reise reisen rent rentals repair report republican "
        "rest restaurant review reviews rich rip rocks rodeo rugby run sale salon sarl sbs school schule science security "
        "select services sex sexy shoes shop shopping show singles site ski skin soccer social software solar solutions "
        "soy space sport spot storage store stream studio study style sucks supplies supply support surf surgery sydney "
        "systems tattoo tax taxi team tech technology tel tennis theater tickets tienda tips tires tirol today tokyo "
        "tools top tours town toys trade trading training travel tube university vacations vegas ventures vet viajes "
        "video villas vin vision vodka vote voyage watch webcam website wedding wien win wine work works world wtf yachts "
        "yoga zip zone xxx porn local onion bayern swiss scot wales eus gal bzh amsterdam brussels vlaanderen gent quebec "
        "capetown boston"
    ).split()
)
# Words that prose has before "dot" or "point", and no host consists of.
POINTERS = frozenset(
    "the a an this that these those each every any some one two both another other same which what whose my your his "
    "her its our their no all such first second third next last either neither".split()
)
LABEL = re.compile(r"[^\W_][\w-]*")
BARE_POINT = re.compile(r"\spoint\s", re.IGNORECASE)
PROSE_AFTER = re.compile(r"[\x20\t\u00a0]+[^\W\d_]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds the @ it is found by; its local part is the run of local
    characters before it, from the end of the last match on."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            free = host.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def numbers(text: str) -> Iterator[tuple[str, int, int]]:
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if m[2] and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Identifiers as they stand, by kind and start."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    return found + list(numbers(text))


@cache
def lookalikes() -> dict[str, str]:
    """Characters that stand for one ASCII character: the fixed ones, and by rule
    compatibility forms and digits of any script."""
    table = dict(LOOKALIKES)
    for code in range(0xA0, 0x20000):
        char = chr(code)
        form = unicodedata.normalize("NFKC", char)
        if len(form) == 1 and form.isascii() and form.isprintable():
            table.setdefault(char, form)
        elif (digit := unicodedata.digit(char, None)) is not None:
            table.setdefault(char, str(digit))
    return table


class Segment(NamedTuple):
    """A stretch of the normalised text and the source it stands for; ``copied``
    stretches map character by character."""

    at: int
    start: int
    end: int
    copied: bool


class Rewritten:
    """A text after some edits, which can map its spans back."""

    def __init__(self, text: str, edits: Iterator[tuple[int, int, str]]) -> None:
        parts: list[str] = []
        self.segments: list[Segment] = []
        at = source = 0
        for start, end, new in edits:
            if start > source:
                parts.append(text[source:start])
                self.segments.append(Segment(at, source, start, True))
                at += start - source
            if new:
                parts.append(new)
                self.segments.append(Segment(at, start, end, False))
                at += len(new)
            source = end
        self.edited = source > 0
        if source < len(text):
            parts.append(text[source:])
            self.segments.append(Segment(at, source, len(text), True))
        self.text = "".join(parts)
        self.starts = [s.at for s in self.segments]

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source span of a span that is not empty."""
        first = self.segments[bisect_right(self.starts, start) - 1]
        last = self.segments[bisect_right(self.starts, end - 1) - 1]
        low = first.start + (start - first.at) * first.copied
        return low, last.start + end - last.at if last.copied else last.end


def _folds(text: str) -> Iterator[tuple[int, int, str]]:
    """Look-alikes one by one; a dash counts between digits only, where it joins."""
    table = lookalikes()
    odd = set(NOT_ASCII.findall(text)) & table.keys()
    for m in re.finditer(f"[{re.escape(''.join(sorted(odd)))}]", text) if odd else ():
        a, b = m.span()
        new = table[m[0]]
        if new != "-" or text[max(a - 1, 0) : a].isdigit() and text[b : b + 1].isdigit():
            yield a, b, new


def _respelled(text: str) -> Iterator[tuple[int, int, str]]:
    for m in EDIT.finditer(text):
        if m["digits"]:
            start = m.start()
            found = list(NUMBER.finditer(m[0]))
            for k, word in enumerate(found):
                low = found[k - 1].end() if k else 0
                # re takes a dotted capital I for an i, str.lower() does not
                yield start + low, start + word.end(), SPELLED[word[0].replace(DOTTED_I, "i").lower()]
        else:
            yield m.start(), m.end(), "+" if m["plus"] else "@" if m["at"] else "."


def disguised_spans(text: str, hinted: bool = True) -> list[tuple[str, int, int, str]]:
    """Identifiers of the normalised text that an edit is part of, with source
    offsets and the normalised value. ``hinted``: false if the text is known to
    have no spelled disguise (``hints``); it is not asked where look-alikes are
    folded, since they may make any word part of an identifier."""
    first = Rewritten(text, () if text.isascii() else _folds(text))
    if not (hinted or first.edited):
        return []
    second = Rewritten(first.text, _respelled(first.text))
    if not (first.edited or second.edited):
        return []
    out = []
    for kind, a, b in plain_spans(second.text):
        value = second.text[a:b]
        low, high = first.back(*second.back(a, b))
        if text[low:high] != value and not (kind == "email" and _prose(text, low, high, value)):
            out.append((kind, low, high, value))
    return out


def _prose(text: str, low: int, high: int, value: str) -> bool:
    """Whether an email with a bare at rather is running prose: it has no known
    ending, or one that is a word, two labels parted by a bare dot and either a host
    like "the" or "this", or a bare "point" and more words after it on the line."""
    at = BARE_AT.search(text, low, high)
    ending = value.rpartition(".")[2].lower()
    if not at or ending in DOMAINS:
        return False
    if ending not in WORD_DOMAINS:
        return True
    host = LABEL.match(text, at.end())
    if value.rpartition("@")[2].count(".") > 1 or BOXED.search(text, at.end(), high) or not host:
        return False
    point = BARE_POINT.search(text, at.end(), high)
    return host[0].lower() in POINTERS or bool(point and PROSE_AFTER.match(text, high))


def hints(texts: pa.Array) -> np.ndarray:
    """For each text whether it may hold an identifier with a spelled disguise; true
    for every text in which ``EDIT`` would make one, look-alikes aside.

    A word for a dot, a boxed sign, a plus before a number; or a spelled digit next to
    a word that is one too, or that has a digit on that side. Addresses, cards and
    phone numbers have at least one more digit beside a spelled one, with no letter
    between them; in an email a single one replaces letters by a digit, and the email
    stands there plainly. Only spelled digits that are not ASCII make emails longer,
    so these count by themselves. Characters outside ASCII separate words here, as
    quotes and bullets do; letters among them only make more words."""
    words = bytewords.words_of(texts, bytewords.ASCII_LETTERS_DIGITS)
    screen, exact = hint_words()
    kind = np.zeros(len(words.hash) + 2, np.int8)  # one more on both sides
    for at in np.flatnonzero(screen[words.hash >> np.uint64(44)]):
        kind[at + 1] = exact.get(int(words.hash[at]), 0)
    digit, dot, plus, tail = kind == 1, kind == 2, kind == 3, kind == 4
    data, _ = bytewords.text_buffers(texts)
    figure = (data >= 48) & (data < 58)
    starts, ends = digit | tail, digit | tail
    starts[1:-1] |= figure[words.start]
    ends[1:-1] |= figure[words.end - 1]
    found = dot[1:-1] | digit[1:-1] & (ends[:-2] | starts[2:]) | plus[1:-1] & starts[2:]
    found |= tail[1:-1] & (data[words.start - 1] >= 128)
    out = np.zeros(len(texts), bool)
    out[words.row[found]] = True
    for at, text in enumerate(texts.to_pylist()):
        out[at] |= bool(text) and (DOTTED_I in text or bool(BOXED.search(text)))
    return out


@cache
def hint_words() -> tuple[np.ndarray, dict[int, int]]:
    """By hash: 1 for spelled digits, 2 for words for a dot, 3 for plus, 4 for the ends
    of spelled digits after a character outside ASCII; and a bit for the head of every
    such hash."""
    exact = {}
    plain = [w for w in SPELLED if w.isascii()]
    tails = [NOT_ASCII.split(w)[-1] for w in SPELLED if not w.isascii()]
    for kind, group in enumerate([plain, ("dot", "punkt", "point", "punto"), ("plus",), tails], 1):
        found = bytewords.words_of(pa.array(group), bytewords.ASCII_LETTERS_DIGITS)
        exact |= {int(h): kind for h in found.hash}
    screen = np.zeros(1 << 20, bool)
    screen[[h >> 44 for h in exact]] = True
    return screen, exact


def spans(text: str, hinted: bool = True) -> list[tuple[str, int, int, bool, str]]:
    """All spans by kind and start. A disguised span within a plain one of its kind
    says nothing new and is left out."""
    plain = plain_spans(text)
    found = [(k, a, b, True, text[a:b]) for k, a, b in plain]
    for kind, low, high, value in disguised_spans(text, hinted):
        if not any(k == kind and a <= low and high <= b for k, a, b in plain):
            found.append((kind, low, high, False, value))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``pii``: for every identifier its kind, start and end in code points of
    the source, whether it stands there plainly, and its value after normalising.

    Plain emails, addresses, cards and phone numbers are always reported as they
    stand. Two transducers then rewrite the text: one maps look-alike characters
    and drops invisible ones, one writes spelled digits and disguised at, dot and
    plus as the characters they stand for. What is found only after rewriting is
    mapped back and added.

    Left out is "x at y dot z" with a bare at where z is no country code nor one of
    the general endings in ``DOMAINS`` and ``WORD_DOMAINS``. Where z is among the
    latter ("in", "it", "online") and the dot is bare too, it is left out if y is a
    word such as "the" or "this" ("at this point in"), and with "point" for the dot
    if words follow on the line. So is the ending "one", which is read as a digit.

    Null and empty texts have no identifiers; repeated rows stay; an empty table
    gives no rows. A column named ``pii`` is replaced."""
    rows = docs.select(packed(docs, keep).alias("row"), F.col(f"`{text}`").cast("string").alias("body"))
    schema = StructType([rows.schema["row"], StructField("pii", ArrayType(SPAN))])
    return unpacked(rows.mapInArrow(_find, schema), "row", ["pii"])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(ArrayType(SPAN))
    names = SPAN.names
    for batch in bytewords.sliced(batches, "body"):
        texts = batch.column("body")
        bodies = [t or "" for t in texts.to_pylist()]
        hinted = hints(texts)
        found = [
            [dict(zip(names, s, strict=True)) for s in spans(t, h)] for t, h in zip(bodies, hinted, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind)], names=["row", "pii"])


def masked(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with every identifier in ``text`` replaced by its kind in angle
    brackets; of overlapping identifiers the first, then the longer, is taken."""
    found = find(docs, text, keep)
    return found.withColumn(text, F.udf(_masked, "string")(F.col(f"`{text}`"), "pii")).drop("pii")


def _masked(text: str | None, pii: list | None) -> str | None:
    parts, at = [], 0
    for s in sorted(pii or [], key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"<{s['kind']}>"]
            at = s["end"]
    return text if text is None else "".join([*parts, text[at:]])


def listed(found: Column) -> Column:
    """Spans as text: kind, start and end."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
