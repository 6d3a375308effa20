"""Quality of documents by a conditional random field over their lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm import bytewords, gru
from tickloom.llm.bytewords import BETWEEN_BLANKS
from tickloom.llm.langid import sample
from tickloom.llm.placing import packed, unpacked

SAMPLE = 1500
EDGES = 15
STEPS = 200
ROUND = 20
HALVINGS = 14
AGREED = 0.9
RATE = 0.05
SHRINK = 1e-3
TIES = ("before", "after", "step")
TIE_SHRINK = 5e-2
THRESHOLD = 0.7
SLICE = 4 << 20
OUTPUTS = ["score", "n_lines", "predicted"]

OTHER, UPPER, LOWER, WIDE, DIGIT, BLANK, SHOUT, BAR, SIGN, STOP = range(10)
KIND = np.zeros(256, np.int64)
KIND[65:91], KIND[97:123], KIND[128:], KIND[48:58] = UPPER, LOWER, WIDE, DIGIT
KIND[list(b" \t\r\x0b\x0c")] = BLANK
KIND[list(b"!")], KIND[list(b"|")], KIND[list(b".,;:?")] = SHOUT, BAR, STOP
KIND[list(b"*#$%&@^~<>=+_/\\{}[]")] = SIGN


@dataclass
class Lines:
    """Measures of lines (measures, lines), their lengths and the lines of each text."""

    measures: np.ndarray
    length: np.ndarray
    counts: np.ndarray


def lines_of(texts: pa.Array) -> Lines:
    """Lines between line feeds; an empty text has one, which is empty."""
    data, bounds = bytewords.text_buffers(texts)
    feeds = np.flatnonzero(data == 10)
    inside = np.searchsorted(feeds, bounds)
    counts = np.diff(inside) + 1
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    start = np.empty(total, np.int64)
    is_first = np.zeros(total, bool)
    is_first[first] = True
    start[is_first] = bounds[:-1]
    start[~is_first] = feeds + 1
    end = np.empty(total, np.int64)
    is_last = np.zeros(total, bool)
    is_last[first + counts - 1] = True
    end[is_last] = bounds[1:]
    end[~is_last] = feeds
    length = end - start
    line = np.repeat(np.arange(total), length + ~is_last)
    kinds = np.bincount(line * 10 + KIND[data], minlength=total * 10).reshape(total, 10).T.astype(np.float64)
    words = bytewords.words_in(data, bounds, BETWEEN_BLANKS)
    owner = line[words.start]
    number = np.bincount(owner, minlength=total)
    same = np.zeros(len(owner), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    repeats = np.bincount(owner[same], minlength=total)
    digest = np.zeros(total, np.uint64)
    some = np.flatnonzero(number)
    if len(some):
        head = np.cumsum(number) - number
        turned = words.hash * (np.arange(len(owner)) - head[owner] + 3).astype(np.uint64)
        digest[some] = np.add.reduceat(turned, head[some])
    echo = np.zeros(total, bool)
    echo[1:] = (digest[1:] == digest[:-1]) & ~is_first[1:] & (number[1:] > 0)
    per_word = np.maximum(number, 1)
    size = np.maximum(length, 1)
    letters = kinds[UPPER] + kinds[LOWER] + kinds[WIDE]
    measures = np.stack(
        [
            np.log2(1 + length),
            kinds[UPPER] / np.maximum(kinds[UPPER] + kinds[LOWER], 1),
            letters / size,
            kinds[SHOUT] / per_word,
            kinds[BAR] / per_word,
            kinds[SIGN] / per_word,
            kinds[STOP] / per_word,
            kinds[DIGIT] / size,
            kinds[WIDE] / size,
            repeats / per_word,
            letters / per_word,
            echo.astype(float),
            np.where(is_first & is_last, np.log2(2 + length), np.where(is_first, -1.0, np.where(is_last, -2.0, -3.0))),
        ]
    )
    return Lines(measures, length, counts)


@dataclass
class Model:
    """``edges`` cut each measure into bins; weights for the bins of the line before,
    the line itself and the line after, and for the steps between labels."""

    edges: list[np.ndarray]
    weights: dict[str, np.ndarray]


def bins(edges: list[np.ndarray], measures: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, m, "right") for e, m in zip(edges, measures, strict=True)])


def neighbours(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each line whether it has one before and one after it."""
    first = np.cumsum(counts) - counts
    before, after = np.ones(int(counts.sum()), bool), np.ones(int(counts.sum()), bool)
    before[first] = False
    after[first + counts - 1] = False
    return before, after


def evidence(weights: dict[str, np.ndarray], binned: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-odds of good for each line by itself and its neighbours."""
    before, after = neighbours(counts)
    own = weights["shift"][0] + sum(w[b] for w, b in zip(weights["own"], binned, strict=True))
    back = sum(w[b] for w, b in zip(weights["before"], binned, strict=True))
    ahead = sum(w[b] for w, b in zip(weights["after"], binned, strict=True))
    own[before] += np.roll(back, 1)[before]
    own[after] += np.roll(ahead, -1)[after]
    return own


def marginals(e: np.ndarray, counts: np.ndarray, step: np.ndarray):
    """Forward-backward over all texts at once. ``step[i, j]`` scores label j after
    label i. Returns the probability of good of every line, and for every line that
    has one before it the probabilities of the four steps (2, 2, lines)."""
    order = np.argsort(-counts, kind="stable")
    start, size = (np.cumsum(counts) - counts)[order], counts[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")
    ahead, behind = e.copy(), np.zeros(len(e))
    for t in range(1, longest):
        at = start[: active[t]] + t
        a = ahead[at - 1]
        ahead[at] += np.logaddexp(a + step[1, 1], step[0, 1]) - np.logaddexp(a + step[1, 0], step[0, 0])
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t
        b = e[at + 1] + behind[at + 1]
        behind[at] = np.logaddexp(b + step[1, 1], step[1, 0]) - np.logaddexp(b + step[0, 1], step[0, 0])
    good = 1 / (1 + np.exp(-np.clip(ahead + behind, -500, 500)))
    later = np.flatnonzero(neighbours(counts)[0])
    a, b = ahead[later - 1], e[later] + behind[later]
    joint = np.array([[step[0, 0] + 0 * a, step[0, 1] + b], [step[1, 0] + a, step[1, 1] + a + b]])
    joint -= joint.max((0, 1))
    joint = np.exp(joint)
    return good, later, joint / joint.sum((0, 1))


def untrained() -> Model:
    number = len(lines_of(pa.array([""])).measures)
    return Model([np.zeros(0)] * number, initial(number))


def initial(number: int) -> dict[str, np.ndarray]:
    tables = {k: np.zeros((number, EDGES + 1)) for k in ("before", "own", "after")}
    return tables | {"shift": np.zeros(1), "step": np.zeros((2, 2))}


def cut_points(measure: np.ndarray) -> np.ndarray:
    """Borders of bins: quantiles of the distinct values, as most lines have none of
    what makes a line odd."""
    values = np.unique(np.round(measure, 3))
    return np.unique(np.quantile(values, np.linspace(0, 1, EDGES + 2)[1:-1]))


def line_weights(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """The text of each line, and its share of the text by length."""
    text = np.repeat(np.arange(len(lines.counts)), lines.counts)
    weight = lines.length + 1.0
    return text, weight / np.bincount(text, weight, len(lines.counts))[text]


def clamped(e: np.ndarray, lines: Lines, step: np.ndarray, labels: np.ndarray):
    """What ``marginals`` returns once every text agrees with its label: the labellings
    of its lines are weighed anew, as little as possible, until good lines make up at
    least ``AGREED`` of a good text's length, or bad ones of a bad text's. That adds the
    same multiple of a line's share to the evidence of all lines of a text; the multiple
    is found by bisection."""
    text, share = line_weights(lines)
    sign = np.where(labels == 1, 1.0, -1.0)
    low, high = np.zeros(len(labels)), 50.0 * lines.counts
    pull = np.zeros(len(labels))
    for _ in range(HALVINGS):
        good, _, _ = marginals(e + (sign * pull)[text] * share, lines.counts, step)
        agreed = np.bincount(text, share * np.where(sign[text] > 0, good, 1 - good), len(labels)) >= AGREED
        low, high = np.where(agreed, low, pull), np.where(agreed, pull, high)
        pull = (low + high) / 2
        pull[high == 0] = 0
    return marginals(e + (sign * high)[text] * share, lines.counts, step)


def train(texts: list[str], labels: np.ndarray, share_good: float) -> Model:
    """Maximum likelihood of the texts' labels with the labels of their lines hidden.
    Every text of a label counts the same; ``share_good`` is what the good ones count.

    The first half takes a text's label for all its lines and learns from the lines
    alone. After that the labellings that agree with the text's label are weighed
    (``clamped``) every few steps and learnt from, together with the neighbours and the
    steps between labels, so a good text may have bad lines. What ties lines together is
    held small: where all lines of a text look alike, stronger ties would explain its
    label as well, and no line could differ from its text."""
    lines = lines_of(pa.array(texts, pa.string()))
    edges = [cut_points(m) for m in lines.measures]
    binned = bins(edges, lines.measures)
    weights = initial(len(edges))
    text, _ = line_weights(lines)
    number = {0: max(1, int((labels == 0).sum())), 1: max(1, int((labels == 1).sum()))}
    part = np.where(labels == 1, share_good / number[1], (1 - share_good) / number[0])
    share = part[text] / lines.counts[text]
    before, after = neighbours(lines.counts)
    later = np.flatnonzero(before)
    target = labels[text]
    seen = np.zeros((2, 2, len(later)))
    seen[target[later - 1].astype(int), target[later].astype(int), np.arange(len(later))] = 1
    adam = gru.Adam(weights, RATE)
    for turn in range(STEPS):
        e = evidence(weights, binned, lines.counts)
        if turn >= STEPS // 2 and turn % ROUND == 0:
            target, _, seen = clamped(e, lines, weights["step"], labels)
        good, _, joint = marginals(e, lines.counts, weights["step"])
        miss = (good - target) * share
        slopes = {"shift": np.array([miss.sum()])}
        for name, shift, has in (("own", 0, None), ("before", -1, before), ("after", 1, after)):
            moved = miss if has is None else np.roll(np.where(has, miss, 0), shift)
            slopes[name] = np.stack([np.bincount(b, moved, EDGES + 1) for b in binned])
        slopes["step"] = ((joint - seen) * share[later]).sum(2)
        if turn < STEPS // 2:
            slopes |= {k: np.zeros_like(weights[k]) for k in TIES}
        adam.update({k: g + (TIE_SHRINK if k in TIES else SHRINK) * weights[k] for k, g in slopes.items()})
    return Model(edges, weights)


def line_labels(model: Model, texts: pa.Array) -> list[np.ndarray]:
    """The probability of good of each line of each text."""
    lines = lines_of(texts)
    e = evidence(model.weights, bins(model.edges, lines.measures), lines.counts)
    good, _, _ = marginals(e, lines.counts, model.weights["step"])
    return np.split(good, np.cumsum(lines.counts)[:-1])


def score_texts(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Share of good in each text, lines weighing by their length, and their number."""
    lines = lines_of(texts)
    e = evidence(model.weights, bins(model.edges, lines.measures), lines.counts)
    good, _, _ = marginals(e, lines.counts, model.weights["step"])
    text, share = line_weights(lines)
    return np.clip(np.bincount(text, share * good, len(texts)), 0, 1), lines.counts


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str, text: str = "text", per_label: int = SAMPLE
) -> Model:
    """A model from labelled documents: at most ``per_label`` texts of each label, which
    weigh as the labels do among all of these rows. Without any, every text scores
    one half."""
    rows = sample(docs, labels, learn, label, per_label, text)
    known = F.col(f"`{label}`")
    share = labels.filter(learn & known.isNotNull()).agg(F.avg(known.cast("double"))).first()[0]
    texts, labels = [t for t, _ in rows], np.array([float(y) for _, y in rows])
    return train(texts, labels, share) if rows else untrained()


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``score`` (0 to 1), ``n_lines`` and ``predicted`` (1 from 0.7 on).

    Every line of the whole text is measured (length, case, signs, repeated words
    and lines, place); the bins of a line and of its neighbours give its evidence,
    steps between labels tie the lines together, and the forward-backward
    probabilities of good are averaged by line length. Null and empty texts are one
    empty line. Repeated rows stay; an empty table gives no rows; columns of the
    outputs' names are replaced."""
    rows = docs.select(packed(docs, keep).alias("row"), F.col(f"`{text}`").cast("string").alias("body"))
    schema = rows.drop("body").schema.add("score", "double").add("n_lines", "long")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.mapInArrow(_scorer(sent), schema)
    return unpacked(scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")), "row", OUTPUTS)


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in bytewords.sliced(batches, "body", SLICE):
            scores, number = score_texts(model, batch.column("body"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores), pa.array(number)], names=["row", "score", "n_lines"]
            )

    return run
