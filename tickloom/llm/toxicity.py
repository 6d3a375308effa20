"""Toxicity of whole texts by a bidirectional recurrent network with attention."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm import bytewords, gru
from tickloom.llm.bytewords import LETTERS_DIGITS
from tickloom.llm.langid import sample
from tickloom.llm.placing import packed, unpacked

SAMPLE = 2000
TRAIN_WINDOWS = 48
WINDOW, STRIDE = 32, 16
HIDDEN = 8
WORD_BITS, WORD_SIZE = 15, 8
GRAM, GRAM_BITS, GRAM_SIZE = 5, 15, 6
EPOCHS = 6
BATCH = 48
RATE = 0.01
OUTPUTS = ["score", "n_windows", "predicted"]


@dataclass
class Model:
    weights: dict[str, np.ndarray]


@dataclass
class Features:
    """Words of some texts: bucket of each word, buckets of its character grams in a
    row, first gram of each word that has any, and the words of each text."""

    word: np.ndarray
    gram: np.ndarray
    owner: np.ndarray
    head: np.ndarray
    counts: np.ndarray


def features(texts: pa.Array) -> Features:
    data, bounds = bytewords.text_buffers(texts)
    words = bytewords.words_in(data, bounds, LETTERS_DIGITS)
    plain = np.where(LETTERS_DIGITS.word[data], LETTERS_DIGITS.fold[data], np.uint8(32)).astype(np.uint32)
    # Grams of five bytes within a word; the first may begin with the blank before it.
    count = np.maximum(0, words.end - words.start - (GRAM - 2))
    owner = np.flatnonzero(count)
    some = count[owner]
    head = np.cumsum(some) - some
    at = np.arange(int(some.sum())) - np.repeat(head - words.start[owner], some) - 1
    code = plain[np.maximum(at, 0)]
    code[head] = 32
    for k in range(1, GRAM):
        code = code * np.uint32(0x01000193) + plain[at + k]
    code ^= code >> np.uint32(15)
    gram = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
    word = (words.hash >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    counts = np.bincount(words.row, minlength=len(texts))
    return Features(word, gram.astype(np.int32), owner, head, counts)


def initial(seed: int) -> Model:
    random = np.random.default_rng(seed)
    size = WORD_SIZE + GRAM_SIZE
    weights = {
        "words": gru.drawn(random, WORD_SIZE, 1 << WORD_BITS, scale=0.1),
        "grams": gru.drawn(random, GRAM_SIZE, 1 << GRAM_BITS, scale=0.1),
        "look": gru.drawn(random, 2 * HIDDEN, 1, scale=0.3),
        "out": gru.drawn(random, 2 * HIDDEN, 1, scale=0.5),
        "shift": np.zeros((1, 1), np.float32),
    }
    for way in "fb":
        weights[f"in_{way}"] = gru.drawn(random, 3 * HIDDEN, size, scale=0.5)
        weights[f"bias_{way}"] = np.zeros((3 * HIDDEN, 1), np.float32)
        weights[f"rec_{way}"] = gru.drawn(random, 3 * HIDDEN, HIDDEN, scale=0.3)
    return Model(weights)


def inputs(weights: dict[str, np.ndarray], f: Features) -> np.ndarray:
    """Word and character vectors of every word: (sizes, words)."""
    x = np.zeros((WORD_SIZE + GRAM_SIZE, len(f.word)), np.float32)
    np.take(weights["words"], f.word, 1, out=x[:WORD_SIZE])
    if len(f.owner):
        for k in range(GRAM_SIZE):
            x[WORD_SIZE + k, f.owner] = np.add.reduceat(weights["grams"][k][f.gram], f.head)
    return x


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over all words of each text: text, first word and length.
    A text without words has one empty window."""
    number = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(counts)), number)
    place = (np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)) * STRIDE
    start = (np.cumsum(counts) - counts)[text] + place
    return text, start, np.minimum(WINDOW, counts[text] - place)


def lanes(start: np.ndarray, length: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Word at each step of each window and the masks."""
    place = np.arange(WINDOW)[:, None]
    return np.minimum(start + place, max(0, total - 1)), (place < length).astype(np.float32)


def forward(weights, projected: dict[str, np.ndarray], word: np.ndarray, masks: np.ndarray, keep: bool = False):
    """Logit of every window; ``keep`` also returns what the way back needs."""
    states, caches = {}, {}
    for way in "fb":
        rows = projected[way]
        ran = gru.run(lambda t, rows=rows: np.take(rows, word[t], 1), weights[f"rec_{way}"], masks, way == "b")
        states[way], caches[way] = {}, []
        for t, h, cache in ran:
            states[way][t] = h
            if keep:
                caches[way].append((t, cache))
    both = np.stack([np.concatenate([states["f"][t], states["b"][t]]) for t in range(WINDOW)])
    scores = np.einsum("k,tkl->tl", weights["look"][:, 0], both) + np.where(masks > 0, 0, np.float32(-1e9))
    share = np.exp(scores - scores.max(0)) * masks
    share /= np.maximum(share.sum(0), 1e-9)
    pooled = np.einsum("tl,tkl->kl", share, both)
    logit = (weights["out"].T @ pooled + weights["shift"])[0]
    return (logit, both, share, pooled, caches) if keep else logit


def projections(weights, x: np.ndarray) -> dict[str, np.ndarray]:
    if not x.shape[1]:
        x = np.zeros((len(x), 1), np.float32)
    return {way: weights[f"in_{way}"] @ x + weights[f"bias_{way}"] for way in "fb"}


def slopes(weights, f: Features, word, masks, by_logit, kept, x) -> dict[str, np.ndarray]:
    """Slopes of the loss by all weights, from its slope by each window's logit."""
    _, both, share, pooled, caches = kept
    out = {"shift": by_logit.sum().reshape(1, 1), "out": pooled @ by_logit[:, None]}
    by_pooled = weights["out"] * by_logit
    by_share = np.einsum("kl,tkl->tl", by_pooled, both)
    by_score = share * (by_share - (share * by_share).sum(0))
    out["look"] = np.einsum("tl,tkl->k", by_score, both)[:, None]
    by_both = share[:, None] * by_pooled + by_score[:, None] * weights["look"]
    by_x = np.zeros_like(x)
    for part, way in enumerate("fb"):
        own = slice(part * HIDDEN, (part + 1) * HIDDEN)
        states = [(t, by_both[t, own]) for t, _ in caches[way]]
        steps, out[f"rec_{way}"] = gru.back(caches[way], states, weights[f"rec_{way}"], masks)
        at = np.concatenate([word[t] for t, _ in steps])
        value = np.concatenate([g for _, g in steps], 1)
        by_word = np.stack([np.bincount(at, v, x.shape[1]) for v in value]).astype(np.float32)
        out[f"in_{way}"] = by_word @ x.T
        out[f"bias_{way}"] = by_word.sum(1, keepdims=True)
        by_x += weights[f"in_{way}"].T @ by_word
    out["words"] = np.stack([np.bincount(f.word, v, 1 << WORD_BITS) for v in by_x[:WORD_SIZE]])
    sizes = np.diff(np.append(f.head, len(f.gram)))
    out["grams"] = np.stack(
        [np.bincount(f.gram, np.repeat(v[f.owner], sizes), 1 << GRAM_BITS) for v in by_x[WORD_SIZE:]]
    )
    return out


def train(texts: list[str], labels: np.ndarray, seed: int = 5) -> Model:
    """Fit to labelled texts. The label is the text's; its windows share its loss by
    how high they score, as the highest decides in use. At most ``TRAIN_WINDOWS``
    windows of a text, evenly spaced, take part."""
    model = initial(seed)
    w = model.weights
    random = np.random.default_rng(seed)
    adam = gru.Adam(w, RATE)
    for epoch in range(EPOCHS):
        adam.rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(len(texts))
        for low in range(0, len(order), BATCH):
            pick = order[low : low + BATCH]
            f = features(pa.array([texts[i] for i in pick], pa.string()))
            text, start, length = windows(f.counts)
            number = np.bincount(text)
            place = np.arange(len(text)) - (np.cumsum(number) - number)[text]
            step = np.maximum(1, -(-number // TRAIN_WINDOWS))[text]
            kept = place % step == random.integers(0, step)
            text, start, length = text[kept], start[kept], length[kept]
            if not len(text):
                continue
            word, masks = lanes(start, length, len(f.word))
            x = inputs(w, f)
            result = forward(w, projections(w, x), word, masks, keep=True)
            logit, label = result[0], labels[pick][text]
            weight = _window_weights(logit, text, len(pick), label)
            by_logit = ((1 / (1 + np.exp(-logit)) - label) * weight / len(pick)).astype(np.float32)
            if len(f.word):
                adam.update(slopes(w, f, word, masks, by_logit, result, x))
    return model


def _window_weights(logit, text, n, label) -> np.ndarray:
    """Weights within a text by exp(logit), one in sum; windows of texts that are not
    toxic count alike in addition."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, text, logit)
    e = np.exp(logit - top[text])
    soft = e / np.bincount(text, e, n)[text]
    even = 1 / np.bincount(text, minlength=n)[text]
    return soft + np.where(label == 0, even, 0)


def score_texts(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Probability of the highest window of each text, and its number of windows."""
    f = features(texts)
    text, start, length = windows(f.counts)
    word, masks = lanes(start, length, len(f.word))
    logit = forward(model.weights, projections(model.weights, inputs(model.weights, f)), word, masks)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, logit.astype(np.float64))
    return 1 / (1 + np.exp(-top)), np.bincount(text, minlength=len(texts))


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str, text: str = "text", per_label: int = SAMPLE
) -> Model:
    """A model from labelled documents, at most ``per_label`` texts of each label. Without
    any, every text scores one half."""
    rows = sample(docs, labels, learn, label, per_label, text)
    texts, labels = [t for t, _ in rows], np.array([float(y) for _, y in rows])
    model = train(texts, labels)
    if not rows:
        model.weights["out"][:] = 0
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``score`` (0 to 1, the highest of all windows), ``n_windows`` and
    ``predicted`` (1 from 0.5 on).

    Every text is cut into windows of 32 words that overlap by half. The network
    reads a window's words in both directions, each word as a learned vector and the
    sum of learned vectors of its character grams, and pools the states by
    attention. Null, empty and wordless texts have one empty window and get the
    score the model gives to it. Repeated rows stay; an empty table gives no rows;
    columns of the outputs' names are replaced."""
    rows = docs.select(packed(docs, keep).alias("row"), F.col(f"`{text}`").cast("string").alias("body"))
    schema = rows.drop("body").schema.add("score", "double").add("n_windows", "long")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.mapInArrow(_scorer(sent), schema)
    return unpacked(scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), "row", OUTPUTS)


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in bytewords.sliced(batches, "body"):
            scores, number = score_texts(model, batch.column("body"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores), pa.array(number)], names=["row", "score", "n_windows"]
            )

    return run
