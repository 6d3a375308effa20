"""Language of whole texts by a bidirectional recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm import bytewords, gru
from tickloom.llm.placing import unpacked, with_text
from tickloom.operators.sampling import lowest
from tickloom.session import small_batches

SAMPLE = 400
SAMPLE_BYTES = 1 << 16
SLICE_BYTES = 1 << 18
WINDOWS = 16
STEPS = 64
HIDDEN = 8
EPOCHS = 4
BATCH = 512
RATE = 0.02
UNDETERMINED = "und"
OUTPUTS = ["lang_pred", "score"]

FOLD = np.arange(256)
FOLD[65:91] += 32
LETTER = np.zeros(256, np.float32)
LETTER[97:123] = LETTER[65:91] = LETTER[128:] = 1


@dataclass
class Model:
    langs: list[str]
    weights: dict[str, np.ndarray]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Projections of every byte, A-Z as a-z, for both directions."""
        return self.weights["in_f"][:, FOLD], self.weights["in_b"][:, FOLD]


def initial(langs: list[str], hidden: int, seed: int) -> Model:
    random = np.random.default_rng(seed)
    weights = {}
    for way in "fb":
        weights[f"in_{way}"] = gru.drawn(random, 3 * hidden, 256, scale=0.5)
        weights[f"rec_{way}"] = gru.drawn(random, 3 * hidden, hidden, scale=0.3)
        weights[f"out_{way}"] = gru.drawn(random, len(langs), hidden, scale=0.3)
    weights["bias"] = np.zeros((len(langs), 1), np.float32)
    return Model(langs, weights)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(0))
    return e / e.sum(0)


def windows(data: np.ndarray, bounds: np.ndarray, steps: int):
    """Texts cut into stretches of ``steps`` bytes, a lane each: bytes and masks by
    step, and the text of each lane. Every text has a lane, empty ones too."""
    sizes = np.diff(bounds)
    counts = np.maximum(1, -(-sizes // steps))
    text = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = bounds[text] + number * steps
    length = np.minimum(steps, bounds[text + 1] - start)
    place = np.arange(steps)[:, None]
    mask = (place < length).astype(np.float32)
    padded = np.concatenate([data, np.zeros(steps, np.uint8)])
    return padded[start[None, :] + place], mask, text


def train(texts: list[str], targets: np.ndarray, langs: list[str], hidden: int = HIDDEN, seed: int = 7) -> Model:
    """Fit to the languages of some texts. Every letter's position is a case; at
    most ``WINDOWS`` stretches of a text, chosen at random, take part."""
    model = initial(langs, hidden, seed)
    random = np.random.default_rng(seed)
    data, bounds = bytewords.text_buffers(pa.array(texts, pa.string()))
    taken, masks, text = windows(data, bounds, STEPS)
    order = random.permutation(len(text))
    seen = np.zeros(len(texts), np.int64)
    chosen = []
    for lane in order:
        if seen[text[lane]] < WINDOWS:
            seen[text[lane]] += 1
            chosen.append(lane)
    chosen = np.array(chosen, np.int64)
    adam = gru.Adam(model.weights, RATE)
    for epoch in range(EPOCHS):
        adam.rate = RATE * (1 - epoch / EPOCHS)
        lanes = random.permutation(chosen)
        for at in range(0, len(lanes), BATCH):
            pick = lanes[at : at + BATCH]
            adam.update(slopes(model, FOLD[taken[:, pick]], masks[:, pick], targets[text[pick]]))
    return model


def slopes(model: Model, data: np.ndarray, masks: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the mean cross-entropy over letters."""
    w = model.weights
    steps, lanes = data.shape
    caches, states = {}, {}
    for way in "fb":
        table = w[f"in_{way}"]
        ran = list(gru.run(lambda t, table=table: table[:, data[t]], w[f"rec_{way}"], masks, way == "b"))
        caches[way] = [(t, c) for t, _, c in ran]
        states[way] = {t: h for t, h, _ in ran}
    weight = masks * LETTER[data]
    weight /= max(1.0, weight.sum())
    true = np.eye(len(model.langs), dtype=np.float32)[:, target]
    by_logit = [
        (softmax(w["out_f"] @ states["f"][t] + w["out_b"] @ states["b"][t] + w["bias"]) - true) * weight[t]
        for t in range(steps)
    ]
    out = {"bias": sum(g.sum(1, keepdims=True) for g in by_logit)}
    for way in "fb":
        by_state = [(t, w[f"out_{way}"].T @ by_logit[t]) for t, _ in caches[way]]
        inputs, out[f"rec_{way}"] = gru.back(caches[way], by_state, w[f"rec_{way}"], masks)
        out[f"out_{way}"] = sum(by_logit[t] @ states[way][t].T for t in range(steps))
        table = np.zeros_like(w[f"in_{way}"])
        rows = np.concatenate([data[t] for t, _ in inputs])
        values = np.concatenate([g for _, g in inputs], 1)
        for k in range(len(table)):
            table[k] = np.bincount(rows, values[k], 256)
        out[f"in_{way}"] = table
    return out


def pooled(model: Model, texts: pa.Array) -> np.ndarray:
    """Mean probability of each language over the letters of each text (languages,
    texts); zeros where there are none."""
    data, bounds = bytewords.text_buffers(texts)
    taken, masks, text = windows(data, bounds, STEPS)
    w = model.weights
    table_f, table_b = model.tables()
    heads = {}
    for t, h, _ in gru.run(lambda t: np.take(table_f, taken[t], 1), w["rec_f"], masks):
        heads[t] = w["out_f"] @ h + w["bias"]
    weight = masks * LETTER[taken]
    total = np.zeros((len(model.langs), len(text)), np.float32)
    for t, h, _ in gru.run(lambda t: np.take(table_b, taken[t], 1), w["rec_b"], masks, True):
        total += softmax(heads.pop(t) + w["out_b"] @ h) * weight[t]
    letters = np.bincount(text, weight.sum(0), len(texts))
    sums = np.stack([np.bincount(text, row, len(texts)) for row in total])
    return sums / np.maximum(letters, 1)


def identify(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the probability pooled over the letters of
    the whole text, every one of which the network labels. The network reads
    stretches of 64 bytes in both directions, each from a state of zero.

    Null and empty texts and texts without a letter of any script are ``und`` with
    score 0, and so is everything if the model knows no language. Repeated rows
    stay; an empty table gives no rows; columns of the outputs' names are
    replaced."""
    return unpacked(identified_rows(docs, model, text, keep), "row", OUTPUTS)


def identified_rows(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """What ``identify`` returns, with the kept columns as a struct ``row``."""
    body = F.col(f"`{text}`").cast("string")
    known = F.lit(bool(model.langs)) & F.coalesce(body.rlike("\\p{L}"), F.lit(False))
    columns, at = with_text(docs, keep, text, F.when(known, body))
    rows = docs.select(*columns, known.alias("known"))
    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double")
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_labeller(sent, at), schema)


def _labeller(sent, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in bytewords.sliced(batches, column, SLICE_BYTES):
            texts = bytewords.carried(batch, column)
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            some = np.flatnonzero(batch.column("known").to_numpy(zero_copy_only=False))
            if len(some):
                shares = pooled(model, texts.take(pa.array(some)))
                for at, best, share in zip(some, shares.argmax(0), shares.max(0), strict=True):
                    names[at], scores[at] = model.langs[best], min(1.0, share)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names), pa.array(scores)], names=["row", "lang_pred", "score"]
            )

    return run


def sample(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    label: str,
    per_label: int,
    text: str = "text",
    id: str = "doc_id",
    limit: int = SAMPLE_BYTES,
) -> list[tuple[str, object]]:
    """Texts and labels to learn from: of each label the ``per_label`` ids with the
    smallest hashes among those that have a text of at most ``limit`` bytes. Ids are
    chosen first, in one scan, so that no texts move but those of the sample; of several
    such texts of an id the least is taken."""
    known = F.col(f"`{label}`")
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("body"))
    short = texts.filter(F.octet_length("body") <= limit)
    own = labels.filter(learn & known.isNotNull()).select(F.col(f"`{id}`").alias("id"), known.alias("known")).distinct()
    usable = own.join(short.select("id").distinct(), "id").withColumn("draw", F.xxhash64("id"))
    chosen = lowest(usable, per_label, ["draw", "id"], ["known"]).select("id", "known")
    rows = short.join(F.broadcast(chosen), "id").groupBy("id", "known").agg(F.min("body").alias("body")).collect()
    return [(r["body"], r["known"]) for r in sorted(rows, key=lambda r: (r["id"], r["known"]))]


def fitted(docs: DataFrame, learn: Column, lang: str = "lang", text: str = "text", per_lang: int = SAMPLE) -> Model:
    """A model of the languages of the rows to learn from, at most ``per_lang``
    texts of each."""
    rows = sample(docs, docs, learn, lang, per_lang, text)
    langs = sorted({known for _, known in rows})
    number = {name: k for k, name in enumerate(langs)}
    if not rows:
        return Model([], {})
    return train([body for body, _ in rows], np.array([number[known] for _, known in rows]), langs)
