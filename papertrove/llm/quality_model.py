"""Document quality by attention over passages (multiple-instance learning).

A document is a bag of passages and only the bag has a label. Every passage is encoded; gated attention, learned from
the documents' labels, weighs the passages; the weighted sum of their encodings is what is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papertrove.llm.words import Words, mixed, slices, table
from papertrove.operators.sampling import bounded_sample

#: Words of a passage; the bound of the labelled sample that the model is fitted on, in documents and bytes of a text.
PASSAGE = 64
FIT_DOCUMENTS = 4000
FIT_BYTES = 128_000
HASHED = 32
ENCODED = 16
ATTENTION = 12
EPOCHS = 40
BATCH = 128
RATE = 0.01
DECAY = 1e-4
FOLDS, HELD_OUT = 3, 1

_BYTES = np.arange(256)
#: Shares of bytes that describe a passage.
KINDS = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "wide": _BYTES >= 128,
    "stop": np.isin(_BYTES, np.frombuffer(b".!?", np.uint8)),
    "shout": _BYTES == 33,
    "comma": np.isin(_BYTES, np.frombuffer(b",;:", np.uint8)),
    "bar": _BYTES == 124,
    "symbol": np.isin(_BYTES, np.frombuffer(b"#*$%&<>@_=~^\\/+", np.uint8)),
}
STYLE = len(KINDS) + 5
FEATURES = STYLE + HASHED


def passages(words: Words, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of ``size`` words (a document's last one is shorter) and the bounds of the documents.

    A document without words is one passage of zeros, so every document has at least one.
    """
    sizes = np.diff(words.bounds)
    per_document = np.maximum(1, -(-sizes // size))
    bounds = np.append(0, np.cumsum(per_document))
    count = int(bounds[-1])
    out = np.zeros((count, FEATURES), np.float32)
    if not len(words):
        return out, bounds
    document = words.documents
    place = np.arange(len(words)) - words.bounds[document]
    passage = bounds[document] + place // size
    n = np.bincount(passage, minlength=count)
    full = np.maximum(n, 1)
    lengths = words.ends - words.starts
    chars = np.maximum(np.bincount(passage, lengths, count), 1)
    used = np.flatnonzero(n)
    first = np.searchsorted(passage, used)
    begins, ends = words.starts[first], words.ends[np.append(first[1:], len(words)) - 1]
    for i, mask in enumerate(KINDS.values()):
        seen = np.append(0, np.cumsum(mask[words.data], dtype=np.int64))
        out[used, i] = (seen[ends] - seen[begins]) / chars[used]
    codes = words.codes()
    again = np.append(False, (codes[1:] == codes[:-1]) & (passage[1:] == passage[:-1]))
    # Equal words of one passage have one key, so a passage's distinct words are its distinct keys.
    keys = mixed(codes ^ mixed(passage.astype(np.uint64)))
    order = np.argsort(keys)
    distinct = np.append(True, keys[order[1:]] != keys[order[:-1]])
    kinds = np.bincount(passage[order[distinct]], minlength=count)
    base = len(KINDS)
    out[:, base] = chars / full / 10
    out[:, base + 1] = np.bincount(passage, again, count) / full
    out[:, base + 2] = kinds / full
    out[:, base + 3] = np.log1p(n) / 4
    squares = np.bincount(passage, lengths.astype(float) ** 2, count) / full
    out[:, base + 4] = np.sqrt(np.maximum(0, squares - (chars / full) ** 2)) / 5
    bucket = (codes % np.uint64(HASHED)).astype(np.int64)
    hashed = np.bincount(passage * HASHED + bucket, minlength=count * HASHED).reshape(count, HASHED)
    out[:, STYLE:] = hashed / full[:, None]
    out[n == 0] = 0
    return out, bounds


@dataclass
class AttentionModel:
    """Encoder, gated attention and scorer; ``mean`` and ``scale`` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = np.clip((features - self.mean) / self.scale, -6, 6)
        encoded = np.tanh(x @ w["encode"] + w["encode_bias"])
        tanh = np.tanh(encoded @ w["value"])
        gate = 0.5 + 0.5 * np.tanh(0.5 * (encoded @ w["gate"]))
        energy = (tanh * gate) @ w["attend"]
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        top = np.maximum.reduceat(energy, bounds[:-1])
        raised = np.exp(energy - top[owner])
        attention = raised / np.add.reduceat(raised, bounds[:-1])[owner]
        pooled = np.add.reduceat(attention[:, None] * encoded, bounds[:-1])
        logit = pooled @ w["score"] + w["score_bias"][0]
        names = ("x", "encoded", "tanh", "gate", "owner", "attention", "pooled", "logit")
        return dict(zip(names, (x, encoded, tanh, gate, owner, attention, pooled, logit), strict=True))

    def gradient(self, features: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean cross entropy."""
        w, f = self.weights, self.forward(features, bounds)
        error = ((probability(f["logit"]) - labels) / len(labels)).astype(np.float32)
        out = {"score": f["pooled"].T @ error, "score_bias": np.array([error.sum()])}
        pooled = error[:, None] * w["score"]
        mine = pooled[f["owner"]]
        attention = (mine * f["encoded"]).sum(axis=1)
        mean = np.add.reduceat(f["attention"] * attention, bounds[:-1])
        energy = f["attention"] * (attention - mean[f["owner"]])
        out["attend"] = (f["tanh"] * f["gate"]).T @ energy
        product = energy[:, None] * w["attend"]
        tanh = product * f["gate"] * (1 - f["tanh"] ** 2)
        gate = product * f["tanh"] * f["gate"] * (1 - f["gate"])
        out["value"], out["gate"] = f["encoded"].T @ tanh, f["encoded"].T @ gate
        encoded = f["attention"][:, None] * mine + tanh @ w["value"].T + gate @ w["gate"].T
        inner = encoded * (1 - f["encoded"] ** 2)
        out["encode"], out["encode_bias"] = f["x"].T @ inner, inner.sum(axis=0)
        return out


def probability(logit: np.ndarray) -> np.ndarray:
    """Of label 1."""
    return 0.5 + 0.5 * np.tanh(0.5 * logit.astype(np.float64))


def fit_model(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, seed: int = 5) -> AttentionModel:
    """Fit by Adam on the documents' labels (0 or 1). Without documents every score is one half."""
    rng = np.random.Generator(np.random.PCG64(seed))
    shapes = {
        "encode": (FEATURES, ENCODED),
        "encode_bias": (ENCODED,),
        "value": (ENCODED, ATTENTION),
        "gate": (ENCODED, ATTENTION),
        "attend": (ATTENTION,),
        "score": (ENCODED,),
        "score_bias": (1,),
    }
    w = {
        name: (rng.normal(0, 0.25, s) if len(s) > 1 or name == "attend" else np.zeros(s)).astype(np.float32)
        for name, s in shapes.items()
    }
    if not len(labels):
        w["score"][:] = 0
        return AttentionModel(np.zeros(FEATURES), np.ones(FEATURES), w)
    model = AttentionModel(features.mean(axis=0), features.std(axis=0) + 1e-3, w)
    first = {name: np.zeros_like(value) for name, value in w.items()}
    second = {name: np.zeros_like(value) for name, value in w.items()}
    updates = 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(labels))
        for at in range(0, len(labels), BATCH):
            some = shuffled[at : at + BATCH]
            sizes = bounds[some + 1] - bounds[some]
            own = np.append(0, np.cumsum(sizes))
            rows = np.repeat(bounds[some] - own[:-1], sizes) + np.arange(own[-1])
            updates += 1
            rate = RATE * np.sqrt(1 - 0.999**updates) / (1 - 0.9**updates)
            for name, g in model.gradient(features[rows], own, labels[some]).items():
                g = g + DECAY * w[name]
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                w[name] -= (rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    """True for the fold that nothing is learned from; a null id is in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def _sample(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, bounds and labels of at most ``FIT_DOCUMENTS`` labelled documents outside the held-out fold."""
    marked = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = bounded_sample(marked, ["doc_id"], FIT_DOCUMENTS)
    # At most FIT_DOCUMENTS pairs of numbers: small enough to send to every task.
    rows = documents.join(F.broadcast(chosen), "doc_id").filter(F.octet_length("text") <= FIT_BYTES)
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("features", pa.binary())])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            features, bounds = passages(Words(part.column("text")))
            ids, label = (part.column(name).combine_chunks() for name in ("doc_id", "label"))
            data = [features[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield table(schema, doc_id=ids, label=label, features=data)

    described = rows.select("doc_id", "label", "text").mapInArrow(describe, "doc_id long, label int, features binary")
    # Rows that repeat an id are bounded too: one of them is learned from.
    found = sorted(described.groupBy("doc_id", "label").agg(F.min("features")).collect(), key=lambda row: row[0])
    parts = [np.frombuffer(row[2], np.float32).reshape(-1, FEATURES) for row in found]
    bounds = np.append(0, np.cumsum([len(part) for part in parts])).astype(np.int64)
    features = np.concatenate(parts) if parts else np.zeros((0, FEATURES), np.float32)
    return features, bounds, np.array([row[1] for row in found], np.float32)


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text``): ``held_out, score`` (0 to 1, higher: label 1 likelier), ``predicted``,
    the number of ``passages`` and the ``focus``, the passage with the largest attention weight.

    ``labels`` needs ``doc_id, quality``; qualities other than 0 and 1 and null ids are ignored, and of different labels
    of one document the larger counts. Only the text is an input of the score. A null or empty text is one empty passage
    and is scored like any other; a null ``doc_id`` stays null and counts as held out. Rows that repeat an id are scored
    one by one. Without labels every score is one half. Texts of any length are read whole, passage by passage.
    """
    rows = documents.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    model = documents.sparkSession.sparkContext.broadcast(fit_model(*_sample(rows, labels)))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("score", pa.float64()), ("passages", pa.int64()), ("focus", pa.int64())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            features, bounds = passages(Words(part.column("text")))
            found = model.value.forward(features, bounds)
            attention = found["attention"]
            top = np.maximum.reduceat(attention, bounds[:-1])
            leading = np.flatnonzero(attention == np.repeat(top, np.diff(bounds)))
            focus = leading[np.searchsorted(leading, bounds[:-1])] - bounds[:-1]
            ids = part.column("doc_id").combine_chunks()
            yield table(schema, doc_id=ids, score=probability(found["logit"]), passages=np.diff(bounds), focus=focus)

    scored = rows.mapInArrow(score, "doc_id long, score double, passages long, focus long")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
        "focus",
    )
