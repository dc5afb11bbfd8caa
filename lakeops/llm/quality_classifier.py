"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages (windows of ``PASSAGE`` bytes of the whole
text).  Each passage gets a vector of surface statistics: bigram frequencies of
byte classes, share of distinct words, word length, length.  The model encodes
every passage, h = tanh(W x + b), learns gated attention weights
a = softmax(w . (tanh(V h) * sigmoid(U h))) from document labels only, and
scores the weighted representation, sigmoid(c . sum(a h) + d).

The fit is on a bounded, deterministic sample of labelled rows
(``max_per_class`` of each label, by hash of the id); every document is scored
from all its passages in the task that reads it, without a shuffle.

Cases: a null or empty text is one passage of zeros; a document labelled twice
takes the lower label; null labels and labels without a document are no
examples; if a class has no example, every score is 0.5; repeated rows are
scored each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from lakeops.llm._common import map_batches

PASSAGE = 512
THRESHOLD = 0.3
HELD_OUT_MOD = 5

#: byte classes: space, lower, upper, digit, sentence mark, symbol, other mark, non-ASCII, line end
N_CLASSES = 9
CLASS = np.full(256, 6, np.uint8)
CLASS[[32, 9, 11, 12, 13]] = 0
CLASS[97:123] = 1
CLASS[65:91] = 2
CLASS[48:58] = 3
CLASS[[ord(c) for c in ".,;:?"]] = 4
CLASS[[ord(c) for c in "#*$%&|<>"]] = 5
CLASS[128:] = 7
CLASS[10] = 8
N_FEATURES = N_CLASSES * N_CLASSES + 3


def passages(text: str | None) -> np.ndarray:
    """(passages, features) of one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, -(-len(raw) // PASSAGE))
    x = np.zeros((n, N_FEATURES), np.float32)
    if not raw:
        return x
    kind = CLASS[np.frombuffer(raw, np.uint8)].astype(np.int64)
    pairs = kind[:-1] * N_CLASSES + kind[1:] + (np.arange(len(raw) - 1) // PASSAGE) * N_CLASSES ** 2
    grams = np.bincount(pairs, minlength=n * N_CLASSES ** 2).reshape(n, -1)
    x[:, :N_CLASSES ** 2] = np.sqrt(grams / np.maximum(grams.sum(1, keepdims=True), 1))
    for i in range(n):
        part = raw[i * PASSAGE:(i + 1) * PASSAGE]
        words = part.split()
        x[i, -3] = len(set(words)) / max(len(words), 1)
        x[i, -2] = min(len(part) / max(len(words), 1), 64) / 16
        x[i, -1] = len(part) / PASSAGE
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class AttentionModel:
    """Parameters of the network; ``mean`` and ``scale`` standardise features."""
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """x: passages of several bags, one after another; starts: first of each."""
        p, sizes = self.p, np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": sigmoid(z @ p["c"] + p["d"]), "sizes": sizes}

    def gradient(self, f: dict[str, np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean log loss."""
        p, n = self.p, f["sizes"]
        dy = weight * (f["y"] - y) / weight.sum()
        dz = np.repeat(dy[:, None] * p["c"], n, axis=0)
        da = (dz * f["h"]).sum(1)
        mean = np.repeat(np.add.reduceat(f["a"] * da, np.concatenate(([0], np.cumsum(n)[:-1]))), n)
        de = f["a"] * (da - mean)
        tg = f["t"] * f["g"]
        dt = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["w"] * tg * (1 - f["g"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": tg.T @ de, "c": f["z"].T @ dy, "d": np.array(dy.sum())}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0] + [len(b) for b in bags])[:-1]
        x = (np.concatenate(bags) - self.mean) / self.scale
        return self.forward(x, starts)["y"]


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, steps: int = 200,
        rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> AttentionModel:
    """Full-batch Adam on document labels, both classes weighted alike."""
    x = np.concatenate(bags).astype(np.float64)
    starts = np.cumsum([0] + [len(b) for b in bags])[:-1]
    mean, scale = x.mean(0), x.std(0) + 0.02
    x = (x - mean) / scale
    r = np.random.default_rng(seed)
    m = AttentionModel(mean, scale, {
        "W": r.normal(0, N_FEATURES ** -0.5, (N_FEATURES, hidden)), "b": np.zeros(hidden),
        "V": r.normal(0, hidden ** -0.5, (hidden, gate)), "U": r.normal(0, hidden ** -0.5, (hidden, gate)),
        "w": r.normal(0, gate ** -0.5, gate), "c": r.normal(0, hidden ** -0.5, hidden), "d": np.array(0.0)})
    y = labels.astype(np.float64)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    first = {k: np.zeros_like(v) for k, v in m.p.items()}
    second = {k: np.zeros_like(v) for k, v in m.p.items()}
    for s in range(1, steps + 1):
        grad = m.gradient(m.forward(x, starts), y, weight)
        for k, g in grad.items():
            g = g + decay * m.p[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            m.p[k] = m.p[k] - rate * (first[k] / (1 - 0.9 ** s)) / (np.sqrt(second[k] / (1 - 0.999 ** s)) + 1e-8)
    return m


def sample(docs: DataFrame, labels: DataFrame, max_per_class: int) -> DataFrame:
    """(doc_id, quality, text): at most ``max_per_class`` labelled documents of
    each label from the rows that are not held out, the same ones in every run."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
                           & (F.crc32(F.col("doc_id").cast("string")) % HELD_OUT_MOD != 0))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = (known.filter("quality = 0").orderBy(*order).limit(max_per_class)
              .unionByName(known.filter("quality = 1").orderBy(*order).limit(max_per_class)))
    return (docs.select(F.col("doc_id"), F.col("text"))
            .join(F.broadcast(chosen), "doc_id")                  # at most 2 * max_per_class rows
            .select("doc_id", "quality", "text"))


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = 1500, max_passages: int = 48) -> AttentionModel | None:
    """Fits on the bounded sample; of a sampled document at most
    ``max_passages`` evenly spaced passages are used (in the fit only)."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("quality", IntegerType()),
                         StructField("x", ArrayType(FloatType()))])

    def make():
        def step(batch):
            bags = [passages(t) for t in batch.column(2).to_pylist()]
            bags = [b[np.unique(np.linspace(0, len(b) - 1, max_passages).round().astype(int))] for b in bags]
            flat = pa.array(np.concatenate([b.ravel() for b in bags]) if bags else [], pa.float32())
            ends = np.cumsum([0] + [b.size for b in bags])
            return [batch.column(0), batch.column(1).cast(pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
        return step

    found = map_batches(sample(docs, labels, max_per_class), make, schema).toArrow().sort_by("doc_id")
    y = found.column("quality").to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    bags = [np.asarray(v.values, np.float32).reshape(-1, N_FEATURES) for v in found.column("x")]
    return fit(bags, y)


def batch_scores(model: AttentionModel | None, texts: list) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    out = []
    for i in range(0, len(texts), 64):                            # bounded: 64 texts at a time
        out.append(model.scores([passages(t) for t in texts[i:i + 64]]))
    return np.concatenate(out)


def classify(docs: DataFrame, model: AttentionModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    schema = StructType([docs.schema["doc_id"], StructField("score", DoubleType())])

    def make():
        def step(batch):
            return [batch.column(0), batch_scores(model, batch.column(1).to_pylist())]
        return step

    scored = map_batches(docs.select("doc_id", "text"), make, schema)
    return scored.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % HELD_OUT_MOD == 0).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: AttentionModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    at = docs.columns.index("text")

    def make():
        def step(batch):
            keep = pa.array(batch_scores(model, batch.column(at).to_pylist()) >= threshold)
            return [pc.filter(c, keep) for c in batch.columns]
        return step

    return map_batches(docs, make, docs.schema)
