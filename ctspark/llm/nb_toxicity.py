"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the character n-grams of a lower-cased text, hashed into a fixed number of slots.  On labelled
texts each slot gets the log ratio of its smoothed rates among all characters of toxic and of other texts.  Slots
whose presence tells the classes apart by less than ``min_z`` standard errors get 0, so that what a small sample
collects by chance is not learnt.  A logistic regression with an L2 penalty is fitted on ratio times the logarithm
of the slot's density in the text; two further inputs (bias and log length) take up what longer texts collect.

The fit uses a bounded sample of labelled rows (``per_class``) with whole texts: Spark tasks count
their slots, and the driver gets one row a slot and, of each text, its counts in the at most ``max_slots`` telling
slots.  Scoring reads whole texts of any length.  Null texts count as empty; an empty text gets the score of a text without
n-grams.  Without labels of both classes every score is 0.  Rows are independent of each other: repeated rows and ties
get equal scores, further columns do not matter, an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, released
from .labelled import labelled_sample

#: n-gram lengths, slots of the feature table (a power of two), and the bound of the fit.
LENGTHS = (3, 4, 5, 6, 7)
SLOT_BITS = 20
PER_CLASS = 2500
MAX_SLOTS = 1 << 15


def grams(text: str, lengths=LENGTHS, slot_bits: int = SLOT_BITS) -> np.ndarray:
    """The slots of a text's character n-grams, blanks at either end included, repeats kept."""
    chars = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    parts, h, shift = [], chars, np.uint32(32 - slot_bits)
    for n in range(2, max(lengths) + 1):
        if len(chars) < n:
            break
        h = (h[:-1] * np.uint32(0x01000193)) ^ (chars[n - 1 :] * np.uint32(0x85EBCA6B))
        if n in lengths:
            parts.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> shift)
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


@dataclass
class Model:
    """Weights by slot (ratio times coefficient), then those of the bias and of log length."""

    weights: np.ndarray
    bias: float
    length: float
    lengths: tuple = LENGTHS
    slot_bits: int = SLOT_BITS

    def score(self, text: str) -> float:
        w = self.weights
        slots = grams(text, self.lengths, self.slot_bits)
        slots, many = np.unique(slots[w[slots] != 0.0], return_counts=True)
        z = float((w[slots] * density(many, len(text))).sum(dtype=np.float64)) + self.bias + self.length * float(np.log1p(len(text)))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def density(many: np.ndarray, length: int) -> np.ndarray:
    """The logarithm of how often slots occur in some 2,000 characters; short texts count as a little longer."""
    return np.log1p(many * (2000.0 / (length + 200)))


def ratios(texts: np.ndarray, times: np.ndarray, n: np.ndarray, chars: np.ndarray, smooth: float = 1.0, min_count: int = 3, min_z: float = 3.0, max_slots: int = MAX_SLOTS) -> np.ndarray:
    """The log ratio of every slot's rates in the two classes of ``n`` texts with ``chars`` characters.

    ``texts`` and ``times`` count by class the texts with a slot and its occurrences.  Slots in fewer than
    ``min_count`` texts, or whose share of texts differs between the classes by fewer than ``min_z`` standard errors (of
    the log ratio), get 0, and so do all but the ``max_slots`` most telling ones.
    """
    ratio = np.log((times[1] + smooth) / (chars[1] + 2 * smooth)) - np.log((times[0] + smooth) / (chars[0] + 2 * smooth))
    share = np.log((texts[1] + smooth) / (n[1] + 2 * smooth)) - np.log((texts[0] + smooth) / (n[0] + 2 * smooth))
    z = np.abs(share) / np.sqrt(1 / (texts[1] + smooth) + 1 / (texts[0] + smooth))
    z[(texts.sum(0) < min(min_count, int(n.sum()) // 2)) | (ratio == 0)] = 0.0
    least = min_z
    if np.count_nonzero(z >= min_z) > max_slots:
        least = max(min_z, float(np.nextafter(np.partition(z, -max_slots - 1)[-max_slots - 1], np.inf)))
    ratio[z < least] = 0.0
    return ratio


def fit(rows: list[np.ndarray], counts: list[np.ndarray], sizes: list[int], toxic: list[int], ratio: np.ndarray, lengths=LENGTHS, slot_bits: int = SLOT_BITS, l2: float = 2e-4, steps: int = 120) -> Model:
    """The classifier of texts of both classes, given as places among the slots with a ratio, counts there and lengths."""
    y = np.asarray(toxic, np.float64)
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)
    kept = np.flatnonzero(ratio)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate(rows)
    values = ratio[kept][flat] * np.concatenate([density(c, n) for c, n in zip(counts, sizes, strict=True)])
    size = np.log1p(sizes)
    extra = np.c_[np.ones(len(rows)), size - size.mean()]
    weight = np.where(y == 1, 0.5 / n[1], 0.5 / n[0])
    norm = float(np.median(np.sqrt(np.bincount(doc, values**2, len(rows)))) + 1e-9) if len(flat) else 1.0
    norm = max(norm, 1.0)
    w, u = np.ones(len(kept)) / norm, np.zeros(2)
    gw, gu = np.zeros_like(w), np.zeros(2)
    for _ in range(steps):  # full-batch steps with a step size for each weight
        z = np.bincount(doc, values * w[flat], len(rows)) / norm + extra @ u
        d = weight * (1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y)
        grad = np.bincount(flat, values * d[doc], len(w)) / norm + l2 * w
        g2 = extra.T @ d
        gw += grad**2
        gu += g2**2
        w -= 0.3 * grad / (np.sqrt(gw) + 1e-12)
        u -= 0.3 * g2 / (np.sqrt(gu) + 1e-12)
    weights = np.zeros(1 << slot_bits, np.float32)
    weights[kept] = w * ratio[kept] / norm
    return Model(weights, float(u[0] - u[1] * size.mean()), float(u[1]), tuple(lengths), slot_bits)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = PER_CLASS, lengths=LENGTHS, slot_bits: int = SLOT_BITS, **options) -> Model | None:
    """Fit on at most ``per_class`` labelled rows of each class that are not held out; None without both classes."""
    sample, _ = labelled_sample(docs, labels, label_col, per_class)
    n = np.zeros(2)
    for r in sample.groupBy("y").count().collect():
        n[r["y"]] = r["count"]
    if not n.all():
        return None

    def counts(batches):
        texts, times = (np.zeros((2, 1 << slot_bits), np.int64) for _ in range(2))
        chars = np.zeros(2, np.int64)
        for b in pieces(batches):
            for y, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                slots, many = np.unique(grams(t, lengths, slot_bits), return_counts=True)
                texts[y, slots] += 1
                times[y, slots] += many
                chars[y] += len(t)
        slots = np.flatnonzero(texts.any(0))
        for at in range(0, len(slots), 1 << 16):
            part = slots[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *(pa.array(x[y, part]) for x in (texts, times) for y in (0, 1))], ["slot", *names])
        # the characters of both classes stand in a row of their own
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), *(pa.array([int(v)], pa.int64()) for v in (0, 0, *chars))], ["slot", *names])

    names = ["x0", "x1", "t0", "t1"]
    found = sample.mapInArrow(released(counts), "slot long, " + ", ".join(f"{c} long" for c in names))
    # one row a slot: a fixed size; slots in fewer texts than any ratio needs stay behind
    table = found.groupBy("slot").agg(*(F.sum(c).alias(c) for c in names)).where(F.expr(f"slot < 0 or x0 + x1 >= {min(3, int(n.sum()) // 2)}")).toArrow()
    slots = table.column("slot").to_numpy()
    chars = np.array([table.column(c).to_numpy()[slots < 0].sum() for c in ("t0", "t1")], float)
    texts, times = (np.zeros((2, 1 << slot_bits)) for _ in range(2))
    for into, cols in ((texts, names[:2]), (times, names[2:])):
        for y, c in enumerate(cols):
            into[y, slots[slots >= 0]] = table.column(c).to_numpy()[slots >= 0]
    ratio = ratios(texts, times, n, chars, **{k: options.pop(k) for k in ("smooth", "min_count", "min_z", "max_slots") if k in options})
    place = np.full(1 << slot_bits, -1, np.int32)
    place[ratio != 0] = np.arange(np.count_nonzero(ratio))
    shared = docs.sparkSession.sparkContext.broadcast(place)  # 2 ** slot_bits numbers

    def telling(batches):
        for b in pieces(batches):
            texts = b.column(2).to_pylist()
            found = []
            for t in texts:
                slots = grams(t, lengths, slot_bits)
                found.append(np.unique(shared.value[slots[shared.value[slots] >= 0]], return_counts=True))
            cols = [pa.array([x[k].astype("<i4").tobytes() for x in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(t) for t in texts], pa.int64()), *cols], ["i", "y", "size", "places", "many"])

    rows = sorted(sample.mapInArrow(released(telling), "i string, y int, size long, places binary, many binary").collect(), key=lambda r: r.i)
    places, many = ([np.frombuffer(bytes(r[c]), "<i4").astype(np.int64) for r in rows] for c in ("places", "many"))
    return fit(places, many, [r["size"] for r in rows], [r.y for r in rows], ratio, lengths, slot_bits, **options)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # 2 ** slot_bits floats

    def run(batches):
        m = pickle.loads(shared.value)
        for b in pieces(batches):
            out = [m.score(t or "") if m else 0.0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(released(run), f"id {kind}, score double").withColumnRenamed("id", id_col)

