"""Quality by compression: two zstandard dictionaries, one from good text and one from bad.

A text is cut into chunks and every chunk is compressed with both dictionaries; text that shares
phrases with the good samples gets smaller with the good dictionary.  The difference of the two
sizes over the text's size is calibrated into a probability by a logistic regression, together
with the sizes themselves (good dictionary, none) and log length, as short and repetitive texts
shift the difference.

The fit uses a bounded sample of labelled rows (``per_class``) with whole texts, which stay in Spark
tasks: one half trains
the dictionaries, the other the calibration, where a drawn row counts for as many labels as it stands
for: the share of good labels that the score learns is the table's at every size.  Scoring reads whole texts.  Nulls count as empty
texts; an empty text gets the calibrated score of zero sizes.  Without labels of both classes every
score is 1 (nothing is rejected).  Rows are independent of each other, so repeated rows get equal
scores, and ties are equal scores; a score on the threshold is kept; further columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, released, utf8
from .labelled import labelled_sample

PER_CLASS = 2500
#: Chunks that one text gives to a dictionary, from all over it; a dictionary holds 32 KB.
DICTIONARY_CHUNKS = 8
DICTIONARY_BYTES = 32 << 10
CHUNK_BYTES = 1024
LEVEL = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    chunk_bytes: int = CHUNK_BYTES
    level: int = LEVEL


def spread_chunks(raw: bytes, chunk_bytes: int, most: int) -> list[bytes]:
    """The chunks of a text; of more than ``most``, one at a place by hash from each of ``most`` equal stretches."""
    n = -(-len(raw) // chunk_bytes)
    at = range(n)
    if n > most:
        h, cuts = zlib.crc32(raw), [k * n // most for k in range(most + 1)]
        at = [a + zlib.crc32(bytes([k % 256]), h) % (b - a) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return [raw[i * chunk_bytes : (i + 1) * chunk_bytes] for i in at]


def build_dictionary(chunks: list[bytes], size: int, level: int) -> bytes:
    """A trained dictionary of the chunks; their plain bytes when there are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, [c for c in chunks if len(c) >= 8], level=level).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(chunks)[:size] or b"\n" * 8


class Meter:
    """Measures a text with both dictionaries and without."""

    def __init__(self, good: bytes, bad: bytes, chunk_bytes: int, level: int):
        import zstandard

        self.chunk, self.packers = chunk_bytes, []
        for d in (good, bad):
            kind = zstandard.DICT_TYPE_FULLDICT if d[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
            own = zstandard.ZstdCompressionDict(d, dict_type=kind)
            own.precompute_compress(level=level)
            self.packers.append(zstandard.ZstdCompressor(dict_data=own, write_content_size=False, write_dict_id=False))
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)

    def measure(self, raw: bytes) -> tuple[float, float, float, float]:
        """(normalised difference, size with the good dictionary, size without, log length)."""
        if not raw:
            return 0.0, 0.0, 0.0, 0.0
        parts = [raw[i : i + self.chunk] for i in range(0, len(raw), self.chunk)]
        good, bad = (sum(len(p.compress(x)) for x in parts) for p in self.packers)
        n = len(raw)
        return (bad - good) / n, good / n, len(self.plain.compress(raw)) / n, float(np.log1p(n))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = l2 * np.r_[np.ones(x.shape[1] - 1), 0.0]
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -50, 50)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x / weight.sum() + np.diag(ridge) + 1e-9 * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (weight * (p - y)) / weight.sum() + ridge * w)
    return w


def calibrate(good: bytes, bad: bytes, x: np.ndarray, y: np.ndarray, weight: np.ndarray, chunk_bytes: int, level: int) -> Model:
    """The model of two dictionaries and of measured rows; a row counts for ``weight`` labels."""
    centre = np.average(x, 0, weight)
    scale = np.sqrt(np.average((x - centre) ** 2, 0, weight)) + 1e-6
    return Model(good, bad, _logistic(np.c_[(x - centre) / scale, np.ones(len(x))], y, weight), centre, scale, chunk_bytes, level)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = PER_CLASS, dictionary_bytes: int = DICTIONARY_BYTES, chunk_bytes: int = CHUNK_BYTES, level: int = LEVEL) -> Model | None:
    """Fit on at most ``per_class`` labelled rows of each class that are not held out; None without both classes.

    Dictionaries come from every other text, the calibration from the rest.  A text counts for as
    many usable labels of its class as it stands for, so the calibration keeps the table's share
    of good labels when the classes are drawn at different rates.  The driver gets chunks of a
    fixed size and four numbers a text.
    """
    rows, stands_for = labelled_sample(docs, labels, label_col, per_class)
    sides: dict[int, list[str]] = {0: [], 1: []}
    for r in sorted(rows.select("i", "y").collect()):
        sides[r.y].append(r.i)
    if not (sides[0] and sides[1]):
        return None
    held = {c: sides[c][1::2] or sides[c] for c in sides}
    learnt, measured = {i for s in sides.values() for i in s[::2]}, {i for s in held.values() for i in s}

    def draw(batches):
        for b in pieces(batches):
            b = b.filter(pa.array([i in learnt for i in b.column(0).to_pylist()]))
            chunks = [spread_chunks(raw, chunk_bytes, DICTIONARY_CHUNKS) for raw in utf8(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(chunks, pa.list_(pa.binary()))], ["i", "y", "chunks"])

    drawn: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(rows.mapInArrow(released(draw), "i string, y int, chunks array<binary>").collect(), key=lambda r: r.i):
        drawn[r.y] += map(bytes, r.chunks)
    good, bad = (build_dictionary(drawn[c], dictionary_bytes, level) for c in (1, 0))
    shared = docs.sparkSession.sparkContext.broadcast((good, bad))  # two dictionaries of fixed size

    def measure(batches):
        meter = Meter(*shared.value, chunk_bytes, level)
        for b in pieces(batches):
            b = b.filter(pa.array([i in measured for i in b.column(0).to_pylist()]))
            x = [meter.measure(raw) for raw in utf8(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.list_(pa.float64()))], ["i", "y", "x"])

    found = sorted(rows.mapInArrow(released(measure), "i string, y int, x array<double>").collect(), key=lambda r: r.i)
    weight = {c: stands_for[c] * len(sides[c]) / len(held[c]) for c in sides}
    return calibrate(good, bad, np.array([r.x for r in found]), np.array([r.y for r in found], float), np.array([weight[r.y] for r in found]), chunk_bytes, level)


class Scorer:
    def __init__(self, model: Model | None):
        self.model = model
        self.meter = Meter(model.good, model.bad, model.chunk_bytes, model.level) if model else None

    def __call__(self, raws: list[bytes]) -> np.ndarray:
        if not self.model or not raws:
            return np.ones(len(raws))
        x = np.array([self.meter.measure(r) for r in raws])
        z = np.c_[(x - self.model.centre) / self.model.scale, np.ones(len(x))] @ self.model.weights
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text: the probability of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # two dictionaries of fixed size

    def run(batches):
        scorer = Scorer(pickle.loads(shared.value))
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scorer(utf8(b.column(1))), pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(released(run), f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep(docs: DataFrame, model: Model | None, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    spot = docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(pickle.loads(shared.value))
        for b in pieces(batches):
            yield b.filter(pa.array(scorer(utf8(b.column(spot))) >= threshold))

    return docs.mapInArrow(released(run), docs.schema)
