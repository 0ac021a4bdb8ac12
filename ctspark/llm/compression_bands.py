"""Quality rules by compression: zstandard ratios must lie inside bands.

A document's ratio is its UTF-8 size over its compressed size, for the whole text and for fixed
chunks of it, the last one shorter.  Repetitive text compresses too well, noise too badly; what is normal rises with
the length, so a band is given at some lengths, and its limits in between follow the logarithm of the length.  More than a
twentieth of the chunks out of band, two neighbours, or whole chunks that differ by more than ``SPREAD``, reject a text
whatever its whole ratio is, as noise and repetition cancel there.  Simple counting rules come first.

Texts of any length are read whole, a chunk at a time; a ratio on a limit is inside, so ties are kept.
Nulls and texts without words have no words and fail the base rules.  Rows are independent:
repeated rows give equal rows, further columns do not matter, an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, released, utf8

#: Bands: (UTF-8 bytes, lowest ratio, highest ratio) of prose; the first and the last hold beyond their lengths.
WHOLE_BANDS = (
    (64, 0.55, 1.62),
    (100, 0.85, 1.72),
    (200, 1.10, 1.85),
    (300, 1.22, 1.92),
    (500, 1.32, 1.97),
    (700, 1.38, 2.00),
    (1000, 1.50, 2.05),
    (1400, 1.62, 2.11),
    (2000, 1.72, 2.16),
    (2800, 1.82, 2.21),
    (4000, 1.92, 2.28),
    (5600, 2.02, 2.33),
    (8000, 2.06, 2.38),
    (12000, 2.10, 2.43),
    (20000, 2.14, 2.48),
    (40000, 2.20, 2.55),
    (100000, 2.25, 2.65),
)
#: A chunk starts and ends inside the text, so its bands are somewhat wider; of the shortest ones nothing is asked.
CHUNK_BANDS = ((99, 0.0, 99.0), *((n, lo - 0.1, hi + 0.04) for n, lo, hi in WHOLE_BANDS if 100 <= n <= 5600))
#: How far the ratios of a text's whole chunks may lie apart.
SPREAD = 0.25
CHUNK_BYTES = 4096
#: Chunks out of band that reject a text: more than this share, or two neighbours.
BAD_SHARE = 0.05
LEVEL = 3
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words inside ``width``-word windows that occur at least twice in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    span = 1
    while span < width:  # ids of 2-, 4- and 8-word windows, exactly
        step = min(span, width - span)
        pair = ids[: len(ids) - step] * (int(ids.max()) + 1) + ids[step:]
        distinct, ids = np.unique(pair, return_inverse=True)
        if len(distinct) == len(pair):
            return 0
        span += step
    twice = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, repeated words) of a text."""
    words = raw.split()
    joined = raw.translate(None, _BLANKS)
    points = int(np.count_nonzero((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(words), points, symbols, len(lines) - len(set(lines)), repeated_words(words)


def band_of(size: int, bands) -> tuple[float, float]:
    """The limits at a length: between two given lengths they follow its logarithm."""
    at = math.log(max(1, size))
    after = next((i for i, b in enumerate(bands) if size <= b[0]), len(bands))
    if after in (0, len(bands)):
        return bands[min(after, len(bands) - 1)][1:]
    (n0, lo0, hi0), (n1, lo1, hi1) = bands[after - 1], bands[after]
    part = (at - math.log(n0)) / (math.log(n1) - math.log(n0))
    return lo0 + part * (lo1 - lo0), hi0 + part * (hi1 - hi0)


def ratios(raw: bytes, compressor, chunk_bytes: int = CHUNK_BYTES) -> tuple[float, list[tuple[int, float]]]:
    """The ratio of the whole text, and (size, ratio) of each chunk of a text of one chunk or more; the last one may be shorter."""
    whole = len(raw) / len(compressor.compress(raw)) if raw else 0.0
    if len(raw) < chunk_bytes:
        return whole, []
    parts = [raw[a : a + chunk_bytes] for a in range(0, len(raw), chunk_bytes)]
    return whole, [(len(p), len(p) / len(compressor.compress(p))) for p in parts]


def chunks_ok(out: list[bool], share: float = BAD_SHARE) -> bool:
    """Whether the chunks pass, given which of them are out of band."""
    return sum(out) <= share * len(out) and not any(a and b for a, b in zip(out, out[1:], strict=False))


def even(chunks: list[tuple[int, float]], chunk_bytes: int = CHUNK_BYTES, spread: float = SPREAD) -> bool:
    """Whether the ratios of whole chunks lie near each other."""
    full = [r for n, r in chunks if n == chunk_bytes]
    return not full or max(full) - min(full) <= spread


def verdict(raw: bytes, compressor, whole_bands=WHOLE_BANDS, chunk_bands=CHUNK_BANDS, chunk_bytes: int = CHUNK_BYTES) -> tuple[float, list[tuple[int, float]], list[bool], bool]:
    """(ratio, chunks, which of them are out of band, whether the text is inside all bands)."""

    def outside(n: int, r: float, bands) -> bool:
        lo, hi = band_of(n, bands)
        return not lo <= r <= hi

    whole, chunks = ratios(raw, compressor, chunk_bytes)
    out = [outside(n, r, chunk_bands) for n, r in chunks]
    return whole, chunks, out, not outside(len(raw), whole, whole_bands) and chunks_ok(out) and even(chunks, chunk_bytes)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_bands=WHOLE_BANDS, chunk_bands=CHUNK_BANDS, chunk_bytes: int = CHUNK_BYTES, level: int = LEVEL) -> DataFrame:
    """The counts, the ratios and the two verdicts of every text."""

    def run(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=level, write_content_size=False)
        for b in pieces(batches):
            rows = []
            for raw in utf8(b.column(1)):
                n_words, chars, symbols, lines, again = base_counts(raw)
                whole, chunks, out, inside = verdict(raw, packer, whole_bands, chunk_bands, chunk_bytes)
                rows.append((n_words, chars, symbols, lines, again, n_words < 20 or 100 * again > 30 * n_words, whole, min((r for _, r in chunks), default=whole), max((r for _, r in chunks), default=whole), sum(out), inside))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["id", *_NAMES])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, chunk_ratio_min double, chunk_ratio_max double, n_bad_chunks long, in_band boolean"
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(released(run), schema)
    return out.withColumn("kept", ~F.col("base_failed") & F.col("in_band")).withColumnRenamed("id", id_col)


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "chunk_ratio_min", "chunk_ratio_max", "n_bad_chunks", "in_band"]
