"""Repeated strings by suffix sorting with a difference cover, distributed by content.

Every byte covered by a string of ``width`` bytes that also starts anywhere else goes.

1. Routing.  Each window of ``width`` bytes has an anchor: the lowest-hashed ``gram`` of bytes in it.
   Equal windows have equal anchors at the same place, so windows can only repeat within the group
   of one anchor.  Anchors are counted over the corpus; windows whose anchor occurs once are settled.
   Neighbouring windows with one anchor form a context, a few hundred bytes; equal contexts are
   collapsed into one with a count before any text is shuffled.
2. Suffix sorting.  Contexts are shuffled by anchor.  A task sorts the suffixes of whole anchor groups
   with the difference cover modulo 3: sampled triples are sorted and named, the string of names is
   sorted recursively (until names are unique or cover ``width`` bytes), the remaining suffixes are
   sorted by first symbol and the rank behind it, and both are merged.
   An anchor with very many different contexts (the edges of a passage in many texts) is dealt a second time, by the
   hash of each whole window, so that it never is one task's work.
3. Neighbours in suffix order are compared over ``width`` bytes; starts that agree are repeated, and so
   are all starts of a context that occurs more than once.
4. The repeated starts go back to the documents' rows and become removed runs of bytes.

Texts of any length are read whole, a megabyte at a time; ties do not arise.  Null texts count as empty; texts shorter than ``width`` have no string to remove.  Repeated rows
repeat each other's text.  An empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Temporary, bitmap, filter_bits, pieces, release, released, settle, utf8

WIDTH = 200
GRAM = 50
#: Bytes of text that a worker takes together.
PIECE = 8 << 20
#: Bytes that one suffix sort takes together, unless a single anchor's contexts are more.
SORT_BYTES = 1 << 20
#: Different contexts of one anchor that one task sorts together, about a megabyte; the windows of more meet by their hashes.
MANY = 4096
_BASE = 0x9E3779B97F4A7C15 | 1
_SLICE = 1 << 20


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


_POWERS = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", _inverse(_BASE))):
                a = np.full(n + 1, np.uint64(base & 0xFFFFFFFFFFFFFFFF))
                a[0] = 1
                _POWERS[name] = np.multiply.accumulate(a)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each position on."""
    n = len(data)
    up, down = _powers(max(1 << 12, 1 << int(n).bit_length()))
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    n = len(a)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = a
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def contexts(raw: bytes, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, anchor hash) of a text's contexts, which tile its windows."""
    if len(raw) < width:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    data, parts = np.frombuffer(raw, np.uint8), []
    w, mask = width - gram + 1, np.uint64(_SLICE - 1)
    for at in range(0, len(raw) - width + 1, _SLICE - width):
        h = gram_hashes(data[at : at + _SLICE - 1], gram)
        if len(h) < w:
            break
        keyed = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
        spot = (_sliding_min(keyed, w) & mask).astype(np.int64)
        cut = np.concatenate([[0], np.flatnonzero(np.diff(spot)) + 1])
        parts.append((cut + at, np.diff(np.concatenate([cut, [len(spot)]])), h[spot[cut]].view(np.int64)))
    starts, counts, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    if len(parts) > 1:  # slices share windows: each start belongs to the first context that has it
        ends = np.maximum.accumulate(starts + counts)
        first = np.maximum(starts, np.concatenate([[0], ends[:-1]]))
        counts = starts + counts - first
        keep = counts > 0
        starts, counts, hashes = first[keep], counts[keep], hashes[keep]
    return starts, counts, hashes


def suffix_ranks(s: np.ndarray, covered: int, width: int) -> np.ndarray:
    """Ranks of the suffixes of ``s`` (symbols from 0 on), right over ``width`` bytes at least.

    A symbol stands for ``covered`` bytes.
    """
    n = len(s)
    if n < 4:
        return np.array([sorted(range(n), key=lambda i: tuple(s[i:])).index(i) + 1 for i in range(n)], np.int64)
    t = np.concatenate([s + 1, np.zeros(4, np.int64)])
    i1, i2, i0 = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([i1, i2])
    k = int(t.max()) + 1
    # sort the sampled triples and name them
    names = _dense(_dense(t[sample] * k + t[sample + 1]) * k + t[sample + 2]) if k > 2_000_000 else _dense((t[sample] * k + t[sample + 1]) * k + t[sample + 2])
    if 3 * covered < width and int(names.max()) + 1 < len(names):
        # a zero between both halves: the first half's last triple ends in the padding
        names = suffix_ranks(names, 3 * covered, width)
    rank = np.zeros(n + 5, np.int64)
    rank[sample] = names + 1
    rank[n:] = 0
    m = int(rank.max()) + 1
    # remaining suffixes: first symbol, then the rank behind it
    k0 = t[i0] * m + rank[i0 + 1]
    o0 = np.argsort(k0, kind="stable")
    k0 = k0[o0]
    i0 = i0[o0]
    real = i1[i1 < n]
    k1 = t[real] * m + rank[real + 1]
    both = _dense(np.concatenate([t[i0] * k + t[i0 + 1], t[i2] * k + t[i2 + 1]]))
    k02, k2 = both[: len(i0)] * m + rank[i0 + 2], both[len(i0) :] * m + rank[i2 + 2]
    # merge: a suffix's place is the number of smaller ones of either kind
    place = np.empty(n, np.int64)
    s1, s2 = np.sort(k1), np.sort(k2)
    place[i0] = np.arange(len(i0)) + np.searchsorted(s1, k0) + np.searchsorted(s2, k02)
    order = np.argsort(np.concatenate([rank[real], rank[i2]]), kind="stable")
    among = np.empty(len(order), np.int64)
    among[order] = np.arange(len(order))
    place[real] = among[: len(real)] + np.searchsorted(k0, k1, side="right")
    place[i2] = among[len(real) :] + np.searchsorted(np.sort(k02), k2, side="right")
    return place


def _dense(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1].astype(np.int64, copy=False)


def repeated_starts(texts: list[bytes], starts: list[int], width: int = WIDTH) -> list[np.ndarray]:
    """For each text, which of its first ``starts`` windows are found again in any of the texts."""
    joined = b"\x00".join(texts) + b"\x00"
    size = np.array([len(t) + 1 for t in texts])
    base = np.concatenate([[0], np.cumsum(size)[:-1]])
    data = np.frombuffer(joined, np.uint8)
    symbols = data.astype(np.int64) + 1
    symbols[base + size - 1] = 0
    where = np.concatenate([np.arange(b, b + n) for b, n in zip(base, starts, strict=True)])
    rank = suffix_ranks(symbols, 1, width)
    where = where[np.argsort(rank[where], kind="stable")]
    again = np.zeros(len(data), bool)
    # compare adjacent prefixes, eight bytes at a time, only as long as they agree
    left = np.arange(len(where) - 1)
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    for at in range(0, width, 8):
        span = min(8, width - at)
        a, b = where[left] + at, where[left + 1] + at
        left = left[(windows[a, :span] == windows[b, :span]).all(axis=1)] if len(left) else left
    again[where[left]] = True
    again[where[left + 1]] = True
    return [again[b : b + n] for b, n in zip(base, starts, strict=True)]


def _spans(flags: np.ndarray, width: int) -> list[int]:
    """Covered runs as start, end, start, end ... relative to the first start."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > width)
    return np.c_[at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + width].ravel().tolist()


def _filter_of(repeated: DataFrame) -> np.ndarray:
    """A Bloom filter with two bits a hash from the settled column ``h``, sized by their number."""
    power = filter_bits(2 * repeated.count())
    mask = (1 << power) - 1
    spots = repeated.select(F.explode(F.array(F.col("h").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(mask)))).alias("b"))
    return bitmap(spots, power)


def _hit(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bits) * 32 - 1)
    out = np.ones(len(h), bool)
    for b in (h.view(np.uint64) & mask, (h.view(np.uint64) >> np.uint64(32)) & mask):
        out &= (bits[(b >> np.uint64(5)).astype(np.int64)] >> (b & np.uint64(31)).astype(np.uint32)) & 1 == 1
    return out


_OCC = [("start", pa.int64()), ("n", pa.int64()), ("h", pa.int64()), ("key", pa.binary())]


def _texts(docs: DataFrame, text_col: str, width: int, gram: int, all_texts: bool) -> DataFrame:
    """``docs`` with ``raw``, the text's bytes, ``n_bytes``, ``sha`` and ``occ``, its contexts with an anchor that may be repeated.

    ``raw`` is left out (and ``sha``, its hash, is there) for texts without any, unless ``all_texts``.
    """

    def anchors(batches):
        for b in pieces(batches, PIECE):
            found = [contexts(r, width, gram)[2] for r in utf8(b.column(0))]
            h, c = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(np.minimum(c, 2), pa.int64())], ["h", "c"])

    text = F.col(text_col).cast("string").alias("text")
    repeated = settle(docs.select(text).mapInArrow(released(anchors), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where("c > 1").select("h"), "anchors")
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(repeated))
    release(repeated)
    others = [c for c in docs.columns if c != text_col]

    def split(batches):
        from xxhash import xxh3_128_digest

        for b in pieces(batches, PIECE):
            out = []
            for raw in utf8(b.column(0)):
                starts, counts, hashes = contexts(raw, width, gram)
                hit = np.flatnonzero(_hit(shared.value, hashes)) if len(hashes) else []
                occ = [{"start": int(starts[i]), "n": int(counts[i]), "h": int(hashes[i]), "key": xxh3_128_digest(raw[starts[i] : starts[i] + counts[i] + width - 1])} for i in hit]
                keep = all_texts or bool(occ)
                out.append((len(raw), None if keep else hashlib.sha256(raw).hexdigest(), raw if keep else None, occ or None))
            cols = list(zip(*out, strict=True))
            made = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.list_(pa.struct(_OCC)))]
            yield pa.RecordBatch.from_arrays([*(b.column(i + 1) for i in range(len(others))), *made], [*others, "n_bytes", "sha", "raw", "occ"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return settle(docs.select(text, *(f"`{c}`" for c in others)).mapInArrow(released(split), f"{kinds}, n_bytes long, sha string, raw binary, occ array<struct<start: long, n: long, h: long, key: binary>>"), "texts")


def _runs(rows: DataFrame, width: int) -> DataFrame:
    """(row, spans) of the texts that lose bytes, as start, end, start, end ..."""
    places = rows.where("occ is not null").select("row", F.explode("occ").alias("o")).select("row", "o.*")
    distinct = places.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("row", "start", "n", "h")).alias("x")).select("key", "c", "x.*")
    hot = settle(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > MANY).select(F.col("h").alias("hot")), "hot")
    rare = hot.isEmpty()
    if rare:
        distinct = distinct.withColumn("hot", F.lit(None).cast("long"))
    else:
        distinct = distinct.join(hot, F.col("h") == F.col("hot"), "left")
    wanted = distinct.groupBy("row").agg(F.collect_list(F.struct("key", "c", "start", "n", "h", F.col("hot").isNotNull().alias("hot"))).alias("xs"))
    strings = rows.where("occ is not null").select("row", "raw").join(wanted, "row")
    # cut before they are told apart, so that no text is copied to each of its contexts
    cut = f"transform(xs, x -> struct(x.h, x.key, x.c, x.n, x.hot, substring(raw, cast(x.start + 1 as int), cast(x.n + {width - 1} as int)) AS s))"
    strings = strings.select(F.explode(F.expr(cut)).alias("x")).select("x.*")
    strings = strings if rare else settle(strings, "contexts")
    few = strings.where("not hot").drop("hot").repartition("h").sortWithinPartitions("h")
    marked = few.mapInArrow(released(_sorter(width)), "key binary, spans array<long>")
    marked = settle(marked if rare else marked.unionByName(_by_windows(strings.where("hot"), width)), "marked")
    runs = places.join(marked, "key").groupBy("row").agg(F.flatten(F.collect_list(F.transform("spans", lambda x: x + F.col("start")))).alias("spans"))
    return settle(runs, "runs")


def _by_windows(strings: DataFrame, width: int) -> DataFrame:
    """(key, spans) of contexts whose anchor has very many: their windows meet by the hash of the whole window.

    Equal windows still meet, and an anchor's windows spread over as many keys as there are different ones.
    """

    def windows(batches):
        from xxhash import xxh3_128_digest

        for b in pieces(batches, 1 << 20, 512):
            keys, c, n, s = (b.column(i).to_pylist() for i in range(4))
            made = [(xxh3_128_digest(s[i][at : at + width]), keys[i], at, c[i]) for i in range(len(keys)) for at in range(n[i])]
            if made:
                cols = list(zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (pa.binary(), pa.binary(), pa.int32(), pa.int64()), strict=True)], ["w", "key", "at", "c"])

    def spans(batches):
        for b in batches:
            out = []
            for at in b.column(1).to_pylist():
                flags = np.zeros(max(at) + 1, bool)
                flags[at] = True
                out.append(_spans(flags, width))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64()))], ["key", "spans"])

    found = strings.select("key", "c", "n", "s").mapInArrow(released(windows), "w binary, key binary, at int, c long")
    again = found.groupBy("w").agg(F.sum("c").alias("times")).where("times > 1").select("w")
    starts = found.join(again, "w").groupBy("key").agg(F.collect_set("at").alias("at"))
    return starts.mapInArrow(spans, "key binary, spans array<long>")


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, n_bytes, n_removed, n_spans, kept_sha256, kept, kept_text) of every text.

    ``kept`` holds the remaining bytes of texts that lost some, and is null for the others;
    ``kept_text`` is its text, without characters of which only some bytes are left.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    with Temporary() as tables:
        rows = tables.keep(_texts(src, "text", width, gram, False))
        runs = tables.keep(_runs(rows, width))
    hurt = rows.where("raw is not null").select("row", "id", "n_bytes", "raw").join(runs, "row", "left").mapInArrow(released(_cutter), f"row long, id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string")
    whole = rows.where("raw is null").select("row", "id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"), F.lit(None).cast("string").alias("kept_text"))
    return whole.unionByName(hurt).withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with repeated strings cut out of their texts, and ``size_col`` of these set anew where there is one.

    What remains is decoded again; a character of which only some bytes repeat is dropped.  Rows are
    told apart by number, so ids may be null or repeat; ids themselves do not matter.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").isNull().alias("none"), *(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    with Temporary() as tables:
        rows = tables.keep(_texts(src, names[text_col], width, gram, True))
        runs = tables.keep(_runs(rows, width))
    text = pa.string()

    def cut(batches):
        for b in batches:
            out = []
            for raw, spans, none in zip(*(b.column(c).to_pylist() for c in ("raw", "spans", "none")), strict=True):
                if not spans:
                    out.append((None if none else raw.decode("utf-8", "replace"), False))
                else:
                    out.append((_cut(raw, spans)[0].decode("utf-8", "ignore"), True))
            made = [pa.array([x[0] for x in out], text), pa.array([x[1] for x in out])]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in others), *made], [*others, "text", "changed"])

    others = [n for c, n in names.items() if c != text_col]
    kinds = "".join(f"{n} {docs.schema[c].dataType.simpleString()}, " for c, n in names.items() if c != text_col)
    found = rows.join(runs, "row", "left").select("raw", "spans", "none", *others).mapInArrow(released(cut), f"{kinds}text string, changed boolean")
    columns = []
    for c, n in names.items():
        if c == text_col:
            columns.append(F.col("text").cast(docs.schema[c].dataType).alias(c))
        elif c == size_col:
            columns.append(F.when(F.col("changed"), F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(n)).alias(c))
        else:
            columns.append(F.col(n).alias(c))
    return found.select(*columns)


def _cut(raw: bytes, spans: list[int]) -> tuple[bytes, np.ndarray]:
    """The bytes that the spans leave, and which are gone."""
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, spans[0::2], 1)
    np.add.at(edge, spans[1::2], -1)
    gone = np.cumsum(edge[:-1]) > 0
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), gone


def _sorter(width: int):
    def run(batches):
        held, size, last = [], 0, None

        def done():
            # an anchor with a single context has nothing to compare it with
            groups = {}
            for i, x in enumerate(held):
                groups.setdefault(x[4], []).append(i)
            rows = [i for g in groups.values() if len(g) > 1 for i in g]
            flags = dict(zip(rows, repeated_starts([held[i][1] for i in rows], [held[i][2] for i in rows], width), strict=True)) if rows else {}
            keys, spans = [], []
            for i, (key, _, n, c, _) in enumerate(held):
                found = [0, n + width - 1] if c > 1 else _spans(flags[i], width) if i in flags else []
                if found:
                    keys.append(key)
                    spans.append(found)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(spans, pa.list_(pa.int64()))], ["key", "spans"])

        for b in batches:
            for h, key, c, n, s in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if size >= SORT_BYTES and h != last:
                    yield done()
                    held, size = [], 0
                held.append((key, s, n, c, h))
                size, last = size + len(s), h
        if held:
            yield done()

    return run


def _cutter(batches):
    for b in pieces(batches, PIECE):
        out = []
        for raw, spans in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
            if not spans:
                out.append((0, 0, hashlib.sha256(raw).hexdigest(), None, None))
                continue
            kept, gone = _cut(raw, spans)
            out.append((int(gone.sum()), int(gone[0]) + int(np.count_nonzero(np.diff(gone.astype(np.int8)) == 1)), hashlib.sha256(kept).hexdigest(), kept, kept.decode("utf-8", "ignore")))
        cols = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.string())], ["row", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"])
