"""Sum-of-squares packing of token sequences into windows of a fixed size.

Documents are packed online.  Full windows are cut off a long document; what is left over goes
into a window by the sum-of-squares rule: with N(h) open windows filled up to h, the piece goes
where the sum of all N(h) squared is smallest afterwards.  The level array N is all the state
that the choice needs.  A window that is full, or filled to a power of two, needs no padding and
does not count as partially filled; it is still open to later pieces.

Every input partition is packed on its own, so nothing is gathered; a partition's last partial
windows are merged by cutting their pieces, and the single one left is cut at powers of two.
Padding is therefore zero whatever the partitioning.  The result depends on the order of rows
within a partition, and a sequence id holds the partition's number.

Ties of the rule go to the fullest window.  A text of any length is tokenized whole and cut into as many windows as it
fills.  ``spanning`` says that a tokenizer's pre-tokens may hold white space; it is tried on a few strings, and a
tokenizer that needs it and is used without raises an error.
Nulls count as empty texts, which have the closing id alone.  Repeated rows are packed one by one.
An empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import zlib
from struct import pack as packed
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, released

WINDOW = 2048
CLOSING_ID = 1
#: Words that a worker remembers the ids of, about 150 MB.
CACHE_ENTRIES = 800_000
#: Bytes of text that a worker takes together.
PIECE = 16 << 20


def byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes with: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Stands between words that are encoded together.
_MARK = "|"


class WordTokenizer:
    """Ids of a text by a tokenizer whose pre-tokens never span white space; words are remembered.

    Strings of added tokens in a text get their ids, as the tool gives them.
    """

    def __init__(self, data: bytes, spanning: bool = False):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_str(data.decode())
        self.known: dict[str, bytes] = {}
        self.spanning = spanning
        self.bytes = byte_characters()
        self.model = self.tool.model
        marks = self.tool.encode(_MARK, add_special_tokens=False).ids
        if not spanning:  # words apart must give what they give together
            for text in ("a b", "A  b\n c", "1 2", "x\ty ."):
                apart = [i for w in text.replace("\n", " ").split(" ") for i in self.tool.encode(w, add_special_tokens=False).ids]
                if apart != self.tool.encode(text, add_special_tokens=False).ids:
                    raise ValueError("this tokenizer's tokens hold white space: set spanning")
        # whether a word of letters goes to the merges as it is: lower case, byte level, nothing else
        probe = [w for w in ("the", "caf\u00e9", "\u65e5\u672c", "Uml\u00e4ut") if self._letters(w.lower()) != np.asarray(self.tool.encode(w, add_special_tokens=False).ids, "<u4").tobytes()]
        self.simple = not probe
        self.mark = marks[0] if len(marks) == 1 else -1  # a tokenizer without a one-id mark encodes word by word
        #: Words that hold one of these go to the tool as they are.
        self.added = tuple(t.content for t in self.tool.get_added_tokens_decoder().values())

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of each word: they are encoded as one text with a mark between them."""
        raw = np.asarray(self.tool.encode(f" {_MARK} ".join(words), add_special_tokens=False).ids, "<u4")
        cut = np.flatnonzero(raw == self.mark)
        if len(cut) != len(words) - 1:
            return [np.asarray(e.ids, "<u4").tobytes() for e in self.tool.encode_batch_fast(words, add_special_tokens=False)]
        ids, ends = raw.tobytes(), [*cut.tolist(), len(raw)]
        return [ids[4 * a : 4 * b] for a, b in zip([0, *(c + 1 for c in ends[:-1])], ends, strict=True)]

    def _letters(self, word: str) -> bytes:
        """The ids of a normalised word of letters, which is one pre-token: the merges alone."""
        # printable ASCII stands for itself
        mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.bytes)
        return packed(f"<{len(found := self.model.tokenize(mapped))}I", *[t.id for t in found])

    def _learn(self, words: set[str]) -> None:
        known, stems, rest, simple = self.known, {}, set(), self.simple
        for w in words:  # a full stop or comma behind a letter is a pre-token of its own
            stem, end = (w[:-1], w[-1]) if len(w) > 1 and w[-1] in ".," and w[-2].isalpha() else (w, "")
            low = stem.lower()
            if simple and low.isalpha() and (stem.isascii() or ("\u03a3" not in stem and is_normalized("NFC", stem) and is_normalized("NFC", low))):
                stems[w] = low, end
            else:
                rest.add(w)
        if stems:
            rest |= {".", ","} - known.keys()
        apart = {w for w in rest if _MARK in w}
        for added in self.added:
            if _MARK not in added:
                apart.update(w for w in rest if added in w)
        plain = [w for w in rest if w not in apart]
        for at in range(0, len(plain), 4000):
            part = plain[at : at + 4000]
            known.update(zip(part, self._ids(part), strict=True))
        for w in apart:
            known[w] = np.asarray(self.tool.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        for w, (low, end) in stems.items():
            ids = known.get(low)
            if ids is None:
                ids = known[low] = self._letters(low)
            known[w] = ids + known[end] if end else ids

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if self.spanning:
            return [np.asarray(e.ids, "<u4").tobytes() for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)]
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known = self.known
        new = set().union(*split).difference(known)
        if new:
            self._learn(new)
        return [b"".join(map(known.__getitem__, words)) for words in split]


class LevelArray:
    """Numbers of open windows by fill level, and the sum-of-squares choice."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        counted = np.ones(window + 1, bool)
        counted[0] = counted[window] = False
        p = 1
        while p <= window:
            counted[p] = False
            p *= 2
        self.counted = counted

    def choose(self, size: int) -> int:
        """The level (0: a new window) to put a piece of ``size`` on."""
        n, top = self.count, self.window - size
        levels = np.flatnonzero(n[: top + 1])
        levels = levels[levels > 0]
        options = np.concatenate([[0], levels])
        after = options + size
        # moving a window from h to h + size changes the sum by 2 N(h + size) + 1 and -(2 N(h) - 1)
        gain = np.where(self.counted[after], 2 * n[after] + 1, 0) - np.where(self.counted[options], 2 * n[options] - 1, 0)
        best = np.flatnonzero(gain == gain.min())
        return int(options[best[-1]])  # ties: the fullest

    def move(self, level: int, size: int) -> None:
        if level:
            self.count[level] -= 1
        if level + size < self.window:
            self.count[level + size] += 1


class Packer:
    """Packs one partition; rows are (row, start, length, crc, total, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        self.levels = LevelArray(window)
        self.open: dict[int, list[list]] = {}  # level: windows; a window is a list of (document, start, ids, total)

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def _rows(self, window: list) -> list[tuple]:
        sequence, offset, out = self._new(), 0, []
        for doc, start, ids, total in window:
            n = len(ids) // 4
            out.append((doc, start, n, zlib.crc32(ids), total, sequence, offset))
            offset += n
        return out

    def add(self, doc, ids: bytes) -> list[tuple]:
        total, at, out = len(ids) // 4, 0, []
        while total - at >= self.window:
            out += self._rows([(doc, at, ids[4 * at : 4 * (at + self.window)], total)])
            at += self.window
        size = total - at
        if size:
            level = self.levels.choose(size)
            self.levels.move(level, size)
            into = self.open[level].pop() if level else []
            into.append((doc, at, ids[4 * at :], total))
            if level + size == self.window:
                out += self._rows(into)
            else:
                self.open.setdefault(level + size, []).append(into)
        return out

    def finish(self) -> list[tuple]:
        """Close windows at a power of two as they are; merge the others, cutting pieces."""
        out, rest = [], []
        for level in sorted(self.open, reverse=True):
            for w in self.open[level]:
                if self.levels.counted[level]:
                    rest += w
                else:
                    out += self._rows(w)
        left = sum(len(ids) for _, _, ids, _ in rest) // 4
        target, current, filled = 0, [], 0
        for doc, start, ids, total in rest:
            at, n = 0, len(ids) // 4
            while at < n:
                if not filled:
                    target = min(self.window, 1 << (left.bit_length() - 1))
                take = min(n - at, target - filled)
                current.append((doc, start + at, ids[4 * at : 4 * (at + take)], total))
                at, filled, left = at + take, filled + take, left - take
                if filled == target:
                    out += self._rows(current)
                    current, filled = [], 0
        return out


def pack(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, closing_id: int = CLOSING_ID, id_col: str = "doc_id", text_col: str = "text", spanning: bool = False, remember: bool = True) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``spanning`` must be set for a tokenizer whose pre-tokens can hold white space.  A worker remembers words
    for its next task, which spares a sixth of the time, unless ``remember`` is off to leave the room to other work.
    """
    with open(tokenizer_file, "rb") as f:  # a vocabulary file is bounded; executors get its bytes
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.uint32(closing_id).tobytes()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        tool, packer, id_type = None, None, None
        for b in pieces(batches, PIECE):
            if tool is None:
                tool = _tokenizer(shared.value, spanning)
                packer = Packer(window, TaskContext.get().partitionId() << 33)
                id_type = b.schema.field(0).type
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), tool.encode_all([t or "" for t in b.column(1).to_pylist()]), strict=True):
                rows += packer.add(doc, ids + end)
            if rows:
                yield _batch(rows, id_type)
        if packer and (rows := packer.finish()):
            yield _batch(rows, id_type)
        if tool and not remember:
            tool.known.clear()

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(released(run), schema).withColumnRenamed("id", id_col)


_TOOLS: dict = {}


def _tokenizer(data: bytes, spanning: bool) -> WordTokenizer:
    key = (hash(data), spanning)
    if key not in _TOOLS:
        _TOOLS.clear()
        _TOOLS[key] = WordTokenizer(data, spanning)
    return _TOOLS[key]


def _batch(rows: list[tuple], id_type) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])], ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
