"""Byte-level BPE through a sentencepiece model that is written straight from a rank file.

The model is a protocol buffer with one piece per vocabulary entry.  Every byte stands for one
printable character, the score of a piece is its negative rank (the lowest rank merges first)
and the normaliser is the identity, so the library's BPE merges in rank order.  The unknown
piece, which the format demands, comes last: ids are ranks.  Pre-tokens are encoded one by one;
a pre-token that is itself an entry takes its rank directly, as rank-file encoders do.  Decoding
maps ids back to bytes.

Texts are encoded whole, whatever their length: pre-tokens go to the model in pieces of a few megabytes.
Nulls count as empty texts (no ids, no bytes).  Rows are independent: ties, repeated rows and
further columns do not matter, an empty table gives an empty result.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

#: Pre-tokens that a worker remembers; more only cost time, as they are encoded anew.
CACHE_ENTRIES = 800_000


def byte_alphabet() -> list[str]:
    """One printable character for each byte value."""
    return [chr(0x100 + b) for b in range(256)]


def read_ranks(data: bytes) -> list[bytes]:
    """The entries of a rank file (base64 piece, blank, rank), by rank."""
    ranks = {int(r): base64.b64decode(p) for p, r in (line.split() for line in data.splitlines() if line)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("the ranks of a vocabulary must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def serialise_model(entries: list[bytes]) -> bytes:
    """A sentencepiece BPE model (protocol buffer) with ``entries`` as pieces, in rank order."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    alphabet = byte_alphabet()
    model = pb.ModelProto()
    for rank, entry in enumerate(entries):
        model.pieces.add(piece="".join(alphabet[b] for b in entry), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    t, n = model.trainer_spec, model.normalizer_spec
    t.model_type = pb.TrainerSpec.BPE
    t.vocab_size = len(entries) + 1
    t.unk_id, t.bos_id, t.eos_id, t.pad_id = len(entries), -1, -1, -1
    t.treat_whitespace_as_suffix = t.byte_fallback = False
    n.name = "identity"
    n.precompiled_charsmap = b""
    n.add_dummy_prefix = n.remove_extra_whitespaces = n.escape_whitespaces = False
    return model.SerializeToString()


class Encoder:
    """Encodes texts with the serialised model; remembers frequent words.

    With this pattern a single blank before a visible character always opens a pre-token, so a
    text is cut at its blanks first and the pattern is only run on words not seen before.  Texts
    with neighbouring blanks go through the pattern as a whole.
    """

    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        import sentencepiece

        entries = read_ranks(rank_file)
        self.split = regex.compile(pattern).findall
        self.by_blank = pattern.startswith("'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|")
        self.whole = {e: np.uint32(i).tobytes() for i, e in enumerate(entries)}
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet())}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(entries))
        self.known: dict[str, bytes] = {}

    def pre_token(self, w: str) -> bytes:
        raw = w.encode("utf-8")
        got = self.whole.get(raw)
        if got is None:
            got = np.asarray(self.model.encode(raw.decode("latin-1").translate(self.alphabet)), "<u4").tobytes()
        return got

    def word(self, w: str) -> bytes:
        return b"".join(map(self.pre_token, self.split(w)))

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.by_blank or "  " in text or text[-1] == " ":
            return self.word(text)
        known = self.known
        # a word keeps the blank before it; a line end inside is kept apart from the words around
        words = text.replace(" ", "\x00 ").split("\x00") if "\x00" not in text else [(" " if i else "") + w for i, w in enumerate(text.split(" "))]
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            out = []
            for w in words:
                ids = known.get(w)
                if ids is None:
                    if "\n" in w:  # joins two words: rarely seen again
                        ids = self.lines(w)
                    else:
                        if len(known) >= CACHE_ENTRIES:
                            known.clear()
                        ids = known[w] = self.word(w)
                out.append(ids)
            return b"".join(out)

    def lines(self, w: str) -> bytes:
        """A word with line ends; one between two visible characters is a pre-token of its own."""
        end = self.known.get("\n")
        if end is None:
            end = self.known["\n"] = self.word("\n")
        parts, out = w.split("\n"), []
        for i, x in enumerate(parts):
            after = parts[i + 1] if i + 1 < len(parts) else None
            if after is not None and (not x or not after or x[-1].isspace() or after[0].isspace()):
                out.append(self.word("\n".join(parts[i:])))
                break
            ids = self.known.get(x)
            if ids is None:
                ids = self.word(x)
                if len(self.known) < CACHE_ENTRIES:
                    self.known[x] = ids
            out.append(ids if after is None else ids + end)
        return b"".join(out)


_ENCODERS: dict = {}


def _encoder(rank_file: bytes, pattern: str) -> Encoder:
    key = (hash(rank_file), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(rank_file, pattern)
    return _ENCODERS[key]


def _rank_bytes(docs: DataFrame, vocabulary: str):
    with open(vocabulary, "rb") as f:  # a vocabulary file is bounded; executors get its bytes
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): the ids of every text as little-endian unsigned 32-bit integers."""
    shared = _rank_bytes(docs, vocabulary)

    def run(batches):
        enc = None
        for b in pieces(batches):
            enc = enc or _encoder(shared.value, pattern)
            ids = [enc.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, ids binary")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``: the bytes of every id, by the inverse mapping."""
    shared = _rank_bytes(encoded, vocabulary)
    spot = encoded.columns.index(ids_col)

    def run(batches):
        entries = None
        for b in pieces(batches):
            if entries is None:
                entries = read_ranks(shared.value)
            texts = [b"".join(map(entries.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in b.column(spot).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary())], [*b.schema.names, "decoded"])

    from pyspark.sql.types import BinaryType, StructField, StructType

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))
