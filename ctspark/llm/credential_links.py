"""Secrets by pattern, and credentials whose parts are only telling together.

Three base kinds are found by fixed patterns: assignments of a secret's name, access key numbers and long
hexadecimal strings.  Beside them lie weaker candidates in three roles, found together by one pattern, leftmost first:

* ``id``, an access identifier: a value given to a name such as ``client_id`` or ``login``, a short or
  temporary access key number, an e-mail address;
* ``key``, a secret: a value given to a name such as ``pwd``, also one too short for the base kind; an opaque
  string of 20 and more with capitals, small letters and digits; 16 to 23 hexadecimal digits;
* ``endpoint``: a URL, a value given to a name such as ``host``, a host with its port.

One such candidate alone is mostly noise.  Parts are therefore joined by interval within their scope: the
scope is a paragraph (text between blank lines), and two parts meet if at most ``reach`` code points lie between
them.  Base spans are parts too (access numbers as ids, the others as keys) but need no partner.  An id is reported
if a key meets it, a key if an id or an endpoint does, an endpoint if an id and a key do.  A URL that holds a name
and a password is all three and is always reported.  Candidates that overlap a base span are not reported again.

The join is dealt by row, scope and cell of ``reach`` code points; a part lies in the cells it touches, its
partners' reach included, and a pair is compared in the first cell it shares.  So a long text, or a page of nothing
but candidates, is spread over many keys, and a part has no more partners than fit into its reach.

Null texts count as empty.  Repeated rows get equal spans.  Texts are read whole; every pattern takes a
bounded number of steps from any start, so a text's time grows with its length.  Ties: spans that start together are
ordered by kind as listed.  An empty table gives an empty result; further columns do not matter.  Offsets are
code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, released, settle

KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
REACH = 300


def any_case(names: str) -> str:
    """``names`` with each letter in either case; only ASCII letters match, whatever folds to them."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", names)


_IS = "[\"']?\\x20*[:=]\\x20*[\"']?"
#: Fixed patterns of the base kinds; the value of an assignment, its second group, has six characters or more.
ASSIGN = f"({any_case('password|passwd|secret|token|api_?key')}){_IS}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: The candidates: (role, pattern), tried in this order.
CANDIDATES = (
    ("endpoint", f"(?:{any_case('https?|ftps?|sftp|ssh|postgres(?:ql)?|mysql|mongodb(?:\\+srv)?|rediss?|amqps?')}|{any_case('jdbc')}:[A-Za-z]{{2,12}})://[^\\x20\\x09-\\x0D\"'<>]+"),
    ("id", f"(?:{any_case('access[_-]?key(?:[_-]?id)?|client[_-]?id|app[_-]?id|key[_-]?id|account|user(?:name)?|login')}){_IS}[A-Za-z0-9._@+-]{{3,}}"),
    ("key", f"(?:{any_case('password|passwd|secret|token|api_?key|passphrase|pass|pwd|private[_-]?key|credentials?|auth(?:orization)?')}){_IS}[A-Za-z0-9+/_.=-]{{3,}}"),
    ("id", "(?:AKIA|ASIA|AIDA|AROA)[A-Z0-9]{8,}"),
    ("endpoint", f"(?:{any_case('host(?:name)?|endpoint|server|database|bucket')}){_IS}[A-Za-z0-9._:/-]{{3,}}"),
    ("id", "[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\\.[A-Za-z0-9-]{1,63}){1,8}"),
    ("endpoint", "[A-Za-z0-9-]{1,63}(?:\\.[A-Za-z0-9-]{1,63}){1,8}:[0-9]{2,5}"),
    ("key", "[A-Za-z0-9+/-]{16,}={0,2}"),
)
PARTS = "|".join(f"({p})" for _, p in CANDIDATES)
#: The last candidate needs all of MIXED in 20 characters, or is SHORT_HEX with a digit and a letter.
MIXED = ("[A-Z]", "[a-z]", "[0-9]")
SHORT_HEX = "[0-9a-f]{16,23}"
#: A URL with a name and a password needs no partner.
LOGIN_URL = "://[^/@:]+:[^/@]+@"
SCOPE = "\n[\\x20\\x09\\x0D]*\n"

_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_PART = pa.struct([("scope", pa.int32()), ("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("role", pa.string()), ("weak", pa.bool_()), ("whole", pa.bool_())])
_BASE_ROLES = ("key", "id", "key")
#: What every named key's pattern holds, in small letters.
_NAMES = ("pass", "pwd", "secret", "token", "apikey", "api_key", "private", "credential", "auth")


class Scanner:
    """Base spans and parts of one text."""

    def __init__(self):
        self.assign, self.access, self.hex, self.parts, self.scope = map(re.compile, (ASSIGN, ACCESS, HEX, PARTS, SCOPE))
        self.run, self.digit, self.letter, self.short, self.login = map(re.compile, ("[A-Za-z0-9+/-]{16,}", "[0-9]", "[a-f]", SHORT_HEX, LOGIN_URL))
        self.mixed = [re.compile(p) for p in MIXED]

    def base(self, text: str, low: str) -> list[tuple[int, int, int]]:
        """(start, kind, end), by start, then kind."""
        out = []
        if any(name in low for name in ("password", "passwd", "secret", "token", "apikey", "api_key")):
            out += [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in self.access.finditer(text)]
        out += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        return sorted(out)

    def _opaque(self, s: str) -> bool:
        if len(s) >= 20 and all(p.search(s) for p in self.mixed):
            return True
        return bool(self.short.fullmatch(s) and self.digit.search(s) and self.letter.search(s))

    def _may_report(self, text: str, low: str) -> bool:
        """Whether any key can be among the parts; without one only a URL with a login is reported."""
        return "://" in text or any(name in low for name in _NAMES) or any(self.digit.search(m[0]) for m in self.run.finditer(text))

    def parts_of(self, text: str, low: str, base: list[tuple[int, int, int]]) -> list[dict]:
        """Base spans and candidates in order, with role and scope, if some might meet."""
        if not base and not self._may_report(text, low):
            return []
        covered = []
        for start, _, end in base:
            if covered and start < covered[-1][1]:
                covered[-1][1] = max(covered[-1][1], end)
            else:
                covered.append([start, end])
        starts = [c[0] for c in covered]
        found = []
        for m in self.parts.finditer(text):
            start, end = m.span()
            at = bisect_left(starts, end) - 1
            if (m.lastindex == len(CANDIDATES) and not self._opaque(m[0])) or (at >= 0 and covered[at][1] > start):
                continue
            role = CANDIDATES[m.lastindex - 1][0]
            found.append((start, KINDS.index(role), end, role, True, role == "endpoint" and self.login.search(m[0]) is not None))
        roles = {x[3] for x in found} | {_BASE_ROLES[k] for _, k, _ in base}
        if not found or ("key" not in roles and not any(x[5] for x in found)):
            return []
        found += [(start, k, end, _BASE_ROLES[k], False, False) for start, k, end in base]
        cuts = [m.end() for m in self.scope.finditer(text)]
        return [{"scope": bisect_right(cuts, x[0]), "start": x[0], "kind": x[1], "end": x[2], "role": x[3], "weak": x[4], "whole": x[5]} for x in sorted(found)]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, base, parts) of every row: the base spans, and the parts of texts in which some might meet."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        scanner = Scanner()
        for b in pieces(batches):
            bases, parts = [], []
            for text in b.column(2).to_pylist():
                low = text.lower()
                base = scanner.base(text, low)
                bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                parts.append(scanner.parts_of(text, low, base) or None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bases, pa.list_(_SPAN)), pa.array(parts, pa.list_(_PART))], ["row", "id", "base", "parts"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    spans, parts = (f"array<struct<{x}>>" for x in ("start: int, kind: int, end: int", "scope: int, start: int, kind: int, end: int, role: string, weak: boolean, whole: boolean"))
    return rows.mapInArrow(released(run), f"row long, id {kind}, base {spans}, parts {parts}")


def pairs(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Candidates with each part of another role that meets them: the columns of ``parts``, and the partner's as ``p_...``."""

    def cells(lo: Column, hi: Column) -> Column:
        return F.sequence(F.floor(lo / reach), F.floor(hi / reach))

    left = parts.where("weak").withColumn("cells", cells(F.col("start") - reach, F.col("end") + reach))
    left = left.withColumn("first", F.element_at("cells", 1)).withColumn("cell", F.explode("cells")).drop("cells")
    right = parts.select("row", "scope", *(F.col(c).alias(f"p_{c}") for c in ("start", "kind", "end", "role")), cells(F.col("start"), F.col("end") - 1).alias("cells"))
    right = right.withColumn("p_first", F.element_at("cells", 1)).withColumn("cell", F.explode("cells")).drop("cells")
    near = (F.col("p_start") <= F.col("end") + reach) & (F.col("start") <= F.col("p_end") + reach)
    met = left.join(right, ["row", "scope", "cell"]).where((F.col("role") != F.col("p_role")) & near & (F.col("cell") == F.greatest("first", "p_first")))
    return met.drop("cell", "first", "p_first")


def reported(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, kind, start, end) of the candidates whose complementary parts are there."""
    met = pairs(parts, reach).groupBy("row", "kind", "start", "end", "role").agg(*(F.max((F.col("p_role") == r).cast("int")).alias(f"by_{r}") for r in ("id", "key", "endpoint")))
    told = F.when(F.col("role") == "id", F.col("by_key") == 1).when(F.col("role") == "key", (F.col("by_id") == 1) | (F.col("by_endpoint") == 1))
    told = told.otherwise((F.col("by_id") == 1) & (F.col("by_key") == 1))
    return met.where(told).select("row", "kind", "start", "end").union(parts.where("whole").select("row", "kind", "start", "end"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """(row, id, base, spans) of every row; spans are array<struct<start, kind, end>>, the base spans among them."""
    rows = settle(scan(docs, id_col, text_col), "scan")
    parts = rows.where("parts is not null").select("row", F.explode("parts").alias("x")).select("row", "x.*")
    more = reported(parts, reach).groupBy("row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))
    more = settle(more, "linked")  # its size is known then, and the join is planned by it
    out = rows.drop("parts").join(more, "row", "left")
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return out.select("row", F.col("id").alias(id_col), "base", spans.alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row a document: counts of the base kinds, the base spans' digest, all spans written out."""

    def of_kind(i: int):
        return lambda x: x["kind"] == i

    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    return found.select(id_col, *counts, F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
