"""Per-value IDNA helper for host names that are not plain ASCII.

Plain ASCII hosts are normalised natively (see ``operators/hosts.py``); only names with a
non-ASCII character, or with ``--`` in them (``xn--`` labels and others that the hyphen rule forbids), reach this
helper, either inside the certificate Arrow stage or through the Arrow-batched ``idna_to_ascii_udf``.

Names are mapped for lookup (UTS #46, non-transitional, no STD3 rules).  A label that starts with ``xn--`` is decoded
and must be what the mapping gives: normalised, of valid characters.  Labels, decoded ones too, have no hyphen at either end, none at
both their third and fourth place, no leading combining mark, joiners in their contexts only, and fit the bidirectional
rule if any label is written from right to left.  Empty labels are left to the suffix lookup.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:  # the idna package implements UTS #46 lookup mapping
    import idna as _idna
except ImportError:  # pragma: no cover - stdlib IDNA 2003 fallback
    _idna = None

# Go's strings.TrimSpace white-space set.
GO_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"


def go_trim_py(s: str) -> str:
    return s.strip(GO_SPACE)


def normalize_host_py(s: str) -> str:
    """lower -> drop one leading '*.' -> trim dots -> IDNA ToASCII; '' when conversion fails."""
    h = s.lower()
    if h.startswith("*."):
        h = h[2:]
    h = h.strip(".")
    if h.isascii() and "--" not in h:
        return "" if _hyphen_edge(h.split(".")) else h
    try:
        return _lookup_ascii(h) if _idna is not None else h.encode("idna").decode("ascii")
    except Exception:  # noqa: BLE001 - whatever is wrong with a name, it has no host
        return ""


def _hyphen_edge(labels: list[str]) -> bool:
    return any(x and (x[0] == "-" or x[-1] == "-") for x in labels)


def _checked(label: str) -> None:
    if not label:
        return
    if (len(label) > 4 and label[2:4] == "--") or _hyphen_edge([label]):
        raise ValueError("hyphens at wrong places")
    if label.isascii():
        return
    _idna.check_initial_combiner(label)
    for at, c in enumerate(label):
        if c in "\u200c\u200d" and not _idna.valid_contextj(label, at):
            raise ValueError("joiner out of context")


def _lookup_ascii(host: str) -> str:
    labels = _idna.uts46_remap(host, std3_rules=False, transitional=False).split(".")
    plain = []
    for label in labels:
        if label.startswith("xn--"):
            label = label[4:].encode("ascii").decode("punycode")
            if _idna.uts46_remap(label, std3_rules=False, transitional=False) != label:
                raise ValueError("not the normal form of its label")
        _checked(label)
        plain.append(label)
    if any(unicodedata.bidirectional(c) in ("R", "AL", "AN") for x in plain for c in x):
        for label in plain:
            if label:
                _idna.check_bidi(label, check_ltr=True)
    return ".".join(x if x.isascii() else "xn--" + x.encode("punycode").decode("ascii") for x in plain)


def needs_lookup(s: str | None) -> bool:
    """Whether a name cannot be normalised natively."""
    return s is not None and (not s.isascii() or "--" in s)


def normalize_if_needed(s):
    return normalize_host_py(s) if needs_lookup(s) else None


@F.pandas_udf(T.StringType())
def idna_to_ascii_udf(s: pd.Series) -> pd.Series:
    """Normalised hosts; callers pass null for rows that need no lookup."""
    return s.map(lambda v: None if v is None else normalize_host_py(v))
