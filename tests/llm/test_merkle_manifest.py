"""Merkle manifest against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest

from ctspark.llm import merkle_manifest as mm

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree long, n long, lo long, digest string, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, text):
    parts = []
    for v in (*row[:4], text):
        raw = None if v is None else str(v).encode()
        parts.append("-" if raw is None else f"{len(raw)}:{raw.decode()}")
    return h(*parts)


def levels(nodes):
    """Levels of (digest, leaves below) up to one node, and each leaf's path as (left, right)."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
            paths[i].append((run[: at % 16], run[at % 16 + 1 :]))
        where = [at // 16 for at in where]
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded) of rows (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, brute_leaf(r, r[4]), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names}
    root, tops = levels([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        subroot, paths = trees[s]
        for (_, _, own, r), path in zip(sorted(by[s], key=lambda x: x[:3]), paths, strict=True):
            given = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                given = brute_leaf(r, r[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            for left, right in path + top:
                given = h(*left, given, *right)
            out.append((r[0], own, subroot, root, h(*(d for left, right in path + top for d in (*left, *right))), given))
    return sorted(out, key=str)


def spark_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, "x", "y") for r in rows], SCHEMA).repartition(5)
    from pyspark.sql import functions as F

    given = mm.leaf([F.col(c) if c != "text" else mm.lowered(F.col(c)) for c in FIELDS])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    m = mm.build(df, FIELDS, keep={"given": F.when(tampered, given)})
    found = mm.proofs(m).select("order", "digest", "subroot", F.lit(m.root), mm.proof_digest(F.col("path")), mm.folded(F.coalesce("kept_given", "digest"), F.col("path")))
    return sorted((tuple(r) for r in found.collect()), key=str)


def corpus(sizes, seed=3):
    rng = random.Random(seed)
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            at += rng.randint(1, 4)
            text = rng.choice([None, "", "Élan VITAL Ünder K", "plain Text", "a" * rng.randint(1, 50), "X" * 9])
            rows.append((at, source, rng.choice([None, "en", "de"]), rng.choice([None, len(text or "")]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, None: 1}, {"a": 300, "": 16, "é": 17, "z": 257, None: 1, "B": 33}, {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_against_brute_force(spark, sizes):
    rows = corpus(sizes)
    assert spark_rows(spark, rows) == brute(rows)


def test_repeated_rows_null_ids_and_long_texts(spark):
    rows = corpus({"a": 20, "b": 3})
    rows += [rows[0]] * 18 + [(None, "a", "en", 1, "Null Id"), (None, "a", None, None, None), (7, "a", "en", 2, "other text"), (7, "a", "en", 2, "another Text"), (9_999, "b", "en", None, "Long TEXT " * 200_000)]
    assert spark_rows(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert spark_rows(spark, []) == []


def test_interval_labels_cover_their_children(spark):
    df = spark.createDataFrame([(*r, 1, 2, 3, "x", "y") for r in corpus({"a": 300, "b": 5})], SCHEMA)
    m = mm.build(df, FIELDS)
    of_a = [sorted((r["lo"], r["hi"]) for r in level.where("n = 300").collect()) for level in m.levels[1:]]
    assert of_a == [[(0, 256), (256, 300)], [(0, 300)]]
    for level in m.levels:
        for r in level.collect():
            assert r["lo"] == r["run"][0]["lo"] and r["hi"] == r["run"][-1]["hi"]
            assert all(a["hi"] == b["lo"] for a, b in zip(r["run"], r["run"][1:]))
