"""Personal data, sharding and search against brute force."""

import random
import re

import numpy as np
import pytest

from ctspark.llm import impact_topk, kd_sharding, pii_bootstrap

SCHEMA = "doc_id long, text string, source string, lang string, shard string, row long, base string"


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "s" if i % 3 else None, "l", "x", 1, "b") for i, t in enumerate(texts)], SCHEMA).repartition(3)


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_spans(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    for k, (p, good) in enumerate(kinds):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text) if good(m[0])]
    return sorted(out)


def texts(seed=1):
    rng = random.Random(seed)
    out = [None, "", "é😀 a.b@c.d-e.f x@y z@w. 1.2.3.4 1.2.3.4.5 300.1.1.1 0000000000000000000000000255.1.1.1", "4539 1488 0343 6467 4539-1488-0343-6468 +1 (555) 010-9999. +12 3", "1 " * 6000, "9" * 20000, "a@b." * 300, "+1" + "(" * 500 + "2"]
    for _ in range(300):
        out.append("".join(rng.choice(["1", "23", "4539148803436467", ".", "-", " ", "+", "@", "a", "é", "(", ")", "x.y", "😀", "10.0.0.1", "+1 555 010 9999", "me@ex.org", "\n"]) for _ in range(rng.randint(1, 25))))
    return out


def test_seeds_equal_brute_force(spark):
    own = texts()
    rows = pii_bootstrap.find(frame(spark, own)).collect()
    assert len(rows) == len(own)
    for r in rows:
        assert [tuple(x) for x in r.base] == brute_spans(own[r.doc_id]), own[r.doc_id]
        assert {tuple(x) for x in r.base} <= {tuple(x) for x in r.spans}


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(2)
    own = [f"some words call me at person{i}@mail{i}.example.org thanks {i}" for i in range(12)]
    own += [f"some words call me at AB-{rng.randrange(10**9):09d} thanks" for _ in range(2)]
    own += [f"order number of parcel {rng.randrange(10**9):09d} sent" for _ in range(12)]
    rows = {r.doc_id: r for r in pii_bootstrap.find(frame(spark, own)).collect()}
    for i, t in enumerate(own):
        found = [(t[x["start"] : x["end"]], pii_bootstrap.KINDS[x["kind"]]) for x in rows[i].spans]
        want = [(t.split()[5], "email")] if i < 12 else [(t.split()[5], "id")] if i < 14 else []
        assert found == want
    clean = pii_bootstrap.redact(frame(spark, own)).collect()
    assert clean[0].asDict().keys() == {"doc_id", "text", "source", "lang", "shard", "row", "base"}
    assert {r.text for r in clean if r.doc_id in (12, 13)} == {"some words call me at <id> thanks"}


def test_seeds_with_blanks_teach_contexts_and_groups_are_found(spark):
    rng = random.Random(4)
    own = [f"please ring room 12 desk on +1 (017) 555-{1000 + 37 * i} before noon" for i in range(16)]
    unseen = ["017 555 7713", "GB29 NWBK 6016 1331 9268 19", "55512"]
    own += [f"please ring room 12 desk on {x} before noon" for x in unseen]
    own += [f"the parcel has number {rng.randrange(10**9):09d} inside" for _ in range(12)]
    rows = {r.doc_id: r for r in pii_bootstrap.find(frame(spark, own)).collect()}
    for i, t in enumerate(own):
        found = {t[x["start"] : x["end"]] for x in rows[i].spans}
        assert (unseen[i - 16] in found) if 16 <= i < 19 else len(found) == (i < 16)


def test_found_instances_support_further_patterns(spark):
    edges = [("a", f"s{i}", True) for i in range(30)] + [(p, f"x{i}", False) for p in ("a", "b") for i in range(4)] + [("c", f"y{i}", False) for i in range(6)]
    graph = spark.createDataFrame(edges, "pattern string, s string, seed boolean")
    assert {r.pattern for r in pii_bootstrap.confident_patterns(graph).collect()} == {"a", "b"}


def brute_scores(edges, rounds):
    seeds = {s for _, s, k in edges if k}
    score = {s: float(s in seeds) for _, s, _ in edges}
    by, of = {}, {}
    for p, s, _ in edges:
        by.setdefault(p, set()).add(s)
        of.setdefault(s, set()).add(p)
    for turn in range(rounds):
        p_score = {p: sum(score[s] for s in x) / (len(x) + 1) for p, x in by.items()}
        if turn + 1 < rounds:
            score = {s: max(float(s in seeds), 1 - float(np.prod([1 - min(p_score[p], 0.99) for p in x]))) for s, x in of.items()}
    return p_score


def test_graph_scores_equal_brute_force(spark):
    rng = random.Random(3)
    edges = list({(f"p{rng.randrange(6)}", s, s < 20) for s in range(60) for _ in range(3)})
    edges = [(p, f"i{s}", k) for p, s, k in edges]
    got = {r.pattern: r.score for r in pii_bootstrap.confident_patterns(spark.createDataFrame(edges, "pattern string, s string, seed boolean"), confidence=0.0, min_instances=1, min_seeds=0).collect()}
    want = brute_scores(edges, pii_bootstrap.ROUNDS)
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_shards_have_near_equal_bytes(spark, shards):
    rng = random.Random(4)
    own = ["x" * rng.randint(0, 60) for _ in range(800)] + ["hot" * 10] * 400 + [None, "", "é"]
    rows = kd_sharding.shard(frame(spark, own), shards, with_text_crc=True).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(own)))
    by = {}
    for r in rows:
        assert r.size == len((own[r.doc_id] or "").encode()) + 1
        by.setdefault(r.shard, []).append(r)
    sizes = [sum(r.size for r in x) for x in by.values()]
    assert set(by) == set(range(shards)) and max(sizes) - min(sizes) <= 3 * 62
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())


def test_shards_of_few_and_of_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert kd_sharding.shard(none, 16).count() == 0
    assert pii_bootstrap.find(none).count() == 0
    same = kd_sharding.shard(frame(spark, ["a"] * 40, [None] * 40), 16).collect()
    assert len(same) == 40 and max(sum(r.shard == s for r in same) for s in range(16)) <= 4


@pytest.mark.parametrize("kind", ["gauss", "ties", "wide"])
def test_top_k_equals_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    n = 700
    v = {"gauss": rng.integers(-30, 31, (n, 16)), "ties": rng.integers(0, 2, (n, 3)), "wide": (rng.standard_normal((n, 8)) * 10 ** rng.integers(0, 5, (n, 1))).astype(int)}[kind]
    df = spark.createDataFrame([(i, x.tolist(), "e") for i, x in enumerate(v)] + [(None, [1] * v.shape[1], "e"), (5000, None, "e"), (5020, [], "e")], "vec_id long, vec array<int>, score string").repartition(3)
    rows = impact_topk.top_k(df, df.where("vec_id % 20 = 0"), 20, block=150, query_block=9).collect()
    got = {}
    for r in rows:
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    everything = [*enumerate(v), (5020, np.zeros(v.shape[1], int))]
    for q in [*range(0, n, 20), 5020]:
        query = v[q] if q < n else np.zeros(v.shape[1], int)
        want = sorted((-int(x @ query), i) for i, x in everything if i != q)[:20]
        assert [got[q][k] for k in range(1, 21)] == [(i, -s) for s, i in want]


def test_few_candidates_give_all(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3, 4]), (20, [5, 6])], "vec_id long, vec array<int>")
    assert sorted((r.query_id, r.rank, r.vec_id) for r in impact_topk.top_k(df, df.where("vec_id % 20 = 0"), 20).collect()) == [(0, 1, 20), (0, 2, 1), (20, 1, 1), (20, 2, 0)]


@pytest.mark.parametrize("shards", [4, 7])
def test_splits_equal_brute_force(spark, monkeypatch, shards):
    """Every cut again by sorting a node's rows along its widest axis."""
    from pyspark.sql import functions as F

    kept, settle = {}, kd_sharding.settle

    def spy(df, name, *rest):
        out = settle(df, name, *rest)
        kept.setdefault(name, out)
        return out

    monkeypatch.setattr(kd_sharding, "settle", spy)
    rng = random.Random(9)
    own = ["x" * rng.randint(0, 90) for _ in range(300)] + ["copy of one text"] * 150 + [None]
    df = spark.createDataFrame([(i, t, rng.choice(["a", "b", "b", None]), rng.choice(["en", "de"])) for i, t in enumerate(own)], "doc_id long, text string, source string, lang string").repartition(3)
    found = {r.doc_id: r.shard for r in kd_sharding.shard(df, shards).collect()}
    points = kept["points"]
    axes = [c for c in points.columns if c.startswith("raw_")]
    rows = points.withColumn("tail", F.shiftleft("t", kd_sharding.ROW_BITS) + F.pmod(F.xxhash64("row"), F.lit(1 << kd_sharding.ROW_BITS))).collect()
    rows = [r.asDict() | {"t": r["t"] or 0} for r in rows]
    for a in axes:
        values = [r[a] for r in rows if r[a] is not None]
        low, high, top = min(values), max(values), (1 << kd_sharding.VALUE_BITS) - 1
        for r in rows:
            r[a] = 0 if r[a] is None or high <= low else min(top, max(0, int((r[a] - low) / (high - low) * top)))
    expected, nodes = {}, [(rows, shards, 0)]
    while nodes:
        part, k, first = nodes.pop()
        if k == 1:
            expected |= {r["id"]: first for r in part}
            continue
        axis = max(axes, key=lambda a: max(r[a] for r in part) - min(r[a] for r in part))  # noqa: B023
        place = lambda r: (r[axis] << (kd_sharding.TEXT_BITS + kd_sharding.ROW_BITS)) + (r["tail"] or 0)  # noqa: B023, E731
        part = sorted(part, key=place)
        goal, upto, cut = sum(r["bytes"] for r in part) * (k // 2) / k, 0, 0
        for i, r in enumerate(part):
            if upto > goal:
                break
            cut, begin, last = i, upto, r["bytes"]
            upto += r["bytes"]
        cut += goal - begin > last / 2
        nodes += [(part[:cut], k // 2, first), (part[cut:], k - k // 2, first + k // 2)]
    assert found == expected


def test_long_texts_of_identifiers_take_linear_time(spark):
    """A text of six-digit numbers and one of addresses, both of more than half a megabyte, and masked whole."""
    import time

    rng = random.Random(6)
    numbers = " ".join(str(rng.randrange(100_000, 999_999)) for _ in range(100_000))
    mails = " ".join(f"p{i}@mail{i % 7}.example.org" for i in range(25_000))
    df = frame(spark, [numbers, mails, "é" * 1500 + " me@ex.org " + "w" * 3000])
    began = time.time()
    found = {r.doc_id: r for r in pii_bootstrap.find(df).collect()}
    assert len(found[1].base) == 25_000 and [tuple(x) for x in found[2].base] == [(1501, 0, 1510)]
    masked = {r.doc_id: r.text for r in pii_bootstrap.redact(df).collect()}
    assert masked[1] == " ".join(["<email>"] * 25_000) and masked[2] == "é" * 1500 + " <email> " + "w" * 3000
    assert time.time() - began < 120


def test_overlapping_cuts_are_masked_once(spark):
    from pyspark.sql import functions as F

    text = "ab é😀 12345678901 tail"
    spans = [(0, 2, 2), (3, 0, 6), (4, 1, 5), (5, 3, 9), (9, 2, 9)]

    def brute():
        out, at = "", 0
        for s, k, e in spans:
            if s >= at:
                out += text[at:s] + f"<{pii_bootstrap.KINDS[k]}>"
            at = max(at, e)
        return out + text[at:]

    b = lambda n: len(text[:n].encode())
    df = spark.createDataFrame([(text, [(s, k, e, b(s), b(e)) for s, k, e in spans])], "t string, c array<struct<start: int, kind: int, end: int, bstart: int, bend: int>>")
    assert df.select(pii_bootstrap.masked(F.col("t"), F.col("c"))).first()[0] == brute()
    assert df.select(pii_bootstrap.masked(F.col("t"), F.filter("c", lambda x: F.lit(False)))).first()[0] == text


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1500])
def test_running_totals_in_blocks(spark, n):
    from pyspark.sql import functions as F

    rng = random.Random(n)
    values = [rng.randrange(100) for _ in range(n)]
    row = spark.createDataFrame([(values,)], "v array<int>").select(pii_bootstrap._before(F.col("v"), lambda a, b: a + b), pii_bootstrap._before(F.col("v"), F.greatest)).first()
    assert row[0] == [sum(values[:i]) for i in range(n)] and row[1] == [max([0, *values[:i]]) for i in range(n)]
