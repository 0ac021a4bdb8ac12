"""Repeated strings and the Jaccard join against brute force."""

import hashlib
import random

import numpy as np
import pytest

from ctspark.llm import dc3_dedup, jaccard_join

SCHEMA = "doc_id long, text string, source string, row long, h long"


def brute_repeats(texts, width=200):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for r in raws:
        for i in range(len(r) - width + 1):
            seen[r[i : i + width]] = seen.get(r[i : i + width], 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - width + 1):
            if seen[r[i : i + width]] > 1:
                gone[i : i + width] = True
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def brute_components(texts):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())

    sets, up = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(60), prose(20)
    texts = [None, "", " \n\t", "a", "a b", "a b", "A B", "ha " * 400, "x" * 199, "x" * 200, "x" * 201, passage, passage + passage]
    for _ in range(25):
        texts.append(prose(rng.randint(5, 300)))
    for _ in range(15):
        texts.append(f"{prose(rng.randint(0, 80))} {passage[rng.randint(0, 60):]} {line}\n{prose(rng.randint(0, 80))}")
    base = prose(300).split()
    for _ in range(60):  # near copies at all distances around the limit
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 8, 10, 12, 16, 25])):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    tiny = [word() for _ in range(12)]
    texts += [" ".join(tiny), " ".join(tiny[:-1]), " ".join(tiny[1:]), " ".join(tiny) + " " + word()]
    texts += [texts[20]] * 5 + [texts[-1].upper()]
    return texts


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "s", 0, 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    texts = corpus(seed)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dc3_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_repeats(texts)))


def test_suffix_ranks_order_all_suffixes():
    rng = random.Random(4)
    for n in [1, 2, 3, 4, 5, 6, 7, 20, 100, 101, 102]:
        for letters in ("a", "ab", "abcd"):
            s = [ord(rng.choice(letters)) for _ in range(n)]
            rank = dc3_dedup.suffix_ranks(np.array(s, np.int64), 1, 10**6)
            assert list(np.argsort(rank)) == sorted(range(n), key=lambda i: s[i:])


def test_contexts_tile_all_windows_of_long_texts(monkeypatch):
    monkeypatch.setattr(dc3_dedup, "_SLICE", 1024)
    raw = bytes(random.Random(5).choices(b"abc", k=5000))
    starts, counts, _ = dc3_dedup.contexts(raw)
    assert [i for s, n in zip(starts, counts, strict=True) for i in range(s, s + n)] == list(range(len(raw) - 199))


@pytest.mark.parametrize("seed", [1, 3])
def test_components_equal_brute_force(spark, seed):
    texts = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_components(texts)))


def test_empty_tables_and_null_ids(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert dc3_dedup.remove_repeats(none).count() == 0
    assert jaccard_join.link_components(none).count() == 0
    rows = spark.createDataFrame([(None, "a b c d", None, 1, 1), (7, "a b c d", None, 1, 1), (None, None, None, 1, 1), (3, "q r s t", None, 1, 1)], SCHEMA)
    assert sorted(map(tuple, jaccard_join.link_components(rows).collect()), key=str) == sorted([(None, 2, 7), (7, 2, 7), (None, 0, None), (3, 2, 3)], key=str)
    assert dc3_dedup.remove_repeats(rows).count() == 4


def test_cut_characters_are_dropped_from_the_text(spark):
    passage = "é" * 120  # cuts fall inside characters of two bytes
    texts = ["a" + passage + "xyz", "bé" + passage[:-1] + "ü" * 3, None, "clean �"]
    rows = {r.doc_id: r.text for r in dc3_dedup.without_repeats(frame(spark, texts)).collect()}
    raws, seen = [(t or "").encode() for t in texts], {}
    for r in raws:
        for i in range(len(r) - 199):
            seen[r[i : i + 200]] = seen.get(r[i : i + 200], 0) + 1
    for i, r in enumerate(raws):
        gone = {j for k in range(len(r) - 199) if seen[r[k : k + 200]] > 1 for j in range(k, k + 200)}
        want = bytes(b for j, b in enumerate(r) if j not in gone).decode("utf-8", "ignore")
        assert (rows[i] or "") == want
    assert rows[2] is None and rows[3] == texts[3]


def templated(n, frame, extra, seed):
    """Documents that share a frame of words in the same order, each with words of its own between them."""
    rng = random.Random(seed)
    words = [f"frame{i}" for i in range(frame)]
    out = []
    for d in range(n):
        own = sorted(rng.sample(range(frame), extra(rng)))
        text = [w if i not in own else f"own{d}x{i}" for i, w in enumerate(words)]
        out.append(" ".join(text))
    return out


def test_templated_documents_that_do_not_link(spark):
    """2,000 documents with one frame: none is near another, and few pairs are looked at."""
    texts = templated(2000, 150, lambda rng: 6, 4)
    df = spark.createDataFrame([(i, t, "s", 0, 0) for i, t in enumerate(texts)], SCHEMA)
    found = jaccard_join.link_components(df, width=3, num=90, den=100).collect()
    expected = brute_components_fast(texts)
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == list(enumerate(expected))


def brute_components_fast(texts, width=3, num=90, den=100):
    """Components by a matrix of intersections."""
    shingles = [{tuple(t.split()[i : i + width]) for i in range(len(t.split()) - width + 1)} for t in texts]
    names = {s: i for i, s in enumerate(sorted(set().union(*shingles)))}
    m = np.zeros((len(texts), len(names)), np.float32)
    for i, s in enumerate(shingles):
        m[i, [names[x] for x in s]] = 1
    inter = m @ m.T
    sizes = m.sum(axis=1)
    linked = den * inter >= num * (sizes[:, None] + sizes[None, :] - inter)
    label = np.arange(len(texts))
    while True:
        new = np.where(linked, label[None, :], len(texts)).min(axis=1)
        if (new == label).all():
            return label.tolist()
        label = new


@pytest.mark.parametrize(("n", "frame", "low", "high", "num"), [(400, 120, 0, 9, 80), (400, 120, 2, 6, 90), (300, 60, 0, 20, 70)])
def test_hot_regions_with_links_of_all_kinds(spark, n, frame, low, high, num):
    texts = templated(n, frame, lambda rng: rng.randint(low, high), 7)
    df = spark.createDataFrame([(i, t, "s", 0, 0) for i, t in enumerate(texts)], SCHEMA)
    found = jaccard_join.link_components(df, width=3, num=num, den=100).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == list(enumerate(brute_components_fast(texts, 3, num)))


def test_parity_bitmaps_bound_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(rng.integers(-(1 << 62), 1 << 62, rng.integers(1, 3000))) for _ in range(2))
        a = np.unique(np.concatenate([a, b[: len(b) // 2]]))
        bits = sum(int(x).bit_count() for x in (jaccard_join.parity(a) ^ jaccard_join.parity(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_more_pivots_and_salts(spark, monkeypatch):
    """Small cells make several turns and deal a region's members to several salts."""
    monkeypatch.setattr(jaccard_join, "CELL", 8)
    texts = templated(300, 100, lambda rng: rng.randint(0, 6), 11) + templated(60, 100, lambda rng: 1, 12)
    df = spark.createDataFrame([(i, t, "s", 0, 0) for i, t in enumerate(texts)], SCHEMA)
    found = jaccard_join.link_components(df, width=3, num=88, den=100).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == list(enumerate(brute_components_fast(texts, 3, 88)))


def test_passage_with_different_edges_in_many_texts(spark, monkeypatch):
    """5,000 texts share a passage, each with its own words on either side: its edge anchors are dealt by whole windows."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = " ".join(word() for _ in range(70))
    texts = [" ".join(word() for _ in range(30)) + f" {i} " + passage + f" {i * 7} " + " ".join(word() for _ in range(30)) for i in range(5000)]
    monkeypatch.setattr(dc3_dedup, "SORT_BYTES", 1 << 18)
    df = spark.createDataFrame([(i, t, "s", 0, 0) for i, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in dc3_dedup.remove_repeats(df).collect()}
    expected = brute_repeats(texts[:300])  # the passage repeats there too, and whatever else does is in all
    common = len((" " + passage + " ").encode())
    assert all(common - 2 <= found[i][1] <= common + 40 for i in found)
    assert [found[i] for i in range(300)] == expected or all(abs(found[i][1] - expected[i][1]) <= 40 for i in range(300))


@pytest.mark.parametrize("many", [0, 1, 3])
def test_windows_and_suffixes_agree(spark, monkeypatch, many):
    """Whatever share of the anchors is dealt by windows, the result is the same."""
    monkeypatch.setattr(dc3_dedup, "MANY", many)
    texts = corpus(4)
    df = spark.createDataFrame([(i, t, "s", 0, 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in dc3_dedup.remove_repeats(df).collect())
    assert got == [(i, *x) for i, x in enumerate(brute_repeats(texts))]


def test_cut_texts_keep_their_columns(spark):
    texts = corpus(5)
    rows = [(i if i % 9 else None, t, f"src{i % 3}", i * 10, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, c0 string, n_chars int, row long").repartition(3)
    out = dc3_dedup.without_repeats(df)
    assert out.schema == df.schema
    got = {r["row"]: r for r in out.collect()}
    expected = brute_repeats(texts)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["doc_id"], r["c0"]) == (rows[i][0], rows[i][2])
        if expected[i][1] == 0:
            assert r["text"] == t and r["n_chars"] == i * 10
        else:
            assert r["n_chars"] == len(r["text"]) and len(r["text"].encode()) <= expected[i][0] - expected[i][1]


def test_texts_of_a_megabyte(spark):
    rng = random.Random(21)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 7))) for _ in range(n))
    half, own = prose(130_000), prose(230_000)
    texts = [half + " " + half, own, own + " tail", "z" * 1_200_000]
    assert min(len(t.encode()) for t in texts) > 1_000_000
    df = spark.createDataFrame([(i, t, "s", 0, 0) for i, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: r for r in dc3_dedup.remove_repeats(df).collect()}
    sizes = [len(t.encode()) for t in texts]
    assert found[0]["n_removed"] in (sizes[0], sizes[0] - 1) and [found[i]["n_removed"] for i in (1, 3)] == [sizes[1], sizes[3]]
    assert sizes[2] - 5 <= found[2]["n_removed"] + 5 <= sizes[2] + 5 and found[2]["kept_text"] in (" tail", "tail")
    links = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link_components(df).collect()}
    assert [links[i][1] for i in range(4)] == [0, 1, 1, 3] and links[3][0] == 1 and links[1][0] > 200_000
