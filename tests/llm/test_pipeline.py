"""The pipeline's stages on a small corpus, each against brute force over its own input."""

import random
import re

import pytest
from test_dedup_and_join import brute_repeats

import corpus_pipeline
from ctspark.llm import pii_bootstrap


def five_word_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("aeiourstlnmd") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, labels = [], []
    for i in range(260):
        body = prose(rng.randint(60, 200))
        if i % 5 == 0:
            body = re.sub(" ", lambda m: rng.choice([" *** ", "$$$ ", " | "]), body)
            labels.append((i, 0, 0))
        elif i % 2:
            labels.append((i, 1, 0))
        rows.append(body)
    base = prose(150).split()
    for _ in range(12):  # near copies
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 9])):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        rows.append(" ".join(copy))
    passage = prose(60)
    rows += [f"{prose(80)} {passage} {prose(60)} write to a.b{i}@mail.example.org or 10.0.0.{i}" for i in range(6)]
    rows += [None, "", rows[1], rows[1]]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_every_stage_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{folder}/stage-{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        rows = docs.collect()
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows) and all(r.n_chars == len(r.text or "") for r in rows)
        if name == "quality_classifier":
            clean = [i for i in range(260) if i % 5]
            assert len([i for i in clean if i in after]) >= 0.97 * len(clean)
            assert len([i for i in range(0, 260, 5) if i in after]) <= 3
        elif name == "jaccard_join":
            ids = sorted(before)
            sets, up = five_word_sets([before[i] for i in ids]), list(range(len(ids)))

            def root(i):
                while up[i] != i:
                    i = up[i]
                return i

            for i in range(len(ids)):
                for j in range(i):
                    if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                        a, b = sorted((root(i), root(j)))
                        up[b] = a
            assert set(after) == {ids[i] for i in range(len(ids)) if root(i) == i}
        elif name == "suffix_dedup":
            ids = sorted(before)
            for i, (size, removed, _, _) in zip(ids, brute_repeats([before[i] for i in ids]), strict=True):
                assert len((after[i] or "").encode()) == size - removed
        else:
            assert set(after) == set(before)
            for i, t in before.items():
                if t and "@mail" in t:
                    assert "@" not in after[i] and "<email>" in after[i] and "<ip>" in after[i]
                else:
                    assert after[i] == t
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == set(before)
    assert pii_bootstrap.KINDS[0] == "email"


def test_run_gives_the_last_stage(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    tokens, lengths = {}, {}
    for r in rows:
        tokens[r.doc_id] = r.doc_tokens
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert tokens == lengths and corpus_pipeline.ORACLE_SQL is None


ODD = "doc_id long, text string, lang string, source string, n_chars long, row long, h long, key string, gone long, c0 int, `none` string, spans array<int>, text_2 string"


@pytest.mark.parametrize("case", ["no documents", "no labels", "repeated ids and further columns"])
def test_stages_of_odd_tables(spark, tmp_path, case):
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 7))) for _ in range(n))
    texts = [prose(60), prose(50), None, "", "a b", prose(70), "long " + prose(30_000)]
    rows = [(i % 3 if i < 5 else None, t, None, None if i % 2 else "s", i, 1, 2, "k", 3, 4, "n", [i], "other") for i, t in enumerate([*texts, texts[0], texts[0]])]
    docs = spark.createDataFrame(rows if case != "no documents" else [], ODD)
    labels = [(0, 1, 0), (1, 0, 1), (2, 1, 0), (3, None, None)] if case != "no labels" else []
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == before.columns and {f.dataType for f in docs.schema} == {f.dataType for f in before.schema}
    ids = {r.doc_id for r in before.collect()}
    assert {r.doc_id for r in docs.collect()} == ids
    assert (case == "no documents") == (not ids)
    if case == "no labels":  # nothing is rejected without labels, and a null id stands for no document
        assert None in ids
