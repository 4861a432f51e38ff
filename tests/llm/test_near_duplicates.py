import random

import numpy as np
import pyarrow as pa
import pytest

from alluvia.llm import linking
from alluvia.llm import near_duplicates as near_duplicates_module
from alluvia.llm.near_duplicates import Sampler, learn_weights, near_duplicates, shingle_rows, weighted_jaccard

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, class_id string"


def brute(texts, weights):
    rows = list(shingle_rows(pa.array(texts), weights))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or weighted_jaccard(rows[i], rows[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def classes(rows):
    return {r["doc_id"]: r["class_id"] for r in rows}


def test_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    weights = learn_weights(docs.select("text"))
    expected = brute([r["text"] for r in rows], weights)
    got = classes(near_duplicates(docs).collect())
    assert [got[r["doc_id"]] for r in rows] == [rows[k]["doc_id"] for k in expected]
    assert len(set(expected)) < len(rows)


@pytest.mark.parametrize(("small", "with_base"), [(4, True), (linking.SMALL, False)])
def test_large_group_of_near_copies(spark, monkeypatch, small, with_base):
    monkeypatch.setattr(linking, "SMALL", small)
    random.seed(3)
    base = [f"w{random.randrange(500)}" for _ in range(120)]
    texts = [" ".join(base)] * with_base
    for i in range(60):
        copy = list(base)
        for _ in range(2):
            copy[random.randrange(120)] = f"x{i}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"u{i}v{random.randrange(10**6)}" for _ in range(60)) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute(texts, learn_weights(df.select("text")))
    got = classes(near_duplicates(df).collect())
    assert [got[i] for i in range(len(texts))] == expected


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", "b"), (None, "one two", None), (4, "one two", "x"), (4, "one two", "x"), (5, "!!", "y")]])
def test_edge_rows(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    if rows:
        size = sorted((r["doc_id"] or 0, r["class_size"]) for r in got)
        assert size == [(0, 3), (1, 2), (2, 2), (4, 3), (4, 3), (5, 1)]


def test_weighted_jaccard():
    a = (np.array([1, 2, 3], np.uint64), np.array([1.0, 2.0, 1.0]))
    b = (np.array([2, 3, 4], np.uint64), np.array([1.0, 1.0, 3.0]))
    assert weighted_jaccard(a, b) == pytest.approx(2 / 7)


@pytest.mark.parametrize(("small", "block"), [(4, 2048), (4, 16), (linking.SMALL, 16)])
def test_links_of_large_buckets_against_all_pairs(spark, monkeypatch, small, block):
    monkeypatch.setattr(linking, "SMALL", small)
    monkeypatch.setattr(near_duplicates_module, "BLOCK", block)
    random.seed(5)
    run = [f"w{random.randrange(5000)}" for _ in range(500)]
    texts = [" ".join(run[i * 5 : i * 5 + 120]) for i in range(60)]  # a chain: each links to the two next
    base = [f"v{random.randrange(500)}" for _ in range(120)]
    for i in range(60):  # all link to all, none is the centre
        copy = list(base)
        copy[random.randrange(120)] = f"x{i}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weights = learn_weights(df.select("text"))
    rows = list(shingle_rows(pa.array(texts), weights))
    sampler = Sampler()
    bands = [sampler.bands(*r) for r in rows]
    linked = [[x != y and (bands[x] == bands[y]).any() and weighted_jaccard(rows[x], rows[y]) >= 0.8 for y in range(len(texts))] for x in range(len(texts))]
    root = list(range(len(texts)))
    for _ in texts:
        root = [min([root[x], *(root[y] for y in range(len(texts)) if linked[x][y])]) for x in range(len(texts))]
    got = {r["doc_id"]: r for r in near_duplicates(df).collect()}
    assert [got[i]["n_links"] for i in range(len(texts))] == [sum(x) for x in linked]
    assert [got[i]["class_id"] for i in range(len(texts))] == root


def test_near_copies_without_a_centre_against_all_pairs(spark):
    """250 copies of one text, each with two or three own words, so that most pairs lie near the threshold and none links to all."""
    random.seed(12)
    base = [f"v{random.randrange(3000)}" for _ in range(240)]
    texts = []
    for i in range(250):
        copy = list(base)
        for k in random.sample(range(240), random.choice((2, 3))):
            copy[k] = f"own{i}x{k}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = list(shingle_rows(pa.array(texts), learn_weights(df.select("text"))))
    linked = [[x != y and weighted_jaccard(rows[min(x, y)], rows[max(x, y)]) >= 0.8 for y in range(250)] for x in range(250)]
    root = list(range(250))
    for _ in range(20):
        root = [min([root[x], *(root[y] for y in range(250) if linked[x][y])]) for x in range(250)]
    got = {r["doc_id"]: r for r in near_duplicates(df).collect()}
    links = sum(map(sum, linked))
    assert links > 4000
    assert links >= sum(r["n_links"] for r in got.values()) >= 0.99 * links
    assert sum(got[i]["class_id"] == root[i] for i in range(250)) >= 248


def test_long_texts_and_clashing_columns(spark):
    long_ = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, long_, 5, [1]), (2, long_ + " more", 6, None), (3, "short text of seven words in all", 7, [2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, bands array<int>").selectExpr("*", "doc_id AS class_row", "'x' AS digest", "1 AS n_links")
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates(df).collect()} == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    kept = near_duplicates_module.one_of_each_class(df)
    assert kept.columns == df.columns and kept.count() == 2
