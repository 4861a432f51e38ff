import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from alluvia.llm import maxent_lm
from alluvia.llm.maxent_lm import DIGITS, LEAVES, features, leaf_log_probabilities, learn_vocabulary, lm_scores, token_counts, tokens, train, weight_rows

DATA = "/root/testdata/sf0.001"


def cut(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute(rows):
    held = {i: zlib.crc32(str(d).encode()) % 5 == 1 for i, (d, _) in enumerate(rows)}
    counts = Counter()
    for i, (_, t) in enumerate(rows):
        if not held[i]:
            counts.update(cut(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, (d, t) in enumerate(rows):
        own = cut(t)
        out.append((d, held[i], len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)))
    return sorted(out)


@pytest.mark.parametrize("heavy", [1 << 18, 64])
def test_base_against_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(maxent_lm, "HEAVY", heavy)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(9001, None), (9002, ""), (9003, "A\x0bB\x00\x01 É"), (9003, "A\x0bB\x00\x01 É")], "doc_id long, text string")
    df = docs.unionByName(extra)
    expected = brute([tuple(r) for r in df.collect()])
    got = sorted(tuple(r)[:6] for r in lm_scores(df).collect())
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert all(g[5] == pytest.approx(e[5], rel=1e-9) for g, e in zip(got, expected))


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def learnt(spark, texts, monkeypatch, heavy=1 << 18):
    monkeypatch.setattr(maxent_lm, "HEAVY", heavy)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    vocabulary = spark.sparkContext.broadcast(learn_vocabulary(token_counts(df)))
    return vocabulary.value, train(df, vocabulary)


TEXTS = ["a b a c a b", "b a a d", None, "", "the the a b c d e f g", "a b x y z " * 5] * 6


@pytest.mark.parametrize("heavy", [1 << 18, 16])
def test_probabilities_of_all_words_add_up_to_one(spark, monkeypatch, heavy):
    vocabulary, weights = learnt(spark, TEXTS, monkeypatch, heavy)
    token, offsets = tokens(pa.array(["a b", "the a", "never seen"]))
    feature = features(token, offsets)
    n, v = np.zeros(LEAVES), np.zeros(LEAVES)
    words, counts = np.unique(tokens(pa.array(TEXTS, pa.string()))[0], return_counts=True)
    _, leaves = vocabulary.look_up(words)
    np.add.at(n, leaves, counts)
    np.add.at(v, leaves, 1)
    for at in range(len(token)):
        history = feature[:, [at] * LEAVES]
        leaf = np.exp(leaf_log_probabilities(weights, vocabulary, history, np.arange(LEAVES)))
        known = sum(leaf[k] * (c + 0.5) / (n[k] + 0.5 * (v[k] + 1)) for k, c in zip(leaves, counts))
        unknown = sum(leaf[k] * 0.5 / (n[k] + 0.5 * (v[k] + 1)) for k in range(LEAVES))
        assert known + unknown == pytest.approx(1, abs=1e-5)


def test_scores_against_a_plain_loop(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    training = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    vocabulary, weights = learnt(spark, training, monkeypatch)
    counts = Counter(w for t in training for w in tokens(pa.array([t], pa.string()))[0].tolist())
    mass, size = Counter(), Counter()
    for w, c in counts.items():
        leaf = int(vocabulary.look_up(np.array([w], np.uint64))[1][0])
        mass[leaf] += c
        size[leaf] += 1
    got = {r["doc_id"]: r["score"] for r in lm_scores(df).collect()}
    for i, t in rows:
        token, offsets = tokens(pa.array([t], pa.string()))
        feature, total = features(token, offsets), 0.0
        for k, w in enumerate(token.tolist()):
            leaf = int(vocabulary.look_up(token[k : k + 1])[1][0])
            first, second = divmod(leaf, DIGITS)
            one, two = weight_rows(feature[:, k : k + 1], np.array([first]), vocabulary.bits)
            for z, digit in ((vocabulary.first + sum(weights[0][r[0]] for r in one), first), (vocabulary.second[first] + sum(weights[1][r[0]] for r in two), second)):
                total += (float(z[digit]) - math.log(sum(math.exp(x) for x in z.tolist()))) / math.log(10)
            total += math.log10((counts[w] + 0.5) / (mass[leaf] + 0.5 * (size[leaf] + 1)))
        assert got[i] == pytest.approx(total, rel=1e-4)


def test_partitions_do_not_change_scores(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    one, many = ({r["doc_id"]: r["score"] for r in lm_scores(df.repartition(n)).collect()} for n in (1, 16))
    assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k], rel=1e-4) for k in one)


def test_very_long_text_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "word other " * 60_000, 5), (2, "word", 6)], "doc_id long, text string, row long").withColumn("score", F.lit(0.0))
    rows = {r["doc_id"]: r for r in lm_scores(df).collect()}
    assert rows[1]["n_tokens"] == 120_001 and rows[2]["score"] < 0


def test_empty_table(spark):
    assert lm_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []
