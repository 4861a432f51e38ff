"""Language model scores: a hashed maximum-entropy model with a class-factored softmax, and the smoothed unigram base.

Tokens are runs of other bytes than ASCII white space, A-Z in lower case, and one end token after each text. Words with at
least 1 in 2**18 of all training tokens ("heavy", so at most 2**18) are dealt by frequency to 224 leaves of about equal mass, so
that the most frequent words have leaves of their own; all others fall into 32 leaves by hash bits. A leaf's number has two
digits, its class and its place there:

    P(word | history) = P(class | history) * P(leaf | class, history) * P(word | leaf)

The first two factors are softmaxes over hashed features of the history (last word, last two words, and the words one and two
before the last alone, as skips; for the second factor together with the class); the last is the word's smoothed share of its
leaf, with a share for words never seen. There is one row of weights for about 2**13 training tokens, from 2**13 up to 2**18 rows.

Training takes ROUNDS synchronised rounds, each over the texts of one hash shard: every task sums seen and expected counts by
feature and digit under the round's weights, the sums are added up, and the weights move along the gradient (seen minus
expected), scaled by the expected counts. How rows are split into tasks changes nothing but the order of sums.

Words outside the heavy table get their counts by a join on their hash, so that nothing that grows with the vocabulary is
broadcast. Null texts are empty: one end token. Rows may repeat; each is scored and, unless held out, learnt from. Without
training texts all counts are 0. Other columns than the text and the id are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.llm.arrow_text import Table, letters_table, mix, row_chunks, utf8, words
from alluvia.llm.storage import materialise

WORDS = letters_table(b"\x20\x09\x0a\x0b\x0c\x0d")
END, START = np.uint64(0x5EED0E4D5EED0E4D), np.uint64(0x5EED57A275EED57A)
HEAVY = 1 << 18
DIGITS = 16
TAIL_BITS = 5
LEAVES = DIGITS * DIGITS
HEAVY_LEAVES = LEAVES - (1 << TAIL_BITS)
LEAST_BITS, MOST_BITS, TOKENS_A_ROW = 13, 18, 13
SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
STEP_TOKENS = 32768
ROUNDS = 3
SMOOTHING = 4
RATE = 0.35
PARTS = 8
FOLD = 64


def is_held_out(doc_id: Column, parts: int = 5, part: int = 1) -> Column:
    """Whether crc32 of doc_id as text falls in the part that isn't learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a chunk, each text's end token included, and the texts' offsets among them."""
    data, offsets = utf8(column)
    hashes, _, _, first = words(data, offsets, WORDS)
    ends = first[1:] + np.arange(len(first) - 1)
    out = np.empty(len(hashes) + len(first) - 1, np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end], out[~is_end] = END, hashes
    return out, np.concatenate([[0], ends + 1])


def features(token: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit features of each token's history, one row for each kind of feature."""
    at = np.arange(len(token)) - np.repeat(offsets[:-1], np.diff(offsets))
    last = []
    for k in (1, 2, 3):
        x = np.full(len(token), START)
        x[k:] = token[:-k] if len(token) > k else x[k:]
        last.append(np.where(at >= k, x, START))
    kinds = (last[0], last[0] * np.uint64(3) + last[1], last[1], last[2])
    return np.stack([mix(x * s) for x, s in zip(kinds, SEEDS)])


def weight_rows(feature: np.ndarray, classes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of weights of the first digit, and of the second, for which the class is part of the feature."""
    shift = np.uint64(64 - bits)
    second = (feature ^ (classes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (feature >> shift).astype(np.int64), (second >> shift).astype(np.int64)


def token_counts(texts: DataFrame) -> DataFrame:
    """word (a 64-bit hash) and c, its count."""

    def run(batches):
        for batch in batches:
            for start, stop in row_chunks(batch.column(0), 4 << 20):
                parts = [tokens(batch.column(0).slice(start + a, b - a))[0] for a, b in row_chunks(batch.column(0).slice(start, stop - start))]
                word, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "c"])

    return texts.mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Heavy words with their counts and leaves, count and size of every leaf, and the digits' log shares."""

    def __init__(self, total: int, distinct: int, keys: np.ndarray, counts: np.ndarray, tail: dict[int, tuple[int, int]]):
        order = np.lexsort((keys, -counts))
        keys, self.counts = keys[order], counts[order].astype(np.float64)
        self.total, self.distinct, self.table = total, distinct, Table(keys, self.counts)
        mass = np.cumsum(self.counts) - self.counts / 2
        self.leaves = np.minimum((mass / max(self.counts.sum(), 1) * HEAVY_LEAVES).astype(np.int64), HEAVY_LEAVES - 1)
        n = np.bincount(self.leaves, self.counts, LEAVES) if len(keys) else np.zeros(LEAVES)
        v = np.bincount(self.leaves, minlength=LEAVES) if len(keys) else np.zeros(LEAVES, np.int64)
        for k, (tokens_, words_) in tail.items():
            n[HEAVY_LEAVES + k], v[HEAVY_LEAVES + k] = tokens_, words_
        self.log_size = np.log10(n + 0.5 * (v + 1))
        share = (n + 0.5).reshape(DIGITS, DIGITS)
        self.first = np.log(share.sum(1) / share.sum()).astype(np.float32)
        self.second = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
        self.log_total = math.log10(total + 0.5 * (distinct + 1))
        self.bits = min(max(int(total).bit_length() - TOKENS_A_ROW, LEAST_BITS), MOST_BITS)

    def look_up(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the heavy words (-1: none) and leaf of each token."""
        found = self.table.find(token)
        tail = (token >> np.uint64(64 - TAIL_BITS)).astype(np.int64) + HEAVY_LEAVES
        return found, np.where(found >= 0, self.leaves[found] if len(self.leaves) else tail, tail)


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, and the heavy words: those with at least 1 in HEAVY of all tokens, at most HEAVY of them."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = total // HEAVY + 1
    rows = counts.where(F.col("c") >= least).toArrow()
    place = F.shiftrightunsigned("word", 64 - TAIL_BITS)
    tail = counts.where(F.col("c") < least).groupBy(place.cast("int").alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    return Vocabulary(total, distinct, rows.column("word").to_numpy().view(np.uint64), rows.column("c").to_numpy(), {r["k"]: (r["n"], r["v"]) for r in tail})


def digit_probabilities(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Natural log P(digit | history) by token and digit."""
    z = weights[rows[0]] + bias
    for r in rows[1:]:
        z += weights[r]
    z -= z.max(1, keepdims=True)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return z


def leaf_log_probabilities(weights: np.ndarray, vocabulary: Vocabulary, feature: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Natural log P(leaf | history) of each token's leaf."""
    first, second = leaf // DIGITS, leaf % DIGITS
    one, two = weight_rows(feature, first, vocabulary.bits)
    each = np.arange(len(leaf))
    return digit_probabilities(weights[0], one, vocabulary.first)[each, first] + digit_probabilities(weights[1], two, vocabulary.second[first])[each, second]


def count_sums(texts: DataFrame, vocabulary, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seen and expected counts of each (factor, row, digit) over all tokens of the texts, under these weights."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)
    size = weights.shape[1]
    tasks = max(1, texts.rdd.getNumPartitions())

    def run(batches):
        v, w = vocabulary.value, shared.value
        seen, expected = np.zeros(2 * size * DIGITS, np.int64), np.zeros((2 * size, DIGITS), np.float32)
        some = False
        for batch in batches:
            for start, stop in row_chunks(batch.column(0)):
                some = True
                token, offsets = tokens(batch.column(0).slice(start, stop - start))
                feature, (_, leaves) = features(token, offsets), v.look_up(token)
                for a in range(0, len(token), STEP_TOKENS):
                    f, leaf = feature[:, a : a + STEP_TOKENS], leaves[a : a + STEP_TOKENS]
                    first, second = leaf // DIGITS, leaf % DIGITS
                    one, two = weight_rows(f, first, v.bits)
                    p = np.exp(np.concatenate([digit_probabilities(w[0], one, v.first), digit_probabilities(w[1], two, v.second[first])]))
                    rows = np.concatenate([one, two + size], 1).ravel()
                    digit = np.tile(np.concatenate([first, second]), len(f))
                    seen += np.bincount(rows * DIGITS + digit, minlength=len(seen))
                    order = np.argsort(rows.astype(np.uint16 if 2 * size <= 1 << 16 else np.uint32), kind="stable")  # small numbers are sorted by digits
                    rows = rows[order]
                    begins = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                    expected[rows[begins]] += np.add.reduceat(p[order % len(p)], begins, axis=0)
        if some:
            gid, cut = TaskContext.get().partitionId() // FOLD, 2 * size // PARTS
            sums = [[x.reshape(2 * size, DIGITS)[p * cut : (p + 1) * cut].tobytes() for p in range(PARTS)] for x in (seen.astype(np.float32), expected)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([gid] * PARTS, pa.int64()), *(pa.array(x, pa.binary()) for x in sums)], ["part", "gid", "seen", "expected"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = {c: sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pdf[c]).astype(np.float32).tobytes() for c in ("seen", "expected")}
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "gid": pdf["gid"].iloc[:1] // FOLD, "seen": [total["seen"]], "expected": [total["expected"]]})

    schema = "part int, gid long, seen binary, expected binary"
    sums = texts.mapInArrow(run, schema)
    left = math.ceil(tasks / FOLD)
    while True:  # at most FOLD vectors meet in one group, level by level
        sums = sums.groupBy("part", "gid").applyInPandas(add, schema)
        if left <= 1:
            break
        left = math.ceil(left / FOLD)
    out = np.zeros((2, 2 * size, DIGITS), np.float32)
    for r in sums.collect():
        cut = 2 * size // PARTS
        for x, name in zip(out, ("seen", "expected")):
            x[r["part"] * cut : (r["part"] + 1) * cut] = np.frombuffer(r[name], np.float32).reshape(cut, DIGITS)
    shared.unpersist()
    return tuple(x.reshape(weights.shape) for x in out)


def train(texts: DataFrame, vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (factor, row, digit) after so many rounds; round k sees the texts whose hash has remainder k."""
    weights = np.zeros((2, 1 << vocabulary.value.bits, DIGITS), np.float32)
    for k in range(rounds):
        shard = texts.where(F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(rounds)) == k)
        seen, expected = count_sums(shard, vocabulary, weights)
        weights += np.float32(RATE) * np.log1p((seen - expected) / (expected + SMOOTHING))
    return weights


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, tail array<struct<word: long, n: int>>"


def score_heavy(df: DataFrame, vocabulary, weights) -> DataFrame:
    """Per row all that needs no counts of tail words; the tail words themselves as (word, n)."""
    pair = pa.struct([("word", pa.int64()), ("n", pa.int32())])

    def run(batches):
        v, row = vocabulary.value, TaskContext.get().partitionId() << 40
        logs = np.append(np.log10(v.counts + 0.5), 0.0)
        for batch in batches:
            for start, stop in row_chunks(batch.column(2)):
                b = batch.slice(start, stop - start)
                token, offsets = tokens(b.column(2))
                (found, leaves), feature = v.look_up(token), features(token, offsets)
                factor = np.empty(len(token))
                for a in range(0, len(token), STEP_TOKENS):
                    factor[a : a + STEP_TOKENS] = leaf_log_probabilities(weights.value, v, feature[:, a : a + STEP_TOKENS], leaves[a : a + STEP_TOKENS])
                own = np.where(found >= 0, logs[found], 0.0)
                n = np.diff(offsets)
                sums = [np.add.reduceat(x, offsets[:-1]) for x in (own, own + factor / math.log(10) - v.log_size[leaves], (found >= 0).astype(np.int64))]
                rare = np.flatnonzero(found < 0)
                of_row = np.repeat(np.arange(len(n), dtype=np.uint64), n)[rare]
                order = np.lexsort((token[rare], of_row))
                word, of_row = token[rare][order], of_row[order]
                head = np.ones(len(word), bool)
                head[1:] = (word[1:] != word[:-1]) | (of_row[1:] != of_row[:-1])
                at = np.flatnonzero(head)
                times = np.diff(np.append(at, len(word)))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of_row[at], np.arange(len(n) + 1, dtype=np.uint64)).astype(np.int32)), pa.StructArray.from_arrays([pa.array(word[at].view(np.int64)), pa.array(times.astype(np.int32))], fields=list(pair)))
                m = b.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(range(row, row + m), pa.int64()), b.column(0), b.column(1), pa.array(n.astype(np.int64)), pa.array(sums[2]), pa.array(sums[0] - n * v.log_total), pa.array(sums[1]), lists], ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "tail"])
                row += m

    return df.select("doc_id", "held_out", "text").mapInArrow(run, SCORED)


def lm_scores(df: DataFrame, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (both log10)."""
    sc = df.sparkSession.sparkContext
    df = df.select(F.col(doc_id).cast("long").alias("doc_id"), is_held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    training = df.where(~F.col("held_out")).select("text")
    counts = materialise(token_counts(training), "token-counts")
    vocabulary = learn_vocabulary(counts)
    shared = sc.broadcast(vocabulary)
    weights = train(training, shared, rounds)
    scored = materialise(score_heavy(df, shared, sc.broadcast(weights)), "lm-scored")
    rare = counts.where(F.col("c") < vocabulary.total // HEAVY + 1)
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n").join(rare, "word", "left")
    added = tail.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored.drop("tail").join(added, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"),
    )
