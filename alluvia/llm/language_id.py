"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every run of other characters than letters becomes one space, and all n-grams of 1 to 4 code points are
hashed to buckets. Each language has one log probability per bucket (Laplace smoothing) and a prior, its smoothed share of the
learnt texts; the matrix is broadcast, its size being languages x buckets whatever the corpus. Batches are scored by gathering
and summing in numpy, sums over a text's n-grams of all orders.

Null texts and texts without a letter are `und` with score 0. Ties go to the first language in sorted order. Languages are
those of the labelled rows; without any, and so for an empty table, every text is `und`. Repeated rows give repeated rows.
Columns of the input may have any names: those that clash with a result's are replaced, in identify() by names of one's choice.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.llm.arrow_text import row_chunks

BUCKETS = 1 << 15
LONGEST = 4
FIT_ROWS = 20_000
FIT_TASKS = 16
SPACE = 32
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, those of one order after another, and each text's letters and spaces as offsets."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)
    letter = letters()[points]
    before = np.zeros(len(points), bool)
    before[1:] = letter[:-1]
    begins = offsets[:-1]
    before[begins[begins < len(points)]] = False
    kept = letter | before
    points = np.where(letter, points, np.uint32(SPACE))[kept]
    offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
    n = len(points)
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    out = np.full((LONGEST, n), BUCKETS, np.int32)
    value = np.zeros(n, np.uint32)
    for k in range(min(LONGEST, n)):
        value = value[: n - k] * np.uint32(0x01000193) + (points[k:] + np.uint32(k)) * np.uint32(0x9E3779B1)
        mixed = value ^ (value >> np.uint32(15))
        mixed = mixed * np.uint32(0x85EBCA6B)
        bucket = (mixed >> np.uint32(32 - 15)).astype(np.int32)
        fits = room[: n - k] > k
        out[k, : n - k][fits] = bucket[fits]
    return out, offsets


def is_held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of doc_id as text falls in the part that is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


class LanguageModel:
    """Sorted languages, their log probabilities by bucket, of which the last column, for no n-gram, is zero, and their log priors."""

    def __init__(self, languages: list[str], log_probability: np.ndarray, log_prior: np.ndarray):
        self.languages, self.log_probability, self.log_prior = languages, log_probability, log_prior

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log priors and summed log probabilities by language and text, and whether the text has a letter."""
        buckets, offsets = grams(texts)
        some = np.diff(offsets) > 0
        out = np.zeros((len(self.languages), len(texts)))
        for k, row in enumerate(self.log_probability):
            each = row[buckets[0]].astype(np.float64)
            for order in buckets[1:]:
                each += row[order]
            total = np.concatenate([[0.0], np.cumsum(each)])
            out[k] = self.log_prior[k] + total[offsets[1:]] - total[offsets[:-1]]
        return out, some

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The most probable language of each text and its posterior probability."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        log, some = self.scores(texts)
        best = log.argmax(0)
        score = 1 / np.exp(np.minimum(log - log.max(0), 0)).sum(0)
        return [self.languages[b] if s else "und" for b, s in zip(best, some)], np.where(some, score, 0.0)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Learn from about fit_rows of the labelled rows (all if there are no more), chosen by a hash of the key.

    The bounded sample goes to FIT_TASKS tasks; each returns one vector of counts for each language, summed by language.
    """
    labelled = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    n = labelled.count()
    if n > fit_rows:
        labelled = labelled.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) < int(fit_rows / n * (1 << 30)))

    def count(batches):
        counts: dict[str, np.ndarray] = {}  # the last place is the number of texts
        for batch in batches:
            for start, stop in row_chunks(batch.column(1)):
                b = batch.slice(start, stop - start)
                buckets, offsets = grams(b.column(1).to_pylist())
                for k, label in enumerate(b.column(0).to_pylist()):
                    counts.setdefault(label, np.zeros(BUCKETS + 1, np.int64))
                    counts[label] += np.append(np.bincount(buckets[:, offsets[k] : offsets[k + 1]].ravel(), minlength=BUCKETS + 1)[:BUCKETS], 1)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c.tobytes() for c in counts.values()], pa.binary())], ["lang", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in pdf["counts"])
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "counts": [total.tobytes()]})

    schema = "lang string, counts binary"
    sample = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).repartition(FIT_TASKS)
    rows = sorted(sample.mapInArrow(count, schema).groupBy("lang").applyInPandas(add, schema).collect())
    matrix, texts = np.zeros((len(rows), BUCKETS + 1), np.float32), np.zeros(len(rows))
    for k, row in enumerate(rows):
        counts, texts[k] = np.frombuffer(row["counts"], np.int64)[:BUCKETS], np.frombuffer(row["counts"], np.int64)[BUCKETS]
        matrix[k, :BUCKETS] = np.log((counts + 0.5) / (counts.sum() + 0.5 * BUCKETS))
    return LanguageModel([r["lang"] for r in rows], matrix, np.log((texts + 0.5) / (texts + 0.5).sum()) if rows else texts)


def identify(df: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of df and two of these names; clashing columns of df are replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    df = df.drop(lang_pred, score)
    at, names = df.columns.index(text), df.columns

    def run(batches):
        for batch in batches:
            for start, stop in row_chunks(batch.column(at)):
                b = batch.slice(start, stop - start)
                langs, each = shared.value.predict([t or "" for t in b.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(each, pa.float64())], [*names, lang_pred, score])

    return df.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + f", `{lang_pred}` string, `{score}` double")


def language_id(df: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, from a model of the rows that aren't held out."""
    df = df.withColumn("held_out", is_held_out(F.col(doc_id)))
    model = fit(df.where(~F.col("held_out")), text, lang, doc_id, fit_rows)
    return identify(df.select(F.col(doc_id).cast("long").alias("doc_id"), "held_out", F.col(text).alias("text")), model).select("doc_id", "held_out", "lang_pred", "score")
