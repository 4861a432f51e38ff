import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from alluvia.llm.language_id import fit, identify, is_held_out

DATA = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, score double, row string"


def written(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["language", "repeated_lines", "near_duplicates", "benchmark_leaks", "token_ids"]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = written(pipeline.language(spark, docs, DATA), tmp_path / "1")
    model = fit(docs.where(~is_held_out(F.col("doc_id"))))
    expected = {r["doc_id"] for r in identify(docs, model).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert {r["doc_id"] for r in kept.collect()} == expected and kept.columns == docs.columns

    lines = written(pipeline.repeated_lines(spark, kept, DATA), tmp_path / "2")
    seen, before = set(), {r["doc_id"]: r["text"] for r in kept.collect()}
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.collect()}
    for k in sorted(before):  # exact repeats go, at the least
        first = [x for x in before[k].split("\n") if not x.strip() or x not in seen]
        seen.update(before[k].split("\n"))
        left = after.get(k, ("", 0))[0].split("\n")
        assert set(left) <= set(first) | {""}
    assert all(n == len(t) for t, n in after.values())

    unique = written(pipeline.near_duplicates(spark, lines, DATA), tmp_path / "3")
    texts = [r["text"] for r in unique.collect()]
    assert len(set(texts)) == len(texts) and unique.count() <= lines.count()

    clean = written(pipeline.benchmark_leaks(spark, unique, DATA), tmp_path / "4")
    items = [shingles(r[0]) for r in duckdb.sql(f"SELECT text FROM '{DATA}/benchmark.parquet'").fetchall()]
    gone = {r["doc_id"] for r in unique.collect()} - {r["doc_id"] for r in clean.collect()}
    for r in unique.collect():  # a document that holds all of an item's shingles goes, one without any stays
        own = set(shingles(r["text"]))
        if any(i and own >= set(i) for i in items):
            assert r["doc_id"] in gone
        if not any(own & set(i) for i in items):
            assert r["doc_id"] not in gone

    ids = pipeline.token_ids(spark, clean, DATA).collect()
    assert {r["doc_id"] for r in ids} == {r["doc_id"] for r in clean.collect()}
    assert all(r["n_tokens"] == len(r["ids"]) for r in ids)


EDGES = [
    (1, "the house of the river and the light", "en", "a", 1, 7.5, "x"), (1, "the house of the river and the light", "en", "a", 1, 7.5, "x"), (2, None, None, None, None, None, None),
    (3, "", "en", "a", 0, 1.0, "y"), (None, "das haus und der garten ist alt und leer", "de", "b", 5, 2.0, "z"), (4, "ab", "de", "b", 2, None, "w"), (5, "der garten " * 20_000, "de", "b", 2, 3.0, "v"),
]


@pytest.mark.parametrize("rows", [[], EDGES])
def test_edges_and_clashing_columns(spark, tmp_path, rows):
    docs = written(spark.createDataFrame(rows, DOCUMENT), tmp_path / "documents.parquet")
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, (name, stage) in enumerate(pipeline.STAGES):
        docs = written(stage(spark, docs, str(tmp_path)), tmp_path / str(k))
        if name != "token_ids":
            assert docs.columns == [c.split()[0] for c in DOCUMENT.split(", ")]
            told = {r["doc_id"]: (r["score"], r["row"]) for r in docs.collect()}
            assert all(told[r[0]] == (r[5], r[6]) for r in rows if r[0] in told)
    assert bool(rows) == bool(docs.count())


def test_lazy_queries_and_the_pipeline_mix(spark, tmp_path):
    from alluvia.llm.queries import QUERIES

    first, second = QUERIES["op3_secret_scan"](spark, DATA), QUERIES["op7_line_dedup"](spark, DATA)
    result = pipeline.run(spark, DATA)
    again = pipeline.run(spark, "/root/testdata/sf0.01/../sf0.001")
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert first.count() == n and second.count() == n
    assert result.count() == again.count() > 0
