import random

import pytest

from alluvia.llm.line_dedup import POINTS_PER_EDIT, line_dedup, within_edits, without_repeats


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    s = list(text)
    for _ in range(n):
        k = rng.randrange(3)
        at = rng.randrange(len(s) + (k == 0))
        if k == 0:
            s.insert(at, rng.choice("abé"))
        elif k == 1:
            s[at] = rng.choice("abé")
        elif len(s) > 1:
            del s[at]
    return "".join(s)


def test_band_against_full_table():
    rng = random.Random(1)
    a = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    b = [edited(rng, x, rng.randint(0, 4)) for x in a]
    for edits in (1, 2, 3):
        assert within_edits(a, b, edits).tolist() == [distance(x, y) <= edits for x, y in zip(a, b)]


def brute(rows):
    lines = [(d, k, r, x) for r, (d, t) in enumerate(rows) for k, x in enumerate((t or "").split("\n")) if x.strip()]
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(lines):
        for j in range(i):
            a, b = x[3], lines[j][3]
            most = min(2, min(len(a), len(b)) // POINTS_PER_EDIT)
            if a == b or (abs(len(a) - len(b)) <= most and distance(a, b) <= most):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    first = {}
    for i, x in enumerate(lines):
        first[find(i)] = min(first.get(find(i), x[:3]), x[:3])
    out = [[] for _ in rows]
    for i, x in enumerate(lines):
        f = first[find(i)]
        if f != x[:3]:
            out[x[2]].append(f"{x[1]}:{f[0]}:{f[1]}")
    return sorted((d, ",".join(o)) for (d, _), o in zip(rows, out))


@pytest.mark.parametrize("crowd", [0, 50])
@pytest.mark.parametrize("longest", [60, 26])
def test_against_all_pairs(spark, crowd, longest):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, longest))) for _ in range(30)]
    rows = []
    for i in range(40):
        text = "\n".join([edited(rng, rng.choice(base), rng.randint(0, 3)) for _ in range(4)] + ["", "  "] * (i % 2))
        rows.append((i, text))
    rows += [(100 + i, "the very same long beginning of a line " + "".join(rng.choice("xyz") for _ in range(30))) for i in range(crowd)]
    got = sorted((r["doc_id"], r["repeats"]) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (3, "x\n\nx\n" + "y" * 30), (3, "x\n\nx\n" + "y" * 30), (4, "z" * 100000)]])
def test_edges(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup(df).collect()
    assert len(got) == len(rows)
    kept = sorted((r["doc_id"], r["text"]) for r in without_repeats(df).collect() if r["text"] is not None)
    assert kept == ([(2, ""), (3, "x\n\n" + "y" * 30), (4, "z" * 100000)] if rows else [])


def test_stored_rows_are_numbered_without_a_copy(spark, tmp_path):
    from alluvia.llm.storage import with_row_numbers

    line = "a line that is long enough to be compared with others"
    rows = [(None, f"{line}\nown {i} words of the text" if i % 3 else None, i % 5) for i in range(60)] + [(1, line, 7)] * 2
    made = spark.createDataFrame(rows, "doc_id long, text string, row int")
    made.repartition(4).write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    numbered = with_row_numbers(stored, "__n")
    assert numbered.columns == [*stored.columns, "__n"]
    assert numbered.select("__n").distinct().count() == len(rows)
    assert not any("/alluvia/" in x for x in numbered.inputFiles())
    kept = without_repeats(stored).collect()
    assert sum(line in (r.text or "") for r in kept) == 1
    assert sum(r.text is None for r in kept) == 20


def test_crowd_of_one_prefix(spark):
    """Thousands of different lines with one beginning: every pair is within the edits or apart as brute force on a sample of the ends says."""
    rng = random.Random(9)
    ends = ["".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(1500)]
    ends += [edited(rng, rng.choice(ends), rng.randint(1, 3)) for _ in range(700)]
    rows = [(i, "2026-01-01 00:00:00 service started on host " + e) for i, e in enumerate(ends)]
    got = {r["doc_id"]: r["repeats"] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    root = list(range(len(ends)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    deleted = {}
    for i, e in enumerate(ends):  # lines within two edits share what is left when each loses at most two code points
        cuts = {e} | {e[:k] + e[k + 1 :] for k in range(len(e))}
        cuts |= {c[:k] + c[k + 1 :] for c in list(cuts) for k in range(len(c))}
        near = {j for c in cuts for j in deleted.get(c, ())}
        for j in near:
            if distance(e, ends[j]) <= 2:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
        for c in cuts:
            deleted.setdefault(c, []).append(i)
    assert got == {i: "" if find(i) == i else f"0:{find(i)}:0" for i in range(len(ends))}


def test_clashing_columns(spark):
    rows = [(1, "same line\nown", 3, "x", True), (2, "same line\nother", 4, "y", False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, lines string, __drop boolean")
    assert without_repeats(df).orderBy("doc_id").collect() == [(1, "same line\nown", 3, "x", True), (2, "other", 4, "y", False)]
    assert line_dedup(df).count() == 2
