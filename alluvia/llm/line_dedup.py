"""Near-duplicate lines by a segment-partition edit join.

Two lines are linked if their edit distance in code points is at most the edits that the shorter one allows: one for every 12
code points it has, and 2 at most (parameters). Lines of fewer than 12 code points so equal their exact copies alone, lines of
12 to 23 link at one edit, all longer ones at two. If a line is cut into one segment more than the edits, one segment stays as
it is, so that a similar line holds it, shifted by no more places than there are edits. Every line is indexed under (edits, its
length, segment number, segment) and probes the substrings that may be a segment of a line of its length or a little shorter
(the multi-match-aware selection, at most 12 substrings in all). Candidates are verified by a banded bit-parallel edit distance,
many pairs at a time. Classes are connected components; a line repeats if its class has a line that comes earlier by
(doc_id, line number).

Equal lines are one from the start, so that a line that millions of texts share is indexed once. Index keys of more than
CROWDED lines go through stars around a leader; where some don't link to it, the lines left are compared block by block, with a
count of kinds of code points as a filter, and only links are emitted. Lines that a star connects aren't compared with each
other, so that classes are whole but numbers of links are not counted.

Lines are what stands between line feeds; blank ones are left alone. Null texts have no lines. Rows may repeat: the later copy's
lines repeat. Ties in (doc_id, line number) go to the row read first. An empty table gives an empty result; other columns than
the text and the id are not read, and may have any names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.llm.arrow_text import mix, prefix_hashes, range_hashes, row_chunks
from alluvia.llm.linking import PAIR_ROWS, connected_components, verified_links
from alluvia.llm.storage import TEXT_ROWS, discard, materialise, with_row_numbers

EDITS = 2
POINTS_PER_EDIT = 12
CROWDED = 8
PORTION = 8192
_BLANK = np.zeros(0x110000, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]] = True
_LINES = pa.list_(pa.struct([("id", pa.int64()), ("line_no", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("index", pa.list_(pa.int64())), ("probes", pa.list_(pa.int64()))]))


def segments(length: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the edits + 1 even segments of lines of these lengths; the longer ones come last."""
    n = edits + 1
    base, longer = length // n, length % n
    i = np.arange(n)[:, None]
    size = base + (i >= n - longer)
    return np.cumsum(size, 0) - size, size


def allowed_edits(length, edits: int = EDITS):
    """How many edits a line of this length allows."""
    return np.minimum(np.asarray(length) // POINTS_PER_EDIT, edits)


def line_keys(prefix: np.ndarray, start: np.ndarray, length: np.ndarray, edits: int = EDITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, key and whether it is one of the index (else only a probe), of all lines that start there in the hashed points."""
    found = []
    for e in range(1, edits + 1):
        least, most = e * POINTS_PER_EDIT, (e + 1) * POINTS_PER_EDIT - 1 if e < edits else np.iinfo(np.int64).max
        for shorter in range(e + 1):
            line = np.flatnonzero((length - shorter >= least) & (length - shorter <= most))
            own = length[line] - shorter
            at, size = segments(own, e)
            for i in range(e + 1):
                salt = mix(((own * (edits + 1) + i) * (edits + 1) + e).astype(np.uint64) + np.uint64(1))
                for shift in range(max(-i, shorter - (e - i)), min(i, shorter + (e - i)) + 1):
                    s = at[i] + shift
                    fits = (s >= 0) & (s + size[i] <= length[line])
                    who, s, n = line[fits], s[fits], size[i][fits]
                    found.append((who, (range_hashes(prefix, start[who] + s, start[who] + s + n) ^ salt[fits]).view(np.int64), np.full(len(who), not (shorter or shift))))
    return tuple(np.concatenate(x) for x in zip(*found))


def _lists(line: np.ndarray, key: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(line, kind="stable")
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(line[order], np.arange(n + 1)).astype(np.int32)), pa.array(key[order]))


def _lines_of(texts: list[str], counter: int) -> tuple[pa.Array, np.ndarray]:
    """The lines of each text with ids, hashes and keys, and how many each text has."""
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    feeds = np.flatnonzero(points == 10)
    start, stop = np.concatenate([[0], feeds[:-1] + 1]), feeds
    text = np.searchsorted(bounds, start, "right") - 1
    number = np.arange(len(start)) - np.searchsorted(start, bounds[:-1])[text]
    filled = np.concatenate([[0], np.cumsum(~_BLANK[points])])
    kept = filled[stop] > filled[start]
    start, stop, text, number = start[kept], stop[kept], text[kept], number[kept]
    one, two = prefix_hashes(points), prefix_hashes(points, 7)
    line, key, indexed = line_keys(one, start, stop - start)
    lists = [_lists(line[of], key[of], len(start)) for of in (indexed, ~indexed)]
    ids = np.arange(counter, counter + len(start))
    inner = pa.StructArray.from_arrays([pa.array(ids), pa.array(number.astype(np.int32)), pa.array(range_hashes(one, start, stop).view(np.int64)), pa.array(range_hashes(two, start, stop).view(np.int64)), *lists], fields=list(_LINES.value_type))
    at = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), inner), np.diff(at)


def hashed_lines(df: DataFrame) -> DataFrame:
    """row (unique), doc_id and lines of (doc_id, text); a given row column is kept."""
    given = "row" in df.columns
    df = df.select("doc_id", "text", *(["row"] if given else []))

    def run(batches):
        row = counter = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, stop in row_chunks(batch.column(1)):
                b = batch.slice(start, stop - start)
                lines, counts = _lines_of([t or "" for t in b.column(1).to_pylist()], counter)
                rows = b.column(2) if given else pa.array(range(row, row + b.num_rows), pa.int64())
                yield pa.RecordBatch.from_arrays([rows, b.column(0), lines], ["row", "doc_id", "lines"])
                row, counter = row + b.num_rows, counter + int(counts.sum())

    return df.mapInArrow(run, "row long, doc_id long, lines array<struct<id: long, line_no: int, h1: long, h2: long, index: array<long>, probes: array<long>>>")


def within_edits(a: list[str], b: list[str], edits: int = EDITS, most: np.ndarray | None = None) -> np.ndarray:
    """Whether each pair's edit distance is at most edits, or as many as most says, pair by pair, if that is less: equal ends are cut off, the rest goes through the band in lockstep."""
    left, right, where = [], [], []
    out = np.zeros(len(a), bool)
    most = np.full(len(a), edits) if most is None else np.minimum(most, edits)
    for k, (x, y) in enumerate(zip(a, b)):
        if abs(len(x) - len(y)) > most[k]:
            continue
        p, q = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for t in (x, y))
        n = min(len(p), len(q))
        differ = np.flatnonzero(p[:n] != q[:n])
        head = differ[0] if len(differ) else n
        p, q = p[head:], q[head:]
        n = min(len(p), len(q))
        differ = np.flatnonzero(p[len(p) - n :][::-1] != q[len(q) - n :][::-1])
        tail = differ[0] if len(differ) else n
        p, q = p[: len(p) - tail], q[: len(q) - tail]
        if min(len(p), len(q)) == 0:
            out[k] = max(len(p), len(q)) <= most[k]
        else:
            left.append(p), right.append(q), where.append(k)
    order = np.argsort([len(x) for x in left], kind="stable")
    for part in np.array_split(order, max(1, len(order) // 2048)):
        if len(part):
            pairs = [where[i] for i in part]
            out[pairs] = _banded([left[i] for i in part], [right[i] for i in part], edits) <= most[pairs]
    return out


def linked_lines(a: list[str], b: list[str]) -> np.ndarray:
    """Whether the lines of each pair are within the edits that the shorter one allows; portions of PORTION pairs bound the memory."""
    most = allowed_edits([min(len(x), len(y)) for x, y in zip(a, b)])
    out = np.zeros(len(a), bool)
    for at in range(0, len(a), PORTION):
        part = slice(at, at + PORTION)
        out[part] = within_edits(a[part], b[part], EDITS, most[part])
    return out


def _banded(a: list[np.ndarray], b: list[np.ndarray], k: int) -> np.ndarray:
    """Edit distances, right where they are at most k, by bit vectors of a band of 2k + 1 diagonals.

    Bit d of column j stands for row j + d - k. vp and vn mark where a cell exceeds, or falls below, the one above it.
    """
    n, m = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    width = max(n.max(), m.max())
    rows, columns = np.full((len(a), width + 2 * k + 1), -1, np.int64), np.full((len(b), width), -2, np.int64)
    for i, (x, y) in enumerate(zip(a, b)):
        rows[i, k : k + len(x)], columns[i, : len(y)] = x, y
    top, full = 2 * k, (1 << (2 * k + 1)) - 1
    vp, vn = np.full(len(a), (full >> k) << k, np.int64), np.zeros(len(a), np.int64)
    distance = np.minimum(n, k)
    for j in range(int(m.max())):
        same = np.zeros(len(a), np.int64)
        for d in range(top + 1):
            same |= (rows[:, j + d] == columns[:, j]).astype(np.int64) << d
        zero = ((((same & vp) + vp) ^ vp) | same | vn) & full
        hp, hn = (vn | ~(zero | vp)) & full, zero & vp
        last = n - 1 - j + k
        diagonal = 1 - (zero >> top & 1)
        bit = np.clip(last, 0, top)
        level = (hp >> bit & 1) - (hn >> bit & 1)
        distance += np.where(j < m, np.where(j + k < n, diagonal, level), 0)
        vp, vn = (hn | ~((zero >> 1) | hp)) & full, (zero >> 1) & hp
    return distance


def _line_texts(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """id and text of the wanted lines (id, doc_id, line_no, h1) from (doc_id, text); a line counts if its hash is the wanted one."""
    lists = wanted.groupBy(F.col("doc_id").alias("__d")).agg(F.collect_list(F.struct("id", "line_no", "h1")).alias("wanted"))
    held = df.join(lists, F.col("doc_id").eqNullSafe(F.col("__d"))).select("text", "wanted")

    def run(batches):
        for batch in batches:
            for start, stop in row_chunks(batch.column(0)):
                b = batch.slice(start, stop - start)
                ids, texts = [], []
                for text, lines in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    cut = (text or "").split("\n")
                    for x in lines:
                        if x["line_no"] < len(cut):
                            ids.append((x["id"], x["h1"]))
                            texts.append(cut[x["line_no"]])
                points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
                bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
                own = range_hashes(prefix_hashes(points), bounds[:-1], bounds[1:]).view(np.int64).tolist()
                kept = [i for i, (x, h) in enumerate(zip(ids, own)) if x[1] == h]
                yield pa.RecordBatch.from_arrays([pa.array([ids[i][0] for i in kept], pa.int64()), pa.array([texts[i] for i in kept], pa.string())], ["id", "line"])

    return held.mapInArrow(run, "id long, line string").dropDuplicates(["id"])


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked."""
    both = pairs.join(lines.select(F.col("id").alias("a"), F.col("line").alias("ta")), "a").join(lines.select(F.col("id").alias("b"), F.col("line").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        for batch in batches:
            for start, stop in row_chunks(batch.column(2)):
                b = batch.slice(start, stop - start)
                kept = pa.array(linked_lines(b.column(2).to_pylist(), b.column(3).to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column(0).filter(kept), b.column(1).filter(kept)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


BLOCK, BLOCK_POINTS = 1024, 1 << 20
KINDS = 32


def _linked_in_block(table: pa.Table) -> pa.Table:
    """Links between the two blocks of lines, or within the one block, of a table (bucket, i, j, block, id, label, line).

    Two lines within EDITS differ by at most twice as many in their counts of kinds of code points; pairs that pass this
    are verified. Pairs of one label are known to be connected.
    """
    ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
    label = np.array([-1 if x is None else x for x in table.column("label").to_pylist()])
    lines = table.column("line").to_pylist()
    counts = np.stack([np.bincount(mix(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)) % np.uint64(KINDS), minlength=KINDS) for x in lines]).astype(np.int32)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    right = np.flatnonzero(block == j)
    a, b = [], []
    for x in np.flatnonzero(block == i):
        near = right[np.abs(counts[right] - counts[x]).sum(1) <= 2 * EDITS]
        near = near[(ids[near] > ids[x] if i == j else ids[near] != ids[x]) & ((label[near] != label[x]) | (label[x] < 0))]
        a += [x] * len(near)
        b += near.tolist()
    kept = linked_lines([lines[k] for k in a], [lines[k] for k in b])
    x, y = ids[np.array(a, np.int64)][kept], ids[np.array(b, np.int64)][kept]
    return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y)})


def _linked_in_blocks(rest: DataFrame, lines: DataFrame) -> DataFrame:
    """Links within each bucket of (bucket, id, label): its lines are dealt to blocks of about BLOCK lines and BLOCK_POINTS code points, and every pair of blocks is one group; no pairs are emitted but links."""
    held = rest.join(lines, "id")
    blocks = held.groupBy("bucket").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("line")) / BLOCK_POINTS)).cast("int").alias("n"))
    dealt = rest.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    met = met.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "label").join(lines, "id")
    return met.groupBy("bucket", "i", "j").applyInArrow(_linked_in_block, "a long, b long").distinct()


def line_classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (doc_id, text[, row]): all rows (row, doc_id, n_lines), and the repeats (row, doc_id, line_no, first_doc, first_line)."""
    hashed = materialise(hashed_lines(df), "lines", TEXT_ROWS)
    told = F.transform("lines", lambda x: F.struct(x["id"].alias("id"), x["line_no"].alias("line_no"), x["h1"].alias("h1"), x["h2"].alias("h2")))
    slim = materialise(hashed.select("row", "doc_id", told.alias("lines")), "line-rows")
    flat = slim.select("row", "doc_id", F.explode("lines").alias("l")).select("row", "doc_id", "l.id", "l.line_no", "l.h1", "l.h2")
    order = F.struct("doc_id", "line_no", "row")
    nodes = materialise(flat.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.min(order).alias("first")), "line-nodes")
    keys = hashed.select(F.explode("lines").alias("l")).select("l.id", "l.index", "l.probes").where((F.size("index") > 0) | (F.size("probes") > 0))
    keyed = materialise(keys.join(nodes.select("id"), "id", "left_semi"), "line-keys")
    discard(hashed)
    index = keyed.select("id", F.explode("index").alias("key"))
    lookups = keyed.select("id", F.explode(F.concat("index", "probes")).alias("key"))
    shared = lookups.join(index.withColumnRenamed("id", "other"), "key").where("id != other")
    crowded = materialise(index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("key"), "crowded-keys")
    if crowded.isEmpty():
        many = None
        pairs = shared
    else:
        many = materialise(lookups.join(crowded, "key", "left_semi").select(F.col("key").alias("bucket"), F.lit(0).alias("band"), "id").distinct(), "crowded")
        pairs = lookups.join(index.join(crowded, "key", "left_anti").withColumnRenamed("id", "other"), "key").where("id != other")
    pairs = materialise(pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct(), "line-pairs")
    discard(keyed)
    ids = [pairs.select(F.col("a").alias("id")), pairs.select(F.col("b").alias("id")), *([many.select("id")] if many is not None else [])]
    wanted = flat.select("id", "doc_id", "line_no", "h1").join(reduce(DataFrame.unionByName, ids).distinct(), "id", "left_semi")
    lines = materialise(_line_texts(df.select("doc_id", "text"), wanted), "line-texts", PAIR_ROWS)
    links = _verified(pairs, lines)
    if many is not None:
        links = links.unionByName(verified_links(many, lambda p: _verified(p, lines), lambda rest, level: None, lambda rest: _linked_in_blocks(rest, lines))).distinct()
    links = materialise(links, "line-links", PAIR_ROWS)
    discard(pairs, lines)
    rooted = materialise(nodes.join(connected_components(links), "id", "left").withColumn("root", F.coalesce("root", "id")), "rooted")
    discard(nodes, links)
    classes = rooted.groupBy("root").agg(F.sum("n").alias("total"), F.min("first").alias("f")).where("total > 1")
    members = rooted.join(classes, "root").select("h1", "h2", "f")
    found = flat.select("row", "doc_id", "line_no", "h1", "h2").join(members, ["h1", "h2"])
    found = found.select("row", "doc_id", "line_no", F.col("f.doc_id").alias("first_doc"), F.col("f.line_no").alias("first_line"), F.col("f.row").alias("first_row"))
    return slim.select("row", "doc_id", F.size("lines").cast("long").alias("n_lines")), found


def _is_repeat():
    return ~((F.col("first_row") == F.col("row")) & (F.col("first_line") == F.col("line_no")))


def line_dedup(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_lines (not blank), n_repeats, and repeats: line number, document and line number of the class's first line, joined by colons and commas in line order."""
    rows, members = line_classes(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    mark = F.concat_ws(":", F.col("line_no").cast("string"), F.coalesce(F.col("first_doc").cast("string"), F.lit("")), F.col("first_line").cast("string"))
    told = members.where(_is_repeat()).groupBy("row").agg(F.count("*").alias("n_repeats"), F.sort_array(F.collect_list(F.struct("line_no", mark.alias("mark")))).alias("all"))
    joined = F.array_join(F.transform("all", lambda x: x["mark"]), ",")
    return rows.join(told, "row", "left").select("doc_id", "n_lines", F.coalesce("n_repeats", F.lit(0)).alias("n_repeats"), F.coalesce(joined, F.lit("")).alias("repeats"))


def without_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """df with the repeating lines taken out of its texts; rows whose text was filled and has only blanks left go, all others stay.

    Columns of df may have any names but those that begin with __line_dedup_.
    """
    row, drop, kept = (f"__line_dedup_{x}" for x in ("row", "drop", "kept"))
    numbered = with_row_numbers(df, row)
    _, members = line_classes(numbered.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(row).alias("row")))
    told = members.where(_is_repeat()).groupBy(F.col("row").alias(row)).agg(F.collect_set("line_no").alias(drop))

    def others(lines):
        """The lines that aren't dropped: the numbers left are found by a hash set, once for each text."""
        return F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop)), lambda i: F.get(lines, i))

    left = F.array_join(F.element_at(F.transform(F.array(F.split(F.col(text), "\n")), others), 1), "\n")
    out = numbered.join(told, row, "left").withColumn(kept, F.when(F.col(drop).isNull(), F.col(text)).otherwise(left))
    emptied = F.col(drop).isNotNull() & ~F.col(kept).rlike(r"\S")
    return out.where(~emptied).withColumn(text, F.col(kept)).select(*df.columns)
