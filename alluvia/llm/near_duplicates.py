"""Near-duplicate texts: improved consistent weighted sampling (ICWS) over TF-IDF shingles, banded, then verified.

A text's words are its runs of letters, digits and other characters than ASCII signs, ASCII letters in lower case; its shingles
are five words in a row (all words, if there are fewer). A shingle weighs its count in the text times the mean idf of its words,
idf being 1 + log(N / df) / log(N / least df), between 1 and 2. The idf is taken from words: a df of whole shingles would make
the text that a large group of copies shares nearly weightless, and its members would seem unlike each other only because they
are many. Words of fewer documents than 1 in 2**17 of all (document, word) pairs share the highest idf, so that the broadcast
table has at most 2**17 rows whatever the corpus. That bound is a share of the documents (pairs a document / 2**17), not a
number of them: a word that a given share of the documents holds weighs the same in a corpus of any size.

Two texts link if their weighted Jaccard similarity, computed from the whole texts, is at least 0.8 (a parameter). The
candidates share a band of ICWS samples, and every pair of candidates is compared: those of small buckets one by one, those of
larger buckets block by block, where the links are counted and only as many emitted as keep the blocks' texts connected.
Classes are the connected components; equal texts are one class from the start.
Null texts are empty; empty texts equal each other; a text without words links to nothing but its copies. Rows may repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.llm import linking
from alluvia.llm.arrow_text import Table, letters_table, mix, row_chunks, utf8, words
from alluvia.llm.linking import connected_components
from alluvia.llm.storage import TEXT_ROWS, materialise, with_row_numbers

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
BLOCK, BLOCK_POINTS = 2048, 4 << 20
HEAVY = 1 << 17
SIGNS = bytes(b for b in range(1, 128) if not chr(b).isalnum())
LETTERS = letters_table(SIGNS)
_STEP = np.uint64(0x9FB21C651E98DF25)


def word_frequencies(texts: DataFrame) -> DataFrame:
    """word (a 64-bit hash) and df, the rows that hold it."""

    def run(batches):
        for batch in batches:
            for start, stop in row_chunks(batch.column(0)):
                data, offsets = utf8(batch.column(0).slice(start, stop - start))
                hashes, _, _, first = words(data, offsets, LETTERS)
                row = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(first))
                _, once = np.unique(hashes + mix(row + np.uint64(1)), return_index=True)
                word, n = np.unique(hashes[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "df"])

    return texts.mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df"))


class Weights:
    """idf of words from a bounded table; words that aren't in it have the highest."""

    def __init__(self, n: int, least: int, keys: np.ndarray, df: np.ndarray):
        top = max(np.log(max(n, 2) / max(1, min(least, n / 2))), 1e-9)
        self.idf = np.append(1 + np.clip(np.log(max(n, 1) / df.astype(np.float64)) / top, 0, 1), 2.0) if len(df) else np.array([2.0])
        self.table = Table(keys, df)

    def of(self, words_: np.ndarray) -> np.ndarray:
        return self.idf[self.table.find(words_)]


def learn_weights(texts: DataFrame) -> Weights:
    """Document frequencies of all rows; the words above the least df are collected, at most HEAVY of them."""
    counts = materialise(word_frequencies(texts), "word-df", TEXT_ROWS)
    n, total = texts.count(), counts.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    least = total // HEAVY + 1
    rows = counts.where(F.col("df") >= least).toArrow()
    return Weights(n, least, rows.column("word").to_numpy().view(np.uint64), rows.column("df").to_numpy())


def shingle_rows(column: pa.Array, weights: Weights):
    """For each row of a chunk the distinct shingles, sorted, and their weights."""
    data, offsets = utf8(column)
    hashes, _, _, first = words(data, offsets, LETTERS)
    idf = np.concatenate([[0.0], np.cumsum(weights.of(hashes))])
    n = len(hashes)
    value = np.zeros(max(n - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        value = value * _STEP + hashes[k : k + len(value)]
    value = mix(value)
    for start, stop in zip(first[:-1].tolist(), first[1:].tolist()):
        if stop - start >= SHINGLE:
            own, at, tf = np.unique(value[start : stop - SHINGLE + 1], return_index=True, return_counts=True)
            yield own, tf * (idf[start + at + SHINGLE] - idf[start + at]) / SHINGLE
        elif stop > start:
            whole = np.uint64(stop - start)
            for h in hashes[start:stop]:
                whole = np.uint64((int(whole) * int(_STEP) + int(h)) & 0xFFFFFFFFFFFFFFFF)
            yield mix(np.array([whole], np.uint64)), np.array([(idf[stop] - idf[start]) / (stop - start)])
        else:
            yield np.zeros(0, np.uint64), np.zeros(0)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser over sum of the greater weights of sorted distinct shingles; 0 if either has none."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


class Sampler:
    """ICWS with the random variables of each shingle and sample read from quantile tables by hash bits."""

    def __init__(self, samples: int = BANDS * ROWS, bits: int = 14):
        steps = (np.arange(1 << bits) + 0.5) / (1 << bits)
        x = np.full(len(steps), 1.0)  # quantiles of Gamma(2, 1): 1 - (1 + x) exp(-x) = p, by bisection
        low, high = np.zeros(len(steps)), np.full(len(steps), 60.0)
        for _ in range(60):
            x = (low + high) / 2
            below = 1 - (1 + x) * np.exp(-x) < steps
            low, high = np.where(below, x, low), np.where(below, high, x)
        self.bits, self.r, self.log_c = np.uint64(bits), x.astype(np.float32), np.log(x).astype(np.float32)
        self.mask = np.uint64((1 << bits) - 1)
        self.seeds = mix(np.arange(1, samples + 1, dtype=np.uint64))

    def samples(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit sample per seed; blocks bound the memory of long texts."""
        best = np.full(len(self.seeds), np.inf, np.float32)
        out = np.zeros(len(self.seeds), np.uint64)
        for at in range(0, len(shingles), 2048):
            s, log_w = shingles[at : at + 2048], np.log(weights[at : at + 2048]).astype(np.float32)
            x = (self.seeds[:, None] ^ s) * np.uint64(0xFF51AFD7ED558CCD)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xC4CEB9FE1A85EC53)
            r = self.r[x & self.mask]
            log_c = self.log_c[(x >> self.bits) & self.mask]
            beta = (x >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
            t = np.floor(log_w / r + beta)
            log_a = log_c - r * (t - beta + 1)
            k = log_a.argmin(1)
            each = np.arange(len(k))
            less = log_a[each, k] < best
            best = np.where(less, log_a[each, k], best)
            out = np.where(less, mix(s[k] + t[each, k].astype(np.int64).astype(np.uint64) * _STEP), out)
        return out

    def bands(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        rows = self.samples(shingles, weights).reshape(BANDS, ROWS)
        value = np.arange(1, BANDS + 1, dtype=np.uint64)
        for k in range(ROWS):
            value = mix(value * _STEP + rows[:, k])
        return value.view(np.int64)


def signatures(df: DataFrame, weights, text: str = "text", doc_id: str = "doc_id", row_number: str | None = None) -> DataFrame:
    """row (unique), doc_id, digest (md5 of the text) and bands, empty for a text without words; row_number names a column that is the row."""
    given = row_number is not None

    def run(batches):
        sampler, row = Sampler(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, stop in row_chunks(batch.column(1)):
                b = batch.slice(start, stop - start)
                digests = [hashlib.md5((t or "").encode()).hexdigest() for t in b.column(1).to_pylist()]
                seen: dict[str, np.ndarray] = {}
                bands = []
                for digest, (own, w) in zip(digests, shingle_rows(b.column(1), weights.value)):
                    if digest not in seen:
                        seen[digest] = sampler.bands(own, w) if len(own) else np.zeros(0, np.int64)
                    bands.append(seen[digest])
                n = b.num_rows
                rows = b.column(2) if given else pa.array(range(row, row + n), pa.int64())
                yield pa.RecordBatch.from_arrays([rows, b.column(0), pa.array(digests, pa.string()), pa.array(bands, pa.list_(pa.int64()))], ["row", "doc_id", "digest", "bands"])
                row += n

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *([F.col(row_number).alias("row")] if given else [])).mapInArrow(run, "row long, doc_id long, digest string, bands array<long>")


def similar_pairs(pairs: DataFrame, texts: DataFrame, weights, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) have at least this weighted Jaccard similarity, with it."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        for batch in batches:
            for start, stop in row_chunks(batch.column(2)):
                b = batch.slice(start, stop - start)
                left = b.column(0).to_pylist()
                found = [weighted_jaccard(x, y) for x, y in zip(_texts(b.column(2), left, weights.value), shingle_rows(b.column(3), weights.value))]
                kept = np.array(found) >= similarity
                yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(kept)), b.column(1).filter(pa.array(kept)), pa.array(np.array(found)[kept], pa.float64())], ["a", "b", "similarity"])

    return both.mapInArrow(run, "a long, b long, similarity double")


def _texts(column: pa.Array, keys: list[int], weights: Weights):
    """shingle_rows of a column whose keys repeat in a row: each run is computed once."""
    heads = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
    own = list(shingle_rows(column.take(pa.array(heads, pa.int64())), weights))
    at = -1
    for i in range(len(keys)):
        at += i == 0 or keys[i] != keys[i - 1]
        yield own[at]


def block_links(left: list[int], right: list[int], rows: list[tuple[np.ndarray, np.ndarray]], bands: np.ndarray, wide: np.ndarray, band: int, similarity: float) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Of the pairs of a left and a right row whose first common band is this one and that have no narrow common band: as many links
    as keep all linked rows connected, and each row's number of links. left and right are the same list or have no common row."""
    sizes = np.array([len(s) for s, _ in rows])
    starts = np.cumsum(sizes) - sizes
    codes = np.unique(np.concatenate([s for s, _ in rows]), return_inverse=True)[1]
    weights = np.concatenate([w for _, w in rows])
    totals = np.array([w.sum() for _, w in rows])
    dense = np.zeros(int(codes.max()) + 1)
    links, degree, label = [], np.zeros(len(rows), np.int64), np.arange(len(rows))
    others = np.array(right)
    for at, x in enumerate(left):
        near = others[at + 1 :] if left is right else others
        common = bands[near] == bands[x]
        own = common[:, band] & ~common[:, :band].any(1) & ~(common & ~wide[x]).any(1)
        near = near[own & (np.minimum(totals[near], totals[x]) >= (similarity - 1e-9) * np.maximum(totals[near], totals[x]))]
        if not len(near):
            continue
        mine = slice(starts[x], starts[x] + sizes[x])
        dense[codes[mine]] = weights[mine]
        ends = np.cumsum(sizes[near])
        each = np.repeat(starts[near] - (ends - sizes[near]), sizes[near]) + np.arange(ends[-1])
        both = np.add.reduceat(np.minimum(dense[codes[each]], weights[each]), ends - sizes[near])
        dense[codes[mine]] = 0
        found = both / (totals[near] + totals[x] - both)
        for k in np.flatnonzero(np.abs(found - similarity) < 1e-9):  # the order of the sum may decide: as verify() does it
            found[k] = weighted_jaccard(*(rows[i] for i in sorted((x, near[k]))))
        near = near[found >= similarity]
        degree[x] += len(near)
        degree[near] += 1
        reached, first = np.unique(label[near], return_index=True)
        for other, k in zip(reached, first):
            if other != label[x]:
                links.append((x, int(near[k])))
                label[label == other] = label[x]
    return links, degree


def links_in_blocks(large: DataFrame, nodes: DataFrame, texts: DataFrame, weights, similarity: float) -> DataFrame:
    """Links (a, b, n null) and numbers of links (a, b null, n) of all candidates that share buckets of large (bucket, band, id) and no other.

    A bucket's texts are dealt to blocks of at most about BLOCK texts and BLOCK_POINTS characters; every pair of blocks is one
    group. A pair counts in its first band only.
    """
    wide = large.groupBy("id").agg(F.collect_set("band").alias("wide"))
    members = wide.join(nodes.select("id", "bands"), "id").join(texts, "id")
    measured = large.join(members.select("id", F.length("text").alias("points")), "id")
    parts = measured.groupBy("bucket").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("points") / BLOCK_POINTS)).cast("int").alias("k"))
    dealt = large.join(parts, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    met = met.select("bucket", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id").join(members, "id")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        texts_ = table.column("text").combine_chunks()
        rows = [r for start, stop in row_chunks(texts_) for r in shingle_rows(texts_.slice(start, stop - start), weights.value)]
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        told = np.zeros((len(ids), BANDS), bool)
        for at, x in enumerate(table.column("wide").to_pylist()):
            told[at, x] = True
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left = np.flatnonzero(block == i).tolist()
        links, degree = block_links(left, left if i == j else np.flatnonzero(block == j).tolist(), rows, bands, told, table.column("band")[0].as_py(), similarity)
        counted = np.flatnonzero(degree)
        a, b = (ids[np.array([x[k] for x in links], np.int64)] for k in (0, 1))
        none, n = [None] * len(links), len(counted)
        return pa.table({"a": pa.array([*a.tolist(), *ids[counted].tolist()], pa.int64()), "b": pa.array(b.tolist() + [None] * n, pa.int64()), "n": pa.array(none + degree[counted].tolist(), pa.int64())})

    return met.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long, n long")


def near_duplicate_rows(df: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY, row_number: str | None = None) -> DataFrame:
    """One row per input row: row, doc_id, digest, class_row (the first row of its class) and n_links of its text to different texts."""
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    weights = spark.sparkContext.broadcast(learn_weights(texts))
    signed = materialise(signatures(df, weights, text, doc_id, row_number), "signatures", TEXT_ROWS)
    nodes = materialise(signed.groupBy("digest").agg(F.min("row").alias("id"), F.min_by("doc_id", "row").alias("doc_id"), F.min_by("bands", "row").alias("bands")), "nodes")
    entries = nodes.select("id", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("bucket"), "band", "id")

    met = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    wanted = entries.join(met, "bucket").select("id").distinct().join(nodes.drop("bands"), "id")
    found = df.select(F.col(doc_id).cast("long").alias("__d"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = found.join(wanted, found["__d"].eqNullSafe(wanted["doc_id"]) & (F.md5(found["text"]) == wanted["digest"])).select("id", "text")
    candidates = materialise(found.groupBy("id").agg(F.first("text").alias("text")), "candidate-texts")

    sized = materialise(entries.join(met, "bucket"), "buckets")
    pairs = linking._pairs_within(sized.where(F.col("n") <= linking.SMALL).withColumn("label", F.lit(None).cast("long"))).distinct()
    links = materialise(similar_pairs(materialise(pairs, "pairs"), candidates, weights, similarity), "links", linking.PAIR_ROWS).select("a", "b")
    large = sized.where(F.col("n") > linking.SMALL).select("bucket", "band", "id")
    blocks = materialise(links_in_blocks(large, nodes, candidates, weights, similarity), "block-links")
    degree = links.select(F.col("a").alias("id"), F.lit(1).cast("long").alias("n")).unionByName(links.select(F.col("b").alias("id"), F.lit(1).cast("long").alias("n")))
    degree = degree.unionByName(blocks.where("n IS NOT NULL").select(F.col("a").alias("id"), "n")).groupBy("id").agg(F.sum("n").alias("n_links"))
    links = materialise(links.unionByName(blocks.where("n IS NULL").select("a", "b")), "text-links")
    roots = connected_components(links)
    classes = nodes.select("id", "digest").join(roots, "id", "left").join(degree, "id", "left").select("digest", F.coalesce("root", "id").alias("class_row"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return signed.select("row", "doc_id", "digest").join(classes, "digest")


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, class_id (the least doc_id of its class), class_size in rows and n_links."""
    rows = materialise(near_duplicate_rows(df, text, doc_id, similarity), "classes")
    classes = materialise(rows.groupBy("class_row").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "class-sizes")  # so that the join can split a large class
    return rows.join(classes, "class_row").select("doc_id", "class_id", "class_size", "n_links")


def one_of_each_class(df: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of df that come first in their classes, whole. Columns of df may have any names but __near_duplicates_row."""
    name = "__near_duplicates_row"
    numbered = with_row_numbers(df, name)
    first = near_duplicate_rows(numbered, text, doc_id, similarity, name).where("row = class_row").select(F.col("row").alias(name))
    return numbered.join(first, name, "left_semi").select(*df.columns)
