"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check; DataFrame functions only.

Words are runs of letters and digits in lower case; shingles are five words in a row. A window is a stretch of a text as long
(in words) as some benchmark item. Similarity of window and item is the weighted Jaccard similarity of their shingles, a
shingle weighing as often as it occurs; a text is contaminated by an item if a window reaches 0.8 (a parameter).

Windows without a shingle of the benchmark can't reach any similarity above 0, so windows are laid where text and item share
a shingle, in the alignment of that shingle; one that would begin before the text or end behind it is moved inside, and a text
shorter than the item is one window. Equal windows are taken once. Each window's 64-bit SimHash is compared with the
items' by multi-index hashing: fingerprints are cut into 4 blocks of 16 bits; if two differ in at most 15 bits, some block
differs in at most 3, so that looking up each block of the window among the items' blocks with all changes of up to 3 bits
finds every fingerprint within the radius. The pairs found are then checked exactly. At similarity 0.8 the expected distance is
about 10 bits with a standard deviation of 3.

Items of fewer than five words match nothing (one common word would flag every text); null and short texts match nothing.
Items are told apart by item_id; repeated rows of a text give one row per doc_id and item, and windows that tie go to the first.
Empty tables on either side give an empty result; other columns than the ids and texts are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.llm.storage import materialise

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, CHANGES = 4, 16, 3
RADIUS = BLOCKS * (CHANGES + 1) - 1
LANES = 0x0000000100000001


def word_array(text: Column) -> Column:
    """Words of a text, an empty array if it has none."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def shingle_array(words: Column) -> Column:
    """Hashes of the shingles of an array of words, in order.

    The array is bound to a lambda variable, so that it is made once and not in each step, wherever the optimiser moves this.
    """

    def of(w: Column) -> Column:
        n = F.size(w) - (SHINGLE - 1)
        hashes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        return F.when(n > 0, hashes).otherwise(F.array().cast("array<long>"))

    return F.element_at(F.transform(F.array(words), of), 1)


def simhash(rows: DataFrame, key: str, shingle: str) -> DataFrame:
    """key and fingerprint: bit i is set if more than half of the key's shingles (rows) have it set.

    Thirty-two sums count two bits each in lanes of 32 bits. The bits are gathered by one loop over them, not by an expression
    for each: the driver copies a plan's expressions at every step of planning.
    """
    sums = F.array(*[F.sum(F.shiftrightunsigned(F.col(shingle), i).bitwiseAND(F.lit(LANES))) for i in range(32)])
    counts = rows.groupBy(key).agg(F.count("*").alias("n"), sums.alias("sums"))

    def with_bit(bits: Column, i: Column) -> Column:
        lane = F.call_function("shiftrightunsigned", F.get("sums", i % 32), F.when(i < 32, 0).otherwise(32)).bitwiseAND(F.lit(0xFFFFFFFF))
        return bits.bitwiseOR(F.call_function("shiftleft", (lane * 2 > F.col("n")).cast("long"), i))

    bits = F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), with_bit)
    return counts.select(key, bits.alias("fingerprint"))


def _blocks(fingerprint: Column) -> Column:
    return F.array(*[F.shiftrightunsigned(fingerprint, BLOCK_BITS * j).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int") for j in range(BLOCKS)])


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """content and item_key of all fingerprints at a distance of at most RADIUS.

    The items' blocks are spread over all changes of up to CHANGES bits, the windows' blocks are looked up as they are. Both
    sides are shuffled: the spread blocks are some 2,800 rows an item, too many to broadcast. The changes are one literal, as
    an expression for each takes the driver much memory to plan.
    """
    masks = ",".join(str(sum(1 << b for b in bits)) for n in range(CHANGES + 1) for bits in combinations(range(BLOCK_BITS), n))
    spread = items.select("item_key", F.col("fingerprint").alias("f"), F.posexplode(_blocks(F.col("fingerprint"))).alias("place", "block"))
    spread = spread.select("*", F.explode(F.split(F.lit(masks), ",").cast("array<int>")).alias("mask"))
    spread = spread.select("item_key", "f", "place", F.col("block").bitwiseXOR(F.col("mask")).alias("block"))
    looked = windows.select("content", "fingerprint", F.posexplode(_blocks(F.col("fingerprint"))).alias("place", "block"))
    near = looked.join(spread.hint("merge"), ["place", "block"]).where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("f"))) <= RADIUS)
    return near.select("content", "item_key").distinct()


def contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, similarity (the best of the text's windows) and start_word (of the first such window), one row for each pair."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), word_array(F.col(item_text)).alias("w")).where(F.size("w") >= SHINGLE)
    items = items.select("item_id", F.size("w").alias("length"), shingle_array(F.col("w")).alias("shingles"))
    items = materialise(items.select("item_id", F.xxhash64("item_id", "shingles").alias("item_key"), "length", "shingles").distinct(), "items")
    at = items.select("length", F.posexplode("shingles").alias("place", "shingle")).distinct()

    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = texts.withColumn("t", F.xxhash64("text"))
    spots = texts.select("doc_id", "t", F.posexplode_outer(shingle_array(word_array(F.col("text")))).alias("i", "shingle"))
    starts = spots.join(at, "shingle").select("doc_id", "t", "length", (F.col("i") - F.col("place")).alias("start")).distinct()
    starts = materialise(starts, "windows")
    by_text = starts.groupBy("doc_id", "t").agg(F.collect_set(F.struct("start", "length")).alias("all"))
    held = texts.alias("d").join(by_text.alias("s"), F.expr("d.doc_id <=> s.doc_id AND d.t = s.t")).select("d.doc_id", shingle_array(word_array(F.col("d.text"))).alias("shingles"), "s.all")
    n_words = F.size("shingles") + (SHINGLE - 1)
    inside = F.transform("all", lambda x: F.struct(F.greatest(F.lit(0), F.least(x["start"], n_words - x["length"])).alias("start"), F.least(x["length"], n_words).alias("length")))
    windows = held.select("doc_id", "shingles", F.explode(F.array_distinct(inside)).alias("x"))
    windows = windows.select("doc_id", F.col("x.start").alias("start"), F.slice("shingles", F.col("x.start") + 1, F.col("x.length") - (SHINGLE - 1)).alias("part"))
    windows = materialise(windows.select("doc_id", "start", F.xxhash64("part").alias("content"), "part").distinct(), "window-shingles")

    contents = materialise(windows.groupBy("content").agg(F.first("part").alias("part")), "contents")
    prints = simhash(contents.select("content", F.explode("part").alias("shingle")), "content", "shingle")
    item_prints = simhash(items.select("item_key", F.explode("shingles").alias("shingle")), "item_key", "shingle")
    pairs = materialise(within_radius(prints, item_prints), "near-fingerprints")

    of_window = pairs.join(contents, "content").select("content", "item_key", F.size("part").alias("n"), F.explode("part").alias("shingle"))
    of_window = of_window.groupBy("content", "item_key", "n", "shingle").agg(F.count("*").alias("c"))
    of_item = items.select("item_key", "item_id", F.size("shingles").alias("m"), F.explode("shingles").alias("shingle")).groupBy("item_key", "item_id", "m", "shingle").agg(F.count("*").alias("k"))
    both = of_window.join(of_item, ["item_key", "shingle"]).groupBy("content", "item_key", "item_id", "n", "m").agg(F.sum(F.least("c", "k")).alias("both"))
    checked = both.select("content", "item_id", (F.col("both") / (F.col("n") + F.col("m") - F.col("both"))).alias("similarity")).where(F.col("similarity") >= similarity)
    found = windows.select("doc_id", "start", "content").join(materialise(checked, "leaks"), "content")
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), F.min_by("start", F.struct(-F.col("similarity"), F.col("start"))).cast("long").alias("start_word"))


def oracle(similarity: float = SIMILARITY) -> str:
    """The same by comparing all windows that share an aligned shingle, in DuckDB SQL."""
    words = "string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')"
    return f"""
WITH iw AS (SELECT DISTINCT item_id, {words} AS w FROM benchmark),
items AS (SELECT item_id, len(w) AS length, list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) AS s FROM iw WHERE len(w) >= {SHINGLE}),
docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
ds AS (SELECT r, doc_id, list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) AS s FROM docs WHERE len(w) >= {SHINGLE}),
dx AS (SELECT r, unnest(s) AS g, generate_subscripts(s, 1) AS i FROM ds),
ix AS (SELECT item_id, length, unnest(s) AS g, generate_subscripts(s, 1) AS p FROM items),
laid AS (SELECT DISTINCT r, i - p AS start, length FROM dx JOIN (SELECT DISTINCT length, g, p FROM ix) USING (g)),
win AS (SELECT DISTINCT r, greatest(0, least(start, len(s) + {SHINGLE - 1} - length)) AS start, least(length, len(s) + {SHINGLE - 1}) AS length FROM laid JOIN ds USING (r)),
part AS (SELECT r, doc_id, start, s[start + 1:start + length - {SHINGLE - 1}] AS part FROM win JOIN ds USING (r)),
px AS (SELECT r, doc_id, start, len(part) AS n, g, count(*) AS c FROM (SELECT r, doc_id, start, part, unnest(part) AS g FROM part) GROUP BY ALL),
ic AS (SELECT item_id, len(s) AS m, g, count(*) AS k FROM (SELECT item_id, s, unnest(s) AS g FROM items) GROUP BY ALL),
sim AS (SELECT r, doc_id, start, item_id, sum(least(c, k))::BIGINT AS b, n, m FROM px JOIN ic USING (g) GROUP BY r, doc_id, start, item_id, n, m),
ok AS (SELECT doc_id, item_id, start, b / (n + m - b) AS similarity FROM sim WHERE b / (n + m - b) >= {similarity})
SELECT doc_id, item_id, max(similarity) AS similarity, CAST(first(start ORDER BY similarity DESC, start) AS BIGINT) AS start_word FROM ok GROUP BY doc_id, item_id
"""
