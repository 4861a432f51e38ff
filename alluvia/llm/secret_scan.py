"""Secret scan with corpus-wide ownership frequency.

Every text is searched for credential patterns. The value of each find, as a digest, is counted over the whole corpus by
distinct repositories and distinct owners: a value that many owners hold is a copied example, one that a few owners hold looks
live. The pattern finds ("base" kinds) always stay; long mixed tokens outside them are added as kind `owned` where their
digest belongs to few owners.

Nulls are empty texts; a null repository counts as one nameless repository. Rows may repeat: each is answered by itself, and
ownership counts repositories and owners, so that repeats add nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.llm.storage import materialise

# The kinds in order, their patterns and the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "owned")
LEAST = {"assign": 12, "access": 18, "hex": 16, "owned": 20}

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIXED = (re.compile(r"[0-9]"), re.compile(r"[A-Za-z]"))


def bits_per_character(value: str) -> float:
    """Shannon entropy of a value's characters."""
    n = len(value)
    return -sum(c / n * log2(c / n) for c in Counter(value).values())


def base_finds(text: str) -> list[tuple[int, int, int, str]]:
    """Start, kind's place in KINDS, end and value of the base finds, ordered by start and kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def token_finds(text: str, base: list[tuple[int, int, int, str]], least_bits: float) -> list[tuple[int, int, int, str]]:
    """Long tokens of letters and digits with enough entropy that touch no base find."""
    found = []
    starts = [s for s, _, _, _ in base]
    ends = list(accumulate((e for _, _, e, _ in base), max))  # the furthest end so far
    for m in TOKEN.finditer(text):
        value, before = m[0], bisect_left(starts, m.end())
        touches = before > 0 and ends[before - 1] > m.start()
        if not touches and all(x.search(value) for x in MIXED) and bits_per_character(value) >= least_bits:
            found.append((m.start(), 3, m.end(), value))
    return found


def _digest(value: str) -> str:
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()[:32]


SCANNED = "row long, doc_id long, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, finds array<struct<start: int, kind: int, stop: int, digest: string>>"
_FIND = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("digest", pa.string())])


def scan_texts(df: DataFrame, text: str = "text", doc_id: str = "doc_id", repository: str = "source", least_bits: float = 3.0) -> DataFrame:
    """One row per input row with its finds; `row` is unique."""

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            base_of, finds_of, digests = [], [], []
            for t in b.column(1):
                t = t.as_py() or ""
                base = base_finds(t)
                base_of.append([sum(1 for x in base if x[1] == k) for k in range(3)])
                digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base).encode()).hexdigest())
                finds_of.append([{"start": s, "kind": k, "stop": e, "digest": _digest(v)} for s, k, e, v in sorted(base + token_finds(t, base, least_bits))])
            n = b.num_rows
            counts = [pa.array([x[k] for x in base_of], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + n), pa.int64()), b.column(0), b.column(2), *counts, pa.array(digests, pa.string()), pa.array(finds_of, pa.list_(_FIND))],
                ["row", "doc_id", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "finds"],
            )
            row += n

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(repository).cast("string").alias("repository")).mapInArrow(run, SCANNED)


def owner_of(repository: Column) -> Column:
    """What stands before the first slash of a repository's name: its owner."""
    return F.substring_index(F.coalesce(repository, F.lit("")), "/", 1)


def ownership(scanned: DataFrame) -> DataFrame:
    """digest, n_repositories and n_owners over the whole corpus; repeats within a repository fall away before the counting shuffle."""
    held = scanned.select(F.coalesce("repository", F.lit("")).alias("repository"), F.explode(F.array_distinct(F.transform("finds", lambda x: x["digest"]))).alias("digest"))
    return held.distinct().withColumn("owner", owner_of(F.col("repository"))).groupBy("digest").agg(F.countDistinct("repository").alias("n_repositories"), F.countDistinct("owner").alias("n_owners"))


def secret_scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id", repository: str = "source", most_owners: int = 2, least_bits: float = 3.0) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, and how many spans look live or copied.

    most_owners: a value of more owners than this is a copied example.
    """
    scanned = materialise(scan_texts(df, text, doc_id, repository, least_bits), "secrets")
    own = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    some = scanned.where(F.size("finds") > 0)
    live = materialise(ownership(some).select("digest", (F.col("n_owners") <= most_owners).alias("live")), "owners")  # written, so that the join can split a value that many rows hold
    finds = some.select("row", *own, F.explode("finds").alias("find")).select("row", *own, "find.*").join(live, "digest")
    kept = (F.col("kind") < 3) | F.col("live")
    spans = finds.groupBy("row").agg(
        *[F.any_value(c).alias(c) for c in own],
        F.sort_array(F.collect_list(F.when(kept, F.struct("start", "kind", "stop")))).alias("all"),
        F.count_if(kept & F.col("live")).alias("n_live"),
        F.count_if(kept & ~F.col("live")).alias("n_copied"),
    )
    kinds = F.array(*map(F.lit, KINDS))
    joined = F.array_join(F.transform("all", lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")
    found = spans.select(*own, joined.alias("spans"), "n_live", "n_copied")
    none = scanned.where(F.size("finds") == 0)  # most rows: they are not shuffled
    return found.unionByName(none.select(*own, F.lit("").alias("spans"), F.lit(0).cast("long").alias("n_live"), F.lit(0).cast("long").alias("n_copied")))
