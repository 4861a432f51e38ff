"""GeoJSON files whose encoding isn't known: damaged ones are told apart, the others become text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.sources.staging import ship_package

# Control bytes that no text file holds, and the marks at the start of a file.
CONTROL = re.compile(rb"[\x01-\x08\x0e-\x1f]")
MARKS = {b"\xef\xbb\xbf": "utf-8-sig", b"\xff\xfe": "utf-16", b"\xfe\xff": "utf-16"}


# Encodings of one byte that are tried, and letters that texts in them have most besides ASCII.
SINGLE_BYTE = {"cp1252": "éèàùâêîôûçäöüßñáíóúãõåæøœ’“”–", "cp1251": "оеаинтсрвлкмдпуяыьгзбчйхжюш", "iso8859-2": "ąćęłńóśźżčďěňřšťůžáéíýőű"}
LEAST_SURE, SAMPLE_BYTES = 0.7, 1 << 14


def guessed(raw: bytes) -> tuple[str, float]:
    """The encoding that makes most of the bytes beyond ASCII letters of its language, and the share that it makes so."""
    high = bytes(b for b in raw[:SAMPLE_BYTES] if b >= 128)
    if not high:
        return "ascii", 1.0
    shares = {name: sum(c in letters for c in high.decode(name, "replace").lower()) / len(high) for name, letters in SINGLE_BYTE.items()}
    best = max(shares, key=shares.get)
    return best, shares[best]


def encoding_of(raw: bytes) -> str:
    """binary if there are control bytes, else by the mark, else utf-8 if it decodes, else what guessed() is sure of, else latin-1."""
    if CONTROL.search(raw):
        return "binary"
    for mark, name in MARKS.items():
        if raw.startswith(mark):
            return name
    try:
        raw.decode()
    except UnicodeDecodeError:
        name, sure = guessed(raw)
        return name if sure >= LEAST_SURE else "latin-1"
    return "utf-8"


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: file, encoding, properties and geometry as JSON text; a damaged file gives one row of nulls with encoding binary, an empty one none."""

    @F.pandas_udf("encoding string, text string")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            names = [encoding_of(x) for x in part]
            yield pd.DataFrame({"encoding": names, "text": [None if n == "binary" else x.decode(n, "replace") for n, x in zip(names, part)]})

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), decoded("content").alias("d"))
    ship_package()
    found = F.from_json("d.text", "struct<features: array<struct<properties: string, geometry: string>>>")["features"]
    return files.select("file", "d.encoding", F.explode_outer(found).alias("f")).select("file", "encoding", "f.properties", "f.geometry")
