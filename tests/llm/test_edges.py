"""Edge cases of the scans, and comparisons with brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from alluvia.llm import decontamination, language_id, licences, secret_scan, sentence_pieces
from alluvia.llm.flac import encoded_media, media_digests

DATA = "/root/testdata/sf0.001"


def found(spark, rows, schema="doc_id long, text string"):
    return {r["doc_id"]: r for r in licences.license_scan(spark.createDataFrame(rows, schema), licences.known_digests(spark)).collect()}


# --- licences


def test_wrapped_licences_keep_their_lines(spark):
    import textwrap

    texts = {k: t for k, t in licences.KNOWN if len(t) > 400}
    rows = [(i, "Copyright (c) 2001-2024, A. Author\nAll rights reserved.\n\n" + "\n\n".join(textwrap.fill(p, 60) for p in t.split("\n\n"))) for i, t in enumerate(texts.values())]
    got = found(spark, rows)
    assert [got[i]["license_id"] for i in range(len(rows))] == list(texts)


def test_whole_licences_of_the_system(spark):
    from pathlib import Path

    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-3": "GPL-3.0", "GPL-2": "GPL-2.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all((folder / n).exists() for n in names):
        pytest.skip("no licence texts here")
    got = found(spark, [(i, (folder / n).read_text().upper()) for i, n in enumerate(names)])
    assert [got[i]["license_id"] for i in range(len(names))] == list(names.values())


def test_licence_edges(spark):
    mit = licences.KNOWN[0][1]
    rows = [(1, mit, "x", 3), (1, mit, "x", 3), (2, None, None, None), (None, "MIT " * 200_000, "y", 1), (3, "copyright notice and this permission\nnotice", "z", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license_id string, digest int")
    got = licences.license_scan(df, licences.known_digests(spark)).collect()
    assert len(got) == 5 and sum(r["license_id"] == "MIT" for r in got) == 2
    ties = licences.known_digests(spark, (("B", mit), ("A", mit.upper())), (("C", "0" * 64),))
    assert {r["license_id"] for r in ties.collect()} == {"A", "C"}
    assert licences.license_scan(spark.createDataFrame([], "doc_id long, text string"), ties).collect() == []
    assert licences.license_scan(df, ties.where("false")).where("license_id IS NOT NULL").count() == 0


# --- secrets

SECRET = "doc_id long, text string, source string"


def scanned(spark, rows, **options):
    return sorted((tuple(r) for r in secret_scan.secret_scan(spark.createDataFrame(rows, SECRET), **options).collect()), key=repr)


def brute_spans(text):
    """All base finds by trying every start."""
    out = []
    for kind, pattern, least in (("assign", secret_scan.ASSIGN, 12), ("access", secret_scan.ACCESS, 18), ("hex", re.compile("[0-9a-f]+"), 16)):
        at = 0
        while at < len(text):
            m = pattern.match(text, at)
            if not m:
                at += 1
                continue
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), ("assign", "access", "hex").index(kind), m.end(), kind))
            at = m.end()
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def test_base_spans_against_every_start(spark):
    rng = random.Random(8)
    parts = ["api_key=", "token: '", 'SECRET" = "', "AKIA", "deadbeef", "0123456789abcdef", "Zz+/=-._", "é", " ", "\n", "passwd", "A1B2C3", "q"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))), "a/b") for i in range(150)]
    got = {r["doc_id"]: r for r in secret_scan.secret_scan(spark.createDataFrame(rows, SECRET)).collect()}
    for i, t, _ in rows:
        spans = brute_spans(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) - {""} <= set(got[i]["spans"].split(","))


def test_copied_examples_are_told_from_owned_values(spark):
    own, example = "aB3dE6gH9jK2mN5pQ8sT1vX4", "xY7zW2qR9tU4iO1pA6sD3fG8"
    rows = [(1, f"x {own} y", "ann/a"), (2, f"x {own} y", "ann/b"), (3, f"x {own} y", "bob/c")]
    rows += [(10 + i, f"see {example} here", f"owner{i}/repo") for i in range(5)] + [(20, f"see {example} and {own}", None)] * 2
    got = {r[0]: r for r in scanned(spark, rows, most_owners=3)}
    assert got[1][5] == "owned:2:26" and got[1][6:] == (1, 0)  # ann, bob and the nameless owner
    assert got[10][5] == "" and got[20][5].startswith("owned:33:")
    few = {r[0]: r for r in scanned(spark, rows, most_owners=2)}
    assert few[1][5] == ""
    base = f'token = "{example}"'
    copied = [(i, base, f"owner{i}/repo") for i in range(4)]
    assert all(r[5].startswith("assign:") and r[6:] == (0, 1) for r in scanned(spark, copied))  # base spans stay, as copied ones


def test_secret_edges(spark):
    clash = spark.createDataFrame([(1, "deadbeefdeadbeef " * 5_000, "a", 3, "d"), (None, None, None, None, None)], SECRET + ", row int, digest string")
    rows = secret_scan.secret_scan(clash).collect()
    assert sorted((r["doc_id"] or 0, r["n_hex"]) for r in rows) == [(0, 0), (1, 5_000)]


# --- languages

LANGUAGE = "doc_id long, text string, lang string"


@pytest.mark.parametrize("text", ["ok", "a", "ab cd", "é", "x1", "abc", "日"])
def test_texts_of_a_few_letters(spark, text):
    rows = [(0, "the river and the house", "en"), (1, "der fluss und das haus", "de"), (2, "le fleuve et la maison", "fr"), (3, "the light of the house", "en"), (9, text, None)]
    got = {r["doc_id"]: r for r in language_id.language_id(spark.createDataFrame(rows, LANGUAGE)).collect()}
    assert got[9]["lang_pred"] in ("en", "de", "fr") and 0 < got[9]["score"] <= 1


def plain_grams(text):
    points, out = [], []
    for c in text.lower():
        if c.isalpha():
            points.append(c)
        elif points and points[-1] != " ":
            points.append(" ")
    s = "".join(points)
    for k in range(1, 5):
        out += [s[i : i + k] for i in range(len(s) - k + 1)]
    return out


def test_against_plain_naive_bayes(spark):
    """With as many buckets as there are n-grams, all but rare collisions, predictions and scores follow the plain formula."""
    rows = [(r["doc_id"], (r["text"] or "")[:400], r["lang"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").limit(80).collect()]
    training = [(t, lang) for i, t, lang in rows if lang and t and zlib.crc32(str(i).encode()) % 4 != 2]
    counts, texts = {}, Counter(lang for _, lang in training)
    buckets = language_id.BUCKETS

    def bucket(gram):
        value = 0
        for k, c in enumerate(gram):
            value = (value * 0x01000193 + (ord(c) + k) * 0x9E3779B1) & 0xFFFFFFFF
        value ^= value >> 15
        return ((value * 0x85EBCA6B) & 0xFFFFFFFF) >> 17

    for t, lang in training:
        counts.setdefault(lang, Counter()).update(map(bucket, plain_grams(t)))
    got = {r["doc_id"]: r for r in language_id.language_id(spark.createDataFrame(rows, LANGUAGE)).collect()}
    for i, t, _ in rows:
        grams = list(map(bucket, plain_grams(t)))
        if not grams:
            assert got[i]["lang_pred"] == "und"
            continue
        sums = {lang: log((texts[lang] + 0.5) / (sum(texts.values()) + 0.5 * len(texts))) + sum(log((c[g] + 0.5) / (sum(c.values()) + 0.5 * buckets)) for g in grams) for lang, c in counts.items()}
        best = max(sorted(sums), key=sums.get)
        ordered = sorted(sums.values())
        if len(ordered) < 2 or ordered[-1] - ordered[-2] > 1e-2:
            assert got[i]["lang_pred"] == best


def test_language_ties_priors_and_clashes(spark):
    same = [(0, "abc", "b"), (1, "abc", "a"), (3, "abc", "a"), (7, "abc", "b"), (2, "abc", None)]
    kept = [r for r in same if r[2] is None or zlib.crc32(str(r[0]).encode()) % 4 != 2]
    n = Counter(r[2] for r in kept if r[2])
    got = {r["doc_id"]: r for r in language_id.language_id(spark.createDataFrame(same, LANGUAGE)).collect()}
    assert got[2]["lang_pred"] == max(sorted(n), key=n.get)
    df = spark.createDataFrame([(1, "the house", "en", 7.5, "x")], LANGUAGE + ", score double, lang_pred string")
    model = language_id.fit(df)
    assert language_id.identify(df, model, lang_pred="__p", score="__s").select("score", "lang_pred").collect() == [(7.5, "x")]
    assert language_id.identify(df, model).select("score").first()[0] == 1.0
    assert language_id.language_id(spark.createDataFrame([], LANGUAGE)).collect() == []
    assert language_id.language_id(spark.createDataFrame([(1, "the house " * 100_000, "en"), (1, "the house", "en")], LANGUAGE)).count() == 2


# --- leaks


def window_similarity(item, words, start, length):
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    a, b = grams(item), grams(words[start : start + length])
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def test_recall_against_all_windows(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(4000)}"
    items = [(i, [word() for _ in range(rng.randint(12, 60))]) for i in range(25)]
    docs = []
    for d in range(120):
        item = list(rng.choice(items)[1])
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
            at = rng.randrange(len(item))
            rng.choice((lambda: item.__setitem__(at, word()), lambda: item.pop(at), lambda: item.insert(at, word())))()
        docs.append((d, [word() for _ in range(rng.choice((0, 3, 40)))] + item + [word() for _ in range(rng.choice((0, 2, 40)))]))
    expected = {}
    for d, words in docs:
        for i, item in items:
            if len(words) < 5 or len(item) < 5 or not set(item) & set(words):
                continue
            length = min(len(item), len(words))
            best = max(window_similarity(item, words, s, length) for s in range(len(words) - length + 1))
            if best >= 0.8:
                expected[d, i] = best
    as_text = lambda rows, name: spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.contaminated(as_text(docs, "doc_id"), as_text(items, "item_id")).collect()}
    assert got.keys() <= expected.keys()
    assert len(got) >= 0.9 * len(expected) > 30  # the radius of the fingerprints may miss windows near the threshold
    assert all(s <= expected[k] + 1e-9 for k, s in got.items())


def test_leak_edges(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, item, "a"), (1, item, "a"), (2, None, None), (3, "", "c"), (4, "filler " * 50_000 + item, "d"), (None, item, "e")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, item, 1), (8, item, 2), (9, "one two", 3), (10, None, 4)], "item_id long, text string, doc_id int")
    got = sorted((r["doc_id"] or 0, r["item_id"], r["similarity"], r["start_word"]) for r in decontamination.contaminated(docs, items).collect())
    assert got == [(d, i, 1.0, s) for d, s in ((0, 0), (1, 0), (4, 50_000)) for i in (7, 8)]
    assert decontamination.contaminated(docs.where("false"), items).collect() == [] == decontamination.contaminated(docs, items.where("false")).collect()


# --- media


class Bits:
    """A plain reader of bits, for a decoder that shares nothing with the operator's."""

    def __init__(self, data):
        self.bits, self.at = "".join(f"{b:08b}" for b in data), 0

    def take(self, n):
        self.at += n
        return int(self.bits[self.at - n : self.at] or "0", 2)

    def signed(self, n):
        v = self.take(n)
        return v - (1 << n) if n and v >> (n - 1) else v

    def unary(self):
        n = self.bits.index("1", self.at) - self.at
        self.at += n + 1
        return n


def plain_decode(data):
    assert data[:4] == b"fLaC"
    at, last, total = 4, False, 0
    while not last:
        last, kind, size = data[at] >> 7, data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        if kind == 0:
            info = data[at + 4 : at + 4 + size]
            total = int.from_bytes(info[13:18], "big") & ((1 << 36) - 1)
            assert (int.from_bytes(info[10:14], "big") >> 4 & 31) + 1 == 8 and (int.from_bytes(info[10:14], "big") >> 9 & 7) == 0
        at += 4 + size
    b, out = Bits(data[at:]), []
    while len(out) < total:
        assert b.take(14) == 0b11111111111110
        b.take(2)
        size_code, rate_code = b.take(4), b.take(4)
        assert b.take(4) == 0
        b.take(4)
        first = b.take(8)
        for _ in range(max(0, (f"{first:08b}" + "0").index("0") - 1)):
            b.take(8)
        n = {1: 192, **{k: 576 << (k - 2) for k in range(2, 6)}, **{k: 256 << (k - 8) for k in range(8, 16)}}.get(size_code) or b.take({6: 8, 7: 16}[size_code]) + 1
        b.take({12: 8, 13: 16, 14: 16}.get(rate_code, 0))
        b.take(8)
        b.take(1)
        kind = b.take(6)
        wasted = b.unary() + 1 if b.take(1) else 0
        width = 8 - wasted
        if kind == 0:
            x = [b.signed(width)] * n
        elif kind == 1:
            x = [b.signed(width) for _ in range(n)]
        else:
            order = kind - 8 if kind < 32 else kind - 31
            x = [b.signed(width) for _ in range(order)]
            if kind < 32:
                factors, shift = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order], 0
            else:
                precision = b.take(4) + 1
                shift = b.signed(5)
                factors = [b.signed(precision) for _ in range(order)]
            method, parts = b.take(2), 1 << b.take(4)
            for p in range(parts):
                rice = b.take(4 + method)
                count = n // parts - (order if p == 0 else 0)
                raw = b.take(5) if rice == (31 if method else 15) else None
                for _ in range(count):
                    if raw is not None:
                        r = b.signed(raw)
                    else:
                        v = b.unary() << rice | b.take(rice)
                        r = v >> 1 ^ -(v & 1)
                    x.append(r + (sum(f * x[-1 - k] for k, f in enumerate(factors)) >> shift))
        out += [v << wasted for v in x]
        b.at += -b.at % 8
        b.take(16)
    return bytes(v + 128 for v in out)


def test_stored_media_by_another_decoder(spark):
    texts = ["", None, "a" * 64, "the quick brown fox " * 30, "é①\x00" * 70, "x" * 5000, "ab" * 900 + "z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = {r["doc_id"]: r for r in encoded_media(df).collect()}
    told = {r["doc_id"]: r for r in media_digests(df).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        media = bytes(stored[i]["media"])
        assert plain_decode(media) == payload
        assert told[i]["payload_sha256"] == hashlib.sha256(payload).hexdigest() and told[i]["media_sha256"] == hashlib.sha256(media).hexdigest()
        assert (told[i]["n_bytes"], told[i]["payload_bytes"], told[i]["media_bytes"], told[i]["tail_crc32"]) == (len(raw), len(payload), len(media), zlib.crc32(payload[-64:]))
        x = [v - 128 for v in payload]
        frames, total, energy, crossings = map(int, told[i]["feature"].split(":"))
        assert (total, energy, crossings) == (sum(x), sum(v * v for v in x), sum((a < 0) != (b < 0) for a, b in zip(x, x[1:]))) and frames >= 1


def test_media_edges(spark):
    df = spark.createDataFrame([(1, "same", "m", 3), (2, "same", None, None), (1, "same", "m", 3)], "doc_id long, text string, media string, n_bytes int")
    rows = media_digests(df).collect()
    assert len(rows) == 3 and len({r["media_sha256"] for r in rows}) == 1
    assert media_digests(df.where("false")).collect() == []
    [long_] = media_digests(spark.createDataFrame([(1, "long text " * 100_000)], "doc_id long, text string")).collect()
    assert long_["n_bytes"] == 1_000_000 and long_["payload_bytes"] % 64 == 0


# --- sentence pieces


def test_agenda_alone_gives_the_library_ids(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", F.lit("x").alias("ids"), F.lit(1).alias("__text"))
    coded = sentence_pieces.encoding_digests(docs, model)
    assert coded.agg(F.sum("n_differing")).first()[0] == 0
    own = sentence_pieces.PieceCoder(model)
    for text in ("The quick brown fox", "  spaces  ", "aaaaabaaaa", "x" * 300, "naïve café №5 ①②"):
        marked = ("▁" + text).replace(" ", "▁")
        assert own.merge(marked) == own.library.encode(text)


def test_a_broken_agenda_shows(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    own = sentence_pieces.PieceCoder(public_tokenizers.path("piece_bpe_32k.model"))
    own.merge = lambda part: [0]
    [(parts, wrong), (_, again)] = own.encode(["two words", "two"])
    assert wrong == 2 and again == 1 and [i for p in parts for i in p] == own.library.encode("two words")


def test_pieces_of_an_empty_table(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    model = public_tokenizers.path("piece_bpe_32k.model")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sentence_pieces.encoding_digests(none, model).collect() == [] == sentence_pieces.encode_texts(none, model).collect()
    rows = sentence_pieces.encoding_digests(spark.createDataFrame([(1, "t" * 200_000), (1, "t" * 200_000), (None, None)], "doc_id long, text string"), model).collect()
    assert len(rows) == 3 and rows[0]["n_tokens"] == rows[1]["n_tokens"] > 0
