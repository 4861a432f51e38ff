import hashlib
import random
import re

import duckdb
import pytest

from alluvia.llm import decontamination, licences
from alluvia.llm.html_wrappers import align, main_texts, parse, with_groups
from alluvia.llm.language_id import language_id
from alluvia.llm.secret_scan import secret_scan
from alluvia.llm.sentence_pieces import decode_ids, encode_texts, encoding_digests

DATA = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, source string, lang string"


def rows_of(spark, sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return sorted(map(repr, con.execute(sql).fetchall()))


def test_licences_and_leaks_against_sql(spark):
    docs, items = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    got = licences.license_scan(docs, licences.known_digests(spark)).collect()
    assert sorted(repr(tuple(r)) for r in got) == rows_of(spark, licences.oracle())
    found = decontamination.contaminated(docs, items).collect()
    assert sorted(repr(tuple(r)) for r in found) == rows_of(spark, decontamination.oracle())


def test_licence_spellings_and_edges(spark):
    mit = licences.KNOWN[0][1]
    rows = [(1, "Copyright (c) 2020 A\n\n" + mit.upper().replace(",", " ;")), (2, None), (3, ""), (4, mit + " x"), (4, mit + " x"), (5, "This work is licenced under the GNU General Public Licence, version 3")]
    got = {r["doc_id"]: r for r in licences.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), licences.known_digests(spark)).collect()}
    assert [got[i]["license_id"] for i in range(1, 6)] == ["MIT", None, None, None, "GPL-3.0"]


def test_secrets(spark):
    key = "Zx9" * 10
    rows = [(1, f'é API_KEY = "{key}" AKIA{"A1" * 8} {"0a" * 8}', "a/x", "en"), (2, None, None, None), (2, None, None, None), (3, "token: secret=abc", "b/y", "en"), (4, "x aB3dE6gH9jK2mN5pQ8sT1vX4", "c", "en")]
    got = {r["doc_id"]: r for r in secret_scan(spark.createDataFrame(rows, DOC)).collect()}
    text = rows[0][1]
    at = [m.span() for m in re.finditer(r'API_KEY = "\w+|AKIA\w+|(?:0a){8}', text)]
    base = ",".join(f"{k}:{s}:{e}" for k, (s, e) in zip(("assign", "access", "hex"), at))
    assert (got[1]["n_assign"], got[1]["n_access"], got[1]["n_hex"]) == (1, 1, 1)
    assert got[1]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and got[1]["spans"] == base
    assert got[2]["spans"] == "" and got[3]["n_assign"] == 0 and got[4]["spans"].startswith("owned:")
    assert secret_scan(spark.createDataFrame([], DOC)).collect() == []


def test_language_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    odd = language_id(spark.createDataFrame([(1, None, None, "en"), (2, "12 !", None, None)], DOC)).collect()
    assert {(r["lang_pred"], r["score"]) for r in odd} == {("und", 0.0)}


def test_pieces_against_the_library(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    df = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(9001, None), (9002, " ▁\n①a  "), (9003, "x" * 5000)], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    for r in encoding_digests(df, model).collect():
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    back = {r["doc_id"]: r["text"] for r in decode_ids(encode_texts(df, model), model).collect()}
    assert all(back[k] == library.decode(library.encode(t)) for k, t in texts.items())


def test_wrappers_and_pages(spark):
    assert with_groups("ul li /li li /li /ul".split()) == ["ul", "(li /li)+", "/ul"]
    assert align("a b c".split(), "a c d".split()) == ["a", "b?", "c", "d?"]
    page = '<html><head><title>t</title></head><body><nav>menu</nav><article><h1>A &amp;amp; B</h1><p>one\n two<br>three<p>f<b>our</b><div class="comments"><p>no</p></div></article><footer>f</footer></body>'
    rows = [(1, "http://h/1", page), (2, "http://h/2", None), (2, None, ""), (3, "http://h/3", page.replace("four", "five"))]
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    text = "A &amp; B\none two three\nfour"
    assert got == [(1, text, len(text)), (2, "", 0), (2, "", 0), (3, text, len(text))]


def test_wrapper_tells_slots_from_template(spark):
    def page(i):
        more = f"<blockquote>quote {i}</blockquote>" if i % 2 else ""
        body = "".join(f"<p>text {i} {j}" for j in range(1 + i % 3))
        return f"<body><article><p class='by'>By our staff</p><h1>Title {i}</h1>{more}{body}<ul><li>Home<li>More</ul></article></body>"

    rows = [(i, f"http://h/{i}", page(i)) for i in range(6)] + [(9, "http://single/", page(1))]
    got = {r["page_id"]: r["text"].split("\n") for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == [f"Title {i}", *[f"quote {i}"] * (i % 2), *(f"text {i} {j}" for j in range(1 + i % 3))]
    assert got[9] == ["By our staff", "Title 1", "quote 1", "text 1 0", "text 1 1", "Home", "More"]
    assert align(["a", "(p #text /p)+", "z"], "a p #text /p z".split()) == ["a", "(p #text /p)+", "z"]


def test_leaks_at_the_edges_of_a_text(spark):
    words = [f"w{i}" for i in range(40)]
    more = [f"m{i}" for i in range(30)]
    texts = [words[1:] + more, more + words[:-1], words[2:-2], more + words[10:], more + words + more]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r["doc_id"]: (r["item_id"], round(r["similarity"], 3), r["start_word"]) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {0: (7, 0.946, 0), 1: (7, 0.946, 29), 2: (7, 0.889, 0), 4: (7, 1.0, 30)}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body class='home right-sidebar'><p>body</p><div class='sidebar'>no</div></body>", "body"),
        ("<div id='content' class='no-sidebar'><p>body</p></div><div class='ad-banner'>no</div>", "body"),
        ("<article class='comment'><p>body</p></article><div aria-hidden=true>no</div><div hidden>no</div>", "body"),
        ("<div style='overflow: hidden' title='see class=ad hidden'><p>body</p></div><div class=ad>no</div>", "body"),
        ("<div data-role='banner' aria-hidden='false'><p>body</p></div><p role=banner>no</p>", "body"),
        ("<div class='sidebar'><p>all there is</p></div><nav>no</nav>", "all there is"),
        ("<form><p>all there is</p></form><script>no</script>", "all there is"),
        ("<article hidden>no</article><main class='sidebar'><p>body</p></main>", "body"),
        ("<head><title>no</title></head><script>no</script>", ""),
    ],
)
def test_noise_never_empties_a_page(page, text):
    assert "\n".join(t for _, t, _ in parse(page)[0]) == text


def nodes(df):
    """The nodes and expressions of a plan, as it is analysed and as it is optimised."""
    execution = df._jdf.queryExecution()
    return [plan.toJSON().count('"class"') for plan in (execution.analyzed(), execution.optimizedPlan())]


def test_fingerprints_against_brute_force_by_small_plans(spark):
    rng = random.Random(5)
    shingles = [(key, rng.getrandbits(64) - (1 << 63)) for key in range(40) for _ in range(key % 7 + 1)]
    prints = decontamination.simhash(spark.createDataFrame(shingles, "key long, shingle long"), "key", "shingle")
    expected = {}
    for key in range(40):
        own = [s for k, s in shingles if k == key]
        bits = sum(1 << i for i in range(64) if 2 * sum(s >> i & 1 for s in own) > len(own))
        expected[key] = bits - (bits >> 63 << 64)
    assert {r["key"]: r["fingerprint"] for r in prints.collect()} == expected and min(expected.values()) < 0

    signed = lambda x: x - (x >> 63 << 64)
    base = [rng.getrandbits(64) for _ in range(5)] + [0, (1 << 64) - 1]
    others = [b ^ sum(1 << i for i in rng.sample(range(64), n)) for b in base for n in range(20)]
    items = spark.createDataFrame([(i, signed(b)) for i, b in enumerate(base)], "item_key long, fingerprint long")
    windows = spark.createDataFrame([(i, signed(w)) for i, w in enumerate(others)], "content long, fingerprint long")
    near = decontamination.within_radius(windows, items)
    brute = sorted((i, j) for i, w in enumerate(others) for j, b in enumerate(base) if (w ^ b).bit_count() <= decontamination.RADIUS)
    assert sorted(tuple(r) for r in near.collect()) == brute and len(brute) >= 16 * len(base)
    assert max(nodes(prints)) < 600 and max(nodes(near)) < 600
