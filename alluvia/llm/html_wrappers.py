"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page is a stream of tag tokens and text. Adjacent repeats of a token sequence become a repeated group. Streams of a host are
aligned one after another with its wrapper: tags that only one side has become optional groups, and text that differs between
pages at one place becomes a slot. Equal streams are taken once; streams and wrappers meet in groups of bounded size, level by
level, so that a host with any number of pages needs no large task. Each page's stream is then aligned with its host's wrapper,
which gives each of its blocks a place there: the token, and the number of the block within it if the token is a group. A place
that has the same text on all of at least three different pages is the template's; all others are slots. The host's content
root is the <article> or <main> that holds most of the slots' text, else the deepest container that holds nearly all of it and
that most pages have once: what repeats on a page is a part of its story. The
main text of a page is its slots below its host's root, without those in navigation, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments. A page without a slot below the root gives its blocks below the root, and
without any its slots, or else its blocks, outside such parts. Class and id words count as whole names, or if all parts of a name are
such words, and never on html, body, main and article; a page that would be empty is read again without these words, and then
with only the parts out that never show text. A header element inside an article or main element is the article's own.

Streams of any length are aligned by one rule: equal ends, then tokens (or else pairs of them, then fours, up to 64) that both
sides have once, as many as are in the same order, and between these the same again; what has none is aligned by longest common
runs.

Null html gives an empty text; pages without a host share the nameless host. Repeated rows give repeated rows. Broken markup is
read as far as it goes: unclosed elements end with their parents or at the end of the page.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.llm.arrow_text import row_chunks
from alluvia.llm.linking import PAIR_ROWS
from alluvia.llm.storage import materialise

# Element names and words of class, id and role by what they mean.
RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div table tbody tr td center details figure".split())
BLOCKS = CONTAINERS | frozenset(
    "address blockquote caption dd dl dt fieldset figcaption footer form h1 h2 h3 h4 h5 h6 header hr li nav ol p pre summary tfoot th thead ul aside head menu dialog".split()
)
NOISE = frozenset("head nav header footer aside form script style noscript template button select svg menu dialog title textarea iframe object canvas audio video xmp noembed noframes".split())
UNSHOWN = frozenset("head script style noscript template button select svg title textarea iframe object canvas audio video xmp noembed noframes".split())
KEPT = frozenset("html body main article".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
    "notice cookie cookies consent gdpr comment comments disqus respond replies related share sharing social newsletter subscribe popup modal toolbar".split()
)
NOISE_NAMES = frozenset("header site-header page-header masthead".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())

TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?=</(?P=raw)\b|\Z)|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
FAN = 32
LONGEST_GROUP = 16
TEMPLATE_PAGES = 3
_SYNTAX = re.compile(r"[()?+]")


def _marks(element: str, rest: str) -> tuple[str, bool]:
    """The class as part of a path, digits left out, and whether class, id, role or hiding make the element noise."""
    label, noise = "", False
    seen = set()
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in seen:  # of a repeated attribute the first counts
            continue
        seen.add(name)
        if name in ("class", "id"):
            names = value.split()
            noise |= element not in KEPT and any(n in NOISE_NAMES or NOISE_WORDS.issuperset(re.split(r"[-_]+", n.strip("-_"))) for n in names)
            if name == "class" and names:
                label = "." + ".".join(re.sub(r"\d+", "", n) for n in names)
        elif name == "role":
            noise |= value in NOISE_ROLES
        else:
            noise |= name == "hidden" or (name == "aria-hidden" and value == "true")
    return label, noise


def parse(page: str) -> tuple[list[tuple[str, str, int]], list[str], dict[str, bool]]:
    """The blocks of a page outside noise, as (path of containers, text, place of its first text in the stream), its token stream, and for each container above a block whether the page has it more than once.

    If there are none, attributes don't count, and if there are none yet, only elements that never show text are noise.
    """
    found = _parsed(page, NOISE, True)
    if not found[0]:
        for elements in (NOISE, UNSHOWN):
            less = _parsed(page, elements, False)
            if less[0]:
                return less
    return found


def _parsed(page: str, elements: frozenset[str], by_attributes: bool) -> tuple[list[tuple[str, str, int]], list[str], dict[str, bool]]:
    blocks, stream, parts, opened = [], [], [], Counter()
    first = -1
    stack: list[tuple[str, str, bool]] = []  # name, path, whether inside noise

    def flush() -> None:
        nonlocal first
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                blocks.append((stack[-1][1] if stack else "", text, first))
        first = -1

    def leave(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1][0] in BLOCKS:
                flush()
            name, _, _ = stack.pop()
            stream.append("/" + _SYNTAX.sub("", name))

    last = 0
    for m in [*TOKEN.finditer(page), None]:
        text = page[last : m.start() if m else len(page)]
        if text and not (stack and stack[-1][2]):
            parts.append(_html.unescape(text))  # a reference doesn't go on behind a tag
            if not text.isspace():
                if not stream or stream[-1] != "#text":
                    stream.append("#text")
                if first < 0:
                    first = len(stream) - 1
        if m is None:
            break
        last = m.end()
        name = (m["name"] or m["raw"] or "").lower()
        if not name:
            continue
        if m["close"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    leave(depth)
                    break
                if stack[depth][0] in CONTAINERS and name not in CONTAINERS and name not in NOISE:
                    break
        elif name == "br" or name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                parts.append(" ")
        else:
            if name in BLOCKS:
                for depth in range(len(stack) - 1, -1, -1):
                    open_ = stack[depth][0]
                    if open_ == "p" or (open_ == name and name in ("li", "tr", "td", "th", "dd", "dt")):
                        leave(depth)
                        break
                    if open_ in CONTAINERS or open_ in NOISE or open_ in ("ul", "ol", "dl", "blockquote"):
                        break
                flush()
            label, noise = _marks(name, m["rest"] or "")
            noise &= by_attributes
            above = stack[-1] if stack else ("", "", False)
            path = f"{above[1]}/{name}{label}" if name in CONTAINERS else above[1]
            opened[path] += name in CONTAINERS
            own = name == "header" and any(x[0] in ("article", "main") for x in stack)
            stack.append((name, path, above[2] or noise or (name in elements and not own)))
            stream.append(_SYNTAX.sub("", name + label))
    leave(0)
    flush()
    above = {p[:k] for p in {p for p, _, _ in blocks} for k in (*(m.start() for m in re.finditer("/", p) if m.start()), len(p))}
    return blocks, stream, {p: opened[p] > 1 for p in sorted(above) if p}


def grouped(stream: list[str]) -> tuple[list[str], list[int]]:
    """The stream with adjacent repeats of a token sequence written once as a group, shortest sequences first, and where each of its tokens starts."""
    starts = list(range(len(stream)))
    for size in range(1, LONGEST_GROUP + 1):
        out, at, i = [], [], 0
        while i < len(stream):
            unit, n = stream[i : i + size], 1
            while len(unit) == size and stream[i + n * size : i + (n + 1) * size] == unit:
                n += 1
            at.append(starts[i])
            if n > 1:
                out.append(unit[0] if size == 1 and unit[0].startswith("(") else f"({' '.join(unit)})+")
                i += n * size
            else:
                out.append(stream[i])
                i += 1
        stream, starts = out, at
    return stream, starts


def with_groups(stream: list[str]) -> list[str]:
    """The stream with adjacent repeats of a token sequence written once as a group, shortest sequences first."""
    return grouped(stream)[0]


def folded(tokens: list[str], groups: set[str]) -> tuple[list[str], list[int]]:
    """The tokens with single units of the groups written as the group, shortest units first, and where each of them starts; an optional token is no part of a unit."""
    starts = list(range(len(tokens)))
    for unit, group in sorted(((_tokens(g[1:-2]), g) for g in groups), key=lambda x: (len(x[0]), x[1])):
        if unit[0] not in tokens:
            continue
        out, at, i = [], [], 0
        while i < len(tokens):
            same = tokens[i] == unit[0] and tokens[i : i + len(unit)] == unit
            out.append(group if same else tokens[i])
            at.append(starts[i])
            i += len(unit) if same else 1
        tokens, starts = out, at
    return tokens, starts


def _groups(tokens: list[str]) -> set[str]:
    return {t.removesuffix("?") for t in tokens if t.startswith("(")}


def matches(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """Runs (place in a, place in b, length) that both have, in order, by one rule for all lengths: equal ends, then what both have once, then longest common runs."""
    least = min(len(a), len(b))
    head = next((k for k in range(least) if a[k] != b[k]), least)
    tail = next((k for k in range(least - head) if a[-1 - k] != b[-1 - k]), least - head)
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    out = [(0, 0, head)]
    tried = ([*zip(*(s[i:] for i in range(k)))] for k in (1, 2, 4, 8, 16, 32, 64) for s in (x, y))
    if anchors := next(filter(None, (_anchors(*two) for two in zip(tried, tried))), []):
        before = (-1, -1)
        for i, j in [*anchors, (len(x), len(y))]:
            out += [(p + before[0] + 1 + head, q + before[1] + 1 + head, n) for p, q, n in matches(x[before[0] + 1 : i], y[before[1] + 1 : j])]
            out.append((i + head, j + head, int(i < len(x))))
            before = (i, j)
    elif x and y:
        out += [(i + head, j + head, n) for i, j, n in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()]
    return [m for m in [*out, (len(a) - tail, len(b) - tail, tail)] if m[2]]


def _anchors(a: list[tuple], b: list[tuple]) -> list[tuple[int, int]]:
    """Places of token sequences that both sides have just once, as many as are in the same order on both."""
    once = [{t: k for k, t in enumerate(s) if n[t] == 1} for s, n in ((a, Counter(a)), (b, Counter(b)))]
    pairs = [(i, once[1][t]) for t, i in once[0].items() if t in once[1]]
    ends: list[int] = []  # last places in b of the best chains of each length
    chain: list[list[int]] = []
    back = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        if at == len(ends):
            ends.append(j), chain.append([k])
        else:
            ends[at] = j
            chain[at].append(k)
        back.append(chain[at - 1][-1] if at else -1)
    out, k = [], chain[-1][-1] if chain else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(one: list[str], other: list[str]) -> list[str]:
    """The wrapper of two wrappers: tokens of both stay, tokens of one become optional; a group and its single unit are the group."""
    groups = _groups(one) | _groups(other)
    one, other = (folded(w, groups)[0] for w in (one, other))
    plain = [[t.removesuffix("?") for t in w] for w in (one, other)]
    out, i, j = [], 0, 0
    for a, b, n in [*matches(*plain), (len(one), len(other), 0)]:
        out += [t if t.endswith("?") else t + "?" for t in (*one[i:a], *other[j:b])]
        out += [x if x == y else x.removesuffix("?") + "?" for x, y in zip(one[a : a + n], other[b : b + n])]
        i, j = a + n, b + n
    return [t for i, t in enumerate(out) if not (t.endswith("?") and i and out[i - 1] == t)]


def places(stream: list[str], wrapper: list[str]) -> list[int]:
    """For each token of a page's stream with groups, its place in the host's wrapper, or -1."""
    short, starts = folded(stream, _groups(wrapper))
    found = [-1] * len(short)
    for i, j, n in matches(short, [t.removesuffix("?") for t in wrapper]):
        found[i : i + n] = range(j, j + n)
    return [found[bisect_right(starts, i) - 1] for i in range(len(stream))]


PARSED = "row long, page_id long, url string, host string, wrapper string, paths array<string>, texts array<string>, spots array<struct<at:int,nth:int>>, containers map<string,boolean>"


_SPOTS = pa.list_(pa.struct([("at", pa.int32()), ("nth", pa.int32())]))


def _spots(blocks: list[tuple[str, str, int]], starts: list[int]) -> list[dict[str, int]]:
    """For each block the token of the stream with groups that holds its first text, and its number among the blocks of that token."""
    out, seen = [], Counter()
    for _, _, first in blocks:
        at = bisect_right(starts, first) - 1
        out.append({"at": at, "nth": seen[at]})
        seen[at] += 1
    return out


def parsed_pages(df: DataFrame, page_id: str, url: str, page: str) -> DataFrame:
    """One row per page: row (unique), its host, its token stream with groups, and the paths, texts and spots of its blocks."""

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, stop in row_chunks(batch.column(2)):
                b = batch.slice(start, stop - start)
                found = [parse(x or "") for x in b.column(2).to_pylist()]
                hosts = [(m[1].lower() if (m := re.match(r"(?:[A-Za-z][\w+.-]*:)?//([^/?#]*)", u or "")) else "") for u in b.column(1).to_pylist()]
                streams = [grouped(s) for _, s, _ in found]
                n = b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(row, row + n), pa.int64()), b.column(0), b.column(1), pa.array(hosts, pa.string()), pa.array([" ".join(s) for s, _ in streams], pa.string()),
                        pa.array([[p for p, _, _ in x] for x, _, _ in found], pa.list_(pa.string())), pa.array([[t for _, t, _ in x] for x, _, _ in found], pa.list_(pa.string())),
                        pa.array([_spots(x, at) for (x, _, _), (_, at) in zip(found, streams)], _SPOTS), pa.array([list(c.items()) for _, _, c in found], pa.map_(pa.string(), pa.bool_())),
                    ],
                    ["row", "page_id", "url", "host", "wrapper", "paths", "texts", "spots", "containers"],
                )
                row += n

    return df.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).alias("html")).mapInArrow(run, PARSED)


def _tokens(wrapper: str) -> list[str]:
    """Tokens of a written wrapper; a group with its spaces is one token."""
    out, depth = [], 0
    for t in wrapper.split():
        if depth:
            out[-1] += " " + t
        else:
            out.append(t)
        depth += t.count("(") - t.count(")")
    return out


def infer_wrappers(parsed: DataFrame) -> DataFrame:
    """host, wrapper and n_pages: distinct streams of a host meet in groups of at most about FAN, until each host has one."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(pdf["wrapper"], key=lambda w: (len(w), w))
        out = _tokens(rows[0])
        for w in rows[1:]:
            out = align(out, _tokens(w))
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "wrapper": [" ".join(out)], "n_pages": [pdf["n_pages"].sum()]})

    schema = "host string, wrapper string, n_pages long"
    level = parsed.groupBy("host", "wrapper").agg(F.count("*").alias("n_pages"))
    while True:
        level = materialise(level, "wrappers")
        sizes = level.groupBy("host").agg(F.count("*").alias("n")).where("n > 1")
        if sizes.isEmpty():
            return level
        dealt = level.join(sizes, "host", "left").withColumn("g", F.pmod(F.xxhash64("wrapper"), F.ceil(F.coalesce("n", F.lit(1)) / FAN)))
        level = dealt.groupBy("host", "g").applyInPandas(merge, schema)


def placed_streams(parsed: DataFrame, wrappers: DataFrame) -> DataFrame:
    """form (of host and stream) and places: for each token of the stream its place in the host's wrapper.

    Streams of a host are dealt to groups of about FAN, and its wrapper to each group, so that no task holds a large host.
    """
    streams = parsed.select("host", "form", F.col("wrapper").alias("stream")).dropDuplicates(["form"])
    sizes = streams.groupBy("host").agg(F.ceil(F.count("*") / FAN).cast("int").alias("k"))
    dealt = streams.join(sizes, "host").withColumn("g", F.pmod(F.xxhash64("stream"), F.col("k")).cast("int")).drop("k")
    spread = wrappers.select("host", "wrapper").join(sizes, "host").select("host", "wrapper", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("g"))

    def run(batches):
        for batch in batches:
            found = [places(_tokens(s), _tokens(w)) for s, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["form", "places"])

    both = dealt.join(spread, ["host", "g"]).select("form", "stream", "wrapper")
    return materialise(both.mapInArrow(run, "form long, places array<int>"), "places", PAIR_ROWS)


def slots_and_template(parsed: DataFrame, wrappers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The slots' text by host and path (host, path, mass), the template's spots of each form that has any (form, template), and the containers that more than half of the pages that have them repeat (host, root).

    Equal pages of a host count once. A text that has no place in the wrapper is a slot.
    """
    pages = parsed.select("host", "form", F.xxhash64("texts").alias("content"), "containers").groupBy("host", "form", "content").agg(F.any_value("containers").alias("containers"))
    repeated = pages.select("host", F.explode("containers").alias("root", "many")).groupBy("host", "root").agg((F.count_if(F.col("many")) * 2 > F.count("*")).alias("many")).where("many").drop("many")
    slim = parsed.select("host", "form", F.xxhash64("texts").alias("content"), F.arrays_zip("paths", "spots", F.transform("texts", lambda t: F.xxhash64(t)).alias("hashes"), F.transform("texts", lambda t: F.length(t).cast("long")).alias("sizes")).alias("blocks"))
    slim = slim.dropDuplicates(["form", "content"]).join(placed_streams(parsed, wrappers), "form")
    blocks = slim.select("host", "form", "places", F.explode("blocks").alias("b")).select("host", "form", F.col("b.paths").alias("path"), F.col("b.spots").alias("spot"), F.get("places", F.col("b.spots.at")).alias("place"), F.col("b.hashes").alias("hash"), F.col("b.sizes").alias("size"))
    blocks = materialise(blocks, "blocks")
    placed = blocks.where("place >= 0").withColumn("nth", F.col("spot.nth"))
    fixed = placed.groupBy("host", "place", "nth").agg(F.count("*").alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"))
    fixed = materialise(fixed.where((F.col("low") == F.col("high")) & (F.col("n") >= TEMPLATE_PAGES)).select("host", "place", "nth"), "template")
    template = placed.select("host", "form", "spot", "place", "nth").distinct().join(fixed, ["host", "place", "nth"]).groupBy("form").agg(F.collect_set("spot").alias("template"))
    slots = blocks.withColumn("nth", F.col("spot.nth")).join(fixed, ["host", "place", "nth"], "left_anti")
    return slots.groupBy("host", "path").agg(F.sum("size").alias("mass")), template, repeated


def content_roots(slots: DataFrame, repeated: DataFrame) -> DataFrame:
    """host and root, the path of the container that holds the text of the slots (host, path, mass) and isn't repeated (host, root)."""
    slots = materialise(slots, "slots")
    parts = F.split(F.substring("path", 2, 1 << 20), "/")
    above = slots.select("host", "mass", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, k), "/")))).alias("root"))
    above = above.groupBy("host", "root").agg(F.sum("mass").alias("mass")).join(repeated, ["host", "root"], "left_anti")
    total = slots.groupBy("host").agg(F.sum("mass").alias("total"))
    last = F.element_at(F.split("root", "/"), -1)
    told = last.rlike(r"^(article|main)($|\.)")
    depth = F.size(F.split("root", "/"))
    scored = above.join(total, "host").where(F.when(told, F.col("mass") >= 0.5 * F.col("total")).otherwise(F.col("mass") >= 0.8 * F.col("total")))
    rank = F.struct(told.cast("int"), F.when(told, -depth).otherwise(depth), F.col("mass"), F.col("root"))
    return scored.groupBy("host").agg(F.max_by("root", rank).alias("root"))


def main_texts(df: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, root and wrapper_sha256 (of the host's wrapper)."""
    parsed = materialise(parsed_pages(df, page_id, url, page).withColumn("form", F.xxhash64("host", "wrapper")), "pages")
    wrappers = infer_wrappers(parsed)
    slots, template, repeated = slots_and_template(parsed, wrappers)
    known = wrappers.select("host", F.sha2("wrapper", 256).alias("wrapper_sha256")).join(content_roots(slots, repeated), "host", "left")
    known, template = materialise(known, "roots"), materialise(template, "template-spots")  # their sizes are known then: Spark broadcasts them if they are small, and shuffles no pages
    pages = parsed.drop("wrapper", "containers").join(known, "host", "left").join(template, "form", "left")
    zipped = F.arrays_zip("paths", "texts", "spots")
    below = F.filter(zipped, lambda b: (b["paths"] == F.col("root")) | F.startswith(b["paths"], F.concat("root", F.lit("/"))))
    below = F.when(F.col("root").isNotNull(), below).otherwise(F.slice(zipped, 1, 0))

    def in_slots(blocks):
        return F.filter(blocks, lambda b: ~F.coalesce(F.array_contains("template", b["spots"]), F.lit(False)))

    chosen = zipped
    for blocks in (in_slots(zipped), below, in_slots(below)):
        chosen = F.when(F.size(blocks) > 0, blocks).otherwise(chosen)
    text = F.array_join(F.transform(chosen, lambda b: b["texts"]), "\n")
    return pages.select("page_id", "url", text.alias("text"), "root", "wrapper_sha256").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "root", "wrapper_sha256")
