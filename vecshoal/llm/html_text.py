"""Main text of web pages by removing what a site repeats on its pages.

Each page is read once into blocks of text. Every element that holds text is a subtree with a hash of its tags and
words, on every page and whether or not it is told by a name. Spark counts the subtrees by host, and those found on at least
``share`` of a host's pages (``least_pages`` at least), or on ``many_pages`` however large the host is, are template and go with all
they hold. Copies are no evidence: pages of a host with equal blocks count as one, and so do equal articles, which a site may show on
their own page and in its lists. Subtrees of pages meet the templates by host and hash, and a page gets those it holds. What sites do not repeat word for word - menus that
change from page to page, adverts, forms, reader comments - is told by element, and by whole
role and class names. If a page marks its article
(``article``, ``main``) and the article holds text, only that is text. Elements inside it are template like any others, but
its passages - paragraphs, headings, quotations, single items of lists and tables - do not go by their own count: pages of a
site may quote one another. They go with a recurring element around them.

Cases: a NULL html is empty and gives an empty text; a NULL url belongs to a host of its own; repeated rows count as one page
and are given out alike; malformed and cut-off markup is read as far as it goes; an empty table gives an empty result. Only id, url and
html are read, so other columns never clash.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshoal.llm.common import stored, whole
from vecshoal.operators.joins import attach, local_copy

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|iframe)\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>|<(?=[a-zA-Z/!?])[^>]*\Z|([^<]+|<)""",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
BLOCK = set(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a start tag closes when it finds them open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
PARAGRAPH = {"p"}
#: A start tag closes nothing beyond these.
HOLDS = set("ul ol dl table div section article body".split())
BESIDE = set("aside button dialog footer form head header menu nav select svg".split())
#: Class names, ids and roles of adverts and reader comments, wherever they stand.
ADDED_NAMES = set(
    "ad ads advert adverts advertisement advertising comment comments disqus promo promoted replies reply respond sponsor sponsored".split()
)
#: The same of what else is not article text, outside an article that the page marks.
BESIDE_NAMES = ADDED_NAMES | set(
    "banner breadcrumb breadcrumbs consent contentinfo complementary cookie cookies footer form header login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pagination popup related search share sharing sidebar signup social "
    "subscribe toolbar widget".split()
)
#: Words that say where or how large a part is, and nothing of what it holds.
NEUTRAL = set(
    "area bar block bottom box column container content group head inner item items left links list main outer page panel right row section site "
    "slot thread top unit wrap wrapper".split()
)
MAIN = {"article", "main"}
#: Elements of an article that are not template by their own count.
PASSAGE = set("blockquote dd dt h1 h2 h3 h4 h5 h6 li p pre td th tr".split())
#: Elements that are the page or its article, never a part that a site repeats.
WHOLE = MAIN | {"body", "html"}
SPACE = re.compile(r"\s+")

PARSED = T.StructType(
    [
        T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("path", T.ArrayType(T.LongType()))]))),
        T.StructField("units", T.ArrayType(T.StructType([T.StructField("hash", T.LongType()), T.StructField("subtrees", T.ArrayType(T.LongType()))]))),
    ]
)


def beside(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether an element is told by its tag or name to stand beside the article.

    A name is a whole class, id or role; of a compound one every part must be such a name or a neutral word. Inside an article that
    the page marks only adverts and comments are told by name.
    """
    if tag in BESIDE and not (tag == "header" and in_main):
        return True
    if tag in ("body", "html") or not attributes:
        return False
    names = ADDED_NAMES if in_main else BESIDE_NAMES
    for found in NAMES.findall(attributes):
        for name in "".join(found).lower().split():
            parts = set(filter(None, re.split(r"[^a-z]+", name)))
            if not names.isdisjoint(parts) and parts <= names | NEUTRAL:
                return True
    return False


def page_blocks(page: str) -> tuple[list[dict], list[dict]]:
    """Blocks of text in page order, each with the hashes of the subtrees it may go with, innermost first; and the page
    followed by its articles, each with a hash of its blocks and the hashes of the subtrees in it but in no article further in.

    If the page marks an article that holds text, only blocks of it come.
    """
    tags, parents, digests, named, mains = ["#"], [-1], [xxhash.xxh64("#")], [False], [False]
    blocks: list[tuple[int, str]] = []
    words: list[str] = []
    opened: dict[str, int] = {}
    at = 0

    def flush() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(words))).strip()
        words.clear()
        if text:
            blocks.append((at, text))
            digests[at].update(text)

    def close() -> None:
        nonlocal at
        opened[tags[at]] -= 1
        digests[parents[at]].update(digests[at].digest())
        at = parents[at]

    for match in TOKEN.finditer(page):
        _, end, tag, attributes, text = match.groups()
        if text is not None:
            words.append(text)
        elif tag is not None:
            tag = tag.lower()
            if end:
                known = opened.get(tag, 0) > 0
                if known or tag in BLOCK:
                    flush()
                while known and opened[tag] and tags[at] != tag:
                    close()
                if known:
                    close()
                continue
            if tag in ("br", "img"):
                words.append(" ")
            if tag in VOID:
                continue
            apart = beside(tag, attributes, mains[at])
            if tag not in BLOCK and not apart:
                continue
            flush()
            ends = CLOSES.get(tag, PARAGRAPH)
            node = at
            while node > 0 and tags[node] not in ends and tags[node] not in HOLDS:
                node = parents[node]
            if node > 0 and tags[node] in ends:
                while at != node:
                    close()
                close()
            main = mains[at] or tag in MAIN
            tags.append(tag)
            named.append(named[at] or apart)
            opened[tag] = opened.get(tag, 0) + 1
            mains.append(main)
            digests.append(xxhash.xxh64(tag))
            parents.append(at)
            at = len(tags) - 1
    flush()
    while at > 0:
        close()
    has_main = any(mains[node] and not named[node] for node, _ in blocks)
    # The article or page around each element.
    around = [0] * len(tags)
    for node in range(1, len(tags)):
        around[node] = node if tags[node] in MAIN else around[parents[node]]
    held = {0: xxhash.xxh64(seed=1)}
    subtrees: dict[int, set[int]] = {0: set()}
    out, counted = [], {0}
    for node, text in blocks:
        up = node
        while up not in counted:
            counted.add(up)
            if tags[up] not in WHOLE:
                subtrees.setdefault(around[up], set()).add(digests[up].intdigest() - (1 << 63))
            up = parents[up]
        if named[node] or has_main and not mains[node]:
            continue
        path = []
        up = node
        while up > 0 and mains[up] >= has_main:
            if tags[up] not in WHOLE and not (has_main and tags[up] in PASSAGE):
                path.append(digests[up].intdigest() - (1 << 63))
            up = parents[up]
        out.append({"text": text, "path": path})
        line, unit = text + "\n", around[node]
        held[0].update(line)
        while unit:
            held.setdefault(unit, xxhash.xxh64()).update(line)
            unit = around[parents[unit]]
    none = xxhash.xxh64()
    return out, [{"hash": held.get(unit, none).intdigest() - (1 << 63), "subtrees": sorted(own)} for unit, own in sorted(subtrees.items())]


def extract(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    share: float = 0.2,
    least_pages: int = 3,
    many_pages: int = 100,
) -> DataFrame:
    """``page_id, url, text``: the main text, one line per block."""
    id_type = pages.schema[page_id].dataType
    schema = T.StructType([T.StructField("page_id", id_type), T.StructField("url", T.StringType()), *PARSED.fields])
    nested = pa.list_(pa.struct([("text", pa.string()), ("path", pa.list_(pa.int64()))]))
    counted = pa.list_(pa.struct([("hash", pa.int64()), ("subtrees", pa.list_(pa.int64()))]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                pages_read = [page_blocks(page) for page in part.column(2).to_pylist()]
                columns = [
                    part.column(0), part.column(1),
                    pa.array([blocks for blocks, _ in pages_read], type=nested),
                    pa.array([units for _, units in pages_read], type=counted),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "blocks", "units"])

    read = pages.select(F.col(page_id), F.col(url).cast("string"), whole(html)).mapInArrow(parse, schema)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    read = stored(read.withColumn("_host", host).withColumn("row", F.monotonically_increasing_id()), "pages")

    # Copies of a page or an article are one. Of what surrounds equal texts, one copy's is counted.
    every = F.array_sort(F.array_distinct(F.flatten(F.col("units")["subtrees"])))
    alone = F.transform("units", lambda unit: F.struct(F.lit(0).alias("page"), unit["hash"].alias("hash"), unit["subtrees"].alias("subtrees")))
    page = F.struct(F.lit(1).alias("page"), F.col("units")[0]["hash"].alias("hash"), every.alias("subtrees"))
    once = read.select("_host", F.inline(F.concat(F.array(page), alone))).groupBy("_host", "page", "hash").agg(F.min("subtrees").alias("subtrees"))
    counts = once.select("_host", "page", F.explode("subtrees").alias("subtree")).groupBy("_host", "subtree")
    counts = counts.agg(F.least(F.sum("page"), F.sum(1 - F.col("page"))).alias("n")).where(F.col("n") >= least_pages)
    sizes = read.groupBy("_host").agg(F.count_distinct(F.col("units")[0]["hash"]).alias("pages"))
    often = counts.join(sizes, "_host").where((F.col("n") >= F.col("pages") * share) | (F.col("n") >= many_pages))
    often = stored(often.select(F.struct("_host", "subtree").alias("key")), "templates")

    paths = F.array_distinct(F.flatten(F.col("blocks")["path"]))
    held = read.select("row", "_host", F.explode(paths).alias("subtree")).select("row", F.struct("_host", "subtree").alias("key"))
    marks = attach(held, often, "key", "row", salts=32).groupBy("row").agg(F.collect_list("key.subtree").alias("template"))
    marks = stored(marks, "marks")
    few = local_copy(marks)
    if few is not None:
        pages_with = read.join(F.broadcast(few), "row", "left")
    else:
        # Pages without a subtree that could be template stay where they are.
        bare = F.size(paths) == 0
        pages_with = read.where(~bare).join(marks, "row", "left")
        pages_with = pages_with.unionByName(read.where(bare).withColumn("template", F.lit(None).cast("array<bigint>")))
    template = F.coalesce("template", F.array().cast("array<bigint>"))
    own = F.filter("blocks", lambda block: ~F.arrays_overlap(block["path"], template))
    text = F.array_join(F.transform(own, lambda block: block["text"]), "\n")
    return pages_with.select("page_id", "url", text.alias("text"))
