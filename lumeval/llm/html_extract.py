"""Main text of web pages by a site style tree.

Every page becomes a list of blocks, each with its style path: the open containers (tag and first class
or id) from the body down, and the block's own tag.  The pages of a host are merged by these
paths: a node of the site style tree counts its contents (texts) and, for containers, the layouts of their children.  A
node's importance is the normalised entropy of its contents over the host, weighted with the
entropy of the layout that presents it: a menu or notice that looks the same on all pages has none.
Branches below ``LEAST`` are removed from each page of the host, given ``EVIDENCE`` occurrences.

Menus, headers, footers, side bars, adverts, forms and the like are also recognised by their elements and class
names, as are reader comments; if a page has an article (or main) element, the text is what that element
holds.  Headings and paragraphs that stand in an article without a class of their own are content whatever their
entropy, so copies of one page do not erase themselves.

Defined results: null or empty html gives an empty text; unclosed elements end with their container;
raw white space in a block becomes one space; blocks are joined by one line feed; a null url is a host of its own;
repeated rows are extracted row by row; other columns are never read.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace

LEAST = 0.3
EVIDENCE = 8
LAYOUT_WEIGHT = 0.2
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|select|button|title)\b[^>]*>"
                   r".*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
                   re.S | re.I)
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Containers: only these are kept open, so that unclosed paragraphs and inline marks do no harm.
CONTAINERS = frozenset("body div section article main nav aside header footer form ul ol dl table thead tbody tr "
                       "figure blockquote details fieldset".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre hr figcaption address summary caption".split())
OUTSIDE = ("", "", False, False, False)
NOISE_TAGS = frozenset("nav aside footer form dialog menu head".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement banner sponsored promo promotion cookie cookies consent notice "
                        "popup modal sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
                        "comment comments disqus reply replies share sharing social newsletter subscribe related "
                        "recommended widget toolbar pagination login search".split())


class Block:
    __slots__ = ("path", "text", "noise", "article", "plain")

    def __init__(self, path, text, noise, article, plain):
        self.path, self.text, self.noise, self.article, self.plain = path, text, noise, article, plain


def _names(attrs: str) -> tuple[str, bool]:
    """First class or id of an element, and whether its names mark it as noise."""
    first, words = "", set()
    for key, a, b, c in ATTR.findall(attrs):
        value = (a or b or c).lower()
        if not first and key.lower() != "role":
            first = value.split()[0] if value.split() else ""
        words.update(re.split(r"[^a-z0-9]+", value))
    return first, not words.isdisjoint(NOISE_WORDS)


def blocks_of(page: str | None) -> list[Block]:
    """Blocks of text in page order."""
    out: list[Block] = []
    stack: list[tuple[str, str, bool, bool, bool]] = []  # (tag, path, noise, within an article, named there)
    leaf, leaf_named = "", False
    text: list[str] = []

    def flush():
        if text:
            joined = "".join(text)
            joined = " ".join((entities.unescape(joined) if "&" in joined else joined).split())
            if joined:
                _, path, noise, article, named = stack[-1] if stack else OUTSIDE
                out.append(Block(f"{path}/{leaf}", joined, noise, article, not (leaf_named or named)))
            text.clear()

    pos = 0
    page = page or ""
    for m in TOKEN.finditer(page):
        if m.start() > pos:
            text.append(page[pos:m.start()])
        pos = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCKS and tag not in NOISE_TAGS and tag != "html":
            continue
        flush()
        leaf, leaf_named = "", False
        if m.group(2):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        first, noisy = _names(m.group(4)) if m.group(4) else ("", False)
        name = f"{tag}.{first}" if first else tag
        _, path, noise, article, named = stack[-1] if stack else OUTSIDE
        if tag in CONTAINERS or tag in NOISE_TAGS or noisy:
            if tag in ("body", "html"):
                if tag == "body":
                    stack[:] = [("body", "body", False, False, False)]
                continue
            here = noisy or tag in NOISE_TAGS or (tag == "header" and not article)
            stack.append((tag, f"{path}/{name}", noise or here, article or tag in ("article", "main"),
                          named or (article and bool(first))))
        else:
            leaf, leaf_named = name, bool(first)
    if pos < len(page):
        rest = page[pos:]
        text.append(rest if "<" not in rest else re.sub(r"<[a-zA-Z/!][^<]*\Z", "", rest))
    flush()
    return out


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def page_text(page: str | None, low: set[int]) -> str:
    """Main text of a page, ``low`` being the paths of its host that have no importance."""
    blocks = [b for b in blocks_of(page) if not b.noise
              and not (_key(b.path) in low and not (b.article and b.plain))]
    if any(b.article for b in blocks):
        blocks = [b for b in blocks if b.article]
    return "\n".join(b.text for b in blocks)


def _features(it):
    """(host, html) -> (host, node, parent, kind, feature): texts of nodes, layouts of containers."""
    for batch in it:
        out = [[], [], [], [], []]
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            layout: dict[str, list[str]] = {}
            for b in blocks_of(page):
                parent, _, leaf = b.path.rpartition("/")
                kids = layout.setdefault(parent, [])
                if not kids or kids[-1] != leaf:
                    kids.append(leaf)
                for c, v in enumerate((host, _key(b.path), _key(parent), 1, _key(b.text))):
                    out[c].append(v)
            for parent, kids in layout.items():
                for c, v in enumerate((host, _key(parent), _key(parent), 0, _key(" ".join(kids)))):
                    out[c].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), *[pa.array(o, pa.int64()) for o in out[1:]]],
            names=["host", "node", "parent", "kind", "feature"])


def low_nodes(ws: Workspace, pages: DataFrame) -> DataFrame:
    """(host, low): unimportant nodes of each host's style tree."""
    feats = pages.select("host", "html").mapInArrow(_features, "host string, node long, parent long, kind long, feature long")
    counts = feats.groupBy("host", "node", "parent", "kind", "feature").agg(F.count("*").alias("c"))
    nodes = ws.save(counts.groupBy("host", "node", "parent", "kind").agg(
        F.sum("c").alias("t"), F.sum(F.col("c") * F.log("c")).alias("s")), "nodes")
    entropy = F.when(F.col("t") > 1, (F.log("t") - F.col("s") / F.col("t")) / F.log("t")).otherwise(1.0)
    nodes = nodes.withColumn("h", entropy)
    text = nodes.filter("kind = 1").select("host", "node", "parent", "t", "h")
    layout = nodes.filter("kind = 0").select("host", F.col("node").alias("parent"), F.col("h").alias("presented"))
    importance = (text.join(layout, ["host", "parent"], "left")
                  .withColumn("imp", (1 - LAYOUT_WEIGHT) * F.col("h") + LAYOUT_WEIGHT * F.coalesce("presented", F.lit(1.0))))
    low = importance.filter((F.col("t") >= EVIDENCE) & (F.col("imp") < LEAST))
    return ws.save(low.groupBy("host").agg(F.collect_set("node").alias("low")), "low")


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    ws = Workspace(spark, "html_extract")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))
    src = pages.select("page_id", "url", "html").withColumn("host", host)
    rows = src.join(low_nodes(ws, src), "host", "left").select("page_id", "url", "html", "low")
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(it):
        for batch in it:
            texts = [page_text(p, set(low or ())) for p, low in
                     zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)
