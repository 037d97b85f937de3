"""HTML extraction: a style tree for each host, and the important branches of each page.

Pages of a host are merged into one tree. Its *element nodes* are blocks at
their place, its *style nodes* the sequences of children that an element has on
different pages; texts are leaves. The importance of an element follows from
entropies: over its styles (one layout on all pages: none) and, at the leaves,
over the pages on which a text or link occurs (the same on all pages: none);
an element's own and its children's are weighed by 0.9 to the power of the
number of its styles. Branches below a threshold are frame, not article.

No tree is ever held together. A page names the nodes that it is made of by
hashes of host and path, and Spark counts names. Importance is linear in the
styles' shares, so the importance of an element in the merged tree is the mean,
over its pages, of what follows from the page's own children: one pass over the
different layouts gives it at any depth.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .html import FLOW, Page, article_of, parse

DAMPING = 0.9
THRESHOLD = 0.3
LEAST_PAGES = 3
MOST_CUT = 0.5  # of the text of a page that says where its article is
BROADCAST_BRANCHES = 500_000  # branches to remove that are broadcast at most; more of them are joined by a shuffle
AT_ONCE = 8_000_000  # bytes of pages of one Arrow batch


def host_of(url: str | None) -> str | None:
    try:
        return urlsplit((url or "").strip()).hostname or None
    except ValueError:
        return None


def _name(*parts) -> int:
    """A 64-bit name, signed as Spark's longs are."""
    h = xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts)))
    return h - (1 << 64) if h >> 63 else h


def shape(page: Page, host: str) -> tuple[int, list[int], list[int], list[int]]:
    """(name of the layout, names of the elements, names of their styles, names of the texts' places)."""
    n = len(page.tag)
    element, style, leaf = [0] * n, [0] * n, [0] * len(page.texts)
    element[0] = _name(host, page.label[0])
    whole = xxhash.xxh3_64(host)
    for i in range(n):  # parents come before their children
        kids = page.children[i]
        style[i] = _name(element[i], *("#" if k < 0 else page.label[k] for k in kids))
        whole.update(f"{i}:{style[i]}")
        for place, k in enumerate(kids):
            if k < 0:
                leaf[-1 - k] = _name(style[i], place)
            else:
                element[k] = _name(style[i], place)
    h = whole.intdigest()
    return h - (1 << 64) if h >> 63 else h, element, style, leaf


def _pack(page: Page, element: list[int], style: list[int], leaf: list[int]) -> bytes:
    """A layout as numbers: elements, styles, places of texts, parents of both, and which elements are containers."""
    ints = lambda x: np.asarray(x, "<i8").tobytes()
    boxes = [int(t not in FLOW and i > 0 and t not in ("html", "body", "article", "main")) for i, t in enumerate(page.tag)]
    return ints([len(element), len(leaf)]) + ints(element) + ints(style) + ints(leaf) + ints(page.parent) + ints(page.at) + ints(boxes)


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    """(names of elements and texts, styles (0: text), parents, containers) of a packed layout; elements come first."""
    x = np.frombuffer(data, "<i8")
    n, m = int(x[0]), int(x[1])
    element, style, leaf, parent, at, boxes = np.split(x[2:], np.cumsum([n, n, m, n, m]))
    nothing = np.zeros(m, np.int64)
    return np.concatenate((element, leaf)), np.concatenate((style, nothing)), np.concatenate((parent, at)), np.concatenate((boxes, nothing))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    from .common import split_table

    yield from split_table(batch, AT_ONCE, "html")


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(layout, content, packed, place, feature, times) of each page; packed only where a batch has a layout first."""
    for whole in batches:
        for batch in _slices(whole):
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            known = set()
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                host = host_of(url)
                if host is None or not html:
                    continue
                page = parse(html)
                layout, element, style, leaf = shape(page, host)
                features = Counter()
                content = xxhash.xxh3_64(str(layout))
                for name, text, links in zip(leaf, page.texts, page.links, strict=True):
                    content.update(text + "\x1e")
                    features[name, _name("t", text)] += 1
                    for link in links:
                        features[name, _name("a", link)] += 1
                rows[0].append(layout)
                rows[1].append(_name(content.hexdigest()))
                rows[2].append(None if layout in known else _pack(page, element, style, leaf))
                known.add(layout)
                rows[3].append([k[0] for k in features])
                rows[4].append([k[1] for k in features])
                rows[5].append(list(features.values()))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=["layout", "content", "packed", "place", "feature", "times"])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(layout, pages, position, name, style) of each node of each layout."""
    for batch in batches:
        for layout, pages, packed in zip(*(batch.column(c).to_pylist() for c in ("layout", "pages", "packed")), strict=True):
            names, styles, _, _ = _unpack(packed)
            n = len(names)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, layout)), pa.array(np.full(n, pages)), pa.array(np.arange(n, dtype=np.int32)), pa.array(names), pa.array(styles)], names=["layout", "pages", "position", "name", "style"])


def importances(packed: bytes, known: dict[int, tuple[int, float]], damping: float = DAMPING) -> np.ndarray:
    """Importance of each node of a layout from its own children: known has (number of styles, own importance) by position; nodes of one page only are fully important."""
    names, _, parents, _ = _unpack(packed)
    out = np.ones(len(names))
    below, kids = np.zeros(len(names)), np.zeros(len(names), np.int64)
    elements = int(np.frombuffer(packed[:8], "<i8")[0])
    for i in (*range(elements, len(names)), *range(elements - 1, -1, -1)):  # texts, then elements from the last to the first
        styles, own = known.get(i, (1, 1.0))
        if i >= elements or not kids[i]:
            out[i] = own
        else:
            weight = damping**styles
            out[i] = (1 - weight) * own + weight * below[i] / kids[i]
        if parents[i] >= 0:
            below[parents[i]] += out[i]
            kids[parents[i]] += 1
    return out


def _of_boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(layout, pages, position, name, importance) of the containers of each layout."""
    for batch in batches:
        for row in batch.to_pylist():
            names, _, _, boxes = _unpack(row["packed"])
            at = np.flatnonzero(boxes)
            value = importances(row["packed"], {k["position"]: (k["styles"], k["own"]) for k in row["known"] or []})
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["layout"])), pa.array(np.full(len(at), row["pages"])), pa.array(at.astype(np.int32)), pa.array(names[at]), pa.array(value[at])], names=["layout", "pages", "position", "name", "importance"])


def style_tree(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(layouts (layout, pages, packed), nodes (name, pages, styles, own)): the merged trees of all hosts, and of each node what it tells by itself.

    own is the entropy of an element's styles, or one less the mean entropy of
    a text's features, in units of the logarithm of its pages; 1 where there is
    one page. Pages alike in layout and texts count once.
    """
    rows = pages.select("url", F.col("html").cast("string").alias("html")).mapInArrow(_shapes, "layout long, content long, packed binary, place array<long>, feature array<long>, times array<int>")
    several = materialise(rows.groupBy("layout", "content").agg(F.first("packed", ignorenulls=True).alias("packed"), F.first("place").alias("place"), F.first("feature").alias("feature"), F.first("times").alias("times")), "page-shapes")
    layouts = materialise(several.groupBy("layout").agg(F.count("*").alias("pages"), F.first("packed", ignorenulls=True).alias("packed")), "layouts")
    log = lambda c: F.when(F.col(c) > 0, F.log(F.col(c))).otherwise(F.lit(0.0))
    flat = several.select(F.explode(F.arrays_zip("place", "feature", "times")).alias("x")).select("x.place", "x.feature", F.col("x.times").alias("c"))
    features = flat.groupBy("place", "feature").agg(F.sum("c").alias("t"), F.sum(F.col("c") * log("c")).alias("s"))
    texts = features.groupBy(F.col("place").alias("name")).agg(F.avg(log("t") - F.col("s") / F.col("t")).alias("entropy"))
    each = layouts.mapInArrow(_nodes, "layout long, pages long, position int, name long, style long")
    styles = each.groupBy("name", "style").agg(F.sum("pages").alias("c"))
    # nodes of one page are left out: they are fully important
    nodes = styles.groupBy("name").agg(F.sum("c").alias("pages"), F.count("*").alias("styles"), (log("pages") - F.sum(F.col("c") * log("c")) / F.col("pages")).alias("spread"))
    nodes = nodes.where("pages > 1").join(texts, "name", "left")
    own = F.when(F.col("entropy").isNotNull(), 1 - F.col("entropy") / log("pages")).otherwise(F.col("spread") / log("pages"))
    return layouts, materialise(nodes.select("name", "pages", "styles", own.alias("own")), "style-nodes")


def unimportant(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(layout, positions): the containers of each layout whose importance in their host's tree is below ``threshold``; only hosts' nodes on ``least_pages`` pages and more are judged."""
    layouts, nodes = style_tree(pages)
    each = layouts.mapInArrow(_nodes, "layout long, pages long, position int, name long, style long")
    known = each.join(nodes.select("name", "styles", "own"), "name").groupBy("layout").agg(F.collect_list(F.struct("position", "styles", "own")).alias("known"))
    boxes = materialise(layouts.join(known, "layout", "left").mapInArrow(_of_boxes, "layout long, pages long, position int, name long, importance double"), "containers")
    low = boxes.groupBy("name").agg(F.sum("pages").alias("n"), (F.sum(F.col("importance") * F.col("pages")) / F.sum("pages")).alias("mean")).where((F.col("n") >= least_pages) & (F.col("mean") < threshold)).select("name")
    return boxes.join(low, "name").groupBy("layout").agg(F.sort_array(F.collect_list("position")).alias("positions"))


def article_text(page: Page, cut: set[int]) -> str:
    """The texts of the article, joined by line breaks, without those in containers at the positions ``cut``.

    Where the page says where its article is, branches that hold most of it are
    no frame: then, or if nothing would be left, nothing is cut.
    """
    article = article_of(page)
    keep = article.texts
    if cut:
        gone = [False] * len(page.tag)
        for i in range(len(page.tag)):
            p = page.parent[i]
            gone[i] = i not in article.roots and ((i in cut) or (p >= 0 and gone[p]))
        keep = [k for k in article.texts if not gone[page.at[k]]]
        if article.said:
            size = lambda some: sum(len(page.texts[k]) for k in some)
            if size(keep) < (1 - MOST_CUT) * size(article.texts):
                keep = article.texts
        elif not keep:
            keep = article.texts
    return "\n".join(page.texts[k] for k in keep)


def extract_articles(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    text is the article: blocks in page order, one line each, white space within
    a block as one space, character references decoded. Left out are elements
    that HTML means for something else (menus, headers, footers, sidebars,
    forms, scripts, ...), those whose class or id names such a thing (adverts,
    notices, comments, ...), and branches that the host's style tree finds
    unimportant. Paragraphs and headings are never cut for being repeated on
    other pages, only containers are.

    A page without html, or without text, has the text ''; without a host that
    can be read from its url, or of a host with few pages, only what the page
    itself says counts. Repeated rows come back each; exact copies count once
    in the tree. Extra columns don't matter; an empty table gives none. Host
    and path are never collected: the largest task input is one page.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    cuts = materialise(unimportant(rows, threshold, least_pages), "unimportant")
    size = cuts.agg(F.coalesce(F.sum(F.size("positions")), F.lit(0)).alias("n")).first()["n"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    if size <= BROADCAST_BRANCHES:
        known = pages.sparkSession.sparkContext.broadcast({r["layout"]: set(r["positions"]) for r in cuts.collect()})

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in _slices(whole):
                    texts = [article_text(page := parse(html), _cut(page, url, known.value)) for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True)]
                    yield _result(batch, texts)

        return rows.mapInArrow(finish, out)
    named = rows.mapInArrow(_with_layout, f"page_id {kinds['page_id']}, url {kinds['url']}, html string, layout long")

    def finish_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                yield _result(batch, [article_text(parse(html), set(cut or ())) for html, cut in zip(batch.column("html").to_pylist(), batch.column("positions").to_pylist(), strict=True)])

    return named.join(cuts.hint("merge"), "layout", "left").select("page_id", "url", "html", "positions").mapInArrow(finish_joined, out)


def _cut(page: Page, url: str | None, known: dict[int, set[int]]) -> set[int]:
    host = host_of(url)
    return known.get(shape(page, host)[0], set()) if known and host is not None else set()


def _with_layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _slices(whole):
            hosts = map(host_of, batch.column("url").to_pylist())
            layouts = [None if host is None else shape(parse(html), host)[0] for host, html in zip(hosts, batch.column("html").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(layouts, pa.int64())], names=["page_id", "url", "html", "layout"])


def _result(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
