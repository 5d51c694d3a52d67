"""Listing pages and detail pages: HTML to rows."""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Node:
    """An element with its children (elements and strings)."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def text(self) -> str:
        """The stripped strings inside, end to end."""
        out, stack = [], list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, Node):
                stack += reversed(c.children)
            elif c.strip():
                out.append(c.strip())
        return "".join(out)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def inside(self, tag: str) -> bool:
        node = self.parent
        while node is not None and node.tag != tag:
            node = node.parent
        return node is not None


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _date(text: str) -> str | None:
    m = re.search(r"(\d{1,2})[-/](\d{1,2})[-/](\d{4})", text)
    try:
        return datetime.date(int(m[3]), int(m[2]), int(m[1])).isoformat() if m else None
    except ValueError:
        return None


def _latin(text: str) -> float:
    letters = [c for c in text if c.isalpha()]
    return sum(c.isascii() for c in letters) / len(letters) if letters else 0.0


# The two texts of the archive column, and the marks of links.
ARCHIVED = {"Archived": True, "Non-Archived": False}
DOWNLOAD, DETAIL = "download=true", "document-detail"
MENU_ID, MENU_CLASSES = "SiteNavigationMenu", ("dropdown-menu", "submenu", "child-menu")


def listing_row(row: Node, category: str, url: str) -> dict | None:
    """One table row as a listing row, its fields found by content; None without title or any link."""
    cells = [c.text() for c in row.all("td")]
    if len(cells) < 4:
        return None
    dates = {t: _date(t) for t in cells}
    anchors = [(a, a.attrs["href"]) for a in row.all("a") if "href" in a.attrs]
    ref = next((t for t in cells if t.count("/") >= 2 and re.search("[A-Za-z]", t) and not dates[t]), "")
    files: dict[str, str] = {}
    for a, href in anchors:
        if DOWNLOAD in href:
            files.setdefault(urljoin(url, href), a.text())
    other = [href for _, href in anchors if DOWNLOAD not in href.lower()]
    detail = next((h for h in other if DETAIL in h.lower()), other[0] if other else None)
    plain = [t for t in cells if len(t) >= 5 and t not in ARCHIVED and not dates[t] and t != (ref or None)]
    titles = plain + [t for a, _ in anchors if (t := a.text())]
    title = max(titles, key=lambda t: (round(_latin(t), 3), len(t)), default="")
    if not title or detail is None and not files:
        return None
    box = next((i for i in row.all("input") if "checkSingle" in i.classes()), None)
    made = "sha1:" + hashlib.sha1(f"{category}|{title}|{ref}".encode()).hexdigest()
    return {
        "liferay_id": (box.attrs.get("value") if box else None) or made,
        "category": category,
        "title": title,
        "reference_no": ref,
        "date_issued": next((d for d in map(dates.get, cells) if d), None),
        "archived": next((ARCHIVED[t] for t in cells if t in ARCHIVED), None),
        "detail_page": urljoin(url, detail) if detail is not None else None,
        "pdf_links": list(files),
        "pdf_filenames": list(files.values()),
        "file_sizes": [p.text() for p in row.all("p") if "text-muted" in p.classes()],
        "source_page": url,
    }


def listing_rows(html: str | None, category: str, url: str) -> tuple[list[dict], int]:
    """Valid rows of the page's listing table in order, and the number of its rows."""
    table = next((t for t in parse(html).all("table") if "table" in t.classes()), None)
    rows = [r for r in table.all("tr") if r.inside("tbody")] if table else []
    return [x for r in rows if (x := listing_row(r, category, url))], len(rows)


def detail_stubs(html: str | None, url: str) -> list[dict]:
    """``document_id, title, detail_url`` of a plain list of detail links, the first of each id."""
    root = parse(html)
    scope = next((t for t in root.all("table") if "table" in t.classes()), root)
    out: dict[str, dict] = {}
    for a in scope.all("a"):
        href = a.attrs.get("href", "")
        m, title = re.search(r"documentId=(\d+)", href), a.text()
        if DETAIL in href and m and title:
            out.setdefault(m[1], {"document_id": m[1], "title": title, "detail_url": urljoin(url, href)})
    return list(out.values())


def in_menu(a: Node, reach: int = 8) -> bool:
    """Whether one of the nearest ancestors is the site's navigation."""
    node = a.parent
    for _ in range(reach):
        if node is None or not node.tag:
            return False
        if node.tag == "nav" or MENU_ID in node.attrs.get("id", "") or any(c in node.attrs.get("class", "") for c in MENU_CLASSES):
            return True
        node = node.parent
    return False


def detail_files(html: str | None, url: str) -> dict[str, str]:
    """Address and name of the attachments on a detail page, without navigation links, each once."""
    out: dict[str, str] = {}
    for a in parse(html).all("a"):
        if DOWNLOAD in a.attrs.get("href", "") and not in_menu(a):
            out.setdefault(urljoin(url, a.attrs["href"]), a.text())
    return out


ROWS = (
    "liferay_id string, category string, title string, reference_no string, date_issued string, archived boolean, detail_page string, "
    "pdf_links array<string>, pdf_filenames array<string>, file_sizes array<string>, source_page string"
)
_ARROW = pa.struct([(n, pa.bool_() if n == "archived" else pa.list_(pa.string()) if n in ("pdf_links", "pdf_filenames", "file_sizes") else pa.string()) for n in
                    ("liferay_id", "category", "title", "reference_no", "date_issued", "archived", "detail_page", "pdf_links", "pdf_filenames", "file_sizes", "source_page")])


def parse_pages(pages: DataFrame) -> DataFrame:
    """``category, cur, raw_rows, rows array<struct>`` of pages ``category, cur, url, html`` (a DOM is needed, so Arrow batches)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [listing_rows(h, c, u) for h, c, u in zip(*(batch.column(n).to_pylist() for n in ("html", "category", "url")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("category"), batch.column("cur"), pa.array([n for _, n in found], pa.int32()), pa.array([r for r, _ in found], pa.list_(_ARROW))],
                ["category", "cur", "raw_rows", "rows"],
            )

    fields = ROWS.replace(", ", ",").replace(" ", ":", 100)
    return pages.select("category", F.col("cur").cast("int").alias("cur"), "url", "html").mapInArrow(run, f"category string, cur int, raw_rows int, rows array<struct<{fields}>>")


def walk(parsed: DataFrame, per_page: int = 20) -> DataFrame:
    """Rows of the pages a walk through each category would have read, with ``pos`` for their order.

    The walk ends with the first page that has no rows, no valid rows or fewer than ``per_page`` rows, and
    before one whose ids were all seen on earlier pages.  One row per page is sorted per category, ids
    are compared by their first page, so no running set is kept.
    """
    from pyspark.sql import Window as W

    ids = parsed.select("category", "cur", F.explode(F.transform("rows", lambda r: r["liferay_id"])).alias("id"))
    first = ids.groupBy("category", "id").agg(F.min("cur").alias("cur"))
    new = first.groupBy("category", "cur").agg(F.count("*").alias("new_ids"))
    pages = parsed.join(new, ["category", "cur"], "left").withColumn("valid", F.size("rows"))
    repeat = (F.col("cur") > F.min("cur").over(W.partitionBy("category"))) & (F.col("valid") > 0) & F.col("new_ids").isNull()
    ends = (F.col("raw_rows") < per_page) | (F.col("valid") == 0)
    before = W.partitionBy("category").orderBy("cur").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("category").orderBy("cur").rowsBetween(W.unboundedPreceding, 0)
    read = pages.withColumns({"__stop": F.coalesce(F.max(ends.cast("int")).over(before), F.lit(0)), "__repeat": F.max(repeat.cast("int")).over(upto)})
    kept = read.filter("__stop = 0 AND __repeat = 0")
    return kept.select("cur", F.posexplode("rows").alias("n", "r")).select("r.*", (F.col("cur") * F.lit(1000) + F.col("n")).cast("bigint").alias("pos"))


def resolve_details(details: DataFrame) -> DataFrame:
    """Listing rows from fetched detail pages ``category, source_page, document_id, title, detail_url, html``; pages without attachment give none."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            files = [detail_files(h, u) if h else {} for h, u in zip(batch.column("html").to_pylist(), batch.column("detail_url").to_pylist())]
            columns = [batch.column(c) for c in ("document_id", "category", "title", "detail_url", "source_page")]
            lists = [pa.array([list(f) for f in files], pa.list_(pa.string())), pa.array([list(f.values()) for f in files], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, *lists], ["liferay_id", "category", "title", "detail_page", "source_page", "pdf_links", "pdf_filenames"])

    found = details.select("document_id", "category", "title", "detail_url", "source_page", "html").mapInArrow(
        run, "liferay_id string, category string, title string, detail_page string, source_page string, pdf_links array<string>, pdf_filenames array<string>"
    )
    none = F.array().cast("array<string>")
    return found.filter(F.size("pdf_links") > 0).select(
        "liferay_id", "category", "title", F.lit("").alias("reference_no"), F.lit(None).cast("string").alias("date_issued"), F.lit(None).cast("boolean").alias("archived"),
        "detail_page", "pdf_links", "pdf_filenames", none.alias("file_sizes"), "source_page",
    )


def stub_rows(pages: DataFrame) -> DataFrame:
    """``category, source_page, document_id, title, detail_url`` of plain link lists ``category, url, html``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = [(c, u, s["document_id"], s["title"], s["detail_url"]) for c, u, h in zip(*(batch.column(n).to_pylist() for n in ("category", "url", "html"))) for s in detail_stubs(h, u)]
            names = ["category", "source_page", "document_id", "title", "detail_url"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(5)], names)

    return pages.select("category", "url", "html").mapInArrow(run, "category string, source_page string, document_id string, title string, detail_url string")
