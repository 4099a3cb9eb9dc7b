"""Directory pages: lines, links and titles of HTML, and label-value blocks."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCKS = frozenset("p div li ul ol tr td th h1 h2 h3 h4 h5 h6 br section article dl dt dd table header footer nav title".split())
_HIDDEN = frozenset(("script", "style"))


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.links: list[dict[str, str]] = []
        self._line: list[str] = []
        self._hidden = 0
        self._link: tuple[str, list[str]] | None = None

    def _flush(self):
        if text := " ".join("".join(self._line).split()):
            self.lines.append(text)
        self._line = []

    def handle_starttag(self, tag, attrs):
        self._hidden += tag in _HIDDEN
        if tag in _BLOCKS:
            self._flush()
        if tag == "a" and (href := dict(attrs).get("href")):
            self._link = (href, [])

    def handle_endtag(self, tag):
        self._hidden = max(0, self._hidden - (tag in _HIDDEN))
        if tag == "a" and self._link:
            self.links.append({"label": " ".join("".join(self._link[1]).split()), "href": self._link[0]})
            self._link = None
        if tag in _BLOCKS:
            self._flush()

    def handle_data(self, data):
        if not self._hidden:
            self._line.append(data)
            if self._link:
                self._link[1].append(data)


def page(html: str | None) -> tuple[list[str], list[dict[str, str]]]:
    p = _Page()
    p.feed(html or "")
    p.close()
    p._flush()
    return p.lines, p.links


def parse_pages(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Rows (id, lines, links) with links as (label, href)."""
    kinds = pa.schema([("id", pa.int64()), ("lines", pa.list_(pa.string())), ("links", pa.list_(pa.struct([("label", pa.string()), ("href", pa.string())])))])

    def run(batches):
        for batch in batches:
            found = [page(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([f[0] for f in found], kinds.field("lines").type), pa.array([f[1] for f in found], kinds.field("links").type)], names=["id", "lines", "links"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "id long, lines array<string>, links array<struct<label:string,href:string>>").withColumnRenamed("id", id_col)


def hrefs(html: Column) -> Column:
    """Addresses of double-quoted links, natively."""
    return F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))


def h1_title(html: Column) -> Column:
    """The first heading without tags; null if there is none."""
    inner = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(inner, "<[^>]*>", " "), r"\s+", " ")), F.lit(""))


def directory_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/(\d+)(?:[/?#]|$)", 1), F.lit(""))


def key_values(lines: DataFrame, page: str, order: str, text: str, starts: str, labels: list[str]) -> DataFrame:
    """Records of label-value lines: a start label opens one; a value is inline or within three lines."""
    from pyspark.sql import Window

    w = Window.partitionBy(page).orderBy(order)
    label = F.regexp_extract(text, rf"(?iu)^\s*({'|'.join(labels)})\s*:?", 1)
    inline = F.nullif(F.regexp_extract(text, rf"(?iu)^\s*(?:{'|'.join(labels)})\s*:\s*(.+?)\s*$", 1), F.lit(""))
    df = lines.withColumns({"_label": F.lower(label), "_inline": inline})
    after = [F.when(F.lead("_label", k).over(w) == "", F.nullif(F.trim(F.lead(text, k).over(w)), F.lit(""))) for k in (1, 2, 3)]
    df = df.withColumns({"record": F.sum((F.col("_label") == starts.lower()).cast("int")).over(w), "_value": F.coalesce("_inline", *after)})
    df = df.where("_label <> '' and record > 0")
    return df.groupBy(page, "record").pivot("_label", [x.lower() for x in labels]).agg(F.first("_value"))
