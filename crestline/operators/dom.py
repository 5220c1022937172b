"""Pages to rows of elements. The parser is Python's own, the rest of the extraction stays in Spark expressions."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT = {"link", "meta", "img", "a", "svg", "script", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# an opening tag closes these open ones, unless a scope element stands between
CLOSES = {
    "li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    **{t: {"p"} for t in ("div", "ul", "ol", "table", "header", "footer", "nav", "section", "article", "form", "h1", "h2", "h3", "h4", "h5", "h6")},
}
SCOPE = {"ul", "ol", "table", "select", "dl", "div", "header", "footer", "nav", "section", "article", "body", "html", "form"}
RAW = {"script", "style", "title", "textarea"}
ROWS_AT_ONCE = 5_000  # elements, of whole pages, that are held before they are passed on

ELEMENT = (
    "page string, node_id int, img_no int, tag string, classes array<string>, id string, role string, attrs map<string,string>, "
    "ancestors array<struct<node_id:int,tag:string,classes:array<string>,id:string,role:string>>, text string"
)


class _Tree(HTMLParser):
    """Collects the kept elements with their ancestors, nearest first; never fails on broken markup."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html, self.rows, self.open, self.count, self.imgs = html, [], [], 0, 0
        self.line_starts = [0]
        for line in html.split("\n"):
            self.line_starts.append(self.line_starts[-1] + len(line) + 1)

    def _offset(self) -> int:
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    def handle_starttag(self, tag, attrs):
        closes = CLOSES.get(tag)
        if closes:
            for k in range(len(self.open) - 1, -1, -1):
                name = self.open[k][0]["tag"]
                if name in closes:
                    self._close(k)
                    break
                if name in SCOPE:
                    break
        self.count += 1
        a = {}
        for k, v in attrs:
            a.setdefault(k, v or "")
        node = {"node_id": self.count, "tag": tag, "classes": a.get("class", "").split(), "id": a.get("id", ""), "role": a.get("role", "")}
        row = None
        if tag in KEPT or "style" in a:
            row = {**node, "attrs": a, "ancestors": [x[0] for x in reversed(self.open)], "text": None, "img_no": None}
            if tag == "img":
                row["img_no"] = self.imgs
                self.imgs += 1
            self.rows.append(row)
        if tag not in VOID:
            self.open.append((node, row, self._offset()))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open:
            self._close(len(self.open) - 1, self._offset() + len(self.get_starttag_text() or ""))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0]["tag"] == tag:
                end = self.html.find(">", self._offset())
                self._close(k, end + 1 if end >= 0 else len(self.html))
                return

    def handle_data(self, data):
        if self.open and self.open[-1][0]["tag"] in RAW and self.open[-1][1] is not None:
            row = self.open[-1][1]
            row["text"] = (row["text"] or "") + data

    def _close(self, k: int, end: int | None = None):
        end = self._offset() if end is None else end
        for node, row, start in self.open[k:]:
            if row is not None and node["tag"] == "svg":
                row["text"] = self.html[start:end]
        del self.open[k:]

    def finish(self) -> list[dict]:
        try:
            self.feed(self.html)
            self.close()
        except Exception:
            pass  # what was read so far counts
        self._close(0, len(self.html))
        return self.rows


def parse_elements(html: str) -> list[dict]:
    return _Tree(html).finish()


def page_elements(pages: DataFrame, page_col: str = "domain", html_col: str = "html") -> DataFrame:
    """One row per element that extraction looks at: links, metas, images, anchors, vector images, scripts, titles and styled elements.

    ``img_no`` counts all images of a page from 0; ``text`` is the markup of a vector image or the text of a script or title.
    Null pages give no row; broken markup gives what can be read.
    """

    def run(batches):
        frame = lambda rows: pd.DataFrame(rows, columns=["page", "node_id", "img_no", "tag", "classes", "id", "role", "attrs", "ancestors", "text"], dtype=object)
        rows = []
        for pdf in batches:
            for p, h in zip(pdf["page"], pdf["html"]):
                rows += [{"page": p, **r} for r in parse_elements(h)]
                if len(rows) >= ROWS_AT_ONCE:
                    yield frame(rows)
                    rows = []
        if rows:
            yield frame(rows)

    taken = pages.select(F.col(f"`{page_col}`").alias("page"), F.col(f"`{html_col}`").alias("html")).where(F.col("html").isNotNull())
    return taken.mapInPandas(run, ELEMENT)
