"""Links of web pages that are given as a table."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import absolute_link, safe_file_name

ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row for each <a href> of each page: the page's other columns, link_no, href, link_text (tags cut, ends stripped)."""
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("href"), F.regexp_extract_all(html, F.lit(ANCHOR), 2).alias("body"))
    rows = pages.select("*", F.posexplode(both).alias("link_no", "a")).drop(html)
    text = F.trim(F.regexp_replace("a.body", "<[^>]*>", ""))
    return rows.select(*[c for c in rows.columns if c != "a"], F.col("a.href").alias("href"), text.alias("link_text"))


#: A comment, what holds no markup, or a tag with its attributes; each alternative moves on, so that a scan is linear.
_PIECE = re.compile(r"""<!--(?:.*?-->|.*)|<(script|style)\b[^>]*+>(?:.*?</\1\s*+>|.*)|<(/?)([a-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-z][^\s/>]*+)([^>]*+)>""", re.I | re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+)?))?""")


def scanned_links(html: str | None) -> Iterator[tuple[str, str]]:
    """(target, text) of each anchor with a target, in page order, however its attributes are quoted; a null page has none.

    Character references are decoded. The text of an anchor that is not closed ends at the next anchor.
    """
    at, href, text = 0, None, []
    html = html or ""
    for m in _PIECE.finditer(html):
        text.append(html[at : m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if tag != "a":
            continue
        if href is not None:
            yield href, " ".join(unescape("".join(text)).split())
        href, text = None, []
        if not (m[2] or m[5]):
            for a in _ATTRIBUTE.finditer(m[4] or m[7] or ""):
                if a[1].lower() == "href":
                    href = unescape(a[2] or a[3] or a[4] or "")
                    break
    if href is not None:
        yield href, " ".join(unescape("".join([*text, html[at:]])).split())


def parsed_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_links() by a scanner of tags: unquoted and unclosed anchors too, references decoded, comments and scripts left out.

    A row for each anchor with a target: the page's other columns, link_no, href, link_text, white space in it as one space.
    """
    keep = [c for c in pages.columns if c != html]

    def scanned(batches):
        for batch in batches:
            rows, numbers, hrefs, texts = [], [], [], []
            for k, page in enumerate(batch.column(len(keep)).to_pylist()):
                for n, (href, text) in enumerate(scanned_links(page)):
                    rows.append(k), numbers.append(n), hrefs.append(href), texts.append(text)
            taken = batch.select(list(range(len(keep)))).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(numbers, pa.int32()), pa.array(hrefs, pa.string()), pa.array(texts, pa.string())], [*keep, "link_no", "href", "link_text"])

    kinds = dict(pages.dtypes)
    return pages.select(*keep, html).mapInArrow(scanned, "".join(f"`{c}` {kinds[c]}, " for c in keep) + "link_no int, href string, link_text string")


def with_suffix(links: DataFrame, suffix: str) -> DataFrame:
    """Links whose target ends so, in any case."""
    return links.filter(F.lower("href").endswith(suffix.lower()))


def naming(links: DataFrame, part: str) -> DataFrame:
    """Links whose target holds the text."""
    return links.filter(F.col("href").contains(part))


def without_texts(links: DataFrame, denied: list[str], c: str = "link_text") -> DataFrame:
    """Rows whose text holds none of the denied texts."""
    if not denied:
        return links
    bad: Column = reduce(lambda a, b: a | b, [F.col(c).contains(x) for x in denied])
    return links.filter(~F.coalesce(bad, F.lit(False)))


def document_manifest(pages: DataFrame, series: str, base: str, suffix: str = ".pdf", denied: list[str] | None = None) -> DataFrame:
    """href, link_text, file_name and url of the documents that pages link to."""
    links = without_texts(with_suffix(page_links(pages), suffix), denied or [])
    name = F.concat(F.lit(f"{series}_"), safe_file_name("link_text"), F.lit(suffix))
    return links.withColumns({"file_name": name, "url": absolute_link("href", base)})
