"""Text of stored HTML pages, whole or by a rule per site."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Elements without text, elements that end an open paragraph, void elements.
SILENT_TAGS = {"script", "style"}
BLOCK_TAGS = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
    "section", "table", "ul",
}
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
    "track", "wbr",
}

# Per site the container and the elements inside it that hold the text, each
# as (attribute, test, value); attribute "tag" tests the element name.
SITE_RULES = [
    ("new york times", ("data-testid", "prefix", "companionColumn-"), [("tag", "equals", "p")]),
    ("cnn", ("class", "token", "storyTD"), [("tag", "equals", "p"), ("class", "contains", "inStoryHeading")]),
    ("fox", ("class", "token", "article-wrap"), [("tag", "equals", "p")]),
    ("washington post", ("class", "token", "grid-center"), [("tag", "equals", "p")]),
    ("daily mail", ("itemprop", "equals", "articleBody"), [("tag", "equals", "p")]),
    ("cnbc", ("class", "token", "ArticleBody-articleBody"), [("tag", "equals", "p")]),
    ("the guardian", ("id", "equals", "maincontent"), [("tag", "equals", "p")]),
    ("new york post", ("class", "token", "layout__inner"), [("tag", "equals", "p")]),
    ("bbc", ("tag", "equals", "html"), [("data-component", "equals", "text-block"), ("data-component", "equals", "subheadline-block")]),
    ("usa today", ("class", "token", "gnt_pr"), [("tag", "equals", "p")]),
]
# Fixed value: the one site whose text sits in several containers.
MULTI_CONTAINER_SITES = {"new york times"}


def _passes(tag: str, attrs: dict, test: tuple[str, str, str]) -> bool:
    attribute, kind, value = test
    actual = tag if attribute == "tag" else attrs.get(attribute)
    if actual is None:
        return False
    if kind == "equals":
        return actual == value
    if kind == "token":
        return value in actual.split()
    if kind == "contains":
        return value in actual
    return actual.startswith(value)


class _Reader(HTMLParser):
    """Collects stripped strings; with a rule only inside its container and elements."""

    def __init__(self, container=None, elements=(), many=False):
        super().__init__(convert_charrefs=True)
        self.container, self.elements, self.many = container, elements, many
        self.strings: list[str] = []
        self.found = container is None
        self.open: list[tuple[str, bool, bool]] = []  # tag, opens container, opens element
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        if tag in SILENT_TAGS:
            self.silent += 1
        if tag in BLOCK_TAGS:
            self._close_paragraph()
        if tag in VOID_TAGS:
            return
        attributes = dict(attrs)
        inside = any(c for _, c, _ in self.open)
        is_container = (
            self.container is not None
            and not inside
            and (self.many or not self.found)
            and _passes(tag, attributes, self.container)
        )
        self.found = self.found or is_container
        is_element = inside and any(_passes(tag, attributes, e) for e in self.elements)
        self.open.append((tag, is_container, is_element))

    def handle_startendtag(self, tag, attrs):
        return

    def _close_paragraph(self):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == "p":
                # Formatting left open inside a paragraph does not reach beyond it.
                del self.open[at:]
                return
            if self.open[at][0] in BLOCK_TAGS or self.open[at][1]:
                return

    def handle_endtag(self, tag):
        if tag in SILENT_TAGS:
            self.silent = max(0, self.silent - 1)
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                return

    def handle_data(self, data):
        text = data.strip()
        if not text or self.silent:
            return
        if self.container is None or any(e for _, _, e in self.open):
            self.strings.append(text)


def _read(html: str | None, **rule) -> tuple[str | None, bool]:
    if html is None:
        return None, False
    reader = _Reader(**rule)
    reader.feed(html)
    reader.close()
    return " ".join(reader.strings), reader.found


def html_to_text(df: DataFrame, html: str, out: str = "text") -> DataFrame:
    """Strings of a page joined by blanks; scripts, styles and comments are not text."""

    @F.pandas_udf("string")
    def text_of(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: _read(page)[0])

    return df.withColumn(out, text_of(F.col(html)))


def extract_article(
    df: DataFrame,
    html: str,
    site: str,
    rules: list[tuple] = SITE_RULES,
    multi: set[str] = MULTI_CONTAINER_SITES,
) -> DataFrame:
    """Adds `article_text` and `error`; the site name selects a rule, in any case.

    Rules are a few tuples shipped with the function. A page of an unknown site, or one
    without the container, keeps a null text and says why. Only page and site go through
    Python; other columns, of any type, stay in the JVM. Columns named like the two new
    ones are replaced.
    """
    known = {name: (container, elements, name in multi) for name, container, elements in rules}

    @F.pandas_udf("article_text string, error string")
    def extract(pages: pd.Series, sites: pd.Series) -> pd.DataFrame:
        texts, errors = [], []
        for page, name in zip(pages, sites):
            rule = known.get((name or "").lower())
            if rule is None:
                text, error = None, f"no rule for {name}"
            else:
                container, elements, many = rule
                text, found = _read(page, container=container, elements=elements, many=many)
                text, error = (text, None) if found else (None, "container not found")
            texts.append(text)
            errors.append(error)
        return pd.DataFrame({"article_text": texts, "error": errors}, dtype=object)

    read = df.withColumn("_article", extract(F.col(html), F.col(site)))
    return read.withColumns({c: F.col("_article")[c] for c in ("article_text", "error")}).drop("_article")
