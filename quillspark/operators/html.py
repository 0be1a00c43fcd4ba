"""Text and metadata of HTML pages, with the standard library's parser only."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

# Void elements, furniture by tag, class, id and attribute, where main content is, blocks of text, wordings without value.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DROP_TAGS = {"nav", "aside", "footer", "header", "form", "iframe", "script", "style", "noscript", "svg", "canvas"}
DROP_CLASSES = {
    "nav", "navigation", "menu", "sidebar", "footer", "header", "cookie", "cookies", "cookie-banner", "gdpr", "comments", "comment-section", "related",
    "related-posts", "related-articles", "social", "social-share", "share-buttons", "ads", "advertisement", "ad-container", "sponsor", "popup", "modal",
    "overlay", "newsletter", "pagination", "pager", "page-numbers",
}
DROP_IDS = {"comments", "disqus_thread"}
DROP_PARTS = ("cookie", "banner")
BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "blockquote"}
LOW_VALUE = re.compile(
    r"\s*(?:read more|share this|comments?|related (?:posts?|articles?)|advertisement|sponsored|tags?:|categories?:|filed under|posted (?:in|on)|previous|next|page \d+|\d+ (?:comments?|replies))\s*",
    re.IGNORECASE,
)
META = {
    "author": ["author", "article:author", "twitter:creator"], "description": ["description", "og:description", "twitter:description"], "keywords": ["keywords"],
    "canonical_url": ["canonical", "og:url", "twitter:url"], "site_name": ["og:site_name", "twitter:site"], "published_time": ["article:published_time", "datePublished"],
    "modified_time": ["article:modified_time", "dateModified"], "section": ["article:section"], "article_tag": ["article:tag"],
}


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed([c for c in node.children if isinstance(c, Node)]))

    def text(self) -> str:
        """All text pieces below, each trimmed, without anything between them."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node.strip())
            else:
                stack.extend(reversed(node.children))
        return "".join(out)


class TreeBuilder(HTMLParser):
    """A forgiving tree: an end tag closes up to its start tag, and one without a start tag is passed over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ("li", "p", "td", "th", "tr") and self.open[-1].tag == tag:
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parsed(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def _is_furniture(node: Node) -> bool:
    classes, own_id = node.attrs.get("class", "").split(), node.attrs.get("id", "")
    return (
        node.tag in DROP_TAGS or bool(DROP_CLASSES & set(classes)) or own_id in DROP_IDS or any(p in node.attrs.get("class", "") or p in own_id for p in DROP_PARTS)
        or node.attrs.get("aria-hidden") == "true" or node.attrs.get("role") == "complementary"
    )


def pruned(node: Node) -> Node:
    """The tree without furniture and without elements that directly hold a wording of no value."""
    out = Node(node.tag, node.attrs)
    for child in node.children:
        if isinstance(child, str):
            out.children.append(child)
        elif not _is_furniture(child) and not any(isinstance(c, str) and c.strip() and LOW_VALUE.fullmatch(c) for c in child.children):
            out.children.append(pruned(child))
    return out


def main_content(root: Node) -> Node:
    """The first main element, article, main role, or content or post by class or id; else the body, else all."""
    nodes = list(root.walk())
    has_class = lambda n, c: c in n.attrs.get("class", "").split()
    for test in (
        lambda n: n.tag == "main", lambda n: n.tag == "article", lambda n: n.attrs.get("role") == "main", lambda n: has_class(n, "content"),
        lambda n: n.attrs.get("id") == "content", lambda n: has_class(n, "post"), lambda n: has_class(n, "entry-content"), lambda n: n.tag == "body",
    ):
        if (hit := next(filter(test, nodes), None)) is not None:
            return hit
    return root


def metadata_of(root: Node) -> dict:
    """Title, language, meta fields by priority, open graph and card maps, and the first article's linked data."""
    nodes = list(root.walk())
    metas = [n.attrs for n in nodes if n.tag == "meta"]
    out: dict = {}
    title = next((n.text() for n in nodes if n.tag == "title"), "")
    lang = next((n.attrs.get("lang", "") for n in nodes if n.tag == "html"), "")
    out |= {"title": title or None, "language": lang or None}
    for name, keys in META.items():
        out[name] = next((m["content"] for key in keys for by in ("property", "name") for m in metas if m.get(by) == key and m.get("content")), None)
    graph = {m["property"].replace("og:", "og_"): m["content"] for m in metas if m.get("property", "").startswith("og:") and m.get("content")}
    card = {m["name"].replace("twitter:", "twitter_"): m["content"] for m in metas if m.get("name", "").startswith("twitter:") and m.get("content")}
    out |= {"open_graph": graph or None, "twitter_card": card or None, "schema_org": None}
    for n in nodes:
        if n.tag == "script" and n.attrs.get("type") == "application/ld+json":
            try:
                data = json.loads("".join(c for c in n.children if isinstance(c, str)))
            except ValueError:
                continue
            if isinstance(data, dict) and data.get("@type") in ("Article", "NewsArticle", "BlogPosting"):
                named = lambda x: x.get("name") if isinstance(x, dict) else x if isinstance(x, str) else None
                publisher = data.get("publisher")
                out["schema_org"] = {"type": data["@type"], "headline": data.get("headline"), "author": named(data.get("author")), "datePublished": data.get("datePublished"), "dateModified": data.get("dateModified"), "publisher": named(publisher) if isinstance(publisher, dict) else None}
                break
    return out


def extracted(html: str | None) -> dict:
    """``text`` and ``metadata`` of one page; a page that can't be read gives an empty text."""
    root = parsed(html or "")
    lines = [t for n in main_content(pruned(root)).walk() if n.tag in BLOCKS and (t := n.text()) and not (len(t) < 20 and LOW_VALUE.fullmatch(t))]
    return {"text": re.sub(r"\s+", " ", " ".join(lines)).strip(), "metadata": metadata_of(root)}
