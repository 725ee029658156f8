"""Labelled pages from which the extractor learns: layouts with made-up words, in which
every element carries its label. The layouts and names are fixed values; their number is
the bound of the training set."""

from __future__ import annotations

import random

LABEL = "data-label"
#: Names that page authors give to parts of a page.
CONTENT_NAMES = (
    "content", "article", "post", "entry", "main", "story", "body", "text", "page", "article-body", "post-content",
    "entry-content", "story-body", "main-content", "blog-post", "article__body", "maincontent", "single", "document", "prose",
)
OTHER_NAMES = {
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topnav", "main-menu", "submenu", "pagination", "pager", "toc", "skip-link"),
    "header": ("header", "masthead", "site-header", "topbar", "branding", "logo", "page-header", "tagline"),
    "footer": ("footer", "site-footer", "copyright", "colophon", "legal", "bottom", "imprint", "credits"),
    "aside": ("sidebar", "aside", "widget", "related", "related-posts", "rail", "secondary", "popular", "recommended", "trending", "more-stories", "tags", "author-box"),
    "notice": ("cookie", "cookie-notice", "consent", "gdpr", "notice", "popup", "modal", "alert", "paywall", "overlay", "disclaimer", "privacy-banner", "toast"),
    "ad": ("ad", "ads", "advert", "advertisement", "banner", "sponsored", "sponsor", "promo", "promotion", "ad-slot", "adsense", "partner", "teaser-ad"),
    "form": ("search", "login", "newsletter", "subscribe", "signup", "contact-form", "search-form", "register", "feedback", "poll"),
    "comments": ("comments", "comment-list", "comment", "replies", "disqus", "discussion", "reader-comments", "respond", "responses", "comment-section"),
    "share": ("share", "social", "sharing", "share-buttons", "follow", "social-links", "toolbar"),
}
TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}
#: Names of parts that only arrange what is in them.
NEUTRAL_NAMES = ("", "", "", "inner", "col", "column", "row", "block", "wrap", "wrapper", "container", "left", "right", "cell", "grid", "box")
SYLLABLES = "an be co da el fi go ha in jo ka li mo na or pe qui ra su ti un ve wo ya zu é ß ñ ó".split()


class _Pages:
    def __init__(self, seed: int):
        self.draw = random.Random(seed)
        self.paragraph = "p"

    def words(self, n: int, stops: bool = True) -> str:
        out = ["".join(self.draw.choice(SYLLABLES) for _ in range(self.draw.randint(1, 4))) for _ in range(n)]
        if stops:
            for i in range(self.draw.randint(3, 12), n, self.draw.randint(5, 14)):
                out[i] += self.draw.choice(",.,.;")
        return " ".join(out).capitalize() + ("." if stops else "")

    def link(self, n: int) -> str:
        return f'<a href="/{self.draw.randint(1, 999)}">{self.words(n, False)}</a>'

    def element(self, tag: str, label: int, inner: str, name: str = "") -> str:
        attribute = f' {self.draw.choice(("class", "id"))}="{name}"' if name else ""
        close = "" if tag in ("p", "li") and self.draw.random() < 0.2 else f"</{tag}>"
        return f'<{tag} {LABEL}="{label}"{attribute}>{inner}{close}'

    def prose(self, label: int, paragraphs: int, nested: int = 0) -> str:
        out = []
        for _ in range(paragraphs):
            if nested < 2 and self.draw.random() < 0.1:
                tag = self.draw.choice(("div", "div", "section"))
                out.append(self.element(tag, label, self.prose(label, self.draw.randint(1, 3), nested + 1), self.draw.choice(NEUTRAL_NAMES)))
                continue
            n = self.draw.choice((2, 5, 12, 30, 60, 120))
            inner = self.words(n)
            kind = self.draw.random()
            if kind < 0.15:
                inner = f"<b>{inner}<br>"
            elif kind < 0.3:
                inner += f" {self.link(2)} <em>{self.words(3)}</em>"
            out.append(self.element("p" if label == 0 else self.paragraph, label, inner))
            if self.draw.random() < 0.12:
                out.append(self.element(self.draw.choice(("h2", "h3")), label, self.words(4, False)))
            if self.draw.random() < 0.08:
                out.append(self.element("ul", label, "".join(self.element("li", label, self.words(6)) for _ in range(3))))
            if self.draw.random() < 0.05:
                out.append(self.element("blockquote", label, self.element("p", label, self.words(15))))
            if self.draw.random() < 0.04:
                row = lambda tag: self.element("tr", label, "".join(self.element(tag, label, self.words(2, False)) for _ in range(3)))
                out.append(self.element("table", label, row("th") + row("td") + row("td")))
            if self.draw.random() < 0.05:
                caption = self.element("figcaption", label, self.words(6)) if self.draw.random() < 0.7 else ""
                out.append(self.element("figure", label, '<img src="x.png">' + caption))
            if self.draw.random() < 0.03:
                terms = "".join(self.element("dt", label, self.words(2, False)) + self.element("dd", label, self.words(8)) for _ in range(3))
                out.append(self.element("dl", label, terms))
            if self.draw.random() < 0.04:
                out.append(self.element("pre", label, self.words(8, False)))
        return "".join(out)

    def other(self, kind: str) -> str:
        name = self.draw.choice(OTHER_NAMES[kind]) if kind not in TAGS or self.draw.random() < 0.6 else ""
        tag = TAGS[kind] if kind in TAGS and (not name or self.draw.random() < 0.5) else "div"
        links = "".join(self.element("li", 0, self.link(self.draw.randint(1, 3))) for _ in range(self.draw.randint(3, 9)))
        if kind == "nav":
            inner = self.element("ul", 0, links) if self.draw.random() < 0.8 else " | ".join(self.link(1) for _ in range(5))
        elif kind == "header":
            inner = self.element("div", 0, self.link(2)) + self.element("p", 0, self.words(5, False)) * (self.draw.random() < 0.5)
        elif kind == "footer":
            inner = self.draw.choice((f"&copy; 2024 {self.words(12)}", self.element("p", 0, f"&copy; {self.words(8)}") + self.element("ul", 0, links), self.element("p", 0, self.words(20))))
        elif kind == "form":
            inner = self.element("label", 0, self.words(2, False)) + '<input type="text">' + self.element("button", 0, self.words(1, False)) + self.element("p", 0, self.words(10)) * (self.draw.random() < 0.4)
        elif kind == "comments":
            one = lambda: self.element("div", 0, self.element("p", 0, self.words(self.draw.choice((5, 20, 50)))), self.draw.choice(("comment", "reply", "")))
            inner = self.element("h3", 0, self.words(2, False)) + "".join(one() for _ in range(self.draw.randint(1, 4)))
            name = name or "comments"
        elif kind in ("ad", "notice"):
            inner = self.words(self.draw.choice((4, 10, 25, 50))) if self.draw.random() < 0.6 else self.prose(0, 1)
        else:
            inner = self.element("h3", 0, self.words(2, False)) * (self.draw.random() < 0.6) + (self.element("ul", 0, links) if self.draw.random() < 0.6 else self.prose(0, 2))
        return self.element(tag, 0, inner, name)

    def page(self) -> str:
        some = lambda *kinds: "".join(self.other(k) for k in kinds if self.draw.random() < 0.6)
        self.paragraph = "p" if self.draw.random() < 0.85 else "div"  # some authors have no other
        title = self.element("h1", 1, self.words(6, False)) if self.draw.random() < 0.8 else ""
        if title and self.draw.random() < 0.25:  # an article's own header
            title = self.element("header", 1, title + self.element("p", 1, self.words(9)) * (self.draw.random() < 0.5), self.draw.choice(("", "", "entry-header", "post-header", "article-header")))
        inside = some("share", "ad") if self.draw.random() < 0.4 else ""
        long = self.draw.random() < 0.8
        text = title + self.prose(1, self.draw.randint(1, 6) if long else 1) + inside + self.prose(1, self.draw.randint(0, 8) if long else 0)
        layout = self.draw.random()
        beside = lambda tag: self.element(tag, 0, self.draw.choice((self.other("nav"), self.other("aside"), self.element("ul", 0, "".join(self.element("li", 0, self.link(2)) for _ in range(5))), "".join(self.element("p", 0, self.link(2)) for _ in range(4)))), self.draw.choice(NEUTRAL_NAMES))
        if layout < 0.2 and self.draw.random() < 0.6:  # little beside links
            text = title * (self.draw.random() < 0.4) + self.prose(1, self.draw.randint(1, 4))
        if layout < 0.08:  # cells of a table
            cells = [beside("td"), self.element("td", 1, text, self.draw.choice(NEUTRAL_NAMES))]
            main = self.element("table", 0, self.element("tr", 0, "".join(cells if self.draw.random() < 0.7 else cells[::-1])))
        elif layout < 0.2:  # columns without telling names
            parts = [beside("div"), self.element("div", 1, text, self.draw.choice(NEUTRAL_NAMES))]
            main = self.element("div", 0, "".join(parts if self.draw.random() < 0.7 else parts[::-1]), self.draw.choice(NEUTRAL_NAMES))
        elif layout < 0.42:
            main = self.element("article", 1, text, self.draw.choice(("", "", "post", "story")))
        elif layout < 0.5:
            main = self.element("main", 1, self.element("article", 1, text) if self.draw.random() < 0.5 else text)
        elif layout < 0.9:
            main = self.element("div", 1, text, self.draw.choice(CONTENT_NAMES))
            if self.draw.random() < 0.3:
                main = self.element("section", 1, main)
        else:
            main = text
        if layout < 0.9 and self.draw.random() < 0.3:
            main = self.element("div", 0, main + some("aside", "comments"), self.draw.choice(("wrapper", "container", "row", "layout", "")))
        body = some("notice", "header", "nav", "ad", "nav", "form") + main + some("share", "comments", "aside", "ad", "form", "footer", "notice")
        head = f'<head {LABEL}="0"><title {LABEL}="0">{self.words(5, False)}</title><style>p{{}}</style><script>var t="<p>";</script></head>'
        if layout < 0.9 and self.draw.random() < 0.15:  # a fragment, maybe with nothing around
            return body if self.draw.random() < 0.5 else main
        end = "</body></html>" if self.draw.random() < 0.8 else ""
        return f'<!DOCTYPE html><html {LABEL}="0">{head}<body {LABEL}="{int(layout >= 0.9)}">{body}{end}'


def labelled_pages(n: int = 1000, seed: int = 11) -> list[str]:
    pages = _Pages(seed)
    return [pages.page() for _ in range(n)]
