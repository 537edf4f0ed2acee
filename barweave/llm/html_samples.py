"""Labelled pages for training: layouts of many kinds around texts taken from real pages."""

from __future__ import annotations

import html
import random

#: What stands around articles, by its usual names; the generator mixes elements and names.
BOILER = {
    "nav": ("nav", "menu", "navbar main-nav", "site-nav", "breadcrumb", "pagination"),
    "header": ("header", "site-header", "masthead", "page-head top"),
    "footer": ("footer", "site-footer", "foot copyright", "bottom footer-links"),
    "aside": ("sidebar", "widget", "related", "right sidebar", "recommended teaser", "toc"),
    "ad": ("ad", "advert", "sponsored", "promo banner", "ads-box", "advertisement"),
    "notice": ("cookie-notice", "consent", "alert notice", "gdpr popup", "newsletter-popup"),
    "form": ("newsletter", "search", "login-form", "subscribe", "comment-form", "feedback"),
    "comments": ("comments", "comment-list", "discussion", "replies", "user-comments"),
    "share": ("share", "social", "sharing tools", "tags", "meta byline"),
}
MAIN = ("content", "post", "entry-content", "article-body", "story", "main", "post-text", "page")


#: Stands before every text that belongs to the article (a private-use code point).
KEPT = "\ue000"


class Maker:
    """Makes one page at a time, with the article's texts marked."""

    def __init__(self, texts: list[str], seed: int):
        self.texts = texts or ["Some words of a text. And more words, of course."]
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        words = self.rng.choice(self.texts).split() or ["word"]
        size = self.rng.randint(low, high)
        start = self.rng.randrange(max(1, len(words) - size + 1))
        return " ".join(words[start : start + size])

    def attribute(self, names: tuple[str, ...]) -> str:
        kind = self.rng.random()
        if kind < 0.15:
            return ""
        return f' {"id" if kind < 0.3 else "class"}="{self.rng.choice(names)}"'

    def links(self) -> str:
        count = self.rng.randint(2, 8)
        items = [f'<a href="/x">{html.escape(self.words(1, 3))}</a>' for _ in range(count)]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items)

    def short(self) -> str:
        text = html.escape(self.words(2, 25))
        kind = self.rng.choice(("{}", "<p>{}</p>", "<span>{}</span>", "<div>{}</div>"))
        return kind.replace("{}", text)

    def boiler(self, kind: str) -> str:
        rng, attribute = self.rng, self.attribute(BOILER[kind])
        own = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside"}
        tag = own.get(kind, "form" if kind == "form" else "section")
        if kind not in ("form",) and (rng.random() < 0.5 or kind in ("ad", "notice", "share")):
            tag = "div"
            attribute = attribute or f' class="{rng.choice(BOILER[kind])}"'
        if kind in ("nav", "share"):
            inner = self.links()
        elif kind == "form":
            inner = f'<label>{html.escape(self.words(1, 4))}</label><input name="q">{self.short()}'
        elif kind == "comments":
            name = rng.choice(("comment", "reply", "user-comment"))
            one = rng.choice(("div", "li", "article"))
            inner = f"<h3>{html.escape(self.words(1, 3))}</h3>" * rng.randint(0, 1) + "".join(
                f'<{one} class="{name}"><p>{html.escape(self.words(4, 60))}</p></{one}>'
                for _ in range(rng.randint(1, 5))
            )
        elif kind == "header":
            inner = f"<h1>{html.escape(self.words(1, 3))}</h1>" * rng.randint(0, 1) + self.short()
        else:
            inner = "".join(self.short() for _ in range(rng.randint(1, 3)))
            if rng.random() < 0.4:
                inner += self.links()
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def block(self) -> str:
        """One block of the article."""
        rng = self.rng
        text = self.words(1, 160) if rng.random() < 0.7 else self.words(1, 8)
        safe = KEPT + html.escape(text)
        kind = rng.random()
        if kind < 0.6:
            return f"<p>{safe}</p>" if rng.random() < 0.8 else f"<p><b>{safe}<br>"
        if kind < 0.7:
            return f"<h{rng.randint(2, 4)}>{safe}</h{rng.randint(2, 4)}>"
        if kind < 0.78:
            return f"<blockquote><p>{safe}</p></blockquote>"
        if kind < 0.86:
            return f"<ul><li>{safe}</li></ul>"
        if kind < 0.92:
            return f"<table><tr><td>{safe}</td></tr></table>"
        return f"<div>{safe}</div>" if rng.random() < 0.7 else f"<section><p>{safe}</p></section>"

    def page(self) -> str:
        rng = self.rng
        body = []
        if rng.random() < 0.8:
            body.append(f"<h1>{KEPT}{html.escape(self.words(2, 12))}</h1>")
        for _ in range(rng.choice((1, 1, 2, 4, 8, 14, 30))):
            body.append(self.block())
            if rng.random() < 0.12:
                body.append(self.boiler(rng.choice(("ad", "share", "aside", "form"))))
        inner = "".join(body)
        kind = rng.random()
        if kind < 0.45:
            main = f"<article{self.attribute(MAIN) if rng.random() < 0.5 else ''}>{inner}</article>"
        elif kind < 0.6:
            main = f"<main>{inner}</main>"
        else:
            main = f"<div{self.attribute(MAIN)}>{inner}</div>"
        if rng.random() < 0.3:
            main = f"<div{self.attribute(('wrapper', 'container', 'row', 'page'))}>{main}</div>"
        before = [k for k in ("notice", "header", "nav", "ad") if rng.random() < 0.55]
        around = ("share", "comments", "aside", "form", "ad", "footer")
        after = [k for k in around if rng.random() < 0.45]
        if rng.random() < 0.2:
            before.append("aside")
        if rng.random() < 0.2:
            rng.shuffle(before)
        parts = [*(self.boiler(k) for k in before), main, *(self.boiler(k) for k in after)]
        end = "</body></html>" if rng.random() < 0.9 else ""
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{''.join(parts)}{end}"
