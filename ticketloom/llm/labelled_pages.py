"""Labelled training pages: texts laid out by many site templates, with the truth in an attribute.

A template draws its page furniture (menus, headers, sidebars, notices, adverts, forms, comments,
footers) and the wrapping of its article at random, with or without telling tags and class names,
and with the slips of real markup. Texts come from pages of the corpus, so languages and lengths
are the corpus's own; furniture holds such texts too, so that prose alone does not tell an article.
"""

from __future__ import annotations

import random
from html import escape

MARK = "data-truth"

# Words of class names and ids, by what they stand for.
NAMES = {
    "article": "content article post entry story main-content post-body article-body entry-content story-text text body page-content",
    "menu": "nav menu navbar navigation main-menu breadcrumb breadcrumbs topnav pagination pager tabs links",
    "header": "header masthead site-header page-header top-bar logo branding banner-top",
    "footer": "footer site-footer page-footer bottom copyright legal colophon footer-links",
    "side": "sidebar side aside widget related related-posts recommended more-stories popular trending rail teaser tags",
    "notice": "cookie cookie-banner consent notice alert gdpr newsletter popup modal overlay subscribe message privacy-notice paywall",
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion ad-slot adbox banner outbrain",
    "form": "form search search-form login signup contact-form subscribe-form poll",
    "comment": "comments comment comment-list comment-body discussion replies responses disqus reader-comments comment-thread",
    "share": "share social share-buttons social-links toolbar actions byline meta post-meta author-box",
}
NAMES = {kind: words.split() for kind, words in NAMES.items()}
PLAIN = "wrap container row col inner box block section c1 x12 grid left right layout outer b2 u-mt".split()
TAGS = {
    "menu": ("nav", "div", "ul"), "header": ("header", "div"), "footer": ("footer", "div"), "side": ("aside", "div", "section"),
    "notice": ("div", "section", "aside", "dialog"), "advert": ("div", "aside", "ins-block"), "form": ("form", "div"),
    "comment": ("section", "div", "ol"), "share": ("div", "ul"),
}
PHRASES = {
    "menu": "Home|News|Sport|Contact|About us|Accueil|Kontakt|Inicio|Login|Menu|Next|Previous|1|2|3|Archive",
    "header": "Daily News|The Site|Skip to content|My account|Welcome",
    "footer": "© 2024 Example|All rights reserved.|Privacy policy|Terms of use|Impressum|Mentions légales|Powered by Example",
    "side": "Related articles|Most read|Popular|You may also like|Tags|Recent posts",
    "notice": "We use cookies to improve this site.|Accept|Subscribe to our newsletter|Sign in to continue reading|Nous utilisons des cookies.",
    "advert": "Advertisement|Sponsored|Buy now|Anzeige|Publicité|Offer ends soon!|Save 50% today",
    "form": "Search|Your e-mail|Send|Name|Password|Submit|Choose",
    "comment": "Leave a reply|3 comments|Anonymous wrote|Reply|Great post!|I do not agree.|Posted by guest at 10:45",
    "share": "Share|Tweet|Print|By John Smith|12 May 2023|E-mail",
}
PHRASES = {kind: texts.split("|") for kind, texts in PHRASES.items()}


class _Page:
    def __init__(self, seed: str, texts: list[str]) -> None:
        self.draw = random.Random(seed)
        self.texts = texts or ["A text of some words, as pages have them.", "Another one"]
        self.named = self.draw.random() < 0.85  # this site's class names tell what things are
        self.tagged = self.draw.random() < 0.6 or not self.named  # its tags do

    def chance(self, p: float) -> bool:
        return self.draw.random() < p

    def prose(self) -> str:
        text = self.draw.choice(self.texts)
        if self.chance(0.2):
            words = text.split()
            text = " ".join(words[: self.draw.randint(1, 6)])
        return escape(text, quote=self.chance(0.5))

    def line(self, kind: str) -> str:
        return self.prose() if self.chance(0.4) else escape(self.draw.choice(PHRASES[kind]))

    def element(self, tag: str, kind: str | None, inside: str, truth: int | None = None) -> str:
        attributes = ""
        if kind and self.named:
            words = [self.draw.choice(NAMES[kind])] + ([self.draw.choice(PLAIN)] if self.chance(0.3) else [])
            attributes = f' {self.draw.choice(("class", "class", "id"))}="{" ".join(words)}"'
        elif self.chance(0.4):
            attributes = f' class="{self.draw.choice(PLAIN)}"'
        if truth is not None:
            attributes += f' {MARK}="{truth}"'
        return f"<{tag}{attributes}>{inside}</{tag}>"

    def link(self, text: str) -> str:
        return f'<a href="/{self.draw.randint(1, 999)}">{text}</a>'

    def furniture(self, kind: str) -> str:
        tag = TAGS[kind][0] if self.tagged else self.draw.choice(TAGS[kind][1:])
        tag = "div" if tag == "ins-block" else tag
        n = self.draw.randint(1, 7)
        if kind in ("menu", "share") or kind in ("side", "footer") and self.chance(0.5):
            items = "".join(f"<li>{self.link(self.line(kind))}" + ("</li>" if self.chance(0.8) else "") for _ in range(n))
            inside = items if tag == "ul" else f"<ul>{items}</ul>" if self.chance(0.7) else " ".join(
                self.link(self.line(kind)) for _ in range(n))
        elif kind == "form":
            inside = f"<label>{self.line(kind)}</label><input type='text'><button>{self.line(kind)}</button>"
            if self.chance(0.4):
                inside += "<select>" + "".join(f"<option>{self.line(kind)}" for _ in range(n)) + "</select>"
            if self.chance(0.3):
                inside += f"<p>{self.line(kind)}</p><textarea>{self.line(kind)}</textarea>"
        elif kind == "comment":
            item = "li" if tag == "ol" else "div"
            inside = "" if tag == "ol" else f"<h3>{self.line(kind)}</h3>"
            for _ in range(n):
                inside += self.element(item, kind if self.chance(0.7) else None, "".join(
                    f"<p>{self.line(kind)}</p>" for _ in range(self.draw.randint(1, 3))))
        else:
            wrap = self.draw.choice(("", "p", "div", "span", "h4"))
            lines = [self.line(kind) for _ in range(self.draw.randint(1, 3))]
            inside = "".join(f"<{wrap}>{x}</{wrap}>" if wrap else x + " " for x in lines)
            if self.chance(0.2):
                inside = f"<p>{inside}</p>" if not wrap else inside
        return self.element(tag, kind, inside, 0)

    def paragraph(self) -> str:
        text = self.prose()
        if self.chance(0.2):
            first, _, rest = text.partition(" ")
            text = f"{self.draw.choice(('<b>', '<em>', '<strong>', '<b>'))}{first}{'' if self.chance(0.3) else '</b>'} {rest}"
        if self.chance(0.1):
            text += " " + self.link(self.draw.choice(self.texts)[:20].replace("<", "").replace("&", ""))
        if self.chance(0.1):
            text += "<br>"
        shape = self.draw.random()
        if shape < 0.7:
            return f"<p>{text}" + ("</p>" if self.chance(0.85) else "\n")
        if shape < 0.8:
            return f"<h2>{text}</h2>"
        if shape < 0.88:
            return f"<ul><li>{text}<li>{self.prose()}</ul>"
        return f"<{(t := self.draw.choice(('blockquote', 'div', 'pre', 'h3')))}>{text}</{t}>"

    def article(self) -> str:
        title = f"<h1>{self.prose()}</h1>" if self.chance(0.8) else ""
        if title and self.chance(0.2):
            title = f"<header>{title}</header>" if self.tagged else f"<div>{title}</div>"
        parts = [self.paragraph() for _ in range(self.draw.choice((1, 2, 3, 5, 8, 12, 20)))]
        for kind in ("advert", "side", "share", "form", "comment", "notice", "menu"):
            if self.chance(0.12):
                parts.insert(self.draw.randint(0, len(parts)), self.furniture(kind))
        tag = self.draw.choice(("article", "article", "main")) if self.tagged else self.draw.choice(("div", "section", "td"))
        inner = title + "".join(parts)
        if self.chance(0.3):
            inner = self.element("div", "article" if self.chance(0.5) else None, inner)
        out = self.element(tag, "article" if self.chance(0.7) or not self.tagged else None, inner, 1)
        return f"<table><tr>{out}</tr></table>" if tag == "td" else out

    def whole(self) -> str:
        before = [k for k in ("header", "menu", "notice", "advert", "form", "side") if self.chance(0.45)]
        after = [k for k in ("side", "share", "comment", "advert", "menu", "notice", "form", "footer") if self.chance(0.45)]
        self.draw.shuffle(before)
        parts = [*map(self.furniture, before), self.article(), *map(self.furniture, after)]
        if self.chance(0.05):
            parts = [*map(self.furniture, before + after)]  # a page without an article
        body = "".join(parts)
        for _ in range(self.draw.randint(0, 3)):
            body = self.element("div", None, body)
        body += '<script>var a = "</p>";</script>' if self.chance(0.5) else ""
        head = f"<head><title>{self.prose()}</title><style>p{{margin:0}}</style></head>"
        return f"<!DOCTYPE html><html>{head}<body>{body}" + ("</body></html>" if self.chance(0.8) else "")


def labelled_page(seed: str, texts: list[str]) -> str:
    """A page of `texts` in which the attribute MARK is 1 on an article and 0 on what is none."""
    return _Page(seed, texts).whole()
