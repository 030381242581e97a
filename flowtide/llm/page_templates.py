"""Random pages around given text, for training a block labeller: articles in many layouts, with everything that is no article.

The paragraphs of the article carry a mark, so the labels of a rendered page follow from parsing it.
"""

from __future__ import annotations

import random
from html import escape
from typing import NamedTuple

MARK = ""
#: Usual names of classes and ids, by role.
NAMES = {
    "article": "content post entry article story body main text blog page-content post-content entry-content article-body main-content "
    "post-body story-body richtext prose news-text single-post",
    "header": "header masthead site-header topbar branding logo page-header hero site-title top header-wrap",
    "menu": "nav menu navbar navigation main-nav breadcrumb breadcrumbs pagination pager skip-links tabs toc submenu menubar dropdown",
    "notice": "notice cookie cookie-notice cookies consent gdpr alert popup modal overlay paywall announcement disclaimer toast warning "
    "banner privacy message info-bar",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsense commercial ad-slot banner-ad promoted partner",
    "sidebar": "sidebar side aside widget widget-area related related-posts recommended trending popular most-read rail secondary "
    "complementary tags archive social share sharing author-box more-stories teaser",
    "form": "form newsletter subscribe signup login search contact search-form register subscription survey poll",
    "comments": "comments comment-list comment discussion responses replies reply disqus feedback reader-comments comment-body thread reviews",
    "footer": "footer site-footer colophon copyright bottom legal credits imprint foot page-footer bottom-bar",
    "neutral": "wrapper container page site row col inner layout grid box block section area wrap outer panel column center clearfix",
}
_NAMES = {role: names.split() for role, names in NAMES.items()}
_TAGS = {
    "article": ["article", "main"], "header": ["header"], "menu": ["nav"], "notice": ["aside", "dialog"], "advert": ["aside"], "sidebar": ["aside"],
    "form": ["form"], "comments": ["section"], "footer": ["footer"], "neutral": ["section"],
}
_PHRASES = {
    "menu": "Home|About|About us|Contact|News|Blog|Products|Services|Login|Sign in|Help|FAQ|Archive|Shop|Next|Previous|Back to top|Skip to content",
    "notice": "We use cookies to improve your experience.|This site uses cookies.|Accept all|Please enable JavaScript to view this page.|"
    "By using this site you agree to our privacy policy.|Scheduled maintenance tonight.|You have read all your free articles.|Reject",
    "advert": "Advertisement|Sponsored|Buy now and save 50%!|Limited offer, order today.|Promoted content|Click here for a free trial.|Ad",
    "sidebar": "Related articles|You may also like|Popular posts|Recent posts|Share this|Tags|Follow us|Read more|Trending now|Categories",
    "form": "Subscribe to our newsletter|Email address|Your name|Search|Submit|Sign up|Password|Remember me|Leave a reply|Choose a country",
    "comments": "Comments|3 comments|Reply|Leave a comment|Log in to reply|Report|Discussion|Like|Show more comments|Responses",
    "footer": "All rights reserved.|Privacy policy|Terms of use|Imprint|Powered by our team|Contact us|© 2024|Copyright 2023|Sitemap",
    "header": "Daily News|My Site|The place for everything|Latest updates|Welcome",
}
_PHRASES = {role: words.split("|") for role, words in _PHRASES.items()}


class Material(NamedTuple):
    """Text to make pages of."""

    title: str
    paragraphs: list[str]


class Page:
    """One random page; ``pick`` decides everything."""

    def __init__(self, pick: random.Random, article: Material, others: list[Material]):
        self.pick, self.article, self.others = pick, article, others

    def chance(self, p: float) -> bool:
        return self.pick.random() < p

    def _attribute(self, role: str) -> str:
        name = self.pick.choice(_NAMES[role])
        form = self.pick.randrange(6)
        if form == 0:
            name = f"{self.pick.choice(_NAMES['neutral'])} {name}"
        elif form == 1:
            name = f"{name}-{self.pick.choice(['1', 'main', 'wrap', 'inner', 'top', 'x'])}"
        elif form == 2:
            name = f"{self._noise()} {name}"
        quote = self.pick.choice(['"', '"', "'"])
        return f" {self.pick.choice(['class', 'class', 'id'])}={quote}{name}{quote}"

    def _noise(self) -> str:
        return "".join(self.pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(self.pick.randrange(2, 7)))

    def box(self, role: str, inside: str, plain: float = 0.0) -> str:
        """``inside`` in an element that shows its role by tag, by name or by both; with chance ``plain`` by neither."""
        if self.chance(plain):
            return f"<div>{inside}</div>"
        tag, attribute = "div", ""
        told = self.chance(0.5)
        if told:
            tag = self.pick.choice(_TAGS[role])
        else:
            tag = self.pick.choice(["div", "div", "div", "section", "td" if role != "form" else "div"])
        if not told or tag in ("aside", "section", "dialog") or self.chance(0.5):
            attribute = self._attribute(role)
        made = f"<{tag}{attribute}>{inside}</{tag}>"
        return f"<table><tr>{made}</tr></table>" if tag == "td" else made

    def phrase(self, role: str) -> str:
        return escape(self.pick.choice(_PHRASES[role]))

    def prose(self, longest: int = 40) -> str:
        """Part of some other paragraph: boilerplate may read like an article."""
        words = self.pick.choice(self.pick.choice(self.others).paragraphs).split()
        at = self.pick.randrange(len(words))
        return escape(" ".join(words[at : at + self.pick.randrange(1, longest)]), quote=False)

    def short(self) -> str:
        return self.prose(5)

    def link(self, text: str) -> str:
        return f'<a href="/{self._noise()}">{text}</a>'

    def links(self, role: str = "menu") -> str:
        items = [self.link(self.phrase(role) if self.chance(0.4) else self.short()) for _ in range(self.pick.randrange(2, 8))]
        if self.chance(0.7):
            kind = self.pick.choice(["ul", "ul", "ol"])
            return f"<{kind}>" + "".join(f"<li>{i}</li>" if self.chance(0.9) else f"<li>{i}" for i in items) + f"</{kind}>"
        return self.pick.choice([" ", " | ", "<br>"]).join(items)

    def menu(self) -> str:
        return self.box("menu", self.links())

    def header(self) -> str:
        name = self.phrase("header") if self.chance(0.5) else self.short()
        tag = self.pick.choice(["h1", "h2", "div", "p", "span"])
        inside = f"<{tag}>{self.link(name) if self.chance(0.5) else name}</{tag}>"
        if self.chance(0.3):
            inside += f"<p>{self.phrase('header') if self.chance(0.5) else self.prose(10)}</p>"
        return self.box("header", inside + (self.menu() if self.chance(0.4) else ""))

    def notice(self) -> str:
        text = self.phrase("notice") if self.chance(0.5) else self.prose()
        tag = self.pick.choice(["p", "div", "span"])
        return self.box("notice", f"<{tag}>{text}</{tag}>" + (f"<button>{self.phrase('notice')}</button>" if self.chance(0.4) else ""))

    def advert(self) -> str:
        parts = [self.phrase("advert")] if self.chance(0.3) else []
        parts += [self.prose() for _ in range(self.pick.randrange(1, 3))]
        tag = self.pick.choice(["p", "div", ""])
        return self.box("advert", "".join(f"<{tag}>{p}</{tag}>" if tag else p for p in parts[: 1 if not tag else 3]))

    def sidebar(self) -> str:
        parts = []
        for _ in range(self.pick.randrange(1, 4)):
            head = self.phrase("sidebar") if self.chance(0.5) else self.short()
            tag = self.pick.choice(["h2", "h3", "h4", "div", "strong"])
            parts.append(f"<{tag}>{head}</{tag}>")
            parts.append(self.links("sidebar") if self.chance(0.6) else f"<p>{self.prose()}</p>")
        return self.box("sidebar", "".join(parts))

    def form(self) -> str:
        parts = [f"<p>{self.prose(15)}</p>"] if self.chance(0.4) else []
        for _ in range(self.pick.randrange(1, 4)):
            parts.append(self.pick.choice([
                f"<label>{self.phrase('form')}</label><input name=q value='{self._noise()}'>", f"<button>{self.phrase('form')}</button>",
                f"<select><option>{self.short()}<option>{self.short()}</select>", f"<textarea>{self.short()}</textarea>",
                f"<legend>{self.phrase('form')}</legend>",
            ]))
        return self.box("form", "<form>" + "".join(parts) + "</form>" if self.chance(0.5) else "".join(parts))

    def comments(self) -> str:
        made = []
        for _ in range(self.pick.randrange(1, 6)):
            author = f"<{'b' if self.chance(0.5) else 'div'}>{self.short()}</{'b' if self.chance(0.5) else 'div'}>" if self.chance(0.7) else ""
            body = "".join(f"<p>{self.prose(60)}</p>" for _ in range(self.pick.randrange(1, 3)))
            item = author + body + (self.link(self.phrase("comments")) if self.chance(0.4) else "")
            tag = self.pick.choice(["li", "div", "article", "div"])
            name = self._attribute("comments") if self.chance(0.5) else ""
            made.append(f"<{tag}{name}>{item}</{tag}>")
        head = f"<h3>{self.phrase('comments')}</h3>" if self.chance(0.6) else ""
        inside = "".join(made)
        inside = f"<ol>{inside}</ol>" if "<li" in inside else inside
        return self.box("comments", head + inside + (self.form() if self.chance(0.3) else ""))

    def footer(self) -> str:
        parts = [f"<p>{self.phrase('footer')}</p>" if self.chance(0.5) else f"&copy; {self.short()} &middot; {self.prose(15)}"]
        if self.chance(0.4):
            parts.append(self.links("footer"))
        self.pick.shuffle(parts)
        return self.box("footer", "".join(parts))

    def _marked(self, text: str) -> str:
        out = escape(text, quote=self.chance(0.3))
        words = out.split(" ")
        if len(words) > 3 and self.chance(0.3):
            at = self.pick.randrange(len(words) - 1)
            tag = self.pick.choice(["b", "i", "em", "strong", "a href='/x'", "span", "code"])
            words[at] = f"<{tag}>{words[at]}</{tag.split()[0]}>"
        if len(words) > 6 and self.chance(0.1):
            words.insert(self.pick.randrange(len(words)), "<br>")
        return MARK + " ".join(words)

    def _paragraphs(self) -> str:
        out = []
        stray = self.pick.choice([0.0, 0.0, 0.08, 0.2])
        style = self.pick.choice(["p", "p", "p", "p", "div", "open"])
        left = list(self.article.paragraphs)
        while left:
            if self.chance(0.06) and len(left) > 2:
                n = self.pick.randrange(2, min(len(left), 5) + 1)
                kind, item = self.pick.choice([("ul", "li"), ("ol", "li"), ("table", "td"), ("dl", "dd"), ("blockquote", "p")])
                inside = "".join(("<tr>" if item == "td" else "") + f"<{item}>{self._marked(p)}</{item}>" for p in left[:n])
                out.append(f"<{kind}>{inside}</{kind}>")
                left = left[n:]
            else:
                text = self._marked(left.pop(0))
                tag = self.pick.choice(["h2", "h3", "blockquote", "pre", "figcaption"]) if self.chance(0.06) else style
                out.append(f"<p>{text}" if tag == "open" else f"<{tag}>{text}</{tag}>")
            if self.chance(stray):
                out.append(self.pick.choice([self.advert, self.sidebar, self.form, self.notice, self.menu])())
        return "".join(out)

    def main(self) -> str:
        title = ""
        if self.article.title and self.chance(0.8):
            title = f"<{'h1' if self.chance(0.8) else 'h2'}>{self._marked(self.article.title)}"
            title += "</h1>" if title.startswith("<h1") else "</h2>"
        body = self._paragraphs()
        if self.chance(0.25):
            body = self.box("article", body)
        inside = title + body
        if self.chance(0.15):
            inside += self.pick.choice([self.comments, self.sidebar, self.form])()
        return self.box("article", inside, plain=0.08)

    def html(self) -> str:
        p = self.pick
        before = [f() for f, share in ((self.header, 0.6), (self.menu, 0.6), (self.notice, 0.35), (self.advert, 0.4), (self.form, 0.15)) if self.chance(share)]
        after = [f() for f, share in ((self.comments, 0.5), (self.sidebar, 0.4), (self.advert, 0.25), (self.form, 0.2), (self.notice, 0.15)) if self.chance(share)]
        p.shuffle(before)
        p.shuffle(after)
        early = [self.sidebar()] if self.chance(0.2) else []
        middle = "".join([*early, self.main(), *after])
        for _ in range(p.randrange(3)):
            middle = f"<div{self._attribute('neutral') if self.chance(0.7) else ''}>{middle}</div>"
        end = [self.footer()] if self.chance(0.85) else []
        late = self.notice() if self.chance(0.15) else ""
        title = escape(self.article.title)
        return (
            f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"
            + "".join([*before, middle, *end, late])
            + ("</body></html>" if self.chance(0.8) else "")
        )
