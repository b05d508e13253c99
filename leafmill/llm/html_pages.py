"""Labelled training pages: random articles in random page furniture, with the article's blocks known."""

from __future__ import annotations

import random

#: Names that pages give to their parts (fixed vocabulary; each is tried as class and as id, alone and with others).
NAMES = {
    "menu": ("nav", "navbar", "navigation", "menu", "main-menu", "breadcrumb", "breadcrumbs", "tabs", "pagination", "pager", "toc", "skip-links"),
    "header": ("header", "site-header", "masthead", "topbar", "banner", "logo", "branding", "page-header"),
    "footer": ("footer", "site-footer", "copyright", "legal", "bottom", "colophon", "imprint"),
    "side": ("sidebar", "side", "aside", "widget", "related", "recommended", "popular", "trending", "rail", "more-stories", "tags", "archive"),
    "notice": ("cookie", "cookies", "cookie-banner", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "warning", "message", "toast"),
    "ad": ("ad", "ads", "advert", "advertisement", "adsense", "sponsored", "sponsor", "promo", "promotion", "banner-ad", "ad-slot", "dfp", "affiliate"),
    "form": ("form", "newsletter", "subscribe", "signup", "search", "search-form", "login", "contact-form", "poll"),
    "comment": ("comments", "comment", "comment-list", "comment-body", "respond", "replies", "reply", "disqus", "discussion", "reader-comments", "user-comments"),
    "share": ("share", "social", "sharing", "follow", "like-buttons", "meta-links"),
}
ARTICLE = ("content", "article", "post", "entry", "entry-content", "post-content", "article-body", "story", "story-body", "main", "main-content", "text", "body", "page-content")
SYLLABLES = "an ber co de en fa gil ha is jo ka lu mer no or pe qui ra st tion ung ve wo xa yl zu é ö ñ ß 中 и".split()


class Maker:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        self.kept: list[str] = []

    def words(self, low: int, high: int, stops: bool = True) -> str:
        r, out = self.r, []
        for i in range(r.randint(low, high)):
            w = "".join(r.choices(SYLLABLES, k=r.randint(1, 4)))
            out.append(w.capitalize() if i == 0 or r.random() < 0.05 else w)
            if stops and r.random() < 0.08:
                out[-1] += r.choice(".,;")
        return " ".join(out) + ("." if stops and r.random() < 0.9 else "")

    def named(self, tag: str, kind: str, inner: str) -> str:
        r = self.r
        name = r.choice(NAMES[kind])
        name = r.choice([name, name, f"{name} {r.choice(['box', 'wrap', 'inner', 'block', 'row'])}", f"site-{name}", f"{name}-wrapper", name.replace("-", "_")])
        return f'<{tag} {r.choice(["class", "class", "id"])}="{name}">{inner}</{tag}>'

    def links(self, low: int = 2, high: int = 8) -> str:
        items = [f'<a href="/{i}">{self.words(1, 3, False)}</a>' for i in range(self.r.randint(low, high))]
        return f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>" if self.r.random() < 0.7 else self.r.choice([" | ", " ", " &middot; "]).join(items)

    def noise(self, kind: str) -> str:
        r = self.r
        tag = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form", "comment": "section"}.get(kind, "div")
        if kind in ("menu", "share"):
            inner = self.links()
        elif kind == "form":
            inner = f"<label>{self.words(1, 3, False)}</label><input type=text><select><option>{self.words(1, 2, False)}</option></select><button>{self.words(1, 2, False)}</button>" + (f"<p>{self.words(4, 15)}</p>" if r.random() < 0.5 else "")
        elif kind == "comment":
            inner = f"<h3>{self.words(1, 3, False)}</h3>" + "".join(r.choice(["<div><b>{}</b><p>{}</p></div>", "<li><span>{}</span> <p>{}</p></li>", "<p>{}: {}</p>"]).format(self.words(1, 2, False), self.words(5, 60)) for _ in range(r.randint(1, 5)))
        elif kind == "footer":
            inner = r.choice(["&copy; ", "Copyright ", ""]) + self.words(3, 14) + (self.links(1, 4) if r.random() < 0.5 else "")
        elif kind == "side":
            inner = f"<h3>{self.words(1, 3, False)}</h3>" + (self.links() if r.random() < 0.6 else f"<p>{self.words(5, 40)}</p>")
        elif kind == "header":
            inner = f"<h1>{self.words(1, 4, False)}</h1>" * (r.random() < 0.4) + f"<p>{self.words(2, 8, False)}</p>" * (r.random() < 0.5) + f"<div>{self.words(1, 3, False)}</div>"
        else:
            inner = r.choice(["<p>{}</p>", "{}", "<div><p>{}</p></div>", '<a href="/x">{}</a>']).format(self.words(3, 50))
        if tag != "div" and r.random() < 0.4:
            return f"<{tag}>{inner}</{tag}>"
        return self.named(tag if r.random() < 0.4 else "div", kind, inner)

    def keep(self, low: int, high: int, stops: bool = True) -> str:
        t = self.words(low, high, stops)
        self.kept.append(t)
        return t

    def block(self) -> str:
        r, x = self.r, self.r.random()
        if x < 0.62:
            return f"<p>{self.keep(1, 120 if r.random() < 0.9 else 400)}" + "</p>" * (r.random() < 0.9)
        if x < 0.72:
            h = r.choice(["h2", "h3", "h4"])
            return f"<{h}>{self.keep(1, 9, False)}</{h}>"
        if x < 0.78:
            return "<ul>" + "".join(f"<li>{self.keep(2, 25)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if x < 0.82:
            return f"<blockquote><p>{self.keep(5, 40)}</p></blockquote>"
        if x < 0.85:
            return "<table>" + "".join(f"<tr><td>{self.keep(1, 4, False)}</td><td>{self.keep(1, 6, False)}</td></tr>" for _ in range(r.randint(1, 3))) + "</table>"
        if x < 0.88:
            return f"<figure><img src=x><figcaption>{self.keep(3, 15)}</figcaption></figure>"
        if x < 0.91:
            return f"<pre>{self.keep(3, 20, False)}</pre>"
        if x < 0.94:
            return f"<div>{self.keep(5, 80)}</div>"
        return f"<p><b>{self.keep(1, 40)}<br>"  # never closed

    def page(self) -> tuple[str, list[str]]:
        """html, and its article's block texts."""
        r = self.r
        self.kept = []
        title = self.keep(1, 14, r.random() < 0.5)
        body = [r.choice(["<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>", '<h1 class="title">{}</h1>']).format(title)] if r.random() < 0.85 else []
        if not body:
            self.kept = []
        for _ in range(r.choice([1, 2, 3, 5, 8, 14])):
            body.append(self.block())
            if r.random() < 0.08:
                body.append(self.noise(r.choice(["ad", "side", "share", "form", "notice", "menu"])))
        if r.random() < 0.15:
            body.append(self.noise("comment"))
        inner, x = "".join(body), r.random()
        if x < 0.5:
            inner = f"<article>{inner}</article>" if r.random() < 0.7 else f'<article class="{r.choice(ARTICLE)}">{inner}</article>'
        elif x < 0.7:
            inner = f"<main>{inner}</main>"
        elif x < 0.92:
            inner = f'<div {r.choice(["class", "id"])}="{r.choice(ARTICLE)}">{inner}</div>'
        if r.random() < 0.2:
            inner = f"<main>{inner}</main>"
        before = [self.noise(k) for k in r.sample(["menu", "header", "notice", "ad", "form", "side"], r.randint(0, 4))]
        after = [self.noise(k) for k in r.sample(["comment", "side", "ad", "footer", "share", "form", "notice"], r.randint(0, 5))]
        head = f"<head><title>{r.choice([title, self.words(2, 8, False)])}</title><style>p{{}}</style><script>var a='<p>';</script></head>"
        return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}<!-- note -->{inner}{''.join(after)}</body></html>", list(self.kept)
