"""Made pages with known main text, from which the extractor's trees learn.

A page is put together at random, from a seed: sections in many styles of markup (named elements, named attributes, neither),
texts of made words. Every part says by `data-truth` whether it is main text (1), not (0) or holds both (m).
"""

from __future__ import annotations

import random

# Syllables of made words, and attribute names that sections of web pages go by.
_SYLLABLES = "an be co de en er fo ga he in la le mi no on or pa re sa st te ti um ver wa za ç é ü ñ".split()
_NAMES = {
    "main": "article content main post entry post-content article-body story entry-content page-content text body-text".split(),
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs main-menu toc topnav pagination".split(),
    "header": "header masthead site-header top-bar branding logo page-header".split(),
    "footer": "footer site-footer copyright colophon bottom legal".split(),
    "side": "sidebar side aside widget related recommended rail secondary most-read".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo banner-ad adsbox ad-slot".split(),
    "notice": "notice cookie cookie-notice consent gdpr alert popup modal newsletter-box paywall".split(),
    "comments": "comments comment-list disqus responses discussion reader-comments replies".split(),
    "form": "form search login signup subscribe contact-form search-form".split(),
    "share": "share social share-buttons social-links follow".split(),
}
_TAGS = {"main": "article main div section", "nav": "nav div ul", "header": "header div", "footer": "footer div", "side": "aside div section", "ad": "div aside", "notice": "div section aside", "comments": "section div ol", "form": "form div", "share": "div ul"}


class _Maker:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        self.named = self.r.random() < 0.5  # sections are named elements
        self.short = self.r.random() < 0.35  # the main text is a few words

    def words(self, least: int, most: int) -> str:
        r = self.r
        out = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(least, most))]
        for k in range(len(out)):
            if r.random() < 0.12:
                out[k] += r.choice([",", ".", ".", ";", "?", "&amp;", "***", "%%%"])
        return " ".join(out).capitalize() + r.choice([".", ".", ".", "", "!"])

    def link(self, least: int = 1, most: int = 4) -> str:
        return f'<a href="/{self.r.randint(0, 999)}">{self.words(least, most)}</a>'

    def wrap(self, kind: str, inner: str, truth: str, named: float = 0.9) -> str:
        r = self.r
        tag = r.choice(_TAGS[kind].split()[: 1 if self.named else None])
        says = tag in ("article", "main", "nav", "header", "footer", "aside", "form")
        attrs = ""
        if r.random() < (named if not says else 0.4):
            attrs = f' {r.choice(["class", "class", "id", "role"])}="{r.choice(_NAMES[kind])}"'
        elif r.random() < 0.3:
            attrs = f' class="{r.choice(["row", "col", "c1", "box", "wrap", "container", "x9"])}"'
        return f'<{tag}{attrs} data-truth="{truth}">{inner}</{tag}>'

    def paragraph(self) -> str:
        r = self.r
        size = r.choice([(1, 3), (2, 10)] if self.short else [(1, 3), (2, 10), (10, 40), (30, 90), (60, 250)])
        text = self.words(*size)
        if r.random() < 0.15:
            text += " " + self.link() + " " + self.words(1, 12)
        kind = r.random()
        if kind < 0.12:
            return f"<p><b>{text}<br>"
        if kind < 0.2:
            return f"<p>{text}"
        if kind < 0.24:
            return f"<blockquote>{text}</blockquote>"
        if kind < 0.28:
            return "<ul>" + "".join(f"<li>{self.words(2, 25)}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
        if kind < 0.31:
            return f"<div>{text}</div>"
        if kind < 0.33:
            return f"<pre>{text}</pre>"
        if kind < 0.35:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 6)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        return f"<p>{text}</p>"

    def links(self) -> str:
        r = self.r
        n = r.randint(2, 12)
        if r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(n)) + "</ul>"
        return " | ".join(self.link() for _ in range(n))

    def aside(self, kind: str) -> str:
        r = self.r
        text = lambda: f"<p>{self.words(3, 30)}</p>" if r.random() < 0.5 else self.words(2, 30)
        if kind == "nav":
            inner = self.links()
        elif kind == "header":
            inner = (f"<h1>{self.words(1, 4)}</h1>" if r.random() < 0.3 else f"<div>{self.words(1, 5)}</div>") + (self.links() if r.random() < 0.6 else "")
        elif kind == "footer":
            inner = "&copy; " + self.words(1, 8) + (text() if r.random() < 0.4 else "") + (self.links() if r.random() < 0.4 else "") + " &middot; " + self.words(1, 25)
        elif kind == "side":
            inner = f"<h3>{self.words(1, 4)}</h3>" + (self.links() if r.random() < 0.6 else "".join(text() for _ in range(r.randint(1, 4))))
        elif kind == "comments":
            name, body = r.choice(["li", "div", "article"]), lambda: "".join(f"<p>{self.words(2, 60)}</p>" for _ in range(r.randint(1, 3)))
            inner = (f"<h3>{self.words(1, 3)}</h3>" if r.random() < 0.7 else "") + "".join(f'<{name} class="comment"><b>{self.words(1, 2)}</b>{body()}</{name}>' for _ in range(r.randint(1, 8)))
        elif kind == "form":
            inner = "".join(f"<label>{self.words(1, 3)}</label><input name=x>" for _ in range(r.randint(1, 4))) + f"<p>{self.words(2, 12)}</p><select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select><button>{self.words(1, 2)}</button>"
        elif kind == "share":
            inner = self.links()
        else:
            inner = text() + (f"<button>{self.words(1, 2)}</button>" if kind == "notice" and r.random() < 0.5 else "")
        return self.wrap(kind, inner, "0", 0.7 if kind in ("nav", "footer", "share") else 1.0)

    def page(self) -> str:
        r = self.r
        head = f"<h1>{self.words(2, 14)}</h1>"
        if r.random() < 0.15:
            head = f'<header data-truth="1">{head}</header>'
        parts = [head] if r.random() < 0.9 else []
        for _ in range(r.choice([1, 1, 2, 3] if self.short else [1, 2, 4, 8, 16, 30])):
            parts.append(self.paragraph() if r.random() < 0.93 else f"<h2>{self.words(1, 8)}</h2>")
        mixed = False
        for kind in ("ad", "share", "form", "notice", "side", "comments"):
            if r.random() < 0.1:
                mixed = True
                parts.insert(len(parts) if kind == "comments" else r.randint(0, len(parts)), self.aside(kind))
        inner = "".join(p if "data-truth" in p else p.replace(">", ' data-truth="1">', 1) for p in parts)
        if r.random() < 0.3:
            inner = f'<div class="{r.choice(["inner", "content", "body", "text", "w"])}" data-truth="{"m" if mixed else "1"}">{inner}</div>'
        main = self.wrap("main", inner, "m" if mixed else "1", 0.8)
        before = [self.aside(k) for k in ("header", "nav", "notice", "ad", "form", "side") if r.random() < 0.4]
        after = [self.aside(k) for k in ("share", "side", "ad", "comments", "form", "nav", "notice", "footer") if r.random() < 0.4]
        r.shuffle(before)
        body = "".join(before) + main + "".join(after)
        if r.random() < 0.4:
            body = f'<div class="{r.choice(["page", "wrapper", "container", "site", "root"])}" data-truth="m">{body}</div>'
        return f'<html data-truth="m"><head><title>{self.words(1, 5)}</title><script>var t="</p>";</script></head><body data-truth="m">{body}</body></html>'


def made(n: int, seed: int = 1) -> list[str]:
    return [_Maker(seed * 1_000_003 + k).page() for k in range(n)]
