"""Labelled web pages from a small grammar: the training set of ``extraction``.

There are no labelled pages in the corpus, so the classifier learns from pages whose parts
are known.  A page is a shell of main column, menus, notices, adverts, forms, sidebars and
reader comments in random order, with semantic tags, telling names, meaningless names or
none, and with the unclosed tags that pages have.  Texts are invented words, so nothing of
a language is learned.  Roots of parts that are not main text carry ``data-gold="0"``.
"""

from __future__ import annotations

import random

SYLLABLES = "a e i o u an en in on un ar er or st th tion ment ble ing ly ch sch é ü ñ ión aux eau ti re de la 中 文 ни ка".split()


class Writer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.style = self.rng.choice(["tags", "names", "both", "both", "opaque"])
        self.marks = self.rng.random() < 0.8  # sentences have marks
        self.noise = self.rng.choice(["", "", "", "***", "%%%", " &amp;", "&quot;"])
        self.close = self.rng.random() < 0.7  # paragraphs are closed

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() + (self.noise if self.rng.random() < 0.3 else "") for _ in range(self.rng.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            s = self.words(2, 22).capitalize()
            out.append(s + (self.rng.choice([".", ".", ".", "!", "?"]) if self.marks else ""))
        return " ".join(out)

    def attributes(self, names: str, always: bool = False) -> str:
        """Names of an element in this page's style."""
        if self.style == "opaque" and not always:
            return f' class="css-{self.rng.randrange(1 << 20):x}"' if self.rng.random() < 0.6 else ""
        if self.style == "tags" and not always:
            return ""
        name = self.rng.choice(names.split())
        name = self.rng.choice([name, name, f"{name}-{self.rng.choice(['box', 'wrap', 'inner', 'area', '1', 'block'])}", f"js-{name}", name.upper()])
        return f' {self.rng.choice(["class", "class", "id"])}="{name}"'

    def box(self, tag: str, names: str, inner: str, gold: bool = True) -> str:
        """A part as its semantic tag or as a div with telling names, by the page's style."""
        mark = "" if gold else ' data-gold="0"'
        if self.style == "names" or (self.style == "both" and self.rng.random() < 0.4):
            return f"<div{self.attributes(names, True)}{mark}>{inner}</div>"
        return f"<{tag}{self.attributes(names)}{mark}>{inner}</{tag}>"

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.word()}">{self.words(low, high)}</a>'

    def links(self, low: int, high: int, lo_words: int = 1, hi_words: int = 4) -> str:
        n = self.rng.randint(low, high)
        if self.rng.random() < 0.8:
            tag = self.rng.choice(["ul", "ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.link(lo_words, hi_words)}</li>" for _ in range(n)) + f"</{tag}>"
        return self.rng.choice([" | ", " &middot; ", " "]).join(self.link(lo_words, hi_words) for _ in range(n))

    def inline(self, text: str) -> str:
        if self.rng.random() > 0.35:
            return text
        w = text.split(" ")
        i = self.rng.randrange(len(w))
        j = min(len(w), i + self.rng.randint(1, 4))
        tag, extra = self.rng.choice([("b", ""), ("em", ""), ("a", ' href="/x"'), ("a", ' class="link" href="/y"'), ("code", ""), ("span", ' class="term"'), ("i", ""), ("strong", "")])
        return " ".join([*w[:i], f"<{tag}{extra}>" + " ".join(w[i:j]) + f"</{tag}>", *w[j:]])

    def paragraph(self) -> str:
        r = self.rng.random()
        size = (1, 1) if r < 0.25 else (1, 3) if r < 0.6 else (2, 9)
        text = self.inline(self.sentences(*size) if r > 0.05 else self.words(1, 3).capitalize() + ".")
        if self.rng.random() < 0.12:
            return f"<p><b>{text}<br>"
        return f"<p{self.attributes('paragraph text lead') if self.rng.random() < 0.1 else ''}>{text}" + ("</p>" if self.close else "")

    def block(self) -> str:
        r = self.rng.random()
        if r < 0.74:
            return self.paragraph()
        if r < 0.80:
            return f"<h{(k := self.rng.randint(2, 4))}>{self.words(1, 7).capitalize()}</h{k}>"
        if r < 0.86:
            return "<ul>" + "".join(f"<li>{self.inline(self.sentences(1, 2))}</li>" for _ in range(self.rng.randint(2, 6))) + "</ul>"
        if r < 0.89:
            return f"<blockquote>{self.paragraph()}</blockquote>"
        if r < 0.91:
            return f"<figure><img src=x><figcaption>{self.sentences(1, 1)}</figcaption></figure>"
        if r < 0.93:
            row = lambda: "<tr>" + "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(3)) + "</tr>"
            return "<table>" + "".join(row() for _ in range(self.rng.randint(2, 5))) + "</table>"
        if r < 0.95:
            return f"<pre>{self.words(3, 20)}</pre>"
        if r < 0.97:
            return f"<div>{self.sentences(1, 4)}</div>"
        return f"{self.sentences(1, 2)}<hr>"

    # parts that are not main text
    def advert(self) -> str:
        inner = self.rng.choice([self.sentences(1, 4), f"<p>{self.sentences(1, 3)}</p>", f"<a href=/buy>{self.sentences(1, 2)}</a>", f"<span>{self.words(1, 2)}</span> {self.sentences(1, 2)}"])
        if self.rng.random() < 0.25:
            return f'<aside{self.attributes("ad promo sponsored", True)} data-gold="0">{inner}</aside>'
        return f'<div{self.attributes("ad ads advert advertisement sponsored promo banner ad-slot adsense", True)} data-gold="0">{inner}</div>'

    def notice(self) -> str:
        inner = f"<p>{self.sentences(1, 3)}</p>" if self.rng.random() < 0.6 else self.sentences(1, 3)
        inner += self.rng.choice(["", "<button>ok</button>", self.link()])
        tag = self.rng.choice(["div", "div", "section", "aside"])
        return f'<{tag}{self.attributes("cookie cookie-notice consent gdpr-banner notice alert popup modal privacy message", True)} data-gold="0">{inner}</{tag}>'

    def form(self) -> str:
        fields = "".join(f'<label>{self.words(1, 3)}</label><input name="{self.word()}">' for _ in range(self.rng.randint(1, 4)))
        text = self.rng.choice(["", f"<p>{self.sentences(1, 2)}</p>", f"<h3>{self.words(1, 4)}</h3>"])
        return f'<form{self.attributes("search login signup subscribe newsletter contact")} data-gold="0">{text}{fields}<button>{self.word()}</button></form>'

    def menu(self) -> str:
        return self.box("nav", "nav navbar menu main-menu navigation breadcrumbs pagination toc", self.links(2, 14), False)

    def header(self) -> str:
        inner = f'<div class="logo">{self.words(1, 3)}</div>' if self.rng.random() < 0.5 else self.rng.choice(["", f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(2, 8)}</p>"])
        inner += self.rng.choice(["", self.menu(), self.form()])
        return self.box("header", "header masthead topbar site-header page-header", inner or self.words(1, 4), False)

    def footer(self) -> str:
        inner = "&copy; " + self.words(1, 3) + " &middot; " + self.rng.choice([self.sentences(1, 3), self.links(2, 8), self.words(1, 6)])
        if self.rng.random() < 0.4:
            inner = self.links(3, 12) + f"<p>{inner}</p>"
        return self.box("footer", "footer site-footer bottom copyright legal colophon", inner, False)

    def teaser(self) -> str:
        return f'<div><h3>{self.link(3, 9)}</h3><p>{self.sentences(1, 2)}</p></div>'

    def sidebar(self) -> str:
        parts = [self.rng.choice([lambda: f"<h3>{self.words(1, 3)}</h3>" + self.links(3, 8, 2, 8), lambda: f"<p>{self.sentences(1, 3)}</p>", self.teaser, self.form, self.advert])() for _ in range(self.rng.randint(1, 4))]
        return self.box("aside", "sidebar side-bar widget rail related right-column", "".join(parts), False)

    def related(self) -> str:
        inner = f"<h3>{self.words(1, 3)}</h3>" + self.rng.choice([self.links(3, 8, 3, 10), "".join(self.teaser() for _ in range(self.rng.randint(2, 5)))])
        tag = self.rng.choice(["section", "div", "aside"])
        return f'<{tag}{self.attributes("related recommended more-stories trending also-read popular", True)} data-gold="0">{inner}</{tag}>'

    def comments(self) -> str:
        one = lambda: f'<{(t := self.rng.choice(["div", "li", "article"]))} class="{self.rng.choice(["comment", "reply", "comment-item", "c"])}"><b>{self.words(1, 2)}</b><p>{self.sentences(1, 5)}</p></{t}>'
        inner = f"<h3>{self.words(1, 2)}</h3>" + "".join(one() for _ in range(self.rng.randint(1, 15))) + self.rng.choice(["", self.form()])
        tag = self.rng.choice(["section", "div", "ol"])
        return f'<{tag}{self.attributes("comments comment-list discussion replies disqus_thread reader-comments respond", True)} data-gold="0">{inner}</{tag}>'

    def share(self) -> str:
        return f'<div{self.attributes("share social share-tools follow", True)} data-gold="0">{self.links(2, 5, 1, 1)}</div>'

    def article(self) -> str:
        r = self.rng
        head = f"<h1>{self.words(1, 9).capitalize()}</h1>" if r.random() < 0.9 else ""
        if head and r.random() < 0.1:
            head = f"<header>{head}<p>{self.words(2, 6)}</p></header>"
        if r.random() < 0.2:
            head += f'<p{self.attributes("byline author meta date")}>{self.words(1, 5)}</p>'
        body = [self.block() for _ in range(r.choice([0, 1, 1, 2, 3, 4, 5, 8, 12, 20, 30, 45]))]
        for part, share in ((self.advert, 0.25), (self.share, 0.12), (self.related, 0.1), (self.form, 0.08), (self.notice, 0.04), (self.menu, 0.05)):
            if r.random() < share:
                body.insert(r.randint(0, len(body)), part())
        inner = "".join(body)
        if r.random() < 0.3:
            inner = f'<div{self.attributes("body text content article-body entry-content", True)}>{inner}</div>'
        if r.random() < 0.12:
            inner += self.comments()
        how = r.random()
        if how < 0.55:
            return f'<article{self.attributes("article post story entry")}>{head}{inner}</article>'
        if how < 0.7:
            return f"<main>{head}{inner}</main>"
        if how < 0.95:
            return f'<{(t := r.choice(["div", "div", "section"]))}{self.attributes("article content post story entry main main-content post-body", True)}>{head}{inner}</{t}>'
        return head + inner

    def page(self) -> str:
        r = self.rng
        before = [p() for p, share in ((self.header, 0.5), (self.menu, 0.7), (self.notice, 0.25), (self.advert, 0.45), (self.form, 0.1), (self.sidebar, 0.15)) if r.random() < share]
        after = [p() for p, share in ((self.sidebar, 0.4), (self.related, 0.3), (self.comments, 0.35), (self.share, 0.1), (self.advert, 0.25), (self.form, 0.15), (self.notice, 0.15), (self.menu, 0.2)) if r.random() < share]
        r.shuffle(before)
        r.shuffle(after)
        core = self.article()
        if r.random() < 0.3:
            cut = r.randint(0, len(after))
            core = f'<div{self.attributes("main container content wrapper column page")}>{core}{"".join(after[:cut])}</div>'
            after = after[cut:]
        body = "".join([*before, core, *after]) + (self.footer() if r.random() < 0.85 else "")
        if r.random() < 0.3:
            body = f'<div{self.attributes("page wrapper container site")}>{body}</div>'
        gap = r.choice(["", "", "\n"])
        head = f"<!DOCTYPE html>{gap}<html><head><title>{self.words(1, 5)}</title><script>var t='<p>'</script></head>"
        return head + gap + f"<body>{gap}{body.replace('><', '>' + gap + '<') if gap else body}" + ("</body></html>" if r.random() < 0.8 else "")


def pages(n: int, seed: int) -> list[str]:
    return [Writer(seed * 1_000_003 + i).page() for i in range(n)]
