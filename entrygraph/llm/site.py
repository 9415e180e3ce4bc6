"""Invented web pages with known main text, for fitting and testing the block labeller.

Pages differ in how they are built: by tags that say what they hold, by class
names, by neither; with unclosed tags, with asides and adverts inside the
article, with headlines in and before it. Words are made of syllables drawn
anew for each page, so that none of them gives an answer away; words that menus
and notices really use are mixed into these, and now and then into articles.
Each text ends with MAIN or REST, which readers take off again.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

MAIN, REST = "\ue000", "\ue001"

#: What such parts are called: (tags that say it, names of classes and ids).
PARTS = {
    "menu": (("nav",), "nav menu navbar navigation breadcrumb breadcrumbs topnav mainmenu tabs pager pagination toc"),
    "header": (("header",), "header masthead topbar siteheader branding logo brand hero"),
    "footer": (("footer",), "footer colophon bottom sitefooter copyright legal imprint"),
    "aside": (("aside",), "sidebar aside related widget rail recommended trending popular secondary more teaser"),
    "notice": (("div", "dialog"), "cookie cookies consent notice alert gdpr banner modal popup newsletter subscribe paywall message toast privacy"),
    "advert": (("div", "ins"), "ad ads advert advertisement sponsored sponsor promo promotion adslot adsense commercial banner"),
    "form": (("form",), "form login signup search register contact searchbox"),
    "comments": (("section", "div"), "comments comment commentlist replies discussion disqus responses reply thread"),
    "share": (("div",), "share social sharing follow buttons"),
}
ARTICLE = "content article post entry story body text main postbody entrycontent articlebody page single hentry"
NEUTRAL = "row col container wrap wrapper inner outer clearfix box block section grid left right center layout module item unit"
SAID = {
    "menu": "home about contact news products services blog help archive start über kontakt accueil inicio login sitemap",
    "header": "welcome to the home of search sign in skip",
    "footer": "copyright all rights reserved privacy policy terms impressum datenschutz mentions légales aviso powered by ©",
    "aside": "related more popular latest read also most viewed tags categories weitere lire aussi más",
    "notice": "we use cookies accept this site uses to improve subscribe newsletter agree consent settings wir verwenden nous utilisons",
    "advert": "buy now sale offer free shipping discount sponsored advertisement shop deal anzeige publicité oferta best price",
    "form": "name email password submit search subscribe send your message login remember me choose",
    "comments": "comment reply says wrote posted ago comments leave a like report antworten répondre responder",
    "share": "share facebook twitter email print tweet pin whatsapp linkedin",
}


class Site:
    """One page in the making."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        letters = ["".join(rng.sample("bcdfghjklmnpqrstvwz", 1)) + rng.choice("aeiouäöüéèó") for _ in range(rng.randint(8, 40))] + ["n", "s", "r", "t"]
        self.common = ["".join(rng.choices(letters, k=rng.randint(1, 2))) for _ in range(12)]
        self.letters = letters
        #: How much the markup says: tags and names, names only, or hardly anything.
        self.style = rng.choices(("tags", "names", "plain"), (6, 5, 1))[0]
        self.noise = rng.random() < 0.15

    def word(self) -> str:
        w = self.rng.choice(self.common) if self.rng.random() < 0.4 else "".join(self.rng.choices(self.letters, k=self.rng.randint(1, 5)))
        return w + self.rng.choice(("***", "%%%", "###", "$$$", "&amp;&amp;&amp;")) if self.noise and self.rng.random() < 0.8 else w

    def words(self, n: int, kind: str | None = None, share: float = 0.5) -> str:
        said = SAID[kind].split() if kind else []
        return " ".join([self.rng.choice(said) if said and self.rng.random() < share else self.word() for _ in range(n)])

    def sentence(self, kind: str | None = None, most: int = 22) -> str:
        s = self.words(self.rng.randint(1, most), kind, 0.35)
        return s[:1].upper() + s[1:] + self.rng.choice(("...", ".", ".", ".", "!", "?"))

    def prose(self, kind: str | None = None, most: int = 7) -> str:
        text = " ".join([self.sentence(kind) for _ in range(self.rng.randint(1, most))])
        if self.rng.random() < 0.08:
            text = text.rstrip(".!?")
        if self.rng.random() < 0.3:
            text = text.replace(" ", f' <a href="#">{self.word()}</a> ', 1)
        if self.rng.random() < 0.2:
            text = text.replace(" ", f" <em>{self.word()}</em> ", 1)
        return text

    def names(self, kind: str | None) -> str:
        """Attributes: what the part is called, among names that say nothing; or none."""
        rng, out = self.rng, []
        if kind and self.style != "plain":
            name = rng.choice((ARTICLE if kind == "article" else PARTS[kind][1]).split())
            out.append(rng.choice(("", "", "", "site-", "page-", "js-", "c-", "block_")) + name + rng.choice(("", "", "", "-wrapper", "-inner", "-box", "_list", "-area", "1", "2")))
        while rng.random() < 0.3:
            out.append(rng.choice(NEUTRAL.split()) if rng.random() < 0.7 else self.word().replace("&amp;", "")[:8].strip("*%#$"))
        rng.shuffle(out)
        return f' {rng.choice(("class", "class", "id"))}="{" ".join(out)}"' if out else ""

    def held(self, kind: str, inside: str) -> str:
        """``inside`` in a tag that says what it is, or in a plain one with names."""
        rng = self.rng
        tag = rng.choice(PARTS[kind][0]) if self.style == "tags" and rng.random() < 0.8 else "form" if kind == "form" else rng.choice(("div", "div", "section", "ul" if kind == "menu" else "div"))
        names = self.names(kind if self.style == "names" or rng.random() < 0.5 or tag in ("div", "section", "ins", "dialog", "ul") else None)
        out = f"<{tag}{names}>{inside}</{tag}>"
        return f"<div{self.names(None)}>{out}</div>" if rng.random() < 0.2 else out

    def links(self, kind: str, n: int, words: int = 3) -> str:
        label = lambda: f'<a href="/{self.word()}">{self.words(self.rng.randint(1, words), kind, self.rng.choice((0, 0.7)))}</a>{REST}'
        if self.rng.random() < 0.75:
            items = "".join([f"<li>{label()}</li>" for _ in range(n)])
            return f"<ul{self.names(None)}>{items}</ul>"
        return self.rng.choice((" | ", " ", "<br>")).join([label() for _ in range(n)])

    def rest(self, kind: str) -> str:
        """A part that is not of the article."""
        rng = self.rng
        p = lambda k=kind, most=3: f"<p>{self.prose(k, most)}{REST}</p>"
        head = lambda: f"<h{(n := rng.randint(2, 4))}>{self.words(rng.randint(1, 4), kind)}{REST}</h{n}>"
        bare = lambda most=2: f"{' '.join(self.sentence(kind if rng.random() < 0.5 else None) for _ in range(rng.randint(1, most)))}{REST}"
        if kind == "menu":
            inside = self.links(kind, rng.randint(2, 9), 2)
        elif kind == "header":
            inside = rng.choice((f"<h1>{self.words(2)}{REST}</h1>", f"<div>{self.words(2, kind)}{REST}</div>", f"<a href='/'>{self.words(2)}{REST}</a>")) + (p(kind, 1) if rng.random() < 0.5 else "") + (self.rest("menu") if rng.random() < 0.4 else "")
        elif kind == "footer":
            inside = rng.choice((bare(3), p(), self.links(kind, rng.randint(2, 6)) + p(), f"&copy; {self.word()}.example &middot; {bare()}"))
        elif kind == "aside":
            inside = head() + rng.choice((self.links(kind, rng.randint(2, 6), 9), p(), "".join([f"<div><h4>{self.words(4)}{REST}</h4>{p(None, 1)}</div>" for _ in range(rng.randint(1, 4))])))
        elif kind in ("notice", "advert"):
            inside = rng.choice((bare(3), p(), p() + f"<button>{self.words(1, kind)}{REST}</button>", head() + p(), f'<a href="#">{bare(1)}</a>'))
        elif kind == "form":
            fields = "".join([f"<label>{self.words(rng.randint(1, 3), kind, 0.8)}{REST}</label><input name='x'>" for _ in range(rng.randint(1, 4))])
            picks = f"<select>{''.join([f'<option>{self.words(1)}{REST}' for _ in range(rng.randint(2, 5))])}</select>" if rng.random() < 0.3 else ""
            inside = (head() if rng.random() < 0.4 else "") + (p(kind, 1) if rng.random() < 0.3 else "") + fields + picks + f"<button>{self.words(1, kind, 0.9)}{REST}</button>"
        elif kind == "share":
            inside = self.links(kind, rng.randint(2, 5), 2)
        else:
            one = lambda: f"<{(t := rng.choice(('div', 'li', 'article')))}{self.names('comments')}><{(c := rng.choice(('cite', 'h4', 'span', 'div')))}>{self.words(2, kind, 0.3)}{REST}</{c}>{''.join([p(None, 4) for _ in range(rng.randint(1, 3))])}{rng.choice(('', '<a href=#>reply' + REST + '</a>'))}</{t}>"  # noqa: E731, E501
            inside = head() + "".join([one() for _ in range(rng.randint(1, 5))]) + (self.rest("form") if rng.random() < 0.4 else "")
        return self.held(kind, inside)

    def piece(self) -> str:
        """A piece of the article."""
        rng = self.rng
        kind = rng.choices(("p", "broken", "h2", "ul", "quote", "pre", "table", "figure", "dl", "odd"), (24, 4, 3, 2, 1, 1, 1, 1, 1, 2))[0]
        said = rng.choice(list(SAID)) if rng.random() < (0.12 if self.style == "tags" else 0.06) else None
        if kind == "p":
            return f"<p{self.names(None) if rng.random() < 0.2 else ''}>{self.prose(said)}{MAIN}" + ("</p>" if rng.random() < 0.9 else "")
        if kind == "broken":
            return f"<p><b>{self.prose(said)}{MAIN}<br>"
        if kind == "h2":
            return f"<h{(n := rng.randint(2, 4))}>{self.words(rng.randint(1, 7))}{MAIN}</h{n}>"
        if kind in ("ul", "dl"):
            tag, item = ("ul", "li") if kind == "ul" else ("dl", "dd")
            return f"<{tag}>{''.join([f'<{item}>{self.prose(None, 1) if rng.random() < 0.6 else self.words(3)}{MAIN}</{item}>' for _ in range(rng.randint(2, 6))])}</{tag}>"
        if kind == "table":
            return f"<table>{''.join([f'<tr><td>{self.words(2)}{MAIN}</td><td>{rng.randint(1, 9999)}{MAIN}</td></tr>' for _ in range(rng.randint(2, 5))])}</table>"
        if kind == "odd":
            return f"<p>{rng.choice((self.word(), self.words(3), str(rng.randint(1, 99999)), self.word() + '@' + 'x.example', self.words(5, rng.choice(list(SAID)))))}{MAIN}</p>"
        tag = {"quote": "blockquote", "pre": "pre", "figure": "figcaption"}[kind]
        out = f"<{tag}>{self.prose(None, 3)}{MAIN}</{tag}>"
        return f"<figure>{out}</figure>" if kind == "figure" else out

    def article(self, title: str) -> str:
        rng = self.rng
        head = f"<h1>{title}{MAIN}</h1>"
        if rng.random() < 0.25:
            head = f"<header>{head}</header>" if self.style == "tags" else f"<div{self.names(None)}>{head}</div>"
        pieces = [self.piece() for _ in range(rng.randint(0, 18) if rng.random() < 0.85 else rng.randint(18, 50))]
        for kind in rng.choices(("advert", "share", "aside", "notice", "form"), k=rng.choice((0, 0, 0, 1, 2))):
            pieces.insert(rng.randint(0, len(pieces)), self.rest(kind))
        # an article may end, or begin, as a notice would
        if self.style == "tags" and rng.random() < 0.4:
            line = f"<p>{self.sentence(rng.choice(list(SAID)), 8)}{MAIN}</p>" if rng.random() < 0.4 else f"<p>{self.words(rng.randint(2, 6), rng.choice(list(SAID)), 0.95)}.{MAIN}</p>"
            pieces.insert(0 if rng.random() < 0.2 else len(pieces), line)
        if rng.random() < 0.12:
            pieces.append(self.rest("comments"))
        tag = rng.choice(("article", "article", "main")) if self.style == "tags" else rng.choice(("div", "div", "section", "td"))
        names = self.names("article" if self.style == "names" or rng.random() < 0.3 else None)
        before = rng.random() < 0.15
        body = f"<{tag}{names}>{'' if before else head}{''.join(pieces)}</{tag}>"
        if tag == "td":
            body = f"<table><tr>{body}</tr></table>"
        if self.style == "tags" and tag == "article" and rng.random() < 0.4:
            body = f"<main>{body}</main>"
        return (head if before else "") + body

    def page(self) -> str:
        rng = self.rng
        title = self.words(rng.randint(1, 10))
        title = title[:1].upper() + title[1:] + rng.choice(("", "", "."))
        above = [k for k, p in (("notice", 0.25), ("header", 0.4), ("menu", 0.85), ("advert", 0.5)) if rng.random() < p]
        below = [k for k, p in (("share", 0.2), ("advert", 0.25), ("aside", 0.45), ("comments", 0.35), ("form", 0.2), ("menu", 0.1), ("footer", 0.85), ("notice", 0.15)) if rng.random() < p]
        if rng.random() < 0.2 and "aside" in below:
            below.remove("aside")
            above.append("aside")
        body = "".join([self.rest(k) for k in above]) + self.article(title) + "".join([self.rest(k) for k in below])
        head = f"<head><meta charset=utf-8><title>{title}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        return f"<!DOCTYPE html><html>{head}<body{self.names(None)}>{body}" + ("</body></html>" if rng.random() < 0.9 else "")


def invented(n: int, seed: int) -> Iterator[str]:
    """``n`` pages, the same for a seed."""
    for k in range(n):
        yield Site(random.Random(f"{seed}/{k}")).page()
