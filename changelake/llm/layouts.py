"""Generated pages with known main texts, from which the HTML classifier is fitted.

A page is dealt from the habits that pages have: where the article stands (article, main, div, table cell or bare body), how its parts are
marked, and what stands before, beside, inside and behind it (menus, headers, notices, adverts, share bars, teasers, forms, comments, footers).
Words are made of random syllables, so that nothing is learned about any language.
"""

from __future__ import annotations

import random

_SYLLABLES = "an ar be ca de el en er est fi ga ha in is ka la le ma mi na no on or pa qu ra re sa sch se st ta te ti tu un ve za ö é ня".split()


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.content = rng, []

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.rng.choice(_SYLLABLES) for _ in range(self.rng.randint(1, 4))) for _ in range(self.rng.randint(low, high)))

    def prose(self, low: int, high: int) -> str:
        text = self.words(low, high)
        return text[0].upper() + text[1:] + self.rng.choice("....!?:")

    def keep(self, text: str) -> str:
        self.content.append(text)
        return text

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{i}">{self.words(1, 4)}</a></li>' for i in range(n))

    def teaser(self) -> str:
        return f"<p>{self.prose(8, 30)}</p>"

    def menu(self) -> str:
        own = self.rng.choice((f"<p>{self.words(1, 6)}</p>", f"<h3>{self.words(1, 3)}</h3>", "", "")) + f"<ul>{self.links(self.rng.randint(3, 9))}</ul>"
        return self.rng.choice((f"<nav>{own}</nav>", f'<div class="main-menu">{own}</div>', f'<div id="navbar">{own}</div>', f'<div role="navigation">{own}</div>', f"<menu>{own}</menu>", f"<ul>{self.links(5)}</ul>"))

    def header(self) -> str:
        return self.rng.choice((f"<header><a href=/>{self.words(1, 3)}</a><p>{self.words(3, 8)}</p></header>", f"<header><h1>{self.words(1, 3)}</h1></header>", f'<div class="site-header"><span>{self.words(2, 5)}</span></div>', ""))

    def notice(self) -> str:
        text = self.prose(10, 30)
        return self.rng.choice((f'<div class="cookie-notice"><p>{text}</p><button>OK</button></div>', f'<div id="gdpr-banner">{text} <a href=/p>{self.words(1, 2)}</a></div>', f"<dialog><p>{text}</p></dialog>", f"<div hidden><p>{text}</p></div>", f'<p style="display:none">{text}</p>', f'<div aria-hidden="true">{text}</div>', f'<a class="skip-link" href=#c>{self.words(2, 4)}</a>', ""))

    def advert(self) -> str:
        text = self.prose(5, 25)
        return self.rng.choice((f'<div class="ad">{text}</div>', f'<aside>{text}</aside>', f'<div class="sponsored-box"><a href=/x>{text}</a></div>', f'<div id="promo"><p>{text}</p></div>', f'<div class="ad-container"><p>{text}</p></div>'))

    def share(self) -> str:
        return self.rng.choice((f'<div class="share-bar"><a href=#>{self.words(1, 2)}</a> <a href=#>{self.words(1, 2)}</a></div>', f'<ul class="social">{self.links(3)}</ul>', f'<div class="tags"><a href=#>{self.words(1, 1)}</a>, <a href=#>{self.words(1, 1)}</a></div>'))

    def related(self) -> str:
        return self.rng.choice((f'<div class="related-posts"><h3>{self.words(1, 3)}</h3><ul>{self.links(4)}</ul></div>', f'<section class="recommended">{self.teaser()}{self.teaser()}</section>', f"<ul>{self.links(4)}</ul>"))

    def form(self) -> str:
        return self.rng.choice((f"<form><label>{self.words(1, 2)}</label><input><p>{self.words(3, 12)}</p></form>", f'<div class="newsletter"><p>{self.prose(6, 16)}</p><form><input></form></div>', f'<form role="search"><input><label>{self.words(1, 2)}</label></form>', f"<fieldset><legend>{self.words(1, 3)}</legend><label>{self.words(1, 4)}</label></fieldset>"))

    def comments(self) -> str:
        own = "".join(self.rng.choice(("<div class=comment><p>{}</p></div>", "<li class=comment-item>{}</li>", '<div class="reply"><b>' + self.words(1, 2) + "</b> {}</div>")).format(self.prose(6, 60)) for _ in range(self.rng.randint(1, 5)))
        return self.rng.choice((f'<section class="comments"><h2>{self.words(1, 2)}</h2>{own}</section>', f'<div id="comments">{own}</div>', f"<ol class=comment-list>{own}</ol>"))

    def sidebar(self) -> str:
        own = self.teaser() + f"<ul>{self.links(5)}</ul>" + self.advert()
        return self.rng.choice((f"<aside>{own}</aside>", f'<div id="sidebar">{own}</div>', f'<div class="widget-area">{own}</div>', f'<div role="complementary">{own}</div>'))

    def footer(self) -> str:
        text = f"© {self.words(2, 6)} · {self.words(0, 10)}" if self.rng.random() < 0.5 else f"© {self.rng.randint(1990, 2030)} {self.words(1, 4)}. All rights reserved."
        return self.rng.choice((f"<footer>{text}</footer>", f'<div id="footer"><p>{text}</p><a href=/i>{self.words(1, 2)}</a></div>', f"<footer><p>{self.prose(8, 24)}</p><p>{text}</p></footer>", f'<div class="copyright">{text}</div>', f"<p>{text}</p>", f"<div>{text}</div>", f"<p>{self.words(1, 6)}</p>", f"<address>{self.words(3, 9)}</address><footer>{text}</footer>"))

    def part(self) -> str:
        """A block of the main text, or a few."""
        kind = self.rng.random()
        if kind < 0.08:
            one, two, three = self.prose(3, 30), self.words(1, 4), self.words(1, 30)
            self.keep(f"{one} {two} {three}")
            return self.rng.choice(("<p>{}</p>", "<ul><li>{}</li></ul>")).format(f"{one} <a href=/x>{two}</a> {three}")
        if kind < 0.2:
            text = self.rng.choice((self.prose(1, 3), self.prose(1, 3), self.words(1, 2), "All rights reserved.", f"{self.prose(1, 6)} Subscribe."))
            return f"<p>{self.keep(text)}</p>"
        if kind < 0.6:
            return self.rng.choice(("<p>{}</p>", "<p>{}", "<div>{}</div>")).format(self.keep(self.prose(8, 90)))
        if kind < 0.68:
            name = self.rng.choice(("lead", "intro", "social-story", "text"))
            return f'<p class="{name}">{self.keep(self.prose(1, 40))}</p>'
        if kind < 0.78:
            rank = self.rng.randint(2, 4)
            return f"<h{rank}>{self.keep(self.words(1, 8))}</h{rank}>"
        if kind < 0.85:
            return "<ul>" + "".join(f"<li>{self.keep(self.words(2, 14))}</li>" for _ in range(self.rng.randint(2, 5))) + "</ul>"
        if kind < 0.9:
            return f"<blockquote><p>{self.keep(self.prose(6, 40))}</p></blockquote>"
        if kind < 0.94:
            return f"<pre>{self.keep(self.words(3, 20))}</pre>"
        if kind < 0.97:
            return f"<figure><img src=x><figcaption>{self.keep(self.words(3, 12))}</figcaption></figure>"
        return "<table><tr>" + "".join(f"<td>{self.keep(self.words(1, 4))}</td>" for _ in range(3)) + "</tr></table>"

    def article(self) -> str:
        title = f"<h1>{self.keep(self.words(2, 12))}</h1>"
        headed = self.rng.random() < 0.3
        if headed:
            title = f"<header>{title}" + (f"<p>{self.keep(self.prose(4, 30))}</p>" if self.rng.random() < 0.5 else "") + "</header>"
        own = [title, *(self.part() for _ in range(self.rng.randint(1, 9)))]
        for extra in (self.advert, self.share, self.related, self.form):
            if self.rng.random() < 0.3:
                own.insert(self.rng.randint(1, len(own)), extra())
        body = "".join(own)
        inner = self.rng.choice(("{}", '<div class="entry-content">{}</div>', "<section>{}</section>", '<div class="post-body">{}</div>')).format(body)
        if self.rng.random() < 0.25:
            inner += self.comments()
        if headed:
            return self.rng.choice(("<article>{}</article>", "<main><article>{}</article></main>", '<div class="post">{}</div>')).format(inner)
        return self.rng.choice(("<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div id="content">{}</div>', '<div class="post">{}</div>', '<div class="article-main">{}</div>', "<table><tr><td>{}</td></tr></table>", "{}", "<div><div>{}</div></div>")).format(inner)

    def html(self) -> str:
        before = [x for x in (self.header(), self.menu(), self.notice(), self.advert() if self.rng.random() < 0.4 else "") if x]
        self.rng.shuffle(before)
        behind = [x for x in (self.sidebar() if self.rng.random() < 0.5 else "", self.related() if self.rng.random() < 0.3 else "", self.comments() if self.rng.random() < 0.3 else "") if x]
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body>{''.join(before)}{self.article()}{''.join(behind)}{self.footer()}</body></html>"


def pages(n: int, seed: int) -> list[tuple[str, list[str]]]:
    """(html, blocks of the main text in page order)."""
    out = []
    for i in range(n):
        page = _Page(random.Random(seed * 1_000_003 + i))
        out.append((page.html(), page.content))
    return out
