"""Labelled web page layouts that content models are trained on.

Common layouts of articles and of what surrounds them, written from lists of tags, names and invented words by a seeded
generator: ``data-main`` marks what is content. Own labelled pages may be given to the training instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from random import Random

PAGES, SEED = 700, 13

# Names that layouts give to their parts.
MENU = (
    "nav navbar menu main-menu top-nav navigation site-navigation breadcrumb breadcrumbs toolbar pagination pager tabs submenu "
    "mega-menu links quick-links skip-links toc table-of-contents language-switcher user-menu"
).split()
HEADER = "header site-header masthead top-bar page-header branding logo topbar global-header banner hero-header".split()
FOOTER = "footer site-footer bottom colophon copyright legal site-info foot page-footer imprint credits".split()
SIDEBAR = (
    "sidebar side-bar widget widget-area secondary right-column left-column related related-posts recommended popular trending "
    "most-read archives tag-cloud more-stories teaser promo-box read-next author-box rail complementary"
).split()
NOTICE = (
    "cookie-notice cookie-banner cookies consent gdpr notice alert site-notice announcement modal popup overlay paywall "
    "privacy-notice message-bar toast warning-banner dialog disclaimer"
).split()
ADVERT = (
    "ad ads advert advertisement sponsored sponsor ad-slot ad-container banner-ad adsense promo promoted partner-content "
    "commercial native-ad ad-wrapper marketing"
).split()
FORM = "search search-form login newsletter subscribe signup contact-form comment-form register mailing-list donate".split()
COMMENTS = (
    "comments comment-list comment-section replies user-comments discussion responses reader-comments respond disqus-thread "
    "feedback talkback comment-thread reviews"
).split()
SHARE = "share social share-buttons social-links sharing follow-us like-box share-bar".split()
CONTENT = (
    "content post entry-content article-body story main-content page-content post-body entry blog-post article-text story-body "
    "body-text article post-content main text single-post news-article"
).split()
WRAPPER = "container wrapper page outer row layout site grid inner wrap column".split()

SYLLABLES = "an be cor da en fi gar hu in jo ka lem mo nor ol pra qui ro sta tur un vel wi xa yor zu é ö ing er ion".split()


class Writer:
    def __init__(self, random: Random):
        self.random = random

    def one(self, names: list | tuple):
        return self.random.choice(names)

    def pick(self, *parts: Callable[[], str]) -> str:
        return self.random.choice(parts)()

    def maybe(self, chance: float, part: Callable[[], str]) -> str:
        return part() if self.random.random() < chance else ""

    def some(self, low: int, high: int, part: Callable[[], str]) -> str:
        return "".join(part() for _ in range(self.random.randint(low, high)))

    def word(self) -> str:
        return "".join(self.one(SYLLABLES) for _ in range(self.random.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.random.randint(low, high))).capitalize()

    def sentence(self) -> str:
        text = self.words(3, 14)
        return (text.replace(" ", ", ", 1) if self.random.random() < 0.3 else text) + self.one("...!?.")

    def prose(self) -> str:
        if self.random.random() < 0.1:
            return self.one((self.word().capitalize() + ".", self.words(60, 300), f"{self.word()} " * 40))
        return " ".join(self.sentence() for _ in range(self.one((1, 1, 2, 4, 8, 25))))

    def named(self, names: list, main: int) -> str:
        """Attributes: a class or id by one of the names, sometimes none or a further one, and the label."""
        name, style = self.one(names), self.random.random()
        if style < (0.25 if main else 0.05):
            attrs = ""
        elif style < 0.45:
            attrs = f' id="{name}"'
        elif style < 0.6:
            attrs = f' class="{self.word()} {name}" id="x{self.random.randint(1, 99)}"'
        else:
            attrs = f' class="{name}"'
        return f'{attrs} data-main="{main}"'

    # what surrounds the content
    def link(self) -> str:
        return f'<a href="/{self.word()}">{self.words(1, 4)}</a>'

    def link_list(self) -> str:
        return "<ul>" + self.some(2, 9, lambda: f"<li>{self.link()}</li>") + "</ul>"

    def menu(self) -> str:
        tag = self.one(("nav", "nav", "div", "ul"))
        if tag == "ul":
            return f"<ul{self.named(MENU, 0)}>" + self.some(3, 8, lambda: f"<li>{self.link()}</li>") + "</ul>"
        inside = self.link_list() if self.random.random() < 0.7 else self.some(2, 7, lambda: self.link() + self.one((" | ", " ", " &gt; ")))
        return f"<{tag}{self.named(MENU, 0)}>{inside}</{tag}>"

    def header(self) -> str:
        tag = self.one(("header", "div"))
        title = self.one(("h1", "div", "p", "h2"))
        return (
            f"<{tag}{self.named(HEADER, 0)}><{title}>{self.words(1, 4)}</{title}>"
            + self.maybe(0.5, lambda: f"<p>{self.sentence()}</p>")
            + self.maybe(0.6, self.menu)
            + self.maybe(0.3, self.form)
            + f"</{tag}>"
        )

    def footer(self) -> str:
        tag = self.one(("footer", "footer", "div"))
        lead = self.one(("&copy; ", "Copyright ", ""))
        text = lead + self.words(2, 5) + self.one((" &middot; ", ". ", " ")) + self.sentence()
        inside = self.one((text, f"<p>{text}</p>")) if self.random.random() < 0.6 else self.link_list() + f"<p>{text}</p>"
        return f"<{tag}{self.named(FOOTER, 0)}>{inside}</{tag}>"

    def sidebar(self) -> str:
        tag = self.one(("aside", "aside", "div", "section"))
        inside = self.pick(
            self.link_list,
            lambda: f"<p>{self.prose()}</p>" + self.link_list(),
            lambda: self.some(1, 4, lambda: f"<div><h4>{self.link()}</h4><p>{self.sentence()}</p></div>"),
            lambda: f"<p>{self.prose()}</p>",
            lambda: f"<p>{self.prose()}</p>",
            self.prose,
            lambda: self.some(1, 2, self.teaser),
        )
        return f"<{tag}{self.named(SIDEBAR, 0)}>" + self.maybe(0.8, lambda: f"<h3>{self.words(1, 3)}</h3>") + inside + f"</{tag}>"

    def teaser(self) -> str:
        return f'<article class="teaser" data-main="0"><h3>{self.link()}</h3><p>{self.sentence()}</p></article>'

    def notice(self) -> str:
        tag = self.one(("div", "div", "section", "p", "aside"))
        if tag == "p":
            return f"<p{self.named(NOTICE, 0)}>{self.prose()} {self.link()}</p>"
        role = self.one(("", ' role="alert"', ' role="dialog"', ' role="status"'))
        return f"<{tag}{role}{self.named(NOTICE, 0)}><p>{self.prose()} {self.link()}</p><button>{self.words(1, 2)}</button></{tag}>"

    def advert(self) -> str:
        tag = self.one(("div", "div", "aside", "section", "ins", "p"))
        inside = self.prose() if tag == "p" else self.pick(
            self.prose, self.prose, self.link, lambda: f"<p>{self.prose()}</p>", lambda: f"<span>{self.words(1, 2)}</span> {self.link()}"
        )
        return f"<{tag}{self.named(ADVERT, 0)}>{inside}</{tag}>"

    def form(self) -> str:
        inside = self.pick(
            lambda: f"<label>{self.words(1, 3)}</label><input type=text>",
            lambda: f"<p>{self.prose()}</p><input type=email><button>{self.words(1, 2)}</button>",
            lambda: f"<fieldset><legend>{self.words(1, 3)}</legend><div>{self.sentence()}<input name=q></div></fieldset>",
            lambda: f"<h3>{self.words(2, 4)}</h3>{self.sentence()} <input> <textarea></textarea>",
        )
        return f"<form{self.named(FORM, 0)}>{inside}</form>"

    def comment(self) -> str:
        return self.pick(
            lambda: f"<li><b>{self.words(1, 2)}</b><p>{self.prose()}</p></li>",
            lambda: f'<div class="comment"><span class="author">{self.words(1, 2)}</span><p>{self.prose()}</p><p>{self.prose()}</p></div>',
            lambda: f'<article class="comment"><footer>{self.words(1, 2)}</footer><div><p>{self.prose()}</p></div></article>',
            lambda: f"<p>{self.prose()}</p>",
            lambda: f"<div>{self.prose()}</div>",
            lambda: f"<p><b>{self.words(1, 2)}</b>: {self.prose()}</p>",
        )

    def comments(self) -> str:
        tag = self.one(("section", "div", "div", "ol", "ul"))
        title = self.one(("h2", "h3", "h4"))
        head = "" if tag in ("ol", "ul") else self.maybe(0.8, lambda: f"<{title}>{self.words(1, 3)}</{title}>")
        inside = self.some(1, 8, self.comment)
        if head and self.random.random() < 0.4:
            inside = "<ol>" + self.some(1, 6, lambda: f"<li>{self.pick(self.comment, lambda: f'<p>{self.prose()}</p>')}</li>") + "</ol>"
        return f"<{tag}{self.named(COMMENTS, 0)}>{head}{inside}" + self.maybe(0.3, self.form) + f"</{tag}>"

    def share(self) -> str:
        return f"<div{self.named(SHARE, 0)}>" + self.some(2, 5, self.link) + "</div>"

    # content
    def paragraph(self) -> str:
        text = self.prose()
        return self.pick(
            lambda: f"<p>{text}</p>",
            lambda: f"<p>{text}</p>",
            lambda: f"<p>{text}",
            lambda: f"<p>{text} {self.link()} {self.sentence()}</p>",
            lambda: f"<p><b>{text}<br><p>{self.prose()}</p>",
            lambda: f"<p><em>{self.words(1, 3)}</em> {text}</p>",
            lambda: f"<p>{text}<br>{self.prose()}</p>",
        )

    def line(self) -> str:
        words = self.words(1, 3)
        return self.pick(lambda: f"<p>{words}.</p>", lambda: f"<p>{words}.</p>", lambda: f"<p><b>{words}.<br><p>{self.word()}.</p>")

    def block(self) -> str:
        return self.pick(
            *[self.paragraph] * 14,
            lambda: f"<h2>{self.words(1, 6)}</h2>{self.paragraph()}",
            lambda: "<ul>" + self.some(2, 6, lambda: f"<li>{self.sentence()}</li>") + "</ul>",
            lambda: f"<blockquote>{self.prose()}</blockquote>",
            lambda: f"<blockquote><p>{self.prose()}</p></blockquote>",
            lambda: f"<figure><img><figcaption>{self.sentence()}</figcaption></figure>",
            lambda: "<table>" + self.some(1, 4, lambda: f"<tr><td>{self.words(1, 3)}<td>{self.words(1, 3)}</tr>") + "</table>",
            lambda: f"<pre><code>{self.words(2, 9)}</code></pre>",
            lambda: f"<div>{self.prose()}</div>",
            lambda: f"<section><h2>{self.words(1, 5)}</h2>" + self.some(1, 3, self.paragraph) + "</section>",
            lambda: "<ol>" + self.some(2, 4, lambda: f"<li><p>{self.prose()}</p></li>") + "</ol>",
        )

    def foreign(self) -> str:
        """What stands in articles without belonging to them."""
        return self.pick(self.advert, self.advert, self.sidebar, self.share, self.form, self.notice, self.menu)

    def title(self, main: str) -> str:
        tag = self.one(("h1", "h1", "h1", "h2"))
        title = f"<{tag}{main}>{self.words(2, 9)}</{tag}>"
        return f"<header{main}>{title}</header>" if self.random.random() < 0.15 else title

    def article(self) -> str:
        tag, attrs = self.one((
            ("article", ' data-main="1"'), ("article", ' data-main="1"'), ("article", ' data-main="1"'), ("article", self.named(CONTENT, 1)),
            ("article", self.named(CONTENT, 1)), ("main", ' data-main="1"'), ("main", self.named(CONTENT, 1)), ("div", self.named(CONTENT, 1)),
            ("div", self.named(CONTENT, 1)), ("div", self.named(CONTENT, 1)), ("section", self.named(CONTENT, 1)),
            ("div", ' role="main" data-main="1"'),
        ))
        body = self.some(1, self.one((1, 8, 20, 20, 30)), lambda: self.block() + self.maybe(0.15, self.foreign))
        if self.random.random() < 0.08:
            body = self.some(5, 40, self.line)
        elif self.random.random() < 0.2:
            body = self.some(1, 15, lambda: f"<div>{self.prose()}</div>" + self.maybe(0.1, self.foreign))
        if tag in ("article", "main") and self.random.random() < 0.3:
            body = f"<div{self.named(CONTENT, 1)}>{body}</div>"
        return (
            f"<{tag}{attrs}>" + self.maybe(0.85, lambda: self.title("")) + body + self.maybe(0.15, self.share)
            + self.maybe(0.25, self.comments) + self.maybe(0.1, lambda: f'<footer data-main="0">{self.link()} {self.link()}</footer>')
            + f"</{tag}>"
        )

    def bare(self) -> str:
        """Content without an element of its own."""
        marked = self.title(' data-main="1"')
        for _ in range(self.random.randint(2, 12)):
            marked += f'<p data-main="1">{self.prose()}</p>'
        return marked

    def page(self) -> str:
        around = [self.advert, self.notice, self.sidebar, self.menu, self.form]
        body = self.maybe(0.65, self.header) + self.maybe(0.6, self.menu) + self.maybe(0.5, self.one(around))
        content = self.bare() if self.random.random() < 0.2 else self.article()
        if self.random.random() < 0.05:
            content = ""
        inner = self.maybe(0.3, self.sidebar) + content + self.maybe(0.4, self.sidebar) + self.maybe(0.35, self.comments) + self.maybe(0.2, self.one(around))
        if self.random.random() < 0.5:
            inner = f'<div class="{self.one(WRAPPER)}">{inner}</div>'
        elif self.random.random() < 0.2:
            inner = f'<table class="{self.one(WRAPPER)}"><tr><td data-main="0">{self.menu()}</td><td data-main="1">{content}</td></tr></table>'
        body += inner + self.maybe(0.8, self.footer) + self.maybe(0.2, self.notice)
        if self.random.random() < 0.06:
            body = f'<form action="/page" id="aspnetForm">{body}</form>'
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{body}</body></html>"


def labelled_pages(pages: int = PAGES, seed: int = SEED) -> Iterator[str]:
    random = Random(seed)
    for _ in range(pages):
        yield Writer(random).page()
