"""Labelled pages the content model is trained on, composed from a stated list of page parts.

Each page takes a wrapper for its article, article blocks, and parts around them; the text blocks of the
article carry MARK, which is how the reader of a page knows their label.
"""

from __future__ import annotations

import random

MARK = "\x01"
PAGES = 240
SYLLABLES = "ba do fe ki lo ma nu pe ri so ta ve wi xo yu za chi ther ing ation est und der que os".split()

WRAPPERS = (
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>',
    '<div id="main-content"><div class="post">{}</div></div>', '<div class="entry-content">{}</div>', '<section class="story">{}</section>',
    '<div id="content" class="article-body">{}</div>', "<div><div>{}</div></div>", "<table><tr><td>{}</td></tr></table>",
    '<article class="post">{}</article>', '<div class="container"><article>{}</article></div>', '<div role="main">{}</div>',
)
BEFORE = (
    "<nav><ul>{links}</ul></nav>", '<div class="menu">{anchors}</div>', "<header><h1><a href='/'>{short}</a></h1><p>{line}</p></header>",
    '<div id="header">{short}</div>', '<ul class="nav">{links}</ul>', '<div class="breadcrumb">{anchors}</div>',
    '<div class="cookie-notice"><p>{line}</p><button>{short}</button></div>', '<div class="banner ad">{line}</div>', '<div class="ad">{line}</div>',
    "<form><label>{short}</label><input><button>{short}</button></form>", '<div class="alert">{line}</div>', '<div role="navigation">{anchors}</div>',
    '<div class="advert"><p>{line}</p></div>', '<div class="skip">{anchors}</div>',
)
AFTER = (
    "<footer>&copy; {short} {line}</footer>", "<footer><p>{line}</p><ul>{links}</ul></footer>", "<aside><h3>{short}</h3><ul>{links}</ul></aside>",
    "<aside><p>{line}</p></aside>", '<div class="sidebar"><h3>{short}</h3><p>{line}</p></div>', '<div id="comments"><h3>{short}</h3><p>{line}</p><p>{long}</p></div>',
    '<section class="comments"><ol><li><p>{long}</p></li><li><p>{line}</p></li></ol></section>', '<div class="comment"><p>{long}</p></div>',
    '<div class="related"><h3>{short}</h3><ul>{links}</ul></div>', '<div class="share">{anchors}</div>', '<div class="sponsored"><p>{line}</p></div>',
    '<form class="newsletter"><p>{line}</p><input><button>{short}</button></form>', '<div class="footer">{line}</div>', '<div id="footer"><p>{line}</p></div>',
    '<div class="widget"><h4>{short}</h4>{line}</div>', '<div class="pagination">{anchors}</div>', '<div class="copyright">{short}</div>', '<div class="ad">{line}</div>',
    '<div class="promo"><p>{long}</p></div>', '<div class="popup modal"><p>{line}</p></div>',
)
BLOCKS = (
    "<p>{long}</p>", "<p>{long}</p>", "<p>{long}</p>", "<p>{long}</p>", "<p>{line}</p>", "<p>{line}</p>", "<p>{short}</p>", "<p><b>{line}<br>", "<p>{long} <a href='/x'>{short}</a> {long}</p>",
    "<h2>{short}</h2><p>{long}</p>", "<h2>{line}</h2>", "<h3>{short}</h3>", "<ul><li>{line}</li><li>{line}</li></ul>", "<ol><li>{line}</li><li>{short}</li></ol>",
    "<blockquote><p>{line}</p></blockquote>", "<pre>{line}</pre>", "<div>{long}</div>", "<table><tr><td>{short}</td><td>{line}</td></tr></table>", "<figure><img><figcaption>{line}</figcaption></figure>", "<dl><dt>{short}</dt><dd>{line}</dd></dl>", "{long}",
)


def _words(rng: random.Random, n: int) -> str:
    made = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return " ".join(made)


def _fill(part: str, rng: random.Random, mark: str = "") -> str:
    links = "".join(f"<li><a href='/x'>{_words(rng, rng.randint(1, 3))}</a></li>" for _ in range(rng.randint(2, 6)))
    anchors = " ".join(f"<a href='/x'>{_words(rng, rng.randint(1, 2))}</a>" for _ in range(rng.randint(2, 6)))
    while "{" in part:
        part = part.replace("{links}", links).replace("{anchors}", anchors)
        part = part.replace("{short}", mark + _words(rng, rng.randint(1, 6)), 1)
        part = part.replace("{line}", mark + _words(rng, rng.randint(5, 16)).capitalize() + ".", 1)
        part = part.replace("{long}", mark + ". ".join(_words(rng, rng.randint(6, 20)).capitalize() for _ in range(rng.randint(2, 8))) + ".", 1)
    return part


def labelled_pages(pages: int = PAGES, seed: int = 7) -> list[str]:
    """Pages whose article blocks are marked."""
    made = []
    for i in range(pages):
        rng = random.Random(seed * 1000 + i)
        inside = [_fill("<h1>{line}</h1>", rng, MARK)] if rng.random() < 0.8 else []
        inside += [_fill(rng.choice(BLOCKS), rng, MARK) for _ in range(rng.choice((1, 2, 3, 5, 8, 14)))]
        if rng.random() < 0.15:  # something foreign inside the article
            inside.insert(rng.randrange(len(inside) + 1), _fill(rng.choice(BEFORE[6:9] + AFTER[8:11]), rng))
        before = "".join(_fill(p, rng) for p in rng.sample(BEFORE, rng.randint(0, 4)))
        after = "".join(_fill(p, rng) for p in rng.sample(AFTER, rng.randint(0, 5)))
        made.append(f"<html><head><title>x</title></head><body>{before}{rng.choice(WRAPPERS).format(''.join(inside))}{after}</body></html>")
    return made
