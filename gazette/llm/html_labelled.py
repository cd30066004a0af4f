"""Labelled pages that train the content model.

Hand-written page layouts; an element marked ``y`` is main text, all unmarked text is not.
``PAGES`` spells every layout in several ways (semantic tags, classed boxes, no hints but position), filled with
sentences of different lengths, so that the model learns from tags, names, links and neighbours alike.
"""

from __future__ import annotations

import itertools
import random

SHORT = ("Home", "About us", "Contact", "News", "Read more", "Sports", "Log in", "Privacy", "Terms of use", "Next page")
LONG = (
    "The committee met on Tuesday to discuss the plans, which had been delayed twice before.",
    "Nobody expected the river to rise so quickly, and the lower fields were lost within a day.",
    "She kept the letters in a tin box, tied with string, for more than forty years.",
    "Engineers measured the bridge again in spring; the cracks, they found, had not grown.",
    "Prices fell slightly last month, although most shops had announced the opposite.",
    "A second path leads along the ridge, past two huts and a spring, down to the valley.",
)

HEADER = ('<header class="site-header"><div class="logo">Daily Paper</div><p>All the news of the region</p></header>',
          '<div id="header"><h2>Daily Paper</h2><div class="tagline">All the news of the region, every day.</div></div>', '')
MENU = ('<nav><ul>{links}</ul></nav>', '<div class="navbar menu"><ul>{links}</ul></div>',
        '<div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/n">News</a></div><ul>{links}</ul>',
        '<div><a href="/">Home</a> <a href="/n">News</a> <a href="/s">Sports</a></div>',
        '<div><a href="/">Home</a></div><div><a href="/n">News</a></div><div><a href="/l">Log in</a></div>')
ADVERT = ('<div class="ad">{one}</div>', '<div class="advert banner"><p>{one}</p><a href="/buy">Buy now</a></div>',
          '<aside class="sponsored"><h3>Sponsored</h3><p>{one}</p></aside>', '')
NOTICE = ('<div class="cookie-notice" role="dialog"><p>We use cookies to improve this site.</p><button>Accept</button></div>',
          '<div class="alert notice">{one}</div>', '')
ASIDE = ('<aside><h3>Most read</h3><ul>{links}</ul></aside>', '<div class="sidebar"><h4>Related</h4><ul>{links}</ul><p>{one}</p></div>', '')
BODY = ('<h1 y>{title}</h1><p y>{one}</p><p y>{two}</p><p y>{one} {two}</p>',
        '<h1 y>{title}</h1><p y>{one} <a href="/x">with a link</a> {two}</p><ul><li y>{title}</li><li y>{two}</li></ul><p y>{two}</p>',
        '<h1 y>{title}</h1><p y>{two}</p><h2 y>{title}</h2><p y>{one}</p><blockquote y>{two}</blockquote>{inner}<p y>{one}</p>',
        '<h1 y>{title}</h1><p y>{title}</p><p y>Yes.</p><pre y>x = 1</pre><p y>{two}</p>',
        '<h1 y>{title}</h1><div y>{one}</div><div y>{two}</div><table><tr><td y>{title}</td><td y>12</td></tr></table>',
        '<h1 y>{title}</h1><p y>{title}</p>',
        '<h1 y>{title}</h1><p y>{one}</p><ul><li y>{word}</li><li y>{word}</li><li y>{word}</li></ul><p y>{two}</p>',
        '<h1 y>{title}</h1><p y>{one}</p><ul><li y><a href="/a">{title}</a></li><li y><a href="/b">{word}</a></li></ul>',
        '<h1 y>{title}</h1><figure><img src="a.png"><figcaption y>{title}</figcaption></figure><p y>{two}</p><ol><li y>{word}</li>'
        '<li y>{word} <a href="/c">{word}</a></li></ol><table><tr><td y>{word}</td><td y>3</td></tr><tr><td y>{word}</td><td y>4</td></tr></table>')
INNER = ('<div class="share social"><a href="/s">Share</a> <a href="/t">Send</a></div>', '<div class="ad">{one}</div>',
         '<form class="newsletter"><label>Subscribe to our letter</label><input><button>Go</button></form>', '')
BOX = ('<article>{body}</article>', '<main><div class="content">{body}</div></main>', '<div class="post-content entry">{body}</div>',
       '<main><article class="story">{body}</article></main>', '<div id="article-body">{body}</div>')
COMMENTS = ('<section class="comments"><h3>Comments</h3><div class="comment"><p>{one}</p></div><div class="comment"><p>{two}</p></div></section>',
            '<div id="respond"><ol class="comment-list"><li><b>Ann</b> <p>{two}</p></li></ol><form><textarea></textarea></form></div>', '')
FORM = ('<form action="/search"><label>Search</label><input type="text"><button>Find</button></form>', '')
FOOTER = ('<footer>&copy; Daily Paper &middot; {one}</footer>', '<div class="footer"><p>Copyright Daily Paper. {one}</p><a href="/p">Privacy</a></div>',
          '<footer><ul>{links}</ul><p>{two}</p></footer>', '<p>Copyright 2024</p>', '<div>&copy; 2024 Daily Paper. All rights reserved.</div>')
# boxes without a telling name, beside pages whose main part is marked by its tag
BESIDE = ('<section><h3>{count} replies</h3><div><p><b>Ann</b> says:</p><p>{two}</p></div><div><p>{one}</p></div></section>',
          '<section><h2>More from this place</h2><ul>{links}</ul></section>', '<div class="x1"><p>{one}</p></div>', '', '')
WORDS = ("One", "Two", "Flour", "Salt and water", "North side", "Spring", "A spoon of oil", "Late trains", "Maps", "42 km")


def pages(count: int = 210, seed: int = 1) -> list[str]:
    """``count`` pages; every choice above occurs, in mixed combinations."""
    rng = random.Random(seed)
    parts = (HEADER, MENU, ADVERT, NOTICE, BODY, INNER, BOX, ASIDE, COMMENTS, FORM, FOOTER, BESIDE)
    turns = [itertools.cycle(rng.sample(p, len(p))) for p in parts]
    out = []
    for k in range(count):
        head, menu, ad, notice, body, inner, box, aside, comments, form, foot, beside = [
            next(t) if rng.random() < 0.7 else rng.choice(p) for t, p in zip(turns, parts)]
        where = rng.random()
        late = (comments if where < 0.5 else "") + (beside if "<article" in box or "<main" in box else "")
        body = body.replace("{inner}", inner) + (comments if where >= 0.5 else "")
        page = "".join(["<html><head><title>{title}</title><script>var a = 1;</script></head><body>", head, menu, form if k % 2 else "",
                        notice, ad, box.replace("{body}", body), late, aside, "" if k % 2 else form, foot, "</body></html>"])
        links = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in rng.sample(SHORT, rng.randint(3, 6)))
        for slot in ("{one}", "{two}"):
            while slot in page:
                page = page.replace(slot, " ".join(rng.sample(LONG, rng.randint(1, 4))), 1)
        out.append(_filled(page, rng).replace("{links}", links))
    return out


def _filled(page: str, rng: random.Random) -> str:
    """The page with its one-time slots filled."""
    fill = {"{title}": lambda: rng.choice(LONG)[:rng.randint(20, 60)], "{word}": lambda: rng.choice(WORDS),
            "{count}": lambda: str(rng.randint(1, 40))}
    for slot, value in fill.items():
        while slot in page:
            page = page.replace(slot, value(), 1)
    return page
