"""Main text of web pages: a CRF over the leaf blocks of the DOM, trained on labelled pages, decoded by Viterbi.

A page becomes the sequence of its text blocks (runs of text between block-level tags), each with features of its
ancestors (tag names, roles, words in class and id) and of its text (length, links, sentence ends, place). The CRF marks
each block as article or not; the article's blocks, in page order, are the text.

The labelled pages come from :func:`labelled_pages`, which lays out sites by rule: menus, headers, sidebars, adverts,
notices, forms, comments and footers around articles in several dialects of markup.

Defined results: null and empty pages give an empty text; every input row gives one output row; an empty table gives an
empty result; broken markup never fails (an unclosed comment, script or tag ends with the page). White space, that of
references like &nbsp; included, becomes one space. Other columns are not read.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from html import unescape

import numpy as np
from pyspark.sql import DataFrame

from .crf import Crf, decode, feature_rows, train
from .texts import per_text

LABELS = ("other", "main")

#: A quote opens a string only at the begin of a value; elsewhere, as in ``data-x=don't``, it is a character like any other.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)?+)*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")

# Fixed values of HTML and of the usual words in class names.
RAW = frozenset("script style template textarea iframe object svg canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input".split()) | frozenset(
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msup msub msubsup mover munder munderover mmultiscripts mprescripts none mtable mtr mtd mlabeledtr mstyle mpadded mphantom merror menclose mfenced maction semantics annotation annotation-xml".split()
)
#: Lists to choose from: what they hold is part of a form, and they may stand inside a paragraph.
CHOICES = frozenset("select datalist optgroup option".split())
SECTIONS = frozenset("article main nav header footer aside form section div body html head ul ol dl table figure blockquote dialog menu title button fieldset details address".split())
CUE_TAGS = {"article": "article", "main": "article", "nav": "menu", "menu": "menu", "header": "head", "footer": "foot", "aside": "side", "form": "form", "button": "form", "head": "meta", "title": "meta", "dialog": "notice", "fieldset": "form", **dict.fromkeys(CHOICES, "form")}
CUE_WORDS = {
    "article": "article post entry content story body main text hentry prose".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs tabs toolbar pagination pager".split(),
    "head": "header masthead banner topbar branding logo".split(),
    "foot": "footer foot colophon copyright legal contentinfo bottom".split(),
    "side": "sidebar aside side widget related recommended complementary trending popular more".split(),
    "ad": "ad ads advert adverts advertisement sponsored sponsor promo promotion promoted adsense banner".split(),
    "notice": "notice cookie cookies consent gdpr alert modal popup overlay warning dialog paywall disclaimer".split(),
    "form": "form login signup subscribe newsletter search contact register".split(),
    "comment": "comment comments commentlist disqus reply replies discussion respond responses".split(),
    "share": "share social sharing follow tags byline meta author".split(),
}
#: Words that say nothing about what an element holds.
GENERIC = frozenset("site page wrap wrapper container box list area section block inner outer item items group panel bar holder module region zone unit slot left right top global primary secondary".split())
#: Elements that hold text themselves: a class on them mostly says how it looks.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt figcaption".split())
_CUE_OF = {w: cue for cue, words in CUE_WORDS.items() for w in words}


@dataclass(slots=True)
class Block:
    tag: str
    cues: tuple[str, ...]
    text: str
    linked: int  # letters inside links
    letters: int


def _class_cues(name: str, value: str) -> list[str]:
    """Cues of class words, with a question mark where a class says more than the cue, or more than one thing about a text."""
    found = []
    for token in value.split():
        words = _WORD.findall(token)
        own = dict.fromkeys(_CUE_OF[w] for w in words if w in _CUE_OF)
        vague = any(w not in _CUE_OF and w not in GENERIC for w in words) or name in TEXTUAL and len(own) > 1
        found += [f"{c}?" if vague and c != "article" else c for c in own]
    return found


def _cues(name: str, attributes: str, above: tuple[str, ...]) -> list[str]:
    found = [CUE_TAGS[name]] if name in CUE_TAGS else []
    if name == "header" and "article" in above:
        found = ["heading"]  # the head of the article itself
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "hidden" or m[1].lower() == "style" and "display:none" in value.replace(" ", ""):
                found.append("hidden")
            elif m[1].lower() != "style":
                found += _class_cues(name, value)
    return found


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    # (name, cues from the root down, without repeats); only what was opened and not yet closed
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: dict[str, int] = {}
    text: list[str] = []
    linked = letters = 0
    at, n = 0, len(html)

    def flush() -> None:
        nonlocal linked, letters
        joined = " ".join(unescape("".join(text)).split())
        if joined:
            tag = next((name for name, _ in reversed(stack[-6:]) if name not in INLINE), "none")
            out.append(Block(tag, stack[-1][1] if stack else (), joined, linked, max(1, letters)))
        text.clear()
        linked = letters = 0

    def pop(name: str) -> None:
        while stack:
            last, _ = stack.pop()
            opened[last] -= 1
            if last == name:
                return

    def say(piece: str) -> None:
        nonlocal linked, letters
        text.append(piece)
        size = len(piece.strip())
        letters += size
        if opened.get("a"):
            linked += size

    while at < n:
        sign = html.find("<", at)
        if sign < 0:
            say(html[at:])
            break
        if sign > at:
            say(html[at:sign])
        if html.startswith("<!--", sign):
            end = html.find("-->", sign + 4)
            at = n if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), sign):
            end = html.find(">", sign)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(html, sign) or _LOOSE.match(html, sign)
        if not m:
            if sign + 1 < n and (html[sign + 1].isalpha() or html[sign + 1] == "/"):
                break  # a tag that the page's end cuts off
            say("<")
            at = sign + 1
            continue
        closing, name, attributes = m[1], m[2].lower(), m[3]
        at = m.end()
        if name in RAW and not closing:
            text.append(" ")
            if not (name == "svg" and attributes.rstrip().endswith("/")):
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE).search(html, at)
                stop = n if end is None else html.find(">", end.start())
                at = n if stop < 0 or end is None else stop + 1
            continue
        if name == "br":
            text.append(" ")
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if closing:
            if opened.get(name):
                pop(name)
            continue
        if name not in INLINE and name not in CHOICES and opened.get("p") and name != "p" or name == "p" and opened.get("p"):
            pop("p")
        if name in ("option", "optgroup") and stack and stack[-1][0] == "option":
            pop("option")
        if name in ("li", "dd", "dt", "td", "th", "tr", "optgroup") and stack and stack[-1][0] == name:
            pop(name)
        if attributes.endswith("/") and name not in SECTIONS:
            continue
        above = stack[-1][1] if stack else ()
        fresh = _cues(name, attributes, above)
        # the last twelve cues, innermost last, each once
        own = above if not fresh else (*[c for c in above if c not in fresh], *dict.fromkeys(fresh))[-12:]
        stack.append((name, own))
        opened[name] = opened.get(name, 0) + 1
    flush()
    return out


def _size(n: int) -> str:
    return str(sum(n > x for x in (2, 5, 10, 20, 40, 80)))


_SEEN: dict[tuple, list[int]] = {}


def features(page: list[Block]) -> np.ndarray:
    """Feature rows of each block, of fixed width. What blocks have in common is hashed once."""
    rows = []
    if len(_SEEN) > 100_000:
        _SEEN.clear()
    short = [(b.tag, b.cues[-1] if b.cues else "-", _size(len(b.text.split()))) for b in page]
    for i, b in enumerate(page):
        inner = b.cues[-1] if b.cues else "-"
        outer = b.cues[-2] if len(b.cues) > 1 else "-"
        links = b.linked / b.letters
        words = short[i][2]
        ending = b.text[-1] in ".!?:;\"”»…"
        before = short[i - 1] if i else ("^", "^", "^")
        after = short[i + 1] if i + 1 < len(page) else ("$", "$", "$")
        bad, article = _bad(b.cues), "article" in b.cues
        key = (b.tag, inner, outer, words, int(links * 3.99), ending, "©" in b.text, article, bad, before[:2], after[:2], "hidden" in b.cues)
        if key in _SEEN:
            rows.append(_SEEN[key])
            continue
        names = [
            f"tag={b.tag}", f"in={inner}", f"out={inner}/{outer}", f"tag,in={b.tag},{inner}", f"words={words}", f"words,in={words},{inner}", f"links={int(links * 3.99)}",
            f"end={ending}", f"end,words={ending},{words}", f"sign={'©' in b.text}", f"article={article}", f"bad={bad}", f"bad,article={bad},{article}", f"b={before[1]},{before[0]}", f"a={after[1]},{after[0]}", f"hidden={'hidden' in b.cues}",
        ]
        _SEEN[key] = feature_rows(names)
        rows.append(_SEEN[key])
    return np.array(rows, dtype=np.int32)


_BAD = ("comment", "ad", "notice", "form", "side", "menu", "foot", "share", "meta", "head")


def _bad(cues: tuple[str, ...]) -> str:
    return next((c for c in _BAD if c in cues), "-")


def labelled_pages(seed: int = 5, pages: int = 260) -> list[tuple[list[Block], list[int]]]:
    """Pages laid out by rule; a block is main if its text came from the article."""
    rng = random.Random(seed)
    marks: set[str] = set()

    def word() -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéüñ") for _ in range(rng.randint(1, 9)))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(rng.randint(low, high)))

    def prose(main: bool, low: int = 3, high: int = 70) -> str:
        text = words(low, high).capitalize() + rng.choice((".", ".", ".", ".", "", "!", "?"))
        if main:
            marks.add(text)
        return text

    def links(low: int, high: int) -> str:
        return "".join(f'<li><a href="/x">{words(1, 2)}</a></li>' for _ in range(rng.randint(low, high)))

    def menu() -> str:
        body = f"<ul>{links(3, 8)}</ul>"
        return rng.choice((f"<nav>{body}</nav>", f'<div class="navbar">{body}</div>', f'<div id="menu">{body}</div>', f'<div role="navigation">{body}</div>', f'<header><nav>{body}</nav></header>'))

    def head() -> str:
        return rng.choice((f"<header><div>{words(1, 4)}</div></header>", f'<div class="masthead"><p>{words(1, 6)}</p></div>', f'<header class="site-header"><h2>{words(1, 4)}</h2><p>{words(3, 9)}</p></header>', ""))

    def ad() -> str:
        return f'<div class="{rng.choice(("ad", "ads", "advert", "sponsored", "promo"))}">{rng.choice((prose(False, 2, 25), f"<p>{prose(False, 3, 30)}</p>", f"<a href=x>{words(2, 8)}</a>"))}</div>'

    def side() -> str:
        body = rng.choice((f"<h3>{words(1, 3)}</h3><ul>{links(2, 6)}</ul>", f"<p>{prose(False, 4, 40)}</p>"))
        return rng.choice((f"<aside>{body}</aside>", f'<div class="sidebar">{body}</div>', f'<div class="related">{body}</div>', f'<div class="widget">{body}</div>', f'<div class="{vague()}"><ul>{links(2, 6)}</ul></div>'))

    def notice() -> str:
        if rng.random() < 0.1:
            return f"<noscript>{rng.choice((prose(False, 4, 20), f'<p>{prose(False, 4, 20)}</p>'))}</noscript>"
        return f'<div class="{rng.choice(("notice", "cookie", "alert", "consent", "modal"))}">{rng.choice((prose(False, 4, 30), f"<p>{prose(False, 4, 30)}</p><button>{words(1, 2)}</button>"))}</div>'

    def form() -> str:
        body = f"<label>{words(1, 3)}</label><input><p>{prose(False, 3, 14)}</p><button>{words(1, 2)}</button>"
        return rng.choice((f"<form>{body}</form>", f'<div class="newsletter"><form>{body}</form></div>', f'<div class="subscribe"><p>{prose(False, 4, 20)}</p></div>'))

    def comments() -> str:
        tag = rng.choice(("div", "section", "ul"))
        inner = "li" if tag == "ul" else rng.choice(("div", "p", "article"))
        each = "".join(f'<{inner} class="comment">{rng.choice(("", f"<b>{words(1, 2)}</b> "))}{rng.choice((prose(False, 3, 50), f"<p>{prose(False, 3, 50)}</p>"))}</{inner}>' for _ in range(rng.randint(1, 4)))
        return f'<{tag} {rng.choice(("id", "class"))}="{rng.choice(("comments", "replies", "comment-list", "discussion"))}"><h3>{words(1, 2)}</h3>{each}</{tag}>'

    def foot() -> str:
        body = f"&copy; {word()}.example.org &middot; {prose(False, 3, 12)}"
        return rng.choice((f"<footer>{body}</footer>", f"<footer><p>{body}</p><ul>{links(1, 4)}</ul></footer>", f'<div class="footer"><p>{body}</p></div>', f'<div id="foot">{body}</div>'))

    def article() -> str:
        title = words(1, 10)
        marks.add(title)
        parts = [rng.choice((f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f"<header><h1>{title}</h1><p>{prose(True)}</p></header>"))]
        for _ in range(rng.randint(1, 9)):
            parts.append(rng.choice((
                lambda: f"<p>{prose(True)}</p>", lambda: f"<p>{prose(True)}", lambda: f"<p><b>{prose(True)}<br>", lambda: f"<p>{prose(True)}</p>", lambda: f"<h2>{main_words(1, 6)}</h2>",
                lambda: "<ul>" + "".join(f"<li>{prose(True, 2, 14)}</li>" for _ in range(rng.randint(2, 4))) + "</ul>", lambda: f"<blockquote>{prose(True)}</blockquote>",
                lambda: f'<{(t := rng.choice(("p", "p", "div", "h2", "blockquote")))} class="{vague()}">{prose(True)}</{t}>', lambda: f"<noscript><p>{prose(True)}</p></noscript>",
                lambda: f'<div class="{vague()}"><p>{prose(True)}</p><p>{prose(True)}</p></div>', lambda: f"<p>{prose(True, 1, 3)}</p>", lambda: f"<table><tr><td>{main_words(1, 3)}</td><td>{main_words(1, 2)}</td></tr></table>", lambda: f"<pre>{prose(True)}</pre>",
                lambda: rng.choice((ad, side, form, notice))(),
            ))())
        body = "".join(parts)
        if rng.random() < 0.12:
            body += f"<footer>{rng.choice((prose(False, 3, 12), f'<p>{prose(False, 3, 30)}</p>', f'<ul>{links(1, 4)}</ul>'))}</footer>"
        if rng.random() < 0.15:
            body += f'<div class="share"><a href=x>{words(1, 2)}</a> <a href=x>{words(1, 2)}</a></div>'
        if rng.random() < 0.2:
            body += comments()
        return rng.choice((f"<article>{body}</article>", f"<article>{body}</article>", f"<main>{body}</main>", f'<div class="content">{body}</div>', f'<div id="post">{body}</div>', f"<main><article>{body}</article></main>", f"<div>{body}</div>", body))

    def vague() -> str:
        """A class that holds a cue but says something else, as ``popular-science`` does."""
        cue = rng.choice([w for c, ws in CUE_WORDS.items() if c != "article" for w in ws])
        other = rng.choice(("science", "history", "color", "grid", "story", "figure", "large", "intro", "lead"))
        return rng.choice((f"{cue}-{other}", f"{other}-{cue}", f"{cue}_{other} wide"))

    def main_words(low: int, high: int) -> str:
        text = words(low, high)
        marks.add(text)
        return text

    out = []
    for _ in range(pages):
        marks.clear()
        tops = [rng.choice((head, menu, ad, notice, menu))() for _ in range(rng.randint(1, 4))]
        tails = [rng.choice((side, ad, comments, form, notice, side))() for _ in range(rng.randint(0, 3))]
        middle = rng.choice((article, article, article, lambda: f'<div class="wrap">{side()}{article()}{side()}</div>'))()
        html = f"<html><head><title>{words(1, 8)}</title><style>p{{}}</style></head><body>{''.join(tops)}{middle}{''.join(tails)}{rng.choice((foot(), foot(), ''))}"
        page = blocks(html)
        out.append((page, [int(b.text in marks) for b in page]))
    return out


def model(seed: int = 5) -> Crf:
    pages = [(p, y) for p, y in labelled_pages(seed) if p]
    return train([features(p) for p, _ in pages], [np.array(y) for _, y in pages], LABELS, rounds=70)


def main_texts(pages: list[str | None], crf: Crf) -> list[str]:
    found = [blocks(p) if p else [] for p in pages]
    some = [i for i, p in enumerate(found) if p]
    out = [""] * len(pages)
    for i, path in zip(some, decode(crf, [features(found[i]) for i in some])):
        out[i] = "\n".join(b.text for b, k in zip(found[i], path) if k)
    return out


def extract(pages: DataFrame, crf: Crf | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    crf = crf or model()

    def rows(htmls: list[str | None]) -> list[tuple]:
        return [(t, len(t)) for t in main_texts(htmls, crf)]

    return per_text(pages, rows, "text string, n_chars long", key="page_id", text="html", also=("url",))
