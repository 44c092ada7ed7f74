"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

import html
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_blocks, small_batches

# What HTML's own rules say about elements.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is text that is not shown.
HIDDEN_TAGS = ("script", "style", "template", "noscript", "iframe", "svg", "head", "title")
#: Those that hide the rest of the page without an end tag, and those that have an end tag of their own each.
RAW_TAGS, PAIRED_TAGS = ("script", "style"), ("template", "noscript", "svg")
#: An open tag of the key ends open elements of the value, unless a table or list is in between.
IMPLIED_ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: Block elements that end an open paragraph.
ENDS_P = BLOCK_TAGS - {"button", "caption", "option", "optgroup", "legend", "summary", "head", "title", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}

#: Zones by element name, and by words in class, id and role; the first zone that matches counts.
ZONE_TAGS = {"nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "side", "form": "form", "button": "form", "select": "form", "textarea": "form", "dialog": "notice", "article": "main", "main": "main"}
ZONE_WORDS = {
    "comment": "comment comments reply replies respond disqus discussion responses",
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promoted banner adsense",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe paywall overlay",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs",
    "footer": "footer copyright colophon bottom",
    "side": "sidebar side aside widget widgets related recommended share sharing social tags rail",
    "header": "header masthead topbar logo branding toolbar",
    "form": "form login signin signup search searchbox contact",
    "main": "article content main post entry story body text",
}
#: Words that may stand beside a zone's in a class name ("site-nav", "cookie-box"); beside any other word ("related-work") the zone is only a hint.
PLAIN_WORDS = frozenset(
    "site page post main box wrap wrapper container block area left right top bottom inner outer list links item items section module col column row primary secondary global local x with view region "
    "panel group bar zone slot unit the my mobile desktop sticky fixed inline text content article head foot header footer card form modal".split()
)
#: Elements that hold text of their own: what their class names is a hint, too, never a zone.
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p li td th dt dd caption figcaption blockquote pre summary legend label span a b i em strong small".split())
#: Zones that a class may name though the element holds the whole article: see ``without_wrappers``.
SOFT_ZONES = frozenset(("notice", "nav", "footer", "side", "header", "form"))
_ZONE_OF = {word: zone for zone, words in reversed(ZONE_WORDS.items()) for word in words.split()}
_RANK = {zone: i for i, zone in enumerate(ZONE_WORDS)}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CLOSES = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in HIDDEN_TAGS}
_PAIRS = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.I) for tag in PAIRED_TAGS}
_UNQUOTED_END = re.compile(r"=\s*[^\s\"'=]+/\Z")


def self_closed(attributes: str) -> bool:
    """Whether a tag ends in a slash that isn't the end of an unquoted value."""
    return attributes.endswith("/") and not _UNQUOTED_END.search(attributes)


def paired_ends(page: str, tag: str) -> dict[int, int]:
    """Where the content of each element of that name begins and where its own end tag ends, in one pass; unclosed ones are left out."""
    opened, out = [], {}
    for m in _PAIRS[tag].finditer(page):
        if m[1]:
            if opened:
                out[opened.pop()] = m.end()
        elif not (tag == "svg" and self_closed(m[2])):
            opened.append(m.end())
    return out


def class_words(attributes: str) -> list[list[str]]:
    """Words of each name in class, id and role, in lower case."""
    if not attributes:
        return []
    return [[w.lower() for w in _WORD.findall(name)] for m in _NAMES.finditer(attributes) for name in m[1].strip("\"'").split()]


def zone(tag: str, names: list[list[str]]) -> tuple[str | None, str | None]:
    """The part of a page that an element stands for by its name or the words of its class, id and role, and the part that these only hint at."""
    sure, hints = [], []
    for words in names:
        found = [_ZONE_OF[w] for w in words if w in _ZONE_OF]
        plain = tag not in TEXT_TAGS and all(w in _ZONE_OF or w in PLAIN_WORDS for w in words)
        (sure if plain else hints).extend(found)
    best, hint = (min(x, key=_RANK.get, default=None) for x in (sure, hints))
    if tag in ("html", "body"):
        return None, None
    if tag in ("article", "main"):  # an article says itself what it is, but for a reader's comment or an advert
        return best if best in ("comment", "ad") else "main", None
    return best if best and (best != "main" or tag not in ZONE_TAGS) else ZONE_TAGS.get(tag, best), hint


class Block:
    """A run of text: its open elements, their zones and hints, the words of their classes from the innermost on, characters in links, and its place from both ends."""

    __slots__ = ("text", "tags", "zones", "linked", "elements", "hints", "words", "own_hint", "place")

    def __init__(self, text: str, linked: int, stack: list[tuple]):
        self.text, self.linked, self.place = text, linked, (9, 9)
        self.tags = [x[0] for x in stack]
        self.elements = [(i, z, c) for _, z, i, c, _, _ in stack if z]
        self.zones = [z for _, z, _ in self.elements]
        self.hints = {h for t, _, _, _, h, _ in stack if h and t not in TEXT_TAGS}
        self.own_hint = next((h for t, _, _, _, h, _ in reversed(stack) if h and t in TEXT_TAGS), None)
        self.words = [(i, n) for _, _, i, _, _, n in reversed(stack) if n][:3]


def without_wrappers(blocks: list[Block]) -> list[Block]:
    """Forget the zones of elements that only seem to be menus or the like: by class, with most of the page's text, few links, and the only main part, if any, inside."""
    soft = {e for b in blocks for e, z, by_class in b.elements if by_class and z in SOFT_ZONES}
    if soft:
        size, linked, whole, main, within = dict.fromkeys(soft, 0), dict.fromkeys(soft, 0), 0, 0, dict.fromkeys(soft, 0)
        for b in blocks:
            n, is_main = len(b.text), len(b.text) if "main" in b.zones else 0
            whole, main = whole + n, main + is_main
            for e, _, _ in b.elements:
                if e in soft:
                    size[e], linked[e], within[e] = size[e] + n, linked[e] + b.linked, within[e] + is_main
        wrappers = {e for e in soft if 2 * size[e] >= whole and 10 * linked[e] <= 3 * size[e] and within[e] == main}
        for b in blocks if wrappers else []:
            b.zones = [z for e, z, _ in b.elements if e not in wrappers]
            b.words = [(e, n) for e, n in b.words if e not in wrappers]
    return blocks


def leaf_blocks(page: str) -> list[Block]:
    """Runs of shown text between block-level tags, in page order: text, open elements, their zones, characters in links.

    The zones of elements that wrap the article under another name are left out (``without_wrappers``).
    Character references are decoded, white space becomes one space.  Unclosed elements, comments and tags are ended by the page;
    unclosed hidden elements end at their own tag, but for scripts and styles.
    """
    out: list[Block] = []
    stack: list[tuple[str, str | None, int, bool, str | None, list[str]]] = []
    parts: list[str] = []
    linked = at = anchors = opened = 0
    pairs: dict[str, dict[int, int]] = {}
    unclosed: set[str] = set()

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if anchors:
                linked += len(text.strip())

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append(Block(text, linked, stack))
            linked = 0

    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:-3])
            continue
        tag, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "br" or tag in VOID_TAGS and tag != "hr":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                anchors -= sum(x[0] == "a" for x in stack[depth:])
                del stack[depth:]
            continue
        if tag in HIDDEN_TAGS:
            if tag == "svg" and self_closed(attributes):
                continue
            if tag in PAIRED_TAGS:
                if tag not in pairs:
                    pairs[tag] = paired_ends(page, tag)
                at = pairs[tag].get(at, at)
                continue
            close = None if tag in unclosed else _CLOSES[tag].search(page, at)
            if close:
                at = close.end()
            else:
                unclosed.add(tag)
                at = end if tag in RAW_TAGS else at
            continue
        if tag == "hr":
            continue
        ends = IMPLIED_ENDS.get(tag, ()) if tag != "p" else ()
        if tag in ENDS_P:
            ends = (*ends, "p")
        for target in ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == target:
                    anchors -= sum(x[0] == "a" for x in stack[i:])
                    del stack[i:]
                    break
                if stack[i][0] in ("table", "ul", "ol", "div", "article", "section", "main", "body", "blockquote", "form"):
                    break
        if not attributes.endswith("/") or tag in BLOCK_TAGS:
            names = class_words(attributes)
            own, hint = zone(tag, names)
            if "header" in (own, hint) and any(x[1] == "main" for x in stack):
                own, hint = "title", None  # an article's own header has its title
            opened += 1
            stack.append((tag, own, opened, own is not None and tag not in ZONE_TAGS, hint, [w for n in names for w in n]))
            anchors += tag == "a"
    flush()
    for i, b in enumerate(out):
        b.place = (i, len(out) - 1 - i)
    return without_wrappers(out)


#: Buckets of the words of classes, for each of the innermost three elements that have any.
WORD_BUCKETS = 1024

FEATURES = [
    "bias", "in article", "in main", "in section", "in table", "in list", "in figure", "own p", "own li", "own heading", "own cell", "own quote", "own div", "own body", "own inline",
    *(f"last zone {z}" for z in [*ZONE_WORDS, "title", "none"]), *(f"any zone {z}" for z in [*ZONE_WORDS, "title"]), *(f"hint {z}" for z in ZONE_WORDS), *(f"own hint {z}" for z in ZONE_WORDS),
    *(f"hint {z} in main" for z in ZONE_WORDS),
    "short", "medium", "long", "very long", "no links", "some links", "half links", "all links", "sentence end", "copyright in main", "copyright at the end", "copyright elsewhere", "main inside other zone", "only main", "only main, no other name", "first", "last", "near the end",
    *(f"word {i} at {d}" for d in range(3) for i in range(WORD_BUCKETS)),
]
_AT = {name: i for i, name in enumerate(FEATURES)}
_RIGHTS = re.compile(r"©|\(c\) *\d{4}|^copyright\b.{0,20}\d{4}|\ball rights reserved\b", re.I)


def features(block: Block) -> list[int]:
    """Numbers of the features that hold for a block: its ancestors, their zones and the words of their classes, its length, links, punctuation and place."""
    tags, zones = set(block.tags), block.zones
    on = ["bias", *(f"in {t}" for t in ("article", "main", "section", "table", "figure") if t in tags)]
    if "ul" in tags or "ol" in tags:
        on.append("in list")
    own = next((t for t in reversed(block.tags) if t in BLOCK_TAGS), "body")
    kind = {"p": "p", "li": "li", "td": "cell", "th": "cell", "blockquote": "quote", "pre": "quote", "div": "div", "body": "body"}
    on.append("own heading" if re.fullmatch("h[1-6]", own) else f"own {kind.get(own, 'inline')}")
    on.append(f"last zone {zones[-1] if zones else 'none'}")
    on += [f"any zone {z}" for z in set(zones)]
    on += [f"hint {z}" for z in block.hints]
    if "main" in zones:
        on += [f"hint {z} in main" for z in block.hints]
    if block.own_hint:
        on.append(f"own hint {block.own_hint}")
    if zones and set(zones) <= {"main", "title"}:
        on.append("only main")
        if not block.words or block.words[0][0] <= block.elements[-1][0]:
            on.append("only main, no other name")
    if zones and zones[-1] == "main" and len(set(zones)) > 1:
        on.append("main inside other zone")
    n = len(block.text)
    on.append("short" if n < 25 else "medium" if n < 80 else "long" if n < 250 else "very long")
    share = block.linked / max(n, 1)
    on.append("no links" if share == 0 else "some links" if share < 0.34 else "half links" if share < 0.75 else "all links")
    if block.text[-1] in ".!?:;\"'”»…":
        on.append("sentence end")
    before, after = block.place
    if n < 200 and _RIGHTS.search(block.text):
        on.append("copyright in main" if "main" in zones else "copyright at the end" if after < 3 else "copyright elsewhere")
    on += [name for name, holds in (("first", before == 0), ("last", after == 0), ("near the end", after < 3)) if holds]
    out = [_AT[x] for x in on]
    for d, (_, words) in enumerate(block.words):
        out += {_AT[f"word {crc32(w.encode()) % WORD_BUCKETS} at {d}"] for w in words}
    return out


#: Names of parts of pages that training pages use besides the words of the zones, of the article and of anything.
OTHER_NAMES = {
    "nav": "megamenu drawer sitemap pages jump skiplinks", "header": "brand topnav hero-strip skyline", "footer": "legal imprint credits bottomline", "side": "teaser popular trending latest more-stories outbrain authorbox",
    "ad": "adslot dfp taboola sky leaderboard", "notice": "privacy-note toast optin paybar", "form": "subscribe-box mailing survey poll", "comment": "feedback guestbook thread-list",
}
ARTICLE_NAMES = "prose story-body richtext markdown-body entry-content article-text post-body longread body-copy lead intro chapter".split()


def labelled_pages(number: int = 600, seed: int = 5) -> list[tuple[str, list[bool]]]:
    """Training pages of our own making, with the label of each leaf block (true: main text).

    Layouts mix semantic and plain elements, and put notices, adverts, forms and reader comments before, after and inside the article.
    """
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(1, 9)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    pages = []
    for _ in range(number):
        labels: list[bool] = []

        def leaf(tag: str, text: str, label: bool, attributes: str = "") -> str:
            labels.append(label)
            return f"<{tag}{attributes}>{text}</{tag}>"

        def links(n: int, label: bool = False) -> str:
            return "".join(leaf("li", f'<a href="/{word()}">{words(1, 4)}</a>', label) for _ in range(n))

        def boiler(kind: str) -> str:
            tag = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}.get(kind, "div")
            plain = rng.random() < 0.4 or kind in ("ad", "comment", "notice")
            if plain:
                names, other = ZONE_WORDS[kind].split(), rng.random()
                name = f"{rng.choice(['', 'site-', 'page-', 'x-'])}{rng.choice(names)}" if other < 0.65 else f"{rng.choice(names)}-{word()}" if other < 0.8 else rng.choice(OTHER_NAMES[kind].split())
                tag, attributes = rng.choice(["div", "section", "div"]), f' {rng.choice(["class", "id"])}="{name}"'
            else:
                attributes = ""
            if kind in ("nav", "side") and rng.random() < 0.8:
                head = leaf("h3", words(1, 3), False) if rng.random() < 0.4 else ""
                body = head + f"<ul>{links(rng.randint(2, 7))}</ul>"
            elif kind == "footer":
                body = leaf("p", ("© " if rng.random() < 0.7 else "") + words(2, 12), False) + (f"<ul>{links(3)}</ul>" if rng.random() < 0.4 else "")
            elif kind == "comment":
                body = (leaf("h3", words(1, 2), False) if rng.random() < 0.5 else "") + "".join(leaf("p", words(3, 60) + ".", False) for _ in range(rng.randint(1, 5)))
            elif kind == "form":
                body = leaf("label", words(1, 3), False).replace("label", "p") + "<input type=text>" + leaf("button", words(1, 2), False)
            else:
                body = leaf("p", words(2, 30) + rng.choice([".", "", "!"]), False) if rng.random() < 0.6 else ""
                if not body:
                    labels.append(False)
                    return f"<{tag}{attributes}>{words(2, 25)}{rng.choice(['.', ''])}</{tag}>"
            return f"<{tag}{attributes}>{body}</{tag}>"

        def named(zones: list[str]) -> str:
            """A name as authors give parts of an article, with words that also stand for other parts of a page."""
            part = rng.choice(ZONE_WORDS[rng.choice(zones)].split())
            return rng.choice([f"{part}-{word()}", f"{word()}-{part}", f"{word()} {part}", word()])

        soft = sorted(SOFT_ZONES)

        def main() -> str:
            body = leaf("h1", words(1, 12), True, f' class="{named(soft)}"' if rng.random() < 0.15 else "") if rng.random() < 0.8 else ""
            headed = body and rng.random() < 0.3
            if headed:
                body += leaf("p", words(2, 12), True) if rng.random() < 0.3 else ""
                body = f"<header>{body}</header>" if rng.random() < 0.5 else f'<div class="{rng.choice(["header", "post-header", "article-header", "entry-header", "page-header"])}">{body}</div>'
            for _ in range(rng.randint(1, 12)):
                r = rng.random()
                if r < 0.60:
                    text = words(1, 90 if rng.random() < 0.8 else 4) + rng.choice([".", ".", ".", " |", "", "!", ":"])
                    if rng.random() < 0.2:
                        text = f'{words(1, 20)} <a href="#">{words(1, 5)}</a> {text}'
                    body += leaf("p", text, True, f' class="{rng.choice(["lead", "intro", named(soft), named(soft)])}"' if rng.random() < 0.12 else "")
                elif r < 0.65:
                    part = leaf("h2", words(1, 6), True) + "".join(leaf("p", words(4, 60) + ".", True) for _ in range(rng.randint(1, 3)))
                    body += f'<{(tag := rng.choice(["section", "section", "div"]))} {rng.choice(["class", "id"])}="{named(soft)}">{part}</{tag}>'
                elif r < 0.67:
                    body += leaf("p", rng.choice(["All rights reserved.", f"Copyright 2020 {words(1, 3)}", f"© {words(1, 3)}", f"{words(2, 9)} (c) 1999"]), True)
                elif r < 0.73:
                    body += leaf(rng.choice(["h2", "h3"]), words(1, 8), True, f' {rng.choice(["id", "class"])}="{named(soft)}"' if rng.random() < 0.3 else "")
                elif r < 0.80:
                    body += "<ul>" + "".join(leaf("li", words(1, 20), True) for _ in range(rng.randint(1, 4))) + "</ul>"
                elif r < 0.84:
                    body += leaf("blockquote", words(3, 40), True)
                elif r < 0.87:
                    body += "<table><tr>" + "".join(leaf("td", words(1, 4), True) for _ in range(3)) + "</tr></table>"
                elif r < 0.97:
                    body += boiler(rng.choice(["ad", "side", "form", "notice", "ad"]))
            if rng.random() < 0.25:
                body += boiler("comment")
            style = rng.random() * (0.6 if headed else 1)  # only an article's own header is known from the site's
            if style < 0.45:
                return f"<article{rng.choice(['', '', '', ' class=with-sidebar'])}>{body}</article>"
            if style < 0.6:
                return f"<main>{body}</main>"
            if style < 0.9:
                return f'<div {rng.choice(["class", "id"])}="{rng.choice(["", "post-", "entry-", "page-"])}{rng.choice(["content", "article", "body", "main", "text"])}">{body}</div>' if rng.random() < 0.7 else f'<div class="{rng.choice(ARTICLE_NAMES)}">{body}</div>'
            return f"<div>{body}</div>" if rng.random() < 0.5 else body

        before = [boiler(k) for k in rng.sample(["nav", "header", "notice", "ad", "form", "side"], rng.randint(0, 4))]
        middle = main()
        if rng.random() < 0.1:  # names that mislead
            middle = f'<div class="{rng.choice([x for z in sorted(SOFT_ZONES) for x in ZONE_WORDS[z].split()])}">{middle}</div>'
        after = [boiler(k) for k in rng.sample(["side", "comment", "ad", "form", "footer", "nav", "footer"], rng.randint(0, 4))]
        if rng.random() < 0.15:  # a last line without a footer
            year = rng.randint(1996, 2030)
            after.append(leaf(rng.choice(["p", "div"]), rng.choice([f"Copyright {year} {words(1, 4)}", f"© {year}", f"(c) {year} {words(1, 3)}", f"Copyright © {year}", f"{words(1, 3)} All rights reserved."]), False))
        pages.append((f"<html><head><title>{word()}</title></head><body>{''.join(before)}{middle}{''.join(after)}</body></html>", labels))
    return pages


class Chain:
    """Two labels, weights by feature and by pair of neighbouring labels."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, starts: np.ndarray):
        self.weights, self.transitions, self.starts = weights, transitions, starts

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The most likely labels (Viterbi); a tie keeps the text."""
        if not blocks:
            return []
        w, t, s = self.weights, self.transitions.tolist(), self.starts.tolist()
        scores = [w[features(b)].sum(axis=0).tolist() for b in blocks]
        no, yes = scores[0][0] + s[0], scores[0][1] + s[1]
        back = []
        for s0, s1 in scores[1:]:
            a, b = no + t[0][0], yes + t[1][0]
            c, d = no + t[0][1], yes + t[1][1]
            back.append((b >= a, d >= c))
            no, yes = max(a, b) + s0, max(c, d) + s1
        label = bool(yes >= no)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def marginals(score: np.ndarray, transitions: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once: probabilities of the labels and of neighbouring pairs, and the log of the sum over all labellings.

    ``score`` is (chain, place, label), what starts a chain included; ``mask`` tells the places that a chain has, from its first on.
    """
    log_sum = lambda v, axis: np.log(np.exp(v - v.max(axis=axis, keepdims=True)).sum(axis=axis)) + v.max(axis=axis)
    alpha, beta = np.zeros_like(score), np.zeros_like(score)
    alpha[:, 0] = score[:, 0]
    for k in range(1, score.shape[1]):
        alpha[:, k] = np.where(mask[:, k, None], log_sum(alpha[:, k - 1, :, None] + transitions, 1) + score[:, k], alpha[:, k - 1])
    for k in range(score.shape[1] - 2, -1, -1):
        beta[:, k] = np.where(mask[:, k + 1, None], log_sum(transitions + (score[:, k + 1] + beta[:, k + 1])[:, None, :], 2), 0)
    total = log_sum(alpha[:, -1], 1)
    node = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
    joint = np.exp(alpha[:, :-1, :, None] + transitions + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
    return node, joint, total


def fit(pages: list[tuple[str, list[bool]]], rounds: int = 150, rate: float = 0.3, decay: float = 2e-4) -> Chain:
    """Maximise the conditional likelihood of the labels: forward-backward over all pages at once, AdaGrad steps."""
    chains = [([features(b) for b in leaf_blocks(page)], labels) for page, labels in pages]
    chains = [(f, y) for f, y in chains if len(f) == len(y) and f]
    n, longest = len(chains), max(len(f) for f, _ in chains)
    y = np.zeros((n, longest), int)
    mask = np.zeros((n, longest), bool)
    places, columns = [], []
    for i, (f, labels) in enumerate(chains):
        for k, on in enumerate(f):
            places += [i * longest + k] * len(on)
            columns += on
        y[i, : len(f)], mask[i, : len(f)] = labels, True
    place, column = np.array(places), np.array(columns)
    one = np.eye(2)[y] * mask[..., None]
    w, t, s = np.zeros((len(FEATURES), 2)), np.zeros((2, 2)), np.zeros(2)
    memory = [np.full_like(v, 1e-8) for v in (w, t, s)]
    pairs = mask[:, 1:, None, None] * np.einsum("nka,nkb->nkab", one[:, :-1], one[:, 1:])
    both = lambda at, values, size: np.stack([np.bincount(at, weights=values[:, k], minlength=size) for k in (0, 1)], axis=1)
    for _ in range(rounds):
        score = both(place, w[column], n * longest).reshape(n, longest, 2)
        score[:, 0] += s
        node, joint, _ = marginals(score, t, mask)
        steps = [both(column, (one - node).reshape(-1, 2)[place], len(FEATURES)) / n - decay * w, (pairs - joint).sum(axis=(0, 1)) / n - decay * t, (one - node)[:, 0].sum(axis=0) / n]
        for v, g, m in zip((w, t, s), steps, memory):
            m += g * g
            v += rate * g / np.sqrt(m)
    return Chain(w, t, s)


def main_text(chain: Chain, page: str) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, keep in zip(blocks, chain.decode(blocks)) if keep)


def extract(df: DataFrame, html_column: str = "html", chain: Chain | None = None) -> DataFrame:
    """Add ``text``, the main text of each whole page, blocks in page order joined by a line feed.

    Null and empty pages, and pages without main text, give an empty text; repeated rows are read each by itself; labellings that tie keep the text.  The field is trained on ``labelled_pages`` unless one is given;
    its weights, a fixed number, go to the tasks.  A column named ``text`` is replaced.
    """
    chain = chain or fit(labelled_pages())
    df = df.drop("text")
    schema = T.StructType([*df.schema.fields, T.StructField("text", T.StringType(), False)])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(chain, x or "") for x in batch.column(html_column).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

        return step

    return map_blocks(df, html_column, make, schema)


def op9_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
