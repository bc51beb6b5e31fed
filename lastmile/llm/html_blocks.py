"""Leaf blocks of a page's DOM with features of their ancestors and text."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Elements whose content is no markup, other elements whose content is left out, elements
# that end a block, and void ones.
RAW = frozenset("script style textarea title iframe".split())
SKIPPED = frozenset("noscript template svg head object canvas select button audio video".split())
IN_HEAD = frozenset("base link meta noscript template".split()) | RAW  # any other element ends an open head
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody"
    " td tfoot th thead tr ul".split()
)
FLOW = frozenset("article aside blockquote dl footer form header main nav ol p section table ul".split())
# Elements without an end tag are ended by these start tags, which cannot be inside them.
NOT_INSIDE = {"button": FLOW | {"button"}, "select": BLOCK - {"hr"} | {"select"}, "svg": BLOCK}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INSIDE = (BLOCK | SKIPPED | {"foreignobject"}) - VOID  # counted inside an element that is left out
CLOSED_BY = {  # an open element that a start tag of the named kinds ends
    "p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
}
ANCESTORS = (
    "article main section nav header footer aside form fieldset ul ol dl li table td th blockquote pre figure"
    " figcaption address div p h1 h2 h3 h4 h5 h6 body center menu dialog details"
).split()
# Name parts that page authors use for class and id, by what they mark.
NAMES = {
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner dfp adsense partner",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay paywall disclaimer",
    "comment": "comment comments commentlist reply replies respond disqus discussion reader feedback",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs topbar toolbar pager pagination tabs links skip",
    "side": "sidebar side aside rail widget related recommended more popular trending latest teaser",
    "share": "share sharing social follow tweet facebook newsletter subscribe subscription signup login search",
    "foot": "footer foot copyright legal credits colophon bottom",
    "head": "header head masthead logo brand top",
    "content": "content article post entry story body text main page prose markdown single",
    "meta": "meta byline author date time tags tag category",
}
NAME_OF = {part: kind for kind, parts in NAMES.items() for part in parts.split()}
# Phrases of page furniture, looked for in lower case between blanks.
PHRASES = {
    "rights": ("©", "(c)", "copyright", "all rights reserved", "alle rechte", "tous droits", "derechos reservados"),
    "cookies": ("cookie", "consent", "privacy policy", "datenschutz", "terms of use", "terms of service"),
    "signup": ("subscribe", "sign up", "sign in", "log in", "newsletter", "register", "follow us", "your e-mail", "your email"),
    "advert": ("advertisement", "sponsored", "anzeige", "publicit", "publicidad", "buy now", "shop now"),
    "reply": (" reply", " replies", " comment", "posted by", "says:", " ago ", "antworten", "répondre", "responder"),
    "more": ("read more", " related ", "share this", " next ", " previous ", "back to top", "skip to", " home ", " menu "),
}
FOREIGN = frozenset(["svg", "math"])  # only these may end themselves with a slash

FEATURES = {
    name: i
    for i, name in enumerate(
        [f"in {t}" for t in ANCESTORS] + [f"leaf {t}" for t in ANCESTORS] + [f"named {k}" for k in NAMES]
        + [f"leaf named {k}" for k in NAMES] + [f"says {k}" for k in PHRASES]
        + [f"words {k}" for k in range(9)] + [f"links {k}" for k in range(5)] + [f"short says {k}" for k in PHRASES]
        + ["ends sentence", "has comma", "no letters", "upper", "first", "last", "many marks", "article and named", "bias"]
    )
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
MARKS = re.compile("[|»›·•/]")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    text: str
    features: list[int]


def _names(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    found = set()
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        found.update(NAME_OF.get(p.lower(), "") for p in PART.findall(a or b or c))
    return frozenset(found - {""})


def _text_features(text: str, link_share: float) -> list[str]:
    words = text.split(" ")
    count = len(words)
    out = [f"words {min(count.bit_length(), 8)}", f"links {min(int(link_share * 5), 4)}"]
    whole = f" {text.lower()} "
    said = [k for k, phrases in PHRASES.items() if any(p in whole for p in phrases)]
    out += [f"says {k}" for k in said]
    if count <= 12:
        out += [f"short says {k}" for k in said]
    if text[-1] in ".!?…。\"”»":
        out.append("ends sentence")
    if "," in text:
        out.append("has comma")
    if text.upper() == text.lower():
        out.append("no letters")
    if count > 1 and text.isupper():
        out.append("upper")
    if count > 2 and len(MARKS.findall(text)) > count / 4:
        out.append("many marks")
    return out


def blocks(html: str | None) -> list[Block]:
    """The page's text blocks in order; white space is single, references are decoded.

    Elements left open end where their parents do. Open elements are kept as counts of
    their features, so deep nesting costs no more than shallow.
    """
    html = html or ""
    stack: list[tuple[str, frozenset[str]]] = []
    within: dict[str, int] = {}
    depth: dict[str, int] = {}
    out: list[tuple[str, list[str]]] = []
    pieces: list[str] = []
    linked = 0
    link_open = False
    skipping: list[str] = []  # an element that is left out and those open in it

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(pieces)).split()) if pieces else ""
        if text:
            tag, names = stack[-1] if stack else ("body", frozenset())
            names_in = [k for k in within if k.startswith("named ")]
            features = [*within, *[f"leaf named {k}" for k in names], *_text_features(text, linked / len(text))]
            if f"leaf {tag}" in FEATURES:
                features.append(f"leaf {tag}")
            if depth.get("article") and names_in:
                features.append("article and named")
            out.append((text, features))
        pieces.clear()
        linked = 0

    def change(tag: str, names: frozenset[str], by: int) -> None:
        depth[tag] = depth.get(tag, 0) + by
        for key in [f"in {tag}"] * (f"in {tag}" in FEATURES) + [f"named {n}" for n in names]:
            left = within.get(key, 0) + by
            if left:
                within[key] = left
            else:
                within.pop(key, None)

    def close() -> None:
        tag, names = stack.pop()
        change(tag, names, -1)

    def add(text: str) -> None:
        nonlocal linked
        if skipping == ["head"] and text.strip():
            skipping.clear()
        if skipping:
            return
        pieces.append(text)
        if link_open:
            linked += len(text.strip())

    at = 0
    while at < len(html):
        token = TOKEN.search(html, at)
        if token is None:
            add(html[at:])
            break
        if token.start() > at:
            add(html[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        closing, tag = token[1], token[2].lower()
        if tag in RAW:
            if not closing:
                # A slash does not end these. Where one has a slash and no end tag, it was meant to.
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                if end or not token[3].endswith("/"):
                    at = end.end() if end else len(html)
            pieces.append(" ")
            continue
        if skipping:
            if closing and tag in skipping:
                while skipping.pop() != tag:
                    pass
                continue
            if (
                depth.get(tag) if closing  # left open where its parent ends
                else tag == "body" or tag in NOT_INSIDE.get(skipping[-1], ()) or skipping[-1] == "head" and tag not in IN_HEAD
            ):
                skipping.clear()
            else:
                if not closing and tag in INSIDE and not (tag in FOREIGN and token[3].endswith("/")):
                    skipping.append(tag)
                continue
        if tag in SKIPPED:
            if not closing and not (tag in FOREIGN and token[3].endswith("/")) and not (tag == "head" and depth.get("body")):
                skipping.append(tag)
            pieces.append(" ")
            continue
        if tag == "a":
            link_open = not closing
        elif tag == "br":
            pieces.append(" ")
        if tag not in BLOCK:
            continue
        flush()
        link_open = link_open and not closing
        if closing:
            if depth.get(tag):
                while stack[-1][0] != tag:
                    close()
                close()
        else:
            while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                close()
            if tag not in VOID:
                names = _names(token[3])
                stack.append((tag, names))
                change(tag, names, 1)
    flush()
    last = len(out) - 1
    result = []
    for i, (text, names) in enumerate(out):
        ends = ["first"] * (i <= last * 0.1) + ["last"] * (i >= last * 0.9)
        result.append(Block(text, sorted({FEATURES[f] for f in (*names, *ends, "bias")})))
    return result
