"""Labelled training pages: layouts as site authors write them, with random words."""

from __future__ import annotations

import random

SYLLABLES = "the an er on ti ing re st en ha ed to or as is le de la ion que ment os ado ci der ein sch ung ver lo ma no ra si ta vi".split()
SAID = {
    "ad": ["Advertisement", "Sponsored", "Buy now and save", "Anzeige"],
    "cookie": ["We use cookies to improve your visit.", "By continuing you accept our privacy policy.", "Accept cookies"],
    "foot": ["&copy; 2024 {w}. All rights reserved.", "&copy; {w}.example.com &middot; {s}", "Copyright {w}", "Terms of use", "Imprint"],
    "form": ["Subscribe to our newsletter", "Enter your e-mail", "Sign up", "Search", "Log in"],
    "comment": ["{w} says:", "Posted by {w} 3 days ago", "Reply", "5 comments", "{s}"],
    "share": ["Share this", "Follow us", "Tweet", "Read more", "Next", "Previous"],
}


class PageMaker:
    """Pages as pieces of HTML, each with the labels of its leaf blocks (1: article)."""

    def __init__(self, seed: int) -> None:
        self.rnd = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rnd.choice(SYLLABLES) for _ in range(self.rnd.randint(1, 4)))

    def sentence(self, low: int = 4, high: int = 18) -> str:
        words = [self.word() for _ in range(self.rnd.randint(low, high))]
        if len(words) > 6 and self.rnd.random() < 0.5:
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + "."

    def prose(self) -> str:
        if self.rnd.random() < 0.15:
            return self.sentence(1, 4)
        if self.rnd.random() < 0.08:  # odd article text: tables of words, shouting
            return " | ".join(self.word() for _ in range(self.rnd.randint(3, 30)))
        text = " ".join(self.sentence() for _ in range(self.rnd.randint(1, 8)))
        if self.rnd.random() < 0.04:  # articles may speak of such things
            text += " " + self.say(self.rnd.choice(list(SAID)))
        return text.upper().replace(" ", "!! ") if self.rnd.random() < 0.05 else text

    def say(self, kind: str) -> str:
        return self.rnd.choice(SAID[kind]).format(w=self.word(), s=self.sentence(3, 12))

    def wrap(self, tag: str, name: str, inner: str) -> str:
        how = self.rnd.choice(["class", "id", "none"]) if tag != "div" else self.rnd.choice(["class", "class", "id"])
        return f"<{tag}>{inner}</{tag}>" if how == "none" else f'<{tag} {how}="{name}">{inner}</{tag}>'

    def links(self, count: int) -> str:
        return "".join(f'<li><a href="/{i}">{self.word()}</a></li>' for i in range(count))

    def article(self) -> tuple[str, list[int]]:
        parts, labels = [f"<h1>{self.sentence(2, 12)}</h1>"], [1]
        if self.rnd.random() < 0.2:
            parts.append(self.wrap("div", self.rnd.choice(["share-bar", "social"]), f"<a>{self.say('share')}</a>"))
            labels.append(0)
        for _ in range(self.rnd.randint(1, 14)):
            kind = self.rnd.random()
            if kind < 0.72:
                end = "</p>" if self.rnd.random() < 0.8 else ""
                bold = self.rnd.choice(["", "", "<b>", "<em>"])
                link = f' <a href="x">{self.word()}</a> ' if self.rnd.random() < 0.2 else ""
                tag = "p" if self.rnd.random() < 0.93 else "div"
                end = end if tag == "p" else "</div>"
                parts.append(f"<{tag}>{bold}{self.prose()}{link}{self.rnd.choice(['', '<br>'])}{end}")
                labels.append(1)
            elif kind < 0.8:
                parts.append(f"<h{(n := self.rnd.randint(2, 4))}>{self.sentence(1, 7)[:-1]}</h{n}>")
                labels.append(1)
            elif kind < 0.86:
                n = self.rnd.randint(2, 5)
                parts.append("<ul>" + "".join(f"<li>{self.sentence(2, 12)}</li>" for _ in range(n)) + "</ul>")
                labels += [1] * n
            elif kind < 0.9:
                parts.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
                labels.append(1)
            elif kind < 0.93:
                n = self.rnd.randint(1, 3)
                parts.append("<table>" + f"<tr><td>{self.word()}</td><td>{self.sentence(1, 5)}</td></tr>" * n + "</table>")
                labels += [1, 1] * n
            elif kind < 0.95:
                parts.append(f"<figure><img><figcaption>{self.sentence(3, 10)}</figcaption></figure>")
                labels.append(1)
            else:
                parts.append(self.wrap("div", self.rnd.choice(["ad", "advert", "ad-slot", "promo"]), self.rnd.choice([self.sentence(), self.say("ad")])))
                labels.append(0)
        return "".join(parts), labels

    def comments(self) -> tuple[str, list[int]]:
        n, out, labels = self.rnd.randint(1, 4), "", []
        if self.rnd.random() < 0.6:
            out, labels = f"<h3>{self.rnd.choice(['Comments', '3 comments', 'Discussion'])}</h3>", [0]
        for _ in range(n):
            tag = self.rnd.choice(["li", "div", "article"])
            body = f"<p>{self.say('comment')}</p><p>{self.prose()}</p>" if self.rnd.random() < 0.6 else f"<p>{self.prose()}</p>"
            out += f'<{tag} class="{self.rnd.choice(["comment", "comment-body", "reply"])}">{body}</{tag}>'
            labels += [0] * body.count("<p>")
        return self.wrap(self.rnd.choice(["section", "div"]), self.rnd.choice(["comments", "reader-comments", "respond"]), out), labels

    def furniture(self, kind: str) -> tuple[str, list[int]]:
        rnd, n = self.rnd, self.rnd.randint(2, 8)
        if kind == "nav":
            return self.wrap(rnd.choice(["nav", "nav", "div"]), rnd.choice(["menu", "nav", "navbar"]), f"<ul>{self.links(n)}</ul>"), [0] * n
        if kind == "header":
            return self.wrap("header", rnd.choice(["header", "masthead", "top"]), f"<div>{self.sentence(1, 5)[:-1]}</div><p>{self.sentence(2, 9)}</p>"), [0, 0]
        if kind == "ad":
            text = rnd.choice([self.sentence(3, 20), self.prose(), self.say("ad")])
            return self.wrap("div", rnd.choice(["ad", "ads", "advert", "ad-banner", "sponsored", "promo"]), text), [0]
        if kind == "cookie":
            return self.wrap(rnd.choice(["div", "section"]), rnd.choice(["cookie-notice", "consent", "notice", "gdpr-banner", "box", "row"]), f"<p>{rnd.choice(['', '', self.prose()])} {self.say('cookie')} {rnd.choice(['', self.sentence()])}</p>"), [0]
        if kind == "aside":
            inner = f"<h4>{rnd.choice(['Related', 'Popular', self.sentence(1, 3)])}</h4><ul>{self.links(n)}</ul><p>{self.prose()}</p>"
            return self.wrap(rnd.choice(["aside", "aside", "div"]), rnd.choice(["sidebar", "related", "widget"]), inner), [0] * (n + 2)
        if kind == "form":
            return f'<form action="/s"><p>{self.say("form")}</p><label>{self.sentence(1, 4)}</label><input></form>', [0, 0]
        inner = rnd.choice([
            self.say("foot"), f"{self.say('foot')} {self.sentence()}", self.prose(), f"<p>{self.say('foot')}</p>",
            f"<p>{self.prose()} {self.say('foot')}</p>",
        ])
        return self.wrap(rnd.choice(["footer", "footer", "div"]), rnd.choice(["footer", "copyright", "legal"]), inner), [0]

    def page(self) -> tuple[str, list[int]]:
        rnd = self.rnd
        top = [k for k, p in (("header", 0.4), ("nav", 0.8), ("cookie", 0.3), ("ad", 0.5)) if rnd.random() < p]
        low = [k for k, p in (("ad", 0.3), ("aside", 0.4), ("form", 0.3), ("nav", 0.2)) if rnd.random() < p]
        rnd.shuffle(top)
        rnd.shuffle(low)
        pieces = [self.furniture(k) for k in top]
        body, labels = self.article()
        if rnd.random() < 0.2:
            body = self.wrap(rnd.choice(["section", "div"]), rnd.choice(["chapter", "part", "inner", "text"]), body)
        style = rnd.random()
        if style < 0.5:
            body = f"<article>{body}</article>"
        elif style < 0.7:
            body = f"<main><article>{body}</article></main>" if rnd.random() < 0.5 else f"<main>{body}</main>"
        elif style < 0.95:
            body = self.wrap("div", rnd.choice(["content", "post", "entry-content", "article-body", "story", "text", "page"]), body)
        pieces.append((body, labels))
        if rnd.random() < 0.35:
            pieces.append(self.comments())
        pieces += [self.furniture(k) for k in low]
        if rnd.random() < 0.9:
            pieces.append(self.furniture("footer"))
        inner = "".join(p for p, _ in pieces)
        if rnd.random() < 0.3:
            inner = self.wrap("div", rnd.choice(["wrapper", "page", "container"]), inner)
        head = f"<head><title>{self.word()}</title><style>p{{margin:0}}</style><script>x('<p>')</script></head>"
        return f"<!DOCTYPE html><html>{head}<body><!-- {self.word()} -->{inner}</body></html>", [x for _, ls in pieces for x in ls]


def labelled_pages(count: int, seed: int = 3) -> list[tuple[str, list[int]]]:
    maker = PageMaker(seed)
    return [maker.page() for _ in range(count)]
