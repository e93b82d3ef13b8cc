"""Web pages to text blocks, each with the part of the page it belongs to."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

ARTICLE, MAIN, REST, NOISE = "article", "main", "rest", "noise"

TAG = re.compile(
    r"<(?:!--(?P<comment>.*?(?:-->|\Z))|[!?][^>]*(?:>|\Z)"
    r"|(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>)", re.S)
UNQUOTED = re.compile(r"<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>[^>]*)(?:>|\Z)")
OPENS = re.compile(r"<(?=[a-zA-Z/!?])")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![\w-])(hidden)(?![\w=-])", re.I)

# Elements by their role in a page.
RAW = frozenset("script style textarea title noscript iframe xmp".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
NOISE_ELEMENTS = frozenset(
    "script style noscript template iframe nav footer aside button select textarea menu dialog head title "
    "svg canvas object audio video map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert advertisement adverts sponsor sponsored promo promotion banner nav navbar navigation menu sidebar "
    "footer masthead breadcrumb breadcrumbs cookie cookies consent notice notices gdpr popup modal newsletter "
    "subscribe signup login share sharing social comment comments disqus respond replies related recommended "
    "widget toolbar pagination pager hidden".split())
ENDS_P = BLOCK - {"html", "body", "head"}
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
            "th": {"td", "th", "tr"}, "option": {"option"}, "p": ENDS_P}
HOLDS = frozenset("article main section div td th li table ul ol body html aside nav footer header form blockquote".split())


@dataclass
class Block:
    text: str
    part: str
    linked: float  # share of the characters inside links


def _is_noise(name: str, rest: str, inside: bool) -> bool:
    """By what the element is or says of itself; nothing inside it is main text."""
    if name in NOISE_ELEMENTS or name == "header" and not inside:
        return True
    if not rest.strip() or name in ("html", "body", "article", "main"):
        return False
    for key, double, single, bare, hidden in ATTRIBUTE.findall(rest):
        key, value = key.lower(), (double or single or bare).lower()
        if hidden or key == "aria-hidden" and value == "true" or key == "role" and value in NOISE_ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _looks_noisy(name: str, rest: str, inside: bool) -> bool:
    """By the words of its class or id, or as a form: this counts unless most of the page is inside."""
    if name == "form":
        return True
    if not rest.strip() or name in ("html", "body", "main"):
        return False
    for key, double, single, bare, _ in ATTRIBUTE.findall(rest):
        if key.lower() in ("class", "id"):
            words = set(re.split(r"[\W_]+", (double or single or bare).lower()))
            if name == "article":
                if words & {"comment", "comments"}:
                    return True
            elif words & NOISE_WORDS or "header" in words and not inside:
                return True
    return False


class _Reader:
    def __init__(self):
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, str, tuple[int, ...]]] = []
        self.part = REST
        self.noisy: tuple[int, ...] = ()  # the elements around that look like noise
        self.around: list[tuple[int, ...]] = []  # the same for each block
        self.opened = 0
        self.parts: list[str] = []
        self.links = self.link_chars = 0

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.links:
                self.link_chars += len(raw)

    def flush(self) -> None:
        if self.parts:
            raw = "".join(self.parts)
            body = " ".join(html.unescape(raw).split())
            if body:
                self.blocks.append(Block(body, self.part, self.link_chars / len(raw)))
                self.around.append(self.noisy)
        self.parts, self.link_chars = [], 0

    def _close(self, at: int) -> None:
        self.links -= sum(name == "a" for name, *_ in self.stack[at:])
        del self.stack[at:]
        _, self.part, self.noisy = self.stack[-1] if self.stack else ("", REST, ())

    def open(self, name: str, rest: str) -> None:
        if name in BLOCK:
            self.flush()
        elif name == "br":
            self.text(" ")
        for at in range(len(self.stack) - 1, -1, -1):
            other = self.stack[at][0]
            if name in ENDED_BY.get(other, ()):
                self._close(at)
                break
            if other in HOLDS:
                break
        if name in EMPTY:
            return
        part, noisy = self.part, self.noisy
        if part != NOISE:
            if _looks_noisy(name, rest, part == ARTICLE):
                self.opened += 1
                noisy = (*noisy, self.opened)
            if _is_noise(name, rest, part == ARTICLE):
                part = NOISE
            elif name == ARTICLE or name == MAIN and part != ARTICLE:
                part = name
        if not rest.endswith("/") or name in BLOCK:
            self.stack.append((name, part, noisy))
            self.links += name == "a"
            self.part, self.noisy = part, noisy

    def close(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == name:
                self._close(at)
                break


    def judge(self) -> None:
        """What looks like noise is noise, but for elements around more than half of the page's text."""
        total, inside = 0, Counter()
        for block, noisy in zip(self.blocks, self.around):
            if block.part != NOISE:
                total += len(block.text)
                inside.update(dict.fromkeys(noisy, len(block.text)))
        for block, noisy in zip(self.blocks, self.around):
            if any(2 * inside[n] <= total for n in noisy):
                block.part = NOISE


def read_blocks(page: str) -> list[Block]:
    """The visible blocks of a page in their order. A page that breaks off ends where it does."""
    reader, at, end = _Reader(), 0, len(page)
    while at < end:
        opens = OPENS.search(page, at)
        if not opens:
            reader.text(page[at:])
            break
        reader.text(page[at : opens.start()])
        tag = TAG.match(page, opens.start()) or UNQUOTED.match(page, opens.start())
        if not tag:  # "</" or "<!" before something else
            reader.text(page[opens.start()])
            at = opens.start() + 1
            continue
        at = tag.end()
        name = tag.groupdict().get("name")
        if not name or page[at - 1] != ">":
            continue
        name = name.lower()
        if tag["end"]:
            reader.close(name)
            continue
        reader.open(name, tag["rest"])
        if name in RAW:
            closing = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = closing.start() if closing else end
    reader.flush()
    reader.judge()
    return reader.blocks
