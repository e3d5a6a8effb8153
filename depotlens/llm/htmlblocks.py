"""HTML to leaf blocks: texts between block-level tags, each with its path of tags and class words."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# HTML element names by what they do to text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW_TAGS = frozenset("button iframe math noframes noscript object script select style svg template textarea title".split())
TO_THE_END = frozenset("iframe noframes script style textarea title".split())  # raw text: without an end tag they take the rest of the page
ONE_OPEN = frozenset("button select".split())  # a second start tag ends the first
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())  # any other tag ends the head
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table body html div article section main nav aside header footer form menu".split())

_TOKEN = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""")
_NAMED = re.compile(r"""\b(class|id|role|data-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, ...], ...]  # per open element: its tag, then its class, id and role words
    link_share: float
    label: str  # innermost data-label, used on training pages only


def _element(tag: str, attributes: str) -> tuple[tuple[str, ...], str]:
    tokens, label = [tag], ""
    if attributes:
        for name, value in _NAMED.findall(attributes):
            value = value.strip("\"'").lower()
            if name.lower() == "data-label":
                label = value
            else:
                tokens += ["." + w for w in _WORD.findall(value)[:8]]
    return tuple(tokens), label


def _tag(m: re.Match) -> tuple[str, str, str]:
    """(slash of an end tag, lower-case name, attributes) of a token; an empty name for what is no tag."""
    closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
    return closing, (tag or "").lower(), attributes


_COMMENT_END = re.compile(r"--!?>")


def _comment_end(page: str, at: int) -> int:
    """Where the comment whose ``<!--`` ends at ``at`` ends; an unclosed one takes the rest of the page."""
    for closed_at_once in (">", "->"):
        if page.startswith(closed_at_once, at):
            return at + len(closed_at_once)
    m = _COMMENT_END.search(page, at)
    return len(page) if m is None else m.end()


def _text_end(page: str, tag: str, at: int) -> int:
    """Where the raw text that starts at ``at`` ends, its end tag included."""
    close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
    return len(page) if close is None else close.end()


def _left_out(page: str) -> tuple[dict[int, int], set[int]]:
    """{end of the start tag: end of the element} of the RAW_TAGS elements that are closed before an element around
    them, and the ends of the start tags of custom elements that hold a block (the others run on in their line)."""
    at = 0
    found: dict[int, int] = {}
    blocks: set[int] = set()
    custom: list[int] = []  # start tags of the open custom elements that hold no block yet
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}

    def close(tag: str) -> int:
        while True:
            name, begin = stack.pop()
            opened[name] -= 1
            if custom and custom[-1] == begin:
                custom.pop()
            if name == tag:
                return begin

    while (m := _TOKEN.search(page, at)) is not None:
        at = m.end()
        if m[0] == "<!--":
            at = _comment_end(page, at)
            continue
        closing, tag, attributes = _tag(m)
        if not closing and tag in BLOCK_TAGS:
            blocks.update(custom)
            custom.clear()
        if closing:
            if opened.get(tag):
                begin = close(tag)
                if tag in RAW_TAGS:
                    found[begin] = at
        elif tag and tag not in VOID_TAGS and not attributes.endswith("/"):
            if tag in TO_THE_END:
                at = _text_end(page, tag, at)
                continue
            if tag in ONE_OPEN and opened.get(tag):
                close(tag)
            stack.append((tag, at))
            opened[tag] = opened.get(tag, 0) + 1
            if "-" in tag:
                custom.append(at)
    return found, blocks


def leaf_blocks(page: str) -> list[Block]:
    """The non-empty text blocks of a page in order; scripts, styles, form controls, comments and the head are left out.

    The head ends at its end tag, at the first tag that cannot stand in it or at text. A form control, image or template that
    is not closed before an element around it loses its tag only.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], str]] = []
    pieces: list[str] = []
    linked = total = links = 0
    ahead: tuple[dict[int, int], set[int]] | None = None  # what stands further on, looked up once it is needed
    in_line: dict[str, int] = {}  # open custom elements without a block, by name
    in_head = False

    def flush() -> None:
        nonlocal linked, total
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                label = next((x for _, _, x in reversed(stack) if x), "")
                out.append(Block(text, tuple(e for _, e, _ in stack), linked / max(total, 1), label))
        linked = total = 0

    def end_head() -> None:
        nonlocal in_head
        if in_head:
            stack[:] = [e for e in stack if e[0] != "head"]
            in_head = False

    def add(text: str) -> None:
        nonlocal linked, total
        if not text.isspace():
            end_head()
        pieces.append(text)
        n = len(text.strip())
        total += n
        if links:
            linked += n

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[0] == "<!--":
            at = _comment_end(page, at)
            continue
        closing, tag, attributes = _tag(m)
        if not tag:
            continue
        if not closing and tag not in HEAD_TAGS:
            end_head()
        if tag == "br":
            pieces.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in RAW_TAGS:
            if not closing and not attributes.endswith("/"):
                if tag in TO_THE_END:
                    at = _text_end(page, tag, at)
                else:
                    ahead = ahead or _left_out(page)
                    at = ahead[0].get(at, at)
        elif tag in BLOCK_TAGS or "-" in tag:
            if "-" in tag:
                if closing and in_line.get(tag):
                    in_line[tag] -= 1
                    continue
                if not closing:
                    ahead = ahead or _left_out(page)
                    if at not in ahead[1]:
                        in_line[tag] = in_line.get(tag, 0) + (not attributes.endswith("/"))
                        continue
            flush()
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            else:
                if stack and stack[-1][0] == "p":
                    stack.pop()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in CLOSED_BY.get(tag, ()):
                        del stack[i:]
                        break
                    if stack[i][0] in SCOPES and stack[i][0] not in CLOSED_BY.get(tag, ()):
                        break
                if tag not in VOID_TAGS:
                    element, label = _element(tag, attributes)
                    stack.append((tag, element, label))
                    in_head = in_head or tag == "head"
    flush()
    return out
