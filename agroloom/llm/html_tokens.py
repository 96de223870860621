"""A page's markup as tokens: opened and closed elements by path, and blocks of text with their facts."""

from __future__ import annotations

import html
import re

import xxhash

#: Elements of the language by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp small "
    "span strike strong sub sup time tt u var nobr".split()
)
#: Elements whose content is no markup.
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes svg math canvas".split())
#: Elements that are no part of an article, wherever they stand.
OUTSIDE = frozenset(
    "head nav footer aside form button select option optgroup datalist menu dialog object audio video map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Words of a class or id that mark a part outside the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored banner promo promotion nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar aside widget widgets cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social related recommended comment comments commentlist reply replies respond disqus pagination pager toolbar skip "
    "copyright legal disclaimer".split()
)
#: A class or id that names the article, and one that names the part around it.
ARTICLE = frozenset(
    "article post entry story article-body article-content article-text post-body post-content entry-content story-body".split()
)
AROUND = frozenset("main content main-content page-content".split())
#: What an opening element ends: the names it closes, and those that it doesn't look beyond.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
    "article": ({"head", "nav"}, {"html"}),
    "main": ({"head", "nav"}, {"html"}),
}

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/<>]*)((?:[^<>\"']++|\"[^\"<]*\"|'[^'<]*')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/<>]*)([^<>]*)(?:>|\Z|(?=<))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAMING = re.compile(r"class|id\s*=|role|itemprop|hidden|style", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_END = {name: re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I) for name in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|$)", re.I)

#: Facts of a token: a text's length stands above the bits. An opened element has the level it stands in, too.
FIRST, TEXT, LINKED, HINTED, LEVEL_1, LEVEL_2 = 1, 2, 4, 8, 16, 32
LENGTH_SHIFT = 8
_SHUT, _IN_LINK = 64, 128  # while reading only: outside the article by its element; inside a link


def _named(attributes: str) -> tuple[str, int]:
    """What the attributes add to a path, and the bits that class, id, role and style set."""
    values = {}
    for match in _ATTRIBUTE.finditer(attributes):
        values.setdefault(match[1].lower(), next((v for v in match.groups()[1:] if v is not None), ""))
    names = [values.get("id", ""), *values.get("class", "").split()]
    label = re.sub(r"\d+", "0", " ".join(filter(None, [*names, values.get("role", ""), values.get("itemprop", "")])))
    bits = 0
    role = values.get("role", "").lower()
    if role in ROLES or _HIDDEN.search(values.get("style", "")) or values.get("aria-hidden", "") == "true":
        bits |= _SHUT
    if _BARE_HIDDEN.search(_ATTRIBUTE.sub(" ", attributes)) or values.get("hidden") is not None:
        bits |= _SHUT
    lower = {name.lower() for name in names}
    if lower & ARTICLE or values.get("itemprop", "").lower() == "articlebody":
        bits |= LEVEL_2
    elif lower & AROUND or role == "main":
        bits |= LEVEL_1
    elif any(word.lower() in HINTS for name in names for word in _WORD.findall(name)):
        bits |= HINTED
    return label, bits


class Reader:
    """Reads pages. What attributes say is kept between pages, in a bounded dictionary."""

    def __init__(self, most: int = 20_000):
        self.most = most
        self.attributes: dict[str, tuple[str, int]] = {}

    def named(self, attributes: str) -> tuple[str, int]:
        if not _NAMING.search(attributes):
            return "", 0
        found = self.attributes.get(attributes)
        if found is None:
            if len(self.attributes) >= self.most:
                self.attributes.clear()
            found = self.attributes[attributes] = _named(attributes)
        return found

    def read(self, page: str) -> list[tuple[int, int, str]]:
        """Tokens (hash, facts, text) in page order; the text of a tag is empty.

        An opened or closed element is told by its path of names, classes and ids. A block is the
        text between two borders of elements that aren't inline, with character references decoded and
        each white space as one space; parts outside the article by their element's name are left
        out. Unclosed elements end as browsers end them, at the latest with the page.
        """
        found: list[tuple[int, int, str]] = []
        seen: set[int] = set()
        stack: list[tuple[str, int, int]] = [("", 0, 0)]  # name, path, bits
        opened: dict[str, int] = {}
        parts: list[str] = []
        linked = 0
        rooted = False

        def emit(token: int, facts: int, text: str = "") -> None:
            if token not in seen:
                seen.add(token)
                facts |= FIRST
            found.append((token, facts, text))

        def flush() -> None:
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                parts.clear()
                if text:
                    _, path, bits = next(e for e in reversed(stack) if e[0] not in INLINE)
                    facts = bits & (HINTED | LEVEL_1 | LEVEL_2) | TEXT | len(text) << LENGTH_SHIFT
                    if 2 * linked > len(text):
                        facts |= LINKED
                    emit(xxhash.xxh64_intdigest(text, path ^ 1) - (1 << 63), facts, text)
            linked = 0

        def close(to: int) -> None:
            while len(stack) > to:
                name, path, _ = stack[-1]
                if name not in INLINE:
                    flush()
                    emit((path ^ 0x5BD1E995) - (1 << 63), 0)
                stack.pop()
                opened[name] -= 1

        def say(text: str) -> None:
            nonlocal linked
            bits = stack[-1][2]
            if not bits & _SHUT:
                text = html.unescape(text) if "&" in text else text
                parts.append(text)
                if bits & _IN_LINK:
                    linked += len(text)

        at = 0
        while True:
            mark = _MARK.search(page, at)
            if mark is None:
                say(page[at:])
                break
            if mark.start() > at:
                say(page[at : mark.start()])
            at = mark.end()
            name = mark[2] or mark[5]
            if not name:
                continue
            name = name.lower()
            if mark[1] or mark[4]:
                if not opened.get(name):
                    continue
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        close(k)
                        break
                    if name in INLINE and stack[k][0] not in INLINE:
                        break
                continue
            if name in VOID:
                if name in ("br", "hr", "img"):
                    say(" ")
                if name == "hr":
                    flush()
                continue
            if name in RAW:
                end = _END[name].search(page, at)
                at = len(page) if end is None else end.start()
                if end is not None:
                    at = page.find(">", at) + 1 or len(page)
                continue
            label, bits = self.named(mark[3] or mark[6] or "")
            _, path, above = stack[-1]
            if name in INLINE:
                if name == "a":
                    bits |= _IN_LINK
                if bits & HINTED:  # part of a line, which no template tells from the rest
                    bits |= _SHUT
                stack.append((name, path, above | bits & (_SHUT | _IN_LINK)))
                opened[name] = opened.get(name, 0) + 1
                continue
            flush()
            closes, within = _ENDS.get(name, ({"p"}, set()))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closes:
                    close(k)
                    if name not in ("tr", "tbody", "tfoot", "optgroup"):
                        break
                elif stack[k][0] in within or (not within and stack[k][0] not in INLINE):
                    break
            _, path, above = stack[-1]
            if name in ("html", "body"):
                bits = 0
            elif name in OUTSIDE or (name == "header" and not above & (LEVEL_1 | LEVEL_2)):
                bits |= _SHUT
            elif name == "article" and not bits & HINTED:
                bits |= LEVEL_2
            elif name == "main":
                bits |= LEVEL_1
            if bits & (LEVEL_1 | LEVEL_2) and not rooted and not above & _SHUT:
                rooted, above = True, above & ~HINTED  # what holds the article is no part outside it
            path = xxhash.xxh64_intdigest(f"{name} {label}", path)
            stack.append((name, path, above | bits))
            opened[name] = opened.get(name, 0) + 1
            bits |= above
            emit(path - (1 << 63), 0 if bits & (HINTED | _SHUT) else bits & (LEVEL_1 | LEVEL_2))
        flush()
        close(1)
        return found
