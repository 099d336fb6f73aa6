"""Blocks of text of a page and the containers they lie in, for use inside tasks."""

import re
from html import unescape

# Elements without content worth reading, to their end tag or the page's end,
# and those that end with the next block if they have no end tag of their own; elements
# that end an option; elements without an end tag, that hold other blocks, and that start
# and end a block.
RAW = "script|style|noscript|template|textarea|select|title"
SKIPPED = frozenset("audio button canvas iframe math object option svg video".split())
FOREIGN = frozenset(["math", "svg"])
NESTED = FOREIGN | {"object"}
OPTION, OPTION_ENDS = "option", frozenset("datalist optgroup option select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(
    """
    address article aside blockquote center dd details dialog div dl dt fieldset figcaption
    figure footer form header hgroup li main menu nav ol search section summary table tbody
    td tfoot th thead tr ul
    """.split()
)
BREAKS = frozenset("body caption h1 h2 h3 h4 h5 h6 head hr html legend p pre".split())
# Parts of a page that are not the article, by element and by word in class, id or role.
ASIDE_TAGS = frozenset("aside dialog footer menu nav search".split())
FORM = "form"
ASIDE_WORDS = frozenset(
    """
    ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
    comments complementary contentinfo cookie cookies consent disqus footer masthead menu
    modal nav navbar navigation newsletter notice notices outbrain pager pagination popup
    promo promoted promotion related reply replies respond search share sharing sidebar
    social sponsor sponsored subscribe subscription taboola toolbar widget widgets
    """.split()
)
# Those that can be longer than the article they follow.
REPLY_WORDS = frozenset("comment comments disqus replies reply respond".split())
# Words of names that tell what a container has or lacks, not what it is.
TELLING = frozenset(
    "closed disabled enabled free has have no non not open with without".split()
)
# How a container is marked: a form, by some words of a name, by a whole name, as replies.
FORMS, PARTLY, WHOLLY, REPLIES = range(1, 5)
# The page's header, but not the article's own.
HEADER = "header"
ARTICLE = frozenset(["article", "main"])
TITLE = "h1"

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
      | <(?P<raw>{RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)
      | <(?P<end>/?+)(?P<tag>[a-z][a-z0-9:-]*+)
        (?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | </?[a-z][^>]*+(?:>|\Z)
      | <[!?/][^>]*+(?:>|\Z)""",
    re.S | re.I | re.X,
)
ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""", re.I
)
SAME_TAG = {t: re.compile(rf"<(/?+){t}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for t in SKIPPED}
NAME_PARTS = re.compile(r"[^a-z]+")
DIGITS = re.compile(r"[0-9]+")


def _names(attributes):
    """(mark by the names in class, id and role, 0 for none; generalised classes) of a
    start tag."""
    mark, classes = 0, []
    for found in ATTRIBUTE.finditer(attributes):
        value = (found[2] or found[3] or found[4] or "").lower()
        mark = max(mark, *map(_mark, value.split()), 0)
        if found[1].lower() == "class":
            classes = sorted({DIGITS.sub("#", c) for c in value.split()})
    return mark, classes


def _mark(name):
    words = {w for w in NAME_PARTS.split(name) if w}
    if ASIDE_WORDS.isdisjoint(words) or not TELLING.isdisjoint(words):
        return 0
    if not REPLY_WORDS.isdisjoint(words):
        return REPLIES
    return WHOLLY if words <= ASIDE_WORDS else PARTLY


def blocks(html):
    """(path, text, characters in links) of each block of titled_blocks."""
    return [found[:3] for found in titled_blocks(html)]


def titled_blocks(html):
    """(path, text, characters in links, whether it is a title) of each block that is not
    aside, in page order.

    A path is a tuple of container steps, outermost first; a step is the tag with its
    classes, digits generalised. Elements left open end with what holds them. What a
    container's names say of it is weighed at the end, when its share is known.
    """
    out, pieces, path, stack = [], [], (), []
    marked, within = [], ()
    asides = links = linked = articles = 0
    title = False

    def flush():
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text and not asides:
            out.append((path, text, min(linked, len(text)), title, within, articles > 0))
        pieces, linked = [], 0

    def add(text):
        nonlocal linked
        if text:
            text = unescape(text)
            pieces.append(text)
            if links:
                linked += len(text.strip())

    at, skipped = 0, None
    while token := TOKEN.search(html, at):
        if not skipped:
            add(html[at : token.start()])
        at = token.end()
        tag = (token["tag"] or token["raw"] or "").lower()
        if skipped:
            ended = tag == skipped and token["end"]
            ended = ended or (skipped == OPTION and tag in OPTION_ENDS)
            if tag == skipped and not ended and tag in NESTED:
                at = _next_same(html, at, tag) or at
            elif ended or tag == skipped or tag in CONTAINERS or tag in BREAKS:
                skipped = None
        if skipped or token["raw"]:
            continue
        if tag in SKIPPED:
            if not token["end"]:
                empty = tag in FOREIGN and token["attributes"].endswith("/")
                same = None if empty else _next_same(html, at, tag)
                if same:
                    at = same
                elif not empty:
                    skipped = tag
        elif tag == "a":
            links = 0 if token["end"] else 1
        elif tag == "br":
            pieces.append(" ")
        elif tag in BREAKS:
            flush()
            title = tag == TITLE and not token["end"]
        elif tag in CONTAINERS:
            flush()
            links, title = 0, False
            if token["end"]:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
                if depth is not None:
                    for _, aside, article, *_ in stack[depth:]:
                        asides -= aside
                        articles -= article
                    path, within = stack[depth][3:]
                    del stack[depth:]
            elif not token["attributes"].endswith("/") or tag == "div":
                mark, classes = _names(token["attributes"]) if token["attributes"] else (0, [])
                aside = tag in ASIDE_TAGS or (tag == HEADER and not articles)
                article = tag in ARTICLE
                stack.append((tag, aside, article, path, within))
                if article:
                    for number in within:
                        marked[number][2] = True
                elif not aside and (mark or tag == FORM):
                    within = (*within, len(marked))
                    # Mark, whether it lies in an article and whether it holds one.
                    marked.append([mark or FORMS, articles > 0, False])
                asides += aside
                articles += article
                path = (*path, ".".join([tag, *classes]))
    if not skipped:
        add(html[at:])
    flush()
    held = _asides(out, marked)
    return [found[:4] for found in out if held.isdisjoint(found[4])]


def _next_same(html, at, tag):
    """Where the end tag of an element ends, None if it has none before the next of its kind."""
    same = SAME_TAG[tag].search(html, at)
    return same.end() if same and same[1] else None


def _asides(found, marked):
    """Numbers of the marked containers that are aside.

    A mark does not hold for a container with most of the article's text, or of the
    page's if it has no article. Within an article or beside one, where no article lies
    in it, a whole name still holds, and replies hold as long as there is other text.
    Within an article, a word of a longer name says little: a section on a market's share
    is text. Such a name holds only where most of what it names is links.
    """
    if not marked:
        return frozenset()
    texts = [
        (len(text) - linked, linked, within, article) for _, text, linked, _, within, article in found
    ]
    in_links, in_all = [0] * len(marked), [0] * len(marked)
    for weight, linked, within, _ in texts:
        for number in within:
            in_links[number] += linked
            in_all[number] += weight + linked
    if any(weight for weight, *_, article in texts if article):
        texts = [t for t in texts if t[3]]
        articles = True
    else:
        articles = False
    total, held = sum(t[0] for t in texts), [0] * len(marked)
    for weight, _, within, _ in texts:
        for number in within:
            held[number] += weight

    def holds(mark, inside, around, weight, mostly_links):
        if mark == PARTLY and inside:
            return mostly_links
        if 2 * weight <= total:
            return True
        if mark == FORMS:
            return articles and not around
        if mark == REPLIES and (inside or not articles):
            return weight < total
        return mark == WHOLLY and inside and not around and weight < total

    return {
        n for n, m in enumerate(marked) if holds(*m, held[n], 2 * in_links[n] > in_all[n])
    }


def shares(found):
    """Share of the page's text outside links that each container path holds."""
    held, total = {}, 0.0
    for path, text, linked, *_ in found:
        weight = len(text) - linked
        total += weight
        for depth in range(len(path) + 1):
            held[path[:depth]] = held.get(path[:depth], 0.0) + weight
    return {p: w / total for p, w in held.items()} if total else {}


def is_article(step):
    return step.split(".", 1)[0] in ARTICLE


def deepest(rated, least):
    """The deepest path with a share of at least `least`, first by text if several."""
    good = [p for p, share in rated.items() if share >= least]
    return min(good, key=lambda p: (-len(p), p), default=())


def main_container(rated, least):
    """As deepest, but an article or main element goes before what it holds."""
    articles = {p: share for p, share in rated.items() if p and is_article(p[-1])}
    return deepest(articles, least) or deepest(rated, least)


def text_under(found, path):
    return "\n".join(text for own, text, *_ in found if own[: len(path)] == path)


def article_text(found, path):
    """The blocks at the main container `path` and those around it that belong to the
    article, one per line; empty if the page has no such container.

    The outermost container around it that has text of its own, beside its containers,
    belongs to the article; so do containers beside `path` with a title. Nothing outside
    the article or main element that holds `path` does. Blocks that are mostly links
    are left out around `path`, not in it.
    """
    if not any(own[: len(path)] == path for own, *_ in found):
        return ""
    least = next((d for d, step in enumerate(path, 1) if is_article(step)), 0)
    top, beside = len(path), set()
    for own, text, linked, title in found:
        if own[:least] != path[:least] or own[: len(path)] == path or 2 * linked > len(text):
            continue
        if own == path[: len(own)]:
            top = min(top, len(own))
        elif title:
            beside.add(own[: _common(own, path) + 1])

    def belongs(own, text, linked):
        if own[: len(path)] == path:
            return True
        around = own[:top] == path[:top] or own[: _common(own, path) + 1] in beside
        return around and 2 * linked <= len(text)

    return "\n".join(text for own, text, linked, _ in found if belongs(own, text, linked))


def _common(left, right):
    """Number of first steps that two paths share."""
    return next((d for d, (a, b) in enumerate(zip(left, right)) if a != b), min(len(left), len(right)))
