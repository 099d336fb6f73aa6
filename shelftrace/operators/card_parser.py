"""Raw fields of product cards, for use inside tasks."""

import re
from html import unescape

# Selectors as paths of (tag, classes), outermost first.
CARD = [("article", {"prd", "_fb", "col", "c-prd"})]
LINK = [("a", {"core"})]
IMAGE = [("div", {"img-c"}), ("img", {"img"})]
TEXTS = {
    "name_text": [("h3", {"name"})],
    "price_text": [("div", {"prc"})],
    "old_price_text": [("div", {"s-prc-w"}), ("div", {"old"})],
    "discount_text": [("div", {"bdg", "_dsct", "_sm"})],
    "stars_text": [("div", {"rev"}), ("div", {"stars", "_s"})],
    "reviews_text": [("div", {"rev"})],
}
# Attributes kept of the first link and image, by the field they fill.
ATTRIBUTES = {
    "link": (LINK, {"link_href": "href", "link_id": "data-gtm-id"}),
    "image": (IMAGE, {"image_src": "src", "image_data_src": "data-src"}),
}

# Tags without an end tag, and tags that break a line of text.
VOID = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)
BREAKS = frozenset("article br div h1 h2 h3 h4 li p section tr ul".split())

RAW_FIELDS = [
    "data_sku",
    "link_href",
    "link_id",
    "image_src",
    "image_data_src",
    *TEXTS,
]

SELECTED = frozenset(
    tag
    for path in [CARD, LINK, IMAGE, *TEXTS.values()]
    for tag, _ in path
)

NO_CLASSES = frozenset()

# Tags up to so many characters are kept as read, so many of them at most.
KNOWN_SIZE = 200
KNOWN_TAGS = 4096
KNOWN = {}
PAGES_AT_ONCE = 256

# Possessive throughout: no input makes these backtrack.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?P<raw>script|style|textarea|title)(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)
      | <(?P<end>/?+)(?P<tag>[a-z][^\s/>]*+)
        (?P<attributes>(?:[\s/]++
          | [^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+)>
      | <[!?/][^>]*+>""",
    re.S | re.I | re.X,
)
ATTRIBUTE = re.compile(
    r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+"""
)


def read_attributes(text):
    """Attributes of one tag as they stand; the first of a repeated name counts."""
    found = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), double or single or bare)
    return found


def decoded(text):
    """With its character references decoded; Python refuses numbers of thousands of
    digits, for one."""
    return unescape(text) if text and "&" in text else text


def class_names(text):
    """The classes of a class attribute; one that cannot be decoded counts as it stands."""
    try:
        text = decoded(text)
    except Exception:  # whether the card fails is for its own fields to say
        pass
    return frozenset(text.split())


def _by_last_tag():
    """What to look for at each tag: (name, classes of the last step, steps before)."""
    wanted = {}
    paths = {"card": CARD, **{k: path for k, (path, _) in ATTRIBUTES.items()}, **TEXTS}
    for name, (*outer, (tag, classes)) in paths.items():
        wanted.setdefault(tag, []).append((name, frozenset(classes), outer[::-1]))
    return wanted


WANTED = _by_last_tag()


def below(outer, ancestors):
    """Do the ancestors hold the outer steps, innermost first?"""
    upwards = reversed(ancestors)
    return all(any(t == tag and want <= have for t, have in upwards) for tag, want in outer)


def read_tag(token):
    """What a token is: (tag or None, ends it, breaks a line, classes, attributes, what of
    WANTED its own classes fit)."""
    _, end, tag, attributes = token.groups()
    if not tag:
        return None, False, False, NO_CLASSES, None, ()
    tag = tag.lower()
    values, classes = None, NO_CLASSES
    if not end and tag in SELECTED and "class" in attributes.lower():
        values = read_attributes(attributes)
        classes = class_names(values.get("class", ""))
    fitting = tuple(
        (name, outer) for name, last, outer in WANTED.get(tag, ()) if classes and last <= classes
    )
    return tag, bool(end), tag in BREAKS, classes, values, fitting


def read_cards(html):
    """One dict of raw fields per card, or with the error of that card; a selector's first
    match in a card counts. Short tags are kept as read, for other pages have them too."""
    cards = []
    elements = []  # open elements as (tag, classes)
    open_cards = []  # (depth, card)
    open_texts = []  # (depth, pieces)
    done = 0
    for token in TOKEN.finditer(html):
        raw = token.group()
        read = KNOWN.get(raw)
        if read is None:
            read = read_tag(token)
            if len(raw) <= KNOWN_SIZE:
                if len(KNOWN) >= KNOWN_TAGS:
                    KNOWN.clear()
                KNOWN[raw] = read
        tag, end, breaks, classes, values, fitting = read
        if open_texts:
            found = [html[done : token.start()]]
            if breaks:
                found.append("\n")
            for _, pieces in open_texts:
                pieces += found
        done = token.end()
        if not tag:
            continue
        if end:
            depth = len(elements) - 1
            while depth >= 0 and elements[depth][0] != tag:
                depth -= 1
            if depth >= 0:
                del elements[depth:]
                if open_texts and open_texts[-1][0] >= depth:
                    open_texts = [t for t in open_texts if t[0] < depth]
                if open_cards and open_cards[-1][0] >= depth:
                    open_cards = [c for c in open_cards if c[0] < depth]
            continue
        for name, outer in fitting:
            if outer and not below(outer, elements):
                continue
            if name == "card":
                card = {"data_sku": values.get("data-sku")}
                cards.append(card)
                open_cards.append((len(elements), card))
                continue
            for _, card in open_cards:
                if name in card:
                    continue
                if name in ATTRIBUTES:
                    card[name] = True
                    fields = ATTRIBUTES[name][1]
                    card.update({f: values.get(a) for f, a in fields.items()})
                else:
                    card[name] = []
                    open_texts.append((len(elements), card[name]))
        if tag not in VOID:
            elements.append((tag, classes))
    for _, pieces in open_texts:
        pieces.append(html[done:])
    return [card_row(position, card) for position, card in enumerate(cards)]


def card_row(position, card):
    """The raw fields of one card with references decoded, or why they cannot be."""
    try:
        row = {
            name: "".join(map(decoded, value)) if name in TEXTS else decoded(value)
            for name, value in card.items()
            if name in RAW_FIELDS
        }
    except Exception as error:  # one bad card must not cost the page
        row = {"parse_error": f"{type(error).__name__}: {error}"}
    return row | {"position": position}


def page_rows(html):
    try:
        return read_cards(html)
    except Exception as error:  # one bad page must not stop the job
        return [{"parse_error": f"{type(error).__name__}: {error}"}]


def rows_by_part(pages, size=PAGES_AT_ONCE):
    """(places, rows) of so many pages at a time: the place of the page of each row, and
    the row. Cards as dicts take many times the room that they have in a batch."""
    for start in range(0, len(pages), size):
        places, rows = [], []
        for place, html in enumerate(pages[start : start + size], start):
            found = page_rows(html.as_py()) if html.is_valid else ()
            places.extend([place] * len(found))
            rows.extend(found)
        yield places, rows
