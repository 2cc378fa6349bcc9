"""Text extraction from stored HTML with built-in column functions only.

Elements are found by opening-tag patterns and split by position, which keeps
the work inside the JVM and inside one row: a page is never exploded to be put
together again.
"""

import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtstats.functions.text import strip_text

# The whitespace that separates attributes, for use in brackets.
SPACE = r" \t\n\r\f"
# What may stand in a tag: quoted values hold any character, also ">".
QUOTED = r"\"[^\"]*+\"|'[^']*+'"
# Named references; lookups go from left to right, so the usual ones come first.
_USUAL = ("amp", "lt", "gt", "quot", "nbsp", "apos")
REFERENCES = "\u0001".join(
    f"{name}\u0002{html5[name + ';']}"
    for name in (*_USUAL, *sorted({n[:-1] for n in html5 if n.endswith(";")} - {*_USUAL}))
)
REST = rf"(?:[^>\"']++|{QUOTED})*+>"


def visible_html(html: Column) -> Column:
    """HTML without comments, scripts and styles, which hold no elements."""
    return F.regexp_replace(
        html, r"(?is)<(?:!--.*?-->|(script|style)\b.*?</\1\s*>)", ""
    )


def opening_tag(tag: str, css_class: str | None = None) -> str:
    """Pattern (no groups) of an opening tag, optionally with a class.

    One class name matches anywhere in the class list, which may stand without
    quotes if it is one name; several names separated by spaces match the exact
    attribute text.
    """
    if css_class is None:
        return rf"(?is)<{tag}\b{REST}"
    if " " in css_class:
        name = re.escape(css_class)
        return rf"{_up_to_class(tag)}(?-i:\"{name}\"|'{name}'){REST}"
    return _with_class(tag, _class_item(css_class))


def _up_to_class(tag: str) -> str:
    # Possessive steps over whole attributes: a tag that does not match is given
    # up without going back over it.
    one = rf"(?:[^>\"'{SPACE}]++|{QUOTED})++"
    others = rf"(?:(?!class[{SPACE}]*+=){one}[{SPACE}]++)*+"
    return rf"(?is)<{tag}[{SPACE}]++{others}class[{SPACE}]*+=[{SPACE}]*+"


def _with_class(tag: str, *items: str) -> str:
    """One of the items in the class list, tried once per class name."""
    others = rf"(?:[\"'][{SPACE}]*+(?:[^\"'>{SPACE}]++[{SPACE}]++)*?|(?=[^\"'{SPACE}]))"
    return rf"{_up_to_class(tag)}(?-i:{others}(?:{'|'.join(items)}))"


def _class_item(name: str, then: str = "") -> str:
    return rf"{re.escape(name)}(?=[\"'{SPACE}>])[^>\"']*+[\"']?+{REST}{then}"


#: Marks in a page with its cells cut short: an outer element, a middle one, an inner
#: one, one whose text is still to be found, the end of a text, and two more that the
#: reading itself needs.
MARKS = "\u0001\u0002\u0003\u0004\u0005\u0006\u0007"
OUTER, MIDDLE, INNER, _UNREAD, _END, _SECOND, _THIRD = MARKS


def short_cells(html: Column, tag: str, outer: str, middle: str, inner: str) -> Column:
    """HTML with marks for three elements of one kind that are told apart by class.

    One reading of the page leaves a far shorter one: inner elements become a mark,
    their content and a mark, the opening tags of the other two a mark and a bare tag.
    Inner elements with other tags inside, or with more than two levels of their own
    kind, keep their content and closing tag in place.
    """
    closing = rf"</{tag}[{SPACE}]*+>"
    others = _with_class(tag, *[_class_item(c) for c in (outer, middle, inner)])
    opening = rf"(?!{others})<{tag}(?=[{SPACE}>]){REST}"
    one = rf"{opening}[^<]*+{closing}"
    two = rf"{opening}(?:[^<]++|{one})*+{closing}"
    content = rf"([^<]*+(?:{two}[^<]*+)*+){closing}"
    # A group of each kind of element tells which one was found.
    kinds = [rf"{_class_item(c)}(?<=(>))" for c in (outer, middle, inner)]
    found = _with_class(tag, _class_item(inner, content), *kinds)
    free = F.when(html.rlike(f"[{MARKS}]"), F.translate(html, MARKS, "")).otherwise(html)
    short = F.regexp_replace(free, found, f"{INNER}$1{_END}$2{_SECOND}$3{_THIRD}$4{_END}")
    for groups, mark in zip(
        (f">{_SECOND}{_THIRD}", f"{_SECOND}>{_THIRD}", f"{_SECOND}{_THIRD}>"),
        (OUTER, MIDDLE, INNER + _UNREAD),
    ):
        short = F.replace(short, F.lit(f"{INNER}{_END}{groups}{_END}"), F.lit(f"{mark}<{tag}>"))
    return short


def nested_texts(html: Column, tag: str, outer: str, middle: str, inner: str) -> Column:
    """Texts of inner elements, by middle element, by outer element.

    All three are of one kind and told apart by class. The page is cut before
    each of their opening tags. An inner element ends where its own depth ends,
    whatever elements stand inside it; the text is null when one of the three opens
    before that or the page ends.
    """
    return texts_of_short(short_cells(html, tag, outer, middle, inner), tag)


def texts_of_short(short: Column, tag: str) -> Column:
    """As ``nested_texts``, from the result of ``short_cells``."""

    def after(text: Column, mark: str) -> Column:
        return F.filter(F.split(text, mark, -1), lambda part, i: i >= 1)

    def text(cell: Column) -> Column:
        unread = element_text(F.substr(cell, F.lit(2)), tag)
        read = text_of(F.substring_index(cell, _END, 1))
        # References may stand for marks.
        return F.when(cell.startswith(_UNREAD), F.translate(unread, MARKS, "")).otherwise(
            F.when(F.contains(cell, F.lit("&")), F.translate(read, MARKS, "")).otherwise(read)
        )

    return F.transform(
        after(short, OUTER),
        lambda g: F.transform(after(g, MIDDLE), lambda row: F.transform(after(row, INNER), text)),
    )


def running_sum(values: Column) -> Column:
    """Sums of an integer array up to each position, in doubling steps."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))
    return F.aggregate(
        steps,
        values,
        lambda sums, k: F.transform(
            sums,
            lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)),
        ),
    )


def _tags(html: Column, tag: str) -> Column:
    """The text from each opening or closing tag to the next, without its ``<``."""
    return F.filter(F.split(html, rf"(?i)<(?=/?{tag}[{SPACE}/>])", -1), lambda part, i: i >= 1)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _depths(tags: Column) -> Column:
    """How many elements are open after each tag."""
    return running_sum(F.transform(tags, lambda t: F.when(t.startswith("/"), -1).otherwise(1)))


def element_text(html: Column, tag: str) -> Column:
    """Text of the element that begins the HTML; null when it does not end."""

    def text(state: Column) -> Column:
        tags, end = state["tags"], state["end"]
        inside = F.array_join(F.slice(tags, F.lit(1), end - 1), "<")
        return F.when(end > 0, text_of(F.concat(F.lit("<"), inside)))

    return _bound(
        _bound(
            _tags(html, tag),
            lambda tags: F.struct(
                tags.alias("tags"),
                F.array_position(_depths(tags), F.lit(0)).cast("int").alias("end"),
            ),
        ),
        text,
    )


def decode_entities(text: Column) -> Column:
    """Resolve named and numeric character references, each exactly once."""
    known = F.str_to_map(F.lit(REFERENCES), F.lit("\u0001"), F.lit("\u0002"))

    def resolve(piece: Column, position: Column) -> Column:
        name = F.regexp_extract(piece, r"^(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|\w+);", 1)
        rest = F.substr(piece, F.length(name) + 2)
        number = F.when(
            name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 16)
        ).otherwise(F.conv(F.substr(name, F.lit(2)), 10, 16))
        char = F.when(
            name.startswith("#"),
            F.decode(F.unhex(F.lpad(number, 8, "0")), "UTF-32"),
        ).otherwise(F.try_element_at(known, name))
        return (
            F.when(position == 0, piece)
            .when((name == "") | char.isNull(), F.concat(F.lit("&"), piece))
            .otherwise(F.concat(char, rest))
        )

    decoded = F.array_join(F.transform(F.split(text, "&", -1), resolve), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def text_of(fragment: Column) -> Column:
    """Text of an HTML fragment: tags removed, references resolved."""

    def plain(piece: Column) -> Column:
        text = F.regexp_replace(piece, rf"<(?:[^>\"']++|{QUOTED})*+>", "")
        return (
            F.when(~(F.contains(piece, F.lit("<")) | F.contains(piece, F.lit("&"))), piece)
            .when(~F.contains(piece, F.lit("&")), text)
            .otherwise(decode_entities(text))
        )

    # Bound once, whatever the fragment is made of.
    return F.get(F.transform(F.array(fragment), plain), F.lit(0))


def element_fragments(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Inner HTML of all elements of a kind that do not nest in each other."""
    pattern = opening_tag(tag, css_class) + rf"(.*?)</{tag}\s*>"
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def element_texts(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Stripped texts of all elements of a kind, in page order."""
    return F.transform(
        element_fragments(html, tag, css_class), lambda f: strip_text(text_of(f))
    )


def attribute(opening: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, null when absent."""
    value = rf"(?:{QUOTED}|[^{SPACE}\"'>]++)"
    others = rf"(?:(?!{name}[{SPACE}]*+=)[^{SPACE}>=\"']++(?:[{SPACE}]*+=[{SPACE}]*+{value})?+[{SPACE}]*+)*+"
    pattern = rf"(?is)^<\w++[{SPACE}]++{others}{name}[{SPACE}]*+=[{SPACE}]*+({value})"
    # The value is bound once: each mention in the steps after would match again.
    found = F.transform(
        F.array(F.regexp_extract(opening, pattern, 1)),
        lambda raw: F.when(raw != "", decode_entities(F.regexp_replace(raw, r"^[\"']|[\"']$", ""))),
    )
    return F.get(found, F.lit(0))


def attribute_values(
    html: Column, tag: str, name: str, css_class: str | None = None
) -> Column:
    """Values of an attribute over all elements of a kind, in page order."""
    openings = F.regexp_extract_all(
        html, F.lit(opening_tag(tag, css_class)), F.lit(0)
    )
    values = F.transform(openings, lambda o: attribute(o, name))
    return F.filter(values, lambda v: v.isNotNull())


def part_before(html: Column, opening: str) -> Column:
    """What comes before the first opening tag of a kind, or everything."""
    return F.get(F.split(html, opening, 2), F.lit(0))


def parts_after(html: Column, opening: str) -> Column:
    """What follows each opening tag, up to the next one of the same kind."""
    return F.filter(F.split(html, opening, -1), lambda part, i: i >= 1)


def child_fragments(content: Column, tag: str = "div") -> Column:
    """Direct children of a kind, for content that starts inside their parent.

    Depths are running sums over opening and closing tags, and every child is cut
    out once, up to the tag after its end. What follows the parent's own closing
    tag is left out; a child that does not end goes up to there.
    """

    # Every step binds what the next one uses, or it would be worked out for each tag.
    def with_end(state: Column) -> Column:
        end = F.array_position(state["depths"], F.lit(-1)).cast("int")
        last = F.when(end > 0, end - 1).otherwise(F.size(state["tags"]))
        return F.struct(state["tags"].alias("tags"), state["depths"].alias("depths"), last.alias("last"))

    def with_edges(state: Column) -> Column:
        tags, depths, last = state["tags"], state["depths"], state["last"]
        numbers = F.filter(F.sequence(F.lit(0), last), lambda i: i > 0)
        opens = F.filter(
            numbers,
            lambda i: (F.get(depths, i - 1) == 1) & ~F.get(tags, i - 1).startswith("/"),
        )
        closes = F.filter(numbers, lambda i: F.get(depths, i - 1) == 0)
        return F.struct(tags.alias("tags"), last.alias("last"), opens.alias("opens"), closes.alias("closes"))

    def children(state: Column) -> Column:
        def child(begin: Column, k: Column) -> Column:
            end = F.coalesce(F.get(state["closes"], k), state["last"])
            return F.concat(
                F.lit("<"), F.array_join(F.slice(state["tags"], begin, end - begin + 1), "<")
            )

        return F.transform(state["opens"], child)

    tagged = _bound(
        _tags(content, tag),
        lambda tags: F.struct(tags.alias("tags"), _depths(tags).alias("depths")),
    )
    return _bound(_bound(_bound(tagged, with_end), with_edges), children)
