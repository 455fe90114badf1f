"""HTML measures as Column expressions over a raw ``html`` string.

One regular-expression pass (:func:`pieces_of`) cuts the page at its tags, drops comments and declarations and puts marker
characters between the parts of each piece: the tag's name, the tag, raw content with its end tag, and the text that
follows. Everything else takes pieces apart at the markers, without another pattern over the page, so text inside scripts,
comments or quoted attribute values is never mistaken for markup. All work stays in the JVM.

Every repetition in the patterns is possessive or a plain character class, which Java runs
as a loop: a page with 100,000 attributes neither overflows the stack nor backtracks.

Limits of this route compared with a tree builder: elements ignored inside ``select``,
``frameset`` pages, character references in the values that :func:`has_class` and
:func:`has_attribute_value` test, ``body`` implied by content before an explicit ``<body>``, and
foreign (SVG/MathML) parsing rules.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from .bind import bind
from .entities import decode_entities

# Control characters keep plain-ASCII pages in the JVM's one-byte strings, which regexes run
# over several times faster.
TAG_MARK, NAME_MARK, TEXT_MARK, RAW_MARK = MARKS = "\x01", "\x03", "\x02", "\x04"
SPLIT_MARK = "\x02"  # in tag sequences
_NOT_A_MARK = "\x7F"

_ATTRS = (
    r"""(?:[^=>]++|=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s"'>][^\s>]*+)?+)*+"""
)
_NAME_END = r"(?=[\s/>])"
_TAG_END = r"(?:>|\z)"
_SEQ_END = rf"(?=[<{SPLIT_MARK}]|\z)"

# Elements whose content is text even when it looks like markup.
_RAW_TEXT = "script|style|xmp|iframe|noembed|noframes|noscript"
_RAW_ALL = _RAW_TEXT + "|textarea|title"

# Tags that end an open paragraph.
_ENDS_PARAGRAPH = (
    "address|article|aside|blockquote|center|details|dialog|dir|div|dl|dd|dt|fieldset|"
    "figcaption|figure|footer|form|h[1-6]|header|hgroup|hr|li|listing|main|menu|nav|ol|p|"
    "plaintext|pre|search|section|summary|table|td|th|ul|xmp"
)

# White space as defined by Unicode (what a Unicode-aware trim removes).
UNICODE_SPACE = (
    "\t\n\v\f\r \u0085         "
    "        　"
)


def _raw_element(names: str, group: int) -> str:
    """Start tag, content and end tag; group ``group`` is the name, ``group+1`` the content."""
    return (
        rf"<({names}){_NAME_END}{_ATTRS}{_TAG_END}(.*?)"
        rf"(?:</\{group}{_NAME_END}[^>]*+{_TAG_END}|\z)"
    )


# The look-ahead lets plain text be skipped at one test per character.
_TOKENS = (
    r"(?is)(?=<)(?:<!--(?:>|->|.*?(?:--!?>|\z))"
    rf"|(<({_RAW_ALL}){_NAME_END}{_ATTRS}{_TAG_END})(.*?)"
    rf"(?:(</\2{_NAME_END}[^>]*+{_TAG_END})|\z)"
    rf"|((?=</?([a-z][^\s/>]*+))</?[a-z]{_ATTRS}>)|</?[a-z]{_ATTRS}\z"
    rf"|<[!?][^>]*+{_TAG_END}|</[^a-z>][^>]*+{_TAG_END}|</>)"
)
# A piece: name, tag, raw content, end tag of raw content, text.
_PIECE = f"{TAG_MARK}%s{NAME_MARK}%s{TEXT_MARK}%s{RAW_MARK}%s{RAW_MARK}"
_PLAIN = TEXT_MARK + 2 * RAW_MARK  # stands in pieces without raw content

# What may stand before the body when its tag is left out; "" is a comment or the start.
_HEAD_NAMES = [
    "", *(f"{end}{name}" for name in ("html", "head", "meta", "link", "base", "basefont", "bgsound") for end in ("", "/")),
    "title", "style", "script", "noscript", "noframes",
]
_ATTRIBUTE = r"""[^\s=/>"']++(?:\s*+=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s"'>][^\s>]*+)?+)?+"""


def pieces_of(html: Column) -> Column:
    """The page cut at its tags: one string per tag, comment or declaration, the first one for the text before.

    Line ends become ``\\n`` as in HTML parsing; stray marker characters in the input turn
    into another control character of the same byte length.
    """
    marks = reduce(or_, (F.contains(html, F.lit(m)) for m in MARKS))
    unmarked = F.when(
        marks, F.translate(html, "".join(MARKS), _NOT_A_MARK * len(MARKS))
    ).otherwise(html)
    lines = F.when(
        F.contains(html, F.lit("\r")),
        F.replace(F.replace(unmarked, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")),
    ).otherwise(unmarked)
    # An end tag's name has no group of its own: it is told by the tag.
    marked = F.regexp_replace(lines, _TOKENS, _PIECE % ("$2$6", "$1$5", "$3", "$4"))
    pieces = F.split(F.concat(F.lit(_PIECE % ("", "", "", "")), marked), TAG_MARK)
    return F.slice(pieces, 2, 1 << 30)  # what stands before the first marker is empty


def name_of(piece: Column) -> Column:
    """Lower-case name of a piece's tag, with ``/`` for an end tag, empty for a comment."""
    name = F.lower(F.substring_index(piece, NAME_MARK, 1))
    return (
        # A tag cut off at the end of the page leaves a name without a tag.
        F.when(F.contains(piece, F.lit(NAME_MARK + TEXT_MARK)), "")
        .when(F.contains(piece, F.lit(NAME_MARK + "</")), F.concat(F.lit("/"), name)).otherwise(name)
    )


def tag_of(piece: Column) -> Column:
    """The tag as written."""
    return F.substring_index(F.substring_index(piece, TEXT_MARK, 1), NAME_MARK, -1)


def raw_of(piece: Column) -> Column:
    """Content of a script, title and the like; empty for other tags."""
    return F.substring_index(F.substring_index(piece, TEXT_MARK, -1), RAW_MARK, 1)


def after_of(piece: Column) -> Column:
    """Text between the tag (with its raw content) and the next one, references not yet decoded."""
    return F.substring_index(piece, RAW_MARK, -1)


def text_of(piece: Column) -> Column:
    """All text of a piece: raw content and what follows."""
    return F.when(F.contains(piece, F.lit(_PLAIN)), after_of(piece)).otherwise(
        F.concat(raw_of(piece), after_of(piece))
    )


def tag_sequence(names: Column) -> Column:
    """Names of all tags in order, as ``<name`` and ``</name`` without separators.

    A few hundred bytes per page: element counts look at this instead of the page.
    """
    return F.array_join(F.transform(F.filter(names, lambda n: n != ""), lambda n: F.concat(F.lit("<"), n)), "")


def body_start(names: Column, texts: Column) -> Column:
    """Place (from 1) of the piece that the body starts with: its tag, the end of the head, or the first that can't be
    part of a head."""
    position = lambda name: F.nullif(F.array_position(names, name), F.lit(0))
    foreign = F.filter(
        F.sequence(F.lit(1), F.size(names)),
        lambda i: ~F.get(names, i - 1).isin(_HEAD_NAMES) | ~F.get(texts, i - 1).rlike(r"\A\s*+\z"),
    )
    return F.coalesce(
        position("body"), position("/head"), F.get(foreign, F.lit(0)), F.size(names) + 1
    ).cast("int")


def body_text(pieces: Column, names: Column, texts: Column, start: Column) -> Column:
    """Text of the body, raw content included. A head element that the body starts behind lends only what follows it."""
    first, name = F.get(texts, start - 1), F.get(names, start - 1)
    after = F.regexp_replace(after_of(F.get(pieces, start - 1)), r"\A\s++", "")
    opening = (
        F.when(name.isin("body", "/head"), after_of(F.get(pieces, start - 1)))
        .when(name.isin(_HEAD_NAMES), after).otherwise(first)
    )
    rest = F.array_join(F.slice(texts, start + 1, F.size(texts)), "")
    return F.concat(F.coalesce(opening, F.lit("")), rest)


def raw_text(pieces: Column, names: Column, start: Column, length: Column) -> Column:
    """Script-like content of ``length`` pieces from ``start`` on, which is text but holds no references. Of a head element
    that the body starts behind it does not count."""
    raw = _RAW_TEXT.split("|")

    def joined(own: Column) -> Column:
        found = F.filter(
            F.slice(pieces, start, length),
            lambda p, i: F.get(own, i).isin(raw) & ((i > 0) | ~F.get(own, i).isin(_HEAD_NAMES)),
        )
        return F.when(
            F.arrays_overlap(own, F.array(*map(F.lit, raw))), F.array_join(F.transform(found, raw_of), "\n")
        ).otherwise("")

    return bind(F.slice(names, start, length), joined)


def anchors_of(pieces: Column, names: Column, texts: Column) -> Column:
    """All ``a`` elements in order: ``tag``, ``text`` (references not yet decoded) and ``raw``, the script-like part of the text.

    An anchor ends at its end tag or where the next anchor starts, since anchors do not nest.
    """
    n = F.size(names)
    bounds = F.filter(F.sequence(F.lit(1), n), lambda i: F.get(names, i - 1).isin("a", "/a"))

    def spans(places: Column) -> Column:
        both = F.transform(places, lambda i, k: F.struct(
            i.alias("start"), F.coalesce(F.get(places, k + 1), n + 1).alias("end")
        ))
        return F.filter(both, lambda s: F.get(names, s["start"] - 1) == "a")

    return F.transform(bind(bounds, spans), lambda s: F.struct(
        tag_of(F.get(pieces, s["start"] - 1)).alias("tag"),
        F.array_join(F.slice(texts, s["start"], s["end"] - s["start"]), "").alias("text"),
        raw_text(pieces, names, s["start"], s["end"] - s["start"]).alias("raw"),
    ))


def trim_unicode(text: Column) -> Column:
    return F.btrim(text, F.lit(UNICODE_SPACE))


def title_source(pieces: Column, names: Column) -> Column:
    """Text of all ``title`` elements, references not yet decoded, not trimmed."""
    titles = F.filter(pieces, lambda p, i: F.get(names, i) == "title")
    return F.array_join(F.transform(titles, raw_of), "")


def count_headings(tags: Column) -> Column:
    return F.regexp_count(tags, F.lit(rf"<h[123]{_SEQ_END}"))


def count_paragraphs(tags: Column) -> Column:
    """``p`` elements: start tags, plus the empty ones an unmatched ``</p>`` creates."""
    blocks = F.regexp_replace(tags, rf"(?=</?(?:{_ENDS_PARAGRAPH}){_SEQ_END})", SPLIT_MARK)
    start, end = rf"{SPLIT_MARK}<p{_SEQ_END}", rf"{SPLIT_MARK}</p{_SEQ_END}"
    return bind(
        blocks,
        lambda b: F.regexp_count(b, F.lit(f"{start}|{end}"))
        - F.regexp_count(b, F.lit(f"{start}[^{SPLIT_MARK}]*+{end}")),
    )


def has_element(tags: Column, name: str) -> Column:
    return tags.rlike(rf"<{name}{_SEQ_END}")


def attributes(tag: Column) -> Column:
    """Attributes of the tag that ``tag`` starts with, as ``name=value`` source texts.

    They are cut apart from left to right, so a name inside a quoted value is not found.
    """
    inner = F.regexp_extract(
        tag, rf"(?s)\A<[a-zA-Z][^\s/>]*+({_ATTRS}){_TAG_END}", 1
    )
    return F.regexp_extract_all(inner, F.lit(_ATTRIBUTE), 0)


def attribute_value(attrs: Column, name: str) -> Column:
    """Value of attribute ``name`` as written, NULL when absent; the first of repeats counts."""
    found = F.get(F.filter(attrs, lambda a: a.rlike(rf"(?i)\A{name}\s*(?:=|\z)")), F.lit(0))
    value = F.regexp_replace(found, r"\A[^=]*+(?:=\s*+)?", "")
    return F.regexp_replace(value, r"""(?s)\A(["'])(.*?)(?:\1|\z)""", "$2")


def has_attribute_value(pieces: Column, names: Column, element: str, name: str, value: str) -> Column:
    """Some ``element`` has attribute ``name`` equal to ``value`` (case-sensitive)."""
    tags = F.filter(pieces, lambda p, i: F.get(names, i) == element)
    return F.exists(tags, lambda p: F.coalesce(
        attribute_value(attributes(tag_of(p)), name) == value, F.lit(False)
    ))


def has_class(html: Column, pieces: Column, names: Column, pattern: str, hints: tuple[str, ...]) -> Column:
    """Some element's class attribute matches the regex ``pattern``.

    Only pages that contain one of the literal ``hints`` anywhere, and in them only tags with a
    hint, have their attributes taken apart.
    """

    def hinted(text: Column) -> Column:
        return reduce(or_, [F.contains(text, F.lit(h)) for h in hints])

    exact = F.exists(
        F.filter(pieces, lambda p, i: hinted(p) & ~F.startswith(F.get(names, i), F.lit("/"))),
        lambda p: F.coalesce(attribute_value(attributes(tag_of(p)), "class").rlike(pattern), F.lit(False)),
    )
    return F.when(hinted(html), exact).otherwise(False)
