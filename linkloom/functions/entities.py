"""HTML character references, decoded with built-in Spark expressions.

The reference table is taken from the Python standard library on the driver and
travels in the plan as one constant map, so no Python worker is involved.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from html.entities import html5, name2codepoint

from pyspark.sql import Column, functions as F

from .bind import bind

_PAIR, _ENTRY = "\u0001", "\u0002"
# Looked at before the full table, which is a scan.
_FREQUENT = {n + ";": html5[n + ";"] for n in ("amp", "quot", "lt", "gt", "nbsp")}
# A text with no other references is decoded by plain replacements; the ampersand comes last, so nothing is decoded twice.
_COMMON = {f"&{n};": html5[n + ";"] for n in ("quot", "lt", "gt", "nbsp", "copy", "middot", "amp")}
_UNCOMMON = f"&(?!{'|'.join(n[1:] for n in _COMMON)})"
_REPLACEMENT = "�"


@lru_cache(maxsize=1)
def _named_table() -> str:
    # Map lookup is a scan, so the common HTML 4 names come first.
    names = [n + ";" for n in name2codepoint] + list(html5)
    return _ENTRY.join(f"{n}{_PAIR}{html5[n]}" for n in dict.fromkeys(names))


@lru_cache(maxsize=1)
def _unterminated_names() -> str:
    # Names that may be written without a semicolon; the longest one wins.
    names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return "|".join(names)


@lru_cache(maxsize=1)
def _windows_1252_table() -> str:
    # Numeric references 128-159 mean Windows-1252 characters in HTML.
    pairs = []
    for code in range(0x80, 0xA0):
        try:
            pairs.append(f"{code}{_PAIR}{bytes([code]).decode('cp1252')}")
        except UnicodeDecodeError:
            continue
    return _ENTRY.join(pairs)


def _table(text: str) -> Column:
    return F.str_to_map(F.lit(text), F.lit(_ENTRY), F.lit(_PAIR))


def _character(code: Column) -> Column:
    """Character for a code point given as long (NULL when out of range)."""
    bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    utf32 = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    windows = F.element_at(_table(_windows_1252_table()), code.cast("string"))
    return (
        F.when(bad, F.lit(_REPLACEMENT))
        .when(code.between(0x80, 0x9F), F.coalesce(windows, utf32))
        .otherwise(utf32)
    )


def _numeric(reference: Column) -> Column:
    digits = F.regexp_extract(reference, r"^#[xX]?0*([0-9a-fA-F]*)", 1)
    base = F.when(reference.rlike("^#[xX]"), 16).otherwise(10)
    # More than seven significant digits can only be out of range.
    code = F.when(
        F.length(digits) <= 7,
        F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long"),
    )
    code = F.when(digits == "", F.lit(0).cast("long")).otherwise(code)
    return bind(code, _character)


def _after(piece: Column, prefix: Column) -> Column:
    return F.substr(piece, F.length(prefix) + 1)


def _lookup(table: dict[str, str], name: Column) -> Column:
    found = F
    for key, value in table.items():
        found = found.when(name == key, F.lit(value))
    return found


def _decode_after_ampersand(piece: Column, attribute: bool) -> Column:
    """Decode one piece that followed an ``&``."""
    tail = r"(?![=a-zA-Z0-9])" if attribute else ""
    references = F.struct(
        F.regexp_extract(piece, r"\A(#(?:[0-9]+|[xX][0-9a-fA-F]+);?)", 1).alias("numeric"),
        F.regexp_extract(piece, r"\A([a-zA-Z][a-zA-Z0-9]*;)", 1).alias("named"),
    )

    def decode(found: Column) -> Column:
        numeric, named = found["numeric"], found["named"]
        return (
            F.when(numeric != "", F.concat(_numeric(numeric), _after(piece, numeric)))
            .when(named.isin(list(_FREQUENT)),
                  F.concat(_lookup(_FREQUENT, named), _after(piece, named)))
            .otherwise(bind(F.when(named != "", F.element_at(_table(_named_table()), named)),
                            lambda value: rare(named, value)))
        )

    def rare(named: Column, value: Column) -> Column:
        loose = F.regexp_extract(piece, rf"\A({_unterminated_names()}){tail}", 1)
        return F.when(value.isNotNull(), F.concat(value, _after(piece, named))).otherwise(
            bind(loose, lambda name: F.when(
                name != "",
                F.concat(F.element_at(_table(_named_table()), name), _after(piece, name)),
            ).otherwise(F.concat(F.lit("&"), piece)))
        )

    return bind(references, decode)


def decode_entities(text: Column, attribute: bool = False) -> Column:
    """Replace character references as an HTML5 parser does.

    Splitting at ``&`` decodes each reference exactly once, so ``&amp;lt;`` becomes
    ``&lt;``. ``attribute=True`` applies the stricter rule for attribute values, which
    leaves ``?a=1&copy=2`` alone.
    """
    return F.element_at(decode_all(F.array(text), attribute), 1)


def decode_all(texts: Column, attribute: bool = False) -> Column:
    """:func:`decode_entities` for an array; one expression serves all of its elements."""

    def decode(t: Column) -> Column:
        pieces = F.transform(
            F.split(t, "&"),
            lambda piece, i: F.when(i == 0, piece).otherwise(
                _decode_after_ampersand(piece, attribute)
            ),
        )
        return (
            F.when(~F.contains(t, F.lit("&")), t)
            .when(~t.rlike(_UNCOMMON), reduce(
                lambda done, item: F.replace(done, F.lit(item[0]), F.lit(item[1])), _COMMON.items(), t
            ))
            .otherwise(F.array_join(pieces, ""))
        )

    return F.transform(texts, decode)
