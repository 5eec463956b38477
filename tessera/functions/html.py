"""HTML as column expressions: attributes of tags, links, title and visible text.

Tags are cut out by patterns that know quoted attribute values, so a '>' or an attribute look-alike
inside quotes does no harm; comments, scripts and styles are removed first.  Character references are
decoded from the standard table.  All of it runs in the JVM, one page a row."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The inside of a tag: quoted values (after '=') may hold any character.  Possessive, so that a long
# tag needs no stack.
_INSIDE = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""
_TAG = rf"</?[A-Za-z!?]{_INSIDE}>"
_ANCHOR = rf"(?i)<a(\s{_INSIDE})>"
_ATTRIBUTE = r"""[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+"""
_HIDDEN = rf"(?is)<!--.*?(?:-->|$)|<(script|style)\b{_INSIDE}>.*?(?:</\1\s*+>|$)"
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _character(code: Column) -> Column:
    """The character of a code point, null if there is none."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")


def unescape(col: str | Column) -> Column:
    """Decode character references (named, decimal, hexadecimal); unknown ones stay as they are."""
    text = _c(col)
    named = F.create_map(*[x for k, v in sorted(name2codepoint.items()) for x in (F.lit(k), F.lit(chr(v)))])
    named = F.map_concat(named, F.create_map(F.lit("apos"), F.lit("'")))

    def one(piece: Column) -> Column:
        body = F.substring(piece, 2, F.length(piece) - 2)
        decimal = F.try_to_number(F.substring(body, 2, 10), F.lit("9" * 10)).cast("long")
        hexadecimal = F.conv(F.substring(body, 3, 8), 16, 10).cast("long")
        found = F.when(body.rlike("^#[xX]"), _character(hexadecimal)).when(body.startswith("#"), _character(decimal)).otherwise(F.try_element_at(named, body))
        return F.when(piece.rlike(f"^{_REFERENCE}$"), F.coalesce(found, piece)).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(rf"{_REFERENCE}|[^&]++|&"), F.lit(0))
    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(pieces, one), "")).otherwise(text)


def shown(html: str | Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(_c(html), _HIDDEN, " ")


def attributes(inside: Column) -> Column:
    """Attributes of a tag from the text between its name and '>': (name in lower case, value), in
    order; an attribute without a value has the empty one."""

    def one(x: Column) -> Column:
        raw = F.regexp_extract(x, r"(?s)=\s*+(.*)$", 1)
        value = F.when(raw.rlike("""^["']"""), F.substring(raw, 2, F.length(raw) - 2)).otherwise(raw)
        return F.struct(F.lower(F.regexp_extract(x, r"^([^\s=]+)", 1)).alias("name"), unescape(value).alias("value"))

    return F.transform(F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(0)), one)


def attribute(found: Column, name: str) -> Column:
    """Value of the first attribute of that name, null if there is none."""
    return F.try_element_at(F.filter(found, lambda a: a["name"] == name), F.lit(1))["value"]


def anchors(html: str | Column) -> Column:
    """The attributes of every link tag of a page, in order; null pages have none."""
    inside = F.regexp_extract_all(shown(html), F.lit(_ANCHOR), F.lit(1))
    return F.coalesce(F.transform(inside, attributes), F.array())


def extract_links(df: DataFrame, html: str, pattern: str, css_class: str | None = None, target: str | None = None) -> DataFrame:
    """Link targets that match ``pattern`` (a regular expression on the target), one row each, in any
    order of attributes and any quotes; with ``css_class`` only of links of that class, with ``target``
    only of links that open there."""
    found = df.select(*[c for c in df.columns if c != html], F.explode(anchors(html)).alias("_a"))
    a = F.col("_a")
    keep = attribute(a, "href").rlike(pattern)
    if css_class is not None:
        keep &= F.array_contains(F.split(F.trim(attribute(a, "class")), r"\s+"), css_class)
    if target is not None:
        keep &= attribute(a, "target") == target
    return found.where(keep).select(*[c for c in found.columns if c != "_a"], attribute(a, "href").alias("link"))


def title(html: str | Column) -> Column:
    """Text of the title, trimmed; empty if there is none."""
    return F.trim(unescape(F.regexp_extract(shown(html), rf"(?is)<title\b{_INSIDE}>(.*?)</title", 1)))


def visible_text(html: str | Column) -> Column:
    """The text outside tags and outside the head; the pieces between tags are trimmed and joined by one
    blank."""
    body = F.regexp_replace(shown(html), rf"(?is)<head(?:\s{_INSIDE})?>.*?</head\s*+>", " ")
    pieces = F.transform(F.split(body, _TAG), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    return unescape(F.array_join(F.filter(pieces, lambda p: p != ""), " "))


def page_text(df: DataFrame, html: str, min_len: int = 10) -> DataFrame:
    """Title and visible text of each page; rows whose text is not longer than ``min_len`` go."""
    p = df.select(*[c for c in df.columns if c != html], title(html).alias("title"), visible_text(html).alias("text"))
    return p.filter(F.length("text") > min_len)
