"""HTML fragments as column expressions: find elements, read their text."""

import json
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import clean_text, extract_or_null

_BLOCKS = (
    "address|article|aside|blockquote|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|"
    "header|hr|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul"
)


# White space, listed: Java tests a list of characters by one lookup.
_SPACE = r" \t\n\x0B\f\r"

# What stands in a tag: anything but its end, and quoted values, which may hold a
# ">". Possessive, so long tags neither backtrack nor recurse.
_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""


def _before(attr: str) -> str:
    """What stands in a tag before the attribute."""
    return rf"""(?:[^{_SPACE}>"']++|"[^"]*+"|'[^']*+'|[{_SPACE}]++(?!{attr}[{_SPACE}=>/]))*+"""


def opening_tag(tag: str, attr: str | None = None, value: str | None = None) -> str:
    """Pattern of an opening tag, optionally with an attribute (and its value)."""
    if attr is None:
        return rf"(?is)<{tag}\b{_INSIDE}>"
    space = f"[{_SPACE}]"
    tail = (
        rf"""{space}*+={space}*+(?:"{value}"|'{value}'|{value}(?=[{_SPACE}>]))"""
        if value
        else rf"(?=[{_SPACE}=>/])"
    )
    return rf"(?is)<{tag}\b{_before(attr)}{space}++{attr}{tail}{_INSIDE}>"


_NAMED = json.dumps({"apos": "'"} | {name: chr(code) for name, code in name2codepoint.items()})


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_EDGE = "\uffff"  # stands in no text


def _split(text: Column, pattern: str) -> Column:
    """As ``F.split``, which compiles its pattern anew for every row; replacing
    keeps it, and a single character needs none."""
    return F.split(F.regexp_replace(text, pattern, _EDGE), _EDGE)


def _rest(pieces: Column) -> Column:
    return F.filter(pieces, lambda _, i: i > 0)


def _balanced(rest: Column, tag: str) -> Column:
    """The text up to the end tag that closes an already opened ``tag``, with
    nested elements of the same name counted in and out; all if none does."""

    def step(state: Column, part: Column) -> Column:
        depth = state["depth"] + F.when(part.startswith("/"), -1).otherwise(1)
        # depth 0 is final; the part that reaches it is not kept
        return F.when(state["depth"] == 0, state).otherwise(
            F.struct(
                depth.cast("int").alias("depth"),
                (state["kept"] + (depth > 0).cast("int")).alias("kept"),
            )
        )

    def kept(parts: Column) -> Column:
        # The first part comes before any tag of that name: it is always kept.
        start = F.struct(F.lit(1).alias("depth"), F.lit(1).alias("kept"))
        end = F.aggregate(_rest(parts), start, step)["kept"]
        return F.array_join(F.slice(parts, F.lit(1), end), "<")

    return let(_split(rest, rf"(?i)<(?=/?{tag}\b)"), kept)


def _until_closed(rest: Column, tag: str) -> Column:
    """As :func:`_balanced`; one regular expression when nothing is nested."""
    flat = F.regexp_extract(rest, rf"(?i)^(?:[^<]++|<(?!/{tag}\b))*+", 0)
    return let(
        flat,
        lambda text: F.when(text.rlike(rf"(?i)<{tag}\b"), _balanced(rest, tag)).otherwise(text),
    )


def inner_html(
    html: Column, tag: str, attr: str | None = None, value: str | None = None
) -> Column:
    """Array of the contents of all matching elements, in page order.

    A matching element inside another one ends the outer one early.
    """
    rests = _rest(_split(html, opening_tag(tag, attr, value)))
    return F.transform(rests, lambda rest: _until_closed(rest, tag))


def first_text(html: Column, tag: str, attr: str, value: str) -> Column:
    """Visible text of the first matching element, null if there is none."""
    return visible_text(F.get(inner_html(html, tag, attr, value), F.lit(0)))


def first_attribute(html: Column, tag: str, attr: str) -> Column:
    """Value of the attribute on the first ``tag`` that has it, null if none or
    empty."""
    space = f"[{_SPACE}]"
    pattern = rf"""(?is)<{tag}\b{_before(attr)}{space}++{attr}{space}*+={space}*+("[^"]*"|'[^']*'|[^{_SPACE}"'>]+)"""
    quoted = extract_or_null(html, pattern)
    return F.nullif(F.regexp_replace(quoted, r"""^["']|["']$""", ""), F.lit(""))


def _character(code: Column) -> Column:
    """The character of a Unicode code point; the replacement character where
    there is none."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    safe = F.when(valid, code).otherwise(0xFFFD)
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def decode_entities(text: Column) -> Column:
    """Named (HTML 4) and numeric character references, each decoded once."""
    names = F.from_json(F.lit(_NAMED), "map<string,string>")  # folded to a constant

    def character(body: Column) -> Column:
        hexa = F.conv(F.regexp_extract(body, "^#[xX]0*(.{1,8})$", 1), 16, 10).try_cast("bigint")
        number = F.regexp_extract(body, "^#([0-9]+)$", 1).try_cast("bigint")
        return F.when(
            body.startswith("#"), let(F.coalesce(hexa, number), _character)
        ).otherwise(F.try_element_at(names, body))

    def decode(piece: Column) -> Column:
        body = F.regexp_extract(
            piece, r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);", 1
        )
        known = let(body, lambda b: F.concat(character(b), F.substr(piece, F.length(b) + 2)))
        return F.coalesce(known, F.concat(F.lit("&"), piece))

    def decoded(pieces: Column) -> Column:
        rest = F.array_join(F.transform(_rest(pieces), decode), "")
        return F.concat(F.get(pieces, F.lit(0)), rest)

    return F.when(text.contains("&"), let(F.split(text, "&"), decoded)).otherwise(text)


def without_code(html: Column) -> Column:
    """The page without scripts, styles and comments, whose text may look like
    tags. To be applied to whole pages, before elements are looked for."""
    return F.regexp_replace(html, r"(?is)<(?:(script|style)\b.*?</\1\s*>|!--.*?-->)", "")


def _without_tags(html: Column) -> Column:
    # \x01 marks the edge of a block, \x02 a line break.
    t = F.regexp_replace(without_code(html), r"(?i)<br\b[^>]*>", "\x02")
    t = F.regexp_replace(t, rf"(?i)</?(?:{_BLOCKS})\b[^>]*>", "\x01")
    return F.regexp_replace(t, r"<[/!?\p{Alpha}][^>]*>", "")


def visible_text(html: Column) -> Column:
    """The text a reader of the page would see: block elements and ``<br>`` break
    lines, other tags vanish, runs of white space are one space, both ends are
    trimmed."""
    t = let(html, lambda h: F.when(h.contains("<"), _without_tags(h)).otherwise(h))
    t = F.regexp_replace(t, f"[{_SPACE}]+", " ")
    t = F.regexp_replace(t, "[ \x01\x02]*\x01[ \x01\x02]*", "\n")
    t = F.regexp_replace(t, " ?\x02 ?", "\n")
    return clean_text(F.translate(let(t, decode_entities), "\u00a0", " "))
