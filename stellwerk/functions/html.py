"""Readable text from HTML."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk.functions.text import bound, squeeze

_HIDDEN = r"(?is)<(script|style)\b[^>]*>.*?</\1>"
_BLOCK_END = r"(?i)</(p|div|li|tr|h[1-6])\s*>|<br\s*/?>"
_TAG = r"<[^>]+>"
# What may follow an ampersand, as the HTML standard reads it.
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LOST = "�"


def _windows(code: int) -> str:
    """The sign that numbers of control codes stand for in practice."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _mapped(table: dict[str, str]) -> Column:
    """A map literal; read from one string, as it holds up to some 2,000 names."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def strip_tags(markup: Column) -> Column:
    """Markup removed, block ends turned into line breaks, entities untouched."""
    text = F.regexp_replace(markup, _HIDDEN, " ")
    text = F.regexp_replace(text, _BLOCK_END, "\n")
    return F.regexp_replace(text, _TAG, " ")


def _character(number: Column) -> Column:
    """The character of a numeric reference."""
    special = _mapped({"0": _LOST, "13": "\r"} | {str(c): _windows(c) for c in range(0x80, 0xA0)})
    low = number.bitwiseAND(F.lit(0xFFFF))
    nothing = (
        number.between(1, 8) | (number == 0x0B) | number.between(0x0E, 0x1F) | number.between(0x7F, 0x9F)
        | number.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE)
    )
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.coalesce(
        F.try_element_at(special, number.cast("string")),
        F.when(number.between(0xD800, 0xDFFF) | (number > 0x10FFFF) | number.isNull(), _LOST).when(nothing, "").otherwise(plain),
    )


def _reference(name: Column) -> Column:
    """The text that a reference (without its ampersand) stands for."""
    digits = F.regexp_replace(name, "[#xX;]", "")
    hexadecimal = name.rlike("^#[xX]")
    # More digits than any code point has are too large, whatever they say.
    long = F.length(F.regexp_replace(digits, "^0+", "")) > 12
    number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits)
    number = F.when(long, F.lit(1 << 40)).otherwise(number.try_cast("long"))
    every = _mapped(html5)
    old = {k: v for k, v in html5.items() if not k.endswith(";")}
    short = _mapped(old)
    # Some names of old count without a semicolon, whatever letters follow.
    begun = [
        F.when(F.length(name) > n, F.concat(F.try_element_at(short, F.substring(name, 1, n)), F.substr(name, F.lit(n + 1))))
        for n in range(max(map(len, old)), 1, -1)
    ]
    named = F.coalesce(F.try_element_at(every, name), *begun, F.concat(F.lit("&"), name))
    return F.when(F.startswith(name, F.lit("#")), bound(number, _character)).otherwise(named)


def decoded(text: Column) -> Column:
    """Character references replaced, as ``html.unescape`` does; texts without any are left alone."""

    def part(p: Column) -> Column:
        name = F.regexp_extract(p, _REFERENCE, 1)
        whole = F.concat(_reference(name), F.substr(p, F.length(name) + 1))
        return F.when(name == "", F.concat(F.lit("&"), p)).otherwise(whole)

    def joined(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), part)
        return F.concat(parts[0], F.array_join(rest, ""))

    return F.when(F.contains(text, F.lit("&")), bound(F.split(text, "&", -1), joined)).otherwise(text)


def tidy_lines(text: Column) -> Column:
    """Blanks squeezed inside lines, empty lines dropped."""
    lines = F.transform(F.split(text, "\n"), squeeze)
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def html_to_text(markup: Column) -> Column:
    """Readable text of ``markup``; '' for null."""
    return F.coalesce(tidy_lines(decoded(strip_tags(markup))), F.lit(""))
