"""Contact and pay read from detail fields and free text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk.functions.text import (
    CASED,
    CASELESS,
    bound,
    filled,
    first_filled,
    join_filled,
    squeeze,
)

# Fixed patterns of contact data.
EMAIL = r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"
PHONE = r"(?:\+49|0)\d[\d\s/().-]{6,20}\d"
_NAME = r"[A-ZÄÖÜ][\w-]+"
_DEGREE = r"(?:Dr\.|Prof\.)?\s*"
_SALUTATION = r"(?:Herrn?|Frau)"
NAMED_CONTACT = (
    r"Ansprechpartner(?:in)?\w*\s*(?:ist|:|-)?\s*"
    rf"({_SALUTATION}?\s*{_DEGREE}{_NAME}(?:\s+{_NAME}){{0,2}})"
)
SALUTATION = rf"\b{_SALUTATION}\s+{_DEGREE}{_NAME}(?:\s+{_NAME})?"

# Fixed patterns of pay.
_AMOUNT = r"\d{2,3}(?:[.\s]\d{3})"
_CURRENCY = r"(?:€|Euro|EUR)"
PAY_RANGE = rf"{_AMOUNT}\s*{_CURRENCY}?\s*(?:bis|-|–|—)\s*{_AMOUNT}\s*{_CURRENCY}"
PAY_AMOUNT = rf"(?:{_AMOUNT}\s*{_CURRENCY}|{_CURRENCY}\s*{_AMOUNT}|\d{{2,3}}\s?k\s?{_CURRENCY})"
PAY_GRADE = (
    r"(?:TV(?:Ö|OE|O)D(?:[\s-]?[A-Z]+)?\s*[-–]?\s*(?:E\s?)?\d{1,2}"
    r"|TV[-\s]?L\s*(?:E\s?)?\d{1,2}|Entgeltgruppe\s+\d{1,2}|\bEG\s?\d{1,2}\b)"
)


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    """First match, squeezed; null if none."""
    return bound(
        squeeze(F.regexp_extract(text, pattern, group)), lambda hit: F.when(hit != "", hit)
    )


def _if_any(lowered: Column, hints: tuple[str, ...], value: Column) -> Column:
    """``value`` where one of the hints occurs, else null; the hints are cheap to look for."""
    hinted = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(h)) for h in hints])
    return F.when(hinted, value)


def contact_block(*blocks: Column) -> Column:
    """The first contact struct that is present."""
    return F.coalesce(*blocks)


def contact_person(block: Column | None, text: Column) -> Column:
    """Name from the contact fields, else from the text; '' if none."""
    text = F.coalesce(text, F.lit(""))
    found = [
        _if_any(text, ("Ansprechpartner",), _found(text, CASED + NAMED_CONTACT, 1)),
        _if_any(text, ("Herr", "Frau"), _found(text, CASED + SALUTATION)),
    ]
    if block is not None:
        whole = join_filled(" ", *[block[f] for f in ("anrede", "titel", "vorname", "nachname")])
        found = [F.nullif(whole, F.lit("")), filled(block["name"]), *found]
    return F.coalesce(*found, F.lit(""))


def contact_address(block: Column | None, text: Column) -> Column:
    """'mail / phone', each from the fields, else from the text."""
    text = F.coalesce(text, F.lit(""))
    mail = [_if_any(text, ("@",), _found(text, CASED + EMAIL))]
    phone = [_found(text, CASED + PHONE)]
    if block is not None:
        mail = [filled(block["email"]), filled(block["mail"]), *mail]
        names = ("telefon", "telefonnummer", "tel", "rufnummer")
        phone = [*[filled(block[n]) for n in names], *phone]
    return F.concat_ws(" / ", F.coalesce(*mail), F.coalesce(*phone))


def contact(block: Column | None, text: Column) -> Column:
    """Person and address in one cell."""
    return join_filled(" · ", contact_person(block, text), contact_address(block, text))


def pay_from_text(text: Column) -> Column:
    """A range, else an amount, else a pay grade; '' if none."""
    text = F.coalesce(text, F.lit(""))
    money, group = ("€", "eur"), ("tv", "entgeltgruppe", "eg")

    def read(lowered: Column) -> Column:
        return F.coalesce(
            _if_any(lowered, money, _found(text, CASELESS + PAY_RANGE)),
            _if_any(lowered, money, _found(text, CASELESS + PAY_AMOUNT)),
            _if_any(lowered, group, _found(text, CASELESS + PAY_GRADE)),
            F.lit(""),
        )

    return bound(F.lower(text), read)


def pay(stated: Column, tariff_detail: Column, tariff_own: Column, text: Column) -> Column:
    """Stated pay, else the tariff agreement, else what the text says."""
    tariff = F.nullif(first_filled(tariff_detail, tariff_own), F.lit(""))
    by_tariff = F.concat(F.lit("nach Tarifvertrag ("), tariff, F.lit(")"))
    return F.coalesce(filled(stated), by_tariff, pay_from_text(text))


