"""Surrogates for personal data: keyed, of the same type and form, distinct and consistent.

Detected entities are replaced by others of their kind.  The replacement is derived from a secret
key and the entity's canonical form, so an entity is replaced alike wherever it is mentioned, in
whatever notation.  It keeps punctuation, case, script and length, the country digit of a phone
number, the first digit and the check digit of a card number, the title and so the gender of a
name.  Before use all replacements are checked: one that equals an entity of the corpus, or that
another entity has taken already, is drawn anew.

Only DataFrame functions are used.  Texts without entities are not shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk.llm.common import stored

MALE = ("Mr", "Herr", "Herrn", "Señor", "Sr", "Don", "Monsieur", "Господин", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Doña", "Madame", "Mme", "Mlle", "Госпожа", "госпожа")

_APART = r"(?<![\p{L}\p{N}])"
_END = r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: What stands before a secret, in code, settings or JSON.
_BEFORE = r"(?<=(?i:password|passwd|secret|token|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)"
_NAME = r"\p{Lu}[\p{L}’'-]+(?: \p{Lu}[\p{L}’'-]+){0,2}"

#: Kinds in order of precedence, with their patterns.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]*@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}",
    "key": _APART + r"A[KS]IA[0-9A-Z]{16}" + _END,
    "secret": _BEFORE + r"(?=[A-Za-z+/_!@#$%^&*-]*\d)[A-Za-z0-9+/_!@#$%^&*-]{8,}",
    "ip": r"(?<![\p{L}\p{N}.])" + _OCTET + r"(?:\." + _OCTET + r"){3}(?!\.?[\p{L}\p{N}])",
    "iban": _APART + r"[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?" + _END,
    "card": r"(?<![\p{L}\p{N}+])\d(?:[ -]?\d){12,18}" + _END,
    "ssn": _APART + r"\d{3}-\d{2}-\d{4}" + _END,
    "phone": r"(?<![\p{L}\p{N}+])(?:"
    r"\+\d{1,3}(?:[ .-]?(?:\(\d{1,5}\)|\d{1,5})){2,5}"
    r"|\(\d{2,5}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}"
    r"|0\d{1,4}[ /.-]\d{2,4}(?:[ .-]?\d{2,4}){1,3}"
    r"|\d{3}[ .-]\d{3}[ .-]\d{4})" + _END,
    "man": _APART + "(?:" + "|".join(MALE) + r")\.? " + _NAME,
    "woman": _APART + "(?:" + "|".join(FEMALE) + r")\.? " + _NAME,
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: Cheap test that every text with an entity passes.
HINT = r"[0-9@]|A[KS]IA|(?:" + "|".join(sorted({*MALE, *FEMALE})) + r")\.? \p{Lu}"

ALPHABETS = {
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    r"[\p{IsLatin}]": "abcdefghijklmnopqrstuvwxyz",
    r"[\p{IsCyrillic}]": "абвгдежзиклмнопрстуфхцчшэюя",
    r"[\p{IsGreek}]": "αβγδεζηθικλμνξοπρστυφχψω",
}
#: Syllables and gendered given names that replace names, by script.
LATIN = ("ba", "del", "fin", "gor", "hal", "jen", "kol", "lam", "mer", "nov", "pas", "rin", "sel", "tor", "vas", "wen")
CYRILLIC = ("ба", "дел", "фин", "гор", "хал", "жен", "кол", "лам", "мер", "нов", "пас", "рин", "сел", "тор", "вас", "зен")
GIVEN = {
    ("man", "Latin"): ("Albin", "Bruno", "Carl", "Denis", "Emil", "Felix", "Hugo", "Ivo", "Jonas", "Karim", "Leon", "Marco", "Nils", "Oskar", "Paul", "Ruben"),
    ("woman", "Latin"): ("Alba", "Bella", "Carla", "Denise", "Emma", "Flora", "Hanna", "Ines", "Jana", "Karin", "Lea", "Maria", "Nora", "Olga", "Paula", "Rosa"),
    ("man", "Cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Марк", "Никита", "Олег", "Павел", "Роман", "Семён", "Юрий"),
    ("woman", "Cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "София", "Юлия"),
}
#: From this attempt on a replacement may be longer than the entity.
RELAXED = 8
#: From this attempt on a replacement may equal an entity of the corpus: as many draws of one form
#: fail only where the corpus holds most of what this form can spell.
FULL = 24


def kind_of(mention: Column) -> Column:
    """The first kind whose pattern fits the whole mention."""
    picks = [F.when(mention.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in KINDS.items() if k != "secret"]
    return F.coalesce(*picks, F.lit("secret"))


def title_of(mention: Column) -> Column:
    return F.regexp_extract(mention, r"^(\p{L}+\.? )", 1)


def ending_of(mention: Column) -> Column:
    """The sign of the genitive."""
    return F.regexp_extract(mention, r"([’']s?)$", 1)


def name_in(mention: Column) -> Column:
    """A mention without title and ending."""
    start = F.length(title_of(mention))
    return F.substr(mention, start + 1, F.length(mention) - start - F.length(ending_of(mention)))


def canonical(kind: Column, mention: Column) -> Column:
    """What all notations of an entity share."""
    digits = F.regexp_replace(mention, r"[^0-9]", "")
    name = F.lower(name_in(mention))
    return (
        F.when(kind.isin("phone", "card", "ssn"), digits)
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when(kind == "email", F.lower(mention))
        .when(kind.isin("man", "woman"), name)
        .otherwise(mention)
    )


def surrogate(kind: Column, value: Column, attempt: Column, key: str, last_name: Column | None = None) -> Column:
    """The replacement of a canonical form at a number of attempts; a name of several words ends
    with ``last_name``, if there is one."""

    def draw(i: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string"), i.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")

    def pick(letters: str, i: Column) -> Column:
        return F.substr(F.lit(letters), (draw(i) % len(letters) + 1).cast("int"), F.lit(1))

    def letter(c: Column, i: Column) -> Column:
        low = reduce(lambda out, kv: out.when(F.lower(c).rlike(kv[0]), pick(kv[1], i)), ALPHABETS.items(), F.when(c.rlike("[0-9]"), pick("0123456789", i)))
        return F.when(c.rlike(r"\p{Lu}"), F.upper(low)).otherwise(F.coalesce(low, c))

    def spelled(fixed: Column, end: Column | None = None) -> Column:
        """Characters anew, but for the first ``fixed`` and those behind ``end``."""
        chars = F.split(value, "")
        kept = lambda i: (i < fixed) | (i >= end) if end is not None else i < fixed
        return F.array_join(F.transform(chars, lambda c, i: F.when(kept(i), c).otherwise(letter(c, i))), "")

    def luhn(digits: Column, but_last: bool = False) -> Column:
        """Sum of the digits, every second one doubled, counted from the last."""
        n = F.length(digits)
        each = F.transform(F.split(digits, ""), lambda c, i: _doubled(c.cast("int"), (n - i) % 2 == 0))
        if but_last:
            each = F.slice(each, F.lit(1), n - 1)
        return F.aggregate(each, F.lit(0), lambda s, x: s + x)

    spelt = spelled(F.lit(1))
    check = ((10 - luhn(spelt, True) % 10) % 10).cast("string")
    card = F.when(luhn(value) % 10 == 0, F.concat(F.substr(spelt, F.lit(1), F.length(spelt) - 1), check)).otherwise(spelt)

    def octet(part: Column, i: Column) -> Column:
        n = F.length(part)
        own = F.when(n == 1, draw(i) % 9 + 1).when(n == 2, draw(i) % 90 + 10).otherwise(draw(i) % 155 + 100)
        return F.when(attempt < RELAXED, own).otherwise(draw(i) % 254 + 1).cast("string")

    ip = F.array_join(F.transform(F.split(value, r"\."), octet), ".")
    top = F.length(value) - F.length(F.substring_index(value, ".", -1)) - 1
    local = F.when(attempt < RELAXED, F.lit("")).otherwise(attempt.cast("string"))
    email = F.concat(local, spelled(F.lit(0), top))

    def names(script: str, syllables: tuple[str, ...]) -> Column:
        one = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (draw(i) % len(values) + 1).cast("int"))
        given = F.when(kind == "man", one(GIVEN["man", script], F.lit(-1))).otherwise(one(GIVEN["woman", script], F.lit(-1)))
        count = F.lit(3) + F.floor(attempt / RELAXED).cast("int")
        last = F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: one(syllables, i)), ""))
        if script == "Cyrillic":
            last = F.concat(last, F.when(kind == "man", F.lit("ов")).otherwise(F.lit("ова")))
        if last_name is not None:
            # Given names are few: the later attempts add a second one, made of syllables.
            more = F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), count - 2), lambda i: one(syllables, i)), ""))
            given, last = F.when(attempt < RELAXED, given).otherwise(F.concat_ws("-", given, more)), last_name
        words = F.size(F.split(value, " "))
        middle = one(GIVEN["man", script] + GIVEN["woman", script], F.lit(-2))
        return F.when(words == 1, last).when(words == 2, F.concat_ws(" ", given, last)).otherwise(F.concat_ws(" ", given, middle, last))

    name = F.when(value.rlike(r"\p{IsCyrillic}"), names("Cyrillic", CYRILLIC)).otherwise(names("Latin", LATIN))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "card", card)
        .when(kind == "phone", spelled(F.lit(1)))
        .when(kind == "ssn", spelled(F.lit(0)))
        .when(kind == "iban", spelled(F.lit(2)))
        .when(kind == "key", spelled(F.lit(4)))
        .when(kind.isin("man", "woman"), name)
        .otherwise(spelled(F.lit(0)))
    )


def _doubled(digit: Column, twice: Column) -> Column:
    return F.when(~twice, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)


def rendered(kind: Column, mention: Column, replacement: Column) -> Column:
    """A replacement in the notation of a mention."""
    place = lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1), r"[^0-9A-Za-z]", ""))
    filled = F.array_join(
        F.transform(
            F.split(mention, ""),
            lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substr(replacement, place(i), F.lit(1))).otherwise(c),
        ),
        "",
    )
    cased = F.array_join(
        F.transform(
            F.split(replacement, ""),
            lambda c, i: F.when(F.substr(mention, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c),
        ),
        "",
    )
    named = F.concat(title_of(mention), as_written(name_in(mention), replacement), ending_of(mention))
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), filled)
        .when(kind == "email", cased)
        .when(kind.isin("man", "woman"), named)
        .otherwise(replacement)
    )


def as_written(name: Column, replacement: Column) -> Column:
    """In capitals if the name is."""
    return F.when(~name.rlike(r"\p{Ll}"), F.upper(replacement)).otherwise(replacement)


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for different (kind, value): no two surrogates are alike.

    The last word of a name is an entity, too, and its surrogate ends those of all longer names
    with this word.
    """
    entities = entities.select("kind", "value")
    long = F.col("kind").isin("man", "woman") & F.col("value").contains(" ")
    names = entities.where(long).withColumn("last", F.substring_index("value", " ", -1))
    short = stored(entities.where(~long).unionByName(names.select("kind", F.col("last").alias("value"))).distinct(), "short")
    done = stored(drawn_apart(short, short, key), "assigned")
    names = stored(names.join(done.select("kind", F.col("value").alias("last"), F.col("surrogate").alias("last_name")), ["kind", "last"]), "names")
    if names.isEmpty():
        return done
    return done.unionByName(drawn_apart(names.select("kind", "value", "last_name"), short.unionByName(entities.where(long)), key, done))


def drawn_apart(entities: DataFrame, originals: DataFrame, key: str, done: DataFrame | None = None) -> DataFrame:
    """(kind, value, surrogate) for ``entities``, apart from each other, the originals and ``done``.

    Of entities that draw the same one, the least keeps it, the others draw again; so do those
    that draw an entity of the corpus.  A round is a join of narrow rows; hardly any entity needs
    more than two.
    """
    last = F.col("last_name") if "last_name" in entities.columns else None
    columns = [c for c in ("kind", "value", "last_name") if c in entities.columns]
    pending = entities.select(*columns, F.lit(0).alias("attempt"))
    originals = stored(originals.select("value"), "originals")
    taken, won = done, None
    while True:
        drawn = stored(pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key, last)), "drawn")
        firsts = drawn.groupBy("surrogate").agg(F.min(F.struct("kind", "value")).alias("first"))
        used = originals.select(F.col("value").alias("surrogate"), F.lit(FULL).alias("until"))
        if taken is not None:
            used = used.unionByName(taken.select("surrogate", F.lit(1 << 30).alias("until")))
        used = used.groupBy("surrogate").agg(F.max("until").alias("until"))
        tried = drawn.join(firsts, "surrogate").join(used, "surrogate", "left").select(
            *columns, "attempt", "surrogate",
            ((F.col("first") == F.struct("kind", "value")) & (F.coalesce("until", F.lit(0)) <= F.col("attempt"))).alias("free"),
        )
        tried = stored(tried, "tried")
        new = tried.where("free").select("kind", "value", "surrogate")
        won = new if won is None else won.unionByName(new)
        taken = new if taken is None else taken.unionByName(new)
        pending = tried.where("not free").select(*columns, (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return won


def untitled(names: DataFrame) -> DataFrame:
    """(row, again, pattern) for names (row, nth, kind, value, surrogate) found in texts.

    ``again`` maps what may stand for a name without its title - the full name, given and last
    name, each word - to that part of its surrogate, ``pattern`` finds these, the longest first.
    Of several names with a word, one that ends with it goes first, then the one found first.
    """
    words, parts = F.split("value", " "), F.split("surrogate", " ")
    n = F.size(words)
    one = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.element_at(words, i).alias("name"), F.element_at(parts, i).alias("new"), (i < n).alias("inner")))
    ends = lambda x: F.concat_ws(" ", x[0], F.element_at(x, F.lit(-1)))
    whole = F.array(
        F.struct(F.col("value").alias("name"), F.col("surrogate").alias("new"), F.lit(False).alias("inner")),
        F.struct(F.when(n > 2, ends(words)).alias("name"), ends(parts).alias("new"), F.lit(False).alias("inner")),
    )
    each = names.select("row", "nth", "kind", F.explode(F.concat(whole, one)).alias("x")).select("row", "nth", "kind", "x.*")
    each = each.where("name is not null").groupBy("row", "name").agg(F.min_by("new", F.struct("inner", "nth", "kind")).alias("new"))
    found = F.transform(F.array_sort(F.collect_list(F.struct((-F.length("name")).alias("less"), "name"))), lambda x: x["name"])
    # A name starts with a capital letter, in whatever case the rest is written.
    pattern = F.concat(F.lit(_APART + r"(?=\p{Lu})(?iu:"), F.array_join(found, "|"), F.lit(")" + _END))
    return each.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("name", "new"))).alias("again"), pattern.alias("pattern"))


def replaced(docs: DataFrame, key: str = "surrogates") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``n_replaced``, how many there were.

    ``key`` is a secret of the caller's; with another key all replacements differ.  Texts that are
    missing, empty or without an entity stay as they are, as do all other columns (one named
    ``n_replaced`` is replaced).  Repeated rows and repeated mentions are replaced alike.  Names are
    found behind a title, in Latin and Cyrillic script, and from there on in the whole text also
    without the title: all of the name, its given and last name, each of its words.  What is
    detected in a text is nowhere left in it; a name that has no title in a text is not detected.
    """
    docs = docs.drop("n_replaced")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col("text")
    has = F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False))
    found = docs.where(has).select(F.struct(*columns).alias("kept"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("mentions"))
    found = stored(found.select(F.monotonically_increasing_id().alias("row"), "kept", "mentions"), "found")
    each = found.select("row", F.posexplode(F.array_distinct("mentions")).alias("nth", "mention"))
    each = each.withColumn("kind", kind_of(F.col("mention")))
    each = stored(each.withColumn("value", canonical(F.col("kind"), F.col("mention"))), "mentions")
    mapping = stored(assigned(each.select("kind", "value").distinct(), key), "mapping")
    met = each.join(mapping, ["kind", "value"])
    new = met.select("row", F.struct("mention", rendered(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("new")).alias("pair"))
    new = new.groupBy("row").agg(F.map_from_entries(F.collect_list("pair")).alias("new"))
    names = untitled(met.where(F.col("kind").isin("man", "woman")).select("row", "nth", "kind", "value", "surrogate"))
    changed = found.join(new, "row").join(names, "row", "left")
    any_ = F.coalesce(F.concat(F.lit(ANY + "|"), "pattern"), F.lit(ANY))
    mentions = F.when(F.col("pattern").isNull(), F.col("mentions")).otherwise(F.regexp_extract_all("kept.text", any_, F.lit(0)))
    changed = changed.select("kept", "new", "again", F.split(F.col("kept.text"), any_, -1).alias("parts"), mentions.alias("mentions"))
    part_of = lambda m: as_written(m, F.try_element_at("again", F.lower(m)))
    pieces = F.zip_with("parts", "mentions", lambda p, m: F.concat(p, F.coalesce(F.try_element_at("new", m), part_of(m), F.lit(""))))
    changed = changed.select("kept", F.array_join(pieces, "").alias("new_text"), F.size("mentions").alias("n_replaced"))
    changed = changed.select(
        *[F.col("new_text").alias("text") if c == "text" else F.col(f"kept.`{c}`").alias(c) for c in docs.columns], "n_replaced"
    )
    return docs.where(~has).withColumn("n_replaced", F.lit(0)).unionByName(changed)
