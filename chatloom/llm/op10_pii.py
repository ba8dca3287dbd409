"""Personal data: keyed surrogates of the same type, script and format.

Entities are found by one pattern, the text is split at them, and each is replaced by a surrogate
computed from the entity and a secret key alone. Every part of a surrogate is a keyed permutation of
the values of its format:

* digit strings (cards, phone and social security numbers) go through a Feistel network of modular
  additions over their digits; a card keeps its issuer digit (two of 14 or 15
  digits, four of the 2 series) and how far its check digit is off;
* addresses (IPv4) go through the same over (first two bytes, last two bytes), first byte 1 to 255;
* letters and digits of mail addresses go through chained keyed shifts, forward and backward, that
  keep case, script and character class; hosts end in the reserved ``.example``;
* known given names go to given names of the same gender and script by a keyed rotation; other
  names go through the chained shifts, vowels to vowels and consonants to consonants, and keep
  their last letter, which often marks gender.

So one entity has one surrogate everywhere (coreference, across formats of a phone number and case
too), and two entities do not share one (distinctness) without a table of all entities in memory.
``collision_free_key`` checks that over a whole corpus, on one pre-aggregated row per entity, and
goes on to the next version of the key if two entities met, which the mix of lists and shifts for
names leaves as a remote chance. The digit permutations also leave no value as it was: one that
would map to itself swaps images with its neighbour.

All of it is DataFrame functions. Edge cases: a null text stays null, an empty one empty; rows that
repeat get equal results; other columns are kept. Dotted numbers that are no address (first
byte 0, a byte above 255), digits inside longer digit strings and names without a
title or a known given name are left alone. Cards of 16 digits that begin with 3 to 6, and of 15
that begin with 34 or 37, are taken as they are; other lengths from 13 to 19 and the 2 series need
a valid check digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import fresh, keyed_long, materialize

KEY = "surrogates-1"

# Given names by gender and script, and titles.
GIVEN = {
    ("latin", "f"): (
        "Anna", "Maria", "Sophie", "Laura", "Julia", "Elena", "Carmen", "Claire",
        "Emma", "Olivia", "Alice", "Sarah", "Nina", "Marta", "Ingrid", "Camille",
    ),
    ("latin", "m"): (
        "John", "Peter", "Thomas", "Carlos", "Hans", "Pierre", "David", "Michael",
        "James", "Robert", "Lucas", "Daniel", "Felix", "Pablo", "Simon", "Martin",
    ),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана"),
    ("cyrillic", "m"): ("Иван", "Сергей", "Дмитрий", "Андрей", "Алексей", "Николай", "Павел", "Михаил"),
    ("greek", "f"): ("Ελένη", "Μαρία", "Κατερίνα", "Σοφία"),
    ("greek", "m"): ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας"),
}
TITLES = (
    "Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme",
    "Señor", "Señora", "Sr", "Sra", "Don", "Doña", "Г-н", "Г-жа",
)

_CAPITAL = r"\p{Lu}[\p{L}]+(?:[-'’]\p{Lu}\p{L}+)*"
_GIVEN = "|".join(name for names in GIVEN.values() for name in names)
_BEFORE = r"(?<![\p{L}\p{N}.+-])"
_AFTER = r"(?![\p{L}\p{N}]|[.-]\d)"
_BYTE = r"(?:\d|[1-9]\d|1\d\d|2[0-4]\d|25[0-5])"
# Cards that need no valid check digit, and those that do.
_CARD = (
    r"(?:[3-6]\d{15}|3[47]\d{13}|[3-6]\d{3}(?:(?: \d{4}){3}|(?:-\d{4}){3})"
    r"|3[47]\d\d(?: \d{6} |-\d{6}-)\d{5})"
)
_SERIES_2 = r"(?:222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)"
_CHECKED_CARD = (
    rf"(?:[3-6]\d{{12,18}}|{_SERIES_2}(?:\d{{12}}|(?: \d{{4}}){{3}}|(?:-\d{{4}}){{3}})"
    r"|3[0689]\d\d(?: \d{6} |-\d{6}-)\d{4})"
)
NUMBERS = {
    "ipv4": rf"(?:[1-9]|[1-9]\d|1\d\d|2[0-4]\d|25[0-5])(?:\.{_BYTE}){{3}}",
    "card": rf"(?:{_CARD}|{_CHECKED_CARD})",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "phone": (
        r"(?:(?:\+\d{1,3}[ .-]?|1[ .-]|1(?=\())?"
        r"(?:\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})"
        r"|\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}|1?[2-9]\d{9})"
    ),
}
# The first character is tested before anything else, and runs are possessive, so text without
# entities costs one class test for most characters.
_NUMBER = rf"(?=[0-9+(]){_BEFORE}(?:{'|'.join(NUMBERS.values())}){_AFTER}"
_EMAIL = (
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_][\p{L}\p{N}._%+-]*+@"
    r"(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?\.)+\p{L}{2,}(?![\p{L}\p{N}])"
)
_NAME = (
    r"(?=\p{Lu})(?<![\p{L}\p{N}])(?=[\p{L}-]++\.? \p{Lu})"
    rf"(?:(?:{'|'.join(TITLES)})\.? {_CAPITAL}(?: {_CAPITAL})?|(?:{_GIVEN}) {_CAPITAL})(?![\p{{L}}\p{{N}}])"
)
ENTITY = f"{_NUMBER}|{_NAME}|{_EMAIL}"
KINDS = ("email", "name", *NUMBERS)

# Classes of letters that replace each other; the chained shifts stay inside a class.
_NAME_CLASSES = (
    "aeiou", "bcdfghjklmnpqrstvwxyz", "àâáãåèéêëìíîïòóôõùúûäöü", "çñßšžćčłńśźż",
    "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "ъьё", "αειουηω", "βγδζθκλμνξπρστφχψ", "άέήίόύώϊϋ",
)
_MAIL_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "0123456789", "àâáãåèéêëìíîïòóôõùúûäöüçñß",
                 "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars(text: Column) -> Column:
    """The places of a text that has at least one character."""
    return F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1)))


def _feistel(high: Column, low: Column, high_size: Column, low_size: Column, key: str, tweak: Column):
    """A keyed permutation of pairs below (high_size, low_size), as a struct of both."""

    def step(turn: str, changes_high: bool):
        # Spark counts the parameters of these functions, so constants come in from around them.
        def change(p: Column) -> Column:
            if changes_high:
                number = keyed_long(f"{key}/{turn}", tweak, p["b"].cast("string"))
                return F.struct(((p["a"] + number) % high_size).alias("a"), p["b"].alias("b"))
            number = keyed_long(f"{key}/{turn}", tweak, p["a"].cast("string"))
            return F.struct(p["a"].alias("a"), ((p["b"] + number) % low_size).alias("b"))

        return change

    def rounds(pair: Column) -> Column:
        for turn in range(2):
            pair = _let(pair, step(f"a{turn}", True))
            pair = _let(pair, step(f"b{turn}", False))
        return pair

    def pair(a: Column, b: Column) -> Column:
        return F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))

    # All sizes are even, so a value and its neighbour are each other's neighbour.
    neighbour = pair(high, low.cast("bigint").bitwiseXOR(F.lit(1).cast("bigint")))
    return _let(
        F.struct(
            pair(high, low).alias("x"),
            rounds(pair(high, low)).alias("y"),
            neighbour.alias("m"),
            rounds(neighbour).alias("n"),
        ),
        lambda v: F.when((v["x"] == v["y"]) | (v["m"] == v["n"]), v["n"]).otherwise(v["y"]),
    )


def _permute_digits(digits: Column, key: str, tweak: Column) -> Column:
    """A string of 2 to 18 digits to another of that length."""
    return _let(digits, lambda value: _permuted(value, key, tweak))


def _permuted(digits: Column, key: str, tweak: Column) -> Column:
    size = F.char_length(digits)
    left = (size / 2).cast("int")

    def power(exponent: Column) -> Column:
        return F.rpad(F.lit("1"), exponent + 1, "0").cast("bigint")

    permuted = _feistel(
        F.substring(digits, F.lit(1), left).cast("bigint"),
        F.substring(digits, left + 1, size - left).cast("bigint"),
        power(left),
        power(size - left),
        key,
        tweak,
    )
    return _let(
        permuted,
        lambda p: F.concat(
            F.lpad(p["a"].cast("string"), left, "0"),
            F.lpad(p["b"].cast("string"), size - left, "0"),
        ),
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _laid_out(entity: Column, digits: Column) -> Column:
    """``digits`` in the places of the digits of ``entity``."""
    return _let(digits, lambda value: _placed(entity, value))


def _placed(entity: Column, digits: Column) -> Column:
    def at(place: Column) -> Column:
        char = F.substring(entity, place, F.lit(1))
        return F.when(
            char.between("0", "9"),
            F.substring(digits, F.char_length(_digits(F.substring(entity, F.lit(1), place))), F.lit(1)),
        ).otherwise(char)

    return F.array_join(F.transform(_chars(entity), at), "")


def _check_digit(payload: Column) -> Column:
    """The digit that makes a card number sum up to a multiple of ten."""
    return _let(payload, _luhn)


def _luhn(payload: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(payload, -place, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(
            place % 2 == 1, F.when(doubled > 9, doubled - 9).otherwise(doubled)
        ).otherwise(digit)

    total = F.aggregate(_chars(payload), F.lit(0), add)
    return (F.lit(10) - total % 10) % 10


def _card(entity: Column, key: str) -> Column:
    def made(digits: Column) -> Column:
        size = F.char_length(digits)
        payload = F.substring(digits, F.lit(1), size - 1)
        off = F.substring(digits, -1, 1).cast("int") - _check_digit(payload) + 10
        kept = F.when(digits.startswith("2"), 4).when(size.isin(14, 15), 2).otherwise(1)
        return _let(
            F.concat(
                F.substring(digits, F.lit(1), kept),
                _permute_digits(
                    F.substring(digits, kept + 1, size - kept - 1), key, F.lit("card")
                ),
            ),
            lambda new: F.concat(new, ((_check_digit(new) + off) % 10).cast("string")),
        )

    return _let(_digits(entity), lambda digits: _laid_out(entity, made(digits)))


def _number(entity: Column, key: str, kind: str, kept: int) -> Column:
    """All digits but the last ``kept`` at most stay: country code and first digit of a phone."""

    def made(digits: Column) -> Column:
        changed = F.least(F.lit(kept), F.char_length(digits))
        return F.concat(
            F.substring(digits, F.lit(1), F.char_length(digits) - changed),
            _permute_digits(
                F.substring(digits, F.char_length(digits) - changed + 1, changed), key, F.lit(kind)
            ),
        )

    return _let(_digits(entity), lambda digits: _laid_out(entity, made(digits)))


def _address(entity: Column, key: str) -> Column:
    def made(part: Column) -> Column:
        def byte(place: int) -> Column:
            return F.element_at(part, place).cast("bigint")

        permuted = _feistel(
            (byte(1) - 1) * 256 + byte(2),
            byte(3) * 256 + byte(4),
            F.lit(255 * 256).cast("bigint"),
            F.lit(65536).cast("bigint"),
            key,
            F.lit("ipv4"),
        )
        return _let(
            permuted,
            lambda p: F.concat_ws(
                ".",
                (F.floor(p["a"] / 256) + 1).cast("string"),
                (p["a"] % 256).cast("string"),
                F.floor(p["b"] / 256).cast("string"),
                (p["b"] % 256).cast("string"),
            ),
        )

    return _let(F.split(entity, r"\."), made)


def _chained(text: Column, classes: tuple[str, ...], key: str, tweak: str, kept: Column) -> Column:
    """Keyed shifts inside letter classes, chained forward and then backward; case is kept.

    The last ``kept`` characters stay. Each pass can be undone from the end it came from, so the
    whole is a permutation of the texts of one format.
    """
    return _let(text, lambda value: _shifted_twice(value, classes, key, tweak, kept))


def _shifted_twice(
    text: Column, classes: tuple[str, ...], key: str, tweak: str, kept: Column
) -> Column:

    def shifted(char: Column, number: Column) -> Column:
        chosen = None
        for letters in classes:
            place = F.position(char, F.lit(letters))
            moved = F.substring(
                F.lit(letters), ((place - 1 + number) % len(letters) + 1).cast("int"), F.lit(1)
            )
            chosen = F.when(place > 0, moved) if chosen is None else chosen.when(place > 0, moved)
        return chosen.otherwise(char)

    def one_pass(source: Column, forward: bool) -> Column:
        def at(place: Column) -> Column:
            rest = (
                F.substring(source, F.lit(1), place - 1)
                if forward
                else F.substring(source, place + 1, F.char_length(source))
            )
            number = keyed_long(f"{key}/{tweak}{'f' if forward else 'b'}", place.cast("string"), rest)
            char = F.substring(source, place, F.lit(1))
            moved = _let(
                F.struct(char.alias("char"), number.alias("number")),
                lambda v: shifted(v["char"], v["number"]),
            )
            return F.when(place > F.char_length(source) - kept, char).otherwise(moved)

        return F.array_join(F.transform(_chars(source), at), "")

    mixed = _let(
        F.lower(text), lambda low: _let(one_pass(low, True), lambda once: one_pass(once, False))
    )

    def recased(new: Column) -> Column:
        def at(place: Column) -> Column:
            old = F.substring(text, place, F.lit(1))
            char = F.substring(new, place, F.lit(1))
            return F.when(old != F.lower(old), F.upper(char)).otherwise(char)

        return F.array_join(F.transform(_chars(text), at), "")

    return _let(mixed, recased)


def _email(entity: Column, key: str) -> Column:
    local = F.substring_index(entity, "@", 1)
    host = F.substring_index(entity, "@", -1)
    none = F.lit(0)
    return F.concat(
        _chained(local, _MAIL_CLASSES, key, "local", none),
        F.lit("@"),
        _chained(host, _MAIL_CLASSES, key, "host", none),
        F.lit(".example"),
    )


_TITLE = rf"^(?:{'|'.join(TITLES)})\.?$"
_ALL_GIVEN = tuple(name for names in GIVEN.values() for name in names)


def _name(entity: Column, key: str) -> Column:
    def other(token: Column) -> Column:
        kept = F.when(F.char_length(token) > 3, 1).otherwise(0)

        def again(new: Column) -> Column:
            # The image of no other name may be a known given name; one more round leads out.
            return F.when(
                new.isin(*_ALL_GIVEN), _chained(new, _NAME_CLASSES, key, "name", kept)
            ).otherwise(new)

        return _let(_chained(token, _NAME_CLASSES, key, "name", kept), again)

    def part(token: Column) -> Column:
        chosen = F.when(token.rlike(_TITLE), token)
        for (script, gender), names in GIVEN.items():
            listed = F.array(*(F.lit(name) for name in names))
            shift = 1 + keyed_long(f"{key}/given", F.lit(script), F.lit(gender)) % (len(names) - 1)
            place = F.array_position(listed, token)
            chosen = chosen.when(
                token.isin(*names),
                F.element_at(listed, ((place - 1 + shift) % len(names) + 1).cast("int")),
            )
        return chosen.otherwise(other(token))

    return F.array_join(F.transform(F.split(entity, " "), part), " ")


def entity_kind(entity: Column) -> Column:
    size = F.char_length(_digits(entity))
    return (
        F.when(entity.contains("@"), "email")
        .when(entity.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ipv4")
        .when(entity.rlike(r"^\p{L}"), "name")
        .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(entity.rlike(r"^[2-6]") & size.between(13, 19), "card")
        .otherwise("phone")
    )


def surrogate(entity: Column, key: str = KEY) -> Column:
    """The replacement of one detected entity."""
    kind = entity_kind(entity)
    return (
        F.when(kind == "email", _email(entity, key))
        .when(kind == "ipv4", _address(entity, key))
        .when(kind == "name", _name(entity, key))
        .when(kind == "ssn", _number(entity, key, "ssn", 9))
        .when(kind == "card", _card(entity, key))
        .otherwise(_number(entity, key, "phone", 9))
    )


def _is_entity(match: Column) -> Column:
    """Whether a match of the pattern is one: some cards need a valid check digit."""

    def valid(digits: Column) -> Column:
        payload = F.substring(digits, F.lit(1), F.char_length(digits) - 1)
        return _check_digit(payload) == F.substring(digits, -1, 1).cast("int")

    unsure = match.rlike(f"^{_CHECKED_CARD}$") & ~match.rlike(f"^{_CARD}$")
    return F.when(unsure, _let(_digits(match), valid)).otherwise(True)


def detected(text: Column) -> Column:
    """The entities of a text in order."""
    return F.filter(_matches(text), _is_entity)


def _matches(text: Column) -> Column:
    """What the pattern finds in a text, in order."""
    # Every entity has a digit, an @ or a capital behind a space; most texts are tested only for it.
    return F.when(
        text.rlike(r"[0-9@]|\p{Lu}[\p{L}-]*+\.? \p{Lu}"),
        F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)),
    ).otherwise(F.array().cast("array<string>"))


def replaced(text: Column, matches: Column, key: str = KEY) -> Column:
    """``text`` with those of its ``matches`` that are entities replaced."""

    def new(match: Column) -> Column:
        return F.when(_is_entity(match), surrogate(match, key)).otherwise(match)

    pieces = F.zip_with(
        F.split(text, ENTITY, -1),
        matches,
        lambda piece, match: F.concat(
            piece, F.when(match.isNull(), F.lit("")).otherwise(new(match))
        ),
    )
    return F.when(F.size(matches) > 0, F.array_join(pieces, "")).otherwise(text)


def normal_entity(entity: Column) -> Column:
    """What two spellings of one entity have in common, with its kind in front."""

    def normal(value: Column) -> Column:
        kind = entity_kind(value)
        digits = F.regexp_replace(value, r"^\+?1(?=\D|\d{10}$)|[^0-9]", "")
        return F.concat_ws(
            ":",
            kind,
            F.when(kind.isin("email", "name"), F.lower(value))
            .when(kind == "ipv4", value)
            .otherwise(digits),
        )

    return _let(entity, normal)


def surrogate_collisions(entities: DataFrame, key: str = KEY) -> DataFrame:
    """Surrogates that two different entities of a column ``entity`` share.

    Entities are made distinct before the shuffle, so a frequent one is one row of each task.
    """
    distinct = entities.groupBy(normal_entity(F.col("entity")).alias("normal")).agg(
        F.min("entity").alias("entity")
    )
    made = distinct.select(normal_entity(surrogate(F.col("entity"), key)).alias("surrogate"))
    return made.groupBy("surrogate").agg(F.count(F.lit(1)).alias("entities")).where(
        F.col("entities") > 1
    )


def collision_free_key(docs: DataFrame, key: str = KEY, attempts: int = 8) -> str:
    """The first version of ``key`` under which no two entities of the corpus share a surrogate."""
    found = docs.select(detected(F.col("text")).alias("entities")).where(F.size("entities") > 0)
    entities = materialize(
        found.select(F.explode("entities").alias("entity")).distinct(), "entities"
    )
    for attempt in range(attempts):
        version = key if attempt == 0 else f"{key}#{attempt}"
        if surrogate_collisions(entities, version).isEmpty():
            return version
    raise ValueError(f"no version of the key keeps the entities apart in {attempts} attempts")


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, ``n_chars`` of the new text where that column is there,
    and the array ``entity_kinds`` of what was replaced (instead of any column of that name)."""
    columns = [name for name in docs.columns if name != "entity_kinds"]
    matches = fresh("matches", columns)
    found = docs.select(*columns, _matches(F.col("text")).alias(matches))
    done = found.withColumn("text", replaced(F.col("text"), F.col(matches), key))
    if "n_chars" in columns:
        # Kept as it was where nothing was replaced.
        done = done.withColumn(
            "n_chars",
            F.when(F.size(matches) > 0, F.char_length("text").cast("bigint")).otherwise(
                F.col("n_chars")
            ),
        )
    return done.select(
        *columns,
        F.transform(
            F.filter(F.coalesce(F.col(matches), F.array().cast("array<string>")), _is_entity),
            entity_kind,
        ).alias("entity_kinds"),
    )
