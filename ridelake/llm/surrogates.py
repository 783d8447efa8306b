"""Personal data replaced by keyed surrogates, in DataFrame functions alone.

One pattern finds entities; what stands between them is kept as it is. An entity's canonical form (lower case, or
digits without their punctuation) decides its surrogate, so all mentions of it change alike,
through the whole corpus, and each mention keeps its own layout and case. Surrogates replace letters by
letters of the same script and kind, digits by digits, hexadecimals by hexadecimals; a card number that
passes its check digit still does; given names and Cyrillic surnames keep the endings of the title's gender.

Distinct entities are few against their texts. They are gathered once and checked: where two would get one
surrogate, or a surrogate is itself an entity of the corpus, all but the first try again with the next number
in the key, until every entity has a surrogate of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridelake.llm.shared import stored

# Titles by gender. Fixed values.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин", "г-н", "Κύριος", "κ"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Госпожа", "г-жа", "Κυρία", "κα"),
    "n": ("Dr", "Prof", "Professor"),
}
# Letters of a script that stand for each other, vowels and others, and the endings that mark gender.
SCRIPTS = {
    "Cyrillic": ("аеиоуы", "бвгдзклмнпрстфх", "н", "а"),
    "Greek": ("αειουη", "βγδζκλμνπρστφχ", "ς", "α"),
    "Han": ("", "王李张刘陈杨黄赵吴周徐孙马朱胡郭何林高梁", "", ""),
    "Hiragana": ("", "かきくけこさしすせそたちつてとなにぬねの", "", ""),
    "Katakana": ("", "カキクケコサシスセソタチツテトナニヌネノ", "", ""),
    "Hangul": ("", "김이박최정강조윤장임한오서신권황안송류홍", "", ""),
    "Arabic": ("اوي", "بتجحدرسصطعفقكلمن", "", "ة"),
    "Hebrew": ("אהוי", "בגדזחטכלמנסעפצקרש", "", "ה"),
    "Latin": ("aeiou", "bcdfghklmnprstvw", "o", "a"),
}

_DIGITS = "0123456789"

_TITLE = "|".join(t for group in TITLES.values() for t in group)
_NAME = r"\p{Lu}[\p{L}'’]+(?:-\p{Lu}[\p{L}'’]+)?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# All start where no letter or digit stands before.
PATTERNS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}](?:[\p{L}\p{N}-]*\.)+\p{L}{2,}",
    "name": rf"(?:{_TITLE})\.? {_NAME}(?: {_NAME}){{0,2}}",
    "ip": rf"(?<!\.)(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ssn": r"(?<!-)\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?!\d)|\(\d{2,4}\) ?\d{3}[ .-]?\d{4}(?!\d)|(?<![.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "card": r"(?<![.-])\d(?:[ -]?\d){12,18}(?![\p{L}\d])",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})(?![\p{L}\p{N}])",
}
_NUMBERS = "|".join(PATTERNS[k] for k in ("ip", "ssn", "phone", "card"))
_WORDS = "|".join(PATTERNS[k] for k in ("name", "iban", "secret"))
ENTITY = rf"(?<![\p{{L}}\p{{N}}])(?:{PATTERNS['email']}|(?=[\d+(])(?:{_NUMBERS})|(?=[\p{{L}}\d])(?:{_WORDS}))"
MAX_ROUNDS = 100


def kind_of(m: Column) -> Column:
    """The kind of a match, told by its form."""
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(rf"^(?:{_TITLE})\.? "), "name")
        .when(m.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(m.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
        .when(m.rlike(r"^[\d -]+$") & ~m.rlike(r"^\d{32}"), "card")
        .when(m.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$") & ~m.rlike("^[0-9A-F]{32,}$"), "iban")
        .otherwise("secret")
    )


def gender_of(title: Column) -> Column:
    bare = F.regexp_replace(title, r"\.$", "")
    return F.when(bare.isin(*TITLES["m"]), "m").when(bare.isin(*TITLES["f"]), "f").otherwise("n")


def parts_of(m: Column) -> Column:
    """The entities in a match, ``type`` and ``canon`` of each: one, or one for each word of a name."""
    words = F.split(m, " ")
    gender = gender_of(words[0])

    def word(w: Column, i: Column) -> Column:
        # A surname is one for all who bear it, except where its ending tells the gender.
        surname = F.concat(F.lit("surname_"), F.when(w.rlike(r"^\p{IsCyrillic}"), gender).otherwise("n"))
        role = F.when(i == F.size(words) - 2, surname).otherwise(F.concat(F.lit("given_"), gender))
        return F.struct(role.alias("type"), F.lower(w).alias("canon"))

    kind = kind_of(m)
    digits = F.regexp_replace(m, r"\D", "")
    canon = (
        F.when(kind == "email", F.lower(m))
        .when(kind == "phone", F.concat(F.when(m.startswith("+"), "+").otherwise(""), digits))
        .when(kind.isin("ssn", "card"), digits)
        .when(kind == "iban", F.replace(m, F.lit(" "), F.lit("")))
        .otherwise(m)
    )
    return F.when(kind == "name", F.transform(F.slice(words, 2, F.size(words) - 1), word)).otherwise(
        F.array(F.struct(kind.alias("type"), canon.alias("canon")))
    )


# Surrogates of canonical forms


def _stream(key: str, *what: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[w.cast("string") for w in what]), 512)


def _number(stream: Column, i: Column, below: Column | int) -> Column:
    """A number below ``below`` for place ``i``, from two bytes of the stream."""
    at = F.pmod(i, F.lit(62)) * 2 + 1
    return F.pmod(F.conv(F.substr(stream, at, F.lit(4)), 16, 10).cast("int"), F.lit(below) if isinstance(below, int) else below)


def _one_of(letters: Column | str, stream: Column, i: Column) -> Column:
    letters = F.lit(letters) if isinstance(letters, str) else letters
    return F.substr(letters, _number(stream, i, F.length(letters)) + 1, F.lit(1))


def _pool(c: Column) -> Column:
    """The letters that ``c`` may become, of its script and kind; null if it is no letter of a known script."""
    low, out = F.lower(c), None
    for script, (vowels, others, _, _) in SCRIPTS.items():
        here = c.rlike(rf"^[\p{{L}}&&\p{{Is{script}}}]$")
        letters = F.when(low.rlike(f"^[{vowels}]$"), vowels).otherwise(others) if vowels else F.lit(others)
        out = F.when(here, letters) if out is None else out.when(here, letters)
    return out


def _chars(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(text, i, F.lit(1)))).otherwise(
        F.array().cast("array<string>")
    )


def _scrambled(text: Column, stream: Column) -> Column:
    """Every character replaced by one of the same script and kind, in its case; other characters stay."""

    def like(x: Column, i: Column) -> Column:
        c, new = x["c"], _one_of(x["pool"], stream, i)
        cased = F.when((F.upper(c) == c) & (F.lower(c) != c), F.upper(new)).otherwise(new)
        return F.when(x["pool"].isNull(), c).when(x["pool"] == _DIGITS, new).otherwise(cased)

    known = F.transform(_chars(text), lambda c: F.struct(c.alias("c"), F.when(c.rlike(r"^\d$"), _DIGITS).otherwise(_pool(c)).alias("pool")))
    return F.array_join(F.transform(known, like), "")


def _luhn(digits: Column, doubled_from: int) -> Column:
    """Sum of the digits' check, where each second digit from the right is doubled, from place ``doubled_from``."""
    values = F.transform(F.reverse(_chars(digits)), lambda c, i: F.when(F.pmod(i, F.lit(2)) == doubled_from, c.cast("int") * 2).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0))


def with_surrogate(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (``type, canon, attempt``) with the ``surrogate`` of each under the key.

    What all kinds share is a column of its own, so that no expression holds it more than once: the stream of numbers, and
    the text whose characters are replaced.
    """
    kind, canon, attempt = F.col("type"), F.col("canon"), F.col("attempt")
    local, domain = F.split_part(canon, F.lit("@"), F.lit(1)), F.split_part(canon, F.lit("@"), F.lit(2))
    prefix = F.regexp_extract(canon, r"^(?:AKIA|gh[pousr]_|sk-|xox[abprs]-)?", 0)
    # Short names have few surrogates: later attempts add letters.
    longer = F.concat(canon, F.repeat(F.substr(canon, F.lit(-1), F.lit(1)), F.floor(attempt / 4).cast("int")))
    open_ = (
        F.when(kind == "email", local).when(kind == "iban", F.substr(canon, F.lit(3))).when(kind == "secret", F.substr(canon, F.length(prefix) + 1))
        .when(kind.isin("card", "phone", "ip", "ssn"), canon).otherwise(longer)
    )
    made = entities.withColumns({"_own": _stream(key, kind, canon, attempt), "_domain": _stream(key, F.lit("domain"), domain), "_open": open_})
    made = made.withColumn("_word", _scrambled(F.col("_open"), F.col("_own")))
    return made.withColumn("surrogate", _surrogate(kind, canon, F.col("_own"), F.col("_word"))).drop("_own", "_domain", "_open", "_word")


def _surrogate(kind: Column, canon: Column, own: Column, word: Column) -> Column:
    """The surrogate of a canonical form: ``word``, its open part replaced, put into the form of its kind."""
    domain = F.split_part(canon, F.lit("@"), F.lit(2))
    top = F.regexp_extract(domain, r"\.[^.]+$", 0)
    inner = F.regexp_replace(domain, r"\.[^.]+$", "")
    email = F.concat(word, F.lit("@"), _scrambled(inner, F.col("_domain")), top)

    body = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(word, F.lit(2), F.length(canon) - 2))
    check = F.pmod(10 - F.pmod(_luhn(body, 0), F.lit(10)), F.lit(10)).cast("string")
    card = F.concat(body, F.when(_luhn(canon, 1) % 10 == 0, check).otherwise(F.substr(word, F.length(canon), F.lit(1))))

    phone = F.concat(F.regexp_extract(canon, r"^\+?\d", 0), F.substr(word, F.length(F.regexp_extract(canon, r"^\+?\d", 0)) + 1))
    ip = F.array_join(F.transform(F.split(canon, r"\."), lambda _, i: (_number(own, i, 254) + 1).cast("string")), ".")
    iban = F.concat(F.substr(canon, F.lit(1), F.lit(2)), word)

    hexes = "0123456789abcdef"
    in_hex = F.array_join(F.transform(_chars(canon), lambda _, i: _one_of(hexes, own, i)), "")
    prefix = F.regexp_extract(canon, r"^(?:AKIA|gh[pousr]_|sk-|xox[abprs]-)?", 0)
    secret = (
        F.when(canon.rlike("^[0-9a-f]+$"), in_hex)
        .when(canon.rlike("^[0-9A-F]+$"), F.upper(in_hex))
        .otherwise(F.concat(prefix, word))
    )

    gender = F.substr(kind, F.lit(-1), F.lit(1))
    ended = F.when(gender == "n", word)
    for script, (_, _, male, female) in SCRIPTS.items():
        marks = canon.rlike(rf"^\p{{Is{script}}}") & (kind.startswith("given") | F.lit(script == "Cyrillic")) & (F.length(word) > 1)
        cut = F.substr(word, F.lit(1), F.length(word) - 1)
        for g, end in (("m", male), ("f", female)):
            if end:
                ended = ended.when(marks & (gender == g), F.concat(cut, F.lit(end)))
    name = ended.otherwise(word)
    return (
        F.when(kind == "email", email).when(kind == "card", card).when(kind == "phone", phone).when(kind == "ip", ip)
        .when(kind == "ssn", word).when(kind == "iban", iban).when(kind == "secret", secret).otherwise(name)
    )


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """``type, canon, surrogate`` for distinct entities: different entities of a type get different surrogates, none of which is an entity.

    Genders of one role are compared together. Each round is one pass over the entities and one count.
    """
    role = F.regexp_replace("type", "_[mfn]$", "")
    entities = stored(entities.withColumn("role", role), "entities")
    taken = entities.select("role", F.col("canon").alias("surrogate"), F.lit(True).alias("taken")).distinct()
    now = entities.withColumn("attempt", F.lit(0))
    for _ in range(MAX_ROUNDS):
        tried = with_surrogate(now, key)
        first = Window.partitionBy("role", "surrogate").orderBy("attempt", "canon", "type")
        judged = tried.join(taken, ["role", "surrogate"], "left").withColumn("clash", F.col("taken").isNotNull() | (F.row_number().over(first) > 1))
        now = stored(judged.select("type", "canon", "role", "attempt", "surrogate", "clash"), "surrogates")
        if not now.where("clash").limit(1).count():
            return now.select("type", "canon", "surrogate")
        now = now.select("type", "canon", "role", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))
    raise RuntimeError(f"no distinct surrogates after {MAX_ROUNDS} attempts")


# Texts


def _name_of(kind: Column, canon: Column) -> Column:
    return F.concat(kind, F.lit("|"), canon)


def _in_case(surrogate_: Column, original: Column) -> Column:
    """A word of a name in the case of the original: capitals throughout, or the first letter."""
    return F.when((F.upper(original) == original) & (F.length(original) > 1), F.upper(surrogate_)).otherwise(
        F.concat(F.upper(F.substr(surrogate_, F.lit(1), F.lit(1))), F.substr(surrogate_, F.lit(2)))
    )


def replaced(m: Column, known: Column) -> Column:
    """The text that stands for a match; ``known`` maps the names of entities to surrogates."""
    kind, parts = kind_of(m), parts_of(m)
    get = lambda part: F.element_at(known, _name_of(part["type"], part["canon"]))
    one = get(parts[0])
    bare = F.replace(one, F.lit("+"), F.lit(""))
    seen = lambda i, what: F.length(F.regexp_replace(F.substr(m, F.lit(1), i + 1), what, ""))
    laid = F.array_join(F.transform(_chars(m), lambda c, i: F.when(c.rlike(r"^\d$"), F.substr(bare, seen(i, r"\D"), F.lit(1))).otherwise(c)), "")
    spaced = F.array_join(F.transform(_chars(m), lambda c, i: F.when(c == " ", c).otherwise(F.substr(one, seen(i, " "), F.lit(1)))), "")
    cased = F.array_join(F.transform(_chars(m), lambda c, i: F.when((F.upper(c) == c) & (F.lower(c) != c), F.upper(F.substr(one, i + 1, F.lit(1)))).otherwise(F.substr(one, i + 1, F.lit(1)))), "")
    words = F.split(m, " ")
    named = F.array_join(F.concat(F.slice(words, 1, 1), F.transform(parts, lambda p, i: _in_case(get(p), F.get(words, i + 1)))), " ")
    return (
        F.when(kind == "name", named).when(kind.isin("phone", "card", "ssn"), laid).when(kind == "iban", spaced)
        .when(kind == "email", cased).otherwise(one)
    )


def pseudonymise(docs: DataFrame, *, text_col: str = "text", key: str = "change me") -> DataFrame:
    """``docs`` with the entities in ``text_col`` replaced, and ``n_entities`` (long), the mentions replaced.

    All rows and columns stay; a text without entities stays as it is, as does an empty one; a null text is null
    with 0 mentions. The result depends on the texts and the key alone, not on ids or order. A column named
    ``n_entities`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_entities", "_pii_key", "_pii_known")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    text = F.col(f"`{text_col}`").cast("string")
    matches = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    some = F.coalesce(text.rlike(ENTITY), F.lit(False))
    key_of = F.xxhash64(text)

    found = rows.where(some).select(key_of.alias("_pii_key"), F.explode(F.array_distinct(F.flatten(F.transform(matches, parts_of)))).alias("e"))
    found = stored(found.select("_pii_key", "e.type", "e.canon").distinct(), "mentions")
    table = assigned(found.select("type", "canon").distinct(), key)
    known = found.join(table, ["type", "canon"]).groupBy("_pii_key").agg(
        F.map_from_entries(F.collect_list(F.struct(_name_of(F.col("type"), F.col("canon")), F.col("surrogate")))).alias("_pii_known")
    )
    # Only texts with entities move; their maps are as small as what a text holds.
    changed = rows.where(some).withColumn("_pii_key", key_of).join(known, "_pii_key")
    new = F.transform(matches, lambda m: replaced(m, F.col("_pii_known")))
    between = F.split(text, ENTITY, -1)
    whole = F.array_join(F.transform(between, lambda x, i: F.concat(x, F.coalesce(F.get(new, i), F.lit("")))), "")
    out = [whole.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept]
    changed = changed.select(*out, F.size(matches).cast("long").alias("n_entities"))
    same = rows.where(~some).select(*kept, F.lit(0).cast("long").alias("n_entities"))
    return same.unionByName(changed)
