"""Personal data replaced by surrogates, with DataFrame functions only.

Detected entities (e-mail and IP addresses, phone, card, social security and account numbers,
secrets, names of persons) get replacements of the same type and format, derived from a secret key
and the entity alone: one entity has the same surrogate wherever it occurs, in any letter case or
grouping of digits. Surrogates of all entities of the corpus are checked against each other and
against the entities; of those that collide all but one are derived anew until none does. Later
attempts draw from more: longer names, local parts and addresses, and where a format has no free value left
(more entities than it has values) a bracketed word with the kind and a digest. Card and
account numbers must bear their checksum to be taken as such, and so do their surrogates.

A surname with a form of address is the person of that surname whom the text names in full, if there is one only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.llm.common import salted_join, stored, unused_prefix, without

# Forms of address and given names by gender and script, syllables for surnames.
TITLES_MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин"]
TITLES_FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Señora", "Госпожа"]
NAMES = {
    ("male", "latin"): [
        "James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Matthew", "Anthony", "Mark", "Paul", "Steven", "Andrew",
        "George", "Edward", "Kevin", "Brian", "Peter", "Hans", "Jürgen", "Klaus", "Wolfgang", "Stefan", "Uwe", "Pierre", "Jean", "Louis", "François", "Philippe", "José", "Carlos",
        "Juan", "Luis", "Miguel", "Javier", "Pedro",
    ],
    ("female", "latin"): [
        "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Nancy", "Lisa", "Margaret", "Alice", "Emily", "Emma", "Laura", "Julia",
        "Anna", "Ursula", "Petra", "Monika", "Sabine", "Maria", "Marie", "Claire", "Sophie", "Camille", "Hélène", "Isabelle", "María", "Carmen", "Lucía", "Ana", "Elena", "Rosa",
    ],
    ("male", "cyrillic"): ["Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей", "Михаил"],
    ("female", "cyrillic"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Светлана"],
}
#: Accented letters that are often written without their accent.
PLAIN = {"á": "a", "é": "e", "è": "e", "í": "i", "ü": "u", "ñ": "n", "ç": "c", "ё": "е"}
PLAIN |= {c.upper(): p.upper() for c, p in PLAIN.items()}
SYLLABLES = {
    "latin": ["bar", "ben", "cal", "dor", "fel", "gan", "hol", "kem", "lin", "mar", "nor", "pel", "ros", "sten", "tal", "wen"],
    "cyrillic": ["бар", "вол", "гор", "дан", "зор", "кал", "лом", "мир", "нов", "пет", "род", "сав", "тим", "фед", "хар", "яр"],
}

#: Attempts at a surrogate of the entity's own format.
LAST = 12

_L, _R = "(?<![\\p{L}\\p{N}])", "(?![\\p{L}\\p{N}])"



def _any_of(names: list[str]) -> str:
    """A pattern for any of these names, with or without their accents."""
    return "(?:" + "|".join("".join(f"[{c}{PLAIN[c]}]" if c in PLAIN else c for c in n) for n in names) + ")"


_TITLE = _any_of(["Dr", "Prof", *TITLES_MALE, *TITLES_FEMALE])
_GIVEN = _any_of([n for names in NAMES.values() for n in names])
_CAPITALS = _any_of([n.upper() for names in NAMES.values() for n in names])
#: Country codes of telephone numbers; the others have three digits.
_COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
_OCTET, _H = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])", "[0-9A-Fa-f]{1,4}"
_WORD = "\\p{Lu}\\p{Ll}+"
PATTERNS = {
    "email": "(?<![\\p{L}\\p{N}._%+-])[\\p{L}\\p{N}][\\p{L}\\p{N}._%+-]*+@[\\p{L}\\p{N}-]+(?:\\.[\\p{L}\\p{N}-]+)*\\.[A-Za-z]{2,}",
    "secret": _L + "(?:[0-9a-fA-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|xox[abp]-[A-Za-z0-9-]{10,})" + _R
    + "|(?<=(?i:token|secret|password|passwd|api_key|apikey)\\s?[=:]\\s?[\"'])[^\"'\\s]{8,}",
    "ip": f"(?<![\\p{{L}}\\p{{N}}.])(?:{_OCTET}\\.){{3}}{_OCTET}(?![0-9]|\\.[0-9])",
    "ipv6": f"(?<![\\p{{L}}\\p{{N}}:.])(?=[A-Fa-f:]*[0-9])(?:(?:{_H}:){{7}}{_H}|(?:{_H}:){{1,6}}(?::{_H}){{1,6}}|(?:{_H}:){{2,6}}:)(?![\\p{{L}}\\p{{N}}:])",
    "iban": _L + "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _R,
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": "\\+[0-9]{1,3}[ .-]?\\(?[0-9]{2,4}\\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9.-])(?:\\([0-9]{3}\\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])",
    "card": "(?<![0-9.])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
    "person": f"(?<!\\p{{L}})(?:{_TITLE}\\.? {_WORD}(?: \\p{{Lu}}\\.)?(?:[ -]{_WORD})?|{_GIVEN}(?: \\p{{Lu}}\\.)? {_WORD}(?:-{_WORD})?|{_CAPITALS} \\p{{Lu}}{{2,}}(?:-\\p{{Lu}}{{2,}})?)(?!\\p{{L}})",
}
ENTITY = "|".join(PATTERNS.values())
#: Whatever has an entity matches this, which is quicker to rule out.
HINT = f"[0-9@]|(?i:token|secret|passw|api_?key)|AKIA|gh[pousr]_|sk-|xox[abp]-|[a-fA-F]{{32}}|(?<!\\p{{L}})(?:{_TITLE}|{_GIVEN}|{_CAPITALS})\\.? \\p{{Lu}}"


def _matches(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _kind(entity: Column) -> Column:
    """The first pattern that the entity matches whole; values after a key word are secrets."""
    kind = F.lit("secret")
    for name in reversed([k for k in PATTERNS if k != "secret"]):
        kind = F.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    return F.when(entity.rlike("^[0-9a-fA-F]{32,64}$"), "secret").otherwise(kind)


def _gender(entity: Column) -> Column:
    """As the given name or the form of address says; ``any`` where neither does."""
    of = lambda g, titles: _any_of([*titles, *(n for (gender, _), names in NAMES.items() if gender == g for n in (*names, *map(str.upper, names)))])
    says = lambda g, titles: entity.rlike(f"^(?:(?:Dr|Prof)\\.? )?{of(g, titles)}[. ]")
    return F.when(says("female", TITLES_FEMALE), "female").when(says("male", TITLES_MALE), "male").otherwise("any")


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10: 0 for card numbers."""
    twice = lambda c, i: F.when(i % 2 == 1, c * 2 - F.when(c > 4, 9).otherwise(0)).otherwise(c)
    values = F.transform(F.transform(_chars(F.reverse(digits)), lambda c: c.cast("int")), twice)
    return F.aggregate(values, F.lit(0), lambda x, y: x + y) % 10


def _mod97(account: Column) -> Column:
    """An account number with its first four characters moved to the end, modulo 97: 1 where its check digits hold."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    step = lambda x, c: F.when(c.rlike("[0-9]"), x * 10 + c.cast("int")).otherwise(x * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(_chars(moved), F.lit(0), step)


def _holds(kind: Column, entity: Column) -> Column:
    """Whether an entity of a kind with a checksum bears it."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return F.when(kind == "card", _luhn(digits) == 0).when(kind == "iban", _mod97(F.regexp_replace(entity, " ", "")) == 1).otherwise(F.lit(True))


def _canonical(kind: Column, entity: Column) -> Column:
    """What all mentions of one entity share."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    # numbers of country 1 are often written without it
    north = entity.rlike("^\\+1[^0-9]") & (F.length(digits) == 11)
    country = F.length(F.regexp_extract(entity, f"^\\+({_COUNTRY})", 1))
    names = F.lower(F.regexp_replace(entity, f"^{_TITLE}\\.? ", ""))
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when((kind == "phone") & north, F.concat(F.lit("0:"), F.substring(digits, 2, 10)))
        .when(kind == "phone", F.concat(country.cast("string"), F.lit(":"), digits))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "person", F.concat(_gender(entity), F.lit(":"), names))
        .when(kind.isin("email", "ipv6") | entity.rlike("^[0-9a-fA-F]{32,64}$"), F.lower(entity))
        .otherwise(entity)
    )


def _hex(digest: Column, at: Column, most: int) -> Column:
    """A number under ``most`` (up to 4096) from the three hexadecimal digits at ``at``."""
    return F.pmod(F.conv(F.substring(digest, F.pmod(at, F.lit(126)) + 1, F.lit(3)), 16, 10).cast("int"), F.lit(most))


def _from(values: list[str], digest: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), _hex(digest, F.lit(at), len(values)) + 1)


def _same_shape(text: Column, digest: Column, skip: Column, wide: Column | None = None) -> Column:
    """Digits for digits and letters for letters, of the same case, after the first ``skip`` characters.

    Where ``wide`` holds there are letters for all other characters too.
    """
    case = F.when(F.upper(text) == text, 65).otherwise(97)

    def one(c: Column, i: Column) -> Column:
        n = i * 3
        return (
            F.when(i < skip, c)
            .when(c.rlike("[0-9]"), _hex(digest, n, 10).cast("string"))
            .when(c.rlike("\\p{Lu}"), F.char(_hex(digest, n, 26) + 65))
            .when(c.rlike("\\p{L}"), F.char(_hex(digest, n, 26) + 97))
            .otherwise(c if wide is None else F.when(wide, F.char(_hex(digest, n, 26) + case)).otherwise(c))
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """The replacement, in canonical form."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, attempt.cast("string")), 512)
    number = F.substring_index(canonical, ":", -1)
    octet = lambda n: _hex(digest, F.lit(3 * n), 254).cast("int") + 1
    hexadecimal = F.substring(digest, F.lit(1), F.length(canonical))
    names = F.split(number, "[ -]")
    cyrillic = number.rlike("\\p{IsCyrillic}")
    given = F.lit(None).cast("string")
    surname = F.lit(None).cast("string")
    both = {("any", script): [n for (_, own), names in NAMES.items() if own == script for n in names] for script in ("latin", "cyrillic")}
    for (gender, script), values in (NAMES | both).items():
        this = canonical.startswith(f"{gender}:") & (cyrillic if script == "cyrillic" else ~cyrillic)
        given = F.when(this, _from(values, digest, 0)).otherwise(given)
    for script, values in SYLLABLES.items():
        parts = [_from(values, digest, 5 * n + 5) for n in range(4)]
        longer = F.when(attempt > 2, F.concat(*[_from(values, digest, 5 * n + 40) for n in range(4)])).otherwise("")
        made = F.initcap(F.concat(*parts[:3], F.when(attempt > 0, parts[3]).otherwise(""), longer))
        surname = F.when(cyrillic if script == "cyrillic" else ~cyrillic, made).otherwise(surname)
    person = F.when(F.size(names) > 1, F.concat_ws(" ", given, surname)).otherwise(surname)
    tld = F.substring_index(canonical, ".", -1)
    body = F.substring(canonical, F.lit(1), F.length(canonical) - F.length(tld))
    # short local parts leave little choice: later attempts add letters
    longer = F.when(attempt > 3, F.substring(digest, F.lit(60), attempt)).otherwise("")
    # so do the letters and digits of a masked secret: later attempts replace its other characters, and the first one if there is nothing else
    wide = (attempt > 3) | ~canonical.rlike("[0-9\\p{L}]")
    card = _same_shape(canonical, digest, F.lit(1))
    card = F.substring(card, F.lit(1), F.length(card) - 1)
    account = F.concat(F.substring(canonical, 1, 2), F.lit("00"), F.substring(_same_shape(canonical, digest, F.lit(2)), F.lit(5), F.length(canonical)))
    whole = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(digest, 4 * i + 40, F.lit(4))), ":")
    address = F.array_join(F.transform(_chars(canonical), lambda c, i: F.when(c == ":", c).otherwise(F.substring(digest, i + 1, F.lit(1)))), "")
    # no free value of this format was found: a word that says what was here
    word = F.concat(F.lit("["), kind, F.lit("-"), F.substring(digest, 1, 24), F.lit("]"))
    return (
        F.when(attempt >= LAST, word)
        .when(kind == "email", F.concat(longer, _same_shape(body, digest, F.lit(0)), tld))
        .when(kind == "ip", F.concat_ws(".", octet(0), octet(1), octet(2), octet(3)))
        .when(kind == "phone", F.concat(F.substring_index(canonical, ":", 1), F.lit(":"), _same_shape(number, digest, F.substring_index(canonical, ":", 1).cast("int"))))
        .when(kind == "ipv6", F.when(attempt > 5, whole).otherwise(address))
        .when(kind == "card", F.concat(card, F.pmod(10 - _luhn(F.concat(card, F.lit("0"))), F.lit(10)).cast("string")))
        .when(kind == "iban", F.concat(F.substring(account, 1, 2), F.lpad((98 - _mod97(account)).cast("string"), 2, "0"), F.substring(account, F.lit(5), F.length(account))))
        .when(kind == "person", F.concat(F.substring_index(canonical, ":", 1), F.lit(":"), person))
        .when((kind == "secret") & canonical.rlike("^[0-9a-f]{32,64}$"), hexadecimal)
        .otherwise(_same_shape(canonical, digest, F.lit(0), wide & (kind == "secret")))
    )


def _written(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate as this mention writes its entity: its case, its grouping, its form of address."""
    number = F.substring_index(surrogate, ":", -1)
    digits = F.length(F.regexp_replace(entity, "[^0-9]", ""))
    number = F.when((kind == "phone") & surrogate.startswith("0:") & (digits == 11), F.concat(F.lit("1"), number)).otherwise(number)

    def digit(c: Column, i: Column) -> Column:
        n = F.length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substring(number, n, F.lit(1))).otherwise(c)

    def grouped(c: Column, i: Column) -> Column:
        n = F.length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), " ", ""))
        return F.when(c == " ", c).otherwise(F.substring(surrogate, n, F.lit(1)))

    title = F.regexp_extract(entity, f"^({_TITLE}\\.? )", 1)
    name = F.substring(entity, F.length(title) + 1, F.length(entity))
    # a mention by surname alone gets the surname alone
    named = F.when(name.rlike(" "), number).otherwise(F.substring_index(number, " ", -1))
    named = F.when((F.upper(name) == name) & name.rlike("\\p{L}{2}"), F.upper(named)).otherwise(named)
    upper = (F.upper(entity) == entity) & (F.lower(entity) != entity)
    chars = F.split(entity, "")
    return (
        F.when(surrogate.startswith("["), surrogate)
        .when(kind.isin("phone", "card", "ssn"), F.array_join(F.transform(chars, digit), ""))
        .when(kind == "iban", F.array_join(F.transform(chars, grouped), ""))
        .when(kind == "person", F.concat(title, named))
        .when(kind.isin("email", "ipv6", "secret") & upper & entity.rlike("^[0-9a-fA-F]{32,64}$|[@:]"), F.upper(surrogate))
        .otherwise(surrogate)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """One row per distinct (kind, canonical) with a surrogate that no other entity has and that is none itself.

    After ``LAST`` attempts surrogates are words that can't be entities and differ as their digests do.
    """
    real = stored(entities.select("kind", "canonical").distinct(), "entities")
    todo = real.withColumn("attempt", F.lit(0))
    done = None
    while True:
        tried = todo.withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("canonical"), F.col("attempt")))
        taken = tried.select("kind", "surrogate").join(real.select("kind", F.col("canonical").alias("surrogate")), ["kind", "surrogate"], "left_semi")
        if done is not None:
            taken = taken.union(tried.select("kind", "surrogate").join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_semi"))
        first = tried.groupBy("kind", "surrogate").agg(F.min("canonical").alias("winner"))
        first = first.join(taken.distinct(), ["kind", "surrogate"], "left_anti")
        tried = stored(tried.join(first, ["kind", "surrogate"], "left"), "tried")
        won = tried.filter(F.col("winner").eqNullSafe(F.col("canonical"))).select("kind", "canonical", "surrogate")
        done = won if done is None else done.union(won)
        todo = tried.filter(~F.col("winner").eqNullSafe(F.col("canonical"))).select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        if todo.isEmpty():
            return done


def _linked_surnames(mentions: DataFrame, keys: list[str]) -> DataFrame:
    """``mentions`` in which a surname alone has the canonical form of the one full name with it in the same text."""
    name = F.substring_index("canonical", ":", -1)
    person = F.when(F.col("kind") == "person", F.substring_index(name, " ", -1))
    named = mentions.withColumns({"surname": person, "full": name.contains(" ")})
    full = named.filter("surname is not null and full").groupBy(*keys, "surname").agg(F.min("canonical").alias("one"), F.max("canonical").alias("other"))
    full = full.filter("one = other").drop("other")
    out = named.join(full, [*keys, "surname"], "left")
    linked = F.when(F.col("surname").isNotNull() & ~F.col("full") & F.col("one").isNotNull(), F.col("one")).otherwise(F.col("canonical"))
    return stored(out.withColumn("canonical", linked).select(*mentions.columns), "mentions")


def surrogate_key(spark: SparkSession) -> str:
    """The secret key, from spark.screenloom.surrogateKey. Without it a known one is used: fit for tests only."""
    return spark.conf.get("spark.screenloom.surrogateKey", "no secret")


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities in ``text_col`` replaced, and n_entities (long).

    Texts without entities stay as they are; null stays null, with 0 entities. Equal texts give
    equal results, whatever their ids; ids may be null or repeat. Very long texts are searched
    whole. A column named n_entities is replaced, others pass through. An empty table gives no rows.
    """
    text = F.col(text_col)
    mark = unused_prefix(docs)
    keys, new = [f"{mark}k{i}" for i in range(3)], f"{mark}new"
    keyed = without(docs, ["n_entities"]).withColumns(dict(zip(keys, (F.xxhash64(text), F.hash(text), F.length(text)), strict=True)))
    # a text is looked at once, however many copies it has
    found = keyed.select(*keys, _matches(text).alias("found")).filter(F.size("found") > 0)
    found = found.groupBy(*keys).agg(F.first("found").alias("found"))
    mentions = found.select(*keys, F.posexplode("found").alias("place", "entity")).withColumn("kind", _kind(F.col("entity")))
    mentions = mentions.withColumn("kind", F.when(_holds(F.col("kind"), F.col("entity")), F.col("kind")))
    mentions = mentions.withColumn("canonical", F.when(F.col("kind").isNotNull(), _canonical(F.col("kind"), F.col("entity"))))
    mentions = _linked_surnames(stored(mentions, "found"), keys)
    chosen = surrogates(mentions.filter("kind is not null"), key)
    written = salted_join(mentions, chosen, ["kind", "canonical"], F.col(keys[0]))
    # what only looks like an entity is put back as it is
    again = F.coalesce(_written(F.col("kind"), F.col("entity"), F.col("surrogate")), F.col("entity"))
    written = written.select(*keys, F.struct("place", again.alias("new"), F.col("kind").isNotNull().cast("long").alias("is_entity")).alias("mention"))
    written = written.groupBy(*keys).agg(F.sort_array(F.collect_list("mention")).alias(new))
    out = salted_join(keyed, written, keys, F.col(id_col))
    between = F.split(text, ENTITY, -1)
    news = F.concat(F.transform(new, lambda x: x["new"]), F.array(F.lit("")))
    replaced = F.array_join(F.zip_with(between, news, lambda a, b: F.concat(a, b)), "")
    number = F.aggregate(new, F.lit(0).cast("long"), lambda n, x: n + x["is_entity"])
    return out.withColumns({text_col: F.when(F.col(new).isNull(), text).otherwise(replaced), "n_entities": F.coalesce(number, F.lit(0).cast("long"))}).select(
        *without(docs, ["n_entities"]).columns, "n_entities"
    )
