"""Operator 3: personal data replaced by keyed surrogates, DataFrame functions only.

Entities are found by one pattern. Each distinct entity, by type and canonical
form, gets a surrogate from a keyed hash that keeps its type and format: digits
stay digits, letters stay letters of the same case and script, separators stay,
a card number keeps its check sum, an address its private range, a person the
gender of the titles. The same entity has the same surrogate everywhere
(coreference). Surrogates that meet another one or an entity of the texts are
drawn again until all are distinct.

A person is a given name and a surname. Surnames are settled first, so a mention
by surname alone agrees with the full name; then whole names are, so no two people
of one surname become one. Hyphens, apostrophes and particles of a surname stay
where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, running, stored

#: Titles by gender, given names by gender and script, syllables of surnames.
MALE_TITLES = "Mr|Mister|Sir|Herr|Señor|Sr|Monsieur|Signor|Господин"
FEMALE_TITLES = "Mrs|Ms|Miss|Madam|Frau|Señora|Sra|Señorita|Madame|Mme|Signora|Госпожа"
OPEN_TITLES = "Dr|Prof"
PARTICLES = "de|del|della|den|der|di|dos|du|da|la|le|van|von|vom|zu|zum|zur|ter|ten|bin|al"
GIVEN = {
    "m": "Alan Bruno Carl Dirk Emil Felix Georg Hugo Ivan Jonas Kurt Leon Marc Nils Otto Paul".split(),
    "f": "Alma Berta Clara Dora Emma Freya Greta Helga Irene Julia Karin Lena Maria Nora Olga Paula".split(),
    "u": "Alex Bent Chris Dani Eli Fynn Gale Hollis Indy Jona Kim Lou Maxi Nico Onyx Pat".split(),
    "cm": "Антон Борис Виктор Глеб Денис Егор Захар Игорь".split(),
    "cf": "Анна Вера Галина Дарья Елена Зоя Ирина Клара".split(),
}
SYLLABLES = {"latin": "bar den fol gar hun jor kel lam mor nev pel ras sol tam vin wes".split(), "cyrillic": "бар вен гор дал кел лам мор нев пел рас сол тим ран вес зин лор".split()}
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: The lengths are those that mail allows; they also bound the search in long runs.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9.-]{0,250}[A-Za-z0-9])?\.[A-Za-z]{2,24}"
IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})[ .-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])"
NAME = r"\p{Lu}(?:\p{L}+|['’]\p{L}+)(?:['’-]\p{L}+)*"
INITIALS = r"(?:\p{Lu}\.)+"
PERSON = rf"(?<!\p{{L}})(?:{MALE_TITLES}|{FEMALE_TITLES}|{OPEN_TITLES})\.?[ ](?:(?:{NAME}|{INITIALS})[ ])?(?:(?:{PARTICLES})[ ]){{0,3}}{NAME}(?!\p{{L}})"
PATTERN = "|".join((EMAIL, IPV4, SOCIAL, PHONE, CARD, PERSON))
#: Every alternative of PATTERN holds one of these.
_MAYBE = rf"@|\+[0-9]|[0-9]{{3}}|[0-9]\.[0-9]|(?:{MALE_TITLES}|{FEMALE_TITLES}|{OPEN_TITLES})\.?[ ](?:\p{{Lu}}|(?:{PARTICLES})[ ])"
#: Draws of one entity before it counts as impossible to keep all apart.
MOST_ATTEMPTS = 64


def entity_kind(raw: Column) -> Column:
    return (
        F.when(raw.rlike(f"^{EMAIL}$"), "email").when(raw.rlike(f"^{IPV4}$"), "ip").when(raw.rlike(f"^{SOCIAL}$"), "social")
        .when(raw.rlike(f"^(?:{PHONE})$"), "phone").when(raw.rlike(f"^{CARD}$"), "card").otherwise("person")
    )


def _name_parts(raw: Column) -> Column:
    """Struct of title, given name (or empty) and surname of a person's mention."""
    words = F.split(raw, " ")
    full = (F.size(words) > 2) & ~words[1].rlike(f"^(?:{PARTICLES})$")
    given = F.when(full, words[1]).otherwise("")
    surname = F.array_join(F.slice(words, F.when(full, 3).otherwise(2), F.size(words)), " ")
    return F.struct(words[0].alias("title"), given.alias("given"), surname.alias("surname"))


def _gender(title: Column) -> Column:
    """f or m, null for an open title."""
    plain = F.regexp_replace(title, r"\.$", "")
    return F.when(plain.rlike(f"^(?:{MALE_TITLES})$"), "m").when(plain.rlike(f"^(?:{FEMALE_TITLES})$"), "f")


def canonical(kind: Column, raw: Column) -> Column:
    """What makes two mentions the same entity; of a person the surname."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    return F.when(kind == "email", F.lower(raw)).when(kind == "person", F.lower(_name_parts(raw)["surname"])).when(kind == "ip", raw).otherwise(digits)


def _number(hexes: Column, k: Column | int, modulo: Column | int) -> Column:
    """The k-th draw below ``modulo`` from a hexadecimal digest of 64 digits."""
    k = F.lit(k) if isinstance(k, int) else k
    at = (k * 3 % 57 + 1).cast("int")
    return (F.conv(F.substring(hexes, at, F.lit(7)), 16, 10).cast("long") + k) % modulo


def _draw(hexes: Column, alphabet: str, k: Column) -> Column:
    return F.substring(F.lit(alphabet), (_number(hexes, k, len(alphabet)) + 1).cast("int"), F.lit(1))


def _letters(shape: Column, hexes: Column) -> Column:
    """Redraw letters and digits of a lower-case text, keep everything else."""
    chars = F.split(shape, "")
    return F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("^[a-z]$"), _draw(hexes, LOWER, i)).when(c.rlike("^[0-9]$"), _draw(hexes, "0123456789", i)).otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    """Check sum modulo 10 of a number, doubling every second digit from the right."""
    numbers = F.transform(F.reverse(F.split(digits, "")), lambda c, i: (c.cast("int") * (1 + i % 2)))
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10


def surrogate(kind: Column, entity: Column, key: str, attempt: Column) -> Column:
    """Replacement of a canonical entity. Later attempts draw anew: from the fourth
    on mail addresses and names are longer, from the ninth on addresses of small
    private ranges come from the largest one."""
    hexes = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string")), 256)
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    domain_hexes = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), domain), 256)
    longer = F.when(attempt >= 3, F.concat(F.lit("."), attempt.cast("string"), F.substring(hexes, 60, 5))).otherwise("")
    email = F.concat(_letters(local, hexes), longer, F.lit("@"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: _draw(domain_hexes, LOWER, i)), ""), F.lit(".example"))
    octets = F.split(entity, r"\.")
    private = F.when(entity.rlike(r"^10\.") | ((attempt >= 8) & entity.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|127\.0)\.")), F.array(F.lit("10"))).when(entity.rlike(r"^10\."), F.array(octets[0])).when(entity.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|127\.0)\."), F.slice(octets, 1, 2)).otherwise(F.array((11 + _number(hexes, 0, 100)).cast("string")))
    more = F.transform(F.sequence(F.size(private), F.lit(3)), lambda i: (_number(hexes, i, 254) + 1).cast("string"))
    address = F.array_join(F.concat(private, more), ".")
    chars = F.split(entity, "")
    plain = F.array_join(F.transform(chars, lambda c, i: _draw(hexes, "0123456789", i)), "")
    leading = F.concat((_number(hexes, 1, 8) + 2).cast("string"), F.substring(plain, 2, 64))
    # the country code stays; all but it is drawn
    country = F.when(F.length(entity) > 10, F.substring(entity, F.lit(1), F.length(entity) - 10)).otherwise("")
    phone = F.concat(country, F.substring(leading, F.lit(1), F.least(F.length(entity), F.lit(10))))
    body = F.concat(F.substring(leading, F.lit(1), F.length(entity) - 2), F.lit("0"))
    tail = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: _luhn(F.concat(body, d.cast("string"))) == _luhn(entity))
    card = F.concat(body, tail[0].cast("string"))
    person = _surname(entity, hexes, attempt)
    return F.when(kind == "email", email).when(kind == "ip", address).when(kind == "phone", phone).when(kind == "card", card).when(kind == "social", leading).otherwise(person)


def _surname(entity: Column, hexes: Column, attempt: Column) -> Column:
    """Syllables for each part of a surname; particles, hyphens and what stands
    before an apostrophe stay."""
    parts = F.split(entity, r"(?<=[ '’-])|(?=[ '’-])")
    count = F.when(attempt >= 3, 5).otherwise(3)

    def drawn(k: Column, script: str) -> Column:
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        each = F.transform(F.sequence(F.lit(1), count), lambda j: F.element_at(syllables, (_number(hexes, k * 5 + j, len(SYLLABLES[script])) + 1).cast("int")))
        return F.array_join(each, "")

    def part(p: Column, k: Column) -> Column:
        last = k == F.size(parts) - 1
        stays = p.rlike("^[ '’-]$") | (~last & (p.rlike(f"^(?:{PARTICLES})$") | (F.length(p) == 1)))
        return F.when(stays, p).when(p.rlike(r"\p{IsCyrillic}"), drawn(k, "cyrillic")).otherwise(drawn(k, "latin"))

    return F.array_join(F.transform(parts, part), "")


def _given(group: Column, hexes: Column, attempt: Column) -> Column:
    """A given name of the group; later a double one, and then one made up in part,
    so that no surname has more people than names."""

    def pick(k: int) -> Column:
        out = F.lit(None).cast("string")
        for name, names in GIVEN.items():
            out = F.when(group == name, F.element_at(F.array(*[F.lit(n.lower()) for n in names]), (_number(hexes, k, len(names)) + 1).cast("int"))).otherwise(out)
        return out

    made = F.when(group.isin("cm", "cf"), _surname(F.lit("имя"), hexes, F.lit(0))).otherwise(_surname(F.lit("name"), hexes, F.lit(0)))
    return F.when(attempt < 4, pick(0)).when(attempt < 12, F.concat_ws("-", pick(0), pick(1))).otherwise(F.concat_ws("-", pick(0), made))


def _capital(name: Column) -> Column:
    """Parts of a name with a capital, particles without."""
    parts = F.split(name, r"(?<=[ '’-])|(?=[ '’-])")
    return F.array_join(F.transform(parts, lambda p, k: F.when(p.rlike(f"^(?:{PARTICLES})$") & (k < F.size(parts) - 1), p).otherwise(F.initcap(p))), "")


def _rendered(kind: Column, raw: Column, new: Column, given: Column) -> Column:
    """The surrogate in the format of one mention; ``given`` is that of a person."""
    chars = F.split(raw, "")
    digits = lambda i: F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), "[^0-9]", ""))
    spaced = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("^[0-9]$"), F.substring(new, digits(i), F.lit(1))).otherwise(c)), "")
    email = F.when(raw == F.upper(raw), F.upper(new)).otherwise(new)
    parts = _name_parts(raw)
    upper = lambda old, name: F.when(old == F.upper(old), F.upper(name)).otherwise(_capital(name))
    first = F.when(parts["given"].rlike(f"^{INITIALS}$"), F.concat(F.upper(F.substring(given, 1, 1)), F.lit("."))).otherwise(upper(parts["given"], given))
    person = F.concat_ws(" ", parts["title"], F.when(parts["given"] != "", first), upper(parts["surname"], new))
    return F.when(kind == "email", email).when(kind == "person", person).when(kind == "ip", new).otherwise(spaced)


def surrogate_table(entities: DataFrame, key: str, draw=None) -> DataFrame:
    """Rows (kind, entity, surrogate), distinct within a kind, from distinct
    (kind, entity).

    A surrogate is settled if no other row drew it and it is no entity itself;
    of several rows that drew it the first in a keyed order keeps it. The rest
    draw again against all that is settled. ``draw`` makes a surrogate for an
    attempt from the columns of ``entities``. More entities than a format has
    surrogates are an error.
    """
    if draw is None:
        draw = lambda attempt: surrogate(F.col("kind"), F.col("entity"), key, attempt)
    settled, open_, attempt = None, entities, 0
    names = entities.select("kind", F.col("entity").alias("surrogate"))
    while True:
        drawn = stored(open_.select("kind", "entity", draw(F.lit(attempt)).alias("surrogate")), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct(F.sha2(F.concat(F.lit(key), F.col("entity")), 256), "entity")).alias("best"))
        taken = names if settled is None else names.unionByName(settled.select("kind", "surrogate"))
        won = first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", F.col("best.entity").alias("entity"), "surrogate")
        won = stored(won if settled is None else won.unionByName(settled), "settled")
        left = stored(entities.join(won, ["kind", "entity"], "left_anti"), "open")
        settled, attempt = won, attempt + 1
        if left.isEmpty():
            return settled
        if attempt >= MOST_ATTEMPTS:
            raise ValueError(f"{left.count()} entities, of kind {left.first().kind} among others, have no distinct surrogate")
        open_ = left


def _people(each: DataFrame, surnames: DataFrame, key: str) -> DataFrame:
    """Rows (surname, given, new_given) of all people named in full."""
    known = each.where("kind = 'person' AND given <> ''").groupBy(F.col("entity").alias("surname"), "given").agg(F.max("gender").alias("gender"))
    known = known.join(surnames.where("kind = 'person'").select(F.col("entity").alias("surname"), F.col("surrogate").alias("new")), "surname")
    gender = F.coalesce("gender", F.lit("u"))
    group = F.when(F.concat("given", "surname").rlike(r"\p{IsCyrillic}"), F.when(gender == "f", "cf").otherwise("cm")).otherwise(gender)
    known = stored(known.select(F.lit("full").alias("kind"), F.concat_ws(" ", "given", "surname").alias("entity"), "surname", "given", "new", group.alias("group")), "people")

    def draw(attempt: Column) -> Column:
        hexes = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("given"), F.col("given"), F.when(attempt > 0, F.concat(F.col("entity"), attempt.cast("string")))), 256)
        return F.concat_ws(" ", _given(F.col("group"), hexes, attempt), "new")

    found = surrogate_table(known, key, draw)
    return known.join(found, ["kind", "entity"]).select("surname", "given", F.substring_index("surrogate", " ", 1).alias("new_given"))


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """Rows (doc_id, text, n_entities), one per row of ``docs``, entities replaced.

    ``docs`` needs doc_id and text. A null text stays null; texts without
    entities stay as they are; repeated rows get the same text. ``key`` makes
    surrogates differ between runs with different keys, and agree otherwise.
    """
    docs = columns(docs, "doc_id", "text").withColumn("found", F.when(F.col("text").rlike(_MAYBE), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))))
    some = F.coalesce(F.size("found"), F.lit(-1)) > 0
    with running(docs.sparkSession):
        marked = docs.where(some).withColumn("row", F.xxhash64("doc_id", "text"))
        each = marked.select("row", F.posexplode("found").alias("place", "raw")).distinct()
        kind, parts = entity_kind(F.col("raw")), _name_parts(F.col("raw"))
        each = each.withColumn("kind", kind).withColumn("entity", canonical(F.col("kind"), F.col("raw")))
        given, gender = F.when(F.col("kind") == "person", F.lower(parts["given"])), F.when(F.col("kind") == "person", _gender(parts["title"]))
        each = stored(each.withColumn("given", F.coalesce(given, F.lit(""))).withColumn("gender", gender), "entities")
        known = surrogate_table(each.groupBy("kind", "entity").agg(F.count("*").alias("_")).drop("_"), key)
        people = _people(each, known, key)
        named = each.join(known, ["kind", "entity"]).join(people.withColumn("kind", F.lit("person")).withColumnRenamed("surname", "entity"), ["kind", "entity", "given"], "left")
        new = _rendered(F.col("kind"), F.col("raw"), F.col("surrogate"), F.col("new_given"))
        swapped = named.select("row", F.struct("place", new.alias("new")).alias("s"))
        swapped = stored(swapped.groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("s")), "replacements")
    pieces = F.split("text", PATTERN, -1)
    text = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.when(i < F.size("s"), F.get(F.col("s"), i)["new"]).otherwise(""))), "")
    changed = marked.join(swapped, "row").select("doc_id", text.alias("text"), F.size("s").alias("n_entities"))
    return docs.where(~some).select("doc_id", "text", F.lit(0).alias("n_entities")).unionByName(changed)
