"""Replace personal data by keyed surrogates, with DataFrame functions only.

Every entity becomes another one of its kind and format: digits stay digits,
letters keep their case, separators stay where they are, cards keep network
and check digit, names keep title, gender and script. The replacement is a
function of a secret key, the kind and the canonical entity, so all mentions
of one entity, however formatted, get one replacement in the whole corpus
without a join. Collisions are checked over the distinct entities of the
corpus: of two entities with one replacement, and of an entity whose
replacement is itself an entity of the corpus, one is given another attempt.
The few entities with such attempts are joined to the texts that hold them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import plain_names, stored

# Titles that tell a gender, and given names by gender and script.
MALE_TITLES = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Г-н"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Г-жа"]
GIVEN = {
    ("m", "latin"): "Adam Alan Bruno Carl David Eric Felix Hugo Ivan Jonas Karl Leon Marco Noah Oscar Paul",
    ("f", "latin"): "Ada Alice Bella Clara Diana Emma Flora Helen Irene Julia Karin Laura Maria Nora Olga Paula",
    ("m", "greek"): "Άγγελος Αλέξης Γιώργος Δημήτρης Ηλίας Θάνος Κώστας Λεωνίδας Μάνος Νίκος Παύλος Πέτρος Σπύρος Στέλιος Τάσος Φώτης",
    ("f", "greek"): "Αγγελική Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Όλγα Ράνια Σοφία Φωτεινή Χαρά",
    ("m", "cyrillic"): "Алексей Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Юрий",
    ("f", "cyrillic"): "Алиса Анна Вера Галина Дарья Ева Жанна Инна Кира Лидия Мария Нина Ольга Полина Рита Юлия",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mi mo na ne no pa ra re ro sa se ta to",
    "greek": "βα βε βο δα δε δο ζα ζε θα θε κα κε κο λα λε λο μα με μι μο να νε νο πα ρα ρε ρο σα σε τα τε το",
    "cyrillic": "ба бе бо да де до фа фе га го ха ка ке ко ла ле ло ма ме ми мо на не но па ра ре ро са се та то",
}

KINDS = "private_kinds"
_TITLE = "|".join(MALE_TITLES + FEMALE_TITLES)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_ASSIGNED = r"\b(?i:password|passwd|pwd|secret|token|api_key|apikey)\s?[=:]\s?"
_HEX = "[0-9A-Fa-f]{1,4}"
_IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_IPV6 = rf"(?<![0-9A-Za-z:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![0-9A-Za-z:])"
# Without upper lengths; possessive, and bound to the beginning of a run, so that long texts take linear time.
PATTERN = "|".join([
    _ASSIGNED + r"[^\s\"',;]{6,}+",
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"\bAKIA[A-Z0-9]{16}\b",
    r"(?<=[\"'])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?=[\"'])",
    rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    _IPV6,
    _IBAN,
    r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    r"(?<![\d+-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?!\d)",
    r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    r"(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?!\d)",
    rf"\b(?:{_TITLE})\.? \p{{Lu}}[\p{{Ll}}'-]++(?: \p{{Lu}}[\p{{Ll}}'-]++)?",
])
# Texts without any of these hold no entity; the pattern above is costly. Every branch needs one of them.
_MAYBE = rf"[0-9@]|AKIA|[0-9A-Fa-f]:|[\"'][a-fA-F]{{32}}|(?i:password|passwd|pwd|secret|token|api_?key)|\b(?:{_TITLE})\b"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(entity: Column) -> Column:
    return (
        F.when(entity.rlike("^" + _ASSIGNED), "secret")
        .when(entity.contains("@"), "email")
        .when(entity.rlike("^AKIA[A-Z0-9]{16}$"), "access_key")
        .when(entity.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"), "secret")
        .when(entity.rlike("^[0-9A-Fa-f]*:[0-9A-Fa-f:]+$"), "ipv6")
        .when(entity.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$"), "iban")
        .when(entity.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ipv4")
        .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "national_id")
        .when(entity.rlike(r"^\d{4}[ -]?\d{4}[ -]?\d{4}"), "card")
        .when(entity.rlike(r"^[+(0-9]"), "phone")
        .otherwise("name")
    )


def _name_words(entity: Column) -> Column:
    return F.split(F.regexp_replace(entity, rf"^(?:{_TITLE})\.? ", ""), " ")


_FEMALE_FORM = "(ов|ев|ин|ын)а$"


def _gender(entity: Column) -> Column:
    return F.when(entity.rlike(rf"^(?:{'|'.join(MALE_TITLES)})\b\.? "), "m").otherwise("f")


def parts_of(entity: Column) -> Column:
    """What of an entity is replaced, in canonical form: a name has a part for each word."""
    kind = kind_of(entity)
    canonical = (
        F.when(kind == "email", F.lower(entity))
        .when(kind == "secret", F.regexp_replace(entity, "^" + _ASSIGNED, ""))
        .when(kind == "phone", F.when(F.length(_digits(entity)) > 10, F.substring(_digits(entity), -10, 10)).otherwise(
            _digits(entity)))
        .when(kind.isin("card", "national_id"), _digits(entity))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .when(kind == "ipv6", F.lower(entity))
        .otherwise(entity)
    )
    words = _name_words(entity)
    # Male and female forms of a Cyrillic surname are one surname.
    own = F.regexp_replace(F.lower(F.element_at(words, -1)), _FEMALE_FORM, "$1")
    last = F.struct(F.lit("surname").alias("kind"), own.alias("canonical"))
    first = F.struct(F.concat(F.lit("given_"), _gender(entity)).alias("kind"), F.lower(words[0]).alias("canonical"))
    named = F.when(F.size(words) > 1, F.array(first, last)).otherwise(F.array(last))
    return F.when(kind == "name", named).otherwise(
        F.array(F.struct(kind.alias("kind"), canonical.alias("canonical"))))


# --- replacements -----------------------------------------------------------

def _hash(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canonical, attempt.cast("string")), 512)


def _number(digest: Column, place, width: int = 2) -> Column:
    """A number from ``width`` hex digits of the digest; places beyond its end begin again."""
    at = F.pmod(F.lit(place) * width, F.lit(128 - 128 % width)) + 1
    return F.conv(F.substr(digest, at.cast("int"), F.lit(width)), 16, 10).cast("bigint")


def _letter(alphabet: str, number: Column) -> Column:
    return F.substr(F.lit(alphabet), (F.pmod(number, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))


def _reshaped(text: Column, digest: Column, hexadecimal: Column | None = None) -> Column:
    """``text`` with other characters of the same class; hexadecimal texts stay hexadecimal."""

    def change(c: Column, i: Column) -> Column:
        number = _number(digest, i)  # places beyond the digest's end repeat it
        changed = (F.when(c.rlike("[0-9]"), _letter("0123456789", number))
                   .when(c.rlike("[a-z]"), _letter("abcdefghijklmnopqrstuvwxyz", number))
                   .when(c.rlike("[A-Z]"), _letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", number)).otherwise(c))
        if hexadecimal is None:
            return changed
        return F.when(hexadecimal, _letter("0123456789abcdef", number)).otherwise(changed)

    return F.array_join(F.transform(F.split(text, ""), change), "")


def _checked(body: Column) -> Column:
    """``body`` (digits) with the Luhn check digit behind it."""

    def weigh(c: Column, i: Column) -> Column:
        n = c.cast("int")
        twice = F.when(n > 4, n * 2 - 9).otherwise(n * 2)
        return F.when(F.pmod(F.length(body) - i, F.lit(2)) == 1, twice).otherwise(n)

    total = F.aggregate(F.transform(F.split(body, ""), weigh), F.lit(0), lambda a, b: a + b)
    return F.concat(body, F.pmod(-total, F.lit(10)).cast("string"))


def _with_check_digits(country: Column, bban: Column) -> Column:
    """An IBAN whose check digits fit: letters count 10 to 35, and the whole leaves one when divided by 97."""

    def weigh(rest: Column, c: Column) -> Column:
        letter = F.instr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c)
        return F.when(letter > 0, (rest * 100 + letter + 9) % 97).otherwise(
            (rest * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97)

    rest = F.aggregate(F.split(F.concat(bban, country, F.lit("00")), ""), F.lit(0), weigh)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), bban)


def _word(digest: Column, script: str, first: int, count: int) -> Column:
    syllables = F.array(*map(F.lit, SYLLABLES[script].split()))
    return F.initcap(F.concat(*[
        F.element_at(syllables, (F.pmod(_number(digest, first + i, 4), F.lit(32)) + 1).cast("int"))
        for i in range(count)]))


def _given(digest: Column, gender: str, attempt: Column) -> Column:
    def pick(script: str, place: int) -> Column:
        names = F.array(*map(F.lit, GIVEN[gender, script].split()))
        return F.element_at(names, (F.pmod(_number(digest, place), F.lit(16)) + 1).cast("int"))

    def name(script: str) -> Column:
        # A further attempt needs room: a double name, then one with a middle part.
        return (F.when(attempt == 0, pick(script, 0)).when(attempt < 8, F.concat_ws("-", pick(script, 0), pick(script, 1)))
                .otherwise(F.concat_ws("-", pick(script, 0), _word(digest, script, 4, 4))))

    return name


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def replacement(key: str, part: Column, attempt: Column) -> Column:
    """The canonical surrogate of a part."""
    kind, canonical = part["kind"], part["canonical"]
    return _let(_hash(key, kind, canonical, attempt), lambda digest: _replaced(key, kind, canonical, attempt, digest))


def _surname(canonical: Column, digest: Column) -> Column:
    word = {script: _word(digest, script, 10, 4) for script in SYLLABLES}
    return (F.when(canonical.rlike(r"\p{IsCyrillic}"), F.concat(word["cyrillic"], F.lit("ов")))
            .when(canonical.rlike(r"\p{IsGreek}"), word["greek"]).otherwise(word["latin"]))


def _replaced(key: str, kind: Column, canonical: Column, attempt: Column, digest: Column) -> Column:
    shaped = _reshaped(canonical, digest)
    octets = F.concat_ws(".", (F.pmod(_number(digest, 0, 4), F.lit(223)) + 1).cast("string"),
                         *[F.pmod(_number(digest, i), F.lit(256)).cast("string") for i in (4, 5, 6)])
    # Addresses of one domain stay together: it has a replacement of its own.
    domain_digest = _hash(key, F.lit("domain"), F.substring_index(canonical, "@", -1), F.lit(0))
    domain = F.concat(*[_letter("abcdefghijklmnopqrstuvwxyz", _number(domain_digest, 50 + i)) for i in range(10)])
    local = _reshaped(F.substring_index(canonical, "@", 1), digest)
    card = _checked(F.concat(F.substring(canonical, 1, 1), F.substr(shaped, F.lit(2), F.length(canonical) - 2)))
    cyrillic, greek = canonical.rlike(r"\p{IsCyrillic}"), canonical.rlike(r"\p{IsGreek}")
    bban = F.substr(shaped, F.lit(5), F.length(canonical))
    hexadecimal = F.transform(F.split(canonical, ""), lambda c, i: F.when(
        c.rlike("[0-9a-f]"), _letter("123456789abcdef", _number(digest, i))).otherwise(c))
    given_m, given_f = _given(digest, "m", attempt), _given(digest, "f", attempt)
    return (
        F.when(kind == "email", F.concat(local, F.lit("@"), domain, F.lit(".example.com")))
        .when(kind == "ipv4", octets)
        .when(kind == "card", card)
        .when(kind == "secret", _reshaped(canonical, digest, canonical.rlike("^[0-9a-f]+$")))
        .when(kind == "access_key", F.concat(F.lit("AKIA"), F.substring(shaped, 5, 16)))
        .when(kind == "ipv6", F.array_join(hexadecimal, ""))
        .when(kind == "iban", _let(bban, lambda own: _with_check_digits(F.substring(canonical, 1, 2), own)))
        .when(kind == "surname", _surname(canonical, digest))
        .when(kind == "given_m", F.when(cyrillic, given_m("cyrillic")).when(greek, given_m("greek")).otherwise(
            given_m("latin")))
        .when(kind == "given_f", F.when(cyrillic, given_f("cyrillic")).when(greek, given_f("greek")).otherwise(
            given_f("latin")))
        .otherwise(shaped)
    )


def _laid_out(entity: Column, digits: Column) -> Column:
    """``digits`` in the places of the entity's digits, from the right; further digits stay."""

    def place(c: Column, i: Column) -> Column:
        behind = F.length(_digits(F.substr(entity, (i + 2).cast("int"))))
        return F.when(c.rlike("[0-9]") & (behind < F.length(digits)),
                      F.substr(digits, (F.length(digits) - behind).cast("int"), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(entity, ""), place), "")


def surrogate(key: str, entity: Column, attempt_of) -> Column:
    """The text that stands for ``entity``; ``attempt_of(part)`` gives the attempt of a part."""
    new = F.transform(parts_of(entity), lambda part: replacement(key, part, attempt_of(part)))
    return _let(F.struct(entity.alias("e"), kind_of(entity).alias("kind"), new.alias("new")),
                lambda made: _written(made["e"], made["kind"], made["new"]))


def _written(entity: Column, kind: Column, new: Column) -> Column:
    title = F.regexp_extract(entity, rf"^(?:{_TITLE})\.? ", 0)
    female = F.when(entity.rlike(_FEMALE_FORM), "а").otherwise("")
    return (
        F.when(kind == "name", F.concat(title, F.array_join(new, " "), female))
        .when(kind.isin("phone", "card", "national_id"), _laid_out(entity, new[0]))
        .when(kind == "iban", _spaced(entity, new[0]))
        .when(kind == "secret", F.concat(F.regexp_extract(entity, "^" + _ASSIGNED, 0), new[0]))
        .otherwise(new[0])
    )


def _spaced(entity: Column, letters: Column) -> Column:
    """``letters`` with spaces where ``entity`` has them."""

    def place(c: Column, i: Column) -> Column:
        before = F.length(F.replace(F.substr(entity, F.lit(1), i.cast("int")), F.lit(" "), F.lit("")))
        return F.when(c == " ", c).otherwise(F.substr(letters, before + 1, F.lit(1)))

    return F.array_join(F.transform(F.split(entity, ""), place), "")


def bare_surnames(found: Column) -> Column:
    """The surnames of the names in ``found``, each once, longest first: later mentions may lack the title."""
    last = F.transform(F.filter(found, lambda e: kind_of(e) == "name"), lambda e: F.element_at(_name_words(e), -1))
    return F.reverse(F.array_sort(F.array_distinct(last)))


def _without_surnames(key: str, gap: Column, names: Column, attempt_of) -> Column:
    """``gap`` with every bare mention of ``names`` replaced like the mention with a title."""

    def put(text: Column, name: Column) -> Column:
        own = F.struct(F.lit("surname").alias("kind"), F.regexp_replace(F.lower(name), _FEMALE_FORM, "$1").alias("canonical"))
        base = _let(own, lambda part: _let(_hash(key, part["kind"], part["canonical"], attempt_of(part)),
                                           lambda digest: _surname(part["canonical"], digest)))
        new = F.concat(base, F.when(name.rlike(_FEMALE_FORM), "а").otherwise(""))
        return F.regexp_replace(text, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), name, F.lit(r"(?![\p{L}\p{N}])")), new)

    return F.when(F.size(names) > 0, F.aggregate(names, gap, put)).otherwise(gap)


# --- corpus -----------------------------------------------------------------

def entities_in(text: Column) -> Column:
    """All entities of a text in order; null has none."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(_MAYBE), F.regexp_extract_all(text, F.lit(PATTERN), 0)).otherwise(none)


def further_attempts(docs: DataFrame, key: str) -> DataFrame:
    """kind, canonical, attempt of the parts whose first replacement is taken.

    A replacement is taken if another part of the kind has it and comes first,
    or if it is itself an entity of the corpus. Rounds go on until all parts
    of a kind have different replacements; each looks only at new attempts.
    """
    parts = docs.select(F.explode(entities_in(F.col("text"))).alias("e")).select(
        F.explode(parts_of(F.col("e"))).alias("part")).select("part.kind", "part.canonical").distinct()
    parts = stored(parts.withColumn("attempt", F.lit(0)), "private-parts")
    tried = parts.withColumn("new", replacement(key, F.struct("kind", "canonical"), F.col("attempt")))
    tried = stored(tried, "private-attempts")
    settled = None
    while True:
        # Of equal replacements, one that is settled comes first, then the smallest entity.
        rivals = tried.withColumn("order", F.lit(1))
        if settled is not None:
            rivals = rivals.unionByName(settled.withColumn("order", F.lit(0)))
        first = rivals.groupBy("kind", F.lower("new").alias("low")).agg(
            F.min(F.struct("order", "canonical")).alias("first"))
        real = parts.select("kind", F.lower("canonical").alias("low"), F.lit(True).alias("real"))
        judged = tried.withColumn("low", F.lower("new")).join(first, ["kind", "low"]).join(
            real.distinct(), ["kind", "low"], "left")
        fits = (F.col("first.order") == 1) & (F.col("first.canonical") == F.col("canonical")) & F.col("real").isNull()
        judged = stored(judged.select("kind", "canonical", "attempt", "new", fits.alias("fits")), "private-judged")
        fit = judged.where("fits").drop("fits")
        settled = fit if settled is None else settled.unionByName(fit)
        again = judged.where(~F.col("fits"))
        if again.isEmpty():
            return settled.where(F.col("attempt") > 0).select("kind", "canonical", "attempt")
        again = again.select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        tried = stored(again.withColumn("new", replacement(key, F.struct("kind", "canonical"), F.col("attempt"))),
                       "private-attempts")


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with replaced entities in ``text`` and their kinds in ``private_kinds``.

    A surname that a text has with a title is replaced without it too. Null
    stays null and a text without entities stays as it is. Repeated rows get the
    same text. Other columns are passed on, whatever their names, but for
    ``private_kinds``, which is an error; an empty table gives no rows.
    """
    rows, back, new = plain_names(docs)
    texts = docs.select("text")
    attempts = further_attempts(texts, key)
    text = F.col(new["text"])
    found, gaps = entities_in(text), F.split(text, PATTERN, -1)
    marked = rows.withColumn("found", found)
    if attempts.isEmpty():
        attempt_of = lambda part: F.lit(0)
    else:
        # Texts with such entities, by hash; equal hashes of different texts only lengthen a list.
        name = F.concat_ws(":", "kind", "canonical").alias("name")
        held = texts.select(F.xxhash64("text").alias("hash"), F.explode(entities_in(F.col("text"))).alias("e")).select(
            "hash", F.explode(parts_of(F.col("e"))).alias("part")).select("hash", "part.kind", "part.canonical")
        known = held.join(attempts, ["kind", "canonical"]).select("hash", name, "attempt").distinct()
        known = known.groupBy("hash").agg(F.map_from_entries(F.collect_list(F.struct("name", "attempt"))).alias(
            "attempts"))
        marked = marked.withColumn("hash", F.xxhash64(text)).join(known, "hash", "left")
        attempt_of = lambda part: F.coalesce(
            F.element_at("attempts", F.concat_ws(":", part["kind"], part["canonical"])), F.lit(0))
    marked = marked.withColumn("names", bare_surnames(F.col("found")))
    replaced = F.array_join(F.transform(
        F.arrays_zip(gaps.alias("gap"), F.transform("found", lambda e: surrogate(key, e, attempt_of)).alias("new")),
        lambda z: F.concat(_without_surnames(key, z["gap"], F.col("names"), attempt_of), F.coalesce(z["new"], F.lit("")))), "")
    if KINDS in docs.columns:
        raise ValueError(f"the documents have a column {KINDS} already")
    done = marked.withColumn(new["text"], F.when(F.size("found") > 0, replaced).otherwise(text))
    # Two steps: in one, a column's old name could be taken for one of the columns added here.
    done = done.select(*new.values(), F.transform("found", kind_of).alias("kinds"))
    return done.select(*back, F.col("kinds").alias(KINDS))
