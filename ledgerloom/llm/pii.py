"""Surrogates for personal data, by DataFrame operations only.

One expression finds e-mail and IP addresses, phone, card, social security and account numbers,
assigned secrets, and names after titles. It looks at every text once; what it finds is stored with the rows.
Every find is made of units: one value, or the words of a name. A unit is known by its kind and canonical
form (lower case, or digits alone), so spellings of one entity stay one entity, and its surrogate is drawn
from a keyed digest of both. Surrogates keep the kind and format: separators, length, letter case, a card's
issuer digit and checksum, a name's script.

A given name has one surrogate, whatever title stands before it. Its gender is that of the titles it is
most often found with in the corpus; where none tells, that of the name itself. In the text that holds a titled name,
the full name and the family name are replaced wherever they stand again without a title.

Two units of a kind must not share a surrogate, and no surrogate may be another unit's original.
Distinct units of the whole corpus are checked for that; losers draw again with the next attempt
until no collision is left. Attempts widen the space of names. Only units that drew again, or whose gender the
corpus tells otherwise, are joined to the documents that hold them; all others are computed where they stand.

Defined results: null texts stay null and have no entities; empty texts stay empty. Repeated rows get
the same replacements. Rows keep their columns, whatever their names; columns called n_entities or entity_kinds
are replaced by those of the result. ``n_entities`` counts what the expression found. An empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch, is_empty, prepare

# What is searched for. Titles tell a gender; the order of kinds settles ties.
TITLES = {"m": "Mr|Herr|Señor|Sr|Monsieur|Господин", "f": "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Госпожа", "any": "Dr|Prof"}
TITLE = "(?:" + "|".join(f"{t}|{t.upper()}" for group in TITLES.values() for t in group.split("|")) + ")"
#: One title or several, each perhaps with a point; blanks and line breaks may follow.
TITLED = rf"{TITLE}\.?\s++(?:{TITLE}\.?\s++)*+"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
GROUP = "[0-9A-Fa-f]{1,4}"
#: Written out or shortened, the last two groups perhaps as an IPv4 address; not a part of a longer run of groups.
IP6 = (
    rf"(?<![0-9A-Za-z])(?<!(?<![0-9A-Za-z])[0-9A-Fa-f]{{1,4}}:)(?=[0-9A-Fa-f]{{0,4}}:[0-9A-Fa-f:])(?:(?:{GROUP}:){{6}}(?:{OCTET}\.){{3}}{OCTET}|(?:{GROUP}:){{7}}{GROUP}"
    rf"|(?:{GROUP}(?::{GROUP}){{0,5}})?::(?:{GROUP}:){{0,5}}(?:{OCTET}\.){{3}}{OCTET}|(?:{GROUP}(?::{GROUP}){{0,6}})?::{GROUP}(?::{GROUP}){{0,6}}|{GROUP}(?::{GROUP}){{0,6}}::)"
    r"(?![0-9A-Za-z]|:[0-9A-Fa-f:]|\.[0-9])"
)
NAME_WORD = r"\p{Lu}(?:[\p{L}\p{M}'\-]|’(?=\p{Lu}))++"
#: Small words inside a name; they stay as they are.
PARTICLES = "van|von|der|den|de|del|della|di|da|dos|das|do|du|la|le|los|las|y|e|zu|zum|zur|ter|ten|bin|ibn|al|el|af|av"
#: Initials count as a word where another word of the name follows.
INITIALS = r"(?:\p{Lu}\.-?)++(?=[ \t]*+\p{Lu})"
NAMED = rf"(?:(?:{PARTICLES})[ \t]++){{0,3}}+(?:{INITIALS}|{NAME_WORD})"
ASSIGNED = r"(?i:api[_\-]?key|access[_\-]?key|auth[_\-]?token|token|secret|password|passwd)\s{0,3}[=:]\s{0,3}[\"']?"
PATTERNS = {
    "ip": rf"(?:(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])|{IP6})",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){2,3}(?:[ \-][0-9]{1,3})?)(?![0-9])",
    "phone": r"(?<![0-9+])(?<![0-9][ .\-/])(?:0[0-9]{2,4}[ /\-](?:[0-9]{5,8}|[0-9]{3,4}[ \-][0-9]{3,5})|[0-9]{3} [0-9]{3} [0-9]{4}(?![ .\-][0-9])|\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .\-]?[0-9]{2,4}){2,4}|\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-][0-9]{4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4})(?![0-9])",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": rf"\b{ASSIGNED}[A-Za-z0-9_\-+/.]{{8,}}+",
    "name": rf"\b{TITLED}{NAMED}(?:[ \t]++{NAMED})*+",
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)*+(?<=\.[A-Za-z]{2,63})",
}
#: One look at the first character spares most places the longer expressions.
FOUND = "(?:" + "|".join([
    f"(?=[0-9A-Fa-f:]){IP6}",
    f"(?=[0-9+(])(?:{'|'.join(PATTERNS[k] for k in ('ip', 'ssn', 'card', 'phone'))})", f"(?=[A-Z][A-Z][0-9]){PATTERNS['iban']}",
    f"(?=[AaTtSsPp]){PATTERNS['secret']}", f"(?=[MHSDPFГ]){PATTERNS['name']}", PATTERNS["email"],
]) + ")"

# Names to draw from, by gender and script.
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Lukas Martin Noel Oscar Paul",
    ("f", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Klara Laura Maria Nora Olga Paula",
    ("m", "cyrillic"): "Антон Борис Виктор Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Фёдор Юрий",
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина София Юлия",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te",
    "cyrillic": "ба бе бо ва ве во га го да де до за зе ка ко ла ле ло ма ме мо на не но ра ре ро са се со та те",
}
ALPHABET, HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"


def kind_of(found: Column) -> Column:
    """The first kind whose expression the whole find fits."""
    return F.coalesce(*[F.when(found.rlike(f"^(?:{pattern})$"), F.lit(kind)) for kind, pattern in PATTERNS.items()])


def secret_of(found: Column) -> Column:
    """What is assigned."""
    return F.regexp_extract(found, f"^{ASSIGNED}(.*)$", 1)


def name_of(found: Column) -> Column:
    """A name without its titles."""
    return F.regexp_replace(found, f"^{TITLED}", "")


def words_of(found: Column) -> Column:
    """The words of a name after its titles."""
    return F.split(name_of(found), r"[ \t]+")


def is_initials(word: Column) -> Column:
    return word.rlike(r"^(?:\p{Lu}\.-?)+$")


def told_gender(found: Column) -> Column:
    """What a name's titles tell: f, m or nothing."""
    titles = F.regexp_extract(found, f"^({TITLED})", 1)
    either = {g: "|".join(f"{t}|{t.upper()}" for t in TITLES[g].split("|")) for g in "fm"}
    return F.when(titles.rlike(rf"\b(?:{either['f']})\b"), F.lit("f")).when(titles.rlike(rf"\b(?:{either['m']})\b"), F.lit("m")).otherwise(F.lit(""))


def own_gender(name: Column) -> Column:
    """The gender of a given name in lower case by the lists, else by its ending."""
    def listed(gender):
        return [n.lower() for (g, _), names in GIVEN.items() if g == gender for n in names.split()]

    return F.when(name.isin(listed("f")), F.lit("f")).when(name.isin(listed("m")), F.lit("m")).when(name.rlike("[aая]$"), F.lit("f")).otherwise(F.lit("m"))


def is_particle(word: Column) -> Column:
    return word.rlike(f"^(?:{PARTICLES})$")


def full_ip6(found: Column) -> Column:
    """All groups in lower case without leading zeros; an IPv4 address at the end stays one."""
    def groups(part):
        return F.filter(F.split(F.lower(part), ":"), lambda g: g != "")

    before, after = groups(F.substring_index(found, "::", 1)), groups(F.substring_index(found, "::", -1))
    left_out = F.greatest(F.lit(8) - F.size(before) - F.size(after) - F.when(found.contains("."), 1).otherwise(0), F.lit(0))
    every = F.when(found.contains("::"), F.concat(before, F.array_repeat(F.lit("0"), left_out), after)).otherwise(before)
    return F.array_join(F.transform(every, lambda g: F.regexp_replace(g, "^0+(?=[0-9a-f])", "")), ":")


def units_of(kind: Column, found: Column) -> Column:
    """The units of a find, each with kind, canonical value, told gender and the kind it draws as by itself."""
    def unit(kind, value, gender, alone):
        return F.struct(kind.alias("kind"), value.alias("value"), gender.alias("gender"), alone.alias("alone"))

    named = F.filter(words_of(found), lambda w: ~is_particle(w))
    gender = told_gender(found)
    sorted_out = F.transform(named, lambda w, i: F.struct(
        F.when(i == F.size(named) - 1, F.lit("surname")).when(is_initials(w), F.lit("initials")).otherwise(F.lit("given")).alias("kind"), F.lower(w).alias("value")))
    part = F.transform(sorted_out, lambda u: unit(u["kind"], u["value"], gender, drawing_kind(u["kind"], u["value"], F.lit(""))))
    secret = secret_of(found)
    value = (
        F.when(kind == "ip", F.when(found.contains(":"), full_ip6(found)).otherwise(found)).when(kind == "email", F.lower(found))
        .when(kind == "secret", F.when(secret == F.upper(secret), F.lower(secret)).otherwise(secret))
        .when(kind == "iban", F.replace(found, F.lit(" "), F.lit(""))).otherwise(F.regexp_replace(found, "[^0-9]", ""))
    )
    return F.when(kind == "name", part).otherwise(F.array(unit(kind, value, F.lit(""), kind)))


def drawing_kind(kind: Column, value: Column, told: Column) -> Column:
    """The kind that a unit draws as: given names by gender."""
    gender = F.when(told == "", own_gender(value)).otherwise(told)
    return F.when(kind == "given", F.concat(F.lit("given_"), gender)).otherwise(kind)


def luhn(digits: Column) -> Column:
    """The checksum of a digit string modulo 10."""
    def add(total, j):
        digit = F.substr(digits, F.length(digits) - j, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(j % 2 == 0, digit).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10


def drawn(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a unit in canonical form: every place draws from a keyed digest."""
    seed = F.concat_ws("/", F.lit(key), kind, attempt.cast("string"), value)

    def number(place, below):
        digest = F.sha2(F.concat_ws("/", seed, place.cast("string")), 256)
        return (F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("bigint") % below).cast("int")

    def pick(characters, place):
        return F.substr(F.lit(characters), number(place, len(characters)) + 1, F.lit(1))

    def letters(text, first, hexadecimal=False):
        """``text`` with every letter and digit drawn anew in its class; places count from ``first``."""
        def one(old, i):
            place = i + first
            letter = pick(ALPHABET, place)
            if hexadecimal:
                return pick(HEX, place)
            return (F.when(old.rlike("[0-9]"), number(place, 10).cast("string")).when(old.rlike("[a-z]"), letter)
                    .when(old.rlike("[A-Z]"), F.upper(letter)).otherwise(old))

        # Split once: a substring for every place would walk a long secret again and again.
        return F.when(F.length(text) == 0, F.lit("")).otherwise(F.array_join(F.transform(F.split(text, ""), one), ""))

    # Mail goes to a reserved domain; the labels before the last one are drawn like the mailbox.
    mailbox, host = F.substring_index(value, "@", 1), F.regexp_replace(F.substring_index(value, "@", -1), r"\.[a-z]+$", "")
    email = F.concat(letters(mailbox, 1), F.lit("@"), letters(host, 1001), F.lit(".example"))
    ip = F.concat_ws(".", *[(number(F.lit(k), 254) + 1).cast("string") for k in range(4)])
    # Addresses of eight groups go to the range reserved for documentation.
    digits = F.sha2(F.concat_ws("/", seed, F.lit("groups")), 256)
    ip6 = F.concat_ws(":", F.lit("2001:db8"), *[F.substr(digits, F.lit(4 * k + 1), F.lit(4)) for k in range(6)])
    ip = F.when(value.contains(":"), ip6).otherwise(ip)
    tail = F.concat(F.substr(value, F.lit(1), F.lit(1)), letters(F.substr(value, F.lit(2)), 2))
    # The last digit makes the surrogate as valid, or as invalid, as the original.
    body = F.substr(tail, F.lit(1), F.length(value) - 1)
    card = F.concat(body, F.pmod(luhn(value) - luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
    iban = F.concat(F.substr(value, F.lit(1), F.lit(2)), letters(F.substr(value, F.lit(3)), 3))
    cyrillic = value.rlike(r"\p{IsCyrillic}")

    def series(choices, last, between):
        """Draws at places 0 to ``last``: every attempt adds one."""
        count = len(choices.split())
        return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: F.get(F.split(F.lit(choices), " "), number(i, count))), between)

    def given(gender):
        names = [F.lower(series(GIVEN[gender, script], attempt, "-")) for script in ("cyrillic", "latin")]
        return F.when(cyrillic, names[0]).otherwise(names[1])

    initials = F.array_join(F.transform(F.split(value, ""), lambda x, i: F.when(x.rlike(r"\p{IsCyrillic}"), pick("абвгдезиклмнопрст", i)).when(
        x.rlike(r"\p{L}"), pick(ALPHABET, i)).otherwise(x)), "")
    surname = F.when(cyrillic, series(SYLLABLES["cyrillic"], attempt + 2, "")).otherwise(series(SYLLABLES["latin"], attempt + 2, ""))
    secret = F.when(value.rlike("^[0-9a-f]+$"), letters(value, 1, hexadecimal=True)).otherwise(letters(value, 1))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", tail)
        .when(kind == "ssn", letters(value, 1)).when(kind == "secret", secret).when(kind == "iban", iban)
        .when(kind == "given_m", given("m")).when(kind == "given_f", given("f")).when(kind == "surname", surname).when(kind == "initials", initials)
    )


def shown(kind: Column, found: Column, made: Column) -> Column:
    """A find with the surrogates ``made`` of its units put into its format."""
    one = F.get(made, F.lit(0))

    def cased(original):
        return F.when(original == F.upper(original), F.upper(one)).otherwise(one)

    def filled(places):
        """The find's characters of the class ``places`` replaced in order by those of the surrogate."""
        def put(i):
            old = F.substr(found, i, F.lit(1))
            count = F.length(F.regexp_replace(F.substr(found, F.lit(1), i), f"[^{places}]", ""))
            return F.when(old.rlike(f"[{places}]"), F.substr(one, count, F.lit(1))).otherwise(old)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(found)), put), "")

    name = name_of(found)
    words, gaps = words_of(found), F.split(name, r"[^ \t]+", -1)
    # The family name tells whether a name is shouted; initials are upper case anyway.
    shouted = F.element_at(words, -1).rlike(r"^\p{Lu}{2}[^\p{Ll}]*$")
    names = F.transform(made, lambda w: F.when(shouted | w.contains("."), F.upper(w)).otherwise(F.initcap(F.replace(w, F.lit("-"), F.lit(" ")))))
    names = F.transform(names, lambda w: F.replace(w, F.lit(" "), F.lit("-")))
    placed = F.transform(words, lambda w, i: F.when(is_particle(w), w).otherwise(
        F.get(names, F.size(F.filter(F.slice(words, 1, i + 1), lambda v: ~is_particle(v))) - 1)))
    spaced = F.array_join(F.zip_with(gaps, placed, lambda gap, w: F.concat(gap, F.coalesce(w, F.lit("")))), "")
    secret = secret_of(found)
    return (
        F.when(kind == "name", F.concat(F.regexp_extract(found, f"^({TITLED})", 1), spaced))
        .when(kind == "secret", F.concat(F.regexp_extract(found, f"^{ASSIGNED}", 0), cased(secret)))
        .when(kind == "email", cased(found)).when(kind == "ip", one).when(kind == "iban", filled("0-9A-Z")).otherwise(filled("0-9"))
    )


def finds_of(text: Column) -> Column:
    """Each find's value and kind, in order; empty for null texts."""
    found = F.coalesce(F.regexp_extract_all(text, F.lit(FOUND), 0), F.array().cast("array<string>"))
    return F.transform(found, lambda e: F.struct(e.alias("value"), kind_of(e).alias("kind")))


LETTER = r"[\p{L}\p{M}\p{Nd}]"


def repeats_of(finds: Column, pieces: Column) -> Column:
    """What stands for full and family names of titled finds where they stand again: pairs of text and replacement."""
    def pairs(find, piece):
        full, made = name_of(find["value"]), name_of(piece)
        family, made_family = F.element_at(F.split(full, r"[ \t]+"), -1), F.element_at(F.split(made, r"[ \t]+"), -1)
        both = F.array(*[F.struct(a.alias("old"), b.alias("new")) for a, b in (
            (full, made), (F.upper(full), F.upper(made)), (family, made_family), (F.upper(family), F.upper(made_family)))])
        return F.when(find["kind"] == "name", both).otherwise(F.array().cast("array<struct<old:string,new:string>>"))

    return F.array_distinct(F.filter(F.flatten(F.zip_with(finds, pieces, pairs)), lambda e: F.length(e["old"]) > 1))


def repeat_pattern(repeats: Column) -> Column:
    """One expression for all repeated names of a text, longer ones first."""
    longest = F.reverse(F.sort_array(F.transform(repeats, lambda e: F.struct(F.length(e["old"]).alias("n"), e["old"].alias("old")))))
    either = F.array_join(F.transform(longest, lambda e: F.concat(F.lit("\\Q"), e["old"], F.lit("\\E"))), "|")
    return F.when(F.size(repeats) > 0, F.concat(F.lit(f"(?<!{LETTER})(?:"), either, F.lit(f")(?!{LETTER})")))


def replaced_again(rest: Column, repeats: Column, pattern: Column) -> Column:
    """Text between finds with the repeated names in it replaced."""
    found = F.regexp_extract_all(rest, pattern, F.lit(0))
    new = F.transform(found, lambda x: F.get(F.filter(repeats, lambda e: e["old"] == x), F.lit(0))["new"])
    joined = F.array_join(F.zip_with(F.split(rest, pattern, -1), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(pattern.isNotNull(), joined).otherwise(rest)


def redrawn(scratch: Scratch, units: DataFrame, key: str) -> DataFrame:
    """kind, value and surrogate of the units whose first draw collided; ``units`` are distinct."""
    return settled(scratch, units, key).where("attempt > 0").select("kind", "value", "surrogate")


def settled(scratch: Scratch, units: DataFrame, key: str) -> DataFrame:
    """kind, value, attempt and surrogate of all units, after as many draws as collisions ask for."""
    draw = drawn(F.col("kind"), F.col("value"), F.col("attempt"), key).alias("surrogate")
    current = scratch.save(units.withColumn("attempt", F.lit(0)).select("kind", "value", "attempt", draw), "drawn-0")
    step = 0
    while True:
        # The earliest attempt, then the smallest value, keeps a surrogate that several units drew.
        holder = current.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("first"), F.count("*").alias("n"))
        lost = current.join(holder.where("n > 1"), ["kind", "surrogate"]).where("value != first.value").select("kind", "value")
        # A surrogate that is some unit's original would merge two entities.
        originals = units.select("kind", F.col("value").alias("surrogate"))
        taken = current.join(originals, ["kind", "surrogate"], "left_semi").select("kind", "value")
        losers = scratch.save(lost.unionByName(taken).distinct(), f"lost-{step}")
        if is_empty(losers):
            return current
        again = current.join(losers, ["kind", "value"], "left_semi").withColumn("attempt", F.col("attempt") + 1)
        step += 1
        kept = current.join(losers, ["kind", "value"], "left_anti")
        current = scratch.save(kept.unionByName(again.select("kind", "value", "attempt", draw)), f"drawn-{step}")
        scratch.drop(f"drawn-{step - 1}")


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, and two more columns: n_entities and entity_kinds (sorted, distinct)."""
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "pii")
    # Columns go by numbers in here, so that none clashes.
    own = [c for c in docs.columns if c not in ("n_entities", "entity_kinds")]
    named = docs.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(own) if c != text])
    rows = scratch.save(named.withColumn("finds", finds_of(F.col("text"))), "finds")
    some = rows.where(F.size("finds") > 0)

    units = F.explode(F.flatten(F.transform("finds", lambda f: units_of(f["kind"], f["value"])))).alias("unit")
    mentions = some.select(F.xxhash64("text").alias("held"), units).select("held", "unit.kind", "unit.value", "unit.gender").where("kind <> 'initials'")
    mentions = scratch.save(mentions.groupBy("held", "kind", "value", "gender").agg(F.count("*").alias("n")), "mentions")
    by_title = [F.sum(F.when(F.col("gender") == g, F.col("n")).otherwise(0)).alias(g) for g in "fm"]
    told = mentions.groupBy("kind", "value").agg(*by_title)
    told = told.withColumn("told", F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > F.col("f"), "m").otherwise(""))
    drawing = told.select(F.col("kind").alias("unit_kind"), "value", drawing_kind(F.col("kind"), F.col("value"), F.col("told")).alias("kind"),
                          drawing_kind(F.col("kind"), F.col("value"), F.lit("")).alias("alone"))
    drawing = scratch.save(drawing, "units")
    final = settled(scratch, drawing.select("kind", "value"), key).join(drawing, ["kind", "value"])
    changed = final.where((F.col("attempt") > 0) | (F.col("kind") != F.col("alone"))).select(F.col("unit_kind").alias("kind"), "value", "surrogate")
    changed = scratch.save(changed, "changed")

    # Texts that hold such a unit, by the text's hash: another text of equal hash gets entries it never looks up.
    entry = F.struct(F.concat_ws("/", "kind", "value"), F.col("surrogate"))
    entries = mentions.select("held", "kind", "value").distinct().join(changed, ["kind", "value"]).groupBy("held").agg(F.map_from_entries(F.collect_set(entry)).alias("entries"))
    entries = scratch.save(entries, "entries")
    scratch.drop("mentions", "changed", "units")
    held = some.withColumn("held", F.xxhash64("text")).join(entries, "held", "left")

    def made(unit):
        again = F.element_at("entries", F.concat_ws("/", unit["kind"], unit["value"]))
        return F.coalesce(again, drawn(unit["alone"], unit["value"], F.lit(0), key))

    # A find's surrogates are a value of their own: put in wherever ``shown`` uses them, they make a plan ten times as long.
    found = F.transform("finds", lambda f: F.struct(f["kind"].alias("kind"), f["value"].alias("value"), F.transform(units_of(f["kind"], f["value"]), made).alias("made")))
    pieces = F.transform(found, lambda f: shown(f["kind"], f["value"], f["made"]))
    held = held.withColumn("pieces", pieces).withColumn("repeats", repeats_of(F.col("finds"), F.col("pieces")))
    held = held.withColumn("again", repeat_pattern(F.col("repeats"))).withColumn("rests", F.split("text", FOUND, -1))
    rest = F.transform("rests", lambda r: replaced_again(r, F.col("repeats"), F.col("again")))
    joined = F.array_join(F.zip_with(rest, "pieces", lambda r, piece: F.concat(r, F.coalesce(piece, F.lit("")))), "")
    done = held.withColumn("text", joined).select(*rows.columns).unionByName(rows.where(F.size("finds") == 0))
    columns = [F.col("text" if c == text else f"c{k}").alias(c) for k, c in enumerate(own)]
    kinds = F.array_sort(F.array_distinct(F.transform("finds", lambda f: f["kind"])))
    return done.select(*columns, F.size("finds").alias("n_entities"), kinds.alias("entity_kinds"))
