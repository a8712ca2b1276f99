"""Surrogates for personal data: keyed, type-consistent, distinct and coreferent.

Entities are found by one pattern of all kinds: e-mail and IP addresses, telephone, card, account (IBAN) and
social security numbers, access keys, tokens with a known prefix and other hexadecimal secrets, and names
after a title. Each gets a
replacement derived from the secret key, its kind and its canonical form, so that the same entity
is replaced alike everywhere, however it is written: separators and case of the occurrence stay,
a telephone number keeps "+" and its first digit, a card number its first digit and a valid check
digit (without one it is no card number, and stays), an account number its country and valid check digits
(likewise), an access key or token its prefix, an address its last label. Names keep their script; a given
name has one gender in the whole corpus, that of the first of its titles in the order male, female, other;
a surname alone and after a given name is the same one.

Two entities must not share a replacement, and no replacement may be an entity found in the corpus.
All distinct entities are checked together, and those in conflict, but for the first of them, are
derived anew until none is; a replacement's derivations are counted in `attempt`.

Everything is a Spark expression. Texts without a digit, "@", title or prefix of a key are not searched
further. A null text stays null, an empty one empty. Repeated rows, and rows that share a doc_id or have
none, are replaced each by itself. An empty table gives no rows. All columns of the input are returned as
they are, whatever their names, but for `text`, and `_entities`, which the count takes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import checked, prepare
from riskweave.session import materialise

KEY = "riskweave"
#: Derivations after which a conflict is an error: a kind's values must be nearly used up by then.
ATTEMPTS = 64

MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Prof")
TITLE = "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True))
NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# In this order: the first kind that matches at a place is taken. No part is searched twice, as
# look-behinds keep a search from starting inside a run.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=[0-9A-Fa-f:]{0,38}[0-9])[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?![\d]|\.\d)",
    "phone": r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{2,4}\)|[ .-]\d{2,4})(?:[ .-]?\d{2,4}){1,3}(?!\d)"
    r"|(?<![\w(+-])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w.,+/-])0\d{2,4}[ /]\d{6,8}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{13,19})(?![\w-])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "token": r"(?<![A-Za-z0-9_])(?:gh[opsu]_[A-Za-z0-9]{36}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,64}|xox[abp]-[A-Za-z0-9-]{16,64})(?![A-Za-z0-9_])",
    "secret": r"(?<![A-Za-z0-9])(?=[a-fA-F]{0,63}[0-9])(?=[0-9]{0,63}[a-fA-F])(?:[0-9a-f]{16,64}|[0-9A-F]{16,64})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z]{4})?(?: \d{4}){2,6}(?: \d{1,3})?)(?![A-Za-z0-9])",
    "person": rf"(?<![\p{{L}}])(?:{TITLE})\.? {NAME}(?: {NAME})?",
}
PATTERN = "|".join(KINDS.values())
# What a text must hold for any kind to match: all but names and access keys hold a digit or "@".
GATE = rf"[0-9@]|AKIA|ASIA|gh[opsu]_|[sr]k_(?:live|test)_|xox[abp]-|(?<![\p{{L}}])(?:{TITLE})\.? \p{{Lu}}"
PREFIX = r"^(?:gh[opsu]_|[sr]k_(?:live|test)_|xox[abp]-)"
DIGITS = ("phone", "ssn", "card")
# Syllables that surrogate names are built of, by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ja jo ka ke la le li lo ma me mi mo na ne no pa ra re ro sa".split(),
    "cyrillic": "ба бе бо ва ве го да де до за зе зо ка ке ко ла ле ли ло ма ме ми мо на не но па ра ре ро са та".split(),
    "greek": "βα γα γε δα δε ζα ζε θα θε κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε ρα ρε ρο σα τα τε το".split(),
}
# Endings by script: of male, female and other given names, and of surnames.
ENDINGS = {
    "latin": {"given_m": "rt", "given_f": "ia", "given": "n", "surname": "ner"},
    "cyrillic": {"given_m": "н", "given_f": "ия", "given": "л", "surname": "нко"},
    "greek": {"given_m": "ς", "given_f": "ία", "given": "ν", "surname": "κης"},
}


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often and deep the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kind_of(value: Column) -> Column:
    """The kind of a match: the first whose pattern it is, as a whole."""
    tests = [(k, value.rlike(rf"\A(?:{p})\z")) for k, p in KINDS.items()]
    return reduce(lambda rest, t: F.when(t[1], F.lit(t[0])).otherwise(rest), reversed(tests), F.lit("secret"))


def canonical(kind: Column, value: Column) -> Column:
    """One form for all ways to write an entity."""
    digits = F.regexp_replace(value, r"[^0-9+]", "")
    plain = F.when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).when(kind.isin("key", "token"), value)
    return F.when(kind.isin(*DIGITS), digits).otherwise(F.coalesce(plain, F.lower(value)))


def seed(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """128 hexadecimal digits that depend on the key and the entity."""
    text = F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string"))
    return F.concat(F.sha2(F.concat(F.lit("1"), text), 256), F.sha2(F.concat(F.lit("2"), text), 256))


def draw(seeds: Column, place: Column, values: int) -> Column:
    """A number below ``values`` from two bytes of the seed."""
    begin = (place * 4) % 124 + 1
    return F.conv(F.substring(seeds, begin, F.lit(4)), 16, 10).cast("int") % values


def chars(value: Column, change) -> Column:
    """A text changed character by character: ``change(character, place)``."""
    return F.array_join(F.transform(F.split(value, ""), change), "")


def letter(char: Column, seeds: Column, place: Column) -> Column:
    """A digit for a digit, a letter for a letter of the same case, anything else as it is."""
    of = {"0123456789": r"[0-9]", "abcdefghijklmnopqrstuvwxyz": "[a-z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ": "[A-Z]"}
    out = char
    for values, pattern in of.items():
        drawn = F.substring(F.lit(values), draw(seeds, place, len(values)) + 1, F.lit(1))
        out = F.when(char.rlike(pattern), drawn).otherwise(out)
    return out


def luhn(digits: Column) -> Column:
    """Check sum modulo 10 of a card number, its last digit included."""
    n = F.length(digits)
    place = F.sequence(F.lit(1), n)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(place, F.lit(0), add) % 10


def mod97(account: Column) -> Column:
    """An account number, its first four characters last and letters as numbers from 10, modulo 97."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, F.lit(1), F.lit(4)))
    values = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(values, F.lit(0), lambda total, x: (total * F.when(x > 9, 100).otherwise(10) + x) % 97)


def new_account(known: Column, seeds: Column) -> Column:
    """Another account number of the country, with its check digits."""
    country, rest = F.substring(known, F.lit(1), F.lit(2)), F.substring(known, F.lit(5), F.length(known))
    body = chars(rest, lambda c, i: letter(c, seeds, i))
    return let(body, lambda b: F.concat(country, F.lpad((98 - mod97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b))


def new_digits(kind: Column, known: Column, seeds: Column) -> Column:
    """Digits in place of the digits of a number's canonical form."""
    keep = F.when(known.startswith("+") | (kind == "card"), 1).otherwise(0)
    drawn = chars(F.replace(known, F.lit("+"), F.lit("")), lambda c, i: F.when(i < keep, c).otherwise(
        F.when(i == keep, draw(seeds, i, 9) + 1).otherwise(draw(seeds, i, 10)).cast("string")
    ))

    def checked(digits: Column) -> Column:
        short = F.substring(digits, F.lit(1), F.length(digits) - 1)
        return let(short, lambda x: F.concat(x, let(F.concat(x, F.lit("0")), lambda y: ((10 - luhn(y)) % 10).cast("string"))))

    return let(drawn, lambda digits: F.when(kind == "card", checked(digits)).otherwise(digits))


def fill(template: Column, signs: Column, of: str = "0-9") -> Column:
    """The digits (or other signs) of ``template`` replaced one after another, the rest as it is."""

    def change(char: Column, place: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(template, F.lit(1), place), f"[^{of}]", ""))
        return F.when(char.rlike(f"[{of}]"), F.substring(signs, before + 1, F.lit(1))).otherwise(char)

    return chars(template, change)


def new_name(kind: Column, value: Column, seeds: Column, attempt: Column) -> Column:
    """A name of the same script and kind; longer with every ten attempts."""
    script = F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    out = F.lit(None).cast("string")
    for name, table in SYLLABLES.items():
        count = 3 + F.floor(attempt / 10).cast("int")
        body = syllables(table, count, seeds)
        ending = reduce(
            lambda rest, e: F.when(kind == e[0], F.lit(e[1])).otherwise(rest), ENDINGS[name].items(), F.lit("")
        )
        out = F.when(script == name, F.initcap(F.concat(body, ending))).otherwise(out)
    return out


def syllables(table: list[str], count: Column, seeds: Column) -> Column:
    values = F.lit(table)
    return F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.get(values, draw(seeds, i, len(table)))), "")


def replacement(kind: Column, known: Column, attempt: Column, template: Column, key: str) -> Column:
    """What stands for an entity (kind, canonical form, attempt) in place of ``template``."""

    def email(seeds: Column) -> Column:
        local, domain = F.substring_index(template, "@", 1), F.substring_index(template, "@", -1)
        label = F.substring_index(domain, ".", -1)
        host = F.substring(domain, F.lit(1), F.length(domain) - F.length(label))
        hosts = seed(key, F.lit("domain"), F.substring_index(known, "@", -1), F.lit(0))
        new_host = let(hosts, lambda h: chars(host, lambda c, i: letter(c, h, i)))
        return F.concat(chars(local, lambda c, i: letter(c, seeds, i)), F.lit("@"), new_host, label)

    def access(seeds: Column) -> Column:
        prefix = F.when(kind == "key", F.substring(template, F.lit(1), F.lit(4))).otherwise(F.regexp_extract(template, PREFIX, 0))
        rest = F.substring(template, F.length(prefix) + 1, F.lit(80))
        return F.concat(prefix, chars(rest, lambda c, i: letter(c, seeds, i)))

    def groups(seeds: Column) -> Column:
        def hexa(char: Column, place: Column) -> Column:
            low, high = (F.substring(F.lit(x), draw(seeds, place, 6) + 1, F.lit(1)) for x in ("abcdef", "ABCDEF"))
            return F.when(char.rlike("[a-f]"), low).when(char.rlike("[A-F]"), high).otherwise(letter(char, seeds, place))

        return chars(template, hexa)

    def secret(seeds: Column) -> Column:
        made = F.substring(seeds, F.lit(1), F.length(known))
        return F.when(template.rlike("[A-F]"), F.upper(made)).otherwise(made)

    def made(seeds: Column) -> Column:
        octets = [(draw(seeds, F.lit(k), 254) + 1).cast("string") for k in range(4)]
        return (
            F.when(kind == "email", email(seeds))
            .when(kind == "ip", F.concat_ws(".", *octets))
            .when(kind.isin(*DIGITS), let(new_digits(kind, known, seeds), lambda digits: fill(template, digits)))
            .when(kind.isin("key", "token"), access(seeds))
            .when(kind == "ip6", groups(seeds))
            .when(kind == "iban", let(new_account(known, seeds), lambda account: fill(template, account, "A-Z0-9")))
            .when(kind == "secret", secret(seeds))
            .otherwise(new_name(kind, known, seeds, attempt))
        )

    return F.when(kind == "none", template).otherwise(let(seed(key, kind, known, attempt), made))


def parts_of(found: DataFrame) -> DataFrame:
    """(_row, _at, _part, kind, template, known): a name is as many parts as it has words after its title."""
    kind = kind_of(F.col("match"))
    kind = F.when((kind == "card") & (luhn(F.regexp_replace("match", "[^0-9]", "")) != 0), "none").otherwise(kind)
    # A run of hexadecimal digits may be an account number; without valid check digits nothing else is.
    account = F.col("match").rlike(rf"\A(?:{KINDS['iban']})\z")
    valid = account & (mod97(F.when(account, F.replace("match", F.lit(" "), F.lit("")))) == 1)
    kind = F.when(valid, "iban").when(kind == "iban", "none").otherwise(kind)
    title = F.regexp_replace(F.substring_index("match", " ", 1), r"\.$", "")
    gender = F.when(title.isin(*MALE), "given_m").when(title.isin(*FEMALE), "given_f").otherwise("given")
    names = F.slice(F.split("match", " "), 2, 2)
    parts = F.when(kind == "person", names).otherwise(F.array("match"))
    rows = found.select("_row", "_at", kind.alias("of"), gender.alias("gender"), F.size(parts).alias("n"), F.posexplode(parts).alias("_part", "template"))
    named = F.when((F.col("n") == 2) & (F.col("_part") == 0), F.col("gender")).otherwise("surname")
    rows = rows.withColumn("kind", F.when(F.col("of") == "person", named).otherwise(F.col("of")))
    return rows.select("_row", "_at", "_part", "kind", "template", canonical(F.col("kind"), F.col("template")).alias("known"))


def one_gender(parts: DataFrame) -> DataFrame:
    """Parts with one kind for each given name, whatever the titles beside it: male, female, other."""
    order = ("given_m", "given_f", "given")
    given = parts.filter(F.col("kind").isin(*order)).groupBy("known").agg(F.min(F.array_position(F.lit(list(order)), F.col("kind"))).alias("place"))
    given = checked(given)
    kind = F.when(F.col("kind").isin(*order), F.get(F.lit(list(order)), (F.col("place") - 1).cast("int"))).otherwise(F.col("kind"))
    return parts.join(given, "known", "left").withColumn("kind", kind).select(parts.columns)


def settled(entities: DataFrame, key: str) -> DataFrame:
    """(kind, known, attempt) of the entities that need more than their first derivation."""
    entities = materialise(entities)
    state = entities.withColumn("attempt", F.lit(0))
    for _ in range(ATTEMPTS):
        made = replacement(F.col("kind"), F.col("known"), F.col("attempt"), F.col("known"), key)
        state = materialise(state.select("kind", "known", "attempt", canonical(F.col("kind"), made).alias("made")))
        first = materialise(state.groupBy("kind", "made").agg(F.min("known").alias("first"), F.count("*").alias("n")))
        real = entities.select("kind", F.col("known").alias("made"), F.lit(True).alias("real"))
        wrong = first.join(real, ["kind", "made"], "left").filter("n > 1 or real")
        wrong = materialise(wrong.select("kind", "made", "first", "real"))
        if wrong.isEmpty():
            break
        bad = F.col("real") | (F.col("known") != F.col("first"))
        state = state.join(wrong, ["kind", "made"], "left").select(
            "kind", "known", (F.col("attempt") + F.coalesce(bad, F.lit(False)).cast("int")).alias("attempt")
        )
    else:
        raise RuntimeError(f"entities share replacements after {ATTEMPTS} derivations")
    return materialise(state.filter("attempt > 0").select("kind", "known", "attempt"))


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``_entities``: the number of entities replaced."""
    prepare(docs.sparkSession)
    none = F.array().cast("array<string>")
    found = F.when(F.col("text").rlike(GATE), F.regexp_extract_all("text", F.lit(PATTERN), 0)).otherwise(none)
    # Input columns travel in one struct, so none of their names can clash.
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "_entities")]
    marked = docs.select(F.struct(*others, F.lit(0).alias("_")).alias("_all"), "text", F.coalesce(found, none).alias("_found"))
    marked = materialise(marked.withColumn("_row", F.monotonically_increasing_id()))
    some = marked.filter(F.size("_found") > 0)
    parts = materialise(one_gender(materialise(parts_of(some.select("_row", F.posexplode("_found").alias("_at", "match"))))))
    again = settled(parts.filter("kind <> 'none'").select("kind", "known").distinct(), key)
    parts = parts.join(again, ["kind", "known"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
    made = replacement(F.col("kind"), F.col("known"), F.col("attempt"), F.col("template"), key)
    made = parts.select("_row", "kind", F.struct("_at", "_part", made.alias("made")).alias("x"))
    count = F.countDistinct(F.when(F.col("kind") != "none", F.col("x._at")))
    made = materialise(made.groupBy("_row").agg(F.sort_array(F.collect_list("x")).alias("_made"), count.alias("_n")))
    rows = some.join(made, "_row")
    # A name's parts follow its title; other entities are one part, the first.
    named = rf"\A(?:{TITLE})\.? "

    def joined(x: Column) -> Column:
        title = F.concat(F.substring_index(F.get("_found", x["_at"]), " ", 1), F.lit(" "))
        return F.when(x["_part"] > 0, F.concat(F.lit(" "), x["made"])).when(
            F.get("_found", x["_at"]).rlike(named), F.concat(F.get("_pieces", x["_at"]), title, x["made"])
        ).otherwise(F.concat(F.get("_pieces", x["_at"]), x["made"]))

    # Written out first: the pieces are looked up once for each entity.
    rows = materialise(rows.withColumn("_pieces", F.split("text", PATTERN, -1)).drop("text"))
    text = F.concat(F.array_join(F.transform("_made", joined), ""), F.element_at("_pieces", -1))
    def columns(new: Column, count: Column) -> list[Column]:
        old = [c for c in docs.columns if c != "_entities"]
        return [*(new.alias(c) if c == "text" else F.col("_all").getField(c).alias(c) for c in old), count.cast("long").alias("_entities")]

    plain = marked.filter(F.size("_found") == 0).select(*columns(F.col("text"), F.lit(0)))
    return plain.union(rows.select(*columns(text, F.col("_n"))))
