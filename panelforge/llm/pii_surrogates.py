"""Surrogates for personal data, in DataFrame operations only.

Entities (e-mail, IBAN, IPv4, social security number, payment card, phone, titled name)
are found by one pattern over the whole text. Every distinct entity (type, canonical form)
gets one keyed surrogate of its type, so all its mentions in the corpus change alike,
whatever their punctuation: digits and letters are replaced position by position, octets
stay octets of the same width. Cards and IBANs with right check digits get surrogates with
right check digits. A run of 13 to 19 digits without separators that fails the Luhn test is
no card and stays; one with separators that fails it is replaced all the same, since it may
hold other numbers. A surrogate that another entity already has, or that is
itself somebody's entity, is rejected and drawn again with the next attempt, until all are
distinct; after some attempts surrogates grow longer (addresses leave their octet widths),
so a format with fewer surrogates than entities comes to an end as well.

Names are whole names: any number of words with inner capitals, apostrophes, hyphens,
particles and initials. Their entities are the parts, so given and family names agree
across titles and mentions; a part keeps its script, and a given name the gender of its
titles. Parts of a document's titled names are replaced wherever that document has them as
capitalised words. Initials are turned by a keyed permutation of the alphabet.

Mentions join their surrogates by entity, one row per (document, mention); only documents
with entities are joined back to their text.

Defined results: null texts stay null, empty ones empty; repeated rows change alike; an
empty table gives no rows; extra columns are ignored."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, pick

# Entity patterns, in order of preference at one place of the text.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IBAN = r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])"
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)"
SSN = r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\p{L}\d-])"
CARD = r"(?<![\p{L}\d])\d(?:[ -]?\d){12,18}(?![\p{L}\d])"
PHONE = (r"(?<![\p{L}\d])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
         r"|(?<![\p{L}\d])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
         r"|(?<![\p{L}\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\p{L}\d])")
MALE = r"Mr|Herr|Monsieur|Señor|Sir|г-н|Κύριος"
FEMALE = r"Mrs|Ms|Miss|Frau|Madame|Señora|г-жа|Κυρία"
NEUTRAL = r"Dr|Prof"
TITLES = rf"(?:(?:{MALE}|{FEMALE}|{NEUTRAL})(?![\p{{L}}\p{{M}}])\.? )+"
#: A part of a name (no initial); a closing 's is not of the name.
PART = (rf"(?<![\p{{L}}\p{{M}}\d])(?!(?:{MALE}|{FEMALE}|{NEUTRAL})(?![\p{{L}}\p{{M}}]))\p{{Lu}}\p{{M}}*+"
        r"(?:(?:\p{L}\p{M}*+)+|['’](?!s(?!\p{L}))\p{L}\p{M}*+)+")
INITIAL = r"(?<![\p{L}\p{M}\d])\p{Lu}(?:\.|(?= \p{Lu}))"
PARTICLE = r"(?:(?:van|von|vom|de|del|della|der|den|di|da|dos|du|el|bin|ibn|al|ter|ten|zu|zur|la|le) )"
_NAME_WORD = rf"{PARTICLE}*(?:{INITIAL}|{PART}(?:-{PART})*)"
NAME = rf"(?<!\p{{L}}){TITLES}{_NAME_WORD}(?:(?: |(?<=\.)){_NAME_WORD})*"
ENTITY = "|".join((EMAIL, IBAN, IPV4, SSN, CARD, PHONE, NAME))
#: Texts without any of these hold no entity (a cheap first look).
MARK = rf"[@\d]|{MALE}|{FEMALE}|{NEUTRAL}"

# Given names by script and gender, and syllables of family names by script.
GIVEN = {
    "latin": {"m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Max",
                    "Noah", "Oscar", "Paul", "Simon"],
              "f": ["Alma", "Berta", "Clara", "Dora", "Ella", "Flora", "Greta", "Hanna", "Ida", "Julia", "Lena", "Maria",
                    "Nina", "Olga", "Paula", "Sara"],
              "n": ["Alex", "Charlie", "Dana", "Jamie", "Kim", "Mika", "Robin", "Sasha"]},
    "cyrillic": {"m": ["Антон", "Борис", "Виктор", "Егор", "Иван", "Олег", "Павел", "Юрий"],
                 "f": ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
                 "n": ["Саша", "Женя", "Валя", "Слава"]},
    "greek": {"m": ["Γιώργος", "Νίκος", "Πέτρος", "Σταύρος"], "f": ["Άννα", "Ελένη", "Μαρία", "Σοφία"],
              "n": ["Αντώνη", "Φώτη"]},
}
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "fa", "ga", "go", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo",
              "na", "ne", "no", "pa", "pe", "po", "ra", "re", "ro", "sa", "se", "ta", "te", "to"],
    "cyrillic": ["ба", "ве", "го", "да", "жи", "за", "ко", "ла", "ме", "но", "по", "ра", "со", "ту", "фе", "ша"],
    "greek": ["βα", "γε", "δο", "ζα", "θε", "κο", "λα", "με", "νο", "πα", "ρε", "σο", "τα", "φε", "χο", "ψα"],
}


def luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10: 0 for a valid card number."""
    def one(c, i):
        v = c.cast("int")
        return F.when(i % 2 == 0, v).otherwise(v * 2 - F.when(v > 4, 9).otherwise(0))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda a, x: a + x) % 10


def mod97(iban: Column) -> Column:
    """The remainder of an IBAN without spaces (country and check digits first): 1 if valid."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97)


def kind_of(m: Column) -> Column:
    """The entity's type; ``number`` for a run of digits that is no card."""
    return (F.when(m.contains("@"), "email").when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban")
            .when(m.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip").when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"^\d{13,19}$") & (luhn(m) != 0), "number").when(m.rlike(r"^\d(?:[ -]?\d){12,18}$"), "card").when(m.rlike(r"^[+(\d]"), "phone").otherwise("name"))


def canonical(m: Column, kind: Column) -> Column:
    """What mentions of one entity share (names: see ``name_parts``)."""
    return (F.when(kind == "email", F.lower(m)).when(kind == "ip", m)
            .when(kind == "iban", F.regexp_replace(m, " ", ""))
            .otherwise(F.regexp_replace(m, r"\D", "")))


def part_key(part: Column) -> Column:
    return F.regexp_replace(F.lower(part), "’", "'")


def name_parts(m: Column) -> Column:
    """(canon, style) of each part of a titled name: style is the gender of the title for a
    given name, and s for the last word's parts."""
    name = F.regexp_replace(m, rf"^{TITLES}", "")
    gender = F.when(m.rlike(rf"^(?:{FEMALE})(?!\p{{L}})"), "f").when(m.rlike(rf"^(?:{MALE})(?!\p{{L}})"), "m").otherwise("n")
    last = F.regexp_extract(name, r"[^ ]+$", 0)

    def parts(words: Column, style: Column) -> Column:
        return F.transform(F.regexp_extract_all(words, F.lit(PART), F.lit(0)),
                           lambda x: F.struct(part_key(x).alias("canon"), style.alias("style")))
    return F.concat(parts(F.regexp_extract(name, r"^(.*) [^ ]+$", 1), gender), parts(last, F.lit("s")))


def _number(digest: Column, i: Column, modulo: int) -> Column:
    """A number below ``modulo`` from place ``i`` of the digest."""
    return (F.conv(F.substring(digest, F.pmod(i * 4, F.lit(256)) + 1, F.lit(4)), 16, 10).cast("int") % modulo)


def _letters(s: Column, digest: Column) -> Column:
    """Every digit and letter replaced by one of its class, the rest kept."""
    def one(c, i):
        return (F.when(c.rlike("[0-9]"), _number(digest, i, 10).cast("string"))
                .when(c.rlike("[a-z]"), F.chr(_number(digest, i, 26) + 97))
                .when(c.rlike("[A-Z]"), F.chr(_number(digest, i, 26) + 65)).otherwise(c))
    return F.array_join(F.transform(F.split(s, ""), one), "")


def _octets(s: Column, digest: Column, attempt: int) -> Column:
    def one(o, i):
        any_ = F.conv(F.substring(digest, i * 4 + 1, F.lit(2)), 16, 10).cast("int")
        return (any_ if attempt >= GROW else
                F.when(F.length(o) == 1, _number(digest, i, 10)).when(F.length(o) == 2, _number(digest, i, 90) + 10)
                .otherwise(_number(digest, i, 155) + 100)).cast("string")
    return F.array_join(F.transform(F.split(s, r"\."), one), ".")


def _name(part: Column, style: Column, digest: Column, attempt: int) -> Column:
    """A part's surrogate in small letters: a given name of the pool (with syllables from the
    second attempt on), or a family name of four syllables and more."""
    script = F.when(part.rlike(r"\p{IsCyrillic}"), "cyrillic").when(part.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    out = F.lit(None).cast("string")
    for sc, by in GIVEN.items():
        pool, n = F.array(*map(F.lit, SYLLABLES[sc])), len(SYLLABLES[sc])

        def syllables(count):
            return [F.element_at(pool, _number(digest, F.lit(k), n) + 1) for k in range(1, count + 1)]
        family = F.concat(*syllables(4 + attempt // 2))
        for g, names in by.items():
            given = F.element_at(F.array(*[F.lit(x.lower()) for x in names]), _number(digest, F.lit(0), len(names)) + 1)
            more = syllables(min(2 * attempt, 4 + attempt // 2))
            out = F.when((script == sc) & (style == g), F.concat(given, *more)).otherwise(out)
        out = F.when((script == sc) & (style == "s"), family).otherwise(out)
    return out


#: Attempts in the entity's own length; from here on every second one adds two characters.
GROW = 6


def surrogate(kind: Column, canon: Column, style: Column, attempt: int, secret: str) -> Column:
    """The keyed surrogate of a canonical form: same type, length and layout (longer from the
    attempt ``GROW`` on). That of an e-mail keeps the domain, an entity of its own."""
    full = F.concat(*[F.sha2(F.concat_ws("|", F.lit(secret), kind, canon, F.lit(str(attempt)), F.lit(str(k))), 256)
                      for k in range(4)])
    add = max(0, attempt - GROW + 2) // 2 * 2
    more = F.substring(F.sha2(F.concat_ws("|", F.lit(secret), kind, canon, F.lit(str(attempt)), F.lit("more")), 256), 1, add)
    digits, letters = F.translate(more, "abcdef", "012345"), F.translate(more, "0123456789", "ghijklmnop")
    host, at = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    tld = F.substring_index(canon, ".", -1)
    labels = F.substring(canon, F.lit(1), F.length(canon) - F.length(tld))
    bban = F.concat(_letters(F.expr("substring(canon, 5)"), full), digits)
    check = F.lpad((98 - mod97(F.concat(F.substring(canon, 1, 2), F.lit("00"), bban))).cast("string"), 2, "0")
    body = F.concat(F.substring(canon, 1, 1), _letters(F.expr("substring(canon, 2, length(canon) - 2)"), full), digits)
    last = ((10 - luhn(F.concat(body, F.lit("0")))) % 10).cast("string")
    # the country digit of a phone and the issuer digit of a card stay
    return (F.when(kind == "email", F.concat(letters, _letters(host, full), F.lit("@"), at))
            .when(kind == "domain", F.concat(letters, _letters(labels, full), tld))
            .when(kind == "ip", _octets(canon, full, attempt)).when(kind == "name", _name(canon, style, full, attempt))
            .when((kind == "iban") & (mod97(canon) == 1), F.concat(F.substring(canon, 1, 2), check, bban))
            .when((kind == "card") & (luhn(canon) == 0), F.concat(body, last))
            .when(kind == "iban", F.concat(F.substring(canon, 1, 2), _letters(F.expr("substring(canon, 3)"), full), digits))
            .when(kind.isin("card", "phone"), F.concat(F.substring(canon, 1, 1),
                                                       _letters(F.expr("substring(canon, 2)"), full), digits))
            .otherwise(F.concat(_letters(canon, full), digits)))


def render(mention: Column, kind: Column, new: Column) -> Column:
    """The surrogate in the mention's own layout (names: see ``renamed``)."""
    def fill(pattern: str) -> Column:  # letters and digits of the surrogate in turn, other characters kept
        return F.aggregate(
            F.split(mention, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")),
            lambda acc, c: F.when(c.rlike(pattern), F.struct(
                F.concat(acc["out"], F.substring(new, acc["i"], F.lit(1))).alias("out"), (acc["i"] + 1).alias("i")))
            .otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["i"].alias("i"))),
            lambda acc: F.concat(acc["out"], F.substring(new, acc["i"], F.length(new))))
    upper = mention == F.upper(mention)
    return (F.when(kind == "email", F.when(upper, F.upper(new)).otherwise(new)).when(kind.isin("ip", "name"), new)
            .when(kind == "iban", fill("[A-Z0-9]")).otherwise(fill("[0-9]")))


def renamed(text: Column, puts: Column) -> Column:
    """``text`` with every name part that ``puts`` knows replaced, in the part's own case."""
    def one(part):
        new = F.element_at(puts, part_key(part))
        return F.coalesce(F.when(part == F.upper(part), F.upper(new)).otherwise(F.initcap(new)), part)
    found, rest = F.regexp_extract_all(text, F.lit(PART), F.lit(0)), F.split(text, PART, -1)
    return F.concat(F.array_join(F.transform(found, lambda x, i: F.concat(F.element_at(rest, i + 1), one(x))), ""),
                    F.element_at(rest, -1))


def _initials(secret: str) -> tuple[str, str]:
    """Capitals and what each is replaced by: every alphabet turned by a keyed distance."""
    before, after = "", ""
    for letters in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝÞČĎĞİŁŃŇŘŚŞŠŤŮŹŻŽ",
                    "АБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"):
        by = int(hashlib.sha256(f"{secret}|initial|{letters}".encode()).hexdigest(), 16) % (len(letters) - 1) + 1
        before, after = before + letters, after + letters[by:] + letters[:by]
    return before, after


def _full_name(mention: Column, puts: Column, secret: str) -> Column:
    """A titled name with its parts and initials replaced."""
    title = F.regexp_extract(mention, rf"^{TITLES}", 0)
    name = F.substring(mention, F.length(title) + 1, F.length(mention))
    initial = r"(?<!\p{L})\p{Lu}(?![\p{L}\p{M}'’])"
    found, rest = F.regexp_extract_all(name, F.lit(initial), F.lit(0)), F.split(name, initial, -1)
    turned = F.transform(found, lambda x, i: F.concat(renamed(F.element_at(rest, i + 1), puts), F.translate(x, *_initials(secret))))
    return F.concat(title, F.array_join(turned, ""), renamed(F.element_at(rest, -1), puts))


def dictionary(spark: SparkSession, entities: DataFrame, secret: str) -> DataFrame:
    """(kind, canon) -> new, all distinct within a kind and none of them an entity itself.
    A part of names with one gender's titles only keeps it; one that is also a last word is
    a family name."""
    style = F.when(F.max("style") == "s", "s").when(F.min("style") == F.max("style"), F.max("style")).otherwise("n")
    entities = entities.select("kind", "canon", "style")
    domains = entities.where("kind = 'email'").select(
        F.lit("domain").alias("kind"), F.substring_index("canon", "@", -1).alias("canon"), "style")
    entities = materialize(spark, entities.union(domains).groupBy("kind", "canon").agg(style.alias("style")), "pii-entities")
    pending, taken, attempt = entities, None, 0
    while True:
        drawn = pending.withColumn("new", surrogate(F.col("kind"), F.col("canon"), F.col("style"), attempt, secret))
        first = F.row_number().over(Window.partitionBy("kind", "new").orderBy("canon")) == 1
        drawn = drawn.withColumn("ok", first)
        used = entities.select("kind", F.col("canon").alias("new"))
        if taken is not None:
            used = used.union(taken.select("kind", "new"))
        drawn = drawn.join(used.distinct().withColumn("hit", F.lit(True)), ["kind", "new"], "left")
        drawn = materialize(spark, drawn.select("kind", "canon", "style", "new",
                                                (F.col("ok") & F.col("hit").isNull()).alias("ok")), "pii-drawn")
        good = drawn.where("ok").select("kind", "canon", "new")
        taken = good if taken is None else taken.union(good)
        pending, attempt = drawn.where("not ok").select("kind", "canon", "style"), attempt + 1
        if pending.isEmpty():
            break
    # a domain's surrogate depends on the domain alone, so colleagues stay colleagues
    domains = taken.where("kind = 'domain'").select(F.col("canon").alias("domain"), F.col("new").alias("to"))
    mails = taken.where("kind = 'email'").withColumn("domain", F.substring_index("canon", "@", -1)).join(domains, "domain")
    return taken.where("kind not in ('email', 'domain')").union(
        mails.select("kind", "canon", F.concat(F.substring_index("new", "@", 1), F.lit("@"), "to")))


def replace_pii(spark: SparkSession, docs: DataFrame, secret: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``secret`` keys the surrogates: who knows it can test guesses, so keep it apart. One row per document: doc_id, text with surrogates, n_entities, and one count per type
    (n_email, n_iban, n_ip, n_ssn, n_card, n_phone, n_name). Untitled mentions aren't counted."""
    d = pick(docs, doc_id=id_col, text=text_col)
    # the texts with entities, once, with what was found
    found = F.when(F.col("text").rlike(MARK), F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    d = d.withColumn("found", F.coalesce(found, F.array().cast("array<string>"))).withColumn(
        "content", F.xxhash64("text"))
    keys = materialize(spark, d.where("size(found) > 0").select("doc_id", "content", F.array_distinct("found").alias("found"))
                       .distinct(), "pii-found")
    mentions = keys.select("doc_id", "content", F.explode("found").alias("mention"))
    mentions = mentions.withColumn("kind", kind_of(F.col("mention"))).where("kind <> 'number'")
    plain = F.array(F.struct(canonical(F.col("mention"), F.col("kind")).alias("canon"), F.lit(None).cast("string").alias("style")))
    mentions = mentions.withColumn("part", F.explode(F.when(F.col("kind") == "name", name_parts(F.col("mention")))
                                                     .otherwise(plain))).select("doc_id", "content", "mention", "kind", "part.*")
    mentions = mentions.withColumn("mention", F.when(F.col("kind") == "name", F.col("canon")).otherwise(F.col("mention")))
    new = mentions.join(dictionary(spark, mentions, secret), ["kind", "canon"]).withColumn(
        "put", render(F.col("mention"), F.col("kind"), F.col("new")))
    maps = new.groupBy("doc_id", "content").agg(F.map_from_entries(F.collect_set(F.struct("mention", "put"))).alias("puts"))
    maps = maps.toDF("map_id", "map_content", "puts")
    # a document with no more than initials or plain numbers has no map
    hit = d.where("size(found) > 0").join(maps, F.col("doc_id").eqNullSafe(F.col("map_id")) &
                                          (F.col("content") == F.col("map_content")), "left").withColumn(
        "puts", F.coalesce("puts", F.create_map().cast("map<string,string>")))
    puts, pieces = F.col("puts"), F.split("text", ENTITY, -1)
    # untitled mentions of the document's names lie between its entities
    pieces = F.when(F.exists("found", lambda m: kind_of(m) == "name"), F.transform(pieces, lambda x: renamed(x, puts))
                    ).otherwise(pieces)
    text = F.concat(F.array_join(F.transform("found", lambda m, i: F.concat(
        F.element_at("pieces", i + 1), F.when(kind_of(m) == "name", _full_name(m, puts, secret))
        .when(kind_of(m) == "number", m).otherwise(F.element_at(puts, m)))), ""), F.element_at("pieces", -1))
    hit = hit.withColumn("pieces", pieces)
    kinds = F.transform("found", kind_of)
    counts = [(F.size("found") - F.size(F.array_remove(kinds, n))).cast("long").alias(f"n_{n}")
              for n in ("email", "iban", "ip", "ssn", "card", "phone", "name")]
    entities = F.size(F.array_remove(kinds, "number")).cast("long").alias("n_entities")
    done = hit.select("doc_id", text.alias("text"), entities, *counts)
    clean = d.where("size(found) = 0").select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"),
                                              *[F.lit(0).cast("long").alias(c) for c in done.columns[3:]])
    return done.union(clean)
