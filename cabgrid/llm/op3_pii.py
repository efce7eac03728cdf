"""PII surrogates (operator 3, DataFrame functions only).

Detection: e-mail addresses, phone numbers, IPv4 addresses, payment cards
(Luhn-valid), IPv6 addresses, social security numbers, credentials (values of any
length after token/password/secret/key, AKIA keys, long hex strings) and people
named with a title. Each entity gets a surrogate
drawn from a keyed hash of its type and normal form, so every mention of it,
in whatever writing, has the same one (a surname alone and after a first name
too). The surrogate keeps type and form: digit groups, punctuation, case,
length, top-level domain, country code, octet lengths, card network and check
digit, the script of a name and, after a gendered title, its ending.

Distinctness: the table of distinct entities is checked; of entities with one
surrogate all but the first, and those whose surrogate is an entity of the
corpus, are drawn again, until none is left (or, after LAST draws, the form
has no free value left: then the last one stays). Redrawn entities are joined back
to the rows that mention them; all others need no join. Texts without an
entity are passed on in the scan.

Edge cases: null texts stay null and empty ones empty; texts of any length are
whole; rows repeating a doc_id or a text get the same surrogates; null ids are
kept; other columns of any name are kept; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, with_row

KEY = "surrogate-key"
WIDER, LAST = 4, 24

# Titles that announce a person's name, by what they say of gender.
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа")
MALE = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "г-н")
NEUTRAL = ("Dr", "Prof", "Professor")

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Every repeated group is bounded: the engine recurses once for each repetition.
EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}\-]{1,63}+\.){1,32}[A-Za-z]{2,24}"
SAID = r"(?i:token|password|passwd|secret|api_?key|access_?key)[\"']?\s{0,3}[=:]\s{0,3}"
ASSIGNED = SAID + r"""(?:"[^"\r\n]++(?=")|'[^'\r\n]++(?=')|["']?[^\s"'<>]*[^\s"'<>.,;:!?)\]}])"""
KEYS = r"\bAKIA[A-Z0-9]{16}\b|\b[0-9a-f]{32,64}\b"
CARD = r"(?<![\w.])(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,4}|\d{4}(?:-\d{4}){2}-\d{1,4}|\d{4} \d{6} \d{5})(?!\w)"
# Calling codes; a trunk zero in parentheses belongs to the way of writing.
CODE = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
PHONE = (r"\+1[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)|\+[2-9](?:[ .\-/]?\(?\d\)?){7,14}(?!\d)"
         r"|(?<![\w.+\-])(?:1[ .\-])?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?!\w)")
SSN = r"(?<![\w.+\-])\d{3}-\d{2}-\d{4}(?![\w\-])"
HEX = "[0-9A-Fa-f]{1,4}"
IPV6 = (rf"(?<![\w:.])(?=[A-Fa-f:]*\d)(?:(?:{HEX}:){{7}}{HEX}|{HEX}(?::{HEX}){{0,6}}::(?:{HEX}(?::{HEX}){{0,6}})?"
        rf"|::{HEX}(?::{HEX}){{0,6}})(?![\w:])")
IP = rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)"
NAME = r"(?:\p{L}['’])?\p{Lu}\p{L}+(?:['’\-]\p{L}+){0,3}"
PERSON = rf"(?<!\p{{L}})(?:{'|'.join((*FEMALE, *MALE, *NEUTRAL))})\.? {NAME}(?: {NAME})?"
ENTITY = "|".join((EMAIL, ASSIGNED, KEYS, CARD, SSN, IPV6, PHONE, IP, PERSON))

SCRIPTS = (("IsCyrillic", "бвгдзклмнпрстф", "аеиоу"), ("IsGreek", "βγδκλμνπρστφ", "αεηιο"), (None, "bdfgklmnprstvz", "aeiou"))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars(text: Column, body) -> Column:
    """The characters body(position from 1, character), joined."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
                                    lambda j: body(j, F.substring(text, j, F.lit(1)))), "")


def _luhn_sum(digits: Column, odd: int) -> Column:
    """Luhn sum with the digits in places of parity ``odd`` from the right doubled."""
    n = F.length(digits)

    def add(total, j):
        d = F.substring(digits, j, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - j) % 2 == odd, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _part(address: Column, i: int) -> Column:
    """The groups of an IPv6 address before (0) or after (1) its ``::``."""
    return F.filter(F.split(F.coalesce(F.get(F.split(address, "::"), F.lit(i)), F.lit("")), ":"), lambda g: g != "")


def _groups(address: Column) -> Column:
    """The eight groups of an IPv6 address, lower-cased, without leading zeros."""
    a, b = _part(F.lower(address), 0), _part(F.lower(address), 1)
    full = F.concat(a, F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(a) - F.size(b))), b)
    return F.array_join(F.transform(full, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")


def kind(m: Column) -> Column:
    """Type of a match; null if it is none after all (cards need a valid sum)."""
    digits = F.regexp_replace(m, r"\D", "")
    card = m.rlike(r"^[\d \-]+$") & (F.length(digits) >= 13)
    return (
        F.when(m.rlike(f"^{SAID}"), "secret")
        .when(m.contains("@"), "email")
        .when(m.rlike(rf"^{IP}$"), "ip")
        .when(m.contains(":"), "ipv6")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(m.rlike(r"^AKIA") | m.rlike(r"^[0-9a-f]{32,64}$")
              & m.rlike("[a-f]"), "secret")
        .when(card, F.when(_luhn_sum(digits, 1) % 10 == 0, "card"))
        .when(m.rlike(r"^[+(\d]"), F.when(F.length(digits).between(8, 15), "phone"))
        .otherwise("person"))


def lead(m: Column, t: Column) -> Column:
    """The part of a match that stays: what announces it, or a country code."""
    return (F.when(t == "secret", F.regexp_extract(m, rf"^({SAID}[\"']?|AKIA)", 1))
            .when(t == "phone", F.regexp_extract(m, rf"^((?:{CODE}|1(?=[ .\-]))[ .\-/]?(?:\(0\)[ .\-/]?)?)", 1))
            .when(t == "person", F.regexp_extract(m, r"^(\S+ )", 1)).otherwise(""))


def entities(m: Column) -> Column:
    """The entities of a match, as structs (t, norm): one, or a person's names."""
    def of(t):
        core = F.substring(m, F.length(lead(m, t)) + 1, F.length(m))
        names = F.split(F.lower(core), " ")
        title = F.regexp_replace(lead(m, t), r"[. ]", "")
        gender = F.when(title.isin(*FEMALE), "given_f").when(title.isin(*MALE), "given_m").otherwise("given")
        norm = (F.when(t.isin("phone", "card", "ssn"), F.regexp_replace(core, r"\D", ""))
                .when(t == "ipv6", _groups(core)).otherwise(F.lower(core)))
        return F.when(t == "person", F.transform(names, lambda n, i: F.struct(
            F.when(i + 1 < F.size(names), gender).otherwise("surname").alias("t"), n.alias("norm")))).otherwise(
            F.array(F.struct(t.alias("t"), norm.alias("norm"))))
    return _bind(kind(m), of)


def surrogate(t: Column, norm: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate of a normal form, as long as it; ``attempt`` redraws, from
    WIDER on in a wider form (any octets, longer names)."""
    base = F.concat_ws("|", F.lit(key), t, norm, attempt.cast("string"))
    digest = F.concat(F.sha2(base, 256), F.sha2(F.concat(base, F.lit("|")), 256))

    def draw(h):
        def byte(j):
            return F.conv(F.substring(h, (j - 1) % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")

        def pick(pool, j):
            return F.substring(F.lit(pool), byte(j) % len(pool) + 1, F.lit(1))

        def alnum(j, c):
            return (F.when(c.rlike("[0-9]"), pick("0123456789", j)).when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz", j)).otherwise(c))

        n = F.length(norm)
        kept = F.length(F.regexp_extract(norm, r"(\.[a-z]+)$", 1))
        email = _chars(norm, lambda j, c: F.when(j > n - kept, c).otherwise(alnum(j, c)))
        hexa = norm.rlike("^[0-9a-f]+$")
        more = F.greatest((attempt / WIDER).cast("int"), (~norm.rlike("[a-z0-9]")).cast("int"))
        secret = _chars(F.concat(norm, F.repeat(F.lit("a"), more)), lambda j, c: F.when(hexa & c.rlike("[a-f]"), pick("abcdef", j)).otherwise(alnum(j, c)))
        phone = _chars(norm, lambda j, c: F.when(j == 1, pick("23456789", j)).otherwise(pick("0123456789", j)))
        body = _chars(F.substring(norm, F.lit(1), n - 1), lambda j, c: F.when(j == 1, c).otherwise(pick("0123456789", j)))
        card = _bind(body, lambda b: F.concat(b, ((10 - _luhn_sum(b, 0) % 10) % 10).cast("string")))
        ssn = _chars(norm, lambda j, c: F.when(j == 1, pick("12345", j)).when(j.isin(5, 9), pick("123456789", j)).otherwise(pick("0123456789", j)))

        def group(g, i):
            wide = F.when(attempt >= WIDER, F.lit(4)).otherwise(F.length(g))
            digits = F.concat(*[pick("123456789abcdef" if k == 0 else "0123456789abcdef", i * 4 + k + 1) for k in range(4)])
            return F.when(g == "0", g).otherwise(F.substring(digits, F.lit(1), wide))

        ipv6 = F.array_join(F.transform(F.split(norm, ":"), group), ":")
        octets = F.split(norm, r"\.")
        ip = F.array_join(F.transform(octets, lambda o, i: F.when(attempt >= WIDER, byte(i + 1).cast("string"))
                                      .when(F.length(o) == 3, (100 + byte(i + 1) % 156).cast("string"))
                                      .when(F.length(o) == 2, (10 + byte(i + 1) % 90).cast("string"))
                                      .otherwise((1 + byte(i + 1) % 9).cast("string"))), ".")

        longer = F.concat(norm, F.repeat(F.lit("a"), (attempt / WIDER).cast("int")))
        end = F.length(longer)

        def name(consonants, vowels):
            return _chars(longer, lambda j, c: F.when(~c.rlike(r"\p{L}"), c).when((j == end) & (t == "given_f"), F.lit(vowels[0]))
                          .when((j == end) & (t == "given_m"), pick(consonants, j))
                          .when(j % 2 == 1, pick(consonants, j)).otherwise(pick(vowels, j)))

        person = F.when(norm.rlike(rf"\p{{{SCRIPTS[0][0]}}}"), name(*SCRIPTS[0][1:])).when(
            norm.rlike(rf"\p{{{SCRIPTS[1][0]}}}"), name(*SCRIPTS[1][1:])).otherwise(name(*SCRIPTS[2][1:]))
        return (F.when(t == "email", email).when(t == "secret", secret).when(t == "phone", phone)
                .when(t == "card", card).when(t == "ip", ip).when(t == "ssn", ssn).when(t == "ipv6", ipv6).otherwise(person))

    return _bind(digest, draw)


def _written(m: Column, t: Column, new: Column) -> Column:
    """``new`` in the writing of the match: its digit groups, or its case."""
    head = lead(m, t)
    core = F.substring(m, F.length(head) + 1, F.length(m))
    nth = lambda j: F.length(F.regexp_replace(F.substring(core, F.lit(1), j), r"\D", ""))
    digits = _chars(core, lambda j, c: F.when(c.rlike(r"\d"), F.substring(new, nth(j), F.lit(1))).otherwise(c))
    cased = _chars(new, lambda j, c: F.when(F.substring(core, j, F.lit(1)) != F.lower(F.substring(core, j, F.lit(1))), F.upper(c))
                   .otherwise(c))
    six = F.split(new, ":")
    a, b = _part(core, 0), _part(core, 1)
    as_long = lambda g, old: F.when(F.length(old) > F.length(g), F.lpad(g, 4, "0")).otherwise(g)
    left = F.array_join(F.zip_with(F.slice(six, F.lit(1), F.size(a)), a, as_long), ":")
    right = F.array_join(F.zip_with(F.slice(six, 9 - F.size(b), F.size(b)), b, as_long), ":")
    address = F.concat(left, F.when(core.contains("::"), F.concat(F.lit("::"), right)).otherwise(""))
    address = F.when(core.rlike("[A-F]"), F.upper(address)).otherwise(address)
    return F.concat(head, F.when(t.isin("phone", "card", "ssn"), digits).when(t == "ip", new).when(t == "ipv6", address).otherwise(cased))


def replaced(text: Column, found: Column, attempts: Column, key: str = KEY) -> Column:
    """``text`` with its matches ``found`` replaced; ``attempts``: map "type|norm"
    to the type (of a given name, what the corpus says of gender) and the
    attempt of entities that are not drawn as they are mentioned."""
    def new(m):
        def write(t):
            parts = F.transform(entities(m), lambda e: _bind(F.element_at(attempts, F.concat_ws("|", e["t"], e["norm"])), lambda a: surrogate(
                F.coalesce(a["as_t"], e["t"]), e["norm"], F.coalesce(a["attempt"], F.lit(0)), key)))
            return F.when(t.isNull(), m).otherwise(_written(m, t, F.array_join(parts, " ")))
        return _bind(kind(m), write)

    gaps = F.split(text, ENTITY, -1)
    return F.array_join(F.zip_with(gaps, F.transform(found, new), lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")


def by_name(known: DataFrame) -> DataFrame:
    """(t, norm, as_t): the type each distinct entity ``known`` (t, norm) is
    drawn as. A given name is one entity under any title: female or male if its
    titles say one of the two, else of no gender."""
    given = known.filter(F.col("t").startswith("given"))
    said = given.groupBy("norm").agg(F.max((F.col("t") == "given_f").cast("int")).alias("f"), F.max((F.col("t") == "given_m").cast("int")).alias("m"))
    as_t = F.when(F.col("f") > F.col("m"), "given_f").when(F.col("m") > F.col("f"), "given_m").otherwise("given")
    return (given.join(said, "norm").select("t", "norm", as_t.alias("as_t"))
            .unionByName(known.filter(~F.col("t").startswith("given")).select("t", "norm", F.col("t").alias("as_t"))))


def redraws(known: DataFrame, key: str = KEY) -> DataFrame:
    """(t, norm, attempt) of the entities that need an attempt after 0, from
    the distinct entities ``known`` (t, norm)."""
    drawn = materialise(known.withColumn("attempt", F.lit(0)).withColumn("new", surrogate(F.col("t"), F.col("norm"), F.col("attempt"), key)))
    plain = F.regexp_replace("t", "^given.*", "given")  # given names differ whatever their gender
    names = known.select(plain.alias("of"), F.col("norm").alias("real"))
    while True:
        # First of each surrogate: earlier attempts stay, then the smaller normal form.
        first = drawn.groupBy(plain.alias("of"), "new").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "norm")).alias("stays")).filter("n > 1")
        shared = drawn.withColumn("of", plain).join(first, ["of", "new"]).filter(F.struct("attempt", "norm") != F.col("stays")).select("t", "norm")
        real = drawn.join(names, (plain == F.col("of")) & (F.col("new") == F.col("real")), "left_semi").select("t", "norm")
        again = shared.unionByName(real).distinct()
        again = materialise(again.join(drawn.filter(F.col("attempt") < LAST), ["t", "norm"], "left_semi"))
        if again.isEmpty():
            return drawn.filter("attempt > 0").select("t", "norm", "attempt")
        redo = drawn.join(again, ["t", "norm"], "left_semi").withColumn("attempt", F.col("attempt") + 1)
        redo = redo.withColumn("new", surrogate(F.col("t"), F.col("norm"), F.col("attempt"), key))
        drawn = materialise(drawn.join(again, ["t", "norm"], "left_anti").unionByName(redo))


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``row`` (the input row), ``new_text`` and ``n_entities`` of each row of
    ``docs`` (text)."""
    rows = with_row(docs, F.col("text"))
    has = F.coalesce(F.col("text").rlike(ENTITY), F.lit(False))
    clean = rows.filter(~has).select("row", F.col("text").alias("new_text"), F.lit(0).alias("n_entities"))
    marked = materialise(rows.filter(has).select("row", "text", F.regexp_extract_all("text", F.lit(ENTITY), 0).alias("found"))
                         .withColumn("at", F.monotonically_increasing_id()))
    mentions = (marked.select("at", F.explode("found").alias("m")).filter(kind(F.col("m")).isNotNull())
                .select("at", F.explode(entities(F.col("m"))).alias("e")).select("at", "e.t", "e.norm"))
    known = materialise(by_name(mentions.select("t", "norm").distinct()))
    drawn = redraws(known.select(F.col("as_t").alias("t"), "norm").distinct(), key)
    again = (known.join(drawn.withColumnRenamed("t", "as_t"), ["as_t", "norm"], "left")
             .withColumn("attempt", F.coalesce("attempt", F.lit(0))).filter("attempt > 0 or t <> as_t"))
    per_row = (mentions.distinct().join(again, ["t", "norm"]).groupBy("at")
               .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "t", "norm"), F.struct("as_t", "attempt")))).alias("attempts")))
    none = F.create_map().cast("map<string,struct<as_t:string,attempt:int>>")
    full = marked.join(per_row, "at", "left").withColumn("attempts", F.coalesce("attempts", none))
    changed = full.select("row", replaced(F.col("text"), F.col("found"), F.col("attempts"), key).alias("new_text"),
                          F.size(F.filter("found", lambda m: kind(m).isNotNull())).alias("n_entities"))
    return clean.unionByName(changed)


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = replace_entities(table(spark, sf_dir, "documents"))
    return done.select(F.col("row.doc_id").alias("doc_id"), F.col("new_text").alias("text"), "n_entities")
