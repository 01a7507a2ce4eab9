r"""Surrogates for personal data.

Detected entities are replaced by keyed surrogates of the same type and format:
letters by letters of the same script and case, digits by digits, hex by hex, with
punctuation and lengths kept; IPv4 octets stay octets, card numbers keep a valid
check digit valid, e-mail addresses keep their top-level domain, and names of people
become names of the same gender and script.

A surrogate is a function of the key, the type, the entity and an attempt number.
The distinct entities of the corpus are checked together: a surrogate that two
entities claim goes to one of them, and one that equals an entity of the corpus to
none; the others try again with the next attempt, and after ``GROW_AFTER`` attempts
with a longer format. So the same entity has one surrogate everywhere, different
entities have different ones, and no surrogate is somebody's real value.

Coreference: e-mail addresses and names are one entity without regard to case;
cards, phones, IBANs and SSNs are known by their letters and digits, and each mention
keeps its own separators. A given or family name that stands alone becomes that part
of the surrogate of the document's first full name with it.

Limits of the detection: names of people are given names of ``GIVEN`` (60 names in
Latin and Cyrillic script), with particles, before a family name that starts with a
capital or is in capitals; other names are not seen. Secrets are lower-case hex runs
from 32 characters, and runs from 12 characters after one of seven labels (in any
case, quoted or not) with ``=`` or ``:``. No run has an upper bound, and a labelled
secret is tried before any number that it might begin with. Four numbers after
``version`` or ``v`` are no address, digits after ``ISBN`` no card.

Edge cases: null and empty texts stay as they are; texts of any length are searched
whole; an entity that fills a text is replaced like any other; equal rows give equal
rows; an empty table gives no rows; other columns pass through, an ``n_entities`` of
the input is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, lower_ascii, row_key, settled

GROW_AFTER = 12
BLOCKS = 6  # of 64 keyed bytes each, at least; longer values take more

# Given names by script and gender, and family names by script.
GIVEN = {
    ("latin", "f"): ["Alice", "Anna", "Camille", "Carmen", "Charlotte", "Elena", "Emily", "Greta", "Ingrid", "Isabel",
                     "Julia", "Laura", "Lucía", "Maria", "Nathalie", "Olivia", "Sabine", "Sarah", "Sofia", "Ursula"],
    ("latin", "m"): ["Andreas", "Antonio", "Carlos", "Daniel", "David", "Diego", "Edward", "François", "Friedrich",
                     "George", "Hans", "James", "Javier", "John", "Jürgen", "Michael", "Peter", "Pierre", "Robert", "Thomas"],
    ("cyrillic", "f"): ["Анна", "Дарья", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Светлана", "Татьяна", "Юлия"],
    ("cyrillic", "m"): ["Алексей", "Борис", "Владимир", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей", "Юрий"],
}
# Syllables of surrogate family names by script.
SYLLABLES = {
    "latin": ["bar", "ben", "cal", "dor", "fen", "gar", "hol", "kin", "lam", "mor", "nor", "pel", "ros", "sel", "tal", "wen"],
    "cyrillic": ["бар", "бел", "вал", "гор", "дан", "жар", "зор", "кор", "лаз", "мор", "нов", "пет", "рос", "сел", "тал", "фом"],
}

_EDGE = r"(?<![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_LABEL = r"(?i:token|secret|password|passwd|api_key|apikey|access_key)"
#: Types in the order they are tried at a position.
PATTERNS = {
    "secret": rf"(?<={_LABEL}[\"']?[ ]{{0,2}}[=:][ ]{{0,2}}[\"']?)[A-Za-z0-9+/_.=-]{{12,}}(?<!\.)(?!\.*+[\p{{L}}\p{{N}}+/_=@-])"
              + "|" + _EDGE + r"[0-9a-f]{32,}+(?![\p{L}\p{N}])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?\.){1,126}\p{L}{2,24}",
    "ip": rf"(?<![\p{{N}}.])(?<!(?i:version|ver|v)[. ]{{0,2}}){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{N}}]|\.[0-9])",
    "iban": _EDGE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "card": r"(?<![\p{L}\p{N}.-])(?<!(?i:isbn)(?:-1[03])?[: ]{0,2})[0-9](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?[0-9]{3,4}|[0-9]{3}[ .-][0-9]{3})[ .-][0-9]{3,4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![\p{L}\p{N}])",
}
# Words between given and family names.
PARTICLES = ["da", "de", "del", "den", "der", "di", "do", "dos", "du", "la", "le", "van", "von", "zu"]


def _name_pattern() -> str:
    """One or more known given names, particles, and a family name: capitalised, with an
    inner capital or an apostrophe, double, or all in capitals after given names that are."""
    names = sorted({n for group in GIVEN.values() for n in group})

    def either(names: list[str]) -> str:
        by_first = {c: [n[1:] for n in names if n[0] == c] for c in sorted({n[0] for n in names})}
        return "(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + ")"

    end = r"(?![\p{L}\p{N}])"
    family = r"(?:\p{Lu}['’])?\p{Lu}[\p{Ll}\p{M}]+(?:\p{Lu}[\p{Ll}\p{M}]+)?"
    given, capitals = either(names), either([n.upper() for n in names])
    mixed = rf"{given}(?: {given}(?= )){{0,8}}(?: (?:{'|'.join(PARTICLES)})){{0,4}} {family}(?:-{family})?{end}"
    upper = rf"{capitals}(?: {capitals}(?= )){{0,8}} (?:\p{{Lu}}['’])?[\p{{Lu}}\p{{M}}]{{2,}}+(?:-[\p{{Lu}}\p{{M}}]{{2,}}+)?{end}"
    return _EDGE + f"(?:{mixed}|{upper})"


#: Types that are one entity whatever their separators are.
SEPARATED = ("card", "phone", "iban", "ssn")
#: Words with their hyphens, and what is between words.
WORDS = r"(?:\p{Lu}['’](?=\p{Lu}))?[\p{L}\p{M}\p{N}-]++|[^\p{L}\p{M}\p{N}-]++"
ENTITY = "|".join([*PATTERNS.values(), _name_pattern()])
#: Every text with an entity has a digit, an @, a secret's label, a run of hex letters or a name.
MAYBE = r"[@0-9]|(?i:token|secret|passw(?:or)?d|key)[\"']?[ ]{0,2}[=:]|[a-f]{32}|" + _name_pattern()


def _kind(value: Column) -> Column:
    """Type of a found entity, by the first pattern that fits it whole."""
    bare = {k: p for k, p in PATTERNS.items() if k != "secret"}
    out = reduce(lambda acc, kv: acc.when(value.rlike(f"^(?:{kv[1]})$"), F.lit(kv[0])),
                 list(bare.items())[1:], F.when(value.rlike(f"^(?:{bare['email']})$"), F.lit("email")))
    out = out.when(value.rlike(f"^(?:{_name_pattern()})$"), F.lit("person"))
    return out.otherwise(F.when(value.rlike(r"^[0-9a-f]+$"), F.lit("hex")).otherwise(F.lit("secret")))


# --------------------------------------------------------------------- surrogates

def _blocks(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Hex digits that depend on key, type, value and attempt: two for every
    character of the value, in blocks of 128."""
    seed = F.concat_ws("\u001f", F.lit(key), kind, attempt.cast("string"), value)
    last = F.greatest(F.lit(BLOCKS), F.ceil(F.char_length(value) / 64).cast("int")) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.sha2(F.concat(b.cast("string"), F.lit("\u001f"), seed), 512))


def _shaped(value: str, blocks: str) -> str:
    """SQL of a text like ``value`` with every letter and digit replaced by a keyed
    one of the same class; the byte for a position is two hex digits of the blocks."""
    byte = f"cast(conv(substr(element_at({blocks}, cast(i div 64 as int) + 1), (i % 64) * 2 + 1, 2), 16, 10) as int)"

    def one_of(letters: str) -> str:
        return f"substr('{letters}', {byte} % {len(letters)} + 1, 1)"

    latin, cyrillic, greek = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω"
    return (f"array_join(transform(split({value}, ''), (c, i) -> CASE WHEN c RLIKE '[0-9]' THEN cast({byte} % 10 as string) "
            f"WHEN c RLIKE '\\\\p{{IsCyrillic}}' THEN CASE WHEN c = lower(c) THEN {one_of(cyrillic)} ELSE {one_of(cyrillic.upper())} END "
            f"WHEN c RLIKE '\\\\p{{IsGreek}}' THEN CASE WHEN c = lower(c) THEN {one_of(greek)} ELSE {one_of(greek.upper())} END "
            f"WHEN c RLIKE '\\\\p{{L}}' THEN CASE WHEN c = lower(c) THEN {one_of(latin)} ELSE {one_of(latin.upper())} END "
            f"ELSE c END), '')")


def _check_digit(digits: Column) -> Column:
    """The Luhn digit that completes a run of digits."""
    n = F.char_length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, k: acc + _doubled(digits, n, k))
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _doubled(digits: Column, n: Column, k: Column) -> Column:
    d = F.substring(digits, k, F.lit(1)).cast("int")
    twice = F.when(d >= 5, 2 * d - 9).otherwise(2 * d)
    return F.when((n - k) % 2 == 0, twice).otherwise(d)


def _card(value: Column, shaped: Column) -> Column:
    """Shaped digits; a number whose check digit was right gets the right one."""
    old, new = (F.regexp_replace(c, "[^0-9]", "") for c in (value, shaped))
    valid = _check_digit(F.substring(old, 1, F.char_length(old) - 1)) == F.substring(old, F.char_length(old), F.lit(1))
    fixed = F.concat(F.substring(shaped, 1, F.char_length(shaped) - 1), _check_digit(F.substring(new, 1, F.char_length(new) - 1)))
    return F.when(valid, fixed).otherwise(shaped)


def _byte(stream: Column, k: int) -> Column:
    return F.conv(F.substring(stream, 2 * k + 1, 2), 16, 10).cast("int")


def _person(value: Column, stream: Column, grown: Column) -> Column:
    """Other given names of the same gender and script, the particles, and a family name
    of the script."""
    words = F.split(value, " ")
    given = F.element_at(words, 1)
    middle = F.slice(words, F.lit(2), F.size(words) - 2)
    out = None
    for (script, _gender), names in GIVEN.items():
        listed = F.array(*[F.lit(n) for n in names])
        pick = _byte(stream, 0) % (len(names) - 1) + 1
        first = F.element_at(listed, pick + (pick >= F.array_position(listed, given)).cast("int"))
        parts = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        one, two = (F.initcap(F.concat(*[F.element_at(parts, _byte(stream, k) % len(SYLLABLES[script]) + 1) for k in at]))
                    for at in ((1, 2, 3, 4), (5, 6, 7, 8)))
        between = F.array_join(F.transform(middle, lambda w, i: F.concat(F.lit(" "), F.when(
            F.lower(w).isin(PARTICLES), F.lower(w)).otherwise(F.element_at(listed, (_byte(stream, 9) + i) % len(names) + 1)))), "")
        name = F.concat(first, between, F.lit(" "), one, F.when(grown, F.concat(F.lit("-"), two)).otherwise(F.lit("")))
        fits = given.isin(names)
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def _with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt) → with a candidate surrogate."""
    e = entities.withColumn("blocks", _blocks(F.col("kind"), F.col("value"), F.col("attempt"), key))
    e = e.withColumn("stream", F.array_join("blocks", ""))
    domain = F.regexp_extract("value", r"\.(\p{L}+)$", 1)
    e = e.withColumn("body", F.when(F.col("kind") == "email", F.regexp_replace("value", r"\p{L}+$", "")).otherwise(F.col("value")))
    e = e.withColumn("shaped", F.expr(_shaped("body", "blocks")))
    octets = F.concat_ws(".", *[(_byte(F.col("stream"), k) % 254 + 1).cast("string") for k in range(4)])
    hexed = F.expr("substr(stream, 1, length(value))")
    # too many clashes: the format has fewer values than there are entities
    grown = F.col("attempt") > GROW_AFTER
    longer = F.when(grown, F.translate(F.substring("stream", 1, 8), "abcdef", "012345")).otherwise(F.lit(""))
    made = (F.when(F.col("kind") == "email", F.concat(longer, F.col("shaped"), domain))
            .when(F.col("kind") == "ip", F.when(grown, F.concat(F.lit("2001:db8::"), F.substring("stream", 1, 4), F.lit(":"),
                                                                F.substring("stream", 5, 4))).otherwise(octets))
            .when(F.col("kind") == "card", F.concat(_card(F.col("value"), F.col("shaped")), longer))
            .when(F.col("kind") == "hex", F.concat(hexed, longer))
            .when(F.col("kind") == "person", _person(F.col("value"), F.col("stream"), grown))
            .otherwise(F.concat(F.col("shaped"), longer)))
    return e.select("kind", "value", "attempt", made.alias("surrogate"))


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Distinct (kind, value) → surrogate, distinct per kind and never one of the values."""
    todo = settled(entities.select("kind", "value").distinct())
    real = todo.withColumnRenamed("value", "surrogate")
    todo = todo.withColumn("attempt", F.lit(0))
    done = None
    while True:
        made = settled(_with_surrogates(todo, key))
        free = lookup_join(made, real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = lookup_join(free, done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = settled(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")))
        done = won if done is None else settled(done.unionByName(won))
        todo = lookup_join(made, won.select("kind", "value"), ["kind", "value"], "left_anti")
        todo = settled(todo.select("kind", "value", (F.col("attempt") + 1).alias("attempt")))
        if todo.isEmpty():
            return done


# ---------------------------------------------------------------------- documents

def _canonical(kind: Column, value: Column) -> Column:
    return (F.when(kind == "email", lower_ascii(value))
            .when(kind == "person", F.initcap(F.lower(value)))
            .when(kind.isin(*SEPARATED), F.regexp_replace(value, "[^A-Za-z0-9]", "")).otherwise(value))


def _formatted(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate of a bare number with the separators of the mention, of a name in
    its case."""
    bare = r"regexp_replace({}, '[^A-Za-z0-9]', '')"
    before = f"length({bare.format('substr(mention, 1, i)')})"
    put = F.expr(f"array_join(transform(split(mention, ''), (c, i) -> CASE WHEN c RLIKE '[A-Za-z0-9]' "
                 f"THEN substr(surrogate, {before} + 1, 1) ELSE c END), '')")
    rest = F.expr(f"substr(surrogate, length({bare.format('mention')}) + 1)")
    capitals = (kind == "person") & (mention == F.upper(mention))
    return (F.when(kind.isin(*SEPARATED), F.concat(put, rest)).when(capitals, F.upper(surrogate)).otherwise(surrogate))


def _names(found: Column) -> Column:
    """Single names of a document's people with their surrogates, in order."""
    def parts(x: Column) -> Column:
        return F.array(*[F.concat(F.substring_index(x["mention"], " ", k), F.lit("\u001f"), F.substring_index(x["surrogate"], " ", k))
                         for k in (1, -1)])

    people = F.transform(F.filter(found, lambda x: x["kind"] == "person"), parts)
    return F.array_distinct(F.flatten(people))


def _linked(pieces: Column, names: Column) -> Column:
    """Per piece of text its words and separators, single names replaced, as (old, new)."""
    words = F.transform(names, lambda x: F.substring_index(x, "\u001f", 1))
    news = F.transform(names, lambda x: F.substring_index(x, "\u001f", -1))

    def new(word: Column) -> Column:
        at = F.array_position(words, word).cast("int")
        return F.when(at > 0, F.element_at(news, F.greatest(at, F.lit(1)))).otherwise(word)

    def both(word: Column) -> Column:
        split = word.contains("-") & ~F.array_contains(words, word)
        joined = F.array_join(F.transform(F.split(word, "-"), new), "-")
        return F.struct(word.alias("old"), F.when(split, joined).otherwise(new(word)).alias("new"))

    return F.transform(pieces, lambda piece: F.transform(F.regexp_extract_all(piece, F.lit(WORDS), F.lit(0)), both))


def entities_of(docs: DataFrame) -> DataFrame:
    """(key, p, kind, value, mention): the entities of every whole text in order, as
    known and as written; key digests doc_id and text."""
    found = F.regexp_extract_all(F.col("text"), F.lit(ENTITY), F.lit(0))
    d = docs.select("doc_id", "text").filter(F.col("text").rlike(MAYBE))
    d = d.select(row_key("doc_id", "text").alias("key"), F.posexplode(found).alias("p", "value"))
    d = d.select("key", "p", _kind(F.col("value")).alias("kind"), "value")
    known = _canonical(F.col("kind"), F.col("value")).alias("value")
    return settled(d.select("key", "p", "kind", known, F.col("value").alias("mention")).distinct())


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and n_entities, the entities replaced.
    ``key`` is the secret that surrogates depend on."""
    found = entities_of(docs)
    table = assign_surrogates(found, key)
    mapped = lookup_join(found, table, ["kind", "value"], "inner")
    mapped = mapped.withColumn("surrogate", _formatted(F.col("kind"), F.col("mention"), F.col("surrogate")))
    lists = mapped.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("p", "surrogate", "kind", "mention"))).alias("found"))
    lists = settled(lists.select("key", F.transform("found", lambda x: x["surrogate"]).alias("surrogates"),
                                 _names(F.col("found")).alias("names")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    out = lookup_join(docs.select(row, "text", row_key("doc_id", "text").alias("key")), lists, ["key"], "left")
    out = out.withColumn("pieces", F.when(F.col("surrogates").isNotNull(), F.split("text", ENTITY)))
    out = out.withColumn("linked", F.when(F.size("names") > 0, _linked(F.col("pieces"), F.col("names"))))
    texts = F.coalesce(F.transform("linked", lambda words: F.array_join(F.transform(words, lambda w: w["new"]), "")), F.col("pieces"))
    joined = F.array_join(F.flatten(F.zip_with(texts, "surrogates", lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    text = F.when(F.col("surrogates").isNull(), F.col("text")).otherwise(joined)
    single = F.size(F.filter(F.flatten("linked"), lambda w: w["old"] != w["new"]))
    n = (F.coalesce(F.size("surrogates"), F.lit(0)) + F.coalesce(single, F.lit(0))).cast("long")
    out = out.select("row", text.alias("new_text"), n.alias("n"))
    return out.select(*[F.col("new_text").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
                        for c in docs.columns if c.lower() != "n_entities"], F.col("n").alias("n_entities"))
