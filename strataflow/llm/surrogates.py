"""Personal data: entities get keyed, type-consistent surrogates, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.shared import column, saved

#: Titles before a name, by gender.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Don", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Doña", "Госпожа")
#: Syllables that surrogate names are made of, by script, and their endings by gender. A part of a name in
#: any other script gets Latin ones.
LATIN = ("ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "we", "li", "ro", "na", "ke")
CYRILLIC = ("ба", "де", "фи", "го", "лу", "ма", "не", "ри", "со", "ту", "ва", "ве", "ли", "ро", "на", "ке")
GREEK = ("βα", "δε", "φι", "γο", "λυ", "μα", "νε", "ρι", "σο", "τυ", "πα", "κε", "λι", "ρο", "να", "ξε")
ARMENIAN = ("բա", "դե", "ֆի", "գո", "լի", "մա", "նե", "րի", "սո", "տի", "վա", "կե", "ժի", "ռո", "նա", "զե")
ENDS = {"Latin": ("n", "a"), "Cyrillic": ("н", "а"), "Greek": ("ν", "α"), "Armenian": ("ն", "ա")}

_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]++@[\w-]++(?:\.[\w-]++)+",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9a-f]*[0-9])[0-9a-f]{32,}+(?![0-9A-Za-z])",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    "card": r"(?<![\w-])(?:\d[ -]?){12,18}\d(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?!\w)",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(MALE + FEMALE)})\.? {_NAME}(?: {_NAME})?+",
}
#: One pattern that finds every kind; earlier kinds win where two begin at one place.
ANY = "|".join(PATTERNS.values())
#: Attempts in an entity's own format before e-mail addresses get longer and octets of any width; names grow with every attempt.
OWN_FORMAT = 8
#: Rounds of collision repair after which the job stops with an error instead of an ambiguous result.
ROUNDS = 30


def kind_of(value: Column) -> Column:
    tests = F.when(value.contains("@"), "email")
    tests = tests.when(value.rlike(r"^[0-9a-f]{32,}$") & value.rlike("[a-f]"), "secret")
    tests = tests.when(value.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
    tests = tests.when(value.rlike(r"^\p{L}"), "name")
    digits = F.length(F.regexp_replace(value, r"\D", ""))
    tests = tests.when(value.rlike(r"^[0-9a-f]{32,}$"), "secret")
    return tests.when((digits >= 13) & ~value.startswith("+"), "card").otherwise("phone")


def canonical(kind: Column, value: Column) -> Column:
    """What two spellings of one entity share: digits of numbers, lower case, names without title."""
    name = F.lower(F.regexp_replace(value, r"^\S+ ", ""))
    return F.when(kind.isin("card", "phone"), F.regexp_replace(value, r"\D", "")).when(kind == "name", name).otherwise(F.lower(value))


def _stream(secret: str, kind: Column, of: Column, attempt: Column) -> Column:
    """64 keyed hexadecimal digits of an entity."""
    return F.sha2(F.concat_ws("\u0001", F.lit(secret), kind, of, attempt.cast("string")), 256)


def _nibble(stream: Column, i: Column, base: int) -> Column:
    """A number below ``base`` from two digits of the stream at place ``i``, which wraps round."""
    at = F.pmod(i * 2, F.lit(62)) + 1
    number = F.conv(F.substring(stream, at, F.lit(2)), 16, 10).cast("int")
    return F.pmod(number + F.floor(i / 31).cast("int") * 7, F.lit(base))


def _char(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), n.cast("int") + 1, F.lit(1))


def _same_format(value: Column, stream: Column, keep: Column) -> Column:
    """Digits become digits and letters letters of the same case; the first ``keep`` characters and others stay."""

    def one(c: Column, i: Column) -> Column:
        return (
            F.when(i < keep, c)
            .when(c.rlike("[0-9]"), _nibble(stream, i, 10).cast("string"))
            .when(c.rlike("[a-z]"), _char("abcdefghijklmnopqrstuvwxyz", _nibble(stream, i, 26)))
            .when(c.rlike("[A-Z]"), _char("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _nibble(stream, i, 26)))
            .when(c.rlike(r"\p{IsCyrillic}"), _char("абвгдежзиклмнопрстуфхцчшэюя", _nibble(stream, i, 27)))
            .when(c.rlike(r"\p{IsGreek}"), _char("αβγδεζηθικλμνξοπρστυφχψω", _nibble(stream, i, 24)))
            .when(c.rlike(r"\p{L}"), _char("abcdefghijklmnopqrstuvwxyz", _nibble(stream, i, 26)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _number(value: Column, digits: Column) -> Column:
    """``value`` with its k-th digit replaced by the k-th of ``digits``: the format stays."""
    parts = F.split(value, r"\d")
    return F.concat(
        F.get(parts, F.lit(0)),
        F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), lambda p, i: F.concat(F.substring(digits, i + 1, F.lit(1)), p)), ""),
    )


def _luhn(body: Column) -> Column:
    """The check digit behind ``body``."""
    n = F.length(body)
    doubled = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.when(F.pmod(n - i, F.lit(2)) == 0, F.substring(body, i, F.lit(1)).cast("int") * 2).otherwise(F.substring(body, i, F.lit(1)).cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d))
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def _drawn(stream: Column, n: Column, start: int) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: _nibble(stream, i + start, 10).cast("string")), "")


def surrogate(value: Column, attempt: Column, secret: str) -> Column:
    """The replacement of one found text: same kind, format, script and gender, from the key alone.

    E-mail addresses keep their last label, phone numbers their country code, card numbers
    the first digit and a right check digit; addresses have octets of the same width. Names keep
    their title; each part is drawn in its own script from the part itself, so that a family name stays one. Names get a
    syllable more with each attempt; from attempt ``OWN_FORMAT`` on, e-mail addresses get a letter more
    with each, and octets have any width, so that a format's values never bound the corpus.
    """
    kind = kind_of(value)
    of = canonical(kind, value)
    # Handed on as the element of an array, so that each is computed once and not for every character made.
    given = F.struct(value.alias("value"), kind.alias("kind"), of.alias("of"), _stream(secret, kind, of, attempt).alias("stream"))
    return F.get(F.transform(F.array(given), lambda g: _made(g["value"], g["kind"], g["of"], g["stream"], attempt, secret)), F.lit(0))


def _made(value: Column, kind: Column, of: Column, stream: Column, attempt: Column, secret: str) -> Column:
    tail = F.regexp_extract(value, r"(\.[\w-]+)$", 1)
    body = F.substring(value, F.lit(1), F.length(value) - F.length(tail))
    more = F.greatest(attempt - (OWN_FORMAT - 1), F.lit(0))
    letters = F.array_join(F.transform(F.slice(F.sequence(F.lit(0), more), 2, more), lambda i: _char("abcdefghijklmnopqrstuvwxyz", _nibble(stream, 31 - i, 26))), "")
    email = F.concat(letters, _same_format(F.when(kind == "email", body).otherwise(""), stream, F.lit(0)), tail)
    hexes = F.array_join(
        F.transform(F.split(F.when(kind == "secret", value).otherwise(""), ""), lambda c, i: F.when(c == "", "").otherwise(_char("0123456789abcdef", _nibble(stream, i, 16)))), ""
    )

    def octet(part: Column, i: Column) -> Column:
        width = F.length(part)
        n = F.conv(F.substring(stream, i * 8 + 1, F.lit(7)), 16, 10).cast("long")
        wide = F.when(attempt >= OWN_FORMAT, F.pmod(n, F.lit(254)) + 1)
        return wide.when(width == 1, F.pmod(n, F.lit(9)) + 1).when(width == 2, F.pmod(n, F.lit(90)) + 10).otherwise(F.pmod(n, F.lit(155)) + 100).cast("string")

    ip = F.array_join(F.transform(F.split(F.when(kind == "ip", value).otherwise("1.1.1.1"), r"\."), octet), ".")
    digits = F.when(kind.isin("card", "phone"), of).otherwise("0000000000000")
    start = F.concat(F.substring(digits, 1, 1), _drawn(stream, F.length(digits) - 2, 0))
    card = _number(value, F.concat(start, _luhn(start)))
    code = F.length(F.regexp_replace(F.regexp_extract(value, r"^(\+\d{1,3}(?=\D)|)", 1), r"\D", ""))
    phone = _number(value, F.concat(F.substring(digits, F.lit(1), code), _drawn(stream, F.length(digits), 0)))
    title = F.regexp_extract(value, r"^(\S+ )", 1)
    bare = F.regexp_replace(title, r"[. ]", "")
    gender = F.when(bare.isin(*FEMALE), "f").otherwise("m")
    two = value.rlike(r" \S+ ")

    scripts = {"Latin": LATIN, "Cyrillic": CYRILLIC, "Greek": GREEK, "Armenian": ARMENIAN}

    def by_script(part: Column, given: dict[str, Column]) -> Column:
        choice = F.when(part.rlike(r"\p{IsCyrillic}"), given["Cyrillic"]).when(part.rlike(r"\p{IsGreek}"), given["Greek"])
        return choice.when(part.rlike(r"\p{IsArmenian}"), given["Armenian"]).otherwise(given["Latin"])

    def prepared(part: Column) -> Column:
        syllables = by_script(part, {s: F.array(*[F.lit(x) for x in given]) for s, given in scripts.items()})
        end = by_script(part, {s: F.when(gender == "f", F.lit(f)).otherwise(F.lit(m)) for s, (m, f) in ENDS.items()})
        return F.struct(_stream(secret, F.lit("part"), F.lower(part), attempt).alias("own"), syllables.alias("syllables"), end.alias("end"))

    def drawn_name(part: Column, i: Column) -> Column:
        drawn = F.transform(F.sequence(F.lit(0), attempt + 3), lambda k: F.get(part["syllables"], _nibble(part["own"], k, 16)))
        # The gender shows in a given name: the first of two parts.
        return F.initcap(F.concat(F.array_join(drawn, ""), F.when((i == 0) & two, part["end"]).otherwise("")))

    parts = F.transform(F.split(F.regexp_replace(value, r"^\S+ ", ""), " "), prepared)
    names = F.concat(title, F.array_join(F.transform(parts, drawn_name), " "))
    return (
        F.when(kind == "email", email).when(kind == "secret", hexes).when(kind == "ip", ip).when(kind == "card", card).when(kind == "name", names).otherwise(phone)
    )


def _repairs(found: DataFrame, secret: str) -> DataFrame:
    """``kind, entity, attempt`` of the entities whose first surrogate another entity has or takes.

    An entity's surrogate may be no other entity's, and no entity of the corpus itself. Of those
    that want one surrogate the least keeps it, and the others draw again, until none is left.
    """
    # A number of partitions is kept as it is given; few bytes, but hashes to draw for each row.
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = found.repartition(tasks, "kind", "entity").groupBy("kind", "entity").agg(F.min("value").alias("value"))
    settled = None
    pending = values.withColumn("attempt", F.lit(0))
    known = values.select("kind", F.col("entity").alias("taken"))
    repaired = None
    for turn in range(ROUNDS):
        drawn = surrogate(F.col("value"), F.col("attempt"), secret)
        wanted = saved(pending.withColumn("taken", canonical(F.col("kind"), drawn)), "wanted")
        least = wanted.groupBy("kind", "taken").agg(F.min("entity").alias("keeper"))
        least = least.join(known.distinct(), ["kind", "taken"], "left_anti")
        # Only the keeper of a free surrogate has its row here, so no two rows meet.
        good = wanted.join(least.select("kind", F.col("taken"), F.col("keeper").alias("entity")), ["kind", "taken", "entity"], "left_semi")
        good = saved(good, "settled")
        settled = good if settled is None else settled.unionByName(good)
        if turn:
            fixed = good.select("kind", "entity", "attempt")
            repaired = fixed if repaired is None else repaired.unionByName(fixed)
        pending = saved(wanted.join(good, ["kind", "entity"], "left_anti").select("kind", "entity", "value", (F.col("attempt") + 1).alias("attempt")), "pending")
        if pending.isEmpty():
            return repaired if repaired is not None else pending.select("kind", "entity", "attempt")
        known = values.select("kind", F.col("entity").alias("taken")).unionByName(settled.select("kind", "taken"))
    raise ValueError("surrogates still collide; the formats of some entities leave too few values")


def replace_entities(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, n_entities, kinds``: every row of ``docs`` with all entities replaced.

    Surrogates depend on the key and the entity only, so one entity has one surrogate in the whole
    corpus and two entities have two; all that is not an entity stays as it is. ``kinds`` lists the
    kinds found, in order. NULL texts stay NULL. Repeated rows and NULL ids are treated alike. An
    empty table gives an empty result; a text of any length is one value, read by one pattern.
    """
    rows = docs.select(column(docs, key).alias("doc_id"), column(docs, text).alias("text"))
    matched = rows.withColumn("found", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    value = F.col("value")
    # One row per entity and spelling of a task's documents, so a frequent entity is small before any shuffle.
    found = matched.select(F.explode("found").alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    found = found.select("value", kind_of(value).alias("kind"), canonical(kind_of(value), value).alias("entity"))
    repairs = _repairs(saved(found, "entities"), secret)
    if repairs.isEmpty():
        matched = matched.withColumn("again", F.lit(None).cast("map<string,int>"))
    else:
        repairs = saved(repairs, "repairs")
        held = matched.select("doc_id", F.xxhash64("text").alias("version"), F.explode("found").alias("value")).distinct()
        held = held.withColumn("kind", kind_of(value)).withColumn("entity", canonical(F.col("kind"), value)).join(repairs, ["kind", "entity"])
        held = held.groupBy("doc_id", "version").agg(F.map_from_entries(F.collect_list(F.struct("value", "attempt"))).alias("again"))
        held = saved(held.select(F.col("doc_id").alias("held_id"), "version", "again"), "held")
        matched = matched.join(held, F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.xxhash64("text") == F.col("version")), "left")
    attempt = lambda v: F.coalesce(F.try_element_at(F.col("again"), v), F.lit(0))
    pieces = F.split("text", ANY)
    made = F.concat(F.transform("found", lambda v: surrogate(v, attempt(v), secret)), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(pieces, made, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
    return matched.select(
        "doc_id",
        F.when(F.size("found") > 0, whole).otherwise(F.col("text")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("found")).alias("n_entities"),
        F.transform("found", lambda v: kind_of(v)).alias("kinds"),
    )
