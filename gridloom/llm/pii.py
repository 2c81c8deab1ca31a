"""Format-preserving pseudonyms by keyed Feistel permutations; DataFrame functions only.

Values are found by one pattern, validated by kind, and turned to a vector of digits of given radices.
A Feistel network adds to one half of the vector what a keyed hash makes of the other, in turns, which
permutes the values of a format: equal values get equal pseudonyms in all documents, different ones
different. Check digits are computed again. What fails validation stays as it is; but where an IBAN or card has
swallowed what stands beside it, the longest valid part between separators is taken, and the search goes on behind it.

    email    letters and digits up to the last dot, each within its own alphabet; up to 64 characters before the @, 254 in all, no two dots together
    ip       IPv4 octets up to 255
    phone    digits behind the country code; three groups (3, 3, 4) with a bracket, dot or hyphen, or with spaces where the area
             begins with 2 to 9, or an international number of 8 to 15 digits that begins with + and its country code
    date     days from 1900-01-01 to 2101-11-10, in the same notation: ISO, day first with dots, month first with slashes, and
             with slashes day first where that alone is a date; those stay among themselves, as days from the 13th on
    ssn      area, group and serial within their valid ranges
    iban     country stays, check digits computed again (ISO 7064 mod 97)
    card     13 to 19 digits with a valid Luhn digit, which is computed again; dots part groups of four only
    secret   32 to 64 hexadecimal digits, letters and decimal digits among them
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

ROUNDS = 10

#: The key is a secret of the deployment; this one serves tests and the registered query.
KEY = "gridloom"

PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "phone": r"(?<!\d)(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}|\+[1-9]\d{0,2}(?:[ .-]?(?:\(\d{1,4}\)|\d{1,4})){2,6}|(?<!\d[ .-])[2-9]\d{2} \d{3} \d{4}(?![ .-]\d))(?!\d)",
    "date": r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{2}([./])\d{2}\1\d{4})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])",
    "card": r"(?<!\d)(?:\d(?:[ -]?\d){12,18}|(?<!\d\.)\d{4}(?:\.\d{4}){3}(?!\.\d))(?!\d)",
}
KINDS = list(PATTERNS)

#: Groups in which a card inside a longer run of digits is written, at most; fewest characters of an IBAN or card.
CARD_GROUPS, LEAST = 5, 13

#: Alphabets within which a character stays.
DIGITS = "0123456789"
ALPHABETS = [DIGITS, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"]
HEX = ["0123456789abcdef", "0123456789ABCDEF"]

#: 256 * 288 days from this one on.
DAY_ONE, DAYS = "1900-01-01", (256, 288)

#: Turns in which a walk over days meets one after the 12th: each does with odds of 3 to 2, so that one walk in 10^26 is cut.
WALK = 64


def any_pattern() -> str:
    """All kinds in one pattern; the back reference counts its own group."""
    return "|".join(p.replace("([./])", "(?<sep>[./])").replace(r"\1", r"\k<sep>") for p in PATTERNS.values())


def feistel(left: Column, right: Column, left_radix: Column, right_radix: Column, kind: str, key: str) -> Column:
    """Struct (a, b) of the permuted halves: arrays of longs, each below its radix."""

    def moved(half: Column, radix: Column, other: Column, turn: Column) -> Column:
        seed = F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), F.array_join(other.cast("array<string>"), ","), F.lit("|"))

        def add(x: Column, i: Column) -> Column:
            word = F.conv(F.substring(F.sha2(F.concat(seed, i.cast("string")), 256), 1, 12), 16, 10).cast("long")
            return (x + word) % F.element_at(radix, i + 1)

        return F.transform(half, add)

    def turn(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        a = F.when(even, moved(acc.a, left_radix, acc.b, i)).otherwise(acc.a)
        b = F.when(even, acc.b).otherwise(moved(acc.b, right_radix, acc.a, i))
        return F.struct(a.alias("a"), b.alias("b"))

    start = F.struct(left.cast("array<bigint>").alias("a"), right.cast("array<bigint>").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def permuted(text: Column, alphabets: list[str], kind: str, key: str) -> Column:
    """The text with each character of an alphabet permuted within it; other characters stay."""
    def radix(c: Column) -> Column:
        out = F.lit(1)
        for a in alphabets:
            out = F.when(F.contains(F.lit(a), c), F.lit(len(a))).otherwise(out)
        return out.cast("long")

    def value(c: Column) -> Column:
        out = F.lit(0)
        for a in alphabets:
            out = F.when(F.contains(F.lit(a), c), F.position(c, F.lit(a)) - 1).otherwise(out)
        return out.cast("long")

    def shown(c: Column, v: Column) -> Column:
        out = c
        for a in alphabets:
            out = F.when(F.contains(F.lit(a), c), F.substr(F.lit(a), (v + 1).cast("int"), F.lit(1))).otherwise(out)
        return out

    def run(chars: Column) -> Column:
        n = F.size(chars)
        values, radices = F.transform(chars, value), F.transform(chars, radix)
        half = F.ceil(n / 2).cast("int")

        def done(p: Column) -> Column:
            return F.array_join(F.zip_with(chars, F.concat(p.a, p.b), shown), "")

        cut = lambda x: (F.slice(x, F.lit(1), half), F.slice(x, half + 1, n - half))
        (a, b), (ra, rb) = cut(values), cut(radices)
        return _let(feistel(a, b, ra, rb, kind, key), done)

    return _let(F.filter(F.split(text, ""), lambda c: c != ""), run)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits of which the last one counts once."""

    def part(d: Column, i: Column) -> Column:
        twice = d.cast("int") * (i % 2 + 1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    values = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), part)
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def mod97(text: Column) -> Column:
    """Remainder by 97 of letters and digits read as a number, A being 10."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    value = lambda c: F.position(c, F.lit(DIGITS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) - 1
    return F.aggregate(chars, F.lit(0).cast("int"), lambda a, c: ((a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97).cast("int"))


def _slashed(m: Column, day: int, month: int) -> Column:
    return F.when(m.substr(3, 1) == "/", F.concat_ws("-", m.substr(7, 4), m.substr(month, 2), m.substr(day, 2))).try_cast("date")


def _day_first(m: Column) -> Column:
    """Whether a slashed match is a date only if the day stands first."""
    return _slashed(m, 4, 1).isNull() & _slashed(m, 1, 4).isNotNull()


def _day(m: Column) -> Column:
    """The date that a match notes, null if there is none: ISO, day first with dots, month first with slashes, else day first."""
    iso = F.when(m.substr(5, 1) == "-", m).try_cast("date")
    dots = F.when(m.substr(3, 1) == ".", F.concat_ws("-", m.substr(7, 4), m.substr(4, 2), m.substr(1, 2))).try_cast("date")
    return F.coalesce(iso, dots, _slashed(m, 4, 1), _slashed(m, 1, 4))


def _count(m: Column) -> Column:
    return F.datediff(_day(m), F.lit(DAY_ONE).cast("date"))


def _octets(m: Column) -> Column:
    return F.split(m, r"\.").cast("array<bigint>")


def _ssn(m: Column) -> tuple[Column, Column, Column]:
    return tuple(x.cast("long") for x in (m.substr(1, 3), m.substr(5, 2), m.substr(8, 4)))


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(_octets(m), lambda x: x <= 255)
    if kind == "date":
        return F.coalesce(_count(m).between(0, DAYS[0] * DAYS[1] - 1), F.lit(False))
    if kind == "ssn":
        area, group, serial = _ssn(m)
        return (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    if kind == "iban":
        flat = F.regexp_replace(m, " ", "")
        return F.length(flat).between(15, 34) & (mod97(F.concat(F.substring(flat, 5, 40), F.substring(flat, 1, 4))) == 1)
    if kind == "card":
        return (luhn_sum(_digits(m)) % 10 == 0) & (F.regexp_replace(m, "[0 .-]", "") != "")
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15) & ~F.rlike(_digits(m), F.lit(r"^(\d)\1*$"))
    if kind == "email":
        return (F.length(m) <= 254) & (F.position(F.lit("@"), m) <= 65) & ~F.contains(m, F.lit(".."))
    return F.rlike(m, F.lit("[0-9]")) & F.rlike(m, F.lit("[A-Fa-f]"))  # secret


def pseudonym(kind: str, m: Column, key: str) -> Column:
    longs = lambda *x: F.array(*[F.lit(v).cast("long") for v in x])
    if kind == "email":
        head = F.regexp_extract(m, r"^(.*)\.[^.]*$", 1)
        return F.concat(permuted(head, ALPHABETS, kind, key), F.regexp_extract(m, r"\.[^.]*$", 0))
    if kind == "ip":
        o = _octets(m)
        p = feistel(F.slice(o, 1, 2), F.slice(o, 3, 2), longs(256, 256), longs(256, 256), kind, key)
        return _let(p, lambda p: F.array_join(F.concat(p.a, p.b).cast("array<string>"), "."))
    if kind == "phone":
        code = F.regexp_extract(m, r"^(?:\+\d{1,3}[ .-]?)?", 0)
        return F.concat(code, permuted(F.substr(m, F.length(code) + 1), [DIGITS], kind, key))
    if kind == "date":
        day_one, first = F.lit(DAY_ONE).cast("date"), _day_first(m)

        def turned(n: Column) -> Column:
            p = feistel(F.array(F.floor(n / DAYS[1])), F.array(n % DAYS[1]), longs(DAYS[0]), longs(DAYS[1]), kind, key)
            return _let(p, lambda p: p.a[0] * DAYS[1] + p.b[0])

        def among(n: Column) -> Column:
            """Turned until the day is one of those that can only stand first: a walk on a cycle, which comes back to one."""
            out = lambda k: F.dayofmonth(F.date_add(day_one, k.cast("int"))) > 12
            return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), n, lambda k, _: F.when(out(k), k).otherwise(turned(k)))

        def shown(n: Column) -> Column:
            day = F.date_add(day_one, n.cast("int"))
            dmy = F.when(first, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "MM/dd/yyyy"))
            return F.when(m.substr(5, 1) == "-", F.date_format(day, "yyyy-MM-dd")).when(m.substr(3, 1) == ".", F.date_format(day, "dd.MM.yyyy")).otherwise(dmy)

        return _let(turned(_count(m).cast("long")), lambda n: _let(F.when(first, among(n)).otherwise(n), shown))
    if kind == "ssn":
        area, group, serial = _ssn(m)
        index = area - F.when(area > 666, 2).otherwise(1)
        p = feistel(F.array(index), F.array(group - 1, serial - 1), longs(898), longs(99, 9999), kind, key)

        def shown(p: Column) -> Column:
            area = p.a[0] + F.when(p.a[0] >= 665, 2).otherwise(1)
            return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((p.b[0] + 1).cast("string"), 2, "0"), F.lpad((p.b[1] + 1).cast("string"), 4, "0"))

        return _let(p, shown)
    if kind == "iban":
        body = permuted(F.substring(m, 5, 60), ALPHABETS[:3], kind, key)

        def checked(body: Column) -> Column:
            country = F.substring(m, 1, 2)
            rest = 98 - mod97(F.concat(F.regexp_replace(body, " ", ""), country, F.lit("00")))
            return F.concat(country, F.lpad(rest.cast("string"), 2, "0"), body)

        return _let(body, checked)
    if kind == "secret":
        small = F.rlike(m, F.lit("[a-f]"))
        return F.when(small, permuted(m, HEX[:1], kind, key)).otherwise(permuted(m, HEX[1:], kind, key))
    body = permuted(F.substr(m, F.lit(1), F.length(m) - 1), [DIGITS], kind, key)
    return _let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(_digits(b), F.lit("0"))) % 10) % 10).cast("string")))


def _kind(m: Column) -> Column:
    """The kind of a match, null if it doesn't validate."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        whole = "^(?:" + PATTERNS[kind] + ")$"
        out = F.when(F.rlike(m, F.lit(whole)), F.when(valid(kind, m), F.lit(kind))).otherwise(out)
    return out


def _inside(m: Column) -> Column:
    """Struct (before, value) of the first longest valid part of an IBAN or card match that fails as a whole, null if there is none.

    Parts begin and end at separators; a card's part has at most CARD_GROUPS of them.
    """
    whole = f"^(?:{PATTERNS['iban']}|{PATTERNS['card']})$"

    def spans(t: Column) -> Column:
        def start(i: Column) -> Column:
            def part(n: Column) -> Column:
                raw = F.array_join(F.slice(t, i + 1, n), "")
                value = F.regexp_replace(raw, "^[ -]", "")
                before = F.concat(F.array_join(F.slice(t, F.lit(1), i), ""), F.regexp_extract(raw, "^[ -]?", 0))
                few = (n <= CARD_GROUPS) | F.rlike(value, F.lit("^[A-Z]"))
                return F.struct(before.alias("before"), F.when(few & F.rlike(value, F.lit(whole)), value).alias("value"))

            return F.transform(F.sequence(F.size(t) - i, F.lit(1), F.lit(-1)), part)

        every = F.flatten(F.transform(F.sequence(F.lit(0), F.size(t) - 1), start))
        return F.get(F.filter(every, lambda x: x.value.isNotNull() & _kind(x.value).isNotNull()), F.lit(0))

    tokens = F.regexp_extract_all(m, F.lit("[ -]?[^ -]+"), F.lit(0))
    return F.when(F.rlike(m, F.lit(whole)) & F.rlike(m, F.lit("[ -]")) & _kind(m).isNull(), _let(tokens, spans))


def segments(text: Column, pattern: str) -> Column:
    """The text in parts, to be searched each for itself: each valid value inside a failing match is a part of its own."""

    def step(acc: Column, _: Column) -> Column:
        def cut(found: Column) -> Column:
            def at(x: Column) -> Column:
                i = F.get(F.filter(F.sequence(F.lit(0), F.size(x)), lambda k: (k == F.size(x)) | F.get(x, k).isNotNull()), F.lit(0))

                def parts(i: Column) -> Column:
                    between = F.slice(F.split(acc.rest, pattern, -1), F.lit(1), i + 1)
                    values = F.concat(F.slice(found, F.lit(1), i), F.array(F.lit("")))
                    head = F.array_join(F.zip_with(between, values, lambda a, b: F.concat(a, b)), "")
                    return _let(F.struct(F.concat(head, F.get(x, i).before).alias("head"), F.get(x, i).value.alias("value")), rest)

                def rest(y: Column) -> Column:
                    behind = F.substr(acc.rest, F.length(y.head) + F.length(y.value) + 1)
                    return F.struct(F.concat(acc.done, F.array(y.head, y.value)).alias("done"), behind.alias("rest"), F.lit(True).alias("more"))

                stop = F.struct(acc.done.alias("done"), acc.rest.alias("rest"), F.lit(False).alias("more"))
                return _let(i, lambda i: F.when(i == F.size(x), stop).otherwise(parts(i)))

            return _let(F.transform(found, _inside), at)

        return F.when(acc.more, _let(F.regexp_extract_all(acc.rest, F.lit(pattern), F.lit(0)), cut)).otherwise(acc)

    start = F.struct(F.array().cast("array<string>").alias("done"), text.alias("rest"), F.lit(True).alias("more"))
    turns = F.sequence(F.lit(0), F.floor(F.length(text) / LEAST).cast("int"))
    return F.aggregate(turns, start, step, lambda acc: F.concat(acc.done, F.array(acc.rest)))


def _joined(a: Column, b: Column) -> Column:
    """Arrays of strings in a row, the last one of the first and the first one of the second made one."""
    n = F.size(a)
    seam = F.concat(F.element_at(a, -1), F.element_at(b, 1))
    return F.when(n == 0, b).otherwise(F.concat(F.slice(a, F.lit(1), n - 1), F.array(seam), F.slice(b, F.lit(2), F.size(b))))


def _replaced(m: Column, key: str) -> Column:
    def by_kind(kind: Column) -> Column:
        value = m
        for k in KINDS:
            value = F.when(kind == k, pseudonym(k, m, key)).otherwise(value)
        return F.struct(kind.alias("kind"), value.alias("value"))

    return _let(_kind(m), by_kind)


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda x: x.kind == kind


def pseudonymized(docs: DataFrame, key: str = KEY, column: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with the values in ``column`` replaced, and with n_<kind> columns (long) if asked for, in place of any so named.

    Null texts stay null with counts 0; other columns stay. Every row is handled by itself, so
    repeated rows come out alike, and an empty table stays empty.
    """
    text = F.col(column).cast("string")
    pattern = any_pattern()
    every = lambda x: F.regexp_extract_all(x, F.lit(pattern), F.lit(0))
    found = F.when(F.rlike(text, F.lit("[0-9@]|[A-Fa-f]{32}")), every(text))
    name, parts = "_found", "_parts"
    while {name, parts} & {c.lower() for c in docs.columns}:  # names are told apart without regard to case
        name, parts = name + "_", parts + "_"
    rows = docs.withColumn(name, F.coalesce(found, F.array().cast("array<string>")))
    rows = rows.withColumn(parts, F.when(F.exists(name, lambda m: _inside(m).isNotNull()), segments(text, pattern)))
    matches = F.when(F.col(parts).isNull(), F.col(name)).otherwise(F.flatten(F.transform(parts, every)))
    rows = rows.withColumn(name, F.transform(matches, lambda m: _replaced(m, key)))
    # what ends a part and what begins the next stand between the same two values
    joined = F.aggregate(F.transform(parts, lambda x: F.split(x, pattern, -1)), F.array().cast("array<string>"), _joined)
    between = F.when(F.col(parts).isNull(), F.split(text, pattern, -1)).otherwise(joined)
    values = F.concat(F.transform(name, lambda x: x.value), F.array(F.lit("")))
    new = F.when(F.size(name) > 0, F.array_join(F.zip_with(between, values, lambda a, b: F.concat(a, b)), "")).otherwise(text)
    out = rows.withColumn(column, new)
    if counts:
        out = out.withColumns({f"n_{k}": F.size(F.filter(name, _of(k))).cast("long") for k in KINDS})
    return out.drop(name, parts)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymized(documents(spark, sf_dir).select("doc_id", "text"))
