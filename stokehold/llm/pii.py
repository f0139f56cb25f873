"""Personal data replaced by format-preserving Feistel pseudonyms.

A value that passes its check is permuted within its own format by a keyed
Feistel network: card numbers (Luhn) to card numbers, phone numbers, IPv4
addresses, social security numbers, IBANs (mod 97) and calendar dates to others of the same
form, and likewise the letters among letters and digits among digits of an e-mail
address's local part and of hexadecimal keys after ``password`` or ``token``. It is a permutation:
equal values get equal pseudonyms in every document, different ones stay
different, and whoever holds the key can undo it (``restore``). Values
that fail their check are left alone, and so is all other text.

Round function: SHA-256 of key, kind, length, round and half. Everything is
an SQL expression over one row, so nothing is shuffled.

Null texts stay null; texts without a value are unchanged; rows, ties,
repeats and other columns (whatever their names) are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Kinds in the order in which they are tried; none begins or ends inside a longer word or number.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)",
    "date": r"(?<![\d/.-])(?:(?:1[89]|2[01])\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([/.])(?:0[1-9]|1[0-2])\2(?:1[89]|2[01])\d\d)(?![\d/-])",
    "ssn": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,4}|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\d)",
    "key": r"(?<=(?:password|token)(?:=| = |: )\"?)[0-9A-Fa-f]{8,}(?![0-9A-Za-z])",
}
#: One expression for all kinds; the group of the date's separator is the second.
ANY = "(" + "|".join(PATTERNS.values()) + ")"
#: Texts without any of these hold no value.
HINT = r"[0-9@]|password|token"

#: Days of a Gregorian cycle of 400 years, as two factors.
FIRST_DAY, DAYS, DAY_A, DAY_B = "1800-01-01", 146097, 189, 773


#: Digits of half a stretch that fit 63 bits, by radix: digits, hexadecimal letters, letters.
HALF = {10: 18, 6: 24, 26: 13}
#: Digits of each radix as they stand in texts, and as ``conv`` wants them.
SHOWN = {10: "0123456789", 6: "abcdef", 26: "abcdefghijklmnopqrstuvwxyz"}


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _power(radix: int, n: Column) -> Column:
    """radix ** n for 0 <= n, exact."""
    return F.element_at(F.array(*[F.lit(radix ** k).cast("long") for k in range(HALF[radix] + 1)]), n + 1)


def _feistel(left: Column, right: Column, a: Column, b: Column, tweak: Column, back: bool) -> Column:
    """Struct (l, r): the keyed permutation of left < a, right < b."""
    def value(r: Column, half: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", tweak, r.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def add(x: Column, y: Column, m: Column) -> Column:
        y = F.pmod(y, m)
        return F.pmod(x - y, m) if back else F.pmod(x + (y - m), m)  # no sum beyond 63 bits

    def step(s: Column, k: Column) -> Column:
        r = F.lit(ROUNDS - 1) - k if back else k
        even = r % 2 == 0
        return F.struct(F.when(even, add(s["l"], value(r, s["r"]), a)).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(add(s["r"], value(r, s["l"]), b)).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _number(digits: Column, radix: int) -> Column:
    plain = F.translate(digits, SHOWN[radix], "0123456789abcdefghijklmnop"[:radix])
    return F.coalesce(F.conv(F.when(digits != "", plain), radix, 10).cast("long"), F.lit(0).cast("long"))


def _digits(number: Column, radix: int, n: Column) -> Column:
    """``number`` with exactly ``n`` digits."""
    text = F.lower(F.conv(number.cast("string"), 10, radix))
    filled = F.when(n == 0, F.lit("")).otherwise(F.concat(F.repeat(F.lit("0"), n - F.length(text)), text))
    return F.translate(filled, "0123456789abcdefghijklmnop"[:radix], SHOWN[radix])


def _permuted(digits: Column, radix: int, tweak: Column, back: bool) -> Column:
    """Digits of any length, permuted in stretches of two halves that fit 63 bits."""
    def stretch(x: Column, k: Column, size: Column) -> Column:
        n = F.length(x)
        a = F.floor(n / 2).cast("int")
        b = n - a
        label = F.concat_ws("|", tweak, size.cast("string"), k.cast("string"))
        s = _feistel(_number(F.substr(x, F.lit(1), a), radix), _number(F.substr(x, a + 1, b), radix), _power(radix, a), _power(radix, b), label, back)
        return _let(s, lambda p: F.concat(_digits(p["l"], radix, a), _digits(p["r"], radix, b)))

    return _let(digits, lambda d: F.array_join(
        F.transform(F.regexp_extract_all(d, F.lit(f"[\\s\\S]{{1,{2 * HALF[radix]}}}"), F.lit(0)), lambda x, k: stretch(x, k, F.length(d))), ""))


def _refill(value: Column, digits: Column, kind: str) -> Column:
    """``value`` with the characters of a class replaced in turn, upper case kept."""
    def fill(new: Column) -> Column:
        def char(i: Column) -> Column:
            c = F.substr(value, i, F.lit(1))
            before = F.length(F.regexp_replace(F.substr(value, F.lit(1), i), f"[^{kind}]", ""))
            x = F.substr(new, before, F.lit(1))
            return F.when(~c.rlike(f"[{kind}]"), c).when(c.rlike("[A-Z]"), F.upper(x)).otherwise(x)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")

    return _let(digits, fill)


def _chars(value: Column, kind: str) -> Column:
    return F.lower(F.regexp_replace(value, f"[^{kind}]", ""))


def _luhn(body: Column) -> Column:
    """Check digit of the digits ``body``."""
    n = F.length(body)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(body, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.pmod(F.lit(0) - F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add), F.lit(10)).cast("string")


def _mod97(text: Column) -> Column:
    """Remainder of letters (A = 10) and digits read as one number."""
    def add(total: Column, c: Column) -> Column:
        v = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (total * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), lambda t, c: F.when(c == "", t).otherwise(add(t, c)))


def _card(m: Column, key: Column, back: bool) -> Column:
    digits = _chars(m, "0-9")
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    valid = _luhn(body) == F.right(digits, F.lit(1))
    new = _let(_permuted(body, 10, F.concat(key, F.lit("|card")), back), lambda b: F.concat(b, _luhn(b)))
    return F.when(valid, _refill(m, new, "0-9")).otherwise(m)


def _phone(m: Column, key: Column, back: bool) -> Column:
    code = F.regexp_extract(m, r"^\+\d{1,3}?(?=[ .(-]|\d{7,})", 0)
    rest = F.substr(m, F.length(code) + 1, F.length(m))
    new = _permuted(_chars(rest, "0-9"), 10, F.concat(key, F.lit("|phone|"), code), back)
    return F.concat(code, _refill(rest, new, "0-9"))


def _ip(m: Column, key: Column, back: bool) -> Column:
    part = F.split(m, r"\.")
    at = lambda k: F.element_at(part, k).cast("long")
    full = F.lit(65536).cast("long")
    s = _feistel(at(1) * 256 + at(2), at(3) * 256 + at(4), full, full, F.concat(key, F.lit("|ip")), back)
    return _let(s, lambda p: F.concat_ws(".", F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256))


def _date(m: Column, key: Column, back: bool) -> Column:
    iso = m.rlike(r"^\d{4}")
    y = F.when(iso, F.substr(m, F.lit(1), F.lit(4))).otherwise(F.substr(m, F.lit(7), F.lit(4))).cast("int")
    mo = F.when(iso, F.substr(m, F.lit(6), F.lit(2))).otherwise(F.substr(m, F.lit(4), F.lit(2))).cast("int")
    d = F.when(iso, F.substr(m, F.lit(9), F.lit(2))).otherwise(F.substr(m, F.lit(1), F.lit(2))).cast("int")
    month = F.make_date(y, mo, F.lit(1))
    # a day the month doesn't have isn't a date
    valid = d <= F.dayofmonth(F.last_day(month))
    first = F.to_date(F.lit(FIRST_DAY))
    n = F.datediff(month, first) + d - 1
    s = _feistel(F.floor(n / DAY_B), n % DAY_B, F.lit(DAY_A).cast("long"), F.lit(DAY_B).cast("long"), F.concat(key, F.lit("|date")), back)
    day = _let(s, lambda p: F.date_add(first, (p["l"] * DAY_B + p["r"]).cast("int")))
    sep = F.substr(m, F.lit(3), F.lit(1))
    shown = _let(day, lambda x: F.when(iso, F.date_format(x, "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format(x, "dd"), sep, F.date_format(x, "MM"), sep, F.date_format(x, "yyyy"))))
    return F.when(valid & n.between(0, DAYS - 1), shown).otherwise(m)


def _iban(m: Column, key: Column, back: bool) -> Column:
    flat = F.regexp_replace(m, " ", "")
    body = F.substr(flat, F.lit(5), F.length(flat))
    land = F.substr(flat, F.lit(1), F.lit(2))
    valid = _mod97(F.concat(body, F.substr(flat, F.lit(1), F.lit(4)))) == 1
    digits = _chars(body, "0-9")
    new = _refill(body, _permuted(digits, 10, F.concat(key, F.lit("|iban|"), land, F.regexp_replace(body, "[0-9]", "0")), back), "0-9")
    rest = F.substr(m, F.lit(3), F.length(m))

    def spaced(full: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(rest)), lambda i: F.when(F.substr(rest, i, F.lit(1)) == " ", F.lit(" ")).otherwise(
            F.substr(full, F.length(F.regexp_replace(F.substr(rest, F.lit(1), i), " ", "")), F.lit(1)))), "")

    full = _let(new, lambda b: F.concat(F.lpad((98 - _mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), b))
    return F.when(valid & (digits != ""), F.concat(land, _let(full, spaced))).otherwise(m)


def _ssn(m: Column, key: Column, back: bool) -> Column:
    # areas 001-899 but 666, groups 01-99, serials 0001-9999: the numbers that PATTERNS takes, and no others
    area = F.substr(m, F.lit(1), F.lit(3)).cast("long")
    left = area - F.when(area > 666, 2).otherwise(1)
    right = (F.substr(m, F.lit(5), F.lit(2)).cast("long") - 1) * 9999 + F.substr(m, F.lit(8), F.lit(4)).cast("long") - 1
    s = _feistel(left, right, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), F.concat(key, F.lit("|ssn")), back)

    def shown(p: Column) -> Column:
        return F.concat_ws("-", F.lpad((p["l"] + F.when(p["l"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                           F.lpad((F.floor(p["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((p["r"] % 9999 + 1).cast("string"), 4, "0"))

    return _let(s, shown)


def _mixed(m: Column, key: Column, back: bool, radix: int, letters: str) -> Column:
    """Letters permuted among letters and digits among digits, case and places kept."""
    digits = _refill(m, _permuted(_chars(m, "0-9"), 10, F.concat(key, F.lit("|digits")), back), "0-9")
    return _let(digits, lambda d: _refill(d, _permuted(_chars(d, letters), radix, F.concat(key, F.lit("|letters")), back), letters))


def _email(m: Column, key: Column, back: bool) -> Column:
    at = F.instr(m, "@")
    local, domain = F.substr(m, F.lit(1), at - 1), F.substr(m, at, F.length(m))
    return F.concat(_mixed(local, F.concat(key, F.lit("|email|"), F.lower(domain)), back, 26, "A-Za-z"), domain)


def _key(m: Column, key: Column, back: bool) -> Column:
    return _mixed(m, F.concat(key, F.lit("|key")), back, 6, "A-Fa-f")


_KINDS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "iban": _iban, "card": _card, "key": _key}

#: What tells the kind of a match of ANY (its surroundings are checked already), in the same order.
_SHAPES = {"email": "@", "ip": r"^\d{1,3}(?:\.\d{1,3}){3}$", "date": r"^(?:\d{4}-\d\d-\d\d|\d\d([/.])\d\d\1\d{4})$", "ssn": r"^\d{3}-\d\d-\d{4}$", "phone": r"^\+",
           "iban": r"^[A-Z]{2}\d\d", "card": r"^\d{4}[\d -]{9,18}$", "key": r"^[0-9A-Fa-f]+$"}


def _kind(m: Column) -> Column:
    out = F.lit(None).cast("string")
    for name in reversed(_SHAPES):
        out = F.when(m.rlike(_SHAPES[name]), F.lit(name)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found: str | None = None, back: bool = False) -> DataFrame:
    """``docs`` with every value in the text replaced; ``found`` names an extra
    column with the replaced values' kind and pseudonym, in text order."""
    name = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    text = F.col(name[text_col])
    secret = F.lit(key)
    rows = docs.toDF(*[name[c] for c in docs.columns])
    some = text.rlike(HINT)
    rows = rows.withColumn("_m", F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    rows = rows.withColumn("_v", F.when(F.size("_m") > 0, F.transform("_m", lambda m: F.struct(m.alias("m"), _kind(m).alias("k")))))
    # kinds are told apart before the permutations, each of which runs only for its own values
    def replaced(v: Column) -> Column:
        out = v["m"]
        for kind, permute in reversed(_KINDS.items()):
            out = F.when(v["k"] == kind, permute(v["m"], secret, back)).otherwise(out)
        return out

    rows = rows.withColumn("_r", F.when(F.col("_v").isNotNull(), F.transform("_v", lambda v: F.struct(v["m"].alias("m"), v["k"].alias("k"), replaced(v).alias("n")))))
    parts = F.split(text, ANY, -1)
    new = F.array_join(F.zip_with(parts, F.col("_r"), lambda p, r: F.concat(p, F.coalesce(r["n"], F.lit("")))), "")
    done = rows.withColumn("_t", F.when(F.col("_r").isNotNull(), new).otherwise(text))
    hits = F.transform(F.filter(F.coalesce(F.col("_r"), F.array()), lambda r: r["m"] != r["n"]), lambda r: F.struct(r["k"].alias("kind"), r["n"].alias("pseudonym")))
    return done.select(*[(F.col("_t") if c == text_col else F.col(name[c])).alias(c) for c in docs.columns], *([hits.alias(found)] if found else []))


def restore(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The inverse of ``pseudonymise`` under the same key, for whoever holds it."""
    return pseudonymise(docs, key, text_col, back=True)
