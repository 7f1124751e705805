"""Personal data as format-preserving pseudonyms, in SQL expressions only.

Numbers are found by pattern and validated (Luhn digits, IBAN remainders, number ranges, calendar
dates); what is valid is permuted by a keyed Feistel network within its own format and range. A
permutation keeps equal values equal and different values different, in every document and however they
are punctuated, and a pseudonym is valid where the value was. What isn't valid stays as it is. As any
permutation it may map a value to itself, the likelier the fewer values its format has.

* Cards, IBANs (digits; country, letters and check digits are kept or made right) and SSNs keep their shape.
* Dates keep which of three groups their day is in (to 12, to 28, beyond), so that a date written month
  first stays readable as such, and equal dates in different orders stay linked.
* Phone numbers keep their country code; a ten-digit number without one counts as code 1.
* E-mail addresses keep domain, length and the places of letters, digits and symbols of the name; letters
  and digits are permuted, in lower case. Domain names of more than 126 labels don't exist.

A network works on pairs (a, b) with a < A and b < B: rounds add a keyed hash of one half to the other,
modulo its range. So any range A * B is permuted exactly, without walking over values outside it.

Null texts stay null with no replacements; empty texts stay empty. Repeated rows get equal results. Very
long texts are searched whole: patterns repeat groups a bounded number of times, as Java's do so by
recursion. Where two formats fit at a place, the first in :data:`PATTERNS` counts. Other columns pass
through; the list of replacements takes a number after its name if a column has that name already. The
key must not be null; equal keys give equal pseudonyms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import free_name, let

ROUNDS = 8
#: Formats in the order in which they are tried at a place.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,126}[A-Za-z]{2,24}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"\+[0-9]{1,3}[ -]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ -]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
}
#: Lengths of IBANs by country; they end there, whatever word or number follows.
_IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_KNOWN_IBAN = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in _IBAN_LENGTHS.items())
_END = r"(?![A-Za-z0-9@]|[.-][0-9])"
#: Digits in groups, however many: the numbers in it are found by :func:`_numbers`.
_RUN = r"[0-9](?=(?:[ -]?[0-9]){12})[0-9 -]*[0-9](?!/[0-9])"
#: Cards as they are usually written: in one group, by fours, or 4-6-5 and 4-6-4.
_USUAL = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
#: A place begins after and ends before anything that would make it part of a longer word or number.
CANDIDATE = r"(?<![A-Za-z0-9+._%@-])(?:" + "|".join((PATTERNS | {"email": f"{PATTERNS['email']}|{_KNOWN_IBAN}", "card": _RUN}).values()) + f"){_END}"
#: Dates of these years are permuted, 205 years with 50 leap years.
_YEARS = (1900, 2104)
#: Sizes of the two halves, by the day's group: 205 * 12 * 12 days to the 12th, 205 * 12 * 16 to the 28th, 205 * 29 + 50 beyond.
_DAYS = ((164, 180), (192, 205), (55, 109))
#: Days beyond the 28th before each month, in a year that isn't a leap year.
_LATE = (0, 3, 3, 6, 8, 11, 13, 16, 19, 21, 24, 26)
#: Country codes of one and of two digits; all others have three.
_COUNTRY = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
_LETTERS, _BASE_26 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"


def _hash(key: Column, tweak: Column | str, i: Column, x: Column, modulus: Column) -> Column:
    """60 keyed bits modulo a range."""
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak
    digest = F.sha2(F.concat_ws("|", key, tweak, i.cast("string"), x.cast("string"), modulus.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), modulus)


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: Column, tweak: Column | str) -> Column:
    """struct(a long, b long): the keyed permutation of the pairs a < size_a, b < size_b."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(s["a"] + _hash(key, tweak, i, s["b"], size_a.cast("long")), size_a.cast("long"))).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(F.pmod(s["b"] + _hash(key, tweak, i, s["a"], size_b.cast("long")), size_b.cast("long"))).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permute_digits(digits: Column, key: Column, tweak: Column | str) -> Column:
    """A string of 1 to 36 digits as another of the same length."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k).cast("long")
    head, tail = F.substring(digits, F.lit(1), left), F.substring(digits, left + 1, n)
    # A string of odd length has the longer half on the right; both stay within a long.
    size_a, size_b = power(left), power(n - left)
    got = feistel(F.when(left == 0, 0).otherwise(head.try_cast("long")), tail.try_cast("long"), size_a, size_b, key, F.concat_ws(":", F.lit(tweak) if isinstance(tweak, str) else tweak, n.cast("string")))
    # One-element arrays keep the result from being computed for each half.
    joined = F.transform(F.array(got), lambda s: F.concat(F.when(left == 0, "").otherwise(F.lpad(s["a"].cast("string"), left, F.lit("0"))), F.lpad(s["b"].cast("string"), n - left, F.lit("0"))))
    return F.get(joined, F.lit(0))


def permute_letters(letters: Column, key: Column, tweak: Column | str) -> Column:
    """A string of 1 to 26 lower-case letters as another of the same length."""
    n = F.length(letters)
    left = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(26.0), k).cast("long")
    number = lambda t: F.conv(F.translate(t, _LETTERS, _BASE_26), 26, 10).try_cast("long")
    word = lambda x, k: F.lpad(F.translate(F.lower(F.conv(x.cast("string"), 10, 26)), _BASE_26, _LETTERS), k, F.lit("a"))
    got = feistel(F.when(left == 0, 0).otherwise(number(F.substring(letters, F.lit(1), left))), number(F.substring(letters, left + 1, n)), power(left), power(n - left), key, F.concat_ws(":", F.lit(tweak) if isinstance(tweak, str) else tweak, n.cast("string")))
    return let(got, lambda s: F.concat(F.when(left == 0, "").otherwise(word(s["a"], left)), word(s["b"], n - left)))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum; digits are doubled at every second place from the right, the last not."""
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, F.coalesce(c.try_cast("int"), F.lit(0))).otherwise(F.coalesce(c.try_cast("int"), F.lit(0)) * 2)),
        F.lit(0),
        lambda acc, x: acc + F.when(x > 9, x - 9).otherwise(x).cast("int"),
    )


def mod97(text: Column) -> Column:
    """An IBAN's remainder, letters as 10 to 35."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda acc, c: F.when(F.length(c) == 0, acc).when(c.rlike("[0-9]"), (acc * 10 + c.try_cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97).cast("int"),
    )


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one by one, by ``digits``."""
    filled = F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.struct(F.concat(s["out"], F.when(c.rlike("[0-9]"), F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"), (s["at"] + F.when(c.rlike("[0-9]"), 1).otherwise(0)).cast("int").alias("at")),
    )
    return filled["out"]


def _only_digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _card(v: Column, key: Column) -> Column:
    def made(d: Column) -> Column:
        body = permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        return let(body, lambda b: _refill(v, F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string"))))

    return let(_only_digits(v), lambda d: F.when(F.length(d).between(13, 19) & (luhn_sum(d) % 10 == 0), made(d)))


def _iban(v: Column, key: Column) -> Column:
    def made(c: Column) -> Column:
        country, body = F.substring(c, 1, 2), F.substring(c, F.lit(5), F.length(c))
        new = let(_only_digits(body), lambda d: F.when(F.length(d) == 0, body).otherwise(_refill(body, permute_digits(d, key, F.concat_ws(":", F.lit("iban"), country, F.regexp_replace(body, "[0-9]", ""))))))
        return let(new, lambda b: _shape(v, F.concat(country, F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b)))

    return let(F.replace(v, F.lit(" "), F.lit("")), lambda c: F.when(F.length(c).between(15, 34) & (mod97(F.concat(F.substring(c, F.lit(5), F.length(c)), F.substring(c, 1, 4))) == 1), made(c)))


def _shape(shape: Column, chars: Column) -> Column:
    filled = F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.struct(F.concat(s["out"], F.when(c == " ", c).otherwise(F.substring(chars, s["at"], F.lit(1)))).alias("out"), (s["at"] + F.when(c == " ", 0).otherwise(1)).cast("int").alias("at")),
    )
    return filled["out"]


def _ip(v: Column, key: Column) -> Column:
    def made(o: Column) -> Column:
        octet = lambda k: o[k].try_cast("long")
        got = feistel(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), F.lit(65536), F.lit(65536), key, "ip")
        part = lambda x, hi: (F.floor(x / 256) if hi else x % 256).cast("long").cast("string")
        return let(got, lambda s: F.concat_ws(".", part(s["a"], True), part(s["a"], False), part(s["b"], True), part(s["b"], False)))

    return let(F.split(v, r"\."), lambda o: F.when(F.forall(o, lambda x: x.try_cast("int") <= 255), made(o)))


def _leaps(y: Column) -> Column:
    """Leap years from the first year on, before year y."""
    return F.greatest(F.floor((y - 1901) / 4), F.lit(0)).cast("int") - F.when(y > 2100, 1).otherwise(0)


def _is_leap(y: Column) -> Column:
    return (y % 4 == 0) & (y != 1900) & (y != 2100)


def _day_index(d: Column) -> Column:
    """struct(grade, i): the day's group and its number in it."""
    y, m, day = F.year(d), F.month(d), F.dayofmonth(d)
    months = (y - _YEARS[0]) * 12 + m - 1
    late = F.get(F.array(*map(F.lit, _LATE)), m - 1) + F.when(_is_leap(y) & (m > 2), 1).otherwise(0)
    return (
        F.when(day <= 12, F.struct(F.lit(0).alias("grade"), (months * 12 + day - 1).alias("i")))
        .when(day <= 28, F.struct(F.lit(1).alias("grade"), (months * 16 + day - 13).alias("i")))
        .otherwise(F.struct(F.lit(2).alias("grade"), ((y - _YEARS[0]) * 29 + _leaps(y) + late + day - 29).alias("i")))
    )


def _day_of_index(grade: Column, i: Column) -> Column:
    """The date of a number in a group."""
    size = F.when(grade == 0, 12).otherwise(16)
    month = F.floor(i / size).cast("int")
    early = F.make_date(F.floor(month / 12).cast("int") + _YEARS[0], month % 12 + 1, (i % size).cast("int") + F.when(grade == 0, 1).otherwise(13))
    before = lambda y: (y - _YEARS[0]) * 29 + _leaps(y)
    near = _YEARS[0] + F.floor(i / 29.25).cast("int")
    years = F.filter(F.sequence(near - 2, near + 2), lambda y: before(y) <= i)

    def in_year(y: Column) -> Column:
        rest = (i - before(y)).cast("int")
        offset = lambda m: F.get(F.array(*map(F.lit, _LATE)), m - 1) + F.when(_is_leap(y) & (m > 2), 1).otherwise(0)
        return let(F.array_max(F.filter(F.sequence(F.lit(1), F.lit(12)), lambda m: offset(m) <= rest)), lambda m: F.make_date(y, m, rest - offset(m) + 29))

    return F.when(grade < 2, early).otherwise(let(F.array_max(years), in_year))


def _date(v: Column, key: Column) -> Column:
    iso = v.rlike("^[0-9]{4}-")
    day_first = F.concat_ws("-", F.substring(v, 7, 4), F.substring(v, 4, 2), F.substring(v, 1, 2))
    month_first = F.concat_ws("-", F.substring(v, 7, 4), F.substring(v, 1, 2), F.substring(v, 4, 2))
    # With slashes, a date that isn't valid with the day first may be with the month first. Its day is above 12 then, and
    # stays so: the pseudonym reads month first as well.
    parsed = F.when(iso, v.try_cast("date")).otherwise(F.coalesce(day_first.try_cast("date"), F.when(v.contains("/"), month_first.try_cast("date"))))
    swapped = ~iso & day_first.try_cast("date").isNull()

    def made(d: Column) -> Column:
        sep = F.substring(v, 3, 1)

        def new(x: Column) -> Column:
            half = lambda k: F.element_at(F.array(*(F.lit(sizes[k]) for sizes in _DAYS)), x["grade"] + 1)
            got = feistel(F.floor(x["i"] / half(1)), x["i"] % half(1), half(0), half(1), key, F.concat(F.lit("date:"), x["grade"].cast("string")))
            return let(got, lambda s: _day_of_index(x["grade"], s["a"] * half(1) + s["b"]))

        def shown(t: Column) -> Column:
            y, m, day = (F.date_format(t, f) for f in ("yyyy", "MM", "dd"))
            return F.when(iso, F.concat_ws("-", y, m, day)).when(swapped, F.concat(m, sep, day, sep, y)).otherwise(F.concat(day, sep, m, sep, y))

        return let(let(_day_index(d), new), shown)

    return let(parsed, lambda d: F.when(F.year(d).between(*_YEARS), made(d)))


def _ssn(v: Column, key: Column) -> Column:
    area, group, serial = (F.substring(v, p, n).try_cast("int") for p, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area.between(1, 899)) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    got = feistel(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def shown(s: Column) -> Column:
        i = F.floor(s["a"] / 99)
        pad = lambda x, n: F.lpad(x.cast("long").cast("string"), n, "0")
        return F.concat_ws("-", pad(F.when(i >= 665, i + 2).otherwise(i + 1), 3), pad(s["a"] % 99 + 1, 2), pad(s["b"] + 1, 4))

    return F.when(valid, let(got, shown))


def _phone(v: Column, key: Column) -> Column:
    # What stands before the number, its country code, stays.
    code = F.when(v.startswith("+"), F.regexp_extract(v, _COUNTRY, 1)).otherwise(F.lit(""))

    def made(d: Column, c: Column) -> Column:
        number = F.substring(d, F.length(c) + 1, F.length(d))
        tweak = F.concat(F.lit("phone:"), F.when(c == "", "1").otherwise(c))
        return _refill(v, F.concat(c, permute_digits(number, key, tweak)))

    return let(_only_digits(v), lambda d: let(code, lambda c: F.when(F.length(d).between(8, 15), made(d, c))))


def _email(v: Column, key: Column) -> Column:
    domain = F.regexp_extract(v, "@(.+)$", 1)

    def made(name: Column) -> Column:
        shape = F.regexp_replace(F.regexp_replace(name, "[0-9]", "0"), "[a-z]", "a")
        letters, digits = F.regexp_replace(name, "[^a-z]", ""), F.regexp_replace(name, "[^0-9]", "")
        tweak = lambda what: F.concat_ws("|", F.lit("email"), F.lit(what), shape, F.lower(domain))
        part = lambda t, k, n: F.substring(t, F.lit(k * n + 1), F.lit(n))

        def pieces(t: Column, n: int, permute, what) -> Column:
            """A name has up to 64 characters: its letters by 26 and its digits by 36, each permuted by itself."""
            return F.concat(*(let(part(t, k, n), lambda p, k=k: F.when(F.length(p) == 0, "").otherwise(permute(p, key, F.concat_ws("|", what, F.lit(str(k)))))) for k in range(-(-64 // n))))

        # The letters depend on the new digits too, so that names that differ in digits alone share nothing.
        return let(pieces(digits, 36, permute_digits, tweak("digits")), lambda nd: let(pieces(letters, 26, permute_letters, F.concat_ws("|", tweak("letters"), nd)), lambda nl: _spelled(name, nl, nd)))

    # The domain is no person's.
    return let(F.lower(F.regexp_extract(v, "^([^@]+)@", 1)), lambda name: F.concat(made(name), F.lit("@"), domain))


def _spelled(shape: Column, letters: Column, digits: Column) -> Column:
    """``shape`` with its letters and digits replaced, one by one."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("a"), F.lit(1).alias("d"))

    def step(s: Column, c: Column) -> Column:
        letter, digit = c.rlike("[a-z]"), c.rlike("[0-9]")
        put = F.when(letter, F.substring(letters, s["a"], F.lit(1))).when(digit, F.substring(digits, s["d"], F.lit(1))).otherwise(c)
        return F.struct(F.concat(s["out"], put).alias("out"), (s["a"] + F.when(letter, 1).otherwise(0)).cast("int").alias("a"), (s["d"] + F.when(digit, 1).otherwise(0)).cast("int").alias("d"))

    return F.aggregate(F.split(shape, ""), start, step)["out"]


_MAKERS = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(value: Column, key: Column) -> Column:
    """struct(kind, value) of one candidate: the first format that fits and is valid; kind null and the value itself if none is."""
    def made(kind: str, pattern: str) -> Column:
        fits = F.when(value.rlike(f"^(?:{pattern})$"), _MAKERS[kind](value, key))
        return let(fits, lambda m: F.when(m.isNotNull(), F.struct(F.lit(kind).alias("kind"), m.alias("value"))))

    # Side by side, not one in another: each level of functions takes the analyzer a few turns.
    return F.coalesce(*(made(k, p) for k, p in PATTERNS.items()), F.struct(F.lit(None).cast("string").alias("kind"), value.alias("value")))


def _valid_card(v: Column) -> Column:
    return v.rlike(f"^{PATTERNS['card']}$") & (luhn_sum(_only_digits(v)) % 10 == 0)


def _numbers(run: Column, kinds: tuple[str, ...], card) -> Column:
    """array<struct<s, try>>: a run of groups as numbers to try, each of whole groups, and what lies between them; the first and longest count."""
    found = "^(?:" + "|".join(PATTERNS[k] for k in kinds) + ")$"
    piece = lambda t, i, j: F.array_join(F.slice(t, i, j - i + 1), "")
    token = lambda s, tried: F.struct(s.alias("s"), F.lit(tried).alias("try"))

    def split(t: Column) -> Column:
        n = F.size(t)

        def step(state: Column, i: Column) -> Column:
            # A card has 19 groups at most.
            ends = F.filter(F.sequence(F.least(i + 36, n), i, F.lit(-1)), lambda j: F.get(t, j - 1).rlike("^[A-Z0-9]"))
            good = F.filter(F.transform(ends, lambda j: F.struct(j.alias("j"), piece(t, i, j).alias("s"))), lambda e: e["s"].rlike(found) | card(e["s"]))
            taken = lambda e: F.struct(F.concat(state["out"], F.array(token(piece(t, state["at"], i - 1), False), token(e["s"], True))).alias("out"), (e["j"] + 1).alias("at"))
            there = (i >= state["at"]) & F.get(t, i - 1).rlike("^[A-Z0-9]")
            return F.when(there, let(F.get(good, F.lit(0)), lambda e: F.when(e.isNotNull(), taken(e)).otherwise(state))).otherwise(state)

        start = F.struct(F.array().cast("array<struct<s:string,try:boolean>>").alias("out"), F.lit(1).alias("at"))
        return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda z: F.concat(z["out"], F.array(token(piece(t, z["at"], n), False))))

    return F.when(run.rlike("[A-Z0-9]"), let(F.regexp_extract_all(run, F.lit("[A-Z0-9]+|[ -]+"), F.lit(0)), split)).otherwise(F.array(token(run, False)))


def _tokens(v: Column) -> Column:
    """array<struct<s, try>> of one candidate: itself, or the numbers in a run that isn't one."""
    own = ("date", "ssn", "phone")
    usual = _numbers(v, own, lambda x: x.rlike(_USUAL) & _valid_card(x))
    cards = F.flatten(F.transform(usual, lambda t: F.when(t["try"], F.array(t)).otherwise(_numbers(t["s"], own, _valid_card))))
    is_iban = lambda x: x.rlike(f"^(?:{PATTERNS['iban']})$") & let(F.replace(x, F.lit(" "), F.lit("")), lambda c: F.length(c).between(15, 34) & (mod97(F.concat(F.substring(c, F.lit(5), F.length(c)), F.substring(c, 1, 4))) == 1))
    ibans = _numbers(v, own, lambda x: is_iban(x) | _valid_card(x))
    single = v.rlike("^(?:" + "|".join(PATTERNS[k] for k in own) + ")$") | _valid_card(v)
    return F.when(v.rlike("^[0-9][0-9 -]*$") & ~single, cards).when(v.rlike(f"^(?:{PATTERNS['iban']})$") & ~is_iban(v), ibans).otherwise(F.array(F.struct(v.alias("s"), F.lit(True).alias("try"))))


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "pii") -> DataFrame:
    """``docs`` with pseudonyms in text_col, and found_col array<struct<kind, value>>: what was put in, in order; no shuffle."""
    found, made = free_name(docs, found_col), free_name(docs, "__tb_made")
    text, secret = F.col(text_col), F.lit(key)
    some = text.rlike(CANDIDATE)
    plain = lambda p: F.array(F.struct(p.alias("s"), F.lit(False).alias("try")))
    tokens = F.flatten(F.zip_with(F.split(text, CANDIDATE, -1), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda p, v: F.when(v.isNull(), plain(p)).otherwise(F.concat(plain(p), _tokens(v)))))
    untouched = lambda t: F.struct(F.lit(None).cast("string").alias("kind"), t["s"].alias("value"))
    rows = docs.withColumn(made, F.when(some, F.transform(tokens, lambda t: F.when(t["try"], pseudonym(t["s"], secret)).otherwise(untouched(t)))))
    whole = F.array_join(F.col(made)["value"], "")
    rows = rows.withColumn(found, F.coalesce(F.filter(made, lambda m: m["kind"].isNotNull()), F.array().cast("array<struct<kind:string,value:string>>")))
    return rows.withColumn(text_col, F.when(F.size(found) > 0, whole).otherwise(text)).drop(made)
