"""Format-preserving pseudonyms for personal numbers and dates by keyed Feistel networks.

Found and validated values are replaced by others of the same format, the same one for equal
values in all documents and every run with the key:

* payment cards, 13 to 19 digits with a valid Luhn digit: the other digits are permuted and
  the Luhn digit is computed again; blanks and hyphens stay in place;
* IBANs with valid check digits (mod 97): the digits of the account part are permuted, the
  check digits computed again;
* US social security numbers in the assigned ranges: permuted within those ranges;
* phone numbers +1 (ddd) ddd-dddd, (ddd) ddd-dddd, ddd-ddd-dddd and +1 ddd ddd dddd: the ten
  digits are permuted;
* IPv4 addresses with octets of at most 255: the 32 bits are permuted;
* dates yyyy-mm-dd, yyyy/mm/dd, dd/mm/yyyy and dd.mm.yyyy that exist, from 1900-01-01 for
  73,170 days: the day is permuted within that range and written in the same format;
* e-mail addresses: letters and digits of the local part are permuted in place.

What looks alike but does not validate stays as it is. A card or IBAN may stand next to other
groups of digits or words ("4111 1111 1111 1111 12/27"): in a run of groups between blanks the
longest spans that validate are the values, and only these are replaced; IBANs of their country's
length go first. One span in ten passes Luhn by chance, so a part of a longer run is a card only if it
starts as an issuer's numbers of its length do, is grouped as cards are printed, and does not lie in a
row of four-digit groups that is not made of such cards: tables of numbers stay. Each permutation is a balanced Feistel
network over two halves of the value's own range: a' = (a + f(key, round, b)) mod A, then the
halves swap roles, ``ROUNDS`` times, with f from SHA-256. Adding modulo a half's size can be
undone, so it is a bijection and no two values share a pseudonym.

DataFrame functions only, row by row: no shuffle, nothing collected. Texts without a digit or
an at-sign are passed through without matching.

Cases: a null text stays null, an empty one empty; other columns, whatever their names, pass
through; ``replaced`` counts the values replaced. The key is a parameter; whoever holds it can
undo the permutation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, own, table

ROUNDS = 8
KEY = "pseudonyms"

DATE_DAYS = (270, 271)  # halves of the day range, 270 * 271 days
# Patterns in order of precedence. Boundaries keep them off longer runs of digits, and make each
# run of characters be tried from its start only.
CARD = r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?<![\w-])(?:(?:\+1[ -]?)?\(\d{3}\) ?|(?:\+1[ -])?\d{3}[ -])\d{3}[ -]\d{4}(?![\w-])"
IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
DATE = r"(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-]|\.\d)"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
# Where cards and IBANs are looked for: a whole run of digit groups, with what follows if that rules
# the last group out, and at every possible start the longest that looks like an IBAN.
CARD_RUN = r"(?<![\w.-])(?=(?:\d[ -]?){12}\d)\d++(?:[ -]\d++)*+(?:[\w-]|\.\d)?"
CARD_SHAPE = r"\d+|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5}"  # as cards are printed
# First digits and lengths of the issuers' numbers.
ISSUERS = (r"4(?:\d{12}|\d{15}|\d{18})", r"5[1-5]\d{14}", r"2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}", r"3[47]\d{13}",
           r"3(?:0[0-5]|[689]\d)\d{11}", r"35(?:2[89]|[3-8]\d)\d{12}", r"6(?:011|5\d\d|4[4-9]\d)\d{12}", r"62\d{14,17}")
ISSUED = "|".join(ISSUERS)
IBAN_RUN = rf"(?=({IBAN}))\b[A-Z]{{2}}\d{{2}}"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _noise(key: str, domain: str, r: Column, value: Column) -> Column:
    """60 bits of SHA-256 of key, domain, round and the other half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(domain), r.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(key: str, domain: str, a: Column, size_a: Column | int, b: Column, size_b: Column | int) -> Column:
    """struct(a, b): a permutation of [0, size_a) x [0, size_b)."""
    size_a = F.lit(size_a).cast("long") if isinstance(size_a, int) else size_a
    size_b = F.lit(size_b).cast("long") if isinstance(size_b, int) else size_b
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s, r):
        left = r % 2 == 0
        return F.struct(
            F.when(left, F.pmod(s["a"] + F.pmod(_noise(key, domain, r, s["b"]), size_a), size_a)).otherwise(s["a"]).alias("a"),
            F.when(left, s["b"]).otherwise(F.pmod(s["b"] + F.pmod(_noise(key, domain, r, s["a"]), size_b), size_b)).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _chars(s: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substr(s, i, F.lit(1)))


def _padded(n: Column, width: Column) -> Column:
    return F.lpad(n.cast("string"), width, F.lit("0"))


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits`` (as many)."""
    def fill(new):
        def put(s, c):
            digit = c.rlike("[0-9]")
            return F.struct(F.concat(s["out"], F.when(digit, F.substr(new, s["n"], F.lit(1))).otherwise(c)).alias("out"),
                            F.when(digit, s["n"] + 1).otherwise(s["n"]).alias("n"))
        return F.aggregate(_chars(shape), F.struct(F.lit("").alias("out"), F.lit(1).alias("n")), put, lambda s: s["out"])
    return _let(digits, fill)


def luhn_digit(payload: Column) -> Column:
    """The check digit for a string of digits (a bound value)."""
    n = F.length(payload)

    def add(total, i):
        d = F.substr(payload, i, F.lit(1)).cast("int")
        twice = F.when((n - i) % 2 == 0, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)
    return F.pmod(10 - F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10, F.lit(10)).cast("string")


def _digit_string(key: str, domain: str, s: Column) -> Column:
    """A permutation of the digit strings of each length (1 to 36; a bound value)."""
    n = F.length(s)
    left = F.floor(n / 2).cast("int")
    power = lambda k: F.element_at(F.array(*[F.lit(10 ** i) for i in range(19)]), k + 1)
    a, b = F.substr(s, F.lit(1), left), F.substr(s, left + 1, n - left)
    halves = feistel(key, domain, F.when(left > 0, a.cast("long")).otherwise(F.lit(0).cast("long")), power(left),
                     b.cast("long"), power(n - left))
    return _let(halves, lambda p: F.concat(F.when(left > 0, _padded(p["a"], left)).otherwise(""), _padded(p["b"], n - left)))


def card(key: str, s: Column) -> Column:
    def of_digits(d):
        def of_payload(payload):
            valid = luhn_digit(payload) == F.substr(d, F.length(d), F.lit(1))
            return F.when(valid, _let(_digit_string(key, "card", payload),
                                      lambda new: _refill(s, F.concat(new, luhn_digit(new)))))
        return _let(F.substr(d, F.lit(1), F.length(d) - 1), of_payload)
    return _let(_digits(s), of_digits)


def _mod97(s: Column) -> Column:
    """Remainder of an IBAN's letters and digits read as a number (A = 10)."""
    def add(r, c):
        v = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (r * F.when(v < 10, F.lit(10)).otherwise(F.lit(100)) + v) % 97
    return F.aggregate(_chars(s), F.lit(0), lambda r, c: add(r, c).cast("int"))


def iban(key: str, s: Column) -> Column:
    def of_plain(plain):
        country = F.substr(plain, F.lit(1), F.lit(2))

        def of_account(account):
            valid = (_mod97(F.concat(account, F.substr(plain, F.lit(1), F.lit(4)))) == 1) & F.length(plain).between(15, 34)
            numbers = _let(_digits(account), lambda d: F.when(
                F.length(d) > 0, _refill(account, _digit_string(key, "iban", d))).otherwise(account))

            def spaced(text):  # the blanks go back to their places
                def put(out, c):
                    blank = c == " "
                    return F.struct(F.concat(out["out"], F.when(blank, c).otherwise(F.substr(text, out["n"], F.lit(1)))).alias("out"),
                                    F.when(blank, out["n"]).otherwise(out["n"] + 1).alias("n"))
                return F.aggregate(_chars(s), F.struct(F.lit("").alias("out"), F.lit(1).alias("n")), put, lambda x: x["out"])
            whole = _let(numbers, lambda new: _let(
                F.concat(country, _padded(98 - _mod97(F.concat(new, country, F.lit("00"))), F.lit(2)), new), spaced))
            return F.when(valid, whole)
        return _let(F.substr(plain, F.lit(5)), of_account)
    return _let(F.regexp_replace(s, " ", ""), of_plain)


def ssn(key: str, s: Column) -> Column:
    area, group, serial = (F.substr(s, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)  # 0 to 897

    def text(p):
        new = F.floor(p["a"] / 99)
        return F.concat_ws("-", _padded(F.when(new >= 665, new + 2).otherwise(new + 1), F.lit(3)),
                           _padded(p["a"] % 99 + 1, F.lit(2)), _padded(p["b"] + 1, F.lit(4)))
    return F.when(valid, _let(feistel(key, "ssn", index * 99 + group - 1, 898 * 99, serial - 1, 9999), text))


def phone(key: str, s: Column) -> Column:
    prefix = F.regexp_extract(s, r"^\+1[ -]?", 0)
    return _let(F.substr(s, F.length(prefix) + 1), lambda rest: _let(_digits(rest), lambda d: F.concat(
        prefix, _refill(rest, _digit_string(key, "phone", d)))))


def ip(key: str, s: Column) -> Column:
    def of_octets(o):
        valid = F.forall(o, lambda x: x <= 255)
        halves = feistel(key, "ip", F.get(o, 0) * 256 + F.get(o, 1), 65536, F.get(o, 2) * 256 + F.get(o, 3), 65536)
        return F.when(valid, _let(halves, lambda p: F.concat_ws(".", *[x.cast("string") for x in (
            F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)])))
    return _let(F.transform(F.split(s, r"\."), lambda x: x.cast("int")), of_octets)


def date(key: str, s: Column) -> Column:
    year_first = s.rlike(r"^\d{4}")
    sep = F.when(year_first, F.substr(s, F.lit(5), F.lit(1))).otherwise(F.substr(s, F.lit(3), F.lit(1)))
    at = lambda y, o: F.when(year_first, F.substr(s, F.lit(y[0]), F.lit(y[1]))).otherwise(
        F.substr(s, F.lit(o[0]), F.lit(o[1])))
    day = F.to_date(F.try_to_timestamp(
        F.concat_ws("-", at((1, 4), (7, 4)), at((6, 2), (4, 2)), at((9, 2), (1, 2))), F.lit("yyyy-MM-dd")))
    origin = F.lit("1900-01-01").cast("date")

    def of_index(index):
        def text(new):
            y, m, d = (F.date_format(new, f) for f in ("yyyy", "MM", "dd"))
            return F.when(year_first, F.concat(y, sep, m, sep, d)).otherwise(F.concat(d, sep, m, sep, y))
        halves = feistel(key, "date", F.floor(index / DATE_DAYS[1]), DATE_DAYS[0], index % DATE_DAYS[1], DATE_DAYS[1])
        new = _let(halves, lambda p: F.date_add(origin, (p["a"] * DATE_DAYS[1] + p["b"]).cast("int")))
        return F.when(index.between(0, DATE_DAYS[0] * DATE_DAYS[1] - 1), _let(new, text))
    return _let(F.datediff(day, origin), of_index)  # null if there is no such day


def email(key: str, s: Column) -> Column:
    """Letters and digits of the local part are shifted within their kind, those at even places
    by a hash of those at odd places and the other way round: a Feistel network over places."""
    local, domain = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1)

    def step(text, r):
        chars = _chars(text)
        other = F.array_join(F.filter(chars, lambda c, i: i % 2 != r % 2), "")
        seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), r.cast("string"), F.length(text).cast("string"), other), 256)

        def shift(noise, c, i):
            # 7 hexadecimal digits per place, from a hash of its own
            n = F.conv(F.substring(F.sha2(F.concat(noise, i.cast("string")), 256), 1, 7), 16, 10).cast("long")
            turn = lambda first, size: F.chr(F.pmod(F.ascii(c) - first + n, F.lit(size)) + first)
            return (F.when(i % 2 != r % 2, c).when(c.rlike("[0-9]"), turn(48, 10)).when(c.rlike("[a-z]"), turn(97, 26))
                    .when(c.rlike("[A-Z]"), turn(65, 26)).otherwise(c))
        return _let(seed, lambda noise: F.array_join(F.transform(chars, lambda c, i: shift(noise, c, i)), ""))
    return F.concat(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), local, step), F.lit("@"), domain)


def pseudonym(key: str, s: Column) -> Column:
    """The pseudonym of one match, or null if it does not validate."""
    kinds = ((EMAIL, email), (IBAN, iban), (DATE, date), (SSN, ssn), (PHONE, phone), (CARD, card), (IP, ip))
    out = None
    for pattern, f in kinds:
        is_kind = s.rlike(f"^(?:{pattern})$")
        out = F.when(is_kind, f(key, s)) if out is None else out.when(is_kind, f(key, s))
    return out


def _card_spans(run: Column) -> Column:
    """Spans of whole groups between blanks that are cards, without overlap: those grouped as
    cards are printed first, then the longest."""
    def of_tokens(t):
        four = lambda i: F.coalesce(F.get(t, i).rlike(r"^\d{4}$"), F.lit(False))

        def of_issuer(text):
            return text.rlike(f"^(?:{CARD_SHAPE})$") & _let(_digits(text), lambda d: d.rlike(f"^(?:{ISSUED})$")
                                                            & (luhn_digit(F.substr(d, F.lit(1), F.length(d) - 1))
                                                               == F.substr(d, F.length(d), F.lit(1))))

        def in_part(text, i, n):
            """Whether a part of a longer run can be a card: an issuer's, and in a row of four-digit
            groups the next ones, on either side, are again the four groups of an issuer's card."""
            groups = lambda at: F.array_join(F.slice(t, F.greatest(at, F.lit(0)) + 1, F.lit(4)), " ")
            after = ~four(i + n) | of_issuer(groups(i + n))
            before = F.when(i < 1, F.lit(True)).otherwise(~four(i - 1) | ((i >= 4) & of_issuer(groups(i - 4))))
            in_fours = text.rlike(r"^\d{4}( \d{4}){3}$")
            return of_issuer(text) & (~in_fours | (after & before))

        def at(i):
            def span(n):
                text = F.array_join(F.slice(t, i + 1, n), " ")
                digits = F.length(_digits(text))
                fits = ((i + n <= F.size(t)) & digits.between(13, 19) & text.rlike(f"^{CARD}$")
                        & ((n == F.size(t)) | in_part(text, i, n)))
                valid = F.when(fits, _let(_digits(text), lambda d: luhn_digit(F.substr(d, F.lit(1), F.length(d) - 1))
                                          == F.substr(d, F.length(d), F.lit(1))))
                return F.when(valid, F.struct((~text.rlike(f"^(?:{CARD_SHAPE})$")).alias("odd"), (-digits).alias("order"),
                                              i.alias("at"), n.alias("n"), text.alias("text")))
            return F.filter(F.transform(F.sequence(F.lit(1), F.lit(19)), span), lambda x: x.isNotNull())
        found = F.array_sort(F.flatten(F.transform(F.sequence(F.lit(0), F.size(t) - 1), at)))
        none = F.array().cast("array<struct<odd:boolean,order:int,at:int,n:int,text:string>>")

        def put(kept, x):
            clash = F.exists(kept, lambda y: (x["at"] < y["at"] + y["n"]) & (y["at"] < x["at"] + x["n"]))
            return F.when(clash, kept).otherwise(F.concat(kept, F.array(x)))
        return F.transform(F.aggregate(found, none, put), lambda x: x["text"])
    return _let(F.split(run, " ", -1), of_tokens)


def _iban_span(run: Column) -> Column:
    """The start of ``run`` that is an IBAN, of its country's length or else the longest; or null."""
    length = F.create_map(*[F.lit(x) for n, names in IBAN_LENGTHS.items() for c in names.split() for x in (c, n)])

    def of_tokens(t):
        def span(n):
            text = F.array_join(F.slice(t, F.lit(1), n), " ")
            valid = _let(F.regexp_replace(text, " ", ""), lambda p: F.length(p).between(15, 34) & (
                _mod97(F.concat(F.substr(p, F.lit(5)), F.substr(p, F.lit(1), F.lit(4)))) == 1))
            size = F.length(F.regexp_replace(text, " ", ""))
            usual = F.coalesce(size == F.element_at(length, F.substr(text, F.lit(1), F.lit(2))), F.lit(False))
            return F.when(text.rlike(f"^{IBAN}$") & valid, F.struct(usual.alias("usual"), n.alias("n"), text.alias("text")))
        return F.array_max(F.transform(F.sequence(F.lit(1), F.size(t)), span))["text"]
    return _let(F.split(run, " ", -1), of_tokens)


def _any(text: Column) -> Column:
    """The pattern of a text: cards and IBANs stand in it as the values found in the text."""
    def values(found, before, after):
        # all of digits, capitals, blanks and hyphens; longer ones first
        found = F.array_sort(F.array_distinct(found), lambda a, b: F.length(b) - F.length(a))
        return F.when(F.size(found) > 0, F.concat(F.lit(f"{before}(?:"), F.array_join(found, "|"), F.lit(f"){after}|"))).otherwise("")
    cards = F.when(text.rlike(CARD_RUN), _let(F.flatten(F.transform(
        F.regexp_extract_all(text, F.lit(CARD_RUN), 0), _card_spans)), lambda x: values(x, r"(?<![\w.-])", r"(?![\w-]|\.\d)")))
    ibans = F.when(text.rlike(IBAN), _let(F.filter(F.transform(
        F.regexp_extract_all(text, F.lit(IBAN_RUN), 1), _iban_span), lambda x: x.isNotNull()), lambda x: values(x, r"\b", r"\b")))
    return F.concat(F.lit(f"({EMAIL}|"), F.coalesce(ibans, F.lit("")), F.lit(f"{DATE}|{SSN}|{PHONE}|"),
                    F.coalesce(cards, F.lit("")), F.lit(f"{IP})"))


def pseudonymise(docs: DataFrame, key: str = KEY, column: str = "text") -> DataFrame:
    """``docs`` with the values in ``column`` replaced and ``replaced`` counted."""
    text = F.col(column)
    maybe = text.rlike("[0-9]|@")
    any_, old, new, pieces = (fresh(docs, n) for n in ("__any", "__old", "__new", "__pieces"))
    found = docs.withColumn(any_, F.when(maybe, _any(text)))
    found = found.withColumn(old, F.regexp_extract_all(text, F.col(any_), 1))
    found = found.withColumn(new, F.transform(old, lambda m: pseudonym(key, m)))
    hit = F.exists(new, lambda x: x.isNotNull())
    found = found.withColumn(pieces, F.when(hit, F.split(text, F.col(any_), -1)))
    whole = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.size(old)), lambda i: F.concat(
        F.element_at(pieces, i), F.coalesce(F.element_at(new, i), F.element_at(old, i)))), ""),
        F.element_at(pieces, -1))
    count = F.coalesce(F.size(F.filter(new, lambda x: x.isNotNull())), F.lit(0))
    return found.select(*[F.when(hit, whole).otherwise(text).alias(c) if c == column else own(found, c)
                          for c in docs.columns], count.alias(fresh(docs, "replaced")))


def op8_pseudonyms(spark, sf_dir) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents")).select("doc_id", "text", F.col("replaced").cast("long").alias("replaced"))
