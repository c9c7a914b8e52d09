"""Operator 3: personal data becomes format-preserving pseudonyms, with DataFrame functions only.

Candidates are found by one pattern, validated (Luhn sums, octets, calendar days, reserved number
ranges) and put through a keyed Feistel network over the characters or numbers of their own format:
each round shifts one half by a keyed hash of the other half, every character within its alphabet.
This is a permutation of the format, so equal values have equal pseudonyms in all documents and
different values of a format stay different. Card numbers get a new check digit, octets stay octets,
days stay days of 1800 to 2199, credentials keep their alphabet, e-mail addresses their domain, phones and accounts their country.

Letters of other scripts move among the letters of their kind within the 128 code points around them, ideographs and Hangul among all of theirs. What leaves its format (a number range that
isn't given out, a day that reads in the other order) is permuted again until it is back in it.

Defined results: null stays null, and a text without valid candidates stays as it is; candidates that
fail validation stay; repeated rows are treated alike; all other columns pass through.
"""

from __future__ import annotations

import functools
import json
import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Most times that a value is permuted again; a chance below 1e-9 for a value is left out of its format then.
WALK = 24
LOW, HIGH, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
LATIN, LATIN_HIGH = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
#: Code points in a row that are all letters of no case, from which on they are one alphabet: ideographs, Hangul and the like.
STRETCH = 200
NAMES = "password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key"
#: Heads of credentials that are told by them.
HEADS = "(?:AKIA|ASIA)(?=[A-Z0-9]{16}(?![A-Za-z0-9]))|gh[pousr]_(?=[A-Za-z0-9]{20})|glpat-(?=[A-Za-z0-9_-]{16})|xox[abprs]-(?=[A-Za-z0-9-]{10})|[sp]k[_-](?:live[_-]|test[_-]|proj-)?(?=[A-Za-z0-9]{16})"
#: Signed tokens and what follows the word bearer: their parts are cut by dots.
DOTTED = r"eyJ(?=[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{8,}\.)|(?i:bearer) (?=[A-Za-z0-9._~+/-]{16})"
ASSIGNED = rf"(?i:{NAMES})[\"']? ?[=:] ?[\"']?"

EMAIL = r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[\p{L}\p{M}\p{N}-]++(?:\.[\p{L}\p{M}\p{N}-]++)+"
CARD = r"(?<![\p{L}\p{N}_])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}([ -])[0-9]{6}\2[0-9]{5})(?![\p{L}\p{N}_])"
PHONE = r"(?<![\p{L}\p{N}+(])(?:(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|\+[0-9]{1,3}(?:[ .-][0-9]{2,8}){2,4}|\+[0-9]{9,14}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
#: Whole, or with ``::``: of three groups or more, or of two if the first has four digits and the address a decimal digit; ``a1::b2`` is a name.
IPV6 = r"(?<![\p{L}\p{N}:_])(?:(?=[A-Fa-f:]*+[0-9])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5}|(?:[0-9A-Fa-f]{1,4}:)(?::[0-9A-Fa-f]{1,4}){2,6}|(?=[A-Fa-f:]*+[0-9])[0-9A-Fa-f]{4}::[0-9A-Fa-f]{1,4})(?![\p{L}\p{N}:_])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
DAY = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
SECRET = rf"(?<![A-Za-z0-9])(?:(?:{DOTTED})[A-Za-z0-9._~+/-]+|(?:{HEADS})[A-Za-z0-9_-]+|{ASSIGNED}[A-Za-z0-9+/_-]{{8,}})"
ANY = "|".join(p.replace(r"\1", r"\k<a>").replace(r"\2", r"\k<b>").replace("([ -])", "(?<a>[ -])", 1).replace("([ -])", "(?<b>[ -])", 1) for p in (EMAIL, SECRET, IPV6, IPV4, DAY, SSN, IBAN, PHONE, CARD))
#: Country calling codes of one and two digits; all others have three.
CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def hashed(key: str, tweak: str, turn: Column, *data: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), *[d.cast("string") for d in data]), 256)


def below(digest: Column, n: int) -> Column:
    """A number under ``n`` from the first 52 bits of a digest."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") % n


def code_point(n: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


@functools.cache
def stretches() -> tuple[tuple[int, int], ...]:
    """First code points and sizes of the long runs of letters of no case."""
    out, first = [], None
    for n in range(0x80, sys.maxunicode + 2):
        inside = n <= sys.maxunicode and unicodedata.category(chr(n)) == "Lo"
        if inside and first is None:
            first = n
        elif not inside and first is not None:
            if n - first >= STRETCH:
                out.append((first, n - first))
            first = None
    return tuple(out)


@functools.cache
def block_alphabets() -> str:
    """Letters and numerals of each 128 code points, small, large, others and numerals apart, as JSON; those with alphabets of their own aren't among them.

    No character is in two of these, and each stays in its own, so moving within them is a permutation.
    """
    own = {*LOW, *HIGH, *DIGITS, *LATIN, *LATIN_HIGH}
    own.update(chr(n) for first, size in stretches() for n in range(first, first + size))
    out: dict[str, dict[str, str]] = {}
    for n in range(0x80, sys.maxunicode + 1):
        c = chr(n)
        kind = unicodedata.category(c)
        if kind[0] in "LN" and c not in own:
            group = kind if kind in ("Ll", "Lu") else kind[0]
            block = out.setdefault(str(n // 128), {})
            block[group] = block.get(group, "") + c
    return json.dumps({k: list(v.values()) for k, v in out.items()}, ensure_ascii=False)


def shifted(half: Column, digest: Column, alphabets: tuple[str, ...], letters: bool = False) -> Column:
    """Each character moved within its alphabet; with ``letters`` also those of other scripts. All else stays."""

    def moved(c: Column, by: Column, alphabet: Column) -> Column:
        return alphabet.substr((F.position(c, alphabet) - 1 + by) % F.length(alphabet) + 1, F.lit(1))

    def one(i: Column) -> Column:
        c = half.substr(i, F.lit(1))
        by = F.conv(digest.substr((i - 1) % 16 * 4 + 1, F.lit(4)), 16, 10).cast("int")
        out = c
        if letters:
            n = F.ascii(c)
            blocks = F.from_json(F.lit(block_alphabets()), "map<string,array<string>>")
            own = F.get(F.filter(F.try_element_at(blocks, F.floor(n / 128).cast("string")), lambda a: F.position(c, a) > 0), F.lit(0))
            runs = F.from_json(F.lit(json.dumps([{"a": first, "size": size} for first, size in stretches()])), "array<struct<a:int,size:int>>")
            run = F.get(F.filter(runs, lambda x: (n >= x["a"]) & (n < x["a"] + x["size"])), F.lit(0))
            out = F.when(n >= 0x80, F.coalesce(moved(c, by, own), code_point(run["a"] + (n - run["a"] + by) % run["size"]), c)).otherwise(c)
        for a in reversed(alphabets):
            out = F.when(F.position(c, F.lit(a)) > 0, moved(c, by, F.lit(a))).otherwise(out)
        return out

    return F.when(F.length(half) == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), one), ""))


def walked(first: Column, again: Callable[[Column], Column], fits: Callable[[Column], Column]) -> Column:
    """``first``, permuted again until it fits: a permutation of the values that fit."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda v, _: F.when(fits(v), v).otherwise(again(v)))


def permuted(value: Column, key: str, tweak: str, alphabets: tuple[str, ...] = (DIGITS,), letters: bool = False) -> Column:
    """Feistel network over the two halves of a string; characters outside the alphabets stay."""

    def net(v: Column) -> Column:
        n = F.length(v)
        m = F.ceil(n / 2).cast("int")

        def turn(acc: Column, r: Column) -> Column:
            a, b = acc["a"], acc["b"]
            left = shifted(a, hashed(key, tweak, r, n, b), alphabets, letters)
            right = shifted(b, hashed(key, tweak, r, n, a), alphabets, letters)
            return F.struct(F.when(r % 2 == 0, left).otherwise(a).alias("a"), F.when(r % 2 == 1, right).otherwise(b).alias("b"))

        first = F.struct(v.substr(F.lit(1), m).alias("a"), v.substr(m + 1, n).alias("b"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, turn, lambda acc: F.concat(acc["a"], acc["b"]))

    return let(value, net)


def permuted_pair(a: Column, b: Column, n: int, m: int, key: str, tweak: str) -> Column:
    """Feistel network over two numbers, under ``n`` and under ``m``."""

    def turn(acc: Column, r: Column) -> Column:
        left = (acc["a"] + below(hashed(key, tweak, r, acc["b"]), n)) % n
        right = (acc["b"] + below(hashed(key, tweak, r, acc["a"]), m)) % m
        return F.struct(F.when(r % 2 == 0, left).otherwise(acc["a"]).alias("a"), F.when(r % 2 == 1, right).otherwise(acc["b"]).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), turn)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refilled(form: Column, digits: Column, place: str = "[0-9]") -> Column:
    """``form`` with its digits, or what ``place`` says, replaced by ``digits`` in order."""

    def one(i: Column) -> Column:
        c = form.substr(i, F.lit(1))
        upto = F.length(F.regexp_replace(form.substr(F.lit(1), i), f"[^{place[1:]}", ""))
        return F.when(c.rlike(place), digits.substr(upto, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), one), "")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum from the right; ``doubled`` is 1 if the digit at the right end isn't doubled, 0 if it is."""
    n = F.length(digits)

    def step(s: Column, i: Column) -> Column:
        d = digits.substr(n - i, F.lit(1)).cast("int")
        return s + F.when(i % 2 == doubled, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step)


def card(v: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        body = let(F.concat(d.substr(F.lit(1), F.lit(1)), permuted(d.substr(F.lit(2), F.length(d) - 2), key, "card")), lambda b: F.concat(b, ((10 - luhn_sum(b, 0) % 10) % 10).cast("string")))
        valid = (luhn_sum(d, 1) % 10 == 0) & ~d.rlike("^0+$")
        return F.when(valid, let(body, lambda b: F.when(F.length(v) == F.length(d), b).otherwise(refilled(v, b)))).otherwise(v)

    return let(digits_of(v), new)


def phone(v: Column, key: str) -> Column:
    """The country code stays, the other digits are permuted, whatever stands between them."""

    def new(code: Column) -> Column:
        rest = v.substr(F.length(code) + 1, F.length(v))
        return F.concat(code, let(permuted(digits_of(rest), key, "phone"), lambda d: refilled(rest, d)))

    return let(F.regexp_extract(v, rf"^(\+(?:{CALLING})|[0-9]{{1,3}}[ .-]?(?=\())", 1), new)


def ipv4(v: Column, key: str) -> Column:
    def new(o: Column) -> Column:
        net = permuted_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
        text = let(net, lambda p: F.concat_ws(".", F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256))
        return F.when(F.array_max(o) < 256, text).otherwise(v)

    return let(F.transform(F.split(v, r"\."), lambda x: x.cast("int")), new)


def ipv6(v: Column, key: str) -> Column:
    """The hexadecimal digits of the groups, as many in each as before."""
    low = F.lower(v)
    return let(permuted(F.replace(low, F.lit(":"), F.lit("")), key, "ipv6", (HEX,)), lambda d: refilled(low, d, "[0-9a-f]"))


def iban(v: Column, key: str) -> Column:
    """The country stays, the account is permuted and gets new check digits."""

    def rest_of(account: Column, country: Column, check: Column) -> Column:
        text = F.concat(account, country, check)
        value = lambda c: F.position(c, F.lit(DIGITS + HIGH)) - 1
        return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), lambda s, i: let(value(text.substr(i, F.lit(1))), lambda x: (s * F.when(x > 9, 100).otherwise(10) + x) % 97))

    def new(c: Column) -> Column:
        country, account = c.substr(1, 2), c.substr(F.lit(5), F.length(c))
        moved = let(permuted(account, key, "iban", (DIGITS, HIGH)), lambda a: F.concat(country, F.lpad((98 - rest_of(a, country, F.lit("00"))).cast("string"), 2, "0"), a))
        return F.when(rest_of(account, country, c.substr(3, 2)) == 1, let(moved, lambda m: refilled(v, m, "[0-9A-Z]"))).otherwise(v)

    return let(F.replace(v, F.lit(" "), F.lit("")), new)


def ssn(v: Column, key: str) -> Column:
    given = lambda d: ~d.rlike("^(?:000|666|9)|^...00|0000$")

    def new(d: Column) -> Column:
        once = lambda x: permuted(x, key, "ssn")
        return F.when(given(d), let(walked(once(d), once, given), lambda m: refilled(v, m))).otherwise(v)

    return let(digits_of(v), new)


def day(v: Column, key: str) -> Column:
    """146,097 = 189 * 773 days make up the 400 years. Day before month, unless only the other order is a day: such days stay in it."""
    first = F.lit("1800-01-01").cast("date")
    read = lambda *at: F.concat_ws("-", *[v.substr(a, n) for a, n in at]).try_cast("date")

    def new(d: Column) -> Column:
        month_first = v.contains("/") & read((7, 4), (4, 2), (1, 2)).isNull()
        net = lambda at: let(permuted_pair(F.floor(at / 773), at % 773, 189, 773, key, "day"), lambda p: (p["a"] * 773 + p["b"]).cast("int"))
        text = lambda at: F.date_format(F.date_add(first, at), "yyyy-MM-dd")
        fits = lambda at: ~month_first | (F.dayofmonth(F.date_add(first, at)) > 12)
        at = F.datediff(d, first)
        order = lambda m: F.when(month_first, F.concat_ws("/", m.substr(6, 2), m.substr(9, 2), m.substr(1, 4))).when(v.contains("/"), F.concat_ws("/", m.substr(9, 2), m.substr(6, 2), m.substr(1, 4))).otherwise(m)
        out = let(text(walked(net(at), net, fits)), order)
        return F.when(at.between(0, 146_096), out).otherwise(v)

    plain = F.when(v.contains("/"), F.coalesce(read((7, 4), (4, 2), (1, 2)), read((7, 4), (1, 2), (4, 2)))).otherwise(v.try_cast("date"))
    return let(plain, new)


def email(v: Column, key: str) -> Column:
    local, domain = F.substring_index(v, "@", 1), F.substring_index(v, "@", -1)
    return F.concat(permuted(local, key, "email", (LOW, HIGH, DIGITS, LATIN, LATIN_HIGH), True), F.lit("@"), domain)


def secret(v: Column, key: str) -> Column:
    def new(head: Column) -> Column:
        rest = v.substr(F.length(head) + 1, F.length(v))
        return F.concat(head, F.when(rest.rlike("^[0-9a-f]+$"), permuted(rest, key, "hex", (HEX,))).otherwise(permuted(rest, key, "secret", (LOW, HIGH, DIGITS))))

    return let(F.regexp_extract(v, rf"^({DOTTED}|{HEADS}|{ASSIGNED})", 1), new)


KINDS = {"email": email, "secret": secret, "ip": ipv4, "ipv6": ipv6, "day": day, "ssn": ssn, "iban": iban, "phone": phone, "card": card}
_TELLS = {"email": "@", "secret": rf"^(?:{DOTTED}|{HEADS}|{ASSIGNED})", "ip": r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$", "ipv6": "^[0-9A-Fa-f]+:[0-9A-Fa-f:]+$", "day": r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})$", "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "iban": "^[A-Z]", "phone": r"^[+(]|^[0-9]{1,3}[ .-]?\(|^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$"}


def kind_of(v: Column) -> Column:
    out = F.lit("card")
    for kind, tell in reversed(_TELLS.items()):
        out = F.when(v.rlike(tell), kind).otherwise(out)
    return out


def pseudonym(v: Column, key: str) -> Column:
    """Of one candidate; itself if it isn't valid."""
    out = card(v, key)
    for kind, tell in reversed(_TELLS.items()):
        out = F.when(v.rlike(tell), KINDS[kind](v, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` under the caller's secret ``key``; ``count_col`` gets the number of values that changed."""
    text = F.col(text_col)
    suspect = text.rlike(ANY)
    found = "__found"
    while found in docs.columns:
        found += "_"
    out = docs.withColumn(found, F.when(suspect, F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda v: F.struct(v.alias("v"), pseudonym(v, key).alias("p")))))
    whole = F.array_join(F.zip_with(F.split(text, ANY, -1), F.col(found), lambda a, b: F.concat(a, F.coalesce(b["p"], F.lit("")))), "")
    changed = {text_col: F.when(F.col(found).isNull(), text).otherwise(whole)}
    if count_col:
        changed[count_col] = F.coalesce(F.size(F.filter(F.col(found), lambda x: x["v"] != x["p"])), F.lit(0))
    return out.withColumns(changed).drop(found)


def findings(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kind, value, pseudonym) of every candidate that is valid, once for each time it occurs."""
    text = F.col(text_col)
    one = docs.where(text.rlike(ANY)).select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("value"))
    one = one.select("id", kind_of(F.col("value")).alias("kind"), "value", pseudonym(F.col("value"), key).alias("pseudonym")).where("value <> pseudonym")
    return one.withColumnRenamed("id", id_col)
