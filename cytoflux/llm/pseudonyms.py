"""Format-preserving pseudonyms for personal data, as Spark columns only.

One pattern finds candidates; a candidate counts only if it is valid (check digits, ranges, calendar).
Numbers and dates are permuted within their format by a keyed Feistel network over two digit groups: halves take
turns in adding a keyed hash of the other half, modulo the size of their group, which is a permutation whatever the hash
is.  Where the format has rules, the check digit is computed anew, or the permutation goes on until it meets a valid value
(cycle walking), so it stays a permutation of the valid values: equal values stay equal in all
documents, different ones stay different.  A number with a foreign or unassigned prefix stays of its kind: those that the
numbering plan of +1 knows are permuted among themselves, all other international numbers of a length among themselves.  E-mail addresses and hexadecimal secrets get a keyed hash in their form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, unused

#: Steps of cycle walking; half of the values or more are valid in each format, so not to end in them has a chance under 2^-256 and is an error.
ROUNDS, WALKS = 8, 256

#: Candidates by kind; the order matters where two could start at one place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,}",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![\p{L}\p{N}])",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}|\d{2,4}[ .-]\d{3}[ .-]?\d{4}|\d{7,12})(?!\d)",
    "local phone": r"(?<![\d+(.-])(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[.-])[2-9]\d{2}[.-]\d{4}(?![\d.-]*\d)",
    "card": r"(?<!\d)(?:\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Countries' codes of one and of two digits; all others have three (fixed values of the international numbering plan).
ONE_DIGIT_CODES = "1|7"
TWO_DIGIT_CODES = "2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"


def _hash(key: str, kind: Column, turn: Column, value: Column) -> Column:
    """60 bits of SHA-256 of key, kind, turn and value."""
    text = F.concat(F.lit(f"{key}|"), kind, F.lit("|"), turn.cast("string"), F.lit("|"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str | Column, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """A keyed permutation of pairs a < size_a, b < size_b: a struct of the new ``a`` and ``b``."""
    kind = F.lit(kind) if isinstance(kind, str) else kind

    def turn(pair: Column, k: Column) -> Column:
        even = k % 2 == 0
        return F.struct(
            F.when(even, F.pmod(pair["a"] + F.pmod(_hash(key, kind, k, pair["b"]), size_a), size_a)).otherwise(pair["a"]).alias("a"),
            F.when(even, pair["b"]).otherwise(F.pmod(pair["b"] + F.pmod(_hash(key, kind, k, pair["a"]), size_b), size_b)).alias("b"),
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def with_value(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """A keyed permutation of the strings of 2 to 36 digits of each length; lengths have round functions of their own."""
    n = F.length(digits)
    of_length = F.concat(F.lit(f"{kind}/"), n.cast("string"))
    u = F.floor(n / 2).cast("int")
    size = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
    pair = feistel(key, of_length, F.substring(digits, F.lit(1), u), F.substring(digits, u + 1, n), size(u), size(n - u))
    return with_value(pair, lambda p: F.concat(F.lpad(p["a"].cast("string"), u, "0"), F.lpad(p["b"].cast("string"), n - u, "0")))


def walked(start: Column, step: Callable[[Column], Column], valid: Callable[[Column], Column], kind: str = "string") -> Column:
    """Steps from ``start``, one at least, until the value is valid; an error if WALKS steps do not get there."""

    def go(state: Column, _: Column) -> Column:
        return F.when(state["done"], state).otherwise(with_value(step(state["v"]), lambda v: F.struct(v.alias("v"), valid(v).alias("done"))))

    def end(state: Column) -> Column:
        return F.when(state["done"], state["v"]).otherwise(F.raise_error(F.lit("cycle walking met no valid value")).cast(kind))

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), F.struct(start.alias("v"), F.lit(False).alias("done")), go)
    return with_value(walk, end)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def refilled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in order."""
    def at(k: Column) -> Column:
        c = F.substring(form, k, F.lit(1))
        return F.when(c.rlike("[0-9]"), F.substring(digits, F.length(digits_of(F.substring(form, F.lit(1), k))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), at), "")


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Sum of a digit string where every second digit from the right is doubled, the last one too if ``doubled_last``."""
    n = F.length(digits)

    def add(total: Column, k: Column) -> Column:
        d = F.substring(digits, k, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - k) % 2 == (0 if doubled_last else 1), twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        body = permuted_digits(key, "card", F.substring(d, F.lit(1), F.length(d) - 1))
        whole = with_value(body, lambda b: F.concat(b, ((10 - luhn_sum(b, True) % 10) % 10).cast("string")))
        return F.when(luhn_sum(d, False) % 10 == 0, refilled(m, whole)).otherwise(m)

    return with_value(digits_of(m), new)


def in_plan(ten: Column) -> Column:
    """Whether ten digits are a number of the plan of +1: area and exchange begin with 2 to 9 and neither ends in 11."""
    return ten.rlike("^[2-9](?!11)[0-9]{2}[2-9](?!11)[0-9]{6}$")


def _phone(m: Column, key: str) -> Column:
    """All digits behind the country's code; the code stays, and so does being in the plan of +1 or not."""

    def new(d: Column) -> Column:
        n = F.when(d.rlike(f"^(?:{ONE_DIGIT_CODES})"), 1).when(d.rlike(f"^(?:{TWO_DIGIT_CODES})"), 2).otherwise(3)
        code, rest = F.substring(d, F.lit(1), n), F.substring(d, n + 1, F.length(d))
        # Being in the plan is kept only where the code is 1; other countries have plans of their own.
        planned = lambda x: (code == "1") & in_plan(x)

        def of_kind(x: Column, kind: str, wanted: bool) -> Column:
            return walked(x, lambda v: permuted_digits(key, kind, v), lambda v: planned(v) == F.lit(wanted))

        moved = lambda x: F.when(planned(x), of_kind(x, "planned phone", True)).otherwise(of_kind(x, "phone", False))
        return refilled(m, F.concat(code, with_value(rest, moved)))

    return with_value(digits_of(m), lambda d: F.when(F.length(d).between(8, 15), new(d)).otherwise(m))


def _local_phone(m: Column, key: str) -> Column:
    """Ten digits without a country's code, if the plan of +1 has them; the same number with +1 gets the same digits."""
    new = lambda d: refilled(m, walked(d, lambda v: permuted_digits(key, "planned phone", v), in_plan))
    return with_value(digits_of(m), lambda d: F.when(in_plan(d), new(d)).otherwise(m))


def _ssn(m: Column, key: str) -> Column:
    def valid(d: Column) -> Column:
        area, group, serial = F.substring(d, 1, 3), F.substring(d, 4, 2), F.substring(d, 6, 4)
        return ~(area.isin("000", "666") | (area >= "900") | (group == "00") | (serial == "0000"))

    new = lambda d: refilled(m, walked(d, lambda v: permuted_digits(key, "ssn", v), valid))
    return with_value(digits_of(m), lambda d: F.when(valid(d), new(d)).otherwise(m))


def _ip(m: Column, key: str) -> Column:
    def new(o: Column) -> Column:
        number = lambda k: F.element_at(o, k).cast("long")
        pair = feistel(key, "ip", number(1) * 256 + number(2), number(3) * 256 + number(4), F.lit(65536), F.lit(65536))
        text = lambda p: F.concat_ws(".", *[x.cast("string") for x in (F.shiftright(p["a"], 8), p["a"] % 256, F.shiftright(p["b"], 8), p["b"] % 256)])
        return F.when(F.forall(o, lambda x: x.cast("int") < 256), with_value(pair, text)).otherwise(m)

    return with_value(F.split(m, r"\."), new)


def _date(m: Column, key: str) -> Column:
    """Days from FIRST_DAY to LAST_DAY are permuted; others are no dates here.  Day before month where both orders are valid."""
    days = lambda x: F.datediff(x, F.lit(FIRST_DAY).cast("date")).cast("long")
    sides = (271, 270)  # the least such product that holds all days

    def new(form: str) -> Column:
        def made(d: Column) -> Column:
            span = days(F.lit(LAST_DAY).cast("date"))
            inside = lambda v: (v >= 0) & (v <= span)
            step = lambda v: with_value(feistel(key, "date", F.floor(v / sides[1]), v % sides[1], F.lit(sides[0]), F.lit(sides[1])), lambda p: p["a"] * sides[1] + p["b"])
            shown = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), walked(d, step, inside, "long").cast("int")), form)
            return F.when(inside(d), shown)

        return with_value(days(F.try_to_date(m, form)), made)

    return F.coalesce(
        F.when(m.rlike("^[0-9]{4}-"), new("yyyy-MM-dd")),
        F.when(m.rlike("/"), F.coalesce(new("dd/MM/yyyy"), new("MM/dd/yyyy"))),
        F.when(m.rlike(r"^[0-9]{2}\."), new("dd.MM.yyyy")),
        m,
    )


def _iban(m: Column, key: str) -> Column:
    """Digits of the account part are permuted; letters and the country stay; the check digits follow."""

    def rest(country_and_account: Column) -> Column:
        c = country_and_account
        value = lambda x: F.when(x.rlike("[0-9]"), x.cast("int")).otherwise(F.ascii(x) - 55)
        ordered = F.filter(F.split(F.concat(F.substring(c, F.lit(5), F.length(c)), F.substring(c, 1, 4)), ""), lambda x: x != "")
        return F.aggregate(ordered, F.lit(0), lambda total, x: with_value(value(x), lambda v: (total * F.when(v > 9, 100).otherwise(10) + v) % 97))

    def new(c: Column) -> Column:
        account = F.substring(c, F.lit(5), F.length(c))
        moved = with_value(digits_of(account), lambda d: F.when(F.length(d) > 1, refilled(account, permuted_digits(key, "iban", d))).otherwise(account))
        whole = with_value(moved, lambda a: F.concat(F.substring(c, 1, 2), F.lpad((98 - rest(F.concat(F.substring(c, 1, 2), F.lit("00"), a))).cast("string"), 2, "0"), a))
        spaced = with_value(whole, lambda w: F.when(m.contains(" "), F.array_join(F.regexp_extract_all(w, F.lit(".{1,4}"), F.lit(0)), " ")).otherwise(w))
        return F.when(rest(c) == 1, spaced).otherwise(m)

    return with_value(F.regexp_replace(m, " ", ""), new)


def _keyed(m: Column, key: str, kind: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), F.lower(m)).cast("binary"), 256)


def _secret(m: Column, key: str) -> Column:
    new = F.substring(_keyed(m, key, "secret"), F.lit(1), F.length(m))
    return F.when(m.rlike("[A-F]"), F.upper(new)).otherwise(new)


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("user-"), F.substring(_keyed(m, key, "email"), 1, 16), F.lit("@pseudonym.invalid"))


MAKERS = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "local phone": _local_phone, "card": _card}


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of a candidate, or the candidate itself where it is not valid."""
    out = found
    for kind in reversed(list(PATTERNS)):
        out = F.when(found.rlike(f"^(?:{PATTERNS[kind]})$"), MAKERS[kind](found, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """Replace personal data in a text column under a secret ``key``; with ``count``, append how many places changed.

    A projection: no shuffle, no Python on executors.  A null text stays null (0 places), other columns stay as they are, repeated rows
    and equal values get equal pseudonyms, rows are independent.  An input column named ``count`` is replaced.
    """
    old, new = unused(docs, "pii_old"), unused(docs, "pii_new")
    t = F.col(f"`{text}`")
    if not key:
        raise ValueError("pseudonyms need a key")
    marked = docs.withColumn(old, F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))))
    marked = marked.withColumn(new, F.when(F.size(old) > 0, F.transform(F.col(old), lambda m: pseudonym(m, key))))
    parts = F.zip_with(F.split(t, ANY, -1), F.concat(F.col(new), F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    changed = F.coalesce(F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x)), F.lit(0)) if count else None
    columns = [F.when(F.col(new).isNotNull(), F.array_join(parts, "")).otherwise(t).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c != count]
    return marked.select(*columns, *([F.greatest(changed, F.lit(0)).cast("long").alias(count)] if count else []))


#: The key of the registered query and of the pipeline over the test tables; real data need a secret one.
TEST_KEY = "a key for the test tables"


def op2_feistel_pseudonyms(spark, sf_dir):
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), TEST_KEY, count="n_replaced")
