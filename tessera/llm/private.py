"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

Telephone, card and social security numbers, IP addresses and dates are found
by pattern and validated (check digit, ranges, calendar). Each is numbered within
the set of valid values of its format, and permuted there by a Feistel network
keyed with a secret: ten rounds of adding a keyed digest of one half to the
other, modulo the sizes of the halves, whose product is that of the set. A
permutation sends equal values to equal pseudonyms and different ones to
different ones, so values stay linked across documents whatever their
punctuation, and whoever has the key can undo it. Card numbers keep a right
check digit, dates stay dates, social security numbers valid ones. An e-mail
address has no fixed format; its name is replaced by a keyed digest.

Telephone numbers are found as groups of 3, 3 and 4 digits with or without a
country code, and in other groups after a plus sign; card numbers unbroken or in
the groups they are printed in, with what else stands beside them left alone.

All of it is column expressions: a text is split at what was found, each find
is rewritten, and the text is joined again. The key comes from a subquery, so
that plans and event logs don't show it.

Defined results: a null text stays null with no finds; what fails validation
is left as it is; repeated rows return repeated rows; an empty table returns no
rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let

ROUNDS = 10
KINDS = ("email", "ip", "date", "ssn", "phone", "card")
#: Telephone numbers of 3, 3 and 4 digits, and those after a plus sign in other groups.
GROUPED = r"(?<![0-9+-])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"
INTERNATIONAL = r"(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?[0-9]{1,4}|[ .-]?\([0-9]{1,4}\)){2,6}(?![0-9])"
#: Finds by kind; each stands between characters that can't continue it.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[\p{L}0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "date": r"(?<![0-9-])(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9-])|(?<![0-9/.])[0-3][0-9][/.][01][0-9][/.](?:19|20)[0-9]{2}(?![0-9/])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": f"{GROUPED}|{INTERNATIONAL}",
    "card": r"(?<![0-9-])(?:[0-9]{4}([ -])[0-9]{4}(?:\1[0-9]{4}){2}(?:\1[0-9]{3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{13,19})(?![0-9-])",
}
ANY = "|".join(PATTERNS[k] for k in KINDS)
#: Every find has an @, or a digit before one of these.
MAY = r"@|[0-9][0-9./ ()-]"
#: The days of the years 19xx and 20xx, as the product of two halves.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)
#: Areas of social security numbers: 001 to 899 without 666; groups and serials above nil.
AREAS, GROUPS, SERIALS = 898, 99, 9999


def _digest(key: Column | str, *parts: Column) -> Column:
    """A keyed digest as a whole number below 16^13."""
    text = F.concat_ws(":", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 13), 16, 10).cast("long")


def _power_of_ten(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**i).cast("long") for i in range(0, 13)]), n.cast("int") + 1)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: Column | str, tag: str) -> Column:
    """struct(a, b): the permuted halves, where left < left_size and right <
    right_size. Rounds alternate between the halves."""

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        a = F.when(even, (s["a"] + _digest(key, F.lit(tag), i, s["b"])) % left_size).otherwise(s["a"])
        b = F.when(even, s["b"]).otherwise((s["b"] + _digest(key, F.lit(tag), i, s["a"])) % right_size)
        return F.struct(a.alias("a"), b.alias("b"))

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permuted_digits(digits: Column, key: Column | str, tag: str) -> Column:
    """A string of 2 to 24 digits, permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    halves = feistel(F.substring(digits, F.lit(1), u), F.substring(digits, u + 1, n - u), _power_of_ten(u), _power_of_ten(n - u), key, tag)
    return let(halves, lambda h: F.concat(F.lpad(h["a"].cast("string"), u, "0"), F.lpad(h["b"].cast("string"), n - u, "0")))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refilled(m: Column, digits: Column) -> Column:
    """m with its digits replaced, one by one, by those given."""
    gaps = F.split(m, "[0-9]", -1)
    return let(F.split(digits, ""), lambda d: F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(d, i), F.lit("")))), ""))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of digits, the last of which is the check digit."""

    def part(d: Column, i: Column) -> Column:
        v = d.cast("int") * (1 + i % 2)
        return F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), part), F.lit(0), lambda a, x: a + x)


def _card(m: Column, key: Column | str) -> Column:
    """The card that m holds, permuted: all its digits, or else the first sixteen
    in groups of four, when a number beside them has been taken for a part."""

    def changed(d: Column) -> Column:
        body = permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        return let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))

    def of(d: Column) -> Column:
        first = F.substring(d, 1, 16)
        inside = (F.length(d) > 16) & m.rlike("^[0-9]{4}[ -]") & (luhn_sum(first) % 10 == 0)
        return F.when(luhn_sum(d) % 10 == 0, _refilled(m, changed(d))).when(inside, _refilled(m, F.concat(changed(first), F.substring(d, F.lit(17), F.length(d))))).otherwise(m)

    return let(_digits(m), of)


def _ip(m: Column, key: Column | str) -> Column:
    def changed(o: Column) -> Column:
        halves = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip")
        return let(halves, lambda h: F.concat_ws(".", *[x.cast("string") for x in (F.floor(h["a"] / 256), h["a"] % 256, F.floor(h["b"] / 256), h["b"] % 256)]))

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), lambda o: F.when(F.array_max(o) < 256, changed(o)).otherwise(m))


def _date(m: Column, key: Column | str) -> Column:
    iso = F.substring(m, 5, 1) == "-"
    day = F.when(iso, m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    first = F.lit(FIRST_DAY).cast("date")
    n = F.datediff(F.try_to_date(day, "yyyy-MM-dd"), first)

    def changed(k: Column) -> Column:
        halves = feistel(F.floor(k / DAYS[1]), k % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date")
        new = let(halves, lambda h: F.date_add(first, (h["a"] * DAYS[1] + h["b"]).cast("int")))
        sep = F.substring(m, 3, 1)
        return let(new, lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat_ws("", F.date_format(d, "dd"), sep, F.date_format(d, "MM"), sep, F.date_format(d, "yyyy"))))

    return let(n, lambda k: F.when(k.between(0, DAYS[0] * DAYS[1] - 1), changed(k)).otherwise(m))


def _phone(m: Column, key: Column | str) -> Column:
    """The last ten digits of 3, 3 and 4 are permuted, so that a country code
    before them stays; of other groups all but the first three digits."""
    grouped = m.rlike(f"^(?:{GROUPED})$")

    def of(d: Column) -> Column:
        keep = F.when(grouped, F.length(d) - 10).otherwise(3)
        new = F.concat(F.substring(d, F.lit(1), keep), permuted_digits(F.substring(d, keep + 1, F.length(d) - keep), key, "phone"))
        return F.when(grouped | F.length(d).between(8, 15), _refilled(m, new)).otherwise(m)

    return let(_digits(m), of)


def _ssn(m: Column, key: Column | str) -> Column:
    area, group, serial = (F.substring(m, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    nth = area - 1 - (area > 666).cast("long")
    halves = feistel(nth * GROUPS + group - 1, serial - 1, F.lit(AREAS * GROUPS), F.lit(SERIALS), key, "ssn")

    def told(h: Column) -> Column:
        at = F.floor(h["a"] / GROUPS) + 1
        parts = ((at + (at > 665).cast("long"), 3), (h["a"] % GROUPS + 1, 2), (h["b"] + 1, 4))
        return F.concat_ws("-", *[F.lpad(v.cast("string"), n, "0") for v, n in parts])

    return F.when(valid, let(halves, told)).otherwise(m)


def _email(m: Column, key: Column | str) -> Column:
    name, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    return F.concat(F.lit("u"), F.lpad(F.lower(F.hex(_digest(key, F.lit("email"), F.lower(name), F.lower(domain)))), 13, "0"), F.lit("@"), domain)


_RULES = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def kind_of(m: Column) -> Column:
    return F.coalesce(*[F.when(m.rlike(f"^(?:{PATTERNS[k]})$"), F.lit(k)) for k in KINDS])


def pseudonym(m: Column, key: Column | str) -> Column:
    def of(kind: Column) -> Column:
        out = m
        for k in reversed(KINDS):
            out = F.when(kind == k, _RULES[k](m, key)).otherwise(out)
        return out

    return let(kind_of(m), of)


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (rewritten), finds: array of (kind, value, pseudonym)."""
    secret = docs.sparkSession.createDataFrame([(key,)], "key string").scalar()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("key", secret)
    finds = F.when(F.col("text").rlike(MAY), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).otherwise(F.expr("cast(array() as array<string>)"))
    rows = rows.withColumn("found", finds)
    changed = F.transform("found", lambda m: F.struct(kind_of(m).alias("kind"), m.alias("value"), pseudonym(m, F.col("key")).alias("pseudonym")))
    rows = rows.withColumn("all", F.when(F.size("found") > 0, changed))
    between = F.split("text", ANY, -1)
    text = F.when(F.size("found") > 0, F.array_join(F.transform(between, lambda g, i: F.concat(g, F.coalesce(F.get("all", i)["pseudonym"], F.lit("")))), "")).otherwise(F.col("text"))
    kept = F.coalesce(F.filter("all", lambda x: x["value"] != x["pseudonym"]), F.expr("cast(array() as array<struct<kind: string, value: string, pseudonym: string>>)"))
    return rows.select("doc_id", text.alias("text"), kept.alias("finds"))
