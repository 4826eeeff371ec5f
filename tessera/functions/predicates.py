"""Column expressions: missing values, classifications, validity, tolerances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_present(*cols: str | Column) -> Column:
    """The first that is not null; zero is a value."""
    return F.coalesce(*map(col, cols))


def first_truthy(*cols: str | Column) -> Column:
    """The first that is neither null nor zero, else the last as it is."""
    *head, last = map(col, cols)
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in head], last)


def zero_as_null(c: str | Column) -> Column:
    return F.nullif(col(c).cast("double"), F.lit(0.0))


def lag_class(accepted: str | Column, period_end: str | Column, missing_up_to: int = 10, release_up_to: int = 25, filing_up_to: int = 200) -> Column:
    """How long after the period a statement became public: missing (no date, or
    too soon to be true), release, filing or delinquent."""
    days = F.datediff(col(accepted), col(period_end))
    return F.when(days.isNull() | (days <= missing_up_to), "missing").when(days <= release_up_to, "release").when(days <= filing_up_to, "filing").otherwise("delinquent")


def split_ratio(numerator: str | Column, denominator: str | Column, label: str | Column) -> Column:
    """numerator / denominator, or else what a label such as 3:2, 3/2 or 3-2 says."""
    given = F.try_divide(F.nullif(col(numerator).cast("double"), F.lit(0.0)), F.nullif(col(denominator).cast("double"), F.lit(0.0)))
    parts = F.split(col(label), "[:/-]")
    part = lambda i: F.trim(F.get(parts, F.lit(i))).try_cast("double")
    return F.coalesce(given, F.try_divide(part(0), F.nullif(part(1), F.lit(0.0))))


#: Suffixes that mark instruments other than common shares (fixed values).
SUFFIXES = r"-(P[A-Z]?|UN|WS|WT|R|U)$"


def not_common(symbol: str | Column) -> Column:
    s = col(symbol)
    return s.rlike(SUFFIXES) | ((F.length(s) == 5) & F.substring(s, 5, 1).isin("U", "W", "R"))


def instrument_class(symbol: str | Column) -> Column:
    s = col(symbol)
    last = F.substring(s, 5, 1)
    five = F.length(s) == 5
    return F.when(s.rlike(SUFFIXES), "suffix").when(five & (last == "U"), "5U").when(five & (last == "W"), "5W").when(five & (last == "R"), "5R").otherwise("common?")


def listed(exchange: str | Column) -> Column:
    return F.coalesce(F.upper(col(exchange)).rlike("NYSE|NASDAQ|AMEX"), F.lit(False))


def same_issuer(a: str | Column, b: str | Column) -> Column:
    """False only if both ids are given and differ after leading zeros."""
    x, y = F.nullif(F.ltrim(F.trim(col(a)), F.lit("0")), F.lit("")), F.nullif(F.ltrim(F.trim(col(b)), F.lit("0")), F.lit(""))
    return F.coalesce(x == y, F.lit(True))


def padded_id(c: str | Column, width: int = 10) -> Column:
    return F.lpad(F.ltrim(col(c), F.lit("0")), width, "0")


def covers(valid_from: str | Column, valid_to: str | Column, t: str | Column) -> Column:
    """Whether a closed interval, open if it has no end, holds t."""
    return (col(valid_from) <= col(t)) & (col(valid_to).isNull() | (col(valid_to) >= col(t)))


def visible(accepted: str | Column, as_of: str | Column, hour: int = 16) -> Column:
    """Public by the close of as_of; what has no time of acceptance is not."""
    return F.coalesce(col(accepted) <= col(as_of).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(hour)), F.lit(False))


def financial(sector: str | Column) -> Column:
    return F.lower(F.coalesce(col(sector), F.lit("unknown"))).contains("financ")


def not_past(fiscal_date: str | Column, today: str | Column) -> Column:
    """Whether an estimate is for the running year or a later one."""
    return col(fiscal_date) >= F.trunc(col(today), "YEAR")


def off_tolerance(ours: Column, theirs: Column, our_price: Column, their_price: Column, flat: float = 0.001, tick: float = 0.011) -> Column:
    """Whether two returns differ by more than quantised prices explain."""
    return F.abs(ours - theirs) > F.greatest(F.lit(flat), F.lit(tick) / our_price, F.lit(tick) / their_price)


def seam(ours: Column, theirs: Column, split: Column, jump: float = 2.0, apart: float = 1.5) -> Column:
    """A return that only a missing split can explain: take the other series'."""
    return (F.abs(ours) > jump) & split.isNull() & (F.abs(ours - theirs) > apart)


def other_insane(ours: Column, theirs: Column) -> Column:
    return (F.abs(theirs) > 1) & (F.abs(ours) < 0.2)


def bucket_of_match(pct: str | Column) -> Column:
    p = col(pct)
    return F.when(p.isNull(), "no-oracle").when(p >= 99, "99+").when(p >= 95, "95-99").otherwise("<95")


def near(a: Column, b: Column, floor: float, share: float) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(floor), share * F.abs(b))


def restatement_tag(value: Column, original: Column, latest: Column, floor: float, share: float) -> Column:
    """Which reported figure a vendor's value repeats."""
    restated = ~near(original, latest, floor, share)
    return (
        F.when(~restated & near(value, latest, floor, share), "unrestated")
        .when(restated & near(value, original, floor, share), "original")
        .when(restated & near(value, latest, floor, share), "restated")
        .otherwise("neither")
    )


def iso_week(d: str | Column) -> Column:
    """YYYY-Www of the ISO calendar."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), col(d)).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(col(d)).cast("string"), 2, "0"))


def canonical_hash(pairs: dict[str, Column], length: int = 16) -> Column:
    """Leading hex digits of SHA-256 over key=value pairs in order of key; a
    null is written out, so it differs from an absent key."""
    text = F.concat_ws("|", *[F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("null"))) for k, v in sorted(pairs.items())])
    return F.substring(F.sha2(text, 256), 1, length)
