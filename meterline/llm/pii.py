"""Format-preserving pseudonyms of personal numbers, dates and addresses, in built-in functions only.

A text is cut at everything that looks like a number, date or address. What is valid (Luhn digit, form of a phone
number, calendar) is mapped to two integers below a and b; a keyed Feistel network with additions modulo a and b
permutes all pairs; the pair is written in the same format. So each value of a class has one pseudonym of that
class, different values have different ones, and equal values stay linked across documents, however they are spaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What begins with digits, is no run of digits, spaces and dashes, and so must not lose its beginning to one.
_NO_RUN = "|".join(
    (
        r"[0-9]{2}([/.])[0-9]{2}\1[0-9]{4}(?![0-9])",
        r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
        r"[0-9]{3}(?:\.[0-9]{3}[ .-]|[ -][0-9]{3}\.)[0-9]{4}(?![0-9])",
        r"(?=[0-9._%+-]*[A-Za-z])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+\.[A-Za-z0-9-]",
    )
)
#: What may be personal, with nothing of the same kind on either side; validity is tested on the match.
PATTERN = "|".join(
    (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",  # mail address
        r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",  # IP address
        r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9])",
        r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",  # social security number
        r"(?<![0-9])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",  # phone number
        # digits over single spaces and dashes, up to where a date, address or dotted phone number begins: cards are within
        r"(?<![0-9])[0-9](?:[0-9]|[ -](?!" + _NO_RUN + r")[0-9]){12,}+",
    )
)
ROUNDS = 8
FIRST_DAY = "1900-01-01"
#: 271 x 270 days from the first, so that they are exactly the pairs of a Feistel network.
DAYS = (271, 270)
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
AMERICAN = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"
#: Day first, where the first number is no month. Days 13 and later alone, so they never meet those written month first.
DAY_FIRST = r"^(?:1[3-9]|2[0-9]|3[01])/(?:0[1-9]|1[0-2])/[0-9]{4}$"
#: 211 x 211 days with numbers from 13 on, to March 2101: all of them that DAYS holds, and more.
LATE_DAYS = (211, 211)
LAST_LATE_DAY = "2101-03-28"
EUROPEAN = r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$"
DATES = ((ISO, "yyyy-MM-dd"), (AMERICAN, "MM/dd/yyyy"), (DAY_FIRST, "dd/MM/yyyy"), (EUROPEAN, "dd.MM.yyyy"))
IP = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])$"
PHONE = r"^(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$"
SSN = r"^(?:00[1-9]|0[1-9][0-9]|[1-57-8][0-9]{2}|6(?:[0-57-9][0-9]|6[0-57-9]))-(?:0[1-9]|[1-9][0-9])-(?:000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})$"
CARD = r"^[0-9](?:[ -]?[0-9]){12,18}$"
RUN = r"^[0-9]+[ -][0-9 -]+$"
#: How cards are usually grouped.
USUAL = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}|[0-9]{4}([ -])[0-9]{4}\3[0-9]{5})$"


def _hash(key: str, *parts: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, tweak: Column, key: str, back: bool = False) -> Column:
    """A struct (l, r) with l below a and r below b: a keyed permutation of all such pairs, or its inverse."""

    def step(x: Column, i: Column) -> Column:
        n, j = F.lit(1), F.lit(ROUNDS + 1) - i if back else i
        n = F.lit(-1 if back else 1)
        on_left = F.struct(
            F.pmod(x["l"] + n * F.pmod(_hash(key, tweak, j, x["r"]), a), a).alias("l"), x["r"].alias("r")
        )
        on_right = F.struct(
            x["l"].alias("l"), F.pmod(x["r"] + n * F.pmod(_hash(key, tweak, j, x["l"]), b), b).alias("r")
        )
        return F.when(j % 2 == 1, on_left).otherwise(on_right)

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled and reduced, beginning with the last."""
    marks = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    weighed = F.transform(
        marks, lambda c, i: F.when(i % 2 == 0, F.pmod(c.cast("int") * 2, F.lit(10)) + (c >= "5").cast("int")).otherwise(c.cast("int"))
    )
    return F.aggregate(weighed, F.lit(0), lambda s, x: s + x)


def luhn_digit(payload: Column) -> Column:
    return F.pmod(-_luhn_sum(payload), F.lit(10)).cast("string")


def _refill(form: Column, digits: Column) -> Column:
    """The form with its digits replaced, in order, by those given."""
    filled = F.aggregate(
        F.split(form, ""),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, c: F.when(
            c.rlike("^[0-9]$"),
            F.struct(F.concat(s["out"], F.substring(digits, s["at"] + 1, F.lit(1))).alias("out"), (s["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
    )
    return filled["out"]


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _long(digits: Column, at: int, n: int) -> Column:
    return F.substring(digits, at, n).cast("long")


def _card(m: Column, key: str) -> Column:
    """The first digit stays, the check digit is made anew, the digits between are permuted."""
    d = _digits(m)
    n = F.length(d) - 2
    half = F.floor(n / 2).cast("int")
    left, right = F.substring(d, F.lit(2), half), F.substring(d, half + 2, n - half)
    out = feistel(left, right, F.pow(F.lit(10), half).cast("long"), F.pow(F.lit(10), n - half).cast("long"), F.concat(F.lit("card"), n.cast("string")), key)
    payload = F.concat(F.substring(d, 1, 1), _padded(out["l"], half), _padded(out["r"], n - half))
    return _refill(m, F.concat(payload, luhn_digit(payload)))


def _phone(m: Column, key: str) -> Column:
    """Numbers of the plan (area and exchange codes 200 to 999) and all others are permuted apart; a country code stays."""
    d = _digits(m)
    own = F.substring(d, -10, 10)
    area, exchange = _long(own, 1, 3), _long(own, 4, 3)
    plan = (area >= 200) & (exchange >= 200)
    # off the plan: 200 x 1000 pairs with a low area code, then 800 x 200 with a low exchange code only
    left = (
        F.when(plan, (area - 200) * 800 + exchange - 200)
        .when(area < 200, area * 1000 + exchange)
        .otherwise(200_000 + (area - 200) * 200 + exchange)
    )
    a, tweak = F.when(plan, 640_000).otherwise(360_000), F.when(plan, "phone").otherwise("phone off plan")
    out = feistel(left, _long(own, 7, 4), a, F.lit(10_000), tweak, key)
    high = out["l"] - 200_000
    codes = (
        F.when(plan, F.floor(out["l"] / 800) * 1000 + 200_000 + out["l"] % 800 + 200)
        .when(high < 0, out["l"])
        .otherwise(F.floor(high / 200) * 1000 + 200_000 + high % 200)
    )
    new = F.concat(_padded(codes, 6), _padded(out["r"], 4))
    return _refill(m, F.concat(F.when(F.length(d) == 11, F.substring(d, 1, 1)).otherwise(""), new))


def _ssn(m: Column, key: str) -> Column:
    d = _digits(m)
    area = _long(d, 1, 3)
    left = (area - 1 - (area > 666).cast("long")) * 99 + _long(d, 4, 2) - 1
    out = feistel(left, _long(d, 6, 4) - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key)
    number = F.floor(out["l"] / 99) + 1
    number = number + (number >= 666).cast("long")
    return F.concat_ws("-", _padded(number, 3), _padded(out["l"] % 99 + 1, 2), _padded(out["r"] + 1, 4))


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    out = feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), F.lit("ip"), key)
    return F.concat_ws(".", *(x.cast("string") for h in ("l", "r") for x in (F.floor(out[h] / 256), out[h] % 256)))


def _day(m: Column, form: str) -> Column:
    """Number of the day if the text is a date in range, else null."""
    day = F.date_diff(F.try_to_timestamp(m, F.lit(form)).cast("date"), F.lit(FIRST_DAY).cast("date"))
    last = F.date_diff(F.lit(LAST_LATE_DAY).cast("date"), F.lit(FIRST_DAY).cast("date")) if form == "dd/MM/yyyy" else DAYS[0] * DAYS[1] - 1
    return F.when(day.between(0, last), day)


def _date(m: Column, form: str, key: str) -> Column:
    if form == "dd/MM/yyyy":
        return _day_first(m, form, key)
    day = _day(m, form)
    out = feistel(F.floor(day / DAYS[1]), day % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), F.lit("date"), key)
    return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (out["l"] * DAYS[1] + out["r"]).cast("int")), form)


def _late_days_before(month: Column) -> Column:
    """How many days with numbers from 13 on lie before a month, counted from that of the first day."""
    first = F.lit(FIRST_DAY).cast("date")
    return F.date_diff(F.add_months(first, month), first) - 12 * month


def _late_day(n: Column) -> Column:
    """The n-th day (from 0) with a number from 13 on."""
    about = F.floor(n / (30.436875 - 12)).cast("int")
    month = F.array_max(F.filter(F.sequence(about - 2, about + 2), lambda k: _late_days_before(k) <= n))
    at = F.transform(F.array(month), lambda k: F.date_add(F.add_months(F.lit(FIRST_DAY).cast("date"), k), (n - _late_days_before(k)).cast("int") + 12))
    return F.element_at(at, 1)


def _day_first(m: Column, form: str, key: str) -> Column:
    """Days with numbers from 13 on are permuted among themselves, so no pseudonym can be read month first."""
    day = F.try_to_timestamp(m, F.lit(form)).cast("date")
    first = F.lit(FIRST_DAY).cast("date")
    n = F.date_diff(day, first) - 12 * (F.months_between(F.trunc(day, "month"), first).cast("int") + 1)
    out = feistel(F.floor(n / LATE_DAYS[1]), n % LATE_DAYS[1], F.lit(LATE_DAYS[0]), F.lit(LATE_DAYS[1]), F.lit("day first"), key)
    return F.date_format(_late_day((out["l"] * LATE_DAYS[1] + out["r"]).cast("int")), form)


def _shifted(part: Column, other: Column, key: str, i: Column) -> Column:
    """Letters and digits moved within their kind by a key stream made from the other half."""

    def move(c: Column, at: Column) -> Column:
        by = _hash(key, F.lit("mail"), i, at, other)

        def within(first: str, n: int) -> Column:
            return F.char(F.pmod(F.ascii(c) - ord(first) + by, F.lit(n)) + ord(first))

        return (
            F.when(c.rlike("^[0-9]$"), within("0", 10))
            .when(c.rlike("^[a-z]$"), within("a", 26))
            .when(c.rlike("^[A-Z]$"), within("A", 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(part, ""), move), "")


def _mail(m: Column, key: str) -> Column:
    """The part before the @ is permuted, the domain stays: an alphabetic Feistel network over its halves."""
    own = F.substring_index(m, "@", 1)
    half = F.floor(F.length(own) / 2).cast("int")
    start = F.struct(F.substring(own, F.lit(1), half).alias("l"), F.substring(own, half + 1, F.length(own)).alias("r"))
    out = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda x, i: F.when(i % 2 == 1, F.struct(x["l"].alias("l"), _shifted(x["r"], x["l"], key, i).alias("r"))).otherwise(
            F.struct(_shifted(x["l"], x["r"], key, i).alias("l"), x["r"].alias("r"))
        ),
    )
    return F.concat(out["l"], out["r"], F.lit("@"), F.substring_index(m, "@", -1))


def kind_of(m: Column) -> Column:
    """The class of a match, or null if it is not valid as any."""
    kind = F.when(F.contains(m, F.lit("@")), "mail").when(m.rlike(IP), "ip")
    for pattern, form in DATES:
        kind = kind.when(m.rlike(pattern) & _day(m, form).isNotNull(), "date")
    kind = kind.when(m.rlike(SSN), "ssn").when(m.rlike(PHONE), "phone")
    return kind.when(m.rlike(CARD) & (F.pmod(_luhn_sum(F.concat(_digits(m), F.lit("0"))), F.lit(10)) == 0), "card")


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a match; what is not valid comes back as it is."""
    kind = kind_of(m)
    dated = F.coalesce(*(F.when(m.rlike(p), _date(m, form, key)) for p, form in DATES))
    return (
        F.when(kind == "mail", _mail(m, key))
        .when(kind == "ip", _ip(m, key))
        .when(kind == "date", dated)
        .when(kind == "ssn", _ssn(m, key))
        .when(kind == "phone", _phone(m, key))
        .when(kind == "card", _card(m, key))
        .otherwise(m)
    )


def _values_within(m: Column) -> Column:
    """Where a run of digits has values on borders of its groups: structs (start, stop), apart from each other, in order.

    Of values that overlap, a card as cards are usually grouped goes first, then the whole run, then dates, social security
    and phone numbers, then any other card; of the same sort the longer one, then the first.
    """
    groups = F.split(m, "[ -]")
    starts = F.aggregate(
        groups, F.array(F.lit(0)), lambda s, g: F.concat(s, F.array(F.element_at(s, -1) + F.length(g) + 1))
    )  # one more than groups

    def among(starts: Column) -> Column:
        n = F.size(starts) - 1

        def span(i: Column, j: Column) -> Column:
            start, stop = F.get(starts, i), F.get(starts, j) - 1
            return F.struct(start.alias("start"), stop.alias("stop"), (stop - start - (j - i - 1)).alias("digits"))

        spans = F.flatten(
            F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: F.transform(F.sequence(i + 1, F.least(i + 19, n)), lambda j: span(i, j)),
            )
        )
        spans = F.filter(spans, lambda s: s["digits"].between(8, 19))

        def known(s: Column) -> Column:
            own = F.substring(m, s["start"] + 1, s["stop"] - s["start"])
            usual, whole = own.rlike(USUAL), (s["start"] == 0) & (s["stop"] == F.length(m))
            return F.struct(s["digits"].alias("digits"), s["start"].alias("start"), s["stop"].alias("stop"), usual.alias("usual"), whole.alias("whole"), kind_of(own).alias("kind"))

        def ranked(s: Column) -> Column:
            card = s["kind"] == "card"
            rank = F.when(card & s["usual"], 0).when(s["whole"], 1).when(~card, 2).otherwise(3)
            return F.struct(rank.alias("rank"), (-s["digits"]).alias("digits"), s["start"].alias("start"), s["stop"].alias("stop"))

        values = F.filter(F.transform(spans, known), lambda s: s["kind"].isNotNull())
        return F.array_sort(F.transform(values, ranked))

    candidates = F.flatten(F.transform(F.array(starts), among))
    at = lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))
    apart = F.aggregate(
        candidates,
        F.array().cast("array<struct<start:int,stop:int>>"),
        lambda kept, s: F.when(F.exists(kept, lambda k: (k["start"] < s["stop"]) & (s["start"] < k["stop"])), kept).otherwise(
            F.concat(kept, F.array(at(s)))
        ),
    )
    return F.array_sort(apart)


def _parts(m: Column) -> Column:
    """A match cut in texts of which each is a value as a whole or holds none. They make up the match."""

    def cut(spans: Column) -> Column:
        ends = F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["stop"])))
        return F.zip_with(
            F.concat(F.array(F.lit(0)), ends),
            F.concat(ends, F.array(F.length(m))),
            lambda a, b: F.substring(m, a + 1, b - a),
        )

    within = F.flatten(F.transform(F.array(_values_within(m)), cut))
    return F.when(m.rlike(RUN) & (F.length(_digits(m)) > 12), within).otherwise(F.array(m))


def _matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def found(text: Column) -> Column:
    """What may be personal, in order; a run of digits is cut around the values in it."""
    return F.flatten(F.transform(_matches(text), _parts))


def pseudonymised(text: Column, key: str) -> Column:
    """The text with every valid personal value replaced. Null stays null, all other characters stay as they are."""
    whole = F.zip_with(
        F.split(text, PATTERN, -1),
        F.transform(_matches(text), lambda m: F.array_join(F.transform(_parts(m), lambda p: pseudonym(p, key)), "")),
        lambda between, new: F.concat(between, F.coalesce(new, F.lit(""))),
    )
    return F.when(text.rlike(PATTERN), F.array_join(whole, "")).otherwise(text)


def pseudonymise(documents: DataFrame, key: str) -> DataFrame:
    """The same rows and columns with `text` replaced, and `n_chars` counted anew if there is one.

    Null and empty texts, repeated rows and further columns come back unchanged; a null n_chars stays null.
    """
    new = {"text": pseudonymised(F.col("text"), key)}
    out = documents.withColumns(new)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        counted = F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(kind))
        out = out.withColumn("n_chars", F.coalesce(counted, F.col("n_chars")))
    return out
