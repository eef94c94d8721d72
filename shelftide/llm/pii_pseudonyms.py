"""Format-preserving pseudonyms of personal data, in DataFrame functions only.

Card and account numbers (validated by their check digits), social security numbers, phone numbers, IPv4
addresses, e-mail addresses and dates are found in the text and replaced by values of the same format. A value's digits
are permuted by a keyed Feistel network: the digits are cut in two halves, and every round adds
a keyed hash of one half to the other, modulo a power of ten. That is a bijection of all numbers
of that length, so equal values get equal pseudonyms in every document (links stay), different values
different ones, and who holds the key can go back. Where not every number is valid (octets,
days of a month, check digits) the permutation runs on the ranks of the valid values, walking on
until it falls inside again (cycle walking), or the check digit is computed anew.

Separators, the country code and everything else stay. The hash is SHA-256 over the key, the kind,
the round and the half.

Defined results: NULL and empty texts stay as they are; a number that fails validation stays; the
same value is replaced wherever it stands, also in repeated documents. Very long texts are one pass each; a mail
domain has at most 127 labels, so no text makes the patterns recurse deeper than that. A column of the input that has
the name of the count gives way to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import unused_name

ROUNDS = 8
# First day number and count of days that dates are permuted in (1900-01-01 to 2099-12-31).
FIRST_DAY = "1900-01-01"
DAYS = 73049

CARD = (
    r"(?<![0-9A-Za-z.+-])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9A-Za-z])|(?:[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{13,19})(?![0-9A-Za-z]))"
)
# With a country code; the separator is the same between all groups, or there is none.
ABROAD = r"\+[0-9]{1,3}(?: \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])|(?: (?:\([0-9]{1,4}\)|[0-9]{1,4})(?: [0-9]{2,8}){1,4}|-[0-9]{1,4}(?:-[0-9]{2,8}){1,4}|[.][0-9]{1,4}(?:[.][0-9]{2,8}){1,4}|[0-9]{6,12})(?![0-9A-Za-z]|[./-][0-9]))"
NATIONAL = r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?[0-9]{3}[ .-]|[0-9]{3}-[0-9]{3}-|[0-9]{3}[.][0-9]{3}[.])[0-9]{4}(?![0-9A-Za-z]|[./-][0-9])"
PHONE = f"{ABROAD}|{NATIONAL}"
ADDRESS = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z])(?!\.[0-9])"
DATE = (
    r"(?<![0-9A-Za-z./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}[.][0-9]{2}[.](?:19|20)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})"
    r"(?![0-9A-Za-z])(?![./-][0-9])"
)
MAIL = r"(?<![0-9A-Za-z._%+-])[0-9A-Za-z][0-9A-Za-z._%+-]{0,63}@[0-9A-Za-z](?:[0-9A-Za-z-]{0,62}\.){1,126}[A-Za-z]{2,24}(?![0-9A-Za-z])"
# Social security numbers (American), and international account numbers: solid, or in fours with blanks between.
SOCIAL = r"(?<![0-9A-Za-z.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|[./-][0-9])"
ACCOUNT = r"(?<![0-9A-Za-z.+-])[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)(?![0-9A-Za-z])"
FOUND = "|".join((MAIL, PHONE, DATE, ADDRESS, SOCIAL, ACCOUNT, CARD))
# Areas that no social security number has, beside 900 and above.
NO_AREAS = (0, 666)


@dataclass(frozen=True)
class PseudonymParams:
    """The key is a secret of the caller; the default is for tests only."""

    key: str = "change-me"
    rounds: int = ROUNDS


def feistel(number: Column, left_size: int, right_size: int, params: PseudonymParams, kind: str, forward: bool = True) -> Column:
    """The keyed permutation of numbers below ``left_size`` * ``right_size``. Even rounds change
    the left part, odd rounds the right one; backwards the rounds run in reverse with subtraction."""
    state = F.struct(F.rint((number - number % right_size) / F.lit(right_size)).cast("long").alias("l"), (number % right_size).alias("r"))
    turns = F.array(*[F.lit(t) for t in (range(params.rounds) if forward else reversed(range(params.rounds)))])
    sign = 1 if forward else -1

    def turn(s: Column, t: Column) -> Column:
        seed = F.concat(F.lit(f"{params.key}|{kind}|"), t.cast("string"), F.lit("|"), F.when(t % 2 == 0, s["r"]).otherwise(s["l"]).cast("string"))
        drawn = F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10).cast("long")
        return F.struct(
            F.when(t % 2 == 0, F.pmod(s["l"] + sign * (drawn % left_size), F.lit(left_size))).otherwise(s["l"]).cast("long").alias("l"),
            F.when(t % 2 == 1, F.pmod(s["r"] + sign * (drawn % right_size), F.lit(right_size))).otherwise(s["r"]).cast("long").alias("r"),
        )

    return F.aggregate(turns, state, turn, lambda s: s["l"] * F.lit(right_size) + s["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column, odd_doubled: bool) -> Column:
    """Sum of digits where every second one, counted from the right, is doubled."""
    places = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda k: F.substring(F.reverse(digits), k, F.lit(1)).cast("int") * F.when((k % 2 == 1) == F.lit(odd_doubled), 2).otherwise(1),
    )
    return F.aggregate(places, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order; everything else stays."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.length(value)),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
        lambda s, k: F.when(
            F.substring(value, k, F.lit(1)).between("0", "9"),
            F.struct(F.concat(s["out"], F.substring(digits, s["next"], F.lit(1))).alias("out"), (s["next"] + 1).alias("next")),
        ).otherwise(F.struct(F.concat(s["out"], F.substring(value, k, F.lit(1))).alias("out"), s["next"].alias("next"))),
        lambda s: s["out"],
    )
    return step


def _moved(digits: Column, params: PseudonymParams, kind: str, forward: bool) -> Column:
    """The permutation of all numbers of as many digits (18 at most)."""
    tens = F.array(*[F.lit(10**k).cast("long") for k in range(10)])
    power = lambda k: F.element_at(tens, (k + 1).cast("int"))
    n = F.length(digits)
    left, right = power(F.floor(n / 2)), power(F.ceil(n / 2))
    return F.lpad(feistel(digits.cast("long"), left, right, params, kind, forward).cast("string"), n, F.lit("0"))


def _card(value: Column, params: PseudonymParams, forward: bool) -> Column:
    digits = _digits(value)
    moved = _moved(F.substring(digits, F.lit(1), F.length(digits) - 1), params, "card", forward)
    check = ((10 - _luhn_sum(moved, True) % 10) % 10).cast("string")
    return F.when(_luhn_sum(digits, False) % 10 == 0, _refilled(value, F.concat(moved, check))).otherwise(value)


def _phone(value: Column, params: PseudonymParams, forward: bool) -> Column:
    """The digits after the country code; without a separator the first two stay, without a code none."""
    code = F.length(F.regexp_extract(value, "^(?:[+][0-9]{1,3}(?=[ .-])|[+][0-9]{2}|)", 0))
    rest = F.substring(value, code + 1, F.length(value))
    digits = _digits(rest)
    # More digits than a number has: the first 18 move.
    moved = F.concat(_moved(F.substring(digits, 1, 18), params, "phone", forward), F.substring(digits, F.lit(19), F.length(digits)))
    return F.concat(F.substring(value, F.lit(1), code), _refilled(rest, moved))


def _address(value: Column, params: PseudonymParams, forward: bool) -> Column:
    parts = F.split(value, r"\.")
    valid = F.forall(parts, lambda p: (p.cast("int") <= 255) & (p == p.cast("int").cast("string")))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p.cast("int"))
    moved = feistel(number, 65536, 65536, params, "address", forward)
    quads = [((moved / F.lit(256**k)).cast("long") % 256).cast("string") for k in (3, 2, 1, 0)]
    return F.when(valid, F.concat_ws(".", *quads)).otherwise(value)


def _date(value: Column, params: PseudonymParams, forward: bool) -> Column:
    """Days are permuted among the days of two centuries: 271 x 270 ranks hold them, and ranks
    beyond the last day are walked over. Written with dots the day comes first, with slashes the month."""
    dotted, slashed = F.substring(value, 3, 1) == ".", F.substring(value, 3, 1) == "/"

    def shown(day: Column) -> Column:
        return F.when(dotted, F.date_format(day, "dd.MM.yyyy")).when(slashed, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))

    iso = (
        F.when(dotted, F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2)))
        .when(slashed, F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 1, 2), F.substring(value, 4, 2)))
        .otherwise(value)
    )
    day = iso.try_cast("date")
    rank = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    moved = feistel(rank, 271, 270, params, "date", forward)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(6)), moved, lambda m, _: F.when(m < DAYS, m).otherwise(feistel(m, 271, 270, params, "date", forward))
    )
    after = F.date_add(F.lit(FIRST_DAY).cast("date"), walked.cast("int"))
    return F.when(day.isNull() | (rank < 0) | (rank >= DAYS), value).otherwise(shown(after))


def _characters(name: Column, context: Column, params: PseudonymParams, kind: str, forward: bool) -> Column:
    """A Feistel network over the two halves of ``name``: every round shifts the characters of one half inside
    their class (small letter, capital, digit) by a keyed hash of the other and of ``context``."""
    cut = ((F.length(name) + 1) / 2).cast("int")
    state = F.struct(F.substring(name, F.lit(1), cut).alias("l"), F.substring(name, cut + 1, F.length(name)).alias("r"))
    turns = F.array(*[F.lit(t) for t in (range(params.rounds) if forward else reversed(range(params.rounds)))])
    sign = 1 if forward else -1

    def shifted(half: Column, other: Column, t: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(f"{params.key}|{kind}|"), t.cast("string"), F.lit("|"), other, context), 256)

        def place(k: Column) -> Column:
            c = F.substring(half, k, F.lit(1))
            by = F.conv(F.substring(digest, 1 + (k * 4) % 56, F.lit(4)), 16, 10).cast("int")
            inside = lambda first, size: F.char((F.pmod(F.ascii(c) - first + sign * by, F.lit(size)) + first).cast("long"))
            return (
                F.when(c.between("a", "z"), inside(97, 26)).when(c.between("A", "Z"), inside(65, 26)).when(c.between("0", "9"), inside(48, 10)).otherwise(c)
            )

        moved = F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), place), "")
        return F.when(F.length(half) > 0, moved).otherwise(half)

    def turn(s: Column, t: Column) -> Column:
        return F.struct(
            F.when(t % 2 == 0, shifted(s["l"], s["r"], t)).otherwise(s["l"]).alias("l"),
            F.when(t % 2 == 1, shifted(s["r"], s["l"], t)).otherwise(s["r"]).alias("r"),
        )

    return F.aggregate(turns, state, turn, lambda s: F.concat(s["l"], s["r"]))


def _mail(value: Column, params: PseudonymParams, forward: bool) -> Column:
    """The name moves; the domain stays."""
    name = F.substring_index(value, "@", 1)
    domain = F.substring(value, F.length(name) + 1, F.length(value))
    return F.concat(_characters(name, domain, params, "mail", forward), domain)


def _social(value: Column, params: PseudonymParams, forward: bool) -> Column:
    """Valid numbers are permuted by rank: 898 areas, 99 groups, 9,999 serials."""
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(k)).cast("long") for k in (1, 2, 3))
    valid = ~area.isin(*NO_AREAS) & (area < 900) & (group > 0) & (serial > 0)
    # Areas by rank: those above the one that is left out move down by one.
    place = area - 1 - (area > NO_AREAS[1]).cast("long")
    rank = (place * 99 + group - 1) * 9999 + serial - 1
    moved = feistel(rank, 898 * 99, 9999, params, "social", forward)
    # Division of whole numbers without a way through doubles.
    upper = ((moved - moved % 9999) / 9999).cast("long")
    new_place = ((upper - upper % 99) / 99).cast("long")
    new_area = new_place + 1 + (new_place >= NO_AREAS[1] - 1).cast("long")
    shown = lambda n, width: F.lpad(n.cast("string"), width, "0")
    return F.when(valid, F.concat_ws("-", shown(new_area, 3), shown(upper % 99 + 1, 2), shown(moved % 9999 + 1, 4))).otherwise(value)


def _remainder(characters: Column) -> Column:
    """The remainder by 97 of a number in which letters stand for 10 to 35."""
    step = lambda r, c: F.when(c.between("0", "9"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(F.split(characters, ""), lambda c: c != ""), F.lit(0), step)


def _account(value: Column, params: PseudonymParams, forward: bool) -> Column:
    """Accounts whose check digits are right: the country stays, the characters after the check digits move inside
    their class, the check digits are computed anew, the blanks stay where they were."""
    solid = F.replace(value, F.lit(" "), F.lit(""))
    country, rest = F.substring(solid, 1, 2), F.substring(solid, F.lit(5), F.length(solid))
    valid = _remainder(F.concat(rest, F.substring(solid, 1, 4))) == 1
    moved = _characters(rest, country, params, "account", forward)
    check = F.lpad((98 - _remainder(F.concat(moved, country, F.lit("00")))).cast("string"), 2, "0")
    new = F.concat(country, check, moved)
    fours = F.trim(F.regexp_replace(new, "(.{4})", "$1 "))
    return F.when(valid, F.when(value.contains(" "), fours).otherwise(new)).otherwise(value)


def pseudonym(value: Column, params: PseudonymParams = PseudonymParams(), forward: bool = True) -> Column:
    """The pseudonym of one found value, by its kind; with ``forward`` False the value of a pseudonym."""
    return (
        F.when(value.contains("@"), _mail(value, params, forward))
        .when(value.rlike(f"^(?:{SOCIAL})$"), _social(value, params, forward))
        .when(value.rlike(f"^(?:{ACCOUNT})$"), _account(value, params, forward))
        .when(value.startswith("+") | value.rlike(f"^(?:{NATIONAL})$"), _phone(value, params, forward))
        .when(value.rlike(f"^(?:{DATE})$"), _date(value, params, forward))
        .when(value.rlike(f"^(?:{ADDRESS})$"), _address(value, params, forward))
        .otherwise(_card(value, params, forward))
    )


def pseudonymise(
    docs: DataFrame,
    params: PseudonymParams = PseudonymParams(),
    text_col: str = "text",
    count_col: str | None = None,
    forward: bool = True,
) -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced; ``count_col`` names a column for the number
    of values that changed (0 for NULL). One narrow projection: nothing is shuffled."""
    columns = docs.columns
    values, changed = unused_name(columns, "found_values"), unused_name(columns, "new_values")
    text = F.col(text_col)
    out = docs.withColumn(values, F.when(text.rlike(FOUND), F.regexp_extract_all(text, F.lit(FOUND), F.lit(0))))
    out = out.withColumn(changed, F.transform(values, lambda v: pseudonym(v, params, forward)))
    gaps = F.split(text, FOUND, -1)
    joined = F.array_join(F.zip_with(gaps, F.array_append(F.col(changed), F.lit("")), lambda g, v: F.concat(g, v)), "")
    count = F.size(F.filter(F.zip_with(values, changed, lambda a, b: a != b), lambda x: x)).cast("long")
    counted = [F.coalesce(F.when(F.col(values).isNotNull(), count), F.lit(0).cast("long")).alias(count_col)] if count_col else []
    replaced = F.when(F.col(values).isNull(), text).otherwise(joined).alias(text_col)
    kept = [c for c in columns if not count_col or c.lower() != count_col.lower()]
    return out.select(*[replaced if c == text_col else F.col(c) for c in kept], *counted)
