"""Format-preserving pseudonyms for personal data, in Spark SQL expressions alone.

Every found value is validated, turned into a short array of whole numbers ("limbs", each with its own radix), permuted by a
keyed unbalanced Feistel network over the limbs, and written back in its own format. Each round adds a SHA-256 based function
of the other limbs to one limb, modulo its radix, so the whole is a permutation: equal values get equal
pseudonyms in every document and different values different ones. A card number keeps its check digit's validity, a date
stays a date of 1900 to 2100, an address octet stays below 256, letters stay letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

# Shapes, tried in this order at each place of a text.
SHAPES = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])\+[0-9]{1,3}[ .\-]?\(?[0-9]{3}\)?[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![\p{L}\p{N}])",
    "date": r"(?<![\p{L}\p{N}])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![\p{L}\p{N}])",
    "address": r"(?<![\p{L}\p{N}.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[\p{L}\p{N}])",
    "social": r"(?<![\p{L}\p{N}\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}\-])",
    "card": r"(?<![\p{L}\p{N}])(?:[0-9]{13,19}|[0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4})(?![\p{L}\p{N}])",
}
ANY = "|".join(SHAPES.values())
DAYS, DAY_RADIX = 73414, (94, 781)  # 1900-01-01 to 2100-12-31; their product is the number of days


def _one(kind: str) -> str:
    """The shape as a whole, for a value cut out of its text."""
    return f"^(?:{SHAPES[kind]})$"


def _power(base: int, exponent: Column) -> Column:
    return F.pow(F.lit(float(base)), exponent).cast("long")


def _radix(limbs: Column, radix: Column, kind: str, key: str, laps: int = 4) -> Column:
    """``limbs`` (array of long) permuted within ``radix``: ``laps`` rounds for each limb."""
    def one_round(state: Column, r: Column) -> Column:
        turn = F.pmod(r, F.size(state)).cast("int")
        others = F.array_join(F.transform(state, lambda x, i: F.when(i == turn, "*").otherwise(x.cast("string"))), ",")
        tag = F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), F.size(state).cast("string"), others)
        noise = F.conv(F.substring(F.sha2(tag.cast("binary"), 256), 1, 14), 16, 10).cast("long")
        return F.transform(state, lambda x, i: F.when(i == turn, F.pmod(x + noise, F.get(radix, i))).otherwise(x))

    turns = F.sequence(F.lit(0), F.size(limbs) * laps - 1)
    return F.when(F.size(limbs) > 0, F.aggregate(turns, limbs, one_round)).otherwise(limbs)


def _halves(digits: Column) -> tuple[Column, Column, Column]:
    """(limbs, radix, widths) of a string of decimal digits, in two halves."""
    left = F.floor(F.length(digits) / 2).cast("int")
    widths = F.array(left, F.length(digits) - left)
    limbs = F.array(F.substr(digits, F.lit(1), left).cast("long"), F.substr(digits, left + 1).cast("long"))
    return limbs, F.transform(widths, lambda w: _power(10, w)), widths


def _padded(limbs: Column, widths: Column) -> Column:
    return F.array_join(F.zip_with(limbs, widths, lambda x, w: F.call_function("lpad", x.cast("string"), w, F.lit("0"))), "")


def _digits(digits: Column, kind: str, key: str) -> Column:
    limbs, radix, widths = _halves(digits)
    return _padded(_radix(limbs, radix, kind, key), widths)


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes ``payload`` + digit a valid number."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(payload, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, 2 * digit - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

    return F.pmod(-F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10))


def _card(value: Column, key: str) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
    # a number that fails the check keeps failing it by the same amount
    error = F.substr(digits, F.length(digits)).cast("int") - luhn_digit(payload)
    fresh = _digits(payload, "card", key)
    whole = F.concat(fresh, F.pmod(luhn_digit(fresh) + error, F.lit(10)).cast("string"))
    gap = F.regexp_extract(value, "[^0-9]", 0)
    parts = F.array_join(F.array(*[F.substring(whole, i, 4) for i in (1, 5, 9, 13)]), "|")
    return F.when(gap == "", whole).otherwise(F.call_function("replace", parts, F.lit("|"), gap))


def _phone(value: Column, key: str) -> Column:
    shape = r"^(\+[0-9]{1,3}[ .\-]?\(?)([0-9]{3})(\)?[ .\-]?)([0-9]{3})([ .\-]?)([0-9]{4})$"
    g = [F.regexp_extract(value, shape, i) for i in range(1, 7)]
    fresh = _digits(F.concat(g[1], g[3], g[5]), "phone", key)
    return F.concat(g[0], F.substring(fresh, 1, 3), g[2], F.substring(fresh, 4, 3), g[4], F.substring(fresh, 7, 4))


def _social(value: Column, key: str) -> Column:
    fresh = _digits(F.regexp_replace(value, "-", ""), "social", key)
    return F.concat_ws("-", F.substring(fresh, 1, 3), F.substring(fresh, 4, 2), F.substring(fresh, 6, 4))


def _octets(value: Column) -> Column:
    return F.transform(F.split(value, r"\."), lambda x: x.cast("long"))


def _address(value: Column, key: str) -> Column:
    octets = _octets(value)
    limbs = F.array(F.get(octets, F.lit(0)) * 256 + F.get(octets, F.lit(1)), F.get(octets, F.lit(2)) * 256 + F.get(octets, F.lit(3)))
    fresh = _radix(limbs, F.array(F.lit(65536).cast("long"), F.lit(65536).cast("long")), "address", key)
    return F.array_join(F.flatten(F.transform(fresh, lambda x: F.array(F.floor(x / 256).cast("long"), x % 256))), ".")


def _date_parts(value: Column) -> tuple[Column, Column]:
    """(format, day): the format that reads the value as a real day of the range, and that day."""
    def day(pattern: str) -> Column:
        when = F.to_date(F.try_to_timestamp(value, F.lit(pattern)))
        return F.when(when.between(F.lit("1900-01-01").cast("date"), F.lit("2100-12-31").cast("date")), when)

    known = [("^[0-9]{4}-", "yyyy-MM-dd"), ("^[0-9]{4}/", "yyyy/MM/dd"), (r"^[0-9]{2}\.", "dd.MM.yyyy"), ("^[0-9]{2}/", "dd/MM/yyyy")]
    choices = [(F.when(value.rlike(shape), day(pattern)), pattern) for shape, pattern in known]
    return F.coalesce(*[F.when(d.isNotNull(), F.lit(p)) for d, p in choices]), F.coalesce(*[d for d, _ in choices])


def _date(value: Column, key: str) -> Column:
    _, day = _date_parts(value)
    number = F.datediff(day, F.lit("1900-01-01").cast("date")).cast("long")
    fresh = _radix(F.array(F.floor(number / DAY_RADIX[1]).cast("long"), number % DAY_RADIX[1]),
                   F.array(*[F.lit(r).cast("long") for r in DAY_RADIX]), "date", key)
    moved = F.date_add(F.lit("1900-01-01").cast("date"), (F.get(fresh, F.lit(0)) * DAY_RADIX[1] + F.get(fresh, F.lit(1))).cast("int"))
    # written in the field order of its shape: year first, or day first
    first = value.rlike("^[0-9]{2}[^0-9]")
    apart = F.regexp_extract(value, "[^0-9]", 0)
    day_first = F.date_format(moved, "dd.MM.yyyy")
    year_first = F.date_format(moved, "yyyy.MM.dd")
    return F.call_function("replace", F.when(first, day_first).otherwise(year_first), F.lit("."), apart)


def _secret(value: Column, key: str) -> Column:
    n = F.length(value)
    starts = F.sequence(F.lit(1), n, F.lit(8))
    widths = F.transform(starts, lambda i: F.least(F.lit(8), n - i + 1))
    limbs = F.transform(starts, lambda i: F.conv(F.substr(value, i, F.least(F.lit(8), n - i + 1)), 16, 10).cast("long"))
    fresh = _radix(limbs, F.transform(widths, lambda w: _power(16, w)), "secret", key)
    text = F.array_join(F.zip_with(fresh, widths, lambda x, w: F.call_function("lpad", F.lower(F.hex(x)), w, F.lit("0"))), "")
    return F.when(value.rlike("[A-F]"), F.upper(text)).otherwise(text)


def _email(value: Column, key: str) -> Column:
    """Letters and digits of the local part are permuted; its other signs and the domain stay."""
    at = F.instr(value, "@")
    signs = F.filter(F.split(F.substr(value, F.lit(1), at - 1), ""), lambda c: c != "")
    code = F.transform(signs, lambda c: F.ascii(c).cast("long"))
    low = F.transform(code, lambda c: F.when(c.between(97, 122), 97).when(c.between(65, 90), 65).when(c.between(48, 57), 48).otherwise(c).cast("long"))
    radix = F.transform(code, lambda c: F.when(c.between(97, 122) | c.between(65, 90), 26).when(c.between(48, 57), 10).otherwise(1).cast("long"))
    fresh = _radix(F.zip_with(code, low, lambda c, b: c - b), radix, "email", key)
    text = F.zip_with(F.zip_with(fresh, low, lambda x, b: x + b), signs, lambda c, s: F.when(F.ascii(s) < 128, F.char(c)).otherwise(s))
    return F.concat(F.array_join(text, ""), F.substr(value, at))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; a value that fails validation (no such day, octet over 255) stays."""
    octets = _octets(value)
    return (F.when(value.contains("@"), _email(value, key))
            .when(value.rlike(_one("secret")), _secret(value, key))
            .when(value.startswith("+"), _phone(value, key))
            .when(value.rlike(_one("date")), F.coalesce(_date(value, key), value))
            .when(value.rlike(_one("address")), F.when(F.forall(octets, lambda x: x < 256), _address(value, key)).otherwise(value))
            .when(value.rlike(_one("social")), _social(value, key))
            .when(value.rlike(_one("card")), _card(value, key))
            .otherwise(value))


def _hits(text: Column) -> Column:
    some = text.rlike("[0-9@]")
    return F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def pseudonymised(text: Column, hits: Column, key: str) -> Column:
    """``text`` with each of its ``hits`` replaced; the pieces between are those of a split at the same pattern."""
    between = F.split(text, ANY, -1)
    fresh = F.transform(hits, lambda v: pseudonym(v, key))
    joined = F.array_join(F.zip_with(between, F.concat(fresh, F.array(F.lit(""))), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(F.size(hits) > 0, joined).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with personal data in ``text_col`` replaced by format-preserving pseudonyms.

    Card-like numbers, phone numbers of +country and 3-3-4 digits, social security numbers, IPv4 addresses, dates of 1900 to 2100, e-mail
    local parts and long hexadecimal secrets are replaced; everything else stays. A null text stays null, an empty one empty. No
    column is added, no shuffle is made, repeated rows stay repeated.
    """
    hits = "__pseudonym_hits"
    found = docs.withColumn(hits, _hits(whole_text(text_col)))
    return found.withColumn(text_col, pseudonymised(F.col(text_col), F.col(hits), key)).drop(hits)


def pseudonym_report(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_values, n_cards, n_valid_cards, n_dates): the new text and how many values were found in the old one.

    One row per input row; a null text gives a null text and zeros.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _hits(whole_text(text_col)).alias("hits"))
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
    cards = F.filter("hits", lambda v: v.rlike(_one("card")))
    valid = F.filter(cards, lambda v: luhn_digit(F.substr(digits(v), F.lit(1), F.length(digits(v)) - 1))
                     == F.substr(digits(v), F.length(digits(v))).cast("int"))
    dates = F.filter("hits", lambda v: v.rlike(_one("date")) & _date_parts(v)[1].isNotNull())
    return rows.select(F.col("id").alias(id_col), pseudonymised(F.col("text"), F.col("hits"), key).alias(text_col),
                       F.size("hits").alias("n_values"), F.size(cards).alias("n_cards"), F.size(valid).alias("n_valid_cards"),
                       F.size(dates).alias("n_dates"))
