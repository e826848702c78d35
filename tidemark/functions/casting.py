"""Text to typed columns.

Three numeric modes:

``exact``
    Reads the number the text means, either mark style; ``locale`` settles ``1.234``.
``compat_microbatch`` / ``compat_backfill``
    Give the values the existing scheduled merge / table backfill give for the same text,
    including their quirks, so that tables filled by them stay comparable.

Every rule is one expression over built-in functions, so casts stay inside whole-stage codegen.
Costly parts stand in a condition that is always evaluated, where Spark computes them once per
row; a failing text-to-integer or text-to-double cast raises inside the JVM, so a pattern test
stands before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_MODES = ("exact", "compat_microbatch", "compat_backfill")
LOCALES = ("auto", "en", "id")

# Words read as true and false.
TRUE_WORDS = ("t", "true", "1", "y", "yes")
FALSE_WORDS = ("f", "false", "0", "n", "no")

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONS = (T.DecimalType, T.DoubleType, T.FloatType)
_TIMES = (T.TimestampType, T.TimestampNTZType)

_BLANKS = r"[\s\p{Zs}]+"
_EDGE_BLANKS = r"^[\s\p{Zs}]+|[\s\p{Zs}]+$"
_CURRENCY = r"^([+-]?)(?:[A-Za-z]{0,3}\p{Sc}|[A-Za-z]{2,3}\.?)"
_BARE = r"^[0-9.,+-]*$"
_INTEGER = r"^[+-]?[0-9]+$"
_DOUBLE = r"^\s*[+-]?(?:NaN|Infinity|0[xX].+|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[fFdD]?)\s*$"
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_ONE_AMBIGUOUS_MARK = r"^[+-]?[0-9]{1,3}[.,][0-9]{3}$"


def _nonblank(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def _drop(col: Column, pattern: str) -> Column:
    return F.regexp_replace(col, pattern, "")


def strip_text(col: Column) -> Column:
    """Trim every kind of blank, no-break space included."""
    return _drop(col, _EDGE_BLANKS)


def _try_chain(col: Column, *kinds: T.DataType) -> Column:
    for kind in kinds:
        col = col.try_cast(kind)
    return col


# --- numbers -------------------------------------------------------------------------------

def _swap_marks(col: Column) -> Column:
    """Drop dots, then read the comma as the decimal dot."""
    return F.replace(F.replace(col, F.lit(".")), F.lit(","), F.lit("."))


# What the compatible modes take out of a number's text.
NUMBER_CHARACTERS = r"[^0-9\-,\.]"
WHOLE_CHARACTERS = r"[^0-9\-]"
FRACTION_CHARACTERS = r"[^0-9\-\.]"


def leading_integer(col: Column, target: T.DataType) -> Column:
    """Compat rule: the integer before the first separator.

    Text that starts with a separator falls back to the part before ``,`` and then to the
    part before ``.`` once the other mark is gone.
    """
    text = F.trim(col)
    head = F.regexp_extract(_drop(text, NUMBER_CHARACTERS), r"^-?[0-9]+", 0)
    before_comma = _drop(F.split_part(text, F.lit(","), F.lit(1)), WHOLE_CHARACTERS)
    before_dot = _drop(
        F.split_part(F.replace(text, F.lit(",")), F.lit("."), F.lit(1)), WHOLE_CHARACTERS
    )
    return F.coalesce(*(_nonblank(part).try_cast(target) for part in (head, before_comma, before_dot)))


def dotted_first_fraction(col: Column, target: T.DataType) -> Column:
    """Compat rule: read ``.`` as the thousands mark, else ``,``, else keep digits only."""
    text = F.trim(col)
    dot_decimal = F.replace(text, F.lit(","))
    digits = _drop(text, FRACTION_CHARACTERS)

    def through_double(part: Column) -> Column:
        return F.when(part.rlike(_DOUBLE), _try_chain(part, T.DoubleType(), target))

    return F.coalesce(through_double(_swap_marks(text)), through_double(dot_decimal), _nonblank(digits).try_cast(target))


def _bare(col: Column) -> Column:
    """Without blanks and a leading currency word."""
    cleaned = F.regexp_replace(_drop(col, _BLANKS), _CURRENCY, "$1")
    return F.when(col.rlike(_BARE), col).otherwise(cleaned)


def _dot_marked(text: Column, locale: str) -> Column:
    """Bare text with the decimal mark as a dot and no thousands marks."""
    if locale not in LOCALES:
        raise ValueError(f"locale must be one of {LOCALES}, got {locale!r}")
    dots, commas = (F.length(text) - F.length(F.replace(text, F.lit(mark))) for mark in ".,")
    ambiguous = text.rlike(_ONE_AMBIGUOUS_MARK)
    id_style, other_style = F.lit(locale == "id"), F.lit(locale != "id")
    dot_is_decimal = (
        F.when(commas == 0, (dots <= 1) & ~(id_style & ambiguous))
        .when(dots == 0, (commas > 1) | (other_style & ambiguous))
        .otherwise(text.rlike(r"\.[^.,]*$"))
    )
    return F.when(dot_is_decimal, F.replace(text, F.lit(","))).otherwise(_swap_marks(text))


def _parsed(plain: Column, target: T.DataType) -> Column:
    if isinstance(target, _INTEGERS):
        whole = _try_chain(plain, T.DecimalType(38, 18), target)
        return F.when(plain.rlike(_INTEGER), plain.try_cast(target)).otherwise(whole)
    if isinstance(target, T.DecimalType):
        # the decimal parser itself rejects what is not a number
        return plain.try_cast(target)
    return F.when(plain.rlike(_NUMBER), plain.try_cast(target))


def number_text(col: Column, locale: str = "auto") -> Column:
    """Canonical ``-1234.56`` text of a number in either mark style; NULL when it is not one.

    The right-most of two kinds of mark is the decimal mark, a repeated mark is the thousands
    mark, and a single mark is the decimal mark unless the text has the ``1.234`` shape, which
    ``locale`` decides (``auto`` reads it as ``en``).
    """
    plain = _dot_marked(_bare(col), locale)
    return F.when(plain.rlike(_NUMBER), plain)


def exact_number(col: Column, target: T.DataType, locale: str = "auto") -> Column:
    """Exact mode: decimals round half up, integers truncate toward zero, overflow is NULL."""
    return _parsed(_dot_marked(_bare(col), locale), target)


# --- other kinds ---------------------------------------------------------------------------

def boolean_word(col: Column) -> Column:
    word = F.lower(strip_text(col))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def flag_is_set(text: str) -> bool:
    """Option text such as ``--debug=yes``."""
    return str(text).strip().lower() in TRUE_WORDS


def time_text(col: Column, target: T.DataType) -> Column:
    """Blank text is NULL; the cast itself skips plain blanks, other blanks are stripped only if needed."""
    return F.coalesce(col.try_cast(target), strip_text(col).try_cast(target))


def sized_text(col: Column, length: int) -> Column:
    return F.substring(col.cast("string"), 1, length)


# --- dispatch ------------------------------------------------------------------------------

def cast_column(
    col: Column,
    target: T.DataType | None,
    *,
    source: T.DataType | None = None,
    numeric_mode: str = "exact",
    locale: str = "auto",
) -> Column:
    """Shape ``col`` for a ``target`` type; a missing target passes the column through.

    ``source`` is the column's own type. A column already of the target type is left alone and,
    in exact mode, one typed column is converted directly instead of through text.
    """
    if numeric_mode not in NUMERIC_MODES:
        raise ValueError(f"numeric_mode must be one of {NUMERIC_MODES}, got {numeric_mode!r}")
    if target is None:
        return col
    if isinstance(target, (T.VarcharType, T.CharType)):
        return sized_text(col, target.length)
    is_text = source is None or isinstance(source, (T.StringType, T.VarcharType, T.CharType))
    numeric = isinstance(target, _INTEGERS + _FRACTIONS)
    keeps_quirks = numeric and numeric_mode == "compat_backfill"
    if not is_text and not keeps_quirks:
        return col if source == target else col.try_cast(target)
    text = col if is_text else col.cast("string")

    if numeric_mode == "compat_backfill" and numeric:
        return leading_integer(text, target)
    if numeric_mode == "compat_microbatch":
        if isinstance(target, _INTEGERS) and not isinstance(target, T.ByteType):
            return leading_integer(text, target)
        if isinstance(target, _FRACTIONS):
            return dotted_first_fraction(text, target)
    elif numeric:
        return exact_number(text, target, locale)
    if isinstance(target, T.BooleanType):
        return boolean_word(text)
    if isinstance(target, _TIMES + (T.DateType,)):
        return time_text(text, target)
    return text if target == source else text.try_cast(target)


def cast_to_schema(
    df: DataFrame,
    schema: T.StructType,
    *,
    numeric_mode: str = "exact",
    locale: str = "auto",
    overrides: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Cast the columns of ``df`` that ``schema`` names (any case); others pass through."""
    wanted = {field.name.lower(): field.dataType for field in schema.fields}
    wanted.update({name.lower(): kind for name, kind in (overrides or {}).items()})
    if numeric_mode == "exact":
        # exact numbers in three projections: each step reads the one before by name, so that the
        # generated code stays small and no step is computed twice
        numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
                   and isinstance(wanted.get(f.name.lower()), _INTEGERS + _FRACTIONS)]
        df = df.withColumns({n: _bare(F.col(f"`{n}`")) for n in numbers})
        df = df.withColumns({n: _dot_marked(F.col(f"`{n}`"), locale) for n in numbers})
        df = df.withColumns({n: _parsed(F.col(f"`{n}`"), wanted[n.lower()]) for n in numbers})
    return df.select(*(
        cast_column(
            F.col(f"`{field.name}`"), wanted.get(field.name.lower()),
            source=field.dataType, numeric_mode=numeric_mode, locale=locale,
        ).alias(field.name)
        for field in df.schema.fields
    ))


def all_text(df: DataFrame, overrides: Mapping[str, T.DataType | str] | None = None) -> DataFrame:
    """Every column as string, except those with an override."""
    kinds = {name.lower(): kind for name, kind in (overrides or {}).items()}
    return df.select(*(
        F.col(f"`{name}`").cast(kinds.get(name.lower(), "string")).alias(name) for name in df.columns
    ))


# --- change-record decoding ----------------------------------------------------------------

def decimal_text(col: Column, precision: int, scale: int) -> Column:
    """Decimals a change stream sends as plain text."""
    return exact_number(col, T.DecimalType(precision, scale), "en")


def micros_time(col: Column) -> Column:
    """Microseconds since 1970 to a zone-less timestamp."""
    return F.timestamp_micros(col.cast("long")).cast("timestamp_ntz")


def millis_time(col: Column) -> Column:
    """Milliseconds since 1970 to a zone-less timestamp."""
    return F.timestamp_millis(col.cast("long")).cast("timestamp_ntz")
