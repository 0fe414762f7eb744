"""Value cleaning as Column expressions: no UDF, all inside the JVM.

Every function takes and returns a string Column and maps NULL to the empty string, which means
"no value" throughout the package.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowkin.functions.text import collapse, drop_blanks, let, strip

# Tokens that stand for a missing value, compared in lower case.
NULL_TOKENS = ("none", "null", "nan", "n/a", "na", "-", "")

# The shorter token list used for the all-fields map.
PLAIN_NULL_TOKENS = ("none", "null", "nan")

# Honorifics dropped from the head of a name.
HONORIFICS = ("mr", "ms", "mrs", "dr", "prof", "er")

# Month abbreviations of the two textual date formats.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# Fields with a rule of their own; every other field uses the plain string rule.
NUMBER_FIELDS = ("age", "id_code")
DATE_FIELDS = ("dob",)


def normalize_string(text: Column) -> Column:
    """Strip, collapse blanks, lower-case."""
    # Once every run of blanks is one space, the plain trim is enough.
    return F.coalesce(F.lower(F.trim(collapse(text))), F.lit(""))


def normalize_name(text: Column) -> Column:
    """Plain rule, minus one leading honorific, punctuation read as blanks."""
    titles = "|".join(HONORIFICS)
    untitled = F.regexp_replace(normalize_string(text), rf"^({titles})\.?\s+", "")
    return F.trim(F.regexp_replace(untitled, r"""[.,_\-'"\s]+""", " "))


def normalize_email(text: Column) -> Column:
    """Lower case, no blanks at all; the address is not validated."""
    return F.coalesce(F.lower(drop_blanks(text)), F.lit(""))


def normalize_phone(text: Column) -> Column:
    """Digits only; a 91, 0 or 1 prefix in front of ten digits is dropped."""
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\D+", "")
    return F.regexp_replace(digits, r"(?U)^(91|0|1)(?=\d{10}$)", "")


# Single underscores may group the digits.
_DIGITS = r"\d+(_\d+)*"
_INTEGER_TEXT = rf"^[+-]?{_DIGITS}(\.0*)?$"
_DECIMAL_TEXT = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
_INFINITY_TEXT = r"(?i)^([+-]?)inf(inity)?$"


def normalize_number(text: Column) -> Column:
    """One spelling per number: ``20.0`` and ``020`` become ``20``; other text gets the plain rule.

    Integer-looking text keeps all its digits, so identifiers longer than a double's 53 bits stay
    apart from each other.
    """

    def spell(s: Column) -> Column:
        digits = F.replace(s, F.lit("_"), F.lit(""))
        return (
            F.when(s.rlike(_INTEGER_TEXT), _integer_text(digits))
            .when(s.rlike(_DECIMAL_TEXT), let(digits.try_cast("double"), _double_text))
            .when(s.rlike(_INFINITY_TEXT), F.regexp_replace(s, r"(?i)^\+?(-?)inf.*$", "$1inf"))
            .when(s.rlike(r"(?i)^[+-]?nan$"), F.lit("nan"))
            .otherwise(normalize_string(s))
        )

    # Bound once: a filter on the result may be moved below the projection that computes it, and
    # must not multiply the expression.
    return let(strip(F.coalesce(text, F.lit(""))), spell)


def _integer_text(number: Column) -> Column:
    trimmed = F.regexp_replace(number, r"^\+?(-?)0*(\d+?)(\.0*)?$", "$1$2")
    return F.regexp_replace(trimmed, "^-0$", "0")


def _double_text(value: Column) -> Column:
    size = F.abs(value)
    whole = value == F.floor(value).cast("double")
    # Fixed-point text holds all digits of a double in this range; smaller values keep an exponent.
    fixed = F.regexp_replace(value.try_cast("decimal(38,22)").cast("string"), r"\.?0+$", "")
    small = F.regexp_replace(value.cast("string"), r"(\.0)?E-", "e-")
    small = F.regexp_replace(small, r"e-(\d)$", "e-0$1")
    whole_text = F.coalesce(value.try_cast("decimal(38,0)").cast("string"), value.cast("string"))
    return (
        F.when(size == F.lit(float("inf")), F.when(value < 0, F.lit("-inf")).otherwise(F.lit("inf")))
        .when(whole, whole_text)
        .when(size >= 1e-4, fixed)
        .otherwise(small)
    )


# (pattern, group of year, group of month, group of day); the first pattern that gives a real
# calendar day wins, so day-first reading has priority over month-first.
_DAY = r"( ?[1-9]|0[1-9]|[12]\d|3[01])"
_MONTH = r"(0?[1-9]|1[0-2])"
_MONTH_NAME = "(" + "|".join(MONTHS) + ")"
_DATE_FORMS = (
    (rf"^(\d{{4}})-{_MONTH}-{_DAY}$", 1, 2, 3),
    (rf"^{_DAY}/{_MONTH}/(\d{{4}})$", 3, 2, 1),
    (rf"^{_MONTH}/{_DAY}/(\d{{4}})$", 3, 1, 2),
    (rf"^{_DAY}-{_MONTH}-(\d{{4}})$", 3, 2, 1),
    (rf"^(\d{{4}})/{_MONTH}/{_DAY}$", 1, 2, 3),
    (rf"^{_DAY}\.{_MONTH}\.(\d{{4}})$", 3, 2, 1),
    (rf"^{_MONTH_NAME}\s+{_DAY},\s+(\d{{4}})$", 3, 1, 2),
    (rf"^{_DAY}\s+{_MONTH_NAME}\s+(\d{{4}})$", 3, 2, 1),
)


def normalize_date(text: Column) -> Column:
    """ISO date of the first matching day format, otherwise the plain rule."""

    def first_day(s: Column) -> Column:
        return F.coalesce(*[_iso_day(s, *form) for form in _DATE_FORMS], normalize_string(s))

    return let(F.lower(strip(F.coalesce(text, F.lit("")))), first_day)


def _iso_day(s: Column, pattern: str, year: int, month: int, day: int) -> Column:
    part = lambda group: F.regexp_extract(s, pattern, group)
    month_text = part(month)
    if _MONTH_NAME in pattern:
        number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month_text)
        month_text = number.cast("string")
    iso = F.concat_ws(
        "-", part(year), F.lpad(month_text, 2, "0"), F.lpad(F.trim(part(day)), 2, "0")
    )
    usable = s.rlike(pattern) & (part(year) != "0000")
    return F.when(usable & iso.try_cast("date").isNotNull(), iso)


def drop_null_tokens(text: Column) -> Column:
    """Stripped text, or "" when it is a spelling of "no value"."""
    tokens = "|".join(token for token in NULL_TOKENS if token)
    return F.regexp_replace(strip(F.coalesce(text, F.lit(""))), f"(?i)^({tokens})$", "")


def rule_of(field: str):
    """The cleaning function of a canonical field, chosen at plan time."""
    name = field.lower()
    if name in NUMBER_FIELDS:
        return normalize_number
    if name in DATE_FIELDS:
        return normalize_date
    return {"email": normalize_email, "phone": normalize_phone, "name": normalize_name}.get(
        name, normalize_string
    )


def clean_value(field: str, text: Column) -> Column:
    """Clean one column whose canonical field is known when the plan is built."""
    return rule_of(field)(drop_null_tokens(text))


def clean_by_field(field: Column, text: Column) -> Column:
    """Clean a value whose canonical field is data, as in a map of varying keys."""
    name = F.lower(field)

    def dispatch(value: Column) -> Column:
        return (
            F.when(value == "", F.lit(""))
            .when(name == "email", normalize_email(value))
            .when(name == "phone", normalize_phone(value))
            .when(name == "name", normalize_name(value))
            .when(name.isin(*NUMBER_FIELDS), normalize_number(value))
            .when(name.isin(*DATE_FIELDS), normalize_date(value))
            .otherwise(normalize_string(value))
        )

    return let(drop_null_tokens(text), dispatch)
