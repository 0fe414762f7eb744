"""Mapping of column names to canonical fields.

Two paths give the same canonical map:

* wide: a DataFrame with ordinary columns; names are resolved once, when the plan is built;
* map: rows that carry a ``MAP<STRING,STRING>`` whose keys differ from row to row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.functions.cleaning import (
    PLAIN_NULL_TOKENS,
    clean_by_field,
    clean_value,
    normalize_string,
)
from rowkin.functions.text import BLANK_CHARS, is_blank, let, strip

# The canonical fields and the header spellings that mean them.
CANONICAL_ALIASES = {
    "name": [
        "name", "full_name", "fullname", "student_name", "studentname", "customer_name", "customername",
        "employee_name", "employeename", "user_name", "username", "first_name", "contact_name",
        "person_name", "candidate_name", "member_name", "client_name", "author",
    ],
    "email": [
        "email", "email_id", "emailid", "mail", "mail_id", "mailid", "e_mail", "email_address",
        "emailaddress", "contact_email", "student_email", "official_email", "personal_email",
    ],
    "phone": [
        "phone", "phone_number", "phonenumber", "phone_no", "phoneno", "mobile", "mobile_no", "mobileno",
        "mobile_number", "mobilenumber", "contact", "contact_no", "contactno", "contact_number", "tel",
        "telephone", "cell", "cell_phone", "cellphone",
    ],
    "department": [
        "department", "dept", "branch", "stream", "course", "major", "division", "faculty", "program",
        "discipline",
    ],
    "id_code": [
        "id", "roll_no", "rollno", "reg_no", "regno", "register_number", "registration_number",
        "student_id", "studentid", "emp_id", "empid", "employee_id", "customer_id", "user_id", "uid",
        "code", "enrollment_no",
    ],
    "dob": ["dob", "date_of_birth", "dateofbirth", "birth_date", "birthdate", "bday"],
    "age": ["age", "years"],
    "address": ["address", "addr", "location", "city", "residence", "street"],
    "company": [
        "company", "organization", "org", "institution", "college", "university", "workplace",
    ],
    "gender": ["gender", "sex"],
}

PROVENANCE_PREFIX = "__"


def sanitize(name: str) -> str:
    """Lower-case a header, join its words with underscores, keep only ``[a-z0-9_]``."""
    joined = re.sub(r"[\s-]+", "_", name.strip().lower())
    return re.sub(r"[^a-z0-9_]", "", joined)


def sanitize_column(name: Column) -> Column:
    """:func:`sanitize` for header names held in data."""
    joined = F.regexp_replace(F.lower(strip(name)), f"[{BLANK_CHARS}-]+", "_")
    return F.regexp_replace(joined, "[^a-z0-9_]", "")


class FieldMap:
    """Canonical fields and their aliases; ``custom`` extends a field or adds a new one."""

    def __init__(self, custom: Mapping[str, Iterable[str]] | None = None):
        aliases = {field: list(names) for field, names in CANONICAL_ALIASES.items()}
        for field, names in (custom or {}).items():
            aliases.setdefault(field, []).extend(names)
        self.aliases = aliases
        # Later fields win an alias that two of them claim.
        self._field_of: dict[str, str] = {}
        for field, names in aliases.items():
            for name in [field, *names]:
                self._field_of[sanitize(name)] = field

    @classmethod
    def from_table(cls, aliases: DataFrame) -> "FieldMap":
        """Build from a ``(field, alias)`` table, a small piece of configuration."""
        custom: dict[str, list[str]] = {}
        for row in aliases.select("field", "alias").sort("field", "alias").toLocalIterator():
            custom.setdefault(row["field"], []).append(row["alias"])
        return cls(custom)

    def fields(self) -> set[str]:
        return set(self.aliases)

    def table(self, spark: SparkSession) -> DataFrame:
        """The mapping as a ``(alias, field)`` DataFrame, the join side for long key columns."""
        return spark.createDataFrame(sorted(self._field_of.items()), "alias string, field string")

    def field(self, name: str) -> str:
        """Canonical field of one header, or its sanitised form."""
        clean = sanitize(name)
        return self._field_of.get(clean, clean)

    def field_column(self, name: Column) -> Column:
        """:meth:`field` for header names held in data."""
        clean = sanitize_column(name)
        # Most headers differ from an alias in case and single blanks or hyphens only: no regular expression for them.
        # An alias with an underscore at an end or two in a row would match other headers, too.
        usual = {alias: field for alias, field in self._field_of.items() if re.fullmatch("[a-z0-9]+(_[a-z0-9]+)*", alias)}
        plain = F.lower(F.translate(name, " -", "__"))
        return F.coalesce(F.try_element_at(_literal(usual), plain), F.try_element_at(_literal(self._field_of), clean), clean)

    # -- wide path ---------------------------------------------------------------------------

    def sources(self, columns: Iterable[str]) -> dict[str, list[str]]:
        """Canonical field -> the columns that feed it, in column order."""
        plan: dict[str, list[str]] = {}
        for column in columns:
            if not column.startswith(PROVENANCE_PREFIX):
                plan.setdefault(self.field(column), []).append(column)
        return plan

    def fused(self, columns: Iterable[str]) -> dict[str, Column]:
        """Canonical field -> raw value: the first non-blank of its columns."""
        fused = {}
        for field, names in self.sources(columns).items():
            texts = [_text(name) for name in names]
            fused[field] = texts[0] if len(texts) == 1 else F.coalesce(
                *[F.when(~is_blank(text), text) for text in texts]
            )
        return fused

    def cleaned(self, columns: Iterable[str]) -> dict[str, Column]:
        """Canonical field -> cleaned value, "" when missing."""
        return {field: clean_value(field, raw) for field, raw in self.fused(columns).items()}

    # -- map path ----------------------------------------------------------------------------

    def fuse_map(self, raw: Column) -> Column:
        """Rename the keys of a raw map; of several keys with one field the first non-blank wins."""
        entries = F.filter(
            F.map_entries(raw),
            lambda e: ~e["key"].startswith(PROVENANCE_PREFIX) & ~is_blank(e["value"]),
        )
        return _first_per_key(
            F.transform(
                entries,
                lambda e: F.struct(self.field_column(e["key"]).alias("key"), e["value"].alias("value")),
            )
        )

    def clean_map(self, raw: Column) -> Column:
        """Canonical map of a raw map: fused, cleaned, empty values dropped."""
        cleaned = F.transform_values(self.fuse_map(raw), clean_by_field)
        return F.map_filter(cleaned, lambda _, value: value != "")


def _literal(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def _text(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def _first_per_key(entries: Column) -> Column:
    """Map of ``(key, value)`` entries, keeping the first value of a repeated key."""

    def pick(pairs: Column) -> Column:
        keys = F.transform(pairs, lambda e: e["key"])
        distinct = F.array_distinct(keys)
        first = F.transform(
            distinct, lambda key: F.get(pairs, F.array_position(pairs["key"], key).cast("int") - 1)["value"]
        )
        return F.map_from_arrays(distinct, first)

    return let(entries, pick)


def last_per_key(entries: Column) -> Column:
    """Map of ``(key, value)`` entries, keeping the last value of a repeated key."""
    return F.map_from_entries(F.reverse(F.map_entries(_first_per_key(F.reverse(entries)))))


def map_of(columns: Mapping[str, Column]) -> Column:
    """Map of named columns without the empty ones."""
    pairs = [
        F.when(F.coalesce(value, F.lit("")) != "", F.struct(F.lit(name).alias("key"), value.alias("value")))
        for name, value in columns.items()
    ]
    return F.map_from_entries(F.array_compact(F.array(*pairs)))


def raw_map(columns: Iterable[str]) -> Column:
    """Map of the raw columns of a wide row, NULL as missing."""
    return F.map_filter(
        F.create_map(*[part for c in columns for part in (F.lit(c), _text(c))]),
        lambda _, value: value.isNotNull(),
    )


def normalized_map(raw: Column, canonical: Column) -> Column:
    """All-fields map: the canonical map overlaid with every original key under the plain rule."""
    entries = F.reverse(
        F.filter(
            F.transform(
                F.filter(F.map_entries(raw), lambda e: ~e["key"].startswith(PROVENANCE_PREFIX)),
                lambda e: F.struct(
                    strip(e["key"]).alias("key"), normalize_string(e["value"]).alias("value")
                ),
            ),
            lambda e: (e["value"] != "") & ~e["value"].isin(*PLAIN_NULL_TOKENS),
        )
    )
    # Reversed, so that the last of several keys that differ only in outer blanks is kept.
    def overlay(original: Column) -> Column:
        keep = F.map_filter(canonical, lambda key, _: ~F.map_contains_key(original, key))
        return F.map_concat(keep, original)

    return let(_first_per_key(entries), overlay)
