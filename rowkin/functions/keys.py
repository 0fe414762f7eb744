"""Composite keys, blocking keys and integer fingerprints."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifiers strong enough to match on alone, in match order.
IDENTIFIERS = ("email", "phone", "id_code")

# The parameters of the three fingerprints.
FINGERPRINT_MODULUS = 2**32
POLYNOMIAL_BASE = 31
DJB2_SEED = 5381
DJB2_FACTOR = 33
FNV_BASIS = 2166136261
FNV_PRIME = 16777619

# Bucket counts offered for a key profile.
BUCKET_COUNTS = (31, 53, 101, 211, 401, 809, 1601, 3203, 6421, 12853, 25717, 50021)


def composite_key(canonical: Column) -> Column:
    """``field:value`` pairs of a canonical map, sorted by field and joined by ``|``."""
    present = F.filter(F.map_entries(canonical), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    return F.array_join(
        F.transform(F.array_sort(present), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), "|"
    )


def composite_key_of_columns(cleaned: Mapping[str, Column]) -> Column:
    """:func:`composite_key` when the fields are known at plan time: no map, no sort per row."""
    pairs = [
        F.when(value != "", F.concat(F.lit(f"{field}:"), value)) for field, value in sorted(cleaned.items())
    ]
    return F.concat_ws("|", *pairs)


def secondary_keys(canonical: Column) -> Column:
    """Array of ``(key_type, key)`` blocking keys: strong identifiers and name with context."""
    value = lambda field: F.try_element_at(canonical, F.lit(field))
    keys = [_pair(field, F.concat(F.lit(f"{field}:"), value(field))) for field in IDENTIFIERS]
    for key_type, label, field in (("name_dept", "dept", "department"), ("name_dob", "dob", "dob")):
        keys.append(
            _pair(
                key_type,
                F.concat(F.lit("name:"), value("name"), F.lit(f"|{label}:"), value(field)),
            )
        )
    return F.filter(F.array(*keys), lambda pair: pair["key"].isNotNull())


def _pair(key_type: str, key: Column) -> Column:
    return F.struct(F.lit(key_type).alias("key_type"), key.alias("key"))


def _code_points(key: Column) -> Column:
    return F.transform(F.split(key, ""), lambda c: F.ascii(c).cast("bigint"))


def _fold(points: Column, seed: int, step) -> Column:
    modulus = F.lit(FINGERPRINT_MODULUS)
    return F.aggregate(points, F.lit(seed).cast("bigint"), lambda acc, c: step(acc, c) % modulus)


def polynomial_hash(key: Column) -> Column:
    """``sum(code_point[i] * 31^i) mod 2^32``, evaluated from the last character down."""
    points = F.reverse(_code_points(key))
    return _guard(key, _fold(points, 0, lambda acc, c: acc * POLYNOMIAL_BASE + c), 0)


def djb2_hash(key: Column) -> Column:
    return _guard(key, _fold(_code_points(key), DJB2_SEED, lambda acc, c: acc * DJB2_FACTOR + c), DJB2_SEED)


def fnv1a_hash(key: Column) -> Column:
    """FNV-1a over code points (not bytes)."""
    return _guard(key, _fold(_code_points(key), FNV_BASIS, lambda acc, c: acc.bitwiseXOR(c) * FNV_PRIME), FNV_BASIS)


def _guard(key: Column, value: Column, empty: int) -> Column:
    # split('', '') gives one empty string rather than no character.
    return F.when(key == "", F.lit(empty).cast("bigint")).otherwise(value)


FINGERPRINTS = {"polynomial": polynomial_hash, "djb2": djb2_hash, "fnv1a": fnv1a_hash}


def fingerprint(key: Column, algorithm: str = "polynomial") -> Column:
    """Fingerprint by name, an unknown name meaning polynomial; 0 for the empty key."""
    value = FINGERPRINTS.get(algorithm, polynomial_hash)(key)
    return F.when(key == "", F.lit(0).cast("bigint")).otherwise(value)


def bucket_id(key: Column, buckets: int, algorithm: str = "polynomial") -> Column:
    return F.pmod(fingerprint(key, algorithm), F.lit(buckets)).cast("bigint")


def bucket_count(target: int) -> int:
    """Smallest offered count that is at least ``target``; beyond the list the next odd number."""
    for count in BUCKET_COUNTS:
        if count >= target:
            return count
    return target if target % 2 else target + 1
