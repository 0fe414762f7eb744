"""A plain sequential model of the cascade, to test the set-based one against."""


def distance(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        last, row[0] = row[0], row[0] + 1
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similar(a, b):
    """Similarity of two field dicts when they are a possible match, else None."""
    n, m = a.get("name") or "", b.get("name") or ""
    if min(len(n), len(m)) < 3:
        return None
    shared = any(a.get(f) and a.get(f) == b.get(f) for f in ("department", "company", "address"))
    value = 1.0 - distance(n, m) / max(len(n), len(m))
    return value if value >= 0.85 or (shared and value >= 0.70) else None


def cascade(rows):
    """``rows``: [(id, fields)] in order -> {id: (anchor, kind, confidence)}; None for unique."""
    by_key, by_field, unique, result = {}, {"email": {}, "phone": {}, "id_code": {}}, [], {}
    for i, fields in rows:
        key = "|".join(f"{k}:{v}" for k, v in sorted(fields.items()) if v)
        if not key:
            result[i] = None
            continue
        if by_key.setdefault(key, i) != i:
            result[i] = (by_key[key], "exact", 100.0)
            continue
        for field, confidence in (("email", 95.0), ("phone", 90.0), ("id_code", 95.0)):
            value = fields.get(field)
            if value and by_field[field].setdefault(value, i) != i:
                result[i] = (by_field[field][value], field, confidence)
                break
        else:
            for j, other in unique:
                value = similar(fields, other)
                if value is not None:
                    result[i] = (j, "name", round(value * 100, 1))
                    break
            else:
                result[i] = None
                unique.append((i, fields))
    return result
