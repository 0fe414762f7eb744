"""Plain Python versions of operators that SQL cannot express."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict


def suffix_removal(texts: list[str | None], length: int = 200) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of every text, by counting every string of ``length`` bytes."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def jaccard_components(docs: list[tuple], words: int = 4, percent: int = 85) -> list[tuple]:
    """(id, n_shingles, component_id) of every (id, text), by comparing all pairs that share a shingle."""
    sets = []
    for _, text in docs:
        parts = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        parts = [w for w in re.split(r"[\x20\x09-\x0D]+", parts) if w]
        n = min(words, len(parts))
        sets.append({tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if parts else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, made in enumerate(sets):
        for s in made:
            holders[s].append(i)
    for i, made in enumerate(sets):
        common = Counter(j for s in made for j in holders[s] if j < i)
        for j, both in common.items():
            if 100 * both >= percent * (len(made) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(docs)]


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    words = _WORD.findall(text)
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def _luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """The base kinds by their patterns over the whole text."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def top_k(vectors: list[tuple], k: int = 5, every: int = 50) -> list[tuple]:
    """(query_id, rank, vec_id, score)"""
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in usable if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return out


def mix(docs: list[tuple], weights=(5, 2, 1)) -> list[tuple]:
    """(doc_id, size, source_size, target) of every (doc_id, text, source)."""
    sizes = [len(_WORD.findall(t or "")) for _, t, _ in docs]
    total: dict = {}
    for (_, _, source), n in zip(docs, sizes, strict=True):
        total[source] = total.get(source, 0) + n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full: set = set()
    while True:
        rest = 1.5 * sum(total.values()) - sum(2 * total[s] for s in full)
        level = rest / max(1, sum(weight[s] for s in order if s not in full))
        new = {s for s in order if s not in full and weight[s] * level > 2 * total[s]}
        if not new:
            break
        full |= new
    target = {s: 2 * total[s] if s in full else weight[s] * level for s in order}
    return [(d, n, total[s], target[s]) for (d, _, s), n in zip(docs, sizes, strict=True)]
