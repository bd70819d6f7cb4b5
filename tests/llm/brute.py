"""Plain re-tellings of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, width=4):
    w = plain_words(fold(text))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def components(docs, percent=85):
    """doc_id -> (set size, smallest id reachable), by all pairs that share a shingle."""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    met = Counter()
    for ids in where.values():
        for i, a in enumerate(ids):
            for b in ids[:i]:
                met[(a, b)] += 1
    for (a, b), k in met.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def secret_base(text):
    text = text or ""
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_base(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]
    return out


def quality_base(text):
    w = plain_words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if plain_words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def license_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))
    places = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    places.sort()
    return len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places}))


def edit_distance(item, window):
    """(distance, first end) of the part of ``window`` nearest to ``item``."""
    m = len(item)
    column, best = list(range(m + 1)), (m, 0)
    for end, c in enumerate(window, 1):
        fresh = [0]
        for i in range(1, m + 1):
            fresh.append(min(column[i] + 1, fresh[i - 1] + 1, column[i - 1] + (item[i - 1] != c)))
        column = fresh
        if column[m] < best[0]:
            best = (column[m], end)
    return best


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "one"),
    (6, "One"),
    (7, "é" * 20_000),
    (8, "word " * 20_000),
    (9, "İstanbul ﬁ     𝔘𝔫𝔦 ß \U0001f600 end"),
    (10, "1" * 30_000 + "." + "a" * 30_000 + "@" + "A" * 30_000),
]


def odd_rows(spark):
    """Nulls, empty and long texts, ties, a repeated row, a null id and clashing extra columns."""
    rows = [(i, t, None if i in (2, 7) else "en", None if i in (3, 4) else "src", None, "x", 1, "y") for i, t in [*ODD, (4, "one"), (None, "one")]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, n long, spans string"
    return spark.createDataFrame(rows, schema)
