"""Plain single-machine versions of the corpus operators' contracts."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def span_text(spans):
    return ",".join(f"{list(KINDS)[k]}:{a}:{b}" for a, k, b in spans)


def shingles(text, size):
    w = words(lower(text))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_components(texts, size, percent):
    """(set size, smallest index that links lead to) by position."""
    sets = [shingles(t, size) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def kept_words(texts, length=20):
    """(words, removed, digest of the kept) by position."""
    seen, out = set(), []
    for t in texts:
        w = words(t)
        gone = set()
        for s in range(len(w) - length + 1):
            key = tuple(w[s:s + length])
            if key in seen:
                gone |= set(range(s, s + length))
            seen.add(key)
        out.append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def contamination(texts, items, length=13):
    """(words, hit, items, digest, contaminated) by position; items are (id, text)."""
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        for s in range(max(1, len(w) - length + 1)) if w and item is not None else ():
            windows.setdefault(tuple(w[s:s + length]), set()).add(str(item))
    out = []
    for t in texts:
        w, hit, named = ALNUM.findall(lower(t)), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s:s + n]))
                if found:
                    hit |= set(range(s, s + n))
                    named |= found
        out.append((len(w), len(hit), len(named), sha(",".join(sorted(named))), bool(hit) and 20 * len(hit) >= len(w)))
    return out
