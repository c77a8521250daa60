"""Plain single-process versions of the operators, written from the contracts."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def crc(x):
    return zlib.crc32(("" if x is None else str(x)).encode())


def simhash(text):
    w = ASCII_WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[j:j + 3]) for j in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits=3):
    """Component number of each fingerprint in a list, by comparing all pairs."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def digest(spans, kinds):
    spans = sorted(spans, key=lambda x: (x[1], kinds.index(x[0])))
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def luhn(s):
    total = 0
    for i, c in enumerate(s[::-1]):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    out, t = [], text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        x = re.sub("[^0-9]", "", m[0])
        if 14 <= len(x) <= 19 and luhn(x):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def secrets(text):
    out, t = [], text or ""
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    for kind, p, least in (("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)):
        out += [(kind, *m.span()) for m in re.finditer(p, t) if len(m[0]) >= least]
    return out


def rules(text):
    t = text or ""
    w = ASCII_WORD.findall(t)
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if ASCII_WORD.search(x):
            dup += x in seen
            seen.add(x)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if n[g] > 1 for d in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def letter_words(text):
    return LETTER_WORD.findall((text or "").translate(LOWER))


def phrases(text):
    w, out, labels = letter_words(text), [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        for k in range(len(w)):
            if w[k:k + len(p)] == p:
                out.append(k)
                labels.add(label)
    return len(w), len(out), min(out, default=None), max(out, default=None), ",".join(sorted(labels))


def windows(items):
    out = {}
    for i, t in items:
        w = letter_words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            out.setdefault(tuple(w[k:k + 13]), set()).update(() if i is None else (str(i),))
    return out


def contamination(text, found):
    w, hit, items = letter_words(text), set(), set()
    for size in {len(x) for x in found}:
        for k in range(len(w) - size + 1):
            if (own := found.get(tuple(w[k:k + size]))) is not None:
                hit.update(range(k, k + size))
                items |= own
    return (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(),
            len(hit) > 0 and 20 * len(hit) >= len(w))


def kneser_ney(texts, order, folds=10):
    """(n_tokens, n_known, train_tokens, base, score) of each (doc_id, text)."""
    toks = [[*ASCII_WORD.findall((t or "").translate(LOWER)), "\n"] for _, t in texts]
    train = [w for (i, _), w in zip(texts, toks) if crc(i) % folds]
    raw = Counter(x for w in train for x in w)
    total, kinds = sum(raw.values()), len(raw)
    pad = ["^"] * (order - 1)
    counts = {order: Counter(tuple(p[i:i + order]) for w in train for p in [pad + w] for i in range(len(w)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def discount(c):
        n = [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        if not all(n[:3]):
            return [0, .5, .5, .5]
        y = n[0] / (n[0] + 2 * n[1])
        d = 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]
        return [0, *(min(max(v, 0), j) for j, v in enumerate(d, 1))]
    d = {k: discount(c) for k, c in counts.items()}
    sums, rest = Counter(), Counter()
    for k, c in counts.items():
        for g, v in c.items():
            sums[g[:-1]] += v
            rest[g[:-1]] += d[k][min(v, 3)]
    out = []
    for w in toks:
        score, p = 0.0, pad + w
        for i, x in enumerate(w):
            prob = 1 / (kinds + 1)
            for k in range(1, order + 1):
                ctx = tuple(p[i + order - k:i + order - 1])
                if sums[ctx]:
                    v = counts[k][ctx + (x,)]
                    prob = (v - d[k][min(v, 3)] + rest[ctx] * prob) / sums[ctx]
            score += math.log10(prob)
        base = sum(math.log10((raw[x] + .1) / (total + .1 * (kinds + 1))) for x in w)
        out.append((len(w), sum(raw[x] > 0 for x in w), total, base, score))
    return out
