"""Plain Python versions of the operators' contracts, over lists of (doc_id, text)."""

import hashlib
import re
import zlib
from collections import defaultdict

import xxhash

LAST = (1 << 63) - 1
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
WORD8 = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def raw(text):
    return (text or "").encode()


def az(data):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def order(doc_id):
    return LAST if doc_id is None else doc_id


def tokens(rows, tokenizer):
    texts = [t or "" for _, t in rows]
    counts = [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    return [(i, len(t.encode()), n, n > 2048) for (i, _), t, n in zip(rows, texts, counts, strict=True)]


def substrings(rows):
    def order(doc_id, text):
        h = xxhash.xxh64_intdigest(raw(text), 42)
        return (1 << 62) + (h - (1 << 64) if h >> 63 else h) % (1 << 62) if doc_id is None else doc_id

    first = {}
    words = [WORD.findall(raw(t)) for _, t in rows]
    for (i, t), w in zip(rows, words, strict=True):
        for k in range(len(w) - 49):
            g = tuple(w[k : k + 50])
            first[g] = min(first.get(g, LAST), order(i, t))
    out = []
    for (i, t), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < order(i, t):
                gone.update(range(k, k + 50))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), sha(b" ".join(kept))))
    return out


def kept_lines(rows):
    def key(line):
        k = az(line.strip(b" \t\n\x0b\x0c\r"))
        return k if len(k.decode()) >= 10 else None

    held = defaultdict(set)
    for i, t in rows:
        for line in raw(t).split(b"\n"):
            held[key(line)].add(order(i))
    out = []
    for i, t in rows:
        lines = raw(t).split(b"\n")
        out.append((i, lines, [x for x in lines if key(x) is None or len(held[key(x)]) < 2 or min(held[key(x)]) == order(i)]))
    return out


def lines(rows):
    return [(i, len(a), len(a) - len(b), sha(b"\n".join(b))) for i, a, b in kept_lines(rows)]


def fingerprint(text):
    w = WORD.findall(az(raw(text)))
    if not w:
        return 0
    shingles = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def near_copies(rows):
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    parent = {p: p for p in distinct}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(distinct)):
        for b in range(a):
            if (distinct[a] ^ distinct[b]).bit_count() <= 2:
                parent[find(distinct[a])] = find(distinct[b])
    least = defaultdict(lambda: LAST)
    for (i, _), p in zip(rows, prints, strict=True):
        least[find(p)] = min(least[find(p)], order(i))
    named = {r: None if i == LAST else i for r, i in least.items()}
    return [(i, f"{p:016x}", named[find(p)]) for (i, _), p in zip(rows, prints, strict=True)]


def benchmark(rows, items):
    windows = defaultdict(set)
    for item, t in items:
        w = WORD8.findall(az(raw(t)).decode())
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(item)
    lengths = {len(g) for g in windows}
    out = []
    for i, t in rows:
        w = WORD8.findall(az(raw(t)).decode())
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                g = tuple(w[k : k + n])
                if g in windows:
                    hit.update(range(k, k + n))
                    found |= windows[g] - {None}
        ids = ",".join(sorted(map(str, found))).encode()
        out.append((i, len(w), len(hit), len(found), sha(ids), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def quality(rows):
    out = []
    for i, t in rows:
        text = t or ""
        w = [x.decode() for x in WORD.findall(raw(text))]
        n_symbols = sum(c in "#*$%&|<>" for c in text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line.encode()):
                dup += line in seen
                seen.add(line)
        at = defaultdict(list)
        for k in range(len(w) - 4):
            at[tuple(w[k : k + 5])].append(k)
        repeat = len({k + j for ks in at.values() if len(ks) > 1 for k in ks for j in range(5)})
        base = len(w) < 10 or 100 * repeat > 20 * len(w)
        chars = sum(map(len, w))
        more = 10 * n_symbols > 3 * len(w) or chars > 60 * len(w) or 10 * dup > 5 * len(text.split("\n"))
        out.append((i, len(w), chars, n_symbols, dup, repeat, base, not base and not more))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """Shares all words by weight and shares the excess over the stops again, round by round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    got, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            got |= {s: level * weight[s] for s in free}
            break
        got |= {s: float(most * sizes[s]) for s in over}
        rest -= sum(got[s] for s in over)
        free -= over
    return got


def planted_words(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic(words, least=12):
    """Every maximal stretch for every lag; the smallest lag of equal stretches."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        equal = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = None
        for i, x in enumerate(equal):
            if x and start is None:
                start = i
            elif not x and start is not None:
                if i - start + q >= max(least, 2 * q):
                    found.setdefault((start, i - start + q), q)
                start = None
    return sorted((s, m, q) for (s, m), q in found.items())


def periodic_digest(rows):
    out = []
    for i, t in rows:
        words = planted_words(i, WORD.findall(raw(t)))
        runs = periodic(words)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = min(((-m, s, q) for s, m, q in runs), default=None)
        first = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
        out.append((i, len(runs), *first, sha(listed), sha(b" ".join(w for k, w in enumerate(words) if k not in gone))))
    return out


def phrases(rows, least=30, top=2000):
    """rows: (lang, text)."""
    said, n = defaultdict(int), defaultdict(int)
    for lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", az(raw(t))):
            w = [x.decode() for x in re.findall(rb"[^ \t]+", piece)]
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    said[lang, tuple(w[i : i + k])] += 1
    candidates = {key: a for key, a in said.items() if a >= least and len(key[1]) > 1}
    most = defaultdict(int)
    for (lang, p), a in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                most[lang, p[i : i + k]] = max(most[lang, p[i : i + k]], a)
    by_lang = defaultdict(list)
    for (lang, p), a in candidates.items():
        if 100 * most[lang, p] >= 80 * a:
            continue
        cuts = [(2000000 * a // (said[lang, p[:k]] + said[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(p).encode(), said[lang, p[:k]], said[lang, p[k:]]))
    out = []
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def repeated_bytes(texts, length=400):
    """(n_bytes, spans, kept) of each text."""
    starts = defaultdict(int)
    data = [raw(t) for t in texts]
    for b in data:
        for x in range(len(b) - length + 1):
            starts[b[x : x + length]] += 1
    out = []
    for b in data:
        gone = bytearray(len(b))
        for x in range(len(b) - length + 1):
            if starts[b[x : x + length]] > 1:
                gone[x : x + length] = b"\1" * length
        spans = [(m.start(), m.end() - m.start()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((len(b), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out
