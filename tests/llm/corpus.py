"""A small corpus with the cases that matter, planted."""

import random

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score double, kept boolean, id string, key int, h int, n_words int, words array<string>"
ITEMS = "item_id bigint, text string, len int, wid string, words string"


def vocabulary(rng, n):
    return ["".join(rng.choice(["ka", "lo", "mi", "né", "su", "Ta", "vor", "ünd", "xi", "ж"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(rng, words, n):
    out = []
    for k in range(n):
        out.append(rng.choice(words) + rng.choice(["", "", "", ",", "."]))
        out.append(rng.choice([" ", " ", " ", " ", " ", "  ", "\t", "\n"]))
    return "".join(out)


def documents(seed=3):
    """Rows (doc_id, text, lang, source, n_chars, and clashing columns)."""
    rng = random.Random(seed)
    words = vocabulary(rng, 3000)
    passage = " ".join(rng.choice(words) for _ in range(70))
    line = "All rights reserved by the holders, see the licence"
    texts = [prose(rng, words, rng.randint(60, 220)) for _ in range(24)]
    texts += [texts[0], texts[0], texts[5], texts[5].replace(" ", "  ", 3)]  # whole copies; one differs in white space only
    for k in (1, 2, 3, 3, 3):  # near copies: a word replaced
        parts = texts[k].split(" ")
        parts[rng.randrange(5, len(parts))] = "anderswo"
        texts.append(" ".join(parts))
    texts += [prose(rng, words, 30) + " " + passage + " " + prose(rng, words, 40) for _ in range(4)]
    texts += [passage, passage + " " + passage, " ".join(passage.split()[:49]), " ".join(passage.split()[10:60])]
    texts += [prose(rng, words, 20) + "\n" + v + "\n" + prose(rng, words, 20) for v in (line, line.upper(), f"  {line}\t", line + "!")]
    texts += [line, "kurz\nkurz\n" + line, "ÄÖÜäöüßéèê\nx", "äöüäöüßéèê\nx", "ÄÖÜäöüßéèê"]
    texts += ["", " \t\n\r\x0b\x0c ", "\n\n", "!!! ... ???", "wort", "Zwei Worte", "a b c", "A B C", " 　 b", "İstanbul K elvin İ"]
    texts += ["gleich " * 400, ("eins zwei drei vier fünf sechs " * 3).strip(), "# * $ % & | < > " * 20, "x" * 5000, "\n".join(["eine Zeile mit Worten"] * 12)]
    texts += [prose(rng, words, 9000), " ".join(f"w{k}" for k in range(15000))]
    texts += [it + " und noch mehr davon" for it in ("Alpha beta gamma", "Kelvin kelvin")]
    rows = [(k * 3 % 101, t) for k, t in enumerate(texts)]
    rows += [(200, None), (201, None), (None, texts[7]), (None, None), (None, "nur hier " + passage), rows[9], rows[9], (202, texts[4])]
    rng.shuffle(rows)
    sources = ["web", "Web", "wiki", "böcker", None, "web", "web"]
    full = []
    for k, (i, t) in enumerate(rows):
        source = sources[(0 if i is None else i) % len(sources)]
        full.append((i, t, "en", source, None if t is None else len(t), "size", 0.5, None, "id", 1, 2, 3, ["x"]))
    return full


def items(rows):
    """Benchmark rows over passages of the documents."""
    rng = random.Random(5)
    long = [t for _, t, *_ in rows if t and len(t.split()) > 100]
    out = []
    for k in range(6):
        words = rng.choice(long).split()
        a = rng.randrange(len(words) - 40)
        out.append((k, " ".join(words[a : a + rng.choice([13, 14, 20, 30])]).upper() if k % 2 else " ".join(words[a : a + 25])))
    out += [(6, "Alpha-beta, GAMMA!"), (7, "kelvin"), (8, ""), (9, None), (10, "..."), (None, "Zwei Worte"), (11, "nirgends zu finden " * 6), (12, out[0][1]), (13, "a b"), (0, "eins zwei drei vier")]
    return [(i, t, 1, "w", "x") for i, t in out]
