"""Personal data replaced by keyed surrogates.

Every detected entity (mail address, phone, card, account, network address,
identity number, secret, name) gets a replacement of its own type and format:
digits for digits with the separators kept, valid check digits, the same case,
names of the same gender and script.  A surrogate is a keyed function of the
entity, so it is the same wherever the entity occurs (coreference), and nobody
without the key can tell whose it is.

Distinctness is checked over the whole corpus: the distinct entities get a
first candidate each; one whose candidate is taken by another entity, or is
itself an entity found in the corpus, tries its next candidate, until none is
left.  Later candidates come from the whole space of the entity's format (made
names grow instead).  A space that is nearly used up is listed and paired with
its entities by rank, so that no number of entities ends the job.  Then the
mapping comes back to the documents that mention it.  The joins are on
entities or documents, never on a group gathered in one task.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from functools import reduce
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import id_order, scratch, text_of

#: For tests and demonstrations; pass a secret key of your own.
DEMO_KEY = b"not a secret"
#: Candidates taken from the pool or the narrow format before the whole space is drawn from.
POOL_TRIES = 8
#: Rounds before a space of at most DENSE times its entities is listed and paired by rank.
LAST_RESORT = 24
DENSE = 16
#: Members of a space made in one task, and slices in which its members are ranked.
MEMBERS_PER_TASK = 100_000
SLICES = 4096

# Name parts by script and gender, titles by gender.
GIVEN = {
    ("latin", "m"): "Adam Andreas Antonio Carlos Daniel David Felix Hans Jack Jean John Jose Juan Karl Louis Luis Marc Martin Michael Oscar Paul Peter Pierre Robert Thomas William".split(),
    ("latin", "f"): "Alice Ana Anna Carla Carmen Claire Clara Elena Elisa Emma Eva Helen Ingrid Julia Laura Lucia Maria Marie Martha Mary Monika Nadia Olivia Petra Sarah Sofia".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
    ("cyrillic", "f"): "Александра Анна Вера Галина Дарья Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
}
HAN_FAMILY = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗"
HAN_GIVEN = {"m": "伟强磊军勇杰涛明超刚平辉健鹏华飞斌波浩宇", "f": "芳娜敏静丽艳娟霞秀梅玲燕红英兰萍莉雪琳洁"}
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr г-н господин".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra г-жа госпожа".split(),
    "n": "Dr Prof".split(),
}
HAN_TITLES = {"先生": "m", "女士": "f", "小姐": "f"}
SYLLABLES = {"latin": "ba be bo da de do fa fe ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo".split(), "cyrillic": "ба ва га да ка ла ма на па ра са та бо во го до ко ло мо но по ро со то".split()}
NAME_END = {("latin", "m"): "n", ("latin", "f"): "a", ("cyrillic", "m"): "н", ("cyrillic", "f"): "а"}

#: What may stand in a place of a template.
PLACES = {
    "\x01": "0123456789",
    "\x02": "abcdefghijklmnopqrstuvwxyz0123456789",
    "\x03": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789/+_-",
    "\x04": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "\x05": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "\x06": (*map(str, range(256)), *(f"0{k}" for k in range(10))),
    "\x0e": HAN_FAMILY,
    "\x0f": "".join(map(chr, range(0x4E00, 0xA000))),
}

_TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_GIVEN_CLASS = {n: key for key, names in GIVEN.items() for n in names}
_CAPITAL = r"[^\W\d_a-zà-öø-ÿа-яё][^\W\d_]+"
_TITLED = re.compile(rf"\b({'|'.join(map(re.escape, sorted(_TITLE_GENDER, key=len, reverse=True)))})\b\.?[ \t]+({_CAPITAL})(?:[ \t]+({_CAPITAL}))?")
_NAMED = re.compile(rf"\b({'|'.join(sorted([*_GIVEN_CLASS, *map(str.upper, _GIVEN_CLASS)], key=len, reverse=True))})[ \t]+({_CAPITAL})")
_WORD = re.compile(rf"\b{_CAPITAL}\b")
_HAN = re.compile(rf"([{HAN_FAMILY}][\u4e00-\u9fff]{{1,2}})(?=({'|'.join(HAN_TITLES)}))")
_MAIL = re.compile(r"(?<![A-Za-z0-9._+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_SECRET = re.compile(r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b[\"']?\s*[=:]\s*[\"']?)([A-Za-z0-9/+_\-]{8,})")
_ACCESS = re.compile(r"\b(?:AKIA|ASIA)([0-9A-Z]{16})\b")
_ADDRESS = re.compile(r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d]|\.\d)")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_CARD = re.compile(r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)")
_PERSON = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\+\d{2,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)")
_DIGIT = re.compile(r"\d")

_LETTERS: dict[str, str] = {}  # filled by _letters; a plain dict travels to workers by value

KINDS = ("email", "phone", "card", "account", "address", "person", "secret", "name")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _iban_rest(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and 98 - _iban_rest(s[:2], s[4:]) == int(s[2:4])


def _letters(script: str) -> str:
    """The lower-case letters (or those without case) that Unicode names after a script, apart from mere forms of others."""
    if script not in _LETTERS:
        mine = (c for c in map(chr, range(0x20000)) if unicodedata.name(c, "").startswith(script.upper() + " ") and c.isalpha())
        _LETTERS[script] = "".join(c for c in mine if c.casefold() == c == c.capitalize().casefold() and unicodedata.normalize("NFKC", c) == c)
    return _LETTERS[script]


def _script(word: str) -> str:
    if word[0] < "\u0250":
        return "latin"
    if "\u0400" <= word[0] <= "\u04ff":
        return "cyrillic"
    script = unicodedata.name(word[0], "latin").split()[0].lower()
    return script if script in SYLLABLES or len(_letters(script)) >= 10 else "latin"


def _names(text: str) -> list[tuple[int, int, str, str]]:
    found = []

    def given(a: int, b: int, gender: str) -> None:
        word = text[a:b]
        script, known = _GIVEN_CLASS.get(word.capitalize(), (_script(word), gender))
        gender = known if gender == "n" else gender
        found.append((a, b, f"given|{'m' if gender == 'n' else gender}|{script}", word.casefold()))

    def family(a: int, b: int) -> None:
        found.append((a, b, f"family||{_script(text[a:b])}", text[a:b].casefold()))

    for m in _TITLED.finditer(text):
        gender = _TITLE_GENDER[m[1]]
        if m[3]:
            given(*m.span(2), gender)
            family(*m.span(3))
        elif m[2].capitalize() in _GIVEN_CLASS:
            given(*m.span(2), gender)
        else:
            family(*m.span(2))
    for m in _NAMED.finditer(text):
        given(*m.span(1), "n")
        family(*m.span(2))
    for m in _HAN.finditer(text):
        found.append((*m.span(1), f"han|{HAN_TITLES[m[2]]}|han", m[1]))
    return found + _later(text, found)


def _later(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """The other mentions in a text of the names found in it, each as where the name stands first."""
    if not found:
        return []
    first: dict[str, str] = {}
    for _, _, kind, canon in sorted(found):
        first.setdefault(canon, kind)
    more = []
    if any(not kind.startswith("han|") for kind in first.values()):
        for m in _WORD.finditer(text):
            canon = m[0].casefold()
            if canon in first:
                more.append((*m.span(), first[canon], canon))
    # Han names stand between no word boundaries; of two that begin alike the longer one counts
    han = sorted((c for c, kind in first.items() if kind.startswith("han|")), key=lambda c: (-len(c), c))
    if han:
        more += [(*m.span(), first[m[0]], m[0]) for m in re.finditer("|".join(han), text)]
    return more


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of the entities of a text, in order, without overlaps.

    Where two overlap, the one looked for first stays.  The canonical form is
    what coreferent mentions share: digits without separators, lower case.
    """
    found: list[tuple[int, int, str, str]] = []
    if "=" in text or ":" in text:
        found += [(*m.span(1), "secret", m[1]) for m in _SECRET.finditer(text)]
    if "AKIA" in text or "ASIA" in text:
        found += [(*m.span(1), "secret", m[1]) for m in _ACCESS.finditer(text)]
    if "@" in text:
        found += [(*m.span(), "email", m[0].lower()) for m in _MAIL.finditer(text)]
    if _DIGIT.search(text):
        found += [(*m.span(), "account", m[0].replace(" ", "")) for m in _IBAN.finditer(text) if _iban(m[0])]
        found += [(*m.span(), "address", m[0]) for m in _ADDRESS.finditer(text)]
        for m in _CARD.finditer(text):
            digits = re.sub(r"\D", "", m[0])
            if luhn(digits):
                found.append((*m.span(), "card", digits))
        found += [(*m.span(), "person", re.sub(r"\D", "", m[0])) for m in _PERSON.finditer(text)]
        found += [(*m.span(), "phone", re.sub(r"\D", "", m[0])) for m in _PHONE.finditer(text)]
    found += _names(text)
    # in the order of places, the one looked for first winning
    order = sorted(range(len(found)), key=lambda i: (found[i][0], i))
    kept: list[tuple[int, int, int]] = []
    for i in order:
        while kept and found[i][0] < kept[-1][1] and i < kept[-1][2]:
            kept.pop()
        if not kept or found[i][0] >= kept[-1][1]:
            kept.append((found[i][0], found[i][1], i))
    return [found[i] for _, _, i in kept]


class _Stream:
    """Keyed pseudo-random numbers of one entity and attempt."""

    def __init__(self, key: bytes, *parts: str):
        self.seed = hashlib.blake2b("\x1f".join(parts).encode(), key=hashlib.blake2b(key).digest()).digest()
        self.block, self.left = 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left = hashlib.blake2b(self.seed + self.block.to_bytes(8, "big")).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return value % n

    def of(self, items):
        return items[self.below(len(items))]


def _like(s: _Stream, text: str) -> str:
    """Digits for digits, letters for letters of the same case (hexadecimal ones if all are), the rest as it is."""
    hexadecimal = not set(text.lower()) - set("0123456789abcdef")
    letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"
    out = []
    for c in text:
        if c.isdigit() and c.isascii():
            out.append(s.of("0123456789"))
        elif c.isalpha() and c.isascii():
            d = s.of(letters)
            out.append(d.upper() if c.isupper() else d)
        else:
            out.append(c)
    return "".join(out)


def _kept(canon: str) -> int:
    """Octets of a private or loopback address that say so."""
    octets = canon.split(".")
    return {"10": 1, "127": 1}.get(octets[0], 2 if octets[:2] == ["192", "168"] else 0)


def template(kind: str, canon: str) -> str | None:
    """The space an entity's surrogates are from: fixed characters, and keys of PLACES; None for names that grow."""
    if kind == "email":
        head, _, top = canon.rpartition(".")
        return "".join("\x02" if c.isalnum() else c for c in head) + "." + top
    if kind == "card":
        return canon[0] + "\x01" * (len(canon) - 1)
    if kind == "account":
        return canon[:2] + "\x01\x01" + "".join("\x01" if c.isdigit() else "\x05" for c in canon[4:])
    if kind == "address":
        keep = _kept(canon)
        return ".".join([*canon.split(".")[:keep], *["\x06"] * (4 - keep)])
    if kind == "phone":
        keep = max(0, len(canon) - 10)
        return canon[:keep] + "\x01" * (len(canon) - keep)
    if kind == "person":
        return "\x01" * len(canon)
    if kind == "secret":
        return ("\x04" if set(canon) <= set(PLACES["\x04"]) else "\x03") * len(canon)
    return "\x0e" + "\x0f" * (len(canon) - 1) if kind.startswith("han|") else None


def _places(space: str) -> list:
    return [PLACES.get(c, c) for c in space]


def _member(space: str, k: int) -> str:
    out = []
    for place in reversed(_places(space)):
        k, at = divmod(k, len(place))
        out.append(place[at])
    return "".join(reversed(out))


def _belongs(kind: str, space: str, value: str) -> bool:
    """Whether the value is of that space alone, with its check digits."""
    return template(kind, value) == space and (kind != "card" or luhn(value)) and (kind != "account" or _iban(value))


def candidate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The surrogate, in canonical form, that an entity tries at this attempt."""
    s = _Stream(key, kind, canon, str(attempt))
    if attempt >= POOL_TRIES and kind not in ("card", "account") and (space := template(kind, canon)):
        return "".join(s.of(place) for place in _places(space))
    if kind == "email":
        local, _, domain = canon.partition("@")
        host, _, top = domain.rpartition(".")
        # mail addresses of one domain share its surrogate
        return _like(s, local) + "@" + _like(_Stream(key, "domain", domain), host) + "." + top
    if kind == "card":
        body = canon[0] + "".join(s.of("0123456789") for _ in canon[2:])
        return next(body + d for d in "0123456789" if luhn(body + d))
    if kind == "account":
        body = _like(s, canon[4:])
        return f"{canon[:2]}{98 - _iban_rest(canon[:2], body):02d}{body}"
    if kind == "address":
        octets, keep = canon.split("."), _kept(canon)
        return ".".join([*octets[:keep], *(str(1 + s.below(254)) for _ in octets[keep:])])
    if kind == "phone":
        keep = max(0, len(canon) - 10) if len(canon) >= 10 else 0
        rest = "".join(s.of("0123456789") for _ in canon[keep:])
        return canon[:keep] + s.of("23456789") + rest[1:]
    if kind in ("person", "secret"):
        return _like(s, canon)
    part, gender, script = kind.split("|")
    if part == "han":
        return s.of(HAN_FAMILY) + "".join(s.of(HAN_GIVEN[gender]) for _ in canon[1:])
    if script not in SYLLABLES:
        if script == "cjk" and attempt < POOL_TRIES:
            return s.of(HAN_FAMILY) + "".join(s.of(HAN_GIVEN["m"] + HAN_GIVEN["f"]) for _ in canon[1:])
        return "".join(s.of(_letters(script)) for _ in range(len(canon) + attempt // POOL_TRIES))
    if part == "given" and attempt < POOL_TRIES:
        return s.of(GIVEN[script, gender]).casefold()
    name = "".join(s.of(SYLLABLES[script]) for _ in range(2 + s.below(2) + attempt // POOL_TRIES))
    return name + (NAME_END[script, gender] if part == "given" else s.of(NAME_END[script, "m"] + NAME_END[script, "f"]))


def render(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the format of a mention: its separators, its case."""
    if kind in ("card", "person", "phone", "account"):
        it = iter(surrogate)
        return "".join(next(it) if c.isalnum() else c for c in mention)
    if kind == "email":
        return "".join(b.upper() if a.isupper() else b for a, b in zip(mention, surrogate, strict=True))
    if "|" in kind and not kind.startswith("han"):
        return surrogate.upper() if mention.isupper() else surrogate.capitalize()
    return surrogate


def _mentions(batches):
    for batch in batches:
        rows = set()
        for id_, key, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            rows.update((id_, key, kind, canon) for _, _, kind, canon in detect(text))
        if rows:
            columns = list(zip(*sorted(rows), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "key", "kind", "canon"])


def _candidates(key: bytes, attempt: int):
    def run(batches):
        for batch in batches:
            rows = []
            for kind, canon in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                made, space = candidate(key, kind, canon, attempt), template(kind, canon)
                if made != canon and (space is None or _belongs(kind, space, made)):
                    rows.append((kind, canon, made))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["kind", "canon", "surrogate"])

    return run


def _spaces(batches):
    for batch in batches:
        kinds, canons = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        spaces = [template(k, c) for k, c in zip(kinds, canons, strict=True)]
        sizes = [float(math.prod(map(len, _places(s)))) if s else None for s in spaces]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spaces, pa.string()), pa.array(sizes, pa.float64())], ["kind", "canon", "space", "size"])


def _members(batches):
    for batch in batches:
        for kind, space, first, last in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            values = [v for v in (_member(space, k) for k in range(first, last)) if _belongs(kind, space, v)]
            n = len(values)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.string()), pa.array([space] * n, pa.string()), pa.array(values, pa.string())], ["kind", "space", "value"])


def _drawn(key: bytes):
    """Adds the value's place in a keyed order."""

    def run(batches):
        secret = hashlib.blake2b(key).digest()
        for batch in batches:
            at = [hashlib.blake2b(f"{k}\x1f{v}".encode(), key=secret, digest_size=16).hexdigest() for k, v in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.string())], ["kind", "space", "value", "at"])

    return run


def _ranked(values: DataFrame, key: bytes) -> DataFrame:
    """kind, space, value, rank (from 0, in a keyed order): ranks within slices, and the sizes of the slices before."""
    drawn = values.mapInArrow(_drawn(key), "kind string, space string, value string, at string")
    drawn = scratch(drawn.withColumn("slice", F.conv(F.substring("at", 1, 8), 16, 10).cast("bigint") % SLICES), "drawn")
    by = Window.partitionBy("kind", "space")
    before = F.sum("n").over(by.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sizes = drawn.groupBy("kind", "space", "slice").agg(F.count("*").alias("n"))
    sizes = sizes.select("kind", "space", "slice", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("kind", "space", "slice").orderBy("at", "value")) - 1
    return drawn.withColumn("within", within).join(sizes, ["kind", "space", "slice"]).select("kind", "space", "value", (F.col("before") + F.col("within")).alias("rank"))


def _paired(spaces: DataFrame, known: DataFrame, key: bytes) -> DataFrame:
    """kind, canon, surrogate for all entities of whole spaces (``spaces``: kind, space, size; ``known``: kind, canon, space).

    The entities take the members that are no entity; if these do not reach,
    the rest take entities' own forms, in an order in which none meets itself.
    """
    ours = known.join(spaces.select("kind", "space"), ["kind", "space"]).select("kind", "space", F.col("canon").alias("value"))
    ours = scratch(_ranked(ours, key), "ranked")
    size = F.col("size").cast("bigint")
    starts = F.explode(F.sequence(F.lit(0), size - 1, F.lit(MEMBERS_PER_TASK))).alias("first")
    parts = spaces.select("kind", "space", "size", starts).select("kind", "space", "first", F.least(F.col("first") + MEMBERS_PER_TASK, size).alias("last"))
    members = parts.repartition("kind", "space", "first").mapInArrow(_members, "kind string, space string, value string")
    free = scratch(_ranked(members.join(ours, ["kind", "space", "value"], "left_anti"), key), "free")
    n_ours = ours.groupBy("kind", "space").agg(F.count("*").alias("n"))
    n_free = free.groupBy("kind", "space").agg(F.count("*").alias("m"))
    sizes = n_ours.join(n_free, ["kind", "space"], "left").withColumn("m", F.coalesce("m", F.lit(0)))
    # targets: the free members, then the entities in turn, one further where all members are entities
    turn = F.when(F.col("m") == 0, F.pmod(F.col("rank") - 1, F.col("n"))).otherwise(F.col("rank") + F.col("m"))
    again = ours.join(sizes, ["kind", "space"]).select("kind", "space", F.col("value").alias("surrogate"), turn.alias("rank"))
    targets = free.select("kind", "space", F.col("value").alias("surrogate"), "rank").unionByName(again)
    return ours.join(targets, ["kind", "space", "rank"]).select("kind", F.col("value").alias("canon"), "surrogate")


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, canon, surrogate: one-to-one within a kind, and no surrogate is an entity itself.

    Given names and Han names are exempt from the last check (their pools are
    the names in use), but none is its own surrogate.  So are entities that their space has no room for
    otherwise (of more than half its members).
    """
    entities = scratch(entities.select("kind", "canon").distinct(), "entities")
    pending, done = entities, []
    real = entities.where(~F.col("kind").rlike(r"^(given|han)\|")).select("kind", F.col("canon").alias("surrogate"))
    for attempt in count():
        tried = scratch(pending.mapInArrow(_candidates(key, attempt), "kind string, canon string, surrogate string"), "tried")
        fair = tried.join(real, ["kind", "surrogate"], "left_anti")
        if done:
            fair = fair.join(reduce(DataFrame.unionByName, done).select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("canon"))
        won = scratch(fair.withColumn("turn", first).where("turn = 1").select("kind", "canon", "surrogate"), "assigned")
        done.append(won)
        pending = scratch(pending.join(won, ["kind", "canon"], "left_anti"), "pending")
        if attempt + 1 >= LAST_RESORT and pending.limit(1).count():
            known = scratch(entities.mapInArrow(_spaces, "kind string, canon string, space string, size double"), "spaces")
            full = pending.join(known, ["kind", "canon"]).where("space IS NOT NULL").select("kind", "space").distinct()
            full = known.join(full, ["kind", "space"]).groupBy("kind", "space", "size").agg(F.count("*").alias("n"))
            full = scratch(full.where(F.col("size") <= DENSE * F.col("n")).drop("n"), "full")
            if full.limit(1).count():
                # spaces do not overlap, so each is paired anew as a whole
                paired = scratch(_paired(full, known, key), "paired")
                others = reduce(DataFrame.unionByName, done).join(paired, ["kind", "canon"], "left_anti")
                done = [scratch(others.unionByName(paired), "assigned")]
                pending = scratch(pending.join(paired, ["kind", "canon"], "left_anti"), "pending")
        if not pending.limit(1).count():
            return scratch(reduce(DataFrame.unionByName, done), "surrogates")
    raise AssertionError("unreachable")


def _replace(names: list[str], text_at: int):
    def run(batches):
        for batch in batches:
            out = list(batch.columns[:-1])
            texts, pairs = out[text_at].to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            counts = []
            for i, (text, found) in enumerate(zip(texts, pairs, strict=True)):
                count = dict.fromkeys(KINDS, 0)
                if found:
                    surrogate = {(p["kind"], p["canon"]): p["surrogate"] for p in found}
                    parts, last = [], 0
                    for a, b, kind, canon in detect(text):
                        parts += [text[last:a], render(kind, text[a:b], surrogate[kind, canon])]
                        last = b
                        count["name" if "|" in kind else kind] += 1
                    texts[i] = "".join([*parts, text[last:]])
                counts.append(count)
            out[text_at] = pa.array(texts, pa.string())
            out += [pa.array([c[k] for c in counts], pa.int32()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(out, names)

    return run


def pseudonymize(docs: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    """``docs`` with the entities in its text replaced, and __n_<kind> mentions replaced of each kind.

    Defined cases: a null text stays null, an empty one empty; texts without
    an entity are unchanged; repeated rows are rewritten alike; rows of one
    doc_id with different texts are rewritten apart; an empty table gives no
    rows; extra columns stay.
    """
    keyed = docs.withColumn("__order", id_order()).withColumn("__key", F.xxhash64(text_of()))
    rows = keyed.select("__order", "__key", text_of().alias("text"))
    mentions = scratch(rows.mapInArrow(_mentions, "id bigint, key bigint, kind string, canon string"), "mentions")
    known = assign(mentions, key)
    pairs = mentions.distinct().join(known, ["kind", "canon"]).groupBy(F.col("id").alias("__i"), F.col("key").alias("__k"))
    pairs = scratch(pairs.agg(F.collect_list(F.struct("kind", "canon", "surrogate")).alias("__pairs")), "pairs")
    # by a shuffle at every size, so that the plan does not turn over as the corpus grows
    joined = keyed.join(pairs.hint("merge"), (F.col("__order") == F.col("__i")) & (F.col("__key") == F.col("__k")), "left")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(f"__n_{k}", T.IntegerType()) for k in KINDS)])
    return joined.select(*docs.columns, "__pairs").mapInArrow(_replace([f.name for f in schema], docs.columns.index("text")), schema)


def op1_pii_surrogates(docs: DataFrame) -> DataFrame:
    """doc_id, text (rewritten), n_entities, and n_<kind> for each kind."""
    done = pseudonymize(docs.select("doc_id", "text"))
    counts = [F.col(f"__n_{k}") for k in KINDS]
    return done.select("doc_id", "text", reduce(lambda a, b: a + b, counts).alias("n_entities"), *[c.alias(f"n_{k}") for c, k in zip(counts, KINDS, strict=True)])
