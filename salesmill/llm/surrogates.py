"""Operator 3: personal data replaced by keyed surrogates.

Detected are e-mail addresses, phone, card, account (IBAN) and social-security
numbers, IP addresses, secrets (values given for a token, key or password, and
long hexadecimal strings) and names led by a title. An entity is a kind and a
canonical form (digits without separators, lower case where case means nothing).
Its surrogate comes from an HMAC of both under a secret key and keeps kind and
format: letters of the same script and case, digits for digits, country codes,
the first digit of a card and whether its check digit fits, the gender that the
titles of a name tell. A name is one entity under all its titles, an international
number under all notations. A mention keeps its own separators and case.

Every entity of the corpus has one surrogate, so mentions stay coreferent. Different
entities keep different ones, and no surrogate is an entity that occurs: Spark
groups what is proposed, in use and real by value, the smallest entity keeps a
contested value, and the others draw again until none is left. From the
``LOOSE``-th draw on surrogates also get longer, so small formats cannot run out.

Entities and surrogates meet the texts by joins, and only texts with entities
are shuffled.

Defined results: rows keep all their columns; a null text stays null, an empty one
empty; texts without entities are unchanged; repeated rows are replaced alike; a
null ``doc_id`` is kept; an empty table gives no rows. A column ``n_replaced`` is
added, in the place of one of that name.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import arrow_batch, lean, read, saved, slices, small_batches

KEY = b"surrogates of the checks"  # a user passes a secret of their own
LOOSE = 6
BATCH_BYTES = 2 << 20

# Titles and the gender they tell: fixed values.
TITLES = {
    "Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sir": "m", "Господин": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Госпожа": "f",
    "Dr": "n", "Prof": "n",
}
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
# Particles inside a name: fixed values.
PARTICLES = (
    "von vom van den der dem zu zum zur de del della dello di da do dos das du des la le las los al el bin bint ibn "
    "abu ben ter ten te af av"
).split()
_SMALL = "".join(c for c in map(chr, range(0x80, 0x10000)) if c.islower() and c.isalpha())
_UP = rf"[^\W\d_a-z{_SMALL}]"
_REST = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_FULL = rf"(?!(?:{_TITLE})\b)(?:{_UP}|(?:[dl]|al|el|[OD])[-'’]{_UP})(?:{_REST}|['’]{_REST})"
_BEFORE = rf"(?:{'|'.join(PARTICLES)}) |(?:{_UP}\.[ -]?)++(?<=[ .-])|{_UP} (?={_UP})"
# Initials and particles, then capitalised parts in any number; the first part may be of any letter but a-z.
_NAME = (
    rf"(?:{_BEFORE})*(?:{_FULL}|(?!(?:{_TITLE})\b)[^\W\d_a-z]{_REST})"
    rf"(?: (?:{_BEFORE})*{_FULL}| (?:{_UP}\.)+)*"
)
# Country codes of one and two digits; all others have three. No code begins another.
_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
_COUNTRY = re.compile(rf"{_CODES}|\d{{3}}")
_ON = r"(?:\)?[ .\-]?\(?\d)"

# In order of precedence; the last group that matched is what gets replaced.
PATTERNS = (
    ("secret", re.compile(
        r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s*[:=]\s*[\"']?"
        r"([A-Za-z0-9_\-./+]{12,})"
    )),
    ("secret", re.compile(r"\b([0-9a-f]{32,}|[0-9A-F]{32,})\b")),
    ("email", None),  # found from its @ by ``addresses``
    ("iban", re.compile(r"\b([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")),
    ("card", re.compile(r"(?<![\w.\-+])(\d(?:[ -]?\d){12,18})(?![\w\-])")),
    ("ip", re.compile(r"(?<![\w.])((?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\.?\w)")),
    ("ssn", re.compile(r"(?<![\w\-])(\d{3}-\d{2}-\d{4})(?![\w\-])")),
    ("phone", re.compile(
        # A number ends with the group that fills it: ten digits after 1 and 7, twelve after other codes.
        rf"(?<![\w+.\-])(\+(?:\d{{7,15}}(?!\d)|[17]{_ON}{{6,10}}(?!\d)|(?:{_CODES}|\d{{3}}){_ON}{{4,12}}(?!\d))"
        r"|\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?![\w\-])"
    )),
    ("name", None),  # found behind its titles by ``titled``
)
_LOCAL = re.compile(r"[A-Za-z0-9._%+\-]*")
_DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
_LETTER_OR_DIGIT = re.compile(r"[A-Za-z0-9]")
_LOCAL_END = re.compile(r"[A-Za-z0-9_+\-]")
_TITLES = re.compile(rf"\b(?:(?:{_TITLE})\.? )++")
_TITLED = re.compile(_NAME)
_ANY_TITLE = re.compile(rf"\b(?:{_TITLE})\b")
_DIGIT = re.compile(r"\d")
_ASKS = re.compile(r"(?i)token|secret|passw|key")
# Texts without any of these hold no entity; for Spark's regular expressions.
MAYBE = rf"\p{{Nd}}|@|(?i:token|secret|passw|key)|{_TITLE}"
# Letters a drawn name is made of, by script: consonants, vowels.
LETTERS = {"LATIN": ("bdfgklmnprstv", "aeiou"), "CYRILLIC": ("бвгдзклмнпрст", "аеиоу")}


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of what is found, in order, without overlap."""
    digits, at, title = _DIGIT.search(text), "@" in text, _ANY_TITLE.search(text)
    if not (digits or at or title or _ASKS.search(text)):
        return []
    taken: list[tuple[int, int, str, str]] = []
    starts: list[int] = []
    ends: list[int] = []
    for kind, pattern in PATTERNS:
        if kind == "email" and not at or kind == "name" and not title:
            continue
        if kind in ("iban", "card", "ip", "ssn", "phone") and not digits:
            continue
        # What is taken already ends a phone number, whatever it looks like.
        where = _masked(text, taken) if kind == "phone" else text
        finder = {"email": addresses, "name": titled}.get(kind)
        spans = finder(text) if finder else ((*m.span(1), m[0]) for m in pattern.finditer(where))
        for s, e, whole in spans:
            # Spans do not overlap, so starts and ends have one order.
            i = bisect.bisect_left(starts, s)
            if (i == 0 or ends[i - 1] <= s) and (i == len(starts) or starts[i] >= e):
                name = canonical(kind, where[s:e], whole)
                if name:
                    starts.insert(i, s)
                    ends.insert(i, e)
                    taken.append((s, e, *name))
    return sorted(taken)


def addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, address) of e-mail addresses: from each @ back and forth, so every character is read a few times."""
    back, done, at = text[::-1], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain and at and _LOCAL_END.match(text, at - 1):
            first = max(done, len(text) - _LOCAL.match(back, len(text) - at).end())
            start = _LETTER_OR_DIGIT.search(text, first, at)
            if start:
                done = domain.end()
                yield start.start(), done, text[start.start() : done]
        at = text.find("@", at + 1)


def titled(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, name with its titles) of names; a run of titles is read once."""
    titles = _TITLES.search(text)
    while titles:
        name = _TITLED.match(text, titles.end())
        if name:
            yield *name.span(), text[titles.start() : name.end()]
        titles = _TITLES.search(text, (name or titles).end())


def _masked(text: str, taken: list[tuple[int, int, str, str]]) -> str:
    parts, at = [], 0
    for s, e, *_ in sorted(taken):
        parts += [text[at:s], "_" * (e - s)]
        at = e
    return "".join([*parts, text[at:]])


def canonical(kind: str, mention: str, whole: str) -> tuple[str, str] | None:
    if kind in ("card", "ssn", "phone"):
        digits = re.sub(r"\D", "", mention)
        if kind == "phone" and not 7 <= len(digits) <= 15:
            return None
        # A leading country code is part of the format that has to stay.
        if mention.startswith("+"):
            digits = re.sub(r"\D", "", mention.replace("(0)", ""))
            code = _COUNTRY.match(digits)[0]
            return kind, f"{code}+{digits[len(code) :]}"
        return kind, digits
    if kind == "iban":
        return kind, mention.replace(" ", "")
    if kind == "email":
        return kind, mention.lower()
    if kind == "name":
        # All titles before the name; those without a gender say nothing.
        told = {TITLES[t] for t in _ANY_TITLE.findall(whole[: len(whole) - len(mention)])} - {"n"}
        return f"name-{told.pop() if len(told) == 1 else 'n'}", " ".join(mention.split()).lower()
    if kind == "secret" and mention.isalpha():
        return None  # a word, as in "password: something"
    return kind, mention


class Draw:
    """Numbers drawn from an HMAC of an entity and the turn."""

    def __init__(self, key: bytes, kind: str, name: str, turn: int):
        self.key, self.seed, self.block, self.pool = key, f"{kind}\0{turn}\0{name}".encode(), 0, 1
        self.left = 0

    def below(self, n: int) -> int:
        if self.pool < n << 32:
            digest = hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.left, self.pool, self.block = int.from_bytes(digest, "big"), 1 << 256, self.block + 1
        self.left, out = divmod(self.left, n)
        self.pool //= n
        return out

    def of(self, letters: str) -> str:
        return letters[self.below(len(letters))]

    def like(self, text: str) -> str:
        """A character of the same class for each: hexadecimal strings stay so."""
        if re.fullmatch(r"[0-9a-f]+", text) and re.search("[a-f]", text) and len(text) >= 16:
            return "".join(self.of("0123456789abcdef") for _ in text)
        if re.fullmatch(r"[0-9A-F]+", text) and re.search("[A-F]", text) and len(text) >= 16:
            return "".join(self.of("0123456789ABCDEF") for _ in text)
        return "".join(self.char(c) for c in text)

    def char(self, c: str) -> str:
        if c.isdigit():
            return self.of("0123456789")
        if c.isascii() and c.isalpha():
            drawn = self.of("abcdefghijklmnopqrstuvwxyz")
            return drawn.upper() if c.isupper() else drawn
        return c


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def surrogate(key: bytes, kind: str, name: str, turn: int) -> str:
    """The canonical form of what stands for an entity at its ``turn``-th draw."""
    d = Draw(key, "name" if kind.startswith("name-") else kind, name, turn)
    more = max(0, turn - LOOSE + 1)
    if kind == "email":
        local, _, domain = name.partition("@")
        labels = domain.split(".")
        return f"{d.like(local)}{''.join(d.of('0123456789') for _ in range(more))}@{'.'.join([*map(d.like, labels[:-1]), labels[-1]])}"
    if kind == "ip":
        span = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
        parts = [(0, 256) if more else span[len(p)] for p in name.split(".")]
        return ".".join(str(low + d.below(n)) for low, n in parts)
    if kind == "card":
        body = name[0] + "".join(d.of("0123456789") for _ in name[1:])
        body += "".join(d.of("0123456789") for _ in range(more))
        fits = [body[:-1] + c for c in "0123456789" if luhn(body[:-1] + c)]
        return fits[0] if luhn(name) else body if not luhn(body) else body[:-1] + str((int(body[-1]) + 1) % 10)
    if kind == "iban":
        body = d.like(name[4:]) + "".join(d.of("0123456789") for _ in range(more))
        number = "".join(str(int(c, 36)) for c in body + name[:2] + "00")
        return f"{name[:2]}{98 - int(number) % 97:02d}{body}"
    if kind.startswith("name-"):
        parts = name.split(" ")
        small = [p.endswith(".") or len(p) == 1 or p in PARTICLES and i < len(parts) - 1 for i, p in enumerate(parts)]
        first = small.index(False) if False in small else 0
        return " ".join(
            _drawn_small(d, part) if few and i != first else _drawn_name(d, part, kind[-1], more if i == first else 0)
            for i, (part, few) in enumerate(zip(parts, small))
        )
    if kind == "phone" and "+" in name:
        code, _, rest = name.partition("+")
        return f"{code}+{d.like(rest)}{''.join(d.of('0123456789') for _ in range(more))}"
    return d.like(name) + "".join(d.of("0123456789") for _ in range(more))


def _drawn_name(d: Draw, part: str, gender: str, more: int) -> str:
    script = next((unicodedata.name(c, "").split(" ")[0] for c in part if c.isalpha()), "LATIN")
    consonants, vowels = LETTERS.get(script, LETTERS["LATIN"])
    letters = len(part) + 2 * more
    out = "".join(d.of((consonants, vowels)[i % 2]) for i in range(max(2, letters)))
    ends = {"f": vowels[0], "m": d.of(consonants)}
    return out[:-1] + ends.get(gender, out[-1])


def _drawn_small(d: Draw, part: str) -> str:
    """Another particle, or other initials with the same points."""
    if part in PARTICLES:
        return d.of(PARTICLES)
    cyrillic = any("CYRILLIC" in unicodedata.name(c, "") for c in part)
    consonants, _ = LETTERS["CYRILLIC" if cyrillic else "LATIN"]
    return "".join(d.of(consonants) if c.isalpha() else c for c in part)


def rendered(kind: str, mention: str, drawn: str) -> str:
    """A surrogate in the mention's own separators and case."""
    if kind in ("card", "ssn", "phone", "iban"):
        left = list(drawn.replace("+", ""))
        trunk = mention.find("(0)") + 1 if kind == "phone" and mention.startswith("+") else 0
        out = [left.pop(0) if c.isalnum() and left and (not trunk or i != trunk) else c for i, c in enumerate(mention)]
        return "".join(out + left)
    if kind == "email":
        return drawn.upper() if mention.isupper() else drawn
    if kind.startswith("name-"):
        pairs = zip(mention.split(" "), drawn.split(" "))
        return " ".join(n if m.islower() else n.upper() if m.isupper() else n.title() for m, n in pairs)
    return drawn


FOUND = pa.schema([("kind", pa.string()), ("name", pa.string())])
FOUND_SQL = "kind string, name string"


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entities of each text, each once: (row, kind, name)."""
    for batch in slices(batches, "text", BATCH_BYTES):
        rows: dict = {"row": [], "kind": [], "name": []}
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            for kind, name in sorted({e[2:] for e in entities(text or "")}):
                rows["row"].append(row)
                rows["kind"].append(kind)
                rows["name"].append(name)
        yield arrow_batch(pa.schema([("row", pa.string()), *FOUND]), rows)


def family() -> F.Column:
    """The kind without what a title tells: one name is one entity, whatever its titles."""
    return F.when(F.col("kind").startswith("name-"), "name").otherwise(F.col("kind"))


def inventoried(found: DataFrame) -> DataFrame:
    """(kind, name) of each entity once; a name has the gender that its titles tell, none if they differ."""
    told = lambda g: F.max(F.col("kind") == f"name-{g}")
    gender = F.when(told("m") & ~told("f"), "name-m").when(told("f") & ~told("m"), "name-f").otherwise("name-n")
    return (
        found.groupBy(family().alias("family"), "name")
        .agg(gender.alias("gender"))
        .select(F.when(F.col("family") == "name", F.col("gender")).otherwise(F.col("family")).alias("kind"), "name")
    )


def assigned(inventory: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, name, drawn) of every entity of a table of distinct ones."""

    def drawer(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds, names = batch.column("kind"), batch.column("name")
                drawn = [surrogate(key, k, n, turn) for k, n in zip(kinds.to_pylist(), names.to_pylist())]
                yield pa.RecordBatch.from_pydict({"kind": kinds, "name": names, "drawn": drawn})

        return run

    # Numbers are compared without notation and across their kinds, names across genders.
    digits = F.col("kind").isin("phone", "card", "ssn")
    group = F.when(digits, "digits").otherwise(family()).alias("group")
    plain = lambda col: F.when(digits, F.regexp_replace(col, "\\D", "")).otherwise(F.col(col)).alias("value")
    done, waiting, turn = None, inventory, 0
    while True:
        drawn = saved(waiting.mapInArrow(drawer(turn), f"{FOUND_SQL}, drawn string"), "drawn")
        # By value: real entities and surrogates in use come before any proposal.
        value = lambda df, col, first: df.select(group, plain(col), F.lit(first).alias("p"), "kind", "name")
        claims = value(inventory, "name", 0).unionByName(value(drawn, "drawn", 1))
        if done is not None:
            claims = claims.unionByName(value(done, "drawn", 0))
        holders = claims.groupBy("group", "value").agg(F.min(F.struct("p", "kind", "name")).alias("holder"))
        own = F.col("holder") == F.struct(F.lit(1).alias("p"), "kind", "name")
        judged = saved(
            drawn.select("*", group, plain("drawn"))
            .join(holders, ["group", "value"])
            .select("kind", "name", "drawn", own.alias("kept")),
            "judged",
        )
        kept = judged.where("kept").drop("kept")
        done = kept if done is None else done.unionByName(kept)
        waiting = judged.where("not kept").select("kind", "name")
        turn += 1
        if waiting.isEmpty():
            return done


def replaced(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """The documents with surrogates for all entities, and ``n_replaced``."""
    small_batches(docs.sparkSession)
    docs = docs.drop("n_replaced")
    keyed = docs.withColumn("_row", F.md5(F.col("text").cast("binary")))
    found = keyed.select(F.col("_row").alias("row"), "text").mapInArrow(lean(_finder), f"row string, {FOUND_SQL}")
    found = saved(found.distinct(), "entities")
    names = assigned(saved(inventoried(found), "inventory"), key)
    by_row = (
        found.select("row", family().alias("kind"), "name")
        .distinct()
        .join(names.select(family().alias("kind"), "name", "drawn"), ["kind", "name"])
        .groupBy(F.col("row").alias("_row"))
        .agg(F.collect_list(F.struct("kind", "name", "drawn")).alias("_names"))
    )
    # Only texts that may hold an entity are sent to their surrogates.
    some = keyed.withColumn("_some", F.col("text").rlike(MAYBE))
    plain = some.where("not coalesce(_some, false)").withColumn("n_replaced", F.lit(0))
    joined = some.where("_some").join(by_row, "_row", "left")
    order = [*docs.columns, "_names"]
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", n_replaced int"
    return plain.select(*docs.columns, "n_replaced").unionByName(
        joined.select(*order).mapInArrow(lean(_replacer(docs.columns)), schema)
    )


def _replacer(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            texts, counts = [], []
            for text, names in zip(batch.column("text").to_pylist(), batch.column("_names").to_pylist()):
                n = 0
                if names:
                    drawn = {(e["kind"], e["name"]): e["drawn"] for e in names}
                    parts, at = [], 0
                    for s, e, kind, name in entities(text):
                        parts += [text[at:s], rendered(kind, text[s:e], drawn[kind.split("-")[0], name])]
                        at, n = e, n + 1
                    text = "".join([*parts, text[at:]])
                texts.append(text)
                counts.append(n)
            out = {c: batch.column(c) for c in columns}
            out |= {"text": pa.array(texts, pa.string()), "n_replaced": pa.array(counts, pa.int32())}
            yield pa.RecordBatch.from_pydict(out)

    return run


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return replaced(docs)
