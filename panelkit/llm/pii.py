"""Operator 1: personal data, by patterns and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field, trained from a small labelled table, reads the neighbourhoods of digits,
``@`` and `` at host . com`` (everything it labels has one) and adds what the patterns miss: numbers and addresses in other spellings, and
secrets. Its spans must keep the arithmetic of their kind (check digit, part size, number of digits) and may not touch a
base span. Places count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelkit.llm import crf
from panelkit.llm.common import ship

KINDS = ("email", "ip", "card", "phone", "secret")
#: Rows of the labelled table that training may read.
TRAINING_ROWS = 2_000
#: Characters around a digit, an ``@`` or an `` at `` that the field sees.
AROUND = 48

Span = tuple[str, int, int]

# Possessive quantifiers and the look-behind keep long runs linear; the matches are those of the plain patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@]")
_OPENING = re.compile(r"[0-9@][0-9@.:()+ -]*| at (?=[\w-]+ ?\. ?[\w-])")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from each @ back over the local part, then forward over the domain."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by start and then kind."""
    if not _SIGNAL.search(text):
        return []
    out: list[Span] = [("email", *m) for m in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _small_parts(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sort_spans(out)


def sort_spans(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def join_spans(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def neighbourhoods(text: str) -> list[tuple[int, int]]:
    """Stretches around digits, @ and "at" in front of a host, widened to white space or twice ``AROUND``."""
    out: list[tuple[int, int]] = []
    for m in _OPENING.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        least, most = max(0, a - AROUND), min(len(text), b + AROUND)
        while a > least and not text[a - 1].isspace():
            a -= 1
        while b < most and not text[b].isspace():
            b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _holds(kind: str, text: str) -> bool:
    digits = _digits(text)
    if kind == "email":
        return bool(re.fullmatch(r"[\w.+-]+(?: ?@ ?| at )[\w-]+(?: ?\. ?[\w-]+)+", text))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}", text)) and _small_parts(text.replace(" ", ""))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    return len(text) >= 16 and any(c.isalpha() for c in text) and bool(digits)


class Finder:
    def __init__(self, model: crf.Crf) -> None:
        self.model = model

    def spans(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """Base spans and all spans of each text; the texts' neighbourhoods are decoded together."""
        sequences, origins = [], []
        for row, text in enumerate(texts):
            for a, b in neighbourhoods(text):
                tokens, places, spaced = crf.tokenize(text[a:b])
                if tokens:
                    sequences.append(crf.features(tokens, spaced))
                    origins.append((row, a, places))
        found: list[list[Span]] = [[] for _ in texts]
        for (row, a, places), path in zip(origins, self.model.viterbi(sequences), strict=True):
            k = 0
            while k < len(path):
                end = k + 1
                while end < len(path) and path[end] == path[k]:
                    end += 1
                kind = self.model.labels[path[k]]
                if kind != "O":
                    start, stop = a + places[k][0], a + places[end - 1][1]
                    if _holds(kind, texts[row][start:stop]):
                        found[row].append((kind, start, stop))
                k = end
        out = []
        for text, more in zip(texts, found, strict=True):
            base = base_spans(text)
            added = [s for s in more if not any(s[1] < b[2] and b[1] < s[2] for b in base)] if more else []
            out.append((base, sort_spans(base + added)))
        return out


# The small labelled table. Slots are filled by rule, so that the field learns shapes and surroundings.
_FRAMES = (
    "please write to {email} for more", "{email}", "contact : {email} or call {phone}", "send it to {email} today .",
    "you can reach me at {odd_email} any time", "mail {odd_email} , thanks", "by mail ( {email} ) only",
    "call {phone} now", "phone {odd_phone} after nine", "tel . {odd_phone}", "my number is {odd_phone} and", "{phone}",
    "fax {odd_phone} , mobile {phone}", "the and {phone} of in", "host {ip} is down", "{ip}", "from {ip} to {ip}",
    "connect to {ip} : 8080", "of the {ip} and in", "server address {odd_ip} here", "card {card} valid thru 09 / 27",
    "paid with {card}", "{card}", "number {odd_card} was charged", "on {card} and the", "{odd_card}",
    'token = "{secret}"', 'the and token = "{secret}" of in', 'api_key : "{secret}"', "password = {secret}", "secret {secret}",
    "key={secret} and", "Authorization : Bearer {secret}",
    # Numbers that are no personal data.
    "version {version} of the", "Version {version}.", "licensed under {version}", "in {year} the and", "on {date} we met",
    "between {year} and {year}", "costs $ {price} each", "{price} EUR", "page {small} of {small}", "{small} of the",
    "chapter {small} . {small}", "order {order} was sent", "about {order} people", "at {time} the and", "{small} , {small} , {small}",
    "{ratio} of all", "see section {version}", "room {small}", "the {year} report", "isbn {isbn}", "of in the {order} and",
    "user @ home and", "follow @{word} for", "@{word}", "{small} | {small} | {order}", "{word}{small} the and",
)


def training_table(rows: int = 500, seed: int = 1) -> list[dict]:
    """Rows (text, spans) of frames with filled slots between invented words."""
    r = random.Random(seed)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("aeiou") + r.choice("bdlmnrst") for _ in range(r.randint(1, 4)))

    def valid_card(n: int) -> str:
        head = number(n - 1)
        return next(head + c for c in "0123456789" if luhn(head + c))

    def groups(digits: str, sign: str) -> str:
        return sign.join(digits[k : k + 4] for k in range(0, len(digits), 4))

    def fill(slot: str) -> str:
        name, host = f"{word()}{r.choice(['', '.', '_'])}{word()}{r.choice(['', number(2)])}", f"{word()}{r.choice(['', number(1)])}"
        area, mid, end = number(3), number(3), number(4)
        return {
            "email": lambda: f"{name}@{host}.{r.choice(['com', 'org', 'example.net', 'co.uk'])}",
            "odd_email": lambda: r.choice([f"{name} @ {host} . com", f"{name}@{host} . org", f"{name} at {host} . com"]),
            "phone": lambda: f"+{r.choice(['1', '44', '49'])} ({area}) {mid}-{end}",
            "odd_phone": lambda: r.choice([f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"({area}) {mid} {end}"]),
            "ip": lambda: ".".join(str(r.randint(1, 255)) for _ in range(4)),
            "odd_ip": lambda: " . ".join(str(r.randint(1, 255)) for _ in range(4)),
            "card": lambda: r.choice([valid_card(16), groups(valid_card(16), " "), groups(valid_card(16), "-"), valid_card(15)]),
            "odd_card": lambda: r.choice([groups(valid_card(16), "."), groups(valid_card(16), " / ")]),
            "secret": lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40, 64]))),
            "version": lambda: r.choice([f"{r.randint(1, 9)}.{r.randint(0, 20)}", f"{r.randint(1, 9)}.0.{r.randint(0, 30)}"]),
            "year": lambda: str(r.randint(1900, 2030)),
            "date": lambda: r.choice([f"{number(2)}.{number(2)}.{number(4)}", f"{number(4)}-{number(2)}-{number(2)}", f"{number(2)}/{number(2)}/{number(2)}"]),
            "price": lambda: r.choice([f"{number(2)}.{number(2)}", f"{number(1)},{number(3)}.{number(2)}"]),
            "small": lambda: str(r.randint(0, 999)),
            "order": lambda: number(r.randint(4, 9)),
            "time": lambda: f"{number(2)}:{number(2)}",
            "ratio": lambda: f"{number(2)}.{number(1)} %",
            "isbn": lambda: f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}",
            "word": word,
        }[slot]()

    out = []
    for k in range(rows):
        text, spans = " ".join(word() for _ in range(r.randint(0, 6))), []
        text += " " if text else ""
        for part in re.split(r"(\{\w+\})", _FRAMES[k % len(_FRAMES)]):
            if part.startswith("{"):
                kind, value = part[1:-1].removeprefix("odd_"), fill(part[1:-1])
                if kind in KINDS:
                    spans.append((kind, len(text), len(text) + len(value)))
                text += value
            else:
                text += part
        out.append({"text": text + "".join(" " + word() for _ in range(r.randint(0, 5))), "spans": spans})
    return out


def train(table: DataFrame | list[dict]) -> crf.Crf:
    """Fit the field on a labelled table: text, spans array<struct<kind, start, end>>.

    Of a DataFrame the first ``TRAINING_ROWS`` rows by text are read.
    """
    if isinstance(table, DataFrame):
        rows = [r.asDict(recursive=True) for r in table.orderBy("text").limit(TRAINING_ROWS).collect()]
        rows = [{"text": r["text"] or "", "spans": [(s["kind"], s["start"], s["end"]) for s in r["spans"] or ()]} for r in rows]
    else:
        rows = table[:TRAINING_ROWS]
    labels = ["O", *KINDS]
    sequences, targets = [], []
    for row in rows:
        tokens, places, spaced = crf.tokenize(row["text"])
        if not tokens:
            continue
        path = [next((labels.index(k) for k, a, b in row["spans"] if a <= x and y <= b), 0) for x, y in places]
        sequences.append(crf.features(tokens, spaced))
        targets.append(path)
    return crf.fit(sequences, targets, labels)


_TRAINED: dict[str, crf.Crf] = {}


def default_model() -> crf.Crf:
    if "table" not in _TRAINED:
        _TRAINED["table"] = train(training_table())
    return _TRAINED["table"]


_SPAN = T.StructType().add("kind", "string").add("start", "integer").add("end", "integer")


def _find(shared, text_col: str, masked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                texts = [t.as_py() or "" for t in part.column(text_col)]
                found = finder.spans(texts)
                names, columns = list(batch.schema.names), [part.column(c) for c in batch.schema.names]
                if masked:
                    values = [mask(t, s) if s else t for t, (_, s) in zip(texts, found, strict=True)]
                    nulls = part.column(text_col).is_null().to_pylist()
                    columns[names.index(text_col)] = pa.array([None if n else v for n, v in zip(nulls, values, strict=True)], pa.string())
                else:
                    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
                    as_rows = lambda spans: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans]
                    columns += [pa.array([as_rows(b) for b, _ in found], kind), pa.array([as_rows(a) for _, a in found], kind)]
                    names += ["base_spans", "spans"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def mask(text: str, spans: Iterable[Span]) -> str:
    """``text`` with each span replaced by its kind; of overlapping spans the first one's kind stands for both."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, text_col: str = "text", *, model: crf.Crf | None = None) -> DataFrame:
    """``docs`` with base_spans and spans, arrays of (kind, start, end); columns of these names are replaced.

    Null and empty texts have none. Rows are judged one by one, so repeated rows and ids make no difference. The model
    (under 1 MB, by its number of slots) is broadcast.
    """
    ship(docs.sparkSession)
    own = docs.select(*[c for c in docs.columns if c.lower() not in ("base_spans", "spans")])
    shared = docs.sparkSession.sparkContext.broadcast(model or default_model())
    added = [T.StructField(c, T.ArrayType(_SPAN)) for c in ("base_spans", "spans")]
    return own.mapInArrow(_find(shared, text_col, False), T.StructType([*own.schema, *added]))


def mask_pii(docs: DataFrame, text_col: str = "text", *, model: crf.Crf | None = None) -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in brackets; all rows stay, null texts stay null."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or default_model())
    return docs.mapInArrow(_find(shared, text_col, True), docs.schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, spans = ([[(s["kind"], s["start"], s["end"]) for s in row] for row in batch.column(c).to_pylist()] for c in ("base_spans", "spans"))
        counts = [pa.array([sum(s[0] == k for s in row) for row in base], pa.int64()) for k in KINDS[:4]]
        shas = [hashlib.sha256(join_spans(row).encode()).hexdigest() for row in base]
        secrets = pa.array([sum(s[0] == "secret" for s in row) for row in spans], pa.int64())
        columns = [batch.column("doc_id"), *counts, pa.array(shas), pa.array([join_spans(row) for row in spans]), secrets]
        names = ["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "spans", "n_secret"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counts = ", ".join(f"n_{k} long" for k in KINDS[:4])
    found = find_pii(docs).select("doc_id", "base_spans", "spans")
    return found.mapInArrow(_digest, f"doc_id long, {counts}, base_sha256 string, spans string, n_secret long")
