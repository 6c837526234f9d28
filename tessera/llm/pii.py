"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Base kinds are those of the contract: email, ip, card (Luhn) and phone. The method adds IBANs confirmed by mod 97, and card
numbers written with other separators that pass Luhn and stand near a word that names them.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "card_near")

# The patterns match what the contract's do. Possessive repeats and look-behinds keep them linear on long runs: a match that
# starts inside a run of digits can only be the tail of one that starts at its head.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_CARD_NEAR = re.compile(r"(?<![0-9.])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])")
#: Words (lower case) that raise or lower the score of a kind within CONTEXT characters before a span.
CONTEXT = 40
NEAR = {
    "email": ({"email", "mail", "contact", "e-mail"}, {"example"}),
    "ip": ({"ip", "host", "server", "address"}, {"version", "release", "section"}),
    "card": ({"card", "visa", "mastercard", "credit", "payment"}, {"isbn", "order", "id"}),
    "phone": ({"phone", "tel", "call", "mobile", "fax"}, {"version", "id"}),
    "iban": ({"iban", "account", "bank", "konto", "compte", "cuenta"}, set()),
    "card_near": ({"card", "visa", "mastercard", "credit", "payment"}, {"isbn", "order", "id"}),
}
#: Scores: a pattern alone, one with a checksum, and what a word nearby adds or takes. Kinds of the method itself need LEAST.
PLAIN, CHECKED, STEP, LEAST = 0.5, 0.8, 0.15, 0.8
_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The checksum of IBANs."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str):
    """Leftmost matches that don't overlap: the run of local characters before each @ with a domain, after the last match."""
    end = 0
    for m in _DOMAIN.finditer(text):
        k = m.start()
        while k > end and text[k - 1] in _LOCAL_CHARS:
            k -= 1
        if k < m.start():
            yield k, m.end()
            end = m.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """start, end, kind of the base spans, by start, then kind as listed."""
    out = []
    if "@" in text:
        out += [(s, e, "email") for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda x: (x[0], BASE_KINDS.index(x[2])))


def score(text: str, start: int, end: int, kind: str, checked: bool) -> float:
    """PLAIN or CHECKED, adjusted by the words before the span."""
    near = {w.lower() for w in _WORD.findall(text[max(0, start - CONTEXT) : start])}
    up, down = NEAR[kind]
    return round((CHECKED if checked else PLAIN) + STEP * bool(near & up) - STEP * bool(near & down), 2)


def iban_end(text: str, m: re.Match) -> int | None:
    """The end of the longest part of a match that is an IBAN, ending where a group or the match ends."""
    for end in [m.end(), *(m.start() + k for k in range(len(m[0]) - 1, 14, -1) if m[0][k] == " ")]:
        number = text[m.start() : end].replace(" ", "")
        if 15 <= len(number) <= 34 and mod97(number):
            return end
    return None


def find(text: str) -> list[tuple[int, int, str, float]]:
    """All spans as start, end, kind, score: the base ones, and those of the method that score LEAST and overlap none."""
    base = base_spans(text)
    out = [(s, e, k, score(text, s, e, k, k == "card")) for s, e, k in base]
    more = [(m.start(), e, "iban") for m in _IBAN.finditer(text) if (e := iban_end(text, m))]
    more += [(*m.span(), "card_near") for m in _CARD_NEAR.finditer(text) if luhn(re.sub("[^0-9]", "", m[0]))]
    for s, e, k in more:
        rate = score(text, s, e, k, True)
        if rate >= (LEAST if k == "iban" else round(CHECKED + STEP, 2)) and not any(s < y and x < e for x, y, *_ in out):
            out.append((s, e, k, rate))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def pii(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, found (array of kind, start, end, score; code points, end exclusive), by start.

    Null texts count as empty and have no spans. Repeated rows each get theirs. No rows give no rows."""
    prepare(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            rows = [[{"kind": k, "start": s, "end": e, "score": x} for s, e, k, x in find(t or "")] for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(rows, kind)], names=["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, found array<struct<kind:string,start:long,end:long,score:double>>")


def masked(text: str, least: float = 0.0) -> str:
    """The text with each span of at least that score replaced by its kind in brackets."""
    out, at = [], 0
    for s, e, k, x in find(text):
        if x >= least and s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
            at = e
    return "".join([*out, text[at:]])


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from found spans."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("found", lambda x: x["kind"].isin(*BASE_KINDS))
    kinds = F.transform("found", lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, lambda x: x == kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]  # noqa: B023 (run at once)
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))

