"""Personal data in texts (operator 4).

Regular expressions propose spans, validators confirm them, and context words
near a span adjust its score. Base kinds (email, ip, card, phone) count whenever
their pattern and validator hold; context only moves their score. Kinds that the
method adds are reported when the score reaches `THRESHOLD`:

  iban   country code, two check digits, up to 30 letters or digits; mod-97 must be 1
  ssn    ddd-dd-dddd with valid number ranges, only with a context word nearby
  tel    7 to 12 digits in groups without a plus, only with a context word nearby

Every pattern runs in linear time on any text: a start is tried only where a run
of its first character class begins, and emails are found from their @ signs.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import common

KINDS = ("email", "ip", "card", "phone")
EXTRA = ("iban", "ssn", "tel")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]++@")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}(?![0-9A-Za-z-])")

#: Score of a confirmed span, what a context word adds, and the score that is reported.
BASE_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "tel": 0.3}
CONTEXT_BONUS, THRESHOLD = 0.3, 0.6
#: Context words count when they end at most this many code points before a span.
CONTEXT_REACH = 40
CONTEXT = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|credit|payment)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security)\b", re.I),
    "tel": re.compile(r"\b(?:phone|tel|telephone|call|mobile|fax)\b", re.I),
}

Span = tuple[int, int, str, float]  # start, end, kind, score


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the email pattern, found from the @ signs."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            last = domain.end()
        else:
            last = max(last, at)
        at = text.find("@", max(at + 1, last))
    return found


def confirmed(text: str) -> list[tuple[int, int, str]]:
    """Spans whose pattern and validator hold, base kinds first."""
    out = [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    for m in IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            out.append((m.start(), m.end(), "iban"))
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            out.append((m.start(), m.end(), "ssn"))
    for m in TEL.finditer(text):
        out.append((m.start(), m.end(), "tel"))
    return out


def find_spans(text: str) -> list[Span]:
    """Reported spans by start, then kind. Added kinds give way to what base spans cover."""
    spans: list[Span] = []
    covered: list[tuple[int, int]] = []
    for start, end, kind in confirmed(text):
        near = CONTEXT[kind].search(text, max(0, start - CONTEXT_REACH), start)
        score = min(1.0, BASE_SCORE[kind] + CONTEXT_BONUS * bool(near))
        if kind in KINDS:
            covered.append((start, end))
        elif score < THRESHOLD or any(a < end and start < b for a, b in covered):
            continue
        spans.append((start, end, kind, score))
    order = {k: i for i, k in enumerate(KINDS + EXTRA)}
    return sorted(spans, key=lambda s: (s[0], order[s[2]]))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, of the first's kind."""
    out, at = [], 0
    merged: list[list] = []
    for start, end, kind, _ in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k, _ in spans)


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`; other columns are left out), repeated rows too.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 (of
    kind:start:end of base spans, comma-joined), spans (all reported spans,
    joined likewise) and scores (in the order of `spans`). Positions are code
    points, end exclusive. Null text is empty: no spans. Null doc_id stays null.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores")}
        for text in common.strings(batch.column(1)):
            spans = find_spans(text)
            base = [s for s in spans if s[2] in KINDS]
            for k in KINDS:
                out[f"n_{k}"].append(sum(s[2] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(spans))
            out["scores"].append([s[3] for s in spans])
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **out}, pa.schema([
            ("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
            ("base_sha256", pa.string()), ("spans", pa.string()), ("scores", pa.list_(pa.float64()))]))

    return common.python_rows(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), common.text_of().alias("text")), run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, scores array<double>")


def mask(docs: DataFrame) -> DataFrame:
    """`docs` with reported spans in `text` replaced by <KIND>, and `n_chars`, where there is one, made anew.

    All other columns pass through. Null text stays null, texts without spans stay as they are.
    """
    @F.pandas_udf("string")
    def redact(texts):
        import pandas as pd
        return pd.Series([None if t is None else masked(t, find_spans(t)) for t in texts], dtype=object)

    out = docs.withColumn("text", redact("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, base and added spans."""
    return detect(common.table(spark, sf_dir, "documents"))
