"""Personal data: base spans, and further spans chosen by boosted trees.

Base spans follow fixed patterns and always stay. High-recall generators propose further, possibly
overlapping spans: addresses with the "at" or the dots written out, numbers in groups with unusual
separators, phones without country code, IPv6. Trees judge them by format and context; of those above
the kind's calibrated threshold the likeliest non-overlapping ones are added.

The tables hold no labels for this, so the examples come from the corpus: base spans in their places,
the same rewritten the way people write them around filters (positive), and candidates that are none,
numbers broken or turned into dates, amounts and versions (negative), from at most ``SAMPLE_DOCS``
documents and ``MAX_EXAMPLES`` examples. Everything else runs over every whole text, in time with its length. Repeated rows
have the same spans each.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from novalake.llm.boosting import Boosted, fit
from novalake.llm.common import slices, texts_of

SAMPLE_DOCS = 8_000
MAX_EXAMPLES = 24_000
PRECISION = 0.97
KINDS = ("email", "ip", "card", "phone")
AROUND = 32
JUDGED_AT_ONCE = 8_192

# The patterns of base spans.
EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# What the generators look for.
AT = re.compile(r"[@＠]|[ ]?[\[({<][ ]?at[ ]?[\])}>][ ]?|[ ]at[ ]", re.I)
LOCAL_LIKE = re.compile(r"[\w.%+'-]{1,64}[ ]?\Z")
HOST_LIKE = re.compile(
    r"[ ]?[\w-]+(?:[ ]?(?:[.．]|[\[({<][ ]?(?:dot|\.)[ ]?[\])}>]|[ ]dot[ ])[ ]?[\w-]+)+", re.I)
UNBROKEN = re.compile(r"(?<![0-9])[0-9]{12,19}(?![0-9])")
NUMBER_LIKE = {
    "ip": re.compile(r"(?<![\w.:])[0-9]{1,3}(?:[ ]?[\[({]?(?:\.|dot|,)[\])}]?[ ]?[0-9]{1,3}){3}(?![\w:])"
                     r"|(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}(?![\w:])", re.I),
    "card": re.compile(r"(?<![\w.])[0-9](?:[\x20 ._/-]{0,3}[0-9]){11,18}(?![\w])"),
    "phone": re.compile(r"(?<![\w.+])(?:\+[\x20(]?|00|\()?[0-9]{1,4}\)?(?:[\x20 ./()-]{1,3}[0-9]{2,5}){1,5}(?!\w)"),
}
HINTS = {
    "email": ("mail", "e-mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse", "login", "from"),
    "card": ("card", "visa", "master", "amex", "credit", "karte", "carte", "tarjeta", "pay"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "handy", "móvil", "fon"),
}
NOT_HINTS = ("version", "page", "vol", "isbn", "date", "section", "$", "€", "%", "order", "license", "no.")


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _octet(part: str) -> bool:
    kept = part.lstrip("0")
    return len(kept) <= 3 and int(kept or "0") <= 255


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, by start, then kind in the listed order."""
    found = []
    at, ended = text.find("@"), 0
    while at >= 0:
        host = EMAIL_HOST.match(text, at)
        if host:
            # the longest run of permitted characters that ends at the @
            low = max(ended, at - 64)
            start = low + len(text[low:at].rstrip(EMAIL_LOCAL))
            while start == low > ended:
                low = max(ended, at - 4 * (at - low))
                start = low + len(text[low:at].rstrip(EMAIL_LOCAL))
            if start < at:
                ended = host.end()
                found.append((start, "email", ended))
                at = ended - 1
        at = text.find("@", at + 1)
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                if all(map(_octet, m[0].split("."))):
                    found.append((m.start(), "ip", m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), "phone", m.end()))
    found.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return found


def proposals(text: str) -> list[tuple[int, str, int]]:
    """Spans that might be personal data, overlapping ones too."""
    found = []
    for m in AT.finditer(text):
        host = HOST_LIKE.match(text, m.end())
        local = host and LOCAL_LIKE.search(text[max(0, m.start() - 65) : m.start()])
        if local:
            found.append((m.start() - len(local[0]), "email", host.end()))
    if DIGIT.search(text) or text.count(":") > 2:
        for kind, pattern in NUMBER_LIKE.items():
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
        found += [(m.start(), "card", m.end()) for m in UNBROKEN.finditer(text)]
    return found


def features(text: str, start: int, kind: str, end: int) -> list[float]:
    body = text[start:end]
    before, after = text[max(0, start - AROUND) : start].lower(), text[end : end + AROUND].lower()
    digits = [c for c in body if c.isdigit() and c.isascii()]
    groups = re.findall(r"[0-9]+", body)
    words = re.findall(r"[^\W\d_]+", body)
    plain = "".join(digits)
    left, right = before[-1:], after[:1]
    return [
        float(KINDS.index(kind)), len(body), len(digits), len(digits) / len(body),
        len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(set(digits)), float(12 <= len(digits) <= 19 and luhn(plain)),
        float(9 <= len(digits) <= 15), float(len(groups) == 4 and all(map(_octet, groups))),
        float(body[:1] == "+"), float("(" in body and len(digits) > 5), body.count("."),
        body.count("-"), body.count(" "), body.count(":"), body.count("/"), body.count(","),
        float("@" in body or "＠" in body), float(bool(re.search(r"[\[({<] ?(at|dot)", body, re.I))),
        float(bool(re.search(r" dot ", body, re.I))), float(len(words)),
        max(map(len, words), default=0), float(words[-1].islower() and 2 <= len(words[-1]) <= 6) if words else -1.0,
        float(len(groups) == 3 and len(groups[0]) in (2, 4) and max(map(len, groups)) <= 4 and len(digits) <= 8),
        float(any(h in before or h in after[:12] for h in HINTS[kind])),
        float(any(h in before for h in NOT_HINTS)),
        float(left.isalnum()), float(right.isalnum()), float(left in "$€£#=\"'" and left != ""),
    ]


def _rewritten(body: str, kind: str, draw: random.Random) -> str | None:
    """The same item as people write it around filters."""
    if kind == "email":
        local, _, host = body.partition("@")
        if draw.random() < 0.7:  # not all addresses have digits, or as many labels
            local = draw.choice([local.rstrip("0123456789."), local[:6].strip(".") + "_" + local[:3], local[:4]]) or local
            host = host[-draw.randrange(6, 14):].lstrip("-.").partition(".")[2] or host
            host = draw.choice([host, local[:5].strip("._") + "." + draw.choice(["org", "com", "net", "de", "fr"])])
        at = draw.choice([" at ", " [at] ", "(at)", "[at]", "＠"])
        if at == "＠":
            return f"{local}{at}{host}"
        return f"{local}{at}{host.replace('.', draw.choice([' dot ', '[dot]', '(dot)', '.']))}"
    if kind == "ip":
        parts = [p if draw.random() < 0.5 else str(draw.randrange(256)) for p in body.split(".")]
        return draw.choice(["[.]", "(.)", " . ", "[dot]"]).join(parts)
    digits = NOT_DIGIT.sub("", body)
    if kind == "card":
        return draw.choice([".", "/", "  ", " - ", "_", " "]).join(
            digits[i : i + 4] for i in range(0, len(digits), 4))
    mark = draw.choice(["-", ".", " ", "/", " - "])
    form = draw.choice(["({0}) {1}{m}{2}", "{0}{m}{1}{m}{2}", "00{3}{m}{0}{m}{1}{m}{2}", "({0}){1}{m}{2}"])
    return form.format(digits[-10:-7] or "212", digits[-7:-4], digits[-4:], digits[:-10] or "1", m=mark)


def _broken(body: str, kind: str, draw: random.Random) -> str:
    """Something that looks like the item but is none."""
    if kind == "email":
        return draw.choice(["look at it. then", "at the end. of", "meet @ noon. then", "was at home. so"])
    n = draw.randrange
    if kind == "ip":
        return draw.choice([f"{n(300, 999)}.{n(300, 999)}.{n(99)}.{n(999)}", f"{n(9)}, {n(99)}, {n(99)}, {n(99)}",
                            f"{n(12)}:{n(10, 60)}:{n(10, 60)}:{n(10, 60)}"])
    if kind == "card":
        digits = NOT_DIGIT.sub("", body)
        wrong = digits[:-1] + str((int(digits[-1]) + n(1, 9)) % 10)
        return draw.choice([wrong, " ".join(str(n(10, 9999)) for _ in range(5)), f"{n(10**6)}.{n(10**8)}",
                            ".".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))])
    return draw.choice([f"{n(1900, 2030)}-{n(10, 13)}-{n(10, 29)}", f"{n(10, 29)}.{n(10, 13)}.{n(1900, 2030)}",
                        f"{n(10, 99)} {n(100, 999)}", f"{n(1000, 2000)}-{n(1000, 2030)}", f"{n(1, 99)}/{n(10, 99)}",
                        f"{n(1, 99)}.{n(100, 999)}.{n(100, 999)}", f"{n(10, 24)}-{n(10, 60)}-{n(10, 60)}"])


class Covered:
    """Which characters of a text lie in spans, a byte for each: asking for a span, or adding one, takes time with its length,
    however many others there are."""

    def __init__(self, length: int, spans: list[tuple[int, str, int]] = ()):
        self.flags = bytearray(length)
        for start, _, end in spans:
            self.add(start, end)

    def add(self, start: int, end: int) -> None:
        self.flags[start:end] = b"\1" * (end - start)

    def meets(self, start: int, end: int) -> bool:
        return self.flags.find(1, start, end) >= 0


def examples(text: str) -> Iterator[tuple[int, list[float]]]:
    """Labelled candidates of one text (kinds are feature 0)."""
    base = base_spans(text)
    for start, kind, end in base:
        draw = random.Random(text[start:end])
        yield 1, features(text, start, kind, end)
        for label, body in ((1, _rewritten(text[start:end], kind, draw)), (0, _broken(text[start:end], kind, draw))):
            changed = text[max(0, start - AROUND) : start] + body + text[end : end + AROUND]
            at = min(start, AROUND)
            for s, k, e in proposals(changed):
                if s < at + len(body) and at < e and k == kind:
                    yield label, features(changed, s, k, e)
    covered = Covered(len(text), base)
    for start, kind, end in proposals(text):
        if not covered.meets(start, end):
            yield 0, features(text, start, kind, end)


@dataclass
class Detector:
    """Trees and the least probability for each kind; without trees, base spans only."""

    trees: Boosted | None
    least: tuple[float, ...] = (2.0,) * len(KINDS)

    def spans(self, text: str) -> list[tuple[int, str, int]]:
        base = base_spans(text)
        if self.trees is None:
            return base
        covered = Covered(len(text), base)
        free = [s for s in proposals(text) if not covered.meets(s[0], s[2])]
        if not free:
            return base
        likely = np.concatenate([
            self.trees.probability(np.array([features(text, *s) for s in free[n : n + JUDGED_AT_ONCE]]))
            for n in range(0, len(free), JUDGED_AT_ONCE)])
        taken = list(base)
        for n in np.argsort(-likely, kind="stable").tolist():
            start, kind, end = free[n]
            if likely[n] >= self.least[KINDS.index(kind)] and not covered.meets(start, end):
                covered.add(start, end)
                taken.append(free[n])
        taken.sort(key=lambda s: (s[0], KINDS.index(s[1])))
        return taken


def train(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS,
          max_examples: int = MAX_EXAMPLES) -> Detector:
    """Fits trees, calibration and thresholds to a sample drawn by the hash of the text, each text once. Of more than
    ``max_examples`` the first ones of each kind and label in each text come first, then the second ones, and so on. With fewer
    than 40 examples, or of one label only, the detector has no trees."""
    rows = docs.count()
    rate = min(1.0, sample_docs / max(1, rows))
    chosen = docs.select(F.col(text).alias("body"), F.xxhash64(text).alias("digest")).filter(
        F.pmod("digest", F.lit(1 << 30)) < F.lit(int(rate * (1 << 30))))

    def draw(batches):
        seen = set()  # of a sample, so small; copies in other tasks are dropped below
        for batch in slices(batches, "body"):
            made = []
            for body, digest in zip(texts_of(batch, "body"), batch.column("digest").to_pylist()):
                if digest in seen:
                    continue
                seen.add(digest)
                nth = Counter()
                for label, x in examples(body):
                    nth[x[0], label] += 1
                    made.append((digest, nth[x[0], label], label, x))
            yield pa.RecordBatch.from_arrays([
                pa.array(column, kind) for column, kind in zip(
                    zip(*made) if made else [()] * 4,
                    (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64())))], ["digest", "nth", "label", "x"])

    drawn = chosen.mapInArrow(draw, "digest bigint, nth int, label int, x array<double>")
    drawn = drawn.dropDuplicates(["digest", "nth", "label", "x"])
    got = drawn.orderBy("nth", "digest", "label", "x").limit(max_examples).toArrow()
    y = got["label"].to_numpy()
    if len(y) < 40 or y.min() == y.max():
        return Detector(None)
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    order = np.lexsort((*x.T[::-1], y))  # the same examples in any order give the same trees
    order = order[np.random.default_rng(5).permutation(len(order))]
    x, y = x[order], y[order]
    trees = fit(x, y)
    held = np.arange(len(y)) % 4 == 3
    likely, least = trees.probability(x[held]), []
    for kind in range(len(KINDS)):
        mine = x[held][:, 0] == kind
        least.append(_threshold(likely[mine], y[held][mine]))
    return Detector(trees, tuple(least))


def _threshold(likely: np.ndarray, y: np.ndarray) -> float:
    """The least probability, 0.5 at least, above which the wanted precision is kept."""
    if not y.sum():
        return 2.0
    order = np.argsort(-likely, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(right >= PRECISION)
    return max(0.5, float(likely[order][good[-1]])) if len(good) else 2.0


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
SPANS_DDL = "array<struct<start:bigint, kind:string, end:bigint>>"


def find(docs: DataFrame, detector: Detector, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: all spans in code points. Null and empty texts have none."""
    def run(batches):
        for batch in slices(batches, "body"):
            bodies = texts_of(batch, "body")
            columns = [[[dict(zip(("start", "kind", "end"), s)) for s in f(b)] for b in bodies]
                       for f in (base_spans, detector.spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *(pa.array(c, SPANS) for c in columns)], ["doc_id", "base", "spans"])

    slim = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("body"))
    return slim.mapInArrow(run, f"doc_id bigint, base {SPANS_DDL}, spans {SPANS_DDL}")


def mask(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each stretch of spans replaced by the kind of its first one."""
    parts, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, detector: Detector, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns, with spans masked and ``length`` (if there) the new number of code points.
    A null text stays null."""
    schema = docs.schema

    def run(batches):
        for batch in slices(batches, text):
            bodies = batch.column(text).to_pylist()
            masked = [b if b is None else mask(b, detector.spans(b)) for b in bodies]
            at = batch.schema.get_field_index(text)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(masked, batch.schema.field(at).type))
            at = batch.schema.get_field_index(length)
            if at >= 0:
                old = batch.column(at).to_pylist()
                new = [o if b == m else len(m) for o, b, m in zip(old, bodies, masked)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, schema)
