"""Personal data by weak supervision (operator 9)."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from importlib.resources import files
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret", "address")
SECRET, ADDRESS = 4, 5


def gazetteer(name: str) -> tuple[str, ...]:
    """The entries of one of the package's lists, a line each."""
    return tuple(files("terraloom.llm").joinpath("gazetteers", f"{name}.txt").read_text(encoding="utf-8").split("\n")[:-1])


#: Words that stand before credentials, and before contact data, in English, German, French and Spanish; words of streets; cities.
SECRET_WORDS, CONTACT_WORDS, STREETS, PLACES = map(gazetteer, ("secret_words", "contact_words", "street_words", "places"))
#: Heads of well-known credential formats, first digits of payment cards, country calling codes of one and two digits, and the
#: zones in which codes have three.
CREDENTIALS = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "npm_", "pypi-", "sk_live_", "rk_live_", "xoxb-", "xoxp-", "eyJ")
ISSUERS = ("2", "3", "4", "5", "6")
CALLING = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
CALLING += tuple("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 80 85 87 88 96 97 99".split())
CONTEXT = 24  # characters before a span that the context labeler reads
SHAPES = 4  # buckets of each shape feature
LABELERS = 4
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match can begin only where a run of digits begins: within a run, what follows is the same
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{12,}+")
_UP, _LOW = "A-ZÀ-ÖØ-Þ", "a-zà-öø-ÿß"
_BEFORE = "|".join(w for w in STREETS if w in ("avenida", "avenue", "boulevard", "calle", "camino", "carretera", "chemin", "impasse", "paseo", "place", "plaza", "quai", "route", "rue"))
_AFTER = "|".join(sorted((f"{w.capitalize()}" for w in STREETS), key=len, reverse=True))
_TAIL = "|".join(w for w in STREETS if w in ("allee", "damm", "gasse", "platz", "ring", "straße", "strasse", "ufer", "weg"))
_STREET = rf"(?i:{_BEFORE})(?: (?:de|del|des|du|la|las|le|les|los|d'|l'))*(?: [{_UP}][{_LOW}'’-]+){{1,3}}"
#: 12 High Street; rue de la Paix 5 and 5, rue de la Paix; Lindenstraße 7
_ADDRESSES = (
    re.compile(rf"(?<![0-9.,])[0-9]{{1,4}}[a-z]?,? (?:[{_UP}][{_LOW}'’-]+ ){{1,3}}(?:{_AFTER})\b"),
    re.compile(rf"(?<![0-9.,])[0-9]{{1,4}}(?: bis| ter)?,? {_STREET}"),
    re.compile(rf"\b{_STREET},? (?:n[.º°]{{1,2}} ?)?[0-9]{{1,4}}(?![0-9])"),
    re.compile(rf"\b[{_UP}][{_LOW}-]*(?:{_TAIL}) [0-9]{{1,4}}[a-z]?(?![0-9A-Za-z])"),
)
_STREET_SIGNS = tuple(w for w in STREETS if w != "st")
_POSTCODE = re.compile("(?<![0-9])[0-9]{4,5}(?![0-9])")
_NOT_DIGIT = re.compile("[^0-9]+")
_DIGITS = re.compile("[0-9]+")
_SPANS = "array<struct<kind:int,start:int,end:int,base:boolean,code:int>>"


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: a match begins where the run of local characters before it does."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            last = m.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def inner_phone(text: str, start: int, end: int) -> tuple[int, int] | None:
    """A number at the head of a match of too many digits: the fewest whole runs of digits that make 10 of them, if at most 15."""
    total = 0
    for m in _DIGITS.finditer(text, start, end):
        total += m.end() - m.start()
        if total >= 10:
            return (start, m.end()) if total <= 15 else None
    return None


def covers(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span overlaps any of ``spans``, by binary search."""
    starts, ends = [a for a, _ in sorted(spans)], list(accumulate((b for _, b in sorted(spans)), max))
    return lambda a, b: bool(i := bisect_left(starts, b)) and ends[i - 1] > a


def inner_cards(text: str, start: int, end: int, taken: Callable[[int, int], bool]) -> Iterator[tuple[int, int]]:
    """Numbers within a failing match: leftmost, longest whole runs of digits that make 14 to 19 and pass Luhn, off the spans ``taken``."""
    runs = [m.span() for m in _DIGITS.finditer(text, start, end) if not taken(*m.span())]
    i = 0
    while i < len(runs):
        digits, j, last = "", i, -1
        while j < len(runs) and len(digits) + runs[j][1] - runs[j][0] <= 19 and (j == i or runs[j][0] == runs[j - 1][1] + 1):
            digits += text[runs[j][0] : runs[j][1]]
            if len(digits) >= 14 and luhn(digits):
                last = j
            j += 1
        if last >= 0:
            yield runs[i][0], runs[last][1]
        i = max(i, last) + 1


def raw_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, passes) of the base patterns, failing matches too, and of credential-like words."""
    found = [(0, a, b, True) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        found.append((1, *m.span(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts)))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if m.end() - m.start() >= 12 else ""
        if len(digits) >= 12:
            found.append((2, *m.span(), 14 <= len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for m in _PHONE.finditer(text):
            found.append((3, *m.span(), 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15))
    for m in _SECRET.finditer(text):
        found.append((SECRET, *m.span(), False))
    if _DIGITS.search(text) and (any(w in (low := text.lower()) for w in _STREET_SIGNS) or " St" in text):
        spans = sorted((m.span() for p in _ADDRESSES for m in p.finditer(text) if any(c.isdigit() for c in m[0])), key=lambda x: (x[0], -x[1]))
        last = 0
        for a, b in spans:
            if a >= last:
                found.append((ADDRESS, a, b, False))
                last = b
    return found


def inner_matches(text: str, found: list[tuple[int, int, int, bool]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of phone and card numbers inside failing matches, where the base rule tries no second time."""
    phones = [x for k, a, b, ok in found if k == 3 and not ok and (x := inner_phone(text, a, b))]
    taken = covers(phones)
    cards = [x for k, a, b, ok in found if k == 2 and not ok for x in inner_cards(text, a, b, taken)]
    return [(3, *x) for x in phones] + [(2, *x) for x in cards]


def votes(text: str, kind: int, start: int, end: int, passes: bool) -> tuple[int, ...]:
    """Labelers' votes: 0 against, 1 for, 2 abstains. The gazetteers are words before the span, heads of credential formats,
    card issuers and calling codes; the context labeler reads what stands at either end."""
    span, before = text[start:end], text[max(0, start - CONTEXT) : start].lower()
    if kind == ADDRESS:
        after = text[end : end + 2 * CONTEXT]
        named = [w for w in span.split() if w[:1].isupper()]
        listed = any(p in after for p in PLACES)
        cued = any(w in before for w in CONTACT_WORDS) or _POSTCODE.search(after) is not None
        return int(bool(named)), 1 if listed else 2, int(cued or listed), int(2 <= len(span.split()) <= 8)
    words = SECRET_WORDS if kind == 4 else CONTACT_WORDS
    pattern = int(passes) if kind < 4 else int(re.fullmatch("[0-9a-f]{16,64}|[A-Za-z0-9_/+-]{20,}", span) is not None)
    listed = span.startswith(ISSUERS) if kind == 2 else span[1:].startswith(CALLING) if kind == 3 else kind == 4 and span.startswith(CREDENTIALS)
    gazetteer = 1 if listed or any(w in before for w in words) else 0 if kind in (2, 4) else 2
    joint = kind < 4 and (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum())
    assigned = before.rstrip().endswith(("=", ":", '="', "='", ':"', '= "', "= '", ': "', '"'))
    # for a credential of a known format neither a missing assignment nor its shape says anything
    unsaid = 0 if kind == 4 and not listed else 2
    context = 0 if joint else 1 if assigned else unsaid
    digits = sum(c.isdigit() for c in span) / len(span)
    spread = len(set(span)) / min(len(span), 16)
    shape = (1 if spread >= 0.5 and digits >= 0.2 else unsaid) if kind == 4 else 1 if spread >= 0.25 else 0
    return pattern, gazetteer, context, shape


def code_of(text: str, kind: int, start: int, end: int, passes: bool) -> int:
    """Votes and shape of a candidate in one bounded number."""
    vote = votes(text, kind, start, end, passes)
    span = text[start:end]
    length = min(SHAPES - 1, (end - start) // 10)
    digits = min(SHAPES - 1, int(SHAPES * sum(c.isdigit() for c in span) / len(span)))
    code = kind
    for v in vote:
        code = code * 3 + v
    return (code * SHAPES + length) * SHAPES + digits


def unpack(code: int) -> tuple[int, list[int], int, int]:
    code, digits = divmod(code, SHAPES)
    code, length = divmod(code, SHAPES)
    vote = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        vote.insert(0, v)
    return code, vote, length, digits


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Candidate spans of every whole text with their codes, ordered by start and kind; one row for each input row, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found = raw_matches(text) if text else []
                covered = covers([(a, b) for k, a, b, ok in found if ok])
                spans = []
                for k, a, b, ok in sorted(found, key=lambda x: (x[1], x[0])):
                    if ok or not covered(a, b):  # what a base span covers is no other candidate
                        spans.append({"kind": k, "start": a, "end": b, "base": ok, "code": code_of(text, k, a, b, ok)})
                for k, a, b in inner_matches(text, found):
                    if not covered(a, b):
                        spans.append({"kind": k, "start": a, "end": b, "base": False, "code": code_of(text, k, a, b, True)})
                spans.sort(key=lambda x: (x["start"], x["kind"]))
                rows.append(spans)
            kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("code", pa.int32())]))
            yield pa.record_batch({id_col: batch.column(0), "spans": pa.array(rows, kind)})

    one = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return one.mapInArrow(run, f"`{id_col}` {one.schema[0].dataType.simpleString()}, spans {_SPANS}")


def reliabilities(vote: np.ndarray, count: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: probability that each pattern is personal data, and the labelers' rates
    of voting for (1), against (0) under either truth. Abstentions say nothing."""
    said = vote != 2
    post = np.where(said, vote, 0).sum(1) / np.maximum(1, said.sum(1))  # the start: the majority
    rate = np.zeros((2, vote.shape[1]))
    for _ in range(rounds):
        prior = np.clip((post * count).sum() / max(1, count.sum()), 0.01, 0.99)
        like = np.log(np.array([1 - prior, prior]))[:, None] + np.zeros((2, len(vote)))
        for truth, p in enumerate((1 - post, post)):
            weight = p * count
            for j in range(vote.shape[1]):
                total = (weight * said[:, j]).sum()
                rate[truth, j] = np.clip(((weight * (vote[:, j] == 1)).sum() + 1) / (total + 2), 0.01, 0.99)
                like[truth] += np.where(said[:, j], np.log(np.where(vote[:, j] == 1, rate[truth, j], 1 - rate[truth, j])), 0)
        post = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
    return post, rate


def span_features(kind: int, vote: list[int], length: int, digits: int) -> np.ndarray:
    x = np.zeros(1 + 2 * LABELERS + 2 * SHAPES)
    x[0] = 1
    for j, v in enumerate(vote):
        x[1 + 2 * j], x[2 + 2 * j] = v == 1, v == 0
    x[1 + 2 * LABELERS + length] = 1
    x[1 + 2 * LABELERS + SHAPES + digits] = 1
    return x


def train_classifier(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50, decay: float = 1e-2) -> np.ndarray:
    """Logistic regression on soft labels by damped Newton steps."""
    w, weight = np.zeros(x.shape[1]), weight / max(1.0, weight.sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-4 * decay * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(hess, grad), -5, 5)
    return w


def accepted_codes(candidates: DataFrame, threshold: float = 0.9) -> list[int]:
    """Codes of candidates that the trained span classifiers, for credentials, street addresses and contact data, take for personal data.

    Every candidate is counted; what reaches the driver is a row a code, and the codes are at most 6 * 3^4 * 4 * 4.
    """
    seen = candidates.select(F.explode("spans").alias("s")).groupBy("s.code").count().collect()
    seen = sorted((int(r["code"]), int(r["count"])) for r in seen)
    good = []
    for own in ((SECRET,), (ADDRESS,), (0, 1, 2, 3)):  # they have labelers of their own
        mine = [(c, n, unpack(c)) for c, n in seen if unpack(c)[0] in own]
        if not mine:
            continue
        count = np.array([n for _, n, _ in mine], float)
        post, _ = reliabilities(np.array([p[1] for _, _, p in mine]), count)
        x = np.array([span_features(*p) for _, _, p in mine])
        score = 1 / (1 + np.exp(-np.clip(x @ train_classifier(x, post, count), -30, 30)))
        for (code, _, (_, vote, _, _)), p in zip(mine, score, strict=True):
            # a credential must be named as one or assigned, as shape alone marks clean words too, and an address have a place, a postcode or
            # a word of contact beside it; contact data must pass the check of its kind
            if p >= threshold and (vote[0] == 1 if own[0] == 0 else vote[1] == 1 or vote[2] == 1):
                good.append(code)
    return good


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in every whole text: ``(doc_id, spans array<struct<kind, start, end, base>>)``, a row for each input row.

    Base patterns (e-mail, IP, card, phone) always stand. Credentials, street addresses (English, French, Spanish and German forms), and phone and card numbers inside failing base matches (a phone
    number that a card number follows), are added where the classifier, trained on labels that expectation-maximisation draws
    from the votes of pattern, gazetteer, context and shape labelers, takes them. Offsets are code points.
    Null or empty texts have no spans. Ids may be null or repeat; other columns are ignored; an empty table gives no rows.
    ``path``: where the scanned candidates are written, in a folder that all executors share.
    """
    found = scan(docs, id_col, text_col)
    found.write.parquet(path)
    found = docs.sparkSession.read.schema(found.schema).parquet(path)
    good = accepted_codes(found)
    taken = F.filter("spans", lambda s: s["base"] | s["code"].isin(good) if good else s["base"])
    return found.select(id_col, taken.alias("spans"))
