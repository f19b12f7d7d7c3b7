"""Personal data by boosted trees over candidate spans (operator 2).

Plain patterns give the base spans, which always stand. High-recall generators
propose further, overlapping spans (every sub-run of whole digit groups of a
number run, addresses written out, account numbers). Gradient-boosted trees judge each candidate by its
format and its context, a threshold per kind, calibrated on held-out
candidates, decides, and of overlapping candidates the most probable stays.

Training data come from the texts themselves. Candidates that the base
patterns confirm are positive, and so are rewritten forms of them in the same
context (no country code, other separators, addresses written out), since the
forms the base patterns cannot see are what the trees are for. Account numbers
are confirmed by the IBAN check, and generated ones that pass it are put into
the contexts of confirmed spans and of account candidates. Candidates that
nothing confirms are negative, and so are the digits of confirmed ones written
as year ranges, dates and counts, account numbers that fail the check, and
parts of numbers and runs over two of them. At most about ``MAX_TEXTS`` texts, chosen by
hash, and ``MAX_CANDIDATES`` candidates train the trees on the driver; every
text is then searched whole. No shuffle but the bounded training sample.

Defined cases: null and empty texts have no spans; without positive or
negative candidates only base spans are found; repeated rows and null ids get
a result row each; an empty table gives an empty one; other columns are kept
by ``redact`` and not read by ``scan``.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .spans import Span, span_table

BASE_KINDS = ("email", "ip", "card", "phone")
# spans the trees add have kinds of their own
ADDED_KINDS = ("written_email", "other_phone", "other_card", "account")
KINDS = (*BASE_KINDS, *ADDED_KINDS)
_ADDED = {"email": "written_email", "phone": "other_phone", "card": "other_card"}

MAX_TEXTS = 20_000
MAX_CANDIDATES = 40_000
SCORED = 10_000  # candidates of one text that are scored at a time
PRECISION = 0.95  # calibrated probability from which a candidate is added

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that fails at the start of a run of digits fails at all its digits.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[re.Match]:
    """The matches of ``_EMAIL`` from left to right. Each starts at the run of
    local-part characters before an '@', or where the last match ended in it,
    so that a long run without an '@' is not tried at every character."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            yield m
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its test."""
    found: list[Span] = []
    if "@" in text:
        found += (("email", *m.span()) for m in _emails(text))
    if _DIGIT.search(text):
        found += (("ip", *m.span()) for m in _IP.finditer(text)
                  if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m.groups()))
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            found += (("phone", *m.span()) for m in _PHONE.finditer(text)
                      if 8 <= len(_digits(m[0])) <= 15)
    return found


# -- candidates -------------------------------------------------------------------

_AT = re.compile(r"(?i:@|\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20)")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?i:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)"
                     r"[A-Za-z0-9-]{1,63})+")
_NUMBER = re.compile(r"[+(]{0,2}[0-9]+(?:[\x20().\-/]{1,2}[0-9]+)*")
_GROUP = re.compile(r"([+(]{0,2})[0-9]+")
_ACCOUNT = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")

# Words that speak for or against a number nearby.
CUES = {
    "call": ("phone", "tel", "call", "mobile", "fax", "whatsapp", "number"),
    "mail": ("mail", "contact", "write", "address"),
    "card": ("card", "visa", "mastercard", "credit", "debit"),
    "account": ("iban", "account", "bank", "ssn", "passport"),
    "other": ("order", "ref", "id", "version", "isbn", "issue", "page", "token", "sha", "http", "www"),
}
CONTEXT = 24
_RUN_BEFORE = re.compile(r"[0-9][\x20().\-/]{0,2}\Z")  # the number run goes on outside the span
_TOP_LEVEL = re.compile(r"[^A-Za-z](?:[a-z]{2,}|[A-Z]{2,})\Z")
_RUN_AFTER = re.compile(r"[\x20().\-/]{0,2}[0-9]")


def _sub_runs(text: str) -> Iterator[tuple[int, int, int]]:
    """(digits, start, end) of whole digit groups in a row with 7 to 19 digits."""
    for m in _NUMBER.finditer(text):
        groups = [(g.start(), g.end(1), g.end()) for g in _GROUP.finditer(text, *m.span())]
        for i, (a, _, _) in enumerate(groups):
            n = 0
            for _, first, b in groups[i:i + 19]:
                n += b - first
                if n > 19:
                    break
                if n >= 7:
                    yield n, a, b


def candidates(text: str) -> list[Span]:
    """Overlapping spans that may be personal data, whatever their kind."""
    found: set[Span] = set()
    for at in _AT.finditer(text):
        local = _LOCAL.search(text[max(0, at.start() - 64):at.start()])
        domain = _DOMAIN.match(text, at.end())
        if local and domain:
            found.add(("written_email", at.start() - len(local[0]), domain.end()))
    if _DIGIT.search(text):
        for n, a, b in _sub_runs(text):
            if n <= 15:
                found.add(("other_phone", a, b))
            if n >= 13:
                found.add(("other_card", a, b))
        for m in _ACCOUNT.finditer(text):  # a capitalised word after the number looks like its end
            found.update(("account", m.start(), m.start() + e.start())
                         for e in re.finditer(r"\x20|$", m[0]) if len(m[0][:e.start()].replace(" ", "")) >= 12)
    return sorted(found, key=lambda s: (s[1], s[2], s[0]))


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return len(s) >= 15 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def features(kind: str, span: str, before: str, after: str) -> list[float]:
    """Format of the span and its context."""
    digits = _digits(span)
    groups = [len(g) for g in re.findall("[0-9]+", span)] or [0]
    prev, nxt = before[-1:], after[:1]
    words = before.lower()
    return [
        float(ADDED_KINDS.index(kind)), len(span), len(digits), len(groups), max(groups), min(groups),
        groups[-1], span.count(" "), span.count("-"), span.count("."), span.count("/"),
        span.count("("), float("@" in span), float(sum(c.isalpha() for c in span)),
        float(len(digits) >= 12 and luhn(digits)), float(kind == "account" and _iban(span)),
        len(set(digits)), float(prev.isalnum()), float(prev in "\"'=:#_-./"), float(nxt.isalnum()),
        float(nxt in "\"'=:#_-/"), float(bool(_RUN_BEFORE.search(before))), float(bool(_RUN_AFTER.match(after))),
        float(kind == "written_email" and bool(_TOP_LEVEL.search(span))),
        float(groups[-3:] == [3, 3, 4]), float(len(groups) > 3 and set(groups) == {4} and luhn(digits)),
        *[float(any(c in words for c in cue)) for cue in CUES.values()]]


def _context(text: str, a: int, b: int) -> tuple[str, str]:
    return text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]


def _rewritten(kind: str, span: str) -> list[str]:
    """Other ways in which people write a confirmed span."""
    if kind == "email":
        at = span.replace("@", " at ")
        return [at.replace(".", " dot "), span.replace("@", "(at)").replace(".", "(dot)"), at]
    if kind == "phone":
        local = re.sub(r"^\+[0-9]{1,3}[\x20.-]?", "", span)
        plain = re.sub(r"[()]", "", local)
        return [local, re.sub(r"[\x20.]+", "-", plain), re.sub(r"[\x20-]+", ".", plain)]
    if kind == "card":
        d = _digits(span)
        return [" ".join(d[i:i + 4] for i in range(0, len(d), 4)),
                "-".join(d[i:i + 4] for i in range(0, len(d), 4)),
                ".".join(d[i:i + 4] for i in range(0, len(d), 4))]
    return []


def _innocent(span: str) -> list[tuple[str, str]]:
    """(kind, form) of the span's digits as numbers that are not personal:
    year ranges, dates, counts, and a card number that fails its test; of an
    address, its first word before a time, a version and a new sentence."""
    if "@" in span:
        word, place = (re.split("[^A-Za-z0-9]+", x.strip("._%+-"))[0] for x in span.split("@"))
        n = len(span)
        return [("written_email", f"{word} at {x}") for x in (
            f"{n % 24}.{n * 7 % 60:02d}", f"v{n % 7}.{n % 10}.{n % 3}", f"{place}.{word.capitalize()}", f"{n}.{n % 10}")]
    d = _digits(span)
    if len(d) < 8:
        return []
    out = [("other_phone", f) for f in (f"{d[:4]}-{d[4:8]}", f"{d[:4]}-{d[4:6]}-{d[6:8]}", f"{d[:4]}/{d[4:8]}",
                                        f"{d[:2]}.{d[2:4]}.{d[4:8]}", d[:7], d[:8], d[:12], f"{d[:3]}.{d[3:9]}")]
    if len(d) >= 16:
        wrong = d[:15] + str((int(d[15]) + 1 + luhn(d[:16])) % 10)
        wrong = wrong if not luhn(wrong) else d[:15] + str((int(wrong[15]) + 1) % 10)
        out += [("other_card", wrong), ("other_card", " ".join(wrong[i:i + 4] for i in range(0, 16, 4)))]
    return out


# Countries and shapes (0 a digit, A a letter) of generated IBANs.
_IBAN_SHAPES = (("DE", "0" * 18), ("AT", "0" * 16), ("ES", "0" * 20), ("BE", "0" * 12), ("PL", "0" * 24),
                ("GB", "AAAA" + "0" * 14), ("NL", "AAAA" + "0" * 10), ("FR", "0" * 10 + "A0" * 5 + "000"))


def _ibans(seed: str, n: int) -> Iterator[tuple[str, bool]]:
    """``n`` made-up IBANs and as many with wrong check digits, each compact or
    in groups of four, and whether it passes the check."""
    rng = random.Random(seed)
    for _ in range(n):
        country, shape = rng.choice(_IBAN_SHAPES)
        body = "".join(rng.choice("0123456789" if c == "0" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in shape)
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        wrong = (check - 2 + rng.randrange(1, 97)) % 97 + 2
        for digits, good in ((check, True), (wrong, False)):
            whole = f"{country}{digits:02d}{body}"
            yield rng.choice((whole, " ".join(whole[i:i + 4] for i in range(0, len(whole), 4)))), good


def _with_accounts(before: str, after: str, n: int) -> Iterator[tuple[list[float], int]]:
    """Candidates in and over generated IBANs that stand in a context."""
    for form, good in _ibans(before + after, n):
        a, b = len(before), len(before) + len(form)
        text = before + form + after
        for kind, x, y in candidates(text):
            if x < b and a < y:
                whole = good and (kind, x, y) == ("account", a, b)
                yield features(kind, text[x:y], *_context(text, x, y)), int(whole)


def _placed(kind: str, forms: list[str], before: str, after: str) -> Iterator[tuple[list[float], int]]:
    """Forms of a confirmed number that stand in a context, and as negatives
    some of the other candidates that have a part in them."""
    text = before + " ".join(forms) + after
    own, at = set(), len(before)
    for form in forms:
        own.add((kind, at, at + len(form)))
        at += len(form) + 1
    parts = [s for s in candidates(text) if s not in own and s[1] < at - 1 and len(before) < s[2]]
    for k, a, b in [*own, *random.Random(text).sample(parts, min(len(parts), 4 * len(own)))]:
        yield features(k, text[a:b], *_context(text, a, b)), int((k, a, b) in own)


def training_rows(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and label (1 personal, 0 not) of the text's candidates."""
    base = base_spans(text)
    for kind, a, b in base:
        if kind != "ip":
            for form in (text[a:b], *_rewritten(kind, text[a:b])):
                if kind == "email" or form.startswith("+"):  # parts of a full phone number are never free
                    yield features(_ADDED[kind], form, *_context(text, a, b)), 1
                else:
                    for n in (1, 2):  # alone and next to another
                        yield from _placed(_ADDED[kind], [form] * n, *_context(text, a, b))
            for other, form in _innocent(text[a:b]):
                yield features(other, form, *_context(text, a, b)), 0
            yield from _with_accounts(*_context(text, a, b), 1)
    for kind, a, b in candidates(text):
        account = kind == "account" and _iban(text[a:b])
        if account or not any(x < b and a < y for _, x, y in base):
            yield features(kind, text[a:b], *_context(text, a, b)), int(account)
        if kind == "account":
            yield from _with_accounts(*_context(text, a, b), 4)


# -- boosted trees ------------------------------------------------------------------

class BoostedTrees:
    """Logistic boosting with complete trees of one depth over binned features."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 24):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.start, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1], method="lower")) for c in x.T]
        binned = np.stack([np.searchsorted(cut, c) for cut, c in zip(cuts, x.T)], axis=1)
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            levels = []
            for level in range(self.depth):
                feature, at, cut = self._split(binned, node, 1 << level, grad, hess, cuts)
                levels.append((feature, cut))
                node = 2 * node + (binned[np.arange(len(y)), feature[node]] > at[node])
            size = 1 << self.depth
            g, h = (np.bincount(node, v, size) for v in (grad, hess))
            leaf = self.rate * g / (h + 1.0)
            score += leaf[node]
            self.trees.append((levels, leaf))
        return self

    def _split(self, binned, node, size, grad, hess, cuts):
        """The best feature and bin of each node of a level."""
        best = np.full(size, -1.0)
        feature, at, value = np.zeros(size, np.int64), np.full(size, self.bins), np.full(size, np.inf)
        for f, cut in enumerate(cuts):
            key = node * self.bins + binned[:, f]
            g, h = (np.bincount(key, v, size * self.bins).reshape(size, -1) for v in (grad, hess))
            gl, hl = g.cumsum(1), h.cumsum(1)
            gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
            gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1)
            gain[:, len(cut):] = -1.0  # no cut there
            j = gain.argmax(1)
            top = gain[np.arange(size), j]
            better = top > best + 1e-12
            best[better], feature[better], at[better] = top[better], f, j[better]
            if len(cut):
                value[better] = cut[np.minimum(j[better], len(cut) - 1)]
        return feature, at, value

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for levels, leaf in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for feature, cut in levels:
                node = 2 * node + (x[rows, feature[node]] > cut[node])
            total += leaf[node]
        return total


class Detector:
    """Trees with a score threshold per kind; kinds without one add nothing."""

    def __init__(self, trees: BoostedTrees | None = None, limits: dict[str, float] | None = None):
        self.trees, self.limits = trees, limits or {}

    def added(self, text: str, base: list[Span]) -> list[Span]:
        if self.trees is None:
            return []
        # digits of an account number may look like a card: it may hold a base span
        free = [s for s in candidates(text) if s[0] in self.limits
                and not any(a < s[2] and s[1] < b and not (s[0] == "account" and s[1] <= a and b <= s[2])
                            for _, a, b in base)]
        good = []
        for i in range(0, len(free), SCORED):
            part = free[i:i + SCORED]
            scores = self.trees.score(np.array([features(k, text[a:b], *_context(text, a, b)) for k, a, b in part]))
            good += ((s, span) for s, span in zip(scores, part) if s >= self.limits[span[0]])
        taken: list[Span] = []  # by start, none overlaps another
        for _, (kind, a, b) in sorted(good, key=lambda x: (-x[0], x[1][1], x[1][2])):
            at = bisect_left(taken, b, key=lambda s: s[1])
            if at == 0 or taken[at - 1][2] <= a:
                taken.insert(at, (kind, a, b))
        return taken

    def find(self, text: str) -> list[Span]:
        """Base spans and added ones, by kind in the order of KINDS, then start."""
        base = base_spans(text)
        return sorted(base + self.added(text, base), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def calibrated_limit(scores: np.ndarray, labels: np.ndarray, probability: float) -> float:
    """The score at which a logistic curve through held-out scores reaches the
    probability. Labels are smoothed by one count on either side, so a sample
    that the trees separate fully still gets a finite curve."""
    up = int(labels.sum())
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (len(labels) - up + 2))
    z = np.stack([scores, np.ones(len(scores))], axis=1)
    w = np.array([1.0, 0.0])  # the scores are log odds already
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (target - p) - 1e-3 * (w - [1.0, 0.0])
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -1, 1)
        w[0] = max(w[0], 0.05)  # a higher score never means a lower probability
    return float((np.log(probability / (1 - probability)) - w[1]) / w[0])


def fit(df: DataFrame, text_col: str = "text", max_texts: int = MAX_TEXTS,
        max_candidates: int = MAX_CANDIDATES) -> Detector:
    """Train and calibrate on a bounded sample of the texts, chosen by hash."""
    ship_package(df.sparkSession)
    n = df.count()
    texts = df.select(F.col(text_col).alias("text"))
    if n > max_texts:
        share = int(max_texts / n * (1 << 30))
        texts = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share)
    schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("y", T.IntegerType())])

    def run(batches):
        for batch in batches:
            rows = [r for t in batch.column(0) for r in training_rows(t.as_py() or "")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in rows], pa.list_(pa.float64())),
                 pa.array([y for _, y in rows], pa.int32())], names=["x", "y"])

    order = F.xxhash64("x", "y")
    sample = (texts.mapInArrow(run, schema).withColumn("o", order)
                   .orderBy("o", "x", "y").limit(max_candidates).collect())
    y = np.array([r.y for r in sample], dtype=float)
    if not 0 < y.sum() < len(y):
        return Detector()
    x = np.array([r.x for r in sample])
    held = np.array([r.o for r in sample]) % 4 == 0
    if not 0 < y[~held].sum() < (~held).sum():
        return Detector()
    trees = BoostedTrees().fit(x[~held], y[~held])
    scores = trees.score(x[held])
    limits = {}
    for i, kind in enumerate(ADDED_KINDS):
        own = x[held][:, 0] == i
        if (y[held][own] == 1).any():
            limits[kind] = calibrated_limit(scores[own], y[held][own], PRECISION)
    return Detector(trees, limits)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         detector: Detector | None = None) -> DataFrame:
    """(id, ``spans``) per input row; fits a detector on the texts if none is given."""
    found = fit(df, text_col) if detector is None else detector
    return span_table(df, found.find, id_col, text_col)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping
    spans become one, named after the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += (text[at:a], f"[{kind.upper()}]")
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", detector: Detector | None = None) -> DataFrame:
    """All rows and columns, personal data in the text replaced; null stays null."""
    found = fit(docs, text_col) if detector is None else detector

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redacted(t, found.find(t)))

    return docs.withColumn(text_col, clean(F.col(text_col)))
