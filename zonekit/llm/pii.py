"""2. Personal data by candidate gradient boosting.

Rules with a check (``base_spans``) always redact. Beside them high-recall generators propose more spans, which may
overlap: addresses spelled out, national phone numbers, account numbers, IPv6 addresses, keys and passwords. Boosted
trees score each candidate by its format and context; a Platt fit on held-out candidates turns scores into
probabilities, and each generator's threshold is the least probability at which the precision on them reaches
``PRECISION``. Candidates are held out by whole forms of strings, so calibration speaks for forms that trees haven't seen. Of overlapping accepted candidates one that holds another whole
goes before it, so that no part of it is left over, else the likeliest stays; none stays that touches a base span.

No labels of personal data exist, so ``train`` makes them: into windows of the ``SAMPLE_DOCS`` documents with the least
hashes (a bounded sample) it plants ``PLANTED`` strings from templates, half personal data and half look-alikes.

Spans count code points, end exclusive. Null text counts as empty and has no spans. Rows, repeated rows and
other columns stay as they are; a result column replaces one of its name. An empty table trains on planted strings
alone and stays empty.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sampled

#: Bounds of the training sample, and the precision that thresholds must reach on kept-out forms.
SAMPLE_DOCS, PLANTED, PRECISION = 300, 6000, 0.99
#: Folds of forms for calibration, and the highest threshold.
FOLDS, HIGHEST = 5, 0.95
#: Boosting: trees, depth, step, bins of a feature.
TREES, DEPTH, STEP, BINS = 50, 3, 0.25, 32
#: Kinds in the order in which spans with equal starts stand.
KINDS = ["email", "ip", "card", "phone", "account", "secret"]

SPANS = "array<struct<kind string, start int, end int, base boolean, probability double>>"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Around each @: the local part reaches left to the end of the match before, so the time is linear."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        local = at
        while local > end and (c := text[local - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            local -= 1
        if local < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((local, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four fixed kinds, leftmost and without overlap in a kind; matches that fail a check are dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


#: An "at" of an address spelled out, and the domain after it.
_AT = re.compile(r"(?i) ?(?:@|\(at\)|\[at\]| at ) ?")
_SPELLED = re.compile(r"(?i)[a-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[a-z0-9-]{2,}+)++")
_HEX = "[0-9A-Fa-f]{1,4}"
_GROUPS = f"{_HEX}(?::{_HEX}){{0,6}}"


def _spelled_emails(text: str) -> Iterator[tuple[int, int]]:
    """As in ``_emails`` the local part reaches left from each "at", to the end of the match before."""
    end = 0
    for m in _AT.finditer(text):
        local = m.start()
        while local > end and (c := text[local - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            local -= 1
        if local < m.start() and (d := _SPELLED.match(text, m.end())):
            end = d.end()
            yield local, end


def _all(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    found = re.compile(pattern).finditer
    return lambda text: (m.span() for m in found(text))


#: Digits in groups with up to two signs between them, however many.
_NUMBER = re.compile(r"[+(]?[0-9](?:[ ()./-]{0,2}[0-9]){6,}+")
#: Most digits of a phone number; longer runs are proposed whole as accounts.
PHONE_DIGITS = 16


def _numbers(long: bool) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in _NUMBER.finditer(text) if (len(_DIGIT.findall(m[0])) > PHONE_DIGITS) == long)


#: Generators: name, kind, what each of its matches must hold (none: a digit), spans. Runs end where the token ends.
GENERATORS = [
    ("spelled_email", "email", re.compile(r"(?i)@|\(at\)|\[at\]| at "), _spelled_emails),
    ("numbers", "phone", None, _numbers(False)),
    ("long_numbers", "account", None, _numbers(True)),
    ("groups", "account", None, _all(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")),
    ("iban", "account", None, _all(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")),
    ("ipv6", "ip", re.compile(":"), _all(
        rf"(?<![0-9A-Za-z:])(?:(?:{_HEX}:){{3,7}}{_HEX}|{_GROUPS}::(?:{_GROUPS})?|::{_GROUPS})(?![0-9A-Za-z:])")),
    ("long_key", "secret", None, _all(r"(?<![0-9A-Za-z_])(?=[A-Za-z_]*+[0-9])[0-9A-Za-z_]{18,}+")),
    ("assigned", "secret", re.compile("[=:]"), _all(r"(?i)(?:password|passwd|secret|token|api[_-]?key) ?[=:] ?[\"']?[^\s\"']{8,}+[\"']?")),
]
#: Context words (lower case, before or after a span) and what they speak for.
CONTEXT = [re.compile(p) for p in (
    r"tel|phone|call|fax|mobil|cell|whatsapp|sms", r"mail|contact|write|reach", r"ssn|iban|passport|account|konto|social|tax",
    r"passw|token|secret|key|login|credential", r"version|v\.|build|release|section|chapter|page|isbn|issn|doi",
    r"order|invoice|ticket|ref|item|sku|total|price|eur|usd|qty|sum", r"date|since|until|year|born|time|clock")]
#: Words before "at" and a domain that name a place, not a person.
_PROSE = re.compile(r"(?i)(?:available|found|look|online|hosted|read|see|visit|here|more|us|them|him|it|is|are) ")
#: A local part of two names.
_NAME = re.compile(r"[A-Za-z0-9]+[._-][A-Za-z0-9]+[ (\[@]")


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(generator, start, end) of all generators; spans may overlap."""
    return [(g, a, b) for g, (_, _, needs, spans) in enumerate(GENERATORS) if (needs or _DIGIT).search(text) for a, b in spans(text)]


def features(text: str, g: int, start: int, end: int) -> list[float]:
    s = text[start:end]
    digits = "".join(_DIGIT.findall(s))
    groups = re.findall(r"[0-9]+", s)
    near = (text[max(0, start - 24):start] + " " + text[end:end + 12]).lower()
    own = [float(g == i) for i in range(len(GENERATORS))]
    form = [len(s), len(digits), sum(map(str.isupper, s)), sum(map(str.islower, s)), len(s) - len(digits) - sum(map(str.isalpha, s)),
            len(groups), len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0, s.startswith("+"), s.startswith("("), "." in s,
            "/" in s, " " in s, "-" in s, bool(digits) and luhn(digits), len(set(s)) / len(s),
            bool(re.fullmatch(r"(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}.*", s)),
            text[start - 1:start].isalnum() if start else 0, text[end:end + 1].isalnum(),
            ". " in s, "::" in s, s.count(":"), bool(digits) and any(c in "abcdefABCDEF" for c in s), max(map(len, s.split(":"))), "@" in s, "(" in s or "[" in s, len(s) - max(map(s.rfind, ". :)]")), bool(_PROSE.match(s)), bool(_NAME.match(s))]
    return own + [float(x) for x in form] + [float(bool(p.search(near))) for p in CONTEXT]


@dataclass
class Trees:
    """Boosted trees for a logistic loss, all of one depth: split features, thresholds and leaf values."""
    start: float
    split: np.ndarray
    above: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for split, above, leaf in zip(self.split, self.above, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), split[node]] > above[node])
            out += leaf[node - (2 ** DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    trees = Trees(float(np.log(mean / (1 - mean))), np.zeros((TREES, 2 ** DEPTH - 1), np.int64),
                  np.full((TREES, 2 ** DEPTH - 1), np.inf), np.zeros((TREES, 2 ** DEPTH)))
    score = np.full(len(y), trees.start)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, p * (1 - p) + 1e-9
        node = np.zeros(len(y), np.int64)
        for n in range(2 ** DEPTH - 1):
            here = np.flatnonzero(node == n)
            best = (1e-6, 0, np.inf, 0)
            if len(here) >= 20:
                g, h = grad[here], hess[here]
                for f in range(x.shape[1]):
                    b = binned[here, f]
                    gl, hl = (np.cumsum(np.bincount(b, w, len(edges[f]) + 1))[:-1] for w in (g, h))
                    gain = gl ** 2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
                    if len(gain) and gain.max() > best[0]:
                        k = int(gain.argmax())
                        best = (gain[k], f, edges[f][k], k)
            _, trees.split[t, n], trees.above[t, n], _ = best
            node[here] = 2 * n + 1 + (x[here, best[1]] > best[2])
        for leaf in range(2 ** DEPTH):
            here = node == leaf + 2 ** DEPTH - 1
            trees.leaf[t, leaf] = STEP * grad[here].sum() / (hess[here].sum() + 1) if here.any() else 0
        score += trees.leaf[t, node - (2 ** DEPTH - 1)]
    return trees


@dataclass
class Model:
    trees: Trees
    platt: tuple[float, float]
    thresholds: list[float]
    held_out: dict = field(default_factory=dict)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * self.trees.score(x) + b, -30, 30)))


def planted(r: random.Random) -> tuple[str, bool, int]:
    """A string in a short context, whether it is personal data, and the number of its form."""
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    a = lambda k, s="abcdefghijklmnopqrstuvwxyz": "".join(r.choice(s) for _ in range(k))
    at, dot = r.choice([(" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("(at)", "."), (" at ", "."), (" @ ", "."),
                       ("(AT)", "(DOT)"), (" AT ", " DOT "), ("[AT]", ".")])
    hexes, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
    group = lambda: a(r.randint(1, 4), hexes)
    four = lambda k: " ".join(n(4) for _ in range(k))
    name = a(r.randint(3, 8)) + r.choice(["", ".", "_"]) + a(r.randint(2, 6))
    yes = [
        f"{r.choice(['contact', 'mail', 'write to', 'e-mail:'])} |{name}{at}{a(r.randint(3, 8))}{dot}{r.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}|",
        f"{r.choice(['call', 'phone', 'tel.', 'Tel:', 'mobile', 'fax'])} |({n(3)}) {n(3)}-{n(4)}|", f"{r.choice(['call', 'phone:', 'tel'])} |{n(3)}-{n(3)}-{n(4)}|",
        f"{r.choice(['Tel.', 'phone', 'fax'])} |0{n(r.randint(2, 4))}/{n(r.randint(5, 8))}|", f"{r.choice(['SSN', 'social security', 'ssn:'])} |{n(3)}-{n(2)}-{n(4)}|",
        f"{r.choice(['IBAN', 'account', 'konto'])} |{r.choice(['DE', 'FR', 'ES'])}{n(2)} {n(4)} {n(4)} {n(4)} {n(4)} {n(2)}|",
        f"|{':'.join(a(4, hexes) for _ in range(8))}|", f"|AKIA{a(16, upper)}|", f"|password={a(r.randint(10, 20), hexes)}|", f"|token = \"{a(40, hexes)}\"|",
        f"|api_key: {a(r.randint(20, 32), hexes)}|", f"|{a(r.choice([64, 96, 128]), hexes)}|",
        f"|token={'.'.join(a(r.randint(20, 120), base64) for _ in range(3))}|",
        f"|{r.choice(['2001:db8', 'fe80', '2a02:' + group()])}::{':'.join(group() for _ in range(r.randint(1, 4)))}|",
        f"{r.choice(['reach me:', 'from', 'by mail', 'my address is'])} |{name}{at}{a(r.randint(3, 8))}{dot}{r.choice(['com', 'co.uk', 'io', 'info'])}|",
        f"{r.choice(['mobil', 'cell', 'sms to', 'whatsapp'])} |{n(4)} {n(3)} {n(3)}|", f"{r.choice(['my social', 'tax id', 'social sec.'])} |{n(3)}-{n(2)}-{n(4)}|",
        f"{r.choice(['transfer to', 'bank', 'account no.'])} |{r.choice(['GB', 'NL', 'IT', 'AT'])}{n(2)}{a(4, upper)}{n(4)}{n(4)}{n(2)}|",
        f"{r.choice(['account', 'konto', 'account no.'])} |{n(r.randint(17, 26))}|", f"{r.choice(['bank account', 'konto nr'])} |{four(r.randint(5, 6))}|",
        f"{r.choice(['gateway', 'host', 'from', 'address'])} |{':'.join(group() for _ in range(8))}|", f"{r.choice(['login', 'use'])} |secret: {a(r.randint(9, 24), base64)}|",
        f"{r.choice(['key', 'bearer'])} |{a(r.randint(28, 60), hexes)}{n(2)}|", f"|passwd={a(r.randint(8, 14), base64)}{n(2)}|",
        f"{r.choice(['ping', 'host', 'server', 'via'])} |{group()}:{group()}::{r.choice([group(), n(1), n(2), group() + ':' + group()])}|",
        f"{r.choice(['route', 'net', 'address'])} |{r.choice(['fd00', 'fe80', 'ff02'])}::{group()}|", f"|ghp_{a(36, base64[:62])}|", f"{r.choice(['phone', 'call', 'fax'])} |{n(3)}.{n(3)}.{n(4)}|",
        f"{r.choice(['to', 'from', 'dns'])} |2a00:{n(4)}:{group()}:{group()}::{group()}|", f"{r.choice(['node', 'ip', 'to'])} |{':'.join(a(r.randint(2, 4), hexes) for _ in range(8))}|",
        f"|{r.choice(['::1', '::ffff:' + group() + n(1), n(4) + '::' + group()])}| is up"]
    no = [
        f"met {r.choice(['him', 'them'])} |{a(5)} at {a(4)}. {a(5)}|", f"a |{a(5)} at {a(6)} dot {a(3)}| or two", f"order |{n(10)}|", f"ISBN |978-{n(1)}-{n(4)}-{n(4)}-{n(1)}|",
        f"version |{n(1)}.{n(2)}.{n(4)}.{n(2)}|", f"on |{r.randint(1950, 2030)}-{n(2)}-{n(2)}| at |{n(2)}:{n(2)}:{n(2)}:{n(2)}|", f"invoice |{n(3)}-{n(2)}-{n(4)}| total",
        f"|{n(2)}.{n(2)}.{r.randint(1950, 2030)}|", f"total |{n(3)} {n(3)} {n(3)}| EUR", f"|{a(r.randint(18, 40))}{n(1)}|", f"item |{a(4, upper)} {n(4)} {n(4)}| in stock",
        f"ref |{n(4)}/{n(4)}/{n(3)}|", f"ticket |{n(r.randint(8, 16))}|", f"doi |{n(2)}.{n(4)}/{n(6)}|", f"|{a(24)}_{a(6)}{n(2)}|", f"a token: |{a(9)}| of",
        f"|{r.choice(['available', 'found', 'look', 'online', 'read', 'see', 'us'])} at {a(r.randint(3, 8))}.{r.choice(['com', 'org', 'net'])}|",
        f"|{'_'.join(a(r.randint(3, 9)) for _ in range(r.randint(4, 14)))}_{n(1)}|", f"call |{a(3, 'abcdef')}::{a(3, 'abcdef')}|()",
        f"visit |{r.choice(['us', 'them', 'more', 'it'])} at {a(r.randint(3, 8))}.{r.choice(['com', 'org', 'net', 'de'])}|", f"order no. |{n(3)}-{n(2)}-{n(4)}| shipped",
        f"sku |{n(3)}-{n(2)}-{n(4)}|", f"item |{a(2, upper)}{n(2)} {n(4)} {n(4)}| qty", f"serial |{n(r.randint(17, 24))}| of the item", f"pi is |3.{n(r.randint(18, 30))}|",
        f"mac at |{n(2)}:{n(2)}:{n(2)}:{n(2)}:{n(2)}:{n(2)}| o'clock", f"a secret: |{a(r.randint(4, 7))}| of", f"page |{n(3)} {n(3)} {n(3)}| section", f"the |{a(r.randint(18, 30))}_{n(3)}| item",
        f"in |{a(4, 'abcdef')}::{a(4, 'abcdef')}| of", f"at |{n(1)}:{n(2)}:{n(2)}:{n(2)}:{n(3)}| time", f"use |{a(2, 'abcdef')}{n(1)}::{a(2, 'abcdef')}|()",
        f"ratio |{n(1)}:{n(1)}:{n(1)}:{n(1)}| mixed", f"lap |{n(2)}:{n(2)}:{n(2)}:{n(2)}|", f"call |{a(4, 'abcdef')}::{a(3, 'abcdef')}|<", f"a |{a(3, 'abcdef')}::{a(4, 'abcdef')}| b",
        f"verse |{n(1)}:{n(2)}:{n(1)}:{n(2)}:{n(2)}|", f"|{a(3, 'abcdef')}::{a(3, 'abcdef')}|::x"]
    good = r.random() < 0.5
    form = r.randrange(len(yes if good else no))
    return (yes if good else no)[form], good, form + (0 if good else len(yes))


def examples(texts: list[str], seed: int = 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and forms of the candidates in windows with planted strings."""
    r, x, y, forms = random.Random(seed), [], [], []
    texts = [t for t in texts if t] or ["some words before and after it in a text of no other use"]
    for _ in range(PLANTED):
        t = r.choice(texts)
        at = r.randrange(len(t))
        at = t.rfind(" ", 0, at) + 1
        marked, good, form = planted(r)
        pre = f"{t[max(0, at - 80):at]}{marked.split('|')[0]}"
        parts = marked.split("|")
        window, spans = pre, []
        for i, part in enumerate(parts[1:], 1):
            if i % 2:
                spans.append((len(window), len(window) + len(part)))
            window += part
        window += " " + t[at:at + 80]
        own = base_spans(window)
        for g, a, b in candidates(window):
            if any(a < e and s < b for _, s, e in own):
                continue
            overlap = max((min(b, e) - max(a, s) for s, e in spans), default=0)
            if overlap > 0:
                whole = any(overlap >= 0.8 * (e - s) and overlap >= 0.8 * (b - a) for s, e in spans)
                if good and not whole:
                    continue  # a part of a planted string teaches neither
                x.append(features(window, g, a, b))
                y.append(float(good))
                forms.append(form)
    return np.array(x), np.array(y), np.array(forms)


def platt(score: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic fit. Its targets stand off 0 and 1 by one example a class, so separable scores stay finite."""
    good, bad = truth.sum(), (1 - truth).sum()
    want = np.where(truth > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        w, e = p * (1 - p) + 1e-9, want - p
        m = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-3]])
        da, db = np.linalg.solve(m, [(e * score).sum(), e.sum()])
        a, b = a + float(np.clip(da, -1, 1)), b + float(np.clip(db, -1, 1))
    return a, b


def train(df: DataFrame, text: str = "text") -> Model:
    """Fit trees on windows of the documents with the least hashes; calibrate and set thresholds on forms that trees haven't seen.

    The forms of planted strings are dealt to ``FOLDS`` folds; each fold is scored by trees fitted without its forms. The Platt fit and the
    thresholds use these scores alone. A threshold is the least probability from 0.5 on at which the precision over
    kept-out forms reaches ``PRECISION``, at most ``HIGHEST``; ``held_out`` has recall and precision by generator.
    """
    x, y, forms = examples(sampled(df, text, SAMPLE_DOCS))
    score = np.empty(len(y))
    for k in range(FOLDS):
        out = forms % FOLDS == k
        score[out] = boost(x[~out], y[~out]).score(x[out])
    model = Model(boost(x, y), platt(score, y), [])
    a, b = model.platt
    p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
    for g, (name, *_) in enumerate(GENERATORS):
        own = x[:, g] == 1
        order = np.argsort(-p[own], kind="stable")
        last = np.append(np.diff(p[own][order]) != 0, True)  # equal probabilities pass together
        precise = (np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1) >= PRECISION) & last
        least = float(p[own][order][np.flatnonzero(precise)[-1]]) if precise.any() else HIGHEST
        model.thresholds.append(min(max(least, 0.5), HIGHEST))
        taken = p[own] >= model.thresholds[-1]
        model.held_out[name] = {"recall": float(y[own][taken].sum() / max(1, y[own].sum())), "precision": float(y[own][taken].mean()) if taken.any() else 1.0}
    model.held_out |= {"accuracy": float(((p > 0.5) == y).mean()), "candidates": len(y)}
    return model


def find(texts: list[str], model: Model) -> list[list[tuple[str, int, int, bool, float]]]:
    """All spans of each text: the base ones, and the accepted candidates beside them."""
    limits = np.array(model.thresholds)
    out, rows, x = [], [], []
    for i, t in enumerate(texts):
        own = [(k, a, b, True, 1.0) for k, a, b in base_spans(t)]
        out.append(own)
        fixed: list[list[int]] = []  # base spans put together, in order
        for _, a, b, _, _ in own:
            if fixed and a < fixed[-1][1]:
                fixed[-1][1] = max(fixed[-1][1], b)
            else:
                fixed.append([a, b])
        ends = [b for _, b in fixed]
        for g, a, b in candidates(t):
            at = bisect.bisect_right(ends, a)  # the first that ends behind the start
            if at == len(fixed) or fixed[at][0] >= b:
                rows.append((i, g, a, b))
                x.append(features(t, g, a, b))
    if rows:
        p = model.probabilities(np.array(x))
        taken: dict[int, list[tuple[int, int]]] = {}  # of each text, apart from each other and in order
        good = [j for j in range(len(rows)) if p[j] >= limits[rows[j][1]]]
        inner, last, reach = set(), -1, 0  # those that lie in another one
        for j in sorted(good, key=lambda j: (rows[j][0], rows[j][2], -rows[j][3], -p[j])):
            i, _, _, b = rows[j]
            if i == last and b <= reach:
                inner.add(j)
            else:
                last, reach = i, b
        for j in sorted(good, key=lambda j: (j in inner, -p[j], rows[j])):
            i, g, a, b = rows[j]
            own = taken.setdefault(i, [])
            at = bisect.bisect_left(own, (a, b))
            if (at == 0 or own[at - 1][1] <= a) and (at == len(own) or own[at][0] >= b):
                own.insert(at, (a, b))
                out[i].append((GENERATORS[g][1], a, b, False, float(p[j])))
    for spans in out:
        spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return out


def detect(df: DataFrame, model: Model, text: str = "text", to: str = "pii") -> DataFrame:
    """``df`` with column ``to``: the spans of ``text``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("probability", pa.float64())]))
    names = ["kind", "start", "end", "base", "probability"]

    @F.arrow_udf(SPANS)
    def spans(column: pa.Array) -> pa.Array:
        found = find([t or "" for t in column.to_pylist()], model)
        return pa.array([[dict(zip(names, s)) for s in ss] for ss in found], kind)

    return df.withColumn(to, spans(F.col(text).cast("string")))


def redacted(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in brackets; null stays null."""

    @F.arrow_udf("string")
    def clean(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        out = []
        for t, spans in zip(texts, find([t or "" for t in texts], model)):
            parts, end = [], 0
            for k, a, b, _, _ in spans:
                if a >= end:
                    parts += [t[end:a], f"[{k.upper()}]"]
                end = max(end, b)
            out.append("".join(parts) + t[end:] if spans else t)
        return pa.array(out, pa.string())

    return df.withColumn(text, clean(F.col(text).cast("string")))


def listed(spans: str, only_base: bool) -> Column:
    """kind:start:end of the spans, joined by commas."""
    chosen = f"filter({spans}, s -> s.base)" if only_base else spans
    return F.expr(f"array_join(transform({chosen}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
