"""Operator 12: personal data by weak supervision.

Base spans are what four fixed patterns and their checks find. Beyond them, wider
patterns propose candidates: addresses written around the @ sign, version 6 and
defanged network addresses, numbers in card and phone shapes without the base's
marks. Labelers vote yes, no or nothing on every candidate: the checksum or shape
(regex), known endings, prefixes and codes (gazetteer), the words before it and the
characters around it (context). Spark counts the vote patterns over all documents;
expectation-maximisation estimates each labeler's reliabilities from them, with base
spans known to be right, and a logistic span classifier is trained on its
posteriors. Candidates that it accepts are added to the base spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import let_go, picked, slices, table

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.5  # probability from which a candidate becomes a span
ROUNDS = 60  # of expectation-maximisation
PRIOR = 0.5  # weight of the labelers' prior reliabilities, as a share of the candidates
BEFORE = 40  # characters before a candidate whose words are looked at
LONGEST = 200  # characters of a candidate

# --- base spans: fixed patterns of the contract ---------------------------------------

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# no match starts inside a run of digits: where the run's start fails, so do its other places
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 if d > 4 else d * 2
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@`` and DOMAIN, in time linear in the text:
    the run of address characters before each @ is measured backwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done and (m := DOMAIN.match(text, at + 1)):
            run = text[done:at]
            start = done + len(run.rstrip(LOCAL))
            if start < at:
                out.append((start, m.end()))
                done = m.end()
        done = max(done, at + 1)  # no address holds an @ on its left side
        at = text.find("@", at + 1)
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> dict[str, list[Span]]:
    """The base spans of each kind; matches that fail their check are dropped, and the
    search goes on behind them."""
    cards, phones = [], []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGITS.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
            phones.append(m.span())
    return {"email": emails(text) if "@" in text else [],
            "ip": [m.span() for m in IP.finditer(text) if all(map(_byte, m.group().split(".")))],
            "card": cards, "phone": phones}


# --- candidates ---------------------------------------------------------------------------

# the middle and the right side of an address written around the @ sign
AT = re.compile(r" ?(?:\(at\)|\[at\]|\{at\}|@) ?| at ", re.I)
HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot |\.) ?[A-Za-z0-9-]{2,63}){1,4}(?![A-Za-z0-9-])",
                  re.I)


def written_emails(text: str) -> list[Span]:
    out, done = [], 0
    for m in AT.finditer(text):
        if m.start() >= done and (host := HOST.match(text, m.end())):
            run = text[max(done, m.start() - 64):m.start()]
            start = m.start() - len(run) + len(run.rstrip(LOCAL))
            if start < m.start():
                out.append((start, host.end()))
                done = host.end()
    return out


def _matches(pattern: str):
    found = re.compile(pattern)
    return lambda text: [m.span() for m in found.finditer(text)]


# wider finders per kind; all repeats are bounded, so a match costs bounded time
WIDER = {
    "email": [written_emails],
    "ip": [_matches(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
           _matches(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])"),
           _matches(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])")],
    "card": [_matches(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"),
             _matches(r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])")],
    "phone": [_matches(r"(?<![0-9(+])\([0-9]{2,5}\)[ -]?[0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9])"),
              _matches(r"(?<![0-9.+-])[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}(?![0-9])"),
              _matches(r"(?<![0-9+])00[1-9][0-9]{0,2}(?:[ .()/-]{1,2}[0-9]{2,6}){2,5}(?![0-9])"),
              _matches(r"(?<![0-9+])0[0-9]{2,4}[ /-][0-9]{3,4}(?:[ -]?[0-9]{2,4}){1,2}(?![0-9])")],
}
FORMS = 6  # finders of a kind at most; form 0 is the base

# What the gazetteer and context labelers know.
ENDINGS = frozenset("com org net edu gov io info biz de es fr it nl uk us ca au ch at be pl se no eu example".split())
CARD_PREFIX = re.compile(r"4|5[1-5]|2[2-7]|3[47]|36|38|30[0-5]|6011|65|35|62")
WORDS = {
    "email": "email e-mail mail contact write correo escriba courriel schreiben kontakt adresse",
    "ip": "ip address server host client addr login from dirección adresse rechner hôte",
    "card": "card visa mastercard amex credit debit payment tarjeta crédito karte kreditkarte carte crédit",
    "phone": "phone tel telephone call fax mobile cell whatsapp sms teléfono llame móvil telefon anruf "
             "handy téléphone appelez portable",
}
CONTEXT = {k: frozenset(v.split()) for k, v in WORDS.items()}
AGAINST = frozenset(
    "version v build order invoice isbn issn doi id no nr num number ref reference serial code section "
    "chapter page pages figure table hash token key sku item part model release pedido factura "
    "bestellung rechnung commande facture artikel".split())
LETTERS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
LABELERS = ("regex", "gazetteer", "context", "against", "around")


def _votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """Votes (1, 0, -1) of the LABELERS on one candidate."""
    span = text[start:end]
    digits = NOT_DIGITS.sub("", span)
    if kind == "email":
        host = re.split(r"at[\])}]| at |@", span, maxsplit=1, flags=re.I)[-1]
        last = re.split(r"[\s.)\]}]+", host.strip())[-1].lower()
        regex = 1 if "@" in span or re.search(r"[(\[{](at|dot)[)\]}]", span, re.I) else -1
        gazetteer = 1 if last in ENDINGS else -1
    elif kind == "ip":
        parts = re.split(r"[^0-9A-Fa-f]+", span)
        if ":" in span:
            regex = 1 if re.search(r"[0-9]", span) and (len(parts) >= 8 or "::" in span) and len(parts) >= 4 else -1
            gazetteer = 1 if re.match(r"2[0-9a-f]{3}:|fe80:|f[cd][0-9a-f]{2}:", span, re.I) else -1
        else:
            regex = 1 if all(map(_byte, re.split(r"[^0-9]+", span))) else -1
            gazetteer = -1 if span.startswith("0") else 1
    elif kind == "card":
        regex = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        gazetteer = 1 if CARD_PREFIX.match(digits) and len(digits) in (14, 15, 16, 19) else -1
    else:
        regex = 1 if 9 <= len(digits) <= 15 and len(set(digits)) > 2 else -1
        gazetteer = 1 if re.match(r"00[1-9]|0[1-9]|[2-9][0-9]{2}|1[2-9]", digits) else -1
    before = [w.lower() for w in LETTERS.findall(text[max(0, start - BEFORE):start])][-4:]
    context = 1 if any(w in CONTEXT[kind] for w in before) else 0
    against = -1 if any(w in AGAINST for w in before[-2:]) else 0
    left, right = text[max(0, start - 1):start], text[end:end + 1]
    joined = left.isalnum() or right.isalnum() or left in ("#", "=", "_", "/", '"', "'") or right in ("_", "/", '"', "'")
    return regex, gazetteer, context, against, -1 if joined else 1


def _union(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the places covered, in order and apart."""
    starts, ends = [], []
    for s, e in sorted(spans):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def candidates(text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int, int]]:
    """(kind, form, start, end): base spans as form 0, and of each kind the leftmost
    matches of the wider finders that meet no base span and none found before."""
    out = [(k, 0, s, e) for k in KINDS for s, e in base[k]]
    starts, ends = _union([(s, e) for _, _, s, e in out])
    digits = any(c in text for c in "0123456789")
    for kind in KINDS:
        if kind in ("card", "phone") and not digits or kind == "ip" and not digits and ":" not in text:
            continue
        for form, finder in enumerate(WIDER[kind], 1):
            new = []
            for s, e in finder(text):
                i = bisect_right(ends, s)
                if e - s <= LONGEST and not (i < len(starts) and starts[i] < e):
                    new.append((s, e))
            if new:
                out += [(kind, form, s, e) for s, e in new]
                starts, ends = _union([*zip(starts, ends, strict=True), *new])
    return out


PATTERN = "kind int, form int, " + ", ".join(f"{x} int" for x in LABELERS)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (kind, form, votes, n): a row per pattern that this task has seen."""
    let_go()
    counts: Counter = Counter()
    for b in slices(batches):
        for text in b.column("text").to_pylist():
            text = text or ""
            for kind, form, s, e in candidates(text, base_spans(text)):
                counts[(KINDS.index(kind), form, *_votes(kind, text, s, e))] += 1
    names = [f.split()[0] for f in PATTERN.split(", ")]
    rows = list(counts)
    yield pa.RecordBatch.from_arrays(
        [*(pa.array([r[i] for r in rows], pa.int32()) for i in range(len(names))),
         pa.array([counts[r] for r in rows], pa.int64())], names=[*names, "n"])


# --- the label model and the classifier ------------------------------------------------------

# a labeler's votes (-1, 0, 1) on wrong and on right candidates before any data is seen
PRIOR_VOTES = {
    "regex": ((0.90, 0.02, 0.08), (0.02, 0.02, 0.96)),
    "gazetteer": ((0.60, 0.05, 0.35), (0.15, 0.05, 0.80)),
    "context": ((0.02, 0.95, 0.03), (0.02, 0.58, 0.40)),
    "against": ((0.25, 0.74, 0.01), (0.02, 0.97, 0.01)),
    "around": ((0.50, 0.02, 0.48), (0.05, 0.02, 0.93)),
}
PRIOR_SHARE = 0.2  # of right ones among candidates that are not base spans


def label_model(votes: np.ndarray, base: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Probability of each vote pattern (rows of -1, 0, 1) to be right, by
    expectation-maximisation; base patterns are right. ``n`` counts candidates."""
    prior = np.log([[PRIOR_VOTES[x][y] for x in LABELERS] for y in (0, 1)])  # (2, labelers, 3)
    strength = max(20.0, PRIOR * float(n[~base].sum()))
    chance, share = prior, PRIOR_SHARE
    at = votes + 1
    right = base.astype(float)
    for _ in range(rounds if len(n) else 0):
        odds = np.log(share) - np.log(1 - share) + sum(
            chance[1, j, at[:, j]] - chance[0, j, at[:, j]] for j in range(len(LABELERS)))
        right = np.where(base, 1.0, 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        mass = np.exp(prior) * strength
        for y, p in ((0, 1 - right), (1, right)):
            # base spans pass the regex labeler by definition: they tell of the other labelers only
            for j in range(len(LABELERS)):
                np.add.at(mass[y, j], at[:, j], n * p * (~base | (j > 0)))
        chance = np.log(mass / mass.sum(axis=2, keepdims=True))
        free = float((n * ~base).sum())
        share = (float((n * right * ~base).sum()) + PRIOR_SHARE * strength) / (free + strength)
    return right


def features(kind: int, form: int, votes: tuple[int, ...]) -> list[int]:
    """Places of a candidate's features: its kind, its form, each labeler's vote, and
    the votes of regex and gazetteer per kind."""
    first = len(KINDS) + len(KINDS) * FORMS
    out = [kind, len(KINDS) + kind * FORMS + form]
    out += [first + 3 * j + v + 1 for j, v in enumerate(votes)]
    out.append(first + 3 * len(LABELERS) + kind * 9 + (votes[0] + 1) * 3 + votes[1] + 1)
    return out


WIDTH = len(KINDS) * (1 + FORMS + 9) + 3 * len(LABELERS)


def train(texts: DataFrame) -> np.ndarray:
    """Weights of the span classifier: logistic regression on the label model's
    posteriors, each kind's label model on its own. The driver gets a row per vote
    pattern, 4 * 6 * 3^5 at most whatever the corpus."""
    rows = texts.mapInArrow(_patterns, PATTERN + ", n bigint").groupBy("kind", "form", *LABELERS).agg(
        F.sum("n").alias("n")).orderBy("kind", "form", *LABELERS).collect()
    x, y, w = np.zeros((len(rows), WIDTH)), np.zeros(len(rows)), np.zeros(len(rows))
    for kind in range(len(KINDS)):
        mine = [i for i, r in enumerate(rows) if r.kind == kind]
        votes = np.array([[rows[i][v] for v in LABELERS] for i in mine], np.int64).reshape(-1, len(LABELERS))
        n = np.array([rows[i].n for i in mine], float)
        y[mine] = label_model(votes, np.array([rows[i].form == 0 for i in mine], bool), n)
        w[mine] = n
    for i, r in enumerate(rows):
        x[i, features(r.kind, r.form, tuple(r[v] for v in LABELERS))] = 1
    w = np.sqrt(w)  # frequent patterns, copies above all, lead without silencing the rest
    weights = np.zeros(WIDTH)
    for _ in range(25 if len(rows) else 0):  # Newton steps of the penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (w * (y - p)) - 0.1 * weights
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(WIDTH)
        weights += np.linalg.solve(hessian, gradient)
    return weights


def _joined(spans: list[tuple[str, int, int]]) -> str:
    spans = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def text_spans(text: str, weights: np.ndarray) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, spans that the classifier adds) of one text."""
    found, added = [], []
    for kind, form, s, e in candidates(text, base_spans(text)):
        if form == 0:
            found.append((kind, s, e))
        elif weights[features(KINDS.index(kind), form, _votes(kind, text, s, e))].sum() >= np.log(ACCEPT / (1 - ACCEPT)):
            added.append((kind, s, e))
    return found, added


SPANS = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"


def _found(weights: np.ndarray):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in slices(batches):
            out: list[list] = [[] for _ in range(7)]
            for text in b.column("text").to_pylist():
                base, added = text_spans(text or "", weights)
                n = Counter(k for k, _, _ in base)
                row = (*(n[k] for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(),
                       _joined(base + added), len(added))
                for o, v in zip(out, row, strict=True):
                    o.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(o, k) for o, k in zip(out, kinds, strict=True))],
                names=["doc_id", *(f.split()[0] for f in SPANS.split(", "))])
    return found


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_email, n_ip, n_card, n_phone (base
    spans), base_sha256, spans (base and added) and n_added.

    Spans count code points, end exclusive. Null text counts as empty: no spans, the
    digest of the empty text. Whole texts of any length are searched, in time linear
    in the text. Repeated rows give a row each; an empty table gives none.
    """
    docs = picked(docs, "doc_id", "text")
    weights = train(docs.select("text"))
    return docs.mapInArrow(_found(weights), f"doc_id {dict(docs.dtypes)['doc_id']}, {SPANS}")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
