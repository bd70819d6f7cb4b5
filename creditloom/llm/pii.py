"""Personal data in texts by weak supervision.

Four fixed patterns give the base spans.  They and weaker patterns propose candidates; labelers
(format, gazetteer, context, shape) vote on each.  Votes repeat, so all that is gathered are
counts of vote patterns.  Expectation-maximisation estimates from them how reliable each
labeler is, without any label, and the posteriors train a logistic classifier of spans, which
decides on the candidates beyond the base.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import small_batches
from creditloom.session import cut_lineage

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "birth", "handle", "number"]
CONTEXT = 32

# Look-behinds and possessive runs only spare attempts that could not succeed: a run of digits
# that fails from its start fails from every later digit too.
LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WEAK = [
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("birth", re.compile(r"(?<![0-9./-])[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}(?![0-9./-])")),
    ("handle", re.compile(r"(?<![A-Za-z0-9._%+@-])@[A-Za-z_][A-Za-z0-9_]{2,30}(?![A-Za-z0-9_.@-])")),
    ("number", re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){8,19}(?![0-9])")),
]
DIGIT, NOT_DIGIT = re.compile("[0-9]"), re.compile("[^0-9]")

# Fixed values of the gazetteers.
MAIL_DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at"}
CALLING_CODES = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "82", "86", "91"}
IBAN_COUNTRIES = {"AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE"}
# Fixed values of the context labelers.
FOR = re.compile(r"mail|contact|call|phone|tel\b|mobile|fax|card|visa|iban|account|konto|born|birth|geboren|name|user|passport|address|\bip\b", re.I)
AGAINST = re.compile(r"version|isbn|issn|order|invoice|serial|token|hash|sha\d|commit|build|page|figure|table|example|http", re.I)

LABELERS = ["format", "gazetteer", "context", "counter_context", "edges", "variety"]
SHAPES = ["long", "separated", "letters", "line_start", "line_end"]


def luhn(digits: str) -> bool:
    """Whether the check digit holds."""
    doubled = [2 * int(d) - 9 * (d > "4") if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and a domain with a dot, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by kind, then start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 8 <= sum(map(m[0].count, "0123456789")) <= 15:
                out.append(("phone", *m.span()))
    return out


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates of the other kinds that touch no base span nor an earlier candidate."""
    if not ("@" in text or DIGIT.search(text)):
        return []
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for kind, pattern in WEAK:
        fresh = []
        at = 0
        for m in pattern.finditer(text):
            a, b = m.span()
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if at == len(taken) or taken[at][0] >= b:
                fresh.append((a, b))
                out.append((kind, a, b))
        taken = sorted(taken + fresh)
    return out


def votes(text: str, kind: str, start: int, end: int, valid: bool) -> str:
    """One sign for each labeler: + personal, - not, 0 no opinion."""
    span = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = NOT_DIGIT.sub("", span)
    known = {
        "email": span.rpartition(".")[2].lower() in MAIL_DOMAINS,
        "phone": any(digits.startswith(c) for c in CALLING_CODES),
        "iban": span[:2] in IBAN_COUNTRIES,
        "card": digits[:1] in {"3", "4", "5", "6"},
        "birth": True,
    }.get(kind)
    edge = (text[start - 1 : start] + text[end : end + 1]) if start else text[end : end + 1]
    return "".join(
        [
            "+" if valid else "-",
            "0" if known is None else "+" if known else "-",
            "+" if FOR.search(before) or FOR.search(after) else "0",
            "-" if AGAINST.search(before) else "0",
            "-" if any(c.isalnum() for c in edge) else "+",
            "0" if not digits else "-" if len(set(digits)) < 3 or digits in "01234567890123456789" else "+",
        ]
    )


def valid_format(kind: str, span: str) -> bool:
    """The format labeler's check for the kinds beyond the base."""
    if kind == "iban":
        plain = span.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    if kind == "birth":
        day, month, year = map(int, re.split("[./-]", span))
        return min(day, month) >= 1 and min(day, month) <= 12 and max(day, month) <= 31 and 1900 <= year <= 2030
    if kind == "number":
        digits = NOT_DIGIT.sub("", span)
        return len(digits) in (9, 11) and len(span) > len(digits)
    return True


def shape(text: str, start: int, end: int) -> str:
    """One bit for each of SHAPES."""
    span = text[start:end]
    bits = [
        len(span) > 16,
        any(c in " -.()" for c in span),
        any(c.isalpha() for c in span),
        start == 0 or text[start - 1] == "\n",
        end == len(text) or text[end] == "\n",
    ]
    return "".join("01"[b] for b in bits)


CANDIDATES = "array<struct<kind:string,start:long,end:long,votes:string,shape:string>>"


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found): the candidates of each row with their votes, base kinds first."""

    @F.pandas_udf(CANDIDATES)
    def propose(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for value in batch:
                value = value or ""
                base = base_spans(value)
                rows = [(k, a, b, True) for k, a, b in base]
                rows += [(k, a, b, valid_format(k, value[a:b])) for k, a, b in weak_spans(value, base)]
                out.append(
                    [
                        {"kind": k, "start": a, "end": b, "votes": votes(value, k, a, b, ok), "shape": shape(value, a, b)}
                        for k, a, b, ok in rows
                    ]
                )
            yield pd.Series(out)

    return docs.select(F.col(doc_id).alias("doc_id"), propose(F.col(text)).alias("found"))


def reliabilities(kinds: np.ndarray, signs: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior of each vote pattern by expectation-maximisation over counted patterns.

    Classes: personal or not.  Each kind has a share of personal spans, each labeler a
    distribution over its three votes for either class.  Starts from the balance of votes.
    """
    posterior = 1 / (1 + np.exp(-(signs.sum(axis=1) - 0.5)))
    onehot = (signs[:, :, None] == np.array([-1, 0, 1])).astype(float)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        spread = np.einsum("zn,njv->zjv", weight, onehot) + 0.5
        spread /= spread.sum(axis=2, keepdims=True)
        prior = np.zeros(len(counts))
        for kind in np.unique(kinds):
            own = kinds == kind
            prior[own] = (weight[1][own].sum() + 1) / (counts[own].sum() + 2)
        logs = np.einsum("njv,zjv->zn", onehot, np.log(spread))
        fresh = 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + np.log1p(-prior) - np.log(prior), -60, 60)))
        if np.abs(fresh - posterior).max() < 1e-9:
            break
        posterior = fresh
    return posterior


def logistic(rows: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Probabilities of a ridge-penalised logistic fit to soft labels, by Newton steps."""
    x = np.hstack([np.ones((len(rows), 1)), rows])
    beta = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (counts * (target - p)) - penalty @ beta
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + penalty
        move = np.linalg.solve(hessian, gradient)
        beta += move * min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-9:
            break
    return 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))


def classify(found: DataFrame) -> dict[tuple[str, str, str], float]:
    """Probability of each (kind, votes, shape) that occurs in ``found``.

    The patterns are counted over all rows; there are at most kinds * 3^labelers * 2^shapes of
    them however large the corpus is, and only those that occur reach the driver.
    """
    counted = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.votes", "c.shape").count()
    rows = sorted((r["kind"], r["votes"], r["shape"], r["count"]) for r in counted.collect())
    if not rows:
        return {}
    kinds = np.array([r[0] for r in rows])
    signs = np.array([["-0+".index(v) - 1 for v in r[1]] for r in rows])
    counts = np.array([r[3] for r in rows], dtype=float)
    soft = reliabilities(kinds, signs, counts)
    own = (kinds[:, None] == np.array(KINDS)).astype(float)
    bits = np.array([[float(b) for b in r[2]] for r in rows])
    fitted = logistic(np.hstack([own, bits, signs]), soft, counts)
    return {r[:3]: float(p) for r, p in zip(rows, fitted, strict=True)}


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, spans): array of (kind, start, end, probability, base), by kind, then start.

    One row for each row of ``docs``.  Base spans always stay, leftmost and not overlapping
    within a kind; candidates of the other kinds come with a probability of at least ``least``.
    Positions are in code points, end exclusive.  Null text counts as empty; empty texts have
    no spans; null ids stay null; repeated rows are scanned, and counted, each; an empty table
    gives no rows; other columns are not looked at.
    """
    small_batches(docs)
    found = cut_lineage(candidates(docs, doc_id, text))
    shared = docs.sparkSession.sparkContext.broadcast(classify(found))

    @F.pandas_udf("array<struct<kind:string,start:long,end:long,probability:double,base:boolean>>")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            out = []
            for spans in batch:
                rows = []
                for c in spans:
                    p, base = model[c["kind"], c["votes"], c["shape"]], c["kind"] in BASE_KINDS
                    if base or p >= least:
                        rows.append({"kind": c["kind"], "start": c["start"], "end": c["end"], "probability": p, "base": base})
                out.append(sorted(rows, key=lambda r: (KINDS.index(r["kind"]), r["start"])))
            yield pd.Series(out)

    return found.select(F.col("doc_id").alias(doc_id), decide("found").alias("spans"))


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of ``find``."""
    found = find(docs, doc_id, text)

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(doc_id, *[count(k) for k in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
