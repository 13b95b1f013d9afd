"""Personal data by weak supervision.

Plain patterns give the base spans. Further candidates - digit groups, long tokens and
spelled-out addresses that no base span covers - are voted on by labelers (shape,
gazetteer, context, length, mixture). Candidates are counted by their votes over the
whole corpus, expectation-maximisation on those counts estimates how reliable each
labeler is, and the resulting labels train a logistic span classifier, which decides.
The counts have one row per combination of votes and kind: their number is fixed by the
labelers, so the driver sees no more on a larger corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.llm.common import small_batches, texts, unused
from passagework.session import written

BASE = ("email", "ip", "card", "phone")
ADDED = ("number", "secret", "address")
KINDS = BASE + ADDED
SPAN = "array<struct<kind: string, start: int, end: int, votes: int>>"
SCHEMA = (
    "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, "
    f"base_sha256 string, base {SPAN}, more {SPAN}"
)
LABELERS = 6
#: The classifier's least probability for a span that no base pattern found.
ACCEPT = 0.9

# The words that the gazetteer and context labelers know.
BEFORE = frozenset(
    "phone tel telephone mobile fax call contact ssn social card account iban passport id "
    "token key secret password passwd pwd api email mail telefon konto téléphone teléfono".split()
)
AGAINST = frozenset(
    "version page pages isbn year chapter section figure table line total price usd eur no number".split()
)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive, and only from the start of digits: the same matches in linear time
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[\x20()./-]{0,2}[0-9]){6,}")
SECRET = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+(?=[^A-Za-z0-9_-]|\Z)")
ADDRESS = re.compile(
    r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?[A-Za-z0-9-]{1,63}){1,5}"
)
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost spans that don't overlap within their kind, by kind and start; failing ones drop."""
    out: list[tuple[str, int, int]] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        tail = EMAIL_TAIL.match(text, at) if start < at else None
        if tail:
            end = tail.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def votes(kind: str, value: str, before: str) -> int:
    """The labelers' votes as digits to the base three: 0 abstains, 1 against, 2 for."""
    digits, words = _digits(value), [w.lower() for w in _WORD.findall(before)[-3:]]
    letters = sum(c.isalpha() for c in value)
    shape = 2 if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{16}|[0-9a-f]{32,64}", value) else 0
    if re.fullmatch(r"(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}.*", value):
        shape = 1
    known = 2 if any(w in BEFORE for w in words) else 0
    context = 1 if any(w in AGAINST for w in words) else 2 if before.rstrip().endswith((":", "=", '"')) else 0
    if kind == "secret":
        mixed = 2 if len(digits) >= 4 and letters >= 4 else 1
        length = 2 if len(value) >= 32 else 0
    elif kind == "number":
        mixed = 1 if len(set(digits)) < 3 else 0
        length = 2 if 9 <= len(digits) <= 19 else 1
    else:
        mixed, length = 2, 0
    groups = len(re.findall(r"[0-9]+", value))
    grouped = 2 if kind == "number" and 2 <= groups <= 4 and len(digits) >= 9 else 1 if groups > 6 else 0
    code = 0
    for v in (shape, known, context, mixed, length, grouped):
        code = code * 3 + v
    return code


def further_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int]]:
    """Candidates clear of the base spans, with their kind and votes."""
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for kind, pattern in zip(ADDED, (NUMBER, SECRET, ADDRESS), strict=True):
        if kind == "address" and "at" not in text:
            continue
        k = 0
        for m in pattern.finditer(text):
            a, b = m.span()
            if kind == "secret" and (not re.search(r"[0-9]", m[0]) or m[0].isdigit()):
                continue
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if any(x < b and a < y for x, y in taken[max(0, k - 1) : k + 4]):
                continue
            out.append((kind, a, b, votes(kind, m[0], text[max(0, a - 40) : a])))
    return out


def candidate_spans(docs: DataFrame) -> DataFrame:
    """Base spans, their digest, and voted candidates of every whole text (null: empty)."""
    names = [x.split()[0] for x in SCHEMA.split(", ")[:6]] + ["base_sha256", "base", "more"]

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames, "text", 8_000_000):
            out = []
            for doc_id, key, text in zip(frame["doc_id"], frame["text_key"], frame["text"], strict=True):
                base = base_spans(text)
                counts = [sum(k == kind for k, _, _ in base) for kind in BASE]
                digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
                more = further_spans(text, base)
                out.append(
                    (
                        doc_id,
                        key,
                        *counts,
                        digest,
                        [dict(kind=k, start=a, end=b, votes=-1) for k, a, b in base],
                        [dict(kind=k, start=a, end=b, votes=v) for k, a, b, v in more],
                    )
                )
            made = pd.DataFrame(out, columns=names)
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    keyed = texts(docs, "doc_id").select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return keyed.mapInPandas(find, SCHEMA)


def unfold(code: np.ndarray) -> np.ndarray:
    return np.stack([code // 3 ** (LABELERS - 1 - i) % 3 for i in range(LABELERS)], axis=1)


def reliabilities(ballots: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over counted votes: (posterior, P(vote | class, labeler), prior).

    Starts from the majority of votes; a vote is 0, 1 or 2, abstaining included.
    """
    score = (ballots == 2).sum(axis=1) - (ballots == 1).sum(axis=1)
    post = 1 / (1 + np.exp(-1.5 * score.astype(float)))
    like, prior = np.full((2, ballots.shape[1], 3), 1 / 3), 0.5
    for _ in range(rounds):
        weight = np.stack([n * (1 - post), n * post])
        prior = float(np.clip(weight[1].sum() / weight.sum(), 1e-4, 1 - 1e-4))
        for i in range(ballots.shape[1]):
            for v in range(3):
                like[:, i, v] = (weight * (ballots[:, i] == v)).sum(axis=1) + 1
            like[:, i] /= like[:, i].sum(axis=1, keepdims=True)
        logs = sum(np.log(like[:, i, ballots[:, i]]) for i in range(ballots.shape[1]))
        gap = logs[1] - logs[0] + np.log(prior / (1 - prior))
        post = 1 / (1 + np.exp(-np.clip(gap, -30, 30)))
    return post, like, prior


def train_classifier(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weighted logistic regression on probabilistic labels, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    n = n / n.sum() * len(n)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (n * (y - p)) - 0.05 * w)
    return w


def _features(kinds: np.ndarray, ballots: np.ndarray) -> np.ndarray:
    parts = [kinds == k for k in ADDED]
    parts += [ballots[:, i] == v for i in range(ballots.shape[1]) for v in (1, 2)]
    return np.stack(parts, axis=1).astype(float)


def accepted(counts: list[tuple[str, int, int]], accept: float = ACCEPT) -> list[tuple[str, int]]:
    """The (kind, votes) that the trained classifier takes for personal data."""
    if not counts:
        return []
    kinds = np.array([c[0] for c in counts])
    codes, n = (np.array([c[i] for c in counts]) for i in (1, 2))
    ballots = unfold(codes)
    post, _, _ = reliabilities(ballots, n)
    x = _features(kinds, ballots)
    w = train_classifier(x, post, n)
    p = 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(x)), x]) @ w, -30, 30)))
    # a labeler's say is needed: what all abstain from is no finding
    chosen = (p >= accept) & (ballots == 2).any(axis=1)
    return [(str(k), int(c)) for k, c, yes in zip(kinds, codes, chosen, strict=True) if yes]


def personal_spans(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """Per row of ``docs``: base counts and digest, and ``found``, all spans by kind and start.

    Positions are code points, ends exclusive. Null and empty texts have none. Runs two jobs:
    texts are read once, the second reads the counts of votes.
    """
    spans = written(candidate_spans(docs), "spans")
    counts = (
        spans.select(F.explode("more").alias("s")).groupBy("s.kind", "s.votes").agg(F.count("*").alias("n"))
    ).collect()  # one row for each combination of kind and votes
    taken = accepted(sorted((r["kind"], r["votes"], r["n"]) for r in counts), accept)
    by_kind = {k: [v for kind, v in taken if kind == k] for k in ADDED}

    def good(s):
        tests = [(s["kind"] == k) & s["votes"].isin(v) for k, v in by_kind.items() if v]
        return F.lit(False) if not tests else F.coalesce(*[F.when(t, True) for t in tests], F.lit(False))

    return spans.withColumn("found", F.concat("base", F.filter("more", good))).drop("base", "more")


def described(found) -> F.Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets.

    Other columns stay; ``n_chars``, if there, follows the new text. Null texts stay null. Rows
    with equal ``doc_id`` and text are equal in what is found, so the join keeps their number.
    """
    columns = docs.columns
    found = personal_spans(docs).where(F.size("found") > 0)
    d, k, key, spans = unused(docs, "_d", "_k", "_key", "_found")
    once = found.groupBy(F.col("doc_id").alias(d), F.col("text_key").alias(k)).agg(F.first("found").alias(spans))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    # texts move once, to what was found, at every size
    joined = keyed.join(written(once, "found").hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(key) == F.col(k)), "left")

    @F.pandas_udf("string")
    def masked(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(text, spans, strict=True):
            if t is None or s is None or not len(s):
                out.append(t)
                continue
            parts, at = [], 0
            for x in sorted(s, key=lambda x: (x["start"], -x["end"])):
                if x["start"] >= at:
                    parts += [t[at : x["start"]], f"<{x['kind'].upper()}>"]
                at = max(at, x["end"])
            out.append("".join([*parts, t[at:]]))
        return pd.Series(out, dtype="object")

    done = joined.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(masked("text", spans)))
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return done.select(*columns)
