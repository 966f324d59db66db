"""Personal data by weak supervision.

Four kinds have base rules (email, ip, card, phone) whose spans always stay. Beyond them
candidates of these and two more kinds (secret, name) are proposed by broad patterns, and
labelers vote on each: a strict pattern, a check of the value, a gazetteer and the words
around it. Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is for a kind (Dawid and Skene's model); the resulting
probabilities train the final classifier, naive Bayes over the shape, length and
neighbourhood of a span, which decides on the candidates.

Texts are read once. Everything after works on the few spans found: vote patterns and
feature counts are aggregates of bounded size, the only data that reach the driver.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise
from .common import arrow_map

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "name")
LABELERS = ("pattern", "check", "gazetteer", "context")
# Probability from which a candidate is taken.
ACCEPT = 0.9
EM_ROUNDS = 50
# Buckets that neighbouring words are hashed into.
BUCKETS = 256
NEAR = 32

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Starting inside a run of digits cannot match where its start does not.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Candidates: broader than the base rules.
SPELLED = re.compile(r"\b[\w.+-]{1,64}\s?(?:\(at\)|\[at\]|\{at\}|@)\s?[\w-]{1,63}(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\.)\s?[A-Za-z][\w-]{1,62}){1,4}")
NUMBERS = re.compile(r"(?<![\w.+-])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,18}(?![\w-])")
SECRET = re.compile(r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_/+-]*[0-9])(?=[0-9_/+-]*[A-Za-z])[A-Za-z0-9_+/-]{20,128}={0,2}(?![A-Za-z0-9_+/-])")
# Forms of address, top-level domains, words that announce a kind.
TITLES = "Mr Mrs Ms Dr Prof Herr Herrn Frau Monsieur Madame Mme Mlle Señor Señora Sr Sra Don Doña".split()
NAME = re.compile(r"\b(?:" + "|".join(TITLES) + r")\.? ((?:[A-ZÀ-ÖØ-Þ][\w'’-]{1,30})(?: [A-ZÀ-ÖØ-Þ][\w'’-]{1,30}){0,2})")
DOMAINS = frozenset("com org net edu gov info biz io co de fr es uk us eu it nl at ch be pl se ru cn jp br au ca in mx".split())
ANNOUNCE = {
    "email": "email e-mail mail contact write correo courriel".split(),
    "ip": "ip address host server client login".split(),
    "card": "card visa mastercard credit account iban karte carte tarjeta".split(),
    "phone": "phone tel telephone call mobile fax telefon téléphone teléfono cell".split(),
    "secret": "token key secret password passwd api auth bearer pwd credential".split(),
    "name": "name dear contact signed author von by from".split(),
}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The spans of the base rules, by start and then kind."""
    found = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            found.append((start, end, "email"))
        at = text.find("@", max(at + 1, end))
    found += [
        (m.start(), m.end(), "ip") for m in IP.finditer(text) if all(_small(p) for p in m[0].split("."))
    ]
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 14 and _is_card(match[0]):
            found.append((match.start(), match.end(), "card"))
    if "+" in text:
        found += [
            (m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15
        ]
    return sorted(found, key=lambda s: (s[0], BASE_KINDS.index(s[2])))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _is_card(text: str) -> bool:
    digits = [ord(c) - 48 for c in text if c.isdigit()]
    if not 14 <= len(digits) <= 19:
        return False
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans the broad patterns propose, apart from the base spans and one another."""
    found = []
    if "@" in text or "at)" in text or "at]" in text or "at}" in text:
        found += [(m.start(), m.end(), "email") for m in SPELLED.finditer(text)]
    for match in NUMBERS.finditer(text):
        digits = sum(map(str.isdigit, match[0]))
        kind = "card" if digits >= 13 else "phone"
        found.append((match.start(), match.end(), kind))
    found += [(m.start(), m.end(), "secret") for m in SECRET.finditer(text)]
    found += [(m.start(1), m.end(1), "name") for m in NAME.finditer(text)]
    out, taken = [], sorted((s, e) for s, e, _ in base)
    for start, end, kind in sorted(found):
        if all(end <= s or e <= start for s, e in _around(taken, start, end)):
            insort(taken, (start, end))
            out.append((start, end, kind))
    return out


def _around(taken: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    place = bisect_left(taken, (end, end))
    return taken[max(0, place - 8) : place]


def votes(text: str, start: int, end: int, kind: str) -> list[int]:
    """One vote per labeler: 1 for, 0 against, -1 for none."""
    value = text[start:end]
    before = text[max(0, start - NEAR) : start].lower()
    after = text[end : end + 1]
    digits = [c for c in value if c.isdigit()]
    strict = {
        "email": bool(re.fullmatch(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", value)),
        "card": bool(re.fullmatch(r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}", value)),
        "phone": bool(re.fullmatch(r"\(?\d{2,4}\)?[ .-]\d{3,4}[ .-]\d{3,6}", value)),
        "secret": bool(re.fullmatch(r"[0-9a-fA-F]{32,64}|[A-Za-z0-9_+/-]{32,128}={0,2}", value)),
        "name": " " in value,
    }[kind]
    checks = {
        "email": -1,
        "card": int(_is_card(value)),
        "phone": int(7 <= len(digits) <= 15 and len(set(digits)) > 2),
        "secret": int(_entropy(value) > 3.0),
        "name": int(not text[max(0, start - 1) : start].isalnum()),
    }[kind]
    gazetteer = {
        "email": int(value.rsplit(".", 1)[-1].strip(" )]}").lower() in DOMAINS),
        "card": int(value[:1] in "3456" or value[:2] == "22"),
        "phone": -1,
        "secret": -1,
        "name": 1,
    }[kind]
    words = set(re.findall(r"[\w-]+", before))
    if words.intersection(ANNOUNCE[kind]):
        context = 1
    elif after.isalnum() or any(words.intersection(w) for k, w in ANNOUNCE.items() if k != kind):
        context = 0
    else:
        context = -1
    return [int(strict), checks, gazetteer, context]


def _entropy(text: str) -> float:
    counts = [text.count(c) / len(text) for c in set(text)]
    return -sum(p * math.log2(p) for p in counts)


def features(text: str, start: int, end: int, kind: str) -> list[str]:
    value = text[start:end]
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"\d", "9", re.sub(r"[^\W\d_]", "a", value)))[:12]
    before = re.findall(r"[\w-]+|[^\w\s]", text[max(0, start - NEAR) : start].lower())
    last = before[-2:] if before else []
    hashed = [int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=2).digest()) % BUCKETS for w in last]
    return [
        f"shape {int.from_bytes(hashlib.blake2b(shape.encode('utf-8', 'replace'), digest_size=2).digest()) % BUCKETS}",
        f"length {min(len(value), 64) // 4}",
        f"edges {_class(text[start - 1 : start])} {_class(text[end : end + 1])}",
        *[f"word {i} {h}" for i, h in enumerate(hashed)],
        f"digits {sum(map(str.isdigit, value)) * 4 // max(1, len(value))}",
    ]


def _class(char: str) -> str:
    return "none" if not char else "digit" if char.isdigit() else "letter" if char.isalpha() else "blank" if char.isspace() else "mark"


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
CANDIDATE = pa.struct(
    [*SPAN, pa.field("votes", pa.list_(pa.int64())), pa.field("features", pa.list_(pa.string()))]
)
FOUND = (
    "doc_id long, base array<struct<start: long, end: long, kind: string>>, "
    "candidates array<struct<start: long, end: long, kind: string, votes: array<long>, features: array<string>>>"
)


def _find_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bases, proposed = [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            base = base_spans(text)
            bases.append([dict(zip(("start", "end", "kind"), s)) for s in base])
            proposed.append(
                [
                    {"start": s, "end": e, "kind": k, "votes": votes(text, s, e, k), "features": features(text, s, e, k)}
                    for s, e, k in candidates(text, base)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(bases, pa.list_(SPAN)), pa.array(proposed, pa.list_(CANDIDATE))],
            names=["doc_id", "base", "candidates"],
        )


def reliabilities(patterns: list[tuple[list[int], int]], rounds: int = EM_ROUNDS) -> dict[tuple[int, ...], float]:
    """Probability of being personal data per vote pattern, from counts of patterns.

    Starts from majority votes; each round estimates how often every labeler votes for
    true and for false candidates, and from that the candidates again. A labeler's vote
    is smoothed by one true and one false agreement."""
    if not patterns:
        return {}
    table = np.array([p for p, _ in patterns])
    counts = np.array([n for _, n in patterns], dtype=float)
    cast = (table >= 0).sum(axis=1)
    truth = np.where(cast > 0, (table == 1).sum(axis=1) / np.maximum(cast, 1), 0.5)
    for _ in range(rounds):
        share = (counts @ truth + 1) / (counts.sum() + 2)
        yes = np.log(share) + np.zeros(len(table))
        no = np.log(1 - share) + np.zeros(len(table))
        for j in range(table.shape[1]):
            given = table[:, j] >= 0
            right = (counts * truth * given) @ (table[:, j] == 1)
            wrong = (counts * (1 - truth) * given) @ (table[:, j] == 1)
            # A labeler agrees with the truth more often than not.
            hit = max(0.55, (right + 1.6) / ((counts * truth) @ given + 2))
            false = min(0.45, (wrong + 0.4) / ((counts * (1 - truth)) @ given + 2))
            yes += np.where(table[:, j] == 1, np.log(hit), np.where(given, np.log(1 - min(hit, 0.999)), 0))
            no += np.where(table[:, j] == 1, np.log(max(false, 1e-3)), np.where(given, np.log(1 - false), 0))
        truth = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
    return {tuple(p): float(t) for (p, _), t in zip(patterns, truth)}


def train(found: DataFrame) -> dict[str, dict[str, float]]:
    """The span classifier per kind: log-odds of its features, ``""`` for the prior."""
    spans = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.features")
    counted = spans.groupBy("kind", "votes").count().collect()
    chances = {}
    for kind in KINDS:
        own = sorted((tuple(r["votes"]), r["count"]) for r in counted if r["kind"] == kind)
        chances.update({(kind, *p): t for p, t in reliabilities([(list(p), n) for p, n in own]).items()})
    if not chances:
        return {}
    rows = [(k[0], list(k[1:]), t) for k, t in sorted(chances.items())]
    soft = found.sparkSession.createDataFrame(rows, "kind string, votes array<long>, truth double")
    # At most one row per kind and vote pattern, under a thousand.
    labelled = spans.join(F.broadcast(soft), ["kind", "votes"])
    weights = (
        labelled.select("kind", "truth", F.explode(F.concat("features", F.array(F.lit("")))).alias("feature"))
        .groupBy("kind", "feature")
        .agg(F.sum("truth").alias("yes"), F.sum(1 - F.col("truth")).alias("no"))
        .collect()
    )
    model: dict[str, dict[str, float]] = {}
    totals = {r["kind"]: (r["yes"], r["no"]) for r in weights if r["feature"] == ""}
    for r in weights:
        yes, no = totals[r["kind"]]
        odds = math.log((r["yes"] + 1) / (yes + 2)) - math.log((r["no"] + 1) / (no + 2))
        if r["feature"] == "":
            odds = math.log((yes + 1) / (no + 1))
        model.setdefault(r["kind"], {})[r["feature"]] = odds
    return model


def probability(model: dict[str, dict[str, float]], kind: str, found: list[str]) -> float:
    weights = model.get(kind)
    if not weights:
        return 0.0
    total = weights[""] + sum(weights.get(f, 0.0) for f in found)
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, total))))


def _digest(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def _decide_batches(
    batches: Iterator[pa.RecordBatch], model: dict[str, dict[str, float]], accept: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base_texts, all_texts = [], []
        for base, proposed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = [(s["start"], s["end"], s["kind"]) for s in base]
            added = [
                (c["start"], c["end"], c["kind"])
                for c in proposed
                if probability(model, c["kind"], c["features"]) >= accept
            ]
            base_texts.append(_digest(own))
            all_texts.append(_digest(own + added))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(base_texts, pa.string()), pa.array(all_texts, pa.string())],
            names=["doc_id", "base", "base_spans", "spans"],
        )


def find_personal_data(
    docs: DataFrame, accept: float = ACCEPT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, base, base_spans, spans)`` per row of ``docs``, repeated rows included.

    ``base`` lists the spans of the base rules, ``base_spans`` writes them as
    ``kind:start:end`` (code points, end exclusive) by start and kind, ``spans`` writes
    all, with the candidates whose probability is ``accept`` or more. A null or empty
    text has no spans; an empty table no rows. Other columns are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = materialise(arrow_map(rows, _find_batches, FOUND), "spans")
    model = train(found)
    return arrow_map(
        found,
        partial(_decide_batches, model=model, accept=accept),
        "doc_id long, base array<struct<start: long, end: long, kind: string>>, base_spans string, spans string",
    )
