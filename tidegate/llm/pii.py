"""Personal data by weak supervision.

Four base patterns (e-mail, IP address, card, phone) are always reported.  Looser patterns find further
candidate spans: masked e-mails and addresses, digit groups that could be a phone, card numbers with a wrong
checksum.  Labelers look
at every candidate, base spans included, and vote for, against or not at all: the strict pattern, a
validator (checksum, ranges), a gazetteer (top-level domains, card and country prefixes), the words before
the span and the characters around it.

Votes are counted over the whole table, and expectation-maximisation estimates from the counts how often
each labeler votes each way on true and on false spans, and so how likely each pattern of votes is true.  A
logistic span classifier is then trained on the span's features against these likelihoods, over the counts
of all candidates, and decides which candidates are added.  Counts have a row for each combination seen, of
which there are a bounded number, so nothing else reaches the driver.

Spans are code points, end exclusive.  NULL and empty texts have none.  Repeated rows are each searched.
A kind without candidates is left as its base.  An empty table gives no rows.  Texts of any length are
searched whole, in time that grows with their length.  Columns beside the two named are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import text_of
from tidegate.storage import stage

# Fixed values of the contract, in its order.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}

# An e-mail is looked for from its mark to both sides, as a search from the left reads a long run of letters once
# for each of them.  A run of digits can only match from its start, or not at all.
LOCAL = string.ascii_letters + string.digits + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")

MASK = re.compile(r"\x20?[\[({]at[\])}]\x20?", re.IGNORECASE)
MASKED_DOMAIN = re.compile(
    r"[A-Za-z0-9-]+(?:\x20?(?:\.|[\[({]dot[\])}])\x20?[A-Za-z0-9-]+)+", re.IGNORECASE
)
PHONE_SHAPE = re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}(?:[ .-][0-9]{3,4}){1,2}(?![0-9])")
MASKED_IP = re.compile(
    r"(?<![0-9])[0-9]{1,3}(?:\[\.\]|\(\.\))[0-9]{1,3}(?:\[\.\]|\(\.\))[0-9]{1,3}(?:\[\.\]|\(\.\))[0-9]{1,3}(?![0-9])"
)

# The gazetteers and cue words of the labelers.
DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu"}
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
CUES = {
    "email": ("mail", "contact", "write", "@"),
    "ip": ("ip", "server", "host", "address", "addr"),
    "card": ("card", "visa", "credit", "payment", "amex"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
}
LABELERS = ("pattern", "validator", "gazetteer", "context", "edges")
CUE_REACH = 24
THRESHOLD = 0.95


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c)
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def valid(kind: str, span: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in span.split("."))
    if kind == "card":
        digits = digits_of(span)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits_of(span)) <= 15
    return True


def marked_spans(text: str, marks: Iterable[tuple[int, int]], domain: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost spans of a local part, a mark (given from left to right) and a domain; each reads its surroundings once."""
    found, free = [], 0
    for start, end in marks:
        if start < free:
            continue
        first = free + len(text[free:start].rstrip(LOCAL))
        after = domain.match(text, end) if first < start else None
        if after:
            found.append((first, after.end()))
        free = after.end() if after else end
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, in order."""
    found = []
    if "@" in text:
        at = ((m.start(), m.end()) for m in re.finditer("@", text))
        found += [(start, 0, end) for start, end in marked_spans(text, at, DOMAIN)]
    digit = re.search("[0-9]", text) is not None
    for number, pattern in ((1, IP_RUNS), (2, BASE["card"]), (3, BASE["phone"])):
        if digit and (number != 3 or "+" in text):
            found += [(m.start(), number, m.end()) for m in pattern.finditer(text) if valid(KINDS[number], m[0])]
    return sorted(found)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """All candidates that are no base spans and overlap none: masked e-mails and addresses, numbers in groups that
    look like phones, and card shapes that fail the checksum."""
    masks = ((m.start(), m.end()) for m in MASK.finditer(text))
    found = [(start, 0, end) for start, end in marked_spans(text, masks, MASKED_DOMAIN)]
    found += [(m.start(), 1, m.end()) for m in MASKED_IP.finditer(text)]
    found += [(m.start(), 3, m.end()) for m in PHONE_SHAPE.finditer(text)]
    for m in BASE["card"].finditer(text):
        if 12 <= len(digits_of(m[0])) <= 19 and not valid("card", m[0]):
            found.append((m.start(), 2, m.end()))
    # Base spans in order, with the furthest end up to each: a candidate looks at those that start before its end.
    starts = [s for s, _, _ in base]
    ends = list(itertools.accumulate((e for _, _, e in base), max))
    free = []
    for start, number, end in sorted(found):
        before = bisect.bisect_left(starts, end)
        if not before or ends[before - 1] <= start:
            free.append((start, number, end))
    return free


def votes_of(text: str, start: int, number: int, end: int, is_base: bool) -> str:
    """One letter for each labeler: y for, n against, - none."""
    kind, span = KINDS[number], text[start:end]
    digits = digits_of(span)
    plain = re.sub(r"[\[\](){}]", "", span.lower())
    if kind == "email":
        checked = "y" if re.search(r"[a-z0-9](?:@|\x20?at\x20?)[a-z0-9]", plain) else "n"
        gazetteer = "y" if re.split(r"\.|dot", plain)[-1].strip() in DOMAINS else "n"
    elif kind == "ip":
        # Leading zeros, of which there may be thousands, don't count.
        parts = [int(p.lstrip("0")[:4] or 0) for p in re.findall(r"[0-9]+", span)]
        checked = "y" if len(parts) == 4 and max(parts) <= 255 else "n"
        gazetteer = "n" if parts[0] in (0, 127) or parts[0] > 223 else "-"
    elif kind == "card":
        checked = "y" if luhn(digits) else "n"
        gazetteer = "y" if digits.startswith(CARD_STARTS) else "n"
    else:
        checked = "y" if 9 <= len(digits) <= 15 else "n"
        gazetteer = "y" if span.startswith("+") else "-"
    before = text[max(0, start - CUE_REACH) : start].lower()
    cue = "y" if any(c in before for c in CUES[kind]) else "-"
    outside = text[start - 1 : start] + text[end : end + 1]
    edges = "n" if any(c.isalnum() for c in outside) else "-"
    return ("y" if is_base else "n") + checked + gazetteer + cue + edges


def features_of(text: str, start: int, number: int, end: int) -> str:
    """What the classifier sees of a span, as a short key of small categories."""
    span = text[start:end]
    n_digits = min(len(digits_of(span)), 20)
    marks = "".join(c for c in "+@([.- " if c in span)
    before = text[max(0, start - CUE_REACH) : start].lower()
    cue = int(any(c in before for c in CUES[KINDS[number]]))
    # Checksum or range, and prefix or ending, as the labelers see them.
    checked, known = votes_of(text, start, number, end, False)[1:3]
    return f"{n_digits}|{marks}|{cue}|{checked}|{known}"


def search(docs: DataFrame) -> DataFrame:
    """A row for each document: counts and digest of base spans, and all candidates with votes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, "
        "candidates array<struct<start:int,kind:int,end:int,base:boolean,votes:string,features:string>>"
    )

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                base = base_spans(text)
                spans = [(*s, True) for s in base] + [(*s, False) for s in loose_spans(text, base)]
                candidates = [
                    (s, k, e, b, votes_of(text, s, k, e, b), features_of(text, s, k, e)) for s, k, e, b in spans
                ]
                counts = [sum(k == n for _, k, _ in base) for n in range(4)]
                out.append((*counts, joined(base), [dict(zip(_NAMES, c)) for c in candidates]))
            frame = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "candidates"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return docs.select("doc_id", text_of().alias("text")).mapInPandas(searched, schema)


_NAMES = ("start", "kind", "end", "base", "votes", "features")


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def reliabilities(counts: pd.DataFrame, rounds: int = 100) -> np.ndarray:
    """The likelihood that each row of (votes, n) is true, by expectation-maximisation over two classes.

    A labeler's votes are independent given the class.  The first guess is the share of votes for.
    """
    letters = np.array([["yn-".index(c) for c in v] for v in counts["votes"]])
    n = counts["n"].to_numpy(float)
    ayes, noes = (letters == 0).sum(axis=1), (letters == 1).sum(axis=1)
    true = (ayes + 0.5) / (ayes + noes + 1)
    for _ in range(rounds):
        weights = np.stack([n * (1 - true), n * true])
        prior = (weights.sum(axis=1) + 1) / (n.sum() + 2)
        log = np.log(prior)[:, None] + np.zeros((2, len(n)))
        for j in range(letters.shape[1]):
            chance = np.stack([(weights * (letters[:, j] == v)).sum(axis=1) + 0.5 for v in range(3)], axis=1)
            chance /= chance.sum(axis=1, keepdims=True)
            log += np.log(chance)[:, letters[:, j]]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - true).max() < 1e-6:
            break
        true = new
    return true


def accepted(counts: pd.DataFrame, threshold: float = THRESHOLD) -> set[tuple[int, str]]:
    """(kind, features) that the trained classifier takes for personal data.

    ``counts`` has kind, votes, features and n.  Features are one-hot parts of the key.
    """
    out = set()
    for kind, rows in counts.groupby("kind"):
        rows = rows.sort_values(["features", "votes"]).reset_index(drop=True)
        true = reliabilities(rows.groupby("votes", as_index=False)["n"].sum())
        by_votes = dict(zip(sorted(rows["votes"].unique()), true))
        target = rows["votes"].map(by_votes).to_numpy()
        parts = [[f"{i}={p}" for i, p in enumerate(f.split("|"))] for f in rows["features"]]
        names = sorted({p for ps in parts for p in ps})
        x = np.array([[float(n in ps) for n in names] + [1.0] for ps in parts])
        weight = rows["n"].to_numpy(float) / rows["n"].sum()
        beta = np.zeros(x.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            slope = x.T @ (weight * (p - target)) + 1e-4 * beta
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
            step = np.linalg.solve(curve, slope)
            beta -= step
            if np.abs(step).max() < 1e-7:
                break
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        out |= {(int(kind), f) for f, one in zip(rows["features"], p) if one >= threshold}
    return out


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts and digest of the base spans, and ``spans``: these and the ones the classifier adds."""
    rows = stage(search(docs), "pii-spans").frame
    counts = (
        rows.select(F.explode("candidates").alias("c"))
        .groupBy("c.kind", "c.votes", "c.features")
        .agg(F.count(F.lit(1)).alias("n"))
        .toPandas()
    )
    taken = accepted(counts, threshold)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, spans = [], []
            for base, candidates in zip(batch["base"].to_pylist(), batch["candidates"].to_pylist()):
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                kept = [
                    (c["start"], c["kind"], c["end"])
                    for c in candidates
                    if c["base"] or (c["kind"], c["features"]) in taken
                ]
                spans.append(joined(sorted(set(kept))))
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone"]
            yield pa.RecordBatch.from_arrays(
                [*[batch[n] for n in names], pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=[*names, "base_sha256", "spans"],
            )

    return rows.mapInArrow(
        decided,
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )
