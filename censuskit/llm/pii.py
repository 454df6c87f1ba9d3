"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them.

1. Regular expressions propose spans in each whole text. Those that pass their kind's rule are
   base spans and stay; those that fail it are never given, but show what is no personal data.
   Kinds beyond the base ones are proposed too: masked addresses, account numbers, names after
   titles or given names, local telephone numbers, social security numbers.
2. Labelers (a strict form, a checksum, a gazetteer, words before, words after, borders, variety
   of digits) vote 1, -1 or 0 on each proposed span.
3. Of all spans, only how often each pattern of votes occurs leaves the tasks: at most
   3 ** 7 patterns and 4 lengths for each of 9 kinds, whatever the corpus.
   Expectation-maximisation over these counts estimates each labeler's reliability (the chance
   of each vote on personal data and on other text) and each kind's share, and so a probability
   for each pattern.
4. A logistic model over votes, kind and length learns these probabilities: the span
   classifier. It scores every span; spans of the further kinds with a score of at least
   ``threshold`` are added, unless they overlap a base span or a better added one.

Proposals and votes are written with one row per document, so that neither texts nor rows are
joined again; the last step reads that small table alone.

Defined results: null and empty texts have no spans. Rows that repeat, lack or share an id are
rows of their own. Texts are read whole, in time proportional to their length. Ties between
added spans go to the longer, then the earlier one. With no spans in the whole table, nothing
is learned and nothing is added. An empty table gives an empty result. Extra columns are never
read, unless ``with_text`` asks for the text back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from censuskit.llm.common import stash

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "email_masked", "iban", "name", "phone_local", "ssn"]
LABELERS = ["form", "checksum", "gazetteer", "before", "after", "borders", "variety"]
#: Code points of context on either side.
CONTEXT = 40
_LENGTHS = (12, 18, 26)

# Word lists of the gazetteer and context labelers.
TOP_LEVEL = set("com org net edu gov mil int io co info biz de fr es it nl be at ch uk ie us ca au nz jp cn in br mx pl se no fi dk pt gr cz ru eu".split())
CALLING = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
IBAN_COUNTRIES = set("AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM TR".split())
TITLES = "Mr. Mrs. Ms. Dr. Prof. Herr Frau Madame Monsieur Señor Señora".split()
GIVEN = "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Thomas Sarah Hans Peter Klaus Sabine Jean Pierre Marie Carlos Carmen Juan".split()
WORDS = {
    "email": "mail contact write reach address".split(), "email_masked": "mail contact write reach address".split(), "ip": "ip host server login address client".split(),
    "card": "card visa mastercard credit pay amex".split(), "phone": "phone tel call mobile fax contact".split(), "phone_local": "phone tel call mobile fax contact".split(),
    "iban": "iban account bank transfer konto".split(), "name": "name dear signed contact patient sincerely".split(), "ssn": "ssn social security".split(),
}
AGAINST = "version release build isbn issn order invoice serial chapter section sku ticket".split()

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a run of digits is tried from its first one only: from any other the same characters would follow
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"[\[({] ?(?:at|AT) ?[\])}]")
_HOST = re.compile(r" ?[A-Za-z0-9-]++(?:(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?)[A-Za-z0-9-]++)+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
_LOCAL_PHONE = re.compile(r"(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SURNAME = re.compile(r" [A-ZÀ-Þ][a-zß-ÿ]+(?: [A-ZÀ-Þ][a-zß-ÿ]+)?")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _octets(s: str) -> list[int]:
    """The parts of an address; 256 stands for all above 255, however long."""
    return [min(256, int(p)) if len(p := part.lstrip("0")) and len(p) <= 3 else 256 * bool(p) for part in s.split(".")]


def base_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """kind, start, end and whether the kind's rule holds, leftmost without overlaps per kind."""
    ended = 0
    for m in _DOMAIN.finditer(text):
        # the local part reaches back to the last match or @, and so each character is read once
        begin = max(ended, text.rfind("@", ended, m.start()) + 1)
        local = m.start() - begin - len(text[begin : m.start()].rstrip(_LOCAL))
        if local:
            yield "email", m.start() - local, m.end(), True
            ended = m.end()
    for m in _IP.finditer(text):
        yield "ip", m.start(), m.end(), max(_octets(m[0])) <= 255
    for m in _DIGITS.finditer(text):
        digits = _only_digits(m[0])
        yield "card", m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)
    for m in _PHONE.finditer(text):
        yield "phone", m.start(), m.end(), 8 <= len(_only_digits(m[0])) <= 15


def further_matches(text: str) -> Iterator[tuple[str, int, int]]:
    """kind, start and end of what may be personal data of the further kinds."""
    for m in _AT.finditer(text):
        before = text[max(0, m.start() - 65) : m.start()].removesuffix(" ")
        local = len(before) - len(before.rstrip(_LOCAL))
        if local and (host := _HOST.match(text, m.end())):
            yield "email_masked", m.start() - local - (text[m.start() - 1] == " "), host.end()
    for kind, form in (("iban", _IBAN), ("phone_local", _LOCAL_PHONE), ("ssn", _SSN)):
        for m in form.finditer(text):
            yield kind, m.start(), m.end()
    for words, kept in ((TITLES, False), (GIVEN, True)):
        for word in words:
            at = text.find(word)
            while at >= 0:
                end = at + len(word)
                if not (at and text[at - 1].isalnum()) and (m := _SURNAME.match(text, end)):
                    yield "name", at if kept else end + 1, m.end()
                at = text.find(word, end)


def _vote(yes: bool) -> int:
    return 1 if yes else -1


def _words(context: str, kind: str) -> int:
    found = set(re.findall(r"[a-z]+", context.lower()))
    return 1 if any(w.startswith(k) for w in found for k in WORDS[kind]) else -1 if found.intersection(AGAINST) else 0


def _iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(text: str, kind: str, start: int, end: int) -> list[int]:
    """What each labeler says of a span."""
    span, digits = text[start:end], _only_digits(text[start:end][:64])
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    form, checksum, known, variety = 0, 0, 0, 0
    if kind in ("email", "email_masked"):
        host = re.split(r"[.\x20\[\](){}]+", span.rpartition("@")[2] if kind == "email" else span)
        form = _vote(len(span) <= 254)
        checksum = _vote(all(len(label) <= 63 and label[:1] != "-" and label[-1:] != "-" for label in host))
        known = _vote(host[-1].lower() in TOP_LEVEL)
    elif kind == "ip":
        parts = _octets(span)
        form = _vote(not re.search(r"(?:^|\.)0[0-9]", span))
        checksum = _vote(max(parts) <= 255)
        known = _vote(1 <= parts[0] <= 223 and parts[0] not in (10, 127) and tuple(parts[:2]) != (192, 168))
    elif kind == "card":
        form = _vote(bool(re.fullmatch(r"[0-9]{16,19}|(?:[0-9]{4}[ -]){3}[0-9]{4}", span)))
        checksum = _vote(16 <= len(digits) <= 19 and luhn(digits))
        known = _vote(bool(re.match(r"4|5[1-5]|2[2-7]|3[47]|6011|65", digits)))
    elif kind in ("phone", "phone_local"):
        form = _vote(bool(re.fullmatch(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]+\)|[0-9]+)(?:[ .-][0-9]+)+|\+[0-9]{8,15}", span)) if kind == "phone" else "(" in span or span.count("-") == 2)
        checksum = _vote(8 <= len(digits) <= 15) if kind == "phone" else _vote(digits[0] not in "01" and digits[3] not in "01")
        known = _vote(any(digits[:k] in CALLING for k in (1, 2))) if kind == "phone" else 0
    elif kind == "iban":
        form, checksum, known = _vote(span.count(" ") in (0, len(span) // 5)), _vote(_iban_valid(span)), _vote(span[:2] in IBAN_COUNTRIES)
    elif kind == "ssn":
        form, checksum = 1, _vote(digits[3:5] != "00" and digits[5:] != "0000")
        known = _vote(digits[:3] not in ("000", "666") and digits[0] != "9")
    elif kind == "name":
        form = _vote(" " in span)
        known = _vote(span.split(" ")[0] in GIVEN) if before.strip() == "" or before.split()[-1] not in TITLES else 1
    if kind not in ("email", "email_masked", "name"):
        variety = _vote(len(set(digits)) > 2 and not digits.startswith(("12345678", "98765432")))
    glued = re.search(r"[\w@/._+-]$", before) or re.match(r"[\w@/]|[._-]\w", after)
    return [form, checksum, known, _words(before, kind), _words(after, kind), _vote(not glued), variety]


def _key(given: list[int], length: int) -> int:
    """Votes and a class of lengths as one number."""
    key = sum(length >= n for n in _LENGTHS)
    for v in given:
        key = key * 3 + v + 1
    return key


def _unpacked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes (rows by labelers) and classes of lengths of numbers made by _key."""
    given = np.stack([keys // 3 ** (len(LABELERS) - 1 - i) % 3 - 1 for i in range(len(LABELERS))], axis=1)
    return given, keys // 3 ** len(LABELERS)


_PROPOSED = "kind int, start int, stop int, key int, base boolean"


def proposals(text: str) -> list[tuple[int, int, int, int, bool]]:
    """Spans of a text with their votes (see _PROPOSED): base ones, failed ones of at least 12
    digits, and further ones that overlap no base span."""
    found, taken = [], []
    for kind, start, end, holds in base_matches(text):
        if holds or kind != "card" or end - start >= 12:
            found.append((kind, start, end, holds))
            if holds:
                taken.append((start, end))
    taken.sort()
    starts, ends = [a for a, _ in taken], list(np.maximum.accumulate([b for _, b in taken])) if taken else []
    for kind, start, end in set(further_matches(text)):
        at = int(np.searchsorted(starts, end)) if starts else 0
        if not at or ends[at - 1] <= start:
            found.append((kind, start, end, False))
    return sorted((KINDS.index(kind), start, end, _key(votes(text, kind, start, end), end - start), holds) for kind, start, end, holds in found)


def _struct_lists(rows: list[list[tuple]], kinds: list[tuple[str, pa.DataType]]) -> pa.Array:
    flat = [r for row in rows for r in row]
    values = pa.StructArray.from_arrays([pa.array([r[i] for r in flat], kind) for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), values)


def propose(docs: DataFrame, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its proposed spans, one row per document, written; with_text keeps the text."""
    kinds = [("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("key", pa.int32()), ("base", pa.bool_())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                spans = _struct_lists([proposals(t) if t else [] for t in part.column("text").to_pylist()], kinds)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), spans, *[part.column("text")] * with_text], ["doc_id", "found", *["text"] * with_text])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stash(rows.mapInArrow(work, f"doc_id long, found array<struct<{_PROPOSED.replace(' ', ':').replace(',:', ', ')}>>" + ", text string" * with_text), "pii-proposed")


def estimate(kind: np.ndarray, given: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation over patterns: for each the probability of personal data, the
    share of it in each kind, and each labeler's chance of a vote (-1, 0, 1) given other text
    and given personal data. One is added to each count, and majorities are the first guess."""
    truth = 1 / (1 + np.exp(-given.sum(axis=1, dtype=float)))
    chance = np.zeros((len(LABELERS), 3, 2))
    share = np.zeros(len(KINDS))
    for _ in range(rounds):
        weights = np.stack([counts * (1 - truth), counts * truth], axis=1)
        for i in range(len(LABELERS)):
            for v in range(3):
                chance[i, v] = (weights[given[:, i] == v - 1].sum(axis=0) + 1) / (weights.sum(axis=0) + 3)
        for k in range(len(KINDS)):
            share[k] = (weights[kind == k, 1].sum() + 1) / (counts[kind == k].sum() + 2)
        logs = np.log(np.stack([1 - share[kind], share[kind]], axis=1))
        for i in range(len(LABELERS)):
            logs += np.log(chance[i, given[:, i] + 1])
        before, truth = truth, 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if np.abs(truth - before).max(initial=0) < 1e-9:
            break
    return truth, share, chance


def features(kind: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Kind, votes for and votes against, and class of length, all as 0 or 1."""
    given, length = _unpacked(key)
    return np.concatenate([kind[:, None] == np.arange(len(KINDS)), given == 1, given == -1, length[:, None] == np.arange(len(_LENGTHS) + 1)], axis=1).astype(float)


def fit(x: np.ndarray, truth: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of the logistic model that is nearest to the probabilities, by Newton's steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (counts * p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (counts * (truth - p)) - ridge * w)
        w = w + step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(proposed: DataFrame) -> np.ndarray:
    """Weights of the span classifier, from all proposed spans of all documents."""
    rows = proposed.select(F.explode("found").alias("s")).groupBy("s.kind", "s.key").agg(F.count(F.lit(1)).alias("n")).collect()
    kind, key, counts = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    truth, _, _ = estimate(kind, _unpacked(key)[0], counts)
    return fit(features(kind, key), truth, counts)


def chosen(found: list[dict], scores: np.ndarray, threshold: float) -> list[tuple[str, int, int, float, bool]]:
    """Base spans, and further ones that reach the threshold, the best of those that overlap."""
    out = [(s["kind"], s["start"], s["stop"], p, True) for s, p in zip(found, scores, strict=True) if s["base"]]
    more = [(-p, s["start"] - s["stop"], s["start"], s) for s, p in zip(found, scores, strict=True) if s["kind"] >= len(BASE) and p >= threshold]
    held: list[tuple[int, int]] = []
    for p, _, start, s in sorted(more, key=lambda m: (*m[:3], m[3]["kind"])):
        at = int(np.searchsorted([a for a, _ in held], s["stop"])) if held else 0
        if not at or held[at - 1][1] <= start:
            held.insert(at, (start, s["stop"]))
            out.append((s["kind"], start, s["stop"], -p, False))
    return [(KINDS[k], *rest) for k, *rest in sorted(out)]


def find_personal_data(docs: DataFrame, threshold: float = 0.8, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and detections (kind, start, stop, score, base), by kind as in KINDS, then start, in
    code points, stop exclusive. with_text adds redacted: the text with [KIND] for each span."""
    proposed = propose(docs, with_text, id_col, text_col)
    weights = train(proposed)
    kinds = [("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())]

    def redacted(text: str | None, spans: list[tuple]) -> str | None:
        out, at = [], 0
        for kind, start, end, *_ in sorted(spans, key=lambda s: s[1]):
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return text if text is None else "".join([*out, text[at:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = part.column("found").to_pylist()
                flat = [s for row in found for s in row]
                scores = 1 / (1 + np.exp(-np.clip(features(*(np.array([s[c] for s in flat], np.int64) for c in ("kind", "key"))) @ weights, -30, 30)))
                ends = np.cumsum([len(row) for row in found])
                spans = [chosen(row, scores[e - len(row) : e], threshold) for row, e in zip(found, ends, strict=True)]
                texts = [pa.array([redacted(t, s) for t, s in zip(part.column("text").to_pylist(), spans, strict=True)], pa.string())] if with_text else []
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _struct_lists(spans, kinds), *texts], ["doc_id", "detections", *["redacted"] * with_text])

    return proposed.mapInArrow(work, "doc_id long, detections array<struct<kind:string, start:int, stop:int, score:double, base:boolean>>" + ", redacted string" * with_text)
