"""Personal data: base spans against plain regular expressions, the model against loops."""

import hashlib
import math
import random
import re
import time

import numpy as np

SCHEMA = "doc_id long, text string, found string, detections int, kind int, n_email string"

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    doubled = [int(c) * (1 + (k % 2)) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain(text):
    """The base spans, straight from the definition."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            holds = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(digits) <= 19 and plain_luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if holds:
                out.append((kind, m.start(), m.end()))
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in texts], SCHEMA)


TEXTS = [
    "mail ann.b+c@mail4.example.com or x@y.z@q.r.s, not @a.b or a@b or a@b..c; ip 1.2.3.4, 1.2.3.4.5.6.7.8, 256.1.1.1, 001.02.3.255, 1.2.3.9999999999999999999999",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4845168114407329 4845168114407329; call +1 (017) 555-7713, +49 30 1234567, +1, +12, +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "é🙂 n@h.io é 10.0.0.1", "+1 ((((", "", None, "a" * 50 + "@", "1" * 60, "...@...", "1.1.1.1.1.1.1", "+1 555 555 5555+1 555 555 5555",
]


def test_base_matches_against_plain_expressions():
    from censuskit.llm.pii import base_matches

    rng = random.Random(1)
    texts = [t or "" for t in TEXTS]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for alphabet in ("a@.-", "01.", "1234 -", "+12 ().-", "a1@.+ -", "9.25") for _ in range(1500)]
    for text in texts:
        assert [m[:3] for m in base_matches(text) if m[3]] == plain(text), text


def test_time_follows_length():
    from censuskit.llm.pii import proposals

    for piece in ("a", "1", "@", "a@", "1.", "+1", "(", "1 ", "AB12", "Dr. ", "1-", "[at]", "a [at] b"):
        began = time.time()
        proposals(piece * (200_000 // len(piece)))
        assert time.time() - began < 20, piece


def test_estimate_against_loops():
    from censuskit.llm.pii import KINDS, LABELERS, estimate

    rng = np.random.default_rng(3)
    truth = rng.random(400) < 0.6
    kind = rng.integers(0, 3, 400)
    right = [0.95, 0.9, 0.7, 0.6, 0.55, 0.8, 0.5]
    given = np.array([[0 if rng.random() < 0.2 else (1 if (rng.random() < r) == t else -1) for r in right] for t in truth])
    # span by span
    p = [1 / (1 + math.exp(-sum(g))) for g in given]
    for _ in range(30):
        chance = [[[(sum(1 - q if y == 0 else q for q, g in zip(p, given) if g[i] == v) + 1) / (sum(1 - q if y == 0 else q for q in p) + 3) for y in (0, 1)] for v in (-1, 0, 1)] for i in range(len(LABELERS))]
        share = [(sum(q for q, k in zip(p, kind) if k == s) + 1) / (sum(k == s for k in kind) + 2) for s in range(len(KINDS))]
        odds = [(share[k] * math.prod(chance[i][g[i] + 1][1] for i in range(7)), (1 - share[k]) * math.prod(chance[i][g[i] + 1][0] for i in range(7))) for k, g in zip(kind, given)]
        p = [a / (a + b) for a, b in odds]
    patterns, place, counts = np.unique(np.concatenate([kind[:, None], given], axis=1), axis=0, return_inverse=True, return_counts=True)
    got, shares, chances = estimate(patterns[:, 0], patterns[:, 1:], counts, rounds=30)
    assert np.allclose(got[place.ravel()], p, atol=1e-9) and np.allclose(shares, share) and np.allclose(chances, chance)
    assert ((got[place.ravel()] > 0.5) == truth).mean() > 0.9
    # better labelers are found to be so
    sure = [chances[i, 2, 1] / (chances[i, 2, 1] + chances[i, 0, 1]) for i in range(7)]
    assert sure[0] > sure[2] > sure[4]


def test_fit_is_at_the_optimum():
    from censuskit.llm.pii import fit

    rng = np.random.default_rng(4)
    x, p, n = (rng.random((60, 8)) < 0.4).astype(float), rng.random(60), rng.integers(1, 50, 60)
    w = fit(x, p, n)
    q = 1 / (1 + np.exp(-x @ w))
    assert np.abs(x.T @ (n * (p - q)) - w).max() < 1e-6


def test_query(spark, tmp_path):
    from censuskit.llm.queries import op11_personal_data

    rows = [*enumerate(TEXTS), (None, TEXTS[0]), (3, TEXTS[0]), (3, TEXTS[0]), (50, "text " * 100_000 + TEXTS[1])]
    frame(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(op11_personal_data(spark, str(tmp_path)).collect(), key=lambda r: (str(r.doc_id), r.base_sha256))
    want = []
    for i, t in rows:
        spans = plain(t or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((i, *[sum(s[0] == k for s in spans) for k in PLAIN], hashlib.sha256(joined.encode()).hexdigest(), joined))
    want.sort(key=lambda r: (str(r[0]), r[5]))
    assert [tuple(r)[:6] for r in got] == [w[:6] for w in want]
    for r, w in zip(got, want):
        assert set(filter(None, w[6].split(","))) <= set(r.spans.split(","))
    frame(spark, []).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert op11_personal_data(spark, str(tmp_path / "none")).count() == 0


def test_added_spans(spark):
    from censuskit.llm.pii import find_personal_data

    rng = random.Random(5)
    texts = []
    for i in range(300):
        filler = lambda: " ".join(rng.choice("lorem ipsum dolor sit amet".split()) for _ in range(12))
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        luhn = next(digits + c for c in "0123456789" if plain_luhn(digits + c))
        texts.append((i, f"{filler()} contact me by mail a{i}.b@host.com {filler()} phone +1 (212) 555-{1000 + i} or card 4{luhn[1:]} {filler()} host 8.8.{i % 256}.1"))
        texts.append((1000 + i, f"{filler()} order {digits[:13]}x version 999.{i}.400.1 serial {digits}7 {filler()} build +1 2 3"))
    texts += [(5000, "please write to bob.smith [at] mail (dot) example (dot) com today"), (5001, "signed, Dr. Elena Moreno and Maria"), (5002, "transfer to account DE89 3704 0044 0532 0130 00 now"), (5003, "call (415) 555-2671 now"), (5004, "nothing at all [at] here"), (5005, "his ssn is 078-05-1120."), (5006, None)]
    got = {r.doc_id: r for r in find_personal_data(frame(spark, texts), with_text=True).collect()}
    added = {i: [(s.kind, dict(texts)[i][s.start : s.stop]) for s in r.detections if not s.base] for i, r in got.items()}
    assert added[5000] == [("email_masked", "bob.smith [at] mail (dot) example (dot) com")]
    assert added[5001] == [("name", "Elena Moreno")]
    assert added[5002] == [("iban", "DE89 3704 0044 0532 0130 00")] and added[5003] == [("phone_local", "(415) 555-2671")] and added[5005] == [("ssn", "078-05-1120")]
    assert all(not a for i, a in added.items() if i < 5000 or i in (5004, 5006))
    assert got[5003].redacted == "call [PHONE_LOCAL] now" and got[5006].redacted is None
    assert all(0 <= s.score <= 1 for r in got.values() for s in r.detections)
