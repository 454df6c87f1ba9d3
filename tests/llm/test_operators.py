"""Each operator against a brute-force version or a round trip, and on awkward rows."""

import base64
import collections
import hashlib
import math
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, hits int"
LONG = "\n".join(f"line {i} of a long text about nothing in particular" for i in range(3000))
BASE = "the quick brown fox jumps over the lazy dog and runs far away from the old stone house near the river bank today"


def frame(spark, texts):
    """Documents with extra columns whose names clash with those of the operators."""
    rows = [(i, t, "en" if k % 2 else None, None if (i or 0) % 5 == 4 else f"s{(i or 0) % 3}", None, 1.0, "x", 2) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


AWKWARD = [
    (0, BASE), (1, None), (2, ""), (3, "   \n\t"), (4, BASE + " "), (5, BASE.replace(" ", "\n")), (6, LONG), (7, "a"), (8, BASE + " indeed"), (9, BASE + " indeed"),
    (10, "Licensed under the Apache License, Version 2.0. CC  BY, MIT\nlicense"), (11, "ÄÖ ß 漢字 🙂 naïve"), (12, LONG + "\nmore"), (12, LONG + "\nmore"), (13, "one two three"), (None, BASE),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, AWKWARD).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_exact_dedup(awkward, empty):
    from censuskit.llm.exact_dedup import exact_dedup

    got = exact_dedup(awkward, block_bytes=64)
    rows = got.collect()
    assert len(rows) == len(AWKWARD)
    groups = collections.defaultdict(list)
    for i, t in AWKWARD:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    found = collections.defaultdict(list)
    for r in rows:
        found[r.text_sha256].append(r)
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), math.inf if m[0] is None else m[0]))[0]
        mine = found[hashlib.sha256(norm.encode()).hexdigest()]
        assert len(mine) == len(members)
        assert all(r.group_size == len(members) and r.keep_id == keep for r in mine)
        # one row stays, also where rows repeat
        assert [r.doc_id for r in mine if r.kept] == [keep]
    assert exact_dedup(empty).count() == 0


def test_exact_dedup_keeps_one_row(spark):
    from censuskit.llm.exact_dedup import exact_dedup

    docs = frame(spark, [(5, "x y"), (5, "xy"), (None, "a b"), (None, "ab"), (7, "q"), (7, "q")]).withColumn("no", F.monotonically_increasing_id())
    rows = exact_dedup(docs, key_col="no").filter("kept").join(docs.select("no", "text"), F.col("key") == F.col("no"))
    assert sorted(r.text for r in rows.collect()) == ["a b", "q", "x y"]


def test_mixing(spark, awkward, empty):
    from censuskit.llm.mixing import mix_sources, placed_documents, schedule

    for docs, texts in ((awkward, AWKWARD), (frame(spark, [(i, "w " * (i * 37 % 200)) for i in range(300)]), None)):
        rows = mix_sources(docs, block_words=16).collect()
        sizes, weights, targets = collections.Counter(), {}, {}
        for r, src in zip(sorted(docs.collect(), key=lambda r: str(r.doc_id)), sorted(rows, key=lambda r: str(r.doc_id))):
            sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        total, capped = sum(sizes.values()), set()
        while True:
            rest, free = total - sum(3 * sizes[s] for s in capped), sum(weights[s] for s in names if s not in capped)
            targets = {s: 3 * sizes[s] if s in capped else rest * weights[s] / free for s in names}
            over = {s for s in names if targets[s] > 3 * sizes[s]}
            if not over:
                break
            capped |= over
        source = {r.doc_id: r.source for r in docs.collect()}
        taken = collections.Counter()
        for r in rows:
            assert r.target == pytest.approx(targets[source[r.doc_id]])
            assert r.source_size == sizes[source[r.doc_id]] and 0 <= r.taken <= 3 * r.size
            taken[source[r.doc_id]] += r.taken
        # a slot more or less, of total / 65536 words
        slack = 1 + total / 65536 if (total := sum(sizes.values())) else 0
        assert all(abs(taken[s] - targets[s]) <= slack for s in names)
    assert mix_sources(empty).count() == 0
    # every stretch of the schedule is close to the targets
    placed, t = placed_documents(docs)
    slots = [r.s for r in schedule(t, 4096).orderBy("position").collect()]
    assert len(slots) == 4096
    share = collections.Counter(slots)
    for s, n in share.items():
        half = slots[: len(slots) // 2].count(s)
        assert abs(half - n / 2) <= 6
    # the sequence decides what is taken, and where
    first, again, other = ({r.doc_id: (r.taken, r.first_slot) for r in mix_sources(docs, point=p).collect()} for p in (None, None, F.lit(0.1)))
    assert first == again and sum(first[i][0] != other[i][0] for i in first) > 50


def test_mixing_targets_of_many_sources(spark):
    from censuskit.llm.mixing import source_targets

    rng = random.Random(5)
    sizes = {f"h{i:05}": rng.choice([0, 1, 10, 1000, 50_000]) for i in range(9000)}
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).orderBy("s").collect()
    assert [r.source for r in rows] == sorted(sizes) and [r.s for r in rows] == list(range(9000))
    weights = [(5, 2, 1)[i % 3] for i in range(9000)]
    level = max(r.target / w for r, w in zip(rows, weights))
    assert sum(r.target for r in rows) == pytest.approx(sum(sizes.values()))
    assert all(r.target == pytest.approx(min(3 * sizes[r.source], level * w)) for r, w in zip(rows, weights))


def test_bpe(awkward, empty):
    import public_tokenizers
    import tiktoken

    from censuskit.llm.bpe import PrefixEncoder, Vocabulary, encode_documents

    v = Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    t = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    rows = encode_documents(awkward).collect()
    texts = dict(AWKWARD)
    for r in rows:
        ids = t.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert encode_documents(empty).count() == 0
    rng = random.Random(4)
    for _ in range(40):
        b = bytes(rng.choice(b"aab \xc3\xa9the") for _ in range(rng.randint(1, 400)))
        p = PrefixEncoder(v, b[: len(b) // 2]).append(b[len(b) // 2 :])
        assert p.tokens() == t._encode_single_piece(b)
        i = rng.randint(0, len(b))
        j = rng.randint(i, min(len(b), i + 9))
        assert p.edited(i, j, b"zz").tokens() == t._encode_single_piece(b[:i] + b"zz" + b[j:])


def test_ngram_components(spark, awkward, empty):
    from censuskit.llm.ngram_join import ngram_components

    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    texts = list(AWKWARD[:12])
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        for k in range(6):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append((100 + g * 10 + k, "  ".join(copy).upper() if k % 2 else " ".join(copy)))
    for n, share in ((4, 85), (5, 80)):
        sets = {}
        for i, t in texts:
            w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
            sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        parent = {i: i for i in sets}

        def root(x, parent=parent):
            return x if parent[x] == x else root(parent[x])

        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
        got = by_id(ngram_components(frame(spark, texts).repartition(3), n, share))
        assert {i: (len(s), root(i)) for i, s in sets.items()} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}
    rows = ngram_components(awkward).collect()
    assert len(rows) == len(AWKWARD) and {r.component_id for r in rows if r.doc_id is None} == {0}
    assert ngram_components(empty).count() == 0


@pytest.mark.parametrize(("n", "share"), [(4, 85), (5, 80)])
def test_ngram_components_of_all_small_sizes(spark, n, share):
    """Pairs of 1 to 60 words and one more, one word less in the middle or one exchanged at the
    end, some with others that hold a few of their n-grams: no link is lost, none made up."""
    from censuskit.llm.ngram_join import ngram_components

    rng = random.Random(n)
    word = lambda: f"w{rng.randrange(10**9)}"
    texts, groups = [], []
    for k in range(1, 61):
        for turn in range(100):
            a = [word() for _ in range(k)]
            b = [a + [word()], a[: k // 2] + a[k // 2 + 1 :], a[:-1] + [word()], a[1:]][turn % 4]
            some = [a, b]
            if turn % 5 == 0 and k > n:
                at = rng.randrange(k - n)
                some += [[word() for _ in range(k)] + a[at : at + n], a[at : at + n] + [word() for _ in range(2 * k)]]
            groups.append(range(len(texts), len(texts) + len(some)))
            texts += some
    sets = [{tuple(t[i : i + n]) for i in range(len(t) - n + 1)} if len(t) >= n else {tuple(t)} - {()} for t in texts]
    want = {}
    for group in groups:
        root = {i: i for i in group}
        for a in group:
            for b in group:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                    low, high = sorted((root[a], root[b]))
                    root = {i: low if r == high else r for i, r in root.items()}
        want |= root
    got = by_id(ngram_components(frame(spark, [(i, " ".join(t)) for i, t in enumerate(texts)]).repartition(4), n, share))
    assert {i: (len(s), want[i]) for i, s in enumerate(sets)} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}


def test_ngram_components_just_below_the_threshold(spark):
    """Many near copies around the threshold, on both sides of it, and a passage that most texts hold."""
    from censuskit.llm.ngram_join import ngram_components

    rng = random.Random(9)
    words = [f"v{i}" for i in range(5000)]
    passage, texts = rng.sample(words, 60), []
    for g in range(4):
        base = rng.sample(words, 70)
        for k in range(60):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append((1000 * g + k, " ".join((passage if k % 2 else []) + copy + rng.sample(words, rng.randint(0, 6)))))
    texts += [(9000 + k, " ".join(passage + rng.sample(words, rng.randint(5, 16)))) for k in range(80)]
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, w in ((i, t.split(" ")) for i, t in texts)}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = by_id(ngram_components(frame(spark, texts).repartition(3)))
    assert {i: root(i) for i in sets} == {i: r.component_id for i, r in got.items()}
    assert 20 < len({root(i) for i in sets}) < len(sets) - 50


@pytest.mark.parametrize("order", [2, 3])
def test_katz(awkward, empty, spark, order):
    from censuskit.llm.common import crc_mod
    from censuskit.llm.katz import K, discounts, score_documents

    docs = awkward.unionByName(frame(spark, [(i, " ".join(random.Random(i % 40).choices("abcdefgh", k=30))) for i in range(20, 120)]))
    held = crc_mod("doc_id", 5) == 1
    rows, model = score_documents(docs, held, batch_bytes=2000, part_bytes=3000, order=order)
    rows, t = rows.collect(), model.totals
    assert t.parts > 3
    texts = [(r.doc_id, r.held, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) + ["$"]) for r in docs.withColumn("held", held).collect()]
    grams = collections.defaultdict(collections.Counter)  # by context, of up to order - 1 words
    for _, h, w in texts:
        if not h:
            padded = ["^", *w]
            for i in range(1, len(padded)):
                for k in range(order):
                    if i - k >= 0:
                        grams[tuple(padded[i - k : i])][padded[i]] += 1
    c, starts = grams[()], sum(not h for _, h, _ in texts)
    total = sum(c.values())
    for n in range(1, order + 1):
        counts = collections.Counter(x for u, ws in grams.items() if len(u) == n - 1 for x in ws.values())
        assert t.d[n] == pytest.approx(discounts(counts))
        if n > 1:
            assert collections.Counter(r.c for r in model.grams(n).collect()) == counts
    assert {r.word: r.c for r in model.words.collect()} == {w: n for w, n in c.items() if w != "$"} and c["$"] == starts

    def p(u, w):
        """By the definition, for any context."""
        if not u:
            return t.d[1].get(c[w], 1.0) * c[w] * t.word_keep / total if c[w] else t.unknown
        after = grams.get(u)
        if not after:
            return p(u[1:], w)
        n = sum(after.values())
        keep = n / (n + 1) if min(after.values()) > K else 1.0
        seen = {x: keep * t.d[len(u) + 1].get(k, 1.0) * k / n for x, k in after.items()}
        if w in seen:
            return seen[w]
        return (1 - sum(seen.values())) / (1 - sum(p(u[1:], x) for x in seen)) * p(u[1:], w)

    # exactly normalised over the vocabulary and the unknown word
    for u in random.Random(1).sample(sorted(grams), 12):
        assert sum(p(u, w) for w in [*c, "not a word"]) == pytest.approx(1)
    want = collections.Counter()
    for i, h, w in texts:
        padded, known = ["^", *w], {}
        s = 0.0
        for k in range(1, len(padded)):
            at = tuple(padded[max(0, k - order + 1) : k]), padded[k]
            known[at] = known.get(at) or math.log10(p(*at))
            s += known[at]
        base = sum(math.log10((c[x] + 0.5) / (total + 0.5 * (len(c) + 1))) for x in w)
        want[(i, h, len(w), sum(c[x] > 0 for x in w), total, round(base, 5), round(s, 5))] += 1
    assert want == collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in rows)
    assert score_documents(empty, held, order=order)[0].count() == 0
    nothing, _ = score_documents(docs, F.lit(True), batch_bytes=2000, order=order)
    assert {(r.n_known, r.base_score, r.score) for r in nothing.collect()} == {(0, 0.0, 0.0)}
    assert all(0 < d < 1 for n in ({}, {1: 5, 2: 1}, {1: 3}, {2: 4}) for d in discounts(n).values())


def test_katz_query_uses_pairs_seen_once(spark, tmp_path):
    from zlib import crc32

    from censuskit.llm.common import crc_mod
    from censuskit.llm.katz import score_documents
    from censuskit.llm.queries import op2_katz_backoff

    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    ids = [i for i in range(400) if crc32(str(i).encode()) % 5 != 1][:60]
    a, b = [i for i in range(400) if crc32(str(i).encode()) % 5 == 1][:2]
    passages = [rng.sample(words, 40) for _ in ids]
    other = sorted(passages[0])
    # half of the texts occur twice, so that the discount of pairs seen once is one that prose has
    train = [(i, p) for i, p in zip(ids, passages)] + list(zip(ids[30:], passages[30:]))
    docs = frame(spark, [*[(i, " ".join(p)) for i, p in train], (a, " ".join(passages[0])), (b, " ".join(other))])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    score = {r.doc_id: r.score for r in op2_katz_backoff(spark, str(tmp_path)).collect()}
    # the same words: only the pairs of one training text tell them apart
    assert score[a] > score[b] + 10
    model = score_documents(docs, crc_mod("doc_id", 5) == 1)[1]
    pairs = collections.Counter(x for _, p in train for x in zip(["^", *p], [*p, "$"]))
    assert collections.Counter(r.c for r in model.pairs.collect()) == collections.Counter(pairs.values()) and model.totals.pair_d[1] > 0


def test_licenses(awkward, empty, spark):
    from censuskit.llm.licenses import BASE as PHRASES, rules, scan_licenses

    assert len(rules()) > 300
    text = dict(AWKWARD)
    for r in scan_licenses(awkward).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text[r.doc_id] or ""))
        at = [(i, label) for ph, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(ph.split())] == ph.split()]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})))
        assert 0 <= r.score <= 1
    cases = {
        "released under the GNU Lesser General Public License, version 2.1 or later": "lgpl-2.1",
        "SPDX-License-Identifier: Apache-2.0 is not a name we know, Apache License 2.0 is": "apache,apache-2.0",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0": "cc-by-nc-sa-4.0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
        "nothing of the kind": "",
    }
    docs = frame(spark, list(enumerate(cases)))
    assert [r.labels for r in scan_licenses(docs).orderBy("doc_id").collect()] == list(cases.values())
    # a contained detection is suppressed
    one = scan_licenses(frame(spark, [(1, "licensed under the apache license, version 2.0")])).first()
    assert [d.label for d in one.detections] == ["apache-2.0"]
    assert scan_licenses(empty).count() == 0


def test_licenses_in_wrapped_and_short_forms(spark):
    from censuskit.llm.licenses import SPDX, scan_licenses

    cases = {
        "Copyright 2020. All rights\n * reserved.": "proprietary",
        "released into the public\n# domain": "public-domain",
        "Creative\n// Commons Attribution 4.0": "cc-by-4.0",
        "this is CC\n * Zero": "cc0",
        "Permission to use, copy, modify, and/or distribute this software": "isc",
        "Permission\n# to use, copy, modify, and\n# distribute this software": "isc",
        "under the zlib/libpng license": "zlib",
        "MPL 2.0": "mpl-2.0",
        "licensed under the EPL": "epl",
        "dual: OSL version 3.0": "osl-3.0",
        "AFL v2.1": "afl-2.1",
        "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause": "apache-2.0,bsd-3-clause,mit",
        "licensed under MIT": "mit",
        "see Apache-2.0 for it": "apache-2.0",
        "a simple example, deplorable and the oslo flat": "",
        "they commit or emit": "",
    }
    cases |= {f"// SPDX-License-Identifier: {name.upper()}{end}\nint main()": label for label, name in SPDX for end in ("", "-or-later")}
    got = [r.labels for r in scan_licenses(frame(spark, list(enumerate(cases)))).orderBy("doc_id").collect()]
    # the loose scan names "cc by" without a version as well
    assert [(c, ",".join(x for x in g.split(",") if x != "cc-by" or label == x)) for c, g, label in zip(cases, got, cases.values())] == list(cases.items())


def test_license_suppression_against_brute_force(spark):
    from censuskit.llm.licenses import FOUND, scan_licenses, unsuppressed

    rng = random.Random(11)
    rows = []
    for k in range(60):
        seen = {}
        for _ in range(rng.randint(0, 40)):
            a = rng.randint(0, 30)
            seen[rng.randint(0, 12), a, a + rng.randint(1, 12)] = None
        rows.append((k, [(o, f"l{o}", 0.5, a, b) for o, a, b in seen]))
    got = spark.createDataFrame(rows, f"k int, found {FOUND}").select("k", unsuppressed(F.col("found")).alias("d")).collect()
    for k, d in got:
        found = rows[k][1]
        want = {f for f in found if not any(o[3] <= f[3] and o[4] >= f[4] and (o[4] - o[3] > f[4] - f[3] or o[0] < f[0]) for o in found)}
        assert {tuple(x) for x in d} == want
    many = frame(spark, [(1, "licensed under the apache license, version 2.0. " * 4000)])
    assert len(scan_licenses(many).first().detections) == 4000
    at = {"see http://www.apache.org/licenses/LICENSE-2.0 for": "apache-2.0", "https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa-4.0", "https://opensource.org/licenses/MIT": "mit", "<https://www.gnu.org/licenses/>": "", "http://www.boost.org/LICENSE_1_0.txt": "boost-1.0"}
    assert [r.labels for r in scan_licenses(frame(spark, list(enumerate(at)))).orderBy("doc_id").collect()] == list(at.values())


def test_iblt(awkward, empty, spark):
    from censuskit.llm.iblt import compare, fingerprint_documents

    rows = fingerprint_documents(awkward).collect()
    assert len(rows) == len(AWKWARD)
    order = sorted(AWKWARD, key=lambda x: -1 if x[0] is None else x[0], reverse=True)
    lines = lambda t: {x for x in t.split("\n") if x.strip(" ")}
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    want = collections.Counter()
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        want[(i, len(t), hashlib.sha256(e.encode()).hexdigest(), round(like(lines(t), lines(e)), 9), round(like(lines(t), lines(nxt)), 9))] += 1
    assert want == collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows)
    # many rows without an id follow in an order of their own, whatever the ranges
    loose = frame(spark, [(None, f"text {i}\nline {i % 3}") for i in range(50)] + [(i, f"t {i}") for i in range(5)])
    chain = fingerprint_documents(loose)
    assert chain.count() == 55 and chain.select("edited_sha256").distinct().count() > 45
    same = {r.fingerprint for r in rows if r.doc_id in (8, 9)}
    assert len(same) == 1
    assert fingerprint_documents(empty).count() == 0
    # the digests themselves are recovered, with retries for the large difference
    pairs = spark.createDataFrame([(1, list(range(1000)), list(range(500, 1400))), (2, [5], [5]), (3, [], [7])], "k long, a array<long>, b array<long>")
    got = {r.k: (sorted(r.only_a), sorted(r.only_b)) for r in compare(pairs, ["k"]).collect()}
    assert got == {1: (list(range(500)), list(range(1000, 1400))), 2: ([], []), 3: ([], [7])}


def test_warc_zip(spark, tmp_path):
    import io
    import zipfile

    from censuskit.llm.common import stash
    from censuskit.llm.warc_zip import ZipDirectory, archive_files, read_archives, write_archives

    pages = [(i, None if i % 7 == 0 else f"http://h/{i}", [None, "", "<p>same</p>", f"<p>{i} é</p>", "x" * 5000][i % 5]) for i in range(60)] + [(3, "http://h/3", "<p>3 é</p>"), (None, "u", "<p>no id</p>"), (None, "v", "<p>same</p>"), (None, "w", "<p>no id</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload_bytes", F.lit(1))
    archives = stash(write_archives(df, archive_bytes=20_000, member_bytes=6_000), "test-warc")
    rows = read_archives(archives, with_payload=True).collect()
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    assert len(rows) == len(pages)
    want = collections.Counter()
    for i, u, h in pages:
        b, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and f != i
        want[(i, u, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", f if revisit else None, None if revisit else b)] += 1
    assert want == collections.Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in rows)
    # the files are ordinary ZIP files, and ordinary ones are read; compressed members are refused
    one = archives.first()
    content = open(one.archive.removeprefix("file://"), "rb").read()
    assert archives.count() > 1 and zipfile.ZipFile(io.BytesIO(content)).testzip() is None
    (tmp_path / "a.zip").write_bytes(content)
    assert read_archives(archive_files(spark, str(tmp_path))).count() == len([r for r in rows if r.archive == one.archive])
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m", "a" * 1000)
    data = packed.getvalue()
    d = ZipDirectory(lambda o, n: data[o : o + n], len(data))
    with pytest.raises(ValueError, match="compressed"):
        d.place("m")
    assert read_archives(write_archives(df.limit(0))).count() == 0
    small = write_archives(df, min_revisit_bytes=20)
    assert {r.record_type for r in read_archives(small).filter("payload_bytes < 20").collect()} == {"response"}


def test_zip64_directory():
    import struct

    from censuskit.llm.warc_zip import ZipDirectory

    body = b"hello"
    local = b"PK\x03\x04" + bytes(22) + struct.pack("<HH", 1, 0) + b"m" + body
    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    entry = b"PK\x01\x02" + bytes(6) + struct.pack("<H", 0) + bytes(8) + struct.pack("<II", 0xFFFFFFFF, 0xFFFFFFFF) + struct.pack("<HHH", 1, len(extra), 0) + bytes(8) + struct.pack("<I", 0xFFFFFFFF) + b"m" + extra
    end64 = b"PK\x06\x06" + struct.pack("<Q", 44) + bytes(20) + struct.pack("<QQQ", 1, len(entry), len(local))
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(local) + len(entry), 1)
    end = b"PK\x05\x06" + bytes(4) + struct.pack("<HHIIH", 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = local + entry + end64 + locator + end
    d = ZipDirectory(lambda o, n: data[o : o + n], len(data))
    assert d.range("m", 1, 3) == b"ell"
    with pytest.raises(ValueError, match="beyond"):
        d.range("m", 3, 3)


def test_zip64_archive_beyond_four_gigabytes(spark, tmp_path):
    """A sparse file whose index and last record lie past 4 GB is read by range."""
    import gzip
    import zipfile

    from censuskit.llm.warc_zip import read_archives, warc_record

    path, record = tmp_path / "big.zip", gzip.compress(warc_record(1 << 60, "u", b"hello", "D", None))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("first", b"x")
        z.fp.seek((4 << 30) + 10_000)  # a hole
        z.start_dir = z.fp.tell()
        z.writestr("archive/part-000.warc.gz", record)
        z.writestr("indexes/index.cdx", f"archive/part-000.warc.gz 0 {len(record)}")
    rows = read_archives(spark.createDataFrame([(f"file://{path}",)], "archive string"), with_payload=True).collect()
    assert [(r.page_id, bytes(r.payload), r.record_offset) for r in rows] == [(1 << 60, b"hello", 0)]


def test_toxicity(spark, awkward, empty):
    from censuskit.llm.toxicity import CharModel, evidence_of, restore, train, words_of

    m = CharModel({"idiot": 50, "the": 900, "clown": 40, "moron": 30, "hello": 80, "pathetic": 12, "stupid": 20})
    assert [restore(w, m) for w in ("1d10t", "idiooot", "cl0wn", "m0r0n", "p@thetic", "$tupid", "helllo")] == ["idiot", "idiot", "clown", "moron", "pathetic", "stupid", "hello"]
    assert "idiot" in words_of("oh i d i o t !!", m, {}) and "idiot" in words_of("you 1d10t!!", m, {})
    rng = random.Random(3)
    plain = lambda: " ".join(rng.choices(["good", "day", "river", "stone", "house", "tree", "walk"], k=20))
    rows = [(i, plain() + (" " + rng.choice(["idiot", "moron"]) if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    test = frame(spark, [(1, plain() + " 1d10t"), (2, plain()), (3, plain() + " m o r o n"), (4, None), (5, "")])
    score = {r.doc_id: r.score for r in evidence_of(test, model).collect()}
    assert score[1] > 0.5 and score[3] > 0.5 and max(score[2], score[4], score[5]) < 0.5
    got = evidence_of(awkward, model, (F.col("label"),))
    assert got.count() == len(AWKWARD) and evidence_of(empty, model).count() == 0
    none = train(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    assert {r.score for r in evidence_of(test, none).collect()} == {0.5}


def test_toxicity_on_held_out_rows(spark):
    from censuskit.llm.queries import op6_toxicity

    d = "/root/testdata/sf0.1"
    both = op6_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out")
    r = both.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int")).alias("right"), F.sum(F.col("toxic") * F.col("predicted")).alias("tp"), F.sum("predicted").alias("p"), F.sum("toxic").alias("t")).first()
    assert r.right > 0.97 and r.tp / r.p > 0.9 and r.tp / r.t > 0.85


def test_toxicity_readings(spark):
    from censuskit.llm.toxicity import CharModel, restore, words_of

    m = CharModel({"idiot": 50, "the": 900, "clown": 40, "moron": 30, "hello": 80, "pathetic": 12, "stupid": 20, "rat": 30})
    for text, word in {
        "!diot": "idiot", "|diot": "idiot", "<lown": "clown", "(idiot)": "idiot", "idiot!!": "idiot", "1 d 1 0 t": "idiot", "i  d  i  o  t": "idiot", "i\td\ti\to\tt": "idiot",
        "iiddiioott": "idiot", "ra+": "rat", "! d ! 0 t": "idiot", "id" + "i" * 60 + "ot": "idiot",
    }.items():
        assert word in words_of(f"you {text} there", m, {}), text
    assert words_of("the committee said hello!", m, {}) == {"the", "committee", "said", "hello"}
    # brute force over all letters for all places: the cheapest path is found
    import itertools

    from censuskit.llm.toxicity import LOOKS_LIKE, SWAP_COST

    for observed in ("1d10t", "cl0wn", "r4t", "m0r0n", "8|0"):
        options = [LOOKS_LIKE.get(c, c) for c in observed]
        price = lambda w: sum(m.cost(("^^" + w)[i : i + 2], (w + "$")[i]) for i in range(len(w) + 1)) + SWAP_COST * sum(c in LOOKS_LIKE for c in observed)
        best = min(itertools.product(*options), key=lambda w: price("".join(w)))
        assert price(restore(observed, m)) == pytest.approx(price("".join(best)))
    long = "".join(random.Random(1).choices("ab01", k=100_000))
    assert len(restore(long, m)) > 50_000


def test_ids_are_exact_beside_nulls(spark, tmp_path):
    from censuskit.llm.bpe import encode_documents
    from censuskit.llm.katz import score_documents
    from censuskit.llm.language_id import identify
    from censuskit.llm.ngram_join import ngram_components
    from censuskit.llm.toxicity import ToxicModel, evidence_of
    from censuskit.llm.warc_zip import read_archives, write_archives

    big = (1 << 53) + 1
    docs = frame(spark, [(big, BASE), (None, "other words in here"), (big + 2, BASE)]).coalesce(1)
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    warc = read_archives(write_archives(pages)).collect()
    assert {(r.page_id, r.refers_to) for r in warc} == {(big, None), (None, None), (big + 2, big)}
    near = ngram_components(docs).collect()
    assert {(r.doc_id, r.component_id) for r in near} == {(big, big), (None, None), (big + 2, big)}
    for out in (encode_documents(docs), score_documents(docs, F.lit(False))[0], identify(docs, [("a", b"abcdefgh" * 4)]), evidence_of(docs, ToxicModel(None, {}, 1.0, 0.0))):
        assert {r.doc_id for r in out.collect()} == {big, None, big + 2}


def test_language_id_against_brute_force(spark):
    import zstandard

    from censuskit.llm.language_id import MIN_MATCH, STRATEGY, identify

    rng = random.Random(3)
    dictionaries = [(f"x{i}", "".join(rng.choices("abcdefgh"[i:] + "  ", k=4000)).encode()) for i in range(3)]
    dictionaries.append(("twin", dictionaries[2][1]))
    texts = ["".join(rng.choices("abcdefgh"[i % 3 :] + " ", k=rng.choice([5, 60, 900, 9000]))) for i in range(40)]
    odd = ["²", "½ ¹ 7", "Ⅷ", "\u0300", "12 34", "", None]
    got = by_id(identify(frame(spark, list(enumerate(texts + odd))), dictionaries))
    for i, t in enumerate(texts):
        sizes = []
        for _, data in dictionaries:
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(3, source_size=4096, dict_size=len(data), min_match=MIN_MATCH, strategy=STRATEGY)
            sizes.append(sum(len(zstandard.ZstdCompressor(compression_params=how, dict_data=d).compress(t[k : k + 4096].encode())) for k in range(0, len(t), 4096)))
        # ties go to the first: never to the twin
        assert got[i].lang_pred == dictionaries[sizes.index(min(sizes))][0] != "twin"
    assert {got[len(texts) + i].lang_pred for i in range(len(odd))} == {"und"}


def test_language_id(spark, awkward, empty):
    from censuskit.llm.language_id import identify, train_dictionaries
    from censuskit.llm.queries import op8_language_id

    d = "/root/testdata/sf0.01"
    got = op8_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    dictionaries = train_dictionaries(spark.read.parquet(f"{d}/documents.parquet"))
    rows = identify(awkward, dictionaries).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3}
    assert all(0 <= r.score <= 1 for r in rows) and identify(empty, dictionaries).count() == 0
    assert train_dictionaries(empty) == [] and {r.lang_pred for r in identify(awkward, []).collect()} == {"und"}


def test_language_dictionaries_come_from_all_over_the_texts(spark):
    from censuskit.llm.language_id import identify, train_dictionaries

    rng = random.Random(12)
    header = "this notice and the terms that follow apply to every copy of the text below " * 10
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(200)] for lang, letters in (("xa", "abcdefghi"), ("xb", "klmnopqrs"))}
    text = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(i, header + text(lang, 400), lang) for i in range(600) for lang in (("xa", "xb")[i % 2],)], schema)
    dictionaries = train_dictionaries(docs)
    assert all(60_000 < len(data) <= 65_536 and data.count(b"this notice") * 40 < len(data) / 20 for _, data in dictionaries)
    got = by_id(identify(spark.createDataFrame([(1, text("xa", 60), None), (2, text("xb", 60), None)], schema), dictionaries))
    assert (got[1].lang_pred, got[2].lang_pred) == ("xa", "xb") and not got[1].rejected and not got[2].rejected
    # no language is left out
    many = spark.createDataFrame([(i, f"words of language {i}", f"l{i:03}") for i in range(520)], schema)
    assert len(train_dictionaries(many)) == 520


def test_brief_deletes_its_tables_but_keeps_results(spark):
    from censuskit.llm.common import brief, stash

    with brief(spark) as keep:
        first = stash(spark.range(10), "brief-first")
        with brief(spark) as keep_inner:
            second = stash(first.filter("id > 3"), "brief-second")
            third = keep_inner(second.filter("id > 5"), "brief-third")
        folder = Path(second.inputFiles()[0].removeprefix("file://")).parent
        assert not folder.exists()
        last = keep(third.join(first, "id"), "brief-last")
    assert not Path(third.inputFiles()[0].removeprefix("file://")).parent.exists()
    assert sorted(r.id for r in last.collect()) == [6, 7, 8, 9]


def test_languages_with_hardly_any_text_have_a_dictionary(spark):
    from censuskit.llm.language_id import identify, train_dictionaries

    rows = [(i, "en", "the quick brown fox jumps over the lazy dog " * 3) for i in range(4)] + [(10, "xx", "ñ"), (11, "yy", "  "), (12, "zz", "")]
    learned = train_dictionaries(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert [lang for lang, _ in learned] == ["en", "xx", "yy"] and all(len(data) >= 8 for _, data in learned)
    got = {r.doc_id: r.lang_pred for r in identify(spark.createDataFrame([(1, "ñ ñ ñ ñ"), (2, "the lazy dog jumps over the quick brown fox")], "doc_id long, text string"), learned).collect()}
    assert got[2] == "en"


def test_mixing_deals_out_rows_without_an_id(spark):
    from censuskit.llm.mixing import mix_sources, placed_documents

    docs = frame(spark, [(None if i % 2 else 7, f"w{i} " * (5 + i % 7)) for i in range(400)]).withColumn("source", F.lit("s"))
    placed, _ = placed_documents(docs)
    starts = [r.start for r in placed.collect()]
    assert len(set(starts)) == len(starts) == 400
    rows = mix_sources(docs).collect()
    assert sum(r.taken for r in rows) == pytest.approx(rows[0].target, abs=2)
