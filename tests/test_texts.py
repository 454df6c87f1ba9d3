"""Keyword tables and merged phrases against plain loops."""

import random
import re

from pyspark.sql import functions as F

from censuskit.functions import keywords as kw, notes


def plain_counts(text, phrases, cues, window):
    """Every place of every phrase, one by one."""
    low, out = (text or "").lower(), {}
    word = lambda c: bool(re.fullmatch("[A-Za-z0-9_]", c))
    for phrase, label in set(phrases):
        at = low.find(phrase)
        while at >= 0:
            end = at + len(phrase)
            inside = (at and word(low[at - 1]) and word(low[at])) or (end < len(low) and word(low[end]) and word(low[end - 1]))
            before = re.search(rf"((?:[a-z0-9_]+ +){{0,{window}}})$", low[:at], re.A)[1].split()[-window:]
            if not inside and not set(before) & set(cues):
                out[label] = out.get(label, 0) + 1
            at = low.find(phrase, at + 1)
    return out


def test_keyword_counts(spark):
    """Thousands of phrases, some inside others, against a search for each."""
    rng = random.Random(4)
    words = ["no", "not", "by", "a", "ab", "abc", "pain", "chest", "fall", "no_fall", "é", "x1"]
    phrases = sorted({(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))), f"l{rng.randrange(9)}") for _ in range(6000)})
    assert len(phrases) > 3000
    texts = [" ".join(rng.choice([*words, "pain,", "fall.", "NO", "  ", "Chest"]) for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None, "", "no pain", "no no pain", "not a chest pain", "nota pain"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("counts_0", F.lit(1)).withColumn("low_0", F.lit(2)).repartition(3)
    table = spark.createDataFrame([*phrases, ("", "l0"), (None, "l1"), ("pain", None)], "phrase string, label string")
    for window in (1, 3):
        got = {r.id: r.counts for r in kw.keyword_counts(df.select("id", "text"), "text", table, window=window).collect()}
        assert got == {i: plain_counts(t, phrases, kw.NEGATIONS, window) for i, t in enumerate(texts)}


def test_many_automata(spark, monkeypatch):
    monkeypatch.setattr(kw, "MOST", 2)
    df = spark.createDataFrame([(1, "a b c a b")], "id long, text string")
    table = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("a b", "y"), ("b c", "y"), ("q", "z")], "phrase string, label string")
    assert kw.keyword_counts(df, "text", table).first().counts == {"x": 4, "y": 4}
    assert kw.keyword_counts(df, "text", table.limit(0)).first().counts == {}


def test_merge_pairs(spark):
    rng = random.Random(2)
    pairs = [("a", "b"), ("b", "c"), ("a", "a"), ("c", "d")]
    rows = [(i, [rng.choice("abcde") for _ in range(rng.choice([0, 1, 2, 5, 40, 300]))]) for i in range(80)] + [(100, None), (101, ["a"] * 7)]
    got = {r.id: r.ws for r in notes.merge_pairs(spark.createDataFrame(rows, "id long, ws array<string>"), "id", "ws", spark.createDataFrame(pairs, "a string, b string")).collect()}
    for i, ws in rows:
        out, at = [], 0
        while ws and at < len(ws):
            if at + 1 < len(ws) and (ws[at], ws[at + 1]) in pairs:
                out.append(f"{ws[at]}_{ws[at + 1]}")
                at += 2
            else:
                out.append(ws[at])
                at += 1
        assert got[i] == (None if ws is None else out)


def test_clean_tokens_against_a_plain_filter(spark):
    stop = ["the", "and", "for"]
    rows = ["The cat (and dogs) sat", "ab abc abc1 1abc a1bc the1 thes the for-and", "", None, "[x\ny] naïve Straße (open", "İstanbul the\tand  theand", "fort for  1 and2 foré"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    bare = F.regexp_replace(F.regexp_replace(F.lower("text"), r"\[[^\]]*\]|\([^)]*\)", " "), "[^a-z0-9 ]+", " ")
    plain = F.filter(F.split(bare, " "), lambda w: (F.length(w) > 2) & ~w.rlike("[0-9]") & ~w.isin(*stop))
    for r in df.select(notes.clean_tokens(F.col("text"), stop).alias("a"), plain.alias("b")).collect():
        assert r.a == r.b
