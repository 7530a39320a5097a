"""The keyword index against the compiled rules."""

import random

from pyspark.sql import functions as F

from filingmill.operators import classify, keywords
from filingmill.plans.queries import pack
from filingmill.sources import rulepack
from filingmill.sources.rulepack import Role


def both(spark, rows, packs):
    df = spark.createDataFrame(rows, "id int, market string, t string")
    names = ["id", "table_role", "statement_scope", "classification_confidence", "classification_rule_id", "requires_review"]
    return [sorted((tuple(r) for r in classify.classified(df, packs, F.col("t"), indexed=how).select(*names).collect()), key=str) for how in (None, ["id"])]


def test_shipped_packs(spark):
    packs = rulepack.load_all()
    draw, texts = random.Random(3), [None, "", "x"]
    words = [w for p in packs.values() for r in p.roles for k in ("include", "prefer", "exclude") for w in getattr(r, k)]
    texts += [" ".join(draw.choice([str.upper, str])(w) for w in draw.sample(words, draw.randint(1, 4))) for _ in range(80)]
    compiled, indexed = both(spark, [(i, ["us", "hk", "a_share", "other", None][i % 5], t) for i, t in enumerate(texts)], packs)
    assert compiled == indexed and len({r[1] for r in compiled}) > 2


def test_short_keywords_windows_and_ties(spark, monkeypatch):
    monkeypatch.setattr(keywords, "WINDOW", 5)
    roles = (Role("first", include=("a", "long keyword here"), exclude=("no",)), Role("second", prefer=("bc", "end."), include=("a",)), Role("third", prefer=("bc",)))
    texts = ["a", "bc", "a no", "xx long keyword here xx", "the end.", "no bc", "", "zzz", "lon", "%_\\ a"]
    compiled, indexed = both(spark, [(i, "m", t) for i, t in enumerate(texts)], {"m": pack("m", roles)})
    assert compiled == indexed


def test_five_thousand_keywords(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefg") for _ in range(draw.randint(3, 9)))
    held = sorted({word() for _ in range(6000)})[:5000]
    texts = [" ".join(word() for _ in range(60)) for _ in range(40)] + [None]
    df = spark.createDataFrame([(i, "m", t) for i, t in enumerate(texts)], "id int, market string, text string")
    got = keywords.keyword_hits(df, spark.createDataFrame([("m", k) for k in held] + [("m", ""), ("other", "abc"), ("m", None)], "market string, keyword string"), ["id"])
    assert sorted((r["id"], r["keyword"]) for r in got.collect()) == sorted((i, k) for i, t in enumerate(texts) for k in held if t and k in t)


def test_hits_are_found_where_the_texts_lie(spark, monkeypatch):
    """Neither grams nor matches are shuffled; blocks of keywords, bytes of several characters and windows lose none."""
    held = ["consolidated balance", "consolidated balances", "lidated ba", "\u8d44\u4ea7\u8d1f\u503a\u8868", "\u8d44\u4ea7", "\u8868", "a\nb", "e", "ee", "balance sheet x"]
    texts = ["the consolidated balances", "\u5408\u5e76\u8d44\u4ea7\u8d1f\u503a\u8868", "a\nb", "", None, "eee" * 40 + "balance sheet x"]
    df = spark.createDataFrame([(i, ["m", "n", None][k], t) for i, t in enumerate(texts) for k in range(3)], "id int, market string, text string")
    words = spark.createDataFrame([(m, k) for k in held for m in ("m", "n") if (m, k) != ("n", "e")] * 2, "market string, keyword string")
    expected = sorted((i, m, k) for i, t in enumerate(texts) for m in ("m", "n") for k in held if t and k in t and (m, k) != ("n", "e"))
    for block, window in ((1 << 22, 1 << 17), (40, 9)):
        monkeypatch.setattr(keywords, "BLOCK_BYTES", block, raising=False)
        monkeypatch.setattr(keywords, "WINDOW", window)
        got = keywords.keyword_hits(df, words, ["id"])
        assert sorted((r["id"], r["market"], r["keyword"]) for r in got.collect()) == expected
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_indexed_classes_shuffle_no_text(spark):
    df = spark.createDataFrame([(1, "m", "the end.")], "id int, market string, t string")
    got = classify.classified(df, {"m": pack("m", (Role("r", include=("end",)),))}, F.col("t"), indexed=["id"])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString() and got.first()["table_role"] == "r"


def test_only_the_widths_of_the_keywords_are_made():
    text = "a资bc\x00\xff xyz".encode()
    for widths in ([], [3], [1, 2, 8], [8, 40]):
        made = {w: codes.tolist() for w, codes in keywords._codes(text, widths)}
        assert made == {w: [int.from_bytes(text[i : i + w], "big") for i in range(len(text) - w + 1)] for w in widths if w <= len(text)}
    assert list(keywords._codes(b"", [1])) == []
