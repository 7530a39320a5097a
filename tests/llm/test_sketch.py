import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from filingmill.llm import sketch


def shingles(text):
    words = [w for w in __import__("re").split(r"[ \t\n\r\x0b\f]+", text or "") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


@pytest.mark.parametrize("bucket_rows", [1, 3, 500])
def test_contract(spark, edge_docs, no_docs, monkeypatch, bucket_rows):
    monkeypatch.setattr(sketch, "BUCKET_ROWS", bucket_rows)
    docs = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(docs.collect(), key=lambda r: -r["doc_id"])
    got = {r["doc_id"]: r for r in sketch.compared(docs).collect()}
    assert len(got) == len(rows)
    prints = {}
    for i, r in enumerate(rows):
        text, after = r["text"] or "", rows[(i + 1) % len(rows)]["text"] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + after[:m]
        g = got[r["doc_id"]]
        assert (g["n_chars"], g["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        few = len(shingles(text) | shingles(edited) | shingles(after)) <= sketch.K
        assert abs(g["near_edited"] - jaccard(shingles(text), shingles(edited))) < (1e-9 if few else 0.15)
        assert abs(g["near_next"] - jaccard(shingles(text), shingles(after))) < (1e-9 if few else 0.15)
        assert prints.setdefault(text, g["fingerprint"]) == g["fingerprint"]
    assert sketch.compared(no_docs).count() == 0


def test_repeated_and_null_ids_stay(edge_docs):
    assert sketch.compared(edge_docs).count() == 12


def test_one_row_is_its_own_next(spark):
    got = sketch.compared(spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")).first()
    assert got["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and got["near_next"] == 1.0


def test_merge_containment_and_counts(spark):
    text = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    df = spark.createDataFrame([("g", text(0, 3000)), ("g", text(1500, 4500)), ("h", ""), (None, text(0, 3))], "g string, text string")
    s = sketch.with_sketch(df, "text", "s")
    one = s.where("g = 'g'").agg(F.collect_list("s").alias("l")).select(
        sketch.resemblance(F.col("l")[0], F.col("l")[1]).alias("r"), sketch.containment(F.col("l")[0], F.col("l")[1]).alias("c"), sketch.distinct_shingles(F.col("l")[0]).alias("n"), sketch.merged(F.col("l")[0], F.col("l")[1]).alias("m")
    ).first()
    assert abs(one["r"] - 1 / 3) < 0.15 and abs(one["c"] - 0.5) < 0.2 and abs(one["n"] / 2996 - 1) < 0.3
    merged = {r["g"]: r["s"] for r in sketch.merged_by(s, ["g"], "s").collect()}
    assert merged["g"] == one["m"] and merged["h"] == [] and len(merged[None]) == 1


def test_neighbours_of_hot_and_missing_ids(spark, monkeypatch):
    """A third of the rows share an id and some have none: buckets stay small, and every row has its neighbour."""
    monkeypatch.setattr(sketch, "BUCKET_ROWS", 3)
    monkeypatch.setattr(sketch, "MOST_RANGES", 7)
    ids = [5] * 100 + [None] * 60 + [-(2**63), 2**63 - 1] + list(range(1000, 1140))
    rows = [(d, f"text {i} of number {d} " + "abc" * (i % 5)) for i, d in enumerate(ids)]
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - ((xxhash.xxh64_intdigest(t.encode(), 42) >> 63) << 64)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])), reverse=True)
    want = []
    for i, (d, text) in enumerate(order):
        m = len(text) // 3
        want.append((str(d), hashlib.sha256((text[: len(text) - m] + order[(i + 1) % len(order)][1][:m]).encode()).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in sketch.compared(docs).collect()) == sorted(want)
    sizes = [r["count"] for r in sketch.with_buckets(docs.withColumn("h", F.xxhash64("text"))).groupBy("bucket").count().collect()]
    assert max(sizes) <= 40 and len(sizes) > 60  # ids at both ends of the type stretch two ranges
