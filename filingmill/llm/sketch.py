"""Document fingerprints: bottom-k sketches of word-shingle hashes, in Spark expressions only.

A sketch is the sorted array of the k least distinct 64-bit hashes of a text's shingles. Sketches
merge by keeping the k least of their union; two of them estimate resemblance, containment and the
number of distinct shingles. Its text form is the hashes as 16 hex digits each, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingmill.llm.shared import possibly_in, staged

K = 256
WIDTH = 5
WHITE = r"[ \t\n\r\x0B\f]+"
#: Documents of one bucket of neighbours, and the most ranges of ids whose bounds the driver holds.
BUCKET_ROWS = 500
MOST_RANGES = 4_096


def _col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """Add the sketch of a text column as array<bigint>.

    Null and empty texts, and texts of white space, have an empty sketch; texts of fewer words than
    a shingle have one hash of all their words.
    """
    held = f"__{out}_words"
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), WHITE), lambda w: w != "")
    df = df.withColumn(held, F.transform(words, lambda w: F.xxhash64(w)))
    shingle = lambda i: F.xxhash64(*[F.get(F.col(held), i + j) for j in range(width)])
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(F.size(held) - width, F.lit(0))), shingle)
    least = F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)
    return df.withColumn(out, F.when(F.size(held) > 0, least).otherwise(F.array().cast("array<bigint>"))).drop(held)


def sketch_text(sketch: str | Column) -> Column:
    """The text form of a sketch."""
    return F.array_join(F.transform(_col(sketch), lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def merged(a: str | Column, b: str | Column, k: int = K) -> Column:
    """The sketch of the union of two sketches' shingles."""
    return F.slice(F.sort_array(F.array_union(_col(a), _col(b))), 1, k)


def resemblance(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; two empty sketches are alike."""
    both = merged(a, b, k)
    common = F.size(F.array_intersect(both, F.array_intersect(_col(a), _col(b))))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.greatest(F.size(both), F.lit(1)))


def distinct_shingles(sketch: str | Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    a = _col(sketch)
    span = (F.get(a, F.lit(k - 1)).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / span)


def containment(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Estimated share of a's distinct shingles that are in b; 1 for an empty a."""
    j, n, m = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(_col(a)) == 0, 1.0).otherwise(F.least(F.lit(1.0), j * (n + m) / (1 + j) / F.greatest(n, F.lit(1.0))))


def merged_by(df: DataFrame, keys: list[str], sketch: str, k: int = K, salts: int = 64) -> DataFrame:
    """(keys, sketch): the merged sketch of every group; hot groups are cut by salt first.

    Rows of null sketches count as empty ones; a group of empty sketches has an empty one.
    """
    groups = df.select(*keys).distinct()
    hashes = df.select(*keys, F.explode(sketch).alias("__h")).distinct()
    salted = Window.partitionBy(*keys, F.pmod("__h", F.lit(salts))).orderBy("__h")
    few = hashes.withColumn("__r", F.row_number().over(salted)).where(F.col("__r") <= k)
    few = few.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy("__h"))).where(F.col("__r") <= k)
    found = few.groupBy(*keys).agg(F.sort_array(F.collect_list("__h")).alias("__s"))
    on = groups.alias("g").join(found.alias("f"), [F.col(f"g.{c}").eqNullSafe(F.col(f"f.{c}")) for c in keys], "left")
    return on.select(*[F.col(f"g.{c}").alias(c) for c in keys], F.coalesce("__s", F.array().cast("array<bigint>")).alias(sketch))


def _range_of(id_: Column, bounds: list[int]) -> Column:
    """The number of bounds at or below an id, by binary search; -1 for a null id."""
    cuts = F.lit(bounds).cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        up = F.coalesce(F.get(cuts, mid) <= id_, F.lit(False)) & (s["lo"] < s["hi"])
        return F.struct(F.when(up, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(up, s["hi"]).otherwise(F.least(mid, s["hi"])).alias("hi"))

    steps = F.array(*[F.lit(0)] * (len(bounds).bit_length() + 1))
    return F.when(id_.isNull(), F.lit(-1)).otherwise(F.aggregate(steps, start, halve)["lo"])


def _bounds(rows: DataFrame, total: int) -> list[int]:
    """Bounds of at most ``MOST_RANGES`` ranges of about equal rows; an id with the rows of two is a range of its own."""
    n = min(MOST_RANGES, total // BUCKET_ROWS)
    if n < 2:
        return []
    found = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 4 * n)).alias("q")).first()["q"] or []
    hot = {a for a, b in zip(found, found[1:]) if a == b and a < (1 << 63) - 1}
    return sorted({*found, *(i + 1 for i in hot)})


def with_buckets(rows: DataFrame) -> DataFrame:
    """Add ``span`` and ``bucket`` to rows (doc_id, h): buckets of about ``BUCKET_ROWS`` rows, in order of doc_id, then h.

    Ids are cut into ranges at quantiles, and each range into as many buckets as its rows ask for, by
    place in the range, or by hash in a range of one id or of none. The driver holds a few numbers for
    each range.
    """
    rows = rows.withColumn("span", _range_of(F.col("doc_id"), _bounds(rows, rows.count())))
    stats = {r["span"]: r for r in rows.groupBy("span").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).collect()}
    many, low, wide, first, at = [], [], [], [], 0
    for span in range(-1, max(stats, default=-1) + 1):
        r = stats.get(span)
        n, lo, hi = (r["n"], r["lo"] or 0, r["hi"] or 0) if r else (0, 0, 0)
        many.append(max(1, -(-n // BUCKET_ROWS)))
        low.append(float(lo))
        wide.append(float(hi) - float(lo) + 1.0 if hi > lo else 0.0)
        first.append(at)
        at += many[-1]
    held = lambda values, kind: F.get(F.lit(values).cast(f"array<{kind}>"), F.col("span") + 1) if values else F.lit(0).cast(kind)
    share = F.when(held(wide, "double") > 0, (F.col("doc_id").cast("double") - held(low, "double")) / held(wide, "double")).otherwise(F.col("h").cast("double") / float(1 << 64) + 0.5)
    own = F.least(F.floor(share * held(many, "bigint")), held(many, "bigint") - 1)
    return rows.withColumn("bucket", held(first, "bigint") + F.greatest(own, F.lit(0)))


def with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(doc_id, text, h, bucket, copy) in descending order of doc_id; after the last comes the first.

    Rows go once to buckets of neighbours, and every bucket also gets a copy of the row that follows its
    last. Only the rows that are copied meet a join. Null texts are empty ones. Rows without a doc_id
    come last; equal ids are ordered by the texts' hashes; a single row is followed by itself; an empty
    table stays empty.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    spark = docs.sparkSession
    rows = with_buckets(rows)
    top = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")).alias("top")
    tops = staged(rows.groupBy("span", "bucket").agg(top), "tops")
    spans = sorted((r["span"], r["last"]["doc_id"], r["last"]["h"]) for r in tops.groupBy("span").agg(F.max_by("top", "bucket").alias("last")).collect())  # a row for each range
    before = [(span, *spans[i - 1][1:]) for i, (span, _, _) in enumerate(spans)]
    earlier = spark.createDataFrame(before, "span int, b_id bigint, b_h bigint")
    follower = F.lag(F.struct("top.doc_id", "top.h")).over(Window.partitionBy("span").orderBy("bucket"))
    ends = tops.withColumn("f", follower).join(F.broadcast(earlier), "span")
    ends = ends.select(F.col("bucket").alias("for_bucket"), F.when(F.col("f").isNull(), F.col("b_id")).otherwise(F.col("f.doc_id")).alias("f_id"), F.coalesce("f.h", "b_h").alias("f_h"))
    ends = staged(ends, "ends")
    likely = possibly_in(rows.select("doc_id", "text", "h"), F.xxhash64("doc_id", "h"), ends.select(F.xxhash64("f_id", "f_h").alias("h"))).where("__hit")
    copies = likely.join(ends, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("h") == F.col("f_h"))).dropDuplicates(["for_bucket"])
    copies = copies.select("doc_id", "text", "h", F.col("for_bucket").alias("bucket"), F.lit(True).alias("copy"))
    both = rows.select("doc_id", "text", "h", "bucket", F.lit(False).alias("copy")).unionByName(copies)
    return both.repartition(partitions, "bucket") if partitions else both.repartition("bucket")


def _follow() -> Window:
    return Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").desc_nulls_last(), F.col("h").desc())


def compared(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of ``docs``.

    The edited text has its last third of code points, rounded down, replaced by as many of the
    first of the next document's. Order, nulls and ties are those of ``with_next``.
    """
    rows = with_sketch(with_next(docs), "text", "own", k, width)
    w = _follow()
    rows = rows.withColumn("next_text", F.lead("text").over(w)).withColumn("next", F.lead("own").over(w)).where(~F.col("copy"))
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - third), F.substring("next_text", F.lit(1), third))
    rows = with_sketch(rows.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "own", "next", edited.alias("edited")), "edited", "changed", k, width)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch_text("own").alias("fingerprint"),
        sketch_text("changed").alias("edited_fingerprint"),
        resemblance("own", "changed", k).alias("near_edited"),
        resemblance("own", "next", k).alias("near_next"),
    )
