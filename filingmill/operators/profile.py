"""Page and report profiles from page texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.functions.exprs import contains_any, or_null, strip

# Keywords by market, and those of any other market.
STATEMENT_KEYWORDS = {
    "a_share": ("资产负债表", "利润表", "现金流量表", "合并"),
    "hk": ("consolidated", "statement of financial position", "statement of profit or loss", "statement of cash flows", "綜合"),
    "us": ("consolidated", "balance sheets", "statements of operations", "statements of cash flows"),
}
DEFAULT_KEYWORDS = ("资产负债表", "利润表", "现金流量表", "consolidated", "balance sheet", "statement of financial position", "statement of cash flows")
SAMPLE_CHARS = 1000


def density(n: Column, width: Column, height: Column) -> Column:
    """Characters by area; null without a positive area."""
    return F.when(width * height > 0, n / (width * height))


def has_keywords(text: str, market: str, keywords: dict = STATEMENT_KEYWORDS, default: tuple = DEFAULT_KEYWORDS) -> Column:
    """Whether the text, as it is, holds a keyword of its market."""
    out = contains_any(F.lower(F.col(text)), default)
    for m, own in keywords.items():
        out = F.when(F.col(market) == m, contains_any(F.lower(F.col(text)), own)).otherwise(out)
    return out


def page_profiles(pages: DataFrame, text: str = "text", market: str = "market", keywords: dict = STATEMENT_KEYWORDS, default: tuple = DEFAULT_KEYWORDS) -> DataFrame:
    """Add the profile columns to rows with a text, width, height and market."""
    stripped = strip(F.coalesce(F.col(text), F.lit("")))
    n = F.length(stripped)
    return pages.withColumns(
        {
            "text_char_count": n,
            "text_density": density(n, F.col("width"), F.col("height")),
            "has_statement_keywords": has_keywords(text, market, keywords, default),
            "page_text_sample": or_null(F.substring(stripped, 1, SAMPLE_CHARS)),
        }
    )


def report_profiles(profiles: DataFrame, key: str = "report_id") -> DataFrame:
    """(key, page_count, keyword_page_count, is_text_pdf, unsupported_reason) by report."""
    out = profiles.groupBy(key).agg(
        F.count("*").alias("page_count"), F.count_if("has_statement_keywords").alias("keyword_page_count"), F.bool_or(F.col("text_char_count") > 0).alias("is_text_pdf")
    )
    return out.withColumn("unsupported_reason", F.when(~F.col("is_text_pdf"), F.lit("no_text_layer")))


def with_profile(reports: DataFrame, summary: DataFrame) -> DataFrame:
    """Reports with the profile columns laid over their own; reports without pages have none of either."""
    new = summary.select("report_id", *[F.col(c).alias(f"__{c}") for c in ("page_count", "is_text_pdf", "unsupported_reason")])
    out = reports.join(new, "report_id", "left")
    out = out.withColumn("unsupported_reason", F.when(F.col("__is_text_pdf").isNotNull(), F.col("__unsupported_reason")).otherwise(F.col("unsupported_reason")))
    for c in ("page_count", "is_text_pdf"):
        out = out.withColumn(c, F.coalesce(f"__{c}", c))
    return out.select(*reports.columns)
