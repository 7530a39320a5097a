"""Facts: labelled amounts with concept, unit, parsed value and lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingmill.functions.exprs import MONEY, first_match, label, or_null, parse_decimal, stable_id
from filingmill.functions.periods import period
from filingmill.operators.rawtables import last_cells
from filingmill.sources.rulepack import RulePack

BALANCE_SHEET = "statement.balance_sheet"
STATEMENTS = (BALANCE_SHEET, "statement.income_statement", "statement.cash_flow")
UNIT_CONFIDENCE = 0.99
AUTO_CONFIDENCE = 0.95
#: Pieces of aliases, at most some 20 MB, that may be sent to every task.
SENT_PIECES = 200_000


def units(context: Column, packs: dict[str, RulePack], market: str = "market", longest: bool = False) -> Column:
    """struct(currency, scale_factor, raw_unit, unit_confidence) from the text around a table.

    Patterns are plain substrings, tried in file order; with ``longest`` the longest one in the text
    decides instead.
    """
    text = F.lower(F.coalesce(context, F.lit("")))
    none = F.struct(*[F.lit(None).cast("string").alias(n) for n in ("currency", "currency_pattern", "scale", "scale_pattern")])
    found = none
    for m, pack in packs.items():
        currency, cp = first_match(text, pack.currencies, longest)
        scale, sp = first_match(text, pack.scales, longest)
        own = F.struct(currency.cast("string").alias("currency"), cp.cast("string").alias("currency_pattern"), scale.cast("string").alias("scale"), sp.cast("string").alias("scale_pattern"))
        found = F.when(F.col(market) == m, own).otherwise(found)
    c, s = found["currency_pattern"], found["scale_pattern"]
    held = F.contains(F.lower(s), F.lower(c))
    return F.struct(
        found["currency"].alias("currency"),
        found["scale"].try_cast(MONEY).alias("scale_factor"),
        F.when(F.coalesce(held, F.lit(False)), s).otherwise(or_null(F.concat_ws(" ", c, s))).alias("raw_unit"),
        F.when(c.isNotNull() & s.isNotNull(), F.lit(UNIT_CONFIDENCE)).otherwise(F.lit(0.0)).alias("unit_confidence"),
    )


def unit_context() -> Column:
    return F.concat_ws("\n", F.col("page_text_sample"), F.col("raw_table_text"))


def nearest_unit(levels: Sequence[str]) -> tuple[Column, Column]:
    """The unit of the first level that has one, and whether a later level disagrees with it."""
    chosen = F.coalesce(*levels)
    conflict = F.lit(False)
    for level in levels:
        conflict = conflict | F.coalesce(F.col(level) != chosen, F.lit(False))
    return chosen, conflict


def concepts(rows: DataFrame, aliases: DataFrame, raw_label: str = "raw_label", market: str = "market") -> DataFrame:
    """Rows whose normalised label is an alias of their market, with the concept; others are dropped.

    The join carries no hint: the planner sends the alias table to every task only if its size is below its own threshold.
    """
    keyed = rows.withColumn("__label", label(raw_label))
    right = aliases.withColumnRenamed("market", "__market")
    out = keyed.join(right, (F.col("__label") == F.col("alias")) & (F.col(market) == F.col("__market")))
    return out.drop("__label", "__market", "alias")


def candidates(rows: DataFrame, aliases: DataFrame, raw_label: str, most: int = 2, market: str = "market") -> DataFrame:
    """Unmatched labels with the aliases within ``most`` edits, for review only.

    The label is cut into ``most + 1`` pieces; an alias within that many edits holds one of them
    unchanged, so candidates come from an equality join on pieces before the distance is checked.
    A label of fewer characters has the empty piece, which every alias holds. The pieces of aliases are
    sent to every task if there are at most ``SENT_PIECES`` of them, else they are shuffled.
    """
    n = most + 1

    def pieces(text: Column) -> Column:
        at = lambda i: F.floor(F.length(text) * i / n).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.lit(most)), lambda i: F.substring(text, at(i) + 1, at(i + 1) - at(i)))
        return F.when(F.length(text) < n, F.array(F.lit(""))).otherwise(cut)

    own = rows.select(label(raw_label).alias("__label"), F.col(market).alias("__m")).distinct()
    own = own.where(F.length("__label") > 0).select("__label", "__m", F.explode(pieces(F.col("__label"))).alias("piece"))
    grams = aliases.select("*", F.explode(F.sequence(F.lit(1), F.length("alias"))).alias("at"))
    sized = grams.select("*", F.explode(F.sequence(F.lit(1), F.length("alias") - F.col("at") + 1)).alias("size"))
    sized = sized.select("market", "alias", "normalized_concept_id", F.substring(F.col("alias"), F.col("at"), F.col("size")).alias("piece"))
    sized = sized.unionByName(aliases.select("market", "alias", "normalized_concept_id", F.lit("").alias("piece"))).distinct()
    n_pieces = aliases.agg(F.sum(F.length("alias") * (F.length("alias") + 1) / 2 + 1).alias("n")).first()["n"] or 0
    sized = F.broadcast(sized) if n_pieces <= SENT_PIECES else sized.hint("shuffle_hash")
    met = own.join(sized, (own["__m"] == sized["market"]) & (own["piece"] == sized["piece"])).select("__m", "__label", "alias", "normalized_concept_id").distinct()
    met = met.withColumn("edits", F.levenshtein("__label", "alias")).where((F.col("edits") > 0) & (F.col("edits") <= most))
    return met.select(F.col("__m").alias("market"), F.col("__label").alias("label"), "alias", "normalized_concept_id", "edits", F.lit(True).alias("requires_review"))


def values(rows: DataFrame, raw_value: str = "raw_value") -> DataFrame:
    """Add parsed_decimal, normalized_value and fact_status to rows with a unit.

    A value that doesn't fit the money type, before or after scaling, is null. An alias that several
    concepts claim (``concepts``) and levels whose units disagree (``unit_conflict``) need review, where
    rows have these columns.
    """
    rows = rows.withColumn("parsed_decimal", parse_decimal(raw_value))
    product = F.try_multiply(F.col("parsed_decimal").try_cast("decimal(28,6)"), F.col("scale_factor").try_cast("decimal(9,0)"))
    rows = rows.withColumn("normalized_value", product.try_cast(MONEY))
    fits = F.col("normalized_value").isNotNull() | F.col("scale_factor").isNull()
    ready = F.col("parsed_decimal").isNotNull() & fits & (F.col("unit_confidence") >= AUTO_CONFIDENCE)
    if "concepts" in rows.columns:
        ready &= F.col("concepts") <= 1
    if "unit_conflict" in rows.columns:
        ready &= ~F.col("unit_conflict")
    return rows.withColumn("fact_status", F.when(ready, "normalized").otherwise("needs_review"))


def label_values(cells: DataFrame, key: list[str], value_columns: str = "first") -> DataFrame:
    """(key, row_index, raw_label, raw_value, raw_cell_id, cell_bbox, column_index, column_label) of a grid's rows below its header.

    Labels are column 0 and values column 1, or every later column with ``value_columns='all'``. Rows
    without a label are dropped; a row without value cells gives one null value; of repeated cells the
    last counts. Cells are dealt once, by ``key``, and meet in windows, so work is linear in them.
    """
    kept = cells if value_columns == "all" else cells.where("column_index <= 1")
    held = last_cells(kept.repartition(*key), key)
    is_value, at_head = F.col("column_index") >= 1, F.col("row_index") == 0
    row, column, grid = Window.partitionBy(*key, "row_index"), Window.partitionBy(*key, "column_index"), Window.partitionBy(*key)
    held = held.withColumns({"raw_label": F.max(F.when(~is_value, F.col("raw_text"))).over(row), "__values": F.count(F.when(is_value, 1)).over(row)})
    held = held.withColumn("__first", F.max(F.when(at_head & (F.col("column_index") == 1), F.col("raw_text"))).over(grid))
    heading = F.col("__first")  # of the only value column
    if value_columns == "all":
        held = held.withColumn("__head", F.max(F.when(at_head, F.col("raw_text"))).over(column))
        heading = F.when(is_value, F.col("__head")).otherwise(heading)
    rows = held.where(~at_head & F.col("raw_label").isNotNull() & (is_value | (F.col("__values") == 0)))
    own = lambda c: F.when(is_value, F.col(c))
    return rows.select(*key, "row_index", "raw_label", own("raw_text").alias("raw_value"), own("raw_cell_id").alias("raw_cell_id"), own("bbox").alias("cell_bbox"), F.greatest("column_index", F.lit(1)).alias("column_index"), heading.alias("column_label"))


def suggestions(rows: DataFrame, aliases: DataFrame, most: int = 2, raw_label: str = "raw_label", market: str = "market") -> DataFrame:
    """(market, label, n_rows, candidates): labels that no alias of their market equals, each with the aliases within ``most`` edits.

    ``candidates`` are (edits, alias, normalized_concept_id) in order, empty if no alias is near. Rows without a label or a market
    are left out. Nothing is mapped by it: a reviewer adds an alias to the rule pack.
    """
    counted = rows.select(F.col(market).alias("market"), label(raw_label).alias("label")).where("market is not null and length(label) > 0").groupBy("market", "label").agg(F.count("*").alias("n_rows"))
    known = aliases.select("market", F.col("alias").alias("label"))
    open_labels = counted.join(known, ["market", "label"], "left_anti")
    near = candidates(open_labels, aliases, "label", most, "market")
    near = near.groupBy("market", "label").agg(F.array_sort(F.collect_list(F.struct("edits", "alias", "normalized_concept_id"))).alias("candidates"))
    none = F.array().cast("array<struct<edits:int,alias:string,normalized_concept_id:string>>")
    return open_labels.join(near, ["market", "label"], "left").withColumn("candidates", F.coalesce("candidates", none))


def unmatched_rows(classified: DataFrame, raw_cells: DataFrame, runs: DataFrame, reports: DataFrame, roles: Sequence[str] = STATEMENTS) -> DataFrame:
    """(extraction_run_id, market, raw_label): the labelled rows of the classified statements of some runs, for ``suggestions``."""
    tables = classified.where(F.col("table_role").isin(*roles)).select("raw_table_id", "extraction_run_id")
    tables = tables.join(runs.select("extraction_run_id", "report_id").join(reports.select("report_id", "market"), "report_id"), "extraction_run_id")
    return label_values(raw_cells.join(tables.select("raw_table_id"), "raw_table_id", "left_semi"), ["raw_table_id"]).join(tables, "raw_table_id").select("extraction_run_id", "market", "raw_label")


def period_basis(header: Column, packs: dict[str, RulePack], market: str = "market") -> Column:
    """The first period basis with a pattern in a column header; ``unknown`` without one."""
    text, out = F.lower(F.coalesce(header, F.lit(""))), F.lit("unknown")
    for m, pack in packs.items():
        found, _ = first_match(text, pack.periods)
        out = F.when(F.col(market) == m, F.coalesce(found.cast("string"), F.lit("unknown"))).otherwise(out)
    return out


def with_unit_by_level(rows: DataFrame, packs: dict[str, RulePack], levels: dict[str, Column], longest: bool = False) -> DataFrame:
    """Add the fields of ``units``, from the first level whose text has a currency and a scale, and ``unit_conflict``.

    A later level with another unit is a conflict. Without a level that has both, the texts of all
    levels together decide, as ``units`` does.
    """
    held = {f"__{n}": units(text, packs, longest=longest) for n, text in levels.items()}
    rows = rows.withColumns({**held, "__all": units(F.concat_ws("\n", *levels.values()), packs, longest=longest)})
    known = lambda c: F.col(c)["unit_confidence"] > 0
    rows = rows.withColumns({f"{c}_name": F.when(known(c), F.concat_ws(" ", F.col(c)["currency"], F.col(c)["scale_factor"].cast("string"))) for c in held})
    _, conflict = nearest_unit([f"{c}_name" for c in held])
    rows = rows.withColumns({"__unit": F.coalesce(*[F.when(known(c), F.col(c)) for c in held], F.col("__all")), "unit_conflict": conflict})
    return rows.select("*", "__unit.*").drop("__unit", "__all", *held, *[f"{c}_name" for c in held])


def extract_facts(
    classified: DataFrame, raw_tables: DataFrame, raw_cells: DataFrame, pages: DataFrame, runs: DataFrame, reports: DataFrame, packs: dict[str, RulePack], aliases: DataFrame, created_at: Column, roles: Sequence[str] = (BALANCE_SHEET,), value_columns: str = "first", longest_unit: bool = False, unit_levels: bool = False
) -> DataFrame:
    """Rows of extracted_facts for the classified tables of ``roles`` in the given runs.

    By default only balance sheets and their first value column, as point-in-time amounts. With
    ``value_columns='all'`` every later column is a fact, with the basis its header names. With
    ``unit_levels`` a column's header decides the unit before the table's text, and that before the
    page's; units that disagree need review.
    """
    context = runs.select("extraction_run_id", "report_id").join(reports.select("report_id", "market", "company_id", "fiscal_year", "report_type", "source_type"), "report_id")
    tables = classified.where(F.col("table_role").isin(*roles)).select("raw_table_id", "table_role", "statement_scope")
    tables = tables.join(raw_tables.select("raw_table_id", "extraction_run_id", "report_id", "page_number", "table_index_on_page", "extractor_name", "raw_table_text"), "raw_table_id")
    tables = tables.join(context, ["extraction_run_id", "report_id"]).join(pages.select("report_id", "page_number", "page_text_sample"), ["report_id", "page_number"], "left")
    texts = ("page_text_sample", "raw_table_text")
    if not unit_levels:
        tables = tables.withColumn("u", units(unit_context(), packs, longest=longest_unit)).select("*", "u.*").drop("u", *texts)
    rows = label_values(raw_cells.join(tables.select("raw_table_id"), "raw_table_id", "left_semi"), ["raw_table_id"], value_columns).join(tables, "raw_table_id")
    if unit_levels:
        levels = {"cell": F.col("column_label"), "table": F.col("raw_table_text"), "page": F.col("page_text_sample")}
        rows = with_unit_by_level(rows, packs, levels, longest_unit).drop(*texts)
    rows = values(concepts(rows, aliases))
    basis = F.lit("point_in_time") if value_columns == "first" else period_basis(F.col("column_label"), packs)
    rows = rows.withColumn("__dates", period(F.col("column_label"), basis)).select("*", "__dates.*").drop("__dates")
    return rows.withColumns(
        {
            "fact_id": stable_id("extraction_run_id", "raw_table_id", "row_index", "column_index", "normalized_concept_id"),
            "statement_type": F.substring_index("table_role", ".", -1),
            "period_basis": basis,
            "row_label": F.col("raw_label"),
            "created_at": created_at,
        }
    )


def summary(facts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return facts.groupBy(*keys).agg(F.count("*").alias("fact_count"), F.count_if(F.col("fact_status") == "needs_review").alias("needs_review_count"))
