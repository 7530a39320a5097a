"""Labels and values of grids."""

from filingmill.operators import facts

CELLS = "t string, row_index int, column_index int, raw_text string, raw_cell_id string, bbox array<double>"


def test_the_first_value_column_needs_no_window_by_column(spark):
    grid = [(0, 0, "Caption"), (0, 1, "2025"), (0, 2, "2024"), (1, 0, "Sales"), (1, 1, "5"), (1, 2, "4"), (2, 0, "Costs"), (2, 2, "3"), (3, 0, "Tax"), (3, 1, None)]
    cells = spark.createDataFrame([(t, r, c, x, f"{t}/{r}/{c}", None) for t in "ab" for r, c, x in grid if (t, r, c) != ("b", 0, 1)], CELLS)
    first, every = (facts.label_values(cells, ["t"], how) for how in ("first", "all"))
    windows = [df._jdf.queryExecution().optimizedPlan().toString().count("Window [") for df in (first, every)]
    assert windows[0] < windows[1]
    got = lambda df: sorted((r["t"], r["row_index"], r["column_index"], r["raw_label"], r["raw_value"], r["column_label"]) for r in df.collect())
    assert got(first) == [(t, r, 1, n, v, {"a": "2025", "b": None}[t]) for t in "ab" for r, n, v in ((1, "Sales", "5"), (2, "Costs", None), (3, "Tax", None))]
    assert ("a", 1, 2, "Sales", "4", "2024") in got(every)
