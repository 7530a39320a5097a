from filingmill.operators import review


def test_display_takes_its_width_from_the_cells(spark):
    cells = spark.createDataFrame([(1, 0, 0, "a"), (1, 0, 6, "g"), (2, 0, 1, "b")], "k int, row_index int, column_index int, raw_text string")
    got = review.with_display(cells, ["k"])
    assert got.columns == ["k", "row_index", *[f"display_col_{i}" for i in range(7)]]
    assert sorted(map(tuple, got.collect())) == [(1, 0, "a", *[None] * 5, "g"), (2, 0, None, "b", *[None] * 5)]
    assert review.with_display(cells.where("false"), ["k"]).count() == 0
