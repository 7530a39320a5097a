import pytest

from filingmill.operators import facts

ALIASES = ["cost", "cash", "c", "现金", "资金", "货币资金", "total cash", "xyz"]
LABELS = ["a", "ca", "cas", "cash", "现", "现款", "货币现款", "total cost", "chas", "zzzzzz"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
def test_short_labels_meet_all_aliases_within_the_edits(spark, most):
    rows = spark.createDataFrame([(x, "m") for x in LABELS], "raw_label string, market string")
    aliases = spark.createDataFrame([(a, "m", "c") for a in ALIASES], "alias string, market string, normalized_concept_id string")
    got = sorted((r["label"], r["alias"]) for r in facts.candidates(rows, aliases, "raw_label", most).collect())
    assert got == sorted((x, a) for x in LABELS for a in ALIASES if 1 <= distance(x, a) <= most)
