import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n, seed=0):
    return " ".join(WORDS[(i * i * 7 + i * 3 + seed * 11 + i // 5) % len(WORDS)] for i in range(n))


#: Extra columns carry names that the operators use themselves.
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, code bigint, n bigint, tokens bigint, bucket int, epoch int, cut bigint, part string, score double, shard int, h bigint, copy boolean, items string, marks string"


def doc(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, len(text or ""), 1, 2, 3, 4, 5, 6, "p", 0.5, 7, 8, True, "i", "m")


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [
        doc(1, prose(200, 1)),
        doc(2, prose(200, 1) + " extra"),
        doc(3, None),
        doc(4, ""),
        doc(5, "   \n\t "),
        doc(6, "one two"),
        doc(7, prose(120_000, 3), source="src1"),
        doc(8, prose(200, 1)),
        doc(8, prose(200, 1)),
        doc(None, prose(60, 5), lang=None, source=None),
        doc(10, "naïve Ünïcode 漢字 😀 text　wide  double  spaces <|endoftext|> end", lang="de"),
        doc(11, prose(40, 9), lang=None),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
