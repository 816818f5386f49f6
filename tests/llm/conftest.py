import pytest

LONG = "wort " * 40_000


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, blank and very long texts, repeats and clashing names."""
    rows = [
        (1, "One two three four five six seven eight nine ten eleven.", "en", "src0"),
        (2, None, "en", "src1"), (3, "", None, "src1"), (4, " \t\n", "de", None),
        (5, LONG, "de", "src2"), (6, "12 34 -- 56", "fr", "src2"),
        (7, "Same words here", "en", "src0"), (7, "Same words here", "en", "src0"),
        (None, "No key at all", None, None), (8, "naïve  ▁   text\r\n\x00 end ", "fr", "src0"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "1 AS n_tokens", "2 AS KEPT", "3 AS shard", "4 AS bucket",
                         "5 AS lang_pred", "6 AS `odd.name`", "7 AS component_id",
                         "8 AS tokens", "9 AS path", "10 AS n_shingles", "11 AS id")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
