import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postline import fixed_values as fixed
from postline.functions import text

# input, clean_text, clean_text_ordered
GOLDEN = [
    (
        '@bob Hi "there"\nline2 | https://t.co/aB1?x=2 ok é 42',
        "bob hi there\nline   ok  ",
        " hi there\nline   ok  ",
    ),
    ("RT @x HTTP://Y http xhttpfoo", "rt x  http x", "rt x  http x"),
    ("@bob_7 hi", "bob hi", " hi"),
    ("see https://t.co/aB1 now", "see  now", "see  now"),
    ("see https://t.co/aB1", "see ", "see "),
    ("Été à 100%", "t  ", "t  "),
    ("  two  spaces ", "  two  spaces ", "  two  spaces "),
    ("a\tb", "a\tb", "a\tb"),
    ("hthttpx ttpy", "ht ttpy", "ht ttpy"),
    ("12345", "", ""),
    ("", "", ""),
    (None, None, None),
]


def as_defined(column):
    """The chain rule by rule, with the patterns as they are defined."""
    letters = F.regexp_replace(column, fixed.NON_LETTER, "")
    handle = F.regexp_replace(letters, fixed.LEADING_HANDLE, "")
    return F.regexp_replace(F.lower(handle), fixed.URL, "")


@pytest.mark.parametrize("position, rule", [(1, text.clean_text), (2, text.clean_text_ordered)])
def test_golden_rows(spark, position, rule):
    rows = spark.createDataFrame([(i, row[0]) for i, row in enumerate(GOLDEN)], "i int, text string")
    got = rows.select("i", rule(F.col("text")).alias("text")).orderBy("i").collect()
    assert [row.text for row in got] == [row[position] for row in GOLDEN]


def test_single_rules(spark):
    row = (
        spark.createDataFrame([("@bob_7 Hi\n@amy 1", "xhttp://a/b?c d")], "a string, b string")
        .select(
            text.strip_leading_handle(F.col("a")).alias("handle"),
            text.strip_nonletters(F.col("a")).alias("letters"),
            text.lower_text(F.col("a")).alias("lower"),
            text.strip_urls(F.col("b")).alias("urls"),
        )
        .first()
    )
    assert row.handle == " Hi\n@amy 1"
    assert row.letters == "bob Hi\namy "
    assert row.lower == "@bob_7 hi\n@amy 1"
    assert row.urls == "x d"


def test_letters_rule_equals_its_definition_on_every_code_point(spark):
    points = [p for p in range(1, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    texts = ["".join(f"a{chr(p)}" for p in points[i : i + 500]) for i in range(0, len(points), 500)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    differing = rows.filter(
        text.strip_nonletters(F.col("text"))
        != F.regexp_replace("text", fixed.NON_LETTER, "")
    )
    assert differing.isEmpty()


def test_chain_equals_its_definition_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cleaned = text.clean_text(F.col("text"))
    assert docs.filter(~cleaned.eqNullSafe(as_defined(F.col("text")))).isEmpty()
    assert docs.filter(~cleaned.rlike(r"\A[a-z\s]*\z")).isEmpty()
    assert docs.filter(cleaned != text.clean_text(cleaned)).isEmpty()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="@_hHtTpP:/ \n\tAz09é😀|\"'", max_size=40), min_size=1, max_size=40))
def test_chain_equals_its_definition_on_any_text(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    c = F.col("text")
    assert rows.filter(text.clean_text(c) != as_defined(c)).isEmpty()
