"""Texts with several JSON records, and what they are taken apart into."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reachmill.functions.records import records


def split(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = df.select("n", F.posexplode(records(F.col("text"))).alias("at", "record"))
    result = [[] for _ in texts]
    for row in sorted(found.select("n", "at", "record.*").collect()):
        result[row["n"]].append((row["text"], row["broken"]))
    return result


@pytest.mark.parametrize("text, expected", [
    ('{"a":1}', [{"a": 1}]),
    ('{"a":1}{"a":2}', [{"a": 1}, {"a": 2}]),
    ('{"a":"} {"}\n\n {"a":[1,{"b":2}]}', [{"a": "} {"}, {"a": [1, {"b": 2}]}]),
    ('[{"a":1},{"a":2}]', [{"a": 1}, {"a": 2}]),
    ('[{"a":1}][{"a":2}]{"a":3}', [{"a": 1}, {"a": 2}, {"a": 3}]),
])
def test_records(spark, text, expected):
    [found] = split(spark, [text])
    assert [json.loads(t) for t, _ in found] == expected
    assert not any(broken for _, broken in found)


def test_broken_texts_stay_whole(spark):
    texts = ['{"a":1} x', "{broken", "[]", '[{"a":1},{', '{"a":1}{"a":', '{"a":1}]', '{"a":1}{"b":1}}']
    assert split(spark, texts) == [[(t, True)] for t in texts]
    assert split(spark, [None, ""]) == [[(None, False)], [("", False)]]


def test_long_text(spark):
    one = json.dumps({"a": 'x} {"' * 200_000})
    [found] = split(spark, [one + "\n" + one])
    assert [json.loads(t) for t, _ in found] == [json.loads(one)] * 2


value = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet='ab{}[]", \\\n', max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=3),
    max_leaves=6,
)
objects = st.lists(st.dictionaries(st.text(max_size=3), value, max_size=3), min_size=1, max_size=4)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(objects, st.sampled_from(["", "\n", "  "]), st.booleans()), min_size=1, max_size=20))
def test_any_records(spark, cases):
    texts = [
        json.dumps(o) if as_list else gap.join(json.dumps(x, indent=2 if gap else None) for x in o)
        for o, gap, as_list in cases
    ]
    for (expected, _, _), found in zip(cases, split(spark, texts), strict=True):
        assert [json.loads(t) for t, _ in found] == expected
