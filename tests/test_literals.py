"""Which JSON texts are parsed anew before the walk."""

import pytest

from pyspark.sql import functions as F

from tracewell.operators import literals


@pytest.mark.parametrize(("text", "odd"), [
    ('{"id":"7e3f0a11-9c1d-4e5f-8a2b-3c4d5e6f7a8b"}', False),
    ('{"time":"2025-01-02T03:04:05.000Z","sha":"12345678901234567890abcdef"}', False),
    ('{"a \\" 1e5":"\\\\","b":[1,2.5,-3]}', False),
    ('{"a":1e5}', True),
    ('{"a":"x","b":[1.50]}', True),
    ('["\\\\",1E3]', True),
    ('{"n":12345678901234567890}', True),
    ("3.0", True),
    ('"3.0"', False),
])
def test_only_numbers_outside_of_strings_are_odd(spark, text, odd):
    row = spark.createDataFrame([(text,)], "text string")
    assert row.select(literals.has_odd_numbers(F.col("text"))).first()[0] is odd
    prepared = row.select(literals.prepared(F.col("text"))).first()[0]
    assert (prepared == text) is not odd and ("ue000" in prepared) is odd
