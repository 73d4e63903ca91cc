"""Property: encode then decode gives back every value, for any text and numbers."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tsline.operators.decode import decode_columns
from tsline.operators.encode import encode_lines

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("tag", T.StringType()),
    T.StructField("s", T.StringType()), T.StructField("i", T.LongType()),
    T.StructField("d", T.DoubleType()), T.StructField("b", T.BooleanType())])

rows = st.lists(st.tuples(
    st.text(max_size=20), st.text(max_size=40),
    st.integers(min_value=-2**63, max_value=2**63 - 1),
    st.floats(allow_nan=False, allow_infinity=False),
    st.booleans()), min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_encode_decode_round_trip(spark, data):
    table = [(n, tag, s, i, d, b) for n, (tag, s, i, d, b) in enumerate(data)]
    df = spark.createDataFrame(table, SCHEMA)
    lines = encode_lines(df, "m", tags=["tag"], fields=["s", "i", "d", "b"], time="id",
                         precision="ns")
    back = decode_columns(lines, ["tag"], {"s": T.StringType(), "i": T.LongType(),
                                           "d": T.DoubleType(), "b": T.BooleanType()})
    got = sorted((r["time_ns"], r["tag"], r["s"], r["i"], r["d"], r["b"]) for r in back.collect())
    assert got == sorted(table)
