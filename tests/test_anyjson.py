"""Messages whose keys nobody has listed: merged schema, flattening, odd keys and values."""

from pyspark.sql import types as T

from tempora.functions.anyjson import flatten_any, message_schema
from tempora.streaming.landing import land_any_batch
from tempora.streaming.messages import parse_weather_messages


def frame(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string").repartition(3)


def test_keys_of_all_messages_become_columns(spark):
    msgs = frame(spark, '{"a": 1, "b": {"c": 2.5, "d e": "x"}}', '{"a": 2.5, "new": true, "b": {"f": [1, 2]}}', '{}',
                 '{"a": null, "b": null, "w": [{"k": 1}, {"m": "y"}]}', "broken {", "[1]", "5", None, '"text"')
    out = flatten_any(msgs, keep=["n"])
    assert out.columns == ["n", "_malformed", "a", "b_c", "b_d_e", "b_f", "new", "w"]
    assert out.schema["a"].dataType == T.DoubleType() and out.schema["b_f"].dataType == T.ArrayType(T.LongType())
    rows = {r.n: r for r in out.collect()}
    assert (rows[0].a, rows[0].b_c, rows[0].b_d_e, rows[0].new) == (1.0, 2.5, "x", None)
    assert (rows[1].a, rows[1].new, rows[1].b_f) == (2.5, True, [1, 2])
    assert rows[3].w[0].k == 1 and rows[3].w[1].m == "y"
    assert [rows[n]._malformed for n in range(9)] == [False] * 4 + [True] * 5


def test_values_without_a_common_type_are_text(spark):
    out = flatten_any(frame(spark, '{"x": 1, "o": {"a": 1}, "e": {}, "z": null}', '{"x": "one", "o": 5, "e": {}, "z": null}'), keep=["n"])
    rows = {r.n: r for r in out.collect()}
    assert (rows[0].x, rows[1].x) == ("1", "one") and (rows[0].o, rows[1].o) == ('{"a":1}', "5")
    assert rows[0].e == "{}" and rows[0].z is None


def test_names_that_clash_or_need_quotes(spark):
    out = flatten_any(frame(spark, '{"a b": 1, "a_b": 2, "a": {"b": 3}, "A_B": 4, "q\\"\'`$.[0]": 5, "n": 6, "é": 7, "": 8}'), keep=["n"])
    (r,) = out.collect()
    named = r.asDict()
    assert sorted(v for k, v in named.items() if k not in ("n", "_malformed")) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert named["n"] == 0 and named["n_2"] == 6 and len({k.lower() for k in named}) == len(named)


def test_large_numbers_and_a_given_schema(spark):
    msgs = frame(spark, '{"i": 9007199254740993, "d": 12345678901234567890123, "t": "x"}')
    (r,) = flatten_any(msgs).collect()
    assert r.i == 9007199254740993 and abs(r.d - 1.2345678901234568e22) < 1e7
    given = T.StructType([T.StructField("t", T.LongType()), T.StructField("absent", T.StringType())])
    (r,) = flatten_any(msgs, schema=given).collect()
    assert (r.t, r.absent) == (None, None)
    assert message_schema(msgs.limit(0)) == T.StructType([]) == message_schema(frame(spark, "nothing", None))
    assert flatten_any(frame(spark, "nothing")).collect()[0]._malformed


def test_equals_the_fixed_schema_on_listed_keys(spark):
    text = ('{"dt": 5, "main": {"temp": 280.5, "pressure": 1010}, "wind": {"speed": 3.25}, "id": 7, "cod": 200, "rain": {"1h": 0.5}}')
    got = flatten_any(frame(spark, text)).first()
    want = parse_weather_messages(frame(spark, text)).first()
    assert all(got[c] == want[c] for c in ("dt", "main_temp", "main_pressure", "wind_speed", "id", "cod")) and got.rain_1h == 0.5


def test_landing_keeps_unlisted_keys(spark, scratch):
    first = spark.createDataFrame([('{"dt": 100, "a": 1}',), ('{"dt": 200, "b": {"c": "x"}}',), ("{bad",), ('{"a": 2}',)], "value string")
    name = land_any_batch(first, f"{scratch}/any", 0)
    out = spark.read.parquet(f"{scratch}/any/{name}")
    assert out.columns == ["a", "b_c", "dt"] and sorted((r.dt, r.a, r.b_c) for r in out.fillna({"a": -1, "b_c": "-"}).collect()) == [
        (100, 1, "-"), (200, -1, "x")]
    rejects = spark.read.parquet(f"{scratch}/any_rejects")
    assert sorted(r.value for r in rejects.collect()) == ['{"a": 2}', "{bad"]
