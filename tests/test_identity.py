import hashlib
import json

from pyspark.sql import functions as F

from feedlake.functions import identity as I


def test_canonical_json_sorted_and_styles(spark):
    df = spark.createDataFrame([('{"b": 1, "a": {"d": "x:y, z", "c": [1, 2]}}',)], "s string")
    compact, py = df.select(I.canonical_json("s"), I.canonical_json("s", style="python")).first()
    doc = json.loads(df.first().s)
    assert compact == json.dumps(doc, sort_keys=True, separators=(",", ":"))
    assert py == json.dumps(doc, sort_keys=True)


def test_event_hashes_match_python_rules(spark):
    data = {"id": "v1", "n": 2, "pos": {"lat": 42, "lon": -71}}
    df = spark.createDataFrame([("A", "vehicles", "update", "ep", "v1", json.dumps(data))],
                               "agency string, stream string, event string, endpoint string, id string, data string")
    h_pipe, h_struct = df.select(
        I.event_hash_pipe("endpoint", "event", "id", "data"),
        I.event_hash_struct("agency", "stream", "event", "endpoint", "data")).first()
    exp_pipe = hashlib.sha256(f"ep|update|v1|{json.dumps(data, sort_keys=True)}".encode()).hexdigest()
    payload = {"agency": "A", "stream": "vehicles", "event": "update", "endpoint": "ep", "data": data, "metadata": None}
    exp_struct = hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert h_pipe == exp_pipe
    assert h_struct == exp_struct


def test_hash_stable_under_key_order(spark):
    df = spark.createDataFrame([('{"a":1,"b":2}',), ('{"b":2, "a":1}',)], "d string")
    hs = {r[0] for r in df.select(I.event_hash_struct(F.lit("A"), F.lit("s"), F.lit("e"), F.lit(""), "d")).collect()}
    assert len(hs) == 1


def test_row_hash_matches_python(spark):
    df = spark.createDataFrame([("1", "Main St", None)], "stop_id string, stop_name string, zone string")
    h, h_ign = df.select(I.row_hash(df.columns, "stops"), I.row_hash(df.columns, "stops", True)).first()
    row = {"stop_id": "1", "stop_name": "Main St", "zone": None}
    exp = hashlib.sha256(json.dumps({"table": "stops", "row": row}, sort_keys=True, separators=(",", ":"))
                         .encode()).hexdigest()
    assert h == exp
    row.pop("zone")
    exp2 = hashlib.sha256(json.dumps({"table": "stops", "row": row}, sort_keys=True, separators=(",", ":"))
                          .encode()).hexdigest()
    assert h_ign == exp2


def test_error_hash(spark):
    df = spark.createDataFrame([("A", "2024-01-01 10:00:00", "boom")], "a string, t string, m string")
    assert df.select(I.error_hash("a", "t", "m")).first()[0] == hashlib.sha256(
        b"A|error|2024-01-01 10:00:00|boom").hexdigest()


def test_long_and_odd_json_equals_json_dumps(spark):
    """No cap on length, keys or backslashes."""
    docs = [{"s": "x, y: z" * 150_000}, {f"k{i}": f"v,{i}:" for i in range(10_000)},
            {"a": "\\" * 100 + "\x1f\x0b" + "\\" * 33 + "\x1a", "b": '\\"quoted, "'},
            {"é😀": ["\x00\x1e", "漢字, :", {"n": [1, -2, 3.5, True, None]}]}, [], {}, "plain, text: x", 5]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, s string")
    for r in df.select("i", I.canonical_json("s"), I.canonical_json("s", style="python")).collect():
        assert r[1] == json.dumps(docs[r[0]], sort_keys=True, separators=(",", ":"))
        assert r[2] == json.dumps(docs[r[0]], sort_keys=True)


def test_different_payloads_never_share_a_hash(spark):
    rows = ["plain one", "plain two", '{"a":1,"a":2}', '{"a":1,"a":3}', "{broken", None, "null", '"null"', ""]
    df = spark.createDataFrame([(r,) for r in rows], "d string")
    pipe = [r[0] for r in df.select(I.event_hash_pipe(F.lit("ep"), F.lit("update"), F.lit("1"), "d")).collect()]
    struct = [r[0] for r in df.select(I.event_hash_struct(F.lit("A"), F.lit("s"), F.lit("e"), F.lit(""), "d")).collect()]
    # JSON null and a missing payload are the same record; everything else differs.
    assert len(set(pipe)) == len(set(struct)) == len(rows) - 1
    assert pipe[0] == hashlib.sha256(b'ep|update|1|"plain one"').hexdigest()


def test_numbers_and_strings_like_held_ones_equal_json_dumps(spark):
    numbers = ["0", "-0", "0.0", "-0.0", "0e5", "1.0", "1.50", "-2.50e+3", "1e5", "1E16", "1e15", "123456789012345e1", "999999999999999.9",
               "0.0001", "0.00010", "0.00009", "0.000123456789012345", "9999999999999998", "9999999999999999.0", "0.1e1", "123e-1", "1.5E-7",
               "100000000000000.0", "1234567.12345678", "12345678.123456789", "1e-400", "5e-324", "3" * 40, "-" + "7" * 20 + ".5"]
    strings = ["s", "5s", "1.0s", "-0s", "1.0", 'a"s', "\\", "\x01", ", :", "é", "\uffff1.0", "😀1.0", "k, 1e5: "]
    docs = numbers + [f"[{n}, {n}]" for n in numbers] + [f'{{{json.dumps(a)}: 1.50, {json.dumps(b, ensure_ascii=False)}: [{json.dumps(a)}, -0]}}'
                                                         for a, b in zip(strings, strings[1:])] + [" [ 1.0 ,{ } , 2.5e3 ] "]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    for d, compact, py in df.select("d", I.canonical_json("d"), I.canonical_json("d", style="python")).collect():
        assert compact == json.dumps(json.loads(d), sort_keys=True, separators=(",", ":")), d
        assert py == json.dumps(json.loads(d), sort_keys=True), d


def test_number_texts_that_are_no_json_and_far_exponents(spark):
    docs = ["01.0", "1.", ".5", "[1.50,]", "{1.0:2.0}", '{"a":1.0,"a":2.0}', "1.5E-2147483640", "1E-2147483640"]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    assert [r[0] for r in df.select(I.canonical_json("d")).collect()] == [None] * 6 + ["0.0"] * 2
