"""Property tests on generated documents (many documents per Spark job): canonical
JSON equals Python's ``json.dumps`` for any text, including non-ASCII and control
characters, and with numbers of any spelling."""

import json
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions.identity import canonical_json

ascii_text = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=126), max_size=12)
any_text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12)
scalars = st.one_of(st.none(), st.booleans(), st.integers(-10**12, 10**12), any_text)
docs = st.recursive(scalars, lambda inner: st.one_of(st.lists(inner, max_size=4),
                                                     st.dictionaries(any_text, inner, max_size=4)),
                    max_leaves=12)
objects = st.dictionaries(any_text, docs, min_size=1, max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(objects, min_size=1, max_size=40))
def test_canonical_json_matches_python(spark, batch):
    rows = [(json.dumps(d, ensure_ascii=False), json.dumps(dict(reversed(list(d.items()))))) for d in batch]
    df = spark.createDataFrame(rows, "a string, b string")
    out = df.select(canonical_json("a").alias("ca"), canonical_json("b").alias("cb"),
                    canonical_json("a", style="python").alias("pa")).collect()
    for d, r in zip(batch, out):
        assert r.ca == r.cb == json.dumps(d, sort_keys=True, separators=(",", ":"))
        assert r.pa == json.dumps(d, sort_keys=True)


spelled = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False).map(repr),
    st.floats(1e-8, 1e18).map(lambda x: f"{x:.3f}"), st.floats(allow_nan=False, allow_infinity=False).map(lambda x: f"{x:.17E}"),
    st.integers(-10**40, 10**40).map(str),
    st.tuples(st.integers(-10**20, 10**20), st.integers(0, 10**25), st.integers(-330, 310)).map(lambda t: f"{t[0]}.{t[1]}e{t[2]}"),
    st.sampled_from(["-0", "0", "-0.0", "0e0", "1E5", "1e400", "-1e400", "1e-400", "5e-324", "1e22", "1e23", "9007199254740993.0",
                     "2.82879384806159008E17", "0.10", "1e16", "9999999999999998.0", "123456789012345680.0", "0.0001", "0.00001"]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(spelled, min_size=5, max_size=120))
def test_numbers_come_out_as_python_writes_them(spark, numbers):
    rng = random.Random(len(numbers))
    rows = [(f'{{"b": [{n}, {rng.choice(numbers)}], "a{n}": "{n} \\u00e9", "c": {{"z": {n}}}}}',) for n in numbers]
    out = spark.createDataFrame(rows, "a string").select("a", canonical_json("a").alias("c"), canonical_json("a", style="python").alias("p")).collect()
    for r in out:
        assert r.c == json.dumps(json.loads(r.a), sort_keys=True, separators=(",", ":"))
        assert r.p == json.dumps(json.loads(r.a), sort_keys=True)
