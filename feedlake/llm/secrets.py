"""Secret scans: base patterns plus two character Markov models compared by log-likelihood ratio.

Native: DataFrame functions only. Base spans come from three patterns (assignments, access
keys, hex strings). The models are first-order character chains: one of random strings,
one of ordinary identifiers. Their labelled samples come from the corpus itself: the
values that the base patterns find are random, candidate runs without a digit that no
base span touches are ordinary. Transition counts cover all labelled strings of all
texts; only the table of transitions (128 x 128) reaches the driver. A candidate (a run of
``[A-Za-z0-9+/_=-]{16,}`` with letters and digits, or letters of both cases) that no base span touches
becomes a span when its log-likelihood ratio a transition is over ``THRESHOLD``.

Positions of all matches of a pattern come from splitting the text by it: the lengths of
the pieces between matches and of the matches add up to starts and ends.

Defined cases: null text counts as empty and has no spans; repeated rows are scanned each on
their own; without labelled strings of one kind the table falls back to its priors; an
empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import documents

# The base patterns and what a match must have.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the same as AKIA[A-Z0-9]+ of 16 or more characters
HEX = r"[0-9a-f]{32,}"  # the same as [0-9a-f]+ of 32 or more characters
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE = 8
THRESHOLD = 1.0
#: Prior count of each character among ordinary identifiers.
PLAIN_PRIOR = 0.05
ALPHABET = 128
SPAN = "array<struct<start:int,end:int,value:string>>"


def _located(df: DataFrame, out: str, text: str, pattern: str, value_group: int = 0) -> DataFrame:
    """Adds ``out``: start, end (code points, exclusive) and value of all matches of a pattern.

    Matches and gaps are columns of their own, so that the pattern runs once a text.
    """
    none = F.array().cast("array<string>")
    hit = F.col(text).rlike(pattern)
    df = df.withColumn("__ss_m", F.when(hit, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none))
    some = F.size("__ss_m") > 0
    df = df.withColumn("__ss_g", F.when(some, F.transform(F.split(F.col(text), pattern, -1), F.length)))
    df = df.withColumn("__ss_v", F.when(some, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(value_group)))
                       if value_group else F.col("__ss_m"))
    df = df.withColumn("__ss_l", F.transform("__ss_m", F.length))
    ends = F.aggregate(F.sequence(F.lit(0), F.size("__ss_l") - 1), F.array().cast("array<int>"), lambda acc, i: F.concat(
        acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.get("__ss_g", i) + F.get("__ss_l", i))))
    df = df.withColumn("__ss_e", F.when(some, ends))
    spans = F.transform(F.sequence(F.lit(0), F.size("__ss_l") - 1), lambda i: F.struct(
        (F.get("__ss_e", i) - F.get("__ss_l", i)).alias("start"), F.get("__ss_e", i).alias("end"),
        F.get("__ss_v", i).alias("value")))
    return df.withColumn(out, F.coalesce(F.when(some, spans), F.array().cast(SPAN))) \
        .drop("__ss_m", "__ss_g", "__ss_v", "__ss_l", "__ss_e")


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds __ss_assign, __ss_access, __ss_hex and __ss_run (candidate runs that no base span touches)."""
    df = docs.withColumn("__ss_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = _located(df, "__ss_assign", "__ss_text", ASSIGN, 2)
    df = df.withColumn("__ss_assign", F.filter("__ss_assign", lambda s: F.length(s["value"]) >= MIN_VALUE))
    df = _located(df, "__ss_access", "__ss_text", ACCESS)
    df = _located(df, "__ss_hex", "__ss_text", HEX)
    df = _located(df, "__ss_run", "__ss_text", CANDIDATE)
    df = df.withColumn("__ss_base", F.concat("__ss_assign", "__ss_access", "__ss_hex"))
    apart = F.when(F.size("__ss_base") == 0, F.col("__ss_run")).otherwise(F.filter("__ss_run", lambda r: ~F.exists(
        "__ss_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))))
    return df.withColumn("__ss_run", apart).drop("__ss_text")


def _pairs(values: Column) -> Column:
    """Transitions of a string: code of the first character times ``ALPHABET`` plus that of the second."""
    chars = F.split(values, "")
    code = F.transform(chars, lambda c: F.least(F.ascii(c), F.lit(ALPHABET - 1)))
    return F.transform(F.arrays_zip(F.slice(code, 1, F.greatest(F.size(code) - 1, F.lit(0))).alias("a"),
                                    F.slice(code, 2, F.greatest(F.size(code) - 1, F.lit(0))).alias("b")),
                       lambda p: p["a"] * ALPHABET + p["b"])


def train(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each of the 128 x 128 transitions."""
    found = base_spans(docs.select(F.col(text_col).alias("text")))
    plain = F.filter("__ss_run", lambda r: ~r["value"].rlike("[0-9]"))
    labelled = found.select(F.explode(F.concat(
        F.transform("__ss_base", lambda s: F.struct(F.lit(True).alias("random"), s["value"].alias("value"))),
        F.transform(plain, lambda s: F.struct(F.lit(False).alias("random"), s["value"].alias("value"))))).alias("s"))
    counts = labelled.select("s.random", F.explode(_pairs(F.col("s.value"))).alias("pair")) \
        .groupBy("pair").agg(F.sum(F.col("random").cast("long")).alias("r"), F.sum((~F.col("random")).cast("long")).alias("p"))
    return ratios({r["pair"]: (r["r"], r["p"]) for r in counts.collect()})


def ratios(counts: dict[int, tuple[int, int]]) -> list[float]:
    """First-order chains of both kinds as one table of log ratios.

    Random strings: half learned, half all characters alike. Identifiers: learned, with one
    count that follows how often each character occurs among identifiers at all.
    """
    import math

    letters = [ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."]
    total = len(letters)
    seen = {b: sum(counts.get(a * ALPHABET + b, (0, 0))[1] for a in letters) for b in letters}
    plain_all = sum(seen.values())
    table = [0.0] * (ALPHABET * ALPHABET)
    for a in letters:
        row = [counts.get(a * ALPHABET + b, (0, 0)) for b in letters]
        random, plain = sum(r for r, _ in row), sum(p for _, p in row)
        for b, (r, p) in zip(letters, row):
            as_random = 0.5 / total + 0.5 * (r / random if random else 1.0 / total)
            letter = (seen[b] + PLAIN_PRIOR) / (plain_all + PLAIN_PRIOR * total)
            table[a * ALPHABET + b] = math.log(as_random) - math.log((p + letter) / (plain + 1.0))
    return table


def scan_secrets(docs: DataFrame, table: list[float], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The input with ``secret_spans``: kind, start, end and value of all spans, by start, then kind."""
    weights = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")
    mixed = "(?=.*[A-Z])(?=.*[a-z])|(?=.*[0-9])(?=.*[A-Za-z])"
    found = base_spans(docs.drop("secret_spans"), text_col)
    found = found.withColumn("__ss_run", F.transform(
        F.filter("__ss_run", lambda r: r["value"].rlike(mixed)),
        lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["value"].alias("value"),
                           _pairs(r["value"]).alias("pairs"))))
    found = found.withColumn("__ss_run", F.filter("__ss_run", lambda r: F.aggregate(
        r["pairs"], F.lit(0.0), lambda acc, p: acc + F.get(weights, p)) > F.lit(threshold) * F.size(r["pairs"])))

    def tagged(col: str, rank: int) -> Column:
        return F.transform(col, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                   s["end"].alias("end"), s["value"].alias("value")))

    spans = F.array_sort(F.concat(*(tagged(f"__ss_{k}", i) for i, k in enumerate(("assign", "access", "hex", "run")))))
    kinds = F.array(*map(F.lit, KINDS))
    return found.withColumn("secret_spans", F.transform(spans, lambda s: F.struct(
        F.get(kinds, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))) \
        .drop("__ss_assign", "__ss_access", "__ss_hex", "__ss_base", "__ss_run")


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def mask_secrets(docs: DataFrame, table: list[float], text_col: str = "text", mask: str = "<secret>") -> DataFrame:
    """The documents with every span (overlapping ones as one) replaced by ``mask``; a null text stays null."""
    found = scan_secrets(docs, table, text_col)
    # Walk the spans by start; keep the text before each and where the covered part ends.
    step = F.aggregate("secret_spans", F.struct(F.lit("").alias("done"), F.lit(0).alias("at")), lambda acc, s: F.when(
        s["start"] >= acc["at"], F.struct(F.concat(acc["done"], F.substring(F.col(text_col), acc["at"] + 1,
                                                                            s["start"] - acc["at"]), F.lit(mask)).alias("done"),
                                          s["end"].alias("at")))
        .otherwise(F.struct(acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))))
    masked = F.when(F.size("secret_spans") == 0, F.col(text_col)).otherwise(F.concat(
        F.col("__ss_walk.done"), F.expr(f"substring(`{text_col}`, __ss_walk.at + 1)")))
    return found.withColumn("__ss_walk", step).withColumn(text_col, masked).drop("__ss_walk", "secret_spans")


def q_secrets(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = scan_secrets(docs, train(docs))
    base = F.filter("secret_spans", lambda s: s["kind"] != "markov")

    def count(kind):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
                        spans_text(F.col("secret_spans")).alias("spans"))
