"""Row filters and body classifiers (FLT-01..14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.scalars import local_day, strip
from feedlake.schema import DEFAULT_TZ

# Markers of an HTML rejection page instead of data.
HTML_PREFIXES = ("<html", "<!doctype")
REJECTION_MARKER = "<title>request rejected</title>"


def closed_days(df: DataFrame, as_of: Column, tz: str = DEFAULT_TZ, day: str = "day") -> DataFrame:
    """Rows of local days strictly before the local date of ``as_of`` (FLT-01)."""
    return df.filter(F.col(day) < local_day(as_of, tz))


def is_rejection_page(body: Column) -> Column:
    t = F.lower(strip(body))
    cond = None
    for p in HTML_PREFIXES:
        c = t.startswith(p)
        cond = c if cond is None else (cond | c)
    return cond | F.lower(body).contains(REJECTION_MARKER)


def reject_html(df: DataFrame, body: str = "body") -> DataFrame:
    """Classify captured bodies (FLT-05).

    ``empty`` (blank), ``rejected`` (an HTML page or rejection notice), ``json``
    (payload = canonical JSON) or ``text`` (payload = ``{"data": text}``).
    """
    b = F.col(body)
    v = F.try_parse_json(b)
    outcome = (F.when(b.isNull() | (strip(b) == ""), F.lit("empty"))
               .when(is_rejection_page(b), F.lit("rejected"))
               .when(v.isNotNull(), F.lit("json"))
               .otherwise(F.lit("text")))
    payload = (F.when(outcome == "json", F.to_json(v))
               .when(outcome == "text", F.to_json(F.struct(strip(b).alias("data")))))
    return df.withColumn("outcome", outcome).withColumn("payload", payload)


def object_rows(df: DataFrame, v: str) -> DataFrame:
    """Keep rows whose VARIANT is a JSON object (FLT-14; SRC-19 websocket messages)."""
    return df.filter(F.try_variant_get(F.col(v), "$", "map<string,variant>").isNotNull())
