"""Server-sent-event framing over captured text (SRC-02, WIN-03).

Each captured segment (one row, e.g. one file read with ``wholetext``) is split
into frames with higher-order functions only — no window and no shuffle:

* a blank line closes a frame; text after the last blank line is an unclosed
  tail and is dropped;
* ``event:`` sets the frame's name (the last one wins, default ``message``);
* ``data:`` lines are stripped and joined with ``\\n``; a frame without data
  emits nothing;
* a JSON list payload fans out to one row per element; an element that is no object
  is wrapped as ``{"value": element}``;
* with ``keep_empty_reset`` an empty list under a ``reset`` event gives one row with a
  null record, so that a consumer sees that the set was emptied.

Frames whose data is not JSON are returned with ``ok = false`` so callers can
route them to the error sink (SNK-04) instead of losing the rest of the segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.sources.lines import running_total


def _strip(c):
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def sse_frames(df: DataFrame, body_col: str = "body") -> DataFrame:
    """SRC-02, WIN-03: one row per closed frame: input columns (minus body), ``frame_no``,
    ``event``, ``payload`` (joined data text), ``ok`` (payload is JSON)."""
    text = F.regexp_replace(F.regexp_replace(F.col(body_col), "\r\n", "\n"), "\r", "\n")
    parts = F.split(text, "\n\n")
    closed = F.slice(parts, F.lit(1), F.size(parts) - 1)
    keep = [c for c in df.columns if c != body_col]
    frames = df.select(*keep, F.posexplode(closed).alias("frame_no", "_frame"))
    lines = F.split(F.col("_frame"), "\n")
    events = F.filter(lines, lambda x: x.startswith("event:"))
    data = F.transform(F.filter(lines, lambda x: x.startswith("data:")), lambda x: _strip(F.substr(x, F.lit(6))))
    out = frames.select(
        *keep, "frame_no",
        F.coalesce(_strip(F.substr(F.try_element_at(events, F.lit(-1)), F.lit(7))), F.lit("message")).alias("event"),
        F.when(F.size(data) > 0, F.array_join(data, "\n")).alias("payload"))
    out = out.filter(F.col("payload").isNotNull())
    return out.withColumn("ok", F.try_parse_json("payload").isNotNull())


def sse_line_frames(lines: DataFrame) -> DataFrame:
    """SRC-02, WIN-03 for segments of any size: one row per closed frame of a text file read
    line by line (``lines.read_lines``): ``file``, ``frame_no``, ``event``, ``last_id`` (its ``id:``
    field), ``payload``, ``ok``.

    A frame's number is the count of blank lines before it, carried from split to split, so a
    frame that a split border cuts is one frame; only the lines of one frame meet in a task.
    Frames that a blank line does not close are dropped, as are those without data.
    """
    blank = F.col("value") == ""
    telling = lines.where(blank | F.col("value").rlike("^(event|data|id):"))  # other lines count for no frame
    fields = running_total(telling, blank.cast("int"), "frame_no")
    frame = fields.groupBy("file", "frame_no").agg(
        F.max(blank).alias("_closed"),
        F.sort_array(F.collect_list(F.when(~blank, F.struct("block", "seq", "value")))).alias("_lines"))

    def field(name: str):
        hits = F.filter(F.transform("_lines", lambda x: x["value"]), lambda v: v.startswith(f"{name}:"))
        return F.transform(hits, lambda v: _strip(F.substr(v, F.lit(len(name) + 2))))
    data = field("data")
    out = frame.where(F.col("_closed")).select(
        "file", "frame_no", F.coalesce(F.try_element_at(field("event"), F.lit(-1)), F.lit("message")).alias("event"),
        F.try_element_at(field("id"), F.lit(-1)).alias("last_id"),
        F.when(F.size(data) > 0, F.array_join(data, "\n")).alias("payload")).where(F.col("payload").isNotNull())
    return out.withColumn("ok", F.try_parse_json("payload").isNotNull())


def sse_records(df: DataFrame, body_col: str = "body", keep_empty_reset: bool = False) -> DataFrame:
    """Records of closed, parsable frames: a list payload fans out (``item_no``)."""
    return frame_records(sse_frames(df, body_col), keep_empty_reset)


def frame_records(frames: DataFrame, keep_empty_reset: bool = False) -> DataFrame:
    """Records of frames, whole cells' or lines': a list payload fans out (``item_no``)."""
    fr = frames.filter("ok")
    v = F.try_parse_json("payload")
    arr = F.try_variant_get(v, "$", "array<variant>")
    items = F.transform(F.when(arr.isNotNull(), arr).otherwise(F.array(v)), lambda x: F.when(
        F.try_variant_get(x, "$", "map<string,variant>").isNotNull(), x).otherwise(
        F.to_variant_object(F.create_map(F.lit("value"), x))))
    if keep_empty_reset:
        emptied = (F.col("event") == "reset") & (F.size(arr) == 0)
        items = F.when(emptied, F.array(F.lit(None).cast("variant"))).otherwise(items)
    keep = [c for c in fr.columns if c not in ("payload", "ok")]
    return fr.select(*keep, F.posexplode(items).alias("item_no", "record"))
