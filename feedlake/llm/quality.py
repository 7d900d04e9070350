"""Line-first quality rules: judge each line, drop failing ones, then judge the document.

A line fails when one of these holds (n its words):

* punctuation: more than 0.3 n characters of ``[#*$%&<>]`` or pairs ``!!``, n >= 3;
* shouting: n >= 5 and every cased letter is upper case;
* navigation: at least 3 separators ``|`` and more than n / 5 of them;
* repetition: n >= 10 and more than half of the words equal the word before;
* boilerplate: n <= 40 and the line holds one of ``BOILERPLATE``.

A document that loses more than half of its words, or keeps fewer than 20, is
rejected. The document-wide base counts (symbols, repeated lines and 8-word windows) are
judged beside this; both verdicts must be good.

Defined cases: null text has no words and fails; empty lines have no words and never
fail; repeated rows are judged each on their own; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import documents, map_arrow

MIN_WORDS = 20
LOSS = 0.5
SHINGLE = 8
# Phrases of licence, consent and navigation lines.
BOILERPLATE = ("licensed under", "all rights reserved", "terms of use", "terms of service", "privacy policy",
               "cookie policy", "uses cookies", "accept cookies", "enable javascript", "subscribe to our newsletter",
               "click here", "sign in to", "log in to", "skip to content", "back to top", "lorem ipsum")
PHRASES = re.compile("|".join(map(re.escape, BOILERPLATE)))
SYMBOLS = b"#*$%&|<>"
_ODDS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) | 1 for i in range(SHINGLE)], np.uint64)


def line_fails(line: bytes) -> str | None:
    """The rule that a line (UTF-8) breaks, or None."""
    words = line.split()
    n = len(words)
    marks = sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"<", b">"))) + line.count(b"!!")
    if n >= 3 and 10 * marks > 3 * n:
        return "punctuation"
    if (bars := line.count(b"|")) >= 3 and 5 * bars > n:
        return "navigation"
    if n >= 5 and line.decode().isupper():
        return "shouting"
    if n >= 10 and 2 * sum(map(bytes.__eq__, words, words[1:])) > n:
        return "repetition"
    if 0 < n <= 40 and PHRASES.search(line.lower().decode()):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes], size: int = SHINGLE) -> int:
    """Words that lie in a ``size``-word window found twice or more."""
    n = len(words)
    if n <= size:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.uint64, n) + np.uint64(1)
    key = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        x = ids[i:n - size + 1 + i] * _ODDS[i]
        key += x ^ (x >> np.uint64(29))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    edge[:len(key)] += hit
    edge[size:size + len(key)] -= hit
    return int((np.cumsum(edge)[:n] > 0).sum())


def clean(text: str | None, min_words: int = MIN_WORDS, loss: float = LOSS) -> dict:
    """All counts of one text, its kept lines and the verdict."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    blanks = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = raw.split(b"\n")
    seen, dups = set(), 0
    kept, left = [], 0
    for line in lines:
        k = len(line.split())
        if k:
            dups += line in seen
            seen.add(line)
        if line_fails(line) is None:
            kept.append(line)
            left += k
    repeat = repeated_words(words)
    failed = n < min_words or 100 * repeat > 30 * n
    return {"n_words": n, "word_chars": len(text or "") - blanks, "n_symbols": sum(raw.count(bytes([c])) for c in SYMBOLS),
            "n_dup_lines": dups, "n_repeat_words": repeat, "base_failed": failed,
            "kept": not failed and left >= min_words and left >= (1.0 - loss) * n,
            "n_lines": len(lines), "n_lines_removed": len(lines) - len(kept), "n_words_left": left,
            "text": b"\n".join(kept).decode()}


SCHEMA = pa.schema([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                    ("kept", pa.bool_()), ("n_lines", pa.int64()), ("n_lines_removed", pa.int64()),
                    ("n_words_left", pa.int64()), ("text", pa.string())])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True,
                  min_words: int = MIN_WORDS, loss: float = LOSS) -> DataFrame:
    """Counts, verdict and (``with_text``) the cleaned text of every document."""
    fields = [f for f in SCHEMA if with_text or f.name != "text"]

    def run(it):
        for b in it:
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                found = [clean(t, min_words, loss) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([f[x.name] for f in found], x.type) for x in fields)],
                    ["doc_id", *(x.name for x in fields)])

    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .transform(map_arrow, run, "doc_id long, " + ", ".join(f"{x.name} {names[x.type]}" for x in fields))


def q_quality(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir), with_text=False)


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
x AS (SELECT doc_id, t, string_split(t, chr(10)) AS ls, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
wi AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM x WHERE len(ws) >= 8),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k FROM wi),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rw AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, unnest(range(0, 8)) AS j FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS p FROM x),
lw AS (SELECT doc_id, line, p, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM l),
lj AS (SELECT *, len(w) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY p) AS nth,
       len(regexp_replace(line, '[^#*$%&<>]', '', 'g')) + (len(line) - len(replace(line, '!!', ''))) / 2 AS marks,
       len(line) - len(replace(line, '|', '')) AS bars,
       len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS same FROM lw),
lf AS (SELECT *, (n >= 3 AND 10 * marks > 3 * n) OR (bars >= 3 AND 5 * bars > n)
       OR (n >= 5 AND upper(line) = line AND lower(line) <> line) OR (n >= 10 AND 2 * same > n)
       OR (n BETWEEN 1 AND 40 AND regexp_matches(lower(line), '__PHRASES__')) AS bad FROM lj),
la AS (SELECT doc_id, count(*) FILTER (WHERE n > 0 AND nth > 1) AS n_dup_lines, count(*) AS n_lines,
       count(*) FILTER (WHERE bad) AS n_lines_removed, coalesce(sum(n) FILTER (WHERE NOT bad), 0) AS n_words_left
       FROM lf GROUP BY doc_id),
b AS (SELECT x.doc_id, len(ws) AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
      len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, la.n_dup_lines, coalesce(rw.n, 0) AS n_repeat_words,
      n_lines, n_lines_removed, n_words_left
      FROM x JOIN la ON x.doc_id = la.doc_id LEFT JOIN rw ON x.doc_id = rw.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words_left >= 20
       AND 2 * n_words_left >= n_words AS kept, n_lines, n_lines_removed, CAST(n_words_left AS BIGINT) AS n_words_left
FROM b
""".replace("__PHRASES__", "|".join(BOILERPLATE))
