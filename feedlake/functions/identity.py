"""Content hashes and canonical JSON (IDN-01..06).

Hashes are ``sha2(…, 256)`` over text built with native expressions; no Python
runs per row. Canonical JSON is ``to_json(parse_json(x))``: variant objects keep
their keys sorted, and the output is compact. A variant forgets how a number was
written, so a text with fractions, exponents or long integers goes through it with its
numbers held as strings, and each comes out as ``json.dumps`` writes it (``python_number``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# One JSON token: a string literal (escapes taken in pairs) or a stretch without a quote. Possessive, so
# the matcher never goes back: linear time and no recursion, whatever the length.
_TOKEN = r'(?s)"(?:[^"\\]++|\\.)*+"|[^"]++'
# What stands before a separator and the separator, each match where the last one ended (never inside a string).
_UP_TO_SEPARATOR = r'(?s)\G((?:"(?:[^"\\]++|\\.)*+"|[^",:]++)*+[,:])'


def as_variant(col) -> Column:
    """JSON text -> VARIANT (null when the text is not JSON); VARIANT passes through."""
    return F.try_parse_json(_c(col))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` several times (a lambda binding:
    ``transform(array(value), body)[0]``), so a costly expression is not repeated."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_escape(text) -> Column:
    """Escape every character outside printable ASCII as ``\\uXXXX`` (lower-case hex,
    characters beyond the BMP as a UTF-16 surrogate pair), as ``json.dumps`` does by
    default. Applied to JSON text, where such characters only occur inside strings.
    Rows without such characters are returned unchanged without splitting."""
    def body(t):
        parts = F.regexp_extract_all(t, F.lit(r"[ -~]++|[^ -~]"), F.lit(0))
        escaped = F.transform(parts, lambda ch: F.when(ch.rlike(r"^[ -~]"), ch).otherwise(
            F.regexp_replace(F.lower(F.hex(F.encode(ch, "UTF-16BE"))), r"(.{4})", r"\\u$1")))
        return F.when(t.rlike(r"[^ -~]"), F.array_join(escaped, "")).otherwise(t)
    return let(_c(text), body)


def lower_unicode_escapes(text) -> Column:
    """Spark writes control characters as ``\\u001F`` (upper-case hex) where Python
    writes ``\\u001f``; only ``\\u000B/E/F`` and ``\\u001A``..``F`` differ. Escapes are read in
    pairs from the left, so a backslash that is itself escaped never starts one."""
    def body(t):
        parts = F.regexp_extract_all(t, F.lit(r"(?s)\\u00[01][A-F]|\\.|[^\\]++"), F.lit(0))
        lowered = F.transform(parts, lambda x: F.when(x.rlike(r"^\\u00[01][A-F]$"), F.lower(x)).otherwise(x))
        return F.when(t.rlike(r"\\u00[01][A-F]"), F.array_join(lowered, "")).otherwise(t)
    return let(_c(text), body)


def spaced_separators(text) -> Column:
    """Compact JSON text with ``, `` and ``: `` between values, string literals untouched."""
    return F.regexp_replace(_c(text), _UP_TO_SEPARATOR, "$1 ")


# Characters beyond U+FFFF, as they are or escaped: a variant sorts keys by UTF-16, Python by code point,
# so each gets U+FFFF in front while keys are sorted.
_BEYOND = r"[\x{10000}-\x{10FFFF}]"
_ESCAPED_PAIR = r"(?<!\\)((?:\\\\)*)(\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2})"
# What a variant may not give back as Python would: a number with a fraction, an exponent or 16 digits and more,
# -0, and a character beyond U+FFFF. May also hit inside strings, which costs time only.
_TELLING = r"[0-9][.eE]|[0-9]{16}|-0|\\u[dD][89abAB]|" + _BEYOND
_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
# Number texts that Python writes as they are: integers, and plain floats of up to 15 digits without a zero too many.
_AS_IS = (r"-?(?:[1-9][0-9]*|0\.0|0\.0{0,3}(?:[1-9][0-9]{0,9})?[1-9]|[1-9][0-9]{0,13}\.0|[1-9][0-9]{0,6}\.[0-9]{0,7}[1-9])|0")
# A string literal's inside. Numbers are held on the way through a variant as strings, both told by their first character.
_INSIDE = r'(?:[^"\\]++|\\.)*+'
_HOLD = rf'(?s)"({_INSIDE})"|({_NUMBER})'
_RELEASE = rf'(?s)(")s({_INSIDE}")|"({_AS_IS})s"|"([-0-9][^"s]*+)s"'
# At most 15 digits and an exponent of two.
_SHORT = r"^-?(?:[0-9]{1,15}|(?=[0-9.]{3,16}(?![0-9.]))[0-9]+\.[0-9]+)(?:[eE][+-]?[0-9]{1,2})?$"
# Up to 15 significant digits a decimal is the shortest text of its own double.
_SURE_DIGITS, _SURE_EXPONENT = 15, 290


# The rules below are SQL text, not Columns: the tree is large, and the session's parser builds it in one call.
# Each function takes SQL expressions and gives one; variables of nested lambdas have names of their own.

def _sql_let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _sql_tokens(text: str, name: str, body: str) -> str:
    return f"array_join(transform(regexp_extract_all({text}, r'{_TOKEN}', 0), {name} -> {body}), '')"


def _sql_scientific(text: str, name: str, body) -> str:
    """``body(digits, exponent)`` of a number's text: significant digits without zeros at either
    end ('' for zero) and the power of ten of the first; exponent null beyond an int."""
    whole, fraction = f"regexp_extract({text}, r'^-?([0-9]+)', 1)", f"regexp_extract({text}, r'\\.([0-9]+)', 1)"
    power = f"try_cast(coalesce(nullif(regexp_extract({text}, r'[eE]([+-]?[0-9]+)$', 1), ''), '0') AS INT)"
    head = f"regexp_replace({name}a.v, '^0+', '')"
    at = f"{name}a.w - 1 - (length({name}a.v) - length({head})) + CAST({name}a.p AS BIGINT)"
    parts = f"named_struct('d', regexp_replace({head}, '0+$', ''), 'n', {at})"
    return _sql_let(f"named_struct('v', concat({whole}, {fraction}), 'w', length({whole}), 'p', {power})", f"{name}a",
                    _sql_let(parts, f"{name}b", body(f"{name}b.d", f"{name}b.n")))


def _sql_shortest(text: str, name: str, body) -> str:
    """``body(digits, exponent)`` of the shortest text of the positive double that ``text`` reads as.

    The JVM may write one or two digits too many; a shorter text that reads as the same double is taken.
    """
    x = f"{name}x"

    def fewer(d, n):
        def cut(k):
            digits = f"CAST(CAST(round(CAST({d} AS DECIMAL(38,0)) / CAST({10 ** k} AS DECIMAL(38,0)), 0) AS DECIMAL(38,0)) AS STRING)"
            return f"concat({digits}, 'e', CAST({n} - length({d}) + {1 + k} AS STRING))"
        same = [f"CASE WHEN length({d}) > {k} AND {x} = CAST({cut(k)} AS DOUBLE) THEN {cut(k)} END" for k in (2, 1)]
        return f"coalesce({', '.join(same)}, concat({d}, 'e', CAST({n} - length({d}) + 1 AS STRING)))"
    return _sql_let(f"abs(CAST({text} AS DOUBLE))", x,
                    _sql_let(_sql_scientific(f"CAST({x} AS STRING)", f"{name}s", fewer), f"{name}t",
                             _sql_scientific(f"{name}t", f"{name}u", body)))


def _sql_python_float(d: str, n: str) -> str:
    """Text of a positive float as Python's ``repr`` lays it out: plain from 1e-4 to 1e16."""
    at = f"CAST({n} AS INT)"
    large = (f"CASE WHEN length({d}) <= {at} + 1 THEN concat(rpad({d}, {at} + 1, '0'), '.0') "
             f"ELSE concat(substr({d}, 1, {at} + 1), '.', substr({d}, {at} + 2)) END")
    small = f"concat('0.', repeat('0', -{at} - 1), {d})"
    wide = (f"concat(substr({d}, 1, 1), CASE WHEN length({d}) > 1 THEN concat('.', substr({d}, 2)) ELSE '' END, "
            f"CASE WHEN {n} < 0 THEN 'e-' ELSE 'e+' END, CASE WHEN abs({n}) < 10 THEN '0' ELSE '' END, CAST(abs({n}) AS STRING))")
    return f"CASE WHEN {n} >= 0 AND {n} < 16 THEN {large} WHEN {n} < 0 AND {n} >= -4 THEN {small} ELSE {wide} END"


def _sql_plain_float(text: str, name: str) -> str:
    """Python's text of a float that is written with at most 15 digits and laid out without an exponent
    (from 1e-4 to 1e16): that of its exact decimal; null for any other."""
    d = f"{name}d"
    digits = _sql_let(f"rtrim('0', CAST({d} AS STRING))", f"{name}z", f"CASE WHEN endswith({name}z, '.') THEN concat({name}z, '0') ELSE {name}z END")
    plain = f"CASE WHEN abs({d}) >= 0.0001BD AND abs({d}) < 10000000000000000BD THEN {digits} END"
    return f"CASE WHEN {text} RLIKE r'{_SHORT}' THEN {_sql_let(f'try_cast({text} AS DECIMAL(38,19))', d, plain)} END"


def _sql_python_number(text: str, name: str) -> str:
    sure = _sql_scientific(text, f"{name}q", lambda d, n: f"CASE WHEN {d} = '' THEN '0.0' WHEN length({d}) <= {_SURE_DIGITS} "
                           f"AND abs({n}) <= {_SURE_EXPONENT} THEN {_sql_python_float(d, n)} END")
    plain = _sql_plain_float(text, name)
    unsure = (f"CASE WHEN abs(CAST({text} AS DOUBLE)) = CAST('Infinity' AS DOUBLE) THEN 'Infinity' WHEN CAST({text} AS DOUBLE) = 0D THEN '0.0' "
              f"ELSE {_sql_shortest(text, f'{name}r', _sql_python_float)} END")
    sign = f"CASE WHEN startswith({text}, '-') THEN '-' ELSE '' END"
    return (f"CASE WHEN {text} RLIKE '^-?0$' THEN '0' WHEN {text} RLIKE '^-?[0-9]+$' THEN {text} "
            f"ELSE coalesce({plain}, concat({sign}, coalesce({sure}, {unsure}))) END")


def _sql_lower_escapes(text: str, name: str) -> str:
    """``lower_unicode_escapes`` as SQL."""
    parts = (f"array_join(transform(regexp_extract_all({name}, r'(?s)\\\\u00[01][A-F]|\\\\.|[^\\\\]++', 0), {name}p -> "
             f"CASE WHEN {name}p RLIKE r'^\\\\u00[01][A-F]$' THEN lower({name}p) ELSE {name}p END), '')")
    return _sql_let(text, name, f"CASE WHEN {name} RLIKE r'\\\\u00[01][A-F]' THEN {parts} ELSE {name} END")


def _sql_sorted_with_numbers(text: str) -> str:
    """Key-sorted compact JSON with every number as Python writes it. The sorted text comes with the numbers
    that may be written otherwise between control characters (JSON has none), so every second piece is one."""
    marked = f"CASE WHEN {text} RLIKE r'\\\\u[dD][89abAB]|{_BEYOND}' THEN {_sql_marked_by_token(text)} ELSE {_sql_marked_in_passes(text)} END"
    return f"array_join(transform(split({marked}, '\\u0001'), (q, i) -> CASE WHEN i % 2 = 1 THEN {_sql_python_number('q', 'o')} ELSE q END), '')"


def _sql_marked_in_passes(text: str) -> str:
    """Of a text without characters beyond U+FFFF: on the way through the variant a string (a key too) is marked
    ``s`` in front and a number is a string marked ``s`` behind; one pass holds them and one releases them."""
    held = f"regexp_replace({text}, r'{_HOLD}', '\"$2s$1\"')"
    sorted_text = _sql_lower_escapes(f"to_json(try_parse_json({held}))", "w")
    return f"replace(regexp_replace({sorted_text}, r'{_RELEASE}', '$1$2$3\\u0001$4\\u0001'), '\\u0001\\u0001', '')"


def _sql_marked_by_token(text: str) -> str:
    """Of any text, token by token: characters beyond U+FFFF are marked while keys are sorted, strings
    (keys too) are marked ``s`` and numbers become strings marked ``n`` on the way through the variant."""
    string = f"regexp_replace(regexp_replace(substr(h, 2), r'{_ESCAPED_PAIR}', r'$1\\\\uffff$2'), r'{_BEYOND}', '\\uffff$0')"
    hold = f"CASE WHEN startswith(h, '\"') THEN concat('\"s', {string}) ELSE regexp_replace(h, r'{_NUMBER}', '\"n$0\"') END"
    back = f"concat('\"', regexp_replace(substr(g, 3), concat('\\uffff', r'({_BEYOND})'), '$1'))"
    number = "concat('\\u0001', substr(g, 3, length(g) - 3), '\\u0001')"
    release = f"CASE WHEN startswith(g, '\"s') THEN {back} WHEN startswith(g, '\"n') THEN {number} ELSE g END"
    sorted_text = _sql_lower_escapes(f"to_json(try_parse_json({_sql_tokens(text, 'h', hold)}))", "e")
    return _sql_tokens(sorted_text, "g", release)


def _sql_ascii(text: str, name: str) -> str:
    """``ascii_escape`` as SQL."""
    escaped = (f"array_join(transform(regexp_extract_all({name}, r'[ -~]++|[^ -~]', 0), {name}p -> CASE WHEN {name}p RLIKE r'^[ -~]' THEN {name}p "
               f"ELSE regexp_replace(lower(hex(encode({name}p, 'UTF-16BE'))), r'(.{{4}})', r'\\\\u$1') END), '')")
    return _sql_let(text, name, f"CASE WHEN {name} RLIKE r'[^ -~]' THEN {escaped} ELSE {name} END")


def _sql_string_json(value: str, name: str) -> str:
    """A value as a JSON string literal, null as ``null``."""
    literal = _sql_let(f"to_json(named_struct('v', {value}))", f"{name}j", f"substr({name}j, 6, length({name}j) - 6)")
    return f"CASE WHEN {value} IS NULL THEN 'null' ELSE {_sql_ascii(_sql_lower_escapes(literal, f'{name}l'), f'{name}a')} END"


def _sql_payload(value: str, name: str) -> str:
    """Canonical text of a payload, of one that is no JSON as a JSON string; null as ``null``."""
    sorted_text = _sql_ascii(_sql_let(value, "doc", _sql_sorted_with_numbers("doc")), f"{name}s")
    return f"CASE WHEN try_parse_json({value}) IS NOT NULL THEN {sorted_text} ELSE {_sql_string_json(value, name)} END"


def _sql_line(with_metadata: bool) -> str:
    """The text that IDN-03 hashes, of a struct of its fields."""
    parts = [("agency", _sql_string_json), ("data", _sql_payload), ("endpoint", _sql_string_json), ("event", _sql_string_json),
             *([("metadata", _sql_payload)] if with_metadata else []), ("stream", _sql_string_json)]
    text = ", ".join(f"'{',' if i else '{'}\"{name}\":', {rule(f'r.{name}', f'v{i}')}" for i, (name, rule) in enumerate(parts))
    return f"r -> concat({text}, '}}')"


_NUMBER_RULE = "t -> " + _sql_python_number("t", "t")
_SORTED_RULE = "doc -> " + _sql_sorted_with_numbers("doc")
_LINE_RULES = {flag: _sql_line(flag) for flag in (True, False)}


def _apply(rule: str, value: Column) -> Column:
    """A rule (a lambda in SQL text) on one value."""
    return F.element_at(F.call_function("transform", F.array(value), F.expr(rule)), 1)


def python_number(text) -> Column:
    """A JSON number's text -> the text that Python's ``json`` gives it back as: integers digit by
    digit, floats as the shortest text of their double (``1.50`` -> ``1.5``, ``1E5`` -> ``100000.0``)."""
    return _apply(_NUMBER_RULE, _c(text))


def canonical_json(col, style: str = "compact", is_variant: bool = False, ensure_ascii: bool = True) -> Column:
    """Key-sorted JSON text at every depth (IDN-06).

    ``compact`` uses ``,`` and ``:``; ``python`` uses ``, `` and ``: `` like a
    default ``json.dumps(…, sort_keys=True)``. With ``ensure_ascii`` non-ASCII
    characters are ``\\u``-escaped like ``json.dumps``. Numbers come out as ``json.dumps``
    writes what ``json.loads`` read; a variant (``is_variant``) has lost their text, so its
    floats follow Spark. Text that is not JSON gives null.
    """
    v = _c(col) if is_variant else as_variant(col)
    out = lower_unicode_escapes(F.to_json(v))
    if not is_variant:
        out = F.when(v.isNotNull() & _c(col).rlike(_TELLING), _apply(_SORTED_RULE, _c(col))).otherwise(out)
    if ensure_ascii:
        out = ascii_escape(out)
    if style == "python":
        out = spaced_separators(out)
    return out


def payload_json(col, style: str = "compact") -> Column:
    """Canonical text of a payload: of its JSON value, or of the text as a JSON string; null stays null."""
    text = F.when(_c(col).isNotNull(), ascii_escape(lower_unicode_escapes(json_string(col))))
    return F.coalesce(canonical_json(col, style), text)


def json_string(col) -> Column:
    """A string value as a JSON string literal (quotes and escapes)."""
    return F.to_json(F.struct(_c(col).alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(_c(col).alias("v")))) - 6)


def payload_variant(col) -> Column:
    """JSON text as its value; any other text (not JSON, or with a repeated key) as a JSON
    string, so that different payloads never share a hash; null stays null."""
    c = _c(col)
    return F.coalesce(as_variant(c), F.try_parse_json(json_string(c)))


def event_hash_pipe(endpoint, event, id_, data, agency=None, data_is_variant: bool = False) -> Column:
    """``sha256("[agency|]endpoint|event|id|json(data, sorted, python separators)")`` (IDN-01/02).

    Time is excluded so equal records hash equal across days. Null data is ``null``.
    """
    parts = [] if agency is None else [_c(agency)]
    text = canonical_json(data, "python", is_variant=True) if data_is_variant else payload_json(data, "python")
    parts += [_c(endpoint), _c(event), F.coalesce(_c(id_).cast("string"), F.lit("")), F.coalesce(text, F.lit("null"))]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def event_hash_struct(agency, stream, event, endpoint, data, metadata=None,
                      data_is_variant: bool = False, with_metadata: bool = True) -> Column:
    """``sha256(json{agency, data, endpoint, event[, metadata], stream})`` compact, sorted (IDN-03).

    This is the default identity of an envelope: it covers everything except the
    capture time. Payloads that are not JSON enter as JSON strings.
    """
    def text(data_value: Column, metadata_value: Column) -> Column:
        fields = [_c(agency).cast("string").alias("agency"), data_value.alias("data"),
                  F.coalesce(_c(endpoint).cast("string"), F.lit("")).alias("endpoint"),
                  _c(event).cast("string").alias("event")]
        if with_metadata:
            fields.append(metadata_value.alias("metadata"))
        fields.append(_c(stream).cast("string").alias("stream"))
        return ascii_escape(lower_unicode_escapes(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})))

    m = F.lit(None).cast("variant") if metadata is None else payload_variant(metadata)
    if data_is_variant:
        return F.sha2(text(_c(data), m), 256)
    plain = text(payload_variant(data), m)
    telling = F.coalesce(_c(data).rlike(_TELLING), F.lit(False))
    if metadata is not None:
        telling = telling | F.coalesce(_c(metadata).rlike(_TELLING), F.lit(False))
    # Payloads whose numbers must keep their text: the line is built as text around them.
    fields = {"agency": _c(agency), "data": _c(data), "endpoint": F.coalesce(_c(endpoint).cast("string"), F.lit("")), "event": _c(event),
              "metadata": F.lit(None) if metadata is None else _c(metadata), "stream": _c(stream)}
    line = _apply(_LINE_RULES[with_metadata], F.struct(*[c.cast("string").alias(name) for name, c in fields.items()]))
    return F.sha2(F.when(telling, line).otherwise(plain), 256)


def error_hash(agency, ts_text, message) -> Column:
    """``sha256("agency|error|ts|message")`` (IDN-04)."""
    return F.sha2(F.concat_ws("|", _c(agency), F.lit("error"), _c(ts_text), _c(message)), 256)


def row_json(columns: Sequence[str], table: str, ignore_null_columns: bool = False) -> Column:
    """``{"row":{sorted columns as strings},"table":name}`` compact (IDN-05 payload)."""
    row = F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(columns)])
    opts = {"ignoreNullFields": "true" if ignore_null_columns else "false"}
    return F.concat(F.lit('{"row":'), ascii_escape(lower_unicode_escapes(F.to_json(row, opts))), F.lit(',"table":'),
                    json_string(F.lit(table)), F.lit("}"))


def row_hash(columns: Sequence[str], table: str, ignore_null_columns: bool = False) -> Column:
    """GTFS row identity (IDN-05). Column names are part of the hash unless
    ``ignore_null_columns`` drops null cells, so an added empty column keeps keys."""
    return F.sha2(row_json(columns, table, ignore_null_columns), 256)
