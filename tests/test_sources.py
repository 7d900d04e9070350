from pyspark.sql import functions as F

from feedlake.sources import unwrap as uw
from feedlake.sources.sse import sse_frames, sse_records
from feedlake.sources.tables import read_table


def items(spark, body, cfg, pre=None):
    df = spark.createDataFrame([(body,)], "b string")
    v = F.try_parse_json("b")
    if pre:
        v = pre(v)
    return list(df.select(F.transform(uw.unwrap_items(v, cfg), lambda x: F.to_json(x))).first()[0])


def test_unwrap_configs(spark):
    assert items(spark, '{"entity":[{"a":1},{"a":2}]}', uw.BULK) == ['{"a":1}', '{"a":2}']
    assert items(spark, '{"a":1}', uw.BULK) == ['{"a":1}']
    assert items(spark, '[{"a":1}]', uw.BULK) == ['{"a":1}']
    assert items(spark, '{"data":[{"id":"1"}]}', uw.JSONAPI) == ['{"id":"1"}']
    bt = uw.bustime(("routes",))
    assert items(spark, '{"bustime-response":{"routes":{"route":[{"rt":"1"}]}}}', bt, uw.bustime_body) == ['{"rt":"1"}']
    assert items(spark, '{"routes":{"route":{"rt":"1"}}}', bt) == ['{"rt":"1"}']
    assert items(spark, '{"other":1}', bt) == []
    assert items(spark, '"text"', bt) == []
    assert items(spark, '"hello"', uw.ROUTEMATCH) == ['{"data":"hello"}']
    assert items(spark, '{"msgs":{"x":1}}', uw.PASSIO_ALERTS) == []
    assert items(spark, '{"msgs":[{"x":1}]}', uw.PASSIO_ALERTS) == ['{"x":1}']
    assert items(spark, '{"d":[1,2]}', uw.transloc("routes")) == ["1", "2"]
    assert items(spark, '{"d":[],"routes":[3]}', uw.transloc("routes")) == ["3"]
    assert items(spark, '{"d":{"x":1}}', uw.transloc("routes")) == []
    assert items(spark, '{"only":[{"a":1}]}', uw.ROUTEMATCH) == ['{"a":1}']
    assert items(spark, '{"only":"x"}', uw.ROUTEMATCH) == ['"x"']
    assert items(spark, '{"data":{"a":{"b":[1]}}}', uw.ROUTEMATCH) == ['{"a":{"b":[1]}}']
    assert items(spark, '{"a":1,"b":2}', uw.ROUTEMATCH) == ['{"a":1,"b":2}']
    assert items(spark, "{}", uw.ROUTEMATCH) == []
    mp = uw.massport(("routes", "stops"))
    assert items(spark, '{"routes":{"x":1},"stops":[{"s":1}]}', mp) == ['{"s":1}']
    assert items(spark, '{"routes":{"x":1}}', mp) == ['{"routes":{"x":1}}']
    assert items(spark, '{"data":5}', mp) == ["5"]
    assert items(spark, '[{"m":1}]', uw.PASSIO_ALERTS) == []
    assert items(spark, '{"routes":{"route":"x"}}', uw.bustime(("routes",))) == ['{"route":"x"}']
    assert items(spark, '{"routes":"x"}', uw.bustime(("routes",))) == ['"x"']


def test_sse_framing_edges(spark):
    body = ("event: reset\ndata: [{\"id\":1},{\"id\":2}]\n\n"
            "data: {\"a\":\ndata: 1}\n\n"
            "\n\n"
            "event: update\r\ndata: {bad\r\n\r\n"
            "event: update\ndata: {\"id\":3}\n\n"
            "event: add\ndata: {\"tail\":1}\n")
    df = spark.createDataFrame([("c1", body)], "cap string, body string")
    fr = sse_frames(df).orderBy("frame_no").collect()
    assert [(r.event, r.ok) for r in fr] == [("reset", True), ("message", True), ("update", False), ("update", True)]
    rec = sse_records(df).orderBy("frame_no", "item_no").select("event", F.to_json("record").alias("r")).collect()
    assert [(r.event, r.r) for r in rec] == [("reset", '{"id":1}'), ("reset", '{"id":2}'), ("message", '{"a":1}'),
                                             ("update", '{"id":3}')]


def _small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


def _whole_splits(spark):
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


def test_quoted_csv_is_read_in_splits(spark, tmp_path):
    """Quoted commas, quotes and line feeds over split borders; the header once, blank lines and a
    record of many lines; the text is scanned once."""
    import csv

    from feedlake.sources.gtfs import read_gtfs_table
    rows = [(str(i), f'multi "q", {i}\n\nline\n' if i % 7 == 0 else f"plain {i}", "NA" if i % 5 == 0 else "") for i in range(900)]
    rows.append(("900", "long\n" * 2000, "x"))
    with open(tmp_path / "t.txt", "w", newline="", encoding="utf-8-sig") as f:
        w = csv.writer(f, lineterminator="\r\n")
        w.writerow(["id", "note ", "z"])
        w.writerows(rows)
        f.write("\r\n\r\n")
    _small_splits(spark, 700)
    try:
        t = read_gtfs_table(spark, str(tmp_path / "t.txt"), "t", null_tokens=("", "NA"))
        found = t.collect()
        plan = t._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert spark.read.text(str(tmp_path / "t.txt")).rdd.getNumPartitions() > 20
    finally:
        _whole_splits(spark)
    assert t.columns == ["id", "note", "z"]
    assert sorted(map(tuple, found)) == sorted((i, n, None if z in ("", "NA") else z) for i, n, z in rows)
    assert plan.count("FileScan text") == 1


def test_event_stream_lines_equal_cells(spark, tmp_path):
    """Frames cut by split borders, CRLF, multi-line data, comments and an unclosed tail."""
    from feedlake.sources.lines import read_lines
    from feedlake.sources.sse import frame_records, sse_line_frames, sse_records
    frames = []
    for i in range(200):
        name = "" if i % 4 == 0 else f"event: e{i % 3}\n"
        data = f'data: {{"i":\ndata: {i}}}\n' if i % 3 == 0 else f'data: [{{"i": {i}}}, {i}]\n' if i % 3 == 1 else "data: {bad\n"
        frames.append(f": note\n{name}id: {i}\n{data}\n" + ("\n" if i % 11 == 0 else ""))
    body = "".join(frames) + 'event: tail\ndata: {"tail": 1}\n'
    (tmp_path / "a.txt").write_bytes(body.replace("\n", "\r\n").encode())
    (tmp_path / "b.txt").write_bytes(body.encode())
    _small_splits(spark, 300)
    try:
        rows = frame_records(sse_line_frames(read_lines(spark, str(tmp_path)))).collect()
    finally:
        _whole_splits(spark)
    cells = sse_records(spark.createDataFrame([(body,)], "body string")).collect()
    want = sorted((r.event, str(r.record)) for r in cells)
    for name in ("a.txt", "b.txt"):
        assert sorted((r.event, str(r.record)) for r in rows if r.file.endswith(name)) == want
    assert {r.last_id for r in rows} == {str(i) for i in range(200) if i % 3 != 2}


def test_running_total_deals_a_split_to_many_windows(spark, monkeypatch, tmp_path):
    """SRC-02/05: a split's lines are numbered in short stretches, each a window of its own; the total
    runs through them, and one line begins each file."""
    from pyspark.sql import functions as F
    from feedlake.sources import lines as L
    monkeypatch.setattr(L, "STRETCH_BITS", 2)
    files = {"a.txt": [str(i % 3) for i in range(23)], "b.txt": ["5", "0", "7"], "c.txt": ["1"]}
    for name, rows in files.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    got = L.running_total(L.read_lines(spark, str(tmp_path)), F.col("value").cast("int"), "before", first="first")
    rows = sorted((r.file.rsplit("/", 1)[1], r.seq, int(r.value), r.before, r.first) for r in got.collect())
    for name, values in files.items():
        mine, past = [r for r in rows if r[0] == name], 0
        assert [r[2] for r in mine] == [int(v) for v in values]
        for i, r in enumerate(mine):
            assert (r[3], r[4]) == (past, i == 0)
            past += r[2]


def test_one_row_group_cut_into_byte_ranges_is_spread(spark, tmp_path):
    """A scan with enough byte ranges, all rows of which lie in one of them."""
    spark.range(20_000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS h").coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        scan, dealt = (read_table(spark, str(tmp_path), "t", parallel=p) for p in (False, True))
        sizes = [[r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()] for d in (scan, dealt)]
        splits = scan.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert splits > 4 and sizes[0] == [20_000]
    assert sum(sizes[1]) == 20_000 and max(sizes[1]) <= 2 * 20_000 / splits
