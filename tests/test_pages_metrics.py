"""Page chains, listings, run days, metric series."""

import datetime as dt

from pyspark.sql import functions as F

from estate.operators import filters, metrics, pages

PAGE_SCHEMA = ("workspace_name string, dataset string, day date, page_no int, "
               "continuation_token string, value array<struct<id:string, name:string, extra:int>>")


def _page(ws, n, tok, items, ds="pipelines", day=None):
    return (ws, ds, day, n, tok, [(f"{ws}-{n}-{i}", f"n{i}", i) for i in range(items)])


def test_chain_stops_at_null_token_gap_and_cap(spark):
    rows = ([_page("a", n, None if n == 3 else "t", 2) for n in range(1, 6)]       # ends at 3
            + [_page("b", n, "t", 1) for n in (1, 2, 4)]                           # gap after 2
            + [_page("c", n, "t", 1) for n in (2, 3)]                              # no page 1
            + [_page("d", n, "t", 1) for n in range(1, 10)])                       # cap 4 -> 5 pages
    df = spark.createDataFrame(rows, PAGE_SCHEMA)
    got = pages.reachable_pages(df, max_pages=4).groupBy("workspace_name").agg(
        F.max("page_no").alias("m"), F.count("*").alias("n")).collect()
    assert {r.workspace_name: (r.m, r.n) for r in got} == {"a": (3, 3), "b": (2, 2), "d": (5, 5)}


def test_flatten_keep_remove(spark):
    df = spark.createDataFrame([_page("a", 1, None, 3)], PAGE_SCHEMA)
    out = pages.flatten(df, keep=["id", "name"], remove=["name"])
    assert out.columns == ["workspace_name", "dataset", "id"] and out.count() == 3
    # entries are compared with lower-cased field names as given
    assert pages.flatten(df, keep=["ID", "extra"]).columns == ["workspace_name", "dataset", "extra"]
    assert pages.read_listing(df, "pipelines", keep=[]).columns[-3:] == ["id", "name", "extra"]


def test_runs_partition_by_day(spark):
    rows = [_page("a", 1, None, 2, "pipeline_runs", dt.date(2024, 1, 1)),
            _page("a", 1, None, 1, "pipeline_runs", dt.date(2024, 1, 2))]
    df = spark.createDataFrame(rows, PAGE_SCHEMA)
    got = pages.runs(df, "pipeline_runs", days=[dt.date(2024, 1, 2)]).collect()
    assert [(r.last_upd, r.id) for r in got] == [(dt.date(2024, 1, 2), "a-1-0")]


def test_day_window_local_tz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 3, 0),), (dt.datetime(2024, 1, 10, 6, 0),),
                                (dt.datetime(2023, 11, 11, 12, 0),)], "ts timestamp_ntz")
    got = filters.day_partitions(df, "ts", "America/New_York", dt.date(2024, 1, 10)).collect()
    # 03:00 UTC is still Jan 9 in New York (kept); 06:00 UTC is Jan 10 (today, excluded);
    # Nov 11 is 60 days back (excluded).
    assert [(r.ts.hour, r.last_upd) for r in got] == [(3, dt.date(2024, 1, 9))]
    assert len(filters.day_list(dt.date(2024, 1, 10))) == 59


def test_metric_flatten_and_coarsen(spark):
    pt = lambda m, v: (dt.datetime(2024, 1, 1, 0, m), v, 1.0, v, v, v)
    resp = [("r", "CPUPercent", [([pt(0, 1.0), pt(15, 3.0)],), ([pt(30, 5.0)],)])]
    schema = ("resource_id string, name string, timeseries array<struct<data: array<struct<"
              "timestamp: timestamp_ntz, average: double, count: double, maximum: double, "
              "minimum: double, total: double>>>>")
    flat = metrics.flatten(spark.createDataFrame(resp, schema))
    assert flat.columns == ["resource_id", "name", "timestamp", "average", "count", "maximum",
                            "minimum", "total"]
    assert flat.count() == 3
    r = metrics.coarsen(flat, "1 hour").first()
    assert (r["count"], r.total, r.average, r.minimum, r.maximum) == (3.0, 9.0, 3.0, 1.0, 5.0)


def test_profile_filters_names_and_span(spark):
    rows = [("r", "CPUPercent", dt.datetime(2024, 4, 1), 1.0),
            ("r", "CPUPercent", dt.datetime(2023, 12, 1), 2.0),      # older than 90 days
            ("r", "NotAMetric", dt.datetime(2024, 4, 1), 3.0)]
    df = spark.createDataFrame(rows, "resource_id string, name string, ts timestamp_ntz, value double")
    got = metrics.profile(df, "dedicated").collect()
    assert [(r.name, r.total) for r in got] == [("CPUPercent", 1.0)]


def test_json_dumps_roundtrip_through_operators(spark, root):
    from estate import schemas
    from estate.sources import dumps, tables
    from conftest import SF_SMALL
    pool_pages = tables.pool_pages(spark, SF_SMALL)
    dumps.write_dump(pool_pages, f"{root}/pages")
    back = dumps.read_pages(spark, f"{root}/pages", schemas.SQL_POOL)
    a = pages.read_listing(back, "sql_pools").orderBy("id").collect()
    b = pages.read_listing(pool_pages, "sql_pools").orderBy("id").collect()
    assert a == b and len(a) > 0
    resp = tables.metric_responses(spark, SF_SMALL)
    dumps.write_dump(resp, f"{root}/metrics")
    got = metrics.flatten(dumps.read_metric_responses(spark, f"{root}/metrics"))
    assert got.count() == metrics.flatten(resp).count()


def test_variant_properties_and_case_collisions(spark):
    df = spark.createDataFrame([("w1", '{"tier": 3, "tags": ["a"]}')], "id string, extra_properties string")
    v = filters.as_variant(df, "extra_properties", "absent")
    assert dict(v.dtypes)["extra_properties"] == "variant"
    assert v.select(F.expr("variant_get(extra_properties, '$.tier', 'int')").alias("t")).first().t == 3
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        clash = spark.createDataFrame([(1, 2, 3)], "`Name` int, `name` int, `Other` int")
        out = filters.normalise_names(clash)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    assert out.columns == ["name", "name_2", "other"]
    assert tuple(out.first()) == (1, 2, 3)


def test_first_page_only(spark):
    df = spark.createDataFrame([_page("a", 1, "t", 2), _page("a", 2, None, 3)], PAGE_SCHEMA)
    assert pages.first_page(df, "pipelines").count() == 2


def _loop_reads(pages_by_no, max_pages):
    """The continuation loop stated directly: read page 1, then the next
    page while the last one had a token and at most ``max_pages`` pages were
    read; a page absent from the dump ends the chain."""
    read, k = [], 1
    while k in pages_by_no:
        read.append(k)
        if pages_by_no[k] is None or len(read) > max_pages:
            break
        k += 1
    return read


def test_reachable_pages_matches_the_loop_on_random_dumps(spark):
    import random
    rng = random.Random(3)
    for max_pages in (1, 3, 7):
        rows, want = [], set()
        for c in range(300):
            nums = sorted(rng.sample(range(1, 13), rng.randint(0, 12)))
            chain = {n: (None if rng.random() < 0.15 else f"t{n}") for n in nums}
            ws = f"w{c}"
            rows += [_page(ws, n, tok, 1) for n, tok in chain.items()]
            want |= {(ws, n) for n in _loop_reads(chain, max_pages)}
        df = spark.createDataFrame(rows, PAGE_SCHEMA)
        got = {(r.workspace_name, r.page_no) for r in
               pages.reachable_pages(df, max_pages=max_pages).select("workspace_name", "page_no").collect()}
        assert got == want, (max_pages, sorted(got ^ want)[:5])


def test_zoned_dump_times_become_utc_wall_clock(spark, root):
    """Dumped API objects carry zoned times; staged times are their UTC wall
    clock whatever the session time zone."""
    import json
    import os

    from estate import schemas
    from estate.sources import dumps
    os.makedirs(f"{root}/d")
    objs = [{"id": "a", "name": "p1", "creation_date": "2024-03-10T10:30:00.5Z"},
            {"id": "b", "name": "p2", "creation_date": "2024-03-10T12:30:00+02:00"},
            {"id": "c", "name": "p3", "creation_date": "2024-11-03T01:30:00-07:00"}]
    page = {"workspace_name": "w", "dataset": "sql_pools", "page_no": 1,
            "continuation_token": None, "value": objs}
    with open(f"{root}/d/p.json", "w") as f:
        f.write(json.dumps(page) + "\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = {r.id: r.creation_date for r in pages.read_listing(
                dumps.read_pages(spark, f"{root}/d", schemas.SQL_POOL), "sql_pools").collect()}
            assert got == {"a": dt.datetime(2024, 3, 10, 10, 30, 0, 500000),
                           "b": dt.datetime(2024, 3, 10, 10, 30),
                           "c": dt.datetime(2024, 11, 3, 8, 30)}, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
