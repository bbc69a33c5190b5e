"""S1, S3, U1 text and DataFrame forms (no database is started)."""

from estate.sources import jdbc


def test_quoted_names_and_hidden_password():
    assert jdbc.quoted("a]b") == "[a]]b]"
    assert "secret" not in repr(jdbc.PoolConnection(url="jdbc:x", password="secret"))


def test_one_scan_keeps_listed_databases(spark):
    rows = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3), (None, 4)], "table_catalog string, id long")
    names = spark.createDataFrame([("x",), ("z",), ("z",), (None,)], "name string")
    got = jdbc.scan_databases(rows, names)
    assert sorted((r.table_catalog, r.id) for r in got.collect()) == [("x", 1), ("z", 3)]


def test_connection_options():
    c = jdbc.PoolConnection(url=jdbc.pool_url("jdbc:x://{endpoint};database={database}", "h", "d"),
                            user="u", password="p")
    o = c.options()
    assert o["url"] == "jdbc:x://h;database=d" and o["fetchsize"] == "1000" and o["loginTimeout"] == "30"
    assert o["preferTimestampNTZ"] == "true"


def test_union_databases(spark):
    df = jdbc.union_databases(lambda db: spark.range(2).selectExpr("id"), ["x", "y"])
    assert sorted((r.table_catalog, r.id) for r in df.collect()) == [("x", 0), ("x", 1), ("y", 0), ("y", 1)]
    assert jdbc.union_databases(lambda db: spark.range(1), []) is None


def test_catalog_scans_logic_without_a_database(spark, monkeypatch):
    """S4-S8, S14-S17 on stand-in relations: the JDBC call is replaced by a
    function returning DataFrames of the catalog views' columns."""
    import datetime as dt

    from estate.sources import catalog_scans

    dbs = spark.createDataFrame(
        [("master", 1, dt.datetime(2024, 1, 1), 0, "ONLINE", "Latin1_General_CI_AS"),
         ("sales", 5, dt.datetime(2024, 1, 2), 0, "ONLINE", None),
         ("default", 6, dt.datetime(2024, 1, 3), 0, "ONLINE", "X")],
        "name string, database_id int, create_date timestamp, state int, state_desc string, "
        "collation_name string")
    seen = []

    def fake_run_query(spark_, conn, relation):
        seen.append(relation)
        if relation == "sys.databases":
            return dbs
        db = relation.split(".")[0].strip("[]") if relation.count(".") == 2 else "pool"
        return spark.createDataFrame([(db, "t1", "select 1")],
                                     "table_catalog string, table_name string, view_definition string")

    monkeypatch.setattr(catalog_scans, "run_query", fake_run_query)
    conn = jdbc.PoolConnection(url="jdbc:none")
    listed = catalog_scans.databases(spark, conn)
    assert sorted(r.name for r in listed.collect()) == ["default", "sales"]
    scope = catalog_scans.database_names(catalog_scans.databases_in_scope(listed))
    assert scope == ["sales"]
    views = catalog_scans.views(spark, conn, scope, redact_text=True).collect()
    assert [(r.table_catalog, r.view_definition) for r in views] == [("sales", "[REDACTED]")]
    assert "[sales].information_schema.views" in seen
    assert catalog_scans.tables(spark, conn).count() == 1          # dedicated: one database
    assert "information_schema.tables" in seen
    assert catalog_scans.routines(spark, conn, [], redact_text=True) is None
