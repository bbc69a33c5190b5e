"""F1-F4, F10, F11 on the hand-derived cases of FIXTURES.md §3."""

import pytest
from pyspark.sql import functions as F

from estate.functions.sqltext import REDACTED, classify, redact, statement_slice, strip_comments

STRIP_CASES = [
    ("/* a\n b */select 1", "select 1"),
    ("/* ** **/x", "x"),
    ("/* x select", "/* x select"),
    ("/*/ x", "/*/ x"),
    ("/*a*/1/*b*/2", "12"),
    ("-- hi\nselect", "\nselect"),
    ("select 1 -- c", "select 1 -- c"),
    ("\n\n  -- c\nselect", "\n\n\nselect"),
    ("--a\r\nselect", "\nselect"),
    ("select '/*x*/'", "select ''"),
    ("select 1\n--end", "select 1\n"),
    ("/*" + "z" * 200_000 + "*/ok", "ok"),
    ("\u00a0-- nbsp\nx", "\nx"),
    ("\x1c\u3000--a\n\u2003 --b", "\n"),
    ("\x0b--vt", ""),
    (None, None),
]

WORD_CASES = [
    ("SELECT 1", "SELECT", "1", "QUERY"),
    ("(select a from b", "SELECT", "A", "QUERY"),
    ("with x as (select 1) select", "WITH", "X", "QUERY"),
    ("BEGIN TRAN", "BEGIN", "TRAN", "DML"),
    ("BEGIN;COMMIT TRAN", "BEGIN", "TRAN", "DML"),
    ("end transaction", "END", "TRANSACTION", "TRANSACTION_CONTROL"),
    ("exec sp_a.b", "EXEC", "SP_A", "ROUTINE"),
    ("insert into [dbo].[t] values", "INSERT", "INTO", "DML"),
    ("DROP\tTABLE x", "DROP", "TABLE", "DDL"),
    ("{call x}", "CALL", "X}", "OTHER"),
    ("SELECT", "SELECT", "", "QUERY"),
    ("", "", "", "OTHER"),
    ("commit", "COMMIT", "", "TRANSACTION_CONTROL"),
    ("Rollback tran", "ROLLBACK", "TRAN", "TRANSACTION_CONTROL"),
    ("DBCC SHOW_STATISTICS", "DBCC", "SHOW_STATISTICS", "OTHER"),
]


def test_strip_comments(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(STRIP_CASES)], "i int, c string")
    got = dict(df.select("i", strip_comments("c").alias("o")).collect())
    for i, (_, want) in enumerate(STRIP_CASES):
        assert got[i] == want, STRIP_CASES[i][0][:40]


def test_strip_matches_duckdb_oracle_pattern():
    import duckdb
    from estate.functions.sqltext import LINE_BLANKS
    con = duckdb.connect()
    for text, want in STRIP_CASES[:-1]:
        got = con.execute(
            "select regexp_replace(regexp_replace(?, '(?s)/\\*.*?\\*/', '', 'g'), "
            f"'(?m)^{LINE_BLANKS}*--[^\\n]*', '', 'g')", [text]).fetchone()[0]
        assert got == want, repr(text[:30])


def test_words_and_types(spark):
    df = spark.createDataFrame([(i, c) for i, (c, *_) in enumerate(WORD_CASES)],
                               "i int, command string")
    rows = {r.i: r for r in classify(df, "command", strip=False).collect()}
    for i, (_, w1, w2, t) in enumerate(WORD_CASES):
        r = rows[i]
        assert (r.command_w1, r.command_w2, r.command_type) == (w1, w2, t), WORD_CASES[i][0]


def test_transactions_first_option(spark):
    df = spark.createDataFrame([("BEGIN TRAN",), ("BEGIN x",)], "command string")
    got = [r.command_type for r in classify(df, transactions_first=True).collect()]
    assert got == ["TRANSACTION_CONTROL", "DML"]


def test_redaction_after_classification(spark):
    df = spark.createDataFrame([("select 1",)], "command string")
    r = redact(classify(df), "command", "missing_col").first()
    assert (r.command, r.command_w1, r.command_type) == (REDACTED, "SELECT", "QUERY")


@pytest.mark.parametrize("start,end,want", [(20, -1, "select 2"), (0, 14, "select 1"),
                                            (0, -1, "select 1; select 2"), (20, 400, "select 2")])
def test_statement_slice(spark, start, end, want):
    df = spark.createDataFrame([("select 1; select 2", start, end)], "t string, s int, e int")
    assert df.select(statement_slice("t", "s", "e").alias("x")).first().x == want


def test_statement_slice_counts_utf16_units(spark):
    # U+1F600 is two UTF-16 units (4 bytes): "a", smiley, "b" = 8 bytes.
    df = spark.createDataFrame([("a\U0001F600b; select 2", 10, -1), ("a\U0001F600b;", 0, 6),
                                (None, 0, -1)], "t string, s int, e int")
    got = [r.x for r in df.select(statement_slice("t", "s", "e").alias("x")).collect()]
    assert got == [" select 2", "a\U0001F600b", None]


def test_comment_strip_is_native(spark):
    df = spark.range(3).select(F.lit("-- a\nselect").alias("c"))
    plan = df.select(strip_comments("c"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_second_word_lookbehind_is_equivalent_and_linear(spark):
    import random
    import time

    from estate.functions.sqltext import SECOND_WORD_PATTERN, second_word
    rng = random.Random(11)
    alphabet = list("ab_9 ,.\\t\\n(;") + ["TRAN", "é"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 16))) for _ in range(20000)]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    plain = F.upper(F.regexp_extract("c", SECOND_WORD_PATTERN, 2))
    assert df.filter(second_word("c") != plain).count() == 0
    long_word = spark.createDataFrame([("x" * 200_000 + " y",), ("z" * 200_000,)], "c string")
    t0 = time.time()
    got = [r.w for r in long_word.select(second_word("c").alias("w")).collect()]
    assert got == ["Y", ""] and time.time() - t0 < 30


def _strip_rule(text):
    """F1 stated directly in Python: drop each block comment up to the first
    closing mark, then blank every newline-separated line whose first
    non-blank characters are '--' (Python's Unicode whitespace)."""
    import re
    text = re.sub(r"/\*.*?\*/", "", text, flags=re.S)
    return "\n".join("" if re.match(r"\s*--", line) else line for line in text.split("\n"))


def test_strip_comments_matches_the_rule_on_random_text(spark):
    import random
    rng = random.Random(5)
    alphabet = ["/", "*", "-", "\n", "\r", " ", "\t", "a", "'", ";", "\u00a0", "\u2028",
                "\x1c", "\x85", "\u3000", "\x0b", "--", "/*", "*/"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24))) for _ in range(20000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    got = dict(df.select("i", strip_comments("c").alias("o")).collect())
    bad = [(t, got[i], _strip_rule(t)) for i, t in enumerate(texts) if got[i] != _strip_rule(t)]
    assert not bad, bad[:3]


def test_statement_slice_inside_a_pair(spark):
    """Half of a character outside the BMP becomes U+FFFD, the query goes on."""
    from estate.functions.sqltext import statement_slice
    text = "a\U0001F600b\U0001F601c"
    units = text.encode("utf-16-le")
    rows = [(text, 2 * i, 2 * j) for i in range(7) for j in range(i, 8)] + [(None, 0, 2), ("", 0, -1)]
    df = spark.createDataFrame(rows, "t string, s int, e int")
    got = df.select(statement_slice("t", "s", "e").alias("x")).collect()
    for (t, i, j), r in zip(rows, got):
        if t:
            assert r.x == units[i:j + 2].decode("utf-16-le", "replace").replace("\ufffd\ufffd", "\ufffd"), (i, j)
    assert got[-2].x is None and got[-1].x == ""
