"""SQL-text functions: comment stripping, statement classification,
statement slicing and redaction (F1-F4, F10, F11).

All are native Catalyst expressions (regexp_replace / regexp_extract /
CASE / substring), so they stay inside whole-stage codegen; no Python runs
per row.  Regexes are Java regexes (Spark evaluates them in the JVM).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's, stated here together) --------
REDACTED = "[REDACTED]"
QUERY_WORDS = ("SELECT", "WITH")
DML_WORDS = ("INSERT", "UPDATE", "MERGE", "DELETE", "TRUNCATE", "COPY", "IF",
             "BEGIN", "DECLARE", "BUILDREPLICATEDTABLECACHE")
DDL_WORDS = ("CREATE", "DROP", "ALTER")
ROUTINE_WORDS = ("EXEC", "EXECUTE")
TRAN_WORDS = ("TRAN", "TRANSACTION")
TRAN_END_WORDS = ("COMMIT", "ROLLBACK")
# ---------------------------------------------------------------------------

# Block comment: from a "/*" to the first "*/" after it, across lines, also
# inside string literals; an unterminated "/*" is left alone.  The lazy form
# keeps the Java matcher iterative on very long comments.
_BLOCK_COMMENT = r"(?s)/\*.*?\*/"
# Whitespace of the original line rule (Unicode whitespace, as Python's "\s"
# on text), without the line feed: tab, VT, FF, CR, 0x1C-0x1F, space, NEL,
# NBSP, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# Written with \x{..} escapes, which Java and RE2 (the DuckDB oracle) share.
LINE_BLANKS = (r"[\t\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# Line comment: a line ("\n"-separated) whose first non-blank characters are
# "--" is blanked, its newline kept.  (?d) makes "\n" the only line
# terminator, so "." also eats a "\r" before the "\n"; the blank class has no
# "\n", so the match never runs back over earlier empty lines.
_LINE_COMMENT = r"(?dm)^" + LINE_BLANKS + r"*--.*"

# First word anywhere; word + blanks + next token (not blank, comma or dot).
_FIRST_WORD = r"(\w+)"
SECOND_WORD_PATTERN = r"(\w+)\s+([^\s,.]+)"      # fixed value: the statement's pattern
# Same matches, linear time: a match that starts inside a run of word
# characters implies one at the run's start, which is leftmost, so starts
# after a word character can be skipped.  Without the lookbehind a long
# word (a blob without blanks) is rescanned from each of its positions -
# quadratic in its length.
_SECOND_WORD = r"(?<!\w)" + SECOND_WORD_PATTERN


def strip_comments(c: Column | str) -> Column:
    """remove block comments, then blank whole-line "--" comments.

    Null stays null.  Trailing "-- x" after code on the same line stays.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(c, _BLOCK_COMMENT, ""), _LINE_COMMENT, "")


def first_word(c: Column | str) -> Column:
    """upper-cased first run of word characters, '' when there is none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.regexp_extract(c, _FIRST_WORD, 1))


def second_word(c: Column | str) -> Column:
    """upper-cased token after the first "word + whitespace" pair."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.regexp_extract(c, _SECOND_WORD, 2))


def statement_type(w1: Column | str, w2: Column | str,
                   transactions_first: bool = False) -> Column:
    """statement class from the first two words; first match wins.

    With the reference order ``BEGIN`` is listed as DML before the
    transaction rule, so ``BEGIN TRAN`` is DML.  ``transactions_first=True``
    tests the transaction rule first (``BEGIN TRAN`` becomes
    TRANSACTION_CONTROL).
    """
    w1 = F.col(w1) if isinstance(w1, str) else w1
    w2 = F.col(w2) if isinstance(w2, str) else w2
    is_tran = (((w1 == "BEGIN") | (w1 == "END")) & w2.isin(*TRAN_WORDS)) | w1.isin(*TRAN_END_WORDS)
    rules = [
        (w1.isin(*QUERY_WORDS), "QUERY"),
        (w1.isin(*DML_WORDS), "DML"),
        (w1.isin(*DDL_WORDS), "DDL"),
        (w1.isin(*ROUTINE_WORDS), "ROUTINE"),
        (is_tran, "TRANSACTION_CONTROL"),
    ]
    if transactions_first:
        rules.insert(0, rules.pop())
    out = None
    for cond, label in rules:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("OTHER")


def classify(df, column: str = "command", strip: bool = True,
             transactions_first: bool = False):
    """F1-F4 on ``column``: optionally strip comments in place, then add
    ``{column}_w1``, ``{column}_w2`` and ``{column}_type``."""
    if strip:
        df = df.withColumn(column, strip_comments(column))
    w1, w2 = f"{column}_w1", f"{column}_w2"
    return (df
            .withColumn(w1, first_word(column))
            .withColumn(w2, second_word(column))
            .withColumn(f"{column}_type", statement_type(w1, w2, transactions_first)))


def redact(df, *columns: str):
    """replace the text of each present column by the constant marker."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: F.lit(REDACTED) for c in present})


_BEYOND_BMP = r"[\x{10000}-\x{10FFFF}]"


def statement_slice(text: Column | str, start_offset: Column | str,
                    end_offset: Column | str) -> Column:
    """the statement inside a batch text given byte offsets.

    The source stores text as UTF-16 and gives offsets in bytes;
    ``end_offset = -1`` means "to the end" (the byte length of the text).
    Start byte ``start`` (integer-halved, so always a character boundary),
    length ``(end - start) / 2 + 1`` characters, integer division, clipped at
    the end.  Cutting the UTF-16 bytes keeps the offsets exact for characters
    outside the Basic Multilingual Plane, which count as two units there; half
    of such a character at either end of the cut becomes U+FFFD, so no offset
    fails the query.  Texts without such characters are cut by characters.
    """
    text = F.col(text) if isinstance(text, str) else text
    start = F.col(start_offset) if isinstance(start_offset, str) else start_offset
    end = F.col(end_offset) if isinstance(end_offset, str) else end_offset
    utf16 = F.encode(text, "UTF-16LE")
    end_bytes = F.when(end == -1, F.octet_length(utf16)).otherwise(end)
    # Integer division truncating toward zero, as the source engine does.
    first_unit = (start / 2).cast("int")
    units = ((end_bytes - start) / 2).cast("int") + 1
    cut = F.substring(utf16, first_unit * 2 + 1, F.greatest(units, F.lit(0)) * 2)
    # high byte of the first and last unit: DC-DF is the second half of a pair, D8-DB the first
    size = F.octet_length(cut)
    first, last = F.hex(F.substring(cut, 2, 1)), F.hex(F.substring(cut, size, 1))
    lone_head = (size >= 2) & first.between("DC", "DF")
    lone_tail = (size >= 2) & last.between("D8", "DB")
    unknown = F.unhex(F.lit("FDFF"))
    empty = F.unhex(F.lit(""))
    middle = F.substring(cut, F.when(lone_head, 3).otherwise(1),
                         size - F.when(lone_head, 2).otherwise(0) - F.when(lone_tail, 2).otherwise(0))
    whole = F.concat(F.when(lone_head, unknown).otherwise(empty), middle, F.when(lone_tail, unknown).otherwise(empty))
    plain = ~text.rlike(_BEYOND_BMP) & (start >= 0)
    plain_units = ((F.when(end == -1, F.char_length(text) * 2).otherwise(end) - start) / 2).cast("int") + 1
    return (F.when(plain, text.substr(first_unit + 1, F.greatest(plain_units, F.lit(0))))
            .when(text.isNotNull(), F.decode(whole, "UTF-16LE")))
