"""F5-F8 on the login cases of FIXTURES.md §3."""

import hashlib

from estate.functions.identity import hash_client, pseudonymise_logins
from estate.operators.filters import user_sessions

LOGINS = [
    ("john.doe@contoso.com", "USER", "john"),
    ("jdoe@contoso.com", "USER", "jd"),
    ("John.Doe.Smith@corp.net", "USER", "John"),
    ("a@x.com", "APP", "otherApp"),
    ("svc.app@tenant.local", "APP", "svc"),
    ("9f1c-aa@8899-00", "APP", "9f1c"),
    (" bob.x@y.org", "APP", "otherApp"),
    ("sa", "APP", "otherApp"),
    ("", "APP", "otherApp"),
    (None, "APP", "otherApp"),
]


def test_logins(spark):
    df = spark.createDataFrame([(i, l) for i, (l, *_) in enumerate(LOGINS)], "i int, login_name string")
    out = pseudonymise_logins(df)
    assert "login_name" not in out.columns
    rows = {r.i: r for r in out.collect()}
    for i, (login, typ, user) in enumerate(LOGINS):
        r = rows[i]
        assert (r.login_user_type, r.login_user) == (typ, user), login
        assert r.login_user_sha2 == hashlib.sha256(user.encode()).hexdigest()


def test_keep_clear_false_drops_name(spark):
    df = spark.createDataFrame([("john.doe@contoso.com",)], "login_name string")
    assert set(pseudonymise_logins(df, keep_clear=False).columns) == {"login_user_type", "login_user_sha2"}


def test_client_hash(spark):
    df = spark.createDataFrame([("10.0.0.1:1433",), (None,)], "client_id string")
    rows = hash_client(df).collect()
    assert rows[0].client_id_sha2 == hashlib.sha256(b"10.0.0.1:1433").hexdigest()
    assert rows[1].client_id_sha2 is None


def test_system_sessions_dropped(spark):
    df = spark.createDataFrame([("System",), ("mysystemuser",), ("bob@x.com",), (None,)],
                               "login_name string")
    assert [r.login_name for r in user_sessions(df).collect()] == ["bob@x.com"]


def test_fast_person_test_equals_group_form(spark):
    """The backtracking-light person test accepts exactly the strings the
    fixed pattern's group form accepts."""
    import random

    from pyspark.sql import functions as F

    from estate.functions.identity import login_user_type, login_user_type_by_group
    rng = random.Random(7)
    alphabet = list("ab_9.@- \\n\\r") + ["net", "com", "org", "gov", "edu", "NET", "\\u0085", "é"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(20000)]
    texts += [l for l, *_ in LOGINS if l is not None]
    df = spark.createDataFrame([(t,) for t in texts], "login_name string")
    diff = df.filter(login_user_type("login_name") != login_user_type_by_group("login_name"))
    assert diff.count() == 0, diff.limit(5).collect()
    assert df.filter(login_user_type("login_name") == "USER").count() > 100
