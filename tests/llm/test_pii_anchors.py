import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from rowkin.llm import pii_anchors as P
from tests.llm.brute import base_spans

_CASES = [
    None, "", "a@b.c", "a@b@c.d", "a@b.c@d.e", "@b.c", "x.@-.-", "a@b..c", "a@b.c.", "1.2.3.4.5.6.7.8", "0001.2.3.255", "256.1.1.1",
    "1.2.3.4444444444444444444444", "4111 1111 1111 1111", "4111-1111-1111-1111x", "4111  1111 1111 1111", "12 4111111111111111",
    "+1 (807) 555-5623", "+12", "+1 2", "++1 234 567 89", "+1 234 567 8 ) - .", "+123456789012345678", "é" * 5 + "a@b.c", "+1 2.3.4.5@a.b",
    "9" * 6000, "1." * 3000, "1 " * 3000, "a@" * 3000, "+1-" * 2000,
]


def test_base_kinds_are_those_of_the_patterns():
    rng = random.Random(4)
    cases = _CASES + ["".join(rng.choice("a@.1+2 -(4)") for _ in range(80)) for _ in range(4000)]
    for text in cases:
        assert [s for s in P.find(text) if s[0] in P.BASE_KINDS] == base_spans(text), repr(text)[:100]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a0179.@+- ()x:/é\n%", max_size=60))
def test_base_kinds_on_any_text(text):
    assert [s for s in P.find(text) if s[0] in P.BASE_KINDS] == base_spans(text)


def test_added_kinds_are_validated():
    def kinds(text):
        return [(k, text[a:b]) for k, a, b in P.find(text) if k not in P.BASE_KINDS]

    assert kinds("IBAN: GB82 WEST 1234 5698 7654 32 now") == [("account", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("IBAN: GB83 WEST 1234 5698 7654 32") == []
    assert kinds("ssn 123-45-6789, ssn 000-45-6789, ssn 123-45-67890") == [("account", "123-45-6789")]
    assert kinds("Account number: 12345678; account of 12") == [("account", "12345678")]
    assert kinds("see ftp://bob:pw@host.example/x and http://host.example/y") == [("address", "ftp://bob:pw@host.example/x")]


def test_masks_cover_overlapping_spans_once():
    text = "é mail bob@host.example or +1 807 555 5623."
    assert P.masked(text, P.find(text)) == "é mail [EMAIL] or [PHONE]."
    assert P.masked("abcdef", [("email", 1, 4), ("ip", 2, 5)]) == "a[EMAIL]f"


def test_query_columns_and_redaction(spark):
    docs = spark.createDataFrame(
        [(1, "x a@b.c 1.2.3.4", "k"), (1, None, "k"), (None, "", None)], "doc_id long, text string, spans string"
    )
    rows = sorted((tuple(r) for r in P.detected(docs).select("doc_id", "n_email", "n_ip", "base_sha256", "spans").collect()), key=repr)
    none = hashlib.sha256(b"").hexdigest()
    spans = "email:2:7,ip:8:15"
    assert rows == sorted([(1, 1, 1, hashlib.sha256(spans.encode()).hexdigest(), spans), (1, 0, 0, none, ""), (None, 0, 0, none, "")], key=repr)
    kept = sorted((tuple(r) for r in P.redacted(docs).collect()), key=repr)
    assert kept == sorted([(1, "x [EMAIL] [IP]", "k"), (1, None, "k"), (None, "", None)], key=repr)
    assert P.detected(docs.limit(0)).collect() == []


def test_schemes_are_taken_whole():
    def addresses(text):
        return [text[a:b] for kind, a, b in P.find(text) if kind == "address"]

    long = "verylongschemename-abcdefgh" * 40 + "://u:p@host.x/y"
    assert addresses(long) == [long] and addresses(f"see {long} there") == [long]
    assert addresses("+1.ssh://u:p@h.x") == ["ssh://u:p@h.x"]
    assert addresses("://u:p@h.x 12://u:p@h.x +-://u:p@h.x") == []


def test_secrets_behind_cues():
    def secrets(text):
        return [text[a:b] for kind, a, b in P.find(text) if kind == "secret"]

    value = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    assert secrets(f'é token = "{value}"### 4785') == [value]
    assert secrets(f"API_KEY={value}, 'secret': '{value}'. Token: {value}.") == [value] * 3
    assert secrets("password: hunter2x9, Passwd=short1") == ["hunter2x9"]
    assert secrets("the key: understanding-everything, token = 1234567890123456, secret 24be64439e3e49cf46b2d7c9") == []
    assert secrets("key=dGhpcyBpcyBub3QgYQ==") == ["dGhpcyBpcyBub3QgYQ=="]
    assert secrets("token=" * 50_000) == [] and secrets("key=" + "a1" * 100_000) == ["a1" * 100_000]
    assert P.masked(f"x token={value} y", P.find(f"x token={value} y")) == "x token=[SECRET] y"


def test_total_and_very_long_text(spark):
    long = "plain words " * 40_000 + "a@b.c token=24be64439e3e49cf46b2d7c9 " + "é " * 40_000
    docs = spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in P.detected(docs).collect()}
    assert (rows[1]["n_email"], rows[1]["n_secret"], rows[1]["n_spans"]) == (1, 1, 2)
    assert rows[1]["spans"] == "email:480000:480005,secret:480012:480036" and rows[2]["n_spans"] == 0
