import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from studyloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: [int(c) for c in m[0] if c.isdigit()]

    def luhn(ds):
        return sum(d if i % 2 == 0 else sum(divmod(d * 2, 10)) for i, d in enumerate(reversed(ds))) % 10 == 0

    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab1.@-+ 0()_é", max_size=60) | st.text(alphabet="0123456789 -.+", max_size=80))
def test_base_spans(text):
    assert pii.detect(text) == plain(text)
    assert [(k, a, b) for k, a, b, base in pii.find(text) if base] == plain(text)


def found(text):
    return [(pii.KINDS[k], text[a:b]) for k, a, b, base in pii.find(text) if not base]


def test_disguises():
    assert found("write to john.doe (at) example [dot] com today") == [("email", "john.doe (at) example [dot] com")]
    assert found("jane at example dot co dot uk") == [("email", "jane at example dot co dot uk")]
    assert found("jоhn@examplе.com") == [("email", "jоhn@examplе.com")]
    assert found("j​ohn@exam­ple.com") == [("email", "j​ohn@exam­ple.com")]
    assert found("user @ example.com") == [("email", "user @ example.com")]
    assert found("at １９２.168.0.1 and 10 dot 0 dot 0 dot 1") == [("ip", "１９２.168.0.1"), ("ip", "10 dot 0 dot 0 dot 1")]
    assert found("call +1 (two one two) five five five 0199") == [("phone", "+1 (two one two) five five five 0199")]
    assert found("4111 1111 one111 1111") == []


def test_clean_text_is_left_alone():
    for text in ("we met at noon", "the dot on one of six maps", "un deux trois", "a@b", "1.2.3", "at [dot]", "vue à 10 h, point final", ""):
        assert pii.find(text) == []


def test_long_runs_are_linear():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "a@" * 100_000, "one " * 50_000):
        pii.find(text)


def test_query(spark, documents, awkward):
    texts = ["a@b.cd, 10.0.0.1; +1 (212) 555-0199; 4111 1111 1111 1111", "x (at) y (dot) com"]
    rows = [*awkward, *[(100 + i, t, "en", "a", 0) for i, t in enumerate(texts)]]
    got = {}
    for r in pii.op2_pii(spark, documents(rows)).collect():
        got.setdefault(r.doc_id, r)
    for doc_id, text, *_ in rows:
        base = plain(text or "")
        r = got[doc_id] if doc_id is not None else None
        if r is not None:
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, *_ in base) for i in range(4)]
            assert r.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
    assert got[100].spans == "email:0:6,ip:8:16,card:37:56,phone:18:35" and got[101].spans == "email:0:18"
    assert pii.op2_pii(spark, documents([])).collect() == []


def test_masking(spark):
    d = spark.createDataFrame([("mail a@b.cd or x (at) y.zz now",), (None,), ("none",)], "text string")
    assert [r[0] for r in d.select(pii.masked(d.text, pii.spans(d.text))).collect()] == ["mail <EMAIL> or <EMAIL> now", None, "none"]


def test_disguises_beside_plain_characters():
    for text in ("jоhn@example.com", "jo​hn@example.com", "john@example.cоm", "john@mail.example[dot]com", "jane at example.com", "jane at mail.example.com"):
        assert found(f"to {text} now") == [("email", text)], text
    assert found("+49 30 1234567８") == [("phone", "+49 30 1234567８")]
    for text in ("jоhn@example.com", "john@example.cоm", "+49 30 1234567８"):
        rows = [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in pii.find(text)]
        assert any(r["base"] for r in rows) and pii._mask(text, rows) in ("<EMAIL>", "<PHONE>")
    assert found("we met at noon. Then at 3.5 km, at 10.0.0.1") == []
