import hashlib
import random
import re

from llm_support import by_id, docs

from layerwell.llm.pii import find_spans, pii_report, revealing_terms, sanitise
from layerwell.llm.pii import _found as base_spans

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


TEXTS = [
    None, "", "a@b.c_x@d.e", "x@y..z a@b.c.", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (555) 010-9999.", "+12345678 +123456789 +1234567890123456", "é🙂 me@host.org 日本 10.0.0.1", "card 4111111111111111@x.y +4111111111111111",
    "no digits at all", "@@@ .@. a@b", "1.1.1.1.1.1", "0@0.0", "+1((((((((2", "4 2 4 2 4 2 4 2 4 2 4 2 4 2 4 2",
    "a" * 3000, "1" * 3000, "1 " * 1500, "a@" * 1000, "+1" + "(" * 3000, "1.2." * 1000, "x@y" + ".z" * 1000,
]


def test_base_spans_equal_plain_patterns(spark):
    random.seed(2)
    mixed = ["".join(random.choices("0159a@.+- ()é", k=random.randint(1, 60))) for _ in range(1500)]
    rows = [(i, t, None, None, 1, "x") for i, t in enumerate(TEXTS + mixed)]
    got = by_id(pii_report(docs(spark, rows, ", key int, spans string")))
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        want = brute(text)
        named = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in want)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest(), text[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[1] == k for w in want) for k in range(4)]
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in PLAIN] == [s for s in named.split(",") if s]


def test_very_long_texts_take_linear_time(spark):
    """A run of one character, or of one pattern, as long as a book; plain patterns would take hours."""
    long = ["a" * 300_000, "1" * 300_000, "1 " * 150_000, "a@" * 100_000, "+1" + "(" * 300_000, "1.2." * 4000, "x@y" + ".z" * 100_000]
    got = by_id(pii_report(docs(spark, [(i, t, None, None) for i, t in enumerate(long)])))
    assert [got[i].n_ip for i in range(7)] == [0, 0, 0, 0, 0, 2000, 0]
    assert [got[i].n_email for i in range(7)] == [0, 0, 0, 0, 0, 0, 1]


def told():
    """Documents where a name stands next to one address only, and common words everywhere."""
    rows = [(i, f"write to Zanthor Quill at zq@host.org about the weather in item {chr(97 + i)}", "en", "s") for i in range(5)]
    rows += [(10 + i, f"please write about the weather number {i} and call", "en", "s") for i in range(40)]
    return rows + [(60, "Zanthor without any address", "en", "s"), (61, None, None, None), (62, "about mail a@b.co here", "en", "s")]


def test_words_that_reveal_an_entity(spark):
    frame = docs(spark, told())
    telling, _ = revealing_terms(frame, base_spans(frame, "doc_id", "text", "t"))
    terms = {(r.entity, r.term): r.share for r in telling.collect()}
    assert {t for _, t in terms} == {"quill", "zanthor", "item"} - ({"item"} if ("0:zq@host.org", "item") not in terms else set())
    assert terms["0:zq@host.org", "quill"] > terms["0:zq@host.org", "zanthor"] >= 0.7
    spans = by_id(find_spans(frame))
    assert [s.kind for s in spans[0].spans][:3] == [4, 5, 0] and spans[60].spans == [] and spans[10].spans == []


def test_sanitised_texts(spark):
    frame = docs(spark, told())
    got = sanitise(frame)
    text = {r.doc_id: r.text for r in got.collect()}
    assert got.columns == frame.columns and len(text) == len(told())
    assert text[0].startswith("write to [TERM]  at [EMAIL] about the weather in")
    assert text[60] == "Zanthor without any address" and text[61] is None and text[62] == "about mail [EMAIL] here"


def test_words_far_from_the_entity(spark):
    far = " something common to read" * 10
    rows = [(i, f"Zanthor{far} age 42, zq@host.org, 10.0.0.1{far} Quill", None, None) for i in range(5)]
    rows += [(10 + i, f"other{far} age 42{far}", None, None) for i in range(100)]
    rows += [(200, f"zq@host.org{far} Zanthor and nothing else", None, None)]
    text = {r.doc_id: r.text for r in sanitise(docs(spark, rows)).collect()}
    assert all("Zanthor" not in text[i] and "Quill" not in text[i] for i in (0, 4, 200))
    assert "something common to read age 42, [EMAIL], [IP]" in text[0]


def test_names_at_the_borders_of_a_text_and_between_numbers(spark):
    rows = [(i, "Zanthor: zq@host.org", None, None) for i in range(3)]
    rows += [(5 + i, "zq@host.org Zanthor", None, None) for i in range(3)]
    rows += [(10 + i, "Quillon, age 42, card 4111 1111 1111 1111", None, None) for i in range(5)]
    rows += [(20 + i, f"age 42, card number {i} and other words", None, None) for i in range(100)]
    text = {r.doc_id: r.text for r in sanitise(docs(spark, rows)).collect()}
    assert text[0].endswith(": [EMAIL]") and "Zanthor" not in text[0] + text[5] and "Quillon" not in text[10]
    assert text[10].endswith(", age 42, card [CARD]")


def test_short_words_digits_marks_and_entities_of_few_documents(spark):
    rows = [(i, "Lee K7x 김철수 re\u0301my at zq@host.org", None, None) for i in range(2)]
    rows += [(10, "Quillon at only@host.org", None, None)]
    rows += [(20 + i, f"common words at item {i % 10}", None, None) for i in range(4000)]
    text = {r.doc_id: r.text for r in sanitise(docs(spark, rows)).collect()}
    assert text[0] == text[1] == "[TERM] [TERM] [TERM] [TERM] at [EMAIL]"
    assert text[10] == "[TERM] at [EMAIL]" and text[20] == "common words at item 0"


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(1, "a@b.co", None, None), (1, "a@b.co", None, None), (None, "c@d.eu", None, None), (1, "other text", None, None)]
    got = pii_report(docs(spark, rows)).collect()
    assert len(got) == 4 and sum(r.n_email for r in got) == 3
    assert len(sanitise(docs(spark, rows)).collect()) == 4
    assert pii_report(docs(spark, [])).collect() == [] and sanitise(docs(spark, [])).collect() == []
