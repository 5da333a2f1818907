import pytest
import time
import random
import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cdcspark.llm import pii


def reference(text):
    """The base rules, word for word."""
    rules = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, rule in rules.items():
        for m in re.finditer(rule, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            double = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 13 <= len(digits) <= 19 and double % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1 2.@+-()5é4＠", max_size=60))
def test_base_spans_are_those_of_the_rules(text):
    base, spans = pii.all_spans(text)
    assert base == reference(text) and set(base) <= set(spans)


def shown(text):
    return [(k, text[s:e]) for k, s, e in pii.all_spans(text)[1]]


def test_plain():
    assert shown("a.b@c.de, 10.0.0.255 10.0.0.256, 4111 1111 1111 1111 +49 (30) 123-4567.") == [
        ("email", "a.b@c.de"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 123-4567"),
    ]


def test_disguised():
    for text, kind, span in [
        ("write to john dot doe at example dot com now", "email", "john dot doe at example dot com"),
        ("x john [at] example (dot) com", "email", "john [at] example (dot) com"),
        ("jоhn＠exаmple．com", "email", "jоhn＠exаmple．com"),
        ("jo​hn@exam​ple.com", "email", "jo​hn@exam​ple.com"),
        ("ring plus four nine one five one two three four five six.", "phone", "plus four nine one five one two three four five six"),
        ("＋１ 555 123 4567", "phone", "＋１ 555 123 4567"),
        ("four one one one " * 3 + "one one one one", "card", None),
        ("host one nine two dot one six eight dot one dot one!", "ip", "one nine two dot one six eight dot one dot one"),
        ("٤١١١ ١١١١ ١١١١ ١١١١", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ]:
        found = shown(text)
        assert found == ([(kind, span)] if span else found) and (span or all(k == kind for k, _ in found)), text


def test_clean_text_stays_clean():
    for text in ["look at example.com", "meet at noon. dot your i at once", "one two three", "We were two at three dot matrix printers",
                 "Это чистый текст", "Η ομάδα", "version 1.2.3", "a (at) b", "at dot at dot", "un deux trois", "1234 5678"]:
        assert shown(text) == [], text


def test_very_long_numbers():
    assert shown("0" * 10_000 + "1.2.3.4") == [("ip", "0" * 10_000 + "1.2.3.4")] and shown("9" * 10_000 + ".2.3.4") == []
    assert shown("1 " * 50_000) == [] and shown("+" + "1" * 20_000) == []


def test_find(docs):
    rows = [(1, None), (2, ""), (3, "é a@b.cd"), (3, "é a@b.cd"), (None, "x [at] y [dot] z"), (4, "w " * 100_000 + "a@b.cd")]
    got = sorted((tuple(r) for r in pii.find(docs(rows)).collect()), key=repr)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([
        (1, 0, 0, 0, 0, sha(""), ""), (2, 0, 0, 0, 0, sha(""), ""), (3, 1, 0, 0, 0, sha("email:2:8"), "email:2:8"),
        (3, 1, 0, 0, 0, sha("email:2:8"), "email:2:8"), (None, 0, 0, 0, 0, sha(""), "email:0:16"),
        (4, 1, 0, 0, 0, sha("email:200000:200006"), "email:200000:200006"),
    ], key=repr)
    assert pii.find(docs([])).collect() == []


def test_mask(docs):
    rows = [(1, "a@b.cd and x [at] y [dot] z"), (2, None), (3, "+4111 1111 1111 1111")]
    got = {r.doc_id: r.text for r in pii.mask(docs(rows)).collect()}
    assert got == {1: "<email> and <email>", 2: None, 3: "+<card>"}
    assert pii.mask(docs(rows)).columns == docs(rows).columns


def test_every_mixture_of_signs():
    for text, kind, span in [
        ("Server 192[.]168[.]0[.]1 is down", "ip", "192[.]168[.]0[.]1"),
        ("10 (dot) 0 (dot) 0 (dot) 1", "ip", "10 (dot) 0 (dot) 0 (dot) 1"),
        ("at 192 dot 168 dot 0 dot 1 now", "ip", "192 dot 168 dot 0 dot 1"),
        ("192.168 dot 0[.]1", "ip", "192.168 dot 0[.]1"),
        ("one nine two [.] one six eight (dot) one dot one", "ip", "one nine two [.] one six eight (dot) one dot one"),
        ("mail bob at example dot museum", "email", "bob at example dot museum"),
    ]:
        assert shown(text) == [(kind, span)], text
    for local in ["john", "john.doe", "john dot doe", "john [dot] doe"]:
        for at in [" at ", " [at] ", "(at)", " @ ", "@"]:
            for dot in [".", " dot ", "[.]", " (dot) "]:
                for domain in [f"example{dot}com", f"mail{dot}example{dot}co.uk"]:
                    address = local + at + domain
                    if at + dot == "@." or at == "@" and domain.endswith(".co.uk") and dot == ".":
                        continue
                    want = [("email", address)]
                    assert shown(f"to {address} now") == want, address
    assert shown("john dot doe@example.com") == [("email", "doe@example.com")]


def test_words_beside_a_site_stay():
    for text in ["available at example.com", "We are hosting at example.com.", "stay at home.He left", "look at example[.]com", "a @ b dot product",
                 "1 dot 2 dot 3", "300 dot 1 dot 1 dot 1", "two at three dot matrix", "(.) a [dot] b", "john at noon dot dot dot"]:
        assert shown(text) == [], text


#: The rules as they are stated, on which long runs take time that grows with their square.
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_linear_patterns_match_as_the_rules_do():
    draw = random.Random(3)
    pieces = ["a", "b.c", "@", "@", ".", "..", "_", "%", "-", "1", "23", "255", "256", " ", "+", "+1", "(", ")", "é", "x@y.zz", "1.2.3.4", "\n"]
    for _ in range(4_000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 25)))
        want = [(k, m.start(), m.end()) for k, rule in RULES.items() for m in re.finditer(rule, text) if pii._valid(k, m[0])]
        assert pii.plain_spans(text) == want


def test_signs_with_white_space():
    old = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+@\s+(?=[A-Za-z0-9-]+\s*(?:\.|[\[({<]|dot\b))", re.I)
    draw = random.Random(5)
    for _ in range(4_000):
        text = "".join(draw.choices([" ", "  ", "\n", "(at)", "[ AT ]", "(", "@", "at", "dot", ".", "ab", "<@>"], k=draw.randint(0, 14)))
        assert pii._ats(text) == [m.span() for m in old.finditer(text)]


@pytest.mark.parametrize(
    "text",
    [
        " " * 1_000_000 + "(x at", "a" * 1_000_000 + " x@y.zz", "1" * 1_000_000 + " .", "@" * 300_000, "a@" * 300_000, "x@" + "a" * 1_000_000,
        "1." * 500_000, "+1" + " " * 1_000_000, "one " * 250_000, "x (at) " + " " * 1_000_000 + "y dot com", "( " * 500_000 + "at", "at " * 300_000,
        "<" * 1_000_000 + "@", "a (dot) " * 100_000, "\u200b" * 1_000_000 + "@",
    ],
    ids=range(15),
)
def test_long_runs_take_no_time(text):
    begin = time.monotonic()
    pii.all_spans(text)
    assert time.monotonic() - begin < 6
