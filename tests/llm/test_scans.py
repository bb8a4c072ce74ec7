"""Secrets, personal data, licenses and decontamination against plain matching."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from trailmark.llm import automaton, decontaminate, licenses, pii, secrets
from trailmark.llm.common import text_bytes

from .conftest import PLAIN, doc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def by_row(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rules", [["ab+c"], ["a(b|c)*d", "[0-9]{3,}"], ["x?y{2}z", "[a-c]+\\.[a-c]+"]])
def test_automaton_ends_where_expressions_end(rules):
    machine = automaton.compile_rules([(r, False) for r in rules])
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice("abcdxyz019.") for _ in range(rng.randint(0, 40)))
        states = automaton.run(machine, np.frombuffer(text.encode(), np.uint8), lane=7)
        for r, rule in enumerate(rules):
            for i in range(len(text)):
                ends = any(re.fullmatch(rule, text[a:i + 1]) for a in range(i + 1))
                assert bool(machine.accepts[states[i]] >> r & 1) == ends


def test_automaton_is_minimal():
    assert len(automaton.compile_rules([("ab|cb", False)]).accepts) == 3
    assert len(automaton.compile_rules([("ab", False), ("ab", False)]).accepts) == 3


def plain_secrets(text):
    raw, found = (text or "").encode(), []
    for k, (_, _, _, exact, least) in enumerate(secrets.RULES):
        for m in re.finditer(exact, raw):
            group = m.lastindex or 0
            if m.end(group) - m.start(group) >= least:
                found.append((len(raw[:m.start()].decode()), k, len(raw[:m.end()].decode())))
    return [(secrets.RULES[k][0], a, b) for a, k, b in sorted(found)]


FRAGMENTS = ["password", "PassWd", "token", "api_key", "=", ":", " ", '"', "abcdefgh", "AKIA", "ABCDEFGH1234", "0123456789abcdef" * 2, "é", "\n", "x",
             "bearer ", "://u:p@", "eyJabcdefghij.", "-----BEGIN RSA PRIVATE KEY-----", "@", "x.y", "1", "255", "+1", "4539148803436467", "1.2.3.4", "-555-", "(", ")"]


def made(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_secrets_equal_plain_matching(spark, frame, odd):
    texts = made(400, 1)
    got = {r["doc_id"]: r for r in secrets.op2_query(frame([doc(i, t) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        want = plain_secrets(t)
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in want if k in ("assign", "access", "hex"))
        assert got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert got[i]["n_hex"] == sum(k == "hex" for k, _, _ in want)
    assert secrets.op2_query(odd).count() == odd.count()


def test_pii_equals_plain_matching(spark, frame, odd, empty):
    texts = made(600, 2) + ["mail a.b@c.de or +49 (30) 1234567, 10.0.0.255 and 300.1.1.1", "account: 1234567890"]
    got = {r["doc_id"]: r for r in pii.op5_query(frame([doc(i, t) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        want = [(k, m.start(), m.end()) for k in pii.BASE_KINDS for m in pii.PARSER[k].finditer(t) if pii._valid(k, m.group())]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest(), t
    assert "account:" in got[len(texts) - 1]["spans"]
    assert pii.op5_query(odd).count() == odd.count() and pii.op5_query(empty).count() == 0


def test_identifier_cues_in_any_case():
    iban, built = "DE89 3704 0044 0532 0130 00", pii.machine()
    for text, kind, value in [
        ("Account Number: 12345678", "account", "12345678"), ("İ Konto 12345678", "account", "12345678"), ("COMPTE NR. 12345678", "account", "12345678"),
        (f"iban {iban}", "iban", iban), (f"Iban: {iban}", "iban", iban), (f"IBAN {iban}", "iban", iban),
    ]:
        at = text.index(value)
        assert (kind, at, at + len(value)) in pii.find_spans(built, text), text


def test_spans_are_code_points():
    raw, at = text_bytes(__import__("pyarrow").array(["éé token=abcdefgh"]))
    assert len(raw) == 19 and at.tolist() == [0, 19]
    assert plain_secrets("éé token=abcdefgh") == [("assign", 3, 17)]


def plain_decontamination(text, items, width=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        g = words(t)
        size = min(len(g), width)
        grams = {tuple(g[i:i + size]) for i in range(len(g) - size + 1)} if size else set()
        for i in range(len(w) - size + 1 if size else 0):
            if tuple(w[i:i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, PLAIN), (2, "rights reserved"), (10, "the the"), (3, ""), (4, None), (5, "Grey morning while two boats waited for the tide and the keeper"), (None, "número é ß")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("limit", [0, 1000])
def test_decontamination_equals_brute_force(odd, bench, limit):
    items = [(r["item_id"], r["text"]) for r in bench.filter("item_id is not null").collect()]
    known = bench.filter("item_id is not null")
    report = decontaminate.decontamination_report(odd, known, max_broadcast_windows=limit)
    got = {(r["key"]["id"], r["key"]["h"]): (r["n_hit"], len(r["items"])) for r in report.collect()}
    assert len(got) == sum(plain_decontamination(t, items)[1] > 0 for _, t in {(r["doc_id"], r["text"]) for r in odd.collect()})
    out = decontaminate.op3_query(odd, known)
    want = [(r["doc_id"], *plain_decontamination(r["text"], items)) for r in odd.collect()]
    assert by_row(out, "doc_id", "n_words", "n_hit", "n_items", "items_sha256") == sorted(want, key=repr)


def test_decontamination_filters(odd, empty, bench):
    kept = decontaminate.decontaminate(odd, bench)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({0, 1, 2, 10, 12})
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(odd, bench.limit(0)).count() == odd.count()


def test_decontamination_cuts_spans(frame, spark):
    item = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id int, text string")
    text = "Before, this. One two; three four five six seven eight nine TEN! After (that)."
    out = decontaminate.decontaminate(frame([doc(1, text), doc(2, "untouched  text"), doc(3, None)]), item, remove="spans")
    assert dict(by_row(out, "doc_id", "text")) == {1: "Before, this. ! After (that).", 2: "untouched  text", 3: None}


def test_licenses(frame, odd, empty):
    rows = {
        1: "cc, BY x All rights\nreserved general public license", 2: "Released under the (new) MIT License", 3: "cc", 4: None, 5: "cc by cc by",
    }
    got = {r["doc_id"]: r for r in licenses.op7_query(frame([doc(i, t) for i, t in rows.items()])).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (3, 0, 6, "cc-by,gpl,reserved")
    assert got[2]["labels"] == "mit" and got[2]["n_base"] == 0  # one word put in: two near diagonals
    assert (got[3]["n_words"], got[3]["n_base"], got[3]["first_word"], got[3]["labels"]) == (1, 0, None, "")
    assert (got[4]["n_words"], got[4]["score"]) == (0, 0.0)
    assert (got[5]["n_base"], got[5]["first_word"], got[5]["last_word"]) == (2, 0, 2)
    counts = [(r["doc_id"], len(words(r["text"]))) for r in odd.collect()]
    assert by_row(licenses.op7_query(odd), "doc_id", "n_words") == sorted(counts, key=repr)
    assert licenses.op7_query(empty).count() == 0


def test_pii_matches_in_one_reading():
    """Base kinds equal the expressions on strings made of their own characters, and long hopeless tokens cost little."""
    rng, built = random.Random(9), pii.machine()
    for _ in range(3000):
        t = "".join(rng.choice("a@.-b1 +@.2.3") for _ in range(rng.randint(0, 40)))
        want = sorted((k, m.start(), m.end()) for k in ("email", "ip") for m in pii.PARSER[k].finditer(t) if pii._valid(k, m.group()))
        assert sorted(s for s in pii.find_spans(built, t) if s[0] in ("email", "ip")) == want, t
    for t in ("a" * 1_000_000 + "@", "a" * 1_000_000 + "@b", "a@" * 500_000, "1" * 1_000_000 + ".5", "1." * 500_000, "+1" * 500_000):
        start = time.perf_counter()
        pii.find_spans(built, t)
        assert time.perf_counter() - start < 5, t[:5]


def test_secret_tokens_in_one_reading():
    machine = secrets.build()
    rng = random.Random(4)
    plain = re.compile(rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
    kind = [r[0] for r in secrets.RULES].index("web_token")
    for _ in range(1500):
        t = "".join(rng.choice(["eyJ", "eyJ", "a", "bcdefgh", "12345678", ".", ".", " "]) for _ in range(rng.randint(0, 25))).encode()
        raw = np.frombuffer(t, np.uint8)
        got = sorted((a, b) for r, a, b in secrets.find_spans(machine, raw, np.array([0, len(raw)])).get(0, []) if r == kind)
        assert got == [m.span() for m in plain.finditer(t)], t
    long = np.frombuffer(b"eyJ" * 350_000, np.uint8)
    start = time.perf_counter()
    secrets.find_spans(machine, long, np.array([0, len(long)]))
    assert time.perf_counter() - start < 5


def test_secrets_of_an_empty_table(empty):
    assert secrets.op2_query(empty).count() == 0
