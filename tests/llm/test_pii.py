"""Operator 12: base spans against the contract's patterns, and what the labelers add."""

import hashlib
import random
import re

import llm_data
import numpy as np

from meeple.llm import pii

# the contract's patterns, as written
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        total += int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c))))
    return total % 10 == 0


def checked(kind, s):
    digits = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in s.split(".")),
            "card": 13 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def plain(text):
    return {k: [m.span() for m in re.finditer(p, text) if checked(k, m.group())] for k, p in PATTERNS.items()}


def test_base_spans_equal_the_patterns():
    r = random.Random(5)
    parts = ["@", ".", "-", "+", " ", "1", "25", "256", "4111 1111 1111 1111", "a", "b.c", "+1 (706) 555-3138", "10.0.0.1",
             "x@y.zz", "(", ")", "é", "😀", "\n", "00", "5500-0000-0000-0004", "%", "1.2.3.4.5", "@@", "a@b"]
    for _ in range(4000):
        text = "".join(r.choices(parts, k=r.randint(1, 25)))
        assert pii.base_spans(text) == plain(text), repr(text)


def test_long_runs_take_linear_time():
    import time
    for text in ("9" * 200_000, "a" * 200_000, "1." * 100_000, "@" * 100_000, "+1" + " " * 100_000, "a@" * 100_000,
                 "9 " * 100_000, "(1)" * 60_000, ":" * 100_000, "f:" * 100_000):
        began = time.perf_counter()
        pii.text_spans(text, np.zeros(pii.WIDTH))
        assert time.perf_counter() - began < 3, text[:5]


FOUND = ["mail me: joe.doe@shop.example.com", "host 10.20.30.40 is up", "card 4111 1111 1111 1111 on file",
         "call +1 (706) 555-3138 now", "server 192.168.1.9", "see 4111111111111111 there"]


def trained(spark, extra=()):
    r = random.Random(1)
    clean = [llm_data.sentence(r, 40) for _ in range(80)]
    numbers = ["order " + "".join(r.choice("0123456789") for _ in range(15)) + "x" for _ in range(20)]
    failing = ["it is 9807915762804491 there"] * 40  # no card: the checksum fails
    texts = clean + numbers + failing + FOUND * 10 + list(extra)
    return pii.train(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_written_forms_are_added_and_lookalikes_are_not(spark):
    weights = trained(spark, ["mail joe (at) shop (dot) com", "write to ann[at]mail.example.com",
                              "call (706) 555-3138 today", "phone 706-555-3138"] * 5)

    def added(text):
        return [(k, text[s:e]) for k, s, e in pii.text_spans(text, weights)[1]]
    assert added("please mail jim.b (at) home (dot) com soon") == [("email", "jim.b (at) home (dot) com")]
    assert added("phone (206) 555-0100 today") == [("phone", "(206) 555-0100")]
    assert added("login from fe80:0:0:0:1:2:3:4 at") == [("ip", "fe80:0:0:0:1:2:3:4")]
    for text in ("it is 9807915762804491 there", "version 1.2.300.4", "order 9807915762804491", "look at this. And",
                 'token = "97a3d9800000000000000000c1"', "we met at noon dot dot", "at 12:30 and 11:45", "x = 300.1.2.3"):
        assert added(text) == [], text


def test_label_model_learns_reliabilities():
    """A labeler that agrees with the others is trusted, one that votes at random is not."""
    r = np.random.default_rng(0)
    truth = r.random(4000) < 0.4
    votes = np.zeros((4000, 5), int)
    for j, right in ((0, 0.95), (1, 0.8), (4, 0.9)):
        votes[:, j] = np.where((r.random(4000) < right) == truth, 1, -1)
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = pii.label_model(patterns, np.zeros(len(patterns), bool), n.astype(float))[at.ravel()]
    assert ((p > 0.5) == truth).mean() > 0.93


def test_rows_and_columns(spark):
    docs = llm_data.documents() + [(900, FOUND[0], None, None, None, 1, 1.0, 1), (900, FOUND[0], None, None, None, 1, 1.0, 1)]
    got = pii.personal_data(llm_data.frame(spark, docs)).collect()
    assert len(got) == len(docs)
    rows = [r for r in got if r.doc_id == 900]
    assert len(rows) == 2 and rows[0] == rows[1]
    assert rows[0].spans == "email:9:33" and rows[0].n_email == 1 and rows[0].n_card == 0
    assert rows[0].base_sha256 == hashlib.sha256(b"email:9:33").hexdigest()
    empty = next(r for r in got if r.doc_id == 61)  # ''
    assert empty.spans == "" and empty.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(llm_data.empty(spark)).count() == 0
