"""Personal data: base patterns against a plain reading of them, disguises, and the way back."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigloom.llm import personal_data as p


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(n - 9 * (n > 9) for n in doubled) % 10 == 0


def plain_base(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


def base(text):
    return [x[:3] for x in p.find_spans(text) if x[3]]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "@", ".", "-", " ", "+1", "x", "4111111111111111", "255", "256", "1.2.3.4", "é", "0", "(555) ", "a-b", "_%", "٣", "\n", "7"]), max_size=25))
def test_base_against_patterns(pieces):
    text = "".join(pieces)
    assert base(text) == plain_base(text)


def test_whole_table_and_digests(spark, sf_dir, docs_of, texts):
    from hashlib import sha256

    from sigloom.llm import spans

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + [(9000 + k, t) for k, t in enumerate(texts)]
    rows += [(None, "a@b.co"), (1, "a@b.co"), (9100, "mail jo [at] site [dot] org, +1 555 123 4567 and 1.2.3.4")]
    found = docs_of(rows).select("doc_id", "text", p.personal_data(F.col("text")).alias("f"))
    out = found.select("text", spans.of_kind(F.col("f"), "email").alias("n"), spans.base_digest(F.col("f")).alias("sha"), spans.listed(F.col("f")).alias("all")).collect()
    assert len(out) == len(rows)
    for r in out:
        listed = [f"{k}:{s}:{e}" for k, s, e in plain_base(r.text or "")]
        assert r.sha == sha256(",".join(listed).encode()).hexdigest()
        assert r.n == sum(x.startswith("email") for x in listed) and set(listed) <= set(r["all"].split(","))
    assert out[-1]["all"] == "email:5:27,ip:49:56,phone:29:44"


def test_disguises_come_back_to_their_places():
    cases = {
        "write to jоhn.dое@exаmple.com now": ("email", "jоhn.dое@exаmple.com"),
        "ann (at) mail {dot} net": ("email", "ann (at) mail {dot} net"),
        "it is joe at mail dot org": ("email", "joe at mail dot org"),
        "x\u200b@y\u200b.zz!": ("email", "x\u200b@y\u200b.zz"),
        "ip １０.0.0.１ ok": ("ip", "１０.0.0.１"),
        "call plus one five five five one two three four five six seven": ("phone", "plus one five five five one two three four five six seven"),
        "no four one one one one one one one one one one one one one one one end": ("card", "four one one one one one one one one one one one one one one one"),
    }
    for text, (kind, part) in cases.items():
        at = text.index(part)
        assert (kind, at, at + len(part), False) in p.find_spans(text), text
    assert p.find_spans("we met at noon and the dot was one two three") == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "bc", " ", "é", "x" * 9]), min_size=1, max_size=12), st.randoms(use_true_random=False))
def test_maps_lead_back(pieces, rng):
    text = "".join(pieces)
    edits, k = [], 0
    while k < len(text):
        if rng.random() < 0.3:
            end = min(len(text), k + rng.randint(1, 3))
            edits.append((k, end, rng.choice(["", "Q", "QRS"])))
            k = end
        k += 1
    out = p._Rewritten(text, edits)
    for s in range(len(out.text)):
        a, b = out.back(s, s + 1)
        assert 0 <= a < b <= len(text)
        assert out.text[s] in "QRS" or text[a:b] == out.text[s]


def test_redaction(docs_of):
    docs = docs_of([(1, "mail a@b.co or +1 555 123 4567."), (2, None), (3, ""), (3, "1.2.3.4")])
    got = p.redacted(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert [(r.doc_id, r.text, r.n_chars) for r in got.collect()] == [(1, "mail [EMAIL] or [PHONE].", 24), (2, None, 0), (3, "", 0), (3, "[IP]", 4)]
    assert p.redacted(docs.limit(0)).count() == 0


def test_long_texts_take_linear_time():
    for text in ("9" * 300_000, "@" * 300_000, "a" * 300_000 + "@", "+1" * 100_000, "one " * 60_000, "a.b" * 100_000, "1.2." * 80_000):
        p.find_spans(text)


def test_random_noise():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab@.-+ 0123456789()é") for _ in range(rng.randrange(80)))
        assert base(text) == plain_base(text)


@pytest.mark.parametrize(
    "kind, told",
    [
        ("ip", "one nine two dot one six eight dot one dot one"),
        ("ip", "192 dot one six eight dot 1 dot one"),
        ("ip", "192 dot 168 dot 1 dot 1"),
        ("phone", "+1 five five five one two three 4567"),
        ("phone", "plus one, five five five, one two three, four five six seven"),
        ("phone", "plus one five five five 123 4567"),
        ("phone", "plus one (five five five) 123, 4567"),
        ("card", "4111 one one one one 1111 one one 1 one"),
        ("card", "four one one one, one one one one, 1111, 1111"),
    ],
)
def test_spelled_digits_mixed_with_others(kind, told):
    text = f"write to {told} soon"
    assert (kind, 9, 9 + len(told), False) in p.find_spans(text), p.find_spans(text)
    assert told not in p.redact(text)


def test_mixed_runs_lose_nothing_and_invent_nothing():
    card = " ".join("four one one one one one one one one one one one one one one one".split())
    assert ("card", 0, len(card), False) in p.find_spans(card + ", one more")
    assert p.find_spans("one, two, three. One dot two. Take 5, six or seven of 12 and 4") == []
