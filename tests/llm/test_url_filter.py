"""URL rules against a plain reading, and held-out accuracy of the trees."""

import random

import pytest

from sigloom.llm import url_filter as u


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), tail[:cut]


def plain_rule(host, path):
    fits = [r for r in u.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def pages(spark, urls):
    return spark.createDataFrame([(k, x, "h", "v") for k, x in enumerate(urls)], "page_id bigint, url string, host string, verdict string")


def test_rules(spark, sf_dir):
    urls = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    urls += [None, "", "x", "http://", "http://COM/", "http://xcom/", "http://a.com", "http://a.com?x=/", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/", "http://m.example.com/en/?q", "a://b://net/es/", "http://x.net/es/#f", "http://net/fr", "http://É.com/", "x" * 50_000, "http://" + "a." * 3_000 + "org/" + "p/" * 5_000, urls[0]]
    got = {r.page_id: r for r in u.judge(pages(spark, urls)).collect()}
    assert len(got) == len(urls)
    for k, url in enumerate(urls):
        host, path = plain_parts(url)
        rule, r = plain_rule(host, path), got[k]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "block" if r.chance >= 0.5 else "allow")


def test_held_out_accuracy(spark):
    rng = random.Random(8)
    name = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))

    def url(bad):
        tld = rng.choice(["zip", "top", "org"] if bad else ["org", "edu", "int"])
        path = "/".join(name(4) + (str(rng.randrange(10**6)) if bad else "") for _ in range(rng.randint(1, 3)))
        return f"http://{name(8)}.{tld}/{path}" + "&".join(["?a=1", *(f"{name(2)}=2" for _ in range(rng.randint(2, 5)))]) * bad

    data = [(url(y), y) for y in (0, 1) for _ in range(400)]
    rng.shuffle(data)
    known = spark.createDataFrame([*data[:600], (None, 0), (data[0][0], None)], "url string, label int")
    held = data[600:]
    got = {r.page_id: r.verdict for r in u.judge(pages(spark, [x for x, _ in held]), rules=(), labelled=known).collect()}
    assert sum((got[k] == "block") == bool(y) for k, (_, y) in enumerate(held)) >= 0.95 * len(held)


@pytest.mark.parametrize(("urls", "verdict"), [(["http://a.com/", "http://b.org/"], "allow"), (["http://a.net/es/", "http://b.org/"], "block"), (["http://b.org/"], "allow")])
def test_labels_of_one_kind_or_none(spark, urls, verdict):
    assert u.judge(pages(spark, urls)).orderBy("page_id").collect()[-1].verdict == verdict


def test_no_pages(spark):
    assert u.judge(pages(spark, ["http://a.com/"]).limit(0)).count() == 0
