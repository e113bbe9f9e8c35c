import random

import numpy as np
import pytest

from tidecall.llm import urls as U
from tidecall.llm.common import Scratch
from tidecall.llm.queries import op10_url_filter, url_rules


def keys_frame(spark, n=20_000, listed=3_000):
    r = random.Random(1)
    rows = [(r.getrandbits(63), r.getrandbits(63), i < listed) for i in range(n)]
    return rows, spark.createDataFrame(rows, "h1 long, h2 long, listed boolean")


def test_cascade_is_exact_for_its_universe(spark):
    rows, frame = keys_frame(spark)
    cascade = U.Cascade.build(frame, Scratch(spark, "t"))
    assert len(cascade.levels) >= 2
    h1, h2, listed = (np.array(x) for x in zip(*rows))
    assert (cascade.contains(h1, h2) == listed).all()


@pytest.mark.parametrize("listed", [0, 1, 20_000])
def test_cascade_at_its_ends(spark, listed):
    rows, frame = keys_frame(spark, listed=listed)
    cascade = U.Cascade.build(frame, Scratch(spark, "t"))
    h1, h2, want = (np.array(x) for x in zip(*rows))
    assert (cascade.contains(h1, h2) == want).all()


PAGES = [
    (1, "https://a.example.org/es/x"),
    (2, "http://EXAMPLE.ORG/en/123?q=1"),
    (3, "http://example.org/en/2"),
    (4, "https://x.y.com/fr/a#b"),
    (5, "https://com/de/"),
    (6, "https://m.casino-win.example.com/en/1"),
    (7, "https://casino-win.example.com/fr/1"),
    (8, "no scheme"),
    (9, None),
    (10, "https://host.net"),
    (10, "https://host.net"),
    (11, "https://host.org"),
    (None, "ftp://org/"),
    (12, "http://notexample.org/es/"),
    (13, ""),
    (14, "x://" + "a." * 500 + "org/" + "p" * 5000),
]
WANT = {
    1: ("example.org/es/", "block"),
    2: ("example.org/en/1", "block"),
    3: ("org/", "allow"),
    4: ("com/fr/", "allow"),
    5: ("com/de/", "block"),
    6: (None, "block"),
    7: ("com/fr/", "allow"),
    8: (None, "allow"),
    9: (None, "allow"),
    10: (None, "allow"),
    11: (None, "allow"),
    None: ("org/", "allow"),
    12: ("org/", "allow"),
    13: (None, "allow"),
    14: ("org/", "allow"),
}


@pytest.mark.parametrize("most_bits", [U.MAX_LEVEL_BITS, 1])
def test_rules(spark, monkeypatch, most_bits):
    """By cascades, and by the join that longer lists take."""
    monkeypatch.setattr(U, "MAX_LEVEL_BITS", most_bits)
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, host string, keys string")
    rows = U.judge_urls(pages, url_rules(spark)).collect()
    assert len(rows) == len(PAGES)
    assert {r.page_id: (r.rule, r.verdict) for r in rows} == WANT
    host = {r.page_id: (r.host, r.path) for r in rows}
    assert host[2] == ("example.org", "/en/123") and host[4] == ("x.y.com", "/fr/a") and host[9] == ("", "")


def test_without_rules_and_without_pages(spark):
    rules = url_rules(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string")
    assert {r.verdict for r in U.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert U.judge_urls(pages.limit(0), rules).count() == 0


def test_matches_sql(spark, small):
    from compare import compare, connect
    from tidecall.llm.queries import ORACLES

    assert compare(op10_url_filter(spark, small), connect(small), ORACLES["op10_url_filter"]) is None
