"""Levels of hosts, and outcomes that belong to their hosts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from rollcall.llm import url_filter
from rollcall.llm.common import prepare

LEVELS = {
    "www.bbc.co.uk": ("bbc.co.uk", "co.uk"),
    "bbc.co.uk.": ("bbc.co.uk", "co.uk"),
    "co.uk": ("co.uk", "co.uk"),
    "a.xco.uk": ("xco.uk", "uk"),
    "me@news.example.org:8080": ("example.org", "org"),
    "10.0.0.1": ("10.0.0.1", "[address]"),
    "10.0.0.1:80": ("10.0.0.1", "[address]"),
    "[2001:db8::1]:80": ("[2001:db8::1]", "[address]"),
    "localhost": ("localhost", "localhost"),
    "": ("", ""),
}


def test_levels(spark):
    frame = spark.createDataFrame([(h,) for h in LEVELS], "host string")
    domain = url_filter.domain_of(url_filter.bare_of(F.col("host")))
    rows = frame.select("host", domain.alias("domain")).select("host", "domain", url_filter.suffix_of(F.col("domain")).alias("suffix"))
    assert {r["host"]: (r["domain"], r["suffix"]) for r in rows.collect()} == LEVELS


@pytest.fixture(scope="module")
def fixture(spark):
    """Pages whose outcomes follow their domain, and pages without an outcome."""
    prepare(spark)
    of = {"good.co.uk": (1, 40), "spam.co.uk": (0, 40), "10.0.0.1": (0, 40), "11.0.0.1": (1, 40), "fine.net": (1, 40), "spam.net": (0, 40)}
    pages, labels = [], []
    for domain, (quality, n) in of.items():
        for i in range(n):
            host = domain if domain[0].isdigit() else f"h{i % 4}.{domain}"
            pages.append((len(pages), f"http://{host}/{i}"))
            labels.append((len(pages) - 1, quality, 0))
        if not domain[0].isdigit():
            pages.append((len(pages), f"http://new.{domain}/"))
    return pages, labels


def test_the_method_decides_by_domain(spark, fixture):
    pages, labels = fixture
    table = spark.createDataFrame(pages, "page_id long, url string")
    outcomes = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = url_filter.judge(table, url_filter.outcomes(outcomes))
    rows = {tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()}
    verdicts = {host: verdict for _, host, _, _, verdict in rows}
    for host, verdict in verdicts.items():
        bad = host.endswith(("spam.co.uk", "spam.net")) or host == "10.0.0.1"
        if not host.startswith("new."):
            assert verdict == ("block" if bad else "allow"), host
    assert verdicts["new.good.co.uk"] == verdicts["new.fine.net"] == "allow"
    assert verdicts["new.spam.co.uk"] == verdicts["new.spam.net"] == "block"
    with duckdb.connect() as db:
        db.execute("create table pages (page_id bigint, url varchar)")
        db.execute("create table labels (doc_id bigint, quality int, toxic int)")
        db.executemany("insert into pages values (?, ?)", pages)
        db.executemany("insert into labels values (?, ?, ?)", labels)
        assert set(db.execute(f"select page_id, host, path, rule, verdict from ({url_filter.ORACLE_SQL})").fetchall()) == rows
