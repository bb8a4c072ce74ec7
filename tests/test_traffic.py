import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trailmark.functions import traffic

# Expected classification per signal combination.
CASES = [
    ("gclid wins over UTM", "email", "email", "promo", "abc123", None, None, None, "cpc", "google", "promo"),
    ("fbclid wins over UTM", "email", "email", "promo", None, "xyz", None, None, "cpc", "facebook", "promo"),
    ("gclid wins over referral", None, None, None, "g1", None, None, "google.com", "cpc", "google", "organic/untracked"),
    ("utm medium used", "nl", "email", "spring", None, None, None, None, "email", "nl", "spring"),
    ("utm campaign, cmpid fallback", "nl", "email", None, None, None, "c123", None, "email", "nl", "c123"),
    ("google referrer organic", None, None, None, None, None, None, "google.com", "organic", "google.com", "organic/untracked"),
    ("bing referrer organic", None, None, None, None, None, None, "bing.com", "organic", "bing.com", "organic/untracked"),
    ("other referrer referral", None, None, None, None, None, None, "partner.io", "referral", "partner.io", "organic/untracked"),
    ("no signal direct", None, None, None, None, None, None, None, "direct", "direct", "organic/untracked"),
    ("empty referrer is direct", None, None, None, None, None, None, "", "direct", "direct", "organic/untracked"),
]
NAMES = ["case", *("utm_source", "utm_medium", "utm_campaign", "gclid", "fbclid", "cmpid"), "referrer"]


def classify(df, strict=False):
    signals = {n: F.col(n) for n in traffic.CAMPAIGN_PARAMS}
    ref = F.col("referrer")
    return df.select("case", traffic.traffic_medium(signals, ref).alias("medium"),
                     traffic.traffic_source(signals, ref, strict).alias("source"),
                     traffic.traffic_campaign(signals).alias("campaign"))


def test_waterfall(spark):
    df = spark.createDataFrame([c[:8] for c in CASES], ", ".join(f"`{n}` string" for n in NAMES))
    assert sorted(rows(classify(df))) == sorted((c[0], *c[8:]) for c in CASES)


def test_strict_keeps_empty_referrer(spark):
    df = spark.createDataFrame([CASES[-1][:8]], ", ".join(f"`{n}` string" for n in NAMES))
    assert rows(classify(df, strict=True)) == [("empty referrer is direct", "direct", "", "organic/untracked")]


@pytest.mark.parametrize("url, name, expected", [
    ("https://a/?utm_source=x&gclid=1", "gclid", "1"),
    ("https://a/?utm_source=x&gclid=1", "utm_source", "x"),
    ("https://a/?xutm_source=x", "utm_source", None),
    ("https://a/?UTM_SOURCE=x", "utm_source", None),
    ("https://a/?utm_source=&b=1", "utm_source", None),
    ("https://a/?utm_campaign=a%20b#top", "utm_campaign", "a%20b#top"),
    (None, "gclid", None),
])
def test_url_param(spark, url, name, expected):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(traffic.url_param(F.col("url"), name)).first()[0] == expected


def test_rank(spark):
    df = spark.createDataFrame([("cpc",), ("email",), ("organic",), ("referral",), ("direct",)], "m string")
    assert [r[0] for r in df.select(traffic.signal_rank(F.col("m"))).collect()] == [1, 1, 2, 2, 3]
