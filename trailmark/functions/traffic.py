"""Campaign parameters in URLs and the traffic-source waterfall."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmark.functions.numbers import blank_to_null

# The URL parameters that carry campaign signals.
CAMPAIGN_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "gclid", "fbclid", "cmpid")

# Labels the waterfall assigns.
PAID_MEDIUM = "cpc"
UNTRACKED_CAMPAIGN = "organic/untracked"


def capture(text: Column, pattern: str) -> Column:
    """First capture group, NULL when the pattern does not occur.

    regexp_extract gives '' for no match, so this needs a group that cannot match empty text.
    """
    return blank_to_null(F.regexp_extract(text, pattern, 1))


def url_param(url: Column, name: str, decode: bool = False) -> Column:
    """Value of one query parameter; case-sensitive, up to the next ``&``, '#' not special.

    Most URLs lack most parameters, and a substring test is far cheaper than a regex miss.
    """
    value = F.when(url.contains(f"{name}="), capture(url, f"[?&]{name}=([^&]+)"))
    return F.try_url_decode(value) if decode else value


def campaign_params(url: Column, decode: bool = False) -> dict[str, Column]:
    return {name: url_param(url, name, decode) for name in CAMPAIGN_PARAMS}


def traffic_medium(signals: dict[str, Column], referrer: Column) -> Column:
    """Click id, then utm_medium, then search referrer, then other referrer, then direct."""
    search = referrer.ilike("%google.%") | referrer.ilike("%bing.%")
    return (
        F.when(signals["gclid"].isNotNull() | signals["fbclid"].isNotNull(), PAID_MEDIUM)
        .when(signals["utm_medium"].isNotNull(), signals["utm_medium"])
        .when(search, "organic")
        .when(referrer != "", "referral")
        .otherwise("direct")
    )


def traffic_source(signals: dict[str, Column], referrer: Column, strict: bool = False) -> Column:
    """Click-id owner, utm_source, referrer, direct.  ``strict`` lets an empty referrer through."""
    return F.coalesce(
        F.when(signals["gclid"].isNotNull(), "google"),
        F.when(signals["fbclid"].isNotNull(), "facebook"),
        signals["utm_source"],
        referrer if strict else blank_to_null(referrer),
        F.lit("direct"),
    )


def traffic_campaign(signals: dict[str, Column]) -> Column:
    return F.coalesce(signals["utm_campaign"], signals["cmpid"], F.lit(UNTRACKED_CAMPAIGN))


def signal_rank(medium: Column) -> Column:
    """1 for paid or tagged traffic, 2 for organic and referral, 3 for direct."""
    return F.when(medium == "direct", 3).when(medium.isin("organic", "referral"), 2).otherwise(1)
