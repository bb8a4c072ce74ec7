"""Every declared name finds its column; ambiguous names are refused."""

import pytest

from trailmark.plans import model
from trailmark.plans.metrics import FACTS, fact_aggregate


class Frame:
    def __init__(self, columns):
        self.columns = columns


TABLES = {t: Frame(list(model.ALIASES.get(t, {}))) for t in model.TABLES}
CASES = [(t, c, n) for t, columns in model.ALIASES.items() for c, names in columns.items() for n in names]


@pytest.mark.parametrize(("table", "column", "name"), CASES)
def test_name_on_its_own_table(table, column, name):
    assert model.find_column(TABLES, table, name) == (table, column)
    assert model.find_column(TABLES, table, name.replace(" ", "_").upper()) == (table, column)


@pytest.mark.parametrize(("base", "name", "want"), [
    ("requests", "endpoint", "requests.request_url_full_url"), ("requests", "full url", "requests.request_url_full_url"),
    ("clicks", "full url", "source_properties.url_full_url"), ("events", "event id", "events.id"),
    ("events", "name", "users.user_display_name"), ("loads", "user identifier", "events.user_id"),
])
def test_name_elsewhere(base, name, want):
    assert model.find_column(TABLES, base, name) == tuple(want.split("."))


def test_ambiguity_is_refused(monkeypatch):
    monkeypatch.setitem(model.ALIASES, "copies", {"target_text": ("marked text",)})
    monkeypatch.setitem(model.ALIASES, "pastes", {"target_text": ("marked text",)})
    with pytest.raises(KeyError, match="ambiguous"):
        model.find_column(TABLES, "events", "marked text")
    assert model.find_column(TABLES, "copies", "marked text") == ("copies", "target_text")


@pytest.mark.parametrize("name", FACTS)
def test_facts_by_name_and_column(name):
    base, column = FACTS[name]
    for fact in (name, column):
        made = fact_aggregate("x", fact, "max({})")
        assert (made.base, made.sql) == (base, f"max({column})")
