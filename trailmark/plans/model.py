"""The behaviour star schema: table keys, how tables reach each other, and names for columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

# Tables keyed by event, one row per event of a kind.
EVENT_FACTS = (
    "clicks", "backgrounds", "page_views", "force_restarts", "loads", "cumulative_layout_shifts",
    "first_input_delays", "interaction_to_next_paints", "consents", "copies", "pastes", "highlights",
    "exceptions", "console_messages", "navigates", "form_abandons", "form_input_changes",
    "mouse_thrashes", "elements_seen", "custom_events", "requests", "crashes",
    "source_properties", "element_properties", "page_properties",
)
# Event tables that carry no session or user of their own.
WITHOUT_ACTOR = ("source_properties", "element_properties")
DEFINITIONS = ("page_definitions", "element_definitions", "event_definitions")


@dataclass(frozen=True)
class Table:
    name: str
    key: str
    time: str | None


TABLES: dict[str, Table] = {
    "events": Table("events", "id", "event_time"),
    **{n: Table(n, "event_id", "event_time") for n in EVENT_FACTS},
    "users": Table("users", "id", None),
    "user_properties": Table("user_properties", "user_id", None),
    **{n: Table(n, "id", None) for n in DEFINITIONS},
}


@dataclass(frozen=True)
class Hop:
    """A many-to-one step: ``source.left = target.key``."""

    source: str
    left: str
    target: str

    @property
    def right(self) -> str:
        return TABLES[self.target].key


RELATIONSHIPS: tuple[Hop, ...] = (
    *(Hop("events", "id", n) for n in EVENT_FACTS),
    Hop("events", "user_id", "user_properties"),
    Hop("events", "user_id", "users"),
    Hop("events", "element_definition_id", "element_definitions"),
    Hop("events", "event_definition_id", "event_definitions"),
    Hop("source_properties", "page_definition_id", "page_definitions"),
)


def route(base: str, target: str) -> list[Hop]:
    """Many-to-one hops from ``base`` to ``target``; raises where only one-to-many paths exist.

    Event tables share ``event_id`` and reach each other directly.  Definitions of elements and
    events hang off ``events``; page definitions off the event's context row.
    """
    if target == base:
        return []
    direct = [h for h in RELATIONSHIPS if h.source == base and h.target == target]
    if direct:
        return direct
    per_event = base == "events" or base in EVENT_FACTS
    if per_event and target == "page_definitions":
        return [*route(base, "source_properties"), Hop("source_properties", "page_definition_id", target)]
    if base in EVENT_FACTS:
        if target in EVENT_FACTS or target == "events":
            return [Hop(base, "event_id", target)]
        if target in ("users", "user_properties") and base not in WITHOUT_ACTOR:
            return [Hop(base, "user_id", target)]
        return [Hop(base, "event_id", "events"), *route("events", target)]
    if (base, target) == ("users", "user_properties"):
        return [Hop(base, "id", target)]
    if (base, target) == ("user_properties", "users"):
        return [Hop(base, "user_id", target)]
    raise ValueError(f"{target} is not many-to-one from {base}: it would repeat {base} rows")


# Short names for dimensions whose column name does not say them.
DIMENSION_NAMES: dict[str, str] = {
    "page": "page_definitions.name",
    "named page": "page_definitions.name",
    "defined page name": "page_definitions.name",
    "named element": "element_definitions.name",
    "defined element name": "element_definitions.name",
    "defined event": "event_definitions.name",
    "named event": "event_definitions.name",
    "device type": "source_properties.user_agent_device",
    "form factor": "source_properties.user_agent_device",
    "browser name": "source_properties.user_agent_browser",
    "os": "source_properties.user_agent_operating_system",
    "operating system": "source_properties.user_agent_operating_system",
    "platform": "source_properties.user_agent_operating_system",
    "device os": "source_properties.device_operating_system",
    "state": "source_properties.location_region",
    "province": "source_properties.location_region",
    "coordinates": "source_properties.location_lat_long",
    "geo coordinates": "source_properties.location_lat_long",
    "device brand": "source_properties.device_manufacturer",
    "phone model": "source_properties.device_model",
    "bundle id": "source_properties.app_package_name",
    "current url": "source_properties.url_full_url",
    "page url": "source_properties.url_full_url",
    "domain": "source_properties.url_host",
    "hostname": "source_properties.url_host",
    "page path": "source_properties.url_path",
    "referrer url": "source_properties.initial_referrer_full_url",
    "referring domain": "source_properties.initial_referrer_host",
    "traffic source domain": "source_properties.initial_referrer_host",
    "document title": "source_properties.title",
    "page title": "page_views.page_name",
    "screen name": "page_views.page_name",
    "action name": "custom_events.event_name",
    "conversion event name": "custom_events.event_name",
    "payload": "custom_events.event_properties",
    "button text": "clicks.target_text",
    "click selector": "clicks.target_raw_selector",
    "abandoned field selector": "form_abandons.target_raw_selector",
    "input field selector": "form_input_changes.target_raw_selector",
    "error message": "exceptions.message",
    "exception message": "exceptions.message",
    "source file": "exceptions.exception_source_file",
    "log level": "console_messages.console_message_level",
    "console log text": "console_messages.message",
    "navigation type": "navigates.navigate_reason",
    "consent type": "consents.consent_scope",
    "http method": "requests.request_method",
    "status code": "requests.request_status",
    "http status": "requests.request_status",
    "api url": "requests.request_url_full_url",
    "api host": "requests.request_url_host",
    "app user id": "users.uid",
    "customer user id": "users.uid",
    "email address": "users.user_email",
    "display name": "users.user_display_name",
}

# The names declared for columns, by table and column.
ALIASES: dict[str, dict[str, tuple[str, ...]]] = {
    "events": {
        "element_definition_id": ("element definition id", "named element id"),
        "event_definition_id": ("event definition id", "defined event id"),
        "event_type": ("event category", "type of event"), "id": ("event id", "event identifier"),
        "session_id": ("session id", "session identifier"), "user_id": ("user id", "user identifier"),
        "event_time": ("event timestamp", "time of event"),
    },
    "clicks": {
        "event_id": ("click id",), "fs_dead_count": ("dead count", "dead clicks"), "fs_rage_count": ("rage count", "rage clicks"),
        "fs_error_kind": ("click error type", "error kind"), "is_click_long": ("long press", "long click"),
        "is_click_unhandled": ("unhandled click",), "target_text": ("button text", "element text", "clicked text"),
        "target_raw_selector": ("click selector", "element selector"), "event_time": ("click time",),
    },
    "page_views": {
        "page_name": ("page title", "screen name"), "start_time": ("page load timestamp",),
        "end_time": ("page unload timestamp", "page exit time"),
    },
    "interaction_to_next_paints": {
        "event_name": ("inp trigger", "interaction type"), "target_text": ("inp element text",),
        "target_raw_selector": ("inp element selector",),
    },
    "exceptions": {
        "event_id": ("exception id",), "exception_count": ("burst count",), "exception_source_file": ("file path", "source file"),
        "is_exception_handled": ("caught", "handled"), "message": ("error text", "exception message", "error message"),
    },
    "console_messages": {
        "console_message_level": ("log level", "console level"), "message": ("console error text", "console log text"),
    },
    "navigates": {"navigate_reason": ("navigation type", "nav reason")},
    "form_abandons": {
        "target_raw_selector": ("form field selector", "abandoned field selector"), "target_text": ("abandoned field text",),
    },
    "form_input_changes": {"target_raw_selector": ("input field selector",)},
    "elements_seen": {
        "element_type": ("watched element type",), "element_start_type": ("element state", "element visibility state"),
        "target_text": ("watched element text",), "target_raw_selector": ("watched element selector",),
    },
    "custom_events": {
        "event_name": ("action name", "custom event name", "conversion event name"),
        "event_properties": ("attributes", "payload", "custom properties"),
    },
    "requests": {
        "request_duration_millis": ("latency", "api latency", "request latency"), "request_method": ("http method", "verb"),
        "request_status": ("error code", "http status", "status code"), "request_url_full_url": ("endpoint", "full url", "api url"),
        "request_url_host": ("api host", "request host"), "request_url_path": ("api path", "request path", "endpoint path"),
        "request_url_query": ("query string", "request query params"),
    },
    "consents": {
        "is_consent_given": ("consent granted", "user consented"), "consent_scope": ("consent type", "consent category"),
        "consent_action_type": ("consent action", "consent event type"),
    },
    "source_properties": {
        "title": ("html title", "document title"), "url_full_url": ("current url", "page url", "full url"),
        "url_host": ("domain", "hostname"), "url_path": ("page path", "url path"),
        "page_definition_id": ("named page id", "defined page id"),
        "initial_referrer_full_url": ("referrer url", "referring url", "traffic source url"),
        "initial_referrer_host": ("referrer host", "referring domain", "traffic source domain"),
        "initial_referrer_path": ("referrer path",), "location_city": ("city",), "location_country": ("country",),
        "location_region": ("region", "state", "province"), "location_lat_long": ("coordinates", "lat long", "geo coordinates"),
        "user_agent_browser": ("browser", "browser name"), "user_agent_browser_version": ("browser version",),
        "user_agent_device": ("device type", "form factor"), "user_agent_operating_system": ("operating system", "os", "platform"),
        "device_manufacturer": ("manufacturer", "device brand"), "device_model": ("model", "phone model", "device model"),
        "device_screen_width": ("screen width",), "device_screen_height": ("screen height",),
        "device_viewport_width": ("viewport width", "browser width"), "device_viewport_height": ("viewport height", "browser height"),
        "device_operating_system": ("device os",), "app_name": ("mobile app name", "application name"),
        "app_version": ("app build", "mobile app version"), "app_package_name": ("bundle id", "package name"),
        "entrypoint": ("event origin", "capture method"), "origin": ("capture origin", "event source origin"),
        "integration": ("sdk integration", "capture integration"),
    },
    "users": {
        "uid": ("app user id", "customer user id", "external id", "identified user id"),
        "user_display_name": ("display name", "name", "username"), "user_email": ("email", "email address"),
        "last_updated_time": ("last active", "last seen", "last updated"),
    },
    "page_definitions": {"name": ("named page", "page definition name", "defined page name"), "state": ("page definition status",)},
    "element_definitions": {
        "name": ("named element", "element definition name", "defined element name"), "state": ("element definition status",),
    },
    "event_definitions": {
        "name": ("defined event", "event definition name", "named event"), "state": ("event definition status",),
    },
    "user_properties": {"user_id": ("user identifier",)},
}


def declared(base: str, name: str) -> tuple[str, str] | None:
    """The column a declared name stands for: of the base first, else of the one table that declares it."""
    found = [(t, c) for t, columns in ALIASES.items() for c, names in columns.items() if name in names]
    own = [x for x in found if x[0] == base]
    shared = [x for x in found if x[0] in ("events", *_SHARED)]
    for choice in (own, found if len(found) == 1 else [], shared):
        if len(choice) == 1:
            return choice[0]
    if found:
        raise KeyError(f"{name!r} is ambiguous: {', '.join('.'.join(x) for x in found)}")
    return None


# Prefixes a user leaves out: "browser" means user_agent_browser.
_PREFIXES = ("user_agent_", "location_", "device_", "app_", "url_", "initial_", "user_", "request_", "is_")
_SHARED = ("source_properties", "users")


def find_column(tables: Mapping[str, DataFrame], base: str, name: str) -> tuple[str, str]:
    """(table, column) for a dimension name: ``table.column``, a known short name, a column of the
    base, or a context or user column, with or without its prefix and with spaces or underscores.
    """
    if "." in name:
        table, column = name.split(".", 1)
        return table, column
    plain = name.strip().lower().replace("_", " ")
    own = {c.replace("_", " "): c for c in tables[base].columns}
    if plain in own:
        return base, own[plain]
    if alias := declared(base, plain):
        return alias
    if plain in DIMENSION_NAMES:
        table, column = DIMENSION_NAMES[plain].split(".")
        return table, column
    for table in (base, *_SHARED):
        columns = tables[table].columns
        for candidate in (plain.replace(" ", "_"), *(p + plain.replace(" ", "_") for p in _PREFIXES)):
            if candidate in columns:
                return table, candidate
    raise KeyError(f"unknown dimension {name!r}")
