"""The fixture as DuckDB CTEs."""

from __future__ import annotations

import re

from trailmark.sources.landing import EXPORT_USERS_SQL, STAR_SQL

BASE = """
  fx_gaps AS (
    SELECT event_id AS id, 'd' || cast(user_id AS string) AS user_id, ts AS event_time, event_type,
           cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k, value, user_id AS u,
           lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev
    FROM events),
  fx_numbered AS (
    SELECT *, sum(CASE WHEN prev IS NULL OR event_time > prev + INTERVAL 24 HOUR THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY event_time) AS n FROM fx_gaps),
  fx_base AS (
    SELECT id, user_id, event_time, event_type, k, value, u,
           user_id || '-' || cast(cast(n AS bigint) AS string) AS session_id FROM fx_numbered)"""


def _needs(text: str, known: dict[str, str]) -> list[str]:
    return [n for n in known if re.search(rf"\b{n}\b", text)]


def with_fx(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it mentions: ``fx_<star table>`` and any of ``extra``.

    ``extra`` CTEs may mention each other (in dict order) and star tables.
    """
    extra = extra or {}
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in _needs(text, extra):
            if name not in wanted:
                visit(extra[name])
                wanted.append(name)

    visit(body)
    parts = [f"  {n} AS ({extra[n]})" for n in wanted]
    everything = body + " ".join(extra[n] for n in wanted)
    stars = [n for n in STAR_SQL if re.search(rf"\bfx_{n}\b", everything)]
    ctes = [f"  fx_{n} AS ({STAR_SQL[n]})" for n in stars]
    if any("fx_base" in STAR_SQL[n] for n in stars) or re.search(r"\bfx_base\b", everything):
        ctes.insert(0, BASE)
    if re.search(r"\bfx_export_users\b", everything):
        ctes.append(f"  fx_export_users AS ({EXPORT_USERS_SQL})")
    ctes += parts
    return "WITH " + ",\n".join(ctes) + "\n" + body if ctes else body
