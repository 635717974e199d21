"""The reports as temporary views, for readers who write SQL.

A view over the clock is evaluated anew each time it is read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from rivermark.plans import events, leads


def reports(tables: Mapping[str, DataFrame], ordered: bool = True) -> dict[str, DataFrame]:
    """The views whose tables are given, by name."""
    found: dict[str, DataFrame] = {}
    if "eventos_raw" in tables:
        raw = tables["eventos_raw"]
        found["vw_eventos_ultimas_24h"] = events.last_day_summary(raw, ordered=ordered)
        found["vw_eventos_por_hora"] = events.hourly_by_category(raw, ordered=ordered)
    if "leads" in tables:
        found["v_leads_qualificados"] = leads.qualified_leads(tables["leads"], ordered=ordered)
    if "leads" in tables and "chat_sessions" in tables:
        people, chats = tables["leads"], tables["chat_sessions"]
        found["v_leads_resumo"] = leads.leads_summary(people, chats)
        found["v_sessoes_ativas"] = leads.active_sessions(chats, people, ordered=ordered)
    return found


def create_views(tables: Mapping[str, DataFrame], ordered: bool = True) -> list[str]:
    """Makes the tables and their reports readable in SQL; returns all names."""
    named = {**tables, **reports(tables, ordered)}
    for name, frame in named.items():
        frame.createOrReplaceTempView(name)
    return list(named)
