"""Prompts to tools by fixed patterns.  A prompt that fits none gets the catalogue, never a guess."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field

from acreflow.serving.reasons import explained
from acreflow.serving.tools import TOOLS, Tables, catalogue, run_tool

#: In order: the first pattern that is found names the tool.
_INTENTS = (
    ("candidates", r"strong candidate|rank|further .*review"),
    ("run_summary", r"run summary"),
    ("totals_by_source", r"records by source|uploaded records|totals? by source"),
    ("artifacts", r"\bartifacts?\b|content identifier"),
    ("assemblages", r"assemblage|adjacent parcels"),
    ("old_roofs", r"\broofs?\b"),
    ("stable_with_signals", r"(stable ownership|no (recorded )?transfer|not exchanged|long[- ]held).*(power|industrial|zoning)"),
    ("power_or_industrial", r"power.*(industrial|zoning)|(industrial|zoning).*power"),
    ("water_views", r"view of (the )?water|water view"),
    ("near_places", r"walking distance|\bnear\b|\bwithin [\d.]+ ?(m|km|met)"),
    ("owner_areas", r"out[- ]of[- ]area|regional owner|local owner"),
    ("no_transfer_since", r"no (recorded )?transfer"),
    ("stable_parcels", r"not exchanged|stable ownership|long[- ]held"),
    ("industrial_signals", r"industrial|zoning"),
)
_PLACES = (("starbucks", r"starbucks"), ("water", r"water"), ("power", r"power"), ("transit", r"transit|transport|bus|train"))


@dataclass(frozen=True)
class Match:
    tool: str
    arguments: dict = field(default_factory=dict)


def match(prompt: str) -> Match | None:
    """The tool and its arguments as the prompt says them; None if it fits no tool."""
    text = prompt.lower()
    name = next((n for n, p in _INTENTS if re.search(p, text)), None)
    if name is None:
        return None
    has, out = TOOLS[name].parameters, {}
    if "years" in has and (m := re.search(r"(\d+)(\+)?\s*(?:or more\s*)?years?", text)):
        out["years"] = int(m[1])
        if "inclusive" in has:
            out["inclusive"] = bool(m[2]) or "or more" in m[0]
    if "min_acres" in has and (m := re.search(r"([\d,]+(?:\.\d+)?)\s*acres?", text)):
        out["min_acres"] = float(m[1].replace(",", ""))
    if "as_of" in has and (m := re.search(r"\d{4}-\d{2}-\d{2}", text)):
        out["as_of"] = dt.date.fromisoformat(m[0])
    if name == "near_places":
        out["kind"] = next((k for k, p in _PLACES if re.search(p, text)), "transit")
        if m := re.search(r"([\d.]+)\s*(km|m\b|met)", text):
            out["metres"] = float(m[1]) * (1000 if m[2] == "km" else 1)
    if name == "owner_areas":
        out["area"] = "regional" if "regional" in text else "local" if "local" in text else "out_of_area"
    if name == "candidates" and (m := re.search(r"top (\d+)", text)):
        out["k"] = int(m[1])
    return Match(name, out)


def answer(prompt: str, tables: Tables, most: int = 50) -> dict:
    """tool, arguments, reasoning, assumptions, rows (at most ``most``, each with its explanation, and whether there are more)."""
    found = match(prompt)
    if found is None:
        return {"tool": None, "message": "no tool fits this question", "catalogue": catalogue()}
    t = TOOLS[found.tool]
    rows = [r.asDict(recursive=True) for r in explained(run_tool(found.tool, tables, **found.arguments)).limit(most + 1).collect()]
    values = {k: found.arguments.get(k, d) for k, (_, d) in t.parameters.items()}
    return {"tool": t.name, "arguments": values, "reasoning": t.reasoning.format(**values), "assumptions": list(t.assumptions), "rows": rows[:most], "more": len(rows) > most}
