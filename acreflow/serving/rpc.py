"""The tool interface: JSON-RPC 2.0, a message a line, over any pair of streams (standard input and output)."""

from __future__ import annotations

import json
from typing import IO

from acreflow.serving.agent import answer
from acreflow.serving.tools import Tables, catalogue, run_tool

PROTOCOL = "2024-11-05"
_ASK = {"name": "ask", "description": "A question in words, matched to one of the other tools.", "inputSchema": {"type": "object", "properties": {"prompt": {"type": "string"}}, "required": ["prompt"]}}


def handle(message: dict, tables: Tables, most: int = 200) -> dict | None:
    """The reply to one message; None for notifications."""
    method, params, key = message.get("method"), message.get("params") or {}, message.get("id")
    if key is None:
        return None
    reply = lambda result: {"jsonrpc": "2.0", "id": key, "result": result}
    if method == "initialize":
        return reply({"protocolVersion": PROTOCOL, "capabilities": {"tools": {}}, "serverInfo": {"name": "acreflow", "version": "1"}})
    if method == "ping":
        return reply({})
    if method == "tools/list":
        return reply({"tools": [*catalogue(), _ASK]})
    if method == "tools/call":
        name, arguments = params.get("name"), params.get("arguments") or {}
        try:
            if name == "ask":
                out = answer(str(arguments["prompt"]), tables, most)
            else:
                df = run_tool(name, tables, **arguments)
                rows = [r.asDict(recursive=True) for r in df.limit(most + 1).collect()]
                out = {"rows": rows[:most], "more": len(rows) > most, "schema": json.loads(df.schema.json())}
            return reply({"content": [{"type": "text", "text": json.dumps(out, default=str)}], "isError": False})
        except Exception as e:  # whatever a tool fails with, the server answers and goes on
            return reply({"content": [{"type": "text", "text": f"{type(e).__name__}: {str(e)[:500]}"}], "isError": True})
    return {"jsonrpc": "2.0", "id": key, "error": {"code": -32601, "message": f"no such method: {method}"}}


def serve(tables: Tables, source: IO[str], target: IO[str]) -> None:
    """Answers lines of ``source`` on ``target`` until it ends."""
    for line in source:
        if not line.strip():
            continue
        try:
            out = handle(json.loads(line), tables)
        except json.JSONDecodeError as e:
            out = {"jsonrpc": "2.0", "id": None, "error": {"code": -32700, "message": str(e)}}
        if out is not None:
            target.write(json.dumps(out) + "\n")
            target.flush()
