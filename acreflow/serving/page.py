"""A page for exploring: each tool is a form, its rows a table.  Standard library only."""

from __future__ import annotations

import html
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, urlsplit

from acreflow.serving.tools import TOOLS, Tables, run_tool


def render(path: str, tables: Tables, most: int = 100) -> tuple[int, str]:
    """(status, page) of a path such as ``/stable_parcels?years=10``."""
    parts = urlsplit(path)
    name = parts.path.strip("/")
    esc = lambda x: html.escape(str(x))
    menu = "".join(f"<li><a href='/{esc(n)}'>{esc(n)}</a>: {esc(t.description)}</li>" for n, t in TOOLS.items())
    body, status = f"<ul>{menu}</ul>", 200
    if name:
        if name not in TOOLS:
            return 404, f"<!doctype html><p>no such page</p><ul>{menu}</ul>"
        given = dict(parse_qsl(parts.query))
        form = "".join(f"<label>{esc(k)} <input name='{esc(k)}' value='{esc(given.get(k, d))}'></label> " for k, (_, d) in TOOLS[name].parameters.items())
        body = f"<p><a href='/'>all</a></p><h1>{esc(name)}</h1><p>{esc(TOOLS[name].description)}</p><form>{form}<button>show</button></form>"
        try:
            df = run_tool(name, tables, **given)
            rows = df.limit(most).collect()
            head = "".join(f"<th>{esc(c)}</th>" for c in df.columns)
            body += f"<table><tr>{head}</tr>" + "".join("<tr>" + "".join(f"<td>{esc(v)}</td>" for v in r) + "</tr>" for r in rows) + "</table>"
            body += "".join(f"<p>Assumption: {esc(a)}</p>" for a in TOOLS[name].assumptions)
        except ValueError as e:
            status, body = 400, body + f"<p>{esc(e)}</p>"
    return status, f"<!doctype html><meta charset='utf-8'><title>acreflow</title>{body}"


def server(tables: Tables, port: int = 0) -> ThreadingHTTPServer:
    """A server on localhost; ``serve_forever`` runs it."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, page = render(self.path, tables)
            self.send_response(status)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.end_headers()
            self.wfile.write(page.encode())

        def log_message(self, *args: object) -> None:
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
