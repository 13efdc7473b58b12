"""The page source against a server on this machine: retries, pauses, dead ports, one session a host."""

from __future__ import annotations

import socket
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tidemark.sources import web_pages


@pytest.fixture
def server():
    seen: dict[str, int] = {}
    clients: set[tuple] = set()

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_GET(self):
            n = seen[self.path] = seen.get(self.path, 0) + 1
            clients.add(self.client_address)
            status, headers, body = 200, {}, f"page {self.path}".encode()
            if self.path.startswith("/busy") and n < 3:
                status, headers = 429, {"Retry-After": "0"}
            elif self.path.startswith("/broken"):
                status = 500
            elif self.path.startswith("/missing"):
                status = 404
            elif self.path == "/moved":
                status, headers = 302, {"Location": "/there?x=1"}
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k, v)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", seen, clients
    httpd.shutdown()


def dead_port() -> int:
    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        return s.getsockname()[1]


@pytest.mark.parametrize("way", ["source", "table"])
def test_pages_retries_and_failures(spark, server, way):
    site, seen, clients = server
    dead = f"http://127.0.0.1:{dead_port()}/x"
    urls = [*(f"{site}/p{i}" for i in range(6)), f"{site}/busy", f"{site}/broken", f"{site}/missing", f"{site}/moved", dead, "no url"]
    options = {"retries": 2, "backoff": 0.01, "timeout": 5}
    if way == "source":
        df = web_pages.read_pages(spark, urls, **options)
    else:
        df = web_pages.fetched(spark.createDataFrame([(u,) for u in [*urls, None]], "url string").repartition(3), **options)
    found = {r["url"].removeprefix(site): r for r in df.collect()}
    assert len(found) == len(urls) and all(bytes(found[f"/p{i}"]["body"]) == f"page /p{i}".encode() and found[f"/p{i}"]["attempts"] == 1 for i in range(6))
    assert (found["/busy"]["status"], found["/busy"]["attempts"], found["/busy"]["error"]) == (200, 3, None)
    assert (found["/broken"]["status"], found["/broken"]["attempts"], found["/broken"]["error"], found["/broken"]["body"]) == (500, 3, "HTTP 500", None)
    assert (found["/missing"]["status"], found["/missing"]["attempts"]) == (404, 1) and seen["/missing"] == 1
    assert bytes(found["/moved"]["body"]) == b"page /there?x=1"
    assert found[dead]["status"] is None and "ConnectionRefusedError" in found[dead]["error"] and found[dead]["attempts"] == 3
    assert found["no url"]["attempts"] == 0 and "ValueError" in found["no url"]["error"]
    assert len(clients) == 1  # one connection for the host


def test_pauses():
    assert [web_pages.pause_of(n, 1.5, None, 100) for n in (1, 2, 3)] == [1.5, 3.0, 6.0] and web_pages.pause_of(9, 1.5, None, 100) == 100
    assert web_pages.pause_of(1, 1.5, "7", 100) == 7 and web_pages.pause_of(1, 1.5, "700", 100) == 100 and web_pages.pause_of(1, 1.5, "soon", 100) == 1.5
    later = time.strftime("%a, %d %b %Y %H:%M:%S GMT", time.gmtime(time.time() + 20))
    assert 15 < web_pages.pause_of(1, 1.5, later, 100) <= 20
