"""One gate on the driver through which the workers of a job go: turns at an interval, and a bounded number of leases.

A worker asks over a connection of its own, so that both bounds hold over all partitions and executors. A lease lasts as
long as its connection: the system of a worker that is lost closes it, and the lease is free again.
"""

from __future__ import annotations

import asyncio
import contextlib
import secrets
import socket
import socketserver
import threading
import time
from collections.abc import AsyncIterator, Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Pass:
    """How workers reach a gate; it is sent to them with the job."""

    host: str
    port: int
    secret: str

    def _ask(self, what: str) -> bytes:
        return f"{self.secret} {what}\n".encode()

    @contextlib.contextmanager
    def _asked(self, what: str) -> Iterator[None]:
        with socket.create_connection((self.host, self.port)) as connection:
            connection.sendall(self._ask(what))
            if connection.recv(3) != b"go\n":
                raise ConnectionError("the gate is closed")
            yield

    def turn(self) -> None:
        """Wait until the next request may be made."""
        with self._asked("turn"):
            pass

    def stop(self, why: str) -> None:
        """Tell the driver that the job is to end."""
        with self._asked(f"stop {why}".replace("\n", " ")[:2000]):
            pass

    @contextlib.asynccontextmanager
    async def lease(self) -> AsyncIterator[None]:
        """Wait for one of the leases, and hold it inside."""
        reader, writer = await asyncio.open_connection(self.host, self.port)
        try:
            writer.write(self._ask("lease"))
            if await reader.read(3) != b"go\n":
                raise ConnectionError("the gate is closed")
            yield
        finally:
            writer.close()


class Gate:
    """``with Gate(spark, interval, leases) as gate:`` - ``gate.ticket`` goes to the workers. ``stopped`` tells why a worker ended the job."""

    def __init__(self, spark: SparkSession, interval: float = 0.0, leases: int | None = None, on_stop: Callable[[], None] | None = None):
        self.interval, self.on_stop, self.stopped = max(0.0, interval), on_stop, None
        self._free = threading.Semaphore(max(1, leases)) if leases else None
        self._turns, self._next = threading.Lock(), 0.0
        host = spark.conf.get("spark.driver.host", None) or "127.0.0.1"
        secret, gate = secrets.token_hex(16), self

        class Handler(socketserver.StreamRequestHandler):
            def handle(self) -> None:
                told, _, what = self.rfile.readline(4096).decode(errors="replace").rstrip("\n").partition(" ")
                if secrets.compare_digest(told.encode(), secret.encode()):
                    with contextlib.suppress(OSError):  # a worker that went away
                        gate._serve(self, what)

        class Server(socketserver.ThreadingTCPServer):
            daemon_threads, allow_reuse_address, request_queue_size = True, True, 1024

        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        self._server = Server(("127.0.0.1" if local else "", 0), Handler)
        self.ticket = Pass("127.0.0.1" if local else host, self._server.server_address[1], secret)

    def _serve(self, asker: socketserver.StreamRequestHandler, what: str) -> None:
        if what == "turn":
            with self._turns:
                now = time.monotonic()
                at = max(now, self._next)
                self._next = at + self.interval
            time.sleep(max(0.0, at - now))
            asker.wfile.write(b"go\n")
        elif what == "lease":
            with self._free or contextlib.nullcontext():
                asker.wfile.write(b"go\n")
                asker.rfile.read(1)  # until the worker closes
        elif what.startswith("stop "):
            first, self.stopped = self.stopped is None, self.stopped or what[5:]
            asker.wfile.write(b"go\n")
            if first and self.on_stop:
                self.on_stop()

    def __enter__(self) -> Gate:
        threading.Thread(target=self._server.serve_forever, daemon=True).start()
        return self

    def __exit__(self, *_: object) -> None:
        self._server.shutdown()
        self._server.server_close()
