"""Transports for delivery: how one request reaches one host.

A transport is any object with ``send(host, target, body, key, attempt)``
that returns on success and raises on failure (``close()`` is optional).
Delivery builds one transport per task through a zero-argument factory, so
connections are opened on the executor, never pickled from the driver.
"""

from __future__ import annotations

import urllib.request

# Connect and read timeouts of the endpoint client, seconds.
CONNECT_TIMEOUT_S = 30
READ_TIMEOUT_S = 90


class HttpTransport:
    """POST the body to ``host + target`` (stdlib HTTP, no pooling).

    ``key`` goes out as an ``Idempotency-Key`` header: delivery is
    at-least-once (a retried or speculative task sends again), so the
    endpoint can drop repeats.
    """

    def __init__(self, content_type: str = "application/octet-stream",
                 headers: dict[str, str] | None = None,
                 timeout: float = CONNECT_TIMEOUT_S + READ_TIMEOUT_S):
        self.content_type = content_type
        self.headers = dict(headers or {})
        self.timeout = timeout

    def send(self, host: str, target: str, body: bytes, key: str, attempt: int) -> None:
        data = body.encode("utf-8") if isinstance(body, str) else body
        req = urllib.request.Request(host.rstrip("/") + target, data=data, method="POST")
        req.add_header("Content-Type", self.content_type)
        req.add_header("Idempotency-Key", key)
        for k, v in self.headers.items():
            req.add_header(k, v)
        with urllib.request.urlopen(req, timeout=self.timeout) as resp:  # noqa: S310
            if resp.status // 100 != 2:
                raise OSError(f"HTTP {resp.status} from {host}")
