"""Endpoints that fail by rule, for unit tests of failover."""

from __future__ import annotations


class RuleTransport:
    """In-process transport whose failures follow an arithmetic rule.

    For a request with integer key ``k`` on host number ``h`` (position in
    the host list) at attempt ``a``:

    - ``k % down_mod == 0``: every attempt fails;
    - ``k % late_mod == 0``: attempts up to the number of hosts fail, the
      next succeeds (so only the final retry on the last host gets through);
    - otherwise it fails when ``(k + h) % host_mod == 0``.

    The same rule is plain SQL arithmetic, so outcomes can be checked
    against an independent query.
    """

    def __init__(self, hosts: list[str], down_mod: int = 17, late_mod: int = 13, host_mod: int = 3):
        self.index = {h: i for i, h in enumerate(hosts)}
        self.n = len(hosts)
        self.down_mod, self.late_mod, self.host_mod = down_mod, late_mod, host_mod

    def send(self, host: str, target: str, body, key: str, attempt: int) -> None:
        k, h = int(key), self.index[host]
        if k % self.down_mod == 0:
            raise ConnectionError(f"{host} refused request {k}")
        if k % self.late_mod == 0:
            if attempt <= self.n:
                raise ConnectionError(f"{host} timed out on request {k}")
            return
        if (k + h) % self.host_mod == 0:
            raise ConnectionError(f"{host} failed request {k}")


class FlakyTransport:
    """Fails the first ``failures`` attempts of every request, then succeeds."""

    def __init__(self, failures: int):
        self.failures = failures

    def send(self, host: str, target: str, body, key: str, attempt: int) -> None:
        if attempt <= self.failures:
            raise ConnectionError(f"attempt {attempt} to {host} failed")
