"""Transports: how one page of an endpoint is fetched.

A transport is any object with ``fetch(endpoint, params) -> dict``. It is built
inside the task from the ``transport.*`` options of the source, so neither
connections nor secrets travel with the plan beyond those options.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request


class HttpTransport:
    """GET requests with a bearer token, retried on 429, server errors, broken connections and timeouts.

    The token comes from the environment variable that ``token_env`` names, so it is in no plan.
    """

    def __init__(self, options: dict[str, str]):
        self.base_url = options["base_url"].rstrip("/")
        self.token = os.environ.get(options.get("token_env", ""), "")
        self.timeout = float(options.get("timeout", "30"))
        self.retries = int(options.get("retries", "5"))
        self.backoff = float(options.get("backoff", "1"))

    def fetch(self, endpoint: str, params: dict) -> dict:
        url = f"{self.base_url}/{endpoint.lstrip('/')}?{urllib.parse.urlencode(params)}"
        headers = {"Authorization": f"Bearer {self.token}"} if self.token else {}
        for attempt in range(self.retries + 1):
            try:
                request = urllib.request.Request(url, headers=headers)
                with urllib.request.urlopen(request, timeout=self.timeout) as response:
                    return json.load(response)
            except urllib.error.HTTPError as error:
                if attempt == self.retries or not (error.code == 429 or error.code >= 500):
                    raise
                wait = error.headers.get("Retry-After") if error.headers else None
                time.sleep(float(wait) if wait and wait.isdigit() else self.backoff * 2**attempt)
            except (urllib.error.URLError, TimeoutError, ConnectionError):
                if attempt == self.retries:
                    raise
                time.sleep(self.backoff * 2**attempt)
        raise AssertionError("unreachable")
