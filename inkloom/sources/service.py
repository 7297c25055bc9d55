"""A captioning service over HTTP: a request is posted, then its event stream read."""

from __future__ import annotations

import base64
import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any


def last_data(lines: Iterable[bytes | str]) -> str | None:
    """The payload of the last ``data:`` line of an event stream that is neither empty nor ``null``."""
    last = None
    for raw in lines:
        line = raw.decode("utf-8", "replace") if isinstance(raw, bytes) else raw
        if line.startswith("data:") and (said := line[5:].strip()) not in ("", "null"):
            last = said
    return last


def reply_of(payload: str | None) -> dict[str, Any]:
    """The fields of a payload; of one value what ``functions.text.service_reply`` is of a column."""
    if not payload or not payload.strip():
        return {"error": "empty_response"}
    try:
        got = json.loads(payload)
        if isinstance(got, list):
            got = got[0] if got else {}
        if isinstance(got, str):
            got = json.loads(got)
        if isinstance(got, dict):
            return got
    except ValueError:
        pass
    return {"error": "parse_failed", "detail": payload[:160]}


@dataclass(frozen=True)
class Service:
    """Asks for a caption of an image's bytes. Plain data, so that it travels to the executors."""

    url: str
    token: str
    model: str
    prompt: str
    timeout: float = 180.0
    open: Callable[..., Any] = urllib.request.urlopen

    def __post_init__(self) -> None:
        if not self.url.startswith("https://"):
            raise ValueError("the service's address must begin with https://")

    def __call__(self, image: bytes) -> dict[str, Any]:
        auth = {"Authorization": f"Bearer {self.token}"}
        body = json.dumps({"data": [self.model, self.prompt, base64.b64encode(image).decode()]}).encode()
        try:
            with self.open(urllib.request.Request(self.url, body, {**auth, "Content-Type": "application/json"}), timeout=self.timeout) as answer:
                event = json.load(answer)["event_id"]
            with self.open(urllib.request.Request(f"{self.url}/{event}", headers=auth), timeout=self.timeout) as stream:
                return reply_of(last_data(stream))
        except urllib.error.HTTPError as e:
            return {"error": f"http_{e.code}"}
