"""Edges of the engine: protocols for what needs a network, a renderer or a cloud, and their pure rules.

Nothing here runs inside a query; implementations are injected (S5-S9, S16-S18, K5, K6).
"""

from __future__ import annotations

import email.utils
import time
import urllib.parse
import urllib.robotparser
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol


class HttpClient(Protocol):
    def get(self, url: str) -> tuple[int, dict[str, str], bytes]: ...


class PageReader(Protocol):
    """Native text or OCR of a document, page by page, from 1."""

    def pages(self, content: bytes) -> list[tuple[int, str]]: ...


class Recognizer(Protocol):
    """OCR of one rendered page."""

    def recognize(self, content: bytes, page: int, languages: str, resolution: int) -> str: ...


def recognized_pages(engine: Recognizer, content: bytes, pages: list[int], *, languages: str = "rus+eng", resolutions: tuple[int, ...] = (200, 300), needs_retry: Callable[[str], bool] = lambda text: len(text.strip()) < 800) -> list[tuple[int, str | None, str | None]]:
    """(page, text, error) of each page; a page whose text needs it is read again at the next resolution, and the longer text stays.

    A page that fails is a row with its error; the others go on.
    """
    out: list[tuple[int, str | None, str | None]] = []
    for page in pages:
        best, error = None, None
        for resolution in resolutions:
            try:
                text = engine.recognize(content, page, languages, resolution)
            except Exception as e:  # noqa: BLE001  one page must not fail the document
                error = f"{type(e).__name__}: {e}"
                continue
            if best is None or len(text.strip()) > len(best.strip()):
                best = text
            if not needs_retry(best):
                break
        out.append((page, best, None if best is not None else error))
    return out


class Drive(Protocol):
    """What an upsert needs of a cloud folder."""

    def find(self, folder: str, name: str) -> str | None: ...

    def create(self, folder: str, name: str, path: str) -> str: ...

    def update(self, file_id: str, path: str) -> str: ...


@dataclass
class UpsertingStorage:
    """K5: a file of one name stays one file: found and updated, else created; with ``archive`` a dated copy too."""

    drive: Drive
    today: Callable[[], str]

    def upsert_file(self, path: str, folder: str, name: str, archive: bool) -> str:
        found = self.drive.find(folder, name)
        link = self.drive.update(found, path) if found is not None else self.drive.create(folder, name, path)
        if archive:
            stem, dot, suffix = name.rpartition(".")
            dated = f"{stem}_{self.today()}.{suffix}" if dot else f"{name}_{self.today()}"
            copy = self.drive.find(folder, dated)
            self.drive.update(copy, path) if copy is not None else self.drive.create(folder, dated, path)
        return link


class CloudStorage(Protocol):
    def upsert_file(self, path: str, folder: str, name: str, archive: bool) -> str: ...


def rtf_pages(content: bytes) -> list[tuple[int, str]]:
    """Plain text of an RTF file as one page; bytes that cannot be decoded are replaced."""
    import re

    text = content.decode("cp1251", "replace")
    text = re.sub(r"\{\\\*?\\?(?:fonttbl|colortbl|stylesheet|info|pict)(?:[^{}]|\{[^{}]*\})*\}", "", text)
    text = re.sub(r"\\u(-?\d+)\??", lambda m: chr(int(m[1]) % 65536), text)
    text = re.sub(r"\\'([0-9a-fA-F]{2})", lambda m: bytes([int(m[1], 16)]).decode("cp1251", "replace"), text)
    text = re.sub(r"\\(?:par|line)\b ?", "\n", text)
    text = re.sub(r"\\tab\b ?", "\t", text)
    text = re.sub(r"\\[a-zA-Z]+-?\d* ?|\\[^a-zA-Z]|[{}]", "", text)
    return [(1, text.strip())]


RETRIED = frozenset({429, 502, 503, 504})


class TransportError(OSError):
    """What a client raises when no answer came."""


class Forbidden(PermissionError):
    """The host's robots rules do not allow the address."""


def asked_wait(headers: dict[str, str], now: float) -> float | None:
    """Seconds that Retry-After asks for, as a number or a date; None without a readable one."""
    value = next((v for k, v in headers.items() if k.lower() == "retry-after"), "").strip()
    if value.isdigit():
        return float(value)
    try:
        return max(0.0, email.utils.parsedate_to_datetime(value).timestamp() - now)
    except (TypeError, ValueError):
        return None


@dataclass
class PolitePacing:
    """At most ``rate`` requests a second; some statuses and transport errors are tried again after a bounded wait.

    With ``robots`` an address is asked for only if its host allows it.
    """

    client: HttpClient
    rate: float = 1.0
    attempts: int = 4
    most_wait: float = 60.0
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    last: float = float("-inf")
    robots: RobotsCache | None = None
    now: Callable[[], float] = time.time

    def get(self, url: str) -> tuple[int, dict[str, str], bytes]:
        if self.robots is not None and not self.robots.is_allowed(url):
            raise Forbidden(url)
        for attempt in range(self.attempts):
            wait = self.last + 1 / self.rate - self.clock()
            if wait > 0:
                self.sleep(wait)
            self.last = self.clock()
            final = attempt + 1 == self.attempts
            headers: dict[str, str] = {}
            try:
                status, headers, body = self.client.get(url)
                if status not in RETRIED or final:
                    return status, headers, body
            except TransportError:
                if final:
                    raise
            asked = asked_wait(headers, self.now())
            self.sleep(min(self.most_wait, 2.0**attempt if asked is None else asked))
        raise AssertionError("not reached")

    def download(self, url: str, path: str | Path) -> int:
        """Bytes written to ``path``, which is there whole or not at all; an answer other than 200 raises."""
        status, _, body = self.get(url)
        if status != 200:
            raise TransportError(f"HTTP {status}: {url}")
        target = Path(path)
        target.parent.mkdir(parents=True, exist_ok=True)
        partial = target.with_name(target.name + ".partial")
        try:
            partial.write_bytes(body)
            partial.replace(target)
        finally:
            partial.unlink(missing_ok=True)
        return len(body)


@dataclass
class RobotsCache:
    """The rules of each host, asked for once in ``lifetime`` seconds."""

    client: HttpClient
    agent: str = "tallyforge"
    lifetime: float = 3600.0
    clock: Callable[[], float] = time.monotonic
    rules: dict[str, tuple[float, urllib.robotparser.RobotFileParser]] = field(default_factory=dict)

    def is_allowed(self, url: str) -> bool:
        parts = urllib.parse.urlsplit(url)
        host = f"{parts.scheme}://{parts.netloc}"
        known = self.rules.get(host)
        if known is None or self.clock() - known[0] > self.lifetime:
            try:
                status, _, body = self.client.get(f"{host}/robots.txt")
                rule = robots_rule(status, body.decode("utf-8", "replace"))
            except TransportError:
                rule = robots_rule(None)
            known = self.rules[host] = (self.clock(), rule)
        return known[1].can_fetch(self.agent, url)


def robots_rule(status: int | None, text: str = "") -> urllib.robotparser.RobotFileParser:
    """200 is parsed, 4xx and network errors (None) allow all, other answers disallow all."""
    rule = urllib.robotparser.RobotFileParser()
    if status == 200:
        rule.parse(text.splitlines())
    elif status is None or 400 <= status < 500:
        rule.allow_all = True
    else:
        rule.disallow_all = True
    rule.modified()  # without a time of reading every address would be refused
    return rule


def replicate(storage: CloudStorage | None, enabled: bool, folder: str, path: str, name: str, archive: bool = False) -> tuple[str | None, str | None]:
    """K6: (link, reason why nothing was sent); the guards are asked in order."""
    if not enabled or storage is None:
        return None, "disabled or no provider"
    if not folder:
        return None, "no folder"
    if not Path(path).exists():
        return None, "no local file"
    return storage.upsert_file(path, folder, name, archive), None
