"""Getting published files over HTTP, with limits. Only the driver asks, and only for what a registry names: some dozen small files."""

from __future__ import annotations

import hashlib
import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from tallywright.sources.catalog import PAGE, Catalog, all_results
from tallywright.sources.raw import MOST_BYTES

AGENT = "tallywright/0.1"
CHUNK = 1 << 16


@dataclass(frozen=True)
class Fetched:
    """What came: ``status`` is None and ``reason`` says why where nothing did."""

    url: str
    status: int | None
    body: bytes | None
    content_type: str | None
    fetched_at: str
    reason: str = ""

    @property
    def sha256(self) -> str | None:
        return None if self.body is None else hashlib.sha256(self.body).hexdigest()


def get(url: str, most: int = MOST_BYTES, timeout: float = 40) -> Fetched:
    """One file. Bytes are counted as they come, as a declared length may be missing or wrong; more than ``most`` are not taken, and
    fewer than declared are no file."""
    now = datetime.now(UTC).isoformat(timespec="seconds")
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as answer:
            kind, parts, total = answer.headers.get("Content-Type"), [], 0
            while part := answer.read(CHUNK):
                total += len(part)
                if total > most:
                    return Fetched(url, answer.status, None, kind, now, f"more than {most} bytes")
                parts.append(part)
            declared = answer.headers.get("Content-Length")
            if declared is not None and int(declared) != total:
                return Fetched(url, answer.status, None, kind, now, f"{total} bytes of {declared}")
            return Fetched(url, answer.status, b"".join(parts), kind, now)
    except urllib.error.HTTPError as e:
        return Fetched(url, e.code, None, e.headers.get("Content-Type"), now, str(e))
    except (OSError, ValueError) as e:
        return Fetched(url, None, None, None, now, str(e))


def body_of(url: str) -> tuple[int, bytes]:
    """Status and bytes, as ``ingest_source`` asks for them; an error where nothing came."""
    found = get(url)
    if found.body is None:
        raise ConnectionError(f"{url}: {found.reason}")
    return found.status or 0, found.body


def search(catalog: Catalog, words: str, fetch: Callable[[str], tuple[int, bytes]] = body_of) -> list[dict]:
    """All datasets that a catalogue finds, page by page."""

    def page(start: int) -> dict:
        status, body = fetch(f"{catalog.endpoint}?{urllib.parse.urlencode({'q': words, 'rows': PAGE, 'start': start})}")
        if status != 200:
            raise ConnectionError(f"{status} from {catalog.endpoint}")
        return json.loads(body)["result"]

    return list(all_results(page))
