"""Settings of a run and of access to a document store, from given values and the environment."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

#: Name, default and least value of each numeric setting.
NUMBERS = {
    "JOB_QUEUE_MAXSIZE": (2000, 100),
    "DOWNLOAD_MAX_RETRIES": (4, 1),
    "DOWNLOAD_RETRY_DELAY_SECONDS": (2, 1),
    "DIRECT_DOWNLOAD_CONNECT_TIMEOUT": (20, 5),
    "DIRECT_DOWNLOAD_READ_TIMEOUT": (300, 30),
    "GOOGLE_API_RETRIES": (5, 1),
    "WHISPER_NUM_WORKERS": (2, 1),
}
#: Entries that a listing asks for at once, for one folder and for a walk.
LISTING_PAGE, WALK_PAGE = 100, 1000


def number(name: str, environ: Mapping[str, str]) -> int:
    """A setting, raised to its least value; the default where it is unset or no number."""
    default, least = NUMBERS[name]
    try:
        return max(least, int(environ.get(name) or default))
    except ValueError:
        return default


@dataclass(frozen=True)
class Access:
    """How a document store is entered: kind is service_account or api_key."""

    kind: str
    value: str


def access(credentials: str | None, environ: Mapping[str, str]) -> Access | None:
    """A service account in the credentials' JSON, else a key in it, else the environment's key, else None.

    credentials is the text of a credentials file, null where there is none; one that can't be read
    counts as none.
    """
    try:
        given = json.loads(credentials) if credentials else {}
    except ValueError:
        given = {}
    given = given if isinstance(given, dict) else {}
    if given.get("type") == "service_account":
        return Access("service_account", credentials)
    key = given.get("api_key") or given.get("key") or environ.get("GOOGLE_DRIVE_API_KEY")
    return Access("api_key", key) if key else None
