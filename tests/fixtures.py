"""Raw dump fixtures: gzipped JSON-lines files in the shape of event dumps.

Event ``i`` of an hour happens ``97 * i`` seconds after its start. Ids count the
hours since the start of 2024 in steps of 500; every fourth event writes its ids
and its public flag as strings. Odd events carry members that the envelope does
not name (``org``, ``actor.avatar_url``).
"""

from __future__ import annotations

import datetime as dt
import gzip
import json
from pathlib import Path

START = dt.datetime(2024, 1, 1)
KINDS = {"PushEvent": 3, "WatchEvent": 2, "IssuesEvent": 1, "PullRequestEvent": 1, "ForkEvent": 1}
WHEEL = [kind for kind, weight in KINDS.items() for _ in range(weight)]


def event_id(day: dt.date, hour: int, i: int) -> int:
    hours = (dt.datetime.combine(day, dt.time(hour)) - START) // dt.timedelta(hours=1)
    return 7 + 500 * hours + i


def event(day: dt.date, hour: int, i: int) -> dict:
    number = event_id(day, hour, i)
    as_text = str if i % 4 == 3 else (lambda v: v)
    out = {
        "id": str(number),
        "type": WHEEL[i % len(WHEEL)],
        "actor": {"id": as_text(number + 11), "login": f"dev-{number}", "display_login": f"Dev {number}"},
        "repo": {"id": as_text(3 * number), "name": f"team/project-{number}"},
        "payload": {"size": i, "ref": f"refs/heads/b{i}"},
        "public": "true" if i % 4 == 3 else True,
        "created_at": (dt.datetime.combine(day, dt.time(hour)) + dt.timedelta(seconds=97 * i)).isoformat() + "Z",
    }
    if i % 2:
        out["org"] = {"id": i, "login": f"org-{i}"}
        out["actor"]["avatar_url"] = f"https://example.invalid/{number}.png"
    return out


def write_hour(folder: Path, day: dt.date, hour: int, n: int, extra_lines: list[str] | None = None) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{day.isoformat()}-{hour}.json.gz"
    lines = [json.dumps(event(day, hour, i)) for i in range(n)] + list(extra_lines or [])
    path.write_bytes(gzip.compress("".join(line + "\n" for line in lines).encode()))
    return path


def write_days(folder: Path, start: dt.date, days: int, hours: int, per_hour: int) -> list[str]:
    slots = [(start + dt.timedelta(days=d), h) for d in range(days) for h in range(hours)]
    return [str(write_hour(folder, day, h, per_hour)) for day, h in slots]
