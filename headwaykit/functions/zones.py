"""Zone transition tables: a zone's offsets as sorted arrays, for vectorised conversion of wall clocks.

The zone files are read once, on the driver, and go to the workers as bytes with their version, so all
workers of a job convert by the same tables; a worker parses only the zones it meets.
"""

from __future__ import annotations

import hashlib
import importlib.resources
import re
import zoneinfo
from functools import lru_cache
from pathlib import Path

import numpy as np

#: Tables are written out up to this year; later clocks are moved into the 400 years before it, which have the same calendar.
LAST_YEAR = 2500
CYCLE_S = 146_097 * 86_400
LAST_S = int(np.datetime64(f"{LAST_YEAR}-01-01", "s").astype(np.int64))


class Zones:
    """One version of the zone data. files: the content of the zone files by zone name."""

    def __init__(self, version: str, files: dict[str, bytes]) -> None:
        self.version, self.files = version, files
        self.tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def transitions(self, zone: str) -> tuple[np.ndarray, np.ndarray]:
        """(instants, offsets): from instants[i] on (epoch seconds) the zone is offsets[i] seconds ahead of UTC. KeyError for an unknown zone."""
        if zone not in self.tables:
            self.tables[zone] = parse_zone(self.files[zone])
        return self.tables[zone]

    def readings(self, local: np.ndarray, zone: str, unit: int) -> tuple[np.ndarray, np.ndarray]:
        """The two instants that wall clocks can mean, in units of 1/unit s: equal but in an overlap, earlier first.

        A wall clock that a forward change skips takes the offset before the change, in both.
        """
        instants, offsets = self.transitions(zone)
        moved = np.maximum(0, -((LAST_S * unit - local) // (CYCLE_S * unit))) * (CYCLE_S * unit)
        local = local - moved
        change, before, after = instants[1:], offsets[:-1], offsets[1:]
        # Under the old offset a clock runs up to change+before, under the new one it starts at change+after.
        old = np.searchsorted((change + np.maximum(before, after)) * unit, local, side="right")
        new = np.searchsorted((change + np.minimum(before, after)) * unit, local, side="right")
        # In an overlap old < new: both offsets hold. In a gap too, and only the old one counts there.
        first = local - offsets[old] * unit
        second = local - offsets[new] * unit
        if len(change):
            k = np.minimum(old, len(change) - 1)
            gap = (old != new) & (after[k] > before[k])
            second = np.where(gap, first, second)
        return np.minimum(first, second) + moved, np.maximum(first, second) + moved


@lru_cache(maxsize=1)
def installed_zones() -> Zones:
    """The zone data of this machine (system files first, else the tzdata package), under 2 MB."""
    files: dict[str, bytes] = {}
    for zone in sorted(zoneinfo.available_timezones()):
        content = _file(zone)
        if content is not None and content[:4] == b"TZif":
            files[zone] = content
    digest = hashlib.sha256(b"".join(name.encode() + content for name, content in files.items())).hexdigest()[:12]
    return Zones(f"{_release()}-{digest}", files)


def _file(zone: str) -> bytes | None:
    for root in zoneinfo.TZPATH:
        place = Path(root, zone)
        if place.is_file():
            return place.read_bytes()
    try:
        return importlib.resources.files("tzdata").joinpath("zoneinfo", *zone.split("/")).read_bytes()
    except (ImportError, OSError):
        return None


def _release() -> str:
    """The release the data names itself, as far as the installation has it."""
    for root in zoneinfo.TZPATH:
        for name, pattern in (("tzdata.zi", r"# version (\S+)"), ("+VERSION", r"(\S+)")):
            place = Path(root, name)
            if place.is_file() and (found := re.match(pattern, place.read_text().split("\n", 1)[0])):
                return found[1]
    try:
        from importlib.metadata import version

        return version("tzdata")
    except Exception:
        return "unnamed"


def parse_zone(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The table of a zone file (RFC 8536): its own transitions, then those of its closing rule up to LAST_YEAR."""
    header = lambda at: [int(x) for x in np.frombuffer(content, ">u4", 6, at + 20)]
    utc, std, leap, times, types, chars = header(0)
    at, width = 44, 4
    if content[4:5] >= b"2":
        at += times * 5 + types * 6 + chars + leap * 8 + std + utc + 44
        utc, std, leap, times, types, chars = header(at - 44)
        width = 8
    instants = np.frombuffer(content, f">i{width}", times, at).astype(np.int64)
    index = np.frombuffer(content, np.uint8, times, at + times * width)
    kinds = np.frombuffer(content, [("offset", ">i4"), ("dst", "u1"), ("name", "u1")], types, at + times * (width + 1))
    offsets = kinds["offset"].astype(np.int64)
    standard = np.flatnonzero(kinds["dst"] == 0)
    first = offsets[standard[0] if len(standard) else 0]
    after = offsets[index]
    if width == 8:
        end = at + times * (width + 1) + types * 6 + chars + leap * (width + 4) + std + utc
        more, beyond = rule_transitions(content[end:].strip(b"\n").decode("ascii"))
        if not len(more) and len(beyond) and not times:
            first = beyond[0]
        later = more > (instants[-1] if times else np.iinfo(np.int64).min)
        instants, after = np.concatenate((instants, more[later])), np.concatenate((after, beyond[: len(more)][later]))
    before = np.concatenate(([first], after[:-1])) if len(after) else after
    real = after != before
    return np.concatenate(([np.iinfo(np.int64).min // 2], instants[real])), np.concatenate(([first], after[real]))


RULE = re.compile(
    r"(?:<[^>]+>|[A-Za-z]{3,})(?P<std>[+-]?[\d:]+)"
    r"(?:(?:<[^>]+>|[A-Za-z]{3,})(?P<dst>[+-]?[\d:]+)?,(?P<start>[^,/]+)(?:/(?P<at>[+-]?[\d:]+))?,(?P<end>[^,/]+)(?:/(?P<until>[+-]?[\d:]+))?)?"
)


def _hms(text: str) -> int:
    sign = -1 if text.startswith("-") else 1
    h, m, s = ([int(x) for x in text.lstrip("+-").split(":")] + [0, 0])[:3]
    return sign * (h * 3600 + m * 60 + s)


def rule_transitions(rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(instants, offsets) of a closing rule (POSIX TZ) for 1900 to LAST_YEAR; without changes no instants and its one offset."""
    found = RULE.fullmatch(rule)
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    std = -_hms(found["std"])
    if not found["start"]:
        return np.zeros(0, dtype=np.int64), np.array([std])
    dst = -_hms(found["dst"]) if found["dst"] else std + 3600
    years = np.arange(1900, LAST_YEAR + 2)
    start = _rule_days(found["start"], years) * 86_400 + _hms(found["at"] or "2") - std
    end = _rule_days(found["end"], years) * 86_400 + _hms(found["until"] or "2") - dst
    instants = np.concatenate((start, end))
    order = np.argsort(instants, kind="stable")
    return instants[order], np.concatenate((np.full(len(years), dst), np.full(len(years), std)))[order]


def _rule_days(rule: str, years: np.ndarray) -> np.ndarray:
    """Days since 1970 of a rule's day in each year: Mm.w.d (the w-th weekday d, 5 the last), Jn (29 February not counted) or n."""
    year = (years - 1970).astype("datetime64[Y]")
    day = lambda x: x.astype("datetime64[D]").astype(np.int64)
    if rule[0] == "M":
        month, week, weekday = (int(x) for x in rule[1:].split("."))
        start = year.astype("datetime64[M]") + (month - 1)
        first, length = day(start), day(start + 1) - day(start)
        into = (weekday - (first + 4)) % 7 + (week - 1) * 7
        return first + np.where(into >= length, into - 7, into)
    n = int(rule.lstrip("J"))
    leap = day(year + 1) - day(year) == 366
    return day(year) + (n - 1 + (leap & (n > 59)) if rule[0] == "J" else n)
