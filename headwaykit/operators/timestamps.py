"""Texts that name a time, in whatever format, precision and zone, to one instant.

Each text is reduced to its mask: digits become 9, every other character stays as it is. What the shapes
below accept does not depend on which digits a text has, so a mask tells for all its texts alike whether
they are of a shape, and where each field stands. A mask is mapped to a parser once per worker; a parser
reads its texts as slices of one byte table, and wall clocks become instants by the transition tables of
one version of the zone data, sent along by the driver. Masks without a parser, and values that name no
real time, give null.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwaykit.functions.zones import Zones, installed_zones

#: Zone abbreviations in seconds ahead of UTC.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "EST": -18000, "EDT": -14400, "CST": -21600, "CDT": -18000,
    "MST": -25200, "MDT": -21600, "PST": -28800, "PDT": -25200, "IST": 19800,
}
MONTHS = {m: k for k, m in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1)}

CLOCK = r"(?P<H>\d{1,2}):(?P<M>\d{2})(?::(?P<S>\d{2})(?:[.,](?P<f>\d+))?)?"
HALF = r"(?: ?(?P<ap>[AaPp])\.?[Mm]\.?)?"
ZONE = r"(?: ?(?:(?P<off>[+-]\d{2}:?\d{2}|[+-]\d{2})|(?P<abbr>[A-Za-z]{1,4}))?)(?:\[(?P<iana>[A-Za-z_+\-/0-9]+)\])?"

#: What a text can look like, most telling first. Which one fits is settled once per mask.
SHAPES = [
    ("iso", rf"(?P<Y>\d{{4}})-(?P<m>\d{{1,2}})-(?P<d>\d{{1,2}})(?:[Tt ]{CLOCK}{HALF}{ZONE})?"),
    ("ymd", rf"(?P<Y>\d{{4}})/(?P<m>\d{{1,2}})/(?P<d>\d{{1,2}})(?: {CLOCK}{HALF}{ZONE})?"),
    ("compact", r"(?P<Y>\d{4})(?P<m>\d{2})(?P<d>\d{2})[Tt]?(?P<H>\d{2})(?P<M>\d{2})(?P<S>\d{2})(?:[.,](?P<f>\d+))?(?P<abbr>[Zz])?(?P<off>[+-]\d{2}:?\d{2})?"),
    ("slash", rf"(?P<a>\d{{1,2}})/(?P<b>\d{{1,2}})/(?P<Y>\d{{4}})(?:,? {CLOCK}{HALF}{ZONE})?"),
    ("dots", rf"(?P<d>\d{{1,2}})\.(?P<m>\d{{1,2}})\.(?P<Y>\d{{4}})(?:,? {CLOCK}{HALF}{ZONE})?"),
    ("text", rf"(?:[A-Za-z]{{3,9}},? )?(?P<d>\d{{1,2}})[ -](?P<mon>[A-Za-z]{{3,9}})[ -](?P<Y>\d{{4}})(?:,? {CLOCK}{HALF}{ZONE})?"),
    ("text", rf"(?:[A-Za-z]{{3,9}},? )?(?P<mon>[A-Za-z]{{3,9}}) (?P<d>\d{{1,2}}),? (?P<Y>\d{{4}})(?:(?:,| at)? {CLOCK}{HALF}{ZONE})?"),
    ("epoch", r"/Date\((?P<n>-?\d{1,17})(?P<skip>[+-]\d{4})?\)/"),
    ("number", r"(?P<n>\d{1,19})(?:[.,](?P<f>\d+))?"),
    ("clock", rf"{CLOCK}{HALF}"),
]
COMPILED = [(name, re.compile(pattern, re.ASCII)) for name, pattern in SHAPES]

#: Texts of up to so many bytes share a byte table; longer ones, which few shapes allow, have one each.
TABLE_BYTES = 64
DAY_US = 86_400_000_000


def plain(text: str) -> str:
    """Compatibility characters resolved, format characters dropped, blanks of any kind as spaces, digits of any script as 0 to 9."""
    kept = (c for c in unicodedata.normalize("NFKC", text) if unicodedata.category(c) != "Cf")
    return "".join(" " if c.isspace() else str(unicodedata.decimal(c, c)) for c in kept)


def cleaned(texts: pa.Array) -> pa.Array:
    """Without outer blanks and quotes, inner blanks as one space; a null as an empty text."""
    texts = pc.fill_null(texts, "")
    odd = np.flatnonzero(~pc.string_is_ascii(texts).to_numpy(zero_copy_only=False))
    if len(odd):
        mask = np.zeros(len(texts), dtype=bool)
        mask[odd] = True
        texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([plain(texts[i].as_py()) for i in odd.tolist()], type=texts.type))
    flat = pc.replace_substring_regex(texts, r"[\t-\r\x1c-\x20]+", " ")
    return pc.utf8_trim(pc.utf8_trim(pc.utf8_trim(flat, " "), "\"'"), " ")


def byte_tables(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, table): the texts' bytes, padded with zeros, in one table for short texts and one for each longer one; none for empty ones."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    starts, lengths = ends[:-1], np.diff(ends)
    short = np.flatnonzero((lengths > 0) & (lengths <= TABLE_BYTES))
    if len(short):
        width = int(lengths[short].max())
        column = np.arange(width)
        inside = column < lengths[short, None]
        table = np.zeros((len(short), width), dtype=np.uint8)
        table[inside] = content[(starts[short, None] + column)[inside]]
        yield short, table
    for i in np.flatnonzero(lengths > TABLE_BYTES).tolist():
        yield np.array([i]), content[starts[i] : starts[i] + lengths[i]].reshape(1, -1)


def masked(table: np.ndarray) -> np.ndarray:
    """The masks of the rows of a byte table, as byte strings."""
    masks = np.where((table >= 48) & (table <= 57), np.uint8(57), table)
    return np.ascontiguousarray(masks).view(f"S{table.shape[1]}").ravel()


class Parser:
    """Reads all texts of one mask: where its fields stand, and what its letters say."""

    def __init__(self, name: str, match: re.Match, mask: str) -> None:
        self.name = name
        self.at = {group: match.span(group) for group, value in match.groupdict().items() if value is not None}
        word = lambda group: mask[slice(*self.at[group])] if group in self.at else None
        self.month = MONTHS.get((word("mon") or "")[:3].lower(), 0)
        self.half = (word("ap") or "").lower()
        abbreviation = word("abbr")
        self.offset = None if abbreviation is None else ABBREVIATIONS.get(abbreviation.upper())
        self.known = abbreviation is None or self.offset is not None
        self.minus = (word("off") or word("n") or "").startswith("-")
        iana = word("iana")
        #: The zone's name, or None where it has digits and must be read from each text.
        self.iana = iana if iana is not None and "9" not in iana else None

    def number(self, table: np.ndarray, group: str, skip: int = 0, most: int = 19) -> np.ndarray:
        """A field of digits as integers: its first `most` after `skip` characters."""
        if group not in self.at:
            return np.zeros(len(table), dtype=np.int64)
        i, j = self.at[group]
        i += skip
        j = min(j, i + most)
        powers = np.array([10**k for k in range(j - i - 1, -1, -1)], dtype=np.uint64)
        return ((table[:, i:j].astype(np.uint64) - np.uint64(48)) * powers).sum(axis=1, dtype=np.uint64)

    def integer(self, table: np.ndarray, group: str, skip: int = 0, most: int = 18) -> np.ndarray:
        return self.number(table, group, skip, most).astype(np.int64)

    def fraction(self, table: np.ndarray) -> np.ndarray:
        """Microseconds of the digits behind the point."""
        if "f" not in self.at:
            return np.zeros(len(table), dtype=np.int64)
        digits = min(6, self.at["f"][1] - self.at["f"][0])
        return self.integer(table, "f", most=6) * 10 ** (6 - digits)

    def days(self, table: np.ndarray, day_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Days since 1970 and whether the date exists (years 1 to 9999)."""
        year = self.integer(table, "Y")
        if "a" in self.at:
            a, b = self.integer(table, "a"), self.integer(table, "b")
            month, day = np.where(day_first, b, a), np.where(day_first, a, b)
        else:
            day = self.integer(table, "d")
            month = self.integer(table, "m") if "m" in self.at else np.full(len(table), self.month)
        ok = (month >= 1) & (month <= 12) & (year >= 1) & (day >= 1)
        m, y = np.where(ok, month, 1), np.where(ok, year, 1970)
        start = (y - 1970).astype("datetime64[Y]").astype("datetime64[M]") + (m - 1)
        first = start.astype("datetime64[D]")
        length = ((start + 1).astype("datetime64[D]") - first).astype(np.int64)
        return first.astype(np.int64) + day - 1, ok & (day <= length)

    def clock(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Microseconds since midnight, and whether the clock can be."""
        hour, minute, second = self.integer(table, "H"), self.integer(table, "M"), self.integer(table, "S")
        ok = (minute < 60) & (second < 60)
        if self.half:
            ok &= (hour >= 1) & (hour <= 12)
            hour = hour % 12 + (12 if self.half == "p" else 0)
        return ((hour * 60 + minute) * 60 + second) * 1_000_000 + self.fraction(table), ok & ((hour < 24) | (self.name == "clock"))

    def epoch(self, table: np.ndarray, dated: bool) -> tuple[np.ndarray, np.ndarray, bool]:
        """(microseconds, ok, of the day): counts of seconds or parts of them since 1970 or, where there is a service date, since midnight."""
        i, j = self.at["n"]
        width = j - i - self.minus
        if self.name == "epoch":
            n = self.integer(table, "n", skip=self.minus)
            far = n > 9_000_000_000_000_000  # beyond what microseconds hold
            return np.where(far, 0, n) * (-1000 if self.minus else 1000), (n != 0) & ~far, False
        n = self.number(table, "n")
        if width <= 10:
            local = n.astype(np.int64) * 1_000_000 + self.fraction(table)
            if dated and width <= 6:
                return local, (n != 0) | (width > 1), True
            return local, (n != 0) & (width >= 9), False
        scale = {13: 1_000, 16: 1}.get(width, 0)
        if width == 19:
            return (n // np.uint64(1000)).astype(np.int64), n != 0, False
        return n.astype(np.int64) * scale if scale else np.zeros(len(n), dtype=np.int64), (n != 0) & bool(scale), False

    def offsets(self, table: np.ndarray) -> np.ndarray | None:
        """Seconds ahead of UTC where the text says so, else None."""
        if "off" not in self.at:
            return None if self.offset is None else np.full(len(table), self.offset)
        i, j = self.at["off"]
        hours = self.integer(table, "off", skip=1, most=2)
        minutes = self.integer(table, "off", skip=j - i - 2, most=2) if j - i > 3 else 0
        return (hours * 3600 + minutes * 60) * (-1 if self.minus else 1)


def find_parser(mask: bytes) -> Parser | None:
    text = mask.decode("latin-1")
    for name, pattern in COMPILED:
        match = pattern.fullmatch(text)
        if match:
            return Parser(name, match, text)
    return None


def nearest(first: np.ndarray, second: np.ndarray, near: np.ndarray, has_near: np.ndarray) -> np.ndarray:
    """Of two readings the one nearer to `near`; the first on a tie, or where there is nothing to be near to."""
    return np.where(has_near & (np.abs(second - near) < np.abs(first - near)), second, first)


class Normaliser:
    """Keeps, per worker, which parser each mask has; texts of a known mask need no further search."""

    def __init__(self, dated: bool, zones: Zones) -> None:
        self.dated, self.zones = dated, zones
        self.parsers: dict[bytes, Parser | None] = {}

    def parser(self, mask: bytes) -> Parser | None:
        if mask not in self.parsers:
            if len(self.parsers) > 100_000 or len(mask) > TABLE_BYTES:  # masks of free text: what is not kept is only searched again
                self.parsers.clear()
            self.parsers[mask] = find_parser(mask)
        return self.parsers[mask]

    def __call__(self, texts: pa.Array, zone: pa.Array, day_first: np.ndarray, near: np.ndarray, has_near: np.ndarray, service_day: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(microseconds, known) of the instants."""
        size = len(texts)
        value, known = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=bool)
        wall, half = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)  # clocks that wait for their zone, 12-hour ones without date
        coded = pc.dictionary_encode(zone)
        names: list[str] = coded.dictionary.to_pylist()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

        def code(name: str) -> int:
            if name not in names:
                names.append(name)
            return names.index(name)

        for rows, table in byte_tables(cleaned(texts)):
            masks, which = np.unique(masked(table), return_inverse=True)
            order = np.argsort(which, kind="stable")
            ends = np.cumsum(np.bincount(which, minlength=len(masks))).tolist()
            for mask, start, end in zip(masks.tolist(), [0, *ends], ends):
                parser = self.parser(mask)
                if parser is None:
                    continue
                picked = order[start:end]
                part, index = table[picked], rows[picked]
                if "n" in parser.at:
                    value[index], ok, of_day = parser.epoch(part, self.dated)
                    if not of_day:
                        known[index] = ok
                        continue
                    offset = None
                else:
                    value[index], ok = parser.clock(part)
                    of_day = parser.name == "clock"
                    offset = parser.offsets(part)
                    ok &= parser.known
                if of_day:
                    day = service_day[index]
                    ok &= day != NO_DAY
                    half[index] = bool(parser.half)
                else:
                    day, real = parser.days(part, day_first[index])
                    ok &= real
                value[index] += np.where(ok, day, 0) * DAY_US
                known[index] = ok
                if offset is not None:
                    value[index] -= offset * 1_000_000
                    continue
                wall[index] = ok
                if parser.iana is not None:
                    codes[index] = code(parser.iana)
                elif "iana" in parser.at:
                    i, j = parser.at["iana"]
                    codes[index] = [code(bytes(x).decode("ascii")) for x in part[:, i:j]]
        for at in sorted(set(codes[wall].tolist())):
            here = np.flatnonzero(wall & (codes == at))
            if at < 0 or names[at] not in self.zones.files:
                known[here] = False
                continue
            value[here] = self.instants(value[here], names[at], near[here], has_near[here], half[here])
        return value, known

    def instants(self, local: np.ndarray, zone: str, near: np.ndarray, has_near: np.ndarray, half: np.ndarray) -> np.ndarray:
        best = nearest(*self.zones.readings(local, zone, 1_000_000), near, has_near)
        if half.any():  # 12-hour clocks cannot say that they passed midnight
            later = nearest(*self.zones.readings(local[half] + DAY_US, zone, 1_000_000), near[half], has_near[half])
            best[half] = nearest(best[half], later, near[half], has_near[half])
        return best


NO_DAY = np.iinfo(np.int64).min


def _convert(batches: Iterator[pa.RecordBatch], dated: bool, zones) -> Iterator[pa.RecordBatch]:
    convert = Normaliser(dated, Zones(*zones.value))
    for batch in batches:
        if not batch.num_rows:
            continue
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        near, day = column("near"), column("service_day")
        value, known = convert(
            column("text"),
            column("zone"),
            column("day_first").fill_null(False).to_numpy(zero_copy_only=False).astype(bool),
            near.fill_null(0).to_numpy(zero_copy_only=False),
            near.is_valid().to_numpy(zero_copy_only=False),
            day.fill_null(NO_DAY).to_numpy(zero_copy_only=False),
        )
        yield pa.RecordBatch.from_arrays([column("id"), pa.array(value, type=pa.int64(), mask=~known)], names=["id", "instant_us"])


def to_instants(rows: DataFrame, id_column: str, text: str, zone: str, day_first: str, near: str, service_date: str | None = None, zones: Zones | None = None) -> DataFrame:
    """(id, instant_us): the instant each row's text names, null if it names none.

    zone and day_first say how texts without zone and dates with slashes are meant, near which of
    several readings (the nearest). With service_date, clocks and counts of seconds of up to six
    digits belong to that day's wall clock and may pass 24 h; without, they name no time. Years go from 1
    to 9999. A null text, a zone that is null or unknown where it is needed, and a bare 0 give null;
    repeated rows are kept. zones: the version of the zone data to convert by, the driver's own by default.
    """
    used = zones or installed_zones()
    shipped = rows.sparkSession.sparkContext.broadcast((used.version, used.files))  # under 2 MB
    picked = rows.select(
        F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(zone).alias("zone"), F.col(day_first).alias("day_first"),
        F.unix_micros(near).alias("near"),
        (F.unix_date(service_date) if service_date else F.lit(None)).cast("long").alias("service_day"),
    )
    return picked.mapInArrow(partial(_convert, dated=service_date is not None, zones=shipped), f"id {dict(rows.dtypes)[id_column]}, instant_us bigint")


def raw_instants(raw: DataFrame, sources: DataFrame) -> DataFrame:
    """to_instants of the raw records, each on the clock of its source."""
    # One row per source name; the registry of sources is small only by nature, so the join is left to the planner.
    known = sources.groupBy("source").agg(F.min("zone").alias("zone"), F.min("day_first").alias("day_first"))
    return to_instants(raw.join(known, "source", "left"), "raw_id", "vehicle_timestamp", "zone", "day_first", "ingestion_timestamp")


def schedule_instants(features: DataFrame, zone: str = "America/New_York") -> DataFrame:
    """to_instants of scheduled_arrival, month first, clocks on the service date."""
    rows = features.withColumns({"_zone": F.lit(zone), "_day_first": F.lit(False)})
    return to_instants(rows, "feature_row", "scheduled_arrival", "_zone", "_day_first", "arrival_estimate", "service_date")
