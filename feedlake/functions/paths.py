"""What a landing path says about its file."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROL_NAME = "CONTROL.TXT"


_ROOT = "^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?"  # scheme and authority
_GLOB = re.compile(r"[*?\[{]")


@dataclass(frozen=True)
class Layout:
    """Where the organisation and the feed date stand in a path.

    The default reads ``…/data/{org}/…/finished/{date}/{file}``. For a tree written with
    ``partitionBy`` use ``Layout("/data/org_id=", "/feed_date=")``. With ``org_at`` the organisation
    is that segment of the path, counted from the root, and the date is looked for after it;
    without, the first place of each prefix counts.
    """

    org_prefix: str = "/data/"
    date_prefix: str = "/finished/"
    org_at: int | None = None

    def placed(self, pattern: str) -> Layout:
        """The layout with the organisation's place as an absolute input pattern has it.

        Of several segments that the prefix could mean, the first one with a wildcard counts, or the
        one below the pattern. Relative patterns, and those with a slash in braces, do not tell the
        place.
        """
        path = _plain_pattern(pattern) + "/"
        if self.org_at is not None or not path.startswith("/") or re.search(r"\{[^}]*/", path):
            return self
        before_date = path.rfind(self.date_prefix) + 1 or len(path)
        found = [m.start() + len(self.org_prefix) for m in re.finditer(f"(?={re.escape(self.org_prefix)})", path)]
        found = [e for e in found if e <= before_date]
        segments = {e: path[e:].split("/", 1)[0] for e in found}
        wild = [e for e in found if _GLOB.search(segments[e])] or [e for e in found if not segments[e]]
        if len(found) > 1 and not wild:
            raise ValueError(f"{pattern!r} does not tell which segment is the organisation: set Layout.org_at")
        found = wild or found
        return replace(self, org_at=path[: found[0]].count("/")) if found else self

    def _before_org(self) -> str:
        """Regular expression of what stands before the organisation."""
        prefix = re.escape(self.org_prefix)
        if self.org_at is None:
            return f"^.*?{prefix}"
        return f"{_ROOT}(?:/[^/]*){{{self.org_at - 1}}}/" + re.escape(self.org_prefix.rpartition("/")[2])

    def org_id(self, path: Column) -> Column:
        return F.regexp_extract(path, f"(?s){self._before_org()}([^/]+)/", 1)

    def feed_date(self, path: Column) -> Column:
        date = re.escape(self.date_prefix) + "([^/]+)/"
        if self.org_at is not None:
            date = f"(?s){self._before_org()}[^/]+(?=/).*?{date}"
        return F.regexp_extract(path, date, 1)

    def for_practice(self, directory: Column, practice: Column) -> Column:
        """The same directory under another organisation; only the org segment changes."""
        return F.concat(
            F.regexp_extract(directory, f"(?s)({self._before_org()})", 1),
            practice,
            F.regexp_extract(directory, f"(?s){self._before_org()}[^/]+(/.*)$", 1),
        )

    def any_org(self, path: str) -> str:
        """The same path pattern over all organisations."""
        found = re.match(f"(?s)({self._before_org()})[^/]*(.*)$", path if self.org_at is None else re.sub("(?<![:/])/+", "/", path))
        return f"{found[1]}*{found[2]}" if found else path


def _plain_pattern(pattern: str) -> str:
    """The pattern without scheme, authority and repeated slashes."""
    return re.sub("/+", "/", re.sub(_ROOT, "", pattern)).rstrip("/")


def decoded(path: Column) -> Column:
    """The path itself, from the percent-escaped form in which scans give it."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), plain).otherwise(path)


def scanned_path() -> Column:
    """Path of the file that a row was read from; predicates over it prune files."""
    return decoded(F.col("_metadata.file_path"))


def literal_glob(path: str) -> str:
    """A glob that matches this path alone."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def directory(path: Column) -> Column:
    """Path up to and including the last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def entity_of(name: Column) -> Column:
    """Entity of a data file: its name before the first underscore, null if it has none."""
    return F.when(F.contains(name, F.lit("_")), F.substring_index(name, "_", 1))


def file_kind(path: Column) -> Column:
    """manifest | control | data | unrecognised, decided on the upper-cased whole path."""
    upper = F.upper(path)
    return (
        F.when(F.contains(upper, F.lit("MANIFEST")), "manifest")
        .when(F.contains(upper, F.lit("CONTROL")), "control")
        .when(F.contains(file_name(path), F.lit("_")), "data")
        .otherwise("unrecognised")
    )


def output_name(stem: Column, load_ts: Column) -> Column:
    """``{stem}.{epoch millis}.txt``: the name under which one load of a stem is known."""
    return F.concat(stem, F.lit("."), F.unix_millis(load_ts).cast("string"), F.lit(".txt"))
