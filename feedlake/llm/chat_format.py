"""Chat formatting: records of any known layout become turns, turns become marked text.

A record's nested field paths (those that some layout knows) are hashed. The hash picks a layout, a
declaration of where its turns stand; all combinations of a layout's optional paths are hashed
beforehand. Turns are written between marks, and what a text has of marks is escaped, so that the
output can be read back without loss.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm import bytesnp

ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Where a record has its turns; a path ends in ``?`` when a record may lack it.

    ``turns`` lists (role, paths): the texts at the paths, empty ones left out, make up one turn. With
    ``items``, the path of a list of objects, ``role`` and ``text`` are paths inside an item; in
    ``pairs`` an item holds several turns, (role, path). Without ``items`` but with ``role`` a record is
    one turn itself and ``order`` its place in the conversation. ``names`` renames roles.
    """

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    pairs: tuple[tuple[str, str], ...] = ()
    order: str = ""
    names: dict[str, str] = field(default_factory=dict)

    def paths(self) -> list[str]:
        inside = [p for p in (self.role, self.text, *(p for _, p in self.pairs)) if p]
        listed = [self.items, *(f"{self.items}[].{p}" for p in inside)] if self.items else inside
        return [*listed, *(p for _, some in self.turns for p in some), *([self.order] if self.order else [])]


LAYOUTS = (
    Layout("row", role="role?", text="text?", order="turn"),
    Layout("messages", turns=(("system", ("system?",)),), items="messages", role="role", text="content?"),
    Layout("exchange", turns=(("system", ("system?",)),), items="conversations", role="from", text="value?", names=ROLE_NAMES),
    Layout("dialogue", items="dialog", pairs=(("user", "user?"), ("assistant", "assistant?"))),
    Layout("instruction", turns=(("system", ("system?",)), ("user", ("instruction", "input?")), ("assistant", ("output",)))),
    Layout("reply", turns=(("system", ("system?",)), ("user", ("instruction", "context?")), ("assistant", ("response",)))),
    Layout("completion", turns=(("system", ("system?",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt", turns=(("system", ("system?",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question", turns=(("user", ("context?", "question")), ("assistant", ("answer",)))),
    Layout("nested", turns=(("system", ("data.system?",)), ("user", ("data.prompt.text",)), ("assistant", ("data.response.text",)))),
)


def _plain(path: str) -> str:
    return path.rstrip("?")


def _listed(paths) -> set[str]:
    """The paths and those of the objects and lists above them, as ``field_paths`` gives them."""
    found = set()
    for path in paths:
        parts = path.split(".")
        found |= {".".join(parts[: k + 1]) for k in range(len(parts))}
    return found | {p.removesuffix("[]") for p in found}


def field_paths(value, at: str = "") -> Iterator[str]:
    """Paths of all fields below a JSON value: a list has ``[]``, its items that are no objects ``[].``."""
    if isinstance(value, dict):
        for key, inner in value.items():
            path = f"{at}.{key}" if at else key
            yield path
            yield from field_paths(inner, path)
    elif isinstance(value, list):
        yield f"{at}[]"
        for inner in value:
            if isinstance(inner, dict):
                yield from field_paths(inner, f"{at}[]")
            else:
                yield f"{at}[]."


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


class Registry:
    """The layouts by fingerprint. Two layouts that an equal set of paths fits are refused."""

    def __init__(self, layouts: tuple[Layout, ...] = LAYOUTS):
        self.known: set[str] = set()
        self.by_print: dict[str, Layout] = {}
        for layout in layouts:
            paths = layout.paths()
            self.known |= _listed(map(_plain, paths)) | ({f"{layout.items}[]."} if layout.items else set())
            optional = sorted({_plain(p) for p in paths if p.endswith("?")})
            if layout.items:  # an empty list has no paths inside
                required = {p for p in paths if not p.endswith("?") and "[]" not in p} | {f"{layout.items}[]"}
                inside = {p for p in paths if not p.endswith("?") and "[]" in p}
                bases = [required | inside, required]
            else:
                bases = [{p for p in paths if not p.endswith("?")}]
            for base in bases:
                for size in range(len(optional) + 1):
                    for some in itertools.combinations(optional, size):
                        key = fingerprint(_listed(base | set(some)))
                        if self.by_print.setdefault(key, layout) is not layout:
                            raise ValueError(f"{layout.name} and {self.by_print[key].name} look alike")

    def layout_of(self, record) -> tuple[str, Layout | None]:
        key = fingerprint({p for p in field_paths(record) if p in self.known})
        return key, self.by_print.get(key)


def _at(record, path: str):
    for part in _plain(path).split("."):
        record = record.get(part) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    """A text as it is, null as empty, anything else as JSON."""
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record, layout: Layout) -> Iterator[tuple[int | None, str, str]]:
    """(place, role, text) of the record's turns; an optional turn that it lacks is left out."""
    if layout.role and not layout.items:
        role = _text(_at(record, layout.role))
        yield _at(record, layout.order), layout.names.get(role, role), _text(_at(record, layout.text))
        return
    place = itertools.count()
    for role, paths in layout.turns:
        texts = [_text(_at(record, p)) for p in paths]
        if all(p.endswith("?") for p in paths) and not any(texts):
            continue
        yield next(place), role, "\n\n".join(t for t in texts if t)
    for item in (_at(record, layout.items) or []) if layout.items else []:
        if layout.pairs:
            for role, path in layout.pairs:
                if isinstance(item, dict) and _plain(path) in item:
                    yield next(place), role, _text(_at(item, path))
        else:
            role = _text(_at(item, layout.role))
            yield next(place), layout.names.get(role, role), _text(_at(item, layout.text))


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(id, record, layout, place, role, text) from (id, record): record is JSON text.

    A record that is null, no JSON or of no known layout gives one row with a null layout and its text
    as ``text``, so nothing is lost. A null role or text is empty; a record without turns has no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registry = Registry(layouts)
        for part, _, _ in bytesnp.portions(batches, "record"):
            rows: list[tuple] = []
            for i, raw in enumerate(part.column("record").to_pylist()):
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                key, layout = registry.layout_of(record)
                if layout is None:
                    rows.append((i, key, None, None, None, raw))
                else:
                    rows.extend((i, key, layout.name, *turn) for turn in turns_of(record, layout))
            at, *columns = zip(*rows, strict=True) if rows else [()] * 6
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["id", "fingerprint", "layout", "place", "role", "text"],
            )

    kind = records.schema["id"].dataType.simpleString()
    return records.select("id", "record").mapInArrow(
        run, f"id {kind}, fingerprint string, layout string, place long, role string, text string"
    )


def as_records(rows: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, record): the columns of each row as JSON, nulls too."""
    record = F.to_json(F.struct(*(F.col(c) for c in columns)), {"ignoreNullFields": "false"})
    return rows.select(F.col(id_col).alias("id"), record.alias("record"))


@dataclass(frozen=True)
class Template:
    """``{opens}role{ends}\\n`` text ``\\n{closes}\\n``; ``guarded`` strings of others are escaped as well."""

    opens: str = "<turn "
    ends: str = ">"
    closes: str = "</turn>"
    guarded: tuple[str, ...] = ("### ", "<|")
    learnt: tuple[str, ...] = ("assistant",)

    def _controls(self) -> str:
        """What gets a backslash in front inside texts: backslashes and whatever could be taken for a mark."""
        marks = sorted({self.opens, self.closes, *self.guarded}, key=len, reverse=True)
        return "|".join([r"\\", *(re.sub(r"([^\w\s])", r"\\\1", m) for m in marks)])

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, f"({self._controls()})", r"\\$1")

    def escape_role(self, role: Column) -> Column:
        return F.regexp_replace(role, r"([\\" + re.escape(self.ends) + r"])", r"\\$1")

    def unescape(self, text: str) -> str:
        return re.sub(f"\\\\({self._controls()})", r"\1", text)

    def turns(self, text: str) -> list[tuple[str, str]]:
        """(role, text) of every turn in formatted text; ValueError if it is none."""
        end = re.escape(self.ends)
        turn = re.compile(
            rf"{re.escape(self.opens)}((?:\\.|[^\\{end}])*+){end}\n((?:\\.|(?!\n{re.escape(self.closes)}\n)[^\\])*+)\n{re.escape(self.closes)}\n",
            re.DOTALL,
        )
        found, at = [], 0
        while at < len(text):
            match = turn.match(text, at)
            if not match:
                raise ValueError(f"no turn at {at}")
            found.append((re.sub(r"\\(.)", r"\1", match[1], flags=re.DOTALL), self.unescape(match[2])))
            at = match.end()
        return found


TEMPLATE = Template()


def formatted(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(id, n, piece, loss_start, loss_end) from (id, place, role, text): one piece of text per turn.

    A conversation's text is its pieces in the order of ``n`` (from 0): by place, a null one last, then
    by role and text, so that equal places and repeated rows have one order; all of them stay. The
    loss mask are the code points from ``loss_start`` up to ``loss_end`` of a piece, null in turns that are not
    learnt. A null role or text is empty; a null id is one conversation. A conversation of any
    length is never held as a whole.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(template.opens), template.escape_role(role), F.lit(f"{template.ends}\n"))
    learnt = role.isin(*template.learnt)
    in_order = Window.partitionBy("id").orderBy(F.col("place").asc_nulls_last(), "role", "text")
    return (
        turns.withColumns({"role": role, "text": text})
        .select("id", F.row_number().over(in_order).alias("n"), "role", "text")
        .select("id", F.col("n") - 1, learnt.alias("learnt"), head.alias("head"), template.escape(F.col("text")).alias("body"))
        .toDF("id", "n", "learnt", "head", "body")
        .select(
            "id",
            "n",
            F.concat("head", "body", F.lit(f"\n{template.closes}\n")).alias("piece"),
            F.when(F.col("learnt"), F.length("head")).alias("loss_start"),
            F.when(F.col("learnt"), F.length("head") + F.length("body")).alias("loss_end"),
        )
    )


def _read_back(template: Template):
    """Digests of what the pieces of each conversation say, one piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first = None, True
        count, size, masked = 0, 0, 0
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def done() -> tuple:
            return now, count, turns.hexdigest(), masked, loss.hexdigest(), size

        for batch in batches:
            ready: list[tuple] = []
            for key, piece, start, end in zip(*(batch.column(c).to_pylist() for c in ("id", "piece", "loss_start", "loss_end")), strict=True):
                if first or key != now:
                    if not first:
                        ready.append(done())
                    now, first = key, False
                    count, size, masked = 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in template.turns(piece):
                    turns.update(f"{role}\n{text}\n".encode())
                    count += 1
                size += len(piece)
                if start is not None:
                    said = template.unescape(piece[start:end])
                    masked += len(said)
                    loss.update(said.encode())
            yield _digests(ready, batch.schema.field("id").type)
        if not first:
            yield _digests([done()], batch.schema.field("id").type)
        bytesnp.release()

    return run


def _digests(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * 6
    kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_back(pieces: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from ``formatted`` pieces.

    Pieces are parsed again; nothing but their text and the loss mask is used. A task holds one batch
    of pieces, however long a conversation is.
    """
    kind = pieces.schema["id"].dataType.simpleString()
    return (
        pieces.repartition("id")
        .sortWithinPartitions("id", "n")
        .select("id", "piece", "loss_start", "loss_end")
        .mapInArrow(
            _read_back(template),
            f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )
