"""Chat formatting: records of many layouts become turns, turns become one marked text.

The sorted paths of a record's fields are hashed; the hash selects a declarative mapping
from that layout to turns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map

#: Template: <s>[ROLE]role[/ROLE]text</s>
OPEN, MIDDLE, CLOSE = "<s>[ROLE]", "[/ROLE]", "</s>"
#: Strings that steer a model; inside a text they get a backslash behind their bracket.
CONTROL = r"(/?(?:s>|INST\]|ROLE\]))"
ESCAPE, UNESCAPE = r"([<\[])(\\*)" + CONTROL, r"([<\[])\\(\\*)" + CONTROL
#: Names that stand for a role in layouts that say who a turn is from.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Layout of a record: turns at fixed paths, or a list of turns.

    ``turns`` are (role, paths): the texts at the paths that are there, with a blank
    line between.  With ``each``, every entry of that list is a turn with its role and
    text at ``role`` and ``text``; without it ``role`` and ``text`` are of the record.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""


MAPPINGS = (
    Mapping("turn", ("role", "text"), role="role", text="text"),
    Mapping("messages", ("messages[].role", "messages[].content"), ("system",), (("system", ("system",)),),
            "messages", "role", "content"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), ("system",),
            (("system", ("system",)),), "conversations", "from", "value"),
    Mapping("prompt", ("prompt", "response"), ("system",),
            (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("completion", ("prompt", "completion"), ("system",),
            (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("instruction", ("instruction", "output"), ("input", "system"),
            (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("nested_prompt", ("data.prompt", "data.response"), ("data.system",),
            (("system", ("data.system",)), ("user", ("data.prompt",)), ("assistant", ("data.response",)))),
)


def paths(value, prefix: str = "") -> set[str]:
    """Paths of all fields; list entries share one path, an empty list or object is a path itself."""
    if isinstance(value, dict) and value:
        return set().union(*(paths(v, f"{prefix}.{k}" if prefix else str(k)) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(paths(v, f"{prefix}[]") for v in value))
    return {prefix + "[]" if isinstance(value, list) else prefix}


def fingerprint(found: set[str]) -> str:
    return xxhash.xxh64_hexdigest("\n".join(sorted(found)).encode())


def table_of(mappings: tuple[Mapping, ...]) -> dict[str, Mapping]:
    """Mapping by fingerprint, for each choice of a layout's optional fields."""
    out = {}
    for m in mappings:
        for n in range(len(m.optional) + 1):
            for some in combinations(m.optional, n):
                out[fingerprint({*m.required, *some})] = m
                if m.each:
                    out[fingerprint({f"{m.each}[]", *some})] = m
    return out


def _at(record: dict, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def _turn(record: dict, m: Mapping) -> dict[str, str]:
    role = _text(_at(record, m.role))
    return {"role": ROLES.get(role, role) if m.role == "from" else role, "text": _text(_at(record, m.text))}


def turns_of(record: dict, m: Mapping) -> list[dict[str, str]]:
    """Canonical turns of one record.  Absent and null parts are left out; a null text is empty."""
    out = []
    for role, parts in m.turns:
        values = [_at(record, p) for p in parts]
        if any(v is not None for v in values):
            out.append({"role": role, "text": "\n\n".join(_text(v) for v in values if v is not None)})
    if m.each:
        out += [_turn(entry, m) for entry in _at(record, m.each) or []]
    elif m.role:
        out.append(_turn(record, m))
    return out


def canonical_turns(records: DataFrame, payload: str = "payload", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` with layout, fingerprint and turns (array of role and text).

    ``payload`` is a JSON object.  A layout without a mapping, a null payload and one
    that is no JSON object have null layout and turns, so that nothing is guessed or
    lost; the fingerprint shows which mapping is missing.  Columns of ``records`` with
    the names of results are replaced.
    """
    known = table_of(mappings)
    kept = [c for c in records.columns if c not in ("layout", "fingerprint", "turns")]

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"layout": [], "fingerprint": [], "turns": []}
        for value in batch.column("_payload").to_pylist():
            try:
                record = json.loads(value) if value is not None else None
            except ValueError:
                record = None
            key = fingerprint(paths(record)) if isinstance(record, dict) else None
            m = known.get(key)
            for c, x in zip(out, (m.name if m else None, key, turns_of(record, m) if m else None), strict=True):
                out[c].append(x)
        return {"_row": batch.column("_row")} | out

    inner = records.select(F.struct(*[records[c] for c in kept]).alias("_row"), records[payload].alias("_payload"))
    mapped = arrow_map(inner, run, f"_row {inner.schema['_row'].dataType.simpleString()}, layout string, "
                       "fingerprint string, turns array<struct<role: string, text: string>>")
    return mapped.select("_row.*", "layout", "fingerprint", "turns")


def escaped(text: Column) -> Column:
    """Control strings made harmless; `unescape` is the way back."""
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: str) -> str:
    return re.sub(UNESCAPE, r"\1\2\3", text)


def format_turns(turns: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """``turns`` (role, text, others) with formatted, loss_start and loss_length.

    ``formatted`` is the turn's part of the conversation's text; the parts in order are
    the whole.  The loss mask covers the escaped text of ``learn_role``: loss_length code
    points from loss_start on, none for other roles.  Null roles and texts are empty.
    """
    kept = [c for c in turns.columns if c not in ("formatted", "loss_start", "loss_length")]
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE))
    return turns.select(*kept, head.alias("_head"), escaped(text).alias("_body"), (role == learn_role).alias("_learn")).select(
        *kept, F.concat("_head", "_body", F.lit(CLOSE)).alias("formatted"),
        F.length("_head").cast("long").alias("loss_start"),
        F.when(F.col("_learn"), F.length("_body")).otherwise(0).cast("long").alias("loss_length"))


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    if not (formatted.startswith(OPEN) and formatted.endswith(CLOSE) and MIDDLE in formatted):
        raise ValueError("not a formatted turn")
    role, _, text = formatted[len(OPEN):-len(CLOSE)].partition(MIDDLE)
    return unescape(role), unescape(text)


def read_conversation(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a whole formatted conversation."""
    return [read_turn(part + CLOSE) for part in formatted.split(CLOSE)[:-1]]


def digests(formatted: DataFrame, order: list[str], id_column: str = "conv_id") -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output.

    Turns are parsed where they are; the digest of a conversation takes its turns one by
    one in the order of a shuffle and keeps only its state, however many turns there are.
    Turns with a null id are one conversation.
    """
    def parse(batch: pa.RecordBatch) -> dict:
        roles, texts, losses = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("formatted", "loss_start", "loss_length")]
        for value, start, length in zip(*columns, strict=True):
            role, text = read_turn(value)
            roles.append(role)
            texts.append(text)
            losses.append(unescape(value[start:start + length]))
        return {c: batch.column(c) for c in [id_column, *order]} | {
            "size": batch.column("size"), "role": roles, "text": texts, "loss": losses,
            "masked": [n > 0 for n in columns[2]]}

    kinds = dict(formatted.dtypes)
    head = ", ".join(f"`{c}` {kinds[c]}" for c in [id_column, *order])
    read = arrow_map(
        formatted.select(id_column, *order, "formatted", "loss_start", "loss_length",
                         F.length("formatted").cast("long").alias("size")),
        parse, head + ", size long, role string, text string, loss string, masked boolean")
    ordered = read.repartition(F.col(id_column)).sortWithinPartitions(id_column, *order, "role", "text")
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, current, state = False, None, None
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[id_column, *names])

        def close() -> None:
            n, turns, chars, loss, size = state
            out.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (id_column, "role", "text", "loss", "size")]
            for conversation, role, text, loss, size in zip(*columns, strict=True):
                if not begun or conversation != current:
                    if begun:
                        close()
                    begun, current, state = True, conversation, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += size
            if len(out) > 10_000:
                yield batch_of()
                out.clear()
        if begun:
            close()
        yield batch_of()

    types = [pa.int64() if kinds[id_column] == "bigint" else pa.string(), pa.int64(), pa.string(), pa.int64(),
             pa.string(), pa.int64()]
    if kinds[id_column] not in ("bigint", "string"):
        raise ValueError(f"ids are bigint or string, not {kinds[id_column]}")
    return ordered.mapInArrow(run, f"`{id_column}` {kinds[id_column]}, n_turns long, turns_sha256 string, "
                              "loss_chars long, loss_sha256 string, formatted_chars long")
