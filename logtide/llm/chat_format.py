"""Chat formatting by schema fingerprints.

A record's fingerprint is a hash of its sorted nested field paths. It selects a declarative mapping that says where turns,
roles and texts stand, so that prompt, instruction and message layouts all become canonical turns (conversation, position,
role, text). A record with further fields has the fingerprint of the fields that a mapping names, the largest that fits. The fingerprint of a table of typed columns is taken from its schema; records in JSON text have one each.

The template writes each turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. A control string inside a text gets a backslash
after its first character, one more for each that stands there already, which undoing takes off again: the marks of a
formatted conversation are exactly those that the template wrote. The loss mask is the text between the marks of each
assistant turn.

Turns are formatted one by one, without a shuffle, and read back by streaming through partitions sorted by conversation,
so that a conversation of any length needs the memory of its longest turn. Null texts and roles are empty. Turns of one
position stand by role and text; turns without a position come first.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that tokenizers and templates may read as control.
CONTROL = (START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
_ESCAPE = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROL))
_UNDO = re.compile("|".join(f"{re.escape(c[0])}\\\\+{re.escape(c[1:])}" for c in CONTROL))
TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNDO.sub(lambda m: m[0][0] + m[0][2:], text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, first code point of its text, code point after it)."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def json_paths(value, at: str = "") -> set[str]:
    if isinstance(value, dict):
        return {at}.union(*(json_paths(v, f"{at}.{k}") for k, v in value.items())) if value else {at}
    if isinstance(value, list):
        return {f"{at}[]"}.union(*(json_paths(v, f"{at}[]") for v in value))
    return {at}


def schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    if isinstance(kind, T.StructType):
        return {at}.union(*(schema_paths(f.dataType, f"{at}.{f.name}") for f in kind))
    if isinstance(kind, T.ArrayType):
        return {f"{at}[]"} | schema_paths(kind.elementType, f"{at}[]")
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns.

    turns: paths of lists of turns, one after the other, with the paths of role and text in an element; and then fixed: (role,
    paths of the parts of the text) in order. Only null is absent: a turn whose parts are all null is left out, one of empty
    parts has an empty text. Texts of several parts are joined by blank lines, without the empty ones; numbers, truth values and
    objects stand as JSON.
    """

    name: str
    fields: tuple[str, ...]  # the paths that make the fingerprint
    turns: tuple[str, ...] = ()
    role: str = "role"
    text: str = "content"
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    mixed: tuple[str, ...] = ()  # paths of the fingerprint that are plain in some elements and lists in others

    def paths(self) -> set[str]:
        """A list field's own path is written with its brackets only."""
        return {""} | {f".{f}" for f in self.fields if f + "[]" not in self.fields} | {f".{f}" for f in self.mixed}


def listed(*names: str, role: str = "role", text: str = "content", parts: bool = False) -> tuple[str, ...]:
    """Paths of lists of turns, with texts or with lists of parts (type and text)."""
    below = ("", "[]", "[].type", "[].text") if parts else ("",)
    return tuple(x for n in names for x in (n, f"{n}[]", f"{n}[].{role}", *(f"{n}[].{text}{b}" for b in below)))


ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("turn rows", ("conv_id", "turn", "role", "text")),
    Mapping("messages", listed("messages"), ("messages",)),
    Mapping("messages in parts", listed("messages", parts=True), ("messages",)),
    Mapping("messages, some in parts", listed("messages", parts=True), ("messages",), mixed=("messages[].content",)),
    Mapping("conversations", listed("conversations", role="from", text="value"), ("conversations",), "from", "value"),
    Mapping("messages of prompt and completion", listed("prompt", "completion"), ("prompt", "completion")),
    Mapping("messages of a prompt, and completion", (*listed("prompt"), "completion"), ("prompt",), fixed=(("assistant", ("completion",)),)),
    Mapping("messages of prompt and preferred answer", listed("prompt", "chosen"), ("prompt", "chosen")),
    Mapping("preferred messages", listed("chosen"), ("chosen",)),
    Mapping("prompt and preferred answer", ("prompt", "chosen"), fixed=(("user", ("prompt",)), ("assistant", ("chosen",)))),
    Mapping("prompt and response", ("prompt", "response"), fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt and completion", ("prompt", "completion"), fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("question and answer", ("question", "answer"), fixed=(("user", ("question",)), ("assistant", ("answer",)))),
    Mapping("instruction", ("instruction", "output"), fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction with input", ("instruction", "input", "output"), fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("system, instruction and input", ("system", "instruction", "input", "output"), fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
)


REGISTRY = {fingerprint(m.paths()): m for m in MAPPINGS}


def restricted(record: dict, mapping: Mapping) -> dict | None:
    """The part of a record that a mapping speaks of; None if some of it is missing."""
    names = dict.fromkeys(f.split(".")[0].removesuffix("[]") for f in mapping.fields)
    if not names.keys() <= record.keys():
        return None
    body = {n: record[n] for n in names}
    for name in mapping.turns:
        turns = body[name]
        if not isinstance(turns, list) or not all(isinstance(e, dict) and {mapping.role, mapping.text} <= e.keys() for e in turns):
            return None
        # an empty list says nothing of its elements
        body[name] = [{mapping.role: e[mapping.role], mapping.text: _parts(e[mapping.text])} for e in turns] or [{mapping.role: None, mapping.text: None}]
    return body


def _parts(value):
    """A list of parts with their types and texts only."""
    if not isinstance(value, list):
        return value
    return [{k: x[k] for k in ("type", "text") if k in x} if isinstance(x, dict) else x for x in value]


def as_text(value) -> str:
    """A text as it is, the texts of a list of parts by lines, other values as JSON; null is empty."""
    if value is None or isinstance(value, str):
        return value or ""
    if isinstance(value, list) and all(isinstance(x, dict) and "type" in x for x in value):
        return "\n".join(as_text(x["text"]) for x in value if x.get("text") is not None)
    return json.dumps(value, ensure_ascii=False)


def mapping_of(record: dict) -> Mapping | None:
    """The mapping of a record's fingerprint; else the one of most fields whose fingerprint the record has without its other fields."""
    exact = REGISTRY.get(fingerprint(json_paths(record)))
    if exact is not None:
        return exact
    parts = [(m, restricted(record, m)) for m in MAPPINGS]
    fitting = [m for m, part in parts if part is not None and REGISTRY.get(fingerprint(json_paths(part))) is m]
    return max(fitting, key=lambda m: (len(m.fields), m.name), default=None)


def record_turns(record: dict, ignore: frozenset[str]) -> list[tuple[str, str]] | None:
    """Canonical (role, text) turns of a record, or None for a layout that is not registered.

    Fields that no mapping names are set aside (``set_aside`` counts them); an empty list of turns gives no turns.
    """
    body = {k: v for k, v in record.items() if k not in ignore}
    mapping = mapping_of(body)
    if mapping is None or mapping.name == "turn rows":
        return None
    out = [(ROLES.get(r, r), as_text(e[mapping.text])) for name in mapping.turns for e in body[name] for r in [as_text(e[mapping.role])]]
    for role, parts in mapping.fixed:
        found = [as_text(body[p]) for p in parts if body[p] is not None]
        if found:
            out.append((role, "\n\n".join(t for t in found if t)))
    return out


def unused_paths(record: dict, ignore: frozenset[str]) -> set[str]:
    """Paths of a record's values that its mapping has no use for; none for a record without a mapping, which stays whole."""
    body = {k: v for k, v in record.items() if k not in ignore}
    mapping = mapping_of(body)
    return set() if mapping is None else json_paths(body) - json_paths(restricted(body, mapping)) - mapping.paths()


def set_aside(records: DataFrame, record: str, ignore: tuple[str, ...] = ("id",)) -> DataFrame:
    """How many JSON records have a value at each path that formatting leaves out: (path, records)."""
    skipped = frozenset(ignore)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                try:
                    out += sorted(unused_paths(json.loads(text or ""), skipped))
                except (ValueError, AttributeError, TypeError):
                    pass  # no object: it stays whole
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["path"])

    return records.select(record).mapInArrow(run, "path string").groupBy("path").agg(F.count("*").alias("records"))


TURNS = "conv_id bigint, turn bigint, role string, text string"


def from_json(records: DataFrame, conv_id: str, record: str, ignore: tuple[str, ...] = ("id",)) -> DataFrame:
    """Canonical turns of JSON records, and one row with role null and the record as its text for each that fits no mapping."""
    skipped = frozenset(ignore)

    def run(batches):
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    turns = record_turns(json.loads(text or ""), skipped)
                except (ValueError, AttributeError, TypeError, KeyError):
                    turns = None
                out += [(key, i, r, t) for i, (r, t) in enumerate(turns)] if turns is not None else [(key, None, None, text)]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["conv_id", "turn", "role", "text"])

    return records.select(F.col(conv_id).cast("bigint"), F.col(record)).mapInArrow(run, TURNS)


def canonical_turns(table: DataFrame) -> DataFrame:
    """Canonical turns of a table of typed columns, by the fingerprint of its schema.

    Columns that no mapping names are set aside: the registered layout of most fields that the table has wins.
    """
    present = set(table.columns)
    by_schema = {f: fingerprint(schema_paths(T.StructType([table.schema[c] for c in f]))) for f in {tuple(dict.fromkeys(x.split(".")[0].rstrip("[]") for x in m.fields)) for m in MAPPINGS} if set(f) <= present}
    fitting = [(f, REGISTRY[k]) for f, k in by_schema.items() if k in REGISTRY]
    if not fitting:
        raise ValueError(f"no mapping for the fields {sorted(present)}")
    fields, mapping = max(fitting, key=lambda x: (len(x[0]), x[1].name))
    if mapping.name == "turn rows":
        return table.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    if "conv_id" not in present:
        raise ValueError("a column conv_id is needed")
    return from_json(table.select("conv_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record")), "conv_id", "record")


FORMATTED = "conv_id bigint, turn bigint, formatted string, loss_start bigint, loss_end bigint"


def format_turns(turns: DataFrame) -> DataFrame:
    """Each turn as the template writes it; the loss mask in code points of ``formatted``, null where there is no loss."""

    def run(batches):
        for batch in batches:
            role, text = (batch.column(n).to_pylist() for n in ("role", "text"))
            out = [format_turn(r or "", t or "") for r, t in zip(role, text)]
            loss = [(a, b) if r == "assistant" else (None, None) for r, (_, a, b) in zip(role, out)]
            columns = [pa.array([x[0] for x in out], pa.string()), *(pa.array([x[k] for x in loss], pa.int64()) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), *columns], names(FORMATTED))

    return turns.select("conv_id", "turn", "role", "text").mapInArrow(run, FORMATTED)


READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold: turns and loss texts read from the marks and the mask, hashed as a stream."""

    def run(batches):
        key, state = None, None

        def row():
            return [key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

        for batch in batches:
            out = []
            for conv, text, a, b in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_end"))):
                if state is None or conv != key:
                    if state is not None:
                        out.append(row())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for m in TURN.finditer(text):
                    state[0] += 1
                    state[1].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                state[4] += len(text)
                if a is not None:
                    learned = unescape(text[a:b])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
            yield _rows(out)
        if state is not None:
            yield _rows([row()])

    def _rows(rows):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names(READ))

    # null texts never occur here; equal positions stand by the formatted turn, which begins with the role
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted").mapInArrow(run, READ)


def op9_chat_format(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], TURNS)
    return read_back(format_turns(canonical_turns(table).unionByName(more)))
