"""Chat formatting: records of many layouts become canonical turns, then one marked text with a loss mask.

A record is JSON. Its nested field paths (``[]`` for list elements) are sorted and hashed; this fingerprint selects a
declared mapping, which says where turns, roles and texts are. Unknown layouts are returned with null turns and the
fingerprint, so that a mapping can be declared for them. The template marks turns; escapes inside roles and texts are
reversible, so no text can end or begin a turn.

Null texts and roles count as empty. A null or broken record has an unknown layout. Rows of one conversation are put in
order by turn, then role and text; a null turn comes first; repeated rows are repeated turns. Rows with a null
conversation id form one conversation with a null id. Other columns are ignored; an empty table gives an empty
result. A conversation is one output row, so a single conversation's turns meet in one task.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import share_code

START, END, BREAK = "<|im_start|>", "<|im_end|>", "\n"

#: Other names of the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Declared layout: a list of turns with role and text fields, or fields that are a role's text each."""

    name: str
    turns: str | None = None
    role: str = ""
    text: str = ""
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()  # (role, fields joined by an empty line)
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()

    def fingerprints(self) -> list[int]:
        need = list(self.required)
        if self.turns:
            need += [self.turns, f"{self.turns}[]", f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"]
        return [
            fingerprint_of([*need, *extra])
            for k in range(len(self.optional) + 1) for extra in itertools.combinations(self.optional, k)
        ] + ([fingerprint_of([*self.required, self.turns])] if self.turns else [])

    def apply(self, record: dict) -> list[tuple[str, str]]:
        out = []
        if "system" in self.optional and record.get("system"):
            out.append(("system", _text(record["system"])))
        if self.turns:
            for turn in record.get(self.turns) or []:
                role = _text(turn.get(self.role))
                out.append((ROLES.get(role, role), _text(turn.get(self.text))))
        for role, fields in self.parts:
            texts = [_text(record.get(f)) for f in fields]
            out.append((role, "\n\n".join(t for t in texts if t)))
        return out


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def paths(value, at: str = "") -> set[str]:
    """Nested field paths of a record."""
    out: set[str] = set()
    if isinstance(value, dict):
        for k, v in value.items():
            here = f"{at}.{k}" if at else k
            out |= {here} | paths(v, here)
    elif isinstance(value, list):
        for v in value:
            out |= {f"{at}[]"} | paths(v, f"{at}[]")
    return out


def fingerprint_of(names) -> int:
    digest = hashlib.sha256("\n".join(sorted(set(names))).encode("utf-8", "surrogatepass")).digest()
    return int.from_bytes(digest[:8], "big", signed=True)


MAPPINGS = [
    Mapping("messages", turns="messages", role="role", text="content", optional=("system", "id")),
    Mapping("from_value", turns="conversations", role="from", text="value", optional=("system", "id")),
    Mapping("turn_rows", turns="turns", role="role", text="text", optional=("system", "id")),
    Mapping("instruction", parts=(("user", ("instruction", "input")), ("assistant", ("output",))), required=("instruction", "output"), optional=("input", "system", "id")),
    Mapping("prompt_completion", parts=(("user", ("prompt",)), ("assistant", ("completion",))), required=("prompt", "completion"), optional=("system", "id")),
    Mapping("prompt_response", parts=(("user", ("prompt",)), ("assistant", ("response",))), required=("prompt", "response"), optional=("system", "id")),
    Mapping("question_answer", parts=(("user", ("context", "question")), ("assistant", ("answer",))), required=("question", "answer"), optional=("context", "system", "id")),
]

BY_FINGERPRINT = {f: m for m in MAPPINGS for f in m.fingerprints()}


def escape(text: str) -> str:
    """No ``<|`` is left; backslashes are doubled first."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|") if "\\" in text or "<|" in text else text


_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def render(turns: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """Marked text, and (start, length) in code points of every text under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}{BREAK}", escape(text)
        if role == learned:
            spans.append((at + len(head), len(body)))
        turn = f"{head}{body}{END}{BREAK}"
        out.append(turn)
        at += len(turn)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a marked text."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn at {at}")
        line = formatted.index(BREAK, at)
        stop = formatted.index(END, line)
        turns.append((unescape(formatted[at + len(START) : line]), unescape(formatted[line + 1 : stop])))
        at = stop + len(END) + len(BREAK)
    return turns


def records_of_turns(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, record): one JSON record for each conversation of a table with a row for each turn."""
    empty = F.lit("")
    one = F.struct(
        F.coalesce(F.col(turn).cast("long"), F.lit(-(1 << 63))).alias("at"), F.coalesce(F.col(role).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text).cast("string"), empty).alias("content"),
    )
    turns = F.array_sort(F.collect_list(one))
    messages = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    grouped = rows.groupBy(F.col(id).cast("long").alias("conv_id")).agg(messages.alias("messages"))
    return grouped.select("conv_id", F.to_json(F.struct("messages")).alias("record"))


_FORMATTED = "conv_id long, fingerprint long, layout string, n_turns long, formatted string, loss array<struct<start: long, length: long>>"


def format_records(records: DataFrame, id: str = "conv_id", record: str = "record", learned: str = "assistant") -> DataFrame:
    """conv_id, fingerprint, layout, n_turns, formatted text and loss spans of JSON records of any declared layout."""
    share_code(records.sparkSession)
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for raw in batch.column(1).to_pylist():
                try:
                    value = json.loads(raw) if raw is not None else None
                except ValueError:
                    value = None
                mark = fingerprint_of(paths(value))
                mapping = BY_FINGERPRINT.get(mark) if isinstance(value, dict) else None
                turns = mapping.apply(value) if mapping else None
                text, loss = render(turns, learned) if turns is not None else (None, None)
                row = (mark, mapping and mapping.name, None if turns is None else len(turns), text, loss and [{"start": a, "length": b} for a, b in loss])
                for column, x in zip(out, (*row[:4], [] if loss == [] else row[4])):
                    column.append(x)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), span]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=["conv_id", "fingerprint", "layout", "n_turns", "formatted", "loss"]
            )

    picked = records.select(F.col(id).cast("long").alias("conv_id"), F.col(record).cast("string").alias("record"))
    return picked.mapInArrow(run, _FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts say; rows of unknown layouts have none."""
    share_code(formatted.sparkSession)

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text is None:
                    row = (None,) * 5
                else:
                    turns = parse(text)
                    learned = "".join(unescape(text[s["start"] : s["start"] + s["length"]]) for s in loss)
                    row = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), digest(learned), len(text))
                for column, x in zip(out, row):
                    column.append(x)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, schema)
