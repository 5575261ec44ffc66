"""Chat formatting by schema fingerprinting.

A record is a JSON document in one of many layouts. Its fingerprint is a hash of the sorted set of
its nested field paths (list items share one path, every leaf names its type). A declarative mapping says, for each layout, which paths hold
the turns; the fingerprints of a mapping are computed from the paths it declares, and a record is converted by the
mapping its fingerprint selects into canonical turns (role, text). A record of no known layout keeps its
fingerprint and gets no turns, so it can be found and given a mapping.

Canonical turns are written with a template that marks each turn. Control strings inside roles and texts are
escaped by a backslash after their first character and backslashes are doubled, so a text can neither open nor close a turn, and reading
back restores it exactly. The loss mask covers the escaped text of the assistant's turns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted

START, END = "<|im_start|>", "<|im_end|>"
#: Strings with a meaning for this or other common templates.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ASSISTANT = "assistant"

_ESCAPE = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)) + r"|\\")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_ROLE = re.compile(r"(?:\\.|[^\\\n])*", re.S)


def escape(text: str) -> str:
    """Double each backslash and put one after the first character of each control string."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def escape_role(role: str) -> str:
    """As ``escape``, and a backslash before each newline, so a role ends at the first bare one."""
    return escape(role).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def paths(value: object, at: str = "") -> set[str]:
    """Nested field paths of a JSON value, e.g. ``messages[].role:str``."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else {at + "{}"}
    if isinstance(value, list):
        return set().union(*(paths(v, at + "[]") for v in value)) if value else {at + "[]"}
    kind = "null" if value is None else "bool" if isinstance(value, bool) else "str" if isinstance(value, str) else "num"
    return {f"{at}:{kind}"}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """A layout. Either ``turns`` names a list whose items have ``role`` and ``text``, or ``fields`` lists (path, role)."""

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = field(default=())

    def fingerprints(self) -> list[str]:
        """Of every set of present fields that the layout allows."""
        if self.turns:
            return [fingerprint({f"{self.turns}[].{self.role}:str", f"{self.turns}[].{self.text}:str"}), fingerprint({f"{self.turns}[]"})]
        must = {f"{p}:str" for p, _ in self.fields if p not in self.optional}
        return [fingerprint(must | {f"{p}:str" for p in more}) for n in range(len(self.optional) + 1) for more in combinations(self.optional, n)]

    def convert(self, record: dict) -> list[tuple[str, str]]:
        def get(path: str) -> object:
            value: object = record
            for part in path.split("."):
                value = value.get(part) if isinstance(value, dict) else None
            return value

        if self.turns:
            names = dict(self.roles)
            return [(names.get(t[self.role], t[self.role]), t[self.text]) for t in get(self.turns) or []]
        return [(role, get(path)) for path, role in self.fields if isinstance(get(path), str)]


MAPPINGS = (
    Mapping("messages", turns="messages", role="role", text="content"),
    Mapping("from_value", turns="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("dialog", turns="data.dialog", role="speaker", text="utterance"),
    Mapping("prompt", fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping("instruction", fields=(("system", "system"), ("instruction", "user"), ("output", "assistant")), optional=("system", "output")),
)
BY_FINGERPRINT = {fp: m for m in MAPPINGS for fp in m.fingerprints()}


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, loss spans in code points)."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{END}\n")
        at += len(out[-1])
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns = []
    for part in formatted.split(START)[1:]:
        head = _ROLE.match(part)[0]
        turns.append((unescape(head), unescape(part[len(head) + 1 : part.rindex(END)])))
    return turns


_OUT = "fingerprint string, layout string, formatted string, loss array<struct<start:bigint,stop:bigint>>"


def _formatted(value: str | None) -> dict:
    data = json.loads(value) if value is not None else None
    print_ = fingerprint(paths(data))
    mapping = BY_FINGERPRINT.get(print_) if isinstance(data, dict) else None
    if mapping is None:
        return {"fingerprint": print_, "layout": None, "formatted": None, "loss": None}
    text, spans = render(mapping.convert(data))
    text.encode()  # a text with a lone surrogate is no Unicode text
    return {"fingerprint": print_, "layout": mapping.name, "formatted": text, "loss": [{"start": a, "stop": z} for a, z in spans]}


def formatted(record: Column) -> Column:
    """struct(fingerprint, layout, formatted, loss) of a JSON record; layout and what follows are null for an unknown one.

    A record that is no JSON, holds a lone surrogate or is nested too deep to be read counts as null."""

    @F.arrow_udf(_OUT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("fingerprint", pa.string()), ("layout", pa.string()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
        for col in batches:
            out = []
            for value in col.to_pylist():
                try:
                    out.append(_formatted(value))
                except (ValueError, RecursionError):  # no JSON, a lone surrogate, or nested too deep
                    out.append(_formatted(None))
            yield pa.array(out, kind)

    return run(record.cast("string"))


def read_back(text: Column, loss: Column) -> Column:
    """struct of digests read from a formatted text and its loss spans."""

    @F.arrow_udf("n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for value, own in zip(texts.to_pylist(), spans.to_pylist()):
            value, own = value or "", own or []
            turns = parse(value)
            told = "".join(unescape(value[s["start"] : s["stop"]]) for s in own)
            out.append({
                "n_turns": len(turns),
                "turns_sha256": hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                "loss_chars": len(told),
                "loss_sha256": hashlib.sha256(told.encode()).hexdigest(),
                "formatted_chars": len(value),
            })
        return pa.array(out, pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    return run(text, loss)


def format_records(records: DataFrame, id_col: str = "conv_id", record_col: str = "record") -> DataFrame:
    """id, fingerprint, layout, formatted text and loss spans of every JSON record.

    A null, empty or ill-formed record has the fingerprint of no fields and no layout; repeated rows return
    equal rows; an empty table returns no rows. Other columns of ``records`` are not read.
    """
    return records.select(quoted(id_col).alias(id_col), formatted(quoted(record_col)).alias("f")).select(id_col, "f.*")


def records_of_turns(turns: DataFrame) -> DataFrame:
    """One JSON record per conversation of (conv_id, turn, role, text) rows, in the layouts such data arrive in.

    Turns are ordered by number (ties by role and text, nulls first); null roles and texts are empty. The layout follows from the
    conversation: two turns user, assistant or those after one of the system may be prompt or instruction records, and
    the id's remainder spreads the rest over the list layouts.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles, n = F.transform("t", lambda x: x["role"]), F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(3))
    at = lambda i: F.col("t")[i]["text"]
    known = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    told = F.transform("t", lambda x: F.struct(F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["text"].alias("value")))
    listed = lambda role, text: F.transform("t", lambda x: F.struct(x["role"].alias(role), x["text"].alias(text)))
    is_ = lambda *names: roles == F.array(*map(F.lit, names))
    record = (
        F.when(is_("user", "assistant") & (n == 0), F.to_json(F.struct(at(0).alias("prompt"), at(1).alias("completion"))))
        .when(is_("user", "assistant") & (n == 1), F.to_json(F.struct(at(0).alias("instruction"), at(1).alias("output"))))
        .when(is_("system", "user", "assistant") & (n < 2), F.to_json(F.struct(at(0).alias("system"), at(1).alias("instruction"), at(2).alias("output"))))
        .when(is_("user") & (n < 2), F.to_json(F.struct(at(0).alias("instruction"))))
        .when((n == 1) & known, F.to_json(F.struct(told.alias("conversations"))))
        .when(n == 2, F.to_json(F.struct(F.struct(listed("speaker", "utterance").alias("dialog")).alias("data"))))
        .otherwise(F.to_json(F.struct(listed("role", "content").alias("messages"))))
    )
    return conv.select("conv_id", record.alias("record"))
