"""Chat formatting by schema fingerprints.

A record is JSON of one of many layouts: one turn, a list of messages, an
instruction with an answer, pairs of questions and answers.  The sorted paths
of its known fields are hashed, and the hash picks a mapping that says, as
data, which fields become turns of which role.  A record with more known
fields than any mapping names is read by the most specific mapping whose
required fields it has.  Turns are written with a
template whose control strings cannot be faked: inside texts they are escaped,
reversibly.  The output names the part of each turn that a model learns from.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>"
LEARN = "assistant"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """``required`` and ``optional`` paths, and the turns made from them.

    A turn is (list path, role, text): without a list once, else per element.
    A role that is a path is looked up, ``=name`` is taken literally.
    """

    name: str
    required: tuple[str, ...]
    turns: tuple[tuple[str, str, str], ...]
    optional: tuple[str, ...] = ()
    #: Roles as they stand, also those that have a common name.
    as_given: bool = False


MAPPINGS = (
    Mapping("turn", ("role", "text"), (("", "role", "text"),), as_given=True),
    Mapping("turn_content", ("role", "content"), (("", "role", "content"),)),
    Mapping("messages", ("messages[].role", "messages[].content"),
            (("", "=system", "system"), ("messages", "role", "content")), ("system",)),
    Mapping("message_parts", ("messages[].role", "messages[].content[].text"),
            (("", "=system", "system"), ("messages", "role", "content")), ("messages[].content[].type", "system")),
    Mapping("messages_mixed", ("messages[].role", "messages[].content", "messages[].content[].text"),
            (("", "=system", "system"), ("messages", "role", "content")), ("messages[].content[].type", "system")),
    Mapping("conversations", ("conversations[].role", "conversations[].content"),
            (("", "=system", "system"), ("conversations", "role", "content")), ("system",)),
    Mapping("from_value", ("conversations[].from", "conversations[].value"),
            (("", "=system", "system"), ("conversations", "from", "value")), ("system",)),
    Mapping("instruction", ("instruction", "output"),
            (("", "=system", "system"), ("", "=user", "instruction+input"), ("", "=assistant", "output")),
            ("input", "system")),
    Mapping("prompt_completion", ("prompt", "completion"),
            (("", "=system", "system"), ("", "=user", "prompt"), ("", "=assistant", "completion")), ("system",)),
    Mapping("prompt_response", ("prompt", "response"),
            (("", "=system", "system"), ("history", "=user", "0"), ("history", "=assistant", "1"),
             ("", "=user", "prompt"), ("", "=assistant", "response")), ("system", "history[][]")),
    Mapping("question_answer", ("question", "answer"),
            (("", "=system", "system"), ("", "=user", "context+question"), ("", "=assistant", "answer")), ("system", "context")),
)
KNOWN = frozenset(p for m in MAPPINGS for p in m.required + m.optional)


def paths(value: object, at: str = "") -> set[str]:
    """Paths of the scalars in a record; elements of a list share one path."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths(v, f"{at}.{k}" if at else str(k))}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, at + "[]")}
    return {at}


def fingerprint(found: set[str] | frozenset[str]) -> str:
    """Hash of the paths that some mapping knows; other fields do not matter."""
    return hashlib.sha1("\n".join(sorted(found & KNOWN)).encode()).hexdigest()


BY_FINGERPRINT = {
    fingerprint(frozenset(m.required + extra)): m
    for m in MAPPINGS
    for n in range(len(m.optional) + 1)
    for extra in combinations(m.optional, n)
}


def _text(value: object) -> str:
    """Text of a field: parts one after the other, NULL as nothing."""
    if isinstance(value, list):
        return "".join(_text(v.get("text") if isinstance(v, dict) else v) for v in value)
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def mapping_of(record: object) -> tuple[Mapping | None, bool]:
    """The mapping of a record, and whether its fingerprint names it exactly.

    Without an exact one it is the mapping of most required paths, of equals
    that which leaves fewer known paths unread, then the earlier in the list.
    """
    if not isinstance(record, dict):
        return None, False
    found = paths(record) & KNOWN
    if exact := BY_FINGERPRINT.get(fingerprint(found)):
        return exact, True
    fit = [m for m in MAPPINGS if found.issuperset(m.required)]
    return min(fit, key=lambda m: (-len(m.required), len(found.difference(m.required, m.optional))), default=None), False


def turns(record: object) -> list[tuple[str, str]] | None:
    """Role and text of each turn; None when no mapping fits."""
    mapping, _ = mapping_of(record)
    return None if mapping is None else mapped_turns(record, mapping)


def mapped_turns(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    out, lists = [], {}
    for many, role, text in mapping.turns:
        items = record.get(many) if many else [record]
        for k, item in enumerate(items if isinstance(items, list) else []):
            if isinstance(item, list):
                item = dict(zip(map(str, range(len(item))), item))
            if not isinstance(item, dict):
                continue
            fields = [f for f in text.split("+") if f in item]
            if not fields:
                continue
            body = "\n\n".join(t for t in (_text(item[f]) for f in fields) if t or len(fields) == 1)
            name = role[1:] if role[0] == "=" else _text(item.get(role))
            where = lists.setdefault(many, len(out)) if many else len(out)
            out.append((where, k, len(out), name if mapping.as_given else ROLES.get(name, name), body))
    return [(role, body) for *_, role, body in sorted(out)]


def escaped(text: str) -> str:
    """``<|`` never occurs in the result: a backslash goes between, before any there are."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def piece(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and from where to where its text stands."""
    head = START + escaped(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
    body = escaped(text)
    return head + body + STOP + "\n", len(head), len(head) + len(body)


def parsed(written: str) -> list[tuple[str, str]]:
    """Role and text of every turn in formatted text."""
    out = []
    for part in written.split(START)[1:]:
        head, _, rest = part.partition("\n")
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(head))
        out.append((role, unescaped(rest.rpartition(STOP)[0])))
    return out


def format_chats(records: DataFrame) -> DataFrame:
    """Formats records (conv_id, turn, record): one row per turn.

    conv_id, turn, nth (within the record), piece, learn_from, learn_to (code
    points of ``piece`` that are learnt from; NULL if none), mapped, raw.  A
    record that is NULL, no JSON or of no known layout gives one row with
    mapped = false and an empty piece.  ``raw`` is the record itself, in its
    first row, where the fingerprint names no mapping exactly, so fields that
    were not read stay at hand; NULL elsewhere.  An unknown role is kept as it
    is, a NULL role is empty.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, nth, pieces, begin, stop, mapped, raw = [], [], [], [], [], [], []
            for i, r in enumerate(b.column("record").to_pylist()):
                found, exact = None, False
                try:
                    record = json.loads(r) if r is not None else None
                    mapping, exact = mapping_of(record)
                    found = mapped_turns(record, mapping) if mapping else None
                except (ValueError, RecursionError):
                    pass
                for k, (role, text) in enumerate(found or [("", "")]):
                    p, x, y = piece(role, text) if found else ("", None, None)
                    learn = bool(found) and role == LEARN
                    at.append(i)
                    nth.append(k)
                    pieces.append(p)
                    begin.append(x if learn else None)
                    stop.append(y if learn else None)
                    mapped.append(bool(found))
                    raw.append(None if k or exact and found else r)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id").take(rows), b.column("turn").take(rows), pa.array(nth, pa.int32()),
                 pa.array(pieces, pa.string()), pa.array(begin, pa.int32()), pa.array(stop, pa.int32()),
                 pa.array(mapped, pa.bool_()), pa.array(raw, pa.string())],
                ["conv_id", "turn", "nth", "piece", "learn_from", "learn_to", "mapped", "raw"])

    rows = records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "record")
    return rows.mapInArrow(run, "conv_id long, turn long, nth int, piece string, learn_from int, learn_to int,"
                                " mapped boolean, raw string")


@dataclass
class _Digest:
    conv_id: int | None
    n_turns: int = 0
    loss_chars: int = 0
    chars: int = 0
    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)

    def add(self, text: str, learn: tuple[int | None, int | None]) -> None:
        for role, body in parsed(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{body}\n".encode())
        if learn[0] is not None:
            body = unescaped(text[learn[0]:learn[1]])
            self.loss_chars += len(body)
            self.loss.update(body.encode())
        self.chars += len(text)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from formatted turns alone.

    A digest over a conversation has to see its turns in order, so each goes
    through one task; turns are streamed there, sorted by (conv_id, turn,
    nth, piece), and only the digests' state is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for b in batches:
            done = []
            for conv, text, x, y in zip(*(b.column(c).to_pylist() for c in ("conv_id", "piece", "learn_from", "learn_to"))):
                if now is None or now.conv_id != conv:
                    done += [now] if now else []
                    now = _Digest(conv)
                now.add(text, (x, y))
            yield _digests(done)
        yield _digests([now] if now else [])

    return (
        formatted.select("conv_id", "turn", "nth", "piece", "learn_from", "learn_to")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "nth", "piece")
        .select("conv_id", "piece", "learn_from", "learn_to")
        .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
                         " loss_sha256 string, formatted_chars long")
    )


def _digests(done: list[_Digest]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([d.conv_id for d in done], pa.int64()), pa.array([d.n_turns for d in done], pa.int64()),
         pa.array([d.turns.hexdigest() for d in done], pa.string()), pa.array([d.loss_chars for d in done], pa.int64()),
         pa.array([d.loss.hexdigest() for d in done], pa.string()), pa.array([d.chars for d in done], pa.int64())],
        ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text as records of the layout ``turn``."""
    return conversations.select(
        "conv_id", "turn",
        F.to_json(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("record"),
    )
