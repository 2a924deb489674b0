"""Chat formatting of typed content parts.

A turn's content is a list of parts (text, image, audio, document). A visitor walks the
parts in order: text is escaped, every other part becomes a numbered placeholder, with
its reference and its expanded token count recorded beside the text. Turns are marked
ChatML-style; the loss mask covers what the assistant says.

Escaping is reversible: every `<` that is followed by any number of backslashes and a bar
gets one more backslash, so no escaped text holds `<|`, and a text that already looks
escaped is told apart from one that was.

A conversation is one value of the result, so its turns meet in one row; conversations
are spread over all tasks.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
START = "<|im_start|>"
END = "<|im_end|>"
LOSS_ROLES = ("assistant",)

PART = "type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int"
SPAN = "struct<start:bigint,end:bigint>"
ATTACHMENT = "struct<turn:int,place:int,type:string,ref:string,tokens:bigint>"
SCHEMA = (
    f"conv_id bigint, n_turns bigint, formatted string, loss_spans array<{SPAN}>, "
    f"attachments array<{ATTACHMENT}>, expanded_tokens bigint"
)

_HIDE = re.compile(r"<(\\*)\|")
_SHOW = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _HIDE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHOW.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stands on one line: line breaks and backslashes are escaped as well."""
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


@dataclass
class Budget:
    """Tokens that a placeholder stands for once its attachment is encoded."""

    image_patch: int = 14
    audio_tokens_per_second: float = 25.0
    document_tokens_per_page: int = 600


@dataclass
class PartVisitor:
    """Flattens the parts of one conversation; placeholders are numbered per kind."""

    budget: Budget = field(default_factory=Budget)
    attachments: list[dict] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)

    def visit(self, part: dict, turn: int) -> str:
        kind = part.get("type") or "text"
        handler = getattr(self, f"visit_{kind}", None)
        if handler is None:
            return self._place(kind, part, turn, 0)
        return handler(part, turn)

    def visit_text(self, part: dict, turn: int) -> str:
        return escape(part.get("text") or "")

    def visit_image(self, part: dict, turn: int) -> str:
        side = self.budget.image_patch
        wide, high = part.get("width") or 0, part.get("height") or 0
        return self._place("image", part, turn, math.ceil(wide / side) * math.ceil(high / side))

    def visit_audio(self, part: dict, turn: int) -> str:
        tokens = math.ceil((part.get("seconds") or 0) * self.budget.audio_tokens_per_second)
        return self._place("audio", part, turn, tokens)

    def visit_document(self, part: dict, turn: int) -> str:
        tokens = (part.get("pages") or 0) * self.budget.document_tokens_per_page
        return self._place("document", part, turn, tokens)

    def _place(self, kind: str, part: dict, turn: int, tokens: int) -> str:
        number = self.counts.get(kind, 0)
        self.counts[kind] = number + 1
        self.attachments.append({
            "turn": turn, "place": number, "type": kind, "ref": part.get("ref"), "tokens": tokens,
        })
        return f"<|{escape_role(kind)}_{number}|>"


def format_turns(turns: list[dict], budget: Budget | None = None) -> dict:
    """One conversation as text, with the spans (code points) that bear loss."""
    visitor, out, spans, at = PartVisitor(budget or Budget()), [], [], 0
    for k, turn in enumerate(turns):
        role = turn["role"] or ""
        head = f"{START}{escape_role(role)}\n"
        body = "".join(visitor.visit(p, k) for p in turn["parts"] or () if p is not None)
        tail = f"{END}\n"
        if role in LOSS_ROLES:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        out += (head, body, tail)
        at += len(head) + len(body) + len(tail)
    return {
        "n_turns": len(turns), "formatted": "".join(out), "loss_spans": spans,
        "attachments": visitor.attachments,
        "expanded_tokens": sum(a["tokens"] for a in visitor.attachments),
    }


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, as the formatted text has them (placeholders stay)."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def text_parts(rows: DataFrame, text: str = "text") -> DataFrame:
    """Give rows with a plain text column the `parts` column of one text part."""
    plain = F.from_json(F.lit("{}"), PART.replace(":", " ").replace(",", ", "))
    part = plain.withField("type", F.lit("text")).withField(
        "text", F.coalesce(F.col(text), F.lit(""))
    )
    return rows.withColumn("parts", F.array(part))


def format_conversations(rows: DataFrame, budget: Budget | None = None) -> DataFrame:
    """Format turns (`conv_id`, `turn`, `role`, `parts`) into one row per conversation.

    Turns are ordered by `turn` (null first), equal turns by role, then by their parts;
    repeated rows are repeated turns. A null role is an empty role, null parts are no
    parts, an unknown kind of part is kept as a placeholder of 0 tokens. Rows without
    conv_id form one conversation. Other columns are not read; no rows give no rows.
    """
    turns = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "parts"))).alias("turns")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("conv_id"), batch.column("turns")
            for at in range(0, batch.num_rows, 256):
                done = [format_turns(t, budget) for t in lists.slice(at, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, 256),
                    pa.array([d["n_turns"] for d in done], pa.int64()),
                    pa.array([d["formatted"] for d in done], pa.string()),
                    pa.array([d["loss_spans"] for d in done], _SPANS),
                    pa.array([d["attachments"] for d in done], _ATTACHMENTS),
                    pa.array([d["expanded_tokens"] for d in done], pa.int64()),
                ], names=_NAMES)

    return turns.mapInArrow(run, SCHEMA)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ATTACHMENTS = pa.list_(pa.struct([
    ("turn", pa.int32()), ("place", pa.int32()), ("type", pa.string()),
    ("ref", pa.string()), ("tokens", pa.int64()),
]))
_NAMES = ["conv_id", "n_turns", "formatted", "loss_spans", "attachments", "expanded_tokens"]


DIGESTS = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string"


def digests(formatted: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """Read conversations back from the formatted text and its loss mask, as digests."""
    rows = []
    for text, marked in zip(formatted, spans, strict=True):
        turns = read_turns(text)
        loss = "".join(unescape(text[s["start"] : s["end"]]) for s in marked)
        said = "".join(f"{role}\n{body}\n" for role, body in turns)
        rows.append((len(turns), _sha(said), len(loss), _sha(loss)))
    return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
