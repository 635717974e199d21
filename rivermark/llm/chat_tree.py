"""Chat formatting as packed prefix trees.

Conversations are sorted by their turns, which is the depth-first order of the tree
of all of them: neighbours share their first turns. A task walks its part of that
order and packs it into rows of about ``PACK`` characters. Within a pack a turn that several
conversations share is written once; its node tells where it stands in the
pack's text, the position its first character has in the conversation, its parent, the
intervals of the pack that it may attend to besides itself (its ancestors), and which
characters the loss counts. A first turn that very many conversations share is split
over packs, and written once in each; the sort order ends in the id, so equal conversations
spread over tasks.

The template marks turns with ``[INST] .. [/INST]`` (user), ``<s> .. </s>`` (assistant),
``<<SYS>> .. <</SYS>>`` (system) and ``<<ROLE name>> .. <</ROLE>>`` (any other role). In texts
and role names the characters ``\\ [ < >`` get a backslash, so no text can hold a mark,
and removing the backslashes gives back the text. The loss counts assistant texts
without marks.

Rows are ordered by turn, then role and text (nulls first); null texts and roles count as empty,
repeated rows are turns of their own, rows with a null id are one conversation. One
conversation's turns meet in one row, as its formatted text does.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark.llm.rows import col, stored

PACK = 200_000
# fixed values: the marks around a turn by role
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}
OTHER_MARKS = ("<<ROLE {}>>\n", "\n<</ROLE>>\n")
BODY = r"((?:[^\\\[<>]|\\.)*)"
TURN = re.compile(
    rf"\[INST\] {BODY} \[/INST\]|<s> {BODY} </s>|<<SYS>>\n{BODY}\n<</SYS>>\n|<<ROLE {BODY}>>\n{BODY}\n<</ROLE>>\n", re.S
)
ROLES = {1: "user", 2: "assistant", 3: "system"}
PACKS = """text string,
    nodes array<struct<start:long, end:long, position:long, parent:int, attends:array<struct<start:long, end:long>>,
        loss_start:long, loss_end:long>>,
    conversations array<struct<conv_id:{id}, leaf:int>>"""
READ = "conv_id {id}, turns array<struct<role:string, text:string>>, loss string, formatted string"


def escaped(text: str) -> str:
    return re.sub(r"([\\\[<>])", r"\\\1", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and the span of its text."""
    before, after = MARKS.get(role) or (OTHER_MARKS[0].format(escaped(role)), OTHER_MARKS[1])
    body = escaped(text)
    return before + body + after, len(before), len(before) + len(body)


def parsed(formatted: str) -> list[dict]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        role = ROLES.get(found.lastindex) or unescaped(found.group(4))
        turns.append({"role": role, "text": unescaped(found.group(found.lastindex))})
        at = found.end()
    return turns


class Pack:
    """A prefix tree under construction, in depth-first order."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.nodes: list[dict] = []
        self.conversations: list[dict] = []
        self.path: list[tuple[int, tuple[str, str]]] = []  # node and turn, from the root

    def shared(self, turns: list[tuple[str, str]]) -> int:
        count = 0
        for (_, mine), turn in zip(self.path, turns):
            if mine != turn:
                break
            count += 1
        return count

    def add(self, name, turns: list[tuple[str, str]]) -> None:
        del self.path[self.shared(turns) :]
        for role, text in turns[len(self.path) :]:
            shown, begin, end = rendered(role, text)
            above = self.nodes[self.path[-1][0]] if self.path else None
            attends = list(above["attends"]) if above else []
            if above:
                span = {"start": above["start"], "end": above["end"]}
                if attends and attends[-1]["end"] == span["start"]:
                    span["start"] = attends.pop()["start"]
                attends.append(span)
            loss = role == "assistant"
            self.nodes.append(
                {
                    "start": self.length,
                    "end": self.length + len(shown),
                    "position": above["position"] + above["end"] - above["start"] if above else 0,
                    "parent": self.path[-1][0] if self.path else -1,
                    "attends": attends,
                    "loss_start": self.length + (begin if loss else 0),
                    "loss_end": self.length + (end if loss else 0),
                }
            )
            self.path.append((len(self.nodes) - 1, (role, text)))
            self.parts.append(shown)
            self.length += len(shown)
        self.conversations.append({"conv_id": name, "leaf": self.path[-1][0] if self.path else -1})

    def row(self) -> dict:
        return {"text": "".join(self.parts), "nodes": self.nodes, "conversations": self.conversations}


def pack_up(schema: pa.Schema, limit: int):
    def run(batches):
        pack = Pack()
        for batch in batches:
            for name, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                pack.add(name, [(turn["role"], turn["text"]) for turn in turns])
                if pack.length + 100 * len(pack.conversations) >= limit:
                    yield pa.RecordBatch.from_pylist([pack.row()], schema=schema)
                    pack = Pack()
        if pack.conversations:
            yield pa.RecordBatch.from_pylist([pack.row()], schema=schema)

    return run


def packed(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    limit: int = PACK,
) -> DataFrame:
    """Packs (text, nodes, conversations) of all conversations."""
    text = lambda name: F.coalesce(col(name).cast("string"), F.lit(""))
    turn = F.struct(col(turn_column).alias("turn"), text(role_column).alias("role"), text(text_column).alias("text"))
    whole = conversations.select(col(id_column).alias("conv_id"), turn.alias("turn")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("turn")).alias("turns")
    )
    paths = whole.withColumn("path", F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])))
    # written first: the sort reads its input twice, once to find the ranges
    ordered = stored(paths, "conversation-paths").orderBy("path", "conv_id").select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )
    kind = ordered.schema["conv_id"].dataType
    schema = conversations.sparkSession.createDataFrame([], PACKS.format(id=kind.simpleString())).toArrow().schema
    return ordered.mapInArrow(pack_up(schema, limit), PACKS.format(id=kind.simpleString()))


def read_packs(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for pack in batch.to_pylist():
                rows = []
                for one in pack["conversations"]:
                    spans, node = [], one["leaf"]
                    while node >= 0:
                        spans.append(pack["nodes"][node])
                        node = spans[-1]["parent"]
                    spans.reverse()
                    text = pack["text"]
                    formatted = "".join(text[n["start"] : n["end"]] for n in spans)
                    loss = "".join(unescaped(text[n["loss_start"] : n["loss_end"]]) for n in spans)
                    rows.append(
                        {"conv_id": one["conv_id"], "turns": parsed(formatted), "loss": loss, "formatted": formatted}
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def read_back(packs: DataFrame) -> DataFrame:
    """(conv_id, turns, loss, formatted) of every conversation, from the packs alone."""
    kind = packs.schema["conversations"].dataType.elementType["conv_id"].dataType.simpleString()
    schema = packs.sparkSession.createDataFrame([], READ.format(id=kind)).toArrow().schema
    return packs.mapInArrow(read_packs(schema), READ.format(id=kind))


def attention(node: dict) -> list[tuple[int, int]]:
    """Intervals of the pack that a node's characters see: all of its ancestors, and itself up to each character."""
    return [(a["start"], a["end"]) for a in node["attends"]] + [(node["start"], node["end"])]


def position_ids(nodes: list[dict]) -> list[int]:
    """Position of each character of a pack in its conversations."""
    return [node["position"] + n for node in nodes for n in range(node["end"] - node["start"])]


def chat_format(conversations: DataFrame) -> DataFrame:
    """Digests of every conversation and of conversation -1, as read back from the packs."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    read = read_back(packed(rows.unionByName(probe)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(regexp_replace(text, '([\\\[<>])', '\\\1', 'g')) + CASE role
        WHEN 'user' THEN length('[INST]  [/INST]')
        WHEN 'assistant' THEN length('<s>  </s>')
        WHEN 'system' THEN length('<<SYS>><</SYS>>') + 3
        ELSE length('<<ROLE >><</ROLE>>') + 3 + length(regexp_replace(role, '([\\\[<>])', '\\\1', 'g')) END AS chars
    FROM rows
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
